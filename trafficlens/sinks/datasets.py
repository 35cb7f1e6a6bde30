"""Published datasets: checked parquet writes and SQL table declarations."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

from trafficlens.schemas import OUTPUTS, conform
from trafficlens.session import delete_folder, file_system

# Publishing tiers.
TIERS = ("test", "production")


def dataset_path(root: str, tier: str, name: str) -> str:
    if tier not in TIERS:
        raise ValueError(f"tier must be one of {TIERS}, not {tier!r}")
    return f"{root.rstrip('/')}/{tier}/{name}"


def write_dataset(df: DataFrame, root: str, tier: str, name: str) -> str:
    """Replace a dataset of a tier, after checking it against its schema.

    Overwriting mirrors the result: no file of an earlier run remains.
    """
    path = dataset_path(root, tier, name)
    conform(df, OUTPUTS[name]).write.mode("overwrite").parquet(path)
    return path


def replace_datasets(spark: SparkSession, written: Mapping[str, str]) -> None:
    """Put finished folders (``written``: final path to folder) in their places.

    Called once all of a run's datasets are written, so that a run that fails
    before leaves the tier as it was.
    """
    for path, folder in written.items():
        delete_folder(spark, path)
        files, place = file_system(spark, path)
        files.mkdirs(place.getParent())
        if not files.rename(file_system(spark, folder)[1], place):
            raise OSError(f"cannot move {folder} to {path}")


def table_ddl(name: str, path: str, database: str = "default") -> str:
    columns = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" for f in OUTPUTS[name].fields
    )
    location = path.replace("'", "\\'")
    return (
        f"CREATE TABLE `{database}`.`{name}` ({columns}) USING parquet LOCATION '{location}'"
    )


def _declared(spark: SparkSession, table: str) -> tuple[str, str]:
    """Kind and location of a table."""
    found = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {table}").collect()}
    return found["Type"], found["Location"]


def declare_tables(
    spark: SparkSession,
    root: str,
    tier: str,
    names: Iterable[str],
    database: str = "default",
) -> None:
    """Declare published datasets as external tables with fixed schemas.

    A declaration with another location or schema is replaced; a table of that
    name that holds its own data is not touched and raises.
    """
    for name in names:
        table, path = f"`{database}`.`{name}`", dataset_path(root, tier, name)
        if spark.catalog.tableExists(table):
            kind, location = _declared(spark, table)
            if kind != "EXTERNAL":
                raise ValueError(f"{table} is no external table")
            files, place = file_system(spark, path)
            same = files.makeQualified(place).toString() == location
            if not same or spark.table(table).schema.simpleString() != OUTPUTS[name].simpleString():
                spark.sql(f"DROP TABLE {table}")
        if not spark.catalog.tableExists(table):
            spark.sql(table_ddl(name, path, database))
        spark.catalog.refreshTable(table)

"""Registered queries: columns of the contracts, oracles, and the guard of the entry."""

from __future__ import annotations

import math
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__
import corpus_pipeline
from trafficlens.llm.queries import ORACLE_SQL, QUERIES

TABLES = "documents embeddings pages benchmark labels conversations".split()

COLUMNS = {
    "op1_url_filters": ["page_id", "host", "path", "rule", "verdict"],
    "op3_quality": ["doc_id", "held_out", "score", "predicted"],
    "op4_embedding_dedup": ["vec_id", "n_links", "component_id", "kept"],
    "op5_suffix_dedup": ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
    "op7_best_fit_packing": [
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    ],
    "op9_simhash": ["doc_id", "fingerprint", "component_id"],
    "op10_language_id": ["doc_id", "held_out", "lang_pred", "score"],
    "op11_personal_data": [
        "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"
    ],
}


def test_one_query_for_each_operator():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == [*range(1, 14)]
    assert set(QUERIES) | {"pipeline"} <= set(__spark_entry__.queries())


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).columns[: len(COLUMNS[name])] == COLUMNS[name]


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    return value


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_oracle(spark, sf_dir, name):
    found = QUERIES[name](spark, sf_dir)
    names = sorted(found.columns)
    ours = [tuple(map(plain, r)) for r in found.select(names).collect()]
    with duckdb.connect() as db:
        for table in TABLES:
            db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
        columns = ", ".join(names)
        theirs = db.execute(f"SELECT {columns} FROM ({ORACLE_SQL[name]})").fetchall()
    assert sorted(ours, key=str) == sorted((tuple(map(plain, r)) for r in theirs), key=str)
    assert ours


def test_stages():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language_id", "near_duplicates", "repeated_passages", "benchmark_leaks", "best_fit_packing"
    ]


def test_entry_without_the_subpackage(tmp_path):
    """Only missing files are tolerated, not errors inside them."""
    code = (
        "import sys\n"
        "class Missing:\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name == 'corpus_pipeline' or name.startswith('trafficlens.llm'):\n"
        "            raise ModuleNotFoundError(name, name=name)\n"
        "sys.meta_path.insert(0, Missing())\n"
        "import __spark_entry__ as e\n"
        "assert e.queries() and not any(n.startswith('op') for n in e.queries())\n"
    )
    root = __spark_entry__.__file__.rsplit("/", 1)[0]
    assert subprocess.run([sys.executable, "-c", code], cwd=root).returncode == 0

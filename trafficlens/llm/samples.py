"""Inputs of operators, derived from the sample tables by Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def archive_records(pages: DataFrame) -> DataFrame:
    """A web archive's captures: for every page a full response and a revisit.

    Pages are captured a minute apart and revisited one to five days later, each
    eleventh one before its first capture.  Revisits repeat the entity tag, or its
    weak form, or the date of last modification only, or have another tag, or
    none of these.
    """
    page = pages.filter("page_id is not null").select("page_id", "url", "html")
    n = F.col("page_id")
    tag = F.concat(F.lit('"'), F.md5("html"), F.lit('"'))
    changed = F.concat(F.lit("day "), (n % 28).cast("string"))
    stored = F.create_map(
        F.lit("ETag"),
        F.when(n % 3 == 0, F.concat(F.lit("W/"), tag)).otherwise(tag),
        F.lit("Last-Modified"),
        changed,
        F.lit("Content-Type"),
        F.lit("text/html"),
        F.lit("Cache-Control"),
        F.lit("max-age=60"),
    )
    response = page.select(
        (n * 2).alias("record_id"),
        "url",
        (n * 60).alias("ts"),
        F.lit("response").alias("type"),
        stored.alias("headers"),
        F.col("html").alias("payload"),
    )
    common = F.create_map(
        F.lit("Date"),
        (n * 60).cast("string"),
        F.lit("Content-Type"),
        F.lit("text/plain"),
        F.lit("Cache-Control"),
        F.lit("no-cache"),
    )
    proof = (
        F.when(n % 7 == 0, F.create_map().cast("map<string,string>"))
        .when(n % 4 == 0, F.create_map(F.lit("ETag"), tag))
        .when(n % 4 == 1, F.create_map(F.lit("etag"), F.concat(F.lit("W/"), tag)))
        .when(n % 4 == 2, F.create_map(F.lit("Last-Modified"), changed))
        .otherwise(F.create_map(F.lit("ETag"), F.lit('"other"')))
    )
    revisit = page.select(
        (n * 2 + 1).alias("record_id"),
        "url",
        F.when(n % 11 == 0, n * 60 - 1).otherwise(n * 60 + 86400 * (1 + n % 5)).alias("ts"),
        F.lit("revisit").alias("type"),
        F.map_concat(common, proof).alias("headers"),
        F.lit(None).cast("string").alias("payload"),
    )
    return response.union(revisit)


def preference_messages(conversations: DataFrame) -> DataFrame:
    """Pairs of chosen and rejected conversations.

    Conversations 2k and 2k + 1 make pair k.  The even one is chosen; rejected is
    the same up to its last assistant turn, where the odd one's last assistant
    message stands instead.
    """
    held = conversations.filter("conv_id is not null").select("conv_id", "turn", "role", "text")
    last = held.groupBy("conv_id").agg(
        F.max(F.when(F.col("role") == "assistant", F.col("turn"))).alias("last"),
        F.max("turn").alias("top"),
    )
    told = held.join(last, "conv_id").withColumn("pair_id", F.floor(F.col("conv_id") / 2))
    even = told.filter(F.pmod("conv_id", F.lit(2)) == 0)
    odd = told.filter(F.pmod("conv_id", F.lit(2)) == 1)
    columns = ["pair_id", "side", "turn", "role", "text"]
    chosen = even.withColumn("side", F.lit("chosen")).select(columns)
    kept = (
        even.filter("last is null or turn is null or turn < last")
        .withColumn("side", F.lit("rejected"))
        .select(columns)
    )
    place = last.filter(F.pmod("conv_id", F.lit(2)) == 0).select(
        F.floor(F.col("conv_id") / 2).alias("pair_id"),
        F.coalesce("last", F.col("top") + 1).alias("place"),
    )
    other = (
        odd.filter("role = 'assistant' and turn = last")
        .join(place, "pair_id")
        .select("pair_id", F.lit("rejected").alias("side"), F.col("place").alias("turn"), "role", "text")
    )
    return chosen.union(kept).union(other)


def damaged_messages(conversations: DataFrame) -> DataFrame:
    """Conversations with faults, chosen by a checksum of ``conv_id:turn``.

    Of twenty values 0 drops the row, 1 empties its text, 2 removes the marks that
    end sentences, 3 repeats the row and 4 makes it the user's.  Nulls are one space,
    in the checksum as well as for role and text.
    """
    space = F.lit(" ")
    key = F.concat_ws(
        ":", *[F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")]
    )
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", space).alias("role"),
        F.coalesce("text", space).alias("text"),
        (F.crc32(key) % 20).alias("damage"),
    )
    damage = F.col("damage")
    return rows.filter(damage != 0).select(
        "conv_id",
        "turn",
        F.when(damage == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(damage == 1, "")
        .when(damage == 2, F.translate("text", ".!?", ""))
        .otherwise(F.col("text"))
        .alias("text"),
        F.explode(F.when(damage == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))),
    ).drop("col")


def periodic_documents(docs: DataFrame) -> DataFrame:
    """``doc_id`` and text of documents, the last words of every tenth one periodic.

    The checksum h of an id chooses it if h % 10 is 0.  With g = h div 10, the words
    from a = g % n on repeat the original ones from a to a + p, where p is one more
    than (n - a) div (3 + g % 8).  Rows without an id, and texts without words, stay.
    """
    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    mark = F.crc32(F.col("doc_id").cast("string"))
    chosen = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "text",
        mark.alias("h"),
        F.when(mark % 10 == 0, words).alias("words"),
    )
    numbered = chosen.select(
        "doc_id", "text", "words", F.size("words").alias("n"), F.floor(F.col("h") / 10).alias("g")
    )
    placed = numbered.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    share = F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))
    told = placed.withColumn("p", 1 + share)
    place = F.sequence(F.lit(0).cast("long"), F.col("n") - F.lit(1).cast("long"))

    def original(i):
        at = F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p"))
        return F.get("words", at.cast("int"))

    text = F.array_join(F.transform(place, original), " ")
    return told.select("doc_id", F.when(F.col("n") > 0, text).otherwise(F.col("text")).alias("text"))

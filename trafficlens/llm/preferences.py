"""Chosen and rejected conversations as one prompt and two masked completions.

The common prefix of a pair ends at the first turn whose messages differ between
the sides.  It is found by counting equal messages, so no conversation is
gathered for it.  The prefix is rendered once as the prompt; what follows on
either side is a completion, with the character spans to train on: the text of
assistant messages with its end mark, not their headers nor other roles.

A pair is one training record: only for the final row are its messages gathered,
in order of (turn, role, text).  Native throughout.

Rows without ``pair_id`` or with a side other than chosen or rejected belong to no
pair.  A null turn comes first, a null role is ``unknown``, null text is empty;
messages repeated on one side are repeated there.  If one side has no message the
prompt is empty and that completion null; equal sides are all prompt, and both
completions are empty.  Other columns are dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

_MESSAGE = ("turn", "role", "text")


def rendered(role: Column, text: Column) -> Column:
    return F.concat(F.lit("<|"), role, F.lit("|>\n"), text, F.lit("<|end|>\n"))


def segments(messages: DataFrame) -> DataFrame:
    """Per message its ``part`` (prompt, chosen or rejected), its place and rendering.

    ``messages`` has ``pair_id``, ``side``, ``turn``, ``role`` and ``text``.  A row
    stands for ``copies`` equal messages.
    """
    held = messages.filter(
        F.col("pair_id").isNotNull() & F.col("side").isin("chosen", "rejected")
    ).select(
        "pair_id",
        "side",
        "turn",
        F.coalesce("role", F.lit("unknown")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    counted = held.groupBy("pair_id", *_MESSAGE).agg(
        F.count_if(F.col("side") == "chosen").alias("chosen"),
        F.count_if(F.col("side") == "rejected").alias("rejected"),
    )
    # A null turn comes first and is told apart from an absent difference.
    at = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    ends = counted.groupBy("pair_id").agg(
        F.min(F.when(F.col("chosen") != F.col("rejected"), at)).alias("split"),
        F.sum("chosen").alias("n_chosen"),
        F.sum("rejected").alias("n_rejected"),
    )
    joined = counted.join(ends, "pair_id").withColumn(
        "shared",
        (F.col("n_chosen") > 0)
        & (F.col("n_rejected") > 0)
        & (F.col("split").isNull() | (at < F.col("split"))),
    )
    parts = F.when(
        F.col("shared"),
        F.array(F.struct(F.lit("prompt").alias("part"), F.col("chosen").alias("copies"))),
    ).otherwise(
        F.array(
            F.struct(F.lit("chosen").alias("part"), F.col("chosen").alias("copies")),
            F.struct(F.lit("rejected").alias("part"), F.col("rejected").alias("copies")),
        )
    )
    return (
        joined.withColumn("p", F.explode(parts))
        .filter("p.copies > 0")
        .select(
            "pair_id",
            F.col("p.part").alias("part"),
            F.col("p.copies").alias("copies"),
            *_MESSAGE,
            rendered(F.col("role"), F.col("text")).alias("rendered"),
            (F.col("n_chosen") > 0).alias("has_chosen"),
            (F.col("n_rejected") > 0).alias("has_rejected"),
        )
    )


def _one(part: str) -> tuple[Column, Column]:
    """Text of a part and its spans to train on, from its messages in order."""
    mine = F.array_sort(F.collect_list(F.when(F.col("part") == part, F.col("piece"))))
    text = F.array_join(F.transform(mine, lambda x: x["rendered"]), "")
    spans = F.filter(F.transform(mine, lambda x: x["span"]), lambda s: s.isNotNull())
    return text, spans


def format_pairs(messages: DataFrame) -> DataFrame:
    """Per pair ``prompt``, ``chosen``, ``rejected``, ``prompt_messages`` and, as arrays of
    (start, end) in characters, ``chosen_train`` and ``rejected_train``."""
    order = W.partitionBy("pair_id", "part").orderBy(*_MESSAGE)
    single = segments(messages).withColumn(
        "copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))
    )
    size = F.char_length("rendered")
    ends = F.sum(size).over(order.rowsBetween(W.unboundedPreceding, W.currentRow))
    placed = single.withColumn("end", ends).withColumn("start", F.col("end") - size)
    head = F.char_length(F.concat(F.lit("<|"), F.col("role"), F.lit("|>\n")))
    span = F.when(
        F.col("role") == "assistant",
        F.struct((F.col("start") + head).alias("start"), (F.col("end") - 1).alias("end")),
    )
    piece = F.struct("start", "end", "rendered", span.alias("span"))
    prompt, _ = _one("prompt")
    chosen, chosen_spans = _one("chosen")
    rejected, rejected_spans = _one("rejected")
    return (
        placed.withColumn("piece", piece)
        .groupBy("pair_id")
        .agg(
            prompt.alias("prompt"),
            F.when(F.bool_or("has_chosen"), chosen).alias("chosen"),
            F.when(F.bool_or("has_rejected"), rejected).alias("rejected"),
            F.count_if(F.col("part") == "prompt").alias("prompt_messages"),
            chosen_spans.alias("chosen_train"),
            rejected_spans.alias("rejected_train"),
        )
    )

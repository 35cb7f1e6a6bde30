"""Not-modified revisits of a web archive resolved to earlier full responses.

A revisit record says that a page had not changed.  It is resolved to the latest
earlier full response of the same canonical url, an as-of join, if the validators
agree: the entity tags by weak comparison if both records have one, else the
dates of last modification if both have one.  Without a common validator the
match stands but is ``unverified``.  The result takes the stored response's
payload and headers; of the revisit's headers the ``PERMITTED`` ones replace them.

As-of join without a window over all captures of a url: time is cut in buckets,
the last response before a record is looked up within (url, bucket), and what
came before the bucket is carried over from a summary per (url, bucket).  A url
captured any number of times is thus spread over its buckets, and only their
summaries, bounded by the time span, are put in order.  Payloads take no part
until the match is known.

Earlier means a smaller (time, ``record_id``).  Records without a url, time or id
take no part as responses; such revisits have the outcome ``no_response``.  Null
headers are none; repeated records give repeated rows; a header map's names are
taken in lower case, the first of equal names counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Headers that a not-modified response updates.
PERMITTED = (
    "cache-control",
    "content-location",
    "date",
    "etag",
    "expires",
    "last-modified",
    "vary",
)
BUCKET_SECONDS = 3600

_SCHEME = r"^([A-Za-z][A-Za-z0-9+.-]*)://"


def canonical_url(url: Column) -> Column:
    """Scheme and host in lower case, no default port, no fragment, no empty path."""
    whole = F.substring_index(url, "#", 1)
    scheme = F.lower(F.regexp_extract(whole, _SCHEME, 1))
    rest = F.regexp_replace(whole, _SCHEME, "")
    host = F.lower(F.regexp_extract(rest, r"^([^/?]*)", 1))
    port = F.when(scheme == "http", F.regexp_replace(host, ":80$", "")).when(
        scheme == "https", F.regexp_replace(host, ":443$", "")
    )
    tail = F.regexp_replace(rest, r"^[^/?]*", "")
    path = F.when(F.startswith(tail, F.lit("/")), tail).otherwise(F.concat(F.lit("/"), tail))
    return F.when(scheme == "", whole).otherwise(
        F.concat(scheme, F.lit("://"), F.coalesce(port, host), path)
    )


def _lowered(headers: Column) -> Column:
    """Header map with lower-case names; of equal names the first."""
    entries = F.transform(
        F.map_entries(headers),
        lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")),
    )
    names = F.transform(entries, lambda e: e["key"])
    first = F.filter(entries, lambda e, i: F.array_position(names, e["key"]) == i + 1)
    return F.coalesce(F.map_from_entries(first), F.create_map().cast("map<string,string>"))


def earlier_responses(records: DataFrame, bucket_seconds: int = BUCKET_SECONDS) -> DataFrame:
    """``record_id`` of revisits and ``source_id`` of the latest earlier response, if any.

    ``records`` has ``record_id``, ``canonical``, ``ts`` (seconds) and ``type``.
    """
    timed = records.filter(
        F.col("record_id").isNotNull() & F.col("canonical").isNotNull() & F.col("ts").isNotNull()
    ).select(
        "record_id",
        "canonical",
        "ts",
        F.floor(F.col("ts") / bucket_seconds).alias("bucket"),
        (F.col("type") == "response").alias("full"),
    )
    mark = F.when(F.col("full"), F.struct("ts", "record_id"))
    within = W.partitionBy("canonical", "bucket").orderBy("ts", "record_id")
    near = timed.withColumn(
        "near",
        F.last(mark, ignorenulls=True).over(within.rowsBetween(W.unboundedPreceding, -1)),
    ).filter(~F.col("full"))
    summary = timed.groupBy("canonical", "bucket").agg(F.max(mark).alias("newest"))
    before = W.partitionBy("canonical").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    carried = summary.select(
        "canonical", "bucket", F.last("newest", ignorenulls=True).over(before).alias("carried")
    )
    return near.join(carried, ["canonical", "bucket"]).select(
        "record_id", F.coalesce("near", "carried")["record_id"].alias("source_id")
    )


def _weak(tag: Column) -> Column:
    return F.regexp_replace(tag, "^W/", "")


def resolve(records: DataFrame, bucket_seconds: int = BUCKET_SECONDS) -> DataFrame:
    """Per revisit ``record_id``, ``canonical_url``, ``source_id``, ``outcome``,
    merged ``headers`` and ``payload``.

    ``records`` has ``record_id``, ``url``, ``ts`` (seconds), ``type`` (response or
    revisit), ``headers`` (map) and ``payload``.  Outcomes: ``resolved``,
    ``unverified``, ``mismatch`` (own headers, no payload), ``no_response``.
    """
    named = records.select(
        F.col("record_id").cast("long"),
        canonical_url(F.col("url")).alias("canonical"),
        F.col("ts").cast("long").alias("ts"),
        "type",
        _lowered(F.col("headers")).alias("headers"),
        "payload",
    )
    pairs = earlier_responses(named.drop("headers", "payload"), bucket_seconds).distinct()
    stored = (
        named.filter((F.col("type") == "response") & F.col("record_id").isNotNull())
        .dropDuplicates(["record_id"])
        .select(
            F.col("record_id").alias("source_id"),
            F.col("headers").alias("kept"),
            F.col("payload").alias("body"),
        )
    )
    revisits = named.filter(F.col("type") == "revisit").drop("payload")
    both = revisits.join(pairs, "record_id", "left").join(stored, "source_id", "left")
    tags = _weak(F.col("headers")["etag"]) == _weak(F.col("kept")["etag"])
    dates = F.col("headers")["last-modified"] == F.col("kept")["last-modified"]
    agree = F.coalesce(tags, dates)
    outcome = (
        F.when(F.col("source_id").isNull(), "no_response")
        .when(agree, "resolved")
        .when(agree.isNull(), "unverified")
        .otherwise("mismatch")
    )
    good = F.col("outcome").isin("resolved", "unverified")
    update = F.map_filter("headers", lambda k, v: k.isin(*PERMITTED))
    stays = F.map_filter("kept", lambda k, v: ~F.map_contains_key(update, k))
    return both.withColumn("outcome", outcome).select(
        "record_id",
        F.col("canonical").alias("canonical_url"),
        "source_id",
        "outcome",
        F.when(good, F.map_concat(stays, update)).otherwise(F.col("headers")).alias("headers"),
        F.when(good, F.col("body")).alias("payload"),
    )

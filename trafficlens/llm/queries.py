"""The registered queries of this subpackage and their oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trafficlens.llm import (
    conversation_repair,
    decontaminate,
    embeddings,
    language,
    packing,
    periodic_runs,
    personal_data,
    preferences,
    quality,
    revisits,
    samples,
    simhash,
    suffix_dedup,
    url_filter,
)
from trafficlens.session import staged


def vocabulary() -> str:
    """The byte-level vocabulary file, a path that every executor has."""
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json"))


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Host, path and verdict.
URL_RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every url judged by the rules, or by the path templates they teach."""
    return url_filter.judge(_table(spark, sf_dir, "pages"), URL_RULES)


def op2_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every revisit of the archive made of all pages, resolved."""
    records = samples.archive_records(_table(spark, sf_dir, "pages"))
    lines = F.transform(
        F.array_sort(F.map_entries("headers")), lambda e: F.concat(e["key"], F.lit(": "), e["value"])
    )
    return revisits.resolve(records).select(
        "record_id",
        "canonical_url",
        "source_id",
        "outcome",
        F.array_join(lines, "\n").alias("headers"),
        F.sha2("payload", 256).alias("payload_sha256"),
    )


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quality score for every document, learned on two of three folds."""
    fold = language.held_out(F.col("doc_id"), 3, 1)
    labels = _table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    scored = quality.score(_table(spark, sf_dir, "documents"), labels, ~fold)
    return scored.select(
        "doc_id",
        fold.alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near duplicates among all vectors at a cosine of 0.9."""
    return embeddings.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of documents that repeat a 50-byte string of a smaller document."""
    found = suffix_dedup.remove_repeats(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


def op6_preference_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every pair of conversations as a prompt and two masked completions."""
    messages = samples.preference_messages(_table(spark, sf_dir, "conversations"))

    def spans(name: str):
        return F.array_join(
            F.transform(name, lambda s: F.concat_ws("-", s["start"], s["end"])), ","
        ).alias(name)

    return preferences.format_pairs(messages).select(
        "pair_id",
        "prompt",
        "chosen",
        "rejected",
        "prompt_messages",
        spans("chosen_train"),
        spans("rejected_train"),
    )


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 1024 tokens."""
    return packing.pack(_table(spark, sf_dir, "documents"), vocabulary())


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents that hold a benchmark item, also reworded."""
    return decontaminate.contaminated(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    )


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near copies among all documents: three-word shingles, two bits."""
    return simhash.near_copies(_table(spark, sf_dir, "documents"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned on three of four folds."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    fold = language.held_out(F.col("doc_id"), 4, 2)
    model = language.fit(docs, ~fold)
    return language.identify(docs, model).select(
        "doc_id", fold.alias("held_out"), "lang_pred", "score"
    )


def op11_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document: base spans counted and digested, and all spans."""
    found = personal_data.redact(_table(spark, sf_dir, "documents"))
    counts = [personal_data.number(F.col("base"), kind).alias(f"n_{kind}") for kind in personal_data.KINDS]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(personal_data.written(F.col("base")), 256).alias("base_sha256"),
        personal_data.written(F.col("spans")).alias("spans"),
    )


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit and checksum of every conversation, damaged and repaired."""
    conversations = _table(spark, sf_dir, "conversations")
    messages = samples.damaged_messages(conversations)
    audits = staged(conversation_repair.audit(messages), "audits")
    sums = conversation_repair.digests(conversation_repair.repair(messages, audits))
    # Every conversation has one row of each kind at most; nulls are a key here.
    ids = conversations.select(F.col("conv_id").cast("long").alias("conv_id"))
    parts = ids.unionByName(audits, allowMissingColumns=True).unionByName(
        sums, allowMissingColumns=True
    )
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return parts.groupBy("conv_id").agg(
        *[F.coalesce(F.max(c), F.lit(0).cast("long")).alias(c) for c in counts],
        F.coalesce(F.max("audit"), F.lit("")).alias("audit"),
        F.coalesce(F.max("sha256"), F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words in every document, some of them made periodic."""
    docs = samples.periodic_documents(_table(spark, sf_dir, "documents"))
    found = periodic_runs.collapse_runs(docs)
    best = F.array_max(
        F.transform(
            "runs",
            lambda r: F.struct(
                r["length"].alias("length"), (-r["start"]).alias("back"), (-r["period"]).alias("less")
            ),
        )
    )
    lines = F.transform(
        "runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    )
    told = found.select("doc_id", "runs", "collapsed", best.alias("best"))
    length, period = F.col("best.length"), -F.col("best.less")
    return told.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.back")).alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.floor(length * 1000 / period).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_url_filters": op1_url_filters,
    "op2_warc_revisits": op2_warc_revisits,
    "op3_quality": op3_quality,
    "op4_embedding_dedup": op4_embedding_dedup,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_preference_format": op6_preference_format,
    "op7_best_fit_packing": op7_best_fit_packing,
    "op8_decontamination": op8_decontamination,
    "op9_simhash": op9_simhash,
    "op10_language_id": op10_language_id,
    "op11_personal_data": op11_personal_data,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_periodic_runs": op13_periodic_runs,
}

ORACLE_SQL: dict[str, str] = {
    "op2_warc_revisits": r"""
WITH page AS (
    SELECT page_id AS n, html,
        split_part(url, '#', 1) AS whole,
        '"' || md5(html) || '"' AS tag,
        'day ' || (page_id % 28) AS changed
    FROM pages WHERE page_id IS NOT NULL
), parts AS (
    SELECT *,
        lower(regexp_extract(whole, '^([A-Za-z][A-Za-z0-9+.-]*)://', 1)) AS scheme,
        regexp_replace(whole, '^([A-Za-z][A-Za-z0-9+.-]*)://', '') AS rest
    FROM page
), hosts AS (
    SELECT *,
        lower(regexp_extract(rest, '^([^/?]*)', 1)) AS host,
        regexp_replace(rest, '^[^/?]*', '') AS tail
    FROM parts
), named AS (
    SELECT *, CASE WHEN scheme = '' THEN whole ELSE scheme || '://'
        || CASE scheme WHEN 'http' THEN regexp_replace(host, ':80$', '')
            WHEN 'https' THEN regexp_replace(host, ':443$', '') ELSE host END
        || CASE WHEN starts_with(tail, '/') THEN tail ELSE '/' || tail END END AS canonical
    FROM hosts
), response AS (
    SELECT n * 2 AS source_id, canonical, n * 60 AS ts, tag AS kept_tag,
        CASE WHEN n % 3 = 0 THEN 'W/' || tag ELSE tag END AS kept_etag,
        changed AS kept_changed, html
    FROM named
), revisit AS (
    SELECT n * 2 + 1 AS record_id, canonical, n,
        CASE WHEN n % 11 = 0 THEN n * 60 - 1 ELSE n * 60 + 86400 * (1 + n % 5) END AS ts,
        CASE WHEN n % 7 = 0 THEN NULL WHEN n % 4 = 0 THEN tag WHEN n % 4 = 1 THEN 'W/' || tag
            WHEN n % 4 = 3 THEN '"other"' END AS etag,
        CASE WHEN n % 7 <> 0 AND n % 4 = 2 THEN changed END AS modified
    FROM named
), best AS (
    SELECT v.record_id, max(struct_pack(ts := r.ts, source_id := r.source_id)) AS hit
    FROM revisit v JOIN response r ON r.canonical = v.canonical
        AND (r.ts < v.ts OR (r.ts = v.ts AND r.source_id < v.record_id))
    GROUP BY 1
), judged AS (
    SELECT v.*, r.source_id, r.kept_etag, r.kept_changed, r.html,
        CASE WHEN r.source_id IS NULL THEN 'no_response'
            WHEN v.etag IS NOT NULL THEN CASE
                WHEN regexp_replace(v.etag, '^W/', '') = r.kept_tag THEN 'resolved'
                ELSE 'mismatch' END
            WHEN v.modified IS NOT NULL THEN CASE
                WHEN v.modified = r.kept_changed THEN 'resolved' ELSE 'mismatch' END
            ELSE 'unverified' END AS outcome
    FROM revisit v LEFT JOIN best b USING (record_id)
        LEFT JOIN response r ON r.source_id = b.hit.source_id
)
SELECT record_id, canonical AS canonical_url, source_id, outcome,
    CASE WHEN outcome IN ('resolved', 'unverified') THEN
        'cache-control: no-cache' || chr(10) || 'content-type: text/html' || chr(10)
        || 'date: ' || (n * 60) || chr(10) || 'etag: ' || coalesce(etag, kept_etag) || chr(10)
        || 'last-modified: ' || coalesce(modified, kept_changed)
    ELSE
        'cache-control: no-cache' || chr(10) || 'content-type: text/plain' || chr(10)
        || 'date: ' || (n * 60) || coalesce(chr(10) || 'etag: ' || etag, '')
        || coalesce(chr(10) || 'last-modified: ' || modified, '')
    END AS headers,
    CASE WHEN outcome IN ('resolved', 'unverified') THEN sha256(html) END AS payload_sha256
FROM judged
""",
    "op4_embedding_dedup": r"""
WITH RECURSIVE v AS (
    SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
), links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id
        AND list_dot_product(a.e, b.e)
            >= 0.9 * sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(b.e, b.e))
), reach AS (
    SELECT vec_id AS node, vec_id AS seen FROM v
    UNION
    SELECT r.node, l.b FROM reach r JOIN links l ON l.a = r.seen
)
SELECT v.vec_id,
    (SELECT count(*) FROM links WHERE a = v.vec_id) AS n_links,
    min(seen) AS component_id,
    min(seen) = v.vec_id AS kept
FROM v JOIN reach ON node = vec_id GROUP BY v.vec_id
""",
    "op6_preference_format": r"""
WITH ends AS (
    SELECT conv_id, max(turn) FILTER (role = 'assistant') AS last, max(turn) AS top
    FROM conversations WHERE conv_id IS NOT NULL GROUP BY 1
), told AS (
    SELECT c.*, e.last, e.top, c.conv_id // 2 AS pair_id
    FROM conversations c JOIN ends e USING (conv_id)
), messages AS (
    SELECT pair_id, 'chosen' AS side, turn, role, text FROM told WHERE conv_id % 2 = 0
    UNION ALL
    SELECT pair_id, 'rejected', turn, role, text FROM told
    WHERE conv_id % 2 = 0 AND (last IS NULL OR turn < last)
    UNION ALL
    SELECT o.pair_id, 'rejected', coalesce(e.last, e.top + 1), o.role, o.text
    FROM told o JOIN ends e ON e.conv_id = o.conv_id - 1
    WHERE o.conv_id % 2 = 1 AND o.role = 'assistant' AND o.turn = o.last
), numbered AS (
    SELECT *, row_number() OVER (PARTITION BY pair_id, side ORDER BY turn, role, text) AS place,
        count(*) OVER (PARTITION BY pair_id, side) AS size
    FROM messages
), compared AS (
    SELECT pair_id, coalesce(a.turn, b.turn) AS turn,
        a.role IS NOT DISTINCT FROM b.role AND a.text IS NOT DISTINCT FROM b.text
            AND a.turn IS NOT DISTINCT FROM b.turn AS same,
        least(a.turn, b.turn) AS lower_turn
    FROM (SELECT * FROM numbered WHERE side = 'chosen') a
    FULL JOIN (SELECT * FROM numbered WHERE side = 'rejected') b USING (pair_id, place)
), splits AS (
    SELECT pair_id, min(lower_turn) FILTER (NOT same) AS split FROM compared GROUP BY 1
), sides AS (
    SELECT pair_id, count(*) FILTER (side = 'chosen') AS nc, count(*) FILTER (side = 'rejected') AS nr
    FROM messages GROUP BY 1
), parted AS (
    SELECT n.*, CASE WHEN nc > 0 AND nr > 0 AND (split IS NULL OR turn < split)
            THEN 'prompt' ELSE side END AS part,
        '<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10) AS piece
    FROM numbered n JOIN splits USING (pair_id) JOIN sides USING (pair_id)
), kept AS (
    SELECT *, sum(length(piece)) OVER (PARTITION BY pair_id, part ORDER BY turn, role, text
        ROWS UNBOUNDED PRECEDING) AS stop
    FROM parted WHERE part <> 'prompt' OR side = 'chosen'
), spans AS (
    SELECT *, CASE WHEN role = 'assistant' THEN
        (stop - length(piece) + 14)::BIGINT || '-' || (stop - 1)::BIGINT END AS span FROM kept
)
SELECT pair_id,
    coalesce(string_agg(piece, '' ORDER BY stop) FILTER (part = 'prompt'), '') AS prompt,
    CASE WHEN any_value(nc) > 0 THEN
        coalesce(string_agg(piece, '' ORDER BY stop) FILTER (part = 'chosen'), '') END AS chosen,
    CASE WHEN any_value(nr) > 0 THEN
        coalesce(string_agg(piece, '' ORDER BY stop) FILTER (part = 'rejected'), '') END AS rejected,
    count(*) FILTER (part = 'prompt') AS prompt_messages,
    coalesce(string_agg(span, ',' ORDER BY stop) FILTER (part = 'chosen'), '') AS chosen_train,
    coalesce(string_agg(span, ',' ORDER BY stop) FILTER (part = 'rejected'), '') AS rejected_train
FROM spans JOIN sides USING (pair_id) GROUP BY pair_id
""",
    "op12_conversation_repair": r"""
WITH RECURSIVE keyed AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key
    FROM conversations
), checked AS (
    SELECT *, xor(list_reduce(
        list_prepend(4294967295::BIGINT, list_transform(split(key, ''), lambda c: ascii(c)::BIGINT)),
        lambda sum, byte: list_reduce(
            list_prepend(xor(sum, byte), [1, 2, 3, 4, 5, 6, 7, 8]::BIGINT[]),
            lambda x, k: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END::BIGINT)
        )
    ), 4294967295::BIGINT) % 20 AS damage
    FROM keyed
), damaged AS (
    SELECT conv_id, turn, CASE WHEN damage = 4 THEN 'user' ELSE role END AS role,
        CASE damage WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
    FROM (
        SELECT * FROM checked WHERE damage <> 0
        UNION ALL SELECT * FROM checked WHERE damage = 3
    )
), numbered AS (
    SELECT coalesce(conv_id, -9223372036854775808) AS conv, turn, role, text,
        row_number() OVER (PARTITION BY conv_id
            ORDER BY turn NULLS FIRST, role, sha256(text)) AS i,
        rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS shown
    FROM damaged
), told AS (
    SELECT *, CASE WHEN shown = '' THEN 'blank'
            WHEN row_number() OVER (PARTITION BY conv, role, text ORDER BY i) > 1 THEN 'duplicate'
            WHEN right(shown, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE 'sound' END AS fault,
        CASE left(role, 1) WHEN 's' THEN 1 WHEN 'u' THEN 2 WHEN 'a' THEN 3 ELSE 0 END AS place,
        left(lag(role) OVER (PARTITION BY conv ORDER BY i), 1) || left(role, 1) AS pair
    FROM numbered
), counted AS (
    SELECT conv, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
        count(*) FILTER (fault = 'blank') AS blank,
        count(*) FILTER (fault = 'duplicate') AS duplicate,
        count(*) FILTER (fault = 'truncated') AS truncated,
        count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal,
        max(i) AS n
    FROM told GROUP BY conv
), moves(q, to_q, name) AS (
    -- A role put after another: 0 at the start, 1 system, 2 user, 3 assistant.
    VALUES (0, 2, 'user'), (1, 2, 'user'), (2, 3, 'assistant'), (3, 2, 'user')
), gap(q, to_q, cost, edits, lines) AS (
    -- No, one or two insertions.
    SELECT q, q, 0, '', []::VARCHAR[] FROM moves
    UNION ALL SELECT q, to_q, 3, 'I', [name || ':'] FROM moves
    UNION ALL SELECT a.q, b.to_q, 6, 'II', [a.name || ':', b.name || ':']
    FROM moves a JOIN moves b ON b.q = a.to_q
), walk AS (
    SELECT conv, 0::BIGINT AS i, 0 AS q, 0 AS cost, '' AS audit, []::VARCHAR[] AS lines
    FROM counted
    UNION ALL
    SELECT conv, i, q, best.cost, best.audit, best.lines FROM (
        SELECT conv, i, q, min(struct_pack(cost := cost, audit := audit, lines := lines)) AS best
        FROM (
            SELECT w.conv, t.i, e.q, w.cost + g.cost + e.cost AS cost,
                w.audit || g.edits || e.edit AS audit, w.lines || g.lines || e.line AS lines
            FROM walk w JOIN told t ON t.conv = w.conv AND t.i = w.i + 1
            JOIN gap g ON g.q = w.q JOIN moves m ON m.q = g.to_q,
            LATERAL (
                SELECT 'D' AS edit, g.to_q AS q, 4 AS cost, []::VARCHAR[] AS line
                UNION ALL SELECT 'K', t.place, CASE fault WHEN 'truncated' THEN 3 ELSE 0 END,
                    [t.role || ':' || t.text]
                WHERE t.fault IN ('sound', 'truncated')
                    AND (t.place = m.to_q OR (t.place = 1 AND g.to_q = 0))
                UNION ALL SELECT 'R', m.to_q, CASE fault WHEN 'truncated' THEN 6 ELSE 3 END,
                    [m.name || ':' || t.text]
                WHERE t.fault IN ('sound', 'truncated')
            ) e
        ) GROUP BY conv, i, q
    )
), ended AS (
    SELECT w.conv, min(struct_pack(
        cost := w.cost + g.cost, audit := w.audit || g.edits, lines := w.lines || g.lines)) AS best
    FROM walk w JOIN counted c ON c.conv = w.conv AND c.n = w.i
    JOIN gap g ON g.q = w.q AND g.to_q IN (0, 3)
    GROUP BY w.conv
), ids AS (SELECT DISTINCT conv_id FROM conversations)
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank,
    coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
    coalesce(illegal, 0) AS illegal, coalesce(best.cost, 0)::BIGINT AS cost,
    coalesce(best.audit, '') AS audit,
    sha256(coalesce(array_to_string(best.lines, chr(10)), '')) AS repaired_sha256
FROM ids LEFT JOIN counted ON conv = coalesce(conv_id, -9223372036854775808)
LEFT JOIN ended USING (conv)
""",
}

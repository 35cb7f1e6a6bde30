"""Spans of personal data: strict patterns, and candidates judged by boosted trees.

Base spans match a strict pattern and its check (parts of an address, Luhn's sum,
number of digits); they always stay.  Looser generators, one per kind, propose
further spans in what the base spans leave; they may overlap each other.  Boosted
trees judge their format and context, and per kind a threshold calibrated to a
precision selects those added.

The trees learn without given labels.  Positive are base spans, and disguised copies
of them in the same surroundings ("at" and "dot" in words, other separators, no plus
sign).  Negative are proposals, which no strict pattern took, and copies of base spans
with digits changed so that their check fails.  Of two folds of documents one teaches
the trees and the other sets the thresholds; a kind that reaches the precision nowhere
gets no added spans.

Everything is a column expression on one row, so nothing is shuffled but the
examples.  Null text is empty and has no spans.  Rows that repeat an id, or have
none, each give one row.  Offsets are code points, ends exclusive.  Patterns are
possessive, so a text of any length takes linear time and no deep stack.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trafficlens.session import staged

# About so many examples teach the trees, taken by a hash.
TRAIN_ROWS = 40_000
TREES = 20
DEPTH = 4
# Precision that added spans of a kind must reach on the calibration fold, the
# examples it must rest on (as must each leaf of a tree, so that none learns a single
# proposal by heart), and the steps between thresholds.
PRECISION = 0.95
LEAST_EXAMPLES = 20
STEPS = 200
# Characters of context on each side, and elements summed in one go.
CONTEXT = 24
BLOCK = 512
MASK = "\x00"

KINDS = ("email", "ip", "card", "phone")

# The strict patterns.  No match can start within a run of the first
# class but at its first character or after the match before.
LOCAL = "[A-Za-z0-9._%+-]"
LABEL = "[A-Za-z0-9-]"
STRICT = {
    "email": rf"(?:\G|(?<!{LOCAL})){LOCAL}++@{LABEL}++(?:\.{LABEL}++)++",
    "ip": r"[0-9](?<![0-9]{2})[0-9]*+\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}

_AT = r"(?:\x20?[(\[{]\x20?(?:at|@)\x20?[)\]}]\x20?|\x20?@\x20?|\x20(?:at|AT)\x20)"
_DOT = r"(?:\x20?[(\[{]\x20?(?:dot|\.)\x20?[)\]}]\x20?|\.|\x20(?:dot|DOT)\x20)"
_GAP = r"[\x20 .,/_–-]"
LOOSE = {
    "email": rf"(?<!{LOCAL}){LOCAL}++{_AT}{LABEL}++(?:{_DOT}{LABEL}++)++",
    "ip": rf"[0-9](?<![0-9]{{2}})[0-9]{{0,2}}+(?:{_DOT}[0-9]{{1,3}}+){{3}}(?![0-9])",
    "card": rf"[0-9](?<![0-9]{{2}})(?:{_GAP}{{0,2}}+[0-9]){{11,18}}(?![0-9])",
    "phone": rf"(?<![0-9+])[(+]?[0-9](?:[()]{{0,2}}+{_GAP}{{0,2}}+[()]?[0-9]){{6,14}}(?![0-9])",
}

# Quick tests that a text without matches fails; they spare most texts the patterns.
_MANY_DIGITS = r"[0-9](?:[^0-9]{0,5}+[0-9]){6}"


def _may_hold(text: Column, kind: str, loose: bool) -> Column:
    if kind == "email":
        found = text.contains("@")
        if loose:
            for sign in (" at ", " AT ", "at)", "at]", "at}", "(at", "[at", "{at"):
                found = found | text.contains(sign)
        return found
    if kind == "phone" and not loose:
        return text.contains("+")
    return text.rlike(_MANY_DIGITS if kind != "ip" else "[0-9]")


# Words that stand before contacts, and before other numbers.
CONTACT = r"(?i)(mail|tel|phone|fon|call|fax|contact|kontakt|mobil|correo|courriel|card|visa|ip|host)"
CODE = r"(?i)(token|key|secret|hash|sha|version|id|isbn|[=\"'#$/])"

FEATURES = (
    "kind",
    "length",
    "digits",
    "letters",
    "signs",
    "sorts_of_signs",
    "groups",
    "longest_group",
    "luhn",
    "address_parts",
    "at_sign",
    "opening",
    "last_label",
    "before",
    "after",
    "contact_before",
    "code_before",
    "digits_before",
    "digits_after",
)


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(text: Column) -> Column:
    """Whether 12 to 19 digits, other characters left out, pass Luhn's check."""
    digits = _digits(text)

    def value(place: Column) -> Column:
        digit = F.substring(F.reverse(digits), place, F.lit(1)).cast("int")
        # Twice a digit, less nine if above nine.
        twice = F.when(digit < 5, digit * 2).otherwise(digit * 2 - 9)
        return F.when(place % 2 == 0, twice).otherwise(digit)

    places = F.sequence(F.lit(1), F.length(digits))
    total = F.aggregate(F.transform(places, value), F.lit(0), lambda s, x: s + x)
    return F.when(F.length(digits).between(12, 19), total % 10 == 0).otherwise(F.lit(False))


def address_parts(text: Column) -> Column:
    """Whether all groups of digits are at most 255, leading zeros apart."""
    part = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
    return text.rlike(f"^{part}(?:[^0-9]+{part})*$")


def _passes(kind: str, text: Column) -> Column:
    if kind == "ip":
        return address_parts(text)
    if kind == "card":
        return luhn(text)
    if kind == "phone":
        return F.length(_digits(text)).between(9, 15)
    return F.lit(True)


def _check(kind: str) -> Callable[[Column], Column]:
    return lambda text: _passes(kind, text)


def _holding(kind: str) -> Callable[[Column], Column]:
    return lambda span: _passes(kind, span["text"])


def _sums(array: Column, first: Column) -> Column:
    """For each element ``first`` and the elements before it."""
    start = F.struct(
        first.cast("long").alias("at"), F.array().cast("array<bigint>").alias("list")
    )
    return F.aggregate(
        array,
        start,
        lambda s, x: F.struct(
            (s["at"] + x).alias("at"), F.array_append(s["list"], s["at"]).alias("list")
        ),
        lambda s: s["list"],
    )


def sums_before(array: Column) -> Column:
    """For each number the sum of those before it, block by block: appending to an
    array copies it, so one block for all would take quadratic time.  The array is a
    plain column, as an expression would be computed again for each block."""
    last = F.floor((F.size(array) - 1) / BLOCK).cast("int")
    blocks = F.transform(
        F.sequence(F.lit(0), F.greatest(last, F.lit(0))),
        lambda b: F.slice(array, b * BLOCK + 1, BLOCK),
    )
    zero = F.lit(0).cast("long")
    totals = F.transform(blocks, lambda b: F.aggregate(b, zero, lambda s, x: s + x))
    return F.flatten(F.zip_with(blocks, _sums(totals, zero), _sums))


def _matched(rows: DataFrame, text: str, pattern: str, where: Column) -> DataFrame:
    """Adds ``found``, the matches of a pattern in a column, and the ``pieces`` between;
    texts that are not ``where`` count as empty."""
    pieces = F.split(F.when(where, F.col(text)).otherwise(""), pattern, -1)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    none = F.array().cast("array<string>")
    return rows.withColumn("pieces", pieces).withColumn(
        "found", F.when(F.size("pieces") > 1, found).otherwise(none)
    )


def _located(rows: DataFrame, text: str, pattern: str, where: Column, into: str) -> DataFrame:
    """Adds ``into``, the matches of a pattern in a column: array of structs ``start``,
    ``stop``, ``text``, ``left``, ``right``; further ``pieces`` between them and ``found``."""
    rows = _matched(rows, text, pattern, where)
    found = F.col("found")
    n = F.size(found)
    before, after = F.slice("pieces", F.lit(1), n), F.slice("pieces", F.lit(2), n)
    rows = rows.withColumn(
        "lengths",
        F.zip_with(before, found, lambda b, m: (F.length(b) + F.length(m)).cast("long")),
    )
    sides = F.zip_with(before, after, lambda b, a: F.struct(b.alias("before"), a.alias("after")))
    told = F.zip_with(
        sides,
        found,
        lambda s, m: F.struct(s["before"].alias("before"), m.alias("text"), s["after"].alias("after")),
    )

    def place(row: Column, at: Column) -> Column:
        start = at + F.length(row["before"])
        return F.struct(
            start.alias("start"),
            (start + F.length(row["text"])).alias("stop"),
            row["text"].alias("text"),
            F.right(row["before"], F.lit(CONTEXT)).alias("left"),
            F.left(row["after"], F.lit(CONTEXT)).alias("right"),
        )

    return rows.withColumn(into, F.zip_with(told, sums_before(F.col("lengths")), place)).drop("lengths")


def _span(start: Column, kind: Column, stop: Column, **more: Column) -> Column:
    named = {"start": start, "kind": kind, "stop": stop, **more}
    return F.struct(*[column.alias(name) for name, column in named.items()])


def masked(pieces: Column, found: Column, holds: Column) -> Column:
    """The text again, matches that hold replaced by as many mask characters."""
    n = F.size(found)
    covered = F.zip_with(
        found, holds, lambda m, h: F.when(h, F.repeat(F.lit(MASK), F.length(m))).otherwise(m)
    )
    joined = F.zip_with(F.slice(pieces, F.lit(1), n), covered, lambda b, m: F.concat(b, m))
    return F.concat(F.array_join(joined, ""), F.element_at(pieces, -1))


def _neighbour(char: Column) -> Column:
    """The sort of a neighbouring character as a number."""
    return (
        F.when(char == "", 0)
        .when(char.rlike(r"^\s"), 1)
        .when(char.rlike(r"^[0-9]"), 5)
        .when(char.rlike(r"^[\p{L}_]"), 4)
        .when(char.rlike(r"^[.,;:!?)]"), 2)
        .otherwise(3)
    )


def features(kind: Column, text: Column, left: Column, right: Column) -> Column:
    """The numbers of FEATURES as an array."""
    digits, signs = _digits(text), F.regexp_replace(text, "[0-9A-Za-z]", "")
    groups = F.filter(F.split(text, "[^0-9]+"), lambda g: g != "")
    found = (
        kind,
        F.length(text),
        F.length(digits),
        F.length(F.regexp_replace(text, r"[^A-Za-z]", "")),
        F.length(signs),
        F.size(F.array_distinct(F.split(signs, ""))),
        F.size(groups),
        F.coalesce(F.array_max(F.transform(groups, lambda g: F.length(g))), F.lit(0)),
        luhn(text).cast("int"),
        F.when(kind != 0, address_parts(text).cast("int")).otherwise(0),
        text.contains("@").cast("int"),
        F.when(text.startswith("+"), 3).when(text.startswith("00"), 2)
        .when(text.startswith("("), 1).otherwise(0),
        F.length(F.regexp_extract(text, "([A-Za-z]*)$", 1)),
        _neighbour(F.right(left, F.lit(1))),
        _neighbour(F.left(right, F.lit(1))),
        left.rlike(CONTACT).cast("int"),
        left.rlike(CODE).cast("int"),
        F.length(_digits(left)),
        F.length(_digits(right)),
    )
    return F.array(*[f.cast("double") for f in found])


def _disguised(kind: str, text: Column, way: Column) -> Column:
    """A base span as people write it to escape patterns; ``way`` is 0, 1 or 2."""
    if kind == "email":
        forms = [(" at ", " dot "), ("[at]", "[dot]"), (" (at) ", ".")]
        name, host = F.substring_index(text, "@", 1), F.substring_index(text, "@", -1)
        made = [F.concat(name, F.lit(a), F.replace(host, F.lit("."), F.lit(d))) for a, d in forms]
    elif kind == "ip":
        made = [F.replace(text, F.lit("."), F.lit(d)) for d in ("[.]", " dot ", "(.)")]
    elif kind == "card":
        fours = F.regexp_replace(_digits(text), "(.{4})(?=.)", "$1.")
        made = [F.replace(fours, F.lit("."), F.lit(d)) for d in (".", "/", "_")]
    else:
        rest = F.substring(text, 2, 1 << 30)
        made = [F.concat(F.lit("00"), rest), rest, F.regexp_replace(rest, "[ ()-]+", ".")]
    return F.when(way == 0, made[0]).when(way == 1, made[1]).otherwise(made[2])


def _spoilt(kind: str, text: Column) -> Column | None:
    """A base span that its check refuses, where the kind has one over digits."""
    if kind == "card":
        last = (F.right(text, F.lit(1)).cast("int") + 1) % 10
        return F.concat(F.regexp_replace(text, "[0-9]$", ""), last.cast("string"))
    if kind == "ip":
        return F.regexp_replace(text, r"^[0-9]+", "999")
    return None


def gather(docs: DataFrame) -> DataFrame:
    """Per row of documents ``doc_id``, ``base`` spans, ``proposed`` ones and ``examples``.

    Spans are structs of ``start``, ``kind`` (its place in KINDS) and ``stop``;
    proposed ones also have ``features``.  Examples are structs of ``label`` and
    ``features``.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    # Each kind looks at the whole text; what is found is masked in a copy.
    rows = rows.withColumn("rest", F.col("text"))
    for kind in KINDS:
        where = _may_hold(F.col("text"), kind, loose=False)
        rows = _located(rows, "text", STRICT[kind], where, "spans")
        rows = rows.withColumn(f"base_{kind}", F.filter("spans", _holding(kind)))
        rows = _matched(rows, "rest", STRICT[kind], F.size(f"base_{kind}") > 0)
        cover = masked(F.col("pieces"), F.col("found"), F.transform("found", _check(kind)))
        rows = rows.withColumn(
            "rest", F.when(F.size("found") > 0, cover).otherwise(F.col("rest"))
        ).drop("pieces", "found", "spans")
    for kind in KINDS:
        where = _may_hold(F.col("rest"), kind, loose=True)
        rows = _located(rows, "rest", LOOSE[kind], where, f"loose_{kind}").drop("pieces", "found")

    def spans(kind: str, at: int) -> Column:
        return F.transform(
            f"base_{kind}",
            lambda s: _span(s["start"], F.lit(at), s["stop"]),
        )

    def proposals(kind: str, at: int) -> Column:
        return F.transform(
            f"loose_{kind}",
            lambda s: _span(
                s["start"],
                F.lit(at),
                s["stop"],
                features=features(F.lit(at), s["text"], s["left"], s["right"]),
            ),
        )

    def taught(kind: str, at: int) -> Column:
        def example(s: Column, text: Column, label: float) -> Column:
            told = features(F.lit(at), text, s["left"], s["right"])
            return F.struct(F.lit(label).alias("label"), told.alias("features"))

        def examples(s: Column) -> Column:
            way = F.pmod(F.xxhash64(s["text"]), F.lit(3))
            made = [
                example(s, s["text"], 1.0),
                example(s, _disguised(kind, s["text"], way), 1.0),
            ]
            spoilt = _spoilt(kind, s["text"])
            if spoilt is not None:
                made.append(example(s, spoilt, 0.0))
            return F.array(*made)

        return F.flatten(F.transform(f"base_{kind}", examples))

    kinds = list(enumerate(KINDS))
    return rows.select(
        "doc_id",
        F.concat(*[spans(kind, at) for at, kind in kinds]).alias("base"),
        F.concat(*[proposals(kind, at) for at, kind in kinds]).alias("proposed"),
        F.concat(*[taught(kind, at) for at, kind in kinds]).alias("taught"),
    ).select(
        "doc_id",
        "base",
        "proposed",
        F.concat(
            "taught",
            F.transform(
                "proposed", lambda s: F.struct(F.lit(0.0).alias("label"), s["features"].alias("features"))
            ),
        ).alias("examples"),
    )


# A tree: a leaf's value, or (feature, bound, tree below or at it, tree above).
Tree = float | tuple


def parse_tree(printed: str) -> Tree:
    """A tree from its printed form."""
    lines = iter(line.strip() for line in printed.splitlines()[1:] if line.strip())

    def node() -> Tree:
        line = next(lines)
        leaf = re.match(r"Predict: ([-+.\dE]+)", line)
        if leaf:
            return float(leaf[1])
        step = re.match(r"If \(feature (\d+) <= ([-+.\dE]+)\)", line)
        below = node()
        next(lines)
        return int(step[1]), float(step[2]), below, node()

    return node()


def tree_column(tree: Tree, found: Column) -> Column:
    """The value of a tree for an array of features."""
    if isinstance(tree, float):
        return F.lit(tree)
    at, bound, below, above = tree
    return F.when(F.get(found, F.lit(at)) <= bound, tree_column(below, found)).otherwise(
        tree_column(above, found)
    )


@dataclass
class Model:
    trees: list[tuple[float, Tree]] = field(default_factory=list)
    # Least score of added spans, by kind; kinds without one get none.
    thresholds: dict[int, float] = field(default_factory=dict)

    def score(self, found: Column) -> Column:
        """Probability that a span with these features is personal data."""
        margin = F.lit(0.0)
        for weight, tree in self.trees:
            margin = margin + weight * tree_column(tree, found)
        return 1 / (1 + F.exp(-2 * margin))


def _thresholds(counts: list[tuple[int, int, int, int]], precision: float) -> dict[int, float]:
    """The lowest thresholds above one half at which the spans over them have that
    precision, from (kind, step, positive, all)."""
    at = {(kind, step): (positive, n) for kind, step, positive, n in counts}
    found: dict[int, float] = {}
    for kind in {c[0] for c in counts}:
        right = total = 0
        for step in range(STEPS, STEPS // 2, -1):
            positive, n = at.get((kind, step), (0, 0))
            right, total = right + positive, total + n
            if total >= LEAST_EXAMPLES and (right + 1) / (total + 2) >= precision:
                found[kind] = step / STEPS
    return found


def fit(gathered: DataFrame, train_rows: int = TRAIN_ROWS, precision: float = PRECISION) -> Model:
    """Trees from one fold of the examples of ``gathered``, thresholds from the other."""
    fold = F.pmod(F.xxhash64(F.lit("fold"), "doc_id"), F.lit(2))
    examples = gathered.select(
        "doc_id", fold.alias("fold"), F.explode("examples").alias("e")
    ).select("doc_id", "fold", "e.label", "e.features")
    seen = {
        r["label"]: r["n"]
        for r in examples.filter("fold = 0").groupBy("label").agg(F.count("*").alias("n")).collect()
    }
    if len(seen) < 2:
        return Model()
    step = max(1, round(sum(seen.values()) / train_rows))
    chosen = F.pmod(F.xxhash64(F.lit("train"), "doc_id", "features"), F.lit(step)) == 0
    sample = staged(examples.filter("fold = 0").filter(chosen), "examples")
    if sample.select("label").distinct().count() < 2:
        return Model()
    fitted = GBTClassifier(
        featuresCol="vector",
        labelCol="label",
        maxIter=TREES,
        maxDepth=DEPTH,
        minInstancesPerNode=LEAST_EXAMPLES,
        stepSize=0.3,
        seed=5,
    ).fit(sample.select("label", array_to_vector("features").alias("vector")))
    model = Model(
        [(w, parse_tree(t.toDebugString)) for w, t in zip(fitted.treeWeights, fitted.trees)]
    )
    counts = (
        examples.filter("fold = 1")
        .select(
            F.get("features", F.lit(0)).cast("int").alias("kind"),
            F.floor(model.score(F.col("features")) * STEPS).cast("int").alias("step"),
            "label",
        )
        .groupBy("kind", "step")
        .agg(F.sum("label").cast("long").alias("positive"), F.count("*").alias("n"))
        .collect()
    )
    model.thresholds = _thresholds([tuple(c) for c in counts], precision)
    return model


def _select(model: Model) -> Column:
    """Proposed spans over their kind's threshold; of two neighbours that overlap the
    better scored stays, of equal ones the first."""
    def scored(s: Column) -> Column:
        return _span(s["start"], s["kind"], s["stop"], score=model.score(s["features"]))

    def enough(s: Column) -> Column:
        found = F.lit(False)
        for kind, threshold in sorted(model.thresholds.items()):
            found = found | ((s["kind"] == kind) & (s["score"] >= threshold))
        return found

    return F.array_sort(F.filter(F.transform("proposed", scored), enough))


def find(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """Per row of documents ``doc_id``, ``base`` and ``added`` spans.

    Both are arrays of structs ``start``, ``kind``, ``stop``; added ones have a
    ``score``.  Without a model one is learned from these documents.
    """
    gathered = staged(gather(docs), "personal")
    model = model or fit(gathered)
    chosen = gathered.select("doc_id", "base", _select(model).alias("chosen"))
    none = F.array(F.lit(None).cast("struct<start:bigint,kind:int,stop:bigint,score:double>"))
    n = F.size("chosen")
    sides = F.zip_with(
        F.slice(F.concat(none, "chosen"), F.lit(1), n),
        F.slice(F.concat("chosen", none), F.lit(2), n),
        lambda last, after: F.struct(last.alias("last"), after.alias("after")),
    )

    def unbeaten(own: Column, side: Column) -> Column:
        last, after = side["last"], side["after"]
        beaten = (last["stop"] > own["start"]) & (last["score"] >= own["score"])
        outdone = (after["start"] < own["stop"]) & (after["score"] > own["score"])
        lost = F.coalesce(beaten, F.lit(False)) | F.coalesce(outdone, F.lit(False))
        return F.when(~lost, own)

    added = F.filter(F.zip_with("chosen", sides, unbeaten), lambda s: s.isNotNull())
    return chosen.select("doc_id", "base", added.alias("added"))


def written(spans: Column) -> Column:
    """Spans as kind:start:end by start, then kind, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(
            F.array_sort(spans),
            lambda s: F.concat_ws(
                ":", F.get(names, s["kind"]), s["start"].cast("string"), s["stop"].cast("string")
            ),
        ),
        ",",
    )


def number(spans: Column, kind: str) -> Column:
    """How many spans are of a kind."""
    at = KINDS.index(kind)
    return F.size(F.filter(spans, lambda s: s["kind"] == at)).cast("long")


def redact(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """The rows of :func:`find` with ``spans``, base and added ones together."""
    found = find(docs, model)
    plain = F.transform("added", lambda s: _span(s["start"], s["kind"], s["stop"]))
    return found.withColumn("spans", F.array_sort(F.concat("base", plain)))

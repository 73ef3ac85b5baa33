"""Document fingerprints as threshold-scaled sketches.

A sketch keeps every shingle hash below a fixed fraction of the hash range. Sketches of two
texts are samples of their shingle sets taken by the same rule: they merge by union, and the
share of one that the other holds estimates containment however unequal the texts are. The
fraction is 1/8; a text of few words has a sketch of a larger one (1/4, 1/2 or all), which its
words alone decide. Two sketches are compared at the smaller of their fractions: what the
finer one has beyond it is left out, so stored sketches suffice.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ticketlake.llm.text import lower_ascii, words_of

#: Halvings of the hash range at most; shingles up to which none is made; words in a shingle.
HALVINGS, SMALL, SHINGLE = 3, 64, 5
_LAST = (1 << 63) - 1
#: Ordered pieces per shuffle partition when documents are paired with their successors.
PIECES = 4


def _let(value: Column, body) -> Column:
    """Evaluates ``value`` once per row for all its uses in ``body``."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _limit(halvings: Column) -> Column:
    """The largest hash (non-negative 63-bit numbers) that a sketch keeps."""
    return F.when(halvings == 0, F.lit(_LAST)).when(halvings == 1, F.lit(_LAST >> 1)).when(
        halvings == 2, F.lit(_LAST >> 2)
    ).otherwise(F.lit(_LAST >> HALVINGS))


def sketch(text: Column, k: int = SHINGLE) -> Column:
    """(halvings, hashes): sorted distinct hashes below the text's fraction 1/2**halvings.

    Shingles are runs of k words, A-Z lower-cased, or the whole text if it has fewer. Null
    and wordless texts have no hashes; equal texts have equal sketches.
    """

    def shingles(w: Column) -> Column:
        runs = F.transform(
            F.sequence(F.lit(0), F.size(w) - k),
            lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(k)]),
        )
        whole = F.transform(F.array(F.lit(0)), lambda _: F.xxhash64(w))
        none = F.array().cast("array<bigint>")
        return F.when(F.size(w) >= k, runs).when(F.size(w) > 0, whole).otherwise(none)

    def sketched(found: Column) -> Column:
        n = F.size(found)
        halvings = F.lit(HALVINGS)
        for h in reversed(range(HALVINGS)):
            halvings = F.when(n <= SMALL << h, h).otherwise(halvings)
        return _let(
            halvings,
            lambda h: F.struct(
                h.alias("halvings"),
                F.array_sort(F.array_distinct(F.filter(found, lambda x: x <= _limit(h)))).alias("hashes"),
            ),
        )

    hashes = F.transform(words_of(lower_ascii(text)), lambda w: F.xxhash64(w))
    positive = F.transform(_let(hashes, shingles), lambda h: h.bitwiseAND(F.lit(_LAST)))
    return _let(positive, sketched)


def _at(a: Column, halvings: Column) -> Column:
    """Hashes of a sketch that a smaller fraction keeps too."""
    return F.filter(a["hashes"], lambda h: h <= _limit(halvings))


def merge(a: Column, b: Column) -> Column:
    """The sketch of both texts together, at the smaller of their fractions."""
    least = F.greatest(a["halvings"], b["halvings"])
    both = F.array_sort(F.array_union(_at(a, least), _at(b, least)))
    return F.struct(least.alias("halvings"), both.alias("hashes"))


def containment(a: Column, b: Column) -> Column:
    """Estimated share of the smaller text's shingles that the other has; 0 if a sketch has
    no hash at the fraction they are compared at."""

    def shared(pair: Column) -> Column:
        least = F.least(F.size(pair["a"]), F.size(pair["b"]))
        return F.when(least > 0, F.size(F.array_intersect(pair["a"], pair["b"])) / least).otherwise(0.0)

    halvings = F.greatest(a["halvings"], b["halvings"])
    return _let(F.struct(_at(a, halvings).alias("a"), _at(b, halvings).alias("b")), shared)


def likeness(a: Column, b: Column, equal: Column) -> Column:
    """Containment of the sketches a and b; 1 for equal texts."""
    return F.when(equal, 1.0).otherwise(containment(a, b))


def as_string(a: Column) -> Column:
    """The sketch as text: halvings, a colon, hashes in hexadecimal, in order, joined by
    commas; empty without hashes."""
    hashes = F.array_join(F.transform(a["hashes"], lambda h: F.lower(F.hex(h))), ",")
    return F.when(hashes == "", "").otherwise(F.concat(a["halvings"].cast("string"), F.lit(":"), hashes))


def _place(value: Column, cuts: list[int]) -> Column:
    """How many of the sorted cuts are at most ``value``: first among groups, then in one."""
    if not cuts:
        return F.lit(0)
    step = math.isqrt(len(cuts)) + 1
    groups = [cuts[i : i + step] for i in range(0, len(cuts), step)]
    heads = F.array(*[F.lit(g[0]) for g in groups])
    inner = F.array(*[F.array(*[F.lit(c) for c in g]) for g in groups])
    at_most = lambda b: b <= value
    return _let(
        F.size(F.filter(heads, at_most)),
        lambda g: F.when(g == 0, 0).otherwise(
            (g - 1) * step + F.size(F.filter(F.element_at(inner, F.greatest(g, F.lit(1))), at_most))
        ),
    )


def with_next(
    docs: DataFrame, columns: dict[str, str], pieces: int | None = None, derived: dict[str, Column] | None = None
) -> DataFrame:
    """Adds, for each ``columns`` entry, that column of the next row by ascending doc_id.

    ``derived`` columns are made after the rows were chosen and dealt, once per row. The last row's successor is the first; null ids come last; equal ids go by a hash of the
    text. Rows are dealt to ordered pieces by quantiles of doc_id. Each piece also gets a
    copy of the row that follows its last one, so that successors never cross pieces.
    """
    spark = docs.sparkSession
    ordered = docs.withColumn("_tie", F.xxhash64("text"))
    pieces = pieces or PIECES * int(spark.conf.get("spark.sql.shuffle.partitions"))
    marks = [i / pieces for i in range(1, pieces)]
    # Quantiles are doubles: one of the largest ids may round up beyond them.
    cuts = sorted({min(int(c), 2**63 - 1) for c in docs.approxQuantile("doc_id", marks, 0.1 / pieces)}) if marks else []
    place = F.when(F.col("doc_id").isNull(), F.lit(len(cuts) + 1)).otherwise(_place(F.col("doc_id"), cuts))
    dealt = ordered.withColumn("_piece", place)
    # The first row of each piece: found on narrow columns, then fetched.
    firsts = [
        (r["_piece"], r["f"]["doc_id"], r["f"]["_tie"])
        for r in dealt.groupBy("_piece").agg(F.min(F.struct("doc_id", "_tie")).alias("f")).orderBy("_piece").collect()
    ]
    derived = derived or {}
    if not firsts:
        ordered = ordered.withColumns(derived)
        return ordered.select(*docs.columns, *derived, *[F.col(c).alias(a) for c, a in columns.items()])
    # Row i of this small table (one per piece) precedes piece i's first row.
    before = [(firsts[i - 1][0], d, t, i == 0) for i, (_, d, t) in enumerate(firsts)]
    follow = spark.createDataFrame(before, "_to long, _d long, _t long, _wraps boolean")
    same = dealt["doc_id"].eqNullSafe(follow["_d"]) & (dealt["_tie"] == follow["_t"])
    guests = (
        dealt.join(F.broadcast(follow), same)
        .dropDuplicates(["_to"])
        .select(*docs.columns, "_tie", F.col("_to").alias("_piece"), F.lit(1).alias("_guest"))
    )
    union = dealt.withColumn("_guest", F.lit(0)).withColumn("_piece", F.col("_piece").cast("long")).unionByName(guests).withColumns(derived)
    window = Window.partitionBy("_piece").orderBy("_guest", F.col("doc_id").asc_nulls_last(), "_tie")
    led = union.select("*", *[F.lead(c).over(window).alias(a) for c, a in columns.items()])
    return led.filter("_guest = 0").select(*docs.columns, *derived, *columns.values())


def edited(text: Column, following: Column) -> Column:
    """The text with its last quarter (rounded down) replaced by the next text's beginning."""
    cut = F.floor(F.char_length(text) / 4).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.char_length(text) - cut), F.substring(following, F.lit(1), cut))


def fingerprints(docs: DataFrame) -> DataFrame:
    """Per row: its sketch, that of its edited text and how alike they and the next row's are.

    Columns doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next. A null text counts as empty; repeated rows are rows, null ids come last.
    """
    rows = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    following = {"text": "next_text", "sketch": "next_sketch"}
    paired = with_next(rows, following, derived={"sketch": sketch(F.col("text"))})
    paired = paired.withColumn("edited", edited(F.col("text"), F.col("next_text")))
    paired = paired.select(
        "doc_id", F.char_length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"), "sketch", "next_sketch",
        sketch(F.col("edited")).alias("edited_sketch"),
        (F.col("text") == F.col("edited")).alias("same"), (F.col("text") == F.col("next_text")).alias("same_next"),
    )
    return paired.select(
        "doc_id", "n_chars", "edited_sha256",
        as_string(F.col("sketch")).alias("fingerprint"),
        as_string(F.col("edited_sketch")).alias("edited_fingerprint"),
        likeness(F.col("sketch"), F.col("edited_sketch"), F.col("same")).alias("near_edited"),
        likeness(F.col("sketch"), F.col("next_sketch"), F.col("same_next")).alias("near_next"),
    )

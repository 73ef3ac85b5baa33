"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source starts with the same expected number of copies. Its fractional
part becomes 0 or 1 by pairing documents: words are moved from one to the other until one
of them is integral, in a random direction that keeps both expectations. The moved words
cancel, so a source misses its target by less than one document.

Pairs meet in small chunks first; each chunk leaves at most one fractional document, and
these residuals are chunked again, level by level, until one per source is left.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ticketlake.llm.text import each_copy, materialize, words_of

WEIGHTS, SHARE, MOST = (5, 2, 1), 1.5, 2
#: Documents in a chunk, on average.
CHUNK = 48
SEED = 11
_ITEM = "STRUCT<h: BIGINT, doc_id: BIGINT, text_hash: BIGINT, size: BIGINT, mass: DOUBLE>"
_DONE = "STRUCT<doc_id: BIGINT, text_hash: BIGINT, size: BIGINT, extra: INT>"


def sized(docs: DataFrame) -> DataFrame:
    """(doc_id, source, text_hash, size) per row; size counts words, 0 for null."""
    return docs.select(
        F.col("doc_id").cast("long"), "source", F.xxhash64("text").alias("text_hash"),
        F.size(words_of(F.col("text"))).cast("long").alias("size"),
    )


def targets(
    rows: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST
) -> DataFrame:
    """(source, source_size, target) per source, null among them.

    The sources in code point order, null last, weigh ``weights`` in turn and share
    ``share`` times all sizes by weight; a target stops at ``most`` times its source's size
    and the excess goes to the others. That is the level L with targets
    min(most * size, L * weight), found from running sums over the sources in the order in
    which they fill up.
    """
    sums = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))).cast("int")
    weighed = sums.withColumn("_w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn + 1))
    weighed = weighed.withColumn("_cap", F.lit(float(most)) * F.col("source_size"))
    fills = Window.orderBy(F.col("_cap") / F.col("_w"), F.col("source").asc_nulls_last())
    upto = fills.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    weighed = weighed.withColumns({
        "_capped": F.coalesce(F.sum("_cap").over(upto), F.lit(0.0)),
        "_used": F.coalesce(F.sum("_w").over(upto), F.lit(0.0)),
        "_goal": F.lit(float(share)) * F.sum("source_size").over(whole),
        "_sum_w": F.sum("_w").over(whole),
    })
    # The level if all sources before this one are full; right from the first that it does not fill.
    level = (F.col("_goal") - F.col("_capped")) / (F.col("_sum_w") - F.col("_used"))
    reached = F.when(level * F.col("_w") <= F.col("_cap"), F.struct(F.row_number().over(fills).alias("k"), level.alias("x")))
    weighed = weighed.withColumn("_level", reached).withColumn("_level", F.min("_level").over(whole)["x"])
    target = F.least(F.col("_cap"), F.coalesce(F.col("_level") * F.col("_w"), F.col("_cap")))
    return weighed.select("source", "source_size", target.alias("target"))


def _let(value: str, name: str, body: str) -> str:
    """SQL that evaluates ``value`` once and uses it by name in ``body``."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _item(of: str, mass: str) -> str:
    return f"named_struct('h', {of}.h, 'doc_id', {of}.doc_id, 'text_hash', {of}.text_hash, 'size', {of}.size, 'mass', {mass})"


def _done(of: str, extra: str) -> str:
    return f"named_struct('doc_id', {of}.doc_id, 'text_hash', {of}.text_hash, 'size', {of}.size, 'extra', {extra})"


def _pivot() -> str:
    """One step of the chain: the fractional document ``c`` meets the next one, ``b``.

    ``mass`` is size times fraction. Either ``u`` words move from b to c, until c is full
    or b empty, or ``v`` words from c to b; the odds v : u keep the expectations.
    """
    moved = _let(
        "named_struct('u', least(c.size - c.mass, b.mass), 'v', least(c.mass, b.size - b.mass),"
        f" 'r', shiftrightunsigned(xxhash64({SEED}, c.h, b.h), 11) / 9007199254740992.0D)",
        "m",
        _let(
            "IF(m.r * (m.u + m.v) < m.v,"
            " named_struct('c', IF(c.size - c.mass <= b.mass, CAST(c.size AS DOUBLE), c.mass + b.mass),"
            "  'b', IF(c.size - c.mass <= b.mass, b.mass - (c.size - c.mass), 0D)),"
            " named_struct('c', IF(c.mass <= b.size - b.mass, 0D, c.mass - (b.size - b.mass)),"
            "  'b', IF(c.mass <= b.size - b.mass, b.mass + c.mass, CAST(b.size AS DOUBLE))))",
            "n",
            "named_struct('carry',"
            f" CASE WHEN n.c > 0 AND n.c < c.size THEN {_item('c', 'n.c')}"
            f" WHEN n.b > 0 AND n.b < b.size THEN {_item('b', 'n.b')} END,"
            " 'done', concat(a.done,"
            f" IF(n.c > 0 AND n.c < c.size, array(), array({_done('c', 'CAST(n.c > 0 AS INT)')})),"
            f" IF(n.b > 0 AND n.b < b.size, array(), array({_done('b', 'CAST(n.b > 0 AS INT)')}))))",
        ),
    )
    first = f"named_struct('carry', {_item('b', 'b.mass')}, 'done', a.done)"
    step = _let("a.carry", "c", f"IF(c IS NULL, {first}, {moved})")
    zero = f"named_struct('carry', CAST(NULL AS {_ITEM}), 'done', CAST(array() AS ARRAY<{_DONE}>))"
    return f"aggregate(items, {zero}, (a, b) -> {step})"


def _chunk(h: Column, chunks: Column, level: int) -> Column:
    return F.pmod(F.xxhash64(h, F.lit(level)), chunks)


def _with_source(rows: DataFrame, per_source: DataFrame) -> DataFrame:
    """Rows with the columns of their source, null included."""
    named = per_source.withColumnRenamed("source", "_source")
    return rows.join(named, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")


def pivotal(rows: DataFrame, scratch=None) -> DataFrame:
    """Rounds (source, doc_id, text_hash, size, mass) with 0 < mass < size to 0 or ``extra`` 1.

    Rows that are alike are numbered, so that they do not meet in one chunk.
    """
    names = ("source", "doc_id", "text_hash", "size", "mass")
    alike = rows.groupBy(*names).agg(F.count("*").alias("_n"))
    left = each_copy(alike, "_n").select(*names, F.xxhash64("doc_id", "text_hash", "_copy").alias("h"))
    left = materialize(left, "fractions", scratch)
    sizes = left.groupBy("source").agg(F.ceil(F.count("*") / CHUNK).alias("_chunks"))
    sizes = materialize(sizes, "chunks", scratch)
    most = sizes.agg(F.max("_chunks")).first()[0] or 0
    decided, level = [], 0
    while most:
        dealt = _with_source(left, sizes)
        dealt = dealt.withColumn("_chunk", _chunk(F.col("h"), F.col("_chunks"), level))
        item = F.struct("h", "doc_id", "text_hash", "size", "mass")
        # Large documents first: what stays fractional tends to be small.
        order = F.struct(-F.col("size"), F.col("h"), item.alias("item"))
        folded = (
            dealt.groupBy("source", "_chunk")
            .agg(F.sort_array(F.collect_list(order)).alias("_sorted"))
            .withColumn("items", F.expr("transform(_sorted, s -> s.item)"))
            .select("source", F.expr(_pivot()).alias("f"))
            .select("source", "f.carry", "f.done")
        )
        folded = materialize(folded, f"pivot-{level}", scratch)
        decided.append(folded.select("source", F.explode("done").alias("d")).select("source", "d.*"))
        left = folded.filter("carry IS NOT NULL").select("source", "carry.*")
        if most == 1:
            break
        sizes = sizes.withColumn("_chunks", F.ceil(F.col("_chunks") / CHUNK))
        most, level = -(-most // CHUNK), level + 1
    if not decided:
        return rows.select("source", "doc_id", "text_hash", "size", F.lit(0).alias("extra"))
    # One document per source is left: it gets a copy with the odds of its fraction.
    r = F.shiftrightunsigned(F.xxhash64(F.lit(SEED), F.col("h")), 11) / F.lit(float(1 << 53))
    last = (r * F.col("size") < F.col("mass")).cast("int")
    out = left.select("source", "doc_id", "text_hash", "size", last.alias("extra"))
    for d in decided:
        out = out.unionByName(d)
    return out


def mix(docs: DataFrame, scratch=None, **shares) -> DataFrame:
    """(doc_id, source, text_hash, size, source_size, target, copies) per row of ``docs``.

    ``copies`` is how often the mix takes the document. Null texts and texts without words
    have size 0; they get the whole part of their source's share, which takes no words.
    Rows that are alike are rounded one by one. The choice depends on the rows alone.
    """
    rows = materialize(sized(docs), "sized", scratch)
    goals = materialize(targets(rows, **shares), "targets", scratch)
    p = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    shared = _with_source(rows, goals).withColumn("_p", p)
    # Rounding errors of the division do not make a whole share fractional.
    whole = F.floor(F.col("_p") + 1e-9)
    shared = shared.withColumns({"_whole": whole.cast("int"), "_part": F.greatest(F.col("_p") - whole, F.lit(0.0))})
    split = (F.col("_part") > 1e-9) & (F.col("size") > 0)
    parts = shared.filter(split).select(
        "source", "doc_id", "text_hash", "size", (F.col("_part") * F.col("size")).alias("mass")
    )
    extra = _with_source(pivotal(parts, scratch), goals)
    whole_of = F.floor(F.col("target") / F.col("source_size") + 1e-9).cast("int")
    columns = ("doc_id", "source", "text_hash", "size", "source_size", "target")
    rounded = extra.select(*columns, (whole_of + F.col("extra")).alias("copies"))
    return rounded.unionByName(shared.filter(~split).select(*columns, F.col("_whole").alias("copies")))


def take(docs: DataFrame, scratch=None, **shares) -> DataFrame:
    """The mix itself: rows of ``docs``, each as often as it is taken; none for 0 copies.

    A row of size 0 is kept as often as its share says. What rows alike in doc_id, source and
    text take together is dealt to them as evenly as whole copies allow, in the order of a
    hash of the whole row; each keeps its own other columns.
    """
    totals = (
        mix(docs, scratch, **shares)
        .groupBy(F.col("doc_id").alias("_d"), F.col("source").alias("_s"), F.col("text_hash").alias("_t"))
        .agg(F.sum("copies").cast("long").alias("_copies"), F.count("*").alias("_rows"))
        .filter("_copies > 0")
    )
    # The row travels as one value, so no name of its columns can clash.
    rows = docs.select(
        F.col("doc_id").alias("_i"), F.col("source").alias("_o"), F.xxhash64("text").alias("_h"),
        F.struct(*docs.columns).alias("row"),
    )
    rows = rows.groupBy("_i", "_o", "_h", "row").agg(F.count("*").alias("_same"))
    same = F.col("_i").eqNullSafe(F.col("_d")) & F.col("_o").eqNullSafe(F.col("_s")) & (F.col("_h") == F.col("_t"))
    met = rows.join(totals, same).select("row", "_i", "_o", "_h", "_same", "_copies", "_rows")
    # Only rows that differ in other columns alone have to be put in order.
    alone = met.filter("_rows = _same").select("row", F.col("_copies").alias("_n"))
    before = Window.partitionBy("_i", "_o", "_h").orderBy(F.xxhash64("row")).rowsBetween(Window.unboundedPreceding, -1)
    several = met.filter("_rows > _same").withColumn("_at", F.coalesce(F.sum("_same").over(before), F.lit(0)))
    more = F.col("_copies") % F.col("_rows")
    share = F.col("_same") * F.expr("_copies div _rows") + F.greatest(
        F.lit(0), F.least(F.col("_at") + F.col("_same"), more) - F.col("_at")
    )
    taken = each_copy(alone.unionByName(several.select("row", share.alias("_n"))), "_n", block=None)
    return taken.select(*[F.col("row")[c].alias(c) for c in docs.columns])

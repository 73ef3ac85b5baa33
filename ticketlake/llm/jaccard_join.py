"""N-gram Jaccard join by T-occurrence search.

Two texts link when their shingle sets overlap enough. For a text with n shingles, a partner
must occur on at least T of its n inverted lists. As in DivideSkip, the lists are divided:
the longest are skipped while the short ones are merged, and only candidates from there are
looked up in the long lists by binary search.

On the cluster this is three steps:

* Shingles get one global order, rare before frequent, from a sketch of fixed size that
  counts all of them. A text posts only the first n - T + 1 (the short lists); a partner
  must share one of those. The k-th of them counts only for partners up to some size, and a
  posting whose list has no partner for it is dropped.
* Each list first compares its members with one pivot, then those that it did not reach
  with another, so a list of N texts gives N - 1 candidates, not N * N. A pivot leaves its
  list when it has been compared. Candidates are checked in blocks around their pivot by
  DivideSkip over the block's own inverted lists.
* Texts that are connected by then need no further comparison. Lists that still hold texts
  of different components give all their pairs across components, which are checked too.
  So no link between different components is missed, and the components are exact.

Texts with equal sets are one member throughout.
"""

from __future__ import annotations

import heapq
import itertools
import math
from collections.abc import Callable, Iterator
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketlake.llm.text import BATCH_ROWS, materialize, runs, shingle_hashes

SHINGLE = 5
#: Cells of the frequency sketch, and the blocks it travels in.
CELL_BITS, CELL_BLOCKS = 20, 256
#: Tasks that add up the sketch's blocks.
CELL_TASKS = 32
#: A posting list expected to be longer than this is dealt to several tasks.
LIST_ROWS = 20_000
#: Rounds in which lists compare their members with one pivot only.
STARS = 2
#: Posting lists of more members keep them all, without looking for each one's partner.
WIDE_LIST = 64
#: Members and shingles of one block of candidates around a pivot.
BLOCK_MEMBERS, BLOCK_SHINGLES = 64, 1 << 20
#: Least cells of a set's parities.
PARITY_CELLS = 512


def required(n: int, m: int, percent: int) -> int:
    """Least overlap of sets of n and m elements with 100 * overlap >= percent * union."""
    return -(-percent * (n + m) // (100 + percent))


def reach(n: np.ndarray, ranks: np.ndarray, percent: int) -> np.ndarray:
    """Per rank in the rarity order of a set of n, the largest partner for which it counts.

    Sets that overlap by T share one of the first n - T + 1 of each (ranks from 0). T grows
    with the partner, so a rank counts as long as required(n, m) <= n - rank.
    """
    return (100 + percent) * (n - ranks) // percent - n


def set_id(hashes: np.ndarray) -> int:
    """Signed 64-bit name of a shingle set, from a hash of all its members."""
    return xxhash.xxh3_64_intdigest(hashes.tobytes()) - (1 << 63)


def parities(hashes: np.ndarray) -> bytes:
    """Whether each cell holds an odd number of the set's members, one bit per cell.

    The low bits of a hash are its cell. There are as many cells as members at least, rounded
    up to a power of two, so that long sets do not fill them all: a set's parities take a
    32nd of its hashes' bytes at most, or 64 bytes.
    """
    cells = max(PARITY_CELLS, 1 << (len(hashes) - 1).bit_length())
    odd = np.bincount((hashes & np.uint64(cells - 1)).astype(np.int64), minlength=cells) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def differing(a: bytes, b: bytes) -> int:
    """Cells in which two sets' parities differ.

    The set with more cells is folded to the other's: half the cells are the others' sums.
    """
    x, y = sorted((np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)), key=len)
    while len(y) > len(x):
        y = y[: len(y) // 2] ^ y[len(y) // 2 :]
    return int(np.bitwise_count(x ^ y).sum())


# T-occurrence search --------------------------------------------------------------------
def divide_skip(query: np.ndarray, members: list[np.ndarray], percent: int, mu: float = 0.01) -> list[int]:
    """Which members' sorted sets link with the sorted query set.

    The query's inverted lists over the members are divided into the longest L, with
    L = T / (mu * log2(longest) + 1), and the others. A heap merge of the others keeps the
    members on at least T - L of them; each of those is looked up in the long lists by
    binary search until its own required overlap is reached.
    """
    if not len(query) or not members:
        return []
    sizes = [len(m) for m in members]
    fitting = [i for i, m in enumerate(sizes) if 100 * min(m, len(query)) >= percent * max(m, len(query))]
    if not fitting:
        return []
    owner = np.concatenate([np.full(sizes[i], i) for i in fitting])
    values = np.concatenate([members[i] for i in fitting])
    at = np.searchsorted(query, values)
    at[at == len(query)] = 0
    hit = query[at] == values
    order = np.lexsort((owner[hit], at[hit]))
    rows, owners = at[hit][order], owner[hit][order]
    cuts = np.flatnonzero(np.diff(rows)) + 1
    lists = sorted((x.tolist() for x in np.split(owners, cuts) if len(x)), key=len)
    least = min(required(len(query), sizes[i], percent) for i in fitting)
    skip = min(least - 1, len(lists), int(least / (mu * math.log2(max(len(lists[-1]), 2)) + 1))) if lists else 0
    short, long = lists[: len(lists) - skip], lists[len(lists) - skip :]
    arrays = [np.array(x) for x in long]
    found = []
    for i, run in groupby(heapq.merge(*short)):
        count = sum(1 for _ in run)
        need = required(len(query), sizes[i], percent)
        if count < least - skip:
            continue
        for k, a in enumerate(arrays):
            if count >= need or count + len(arrays) - k < need:
                break
            p = a.searchsorted(i)
            count += int(p < len(a) and a[p] == i)
        if count >= need:
            found.append(i)
    return found


# Sets and their order -------------------------------------------------------------------
def _sets(k: int, bits: int):
    """Per row its set, and at the end of a task the sketch cells of its different sets."""
    width = (1 << bits) // CELL_BLOCKS

    def batch(ids, sizes, names, block, counts, cells) -> pa.RecordBatch:
        arrays = [ids, pa.array(sizes, pa.int64()), pa.array(names, pa.int64()), pa.array(block, pa.int32())]
        columns = ["doc_id", "n_shingles", "set_id", "block", "counts", "parities"]
        return pa.RecordBatch.from_arrays([*arrays, pa.array(counts, pa.binary()), pa.array(cells, pa.binary())], columns)

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros(1 << bits, np.uint32), set()
        for f in batches:
            names, sizes, cells = [], [], []
            for text in f.column("text"):
                h = shingle_hashes(text.as_py(), k)
                sizes.append(len(h))
                names.append(set_id(h) if len(h) else None)
                cells.append(parities(h) if len(h) else None)
                if len(h) and names[-1] not in seen:
                    if len(seen) > 500_000:
                        seen.clear()
                    seen.add(names[-1])
                    np.add.at(total, (h >> np.uint64(64 - bits)).astype(np.int64), 1)
            # Ids are passed on as they are: a number in a float would lose its last digits.
            none = [None] * f.num_rows
            yield batch(f.column("doc_id"), sizes, names, none, none, cells)
        for b in range(CELL_BLOCKS):
            part = total[b * width : (b + 1) * width]
            if part.any():
                yield batch(pa.nulls(1, pa.int64()), [None], [None], [b], [part.tobytes()], [None])

    return sets


def _add_cells(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    sums: dict[int, np.ndarray] = {}
    for f in frames:
        for b, raw in zip(f["block"], f["counts"], strict=True):
            part = np.frombuffer(raw, np.uint32).astype(np.uint64)
            sums[b] = sums[b] + part if b in sums else part
    yield pd.DataFrame({"block": list(sums), "counts": [s.tobytes() for s in sums.values()]})


def sets_and_cells(docs: DataFrame, k: int = SHINGLE, bits: int = CELL_BITS, scratch=None) -> tuple[DataFrame, np.ndarray]:
    """(doc_id, n_shingles, set_id, parities) per row, and the occurrences of all shingles of
    different sets, added up in 2**bits cells by hash: fixed size. One pass over the texts."""
    schema = "doc_id long, n_shingles long, set_id long, block int, counts binary, parities binary"
    rows = materialize(docs.select("doc_id", "text").mapInArrow(_sets(k, bits), schema), "members", scratch)
    parts = rows.filter("block IS NOT NULL").select("block", "counts")
    summed = parts.repartition(CELL_TASKS, "block").mapInPandas(_add_cells, "block int, counts binary")
    out = np.zeros(1 << bits, np.uint64)
    width = (1 << bits) // CELL_BLOCKS
    for row in summed.collect():
        out[row["block"] * width : (row["block"] + 1) * width] += np.frombuffer(row["counts"], np.uint64)
    return rows.filter("block IS NULL").select("doc_id", "n_shingles", "set_id", "parities"), out


def _sliced(work: Callable, schema: pa.Schema):
    """``work`` over frames of the texts of Arrow batches, some rows at a time.

    A whole batch as a data frame would hold all its texts a second time.
    """

    def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = (b.column("text").slice(i, BATCH_ROWS) for b in batches for i in range(0, b.num_rows, BATCH_ROWS))
        for f in work(pd.DataFrame({"text": pd.Series(c.to_pylist(), dtype=object)}) for c in columns):
            yield pa.RecordBatch.from_pandas(f, schema, preserve_index=False)

    return sliced


def _some(frames: Iterator[pd.DataFrame]) -> Iterator[list]:
    """Texts of frames, in runs of bounded size."""
    for f in frames:
        texts = f["text"].tolist()
        for start, stop in runs(texts):
            yield texts[start:stop]


_POSTING = pa.schema([("shingle", pa.int64()), ("rank", pa.int32()), ("n", pa.int32()), ("set_id", pa.int64()), ("salt", pa.int32())])


def _postings(k: int, percent: int, sketch, bits: int, salts: int):
    """The short lists of each set: its rarest n - T + 1 shingles."""

    def postings(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts, seen = sketch.value, set()
        limit = np.uint64(LIST_ROWS)
        # Some texts at a time: a batch's postings together would be many times its texts.
        for texts in _some(frames):
            hashes, names, sizes = [], [], []
            for text in texts:
                h = shingle_hashes(text, k)
                name = set_id(h) if len(h) else None
                if name is None or name in seen:
                    continue
                if len(seen) > 500_000:
                    seen.clear()
                seen.add(name)
                keep = len(h) - -(-percent * len(h) // 100) + 1
                order = np.lexsort((h, counts[(h >> np.uint64(64 - bits)).astype(np.int64)]))
                hashes.append(h[order[:keep]])
                names.append(name)
                sizes.append((keep, len(h)))
            if not hashes:
                continue
            h = np.concatenate(hashes)
            reps = [s for s, _ in sizes]
            sets = np.repeat(np.array(names, np.int64), reps)
            # Lists of frequent cells are dealt to several tasks by set, with salts from 1.
            parts = np.minimum(counts[(h >> np.uint64(64 - bits)).astype(np.int64)] // limit, salts).astype(np.int64) + 1
            # What differs from row to row stands together: so shuffled rows compress best.
            yield pd.DataFrame({
                "shingle": h.view(np.int64),
                "rank": np.concatenate([np.arange(s, dtype=np.int32) for s in reps]),
                "n": np.repeat(np.array([n for _, n in sizes], np.int32), reps),
                "set_id": sets,
                "salt": np.where(parts > 1, np.abs(sets >> 7) % parts + 1, 0).astype(np.int32),
            })

    return postings


def _partnered(starts: np.ndarray, n: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Which rows of whole lists have a partner there: each within the other's reach."""
    first = np.flatnonzero(starts)
    length = np.diff(np.append(first, len(starts)))
    place = np.arange(len(starts)) - np.repeat(first, length)
    found = np.repeat(length > WIDE_LIST, length)
    later = np.flatnonzero(~found & (place > 0))
    apart = 1
    while len(later):
        sooner = later - apart
        both = (n[later] <= most[sooner]) & (n[sooner] <= most[later])
        found[later[both]] = found[sooner[both]] = True
        apart += 1
        later = later[place[later] >= apart]
    return found


def _shared(percent: int):
    """Merges postings sorted by (shingle, salt, set): each set once, those without partner dropped.

    A dealt list's parts stay whole, as partners may be in other parts.
    """
    names = ("shingle", "salt", "set_id", "n", "rank")

    def shared(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None  # the last list, or the last row of a dealt one, waits for what follows
        for f in itertools.chain(frames, [None]):
            if f is None and held is None:
                return
            columns = [f[c].to_numpy() for c in names] if f is not None else [h[:0] for h in held]
            if held is not None:
                columns = [np.concatenate([h, c]) for h, c in zip(held, columns, strict=True)]
            if not len(columns[0]):
                continue
            s, t, i = columns[:3]
            fresh = np.append(True, (s[1:] != s[:-1]) | (t[1:] != t[:-1]) | (i[1:] != i[:-1]))
            columns = [c[fresh] for c in columns]
            s, t = columns[:2]
            starts = np.append(True, (s[1:] != s[:-1]) | (t[1:] != t[:-1]))
            cut = len(s)
            if f is not None:
                cut = int(np.flatnonzero(starts)[-1]) if t[-1] == 0 else len(s) - 1
            held = [c[cut:] for c in columns]
            s, t, i, n, ranks = (c[:cut] for c in columns)
            most = reach(n.astype(np.int64), ranks, percent)
            keep = (t > 0) | _partnered(starts[:cut], n, most)
            yield pd.DataFrame({"shingle": s[keep], "set_id": i[keep], "n": n[keep], "reach": most[keep].astype(np.int32)})

    return shared


def shared_postings(
    docs: DataFrame, sketch: np.ndarray, k: int = SHINGLE, percent: int = 75, bits: int = CELL_BITS
) -> DataFrame:
    """(shingle, set_id, n, reach) of the short lists, of members that have a partner there."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(sketch)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    work = _sliced(_postings(k, percent, shared, bits, tasks), _POSTING)
    rows = docs.select("text").mapInArrow(work, "shingle long, rank int, n int, set_id long, salt int")
    merged = rows.repartition("shingle", "salt").sortWithinPartitions("shingle", "salt", "set_id")
    return merged.mapInPandas(_shared(percent), "shingle long, set_id long, n int, reach int")


# Checking candidates --------------------------------------------------------------------
def _fitting(a: str, b: str, percent: int):
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def set_parities(members: DataFrame, wanted: DataFrame, scratch=None) -> DataFrame:
    """(set_id, m, text_of, parities) once per wanted set: m is its size, text_of a doc_id that has it."""
    once = members.groupBy("set_id").agg(
        F.max("n_shingles").alias("m"), F.min("doc_id").alias("text_of"), F.max("parities").alias("parities")
    )
    return materialize(once.join(wanted, "set_id", "left_semi"), "parities", scratch)


def _possible(percent: int):
    def possible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for f in batches:
            both = [a + b for a, b in zip(f["a_m"].to_pylist(), f["b_m"].to_pylist(), strict=True)]
            cells = zip(both, f["a_parities"], f["b_parities"], strict=True)
            keep = [(n - differing(x.as_buffer(), y.as_buffer())) * (100 + percent) >= 2 * percent * n for n, x, y in cells]
            yield f.select(["a", "b", "n"]).filter(pa.array(keep, pa.bool_()))

    return possible


def may_link(pairs: DataFrame, cells: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b, n) that parities do not rule out, before any set is moved.

    A cell of different parity holds a member that only one of the two sets has. So the
    overlap is at most half of what their sizes leave beside those cells, and no link is
    lost; what passes goes on to the exact check.
    """
    a, b = (cells.select(F.col("set_id").alias(x), *[F.col(c).alias(f"{x}_{c}") for c in ("m", "parities")]) for x in "ab")
    both = pairs.join(a, "a").join(b, "b").select("a", "b", "n", "a_m", "b_m", "a_parities", "b_parities")
    return both.mapInArrow(_possible(percent), pairs.select("a", "b", "n").schema)


def _shingled(k: int):
    def shingled(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for texts in _some(frames):
            sets = [h for h in (shingle_hashes(t, k) for t in texts) if len(h)]
            yield pd.DataFrame({"set_id": np.array([set_id(h) for h in sets], np.int64), "shingles": [h.tobytes() for h in sets]})

    return shingled


def set_table(docs: DataFrame, cells: DataFrame, wanted: DataFrame, k: int = SHINGLE, scratch=None) -> DataFrame:
    """(set_id, shingles) of the wanted sets, from one text each.

    The chosen ids are written first, so that the planner knows their size: below its
    broadcast bound no text is shuffled to be chosen, beyond it the join shuffles. Other texts
    under a chosen doc_id come along; joins on set_id leave them out.
    """
    chosen = cells.join(wanted, "set_id", "left_semi").select(F.col("text_of").alias("_d")).distinct()
    chosen = materialize(chosen, "chosen", scratch)
    texts = docs.join(chosen, docs["doc_id"].eqNullSafe(F.col("_d")), "left_semi")
    work = _sliced(_shingled(k), pa.schema([("set_id", pa.int64()), ("shingles", pa.binary())]))
    return texts.select("text").mapInArrow(work, "set_id long, shingles binary")


def _search(percent: int):
    def search(key: tuple, table: pa.Table) -> pa.Table:
        rows = dict(zip(zip(table["role"].to_pylist(), table["set_id"].to_pylist()), table["shingles"], strict=True))
        sets = {r: np.frombuffer(v.as_buffer(), np.uint64) for r, v in rows.items()}
        members = sorted(name for role, name in sets if role)
        a = key[0].as_py()
        hits = divide_skip(sets[0, a], [sets[1, m] for m in members], percent) if (0, a) in sets else []
        return pa.table({"a": pa.array([a] * len(hits), pa.int64()), "b": pa.array([members[i] for i in hits], pa.int64())})

    return search


def linked(pairs: DataFrame, sets: DataFrame, percent: int, scratch=None) -> DataFrame:
    """The pairs (a, b, n) that link; a is the query, n the size of b. The places that sets
    are sent to are written first, so that their size decides how they are joined."""
    blocks = pairs.groupBy("a").agg(F.count("*").alias("_c"), F.sum(F.col("n").cast("long")).alias("_n"))
    wide = F.greatest(F.ceil(F.col("_c") / BLOCK_MEMBERS), F.ceil(F.col("_n") / BLOCK_SHINGLES))
    blocks = blocks.select("a", wide.alias("_blocks"))
    dealt = pairs.join(blocks, "a").withColumn("block", F.pmod(F.xxhash64("b"), F.col("_blocks")))
    members = dealt.select("a", "block", F.col("b").alias("set_id"), F.lit(1).alias("role"))
    queries = dealt.select("a", "block", F.col("a").alias("set_id"), F.lit(0).alias("role")).distinct()
    places = materialize(queries.unionByName(members), "places", scratch)
    rows = sets.join(places, "set_id")
    return rows.groupBy("a", "block").applyInArrow(_search(percent), "a long, b long")


# Components -----------------------------------------------------------------------------
def _pairs(*pairs: tuple[str, str]):
    """Rows (u, v) from pairs of columns of each row, made in one pass over them."""
    return F.inline(F.array(*[F.struct(F.col(u).alias("u"), F.col(v).alias("v")) for u, v in pairs]))


def components(edges: DataFrame, scratch=None) -> DataFrame:
    """(set_id, component) of all ends of edges (a, b): the smallest id of each component.

    Alternates large and small stars until the edges stop changing; every star is written,
    so a lost executor costs a re-read, and the next one's plan starts from rows, not from
    copies of this one's. Hubs are only ever grouped for their minimum.
    """
    both = edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    current = materialize(both, "edges", scratch)

    def star(e: DataFrame, large: bool) -> DataFrame:
        ends = e.select(_pairs(("u", "v"), ("v", "u"))) if large else e
        least = ends.groupBy("u").agg(F.min("v").alias("_m")).withColumn("_m", F.least("_m", "u"))
        joined = ends.join(least, "u")
        moved = joined.filter("v > u").select(_pairs(("v", "_m"))) if large else joined.select(_pairs(("v", "_m"), ("u", "_m")))
        return materialize(moved.filter("u <> v").distinct(), "edges", scratch)

    def state(e: DataFrame):
        return e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    before = state(current)
    while True:
        current = star(star(current, True), False)
        after = state(current)
        if after == before:
            break
        before = after
    roots = current.select(F.col("v").alias("set_id"), F.col("v").alias("component"))
    return current.select(F.col("u").alias("set_id"), F.col("v").alias("component")).unionByName(roots).distinct()


def _labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    joined = rows.join(labels, "set_id", "left")
    return joined.withColumn("component", F.coalesce("component", "set_id"))


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("set_id")).distinct()


# The join -------------------------------------------------------------------------------
def _relabelled(rows: DataFrame, edges: DataFrame, scratch) -> DataFrame:
    """Rows of lists that still hold several components, with the components."""
    labels = materialize(components(edges, scratch), "components", scratch)
    placed = _labelled(rows.drop("component"), labels)
    placed = materialize(placed.select("shingle", "set_id", "n", "reach", "component"), "placed", scratch)
    mixed = placed.groupBy("shingle").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
    return placed.join(mixed.filter("lo <> hi").select("shingle"), "shingle", "left_semi")


def _around(rows: DataFrame, degrees: DataFrame) -> DataFrame:
    """The lists without their pivots, each row with its list's length and pivot (a, a_n, a_c).

    The pivot is the member that shares most of its short lists: among copies with edits of
    their own, the text they were made from. Lists without a set of ``degrees`` have none.
    """
    weighed = rows.join(degrees, "set_id", "left")
    best = F.max(F.struct("degree", "set_id", "n", "component"))
    lists = weighed.groupBy("shingle").agg(best.alias("p"), F.count("*").alias("members"))
    pivots = lists.select(
        "shingle", "members", *[F.when(F.col("p.degree").isNotNull(), F.col(f"p.{c}")).alias(x)
                                for c, x in (("set_id", "a"), ("n", "a_n"), ("component", "a_c"))]
    )
    return rows.join(pivots, "shingle").filter("a IS NULL OR set_id <> a")


def _star(around: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b, n) of each list's pivot with the members outside its component."""
    pairs = around.filter((F.col("component") != F.col("a_c")) & _fitting("n", "a_n", percent))
    return pairs.select("a", F.col("set_id").alias("b"), "n").distinct()


def links(
    docs: DataFrame, members: DataFrame, sketch: np.ndarray, k: int = SHINGLE, percent: int = 75, scratch=None
) -> DataFrame:
    """Edges (a, b) between set ids whose components are those of all linking sets."""
    shared = materialize(shared_postings(docs, sketch, k, percent), "postings", scratch)
    lists = F.count("*") / (F.first("n") - F.ceil(F.first("n") * percent / 100) + 1)
    degrees = materialize(shared.groupBy("set_id").agg(lists.alias("degree")), "degrees", scratch)
    rest = shared.withColumn("component", F.col("set_id"))
    cells = set_parities(members, degrees, scratch)
    edges = settled = None
    for _ in range(STARS):
        around = materialize(_around(rest, degrees), "around", scratch)
        star = materialize(_star(around, percent), "pairs", scratch)
        near = materialize(may_link(star, cells, percent), "near", scratch)
        found = materialize(linked(near, set_table(docs, cells, _ends(near), k, scratch), percent, scratch), "links", scratch)
        least, most = F.least("a", "b").alias("_x"), F.greatest("a", "b").alias("_y")
        settled = star.select(least, most) if settled is None else settled.unionByName(star.select(least, most))
        edges = found if edges is None else edges.unionByName(found)
        # What a pivot was compared with is settled: of two members no pair is left.
        left = around.filter("a IS NULL OR members > 2").select(rest.columns)
        rest = materialize(_relabelled(left, edges, scratch), "rest", scratch)
        # Next time each list's pivot comes from what the last pivots did not reach.
        degrees = degrees.join(star.select(F.col("a").alias("set_id")).distinct(), "set_id", "left_anti")

    # Lists that still hold several components: all their pairs across components.
    a, b = (rest.select(*[F.col(c).alias(f"{x}_{c}") for c in rest.columns]) for x in "ab")
    crossing = a.join(
        b,
        (a["a_shingle"] == b["b_shingle"]) & (a["a_component"] < b["b_component"])
        & (F.col("a_n") <= F.col("b_reach")) & (F.col("b_n") <= F.col("a_reach")),
    )
    pairs = crossing.select(F.col("a_set_id").alias("a"), F.col("b_set_id").alias("b"), F.col("b_n").alias("n")).distinct()
    pairs = pairs.withColumns({"_x": F.least("a", "b"), "_y": F.greatest("a", "b")})
    # Those that a pivot was compared with are settled.
    pairs = pairs.join(settled, ["_x", "_y"], "left_anti").select("a", "b", "n")
    pairs = materialize(may_link(pairs, cells, percent), "crossing", scratch)
    more = linked(pairs, set_table(docs, cells, _ends(pairs), k, scratch), percent, scratch)
    return edges.unionByName(more)


def jaccard_components(docs: DataFrame, k: int = SHINGLE, percent: int = 75, scratch=None) -> DataFrame:
    """(doc_id, n_shingles, set_id, component_id) per row of ``docs`` (doc_id, text).

    Rows link when 100 * overlap >= percent * union of their sets of k-word shingles;
    ``component_id`` is the smallest doc_id that links reach, the row's own included. Null
    and wordless texts have no shingles and link with nothing. Rows with a null doc_id take
    part as texts; their component is null if it has no other id.
    """
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    members, sketch = sets_and_cells(docs, k, scratch=scratch)
    known = members.filter("set_id IS NOT NULL")
    edges = materialize(links(docs, known, sketch, k, percent, scratch), "all-links", scratch)
    labels = components(edges, scratch)
    # Sets first, so that copies of one text are combined before they meet.
    firsts = known.groupBy("set_id").agg(F.min("doc_id").alias("_first"))
    named = materialize(_labelled(firsts, labels), "named", scratch)
    names = named.groupBy("component").agg(F.min("_first").alias("component_id"))
    by_set = named.join(names, "component").select("set_id", "component_id")
    joined = members.join(by_set, "set_id", "left")
    own = F.when(F.col("set_id").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return joined.select("doc_id", "n_shingles", "set_id", own.alias("component_id"))

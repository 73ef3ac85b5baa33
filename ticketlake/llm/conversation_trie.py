"""Shared beginnings of conversations, counted in double-array tries.

Every turn (role, text) is named by two 64-bit hashes, and a prefix by the exclusive or of
position-tagged turn hashes, so that a prefix has one name wherever it is met. Conversations
are cut into segments of ``SEGMENT`` turns; equal segments are one row with a count, so a
group of copies is no hot spot and a conversation of any length is many rows. Sorted by
prefix, the segments are dealt into ranges: prefix shards. A task packs one batch of its range
at a time into BASE and CHECK arrays over the batch's dense turn ids, follows every segment
through them and adds up counts per node. Nodes that lie inside one batch are finished there;
the few upper nodes that batches share (the paths of a batch's first and last segment, of
segments that go on, and segment roots) are merged globally, and their subtree sums are added
up by pointer doubling: as many rounds as the depth has bits.

Order of turns: by ``turn``, null first, then by the turn hashes; so repeated rows stay
repeated turns. Null role or text is empty. Rows without ``conv_id`` belong to no conversation
and are left out. Other columns are not read. No rows, no nodes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ticketlake.llm.text import materialize, words_of
from ticketlake.session import Scratch

#: Turns per segment; conversations of one family; turns a conversation may borrow.
SEGMENT, FAMILY, HEADS = 256, 20, 4
#: Places tried for a node's children before they go to the end of the arrays.
TRIES = 16
NO_ONE = hashlib.sha256(b"").hexdigest()
_NODES = (
    "k1 long, k2 long, p1 long, p2 long, depth long, n long, conv_id long, ends long, words long,"
    " shared boolean, parent_conv_id long, children long, leaves long, saved long"
)
_LAST = np.iinfo(np.int64).max


# Rebuilt conversations ------------------------------------------------------------------
def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def borrowed_turns(conv_id: Column) -> Column:
    """How many turns a conversation takes over from the head of its family."""
    return (F.crc32(conv_id.cast("string").cast("binary")) % HEADS).cast("long")


def rebuilt(conversations: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Turns of the rebuilt conversations (conv_id, n, pos, h1, h2, words), and all
    conversations (conv_id, n); n counts a conversation's rebuilt turns, pos starts at 1.

    Rows are numbered inside range partitions and shifted by the blocks before, so that one
    conversation with a third of all rows is numbered by many tasks.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn",
        F.xxhash64(role, text).alias("h1"), F.xxhash64(F.lit(1), text, role).alias("h2"),
        F.size(words_of(text)).cast("long").alias("words"),
    )
    order = ("conv_id", "turn", "h1", "h2")
    placed = materialize(
        turns.repartitionByRange(_partitions(turns), *order).sortWithinPartitions(*order)
        .withColumns({"part": F.spark_partition_id(), "seq": F.monotonically_increasing_id()}).drop("turn"),
        "turns", scratch,
    )
    blocks = placed.groupBy("conv_id", "part").agg(F.min("seq").alias("first"), F.count("*").alias("rows"))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    head = F.col("conv_id") - F.col("conv_id") % FAMILY
    convs = blocks.groupBy("conv_id").agg(F.sum("rows").alias("own"))
    convs = convs.withColumns({"head": head, "h": borrowed_turns(F.col("conv_id"))})
    heads = convs.filter(F.col("conv_id") == F.col("head")).select("head", F.col("own").alias("given"))
    convs = convs.join(heads, "head", "left").withColumn("take", F.least("h", F.coalesce("given", F.lit(0))))
    convs = convs.withColumn("n", F.col("take") + F.greatest(F.col("own") - F.col("h"), F.lit(0)))
    convs = materialize(convs.select("conv_id", "head", "h", "take", "n"), "conversations", scratch)
    shifts = blocks.withColumn("shift", F.coalesce(F.sum("rows").over(before), F.lit(0)) - F.col("first") + 1)
    located = placed.join(shifts.drop("first", "rows"), ["conv_id", "part"]).withColumn("place", F.col("seq") + F.col("shift"))
    turn = ("h1", "h2", "words")
    # At most HEADS turns of each head, met by at most FAMILY conversations.
    lent = located.filter((F.col("conv_id") % FAMILY == 0) & (F.col("place") < HEADS))
    lent = lent.select(F.col("conv_id").alias("head"), F.col("place").alias("pos"), *turn)
    taken = convs.join(lent, "head").filter("pos <= take").select("conv_id", "n", "pos", *turn)
    # The shifts of a conversation are one row per partition, joined with its own numbers first.
    own_shifts = shifts.drop("first", "rows").join(convs.select("conv_id", "h", "take", "n"), "conv_id")
    own = placed.join(own_shifts, ["conv_id", "part"]).withColumn("place", F.col("seq") + F.col("shift")).filter("place > h")
    own = own.select("conv_id", "n", (F.col("take") + F.col("place") - F.col("h")).alias("pos"), *turn)
    return own.unionByName(taken), convs.select("conv_id", "n")


def segments(turns: DataFrame, convs: DataFrame, scratch: Scratch) -> DataFrame:
    """(level, conv_id, s1, s2, e1, e2, last, turns): runs of at most ``SEGMENT`` turns with
    the names of the prefixes they start and end at."""
    tagged = turns.withColumns({
        "m1": F.xxhash64("pos", "h1", "h2"), "m2": F.xxhash64("h2", "pos", "h1"),
        "level": F.expr(f"(pos - 1) div {SEGMENT}"),
    })
    turn = F.struct("pos", "h1", "h2", "m1", "m2", "words")
    cut = tagged.groupBy("conv_id", "level").agg(
        F.max("n").alias("n"), F.array_sort(F.collect_list(turn)).alias("turns"),
        F.bit_xor("m1").alias("x1"), F.bit_xor("m2").alias("x2"),
    )
    cut = materialize(cut, "segments", scratch)
    zero = F.lit(0).cast("long")
    short = cut.filter(F.col("n") <= SEGMENT).withColumns({"s1": zero, "s2": zero})
    # Only long conversations need the names of earlier segments: one thin row per segment.
    long = cut.filter(F.col("n") > SEGMENT)
    before = Window.partitionBy("conv_id").orderBy("level").rowsBetween(Window.unboundedPreceding, -1)
    starts = long.select(
        "conv_id", "level", *[F.coalesce(F.bit_xor(f"x{i}").over(before), zero).alias(f"s{i}") for i in (1, 2)]
    )
    cut = short.unionByName(long.join(starts, ["conv_id", "level"]))
    cut = cut.select(
        "level", "conv_id", "s1", "s2", F.col("s1").bitwiseXOR(F.col("x1")).alias("e1"),
        F.col("s2").bitwiseXOR(F.col("x2")).alias("e2"),
        (F.col("level") == F.expr(f"(n - 1) div {SEGMENT}")).alias("last"), "turns",
    )
    none = F.array().cast(cut.schema["turns"].dataType)
    bare = convs.filter("n = 0").select(
        zero.alias("level"), "conv_id", *[zero.alias(c) for c in ("s1", "s2", "e1", "e2")],
        F.lit(True).alias("last"), none.alias("turns"),
    )
    return cut.unionByName(bare)


# Tries inside tasks ---------------------------------------------------------------------
class DoubleArray:
    """BASE and CHECK: the child of state s by label c is t = BASE[s] + c if CHECK[t] = s."""

    def __init__(self, size: int) -> None:
        self.base = np.zeros(size, np.int64)
        self.check = np.full(size, -1, np.int64)
        self.check[0] = 0  # the start state
        self.end, self.cursor = 1, 1

    def _reach(self, end: int) -> None:
        if end > len(self.check):
            more = max(end, 2 * len(self.check)) - len(self.check)
            self.base = np.concatenate([self.base, np.zeros(more, np.int64)])
            self.check = np.concatenate([self.check, np.full(more, -1, np.int64)])
        self.end = max(self.end, end)

    def _fit(self, labels: np.ndarray) -> int:
        """A base that puts all labels (ascending) on free places."""
        free = self.cursor + np.flatnonzero(self.check[self.cursor : self.end] < 0)[:TRIES]
        for t in free.tolist():
            places = t - labels[0] + labels
            inside = places[places < self.end]
            if (self.check[inside] < 0).all():
                return t - int(labels[0])
        return self.end - int(labels[0])

    def add(self, parents: np.ndarray, labels: np.ndarray) -> np.ndarray:
        """Places of new children; rows of one parent are adjacent, labels distinct there."""
        places = np.empty(len(parents), np.int64)
        starts = np.flatnonzero(np.r_[True, parents[1:] != parents[:-1]])
        sizes = np.diff(np.r_[starts, len(parents)])
        for start, size in zip(starts[sizes > 1].tolist(), sizes[sizes > 1].tolist(), strict=True):
            family = np.sort(labels[start : start + size])
            base = self._fit(family)
            self._reach(base + int(family[-1]) + 1)
            self.check[base + family] = parents[start]
            self.base[parents[start]] = base
            places[start : start + size] = base + labels[start : start + size]
        # A single child fits any free place.
        single = starts[sizes == 1]
        free = self.cursor + np.flatnonzero(self.check[self.cursor : self.end] < 0)[: len(single)]
        more = len(single) - len(free)
        free = np.r_[free, np.arange(self.end, self.end + more)]
        self._reach(self.end + more)
        self.check[free] = parents[single]
        self.base[parents[single]] = free - labels[single]
        places[single] = free
        if more > 0:
            self.cursor = self.end
        return places

    def step(self, states: np.ndarray, labels: np.ndarray) -> np.ndarray:
        """The children of states by labels, which must be there."""
        places = self.base[states] + labels
        if (self.check[places] != states).any():
            raise AssertionError("a segment left the trie")
        return places


def _dense(h1: np.ndarray, h2: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Ids 0, 1, ... of distinct turns, in the order of their first place in ``order``."""
    a, b = (np.unique(h, return_inverse=True)[1] for h in (h1, h2))
    _, first, ids = np.unique((a * (len(b) + 1) + b)[order], return_index=True, return_inverse=True)
    rank = np.empty(len(first), np.int64)
    rank[np.argsort(first)] = np.arange(len(first))
    out = np.empty(len(order), np.int64)
    out[order] = rank[ids]
    return out


def shard_nodes(level, s1, s2, n, ends, conv, sizes, h1, h2, m1, m2, words) -> dict[str, np.ndarray]:
    """Nodes of one batch of segments, sorted by level, start and turns.

    The turn arrays hold the segments' turns one after the other.
    """
    rows = len(level)
    offset = np.r_[0, np.cumsum(sizes)[:-1]].astype(np.int64)
    row = np.repeat(np.arange(rows), sizes)
    depth_of = np.arange(len(row)) - offset[row]
    ids = _dense(h1, h2, np.lexsort((row, depth_of)))

    # Pack: the roots first, then all children of one depth.
    trie = DoubleArray(len(row) + rows + 1)
    new = np.r_[True, (level[1:] != level[:-1]) | (s1[1:] != s1[:-1]) | (s2[1:] != s2[:-1])]
    root = np.cumsum(new) - 1
    roots = trie.add(np.zeros(root[-1] + 1, np.int64), np.arange(root[-1] + 1))
    state = roots[root]
    depths = int(sizes.max(initial=0))
    for d in range(depths):
        on = np.flatnonzero(sizes > d)
        parents, labels = state[on], ids[offset[on] + d]
        new = np.r_[True, (parents[1:] != parents[:-1]) | (labels[1:] != labels[:-1])]
        state[on] = trie.add(parents[new], labels[new])[np.cumsum(new) - 1]

    # Traverse: every segment from its root to its end.
    size = trie.end
    sums = {c: np.zeros(size, np.int64) for c in ("k1", "k2", "depth", "n", "ends", "words", "children", "leaves", "saved")}
    smallest, shared = np.full(size, _LAST), np.zeros(size, bool)
    goes_on = n > ends
    common = goes_on.copy()
    common[[0, -1]] = True
    state = trie.step(np.zeros(rows, np.int64), root)
    x1, x2 = s1.copy(), s2.copy()
    layers = [np.unique(state)]
    sums["k1"][state], sums["k2"][state], sums["depth"][state] = s1, s2, level * SEGMENT
    shared[state] = True
    true_root = level == 0
    np.add.at(sums["n"], state[true_root], n[true_root])
    np.minimum.at(smallest, state[true_root], conv[true_root])
    for d in range(depths):
        on = np.flatnonzero(sizes > d)
        at = offset[on] + d
        state[on] = t = trie.step(state[on], ids[at])
        x1[on] ^= m1[at]
        x2[on] ^= m2[at]
        sums["k1"][t], sums["k2"][t] = x1[on], x2[on]
        sums["depth"][t], sums["words"][t] = level[on] * SEGMENT + d + 1, words[at]
        np.add.at(sums["n"], t, n[on])
        np.minimum.at(smallest, t, conv[on])
        shared[t[common[on]]] = True
        layers.append(np.unique(t))
    np.add.at(sums["ends"], state, ends)

    # Add up from the deepest layer; what is shared waits for the global merge.
    parent = trie.check[:size]
    for layer in layers[:0:-1]:
        own = layer[~shared[layer]]
        up = parent[own]
        sums["leaves"][own] += sums["children"][own] == 0
        sums["saved"][own] += (sums["n"][own] - 1) * sums["words"][own]
        np.add.at(sums["children"], up, 1)
        np.add.at(sums["leaves"], up, sums["leaves"][own])
        np.add.at(sums["saved"], up, sums["saved"][own])

    nodes = np.concatenate(layers)
    is_root = np.zeros(size, bool)
    is_root[layers[0]] = True
    up = parent[nodes]
    out = {c: v[nodes] for c, v in sums.items()}
    out |= {
        "p1": np.ma.array(sums["k1"][up], mask=is_root[nodes]), "p2": np.ma.array(sums["k2"][up], mask=is_root[nodes]),
        "conv_id": np.ma.array(smallest[nodes], mask=smallest[nodes] == _LAST), "shared": shared[nodes],
        "parent_conv_id": np.ma.array(smallest[up], mask=shared[up] | is_root[nodes]),
    }
    return out


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in _NODES.split(", ")]
    for batch in batches:
        if not batch.num_rows:
            continue
        turns = batch.column("turns")
        flat = turns.flatten()
        number = lambda c: batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64)
        within = lambda c: pc.struct_field(flat, c).to_numpy(zero_copy_only=False).astype(np.int64)
        sizes = pc.list_value_length(turns).to_numpy(zero_copy_only=False).astype(np.int64)
        out = shard_nodes(
            *map(number, ("level", "s1", "s2", "n", "ends", "conv_id")), sizes,
            *map(within, ("h1", "h2", "m1", "m2", "words")),
        )
        columns = [
            pa.array(out[c].data, mask=np.ma.getmaskarray(out[c])) if isinstance(out[c], np.ma.MaskedArray) else pa.array(out[c])
            for c in names
        ]
        yield pa.RecordBatch.from_arrays(columns, names)


# Lists of ends --------------------------------------------------------------------------
def _joined(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Runs of conversations with one end, as pieces of text."""
    for f in frames:
        if len(f):
            run = (f[["e1", "e2"]] != f[["e1", "e2"]].shift()).any(axis=1).cumsum()
            f = f.assign(piece=f["conv_id"].astype(str))
            yield f.groupby(run, sort=False).agg(
                e1=("e1", "first"), e2=("e2", "first"), first=("conv_id", "first"), piece=("piece", ",".join)
            )


def _hashed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """SHA-256 of each end's pieces, which come in order; one running hash at a time."""
    now, running = None, None
    for f in frames:
        done = []
        for e1, e2, piece in zip(f["e1"], f["e2"], f["piece"], strict=True):
            if (e1, e2) == now:
                running.update(b"," + piece.encode())
                continue
            if now is not None:
                done.append((*now, running.hexdigest()))
            now, running = (e1, e2), hashlib.sha256(piece.encode())
        yield pd.DataFrame(done, columns=["k1", "k2", "sha"])
    if now is not None:
        yield pd.DataFrame([(*now, running.hexdigest())], columns=["k1", "k2", "sha"])


def end_hashes(cut: DataFrame) -> DataFrame:
    """(k1, k2, sha) per node where conversations end: the hash of their ids in order.

    A hash reads its text from start to end. The text is made in sorted pieces by many tasks;
    one task per end reads only the pieces, and keeps none.
    """
    order, parts = ("e1", "e2", "conv_id"), _partitions(cut)
    ended = cut.filter("last").select(*order)
    pieces = ended.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    pieces = pieces.mapInPandas(_joined, "e1 long, e2 long, first long, piece string")
    whole = pieces.repartition(parts, "e1", "e2").sortWithinPartitions("e1", "e2", "first")
    return whole.mapInPandas(_hashed, "k1 long, k2 long, sha string")


# Merge ----------------------------------------------------------------------------------
def _key(a: str, b: str) -> Column:
    return F.when(F.col(a).isNotNull(), F.struct(F.col(a).alias("k1"), F.col(b).alias("k2")))


def _subtree_sums(upper: DataFrame, scratch: Scratch) -> DataFrame:
    """(key, leaves, saved) summed over the shared nodes below each shared node.

    After k rounds a node holds the sums of all nodes less than 2**k below it, and points to
    the one 2**k above.
    """
    state = materialize(upper.select("key", F.col("parent").alias("jump"), "leaves", "saved"), "sums", scratch)
    deepest = upper.agg(F.max("depth")).first()[0] or 0
    for _ in range(int(deepest).bit_length()):
        below = state.filter(F.col("jump").isNotNull()).groupBy(F.col("jump").alias("key")).agg(
            F.sum("leaves").alias("_leaves"), F.sum("saved").alias("_saved")
        )
        further = state.select(F.col("key").alias("jump"), F.col("jump").alias("_jump"))
        state = state.join(below, "key", "left").join(further, "jump", "left").select(
            "key", F.col("_jump").alias("jump"),
            *[(F.col(c) + F.coalesce(F.col(f"_{c}"), F.lit(0))).alias(c) for c in ("leaves", "saved")],
        )
        state = materialize(state, "sums", scratch)
    return state.drop("jump")


def prefix_nodes(conversations: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """All nodes of the trie of rebuilt conversations, one row each.

    ``conv_id`` is the smallest member, ``n_convs`` counts members, ``n_children`` children,
    ``n_leaves`` childless nodes of the subtree, ``saved_tokens`` the subtree's words that
    need no second copy, ``ends_sha256`` names the conversations that end here.
    """
    scratch = scratch or Scratch()
    turns, convs = rebuilt(conversations, scratch)
    cut = segments(turns, convs, scratch)
    groups = cut.groupBy("level", "s1", "s2", "e1", "e2").agg(
        F.count("*").alias("n"), F.count_if("last").alias("ends"), F.min("conv_id").alias("conv_id"),
        F.any_value("turns").alias("turns"),
    )
    order = ("level", "s1", "s2", "turns")
    shards = groups.repartitionByRange(_partitions(groups), *order).sortWithinPartitions(*order)
    nodes = materialize(shards.mapInArrow(_shards, _NODES), "nodes", scratch)

    upper = nodes.filter("shared").groupBy(_key("k1", "k2").alias("key")).agg(
        F.max(_key("p1", "p2")).alias("parent"),
        *[F.sum(c).alias(c) for c in ("n", "ends", "children", "leaves", "saved")],
        *[F.max(c).alias(c) for c in ("depth", "words")], F.min("conv_id").alias("conv_id"),
    )
    upper = materialize(upper, "upper", scratch)
    kids = upper.groupBy(F.col("parent").alias("key")).agg(F.count("*").alias("_kids"))
    upper = upper.join(kids, "key", "left").withColumn("children", F.col("children") + F.coalesce("_kids", F.lit(0)))
    upper = upper.drop("_kids").withColumns({
        "leaves": F.col("leaves") + (F.col("children") == 0).cast("long"),
        "saved": F.col("saved") + (F.col("n") - 1) * F.col("words"),
    })
    upper = materialize(upper, "upper", scratch)
    merged = upper.drop("leaves", "saved").join(_subtree_sums(upper, scratch), "key")

    columns = ("key", "parent", "conv_id", "depth", "n", "ends", "children", "leaves", "saved", "parent_conv_id")
    inner = nodes.filter("NOT shared").withColumns({"key": _key("k1", "k2"), "parent": _key("p1", "p2")})
    merged = merged.withColumn("parent_conv_id", F.lit(None).cast("long"))
    every = inner.select(*columns).unionByName(merged.select(*columns))
    names = upper.select(F.col("key").alias("parent"), F.col("conv_id").alias("_parent_conv"))
    ended = end_hashes(cut).select(_key("k1", "k2").alias("key"), "sha")
    found = every.join(names, "parent", "left").join(ended, "key", "left")
    return found.select(
        "conv_id", "depth", F.coalesce("parent_conv_id", "_parent_conv").alias("parent_conv_id"),
        F.col("n").alias("n_convs"), F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"), F.coalesce("sha", F.lit(NO_ONE)).alias("ends_sha256"),
    )

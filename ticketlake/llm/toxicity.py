"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic texts are the positives; any text of the training folds, labelled or not,
may be drawn as unlabelled, whatever its label. A linear model over hashed word features is trained in
numpy on the risk

    prior * R(P, +) + max(0, R(U, -) - prior * R(P, -))

where the prior is the share of toxic texts among the labelled rows. When the bracket goes
negative the step climbs back along it instead, which keeps the model from learning the
positives hidden among the unlabelled texts as clean.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketlake.llm.text import WORD_CACHE, BoundedCache, materialize, per_text, take_sample

LETTERS = re.compile(r"[^\W\d_]+")
#: Hashed features; features of a word: itself and its beginnings of these lengths.
BITS, PREFIXES = 20, (5, 6, 7)
#: A feature that a text has once, twice, four or eight times is as many features.
LEVELS = (1, 2, 4, 8)
#: Bounds of the training sample, in texts.
MAX_POSITIVE, MAX_UNLABELLED = 3_000, 9_000
#: Standard errors by which a feature is over-represented among the positives, if it trains.
LEAST_EXCESS = 6.0


def _word_features(word: str) -> tuple[int, ...]:
    names = {word, *(f"<{word[:n]}" for n in PREFIXES if len(word) >= n)}
    return tuple(xxhash.xxh64_intdigest(n) & ((1 << BITS) - 1) & ~3 for n in sorted(names))


FEATURES = BoundedCache(_word_features, WORD_CACHE // 2)


def text_features(text: str | None) -> np.ndarray:
    """Sorted distinct feature ids of a whole text; the lowest bits hold the level."""
    counts: Counter = Counter()
    for word, n in Counter(LETTERS.findall((text or "").lower())).items():
        for f in FEATURES[word]:
            counts[f] += n
    if not counts:
        return np.empty(0, np.int32)
    ids = np.fromiter(counts.keys(), np.int32, len(counts))
    n = np.fromiter(counts.values(), np.int64, len(counts))
    return np.concatenate([ids[n >= least] + i for i, least in enumerate(LEVELS)])


@dataclass
class Model:
    """Weights of the features that training kept (all others are 0), and the bias."""

    ids: np.ndarray
    weights: np.ndarray
    bias: float
    prior: float

    def table(self) -> dict[int, float]:
        return dict(zip(self.ids.tolist(), self.weights.tolist(), strict=True))

    def score(self, features: np.ndarray) -> float:
        at = np.searchsorted(self.ids, features)
        at[at == len(self.ids)] = 0
        hit = self.ids[at] == features if len(self.ids) else np.zeros(0, bool)
        return _sigmoid(self.bias + float(self.weights[at[hit]].sum()) if len(features) else self.bias)


def _sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


def fit(
    positive: list[np.ndarray],
    unlabelled: list[np.ndarray],
    prior: float,
    steps: int = 400,
    rate: float = 0.5,
    ridge: float = 1e-5,
    least: float = LEAST_EXCESS,
    back: float = 0.1,
) -> Model:
    """Train on feature lists, with the features that are over-represented among the
    positives by at least ``least`` standard errors.

    Without positives or unlabelled texts the model is the prior alone.
    """
    if not positive or not unlabelled:
        p = float(np.clip(prior, 1e-6, 1 - 1e-6))
        return Model(np.empty(0, np.int32), np.empty(0), float(np.log(p / (1 - p))), prior)
    ids, seen = np.unique(np.concatenate(positive), return_counts=True)
    every, times = np.unique(np.concatenate([ids, *unlabelled]), return_counts=True)
    usual = (times[np.searchsorted(every, ids)] - 0.5) / (len(unlabelled) + 1)
    excess = (seen / len(positive) - usual) / np.sqrt(usual * (1 - usual).clip(1e-9) / len(positive))
    ids = ids[excess >= least]

    def columns(rows: list[np.ndarray]) -> list[np.ndarray]:
        out = []
        for r in rows:
            at = np.searchsorted(ids, r)
            at[at == len(ids)] = 0
            out.append(at[ids[at] == r] if len(ids) else at[:0])
        return out

    pos, unl = columns(positive), columns(unlabelled)
    w, b = np.zeros(len(ids)), float(np.log(prior / (1 - prior)))
    gw, gb = np.full(len(ids), 1e-8), 1e-8

    def flatten(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        return np.concatenate(rows), np.repeat(np.arange(len(rows)), [len(r) for r in rows])

    def margins(flat, owner, n: int) -> np.ndarray:
        return b + np.bincount(owner, w[flat], n)

    def slope(flat, owner, d) -> tuple[np.ndarray, float]:
        return np.bincount(flat, d[owner], len(ids)) / len(d), float(d.mean())

    # Few features are left, so each step takes the whole sample: a batch's own noise would
    # keep turning the sign of the bracket.
    fp, op = flatten(pos)
    fu, ou = flatten(unl)
    for _ in range(steps):
        mp, mu = margins(fp, op, len(pos)), margins(fu, ou, len(unl))
        sp, su = _sigmoid(mp), _sigmoid(mu)
        # Logistic loss: of a text as clean log(1 + e^m), as toxic log(1 + e^-m).
        clean = np.logaddexp(0, mu).mean() - prior * np.logaddexp(0, mp).mean()
        step, sb = slope(fu, ou, su)
        pp, pb = slope(fp, op, sp)
        step, sb = step - prior * pp, sb - prior * pb
        if clean >= 0:
            tp, tb = slope(fp, op, sp - 1)
            step, sb = step + prior * tp, sb + prior * tb
        else:
            step, sb = -back * step, -back * sb
        step = step + ridge * w
        gw += step * step
        gb += sb * sb
        w -= rate * step / np.sqrt(gw)
        b -= rate * sb / np.sqrt(gb)
    used = np.abs(w) > 1e-3
    return Model(ids[used].astype(np.int32), w[used], b, prior)


def _feature_rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for f in frames:
        f["features"] = [text_features(t) for t in f.pop("text")]
        yield f


def _candidates(rows: DataFrame, least: float) -> np.ndarray:
    """Sorted ids of the features of ``rows`` (role, features) that ``fit`` may choose, and hardly another.

    They are counted on the cluster, as the features of all texts would be much for the driver.
    """
    sizes = {r["role"]: r["count"] for r in rows.groupBy("role").count().collect()}
    if len(sizes) < 2:
        return np.empty(0, np.int32)
    each = rows.select("role", F.explode("features").alias("id"))
    counts = each.groupBy("id").agg(F.sum("role").alias("seen"), F.sum(1 - F.col("role")).alias("times"))
    usual = (F.col("times") + 0.5) / (sizes[0] + 1)
    error = F.sqrt(F.greatest(usual * (1 - usual), F.lit(1e-9)) / sizes[1])
    # fit() decides; what is added here are its roundings.
    chosen = counts.filter("seen > 0").filter((F.col("seen") / sizes[1] - usual) / error >= least - 1e-6)
    return np.sort(np.array([r["id"] for r in chosen.select("id").collect()], np.int32))


def _kept(ids: np.ndarray):
    """Of each row's features those in ``ids``, in their order."""

    def kept(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            features = [np.asarray(x, np.int32) for x in f["features"]]
            f["features"] = [x[np.isin(x, ids)].tobytes() for x in features]
            yield f

    return kept


def train(
    docs: DataFrame,
    labels: DataFrame,
    usable,
    max_positive: int = MAX_POSITIVE,
    max_unlabelled: int = MAX_UNLABELLED,
) -> Model:
    """Fit from ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic) where ``usable`` holds.

    The sample is bounded by its two parameters and chosen by a hash of doc_id: positives from
    the labels, unlabelled texts from all of ``docs``. Rows with null ids or labels do not
    train. A document labelled more than once is toxic if any label says so; of rows that
    repeat an id, the smallest text trains.
    """
    known = (
        labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
        .filter(usable(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    share = known.agg(F.avg("toxic").alias("p")).first()["p"] or 0.0
    every = docs.select("doc_id").filter(F.col("doc_id").isNotNull()).filter(usable(F.col("doc_id"))).distinct()
    chosen = take_sample(known.filter("toxic = 1"), "doc_id", max_positive).select("doc_id", F.lit(1).alias("role"))
    chosen = chosen.unionByName(take_sample(every, "doc_id", max_unlabelled).withColumn("role", F.lit(0)))
    # Both roles of one text: two rows. At most the two bounds together: a safe broadcast.
    rows = (
        docs.select("doc_id", "text")
        .join(F.broadcast(chosen), "doc_id")
        .groupBy("doc_id", "role").agg(F.min("text").alias("text"))
        .mapInPandas(_feature_rows, "doc_id long, role int, features array<int>")
    )
    rows = materialize(rows, "features")
    # Only what fit() may choose goes to the driver, from every text.
    rows = rows.mapInPandas(_kept(_candidates(rows, LEAST_EXCESS)), "doc_id long, role int, features binary")
    sets: tuple[list, list] = ([], [])
    for row in sorted(rows.collect(), key=lambda r: (r["role"], r["doc_id"], bytes(r["features"]))):
        sets[row["role"]].append(np.frombuffer(row["features"], np.int32))
    prior = float(np.clip(share, 1e-4, 0.9))
    return fit(sets[1], sets[0], prior)


def _scorer(model: Model):
    """Scores of a batch of texts; made once per task."""
    weights, bias = model.table(), model.bias
    # Most words have no weighted feature: one look-up settles them, and their features are not kept.
    bases = {f & ~3 for f in weights}
    useful = BoundedCache(lambda w: not bases.isdisjoint(_word_features(w)), 4 * WORD_CACHE)

    def scores(texts) -> np.ndarray:
        margins = []
        for text in texts:
            counts: Counter = Counter()
            for word in filter(useful.__getitem__, LETTERS.findall((text or "").lower())):
                for x in FEATURES[word]:
                    counts[x] += 1
            m = bias
            for x, n in sorted(counts.items()):
                for i, least in enumerate(LEVELS):
                    if n >= least:
                        m += weights.get(x + i, 0.0)
            margins.append(m)
        return _sigmoid(np.array(margins, float))

    return scores


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) for every row of ``docs``: null and empty texts get the bias alone.

    Repeated rows are rows, null ids stay null.
    """
    columns = lambda texts, scores: {"score": pa.array(scores(texts), pa.float64())}
    return per_text(docs, "score double", columns, lambda: (_scorer(model),))


def clean(docs: DataFrame, model: Model, bound: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose score is below ``bound``, unchanged."""

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = _scorer(model)
        for b in batches:
            # One text after the other: a batch's texts together would be memory that stays taken.
            found = scores(t.as_py() for t in b.column("text"))
            yield b.filter(pa.array(found < bound))

    return docs.mapInArrow(kept, docs.schema)

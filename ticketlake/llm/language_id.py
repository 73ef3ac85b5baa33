"""Language identification: averaged hashed subword embeddings and a linear softmax.

A word's subwords are its character n-grams with end marks; each hashes to a row of an
embedding table. A text is the mean of its subwords' rows, and a softmax over learned
languages follows. Both tables are trained together by stochastic gradient descent in
numpy. As the model is linear after the mean, scoring counts n-grams and multiplies once.

Rejection is calibrated on texts that training did not see: a temperature that makes the
probabilities honest, and the smallest one at which the wanted precision is reached.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ticketlake.llm.text import materialize, per_text
from ticketlake.llm.toxicity import LETTERS

UNDETERMINED = "und"
BITS, DIM, NGRAMS = 15, 16, (1, 2, 3, 4)
BUCKETS = 1 << BITS
#: Bound of the training sample, in texts per language.
MAX_PER_LANG = 500
#: A sampled training text gives this many chunks of this many distinct words at most.
CHUNKS, CHUNK_WORDS = 4, 60


def subwords(words: list[str]) -> np.ndarray:
    """Table rows of all n-grams of the words, repeats included.

    Runs over the code points of all words at once: a blank before and after each word is
    its end mark, and an n-gram may start or end with a blank but not hold one inside.
    """
    if not words:
        return np.empty(0, np.int64)
    codes = np.frombuffer(f" {' '.join(words)} ".encode("utf-32-le"), np.uint32)
    blank = codes == 32
    before = np.concatenate([[0], np.cumsum(blank)])
    h, rows = np.zeros(len(codes), np.uint32), []
    for n in range(1, max(NGRAMS) + 1):
        m = len(codes) - n + 1
        if m < 1:
            break
        h = h[:m] * np.uint32(0x01000193) ^ codes[n - 1 :]
        if n in NGRAMS:
            inner = before[n - 1 : n - 1 + m] - before[1 : m + 1] if n > 2 else np.zeros(m, np.int64)
            ok = inner == 0 if n > 1 else ~blank
            x = h[ok] * np.uint32(0x9E3779B1) + np.uint32(n)
            x ^= x >> np.uint32(15)
            rows.append((x * np.uint32(0x85EBCA77)) >> np.uint32(32 - BITS))
    return np.concatenate(rows).astype(np.int64)


def words_in(text: str | None) -> list[str]:
    """Runs of letters, lower-cased; numbers that are no digits (halves, Roman signs) are cut out."""
    words = LETTERS.findall((text or "").lower())
    if not all(map(str.isalpha, words)):
        words = [w for w in ("".join(filter(str.isalpha, w)) for w in words) if w]
    return words


@dataclass
class Model:
    langs: list[str]
    table: np.ndarray  # (BUCKETS, languages): embedding times output weights
    bias: np.ndarray
    temperature: float
    least: float  # calibrated probability below which a prediction is rejected

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language and calibrated probability of a whole text."""
        rows = subwords(words_in(text))
        if not len(rows) or not self.langs:
            return UNDETERMINED, 0.0
        times = np.bincount(rows, minlength=len(self.table))
        used = np.flatnonzero(times)
        logits = (times[used] @ self.table[used] / len(rows) + self.bias) / self.temperature
        p = np.exp(logits - logits.max())
        p /= p.sum()
        best = int(np.argmax(p))
        return self.langs[best], float(p[best])


def fit(
    texts: list[list[str]],
    langs: list[str],
    epochs: int = 4,
    rate: float = 2.0,
    precision: float = 0.99,
    seed: int = 5,
) -> Model:
    """Train on word lists; every fifth text calibrates. Ties go to the smaller name."""
    names = sorted(set(langs))
    if not names:
        return Model([], np.zeros((BUCKETS, 0)), np.zeros(0), 1.0, 0.0)
    rng = np.random.default_rng(seed)
    y = np.array([names.index(v) for v in langs])
    bags = [np.unique(subwords(t), return_counts=True) for t in texts]
    shares = [n / n.sum() for _, n in bags]
    usable = np.array([i for i in range(len(y)) if len(shares[i])], int)
    rng.shuffle(usable)
    held, train = usable[::5], np.array([i for k, i in enumerate(usable) if k % 5], int)
    if not len(train):
        train = usable
    emb = rng.normal(0, 1 / DIM, (BUCKETS, DIM))
    out, bias = np.zeros((DIM, len(names))), np.zeros(len(names))
    # Balanced: a rarer language's examples step further.
    size = np.bincount(y[train], minlength=len(names)).clip(1)
    weight = (len(train) / len(names) / size).clip(0.2, 5)
    steps, done = epochs * max(len(train), 1), 0
    for _ in range(epochs):
        for i in rng.permutation(train):
            lr = rate * (1 - done / steps)
            done += 1
            bag, share = bags[i][0], shares[i]
            v = share @ emb[bag]
            z = v @ out + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y[i]] -= 1
            p *= weight[y[i]]
            back = out @ p
            out -= lr * np.outer(v, p)
            bias -= 0.1 * lr * p
            emb[bag] -= lr * np.outer(share, back)
    table = emb @ out
    logits = np.array([shares[i] @ table[bags[i][0]] + bias for i in held]).reshape(-1, len(names))
    temperature, least = _calibrate(logits, y[held], precision)
    return Model(names, table, bias, temperature, least)


def _calibrate(logits: np.ndarray, y: np.ndarray, precision: float) -> tuple[float, float]:
    if not len(y):
        return 1.0, 0.0

    def probabilities(t: float) -> np.ndarray:
        z = logits / t
        p = np.exp(z - z.max(1, keepdims=True))
        return p / p.sum(1, keepdims=True)

    def loss(t: float) -> float:
        return float(-np.log(probabilities(t)[np.arange(len(y)), y].clip(1e-12)).mean())

    temperature = min((0.1, 0.2, 0.35, 0.5, 0.7, 1.0, 1.4, 2.0, 3.0, 5.0), key=loss)
    p = probabilities(temperature)
    best, right = p.max(1), p.argmax(1) == y
    order = np.argsort(-best, kind="stable")
    share = np.cumsum(right[order]) / np.arange(1, len(y) + 1)
    good = np.flatnonzero(share >= precision)
    return temperature, float(best[order][good[-1]]) if len(good) else 1.0


def _chunks(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for f in frames:
        rows = []
        for doc_id, text, lang in zip(f["doc_id"], f["text"], f["lang"], strict=True):
            # Distinct words spread over the whole text, dealt to chunks by their hash.
            words = sorted(set(words_in(text)), key=xxhash.xxh64_intdigest)
            for k in range(CHUNKS):
                if part := words[k::CHUNKS][:CHUNK_WORDS]:
                    rows.append((doc_id, k, lang, " ".join(part)))
        yield pd.DataFrame(rows, columns=["doc_id", "chunk", "lang", "words"])


def train(docs: DataFrame, usable, max_per_lang: int = MAX_PER_LANG, **options) -> Model:
    """Fit on ``docs`` (doc_id, text, lang) where ``usable(doc_id)`` holds.

    Per language at most ``max_per_lang`` texts, chosen by a hash of doc_id. Rows with null
    id, text or lang do not train; of rows that repeat an id, the smallest text does.
    """
    known = docs.select("doc_id", "text", "lang").filter(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & usable(F.col("doc_id"))
    )
    # Hashes up to twice the wanted share of a language, so that no window holds a large one.
    place = F.shiftrightunsigned(F.xxhash64("doc_id"), 11) / F.lit(float(1 << 53))
    sizes = known.groupBy("lang").agg(F.count("*").alias("_n"))
    low = known.select("doc_id", "lang").join(sizes, "lang").filter(
        place * F.col("_n") <= 2 * max_per_lang + 50
    ).select("doc_id", "lang").distinct()
    first = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = low.withColumn("_r", F.row_number().over(first)).filter(F.col("_r") <= max_per_lang).drop("_r")
    # Written first, so that the planner knows how few they are and moves no text for the join.
    chosen = materialize(chosen, "chosen")
    sample = known.join(chosen, ["doc_id", "lang"], "left_semi").groupBy("doc_id", "lang").agg(F.min("text").alias("text"))
    rows = sample.mapInPandas(_chunks, "doc_id long, chunk int, lang string, words string").collect()
    rows.sort(key=lambda r: (r["doc_id"], r["chunk"], r["words"], r["lang"]))
    return fit([r["words"].split(" ") for r in rows], [r["lang"] for r in rows], **options)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score, accepted) per row, from its whole text.

    ``und`` with score 0 for texts that are null or have no letter, and for all if no language
    was learned. ``accepted`` is false for those and where the probability is below the
    calibrated bound. Repeated rows are rows, null ids stay null.
    """

    def predicted(texts: list) -> dict[str, pa.Array]:
        found = [model.predict(t) for t in texts]
        good = [lang != UNDETERMINED and p >= model.least for lang, p in found]
        langs, scores = zip(*found) if found else ((), ())
        return {
            "lang_pred": pa.array(langs, pa.string()), "score": pa.array(scores, pa.float64()),
            "accepted": pa.array(good, pa.bool_()),
        }

    return per_text(docs, "lang_pred string, score double, accepted boolean", predicted)

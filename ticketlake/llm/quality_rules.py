"""Quality rules as a learned decision list.

Sequential covering: each round grows a conjunction of threshold tests on text statistics
that best separates low-quality from other labelled texts, prunes its last tests against a
second part of the sample, and removes what the rule covers. The list becomes one ordered
``CASE WHEN`` expression, so applying it is plain Spark SQL.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketlake.llm.text import per_text, take_sample, window_hashes

SYMBOLS = re.compile(r"[#*$%&|<>]")
WINDOW = 8
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: What the tests compare: shares do not depend on a text's length.
FEATURES = {
    "n_words": "n_words",
    "mean_word_chars": "word_chars / greatest(n_words, 1)",
    "symbols_per_word": "n_symbols / greatest(n_words, 1)",
    "dup_lines_per_100_words": "100 * n_dup_lines / greatest(n_words, 1)",
    "repeat_share": "n_repeat_words / greatest(n_words, 1)",
}
#: Bound of the labelled sample that rules are learned from.
MAX_LABELLED = 40_000


def repeated_words(words: list[bytes], size: int = WINDOW) -> int:
    """Words inside windows of ``size`` words that the text has at least twice."""
    if len(words) <= size:
        return 0
    windows = window_hashes(words, size)
    _, which, times = np.unique(windows, return_inverse=True, return_counts=True)
    again = times[which] > 1
    if not again.any():
        return 0
    edge = np.zeros(len(words) + 1, np.int32)
    starts = np.flatnonzero(again)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + size, -1)
    return int((np.cumsum(edge)[:-1] > 0).sum())


def text_stats(text: str | None) -> tuple[int, int, int, int, int]:
    """The statistics of a whole text, in the order of ``STATS``; zeros for null."""
    raw = (text or "").encode()
    words = raw.split()
    # Code points: bytes that do not continue one.
    joined = np.frombuffer(b"".join(words), np.uint8)
    chars = int(((joined & 0xC0) != 0x80).sum())
    lines = [line for line in raw.split(b"\n") if line.strip()]
    return (
        len(words), chars, len(SYMBOLS.findall(text or "")),
        len(lines) - len(set(lines)), repeated_words(words),
    )


def _stat_columns(texts: list) -> dict[str, pa.Array]:
    rows = np.array([text_stats(t) for t in texts], np.int64).reshape(-1, len(STATS))
    return {s: pa.array(rows[:, i]) for i, s in enumerate(STATS)}


def statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, the five statistics) per row of ``docs``; other columns are not carried.

    Null, empty and blank texts have zeros; repeated rows are rows, null ids stay null.
    """
    return per_text(docs, ", ".join(f"{s} long" for s in STATS), _stat_columns)


# Learning -------------------------------------------------------------------------------
@dataclass(frozen=True)
class Test:
    feature: str
    above: bool
    bound: float

    def sql(self) -> str:
        return f"({FEATURES[self.feature]}) {'>' if self.above else '<='} {self.bound!r}D"

    def holds(self, x: dict[str, np.ndarray]) -> np.ndarray:
        return x[self.feature] > self.bound if self.above else x[self.feature] <= self.bound


@dataclass(frozen=True)
class Rule:
    """A conjunction that rejects; precision and cover as measured on the sample."""

    tests: tuple[Test, ...]
    precision: float
    covered: int

    def sql(self) -> str:
        return " AND ".join(t.sql() for t in self.tests)


def _holds(tests, x: dict[str, np.ndarray], n: int) -> np.ndarray:
    out = np.ones(n, bool)
    for t in tests:
        out &= t.holds(x)
    return out


def _best_test(x, bad: np.ndarray, live: np.ndarray, cuts: int) -> tuple[float, Test | None]:
    """The test with the largest FOIL gain on the rows that are still covered."""
    p0, n0 = bad[live].sum(), (~bad[live]).sum()
    base = np.log2(p0 / (p0 + n0)) if p0 else 0.0
    best: tuple[float, Test | None] = (1e-9, None)
    for name in FEATURES:
        v = x[name][live]
        order = np.argsort(v, kind="stable")
        s, b = v[order], bad[live][order]
        ends = np.flatnonzero(s[1:] > s[:-1])  # a cut lies between two different values
        if not len(ends):
            continue
        if len(ends) > cuts:
            ends = ends[np.unique(np.linspace(0, len(ends) - 1, cuts).astype(int))]
        p = np.cumsum(b)[ends]
        n = ends + 1 - p
        for above, (pos, neg) in ((False, (p, n)), (True, (p0 - p, n0 - n))):
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = np.where(pos > 0, pos * (np.log2(pos / (pos + neg)) - base), -1.0)
            i = int(np.argmax(gain))
            if gain[i] > best[0]:
                bound = float((s[ends[i]] + s[ends[i] + 1]) / 2)
                best = (float(gain[i]), Test(name, above, bound))
    return best


def learn(
    x: dict[str, np.ndarray],
    bad: np.ndarray,
    max_rules: int = 12,
    max_tests: int = 4,
    precision: float = 0.9,
    least: int = 8,
    cuts: int = 256,
    seed: int = 3,
) -> list[Rule]:
    """Ordered rejecting rules.

    Two thirds of the rows grow the rules, the rest prunes them. A rule stays if both parts
    together show at least ``precision`` and ``least`` low-quality rows; learning ends with
    the first rule that does not.
    """
    total = len(bad)
    bad = bad.astype(bool)
    grow = np.random.default_rng(seed).random(total) < 2 / 3
    left, rules = np.ones(total, bool), []
    while len(rules) < max_rules and (bad & left & grow).any():
        tests: list[Test] = []
        live = left & grow
        while len(tests) < max_tests and (~bad & live).any():
            _, test = _best_test(x, bad, live, cuts)
            if test is None:
                break
            tests.append(test)
            live = live & test.holds(x)
        held = left & ~grow

        def value(part) -> float:
            hit = held & _holds(part, x, total)
            p, n = (bad & hit).sum(), (~bad & hit).sum()
            return (p - n) / (p + n) if p + n else -1.0

        best = max(range(1, len(tests) + 1), key=lambda k: (value(tests[:k]), -k), default=0)
        hit = left & _holds(tests[:best], x, total)
        p, n = int((bad & hit).sum()), int((~bad & hit).sum())
        if not best or p < least or p < precision * (p + n):
            break
        rules.append(Rule(tuple(tests[:best]), p / (p + n), p + n))
        left &= ~hit
    return rules


def train(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED, **options) -> list[Rule]:
    """Rules from ``labels`` (doc_id, quality): 0 is low quality.

    Learns from at most ``max_labelled`` labelled rows, those with the smallest hash of
    doc_id. Rows with null ids or labels do not train, nor do texts that the base rule
    rejects anyway. Of rows that repeat an id, the smallest text trains. No labels, no rules:
    every text is kept.
    """
    known = labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
    known = take_sample(known.groupBy("doc_id").agg(F.min("quality").alias("quality")), "doc_id", max_labelled)
    texts = docs.select("doc_id", "text").join(F.broadcast(known.select("doc_id")), "doc_id", "left_semi")
    texts = texts.groupBy("doc_id").agg(F.min("text").alias("text"))
    rows = statistics(texts).join(known, "doc_id").filter(~base_failed())
    frame = rows.select("quality", *[F.expr(e).cast("double").alias(n) for n, e in FEATURES.items()]).toPandas()
    if frame.empty:
        return []
    frame = frame.sort_values(list(frame.columns), ignore_index=True)
    return learn({n: frame[n].to_numpy() for n in FEATURES}, frame["quality"].to_numpy() == 0, **options)


# Applying -------------------------------------------------------------------------------
def base_failed() -> Column:
    return F.expr("n_words < 20 OR 100 * n_repeat_words > 30 * n_words")


def rule_number(rules: list[Rule]) -> Column:
    """Number of the first rule that holds, from 1; 0 if none does."""
    if not rules:
        return F.lit(0)
    return F.expr("CASE " + " ".join(f"WHEN {r.sql()} THEN {i}" for i, r in enumerate(rules, 1)) + " ELSE 0 END")


def apply_rules(stats: DataFrame, rules: list[Rule]) -> DataFrame:
    """Adds base_failed, rule (see ``rule_number``) and kept to rows of statistics; a text
    without words fails the base, whatever the rules."""
    ruled = stats.withColumns({"base_failed": base_failed(), "rule": rule_number(rules)})
    return ruled.withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0))

"""Token ids of two tokenizers, aligned by the bytes they stand for.

A text with a blank before it is encoded by a byte-level vocabulary (A) and by a SentencePiece
model (B). Both id lists are cut where a token of A and a token of B end at the same byte: each
side's cumulative ends go into a dictionary from end to index, the intersection of the two key
sets, sorted, slices both lists into groups, and each slice links the two tokens that end it.

Neither tokenizer joins across a blank that follows a character other than white space, so a
text is cut there into chunks, and a chunk that was met before has its groups at hand. Two
linked tokens end at one byte, hence one's bytes are the end of the other's: the possible links
are the suffix pairs of the two vocabularies, a table that does not grow with the corpus
(``Pairs``). Links are kept as its row numbers.

Null and empty texts, and texts whose tokens do not give back their bytes (the model may write
some characters otherwise), have no tokens. Repeated rows are rows. Other columns are not read.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, compress

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ticketlake.llm.text import materialize
from ticketlake.llm.tokens import blank_chunks, runs
from ticketlake.session import Scratch

#: Chunks that a worker keeps, and the longest that are worth it.
CACHE_CHUNKS, CACHE_LENGTH = 300_000, 64
#: Chunks and characters that are learned at once: an encoding takes many times its text.
LEARN_CHUNKS, LEARN_CHARS = 4_096, 1 << 17
_SCHEMA = "doc_id long, n_a long, n_b long, n_groups long, groups string, links binary"


def _byte_of() -> dict[str, int]:
    """Byte of each character of a byte-level vocabulary: printable ones of Latin-1 stand for
    themselves, the others are numbered from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def byte_level_tokens(path: str) -> list[bytes]:
    """Bytes of each id of a byte-level vocabulary file; special tokens are never used."""
    byte_of, tokenizer = _byte_of(), Tokenizer.from_file(path)
    special = {t.content for t in tokenizer.get_added_tokens_decoder().values()}
    tokens = [tokenizer.id_to_token(i) for i in range(tokenizer.get_vocab_size())]
    return [b"" if t in special else bytes(map(byte_of.__getitem__, t)) for t in tokens]


def piece_tokens(model: sentencepiece.SentencePieceProcessor) -> list[bytes]:
    """Bytes of each id of a SentencePiece model; control pieces are never used."""
    out = []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if model.is_control(i) or model.is_unknown(i):
            out.append(b"")
        else:
            out.append(bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode())
    return out


class Pairs:
    """All pairs of tokens of which one's bytes end the other's, in ascending order."""

    def __init__(self, a: list[bytes], b: list[bytes]) -> None:
        def by_bytes(tokens: list[bytes]) -> dict[bytes, list[int]]:
            ids: dict[bytes, list[int]] = {}
            for i, t in enumerate(tokens):
                if t:
                    ids.setdefault(t, []).append(i)
            return ids

        self.stride = len(b)
        of_a, of_b = by_bytes(a), by_bytes(b)
        found = set()
        for i, t in enumerate(a):
            found.update(i * self.stride + j for k in range(len(t)) for j in of_b.get(t[k:], ()))
        for j, t in enumerate(b):
            found.update(i * self.stride + j for k in range(len(t)) for i in of_a.get(t[k:], ()))
        self.keys = np.array(sorted(found), np.int64)

    def codes(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Row numbers of pairs that are in the table."""
        return np.searchsorted(self.keys, a * self.stride + b).astype("<u4")

    def ids(self) -> tuple[np.ndarray, np.ndarray]:
        return self.keys // self.stride, self.keys % self.stride


class Aligner:
    """Aligns texts with one pair of vocabulary files."""

    def __init__(self, byte_level: str, pieces: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task per core
        self.a = Tokenizer.from_file(byte_level)
        self.a.encode_special_tokens = True  # their strings in a text are text
        self.b = sentencepiece.SentencePieceProcessor(model_file=pieces)
        self.bytes_a, self.bytes_b = byte_level_tokens(byte_level), piece_tokens(self.b)
        self.size_a, self.size_b = (np.array(list(map(len, t)), np.int64) for t in (self.bytes_a, self.bytes_b))
        self.pairs = Pairs(self.bytes_a, self.bytes_b)
        # Ids as text with what follows them: within a side, and at its end.
        texts = lambda n, mark: np.array([f"{i}{mark}" for i in range(n)], object)
        self.text_a = (texts(len(self.bytes_a), ","), texts(len(self.bytes_a), "|"))
        self.text_b = (texts(len(self.bytes_b), ","), texts(len(self.bytes_b), ";"))
        # A piece with a blank after another character would join chunks.
        self.apart = not any(b" " in t.lstrip(b" ") for t in self.bytes_b)
        # Known chunks: place, and there groups, links, numbers (of A, B and groups) and hits.
        self.place: dict[str, int] = {}
        self.groups: list[str] = []
        self.links: list[bytes] = []
        self.numbers = np.zeros((0, 3), np.int64)
        self.hits = np.zeros(0, np.int64)

    def split(self, text: str) -> list[str]:
        """Chunks of a blank and the text, each without the blank it starts with."""
        return blank_chunks(text) if self.apart else [text]

    def _forget(self) -> None:
        """Keeps the half of the chunks that was met most often."""
        names, places = list(self.place), np.array(list(self.place.values()), np.int64)
        best = np.argsort(-self.hits[places], kind="stable")[: CACHE_CHUNKS // 2].tolist()
        kept = places[best]
        self.place = {names[i]: k for k, i in enumerate(best)}
        self.groups, self.links = ([x[i] for i in kept.tolist()] for x in (self.groups, self.links))
        self.numbers, self.hits = self.numbers[kept], self.hits[kept] // 2

    def _learn(self, chunks: list[str]) -> np.ndarray:
        """Groups and links of new chunks, which stand one after the other as one run of bytes;
        returns their numbers."""
        spaced = [" " + c for c in chunks]
        wanted = [c.encode() for c in spaced]
        sides = []
        all_a = [e.ids for e in self.a.encode_batch_fast(spaced, add_special_tokens=False)]
        all_b = self.b.encode(chunks, num_threads=1)
        if "" in chunks:  # a blank at a text's end: the model adds none to nothing
            all_b[chunks.index("")] = [self.b.piece_to_id("▁")]
        for found, size in ((all_a, self.size_a), (all_b, self.size_b)):
            n = np.fromiter(map(len, found), np.int64, len(found))
            ids = np.fromiter(chain.from_iterable(found), np.int64, int(n.sum()))
            sides.append([ids, n, size])
        # Only chunks whose tokens give back their bytes, on both sides.
        length = np.fromiter(map(len, wanted), np.int64, len(wanted))
        fits = np.ones(len(chunks), bool)
        for ids, n, size in sides:
            ends = np.cumsum(n)
            total = np.concatenate([[0], np.cumsum(size[ids])])
            fits &= total[ends] - total[ends - n] == length
        for (ids, n, _), tokens in zip(sides, (self.bytes_a, self.bytes_b), strict=True):
            found = b"".join(map(tokens.__getitem__, ids[np.repeat(fits, n)].tolist()))
            if found != b"".join(compress(wanted, fits)):
                at, start = np.concatenate([[0], np.cumsum(length[fits])]), np.flatnonzero(fits)
                same = [found[at[i] : at[i + 1]] == wanted[k] for i, k in enumerate(start.tolist())]
                fits[start] = same
        a, b = (ids[np.repeat(fits, n)] for ids, n, _ in sides)
        n_a, n_b = (n[fits] for _, n, _ in sides)
        at_a = dict(zip(np.cumsum(self.size_a[a]).tolist(), range(1, len(a) + 1)))
        at_b = dict(zip(np.cumsum(self.size_b[b]).tolist(), range(1, len(b) + 1)))
        common = sorted(at_a.keys() & at_b.keys())
        # Ends of the slices of both lists: group g holds a[cut_a[g]:cut_a[g + 1]] and b likewise.
        cut_a = np.array([0, *map(at_a.__getitem__, common)])
        cut_b = np.array([0, *map(at_b.__getitem__, common)])
        codes = self.pairs.codes(a[cut_a[1:] - 1], b[cut_b[1:] - 1]).tobytes()
        # The slices as text: each group's ids of A, then those of B.
        out = np.empty(len(a) + len(b), object)
        place_a = np.arange(len(a)) + np.repeat(cut_b[:-1], np.diff(cut_a))
        place_b = np.arange(len(b)) + np.repeat(cut_a[1:], np.diff(cut_b))
        out[place_a], out[place_b] = self.text_a[0][a], self.text_b[0][b]
        last_a, last_b = cut_a[1:] - 1, cut_b[1:] - 1
        out[place_a[last_a]], out[place_b[last_b]] = self.text_a[1][a[last_a]], self.text_b[1][b[last_b]]
        # A chunk ends a group; what belongs to it lies between those places.
        numbers = np.zeros((len(chunks), 3), np.int64)
        ends = np.searchsorted(cut_a, np.cumsum(n_a))
        numbers[fits] = np.column_stack([n_a, n_b, np.diff(ends, prepend=0)])
        stops, last = np.cumsum(numbers[:, 0] + numbers[:, 1]).tolist(), (4 * np.cumsum(numbers[:, 2])).tolist()
        text, before = out.tolist(), len(self.groups)
        self.groups += ["".join(text[i:k]) for i, k in zip([0, *stops], stops)]
        self.links += [codes[i:k] for i, k in zip([0, *last], last)]
        self.place.update(zip(chunks, range(before, before + len(chunks))))
        return numbers

    def learn(self, chunks: list[str]) -> None:
        """Keeps the groups and links of new chunks, of which few are encoded at once."""
        numbers, start = [self.numbers], 0
        ends = np.cumsum(np.fromiter(map(len, chunks), np.int64, len(chunks)))
        while start < len(chunks):
            before = ends[start - 1] if start else 0
            stop = max(start + 1, min(start + LEARN_CHUNKS, int(np.searchsorted(ends, before + LEARN_CHARS, "right"))))
            numbers.append(self._learn(chunks[start:stop]))
            start = stop
        self.numbers = np.concatenate(numbers)
        self.hits = np.concatenate([self.hits, np.zeros(len(chunks), np.int64)])

    def align(self, texts: list[str | None]) -> Iterator[tuple[int, int, int, str, bytes]]:
        """(n_a, n_b, n_groups, groups, links) per text; links are row numbers of ``pairs``."""
        cut = [self.split(t) if t else [] for t in texts]
        wanted = set(chain.from_iterable(cut))
        if len(self.place) + len(wanted.difference(self.place)) > CACHE_CHUNKS:
            self._forget()
        if missing := list(wanted.difference(self.place)):
            self.learn(missing)
        for chunks in cut:
            at = list(map(self.place.__getitem__, chunks))
            numbers = self.numbers[at]
            if not at or not numbers[:, 0].all():
                yield 0, 0, 0, "", b""
                continue
            self.hits[at] += 1
            n_a, n_b, n = numbers.sum(axis=0).tolist()
            groups, links = map(self.groups.__getitem__, at), map(self.links.__getitem__, at)
            yield n_a, n_b, n, "".join(groups)[:-1], b"".join(links)
        for c in wanted:
            if len(c) > CACHE_LENGTH:
                at = self.place.pop(c)
                self.groups[at], self.links[at] = "", b""
        if len(self.groups) > 2 * CACHE_CHUNKS:
            self._forget()


@lru_cache(maxsize=2)
def aligner(byte_level: str, pieces: str) -> Aligner:
    """The worker's aligner of two vocabulary files."""
    return Aligner(byte_level, pieces)


def aligned(docs: DataFrame, byte_level: str, pieces: str) -> DataFrame:
    """Alignment of every text of ``docs`` (doc_id, text): see ``_SCHEMA``.

    ``groups`` reads ``a1,a2|b1;a3|b2,b3``; ``links`` holds one unsigned 32-bit row number of
    the pair table per link, in order. The ids are passed on as they are.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in _SCHEMA.split(", ")]
        types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for start, stop in runs(texts):
                columns = list(zip(*aligner(byte_level, pieces).align(texts[start:stop])))
                arrays = [pa.array(c, t) for c, t in zip(columns, types[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(start, stop - start), *arrays], names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, _SCHEMA)


def _count(size: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One row per link code of the task."""
        total = np.zeros(size, np.int64)
        for batch in batches:
            for links in batch.column("links"):
                codes = np.frombuffer(links.as_buffer(), "<u4")
                if len(codes) > size // 8:
                    total += np.bincount(codes, minlength=size)
                else:
                    np.add.at(total, codes, 1)
        codes = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(codes), pa.array(total[codes])], ["code", "n"])

    return count


def link_counts(rows: DataFrame, pairs: Pairs) -> np.ndarray:
    """How many links of all rows hold each pair: as many numbers as the pair table has rows."""
    counted = rows.select("links").mapInArrow(_count(len(pairs.keys)), "code long, n long")
    counts = np.zeros(len(pairs.keys), np.int64)
    for code, n in counted.groupBy("code").agg(F.sum("n")).collect():  # bounded by the vocabularies
        counts[code] = n
    return counts


def _score(counts: np.ndarray, best: np.ndarray, names: list[str]):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_best, sums = [], []
            for links in batch.column("links"):
                codes = np.frombuffer(links.as_buffer(), "<u4")
                n_best.append(int(best[codes].sum()))
                sums.append(int(counts[codes].sum()))
            kept = [batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(n_best, pa.int64()), pa.array(sums, pa.int64())], [*names, "n_best", "count_sum"])

    return score


def scored(rows: DataFrame, byte_level: str, pieces: str) -> DataFrame:
    """Adds to written rows of ``aligned`` how many of their links are the most frequent ones
    of their B id over all rows (ties included), and the sum of all links' counts.

    Counts and best links are arrays over the pair table, so they are sent to tasks whole.
    """
    pairs = aligner(byte_level, pieces).pairs
    counts = link_counts(rows, pairs)
    _, b = pairs.ids()
    most = np.zeros(pairs.stride, np.int64)
    np.maximum.at(most, b, counts)
    best = (counts > 0) & (counts == most[b])
    names = [c for c in rows.columns if c != "links"]
    schema = ", ".join(f"{n} {t}" for n, t in rows.dtypes if n != "links") + ", n_best long, count_sum long"
    return rows.mapInArrow(_score(counts, best, names), schema)


def alignment_digests(docs: DataFrame, byte_level: str, pieces: str, scratch: Scratch | None = None) -> DataFrame:
    """Counts and the groups' hash per document; written once between the two passes."""
    groups = F.when(F.col("groups") != "", F.sha2(F.col("groups").cast("binary"), 256)).otherwise("")
    rows = aligned(docs, byte_level, pieces).select(
        "doc_id", "n_a", "n_b", "n_groups", F.expr("length(links) div 4").cast("long").alias("n_links"),
        groups.alias("groups_sha256"), "links",
    )
    return scored(materialize(rows, "alignments", scratch), byte_level, pieces)

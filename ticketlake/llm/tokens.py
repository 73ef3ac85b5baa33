"""Token ids of whole texts inside tasks, with a cache per chunk of text."""

from __future__ import annotations

import os
import re
import sys
from array import array

import numpy as np
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

from ticketlake.llm.text import runs  # noqa: F401

#: White space of Unicode, as the tokenizers' own patterns understand it.
_WS = "\t-\r \x85\xa0  -     　"
_CHUNK = re.compile(f"[{_WS}]+(?![^{_WS}])| ?[^{_WS}]+|[{_WS}]")
#: A text with this start of a special token is encoded in one go.
_SPECIAL = "<|"
CACHE_CHUNKS = 600_000
#: A blank and all up to the next blank that follows no white space.
_BLANK_CHUNK = re.compile(r" \s*\S*(?:[^\S ]\s*\S*)*")
#: White space before a blank: there, more than a blank starts a chunk.
_ODD_BLANKS = re.compile(r"\s ")
_BYTES = ByteLevel(add_prefix_space=False, use_regex=False)


def blank_chunks(text: str) -> list[str]:
    """Chunks of a blank and the text, each without the blank it starts with.

    A cut is a blank that follows no white space. No byte-level pattern joins across one.
    """
    if _ODD_BLANKS.search(" " + text):
        return [c[1:] for c in _BLANK_CHUNK.findall(" " + text)]
    return text.split(" ")


class Encoder:
    """Encodes texts with one vocabulary file, exactly as encoding them whole would.

    The tokenizer never merges across white space, so chunks between white space have ids
    of their own and repeat over and over. ``spaces`` says whether white space itself has
    ids (byte-level vocabularies): then a chunk carries its leading blank, and runs of white
    space are chunks.
    """

    def __init__(self, path: str, spaces: bool) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task per core
        self.tokenizer = Tokenizer.from_file(path)
        self.merges = self.tokenizer.model.tokenize
        self.spaces, self.limit = spaces, CACHE_CHUNKS
        # What the model sees for a blank and the letters of Latin-1: a character per byte.
        self.seen = {ord(c): "".join(part for part, _ in _BYTES.pre_tokenize_str(c)) for c in map(chr, range(256)) if c == " " or c.isalpha()}
        self.tails: dict[str, bytes] = {}
        self.split = _CHUNK.findall if spaces else lambda text: text.encode().split()
        self.cache: dict = {}

    @staticmethod
    def _ids(encoding) -> bytes:
        return _bytes(encoding.ids)

    def encode(self, text: str | None, end: int) -> np.ndarray:
        """Ids of the text, empty for null, and the end id."""
        text = text or ""
        tail = np.array([end], "<u4").tobytes()
        if _SPECIAL in text:
            return np.frombuffer(self._ids(self.tokenizer.encode(text, add_special_tokens=False)) + tail, "<u4")
        chunks = self.split(text)
        if missing := {*chunks}.difference(self.cache):
            if len(self.cache) + len(missing) > self.limit:
                self.cache.clear()
                missing = {*chunks}
            self._learn(missing)
        return np.frombuffer(b"".join(map(self.cache.__getitem__, chunks)) + tail, "<u4")

    def _learn(self, missing: set) -> None:
        """Caches the ids of chunks.

        Stops and commas after a word have ids of their own. A word of plain letters goes
        straight to the vocabulary's merges; its normal form is known without a pattern.
        """
        others, cache = [], self.cache
        for c in missing:
            text = c if isinstance(c, str) else c.decode()
            word = text.rstrip(".,")
            letters = word[1:] if self.spaces and word[:1] == " " else word
            if not letters.isalpha() or not (letters.isascii() or max(letters) < "\u0100"):
                others.append((c, text))
                continue
            bare = word if self.spaces else word.encode()
            ids = cache.get(bare)
            if ids is None:  # the same word may have stood before other marks
                ids = cache[bare] = _bytes([t.id for t in self.merges(self._mapped(word))])
            if len(word) < len(text):
                cache[c] = ids + self._tail(text[len(word) :])
        if others:
            batch = self.tokenizer.encode_batch_fast([t for _, t in others], add_special_tokens=False)
            cache.update(zip([c for c, _ in others], map(self._ids, batch), strict=True))

    def _mapped(self, word: str) -> str:
        """Letters as the model sees them: lower-cased if the vocabulary is, and one character
        per byte."""
        word = word if self.spaces else word.lower()
        return word if word.isascii() and word[:1] != " " else word.translate(self.seen)

    def _tail(self, marks: str) -> bytes:
        if marks not in self.tails:
            self.tails[marks] = self._ids(self.tokenizer.encode(marks, add_special_tokens=False))
        return self.tails[marks]


def _bytes(ids: list[int]) -> bytes:
    """Ids as little-endian 32-bit numbers."""
    packed = array("I", ids)
    if sys.byteorder != "little":
        packed.byteswap()
    return packed.tobytes()


_ENCODERS: dict[tuple[str, bool], Encoder] = {}


def encoder(path: str, spaces: bool) -> Encoder:
    """The worker's encoder of a vocabulary file."""
    if (path, spaces) not in _ENCODERS:
        _ENCODERS[path, spaces] = Encoder(path, spaces)
    return _ENCODERS[path, spaces]

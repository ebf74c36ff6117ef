"""Encoding of the whole corpus with a public byte-level BPE vocabulary by a lazily determinised transducer.

The ranks of the vocabulary compile into a transducer over bytes. Its state after a prefix is the longest suffix that can still
grow into a token, with the last token of the encoding of every prefix that ends inside that suffix. The next byte adds one
position: its last token is the one suffix token that may stand next to the last token before it (two tokens may be neighbours
iff the merges leave their joined bytes as exactly these two). States and their transitions are made when first met and kept in
a bounded table. Once all suffixes that can still grow agree on the tokens before a point, these are emitted: the lookahead is
bounded by the longest token. Work is linear in the bytes, also within one endless word.

Decoding streams: an incremental UTF-8 state machine turns token bytes into characters as soon as they are whole.

Defined results: a null text and an empty text give the empty list; strings of special tokens are ordinary text; every document
gives one row, copies too; text of any length is encoded whole; other columns are ignored.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

#: Where the public vocabulary files lie; a parameter of every entry point.
TOKENIZERS = "/opt/tokenizers"
# Fixed value: the published pattern that splits text before the merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Table sizes; a full table is emptied and filled again, results do not change.
MAX_STATES, MAX_WORDS, LONGEST_KEPT_WORD = 150_000, 60_000, 48


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank (= id) of a rank file: base64 token, blank, rank on each line."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class Transducer:
    """Lazily determinised BPE transducer over bytes."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.longest = max(map(len, ranks), default=0)
        self.prefixes = {t[:n] for t in ranks for n in range(1, len(t) + 1)}
        self.split_at = regex.compile(PATTERN)
        self.pairs: dict[tuple[bytes, bytes], bool] = {}
        self._reset()
        self.words: dict[str, tuple[int, ...]] = {}

    def _reset(self) -> None:
        # A state: (bytes since the last emitted point, length of the growing suffix, token ending at each position).
        self.ids: dict[tuple[bytes, int, tuple[bytes, ...]], int] = {(b"", 0, ()): 0}
        self.states: list[tuple[bytes, int, tuple[bytes, ...]]] = [(b"", 0, ())]
        self.step: list[dict[int, tuple[int, tuple[int, ...]]]] = [{}]
        self.flush: list[tuple[int, ...]] = [()]

    def merge(self, word: bytes) -> list[bytes]:
        """Tokens of a short byte string by the definition: join the neighbours of lowest rank until none can be joined."""
        parts = [word[i : i + 1] for i in range(len(word))]
        while len(parts) > 1:
            rank, i = min((self.ranks.get(a + b, 1 << 60), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if rank == 1 << 60:
                break
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def neighbours(self, a: bytes, b: bytes) -> bool:
        """Whether tokens a and b may follow each other in an encoding."""
        known = self.pairs.get((a, b))
        if known is None:
            if len(self.pairs) > 500_000:
                self.pairs.clear()
            known = self.pairs[a, b] = a + b not in self.ranks and self.merge(a + b) == [a, b]
        return known

    def _add(self, key: tuple[bytes, int, tuple[bytes, ...]]) -> int:
        """Number of a new state; a word that ends in it still owes the tokens of its pending bytes."""
        to = self.ids[key] = len(self.states)
        self.states.append(key)
        self.step.append({})
        tail, p = [], len(key[0])
        while p > 0:
            tail.append(self.ranks[key[2][p - 1]])
            p -= len(key[2][p - 1])
        self.flush.append(tuple(reversed(tail)))
        return to

    def _next(self, state: int, byte: int) -> tuple[int, tuple[int, ...]]:
        """Make the transition of a state on a byte."""
        pending, grow, ends = self.states[state]
        pending += bytes((byte,))
        n = len(pending)
        last = b""
        for size in range(min(grow + 1, n), 0, -1):
            token = pending[n - size :]
            if token in self.ranks and self.merge(token) == [token] and (size == n or self.neighbours(ends[n - size - 1], token)):
                last = token
                break
        if not last:
            raise ValueError("a byte without token")
        ends = (*ends, last)
        grow = next(size for size in range(min(grow + 1, n), 0, -1) if pending[n - size :] in self.prefixes)
        # Points the paths of all live positions run through; what lies before the last such point is final.
        live = set(range(n - grow, n + 1))
        while len(live) > 1:
            p = max(live)
            if p == 0:
                break
            live.discard(p)
            live.add(p - len(ends[p - 1]))
        done = min(live)
        out: list[int] = []
        p = done
        while p > 0:
            out.append(self.ranks[ends[p - 1]])
            p -= len(ends[p - 1])
        key = (pending[done:], grow, ends[done:])
        to = self.ids.get(key)
        if to is None:
            if len(self.states) >= MAX_STATES:
                return -1, ()
            to = self._add(key)
        made = self.step[state][byte] = (to, tuple(reversed(out)))
        return made

    def encode_bytes(self, word: bytes) -> list[int]:
        """Token ids of one word, one transition per byte."""
        out: list[int] = []
        state = 0
        for byte in word:
            move = self.step[state].get(byte)
            if move is None:
                move = self._next(state, byte)
                if move[0] < 0:  # the table is full: carry the current state into an empty one
                    held = self.states[state]
                    self._reset()
                    state = self._add(held) if held != self.states[0] else 0
                    move = self._next(state, byte)
            state = move[0]
            if move[1]:
                out += move[1]
        return out + list(self.flush[state])

    def encode(self, text: str | None) -> list[int]:
        """Token ids of a text; null and empty texts have none."""
        out: list[int] = []
        words = self.words
        for word in self.split_at.findall(text or ""):
            ids = words.get(word)
            if ids is None:
                ids = tuple(self.encode_bytes(word.encode("utf-8", "replace")))
                if len(word) <= LONGEST_KEPT_WORD:
                    if len(words) >= MAX_WORDS:
                        words.clear()
                    words[word] = ids
            out += ids
        return out


@lru_cache(maxsize=4)
def transducer(name: str = "byte_bpe_50k", folder: str = TOKENIZERS) -> Transducer:
    """The transducer of a vocabulary file; one per worker process."""
    return Transducer(read_ranks(os.path.join(folder, f"{name}.tiktoken")))


class Utf8Decoder:
    """Incremental UTF-8 state machine: feed bytes, get the characters that are whole; ill-formed bytes become U+FFFD."""

    def __init__(self) -> None:
        self.need, self.code, self.low, self.high = 0, 0, 0x80, 0xBF

    def feed(self, data: bytes) -> str:
        out: list[str] = []
        for b in data:
            if self.need:
                if self.low <= b <= self.high:
                    self.code, self.need, self.low, self.high = self.code << 6 | b & 0x3F, self.need - 1, 0x80, 0xBF
                    if not self.need:
                        out.append(chr(self.code))
                    continue
                out.append("�")
                self.need, self.low, self.high = 0, 0x80, 0xBF
            if b < 0x80:
                out.append(chr(b))
            elif 0xC2 <= b <= 0xDF:
                self.need, self.code = 1, b & 0x1F
            elif 0xE0 <= b <= 0xEF:
                self.need, self.code, self.low, self.high = 2, b & 0x0F, 0xA0 if b == 0xE0 else 0x80, 0x9F if b == 0xED else 0xBF
            elif 0xF0 <= b <= 0xF4:
                self.need, self.code, self.low, self.high = 3, b & 0x07, 0x90 if b == 0xF0 else 0x80, 0x8F if b == 0xF4 else 0xBF
            else:
                out.append("�")
        return "".join(out)

    def end(self) -> str:
        left, self.need = ("�" if self.need else ""), 0
        return left


def decode_stream(ids: Iterable[int], vocabulary: dict[int, bytes]) -> Iterator[str]:
    """Text pieces of a stream of ids, each as soon as its characters are whole."""
    machine = Utf8Decoder()
    for i in ids:
        if piece := machine.feed(vocabulary[i]):
            yield piece
    if piece := machine.end():
        yield piece


def encoded(documents: DataFrame, name: str = "byte_bpe_50k", folder: str = TOKENIZERS) -> DataFrame:
    """(doc_id, ids) of every document. Map only: no shuffle, each worker compiles the vocabulary once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = transducer(name, folder)
        for batch in batches:
            offsets, flat = [0], []
            for text in batch.column(1).to_pylist():
                flat += machine.encode(text)
                offsets.append(len(flat))
            ids = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.asarray(flat, dtype=np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], ["doc_id", "ids"])

    return documents.select("doc_id", "text").mapInArrow(run, "doc_id bigint, ids array<int>")


def counted(documents: DataFrame, name: str = "byte_bpe_50k", folder: str = TOKENIZERS) -> DataFrame:
    """(doc_id, source, n_tokens) of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = transducer(name, folder)
        for batch in batches:
            sizes = [len(machine.encode(text)) for text in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sizes, pa.int64())], ["doc_id", "source", "n_tokens"])

    return documents.select("doc_id", "source", "text").mapInArrow(run, "doc_id bigint, source string, n_tokens bigint")

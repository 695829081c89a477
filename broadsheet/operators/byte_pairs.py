"""Tokens of a byte-pair vocabulary, counted by merges over the distinct pieces of texts.

Pieces are found by a pattern in the JVM. A task encodes each distinct one once, as long as it remembers it: from its bytes, the
pair of neighbours with the lowest rank is merged, the leftmost of equal ones first, until no pair is in the vocabulary. Many
pieces are merged at a time, one pair each in a step; long ones go by a heap. No piece is shuffled.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: the pattern of pieces that the public byte-level vocabularies are made for.
PATTERN = r"(?U)'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Longer pieces, in bytes, are merged one by one; others in groups of about GROUP bytes.
LONG, GROUP = 128, 1 << 18
#: Pieces that a task remembers; those of one batch come on top.
MOST_PIECES = 1 << 18

_NONE = np.iinfo(np.int32).max


class Merges:
    """Which pairs of tokens become which token; a token's number is its rank."""

    def __init__(self, vocabulary: str):
        with open(vocabulary, "rb") as file:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
        self.of_byte = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.size = max(ranks.values()) + 1
        pairs = {}
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                left, right = ranks.get(token[:i]), ranks.get(token[i:])
                if left is not None and right is not None:
                    pairs[left * self.size + right] = rank
        self.keys = np.array(sorted(pairs), np.int64)
        self.ranks = np.array([pairs[k] for k in self.keys.tolist()], np.int32)

    @cached_property
    def known(self) -> dict[int, int]:
        return dict(zip(self.keys.tolist(), self.ranks.tolist(), strict=True))

    def ranked(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, or _NONE."""
        key = left.astype(np.int64) * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], _NONE)

    def counts(self, pieces: pa.Array) -> np.ndarray:
        """Number of tokens of each piece."""
        pieces = pieces.cast(pa.large_binary())
        _, offsets, data = pieces.buffers()
        off = np.frombuffer(offsets, np.int64)[pieces.offset : pieces.offset + len(pieces) + 1] if len(pieces) else np.zeros(1, np.int64)
        data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        size = np.diff(off)
        out = np.zeros(len(pieces), np.int64)
        for i in np.flatnonzero(size > LONG).tolist():
            out[i] = self._long(data[off[i] : off[i + 1]])
        short = np.flatnonzero((size > 0) & (size <= LONG))
        for part in np.array_split(short, max(1, int(size[short].sum()) // GROUP)):
            out[part] = self._together(data, off[part], size[part])
        return out

    def _together(self, data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        out = np.zeros(len(size), np.int64)
        word = np.repeat(np.arange(len(size)), size)
        first = np.cumsum(size) - size
        ids = self.of_byte[data[np.repeat(start - first, size) + np.arange(size.sum())]]
        rank = np.full(len(ids), _NONE, np.int32)  # of each part with the next one
        inner = np.flatnonzero(word[:-1] == word[1:])
        rank[inner] = self.ranked(ids[inner], ids[inner + 1])
        while len(ids):
            first = np.flatnonzero(np.diff(word, prepend=-1))
            least = np.minimum.reduceat(rank, first)
            n = np.diff(first, append=len(ids))
            done = least == _NONE
            out[word[first[done]]] = n[done]
            if done.all():
                break
            hit = np.flatnonzero((rank == np.repeat(least, n)) & (rank < _NONE))
            hit = hit[np.diff(word[hit], prepend=-1) != 0]  # the leftmost of each piece
            ids[hit] = rank[hit]
            stay = np.repeat(~done, n)
            stay[hit + 1] = False
            place = np.cumsum(stay) - 1
            ids, word, rank, hit = ids[stay], word[stay], rank[stay], place[hit]
            for left in (hit, hit - 1):  # the merged part with the next one, and the one before with it
                left = left[left >= 0]
                rank[left] = _NONE
                left = left[left + 1 < len(ids)]
                left = left[word[left] == word[left + 1]]
                rank[left] = self.ranked(ids[left], ids[left + 1])
        return out

    def _long(self, data: np.ndarray) -> int:
        ids = self.of_byte[data].tolist()
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        heap = []

        def offer(i: int) -> None:
            if i >= 0 and after[i] < len(ids):
                rank = self.known.get(ids[i] * self.size + ids[after[i]])
                if rank is not None:
                    heapq.heappush(heap, (rank, i, ids[i], ids[after[i]]))

        for i in range(len(ids) - 1):
            offer(i)
        n = len(ids)
        while heap:
            rank, i, left, right = heapq.heappop(heap)
            j = after[i]
            if ids[i] != left or j >= len(ids) or ids[j] != right:  # one of them was merged meanwhile
                continue
            ids[i], ids[j], after[i] = rank, -1, after[j]
            if after[i] < len(ids):
                before[after[i]] = i
            n -= 1
            offer(before[i]), offer(i)
        return n


def pieces(text: Column) -> Column:
    """The pieces of a text that are encoded by themselves."""
    return F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0))


def pieces_of_words(words: Column) -> Column:
    """The pieces of all words of an array, each word by itself."""
    return F.filter(pieces(F.array_join(words, "\n")), lambda p: p != "\n")


def counted(rows: DataFrame, key: str, pieces: str, vocabulary: str) -> DataFrame:
    """rows(key, ..., an array of pieces) -> their other columns and n_tokens, null where there are no pieces.

    vocabulary: the path of a file of byte-pair ranks, which the driver reads.
    """
    held = rows.sparkSession.sparkContext.broadcast(Merges(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, int] = {}
        for batch in batches:
            lists = batch.column(batch.num_columns - 1)
            flat = lists.flatten().dictionary_encode()
            distinct = flat.dictionary.to_pylist()
            if len(known) > MOST_PIECES:
                known = {}
            new = [p for p in distinct if p not in known]
            known.update(zip(new, held.value.counts(pa.array(new, pa.string())).tolist(), strict=True))
            n = np.array([known[p] for p in distinct], np.int64)
            upto = np.concatenate([[0], np.cumsum(n[flat.indices.to_numpy()])]) if len(n) else np.zeros(1, np.int64)
            size = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            end = np.cumsum(size)
            tokens = pa.array(upto[end] - upto[end - size], pa.int64(), mask=size == 0)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], tokens], names=names)

    others = [c for c in rows.columns if c not in (key, pieces)]
    names = [key, *others, "n_tokens"]
    fields = [rows.schema[c] for c in names[:-1]]
    return rows.select(*names[:-1], pieces).mapInArrow(run, T.StructType([*fields, T.StructField("n_tokens", T.LongType())]))

"""Token counts under a unigram model by trie-shared dynamic programming.

A text's pre-tokens are its words, each behind the word mark. The distinct pre-tokens of a task are put into a
trie; the unigram forward score of a node (the best log-probability of any split of its prefix into pieces, and
the number of pieces of that split) is computed once, however many pre-tokens share the prefix, and a terminal
keeps its count. Texts then only add up the counts of their words.

The trie is gone through level by level: sorted pre-tokens are its leaves from left to right, a node is the first
of them with a prefix, and one level's nodes are scored together. A pre-token's count depends on nothing but the
pre-token, so every task works alone: no shuffle, and no table of all distinct words anywhere. A task remembers
the counts of up to MOST_WORDS words and then begins anew, which costs time only.

The vocabulary is a sentencepiece model file that is named by path. Pieces of such a BPE model are listed by
rank, not by probability; piece r of n gets the probability 1 / (r + 1), over their sum (Zipf's law). Bytes that
no piece covers count as one token each, at BYTE_SCORE below the rarest piece.

Defined cases
-------------
* null, empty and blank texts: 0 pre-tokens, 0 tokens. Repeated rows and null ids are counted like others.
* an empty table gives an empty result; columns other than doc_id and text are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import arrays

MARK = "▁"
VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
BYTE_SCORE = -5.0
#: Words whose hashes and counts a task remembers between chunks.
MOST_WORDS = 1 << 20
#: Bytes up to which words are scored together; longer ones one by one.
TOGETHER = 64


class Vocabulary:
    """Pieces as bytes, with log-probabilities."""

    def __init__(self, pieces: list[str]):
        total = math.log(sum(1 / (r + 1) for r in range(len(pieces))))
        self.score = {p.encode(): -math.log(r + 1) - total for r, p in reversed(list(enumerate(pieces)))}
        self.longest = max((len(p) for p in self.score), default=1)
        self.unknown = min(self.score.values(), default=0.0) + BYTE_SCORE
        # All ends of pieces by hash: what a piece that ends at some place may look like, read backwards.
        ends = sorted({p[i:] for p in self.score for i in range(len(p))})
        hashes = _hashes_of(ends)
        order = np.argsort(hashes)
        self.end_keys = hashes[order]
        self.end_scores = np.array([self.score.get(e, -np.inf) for e in ends])[order]

    @staticmethod
    def load(path: str) -> Vocabulary:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
        return Vocabulary([model.id_to_piece(i) for i in ids])


def _hashes_of(parts: list[bytes]) -> np.ndarray:
    off = np.cumsum([0, *map(len, parts)])
    chunk = arrays.Chunk(np.frombuffer(b"".join(parts), np.uint8), off, slice(0))
    return chunk.hashes(off[:-1], off[1:])


def best_count(word: bytes, vocabulary: Vocabulary) -> int:
    """Pieces of the best split of one pre-token; the fewest among equally good ones."""
    score, count = [0.0], [0]
    for end in range(1, len(word) + 1):
        best, n = score[-1] + vocabulary.unknown, count[-1] + 1
        for begin in range(end - 1, max(-1, end - vocabulary.longest - 1), -1):
            if (piece := vocabulary.score.get(word[begin:end])) is not None:
                total = score[begin] + piece
                if total > best or (total == best and count[begin] + 1 < n):
                    best, n = total, count[begin] + 1
        score.append(best)
        count.append(n)
    return count[-1]


def trie_counts(chunk: arrays.Chunk, start: np.ndarray, end: np.ndarray, vocabulary: Vocabulary) -> np.ndarray:
    """Pieces of the best split of the pre-tokens of some distinct words of at most TOGETHER bytes."""
    mark = np.frombuffer(MARK.encode(), np.uint8)
    size, m = end - start + len(mark), len(mark)
    width = int(size.max(initial=m))
    place = np.arange(width - m)
    inside = place < (size - m)[:, None]
    rows = np.zeros((len(start), width), np.uint8)
    rows[:, :m] = mark
    rows[:, m:][inside] = chunk.data[(start[:, None] + place)[inside]]

    order = np.argsort(rows.view(f"S{width}").ravel())
    rows, size = rows[order], size[order]
    differs = rows[1:] != rows[:-1]
    shared = np.zeros(len(rows), np.int64)
    shared[1:] = np.where(differs.any(axis=1), differs.argmax(axis=1), width)
    shared[1:] = np.minimum(shared[1:], np.minimum(size[1:], size[:-1]))

    sums, inverses = arrays.row_sums(rows)
    score, count = np.zeros((len(rows), width + 1)), np.zeros((len(rows), width + 1), np.int32)
    here = np.arange(len(rows))
    for depth in range(1, width + 1):
        fresh = (shared < depth) & (size >= depth)
        at = np.flatnonzero(fresh)
        best, n = score[at, depth - 1] + vocabulary.unknown, count[at, depth - 1] + 1
        open_ = np.arange(len(at))  # nodes whose last bytes are still an end of some piece
        for begin in range(depth - 1, max(-1, depth - vocabulary.longest - 1), -1):
            node = at[open_]
            key = arrays.mixed((sums[node, depth] - sums[node, begin]) * inverses[begin])
            found = np.minimum(np.searchsorted(vocabulary.end_keys, key), len(vocabulary.end_keys) - 1)
            on = vocabulary.end_keys[found] == key
            open_, node, found = open_[on], node[on], found[on]
            if not len(open_):
                break
            total, pieces = score[node, begin] + vocabulary.end_scores[found], count[node, begin] + 1
            better = (total > best[open_]) | ((total == best[open_]) & (pieces < n[open_]))
            best[open_[better]], n[open_[better]] = total[better], pieces[better]
        # All leaves below a node get its score.
        node_of = np.maximum.accumulate(np.where(fresh, here, 0))
        full_score, full_count = np.zeros(len(rows)), np.zeros(len(rows), np.int32)
        full_score[at], full_count[at] = best, n
        score[:, depth], count[:, depth] = full_score[node_of], full_count[node_of]
    out = np.zeros(len(rows), np.int64)
    out[order] = count[here, size]
    return out


class Counter:
    """Counts tokens of texts; keeps the counts by word hash from one batch to the next."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.keys, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def _count(self, chunk: arrays.Chunk, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        counts = np.zeros(len(start), np.int64)
        short = np.flatnonzero(end - start <= TOGETHER)
        for block in np.array_split(short, len(short) // 20_000 + 1):
            if len(block):
                counts[block] = trie_counts(chunk, start[block], end[block], self.vocabulary)
        for k in np.flatnonzero(end - start > TOGETHER):
            counts[k] = best_count(MARK.encode() + chunk.data[start[k] : end[k]].tobytes(), self.vocabulary)
        return counts

    def __call__(self, text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Pre-tokens and tokens of every text."""
        words, tokens = np.zeros(len(text), np.int64), np.zeros(len(text), np.int64)
        for chunk in arrays.chunks(text):
            start, end, doc = chunk.words()
            keys, first, back = np.unique(chunk.hashes(start, end), return_index=True, return_inverse=True)
            if len(self.keys) > MOST_WORDS:
                self.keys, self.counts = self.keys[:0], self.counts[:0]
            at = np.searchsorted(self.keys, keys)
            known = np.zeros(len(keys), bool)
            inside = at < len(self.keys)
            known[inside] = self.keys[at[inside]] == keys[inside]
            counts = np.zeros(len(keys), np.int64)
            counts[known] = self.counts[at[known]]
            counts[~known] = self._count(chunk, start[first[~known]], end[first[~known]])
            self.keys = np.insert(self.keys, at[~known], keys[~known])
            self.counts = np.insert(self.counts, at[~known], counts[~known])
            words[chunk.rows] = np.bincount(doc, minlength=chunk.n)
            tokens[chunk.rows] = np.bincount(doc, weights=counts[back], minlength=chunk.n).astype(np.int64)
        return words, tokens


def token_counts(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, text, ...) -> (doc_id, n_pretokens, n_tokens), a row per document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = None
        for batch in batches:
            count = count or Counter(Vocabulary.load(vocabulary))
            words, tokens = count(batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words), pa.array(tokens)], names=["doc_id", "n_pretokens", "n_tokens"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_pretokens long, n_tokens long")

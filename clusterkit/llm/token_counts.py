"""Token counts by rank-synchronous merging in ragged arrays.

All new pieces of a batch lie one after another in one array of symbols. Each round looks up the
rank of every neighbouring pair, takes each piece's lowest, and merges all its occurrences in all
pieces at once; pieces without a pair that can merge leave the array. What survives is counted.
A piece's result never depends on the others in the batch.

Merging every occurrence of a piece's lowest pair in one round equals merging one at a time:
a pair that a merge creates contains the new symbol and so has a higher rank.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from clusterkit.llm.common import id_and_text, map_rows
from clusterkit.llm.pretoken import PieceTable, Vocabulary, blocks, vocabulary


class Merger:
    """Merge tables as arrays, and the rounds over them."""

    def __init__(self, vocab: Vocabulary):
        self.byte_id = np.array([vocab.id_of[bytes([b])] for b in range(256)], np.int64)
        pairs = sorted((a << 32 | b, vocab.rank[whole], whole) for (a, b), whole in vocab.merge.items())
        # One entry beyond the last key, so that a search always lands on an entry.
        self.key = np.array([k for k, _, _ in pairs] + [1 << 62], np.int64)
        self.rank = np.array([r for _, r, _ in pairs] + [1 << 40], np.int64)
        self.whole = np.array([w for _, _, w in pairs] + [-1], np.int64)
        self.none = 1 << 40

    def counts(self, words: list[bytes]) -> np.ndarray:
        """Symbols that survive of each word; an empty word has none."""
        size = np.array([len(w) for w in words], np.int64)
        out = size.copy()
        symbol = self.byte_id[np.frombuffer(b"".join(words), np.uint8)]
        owner = np.repeat(np.arange(len(words)), size)
        while len(symbol) > 1:
            key = symbol[:-1] << 32 | symbol[1:]
            at = np.searchsorted(self.key, key)
            rank = np.where((self.key[at] == key) & (owner[:-1] == owner[1:]), self.rank[at], self.none)
            first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            lowest = np.minimum.reduceat(np.r_[rank, self.none], first)
            length = np.diff(np.r_[first, len(symbol)])
            hit = np.flatnonzero((rank == np.repeat(lowest, length)[:-1]) & (rank < self.none))
            # Of overlapping hits (a a a) the first, third ... of each run are merged.
            run = np.flatnonzero(np.r_[True, np.diff(hit) != 1]) if len(hit) else hit
            place = np.arange(len(hit)) - np.repeat(run, np.diff(np.r_[run, len(hit)]))
            # Neighbouring hits overlap only where all three symbols are the same.
            same = symbol[hit] == symbol[np.minimum(hit + 1, len(symbol) - 1)]
            hit = hit[~same | (place % 2 == 0)]
            symbol[hit] = self.whole[at[hit]]
            stay = np.ones(len(symbol), bool)
            stay[hit + 1] = False
            np.subtract.at(out, owner[hit], 1)
            stay &= np.repeat(lowest < self.none, length)
            symbol, owner = symbol[stay], owner[stay]
        return out


@lru_cache(2)
def merger(path: str) -> Merger:
    return Merger(vocabulary(path))


@lru_cache(2)
def count_table(path: str) -> PieceTable:
    def fill(new: list[str]) -> list[int]:
        out: list[int] = []
        for run in blocks(new, 1_000_000):
            out += merger(path).counts([piece.encode() for piece in run]).tolist()
        return out

    return PieceTable(vocabulary(path), fill, lambda i: 1)


def token_counts(docs: DataFrame, path: str, limit: int = 1024, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """Columns doc_id, n_bytes, n_tokens, over_limit, one row for each row of ``docs``.

    ``over_limit``: more than ``limit`` tokens. Null texts are empty: 0 bytes, 0 tokens. Null ids
    stay null, repeated rows are counted each, other columns are not read.
    """
    def make():
        def work(batch: pa.RecordBatch) -> list:
            known = count_table(path)
            texts = batch.column("text").to_pylist()
            count = [sum(map(known.__getitem__, split)) for run in blocks(texts) for split in known.learn(run)]
            return [batch.column("doc_id"), [len(t.encode()) for t in texts], count,
                    [n > limit for n in count]]

        return work

    return map_rows(
        id_and_text(docs, id_col, text_col), make,
        "doc_id long, n_bytes long, n_tokens long, over_limit boolean",
        pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()),
                   ("over_limit", pa.bool_())]))

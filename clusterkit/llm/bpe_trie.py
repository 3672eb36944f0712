"""BPE encoding by a prefix-sharing trie, and decoding.

In byte-level BPE the encoding of a prefix is a prefix of some encoding path: for every prefix
there is exactly one last token t such that the prefix without t, encoded, still ends in a token
beside which t survives. The state of a trie node is that last token. The distinct new pieces of a
batch form a trie; walked depth first, each node's state follows from the states above it, and a
prefix that many words share is worked out once. A word's encoding is read off by stepping back
from its node, a token at a time.

The trie is held as its sorted words: sorted order is depth-first order, the common prefix of two
neighbours says how far to climb back, and the states of the open path are one list. So memory is
that of the batch's words even where one of them is very long.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from clusterkit.llm.common import id_and_text, map_rows
from clusterkit.llm.pretoken import PieceTable, Vocabulary, blocks, vocabulary

NEVER = 1 << 60


class TrieEncoder:
    """Encodes words by the last-token states of their prefixes."""

    def __init__(self, vocab: Vocabulary):
        self.vocab = vocab
        ends: dict[bytes, set[int]] = {}
        for token in vocab.id_of:
            if len(token) > 1:
                ends.setdefault(token[-2:], set()).add(len(token))
        #: By the last two bytes of a prefix, the lengths that a last token can have.
        self.lengths = {end: sorted(n, reverse=True) for end, n in ends.items()}
        self.beside: dict[tuple[int, int], bool] = {}
        self.alone: dict[int, bool] = {}

    def survive(self, a: int, b: int, limit: int = NEVER) -> bool:
        """Whether no merge of rank below ``limit`` joins the end of a to the start of b.

        The merges that built the two are undone, latest first. In between, each pair of the
        symbols that face each other lives until the first of the two is merged away; it must not
        be a merge of lower rank. On equal ranks the merge further left comes first.
        """
        v = self.vocab
        a_until = b_until = limit
        while True:
            whole = v.merge.get((a, b))
            if whole is not None and v.rank[whole] < a_until and v.rank[whole] <= b_until:
                if v.rank[whole] < limit:
                    return False
            if v.rank[a] < 0 and v.rank[b] < 0:
                return True
            if v.rank[a] > v.rank[b]:
                a_until, a = v.rank[a], v.halves[a][1]
            else:
                b_until, b = v.rank[b], v.halves[b][0]

    def whole(self, t: int) -> bool:
        """Whether the bytes of a token encode to that token."""
        known = self.alone.get(t)
        if known is None:
            a, b = self.vocab.halves[t]
            known = a < 0 or (self.whole(a) and self.whole(b)
                              and self.survive(a, b, self.vocab.rank[t]))
            self.alone[t] = known
        return known

    def encode(self, words: list[bytes]) -> dict[bytes, list[int]]:
        ids, size_of = self.vocab.id_of, self.vocab.bytes_of
        lengths, beside = self.lengths, self.beside
        last: list[int] = []  # of each prefix of the open path
        before = b""
        out: dict[bytes, list[int]] = {}
        for word in sorted(set(words)):
            depth, most = 0, min(len(before), len(word))
            while depth < most and before[depth] == word[depth]:
                depth += 1
            del last[depth:]
            for d in range(depth + 1, len(word) + 1):
                for n in lengths.get(word[d - 2:d], ()) if d > 1 else ():
                    if n > d:
                        continue
                    t = ids.get(word[d - n:d])
                    if t is None:
                        continue
                    if n == d:
                        if self.whole(t):
                            break
                        continue
                    pair = (last[d - n - 1], t)
                    fits = beside.get(pair)
                    if fits is None:
                        fits = beside[pair] = self.survive(*pair)
                    if fits:
                        break
                else:
                    t = ids[word[d - 1:d]]
                last.append(t)
            back, d = [], len(word)
            while d:
                back.append(last[d - 1])
                d -= len(size_of[last[d - 1]])
            out[word] = back[::-1]
            before = word
        if len(beside) > 2_000_000:  # repeated work only
            beside.clear()
        return out


@lru_cache(2)
def encoder(path: str) -> TrieEncoder:
    return TrieEncoder(vocabulary(path))


@lru_cache(2)
def id_table(path: str) -> PieceTable:
    """Of each piece its ids as little-endian unsigned 32-bit integers."""
    def fill(new: list[str]) -> list[bytes]:
        keys = [piece.encode() for piece in new]
        found = encoder(path).encode(keys)
        return [np.array(found[k], "<u4").tobytes() for k in keys]

    return PieceTable(vocabulary(path), fill, lambda i: np.array([i], "<u4").tobytes())


def encode_texts(texts: list[str], path: str) -> list[bytes]:
    """The ids of each text, as little-endian unsigned 32-bit integers."""
    out: list[bytes] = []
    known = id_table(path)
    for run in blocks(texts):
        out += [b"".join(map(known.__getitem__, split)) for split in known.learn(run)]
    return out


def decode_ids(ids: bytes, path: str) -> str:
    """The text of ids; bytes that are no UTF-8 become replacement characters."""
    of = vocabulary(path).bytes_of
    return b"".join(map(of.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


def bpe_encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Columns doc_id, ids (array of int), one row for each row of ``docs``.

    Null texts are empty and have no ids; null ids of documents stay null; repeated rows are
    encoded as often; other columns are not read.
    """
    def make():
        def work(batch: pa.RecordBatch) -> list:
            got = encode_texts(batch.column("text").to_pylist(), path)
            ends = np.cumsum([0, *(len(x) // 4 for x in got)])
            flat = np.frombuffer(b"".join(got), "<i4")
            return [batch.column("doc_id"), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))]

        return work

    return map_rows(id_and_text(docs, id_col, text_col), make, "doc_id long, ids array<int>",
                    pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))]))


def bpe_decode(encoded: DataFrame, path: str) -> DataFrame:
    """Columns doc_id, text from doc_id, ids; null or no ids give an empty text, null doc_ids stay null,
    repeated rows are decoded as often, other columns are not read, an empty table gives no rows."""
    def make():
        def work(batch: pa.RecordBatch) -> list:
            ids = [np.array(x or [], "<u4").tobytes() for x in batch.column("ids").to_pylist()]
            return [batch.column("doc_id"), [decode_ids(x, path) for x in ids]]

        return work

    return map_rows(encoded.select("doc_id", "ids"), make, "doc_id long, text string",
                    pa.schema([("doc_id", pa.int64()), ("text", pa.string())]))


def bpe_digest(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Columns doc_id, n_tokens, ids_sha256, decoded_sha256: encoded and decoded in one pass."""
    def make():
        def work(batch: pa.RecordBatch) -> list:
            count, ids, text = [], [], []
            for run in blocks(batch.column("text").to_pylist()):
                for got in encode_texts(run, path):
                    count.append(len(got) // 4)
                    ids.append(hashlib.sha256(got).hexdigest())
                    text.append(hashlib.sha256(decode_ids(got, path).encode()).hexdigest())
            return [batch.column("doc_id"), count, ids, text]

        return work

    return map_rows(
        id_and_text(docs, id_col, text_col), make,
        "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string",
        pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()),
                   ("decoded_sha256", pa.string())]))

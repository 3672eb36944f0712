"""Cross-tokenizer alignment: which tokens of one tokenizer stand for which of another.

Both tokenizers cut the same bytes, so a byte at which a token of each ends is a common cut. Divide and
conquer finds them: in an interval that begins and ends at common cuts take the ends of A's tokens
from the middle outwards and look each up among B's ends by bisection; at the first that is there the
interval falls into two, which are treated alike; an interval without one is a leaf, a group of tokens
that belong together. The halves of all intervals of a chunk of documents are treated level by level, so
each step is a few operations on arrays, and a document's own end is the first common cut.

A token of A and one of B are linked if their byte ranges overlap. A pair's count is the number of
documents that hold it linked. Tokens are encoded once: a chunk's documents are written with each link
as a place in the chunk's list of different pairs, and only those lists are shuffled to be counted and
joined back, one row for each chunk and pair however often it occurs in it.

Null and empty texts, and texts whose tokens do not spell a space and the text (B knows no U+2581 but
as a space), have no tokens and zeros in all counts. Null ids stay null, repeated rows are documents of
their own, other columns are not read; an empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clusterkit.llm.common import BATCH_ROWS, id_and_text, written
from clusterkit.llm.pretoken import rank_encoding, vocabulary

#: Characters of a chunk at least, unless the task has fewer: bounds memory, but for a longer document.
CHUNK_CHARS = 2_000_000


# -- the two tokenizers -------------------------------------------------------------------------


@dataclass(frozen=True)
class Side:
    """A tokenizer: ids of a text, the bytes that ids spell, and those of each id."""

    encode: Callable[[str], list[int]]
    spell: Callable[[list[int]], bytes]
    bytes_of: list[bytes]
    lengths: np.ndarray


def _side(encode, spell, bytes_of: list[bytes]) -> Side:
    return Side(encode, spell, bytes_of, np.array([len(b) for b in bytes_of], dtype="int64"))


@lru_cache(2)
def byte_side(path: str) -> Side:
    """A byte-level BPE file; special strings in a text are ordinary text."""
    known = rank_encoding(path)
    return _side(known.encode_ordinary, known.decode_bytes, vocabulary(path).bytes_of)


@lru_cache(2)
def piece_side(path: str) -> Side:
    """A sentencepiece file, which puts the space before a text itself."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    bytes_of = [bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode()
                for i, p in enumerate(map(model.id_to_piece, range(model.get_piece_size())))]

    # Text by text: a list goes through a pool of threads, which takes a quarter longer even with one.
    return _side(model.encode, lambda ids: b"".join(map(bytes_of.__getitem__, ids)), bytes_of)


# -- common cuts --------------------------------------------------------------------------------


def common_cuts(ends_a: np.ndarray, ends_b: np.ndarray, first_a: np.ndarray, first_b: np.ndarray
                ) -> tuple[np.ndarray, np.ndarray]:
    """Places (in A's and in B's ends, both ascending) of all common ends.

    ``first_a``, ``first_b``: where the tokens of each document begin, and their number at the end;
    the last ends of a document are equal."""
    nonempty = np.flatnonzero(np.diff(first_a))
    a0, a1 = first_a[nonempty], first_a[nonempty + 1] - 1  # interval: tokens a0 to a1, ends shared at a1
    b0, b1 = first_b[nonempty], first_b[nonempty + 1] - 1
    found_a, found_b = [a1], [b1]
    while len(a0):
        width = a1 - a0  # ends inside the interval
        open_ = np.flatnonzero((width > 0) & (b1 > b0))
        middle = (a0 + a1 - 1) // 2
        cut_at, cut_b, whose = [], [], []
        step = 0
        while len(open_):
            # middle, then one after and one before it, and so on outwards
            move = (step + 1) // 2 * (1 if step % 2 else -1)
            probe = middle[open_] + move
            inside = (probe >= a0[open_]) & (probe < a1[open_])
            at, of = probe[inside], open_[inside]
            place = np.searchsorted(ends_b, ends_a[at])
            hit = ends_b[place] == ends_a[at]
            cut_at.append(at[hit])
            cut_b.append(place[hit])
            whose.append(of[hit])
            done = np.zeros(len(a0), dtype=bool)
            done[of[hit]] = True
            step += 1
            open_ = open_[~done[open_] & (width[open_] > step)]
        if not whose:
            break
        i, j, w = np.concatenate(cut_at), np.concatenate(cut_b), np.concatenate(whose)
        found_a.append(i)
        found_b.append(j)
        a0, a1, b0, b1 = (np.concatenate(x) for x in (
            (a0[w], i + 1), (i, a1[w]), (b0[w], j + 1), (j, b1[w])))
        order = np.argsort(a0, kind="stable")  # neighbours stay near each other in memory
        a0, a1, b0, b1 = a0[order], a1[order], b0[order], b1[order]
    i, j = np.concatenate(found_a), np.concatenate(found_b)
    return np.sort(i), np.sort(j)


@dataclass
class Aligned:
    """Documents of a chunk: tokens of both sides, places of the groups' ends among them, and links."""

    a: np.ndarray
    b: np.ndarray
    first_a: np.ndarray
    first_b: np.ndarray
    cut_a: np.ndarray
    cut_b: np.ndarray
    link_a: np.ndarray
    link_b: np.ndarray
    first_link: np.ndarray
    first_group: np.ndarray


def _tokens(texts: list[str], sides: tuple[Side, Side]) -> list[list[np.ndarray]]:
    """Of each side the ids of each text; none for a text that the ids of either do not spell."""
    none = np.zeros(0, dtype="int64")
    out: list[list[np.ndarray]] = [[], []]
    for text in texts:
        spaced = " " + text
        both = [side.encode(given) if text else [] for side, given in zip(sides, (spaced, text))]
        spelled = text and all(side.spell(ids) == spaced.encode() for side, ids in zip(sides, both))
        for ids, into in zip(both, out):
            into.append(np.array(ids, dtype="int64") if spelled else none)
    return out


def _before(marks: np.ndarray) -> np.ndarray:
    """How many marks there are before each place."""
    return np.cumsum(marks, dtype="int64") - marks


def align_texts(texts: list[str], sides: tuple[Side, Side]) -> Aligned:
    tokens = _tokens(texts, sides)
    firsts = [np.cumsum([0, *map(len, ids)]) for ids in tokens]
    a, b = (np.concatenate([np.zeros(0, "int64"), *ids]) for ids in tokens)
    ends_a, ends_b = np.cumsum(sides[0].lengths[a]), np.cumsum(sides[1].lengths[b])
    cut_a, cut_b = common_cuts(ends_a, ends_b, *firsts)
    # Each stretch between neighbouring ends of either side is the overlap of one linked pair. An end's
    # two low bits say whose it is, so a token's place is the number of its side's ends before.
    shared = np.zeros(len(b), dtype=bool)
    shared[cut_b] = True
    coded = ends_a << 2 | 1
    coded[cut_a] |= 2
    ends = np.concatenate([coded, ends_b[~shared] << 2 | 2])
    ends.sort(kind="stable")
    link_a, link_b = _before(ends & 1), _before(ends >> 1 & 1)
    return Aligned(a, b, *firsts, cut_a, cut_b, link_a, link_b,
                   np.searchsorted(link_a, firsts[0]), np.searchsorted(cut_a, firsts[0]))


@lru_cache(2)
def _decimals(size_a: int, size_b: int) -> list[bytes]:
    """Ids of A before a comma and before a bar, ids of B before a comma and before a semicolon."""
    return [b"%d%s" % (i, sign) for size, signs in ((size_a, (b",", b"|")), (size_b, (b",", b";")))
            for sign in signs for i in range(size)]


def group_digests(found: Aligned, sides: tuple[Side, Side]) -> list[str]:
    """SHA-256 of each document's groups as ``a1,a2|b1;a3|b2,b3``; empty without tokens."""
    size_a, size_b = (len(s.bytes_of) for s in sides)
    words = _decimals(size_a, size_b)
    # A token's place in the line: its own side's tokens before it, and the other's of earlier groups.
    last_a, last_b = np.zeros(len(found.a), dtype=bool), np.zeros(len(found.b), dtype=bool)
    last_a[found.cut_a], last_b[found.cut_b] = True, True
    group_a, group_b = _before(last_a), _before(last_b)
    before_b = np.concatenate([[0], found.cut_b + 1])
    code = np.empty(len(found.a) + len(found.b), dtype="int64")
    code[np.arange(len(found.a)) + before_b[group_a]] = found.a + size_a * last_a
    code[np.arange(len(found.b)) + found.cut_a[group_b] + 1] = 2 * size_a + found.b + size_b * last_b
    first = found.first_a + found.first_b
    out = []
    for begin, end in zip(first[:-1].tolist(), first[1:].tolist()):
        line = b"".join([words[c] for c in code[begin:end].tolist()])
        out.append(hashlib.sha256(line[:-1]).hexdigest() if line else "")
    return out


# -- over tables --------------------------------------------------------------------------------


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[str]]]:
    ids, texts, held = [], [], 0
    for batch in batches:
        for i, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
            ids.append(i)
            texts.append(text)
            held += len(text)
            if held >= CHUNK_CHARS:
                yield ids, texts
                ids, texts, held = [], [], 0
    if ids:
        yield ids, texts


def _lists(values: np.ndarray, first: np.ndarray, kind: pa.DataType = pa.int32()) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(values, kind))


def _sides(path_a: str, path_b: str) -> tuple[Side, Side]:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return byte_side(path_a), piece_side(path_b)


def alignments(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Columns doc_id, a_ids, b_ids, and of each group the number of tokens up to its end, a_ends, b_ends."""
    schema = pa.schema([("doc_id", pa.int64()), *((c, pa.list_(pa.int32())) for c in ("a_ids", "b_ids", "a_ends", "b_ends"))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides = _sides(path_a, path_b)
        for ids, texts in _chunks(batches):
            x = align_texts(texts, sides)
            groups = np.diff(x.first_group)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), _lists(x.a, x.first_a), _lists(x.b, x.first_b),
                 _lists(x.cut_a + 1 - np.repeat(x.first_a[:-1], groups), x.first_group),
                 _lists(x.cut_b + 1 - np.repeat(x.first_b[:-1], groups), x.first_group)], schema=schema)

    return _batched(docs, id_col, text_col).mapInArrow(
        run, "doc_id long, a_ids array<int>, b_ids array<int>, a_ends array<int>, b_ends array<int>")


def _batched(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return id_and_text(docs, id_col, text_col)


COUNTS = ("n_a", "n_b", "n_groups", "n_links")
#: Rows of documents, and for each chunk one row with its different pairs and their documents.
_CHUNK_SCHEMA = pa.schema([
    ("chunk", pa.int64()), ("doc_id", pa.int64()), *((c, pa.int64()) for c in COUNTS), ("groups_sha256", pa.string()),
    ("links", pa.list_(pa.int32())), ("pairs", pa.list_(pa.int64())), ("holders", pa.list_(pa.int64()))])
_CHUNK_TYPES = ("chunk long, doc_id long, " + ", ".join(f"{c} long" for c in COUNTS)
                + ", groups_sha256 string, links array<int>, pairs array<long>, holders array<long>")


def _encoded(docs: DataFrame, path_a: str, path_b: str, id_col: str, text_col: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        sides = _sides(path_a, path_b)
        task = TaskContext.get().partitionId() << 32
        for n, (ids, texts) in enumerate(_chunks(batches)):
            x = align_texts(texts, sides)
            size = len(ids)
            pairs, place = np.unique(x.a[x.link_a] << 32 | x.b[x.link_b], return_inverse=True)
            links = np.diff(x.first_link)
            held = np.unique(place * size + np.repeat(np.arange(size), links)) // size
            chunk = pa.array(np.full(size, task + n))
            none = pa.nulls(size, pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [chunk, pa.array(ids, pa.int64()), np.diff(x.first_a), np.diff(x.first_b), np.diff(x.first_group), links,
                 pa.array(group_digests(x, sides)), _lists(place, x.first_link), none, none], schema=_CHUNK_SCHEMA)
            empty = [pa.nulls(1, _CHUNK_SCHEMA.field(i).type) for i in range(1, 8)]
            ends = np.array([0, len(pairs)])
            yield pa.RecordBatch.from_arrays(
                [chunk[:1], *empty, _lists(pairs, ends, pa.int64()),
                 _lists(np.bincount(held, minlength=len(pairs)), ends, pa.int64())], schema=_CHUNK_SCHEMA)

    return _batched(docs, id_col, text_col).mapInArrow(run, _CHUNK_TYPES)


def pair_counts(pairs: DataFrame) -> DataFrame:
    """pair, count, best (whether it is the highest of its A id) from rows of pair, holders. A window
    holds the pairs of one A id, at most as many as B has ids."""
    counts = pairs.groupBy("pair").agg(F.sum("holders").alias("count"))
    of_a = Window.partitionBy(F.shiftright("pair", 32))
    return counts.withColumn("best", F.col("count") == F.max("count").over(of_a))


def alignment_report(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each document: doc_id, n_a, n_b, n_groups, n_links, n_best (links whose count is
    the highest of their A id), count_sum (over links), groups_sha256."""
    chunks = written(_encoded(docs, path_a, path_b, id_col, text_col), "alignment")
    listed = chunks.where("pairs IS NOT NULL").select("chunk", F.posexplode(F.arrays_zip("pairs", "holders")))
    listed = listed.select("chunk", F.col("pos").alias("place"), F.col("col.pairs").alias("pair"), F.col("col.holders").alias("holders"))
    counted = listed.select("chunk", "place", "pair").join(pair_counts(listed), "pair").select(
        F.col("chunk").alias("of"), "place", "count", "best")
    texts = chunks.where("links IS NOT NULL").select("chunk", "doc_id", *COUNTS, "groups_sha256", "links")
    names = ["doc_id", *COUNTS, "groups_sha256"]
    schema = pa.schema([*(_CHUNK_SCHEMA.field(c) for c in names), ("n_best", pa.int64()), ("count_sum", pa.int64())])

    def sums(left: pa.Table, right: pa.Table) -> pa.Table:
        place = right["place"].to_numpy()
        value, best = np.zeros(len(place), "int64"), np.zeros(len(place), "int64")
        value[place] = right["count"].to_numpy()
        best[place] = right["best"].to_numpy()
        links = left["links"].combine_chunks()
        links = links.chunk(0) if isinstance(links, pa.ChunkedArray) else links
        at = links.flatten().to_numpy()
        first = np.cumsum([0, *np.diff(links.offsets.to_numpy())])
        totals = [np.diff(np.concatenate([[0], np.cumsum(x[at])])[first]) for x in (best, value)]
        return pa.table([*(left[c] for c in names), *map(pa.array, totals)], schema=schema)

    return texts.groupBy("chunk").cogroup(counted.groupBy("of")).applyInArrow(
        sums, "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS)
        + ", groups_sha256 string, n_best long, count_sum long")

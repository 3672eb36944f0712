"""Exact repeats of byte strings across all texts, by enhanced suffix arrays over shared places.

Every string of ``length`` bytes has an anchor: the leftmost smallest hash of its ``GRAM``-byte
grams. Equal strings have equal anchors, so a text is cut into pieces, each the run of starts with
one anchor and the bytes of their strings, and only pieces of one anchor can hold equal strings:

1. Pieces are counted by content, which settles copies: a piece met twice is repeated whole.
2. The distinct pieces of an anchor go to one task. Bytes in no string whose hash is met twice there
   cannot be repeated and are left out. A suffix array with common-prefix lengths is built over
   the rest; a stack scan walks its tree of common-prefix intervals. An interval of at
   least ``length`` whose occurrences differ in the byte to the left is a maximal repeat, and all
   its occurrences are marked over the interval's length. A repeat that can be extended to
   the left is part of one that cannot, with the same occurrences, so nothing is lost.
3. An anchor with more than ``CROWD`` distinct pieces, such as the edge of a passage that very many
   texts share, never goes to one task: its pieces are cut into shorter runs of starts, grouped by
   the bytes that all strings of a run have in common, and these are settled in the same way; at
   last runs of one start, which counting alone settles.

Positions are bytes of UTF-8. Text is shuffled twice, once to take out the pieces of step 2 and
once to apply what was found; all else are hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clusterkit.llm.common import BATCH_ROWS, id_and_text, written

GRAM = 32
CROWD = 1000
#: Starts of a piece at each level of splitting; the first is bounded by the anchor's window.
WIDTHS = (None, 32, 1)
#: Bytes whose suffix array a task holds at a time, and positions hashed at a time.
BLOCK, SEGMENT = 1 << 20, 1 << 21


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


_BYTES = _mixed(np.arange(1, 257, dtype=np.uint64))


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A hash of each ``gram`` bytes (a power of two), by joining halves."""
    h = _mixed(data.astype(np.uint64) + np.uint64(1))
    size = 1
    while size < gram:
        h = _mixed(h[:-size] * np.uint64(0xD6E8FEB86659FD93) + h[size:])
        size *= 2
    return h


def _window_min(key: np.ndarray, width: int) -> np.ndarray:
    n = len(key) - width + 1
    padded = np.full(-(-len(key) // width) * width, np.uint64(0xFFFFFFFFFFFFFFFF))
    padded[:len(key)] = key
    rows = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1:width - 1 + n])


def _name(data) -> bytes:
    return xxhash.xxh3_128_digest(data)


def _number(name: bytes) -> int:
    return int.from_bytes(name[:8], "little", signed=True)


def cut_pieces(text: bytes, length: int, gram: int) -> list[tuple]:
    """(at, starts, anchor, group, piece) of the runs of starts with one anchor, in order.

    ``anchor`` is its distance from ``at``, ``group`` its hash, ``piece`` the hash of the bytes of
    all strings that start in the run.
    """
    out = []
    low = np.uint64((1 << 22) - 1)
    view = memoryview(text)
    for base in range(0, len(text) - length + 1, SEGMENT):
        part = np.frombuffer(text, np.uint8)[base:base + SEGMENT + length - 1]
        h = gram_hashes(part, gram)
        place = np.arange(len(h), dtype=np.uint64)
        anchor = (_window_min((h & ~low) | place, length - gram + 1) & low).astype(np.int64)
        first = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
        size = np.diff(np.r_[first, len(anchor)])
        to = anchor[first]
        group = h[to].view(np.int64)
        for a, n, k, g in zip(first.tolist(), size.tolist(), to.tolist(), group.tolist()):
            out.append((a + base, n, k - a, g, _name(view[base + a:base + a + n + length - 1])))
    return out


def split_piece(data: bytes, length: int, anchor: int, width: int) -> list[tuple]:
    """A piece cut into shorter pieces: (at, starts, anchor, group, piece).

    Equal strings of two pieces with one anchor lie at the same distance before it. So the starts
    are cut by that distance, ``width`` at a time, and the runs are grouped by the bytes that any
    string at these distances holds.
    """
    out = []
    last = len(data) - length
    for k in range((anchor - last) // width, anchor // width + 1):
        a, b = max(0, anchor - (k + 1) * width + 1), min(last, anchor - k * width)
        if a <= b:
            core = data[anchor - k * width:anchor - (k + 1) * width + 1 + length]
            group = _name(core + k.to_bytes(4, "little") if width > 1 else core)
            out.append((a, b - a + 1, 0, _number(group), _name(data[a:b + length])))
    return out


def _ranked(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of keys, and of each key its rank from 1, with a 0 put at the end."""
    order = np.argsort(key)
    sorted_key = key[order]
    rank = np.empty(len(key) + 1, np.int32)
    rank[order] = np.cumsum(np.r_[True, sorted_key[1:] != sorted_key[:-1]])
    rank[-1] = 0
    return order, rank


def suffix_array(chunks: list[bytes], least: int = 1) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of all suffixes of at least ``least`` bytes: order, common prefix with the one before, and,
    of each byte, its chunk and place in it.

    A suffix ends with its chunk; of two that are equal as far as the shorter goes, the shorter
    comes first. Ranks by the first 7 bytes are tripled in depth, three joined to one, until they
    cover the longest chunk; the common prefixes are read off the ranks of all depths, longest
    first. Three ranks fit one integer up to 2 million bytes.
    """
    size = np.array([len(c) for c in chunks], np.int64)
    n = int(size.sum())
    if n >= 1 << 21:
        raise ValueError("a block of chunks must be under 2 MB")
    text = np.frombuffer(b"".join(chunks), np.uint8)
    owner = np.repeat(np.arange(len(chunks), dtype=np.int32), size)
    end = np.repeat(np.cumsum(size), size)  # of the chunk that each byte is in
    at = np.arange(n)
    padded = np.append(text.astype(np.int64) + 1, 0)
    pack = np.zeros(n, np.int64)
    for k in range(7):
        pack = pack * 257 + padded[np.where(at + k < end, at + k, n)]
    order, rank = _ranked(pack)
    levels, depth = [(7, rank)], 7
    while depth < size.max(initial=0):
        key = rank[:-1].astype(np.int64)
        for k in (1, 2):
            key = (key << 21) + rank[np.where(at + k * depth < end, at + k * depth, n)]
        order, rank = _ranked(key)
        depth *= 3
        levels.append((depth, rank))
    order = order[end[order] - order >= least]
    i, j = order[:-1], order[1:]
    left = np.minimum(end[i] - i, end[j] - j)
    same = np.zeros(len(i), np.int64)
    for depth, rank in reversed(levels):
        for _ in range(1 if depth == levels[-1][0] else 2):
            hit = np.flatnonzero(same < left)
            hit = hit[rank[i[hit] + same[hit]] == rank[j[hit] + same[hit]]]
            # Equal ranks mean equal bytes for this depth, or equal suffixes that end before.
            same[hit] = np.minimum(same[hit] + depth, left[hit])
    for _ in range(6):
        hit = np.flatnonzero(same < left)
        hit = hit[text[i[hit] + same[hit]] == text[j[hit] + same[hit]]]
        same[hit] += 1
    return order, np.append(0, same)[:len(order)], owner, at - (end - size[owner])


def maximal_repeats(chunks: list[bytes], length: int) -> Iterator[tuple[int, list[tuple[int, int]]]]:
    """(common length, all occurrences as (chunk, place)) of each maximal repeat of at least
    ``length`` bytes: a node of the common-prefix interval tree whose occurrences differ in the
    byte to their left, the start of a chunk counting as a byte of its own."""
    if not chunks or max(map(len, chunks)) < length:
        return
    order, same, owner, place = suffix_array(chunks, length)
    text = np.frombuffer(b"".join(chunks), np.uint8)
    before = np.where(place[order] > 0, text[order - 1].astype(np.int64), -1 - owner[order])
    where = list(zip(owner[order].tolist(), place[order].tolist()))
    # changes[i]: places up to i where the byte to the left differs from the suffix before.
    changes = np.append(0, np.cumsum(before[1:] != before[:-1])).tolist()
    for low, high, common in intervals(same, length):
        if changes[high] != changes[low] or before[low] < 0:
            yield common, where[low:high + 1]


def intervals(same: np.ndarray, least: int) -> Iterator[tuple[int, int, int]]:
    """(first, last, common length) of the tree's nodes of at least ``least``, children before
    parents, by one scan with a stack. ``same[i]`` belongs to suffixes i - 1 and i."""
    deep = np.flatnonzero(same >= least)
    values = same[deep].tolist()
    stack: list[tuple[int, int]] = []  # (common length, first suffix)
    past = -2
    for i, value in zip(deep.tolist(), values):
        if i != past + 1:
            while stack:
                common, low = stack.pop()
                yield low, past, common
        low = i - 1
        while stack and stack[-1][0] > value:
            common, low = stack.pop()
            yield low, i - 1, common
        if not stack or stack[-1][0] < value:
            stack.append((value, low))
        past = i
    while stack:
        common, low = stack.pop()
        yield low, past, common


def merged(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Runs (start, end) as the fewest that cover the same places, in order."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(runs):
        if out and a <= out[-1][1]:
            if b > out[-1][1]:
                out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
    return out


def string_hashes(data: np.ndarray, length: int) -> np.ndarray:
    """A hash of each ``length`` bytes: a polynomial modulo 2^64, from its sums up to each byte."""
    powers = np.cumprod(np.full(len(data), 0x9E3779B97F4A7C15, np.uint64))
    sums = np.append(np.uint64(0), np.cumsum(_BYTES[data] * powers))
    return (sums[length:] - sums[:-length]) * powers[::-1][:len(data) - length + 1]


def shared_parts(chunks: list[bytes], length: int) -> list[tuple[int, int, bytes]]:
    """(chunk, place, bytes) of the parts of chunks made of strings of ``length`` bytes whose hash
    is met twice. Equal strings have equal hashes, so every repeat lies within one part, and what
    shares a hash without being equal only stays in to be told apart later. Parts do not overlap."""
    size = np.array([len(c) for c in chunks], np.int64)
    if size.max(initial=0) < length:
        return []
    begin = np.cumsum(size) - size
    data = np.frombuffer(b"".join(chunks), np.uint8)
    whole = np.repeat(begin + size, size)[:len(data) - length + 1]
    at = np.flatnonzero(whole - np.arange(len(whole)) >= length)  # strings that end with their chunk at the latest
    key = string_hashes(data, length)[at]
    order = np.argsort(key)
    twin = np.flatnonzero(key[order[1:]] == key[order[:-1]])
    kept = np.zeros(len(at), bool)
    kept[order[twin]] = kept[order[twin + 1]] = True
    at = at[kept]
    if not len(at):
        return []
    apart = np.flatnonzero(np.diff(at) >= length)
    first, last = at[np.r_[0, apart + 1]], at[np.r_[apart, len(at) - 1]] + length
    chunk = np.searchsorted(begin, first, "right") - 1
    place = first - begin[chunk]
    return [(c, a, chunks[c][a:a + n]) for c, a, n in zip(chunk.tolist(), place.tolist(), (last - first).tolist())]


def repeated_runs(chunks: list[bytes], length: int) -> list[list[tuple[int, int]]]:
    """Of each chunk the runs (start, end) that maximal repeats cover."""
    found: list[list[tuple[int, int]]] = [[] for _ in chunks]
    parts = shared_parts(chunks, length)
    for common, places in maximal_repeats([p[2] for p in parts], length):
        for part, at in places:
            chunk, base, _ = parts[part]
            at += base
            runs = found[chunk]
            if runs and runs[-1][0] <= at and at + common <= runs[-1][1]:
                continue
            runs.append((at, at + common))
    return [merged(runs) for runs in found]


RUNS = "array<struct<start:int,end:int>>"
_run_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
_piece_type = pa.list_(pa.struct([("at", pa.int32()), ("starts", pa.int32()), ("anchor", pa.int32()),
                                  ("group", pa.int64()), ("piece", pa.binary())]))
_PIECE = "array<struct<at:int,starts:int,anchor:int,group:long,piece:binary>>"


def _batch(columns: list, names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(columns, names)


def _pieces(rows: list[list[tuple]]) -> pa.Array:
    flat = [p for r in rows for p in r]
    columns = list(zip(*flat)) or [[]] * 5
    values = pa.StructArray.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, _piece_type.value_type)], fields=list(_piece_type.value_type))
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, rows)]), pa.int32()), values)


def _settle(pieces: DataFrame, with_text: Callable[[DataFrame], DataFrame], length: int, level: int) -> DataFrame:
    """Columns owner, start, end: what is repeated within each owner.

    ``pieces``: owner, copies, at, starts, anchor, group, piece, each row once. ``with_text`` joins
    rows that name an owner with its text (binary).
    """
    spark = pieces.sparkSession
    kinds = pieces.groupBy("group", "piece").agg(
        F.sum("copies").alias("copies"), F.min(F.struct("owner", "at", "starts", "anchor")).alias("one"))
    kinds = written(kinds, "repeats-kinds")
    crowd = kinds.groupBy("group").agg(F.count("*").alias("kinds")).filter("kinds > 1")
    alone = kinds.filter("copies > 1").select(
        "piece", F.lit(0).alias("start"), (F.col("one.starts") + F.lit(length - 1)).alias("end"))
    found = alone
    if level + 1 < len(WIDTHS):
        wanted = kinds.join(crowd, "group").select(
            "group", "piece", "kinds", F.col("one.owner").alias("owner"), F.col("one.at").alias("at"),
            (F.col("one.starts") + F.lit(length - 1)).alias("size"), F.col("one.anchor").alias("anchor"))
        taken = written(with_text(wanted).selectExpr("group", "piece", "kinds", "anchor", _CUT), "repeats-text")
        few = taken.filter(F.col("kinds") <= CROWD).select("group", "piece", "text")
        dealt = few.repartition("group").sortWithinPartitions("group", "piece")
        found = found.unionByName(dealt.mapInArrow(_array_task(length), "piece binary, start int, end int"))
        many = taken.filter(F.col("kinds") > CROWD).select(F.col("piece").alias("owner"), "anchor", "text")
        smaller = written(_split(many, length, WIDTHS[level + 1]), "repeats-split")
        if smaller.head(1):
            texts = many.select("owner", "text")
            inside = _settle(smaller, lambda wanted: texts.join(wanted, "owner"), length, level + 1)
            found = found.unionByName(inside.select(F.col("owner").alias("piece"), "start", "end"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return pieces.select("owner", "at", "piece").join(found, "piece").select(
        "owner", (F.col("at") + F.col("start")).alias("start"), (F.col("at") + F.col("end")).alias("end"))


_CUT = "substring(text, at + 1, size) AS text"


def _split(many: DataFrame, length: int, width: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [split_piece(t, length, a, width)
                    for t, a in zip(batch.column("text").to_pylist(), batch.column("anchor").to_pylist())]
            yield _batch([batch.column("owner"), _pieces(rows)], ["owner", "pieces"])

    cut = many.select("owner", "anchor", "text").mapInArrow(run, f"owner binary, pieces {_PIECE}")
    return cut.select("owner", F.lit(1).cast("long").alias("copies"), F.inline("pieces"))


def _array_task(length: int):
    """Rows (group, piece, text) sorted by group: suffix arrays over whole groups, a block at a
    time; a group holds CROWD pieces at most."""
    def solve(rows: list[tuple]) -> pa.RecordBatch:
        runs = repeated_runs([r[2] for r in rows], length)
        flat = [(r[1], a, b) for r, own in zip(rows, runs) for a, b in own]
        piece, start, end = map(list, zip(*flat)) if flat else ([], [], [])
        return _batch([pa.array(piece, pa.binary()), pa.array(start, pa.int32()), pa.array(end, pa.int32())],
                      ["piece", "start", "end"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("group", "piece", "text"))):
                if size >= BLOCK and row[0] != held[-1][0]:
                    yield solve(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[2])
        if held:
            yield solve(held)

    return run


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.withColumn("owner", F.unhex(F.substring(F.sha2(F.col("text"), 256), 1, 32)))


def repeated_places(docs: DataFrame, length: int = 400, gram: int = GRAM) -> DataFrame:
    """Columns owner, start, end: the places of each distinct text (named by the first half of its
    SHA-256) that maximal repeats cover. ``docs``: doc_id, text without nulls."""
    if not 1 < gram <= length or gram & (gram - 1):
        raise ValueError("gram must be a power of two, from 2 to length")
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [t.encode() for t in batch.column("text").to_pylist()]
            names = [hashlib.sha256(t).digest()[:16] for t in rows]
            yield _batch([batch.column("doc_id"), pa.array(names, pa.binary()),
                          _pieces([cut_pieces(t, length, gram) for t in rows])], ["doc_id", "owner", "pieces"])

    cut = written(docs.filter(F.octet_length("text") >= length).mapInArrow(
        run, f"doc_id long, owner binary, pieces {_PIECE}"), "repeats-pieces")
    # Copies of a text count as one owner that many times; one row is to give its text.
    owners = written(cut.groupBy("owner").agg(
        F.count("*").alias("copies"), F.min("doc_id").alias("doc_id")), "repeats-owners")
    pieces = written(
        cut.select("owner", F.inline("pieces")).dropDuplicates(["owner", "at"]).join(owners.select("owner", "copies"), "owner")
        .select("owner", "copies", "at", "starts", "anchor", "group", "piece"), "repeats-owned")
    keyed = _keyed(docs).withColumn("text", F.encode("text", "UTF-8"))

    def with_text(wanted: DataFrame) -> DataFrame:
        # By owner and id: copies of a text are dealt to different tasks, and one of them is used.
        one = wanted.join(owners.select("owner", "doc_id"), "owner").withColumnsRenamed({"owner": "_owner", "doc_id": "_id"})
        return keyed.join(one, (keyed["owner"] == one["_owner"]) & keyed["doc_id"].eqNullSafe(one["_id"]))

    return _settle(pieces, with_text, length, 0)


def drop_repeats(docs: DataFrame, length: int = 400, gram: int = GRAM, id_col: str = "doc_id",
                 text_col: str = "text", with_kept: bool = True) -> DataFrame:
    """Columns doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans (the removed runs as start:end in
    bytes, end exclusive, comma-joined) and, if asked for, kept (binary), one row for each row of ``docs``:
    every byte inside a string of ``length`` bytes that also starts elsewhere, in the same text or
    another, is removed.

    Null and empty texts have no bytes. Rows repeated with one id are copies of each other. Null
    ids stay null. Other columns are not read. An empty table gives no rows.
    """
    rows = id_and_text(docs, id_col, text_col)
    places = repeated_places(rows, length, gram).groupBy("owner").agg(
        F.collect_set(F.struct("start", "end")).alias("runs"))  # bounded by the text's length
    joined = _keyed(rows).join(written(places, "repeats-places"), "owner", "left").select("doc_id", "text", "runs")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, runs in zip(batch.column("text").to_pylist(), batch.column("runs").to_pylist()):
                data = text.encode()
                spans = merged([(r["start"], r["end"]) for r in runs or []])
                edges = [0, *(x for s in spans for x in s), len(data)]
                kept = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2]))
                out.append((len(data), len(data) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(),
                            ",".join(f"{a}:{b}" for a, b in spans), kept))
            columns = list(zip(*out)) or [[]] * 6
            yield _batch([batch.column("doc_id"), *(pa.array(c, t) for c, t in zip(columns, types))], names)

    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"] + ["kept"] * with_kept
    types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()] + [pa.binary()] * with_kept
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans string"
    return joined.mapInArrow(run, schema + ", kept binary" * with_kept)

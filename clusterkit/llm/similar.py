"""Texts whose word shingles have a Jaccard similarity of at least a bound, verified.

Candidates by SimHash and chains, as in ``simhash.py`` but of wide prints: a ring of ``SEGMENTS`` segments
of 16 bits. At similarity s two prints differ in a share of acos(2s / (1 + s)) / pi of their bits at
most, 0.15 at 0.8, so about ten of 64 bits, which unlike texts may reach, too: a ring of four segments
does not tell them apart. In one of 96 the chain may start at any segment. Its first segment is equal,
which is the candidate key (a pair at 0.8 has none with probability (1 - 0.848^16)^96 = 8e-4); inside
a bucket of equal keys come the budgets of the chain after ``CHAIN`` = 4 and 6 more segments, and
only rows with another one that keeps both go on. All this moves prints, no texts.

Every pair of those that may reach the bound is compared by its whole sets of shingles before it
links, in two rounds. First every member of a bucket against one hub, the member that shares most keys
with others, which settles groups of many near copies by a number of pairs that grows with their size.
Then those members of a bucket that are not connected yet: they come together with their sets in tiles of
bounded work, are compared there, each pair in the first bucket it shares, and a tile gives only
links that connect something, so what leaves it is never more than its members.

A set of shingles is named by a hash of 64 bits, so exact copies are compared with nothing.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clusterkit.llm.common import BATCH_ROWS, drop_written, written
from clusterkit.llm.components import components

SEGMENTS, WIDTH, SEED = 96, 16, 42
WORDS = SEGMENTS * WIDTH // 64
#: Segments after the first at which a chain's budget is checked.
CHAIN = (4, 6)
#: Deviations above the expected distance that a chain may have, and the slack of the whole print.
DEVIATIONS, SLACK = 4, 0.08
#: Prints of a bucket, and shingles of their sets, that one block of a tile holds.
BLOCK, BLOCK_SHINGLES = 1024, 1_000_000

_rng = np.random.default_rng(SEED)
_XOR = _rng.integers(0, 1 << 63, WORDS, np.uint64)
_MUL = _rng.integers(0, 1 << 63, WORDS, np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(text: str, size: int) -> np.ndarray:
    """Sorted distinct hashes of the text's word shingles; words as in ``simhash.fingerprint``."""
    words = text.encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    parts = [b" ".join(words)] if len(words) <= size else map(b" ".join, zip(*(words[k:] for k in range(size))))
    digest = xxhash.xxh64_intdigest
    return np.unique(np.fromiter((digest(s, SEED) for s in parts), np.uint64))


def wide_print(hashes: np.ndarray, run: int = 255) -> np.ndarray:
    """SimHash of a set, 64 bits at a time by another mixing of its hashes: a bit is 1 if set in over half."""
    ones = np.zeros(SEGMENTS * WIDTH, np.int64)
    for a in range(0, len(hashes), run):  # counts of a run fit a byte
        x = (hashes[a:a + run, None] ^ _XOR) * _MUL
        x ^= x >> np.uint64(32)
        x *= np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(29)
        bits = np.unpackbits(x.astype("<u8").view(np.uint8), axis=1, bitorder="little")
        ones += np.add.reduce(bits, axis=0, dtype=np.uint8)
    return np.packbits(2 * ones > len(hashes), bitorder="little")


def differing(similarity: float) -> float:
    """Share of bits in which two sets of this similarity differ at most, on average."""
    return math.acos(2 * similarity / (1 + similarity)) / math.pi


def budget(bits: int, similarity: float) -> int:
    """Differences that so many bits may have."""
    p = differing(similarity)
    return math.floor(bits * p + DEVIATIONS * math.sqrt(bits * p * (1 - p)))


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Of two sorted sets; two empty ones are equal."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both) if len(a) + len(b) else 1.0


def with_sketch(docs: DataFrame, name: str, text_col: str, size: int) -> DataFrame:
    """``docs`` with a struct column of print (a hash of the set), n (shingles) and wide (its SimHash);
    null texts count as empty."""
    kind = T.StructType([T.StructField("print", T.LongType()), T.StructField("n", T.LongType()), T.StructField("wide", T.BinaryType())])
    arrow = pa.struct([("print", pa.int64()), ("n", pa.int64()), ("wide", pa.binary())])

    def sketch(text: str) -> dict:
        found = shingles(text, size)
        return {"print": xxhash.xxh64_intdigest(found.tobytes(), SEED) - (1 << 63), "n": len(found),
                "wide": wide_print(found).tobytes()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text_col)).to_pylist()
            made = pa.array([sketch(t or "") for t in texts], arrow)
            yield pa.RecordBatch.from_arrays([*batch.columns, made], [*batch.schema.names, name])

    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, kind)]))


def _near(four: np.ndarray, two: np.ndarray, first: np.ndarray, similarity: float, small: int = 16) -> np.ndarray:
    """Rows with another of their bucket that keeps the chain's budgets. ``four``, ``two``: the next
    segments; buckets begin at the places ``first``."""
    budgets = [budget(n * WIDTH, similarity) for n in CHAIN]
    size = np.diff(np.r_[first, len(four)])
    owner = np.repeat(np.arange(len(first)), size)
    near = np.zeros(len(four), bool)
    i = np.flatnonzero(size[owner] <= small)
    for shift in range(1, small):
        i = i[i + shift < len(four)]
        i = i[owner[i + shift] == owner[i]]
        if not len(i):
            break
        used = np.bitwise_count(four[i] ^ four[i + shift])
        hit = i[used <= budgets[0]]
        used = used[used <= budgets[0]] + np.bitwise_count(two[hit] ^ two[hit + shift])
        hit = hit[used <= budgets[1]]
        near[hit] = near[hit + shift] = True
    for k in np.flatnonzero(size > small):
        a, b = first[k], first[k] + size[k]
        step = max(1, (1 << 20) // (b - a))
        for c in range(a, b, step):
            d = min(b, c + step)
            used = np.bitwise_count(four[c:d, None] ^ four[a:b])
            x, y = np.nonzero(used <= budgets[0])
            fits = used[x, y] + np.bitwise_count(two[x + c] ^ two[y + a]) <= budgets[1]
            near[c + x[fits & (x + c != y + a)]] = True
    return near


def candidates(firsts: DataFrame, similarity: float, block: int) -> DataFrame:
    """Columns key, print: the rows of each bucket that have another near them by the SimHash of
    ``firsts`` (print, wide). Buckets of more than ``block`` rows are cut into tiles of two blocks."""
    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wide = np.frombuffer(b"".join(batch.column("wide").to_pylist()), np.uint8).reshape(-1, WORDS * 8)
            wide = wide.view("<u2")
            key = wide.astype(np.int32) + (np.arange(SEGMENTS, dtype=np.int32) << WIDTH)
            ring = np.concatenate([wide, wide[:, :CHAIN[1]]], axis=1)
            four, two = (np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(ring[:, a + 1:], b - a, axis=1)[:, :SEGMENTS])
                         for a, b in ((0, CHAIN[0]), CHAIN))
            prints = np.repeat(batch.column("print").to_numpy(), SEGMENTS)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x.ravel()) for x in (key, prints, four.view("<i8"), two.view("<i4"))], ["key", "print", "four", "two"])

    def keys_only(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in spread(batches):
            yield batch.select(["key"])

    def marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None

        def out(rows: list[np.ndarray], first: np.ndarray) -> pa.RecordBatch:
            near = _near(rows[3].view(np.uint64), rows[4].view(np.uint32), first, similarity)
            return pa.RecordBatch.from_arrays([pa.array(rows[0][near]), pa.array(rows[2][near])], ["key", "print"])

        for batch in batches:
            new = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(5)]
            held = new if held is None else [np.concatenate(x) for x in zip(held, new)]
            first = np.flatnonzero(np.r_[True, (held[0][1:] != held[0][:-1]) | (held[1][1:] != held[1][:-1])])
            if len(first) > 1:  # all but the last bucket, of which more rows may come
                cut = first[-1]
                yield out([x[:cut] for x in held], first[:-1])
                held = [x[cut:] for x in held]
        if held is not None and len(held[0]):
            yield out(held, np.zeros(1, np.int64))

    firsts.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    prints = firsts.select("print", "wide")
    # Few: each has more than a block of rows.
    crowd = prints.mapInArrow(keys_only, "key int").groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > block)
    blocks = F.coalesce(F.ceil(F.col("n") / block).cast("int"), F.lit(1))
    own = F.when(F.col("n").isNull(), 0).otherwise(F.pmod(F.xxhash64("print"), blocks).cast("int"))
    keys = prints.mapInArrow(spread, "key int, print long, four long, two int")
    tiled = keys.join(F.broadcast(crowd), "key", "left").withColumn("own", own).withColumn(
        "other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    tile = F.least("own", "other") * F.lit(1 << 20).cast("long") + F.greatest("own", "other")
    dealt = tiled.select("key", tile.alias("tile"), "print", "four", "two").repartition("key", "tile")
    found = dealt.sortWithinPartitions("key", "tile").mapInArrow(marks, "key int, print long")
    return found.dropDuplicates(["key", "print"])


def _verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs (u, v) whose sets reach the bound. A print of many pairs is a hot key of the
    joins, which Spark can split."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = ([np.frombuffer(x, "<u8") for x in batch.column(k).to_pylist()] for k in (2, 3))
            good = pa.array([jaccard(x, y) >= similarity for x, y in zip(a, b)], pa.bool_())
            yield batch.select(["u", "v"]).filter(good)

    left = sets.select(F.col("print").alias("u"), F.col("set").alias("a"))
    right = sets.select(F.col("print").alias("v"), F.col("set").alias("b"))
    return pairs.join(left, "u").join(right, "v").select("u", "v", "a", "b").mapInArrow(run, "u long, v long")


@dataclass
class _Members:
    """Rows of tiles, sorted by key and tile; ``sets`` one after the other, as they come."""

    key: np.ndarray
    tile: np.ndarray
    own: np.ndarray
    prints: np.ndarray
    root: np.ndarray
    wide: np.ndarray
    sets: list[np.ndarray]

    @staticmethod
    def of(batch: pa.RecordBatch) -> "_Members":
        plain = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(5)]
        wide = np.frombuffer(b"".join(batch.column(5).to_pylist()), "<u2").reshape(-1, SEGMENTS)
        return _Members(*plain, wide, [np.frombuffer(x, "<u8") for x in batch.column(6).to_pylist()])

    def _columns(self) -> list:
        return [self.key, self.tile, self.own, self.prints, self.root, self.wide]

    def then(self, more: "_Members") -> "_Members":
        return _Members(*map(np.concatenate, zip(self._columns(), more._columns())), self.sets + more.sets)

    def rows(self, a: int, b: int) -> "_Members":
        return _Members(*(c[a:b] for c in self._columns()), self.sets[a:b])

    def starts(self) -> np.ndarray:
        """Where a tile begins, but for the first."""
        return np.flatnonzero((self.key[1:] != self.key[:-1]) | (self.tile[1:] != self.tile[:-1])) + 1

    def forest(self, similarity: float) -> list[tuple[int, int]]:
        """Links at the bound that connect the members of one tile, as far as they are not connected."""
        root = self.root.copy()
        size = np.array([len(x) for x in self.sets])
        start = int(self.key[0]) >> WIDTH
        most = (differing(similarity) + SLACK) * SEGMENTS * WIDTH
        across = (self.own != self.own[0]).any()  # of two blocks: each block has a tile of its own
        found = []
        for k in range(len(root) - 1):
            j = np.arange(k + 1, len(root))
            j = j[root[j] != root[k]]
            if across:
                j = j[self.own[j] != self.own[k]]
            j = j[np.minimum(size[j], size[k]) >= similarity * np.maximum(size[j], size[k])]
            if len(j):
                differ = self.wide[j] ^ self.wide[k]
                j = j[((differ == 0).argmax(axis=1) == start) & (np.bitwise_count(differ).sum(axis=1, dtype=np.int64) <= most)]
            if not len(j):
                continue
            one, others = self.sets[k], np.concatenate([self.sets[x] for x in j])
            place = np.minimum(np.searchsorted(one, others), len(one) - 1)
            both = np.add.reduceat(one[place] == others, np.cumsum(np.r_[0, size[j][:-1]]), dtype=np.int64)
            for x in j[both >= similarity * (size[j] + size[k] - both)]:
                if root[x] != root[k]:
                    found.append((self.prints[k], self.prints[x]))
                    root[root == root[x]] = root[k]
        return found


def _open_links(similarity: float):
    """A function from rows (key, tile, own, print, root, wide, set), sorted by key and
    tile, to links that connect the members of each tile."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: _Members | None = None

        def out(rows: _Members) -> pa.RecordBatch:
            cuts = [0, *rows.starts().tolist(), len(rows.key)]
            found = [link for a, b in zip(cuts, cuts[1:]) for link in rows.rows(a, b).forest(similarity)]
            u, v = (np.array([link[side] for link in found], np.int64) for side in (0, 1))
            return pa.RecordBatch.from_arrays([pa.array(np.minimum(u, v)), pa.array(np.maximum(u, v))], ["u", "v"])

        for batch in batches:
            if not batch.num_rows:
                continue
            held = _Members.of(batch) if held is None else held.then(_Members.of(batch))
            # All but the last tile, of which more rows may come.
            whole = held.starts()
            if len(whole):
                yield out(held.rows(0, whole[-1]))
                held = held.rows(whole[-1], len(held.key))
        if held is not None:
            yield out(held)

    return run


def links(firsts: DataFrame, rows: DataFrame, similarity: float, size: int, block: int = BLOCK) -> DataFrame:
    """Columns u, v: pairs of prints at ``similarity`` or more that connect all such pairs found, written.

    ``firsts``: written; print, n, wide, first (a doc_id), one row for each print.
    ``rows``: written; doc_id, text, print.
    """
    members = written(candidates(firsts, similarity, block).join(firsts.select("print", "n"), "print"), "similar-near")
    crowd = members.groupBy("key").agg(F.count("*").alias("members"), F.sum("n").alias("shingles"))
    crowded = members.join(crowd, "key")
    score = crowded.groupBy("print").agg(F.sum("members").alias("score"))
    crowded = written(crowded.join(score, "print"), "similar-buckets")

    # The sets of those that are in some bucket with others; a text for each print.
    needed = crowded.select("print").distinct().join(firsts.select("print", "first"), "print")
    texts = rows.join(needed.select(F.col("print").alias("_print"), F.col("first").alias("_id")),
                      (F.col("print") == F.col("_print")) & F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi")

    def to_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [shingles(t or "", size).astype("<u8").tobytes() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("print"), pa.array(made, pa.binary())], ["print", "set"])

    rows.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    sets = texts.select("print", "text").mapInArrow(to_sets, "print long, set binary").dropDuplicates(["print"])
    sets = written(sets, "similar-sets")

    hubs = crowded.groupBy("key").agg(F.max(F.struct("score", "print", "n")).alias("hub"))
    starred = crowded.join(hubs, "key").filter(F.col("print") != F.col("hub.print"))
    least, most = F.least("n", "hub.n"), F.greatest("n", "hub.n")
    star = starred.filter(least >= F.lit(similarity) * most).select(
        F.col("hub.print").alias("u"), F.col("print").alias("v")).distinct()
    near = written(_verified(star, sets, similarity), "similar-links")
    roots = components(near)

    # Hubs have met all of their bucket; of the others, buckets that are not connected yet.
    rest = starred.select("key", "print", "members", "shingles").join(
        roots.select(F.col("node").alias("print"), "root"), "print", "left").withColumn("root", F.coalesce("root", "print"))
    open_keys = rest.groupBy("key").agg(F.min("root").alias("a"), F.max("root").alias("b")).filter("a <> b").select("key")
    blocks = F.greatest(F.ceil(F.col("members") / block), F.ceil(F.col("shingles") / BLOCK_SHINGLES)).cast("int")
    blocks = F.least(blocks, F.col("members").cast("int"))
    tiled = (
        rest.join(open_keys, "key").join(firsts.select("print", "wide"), "print").join(sets, "print")
        .withColumn("own", F.pmod(F.xxhash64("print"), blocks).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
        .select("key", (F.least("own", "other") * F.lit(1 << 20).cast("long") + F.greatest("own", "other")).alias("tile"),
                "own", "print", "root", "wide", "set")
    )
    dealt = tiled.repartition("key", "tile").sortWithinPartitions("key", "tile", "print")
    more = dealt.mapInArrow(_open_links(similarity), "u long, v long").distinct()
    found = written(near.unionByName(more), "similar-links")
    drop_written(members, crowded, sets, near)
    return found


def keep_one(docs: DataFrame, similarity: float, id_col: str, text_col: str, size: int) -> DataFrame:
    """``docs`` with one row of each component of texts at ``similarity`` or more, that of the
    smallest doc_id (null ids last), all columns as they are. Of rows that repeat this doc_id with
    one set of shingles any one stays."""
    columns = docs.columns
    name = "similar_sketch"
    while name in columns:
        name += "_"
    # Written, since the links and the rows that stay are taken from it.
    whole = written(with_sketch(docs, name, text_col, size), "similar-rows")
    ids = whole[id_col].cast("long")
    sketch = F.col(name)
    firsts = whole.select(ids.alias("doc_id"), sketch["print"].alias("print"), sketch["n"].alias("n"), sketch["wide"].alias("wide")).groupBy(
        "print").agg(F.min("doc_id").alias("first"), F.first("n").alias("n"), F.first("wide").alias("wide"))
    firsts = written(firsts, "similar-prints")
    rows = whole.select(ids.alias("doc_id"), whole[text_col].cast("string").alias("text"), sketch["print"].alias("print"))
    roots = components(links(firsts, rows, similarity, size))
    joined = firsts.select("print", "first").join(roots, F.col("print") == F.col("node"), "left").select(
        F.coalesce("root", "print").alias("root"), "print", "first")
    none = (1 << 63) - 1  # sorts null ids last
    best = joined.groupBy("root").agg(F.min(F.struct(F.coalesce("first", F.lit(none)).alias("f"), "print", "first")).alias("best"))
    best = best.select(F.col("best.print").alias("_print"), F.col("best.first").alias("_id"))
    kept = whole.join(best, (sketch["print"] == F.col("_print")) & ids.eqNullSafe(F.col("_id")), "left_semi")
    print_name = f"{name}_print"
    return kept.withColumn(print_name, sketch["print"]).dropDuplicates([id_col, print_name]).select(*columns)

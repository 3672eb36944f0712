"""Near-duplicates by SimHash fingerprints, candidates by pigeonring chains.

Two fingerprints of 64 bits link at no more than ``TAU`` = 3 differing bits. Their four segments
of 16 bits lie on a ring. If all differences together are at most 3, then from some segment on
every chain of 1, 2, 3, 4 consecutive segments keeps within the proportional budget of 0, 1, 2, 3
differences. So the first segment of that chain is equal, and the next differs in one bit at most,
that is, one half of it is equal too. These 24 bits, for each of the four starts and two halves,
are the candidate keys. Inside a bucket of equal keys a pair must keep the budgets of the longer
chains, shortest first, before the full Hamming distance is taken.

Only distinct fingerprints are compared, so exact copies cost nothing. A bucket gives a spanning
forest of its links, not its pairs; one with very many fingerprints is cut into tiles of two
blocks each, which go to different tasks and together meet every pair.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clusterkit.llm import similar
from clusterkit.llm.common import BATCH_ROWS, written
from clusterkit.llm.components import components

TAU, SEGMENTS, WIDTH, SEED = 3, 4, 16, 42
#: Differences that a chain of 1, 2 ... segments may have.
BUDGET = [(n * TAU) // SEGMENTS for n in range(1, SEGMENTS + 1)]
#: Fingerprints of a bucket that one block of a tile holds.
BLOCK = 1024


def fingerprint(text: str, size: int = 3, run: int = 200_000) -> int:
    """SimHash of the text's word shingles, as a signed 64-bit integer.

    A-Z are lower-cased; words are runs of anything but ASCII white space; fewer words than
    ``size`` make one shingle; none: zero.
    """
    words = text.encode().lower().split()
    if not words:
        return 0
    if len(words) <= size:
        shingles: Iterator[bytes] = iter([b" ".join(words)])
    else:
        shingles = map(b" ".join, zip(*(words[k:] for k in range(size))))
    total, ones = 0, np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    while part := [digest(s, SEED) for s in itertools.islice(shingles, run)]:
        bits = np.unpackbits(np.array(part, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
        total += len(part)
    return int(np.packbits(2 * ones > total, bitorder="little").view("<i8")[0])


def with_fingerprint(docs: DataFrame, name: str, text_col: str = "text", size: int = 3) -> DataFrame:
    """``docs`` with a long column of fingerprints added; null texts count as empty."""
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text_col)).to_pylist()
            prints = pa.array([fingerprint(t or "", size) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, prints], [*batch.schema.names, name])

    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return docs.mapInArrow(run, schema)


def _chain(a: np.ndarray, b: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Places where a and b keep all budgets of the chain from segment ``start``."""
    x = a ^ b
    at, used = np.arange(len(x)), np.zeros(len(x), np.uint8)
    for n, budget in enumerate(BUDGET):
        segment = ((start[at] + n) % SEGMENTS * WIDTH).astype(np.uint64)
        used = used + np.bitwise_count(x[at] >> segment & np.uint64((1 << WIDTH) - 1))
        fits = used <= budget
        at, used = at[fits], used[fits]
    return at


def _links(prints: np.ndarray, start: np.ndarray, first: np.ndarray, small: int = 16):
    """Links inside buckets that begin at the places ``first``: pairs of arrays.

    Buckets of up to ``small`` members are compared shift by shift, all of them together; larger
    ones by a search that meets each member once, against those not reached yet.
    """
    size = np.diff(np.r_[first, len(prints)])
    left, right = [], []
    owner = np.repeat(np.arange(len(first)), size)
    few = size[owner] <= small
    for shift in range(1, small):
        i = np.flatnonzero(few[:-shift] & (owner[shift:] == owner[:-shift]))
        if not len(i):
            break
        hit = i[_chain(prints[i], prints[i + shift], start[i])]
        left.append(prints[hit])
        right.append(prints[hit + shift])
    for k in np.flatnonzero(size > small):
        rest = prints[first[k]:first[k] + size[k]]
        which = start[first[k]]
        queue: list = []
        while len(rest):
            if not queue:
                queue, rest = [rest[0]], rest[1:]
            one = queue.pop()
            near = _chain(np.full(len(rest), one), rest, np.full(len(rest), which))
            if len(near):
                left.append(np.full(len(near), one))
                right.append(rest[near])
                queue += list(rest[near])
                rest = np.delete(rest, near)
    empty = np.zeros(0, np.uint64)
    return (np.concatenate(left), np.concatenate(right)) if left else (empty, empty)


def _bucket_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of rows (key, tile, print) that come sorted by key and tile."""
    held: list[np.ndarray] = [np.zeros(0, np.int64)] * 3

    def out(columns: list[np.ndarray]) -> pa.RecordBatch:
        key, tile, prints = columns
        first = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (tile[1:] != tile[:-1])])
        u, v = _links(prints.view(np.uint64), (key >> 25).astype(np.int64), first)
        return pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], ["u", "v"])

    for batch in batches:
        new = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(3)]
        held = [np.concatenate(x) for x in zip(held, new)]
        key, tile, _ = held
        # All but the last bucket, of which more rows may come.
        whole = np.flatnonzero((key[1:] != key[:-1]) | (tile[1:] != tile[:-1]))
        if len(whole):
            cut = whole[-1] + 1
            yield out([x[:cut] for x in held])
            held = [x[cut:] for x in held]
    if len(held[0]):
        yield out(held)


def link_forest(prints: DataFrame, block: int = BLOCK) -> DataFrame:
    """Columns u, v: links between distinct fingerprints (column ``print``) that connect all that
    are linked, by one spanning forest for each bucket. Every link is found in some bucket."""
    p = F.col("print")

    def key(i: int, half: int):
        # Bits 25-26: the start; 24: the half; 8-23: the first segment; 0-7: half of the next.
        segment = F.shiftrightunsigned(p, WIDTH * i).bitwiseAND(0xFFFF)
        byte = F.shiftrightunsigned(p, (WIDTH * (i + 1) + 8 * half) % 64).bitwiseAND(0xFF)
        return F.lit(i << 25 | half << 24).bitwiseOR(F.shiftleft(segment, 8)).bitwiseOR(byte)

    keys = prints.select("print", F.explode(F.array(*(key(i, h) for i in range(SEGMENTS) for h in (0, 1)))).alias("key"))
    crowd = keys.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    blocks = F.ceil(F.col("n") / block).cast("int")
    own = F.pmod(F.xxhash64("print"), blocks).cast("int")
    tiled = (
        keys.join(crowd, "key").withColumn("blocks", blocks).withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("key", (F.least("own", "other") * F.lit(1 << 20).cast("long") + F.greatest("own", "other")).alias("tile"), "print")
    )
    prints.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    dealt = tiled.repartition("key", "tile").sortWithinPartitions("key", "tile", "print")
    return dealt.mapInArrow(_bucket_links, "u long, v long")


def classes(prints: DataFrame) -> DataFrame:
    """Columns print, root, component_id, keep_id, keep_print from rows doc_id, print.

    ``component_id`` is the smallest doc_id of the component, null where all are null, and
    ``keep_print`` the smallest fingerprint that a row of that doc_id has in it.
    """
    firsts = written(prints.groupBy("print").agg(F.min("doc_id").alias("first")), "simhash-prints")
    links = written(link_forest(firsts.select("print")).distinct(), "simhash-links")
    roots = components(links)
    joined = firsts.join(roots, firsts["print"] == roots["node"], "left").select(
        "print", "first", F.coalesce("root", "print").alias("root"))
    joined = written(joined, "simhash-roots")
    none = (1 << 63) - 1  # sorts null ids last
    best = joined.groupBy("root").agg(F.min(F.struct(
        F.coalesce("first", F.lit(none)).alias("f"), "print", "first")).alias("best"))
    return joined.select("print", "root").join(best, "root").select(
        "print", "root", F.col("best.first").alias("component_id"), F.col("best.print").alias("keep_print"))


def simhash_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3) -> DataFrame:
    """Columns doc_id, fingerprint (16 hexadecimal digits), component_id: one row for each row.

    Null and empty texts have fingerprint zero and are linked like any other. Rows with a null id
    take part; a component of such rows alone has a null component_id. Repeated rows are each
    returned. Other columns are not read. An empty table gives no rows.
    """
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))
    prints = written(with_fingerprint(rows, "print", size=size).select("doc_id", "print"), "simhash-docs")
    found = classes(prints).select("print", "component_id")
    return prints.join(found, "print").select(
        "doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3,
             similarity: float | None = None) -> DataFrame:
    """``docs`` with one row of each component, that of the smallest doc_id (null ids last), all
    columns as they are. Of rows that repeat this doc_id with one fingerprint any one stays.

    With ``similarity`` texts link at this Jaccard similarity of their shingles or more, whatever
    their fingerprints (``similar.py``): 64 bits do not tell 0.8 from less.
    """
    if similarity is not None:
        return similar.keep_one(docs, similarity, id_col, text_col, size)
    columns = docs.columns
    name = "simhash_print"
    while name in columns:
        name += "_"
    # Written, since both the classes and the rows that stay are taken from it.
    whole = written(with_fingerprint(docs, name, text_col, size), "simhash-rows")
    prints = whole.select(whole[id_col].cast("long").alias("doc_id"), whole[name].alias("print"))
    best = classes(prints).filter("print = keep_print").select(
        F.col("print").alias("_print"), F.col("component_id").alias("_id"))
    kept = whole.join(best, (whole[name] == F.col("_print")) & whole[id_col].cast("long").eqNullSafe(F.col("_id")), "left_semi")
    return kept.dropDuplicates([id_col, name]).select(*columns)

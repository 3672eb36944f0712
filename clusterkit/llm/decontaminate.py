"""Passages of a benchmark in documents, by q-gram counts in diagonal bands and banded alignment.

Texts and items are normalised: letters lower-cased, each run of anything but letters and digits
one space. An item is cut into windows that begin every few characters, so any fragment a little longer
than a window holds one whole; a document holds a window if some part of it is within the window's
edit budget. The q-gram lemma: a window of m characters and a part within
k edits share at least m - q + 1 - k q q-grams, and these lie on diagonals (place in the text less
place in the window) that differ by at most k. So the shared q-grams are counted in bands of 2 (k + 1)
diagonals, each overlapping half of the next, which leaves every such match whole in one band; bands
that reach the bound are retained, and an alignment inside the band decides.

The benchmark is the stated query set. It is shipped to the tasks in blocks of bounded size, each
block meeting all documents in one scan without a shuffle.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clusterkit.llm.common import BATCH_ROWS, id_and_text
from clusterkit.llm.pretoken import blocks

#: Characters of a q-gram, of a window and between window starts; edits for a character. A fragment of
#: WINDOW + STEP - 1 = 52 characters holds a whole window, and 3 edits are allowed in one.
Q, WINDOW, STEP, RATE = 12, 50, 3, 0.0625
#: Shared grams that are dealt to windows at a time.
HITS = 500_000
#: Characters of benchmark items that one scan carries, and of texts searched at a time.
BLOCK_CHARS, SEGMENT = 4_000_000, 2_000_000

_BREAK = 0x10FFFF  # between documents; no gram of an item and no part of a text holds it


@lru_cache(1)
def _fold() -> np.ndarray:
    """Of each code point its lower-case form, or 0 where it is no letter or digit."""
    out = np.zeros(0x110000, np.uint32)
    for p in range(0x110000):
        c = chr(p)
        if c.isalnum():
            low = c.lower()
            out[p] = ord(low) if len(low) == 1 else p
    out[_BREAK] = _BREAK
    return out


def normalise(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Normalised characters (0: space) and the place of each in the text."""
    # A code point may be no valid character by itself, as a text from elsewhere can hold it.
    code = _fold()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")]
    stay = np.ones(len(code), bool)
    stay[1:] = (code[1:] != 0) | (code[:-1] != 0)
    place = np.flatnonzero(stay)
    return code[place], place


def _grams(code: np.ndarray) -> np.ndarray:
    """Hashes of all Q-grams; Q is 12: two halves of 4, then 4 more."""
    mul = np.uint64(0x9E3779B97F4A7C15)
    h = code.astype(np.uint64) * mul
    if len(h) < Q:
        return h[:0]
    for size in (1, 2):
        h = h[:-size] * np.uint64(0xD6E8FEB86659FD93) + h[size:]
        h ^= h >> np.uint64(32)
    h8 = h[:-4] * np.uint64(0xC2B2AE3D27D4EB4F) + h[4:]
    h12 = h8[:-4] * np.uint64(0x165667B19E3779F9) + h[8:]
    return h12 ^ (h12 >> np.uint64(29))


@dataclass
class Index:
    """Windows of items, and where each gram occurs in the items."""

    item: np.ndarray  # of each window
    start: np.ndarray  # place of each window in the item
    size: np.ndarray
    budget: np.ndarray
    need: np.ndarray  # shared grams that the lemma asks for
    flat: np.ndarray  # characters of all items, each followed by WINDOW signs that match nothing
    begin: np.ndarray  # place of each window in ``flat``
    windows: np.ndarray  # first window of each item, and one more
    gram: np.ndarray  # sorted, distinct
    first: np.ndarray  # of each gram into the next two, and one more
    holder: np.ndarray  # item
    at: np.ndarray  # place in it
    seen: np.ndarray  # a bit map of gram hashes, so that most grams of clean text stop there

    @property
    def chars(self) -> np.ndarray:
        """Characters of each window, padded."""
        return self.flat[self.begin[:, None] + np.arange(WINDOW)]

    @staticmethod
    def of(items: list[tuple[int, str]]) -> "Index":
        none = np.zeros(0, np.int64)
        flat, starts, sizes, begins, grams, holder, at = ([] for _ in range(7))
        item, windows, used = [], [0], 0
        for k, (_, text) in enumerate(items):
            code = normalise(text)[0]
            code = code[(code[:1] == 0).sum():]
            code = code[:len(code) - int(len(code) > 0 and code[-1] == 0)]
            if len(code) >= Q:
                last = max(0, len(code) - WINDOW)
                start = np.append(np.arange(0, last, STEP), last)
                starts.append(start)
                sizes.append(np.full(len(start), min(len(code), WINDOW)))
                begins.append(start + used)
                item.append(np.full(len(start), k))
                g = _grams(code)
                grams.append(g)
                holder.append(np.full(len(g), k))
                at.append(np.arange(len(g)))
                flat += [code, np.full(WINDOW, _BREAK + 1, np.uint32)]
                used += len(code) + WINDOW
            windows.append(windows[-1] + (len(starts[-1]) if len(code) >= Q else 0))
        join = lambda x: np.concatenate(x) if x else none
        size = join(sizes)
        budget = (size * RATE).astype(np.int64)
        budget = np.minimum(budget, np.maximum(0, (size - Q) // Q))  # so that the lemma asks for one gram
        found = join(grams).astype(np.uint64)
        order = np.argsort(found, kind="stable")
        gram, first = np.unique(found[order], return_index=True)
        bits = 1 << max(16, int(len(gram) * 16).bit_length())
        seen = np.zeros(bits, bool)
        seen[(gram & np.uint64(bits - 1)).astype(np.int64)] = True
        return Index(join(item), join(starts), size, budget, size - Q + 1 - budget * Q, join(flat).astype(np.uint32),
                     join(begins), np.array(windows), gram, np.append(first, len(found)), join(holder)[order],
                     join(at)[order], seen)


#: The index built last in this process, by the key of the block it is of.
_built: dict[str, Index] = {}


def _index(key: str, block: list[tuple[int, str]]) -> Index:
    if key not in _built:
        _built.clear()
        _built[key] = Index.of(block)
    return _built[key]


def _bands(place: np.ndarray, holder: np.ndarray, at: np.ndarray, ix: Index) -> tuple[np.ndarray, np.ndarray]:
    """Keys of window and band, with the grams that they share: of grams at ``place`` in the text and
    ``at`` in item ``holder``."""
    keys = []
    before, count = ix.windows[holder], ix.windows[holder + 1] - ix.windows[holder]
    reach = WINDOW - Q  # a window holds the grams that begin up to here
    tries = [(at // STEP - o, None) for o in range(reach // STEP + 1)] + [(count - 1, True)]
    for number, last in tries:
        fits = np.ones(len(at), bool) if last else (number >= 0) & (number < count - 1)
        window = before[fits] + number[fits]
        offset = at[fits] - ix.start[window]
        inside = (offset >= 0) & (offset <= ix.size[window] - Q)
        window, diagonal = window[inside], place[fits][inside] - offset[inside] + WINDOW  # not negative
        band = diagonal // (ix.budget[window] + 1)
        # Each diagonal is in the band that starts at its half and in the one before.
        keys += [window << 40 | band, window << 40 | (band - 1)]
    return np.unique(np.concatenate(keys), return_counts=True)


def _candidates(code: np.ndarray, ix: Index) -> tuple[np.ndarray, np.ndarray]:
    """(window, first diagonal of a band) that hold the grams the lemma asks for."""
    none = np.zeros(0, np.int64)
    h = _grams(code)
    if not len(ix.gram) or not len(h):
        return none, none
    place = np.flatnonzero(ix.seen[(h & np.uint64(len(ix.seen) - 1)).astype(np.int64)])
    to = np.searchsorted(ix.gram, h[place])
    to[to == len(ix.gram)] = 0
    real = ix.gram[to] == h[place]
    place, to = place[real], to[real]
    many = ix.first[to + 1] - ix.first[to]
    ends = np.cumsum(many)
    found = []
    a = 0
    while a < len(place):  # shares of bounded size, one place at least
        b = max(a + 1, int(np.searchsorted(ends, ends[a] - many[a] + HITS, "right")))
        part = many[a:b]
        entry = np.repeat(ix.first[to[a:b]] - np.r_[0, np.cumsum(part)[:-1]], part) + np.arange(part.sum())
        found.append(_bands(np.repeat(place[a:b], part), ix.holder[entry], ix.at[entry], ix))
        a = b
    if not found:
        return none, none
    key, where = np.unique(np.concatenate([k for k, _ in found]), return_inverse=True)
    count = np.bincount(where, weights=np.concatenate([c for _, c in found]), minlength=len(key))
    window, band = key >> 40, key & ((1 << 40) - 1)
    good = (count >= ix.need[window]) & (band < 1 << 39)
    window, band = window[good], band[good]
    return window, band * (ix.budget[window] + 1) - WINDOW


def _align(code: np.ndarray, window: np.ndarray, low: np.ndarray, ix: Index):
    """Least edits that turn a window into a part of the text inside its band, and that part's
    (start, end); rows of one alignment table for all candidates at a time. No part holds a break
    or reaches beyond the text."""
    # Paths may leave the band's diagonals by the budget on either side.
    pad = int(ix.budget.max(initial=0)) + 1
    width = 4 * pad + 1
    far = np.int32(1 << 20)
    n = len(window)
    base = low - pad  # text place of column 0 in row 0
    padded = np.concatenate([np.full(WINDOW + width + pad, _BREAK + 2, np.uint32), code,
                             np.full(2 * WINDOW + 2 * width, _BREAK + 2, np.uint32)])
    shift = WINDOW + width + pad
    column = np.arange(width)
    cost = np.zeros((n, width), np.int32)  # a part may start anywhere
    begin = np.tile(column, (n, 1)) + base[:, None]
    best, where, start = np.full(n, far), np.zeros(n, np.int64), np.zeros(n, np.int64)
    for i in range(WINDOW):
        at = np.clip(base[:, None] + i + column + shift, 0, len(padded) - 1)
        here = padded[at]
        outside = here >= _BREAK
        step = cost + (here != ix.flat[ix.begin[window] + i][:, None])  # same diagonal
        step[outside] = far
        skip = np.full((n, width), far, np.int32)  # a window character left out
        skip[:, :-1] = cost[:, 1:] + 1
        from_skip = skip < step
        step = np.where(from_skip, skip, step)
        source = begin.copy()
        source[:, :-1] = np.where(from_skip[:, :-1], begin[:, 1:], begin[:, :-1])
        for c in range(1, width):  # a text character too many
            more = (step[:, c - 1] + 1 < step[:, c]) & ~outside[:, c]
            step[more, c] = step[more, c - 1] + 1
            source[more, c] = source[more, c - 1]
        cost, begin = step, source
        done = ix.size[window] == i + 1
        if done.any():
            c = cost[done].argmin(axis=1)
            rows = np.flatnonzero(done)
            best[rows], start[rows] = cost[rows, c], begin[rows, c]
            where[rows] = base[rows] + i + c + 1
    return best, start, where


def matches(texts: list[str], ix: Index) -> list[tuple[int, int, int, int, int, int]]:
    """(text number, item number, window, edits, start, end) of all windows found, once each or, at
    several places, once for each; places in code points."""
    out = set()
    base = 0
    for run in blocks(texts, SEGMENT):
        starts = np.cumsum([0, *(len(t) + 1 for t in run)])
        whole, place = normalise(chr(_BREAK).join(run))
        # Parts of the normalised text overlap by more than a match can be long.
        for cut in range(0, len(whole), SEGMENT):
            code = whole[cut:cut + SEGMENT + 2 * WINDOW]
            window, low = _candidates(code, ix)
            for part in range(0, len(window), 4096):
                w = window[part:part + 4096]
                edits, a, b = _align(code, w, low[part:part + 4096], ix)
                for k in np.flatnonzero(edits <= ix.budget[w]):
                    first = place[cut + max(0, a[k])]
                    last = place[cut + min(len(code), b[k]) - 1]
                    n = int(np.searchsorted(starts, first, "right")) - 1
                    out.add((base + n, int(ix.item[w[k]]), int(w[k]), int(edits[k]),
                             int(first - starts[n]), int(last - starts[n] + 1)))
        base += len(run)
    return sorted(out)


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, block_chars: int) -> Iterator[list[tuple]]:
    """The items in blocks of about ``block_chars`` characters, dealt by hash; null texts left out."""
    items = benchmark.select(benchmark[item_col].cast("long").alias("item_id"),
                             benchmark[text_col].cast("string").alias("text")).filter("text is not null")
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = max(1, -(-int(total) // block_chars))
    for k in range(n):
        rows = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k).collect()
        yield sorted(((r.item_id, r.text) for r in rows), key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text: str = "text", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Columns doc_id, item_id, n_windows, edits, first, last: one row for each row of ``docs`` and
    item of which it holds a window; clean documents have none.

    ``edits`` is the least of the windows; ``first`` and ``last`` bound all of them, in code points,
    end exclusive. Items of under ``Q`` characters, normalised, are in no document by definition,
    nor are null items. Null and empty texts hold none. Null ids stay null, repeated rows and items
    are each reported, other columns are not read; an empty table of either kind gives no rows.
    """
    spark = docs.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    rows = id_and_text(docs, id_col, text_col)
    schema = "doc_id long, item_id long, n_windows int, edits int, first int, last int"

    def scan(block: list[tuple[int, str]]) -> DataFrame:
        shipped, key = spark.sparkContext.broadcast(block), uuid.uuid4().hex

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            ix = _index(key, shipped.value)
            ids = [i for i, _ in shipped.value]
            for batch in batches:
                ids_of = batch.column("doc_id").to_pylist()
                found: dict[tuple[int, int], list] = {}
                for n, item, window, edits, a, b in matches(batch.column("text").to_pylist(), ix):
                    one = found.setdefault((n, item), [set(), edits, a, b])
                    one[0].add(window)
                    one[1:] = min(one[1], edits), min(one[2], a), max(one[3], b)
                rows = [(ids_of[n], ids[item], len(one[0]), *one[1:]) for (n, item), one in found.items()]
                columns = list(zip(*rows)) or [[]] * 6
                types = [pa.int64(), pa.int64(), *[pa.int32()] * 4]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)],
                                                 ["doc_id", "item_id", "n_windows", "edits", "first", "last"])

        return rows.mapInArrow(run, schema)

    parts = [scan(block) for block in _blocks(benchmark, item_col, item_text, block_chars)]
    return reduce(DataFrame.unionByName, parts)


def keep_clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
               item_text: str = "text", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The rows of ``docs`` that hold no window of an item, all columns as they are, whatever their
    names. Null and empty texts hold none, repeated rows stay or go alike; without items all rows stay,
    and an empty table gives an empty one."""
    spark = docs.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))

    def scan(rows: DataFrame, block: list[tuple]) -> DataFrame:
        shipped, key = spark.sparkContext.broadcast(block), uuid.uuid4().hex

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            ix = _index(key, shipped.value)
            for batch in batches:
                texts = [t or "" for t in batch.column(batch.schema.get_field_index(text_col)).to_pylist()]
                bad = {n for n, *_ in matches(texts, ix)}
                yield batch.filter(pa.array([n not in bad for n in range(len(texts))], pa.bool_()))

        return rows.mapInArrow(run, docs.schema)

    return reduce(scan, _blocks(benchmark, item_col, item_text, block_chars), docs)

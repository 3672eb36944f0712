"""Nearest centers of many rows at once, without measuring most distances.

Rows lie in a tree of boxes, halved at the median of their widest side. On the way from the root to the
leaves each box keeps the centers that can be nearest to one of its rows: of two centers b and z, b is not
if the box lies on z's side of the plane between them. A box with one center left is settled by the
sums of its rows; the rows of a leaf are measured against the centers that are left there. Nothing is
carried from one scan to the next, and clusters are those of plain distances, the lower id on a tie: a
center goes only if it is farther by more than rounding can hide, and rows of wide leaves, which are
measured by matrix products, are measured again one by one where two centers come out close.

``packed`` deals rows to tasks by place once, so that a task meets few of the centers, and holds them in
blocks, a row each, in the order of their tree. It holds no row twice, and equal rows are spread out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows of a leaf, children of a box, and the width from which matrix products are used.
LEAF, FAN, WIDE = 48, 8, 6
# Numbers in a block and in the blocks of a task, rows below which no task more is worth it, rows that say
# where the tasks' parts lie, and those parts.
BLOCK_CELLS, TASK_CELLS, TASK_ROWS, PLACES, CELLS = 1_000_000, 4_000_000, 4_000, 20_000, 256
# Pairs of boxes and centers met together; centers whose sums are added up in one place.
PAIRS, SLOT = 200_000, 8192


def _finder(width: int) -> tuple[Callable, Callable, Callable, Callable, Callable, Callable]:
    """Closures, as workers need no copy of this package:

    ``sort(x, weights)``: rows in the order of a tree and their weights, filled up to whole leaves with
    rows of weight 0, and the place of each in x (-1: filled up);
    ``tree(sorted, weights)``: the boxes over such rows;
    ``search(tree, centers, first, close, rows)``: the centers of run r are those from first[r] to
    first[r + 1]. ``close(center, count, total)`` is called for settled boxes (``None``: no box is settled
    before its leaves), ``rows(leaf, run, ids, mine)`` for leaves: their rows' center is
    ids[leaf, mine];
    ``groups(tree, sizes)``: which runs to search for together;
    ``squared(tree, leaf, centers, ids, mine)``: the squared distances of leaves' rows to their centers;
    ``sums(tree, leaf, ids, mine, n, own)``: add to ``own`` rows (at 0) and coordinates (from 3 on) by center.
    """
    wide, leaf_rows, fan, pairs = width >= WIDE, LEAF, FAN, PAIRS
    steps = [1, 2, 3, 4, 5, 6, 8, 10, 12, 16, 20, 24, 32, 48, 64, 96, 128, 192, 256, 384, 512, 768, 1024]

    def sort(x, weights=None):
        n, depth = len(x), 0
        while (n >> depth) > leaf_rows:
            depth += 1
        total = -(-n // (1 << depth)) << depth
        ids = np.concatenate([np.arange(n), np.full(total - n, -1)])[None, :]
        pts = x[np.maximum(ids, 0)]
        for _ in range(depth):
            side = (pts.max(axis=1) - pts.min(axis=1)).argmax(axis=1)
            key = np.take_along_axis(pts, side[:, None, None], axis=2)[:, :, 0]
            half = key.shape[1] // 2
            part = np.argpartition(key, half, axis=1)
            pts = np.take_along_axis(pts, part[:, :, None], axis=1).reshape(-1, half, width)
            ids = np.take_along_axis(ids, part, axis=1).reshape(-1, half)
        w = np.where(ids >= 0, 1.0 if weights is None else np.asarray(weights, dtype=float)[np.maximum(ids, 0)], 0.0)
        return pts, w, ids

    def tree(pts, w):
        lo, hi = pts.min(axis=1), pts.max(axis=1)
        count, total = w.sum(axis=1), np.einsum("gm,gmi->gi", w, pts)
        levels, kids = [], []
        while True:
            half = (hi - lo) / 2 * (1 + 1e-12) + 4e-15 * np.maximum(np.abs(lo), np.abs(hi))
            levels.append(((lo + hi) / 2, half, count, total))
            if len(lo) == 1:
                break
            n = fan if len(lo) % fan == 0 else 2
            kids.append(n)
            lo, hi = lo.reshape(-1, n, width).min(axis=1), hi.reshape(-1, n, width).max(axis=1)
            count, total = count.reshape(-1, n).sum(axis=1), total.reshape(-1, n, width).sum(axis=1)
        if wide:  # rows less the middle of their leaf, in the columns in which some leaf varies
            varies = np.flatnonzero((pts.max(axis=1) > pts.min(axis=1)).any(axis=0))
            fixed = np.setdiff1d(np.arange(width), varies)
            turned = varies, fixed, np.ascontiguousarray((pts - levels[0][0][:, None, :])[:, :, varies])
        else:
            turned = [np.ascontiguousarray(pts[:, :, i]) for i in range(width)]
        return levels[::-1], kids[::-1], pts, w, turned

    def listed(begin, length, n):
        """For each list its entries, the last one repeated up to n."""
        return begin[:, None] + np.minimum(np.arange(n), length[:, None] - 1)

    def kept_narrow(p, h, ct, cid):
        # p, h: by coordinate (lists, children); which centers of each list stay for each child
        lists, n = cid.shape
        if n > 16:  # the loop runs inside numpy
            c = [x[cid][:, None, :] for x in ct]
            d2 = sum((a[:, :, None] - b) ** 2 for a, b in zip(p, c))
            z = d2.argmin(axis=2)
            low = np.take_along_axis(d2, z[:, :, None], axis=2)
            own = np.take_along_axis(cid, z, axis=1)
            reach = sum(np.abs(b - x[own][:, :, None]) * a[:, :, None] for a, b, x in zip(h, c, ct))
            return d2 - low <= reach * (2 + 1e-9) + 1e-12 * (d2 + low)
        shape = p[0].shape
        c = [x[cid.T][:, :, None] for x in ct]
        d2, low, at = np.empty((n, *shape)), None, None
        part = np.empty(shape)
        for j in range(n):
            d = d2[j]
            np.subtract(p[0], c[0][j], out=d)
            np.multiply(d, d, out=d)
            for i in range(1, width):
                np.subtract(p[i], c[i][j], out=part)
                np.multiply(part, part, out=part)
                np.add(d, part, out=d)
            if j == 0:
                low, at = d.copy(), np.zeros(shape, dtype="int64")
            else:
                np.copyto(at, j, where=d < low)
                np.minimum(low, d, out=low)
        own = np.take_along_axis(cid, at, axis=1)
        z = [x[own] for x in ct]
        keep, reach = np.empty((*shape, n), dtype=bool), np.empty(shape)
        for j in range(n):
            reach.fill(0.0)
            for i in range(width):
                np.subtract(c[i][j], z[i], out=part)
                np.abs(part, out=part)
                np.multiply(part, h[i], out=part)
                np.add(reach, part, out=reach)
            d = d2[j]
            np.add(d, low, out=part)
            part *= 1e-12
            reach *= 2 + 1e-9
            part += reach
            d -= low
            np.less_equal(d, part, out=keep[:, :, j])
        return keep

    def kept_wide(p, h, centers, cid):
        # p, h: (lists, children, width). The way from b to z inside the box, sum h |b - z|, is at most
        # sqrt(sum h) sqrt(sum h (b - z)^2).
        c = centers[cid]
        origin = p.mean(axis=1, keepdims=True)
        p, c = p - origin, c - origin
        turned = c.transpose(0, 2, 1)
        c2, p2 = (c * c).sum(axis=2)[:, None, :], (p * p).sum(axis=2)[:, :, None]
        d2 = c2 - 2 * (p @ turned)
        z = d2.argmin(axis=2)
        own = np.take_along_axis(c, z[:, :, None], axis=1)
        low = np.take_along_axis(d2, z[:, :, None], axis=2)
        scale = c2 + (own * own).sum(axis=2)[:, :, None] + p2
        across = h @ (turned * turned) - 2 * ((h * own) @ turned) + (h * own * own).sum(axis=2)[:, :, None]
        sides = h.sum(axis=2)[:, :, None]
        reach = np.sqrt(sides * np.maximum(0.0, across + 1e-12 * h.max(axis=2)[:, :, None] * scale))
        return d2 - low <= reach * (2 + 1e-9) + 1e-12 * scale

    def search(made, centers, first, close, rows):
        levels, kids, pts, w, turned = made
        ct = None if wide else [np.ascontiguousarray(x) for x in centers.T]
        run = np.arange(len(first) - 1)
        node, begin, length = np.zeros(len(run), dtype="int64"), first[:-1].copy(), np.diff(first)
        cand = np.arange(first[-1])
        for depth, (p, h, count, total) in enumerate(levels):
            n = 1 if depth == 0 else kids[depth - 1]
            places = None if wide else ([np.ascontiguousarray(x) for x in p.T], [np.ascontiguousarray(x) for x in h.T])
            order = np.argsort(length, kind="stable")
            ends = np.searchsorted(length[order], [s for s in steps if s < length.max()] + [int(length.max())], side="right")
            found, a = [], 0
            for b in ends.tolist():
                if b == a:
                    continue
                most = int(length[order[b - 1]])
                together = max(1, pairs // (n * most))
                for s in range(a, b, together):
                    of = order[s:min(b, s + together)]
                    own = node[of][:, None] * n + np.arange(n)
                    if most == 1:
                        found.append((run[of], own, np.ones(own.shape, dtype="int64"), np.repeat(cand[begin[of]], n)))
                        continue
                    cid = cand[listed(begin[of], length[of], most)]
                    if wide:
                        keep = kept_wide(p[own], h[own], centers, cid)
                    else:
                        keep = kept_narrow([x[own] for x in places[0]], [x[own] for x in places[1]], ct, cid)
                    keep &= (np.arange(most) < length[of][:, None])[:, None, :]
                    found.append((run[of], own, keep.sum(axis=2), np.broadcast_to(cid[:, None, :], keep.shape)[keep]))
                a = b
            node = np.concatenate([x[1].ravel() for x in found])
            run = np.concatenate([np.repeat(x[0], n) for x in found])
            length = np.concatenate([x[2].ravel() for x in found])
            cand = np.concatenate([x[3] for x in found])
            begin = np.cumsum(length) - length
            if close is not None:
                one = length == 1
                if one.any():
                    done, left = np.flatnonzero(one), np.flatnonzero(~one)
                    close(cand[begin[done]], count[node[done]], total[node[done]])
                    node, run, length, begin = node[left], run[left], length[left], begin[left]
                if not len(node):
                    return
        order = np.argsort(length, kind="stable")
        ends = np.searchsorted(length[order], [s for s in steps if s < length.max()] + [int(length.max())], side="right")
        a = 0
        for b in ends.tolist():
            if b > a:
                most = int(length[order[b - 1]])
                together = max(1, 32_768 // w.shape[1] // (max(1, most // 8) if wide else 1))
                for s in range(a, b, together):
                    of = order[s:min(b, s + together)]
                    cid = cand[listed(begin[of], length[of], most)]
                    leaf = node[of]
                    if wide:
                        mine = nearest_wide(made, leaf, centers, cid)
                    else:
                        mine = nearest_narrow([column[leaf] for column in turned], ct, cid)
                    rows(leaf, run[of], cid, mine)
            a = b

    def nearest_narrow(x, ct, cid):
        best, mine = None, np.zeros(x[0].shape, dtype="int16")
        d, part = np.empty(x[0].shape), np.empty(x[0].shape)
        for j in range(cid.shape[1] if cid.shape[1] > 1 else 0):
            for i in range(width):
                out = part if i else d
                np.subtract(x[i], ct[i][cid[:, j]][:, None], out=out)
                np.multiply(out, out, out=out)
                if i:
                    np.add(d, part, out=d)
            if best is None:
                best, d = d, np.empty(d.shape)
            else:
                np.copyto(mine, j, where=d < best)
                np.minimum(best, d, out=best)
        return mine

    def nearest_wide(made, leaf, centers, cid):
        levels, _, pts, w, (varies, _, less) = made
        mine = np.zeros((len(leaf), w.shape[1]), dtype="int16")
        if cid.shape[1] == 1:
            return mine
        p, h = levels[-1][0][leaf], levels[-1][1][leaf]
        moved = centers[cid] - p[:, None, :]
        c2 = (moved * moved).sum(axis=2)
        margin = (1e-12 * (c2.max(axis=1) + (h * h).sum(axis=1)))[:, None]
        c2[:, 1:][cid[:, 1:] == cid[:, :-1]] = np.inf  # the last one repeated
        score = less[leaf] @ np.ascontiguousarray(moved[:, :, varies].transpose(0, 2, 1))
        score *= -2
        score += c2[:, None, :]
        at = score.argmin(axis=2)
        best = np.take_along_axis(score, at[:, :, None], axis=2)[:, :, 0]
        mine[:] = at
        g, m = np.nonzero(np.count_nonzero(score <= (best + margin)[:, :, None], axis=2) > 1)
        for s in range(0, len(g), 4096):
            gs, ms = g[s:s + 4096], m[s:s + 4096]
            x, c = pts[leaf[gs], ms], centers[cid[gs]]
            d2 = sum((x[:, i, None] - c[:, :, i]) ** 2 for i in range(width))
            mine[gs, ms] = d2.argmin(axis=1)
        return mine

    def squared(made, leaf, centers, ids, mine):
        levels, _, pts, _, turned = made
        own = np.take_along_axis(ids, mine.astype("int64"), axis=1)
        out = np.zeros(own.shape)
        if wide:
            varies, fixed, _ = turned
            if len(fixed):
                gap = levels[-1][0][leaf][:, None, fixed] - centers[ids][:, :, fixed]
                out += np.take_along_axis((gap * gap).sum(axis=2), mine.astype("int64"), axis=1)
        for i in varies.tolist() if wide else range(width):
            gap = (pts[leaf, :, i] if wide else turned[i][leaf]) - centers[own, i]
            gap *= gap
            out += gap
        return out

    def sums(made, leaf, ids, mine, n, own):
        levels, _, _, w, turned = made
        weight, m, flat = w[leaf], ids.shape[1], ids.ravel()
        if wide:
            varies, _, less = turned
            chosen = np.zeros((len(leaf), m, weight.shape[1]))
            np.put_along_axis(chosen, mine[:, None, :].astype("int64"), weight[:, None, :], axis=1)
            count = chosen.sum(axis=2)
            total = count[:, :, None] * levels[-1][0][leaf][:, None, :]
            total[:, :, varies] += chosen @ less[leaf]
            own[0] += np.bincount(flat, count.ravel(), n)
            for i in range(width):
                own[3 + i] += np.bincount(flat, total[:, :, i].ravel(), n)
            return
        place = ((np.arange(len(leaf)) * m)[:, None] + mine).ravel()
        own[0] += np.bincount(flat, np.bincount(place, weight.ravel(), flat.size), n)
        for i in range(width):
            own[3 + i] += np.bincount(flat, np.bincount(place, (turned[i][leaf] * weight).ravel(), flat.size), n)

    def groups(made, sizes):
        leaves, out, cost = len(made[2]), [], pairs
        for run, size in enumerate(sizes):
            if cost >= pairs:
                out.append([])
                cost = 0
            out[-1].append(run)
            cost += size + 4 * leaves
        return out

    return sort, tree, search, groups, squared, sums


@dataclass(frozen=True)
class Packed:
    """Rows in blocks: (rows, weights), as bytes."""

    blocks: DataFrame
    width: int


def _places(sample: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Sides and values at which a tree of ``parts`` (a power of 2) parts halves the sample."""
    side, value = np.zeros(parts, dtype="int64"), np.zeros(parts)
    members = {1: sample}
    for node in range(1, parts):
        own = members.pop(node)
        if len(own):
            side[node] = (own.max(axis=0) - own.min(axis=0)).argmax()
            column = own[:, side[node]]
            value[node] = np.partition(column, (len(column) - 1) // 2)[(len(column) - 1) // 2]
            high = column > value[node]
            members[2 * node], members[2 * node + 1] = own[~high], own[high]
        else:
            members[2 * node] = members[2 * node + 1] = own
    return side, value


@contextmanager
def packed(df: DataFrame, width: int, features: str = "features", weight: str | None = None) -> Iterator[Packed]:
    """The usable rows of arrays, dealt by place and held in blocks for the scans inside. Once inside,
    ``df`` is not read again unless a block is lost."""
    from clusterkit.operators.kmeans import _kernel

    read, take, _, _ = _kernel(width, False)
    sort = _finder(width)[0]
    spark = df.sparkSession
    rows = df.select(F.col(features).alias("features"), (F.lit(1) if weight is None else F.col(weight)).cast("bigint").alias("weight"))
    count = rows.count()
    sample = rows.select("features").sample(min(1.0, PLACES / max(1, count)), 1).limit(2 * PLACES).toArrow()["features"].combine_chunks()
    x, usable = read(sample) if len(sample) else (np.zeros((0, width)), np.zeros(0, dtype=bool))
    side, value = _places(x[usable], CELLS)

    def cell(column):
        import numpy as np

        x, usable = read(column)
        at = np.ones(len(x), dtype="int64")
        for _ in range(len(side).bit_length() - 1):
            at = 2 * at + (x[np.arange(len(x)), side[at]] > value[at])
        return pa.array((at - len(side)).astype("int32"), mask=~usable)

    cell.__annotations__ = {"column": pa.Array, "return": pa.Array}
    few = min(4 * spark.sparkContext.defaultParallelism, -(-count // TASK_ROWS))
    parts = max(1, few, -(-count * (width + 1) // TASK_CELLS))
    # Equal rows have one cell; the second key lets them go to several tasks.
    dealt = rows.withColumns({"cell": F.arrow_udf(cell, "int")("features"), "salt": F.pmod(F.monotonically_increasing_id(), F.lit(1024))})
    dealt = dealt.where("cell IS NOT NULL").repartitionByRange(parts, "cell", "salt").select("features", "weight")
    most = max(1, BLOCK_CELLS // (width + 1))

    def pack(batches: Iterable) -> Iterator:
        import numpy as np
        import pyarrow as pa

        held, count = [], 0

        def block(some):
            x, w = (np.concatenate(part) for part in zip(*some))
            pts, w, _ = sort(x, w)
            return pa.RecordBatch.from_arrays(
                [pa.array([pts.shape[0]], pa.int32()), pa.array([pts.tobytes()], pa.binary()), pa.array([w.tobytes()], pa.binary())],
                names=["leaves", "x", "w"])

        for batch in batches:
            x, usable = read(batch.column(0))
            if not usable.any():
                continue
            held.append((take(x, usable), batch.column(1).to_numpy(zero_copy_only=False)[usable]))
            count += len(held[-1][0])
            if count >= most:
                yield block(held)
                held, count = [], 0
        if held:
            yield block(held)

    blocks = dealt.mapInArrow(pack, "leaves int, x binary, w binary").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        blocks.count()
        yield Packed(blocks, width)
    finally:
        blocks.unpersist()


def _unpack(width: int) -> Callable:
    def unpack(batch):
        for leaves, x, w in zip(*(batch.column(i) for i in range(3))):
            leaves = leaves.as_py()
            yield (np.frombuffer(x.as_buffer(), dtype=float).reshape(leaves, -1, width),
                   np.frombuffer(w.as_buffer(), dtype=float).reshape(leaves, -1))

    return unpack


def totals(rows: Packed, runs: Mapping[int, np.ndarray], distances: bool = True) -> dict[int, tuple]:
    """For each run the rows, sums of rows, of distances and of squared distances by cluster, in one scan.
    Without ``distances`` those sums are zeros."""
    width = rows.width
    _, tree, search, groups, squared, add = _finder(width)
    unpack = _unpack(width)
    centers, sizes = np.vstack(list(runs.values())), [len(c) for c in runs.values()]
    first = np.concatenate([[0], np.cumsum(sizes)])
    slot = SLOT
    names = ["slot", "id", "sums"]

    def partial(batches: Iterable) -> Iterator:
        import numpy as np
        import pyarrow as pa

        k = len(centers)
        sums = np.zeros((3 + width, k))  # rows, distances, squares, coordinates

        for batch in batches:
            for pts, w in unpack(batch):
                made = tree(pts, w)
                for group in groups(made, sizes):
                    a, b = int(first[group[0]]), int(first[group[-1] + 1])
                    some, n, own = centers[a:b], b - a, sums[:, a:b]

                    def close(center, count, total):
                        own[0] += np.bincount(center, count, n)
                        for i in range(width):
                            own[3 + i] += np.bincount(center, total[:, i], n)

                    def rows(leaf, run, ids, mine):
                        add(made, leaf, ids, mine, n, own)
                        if distances:
                            center = np.take_along_axis(ids, mine.astype("int64"), axis=1).ravel()
                            d2, weight = squared(made, leaf, some, ids, mine), w[leaf]
                            own[2] += np.bincount(center, (d2 * weight).ravel(), n)
                            own[1] += np.bincount(center, (np.sqrt(d2) * weight).ravel(), n)

                    search(made, some, first[group[0]:group[-1] + 2] - a, None if distances else close, rows)
        yield from put(sums, np.flatnonzero(sums[0]))

    def put(sums, hit):
        for number in np.unique(hit // slot):
            some = hit[hit // slot == number]
            yield pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int32()), pa.array([some], pa.list_(pa.int32())), pa.array([sums[:, some].ravel()], pa.list_(pa.float64()))], names)

    def together(batches: Iterable) -> Iterator:
        import numpy as np

        found = {}
        for batch in batches:
            for number, ids, part in zip(*(batch.column(i) for i in range(3))):
                number = number.as_py()
                some = ids.values.to_numpy(zero_copy_only=False) - number * slot
                held = found.setdefault(number, np.zeros((3 + width, slot)))
                held[:, some] += part.values.to_numpy(zero_copy_only=False).reshape(3 + width, -1)
        for number, held in found.items():
            for batch in put(held, np.flatnonzero(held[0])):
                ids = pa.array([[number * slot + i for i in batch.column(1)[0].as_py()]], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([pa.array([number], pa.int32()), ids, batch.column(2)], names)

    schema = "slot int, id array<int>, sums array<double>"
    # A row for each task and slot, dealt by the slot.
    table = rows.blocks.mapInArrow(partial, schema).repartition(-(-len(centers) // SLOT), "slot").mapInArrow(together, schema).toArrow()
    sums = np.zeros((3 + width, len(centers)))
    for ids, part in zip(table["id"], table["sums"]):
        sums[:, ids.values.to_numpy()] = part.values.to_numpy().reshape(3 + width, -1)
    out = {}
    for at, run in enumerate(runs):
        own = sums[:, first[at]:first[at + 1]]
        out[run] = np.rint(own[0]).astype("int64"), np.ascontiguousarray(own[3:].T), own[1].copy(), own[2].copy()
    return out


def _block_distances(width: int) -> Callable:
    """``block_distances(block, runs)``: the squared distance of every row of a block to the nearest
    center in each run, one run after the other."""
    _, tree, search, groups, squared, _ = _finder(width)

    def block_distances(block, runs: Sequence):
        made, sizes = tree(*block), [len(c) for c in runs]
        for group in groups(made, sizes):
            some = np.vstack([runs[r] for r in group])
            out = np.zeros((len(group), *block[1].shape))

            def rows(leaf, run, ids, mine):
                out[run, leaf] = squared(made, leaf, some, ids, mine)

            search(made, some, np.concatenate([[0], np.cumsum([sizes[r] for r in group])]), None, rows)
            for at, r in enumerate(group):
                yield r, out[at].ravel()

    return block_distances


def _nearest_rows(width: int) -> Callable:
    """``nearest_rows(x, runs)``: the cluster of every row in each run, one run after the other."""
    sort, tree, search, groups, _, _ = _finder(width)

    def nearest_rows(x, runs: Sequence):
        pts, w, place = sort(x)
        made = tree(pts, w)
        sizes = [len(c) for c in runs]
        for group in groups(made, sizes):
            first = np.concatenate([[0], np.cumsum([sizes[r] for r in group])])
            out = np.zeros((len(group), len(x) + 1), dtype="int64")  # the last column takes what is filled up

            def rows(leaf, run, ids, mine):
                own = np.take_along_axis(ids, mine.astype("int64"), axis=1) - first[run][:, None]
                out[run[:, None], place[leaf]] = own

            search(made, np.vstack([runs[r] for r in group]), first, None, rows)
            for at, r in enumerate(group):
                yield r, out[at, :-1]

    return nearest_rows

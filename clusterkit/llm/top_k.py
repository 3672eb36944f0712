"""Exact top-k by inner product: a Voronoi join of queries and data.

Vectors are whole numbers, floor(64 x) of each component. A bounded number of pivots cuts the space
into cells, and each vector belongs to its nearest pivot. Aggregates sum up each cell: rows, largest
distance to the pivot and the distances of the k+1 rows nearest to it; for its queries number and largest
distance. From these follow, for the queries of a cell with pivot c and largest distance r,

* a floor for the k-th best score: a row at distance d from its pivot p has with each of them
  a score of at least c.p - |p| r - (|c| + r) d;
* the rows that could reach the floor: those with c.p + |p| r + (|c| + r) d at or above it.

Only such rows are replicated to the queries. Cells of queries are packed into groups and the rows of a
group into parts, both of bounded size by count, so neither a crowded cell nor a crowded vector puts
more than that into one task. A part keeps its queries' best k over tiles of a matrix product,
leaving out cells that cannot reach the k-th score found so far; the parts' lists are merged.

Nothing is cut off: where the bounds rule out nothing, every row goes to every group, in parts.

Rows whose id or vector is null, or whose vector holds a null or a number that is not finite, take no
part. Vectors of another length than the query's are no candidates, nor are rows of the query's own
id. Of rows repeated whole one is the query, but each is a candidate with a rank of its own. Other
columns are not read; an empty table has no results. Components and scores must fit a long.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clusterkit.llm.common import map_rows, written

#: Pivots: about the root of the rows of a vector length, in all at most this many.
MAX_PIVOTS = 1024
#: Vector lengths with pivots of their own, the commonest; the others have the origin as theirs.
PIVOT_LENGTHS = 16
#: Numbers of a group's queries and of a part's rows at most, and rows of either.
BLOCK_CELLS, BLOCK_ROWS = 4_000_000, 16_384
TILE = 2_048
#: Bounds are widened by this share, far more than they can be off by rounding.
SLACK = 1e-7


def whole_vectors(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 64) -> DataFrame:
    """Columns vec_id, v (floor(scale * x) of each component, as double) of the rows that take part."""
    x = rows[vector_col]

    def finite(c):
        d = c.cast("double")
        return d.isNotNull() & ~F.isnan(d) & (F.abs(d) < F.lit(float("inf")))

    fine = rows[id_col].isNotNull() & F.coalesce(F.forall(x, finite), F.lit(False))
    v = F.transform(x, lambda c: F.floor(c.cast("double") * F.lit(float(scale))).cast("double"))
    return rows.where(fine).select(rows[id_col].cast("long").alias("vec_id"), v.alias("v"))


def _matrix(column: pa.ListArray, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dim)


def _choose_pivots(vectors: DataFrame, rows_of: dict[int, int]) -> list[np.ndarray]:
    """Different vectors of each common length, by the order of their hashes; else the origin."""
    common = sorted(rows_of, key=lambda d: (-rows_of[d], d))[:PIVOT_LENGTHS]
    want = {d: int(np.ceil(np.sqrt(rows_of[d]))) for d in common}
    most = MAX_PIVOTS / max(1, sum(want.values()))
    want = {d: max(1, int(n * min(1, most))) for d, n in want.items()}
    # Of n rows about 4 in want[d]: a hash below that share of all hashes.
    share = F.lit(0.0)
    for d, n in want.items():
        share = F.when(F.size("v") == d, min(1.0, 4 * n / rows_of[d])).otherwise(share)
    mixed = F.xxhash64("v").alias("mixed")
    sample = vectors.select("v", mixed, F.size("v").alias("dim")).where(
        (F.col("mixed").cast("double") / 2.0**64 + 0.5) < share)
    by_dim = Window.partitionBy("dim").orderBy("mixed")
    limit = F.lit(0)
    for d, n in want.items():
        limit = F.when(F.col("dim") == d, n).otherwise(limit)
    chosen = sample.dropDuplicates(["mixed"]).withColumn("n", F.row_number().over(by_dim)).where(F.col("n") <= limit)
    pivots = [np.array(r.v, dtype=float) for r in chosen.orderBy("dim", "mixed").collect()]
    lengths = {len(p) for p in pivots}
    return pivots + [np.zeros(d) for d in sorted(rows_of) if d not in lengths]


def _with_cells(vectors: DataFrame, pivots: list[np.ndarray]) -> DataFrame:
    """vec_id, v, cell (the nearest pivot, of equals the first), distance."""
    at = {d: np.array([i for i, p in enumerate(pivots) if len(p) == d]) for d in {len(p) for p in pivots}}
    stacked = {d: np.array([pivots[i] for i in where]).reshape(len(where), d) for d, where in at.items()}

    def make():
        def work(batch: pa.RecordBatch) -> list:
            column = batch.column("v")
            lengths = np.diff(column.offsets.to_numpy())
            cell, distance = np.zeros(len(column), "int32"), np.zeros(len(column))
            for d in np.unique(lengths).tolist():
                mine = np.flatnonzero(lengths == d)
                x = _matrix(column.take(pa.array(mine)), d)
                p = stacked[d]
                rough = (p * p).sum(axis=1) - 2.0 * (x @ p.T)
                best = rough.argmin(axis=1)
                cell[mine] = at[d][best]
                distance[mine] = np.sqrt(((x - p[best]) ** 2).sum(axis=1))
            return [batch.column("vec_id"), column, cell, distance]

        return work

    return map_rows(vectors, make, "vec_id long, v array<double>, cell int, distance double",
                    pa.schema([("vec_id", pa.int64()), ("v", pa.list_(pa.float64())),
                               ("cell", pa.int32()), ("distance", pa.float64())]))


def _chain(dots: np.ndarray) -> list[int]:
    """The pivots in an order in which neighbours are near each other."""
    norms = np.diag(dots)
    left = np.ones(len(dots), dtype=bool)
    order = [0]
    left[0] = False
    while len(order) < len(dots):
        gaps = np.where(left, norms - 2 * dots[order[-1]], np.inf)
        order.append(int(gaps.argmin()))
        left[order[-1]] = False
    return order


def plan_join(pivots: list[np.ndarray], rows: np.ndarray, radius: np.ndarray, near: list[np.ndarray],
              queries: np.ndarray, query_radius: np.ndarray, k: int, copies: int = 1):
    """What the cells' summaries decide: of each cell its group, of each group the number of blocks
    its queries and of parts its rows are dealt to, and of each group and cell the least distance to the
    pivot from which on a row could reach the group's floors (infinity: none can).

    ``copies``: how many rows may have the query's own id, which do not count for the floor."""
    dims = np.array([len(p) for p in pivots])
    group_of = np.full(len(pivots), -1)
    blocks: list[int] = []
    members: list[list[int]] = []
    reach: list[np.ndarray] = []
    for d in sorted(set(dims.tolist())):
        mine = np.flatnonzero(dims == d)
        p = np.array([pivots[i] for i in mine]).reshape(len(mine), d)
        dots = p @ p.T
        norm = np.sqrt(np.diag(dots))
        most = block_rows(d)
        needs = {}
        at = np.repeat(np.arange(len(mine)), [len(near[i]) for i in mine])
        gaps = np.concatenate([near[i] for i in mine]) if len(mine) else np.zeros(0)
        for i, cell in enumerate(mine):
            if not queries[cell]:
                continue
            r = query_radius[cell]
            size = norm[i] + r
            slack = SLACK * (1 + size * (norm.max() + radius[mine].max()))
            low = np.sort(dots[i, at] - norm[at] * r - size * gaps - slack)[::-1]
            floor = low[k + copies - 1] if len(low) >= k + copies else -np.inf
            over = floor - slack - dots[i] - norm * r
            least = np.divide(over, size, out=np.where(over > 0, np.inf, -np.inf), where=size > 0)
            needs[i] = np.where(least <= radius[mine] * (1 + SLACK), least, np.inf)
        open_rows = most + 1
        for i in _chain(dots):
            if i not in needs:
                continue
            count = int(queries[mine[i]])
            if open_rows + count > most:
                members.append([])
                blocks.append(0)
                reach.append(np.full(len(pivots), np.inf))
                open_rows = 0
            members[-1].append(int(mine[i]))
            group_of[mine[i]] = len(members) - 1
            open_rows += count
            blocks[-1] = -(-open_rows // most)
            reach[-1][mine] = np.minimum(reach[-1][mine], needs[i])
    parts = [max(1, -(-int(rows[np.isfinite(x) | (x < 0)].sum()) // block_rows(int(dims[m[0]]))))
             for x, m in zip(reach, members)]
    return group_of, blocks, parts, np.array(reach).reshape(len(reach), len(pivots))


def block_rows(dim: int) -> int:
    return max(64, min(BLOCK_ROWS, BLOCK_CELLS // max(1, dim)))


# -- one part -----------------------------------------------------------------------------------


def best_in_part(queries: np.ndarray, query_ids: np.ndarray, data: np.ndarray, ids: np.ndarray, cells: np.ndarray,
                 k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, row, score) of the k best rows of each query, ties to the smaller id; rows of the
    query's own id are none. Cells that cannot reach a block's k-th scores are left out."""
    order = np.lexsort((ids, cells))
    data, ids, cells, back = data[order], ids[order], cells[order], order
    rank = np.empty(len(ids), dtype="int64")  # in the order of ids, so that keys settle ties
    rank[np.argsort(ids, kind="stable")] = np.arange(len(ids))
    by_rank = np.argsort(rank)
    starts = np.flatnonzero(np.r_[True, cells[1:] != cells[:-1]]) if len(cells) else np.zeros(0, "int64")
    ends = np.r_[starts[1:], len(cells)]
    middle = np.add.reduceat(data, starts, axis=0) / (ends - starts)[:, None] if len(starts) else data[:0]
    lengths = ends - starts
    spread = np.sqrt(((data - np.repeat(middle, lengths, axis=0)) ** 2).sum(axis=1))
    spread = np.maximum.reduceat(spread, starts) if len(starts) else spread
    largest = np.sqrt((queries**2).sum(axis=1).max(initial=0) * (data**2).sum(axis=1).max(initial=0))
    # Sums of products of whole numbers are exact below these bounds, in any order.
    kind = "float32" if largest < 2**24 else "float64" if largest < 2**53 else "int64"
    shift = int(len(ids)).bit_length()
    wide = largest >= 2.0 ** (62 - shift)
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for begin in range(0, len(queries), TILE):
        q = queries[begin:begin + TILE]
        own = query_ids[begin:begin + TILE]
        size = np.sqrt((q**2).sum(axis=1))
        bound = q @ middle.T + size[:, None] * spread[None, :]
        bound += SLACK * (1 + size[:, None] * (np.sqrt((middle**2).sum(axis=1)) + spread)[None, :])
        turn = np.argsort(-bound.max(axis=0, initial=-np.inf), kind="stable")
        best = np.full((len(q), k), np.iinfo("int64").min) if not wide else None
        floor = np.full(len(q), -np.inf)
        slow: list[list[tuple[int, int, int]]] = [[] for _ in q] if wide else []
        qk = q.astype(kind)
        tile: list[np.ndarray] = []
        held = 0
        for n, c in enumerate(turn):
            if (bound[:, c] >= floor).any():
                for s in range(starts[c], ends[c], TILE):
                    tile.append(np.arange(s, min(ends[c], s + TILE)))
                    held += len(tile[-1])
                    if held < TILE and (n < len(turn) - 1 or s + TILE < ends[c]):
                        continue
                    best, floor = _take(qk, own, data, ids, rank, np.concatenate(tile), kind, shift, k, best, floor, slow)
                    tile, held = [], 0
        if tile:
            best, floor = _take(qk, own, data, ids, rank, np.concatenate(tile), kind, shift, k, best, floor, slow)
        if wide:
            found = [(i, *x) for i, row in enumerate(slow) for x in row]
            at = np.array([f[0] for f in found], dtype="int64")
            rows = by_rank[np.array([-f[2] for f in found], dtype="int64")]
            score = np.array([f[1] for f in found], dtype="int64")
        else:
            at, slot = np.nonzero(best != np.iinfo("int64").min)
            key = best[at, slot]
            score = key >> shift
            rows = by_rank[(1 << shift) - 1 - (key & ((1 << shift) - 1))]
        out.append((at + begin, back[rows], score))
    return tuple(np.concatenate(x) if out else np.zeros(0, "int64") for x in zip(*out)) if out else (np.zeros(0, "int64"),) * 3


def _take(q, own, data, ids, rank, tile, kind, shift, k, best, floor, slow):
    """The best k so far and those of a tile together, as keys of score and rank of the id."""
    x = data[tile].astype(kind)
    score = (q @ x.T).astype("int64")
    mine = own[:, None] == ids[tile][None, :]
    if best is None:  # scores too wide for a key: pairs, sorted in Python
        for i in range(len(q)):
            new = [(int(s), -int(r)) for s, r, m in zip(score[i], rank[tile], mine[i]) if not m]
            slow[i] = sorted(slow[i] + new, reverse=True)[:k]
            if len(slow[i]) == k:
                floor[i] = slow[i][-1][0]
        return None, floor
    key = (score << shift) + ((1 << shift) - 1 - rank[tile])[None, :]
    key[mine] = np.iinfo("int64").min
    rows = np.flatnonzero((key > best[:, :1]).any(axis=1))  # the first column holds the least
    both = np.concatenate([best[rows], key[rows]], axis=1)
    both.partition(both.shape[1] - k, axis=1)
    both = both[:, -k:]
    both.partition(0, axis=1)
    best[rows] = both
    least = best[:, 0]
    return best, np.where(least == np.iinfo("int64").min, -np.inf, (least >> shift).astype(float))


# -- over tables --------------------------------------------------------------------------------


def top_k(vectors: DataFrame, queries, k: int = 20) -> DataFrame:
    """Columns query_id, rank, vec_id, score: for each row of ``vectors`` (vec_id, v, as from
    ``whole_vectors``) that the condition ``queries`` holds for, its k best other rows."""
    spark = vectors.sparkSession
    schema = "query_id long, rank int, vec_id long, score long"
    rows_of = {r.dim: r["count"] for r in vectors.groupBy(F.size("v").alias("dim")).count().collect()}
    if not rows_of:
        return spark.createDataFrame([], schema)
    pivots = _choose_pivots(vectors, rows_of)
    placed = written(_with_cells(vectors, pivots).withColumn("row", F.monotonically_increasing_id()), "topk-cells")
    asks = queries(F.col("vec_id")) if callable(queries) else queries
    nearest = Window.partitionBy("cell").orderBy("distance")
    summary = placed.groupBy("cell").agg(
        F.count("*").alias("n"), F.max("distance").alias("radius"),
        F.count(F.when(asks, 1)).alias("queries"), F.max(F.when(asks, F.col("distance"))).alias("query_radius")).collect()
    close = placed.select("cell", "distance").withColumn("n", F.row_number().over(nearest)).where(F.col("n") <= k + 1).collect()
    copies = placed.groupBy("vec_id").count().agg(F.max("count")).first()[0]
    size = len(pivots)
    rows, radius, asked, reach = (np.zeros(size) for _ in range(4))
    for r in summary:
        rows[r.cell], radius[r.cell], asked[r.cell], reach[r.cell] = r.n, r.radius, r.queries, r.query_radius or 0.0
    near = [[] for _ in range(size)]
    for r in close:
        near[r.cell].append(r.distance)
    group_of, blocks, parts, least = plan_join(
        pivots, rows, radius, [np.array(x) for x in near], asked, reach, k, copies)
    if not blocks:
        return spark.createDataFrame([], schema)
    keyed = _replicated(placed, blocks, parts, least)
    places = F.array(*[F.lit(int(g)) for g in group_of])
    sides = F.array(*[F.lit(int(b)) for b in blocks]), F.array(*[F.lit(int(p)) for p in parts])
    # A query row that is repeated whole is one query; its place among the blocks is by its row.
    asking = placed.where(asks).groupBy("vec_id", "v").agg(F.min("row").alias("row"), F.first("cell").alias("cell"))
    asking = asking.withColumn("g", places[F.col("cell")])
    asking = asking.select(
        F.col("row").alias("asked"), F.col("vec_id").alias("query_id"), F.col("v").alias("q"), "g", F.pmod(F.xxhash64("row"), sides[0][F.col("g")]).cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), sides[1][F.col("g")] - 1)).alias("part"))

    def solve(left: pa.Table, right: pa.Table) -> pa.Table:
        found = _solve(left, right, k)
        return pa.table(found, schema=pa.schema(
            [("asked", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())]))

    key = ["g", "block", "part"]
    lists = asking.groupBy(*key).cogroup(keyed.groupBy(*key)).applyInArrow(
        solve, "asked long, query_id long, vec_id long, score long")
    order = Window.partitionBy("asked").orderBy(F.col("score").desc(), "vec_id")
    return lists.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


def _replicated(placed: DataFrame, blocks: list[int], parts: list[int], least: np.ndarray) -> DataFrame:
    """Each row once for every block of every group that may need it: g, block, part and the row.

    The groups of a cell are listed with the distances from which on they need a row; a row is dealt
    to a part by the hash of its number, the same in every group."""
    spark = placed.sparkSession
    needs = [(c, g, float(least[g, c]), blocks[g], parts[g])
             for g in range(len(blocks)) for c in np.flatnonzero(least[g] < np.inf).tolist()]
    table = spark.createDataFrame(needs, "cell int, g int, least double, blocks int, parts int")
    # At most MAX_PIVOTS groups of MAX_PIVOTS cells.
    some = F.broadcast(table.groupBy("cell").agg(F.collect_list(F.struct("least", "g", "blocks", "parts")).alias("needs")))
    open_to = F.filter("needs", lambda n: n["least"] <= F.col("distance"))
    each = placed.join(some, "cell").select("row", "vec_id", "v", "cell", F.explode(open_to).alias("n"))
    return each.select(
        "vec_id", "v", "cell", F.col("n.g").alias("g"),
        F.explode(F.sequence(F.lit(0), F.col("n.blocks") - 1)).alias("block"),
        F.pmod(F.xxhash64("row"), F.col("n.parts")).cast("int").alias("part"))


def _solve(left: pa.Table, right: pa.Table, k: int) -> list:
    """The best rows of a part for a block of queries: query's row, its id, vec_id, score."""
    if not len(left) or not len(right):
        return [[], [], [], []]
    left, right = left.combine_chunks(), right.combine_chunks()
    v, w = left["q"].combine_chunks(), right["v"].combine_chunks()
    dim = len(v[0])
    ids, mine = right["vec_id"].to_numpy(), left["query_id"].to_numpy()
    at, row, score = best_in_part(_matrix(v, dim), mine, _matrix(w, dim), ids, right["cell"].to_numpy(), k)
    return [left["asked"].to_numpy()[at], mine[at], ids[row], score]

"""Exact top-k against a plain product of all vectors."""

import math
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from clusterkit.llm import top_k

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, label int, v string, cell string, row string, part string"


def plain_top(rows, k=20, every=20):
    """(query_id, rank, vec_id, score) by sorting all products; ids are all different here."""
    good = [(i, [math.floor(64 * float(np.float32(x))) for x in v]) for i, v in rows if i is not None and v is not None
            and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, q in good:
        if i % every == 0:
            found = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in good if j != i and len(v) == len(q))
            out += [(i, n, j, -s) for n, (s, j) in enumerate(found[:k], 1)]
    return sorted(out)


def run(spark, rows, k=20, every=20):
    frame = spark.createDataFrame([(i, v, 1, "x", None, "x", "x") for i, v in rows], SCHEMA)
    got = top_k.top_k(top_k.whole_vectors(frame), lambda i: i % every == 0, k)
    return sorted(tuple(r) for r in got.collect())


def points(rng, n, dim, kind):
    if kind == "random":
        return [[rng.gauss(0, 1) for _ in range(dim)] for _ in range(n)]
    if kind == "groups":
        heads = [[rng.gauss(0, 3) for _ in range(dim)] for _ in range(6)]
        return [[x + rng.gauss(0, 0.05) for x in rng.choice(heads)] for _ in range(n)]
    if kind == "ties":
        return [[rng.choice([0.0, 1.0]) for _ in range(dim)] for _ in range(n)]
    one = [rng.gauss(0, 1) for _ in range(dim)]
    return [one if k % 3 else [rng.gauss(0, 1) for _ in range(dim)] for k in range(n)]


@pytest.mark.parametrize("kind", ["random", "groups", "ties", "copies"])
def test_against_plain_products(spark, kind, monkeypatch):
    monkeypatch.setattr(top_k, "BLOCK_ROWS", 64)
    rng = random.Random(len(kind))
    rows = list(enumerate(points(rng, 700, 5, kind)))
    assert run(spark, rows, every=4) == plain_top(rows, every=4)


def test_bad_rows_lengths_and_sizes(spark):
    rows = [(0, [1.0, 2.0]), (1, None), (2, [1.0, None]), (3, [float("nan"), 1.0]), (4, [float("inf"), 1.0]), (20, []),
            (5, []), (6, [1.5]), (40, [2.0]), (7, [0.25, -3.0]), (None, [1.0, 2.0]), (8, [3e6, 4e6]), (60, [1e7, -2e7]),
            (-20, [-0.001, 0.001])]
    assert run(spark, rows) == plain_top(rows)
    assert run(spark, []) == [] and run(spark, [(1, [1.0])]) == [] and run(spark, [(0, [1.0])]) == []


def test_scores_too_wide_for_keys(spark):
    rows = [(i, [2.0 ** 22 * (i % 7 - 3), 2.0 ** 21 * (i % 5), 1.0]) for i in range(120)]
    assert run(spark, rows, k=7) == plain_top(rows, k=7)


def test_repeated_rows(spark):
    rows = [(0, [1.0, 0.0])] * 3 + [(0, [0.0, 1.0])] + [(1, [2.0, 1.0])] * 2 + [(2, [1.0, 3.0])]
    assert run(spark, rows, k=2) == sorted([(0, 1, 1, 8192), (0, 2, 1, 8192), (0, 1, 2, 12288), (0, 2, 1, 4096)])


def test_far_cells_are_not_replicated(spark):
    """Of queries in one far group nothing else is near: its rows alone are replicated."""
    rng = random.Random(3)
    heads = [[64.0, 0, 0, 0], [-64.0, 0, 0, 0], [0, 64.0, 0, 0], [0, -64.0, 0, 0]]
    rows = [(20 * k + 1, [x + rng.gauss(0, 0.01) for x in heads[k % 4]]) for k in range(800)]
    rows += [(20 * k, [x + rng.gauss(0, 0.01) for x in heads[0]]) for k in range(1000, 1040)]
    frame = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in rows], "vec_id long, embedding array<double>")
    vectors = top_k.whole_vectors(frame)
    pivots = top_k._choose_pivots(vectors, {4: len(rows)})
    placed = [tuple(r) for r in top_k._with_cells(vectors, pivots).select("vec_id", "cell", "distance").collect()]
    cells = range(len(pivots))
    near = [np.sort([d for _, c, d in placed if c == cell])[:21] for cell in cells]
    asked = [[d for i, c, d in placed if c == cell and i % 20 == 0] for cell in cells]
    n = np.array([sum(c == cell for _, c, _ in placed) for cell in cells])
    radius = np.array([max([d for _, c, d in placed if c == cell], default=0) for cell in cells])
    _, blocks, _, least = top_k.plan_join(pivots, n, radius, near, np.array([len(x) for x in asked]),
                                          np.array([max(x, default=0) for x in asked]), 20)
    sent = sum(d >= least[g, c] for g in range(len(blocks)) for _, c, d in placed)
    assert len(blocks) == 1 and 240 <= sent <= 260
    got = sorted(tuple(r) for r in top_k.top_k(vectors, lambda i: i % 20 == 0, 20).collect())
    assert got == plain_top([(i, [float(x) for x in v]) for i, v in rows])


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
def test_whole_table(spark):
    from clusterkit.llm.queries import op12_top_k

    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()]
    assert sorted(tuple(r) for r in op12_top_k(spark, SF_DIR).collect()) == plain_top(rows)

"""Seeded fits, and the jobs that rest on them, against the same draws written out plainly."""

import math

import numpy as np
import pytest

from clusterkit.operators.kmeans import MAX_ITERATIONS, RESTART_TOLERANCE, RESTARTS, SEEDING_STEPS
from clusterkit.operators.quality import fit_sweep
from clusterkit.operators.seeding import OVERSAMPLING, THINNING, draw_factor, mixing_factors
from clusterkit.plans.anomalies import pca_anomalies_job, top_anomalies_job
from clusterkit.sources.records import RecordSpec
from tests.fixtures import features, lines


def part(x):
    return x - math.floor(x)


def plain_mixed(row):
    first, second = mixing_factors(len(row))
    total = 0.0
    for x, a, b in zip(row, first, second):
        total += part(x * a) * b
    return total


def plain_key(mixed, seed, step, mass):
    u = part(mixed * draw_factor(seed, step))
    return -math.log(u) / mass if u > 0 and mass > 0 else math.inf


def gaps(points, centers):
    return ((points[:, None, :] - np.asarray(centers)[None, :, :]) ** 2).sum(axis=2)


def plain_starts(points, weights, most, seed):
    mixed = [plain_mixed(p) for p in points]
    keys = [plain_key(m, seed, 0, w) for m, w in zip(mixed, weights)]
    found = [int(np.argmin(keys))]
    for step in range(1, SEEDING_STEPS + 1):
        d2 = gaps(points, points[found]).min(axis=1)
        keys = [plain_key(m, seed, step, w * d) for m, w, d in zip(mixed, weights, d2)]
        order = sorted((k, i) for i, k in enumerate(keys) if k < math.inf)
        found += [i for _, i in order[:OVERSAMPLING * most]]
    mass = np.bincount(gaps(points, points[found]).argmin(axis=1), weights=weights, minlength=len(found))
    chosen, d2 = [], np.ones(len(found))
    for step in range(min(most, len(found))):
        keys = [plain_key(mixed[i], seed, THINNING + step, m * d) for i, m, d in zip(found, mass, d2)]
        at = int(np.argmin(keys))
        if keys[at] == math.inf:
            break
        gap = ((points[found] - points[found[at]]) ** 2).sum(axis=1)
        d2 = gap if not chosen else np.minimum(d2, gap)
        chosen.append(found[at])
    return points[chosen]


def plain_fits(rows, ks, seeds=range(RESTARTS)):
    """The best centers of each k."""
    points, weights = np.unique(np.asarray(rows, dtype=float), axis=0, return_counts=True)
    out = {}
    for seed in seeds:
        starts = plain_starts(points, weights, max(ks), seed)
        for k in ks:
            centers = starts[:k]
            for _ in range(MAX_ITERATIONS):
                cluster = gaps(points, centers).argmin(axis=1)
                new = np.array([np.average(points[cluster == c], axis=0, weights=weights[cluster == c])
                                if (cluster == c).any() else centers[c] for c in range(len(centers))])
                moved = np.sqrt(((new - centers) ** 2).sum(axis=1)).max()
                centers = new
                if moved <= RESTART_TOLERANCE:
                    break
            cost = (gaps(points, centers).min(axis=1) * weights).sum()
            if k not in out or cost < out[k][0]:
                out[k] = cost, centers
    return out


def test_sweep_equals_the_plain_draws(spark):
    rng = np.random.default_rng(12)
    rows = rng.normal(size=(160, 3)).round(2).tolist()
    rows += rows[:30] + [rows[0]] * 20
    models = fit_sweep(features(spark, rows), [1, 2, 5, 9], restarts=4)
    want = plain_fits(rows, [1, 2, 5, 9], range(4))
    for k, model in models.items():
        assert model.cost == pytest.approx(want[k][0]) and model.centers == pytest.approx(want[k][1])


FIELDS = 18
SPEC = RecordSpec(names=("id", *(f"x{i}" for i in range(FIELDS))), numeric=tuple(range(1, FIELDS + 1)), categorical=(), label=0)


def records():
    rng = np.random.default_rng(21)
    x = rng.normal(size=(420, FIELDS)) * (1 + np.arange(FIELDS) % 7) + rng.normal(size=(420, 1)) * 3
    return x.round(4)


def plain_anomalies(z):
    (_, centers), = plain_fits(z, [150]).values()
    distance = np.sqrt(gaps(z, centers).min(axis=1))
    limit = np.sort(distance)[::-1][99]
    return {i: d for i, d in enumerate(distance) if d > limit}


def scaled(x):
    return (x - x.mean(axis=0)) / x.std(axis=0)


def text(x):
    return [f"r{i}," + ",".join(map(repr, row)) for i, row in enumerate(x.tolist())]


def test_top_anomalies_with_their_own_parameters(spark):
    x = records()
    want = plain_anomalies(scaled(x))
    best = sorted(want, key=lambda i: -want[i])[:10]
    got = top_anomalies_job(lines(spark, text(x)), SPEC).collect()
    assert [int(r["value"].split(",")[0][1:]) for r in got] == best
    assert [r["distance"] for r in got] == pytest.approx([want[i] for i in best])


def test_anomalies_of_fifteen_components_with_their_own_parameters(spark):
    x = records()
    _, _, right = np.linalg.svd(x - x.mean(axis=0), full_matrices=False)
    components = right[:15].T
    largest = np.abs(components).argmax(axis=0)
    components = components * np.sign(components[largest, np.arange(15)])
    want = plain_anomalies(scaled(x @ components))
    got = {int(r["value"].split(",")[0][1:]): r["distance"] for r in pca_anomalies_job(lines(spark, text(x)), SPEC).collect()}
    assert set(got) == set(want) and len(got) == 99
    assert all(got[i] == pytest.approx(want[i]) for i in want)


@pytest.mark.parametrize("width", [3, 15])
def test_packed_rows_draw_and_fit_as_plain_ones(spark, monkeypatch, width):
    from clusterkit.operators import pruning

    used, pack = [], pruning.packed
    monkeypatch.setattr(pruning, "packed", lambda *args: used.append(args[1]) or pack(*args))
    rng = np.random.default_rng(13)
    rows = rng.normal(size=(160, width)).round(2).tolist()
    rows += rows[:30] + [rows[0]] * 20
    models = fit_sweep(features(spark, rows), [6, 70], restarts=4)
    want = plain_fits(rows, [6, 70], range(4))
    for k, model in models.items():
        assert model.cost == pytest.approx(want[k][0]) and model.centers == pytest.approx(want[k][1])
    assert used == [width]  # once for all scans

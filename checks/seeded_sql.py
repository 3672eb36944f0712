"""Seeded K-means in SQL: the draws of k-means||, the thinning to starts and Lloyd's steps with the
stop of runs that stand still, as common table expressions."""

from __future__ import annotations

from collections.abc import Sequence

from clusterkit.operators.kmeans import MAX_ITERATIONS, SEEDING_STEPS
from clusterkit.operators.seeding import OVERSAMPLING, THINNING, draw_factor, mixing_factors


def _x(width: int, source: str = "") -> str:
    dot = f"{source}." if source else ""
    return ", ".join(f"{dot}x{i}" for i in range(width))


def _squared(width: int, a: str, b: str) -> str:
    return " + ".join(f"({a}.x{i} - {b}.x{i}) * ({a}.x{i} - {b}.x{i})" for i in range(width))


def _u(factor: str) -> str:
    return f"(mixed * {factor} - floor(mixed * {factor}))"


def _factors(seeds: Sequence[int], step: int) -> str:
    rows = ", ".join(f"({s}, {draw_factor(s, step)!r}::DOUBLE)" for s in seeds)
    return f"(VALUES {rows}) f(seed, factor)"


def lloyd_until(rows: str, width: int, starts: str, tolerance: float, tag: str = "", weight: str = "p.w") -> list[str]:
    """CTEs that end in ``s{tag}_{MAX_ITERATIONS}`` from ``rows`` (pid, x...) and ``starts``, a query of
    run, k, seed, cluster, done, x...: runs that stand still keep their centers."""
    parts = [f"s{tag}_0 AS MATERIALIZED ({starts})"]
    for i in range(1, MAX_ITERATIONS + 1):
        old = f"s{tag}_{i - 1}"
        means = ", ".join(f"sum(p.x{j} * n.w) / sum(n.w) AS x{j}" for j in range(width))
        kept = ", ".join(f"CASE WHEN o.done OR m.x{j} IS NULL THEN o.x{j} ELSE m.x{j} END AS x{j}" for j in range(width))
        moved = f"sqrt({_squared(width, 'a', 'o')})"
        parts.append(
            f"s{tag}_{i} AS MATERIALIZED (WITH m AS (SELECT n.run, n.b.cluster AS cluster, {means} "
            f"FROM ({near_rows(rows, old, width, weight, 'WHERE NOT c.done')}) n "
            f"JOIN {rows} p USING (pid) GROUP BY 1, 2), a AS (SELECT o.run, o.k, o.seed, o.cluster, o.done, {kept} FROM {old} o "
            f"LEFT JOIN m ON m.run = o.run AND m.cluster = o.cluster) SELECT a.run, a.k, a.seed, a.cluster, "
            f"a.done OR max({moved}) OVER (PARTITION BY a.run) <= {tolerance!r} AS done, {_x(width, 'a')} "
            f"FROM a JOIN {old} o ON o.run = a.run AND o.cluster = a.cluster)"
        )
    return parts


def near_rows(rows: str, centers: str, width: int, weight: str = "p.w", where: str = "") -> str:
    """(pid, run, w, b.d2, b.cluster) of the nearest centers, the lower id on a tie."""
    return (f"SELECT p.pid, c.run, any_value({weight}) AS w, min({{'d2': {_squared(width, 'p', 'c')}, 'cluster': c.cluster}}) AS b "
            f"FROM {rows} p CROSS JOIN {centers} c {where} GROUP BY p.pid, c.run")


def seeded(points: str, width: int, ks: Sequence[int] | str, seeds: Sequence[int], tolerance: float, tag: str = "") -> list[str]:
    """CTEs that end in ``best{tag}`` (run: the k, cluster, x...) from ``points`` (x...). ``ks`` may
    be SQL for one k that depends on the data."""
    first, second = mixing_factors(width)
    terms = [f"(x{i} * {float(a)!r}::DOUBLE - floor(x{i} * {float(a)!r}::DOUBLE)) * {float(b)!r}::DOUBLE"
             for i, (a, b) in enumerate(zip(first, second))]
    rows, most = f"rows{tag}", ks if isinstance(ks, str) else max(ks)
    count = f"{OVERSAMPLING} * {most}" if isinstance(ks, str) else OVERSAMPLING * most
    parts = [
        f"{rows} AS MATERIALIZED (SELECT row_number() OVER () AS pid, count(*) AS w, {_x(width)}, {' + '.join(terms)} AS mixed "
        f"FROM {points} GROUP BY {_x(width)})"
    ]

    def drawn(mass: str, n: int | str) -> str:
        """Of (seed, pid, mixed, factor and what the mass needs) the n least keys of each seed."""
        return (f"SELECT seed, pid, key FROM (SELECT seed, pid, -ln({_u('factor')}) / ({mass}) AS key FROM src "
                f"WHERE {_u('factor')} > 0 AND {mass} > 0) QUALIFY row_number() OVER (PARTITION BY seed ORDER BY key) <= {n}")

    found = f"found{tag}_0"
    parts.append(f"{found} AS MATERIALIZED (WITH src AS (SELECT * FROM {rows} CROSS JOIN {_factors(seeds, 0)}), d AS ({drawn('w', 1)}) "
                 f"SELECT d.seed, 0 AS place, r.w, r.mixed, {_x(width, 'r')} FROM d JOIN {rows} r USING (pid))")
    for step in range(1, SEEDING_STEPS + 1):
        old, found = found, f"found{tag}_{step}"
        parts.append(
            f"{found} AS MATERIALIZED (WITH near AS (SELECT c.seed, p.pid, any_value(p.w) AS w, any_value(p.mixed) AS mixed, "
            f"min({_squared(width, 'p', 'c')}) AS d2 FROM {rows} p CROSS JOIN {old} c GROUP BY c.seed, p.pid), "
            f"src AS (SELECT * FROM near JOIN {_factors(seeds, step)} USING (seed)), d AS ({drawn('w * d2', count)}) "
            f"SELECT * FROM {old} UNION ALL SELECT d.seed, "
            f"(SELECT max(o.place) FROM {old} o WHERE o.seed = d.seed) + row_number() OVER (PARTITION BY d.seed ORDER BY d.key), "
            f"r.w, r.mixed, {_x(width, 'r')} FROM d JOIN {rows} r USING (pid))"
        )
    # Drawn rows weighted by the rows nearest to them.
    parts.append(
        f"weighed{tag} AS MATERIALIZED (SELECT f.seed, f.place, any_value(f.mixed) AS mixed, coalesce(sum(n.w), 0) AS w, "
        f"{', '.join(f'any_value(f.x{i}) AS x{i}' for i in range(width))} FROM {found} f LEFT JOIN ("
        f"SELECT c.seed, p.pid, any_value(p.w) AS w, arg_min(c.place, {{'d2': {_squared(width, 'p', 'c')}, 'place': c.place}}) AS place "
        f"FROM {rows} p CROSS JOIN {found} c GROUP BY c.seed, p.pid) n ON n.seed = f.seed AND n.place = f.place GROUP BY 1, 2)"
    )
    factor = (f"(1000.0::DOUBLE + 9000.0::DOUBLE * ((4096 * seed + t + {THINNING + 1})::DOUBLE * 0.6180339887498949::DOUBLE "
              f"- floor((4096 * seed + t + {THINNING + 1})::DOUBLE * 0.6180339887498949::DOUBLE)))")
    mass = "w * CASE WHEN t = 0 THEN 1.0::DOUBLE ELSE d2 END"
    parts.append(
        f"thin{tag} AS (SELECT seed, place, mixed, w, {_x(width)}, 0 AS t, 'inf'::DOUBLE AS d2, NULL::BIGINT AS pick FROM weighed{tag} "
        f"UNION ALL SELECT a.seed, a.place, a.mixed, a.w, {_x(width, 'a')}, a.t + 1, least(a.d2, {_squared(width, 'a', 'b')}), a.pick FROM ("
        f"SELECT seed, place, mixed, w, {_x(width)}, t, d2, arg_min(place, key) OVER (PARTITION BY seed) AS pick FROM ("
        f"SELECT *, CASE WHEN {_u(factor)} > 0 AND {mass} > 0 THEN -ln({_u(factor)}) / ({mass}) END AS key FROM thin{tag} WHERE t < {most})) a "
        f"JOIN weighed{tag} b ON a.seed = b.seed AND a.pick = b.place)"
    )
    parts.append(f"starts{tag} AS MATERIALIZED (SELECT seed, t - 1 AS cluster, {_x(width)} FROM thin{tag} WHERE pick = place)")
    # One run for each k and seed; finished ones keep their centers.
    each = ", ".join(f"({s})" for s in seeds)
    wanted = f"(SELECT {most})" if isinstance(ks, str) else "(VALUES " + ", ".join(f"({k})" for k in sorted(ks)) + ")"
    parts += lloyd_until(
        rows, width, f"SELECT (g.k * {len(seeds)} + row_number) AS run, g.k, g.seed, s.cluster, false AS done, {_x(width, 's')} "
        f"FROM (SELECT k, seed, row_number() OVER (PARTITION BY k ORDER BY seed) - 1 AS row_number FROM {wanted} a(k), "
        f"(VALUES {each}) b(seed)) g JOIN starts{tag} s ON s.seed = g.seed AND s.cluster < g.k", tolerance, tag)
    last = f"s{tag}_{MAX_ITERATIONS}"
    parts.append(
        f"best{tag} AS MATERIALIZED (WITH costs AS (SELECT run, sum(b.d2 * w) AS cost FROM ({near_rows(rows, last, width)}) GROUP BY run), "
        f"won AS (SELECT c.k, arg_min(c.run, {{'cost': costs.cost, 'seed': c.seed}}) AS run FROM "
        f"(SELECT DISTINCT run, k, seed FROM {last}) c JOIN costs USING (run) GROUP BY c.k) "
        f"SELECT c.k AS run, c.cluster, {_x(width, 'c')} FROM {last} c JOIN won ON won.run = c.run)"
    )
    return parts

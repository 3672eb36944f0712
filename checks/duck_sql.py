"""The same queries in SQL, for DuckDB on the same tables.

K-means, principal components and the jobs made of them are written out as chains of common
table expressions, so that each iteration is plain SQL over the whole table.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from checks import starts as S
from checks.seeded_sql import lloyd_until, near_rows, seeded
from clusterkit.operators.anomaly import ANOMALY_CLUSTERS
from clusterkit.operators.kmeans import (
    DEFAULT_K, DEFAULT_TOLERANCE, MAX_ITERATIONS, RESTARTS, RESTART_TOLERANCE,
)

POWER_STEPS = 400


def cols(prefix: str, width: int, source: str = "") -> list[str]:
    dot = f"{source}." if source else ""
    return [f"{dot}{prefix}{i}" for i in range(width)]


def r6(expression: str) -> str:
    return f"round({expression}, 6) + 0.0"


def r4(expression: str) -> str:
    return f"round({expression}, 4) + 0.0"


# Every K up to floor(sqrt(n / 2)), each with its points spread along the diagonal from -1 to 1.
EVERY_K_STARTS = (
    "SELECT k::INTEGER AS run, j::INTEGER AS cluster, "
    + ", ".join(f"-1.0::DOUBLE + 2.0::DOUBLE * ((j + 0.5::DOUBLE) / k) AS x{i}" for i in range(3))
    + " FROM range(1, (SELECT floor(sqrt(count(*) // 2)) FROM pts)::BIGINT + 1) t(k), range(k) u(j)"
)


def start_values(runs: Mapping[int, Sequence[Sequence[float]]]) -> str:
    rows = [
        f"({run}, {cluster}, {', '.join(f'{float(x)!r}::DOUBLE' for x in center)})"
        for run, centers in runs.items() for cluster, center in enumerate(centers)
    ]
    width = len(next(iter(runs.values()))[0])
    return f"SELECT * FROM (VALUES {', '.join(rows)}) v(run, cluster, {', '.join(cols('x', width))})"


def nearest(points: str, centers: str, width: int) -> str:
    """(pid, run, b.d2, b.cluster): squared distance and id of the nearest center, lower id on a tie."""
    d2 = " + ".join(f"(p.x{i} - c.x{i}) * (p.x{i} - c.x{i})" for i in range(width))
    return (
        f"SELECT p.pid, c.run, min({{'d2': {d2}, 'cluster': c.cluster}}) AS b "
        f"FROM {points} p CROSS JOIN {centers} c GROUP BY p.pid, c.run"
    )


def lloyd(points: str, width: int, starts: str, iterations: int, tag: str = "") -> list[str]:
    """CTEs that end in ``centers{tag}`` (run, cluster, x...) and ``near{tag}`` (pid, run, b)."""
    parts = [f"c{tag}_0 AS MATERIALIZED ({starts})"]
    for i in range(1, iterations + 1):
        old, new = f"c{tag}_{i - 1}", f"c{tag}_{i}"
        means = ", ".join(f"avg(p.x{j}) AS x{j}" for j in range(width))
        kept = ", ".join(f"coalesce(m.x{j}, o.x{j}) AS x{j}" for j in range(width))
        parts.append(
            f"{new} AS MATERIALIZED (SELECT o.run, o.cluster, {kept} FROM {old} o LEFT JOIN ("
            f"SELECT n.run, n.b.cluster AS cluster, {means} FROM ({nearest(points, old, width)}) n "
            f"JOIN {points} p USING (pid) GROUP BY 1, 2) m ON o.run = m.run AND o.cluster = m.cluster)"
        )
    parts.append(f"centers{tag} AS (SELECT * FROM c{tag}_{iterations})")
    parts.append(f"near{tag} AS MATERIALIZED ({nearest(points, f'centers{tag}', width)})")
    return parts


def zscored(source: str, target: str, width: int, keep: str, constants: Sequence[int] = ()) -> str:
    """A CTE with z-scores of x0.. of another one."""
    stats = ", ".join(f"avg(x{i}) AS m{i}, stddev_pop(x{i}) AS s{i}" for i in range(width) if i not in constants)
    scaled = ", ".join(
        f"0.0::DOUBLE AS x{i}" if i in constants
        else f"CASE WHEN s.s{i} <= 0 THEN p.x{i} - s.m{i} ELSE (p.x{i} - s.m{i}) / s.s{i} END AS x{i}"
        for i in range(width)
    )
    return (
        f"{target}_s AS MATERIALIZED (SELECT {stats} FROM {source}), "
        f"{target} AS MATERIALIZED (SELECT {keep}, {scaled} FROM {source} p CROSS JOIN {target}_s s)"
    )


def principal(points: str, width: int, components: int, tag: str = "", steps: int = POWER_STEPS,
              constants: Sequence[int] = ()) -> list[str]:
    """CTEs that end in ``pc{tag}_0``, ``pc{tag}_1``, ... (i, v): power iteration on the sample
    covariance, deflated after each component, the largest loading turned positive."""
    used = [i for i in range(width) if i not in constants]
    entries = ", ".join(f"covar_samp(x{i}, x{j}) AS c_{i}_{j}" for i in used for j in used if i <= j)
    cells = " UNION ALL ".join(
        f"SELECT {i} AS i, {j} AS j, c_{min(i, j)}_{max(i, j)} AS c FROM cov{tag}" for i in used for j in used
    )
    parts = [f"cov{tag} AS MATERIALIZED (SELECT {entries} FROM {points})", f"m{tag}_0 AS MATERIALIZED ({cells})"]
    for n in range(components):
        matrix, name = f"m{tag}_{n}", f"p{tag}_{n}"
        parts.append(
            f"{name} AS (SELECT 0 AS step, i, 1.0 / (i + 1.5) AS v FROM (SELECT DISTINCT i FROM {matrix}) "
            f"UNION ALL SELECT step, i, w / sqrt(sum(w * w) OVER ()) FROM ("
            f"SELECT any_value(p.step) + 1 AS step, m.i, sum(m.c * p.v) AS w FROM {matrix} m JOIN {name} p ON m.j = p.i "
            f"WHERE p.step < {steps} GROUP BY m.i))"
        )
        parts.append(
            f"pc{tag}_{n} AS MATERIALIZED (SELECT i, v * (SELECT sign(arg_max(v, abs(v))) FROM {name} WHERE step = {steps}) AS v "
            f"FROM {name} WHERE step = {steps})"
        )
        if n + 1 < components:
            parts.append(
                f"m{tag}_{n + 1} AS MATERIALIZED (SELECT m.i, m.j, m.c - a.v * b.v * e.e AS c FROM {matrix} m "
                f"JOIN pc{tag}_{n} a ON a.i = m.i JOIN pc{tag}_{n} b ON b.i = m.j CROSS JOIN ("
                f"SELECT sum(a.v * m.c * b.v) AS e FROM {matrix} m JOIN pc{tag}_{n} a ON a.i = m.i "
                f"JOIN pc{tag}_{n} b ON b.i = m.j) e)"
            )
    return parts


def projection(points: str, target: str, width: int, components: int, keep: str, tag: str = "",
               constants: Sequence[int] = (), means: Mapping[int, str] | None = None) -> str:
    """A CTE with the rows of another one times the components, not centered."""
    used = [i for i in range(width) if i not in constants]
    flat = ", ".join(
        f"(SELECT v FROM pc{tag}_{n} WHERE i = {i}) AS l{n}_{i}" for n in range(components) for i in used
    )
    sums = ", ".join(
        " + ".join(f"p.x{i} * l.l{n}_{i}" for i in used) + f" AS x{n}" for n in range(components)
    )
    return (
        f"{target}_l AS MATERIALIZED (SELECT {flat}), "
        f"{target} AS MATERIALIZED (SELECT {keep}, {sums} FROM {points} p CROSS JOIN {target}_l l)"
    )


def chain(parts: Sequence[str], final: str, recursive: bool = False) -> str:
    return f"WITH {'RECURSIVE ' if recursive else ''}" + ",\n".join(parts) + "\n" + final


def entropy(counts: str, by: str = "") -> str:
    """Size-weighted entropy of (cluster, n), from its definition."""
    key, group = (f"{by}, ", f"GROUP BY {by}") if by else ("", "")
    partition = f"{by}, cluster" if by else "cluster"
    return (
        f"SELECT {key}{r6('sum(t * h) / sum(t)')} AS score FROM ("
        f"SELECT {partition}, any_value(t) AS t, sum(-(n / t) * ln(n / t)) AS h FROM ("
        f"SELECT {partition}, n, sum(n) OVER (PARTITION BY {partition}) AS t FROM ({counts})) GROUP BY {partition}) {group}"
    )


# -- sources ----------------------------------------------------------------------------------

ITEMS = """pts AS MATERIALIZED (SELECT row_number() OVER () AS pid, l_orderkey, l_linenumber,
 l_returnflag AS label, l_quantity AS x0, l_extendedprice / 1000 AS x1, l_discount * 100 AS x2,
 l_tax * 100 AS x3 FROM lineitem)"""

DAY = "strftime(l_shipdate, '%Y%m%d')::DOUBLE"
TRADE_FIELDS = [
    DAY, DAY, "l_quantity", "l_linenumber::DOUBLE", DAY, "l_extendedprice",
    "l_extendedprice * (1 - l_discount)", "l_tax", "0.0::DOUBLE", "0.0::DOUBLE",
]
TRADE_LABEL = "'T' || l_orderkey || '-' || l_linenumber"


def flag(column: str, value: str) -> str:
    return f"CASE WHEN {column} = '{value}' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END"


# The first number, the blocks from the last field to the first, the other numbers. A field with
# a single value is one constant slot.
TRADE_SLOTS = (
    TRADE_FIELDS[:1]
    + ["1.0::DOUBLE"] * 10  # currency_cftr back to trade_maturity_date
    + [flag("l_linestatus", v) for v in "FO"]  # buy_sell
    + ["1.0::DOUBLE"] * 3  # instrument_description, currency, counterparty
    + [flag("'B' || l_linenumber", f"B{n}") for n in range(1, 8)]  # book_id
    + [flag("l_returnflag", v) for v in "ANR"]  # product_type
    + TRADE_FIELDS[1:]
)
TRADE_CONSTANTS = [i for i, e in enumerate(TRADE_SLOTS) if e in ("1.0::DOUBLE", "0.0::DOUBLE")]


def trades(expressions: Sequence[str], name: str = "raw") -> str:
    x = ", ".join(f"{e} AS x{i}" for i, e in enumerate(expressions))
    return (
        f"{name} AS MATERIALIZED (SELECT row_number() OVER () AS pid, {TRADE_LABEL} AS trade, "
        f"l_returnflag AS label, {x} FROM lineitem)"
    )


BATCH = f"event_id * {S.BATCHES} // (SELECT max(event_id) + 1 FROM events)"
EVENT_FIELDS = ["user_id::DOUBLE", "value", "hour(ts)::DOUBLE"]
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]
EVENT_SLOTS = EVENT_FIELDS[:1] + [flag("event_type", t) for t in EVENT_TYPES] + EVENT_FIELDS[1:]


def events(expressions: Sequence[str], name: str = "ev") -> str:
    x = ", ".join(f"{e} AS x{i}" for i, e in enumerate(expressions))
    return (
        f"{name} AS MATERIALIZED (SELECT event_id AS pid, {BATCH} AS batch_id, "
        f"event_type AS label, {x} FROM events)"
    )


def one_batch(batch: int, source: str = "ev") -> str:
    return f"{source}{batch} AS MATERIALIZED (SELECT * FROM {source} WHERE batch_id = {batch})"


EMBEDDINGS = (
    "emb AS MATERIALIZED (SELECT vec_id AS pid, vec_id, "
    + ", ".join(f"embedding[{i + 1}]::DOUBLE AS x{i}" for i in range(64)) + " FROM embeddings)"
)


# -- query texts ------------------------------------------------------------------------------


def item_query(final: str) -> str:
    return chain([ITEMS, *lloyd("pts", 4, start_values({0: S.ITEM_STARTS}), S.ITERATIONS)], final)


ASSIGNED = "near n JOIN pts p USING (pid)"
DISTANCE = "sqrt(n.b.d2)"


def threshold(rows: str, rank: int = 100) -> str:
    return f"(SELECT min(d) FROM (SELECT sqrt(b.d2) AS d FROM {rows} ORDER BY d DESC LIMIT {rank}))"


def sweep_scores(near: str) -> str:
    return f"SELECT run AS k, {r6('avg(sqrt(b.d2))')} AS score FROM {near} GROUP BY run"


def sweep_starts(make) -> str:
    return start_values({k: make(k) for k in S.SWEEP})


def plain_sql() -> dict[str, str]:
    item_columns = "l_orderkey, l_partkey, l_suppkey, l_linenumber::BIGINT AS l_linenumber, l_quantity, " \
        "l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus"
    zstats = "(SELECT avg(l_quantity) m0, stddev_pop(l_quantity) s0, avg(l_extendedprice) m1, " \
        "stddev_pop(l_extendedprice) s1, avg(l_tax) m2, stddev_pop(l_tax) s2, avg(7.5::DOUBLE) m3 FROM lineitem)"
    z = [r6(f"({c} - m{i}) / s{i}") for i, c in enumerate(("l_quantity", "l_extendedprice", "l_tax"))]
    items4 = [("l_quantity", 0), ("l_extendedprice / 1000", 1), ("l_discount * 100", 2), ("l_tax * 100", 3)]
    covariances = " UNION ALL ".join(
        f"SELECT {i}::INTEGER AS i, {j}::INTEGER AS j, {r6(f'covar_samp({a}, {b})')} AS covariance FROM lineitem"
        for a, i in items4 for b, j in items4 if i <= j
    )
    return {
        "q01_parse_delimited":
            f"SELECT {item_columns}, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S.%f') AS l_shipdate FROM lineitem",
        "q02_parse_numeric_tsv":
            "SELECT event_id::DOUBLE AS x0, user_id::DOUBLE AS x1, value AS x2 FROM events",
        "q03_numeric_features":
            f"SELECT {TRADE_LABEL} AS label, {', '.join(f'{e} AS f{i}' for i, e in enumerate(TRADE_FIELDS))} FROM lineitem",
        "q04_blank_to_zero":
            "SELECT event_id, CASE WHEN event_id % 7 = 0 THEN 0.0 WHEN event_id % 11 = 0 THEN NULL ELSE value END AS amount, "
            "CASE WHEN event_id % 7 <> 0 AND event_id % 11 = 0 THEN 'not a number' ELSE 'kept' END AS outcome FROM events",
        "q05_last_field_counts":
            "SELECT l_returnflag AS value, count(*) AS count FROM lineitem GROUP BY 1",
        "q06_category_index":
            "SELECT event_type AS value, (row_number() OVER (ORDER BY event_type) - 1)::INTEGER AS index "
            "FROM (SELECT DISTINCT event_type FROM events)",
        "q06b_category_lookup":
            "SELECT event_type, event_id, (dense_rank() OVER (ORDER BY event_type) - 1)::INTEGER AS index FROM events",
        "q07_one_hot_assemble":
            f"SELECT {TRADE_LABEL} AS label, {', '.join(f'{e} AS s{i}' for i, e in enumerate(TRADE_SLOTS))} FROM lineitem",
        "q07b_wide_one_hot":
            "WITH u AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS i FROM (SELECT DISTINCT user_id::VARCHAR AS v FROM events)), "
            "t AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS i FROM (SELECT DISTINCT event_type AS v FROM events)), "
            "n AS (SELECT (SELECT count(*) FROM t) AS types, (SELECT count(*) FROM u) AS users) "
            "SELECT event_id, 0::INTEGER AS slot, value FROM events WHERE value <> 0 "
            "UNION ALL SELECT event_id, (1 + t.i)::INTEGER, 1.0::DOUBLE FROM events JOIN t ON t.v = event_type "
            "UNION ALL SELECT event_id, (1 + types + u.i)::INTEGER, 1.0::DOUBLE FROM events JOIN u ON u.v = user_id::VARCHAR, n "
            "UNION ALL SELECT event_id, (1 + types + users)::INTEGER, hour(ts)::DOUBLE FROM events, n WHERE hour(ts) <> 0",
        "q10_estimate_k": "SELECT floor(sqrt(count(*) // 2))::INTEGER AS k FROM lineitem",
        "q11_vector_stats":
            f"SELECT (i - 1)::INTEGER AS dim, {r6('sum(x)')} AS sum, {r6('sum(x * x)')} AS sum_squares, "
            f"{r6('avg(x)')} AS mean, {r6('stddev_pop(x)')} AS std FROM (SELECT unnest(embedding::DOUBLE[]) AS x, "
            "generate_subscripts(embedding, 1) AS i FROM embeddings) GROUP BY i",
        "q12_zscore":
            f"SELECT l_orderkey, l_linenumber, {z[0]} AS z0, {z[1]} AS z1, {z[2]} AS z2, {r6('7.5 - m3')} AS z3 "
            f"FROM lineitem CROSS JOIN {zstats}",
        "q13_zscore_nan_safe":
            f"SELECT l_orderkey, l_linenumber, {z[0]} AS z0, {z[1]} AS z1, "
            f"CASE WHEN (SELECT count(*) FROM lineitem WHERE l_linenumber = 7) > 0 THEN 0.0 ELSE {z[2]} END AS z2, "
            f"{r6('7.5 - m3')} AS z3 FROM lineitem CROSS JOIN {zstats}",
        "q14_covariance": covariances,
        "q15b_pca_lineitem": chain(
            [ITEMS, *principal("pts", 4, 2), projection("pts", "proj", 4, 2, "p.l_orderkey, p.l_linenumber")],
            f"SELECT l_orderkey, l_linenumber, {r6('x0')} AS p0, {r6('x1')} AS p1 FROM proj", recursive=True,
        ),
    }


def item_sql() -> dict[str, str]:
    centers = ", ".join(f"{r6(f'x{i}')} AS c{i}" for i in range(4))
    means = ", ".join(f"{r6(f'avg(x{i})')} AS c{i}" for i in range(4))
    counts = f"SELECT n.b.cluster AS cluster, p.label, count(*) AS count FROM {ASSIGNED} GROUP BY 1, 2"
    restarts = lloyd("pts", 4, start_values(dict(enumerate(S.ITEM_RESTARTS))), S.ITERATIONS)
    return {
        "q16_k1_center": chain([ITEMS], f"SELECT 0 AS cluster, count(*)::DOUBLE AS weight, {means} FROM pts"),
        "q17_lloyd_centers": item_query(
            f"SELECT cluster, {centers}, (SELECT count(*)::DOUBLE FROM near n WHERE n.b.cluster = centers.cluster) AS weight "
            "FROM centers"),
        "q19_assign": item_query(f"SELECT l_orderkey, l_linenumber, n.b.cluster AS cluster FROM {ASSIGNED}"),
        "q20_distance_to_center": item_query(
            f"SELECT l_orderkey, l_linenumber, {r4(DISTANCE)} AS distance FROM {ASSIGNED}"),
        "q20b_center_join": item_query(
            f"SELECT l_orderkey, l_linenumber, n.b.cluster AS cluster, {r4(DISTANCE)} AS distance FROM {ASSIGNED}"),
        "q21_cluster_label_counts": item_query(counts),
        "q22_mean_distance": item_query(f"SELECT {r6('avg(sqrt(b.d2))')} AS score FROM near"),
        "q24_weighted_entropy": item_query(entropy(
            f"SELECT n.b.cluster AS cluster, p.label, count(*) AS n FROM {ASSIGNED} GROUP BY 1, 2")),
        "q26b_given_restarts": chain([ITEMS, *restarts],
            f"SELECT {r6('avg(sqrt(b.d2))')} AS score, {r4('sum(b.d2)')} AS cost FROM near "
            "GROUP BY run ORDER BY sum(b.d2), run LIMIT 1"),
        "q30_rank_threshold": item_query(f"SELECT {r6(threshold('near'))} AS threshold"),
        "q31_anomalies": item_query(
            f"SELECT l_orderkey, l_linenumber, n.b.cluster AS cluster, {r4(DISTANCE)} AS distance "
            f"FROM {ASSIGNED} WHERE {DISTANCE} > {threshold('near')}"),
        "q50b_anomaly_lines": item_query(
            f"SELECT 'cluster ' || n.b.cluster || ' row ' || l_orderkey || '-' || l_linenumber AS line "
            f"FROM {ASSIGNED} WHERE {DISTANCE} > {threshold('near')}"),
        "q50_report_lines": item_query(
            f"SELECT 'cluster ' || cluster || ' label ' || label || ' count ' || count AS line FROM ({counts})"),
    }


def covariance_sql() -> str:
    return (
        "WITH u AS (SELECT vec_id, unnest(range(64)) AS i, unnest(embedding)::DOUBLE AS x FROM embeddings) "
        f"SELECT a.i::INTEGER AS i, b.i::INTEGER AS j, {r6('covar_samp(a.x, b.x)')} AS covariance "
        "FROM u a JOIN u b ON a.vec_id = b.vec_id AND a.i <= b.i GROUP BY 1, 2"
    )


def seeded_sql() -> dict[str, str]:
    """Groups far apart are the one best clustering, so a fit from any seed must return them."""
    two = "CASE WHEN l_returnflag = 'N' THEN 1 ELSE 0 END"
    three = "instr('ANR', l_returnflag)"
    many = "l_suppkey % 15 * 10 + l_partkey % 10"

    def points(group: str) -> str:
        return (f"pts AS (SELECT l_orderkey, l_linenumber, {group} AS g, ({group})::DOUBLE * 1e4 + l_linenumber AS x0, "
                "l_quantity::DOUBLE AS x1 FROM lineitem)")

    def centers(group: str) -> str:
        return chain([points(group)],
                     f"SELECT (row_number() OVER (ORDER BY avg(x0)) - 1)::INTEGER AS cluster, count(*)::DOUBLE AS weight, "
                     f"{r6('avg(x0)')} AS c0, {r6('avg(x1)')} AS c1 FROM pts GROUP BY g")

    gap = "sqrt((x0 - m0) * (x0 - m0) + (x1 - m1) * (x1 - m1))"
    near = ("d AS (SELECT *, {gap} AS distance FROM (SELECT *, avg(x0) OVER ({by}) AS m0, avg(x1) OVER ({by}) AS m1 FROM pts))")
    each = near.format(gap=gap, by="PARTITION BY g")
    ten = range(RESTARTS)
    return {
        "q25_default_job": chain(
            [trades(TRADE_FIELDS), *seeded("raw", S.TRADE_NUMBERS, [DEFAULT_K], [0], DEFAULT_TOLERANCE),
             f"near AS ({nearest('raw', 'best', S.TRADE_NUMBERS)})"],
            "SELECT n.b.cluster::INTEGER AS cluster, p.label, count(*) AS count FROM near n JOIN raw p USING (pid) GROUP BY 1, 2",
            recursive=True),
        "q26_restarts_score": chain(
            [EMBEDDINGS, *seeded("emb", 64, [1, 2, 10], ten, RESTART_TOLERANCE), f"near AS ({nearest('emb', 'best', 64)})"],
            sweep_scores("near"), recursive=True),
        "q32b_anomalies_seeded": chain(
            [EMBEDDINGS, *seeded("emb", 64, [ANOMALY_CLUSTERS], ten, RESTART_TOLERANCE),
             f"near AS MATERIALIZED ({nearest('emb', 'best', 64)})"],
            f"SELECT p.vec_id, n.b.cluster::INTEGER AS cluster, {r6(DISTANCE)} AS distance FROM near n JOIN emb p USING (pid) "
            f"WHERE {DISTANCE} > {threshold('near')}", recursive=True),
        "q14b_covariance_embeddings": covariance_sql(),
        "q25c_seeded_default_fit": centers(two),
        "q26c_seeded_best_of_ten": centers(three),
        "q26d_seeded_careful_score": chain([points(three), each, each.replace("d AS", "one AS", 1).replace("PARTITION BY g", "")],
            f"SELECT 1::INTEGER AS k, {r6('avg(distance)')} AS score FROM one UNION ALL "
            f"SELECT 3::INTEGER AS k, {r6('avg(distance)')} AS score FROM d"),
        "q32c_seeded_anomalies": chain([points(many), each],
            f"SELECT l_orderkey, l_linenumber, {r4('distance')} AS distance FROM d WHERE distance > "
            "(SELECT min(distance) FROM (SELECT distance FROM d ORDER BY distance DESC LIMIT 100))"),
    }


def job_sql() -> dict[str, str]:
    numbers = S.TRADE_NUMBERS
    fixed = lloyd("raw", numbers, start_values({0: S.trade_start(2)}), S.ITERATIONS)
    raw_sweep = lloyd("raw", numbers, sweep_starts(S.trade_start), S.ITERATIONS)
    norm = [trades(TRADE_FIELDS), zscored("raw", "pts", numbers, "p.pid")]
    encoded = [trades(TRADE_SLOTS), zscored("raw", "pts", S.TRADE_WIDTH, "p.pid, p.trade", TRADE_CONSTANTS)]
    reduced = [
        trades(TRADE_SLOTS), *principal("raw", S.TRADE_WIDTH, 2, constants=TRADE_CONSTANTS),
        projection("raw", "proj", S.TRADE_WIDTH, 2, "p.pid, p.trade, p.label", constants=TRADE_CONSTANTS),
        zscored("proj", "pts", 2, "p.pid, p.trade, p.label"),
    ]
    init = [f"init AS (SELECT row_number() OVER (ORDER BY vec_id) - 1 AS cluster, {', '.join(cols('x', 64))} FROM emb)"]
    starts = f"SELECT 0 AS run, cluster::INTEGER AS cluster, {', '.join(cols('x', 64))} FROM init WHERE cluster < 150"
    top = lloyd("pts", S.TRADE_WIDTH, start_values({0: S.spread(S.TRADE_WIDTH)(3)}), S.ITERATIONS)
    return {
        "q23_k_sweep": chain(
            [trades(TRADE_FIELDS), *raw_sweep,
             *lloyd("raw", numbers, sweep_starts(S.careful_start), S.ITERATIONS, "_c")],
            f"SELECT a.k, a.score, b.score AS score2 FROM ({sweep_scores('near')}) a JOIN ({sweep_scores('near_c')}) b USING (k)"),
        "q50c_score_lines": chain([trades(TRADE_FIELDS), *raw_sweep],
            "SELECT 'cluster ' || k || ' score ' || printf('%.4f', score) AS line FROM "
            "(SELECT run AS k, avg(sqrt(b.d2)) AS score FROM near GROUP BY run)"),
        "q25b_fixed_start_job": chain([trades(TRADE_FIELDS), *fixed],
            "SELECT n.b.cluster AS cluster, p.label, count(*) AS count FROM near n JOIN raw p USING (pid) GROUP BY 1, 2"),
        "q27_pca_entropy_job": chain(
            [*reduced, *lloyd("pts", 2, sweep_starts(S.spread(2)), S.ITERATIONS)],
            entropy("SELECT n.run AS k, n.b.cluster AS cluster, p.label, count(*) AS n FROM near n "
                    "JOIN pts p USING (pid) GROUP BY 1, 2, 3", "k"), recursive=True),
        "q28_normalised_sweep": chain(
            [*norm, *lloyd("pts", numbers, sweep_starts(S.spread(numbers)), S.ITERATIONS)], sweep_scores("near")),
        "q28b_every_k_sweep": chain(
            [events(EVENT_FIELDS, "raw"), zscored("raw", "pts", 3, "p.pid"),
             *lloyd("pts", 3, EVERY_K_STARTS, S.ITERATIONS)], sweep_scores("near")),
        "q29_categorical_sweep": chain(
            [*encoded, *lloyd("pts", S.TRADE_WIDTH, sweep_starts(S.spread(S.TRADE_WIDTH)), S.ITERATIONS)],
            sweep_scores("near")),
        "q32_anomalies_fixed_k": chain(
            [EMBEDDINGS, *init, *lloyd("emb", 64, starts, S.ITERATIONS)],
            f"SELECT p.vec_id, n.b.cluster AS cluster, {r6(DISTANCE)} AS distance FROM near n JOIN emb p USING (pid) "
            f"WHERE {DISTANCE} > {threshold('near')}"),
        "q33_top10_anomalies": chain([*encoded, *top],
            f"SELECT p.trade AS label, {r6(DISTANCE)} AS distance FROM near n JOIN pts p USING (pid) "
            f"WHERE {DISTANCE} > {threshold('near')} ORDER BY {DISTANCE} DESC, p.trade LIMIT 10"),
        "q34_pca_anomalies": chain([*reduced, *lloyd("pts", 2, start_values({0: S.spread(2)(3)}), S.ITERATIONS)],
            f"SELECT p.trade AS label, {r6(DISTANCE)} AS distance FROM near n JOIN pts p USING (pid) "
            f"WHERE {DISTANCE} > {threshold('near')}", recursive=True),
    }


def every_k(points: str, expressions: Sequence[str], limit: str | None = None) -> str:
    """A start for every K up to the rule of thumb (or ``limit``), its points by expressions of j and k."""
    x = ", ".join(f"({e})::DOUBLE AS x{i}" for i, e in enumerate(expressions))
    limit = limit or f"(SELECT floor(sqrt(count(*) // 2)) FROM {points})"
    return (f"SELECT k::INTEGER AS run, k::INTEGER AS k, 0 AS seed, j::INTEGER AS cluster, false AS done, {x} "
            f"FROM range(1, {limit}::BIGINT + 1) t(k), range(k) u(j)")


DIAGONAL = "-1.0::DOUBLE + 2.0::DOUBLE * ((j + 0.5::DOUBLE) / k)"
EVENT_POINT = ["50.0", "200.0::DOUBLE * (j + 0.5::DOUBLE) / k", "12.0"]


def default_sql() -> dict[str, str]:
    """Jobs with their own parameters: every K, 20 iterations, the stop at 1e-6, K by the rule of thumb."""
    width = len(EVENT_SLOTS)

    def scores(points: str, count: int, tag: str = "") -> str:
        return f"SELECT run AS k, {r6('avg(sqrt(b.d2))')} AS score FROM ({near_rows(points, f's{tag}_{MAX_ITERATIONS}', count, '1')}) GROUP BY run"

    labelled = ("SELECT n.run AS k, n.b.cluster AS cluster, p.label, count(*) AS n FROM "
                f"({near_rows('pts1', f's_{MAX_ITERATIONS}', 3, '1')}) n JOIN pts p USING (pid) GROUP BY 1, 2, 3")
    weigh = lambda name, count: f"{name}1 AS MATERIALIZED (SELECT pid, 1 AS w, {', '.join(cols('x', count))} FROM {name})"
    running = [events(EVENT_FIELDS)]
    for b in range(S.BATCHES):
        mean_k = (f"(SELECT sum(k) // count(*) FROM (SELECT batch_id, floor(sqrt(count(*) // 2))::BIGINT AS k FROM ev "
                  f"WHERE batch_id <= {b} GROUP BY 1))")
        running += [one_batch(b), zscored(f"ev{b}", f"pts{b}", 3, "p.pid"), weigh(f"pts{b}", 3),
                    *lloyd_until(f"pts{b}1", 3, every_k("", [DIAGONAL] * 3, mean_k), RESTART_TOLERANCE, f"_b{b}")]
    features = "pts AS MATERIALIZED (SELECT event_id AS pid, value AS x0, hour(ts)::DOUBLE AS x1 FROM events)"
    thumb = "(SELECT floor(sqrt(count(*) // 2))::BIGINT FROM pts)"
    return {
        "q23b_raw_sweep_default": chain(
            [events(EVENT_FIELDS, "pts"), weigh("pts", 3), *lloyd_until("pts1", 3, every_k("pts", EVENT_POINT), RESTART_TOLERANCE)],
            f"SELECT k, score, score AS score2 FROM ({scores('pts1', 3)})"),
        "q29b_categorical_sweep_default": chain(
            [events(EVENT_SLOTS, "raw"), zscored("raw", "pts", width, "p.pid"), weigh("pts", width),
             *lloyd_until("pts1", width, every_k("pts", [DIAGONAL] * width), RESTART_TOLERANCE)], scores("pts1", width)),
        "q27b_pca_entropy_default": chain(
            [events(EVENT_SLOTS, "raw"), *principal("raw", width, 3),
             projection("raw", "proj", width, 3, "p.pid, p.label"), zscored("proj", "pts", 3, "p.pid, p.label"), weigh("pts", 3),
             *lloyd_until("pts1", 3, every_k("pts", [DIAGONAL] * 3), RESTART_TOLERANCE)],
            f"SELECT * FROM ({entropy(labelled, 'k')})", recursive=True),
        "q46d_stream_running_sweep": chain(
            running, " UNION ALL ".join(f"SELECT {b}::BIGINT AS batch_id, k, score FROM ({scores(f'pts{b}1', 3, f'_b{b}')})"
                                        for b in range(S.BATCHES))),
        "q55_detector_estimated_k": chain(
            [features, *seeded("pts", 2, thumb, range(RESTARTS), RESTART_TOLERANCE), f"near AS MATERIALIZED ({nearest('pts', 'best', 2)})"],
            f"SELECT pid AS event_id, {r6(DISTANCE)} AS distance FROM near n WHERE {DISTANCE} > {threshold('near')}", recursive=True),
    }


def online(width: int, starts: Sequence[Sequence[float]]) -> list[str]:
    """Online K-means over the batches: ``m{b}`` (cluster, weight, x...) and ``near_b{b}`` after batch b."""
    parts = [
        events(["value", "hour(ts)::DOUBLE"]),
        f"m_start AS MATERIALIZED (SELECT run, cluster, 0.0::DOUBLE AS weight, {', '.join(cols('x', width))} "
        f"FROM ({start_values({0: starts})}))",
    ]
    old = "m_start"
    for b in range(S.BATCHES):
        sums = ", ".join(f"sum(p.x{i}) AS x{i}" for i in range(width))
        moved = ", ".join(
            f"CASE WHEN s.n IS NULL THEN o.x{i} ELSE (o.x{i} * o.weight + s.x{i}) / (o.weight + s.n) END AS x{i}"
            for i in range(width)
        )
        parts += [
            one_batch(b),
            f"m{b} AS MATERIALIZED (SELECT o.run, o.cluster, o.weight + coalesce(s.n, 0) AS weight, {moved} FROM {old} o "
            f"LEFT JOIN (SELECT n.b.cluster AS cluster, count(*) AS n, {sums} FROM ({nearest(f'ev{b}', old, width)}) n "
            f"JOIN ev{b} p USING (pid) GROUP BY 1) s USING (cluster))",
            f"near_b{b} AS MATERIALIZED ({nearest(f'ev{b}', f'm{b}', width)})",
        ]
        old = f"m{b}"
    return parts


def per_batch(template: str) -> str:
    return " UNION ALL ".join(template.replace("{b}", str(b)) for b in range(S.BATCHES))


def batch_sweeps(expressions: Sequence[str], make, scale: bool) -> list[str]:
    """``near_b{b}`` for the fixed-start sweeps of each batch by itself."""
    width = len(expressions)
    parts = [events(expressions)]
    for b in range(S.BATCHES):
        parts.append(one_batch(b))
        if scale:
            parts.append(zscored(f"ev{b}", f"pts{b}", width, "p.pid, p.label"))
        parts += lloyd(f"{'pts' if scale else 'ev'}{b}", width, sweep_starts(make), S.ITERATIONS, f"_b{b}")
    return parts


def batch_components(b: int, width: int) -> list[str]:
    return [
        one_batch(b), *principal(f"ev{b}", width, 2, f"_b{b}"),
        projection(f"ev{b}", f"proj{b}", width, 2, "p.pid, p.label", f"_b{b}"),
        zscored(f"proj{b}", f"pts{b}", 2, "p.pid, p.label"),
    ]


def stream_sql() -> dict[str, str]:
    trained = online(2, S.EVENT_STARTS)
    centers = per_batch(
        f"SELECT {{b}}::BIGINT AS batch_id, cluster, weight, {r6('x0')} AS c0, {r6('x1')} AS c1 FROM m{{b}}")
    assigned = per_batch(
        f"SELECT pid AS event_id, b.cluster AS cluster, {r6('sqrt(b.d2)')} AS distance FROM near_b{{b}}")
    labelled = per_batch(
        "SELECT {b}::BIGINT AS batch_id, n.b.cluster AS cluster, p.label, count(*) AS count "
        "FROM near_b{b} n JOIN ev{b} p USING (pid) GROUP BY 2, 3")
    predicted = per_batch("SELECT {b}::BIGINT AS batch_id, b.cluster::VARCHAR AS line FROM near_b{b}")
    outcome = ("CASE WHEN event_id % 13 = 0 THEN 'field count' WHEN event_id % 17 = 0 THEN 'not a number' ELSE 'kept' END")
    texts = per_batch("SELECT {b}::BIGINT AS batch_id, printf('%.6f,%.6f', x0, x1) AS line FROM m{b}")
    scores = per_batch(
        f"SELECT {{b}}::BIGINT AS batch_id, run AS k, {r6('avg(sqrt(b.d2))')} AS score FROM near_b{{b}} GROUP BY run")
    width = len(EVENT_SLOTS)
    reduced = [events(EVENT_SLOTS)]
    for b in range(S.BATCHES):
        reduced += batch_components(b, width)
        reduced += lloyd(f"pts{b}", 2, sweep_starts(S.spread(2)), S.ITERATIONS, f"_b{b}")
    labels = per_batch(
        "SELECT {b}::BIGINT AS batch_id, n.run AS k, n.b.cluster AS cluster, p.label, count(*) AS n "
        "FROM near_b{b} n JOIN pts{b} p USING (pid) GROUP BY 2, 3, 4")
    # History is batch 0: its components, z-scores, centers and threshold serve all batches.
    history = [
        events(EVENT_SLOTS), *batch_components(0, width),
        *lloyd("pts0", 2, start_values({0: S.spread(2)(3)}), S.ITERATIONS),
        projection("ev", "proj", width, 2, "p.pid", "_b0"),
        "pts AS MATERIALIZED (SELECT p.pid, (p.x0 - s.m0) / s.s0 AS x0, (p.x1 - s.m1) / s.s1 AS x1 "
        "FROM proj p CROSS JOIN pts0_s s)",
        f"near_all AS MATERIALIZED ({nearest('pts', 'centers', 2)})",
    ]
    return {
        "q40_stream_parse":
            "SELECT event_id, user_id::DOUBLE AS user_id, event_type, value AS amount, hour(ts)::DOUBLE AS hour FROM events",
        "q41_stream_kmeans": chain(trained, centers),
        "q41b_online_interval": chain(trained, centers),
        "q42_stream_assign": chain(trained, assigned),
        "q42b_prediction_text": chain(trained, predicted),
        "q49_observed_rejects": f"SELECT {outcome} AS outcome, count(*) AS lines FROM events GROUP BY 1",
        "q49b_stream_rejects": f"SELECT {BATCH} AS batch_id, {outcome} AS outcome, count(*) AS lines FROM events GROUP BY 1, 2",
        "q43_stream_cluster_label": chain(trained, labelled),
        "q44_stream_center_log": chain(trained, texts),
        "q45_stream_running_k":
            f"SELECT batch_id, (sum(k) OVER (ORDER BY batch_id) // count(*) OVER (ORDER BY batch_id))::INTEGER AS mean_k "
            f"FROM (SELECT {BATCH} AS batch_id, floor(sqrt(count(*) // 2))::BIGINT AS k FROM events GROUP BY 1)",
        "q46_stream_raw_sweep": chain(
            batch_sweeps(EVENT_FIELDS, S.event_start, False), f"SELECT *, score AS score2 FROM ({scores})"),
        "q46b_stream_normalised_sweep": chain(batch_sweeps(EVENT_FIELDS, S.spread(3), True), scores),
        "q46c_stream_categorical_sweep": chain(batch_sweeps(EVENT_SLOTS, S.spread(width), True), scores),
        "q47_stream_pca_entropy": chain(
            reduced, f"SELECT * FROM ({entropy(labels, 'batch_id, k')})", recursive=True),
        "q48_stream_anomalies": chain(history,
            f"SELECT pid AS event_id, b.cluster AS cluster, {r6('sqrt(b.d2)')} AS distance FROM near_all "
            f"WHERE sqrt(b.d2) > {threshold('near')}", recursive=True),
    }


def all_sql() -> dict[str, str]:
    return {**plain_sql(), **item_sql(), **seeded_sql(), **job_sql(), **default_sql(), **stream_sql()}

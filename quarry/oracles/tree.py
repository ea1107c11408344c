"""Twins of the tree queries: the level-wise tree unrolled into one CTE
block per level (``tree_sql``), routing rows through the node table
(``route_sql``), split tables, metrics, importances, batch scoring.
"""

from __future__ import annotations

from quarry.oracles.base import ORACLES, hash_bucket
from quarry.oracles.ingest import TRIPS_OUTLIER, TRIP_TEST_PARSED, TRIP_TRAIN_PARSED


TRIP_FEATS = ["vendor_id", "passenger_count", "pickup_longitude", "pickup_latitude", "dropoff_longitude",
              "dropoff_latitude"]


def tree_sql(train: str, prefix: str, depth: int = 4, min_node: int = 100, min_side: int = 50,
             gain: float = 0.95, k: int = 10, feats: list[str] = TRIP_FEATS) -> str:
    """CTEs growing the level-wise tree over ``train(x0..x{F-1}, y)``.

    Defines ``{prefix}nodes(node, depth, n, prediction, impurity, f, threshold)``.
    """
    nf = len(feats)
    p = prefix
    xs = [f"x{i}" for i in range(nf)]

    def th(i, j):
        return f"(lo{i} + {j} * (hi{i} - lo{i}) / {float(k + 1)!r})"

    bins = [" + ".join(f"CASE WHEN x{i} > {th(i, j)} THEN 1 ELSE 0 END" for j in range(1, k + 1)) for i in range(nf)]
    t_of_bin = "CASE f " + " ".join(f"WHEN {i} THEN {th(i, '(b + 1)')}" for i in range(nf)) + " END"
    x_of_f = "CASE b.f " + " ".join(f"WHEN {i} THEN r.x{i}" for i in range(nf)) + " END"
    lohi = ", ".join(f"min(x{i}) AS lo{i}, max(x{i}) AS hi{i}" for i in range(nf))
    ctes = [
        f"{p}sh AS (SELECT avg(y) AS m FROM ({train}) t)",
        f"{p}st AS (SELECT {lohi} FROM ({train}) t)",
        f"{p}r0 AS (SELECT t.*, y - m AS yc, 1::BIGINT AS node FROM ({train}) t, {p}sh)",
    ]
    levels = []
    for L in range(depth + 1):
        ctes.append(f"{p}ns{L} AS (SELECT node, count(*) AS n, sum(yc) AS s, sum(yc * yc) AS ss FROM {p}r{L} GROUP BY node)")
        if L < depth:
            var = "(CASE WHEN {n} > 0 THEN {ss} / {n} - pow({s} / {n}, 2) ELSE 0.0 END)"
            lv = var.format(n="left_n::DOUBLE", s="left_s", ss="left_ss")
            rv = var.format(n="(n - left_n)::DOUBLE", s="(tot_s - left_s)", ss="(tot_ss - left_ss)")
            nv = var.format(n="n::DOUBLE", s="tot_s", ss="tot_ss")
            ctes.append(f"""{p}cand{L} AS (
  SELECT node, f, b, {t_of_bin} AS threshold, n, left_n, n - left_n AS right_n,
         {nv} AS node_var, ({lv} * left_n + {rv} * (n - left_n)) / n::DOUBLE AS mse
  FROM (
    SELECT node, f, b,
           sum(cnt) OVER w AS left_n, sum(sy) OVER w AS left_s, sum(syy) OVER w AS left_ss,
           sum(cnt) OVER w2 AS n, sum(sy) OVER w2 AS tot_s, sum(syy) OVER w2 AS tot_ss
    FROM (
      SELECT node, f, b, count(*) AS cnt, sum(yc) AS sy, sum(yc * yc) AS syy
      FROM (SELECT node, yc, unnest([{', '.join(str(i) for i in range(nf))}]) AS f, unnest([{', '.join(bins)}]) AS b
            FROM {p}r{L}, {p}st
            WHERE node IN (SELECT node FROM {p}ns{L} WHERE n >= {min_node})) u
      GROUP BY node, f, b) g
    WINDOW w AS (PARTITION BY node, f ORDER BY b ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
           w2 AS (PARTITION BY node, f)) c, {p}st
  WHERE b < {k})""")
            ctes.append(f"""{p}best{L} AS (
  SELECT node, f, threshold FROM (
    SELECT *, row_number() OVER (PARTITION BY node ORDER BY mse, f, threshold) AS rn
    FROM {p}cand{L} WHERE left_n >= {min_side} AND right_n >= {min_side}) q
  WHERE rn = 1 AND mse < node_var * {gain!r})""")
            ctes.append(f"""{p}r{L + 1} AS (
  SELECT r.* EXCLUDE (node), 2 * r.node + CASE WHEN {x_of_f} > b.threshold THEN 1 ELSE 0 END AS node
  FROM {p}r{L} r JOIN {p}best{L} b ON r.node = b.node)""")
            levels.append(f"""SELECT ns.node, {L} AS depth, ns.n, ns.s / ns.n + m AS prediction,
       ns.ss / ns.n - pow(ns.s / ns.n, 2) AS impurity, b.f, b.threshold
FROM {p}ns{L} ns LEFT JOIN {p}best{L} b ON ns.node = b.node, {p}sh""")
        else:
            levels.append(f"""SELECT ns.node, {L} AS depth, ns.n, ns.s / ns.n + m AS prediction,
       ns.ss / ns.n - pow(ns.s / ns.n, 2) AS impurity, NULL::INTEGER AS f, NULL::DOUBLE AS threshold
FROM {p}ns{L} ns, {p}sh""")
    ctes.append(f"{p}nodes AS ({' UNION ALL '.join(levels)})")
    return ",\n".join(ctes)


def route_sql(rows: str, nodes: str, depth: int = 4, nf: int = 6) -> str:
    """Rows of ``rows(id, x0.., ...)`` with ``prediction`` from the node table."""
    x_of_f = "CASE n.f " + " ".join(f"WHEN {i} THEN s.x{i}" for i in range(nf)) + " END"
    q = f"SELECT r.*, 1::BIGINT AS node FROM ({rows}) r"
    for _ in range(depth):
        q = f"""SELECT s.* EXCLUDE (node),
  CASE WHEN n.f IS NULL THEN s.node ELSE 2 * s.node + CASE WHEN {x_of_f} > n.threshold THEN 1 ELSE 0 END END AS node
FROM ({q}) s JOIN {nodes} n ON s.node = n.node"""
    return f"SELECT s.*, n.prediction FROM ({q}) s JOIN {nodes} n ON s.node = n.node"


_TRIP_X = ", ".join(f"{c}::DOUBLE AS x{i}" for i, c in enumerate(TRIP_FEATS))


_TRIP_TV = f"SELECT id, {_TRIP_X}, trip_duration AS y, {hash_bucket('id')} AS bucket FROM ({TRIPS_OUTLIER}) t"


_TRIP_TRAIN = f"SELECT * FROM ({_TRIP_TV}) s WHERE bucket < 80"


_TRIP_VALID = f"SELECT * FROM ({_TRIP_TV}) s WHERE bucket >= 80"


_NAMES = "[" + ", ".join(f"'{c}'" for c in TRIP_FEATS) + "]"


ORACLES["tree_nodes"] = f"""
WITH {tree_sql(_TRIP_TRAIN, 't_')}
SELECT node::BIGINT AS node_id, CASE WHEN node > 1 THEN node // 2 END::BIGINT AS parent_id, depth::BIGINT AS depth,
       f IS NULL AS is_leaf, {_NAMES}[f + 1] AS feature, round(threshold, 6) AS threshold,
       round(prediction, 6) AS prediction, n::BIGINT AS count, round(impurity, 2) AS impurity
FROM t_nodes"""


ORACLES["tree_scores"] = f"""
WITH {tree_sql(_TRIP_TRAIN, 't_')}
SELECT id, round(y, 6) AS trip_duration, round(prediction, 6) AS prediction FROM ({route_sql(_TRIP_VALID, 't_nodes')}) s"""


ORACLES["regression_metrics"] = f"""
WITH {tree_sql(_TRIP_TRAIN, 't_')},
     sc AS ({route_sql(_TRIP_VALID, 't_nodes')})
SELECT count(*)::BIGINT AS n, round(avg((y - prediction) * (y - prediction)), 4) AS mse,
       round(sqrt(avg((y - prediction) * (y - prediction))), 4) AS rmse, round(avg(abs(y - prediction)), 4) AS mae,
       round(CASE WHEN var_pop(y) = 0 THEN 0.0
                  ELSE 1.0 - sum((y - prediction) * (y - prediction)) / (var_pop(y) * count(*)) END, 4) AS r2
FROM sc"""


_FIXED = f"""
SELECT trip_duration AS y,
       CASE WHEN pickup_longitude <= -74.0 THEN CASE WHEN hour(pickup_datetime) BETWEEN 7 AND 9 THEN 4500.0 ELSE 3000.0 END
            ELSE CASE WHEN hour(pickup_datetime) BETWEEN 7 AND 9 THEN 2500.0 ELSE 1000.0 END END AS prediction
FROM ({TRIPS_OUTLIER}) t"""


ORACLES["regression_metrics_fixed"] = f"""
SELECT count(*)::BIGINT AS n, round(avg((y - prediction) * (y - prediction)), 4) AS mse,
       round(sqrt(avg((y - prediction) * (y - prediction))), 4) AS rmse, round(avg(abs(y - prediction)), 4) AS mae,
       round(CASE WHEN var_pop(y) = 0 THEN 0.0
                  ELSE 1.0 - sum((y - prediction) * (y - prediction)) / (var_pop(y) * count(*)) END, 4) AS r2
FROM ({_FIXED}) s"""


_PARSED_TRAIN = f"""
SELECT id, {', '.join(f'{c} AS x{i}' for i, c in enumerate(TRIP_FEATS))}, trip_duration AS y, {hash_bucket('id')} AS bucket
FROM ({TRIP_TRAIN_PARSED}) x WHERE reason IS NULL"""


_PARSED_TEST = f"""
SELECT id, {', '.join(f'{c} AS x{i}' for i, c in enumerate(TRIP_FEATS))}
FROM ({TRIP_TEST_PARSED}) x WHERE reason IS NULL"""


ORACLES["batch_scoring"] = f"""
WITH {tree_sql(f"SELECT * FROM ({_PARSED_TRAIN}) s WHERE bucket < 80", 'b_')}
SELECT id, round(prediction, 6) AS trip_duration FROM ({route_sql(_PARSED_TEST, 'b_nodes')}) s"""


_ROOT = f"SELECT id, {_TRIP_X}, trip_duration AS y FROM ({TRIPS_OUTLIER}) t"


ORACLES["split_table_level"] = f"""
WITH {tree_sql(_ROOT, 's_', depth=1, min_node=0)}
SELECT f::BIGINT AS feature_index, round(threshold, 6) AS threshold, left_n::BIGINT AS left_n, right_n::BIGINT AS right_n,
       round(mse / node_var, 6) AS variance_share, (left_n >= 50 AND right_n >= 50) AS valid
FROM s_cand0"""


ORACLES["best_split_one_node"] = f"""
WITH {tree_sql(_ROOT, 's_', depth=1, min_node=0)}
SELECT {_NAMES}[f + 1] AS feature, round(threshold, 6) AS threshold, round(mse / node_var, 6) AS variance_share,
       left_n::BIGINT AS left_n, right_n::BIGINT AS right_n
FROM (SELECT *, row_number() OVER (ORDER BY mse, f, threshold) AS rn
      FROM s_cand0 WHERE left_n >= 50 AND right_n >= 50) q
WHERE rn = 1 AND mse < node_var * 0.95"""


ORACLES["tree_importances"] = f"""
WITH {tree_sql(_TRIP_TRAIN, 't_')},
gains AS (
  SELECT p.f, p.n * p.impurity - l.n * l.impurity - r.n * r.impurity AS gain
  FROM t_nodes p JOIN t_nodes l ON l.node = 2 * p.node JOIN t_nodes r ON r.node = 2 * p.node + 1
  WHERE p.f IS NOT NULL),
feats(f, feature) AS (VALUES {', '.join(f"({i}, '{c}')" for i, c in enumerate(TRIP_FEATS))})
SELECT feature, round(CASE WHEN (SELECT sum(gain) FROM gains) > 0
                           THEN coalesce(sum(g.gain), 0.0) / (SELECT sum(gain) FROM gains) ELSE 0.0 END, 6) AS importance
FROM feats LEFT JOIN gains g USING (f) GROUP BY feature"""

"""Twins of the binned trees: exact quantile cuts as window counts, trees grown
by one block of CTEs a level (``forest_sql``), all trees of a cross-validation
side by side in a column ``t``.
"""

from __future__ import annotations

from quarry.oracles.base import ORACLES, hash_bucket
from quarry.oracles.features import _FLAG_RANKS, _hav
from quarry.oracles.ingest import TRIPS
from quarry.oracles.tree import TRIP_FEATS, _TRIP_TRAIN, _TRIP_TV


def bins_sql(base: str, prefix: str, nf: int, bins: int = 32) -> str:
    """CTEs ``{prefix}cuts(f, l)``: per feature the sorted cuts over
    ``base(x0.., w)``, from its rows with w = 1."""
    p, fs = prefix, ", ".join(str(i) for i in range(nf))
    return f"""{p}vals AS (SELECT unnest([{fs}]) AS f, unnest([{', '.join(f'x{i}' for i in range(nf))}]) AS value FROM {base} WHERE w = 1),
{p}cum AS (SELECT f, value, c, sum(c) OVER (PARTITION BY f ORDER BY value) AS cum, sum(c) OVER (PARTITION BY f) AS n
  FROM (SELECT f, value, count(*) AS c FROM {p}vals WHERE value IS NOT NULL AND NOT isnan(value) GROUP BY f, value) g),
{p}cuts AS MATERIALIZED (SELECT f, list(value ORDER BY value) AS l FROM {p}cum
  WHERE least(cum * {bins} // n, {bins - 1}) > least((cum - c) * {bins} // n, {bins - 1}) AND cum < n GROUP BY f)"""


def below(cuts: str, x: str, most: int) -> str:
    """How many of a list's first ``most`` numbers are below ``x``."""
    return "(" + " + ".join(f"coalesce(({cuts}[{j}] < {x})::INTEGER, 0)" for j in range(1, most + 1)) + ")"


def binned_sql(base: str, prefix: str, nf: int, trees: str = "SELECT 0 AS t, NULL::INTEGER AS hold, 1 AS least", bins: int = 32) -> str:
    """``{prefix}r0(t, least, id, fold, yi, yt, w, b0.., node)``: every row for
    every tree, with w = 1 where it trains and 0 where it is left out."""
    p = prefix
    cut = [f"coalesce((SELECT l FROM {p}cuts WHERE f = {i}), []::DOUBLE[])" for i in range(nf)]
    bs = ", ".join(f"{below(f'l{i}', f'x{i}', bins - 1)} AS b{i}" for i in range(nf))
    return f"""{p}lists AS (SELECT {', '.join(f'{c} AS l{i}' for i, c in enumerate(cut))}),
{p}binned AS MATERIALIZED (SELECT id, fold, w, floor(y / 0.01 + 0.5)::BIGINT AS yi, {bs} FROM {base}, {p}lists),
{p}r0 AS MATERIALIZED (SELECT t, least, id, fold, yi, CASE WHEN hold = fold THEN 0 ELSE w END AS w, {', '.join(f'b{i}' for i in range(nf))}, 1::BIGINT AS node
  FROM {p}binned, ({trees}) s)"""


def forest_sql(prefix: str, nf: int, depth: int) -> str:
    """Levels over ``{prefix}r0``: ``{prefix}r{{L}}`` holds the node of each row
    after L levels, ``{prefix}best{{L}}`` the splits of level L."""
    p = prefix
    fs, bs = ", ".join(str(i) for i in range(nf)), ", ".join(f"b{i}" for i in range(nf))
    b_of_f = "CASE s.f " + " ".join(f"WHEN {i} THEN r.b{i}" for i in range(nf)) + " END"
    out = []
    for L in range(depth):
        out.append(f"""{p}best{L} AS MATERIALIZED (
  SELECT t, node, f, b, gain FROM (
    SELECT *, row_number() OVER (PARTITION BY t, node ORDER BY gain DESC, f, b) AS rn FROM (
      SELECT t, node, f, b, ln::DOUBLE * (n - ln)::DOUBLE / n::DOUBLE * (apart * apart) AS gain
      FROM (SELECT *, ls::DOUBLE / ln::DOUBLE - (s - ls)::DOUBLE / (n - ln)::DOUBLE AS apart FROM (
        SELECT t, node, f, b, least, sum(c) OVER w AS ln, sum(sy) OVER w AS ls, sum(c) OVER w2 AS n, sum(sy) OVER w2 AS s
        FROM (SELECT t, node, f, b, any_value(least) AS least, count(*) AS c, sum(yi) AS sy
              FROM (SELECT t, node, yi, least, unnest([{fs}]) AS f, unnest([{bs}]) AS b
                    FROM {p}r{L} WHERE w = 1 AND node >= {1 << L}) u GROUP BY t, node, f, b) g
        WINDOW w AS (PARTITION BY t, node, f ORDER BY b ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
               w2 AS (PARTITION BY t, node, f)) a
        WHERE ln >= least AND n - ln >= least) d) c) q
  WHERE rn = 1 AND gain > 0)""")
        out.append(f"""{p}r{L + 1} AS MATERIALIZED (
  SELECT r.* EXCLUDE (node), CASE WHEN s.f IS NULL THEN r.node ELSE 2 * r.node + CASE WHEN {b_of_f} > s.b THEN 1 ELSE 0 END END AS node
  FROM {p}r{L} r LEFT JOIN {p}best{L} s ON r.t = s.t AND r.node = s.node)""")
    return ",\n".join(out)


def means_sql(prefix: str, level: int) -> str:
    """``(t, node, n, mean)`` of the nodes after ``level`` levels."""
    return (f"SELECT t, node, count(*) AS n, sum(yi)::DOUBLE / count(*)::DOUBLE AS mean "
            f"FROM {prefix}r{level} WHERE w = 1 GROUP BY t, node")


DEEP = 20

_DEEP_BASE = f"SELECT *, 0 AS fold, CASE WHEN bucket < 70 THEN 1 ELSE 0 END AS w FROM ({_TRIP_TV}) v"


_DEEP = f"""base AS MATERIALIZED ({_DEEP_BASE}),
{bins_sql('base', 'd_', 6)},
{binned_sql('base', 'd_', 6)},
{forest_sql('d_', 6, DEEP)}"""


ORACLES["deep_tree_leaves"] = f"""
WITH {_DEEP}
SELECT node AS node_id, (len(bin(node)) - 1)::BIGINT AS depth, n::BIGINT AS count, round(mean * 0.01, 6) AS mean
FROM ({means_sql('d_', DEEP)}) m"""


ORACLES["deep_tree_metrics"] = f"""
WITH {_DEEP},
pred AS (SELECT r.yi * 0.01 AS y, m.mean * 0.01 AS prediction
         FROM d_r{DEEP} r JOIN ({means_sql('d_', DEEP)}) m ON r.node = m.node WHERE r.w = 0)
SELECT count(*)::BIGINT AS n, round(avg((y - prediction) * (y - prediction)), 4) AS mse,
       round(sqrt(avg((y - prediction) * (y - prediction))), 4) AS rmse, round(avg(abs(y - prediction)), 4) AS mae,
       round(CASE WHEN var_pop(y) = 0 THEN 0.0
                  ELSE 1.0 - sum((y - prediction) * (y - prediction)) / (var_pop(y) * count(*)) END, 4) AS r2
FROM pred"""


# The structured preparation: flag index of the training rows, complete rows,
# range filter, time parts and distance.
PREPARED = f"""raw AS MATERIALIZED (SELECT *, {hash_bucket('id')} AS bucket FROM ({TRIPS}) t),
ranks AS ({_FLAG_RANKS.format(src="SELECT * FROM raw WHERE bucket < 80")}),
prepared AS MATERIALIZED (
  SELECT t.id, t.bucket, t.vendor_id::DOUBLE AS x0, t.passenger_count::DOUBLE AS x1, t.pickup_longitude AS x2, t.pickup_latitude AS x3,
         t.dropoff_longitude AS x4, t.dropoff_latitude AS x5, hour(t.pickup_datetime)::DOUBLE AS x6,
         (dayofweek(t.pickup_datetime) + 1)::DOUBLE AS x7,
         {_hav('t.pickup_longitude', 't.pickup_latitude', 't.dropoff_longitude', 't.dropoff_latitude')} AS x8,
         coalesce(r.index, (SELECT count(*)::DOUBLE FROM ranks)) AS x9, t.trip_duration AS y
  FROM raw t LEFT JOIN ranks r ON t.store_and_fwd_flag = r.value
  WHERE t.store_and_fwd_flag IS NOT NULL AND t.trip_duration BETWEEN 60.0 AND 14400.0
    AND t.pickup_latitude BETWEEN 40.0 AND 41.0 AND t.pickup_longitude BETWEEN -74.0 AND -73.0
    AND t.dropoff_latitude BETWEEN 40.0 AND 41.0 AND t.dropoff_longitude BETWEEN -74.0 AND -73.0)"""


CV_DEPTHS, CV_LEAST, CV_FOLDS = (5, 7, 10), (1, 10, 50), 3

_CV_TREES = " UNION ALL ".join(
    f"SELECT {j * CV_FOLDS + f} AS t, {f} AS hold, {m} AS least" for j, m in enumerate(CV_LEAST) for f in range(CV_FOLDS)
)


def _cv(depths=CV_DEPTHS) -> str:
    errors = " UNION ALL ".join(
        f"SELECT r.t, {d} AS depth, sqrt(avg(pow((r.yi - m.mean) * 0.01, 2))) AS rmse "
        f"FROM c_r{d} r JOIN ({means_sql('c_', d)}) m ON r.t = m.t AND r.node = m.node WHERE r.w = 0 GROUP BY r.t"
        for d in depths
    )
    least = " ".join(f"WHEN {j} THEN {m}" for j, m in enumerate(CV_LEAST))
    return f"""{PREPARED},
base AS MATERIALIZED (SELECT *, {hash_bucket('id', 7)} % {CV_FOLDS} AS fold, 1 AS w FROM prepared WHERE bucket < 80),
{bins_sql('base', 'c_', 10)},
{binned_sql('base', 'c_', 10, _CV_TREES)},
{forest_sql('c_', 10, max(depths))},
grid AS (SELECT depth AS max_depth, t // {CV_FOLDS} AS j, CASE t // {CV_FOLDS} {least} END AS min_instances_per_node, avg(rmse) AS avg_rmse
         FROM ({errors}) e GROUP BY depth, t // {CV_FOLDS})"""


ORACLES["cv_forest_grid"] = f"""
WITH {_cv()}
SELECT max_depth::INTEGER AS max_depth, min_instances_per_node::INTEGER AS min_instances_per_node, round(avg_rmse, 4) AS avg_rmse,
       row_number() OVER (ORDER BY avg_rmse, max_depth, j) = 1 AS is_best
FROM grid"""

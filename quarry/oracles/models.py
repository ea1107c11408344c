"""Twins of ``quarry.catalog.models``: Newton steps for the L-BFGS optimum, SGD
with hashed mini-batches, drawn thresholds, binned curves, the card rows, and
the stored preparation.
"""

from __future__ import annotations

from quarry.oracles.base import ORACLES, gd_cte, hash_bucket, report_cols, sigmoid
from quarry.oracles.classification import _GRID, _W_KEY, _W_SPLIT, SCORED_FRAUD, auc_stepwise_sql, gd_cte_multi
from quarry.oracles.features import _FLAG_RANKS, _hav
from quarry.oracles.forest import below, bins_sql, binned_sql, forest_sql, means_sql
from quarry.oracles.ingest import FRAUD_PARSED_NO_TIME, TRIPS, TRIPS_OUTLIER
from quarry.oracles.tree import TRIP_FEATS, _NAMES, _PARSED_TRAIN, _TRIP_TRAIN, _TRIP_X, route_sql, tree_sql


# ------------------------------------------------------------------- L-BFGS
def newton_cte(train: str, k: int, steps: int = 25) -> str:
    """``newton(it, b0..bk)`` over ``train(x1..xk, y)``: unweighted logistic
    regression; the Hessian's equations are solved by elimination, one nested
    SELECT a column."""
    idx = range(k + 1)
    bs = ", ".join(f"b{i}" for i in idx)
    x = ["1.0"] + [f"x{i}" for i in range(1, k + 1)]
    m = k + 1
    z = "g.b0 + " + " + ".join(f"g.b{i} * s.x{i}" for i in range(1, k + 1))
    cells = ", ".join([f"sum(p * (1.0 - p) * {x[i]} * {x[j]}) AS a{i}_{j}" for i in idx for j in idx]
                      + [f"sum((p - y) * {x[i]}) AS a{i}_{m}" for i in idx])
    q = f"""SELECT it, {bs}, {cells} FROM (
      SELECT g.it, {', '.join(f'g.b{i}' for i in idx)}, s.*, {sigmoid(z)} AS p FROM newton g, {train} s WHERE g.it < {steps}) e
    GROUP BY it, {bs}"""
    for p in range(k):
        kept = [f"a{i}_{j}" for i in idx for j in range(m + 1) if i <= p and j >= i]
        new = [f"a{i}_{j} - a{i}_{p} / a{p}_{p} * a{p}_{j} AS a{i}_{j}" for i in idx for j in range(m + 1) if i > p and j > p]
        q = f"SELECT it, {bs}, {', '.join(kept + new)} FROM ({q}) q{p}"
    for i in reversed(idx):
        done = "".join(f" - a{i}_{j} * d{j}" for j in range(i + 1, k + 1))
        q = f"SELECT *, (a{i}_{m}{done}) / a{i}_{i} AS d{i} FROM ({q}) r{i}"
    return f"""newton(it, {bs}) AS (
  SELECT 0, {', '.join('0.0::DOUBLE' for _ in idx)}
  UNION ALL
  SELECT it + 1, {', '.join(f'b{i} - d{i}' for i in idx)} FROM ({q}) n)"""


def _scaled(source: str, stats: str) -> str:
    return f"SELECT {', '.join(f'CASE WHEN s{i} > 0 THEN f{i} / s{i} ELSE 0.0 END AS x{i}' for i in range(1, 5))}, label AS y, key FROM {source}, {stats}"


# The four-feature rows labelled at 1.0, which no plane separates.
_LOW_SPLIT = _W_SPLIT.replace("> 4.0", "> 1.0")


def _lbfgs(split: bool) -> str:
    return f"""split AS MATERIALIZED (SELECT *, {_W_KEY} AS key FROM ({_LOW_SPLIT}) w),
tr AS (SELECT * FROM split {'WHERE bucket < 80' if split else ''}),
sd AS (SELECT {', '.join(f'stddev_samp(f{i}) AS s{i}' for i in range(1, 5))} FROM tr),
ltrain AS MATERIALIZED ({_scaled('tr', 'sd')}),
{newton_cte('ltrain', 4)},
fin AS (SELECT * FROM newton WHERE it = (SELECT max(it) FROM newton)),
ltest AS ({_scaled('(SELECT * FROM split WHERE bucket >= 80) t', 'sd')}),
scored AS (SELECT key, y AS label, {sigmoid('fin.b0 + ' + ' + '.join(f'fin.b{i} * x{i}' for i in range(1, 5)))} AS p FROM ltest, fin)"""


def _coefficients(split: bool) -> str:
    names = ["intercept", "f1", "f2", "f3", "f4"]
    return f"WITH RECURSIVE {_lbfgs(split)}\n" + " UNION ALL ".join(
        f"SELECT '{n}' AS feature, round(b{i}, 4) AS coefficient, 0.0::DOUBLE AS gradient FROM fin" for i, n in enumerate(names)
    )


ORACLES["lbfgs_coefficients"] = _coefficients(False)


ORACLES["lbfgs_split_coefficients"] = _coefficients(True)


ORACLES["lbfgs_test_scores"] = f"""
WITH RECURSIVE {_lbfgs(True)}
SELECT key, label, round(p, 4) AS p, CASE WHEN p >= 0.5 THEN 1.0 ELSE 0.0 END::DOUBLE AS prediction FROM scored"""


def confusion_sql(scored: str, at: str = "0.5") -> str:
    return f"""SELECT {at}::DOUBLE AS threshold, count_if(p >= {at} AND label = 1.0)::BIGINT AS tp, count_if(p >= {at} AND label = 0.0)::BIGINT AS fp,
       count_if(p < {at} AND label = 0.0)::BIGINT AS tn, count_if(p < {at} AND label = 1.0)::BIGINT AS fn FROM {scored}"""


def _ties_auc(scored: str) -> str:
    return f"""SELECT CASE WHEN P * N = 0 THEN 0.0 ELSE sum(neg * (tp - pos / 2.0)) / (P::DOUBLE * N::DOUBLE) END AS auc, P::BIGINT AS positives, N::BIGINT AS negatives
FROM (SELECT pos, neg, sum(pos) OVER (ORDER BY p DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tp, sum(pos) OVER () AS P, sum(neg) OVER () AS N
      FROM (SELECT p, count_if(label = 1.0) AS pos, count_if(label <> 1.0) AS neg FROM {scored} GROUP BY p) g) w GROUP BY P, N"""


def _five(sql: str) -> str:
    return sql.replace(", 6)", ", 5)")


ORACLES["lbfgs_test_report"] = f"""
WITH RECURSIVE {_lbfgs(True)}
SELECT threshold, tp, fp, tn, fn, {_five(report_cols())}, round(auc, 5) AS auc, positives, negatives
FROM ({confusion_sql('scored')}) c, ({_ties_auc('scored')}) a"""


# ----------------------------------------------------------------------- SGD
def _sgd(fraction: float) -> str:
    k, reg, tol = 4, 0.01, 1e-3 if fraction >= 1.0 else 0.0
    idx = range(1, k + 1)
    z = "0.0 + " + " + ".join(f"g.w{i} * s.x{i}" for i in idx)
    eta = "(1.0 / sqrt((t + 1)::DOUBLE))"
    new = [f"(w{i} * (1.0 - {eta} * {reg!r}) - {eta} * sg{i} / n)" for i in idx]
    diff = "sqrt(" + " + ".join(f"({w} - w{i}) * ({w} - w{i})" for i, w in zip(idx, new)) + ")"
    norm = "sqrt(" + " + ".join(f"{w} * {w}" for w in new) + ")"
    ws = ", ".join(f"w{i}" for i in idx)
    member = "" if fraction >= 1.0 else f" AND ('0x' || substr(md5('42|' || (g.t + 1)::VARCHAR || '|' || s.key), 1, 7))::BIGINT % 10000 < {round(fraction * 10000)}"
    return f"""
WITH RECURSIVE split AS MATERIALIZED (SELECT *, {_W_KEY} AS key FROM ({_W_SPLIT}) w),
tr AS (SELECT * FROM split WHERE bucket < 80),
sd AS (SELECT {', '.join(f'stddev_samp(f{i}) AS s{i}' for i in idx)} FROM tr),
strain AS MATERIALIZED ({_scaled('tr', 'sd')}),
sgd(t, {ws}, done) AS (
  SELECT 0, {', '.join('0.0::DOUBLE' for _ in idx)}, false
  UNION ALL
  SELECT t + 1, {', '.join(new)}, (t + 1 > 1 AND {diff} < {tol!r} * greatest({norm}, 1.0)) OR t + 1 >= 100
  FROM (SELECT t, {ws}, count(*) AS n, {', '.join(f'sum(e * x{i}) AS sg{i}' for i in idx)}
        FROM (SELECT g.t, {', '.join(f'g.w{i}' for i in idx)}, {', '.join(f's.x{i}' for i in idx)}, {sigmoid(z)} - s.y AS e
              FROM sgd g, strain s WHERE NOT g.done{member}) a
        GROUP BY t, {ws}) c),
fin AS (SELECT * FROM sgd WHERE t = (SELECT max(t) FROM sgd)),
pred AS (SELECT y, CASE WHEN {sigmoid('0.0 + ' + ' + '.join(f'fin.w{i} * x{i}' for i in idx))} >= 0.5 THEN 1.0 ELSE 0.0 END AS yhat
         FROM ({_scaled('(SELECT * FROM split WHERE bucket >= 80) q', 'sd')}) s, fin),
cells AS (SELECT y, yhat, count(*) AS n FROM pred GROUP BY ALL),
a AS (SELECT y AS c, sum(n) AS actual, sum(CASE WHEN y = yhat THEN n ELSE 0 END) AS tp FROM cells GROUP BY y),
pr AS (SELECT yhat AS c, sum(n) AS predicted FROM cells GROUP BY yhat),
pc AS (SELECT actual, tp, CASE WHEN coalesce(predicted, 0) = 0 THEN 0.0 ELSE tp::DOUBLE / predicted END AS prc,
              CASE WHEN actual = 0 THEN 0.0 ELSE tp::DOUBLE / actual END AS rc FROM a LEFT JOIN pr USING (c)),
rep AS (SELECT round(sum(tp) / sum(actual), 6) AS accuracy, round(sum(prc * actual) / sum(actual), 6) AS weighted_precision,
               round(sum(rc * actual) / sum(actual), 6) AS weighted_recall,
               round(sum(CASE WHEN prc + rc = 0 THEN 0.0 ELSE 2.0 * prc * rc / (prc + rc) END * actual) / sum(actual), 6) AS weighted_f1,
               sum(actual)::BIGINT AS n FROM pc)
SELECT rep.*, fin.t::BIGINT AS iterations_run, {', '.join(f'round(fin.w{i}, 6) AS w{i}' for i in idx)} FROM rep, fin"""


ORACLES["sgd_default"] = _sgd(1.0)


ORACLES["sgd_minibatch"] = _sgd(0.1)


# --------------------------------------------------------- seeded thresholds
def seeded_sql(rows: str, depth: int, min_node: int = 100, min_side: int = 50, gain: float = 0.95, k: int = 10, seed: int = 42) -> str:
    """``z_nodes`` and, per level, ``z_cell{L}`` and ``z_tot{L}`` of the tree
    over ``rows(id, x0..x5, y)`` with thresholds drawn for every node."""
    fs = ", ".join(str(i) for i in range(6))
    xs = ", ".join(f"x{i}" for i in range(6))
    lo, hi = ("CASE f " + " ".join(f"WHEN {i} THEN {s}{i}" for i in range(6)) + " END" for s in ("lo", "hi"))
    x_of_f = "CASE b.f " + " ".join(f"WHEN {i} THEN r.x{i}" for i in range(6)) + " END"
    out = [
        f"z_r0 AS MATERIALIZED (SELECT *, floor(y / 0.01 + 0.5)::BIGINT AS yi, 1::BIGINT AS node FROM ({rows}) t)",
        f"z_st AS (SELECT {', '.join(f'min(x{i}) AS lo{i}, max(x{i}) AS hi{i}' for i in range(6))} FROM z_r0)",
        f"""z_thr AS MATERIALIZED (
  SELECT node, f, row_number() OVER (PARTITION BY node, f ORDER BY threshold) - 1 AS b, threshold FROM (
    SELECT node, f, {lo} + u * ({hi} - {lo}) AS threshold, {lo} < {hi} AS varies FROM z_st, (
      SELECT node, f, j, ('0x' || substr(md5('{seed}|' || node || '|' || f || '|' || j), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS u
      FROM range(1, {2 << depth}) n(node), range(6) g(f), range({k}) h(j)) d) e WHERE varies)""",
        "z_lists AS MATERIALIZED (SELECT node, f, list(threshold ORDER BY threshold) AS l FROM z_thr GROUP BY node, f)",
    ]
    levels = []
    for L in range(depth + 1):
        out.append(f"z_tot{L} AS MATERIALIZED (SELECT node, count(*) AS n, sum(yi) AS s, greatest(sum(yi::HUGEINT * yi)::DOUBLE / count(*)::DOUBLE - "
                   f"(sum(yi)::DOUBLE / count(*)::DOUBLE) * (sum(yi)::DOUBLE / count(*)::DOUBLE), 0.0) AS variance FROM z_r{L} GROUP BY node)")
        stats = "t.node, {L} AS depth, t.n, t.s::DOUBLE / t.n::DOUBLE * 0.01 AS prediction, t.variance * 0.01 * 0.01 AS impurity".replace("{L}", str(L))
        if L == depth:
            levels.append(f"SELECT {stats}, NULL::BIGINT AS f, NULL::DOUBLE AS threshold FROM z_tot{L} t")
            continue
        out.append(f"""z_cell{L} AS MATERIALIZED (
  SELECT u.node, u.f, {below('l.l', 'u.x', k)} AS b, count(*) AS c, sum(yi) AS sy
  FROM (SELECT node, yi, unnest([{fs}]) AS f, unnest([{xs}]) AS x FROM z_r{L}) u LEFT JOIN z_lists l ON u.node = l.node AND u.f = l.f
  GROUP BY ALL)""")
        out.append(f"""z_cand{L} AS MATERIALIZED (
  SELECT c.node, f, b, ln, t.n, t.variance, t.variance
         - CASE WHEN t.n > ln THEN ln::DOUBLE * (t.n::DOUBLE - ln::DOUBLE) / t.n::DOUBLE * (apart * apart) ELSE 0.0 END / t.n::DOUBLE AS mse
  FROM (SELECT *, CASE WHEN n > ln THEN ls::DOUBLE / ln::DOUBLE - (s - ls)::DOUBLE / (n::DOUBLE - ln::DOUBLE) END AS apart FROM (
    SELECT node, f, b, sum(c) OVER w AS ln, sum(sy) OVER w AS ls, sum(c) OVER w2 AS n, sum(sy) OVER w2 AS s FROM z_cell{L}
    WINDOW w AS (PARTITION BY node, f ORDER BY b ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), w2 AS (PARTITION BY node, f)) a) c
  JOIN z_tot{L} t ON c.node = t.node)""")
        out.append(f"""z_best{L} AS MATERIALIZED (
  SELECT q.node, q.f, h.threshold FROM (
    SELECT *, row_number() OVER (PARTITION BY node ORDER BY mse, f, b) AS rn FROM z_cand{L} WHERE ln >= {min_side} AND n - ln >= {min_side}) q
  JOIN z_thr h ON q.node = h.node AND q.f = h.f AND q.b = h.b
  WHERE rn = 1 AND mse < {gain!r} * variance AND n >= {min_node})""")
        out.append(f"""z_r{L + 1} AS MATERIALIZED (
  SELECT r.* EXCLUDE (node), 2 * r.node + CASE WHEN {x_of_f} > b.threshold THEN 1 ELSE 0 END AS node FROM z_r{L} r JOIN z_best{L} b ON r.node = b.node)""")
        levels.append(f"SELECT {stats}, b.f, b.threshold FROM z_tot{L} t LEFT JOIN z_best{L} b ON t.node = b.node")
    out.append(f"z_nodes AS ({' UNION ALL '.join(levels)})")
    return ",\n".join(out)


_OUTLIER_ROWS = f"SELECT id, {_TRIP_X}, trip_duration AS y FROM ({TRIPS_OUTLIER}) t"


ORACLES["seeded_tree_nodes"] = f"""
WITH {seeded_sql(_OUTLIER_ROWS, 4)}
SELECT node::BIGINT AS node_id, CASE WHEN node > 1 THEN node // 2 END::BIGINT AS parent_id, depth::BIGINT AS depth,
       f IS NULL AS is_leaf, {_NAMES}[f + 1] AS feature, round(threshold, 6) AS threshold,
       round(prediction, 6) AS prediction, n::BIGINT AS count, round(impurity, 2) AS impurity
FROM z_nodes"""


def _split_rows(L: int) -> str:
    return f"""SELECT h.node, h.f, h.threshold, t.n, t.variance, coalesce(sum(CASE WHEN c.b <= h.b THEN c.c END), 0) AS ln,
       coalesce(max(CASE WHEN c.b <= h.b THEN c.b END), -1) AS at
FROM z_thr h JOIN z_tot{L} t ON h.node = t.node JOIN z_cell{L} c ON h.node = c.node AND h.f = c.f GROUP BY ALL"""


ORACLES["seeded_split_table"] = f"""
WITH {seeded_sql(_OUTLIER_ROWS, 2)},
rows_of AS ({_split_rows(0)} UNION ALL {_split_rows(1)}),
cand AS (SELECT * FROM z_cand0 UNION ALL SELECT * FROM z_cand1)
SELECT r.node::BIGINT AS node, r.f::BIGINT AS feature_index, round(r.threshold, 6) AS threshold, r.ln::BIGINT AS left_n, (r.n - r.ln)::BIGINT AS right_n,
       CASE WHEN r.variance > 0 THEN round(CASE WHEN r.ln < r.n AND c.b IS NOT NULL THEN c.mse ELSE r.variance END / r.variance, 6) END AS variance_share,
       r.ln >= 50 AND r.n - r.ln >= 50 AS valid
FROM rows_of r LEFT JOIN cand c ON r.node = c.node AND r.f = c.f AND r.at = c.b"""


# -------------------------------------------------------------- score curves
_BINS = f"SELECT least(floor(p * 1000.0::DOUBLE), 999)::INTEGER AS bin, count_if(label = 1.0) AS pos, count_if(label <> 1.0) AS neg FROM ({SCORED_FRAUD}) s GROUP BY 1"

_CUM = f"""SELECT bin, pos, neg, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER () AS P, sum(neg) OVER () AS N
FROM ({_BINS}) b WINDOW w AS (ORDER BY bin DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""

_PR = "(CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp::DOUBLE / (tp + fp) END)"
_RC = "(CASE WHEN P = 0 THEN 0.0 ELSE tp::DOUBLE / P END)"


ORACLES["binned_roc"] = f"""
SELECT round(bin / 1000.0::DOUBLE, 6) AS threshold, tp::BIGINT AS tp, fp::BIGINT AS fp, round({_RC}, 6) AS tpr,
       round(CASE WHEN N = 0 THEN 0.0 ELSE fp::DOUBLE / N END, 6) AS fpr, round({_PR}, 6) AS precision,
       round(CASE WHEN {_PR} + {_RC} = 0 THEN 0.0 ELSE 2.0 * {_PR} * {_RC} / ({_PR} + {_RC}) END, 6) AS f1
FROM ({_CUM}) c"""


ORACLES["binned_auc"] = f"""
SELECT round(CASE WHEN P * N = 0 THEN 0.0 ELSE sum(neg * (tp - pos / 2.0)) / (P::DOUBLE * N::DOUBLE) END, 6) AS auc,
       round(CASE WHEN P * N = 0 THEN 0.0 ELSE sum(pos * neg) / 2.0 / (P::DOUBLE * N::DOUBLE) END, 6) AS error_bound,
       P::BIGINT AS positives, N::BIGINT AS negatives
FROM ({_CUM}) c GROUP BY P, N"""


# ---------------------------------------------------------- 29-feature rows
_LABEL = "CASE WHEN l_quantity * l_discount > 4.0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END"

_D = 29

CARD = "SELECT CAST(l_orderkey AS VARCHAR) || '|' || CAST(l_linenumber AS VARCHAR) AS key, " + ", ".join(
    f"((l_orderkey * {2 * i + 1} + l_partkey * {i + 3} + l_linenumber * 7) % {97 + 4 * i}) / {float(97 + 4 * i)!r}::DOUBLE - 0.5::DOUBLE "
    f"+ {_LABEL} * {(i % 5 - 2) / 10.0!r}::DOUBLE AS f{i}"
    for i in range(1, _D)
) + f", l_extendedprice AS f{_D}, {_LABEL} AS label FROM lineitem"

_CARD_NAMES = [*[f"v{i}" for i in range(1, _D)], "amount"]


ORACLES["card_summary"] = f"WITH card AS MATERIALIZED ({CARD})\n" + " UNION ALL ".join(
    f"SELECT '{n}' AS feature, count(*)::BIGINT AS count, round(avg(f{i}), 6) AS mean, round(stddev_pop(f{i}), 6) AS stddev, "
    f"round(min(f{i}), 6) AS min, round(max(f{i}), 6) AS max, round(coalesce(corr(f{i}, label), 0.0), 6) AS label_correlation FROM card"
    for i, n in enumerate(_CARD_NAMES, 1)
)


_CARD_PREP = f"""split AS MATERIALIZED (SELECT *, {hash_bucket('key')} AS bucket FROM ({CARD}) c),
train AS (SELECT * FROM split WHERE bucket < 80),
mm AS (SELECT {', '.join(f'min(f{i}) AS lo{i}, greatest(max(f{i}) - min(f{i}), 1e-8) AS r{i}' for i in range(1, _D + 1))} FROM train),
cwt AS (SELECT CASE WHEN n0 = 0 OR n1 = 0 THEN 1.0 ELSE (n0 + n1)::DOUBLE / (n0 * 2.0) END AS w0,
               CASE WHEN n0 = 0 OR n1 = 0 THEN 1.0 ELSE (n0 + n1)::DOUBLE / (n1 * 2.0) END AS w1
        FROM (SELECT count_if(label = 0.0) AS n0, count_if(label = 1.0) AS n1 FROM train) c),
strain AS MATERIALIZED (SELECT {', '.join(f'(f{i} - lo{i}) / r{i} AS x{i}' for i in range(1, _D + 1))}, label AS y,
                  CASE WHEN label = 1.0 THEN w1 WHEN label = 0.0 THEN w0 ELSE 1.0 END AS cw FROM train, mm, cwt),
stest AS MATERIALIZED (SELECT {', '.join(f'(f{i} - lo{i}) / r{i} AS x{i}' for i in range(1, _D + 1))}, label AS y, key FROM split, mm WHERE bucket >= 80)"""

_CARD_P = sigmoid("fin.b0 + " + " + ".join(f"fin.b{i} * x{i}" for i in range(1, _D + 1)))


ORACLES["card_fit"] = f"""
WITH RECURSIVE {_CARD_PREP},
{gd_cte(0.5, 0.01, 30, 1e-4, k=_D)},
fin AS (SELECT * FROM gd WHERE it = (SELECT max(it) FROM gd)),
scored AS (SELECT y AS label, {_CARD_P} AS p FROM stest, fin),
conf AS ({confusion_sql('scored')}),
coef AS ({' UNION ALL '.join(f"SELECT '{n}' AS feature, round(b{i}, 6) AS coefficient FROM fin" for i, n in enumerate(['intercept', *_CARD_NAMES]))})
SELECT feature, coefficient, threshold, tp, fp, tn, fn, {report_cols()} FROM coef, conf"""


ORACLES["card_grid"] = f"""
WITH RECURSIVE {_CARD_PREP},
{gd_cte_multi(_GRID, 30, 1e-4, k=_D)},
fin AS (SELECT * FROM gd WHERE (cfg, it) IN (SELECT cfg, max(it) FROM gd GROUP BY cfg)),
scored AS (SELECT fin.cfg, {_CARD_P} AS p, y AS label, key FROM stest, fin),
aucs AS ({auc_stepwise_sql('SELECT * FROM scored', 'cfg')})
SELECT grp::BIGINT AS config_index, lr AS learning_rate, reg AS reg_param, round(auc, 6) AS auc
FROM aucs JOIN cfgs ON grp = cfgs.cfg ORDER BY auc DESC, grp ASC LIMIT 1"""


# -------------------------------------------------------- stored preparation
_PREP_FEATURES = [*TRIP_FEATS, "pickup_hour", "pickup_dayofweek", "distance_km", "store_and_fwd_flag_indexed"]
_PREP_BOUNDS = [("trip_duration", 60.0, 14400.0), ("pickup_latitude", 40.0, 41.0), ("pickup_longitude", -74.0, -73.0),
                ("dropoff_latitude", 40.0, 41.0), ("dropoff_longitude", -74.0, -73.0)]
_PREP_REQUIRED = ["store_and_fwd_flag", *TRIP_FEATS, "trip_duration"]

_PREP_CTE = f"""trips AS MATERIALIZED (SELECT *, hour(pickup_datetime) AS pickup_hour, dayofweek(pickup_datetime) + 1 AS pickup_dayofweek,
    {_hav('pickup_longitude', 'pickup_latitude', 'dropoff_longitude', 'dropoff_latitude')} AS distance_km, {hash_bucket('id')} AS bucket FROM ({TRIPS}) t),
train AS (SELECT * FROM trips WHERE bucket < 80),
ranks AS MATERIALIZED ({_FLAG_RANKS.format(src='train')}),
fitted AS (SELECT stddev_samp(distance_km) AS sd, (SELECT count(*)::DOUBLE FROM ranks) AS labels FROM train),
reasoned AS MATERIALIZED (SELECT t.*, coalesce(r.index, labels) AS store_and_fwd_flag_indexed, sd,
    CASE {' '.join(f"WHEN t.{c} IS NULL THEN 'missing {c}'" for c in _PREP_REQUIRED)}
         {' '.join(f"WHEN NOT t.{c} BETWEEN {lo!r} AND {hi!r} THEN 'range {c}'" for c, lo, hi in _PREP_BOUNDS)} END AS reason
    FROM trips t LEFT JOIN ranks r ON t.store_and_fwd_flag = r.value, fitted)"""



ORACLES["prepared_test_rows"] = f"""
WITH {_PREP_CTE}
SELECT id, {', '.join(f"round({'distance_km / sd' if c == 'distance_km' else c + '::DOUBLE'}, 6) AS {c}" for c in _PREP_FEATURES)}, reason
FROM reasoned WHERE bucket >= 80"""


ORACLES["preparation_rejects"] = f"WITH {_PREP_CTE}\nSELECT reason, count(*)::BIGINT AS rows FROM reasoned GROUP BY reason"


def _literal_rows(kind: str, rows: list[tuple]) -> str:
    return " UNION ALL ".join(
        f"SELECT 1 AS version, '{kind}' AS kind, {i} AS position, '{c}' AS \"column\", NULL::VARCHAR AS label, {lo}::DOUBLE AS value, {hi}::DOUBLE AS other"
        for i, (c, lo, hi) in enumerate(rows)
    )


ORACLES["preparation_table"] = f"""
WITH {_PREP_CTE}
{_literal_rows('column', [(c, 'NULL', 'NULL') for c in _PREP_FEATURES])} UNION ALL
{_literal_rows('fill', [(c, 'NULL', 'NULL') for c in _PREP_REQUIRED])} UNION ALL
{_literal_rows('bound', [(c, repr(lo), repr(hi)) for c, lo, hi in _PREP_BOUNDS])} UNION ALL
SELECT 1, 'scale', 0, 'distance_km', NULL, round(sd, 6), 0.0 FROM fitted UNION ALL
SELECT 1, 'labels', 0, 'store_and_fwd_flag', NULL, labels, NULL FROM fitted UNION ALL
SELECT 1, 'index', index::INTEGER, 'store_and_fwd_flag', value, index, NULL FROM ranks"""


# Fixed values of the query: depth and least node size.
_F_DEPTH, _F_LEAST = 7, 10

_F_X = ", ".join(f"{'distance_km / sd' if c == 'distance_km' else c + '::DOUBLE'} AS x{i}" for i, c in enumerate(_PREP_FEATURES))


ORACLES["forest_scoring"] = f"""
WITH {_PREP_CTE},
base AS MATERIALIZED (SELECT id, {_F_X}, trip_duration AS y, 0 AS fold, CASE WHEN bucket < 80 AND reason IS NULL THEN 1 ELSE 0 END AS w
  FROM reasoned WHERE reason IS NULL OR reason = 'range trip_duration'),
{bins_sql('base', 's_', 10)},
{binned_sql('base', 's_', 10, f"SELECT 0 AS t, NULL::INTEGER AS hold, {_F_LEAST} AS least")},
{forest_sql('s_', 10, _F_DEPTH)}
SELECT r.id, round(m.mean * 0.01, 6) AS trip_duration FROM s_r{_F_DEPTH} r JOIN ({means_sql('s_', _F_DEPTH)}) m ON r.node = m.node
WHERE r.id IN (SELECT id FROM reasoned WHERE store_and_fwd_flag IS NOT NULL AND {' AND '.join(f'{c} BETWEEN {lo!r} AND {hi!r}' for c, lo, hi in _PREP_BOUNDS[1:])})"""


# ------------------------------------------------------------ smaller pieces
ORACLES["batch_scoring_validation"] = f"""
WITH {tree_sql(f"SELECT * FROM ({_PARSED_TRAIN}) s WHERE bucket < 80", 'b_')},
sc AS ({route_sql(f"SELECT * FROM ({_PARSED_TRAIN}) s WHERE bucket >= 80", 'b_nodes')})
SELECT count(*)::BIGINT AS n, round(avg((y - prediction) * (y - prediction)), 4) AS mse,
       round(sqrt(avg((y - prediction) * (y - prediction))), 4) AS rmse, round(avg(abs(y - prediction)), 4) AS mae,
       round(CASE WHEN var_pop(y) = 0 THEN 0.0 ELSE 1.0 - sum((y - prediction) * (y - prediction)) / (var_pop(y) * count(*)) END, 4) AS r2
FROM sc"""


_TYPES = {"id": "int", "vendor_id": "int", "passenger_count": "int", "pickup_datetime": "timestamp", "store_and_fwd_flag": "string"}


ORACLES["csv_inferred"] = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", '{_TYPES.get(c, 'double')}' AS type, count({c})::BIGINT AS filled FROM ({TRIPS}) t"
    for c in ("id", "vendor_id", "passenger_count", "pickup_datetime", "pickup_longitude", "pickup_latitude", "dropoff_longitude",
              "dropoff_latitude", "store_and_fwd_flag", "trip_duration")
)


_DEPTH_ROW = "(SELECT max(depth) FROM t_nodes)"
_PATH = "translate(substr(bin(node), 2), '01', 'ac')"
_PAD = "repeat(' ', (depth + 1)::INTEGER)"
_NAME = f"{_NAMES}[f + 1]"


ORACLES["tree_text"] = f"""
WITH {tree_sql(_TRIP_TRAIN, 't_')},
lines AS (
  SELECT '' AS place, 'Regression tree of depth ' || {_DEPTH_ROW} || ' with ' || (SELECT count(*) FROM t_nodes) || ' nodes' AS line
  UNION ALL SELECT {_PATH} || 'A', {_PAD} || 'Predict: ' || round(prediction, 6)::VARCHAR FROM t_nodes WHERE f IS NULL
  UNION ALL SELECT {_PATH} || 'A', {_PAD} || 'If (' || {_NAME} || ' <= ' || round(threshold, 6)::VARCHAR || ')' FROM t_nodes WHERE f IS NOT NULL
  UNION ALL SELECT {_PATH} || 'b', {_PAD} || 'Else (' || {_NAME} || ' > ' || round(threshold, 6)::VARCHAR || ')' FROM t_nodes WHERE f IS NOT NULL)
SELECT (row_number() OVER (ORDER BY place) - 1)::BIGINT AS line_no, line FROM lines"""


_NB_KEY = "concat_ws('|', f1::VARCHAR, f2::VARCHAR, f3::VARCHAR, label::VARCHAR)"

_NB = f"""split AS MATERIALIZED (SELECT *, {hash_bucket(_NB_KEY)} AS bucket FROM (
  SELECT DISTINCT f1, f2, f3, label FROM ({FRAUD_PARSED_NO_TIME}) x WHERE reason IS NULL) c),
train AS (SELECT * FROM split WHERE bucket < 80),
test AS (SELECT * FROM split WHERE bucket >= 80),
mm AS (SELECT {', '.join(f'min(f{i}) AS lo{i}, greatest(max(f{i}) - min(f{i}), 1e-8) AS r{i}' for i in (1, 2, 3))} FROM train),
cwt AS (SELECT CASE WHEN n0 = 0 OR n1 = 0 THEN 1.0 ELSE (n0 + n1)::DOUBLE / (n0 * 2.0) END AS w0,
               CASE WHEN n0 = 0 OR n1 = 0 THEN 1.0 ELSE (n0 + n1)::DOUBLE / (n1 * 2.0) END AS w1
        FROM (SELECT count_if(label = 0.0) AS n0, count_if(label = 1.0) AS n1 FROM train) c),
strain AS (SELECT {', '.join(f'(f{i} - lo{i}) / r{i} AS x{i}' for i in (1, 2, 3))}, label AS y,
                  CASE WHEN label = 1.0 THEN w1 WHEN label = 0.0 THEN w0 ELSE 1.0 END AS cw FROM train, mm, cwt),
stest AS (SELECT {', '.join(f'(f{i} - lo{i}) / r{i} AS x{i}' for i in (1, 2, 3))}, label FROM test, mm)"""


ORACLES["classification_notebook"] = f"""
WITH RECURSIVE {_NB},
{gd_cte_multi(_GRID, 30, 1e-4)},
fin AS (SELECT * FROM gd WHERE (cfg, it) IN (SELECT cfg, max(it) FROM gd GROUP BY cfg)),
scored AS (SELECT cfg, {sigmoid('fin.b0 + fin.b1 * x1 + fin.b2 * x2 + fin.b3 * x3')} AS p, label,
                  concat_ws('|', x1::VARCHAR, x2::VARCHAR, x3::VARCHAR, label::VARCHAR) AS key FROM stest, fin),
aucs AS ({auc_stepwise_sql('SELECT * FROM scored', 'cfg')}),
best AS (SELECT * FROM aucs ORDER BY auc DESC, grp ASC LIMIT 1),
chosen AS MATERIALIZED (SELECT p, label FROM scored, best WHERE cfg = grp),
sweep AS ({' UNION ALL '.join(confusion_sql('chosen', repr(t)) for t in (0.1, 0.3, 0.5, 0.7, 0.9))})
SELECT threshold, tp, fp, tn, fn, {report_cols()}, round(auc, 6) AS auc, positives, negatives FROM sweep, best"""

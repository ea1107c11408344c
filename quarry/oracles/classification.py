"""Twins of the classification queries: the gradient-descent grid and the
stepwise AUC as window sums, the evaluation metrics, the SGD-rule grid
(recursive CTE) and the four-feature variants.
"""

from __future__ import annotations

from quarry.oracles.base import FRAUD_KEY, FRAUD_PREP, FRAUD_SPLIT, ORACLES, gd_cte, hash_bucket, r, report_cols, sigmoid
from quarry.oracles.profiling import _FRAUD_NN


ORACLES["gd_history"] = f"""
WITH RECURSIVE split AS ({FRAUD_SPLIT}),
{FRAUD_PREP},
{gd_cte(0.5, 0.01, 30, 1e-4)}
SELECT 0 AS config_index, 0.5::DOUBLE AS learning_rate, 0.01::DOUBLE AS reg_param, it::BIGINT AS iteration,
       round(loss, 6) AS loss, round(change, 6) AS loss_change
FROM gd WHERE it >= 1"""


def gd_cte_multi(configs: list[tuple[float, float]], max_iter: int, tol: float, train: str = "strain", k: int = 3) -> str:
    """``gd_cte`` for several (lr, reg) configurations at once (column ``cfg``)."""
    values = ", ".join(f"({i}, {lr!r}::DOUBLE, {reg!r}::DOUBLE)" for i, (lr, reg) in enumerate(configs))
    idx = range(1, k + 1)
    bs = ", ".join(f"b{i}" for i in idx)
    z = "g.b0 + " + " + ".join(f"g.b{i} * s.x{i}" for i in idx)
    loss = "sl / n + (" + " + ".join(f"0.5 * reg * b{i} * b{i}" for i in idx) + ")"
    return f"""
cfgs(cfg, lr, reg) AS (VALUES {values}),
gd(cfg, it, b0, {bs}, loss, change) AS (
  SELECT cfg, 0, 0.0::DOUBLE, {", ".join("0.0::DOUBLE" for _ in idx)}, NULL::DOUBLE, 'inf'::DOUBLE FROM cfgs
  UNION ALL
  SELECT c.cfg, it + 1,
         b0 - lr * (se / n), {", ".join(f"b{i} - lr * (se{i} / n + reg * b{i})" for i in idx)},
         {loss},
         CASE WHEN loss IS NULL THEN 'inf'::DOUBLE ELSE abs({loss} - loss) END
  FROM (
    SELECT cfg, it, b0, {bs}, loss, count(*) AS n,
           sum(e) AS se, {", ".join(f"sum(e * x{i}) AS se{i}" for i in idx)}, sum(l) AS sl
    FROM (
      SELECT cfg, it, b0, {bs}, loss, {", ".join(f"x{i}" for i in idx)}, cw * (p - y) AS e,
             CASE WHEN y = 1.0 THEN -cw * ln(p + 1e-9) ELSE -cw * ln(1.0 - p + 1e-9) END AS l
      FROM (
        SELECT g.cfg, g.it, g.b0, {", ".join(f"g.b{i}" for i in idx)}, g.loss, {", ".join(f"s.x{i}" for i in idx)},
               s.y, s.cw, {sigmoid(z)} AS p
        FROM gd g, {train} s
        WHERE g.it < {max_iter} AND g.change >= {tol}
      ) a
    ) b
    GROUP BY cfg, it, b0, {bs}, loss
  ) c JOIN cfgs USING (cfg)
)"""


def auc_stepwise_sql(scored: str, group: str = "0") -> str:
    """Per ``group``: the reference's AUC over ``scored(p, label, key)``."""
    return f"""
SELECT grp, CASE WHEN P = 0 OR N = 0 THEN 0.0 ELSE (sum_tp - last_tp / 2.0) / (P::DOUBLE * N::DOUBLE) END AS auc,
       P::BIGINT AS positives, N::BIGINT AS negatives
FROM (
  SELECT grp, sum(pos * m) AS P, sum(CASE WHEN pos = 0 THEN m ELSE 0 END) AS N,
         sum(CASE WHEN pos = 0 THEN cum_pos * m END) AS sum_tp, max(CASE WHEN pos = 0 THEN cum_pos END) AS last_tp
  FROM (
    SELECT *, sum(pos * m) OVER (PARTITION BY grp ORDER BY p DESC, key ASC, pos DESC
                                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_pos
    FROM (SELECT {group} AS grp, p, key, CASE WHEN label = 1.0 THEN 1 ELSE 0 END AS pos, count(*) AS m
          FROM ({scored}) s0 GROUP BY ALL) g
  ) r
  GROUP BY grp
) a"""


_GRID = [(lr, reg) for lr in (0.01, 0.1, 0.5) for reg in (0.001, 0.01, 0.1)]


_GRID_SCORED = f"""
SELECT fin.cfg, {sigmoid("fin.b0 + fin.b1 * t.x1 + fin.b2 * t.x2 + fin.b3 * t.x3")} AS p, t.y AS label, t.key
FROM (SELECT (f1 - lo1) / r1 AS x1, (f2 - lo2) / r2 AS x2, (f3 - lo3) / r3 AS x3, label AS y, {FRAUD_KEY} AS key
      FROM test, mm) t,
     (SELECT * FROM gd WHERE (cfg, it) IN (SELECT cfg, max(it) FROM gd GROUP BY cfg)) fin"""


ORACLES["gd_grid_best"] = f"""
WITH RECURSIVE split AS ({FRAUD_SPLIT}),
{FRAUD_PREP},
{gd_cte_multi(_GRID, 30, 1e-4)},
aucs AS ({auc_stepwise_sql(_GRID_SCORED, "cfg")})
SELECT grp::BIGINT AS config_index, lr AS learning_rate, reg AS reg_param, round(auc, 6) AS auc
FROM aucs JOIN cfgs ON grp = cfgs.cfg ORDER BY auc DESC, grp ASC LIMIT 1"""


SCORED_FRAUD = f"""
SELECT f1, f2, f3, label, {sigmoid("-6.0 + 0.08 * f1 + 30.0 * f2")} AS p, {FRAUD_KEY} AS key FROM ({_FRAUD_NN}) f"""


def _sweep_row(t: float) -> str:
    return f"""
SELECT {t!r}::DOUBLE AS threshold, tp, fp, tn, fn, {report_cols()}
FROM (SELECT count_if(p >= {t!r} AND label = 1.0)::BIGINT AS tp, count_if(p >= {t!r} AND label = 0.0)::BIGINT AS fp,
             count_if(p < {t!r} AND label = 0.0)::BIGINT AS tn, count_if(p < {t!r} AND label = 1.0)::BIGINT AS fn
      FROM ({SCORED_FRAUD}) s) c"""


ORACLES["confusion"] = _sweep_row(0.5)


ORACLES["threshold_sweep"] = "\nUNION ALL\n".join(_sweep_row(t) for t in (0.1, 0.3, 0.5, 0.7, 0.9))


ORACLES["auc_stepwise"] = (
    f"SELECT round(auc, 6) AS auc, positives, negatives FROM ({auc_stepwise_sql(SCORED_FRAUD)}) a"
)


_ROC = f"""
SELECT p AS threshold, pos, neg,
       sum(pos) OVER (ORDER BY p DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tp,
       sum(neg) OVER (ORDER BY p DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fp,
       sum(pos) OVER () AS P, sum(neg) OVER () AS N
FROM (SELECT p, count_if(label = 1.0) AS pos, count_if(label <> 1.0) AS neg FROM ({SCORED_FRAUD}) s GROUP BY p) g"""


ORACLES["auc_ties"] = f"""
SELECT round(CASE WHEN P * N = 0 THEN 0.0 ELSE sum(neg * (tp - pos / 2.0)) / (P::DOUBLE * N::DOUBLE) END, 6) AS auc,
       P::BIGINT AS positives, N::BIGINT AS negatives
FROM ({_ROC}) r GROUP BY P, N"""


_PREC = "(CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp::DOUBLE / (tp + fp) END)"


_REC = "(CASE WHEN P = 0 THEN 0.0 ELSE tp::DOUBLE / P END)"


ORACLES["roc_points"] = f"""
SELECT round(threshold, 6) AS threshold, round(CASE WHEN N = 0 THEN 0.0 ELSE fp::DOUBLE / N END, 6) AS fpr,
       round({_REC}, 6) AS tpr FROM ({_ROC}) r"""


ORACLES["metrics_by_threshold"] = f"""
SELECT round(threshold, 6) AS threshold, tp::BIGINT AS tp, fp::BIGINT AS fp, round({_PREC}, 6) AS precision,
       round({_REC}, 6) AS recall,
       round(CASE WHEN {_PREC} + {_REC} = 0 THEN 0.0 ELSE 2.0 * {_PREC} * {_REC} / ({_PREC} + {_REC}) END, 6) AS f1
FROM ({_ROC}) r"""


ORACLES["weighted_metrics"] = f"""
WITH pred AS (SELECT label AS y, CASE WHEN p >= 0.5 THEN 1.0 ELSE 0.0 END AS yhat FROM ({SCORED_FRAUD}) s),
     cells AS (SELECT y, yhat, count(*) AS n FROM pred GROUP BY ALL),
     a AS (SELECT y AS c, sum(n) AS actual, sum(CASE WHEN y = yhat THEN n ELSE 0 END) AS tp FROM cells GROUP BY y),
     pr AS (SELECT yhat AS c, sum(n) AS predicted FROM cells GROUP BY yhat),
     pc AS (SELECT actual, tp,
                   CASE WHEN coalesce(predicted, 0) = 0 THEN 0.0 ELSE tp::DOUBLE / predicted END AS prc,
                   CASE WHEN actual = 0 THEN 0.0 ELSE tp::DOUBLE / actual END AS rc
            FROM a LEFT JOIN pr USING (c))
SELECT round(sum(tp) / sum(actual), 6) AS accuracy,
       round(sum(prc * actual) / sum(actual), 6) AS weighted_precision,
       round(sum(rc * actual) / sum(actual), 6) AS weighted_recall,
       round(sum(CASE WHEN prc + rc = 0 THEN 0.0 ELSE 2.0 * prc * rc / (prc + rc) END * actual) / sum(actual), 6) AS weighted_f1,
       sum(actual)::BIGINT AS n
FROM pc"""


def sgd_cte(configs: list[tuple[int, float]], reg: float = 0.01, tol: float = 1e-3, train: str = "sgtrain") -> str:
    """Recursive CTE of ``logistic.sgd_fit``: no intercept, step/√t, L2
    updater, stop at the iteration limit or when ‖Δw‖ < tol·max(‖w‖, 1)."""
    values = ", ".join(f"({i}, {it}, {st!r}::DOUBLE)" for i, (it, st) in enumerate(configs))
    z = "0.0 + g.w1 * s.x1 + g.w2 * s.x2 + g.w3 * s.x3"
    eta = "(step / sqrt((t + 1)::DOUBLE))"
    nw = [f"(w{i} * (1.0 - {eta} * {reg!r}) - ({eta} * sg{i}) / n)" for i in (1, 2, 3)]
    diff = f"sqrt(({nw[0]} - w1) * ({nw[0]} - w1) + ({nw[1]} - w2) * ({nw[1]} - w2) + ({nw[2]} - w3) * ({nw[2]} - w3))"
    norm = f"sqrt({nw[0]} * {nw[0]} + {nw[1]} * {nw[1]} + {nw[2]} * {nw[2]})"
    return f"""
scfg(cfg, lim, step) AS (VALUES {values}),
sgd(cfg, t, w1, w2, w3, done) AS (
  SELECT cfg, 0, 0.0::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE, false FROM scfg
  UNION ALL
  SELECT c.cfg, t + 1, {nw[0]}, {nw[1]}, {nw[2]},
         (t + 1 > 1 AND {diff} < {tol!r} * greatest({norm}, 1.0)) OR t + 1 >= lim
  FROM (
    SELECT cfg, t, w1, w2, w3, count(*) AS n, sum(e * x1) AS sg1, sum(e * x2) AS sg2, sum(e * x3) AS sg3
    FROM (SELECT g.cfg, g.t, g.w1, g.w2, g.w3, s.x1, s.x2, s.x3, 1.0 * ({sigmoid(z)} - s.y) AS e
          FROM sgd g, {train} s WHERE NOT g.done) a
    GROUP BY cfg, t, w1, w2, w3
  ) c JOIN scfg USING (cfg)
)"""


_SGD_CFGS = [(it, st) for it in (50, 100, 200) for st in (0.01, 0.1, 0.5)]


ORACLES["lr_sgd_metrics"] = f"""
WITH RECURSIVE split AS ({FRAUD_SPLIT}),
train AS (SELECT f1, f2, f3, label FROM split WHERE bucket < 80),
test AS (SELECT f1, f2, f3, label FROM split WHERE bucket >= 80),
sd AS (SELECT stddev_samp(f1) AS s1, stddev_samp(f2) AS s2, stddev_samp(f3) AS s3 FROM train),
sgtrain AS (SELECT CASE WHEN s1 > 0 THEN f1 / s1 ELSE 0.0 END AS x1, CASE WHEN s2 > 0 THEN f2 / s2 ELSE 0.0 END AS x2,
                   CASE WHEN s3 > 0 THEN f3 / s3 ELSE 0.0 END AS x3, label AS y FROM train, sd),
sgtest AS (SELECT CASE WHEN s1 > 0 THEN f1 / s1 ELSE 0.0 END AS x1, CASE WHEN s2 > 0 THEN f2 / s2 ELSE 0.0 END AS x2,
                  CASE WHEN s3 > 0 THEN f3 / s3 ELSE 0.0 END AS x3, label AS y FROM test, sd),
{sgd_cte(_SGD_CFGS)},
fin AS (SELECT * FROM sgd WHERE (cfg, t) IN (SELECT cfg, max(t) FROM sgd GROUP BY cfg)),
pred AS (SELECT fin.cfg, t.y AS label,
                CASE WHEN {sigmoid("0.0 + fin.w1 * t.x1 + fin.w2 * t.x2 + fin.w3 * t.x3")} >= 0.5 THEN 1.0 ELSE 0.0 END AS prediction
         FROM sgtest t, fin),
cells AS (SELECT cfg, label, prediction, count(*) AS n FROM pred GROUP BY ALL),
a AS (SELECT cfg, label AS c, sum(n) AS actual, sum(CASE WHEN label = prediction THEN n ELSE 0 END) AS tp
      FROM cells GROUP BY cfg, label),
pr AS (SELECT cfg, prediction AS c, sum(n) AS predicted FROM cells GROUP BY cfg, prediction),
pc AS (SELECT cfg, actual, tp, CASE WHEN coalesce(predicted, 0) = 0 THEN 0.0 ELSE tp::DOUBLE / predicted END AS prc,
              CASE WHEN actual = 0 THEN 0.0 ELSE tp::DOUBLE / actual END AS rc
       FROM a LEFT JOIN pr USING (cfg, c)),
rep AS (SELECT cfg, sum(tp) / sum(actual) AS accuracy, sum(prc * actual) / sum(actual) AS weighted_precision,
               sum(rc * actual) / sum(actual) AS weighted_recall,
               sum(CASE WHEN prc + rc = 0 THEN 0.0 ELSE 2.0 * prc * rc / (prc + rc) END * actual) / sum(actual) AS weighted_f1
        FROM pc GROUP BY cfg),
roc AS (SELECT cfg, sum(CASE WHEN label = 1.0 AND prediction = 1.0 THEN n ELSE 0 END) AS tp,
               sum(CASE WHEN label = 1.0 THEN n ELSE 0 END) AS P,
               sum(CASE WHEN label <> 1.0 AND prediction = 1.0 THEN n ELSE 0 END) AS fp,
               sum(CASE WHEN label <> 1.0 THEN n ELSE 0 END) AS N FROM cells GROUP BY cfg)
SELECT rep.cfg::BIGINT AS config_index, scfg.lim AS iterations, fin.t AS iterations_run, scfg.step AS step,
       round(accuracy, 6) AS accuracy, round(weighted_precision, 6) AS weighted_precision,
       round(weighted_recall, 6) AS weighted_recall, round(weighted_f1, 6) AS weighted_f1,
       round((1.0 + CASE WHEN P = 0 THEN 0.0 ELSE tp::DOUBLE / P END - CASE WHEN N = 0 THEN 0.0 ELSE fp::DOUBLE / N END) / 2.0, 6) AS auc
FROM rep JOIN roc USING (cfg) JOIN scfg USING (cfg) JOIN fin USING (cfg)"""


FRAUD_WIDE = """
SELECT l_quantity AS f1, l_discount AS f2,
       CASE WHEN l_tax = 0.0 THEN NULL ELSE l_tax END AS f3, l_extendedprice AS f4,
       CASE WHEN l_quantity * l_discount > 4.0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS label
FROM lineitem"""


_W_CLEAN = f"""
SELECT DISTINCT * FROM ({FRAUD_WIDE}) t
WHERE f1 IS NOT NULL AND NOT isnan(f1) AND f2 IS NOT NULL AND NOT isnan(f2) AND f3 IS NOT NULL AND NOT isnan(f3)
  AND f4 IS NOT NULL AND NOT isnan(f4) AND label IS NOT NULL AND NOT isnan(label)"""


_W_KEY = "concat_ws('|', " + ", ".join(f"CAST({c} AS DECIMAL(20,6))::VARCHAR" for c in ("f1", "f2", "f3", "f4", "label")) + ")"


_W_SPLIT = f"SELECT f1, f2, f3, f4, label, {hash_bucket(_W_KEY)} AS bucket FROM ({_W_CLEAN}) c"


_W_MM = ", ".join(f"min(f{i}) AS lo{i}, greatest(max(f{i}) - min(f{i}), 1e-8) AS r{i}" for i in range(1, 5))


_W_X = ", ".join(f"(f{i} - lo{i}) / r{i} AS x{i}" for i in range(1, 5))


_W_PREP = f"""
train AS (SELECT * FROM split WHERE bucket < 80),
test AS (SELECT * FROM split WHERE bucket >= 80),
mm AS (SELECT {_W_MM} FROM train),
cwt AS (SELECT n0, n1,
               CASE WHEN n0 = 0 OR n1 = 0 THEN 1.0 ELSE (n0 + n1)::DOUBLE / (n0 * 2.0) END AS w0,
               CASE WHEN n0 = 0 OR n1 = 0 THEN 1.0 ELSE (n0 + n1)::DOUBLE / (n1 * 2.0) END AS w1
        FROM (SELECT count_if(label = 0.0) AS n0, count_if(label = 1.0) AS n1 FROM train) c),
strain AS (SELECT {_W_X}, label AS y, CASE WHEN label = 1.0 THEN w1 WHEN label = 0.0 THEN w0 ELSE 1.0 END AS cw
           FROM train, mm, cwt),
stest AS (SELECT {_W_X}, label AS y FROM test, mm)"""


ORACLES["fraud_report_wide"] = f"""
WITH RECURSIVE split AS ({_W_SPLIT}),
{_W_PREP},
{gd_cte(0.5, 0.01, 30, 1e-4, k=4)},
fin AS (SELECT * FROM gd WHERE it = (SELECT max(it) FROM gd)),
scored AS (SELECT y, {sigmoid("fin.b0 + fin.b1 * x1 + fin.b2 * x2 + fin.b3 * x3 + fin.b4 * x4")} AS p FROM stest, fin),
conf AS (SELECT count_if(p >= 0.5 AND y = 1.0)::BIGINT AS tp, count_if(p >= 0.5 AND y = 0.0)::BIGINT AS fp,
                count_if(p < 0.5 AND y = 0.0)::BIGINT AS tn, count_if(p < 0.5 AND y = 1.0)::BIGINT AS fn
         FROM scored)
SELECT 0.5::DOUBLE AS threshold, tp, fp, tn, fn, {report_cols()},
       (SELECT (n0 + n1)::BIGINT FROM cwt) AS n_train,
       fin.it::BIGINT AS iterations, {r("fin.loss")} AS final_loss,
       {r("fin.b0")} AS w0, {r("fin.b1")} AS w1, {r("fin.b2")} AS w2, {r("fin.b3")} AS w3, {r("fin.b4")} AS w4
FROM conf, fin"""


_W_GRID_SCORED = f"""
SELECT fin.cfg, {sigmoid("fin.b0 + fin.b1 * t.x1 + fin.b2 * t.x2 + fin.b3 * t.x3 + fin.b4 * t.x4")} AS p,
       t.y AS label, t.key
FROM (SELECT {_W_X}, label AS y, {_W_KEY} AS key FROM test, mm) t,
     (SELECT * FROM gd WHERE (cfg, it) IN (SELECT cfg, max(it) FROM gd GROUP BY cfg)) fin"""


ORACLES["gd_grid_best_wide"] = f"""
WITH RECURSIVE split AS ({_W_SPLIT}),
{_W_PREP},
{gd_cte_multi(_GRID, 30, 1e-4, k=4)},
aucs AS ({auc_stepwise_sql(_W_GRID_SCORED, "cfg")})
SELECT grp::BIGINT AS config_index, lr AS learning_rate, reg AS reg_param, round(auc, 6) AS auc
FROM aucs JOIN cfgs ON grp = cfgs.cfg ORDER BY auc DESC, grp ASC LIMIT 1"""

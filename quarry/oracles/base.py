"""Shared pieces of the DuckDB twins: the ``ORACLES`` registry, the fraud
fixture and its clean/split forms, SQL helpers (sigmoid, rounding, report
columns, md5 bucket), gradient descent as a recursive CTE, and the flagship.
"""

from __future__ import annotations


ORACLES: dict[str, str] = {}


FRAUD = """
SELECT l_quantity AS f1, l_discount AS f2,
       CASE WHEN l_tax = 0.0 THEN NULL ELSE l_tax END AS f3,
       CASE WHEN l_quantity * l_discount > 4.0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS label
FROM lineitem"""


FRAUD_CLEAN = f"""
SELECT DISTINCT * FROM ({FRAUD}) t
WHERE f1 IS NOT NULL AND NOT isnan(f1) AND f2 IS NOT NULL AND NOT isnan(f2)
  AND f3 IS NOT NULL AND NOT isnan(f3) AND label IS NOT NULL AND NOT isnan(label)"""


FRAUD_KEY = (
    "concat_ws('|', CAST(f1 AS DECIMAL(20,6))::VARCHAR, CAST(f2 AS DECIMAL(20,6))::VARCHAR, "
    "CAST(f3 AS DECIMAL(20,6))::VARCHAR, CAST(label AS DECIMAL(20,6))::VARCHAR)"
)


def hash_bucket(key_sql: str, seed: int = 42) -> str:
    return f"(('0x' || substr(md5(concat_ws('|', '{seed}', {key_sql})), 1, 7))::BIGINT % 100)"


FRAUD_SPLIT = f"""
SELECT f1, f2, f3, label, {hash_bucket(FRAUD_KEY)} AS bucket FROM ({FRAUD_CLEAN}) c"""


def sigmoid(z: str) -> str:
    return f"(CASE WHEN ({z}) < -500.0 THEN 0.0 WHEN ({z}) > 500.0 THEN 1.0 ELSE 1.0 / (1.0 + exp(-({z}))) END)"


def r(expr: str, digits: int = 6) -> str:
    return f"round({expr}, {digits})"


def report_cols(tp="tp", fp="fp", tn="tn", fn="fn") -> str:
    prec = f"(CASE WHEN {tp} + {fp} = 0 THEN 0.0 ELSE {tp}::DOUBLE / ({tp} + {fp}) END)"
    rec = f"(CASE WHEN {tp} + {fn} = 0 THEN 0.0 ELSE {tp}::DOUBLE / ({tp} + {fn}) END)"
    acc = f"(CASE WHEN {tp}+{fp}+{tn}+{fn} = 0 THEN 0.0 ELSE ({tp} + {tn})::DOUBLE / ({tp}+{fp}+{tn}+{fn}) END)"
    f1 = f"(CASE WHEN {prec} + {rec} = 0 THEN 0.0 ELSE 2.0 * {prec} * {rec} / ({prec} + {rec}) END)"
    return f"{r(acc)} AS accuracy, {r(prec)} AS precision, {r(rec)} AS recall, {r(f1)} AS f1"


def gd_cte(lr: float, reg: float, max_iter: int, tol: float, train: str = "strain", k: int = 3) -> str:
    """Recursive CTE of full-batch gradient descent over ``train(x1..xk, y, cw)``.

    Row ``it`` holds the weights after ``it`` updates and the loss measured
    before the last update; recursion stops after ``max_iter`` rows or when
    the loss change falls below ``tol`` (that update is still applied).
    """
    idx = range(1, k + 1)
    bs = ", ".join(f"b{i}" for i in idx)
    z = "g.b0 + " + " + ".join(f"g.b{i} * s.x{i}" for i in idx)
    regl = " + ".join(f"0.5 * {reg} * b{i} * b{i}" for i in idx)
    return f"""
gd(it, b0, {bs}, loss, change) AS (
  SELECT 0, 0.0::DOUBLE, {", ".join("0.0::DOUBLE" for _ in idx)}, NULL::DOUBLE, 'inf'::DOUBLE
  UNION ALL
  SELECT it + 1,
         b0 - {lr} * (se / n),
         {", ".join(f"b{i} - {lr} * (se{i} / n + {reg} * b{i})" for i in idx)},
         sl / n + ({regl}),
         CASE WHEN loss IS NULL THEN 'inf'::DOUBLE ELSE abs(sl / n + ({regl}) - loss) END
  FROM (
    SELECT it, b0, {bs}, loss, count(*) AS n,
           sum(e) AS se, {", ".join(f"sum(e * x{i}) AS se{i}" for i in idx)}, sum(l) AS sl
    FROM (
      SELECT it, b0, {bs}, loss, {", ".join(f"x{i}" for i in idx)}, cw * (p - y) AS e,
             CASE WHEN y = 1.0 THEN -cw * ln(p + 1e-9) ELSE -cw * ln(1.0 - p + 1e-9) END AS l
      FROM (
        SELECT g.it, g.b0, {", ".join(f"g.b{i}" for i in idx)}, g.loss, {", ".join(f"s.x{i}" for i in idx)},
               s.y, s.cw, {sigmoid(z)} AS p
        FROM gd g, {train} s
        WHERE g.it < {max_iter} AND g.change >= {tol}
      ) a
    ) b
    GROUP BY it, b0, {bs}, loss
  ) c
)"""


FRAUD_PREP = """
train AS (SELECT f1, f2, f3, label FROM split WHERE bucket < 80),
test AS (SELECT f1, f2, f3, label FROM split WHERE bucket >= 80),
mm AS (SELECT min(f1) AS lo1, greatest(max(f1) - min(f1), 1e-8) AS r1,
              min(f2) AS lo2, greatest(max(f2) - min(f2), 1e-8) AS r2,
              min(f3) AS lo3, greatest(max(f3) - min(f3), 1e-8) AS r3 FROM train),
cnt AS (SELECT count_if(label = 0.0) AS n0, count_if(label = 1.0) AS n1 FROM train),
cwt AS (SELECT n0, n1,
               CASE WHEN n0 = 0 OR n1 = 0 THEN 1.0 ELSE (n0 + n1)::DOUBLE / (n0 * 2.0) END AS w0,
               CASE WHEN n0 = 0 OR n1 = 0 THEN 1.0 ELSE (n0 + n1)::DOUBLE / (n1 * 2.0) END AS w1
        FROM cnt),
strain AS (SELECT (f1 - lo1) / r1 AS x1, (f2 - lo2) / r2 AS x2, (f3 - lo3) / r3 AS x3, label AS y,
                  CASE WHEN label = 1.0 THEN w1 WHEN label = 0.0 THEN w0 ELSE 1.0 END AS cw
           FROM train, mm, cwt),
stest AS (SELECT (f1 - lo1) / r1 AS x1, (f2 - lo2) / r2 AS x2, (f3 - lo3) / r3 AS x3, label AS y
          FROM test, mm)"""


ORACLES["fraud_report"] = f"""
WITH RECURSIVE split AS ({FRAUD_SPLIT}),
{FRAUD_PREP},
{gd_cte(0.5, 0.01, 30, 1e-4)},
fin AS (SELECT * FROM gd WHERE it = (SELECT max(it) FROM gd)),
scored AS (SELECT y, {sigmoid("fin.b0 + fin.b1 * x1 + fin.b2 * x2 + fin.b3 * x3")} AS p FROM stest, fin),
conf AS (SELECT count_if(p >= 0.5 AND y = 1.0)::BIGINT AS tp, count_if(p >= 0.5 AND y = 0.0)::BIGINT AS fp,
                count_if(p < 0.5 AND y = 0.0)::BIGINT AS tn, count_if(p < 0.5 AND y = 1.0)::BIGINT AS fn
         FROM scored)
SELECT 0.5::DOUBLE AS threshold, tp, fp, tn, fn, {report_cols()},
       (SELECT (n0 + n1)::BIGINT FROM cwt) AS n_train,
       fin.it::BIGINT AS iterations, {r("fin.loss")} AS final_loss,
       {r("fin.b0")} AS w0, {r("fin.b1")} AS w1, {r("fin.b2")} AS w2, {r("fin.b3")} AS w3
FROM conf, fin"""

"""Evaluation queries.  The predictions are a rule over each order, so that the
SQL twin can state the same rule."""

from pyspark.sql import functions as F

from tidewater.operators import metrics as M
from tidewater.plans.registry import query
from tidewater.session import table

RULE_SQL = """p AS (SELECT o_orderkey, substr(o_orderpriority, 1, 1) AS label,
    CASE WHEN (o_orderkey + o_custkey) % 3 <> 0 THEN substr(o_orderpriority, 1, 1)
         WHEN o_totalprice > 300000 THEN '1' WHEN o_totalprice > 200000 THEN '3' ELSE '5' END AS predicted FROM orders),
  c AS (SELECT label, predicted, count(*) AS n FROM p GROUP BY 1, 2),
  k AS (SELECT DISTINCT label AS cls FROM c UNION SELECT DISTINCT predicted FROM c),
  s AS (SELECT cls, coalesce((SELECT sum(n) FROM c WHERE label = cls AND predicted = cls), 0) AS tp,
     coalesce((SELECT sum(n) FROM c WHERE label = cls), 0) AS support,
     coalesce((SELECT sum(n) FROM c WHERE predicted = cls), 0) AS chosen FROM k)"""


def ruled(spark, d):
    label = F.substring("o_orderpriority", 1, 1)
    guess = (
        F.when((F.col("o_orderkey") + F.col("o_custkey")) % 3 != 0, label)
        .when(F.col("o_totalprice") > 300000, "1")
        .when(F.col("o_totalprice") > 200000, "3")
        .otherwise("5")
    )
    return table(spark, d, "orders").select(label.alias("label"), guess.alias("predicted"))


def rounded(df, digits=6):
    return df.select(*[F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


@query(
    "eval_accuracy",
    f"""WITH {RULE_SQL} SELECT count(*) AS n, count(*) FILTER (label = predicted) AS correct,
        round(avg((label = predicted)::INTEGER), 6) AS accuracy, round(1 - avg((label = predicted)::INTEGER), 6) AS error_rate FROM p""",
)
def eval_accuracy(spark, d):
    return rounded(M.accuracy(ruled(spark, d), "label", "predicted"))


@query(
    "eval_weighted_prf",
    f"""WITH {RULE_SQL} SELECT round(sum(coalesce(tp / nullif(chosen, 0), 0) * support) / sum(support), 6) AS weighted_precision,
        round(sum(coalesce(tp / nullif(support, 0), 0) * support) / sum(support), 6) AS weighted_recall,
        round(sum(coalesce(2 * tp / nullif(chosen + support, 0), 0) * support) / sum(support), 6) AS weighted_f1 FROM s""",
)
def eval_weighted_prf(spark, d):
    return rounded(M.weighted_prf(ruled(spark, d), "label", "predicted"))


@query(
    "eval_macro_prf",
    f"""WITH {RULE_SQL} SELECT round(avg(tp / nullif(chosen, 0)), 6) AS macro_precision,
        round(avg(tp / nullif(support, 0)), 6) AS macro_recall, round(avg(2 * tp / nullif(chosen + support, 0)), 6) AS macro_f1 FROM s""",
)
def eval_macro_prf(spark, d):
    return rounded(M.macro_prf(ruled(spark, d), "label", "predicted", ["1", "2", "3", "4", "5"]))


@query(
    "eval_kappa",
    f"""WITH {RULE_SQL}, t AS (SELECT sum(support) AS n, sum(tp) AS tp, sum(support * chosen) AS m FROM s)
        SELECT round(tp / n, 6) AS observed, round(m / (n * n), 6) AS expected,
               round((tp / n - m / (n * n)) / (1 - m / (n * n)), 6) AS kappa FROM t""",
)
def eval_kappa(spark, d):
    return rounded(M.kappa(ruled(spark, d), "label", "predicted"))


@query(
    "confusion_pairs",
    f"""WITH {RULE_SQL} SELECT least(label, predicted) AS a, greatest(label, predicted) AS b, sum(n)::BIGINT AS n
        FROM c WHERE label <> predicted GROUP BY 1, 2 ORDER BY n DESC, a, b LIMIT 5""",
)
def confusion_pairs(spark, d):
    return M.confusion_pairs(ruled(spark, d), "label", "predicted", 5)


@query(
    "eval_regression",
    """WITH m AS (SELECT regr_slope(l_extendedprice, l_quantity) AS b, regr_intercept(l_extendedprice, l_quantity) AS a FROM lineitem),
       e AS (SELECT l_extendedprice AS y, l_extendedprice - (a + b * l_quantity) AS err FROM lineitem, m)
       SELECT round(sqrt(avg(err * err)), 4) AS rmse, round(avg(abs(err)), 4) AS mae,
              round(1 - sum(err * err) / (var_pop(y) * count(y)), 4) AS r2 FROM e""",
)
def eval_regression(spark, d):
    items = table(spark, d, "lineitem").select("l_extendedprice", "l_quantity")
    fit = items.agg(
        F.regr_slope("l_extendedprice", "l_quantity").alias("b"), F.regr_intercept("l_extendedprice", "l_quantity").alias("a")
    ).first()
    guessed = items.withColumn("fitted", F.lit(fit["a"]) + F.lit(fit["b"]) * F.col("l_quantity"))
    return rounded(M.regression(guessed, "l_extendedprice", "fitted"), 4)


@query(
    "linreg_simple",
    """SELECT l_returnflag, round(regr_slope(l_extendedprice, l_quantity), 4) AS slope,
       round(regr_intercept(l_extendedprice, l_quantity), 4) AS intercept,
       round(regr_r2(l_extendedprice, l_quantity), 6) AS r2 FROM lineitem GROUP BY 1""",
)
def linreg_simple(spark, d):
    return table(spark, d, "lineitem").groupBy("l_returnflag").agg(
        F.round(F.regr_slope("l_extendedprice", "l_quantity"), 4).alias("slope"),
        F.round(F.regr_intercept("l_extendedprice", "l_quantity"), 4).alias("intercept"),
        F.round(F.regr_r2("l_extendedprice", "l_quantity"), 6).alias("r2"),
    )

"""Chart-data queries."""

from pyspark.sql import functions as F

from tidewater.functions import scalars as S
from tidewater.operators import charts as H
from tidewater.operators import sampling as P
from tidewater.plans.expressions import gradient_sql
from tidewater.plans.ordering import hash_sql
from tidewater.plans.registry import query
from tidewater.session import table

VALUE_STOPS = [(5.0, S.BLUE_ARGB), (50.0, S.GREEN_ARGB), (150.0, S.RED_ARGB)]


@query(
    "scatter_frame",
    f"""WITH c AS ({gradient_sql('value', VALUE_STOPS, 'events', 'event_id')})
        SELECT event_id, event_type AS series, hour(ts)::DOUBLE AS x, value AS y, argb AS colour, 7.0::DOUBLE AS size
        FROM events JOIN c USING (event_id)""",
)
def scatter_frame(spark, d):
    colour = S.argb_hex(S.colour_gradient(F.col("value"), VALUE_STOPS))
    return H.scatter_frame(
        table(spark, d, "events"), F.col("event_type"), F.hour("ts"), F.col("value"), colour, F.lit(7), ["event_id"]
    )


@query(
    "axis_extent",
    """SELECT 'money' AS axis, round(least((SELECT min(c_acctbal - 10) FROM customer), (SELECT min(s_acctbal - 5) FROM supplier)), 2) AS lo,
              round(greatest((SELECT max(c_acctbal + 10) FROM customer), (SELECT max(s_acctbal + 5) FROM supplier)), 2) AS hi
       UNION ALL SELECT 'size', min(p_size)::DOUBLE, max(p_size)::DOUBLE FROM part
       UNION ALL SELECT 'none', 0.0, 0.0""",
)
def axis_extent(spark, d):
    ext = H.axis_extent([
        ("money", table(spark, d, "customer"), "c_acctbal", F.lit(10.0)),
        ("money", table(spark, d, "supplier"), "s_acctbal", F.lit(5.0)),
        ("size", table(spark, d, "part"), "p_size", F.lit(0.0)),
        ("none", table(spark, d, "part").filter("p_size < 0"), "p_retailprice", F.lit(0.0)),
    ])
    return ext.select("axis", F.round("lo", 2).alias("lo"), F.round("hi", 2).alias("hi"))


@query(
    "error_bars",
    """SELECT l_returnflag, l_linenumber, round(x, 6) AS x, round(y, 4) AS y, round(x - ex, 6) AS x_lo, round(x + ex, 6) AS x_hi,
              round(y - ey, 4) AS y_lo, round(y + ey, 4) AS y_hi
       FROM (SELECT l_returnflag, l_linenumber, avg(l_quantity) AS x, avg(l_extendedprice) AS y, stddev_samp(l_quantity) AS ex,
             stddev_samp(l_extendedprice) AS ey FROM lineitem GROUP BY 1, 2)""",
)
def error_bars(spark, d):
    g = table(spark, d, "lineitem").groupBy("l_returnflag", "l_linenumber").agg(
        F.avg("l_quantity").alias("x"), F.avg("l_extendedprice").alias("y"),
        F.stddev_samp("l_quantity").alias("ex"), F.stddev_samp("l_extendedprice").alias("ey"),
    )
    e = H.error_bars(g, "x", "y", F.col("ex"), F.col("ey"))
    return e.select(
        "l_returnflag", "l_linenumber", *[F.round(c, 6 if c[0] == "x" else 4).alias(c) for c in ("x", "y", "x_lo", "x_hi", "y_lo", "y_hi")]
    )


BARS = "SELECT p_type AS category, p_brand AS series, round(sum(p_retailprice - 940), 2) AS v FROM part GROUP BY 1, 2"


def bars(spark, d, stacked):
    return H.bar_frame(table(spark, d, "part"), "p_type", "p_brand", F.col("p_retailprice") - 940, stacked)


@query(
    "bar_frame",
    f"""WITH b AS ({BARS}) SELECT category, series, v, round(least(v, 0), 2) AS lo, round(greatest(v, 0), 2) AS hi,
        round(sum(v) OVER (PARTITION BY category ORDER BY series ROWS UNBOUNDED PRECEDING), 2) AS stacked_hi FROM b""",
)
def bar_frame(spark, d):
    flat = bars(spark, d, False)
    stacked = bars(spark, d, True).select("category", "series", F.round("hi", 2).alias("stacked_hi"))
    return flat.select("category", "series", *[F.round(c, 2).alias(c) for c in ("v", "lo", "hi")]).join(stacked, ["category", "series"])


@query(
    "bar_extent",
    f"""WITH b AS ({BARS}), s AS (SELECT category, sum(v) AS v FROM b GROUP BY 1)
        SELECT 'stacked' AS kind, round(min(v), 2) AS lo, round(max(v), 2) AS hi FROM s
        UNION ALL SELECT 'side', round(min(v), 2), round(max(v), 2) FROM b""",
)
def bar_extent(spark, d):
    out = None
    for kind, stacked in (("stacked", True), ("side", False)):
        e = H.bar_extent(bars(spark, d, stacked), stacked)
        e = e.select(F.lit(kind).alias("kind"), F.round("lo", 2).alias("lo"), F.round("hi", 2).alias("hi"))
        out = e if out is None else out.unionByName(e)
    return out


@query("bar_counts", "SELECT o_orderpriority AS category, count(*) AS n FROM orders GROUP BY 1")
def bar_counts(spark, d):
    return table(spark, d, "orders").groupBy(F.col("o_orderpriority").alias("category")).agg(F.count("*").alias("n"))


@query(
    "histogram_bins",
    """WITH c AS (SELECT event_type AS series, floor(value / 10)::BIGINT AS bin, count(*) AS n FROM events WHERE value IS NOT NULL GROUP BY 1, 2),
       g AS (SELECT series, unnest(range((SELECT min(bin) FROM c), (SELECT max(bin) + 1 FROM c)))::BIGINT AS bin FROM (SELECT DISTINCT series FROM c)),
       f AS (SELECT g.series, g.bin, coalesce(n, 0) AS n FROM g LEFT JOIN c ON c.series = g.series AND c.bin = g.bin),
       s AS (SELECT *, sum(n) OVER (PARTITION BY bin ORDER BY series ROWS UNBOUNDED PRECEDING)::BIGINT AS stack_hi FROM f)
       SELECT series, bin, bin * 10.0::DOUBLE AS edge_lo, bin * 10.0::DOUBLE + 10 AS edge_hi, n, stack_hi - n AS stack_lo, stack_hi FROM s""",
)
def histogram_bins(spark, d):
    return H.histogram_bins(table(spark, d, "events"), "value", 0.0, 10.0, "event_type")


@query(
    "panel_frames",
    """WITH p AS (SELECT p_type AS panel_row, p_brand AS panel_col, count(*) AS n, min(p_size) AS x0, max(p_size) AS x1,
           min(p_retailprice) AS y0, max(p_retailprice) AS y1 FROM part GROUP BY 1, 2)
       SELECT panel_row, panel_col, n, min(y0) OVER (PARTITION BY panel_row) AS y_lo, max(y1) OVER (PARTITION BY panel_row) AS y_hi,
              min(x0) OVER () AS x_lo, max(x1) OVER () AS x_hi FROM p""",
)
def panel_frames(spark, d):
    return H.panel_frames(table(spark, d, "part"), "p_type", "p_brand", "p_size", "p_retailprice")


@query(
    "dual_measure_hourly",
    """WITH h AS (SELECT hour(ts) AS h, count(DISTINCT user_id) AS users, count(*) AS n, round(sum(value), 2) AS bytes FROM events GROUP BY 1)
       SELECT h, users, n, bytes FROM h""",
)
def dual_measure_hourly(spark, d):
    return table(spark, d, "events").groupBy(F.hour("ts").cast("bigint").alias("h")).agg(
        F.countDistinct("user_id").alias("users"), F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("bytes")
    )


@query(
    "client_hour_scatter",
    f"""SELECT user_id, hour(ts) AS h, count(*) AS n FROM events WHERE user_id IN (
        SELECT user_id FROM (SELECT DISTINCT user_id FROM events) ORDER BY {hash_sql('user_id', 13)}, user_id LIMIT 10) GROUP BY 1, 2""",
)
def client_hour_scatter(spark, d):
    ev = table(spark, d, "events").select("user_id", "ts")
    chosen = P.sample_keys(ev, "user_id", 10, 13)
    return chosen.groupBy("user_id", F.hour("ts").cast("bigint").alias("h")).agg(F.count("*").alias("n"))

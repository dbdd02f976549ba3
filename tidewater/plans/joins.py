"""Equi-joins, lookups, zips and pair counts; the flagship economy query."""

from pyspark.sql import functions as F

from tidewater.functions import scalars as S
from tidewater.operators import ordered as O
from tidewater.operators import relational as R
from tidewater.operators.relational import small
from tidewater.plans.expressions import gradient_sql
from tidewater.plans.registry import query
from tidewater.session import table

RATE_STOPS = [(240000.0, S.BLUE_ARGB), (250000.0, S.GREEN_ARGB), (262000.0, S.RED_ARGB)]


def mean4(col):
    """Mean of cents to four places.  The nudge, repeated in the SQL, settles
    means that end in exactly half a unit whatever the order of the sum."""
    return F.round(F.col(col) + F.lit(1e-7), 4)


def nation_year_mean(spark, d, lo=1995, hi=2001):
    """Mean order value per (nation, year)."""
    orders = table(spark, d, "orders").select("o_custkey", "o_orderdate", "o_totalprice")
    cust = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    return R.joined_yearly_mean(
        orders, "o_custkey", "o_orderdate", "o_totalprice", cust, "c_nationkey", lo, hi
    )


ECONOMY_BASE = """SELECT n_name AS nation, r_name AS region, lat, lon, rate1996, rate1998, rate2000, rate1998 AS colour_of
  FROM (SELECT c_nationkey,
          avg(CASE WHEN year(o_orderdate) = 1996 THEN o_totalprice END) AS rate1996,
          avg(CASE WHEN year(o_orderdate) = 1998 THEN o_totalprice END) AS rate1998,
          avg(CASE WHEN year(o_orderdate) = 2000 THEN o_totalprice END) AS rate2000
        FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1) w
  JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey
  JOIN (SELECT s_nationkey, avg(s_acctbal) AS lat, avg(s_suppkey) AS lon FROM supplier GROUP BY 1) c
    ON s_nationkey = c_nationkey
  WHERE rate1996 IS NOT NULL AND rate1998 IS NOT NULL AND rate2000 IS NOT NULL"""


@query(
    "economy_by_nation",
    f"""WITH base AS ({ECONOMY_BASE}), col AS (
        {gradient_sql('colour_of', RATE_STOPS, 'base', 'nation')})
        SELECT nation, region, round(lat + 1e-7, 4) AS lat, round(lon + 1e-7, 4) AS lon, round(rate1996 + 1e-7, 4) AS rate1996,
               round(rate1998 + 1e-7, 4) AS rate1998, round(rate2000 + 1e-7, 4) AS rate2000, argb AS argb1998
        FROM base JOIN col USING (nation)""",
)
def economy_by_nation(spark, d):
    wide = R.align_years(nation_year_mean(spark, d, 1996, 2000), "c_nationkey", [1996, 1998, 2000], "rate")
    nation = table(spark, d, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    region = table(spark, d, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    place = R.centroid(
        table(spark, d, "supplier").withColumnRenamed("s_nationkey", "c_nationkey"),
        ["c_nationkey"],
        "s_acctbal",
        "s_suppkey",
    )
    rows = wide.join(small(nation), "c_nationkey").join(small(region), "n_regionkey").join(place, "c_nationkey")
    return rows.select(
        F.col("n_name").alias("nation"),
        F.col("r_name").alias("region"),
        *[mean4(c).alias(c) for c in ("lat", "lon", "rate1996", "rate1998", "rate2000")],
        S.argb_hex(S.colour_gradient(F.col("rate1998"), RATE_STOPS)).alias("argb1998"),
    )


@query(
    "join_chain",
    """SELECT r_name, n_name, count(*) AS n, round(sum(o_totalprice), 2) AS total
       FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
       JOIN region ON n_regionkey = r_regionkey GROUP BY r_name, n_name""",
)
def join_chain(spark, d):
    orders = table(spark, d, "orders").select("o_custkey", "o_totalprice")
    # sums per customer before the joins: one row per customer reaches the shuffle
    per = orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count("*").alias("n"), F.sum("o_totalprice").alias("total")
    )
    place = (
        table(spark, d, "nation")
        .join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(F.col("n_nationkey").alias("c_nationkey"), "n_name", "r_name")
    )
    cust = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    return (
        per.join(cust, "c_custkey")
        .join(place, "c_nationkey")
        .groupBy("r_name", "n_name")
        .agg(F.sum("n").alias("n"), F.round(F.sum("total"), 2).alias("total"))
    )


@query(
    "align_years",
    """SELECT c_nationkey, round(a + 1e-7, 4) AS rate1995, round(b + 1e-7, 4) AS rate1997,
              round(c + 1e-7, 4) AS rate1999, round(e + 1e-7, 4) AS rate2001 FROM (
       SELECT c_nationkey, avg(CASE WHEN year(o_orderdate) = 1995 THEN o_totalprice END) a,
         avg(CASE WHEN year(o_orderdate) = 1997 THEN o_totalprice END) b,
         avg(CASE WHEN year(o_orderdate) = 1999 THEN o_totalprice END) c,
         avg(CASE WHEN year(o_orderdate) = 2001 THEN o_totalprice END) e
       FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1)
       WHERE a IS NOT NULL AND b IS NOT NULL AND c IS NOT NULL AND e IS NOT NULL""",
)
def align_years(spark, d):
    years = [1995, 1997, 1999, 2001]
    wide = R.align_years(nation_year_mean(spark, d), "c_nationkey", years, "rate")
    return wide.select("c_nationkey", *[mean4(f"rate{y}").alias(f"rate{y}") for y in years])


@query(
    "join_composite",
    """WITH a AS (SELECT l_partkey, l_suppkey, sum(l_quantity) AS q FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1, 2),
            r AS (SELECT l_partkey, l_suppkey, sum(l_quantity) AS q FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1, 2)
       SELECT a.l_partkey, a.l_suppkey, a.q AS qa, r.q AS qr FROM a JOIN r
       ON a.l_partkey = r.l_partkey AND a.l_suppkey = r.l_suppkey""",
)
def join_composite(spark, d):
    items = table(spark, d, "lineitem").select("l_partkey", "l_suppkey", "l_quantity", "l_returnflag")

    def side(flag, name):
        return items.filter(F.col("l_returnflag") == flag).groupBy("l_partkey", "l_suppkey").agg(
            F.sum("l_quantity").alias(name)
        )

    return side("A", "qa").join(side("R", "qr"), ["l_partkey", "l_suppkey"])


@query(
    "join_structs",
    """SELECT s_suppkey, s_name, n_nationkey, n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
)
def join_structs(spark, d):
    sup = table(spark, d, "supplier").select(F.struct("s_suppkey", "s_name", "s_nationkey").alias("_1"))
    nat = table(spark, d, "nation").select(F.struct("n_nationkey", "n_name").alias("_2"))
    both = sup.join(nat, F.col("_1.s_nationkey") == F.col("_2.n_nationkey"))
    return both.select("_1.s_suppkey", "_1.s_name", "_2.n_nationkey", "_2.n_name")


@query(
    "join_lookup_left",
    """SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'high' WHEN '2-HIGH' THEN 'high'
              WHEN '3-MEDIUM' THEN 'mid' END AS band FROM orders""",
)
def join_lookup_left(spark, d):
    bands = spark.createDataFrame(
        [("1-URGENT", "high"), ("2-HIGH", "high"), ("3-MEDIUM", "mid")], "o_orderpriority string, band string"
    )
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderpriority")
    return orders.join(small(bands), "o_orderpriority", "left").select("o_orderkey", "band")


@query(
    "join_merge",
    """SELECT c_mktsegment, o_orderpriority, sum(l_quantity) AS qty, count(*) AS n
       FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON l_orderkey = o_orderkey
       GROUP BY 1, 2""",
)
def join_merge(spark, d):
    items = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.sum("l_quantity").alias("qty"), F.count("*").alias("n")
    )
    orders = table(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"), "o_orderpriority")
    cust = table(spark, d, "customer").select("c_custkey", "c_mktsegment")
    return (
        items.join(orders, "o_orderkey")
        .join(cust, "c_custkey")
        .groupBy("c_mktsegment", "o_orderpriority")
        .agg(F.sum("qty").alias("qty"), F.sum("n").alias("n"))
    )


@query(
    "self_join_pairs",
    """SELECT p_brand, p_partkey, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) - 1 AS partners FROM part""",
)
def self_join_pairs(spark, d):
    return R.partner_ranks(table(spark, d, "part").select("p_brand", "p_partkey"), ["p_brand"], "p_partkey")


@query(
    "cross_product",
    """SELECT count(*) AS n, count(*) * count(*) AS ordered_pairs,
              cast(count(*) * (count(*) - 1) / 2 AS BIGINT) AS unordered_pairs FROM customer""",
)
def cross_product(spark, d):
    return R.pair_counts(table(spark, d, "customer"))


@query(
    "unordered_pairs",
    """SELECT l_orderkey, count(*) AS n, count(*) * count(*) AS ordered_pairs,
              cast(count(*) * (count(*) - 1) / 2 AS BIGINT) AS unordered_pairs FROM lineitem GROUP BY 1""",
)
def unordered_pairs(spark, d):
    return R.pair_counts(table(spark, d, "lineitem"), ["l_orderkey"])


@query(
    "zip_rows",
    """WITH a AS (SELECT c_custkey, row_number() OVER (ORDER BY c_acctbal, c_custkey) - 1 AS row_idx FROM customer),
            b AS (SELECT p_partkey, row_number() OVER (ORDER BY p_name, p_partkey) - 1 AS row_idx FROM part)
       SELECT row_idx, c_custkey, p_partkey FROM a JOIN b USING (row_idx)""",
)
def zip_rows(spark, d):
    a = table(spark, d, "customer").select("c_custkey", "c_acctbal")
    b = table(spark, d, "part").select("p_partkey", "p_name")
    return O.zip_rows(a, b, ["c_acctbal", "c_custkey"], ["p_name", "p_partkey"]).select(
        "row_idx", "c_custkey", "p_partkey"
    )


@query(
    "dense_key_index",
    """SELECT o_custkey, row_number() OVER (ORDER BY o_custkey) AS idx FROM (SELECT DISTINCT o_custkey FROM orders)""",
)
def dense_key_index(spark, d):
    return O.dense_index(table(spark, d, "orders"), "o_custkey")


@query(
    "affine_index_join",
    """WITH a AS (SELECT o_totalprice AS x, row_number() OVER (ORDER BY o_orderkey) - 1 AS r FROM orders),
            b AS (SELECT l_quantity AS y, row_number() OVER (ORDER BY l_shipdate, l_orderkey, l_linenumber,
                    l_partkey, l_suppkey, l_quantity) - 1 AS r FROM lineitem)
       SELECT a.r - 1 AS i, round(x * y, 2) AS product FROM a JOIN b ON b.r = 2 * (a.r - 1) + 3 WHERE a.r >= 1""",
)
def affine_index_join(spark, d):
    a = O.with_position(table(spark, d, "orders").select("o_orderkey", F.col("o_totalprice").alias("x")), ["o_orderkey"])
    order = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"]
    b = O.with_position(table(spark, d, "lineitem").select(*order), order)
    both = O.affine_join(a.select("row_idx", "x"), b.select("row_idx", F.col("l_quantity").alias("y")), (1, 1), (2, 3))
    return both.select("i", F.round(F.col("x") * F.col("y"), 2).alias("product"))

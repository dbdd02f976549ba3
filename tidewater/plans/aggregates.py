"""Grouped aggregates, pivots and set operators."""

from pyspark.sql import functions as F

from tidewater.functions import scalars as S
from tidewater.operators import relational as R
from tidewater.plans.expressions import LOG_LINE, log_lines
from tidewater.plans.joins import mean4, nation_year_mean
from tidewater.plans.registry import query
from tidewater.session import spread, table


@query(
    "avg_by_key_year",
    """SELECT o_custkey, cast(year(o_orderdate) AS INTEGER) AS year, round(avg(o_totalprice) + 1e-7, 4) AS mean_value
       FROM orders WHERE year(o_orderdate) BETWEEN 1996 AND 2000 GROUP BY 1, 2""",
)
def avg_by_key_year(spark, d):
    orders = table(spark, d, "orders").select("o_custkey", "o_orderdate", "o_totalprice")
    m = R.yearly_mean(orders, "o_custkey", F.year("o_orderdate"), "o_totalprice", 1996, 2000)
    return m.withColumn("mean_value", mean4("mean_value"))


@query(
    "centroid_by_key",
    """SELECT p_name, p_type, round(avg(p_size), 6) AS lat, round(avg(p_retailprice), 6) AS lon FROM part GROUP BY 1, 2""",
)
def centroid_by_key(spark, d):
    c = R.centroid(table(spark, d, "part"), ["p_name", "p_type"], "p_size", "p_retailprice")
    return c.select("p_name", "p_type", F.round("lat", 6).alias("lat"), F.round("lon", 6).alias("lon"))


@query("count_having", "SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1 HAVING count(*) > 2")
def count_having(spark, d):
    return table(spark, d, "orders").groupBy("o_custkey").agg(F.count("*").alias("n")).filter("n > 2")


@query(
    "word_count",
    """SELECT w AS word, count(*) AS n FROM (SELECT unnest(string_split(text, ' ')) AS w FROM documents)
       WHERE w <> '' GROUP BY 1""",
)
def word_count(spark, d):
    docs = spread(table(spark, d, "documents").select("text"))
    words = docs.select(F.explode(F.split("text", " ")).alias("word"))
    return words.filter(F.col("word") != "").groupBy("word").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "word")


@query("group_size", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def group_size(spark, d):
    return table(spark, d, "events").groupBy("event_type").agg(F.count("*").alias("n"))


HOUR_OF_DAY = "ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-06'"


def one_day(spark, d):
    """One date of the log, cut by bounds the scan can push down."""
    lo, hi = F.lit("2024-01-05").cast("timestamp_ntz"), F.lit("2024-01-06").cast("timestamp_ntz")
    return table(spark, d, "events").filter((F.col("ts") >= lo) & (F.col("ts") < hi))


def by_hour(df):
    return df.groupBy(F.hour("ts").cast("bigint").alias("h"))


@query("hourly_sum", "SELECT hour(ts) AS h, round(sum(value), 2) AS bytes FROM events GROUP BY 1")
def hourly_sum(spark, d):
    return by_hour(table(spark, d, "events")).agg(F.round(F.sum("value"), 2).alias("bytes"))


@query("hourly_distinct", "SELECT hour(ts) AS h, count(DISTINCT user_id) AS users FROM events GROUP BY 1")
def hourly_distinct(spark, d):
    return by_hour(table(spark, d, "events")).agg(F.countDistinct("user_id").alias("users"))


@query("hourly_traffic", f"SELECT hour(ts) AS h, count(*) AS n FROM events WHERE {HOUR_OF_DAY} GROUP BY 1")
def hourly_traffic(spark, d):
    return by_hour(one_day(spark, d)).agg(F.count("*").alias("n"))


@query(
    "group_keys",
    """SELECT k, count(event_id) AS n FROM (SELECT DISTINCT event_type AS k FROM events) g
       LEFT JOIN (SELECT * FROM events WHERE event_type = 'click') e ON e.event_type = g.k GROUP BY 1""",
)
def group_keys(spark, d):
    ev = table(spark, d, "events")
    keys = ev.select(F.col("event_type").alias("k")).distinct()
    one = ev.filter(F.col("event_type") == "click").groupBy(F.col("event_type").alias("k")).agg(F.count("*").alias("n"))
    return keys.join(one, "k", "left").na.fill(0, ["n"])


@query("distinct_values", "SELECT DISTINCT p_brand, p_type FROM part")
def distinct_values(spark, d):
    return table(spark, d, "part").select("p_brand", "p_type").distinct()


@query(
    "link_adjacency",
    r"""WITH e AS (SELECT DISTINCT regexp_extract(url, '^https?://([^/]*)', 1) AS src,
               unnest(regexp_extract_all(html, '<a href="([^"]*)">', 1)) AS dst FROM pages)
        SELECT src, 0::BIGINT AS chunk, count(*) AS n_links, string_agg(dst, ' ' ORDER BY dst) AS links FROM e WHERE dst <> '' GROUP BY 1""",
)
def link_adjacency(spark, d):
    links = F.regexp_extract_all("html", F.lit('<a href="([^"]*)">'), F.lit(1))
    edges = (
        table(spark, d, "pages")
        .select(F.regexp_extract("url", "^https?://([^/]*)", 1).alias("src"), F.explode(links).alias("dst"))
        .filter(F.col("dst") != "")
    )
    return R.adjacency(edges, "src", "dst").withColumn("links", F.array_join("links", " "))


@query(
    "global_count",
    """SELECT (SELECT count(*) FROM lineitem) AS n, (SELECT count(*) FROM lineitem) AS n_by_sum,
       (SELECT sum(length(text) - length(replace(text, chr(10), '')) + 1)::BIGINT FROM documents) AS n_lines""",
)
def global_count(spark, d):
    counts = table(spark, d, "lineitem").agg(F.count("*").alias("n"), F.sum(F.lit(1)).alias("n_by_sum"))
    lines = table(spark, d, "documents").agg(F.sum(F.size(F.split("text", "\n", -1)).cast("bigint")).alias("n_lines"))
    return counts.withColumn("n_lines", lines.scalar())


@query(
    "global_extent",
    """SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi,
       (SELECT max(len(string_split(text, ' ')))::BIGINT FROM documents) AS widest FROM orders""",
)
def global_extent(spark, d):
    ext = table(spark, d, "orders").agg(F.min("o_totalprice").alias("lo"), F.max("o_totalprice").alias("hi"))
    wide = table(spark, d, "documents").agg(F.max(F.size(F.split("text", " "))).cast("bigint").alias("widest"))
    return ext.withColumn("widest", wide.scalar())


@query(
    "vector_row_stats",
    """SELECT vec_id, round(list_sum(list_transform(embedding, lambda x: x::DOUBLE)), 6) AS total,
              round(list_max(embedding)::DOUBLE, 6) AS hi, round(list_min(embedding)::DOUBLE, 6) AS lo FROM embeddings""",
)
def vector_row_stats(spark, d):
    total = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double"))
    return table(spark, d, "embeddings").select(
        "vec_id",
        F.round(total, 6).alias("total"),
        F.round(F.array_max("embedding").cast("double"), 6).alias("hi"),
        F.round(F.array_min("embedding").cast("double"), 6).alias("lo"),
    )


@query(
    "vector_col_stats",
    """WITH e AS (SELECT unnest(range(len(embedding)))::INTEGER AS pos, unnest(embedding)::DOUBLE AS x FROM embeddings)
       SELECT pos, round(sum(x), 6) AS total, round(max(x), 6) AS hi, round(min(x), 6) AS lo FROM e GROUP BY 1""",
)
def vector_col_stats(spark, d):
    s = R.column_vector_stats(table(spark, d, "embeddings"), "embedding")
    return s.select("pos", *[F.round(F.col(c).cast("double"), 6).alias(c) for c in ("total", "hi", "lo")])


@query(
    "merge_moments",
    """SELECT l_returnflag, count(*) AS n, round(avg(l_quantity), 6) AS mean, round(var_pop(l_quantity), 6) AS var_pop
       FROM lineitem GROUP BY 1""",
)
def merge_moments(spark, d):
    # summaries per (flag, status, line) are merged into one per flag
    parts = table(spark, d, "lineitem").groupBy("l_returnflag", "l_linestatus", "l_linenumber").agg(
        F.count("*").alias("n"), F.avg("l_quantity").alias("mean"), F.var_pop("l_quantity").alias("var_pop")
    )
    m = R.merge_moments(parts, ["l_returnflag"])
    return m.select("l_returnflag", "n", F.round("mean", 6).alias("mean"), F.round("var_pop", 6).alias("var_pop"))


@query("contingency", "SELECT p_brand, p_type, count(*) AS n FROM part GROUP BY 1, 2")
def contingency(spark, d):
    return table(spark, d, "part").groupBy("p_brand", "p_type").agg(F.count("*").alias("n"))


@query(
    "field_frequency",
    f"SELECT replace(split_part({LOG_LINE}, ' ', 7), '\"', '') AS field, count(*) AS n FROM events GROUP BY 1",
)
def field_frequency(spark, d):
    field = F.replace(S.part_at(F.col("line"), " ", 6), F.lit('"'), F.lit(""))
    return (
        log_lines(spark, d).groupBy(field.alias("field")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "field")
    )


@query(
    "runs_mean_sd",
    """SELECT l_returnflag, round(avg(l_discount), 6) AS mean, round(stddev_samp(l_discount), 6) AS sd
       FROM lineitem GROUP BY 1""",
)
def runs_mean_sd(spark, d):
    return table(spark, d, "lineitem").groupBy("l_returnflag").agg(
        F.round(F.avg("l_discount"), 6).alias("mean"), F.round(F.stddev_samp("l_discount"), 6).alias("sd")
    )


@query(
    "pivot_wide",
    """SELECT user_id, round(max(value) FILTER (event_type = 'click'), 2) AS click,
       round(max(value) FILTER (event_type = 'view'), 2) AS view,
       round(max(value) FILTER (event_type = 'purchase'), 2) AS purchase FROM events GROUP BY 1""",
)
def pivot_wide(spark, d):
    kinds = ["click", "view", "purchase"]
    return (
        table(spark, d, "events").groupBy("user_id").pivot("event_type", kinds).agg(F.round(F.max("value"), 2))
    )


@query(
    "mode_share",
    """WITH c AS (SELECT o_custkey, o_orderpriority, count(*) AS n FROM orders GROUP BY 1, 2),
       r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY n DESC, o_orderpriority) AS k,
             sum(n) OVER (PARTITION BY o_custkey) AS t FROM c)
       SELECT o_custkey, o_orderpriority AS mode, round(n / t, 6) AS share FROM r WHERE k = 1""",
)
def mode_share(spark, d):
    m = R.mode_share(table(spark, d, "orders"), ["o_custkey"], "o_orderpriority")
    return m.withColumn("share", F.round("share", 6))


@query(
    "union_years",
    """SELECT c_nationkey, y AS year, round(avg(o_totalprice) + 1e-7, 4) AS value FROM (
       SELECT c_nationkey, year(o_orderdate)::INTEGER AS y, o_totalprice FROM orders JOIN customer ON o_custkey = c_custkey)
       WHERE y IN (1996, 1998, 2000) GROUP BY 1, 2""",
)
def union_years(spark, d):
    years = [1996, 1998, 2000]
    wide = R.align_years(nation_year_mean(spark, d, 1996, 2000), "c_nationkey", years, "rate")
    return R.union_years(wide, "c_nationkey", "rate", years).withColumn("value", mean4("value"))


@query(
    "union_fill",
    """SELECT 'customer' AS kind, c_custkey AS id, c_acctbal AS acctbal, c_mktsegment AS segment FROM customer
       UNION ALL SELECT 'supplier', s_suppkey, s_acctbal, NULL FROM supplier""",
)
def union_fill(spark, d):
    cust = table(spark, d, "customer").select(
        F.lit("customer").alias("kind"),
        F.col("c_custkey").alias("id"),
        F.col("c_acctbal").alias("acctbal"),
        F.col("c_mktsegment").alias("segment"),
    )
    sup = table(spark, d, "supplier").select(
        F.lit("supplier").alias("kind"), F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("acctbal")
    )
    return cust.unionByName(sup, allowMissingColumns=True)

"""Windows, sorts, limits, samples and splits."""

from pyspark.sql import functions as F

from tidewater.operators import ordered as O
from tidewater.operators import sampling as P
from tidewater.plans.registry import query
from tidewater.session import table

HASH = "('0x' || substr(md5({id}::VARCHAR || ':{seed}'), 1, 8))::BIGINT"


def hash_sql(id_col: str, seed: int) -> str:
    return HASH.format(id=id_col, seed=seed)


@query(
    "running_score",
    """SELECT user_id, event_id, round(sum(CASE WHEN event_type IN ('click', 'purchase') THEN 1 ELSE -0.8 END)
       OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)::DOUBLE, 4) AS score FROM events""",
)
def running_score(spark, d):
    ev = table(spark, d, "events").select("user_id", "event_id", "ts", "event_type")
    hit = F.col("event_type").isin("click", "purchase")
    out = O.running_score(ev, ["user_id"], ["ts", "event_id"], hit)
    return out.select("user_id", "event_id", F.round("score", 4).alias("score"))


@query(
    "stacked_segments",
    """WITH g AS (SELECT l_linenumber AS category, l_returnflag AS series, sum(l_quantity) AS v FROM lineitem GROUP BY 1, 2),
       s AS (SELECT *, sum(v) OVER (PARTITION BY category ORDER BY series ROWS UNBOUNDED PRECEDING) AS hi FROM g)
       SELECT category, series, v, hi - v AS lo, hi FROM s""",
)
def stacked_segments(spark, d):
    items = table(spark, d, "lineitem").select(
        F.col("l_linenumber").alias("category"), F.col("l_returnflag").alias("series"), "l_quantity"
    )
    return O.stacked_segments(items, "category", "series", "l_quantity")


@query(
    "line_runs",
    """WITH p AS (SELECT user_id, event_id, event_type, ts, lag(event_type) OVER w AS pt, lag(event_id) OVER w AS pe
                  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
       r AS (SELECT *, sum(CASE WHEN pt <> event_type THEN 1 ELSE 0 END)
               OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)::BIGINT AS run FROM p)
       SELECT user_id, run, event_id, event_type, false AS carried FROM r
       UNION ALL SELECT user_id, run, pe, pt, true FROM r WHERE pt <> event_type""",
)
def line_runs(spark, d):
    ev = table(spark, d, "events").select("user_id", "ts", "event_id", "event_type")
    return O.line_runs(ev, ["user_id"], ["ts", "event_id"], "event_type").drop("ts")


@query(
    "bin_edges",
    """WITH b AS (SELECT DISTINCT p_type, p_retailprice AS c FROM part),
       n AS (SELECT *, lag(c) OVER w AS p, lead(c) OVER w AS q FROM b WINDOW w AS (PARTITION BY p_type ORDER BY c))
       SELECT p_type, c AS centre, round(coalesce((c + p) / 2, c - (q - c) / 2), 6) AS lo,
              round(coalesce((c + q) / 2, c + (c - p) / 2), 6) AS hi FROM n""",
)
def bin_edges(spark, d):
    bins = table(spark, d, "part").select("p_type", F.col("p_retailprice").alias("centre")).distinct()
    e = O.bin_edges(bins, "p_type", "centre")
    return e.select("p_type", "centre", F.round("lo", 6).alias("lo"), F.round("hi", 6).alias("hi"))


@query(
    "sort_desc",
    "SELECT p_brand, count(*) AS n, round(sum(p_retailprice), 2) AS total FROM part GROUP BY 1 ORDER BY n DESC, p_brand",
)
def sort_desc(spark, d):
    g = table(spark, d, "part").groupBy("p_brand")
    return g.agg(F.count("*").alias("n"), F.round(F.sum("p_retailprice"), 2).alias("total")).orderBy(F.desc("n"), "p_brand")


@query("limit_n", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 10")
def limit_n(spark, d):
    return table(spark, d, "orders").select("o_orderkey", "o_totalprice").orderBy("o_orderkey").limit(10)


@query(
    "top_k",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 3",
)
def top_k(spark, d):
    return table(spark, d, "orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(3)


@query(
    "slice_rows",
    """SELECT event_id, event_type FROM (SELECT *, row_number() OVER (ORDER BY ts, event_id) AS r FROM events)
       WHERE r BETWEEN 10 AND 20""",
)
def slice_rows(spark, d):
    ev = table(spark, d, "events").select("event_id", "event_type", "ts")
    return O.row_slice(ev, ["ts", "event_id"], 10, 20).select("event_id", "event_type")


@query(
    "shuffle_hash",
    f"""SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY {hash_sql('o_orderkey', 7)}, o_orderkey) - 1 AS place FROM orders""",
)
def shuffle_hash(spark, d):
    mixed = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    mixed = mixed.withColumn("h", P.seeded_hash(F.col("o_orderkey"), 7))
    return O.with_position(mixed, ["h", "o_orderkey"], "place").drop("h")


@query(
    "split_exact",
    f"""WITH r AS (SELECT o_orderkey, row_number() OVER (ORDER BY {hash_sql('o_orderkey', 11)}, o_orderkey) AS k,
             count(*) OVER () AS n FROM orders)
        SELECT o_orderkey, k <= ceil(round(0.8 * n, 6)) AS is_train FROM r""",
)
def split_exact(spark, d):
    return P.split_counted(table(spark, d, "orders").select("o_orderkey"), "o_orderkey", 11, 0.8, rounding="ceil")


@query(
    "split_stratified",
    f"""WITH r AS (SELECT c_custkey, c_mktsegment, row_number() OVER (PARTITION BY c_mktsegment
             ORDER BY {hash_sql('c_custkey', 5)}, c_custkey) AS k,
             count(*) OVER (PARTITION BY c_mktsegment) AS n FROM customer)
        SELECT c_custkey, c_mktsegment, k <= floor(round(0.8 * n, 6)) AS is_train FROM r""",
)
def split_stratified(spark, d):
    cust = table(spark, d, "customer").select("c_custkey", "c_mktsegment")
    return P.split_counted(cust, "c_custkey", 5, 0.8, ["c_mktsegment"])


@query(
    "sample_fraction",
    f"SELECT o_orderkey FROM orders WHERE {hash_sql('o_orderkey', 42)} < cast(floor(0.1 * 4294967296) AS BIGINT)",
)
def sample_fraction(spark, d):
    return P.sampled(table(spark, d, "orders").select("o_orderkey"), "o_orderkey", 42, 0.1)


@query(
    "sample_keys",
    f"""SELECT event_id, user_id FROM events WHERE user_id IN (
        SELECT user_id FROM (SELECT DISTINCT user_id FROM events) ORDER BY {hash_sql('user_id', 3)}, user_id LIMIT 20)""",
)
def sample_keys(spark, d):
    return P.sample_keys(table(spark, d, "events").select("event_id", "user_id"), "user_id", 20, 3)


@query(
    "sample_stride",
    """SELECT event_id, k AS row_idx FROM (SELECT event_id, row_number() OVER (ORDER BY ts, event_id) - 1 AS k FROM events)
       WHERE k % 100 = 0""",
)
def sample_stride(spark, d):
    ev = table(spark, d, "events").select("ts", "event_id")
    return O.with_position(ev, ["ts", "event_id"]).filter("row_idx % 100 = 0").select("event_id", "row_idx")


@query(
    "split_tail_holdout",
    """SELECT o_orderkey, k >= (n // 4000) * 4000 AS is_holdout FROM (
       SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS k, count(*) OVER () AS n FROM orders)""",
)
def split_tail_holdout(spark, d):
    return P.tail_holdout(table(spark, d, "orders").select("o_orderkey"), "o_orderkey", 4000)


@query(
    "fold_assign",
    f"SELECT doc_id, cast(floor({hash_sql('doc_id', 17)} * 10 / 4294967296.0) AS INTEGER) AS fold FROM documents",
)
def fold_assign(spark, d):
    return table(spark, d, "documents").select("doc_id", P.fold_of(F.col("doc_id"), 17, 10).alias("fold"))

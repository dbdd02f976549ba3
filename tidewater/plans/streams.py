"""Streaming queries.

A table is cut into slices by time or key; each slice is laid down as files and
the stream takes it in, so state and checkpoints carry across several runs.
"""

from pyspark.sql import functions as F

from tidewater.functions import words as X
from tidewater.operators.ordered import with_position
from tidewater.operators import bayes as B
from tidewater.operators.sampling import fold_of
from tidewater.plans.bayesian import embeddings_rounds
from tidewater.plans.ordering import hash_sql
from tidewater.plans.registry import query
from tidewater.session import scratch_path, table
from tidewater.streaming import flows

SLICES = 3


def slices(df, column):
    """The rows in SLICES parts by the value of a column, in order; nulls come first."""
    cuts = df.approxQuantile(column, [i / SLICES for i in range(1, SLICES)], 0.001)
    edges = [None, *cuts, None]
    for lo, hi in zip(edges, edges[1:]):
        above = F.lit(True) if lo is None else F.col(column) >= lo
        below = F.lit(True) if hi is None else F.col(column) < hi
        inside = above & below
        yield df.filter(inside | F.col(column).isNull() if lo is None else inside)


def messages(spark, d):
    """Events as JSON messages; views carry no text."""
    ev = table(spark, d, "events")
    text = F.when(F.col("event_type") != "view", F.concat(F.lit("got "), "event_type", F.lit(" by "), F.col("user_id").cast("string")))
    return ev.select("event_id", F.to_json(F.struct("event_id", "value", text.alias("text"))).alias("value"))


@query(
    "stream_source",
    """SELECT event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1""",
)
def stream_source(spark, d):
    src, sink, mark = (scratch_path(spark, n) for n in ("arrivals", "sink", "mark"))
    ev = table(spark, d, "events").select("event_id", "event_type", "value")
    for part in slices(ev, "event_id"):
        part.write.mode("append").parquet(src)
        # one run per arrival: each picks up where the checkpoint left off
        flows.drain(flows.file_stream(spark, src, "event_id bigint, event_type string, value double", files_per_trigger=8), sink, mark)
    back = spark.read.schema("event_id bigint, event_type string, value double").parquet(sink)
    return back.groupBy("event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"))


def click_score(df):
    """A rule in place of a stored model: share of positive words."""
    good = F.size(F.filter(X.words(F.col("text")), lambda w: w.isin("click", "purchase", "signup")))
    bad = F.size(F.filter(X.words(F.col("text")), lambda w: w.isin("error", "got")))
    share = good / (good + bad)
    return df.withColumn("label", F.when(share >= 0.5, "pos").otherwise("neg")).withColumn(
        "confidence", F.greatest(share, 1 - share)
    )


@query(
    "stream_filter_append",
    """SELECT event_id, 'neg' AS label, 1.0::DOUBLE AS confidence FROM events WHERE event_type = 'error'""",
)
def stream_filter_append(spark, d):
    src, sink, mark = (scratch_path(spark, n) for n in ("arrivals", "sink", "mark"))
    for part in slices(messages(spark, d), "event_id"):
        part.select("value").write.mode("append").text(src)
        stream = spark.readStream.text(src)
        kept = flows.confident(stream, "value", "text", click_score, 0.7)
        flows.drain(
            kept.select(F.get_json_object("value", "$.event_id").cast("bigint").alias("event_id"), "label", "confidence"), sink, mark
        )
    return spark.read.schema("event_id bigint, label string, confidence double").parquet(sink)


@query(
    "stream_running_score",
    """SELECT user_id, event_id, row_number() OVER w AS n, round((sum(CASE WHEN event_type IN ('click', 'purchase') THEN 1 ELSE -0.8 END)
       OVER w)::DOUBLE, 4) AS score FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)""",
)
def stream_running_score(spark, d):
    src, sink, mark = (scratch_path(spark, n) for n in ("arrivals", "sink", "mark"))
    ev = table(spark, d, "events").select("event_id", "ts", "user_id", "event_type")
    ev = ev.withColumn("us", F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col("ts"))).drop("ts")
    schema = "event_id bigint, user_id bigint, event_type string, us bigint"
    for part in slices(ev, "us"):
        part.write.mode("append").parquet(src)
        hit = F.col("event_type").isin("click", "purchase")
        scored = flows.running_score(flows.file_stream(spark, src, schema), "user_id", ["us", "event_id"], hit)
        flows.drain(scored, sink, mark)
    back = spark.read.schema(f"user_id bigint, {flows.SCORE_SCHEMA}").parquet(sink)
    return back.withColumn("score", F.round("score", 4))


STREAM_ROUNDS_SQL = f"""o AS (SELECT o_orderpriority AS label, o_totalprice, o_custkey::DOUBLE AS o_custkey,
    (row_number() OVER (ORDER BY o_orderkey) - 1) * {SLICES} // (count(*) OVER ()) AS rnd FROM orders),
  x AS (SELECT label, rnd, unnest([0, 1])::INTEGER AS feature, unnest([o_totalprice, o_custkey]) AS v FROM o),
  r AS (SELECT DISTINCT rnd AS round FROM o)"""


@query(
    "stream_gnb_update",
    f"""WITH {STREAM_ROUNDS_SQL} SELECT round, label, feature, count(*) AS n, round(avg(v), 4) AS mean,
        round(var_pop(v) / 1e6, 4) AS var_pop FROM x JOIN r ON rnd <= round GROUP BY 1, 2, 3""",
)
def stream_gnb_update(spark, d):
    src, store, mark = (scratch_path(spark, n) for n in ("arrivals", "store", "mark"))
    orders = table(spark, d, "orders").select("o_orderkey", F.col("o_orderpriority").alias("label"), "o_totalprice", "o_custkey")
    placed = with_position(orders, ["o_orderkey"])
    n = placed.count()
    schema = "label string, o_totalprice double, o_custkey bigint"
    for r in range(SLICES):
        part = placed.filter(F.floor(F.col("row_idx") * SLICES / F.lit(n)) == r)
        part.select("label", "o_totalprice", "o_custkey").write.mode("append").parquet(src)
        flows.train_on_stream(flows.file_stream(spark, src, schema), "label", ["o_totalprice", "o_custkey"], store, mark)
    m = flows.stored_rounds(spark, store)
    return m.select(
        "round", "label", "feature", "n", F.round("mean", 4).alias("mean"), F.round(F.col("var_pop") / 1e6, 4).alias("var_pop")
    )


ROUND_COUNT = 4


@query(
    "eval_rounds",
    f"""WITH e AS (SELECT *, (row_number() OVER (ORDER BY vec_id) - 1) * {ROUND_COUNT} // (count(*) OVER ()) AS rnd,
            floor({hash_sql('vec_id', 41)} * 10 / 4294967296.0) >= 8 AS held FROM embeddings),
        x AS (SELECT vec_id, label, rnd, held, unnest(embedding)::DOUBLE AS v, unnest(range(len(embedding))) AS f FROM e),
        r AS (SELECT DISTINCT rnd AS round FROM e WHERE NOT held),
        p AS (SELECT round, label AS cls, f, avg(v) AS m, var_pop(v) AS w, count(*) AS n FROM x JOIN r ON rnd <= round AND NOT held GROUP BY 1, 2, 3),
        q AS (SELECT round, cls, ln(any_value(n) / any_value(t)) AS prior FROM p
              JOIN (SELECT round, sum(n) AS t FROM p WHERE f = 0 GROUP BY 1) USING (round) GROUP BY 1, 2),
        s AS (SELECT vec_id, label, rnd, round, cls, sum(-0.5 * ln(2 * pi() * w) - 0.5 * (v - m) * (v - m) / w) AS ll
              FROM x JOIN p USING (f) WHERE held GROUP BY ALL),
        b AS (SELECT s.*, row_number() OVER (PARTITION BY vec_id, round ORDER BY ll + prior DESC, cls) AS k FROM s JOIN q USING (round, cls)),
        h AS (SELECT round, rnd, (cls = label)::INTEGER AS hit FROM b WHERE k = 1)
        SELECT round, 'global' AS scope, count(*) AS n, round(avg(hit), 6) AS accuracy FROM h GROUP BY 1
        UNION ALL SELECT round, 'round', count(*), round(avg(hit), 6) FROM h WHERE rnd = round GROUP BY 1""",
)
def eval_rounds(spark, d):
    """Accuracy of every round's model on the rows held out from all rounds."""
    rows = embeddings_rounds(spark, d, ROUND_COUNT)
    held = fold_of(F.col("vec_id"), 41, 10) >= 8
    a = B.round_accuracy(rows.filter(~held), rows.filter(held), "rnd", "label", "embedding")
    return a.withColumn("accuracy", F.round("accuracy", 6))

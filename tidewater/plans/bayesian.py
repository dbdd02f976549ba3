"""Naive Bayes queries over embeddings, parts, orders and labelled documents."""

from pyspark.sql import functions as F

from tidewater.functions import words as X
from tidewater.operators import bayes as B
from tidewater.operators.ordered import with_position
from tidewater.operators.sampling import fold_of
from tidewater.plans.ordering import hash_sql
from tidewater.plans.registry import query
from tidewater.plans.texts import WORDS_SQL
from tidewater.session import scratch_path, settle, spread, table

CELLS_SQL = """x AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS v, unnest(range(len(embedding)))::INTEGER AS feature
  FROM embeddings),
p AS (SELECT label, feature, count(*) AS n, avg(v) AS mean, var_pop(v) AS var_pop FROM x GROUP BY 1, 2),
pr AS (SELECT label, ln(count(*) / (SELECT count(*) FROM embeddings)) AS log_prior FROM embeddings GROUP BY 1)"""


@query(
    "class_moments",
    f"WITH {CELLS_SQL} SELECT label, feature, n, round(mean, 6) AS mean, round(var_pop, 6) AS var_pop FROM p",
)
def class_moments(spark, d):
    m = B.class_moments(table(spark, d, "embeddings"), "label", "embedding")
    return m.select("label", "feature", "n", F.round("mean", 6).alias("mean"), F.round("var_pop", 6).alias("var_pop"))


def gaussian_params(spark, d):
    return B.with_prior(B.class_moments(table(spark, d, "embeddings"), "label", "embedding"))


@query(
    "gnb_train",
    f"""WITH {CELLS_SQL} SELECT label, feature, round(mean, 6) AS mean, round(var_pop, 6) AS var_pop,
        round(log_prior, 6) AS log_prior FROM p JOIN pr USING (label)""",
)
def gnb_train(spark, d):
    return gaussian_params(spark, d).select(
        "label", "feature", *[F.round(c, 6).alias(c) for c in ("mean", "var_pop", "log_prior")]
    )


GNB_SCORES = f"""{CELLS_SQL},
s AS (SELECT vec_id, p.label, sum(-0.5 * ln(2 * pi() * var_pop) - 0.5 * (v - mean) * (v - mean) / var_pop) AS ll
  FROM x JOIN p USING (feature) GROUP BY 1, 2),
b AS (SELECT vec_id, s.label AS predicted, ll + log_prior AS score,
  row_number() OVER (PARTITION BY vec_id ORDER BY ll + log_prior DESC, s.label) AS k FROM s JOIN pr ON pr.label = s.label)"""


def gnb_predictions(spark, d):
    model = B.GaussianScorer(gaussian_params(spark, d))
    emb = table(spark, d, "embeddings")
    scored = emb.select("vec_id", "label", model.score_column(F.col("embedding")).alias("scores"))
    return scored.withColumn("predicted", model.argmax(F.col("scores")))


@query("gnb_predict", f"WITH {GNB_SCORES} SELECT vec_id, predicted, round(score, 4) AS score FROM b WHERE k = 1")
def gnb_predict(spark, d):
    return gnb_predictions(spark, d).select(
        "vec_id", F.col("predicted").cast("int").alias("predicted"), F.round(F.array_max("scores"), 4).alias("score")
    )


ORDER_PARTS = """SELECT o_orderstatus AS label, unnest([0, 1])::INTEGER AS feature,
  unnest([o_totalprice, o_custkey::DOUBLE]) AS v FROM orders"""


def order_features(spark, d):
    return table(spark, d, "orders").select(
        F.col("o_orderstatus").alias("label"),
        F.year("o_orderdate").alias("part"),
        F.array("o_totalprice", F.col("o_custkey").cast("double")).alias("features"),
    )


@query(
    "gnb_partial_fit",
    f"""WITH x AS ({ORDER_PARTS}) SELECT label, feature, count(*) AS n, round(avg(v), 4) AS mean,
        round(var_pop(v) / 1e6, 4) AS var_pop FROM x GROUP BY 1, 2""",
)
def gnb_partial_fit(spark, d):
    # stored statistics of the old rows, merged with those of the new rows
    rows = order_features(spark, d)
    path = scratch_path(spark, "stats")
    B.class_moments(rows.filter("part < 1999"), "label", "features").write.parquet(path)
    fresh = B.class_moments(rows.filter("part >= 1999"), "label", "features")
    stored = spark.read.schema(fresh.schema).parquet(path)
    m = B.merge_stats(stored.unionByName(fresh))
    return m.select(
        "label", "feature", "n", F.round("mean", 4).alias("mean"), F.round(F.col("var_pop") / 1e6, 4).alias("var_pop")
    )


@query(
    "gnb_stats_store",
    f"""WITH x AS ({ORDER_PARTS}), t AS (SELECT count(*) AS t FROM orders)
        SELECT label, feature, count(*) AS n, round(ln(count(*) / any_value(t)), 6) AS log_prior, round(avg(v), 4) AS mean,
        round(var_pop(v) / 1e6, 4) AS var_pop FROM x, t GROUP BY 1, 2""",
)
def gnb_stats_store(spark, d):
    stats = B.with_prior(B.class_moments(order_features(spark, d), "label", "features"))
    path = scratch_path(spark, "stats")
    stats.write.parquet(path)
    back = spark.read.schema(stats.schema).parquet(path)
    return back.select(
        "label", "feature", "n", F.round("log_prior", 6).alias("log_prior"),
        F.round("mean", 4).alias("mean"), F.round(F.col("var_pop") / 1e6, 4).alias("var_pop"),
    )


ROUND_SIZE = 3000
ROUNDS_SQL = f"""o AS (SELECT o_orderpriority AS label, o_totalprice, o_custkey::DOUBLE AS o_custkey,
    (row_number() OVER (ORDER BY o_orderkey) - 1) // {ROUND_SIZE} AS rnd FROM orders),
  x AS (SELECT label, rnd, unnest([0, 1])::INTEGER AS feature, unnest([o_totalprice, o_custkey]) AS v FROM o),
  r AS (SELECT DISTINCT rnd AS round FROM o)"""


def order_rounds(spark, d):
    orders = table(spark, d, "orders").select(
        "o_orderkey", F.col("o_orderpriority").alias("label"), "o_totalprice", F.col("o_custkey").cast("double").alias("o_custkey")
    )
    return with_position(orders, ["o_orderkey"]).withColumn("rnd", F.floor(F.col("row_idx") / ROUND_SIZE))


@query(
    "gnb_rounds",
    f"""WITH {ROUNDS_SQL} SELECT round, label, feature, count(*) AS n, round(avg(v), 4) AS mean,
        round(var_pop(v) / 1e6, 4) AS var_pop FROM x JOIN r ON rnd <= round GROUP BY 1, 2, 3""",
)
def gnb_rounds(spark, d):
    m = B.round_moments(order_rounds(spark, d), "rnd", "label", ["o_totalprice", "o_custkey"])
    return m.select(
        "round", "label", "feature", "n", F.round("mean", 4).alias("mean"),
        F.round(F.col("var_pop") / 1e6, 4).alias("var_pop"),
    )


def embeddings_rounds(spark, d, rounds=4):
    """Embeddings with a round number by position."""
    placed = with_position(table(spark, d, "embeddings").select("vec_id", "embedding", "label"), ["vec_id"])
    n = placed.count()
    return placed.withColumn("rnd", F.floor(F.col("row_idx") * rounds / F.lit(n)))


# -------------------------------------------------------------- categorical

CATS_SQL = """c AS (SELECT p_partkey, p_type AS label,
    unnest([p_brand, split_part(p_name, ' ', 1), split_part(p_name, ' ', 2)]) AS value FROM part),
  n AS (SELECT label, value, count(*) AS n FROM c GROUP BY 1, 2),
  s AS (SELECT p_type AS label, count(*) AS size FROM part GROUP BY 1),
  v AS (SELECT count(DISTINCT value) AS voc FROM c),
  t AS (SELECT sum(size) AS total FROM s)"""


def part_rows(spark, d):
    return table(spark, d, "part").select(
        "p_partkey",
        F.col("p_type").alias("label"),
        F.concat(F.array("p_brand"), F.split("p_name", " ")).alias("cats"),
        F.array(F.col("p_size").cast("double"), "p_retailprice").alias("nums"),
    )


@query(
    "cnb_train",
    f"""WITH {CATS_SQL} SELECT label, value, n, round(ln((n + 1) / (size + voc)), 6) AS log_p
        FROM n JOIN s USING (label), v""",
)
def cnb_train(spark, d):
    return B.CategoricalModel(part_rows(spark, d), "label", "cats").table().withColumn("log_p", F.round("log_p", 6))


CNB_SCORES = f"""{CATS_SQL},
  cs AS (SELECT c.p_partkey, s.label, sum(ln((coalesce(n.n, 0) + 1) / (size + voc))) AS cat, any_value(ln(size / total)) AS prior
    FROM (SELECT p_partkey, value FROM c) c CROSS JOIN s CROSS JOIN v CROSS JOIN t
    LEFT JOIN n ON n.label = s.label AND n.value = c.value GROUP BY 1, 2)"""


@query(
    "cnb_predict",
    f"""WITH {CNB_SCORES}, b AS (SELECT *, row_number() OVER (PARTITION BY p_partkey ORDER BY cat + prior DESC, label) AS k FROM cs)
        SELECT p_partkey, label AS predicted, round(cat + prior, 6) AS score FROM b WHERE k = 1""",
)
def cnb_predict(spark, d):
    rows = part_rows(spark, d)
    model = B.CategoricalModel(rows, "label", "cats")
    s = model.score(rows, "p_partkey", "cats")
    # scores equal up to the last bits are ties
    flat = F.transform("scores", lambda x: F.round(x, 9))
    return s.select(
        "p_partkey", B.best_label(flat, model.labels).alias("predicted"), F.round(F.array_max("scores"), 6).alias("score")
    )


@query(
    "mixed_nb",
    f"""WITH {CNB_SCORES},
       x AS (SELECT p_partkey, p_type AS label, unnest([0, 1]) AS f, unnest([p_size::DOUBLE, p_retailprice]) AS v FROM part),
       g AS (SELECT label, f, avg(v) AS m, var_pop(v) AS w FROM x GROUP BY 1, 2),
       gs AS (SELECT x.p_partkey, g.label, sum(-0.5 * ln(2 * pi() * w) - 0.5 * (v - m) * (v - m) / w) AS num
              FROM (SELECT p_partkey, f, v FROM x) x JOIN g USING (f) GROUP BY 1, 2),
       b AS (SELECT *, row_number() OVER (PARTITION BY p_partkey ORDER BY cat + prior + num DESC, label) AS k
             FROM cs JOIN gs USING (p_partkey, label))
       SELECT p_partkey, label AS predicted, round(cat + prior + num, 6) AS score FROM b WHERE k = 1""",
)
def mixed_nb(spark, d):
    rows = part_rows(spark, d)
    cat = B.CategoricalModel(rows, "label", "cats")
    gauss = B.GaussianScorer(B.with_prior(B.class_moments(rows, "label", "nums")))
    # the class prior enters once, with the categorical part
    num = rows.select("p_partkey", gauss.score_column(F.col("nums"), prior=False).alias("num"))
    both = cat.score(rows, "p_partkey", "cats").join(num, "p_partkey")
    total = F.zip_with("scores", "num", lambda a, b: a + b)
    return both.select(
        "p_partkey", B.best_label(total, cat.labels).alias("predicted"), F.round(F.array_max(total), 6).alias("score")
    )


@query("gnb_compare")
def gnb_compare(spark, d):
    """Own Gaussian model beside the library's, on the same rows."""
    from pyspark.ml.classification import NaiveBayes
    from pyspark.ml.functions import array_to_vector

    own = gnb_predictions(spark, d).select("vec_id", "label", F.col("predicted").cast("int").alias("own"))
    feats = table(spark, d, "embeddings").select(
        "vec_id", F.col("label").cast("double").alias("label"),
        array_to_vector(F.transform("embedding", lambda x: x.cast("double"))).alias("features"),
    )
    lib = NaiveBayes(modelType="gaussian").fit(feats).transform(feats).select("vec_id", F.col("prediction").cast("int").alias("library"))
    return own.join(lib, "vec_id").groupBy("label").agg(
        F.count("*").alias("n"),
        F.avg((F.col("own") == F.col("label")).cast("int")).alias("own_accuracy"),
        F.avg((F.col("library") == F.col("label")).cast("int")).alias("library_accuracy"),
        F.avg((F.col("own") == F.col("library")).cast("int")).alias("agreement"),
    )


# ------------------------------------------------------------ word presence

VOCABULARY = 5000
DOCS_SQL = f"""d AS (SELECT doc_id, quality AS label, text, {hash_sql('doc_id', 23)} < 3435973837 AS is_train
    FROM documents JOIN labels USING (doc_id)),
  w AS (SELECT doc_id, label, is_train, unnest({WORDS_SQL}) AS word FROM d),
  v AS (SELECT word, count(*) AS c FROM w WHERE is_train GROUP BY 1 ORDER BY c DESC, word LIMIT {VOCABULARY}),
  f AS (SELECT DISTINCT doc_id, label, is_train, w.word FROM w JOIN v ON v.word = w.word),
  l AS (SELECT label, count(*) AS n_l FROM d WHERE is_train GROUP BY 1),
  t AS (SELECT sum(n_l) AS total, count(*) AS n_labels FROM l),
  g AS (SELECT v.word, l.label, n_l, total, n_labels, count(f.doc_id) AS c,
        sum(count(f.doc_id)) OVER (PARTITION BY v.word) AS df, sum(count(f.doc_id)) OVER (PARTITION BY l.label) AS tok
        FROM v CROSS JOIN l CROSS JOIN t LEFT JOIN f ON f.word = v.word AND f.label = l.label AND f.is_train GROUP BY 1, 2, 3, 4, 5)"""


def presence_sql(p1: str, p0: str, prior: str) -> str:
    return f"""WITH {DOCS_SQL},
      e AS (SELECT word, label, ln({p1}) AS a, ln({p0}) AS z, {prior} AS pr FROM g),
      base AS (SELECT label, any_value(pr) + sum(z) AS base FROM e GROUP BY 1),
      s AS (SELECT d.doc_id, base.label AS lab, any_value(base) + coalesce(sum(a - z), 0) AS score
        FROM d CROSS JOIN base LEFT JOIN f ON f.doc_id = d.doc_id
        LEFT JOIN e ON e.word = f.word AND e.label = base.label GROUP BY 1, 2),
      b AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, lab) AS k FROM s)
      SELECT doc_id, label, lab AS predicted, is_train, round(score, 4) AS score FROM b JOIN d USING (doc_id) WHERE k = 1"""


def labelled_docs(spark, d):
    docs = spread(table(spark, d, "documents").select("doc_id", "text")).select("doc_id", X.words(F.col("text")).alias("w"))
    lab = table(spark, d, "labels").select("doc_id", F.col("quality").alias("label"))
    # 80 % of the hash range trains
    split = docs.join(lab, "doc_id").withColumn("is_train", fold_of(F.col("doc_id"), 23, 10) < 8)
    # the texts are cut into words once; vocabulary, counts and scores read the result
    return settle(split, "words")


def presence_model(spark, d, kind):
    docs = labelled_docs(spark, d)
    vocab = X.vocabulary(docs.filter("is_train"), "w", VOCABULARY)
    present = X.presence(docs, ["doc_id", "label", "is_train"], "w", vocab)
    slim = docs.drop("w")
    model = B.PresenceModel(slim.filter("is_train"), present.filter("is_train"), vocab, kind)
    return model, slim, present


def presence_predictions(spark, d, kind):
    model, docs, present = presence_model(spark, d, kind)
    return model.score(docs, present, "doc_id")


def _presence_query(spark, d, kind):
    p = presence_predictions(spark, d, kind)
    return p.select("doc_id", "label", "predicted", "is_train", F.round(F.array_max("scores"), 4).alias("score"))


TOOLKIT_P1 = "CASE WHEN df = 0 THEN 1 WHEN df = total THEN (c + 0.5) / (n_l + 0.5) ELSE (c + 0.5) / (n_l + 1.0) END"
TOOLKIT_P0 = "CASE WHEN df = total THEN 1 WHEN df = 0 THEN (n_l - c + 0.5) / (n_l + 0.5) ELSE (n_l - c + 0.5) / (n_l + 1.0) END"


@query("nb_presence", presence_sql(TOOLKIT_P1, TOOLKIT_P0, "ln((n_l + 0.5) / (total + 0.5 * n_labels))"))
def nb_presence(spark, d):
    return _presence_query(spark, d, "toolkit")


@query("nb_multinomial", presence_sql(f"(c + 1.0) / (tok + {VOCABULARY})", "1", "ln(n_l / total)"))
def nb_multinomial(spark, d):
    return _presence_query(spark, d, "multinomial")


@query("nb_bernoulli", presence_sql("(c + 1.0) / (n_l + 2.0)", "(n_l - c + 1.0) / (n_l + 2.0)", "ln(n_l / total)"))
def nb_bernoulli(spark, d):
    return _presence_query(spark, d, "bernoulli")


@query(
    "informative_features",
    f"""WITH {DOCS_SQL}, e AS (SELECT word, {TOOLKIT_P1} AS p FROM g)
        SELECT word, round(max(p) / min(p), 6) AS ratio FROM e GROUP BY 1 ORDER BY max(p) / min(p) DESC, word LIMIT 15""",
)
def informative_features(spark, d):
    model, _, _ = presence_model(spark, d, "toolkit")
    return model.informative(15).withColumn("ratio", F.round("ratio", 6))

"""Library models, rules, ensembles and repeated experiments."""

from pyspark.ml.classification import (
    DecisionTreeClassifier,
    LinearSVC,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    NaiveBayes,
    OneVsRest,
    RandomForestClassifier,
)
from pyspark.ml import Pipeline
from pyspark.ml.feature import IndexToString, StringIndexer, VectorAssembler, VectorIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from tidewater.operators import c45 as T
from tidewater.operators import clusters as C
from tidewater.operators import metrics as M
from tidewater.operators import models as Q
from tidewater.operators import neighbors as N
from tidewater.operators import ripper as R
from tidewater.operators import rules as L
from tidewater.operators import sgd as G
from tidewater.operators import svm as V
from tidewater.operators.sampling import fold_of, seeded_hash
from tidewater.plans.clustering import embeddings, features
from tidewater.plans.registry import query
from tidewater.session import scratch_path, settle, spread, table

LABEL = dict(labelCol="label_idx", featuresCol="features")


def scored(spark, d, stage):
    train = fold_of(F.col("vec_id"), 31, 10) < 8
    out = Q.fit_score([stage], features(spark, d), train)
    return out.select("vec_id", "label", "predicted", train.alias("is_train"))


@query("logreg")
def logreg(spark, d):
    return scored(spark, d, LogisticRegression(family="multinomial", maxIter=20, regParam=0.01, **LABEL))


@query("random_forest")
def random_forest(spark, d):
    return scored(spark, d, RandomForestClassifier(numTrees=10, seed=7, **LABEL))


@query("mlp")
def mlp(spark, d):
    width, classes = embeddings(spark, d).agg(F.max(F.size("embedding")), F.count_distinct("label")).first()
    layers = [width, 40, 80, 40, classes]
    return scored(spark, d, MultilayerPerceptronClassifier(layers=layers, blockSize=128, seed=1234, maxIter=30, **LABEL))


@query("linear_svc")
def linear_svc(spark, d):
    return scored(spark, d, OneVsRest(classifier=LinearSVC(maxIter=10, regParam=0.01), parallelism=4, **LABEL))


@query("tree_entropy")
def tree_entropy(spark, d):
    return scored(spark, d, DecisionTreeClassifier(impurity="entropy", maxDepth=6, **LABEL))


def text_stats(spark, d):
    """Numeric description of every labelled text."""
    words = F.regexp_count("text", F.lit("[A-Za-z]+"))
    docs = spread(table(spark, d, "documents").select("doc_id", "text")).select(
        "doc_id",
        F.length("text").cast("double").alias("chars"),
        words.cast("double").alias("words"),
        F.size(F.split("text", "\n")).cast("double").alias("lines"),
        F.coalesce(F.try_divide(F.length("text"), words), F.lit(0.0)).alias("chars_per_word"),
    )
    lab = table(spark, d, "labels").select("doc_id", F.col("quality").alias("label"), "toxic")
    # a few numbers per text; the texts are read once
    return settle(docs.join(lab, "doc_id"), "stats")


STATS = ["chars", "words", "lines", "chars_per_word"]


def stat_features(spark, d):
    return C.as_features(text_stats(spark, d).withColumn("vec", F.array(*[F.log1p(c) for c in STATS])), "vec")


@query("sgd_hinge")
def sgd_hinge(spark, d):
    rows = settle(stat_features(spark, d).drop("features"), "examples")
    model = G.fit_sgd(rows, "doc_id", "vec", "label", epochs=10)
    return G.predict_sgd(rows, "vec", model).select("doc_id", "label", "predicted")


@query("rff_svm")
def rff_svm(spark, d):
    e = embeddings(spark, d)
    dims = e.agg(F.max(F.size("embedding"))).first()[0]
    lifted = C.as_features(e.withColumn("z", C.fourier_features(F.col("embedding"), dims, 128, 0.5, 5)), "z")
    out = Q.fit_score([OneVsRest(classifier=LinearSVC(maxIter=10, regParam=0.01), parallelism=4, **LABEL)], lifted.drop("z"))
    return out.select("vec_id", "label", "predicted")


@query("kernel_svm")
def kernel_svm(spark, d):
    e = settle(embeddings(spark, d), "rows")
    machines = V.fit_svm(e.filter(fold_of(F.col("vec_id"), 31, 10) < 8), "embedding", "label", cost=1.0, gamma=0.5)
    return V.predict_svm(e, "embedding", machines, 0.5).select("vec_id", "label", "predicted", F.round("decision", 3).alias("decision"))


@query("nu_svm")
def nu_svm(spark, d):
    rows = settle(stat_features(spark, d).drop("features"), "examples")
    machines = V.fit_nu_svm(rows, "vec", "label", nu=0.2, gamma=0.5)
    return V.predict_svm(rows, "vec", machines, 0.5).select("doc_id", "label", "predicted")


@query("linreg_elastic")
def linreg_elastic(spark, d):
    rows = VectorAssembler(inputCols=["l_quantity", "l_discount", "l_tax"], outputCol="features").transform(
        table(spark, d, "lineitem").select("l_quantity", "l_discount", "l_tax", F.col("l_extendedprice").alias("label"))
    )
    model = LinearRegression(maxIter=100, regParam=0.3, elasticNetParam=0.8).fit(rows)
    s = model.summary
    line = (float(model.intercept), [float(c) for c in model.coefficients], s.rootMeanSquaredError, s.r2, int(s.totalIterations))
    return spark.createDataFrame([line], "intercept double, coefficients array<double>, rmse double, r2 double, iterations int")


@query(
    "label_index",
    """WITH f AS (SELECT o_orderpriority, row_number() OVER (ORDER BY count(*) DESC, o_orderpriority) - 1 AS k FROM orders GROUP BY 1),
       g AS (SELECT o_orderstatus, row_number() OVER (ORDER BY count(*) DESC, o_orderstatus) - 1 AS s FROM orders GROUP BY 1)
       SELECT o_orderkey, k::DOUBLE AS label_idx, s::DOUBLE AS status_idx, o_orderpriority AS back FROM orders JOIN f USING (o_orderpriority) JOIN g USING (o_orderstatus)""",
)
def label_index(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice")
    index = StringIndexer(inputCols=["o_orderpriority", "o_orderstatus"], outputCols=["label_idx", "status_idx"])
    row = VectorAssembler(inputCols=["status_idx", "o_totalprice"], outputCol="raw")
    model = Pipeline(stages=[index, row, VectorIndexer(inputCol="raw", outputCol="indexed", maxCategories=4)]).fit(orders)
    back = IndexToString(inputCol="label_idx", outputCol="back", labels=model.stages[0].labelsArray[0])
    return back.transform(model.transform(orders)).select("o_orderkey", "label_idx", "status_idx", "back")


# -------------------------------------------------------------------- rules


@query(
    "gain_ratio_split",
    """WITH c AS (SELECT unnest(['o_orderstatus', 'y']) AS feature, unnest([o_orderstatus, year(o_orderdate)::VARCHAR]) AS value,
               o_orderpriority AS label FROM orders),
       n AS (SELECT feature, value, label, count(*) AS n FROM c GROUP BY 1, 2, 3),
       b AS (SELECT feature, log2(sum(n)) - sum(n * log2(n)) / sum(n) AS h FROM (SELECT feature, label, sum(n) AS n FROM n GROUP BY 1, 2) GROUP BY 1),
       v AS (SELECT feature, value, sum(n) AS size, log2(sum(n)) - sum(n * log2(n)) / sum(n) AS h FROM n GROUP BY 1, 2),
       a AS (SELECT feature, sum(h * size) / sum(size) AS h, log2(sum(size)) - sum(size * log2(size)) / sum(size) AS si FROM v GROUP BY 1)
       SELECT feature, round(b.h - a.h, 6) AS gain, round(si, 6) AS split_info, round((b.h - a.h) / si, 6) AS gain_ratio
       FROM a JOIN b USING (feature)""",
)
def gain_ratio_split(spark, d):
    orders = table(spark, d, "orders").select("o_orderpriority", "o_orderstatus", F.year("o_orderdate").alias("y"))
    g = L.gain_ratio(orders, "o_orderpriority", ["o_orderstatus", "y"])
    return g.select("feature", *[F.round(c, 6).alias(c) for c in ("gain", "split_info", "gain_ratio")])


SPLIT_NUMERIC, SPLIT_KINDS = ["l_quantity", "ship_day"], ["l_linestatus", "l_linenumber"]


@query(
    "c45_splits",
    """WITH r AS (SELECT l_returnflag AS y, l_quantity::DOUBLE AS l_quantity, (l_shipdate::DATE - DATE '1970-01-01')::DOUBLE AS ship_day,
                      l_linestatus, l_linenumber::VARCHAR AS l_linenumber FROM lineitem),
       n AS (SELECT count(*) AS n FROM r),
       h AS (SELECT log2(sum(c)) - sum(c * log2(c)) / sum(c) AS h FROM (SELECT count(*) AS c FROM r GROUP BY y)),
       x AS (SELECT 'l_quantity' AS attribute, l_quantity AS v, y FROM r UNION ALL SELECT 'ship_day', ship_day, y FROM r),
       g AS (SELECT attribute, v, y, count(*) AS c FROM x GROUP BY 1, 2, 3),
       d AS (SELECT DISTINCT attribute, v FROM g),
       cl AS (SELECT DISTINCT y FROM r),
       f AS (SELECT d.attribute, d.v, cl.y, coalesce(c, 0) AS c FROM d CROSS JOIN cl LEFT JOIN g ON g.attribute = d.attribute AND g.v = d.v AND g.y = cl.y),
       s AS (SELECT attribute, v, y, sum(c) OVER (PARTITION BY attribute, y ORDER BY v) AS low, sum(c) OVER (PARTITION BY attribute, y) AS whole FROM f),
       e AS (SELECT attribute, v, sum(low) AS n_low, sum(whole - low) AS n_high,
                    sum(CASE WHEN low > 0 THEN low * log2(low) ELSE 0 END) AS b_low,
                    sum(CASE WHEN whole > low THEN (whole - low) * log2(whole - low) ELSE 0 END) AS b_high,
                    count(*) OVER (PARTITION BY attribute) AS n_values FROM s GROUP BY 1, 2),
       q AS (SELECT attribute, v AS cut, n_low, n_high, n_values,
                    h - ((n_low * log2(n_low) - b_low) + (n_high * log2(n_high) - b_high)) / (n_low + n_high) AS raw
             FROM e, h WHERE n_low >= 2 AND n_high >= 2),
       best AS (SELECT *, raw - log2(greatest(1, n_values - 1)) / (n_low + n_high) AS gain FROM q
                QUALIFY row_number() OVER (PARTITION BY attribute ORDER BY round(raw, 9) DESC, cut) = 1),
       nums AS (SELECT attribute, cut, gain, -(n_low / n.n * log2(n_low / n.n) + n_high / n.n * log2(n_high / n.n)) AS info FROM best, n),
       k AS (SELECT 'l_linestatus' AS attribute, l_linestatus AS v, y FROM r UNION ALL SELECT 'l_linenumber', l_linenumber, y FROM r),
       kc AS (SELECT attribute, v, y, count(*) AS c FROM k GROUP BY 1, 2, 3),
       kv AS (SELECT attribute, v, sum(c) AS size, sum(c) * log2(sum(c)) - sum(c * log2(c)) AS b FROM kc GROUP BY 1, 2),
       kinds AS (SELECT attribute, NULL::DOUBLE AS cut, max(h) - sum(b) / max(n.n) AS gain, -sum(size / n.n * log2(size / n.n)) AS info FROM kv, h, n GROUP BY 1)
       SELECT attribute, cut, round(gain, 6) AS gain, round(gain / info, 6) AS gain_ratio
       FROM (SELECT * FROM nums UNION ALL SELECT * FROM kinds) WHERE gain > 1e-9 AND info > 1e-9""",
)
def c45_splits(spark, d):
    """What every attribute would gain at the root of a tree."""
    lines = table(spark, d, "lineitem").select("l_returnflag", F.col("l_quantity"), F.datediff(F.to_date("l_shipdate"), F.lit("1970-01-01")).alias("ship_day"), *SPLIT_KINDS)
    rows, classes = T.numbered(lines, "l_returnflag", SPLIT_NUMERIC, SPLIT_KINDS)
    weights = {0: T.class_weights(rows, len(classes))[0]}
    found = T.candidates(rows, weights, SPLIT_NUMERIC, SPLIT_KINDS, {0: set()}, least=2.0)[0]
    out = [(attribute, cut, round(gain, 6), round(ratio, 6)) for gain, ratio, attribute, cut, _ in found]
    return spark.createDataFrame(out, "attribute string, cut double, gain double, gain_ratio double")


def labelled_texts(spark, d):
    """Numbers and kinds of every labelled text."""
    kinds = table(spark, d, "documents").select("doc_id", "lang", "source")
    return text_stats(spark, d).join(kinds, "doc_id")


@query("c45_tree")
def c45_tree(spark, d):
    tree = T.c45(labelled_texts(spark, d), "label", STATS, ["lang", "source"])
    schema = "node int, parent int, branch string, attribute string, cut double, label string, weight double, errors double"
    return spark.createDataFrame(T.tree_rows(tree), schema)


@query("c45_predict")
def c45_predict(spark, d):
    rows = settle(labelled_texts(spark, d), "labelled")
    tree = T.c45(rows.filter(fold_of(F.col("doc_id"), 31, 10) < 8), "label", STATS, ["lang", "source"])
    return T.predict(rows, tree).select("doc_id", "label", "predicted", F.round("confidence", 6).alias("confidence"))


RULE_CUTS = [50000.0, 150000.0, 250000.0, 350000.0, 450000.0]


@query(
    "rule_foil_gain",
    f"""WITH r AS (SELECT o_orderstatus = 'F' AS pos, unnest(list_concat(['o_orderpriority=' || o_orderpriority],
           list_transform([50000, 150000, 250000, 350000, 450000], lambda t: CASE WHEN o_totalprice >= t
             THEN 'o_totalprice>=' || t || '.0' ELSE 'o_totalprice<' || t || '.0' END))) AS cond FROM orders),
       g AS (SELECT cond, count(*) FILTER (pos) AS p, count(*) FILTER (NOT pos) AS n FROM r GROUP BY 1),
       s AS (SELECT avg((o_orderstatus = 'F')::INTEGER) AS share FROM orders)
       SELECT cond, p, n, round(p * (log2(p / (p + n)) - log2(share)), 4) AS gain FROM g, s WHERE p > 0""",
)
def rule_foil_gain(spark, d):
    orders = table(spark, d, "orders").select("o_orderstatus", "o_orderpriority", "o_totalprice")
    values = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
    cands = L.value_candidates({"o_orderpriority": values})
    cands += [("o_totalprice", op, t) for t in RULE_CUTS for op in (">=", "<")]
    names = F.array(*[F.lit(L.show(c)) for c in cands])
    g = L.foil_gain(orders, F.col("o_orderstatus") == "F", cands)
    return g.select(F.get(names, F.col("idx")).alias("cond"), "p", "n", F.round("gain", 4).alias("gain"))


@query("rule_list")
def rule_list(spark, d):
    rows = settle(labelled_texts(spark, d), "labelled")
    rules, default = R.ripper(rows, "doc_id", "label", STATS, ["lang", "source"])
    return R.rule_rows(rows, "label", rules, default)


# ------------------------------------------------------- votes, experiments


@query(
    "vote_ensemble",
    """WITH v AS (SELECT o_orderkey, unnest(['price', 'date', 'status', 'key']) AS model, unnest([
          CASE WHEN o_totalprice > 250000 THEN 'pos' ELSE 'neg' END, CASE WHEN year(o_orderdate) > 1998 THEN 'pos' ELSE 'neg' END,
          CASE o_orderstatus WHEN 'F' THEN 'pos' ELSE 'neg' END, CASE WHEN o_custkey % 2 = 0 THEN 'pos' ELSE 'neg' END]) AS vote FROM orders),
       c AS (SELECT o_orderkey, vote, count(*) AS n FROM v GROUP BY 1, 2),
       r AS (SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY n DESC, vote) AS k FROM c)
       SELECT o_orderkey, vote AS label, n / 4 AS confidence FROM r WHERE k = 1 AND n / 4 >= 0.7""",
)
def vote_ensemble(spark, d):
    def said(name, cond):
        return F.struct(F.lit(name).alias("model"), F.when(cond, "pos").otherwise("neg").alias("vote"))

    rules = F.array(
        said("price", F.col("o_totalprice") > 250000), said("date", F.year("o_orderdate") > 1998),
        said("status", F.col("o_orderstatus") == "F"), said("key", F.col("o_custkey") % 2 == 0),
    )
    votes = table(spark, d, "orders").select("o_orderkey", F.inline(rules))
    return Q.vote_ensemble(votes, "o_orderkey", "model", "vote", 0.7)


@query("sentiment_score")
def sentiment_score(spark, d):
    docs = spread(table(spark, d, "documents").select("doc_id", "text"))
    train = docs.join(table(spark, d, "labels").select("doc_id", F.col("quality").cast("double").alias("label")), "doc_id")
    make = Pipeline(stages=Q.text_stages(5000)).fit(train)
    features_path = scratch_path(spark, "text_features")
    Q.save_model(make, features_path)
    rows = settle(make.transform(train).select("features", "label"), "features")
    paths = []
    for name, stage in (
        ("multinomial", NaiveBayes(modelType="multinomial")),
        ("bernoulli", NaiveBayes(modelType="bernoulli")),
        ("logistic", LogisticRegression(maxIter=10, regParam=0.1)),
    ):
        paths.append(scratch_path(spark, name))
        Q.save_model(Pipeline(stages=[stage]).fit(rows), paths[-1])
    return Q.sentiment(docs, "doc_id", features_path, paths)


@query("model_roundtrip")
def model_roundtrip(spark, d):
    """Predictions of a model before saving beside those after loading."""
    from pyspark.ml import PipelineModel

    f = features(spark, d).withColumn("label", F.col("label").cast("double"))
    model = Pipeline(stages=[LogisticRegression(maxIter=10)]).fit(f)
    path = scratch_path(spark, "model")
    Q.save_model(model, path)
    before = model.transform(f).select("vec_id", F.col("prediction").alias("before"))
    after = PipelineModel.load(path).transform(f).select("vec_id", F.col("prediction").alias("after"))
    return before.join(after, "vec_id")


@query("experiment_summary")
def experiment_summary(spark, d):
    """Four models over several seeds: mean and deviation of four metrics."""
    rows = stat_features(spark, d).persist()
    cands = L.numeric_candidates(rows, STATS)
    out = None
    for seed in range(1, 6):
        marked = rows.withColumn("is_train", seeded_hash(F.col("doc_id"), seed) < int(0.8 * 4294967296))
        train, test = marked.filter("is_train"), marked.filter(~F.col("is_train"))
        near = N.vote(N.knn(train, test, 5, "doc_id", "vec"), train, "doc_id", "label").withColumnRenamed("q_id", "doc_id")
        tree = Q.fit_score([DecisionTreeClassifier(impurity="entropy", **LABEL)], marked, F.col("is_train"))
        lifted = C.as_features(marked.withColumn("z", C.fourier_features(F.col("vec"), 4, 64, 0.5, seed)), "z")
        svm = Q.fit_score([LinearSVC(maxIter=10, **LABEL)], lifted, F.col("is_train"))
        rules = L.learn_rules(train, "label", 0, cands, "doc_id", seed=seed)
        said = {
            "knn": test.select("doc_id", "label").join(near, "doc_id"),
            "tree": tree.filter(~F.col("is_train")),
            "svm": svm.filter(~F.col("is_train")),
            "rules": test.withColumn("predicted", L.apply_rules(rules, 0, 1)),
        }
        for name, p in said.items():
            p = p.select(F.col("label").cast("string").alias("label"), F.col("predicted").cast("string").alias("predicted"))
            p = p.withColumn("model", F.lit(name)).withColumn("seed", F.lit(seed))
            out = p if out is None else out.unionByName(p)
    out = M.scores_by(settle(out, "predictions"), ["model", "seed"], "label", "predicted")
    rows.unpersist()
    names = ["accuracy", "macro_precision", "macro_recall", "macro_f1"]
    return out.groupBy("model").agg(
        F.count("*").alias("runs"),
        *[F.avg(c).alias(f"{c}_mean") for c in names],
        *[F.stddev_samp(c).alias(f"{c}_sd") for c in names],
    )

"""Naive Bayes in closed form, from mergeable counts and moments.

Training is one grouped aggregate with map-side partials, so a hot class costs
no more than any other.  A fitted Gaussian model is (labels x features) numbers;
its size is checked before it is shipped to the tasks that score.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.operators.relational import small
from tidewater.session import settle

MODEL_CELLS = 20_000_000


# ------------------------------------------------------------------ Gaussian


def class_moments(df: DataFrame, label: str, features: str) -> DataFrame:
    """(label, feature, n, mean, var_pop) of an array column, one row buffer per
    class: the vector summary keeps all features in a single aggregate state."""
    as_double = F.transform(F.col(features), lambda x: x.cast("double"))
    vec = df.select(F.col(label).alias("label"), array_to_vector(as_double).alias("_v"))
    s = vec.groupBy("label").agg(
        Summarizer.metrics("count", "mean", "variance").summary(F.col("_v")).alias("_s")
    )
    cells = F.posexplode(
        F.arrays_zip(vector_to_array("_s.mean").alias("mean"), vector_to_array("_s.variance").alias("var"))
    )
    n = F.col("_s.count")
    return (
        s.select("label", n.alias("n"), cells)
        .select("label", F.col("pos").alias("feature"), "n", F.col("col.mean").alias("mean"),
                F.when(F.col("n") > 1, F.col("col.var") * (F.col("n") - 1) / F.col("n")).otherwise(F.lit(0.0)).alias("var_pop"))
    )


def with_prior(stats: DataFrame) -> DataFrame:
    """Log share of each class, from the class sizes of feature 0."""
    sizes = stats.filter(F.col("feature") == 0).select("label", F.col("n").alias("_n"))
    total = sizes.agg(F.sum("_n").alias("_all"))
    prior = sizes.select("label", F.log(F.col("_n") / total.scalar()).alias("log_prior"))
    return stats.join(small(prior), "label")


def merge_stats(parts: DataFrame, keys: Sequence[str] = ("label", "feature")) -> DataFrame:
    """Merge (n, mean, var_pop) summaries, as incremental training needs."""
    from tidewater.operators.relational import merge_moments

    return merge_moments(parts, list(keys))


class GaussianScorer:
    """Fitted Gaussian model as plain arrays; labels are in sorted order."""

    def __init__(self, params: DataFrame):
        n = params.count()
        if n > MODEL_CELLS:
            raise ValueError(f"model of {n} cells is too large to ship to tasks")
        pdf = params.select("label", "feature", "mean", "var_pop", "log_prior").toPandas()
        self.labels = sorted(pdf["label"].unique().tolist())
        wide = pdf.sort_values(["label", "feature"])
        shape = (len(self.labels), -1)
        self.mean = wide["mean"].to_numpy().reshape(shape)
        self.var = wide["var_pop"].to_numpy().reshape(shape)
        self.prior = wide.groupby("label")["log_prior"].first().loc[self.labels].to_numpy()

    def log_scores(self, x: np.ndarray, skip_zero: bool = False) -> np.ndarray:
        """Sum of log densities per row and label, without the prior.

        Logs are added directly, so nothing underflows.  ``skip_zero`` drops the
        features whose density would underflow to zero, as older results did.
        """
        return self.density(x, self.mean, self.var, skip_zero)

    @staticmethod
    def density(x: np.ndarray, mean: np.ndarray, var: np.ndarray, skip_zero: bool = False) -> np.ndarray:
        out = np.empty((len(x), len(mean)))
        for i, (m, v) in enumerate(zip(mean, var)):
            with np.errstate(divide="ignore", invalid="ignore"):
                part = -0.5 * np.log(2 * np.pi * v) - 0.5 * (x - m) ** 2 / v
            part = np.where(v == 0, np.where(x == m, 0.0, -np.inf), part)
            if skip_zero:
                part = np.where(np.exp(part) == 0, 0.0, part)
            out[:, i] = part.sum(axis=1)
        return out

    def score_column(self, features: Column, skip_zero: bool = False, prior: bool = True) -> Column:
        """Array of log scores, one per label."""
        model = self

        @F.pandas_udf(T.ArrayType(T.DoubleType()))
        def scores(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for rows in batches:
                if len(rows) == 0:
                    yield pd.Series([], dtype=object)
                    continue
                x = np.asarray(rows.tolist(), dtype=float)
                s = model.log_scores(x, skip_zero) + (model.prior if prior else 0.0)
                yield pd.Series(list(s))

        return scores(F.transform(features, lambda v: v.cast("double")))

    def argmax(self, scores: Column) -> Column:
        """Label of the best score; a tie goes to the first label."""
        labels = F.array(*[F.lit(v) for v in self.labels])
        return F.get(labels, F.array_position(scores, F.array_max(scores)).cast("int") - 1)


# --------------------------------------------------------------- rounds


def round_moments(df: DataFrame, round_col: str, label: str, features: Sequence[str], cumulative: bool = True) -> DataFrame:
    """Per-round parameters: round r is fitted on every round up to r.

    Each row is summed once; the rounds before it come in by running sums over
    the small (round, label, feature) table.
    """
    cells = F.posexplode(F.array(*[F.col(c).cast("double") for c in features]))
    per = (
        df.select(F.col(round_col).alias("round"), F.col(label).alias("label"), cells)
        .groupBy("round", "label", F.col("pos").alias("feature"))
        .agg(F.count("col").alias("n"), F.sum("col").alias("sx"), F.sum(F.col("col") * F.col("col")).alias("sxx"))
    )
    if cumulative:
        per = cumulate_rounds(per)
    return finish_moments(per)


def cumulate_rounds(per: DataFrame) -> DataFrame:
    """Running sums over rounds; a class absent from a round keeps its past."""
    rounds = per.select("round").distinct()
    classes = per.groupBy("label", "feature").agg(F.min("round").alias("_from"))
    grid = rounds.join(small(classes), F.col("round") >= F.col("_from")).drop("_from")
    w = W.partitionBy("label", "feature").orderBy("round").rowsBetween(W.unboundedPreceding, W.currentRow)
    full = grid.join(per, ["round", "label", "feature"], "left").na.fill(0, ["n", "sx", "sxx"])
    return full.select("round", "label", "feature", *[F.sum(c).over(w).alias(c) for c in ("n", "sx", "sxx")])


def finish_moments(sums: DataFrame) -> DataFrame:
    """Mean and population variance from count, sum and sum of squares."""
    mean = F.col("sx") / F.col("n")
    var = F.greatest(F.col("sxx") / F.col("n") - mean * mean, F.lit(0.0))
    return sums.withColumn("mean", mean).withColumn("var_pop", var).drop("sx", "sxx")


def round_accuracy(train: DataFrame, held: DataFrame, round_col: str, label: str, features: str) -> DataFrame:
    """(round, scope, n, accuracy) of the model after each round: on the
    held-out rows of its own round, and on all held-out rows.

    The rounds' models are shipped together after a size check; each held-out
    row is read once and scored by all of them in its task.
    """
    per = train.select(round_col, label, F.posexplode(F.col(features).cast("array<double>")))
    sums = (
        per.groupBy(F.col(round_col).alias("round"), F.col(label).alias("label"), F.col("pos").alias("feature"))
        .agg(F.count("col").alias("n"), F.sum("col").alias("sx"), F.sum(F.col("col") * F.col("col")).alias("sxx"))
    )
    params = finish_moments(cumulate_rounds(sums))
    if params.count() > MODEL_CELLS:
        raise ValueError("the rounds' models are too large to ship together; use larger rounds")
    found = params.toPandas().sort_values(["round", "label", "feature"])
    models = []
    for number, part in found.groupby("round"):
        labels = sorted(part["label"].unique().tolist())
        size = part.groupby("label")["n"].first().loc[labels].to_numpy()
        shape = (len(labels), -1)
        models.append((int(number), np.asarray(labels), np.log(size / size.sum()),
                       part["mean"].to_numpy().reshape(shape), part["var_pop"].to_numpy().reshape(shape)))

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf) == 0:
                continue
            x = np.asarray(pdf["x"].tolist(), dtype=float)
            for number, labels, prior, mean, var in models:
                s = GaussianScorer.density(x, mean, var) + prior
                hit = labels[s.argmax(1)] == pdf["label"].to_numpy()
                yield pd.DataFrame({"round": number, "own": pdf["rnd"].to_numpy() == number, "hit": hit})

    slim = held.select(F.col(round_col).alias("rnd"), F.col(label).alias("label"), F.col(features).cast("array<double>").alias("x"))
    hits = slim.mapInPandas(score, "round bigint, own boolean, hit boolean")
    scopes = F.when(F.col("own"), F.array(F.lit("global"), F.lit("round"))).otherwise(F.array(F.lit("global")))
    return hits.select("round", "hit", F.explode(scopes).alias("scope")).groupBy("round", "scope").agg(
        F.count("*").alias("n"), F.avg(F.col("hit").cast("int")).alias("accuracy")
    )


# -------------------------------------------------------------- categorical


class CategoricalModel:
    """Counts of (label, value) over one vocabulary for all columns."""

    def __init__(self, df: DataFrame, label: str, cats: str):
        pairs = df.select(F.col(label).alias("label"), F.explode(cats).alias("value"))
        # written once: the planner then knows its true size
        self.counts = settle(pairs.groupBy("label", "value").agg(F.count("*").alias("n")), "counts")
        sizes = df.groupBy(F.col(label).alias("label")).count().orderBy("label").collect()
        self.labels = [r["label"] for r in sizes]
        self.sizes = [r["count"] for r in sizes]
        self.vocabulary = self.counts.select("value").distinct().count()

    def log_prior(self) -> list[float]:
        return [float(np.log(n / sum(self.sizes))) for n in self.sizes]

    def table(self) -> DataFrame:
        """(label, value, n, log_p) with the add-one estimate."""
        size = F.create_map(*[F.lit(x) for pair in zip(self.labels, self.sizes) for x in pair])
        below = F.element_at(size, F.col("label")) + F.lit(self.vocabulary)
        return self.counts.withColumn("log_p", F.log((F.col("n") + 1) / below))

    def score(self, rows: DataFrame, id_col: str, cats: str, prior: bool = True) -> DataFrame:
        """(id, scores): log score per label in label order.

        A value never seen with a label counts as 1 / (class rows + vocabulary).
        """
        floor = [float(np.log(1.0 / (n + self.vocabulary))) for n in self.sizes]
        per_label = [
            F.coalesce(F.max(F.when(F.col("label") == v, F.col("log_p"))), F.lit(f))
            for v, f in zip(self.labels, floor)
        ]
        lookup = self.table().groupBy("value").agg(F.array(*per_label).alias("_lp"))
        values = rows.select(F.col(id_col), F.explode(cats).alias("value"))
        seen = values.join(small(lookup), "value", "left")
        base = self.log_prior() if prior else [0.0] * len(self.labels)
        sums = [
            (F.sum(F.coalesce(F.get("_lp", F.lit(i)), F.lit(f))) + F.lit(b))
            for i, (f, b) in enumerate(zip(floor, base))
        ]
        return seen.groupBy(id_col).agg(F.array(*sums).alias("scores"))


def best_label(scores: Column, labels: Sequence) -> Column:
    names = F.array(*[F.lit(v) for v in labels])
    return F.get(names, F.array_position(scores, F.array_max(scores)).cast("int") - 1)


# ----------------------------------------------------------- word presence


class PresenceModel:
    """Naive Bayes over binary word presence, as one additive table.

    ``kind`` sets the estimate: ``toolkit`` adds one half to every count of
    label and of (label, word present / absent); ``bernoulli`` adds one to the
    (label, word) counts; ``multinomial`` looks at present words only.
    The score of a text is a constant per label plus a weight per present word.
    """

    def __init__(self, docs: DataFrame, present: DataFrame, vocabulary: DataFrame, kind: str, label: str = "label"):
        sizes = docs.groupBy(F.col(label).alias("label")).count().orderBy("label").collect()
        self.labels = [r["label"] for r in sizes]
        self.sizes = [r["count"] for r in sizes]
        self.kind, total = kind, sum(self.sizes)
        seen = present.groupBy("word").agg(
            *[F.count(F.when(F.col("label") == v, 1)).alias(f"c{i}") for i, v in enumerate(self.labels)]
        )
        counts = settle(vocabulary.select("word").join(seen, "word", "left").na.fill(0), "counts")
        cols = [F.col(f"c{i}") for i in range(len(self.labels))]
        df_all = sum(cols[1:], cols[0])
        if kind == "multinomial":
            words = counts.agg(F.count("*").alias("v"), *[F.sum(c).alias(f"s{i}") for i, c in enumerate(cols)]).first()
            p1 = [(c + 1) / F.lit(float(words[f"s{i}"] + words["v"])) for i, c in enumerate(cols)]
            p0 = [F.lit(1.0)] * len(cols)
        else:
            alpha = 0.5 if kind == "toolkit" else 1.0
            # a word present everywhere or nowhere has one observed value only
            both = (df_all > 0) & (df_all < total)
            bins = F.when(both, 2.0).otherwise(1.0) if kind == "toolkit" else F.lit(2.0)
            p1, p0 = [], []
            for c, n in zip(cols, self.sizes):
                below = F.lit(float(n)) + alpha * bins
                if kind == "toolkit":
                    p1.append(F.when(df_all > 0, (c + alpha) / below).otherwise(1.0))
                    p0.append(F.when(df_all < total, (F.lit(n) - c + alpha) / below).otherwise(1.0))
                else:
                    p1.append((c + alpha) / below)
                    p0.append((F.lit(n) - c + alpha) / below)
        self.weights = counts.select(
            "word",
            F.array(*[F.log(p) for p in p1]).alias("log_p1"),
            F.array(*[F.log(p) for p in p0]).alias("log_p0"),
        )
        absent = self.weights.agg(*[F.sum(F.get("log_p0", F.lit(i))) for i in range(len(cols))]).first()
        shift = 0.5 if kind == "toolkit" else 0.0
        self.base = [
            float(np.log((n + shift) / (total + shift * len(self.sizes)))) + float(a or 0.0)
            for n, a in zip(self.sizes, absent)
        ]

    def score(self, docs: DataFrame, present: DataFrame, id_col: str) -> DataFrame:
        """Documents with ``scores`` and ``predicted``; none is left out."""
        gain = F.zip_with("log_p1", "log_p0", lambda a, b: a - b)
        weights = self.weights.select("word", gain.alias("_w"))
        sums = [F.sum(F.get("_w", F.lit(i))).alias(f"_s{i}") for i in range(len(self.labels))]
        per = present.select(id_col, "word").join(small(weights), "word").groupBy(id_col).agg(*sums)
        scores = F.array(
            *[F.coalesce(F.col(f"_s{i}"), F.lit(0.0)) + F.lit(b) for i, b in enumerate(self.base)]
        )
        out = docs.join(per, id_col, "left").withColumn("scores", scores)
        return out.withColumn("predicted", best_label(F.col("scores"), self.labels)).drop(
            *[f"_s{i}" for i in range(len(self.labels))]
        )

    def informative(self, n: int) -> DataFrame:
        """Words by the ratio of their largest to smallest P(present | label)."""
        ratio = F.exp(F.array_max("log_p1") - F.array_min("log_p1"))
        return self.weights.select("word", ratio.alias("ratio")).orderBy(F.desc("ratio"), "word").limit(n)

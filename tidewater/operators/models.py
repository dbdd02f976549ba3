"""Library models behind one fit-and-score shape, ensembles and experiments."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import CountVectorizer, IndexToString, RegexTokenizer, StringIndexer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fit_score(stages: Sequence, df: DataFrame, train: Column | None = None, label: str = "label") -> DataFrame:
    """Fit on the training rows, score every row, and name the prediction.

    The label index is taken from all rows and used throughout, so training,
    scoring and the inverse map agree; the stages read ``label_idx``.
    """
    named = df.withColumn(label, F.col(label).cast("string"))
    index = StringIndexer(inputCol=label, outputCol="label_idx").fit(named)
    rows = index.transform(named)
    model = Pipeline(stages=list(stages)).fit(rows.filter(train) if train is not None else rows)
    names = IndexToString(inputCol="prediction", outputCol="predicted", labels=index.labels)
    return names.transform(model.transform(rows))


def vote_ensemble(votes: DataFrame, key: str, model: str, vote: str, at_least: float = 0.0) -> DataFrame:
    """Majority vote and its share per key; a tie goes to the smallest label.

    A model counts once per key however often it is listed.
    """
    from tidewater.operators.relational import mode_share

    once = votes.groupBy(key, model).agg(F.min(vote).alias("vote"))
    found = mode_share(once, [key], "vote")
    return found.select(key, F.col("mode").alias("label"), F.col("share").alias("confidence")).filter(
        F.col("confidence") >= at_least
    )


def text_stages(n_words: int, text_col: str = "text") -> list:
    cut = RegexTokenizer(inputCol=text_col, outputCol="_words", pattern="[^a-z]+", toLowercase=True)
    return [cut, CountVectorizer(inputCol="_words", outputCol="features", vocabSize=n_words, binary=True)]


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def row_vote(votes: Column) -> Column:
    """Struct (label, confidence) of the votes in one row's array; a tie goes to
    the smallest label."""
    tally = F.transform(
        F.array_sort(F.array_distinct(votes)),
        lambda v: F.struct(F.size(F.filter(votes, lambda x: x == v)).alias("n"), v.alias("label")),
    )
    most = F.array_max(F.transform(tally, lambda t: t["n"]))
    best = F.get(F.filter(tally, lambda t: t["n"] == most), F.lit(0))
    return F.struct(best["label"].alias("label"), (best["n"] / F.size(votes)).alias("confidence"))


def sentiment(texts: DataFrame, key: str, feature_path: str, model_paths: Sequence[str]) -> DataFrame:
    """(key, label, confidence) of each text from stored models by vote.

    Features are made once per text, every model adds its column to the same
    row, and the vote is taken in the row: no shuffle.
    """
    rows = PipelineModel.load(feature_path).transform(texts).select(key, "features")
    names = []
    for i, path in enumerate(model_paths):
        model = PipelineModel.load(path)
        last = model.stages[-1]
        last.setPredictionCol(f"_p{i}").setRawPredictionCol(f"_r{i}").setProbabilityCol(f"_q{i}")
        rows = last.transform(rows).drop(f"_r{i}", f"_q{i}")
        names.append(F.col(f"_p{i}").cast("int"))
    return rows.select(key, row_vote(F.array(*names)).alias("_v")).select(key, "_v.*")

"""Centroid and top-down hierarchical clustering, and the indices that judge them."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.ml.clustering import BisectingKMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.operators.lloyd import Rounds, best, fit_many
from tidewater.session import settle


def as_features(df: DataFrame, array_col: str, name: str = "features") -> DataFrame:
    return df.withColumn(name, array_to_vector(F.col(array_col).cast("array<double>")))


def kmeans_best(df: DataFrame, vec: str, k: int, starts: int = 25, iterations: int = 100, seed: int = 1) -> np.ndarray:
    """Centres of the best of several starts, all of them fitted in the same scans."""
    return best(fit_many(df, vec, [k], starts, iterations, seed))[k].centres


def nearest_centre(centres: np.ndarray, vec: Column) -> Column:
    """Struct (cluster, sq_dist); the centres are k x d numbers."""

    @F.pandas_udf(T.StructType().add("cluster", T.IntegerType()).add("sq_dist", T.DoubleType()))
    def pick(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            if len(rows) == 0:
                yield pd.DataFrame({"cluster": pd.Series(dtype="int32"), "sq_dist": pd.Series(dtype="float64")})
                continue
            x = np.asarray(rows.tolist(), dtype=float)
            d = np.stack([((x - c) ** 2).sum(1) for c in centres], axis=1)
            yield pd.DataFrame({"cluster": d.argmin(1).astype("int32"), "sq_dist": d.min(1)})

    return pick(vec.cast("array<double>"))


def kmeans_step(df: DataFrame, vec: str, centres: np.ndarray) -> DataFrame:
    """One assignment and update: (cluster, pos, centre, n) of the new centres."""
    cells = F.posexplode(F.col(vec).cast("array<double>"))
    placed = df.select(nearest_centre(centres, F.col(vec))["cluster"].alias("cluster"), vec)
    return (
        placed.select("cluster", cells)
        .groupBy("cluster", "pos")
        .agg(F.avg("col").alias("centre"), F.count("*").alias("n"))
    )


def sums_of_squares(df: DataFrame, vec: str, cluster: str) -> DataFrame:
    """Total, within and between sums of squares of given assignments."""
    cells = F.posexplode(F.col(vec).cast("array<double>"))
    per = (
        df.select(F.col(cluster).alias("cluster"), cells)
        .groupBy("cluster", "pos")
        .agg(F.count("*").alias("n"), F.avg("col").alias("m"), (F.var_pop("col") * F.count("*")).alias("ss"))
    )
    # the total follows from the summaries: no second pass over the rows
    pos = per.groupBy("pos").agg(
        F.sum("ss").alias("within"),
        (F.sum(F.col("n") * F.col("m") * F.col("m")) - F.pow(F.sum(F.col("n") * F.col("m")), 2) / F.sum("n")).alias("between"),
    )
    total = F.sum("within") + F.sum("between")
    return pos.agg(
        total.alias("tss"), F.sum("within").alias("wss"), F.sum("between").alias("bss"),
        (F.sum("between") / total).alias("ratio"),
    )


def elbow(df: DataFrame, vec: str, ks: Sequence[int], starts: int = 100, iterations: int = 1000, seed: int = 1) -> DataFrame:
    """(k, wss): least within-cluster sum of squares over the starts, all models fitted together."""
    found = best(fit_many(df, vec, ks, starts, iterations, seed))
    return df.sparkSession.createDataFrame([(int(k), float(m.sse)) for k, m in sorted(found.items())], "k int, wss double")


def gap_statistic(
    df: DataFrame, vec: str, ks: Sequence[int], sets: int = 50, starts: int = 25, iterations: int = 100, seed: int = 1
) -> DataFrame:
    """Gap of log within-cluster cost to uniform rows in the bounding box
    (Tibshirani et al. 2001).  Reference sets have as many rows as the table;
    their models and the table's are fitted in the same rounds."""
    models = fit_many(df, vec, ks, starts, iterations, seed, sets)
    logs = np.array([[math.log(m.sse) if m.sse > 0 else -math.inf for _, m in sorted(best(models, space).items())] for space in range(sets + 1)])
    schema = "k int, log_w double, ref_log_w double, gap double, s_k double"
    if not models:
        return df.sparkSession.createDataFrame([], schema)
    own, ref = logs[0], logs[1:]
    spread = ref.std(axis=0) * math.sqrt(1 + 1 / sets)
    rows = [(int(k), float(o), float(m), float(m - o), float(s)) for k, o, m, s in zip(sorted(set(ks)), own, ref.mean(axis=0), spread)]
    return df.sparkSession.createDataFrame(rows, schema)


# ------------------------------------------------------------- hierarchical


def bisecting(df: DataFrame, id_col: str, vec: str, cut: int, seed: int = 1) -> DataFrame:
    """(id, cluster) of a hierarchy grown from the top: clusters are split in two
    by k-means until there are ``cut``.  It needs no distance between rows."""
    feats = as_features(df.select(F.col(id_col).alias("id"), vec), vec)
    model = BisectingKMeans(k=cut, seed=seed).fit(feats)
    return model.transform(feats).select("id", F.col("prediction").alias("cluster"))


# --------------------------------------------------------- random features


def fourier_features(vec: Column, dims: int, n_features: int, gamma: float, seed: int) -> Column:
    """Random Fourier features (Rahimi and Recht 2007) of the RBF kernel: inner
    products approach exp(-gamma |x - y|^2).  Approximate by design."""
    rng = np.random.default_rng(seed)
    w = rng.normal(scale=math.sqrt(2 * gamma), size=(dims, n_features))
    b = rng.uniform(0, 2 * math.pi, size=n_features)

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def lift(rows: pd.Series) -> pd.Series:
        if len(rows) == 0:
            return pd.Series([], dtype=object)
        x = np.asarray(rows.tolist(), dtype=float)
        return pd.Series(list(math.sqrt(2 / n_features) * np.cos(x @ w + b)))

    return lift(vec.cast("array<double>"))


def landmark_features(df: DataFrame, vec: str, gamma: float, landmarks: int = 500, seed: int = 1) -> DataFrame:
    """The rows with ``z``, coordinates whose inner products approach the RBF
    kernel (Nystroem), and ``missed``, the part of the row's own kernel value
    that they leave out: 0 where they are exact.

    Landmarks are distinct rows by seeded hash; only their small kernel matrix
    is decomposed, on the driver, at a size that is a parameter.
    """
    data = Rounds(df, vec, seed=seed)
    marks = data.first_centres(0, landmarks, 1)[0]
    far = (marks * marks).sum(1)[:, None] + (marks * marks).sum(1)[None, :] - 2 * marks @ marks.T
    values, turn = np.linalg.eigh(np.exp(-gamma * np.maximum(far, 0)))
    sound = values > 1e-10 * values.max(initial=0)
    lift = turn[:, sound] / np.sqrt(values[sound])

    @F.pandas_udf(T.StructType().add("z", T.ArrayType(T.DoubleType())).add("missed", T.DoubleType()))
    def features(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            if len(rows) == 0:
                yield pd.DataFrame({"z": pd.Series(dtype=object), "missed": pd.Series(dtype="float64")})
                continue
            x = np.asarray(rows.tolist(), dtype=float)
            near = np.exp(-gamma * np.maximum((x * x).sum(1)[:, None] + (marks * marks).sum(1)[None, :] - 2 * x @ marks.T, 0))
            z = near @ lift
            yield pd.DataFrame({"z": list(z), "missed": 1.0 - (z * z).sum(1)})

    sized = df.filter((F.size(vec) == data.width) & ~F.exists(vec, lambda v: v.isNull()))
    return sized.withColumn("_f", features(F.col(vec).cast("array<double>"))).select(*df.columns, "_f.z", "_f.missed")


def kernel_kmeans(
    df: DataFrame, vec: str, k: int, gamma: float, landmarks: int = 500, starts: int = 25, iterations: int = 100, seed: int = 1
) -> DataFrame:
    """The rows with ``cluster`` from k-means in the RBF kernel's space, over whole vectors, and ``missed``."""
    lifted = settle(landmark_features(df, vec, gamma, landmarks, seed), "lifted")
    centres = kmeans_best(lifted, "z", k, starts, iterations, seed)
    return lifted.withColumn("cluster", nearest_centre(centres, F.col("z"))["cluster"]).drop("z")

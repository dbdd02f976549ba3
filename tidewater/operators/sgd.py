"""Linear classifiers by stochastic gradient: an epoch in every slot, weights averaged.

Rows are dealt to slots of bounded size by a hash of their id.  In an epoch every
slot starts from the shipped weights, takes its rows one after another in an
order drawn from (id, seed, epoch), and reports its weights; Spark averages them
by the slots' rows.  With one slot this is plain stochastic gradient, step by
step.  Re-runs agree whatever the partitions, as nothing but ids decides order.

Hinge loss, one weight vector for each class against the rest, L2 penalty
``alpha`` and step size 1 / (alpha (t0 + t)) with t counted over the epochs.
Coordinates are brought to mean 0 and deviation 1 first.  Rows without a label
or with a null, short or holed vector are left out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.session import settle

SLOT_ROWS = 50_000
MOST_CLASSES = 1000


@dataclass
class Linear:
    classes: list
    weights: np.ndarray  # classes x (coordinates + 1), the last for the constant
    mean: np.ndarray
    scale: np.ndarray
    losses: list[float] = field(default_factory=list)  # mean hinge loss at the start of each epoch


def epoch_steps(x: np.ndarray, y: np.ndarray, weights: np.ndarray, alpha: float, first: int) -> np.ndarray:
    """Weights after one step for every row; y holds class numbers, x a last column of ones."""
    w = weights.copy()
    rows = np.arange(len(w))
    for t, (v, c) in enumerate(zip(x, y, strict=True), first):
        rate = 1.0 / (alpha * (1.0 / alpha + t))
        sign = np.where(rows == c, 1.0, -1.0)
        inside = sign * (w @ v) < 1.0
        w[:, :-1] *= 1.0 - rate * alpha
        w += np.where(inside, rate * sign, 0.0)[:, None] * v[None, :]
    return w


def hinge(x: np.ndarray, y: np.ndarray, weights: np.ndarray) -> float:
    sign = np.where(y[:, None] == np.arange(len(weights))[None, :], 1.0, -1.0)
    return float(np.maximum(0.0, 1.0 - sign * (x @ weights.T)).sum())


def _prepared(df: DataFrame, id_col: str, vec: str, label: str, slot_rows: int, seed: int):
    rows = df.select(F.col(id_col).cast("string").alias("id"), F.col(vec).cast("array<double>").alias("v"), F.col(label).alias("label"))
    rows = rows.filter(F.col("label").isNotNull() & F.col("v").isNotNull() & ~F.exists("v", lambda x: x.isNull() | F.isnan(x)))
    width = rows.agg(F.max(F.size("v"))).first()[0] or 0
    rows = rows.filter(F.size("v") == width)
    counts = rows.groupBy("label").count().orderBy("label").limit(MOST_CLASSES + 1).collect()
    if len(counts) > MOST_CLASSES:
        raise ValueError(f"more than {MOST_CLASSES} classes")
    classes, n = [r[0] for r in counts], sum(r[1] for r in counts)
    slots = max(1, -(-n // slot_rows))
    y = F.coalesce(*[F.when(F.col("label") == F.lit(c), F.lit(k)) for k, c in enumerate(classes)]) if classes else F.lit(0)
    slot = F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(slots)).cast("int")
    return settle(rows.select("id", "v", y.alias("y"), slot.alias("slot")), "examples"), classes, width


def fit_sgd(
    df: DataFrame, id_col: str, vec: str, label: str, epochs: int = 10, alpha: float = 1e-3, slot_rows: int = SLOT_ROWS, seed: int = 1
) -> Linear:
    """Weights after so many epochs, and the loss at the start of each."""
    rows, classes, width = _prepared(df, id_col, vec, label, slot_rows, seed)
    cells = rows.select(F.posexplode("v")).groupBy("pos").agg(F.avg("col"), F.stddev_pop("col")).orderBy("pos").collect()
    mean, scale = np.array([r[1] for r in cells]), np.array([r[2] or 1.0 for r in cells])
    model = Linear(classes, np.zeros((len(classes), width + 1)), mean, scale)
    for epoch in range(epochs if classes else 0):
        turn = F.xxhash64("id", F.lit(seed), F.lit(epoch))
        run = _slot_epoch(model, alpha, epoch)
        found = rows.withColumn("turn", turn).groupBy("slot").applyInArrow(run, "n bigint, loss double, w array<double>")
        found = settle(found, "epoch")
        n, loss = found.agg(F.sum("n"), F.sum("loss")).first()
        part = found.select("n", F.posexplode("w")).groupBy("pos").agg((F.sum(F.col("n") * F.col("col")) / F.sum("n")).alias("w"))
        model.losses.append(loss / n)
        model.weights = np.array([r.w for r in part.orderBy("pos").collect()]).reshape(model.weights.shape)
    return model


def _slot_epoch(model: Linear, alpha: float, epoch: int) -> Callable[[pa.Table], pa.Table]:
    weights, mean, scale = model.weights, model.mean, model.scale

    def run(table: pa.Table) -> pa.Table:
        order = np.argsort(table["turn"].to_numpy(), kind="stable")
        x = table["v"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(table.num_rows, -1)[order]
        x = np.column_stack([(x - mean) / scale, np.ones(len(x))])
        y = table["y"].to_numpy()[order]
        moved = epoch_steps(x, y, weights, alpha, epoch * len(x))
        columns = [pa.array([len(x)], pa.int64()), pa.array([hinge(x, y, weights)]), pa.array([moved.ravel().tolist()], pa.list_(pa.float64()))]
        return pa.Table.from_arrays(columns, names=["n", "loss", "w"])

    return run


def predict_sgd(df: DataFrame, vec: str, model: Linear, name: str = "predicted") -> DataFrame:
    """The rows with the class of the largest margin, null where the vector is not sound; ties go to the smaller class."""
    mean, scale, weights, width = model.mean, model.scale, model.weights, len(model.mean)

    @F.pandas_udf(T.IntegerType())
    def say(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for rows in batches:
            if len(rows) == 0:
                yield pd.Series([], dtype="int32")
                continue
            x = np.asarray(rows.tolist(), dtype=float).reshape(len(rows), width)
            yield pd.Series((np.column_stack([(x - mean) / scale, np.ones(len(x))]) @ weights.T).argmax(1).astype("int32"))

    v = F.col(vec).cast("array<double>")
    sound = v.isNotNull() & (F.size(v) == width) & ~F.exists(v, lambda x: x.isNull() | F.isnan(x))
    rows = df.withColumn("_y", say(F.when(sound, v).otherwise(F.array_repeat(F.lit(0.0), width))))
    names = F.array(*[F.lit(c) for c in model.classes]) if model.classes else F.array(F.lit(None))
    return rows.withColumn(name, F.when(sound, F.get(names, F.col("_y")))).drop("_y")

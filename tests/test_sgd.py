"""Stochastic gradient: one slot against a plain loop, several against their average."""

import numpy as np
import pytest

from tidewater.operators import sgd as S


@pytest.fixture(scope="module")
def examples(spark):
    draw = np.random.default_rng(2)
    x = np.concatenate([draw.normal(c, 1.0, (60, 3)) for c in ((0, 0, 0), (3, 0, 1), (0, 3, 3))])
    rows = [(i, v.tolist(), "abc"[i // 60]) for i, v in enumerate(x)]
    rows += [(900, None, "a"), (901, [1.0], "b"), (902, [1.0, 2.0, None], "c"), (903, [1.0, 2.0, 3.0], None)]
    return x, spark.createDataFrame(rows, "id int, v array<double>, label string").repartition(4)


def turns(spark, n, seed, epoch):
    from pyspark.sql import functions as F

    rows = spark.range(n).select("id", F.xxhash64(F.col("id").cast("string"), F.lit(seed), F.lit(epoch)).alias("t"), F.pmod(F.xxhash64(F.col("id").cast("string"), F.lit(seed)), F.lit(3)).alias("slot"))
    return {r.id: (r.t, r.slot) for r in rows.collect()}


@pytest.mark.parametrize("slots", [1, 3])
def test_epochs_are_plain_steps(spark, examples, slots):
    x, df = examples
    model = S.fit_sgd(df, "id", "v", "label", epochs=2, alpha=0.01, slot_rows=1000 if slots == 1 else 60, seed=5)
    z = np.column_stack([(x - x.mean(0)) / x.std(0), np.ones(len(x))])
    y = np.arange(180) // 60
    w, losses = np.zeros((3, 4)), []
    for epoch in range(2):
        at = turns(spark, 180, 5, epoch)
        losses.append(np.maximum(0, 1 - np.where(y[:, None] == np.arange(3), 1, -1) * (z @ w.T)).sum() / 180)
        parts = []
        for s in range(slots):
            mine = sorted((i for i in range(180) if slots == 1 or at[i][1] == s), key=lambda i: at[i][0])
            v = w.copy()
            for t, i in enumerate(mine, epoch * len(mine)):
                rate = 1 / (0.01 * (100 + t))
                for c in range(3):
                    sign = 1 if y[i] == c else -1
                    inside = sign * (v[c] @ z[i]) < 1
                    v[c, :3] *= 1 - rate * 0.01
                    if inside:
                        v[c] += rate * sign * z[i]
            parts.append((len(mine), v))
        w = sum(n * v for n, v in parts) / sum(n for n, _ in parts)
    assert np.allclose(model.weights, w) and np.allclose(model.losses, losses)


def test_loss_falls_and_reruns_agree(spark, examples):
    x, df = examples
    a = S.fit_sgd(df, "id", "v", "label", epochs=4, slot_rows=50)
    b = S.fit_sgd(df.repartition(2), "id", "v", "label", epochs=4, slot_rows=50)
    assert np.allclose(a.weights, b.weights) and a.losses[-1] < 0.6 * a.losses[0]
    rows = S.predict_sgd(df, "v", a).collect()
    assert sum(r.predicted == r.label for r in rows if r.id < 900) > 160
    assert {r.id for r in rows if r.predicted is None} == {900, 901, 902}
    none = spark.createDataFrame([], df.schema)
    empty = S.fit_sgd(none, "id", "v", "label")
    assert empty.classes == [] and S.predict_sgd(none, "v", empty).count() == 0

"""Reproducible shuffles, samples, splits and folds.

Randomness is the first 32 bits of md5 over "id:seed", so a retried task, another
partitioning or another engine yields the same answer, ids may be numbers or
strings of any length, and two seeds have nothing to do with each other.  Exact splits find the
hash value that cuts off the wanted number of rows by two rounds of counting;
no row is sorted or moved to rank it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewater.operators.relational import small
from tidewater.session import settle

HASH_RANGE = 1 << 32
BUCKET = 65536


def seeded_hash(id_col: Column, seed: int) -> Column:
    """Whole number in [0, 2^32) from all of the id; null for a null id."""
    digest = F.md5(F.concat(id_col.cast("string"), F.lit(f":{seed}")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def shuffled(df: DataFrame, id_col: str, seed: int) -> DataFrame:
    """Rows in an order that looks random and is the same on every run."""
    return df.orderBy(seeded_hash(F.col(id_col), seed), id_col)


def sampled(df: DataFrame, id_col: str, seed: int, fraction: float) -> DataFrame:
    """Each row kept on its own with the given chance.

    The draw is a hash of the id, so a re-run task keeps the same rows.
    """
    return df.filter(seeded_hash(F.col(id_col), seed) < F.lit(int(fraction * HASH_RANGE)))


def fold_of(id_col: Column, seed: int, folds: int) -> Column:
    return F.floor(seeded_hash(id_col, seed) * F.lit(folds) / F.lit(HASH_RANGE)).cast("int")


def split_counted(
    df: DataFrame,
    id_col: str,
    seed: int,
    fraction: float,
    strata: Sequence[str] = (),
    rounding: str = "floor",
) -> DataFrame:
    """Mark exactly floor/ceil(fraction * n) rows per stratum as train.

    The rows with the smallest (hash, id) are taken.  Counting by the upper 16
    hash bits finds the bucket where the target is crossed, counting inside the
    bucket finds the hash, and ids settle a tie on that very hash.
    """
    strata = list(strata)
    # a constant stratum lets the unstratified case share the plan
    keyed = df.withColumn("_all", F.lit(0)) if not strata else df
    by = strata or ["_all"]
    keyed = keyed.withColumn("_h", seeded_hash(F.col(id_col), seed))
    slim = keyed.select(*by, "_h", F.col(id_col).alias("_id"))
    to_whole = F.ceil if rounding == "ceil" else F.floor
    upto = W.partitionBy(*by).orderBy("_b").rowsBetween(W.unboundedPreceding, W.currentRow)

    def crossing(counts: DataFrame, target: Column) -> DataFrame:
        """First value of ``_b`` at which the running count reaches the target."""
        return (
            counts.withColumn("_cum", F.sum("_n").over(upto))
            .withColumn("_before", F.col("_cum") - F.col("_n"))
            .filter((F.col("_before") < target) & (F.col("_cum") >= target))
        )

    total = W.partitionBy(*by)
    coarse = slim.groupBy(*by, F.shiftright("_h", 16).alias("_b")).agg(F.count("*").alias("_n"))
    coarse = coarse.withColumn(
        "_want", to_whole(F.round(F.sum("_n").over(total) * F.lit(fraction), 6))
    )
    first = crossing(coarse, F.col("_want")).select(
        *by, F.col("_b").alias("_b1"), (F.col("_want") - F.col("_before")).alias("_want")
    )
    bucket = slim.withColumn("_b1", F.shiftright("_h", 16)).join(first, [*by, "_b1"])
    fine = bucket.groupBy(*by, "_want", F.col("_h").alias("_b")).agg(F.count("*").alias("_n"))
    second = crossing(fine, F.col("_want")).select(
        *by, F.col("_b").alias("_h"), (F.col("_want") - F.col("_before")).alias("_want")
    )
    tied = bucket.drop("_want", "_b1").join(second, [*by, "_h"])
    nth = W.partitionBy(*by).orderBy("_id")
    cut = (
        tied.withColumn("_r", F.row_number().over(nth))
        .filter(F.col("_r") == F.col("_want"))
        .select(*by, F.col("_h").alias("_cut_h"), F.col("_id").alias("_cut_id"))
    )
    # a row per stratum; once written, its size is known and no row need move
    cut = settle(cut, "cuts")
    inside = (F.col("_h") < F.col("_cut_h")) | (
        (F.col("_h") == F.col("_cut_h")) & (F.col(id_col) <= F.col("_cut_id"))
    )
    return (
        keyed.join(small(cut), by, "left")
        .withColumn("is_train", F.coalesce(inside, F.lit(False)))
        .drop("_all", "_h", "_cut_h", "_cut_id")
    )


def sample_keys(df: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """All rows of n distinct keys, the keys picked by hash."""
    chosen = df.select(key).distinct().orderBy(seeded_hash(F.col(key), seed), key).limit(n)
    return df.join(small(settle(chosen, "keys")), key, "left_semi")


def tail_holdout(df: DataFrame, order_col: str, round_size: int) -> DataFrame:
    """Mark the rows past the last full multiple of the round size.

    The tail has fewer rows than one round, so its first key comes from a
    top-k, not a full sort.
    """
    tail = df.count() % round_size
    if tail == 0:
        return df.withColumn("is_holdout", F.lit(False))
    cut = (
        df.select(order_col).orderBy(F.desc(order_col)).limit(tail).agg(F.min(order_col)).first()[0]
    )
    return df.withColumn("is_holdout", F.col(order_col) >= F.lit(cut))

"""Ordered operators: global positions, running sums, runs, bin edges.

A window over one hot key (or over no key) sorts that key in one task.  Each
operator here first looks at the largest group.  Up to ``GROUP_ROWS`` rows a
plain window is used; past it the rows are range-partitioned on (key, order),
so a hot key is spread over many blocks, and block totals carry the state from
one block to the next.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewater.session import settle

GROUP_ROWS = 5_000_000
_IN_PARTITION = (1 << 33) - 1


def largest_group(df: DataFrame, keys: Sequence[str]) -> int:
    n = df.groupBy(*keys).count().agg(F.max("count")).first()[0]
    return int(n or 0)


def row_slice(df: DataFrame, order: Sequence, first: int, last: int) -> DataFrame:
    """Rows ``first`` to ``last`` under a total order, counted from 1.

    A top-k of ``last`` rows; only those are numbered.
    """
    nth = F.row_number().over(W.orderBy(*order))
    head = df.orderBy(*order).limit(last)
    return head.withColumn("_nth", nth).filter(F.col("_nth") >= first).drop("_nth")


def with_position(df: DataFrame, order: Sequence, name: str = "row_idx") -> DataFrame:
    """Zero-based position of every row under a total order.

    One range shuffle and one write; the offsets table has a row per partition.
    """
    spark = df.sparkSession
    placed = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_mid", F.monotonically_increasing_id())
    )
    placed = settle(placed, "position")
    block = F.shiftright("_mid", 33)
    counts = placed.groupBy(block.alias("_blk")).count().orderBy("_blk").collect()
    offsets, seen = [], 0
    for row in counts:
        offsets.append((row["_blk"], seen))
        seen += row["count"]
    lookup = spark.createDataFrame(offsets, "_blk bigint, _off bigint")
    return (
        placed.withColumn("_blk", block)
        .join(F.broadcast(lookup), "_blk")
        .withColumn(name, F.col("_off") + F.col("_mid").bitwiseAND(F.lit(_IN_PARTITION)))
        .drop("_blk", "_off", "_mid")
    )


def _blocks(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    placed = df.repartitionByRange(*keys, *order).withColumn("_blk", F.spark_partition_id())
    return settle(placed, "blocks")


def running_sum(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: Column,
    name: str,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """Sum of ``value`` over each key's rows up to and including this one."""
    return running_sums(df, keys, order, {name: value}, group_rows)


def running_sums(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], values: dict[str, Column], group_rows: int = GROUP_ROWS
) -> DataFrame:
    """Several running sums over the same order, by the names of ``values``."""
    tmp = {name: f"_v{i}" for i, name in enumerate(values)}
    df = df.withColumns({tmp[name]: value for name, value in values.items()})
    upto = (W.unboundedPreceding, W.currentRow)
    if largest_group(df, keys) <= group_rows:
        w = W.partitionBy(*keys).orderBy(*order).rowsBetween(*upto)
        return df.withColumns({name: F.sum(v).over(w) for name, v in tmp.items()}).drop(*tmp.values())
    placed = _blocks(df, keys, order)
    inside = W.partitionBy("_blk", *keys).orderBy(*order).rowsBetween(*upto)
    earlier = W.partitionBy(*keys).orderBy("_blk").rowsBetween(W.unboundedPreceding, -1)
    totals = placed.groupBy("_blk", *keys).agg(*[F.sum(v).alias(f"_t{v}") for v in tmp.values()])
    carried = totals.withColumns({f"_c{v}": F.coalesce(F.sum(f"_t{v}").over(earlier), F.lit(0)) for v in tmp.values()})
    found = placed.withColumns({f"_in{v}": F.sum(v).over(inside) for v in tmp.values()}).join(carried, ["_blk", *keys])
    found = found.withColumns({name: F.col(f"_in{v}") + F.col(f"_c{v}") for name, v in tmp.items()})
    return found.drop("_blk", *[p + v for v in tmp.values() for p in ("", "_t", "_c", "_in")])


def with_previous(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    cols: Sequence[str],
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """``prev_<col>`` of the row before, per key; null on the first row."""
    df = df.withColumn("_row", F.struct(*cols))
    if largest_group(df, keys) <= group_rows:
        w = W.partitionBy(*keys).orderBy(*order)
        out = df.withColumn("_prev", F.lag("_row").over(w))
    else:
        placed = _blocks(df, keys, order)
        inside = W.partitionBy("_blk", *keys).orderBy(*order)
        last = (
            placed.groupBy("_blk", *keys)
            .agg(F.max_by("_row", F.struct(*order)).alias("_last"))
            .withColumn("_carry", F.lag("_last").over(W.partitionBy(*keys).orderBy("_blk")))
            .drop("_last")
        )
        out = (
            placed.withColumn("_in", F.lag("_row").over(inside))
            .join(last, ["_blk", *keys])
            .withColumn("_prev", F.coalesce("_in", "_carry"))
            .drop("_blk", "_in", "_carry")
        )
    return out.select(
        *[c for c in out.columns if c not in ("_row", "_prev")],
        *[F.col("_prev")[c].alias(f"prev_{c}") for c in cols],
    )


def running_score(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    hit: Column,
    up: float = 1.0,
    down: float = 0.8,
    name: str = "score",
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """Plus ``up`` for a hit, minus ``down`` otherwise, accumulated in order."""
    step = F.when(hit, F.lit(up)).otherwise(F.lit(-down))
    return running_sum(df, keys, order, step, name, group_rows)


def line_runs(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    colour: str,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """Split each group's ordered points into runs of one colour.

    A new run also starts with the last point of the run before, so drawn lines
    join up: that point appears in both runs, marked ``carried``.
    """
    others = [c for c in df.columns if c not in keys]
    prev = with_previous(df, keys, order, others, group_rows)
    turned = F.col(f"prev_{colour}").isNotNull() & (F.col(f"prev_{colour}") != F.col(colour))
    runs = running_sum(
        prev.withColumn("_turned", turned),
        keys,
        order,
        F.col("_turned").cast("bigint"),
        "run",
        group_rows,
    )
    own = F.struct(*[F.col(c) for c in others], F.lit(False).alias("carried"))
    back = F.struct(*[F.col(f"prev_{c}").alias(c) for c in others], F.lit(True).alias("carried"))
    points = F.when(F.col("_turned"), F.array(back, own)).otherwise(F.array(own))
    return runs.select(*keys, "run", F.explode(points).alias("_p")).select(*keys, "run", "_p.*")


def stacked_segments(df: DataFrame, category: str, series: str, value: str) -> DataFrame:
    """Each series' bar starts where the previous series of the category ended."""
    per = df.groupBy(category, series).agg(F.sum(value).alias("v"))
    w = W.partitionBy(category).orderBy(series).rowsBetween(W.unboundedPreceding, W.currentRow)
    return per.withColumn("hi", F.sum("v").over(w)).withColumn("lo", F.col("hi") - F.col("v"))


def bin_edges(bins: DataFrame, group: str, centre: str) -> DataFrame:
    """Edges half-way to the neighbours, mirrored at both ends of the group."""
    w = W.partitionBy(group).orderBy(centre)
    before, after, here = F.lag(centre).over(w), F.lead(centre).over(w), F.col(centre)
    return bins.withColumn(
        "lo", F.coalesce((here + before) / 2, here - (after - here) / 2)
    ).withColumn("hi", F.coalesce((here + after) / 2, here + (here - before) / 2))


def zip_rows(left: DataFrame, right: DataFrame, left_order: Sequence, right_order: Sequence) -> DataFrame:
    """Pair the n-th row of one frame with the n-th row of the other."""
    a = with_position(left, left_order)
    b = with_position(right, right_order)
    return a.join(b, "row_idx")


def dense_index(df: DataFrame, key: str, name: str = "idx") -> DataFrame:
    """Distinct keys numbered 1..n in key order."""
    return with_position(df.select(key).distinct(), [key], "_p").select(
        key, (F.col("_p") + 1).alias(name)
    )


def affine_join(
    left: DataFrame,
    right: DataFrame,
    left_index: tuple[int, int],
    right_index: tuple[int, int],
) -> DataFrame:
    """Rows ``left[a*i+b]`` beside ``right[c*i+d]`` for every whole i >= 0.

    Both frames carry ``row_idx``.  The index is solved for i on each side, so
    the access becomes one equi-join.
    """

    def solved(df: DataFrame, stride: int, shift: int) -> DataFrame:
        gap = F.col("row_idx") - F.lit(shift)
        fits = (gap >= 0) & (gap % stride == 0)
        return df.filter(fits).withColumn("i", (gap / F.lit(stride)).cast("bigint")).drop("row_idx")

    return solved(left, *left_index).join(solved(right, *right_index), "i")

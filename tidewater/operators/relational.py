"""Joins, aggregates and set operators as plain DataFrame plans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewater.functions.scalars import compound_names
from tidewater.session import size_in_bytes

BROADCAST_BYTES = 64 << 20


def small(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Ask for a broadcast only where the size estimate is under the limit.

    Past it the frame is returned as is and the join shuffles.
    """
    return F.broadcast(df) if size_in_bytes(df) <= limit else df


def drop_missing(df: DataFrame, cols: Sequence[str], markers: Sequence[str] = ("", "NA", "(NA)", "-")) -> DataFrame:
    """Drop every row in which a listed column is null or a missing marker."""
    keep = F.lit(True)
    for c in cols:
        keep = keep & F.col(c).isNotNull() & ~F.col(c).cast("string").isin(list(markers))
    return df.filter(keep)


def explode_compound(df: DataFrame, name_col: str) -> DataFrame:
    rest = [c for c in df.columns if c != name_col]
    return df.select(*rest, F.explode(compound_names(F.col(name_col))).alias("_c")).select(
        *rest, "_c.name", "_c.state"
    )


def yearly_mean(
    df: DataFrame, key: str, year: Column, value: str, lo: int, hi: int, periods: tuple[Column, Sequence] | None = None
) -> DataFrame:
    """Mean per (key, year) for a closed range of years.

    All period codes count unless ``periods`` names a column and its codes.
    """
    if periods is not None:
        df = df.filter(periods[0].isin(list(periods[1])))
    return (
        df.withColumn("year", year.cast("int"))
        .filter(F.col("year").between(lo, hi))
        .groupBy(key, "year")
        .agg(F.avg(value).alias("mean_value"))
    )


def joined_yearly_mean(
    facts: DataFrame, fact_key: str, date: str, value: str, lookup: DataFrame, group: str, lo: int, hi: int
) -> DataFrame:
    """Yearly mean by a group that a lookup gives for the fact key.

    The years are bounds on the stored date, so the scan can skip row groups.
    Sums and counts are taken per (key, year) before the join, so a key with a
    large share of the facts enters it as a few rows.
    """
    kind = facts.schema[date].dataType
    start, end = F.lit(f"{lo}-01-01").cast(kind), F.lit(f"{hi + 1}-01-01").cast(kind)
    per = (
        facts.filter((F.col(date) >= start) & (F.col(date) < end))
        .withColumn("year", F.year(date))
        .groupBy(fact_key, "year")
        .agg(F.sum(value).alias("_s"), F.count(value).alias("_n"))
    )
    return (
        per.join(lookup, fact_key)
        .groupBy(group, "year")
        .agg((F.sum("_s") / F.sum("_n")).alias("mean_value"))
    )


def align_years(df: DataFrame, key: str, years: Sequence[int], prefix: str) -> DataFrame:
    """One row per key with a column per year; keys short of a year drop out.

    One scan and one pivot stand for the several joins of filtered copies.
    """
    wide = df.groupBy(key).pivot("year", list(years)).agg(F.first("mean_value"))
    named = wide.select(key, *[F.col(str(y)).alias(f"{prefix}{y}") for y in years])
    return named.dropna()


def centroid(df: DataFrame, keys: Sequence[str], lat: str, lon: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.avg(lat).alias("lat"), F.avg(lon).alias("lon"))


def union_years(wide: DataFrame, key: str, prefix: str, years: Sequence[int]) -> DataFrame:
    """Stack the year columns of a wide frame: a union from a single scan."""
    pairs = F.array(
        *[F.struct(F.lit(y).alias("year"), F.col(f"{prefix}{y}").alias("value")) for y in years]
    )
    return wide.select(key, F.inline(pairs))


def partner_ranks(df: DataFrame, group: Sequence[str], id_col: str, group_rows: int | None = None) -> DataFrame:
    """Same-group pairs in compact form.

    A row of rank r stands for the r pairs (this row, each row of lower id);
    the ranks of a group of n add up to its n(n-1)/2 unordered pairs.  Output
    is one row per input row however large the group is.
    """
    from tidewater.operators.ordered import GROUP_ROWS, running_sum

    ranked = running_sum(df, group, [id_col], F.lit(1), "_nth", group_rows or GROUP_ROWS)
    return ranked.withColumn("partners", F.col("_nth") - 1).drop("_nth")


def pair_counts(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """How many ordered and unordered pairs a product would hold."""
    n = F.col("n")
    return (
        df.groupBy(*keys)
        .agg(F.count("*").alias("n"))
        .withColumn("ordered_pairs", n * n)
        .withColumn("unordered_pairs", (n * (n - 1) / 2).cast("bigint"))
    )


def moments(df: DataFrame, keys: Sequence[str], value: Column) -> DataFrame:
    """Count, sum and sum of squares: the mergeable form of mean and variance."""
    v = value.cast("double")
    return df.groupBy(*keys).agg(
        F.count(v).alias("n"), F.sum(v).alias("sx"), F.sum(v * v).alias("sxx")
    )


def merge_moments(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Merge summaries (n, mean, var_pop) of one key into one summary."""
    n, mean, var = F.col("n"), F.col("mean"), F.col("var_pop")
    total = F.sum("n")
    return (
        parts.groupBy(*keys)
        .agg(
            total.alias("n"),
            (F.sum(n * mean) / total).alias("mean"),
            (F.sum(n * (var + mean * mean)) / total).alias("_m2"),
        )
        .withColumn("var_pop", F.greatest(F.col("_m2") - F.col("mean") * F.col("mean"), F.lit(0.0)))
        .drop("_m2")
    )


def mode_share(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Most frequent value per key, ties to the smallest, and its share."""
    counts = df.groupBy(*keys, value).agg(F.count("*").alias("_n"))
    best = F.min_by(F.struct(value, "_n"), F.struct(-F.col("_n"), F.col(value)))
    return (
        counts.groupBy(*keys)
        .agg(best.alias("_b"), F.sum("_n").alias("_all"))
        .select(
            *keys,
            F.col("_b")[value].alias("mode"),
            (F.col("_b._n") / F.col("_all")).alias("share"),
        )
    )


def column_vector_stats(df: DataFrame, array_col: str) -> DataFrame:
    return (
        df.select(F.posexplode(array_col).alias("pos", "x"))
        .groupBy("pos")
        .agg(
            F.sum(F.col("x").cast("double")).alias("total"),
            F.max("x").alias("hi"),
            F.min("x").alias("lo"),
        )
    )


def adjacency(edges: DataFrame, src: str, dst: str, max_list: int = 100_000) -> DataFrame:
    """Sorted set of targets per source.

    A source with more than ``max_list`` targets is spread over several rows
    (``chunk`` 0, 1, ...), so no list outgrows a task and none is cut short.
    """
    distinct = edges.select(src, dst).distinct()
    degree = distinct.groupBy(src).agg(F.ceil(F.count("*") / F.lit(max_list)).alias("_chunks"))
    placed = distinct.join(degree, src).withColumn("chunk", F.pmod(F.xxhash64(dst), F.col("_chunks")))
    return placed.groupBy(src, "chunk").agg(
        F.count("*").alias("n_links"), F.sort_array(F.collect_list(dst)).alias("links")
    )

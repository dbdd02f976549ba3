"""The aggregates behind charts.  Nothing is drawn here."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewater.session import settle


def scatter_frame(df: DataFrame, series: Column, x: Column, y: Column, colour: Column, size: Column, keep: Sequence[str] = ()) -> DataFrame:
    return df.select(
        *keep, series.alias("series"), x.cast("double").alias("x"), y.cast("double").alias("y"),
        colour.alias("colour"), size.cast("double").alias("size"),
    )


def error_bars(df: DataFrame, x: str, y: str, ex: Column, ey: Column) -> DataFrame:
    return (
        df.withColumn("x_lo", F.col(x) - ex).withColumn("x_hi", F.col(x) + ex)
        .withColumn("y_lo", F.col(y) - ey).withColumn("y_hi", F.col(y) + ey)
    )


def axis_extent(frames: Sequence[tuple[str, DataFrame, str, Column]]) -> DataFrame:
    """(axis, lo, hi) over all series on an axis, widened by their errors.

    Each entry is (axis, frame, column, error).  An axis without values is 0..0.
    """
    parts = None
    for axis, df, col, err in frames:
        part = df.agg(F.min(F.col(col) - err).alias("lo"), F.max(F.col(col) + err).alias("hi"))
        part = part.select(F.lit(axis).alias("axis"), "lo", "hi")
        parts = part if parts is None else parts.unionByName(part)
    zero = F.lit(0.0)
    return parts.groupBy("axis").agg(
        F.coalesce(F.min("lo"), zero).alias("lo"), F.coalesce(F.max("hi"), zero).alias("hi")
    )


def bar_frame(df: DataFrame, category: str, series: str, value: Column, stacked: bool) -> DataFrame:
    """(category, series, v, lo, hi): bars side by side start at zero, stacked
    ones where the series before ended."""
    per = df.groupBy(F.col(category).alias("category"), F.col(series).alias("series")).agg(F.sum(value).alias("v"))
    if not stacked:
        return per.withColumn("lo", F.least(F.col("v"), F.lit(0.0))).withColumn("hi", F.greatest(F.col("v"), F.lit(0.0)))
    w = W.partitionBy("category").orderBy("series").rowsBetween(W.unboundedPreceding, W.currentRow)
    return per.withColumn("hi", F.sum("v").over(w)).withColumn("lo", F.col("hi") - F.col("v"))


def bar_extent(bars: DataFrame, stacked: bool) -> DataFrame:
    """Value range of a bar chart: of category sums if stacked, else of values."""
    if stacked:
        bars = bars.groupBy("category").agg(F.sum("v").alias("v"))
    return bars.agg(F.min("v").alias("lo"), F.max("v").alias("hi"))


def histogram_bins(df: DataFrame, value: str, lo: float, width: float, series: str | None = None) -> DataFrame:
    """Counts per bin and series over the extent of the data; empty bins show.

    Bins are half open and numbered from ``lo``, below which the numbers are
    negative.  Rows are counted by bin first; the grid of bins is joined after.
    """
    name = F.col(series) if series else F.lit("all")
    pos = F.floor((F.col(value) - F.lit(lo)) / F.lit(width))
    counts = settle(
        df.select(name.alias("series"), pos.cast("bigint").alias("bin")).filter("bin is not null").groupBy("series", "bin").agg(F.count("*").alias("n")),
        "bins",
    )
    extent = counts.agg(F.min("bin").alias("_lo"), F.max("bin").alias("_hi"))
    grid = counts.select("series").distinct().join(F.broadcast(extent)).select("series", F.explode(F.sequence("_lo", "_hi")).alias("bin"))
    full = grid.join(counts, ["series", "bin"], "left").na.fill(0, ["n"])
    edge = F.lit(lo) + F.col("bin") * F.lit(width)
    w = W.partitionBy("bin").orderBy("series").rowsBetween(W.unboundedPreceding, W.currentRow)
    top = F.sum("n").over(w)
    return full.select(
        "series", "bin", edge.alias("edge_lo"), (edge + F.lit(width)).alias("edge_hi"), "n",
        (top - F.col("n")).alias("stack_lo"), top.alias("stack_hi"),
    )


def panel_frames(df: DataFrame, row: str, col: str, x: str, y: str, share_y_by_row: bool = True) -> DataFrame:
    """One row per panel with its point count and the axes it uses: x is shared
    by all panels, y by all or by the panels of one row."""
    panels = df.groupBy(F.col(row).alias("panel_row"), F.col(col).alias("panel_col")).agg(
        F.count("*").alias("n"), F.min(x).alias("_x0"), F.max(x).alias("_x1"), F.min(y).alias("_y0"), F.max(y).alias("_y1")
    )
    # from here on a row per panel
    per_axis = panels.groupBy("panel_row") if share_y_by_row else panels.groupBy()
    ys = per_axis.agg(F.min("_y0").alias("y_lo"), F.max("_y1").alias("y_hi"))
    xs = panels.agg(F.min("_x0").alias("x_lo"), F.max("_x1").alias("x_hi"))
    out = panels.select("panel_row", "panel_col", "n")
    if share_y_by_row:
        out = out.join(ys, "panel_row")
    else:
        out = out.withColumn("y_lo", ys.select("y_lo").scalar()).withColumn("y_hi", ys.select("y_hi").scalar())
    return out.withColumn("x_lo", xs.select("x_lo").scalar()).withColumn("x_hi", xs.select("x_hi").scalar())

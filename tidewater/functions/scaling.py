"""Column scaling: extents by one small aggregate, then plain arithmetic."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _float_columns(df: DataFrame) -> list[str]:
    return [c for c, t in df.dtypes if t in ("double", "float")]


def _scaled(df: DataFrame, shift: dict, spread: dict, digits: int | None) -> DataFrame:
    out = df
    for c in shift:
        value = F.try_divide(F.col(c) - F.lit(shift[c]), F.lit(spread[c]))
        out = out.withColumn(c, value if digits is None else F.round(value, digits))
    return out


def scale_minmax(df: DataFrame, digits: int | None = None) -> DataFrame:
    """Floating columns to [0, 1]; whole-number columns stay.  A constant
    column becomes null."""
    cols = _float_columns(df)
    row = df.agg(*[F.min(c).alias(f"lo_{c}") for c in cols], *[F.max(c).alias(f"hi_{c}") for c in cols]).first()
    lo = {c: row[f"lo_{c}"] for c in cols}
    return _scaled(df, lo, {c: (row[f"hi_{c}"] or 0.0) - (lo[c] or 0.0) for c in cols}, digits)


def scale_zscore(df: DataFrame, digits: int | None = None) -> DataFrame:
    """Floating columns to zero mean and unit sample deviation."""
    cols = _float_columns(df)
    row = df.agg(
        *[F.avg(c).alias(f"m_{c}") for c in cols], *[F.stddev_samp(c).alias(f"s_{c}") for c in cols]
    ).first()
    return _scaled(df, {c: row[f"m_{c}"] for c in cols}, {c: row[f"s_{c}"] for c in cols}, digits)

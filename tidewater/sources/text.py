"""Line, delimited, XML and message sources.

Schemas are given, never inferred, so a read needs no extra pass over the data.
Paths are parameters; credentials belong to the cluster's file-system settings.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("lineSep", "\n").text(path)


def typed_lines(
    spark: SparkSession,
    path: str,
    fields: Mapping[str, tuple[int, str]],
    header: str,
    delim: str = "\t",
    drop_if_contains: str | None = None,
) -> DataFrame:
    """Delimited lines to typed columns, chosen by position and trimmed.

    Lines that contain the header marker go; so do lines that hold the missing
    marker anywhere.  A field that is no such value becomes null.
    """
    lines = text_lines(spark, path).filter(~F.contains("value", F.lit(header)))
    if drop_if_contains:
        lines = lines.filter(~F.contains("value", F.lit(drop_if_contains)))
    cells = F.split("value", delim, -1)
    return lines.select(
        *[F.trim(F.get(cells, F.lit(i))).try_cast(t).alias(n) for n, (i, t) in fields.items()]
    )


def delimited(
    spark: SparkSession,
    path: str,
    schema: str,
    header: bool = False,
    sep: str = ",",
    encoding: str = "UTF-8",
    trim: bool = True,
) -> DataFrame:
    """Quoted delimited text under a given schema; bad fields become null."""
    return (
        spark.read.schema(schema)
        .option("header", header)
        .option("sep", sep)
        .option("encoding", encoding)
        .option("quote", '"')
        .option("escape", '"')
        .option("mode", "PERMISSIVE")
        .option("ignoreLeadingWhiteSpace", trim)
        .option("ignoreTrailingWhiteSpace", trim)
        .csv(path)
    )


def positions(df: DataFrame, lo: int, hi: int) -> DataFrame:
    """Columns lo..hi by one-based position; pruning reaches the scan."""
    return df.select(*df.columns[lo - 1 : hi])


def labelled_lines(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """One file set per class: every non-empty line is a lower-cased document."""
    out = None
    for label, path in paths.items():
        part = text_lines(spark, path).select(F.lower("value").alias("text"), F.lit(label).alias("label"))
        out = part if out is None else out.unionByName(part)
    return out.filter(F.col("text") != "")


def corpus(spark: SparkSession, root: str) -> DataFrame:
    """Corpus by class folder, one sentence per line.  The class is the name of the
    folder under the root; tag ``cvNNN`` in the path is fold NNN div 100 + 1."""
    path = F.col("_metadata.file_path")
    folder = root.rstrip("/").rsplit("/", 1)[-1]
    lines = spark.read.option("recursiveFileLookup", True).option("lineSep", "\n").text(root)
    return lines.select(
        F.col("value").alias("sentence"),
        F.regexp_extract(path, rf"/\Q{folder}\E/([^/]+)/", 1).alias("label"),
        F.floor(F.regexp_extract(path, r"cv([0-9]{3})", 1).cast("int") / 100 + 1).cast("int").alias("fold"),
    )


def xml_rows(spark: SparkSession, path: str, row_tag: str, schema: str) -> DataFrame:
    return spark.read.format("xml").option("rowTag", row_tag).schema(schema).load(path)


def file_inventory(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """Path, size and time of every file under a root; contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob)
        .load(root)
        .select("path", "length", "modificationTime")
    )


def write_csv(df: DataFrame, path: str, header: bool = True, single_file: bool = False) -> None:
    """Partitioned by default; one file only for results known to be small."""
    out = df.coalesce(1) if single_file else df
    out.write.option("header", header).option("quote", '"').option("escape", '"').csv(path)


def append_column(
    spark: SparkSession, src: str, dst: str, schema: str, name: str, value: Column, keep: Sequence[str] | None = None
) -> DataFrame:
    """CSV in, the same rows with one more column out; the result is read back."""
    df = delimited(spark, src, schema, header=True).withColumn(name, value)
    if keep:
        df = df.select(*keep, name)
    write_csv(df, dst)
    return spark.read.schema(df.schema).option("header", True).csv(dst)

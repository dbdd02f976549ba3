"""Structured Streaming flows.

Each flow takes a streaming frame, so the source is the caller's: files in
tests, a message bus in use.  Recovery is the checkpoint's, and the rate is set
on the source (``maxFilesPerTrigger`` or ``maxOffsetsPerTrigger``).  A trigger's
rows are bounded by that rate, and so is any one key's share of them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidewater.operators.bayes import cumulate_rounds, finish_moments

SCORE_SCHEMA = "event_id bigint, n bigint, score double"


def file_stream(spark: SparkSession, path: str, schema: str, fmt: str = "parquet", files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema).format(fmt)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def drain(out: DataFrame, sink: str, checkpoint: str, fmt: str = "parquet") -> None:
    """Append what has arrived so far to a file sink, and stop."""
    q = (
        out.writeStream.outputMode("append").format(fmt).option("path", sink)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    q.awaitTermination()


def confident(messages: DataFrame, raw: str, field: str, score: Callable[[DataFrame], DataFrame], at_least: float) -> DataFrame:
    """Message text if present, scored, and kept from a confidence upward.

    Stateless, so it is the same plan on a stream and on a table.
    """
    text = messages.withColumn("text", F.get_json_object(raw, f"$.{field}")).filter(F.col("text").isNotNull())
    return score(text).filter(F.col("confidence") >= at_least)


def running_score(events: DataFrame, key: str, order: Sequence[str], hit: Column, up: float = 1.0, down: float = 0.8) -> DataFrame:
    """Score after every event, per key, with (count, score) as the state.

    Within a trigger a key's events are put in order; triggers follow arrival.
    """
    order = list(order)

    def step(found: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        n, score = state.get if state.exists else (0, 0.0)
        rows = pd.concat(list(batches)).sort_values(order)
        if len(rows):
            total = score + rows["_step"].cumsum()
            count = range(n + 1, n + 1 + len(rows))
            state.update((n + len(rows), float(total.iloc[-1])))
            yield pd.DataFrame({key: found[0], "event_id": rows["event_id"], "n": list(count), "score": total})

    marked = events.withColumn("_step", F.when(hit, F.lit(up)).otherwise(F.lit(-down)))
    return marked.groupBy(key).applyInPandasWithState(
        step, f"{key} bigint, {SCORE_SCHEMA}", "n bigint, score double", "append", GroupStateTimeout.NoTimeout
    )


def moments_writer(label: str, features: Sequence[str], store: str) -> Callable[[DataFrame, int], None]:
    """foreachBatch function: one small table of sums per batch.

    The batch number is the folder, so a batch that is run again replaces its
    own sums and nothing is counted twice.
    """

    def write(batch: DataFrame, number: int) -> None:
        cells = F.posexplode(F.array(*[F.col(c).cast("double") for c in features]))
        per = (
            batch.select(F.col(label).alias("label"), cells)
            .groupBy("label", F.col("pos").alias("feature"))
            .agg(F.count("col").alias("n"), F.sum("col").alias("sx"), F.sum(F.col("col") * F.col("col")).alias("sxx"))
        )
        per.write.mode("overwrite").parquet(f"{store}/round={number}")

    return write


def train_on_stream(rows: DataFrame, label: str, features: Sequence[str], store: str, checkpoint: str) -> None:
    """Fold what has arrived so far into the stored sums, and stop."""
    q = (
        rows.writeStream.foreachBatch(moments_writer(label, features, store))
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    q.awaitTermination()


def stored_rounds(spark: SparkSession, store: str) -> DataFrame:
    """Parameters after every batch, from the stored sums."""
    per = spark.read.parquet(store).withColumn("round", F.col("round").cast("bigint"))
    return finish_moments(cumulate_rounds(per.select("round", "label", "feature", "n", "sx", "sxx")))

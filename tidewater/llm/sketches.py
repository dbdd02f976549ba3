"""Near-duplicate documents by bottom-k sketches of one hash function.

A document's set is its distinct five-word shingles.  The k smallest hashes of
the set are its sketch.  Inverted lists of the sketch values say which documents
overlap; of a sketch only the rarest values are listed, as many as two documents
must share one of if half their sketches agree.  The k smallest values of two
sketches together estimate the resemblance, and pairs that pass are confirmed on
their full sets.  Equal sets are one class from the start and are compared once.

Null texts and texts without a word have an empty set and no links.  Rows that
share an id are one document with several texts.  A row without an id is kept
and linked with nothing; its component is null.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import WordHashes, hash_words, lists, mix, pieces, raw, rolled
from tidewater.llm.linking import SLACK, by_jaccard, confirmed_components, least_agreement
from tidewater.operators.relational import small
from tidewater.session import settle, spread

WIDTH = 5
PERCENT = 75
KEEP = 96
# Shared rare values that make a pair a candidate: more of them rule out pairs
# that agree on frequent values alone.
NEED = 8


def shingle_set(text: bytes | None, width: int, seen: WordHashes) -> np.ndarray:
    """Sorted hashes of the distinct shingles; a shorter text is one shingle."""
    words = text.lower().split() if text else []
    if not words:
        return np.zeros(0, dtype=np.int64)
    return np.unique(mix(rolled(hash_words(words, seen), min(width, len(words)))).view(np.int64))


def _sketch(width: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = WordHashes()
        for batch in batches:
            for part in pieces(batch):
                sets = [shingle_set(t, width, seen) for t in raw(part.column(1))]
                once = [mix(s.view(np.uint64), 1) for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([int(o.sum().view(np.int64)) for o in once], pa.int64()),
                        pa.array([int(np.bitwise_xor.reduce(mix(o, 2)).view(np.int64)) for o in once], pa.int64()),
                        lists([s[:k] for s in sets], pa.int64()),
                    ],
                    names=["id", "n", "p1", "p2", "sketch"],
                )

    return run


def _sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = WordHashes()
        for batch in batches:
            for part in pieces(batch, 64):
                sets = [shingle_set(t, width, seen) for t in raw(part.column(1))]
                yield pa.RecordBatch.from_arrays([part.column(0), lists(sets, pa.int64())], names=["id", "items"])

    return run


def least_common(s: int, share: float, k: int) -> int:
    """Values that a sketch of s has in common with that of any set of resemblance ``share``.

    A set of s < k is its own sketch, but the other may have more than k and keep
    its k smallest only: of t shared ones as many as chance puts among those k.
    """
    if s >= k:
        return math.ceil(s * least_agreement(share, k) - 1e-9)
    least = math.ceil(s * share - 1e-9)
    for n in range(k + 1, math.floor(s / share + 1e-9) + 1):
        t = min(s, math.ceil(share * (s + n) / (1 + share) - 1e-9))
        p = t / n
        bound = math.floor(k * p - SLACK * (k * p * (1 - p) * (n - k) / (n - 1)) ** 0.5)
        least = min(least, max(bound, t - (n - k)))
    return least


def overlap_lists(sketches: DataFrame, share: float, k: int, need: int = NEED) -> DataFrame:
    """(key, id, need): the rarest sketch values, each with the documents that keep it.

    Two sketches of s values that have t of them in common share c of the first
    s - t + c values of either, in the order of frequency.  Values of a single
    document come first in that order and list nobody.
    """
    rows = sketches.select("id", F.size("sketch").alias("s"), F.explode("sketch").alias("v"))
    often = rows.groupBy("v").agg(F.count("*").alias("f")).filter("f > 1")
    own = rows.join(often, "v").groupBy("id", "s").agg(F.sort_array(F.collect_list(F.struct("f", "v"))).alias("vs"))
    common = F.get(F.array(*[F.lit(least_common(s, share, k)) for s in range(k + 1)]), F.col("s"))
    own = own.withColumn("common", common).withColumn("need", F.least(F.lit(need), "common"))
    first = own.withColumn("room", F.size("vs") - F.col("common") + F.col("need")).filter("room > 0")
    return first.select("id", "need", F.explode(F.slice("vs", F.lit(1), F.col("room"))).alias("x")).select(
        F.col("x.v").alias("key"), "id", "need"
    )


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, percent: int = PERCENT, k: int = KEEP
) -> DataFrame:
    """(id, n_shingles, component_id, kept), a row for each document.

    Two documents are linked when 100 * shared shingles >= percent * shingles of
    either.  component_id is the smallest id reached over links; that document is
    the one kept.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    spec = "id bigint, n bigint, p1 bigint, p2 bigint, sketch array<bigint>"
    facts = settle(spread(texts).mapInArrow(_sketch(width, k), spec), "sketches")
    able = facts.filter("id is not null and n > 0")
    classes = settle(able.groupBy("n", "p1", "p2").agg(F.min("id").alias("rep")), "classes")
    reps = able.join(small(classes), ["n", "p1", "p2"]).filter("id = rep").select("id", "n", "sketch").distinct()
    shared = settle(overlap_lists(reps, percent / 100, k).dropDuplicates(["key", "id"]), "overlaps")
    able_ids = settle(shared.select("id").distinct(), "ids")
    sets = settle(texts.join(small(able_ids), "id", "left_semi").mapInArrow(_sets(width), "id bigint, items array<bigint>"), "sets")

    # an id with several texts ties their classes together
    several = able.join(small(classes), ["n", "p1", "p2"]).groupBy("id").agg(F.min("rep").alias("a"), F.max("rep").alias("b"))
    tied = settle(several.filter("a < b").select("a", "b"), "tied")
    facts_of = settle(reps.join(small(able_ids), "id", "left_semi").select("id", F.col("n").alias("m"), "sketch"), "able")

    def sets_of(ids: DataFrame) -> DataFrame:
        return sets.join(small(ids), "id", "left_semi")

    found = confirmed_components(shared, by_jaccard(facts_of, sets_of, percent, k), tied)
    placed = facts.join(classes, ["n", "p1", "p2"], "left").join(found, F.col("rep") == F.col("node"), "left")
    component = F.when(F.col("n") > 0, F.coalesce("component", "rep", "id")).otherwise(F.col("id"))
    return placed.select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        F.when(F.col("id").isNotNull(), component).alias("component_id"),
        F.when(F.col("id").isNotNull(), F.col("id") == component).otherwise(True).alias("kept"),
    )


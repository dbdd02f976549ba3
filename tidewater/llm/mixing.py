"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source gets the same expected number of copies.  The whole
part is certain.  The fractional parts are settled in pairs: mass, counted in
words, moves at random from one document to the other until one of the two is
integral.  A chunk of documents leaves at most one fractional document; the
residuals of the chunks meet in the next level of a reduction tree.  Words are
moved, not copies, so a source's expected words are kept exactly until its last
residual, which one draw settles.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewater.llm.common import WORD, unit_draw
from tidewater.operators.relational import small
from tidewater.session import settle

CHUNK = 4096
FAN_IN = 64
NEAR = 1e-9


def with_words(docs: DataFrame, text: str = "text", name: str = "size") -> DataFrame:
    """Number of words of the whole text; 0 for null."""
    return docs.withColumn(name, F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long"))


def source_targets(
    sizes: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, most: float = 2.0
) -> DataFrame:
    """(source, source_size, target) from rows of (source, size).

    Sources by code point, null last, take the weights in turn.  ``share`` of all
    words is dealt by weight; a target stops at ``most`` times its source and
    the excess goes to the others by weight.  The windows run over one row for
    each source, not over documents.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    everyone = W.partitionBy()
    rank = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(rank, F.lit(len(weights))) + 1).cast("int"))
    dealt = (
        totals.withColumn("_w", weight)
        .withColumn("_cap", F.col("source_size") * F.lit(float(most)))
        .withColumn("_all", F.sum("source_size").over(everyone) * F.lit(float(share)))
        .withColumn("_ratio", F.col("_cap") / F.col("_w"))
    )
    before = W.orderBy("_ratio", F.col("source").asc_nulls_last()).rowsBetween(W.unboundedPreceding, -1)
    rest = W.orderBy("_ratio", F.col("source").asc_nulls_last()).rowsBetween(W.currentRow, W.unboundedFollowing)
    level = (F.col("_all") - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))) / F.sum("_w").over(rest)
    leveled = dealt.withColumn("_level", level)
    cut = F.min(F.when(F.col("_ratio") > F.col("_level"), F.struct("_ratio", F.col("source").isNull(), "source", "_level"))).over(everyone)
    leveled = leveled.withColumn("_cut", cut)
    return leveled.select(
        "source",
        "source_size",
        F.when(F.col("_cut").isNull(), F.col("_cap"))
        .otherwise(F.least(F.col("_cap"), F.col("_w") * F.col("_cut._level")))
        .alias("target"),
    )


def pivot_chunk(size: np.ndarray, part: np.ndarray, draw: np.ndarray) -> tuple[np.ndarray, int]:
    """Round fractions to 0 or 1, keeping sum(size * part); at most one stays.

    Returns the settled fractions and the place of the one left over, or -1.
    """
    part = part.copy()
    open_at = -1
    for j in range(len(part)):
        if part[j] <= NEAR or part[j] >= 1 - NEAR:
            part[j] = round(part[j])
            continue
        if open_at < 0:
            open_at = j
            continue
        i = open_at
        up = min((1 - part[i]) * size[i], part[j] * size[j])
        down = min(part[i] * size[i], (1 - part[j]) * size[j])
        moved = up if draw[j] * (up + down) < down else -down
        part[i] += moved / size[i]
        part[j] -= moved / size[j]
        for k in (i, j):
            if part[k] <= NEAR or part[k] >= 1 - NEAR:
                part[k] = round(part[k])
        open_at = next((k for k in (i, j) if 0 < part[k] < 1), -1)
    return part, open_at


def _settle_chunk(frame: pd.DataFrame) -> pd.DataFrame:
    # large documents first, so that what is left over tends to be small
    frame = frame.sort_values(["size", "_order", "doc_id"], ascending=[False, True, True]).reset_index(drop=True)
    weight = (frame["size"] * frame["_rows"]).to_numpy(dtype=float)
    part, left = pivot_chunk(weight, frame["_part"].to_numpy(dtype=float), frame["_draw"].to_numpy())
    frame["_part"] = part
    frame["_open"] = np.arange(len(frame)) == left
    return frame[["doc_id", "source", "size", "_rows", "_base", "_part", "_chunk", "_open"]]


def mixed(
    sizes: DataFrame,
    weights: Sequence[float] = (3, 1, 2),
    share: float = 1.5,
    most: float = 2.0,
    seed: int = 0,
    chunk: int = CHUNK,
) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies, n_rows) for rows of (doc_id, source, size).

    Rows equal in all three columns are one unit of ``n_rows`` rows and share
    their draw.  Documents without words carry no mass; each draws on its own.
    Null ids and null sources are values like any other.  A document's copies
    are the floor or the ceiling of its source's target over its size.
    """
    sizes = settle(sizes.select("doc_id", "source", "size"), "sizes")  # the words are counted once
    targets = settle(source_targets(sizes, weights, share, most), "targets")
    units = sizes.groupBy("doc_id", "source", "size").agg(F.count("*").alias("_rows"))
    counts = units.groupBy(F.col("source").alias("_counted")).agg(F.count("*").alias("_n"))
    deal = targets.join(counts, F.col("source").eqNullSafe(F.col("_counted")))
    deal = settle(
        deal.select(
            F.col("source").alias("_source"), "source_size", "target",
            F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0).alias("_copies"),
            F.ceil(F.col("_n") / F.lit(chunk)).cast("long").alias("_chunks"),
        ),
        "deal",
    )
    most_chunks = deal.agg(F.max("_chunks")).first()[0] or 0
    keyed = units.join(small(deal), F.col("source").eqNullSafe(F.col("_source"))).select(
        "doc_id", "source", "size", "_rows",
        F.floor("_copies").cast("int").alias("_base"),
        (F.col("_copies") - F.floor("_copies")).alias("_part"),
        F.pmod(F.xxhash64("doc_id", "source", "size", F.lit(seed)), F.col("_chunks")).alias("_chunk"),
    )
    spec = "doc_id bigint, source string, size bigint, _rows bigint, _base int, _part double, _chunk bigint, _open boolean"
    alone = keyed.filter("size = 0").withColumn(
        "_part", (unit_draw(F.col("doc_id"), F.col("source"), F.lit(seed), F.lit(-1)) < F.col("_part")).cast("double")
    )
    done = [alone.select("doc_id", "source", "size", "_rows", "_base", "_part")]
    now, level = keyed.filter("size > 0"), 0
    while True:
        drawn = now.withColumn("_order", F.xxhash64("doc_id", "source", "size", F.lit(seed), F.lit(level)))
        drawn = drawn.withColumn("_draw", unit_draw(F.col("_order"), F.lit(seed)))
        out = settle(drawn.groupBy("source", "_chunk").applyInPandas(_settle_chunk, spec), f"pivot{level}")
        done.append(out.filter("not _open").select("doc_id", "source", "size", "_rows", "_base", "_part"))
        now = out.filter("_open").drop("_open").withColumn("_chunk", F.floor(F.col("_chunk") / FAN_IN).cast("long"))
        if most_chunks <= 1:
            break
        most_chunks, level = -(-most_chunks // FAN_IN), level + 1
    last = unit_draw(F.col("doc_id"), F.col("source"), F.col("size"), F.lit(seed), F.lit(-2)) < F.col("_part")
    done.append(now.select("doc_id", "source", "size", "_rows", "_base", last.cast("double").alias("_part")))
    every = done[0]
    for d in done[1:]:
        every = every.unionByName(d)
    dealt = small(deal.select("_source", "source_size", "target"))
    return every.join(dealt, F.col("source").eqNullSafe(F.col("_source"))).select(
        "doc_id", "source", "size", "source_size", "target",
        (F.col("_base") + F.col("_part")).cast("int").alias("copies"), F.col("_rows").alias("n_rows"),
    )


def mix_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every document as often as its copies say, columns as given."""
    rows = docs.select("doc_id", "source", "text", F.struct("*").alias("row"))
    sized = with_words(rows).drop("text")
    copies = settle(mixed(sized.select("doc_id", "source", "size"), **options).filter("copies > 0"), "copies")
    copies = copies.select(F.col("doc_id").alias("_id"), F.col("source").alias("_src"), F.col("size").alias("_size"), "copies")
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & F.col("source").eqNullSafe(F.col("_src")) & (F.col("size") == F.col("_size"))
    taken = sized.join(small(copies), same).withColumn("nth", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return taken.select("row.*")

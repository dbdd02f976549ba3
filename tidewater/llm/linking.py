"""Components of a similarity that is confirmed pair by pair, without all pairs.

Candidates come as lists: two items may be similar only if they share a list.
In a round a hash of the items, the same in every list, draws pivots, so few that
holding all items of other components against them makes a bounded number of
pairs for each row.  Confirmed pairs merge components; a pivot has then met
everybody and leaves.  Pairs inside a component need no check.  Once the pairs
between components are few beside the rows, or a round has hardly merged
anything, what is left is checked pair by pair: no candidate is ever skipped.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.operators.components import components
from tidewater.operators.relational import small
from tidewater.session import settle

PAIRS_A_ROW = 12
ROUNDS = 6
DRAWS = 1 << 20
# Standard deviations that the agreement of two sketches may fall short of the
# resemblance: at 0.75 and 96 values, 58 values, missed with a chance of 3e-4;
# at 0.8 of 1e-6.  A set no larger than a sketch is compared as a whole.
SLACK = 3.4
# A round that leaves more than this share of the pairs open was the last with pivots.
SLOW = 0.8


def _cross(rows: DataFrame) -> tuple[int, int]:
    """Pairs of different components that share a list, and rows of such lists."""
    groups = rows.groupBy("key", "c").agg(F.count("*").alias("n"))
    by_key = groups.groupBy("key").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("sq"), F.count("*").alias("m"))
    open_keys = by_key.filter("m > 1")
    pairs, n = open_keys.agg(F.sum((F.col("n") * F.col("n") - F.col("sq")) / 2), F.sum("n")).first()
    return int(pairs or 0), int(n or 0)


def least_agreement(share: float, k: int) -> float:
    """Share of the values of a full sketch that two sets of resemblance ``share`` have in common."""
    return max(0.0, share - SLACK * (share * (1 - share) / k) ** 0.5)


def by_jaccard(
    sketches: DataFrame, sets_of: Callable[[DataFrame], DataFrame], percent: int, k: int
) -> Callable[[DataFrame], DataFrame]:
    """Confirms pairs whose sets share ``percent`` of all their items.

    ``sketches`` holds (id, m, sketch), the size of a set and its k smallest
    hashes; ``sets_of`` gives (id, items), the whole sets of a frame of ids.  Sizes
    and the union of the sketches rule out most pairs before whole sets are joined.
    """

    def side(df: DataFrame, name: str, *cols: str) -> DataFrame:
        return df.select(F.col("id").alias(name), *[F.col(c).alias(f"{c}_{name}") for c in cols])

    def confirm(pairs: DataFrame) -> DataFrame:
        both = pairs.join(side(sketches, "a", "m", "sketch"), "a").join(side(sketches, "b", "m", "sketch"), "b")
        both = both.filter(100 * F.least("m_a", "m_b") >= percent * F.greatest("m_a", "m_b"))
        union = F.slice(F.sort_array(F.array_union("sketch_a", "sketch_b")), 1, k)
        agree = F.size(F.array_intersect(union, F.array_intersect("sketch_a", "sketch_b")))
        likely = both.filter(agree >= F.lit(least_agreement(percent / 100, k)) * F.size(union)).select("a", "b").distinct()
        likely = settle(likely, "likely")

        def whole(name: str) -> DataFrame:
            """Sets of the items of one side, so that no others are shuffled."""
            ids = settle(likely.select(F.col(name).alias("id")).distinct(), "sides")
            return side(sets_of(ids), name, "items")

        full = likely.join(whole("a"), "a").join(whole("b"), "b")
        common = F.size(F.array_intersect("items_a", "items_b"))
        total = F.size("items_a") + F.size("items_b") - common
        return full.filter(100 * common >= percent * total).select("a", "b").distinct()

    return confirm


def confirmed_components(
    lists: DataFrame, confirm: Callable[[DataFrame], DataFrame], known: DataFrame | None = None, written: bool = False
) -> DataFrame:
    """(node, component) of the items that have a confirmed link.

    ``lists`` holds rows of (key, id, need), each (key, id) once.  A pair must share
    as many lists as the smaller ``need`` of its two items says.  ``confirm`` keeps
    the true ones of pairs (a, b) with a < b.  ``known`` are links to begin with.
    Lists that the caller has written are not written again before there are links.
    """
    rows = lists.select("key", "id", "need")
    links = known
    before = math.inf
    tested: DataFrame | None = None
    for round_no in range(ROUNDS + 1):
        if links is None:
            held = rows.withColumn("c", F.col("id"))
        else:
            held = rows.join(components(links, "a", "b"), F.col("id") == F.col("node"), "left")
            held = held.select("key", "id", "need", F.coalesce("component", "id").alias("c"))
            # a list whose items are one component has nothing left to ask
            mixed = held.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).filter("lo < hi").select("key")
            held = held.join(mixed, "key", "left_semi")
        if links is not None or not written:
            held = settle(held, "lists")
        pairs, n = _cross(held)
        if not pairs:
            break
        last = round_no == ROUNDS or pairs <= PAIRS_A_ROW * n or pairs > SLOW * before
        before = pairs
        if last:
            other, rows = held, held.limit(0)
            apart = F.col("id") < F.col("pid")
        else:
            # as many pivots as keep their pairs within the budget
            cut = max(1, int(PAIRS_A_ROW * n / (2 * pairs) * DRAWS))
            chosen = F.pmod(F.xxhash64("id", F.lit(round_no)), F.lit(DRAWS)) < F.lit(cut)
            other, rows = held.filter(chosen), held.filter(~chosen).select("key", "id", "need")
            # two pivots meet once
            apart = ~F.pmod(F.xxhash64("id", F.lit(round_no)), F.lit(DRAWS)).between(0, cut - 1) | (F.col("id") < F.col("pid"))
        other = other.select("key", F.col("id").alias("pid"), F.col("c").alias("pc"), F.col("need").alias("p_need"))
        met = held.join(other, "key").filter((F.col("c") != F.col("pc")) & apart)
        met = met.groupBy(F.least("id", "pid").alias("a"), F.greatest("id", "pid").alias("b")).agg(
            F.count("*").alias("n"), F.min(F.least("need", "p_need")).alias("least")
        )
        met = met.filter("n >= least").select("a", "b")
        if tested is not None:
            met = met.join(tested, ["a", "b"], "left_anti")
        met = settle(met, "met")
        found = settle(confirm(met), "links")
        links = found if links is None else links.unionByName(found)
        if last:
            break
        tested = met if tested is None else tested.unionByName(met)
    if links is None:
        return lists.select(F.col("id").alias("node"), F.col("id").alias("component")).limit(0)
    return components(links, "a", "b")

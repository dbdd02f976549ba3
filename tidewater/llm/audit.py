"""How five text filters overlap: what each removes in every order of application.

A document's failures are one bit mask.  Everything that any order needs is the
number of documents for each (part, mask), so the orders cost nothing: texts are
read once for the filters that look at one text, and only possible repeats are
moved for the one that looks at all of them.

Repeats.  A counting Bloom filter over text hashes goes first.  It has
SLOTS_A_ROW slots for each document; every task adds up its own sketch, a count
for each slot it meets (the map side of the aggregate), and the sketches are
merged by adding.  A text one of whose slots counts 1 is unique for certain.
The rest, true repeats and about one unique text in seventy, are grouped by
their full text to find the least id that holds it.  A text hash that stands for
one text only then names that text; hashes shared by different texts, should any
occur, are joined by the text itself.

Counts are additive.  The mask counts without the repeat filter come from all
rows; the documents that fail it are counted once more by mask and moved from
their mask to the one with its bit.

Null texts are empty ones and a null part is the empty string.  A row without an
id is a copy of nothing and makes nothing a copy, and it has no labels.  Rows of
one id and text are no copies of each other.  Of several label rows for one id,
one with the value 1 is enough.  An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm.common import pieces, raw
from tidewater.operators.relational import small
from tidewater.session import settle, size_in_bytes, spread

FILTERS = "ABCDE"
BITS = {name: 1 << k for k, name in enumerate(FILTERS)}
MASKS = 1 << len(FILTERS)
LEAST_WORDS = 50
LEAST_DISTINCT = 65  # percent of the words
MOST_CAPITALS = 5  # percent of the code points
CAPITALS = bytes(range(65, 91))
SYMBOLS = b"#$%&*|"
CONTINUED = bytes(range(0x80, 0xC0))  # bytes that begin no code point

PROBES = 2
SLOTS_A_ROW = 16
SKETCH_BYTES = 32 << 20  # crowded slots up to which they are broadcast
HEAVY = 1000  # a text with more than 1 / HEAVY of all possible repeats is heavy: there are fewer than HEAVY


def text_mask(body: bytes) -> int:
    """Failures of the filters that look at one text."""
    words = body.split()
    mask = BITS["A"] if len(words) < LEAST_WORDS else 0
    if 100 * len(set(words)) < LEAST_DISTINCT * len(words):
        mask |= BITS["B"]
    points = len(body.translate(None, CONTINUED))
    if 100 * (len(body) - len(body.translate(None, CAPITALS))) > MOST_CAPITALS * points:
        mask |= BITS["C"]
    if len(body.translate(None, SYMBOLS)) != len(body):
        mask |= BITS["D"]
    return mask


def masked(docs: DataFrame, id_col: str, text: str, part: str) -> DataFrame:
    """(id, part, th, mask): one narrow row for each document, its whole text read."""

    def flag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in pieces(batch):
                masks = [text_mask(b or b"") for b in raw(some.column(3))]
                yield pa.RecordBatch.from_arrays(
                    [*some.columns[:3], pa.array(masks, pa.int32())], names=["id", "part", "th", "mask"]
                )

    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.xxhash64(body).alias("th"), body.alias("body")
    )
    kind = docs.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(flag, f"id {kind}, part string, th bigint, mask int")


def slots(th: Column, n_slots: int) -> list[Column]:
    """The slots of a text hash in the sketch."""
    return [F.pmod(F.xxhash64(th, F.lit(k)), F.lit(n_slots)) for k in range(PROBES)]


def crowded_slots(rows: DataFrame, n_slots: int) -> DataFrame:
    """The merged sketch as far as it matters: slots that count 2 or more."""
    met = rows.select(F.explode(F.array_distinct(F.array(*slots(F.col("th"), n_slots)))).alias("slot"))
    return met.groupBy("slot").agg(F.count("*").alias("n")).filter("n > 1")


def possible_repeats(rows: DataFrame, th: Column, sketch: DataFrame, n_slots: int) -> DataFrame:
    """Rows all of whose slots are crowded; the others' texts are unique.

    A small sketch is broadcast, and the rows are read once.  Of a larger one the
    heavy slots, few by their definition, are broadcast, and only rows that miss
    them are shuffled to the rest.
    """
    whole = size_in_bytes(sketch) <= SKETCH_BYTES
    for k, slot in enumerate(slots(th, n_slots)):
        name = f"_slot{k}"
        rows = rows.withColumn(name, slot)
        if whole:
            rows = rows.join(F.broadcast(sketch.select(F.col("slot").alias(name))), name, "left_semi")
            continue
        heavy = F.broadcast(sketch.filter("heavy").select(F.col("slot").alias(name)))
        light = sketch.filter("not heavy").select(F.col("slot").alias(name))
        rows = rows.join(heavy, name, "left_semi").unionByName(rows.join(heavy, name, "left_anti").join(light, name, "left_semi"))
    return rows.drop(*[f"_slot{k}" for k in range(PROBES)])


def later_copies(docs: DataFrame, rows: DataFrame, id_col: str, text: str) -> DataFrame:
    """The rows (id, part, th, mask, good, bad) whose text a smaller id has as well."""
    known = rows.filter("id is not null")
    n = known.count()
    n_slots = max(64, n * SLOTS_A_ROW)
    sketch = crowded_slots(known, n_slots).withColumn("heavy", F.col("n") * HEAVY > n * PROBES)
    sketch = settle(sketch, "sketch")

    body = F.coalesce(F.col(text), F.lit(""))
    texts = docs.filter(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), F.xxhash64(body).alias("th"), body.alias("body"))
    texts = possible_repeats(texts, F.col("th"), sketch, n_slots)
    firsts = settle(texts.groupBy("th", "body").agg(F.min("id").alias("first"), F.count("*").alias("n")).filter("n > 1 or first is not null"), "firsts")

    by_hash = firsts.groupBy("th").agg(F.count("*").alias("texts"), F.min("first").alias("first"), F.sum("n").alias("n"))
    by_hash = settle(by_hash.filter("n > 1"), "repeats")
    total = by_hash.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    plain = by_hash.filter("texts = 1")
    heavy = F.broadcast(plain.filter(F.col("n") * HEAVY > total).select("th", "first"))
    light = small(plain.filter(F.col("n") * HEAVY <= total).select("th", "first"))
    copies = known.join(heavy, "th").unionByName(known.join(heavy, "th", "left_anti").join(light, "th"))
    copies = copies.filter(F.col("id") > F.col("first")).drop("first")

    shared = by_hash.filter("texts > 1").select("th")
    if shared.limit(1).count() == 0:
        return copies
    exact = firsts.join(shared, "th").select("th", "body", "first")
    mine = texts.join(shared, "th").join(exact, ["th", "body"]).filter(F.col("id") > F.col("first"))
    return copies.unionByName(known.join(mine.select("id", "th").distinct(), ["id", "th"]))


def mask_counts(docs: DataFrame, labels: DataFrame, id_col: str, text: str, part: str) -> DataFrame:
    """(part, mask, n, good, bad): documents by the set of filters they fail, and how many are good or toxic."""
    narrow = settle(masked(spread(docs), id_col, text, part), "masks")
    marks = labels.filter(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("bad")
    )
    marks = small(settle(marks.filter("good = 1 or bad = 1"), "marks"))
    with_id, zero = narrow.filter("id is not null"), F.lit(0)
    rows = with_id.join(marks, "id", "left").select("id", "part", "th", "mask", F.coalesce("good", zero).alias("good"), F.coalesce("bad", zero).alias("bad"))
    rows = settle(rows.unionByName(narrow.filter("id is null").select("*", zero.alias("good"), zero.alias("bad"))), "marked")

    def counted(found: DataFrame, mask: Column, sign: int) -> DataFrame:
        sums = found.groupBy("part", mask.alias("mask")).agg(F.count("*").alias("n"), F.sum("good").alias("good"), F.sum("bad").alias("bad"))
        return sums.select("part", "mask", *[(F.lit(sign) * F.col(c)).alias(c) for c in ("n", "good", "bad")])

    copies = settle(later_copies(docs, rows, id_col, text), "copies")
    mask = F.col("mask")
    moved = counted(copies, mask, -1).unionByName(counted(copies, mask.bitwiseOR(F.lit(BITS["E"])), 1))
    every = counted(rows, mask, 1).unionByName(moved)
    return every.groupBy("part", "mask").agg(*[F.sum(c).alias(c) for c in ("n", "good", "bad")])


def contributions(spark: SparkSession) -> DataFrame:
    """(mask, own, before, ...): what a document of a mask counts for at a filter behind a set of others.

    A fixed table of 80 pairs for each of 32 masks.  Of all 120 orders, a mask's
    filters come first equally often, so the filter removes it in 120 / filters
    of the mask orders.
    """
    orders = 120
    rows = []
    for mask in range(MASKS):
        for own in BITS.values():
            fails = bool(mask & own)
            for before in range(MASKS):
                if before & own:
                    continue
                gone = bool(mask & before)
                share = orders // mask.bit_count() if fails else 0
                rows.append((mask, own, before, int(not fails and not gone), int(fails and not gone), int(fails and gone), int(mask == own), share))
    return spark.createDataFrame(rows, "mask int, own int, before int, kept int, removed int, redundant int, alone int, share int")


def orderings(spark: SparkSession) -> DataFrame:
    """(own, before, filter_order, step): the 600 steps of the 120 orders."""
    rows = []
    for order in permutations(FILTERS):
        before = 0
        for step, name in enumerate(order, 1):
            rows.append((BITS[name], before, "".join(order), step))
            before |= BITS[name]
    return spark.createDataFrame(rows, "own int, before int, filter_order string, step int")


def filter_audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """One row for each part, order of the filters and step.

    Counts of documents within the part: ``kept`` after the step, ``removed`` by
    it, ``redundant`` (failing its filter, removed before), ``unique_fails``
    (failing its filter only), ``good_lost`` and ``toxic_lost`` among the
    removed, and ``shapley``, what its filter removes summed over all orders.
    """
    spark = docs.sparkSession
    counts = settle(mask_counts(docs, labels, id_col, text, part), "mask-counts")
    each = counts.join(F.broadcast(contributions(spark)), "mask")
    removed = F.col("removed")
    sums = each.groupBy("part", "own", "before").agg(
        F.sum(F.col("n") * F.col("kept")).alias("kept"),
        F.sum(F.col("n") * removed).alias("removed"),
        F.sum(F.col("n") * F.col("redundant")).alias("redundant"),
        F.sum(F.col("n") * F.col("alone")).alias("unique_fails"),
        F.sum(F.col("good") * removed).alias("good_lost"),
        F.sum(F.col("bad") * removed).alias("toxic_lost"),
        F.sum(F.col("n") * F.col("share")).alias("shapley"),
    )
    return sums.join(F.broadcast(orderings(spark)), ["own", "before"]).drop("own", "before").select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"
    )


# The same counts in SQL: flags by window, orders by enumeration.
AUDIT_SQL = r"""
WITH words AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
firsts AS (SELECT text, min(doc_id) AS first_id FROM words GROUP BY text),
marks AS (
  SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS bad
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
flags AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(bad, 0) AS bad, map {
      'A': len(w) < 50,
      'B': 100 * len(list_distinct(w)) < 65 * len(w),
      'C': 100 * length(regexp_replace(words.text, '[^A-Z]', '', 'g')) > 5 * length(words.text),
      'D': regexp_matches(words.text, '[#$%&*|]'),
      'E': coalesce(words.doc_id > first_id, false)} AS f
  FROM words JOIN firsts ON words.text = firsts.text LEFT JOIN marks ON words.doc_id = marks.doc_id),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l),
orders AS (
  SELECT a.l || b.l || c.l || d.l || e.l AS filter_order
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.l, b.l, c.l, d.l, e.l])) = 5),
steps AS (SELECT filter_order, unnest(range(1, 6))::INT AS step FROM orders),
plays AS (SELECT filter_order, step, substr(filter_order, step, 1) AS own, string_split(filter_order[1:step - 1], '') AS before FROM steps),
grouped AS (SELECT part, f, count(*) AS n, sum(good) AS good, sum(bad) AS bad FROM flags GROUP BY part, f),
counted AS (
  SELECT part, filter_order, step, own,
         sum(CASE WHEN NOT gone AND NOT fails THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN NOT gone AND fails THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN gone AND fails THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN fails AND n_fails = 1 THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN NOT gone AND fails THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN NOT gone AND fails THEN bad ELSE 0 END) AS toxic_lost
  FROM (
    SELECT part, filter_order, step, own, n, good, bad, f[own] AS fails,
           len(list_filter(before, lambda x: x <> '' AND f[x])) > 0 AS gone,
           len(list_filter(map_values(f), lambda x: x)) AS n_fails
    FROM grouped, plays)
  GROUP BY ALL)
SELECT part, filter_order, step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
       unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
       (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley
FROM counted
"""

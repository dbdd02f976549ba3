"""Containment and fuzzy joins that never form the product of two tables.

Each join finds candidate pairs by an equi-join on something every true pair
must share, and then tests the candidates.  Nothing is approximated and no
candidate is dropped by a cap.  Equal strings are matched once: the joins run on
distinct values, and the numbers of copies come back as counts.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.operators.relational import small
from tidewater.session import settle

GRAM = 3
FEW_KEYS = 256  # so many keys are looked for in every text; past it texts are cut into theirs


# ------------------------------------------------------------- containment


def _word_keys(text: Column) -> Column:
    return F.array_distinct(F.split(text, " "))


def _inner_words(text: Column) -> Column:
    """Words with a blank on both sides: whole words of any text around them."""
    w = F.split(text, " ")
    return F.array_distinct(F.slice(w, 2, F.greatest(F.size(w) - 2, F.lit(0))))


def _grams(text: Column, n: int) -> Column:
    chars = F.split(text, "")

    def gram(c, i):
        return F.concat(c, *[F.coalesce(F.get(chars, i + j), F.lit("")) for j in range(1, n)])

    out = F.transform(chars, gram)
    return F.array_distinct(F.filter(out, lambda g: F.length(g) == n))


def _with_keys(hay: DataFrame, wanted: DataFrame, hay_keys: Column, grams: bool) -> DataFrame:
    """(hid, key): the keys of every text, or only the wanted ones where they are few grams."""
    few = [r.key for r in wanted.select("key").distinct().limit(FEW_KEYS + 1).collect()] if grams else []
    if not 0 < len(few) <= FEW_KEYS:
        return hay.select("hid", F.explode(hay_keys).alias("key"))
    held = F.filter(F.array(*[F.lit(k) for k in sorted(few)]), lambda k: F.contains(F.col("text"), k))
    return hay.select("hid", F.explode(held).alias("key"))


def _candidates(hay: DataFrame, needles: DataFrame, hay_keys: Column, needle_keys: Column, grams: bool) -> DataFrame:
    """(hid, nid) pairs that share the needle's rarest key."""
    keys = needles.select("nid", F.explode(needle_keys).alias("key"))
    found = _with_keys(hay, keys, hay_keys, grams)
    # texts are cut up twice: once to count, which shuffles a row per key, and
    # once for the chosen keys; keeping every shared key would outgrow the texts
    often = (
        found.join(small(keys.select("key").distinct()), "key", "left_semi").groupBy("key").agg(F.count("*").alias("n"))
    )
    often = settle(often, "often")
    # a key that no text has rules its needle out
    counted = keys.join(small(often), "key", "left").na.fill(0, ["n"])
    rarest = counted.groupBy("nid").agg(F.min(F.struct("n", "key")).alias("k"))
    probe = settle(rarest.filter(F.col("k.n") > 0).select("nid", F.col("k.key").alias("key")), "probe")
    return _with_keys(hay, probe, hay_keys, grams).join(small(probe), "key").select("hid", "nid")


def join_contains(
    hay: DataFrame, hay_id: str, hay_text: str, needles: DataFrame, needle_id: str, needle_cols: Sequence[str]
) -> DataFrame:
    """(hay_id, needle_id) where the text contains every needle column.

    The first needle column finds the candidates: by its rarest inner word if
    it has three words or more, else by its rarest gram of up to three
    characters.  Texts are joined to the candidates by their id.
    """
    h = hay.select(F.col(hay_id).alias("hid"), F.col(hay_text).alias("text"))
    n = needles.select(F.col(needle_id).alias("nid"), *[F.col(c).alias(f"n{i}") for i, c in enumerate(needle_cols)])
    n = settle(n.withColumn("_w", F.size(_inner_words(F.col("n0")))), "needles")
    every = n
    # every text contains the empty string: such needles meet all texts, as their definition says
    blank = n.filter("n0 = ''").select("nid")
    pairs = None
    if blank.limit(1).count():
        pairs = h.filter("text is not null").select("hid").join(small(blank))
        n = n.filter("n0 <> ''")
    shapes = [(F.col("_w") > 0, _word_keys(F.col("text")), _inner_words(F.col("n0")), False)]
    for size in range(1, GRAM + 1):
        fits = F.length("n0") == size if size < GRAM else F.length("n0") >= size
        shapes.append(((F.col("_w") == 0) & fits, _grams(F.col("text"), size), _grams(F.col("n0"), size), True))
    for keep, hay_keys, needle_keys, grams in shapes:
        some = n.filter(keep)
        if some.limit(1).count() == 0:
            continue
        found = _candidates(h, some, hay_keys, needle_keys, grams)
        pairs = found if pairs is None else pairs.unionByName(found)
    if pairs is None:
        pairs = h.sparkSession.createDataFrame([], "hid bigint, nid bigint")
    tested = pairs.join(small(every.drop("_w")), "nid").join(h, "hid")
    for i in range(len(needle_cols)):
        tested = tested.filter(F.contains("text", F.col(f"n{i}")))
    return tested.select(F.col("hid").alias(hay_id), F.col("nid").alias(needle_id))


# ------------------------------------------------------------ edit distance


def distinct_strings(df: DataFrame, col: str) -> DataFrame:
    """Distinct values with the number of rows that carry each."""
    return df.groupBy(F.col(col).alias("s")).agg(F.count("*").alias("copies"))


def _piece(k: str, i: str, of: str) -> tuple[str, str]:
    """Start (one-based) and length of piece i when ``of`` letters are cut into
    k+1 pieces, the longer ones last."""
    base, extra = f"({of} div ({k} + 1))", f"({of} % ({k} + 1))"
    first_long = f"({k} + 1 - {extra})"
    start = f"(1 + {i} * {base} + greatest(0, {i} - {first_long}))"
    length = f"({base} + if({i} >= {first_long}, 1, 0))"
    return start, length


def _segment_pairs(strings: DataFrame, max_len: str, k: str) -> DataFrame:
    """Candidate pairs (s, t), s the shorter or the equal one.

    With at most k edits one of k+1 pieces of the shorter string stands
    unchanged in the longer one, moved by few places (Li et al. 2011).  ``k``
    and ``max_len`` are SQL expressions over la (shorter) and lb (longer).
    """
    base = strings.select("s", F.length("s").alias("len"))
    start, length = _piece("k", "i", "la")
    # the shorter side: its pieces, for every k its partners can need
    index = (
        base.selectExpr("s", "len AS la", f"explode(array_distinct(transform(sequence(len, {max_len.format(la='len')}), x -> {k.format(la='len', lb='x')}))) AS k")
        .filter("k >= 0")
        .selectExpr("s", "la", "k", "explode(sequence(0, k)) AS i")
        .selectExpr("s", "la", "k", "i", f"cast(substring(s, cast({start} AS int), cast({length} AS int)) AS string) AS piece")
    )
    lens = base.select("len").distinct().agg(F.min("len").alias("lo")).first()["lo"] or 0
    lo = int(lens)
    # the longer side: the substrings that can be such a piece
    delta = "(lb - la)"
    probe = (
        base.selectExpr("s AS t", "len AS lb", f"explode(sequence(least({lo}, len), len)) AS la")
        .filter(f"lb <= {max_len.format(la='la')}")
        .selectExpr("t", "lb", "la", f"{k.format(la='la', lb='lb')} AS k")
        .filter(f"k >= 0 AND {delta} <= k")
        .selectExpr("t", "lb", "la", "k", "explode(sequence(0, k)) AS i")
        .selectExpr("t", "lb", "la", "k", "i", f"{start} AS st", f"{length} AS n")
        .selectExpr(
            "t", "lb", "la", "k", "i", "n",
            f"greatest(1, st - (k - {delta}) div 2) AS p0", f"least(lb - n + 1, st + (k + {delta}) div 2) AS p1",
        )
        .filter("p0 <= p1")
        .selectExpr("t", "lb", "la", "k", "i", "explode(array_distinct(transform(sequence(p0, p1), p -> substring(t, cast(p AS int), cast(n AS int))))) AS piece")
    )
    return (
        index.join(probe, ["la", "k", "i", "piece"])
        .filter((F.col("lb") > F.col("la")) | (F.col("s") < F.col("t")))
        .select("s", "t")
        .distinct()
    )


def _ordered(pairs: DataFrame, strings: DataFrame, value: str) -> DataFrame:
    """a < b, with copies of both and the number of row pairs they stand for."""
    left = strings.select(F.col("s").alias("a"), F.col("copies").alias("n_a"))
    right = strings.select(F.col("s").alias("b"), F.col("copies").alias("n_b"))
    named = pairs.select(F.least("s", "t").alias("a"), F.greatest("s", "t").alias("b"), value)
    return named.join(left, "a").join(right, "b").select("a", "b", value, "n_a", "n_b")


def fuzzy_join_distance(df: DataFrame, col: str, below: int) -> DataFrame:
    """(a, b, distance, n_a, n_b) of distinct values at edit distance < below."""
    strings = settle(distinct_strings(df, col), "strings")
    k = below - 1
    pairs = _segment_pairs(strings, f"{{la}} + {k}", str(k))
    # the bounded form stops early and gives -1 beyond k
    near = pairs.withColumn("distance", F.levenshtein("s", "t", k)).filter(F.col("distance") >= 0)
    return _ordered(near, strings, "distance")


# ------------------------------------------------------------------- ratio


def lcs_length(a: str, b: str) -> int:
    """Length of the longest common subsequence, a row of bits at a time."""
    where: dict[str, int] = {}
    for i, ch in enumerate(a):
        where[ch] = where.get(ch, 0) | (1 << i)
    full = (1 << len(a)) - 1
    row = full
    for ch in b:
        hit = row & where.get(ch, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def ratio_column(a: Column, b: Column) -> Column:
    """2 * LCS / (length a + length b)."""

    @F.pandas_udf(T.DoubleType())
    def ratio(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([2.0 * lcs_length(p, q) / max(len(p) + len(q), 1) for p, q in zip(x, y)], dtype=float)

    return ratio(a, b)


def _numbered_letters(col: Column) -> Column:
    """Letters with their occurrence number: sets that intersect as multisets."""
    sorted_letters = F.array_sort(F.filter(F.split(col, ""), lambda c: c != ""))
    return F.transform(
        sorted_letters, lambda c, i: F.concat(c, (i - F.array_position(sorted_letters, c) + 1).cast("string"))
    )


def _letter_pairs(strings: DataFrame, above: float) -> DataFrame:
    """Candidate pairs by prefix filter over numbered letters, rarest first.

    A ratio above t needs more than t(la+lb)/2 letters in common, so the parts
    of two strings that remain when that many (less one) of the commonest
    letters are left off must share a letter.  Holds for every t > 0.
    """
    base = strings.select("s", F.length("s").alias("len"), "toks")
    each = base.select("s", "len", F.explode("toks").alias("tok"))
    often = each.groupBy("tok").agg(F.count("*").alias("n"))
    ranked = each.join(small(often), "tok").groupBy("s", "len").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("n", "tok"))), lambda x: x["tok"]).alias("toks")
    )
    # least partner length, then the least overlap any partner demands
    shortest = F.floor(F.col("len") * F.lit(above) / F.lit(2 - above) - 1e-9) + 1
    demand = F.greatest(F.floor(F.lit(above) * (F.col("len") + shortest) / 2 - 1e-9) + 1, F.lit(1))
    prefix = F.slice("toks", 1, F.greatest(F.col("len") - demand + 1, F.lit(0)).cast("int"))
    keyed = ranked.select("s", "len", F.explode(prefix).alias("tok"))
    other = keyed.select(F.col("s").alias("t"), F.col("len").alias("len_t"), "tok")
    least, total = F.least("len", "len_t"), F.col("len") + F.col("len_t")
    return (
        keyed.join(other, "tok")
        .filter((F.col("s") < F.col("t")) & (2 * least > F.lit(above) * total - 1e-9))
        .select("s", "t")
        .distinct()
    )


def fuzzy_join_ratio(df: DataFrame, col: str, above: float) -> DataFrame:
    """(a, b, ratio, n_a, n_b) of distinct values with ratio > above.

    Candidates come from pieces at high thresholds and from rare letters below;
    those with enough letters in common, counted as multisets by a built-in,
    reach the subsequence test.
    """
    if not 0 < above < 1:
        raise ValueError("the ratio threshold must lie between 0 and 1")
    strings = distinct_strings(df, col).withColumn("toks", _numbered_letters(F.col("s")))
    strings = settle(strings, "strings")
    if above >= 0.85:
        # fewer than (1-t)(la+lb) insertions and deletions, so no more edits
        k = f"cast(ceil({1 - above!r} * ({{la}} + {{lb}}) - 1e-9) AS int) - 1"
        longest = f"cast(floor({{la}} * {(2 - above) / above!r} + 1e-9) AS int)"
        pairs = _segment_pairs(strings, longest, k)
    else:
        pairs = _letter_pairs(strings, above)
    # letters are numbered once per string and joined to the pairs
    own = strings.select("s", F.col("toks").alias("toks_s"))
    other = strings.select(F.col("s").alias("t"), F.col("toks").alias("toks_t"))
    total = F.length("s") + F.length("t")
    common = F.size(F.array_intersect("toks_s", "toks_t"))
    apart = F.levenshtein("s", "t")
    likely = (
        pairs.join(own, "s")
        .join(other, "t")
        .filter(2 * common > F.lit(above) * total - 1e-9)
        .filter(apart < F.lit(1 - above) * total + 1e-9)
        .select("s", "t")
    )
    scored = likely.withColumn("ratio", ratio_column(F.col("s"), F.col("t"))).filter(F.col("ratio") > F.lit(above))
    return _ordered(scored, strings, "ratio")


# -------------------------------------------------------- pairs and gold


def pairs_by_score(df: DataFrame, name: str, cluster: str, near: DataFrame, score: str) -> DataFrame:
    """Row pairs and gold row pairs per score, from distinct-value pairs.

    Row pairs of equal names count under score 0 distance; they and the gold
    among them follow from group sizes, so no pair of rows is ever formed.
    """
    per = df.groupBy(F.col(name).alias("s"), F.col(cluster).alias("c")).agg(F.count("*").alias("m"))
    n = F.col("n")
    equal = (
        per.groupBy("s")
        .agg(F.sum("m").alias("n"), F.sum(F.col("m") * (F.col("m") - 1) / 2).alias("gold"))
        .agg(F.sum(n * (n - 1) / 2).cast("bigint").alias("pairs"), F.sum("gold").cast("bigint").alias("gold"))
        .select(F.lit(0).cast("double").alias(score), "pairs", "gold")
    )
    same = (
        near.join(per.select(F.col("s").alias("a"), "c", F.col("m").alias("m_a")), "a")
        .join(per.select(F.col("s").alias("b"), "c", F.col("m").alias("m_b")), ["b", "c"])
        .groupBy(score)
        .agg(F.sum(F.col("m_a") * F.col("m_b")).alias("gold"))
    )
    all_pairs = near.groupBy(score).agg(F.sum(F.col("n_a") * F.col("n_b")).alias("pairs"))
    unequal = all_pairs.join(same, score, "left").na.fill(0, ["gold"]).select(F.col(score).cast("double").alias(score), "pairs", "gold")
    return equal.unionByName(unequal)


def gold_total(df: DataFrame, cluster: str) -> int:
    m = F.col("count")
    return int(df.groupBy(cluster).count().agg(F.sum(m * (m - 1) / 2)).first()[0] or 0)

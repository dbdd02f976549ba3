"""Column expressions.  Each takes columns and returns a column, so all of them
stay inside whole-stage code generation and can be pushed to the scan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Regular expressions whose exact form decides the result.
LINK_PATTERN = r"\[\[(.*?)(\||\]\])"
WORD_PATTERN = r"[A-Za-z0-9']+|[^\sA-Za-z0-9]"

# Packed ARGB colours.
BLUE_ARGB = 0xFF0000FF
GREEN_ARGB = 0xFF00FF00
RED_ARGB = 0xFFFF0000

# Number words, letter grades and cut-offs of explicit ratings.
NUMBER_WORDS = {
    "zero": 0, "one": 1, "two": 2, "three": 3, "four": 4, "five": 5,
    "six": 6, "seven": 7, "eight": 8, "nine": 9, "ten": 10,
}
POSITIVE_GRADES = ["A+", "A", "A-", "B+", "B"]
NEGATIVE_GRADES = ["C-", "D+", "D", "D-", "F"]
FIVE_STAR_CUTS = (0.7, 0.4)
FOUR_STAR_CUTS = (0.75, 0.375)


def cast_or(col: Column, dtype: str, default) -> Column:
    """Cast, or the default where the text is no such value."""
    return F.coalesce(col.try_cast(dtype), F.lit(default))


def sentinel_to_null(col: Column, sentinel: str, dtype: str) -> Column:
    return F.nullif(col, F.lit(sentinel)).try_cast(dtype)


def digits_only(col: Column) -> Column:
    return F.regexp_replace(col, "[^0-9]", "").try_cast("int")


def before(col: Column, delim: str) -> Column:
    return F.trim(F.substring_index(col, delim, 1))


def part_at(col: Column, delim_regex: str, index: int) -> Column:
    """Zero-based piece of a split; null past the end."""
    return F.get(F.split(col, delim_regex), F.lit(index))


def clean_cell(col: Column) -> Column:
    """Non-breaking spaces and double quotes removed."""
    return F.replace(F.replace(col, F.lit(" "), F.lit("")), F.lit('"'), F.lit(""))


def compound_names(col: Column) -> Column:
    """``A-B-C, ST`` to distinct (name, state) pairs; state null if absent."""
    state = F.when(F.contains(col, F.lit(",")), F.trim(F.substring_index(col, ",", -1)))
    names = F.array_distinct(F.split(F.substring_index(col, ",", 1), "-"))
    return F.transform(names, lambda n: F.struct(F.trim(n).alias("name"), state.alias("state")))


def first_only(col: Column, literal_regex: str, replacement: str) -> Column:
    """Replace the first match of a regex and leave the later ones."""
    return F.regexp_replace(col, f"(?s)^(.*?){literal_regex}", f"$1{replacement}")


def normalise_log_line(col: Column) -> Column:
    """Space-separated access log line to a comma-separated one."""
    col = first_only(col, ":", ",")
    col = F.regexp_replace(col, r" \+0000\]", "")
    col = first_only(col, r"\[", "")
    col = first_only(col, " - -", "")
    return F.regexp_replace(col, r"\s+", ",")


def links_in(col: Column) -> Column:
    return F.regexp_extract_all(col, F.lit(LINK_PATTERN), F.lit(1))


def page_key(prefix: str, col: Column) -> Column:
    return F.concat(F.lit(prefix), F.replace(col, F.lit(" "), F.lit("_")))


def parse_log_time(date: Column, time: Column) -> Column:
    return F.try_to_timestamp(F.concat_ws(" ", date, time), F.lit("dd/MMM/yyyy HH:mm:ss"))


def numeric_parts(cells: Column) -> Column:
    """The cells that parse as numbers, as doubles, in order."""
    kept = F.filter(cells, lambda c: c.try_cast("double").isNotNull())
    return F.transform(kept, lambda c: c.cast("double"))


def text_parts(cells: Column) -> Column:
    return F.filter(cells, lambda c: c.try_cast("double").isNull())


def colour_gradient(x: Column, stops: Sequence[tuple[float, int]], legacy_red: bool = False) -> Column:
    """Piecewise linear colour between sorted stops, clamped at both ends.

    Channels are blended and cut to whole numbers, then packed to a signed int.
    ``legacy_red`` adds the upper stop's red and the blend share in place of
    their product, the known slip of older charts.
    """
    ordered = sorted(stops)

    def signed(argb: int) -> Column:
        return F.lit(argb - (1 << 32) if argb >= 1 << 31 else argb).cast("int")

    out = F.when(x < ordered[0][0], signed(ordered[0][1]))
    for (lo, c_lo), (hi, c_hi) in zip(ordered, ordered[1:]):
        share = (x - F.lit(lo)) / F.lit(hi - lo)

        def blend(shift: int) -> Column:
            p, q = (c_lo >> shift) & 0xFF, (c_hi >> shift) & 0xFF
            if legacy_red and shift == 16:
                mixed = F.least(F.lit(255.0), F.lit(float(p)) * (1 - share) + F.lit(float(q)) + share)
            else:
                # equal channels stay exactly equal
                mixed = F.lit(float(p)) + F.lit(float(q - p)) * share
            return F.shiftleft(F.floor(mixed).cast("int"), shift)

        packed = blend(24).bitwiseOR(blend(16)).bitwiseOR(blend(8)).bitwiseOR(blend(0))
        out = out.when(x < hi, packed)
    return out.otherwise(signed(ordered[-1][1]))


def argb_hex(col: Column) -> Column:
    return F.lower(F.lpad(F.hex(col.cast("bigint").bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0"))


def rescale(x: Column, lo: Column, hi: Column, to_lo: float, to_hi: float) -> Column:
    return F.lit(to_lo) + F.try_divide((x - lo) * F.lit(to_hi - to_lo), hi - lo)


def tick_spacing(lo: Column, hi: Column, parts: int = 6) -> Column:
    """Range over six, to one significant digit."""
    raw = (hi - lo) / F.lit(float(parts))
    scale = F.pow(F.lit(10.0), F.floor(F.log10(raw)))
    return F.when(raw > 0, F.round(F.round(raw / scale, 1), 0) * scale)


def nice_ticks(lo: Column, hi: Column, parts: int = 6) -> Column:
    """Multiples of the spacing from the first one at or above the minimum."""
    step = tick_spacing(lo, hi, parts)
    first, last = F.ceil(F.round(lo / step, 9)), F.floor(F.round(hi / step, 9))
    return F.transform(F.sequence(first, last), lambda i: F.round(i * step, 9))


def with_rating(df: DataFrame, text_col: str, name: str = "polarity") -> DataFrame:
    """Polarity of the first explicit rating: ``8/10``, ``four out of five``,
    ``out of ****: ***`` or ``grade: B+``; null where none is stated or it lies
    between the cut-offs."""
    number = rf"(?:[0-9]+(?:\.[0-9]+)?|{'|'.join(NUMBER_WORDS)})"
    pattern = rf"({number} ?(?:/|out of) ?{number}|out of \*+: ?\*+|grade: ?[a-f][+-]?)"
    words = F.create_map(*[F.lit(x) for w, v in NUMBER_WORDS.items() for x in (w, float(v))])

    def value(c: Column) -> Column:
        return F.coalesce(c.try_cast("double"), F.try_element_at(words, c))

    found, got, top = F.col("_found"), F.col("_got"), F.col("_top")
    is_stars = F.contains(found, F.lit("*"))
    staged = (
        df.withColumn("_found", F.regexp_extract(F.lower(text_col), pattern, 1))
        .withColumn("_got", F.regexp_extract(found, rf"^({number})", 1))
        .withColumn("_top", F.regexp_extract(found, rf"({number})$", 1))
        .withColumn("_grade", F.upper(F.regexp_extract(found, r"^grade: ?([a-f][+-]?)$", 1)))
        .withColumn(
            "_got",
            F.when(is_stars, F.length(F.regexp_extract(found, r"(\*+)$", 1)).cast("double")).otherwise(value(got)),
        )
        .withColumn(
            "_top",
            F.when(is_stars, F.length(F.regexp_extract(found, r"of (\*+):", 1)).cast("double")).otherwise(value(top)),
        )
    )
    share, four, grade = F.try_divide(got, top), top == 4, F.col("_grade")
    high = F.when(four, F.lit(FOUR_STAR_CUTS[0])).otherwise(F.lit(FIVE_STAR_CUTS[0]))
    low = F.when(four, F.lit(FOUR_STAR_CUTS[1])).otherwise(F.lit(FIVE_STAR_CUTS[1]))
    polarity = (
        F.when(grade.isin(POSITIVE_GRADES) | (share >= high), F.lit("pos"))
        .when(grade.isin(NEGATIVE_GRADES) | (share <= low), F.lit("neg"))
    )
    return staged.withColumn(name, polarity).drop("_found", "_got", "_top", "_grade")

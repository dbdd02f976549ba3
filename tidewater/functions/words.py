"""Text operators: tokens, sentences, stop words, stems, lexicons, vocabulary."""

from __future__ import annotations

import re
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.functions.scalars import WORD_PATTERN
from tidewater.operators.relational import small


def tokens(text: Column) -> Column:
    """Words of ASCII letters, digits and apostrophes; every other visible
    character is a token of its own."""
    return F.regexp_extract_all(text, F.lit(WORD_PATTERN), F.lit(0))


def words(text: Column) -> Column:
    """Lower-cased runs of ASCII letters."""
    return F.regexp_extract_all(F.lower(text), F.lit("[a-z]+"), F.lit(0))


def sentences(text: Column) -> Column:
    """Pieces that end in . ! or ? before white space, or at the end."""
    marked = F.regexp_replace(text, r"([.!?])[ \t\r\n]+", "$1\u0001")
    return F.filter(F.split(marked, "\u0001"), lambda s: F.trim(s) != "")


def drop_stop_words(toks: Column, stop: Sequence[str]) -> Column:
    """Fixed small list, so an IN test per token inside the expression."""
    return F.filter(toks, lambda t: ~F.lower(t).isin(list(stop)))


def vocabulary(docs: DataFrame, words_col: str, n: int) -> DataFrame:
    """The n most frequent words, ties in word order."""
    freq = docs.select(F.explode(words_col).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    return freq.orderBy(F.desc("n"), "word").limit(n)


def presence(docs: DataFrame, id_cols: Sequence[str], words_col: str, vocab: DataFrame) -> DataFrame:
    """(ids, word): which vocabulary words each text has, once each."""
    once = docs.select(*id_cols, F.explode(F.array_distinct(words_col)).alias("word"))
    return once.join(small(vocab.select("word")), "word", "left_semi")


def lexicon_lookup(toks: DataFrame, lexicon: DataFrame, keys: Sequence[str], value: str, default: Column) -> DataFrame:
    """Left join to a user's word table; a miss takes the default."""
    return toks.join(small(lexicon), list(keys), "left").withColumn(value, F.coalesce(F.col(value), default))


# The chunk and chink patterns of the two functions below.


def tag_chunks(tagged: Column) -> Column:
    """Noun chunks over a tag string such as ``the/DT red/JJ ...`` reduced to
    tags: adverbs and verbs, then proper nouns, then one noun at most."""
    return F.regexp_extract_all(tagged, F.lit(r"((?:<RB.?>)*(?:<VB.?>)*(?:<NNP>)+(?:<NN>)?)"), F.lit(1))


def tag_chinks(tagged: Column) -> Column:
    """What is left between runs of verb, preposition and determiner tags."""
    parts = F.split(tagged, r"(?:<VB.?.?>|<IN>|<DT>)+")
    return F.filter(parts, lambda p: p != "")


# ---------------------------------------------------------------- stemming
#
# Porter (1980).  Fixed values: suffix tables of the published steps.
STEP_2 = {
    "ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "izer": "ize", "abli": "able",
    "alli": "al", "entli": "ent", "eli": "e", "ousli": "ous", "ization": "ize", "ation": "ate",
    "ator": "ate", "alism": "al", "iveness": "ive", "fulness": "ful", "ousness": "ous", "aliti": "al",
    "iviti": "ive", "biliti": "ble",
}
STEP_3 = {"icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic", "ful": "", "ness": ""}
STEP_4 = [
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou", "ism",
    "ate", "iti", "ous", "ive", "ize",
]


def _shape(word: str) -> str:
    """Vowel/consonant pattern; y is a vowel after a consonant."""
    out = []
    for i, ch in enumerate(word):
        vowel = ch in "aeiou" or (ch == "y" and i > 0 and out[-1] == "c")
        out.append("v" if vowel else "c")
    return "".join(out)


def _measure(stem: str) -> int:
    return len(re.findall("v+c+", _shape(stem)))


def _ends_cvc(stem: str) -> bool:
    return _shape(stem).endswith("cvc") and stem[-1] not in "wxy"


def _doubled(stem: str) -> bool:
    return len(stem) > 1 and stem[-1] == stem[-2] and _shape(stem)[-1] == "c"


def _longest(word: str, suffixes) -> str | None:
    return max((s for s in suffixes if word.endswith(s)), key=len, default=None)


def porter_stem(word: str) -> str:
    w = word.lower()
    if len(w) <= 2:
        return w
    if w.endswith(("sses", "ies")):
        w = w[:-2]
    elif w.endswith("s") and not w.endswith("ss"):
        w = w[:-1]
    past = _longest(w, ("ed", "ing"))
    if w.endswith("eed"):
        w = w[:-1] if _measure(w[:-3]) > 0 else w
    elif past and "v" in _shape(w[: -len(past)]):
        w = w[: -len(past)]
        if w.endswith(("at", "bl", "iz")) or (_measure(w) == 1 and _ends_cvc(w)):
            w += "e"
        elif _doubled(w) and w[-1] not in "lsz":
            w = w[:-1]
    if w.endswith("y") and "v" in _shape(w[:-1]):
        w = w[:-1] + "i"
    for rules in (STEP_2, STEP_3):
        s = _longest(w, rules)
        if s and _measure(w[: -len(s)]) > 0:
            w = w[: -len(s)] + rules[s]
    s = _longest(w, STEP_4)
    if s and _measure(w[: -len(s)]) > 1 and (s != "ion" or w[: -len(s)].endswith(("s", "t"))):
        w = w[: -len(s)]
    if w.endswith("e"):
        m = _measure(w[:-1])
        if m > 1 or (m == 1 and not _ends_cvc(w[:-1])):
            w = w[:-1]
    if w.endswith("ll") and _measure(w) > 1:
        w = w[:-1]
    return w


@F.pandas_udf(T.StringType())
def stem(col: pd.Series) -> pd.Series:
    return col.map(porter_stem, na_action="ignore")

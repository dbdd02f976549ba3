"""Toxicity by a weighted lexicon found with one Aho-Corasick automaton.

Texts are folded first: lower case, compatibility forms, look-alike letters of
other scripts, and digits or signs that stand for a letter inside a word;
everything but letters then becomes one blank.  Terms are words or beginnings of
words, weighted by the log odds of their document frequencies.  A hit inside an
exception phrase, a word pair that is common in clean documents, does not count.
The weights found are divided by a power of the number of words; a monotone map
puts the cut that is best on the sample at a score of 0.7.

Null and empty texts score 0.  A document that is labelled both ways counts in
both classes; repeated rows are rows of their own.  The whole text is read.  Only the fit is bounded:
about ``sample`` documents of each class.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import bounded_sample, pieces
from tidewater.session import settle

# Letters of other scripts that look like Latin ones, and what
# digits and signs stand for.
LOOK_ALIKES = str.maketrans("абвгеёзикмнопрстухїіјѕԁԛԝαβεηικνοπρτυχγ", "a6bree3ukmhonpctyxiijsdqwabenikvonptuxy")
STAND_INS = str.maketrans("013457@$!|", "oieastasii")

FOREIGN = re.compile("[Ͱ-ԯ]")
INSIDE = re.compile(r"[013457@$!|]+(?=[^\W\d_])")
BETWEEN = re.compile(r"[\W\d_]+")

SHORTEST, LONGEST = 3, 12
LENGTH_POWER = 0.75
CUT_SCORE = 0.7
STEEPNESS = 4.0
CLASS_SAMPLE = 6000


def folded(text: str | None) -> str:
    """`` word word ``: lower-case letters with a blank before and after each word."""
    if not text:
        return " "
    if not text.isascii() and not unicodedata.is_normalized("NFKC", text):
        text = unicodedata.normalize("NFKC", text)
    text = text.lower()
    if FOREIGN.search(text):
        text = text.translate(LOOK_ALIKES)
    text = INSIDE.sub(lambda m: m[0].translate(STAND_INS), text)
    return BETWEEN.sub(" ", f" {text} ")


@dataclass
class Lexicon:
    terms: dict[str, float]  # " stem" or " word " -> weight
    exceptions: list[str] = field(default_factory=list)  # " word word "
    cut: float = 1.0

    def automaton(self) -> ahocorasick.Automaton:
        found = ahocorasick.Automaton()
        for phrase in self.exceptions:
            found.add_word(phrase, (len(phrase), -1.0))
        for term, weight in self.terms.items():
            found.add_word(term, (len(term), weight))
        found.make_automaton()
        return found

    def hits(self, text: str, automaton: ahocorasick.Automaton) -> dict[int, float]:
        """Weight of the heaviest term at each place of a folded text, less the exceptions."""
        if not len(automaton):
            return {}
        at: dict[int, float] = {}
        spared: list[tuple[int, int]] = []
        for end, (n, weight) in automaton.iter(text):
            start = end - n + 1
            if weight < 0:
                spared.append((start, end))
            else:
                at[start] = max(at.get(start, 0.0), weight)
        for start, end in spared:
            for place in range(start, end):
                at.pop(place, None)
        return at

    def strength(self, text: str, automaton: ahocorasick.Automaton) -> float:
        weight = sum(self.hits(text, automaton).values())
        return weight / max(1, text.count(" ") - 1) ** LENGTH_POWER

    def score(self, strength: float) -> float:
        if strength <= 0:
            return 0.0
        odds = (1 - CUT_SCORE) / CUT_SCORE * (self.cut / strength) ** STEEPNESS
        return 1 / (1 + odds)


def stems(text: str) -> set[str]:
    """Candidate terms of a folded text: whole words and their beginnings."""
    out = set()
    for word in set(text.split()):
        out.add(f" {word} ")
        out.update(f" {word[:k]}" for k in range(SHORTEST, min(len(word) - 1, LONGEST) + 1))
    return out


def pairs_around(text: str, lexicon: Lexicon, automaton: ahocorasick.Automaton) -> set[str]:
    """Word pairs of a folded text that hold a hit."""
    out = set()
    for start in lexicon.hits(text, automaton):
        before = text.rfind(" ", 0, start) if start else -1
        end = text.find(" ", start + 1)
        after = text.find(" ", end + 1) if end >= 0 else -1
        if before >= 0 and end >= 0:
            out.add(text[before : end + 1])
        if after >= 0:
            out.add(text[start : after + 1])
    return out


def _counted(sample: DataFrame, of) -> DataFrame:
    """(term, bad, good): in how many sample documents of each class a term occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = {0: Counter(), 1: Counter()}
        pick = of()
        for batch in batches:
            for text, bad in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                counts[bad].update(pick(folded(text)))
        terms = list(counts[0].keys() | counts[1].keys())
        for at in range(0, len(terms), 50_000):
            part = terms[at : at + 50_000]
            yield pa.RecordBatch.from_pydict(
                {"term": part, "bad": pa.array([counts[1][t] for t in part], pa.int64()), "good": pa.array([counts[0][t] for t in part], pa.int64())}
            )

    return sample.select("text", "bad").mapInArrow(run, "term string, bad bigint, good bigint").groupBy("term").agg(
        F.sum("bad").alias("bad"), F.sum("good").alias("good")
    )


def _weights(rows: list, n_bad: int, n_good: int, least_weight: float) -> dict[str, float]:
    """Terms with clear odds; a longer one only where it is much clearer than its beginning."""
    odds = {
        term: float(np.log((bad + 0.5) / (n_bad + 1)) - np.log((good + 0.5) / (n_good + 1))) for term, bad, good in rows
    }
    kept: dict[str, float] = {}
    for term in sorted(odds, key=lambda t: (len(t), t)):
        own = odds[term]
        shorter = max((kept.get(term[:k], -9.0) for k in range(SHORTEST + 1, len(term))), default=-9.0)
        if own >= least_weight and own > shorter + 2.0:
            kept[term] = own
    return kept


def fit_lexicon(
    labelled: DataFrame,
    sample: int = CLASS_SAMPLE,
    least_docs: int = 5,
    least_share: float = 0.004,
    least_weight: float = 3.5,
    exceptions: tuple[str, ...] = (),
    seed: int = 11,
) -> Lexicon:
    """Learn from rows of (doc_id, text, bad), bad being 0 or 1.

    A term must occur in ``least_docs`` and in ``least_share`` of the sampled
    toxic documents; with the sample this bounds the lexicon.
    """
    of_class = [bounded_sample(labelled.filter(F.col("bad") == k), "doc_id", sample, seed + k) for k in (0, 1)]
    picked = settle(of_class[0].unionByName(of_class[1]).select("text", "bad"), "sample")
    sizes = dict(picked.groupBy("bad").count().collect())
    n_good, n_bad = sizes.get(0, 0), sizes.get(1, 0)
    least = max(least_docs, least_share * n_bad)
    common = _counted(picked, lambda: stems).filter(F.col("bad") >= least)
    lexicon = Lexicon(_weights([tuple(r) for r in common.collect()], n_bad, n_good, least_weight), [folded(e) for e in exceptions])

    def around():
        automaton = lexicon.automaton()
        return lambda text: pairs_around(text, lexicon, automaton)

    if lexicon.terms:
        spared = _counted(picked, around).filter((F.col("good") >= least_docs) & (F.col("good") * n_bad > F.col("bad") * n_good))
        lexicon.exceptions += sorted(r.term for r in spared.collect())
        strengths = _strengths(picked, lexicon).toPandas()
        lexicon.cut = best_cut(strengths["strength"].to_numpy(), strengths["bad"].to_numpy())
    return lexicon


def _strengths(rows: DataFrame, lexicon: Lexicon) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = lexicon.automaton()
        for batch in batches:
            values = [lexicon.strength(folded(t), automaton) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(values, pa.float64()), batch.column(1)], names=["strength", "bad"])

    return rows.select("text", F.col("bad").cast("int").alias("bad")).mapInArrow(run, "strength double, bad int")


def best_cut(strength: np.ndarray, bad: np.ndarray) -> float:
    """Middle, on a log scale, of the gap with the best F1 for the toxic class."""
    order = np.argsort(-strength, kind="stable")
    s, hit = strength[order], np.cumsum(bad[order])
    called = np.arange(1, len(s) + 1)
    f1 = 2 * hit / (called + max(1, bad.sum()))
    ends = np.append(s[1:] < s[:-1], True) & (s > 0)
    if not ends.any():
        return 1.0
    k = int(np.argmax(np.where(ends, f1, -1)))
    below = s[k + 1] if k + 1 < len(s) and s[k + 1] > 0 else s[k] / 4
    return float(np.sqrt(s[k] * below))


def score_toxicity(docs: DataFrame, lexicon: Lexicon, text: str = "text") -> DataFrame:
    """The rows with ``score`` and ``predicted`` appended."""
    kept = [c for c in docs.columns if c not in ("score", "predicted")]
    rows = docs.select(*kept)
    place = kept.index(text)
    spec = docs.sparkSession.createDataFrame([], rows.schema).selectExpr("*", "0D score", "0 predicted").schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = lexicon.automaton()
        for batch in batches:
            for part in pieces(batch):
                scores = [lexicon.score(lexicon.strength(folded(t), automaton)) for t in part.column(place).to_pylist()]
                called = [int(s >= CUT_SCORE) for s in scores]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(scores, pa.float64()), pa.array(called, pa.int32())], names=[*part.schema.names, "score", "predicted"]
                )

    return rows.mapInArrow(run, spec)

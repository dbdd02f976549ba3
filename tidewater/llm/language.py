"""Language identification by one bit-sliced Bloom filter over character n-grams.

A slot of the table is a bit mask with one bit for each language, so the slots
of an n-gram's hashes, combined by AND, name every language that may contain it.
The languages' counts over a text are corrected for the rate of false positives
of their bit slice; the largest corrected share decides.

A language contains an n-gram when the n-gram is frequent enough in its texts
and not an accident beside the language that uses it most, so that a few foreign
words do not spread a language's bits.

Null texts and texts without a letter get ``und`` with score 0.  Of languages
with equal shares the first by name wins.  Repeated rows are rows of their own in
the fit and in prediction; an empty table, or one without labels, teaches no
language and every text is ``und``.  The whole text is read.  Only the fit is bounded: ``sample`` documents for each language.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewater.llm.common import mix, pieces, unit_draw
from tidewater.operators.relational import small
from tidewater.session import settle

GRAM = 4
PROBES = 2
BLANK = 32
UNKNOWN = "und"


def letter_table() -> np.ndarray:
    """Code point -> itself for letters, else blank."""
    table = np.full(0x110000, BLANK, dtype=np.uint32)
    letters = np.fromiter((c for c in range(0x110000) if chr(c).isalpha()), dtype=np.uint32)
    table[letters] = letters
    return table


def grams(text: str, letters: np.ndarray, n: int) -> np.ndarray:
    """Codes of all n-grams of the lower-cased letters; runs of others are one blank."""
    codes = np.frombuffer((" " + text.lower() + " ").encode("utf-32-le", "surrogatepass"), dtype="<u4")
    codes = letters[codes]
    codes = codes[np.concatenate([[True], (codes[1:] != BLANK) | (codes[:-1] != BLANK)])].astype(np.uint64)
    if len(codes) < 3:
        return codes[:0]
    if len(codes) < n:
        codes = np.concatenate([codes, np.full(n - len(codes), BLANK, dtype=np.uint64)])
    out = codes[: len(codes) - n + 1].copy()
    for j in range(1, n):
        out = (out << np.uint64(16)) ^ (out >> np.uint64(48)) ^ codes[j : len(codes) - n + 1 + j]
    return out


@dataclass
class LanguageFilter:
    languages: list[str]
    table: np.ndarray  # language bits of every slot
    false_rate: np.ndarray  # of each language's bit slice
    n: int = GRAM

    def masks(self, codes: np.ndarray) -> np.ndarray:
        found = None
        for probe in range(PROBES):
            slot = mix(codes, probe + 1) & np.uint64(len(self.table) - 1)
            bits = self.table[slot.astype(np.int64)]
            found = bits if found is None else found & bits
        return found

    def shares(self, codes: np.ndarray) -> np.ndarray:
        """Corrected share of the n-grams that each language contains."""
        masks = self.masks(codes)
        counts = np.array([np.count_nonzero(masks & masks.dtype.type(1 << k)) for k in range(len(self.languages))], dtype=float)
        n = len(codes)
        return np.clip((counts - n * self.false_rate) / (1 - self.false_rate) / max(n, 1), 0, 1)

    def decide(self, text: str | None, letters: np.ndarray) -> tuple[str, float, float]:
        """Language, score and the corrected share of its n-grams."""
        codes = grams(text, letters, self.n) if text else np.zeros(0, dtype=np.uint64)
        if not len(codes) or not self.languages:
            return UNKNOWN, 0.0, 0.0
        shares = self.shares(codes)
        best = int(shares.argmax())
        total = shares.sum()
        return self.languages[best], float(shares[best] / total) if total else 0.0, float(shares[best])


def build_filter(of: np.ndarray, codes: np.ndarray, n: int) -> LanguageFilter:
    """Filter from parallel arrays of languages and n-gram codes, about 12 bits a code."""
    languages = sorted(set(of))
    if len(languages) > 64:
        raise ValueError("one mask word holds 64 languages")
    kind = np.dtype(f"uint{next(b for b in (8, 16, 32, 64) if b >= max(1, len(languages)))}")
    size = 1 << max(10, int(np.ceil(np.log2(max(1, len(codes)) * 12))))
    table = np.zeros(size, dtype=kind)
    for k, language in enumerate(languages):
        own = codes[of == language].astype(np.int64).view(np.uint64)
        for probe in range(PROBES):
            slots = (mix(own, probe + 1) & np.uint64(size - 1)).astype(np.int64)
            table[slots] |= kind.type(1 << k)
    fill = np.array([np.count_nonzero(table & kind.type(1 << k)) / size for k in range(len(languages))])
    return LanguageFilter(languages, table, np.minimum(fill**PROBES, 0.99), n)


def fit_languages(
    docs: DataFrame,
    label: str = "lang",
    text: str = "text",
    sample: int = 1500,
    n: int = GRAM,
    most_grams: int = 40_000,
    least_count: int = 3,
    least_ratio: float = 0.05,
    seed: int = 7,
) -> LanguageFilter:
    """Learn from at most about ``sample`` documents of each non-null label.

    ``most_grams`` most frequent n-grams of a language are kept, so the model
    has a fixed bound.
    """
    known = docs.filter(F.col(label).isNotNull() & F.col(text).isNotNull())
    sizes = settle(known.groupBy(label).agg(F.count("*").alias("_n")), "labels")
    picked = known.join(small(sizes), label).filter(
        unit_draw(F.xxhash64(text), F.lit(seed)) < F.lit(float(sample)) / F.col("_n")
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = letter_table()
        for batch in batches:
            found: dict[str, list[np.ndarray]] = {}
            for language, body in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found.setdefault(language, []).append(grams(body, letters, n))
            for language, parts in found.items():
                codes, times = np.unique(np.concatenate(parts), return_counts=True)
                yield pa.RecordBatch.from_pydict(
                    {"lang": pa.array([language] * len(codes), pa.string()), "code": pa.array(codes.view(np.int64)), "times": pa.array(times, pa.int64())}
                )

    counted = picked.select(label, text).mapInArrow(count, "lang string, code bigint, times bigint")
    counted = settle(counted.groupBy("lang", "code").agg(F.sum("times").alias("times")), "grams")
    shared = counted.join(small(counted.groupBy("lang").agg(F.sum("times").alias("_all"))), "lang")
    shared = shared.withColumn("f", F.col("times") / F.col("_all"))
    top = shared.groupBy("code").agg(F.max("f").alias("_top"))
    own = shared.join(top, "code").filter((F.col("times") >= least_count) & (F.col("f") >= F.col("_top") * least_ratio))
    # the sample bounds what a language brings here
    nth = F.row_number().over(W.partitionBy("lang").orderBy(F.desc("f"), "code"))
    best = own.withColumn("_nth", nth).filter(F.col("_nth") <= most_grams).select("lang", "code").toPandas()
    return build_filter(best["lang"].to_numpy(), best["code"].to_numpy(), n)


def predict_languages(docs: DataFrame, model: LanguageFilter, text: str = "text") -> DataFrame:
    """The rows with ``lang_pred``, ``score`` and ``lang_share`` appended."""
    known = [f for f in docs.schema.fields if f.name not in ("lang_pred", "score", "lang_share")]
    rows = docs.select(*[f.name for f in known])
    place = rows.columns.index(text)
    spec = docs.sparkSession.createDataFrame([], rows.schema).selectExpr(
        "*", "'' lang_pred", "0D score", "0D lang_share"
    ).schema

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = letter_table()
        for batch in batches:
            for part in pieces(batch):
                found = [model.decide(t, letters) for t in part.column(place).to_pylist()]
                made = [pa.array([f[k] for f in found], kind) for k, kind in enumerate((pa.string(), pa.float64(), pa.float64()))]
                yield pa.RecordBatch.from_arrays([*part.columns, *made], names=[*part.schema.names, "lang_pred", "score", "lang_share"])

    return rows.mapInArrow(predict, spec)

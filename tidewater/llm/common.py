"""Words, hashes and table helpers shared by the corpus operators.

A word is a run of bytes other than blank and the control characters 09 to 0D,
which is what ``bytes.split()`` yields.  Hashes are 64 bits wide and depend on
nothing but the bytes, so a re-run task repeats them.
"""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
CACHE_WORDS = 400_000

# Odd multipliers of the hash finisher (public splitmix64).
MIX_A = np.uint64(0xBF58476D1CE4E5B9)
MIX_B = np.uint64(0x94D049BB133111EB)
STEP = 0x9E3779B97F4A7C15


def per_worker(key: tuple, make: Callable[[], Any]) -> Any:
    """An object that later tasks of the same Python worker find again.

    Task functions travel by value, so their own globals last for one task; a
    module of its own outlives it.  What is kept must be bounded and must not
    change results.
    """
    home = sys.modules.setdefault("_tidewater_worker", types.ModuleType("_tidewater_worker"))
    if key not in home.__dict__:
        home.__dict__[key] = make()
    return home.__dict__[key]


class WordHashes(dict):
    """word -> 64-bit hash, remembered for up to CACHE_WORDS words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def hash_words(words: list[bytes], seen: WordHashes) -> np.ndarray:
    return np.fromiter(map(seen.__getitem__, words), dtype=np.uint64, count=len(words))


def mix(h: np.ndarray, salt: int = 0) -> np.ndarray:
    h = h + np.uint64(salt * STEP & 0xFFFFFFFFFFFFFFFF)
    h ^= h >> np.uint64(30)
    h *= MIX_A
    h ^= h >> np.uint64(27)
    h *= MIX_B
    h ^= h >> np.uint64(31)
    return h


def rolled(h: np.ndarray, n: int) -> np.ndarray:
    """One hash for every n neighbouring word hashes."""
    if len(h) < n:
        return h[:0]
    out = np.zeros(len(h) - n + 1, dtype=np.uint64)
    for j in range(n):
        out ^= h[j : len(h) - n + 1 + j]
        out *= MIX_A
        out ^= out >> np.uint64(29)
    return out


def raw(column: pa.Array) -> list[bytes | None]:
    """UTF-8 bytes of a string column, without decoding them."""
    return column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()


def pieces(batch: pa.RecordBatch, rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Small slices of a batch, so that output rows stay bounded too."""
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def lists(parts: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    """List column from one array for each row."""
    ends = np.zeros(len(parts) + 1, dtype=np.int32)
    np.cumsum([len(p) for p in parts], out=ends[1:])
    flat = np.concatenate(parts) if parts else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, type=kind))


def remainder(id_col: str | Column) -> Column:
    """crc32 of the id as text, mod 3: the fold that models may learn from."""
    return F.pmod(F.crc32(F.col(id_col).cast("string") if isinstance(id_col, str) else id_col.cast("string")), F.lit(3))


def held_out(id_col: str) -> Column:
    """Remainder 1 is held out; a row without an id is neither held out nor learnt from."""
    return F.coalesce(remainder(id_col) == 1, F.lit(False))


def unit_draw(*cols: Column) -> Column:
    """Repeatable number in [0, 1) from the given columns."""
    return F.shiftrightunsigned(F.xxhash64(*cols), 11) / F.lit(float(1 << 53))


def bounded_sample(df: DataFrame, id_col: str, most: int, seed: int) -> DataFrame:
    """About ``most`` rows at most, by a hash of the id, so that re-runs agree."""
    n = df.count()
    return df if n <= most else df.filter(unit_draw(F.col(id_col), F.lit(seed)) < F.lit(most / n))

"""Token counts without a shuffle of pre-tokens: two tiers of lookup beside the rows.

A piece is a maximal run of bytes other than blanks and the controls 09 to 0D.
A tokenizer that turns every run of white space into one blank and drops blanks
when it splits never joins pieces, so the tokens of a text are those of its
pieces.

First tier: the table of frequent pieces.  Every task sums up its own share of
the corpus and reports its most frequent pieces only; the reports are added up,
the most frequent pieces are measured by the library, and their lengths are
broadcast as one packed table of a fixed largest size.  Second tier: a piece
that the table lacks is measured once by each worker and remembered in a cache
of bounded size.  Both tiers hold lengths that the library gave, so neither
changes a result; a tokenizer of another kind gets whole texts.

A null text is an empty one: no bytes, no tokens.  Rows are independent of each
other; repeated rows, null ids and further columns pass through, but columns
named like the three appended ones are replaced.
"""

from __future__ import annotations

import json
import os
import re
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm.common import per_worker, pieces, raw

TABLE_PIECES = 65_536  # entries of the broadcast table
PIECE_BYTES = 32  # longest piece of the table
TASK_PIECES = 4_096  # pieces that a task reports
TALLY_PIECES = 400_000  # pieces that a task counts at a time
CACHE_PIECES = 400_000  # pieces that a worker remembers
CACHE_BYTES = 64  # longest piece that it remembers
BLOCK = 1 << 20  # bytes of a text split at a time
BATCH_BYTES = 4 << 20

BLANK = re.compile(rb"[\x20\x09-\x0D]")
MARKS = b".,;:!?"


Packed = tuple[bytes, bytes]  # pieces parted by blanks, and two bytes of token count for each
NOTHING: Packed = (b"", b"")


def unpacked(table: Packed) -> dict[bytes, int]:
    return dict(zip(table[0].split(), np.frombuffer(table[1], "<u2").tolist(), strict=True))


def blocks(body: bytes) -> Iterator[bytes]:
    """A text in parts of about BLOCK bytes that end at a blank."""
    at = 0
    while at < len(body):
        found = BLANK.search(body, at + BLOCK) if len(body) - at > BLOCK else None
        end = found.start() if found else len(body)
        yield body[at:end]
        at = end


class Library:
    """Token counts as the tokenizer's own library gives them."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.splits = False
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self.count = lambda texts: [len(ids) for ids in model.encode(texts, num_threads=1)]
            return
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        self.count = lambda texts: [len(e) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        self.splits = drops_blanks(path)


def drops_blanks(path: str) -> bool:
    """Whether a tokenizer file makes white space one blank, and drops it when it splits."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    parts = spec["normalizer"] or {}
    steps = parts.get("normalizers", [parts])
    kinds = [s.get("type") for s in steps]
    split = spec["pre_tokenizer"] or {}
    first = split.get("pretokenizers", [split])[0]
    plain = all(t["content"].split() == [t["content"]] and not (t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"]) for t in spec["added_tokens"])
    return (
        plain
        and kinds == ["NFC", "Replace", "Lowercase"]
        and steps[1]["pattern"] == {"Regex": r"\s+"}
        and steps[1]["content"] == " "
        and first.get("type") == "Split"
        and first["behavior"] == "Removed"
        and first["invert"]
        and first["pattern"].get("Regex", "").endswith(r"|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
    )


class PieceLengths(dict):
    """piece -> token count: the broadcast table, then what this worker has measured.

    A piece is measured in lower case, which the tokenizer would take anyway, and
    a last mark behind a Latin letter apart, for the tokenizer splits there.  A
    piece that may hold an added token goes to the library as it stands.
    """

    def __init__(self, path: str, table: Packed) -> None:
        self.library = Library(path)
        self.table = unpacked(table)
        super().__init__(self.table)
        marks = self.library.count([chr(m) for m in MARKS])
        self.marks = dict(zip(MARKS, marks, strict=True))

    @staticmethod
    def parts(piece: bytes) -> tuple[bytes, int]:
        """What the library measures of a piece, and its last mark or 0."""
        if b"<|" in piece:
            return piece, 0
        piece = piece.lower()
        if len(piece) > 1 and piece[-1] in MARKS and 97 <= piece[-2] <= 122:
            return piece[:-1], piece[-1]
        return piece, 0

    def learn(self, words: list[bytes]) -> dict[bytes, int]:
        """Measure the unknown ones; those too long to keep are returned."""
        fresh = {w for w in words if w not in self}
        if not fresh:
            return {}
        if len(self) + len(fresh) > TABLE_PIECES + CACHE_PIECES:
            self.clear()
            self.update(self.table)
            fresh = {w for w in words if w not in self}
        split = {w: self.parts(w) for w in fresh}
        bodies = list({b for b, _ in split.values() if b not in self})
        counts = self.library.count([b.decode("utf-8", "replace") for b in bodies])
        found = dict(zip(bodies, counts, strict=True))
        long = {}
        for word, (body, mark) in split.items():
            n = found[body] if body in found else self[body]
            n += self.marks[mark] if mark else 0
            (self if len(word) <= CACHE_BYTES else long)[word] = n
        self.update((b, n) for b, n in found.items() if len(b) <= CACHE_BYTES)
        return long

    def total(self, words: list[bytes]) -> int:
        long = self.learn(words)
        return sum(map(self.__getitem__, words)) if not long else sum(long[w] if w in long else self[w] for w in words)


def tally(batches: Iterator[list[bytes | None]]) -> Counter:
    """Piece counts of a task in bounded memory: when full, the rarer half is let go."""
    seen: Counter = Counter()
    for bodies in batches:
        for body in bodies:
            for block in blocks(body or b""):
                seen.update(block.split())
                if len(seen) > TALLY_PIECES:
                    middle = sorted(seen.values())[len(seen) // 2]
                    seen = Counter({w: n for w, n in seen.items() if n > middle})
    return seen


def frequent_pieces(docs: DataFrame, tokenizer: str, text: str = "text", most: int = TABLE_PIECES) -> Packed:
    """Lengths of the corpus's most frequent pieces, ``most`` at the most.

    All documents count.  What moves is a report of TASK_PIECES rows from each
    task, never the pieces themselves.
    """

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = tally(raw(batch.column(0)) for batch in batches)
        best = [(w, n) for w, n in seen.most_common(TASK_PIECES) if len(w) <= PIECE_BYTES]
        yield pa.RecordBatch.from_pydict(
            {"piece": pa.array([w for w, _ in best], pa.binary()), "n": pa.array([n for _, n in best], pa.int64())}
        )

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = per_worker(("library", tokenizer), lambda: Library(tokenizer))
        for batch in batches:
            words = batch.column(0).to_pylist()
            counts = library.count([w.decode("utf-8", "replace") for w in words])
            yield pa.RecordBatch.from_pydict({"piece": pa.array(words, pa.binary()), "length": pa.array(counts, pa.int32())})

    reports = docs.select(text).mapInArrow(report, "piece binary, n bigint").groupBy("piece").agg(F.sum("n").alias("n"))
    top = reports.orderBy(F.desc("n"), "piece").limit(most).select("piece")
    rows = top.mapInArrow(measure, "piece binary, length int").collect()
    return b" ".join(bytes(r.piece) for r in rows), np.array([r.length for r in rows], "<u2").tobytes()


def count_tokens(docs: DataFrame, tokenizer: str, text: str = "text", limit: int = 2048) -> DataFrame:
    """The rows with ``n_bytes``, ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens) appended.

    Counts are those of the library without added special tokens, truncation or
    padding; special strings inside a text count as the library takes them.
    """
    made = ("n_bytes", "n_tokens", "over_limit")
    rows = docs.select(*[c for c in docs.columns if c not in made])
    place = rows.columns.index(text)
    spec = docs.sparkSession.createDataFrame([], rows.schema).selectExpr("*", "0L n_bytes", "0L n_tokens", "false over_limit").schema
    splits, made_once = Library(tokenizer).splits, uuid.uuid4().hex
    table = docs.sparkSession.sparkContext.broadcast(frequent_pieces(rows, tokenizer, text) if splits else NOTHING)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = ("lengths", tokenizer, made_once)
        if splits:
            known = per_worker(key, lambda: PieceLengths(tokenizer, table.value))
        else:
            library = per_worker(("library", tokenizer), lambda: Library(tokenizer))
        for batch in batches:
            for part in pieces(batch):
                bodies = [b or b"" for b in raw(part.column(place))]
                if splits:
                    counts = [sum(known.total(block.split()) for block in blocks(b)) for b in bodies]
                else:
                    counts = library.count([b.decode("utf-8", "replace") for b in bodies])
                new = [
                    pa.array([len(b) for b in bodies], pa.int64()),
                    pa.array(counts, pa.int64()),
                    pa.array([n > limit for n in counts], pa.bool_()),
                ]
                yield pa.RecordBatch.from_arrays([*part.columns, *new], names=[*part.schema.names, *made])

    return rows.mapInArrow(count, spec)

"""Token ids in raw binary files, found by key through a minimal perfect hash.

A shard is two files.  ``<name>.ids`` holds nothing but ids, little-endian, two
bytes each when the vocabulary allows and else four, documents in ascending key
order.  ``<name>.idx`` holds the index: displacements of the hash buckets and,
for every slot, a 32-bit fingerprint of its key and the place and length of its
ids, then the keys in document order.  A lookup hashes the key once, reads one
displacement and one slot, and compares the fingerprint.

A task writes under a name of its own and reports it in its manifest row, so a
repeated task leaves a stray file but never a wrong one.  Paths go through
Arrow's file systems: ``file:``, ``hdfs:`` and object stores alike.

A null text is an empty one.  Rows that share an id, a null id included, keep
apart as occurrences 0, 1, ... of the id within their shard, ordered by a hash
of the text.
"""

from __future__ import annotations

import os
import string
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewater.llm.common import per_worker, pieces
from tidewater.session import scratch_path, settle

MAGIC = b"TIDX0001"
HEAD = "<8sIQQ"  # magic, bytes of an id, keys, buckets
KEY = "<?qI"  # null, id, occurrence
KEYS_A_BUCKET = 4
TRIES = 64
CACHE_PIECES = 400_000
CACHE_MARKS = 10_000
MOST_MARKS = 8  # at a piece's end that are cut off it
ROW_PIECES = 1000  # pieces spelt as one text
DOCS_A_SHARD = 8192


# ---- encoding


class PieceIds(dict):
    """Blank-separated piece -> raw ids as they stand after a blank.

    The byte-level pattern never joins across a single blank between two
    characters that are not blanks, nor across a line feed between two such, so
    a text's ids are those of its pieces.  Marks after a letter are a piece of
    their own as well.  A piece beginning with a line feed has no blank before
    it.  Pieces of any other make have no ids here; the tokenizer then gets the
    whole text.

    Two generations of entries are kept: when the younger is full it becomes the
    older one, so frequent pieces stay and memory is bounded.
    """

    def __init__(self, encode_all) -> None:
        super().__init__()
        self.encode_all = encode_all
        self.older: dict[str, bytes] = {}
        self.marks: dict[str, bytes] = {}

    @staticmethod
    def sound(piece: str) -> bool:
        if not piece or piece[-1].isspace():
            return False
        return not piece[piece[0] == "\n"].isspace()

    @staticmethod
    def stem(piece: str) -> str:
        """The piece less the marks that follow its last letter."""
        stem = piece.rstrip(string.punctuation)
        return stem if stem and len(piece) - len(stem) <= MOST_MARKS and stem[-1].isalpha() else piece

    def marked(self, stem: bytes, marks: str) -> bytes:
        if marks not in self.marks:
            if len(self.marks) >= CACHE_MARKS:
                self.marks.clear()
            self.marks[marks] = self.encode_all([marks])[0]
        return stem + self.marks[marks]

    def learn(self, pieces: set[str]) -> dict[str, bytes]:
        """Ids of the sound ones of some pieces that the younger generation lacks."""
        found, new, older = {}, [], self.older
        for p in pieces:
            ids = older.get(p)
            if ids is not None:
                found[p] = ids
            elif p.isalpha() or self.sound(p):
                new.append((p, p if p[-1].isalpha() else self.stem(p)))
        stems = {}
        for _, stem in new:
            stems[stem] = found.get(stem) or self.get(stem) or older.get(stem)
        fresh = [stem for stem, ids in stems.items() if ids is None]
        stems.update(zip(fresh, self.encode_all([p if p[0] == "\n" else " " + p for p in fresh]), strict=True))
        found.update(stems)
        for p, stem in new:
            if len(stem) < len(p):
                found[p] = self.marked(stems[stem], p[len(stem) :])
        if len(self) + len(found) > CACHE_PIECES:
            self.older = dict(self)
            self.clear()
        self.update(found)
        return found


class Encoder:
    """Whole texts to raw ids with a tokenizer file."""

    def __init__(self, tokenizer: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.kind = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.code = "H" if self.kind.itemsize == 2 else "I"
        self.byte_level = "ByteLevel" in repr(self.tokenizer.pre_tokenizer) and self.tokenizer.normalizer is None
        self.pieces = PieceIds(self.in_a_row) if self.byte_level else None
        # a byte-level token is spelt with one character for each byte
        self.bytes_of = np.zeros(self.tokenizer.get_vocab_size(), dtype=np.int64)
        for token, i in self.tokenizer.get_vocab(with_added_tokens=False).items():
            self.bytes_of[i] = len(token)

    def plain(self, texts: list[str]) -> list[bytes]:
        """The tokenizer's own ids."""
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [struct.pack(f"<{len(f.ids)}{self.code}", *f.ids) for f in found]

    def in_a_row(self, pieces: list[str]) -> list[bytes]:
        """Ids of sound pieces with what stands before them, many spelt as one text and cut by their bytes."""
        out: list[bytes] = []
        for at in range(0, len(pieces), ROW_PIECES):
            row = pieces[at : at + ROW_PIECES]
            text = "".join(row)
            if len(row) > 1 and not any(a in text for a in self.added):
                ids = np.frombuffer(self.plain([text])[0], dtype=self.kind)
                ends = np.cumsum(self.bytes_of[ids])
                wanted = np.cumsum([len(p) if p.isascii() else len(p.encode()) for p in row])
                last = np.searchsorted(ends, wanted)
                if last[-1] < len(ends) and (ends[last] == wanted).all():
                    raw, cuts = ids.tobytes(), [0, *((last + 1) * self.kind.itemsize).tolist()]
                    out += [raw[i:j] for i, j in zip(cuts, cuts[1:], strict=False)]
                    continue
            out += self.plain(row)
        return out

    def __call__(self, texts: list[str]) -> list[bytes]:
        if not self.byte_level:
            return self.plain(texts)
        # a text that spells an added token goes to the library whole
        split = [None if any(a in t for a in self.added) else t.replace("\n", " \n").split(" ") for t in texts]
        known = self.pieces.get
        rows = [None if words is None else list(map(known, words[1:])) for words in split]
        gaps = [[i for i, ids in enumerate(row) if ids is None] if row else [] for row in rows]
        learnt = self.pieces.learn({words[i + 1] for words, at in zip(split, gaps, strict=True) for i in at})
        firsts = iter(self.plain([w[0] for w in split if w]))
        out = []
        for text, words, row, at in zip(texts, split, rows, gaps, strict=True):
            try:
                if words is None:
                    raise KeyError(text)
                first = next(firsts)
                if len(words) > 1 and not (self.pieces.sound(words[0]) and words[0][0] != "\n"):
                    raise KeyError(words[0])
                for i in at:
                    row[i] = learnt[words[i + 1]]
                out.append(first + b"".join(row))
            except KeyError:
                out += self.plain([text])
        return out


# ---- minimal perfect hash


def key_hashes(keys: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of every key; the second one's low half is the fingerprint."""
    a = np.fromiter((xxhash.xxh3_64_intdigest(k, 1) for k in keys), dtype=np.uint64, count=len(keys))
    b = np.fromiter((xxhash.xxh3_64_intdigest(k, 2) for k in keys), dtype=np.uint64, count=len(keys))
    return a, b


def slot_of(a: np.ndarray, b: np.ndarray, d: np.ndarray, n: int) -> np.ndarray:
    """Slot of a key whose bucket has displacement d; below 0 the slot itself."""
    h = (a + d.astype(np.uint64) * (b | np.uint64(1))) >> np.uint64(11)
    return np.where(d < 0, -d - 1, (h % np.uint64(max(n, 1))).astype(np.int64))


def build_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Displacement of each bucket so that all keys get different slots of 0..n-1.

    Buckets are placed from the fullest on; the last ones, of one key, take what
    is free.
    """
    n = len(a)
    buckets = max(1, -(-n // KEYS_A_BUCKET))
    shift = np.zeros(buckets, dtype=np.int64)
    if not n:
        return shift
    of = (a % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(of, kind="stable")
    edges = np.searchsorted(of[order], np.arange(buckets + 1))
    sizes = np.diff(edges)
    taken = np.zeros(n, dtype=bool)
    for k in np.argsort(-sizes, kind="stable"):
        if sizes[k] < 2:
            break
        own = order[edges[k] : edges[k + 1]]
        first = 0
        while True:
            d = np.arange(first, first + TRIES, dtype=np.int64)
            at = np.sort(slot_of(a[own][None, :], b[own][None, :], d[:, None], n), axis=1)
            fits = ~taken[at].any(axis=1) & (at[:, 1:] != at[:, :-1]).all(axis=1)
            if fits.any():
                shift[k] = d[fits.argmax()]
                taken[at[fits.argmax()]] = True
                break
            first += TRIES
    free = np.flatnonzero(~taken)
    ones = np.flatnonzero(sizes == 1)
    shift[ones] = -free - 1
    return shift


class ShardIndex:
    """A shard's index in memory: keyed access in constant time."""

    def __init__(self, blob: bytes) -> None:
        magic, self.width, self.n, buckets = struct.unpack_from(HEAD, blob)
        if magic != MAGIC:
            raise ValueError("not a token index")
        at = struct.calcsize(HEAD)
        parts = []
        for kind, count in (("<i8", buckets), ("<u4", self.n), ("<u8", self.n), ("<u8", self.n)):
            parts.append(np.frombuffer(blob, dtype=kind, count=count, offset=at))
            at += parts[-1].nbytes
        self.shift, self.print, self.start, self.length = parts
        step = struct.calcsize(KEY)
        self.keys = [blob[at + i * step : at + (i + 1) * step] for i in range(self.n)]

    @staticmethod
    def pack(keys: list[bytes], start: np.ndarray, length: np.ndarray, width: int) -> bytes:
        a, b = key_hashes(keys)
        shift = build_hash(a, b)
        slot = slot_of(a, b, shift[(a % np.uint64(len(shift))).astype(np.int64)], len(keys))
        by_slot = np.argsort(slot)
        marks = (b & np.uint64(0xFFFFFFFF)).astype("<u4")[by_slot]
        head = struct.pack(HEAD, MAGIC, width, len(keys), len(shift))
        columns = (shift.astype("<i8"), marks, start.astype("<u8")[by_slot], length.astype("<u8")[by_slot])
        return head + b"".join(c.tobytes() for c in columns) + b"".join(keys)

    def find(self, keys: list[bytes]) -> np.ndarray:
        """Slot of each key, or -1 where the fingerprint differs."""
        if not self.n or not keys:
            return np.full(len(keys), -1, dtype=np.int64)
        a, b = key_hashes(keys)
        slot = slot_of(a, b, self.shift[(a % np.uint64(len(self.shift))).astype(np.int64)], self.n)
        return np.where(self.print[slot] == (b & np.uint64(0xFFFFFFFF)).astype("<u4"), slot, -1)


# ---- files


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


MANIFEST = "part int, name string, n_docs bigint, n_ids bigint, width int"


def _writer(folder: str, tokenizer: str, end_id: int | None):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        part, name = task.partitionId(), f"{task.partitionId():06d}-{task.taskAttemptId()}"
        encode = per_worker(("byte pairs", tokenizer), lambda: Encoder(tokenizer))
        end = b"" if end_id is None else np.array([end_id], dtype=encode.kind).tobytes()
        store, root = _opened(folder)
        store.create_dir(root, recursive=True)
        keys, lengths, last, nth = [], [], None, 0
        with store.open_output_stream(f"{root}/{name}.ids") as out:
            for batch in batches:
                for slim in pieces(batch):
                    ids = slim.column(0).to_pylist()
                    for key, body in zip(ids, encode(slim.column(1).to_pylist()), strict=True):
                        nth = nth + 1 if keys and key == last else 0
                        last = key
                        keys.append(struct.pack(KEY, key is None, key or 0, nth))
                        body += end
                        lengths.append(len(body) // encode.kind.itemsize)
                        out.write(body)
        length = np.array(lengths, dtype=np.int64)
        with store.open_output_stream(f"{root}/{name}.idx") as out:
            out.write(ShardIndex.pack(keys, np.cumsum(length) - length, length, encode.kind.itemsize))
        yield pa.RecordBatch.from_pydict(
            {"part": pa.array([part], pa.int32()), "name": [name], "n_docs": pa.array([len(keys)], pa.int64()),
             "n_ids": pa.array([int(length.sum())], pa.int64()), "width": pa.array([encode.kind.itemsize], pa.int32())}
        )

    return write


def write_token_files(
    docs: DataFrame,
    tokenizer: str,
    folder: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int | None = 0,
    docs_a_shard: int = DOCS_A_SHARD,
) -> tuple[str, DataFrame]:
    """Encode and write all documents in ascending id order, nulls first.

    Returns the folder and the manifest: a row for each shard with its name,
    counts and first id's position.
    """
    spark = docs.sparkSession
    folder = folder or scratch_path(spark, "tokens")
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    shards = max(1, -(-rows.count() // docs_a_shard))
    ordered = rows.repartitionByRange(shards, F.col("_id").asc_nulls_first()).sortWithinPartitions(
        F.col("_id").asc_nulls_first(), F.xxhash64("_text")
    )
    manifest = settle(ordered.mapInArrow(_writer(folder, tokenizer, end_id), MANIFEST), "manifest")
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    return folder, manifest.withColumn("first", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


READ = "doc_id bigint, occurrence int, start bigint, n_tokens bigint, ids binary"
DIGEST = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"


def _reader(folder: str, digest: bool):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _opened(folder)
        for batch in batches:
            for shard in batch.to_pylist():
                with store.open_input_stream(f"{root}/{shard['name']}.idx") as f:
                    index = ShardIndex(f.read())
                kind = np.dtype(f"<u{index.width}")
                slots = index.find(index.keys)
                if (slots < 0).any():
                    raise ValueError(f"{shard['name']}: a key's fingerprint differs")
                with store.open_input_file(f"{root}/{shard['name']}.ids") as body:
                    for at in range(0, index.n, 512):
                        rows = []
                        for key, slot in zip(index.keys[at : at + 512], slots[at : at + 512], strict=True):
                            none, doc_id, nth = struct.unpack(KEY, key)
                            start, n = int(index.start[slot]), int(index.length[slot])
                            ids = np.frombuffer(body.read_at(n * index.width, start * index.width), dtype=kind).astype("<u4").tobytes()
                            rows.append((None if none else doc_id, nth, shard["first"] + start, n, zlib.crc32(ids) if digest else ids))
                        doc_id, nth, start, n, value = zip(*rows, strict=True)
                        columns = {"doc_id": pa.array(doc_id, pa.int64()), "occurrence": pa.array(nth, pa.int32()),
                                   "start": pa.array(start, pa.int64()), "n_tokens": pa.array(n, pa.int64())}
                        columns |= {"ids_crc32": pa.array(value, pa.int64())} if digest else {"ids": pa.array(value, pa.binary())}
                        if digest:
                            columns.pop("occurrence")
                        yield pa.RecordBatch.from_pydict(columns)

    return read


def read_token_files(folder: str, manifest: DataFrame, digest: bool = False) -> DataFrame:
    """Every document of the files, each one found through its shard's index.

    Rows carry the ids as unsigned 32-bit little-endian bytes or, for
    ``digest``, their crc32.  Only ids, a shard's index and one document are in
    memory at once.
    """
    shards = max(1, manifest.count())
    dealt = manifest.select("part", "name", "first").repartition(shards, "part")
    return dealt.mapInArrow(_reader(folder, digest), DIGEST if digest else READ)


def lookup(spark: SparkSession, folder: str, name: str, doc_ids: list[int], occurrence: int = 0) -> list[np.ndarray | None]:
    """Ids of a few documents of one shard; None for a key that the shard lacks."""
    store, root = _opened(folder)
    with store.open_input_stream(f"{root}/{name}.idx") as f:
        index = ShardIndex(f.read())
    found = index.find([struct.pack(KEY, d is None, d or 0, occurrence) for d in doc_ids])
    with store.open_input_file(f"{root}/{name}.ids") as body:
        return [
            None if s < 0 else np.frombuffer(
                body.read_at(int(index.length[s]) * index.width, int(index.start[s]) * index.width), dtype=f"<u{index.width}"
            )
            for s in found
        ]

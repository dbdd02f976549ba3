"""SentencePiece encoding and decoding as a weighted transducer.

Three machines are compiled from a model file.  The normaliser maps a text to
symbols: a mark for every blank and, if the model says so, one before the text.
The piece machine reads symbols and writes pieces; its states are the pieces
last written.  Byte fallback reads a symbol that no piece has and writes its
bytes.  A model of merges admits piece r after piece l if and only if merging
the string l r again yields exactly l and r, so that arc has weight 0 and every
other pair weight infinity.  Composed with an input, the best path under
(min, +) is then the model's own segmentation.

Whether the merge of "l r" crosses the border is read off the two borders as
they grow: the tokens at the right edge of l and at the left edge of r, each
with the rank of the merge that takes it in.  Two tokens that face each other
and would merge earlier than either is taken in cross the border.

Two things keep the composition small.  No path crosses a place whose two
symbols stand side by side in no piece, so inputs are cut there.  Words and
parts of words that were composed before are remembered, up to a bound each.

Null and empty texts encode to nothing and decode to the empty text.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidewater.llm.common import per_worker, pieces

# Fixed value: the mark that stands for a blank.
MARK = "▁"
CACHE_WORDS = 600_000
CACHE_PARTS = 300_000
CACHE_SYMBOLS = 40  # longest word or part that is remembered
CACHE_PAIRS = 1_000_000
INFINITE = float("inf")


def _fields(blob: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Fields of one protobuf message: number and value, nested ones as bytes."""

    def varint(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            value |= (blob[at] & 127) << shift
            shift, at = shift + 7, at + 1
            if blob[at - 1] < 128:
                return value, at

    at = 0
    while at < len(blob):
        key, at = varint(at)
        if key & 7 == 0:
            value, at = varint(at)
        else:
            n, at = varint(at) if key & 7 == 2 else ({1: 8, 5: 4}[key & 7], at)
            value, at = blob[at : at + n], at + n
        yield key >> 3, value


class Normaliser:
    """Text to symbols and back, as the model's normaliser_spec has it."""

    def __init__(self, spec: dict[int, int | bytes]) -> None:
        if spec.get(2):
            raise ValueError("a model with a character map is not supported")
        self.prefix = bool(spec.get(3, 1))
        self.squeeze = bool(spec.get(4, 1))

    def __call__(self, text: str) -> str:
        if self.squeeze:
            text = " ".join(x for x in text.split(" ") if x)
        if not text:
            return ""
        return (MARK if self.prefix else "") + text.replace(" ", MARK)

    def back(self, symbols: str) -> str:
        if self.prefix and symbols.startswith(MARK):
            symbols = symbols[1:]
        return symbols.replace(MARK, " ")


class PieceTransducer:
    def __init__(self, model_file: str) -> None:
        import sentencepiece

        with open(model_file, "rb") as f:
            message = f.read()
        parts = dict(kv for kv in _fields(message) if kv[0] in (2, 3))
        if dict(_fields(parts[2])).get(3, 1) != 2:
            raise ValueError("only models of merges are supported")
        self.normalise = Normaliser(dict(_fields(parts.get(3, b""))))
        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        self.size = model.get_piece_size()
        self.kind = np.dtype("<u2" if self.size <= 1 << 16 else "<u4")
        self.bytes_of: list[int] = [0] * 256
        self.rank: dict[str, float] = {}  # lower merges first
        self.id_of: dict[str, int] = {}
        self.written: list[bytes] = [b""] * self.size  # what an id writes when decoded
        for i in range(self.size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.bytes_of[int(piece[3:5], 16)] = i
                self.written[i] = bytes([int(piece[3:5], 16)])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                self.id_of[piece] = i
                self.rank[piece] = -model.get_score(i)
                self.written[i] = piece.encode()
        # the piece machine's arcs: symbol by symbol from a start, "" holds the piece read so far
        self.arcs: dict = {}
        for piece, i in self.id_of.items():
            node = self.arcs
            for symbol in piece:
                node = node.setdefault(symbol, {})
            node[""] = i
        self.spelled = {i: piece for piece, i in self.id_of.items()}
        self.symbols = {piece for piece in self.id_of if len(piece) == 1}
        self.side_by_side = {p[k : k + 2] for p in self.id_of for k in range(len(p) - 1)}
        self.cuts_at_marks = all(pair[0] == MARK for pair in self.side_by_side if pair[1] == MARK)
        self.last_merge: dict[str, tuple[str, str] | None] = {}
        self.stable = {p: self.merged(p) == [p] for p in self.id_of}
        # borders can be read off where every merge comes after those of its halves
        self.ranked: dict[str, bool] = {}
        for p in sorted(self.id_of, key=len):
            halves = [x for x in self.last_merge.get(p) or () if len(x) > 1]
            self.ranked[p] = self.stable[p] and all(self.ranked.get(x, False) and self.rank[x] < self.rank[p] for x in halves)
        self.edges: dict[tuple[str, bool], list[tuple[str, float]]] = {}
        self.pairs: dict[int, float] = {}  # by (left + 1) * size + right
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.known_parts: dict[str, bytes] = {}

    # ---- weights

    def merged(self, symbols: str) -> list[str]:
        """Segmentation by merges: the best-ranked neighbour pair first, leftmost of equals."""
        parts = list(symbols)
        while len(parts) > 1:
            best = min((self.rank.get(parts[k] + parts[k + 1], INFINITE), k) for k in range(len(parts) - 1))
            if best[0] == INFINITE:
                break
            if len(parts) == 2:
                self.last_merge[symbols] = (parts[0], parts[1])
            parts[best[1] : best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]
        return parts

    def weight(self, left: int, right: int) -> float:
        """Weight of the arc that writes piece ``right`` in state ``left``; -1 is the start."""
        if len(self.pairs) >= CACHE_PAIRS:
            self.pairs.clear()
        after = self.spelled[right]
        if left < 0:
            apart = self.stable[after]
        else:
            before = self.spelled[left]
            apart = self.stay_apart(before, after) if self.ranked[before] and self.ranked[after] else self.merged(before + after) == [before, after]
        self.pairs[(left + 1) * self.size + right] = found = 0.0 if apart else INFINITE
        return found

    def edge(self, piece: str, right: bool) -> list[tuple[str, float]]:
        """Tokens at one edge of a piece while it is merged, each with the rank of the merge that takes it in."""
        key = (piece, right)
        if key not in self.edges:
            halves = self.last_merge.get(piece) if len(piece) > 1 else None
            inner = self.edge(halves[right], right) if halves else []
            taken = [*inner[:-1], (inner[-1][0], self.rank[piece])] if inner else []
            self.edges[key] = [*taken, (piece, INFINITE)]
        return self.edges[key]

    def stay_apart(self, left: str, right: str) -> bool:
        """Whether merging two ranked pieces side by side gives just them: of equal ranks the leftmost goes first."""
        a, b = self.edge(left, True), self.edge(right, False)
        i = j = 0
        while True:
            (x, taken_x), (y, taken_y) = a[i], b[j]
            rank = self.rank.get(x + y, INFINITE)
            if rank < taken_x and rank <= taken_y and rank < INFINITE:
                return False
            if taken_x == taken_y == INFINITE:
                return True
            if taken_x <= taken_y:
                i += 1
            else:
                j += 1

    # ---- composition

    def shortest_path(self, part: str) -> list[int]:
        """Piece ids of a part that holds no place of cutting and only known symbols."""
        n = len(part)
        cost, last, back = [0.0] + [INFINITE] * n, [-1] * (n + 1), [0] * (n + 1)
        weights = self.pairs
        for start in range(n):
            here = cost[start]
            if here == INFINITE:
                continue
            node, state, end = self.arcs, (last[start] + 1) * self.size, start
            for symbol in part[start:]:
                node = node.get(symbol)
                if node is None:
                    break
                end += 1
                if here < cost[end] and "" in node:
                    piece = node[""]
                    weight = weights.get(state + piece)
                    if weight is None:
                        weight = self.weight(last[start], piece)
                    if here + weight < cost[end]:
                        cost[end], last[end], back[end] = here + weight, piece, start
        if cost[n] == INFINITE:
            raise ValueError(f"no path for {part!r}")
        path, end = [], n
        while end:
            path.append(last[end])
            end = back[end]
        return path[::-1]

    def parts(self, symbols: str) -> list[str]:
        inside = self.side_by_side
        cuts = [k for k, pair in enumerate(map(add, symbols, symbols[1:]), 1) if pair not in inside]
        if not cuts:
            return [symbols] if symbols else []
        return [symbols[i:k] for i, k in zip([0, *cuts], [*cuts, len(symbols)], strict=True)]

    def _ids(self, part: str) -> list[int]:
        if len(part) == 1 and part not in self.id_of:
            return [self.bytes_of[b] for b in part.encode()]
        if part in self.id_of and self.stable[part]:
            return [self.id_of[part]]
        if not self.symbols.issuperset(part):
            raise ValueError(f"symbols of {part!r} are no pieces of their own")
        return self.shortest_path(part)

    def part(self, symbols: str) -> bytes:
        """Raw ids of a run of symbols that holds no place of cutting."""
        found = self.known_parts.get(symbols)
        if found is None:
            found = np.array(self._ids(symbols), dtype=self.kind).tobytes()
            if len(symbols) <= CACHE_SYMBOLS:
                if len(self.known_parts) >= CACHE_PARTS:
                    self.known_parts.clear()
                self.known_parts[symbols] = found
        return found

    def word(self, word: str) -> bytes:
        """Raw ids of a word with the mark before it."""
        found = self.older.get(word)
        if found is None:
            found = b"".join(map(self.part, self.parts(MARK + word)))
        if len(word) <= CACHE_SYMBOLS:
            if len(self.words) >= CACHE_WORDS:  # the younger generation becomes the older
                self.older, self.words = self.words, {}
            self.words[word] = found
        return found

    def encode(self, text: str | None) -> np.ndarray:
        if text and self.cuts_at_marks and self.normalise.prefix and text[0] != " " and "  " not in text and MARK not in text and not (self.normalise.squeeze and text[-1] == " "):
            words = text.split(" ")
            found = list(map(self.words.get, words))
            if None in found:
                found = [self.word(w) if f is None else f for w, f in zip(words, found, strict=True)]
            return np.frombuffer(b"".join(found), dtype=self.kind)
        symbols = self.normalise(text) if text else ""
        return np.frombuffer(b"".join(map(self.part, self.parts(symbols))), dtype=self.kind)

    def decode(self, ids: np.ndarray) -> str:
        """Text of any id sequence; broken bytes become replacement characters."""
        return self.normalise.back(b"".join(map(self.written.__getitem__, ids.tolist())).decode("utf-8", "replace"))


def loaded(model_file: str) -> PieceTransducer:
    return per_worker(("pieces", model_file), lambda: PieceTransducer(model_file))


def _checks(model_file: str, place: int, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = loaded(model_file)
        for batch in batches:
            for part in pieces(batch):
                rows = []
                for text in part.column(place).to_pylist():
                    ids = machine.encode(text)
                    spelled = machine.decode(ids)
                    fallback = int(np.isin(ids, machine.bytes_of).sum())
                    rows.append((len(ids), fallback, zlib.crc32(ids.astype("<u4").tobytes()), zlib.crc32(spelled.encode())))
                columns = [pa.array([r[k] for r in rows], pa.int64()) for k in range(4)]
                yield pa.RecordBatch.from_arrays([*part.columns, *columns], names=names)

    return run


DIGEST = ("n_ids", "n_bytes", "ids_crc32", "text_crc32")


def encoded_digest(docs: DataFrame, model_file: str, text: str = "text") -> DataFrame:
    """The rows with counts of ids and of byte ids, the ids' crc32, and the crc32
    of the text that decoding the ids gives back."""
    kept = [c for c in docs.columns if c not in DIGEST]
    rows = docs.select(*kept)
    spec = docs.sparkSession.createDataFrame([], rows.schema).selectExpr("*", *[f"0L {c}" for c in DIGEST]).schema
    return rows.mapInArrow(_checks(model_file, kept.index(text), [*kept, *DIGEST]), spec)


def encoded(docs: DataFrame, model_file: str, text: str = "text") -> DataFrame:
    """The rows with ``ids`` and, in place of the text, what the ids decode to."""
    kept = [c for c in docs.columns if c != "ids"]
    rows = docs.select(*kept)
    place = kept.index(text)
    spec = docs.sparkSession.createDataFrame([], rows.schema).selectExpr("*", "array(0) ids").schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = loaded(model_file)
        for batch in batches:
            for part in pieces(batch):
                ids = [machine.encode(t) for t in part.column(place).to_pylist()]
                ends = np.concatenate([[0], np.cumsum([len(i) for i in ids])]).astype(np.int32)
                flat = np.concatenate(ids).astype(np.int32) if ids else np.zeros(0, np.int32)
                columns = list(part.columns)
                columns[place] = pa.array([machine.decode(i) for i in ids], pa.string())
                yield pa.RecordBatch.from_arrays([*columns, pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], names=[*kept, "ids"])

    return rows.mapInArrow(run, spec)

"""Repeated passages removed by sharded Aho-Corasick automata.

A window is ``width`` consecutive words.  Every word of a window whose words
also start anywhere else, in the same document or another, is removed.

Texts of equal words are one class: if there are two of them and they hold a
window, nothing of them stays.  The others are handled in three steps.

Confirm.  The smallest shingle hash inside a window is its anchor;
equal windows have equal anchors, and neighbouring windows mostly share one.
Anchors that occur once rule out their windows.  The windows of the other
anchors are counted by a 64-bit hash of all their words; those counted at least
twice recur.

Compile.  Of each recurring window one document is the witness.  Its runs of such
windows are cut by anchor into phrases, and the phrases of a shard of anchors
become one automaton over words.

Stream.  The stretches of all documents around the shard's anchors run through
the automaton, which finds halves of windows; a window equal in all words marks
them.  A shard of more
stretches than one task should hold is dealt over several tasks, each with the
phrases it needs.

Null texts have no words.  Rows that share an id are told apart by their words.
Rows without an id count like any other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import WordHashes, hash_words, lists, mix, pieces, raw, rolled
from tidewater.operators.relational import small
from tidewater.session import settle, spread

WIDTH = 35
ANCHOR = 8
PLACE_BITS = 24
SHARD_WINDOWS = 30_000
DIGITS, BASE = 2, 64  # symbols of a word
UNKNOWN = "\0" * DIGITS
NOTHING = hashlib.sha256(b"").hexdigest()


def sliding_min(s: np.ndarray, width: int) -> np.ndarray:
    """Least of every ``width`` neighbours, by doubling."""
    n, span = len(s) - width + 1, 1
    while 2 * span <= width:
        s = np.minimum(s[: len(s) - span], s[span:])
        span *= 2
    return np.minimum(s[:n], s[width - span : width - span + n])


def anchors(h: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor hash, first window, windows) of each stretch of windows with one anchor."""
    n = len(h) - width + 1
    if n < 1:
        none = np.zeros(0, dtype=np.int64)
        return none, none, none
    s = mix(rolled(h, ANCHOR))
    # the place rides in the low bits: of equal hashes the leftmost counts, and a
    # shingle that comes again later in the text starts a stretch of its own
    low = np.uint64((1 << PLACE_BITS) - 1)
    least = sliding_min((s & ~low) | (np.arange(len(s), dtype=np.uint64) & low), width - ANCHOR + 1)
    first = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
    at = first + (((least[first] & low).astype(np.int64) - first) & ((1 << PLACE_BITS) - 1))
    return s[at].view(np.int64), first, np.diff(np.append(first, n))


def window_hashes(h: np.ndarray, width: int) -> np.ndarray:
    """One hash of all words for each window, from hashes of overlapping shingles."""
    n = len(h) - width + 1
    if n < 1:
        return h[:0]
    s = rolled(h, ANCHOR)
    out = np.zeros(n, dtype=np.uint64)
    for k in [*range(0, width - ANCHOR, ANCHOR), width - ANCHOR]:
        out = mix(out ^ s[k : k + n], 1)
    return out


def _facts(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = WordHashes()
        for batch in batches:
            for part in pieces(batch):
                rows = []
                for text in raw(part.column(1)):
                    words = text.split() if text else []
                    joined = b" ".join(words)
                    same = xxhash.xxh3_128_digest(joined)
                    rows.append((len(words), *np.frombuffer(same, dtype="<i8").tolist(), hashlib.sha256(joined).hexdigest(), *anchors(hash_words(words, seen), width)))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        *[pa.array([r[k] for r in rows], pa.int64()) for k in range(3)],
                        pa.array([r[3] for r in rows], pa.string()),
                        lists([r[4] for r in rows], pa.int64()),
                        lists([r[5] for r in rows], pa.int32()),
                        lists([r[6] for r in rows], pa.int32()),
                    ],
                    names=["id", "n_words", "w1", "w2", "sha", "anchor", "first", "windows"],
                )

    return run


def _windows(width: int):
    """(w, id, times): the windows of each document's listed stretches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = WordHashes()
        for batch in batches:
            for part in pieces(batch, 128):
                ids, times = part.column(0).to_pylist(), part.column(2).to_pylist()
                for k, text in enumerate(raw(part.column(1))):
                    w = window_hashes(hash_words(text.split(), seen), width).view(np.int64)
                    pick = _covered(part.column(3)[k].values.to_numpy(), part.column(4)[k].values.to_numpy(), len(w))
                    w = w[pick]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(w), pa.array([ids[k]] * len(w), pa.int64()), pa.array(np.full(len(w), times[k], dtype=np.int64))],
                        names=["w", "id", "times"],
                    )

    return run


def _covered(first: np.ndarray, windows: np.ndarray, n: int) -> np.ndarray:
    edge = np.zeros(n + 1, dtype=np.int64)
    np.add.at(edge, first, 1)
    np.add.at(edge, first + windows, -1)
    return np.cumsum(edge)[:n] > 0


def _phrases(width: int):
    """(anchor, phrase): a witness document's recurring windows, cut by anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = WordHashes()
        for batch in batches:
            for part in pieces(batch, 128):
                found_m, found_t = [], []
                for text, wanted in zip(raw(part.column(0)), part.column(1), strict=True):
                    words = text.split()
                    h = hash_words(words, seen)
                    hit = np.isin(window_hashes(h, width).view(np.int64), wanted.values.to_numpy())
                    # runs of recurring windows, cut where the anchor changes
                    m, first, n = anchors(h, width)
                    of = np.repeat(np.arange(len(m)), n)
                    at = np.flatnonzero(hit)
                    cut = np.flatnonzero((np.diff(at) > 1) | (np.diff(of[at]) > 0)) + 1 if len(at) else at
                    begin, end = at[np.append([0], cut).astype(int)] if len(at) else at, at[np.append(cut - 1, -1).astype(int)] if len(at) else at
                    found_m += m[of[begin]].tolist()
                    found_t += [b" ".join(words[a : b + width]) for a, b in zip(begin.tolist(), end.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found_m, pa.int64()), pa.array(found_t, pa.binary()).cast(pa.string())], names=["anchor", "phrase"]
                )

    return run


def _stretches(width: int):
    """(id, w1, w2, anchor, start, words): text around the listed anchors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, 128):
                rows = []
                given = [part.column(c).to_pylist() for c in (0, 1, 2, 4, 5, 6)]
                for text, i, w1, w2, ms, firsts, ns in zip(raw(part.column(3)), *given, strict=True):
                    words = text.split()
                    rows += [(i, w1, w2, m, a, n, b" ".join(words[a : a + n + width - 1])) for m, a, n in zip(ms, firsts, ns, strict=True)]
                columns = list(zip(*rows, strict=True)) or [[]] * 7
                kinds = [pa.int64()] * 4 + [pa.int32()] * 2
                yield pa.RecordBatch.from_arrays(
                    [*[pa.array(c, t) for c, t in zip(columns[:6], kinds, strict=True)], pa.array(columns[6], pa.binary()).cast(pa.string())],
                    names=["id", "w1", "w2", "anchor", "start", "windows", "words"],
                )

    return run


class PhraseAutomaton:
    """Aho-Corasick over words.

    A word is two symbols, a number to base BASE with an alphabet for each digit:
    the automaton looks through a node's arcs one by one, so nodes must not have
    an arc for every word.  The keys are half as long as a window and lie
    end to end along a phrase, so every window of the phrase holds one whole.
    Where a key is found, the windows around it are looked up by all their words.
    """

    def __init__(self, phrases: list[bytes], width: int) -> None:
        self.width = width
        self.half = (width + 1) // 2
        self.symbols: dict[bytes, str] = {}
        self.windows: set[str] = set()
        self.machine = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
        long, step = width * DIGITS, self.half * DIGITS
        for phrase in phrases:
            body = "".join(map(self._symbol, phrase.split(b" ")))
            self.windows.update([body[k : k + long] for k in range(0, len(body) - long + 1, DIGITS)])
            for k in range(0, len(body) - step + 1, step):
                self.machine.add_word(body[k : k + step])
        self.machine.make_automaton()

    def _symbol(self, word: bytes) -> str:
        found = self.symbols.get(word)
        if found is None:
            high, low = divmod(len(self.symbols), BASE)
            high += 1 + BASE
            found = self.symbols[word] = chr(1 + low) + chr(high if high < 0xD800 else high + 0x800)
        return found

    def ranges(self, words: bytes) -> list[tuple[int, int]]:
        """Ranges of words that recurring windows cover, merged."""
        known, none = self.symbols.get, UNKNOWN
        body = "".join([known(w, none) for w in words.split(b" ")])
        out: list[list[int]] = []
        tried, long = 0, self.width * DIGITS  # windows before tried have been looked up
        last = len(body) // DIGITS - self.width
        for end, _ in self.machine.iter(body) if len(self.machine) else ():
            first = (end + 1) // DIGITS - self.half
            for lo in range(max(tried, first + self.half - self.width), min(first, last) + 1):
                if body[lo * DIGITS : lo * DIGITS + long] in self.windows:
                    if out and lo <= out[-1][1]:
                        out[-1][1] = lo + self.width
                    else:
                        out.append([lo, lo + self.width])
            tried = first + 1
        return out


def _stream(width: int):
    def run(phrases: pa.Table, stretches: pa.Table) -> pa.Table:
        machine = PhraseAutomaton(sorted(set(raw(phrases["phrase"]))), width)
        rows = []
        starts = stretches["start"].to_pylist()
        for k, words in enumerate(raw(stretches["words"])):
            rows += [(k, starts[k] + lo, starts[k] + hi) for lo, hi in machine.ranges(words)]
        at = pa.array([r[0] for r in rows], pa.int64())
        found = {c: stretches[c].take(at) for c in ("id", "w1", "w2")}
        found |= {c: pa.array([r[k] for r in rows], pa.int64()) for k, c in ((1, "lo"), (2, "hi"))}
        return pa.table(found)

    return run


def _removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in pieces(batch, 128):
            rows = []
            for k, text in enumerate(raw(part.column(3))):
                words = text.split()
                ranges = part.column(4)[k].as_py()
                lo, hi = np.array([r["lo"] for r in ranges]), np.array([r["hi"] for r in ranges])
                gone = _covered(lo, hi - lo, len(words))
                rest = b" ".join([w for w, g in zip(words, gone.tolist(), strict=True) if not g])
                rows.append((int(gone.sum()), rest))
            yield pa.RecordBatch.from_arrays(
                [*part.columns[:3], pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary()).cast(pa.string())],
                names=["id", "w1", "w2", "n_removed", "rest"],
            )


def strip_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, shard_windows: int = SHARD_WINDOWS
) -> DataFrame:
    """(id, n_words, n_removed, kept_sha256, rest), a row for each document.

    ``rest`` holds the words that stay, one blank between them, where some but
    not all were removed; it is null where nothing was.  ``width`` is at least
    twice the length of an anchor.
    """
    if width < 2 * ANCHOR:
        raise ValueError("windows too short for their anchors")
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    spec = "id bigint, n_words bigint, w1 bigint, w2 bigint, sha string, anchor array<bigint>, first array<int>, windows array<int>"
    facts = settle(spread(texts).mapInArrow(_facts(width), spec), "facts")
    long_ones = facts.filter(F.col("n_words") >= width)
    classes = long_ones.groupBy("w1", "w2").agg(F.count("*").alias("times"), F.min("id").alias("rep"))
    classes = settle(classes, "classes")

    # confirm: anchors first, then windows
    one_each = long_ones.join(classes, ["w1", "w2"]).filter(F.col("id").eqNullSafe(F.col("rep")))
    one_each = settle(one_each.select("id", "w1", "w2", "times", "anchor", "first", "windows").dropDuplicates(["w1", "w2"]), "reps")
    counted = one_each.select("times", F.explode("anchor").alias("anchor")).groupBy("anchor").agg(F.sum("times").alias("n"))
    again = settle(counted.filter("n > 1").select("anchor"), "anchors")
    stretch = F.explode(F.arrays_zip("anchor", "first", "windows")).alias("s")
    open_ones = one_each.select("id", "w1", "w2", "times", stretch).select("id", "w1", "w2", "times", "s.*").join(small(again), "anchor", "left_semi")
    listed = open_ones.groupBy("id", "w1", "w2", "times").agg(F.sort_array(F.collect_list(F.struct("first", "windows", "anchor"))).alias("s"))
    listed = settle(
        listed.select("id", "w1", "w2", "times", *[F.col(f"s.{c}").alias(c) for c in ("anchor", "first", "windows")]), "listed"
    )
    # texts once more, only of those documents; a class of equal words has one row
    ids = settle(listed.select("id").distinct(), "ids")
    named = listed.select("w1", "w2", F.col("id").alias("l_id"), "times", "anchor", "first", "windows")
    wanted = texts.join(small(ids.withColumnRenamed("id", "_id")), F.col("id").eqNullSafe(F.col("_id")), "left_semi")
    tagged = wanted.mapInArrow(_tagged, "id bigint, w1 bigint, w2 bigint, text string").join(named, ["w1", "w2"])
    tagged = tagged.filter(F.col("id").eqNullSafe(F.col("l_id"))).drop("l_id").dropDuplicates(["w1", "w2"])
    bodies = settle(tagged.select("id", "w1", "w2", "text", "times", "anchor", "first", "windows"), "bodies")
    told = F.col("id").eqNullSafe(F.col("l_id")) & (F.col("w1") == F.col("l_w1")) & (F.col("w2") == F.col("l_w2"))
    windows = bodies.select("id", "text", "times", "first", "windows").mapInArrow(_windows(width), "w bigint, id bigint, times bigint")
    recurring = windows.groupBy("w").agg(F.sum("times").alias("n"), F.min("id").alias("witness")).filter("n > 1")
    recurring = settle(recurring.groupBy("witness").agg(F.collect_list("w").alias("ws")), "recurring")

    # compile
    proofs = bodies.select("id", "text").join(recurring, F.col("id").eqNullSafe(F.col("witness")))
    phrases = settle(proofs.select("text", "ws").mapInArrow(_phrases(width), "anchor bigint, phrase string").distinct(), "phrases")

    # stream
    spec = "id bigint, w1 bigint, w2 bigint, anchor bigint, start int, windows int, words string"
    live = bodies.filter("times = 1").select("id", "w1", "w2", "text", "anchor", "first", "windows")
    total = listed.filter("times = 1").agg(F.sum(F.aggregate("windows", F.lit(0).cast("long"), lambda a, x: a + x))).first()[0] or 0
    shards = max(1, -(-total // shard_windows))
    shard = F.pmod(F.xxhash64("anchor"), F.lit(shards)).alias("shard")
    load = listed.filter("times = 1").select(F.explode(F.arrays_zip("anchor", "windows")).alias("s")).select("s.*")
    load = load.groupBy(shard).agg(F.ceil(F.sum("windows") / F.lit(shard_windows)).alias("parts"))
    load = settle(load, "load")
    stretches = live.mapInArrow(_stretches(width), spec).select("*", shard).join(small(load), "shard")
    stretches = stretches.withColumn("part", F.pmod(F.xxhash64("id", "w1", "start"), F.col("parts")))
    dealt = phrases.select("phrase", shard).join(small(load), "shard")
    dealt = dealt.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    left = dealt.select("shard", "part", "phrase").groupBy("shard", "part")
    right = stretches.select("shard", "part", "id", "w1", "w2", "start", "words").groupBy("shard", "part")
    marks = left.cogroup(right).applyInArrow(_stream(width), "id bigint, w1 bigint, w2 bigint, lo bigint, hi bigint")
    marks = marks.groupBy("id", "w1", "w2").agg(F.collect_list(F.struct("lo", "hi")).alias("ranges"))
    marks = settle(marks.select(*[F.col(c).alias(f"l_{c}") for c in ("id", "w1", "w2")], "ranges"), "marks")
    cut = bodies.filter("times = 1").select("id", "w1", "w2", "text").join(marks, told).select("id", "w1", "w2", "text", "ranges")
    cut = settle(cut.mapInArrow(_removed, "id bigint, w1 bigint, w2 bigint, n_removed bigint, rest string"), "cut")

    placed = facts.select("id", "n_words", "w1", "w2", "sha").join(classes.select("w1", "w2", "times"), ["w1", "w2"], "left")
    cut = cut.select(*[F.col(c).alias(f"l_{c}") for c in ("id", "w1", "w2")], "n_removed", "rest")
    copied = F.col("times") > 1
    return placed.join(cut, told, "left").select(
        F.col("id").alias(id_col),
        "n_words",
        F.when(copied, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(copied, F.lit(NOTHING)).when(F.col("rest").isNotNull(), F.sha2("rest", 256)).otherwise(F.col("sha")).alias("kept_sha256"),
        F.when(copied, F.lit("")).otherwise(F.col("rest")).alias("rest"),
    )


def _tagged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in pieces(batch):
            same = [np.frombuffer(xxhash.xxh3_128_digest(b" ".join(t.split()) if t else b""), dtype="<i8") for t in raw(part.column(1))]
            marks = [pa.array([int(s[k]) for s in same], pa.int64()) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([part.column(0), *marks, part.column(1)], names=["id", "w1", "w2", "text"])

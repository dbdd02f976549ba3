"""Cheapest repair of conversation structure, by a grammar-compressed dynamic program.

A conversation is well formed if its roles' initials read ``(s?(ua)+)?``.  Each
row is a symbol: its initial (s, u, a or another) and its fault.  Re-Pair turns
the symbol sequences of the whole corpus into rules of two symbols each, the
most frequent pairs first.  A symbol's transfer matrix holds, for every state
before and after (start, behind s, behind u, behind a), the least cost and the
least audit that reach it; a rule's matrix is the min-plus product of its two
halves, worked out once, bottom-up, and used by every conversation that holds
the rule.  Audits are ropes: a rule's audit points at those of its halves.

Edits: Keep (0), Rerole to user or assistant (1), Delete (2, the only one for
blank and duplicate rows), Insert an empty user or assistant row (5).  A
truncated row that is not deleted adds 5.  Among the cheapest edits the audit
that comes first in ASCII order is taken.  Audits of one stretch of rows between
two states never are prefixes of each other at the same cost, so the least of a
product is the product of the least.

Long conversations.  Rows are range-sorted by (conversation, turn) and cut into
pieces of at most CHUNK rows; matrices of pieces are multiplied in groups of
FAN, in rounds.  Faults are found by aggregates over (conversation, row digest).
Only what a result holds in one value goes through one task as a stream: the
audit and the rows behind one SHA-256.

A null conversation id is a conversation of its own.  Null roles and texts are
one blank each; rows come by turn, nulls first, and rows of one turn by the
digest of role and text, so repeated rows are neighbours.  Further columns are
dropped.  An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import uuid
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewater.llm.common import per_worker
from tidewater.operators.relational import small
from tidewater.session import settle

CHUNK_BITS = 12
FAN = 64
MAX_RULES = 1024  # later pairs stay as they are: a sequence keeps more symbols, no result changes
PAIRS_A_ROUND = 256
LEAST_GAIN = 0.01  # share of all symbols that a round of rules must save
SEQUENCES_KEPT = 20_000  # sequences whose matrix a worker remembers
ROW_BATCH = 2048

BLANKS = " \t\n\x0b\x0c\r"
INITIALS = "sua"
SOUND, CUT, GONE = "suao", "SUAO", "wxyz"  # symbols by initial: no fault, truncated, blank or duplicate
FIRST_RULE = 0xE000  # private use: symbols of rules
LEGAL = {"su", "ua", "au"}
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = 4
ROLES = {USER: "user", ASSISTANT: "assistant"}
KEEP, REROLE, DELETE, INSERT = 0, 1, 2, 5
TRUNCATED = 5

# A rope is a string or a pair of ropes; an entry is (cost, rope) or None.


def joined(a, b):
    if isinstance(a, str) and isinstance(b, str) and len(a) + len(b) <= 64:
        return a + b
    return (a, b) if a and b else a or b


def strands(rope) -> Iterator[str]:
    left = [rope]
    while left:
        top = left.pop()
        if isinstance(top, str):
            yield top
        else:
            left += (top[1], top[0])


def flat(rope) -> str:
    return "".join(strands(rope))


def before(a, b) -> bool:
    """Whether rope a comes before rope b, read only up to the first difference."""
    if a is b:
        return False
    of_a, of_b, x, y = strands(a), strands(b), "", ""
    while True:
        while not x and (got := next(of_a, None)) is not None:
            x = got
        while not y and (got := next(of_b, None)) is not None:
            y = got
        if not x or not y:
            return bool(y)
        n = min(len(x), len(y))
        if x[:n] != y[:n]:
            return x[:n] < y[:n]
        x, y = x[n:], y[n:]


def lesser(a, b):
    if a is None or b is None:
        return b if a is None else a
    return b if b[0] < a[0] or (b[0] == a[0] and before(b[1], a[1])) else a


def product(left: list, right: list) -> list:
    """Min-plus product of two transfer matrices, row after row."""
    out = [None] * STATES**2
    for p in range(STATES):
        for r in range(STATES):
            a = left[p * STATES + r]
            if a is None:
                continue
            for q in range(STATES):
                b = right[r * STATES + q]
                if b is not None:
                    at = p * STATES + q
                    if out[at] is None or a[0] + b[0] <= out[at][0]:
                        out[at] = lesser(out[at], (a[0] + b[0], joined(a[1], b[1])))
    return out


def follow(state: int, initial: str) -> int | None:
    """State behind a row with this initial, None where none may stand."""
    if initial == "s":
        return SYSTEM if state == START else None
    if initial == "u":
        return USER if state != USER else None
    return ASSISTANT if initial == "a" and state == USER else None


def next_role(state: int) -> int:
    """What an inserted or reroled row becomes: the pattern leaves one choice."""
    return ASSISTANT if state == USER else USER


def inserts() -> list:
    """No, one or two inserted rows; more would come back to a state at a cost."""
    out = [None] * STATES**2
    for state in range(STATES):
        one = next_role(state)
        out[state * STATES + state] = (0, "")
        out[state * STATES + one] = (INSERT, "I")
        if (two := next_role(one)) != state:
            out[state * STATES + two] = (2 * INSERT, "II")
    return out


def terminal(symbol: str) -> list:
    """Matrix of one row and the inserts before it."""
    out = [None] * STATES**2
    extra = TRUNCATED if symbol in CUT else 0
    for state in range(STATES):
        found = [(state, (DELETE, "D"))]
        if symbol not in GONE:
            found.append((next_role(state), (REROLE + extra, "R")))
            if (to := follow(state, symbol.lower())) is not None:
                found.append((to, (KEEP + extra, "K")))
        for to, entry in found:
            out[state * STATES + to] = lesser(out[state * STATES + to], entry)
    return product(inserts(), out)


class Grammar:
    """Matrices of all symbols of a rule list, evaluated bottom-up."""

    def __init__(self, rules: list[str]) -> None:
        self.rules = [(pair, chr(FIRST_RULE + k)) for k, pair in enumerate(rules)]
        self.known = {}
        for kinds in (SOUND, CUT, GONE):
            for initial, symbol in zip(SOUND, kinds, strict=True):
                self.known[symbol] = (initial, initial, 0, terminal(symbol))
        for pair, symbol in self.rules:
            self.known[symbol] = self.both(self.known[pair[0]], self.known[pair[1]])
        self.seen: dict[str, tuple] = {}

    @staticmethod
    def both(a: tuple, b: tuple) -> tuple:
        """(first initial, last initial, illegal neighbours, matrix) of two stretches in a row."""
        return a[0], b[1], a[2] + b[2] + (a[1] + b[0] not in LEGAL), product(a[3], b[3])

    def packed(self, line: str) -> str:
        for pair, symbol in self.rules:
            if len(line) == 1:
                break
            line = line.replace(pair, symbol)
        return line

    def value(self, line: str) -> tuple:
        if line not in self.seen:
            if len(self.seen) >= SEQUENCES_KEPT:
                self.seen.clear()
            found = None
            for symbol in self.packed(line):
                found = self.known[symbol] if found is None else self.both(found, self.known[symbol])
            if len(line) > 256:
                return found
            self.seen[line] = found
        return self.seen[line]


def pair_counts(line: str) -> Counter:
    """How often each pair of neighbours could be replaced in a sequence."""
    found = Counter(map("".join, zip(line, line[1:], strict=False)))
    for pair in found:
        if pair[0] == pair[1]:
            found[pair] = line.count(pair)
    return found


def chosen(counts: list[tuple[str, int]], room: int) -> list[str]:
    """The most frequent pairs none of which can overlap another one."""
    lefts, rights, out = set(), set(), []
    for pair, n in counts:
        if n < 2 or len(out) >= room:
            break
        if pair[0] not in rights and pair[1] not in lefts and pair[0] != pair[1] or (pair[0] == pair[1] and pair[0] not in lefts | rights):
            lefts.add(pair[0])
            rights.add(pair[1])
            out.append(pair)
    return out


def repair_rules(lines: DataFrame) -> list[str]:
    """Re-Pair over sequences (line, n): rules in order, each a pair of earlier symbols.

    A round counts the pairs of all sequences, takes those most frequent ones
    that cannot overlap and replaces them.  The driver sees at most
    PAIRS_A_ROUND pairs a round and MAX_RULES rules.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for batch in batches:
            for line, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for pair, k in pair_counts(line).items():
                    found[pair] += k * n
        yield pa.RecordBatch.from_pydict({"pair": pa.array(list(found), pa.string()), "n": pa.array(list(found.values()), pa.int64())})

    rules: list[str] = []
    while len(rules) < MAX_RULES:
        total = lines.agg(F.sum(F.char_length("line") * F.col("n"))).first()[0] or 0
        pairs = lines.select("line", "n").mapInArrow(count, "pair string, n bigint").groupBy("pair").agg(F.sum("n").alias("n"))
        top = [(r.pair, r.n) for r in pairs.orderBy(F.desc("n"), "pair").limit(PAIRS_A_ROUND).collect()]
        took = chosen(top, MAX_RULES - len(rules))
        if sum(n for pair, n in top if pair in took) < max(2, LEAST_GAIN * total):
            break
        line = F.col("line")
        for k, pair in enumerate(took, len(rules)):
            line = F.replace(line, F.lit(pair), F.lit(chr(FIRST_RULE + k)))
        rules += took
        lines = settle(lines.select(line.alias("line"), "n").filter(F.char_length("line") > 1), "sequences")
    return rules


def damaged(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """Conversations with five kinds of damage, dealt by a checksum of (conversation, turn)."""
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (conv, turn)])
    body = F.coalesce(text, F.lit(" "))
    dealt = rows.withColumn("_deal", F.crc32(name) % 20).filter("_deal != 0")
    deal = F.col("_deal")
    return dealt.select(
        conv,
        turn,
        F.when(deal == 4, "user").otherwise(F.coalesce(role, F.lit(" "))).alias(role),
        F.when(deal == 1, "").when(deal == 2, F.translate(body, ".!?", "")).otherwise(body).alias(text),
        F.explode(F.when(deal == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_nth"),
    ).drop("_nth")


def conversation_key(conv: str) -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col(conv).cast("string")), F.lit(""))


def ordered_turns(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """(key, turn, role, text, at, digest, blank, cut): ``at`` rises with (conversation, turn)."""
    who, body = F.coalesce(role, F.lit(" ")), F.coalesce(text, F.lit(" "))
    found = rows.select(conversation_key(conv).alias("key"), F.col(turn).alias("turn"), who.alias("role"), body.alias("text"))
    digest = F.unhex(F.sha2(F.concat_ws("\x00", F.char_length("role").cast("string"), "role", "text"), 256))
    order = ["key", "turn", "digest", "_tie"]
    found = found.withColumn("digest", digest).withColumn("_tie", F.monotonically_increasing_id())
    found = found.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    kept = F.rtrim("text", F.lit(BLANKS))
    found = found.withColumn("blank", kept == "").withColumn("cut", ~F.substring(kept, -1, 1).isin(".", "!", "?"))
    return settle(found.drop("_tie"), "turns")


def faults(turns: DataFrame) -> DataFrame:
    """(key, turn, at, initial, fault): fault is blank, duplicate, truncated or null, the first that holds."""
    firsts = turns.filter("not blank").groupBy("key", "digest").agg(F.min("at").alias("at")).select("at", F.lit(True).alias("first"))
    rows = turns.select("key", "turn", "at", F.substring("role", 1, 1).alias("initial"), "blank", "cut").join(firsts, "at", "left")
    fault = F.when(F.col("blank"), "blank").when(F.col("first").isNull(), "duplicate").when(F.col("cut"), "truncated")
    return settle(rows.select("key", "turn", "at", "initial", fault.alias("fault")), "faults")


def sequences(found: DataFrame) -> DataFrame:
    """(key, chunk, line): symbols of at most 2**CHUNK_BITS rows of one conversation."""
    symbol = F.lit(None)
    for initial, sound, cut, gone in zip((*INITIALS, None), SOUND, CUT, GONE, strict=True):
        one = F.when(F.col("fault").isin("blank", "duplicate"), gone).when(F.col("fault") == "truncated", cut).otherwise(sound)
        symbol = F.coalesce(symbol, F.when(F.col("initial") == initial, one) if initial else one)
    placed = found.select("key", F.shiftright("at", CHUNK_BITS).alias("chunk"), F.struct("at", symbol.alias("s")).alias("row"))
    rows = placed.groupBy("key", "chunk").agg(F.sort_array(F.collect_list("row")).alias("rows"))
    return settle(rows.select("key", "chunk", F.array_join("rows.s", "").alias("line")), "lines")


MATRIX = "first string, last string, illegal bigint, costs array<int>, audits array<string>"


def matrix_columns(values: list[tuple]) -> list[pa.Array]:
    return [
        pa.array([v[0] for v in values], pa.string()),
        pa.array([v[1] for v in values], pa.string()),
        pa.array([v[2] for v in values], pa.int64()),
        pa.array([[e and e[0] for e in v[3]] for v in values], pa.list_(pa.int32())),
        pa.array([[e and flat(e[1]) for e in v[3]] for v in values], pa.list_(pa.string())),
    ]


def matrices(lines: DataFrame, rules: list[str]) -> DataFrame:
    """The value of every sequence: its ends, illegal neighbours and transfer matrix."""
    once = uuid.uuid4().hex

    def value(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar = per_worker(("grammar", once), lambda: Grammar(rules))
        names = ["key", "chunk", "first", "last", "illegal", "costs", "audits"]
        for batch in batches:
            for at in range(0, batch.num_rows, ROW_BATCH):
                part = batch.slice(at, ROW_BATCH)
                made = matrix_columns([grammar.value(line) for line in part.column(2).to_pylist()])
                yield pa.RecordBatch.from_arrays([*part.columns[:2], *made], names=names)

    return settle(lines.mapInArrow(value, f"key string, chunk bigint, {MATRIX}"), "matrices")


def whole(parts: DataFrame) -> DataFrame:
    """One matrix for each conversation: neighbouring parts multiplied FAN at a time, in rounds."""

    def merge(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["chunk"])
        found = None
        for r in rows:
            entries = [None if c is None else (c, a) for c, a in zip(r["costs"], r["audits"], strict=True)]
            one = (r["first"], r["last"], r["illegal"], entries)
            found = one if found is None else Grammar.both(found, one)
        made = matrix_columns([found])
        return pa.Table.from_arrays(
            [pa.array([rows[0]["key"]], pa.string()), pa.array([rows[0]["block"]], pa.int64()), *made],
            names=["key", "chunk", "first", "last", "illegal", "costs", "audits"],
        )

    done = None
    while True:
        several = parts.groupBy("key").count().filter("count > 1").select("key")
        several = settle(several, "several")
        single = parts.join(small(several), "key", "left_anti")
        done = single if done is None else done.unionByName(single)
        if several.limit(1).count() == 0:
            return done
        nth = F.row_number().over(W.partitionBy("key").orderBy("chunk"))
        places = parts.join(small(several), "key", "left_semi").select("key", "chunk")
        places = places.withColumn("block", F.floor((nth - 1) / FAN).cast("bigint"))
        blocks = parts.join(small(settle(places, "places")), ["key", "chunk"])
        merged = blocks.groupBy("key", "block").applyInArrow(merge, f"key string, chunk bigint, {MATRIX}")
        parts = settle(merged, "merged")


def cheapest(values: DataFrame) -> DataFrame:
    """(key, illegal, cost, audit) from the whole matrices: ends at the start or behind an assistant."""

    def end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = inserts()
        for batch in batches:
            best = []
            for costs, audits in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                start = [None if c is None else (c, a) for c, a in zip(costs, audits, strict=True)]
                matrix = product(start + [None] * (STATES**2 - STATES), last)
                best.append(lesser(matrix[START], matrix[ASSISTANT]))
            made = [pa.array([b[0] for b in best], pa.int64()), pa.array([flat(b[1]) for b in best], pa.string())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *made], names=["key", "illegal", "cost", "audit"])

    rows = values.select("key", "illegal", F.slice("costs", 1, STATES).alias("costs"), F.slice("audits", 1, STATES).alias("audits"))
    return settle(rows.mapInArrow(end, "key string, illegal bigint, cost bigint, audit string"), "audits")


class Editor:
    """Applies one audit to rows that come one after another."""

    def __init__(self, audit: str) -> None:
        self.audit, self.at, self.state = audit, 0, START

    def inserted(self) -> Iterator[tuple[str, str]]:
        while self.audit[self.at : self.at + 1] == "I":
            self.at += 1
            self.state = next_role(self.state)
            yield ROLES[self.state], ""

    def row(self, role: str, text: str) -> Iterator[tuple[str, str]]:
        yield from self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self.state = follow(self.state, role[:1])
            yield role, text
        elif edit == "R":
            self.state = next_role(self.state)
            yield ROLES[self.state], text


def edited(turns: DataFrame, audits: DataFrame, digest: bool) -> DataFrame:
    """Repaired rows (key, nth, role, text), or with ``digest`` one (key, repaired_sha256) each.

    Rows stream through in order behind their audit; a task holds one batch and
    one audit however long the conversation is.
    """
    rows = turns.select("key", "at", "role", "text").unionByName(
        audits.select("key", F.lit(-1).cast("bigint").alias("at"), F.lit("").alias("role"), F.col("audit").alias("text"))
    )
    rows = rows.repartition("key").sortWithinPartitions("key", "at")

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, str | None, str]]:
        """(key, role, text) of every repaired row, and (key, None, "") at each end."""
        now, key = None, None
        for batch in batches:
            for new, at, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if at < 0:
                    if now:
                        yield from ((key, r, t) for r, t in now.inserted())
                        yield key, None, ""
                    now, key = Editor(text), new
                else:
                    yield from ((key, r, t) for r, t in now.row(role, text))
        if now:
            yield from ((key, r, t) for r, t in now.inserted())
            yield key, None, ""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, sha, first = [], hashlib.sha256(), True
        for key, role, text in stream(batches):
            if role is not None:
                sha.update(f"{'' if first else chr(10)}{role}:{text}".encode())
                first = False
                continue
            out.append((key, sha.hexdigest()))
            sha, first = hashlib.sha256(), True
            if len(out) == ROW_BATCH:
                yield made(out, ["key", "repaired_sha256"])
                out = []
        yield made(out, ["key", "repaired_sha256"])

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, nth = [], 0
        for key, role, text in stream(batches):
            if role is None:
                nth = 0
                continue
            out.append((key, nth, role, text))
            nth += 1
            if len(out) == ROW_BATCH:
                yield made(out, ["key", "nth", "role", "text"])
                out = []
        yield made(out, ["key", "nth", "role", "text"])

    def made(out: list[tuple], names: list[str]) -> pa.RecordBatch:
        columns = zip(*out, strict=True) if out else [[] for _ in names]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64() if n == "nth" else pa.string()) for c, n in zip(columns, names, strict=True)], names=names)

    if digest:
        return rows.mapInArrow(hashed, "key string, repaired_sha256 string")
    return rows.mapInArrow(listed, "key string, nth bigint, role string, text string")


def repair(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(turns, faults, audits) of conversations: what ``edited`` and ``repair_report`` start from."""
    turns = ordered_turns(rows, conv, turn, role, text)
    found = faults(turns)
    lines = sequences(found)
    rules = repair_rules(settle(lines.groupBy("line").agg(F.count("*").alias("n")), "distinct-lines"))
    return turns, found, cheapest(whole(matrices(lines, rules)))


def repaired_rows(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, nth, role, text): the rows of every conversation after its cheapest repair."""
    turns, _, audits = repair(rows, conv, turn, role, text)
    names = rows.select(conversation_key(conv).alias("key"), F.col(conv)).distinct()
    return edited(turns, audits, digest=False).join(names, "key").select(conv, "nth", F.col("role").alias(role), F.col("text").alias(text))


def repair_report(
    original: DataFrame, rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """One row for every conversation of ``original``, about its ``rows`` and their cheapest repair.

    ``gaps``: turns missing between the first and the last; ``blank``,
    ``duplicate``, ``truncated``: rows by first fault; ``illegal``: neighbours
    that the pattern never has; ``cost`` and ``audit`` of the repair and the
    SHA-256 of its ``role:text`` lines.
    """
    turns, found, audits = repair(rows, conv, turn, role, text)
    fault = F.col("fault")
    n = lambda kind: F.coalesce(F.sum((fault == kind).cast("bigint")), F.lit(0)).alias(kind)
    seen = found.groupBy("key", "turn").agg(*[n(k) for k in ("blank", "duplicate", "truncated")])
    span = F.max("turn") - F.min("turn") + 1 - F.count("turn")
    counts = seen.groupBy("key").agg(F.coalesce(span, F.lit(0)).alias("gaps"), *[F.sum(k).alias(k) for k in ("blank", "duplicate", "truncated")])
    names = original.select(conversation_key(conv).alias("key"), F.col(conv)).distinct()
    every = names.join(counts, "key", "left").join(audits, "key", "left").join(edited(turns, audits, digest=True), "key", "left")
    zero = F.lit(0).cast("bigint")
    return every.select(
        conv,
        *[F.coalesce(c, zero).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


# Damage, faults and repair in SQL: the checksum bit by bit, the program row after row over four states.
REPAIR_SQL = r"""
WITH RECURSIVE
dealt AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         xor(4294967295, list_reduce(
           list_concat([4294967295], flatten(list_transform(
             string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''),
             lambda c: [ord(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
           lambda c, b: xor(xor(c, b) >> 1, 3988292384 * (xor(c, b) & 1)))) % 20 AS deal
  FROM conversations),
hurt AS (
  SELECT conv_id, turn, CASE WHEN deal = 4 THEN 'user' ELSE role END AS role,
         CASE deal WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE WHEN deal = 3 THEN [0, 1] ELSE [0] END) AS nth
  FROM dealt WHERE deal <> 0),
placed AS (
  SELECT conv_id, turn, role, text, rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(length(role) || chr(0) || role || chr(0) || text), nth) AS i
  FROM hurt),
faulty AS (
  SELECT conv_id, turn, role, text, i, role[1] AS initial, lag(role[1]) OVER (PARTITION BY conv_id ORDER BY i) AS previous,
         CASE WHEN body = '' THEN 'blank'
              WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
              WHEN body[-1] NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault
  FROM placed),
counts AS (
  SELECT conv_id, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
         count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (i > 1 AND previous || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faulty GROUP BY conv_id),
moves(p, q, price, letters, added) AS (
  VALUES ('', '', 0, '', []::VARCHAR[]), ('', 'u', 5, 'I', ['user:']), ('', 'a', 10, 'II', ['user:', 'assistant:']),
         ('s', 's', 0, '', []), ('s', 'u', 5, 'I', ['user:']), ('s', 'a', 10, 'II', ['user:', 'assistant:']),
         ('u', 'u', 0, '', []), ('u', 'a', 5, 'I', ['assistant:']), ('a', 'a', 0, '', []), ('a', 'u', 5, 'I', ['user:'])),
opens(p, q, role) AS (
  VALUES ('', 's', NULL), ('', 'u', 'user'), ('s', 'u', 'user'), ('u', 'a', 'assistant'), ('a', 'u', 'user')),
edits AS (
  SELECT conv_id, i, '' AS p, '' AS q, 2 AS price, 'D' AS letter, []::VARCHAR[] AS kept, true AS stays FROM faulty
  UNION ALL
  SELECT conv_id, i, p, q, 5 * (fault = 'truncated')::INT, 'K', [faulty.role || ':' || text], false
  FROM faulty JOIN opens ON initial = q WHERE fault NOT IN ('blank', 'duplicate')
  UNION ALL
  SELECT conv_id, i, p, q, 1 + 5 * (fault = 'truncated')::INT, 'R', [opens.role || ':' || text], false
  FROM faulty JOIN opens ON opens.role IS NOT NULL WHERE fault NOT IN ('blank', 'duplicate')),
walk AS (
  SELECT DISTINCT conv_id, 0::BIGINT AS i, '' AS q, {'price': 0, 'audit': '', 'kept': []::VARCHAR[]} AS best FROM conversations
  UNION ALL
  SELECT conv_id, i, q, min(best) AS best
  FROM (
    SELECT walk.conv_id, edits.i, CASE WHEN stays THEN moves.q ELSE edits.q END AS q,
           {'price': best.price + moves.price + edits.price, 'audit': best.audit || letters || letter,
            'kept': list_concat(list_concat(best.kept, added), edits.kept)} AS best
    FROM walk JOIN moves ON moves.p = walk.q
    JOIN edits ON edits.conv_id IS NOT DISTINCT FROM walk.conv_id AND edits.i = walk.i + 1 AND (stays OR edits.p = moves.q))
  GROUP BY conv_id, i, q),
ends AS (
  SELECT conv_id, min({'price': best.price + price, 'audit': best.audit || letters, 'kept': list_concat(best.kept, added)}) AS best
  FROM (SELECT *, max(i) OVER (PARTITION BY conv_id) AS last_i FROM walk) w JOIN moves ON moves.p = w.q
  WHERE i = last_i AND moves.q IN ('', 'a') GROUP BY conv_id)
SELECT ends.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, best.price::BIGINT AS cost, best.audit AS audit,
       sha256(array_to_string(best.kept, chr(10))) AS repaired_sha256
FROM ends LEFT JOIN counts ON ends.conv_id IS NOT DISTINCT FROM counts.conv_id
"""

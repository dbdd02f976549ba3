"""Token counts, the filter audit and conversation repair against plain versions."""

import hashlib
import random
import zlib
from itertools import permutations

import duckdb
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidewater.llm import PLANS, TWINS, audit, dialogue, token_counts
from tidewater.llm.queries import BYTE_BPE, PIECE_BPE, WORD_BPE

# ---- token counts


def library_counts(texts, path=WORD_BPE):
    t = Tokenizer.from_file(path)
    return [len(e.ids) for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def test_counts_are_the_librarys(spark, data, corpus):
    want = {(i, len(t.encode()), n, n > 2048) for (i, t, *_), n in zip(corpus, library_counts([d[1] for d in corpus]))}
    assert set(map(tuple, PLANS["op11_token_counts"](spark, data).collect())) == want


def test_pieces_count_as_in_whole_texts():
    known = token_counts.PieceLengths(WORD_BPE, token_counts.NOTHING)
    library = token_counts.Library(WORD_BPE)
    draw = random.Random(2)
    parts = ["a", "Ab", "İ", "ß", "ς", "'s", "'S", "'", "n't", ".", ",", "!", "<|endoftext|>", "<|ENDOFTEXT|>", " ", "\n", "\x0b", "\x0c", "\x1c",
             "\x85", "\xa0", "　", "́", "é", "日本", "😀", "9", "½", "Ⅷ", "‍", "\x00", "…", ":"]
    texts = ["".join(draw.choice(parts) for _ in range(draw.randint(0, 12))) for _ in range(8000)]
    texts += ["x" * 5000, "word, " * 3000, ("ab" * 40 + " ") * 50]
    got = [sum(known.total(b.split()) for b in token_counts.blocks(t.encode())) for t in texts]
    assert got == library.count(texts)


@pytest.mark.parametrize("path", [WORD_BPE, BYTE_BPE, PIECE_BPE])
def test_counts_odd_rows(spark, odd, clashing, none, path):
    library = token_counts.Library(path)
    rows = [r.text or "" for r in odd.collect()]
    want = sorted((len(t.encode()), n, n > 30) for t, n in zip(rows, library.count(rows)))
    named = clashing.withColumn("n_tokens", F.lit("x"))
    for docs in (odd, named):
        got = token_counts.count_tokens(docs, path, limit=30)
        assert got.columns == [c for c in docs.columns if c != "n_tokens"] + ["n_bytes", "n_tokens", "over_limit"]
        assert sorted((r.n_bytes, r.n_tokens, r.over_limit) for r in got.collect()) == want
    assert token_counts.count_tokens(none, path).count() == 0


def test_full_caches_change_nothing(monkeypatch, corpus):
    monkeypatch.setattr(token_counts, "CACHE_PIECES", 50)
    monkeypatch.setattr(token_counts, "TABLE_PIECES", 50)
    monkeypatch.setattr(token_counts, "BLOCK", 300)
    known = token_counts.PieceLengths(WORD_BPE, (b"the of,", b"\x01\x00\x02\x00"))
    texts = [d[1] for d in corpus[:60]]
    assert [sum(known.total(b.split()) for b in token_counts.blocks(t.encode())) for t in texts] == library_counts(texts)


# ---- filter audit


def plain_audit(docs, labels):
    """(part, order, step) -> counts, by walking every document through every order."""
    texts = [(i, s or "", t or "") for i, t, s in docs]
    ids = {}
    for i, _, t in texts:
        if i is not None:
            ids[t] = min(i, ids.get(t, i))
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    bad = {i for i, _, x in labels if x == 1 and i is not None}
    rows = []
    for i, part, t in texts:
        words = t.encode().split()
        fails = {
            "A": len(words) < 50,
            "B": 100 * len(set(words)) < 65 * len(words),
            "C": 100 * sum("A" <= c <= "Z" for c in t) > 5 * len(t),
            "D": any(c in "#$%&*|" for c in t),
            "E": i is not None and ids[t] < i,
        }
        rows.append((part, fails, i in good, i in bad))
    out, first = {}, {}
    for part in {r[0] for r in rows}:
        for order in permutations("ABCDE"):
            gone = [False] * len(rows)
            for step, f in enumerate(order, 1):
                c = [0] * 6
                for k, (p, fails, g, x) in enumerate(rows):
                    if p != part:
                        continue
                    if fails[f] and not gone[k]:
                        gone[k] = True
                        c[1] += 1
                        c[4] += g
                        c[5] += x
                    elif fails[f]:
                        c[2] += 1
                    c[0] += not gone[k]
                    c[3] += fails[f] and sum(fails.values()) == 1
                out[part, "".join(order), step] = c
                first[part, f] = first.get((part, f), 0) + c[1]
    return {(p, o, s, *c, first[p, o[s - 1]]) for (p, o, s), c in out.items()}


def audit_docs():
    draw = random.Random(8)
    words = ["Alpha", "beta", "gamma", "#tag", "BIG", "x", "é日", "50%"] + [f"w{i}" for i in range(90)]
    docs = []
    for i in range(260):
        body = " ".join(draw.choice(words[: draw.choice([3, 20, 98])]) for _ in range(draw.choice([0, 5, 49, 50, 60, 90])))
        docs.append((i * 3, body, draw.choice(["a", "b", None, ""])))
    docs += [(900 + k, docs[k % 9][1], "a") for k in range(150)] + [(-5, docs[4][1], "b"), (2000, None, "a"), (2001, "", None), docs[7], docs[7]]
    docs += [(None, docs[3][1], "a"), (None, docs[3][1], None), (docs[9][0], docs[10][1], "b")]
    labels = [(i, draw.choice([0, 1, None]), draw.choice([0, 1, None])) for i in range(0, 1000, 2)] + [(900, 0, 1), (900, 1, 0), (None, 1, 1)]
    return docs, labels


def test_audit_is_the_plain_one(spark, monkeypatch):
    docs, labels = audit_docs()
    a = spark.createDataFrame(docs, "doc_id bigint, text string, source string").repartition(4)
    b = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    want = plain_audit(docs, labels)
    extra = a.select("*", *[F.lit(1).alias(c) for c in ("id", "th", "mask", "part", "n", "good", "body", "first", "slot", "heavy")])
    for heavy, broadcast in ((1000, audit.SKETCH_BYTES), (8, 0)):  # then a large sketch, and the larger groups heavy
        monkeypatch.setattr(audit, "HEAVY", heavy)
        monkeypatch.setattr(audit, "SKETCH_BYTES", broadcast)
        assert set(map(tuple, audit.filter_audit(extra, b).collect())) == want


def test_audit_without_rows(spark, none):
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert audit.filter_audit(none, labels).count() == 0
    one = spark.createDataFrame([(None, None, None)], "doc_id bigint, text string, source string")
    rows = audit.filter_audit(one, labels).collect()
    assert len(rows) == 600 and {r.part for r in rows} == {""} and all(r.removed == (r.filter_order[r.step - 1] == "A") for r in rows)


def test_hashes_of_different_texts(spark, monkeypatch):
    """Texts that share a hash are told apart by the text."""
    docs = spark.createDataFrame([(1, "a", "s"), (2, "b", "s"), (3, "a", "s"), (4, "c", "s"), (5, "b", "s")], "doc_id bigint, text string, source string")
    real = F.xxhash64
    monkeypatch.setattr(audit.F, "xxhash64", lambda *c: real(*c) if len(c) > 1 else F.length(c[0]).cast("bigint"))
    rows = docs.selectExpr("doc_id id", "source part", "cast(length(text) as bigint) th", "0 mask", "0 good", "0 bad")
    assert sorted(r.id for r in audit.later_copies(docs, rows, "doc_id", "text").collect()) == [3, 5]


@pytest.mark.parametrize("key", sorted(TWINS))
def test_sql(spark, data, key):
    con = duckdb.connect()
    for t in ("documents", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{data}/{t}.parquet'")
    found = con.execute(TWINS[key])
    names = [c[0] for c in found.description]
    got = PLANS[key](spark, data).select(*names).collect()
    assert sorted(map(tuple, got)) == sorted(found.fetchall())


# ---- conversations


def plain_damage(rows):
    convs = {}
    for c, t, r, x in rows:
        kept = convs.setdefault(c, [])
        deal = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        r, x = " " if r is None else r, " " if x is None else x
        if deal:
            x = "" if deal == 1 else "".join(k for k in x if k not in ".!?") if deal == 2 else x
            kept += [(t, "user" if deal == 4 else r, x)] * (1 + (deal == 3))
    return convs


def plain_repair(rows):
    """conv -> (gaps, blank, duplicate, truncated, illegal, cost, audit, sha, repaired): row after row over all edits."""
    blank = " \t\n\x0b\x0c\r"
    open_to = {"": "su", "s": "u", "u": "a", "a": "u"}
    out = {}
    for c, turns in plain_damage(rows).items():
        digest = lambda r, x: hashlib.sha256(f"{len(r)}\0{r}\0{x}".encode()).digest()
        turns.sort(key=lambda v: (v[0] is not None, v[0] or 0, digest(*v[1:])))
        seen, faults = set(), []
        for _, r, x in turns:
            body = x.strip(blank)
            faults.append("blank" if not body else "duplicate" if (r, x) in seen else "truncated" if body[-1] not in ".!?" else None)
            seen.add((r, x))

        def with_inserts(layer):
            now = dict(layer)
            for _ in range(2):
                for q, (cost, edits, kept) in list(now.items()):
                    role = "assistant" if q == "u" else "user"
                    new = (cost + 5, edits + "I", (*kept, (role, "")))
                    if role[0] not in now or new[:2] < now[role[0]][:2]:
                        now[role[0]] = new
            return now

        layer = {"": (0, "", ())}
        for (_, r, x), fault in zip(turns, faults):
            found = []
            for q, (cost, edits, kept) in with_inserts(layer).items():
                found.append((q, (cost + 2, edits + "D", kept)))
                if fault in ("blank", "duplicate"):
                    continue
                cost += 5 * (fault == "truncated")
                if r[:1] and r[:1] in open_to[q]:
                    found.append((r[:1], (cost, edits + "K", (*kept, (r, x)))))
                for role in ("user", "assistant"):
                    if role[0] in open_to[q]:
                        found.append((role[0], (cost + 1, edits + "R", (*kept, (role, x)))))
            layer = {}
            for q, v in found:
                layer[q] = min(layer.get(q, v), v, key=lambda v: v[:2])
        ends = with_inserts(layer)
        cost, edits, kept = min((ends[q] for q in ("", "a") if q in ends), key=lambda v: v[:2])
        at = [t for t, *_ in turns if t is not None]
        gaps = max(at) - min(at) + 1 - len(set(at)) if at else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:]))
        sha = hashlib.sha256("\n".join(f"{r}:{x}" for r, x in kept).encode()).hexdigest()
        out[c] = (gaps, *[faults.count(k) for k in ("blank", "duplicate", "truncated")], illegal, cost, edits, sha, kept)
    return out


def odd_turns():
    draw = random.Random(3)
    roles = ["user", "assistant", "system", "u", "tool", "", None, "user", "assistant", "user", "assistant"]
    texts = ["a.", "b!", "c?", "cut", "  ", "", None, "x. \n", "y.", "z.", "q.", "é.", "longer text here.", "…"]
    rows = []
    for c in [*range(250), None]:
        for t in range(draw.randint(1, 14)):
            rows += [(c, draw.choice([t, t, t, t + 3, None, -1]), draw.choice(roles), draw.choice(texts))] * draw.choice([1, 1, 1, 2])
    rows += [(7777, t, draw.choice(["user", "assistant", "system"]), f"text {draw.randint(0, 900)}" + draw.choice([".", ".", "", "!"])) for t in range(1500)]
    return rows


def test_repair_is_the_plain_one(spark, data):
    rows = [tuple(r) for r in spark.read.parquet(f"{data}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    want = {c: v[:-1] for c, v in plain_repair(rows).items()}
    assert {r[0]: tuple(r)[1:] for r in PLANS["op13_conversation_repair"](spark, data).collect()} == want


def test_repair_odd_rows(spark, monkeypatch):
    """Nulls, ties, repeated rows, other roles; a conversation over many chunks and rounds."""
    monkeypatch.setattr(dialogue, "CHUNK_BITS", 5)
    monkeypatch.setattr(dialogue, "FAN", 4)
    rows = odd_turns()
    want = plain_repair(rows)
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").repartition(5)
    extra = df.select("*", *[F.lit("x").alias(c) for c in ("key", "at", "digest", "blank", "chunk", "line", "fault", "audit")])
    hurt = dialogue.damaged(extra, "conv_id", "turn", "role", "text")
    assert {r[0]: tuple(r)[1:] for r in dialogue.repair_report(extra, hurt).collect()} == {c: v[:-1] for c, v in want.items()}
    got = {}
    for r in sorted(dialogue.repaired_rows(hurt).collect(), key=lambda r: r.nth):
        got.setdefault(r.conv_id, []).append((r.role, r.text))
    assert got == {c: list(v[-1]) for c, v in want.items() if v[-1]}


def test_repair_without_rows(spark):
    empty = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    assert dialogue.repair_report(empty, dialogue.damaged(empty, "conv_id", "turn", "role", "text")).count() == 0


def test_rules_change_no_matrix():
    draw = random.Random(5)
    lines = ["".join(draw.choice("suaoSUAOwxyz") for _ in range(draw.randint(1, 30))) for _ in range(200)]
    plain, ruled = dialogue.Grammar([]), dialogue.Grammar(["ua", chr(dialogue.FIRST_RULE) * 2, "UA", "wx", "s" + chr(dialogue.FIRST_RULE)])
    for line in lines + ["ua" * 300]:
        a, b = plain.value(line), ruled.value(line)
        assert a[:3] == b[:3]
        assert [e and (e[0], dialogue.flat(e[1])) for e in a[3]] == [e and (e[0], dialogue.flat(e[1])) for e in b[3]]
    assert dialogue.chosen([("ua", 9), ("au", 8), ("us", 5), ("xx", 4), ("xy", 3), ("zz", 1)], 9) == ["ua", "us", "xx"]

"""MinHash, embedding, substring and line dedup against brute force, and odd rows."""

import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest
from tidewater.llm import PLANS, forest, lines, passages, sketches


class Sets:
    def __init__(self, items):
        self.up = {i: i for i in items}

    def find(self, x):
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def shingles(text, n=5):
    w = text.encode().lower().split() if text else []
    return {tuple(w[k : k + n]) for k in range(max(1, len(w) - n + 1))} if w else set()


def near_by_hand(rows):
    sets = [shingles(t) for _, t in rows]
    groups = Sets(sorted({i for i, _ in rows if i is not None}))
    for a in range(len(rows)):
        for b in range(a):
            if rows[a][0] is None or rows[b][0] is None or not sets[a] or not sets[b]:
                continue
            common = len(sets[a] & sets[b])
            if 100 * common >= 75 * (len(sets[a]) + len(sets[b]) - common):
                groups.join(rows[a][0], rows[b][0])
    return sorted(
        ((i, len(s), groups.find(i), groups.find(i) == i) if i is not None else (None, len(s), None, True) for (i, _), s in zip(rows, sets)), key=repr
    )


def test_sketches_are_brute_force(spark, data, corpus):
    got = PLANS["op1_minhash_dedup"](spark, data).collect()
    assert sorted(map(tuple, got), key=repr) == near_by_hand([r[:2] for r in corpus])


def test_sketches_odd_rows(odd, clashing):
    want = near_by_hand([(r.doc_id, r.text) for r in odd.collect()])
    # an id with several texts is one document: brute force joins them the same way
    for docs in (odd, clashing):
        assert sorted(map(tuple, sketches.near_duplicates(docs).collect()), key=repr) == want


def test_sketches_pivots(spark):
    """A large group of near copies, in which most pairs are only linked through others."""
    base = [f"b{i}" for i in range(200)]
    rows = [(i, " ".join([*base[: i * 2], f"x{i}", *base[i * 2 + 1 :]])) for i in range(90)]
    rows += [(1000 + i, " ".join([f"c{i}_{k}" for k in range(150)] + base[:30])) for i in range(60)]
    got = sketches.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, got), key=repr) == near_by_hand(rows)


@pytest.mark.parametrize(("small", "large"), [(95, 126), (93, 124), (95, 120), (90, 120), (73, 97)])
def test_sketches_of_a_small_and_a_larger_set(spark, small, large):
    """Sets that fit a sketch beside partners that do not; nobody else shares their values."""
    rows = []
    for k in range(60):
        words = [f"p{k}_{x}" for x in range(large + 4)]
        rows += [(2 * k, " ".join(words[: small + 4])), (2 * k + 1, " ".join(words))]
    got = sketches.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = [(2 * k + x, (small, large)[x], 2 * k, x == 0) for k in range(60) for x in (0, 1)]
    assert sorted(map(tuple, got)) == want


def vectors_by_hand(rows, least=0.93):
    ok = [i is not None and v is not None and l is not None and all(x is not None and math.isfinite(x) for x in v) and any(v) for i, v, l in rows]
    groups, links = Sets([k for k in range(len(rows))]), Counter()
    for a in range(len(rows)):
        for b in range(a):
            if ok[a] and ok[b] and rows[a][2] == rows[b][2] and len(rows[a][1]) == len(rows[b][1]):
                x, y = np.array(rows[a][1], float), np.array(rows[b][1], float)
                if x @ y / math.sqrt((x @ x) * (y @ y)) >= least:
                    links[a] += 1
                    links[b] += 1
                    groups.join(a, b)
    least_id = {}
    for k, (i, _, _) in enumerate(rows):
        if i is not None:
            least_id[groups.find(k)] = min(i, least_id.get(groups.find(k), i))
    return sorted(
        ((i, links[k], least_id[groups.find(k)], least_id[groups.find(k)] == i) if i is not None else (None, 0, None, True) for k, (i, _, _) in enumerate(rows)),
        key=repr,
    )


def test_forest_is_brute_force(spark, data):
    rows = [tuple(r) for r in spark.read.parquet(f"{data}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    got = PLANS["op2_embedding_dedup"](spark, data).collect()
    assert sorted(map(tuple, got), key=repr) == vectors_by_hand(rows)


@pytest.mark.parametrize("leaf", [6, 512])
def test_forest_odd_rows(spark, leaf):
    draw = np.random.default_rng(3)
    centre = draw.standard_normal(8)
    rows = [(k, [float(x) for x in np.round(centre + 0.1 * draw.standard_normal(8), 3)], 1) for k in range(40)]
    rows += [(100 + k, rows[0][1], 1) for k in range(15)]  # equal vectors
    rows += [(200, None, 1), (201, [0.0] * 8, 1), (202, [math.nan] * 8, 1), (203, [None] * 8, 1), (204, [math.inf] * 8, 1), (205, rows[0][1], None)]
    rows += [(206, rows[0][1], 2), (207, [1.0, 2.0], 1), (208, [], 1), (None, rows[0][1], 1), (209, [2 * x for x in rows[0][1]], 1), (210, [1e200] * 8, 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = sorted(map(tuple, forest.near_vectors(df, leaf=leaf, trees=16).collect()), key=repr)
    want = vectors_by_hand(rows)
    if leaf == 512:
        assert got == want
    else:  # a cloud of many times a leaf's size: links may be missed, none is made up
        assert [(g[0], g[2] is None) for g in got] == [(w[0], w[2] is None) for w in want]
        assert all(g[1] <= w[1] and (w[2] is None or g[2] >= w[2]) for g, w in zip(got, want))
        assert sum(g[1] for g in got) > 0.5 * sum(w[1] for w in want)
    assert forest.near_vectors(df.limit(0)).count() == 0


@pytest.mark.parametrize("mutual", [0.975, 0.95])
def test_forest_finds_links_of_a_large_cloud(spark, mutual):
    """Distinct near copies, many leaves of them, beside others of their label."""
    draw = np.random.default_rng(11)
    centre = draw.standard_normal(64)
    noise = draw.standard_normal((5000, 64)) * np.linalg.norm(centre) / 8 * math.sqrt(1 / mutual - 1)
    v = np.concatenate([centre + noise, draw.standard_normal((5000, 64))])
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    near = u @ u.T >= 0.93
    np.fill_diagonal(near, False)
    want = near.sum(axis=1)
    df = spark.createDataFrame([(k, x.tolist(), 1) for k, x in enumerate(v)], "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: r for r in forest.near_vectors(df).collect()}
    n_links = np.array([got[k].n_links for k in range(len(v))])
    assert want.sum() > 20_000_000 and (n_links <= want).all()
    assert n_links.sum() >= 0.9 * want.sum()
    assert {got[int(k)].component_id for k in np.flatnonzero(want[:5000])} == {int(np.flatnonzero(want)[0])}


def cut_by_hand(rows, width=35):
    words = [(t.encode().split() if t else []) for _, t in rows]
    count = Counter(tuple(w[k : k + width]) for w in words for k in range(len(w) - width + 1))
    out = []
    for (i, _), w in zip(rows, words):
        gone = [False] * len(w)
        for k in range(len(w) - width + 1):
            if count[tuple(w[k : k + width])] > 1:
                gone[k : k + width] = [True] * width
        out.append((i, len(w), sum(gone), hashlib.sha256(b" ".join(x for x, g in zip(w, gone) if not g)).hexdigest()))
    return sorted(out, key=repr)


def test_passages_are_brute_force(spark, data, corpus):
    got = PLANS["op8_substring_dedup"](spark, data).collect()
    assert sorted(map(tuple, got), key=repr) == cut_by_hand([r[:2] for r in corpus])


def test_passages_odd_rows_and_small_shards(odd, clashing, none):
    want = cut_by_hand([(r.doc_id, r.text) for r in odd.collect()])
    for docs, shard in ((odd, 30_000), (clashing, 40)):
        assert sorted(map(tuple, passages.strip_repeats(docs, shard_windows=shard).drop("rest").collect()), key=repr) == want
    assert passages.strip_repeats(none).count() == 0


def lines_by_hand(rows, n=7, percent=75):
    """(id, text) of distinct rows -> text, lines, removed."""
    places = {}
    for i, t in rows:
        if i is not None and t is not None:
            for no, line in enumerate(t.split("\n")):
                if line.strip(" "):
                    places.setdefault(line, []).append((i, no))
    sets = {x: {x[k : k + n] for k in range(len(x) - n + 1)} if len(x) >= n else {x} for x in places}
    groups = Sets(sorted(places))
    names = sorted(places)
    for a in range(len(names)):
        for b in range(a):
            x, y = sets[names[a]], sets[names[b]]
            if 100 * min(len(x), len(y)) >= percent * max(len(x), len(y)):
                common = len(x & y)
                if 100 * common >= percent * (len(x) + len(y) - common):
                    groups.join(names[a], names[b])
    stay = {}
    for line, at in places.items():
        root = groups.find(line)
        stay[root] = min(at + ([stay[root]] if root in stay else []))
    out = []
    for i, t in rows:
        if t is None:
            out.append((i, None, 0, 0))
            continue
        own = t.split("\n")
        kept = own if i is None else [x for no, x in enumerate(own) if not x.strip(" ") or stay[groups.find(x)] == (i, no)]
        out.append((i, "\n".join(kept), len(own), len(own) - len(kept)))
    return sorted(out, key=repr)


def test_lines_are_brute_force(spark, data, corpus):
    rows = [r[:2] for r in corpus]
    docs = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text")
    got = {tuple(r) for r in lines.dedup_lines(docs).collect()}
    want = set(lines_by_hand(rows))
    # banding may miss a pair near the threshold; nothing else may differ
    assert len(want - got) <= 0.01 * len(want)
    digests = PLANS["op9_line_dedup"](spark, data).collect()
    assert {(r.doc_id, r.n_lines, r.n_removed) for r in digests} == {(i, a, b) for i, _, a, b in got}


def test_lines_odd_rows(spark, clashing, none):
    long = "many words in one line " * 4
    rows = [(1, f"{long}\nshort\n\n  "), (2, f"{long}x\nshort\r"), (3, None), (4, ""), (5, "abc"), (6, "abc\nabd"), (None, f"{long}\nabc"), (7, long), (8, "z" * 9000)]
    got = lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, got), key=repr) == lines_by_hand(rows)
    kept = lines.dedup_lines(clashing)
    assert kept.count() == clashing.count() and kept.columns == [c for c in clashing.columns if c != "n_lines"] + ["n_lines", "n_removed"]
    assert lines.dedup_lines(none).count() == 0


def line_pairs(make, n, seed=5):
    """(documents of one line each, the same as pairs) of ``n`` pairs from ``make(draw)``."""
    draw = np.random.default_rng(seed)
    pairs = [make(draw) for _ in range(n)]
    return [(2 * k + x, pair[x]) for k, pair in enumerate(pairs) for x in (0, 1)]


def letters(draw, n):
    return "".join(draw.choice(list("abcdefghijklmnopqrstuvwxyz"), n))


@pytest.mark.parametrize("size", [12, 30])
def test_lines_of_long_words(spark, size):
    """Nine long words, of which the fourth and the eighth have a letter changed: no run of four stays."""

    def make(draw):
        words = [letters(draw, size) for _ in range(9)]
        other = [w[: size // 2] + "#" + w[size // 2 + 1 :] if k in (3, 7) else w for k, w in enumerate(words)]
        return " ".join(words), " ".join(other)

    rows = line_pairs(make, 200)
    got = lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).agg({"n_removed": "sum"}).first()[0]
    assert got >= 0.97 * 200


@pytest.mark.parametrize(("common", "own"), [(21, 3), (30, 5), (49, 8), (84, 13), (90, 15), (110, 18)])
def test_lines_of_few_shingles(spark, common, own):
    """Lines with a part in common and an end each of their own, on either side of the limits."""

    def make(draw):
        base = letters(draw, common + lines.WIDTH - 1)
        return base + letters(draw, own), base + letters(draw, own)

    rows = line_pairs(make, 1500)
    sets = [{x[k : k + lines.WIDTH] for k in range(len(x) - lines.WIDTH + 1)} for _, x in rows]
    true = sum(100 * len(a & b) >= 75 * len(a | b) for a, b in zip(sets[::2], sets[1::2]))
    got = lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).agg({"n_removed": "sum"}).first()[0]
    assert 0.98 * true <= got <= true
    assert true > 1400


def test_lines_run_no_python(odd):
    plan = lines.dedup_lines(odd)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_sketches_empty(none):
    assert sketches.near_duplicates(none).count() == 0


@pytest.mark.parametrize(("width", "words"), [(16, 2), (17, 3), (35, 200), (36, 2)])
def test_phrase_automaton_is_brute_force(width, words):
    draw = np.random.default_rng(width)
    tongue = [f"w{k}".encode() for k in range(words)]
    phrases = [b" ".join(draw.choice(tongue, width + int(draw.integers(0, 40)))) for _ in range(12)]
    known = {tuple(w[k : k + width]) for w in (p.split() for p in phrases) for k in range(len(w) - width + 1)}
    machine = passages.PhraseAutomaton(phrases, width)
    for at in range(200):
        cut = phrases[at % 12].split()[at % 7 :]
        text = [*draw.choice(tongue, at % 5), *cut, *([b"new"] if at % 2 else []), *draw.choice(tongue, 3), *phrases[at % 5].split()]
        marked = {x for k in range(len(text) - width + 1) if tuple(text[k : k + width]) in known for x in range(k, k + width)}
        assert {x for lo, hi in machine.ranges(b" ".join(text)) for x in range(lo, hi)} == marked


def test_whole_line_sets_are_cut_after_the_pick(spark, monkeypatch):
    base = "the quick brown fox jumps over the lazy dog and runs away"
    texts = [base, base + "!", *(hashlib.sha256(bytes([k])).hexdigest() for k in range(20))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    caught, by_jaccard = [], lines.by_jaccard
    monkeypatch.setattr(lines, "by_jaccard", lambda *a: caught.append(a) or by_jaccard(*a))
    assert sum(r.n_removed for r in lines.dedup_lines(docs).collect()) == 1
    sketches, sets_of = caught[0][:2]
    some = sketches.select("id").limit(1)
    got = sets_of(some)
    # the cut reads lines that were picked and written: nothing is joined on top of it or below
    assert got.count() == 1 and "Join" not in got._jdf.queryExecution().optimizedPlan().toString()
    assert set(got.first()["items"]) and sketches.count() < len(texts)


def test_line_keys_by_place_and_by_minima(spark):
    """Shingles cut by place, values read off one pass and minima by line are the keys of the plain way."""
    from pyspark.sql import functions as F

    draw = random.Random(3)
    texts = ["a", "ab日本", "a" * 500, "ab" * 90 + "é", "日本語のテキスト" * 30, "x" * 7, "y" * 6, "abc" * 40]
    texts += ["".join(draw.choice("abcdef é") for _ in range(n)) for n in (*range(98, 146, 3), 400, 900)]
    rows = spark.createDataFrame(list(enumerate(texts)), "h long, line string")
    regex = F.transform(F.expr("regexp_extract_all(line, '(?s)(?=(.{7}))', 1)"), lambda x: F.xxhash64(x))
    plain = F.when(F.char_length("line") < 7, F.array(F.xxhash64("line"))).otherwise(regex)
    cut = rows.select("h", plain.alias("plain"), lines.shingle_hashes("line", 7).alias("cut")).collect()
    assert all(r.plain == r.cut for r in cut)
    got = {}
    for r in lines.signatures(rows, 7, 75).collect():
        got.setdefault(r.h, []).extend(r["keys"])
    own = {r.h: r["keys"] for r in rows.select("h", lines.band_keys(plain).alias("keys")).collect()}
    assert {h: sorted(k) for h, k in got.items()} == {h: sorted(k) for h, k in own.items()}
    # a ring value is the smallest hash from the start of its bin on, over the end if need be
    far = {r.h: sorted(set(r.plain)) for r in cut}
    want = {}
    for h, hashes in far.items():
        if len(hashes) >= lines.RING_FROM:
            starts = [[-(1 << 63) + ((band + 16 * row) << 58) for row in range(4)] for band in range(12)]
            want[h] = [[min((x for x in hashes if x >= s), default=hashes[0]) for s in band] for band in starts]
    values = spark.createDataFrame([(h, no, v) for h, bands in want.items() for no, v in enumerate(bands)], "h long, no int, v array<long>")
    rings = values.select("h", F.xxhash64("no", "v").alias("key")).collect()
    assert len(rings) >= 12 * 10 and all(r.key in own[r.h] for r in rings)


def test_written_lists_are_not_written_again(spark, monkeypatch):
    from tidewater.llm import linking

    written = []
    plain = linking.settle
    monkeypatch.setattr(linking, "settle", lambda df, label, *a: written.append(label) or plain(df, label, *a))
    docs = spark.createDataFrame([(i, f"the same long line that has a number at its very end {i % 3}\nother {i}") for i in range(9)], "doc_id long, text string")
    assert lines.dedup_lines(docs).agg({"n_removed": "sum"}).first()[0] == 8
    # the first round, and the only one here, had written all lists once more
    assert "lists" not in written and "met" in written

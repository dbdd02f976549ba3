"""Language, toxicity, tokens, neighbours, mixing and the pipeline."""

import random
import struct
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tidewater.llm import PLANS, language, mixing, token_files, toxicity, transducer, vantage
from tidewater.llm.queries import BYTE_BPE, PIECE_BPE


@pytest.fixture(scope="module")
def larger(data):
    return data.replace("sf0.001", "sf0.01")


# ---- token files


def library_ids(texts):
    t = Tokenizer.from_file(BYTE_BPE)
    return [e.ids for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def test_token_files_are_the_librarys(spark, data, corpus):
    docs = sorted(corpus)
    want, start = [], 0
    for (i, *_), ids in zip(docs, library_ids([d[1] for d in docs])):
        ids = [*ids, 0]
        want.append((i, start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        start += len(ids)
    assert sorted(map(tuple, PLANS["op4_token_files"](spark, data).collect())) == want


def test_new_words_are_spelt_in_rows(monkeypatch):
    handed, plain = [], token_files.Encoder.plain
    monkeypatch.setattr(token_files.Encoder, "plain", lambda self, texts: handed.extend(texts) or plain(self, texts))
    encode = token_files.Encoder(BYTE_BPE)
    r = random.Random(4)
    words = ["".join(r.choices("abcdeéßXY", k=r.randrange(1, 9))) + r.choice(["", "", ".", "***", "'", "?!,", "12", "#a"]) for _ in range(4000)]
    texts = [" ".join(words[i : i + 50]).replace(" a", "\nA") for i in range(0, 4000, 50)] + ["a <|endoftext|> b***", "x  y", "", "\n"]
    for _ in range(2):
        got = [np.frombuffer(b, encode.kind).tolist() for b in encode(texts)]
        assert got == library_ids(texts)
    # first words, marks and the odd texts one by one, all others a thousand at a time
    assert len(handed) < 2 * len(texts) + 30


def test_token_files_odd_rows(spark, odd, clashing, none):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    ids = library_ids([t for _, t in rows])
    want = sorted(((i, tuple([*x, 0])) for (i, _), x in zip(rows, ids)), key=repr)
    for docs in (odd, clashing):
        folder, manifest = token_files.write_token_files(docs, BYTE_BPE, docs_a_shard=9)
        back = token_files.read_token_files(folder, manifest).collect()
        assert sorted(((r.doc_id, tuple(np.frombuffer(r.ids, "<u4").tolist())) for r in back), key=repr) == want
        by_start = sorted(back, key=lambda r: r.start)
        assert [r.start for r in by_start] == [sum(r.n_tokens for r in by_start[:k]) for k in range(len(by_start))]
        keys = [(r.doc_id is not None, r.doc_id) for r in by_start]
        assert keys == sorted(keys, key=lambda k: (k[0], k[1] or 0))
    first = manifest.orderBy("part").first()
    some = [r for r in by_start if r.start < first.n_ids and r.occurrence == 0][:4]
    got = token_files.lookup(spark, folder, first.name, [r.doc_id for r in some] + [987_654_321])
    assert [g.astype("<u4").tobytes() for g in got[:-1]] == [r.ids for r in some] and got[-1] is None
    assert token_files.read_token_files(*token_files.write_token_files(none, BYTE_BPE)).count() == 0


def test_pieces_equal_whole_texts():
    encode = token_files.Encoder(BYTE_BPE)
    draw = random.Random(4)
    letters = "abcd XYZ  \n\t.,-!'0123é日😀\x00\x1c\xa0　"
    texts = ["".join(draw.choice(letters) for _ in range(draw.randint(0, 40))) for _ in range(2000)]
    texts += [f"{t[:9]}<|endoftext|>{t[9:]}" for t in texts[:200]] + ["<|endoftext|>", "a <|endoftext|> b", "<|ENDOFTEXT|> <|endoftext| >"]
    assert encode(texts) == encode.plain(texts)
    assert [np.frombuffer(i, encode.kind).tolist() for i in encode(["a <|endoftext|> b"])] == [[64, 220, 50256, 275]]


@pytest.mark.parametrize("n", [0, 1, 2, 3, 50, 3000])
def test_perfect_hash(n):
    keys = [struct.pack("<q", k * 7919) for k in range(n)]
    index = token_files.ShardIndex(token_files.ShardIndex.pack([struct.pack(token_files.KEY, False, k, 0) for k in range(n)], np.arange(n), np.ones(n), 2))
    slots = index.find(index.keys)
    assert sorted(slots.tolist()) == list(range(n)) and index.start[slots].tolist() == list(range(n))
    if n > 2:
        others = [struct.pack(token_files.KEY, False, k, 1) for k in range(2000)]
        assert (index.find(others) < 0).mean() > 0.99 and keys


# ---- sentence pieces


def test_pieces_are_the_librarys(odd, corpus):
    machine = transducer.PieceTransducer(PIECE_BPE)
    library = sentencepiece.SentencePieceProcessor(model_file=PIECE_BPE)
    draw = random.Random(1)
    letters = "abcdefghi XYZ  \n\t.,-!()0123456789éß日本😀\x00▁"
    texts = [d[1] for d in corpus] + [r.text for r in odd.collect() if r.text is not None]
    texts += ["".join(draw.choice(letters) for _ in range(draw.randint(0, 40))) for _ in range(1500)]
    for text in texts:
        ids = machine.encode(text)
        assert ids.tolist() == library.encode(text)
        assert machine.decode(ids) == text.replace("▁", " ")
    assert machine.encode(None).tolist() == []


def test_piece_queries(spark, data, odd, clashing, none, corpus):
    got = {r.doc_id: r for r in PLANS["op7_sentencepiece"](spark, data).collect()}
    assert all(got[i].text_crc32 == zlib.crc32(t.replace("▁", " ").encode()) for i, t, *_ in corpus)
    rows = transducer.encoded(clashing, PIECE_BPE)
    assert rows.columns == [c for c in clashing.columns if c != "ids"] + ["ids"]
    texts = sorted((r.text or "") for r in odd.collect())
    assert sorted(r.text for r in rows.collect()) == texts
    assert transducer.encoded(none, PIECE_BPE).count() == 0


# ---- language and toxicity


def test_language_held_out(spark, larger):
    lang = spark.read.parquet(f"{larger}/documents.parquet").select("doc_id", "lang")
    rows = PLANS["op5_language_id"](spark, larger).join(lang, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert sum(r.lang == r.lang_pred for r in held) / len(held) > 0.98
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_odd_rows(odd, clashing, none):
    model = language.fit_languages(odd)
    found = language.predict_languages(clashing, model).collect()
    for r in found:
        assert (r.lang_pred == "und") == (r.text is None or not any(c.isalpha() for c in r.text))
    assert {r.lang_pred for r in found if r.text and "haus" in r.text} == {"de"}
    assert language.fit_languages(none).languages == []
    assert {r.lang_pred for r in language.predict_languages(odd, language.fit_languages(none)).collect()} == {"und"}


def test_filter_has_no_false_negatives():
    draw = np.random.default_rng(1)
    codes = draw.integers(-(2**62), 2**62, 5000)
    model = language.build_filter(np.array(["a"] * 3000 + ["b"] * 2000, dtype=object), codes, 4)
    masks = model.masks(codes.view(np.uint64))
    assert (masks[:3000] & 1).all() and (masks[3000:] & 2).all()
    assert model.shares(codes[:3000].view(np.uint64))[1] < 0.02


def test_toxicity_held_out(spark, larger):
    marks = spark.read.parquet(f"{larger}/labels.parquet").select("doc_id", "toxic")
    rows = PLANS["op6_toxicity"](spark, larger).join(marks, "doc_id").filter("held_out").collect()
    called = [r for r in rows if r.predicted]
    assert sum(r.toxic for r in called) / len(called) > 0.85
    assert sum(r.toxic for r in called) / sum(r.toxic for r in rows) > 0.6
    assert all(r.predicted == (r.score >= 0.7) and 0 <= r.score <= 1 for r in rows)


def test_folding_and_exceptions(spark, odd, none):
    assert toxicity.folded("Id1ot!! 1diot $cum tr4sh### ІDІОТ ｌ０ser, room 101") == " idiot idiot scum trash idiot loser room "
    assert toxicity.folded(None) == " " and toxicity.folded("") == " "
    lexicon = toxicity.Lexicon({" kill": 2.0}, [" kill time "])
    machine = lexicon.automaton()
    assert lexicon.hits(" kill time killer ", machine) == {10: 2.0}
    rows = [(k, "you id10t here" if k % 2 else f"a calm word {k}", k % 2) for k in range(60)]
    fit = toxicity.fit_lexicon(spark.createDataFrame(rows, "doc_id long, text string, bad int"))
    got = toxicity.score_toxicity(spark.createDataFrame(rows, "doc_id long, text string, score int"), fit).collect()
    assert all(r.predicted == r.doc_id % 2 for r in got)
    empty = toxicity.fit_lexicon(none.select("doc_id", "text", F.lit(1).alias("bad")))
    assert {r.score for r in toxicity.score_toxicity(odd, empty).collect()} == {0.0}


# ---- neighbours


def ranked_by_hand(rows, is_query, k):
    ok = {i: np.array(v, float) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    return {q: sorted(((-float((v * ok[q]).sum()), i) for i, v in ok.items() if i != q))[:k] for q in ok if is_query(q)}


def test_neighbours(spark, data):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{data}/embeddings.parquet").collect()]
    want = ranked_by_hand(rows, lambda q: q % 20 == 0, 20)
    vectors = spark.read.parquet(f"{data}/embeddings.parquet")
    exact = vantage.nearest(vectors, F.col("id") % 20 == 0, factor=1.0, shard_rows=150, block_rows=7).collect()
    assert sorted((r.query_id, r["rank"], r.id) for r in exact) == sorted((q, n + 1, i) for q, best in want.items() for n, (_, i) in enumerate(best))
    found = PLANS["op3_nearest"](spark, data).collect()
    hits = {(q, i) for q, best in want.items() for _, i in best}
    assert sum((r.query_id, r.vec_id) in hits for r in found) / len(hits) > 0.95


def test_neighbours_odd_rows(spark):
    base = [0.5, -1.0, 2.0]
    rows = [(k, base) for k in range(40)] + [(100 + k, [float(k), 1.0, -0.5 * k]) for k in range(30)]
    rows += [(200, None), (201, [0.0] * 3), (202, [float("nan")] * 3), (203, [None, 1.0, 1.0]), (204, [float("inf")] * 3), (205, [1.0]), (None, base)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    want = ranked_by_hand([r for r in rows if r[0] != 205], lambda q: q % 20 == 0, 20)
    got = vantage.nearest(df, F.col("id") % 20 == 0, factor=1.0).collect()
    assert sorted((r.query_id, r["rank"], r.id) for r in got) == sorted((q, n + 1, i) for q, best in want.items() for n, (_, i) in enumerate(best))
    assert vantage.nearest(df.limit(0), F.col("id") % 20 == 0).count() == 0
    assert vantage.nearest(df.filter("vec_id = 0"), F.col("id") % 20 == 0).count() == 0


# ---- mixing


def targets_by_hand(sizes, weights=(3, 1, 2), share=1.5, most=2):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % 3] for k, s in enumerate(names)}
    target, left = {}, set(names)
    while left:
        rest = share * sum(sizes.values()) - sum(target.values())
        level = rest / sum(weight[s] for s in left)
        above = {s for s in left if level * weight[s] >= most * sizes[s]}
        if not above:
            return target | {s: level * weight[s] for s in left}
        target |= {s: most * sizes[s] for s in above}
        left -= above
    return target


def check_mix(rows, docs):
    sizes = {}
    for _, source, n in docs:
        sizes[source] = sizes.get(source, 0) + n
    want = targets_by_hand(sizes)
    largest = max(n for *_, n in docs)
    for s in sizes:
        own = [r for r in rows if r.source == s]
        assert all(r.source_size == sizes[s] and r.target == pytest.approx(want[s]) for r in own)
        assert abs(sum(r.taken for r in own) - want[s]) <= largest
        rate = want[s] / sizes[s] if sizes[s] else 0
        assert all(r.copies in (int(rate), int(rate) + 1, round(rate)) and r.taken <= 2 * r.size for r in own)


def test_mix(spark, larger):
    rows = PLANS["op10_mix_sources"](spark, larger).collect()
    docs = [(r.doc_id, r.source, len(r.text.encode().split())) for r in spark.read.parquet(f"{larger}/documents.parquet").collect()]
    assert sorted((r.doc_id, r.size) for r in rows) == sorted((i, n) for i, _, n in docs)
    check_mix(rows, docs)
    again = PLANS["op10_mix_sources"](spark, larger).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


def test_mix_odd_rows_and_tree(spark, odd, clashing, none):
    docs = [(r.doc_id, r.source, len((r.text or "").encode().split())) for r in odd.collect()]
    sizes = mixing.with_words(clashing.drop("size")).select("doc_id", "source", "size")
    for chunk in (4096, 2):
        mix = mixing.mixed(sizes, chunk=chunk).withColumn("taken", F.col("copies") * F.col("size")).collect()
        each = [r for r in mix for _ in range(r.n_rows)]
        assert sorted(((r.doc_id, r.source, r.size) for r in each), key=repr) == sorted(docs, key=repr)
    out = mixing.mix_documents(clashing)
    assert out.columns == clashing.columns
    assert mixing.mixed(mixing.with_words(none).select("doc_id", "source", "size")).count() == 0
    assert mixing.mix_documents(none).count() == 0


def test_pivot_keeps_mass():
    draw = np.random.default_rng(2)
    size, part = draw.integers(1, 100, 500).astype(float), np.full(500, 0.37)
    total = np.zeros(500)
    for _ in range(300):
        out, left = mixing.pivot_chunk(size, part, draw.random(500))
        assert (size * out).sum() == pytest.approx((size * part).sum())
        assert all(x in (0, 1) for k, x in enumerate(out) if k != left)
        total += out
    assert abs(total.mean() / 300 - 0.37) < 0.01 and 0.2 < total.min() / 300 and total.max() / 300 < 0.55


# ---- pipeline


def test_pipeline(spark, larger):
    docs = spark.read.parquet(f"{larger}/documents.parquet")
    columns, machine = docs.columns, transducer.PieceTransducer(PIECE_BPE)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs.count(), stage(spark, docs, larger).cache()
        assert docs.columns == columns, name
        if name == "language ID":
            assert docs.count() >= 0.99 * before
        if name == "MinHash near-dedup":
            assert docs.count() == docs.select("doc_id").distinct().count()
        if name == "mixing sources":
            assert docs.groupBy("doc_id").count().agg(F.max("count")).first()[0] <= 2
    out = corpus_pipeline.STAGES[-1][1](spark, docs, larger).collect()
    assert len(out) == docs.count() and all(machine.encode(r.text).tolist() == r.ids for r in out[:200])


def test_pipeline_odd_rows(spark, odd, none):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECE_BPE)
    docs = odd
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "").cache()
    out = docs.collect()
    assert out and all(any(c.isalpha() for c in r.text) and r.ids == library.encode(r.text) for r in out)
    # one of the exact and near copies of the base text stays, the one with the smallest id
    assert {r.doc_id for r in out} & {0, 1, 2, -5} == {-5}
    asked = {(r.doc_id, r.source) for r in odd.collect()}
    assert {(r.doc_id, r.source) for r in out} <= asked and pa
    docs = none
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "").cache()
    assert docs.count() == 0

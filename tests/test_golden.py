"""Values worked out by hand or by an independent script."""

import math

import pytest
from pyspark.sql import functions as F

from tidewater.functions import scalars as S
from tidewater.functions import words as X
from tidewater.operators import bayes as B
from tidewater.operators import metrics as M
from tidewater.operators import ordered as O
from tidewater.operators import similarity as Y
from tidewater.sources import markup

GRADIENT = {
    # value: (legacy, blended)
    0.0: ("ff0000ff", "ff0000ff"),
    1.5: ("ff0000ff", "ff0000ff"),
    3.0: ("ff007f7f", "ff007f7f"),
    4.5: ("ffffff00", "ff00ff00"),
    6.35: ("ffff7f00", "ff7f7f00"),
    8.2: ("ffff0000", "ffff0000"),
    9.0: ("ffff0000", "ffff0000"),
}


def test_gradient(spark):
    stops = [(1.5, S.BLUE_ARGB), (4.5, S.GREEN_ARGB), (8.2, S.RED_ARGB)]
    df = spark.createDataFrame([(x,) for x in GRADIENT], "x double")
    rows = df.select(
        "x",
        S.argb_hex(S.colour_gradient(F.col("x"), stops, legacy_red=True)).alias("old"),
        S.argb_hex(S.colour_gradient(F.col("x"), stops)).alias("new"),
    ).collect()
    assert {r["x"]: (r["old"], r["new"]) for r in rows} == GRADIENT


def test_ticks(spark):
    df = spark.createDataFrame([(0.0, 10.0), (1.5, 8.2), (3.0, 3.0)], "lo double, hi double")
    rows = df.select(S.tick_spacing(F.col("lo"), F.col("hi")).alias("s"), S.nice_ticks(F.col("lo"), F.col("hi")).alias("t")).collect()
    assert rows[0]["s"] == 2 and rows[0]["t"] == [0, 2, 4, 6, 8, 10]
    assert rows[1]["s"] == 1 and rows[1]["t"] == [2, 3, 4, 5, 6, 7, 8]
    assert rows[2]["s"] is None


def test_bin_edges(spark):
    df = spark.createDataFrame([("g", 1.0), ("g", 2.0), ("g", 4.0)], "g string, c double")
    got = [(r["lo"], r["hi"]) for r in O.bin_edges(df, "g", "c").orderBy("c").collect()]
    assert got == [(0.5, 1.5), (1.5, 3.0), (3.0, 5.0)]


def test_running_score(spark):
    df = spark.createDataFrame([("k", i, t) for i, t in enumerate(["pos", "pos", "neg", "pos"])], "k string, i int, t string")
    got = O.running_score(df, ["k"], ["i"], F.col("t") == "pos").orderBy("i").collect()
    assert [round(r["score"], 6) for r in got] == [1, 2, 1.2, 2.2]


def test_links(spark):
    df = spark.createDataFrame([("link to [[F]] and link to [[A|shown]]",), ("none",)], "t string")
    assert [r[0] for r in df.select(S.links_in(F.col("t"))).collect()] == [["F", "A"], []]


def test_compound(spark):
    from tidewater.operators.relational import explode_compound

    df = spark.createDataFrame([(1, "A-B-A, TN"), (2, "Solo")], "code int, place string")
    got = {(r["code"], r["name"], r["state"]) for r in explode_compound(df, "place").collect()}
    assert got == {(1, "A", "TN"), (1, "B", "TN"), (2, "Solo", None)}


def test_log_line(spark):
    line = '0040 - - [01/May/1998:21:30:17 +0000] "GET /a:b HTTP/1.0" 200 9'
    df = spark.createDataFrame([(line,)], "l string")
    got = df.select(S.normalise_log_line(F.col("l"))).first()[0]
    assert got == '0040,01/May/1998,21:30:17,"GET,/a:b,HTTP/1.0",200,9'


RATINGS = {
    "I give it 8/10, really": "pos",
    "Four out of five": "pos",
    "rated 5/10 here": None,
    "out of ****: *": "neg",
    "OUT OF ****: **": None,
    "OUT OF ****: ***": "pos",
    "Grade: B-": None,
    "grade: A": "pos",
    "grade: C-": "neg",
    "2.5 out of 5": None,
    "first 1/10 then 9/10": "neg",
    "nothing": None,
}


def test_ratings(spark):
    df = spark.createDataFrame([(t,) for t in RATINGS], "text string")
    assert {r["text"]: r["polarity"] for r in S.with_rating(df, "text").collect()} == RATINGS


def small_set(spark):
    # 5, 4 and 2 values with the stated means and variances
    rows = [("X", 1.0), ("X", 2.0), ("X", 4.0), ("X", 4.0), ("X", 8.0)]
    rows += [("Y", 10.0), ("Y", 10.0), ("Y", 40.0), ("Y", 90.0), ("Z", 100.0), ("Z", 500.0)]
    return spark.createDataFrame([(i, k, [v]) for i, (k, v) in enumerate(rows)], "id int, label string, f array<double>")


def test_gaussian_parameters(spark):
    got = {r["label"]: (r["n"], r["mean"], r["var_pop"]) for r in B.class_moments(small_set(spark), "label", "f").collect()}
    assert got["X"][:2] == (5, pytest.approx(3.8)) and got["X"][2] == pytest.approx(5.76)
    assert got["Z"] == (2, 300.0, pytest.approx(40000.0))


def test_gaussian_scores(spark):
    params = spark.createDataFrame(
        [("X", 0, 5, 3.8, 6.16), ("Y", 0, 4, 37.5, 968.75), ("Z", 0, 2, 300.0, 40000.0)],
        "label string, feature int, n bigint, mean double, var_pop double",
    )
    model = B.GaussianScorer(B.with_prior(params))
    df = spark.createDataFrame([([6.0],), ([80.0],), ([300.0],)], "f array<double>")
    rows = df.select(
        F.col("f")[0].alias("v"),
        model.score_column(F.col("f")).alias("full"),
        model.score_column(F.col("f"), skip_zero=True).alias("skip"),
    ).collect()
    by = {r["v"]: r for r in rows}
    assert [round(x, 4) for x in by[6.0]["skip"]] == [-3.0093, -5.8807, -9.0025]
    assert [round(x, 4) for x in by[80.0]["skip"]] == [-473.9184, -6.3008, -8.527]
    assert [round(x, 4) for x in by[300.0]["skip"]] == [-0.7885, -40.9331, -7.922]
    assert max(range(3), key=lambda i: by[300.0]["skip"][i]) == 0
    assert max(range(3), key=lambda i: by[300.0]["full"][i]) == 2


def test_categorical_unseen(spark):
    rows = [("X", [str(v)]) for v in (1, 2, 3, 4, 5)] + [("Y", [str(v)]) for v in (10, 20, 30, 40)] + [("Z", ["100"]), ("Z", ["500"])]
    train = spark.createDataFrame(rows, "label string, cats array<string>")
    model = B.CategoricalModel(train, "label", "cats")
    test = spark.createDataFrame([(6, ["6"]), (10, ["10"])], "id int, cats array<string>")
    got = {r["id"]: [round(x, 4) for x in r["scores"]] for r in model.score(test, "id", "cats").collect()}
    assert got == {6: [-3.561, -3.7197, -4.2697], 10: [-3.561, -3.0265, -4.2697]}


def test_merge_moments(spark):
    from tidewater.operators.relational import merge_moments

    parts = spark.createDataFrame([("a", 2, 1.5, 0.25), ("a", 3, 4.0, 2 / 3)], "k string, n bigint, mean double, var_pop double")
    r = merge_moments(parts, ["k"]).first()
    values = [1, 2, 3, 4, 5]
    assert (r["n"], r["mean"]) == (5, 3.0) and r["var_pop"] == pytest.approx(sum((v - 3) ** 2 for v in values) / 5)


def test_edit_distance(spark):
    df = spark.createDataFrame([("Hello, World!", "Hallo, World!")], "a string, b string")
    assert df.select(F.levenshtein("a", "b")).first()[0] == 1


def test_lcs():
    assert Y.lcs_length("ABCBDAB", "BDCABA") == 4
    assert Y.lcs_length("", "x") == 0 and Y.lcs_length("same", "same") == 4


# Published examples of the 1980 algorithm.
STEMS = {
    "caresses": "caress", "ponies": "poni", "cats": "cat", "feed": "feed", "agreed": "agre", "plastered": "plaster",
    "motoring": "motor", "sing": "sing", "conflated": "conflat", "hopping": "hop", "falling": "fall", "filing": "file",
    "happy": "happi", "sky": "sky", "relational": "relat", "conditional": "condit", "digitizer": "digit",
    "operator": "oper", "hopefulness": "hope", "triplicate": "triplic", "electrical": "electr", "revival": "reviv",
    "allowance": "allow", "adoption": "adopt", "bowdlerize": "bowdler", "probate": "probat", "rate": "rate",
    "cease": "ceas", "controll": "control", "roll": "roll",
}


def test_stems():
    assert {w: X.porter_stem(w) for w in STEMS} == STEMS


def test_html_tables(spark):
    html = "<table><tr><td>x</td></tr></table><table><tr><th>a</th><th>b</th></tr><tr><td>1<td> two &lt;2 </tr><tr><td>3</td></tr></table>"
    pages = spark.createDataFrame([(7, html), (8, None)], "page_id bigint, html string")
    rows = markup.table_rows(markup.table_cells(pages), 1, ["a", "b"]).orderBy("row_no").collect()
    assert [(r["page_id"], r["a"], r["b"]) for r in rows] == [(7, "1", "two <2"), (7, "3", None)]


def test_kappa_and_macro(spark):
    rows = [("a", "a")] * 20 + [("a", "b")] * 5 + [("b", "a")] * 10 + [("b", "b")] * 15
    df = spark.createDataFrame(rows, "y string, p string")
    assert M.kappa(df, "y", "p").first()["kappa"] == pytest.approx(0.4)
    m = M.macro_prf(df, "y", "p").first()
    assert m["macro_recall"] == pytest.approx((0.8 + 0.6) / 2)


def test_pivot_grades(spark):
    from tidewater.operators.relational import align_years

    df = spark.createDataFrame([("A", 2008, 1.0), ("A", 2009, 2.0), ("B", 2008, 3.0)], "k string, year int, mean_value double")
    assert [tuple(r) for r in align_years(df, "k", [2008, 2009], "r").collect()] == [("A", 1.0, 2.0)]


def test_line_runs_repeat_the_joint(spark):
    df = spark.createDataFrame([("g", i, c) for i, c in enumerate("rrbbr")], "g string, i int, c string")
    got = sorted((r["run"], r["i"], r["c"], r["carried"]) for r in O.line_runs(df, ["g"], ["i"], "c").collect())
    assert got == [
        (0, 0, "r", False), (0, 1, "r", False), (1, 1, "r", True), (1, 2, "b", False), (1, 3, "b", False),
        (2, 3, "b", True), (2, 4, "r", False),
    ]


def test_affine_access(spark):
    a = spark.createDataFrame([(i, float(i)) for i in range(6)], "row_idx bigint, x double")
    b = spark.createDataFrame([(i, 10.0 * i) for i in range(12)], "row_idx bigint, y double")
    got = sorted((r["i"], r["x"], r["y"]) for r in O.affine_join(a, b, (1, 1), (2, 3)).collect())
    assert got == [(i, i + 1.0, 10.0 * (2 * i + 3)) for i in range(5)]


def test_bernoulli_prior_sums(spark):
    docs = spark.createDataFrame([(1, "p"), (2, "p"), (3, "n")], "doc_id int, label string")
    present = spark.createDataFrame([(1, "p", "good"), (2, "p", "good"), (2, "p", "all"), (1, "p", "all"), (3, "n", "all")], "doc_id int, label string, word string")
    vocab = spark.createDataFrame([("good",), ("all",)], "word string")
    model = B.PresenceModel(docs, present, vocab, "toolkit")
    w = {r["word"]: [math.exp(x) for x in r["log_p1"]] for r in model.weights.collect()}
    assert w["good"] == pytest.approx([0.5 / 2, 2.5 / 3])
    assert w["all"] == pytest.approx([1.0, 1.0])  # one observed value: no choice left

"""C4.5 against a plain recursive implementation."""

import math
import random

import pytest

from tidewater.operators import c45 as T

LEAST = 2.0


def bits(counts):
    n = sum(counts)
    return -sum(c / n * math.log2(c / n) for c in counts if c > 0) if n > 0 else 0.0


def by_class(rows, k):
    out = [0.0] * k
    for r, w in rows:
        out[r["y"]] += w
    return out


def plain(rows, k, nums, cats, used=frozenset()):
    """(weights, attribute, cut, {branch: subtree}); rows are (row, weight)."""
    weights = by_class(rows, k)
    total = sum(weights)
    if total < 2 * LEAST - 1e-9 or sum(x > 1e-9 for x in weights) < 2:
        return [weights, None, None, {}]
    found = []
    for a in [*nums, *cats]:
        if a in used:
            continue
        known = [(r, w) for r, w in rows if r[a] is not None]
        n = sum(w for _, w in known)
        if not known:
            continue
        before = bits(by_class(known, k))
        if a in nums:
            values = sorted({r[a] for r, _ in known})
            best = None
            for v in values[:-1]:
                low, high = [x for x in known if x[0][a] <= v], [x for x in known if x[0][a] > v]
                n_low, n_high = sum(w for _, w in low), sum(w for _, w in high)
                if min(n_low, n_high) < LEAST - 1e-9:
                    continue
                gain = before - (n_low * bits(by_class(low, k)) + n_high * bits(by_class(high, k))) / n
                if best is None or round(gain, 9) > round(best[0], 9):
                    best = (gain, v, {True: low, False: high})
            if best is None:
                continue
            gain, cut, arms = best[0] - math.log2(max(1, len(values) - 1)) / n, best[1], best[2]
        else:
            arms = {}
            for r, w in known:
                arms.setdefault(r[a], []).append((r, w))
            if sum(sum(w for _, w in arm) >= LEAST - 1e-9 for arm in arms.values()) < 2:
                continue
            gain, cut = before - sum(sum(w for _, w in arm) * bits(by_class(arm, k)) for arm in arms.values()) / n, None
        gain *= n / total
        parts = [sum(w for _, w in arm) for arm in arms.values()] + [max(0.0, total - n)]
        info = -sum(p / total * math.log2(p / total) for p in parts if p > 0)
        if gain > 1e-9 and info > 1e-9:
            found.append((gain, gain / info, a, cut, arms, n))
    if not found:
        return [weights, None, None, {}]
    mean = sum(f[0] for f in found) / len(found)
    _, _, a, cut, arms, n = max((f for f in found if f[0] >= mean - 1e-9), key=lambda f: round(f[1], 9))
    gone = [(r, w) for r, w in rows if r[a] is None]
    below = {}
    for v in sorted(arms, key=lambda v: (v is False, str(v))):
        share = sum(w for _, w in arms[v]) / n
        below[v] = plain(arms[v] + [(r, w * share) for r, w in gone], k, nums, cats, used | ({a} if cut is None else set()))
    return [weights, a, cut, below]


def pruned(t, confidence):
    total, wrong = sum(t[0]), sum(t[0]) - max(t[0])
    leaf = wrong + T.extra_errors(total, wrong, confidence)
    if not t[3]:
        return leaf
    below = sum(pruned(c, confidence) for c in t[3].values())
    if leaf <= below + 0.1:
        t[1], t[2], t[3] = None, None, {}
        return leaf
    return below


def shape(tree, i=0):
    node = tree.nodes[i]
    leaf = tree.is_leaf(i)
    return [[round(w, 6) for w in node.weights], None if leaf else node.attribute, None if leaf else node.cut, {} if leaf else {v: shape(tree, c) for v, c in node.children.items()}]


def rounded(t):
    return [[round(w, 6) for w in t[0]], t[1], t[2], {v: rounded(c) for v, c in t[3].items()}]


def share(t, row, k):
    if not t[3]:
        n = sum(t[0])
        return [w / n if n else 1 / k for w in t[0]]
    v = row[t[1]]
    arm = None if v is None else t[3].get(v <= t[2] if t[2] is not None else v)
    if arm is not None:
        return share(arm, row, k)
    sizes = {b: sum(c[0]) for b, c in t[3].items()}
    parts = [(sizes[b] / sum(sizes.values()), share(c, row, k)) for b, c in t[3].items() if sizes[b] > 0]
    return [sum(s * p[j] for s, p in parts) for j in range(k)]


@pytest.fixture(scope="module")
def table(spark):
    draw = random.Random(6)
    rows = []
    for i in range(320):
        a, b = round(draw.random() * 10, 1), draw.randint(0, 6)
        c, d = draw.choice(["red", "blue", "green"]), draw.choice(["x", "y"])
        y = "one" if a > 6 and c != "red" else "two" if b > 3 and d == "x" else "three" if c == "green" else "one"
        y = draw.choice(["one", "two", "three"]) if draw.random() < 0.12 else y
        hide = lambda v: None if draw.random() < 0.06 else v
        rows.append((i, y, hide(a), hide(float(b)), hide(c), hide(d)))
    rows += [(900, None, 1.0, 1.0, "red", "x")]
    return rows, spark.createDataFrame(rows, "id int, label string, a double, b double, c string, d string").repartition(4)


@pytest.mark.parametrize("group_rows", [None, 5])
def test_tree_is_the_plain_one(spark, table, monkeypatch, group_rows):
    if group_rows:
        from tidewater.operators import ordered

        sums = ordered.running_sums
        monkeypatch.setattr(T, "running_sums", lambda *a: sums(*a, group_rows))
    rows, df = table
    names = ["one", "three", "two"]
    data = [({"y": names.index(r[1]), "a": r[2], "b": r[3], "c": r[4], "d": r[5]}, 1.0) for r in rows if r[1]]
    want = plain(data, 3, ["a", "b"], ["c", "d"])
    tree = T.grow(df, "label", ["a", "b"], ["c", "d"], max_depth=2 if group_rows else None)
    if group_rows:
        for t in want[3].values():
            for below in t[3].values():
                below[1:] = [None, None, {}]
        assert shape(tree) == rounded(want)
        return
    assert shape(tree) == rounded(want)
    pruned(want, 0.25)
    T.prune(tree, 0.25)
    assert shape(tree) == rounded(want) and 3 < len(T.tree_rows(tree)) < len(tree.nodes)
    extra = [(1000, "?", 5.0, None, "violet", None), (1001, "?", None, None, None, None)]
    asked = df.unionByName(spark.createDataFrame(extra, df.schema))
    for r in T.predict(asked, tree).collect():
        p = share(want, r.asDict(), 3)
        assert r.confidence == pytest.approx(max(p)) and p[names.index(r.predicted)] == pytest.approx(max(p))


def test_trees_without_rows_or_splits(spark):
    none = spark.createDataFrame([], "label string, a double")
    assert T.c45(none, "label", ["a"]).nodes == {}
    same = spark.createDataFrame([("x", 1.0), ("x", 2.0), ("y", None)], "label string, a double")
    tree = T.c45(same, "label", ["a"])
    assert T.tree_rows(tree) == [(0, None, None, None, None, "x", 3.0, 1.0)]


def test_error_limit_grows_with_confidence():
    assert T.extra_errors(6, 0, 0.25) == pytest.approx(6 * (1 - 0.25 ** (1 / 6)))  # 0.206 a row, as published
    assert T.extra_errors(100, 10, 0.1) > T.extra_errors(100, 10, 0.25) > 0
    assert T.extra_errors(4, 4, 0.25) == 0

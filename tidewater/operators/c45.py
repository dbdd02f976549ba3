"""C4.5 decision trees (Quinlan 1993), grown a level at a time.

Rows carry their node and a weight.  A level takes one aggregate of class
weights by (node, attribute, value); running sums over the sorted distinct
values score every cut of every numeric attribute, and each categorical
attribute is scored as a many-way split.  What comes to the driver is one
candidate for each node and attribute; the tree itself lives there, as the
model.

Missing values count in fractions: gain is scaled by the known share, the split
information counts the missing rows as one more branch, and a row that misses
the chosen attribute goes down all branches with the shares of the known
weights, in training as in prediction.  Among splits with at least average gain
the best gain ratio wins; a numeric cut pays log2(cuts) / rows, and two branches
must hold ``least`` rows each.  Pruning replaces a subtree by a leaf when the
pessimistic error of the leaf, at confidence ``confidence``, is no more than a
tenth above that of the subtree; subtrees are not raised.

Rows without a label are left out.  Ties go to the earlier attribute, the smaller
cut and the smaller label.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.operators.ordered import running_sums
from tidewater.session import settle

MOST_CLASSES = 200  # class weights stand in columns
SLACK = 1e-9


@dataclass
class Node:
    weights: list[float]  # by class
    attribute: str | None = None
    cut: float | None = None  # numeric: at most the cut goes to the first branch
    children: dict = field(default_factory=dict)  # branch value -> node number
    pruned: bool = False


@dataclass
class Tree:
    classes: list
    numeric: list[str]
    categorical: list[str]
    nodes: dict[int, Node]

    def is_leaf(self, i: int) -> bool:
        return self.nodes[i].pruned or not self.nodes[i].children


def entropy(parts: Sequence[Column]) -> Column:
    """Bits of weights given as columns, times their sum."""
    bits = lambda c: F.when(c > 0, c * F.log2(c)).otherwise(0.0)
    total = sum(parts[1:], parts[0])
    return bits(total) - sum((bits(c) for c in parts[1:]), bits(parts[0]))


def numbered(df: DataFrame, label: str, numeric: Sequence[str], categorical: Sequence[str]) -> tuple[DataFrame, list]:
    counted = df.filter(F.col(label).isNotNull()).groupBy(label).count().orderBy(label).limit(MOST_CLASSES + 1).collect()
    classes = [r[0] for r in counted]
    if len(classes) > MOST_CLASSES:
        raise ValueError(f"more than {MOST_CLASSES} classes")
    y = F.coalesce(*[F.when(F.col(label) == F.lit(c), F.lit(k)) for k, c in enumerate(classes)]) if classes else F.lit(0)
    nums = F.array(*[F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) for c in numeric]) if numeric else F.lit(None).cast("array<double>")
    cats = F.array(*[F.col(c).cast("string") for c in categorical]) if categorical else F.lit(None).cast("array<string>")
    rows = df.filter(F.col(label).isNotNull()).select(y.alias("y"), nums.alias("nums"), cats.alias("cats"), F.lit(0).alias("node"), F.lit(1.0).alias("w"))
    return rows, classes


def _sums(n_classes: int) -> list[Column]:
    return [F.sum(F.when(F.col("y") == k, F.col("w")).otherwise(0.0)).alias(f"c{k}") for k in range(n_classes)]


def class_weights(rows: DataFrame, n_classes: int) -> dict[int, list[float]]:
    """Weights of every node's rows by class."""
    found = rows.groupBy("node").agg(*_sums(n_classes)).collect()
    return {r.node: [r[f"c{k}"] for k in range(n_classes)] for r in found}


def numeric_splits(rows: DataFrame, n_classes: int, least: float) -> DataFrame:
    """Best cut of every (node, attribute): its gain and split information over the known rows."""
    cs = [F.col(f"c{k}") for k in range(n_classes)]
    cells = rows.filter("nums is not null").select("node", "y", "w", F.posexplode("nums").alias("attr", "v")).filter("v is not null")
    counts = settle(cells.groupBy("node", "attr", "v").agg(*_sums(n_classes)), "counts")
    sums = running_sums(counts, ["node", "attr"], ["v"], {f"l{k}": cs[k] for k in range(n_classes)})
    whole = counts.groupBy("node", "attr").agg(*[F.sum(c).alias(f"t{k}") for k, c in enumerate(cs)], F.count("*").alias("values"))
    both = sums.join(F.broadcast(whole) if whole.count() < 100_000 else whole, ["node", "attr"])
    left = [F.col(f"l{k}") for k in range(n_classes)]
    total = [F.col(f"t{k}") for k in range(n_classes)]
    right = [F.greatest(t - a, F.lit(0.0)) for t, a in zip(total, left, strict=True)]
    n_left, n_all = sum(left[1:], left[0]), sum(total[1:], total[0])
    n_right = n_all - n_left
    gain = (entropy(total) - entropy(left) - entropy(right)) / n_all
    # the last value has nothing to its right
    sound = both.filter((n_left >= least - SLACK) & (n_right >= least - SLACK))
    scored = sound.select("node", "attr", "v", gain.alias("gain"), n_left.alias("n_left"), n_right.alias("n_right"), "values")
    top = scored.groupBy("node", "attr").agg(F.max_by(F.struct("v", "gain", "n_left", "n_right", "values"), F.struct(F.round("gain", 9), -F.col("v"))).alias("b"))
    return top.select("node", "attr", "b.*")


def categorical_splits(rows: DataFrame, n_classes: int, least: float) -> DataFrame:
    """Gain and branch weights of every (node, attribute) as a many-way split of its known rows."""
    cs = [F.col(f"c{k}") for k in range(n_classes)]
    cells = rows.filter("cats is not null").select("node", "y", "w", F.posexplode("cats").alias("attr", "v")).filter("v is not null")
    counts = cells.groupBy("node", "attr", "v").agg(*_sums(n_classes))
    n = sum(cs[1:], cs[0])
    inside = counts.select("node", "attr", "v", *cs, n.alias("n"), entropy(cs).alias("h"))
    per = inside.groupBy("node", "attr").agg(
        *[F.sum(c).alias(f"c{k}") for k, c in enumerate(cs)],
        F.sum("h").alias("h"),
        F.sum(F.when(F.col("n") >= least - SLACK, 1).otherwise(0)).alias("large"),
        F.sort_array(F.collect_list(F.struct("v", "n"))).alias("branches"),
    )
    return per.filter("large > 1").select("node", "attr", ((entropy(cs) - F.col("h")) / n).alias("gain"), "branches")


def split_bits(parts: Sequence[float], total: float) -> float:
    return -sum(p / total * math.log2(p / total) for p in parts if p > 0)


def candidates(rows: DataFrame, weights: dict[int, list[float]], numeric: Sequence[str], categorical: Sequence[str], used: dict[int, set], least: float) -> dict[int, list[tuple]]:
    """node -> (gain, ratio, attribute, cut, branches) of each attribute that can split it."""
    n_classes = len(next(iter(weights.values())))
    out: dict[int, list[tuple]] = {}

    def put(node: int, attribute: str, gain: float, cut: float | None, branches: dict) -> None:
        total, known = sum(weights[node]), sum(branches.values())
        gain *= known / total
        info = split_bits([*branches.values(), max(0.0, total - known)], total)
        if gain > SLACK and info > SLACK:
            out.setdefault(node, []).append((gain, gain / info, attribute, cut, branches))

    if numeric:
        for r in numeric_splits(rows, n_classes, least).collect():
            known = r.n_left + r.n_right
            gain = r.gain - math.log2(max(1, r["values"] - 1)) / known
            put(r.node, numeric[r.attr], gain, r.v, {True: r.n_left, False: r.n_right})
    if categorical:
        for r in categorical_splits(rows, n_classes, least).collect():
            if categorical[r.attr] not in used[r.node]:
                put(r.node, categorical[r.attr], r.gain, None, {b.v: b.n for b in r.branches})
    order = [*numeric, *categorical]
    for found in out.values():
        found.sort(key=lambda c: order.index(c[2]))
    return out


def chosen(found: Sequence[tuple]) -> tuple | None:
    """Best gain ratio among the splits of at least average gain."""
    if not found:
        return None
    mean = sum(c[0] for c in found) / len(found)
    return max((c for c in found if c[0] >= mean - SLACK), key=lambda c: round(c[1], 9))


def grow(df: DataFrame, label: str, numeric: Sequence[str], categorical: Sequence[str], least: float = 2.0, max_depth: int | None = None) -> Tree:
    """The unpruned tree."""
    rows, classes = numbered(df, label, numeric, categorical)
    tree = Tree(classes, list(numeric), list(categorical), {})
    used: dict[int, set] = {0: set()}
    rows, depth, born = settle(rows, "level"), 0, 1
    while classes:
        weights = class_weights(rows, len(classes))
        for i, w in weights.items():
            if i in tree.nodes:
                tree.nodes[i].weights = w
            else:
                tree.nodes[i] = Node(w)
        open_nodes = {i for i, w in weights.items() if sum(w) >= 2 * least - SLACK and sum(x > SLACK for x in w) > 1}
        if not open_nodes or (max_depth is not None and depth >= max_depth):
            break
        if open_nodes != set(weights):
            rows = rows.filter(F.col("node").isin(sorted(open_nodes))) if len(open_nodes) < 1000 else rows.join(
                F.broadcast(df.sparkSession.createDataFrame([(i,) for i in open_nodes], "node int")), "node"
            )
        picks = {i: chosen(c) for i, c in candidates(rows, weights, numeric, categorical, used, least).items()}
        splits = []
        for i, pick in sorted(picks.items()):
            if pick is None or i not in open_nodes:
                continue
            _, _, attribute, cut, branches = pick
            node, known = tree.nodes[i], sum(branches.values())
            node.attribute, node.cut = attribute, cut
            arms = []
            for value, n in branches.items():
                node.children[value] = born
                tree.nodes[born] = Node([0.0] * len(classes))
                used[born] = used[i] | ({attribute} if cut is None else set())
                arms.append((str(value), born, n / known))
                born += 1
            place = list(numeric).index(attribute) if cut is not None else list(categorical).index(attribute)
            splits.append((i, place, cut is not None, cut, arms))
        if not splits:
            break
        plan = df.sparkSession.createDataFrame(splits, "node int, place int, is_num boolean, cut double, arms array<struct<v: string, child: int, share: double>>")
        moved = rows.join(F.broadcast(plan), "node")  # a row for each open node
        number = F.get("nums", F.col("place"))
        value = F.when(F.col("is_num"), F.initcap((number <= F.col("cut")).cast("string"))).otherwise(F.get("cats", F.col("place")))
        arm = F.explode(F.filter("arms", lambda a: F.col("value").isNull() | (a["v"] == F.col("value")))).alias("arm")
        moved = moved.withColumn("value", value).select("y", "nums", "cats", "w", "value", arm)
        share = F.when(F.col("value").isNull(), F.col("arm.share")).otherwise(1.0)
        rows = settle(moved.select("y", "nums", "cats", F.col("arm.child").alias("node"), (F.col("w") * share).alias("w")).filter("w > 0"), "level")
        depth += 1
    return tree


# ------------------------------------------------------------------ pruning


def extra_errors(n: float, errors: float, confidence: float) -> float:
    """Errors to add to those seen among n rows: the upper limit of the binomial at this confidence."""
    if n <= 0:
        return 0.0
    if errors < 1:
        none = n * (1 - confidence ** (1 / n))
        return none if errors <= 0 else none + errors * (extra_errors(n, 1.0, confidence) - none)
    if errors + 0.5 >= n:
        return max(n - errors, 0.0)
    z = NormalDist().inv_cdf(1 - confidence)
    f = (errors + 0.5) / n
    top = f + z * z / (2 * n) + z * math.sqrt(f / n - f * f / n + z * z / (4 * n * n))
    return n * top / (1 + z * z / n) - errors


def prune(tree: Tree, confidence: float = 0.25) -> Tree:
    """Subtrees that a leaf would match become leaves, from the bottom up."""
    estimate: dict[int, float] = {}
    for i in sorted(tree.nodes, reverse=True):  # children are numbered after their parent
        node = tree.nodes[i]
        n = sum(node.weights)
        wrong = n - max(node.weights, default=0.0)
        leaf = wrong + extra_errors(n, wrong, confidence)
        below = sum(estimate[c] for c in node.children.values())
        node.pruned = bool(node.children) and leaf <= below + 0.1
        estimate[i] = leaf if node.pruned or not node.children else below
    return tree


# --------------------------------------------------------------- prediction


def leaf_weights(tree: Tree, pdf: pd.DataFrame) -> np.ndarray:
    """Class weights of every row: shares of the leaves it reaches."""
    out = np.zeros((len(pdf), len(tree.classes)))
    todo = [(0, np.arange(len(pdf)), np.ones(len(pdf)))] if tree.nodes else []
    while todo:
        i, at, w = todo.pop()
        node = tree.nodes[i]
        weights = np.asarray(node.weights)
        if tree.is_leaf(i) or weights.sum() <= 0:
            share = weights / weights.sum() if weights.sum() > 0 else np.full(len(weights), 1 / max(1, len(weights)))
            np.add.at(out, at, w[:, None] * share[None, :])
            continue
        column = pdf[node.attribute].iloc[at]
        gone = column.isna().to_numpy()
        seen = np.zeros(len(at), dtype=bool)
        sizes = {v: sum(tree.nodes[c].weights) for v, c in node.children.items()}
        for value, child in node.children.items():
            if node.cut is not None:
                here = ((pd.to_numeric(column, errors="coerce") <= node.cut) == value).to_numpy() & ~gone
            else:
                here = (column.astype(str) == value).to_numpy() & ~gone
            seen |= here
            if here.any():
                todo.append((child, at[here], w[here]))
        rest = ~seen
        if rest.any():
            for value, child in node.children.items():
                if sizes[value] > 0:
                    todo.append((child, at[rest], w[rest] * sizes[value] / sum(sizes.values())))
    return out


def predict(df: DataFrame, tree: Tree, name: str = "predicted") -> DataFrame:
    """The rows with the likeliest class and its ``confidence``."""
    shipped = df.sparkSession.sparkContext.broadcast((tree.classes, tree.numeric, tree.categorical, {i: (n.weights, n.attribute, n.cut, n.children, n.pruned) for i, n in tree.nodes.items()}))
    rows = df.select(*[c for c in df.columns if c not in (name, "confidence")])
    first = next(iter(tree.classes), None)
    empty = df.sparkSession.createDataFrame([], rows.schema)
    spec = empty.withColumn(name, F.lit(first)).withColumn("confidence", F.lit(0.0)).schema

    def say(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        classes, numeric, categorical, nodes = shipped.value
        model = Tree(classes, numeric, categorical, {i: Node(*n) for i, n in nodes.items()})
        for pdf in batches:
            share = leaf_weights(model, pdf)
            best = share.round(9).argmax(1) if share.shape[1] else np.zeros(len(pdf), dtype=int)
            yield pdf.assign(**{name: [classes[k] for k in best] if classes else None, "confidence": share.max(1, initial=0)})

    return rows.mapInPandas(say, spec)


def tree_rows(tree: Tree) -> list[tuple]:
    """(node, parent, branch, attribute, cut, label, weight, errors) of every node that pruning left."""
    out, todo = [], [(0, None, None)] if tree.nodes else []
    while todo:
        i, parent, branch = todo.pop(0)
        node = tree.nodes[i]
        best = max(range(len(node.weights)), key=lambda k: (round(node.weights[k], 9), -k))
        leaf = tree.is_leaf(i)
        out.append((i, parent, branch, None if leaf else node.attribute, None if leaf else node.cut, str(tree.classes[best]), float(sum(node.weights)), float(sum(node.weights) - node.weights[best])))
        if not leaf:
            todo += [(c, i, str(v)) for v, c in node.children.items()]
    return out


def c45(df: DataFrame, label: str, numeric: Sequence[str], categorical: Sequence[str] = (), least: float = 2.0, confidence: float = 0.25) -> Tree:
    """Grown and pruned tree."""
    return prune(grow(df, label, numeric, categorical, least), confidence)

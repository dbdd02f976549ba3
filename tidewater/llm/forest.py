"""Near-duplicate embeddings by a forest of random-projection trees.

A node splits its vectors by a random direction around the median; those between
two quantiles beside the median spill to both sides.  Nodes are split level by
level until they hold at most ``leaf`` vectors, every level one grouped pass, so
depth follows the data.  Vectors are compared within leaves only, in double
precision.  A pair that meets in several leaves counts in the first of them, by
the leaves that its two vectors carry, so links can be counted in place: a leaf
returns for each vector its number of links and the smallest vector it is
connected to, never its pairs.  Equal vectors of a label are one class.

Splits by count would cut a cloud of near copies larger than a leaf to pieces, so
clouds are found first: a leaf of the first tree in which some vector has many
links names their mean as a centre, and centres close to each other are one.  A
vector that links with a centre is inside its crowd, one within twice that angle
around it.  Pairs of a crowd with a vector inside are compared block against
block, whatever their number; by the triangle inequality that is every link of an
inside vector.  Vectors within half the angle link with each other for sure: they
are the core, whose links are counted by its size.  A pair belongs to its core,
else to its first crowd, else to its first leaf.

A node that no direction divides stays whole and is compared block against
block.  Vectors that are null, zero or hold null or non-finite components, and
vectors without a label, link with nothing; vectors of different lengths neither.
A row without an id is kept; its component is null.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.operators.components import components
from tidewater.operators.relational import small
from tidewater.session import settle

TREES = 10
LEAF = 512
SPILL = 0.05  # share of a node on either side of its median that goes both ways
TREE_BITS = 48  # a leaf's number is its tree above so many bits of its path
MOST_LEVELS = 40
DENSE = 8  # a vector linked with one in so many of a full leaf names a centre
CROWD = 2048  # rows of a block of a crowd
EDGE = 1e-9  # comparisons this close to a threshold are repeated term by term


def _vectors(column: pa.Array) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(flat), -1)


def unit(v: np.ndarray) -> np.ndarray:
    scaled = v / np.abs(v).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled**2).sum(axis=1, keepdims=True))


def _projected(trees: int, levels: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        directions: dict[int, np.ndarray] = {}
        for batch in batches:
            by_size: dict[int, list[int]] = {}
            for k, n in enumerate(batch.column(2).value_lengths().to_pylist()):
                by_size.setdefault(n, []).append(k)
            for n, rows in by_size.items():
                part = batch.take(pa.array(rows))
                if n not in directions:
                    directions[n] = np.random.default_rng([seed, n]).standard_normal((trees * levels, n))
                at = (unit(_vectors(part.column(2))) @ directions[n].T).reshape(len(rows), trees, levels)
                for t in range(trees):
                    flat = pa.array(at[:, t].astype(np.float32).ravel())
                    ends = pa.array(np.arange(len(rows) + 1, dtype=np.int32) * levels)
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0), part.column(1), pa.array([t] * len(rows), pa.int32()), pa.ListArray.from_arrays(ends, flat)],
                        names=["space", "rep", "tree", "at"],
                    )

    return run


def grown(points: DataFrame, trees: int, leaf: int, spill: float, seed: int) -> DataFrame:
    """(space, rep, home): the leaves of every point of (space, rep, v)."""
    largest = points.groupBy("space").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    levels = 0
    if largest > leaf:
        levels = min(MOST_LEVELS, 2 + math.ceil(math.log(largest / leaf) / -math.log(0.5 + spill)))
    spec = "space string, rep bigint, tree int, at array<float>"
    state = points.select("space", "rep", "v").mapInArrow(_projected(trees, max(1, levels), seed), spec)
    state = state.withColumn("node", F.lit(1).cast("long"))
    if levels:
        state = settle(state, "roots")
    done: list[DataFrame] = []
    for level in range(levels):
        at = F.get("at", F.lit(level))
        cuts = state.groupBy("space", "tree", "node").agg(
            F.count("*").alias("n"), F.percentile_approx(at, [0.5 - spill, 0.5 + spill], 1000).alias("q")
        )
        cuts = settle(cuts.filter(F.col("n") > leaf).select("space", "tree", "node", F.get("q", F.lit(0)).alias("lo"), F.get("q", F.lit(1)).alias("hi")), "cuts")
        if not cuts.take(1):
            break
        keys = ["space", "tree", "node"]
        # equal quantiles: a plain split, so that equal projections never double
        left = F.when(F.col("lo") < F.col("hi"), at <= F.col("hi")).otherwise(at <= F.col("lo"))
        right = F.when(F.col("lo") < F.col("hi"), at >= F.col("lo")).otherwise(at > F.col("lo"))
        sides = F.filter(
            F.array(F.when(left, F.col("node") * 2), F.when(right, F.col("node") * 2 + 1)), lambda x: x.isNotNull()
        )
        joined = settle(state.join(small(cuts), keys, "left"), f"level{level}")
        done.append(joined.filter("lo is null").select("space", "rep", "tree", "node"))
        state = joined.filter("lo is not null").withColumn("node", F.explode(sides)).drop("lo", "hi")
    done.append(state.select("space", "rep", "tree", "node"))
    every = done[0]
    for d in done[1:]:
        every = every.unionByName(d)
    return every.select("space", "rep", (F.shiftleft(F.col("tree").cast("long"), TREE_BITS) + F.col("node")).alias("home"))


def _near(v: np.ndarray, w: np.ndarray, least: float) -> np.ndarray:
    """Which rows of v and w link, as exact as the definition asks near the threshold."""
    dot = v @ w.T
    near = dot >= least + EDGE
    a, b = np.nonzero((dot >= least - EDGE) & ~near)
    near[a, b] = (v[a] * w[b]).sum(axis=1) >= least
    return near


def _marks(lists: list[list[int]], names: dict[int, int]) -> np.ndarray:
    has = np.zeros((len(lists), len(names)), dtype=np.float32)
    for r, own in enumerate(lists):
        has[r, [names[x] for x in own if x in names]] = 1
    return has


def _counted(a: pa.Table, b: pa.Table, before: int | None) -> np.ndarray:
    """Pairs that their core counts, or a crowd, one before ``before`` if that is given."""
    ca, cb = (np.array([-1 if c is None else c for c in t["core"].to_pylist()]) for t in (a, b))
    met = (ca[:, None] == cb[None, :]) & (ca[:, None] >= 0)
    in_a, at_a, in_b, at_b = (t[name].to_pylist() for t in (a, b) for name in ("inside", "around"))
    both = {c for own in at_a for c in own} & {c for own in at_b for c in own}
    names = {c: k for k, c in enumerate(sorted(c for c in both if before is None or c < before))}
    if names:
        met |= _marks(in_a, names) @ _marks(at_b, names).T + _marks(at_a, names) @ _marks(in_b, names).T > 0
    return met


NONE = np.iinfo(np.int64).max


def _least_root(near: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest id that each row and column is connected to, step by step over links."""
    while True:
        low_a = np.minimum(a, np.where(near, b[None, :], NONE).min(axis=1, initial=NONE))
        low_b = np.minimum(b, np.where(near, low_a[:, None], NONE).min(axis=0, initial=NONE))
        if (low_a == a).all() and (low_b == b).all():
            return a, b
        a, b = low_a, low_b


def _leaf_links(least: float):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        home, lo, hi = key[1].as_py(), key[2].as_py(), key[3].as_py()
        ids = table["rep"].to_numpy()
        chunk = table["chunk"].to_numpy()
        times = table["times"].to_numpy().astype(np.int64)
        v = unit(_vectors(table["v"]))
        near = _near(v, v, least)
        np.fill_diagonal(near, False)
        linked = near.copy()
        if near.any():
            met = (chunk[:, None] == lo) & (chunk[None, :] == hi)
            linked &= (met | met.T) & ~_counted(table, table, None)
            homes = table["homes"].to_pylist()
            earlier = sorted({h for own in homes for h in own if h < home})
            if earlier:
                place = {h: k for k, h in enumerate(earlier)}
                has = np.zeros((len(ids), len(earlier)), dtype=np.float32)
                for r, own in enumerate(homes):
                    has[r, [place[h] for h in own if h < home]] = 1
                linked &= (has @ has.T) == 0
        links = linked @ times
        root, _ = _least_root(near, ids, ids)
        found = (links > 0) | (root < ids)
        return pa.table({"rep": ids[found], "links": links[found], "root": root[found]})

    return run


def _crowd_links(least: float):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        crowd, lo, hi = key[1].as_py(), key[2].as_py(), key[3].as_py()
        chunk = table["chunk"].to_numpy()
        a, b = table.filter(pa.array(chunk == lo)), table.filter(pa.array(chunk == hi))
        ids_a, ids_b = a["rep"].to_numpy(), b["rep"].to_numpy()
        near = _near(unit(_vectors(a["v"])), unit(_vectors(b["v"])), least) if len(a) and len(b) else np.zeros((len(a), len(b)), dtype=bool)
        near &= ids_a[:, None] != ids_b[None, :]
        linked = near & ~_counted(a, b, crowd) if near.any() else near
        links_a, links_b = linked @ b["times"].to_numpy().astype(np.int64), a["times"].to_numpy().astype(np.int64) @ linked
        root_a, root_b = _least_root(near, ids_a, ids_b)
        out = [(ids_a, links_a, root_a)] if lo == hi else [(ids_a, links_a, root_a), (ids_b, links_b, root_b)]
        ids, links, root = (np.concatenate(x) for x in zip(*out))
        found = (links > 0) | (root < ids)
        return pa.table({"rep": ids[found], "links": links[found], "root": root[found]})

    return run


def _leaf_centres(least: float, many: int):
    """The means of vectors with at least ``many`` links in a leaf and of what they link with."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        v = unit(_vectors(table["v"]))
        near = _near(v, v, least)
        centres, weights = [], []
        while True:
            links = near.sum(axis=1)
            top = int(links.argmax())
            if links[top] <= many:
                break
            own = near[top].copy()
            centres.append(unit(v[own].mean(axis=0, keepdims=True))[0])
            weights.append(int(links[top]))
            near[own] = False
            near[:, own] = False
        return pa.table(
            {"space": pa.array([key[0].as_py()] * len(centres), pa.string()), "centre": pa.array(centres, pa.list_(pa.float64())), "weight": pa.array(weights, pa.int64())}
        )

    return run


def _merged_centres(sure: float):
    """Of centres within ``sure`` of a weightier one only the weighted mean stays."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        v, weight = _vectors(table["centre"]), table["weight"].to_numpy()
        order = np.lexsort([*v.T[::-1], -weight])
        v, weight = v[order], weight[order]
        out, open_ = [], np.ones(len(v), dtype=bool)
        while open_.any():
            close = open_ & (v @ v[open_.argmax()] >= sure)
            close[open_.argmax()] = True
            out.append(unit((v[close] * weight[close, None]).sum(axis=0, keepdims=True))[0])
            open_ &= ~close
        return pa.table({"space": pa.array([key[0].as_py()] * len(out), pa.string()), "centre": pa.array(out, pa.list_(pa.float64()))})

    return run


def _placed(centres: dict[str, np.ndarray], first: dict[str, int], least: float):
    """Adds to points the crowds they are inside of and around, and their core."""
    wide = math.cos(min(math.pi, 2 * math.acos(least))) - EDGE
    sure = math.sqrt((1 + least) / 2) + EDGE

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            inside: list = [[]] * batch.num_rows
            around: list = [[]] * batch.num_rows
            core: list = [None] * batch.num_rows
            by_space: dict[str, list[int]] = {}
            for k, space in enumerate(batch.column(0).to_pylist()):
                if space in centres:
                    by_space.setdefault(space, []).append(k)
            for space, rows in by_space.items():
                at = unit(_vectors(batch.column(2).take(pa.array(rows)))) @ centres[space].T
                for k, near in zip(rows, at):
                    around[k] = [int(c) + first[space] for c in np.flatnonzero(near >= wide)]
                    inside[k] = [int(c) + first[space] for c in np.flatnonzero(near >= least - EDGE)]
                    own = np.flatnonzero(near >= sure)
                    core[k] = int(own[0]) + first[space] if len(own) else None
            kind = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(inside, kind), pa.array(around, kind), pa.array(core, pa.int64())],
                names=["space", "rep", "v", "times", "inside", "around", "core"],
            )

    return run


def crowds(points: DataFrame, homes: DataFrame, least: float, leaf: int) -> tuple[DataFrame, DataFrame | None]:
    """The points with their crowds, and (rep, links, root) of the links that crowds count."""
    cut = homes.select("space", "rep", F.explode("homes").alias("home")).filter(F.col("home").between(2, (1 << TREE_BITS) - 1))
    if not cut.take(1):
        none = F.array().cast("array<bigint>")
        return points.withColumns({"inside": none, "around": none, "core": F.lit(None).cast("long")}), None
    sizes = settle(cut.groupBy("space", "home").agg(F.count("*").alias("n")).filter(F.col("n") <= leaf), "leaves")
    leaves = cut.join(small(sizes.drop("n")), ["space", "home"], "left_semi").join(points, ["space", "rep"])
    found = leaves.groupBy("space", "home").applyInArrow(_leaf_centres(least, max(2, leaf // DENSE)), "space string, centre array<double>, weight bigint")
    found = settle(found, "dense")
    merged = found.groupBy("space").applyInArrow(_merged_centres(math.sqrt((1 + least) / 2)), "space string, centre array<double>")
    centres: dict[str, list] = {}
    for space, centre in merged.collect():
        centres.setdefault(space, []).append(centre)
    first, n = {}, 0
    for space in sorted(centres):
        centres[space] = np.array(sorted(centres[space]))
        first[space], n = n, n + len(centres[space])
    kind = points.schema["v"].dataType.simpleString()
    spec = f"space string, rep bigint, v {kind}, times bigint, inside array<bigint>, around array<bigint>, core bigint"
    points = points.select("space", "rep", "v", "times").mapInArrow(_placed(centres, first, least), spec)
    points = settle(points, "placed")
    if not n:
        return points, None
    total = points.filter("core is not null").groupBy("core").agg(F.sum("times").alias("total"), F.min("rep").alias("root"))
    sure = points.join(small(settle(total, "cores")), "core").select("rep", (F.col("total") - F.col("times")).alias("links"), "root")
    # chunks of the core, of the others inside, of the others around, in this order
    member = points.withColumn("crowd", F.explode("around"))
    part = F.when(F.col("core") == F.col("crowd"), 0).when(F.array_contains("inside", F.col("crowd")), 1).otherwise(2)
    member = member.withColumn("part", part)
    chunks = [F.ceil(F.count(F.when(F.col("part") == p, 1)) / F.lit(CROWD)).alias(f"c{p}") for p in (0, 1, 2)]
    member = member.join(small(settle(member.groupBy("crowd").agg(*chunks), "crowds")), "crowd")
    c0, c1, c2 = F.col("c0"), F.col("c1"), F.col("c2")
    own = F.pmod(F.xxhash64("rep"), F.when(F.col("part") == 0, c0).when(F.col("part") == 1, c1).otherwise(c2))
    member = member.withColumn("chunk", own + F.when(F.col("part") == 0, 0).when(F.col("part") == 1, c0).otherwise(c0 + c1))
    # a core needs no comparison inside, and neither do two that are only around
    start = F.when(F.col("part") == 0, c0).otherwise(0)
    end = F.when(F.col("part") == 2, c0 + c1).otherwise(c0 + c1 + c2)
    member = member.withColumn("other", F.explode(F.when(end > start, F.sequence(start, end - 1)).otherwise(F.array().cast("array<bigint>"))))
    member = member.withColumn("lo", F.least("chunk", "other")).withColumn("hi", F.greatest("chunk", "other"))
    member = member.select("space", "crowd", "lo", "hi", "rep", "chunk", "times", "v", "inside", "around", "core")
    pairs = member.groupBy("space", "crowd", "lo", "hi").applyInArrow(_crowd_links(least), "rep bigint, links bigint, root bigint")
    return points, settle(sure.unionByName(pairs), "crowd_links")


def near_vectors(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    least: float = 0.93,
    trees: int = TREES,
    leaf: int = LEAF,
    spill: float = SPILL,
    seed: int = 5,
) -> DataFrame:
    """(id, n_links, component_id, kept), a row for each vector.

    Vectors of one label with a cosine of at least ``least`` that meet in a leaf or
    a crowd are linked.  n_links counts the other vectors linked directly, copies
    included.  Rows repeated with one id are rows of their own, each linked with
    its copies.  Columns other than the three named are not read, so their names
    may be anything; an empty table gives no rows.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"), F.col(label_col).alias("label"))
    sound = F.col("label").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0)
    sound &= F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists("v", lambda x: x != 0)
    rows = settle(rows.withColumn("sound", F.coalesce(sound, F.lit(False)) & F.col("id").isNotNull()), "vectors")
    space = F.concat_ws(":", F.col("label").cast("string"), F.size("v").cast("string"))
    good = rows.filter("sound").withColumn("space", space)
    points = good.groupBy("space", "v").agg(F.min("id").alias("rep"), F.count("*").alias("times"))
    points = settle(points.select("space", "rep", "v", "times"), "points")
    homes = grown(points, trees, leaf, spill, seed)
    homes = settle(homes.groupBy("space", "rep").agg(F.sort_array(F.collect_set("home")).alias("homes")), "homes")
    points, crowded = crowds(points, homes, least, leaf)
    rooms = homes.select("space", F.explode("homes").alias("home")).groupBy("space", "home").agg(F.count("*").alias("n"))
    large = settle(rooms.filter(F.col("n") > leaf).select("space", "home", F.ceil(F.col("n") / F.lit(leaf)).alias("chunks")), "large")
    member = points.join(homes, ["space", "rep"]).withColumn("home", F.explode("homes"))
    member = member.join(small(large), ["space", "home"], "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
    member = member.withColumn("chunk", F.pmod(F.xxhash64("rep"), F.col("chunks")))
    member = member.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
    member = member.withColumn("lo", F.least("chunk", "other")).withColumn("hi", F.greatest("chunk", "other"))
    member = member.select("space", "home", "lo", "hi", "rep", "chunk", "times", "v", "homes", "inside", "around", "core")
    found = member.groupBy("space", "home", "lo", "hi").applyInArrow(_leaf_links(least), "rep bigint, links bigint, root bigint")
    found = settle(found if crowded is None else found.unionByName(crowded), "found")
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    joined = components(found.filter("root < rep").select("rep", "root"), "rep", "root")
    classes = points.select("space", "v", "rep", "times").join(links, "rep", "left").join(
        joined, F.col("rep") == F.col("node"), "left"
    )
    classes = classes.select("space", "v", "times", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("component", "rep").alias("c"))
    placed = good.join(classes, ["space", "v"]).select(
        "id", (F.col("links") + F.col("times") - 1).cast("long").alias("n_links"), F.col("c").alias("component_id")
    )
    alone = rows.filter("not sound").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    every = placed.unionByName(alone)
    return every.select(
        F.col("id").alias(id_col), "n_links", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept")
    )

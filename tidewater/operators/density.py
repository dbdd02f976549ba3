"""Density clustering: DBSCAN on a grid, and shared-nearest-neighbour clusters.

The grid has side eps / sqrt(d), so two points of one cell are always within
eps.  A cell with ``min_pts`` points is core as a whole and needs no pair inside
it.  Distances are measured only between a sparse cell (fewer than ``min_pts``
points) and its neighbour cells, and between dense neighbour cells to learn
whether they touch.  No step emits the pairs of a crowded cell, and crowded
cells are cut into parts so that none is held by a single task.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.operators.components import components
from tidewater.operators.relational import small
from tidewater.session import settle

PART_ROWS = 512
# two equal distances must not fall on two sides of eps through rounding
EPS_SLACK = 1e-12


def _offsets(dims: int) -> list[tuple[int, ...]]:
    """Cells that can hold a point within eps, the cell itself left out."""
    reach = math.ceil(math.sqrt(dims))
    out = []
    for o in itertools.product(range(-reach, reach + 1), repeat=dims):
        gap = sum(max(abs(x) - 1, 0) ** 2 for x in o)
        if any(o) and gap <= dims:
            out.append(o)
    return out


def _within(dims: int, eps: float) -> Column:
    sq = sum((F.col(f"a{i}") - F.col(f"b{i}")) * (F.col(f"a{i}") - F.col(f"b{i}")) for i in range(dims))
    return sq <= F.lit(eps * eps + EPS_SLACK)


def _with_cell(pts: DataFrame, dims: int, side: float) -> tuple[DataFrame, list[int]]:
    """Number the grid cells, so that a neighbour is a fixed step away and cells
    are joined on one number.  The grid is padded: a step never wraps around."""
    reach = math.ceil(math.sqrt(dims))
    at = [F.floor(F.col(f"x{i}") / F.lit(side)) for i in range(dims)]
    row = pts.agg(*[F.min(c) for c in at], *[F.max(c) for c in at]).first()
    lows = [int(v or 0) - reach for v in row[:dims]]
    spans = [int(v or 0) + reach - lo + 1 for lo, v in zip(lows, row[dims:])]
    strides = [math.prod(spans[i + 1 :]) for i in range(dims)]
    kind = "bigint" if math.prod(spans) < 1 << 62 else "decimal(38,0)"
    steps = [(c - F.lit(lo)).cast(kind) * F.lit(stride).cast(kind) for c, lo, stride in zip(at, lows, strides)]
    return pts.withColumn("cell", sum(steps[1:], steps[0]).cast(kind)), strides


def dbscan(points: DataFrame, id_col: str, coords: Sequence[str], eps: float, min_pts: int, part_rows: int = PART_ROWS) -> DataFrame:
    """(id, is_core, cluster): cluster is the least core id of the component,
    null for noise.  A border point joins the smallest cluster that reaches it,
    so the result does not depend on row order."""
    dims = len(coords)
    if dims > 4:
        raise ValueError("the grid serves up to four dimensions; cluster on shared neighbours beyond that")
    side = eps / math.sqrt(dims) * (1 - 1e-12)
    pts = points.select(
        F.col(id_col).alias("id"),
        *[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(coords)],
    )
    pts, strides = _with_cell(pts, dims, side)
    sizes = pts.groupBy("cell").agg(F.count("*").alias("n_cell"))
    sizes = settle(sizes.withColumn("parts", F.ceil(F.col("n_cell") / F.lit(part_rows))), "cells")
    pts = settle(
        pts.join(small(sizes), "cell").withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts"))),
        "grid",
    )
    cells = sizes
    kind = pts.schema["cell"].dataType
    moves = [sum(x * stride for x, stride in zip(o, strides)) for o in _offsets(dims)]
    steps = F.array(*[F.lit(m).cast(kind) for m in moves])
    near = F.transform(steps, lambda o: (F.col("cell") + o).cast(kind))
    dense = F.col("n_cell") >= min_pts

    def side_a(df: DataFrame) -> DataFrame:
        return df.select("id", "cell", *[F.col(f"x{i}").alias(f"a{i}") for i in range(dims)])

    def side_b(df: DataFrame, *extra: str) -> DataFrame:
        return df.select(
            F.col("id").alias("b_id"), F.col("cell").alias("to"), "part", *extra,
            *[F.col(f"x{i}").alias(f"b{i}") for i in range(dims)],
        )

    # parts of the neighbour cells a point must be sent to
    routes = (
        cells.filter(~dense)
        .select("cell", F.explode(near).alias("to"))
        .join(small(cells.select(F.col("cell").alias("to"), F.col("parts").alias("to_parts"))), "to")
        .select("cell", "to", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("to_parts") - 1)).alias("part"))
    )

    routes = settle(routes, "routes")  # cells that exist only; read by three joins

    # 1. degree of the points of sparse cells; their own cell counts in full
    sparse = pts.filter(~dense)
    met = side_a(sparse).join(routes, "cell").join(side_b(pts), ["to", "part"]).filter(_within(dims, eps))
    reached = met.groupBy("id").agg(F.count("*").alias("outside"))
    degree = sparse.join(reached, "id", "left").withColumn("degree", F.col("n_cell") + F.coalesce("outside", F.lit(0)))
    core_sparse = degree.filter(F.col("degree") >= min_pts).select("id")
    core = pts.join(
        core_sparse.withColumn("_c", F.lit(True)), "id", "left"
    ).withColumn("is_core", dense | F.col("_c").isNotNull()).drop("_c")
    core = settle(core, "core")
    only = core.filter("is_core")
    # a cell's core points are one cluster; its least core id names the cell
    names = only.groupBy("cell").agg(F.min("id").alias("name"))
    named = only.join(names, "cell")

    # 2. cells that touch, at least one of them sparse: points of the sparse one
    a = side_a(named.filter(~dense).select("id", "cell", *[f"x{i}" for i in range(dims)])).join(routes, "cell").join(names, "cell")
    b = side_b(named.withColumnRenamed("name", "b_name"), "b_name")
    touch = a.join(b, ["to", "part"]).filter(_within(dims, eps)).select("name", "b_name").distinct()

    # 3. two dense cells: boxes first, then one part against one part, and only
    #    the pairs still apart are measured in full
    box = only.filter(dense).groupBy("cell").agg(
        F.min("id").alias("name"), F.max("parts").alias("parts"),
        *[F.min(f"x{i}").alias(f"lo{i}") for i in range(dims)],
        *[F.max(f"x{i}").alias(f"hi{i}") for i in range(dims)],
    )
    other = box.select(*[F.col(c).alias(f"o_{c}") for c in box.columns])
    both = (
        box.withColumn("o_cell", F.explode(near))
        .join(other, "o_cell")
        .filter(F.col("name") < F.col("o_name"))
    )
    apart = sum(
        F.pow(F.greatest(F.col(f"lo{i}") - F.col(f"o_hi{i}"), F.col(f"o_lo{i}") - F.col(f"hi{i}"), F.lit(0.0)), 2)
        for i in range(dims)
    )
    across = sum(
        F.pow(F.greatest(F.col(f"hi{i}") - F.col(f"o_lo{i}"), F.col(f"o_hi{i}") - F.col(f"lo{i}")), 2)
        for i in range(dims)
    )
    limit = F.lit(eps * eps + EPS_SLACK)
    edges = [f"{o}{e}{i}" for o in ("", "o_") for e in ("lo", "hi") for i in range(dims)]
    maybe = settle(
        both.filter(apart <= limit).withColumn("sure", across <= limit).select(
            "cell", "name", "parts", "o_cell", "o_name", "o_parts", "sure", *edges
        ),
        "cell_pairs",
    )
    sure = maybe.filter("sure").select("name", F.col("o_name").alias("b_name"))

    def facing(point: str, box: str) -> Column:
        """A point that lies within eps of the other cell's box."""
        gap = sum(
            F.pow(F.greatest(F.col(f"{box}lo{i}") - F.col(f"{point}{i}"), F.col(f"{point}{i}") - F.col(f"{box}hi{i}"), F.lit(0.0)), 2)
            for i in range(dims)
        )
        return gap <= limit

    def measured(pairs: DataFrame) -> DataFrame:
        key = ["name", "o_name", "part", "o_part"]
        a = only.select("cell", "part", *[F.col(f"x{i}").alias(f"a{i}") for i in range(dims)])
        b = only.select(
            F.col("cell").alias("to"), F.col("part").alias("o_part"), *[F.col(f"x{i}").alias(f"b{i}") for i in range(dims)]
        )
        here = pairs.join(a, ["cell", "part"]).filter(facing("a", "o_")).select(*key, *[f"a{i}" for i in range(dims)])
        there = pairs.join(b, ["to", "o_part"]).filter(facing("b", "")).select(*key, *[f"b{i}" for i in range(dims)])
        hits = here.join(there, key).filter(_within(dims, eps))
        return hits.select("name", F.col("o_name").alias("b_name")).distinct()

    open_pairs = maybe.filter(~F.col("sure")).withColumnRenamed("o_cell", "to")
    first = measured(open_pairs.withColumn("part", F.lit(0).cast("bigint")).withColumn("o_part", F.lit(0).cast("bigint")))
    links = settle(touch.unionByName(sure).unionByName(first), "links")
    found = components(links, "name", "b_name")
    if maybe.filter((F.col("parts") > 1) | (F.col("o_parts") > 1)).limit(1).count():
        comp = found.select(F.col("node").alias("name"), "component")
        still = (
            open_pairs.join(comp, "name", "left")
            .join(comp.select(F.col("name").alias("o_name"), F.col("component").alias("o_comp")), "o_name", "left")
            .filter(~F.coalesce(F.col("component") == F.col("o_comp"), F.lit(False)))
        )
        zero = F.lit(0).cast("bigint")
        spread = still.withColumn("part", F.explode(F.sequence(zero, F.col("parts") - 1))).withColumn(
            "o_part", F.explode(F.sequence(zero, F.col("o_parts") - 1))
        )
        links = settle(links.unionByName(measured(spread)), "links")
        found = components(links, "name", "b_name")

    labels = names.join(found.select(F.col("node").alias("name"), "component"), "name", "left").select(
        "cell", F.coalesce("component", "name").alias("cluster")
    )
    # 4. core points by cell; border points of sparse cells by the cores in reach
    core_out = only.join(labels, "cell").select("id", F.lit(True).alias("is_core"), "cluster")
    rest = core.filter(~F.col("is_core"))
    own = rest.join(labels, "cell").select("id", "cluster")
    b = side_b(only.join(labels, "cell"), "cluster")
    away = side_a(rest).join(routes, "cell").join(b, ["to", "part"]).filter(_within(dims, eps)).select("id", "cluster")
    border = own.unionByName(away).groupBy("id").agg(F.min("cluster").alias("cluster"))
    rest_out = rest.select("id").join(border, "id", "left").select("id", F.lit(False).alias("is_core"), "cluster")
    return core_out.unionByName(rest_out)


def shared_neighbours(hits: DataFrame) -> DataFrame:
    """(q_id, b_id, shared): how many of the k nearest two neighbours share.

    Only pairs where one lists the other are looked at: n times k of them.
    """
    lists = hits.groupBy("q_id").agg(F.collect_list("b_id").alias("near"))  # k ids each
    pairs = hits.select("q_id", "b_id").join(lists, "q_id")
    other = lists.select(F.col("q_id").alias("b_id"), F.col("near").alias("o_near"))
    return pairs.join(other, "b_id").select("q_id", "b_id", F.size(F.array_intersect("near", "o_near")).alias("shared"))


def snn_clusters(hits: DataFrame, ids: DataFrame, min_shared: int, min_pts: int) -> DataFrame:
    """(id, is_core, cluster) by density over shared neighbours.

    A listed neighbour counts when at least ``min_shared`` neighbours are
    shared; a point with ``min_pts`` of them, itself included, is core.  Linked
    cores form a cluster; other points join the smallest core cluster that
    lists them; the rest is noise.
    """
    strong = settle(shared_neighbours(hits).filter(F.col("shared") >= min_shared), "shared")
    degree = strong.groupBy("q_id").agg(F.count("*").alias("n"))
    core = settle(degree.filter(F.col("n") + 1 >= min_pts).select(F.col("q_id").alias("id")), "core")
    from_core = strong.join(core.withColumnRenamed("id", "q_id"), "q_id")
    edges = from_core.join(core.withColumnRenamed("id", "b_id"), "b_id", "left_semi")
    found = components(edges, "q_id", "b_id")
    core_out = core.join(found.withColumnRenamed("node", "id"), "id", "left").select(
        "id", F.coalesce("component", "id").alias("cluster")
    )
    reach = (
        from_core.join(core_out.select(F.col("id").alias("q_id"), "cluster"), "q_id")
        .groupBy(F.col("b_id").alias("id"))
        .agg(F.min("cluster").alias("border"))
    )
    return (
        ids.select("id")
        .join(core_out, "id", "left")
        .join(reach, "id", "left")
        .select("id", F.col("cluster").isNotNull().alias("is_core"), F.coalesce("cluster", "border").alias("cluster"))
    )

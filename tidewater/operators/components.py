"""Connected components of an edge list, by large-star and small-star rounds
(Kiveris et al. 2014).  Every round is grouped minima and joins; the edges of
each round are written to the shared folder, so a lost executor costs a re-read
and the plan never grows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.session import settle

MAX_ROUNDS = 60


def _least_neighbour(arcs: DataFrame) -> DataFrame:
    return arcs.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    arcs = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    m = _least_neighbour(arcs)
    return arcs.filter(F.col("v") > F.col("u")).join(m, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    m = _least_neighbour(down)
    moved = down.join(m, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(m.select("u", F.col("m").alias("v"))).filter(F.col("u") != F.col("v"))


def _is_done(edges: DataFrame) -> bool:
    """Every node points once, and only at nodes that point nowhere."""
    n, nodes = edges.agg(F.count("*"), F.count_distinct("u")).first()
    if n != nodes:
        return False
    roots = edges.select(F.col("v").alias("u")).distinct()
    return edges.join(roots, "u", "left_semi").limit(1).count() == 0


def components(edges: DataFrame, src: str, dst: str) -> DataFrame:
    """(node, component): component is the least node id reached."""
    now = edges.select(F.greatest(src, dst).alias("u"), F.least(src, dst).alias("v"))
    now = settle(now.filter(F.col("u") != F.col("v")).distinct(), "edges")
    for _ in range(MAX_ROUNDS):
        if _is_done(now):
            break
        now = settle(_small_star(_large_star(now)).distinct(), "edges")
    else:
        raise RuntimeError("components did not settle")
    star = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return star.unionByName(roots)

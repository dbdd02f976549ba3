"""Nearest neighbours by largest inner product over vantage-point trees, a tree for each shard.

A base vector x becomes (x, sqrt(M^2 - |x|^2)) with M the largest norm, a query q
becomes (q, 0).  Euclidean distance in that space falls as the inner product
grows, so a metric tree serves the search.  A subtree is skipped when the
triangle inequality keeps it from the neighbours found so far; ``factor`` under
1 shrinks the bound that it must beat and so skips more, factor 1 is exact.

Shards hold a bounded number of rows.  Their trees are written to the shared
folder, then every block of queries walks every tree, and the best of each
(query, shard) meet in two steps of at most a few hundred rows a query each.
Equal vectors of a shard are one point of the tree with the smallest ids.

Vectors that are null, zero, of another length than the most frequent one, or
hold null or non-finite components take no part.  Rows without an id neither.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewater.session import settle

SHARD_ROWS = 8192
BLOCK_ROWS = 1024
LEAF = 64
FACTOR = 0.8
MERGE_FAN = 16


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v): vectors as doubles, the ones that may take part."""
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    rows = rows.filter(F.col("id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = rows.filter(finite & F.exists("v", lambda x: x != 0))
    length = rows.groupBy(F.size("v").alias("n")).agg(F.count("*").alias("c")).orderBy(F.desc("c"), "n").first()
    return rows.filter(F.size("v") == (length.n if length else 0))


# ---- one tree


def build(points: np.ndarray, draw: np.random.Generator) -> list:
    """Nodes as (vantage point, near lo, near hi, far lo, far hi, near, far) or (rows,)."""
    nodes: list = []

    def grow(rows: np.ndarray) -> int:
        at = len(nodes)
        nodes.append(None)
        if len(rows) <= LEAF:
            nodes[at] = (rows,)
            return at
        vantage = int(rows[draw.integers(len(rows))])
        d = np.sqrt(np.maximum(((points[rows] - points[vantage]) ** 2).sum(axis=1), 0))
        order = np.argsort(d, kind="stable")
        half = len(rows) // 2
        if d[order[0]] == d[order[-1]]:
            nodes[at] = (rows,)  # nothing to split by
            return at
        inner, outer = order[:half], order[half:]
        near, far = grow(rows[inner]), grow(rows[outer])
        nodes[at] = (vantage, d[inner[0]], d[inner[-1]], d[outer[0]], d[outer[-1]], near, far)
        return at

    grow(np.arange(len(points)))
    return nodes


def search(points: np.ndarray, nodes: list, queries: np.ndarray, k: int, factor: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows and scores of the k nearest points of each query found, row -1 where there are fewer.

    ``points`` have equal norms.  Equal scores go to the smaller row.
    """
    n = len(queries)
    best_s = np.full((n, k), -np.inf)
    best_i = np.full((n, k), np.iinfo(np.int64).max)
    both = (queries**2).sum(axis=1) + ((points**2).sum(axis=1).max() if len(points) else 0.0)

    def scores(q: np.ndarray, rows: np.ndarray) -> np.ndarray:
        return np.einsum("qd,rd->qr", queries[q], points[rows])

    def distance(q: np.ndarray, score: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(both[q] - 2 * score, 0))

    def visit(at: int, q: np.ndarray) -> None:
        node = nodes[at]
        if len(node) == 1:
            rows = node[0]
            s = np.concatenate([best_s[q], scores(q, rows)], axis=1)
            i = np.concatenate([best_i[q], np.broadcast_to(rows, (len(q), len(rows)))], axis=1)
            pick = np.lexsort((i, -s), axis=1)[:, :k]
            best_s[q] = np.take_along_axis(s, pick, axis=1)
            best_i[q] = np.take_along_axis(i, pick, axis=1)
            return
        vantage, near_lo, near_hi, far_lo, far_hi, near, far = node
        d = distance(q, scores(q, np.array([vantage]))[:, 0])
        gap_near = np.maximum(np.maximum(near_lo - d, d - near_hi), 0)
        gap_far = np.maximum(np.maximum(far_lo - d, d - far_hi), 0)
        inside = gap_near <= gap_far
        for side, gap, rows in ((near, gap_near, inside), (far, gap_far, ~inside), (far, gap_far, inside), (near, gap_near, ~inside)):
            reach = factor * distance(q, best_s[q, -1]) + 1e-9
            go = rows & (gap <= reach)
            if go.any():
                visit(side, q[go])

    if len(points) and n:
        visit(0, np.arange(n))
    return np.where(np.isinf(best_s), -1, best_i), best_s


# ---- shards and blocks


def _tree(key: tuple, frame: pd.DataFrame, most: float, k: int) -> pd.DataFrame:
    v = np.array(frame["v"].tolist(), dtype=np.float64)
    # equal vectors are one point; the k + 1 smallest of their ids may come out
    by_id = np.argsort(frame["id"].to_numpy(), kind="stable")
    v, every = v[by_id], frame["id"].to_numpy()[by_id]
    _, first, of = np.unique(v, axis=0, return_index=True, return_inverse=True)
    # points in the order of their smallest id
    rank = np.argsort(np.argsort(first))
    points, of = v[np.sort(first)], rank[of.ravel()]
    order = np.argsort(of, kind="stable")
    ids = every[order]
    edges = np.searchsorted(of[order], np.arange(len(points) + 1))
    owners = [ids[a : min(b, a + k + 1)] for a, b in zip(edges[:-1], edges[1:], strict=True)]
    lift = np.sqrt(np.maximum(most**2 - (points**2).sum(axis=1), 0))
    lifted = np.column_stack([points, lift])
    nodes = build(lifted, np.random.default_rng(int(key[0])))
    return pd.DataFrame({"shard": [key[0]], "tree": [pickle.dumps((lifted, owners, nodes), protocol=5)]})


def _walk(k: int, factor: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                lifted, owners, nodes = pickle.loads(row["tree"])
                asked = np.array(row["ids"], dtype=np.int64)
                q = np.frombuffer(row["queries"], dtype=np.float64).reshape(len(asked), -1)
                # a query's own row may be among the found ones
                found, found_s = search(lifted, nodes, np.column_stack([q, np.zeros(len(q))]), k + 1, factor)
                out = []
                for i, own in enumerate(asked):
                    rows, score = found[i][found[i] >= 0], found_s[i][found[i] >= 0]
                    ids = [owners[r] for r in rows]
                    scores = np.repeat(score, [len(x) for x in ids])
                    flat = np.concatenate(ids) if ids else np.zeros(0, dtype=np.int64)
                    scores, flat = scores[flat != own], flat[flat != own]
                    top = np.lexsort((flat, -scores))[:k]
                    out.append((np.full(len(top), own), flat[top], scores[top]))
                if out:
                    columns = [np.concatenate(c) for c in zip(*out, strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([row["shard"]] * len(columns[0]), pa.int64()), *map(pa.array, columns)], names=["shard", "query_id", "id", "score"]
                    )

    return run


def _packed(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame.sort_values("id")
    body = np.array(frame["v"].tolist(), dtype=np.float64).tobytes()
    return pd.DataFrame({"block": [frame["block"].iloc[0]], "ids": [frame["id"].tolist()], "queries": [body]})


def nearest(
    vectors: DataFrame,
    is_query: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = 20,
    factor: float = FACTOR,
    shard_rows: int = SHARD_ROWS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """(query_id, rank, id, score) of each query's k nearest rows but its own.

    ``is_query`` is a condition on ``id``.  Fewer than k rows come back only
    where there are fewer candidates.  Ties go to the smaller id.  Rows repeated
    with one id and vector are one row; of rows with one id and other vectors each
    is a candidate and a query of its own.  Columns other than the two named are
    not read; an empty table gives no rows.
    """
    rows = settle(usable(vectors, id_col, vector_col).dropDuplicates(["id", "v"]), "vectors")
    n, norm = rows.agg(F.count("*"), F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))).first()
    queries = rows.filter(is_query)
    n_queries = queries.count()
    shards, blocks = max(1, -(-n // shard_rows)), max(1, -(-n_queries // block_rows))
    most = float(np.sqrt(norm or 0.0)) * (1 + 1e-12)
    sharded = rows.withColumn("shard", F.pmod(F.xxhash64("id"), F.lit(shards)))
    trees = sharded.groupBy("shard").applyInPandas(lambda key, frame: _tree(key, frame, most, k), "shard bigint, tree binary")
    trees = settle(trees, "trees")
    packed = queries.withColumn("block", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(blocks))).groupBy("block")
    packed = settle(packed.applyInPandas(_packed, "block bigint, ids array<bigint>, queries binary"), "blocks")
    # the stated query set meets every shard: a row for each (block, shard)
    meet = trees.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).join(packed, "block")
    meet = meet.repartition(max(1, min(shards * blocks, 4096)), F.xxhash64("shard", "block"))
    found = meet.select("shard", "tree", "ids", "queries").mapInArrow(_walk(k, factor), "shard bigint, query_id bigint, id bigint, score double")
    def nth(*keys: str) -> Column:
        return F.row_number().over(W.partitionBy(*keys).orderBy(F.desc("score"), "id"))

    width = shards
    while width > MERGE_FAN:
        found = found.withColumn("shard", F.floor(F.col("shard") / MERGE_FAN).cast("long"))
        found = found.withColumn("_n", nth("query_id", "shard")).filter(F.col("_n") <= k).drop("_n")
        width = -(-width // MERGE_FAN)
    ranked = found.withColumn("rank", nth("query_id")).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "id", "score")

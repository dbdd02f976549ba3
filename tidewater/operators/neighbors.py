"""Exact nearest neighbours under Euclidean distance.

Few queries: the query block is shipped to the tasks and the base is scanned
once; every task keeps k candidates per query, and only those are shuffled.

Many queries: rows are grouped around pivots and by distance to their pivot.
Pivots grow with the rows, up to eight times their square root, and are grouped around a few
of them themselves, so a row meets two short lists of pivots.  A query is first
compared with its own group; the k-th distance found there is its bound.  By the
triangle inequality it then skips whole families of pivots, and in the others
all groups, that hold nothing nearer than its bound, and visits the rest.  Groups
and their visitors are cut into chunks of bounded size, so a hot group becomes
many tasks.  Both ways are exact; ties go to the smaller id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewater.operators.relational import small
from tidewater.session import settle

QUERY_BYTES = 64 << 20
CHUNK_ROWS = 4096
PIVOT_BYTES = 32 << 20  # pivots are shipped to every task
RINGS = 2
SLICE = 1024
RUN = 2048  # base rows held against a slice of queries

HIT_SCHEMA = "q_id bigint, b_id bigint, dist double"


def _matrix(col: pd.Series) -> np.ndarray:
    return np.asarray(col.tolist(), dtype=float)


def _block_top_k(q_ids, q, b_ids, b, k, exclude_self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """k nearest base rows per query of one block, by (distance, id), a slice of
    queries at a time so that the distance table stays small."""
    parts = [
        _slice_top_k(q_ids[i : i + SLICE], q[i : i + SLICE], b_ids, b, k, exclude_self) for i in range(0, len(q), SLICE)
    ]
    return tuple(np.concatenate(col) for col in zip(*parts))


def _slice_top_k(q_ids, q, b_ids, b, k, exclude_self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Products find who can be among the nearest; the kept pairs are then
    measured directly, so equal rows get equal distances.
    """
    rough = (q * q).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2.0 * (q @ b.T)
    slack = 1e-9 * (1.0 + np.abs(rough).max()) if rough.size else 0.0
    if exclude_self:
        rough[q_ids[:, None] == b_ids[None, :]] = np.inf
    if b.shape[0] > k:
        bound = np.partition(rough, k - 1, axis=1)[:, k - 1] + slack
    else:
        bound = np.full(len(q), np.inf)
    rows, cols = np.nonzero((rough <= bound[:, None]) & np.isfinite(rough))
    dist = np.sqrt(((q[rows] - b[cols]) ** 2).sum(1))
    order = np.lexsort((b_ids[cols], dist, rows))
    rows, cols, dist = rows[order], cols[order], dist[order]
    first = np.searchsorted(rows, rows)
    keep = np.arange(len(rows)) - first < k
    return q_ids[rows[keep]], b_ids[cols[keep]], dist[keep]


def _merge(hits: DataFrame, k: int) -> DataFrame:
    w = W.partitionBy("q_id").orderBy("dist", "b_id")
    return hits.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def knn(
    base: DataFrame,
    queries: DataFrame,
    k: int,
    id_col: str,
    vec_col: str,
    exclude_self: bool = False,
    query_bytes: int = QUERY_BYTES,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """(q_id, b_id, dist, rank) of the k nearest base rows of every query."""
    slim_q = queries.select(F.col(id_col).alias("id"), F.col(vec_col).cast("array<double>").alias("vec"))
    slim_b = base.select(F.col(id_col).alias("id"), F.col(vec_col).cast("array<double>").alias("vec"))
    n, width = slim_q.agg(F.count("*"), F.max(F.size("vec"))).first()
    if n * (width or 1) * 8 <= query_bytes:
        return _merge(_scan(slim_b, slim_q, k, exclude_self), k)
    return _merge(_blocks(slim_b, slim_q, k, exclude_self, chunk_rows), k)


def _scan(base: DataFrame, queries: DataFrame, k: int, exclude_self: bool) -> DataFrame:
    block = queries.toPandas()  # size checked by the caller
    spark = base.sparkSession
    shipped = spark.sparkContext.broadcast((block["id"].to_numpy(), _matrix(block["vec"])))

    def nearest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from _scanned(batches, *shipped.value, k, exclude_self)

    return base.mapInPandas(nearest, HIT_SCHEMA)


def _scanned(batches: Iterator[pd.DataFrame], q_ids: np.ndarray, q: np.ndarray, k: int, exclude_self: bool) -> Iterator[pd.DataFrame]:
    """k nearest of every query among the rows of one task: beside the queries and
    their hits a task only holds what a slice of queries and a run of rows need."""
    best: dict[int, pd.DataFrame] = {}
    for pdf in batches:
        ids, rows = pdf["id"].to_numpy(), _matrix(pdf["vec"])
        for low in range(0, len(rows), RUN):
            b_ids, b = ids[low : low + RUN], rows[low : low + RUN]
            for at in range(0, len(q), SLICE):
                got = _slice_top_k(q_ids[at : at + SLICE], q[at : at + SLICE], b_ids, b, k, exclude_self)
                found = pd.DataFrame(dict(zip(("q_id", "b_id", "dist"), got)))
                found = found if at not in best else pd.concat([best[at], found])
                best[at] = found.sort_values(["q_id", "dist", "b_id"]).groupby("q_id").head(k)
    yield from best.values()


class PivotTree:
    """Pivots in families around a few of them.  What is shipped is the pivots and their families, as arrays."""

    def __init__(self, pivots: np.ndarray, family: np.ndarray | None = None) -> None:
        self.pivots = pivots
        self.heads = pivots[: max(1, int(np.ceil(np.sqrt(len(pivots)))))]
        if family is None:
            family = np.concatenate([_distances(pivots[i : i + SLICE], self.heads).argmin(1) for i in range(0, len(pivots), SLICE)])
        self.family = family
        self.members = [np.nonzero(family == f)[0] for f in range(len(self.heads))]

    def place(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(pivot, distance to it, distance to its family's head): nearest head first, then nearest in its family."""
        to_heads = _distances(x, self.heads)
        family = to_heads.argmin(1)
        cell, r = np.zeros(len(x), dtype=int), np.zeros(len(x))
        for f in np.unique(family):
            rows = np.nonzero(family == f)[0]
            d = _distances(x[rows], self.pivots[self.members[f]])
            best = d.argmin(1)
            cell[rows], r[rows] = self.members[f][best], d[np.arange(len(rows)), best]
        return cell, r, to_heads[np.arange(len(x)), family]


def _distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.stack([np.sqrt(((x - p) ** 2).sum(1)) for p in y], axis=1) if len(y) else np.zeros((len(x), 0))


def pivot_tree(base: DataFrame, n: int, width: int, chunk_rows: int) -> PivotTree:
    """Groups of about half a chunk, as long as the pivots stay below eight times the square root of the rows."""
    wanted = min(int(np.ceil(8 * np.sqrt(n))), max(1, 2 * n // (chunk_rows * RINGS)), max(1, PIVOT_BYTES // (8 * max(1, width))))
    return PivotTree(_matrix(base.orderBy(F.xxhash64("id"), "id").limit(max(1, wanted)).toPandas()["vec"]))


def _assign(df: DataFrame, tree, radii: np.ndarray | None) -> DataFrame:
    """Pivot, distances to it and to its head, and the ring that the first distance falls in."""

    def near(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pivots = PivotTree(*tree.value)
        for pdf in batches:
            if len(pdf) == 0:
                continue
            cell, r, far = pivots.place(_matrix(pdf["vec"]))
            ring = np.zeros(len(pdf), dtype=int)
            if radii is not None:
                top = np.maximum(radii[cell], 1e-300)
                ring = np.minimum((r / top * RINGS).astype(int), RINGS - 1)
            yield pdf.assign(cell=cell, r=r, far=far, grp=cell * RINGS + ring)

    return df.mapInPandas(near, "id bigint, vec array<double>, cell int, r double, far double, grp int")


def _surely(x: np.ndarray, need: int, t: PivotTree, groups: dict, of: list[np.ndarray], reach: np.ndarray) -> float:
    """A distance within which one row surely has ``need`` rows, from families in the order they come near."""
    to_heads = _distances(x[None, :], t.heads)[0]
    far, n = np.zeros(0), np.zeros(0, dtype=int)
    for f in np.argsort(to_heads, kind="stable"):
        if len(of[f]):
            far = np.append(far, _distances(x[None, :], t.pivots[groups["pivot"][of[f]]])[0] + groups["hi"][of[f]])
            n = np.append(n, groups["n"][of[f]])
        if n.sum() >= need:
            by = np.argsort(far, kind="stable")
            return float(far[by][np.searchsorted(np.cumsum(n[by]), need)])
    return np.inf


def _visits(known: DataFrame, gb: pd.DataFrame, tree, reach: np.ndarray, need: int) -> DataFrame:
    """(grp, part, id, vec): the parts of groups that may hold something nearer than a query's bound."""
    gb = gb.assign(pivot=gb["grp"] // RINGS).sort_values("grp")
    shipped = known.sparkSession.sparkContext.broadcast({c: gb[c].to_numpy() for c in ("grp", "pivot", "n", "lo", "hi", "parts")})

    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        t, b = PivotTree(*tree.value), shipped.value
        family = t.family[b["pivot"]]
        of = [np.nonzero(family == f)[0] for f in range(len(t.heads))]
        for pdf in batches:
            if len(pdf) == 0:
                continue
            x, theta = _matrix(pdf["vec"]), pdf["bound"].fillna(np.inf).to_numpy(dtype=float)
            for i in np.nonzero(np.isinf(theta))[0]:
                theta[i] = _surely(x[i], need, t, b, of, reach)
            theta = theta * (1 + 1e-9) + 1e-9
            to_heads = _distances(x, t.heads)
            own, part = pdf["grp"].to_numpy(), pdf["part"].to_numpy()
            for f, groups in enumerate(of):
                rows = np.nonzero(to_heads[:, f] - reach[f] <= theta)[0] if len(groups) else groups
                if not len(rows):
                    continue
                d = _distances(x[rows], t.pivots[b["pivot"][groups]])
                least = np.maximum(d - b["hi"][groups], b["lo"][groups] - d)
                at, g = np.nonzero(least <= theta[rows][:, None])
                at, g = rows[at], groups[g]
                times = b["parts"][g]
                at, g = np.repeat(at, times), np.repeat(g, times)
                nth = np.arange(len(at)) - np.repeat(np.cumsum(times) - times, times)
                new = ~((own[at] == b["grp"][g]) & (part[at] == nth))
                at, g, nth = at[new], g[new], nth[new]
                yield pd.DataFrame({"grp": b["grp"][g], "part": nth, "id": pdf["id"].to_numpy()[at], "vec": pdf["vec"].to_numpy()[at]})

    return known.select("id", "vec", "grp", "part", "bound").mapInPandas(look, "grp int, part int, id bigint, vec array<double>")


def _searched(base: DataFrame, queries: DataFrame, k: int, exclude_self: bool, chunk_rows: int):
    """Base rows with group and part; the queries in their own part; their hits there; the visits left to make."""
    spark = base.sparkSession
    n, width = base.agg(F.count("*"), F.max(F.size("vec"))).first()
    if not n:
        return None
    pivots = pivot_tree(base, n, width, chunk_rows)
    tree = spark.sparkContext.broadcast((pivots.pivots, pivots.family))
    both = base.select("id", "vec").unionByName(queries.select("id", "vec"))
    radii = np.zeros(len(pivots.pivots))
    for cell, r in _assign(both, tree, None).groupBy("cell").agg(F.max("r")).collect():  # a row for each pivot
        radii[cell] = r
    placed = settle(_assign(base, tree, radii), "base")
    gb = placed.groupBy("grp").agg(F.count("*").alias("n"), F.min("r").alias("lo"), F.max("r").alias("hi"), F.max("far").alias("far")).toPandas()
    gb["parts"] = -(-gb["n"] // chunk_rows)
    reach = np.full(len(pivots.heads), -np.inf)
    np.maximum.at(reach, pivots.family[(gb["grp"] // RINGS).to_numpy()], gb["far"].to_numpy())
    plan = spark.createDataFrame(gb[["grp", "parts"]].astype("int32"))  # a row for each group

    def numbered(rows: DataFrame, how: str) -> DataFrame:
        part = F.coalesce(F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"), F.lit(-1))
        return rows.select("grp", "id", "vec").join(F.broadcast(plan), "grp", how).select("grp", part.alias("part"), "id", "vec")

    hosts, guests = numbered(placed, "inner"), settle(numbered(_assign(queries, tree, radii), "left"), "queries")
    own = settle(_met(guests, hosts, k, exclude_self, chunk_rows), "own")
    bound = own.groupBy("q_id").agg(F.when(F.count("*") >= k, F.max("dist")).alias("bound"))
    known = guests.join(bound.withColumnRenamed("q_id", "id"), "id", "left")
    visits = settle(_visits(known, gb, tree, reach, k + (1 if exclude_self else 0)), "visits")
    return hosts, guests, own, visits


def _met(guests: DataFrame, hosts: DataFrame, k: int, exclude_self: bool, chunk_rows: int) -> DataFrame:
    """k nearest of each guest among the hosts of its part; many guests of a part are met block by block."""
    crowd = settle(guests.groupBy("grp", "part").agg(F.ceil(F.count("*") / F.lit(chunk_rows)).cast("int").alias("blocks")), "crowd")
    task, cols = ["grp", "part", "block"], ["grp", "part", "block", "id", "vec"]
    left = guests.join(small(crowd), ["grp", "part"]).withColumn("block", F.pmod(F.xxhash64("id", F.lit(1)), F.col("blocks")).cast("int"))
    right = hosts.join(small(crowd), ["grp", "part"]).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))

    def nearest(q: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if len(q) == 0 or len(b) == 0:
            return pd.DataFrame({"q_id": [], "b_id": [], "dist": []})
        got = _block_top_k(q["id"].to_numpy(), _matrix(q["vec"]), b["id"].to_numpy(), _matrix(b["vec"]), k, exclude_self)
        return pd.DataFrame(dict(zip(("q_id", "b_id", "dist"), got)))

    return left.select(*cols).groupBy(*task).cogroup(right.select(*cols).groupBy(*task)).applyInPandas(nearest, HIT_SCHEMA)


def distance_count(base: DataFrame, queries: DataFrame, k: int, id_col: str, vec_col: str, exclude_self: bool = False, chunk_rows: int = CHUNK_ROWS) -> int:
    """How many distances between rows the search for many queries measures."""
    slim = [d.select(F.col(id_col).alias("id"), F.col(vec_col).cast("array<double>").alias("vec")) for d in (base, queries)]
    found = _searched(*slim, k, exclude_self, chunk_rows)
    if found is None:
        return 0
    hosts, guests, _, visits = found
    size = lambda rows, name: rows.groupBy("grp", "part").agg(F.count("*").alias(name))
    both = size(guests.unionByName(visits), "q").join(size(hosts, "b"), ["grp", "part"])
    return int(both.agg(F.sum(F.col("q") * F.col("b"))).first()[0] or 0)


def _blocks(base: DataFrame, queries: DataFrame, k: int, exclude_self: bool, chunk_rows: int) -> DataFrame:
    found = _searched(base, queries, k, exclude_self, chunk_rows)
    if found is None:
        return base.sparkSession.createDataFrame([], HIT_SCHEMA)
    hosts, _, own, visits = found
    return own.unionByName(_met(visits, hosts, k, exclude_self, chunk_rows))


def vote(hits: DataFrame, labels: DataFrame, id_col: str, label_col: str, k: int | None = None) -> DataFrame:
    """(q_id, predicted): majority label of the neighbours.

    A tied vote goes to the label whose neighbours are nearer in sum, then to
    the smaller label.
    """
    near = hits if k is None else hits.filter(F.col("rank") <= k)
    named = near.join(
        labels.select(F.col(id_col).alias("b_id"), F.col(label_col).alias("label")), "b_id"
    )
    tally = named.groupBy("q_id", "label").agg(F.count("*").alias("n"), F.round(F.sum("dist"), 9).alias("far"))
    return tally.groupBy("q_id").agg(
        F.min_by("label", F.struct(-F.col("n"), F.col("far"), F.col("label"))).alias("predicted")
    )


def vote_grid(hits: DataFrame, labels: DataFrame, id_col: str, label_col: str, k_max: int) -> DataFrame:
    """Votes for every k in 1..k_max from one neighbour list per query."""
    ks = F.sequence(F.col("rank"), F.lit(k_max))
    named = hits.filter(F.col("rank") <= k_max).join(
        labels.select(F.col(id_col).alias("b_id"), F.col(label_col).alias("label")), "b_id"
    )
    tally = (
        named.withColumn("k", F.explode(ks))
        .groupBy("q_id", "k", "label")
        .agg(F.count("*").alias("n"), F.round(F.sum("dist"), 9).alias("far"))
    )
    return tally.groupBy("q_id", "k").agg(
        F.min_by("label", F.struct(-F.col("n"), F.col("far"), F.col("label"))).alias("predicted")
    )

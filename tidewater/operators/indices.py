"""Indices that judge the number of clusters, and their vote.

All k are judged together.  One scan with the centres of every k gives, for each
cluster, its rows, sum, scatter matrix and distances to the centre; a second one
gives the silhouettes, which need those sums.  Both bring back one row for each k
and task, added up by k; the indices follow from these sums alone.

Definitions as collected by Charrad et al. (2014); determinants are taken
relative to that of the total scatter, which no vote can see.  The silhouette is
the one of squared distances.  Ties between values of k go to the smaller one.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidewater.operators.lloyd import best, fit_many, matrix, vectors

ROWS = 4096
# How an index picks k: its largest or smallest value, the largest step to the
# value before, the largest or smallest second difference.
VOTES = {
    "kl": "max", "calinski_harabasz": "max", "hartigan": "step", "ccc": "max", "scott": "step", "marriot": "max_bend",
    "trcovw": "step", "tracew": "max_bend", "friedman": "step", "rubin": "min_bend", "ratkowsky": "max", "ball": "step",
    "davies_bouldin": "min", "silhouette": "max", "sd": "min", "dindex": "max_bend",
}


def _folded(rows: DataFrame, job, spark) -> dict[int, list[np.ndarray]]:
    """Arrays of each k, added up over the tasks."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            for k, parts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                arrays = [np.frombuffer(p) for p in parts]
                total[k] = [a + b for a, b in zip(total[k], arrays, strict=True)] if k in total else arrays
        yield packed(total)

    def packed(total: dict[int, list[np.ndarray]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.int32()), pa.array([[a.astype(float).tobytes() for a in parts] for parts in total.values()], pa.list_(pa.binary()))], names=["k", "parts"]
        )

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield packed(job(batches))

    schema = "k int, parts array<binary>"
    slots = spark.sparkContext.defaultParallelism
    found = rows.mapInArrow(tally, schema).repartition(slots, "k").mapInArrow(add, schema).collect()
    return {r.k: [np.frombuffer(p) for p in r.parts] for r in found}


def scatters(rows: DataFrame, width: int, centres: dict[int, np.ndarray]) -> dict[int, dict[str, np.ndarray]]:
    """k -> rows, means, scatter matrices and summed distances of its clusters."""
    spark = rows.sparkSession
    shipped = spark.sparkContext.broadcast(centres)

    def job(batches: Iterator[pa.RecordBatch]) -> dict[int, list[np.ndarray]]:
        total = {k: [np.zeros(k), np.zeros((k, width)), np.zeros((k, width, width)), np.zeros(k)] for k in shipped.value}
        for batch in batches:
            x = matrix(batch.column(0), width)
            for at in range(0, len(x), ROWS):
                part = x[at : at + ROWS]
                for k, c in shipped.value.items():
                    near = ((part * part).sum(1)[:, None] + (c * c).sum(1)[None, :] - 2.0 * part @ c.T).argmin(1)
                    off = part - c[near]
                    for j in range(k):
                        mine = off[near == j]
                        total[k][0][j] += len(mine)
                        total[k][1][j] += mine.sum(0)
                        total[k][2][j] += mine.T @ mine
                        total[k][3][j] += np.sqrt((mine * mine).sum(1)).sum()
        return total

    out = {}
    for k, (n, off, square, far) in _folded(rows, job, spark).items():
        off, square = off.reshape(k, width), square.reshape(k, width, width)
        shift = off / np.maximum(n, 1)[:, None]
        out[k] = {"n": n, "mean": centres[k] + shift, "scatter": square - n[:, None, None] * shift[:, :, None] * shift[:, None, :], "far": far}
    return out


def silhouettes(rows: DataFrame, width: int, centres: dict[int, np.ndarray], stats: dict[int, dict]) -> dict[int, float]:
    """Mean silhouette of squared distances for every k, from the clusters' sums."""
    spark = rows.sparkSession
    spread = {k: (np.trace(s["scatter"], axis1=1, axis2=2) / np.maximum(s["n"], 1), s["mean"], s["n"]) for k, s in stats.items()}
    shipped = spark.sparkContext.broadcast((centres, spread))

    def job(batches: Iterator[pa.RecordBatch]) -> dict[int, list[np.ndarray]]:
        firsts, sums = shipped.value
        total = {k: [np.zeros(2)] for k in firsts}
        for batch in batches:
            x = matrix(batch.column(0), width)
            for at in range(0, len(x), ROWS):
                part = x[at : at + ROWS]
                for k, c in firsts.items():
                    inner, mean, n = sums[k]
                    near = ((part * part).sum(1)[:, None] + (c * c).sum(1)[None, :] - 2.0 * part @ c.T).argmin(1)
                    apart = np.maximum((part * part).sum(1)[:, None] + (mean * mean).sum(1)[None, :] - 2.0 * part @ mean.T, 0) + inner[None, :]
                    at_home = np.arange(len(part)), near
                    alone = n[near] <= 1
                    own = apart[at_home] * n[near] / np.maximum(n[near] - 1, 1)
                    apart[at_home] = np.inf
                    apart[:, n == 0] = np.inf
                    other = apart.min(1)
                    value = np.where(alone | ~np.isfinite(other), 0.0, (other - own) / np.maximum(np.maximum(own, other), 1e-300))
                    total[k][0] += (value.sum(), len(part))
        return total

    return {k: float(s[0] / s[1]) if s[1] else 0.0 for k, (s,) in _folded(rows, job, spark).items()}


def cubic_criterion(within: np.ndarray, total: np.ndarray, n: float, k: int) -> float:
    """Cubic clustering criterion (Sarle 1983) from the scatter matrices."""
    root = np.sqrt(np.maximum(np.sort(np.linalg.eigvalsh(total / (n - 1)))[::-1], 1e-300))
    dims = 1
    for p in range(min(len(root), k - 1), 0, -1):
        side = np.exp((np.log(root[:p]).sum() - np.log(k)) / p)
        if root[p - 1] / side >= 1:
            dims = p
            break
    u = root / np.exp((np.log(root[:dims]).sum() - np.log(k)) / dims)
    left = (1 / (n + u[:dims])).sum() + (u[dims:] ** 2 / (n + u[dims:])).sum()
    expected = 1 - left / (u**2).sum() * ((n - k) ** 2 / n) * (1 + 4 / n)
    seen = 1 - np.trace(within) / np.trace(total)
    return float(np.log((1 - expected) / (1 - seen)) * np.sqrt(n * dims / 2) / (0.001 + expected) ** 1.2)


def index_values(stats: dict[int, dict], silhouette: dict[int, float], ks: Sequence[int]) -> dict[str, dict[int, float]]:
    """index -> k -> value; stats hold one k more on either side, for the differences."""
    within = {k: s["scatter"].sum(0) for k, s in stats.items()}
    n = float(next(iter(stats.values()))["n"].sum())
    grand = {k: (s["n"][:, None] * s["mean"]).sum(0) / n for k, s in stats.items()}
    between = {k: ((s["mean"] - grand[k]).T * s["n"]) @ (s["mean"] - grand[k]) for k, s in stats.items()}
    some = min(stats)
    total = within[some] + between[some]
    width = len(total)
    trace = {k: float(np.trace(w)) for k, w in within.items()}
    whole = np.linalg.slogdet(total)[1]
    # log of |W| / |T|
    share = {k: float(np.linalg.slogdet(w)[1] - whole) for k, w in within.items()}
    change = {k: (k - 1) ** (2 / width) * trace[k - 1] - k ** (2 / width) * trace[k] for k in stats if k - 1 in stats}
    variance = {k: np.linalg.norm(np.diagonal(s["scatter"], axis1=1, axis2=2) / np.maximum(s["n"], 1)[:, None], axis=1) for k, s in stats.items()}
    out: dict[str, dict[int, float]] = {name: {} for name in VOTES}
    apart = {}
    for k in ks:
        s = stats[k]
        gaps = np.sqrt(((s["mean"][:, None, :] - s["mean"][None, :, :]) ** 2).sum(2))
        off = ~np.eye(k, dtype=bool)
        radius = np.sqrt(np.trace(s["scatter"], axis1=1, axis2=2) / np.maximum(s["n"], 1))
        worst = np.where(off, (radius[:, None] + radius[None, :]) / np.where(off & (gaps > 0), gaps, np.inf), 0).max(1)
        apart[k] = float(gaps[off].max() / gaps[off].min() * (1 / np.where(off, gaps, 0).sum(1)).sum()) if gaps[off].min() > 0 else np.inf
        out["kl"][k] = abs(change[k] / change[k + 1]) if change[k + 1] else np.inf
        out["calinski_harabasz"][k] = float(np.trace(between[k]) / (k - 1) / (trace[k] / (n - k)))
        out["ccc"][k] = cubic_criterion(within[k], total, n, k)
        out["ratkowsky"][k] = float(np.mean(np.sqrt(np.diag(between[k]) / np.diag(total))) / np.sqrt(k))
        out["davies_bouldin"][k] = float(worst.mean())
        out["silhouette"][k] = silhouette[k]
    base = float(np.linalg.norm(np.diag(total) / n))
    for k in ks:
        out["sd"][k] = float(apart[max(ks)] * variance[k].mean() / base + apart[k])
    for k in stats:
        s = stats[k]
        out["hartigan"][k] = (trace[k] / trace[k + 1] - 1) * (n - k - 1) if k + 1 in stats else np.nan
        out["scott"][k] = -n * share[k]
        out["marriot"][k] = k * k * float(np.exp(share[k]))
        pooled = within[k] / (n - k)
        out["trcovw"][k] = float((pooled * pooled).sum())
        out["tracew"][k] = trace[k]
        out["friedman"][k] = float(np.trace(np.linalg.solve(within[k], between[k])))
        out["rubin"][k] = float(np.exp(-share[k]))
        out["ball"][k] = trace[k] / k
        out["dindex"][k] = float((s["far"] / np.maximum(s["n"], 1)).mean())
    return out


def voted(values: dict[int, float], ks: Sequence[int], rule: str) -> int:
    """The k that an index picks; the smallest of equal ones."""

    def score(k: int) -> float:
        if rule in ("max", "min"):
            return values[k] if rule == "max" else -values[k]
        if rule == "step":
            return abs(values[k] - values[k - 1])
        bend = (values[k + 1] - values[k]) - (values[k] - values[k - 1])
        return bend if rule == "max_bend" else -bend

    return min(ks, key=lambda k: (-score(k), k))


def cluster_indices(df: DataFrame, vec: str, ks: Sequence[int], starts: int = 25, iterations: int = 100, seed: int = 1) -> DataFrame:
    """One row for each k: sixteen indices and how many of them vote for it.

    ``ks`` are consecutive and start at 2 or above; models of one k more on
    either side are fitted as well, for the indices that look at differences.
    """
    ks = list(ks)
    models = best(fit_many(df, vec, range(ks[0] - 1, ks[-1] + 2), starts, iterations, seed))
    names = list(VOTES)
    schema = "k int, " + ", ".join(f"{name} double" for name in names) + ", votes int"
    if not models:
        return df.sparkSession.createDataFrame([], schema)
    rows, _, width = vectors(df, vec)
    centres = {k: m.centres for k, m in models.items()}
    stats = scatters(rows, width, centres)
    values = index_values(stats, silhouettes(rows, width, centres, stats), ks)
    picks = [voted(values[name], ks, VOTES[name]) for name in names]
    out = [(k, *[float(values[name][k]) for name in names], picks.count(k)) for k in ks]
    return df.sparkSession.createDataFrame(out, schema)

"""Centroid clustering by weighted deduplication: equal quantised vectors are one, with their number as its weight.

Lloyd's rounds run over the distinct vectors only, by numpy within tasks. A task sends out, per centroid, integer sums of its
vectors times their weights, so that means are exact in whatever order they are added up; the driver gets the centroids alone.
Assignments are then joined back to the rows: rows of very common vectors (at most `MOST_COMMON`, each a thousandth of all rows or
more) against a small table of those, all others by a join on their vectors.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, saved

SCALE, COMPONENTS, CENTROIDS, ROUNDS, SALT = 1024, 64, 8, 10, "3:"
#: Components beyond have squared distances that don't fit a long.
LIMIT = 1 << 27
#: A vector that this part of all rows share is common; there can't be more of them than this.
MOST_COMMON = 1000
#: Below, sums of products of components are exact as doubles.
_EXACT = 1 << 22


def quantised(vector: Column, components: int = COMPONENTS, scale: int = SCALE) -> Column:
    """floor(scale * x) of each component, x as double; null unless there are exactly `components`, none null or not finite."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    wide = F.raise_error(F.lit(f"a component beyond {LIMIT} / {scale} in size")).cast("int")
    whole = lambda x: F.floor(x.cast("double") * scale)
    fits = lambda x: F.when(F.abs(x.cast("double") * scale) < LIMIT, whole(x).cast("int")).otherwise(wide)
    return F.when((F.size(vector) == components) & ~odd, F.transform(vector, fits))


def _matrix(column: pa.Array, components: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, components).astype(np.int64)


def nearest(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number, squared distance) of each vector's nearest centroid; of equally near ones the smaller number. Exact."""
    if not len(vectors):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    if max(np.abs(vectors).max(), np.abs(centroids).max()) < _EXACT:
        v, c = vectors.astype(np.float64), centroids.astype(np.float64)
        d = ((v * v).sum(1)[:, None] - 2 * (v @ c.T) + (c * c).sum(1)[None, :]).astype(np.int64)
    else:
        d = np.stack([((vectors - c) ** 2).sum(1) for c in centroids], 1)
    best = d.argmin(1)
    return best, d[np.arange(len(d)), best]


def _weighted_means(distinct: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Each centroid's floor of its vectors' mean, by weight; one without vectors stays."""
    k, components = centroids.shape

    def run(batches):
        sums, weights = [[0] * components for _ in range(k)], [0] * k
        for batch in batches:
            v, n = _matrix(batch.column(0), components), batch.column(1).to_numpy()
            best, _ = nearest(v, centroids)
            # a batch's weights times components stay within a long while weights are below 2**31 or so; else by Python's integers
            small = len(n) and int(n.sum()) < 1 << 35
            for c in np.unique(best).tolist():
                own = best == c
                part = (v[own] * n[own, None]).sum(0).tolist() if small else (v[own].astype(object) * n[own, None].astype(object)).sum(0).tolist()
                sums[c] = [a + b for a, b in zip(sums[c], part, strict=True)]
                weights[c] += int(n[own].sum())
        rows = [(c, i, str(x), weights[c]) for c in range(k) if weights[c] for i, x in enumerate(sums[c])]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), (pa.int32(), pa.int32(), pa.string(), pa.int64()), strict=True)], names=["c", "i", "s", "n"])

    parts = distinct.mapInArrow(run, "c int, i int, s string, n long")
    out = centroids.copy()
    for c, i, s, n in parts.groupBy("c", "i").agg(F.sum(F.col("s").cast("decimal(38,0)")), F.sum("n")).collect():
        out[c, i] = int(s) // n
    return out


def clustered(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS, scale: int = SCALE, k: int = CENTROIDS, rounds: int = ROUNDS, salt: str = SALT) -> DataFrame:
    """The rows of `vectors` that count, without their vector, with cluster, distance (squared), cluster_inertia, inertia and
    centroid_sha256; columns of those names are replaced.

    A vector counts if it has exactly `components` components, none null or not finite; others go. Rows with a null id count, but
    are never a start. Starts are the k rows of least sha256 of salt and id, of equal ones those with the lesser vector; fewer
    rows give fewer centroids. Repeated rows count as often as they are there. An empty table, or one where no vector counts, gives
    no rows. A component of LIMIT / scale or more in size stops the query, as its distances don't fit a long."""
    new = ["cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    keep = [c for c in vectors.columns if c != vector and c.lower() not in new]
    v, n = fresh(vectors.select(*[F.col(f"`{c}`") for c in keep]), "v", "n")
    rows = vectors.select(*[F.col(f"`{c}`") for c in keep], quantised(F.col(f"`{vector}`"), components, scale).alias(v)).filter(F.col(v).isNotNull())
    distinct = saved(rows.groupBy(v).agg(F.count("*").alias(n)), "vectors")

    start = rows.filter(F.col(f"`{vec_id}`").isNotNull()).select(F.sha2(F.concat(F.lit(salt), F.col(f"`{vec_id}`").cast("string")), 256).alias("h"), v)
    starts = [r[1] for r in start.orderBy("h", v).limit(k).collect()]
    if not starts:
        starts = [r[0] for r in distinct.select(v).orderBy(v).limit(k).collect()]
    centroids = np.array(starts, np.int64).reshape(-1, components)
    for _ in range(rounds if len(centroids) else 0):
        moved = _weighted_means(distinct, centroids)
        if (moved == centroids).all():  # every further round gives the same
            break
        centroids = moved

    def run(batches):
        for batch in batches:
            best, distance = nearest(_matrix(batch.column(0), components), centroids)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(best.astype(np.int32)), pa.array(distance)], names=[v, n, "cluster", "distance"])

    assigned = saved(distinct.mapInArrow(run, f"`{v}` array<int>, `{n}` long, cluster int, distance long"), "assigned")
    inertia = {c: (int(x), int(m)) for c, x, m in assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)") * F.col(n)), F.sum(n)).collect()}
    total, count = sum(x for x, _ in inertia.values()), sum(m for _, m in inertia.values())
    common = (F.col(n) > 1) & (F.col(n) * MOST_COMMON >= count)
    # common vectors are at most MOST_COMMON, so they can be everywhere; the rest have fewer rows than a thousandth of all each
    few = assigned.filter(common).select(v, "cluster", "distance")
    rest = assigned.filter(~common).select(v, "cluster", "distance")
    out = rows.join(F.broadcast(few), v).unionByName(rows.join(F.broadcast(few.select(v)), v, "left_anti").join(rest, v))
    by_cluster = lambda value, default: reduce(lambda a, c: a.when(F.col("cluster") == c, value(c)), inertia, F.when(F.lit(False), default))
    sha = F.sha2(F.element_at(F.array(*[F.lit(",".join(map(str, c))) for c in centroids.tolist()] or [F.lit("")]), F.col("cluster") + 1), 256)
    return out.select(
        *[F.col(f"`{c}`") for c in keep],
        "cluster",
        "distance",
        by_cluster(lambda c: F.lit(inertia[c][0]).cast("long"), F.lit(0).cast("long")).alias("cluster_inertia"),
        F.lit(total).cast("long").alias("inertia"),
        sha.alias("centroid_sha256"),
    )

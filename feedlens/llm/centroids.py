"""k-means over integer vectors, with candidates filtered in PCA-rotated coordinates.

1. Vectors of exactly ``dims`` finite components become integers, floor(``scale`` * x).  They are
   written once, with a rotation of theirs: the first ``LEAD`` coordinates along the principal
   axes of the scatter matrix of all vectors (summed in Spark, d * d numbers), and the norm of
   what the other axes hold.
2. Centroids are rotated the same way.  The squared distance of the leading coordinates plus
   the squared difference of the residual norms never exceeds the squared distance, so a
   centroid whose bound lies above an exact distance already found cannot be nearer.
3. The centroid with the least bound is measured in integers, then every other one whose bound
   (less a margin far above the rounding of the floating-point part) does not exceed the best
   distance so far.  All decisions between centroids fall in integers, so the rotation
   never changes a result.
4. A round is one job: each task adds up its vectors by cluster, and k rows a task are
   shuffled.  A cluster that holds a third of all vectors is k rows of sums like any other.
   The driver holds k * ``dims`` integers; rounds end early once no centroid moves, since all
   later ones would repeat the last.

Defined results: vectors that are null, of another size, or with a null or non-finite component
are left out; a component beyond ``LIMIT`` after scaling is an error, as 64 bits could not hold
exact distances; a null id is hashed as the text ``null``; rows with equal ids are vectors of their
own, equal ids among the starts come in the order of their components; with fewer vectors than
``k`` there are as many clusters as vectors; an empty table gives no rows; other columns are
never read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved

LEAD = 16
LIMIT = 1 << 27
MARGIN = 1e-6                   # of the squared norms; rounding of the bounds stays far below


def integers(vectors: DataFrame, id_col: str, vector_col: str, dims: int, scale: int) -> DataFrame:
    """(id, v) of the vectors that are kept, ``v`` as floor(scale * x)."""
    x = F.col(vector_col)
    fine = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))
    ok = x.isNotNull() & (F.size(x) == dims) & F.forall(x, lambda c: fine(c.cast("double")))
    return vectors.where(F.coalesce(ok, F.lit(False))).select(
        F.col(id_col).alias("id"), F.transform(x, lambda c: F.floor(c.cast("double") * scale).cast("long")).alias("v"))


def _matrix(column, kind, width: int) -> np.ndarray:
    return np.asarray(column.flatten()).astype(kind, copy=False).reshape(-1, width)


def scatter(points: DataFrame, dims: int) -> tuple[int, np.ndarray, np.ndarray]:
    """(number, mean, scatter matrix) of all points; raises if a component is too large."""
    def run(batches):
        n, most, one, two = 0, 0, np.zeros(dims), np.zeros((dims, dims))
        for batch in batches:
            v = _matrix(batch.column("v"), np.float64, dims)
            if len(v):
                n, most = n + len(v), max(most, min(int(np.abs(v).max()), 1 << 62))
                one += v.sum(0)
                two += v.T @ v
        yield pa.RecordBatch.from_pydict({"n": [n], "most": [most], "sums": [[*one, *two.ravel()]]})
    parts = points.select("v").mapInArrow(run, "n long, most long, sums array<double>")
    total = parts.agg(F.sum("n").alias("n"), F.max("most").alias("most")).first()
    if (total.most or 0) > LIMIT:
        raise ValueError(f"a scaled component of {total.most} is beyond {LIMIT}; distances would not fit in 64 bits")
    sums = np.zeros(dims + dims * dims)
    for r in parts.select(F.posexplode("sums")).groupBy("pos").agg(F.sum("col").alias("s")).collect():
        sums[r.pos] = r.s                           # dims + dims * dims rows
    mean = sums[:dims] / max(total.n or 0, 1)
    return total.n or 0, mean, sums[dims:].reshape(dims, dims) - (total.n or 0) * np.outer(mean, mean)


class Rotation:
    """Leading coordinates along the principal axes, and the norm of the rest."""

    def __init__(self, mean: np.ndarray, spread: np.ndarray, lead: int):
        _, axes = np.linalg.eigh(spread)
        self.mean, self.axes = mean, np.ascontiguousarray(axes[:, ::-1][:, :lead])

    def __call__(self, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        x = v - self.mean
        lead = x @ self.axes
        rest = np.einsum("ij,ij->i", x, x) - np.einsum("ij,ij->i", lead, lead)
        return lead, np.sqrt(np.maximum(rest, 0))


def rotated(points: DataFrame, rotation: Rotation, dims: int) -> DataFrame:
    """``points`` (id, v) plus ``lead`` and ``rest``; ``v`` in 32 bits."""
    def run(batches):
        for batch in batches:
            v = _matrix(batch.column("v"), np.int64, dims)
            lead, rest = rotation(v)
            wide = lambda a, kind: pa.ListArray.from_arrays(
                pa.array(np.arange(len(a) + 1) * a.shape[1], pa.int32()), pa.array(a.ravel(), kind))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), wide(v, pa.int32()), wide(lead, pa.float64()), pa.array(rest)], names=["id", "v", "lead", "rest"])
    kind = points.schema["id"].dataType.simpleString()
    return points.select("id", "v").mapInArrow(run, f"id {kind}, v array<int>, lead array<double>, rest double")


def nearest(v: np.ndarray, lead: np.ndarray, rest: np.ndarray, centroids: np.ndarray,
            rotation: Rotation) -> tuple[np.ndarray, np.ndarray]:
    """(number of the nearest centroid, squared distance), exact; ties go to the smaller number."""
    c_lead, c_rest = rotation(centroids)
    size = lambda a, r: np.einsum("ij,ij->i", a, a) + r * r
    slack = MARGIN * (size(lead, rest)[:, None] + size(c_lead, c_rest)) + 1
    bound = np.stack([np.square(lead - c).sum(1) for c in c_lead], 1) + np.square(rest[:, None] - c_rest) - slack
    exact = lambda rows, c: np.square(v[rows] - c).sum(1)
    first = bound.argmin(1)
    label, best = first.copy(), exact(slice(None), centroids[first])
    for k in range(len(centroids)):
        rows = np.flatnonzero((bound[:, k] <= best) & (first != k))
        got = exact(rows, centroids[k])
        better = (got < best[rows]) | ((got == best[rows]) & (k < label[rows]))
        label[rows[better]], best[rows[better]] = k, got[better]
    return label, best


def _assigned(batch, centroids, rotation, dims: int, lead: int):
    v = _matrix(batch.column("v"), np.int64, dims)
    return v, *nearest(v, _matrix(batch.column("lead"), np.float64, lead), np.asarray(batch.column("rest")), centroids, rotation)


def moved(points: DataFrame, centroids: np.ndarray, rotation: Rotation) -> np.ndarray:
    """Each centroid as the floor of the mean of the vectors nearest to it; one without any stays."""
    k, dims, lead = *centroids.shape, rotation.axes.shape[1]

    def run(batches):
        n, sums = np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
        for batch in batches:
            v, label, _ = _assigned(batch, centroids, rotation, dims, lead)
            n += np.bincount(label, minlength=k)
            np.add.at(sums, label, v)
        held = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), pa.array(n[held]), pa.array(sums[held].tolist(), pa.list_(pa.int64()))],
                                         names=["cluster", "n", "sums"])
    parts = points.select("v", "lead", "rest").mapInArrow(run, "cluster int, n long, sums array<long>")
    wide = [F.sum(F.col("sums")[i].cast("decimal(38,0)")).alias(f"s{i}") for i in range(dims)]
    out = centroids.copy()
    for r in parts.groupBy("cluster").agg(F.sum("n").alias("n"), *wide).collect():       # k rows
        out[r.cluster] = [int(r[f"s{i}"]) // r.n for i in range(dims)]
    return out


def cluster(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 8, rounds: int = 10,
            dims: int = 64, scale: int = 1024, seed: int = 3, lead: int = LEAD) -> DataFrame:
    """(id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every kept vector."""
    spark = vectors.sparkSession
    points = integers(vectors, id_col, vector_col, dims, scale)
    kind = points.schema["id"].dataType.simpleString()
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("null"))), 256)
    starts = points.orderBy(key, "v").limit(k).collect()                 # k rows
    if not starts:
        return spark.createDataFrame([], f"id {kind}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    _, mean, spread = scatter(points, dims)
    rotation = Rotation(mean, spread, min(lead, dims))
    points = saved(rotated(points, rotation, dims), "rotated")
    centroids = np.array([r.v for r in starts], np.int64)
    for _ in range(rounds):
        now = moved(points, centroids, rotation)
        if (now == centroids).all():
            break
        centroids = now

    def run(batches):
        for batch in batches:
            _, label, best = _assigned(batch, centroids, rotation, dims, rotation.axes.shape[1])
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(label, pa.int32()), pa.array(best)], names=["id", "cluster", "distance"])
    found = saved(points.mapInArrow(run, f"id {kind}, cluster int, distance long"), "assigned")
    sums = {r.cluster: int(r.s) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    named = [(c, sums.get(c, 0), sum(sums.values()), hashlib.sha256(",".join(map(str, v)).encode()).hexdigest())
             for c, v in enumerate(centroids.tolist())]
    table = spark.createDataFrame(named, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(table), "cluster").select(                              # k rows
        "id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")

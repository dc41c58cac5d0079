"""Near-duplicate vectors through an inverted multi-index.

Vectors are scaled to length 1 and cut into two halves; each half has a codebook of its
own, and the pairs of code words form a grid of cells.  Every vector is filed in its
cell.  As a query it visits cells in the order of the summed squared distances of its
halves to the code words (the multi-sequence order: the first T cells lie among the rank
pairs (a, b) with (a + 1)(b + 1) <= T), and leaves out cells that cannot hold a vector
near enough by the bisector bound.  Members of visited cells are compared exactly, in
double precision.

T is measured, not guessed, and has no upper limit but the number of cells: a bounded set
of sample queries is compared with all vectors by brute force, and T is the rank by which
their true neighbours reach the target recall, counted over all links and as the mean over
the queries, so that the links of one large group do not hide the others.  If no sample
query has a neighbour, T is measured on made neighbours that are just near enough.

Code words of one half lie at least ``apart`` from each other: words that a large group of
near copies draws close together are merged, and the other vectors get words in their
place.  Such a group is one cell or a few, compared in blocks.

Equal vectors of one label are one entry with a weight.  A pair that both sides find is
counted once: a member learns of a query only if it does not visit the query's cell itself.
Tasks return, for each vector, the number of links and one member of its local component,
never the pairs.  Crowded cells are dealt over tasks by blocks of members and of queries.

Codebooks are fitted on at most ``sample`` vectors and T on ``probes`` queries, chosen by
hash; all vectors are indexed and are queries.

Defined results: vectors that are null, zero, or hold null or non-finite numbers, and rows
with a null label or id link with nothing; vectors of different length do not link; rows
with equal ids are one node, their links are added up; an empty table gives no rows; other
columns are never read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved
from .components import components

SAMPLE, PROBES = 20_000, 256
RECALL, MIN_CELLS = 0.999, 4
OCCUPANCY = 32              # vectors of a label in a cell, on average
BLOCK = 1024                # members, and queries, of a cell compared in one task


def units(raw, dtype) -> np.ndarray:
    """Rows scaled to length 1, in double precision, from packed numbers."""
    x = np.stack([np.frombuffer(r, dtype) for r in raw]).astype(np.float64)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _means(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """k-means of half vectors."""
    rng = np.random.default_rng(5)
    centres = x[rng.permutation(len(x))[:k]]
    for _ in range(rounds):
        near = _distances(x, centres).argmin(1)
        n = np.bincount(near, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        centres = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres)
    return centres


def _merged(x: np.ndarray, centres: np.ndarray, apart: float):
    """The words left when, from the most used on, each takes those nearer than ``apart``; how many each took."""
    use = np.bincount(_distances(x, centres).argmin(1), minlength=len(centres))
    close, left, kept, took = _distances(centres, centres) < apart * apart, np.ones(len(centres), bool), [], []
    for c in np.argsort(-use, kind="stable"):
        if left[c]:
            mine = close[c] & left
            mine[c] = True
            left &= ~mine
            kept.append(np.average(centres[mine], axis=0, weights=np.maximum(use[mine], 1)))
            took.append(int(mine.sum()))
    return np.array(kept), np.array(took)


def _codebook(x: np.ndarray, k: int, apart: float = 0.0) -> np.ndarray:
    """Up to ``k`` code words for half vectors, none but rarely nearer than ``apart`` to another."""
    words, took = _merged(x, _means(x, k), apart)
    crowded = words[took > 1]
    if len(crowded):                             # the words that groups gave up go to the other vectors
        rest = x[took[_distances(x, words).argmin(1)] == 1]
        free = min(k - len(crowded), len(rest) // 4)
        if free > len(words) - len(crowded):
            words, _ = _merged(x, np.concatenate([crowded, _means(rest, free)]), apart)
    return words


def _distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] - 2 * x @ centres.T + (centres * centres).sum(1), 0)


@dataclass(frozen=True)
class Index:
    """The two codebooks of one vector length."""
    books: tuple[np.ndarray, np.ndarray]
    reach: float                    # squared distance of unit vectors at the threshold

    def distances(self, x: np.ndarray):
        half = self.books[0].shape[1]
        return _distances(x[:, :half], self.books[0]), _distances(x[:, half:], self.books[1])

    def cells(self, x: np.ndarray) -> np.ndarray:
        a, b = self.distances(x)
        return a.argmin(1) * len(self.books[1]) + b.argmin(1)

    def _bound(self, d, book) -> np.ndarray:
        """Squared least distance to each code word's region, along the bisector."""
        near = d.argmin(1)
        gap = np.sqrt(_distances(book, book))[near]
        return (np.maximum(d - d.min(1, keepdims=True), 0) / np.maximum(2 * gap, 1e-12)) ** 2

    def visits(self, x: np.ndarray, cells: int) -> list[np.ndarray]:
        """For each vector the cells it visits, nearest first."""
        wide, width = len(self.books[0]), len(self.books[1])
        cells = min(cells, wide * width)
        rows = [np.arange(min(width, cells // (i + 1))) for i in range(min(wide, cells))]
        first, second = np.repeat(np.arange(len(rows)), [len(r) for r in rows]), np.concatenate(rows)
        out = []
        for at in range(0, len(x), step := max(1, 1_000_000 // len(first))):
            a, b = self.distances(x[at:at + step])
            ra, rb = a.argsort(1, kind="stable"), b.argsort(1, kind="stable")
            take = lambda d, r, k: np.take_along_axis(d, r, 1)[:, k]
            cost = take(a, ra, first) + take(b, rb, second)
            bound = take(self._bound(a, self.books[0]), ra, first) + take(self._bound(b, self.books[1]), rb, second)
            order = cost.argsort(1, kind="stable")[:, :cells]
            for r, o in enumerate(order):
                o = o[bound[r, o] <= self.reach + 1e-9]
                out.append(ra[r, first[o]] * width + rb[r, second[o]])
        return out

    def rank(self, x: np.ndarray, cell: np.ndarray) -> np.ndarray:
        """How many cells each vector of ``x`` must visit to come to the cell beside it."""
        (a, b), width = self.distances(x), len(self.books[1])
        at = np.arange(len(x))
        cost = a[at, cell // width] + b[at, cell % width] + 1e-12
        a, b = np.sort(a, 1), np.sort(b, 1)
        return np.array([np.searchsorted(b[r], cost[r] - a[r], "right").sum() for r in at], np.int64)


def _weighted(vectors: DataFrame, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    """(label, vector, id, weight): each distinct usable vector with its smallest id and its rows."""
    bad = F.exists(vec_col, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    length = F.aggregate(vec_col, F.lit(0.0), lambda s, v: s + v.cast("double") * v.cast("double"))
    usable = F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & F.col(vec_col).isNotNull() & ~bad & (length > 0)
    return vectors.where(usable).groupBy(F.col(label_col).alias("label"), F.col(vec_col).alias("vector")).agg(
        F.min(id_col).alias("id"), F.count(F.lit(1)).alias("weight"))


def _pack(dtype):
    def run(batches):
        for b in batches:
            v = b.column("vector")
            flat, ends = np.asarray(v.flatten(), dtype), np.cumsum(np.asarray(pa.compute.list_value_length(v)))
            raw = pa.array([x.tobytes() for x in np.split(flat, ends[:-1])] if len(ends) else [], pa.binary())
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("label", "id", "weight")),
                                              pa.array(np.diff(ends, prepend=0), pa.int32()), raw],
                                             names=["label", "id", "weight", "dim", "raw"])
    return run


def _component_marks(ids_q, ids_m, q, m):
    """For hits (q[i], m[i]) the smallest id that each query and member reaches within them."""
    low_q, low_m = ids_q.copy(), ids_m.copy()
    while True:
        low = np.minimum(low_q[q], low_m[m])
        new_q, new_m = low_q.copy(), low_m.copy()
        np.minimum.at(new_q, q, low)
        np.minimum.at(new_m, m, low)
        if (new_q == low_q).all() and (new_m == low_m).all():
            return low_q, low_m
        low_q, low_m = new_q, new_m


def _compare(cosine, dtype):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        queries, members = pdf[pdf.asks], pdf[~pdf.asks]
        none = pd.DataFrame({"id": [], "links": [], "root": []}).astype("int64")
        if queries.empty or members.empty:
            return none
        x, y = units(queries.raw, dtype), units(members.raw, dtype)
        iq, im = queries.id.to_numpy(), members.id.to_numpy()
        q, m = np.nonzero(x @ y.T >= cosine - 1e-9)
        exact = np.einsum("ij,ij->i", x[q], y[m]) >= cosine
        q, m = q[exact & (iq[q] != im[m])], m[exact & (iq[q] != im[m])]
        if not len(q):
            return none
        # a member that visits the query's cell finds this pair itself
        homes, home = np.unique(queries.home.to_numpy(), return_inverse=True)
        own = np.zeros((len(im), len(homes)), bool)
        for k in np.unique(m):
            own[k] = np.isin(homes, members.visits.iloc[k])
        alone = ~own[m, home[q]]
        wq, wm = queries.weight.to_numpy(), members.weight.to_numpy()
        links_q = np.bincount(q, wm[m], len(iq))
        links_m = np.bincount(m, np.where(alone, wq[q], 0), len(im))
        low_q, low_m = _component_marks(iq, im, q, m)
        out = pd.DataFrame({"id": np.r_[iq, im], "links": np.r_[links_q, links_m].astype(np.int64), "root": np.r_[low_q, low_m]})
        return out[(out.links > 0) | (out.root != out.id)]
    return run


def _fit(packed: DataFrame, dim: int, labels: int, n: int, cosine: float, dtype, sample: int) -> Index:
    rows = packed.where(F.col("dim") == dim).orderBy(F.xxhash64("id", F.lit(3)), "id").limit(sample).select("raw").collect()
    x = units([bytes(r.raw) for r in rows], dtype)
    k = int(min(max(4, np.ceil(np.sqrt(n / max(labels, 1) / OCCUPANCY))), max(1, len(x) // 4) if len(x) >= 16 else 1, 4096))
    half = (dim + 1) // 2
    reach = 2 - 2 * cosine
    apart = np.sqrt(max(reach, 0) / 2)           # of two linked vectors one half at least is as near as that
    return Index((_codebook(x[:, :half], k, apart), _codebook(x[:, half:], k, apart)), reach)


def _made(x: np.ndarray, cosine: float) -> np.ndarray:
    """For each vector one at the threshold, in a direction by chance."""
    other = np.random.default_rng(7).normal(size=x.shape)
    other -= (other * x).sum(1, keepdims=True) * x
    return cosine * x + np.sqrt(max(0.0, 1 - cosine * cosine)) * other / np.maximum(np.linalg.norm(other, axis=1, keepdims=True), 1e-12)


def _cells_for(packed: DataFrame, dim: int, index: Index, cosine: float, dtype, probes: int, recall: float) -> int:
    """The number of cells by which sample queries meet ``recall`` of their true neighbours."""
    rows = packed.where(F.col("dim") == dim).orderBy(F.xxhash64("id", F.lit(4)), "id").limit(probes).select("id", "label", "raw").collect()
    ids, labels = np.array([r.id for r in rows]), np.array([r.label for r in rows])
    x = units([bytes(r.raw) for r in rows], dtype)
    every = len(index.books[0]) * len(index.books[1])
    steps = np.unique(np.r_[np.ceil(2 ** np.arange(0, np.log2(every) + 0.25, 0.25)).astype(np.int64).clip(max=every), every])
    # found if either side visits the other's cell
    place = lambda a, b: np.searchsorted(steps, np.minimum(index.rank(a, index.cells(b)), index.rank(b, index.cells(a))).clip(max=every))

    def run(batches):
        seen = np.zeros((len(x), len(steps)), np.int64)
        for b in batches:
            y = units([r.as_py() for r in b.column("raw")], dtype)
            q, m = np.nonzero((x @ y.T >= cosine) & (labels[:, None] == np.asarray(b.column("label"))) & (ids[:, None] != np.asarray(b.column("id"))))
            for at in range(0, len(q), 10_000):
                some = slice(at, at + 10_000)
                np.add.at(seen, (q[some], place(x[q[some]], y[m[some]])), 1)
        q, k = np.nonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(q, pa.int32()), pa.array(k, pa.int32()), pa.array(seen[q, k])], names=["probe", "step", "n"])

    got = packed.where(F.col("dim") == dim).mapInArrow(run, "probe int, step int, n long").groupBy("probe", "step").agg(F.sum("n").alias("n")).collect()
    n = np.zeros((len(x), len(steps)))
    for r in got:
        n[r["probe"], r["step"]] = r["n"]
    if not n.any():
        np.add.at(n, (np.arange(len(x)), place(x, _made(x, cosine))), 1)
    n = n[n.sum(1) > 0]
    share = np.minimum(np.cumsum(n.sum(0)) / n.sum(), np.cumsum(n / n.sum(1, keepdims=True), 1).mean(0))
    enough = np.flatnonzero(share >= min(recall, 1 - 1e-9))
    if not len(enough):
        raise RuntimeError(f"all {every} cells hold {share[-1]:.4f} of the sample's links, less than {recall}")
    return int(min(max(MIN_CELLS, 2 * steps[enough[0]]), every))


def near_vectors(vectors: DataFrame, cosine: float = 0.93, id_col: str = "vec_id", vec_col: str = "embedding",
                 label_col: str = "label", sample: int = SAMPLE, probes: int = PROBES, recall: float = RECALL) -> DataFrame:
    """One row per row of ``vectors``: id, ``n_links`` (other vectors linked directly) and
    ``component`` (the smallest id reachable)."""
    dtype = np.float32 if vectors.schema[vec_col].dataType.elementType.typeName() == "float" else np.float64
    distinct = saved(_weighted(vectors.select(id_col, vec_col, label_col), id_col, vec_col, label_col), "vectors")
    kinds = {c: distinct.schema[c].dataType.simpleString() for c in ("label", "id")}
    packed = saved(distinct.select("label", "id", "weight", "vector").mapInArrow(
        _pack(dtype), f"label {kinds['label']}, id {kinds['id']}, weight long, dim int, raw binary"), "packed")
    sizes = packed.groupBy("dim").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("label").alias("labels")).collect()
    plans = {}                                   # one index for each vector length
    for r in sizes:
        index = _fit(packed, r.dim, r.labels, r.n, cosine, dtype, sample)
        plans[r.dim] = (index, _cells_for(packed, r.dim, index, cosine, dtype, probes, recall))

    def file(batches):
        for b in batches:
            for dim in set(b.column("dim").to_pylist()):
                index, cells = plans[dim]
                some = b.filter(pa.compute.equal(b.column("dim"), dim))
                x = units([r.as_py() for r in some.column("raw")], dtype)
                yield pa.RecordBatch.from_arrays([*(some.column(c) for c in ("label", "id", "weight", "dim", "raw")),
                                                  pa.array(index.cells(x), pa.int64()),
                                                  pa.array([v.astype(np.int64) for v in index.visits(x, cells)], pa.list_(pa.int64()))],
                                                 names=["label", "id", "weight", "dim", "raw", "home", "visits"])

    filed = packed.mapInArrow(file, f"label {kinds['label']}, id {kinds['id']}, weight long, dim int, raw binary, "
                                    "home long, visits array<long>")
    key = ["label", "dim", "cell"]
    members = filed.withColumn("cell", F.col("home"))
    queries = filed.withColumn("cell", F.explode("visits"))
    held = members.groupBy(*key).agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    asked = queries.groupBy(*key).agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("parts"))
    crowd = saved(held.join(asked, key), "cells")
    part = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    sides = (queries.join(crowd, key).withColumn("part", part("parts")).withColumn("block", every("blocks"))
             .select(*key, "block", "part", "id", "weight", "raw", "home", F.lit(None).cast("array<long>").alias("visits"), F.lit(True).alias("asks"))
             .unionByName(members.join(crowd, key).withColumn("block", part("blocks")).withColumn("part", every("parts"))
                          .select(*key, "block", "part", "id", "weight", "raw", "home", "visits", F.lit(False).alias("asks"))))
    found = saved(sides.groupBy(*key, "block", "part").applyInPandas(_compare(cosine, dtype), f"id {kinds['id']}, links long, root {kinds['id']}"), "found")
    joined = components(found.select(F.col("id").alias("a"), F.col("root").alias("b"))).withColumnRenamed("component", "__c")
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    classes = (distinct.join(links, "id", "left").join(joined, "id", "left")
               .select(F.col("label").alias("__label"), F.col("vector").alias("__vector"),
                       (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("__links"),
                       F.coalesce("__c", F.col("id")).alias("__component")))
    rows = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vec_col).alias("vector"))
    return (rows.join(classes, (F.col("label") == F.col("__label")) & (F.col("vector") == F.col("__vector")), "left")
            .select("id", F.coalesce("__links", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("__component", F.col("id")).alias("component")))

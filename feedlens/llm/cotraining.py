"""Quality classifier by co-training a text view and a page-metadata view.

Two logistic regressions over the log-odds of features look at different sides of a document: the words and the
shape of its text, and its metadata (source, language, size).  Both start from the
labelled rows.  In each round every view labels the documents of an unlabelled pool
that it is sure about, and the other view learns from them too.  A last regression
over the two views' log-odds, fitted on labelled rows that neither view learned from,
calibrates and combines them.  All documents are then scored by the combined model.

A document is good if its quality label is 1 and its toxic label is not 1.

Fitting is bounded: ``labelled`` and ``pool`` rows at most, chosen by a hash of the id
from all rows, so the sample does not depend on order or on one hot source; it is one
task's work.  Scoring covers every row and whole texts in one pass without a shuffle; the
weights it needs have a fixed size.

Defined results: null texts count as empty, a null source, language or size is a value
of its own; a document with several labels is good only if all say so; labels that are
null or whose document is missing are not used; with fewer than two classes among the
labels every score is their share of good (1 without labels); rows with equal ids are
scored each for itself; an empty table gives no rows; other columns stay.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import saved
from .kneser_ney import slices
from .words import _buffers, hash_parts

LABELLED, POOL = 10_000, 4_000      # most rows that are fitted on
ROUNDS, SURE = 2, 0.95              # rounds of exchange; how sure a pseudo-label has to be
WORDS, META = 1 << 18, 1 << 10      # feature buckets of words and of metadata values
HELD = 5                            # one labelled row in so many calibrates
THRESHOLD = 0.5
PENALTY = {"content": 1e-4, "meta": 1e-3, "both": 1e-3}
ITERATIONS = 120                    # of one regression at most

PREFIXES = (4, 5)                   # bytes of a word's start that count beside the whole word
SEEN = 3                            # a feature has to be in so many labelled rows

#: Words are parted by all ASCII bytes but letters and digits.
_PARTS = np.array([not (chr(b).isalnum() or b > 127) for b in range(256)])
#: Shares of these bytes tell running text from other text.
_KINDS = [b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b".,;:'\"()-", b" \t\r\n", b"\n", b"|{}<>=", b"!?$%&*#@"]
_STEPS = 21                         # a share counts by its step, each with a weight of its own
_CONTENT = WORDS + len(_KINDS) * _STEPS + 11


# -- views --------------------------------------------------------------------

def content_features(column) -> tuple[np.ndarray, np.ndarray]:
    """(feature numbers of all rows, how many each row has): distinct words and steps of shape."""
    parts, counts = hash_parts(column, _PARTS, PREFIXES)
    n = len(counts)
    row = np.repeat(np.arange(n), counts) * WORDS
    bucket = lambda h, k: ((h + np.uint64(k)) & np.uint64(WORDS - 1)).astype(np.int64)
    whole = np.unique(row + bucket(parts[0], 0))
    words = np.bincount(whole // WORDS, minlength=n)
    pairs = np.unique(np.concatenate([whole, *(row + bucket(h, k) for k, h in enumerate(parts[1:], 1))]))
    distinct = np.bincount(pairs // WORDS, minlength=n)
    offsets, data = _buffers(column)
    size = np.diff(offsets)
    raw = data[offsets[0]:offsets[-1]]
    ends = offsets[1:] - offsets[0]
    shape = []
    for k, kind in enumerate(_KINDS):
        table = np.zeros(256, bool)
        table[list(kind)] = True
        total = np.concatenate([[0], np.cumsum(table[raw])])
        share = (total[ends] - total[ends - size]) / np.maximum(size, 1)
        shape.append(WORDS + k * _STEPS + np.minimum((np.sqrt(share) * (_STEPS - 1)).astype(np.int64), _STEPS - 1))
    shape.append(WORDS + len(_KINDS) * _STEPS + (10 * words / np.maximum(counts, 1)).astype(np.int64))
    feature = np.concatenate([pairs % WORDS, *shape])
    at = np.concatenate([pairs // WORDS, *([np.arange(n)] * len(shape))])
    return feature[np.argsort(at, kind="stable")], distinct + len(shape)


def _tags(source: Column, lang: Column, size: Column) -> list[Column]:
    """The buckets of a document's metadata values."""
    steps = F.floor(F.log2(F.greatest(size, F.lit(1))) * 2).cast("string")
    return [F.pmod(F.xxhash64(F.lit(k), F.coalesce(c.cast("string"), F.lit("\u0001null"))), F.lit(META)).cast("int").alias(f"__m{k}")
            for k, c in enumerate((source, lang, steps))]


# -- regression ----------------------------------------------------------------

def _linear(feature, size, w):
    """Sums of weights by row; the last weight is the intercept."""
    if not len(size):
        return np.zeros(0)
    return np.add.reduceat(w[feature], np.cumsum(size) - size) + w[-1]     # no row is without features


def _fit_rows(value, gradient, w, iterations=ITERATIONS, memory=8):
    """Limited-memory quasi-Newton descent with step halving."""
    f, g = value(w), gradient(w)
    pairs: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(iterations):
        d, coefs = -g, []
        for s, y in reversed(pairs):
            coefs.append(a := s @ d / (s @ y))
            d = d - a * y
        if pairs:
            s, y = pairs[-1]
            d = d * (s @ y) / (y @ y)
        for (s, y), a in zip(pairs, reversed(coefs), strict=True):
            d = d + (a - y @ d / (s @ y)) * s
        step, slope = 1.0 if pairs else 1.0 / max(np.abs(g).sum(), 1e-12), g @ d
        while (new := value(w + step * d)) > f + 1e-4 * step * slope and step > 1e-10:
            step /= 2
        if new >= f - 1e-6 * max(abs(f), 1e-12):
            return w if new > f else w + step * d
        s, before = step * d, g
        w, f = w + s, new
        g = gradient(w)
        if s @ (g - before) > 1e-12:
            pairs = [*pairs[1 - memory:], (s, g - before)]
    return w


def logistic(feature, size, y, width, penalty, value=None) -> np.ndarray:
    """Weights (intercept last) of a logistic regression over features of 1, or of ``value`` each."""
    row = np.repeat(np.arange(len(size)), size)
    v, sign, starts = 1.0 if value is None else value, 2 * y - 1, np.cumsum(size) - size

    def margin(w):
        return sign * (np.add.reduceat(w[feature] if value is None else v * w[feature], starts) + w[-1])

    def loss(w):
        return np.logaddexp(0, -margin(w)).mean() + penalty / 2 * (w[:-1] @ w[:-1])

    def slope(w):
        r = -sign / (1 + np.exp(np.clip(margin(w), -500, 500))) / len(y)
        g = np.bincount(feature, v * r[row], width + 1)
        g[:-1] += penalty * w[:-1]
        g[-1] = r.sum()
        return g

    return _fit_rows(loss, slope, np.zeros(width + 1))


def _probability(z):
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def co_train(pdf: pd.DataFrame, rounds: int, sure: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Weights of the content view, the metadata view and their combination."""
    rows = [np.frombuffer(x, np.int32) for x in pdf.features]
    meta = pdf[["__m0", "__m1", "__m2"]].to_numpy()
    y, known = pdf.y.fillna(0).to_numpy(), pdf.y.notna().to_numpy()
    held = known & (pdf.fold.to_numpy() == 0)
    if held.sum() < 2 or len(set(y[held])) < 2 or len(set(y[known & ~held])) < 2:
        held = np.zeros(len(y), bool)                # too few to calibrate on other rows
    train = known & ~held
    # features of hardly any labelled row are left out of the fit: their weights stay 0
    seen = np.bincount(np.concatenate([rows[i] for i in np.flatnonzero(train)]), minlength=_CONTENT) >= SEEN
    seen[WORDS:] = True
    rows = [x[seen[x]] for x in rows]

    def data(view, at):
        if view == "meta":
            return meta[at].ravel(), np.full(len(at), 3)
        return np.concatenate([rows[i] for i in at]), np.array([len(rows[i]) for i in at])

    width = {"content": _CONTENT, "meta": META}

    def fit(view, at, label):
        # each feature counts by its log-odds among the rows, so rare but telling ones are not shrunk away
        feature, size = data(view, at)
        good = np.bincount(feature, np.repeat(label, size), width[view]) + 1
        bad = np.bincount(feature, np.repeat(1 - label, size), width[view]) + 1
        odds = np.log(good / (label.sum() + 2)) - np.log(bad / ((1 - label).sum() + 2))
        w = logistic(feature, size, label, width[view], PENALTY[view], value=odds[feature])
        return np.append(odds * w[:-1], w[-1])

    base, pool = np.flatnonzero(train), np.flatnonzero(~known)
    w = {v: fit(v, base, y[base]) for v in width}
    for _ in range(rounds if len(pool) else 0):
        learned = {}
        for view, other in (("content", "meta"), ("meta", "content")):
            p = _probability(_linear(*data(other, pool), w[other]))
            sure_at = np.flatnonzero((p >= sure) | (p <= 1 - sure))
            at = np.concatenate([base, pool[sure_at]])
            learned[view] = fit(view, at, np.concatenate([y[base], (p[sure_at] >= 0.5).astype(float)]))
        w = learned
    check = np.flatnonzero(held) if held.any() else base
    z = np.stack([_linear(*data(v, check), w[v]) for v in width], 1)
    both = logistic(np.tile([0, 1], len(check)), np.full(len(check), 2), y[check], 2, PENALTY["both"], value=z.ravel())
    return w["content"], w["meta"], both


@dataclass
class CoModel:
    weights: tuple[np.ndarray, np.ndarray, np.ndarray] | None
    share: float                     # of good labels, used when there is nothing to learn

    def score(self, docs: DataFrame, text_col: str = "text", source_col: str = "source", lang_col: str = "lang",
              size_col: str = "n_chars") -> DataFrame:
        """``docs`` plus ``content_score``, ``meta_score`` and ``score``, the probability of good;
        columns of these names are replaced."""
        names = ["content_score", "meta_score", "score"]
        docs = docs.drop(*names)
        if self.weights is None:
            return docs.withColumns({k: F.lit(self.share) for k in names})
        content, meta, both = self.weights
        columns = docs.columns

        def run(batches):
            for batch in batches:
                for some in slices(batch, text_col):
                    z = np.stack([_linear(*content_features(some.column(text_col)), content),
                                  meta[np.stack([np.asarray(some.column(f"__m{k}")) for k in range(3)], 1)].sum(1) + meta[-1]], 1)
                    out = [*(_probability(z[:, k]) for k in (0, 1)), _probability(z @ both[:2] + both[2])]
                    yield pa.RecordBatch.from_arrays([*(some.column(c) for c in columns), *map(pa.array, out)],
                                                     names=[*columns, *names])

        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
        tagged = docs.select("*", *_tags(F.col(source_col), F.col(lang_col), F.col(size_col)))
        return tagged.mapInArrow(run, schema + ", content_score double, meta_score double, score double")


def _chosen(ids: DataFrame, limit: int) -> DataFrame:
    """At most ``limit`` rows by a hash of the id."""
    return ids.orderBy(F.xxhash64("__id", F.lit(7)), "__id").limit(limit)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        lang_col: str = "lang", size_col: str = "n_chars", labelled: int = LABELLED, pool: int = POOL,
        rounds: int = ROUNDS, sure: float = SURE) -> CoModel:
    good = F.when(F.col("quality").isNotNull(), (F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) != 1))
    known = labels.select(F.col(id_col).alias("__id"), good.cast("double").alias("y")).where(
        "__id is not null and y is not null").groupBy("__id").agg(F.min("y").alias("y"))
    rows = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("text"),
                       *_tags(F.col(source_col), F.col(lang_col), F.col(size_col)))
    some = _chosen(known.join(rows.select("__id").where("__id is not null").distinct(), "__id", "left_semi"), labelled)
    free = _chosen(rows.select("__id").where("__id is not null").join(known.select("__id"), "__id", "left_anti"), pool)
    picked = rows.join(F.broadcast(some.unionByName(free.withColumn("y", F.lit(None).cast("double")))), "__id")  # labelled + pool ids
    fold = F.pmod(F.xxhash64("__id", F.lit(11)), F.lit(HELD)).cast("int").alias("fold")

    def features(batches):
        for batch in batches:
            for one in slices(batch, "text"):
                f, size = content_features(one.column("text"))
                parts = np.split(f.astype(np.int32), np.cumsum(size)[:-1]) if len(size) else []
                yield pa.RecordBatch.from_arrays([*(one.column(c) for c in ("y", "fold", "__m0", "__m1", "__m2")),
                                                  pa.array([x.tobytes() for x in parts], pa.binary())],
                                                 names=["y", "fold", "__m0", "__m1", "__m2", "features"])

    data = saved(picked.select("text", "y", fold, "__m0", "__m1", "__m2").mapInArrow(
        features, "y double, fold int, __m0 int, __m1 int, __m2 int, features binary"), "views")
    n, mean = data.agg(F.count("y"), F.avg("y")).first()
    if not n or mean in (0.0, 1.0):
        return CoModel(None, 1.0 if mean is None else float(mean))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"w": [x.tobytes() for x in co_train(pdf, rounds, sure)]})

    # labelled + pool rows at most: one task, three rows of fixed size
    found = data.withColumn("all", F.lit(1)).groupBy("all").applyInPandas(run, "w binary").collect()
    weights = sorted((np.frombuffer(bytes(r.w)) for r in found), key=len, reverse=True)
    return CoModel(tuple(weights), float(mean))


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **options) -> DataFrame:
    """``docs`` plus the scores and ``keep``: whether the probability of good reaches the threshold."""
    model = fit(docs, labels, **options)
    columns = {k: v for k, v in options.items() if k.endswith("_col") and k != "id_col"}
    return model.score(docs, **columns).withColumn("keep", F.col("score") >= threshold)

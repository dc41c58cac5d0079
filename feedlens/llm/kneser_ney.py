"""An interpolated modified Kneser-Ney bigram model, counted in Spark.

Words are maximal runs without white space, A-Z lower-cased, followed by one end
token for each text; words are known by 64-bit hashes.  Counting:

1. each task counts the distinct bigrams of its texts and sends them, packed in
   arrays, to the shard of their context word;
2. each shard merges its bigrams into sorted hash arrays (bigram hash, count) in
   files of the shared folder, and passes on, by word, the counts that the lower
   order needs: how often and after how many words a word came, and how many words
   followed it once, twice, and three times or more;
3. each word shard writes sorted arrays of these numbers.

Only the counts of counts, from which the discounts follow, reach the driver.  To
score, each worker maps the files into memory, looks up a whole batch of bigrams at
once and adds the log-probabilities by text.

    p(w|u) = max(c(uw) - D(c(uw)), 0) / c(u) + (D1 N1(u) + D2 N2(u) + D3 N3+(u)) / c(u) * p(w)
    p(w)   = max(m(w) - E(m(w)), 0) / M + (E1 V1 + E2 V2 + E3 V3+) / M / (V + 1)

m(w) is the number of contexts of w, M their sum, V the number of distinct training
tokens; one more word stands for all unknown ones.  After an unknown word p(w) is
used.  A context that a large share of all tokens has (by a sample of documents) is
dealt over all shards by bigram; its follower counts are added up again by word.

Defined results: a null or blank text holds the end token alone; without training
documents every base probability is 1/1 and the model is uniform over one word;
rows are scored each for itself, whatever their ids; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import partitions, saved, scratch
from .files import mapped, write_bytes
from .words import END, START, chain, hash_words, mix

_SLICE_BYTES = 2 << 20          # texts handled at once inside a task
_PENDING = 2_000_000            # bigrams a task gathers before it merges them


def slices(batch, column: str, limit: int = _SLICE_BYTES):
    """Parts of an Arrow batch with about ``limit`` bytes of text each, at least one row."""
    sizes = np.asarray(pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0), np.int64)
    block = np.cumsum(sizes) // limit
    edges = np.flatnonzero(np.diff(block, prepend=-1, append=block[-1] + 1 if len(block) else 0))
    for lo, hi in zip(edges[:-1], edges[1:], strict=True):
        yield batch.slice(lo, hi - lo)


def tokens(column) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(context, token, tokens of each row) with the end token at the end of every row."""
    words, counts = hash_words(column)
    per_row = counts + 1
    ends = np.cumsum(per_row) - 1
    token = np.empty(len(words) + len(counts), np.uint64)
    is_end = np.zeros(len(token), bool)
    is_end[ends] = True
    token[is_end] = END
    token[~is_end] = words
    context = np.empty_like(token)
    context[1:] = token[:-1]
    context[ends - counts] = START
    return context, token, per_row


def shard_of(context, token, hot, n):
    """A context's shard; the bigrams of the hot contexts go to all shards."""
    spread = np.isin(context, hot)
    return (mix(np.where(spread, context ^ mix(token), context)) % np.uint64(n)).astype(np.int64)


def _merge(parts):
    """Add up (context, token, count) triples."""
    u, w, c = (np.concatenate(x) for x in zip(*parts, strict=True))
    _, first, back = np.unique(chain(u, w), return_index=True, return_inverse=True)
    return u[first], w[first], np.bincount(back, c, len(first)).astype(np.int64)


def _pack(*arrays) -> list[bytes]:
    return [np.ascontiguousarray(a).tobytes() for a in arrays]


def _small(c: np.ndarray) -> np.ndarray:
    """Counts in as few bytes as they need; ``_wide`` reads them by their size."""
    top = int(c.max(initial=0))
    return c.astype(np.uint8 if top < 256 else np.uint32 if top < 2**32 else np.uint64)


def _wide(raw: bytes, n: int) -> np.ndarray:
    width = len(raw) // n if n else 1
    return np.frombuffer(raw, {1: np.uint8, 4: np.uint32, 8: np.uint64}[width]).astype(np.int64)


def _by_shard(u, w, c, shard):
    """Rows (shard, contexts with their run lengths, tokens, counts), tokens sorted by context."""
    order = np.lexsort((u, shard))
    u, w, c, shard = u[order], w[order], c[order], shard[order]
    for part in np.split(np.arange(len(u)), np.flatnonzero(np.diff(shard)) + 1):
        if len(part):
            s = slice(part[0], part[-1] + 1)
            heads, runs = np.unique(u[s], return_counts=True)
            yield int(shard[part[0]]), *_pack(heads, _small(runs), w[s], _small(c[s]))


_COUNTED = "shard int, heads binary, runs binary, tails binary, counts binary"
_BY_WORD = "shard int, words binary, tokens binary, befores binary, n1 binary, n2 binary, n3 binary, n_kinds array<long>"


def count_task(hot, n, text_col):
    def run(batches):
        parts, held = [], 0
        for batch in batches:
            for some in slices(batch, text_col):
                u, w, _ = tokens(some.column(text_col))
                parts.append((u, w, np.ones(len(u), np.int64)))
                held += len(u)
                if held > _PENDING:
                    parts = [_merge(parts)]
                    held = len(parts[0][0]) // 2      # so that merging stays a constant share of the work
        if parts:
            rows = list(_by_shard(*(m := _merge(parts)), shard_of(m[0], m[1], hot, n)))
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(
                zip(*rows, strict=True), [pa.int32(), *[pa.large_binary()] * 4], strict=True)],
                names=["shard", "heads", "runs", "tails", "counts"])
    return run


def _kinds(c) -> np.ndarray:
    """How many counts are 1, 2, 3 and 4."""
    return np.bincount(np.minimum(c, 5), minlength=6)[1:5].astype(np.int64)


def shard_task(folder, n):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        parts = []
        for r in pdf.itertuples(index=False):
            heads = np.frombuffer(r.heads, np.uint64)
            parts.append((np.repeat(heads, _wide(r.runs, len(heads))), (w := np.frombuffer(r.tails, np.uint64)),
                          _wide(r.counts, len(w))))
        u, w, c = _merge(parts)                      # in order of the bigram's hash
        write_bytes(f"{folder}/pairs-{pdf.shard[0]}", *_pack(chain(u, w)))
        write_bytes(f"{folder}/counts-{pdf.shard[0]}", *_pack(c.astype(np.uint32)))
        words, back = np.unique(np.concatenate([w, u]), return_inverse=True)
        as_token, as_context = back[:len(w)], back[len(w):]
        add = lambda at, what=None: np.bincount(at, what, len(words)).astype(np.int64)
        cols = [add(as_token, c), add(as_token), *(add(as_context[x]) for x in (c == 1, c == 2, c >= 3))]
        shard = (mix(words) % np.uint64(n)).astype(np.int64)
        order = np.argsort(shard, kind="stable")     # by shard, then word
        rows, kinds = [], _kinds(c).tolist()
        for part in np.split(order, np.flatnonzero(np.diff(shard[order])) + 1):
            rows.append((int(shard[part[0]]), *_pack(words[part], *(_small(x[part]) for x in cols)), kinds))
            kinds = None                             # once for each bigram shard
        return pd.DataFrame(rows, columns=["shard", "words", "tokens", "befores", "n1", "n2", "n3", "n_kinds"])
    return run


def word_task(folder):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        words = np.concatenate([np.frombuffer(x, np.uint64) for x in pdf.words])
        u, back = np.unique(words, return_inverse=True)
        cols = [np.bincount(back, np.concatenate([_wide(x, len(w) // 8) for x, w in zip(pdf[k], pdf.words, strict=True)]),
                            len(u)).astype(np.uint64) for k in ("tokens", "befores", "n1", "n2", "n3")]
        shard = pdf.shard[0]
        write_bytes(f"{folder}/words-{shard}", *_pack(u))
        write_bytes(f"{folder}/numbers-{shard}", *_pack(np.stack(cols, 1)))
        seen = cols[0] > 0                            # the start context is no token
        pairs = np.sum([x for x in pdf.n_kinds if x is not None] or [np.zeros(4, np.int64)], axis=0)
        before = cols[1][seen].astype(np.int64)
        return pd.DataFrame({"shard": [shard], "vocabulary": [int(seen.sum())], "tokens": [int(cols[0].sum())],
                             "befores": [int(before.sum())], "pair_kinds": [pairs.tolist()],
                             "word_kinds": [_kinds(before).tolist()], "three_plus": [int((before >= 3).sum())]})
    return run


def discounts(kinds) -> tuple[float, float, float]:
    """The discounts of counts 1, 2 and 3+ from the numbers of counts 1 to 4."""
    n1, n2, n3, n4 = (float(x) for x in kinds)
    if not n1:
        return 0.0, 0.0, 0.0
    y = n1 / (n1 + 2 * n2)
    d = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2 if n2 else 1.0, 3 - 4 * y * n4 / n3 if n3 else 1.0]
    return tuple(min(max(x, 0.0), float(k + 1)) for k, x in enumerate(d))


@dataclass(frozen=True)
class Model:
    """Where a counted model lies, with its totals."""
    folder: str
    shards: int
    hot: tuple[int, ...]
    vocabulary: int
    tokens: int
    befores: int
    pair_discounts: tuple[float, float, float]
    word_discounts: tuple[float, float, float]
    word_gamma: float


def fit(docs: DataFrame, text_col: str = "text", sample_of_hot: float = 0.01) -> Model:
    """Count a model of all rows of ``docs``."""
    spark = docs.sparkSession
    n, folder = partitions(spark), scratch(spark, "bigrams")
    texts = docs.select(text_col)

    def common(batches):
        seen: dict[int, int] = {}
        total = 0
        for batch in batches:
            for some in slices(batch, text_col):
                u, _, _ = tokens(some.column(text_col))
                words, c = np.unique(u, return_counts=True)
                total += int(c.sum())
                for k in np.argsort(-c)[:4 * n]:
                    seen[int(words[k])] = seen.get(int(words[k]), 0) + int(c[k])
        top = sorted(seen, key=seen.get)[-4 * n:]
        yield pa.RecordBatch.from_arrays([pa.array(np.array([*top, 0], np.uint64).view(np.int64)),
                                          pa.array([*(seen[k] for k in top), total], pa.int64())], names=["word", "c"])

    sample = texts.sample(sample_of_hot, seed=1).mapInArrow(common, "word long, c long")
    sums = sample.groupBy("word").agg(F.sum("c").alias("c")).orderBy(F.desc("c")).limit(4 * n + 1).collect()
    total = next((r.c for r in sums if r.word == 0), 0)
    hot = tuple(int(np.int64(r.word).view(np.uint64)) for r in sums if r.word != 0 and r.c * 4 * n > total)
    hot_words = np.array(hot, np.uint64)

    counted = texts.mapInArrow(count_task(hot_words, n, text_col), _COUNTED)
    by_word = counted.groupBy("shard").applyInPandas(shard_task(folder, n), _BY_WORD)
    done = by_word.groupBy("shard").applyInPandas(
        word_task(folder), "shard int, vocabulary long, tokens long, befores long, pair_kinds array<long>, "
                           "word_kinds array<long>, three_plus long")
    rows = saved(done, "bigram-totals").collect()        # one short row for each shard
    add = lambda k: np.sum([r[k] for r in rows], axis=0) if rows else np.zeros(4)
    words = discounts(add("word_kinds"))
    vocabulary, befores = sum(r.vocabulary for r in rows), sum(r.befores for r in rows)
    kinds = [*add("word_kinds")[:2], sum(r.three_plus for r in rows)]
    gamma = sum(d * k for d, k in zip(words, kinds, strict=True)) / befores if befores else 1.0
    return Model(folder, n, hot, vocabulary, sum(r.tokens for r in rows), befores,
                 discounts(add("pair_kinds")), words, float(gamma))


class Reader:
    """Looks up batches in a model's files; made once by each task."""

    def __init__(self, model: Model):
        self.m, self.hot = model, np.array(model.hot, np.uint64)
        self.files: dict[tuple[str, int], np.ndarray] = {}

    def _file(self, name: str, shard: int, dtype) -> np.ndarray:
        key = (name, shard)
        if key not in self.files:
            try:
                self.files[key] = mapped(f"{self.m.folder}/{name}-{shard}", dtype)
            except FileNotFoundError:                 # a shard without any entry
                self.files[key] = np.zeros(0, dtype)
        return self.files[key]

    def _find(self, keys, shards, names, dtypes, width):
        """For each key the row of its shard's table; zeros where it is missing."""
        out = np.zeros((len(keys), width), np.float64)
        order = np.lexsort((keys, shards))
        for part in np.split(order, np.flatnonzero(np.diff(shards[order])) + 1):
            if len(part):
                shard = int(shards[part[0]])
                have = self._file(names[0], shard, dtypes[0])
                if len(have):
                    at = np.minimum(np.searchsorted(have, keys[part]), len(have) - 1)
                    hit = have[at] == keys[part]
                    value = self._file(names[1], shard, dtypes[1]).reshape(-1, width)
                    out[part[hit]] = value[at[hit]]
        return out

    def score(self, column) -> tuple[np.ndarray, ...]:
        """(tokens, known tokens, base score, score) of each row."""
        m = self.m
        u, w, per_row = tokens(column)
        pairs, first, back = np.unique(chain(u, w), return_index=True, return_inverse=True)
        words, at = np.unique(np.concatenate([u[first], w[first]]), return_inverse=True)
        n = np.uint64(m.shards)
        numbers = self._find(words, (mix(words) % n).astype(np.int64), ("words", "numbers"), (np.uint64, np.uint64), 5)
        context, token = numbers[at[:len(first)]], numbers[at[len(first):]]
        c = self._find(pairs, shard_of(u[first], w[first], self.hot, m.shards),
                       ("pairs", "counts"), (np.uint64, np.uint32), 1)[:, 0]
        cut = lambda x, d: np.maximum(x - np.choose(np.minimum(x, 3).astype(int), [0.0, *d]), 0)
        lower = m.word_gamma / (m.vocabulary + 1)
        if m.befores:
            lower = cut(token[:, 1], m.word_discounts) / m.befores + lower
        # how often a word was a context: as often as it was a token, and the start once a text
        after = np.where(words == START, float(self.starts()), numbers[:, 0])[at[:len(first)]]
        seen = after > 0
        with np.errstate(divide="ignore", invalid="ignore"):
            p = np.where(seen, cut(c, m.pair_discounts) / after
                         + context[:, 2:] @ np.array(m.pair_discounts) / after * lower, lower)
        base = np.log10((token[:, 0] + 1) / (m.tokens + 1 * (m.vocabulary + 1)))
        row = np.repeat(np.arange(len(per_row)), per_row)
        add = lambda x: np.bincount(row, x, len(per_row))
        return per_row, add(token[back, 0] > 0).astype(np.int64), add(base[back]), add(np.log10(p)[back])

    def starts(self) -> int:
        """Training texts: each has one end token."""
        if not hasattr(self, "_starts"):
            end = np.array([END])
            found = self._find(end, (mix(end) % np.uint64(self.m.shards)).astype(np.int64),
                               ("words", "numbers"), (np.uint64, np.uint64), 5)
            self._starts = int(found[0, 0])
        return self._starts


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` without its text, plus ``n_tokens``, ``n_known``, ``base_score``, ``score``
    (log10 probability of the whole text) and ``perplexity``; columns of these names are replaced."""
    names = ["n_tokens", "n_known", "base_score", "score", "perplexity"]
    others = [c for c in docs.columns if c != text_col and c not in names]
    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in others)

    def run(batches):
        reader = Reader(model)
        for batch in batches:
            for some in slices(batch, text_col):
                n, known, base, got = reader.score(some.column(text_col))
                yield pa.RecordBatch.from_arrays(
                    [*(some.column(c) for c in others), pa.array(n, pa.int64()), pa.array(known, pa.int64()),
                     pa.array(base), pa.array(got), pa.array(10 ** (-got / n))], names=[*others, *names])

    return docs.select(*others, text_col).mapInArrow(run, f"{schema}, n_tokens long, n_known long, base_score double, score double, perplexity double")


def held_out(id_col: Column) -> Column:
    """The held-out seventh: crc32 of the id as text, modulo 7, is 2."""
    return F.coalesce(F.crc32(F.encode(id_col.cast("string"), "utf-8")) % 7 == 2, F.lit(False))

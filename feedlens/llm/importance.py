"""Target-distribution importance resampling over an Aho-Corasick dictionary of words.

A text is read as bytes: A-Z in lower case, every ASCII byte that is no letter or digit a
delimiter.  Features are all runs of 1 to ``max_words`` consecutive words joined by one
blank; a feature's bucket is the CRC-32 of its bytes modulo ``buckets``.

1. Words of all documents and of all target texts are counted in Spark.  The most frequent
   ones, at most ``DICTIONARY`` words of at most ``WORD_BYTES`` bytes (a bound of 3.2 MB), form
   the dictionary: each word between two delimiters is a pattern that carries its CRC and its
   length as payload.
2. An automaton scan of a text emits the payloads of its words in order.  Words outside the
   dictionary lie in the gaps between two emitted words; they are cut out there and get the
   same payload computed on the spot, so the dictionary decides speed only, never results.
3. Payloads of adjacent words are composed: the CRC of "a b" follows from the CRC of "a " and
   the CRC and length of "b", without the bytes.  That gives the buckets of all features.
4. Buckets are counted over all documents and over all target texts; the gain of a bucket is
   the scaled log of how much likelier the target has it.  A document's weight is the sum of
   its features' gains; its score adds Gumbel noise from a hash of its id, so that the highest
   scores are a draw without replacement by weight.
5. The drawn rows are ranked by a range sort over all tasks: each task ranks its own range and
   adds the rows of the ranges before it.

Defined results: a null or empty text has no words, so no features and weight 0; a null id is
hashed as the text ``null`` and comes last among ties; rows with equal ids are scored each for
itself, and between rows of equal score and id any order may come; empty tables give no rows (an
empty target or corpus leaves all counts at 0); other columns are never read.
"""

from __future__ import annotations

import math
import zlib
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import partitions, saved
from .kneser_ney import slices

BUCKETS = 10_000
SEED = 2024
MIN_WORDS = 20
PERCENT = 10
DICTIONARY, WORD_BYTES = 50_000, 64
FLUSH = 300_000                 # distinct words that a counting task holds before it hands them on

#: Each byte as it is compared: A-Z lower-cased, ASCII bytes of no word a blank.
_READ = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def _plain(text: str | None) -> bytes:
    return (text or "").encode().translate(_READ)


# -- CRC-32 of joined strings -----------------------------------------------------------

def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & np.uint32(1), (table >> np.uint32(1)) ^ np.uint32(0xEDB88320), table >> np.uint32(1))
    return table


def _apply(op: np.ndarray, crc: np.ndarray) -> np.ndarray:
    """A linear operator on 32 bits, kept as its results for each value of each of the four bytes."""
    out = op[0][crc & np.uint32(255)]
    for k in range(1, 4):
        out = out ^ op[k][(crc >> np.uint32(8 * k)) & np.uint32(255)]
    return out


@lru_cache(maxsize=64)
def _shift(power: int) -> np.ndarray:
    """The operator that appends 2**power zero bytes to what a CRC has read."""
    if power:
        half = _shift(power - 1)
        return np.stack([_apply(half, part) for part in half])
    table = _crc_table()
    one = lambda c: (c >> np.uint32(8)) ^ table[c & np.uint32(255)]
    return np.stack([one(np.arange(256, dtype=np.uint32) << np.uint32(8 * k)) for k in range(4)])


def crc_joined(first: np.ndarray, second: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRCs of joined strings from both CRCs and the byte lengths of the second strings."""
    out, power = first.astype(np.uint32), 0
    while length.size and int(length.max()) >> power:
        has = (length >> power) & 1 == 1
        out[has] = _apply(_shift(power), out[has])
        power += 1
    return out ^ second


def runs(crc: np.ndarray, length: np.ndarray, max_words: int):
    """CRCs of all runs of 1 to ``max_words`` words, by the number of words."""
    blank = np.full(1, zlib.crc32(b" "), np.uint32)
    so_far = crc
    yield so_far
    for n in range(2, max_words + 1):
        if len(crc) < n:
            return
        spaced = crc_joined(so_far[:-1], blank.repeat(len(so_far) - 1), np.ones(len(so_far) - 1, np.int64))
        so_far = crc_joined(spaced, crc[n - 1:], length[n - 1:])
        yield so_far


# -- dictionary and scans ---------------------------------------------------------------

def _payload(word: bytes) -> int:
    return len(word) << 32 | zlib.crc32(word)


def automaton(words: list[bytes]):
    out = ahocorasick.Automaton()
    for w in words:
        out.add_word(f" {w.decode('latin-1')} ", _payload(w))
    if words:
        out.make_automaton()
    return out


def scan(plain: bytes, dictionary, limit: int = 1 << 22) -> tuple[np.ndarray, np.ndarray]:
    """(CRC, length) of every word of a text in order; long texts are read in parts of ``limit``
    bytes or so, cut at delimiters."""
    parts, lo = [], 0
    while lo >= 0:
        hi = plain.find(b" ", lo + limit)
        parts.append(_scanned(plain[lo:hi] if hi >= 0 else plain[lo:], dictionary))
        lo = hi
    both = np.concatenate(parts)
    return both.astype(np.uint32), (both >> np.uint64(32)).astype(np.int64)


def _scanned(plain: bytes, dictionary) -> np.ndarray:
    text = f" {plain.decode('latin-1')} "           # one character for each byte
    found, at = [], 0
    for end, payload in (dictionary.iter(text) if len(dictionary) else ()):
        gap = end - (payload >> 32) - 1              # where the delimiter before the word is
        if gap > at:
            found += [_payload(w.encode("latin-1")) for w in text[at:gap].split(" ") if w]
        found.append(payload)
        at = end
    found += [_payload(w.encode("latin-1")) for w in text[at:].split(" ") if w]
    return np.array(found, np.uint64)


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, n) of one column ``text``; a task hands on its counts whenever it holds many words."""
    def run(batches):
        held: dict[bytes, int] = {}

        def out():
            got = pa.RecordBatch.from_pydict({"word": pa.array(held.keys(), pa.binary()), "n": pa.array(held.values(), pa.int64())})
            held.clear()
            return got
        for batch in batches:
            for some in slices(batch, "text"):
                for text in some.column("text").to_pylist():
                    for w in _plain(text).split():
                        if len(w) <= WORD_BYTES:
                            held[w] = held.get(w, 0) + 1
                if len(held) >= FLUSH:
                    yield out()
        if held:
            yield out()
    return texts.mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def dictionary_of(texts: DataFrame, size: int = DICTIONARY) -> list[bytes]:
    """The most frequent words of at most ``WORD_BYTES`` bytes, ``size`` of them at most.

    Counts are put on a scale of 32 steps a doubling; the words of the highest steps that fit
    together are taken whole, so no more than ``size`` words ever leave the tasks.
    """
    counts = saved(word_counts(texts).withColumn("step", F.floor(F.log2("n") * 32).cast("int")), "words")
    left, least = size, None
    for r in counts.groupBy("step").agg(F.count(F.lit(1)).alias("words")).orderBy(F.desc("step")).collect():  # 32 * 63 rows at most
        if r.words > left:
            break
        left, least = left - r.words, r.step
    if least is None:
        return []
    return sorted(bytes(r.word) for r in counts.where(F.col("step") >= least).select("word").collect())


def _buckets(plain: bytes, dictionary, max_words: int, buckets: int) -> tuple[int, np.ndarray]:
    """(number of words, buckets of all features)."""
    crc, length = scan(plain, dictionary)
    parts = [r % np.uint32(buckets) for r in runs(crc, length, max_words)]
    return len(crc), np.concatenate(parts).astype(np.int64)


def bucket_counts(texts: DataFrame, words, max_words: int, buckets: int) -> np.ndarray:
    """How many features of the texts fall into each bucket; ``words`` is a broadcast dictionary."""
    def run(batches):
        total, dictionary = np.zeros(buckets, np.int64), automaton(words.value)
        for batch in batches:
            for some in slices(batch, "text"):
                for text in some.column("text").to_pylist():
                    total += np.bincount(_buckets(_plain(text), dictionary, max_words, buckets)[1], minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(at, pa.int32()), "n": pa.array(total[at], pa.int64())})
    out = np.zeros(buckets, np.int64)
    for r in texts.mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r.bucket] = r.n                         # one row for each bucket at most
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln of (target share / corpus share)) of each bucket, one added to each count."""
    b = len(corpus)
    s_all, t_all = int(corpus.sum()), int(target.sum())
    return np.array([math.floor(1000 * math.log(float((t + 1) * (s_all + b)) / float((s + 1) * (t_all + b))))
                     for s, t in zip(corpus.tolist(), target.tolist(), strict=True)], np.int64)


def weights(docs: DataFrame, words, gain: np.ndarray, max_words: int) -> DataFrame:
    """(id, n_words, n_features, weight) of ``docs`` (id, text)."""
    def run(batches):
        dictionary = automaton(words.value)
        for batch in batches:
            for some in slices(batch, "text"):
                rows = []
                for text in some.column("text").to_pylist():
                    n, at = _buckets(_plain(text), dictionary, max_words, len(gain))
                    rows.append((n, len(at), int(gain[at].sum())))
                cols = np.array(rows, np.int64).reshape(-1, 3)
                yield pa.RecordBatch.from_arrays([some.column("id"), *(pa.array(cols[:, k]) for k in range(3))],
                                                 names=["id", "n_words", "n_features", "weight"])
    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(run, f"id {kind}, n_words long, n_features long, weight long")


# -- draw ---------------------------------------------------------------------------------

def noise(seed: int):
    """floor(1000 * Gumbel noise) from the hash of ``seed`` and the id."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("null")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def drawn(scored: DataFrame, min_words: int, percent: int) -> DataFrame:
    """``scored`` (id, n_words, score, ...) plus ``rank`` among the drawn rows, else null."""
    spark = scored.sparkSession
    order = [F.desc("score"), F.asc_nulls_last("id"), F.asc("row")]
    dealt = saved(scored.withColumn("row", F.monotonically_increasing_id()), "scored")
    fit = dealt.where(F.col("n_words") >= min_words)
    most = percent * fit.count() // 100
    fit = saved(fit.repartitionByRange(partitions(spark), *order).withColumn("part", F.spark_partition_id()), "ranges")
    sizes = fit.groupBy("part").agg(F.count(F.lit(1)).alias("n"))           # one row for each task of the sort
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    ranges = fit.join(F.broadcast(starts), "part")
    within = Window.partitionBy("part").orderBy(*order)
    ranked = ranges.where(F.col("before") < most).withColumn("rank", F.col("before") + F.row_number().over(within))
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= most, F.col("rank")).cast("long"))
    none = F.lit(None).cast("long")
    others = ranges.where(F.col("before") >= most).withColumn("rank", none)
    short = dealt.where(F.col("n_words") < min_words).withColumn("rank", none)
    return ranked.unionByName(others).drop("part", "before").unionByName(short).drop("row")


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text",
             max_words: int = 1, buckets: int = BUCKETS, seed: int = SEED, min_words: int = MIN_WORDS,
             percent: int = PERCENT, dictionary: int = DICTIONARY) -> DataFrame:
    """(id, n_words, n_features, weight, score, rank) of every document: of those with at least
    ``min_words`` words, ``percent`` of a hundred (rounded down) are drawn."""
    spark = docs.sparkSession
    mine = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    theirs = target.select(F.col(target_col).alias("text"))
    words = spark.sparkContext.broadcast(dictionary_of(mine.select("text").unionByName(theirs), dictionary))
    corpus = bucket_counts(mine.select("text"), words, max_words, buckets)
    gain = gains(corpus, bucket_counts(theirs, words, max_words, buckets))
    scored = weights(mine, words, gain, max_words).withColumn("score", F.col("weight") + noise(seed))
    return drawn(scored, min_words, percent)

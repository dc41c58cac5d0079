"""Packing of tokenised documents into sequences by a configuration linear program.

1. Each document is tokenised once, in the task that reads it, and closed by the end
   id.  A document longer than a sequence is cut from its end into full pieces, so only
   its first piece may be shorter.
2. The histogram of piece lengths (as many numbers as a sequence has tokens) is all
   that reaches the driver.  There the program "choose how often to use each pattern of
   lengths, cover all pieces, use few patterns" is solved by multiplicative weights: a
   knapsack table prices patterns under the present weights; the least covered lengths
   each open one pattern within a thousandth of the best, used as often as covers the
   scarcest of its lengths once; and the weight of a length shrinks by the factor
   exp(-rate) each time that its pieces are covered once more, so lengths that few good
   patterns hold get dearer than the others.  Rounds end once the least covered length
   has ``EVEN`` times the coverage of the most covered one.
3. The solution averaged over the rounds, scaled so that it covers pieces once in the
   mean, is rounded to whole uses for half of the pieces, most used patterns first, and
   what would cover a piece twice is trimmed.  The pieces left are a program of the same
   kind, whose prices make up for the rounding before, and so on; the last of a few passes
   takes all it can.  The remainder of the rounding (under a fiftieth of the pieces on the
   given tables) goes to its best fit, longest first, in bulk by length.  On a small histogram,
   where one sequence is a large share, rounding may cost one that best fit alone would
   not; then best fit's plan is taken.
4. The plan has one row for each (pattern, length), at most a few for each length,
   whatever the number of documents.  Pieces get their rank within their length by
   counts of hash parts, so a length that a third of all pieces have is dealt over all
   parts, and find their sequence and place by a join with the plan.

Defined results: a null text counts as empty and is one piece, the end id alone; rows
with equal ids are packed each for itself; an empty table gives no rows; other columns
are never read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .byte_pairs import encoder as _encoder
from .common import partitions, saved
from .kneser_ney import slices

CAPACITY = 2048
ROUNDS = 150                # rounds of multiplicative weights at most, half as many in later passes
RATE = 0.01                 # how fast the weight of a covered length shrinks
PASSES, OPENED = 5, 256     # programs, one for what the last left, and patterns that take a step in a round
NEAR, EVEN = 0.999, 0.8     # worth of a pattern against the best; coverage of the least against the most covered length
END_ID = 0


# -- tokens ---------------------------------------------------------------------

def pieces(docs: DataFrame, vocabulary: str, ranks: str | None = None, id_col: str = "doc_id", text_col: str = "text",
           capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """(id, piece, start, length, ids_crc32[, ids]) of each piece of each document."""
    def run(batches):
        encode = _encoder(vocabulary, ranks, END_ID)
        for batch in batches:
            for some in slices(batch, "text"):
                rows: list[list] = [[], [], [], [], [], []]
                for at, text in enumerate(some.column("text").to_pylist()):
                    ids = encode(text or "")
                    first = len(ids) % capacity or min(len(ids), capacity)
                    edges = [0, *range(first, len(ids) + 1, capacity)]
                    for k in range(len(edges) - 1):
                        part = ids[edges[k]:edges[k + 1]]
                        for col, x in zip(rows, (at, k, edges[k], len(part), zlib.crc32(part.tobytes()), part), strict=True):
                            col.append(x)
                cols = [some.column("id").take(pa.array(rows[0], pa.int64())), pa.array(rows[1], pa.int32()),
                        *(pa.array(x, pa.int64()) for x in rows[2:5])]
                names = ["id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    cols.append(pa.array([x.astype(np.int32) for x in rows[5]], pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(cols, names=names)

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids)


# -- the program ------------------------------------------------------------------

def knapsack(value: np.ndarray) -> np.ndarray:
    """The worth of the best pattern for each room 0, 1, ..; ``value[l]`` is length l's (0: not there)."""
    lengths = np.flatnonzero(value > 0)
    worth, best = value[lengths], np.zeros(len(value))
    fitting = np.searchsorted(lengths, np.arange(len(value)), "right")
    for c in range(1, len(value)):
        n = fitting[c]
        best[c] = max(best[c - 1], (best[c - lengths[:n]] + worth[:n]).max()) if n else best[c - 1]
    return best


def pattern_from(first: int, best: np.ndarray, value: np.ndarray, need: np.ndarray, covered: np.ndarray,
                 near: float = NEAR) -> dict[int, int]:
    """A pattern with length ``first`` worth ``near`` times the best one, or as much as can be.

    Of the lengths that keep it so, the least covered is put in next; no length more often than
    there are pieces.
    """
    lengths = np.flatnonzero(value > 0)
    pattern, room, got = {first: 1}, len(value) - 1 - first, value[first]
    while n := int(np.searchsorted(lengths, room, "right")):
        some = lengths[:n]
        total = got + value[some] + best[room - some]
        for l, k in pattern.items():
            if l <= room and k >= need[l]:
                total[np.searchsorted(some, l)] = -1.0
        good = np.flatnonzero(total >= near * best[-1])
        at = good[covered[some[good]].argmin()] if len(good) else total.argmax()
        if total[at] < 0:
            break
        l = int(some[at])
        pattern[l] = pattern.get(l, 0) + 1
        room, got = room - l, got + value[l]
    return pattern


def averaged(demand: np.ndarray, rounds: int, rate: float = RATE) -> list[tuple[dict[int, int], float]]:
    """Patterns with their fractional use, by multiplicative weights; pieces are covered once in the mean."""
    need = demand.astype(float)
    have = np.flatnonzero(need)
    covered = np.zeros_like(need)               # how many times the pieces of a length are covered
    uses: dict[tuple, float] = {}
    for _ in range(rounds):
        value = np.zeros_like(need)
        value[have] = have * np.exp(-rate * (covered[have] - covered[have].min()))
        best = knapsack(value)
        for first in have[np.lexsort((-have, covered[have]))][:OPENED].tolist():
            pattern = pattern_from(first, best, value, need, covered)
            step = min(need[l] / k for l, k in pattern.items())
            for l, k in pattern.items():
                covered[l] += step * k / need[l]
            key = tuple(sorted(pattern.items(), reverse=True))
            uses[key] = uses.get(key, 0.0) + step
        if covered[have].min() >= EVEN * covered.max():
            break
    mean = (covered * need).sum() / need.sum()
    return [(dict(k), x / mean) for k, x in uses.items()]


def best_fit(demand: np.ndarray) -> list[tuple[dict[int, int], int]]:
    """Best fit, longest first, for all pieces of one length at once."""
    capacity = len(demand) - 1
    open_bins: list[list[tuple[tuple, int]]] = [[] for _ in range(capacity + 1)]   # by room left: (lengths, number)
    for l in range(capacity, 0, -1):
        left = int(demand[l])
        for room in range(l, capacity + 1):
            if not left:
                break
            while left and open_bins[room]:
                held, n = open_bins[room].pop()
                use = min(n, left)
                if use < n:
                    open_bins[room].append((held, n - use))
                open_bins[room - l].append((held + (l,), use))
                left -= use
        if left:                                # new sequences, each with as many as fit
            per, over = capacity // l, left % (capacity // l)
            if left >= per:
                open_bins[capacity - per * l].append(((l,) * per, left // per))
            if over:
                open_bins[capacity - over * l].append(((l,) * over, 1))
    count = lambda held: {l: held.count(l) for l in sorted(set(held), reverse=True)}
    return [(count(held), n) for bins in open_bins for held, n in bins]


def _whole(left: np.ndarray, uses: list[tuple[dict[int, int], float]], share: float) -> list[tuple[dict[int, int], int]]:
    """``share`` of ``uses`` as whole numbers (one at least) until that share of the pieces is
    held; they are taken from ``left``."""
    chosen, goal = [], left.sum() * (1 - share)
    for pattern, x in sorted(uses, key=lambda p: -p[1]):
        if left.sum() <= goal:
            break
        n = min(max(1, round(x * share)), *(int(left[l]) // k for l, k in pattern.items()))
        if n > 0:
            chosen.append((pattern, n))
            for l, k in pattern.items():
                left[l] -= n * k
    return chosen


def program(demand: np.ndarray, rounds: int = ROUNDS) -> tuple[list[tuple[dict[int, int], int]], np.ndarray]:
    """Patterns with whole uses by the configuration program, and the pieces that rounding left."""
    left, chosen = demand.astype(np.int64).copy(), []
    for k in range(PASSES):
        if not left.any():
            break
        uses = averaged(left, rounds if k == 0 else max(1, rounds // 2))
        chosen += _whole(left, uses, 0.5 if k < PASSES - 1 else 1.0)
    return chosen, left


def plan(demand: np.ndarray, rounds: int = ROUNDS) -> list[tuple[dict[int, int], int]]:
    """Patterns with whole uses that hold every piece exactly once; ``demand[l]`` pieces of length l."""
    chosen, left = program(demand, rounds)
    return min(chosen + best_fit(left), best_fit(demand), key=lambda p: sum(n for _, n in p))


# -- placing ------------------------------------------------------------------------

def _ranked(parts: DataFrame, n_parts: int) -> DataFrame:
    """``parts`` plus ``rank``, its number (from 0) among all pieces of its length."""
    dealt = parts.withColumn("part", F.pmod(F.xxhash64("id", "piece", "ids_crc32"), F.lit(n_parts)).cast("int"))
    counts = dealt.groupBy("length", "part").agg(F.count(F.lit(1)).alias("c"))       # n_parts rows a length
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("length", "part", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("before"))
    within = Window.partitionBy("length", "part").orderBy("id", "piece", "start")
    return (dealt.withColumn("k", F.row_number().over(within)).join(starts, ["length", "part"])
            .withColumn("rank", F.col("before") + F.col("k") - 1).drop("part", "k", "before"))


def pack(parts: DataFrame, capacity: int = CAPACITY, rounds: int = ROUNDS) -> DataFrame:
    """``parts`` (id, piece, start, length, ...) plus ``sequence_id`` and ``offset``."""
    spark = parts.sparkSession
    demand = np.zeros(capacity + 1, np.int64)
    for r in parts.groupBy("length").agg(F.count(F.lit(1)).alias("c")).collect():      # ``capacity`` rows at most
        demand[r.length] = r.c
    rows, used, seq = [], np.zeros(capacity + 1, np.int64), 0
    for pattern, n in plan(demand, rounds):
        place = 0
        for l, k in pattern.items():
            rows.append((l, int(used[l]), int(used[l] + n * k), k, seq, place))
            used[l] += n * k
            place += l * k
        seq += n
    assert (used == demand).all()
    places = spark.createDataFrame(rows, "length long, lo long, hi long, per int, base long, place long")
    ranked = _ranked(parts, partitions(spark)).alias("r")
    p = F.broadcast(places.alias("p"))                # bounded by the lengths and rounds
    found = ranked.join(p, (F.col("r.length") == F.col("p.length")) & (F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi")))
    at = F.col("rank") - F.col("lo")
    return found.select("r.*", (F.col("base") + F.floor(at / F.col("per"))).cast("long").alias("sequence_id"),
                        (F.col("place") + (at % F.col("per")) * F.col("r.length")).cast("long").alias("offset")).drop("rank")


def pack_documents(docs: DataFrame, vocabulary: str, ranks: str | None = None, id_col: str = "doc_id",
                   text_col: str = "text", capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Pieces of all documents with their sequence and their place in it."""
    return pack(saved(pieces(docs, vocabulary, ranks, id_col, text_col, capacity, with_ids), "pieces"), capacity)

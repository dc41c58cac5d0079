"""Exact n-gram Jaccard join through a token-group matrix.

Each text is the set of hashes of its word shingles; equal sets are one set.

1. All tokens are put in one global order: common ones last, by an exact count of
   token hashes in a table of fixed size (``frequency_bits``), then by hash.  Two sets
   with the required similarity share one of their first tokens (the prefix), as long
   as a prefix leaves out fewer tokens than the required overlap.  Prefix tokens of one
   set only are dropped where the prefixes are dealt by token, before anything is written.
2. Each set has a sketch, a table of one-byte sums of its tokens by bucket: two sets
   differ in at least as many tokens as their sketches differ in buckets.
3. Sets are partitioned into groups of similar sets: those that have the same smallest
   token under one of a few hash orders, and whose sketches look alike, go together.
4. The token-group matrix holds, for each group, the union of the prefix tokens of its
   members, with the range of their sizes.  A set meets the other groups that share a
   prefix token with it and have a member of fitting size, if the token, as the first one
   shared, leaves both enough tokens behind it for the overlap; of two groups the smaller
   asks.  All sets of a group meet their own.  Groups that are not met stay closed.
5. A group met is opened by blocks of members.  Inside a task the sketches bound each
   overlap; only sets with a pair that could reach the required one send their tokens to
   the block.  There all such pairs are compared exactly, but for those whose sets hang
   together by links found before in the block.

A group of copies never becomes pairs of rows: equal sets are joined by their hash, and
members of one group meet in blocks inside a task, which returns fewer links than it has
sets.  Many queries of one block are dealt over tasks, each with a copy of its members.

Defined results: A-Z lower-cased; fewer words than the width give one token; null and
blank texts have an empty set and no links; rows with equal ids each have their own
set and link as any others; a row with a null id links with nothing and has a null
component; an empty table gives no rows; other columns are never read.  A set is
known by 64 bits of hash.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import partitions, saved
from .components import components
from .kneser_ney import slices
from .words import hash_words, mix, shingles

FREQUENCY_BITS = 20         # the frequency table has so many counters at most, at 8 bytes each
ORDERS = 4                  # hash orders by whose smallest token a set finds a group
ALIKE = 60                  # percent: sets that look less alike are not put in one group
BLOCK = 512                 # members of a group, and queries, compared at once
TASK_ROWS = 20_000          # queries and members in one task, on average
_PAIRS = 1 << 20            # pairs of sketches compared at once in a task


def shingle_sets(column, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(tokens of all rows, sorted and distinct within a row; tokens by row; hash of each set)."""
    words, counts = hash_words(column)
    token, n = shingles(words, counts, width)
    row = np.repeat(np.arange(len(n)), n)
    order = np.argsort(token, kind="stable")
    order = order[np.argsort(row[order], kind="stable")]
    token, row = token[order], row[order]
    first = np.ones(len(token), bool)
    first[1:] = (token[1:] != token[:-1]) | (row[1:] != row[:-1])
    token, row = token[first], row[first]
    size = np.bincount(row, minlength=len(n))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(token), dtype=np.uint64)])
    end = np.cumsum(size)
    return token, size, mix(total[end] - total[end - size] + size.astype(np.uint64))


def _required(percent: int, size):
    """The least overlap with any similar set: similarity <= overlap / size."""
    return -(-percent * size // 100)


def _by_id(docs, id_col, text_col):
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))


def sketches(token: np.ndarray, size: np.ndarray) -> list[bytes]:
    """One byte for each of about size / 2 buckets (a power of two): the xor of its tokens."""
    width = 1 << np.ceil(np.log2(np.maximum(size / 2, 32))).astype(np.int64)
    starts = np.cumsum(width) - width
    out = np.zeros(int(width.sum()), np.uint8)
    at = np.repeat(starts, size) + (mix(token) & (np.repeat(width, size) - 1).astype(np.uint64)).astype(np.int64)
    np.bitwise_xor.at(out, at, (token >> np.uint64(40)).astype(np.uint8))
    return [out[s:s + w].tobytes() for s, w in zip(starts, width, strict=True)]


def _folded(raw: bytes, width: int) -> np.ndarray:
    """A sketch with fewer buckets: buckets that fall together are summed."""
    x = np.frombuffer(raw, np.uint8)
    return np.bitwise_xor.reduce(x.reshape(-1, width), axis=0)


def _allowed(percent: int, sizes):
    """The most tokens in which two sets of ``sizes`` together may differ."""
    return (100 - percent) * sizes // (100 + percent)


def _differing(raw: list[bytes], i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(buckets in which sketches i and j differ, buckets compared) of each pair."""
    widths = np.array([len(r) for r in raw])
    common = np.minimum(widths[i], widths[j])
    out = np.zeros(len(i), np.int64)
    for w in np.unique(common):
        at = np.flatnonzero(common == w)
        rows = np.unique(np.concatenate([i[at], j[at]]))
        table = np.stack([_folded(raw[r], w) for r in rows])
        for part in np.array_split(at, len(at) * int(w) // (1 << 25) + 1):
            out[part] = (table[np.searchsorted(rows, i[part])] != table[np.searchsorted(rows, j[part])]).sum(1)
    return out, common


def smallest(token: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The smallest token of each (non-empty) row under each hash order, as a number of that order."""
    out = np.zeros((len(size), ORDERS), np.uint64)
    full = size > 0
    if full.any():
        starts = (np.cumsum(size) - size)[full]
        for k in range(ORDERS):
            out[full, k] = np.minimum.reduceat(mix(token + np.uint64(k + 1)), starts)
    return out


def document_sets(docs: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """(id, n, set, sketch, smallest) of each row; ``n`` is the size of the set."""
    def run(batches):
        for batch in batches:
            for some in slices(batch, "text"):
                token, n, key = shingle_sets(some.column("text"), width)
                yield pa.RecordBatch.from_arrays(
                    [some.column("id"), pa.array(n, pa.int64()), pa.array(key.view(np.int64)), pa.array(sketches(token, n), pa.binary()),
                     pa.array(list(smallest(token, n).view(np.int64)), pa.list_(pa.int64()))],
                    names=["id", "n", "set", "sketch", "smallest"])
    kind = docs.schema[id_col].dataType.simpleString()
    return _by_id(docs, id_col, text_col).mapInArrow(run, f"id {kind}, n long, set long, sketch binary, smallest array<long>")


def token_levels(docs: DataFrame, text_col: str, width: int, bits: int) -> np.ndarray:
    """For each hash bucket of tokens how common it is, as a level.

    Counts come from all documents.  The table has 2^bits counters, whatever the input.
    """
    buckets, chunk = 1 << bits, 1 << min(bits, 12)

    def run(batches):
        table = np.zeros(buckets, np.int64)
        for batch in batches:
            for some in slices(batch, text_col):
                token, _, _ = shingle_sets(some.column(text_col), width)
                table += np.bincount((token & np.uint64(buckets - 1)).astype(np.int64), minlength=buckets)
        if table.any():
            small = table.astype(np.uint32 if table.max() < 2**32 else np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(buckets // chunk), pa.int32()),
                                              pa.array([x.tobytes() for x in small.reshape(-1, chunk)], pa.large_binary())],
                                             names=["chunk", "counts"])

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(chunk, np.int64)
        for raw in pdf.counts:
            total += np.frombuffer(raw, np.uint32 if len(raw) == 4 * chunk else np.uint64).astype(np.int64)
        return pd.DataFrame({"chunk": pdf.chunk[:1], "counts": [total.tobytes()]})

    parts = docs.select(text_col).mapInArrow(run, "chunk int, counts binary").groupBy("chunk").applyInPandas(
        add, "chunk int, counts binary").collect()               # 8 * 2^bits bytes in all
    counts = np.zeros((buckets // chunk, chunk))
    for r in parts:
        counts[r.chunk] = np.frombuffer(r.counts, np.int64)
    counts = counts.ravel()
    return _levels(counts)


def _levels(counts: np.ndarray) -> np.ndarray:
    """Counts as levels: steps of a twentieth of their spread near the middle, of a twentieth of e far above.

    A full counter holds many rare tokens, whose number differs by its root only: a token that
    comes a few times as often as that root stands out, long before it comes as often as the middle.
    """
    middle = max(np.median(counts), 1.0)
    return np.clip(60 + 20 * np.arcsinh((counts - middle) / np.sqrt(middle)), 0, 255).astype(np.uint8)


def _ordered(token, size, levels):
    """Tokens of each row in the global order, and their ranks within the row."""
    level = levels[(token & np.uint64(len(levels) - 1)).astype(np.int64)]
    row = np.repeat(np.arange(len(size)), size)
    order = np.lexsort((token, level, row))
    start = np.cumsum(size) - size
    return token[order], np.arange(len(token)) - np.repeat(start, size), row


def prefixes(docs, text_col, width, percent, levels) -> DataFrame:
    """(token, rank, set, n): of the prefix of each distinct set the tokens that another prefix has too."""
    def run(batches):
        seen: set[int] = set()                  # a task's sets, so that copies in it are dealt once
        for batch in batches:
            for some in slices(batch, text_col):
                token, n, key = shingle_sets(some.column(text_col), width)
                _, first = np.unique(key, return_index=True)
                one = np.zeros(len(n), bool)
                one[[i for i, k in zip(first.tolist(), key[first].tolist(), strict=True) if n[i] and k not in seen]] = True
                seen.update(key[one].tolist())
                token = token[np.repeat(one, n)]
                n, key = n[one], key[one]
                ordered, rank, row = _ordered(token, n, levels)
                keep = rank < (n - _required(percent, n) + 1)[row]
                yield pa.RecordBatch.from_arrays([
                    pa.array(ordered[keep].view(np.int64)), pa.array(rank[keep], pa.int32()),
                    pa.array(key[row[keep]].view(np.int64)), pa.array(n[row[keep]], pa.int64())],
                    names=["token", "rank", "set", "n"])
    # dealt by token once: copies and tokens of one set go before anything is written
    rows = docs.select(text_col).mapInArrow(run, "token long, rank int, set long, n long").repartition("token")
    rows = rows.groupBy("token", "set", "n").agg(F.min("rank").alias("rank"))
    return rows.withColumn("sets", F.count(F.lit(1)).over(Window.partitionBy("token"))).where("sets > 1").drop("sets")


def _tokens_of(rows: DataFrame, width: int) -> DataFrame:
    """(set, tokens): the whole set of each of ``rows`` (set, text) whose text has that set."""
    def run(batches):
        for batch in batches:
            for some in slices(batch, "text"):
                token, n, key = shingle_sets(some.column("text"), width)
                end, names = np.cumsum(n), np.asarray(some.column("set"))
                right = np.flatnonzero(key.view(np.int64) == names)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names[right]), pa.array([token[end[i] - n[i]:end[i]].tobytes() for i in right], pa.large_binary())],
                    names=["set", "tokens"])
    return rows.select("set", "text").mapInArrow(run, "set long, tokens binary")


def _alike(pairs: DataFrame, percent: int) -> DataFrame:
    """(a, b) of those of ``pairs`` (a, b, na, nb, ka, kb) whose sketches look alike."""
    def run(batches):
        for b in batches:
            raw = [x.as_py() for c in ("ka", "kb") for x in b.column(c)]
            n = len(raw) // 2
            got, width = _differing(raw, np.arange(n), np.arange(n) + n)
            most = _allowed(percent, np.asarray(b.column("na")) + np.asarray(b.column("nb")))
            keep = pa.array(got <= width * -np.expm1(-most / width))      # as many buckets as that many tokens hit
            yield pa.RecordBatch.from_arrays([b.column(c).filter(keep) for c in ("a", "b")], names=["a", "b"])
    return pairs.mapInArrow(run, "a long, b long")


def _possible(q: pd.DataFrame, m: pd.DataFrame, raw: list[bytes], percent: int):
    """Yields (i, j): query and member rows of one block that their sketches do not keep apart.

    Both frames are sorted by block; ``raw`` holds the sketches of the queries, then the members.
    """
    sq, sm, nq, nm, own = q.set.to_numpy(), m.set.to_numpy(), q.n.to_numpy(), m.n.to_numpy(), q.own.to_numpy(bool)
    lo, hi = (np.searchsorted(m.block.to_numpy(), q.block.to_numpy(), side) for side in ("left", "right"))
    reach, at = np.cumsum(hi - lo), 0
    while at < len(q):
        end = max(at + 1, int(np.searchsorted(reach, (reach[at - 1] if at else 0) + _PAIRS, "right")))
        k = (hi - lo)[at:end]
        i = np.repeat(np.arange(at, end), k)
        j = np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k) + np.repeat(lo[at:end], k)
        fit = (~own[i] | (sq[i] < sm[j])) & (sq[i] != sm[j])
        fit &= (nq[i] * 100 >= nm[j] * percent) & (nm[j] * 100 >= nq[i] * percent)
        i, j = i[fit], j[fit]
        if len(i):
            got, _ = _differing(raw, i, j + len(q))
            fit = got <= _allowed(percent, nq[i] + nm[j])
            yield i[fit], j[fit]
        at = end


def _sides(pdf: pd.DataFrame) -> tuple[pd.DataFrame, pd.DataFrame]:
    return tuple(pdf[pdf.asks == side].sort_values(["block", "set"]) for side in (True, False))


def _survivors(percent: int):
    """Of a task's rows those with a pair that could be similar enough."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        q, m = _sides(pdf)
        keep_q, keep_m = np.zeros(len(q), bool), np.zeros(len(m), bool)
        for i, j in _possible(q, m, [*q.sketch, *m.sketch], percent):
            keep_q[i] = keep_m[j] = True
        return pd.concat([q[keep_q], m[keep_m]])[["block", "set", "n", "own", "asks"]]
    return run


def _links(percent: int):
    """Exact links of a task's blocks, at most one fewer than a block has sets."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        q, m = _sides(pdf)
        tokens = {s: np.frombuffer(t, np.uint64) for s, t in zip(pdf.set, pdf.tokens, strict=True)}
        raw = {s: sketches(t, np.array([len(t)]))[0] for s, t in tokens.items()}
        out, root = [], {}
        sq, sm = q.set.to_numpy(), m.set.to_numpy()

        def find(x):
            while (up := root.get(x, x)) != x:
                root[x] = root.get(up, up)
                x = up
            return x

        for i, j in _possible(q, m, [raw[s] for s in [*sq, *sm]], percent):
            for a, b in zip(sq[i].tolist(), sm[j].tolist(), strict=True):
                top_a, top_b = find(a), find(b)
                if top_a != top_b:
                    x, y = tokens[a], tokens[b]
                    shared = int((x[np.minimum(np.searchsorted(x, y), len(x) - 1)] == y).sum())
                    if 100 * shared >= percent * (len(x) + len(y) - shared):
                        root[top_b] = top_a
                        out.append((a, b))
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")
    return run


def similar_sets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5,
                 percent: int = 80, frequency_bits: int = FREQUENCY_BITS) -> tuple[DataFrame, DataFrame]:
    """((id, n, set) of each document, (id, component) of the sets with links): every two sets
    with 100 * overlap >= percent * union are in one component, which such links make."""
    spark = docs.sparkSession
    docs = docs.where(F.col(id_col).isNotNull())
    by_doc = saved(document_sets(docs, id_col, text_col, width), "sets")
    levels = token_levels(docs, text_col, width, frequency_bits)
    prefix = saved(prefixes(docs, text_col, width, percent, levels), "prefixes")
    # the sketch and size of the document with the smallest id of each set
    chosen = saved(by_doc.where("n > 0").groupBy("set").agg(F.min(F.struct("id", "n", "sketch", "smallest")).alias("d")).select(
        "set", F.col("d.id").alias("id"), F.col("d.n").alias("n"), F.col("d.sketch").alias("sketch"),
        F.col("d.smallest").alias("smallest")), "chosen")

    # groups: sets with the same smallest token as another, that look alike
    starts = chosen.select("set", "n", F.posexplode("smallest").alias("order", "token"))
    heads = starts.groupBy("order", "token").agg(F.min(F.struct("set", "n")).alias("h"), F.count(F.lit(1)).alias("c")).where("c > 1")
    near = (starts.join(heads, ["order", "token"]).where(F.col("set") != F.col("h.set"))
            .select(F.col("h.set").alias("a"), F.col("set").alias("b"), F.col("h.n").alias("na"), F.col("n").alias("nb"))
            .where((F.col("na") * 100 >= F.col("nb") * ALIKE) & (F.col("nb") * 100 >= F.col("na") * ALIKE)).distinct())
    kinds = lambda k: chosen.select(F.col("set").alias(k), F.col("sketch").alias(f"k{k}"))
    alike = _alike(near.join(kinds("a"), "a").join(kinds("b"), "b"), ALIKE)
    group = components(alike).select(F.col("id").alias("set"), F.col("component").alias("group"))

    # the matrix: (token, group) of all groups; only tokens of more than one group can lead on
    own = F.coalesce("group", F.col("set"))
    # the first token that two sets share leaves them (100 + percent) * (n - rank) >= percent * (both sizes): ``room``
    room = ((100 + percent) * (F.col("n") - F.col("rank")) - percent * F.col("n")).alias("room")
    grouped = saved(prefix.join(group, "set", "left").select("token", "set", "n", room, own.alias("group")), "grouped")
    shared = grouped.groupBy("token").agg(F.min("group").alias("lo"), F.max("group").alias("hi")).where("lo <> hi")
    grouped = saved(grouped.join(shared.select("token"), "token", "left_semi"), "shared-tokens")
    members = group.groupBy("group").agg(F.count(F.lit(1)).alias("members"))
    matrix = grouped.groupBy("token", "group").agg(F.min("n").alias("least"), F.max("n").alias("most"), F.max("room").alias("rooms"))
    matrix = matrix.join(members, "group", "left").select(
        "token", F.col("group").alias("other"), "least", "most", "rooms", F.coalesce("members", F.lit(1)).alias("others"))
    asking = grouped.join(members, "group", "left").select(
        "token", "set", "n", "room", "group", F.coalesce("members", F.lit(1)).alias("members"))
    met = (asking.join(matrix, "token")
           .where((F.struct("members", "group") < F.struct("others", "other"))
                  & (F.col("n") * 100 >= F.col("least") * percent) & (F.col("most") * 100 >= F.col("n") * percent)
                  & (F.col("room") >= F.col("least") * percent) & (F.col("rooms") >= F.col("n") * percent))
           .select("set", F.col("other").alias("group")).distinct())
    met = saved(met, "met-groups")

    # blocks of the groups met, their own included: at most BLOCK members or so, dealt by hash
    # the groups are written first: else the anti-join would be done for each row of ``met``
    alone = saved(met.select("group").distinct(), "groups").join(members, "group", "left_anti")
    parts = members.select("group", F.ceil(F.col("members") / BLOCK).cast("int").alias("parts"))
    inside = (group.join(parts, "group").select("set", "group", F.pmod(F.xxhash64("set"), F.col("parts")).cast("int").alias("part"))
              .unionByName(alone.select(F.col("group").alias("set"), "group", F.lit(0).alias("part"))))
    held = saved(inside.select("set", "group", F.xxhash64("group", "part").alias("block")), "blocks")
    blocks = held.select("group", "block").distinct()
    asked = saved(met.withColumn("own", F.lit(False)).unionByName(group.select("set", "group", F.lit(True).alias("own")))
                  .join(blocks, "group").select("set", "block", "own"), "asked")
    parts = asked.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("parts"))
    rows = (asked.join(parts, "block").withColumn("part", F.pmod(F.xxhash64("set"), F.col("parts")).cast("int"))
            .select("block", "part", "set", "own", F.lit(True).alias("asks"))
            .unionByName(held.join(parts, "block").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
                         .select("block", "part", "set", F.lit(False).alias("own"), F.lit(False).alias("asks"))))
    rows = saved(rows.join(chosen.select("set", "n", "sketch"), "set").withColumn("block", F.xxhash64("block", "part")).drop("part"), "meetings")
    tasks = max(partitions(spark), rows.count() // TASK_ROWS + 1)

    dealt = lambda df: df.withColumn("task", F.pmod(F.xxhash64("block", F.lit(1)), F.lit(tasks))).groupBy("task")
    left = saved(dealt(rows).applyInPandas(_survivors(percent), "block long, set long, n long, own boolean, asks boolean"), "survivors")
    wanted = chosen.join(left.select("set").distinct(), "set", "left_semi").select("set", "id")
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    tokens = _tokens_of(texts.join(wanted, "id"), width).dropDuplicates(["set"])
    links = dealt(left.join(tokens, "set")).applyInPandas(_links(percent), "a long, b long")
    return by_doc.select("id", "n", "set"), components(links)


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5,
                       percent: int = 80, frequency_bits: int = FREQUENCY_BITS) -> DataFrame:
    """(id, n, component): for each document the size of its set and the smallest id reachable
    by links of similar documents, itself included."""
    by_doc, joined = similar_sets(docs, id_col, text_col, width, percent, frequency_bits)
    sets = by_doc.groupBy("set").agg(F.min("id").alias("least")).join(joined.withColumnRenamed("id", "set"), "set", "left")
    classes = sets.select("set", "least", F.coalesce("component", F.col("set")).alias("class"))
    least = classes.groupBy("class").agg(F.min("least").alias("component"))
    named = classes.select("set", "class").join(least, "class").select("set", "component")
    unnamed = document_sets(docs.where(F.col(id_col).isNull()), id_col, text_col, width)
    return by_doc.join(named, "set").select(
        "id", "n", F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("id")).alias("component")).unionByName(
        unnamed.select("id", "n", F.col("id").alias("component")))

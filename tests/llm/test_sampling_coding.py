"""Operators 11 to 13: range-coded token files, importance resampling, integer k-means."""

import hashlib
import math
import os
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from feedlens.llm import centroids as C
from feedlens.llm import importance as I
from feedlens.llm import queries as Q
from feedlens.llm import range_coder as R
from feedlens.llm import token_files as T

SF = "/root/testdata/sf0.001"


# -- range coder ----------------------------------------------------------------------

@settings(max_examples=25, deadline=None)
@given(st.integers(0, 3 * 32 * 256 + 5), st.integers(1, 3000), st.integers(0, 2**31))
def test_coder_gives_back_all_symbols(n, kinds, seed):
    rng = np.random.default_rng(seed)
    ids = (rng.integers(0, kinds, n) ** 2 % 70_000).astype(np.uint32)
    if not n:
        return
    table = R.Table.from_bytes(R.Table.of_counts(*np.unique(ids, return_counts=True)).to_bytes())
    raw = R.encode(ids, table, block=8192)
    blocks = [R.Block(memoryview(b)) for b in raw]
    parts = [(b, c) for b in blocks for c in range(len(b.points))]
    whole = R.decode(parts, table, table.slots())
    assert (np.concatenate(whole) == ids).all()
    alone = R.decode(parts[-1:], table, table.slots())          # from a checkpoint, without what is before it
    assert (alone[0] == whole[-1]).all()


def test_coder_is_near_the_entropy():
    ids = np.minimum(np.random.default_rng(1).zipf(1.3, 400_000), 5000).astype(np.uint32)
    _, counts = np.unique(ids, return_counts=True)
    p = counts / counts.sum()
    table = R.Table.of_counts(*np.unique(ids, return_counts=True))
    bits = 8 * sum(map(len, R.encode(ids, table))) / len(ids)
    assert bits < -(p * np.log2(p)).sum() + 0.4


def test_one_symbol_only_and_unknown_symbol():
    table = R.Table.of_counts(np.array([7]), np.array([10]))
    raw = R.encode(np.full(100, 7, np.uint32), table)
    assert R.decode([(R.Block(raw[0]), 0)], table, table.slots())[0].tolist() == [7] * 100
    with pytest.raises(ValueError):
        R.encode(np.array([8], np.uint32), table)


def test_damage_is_noticed():
    ids = np.random.default_rng(2).integers(0, 500, 9000).astype(np.uint32)
    table = R.Table.of_counts(*np.unique(ids, return_counts=True))
    raw = R.encode(ids, table)[0]
    for at in (2, 30, 200, len(raw) - 3000):                   # head, checkpoints, words
        bad = bytearray(raw)
        bad[at] ^= 4
        with pytest.raises(ValueError):
            block = R.Block(bytes(bad))
            R.decode([(block, c) for c in range(len(block.points))], table, table.slots())
    frequencies = bytearray(table.to_bytes())
    frequencies[20] ^= 1
    with pytest.raises(ValueError):
        R.Table.from_bytes(bytes(frequencies))


# -- token files --------------------------------------------------------------------------

def brute_tokens(rows):
    tokenizer, start, out = Tokenizer.from_file(Q.VOCABULARY), 0, []
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        out.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def token_docs(spark, rows, parts=3):
    return spark.createDataFrame([(t, i, "x", 1) for i, t in rows], "text string, doc_id long, ids string, part int").repartition(parts)


def test_files_match_brute_force(spark):
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choices(["straße", "the", "ñu", "<|endoftext|>", "word", "\n\n", "日本"], k=rng.randint(0, 80)))) for i in range(300)]
    rows += [(1000, None), (1001, ""), (-5, "negative id"), (None, "no id"), (2000, "long " * 300_000)]
    got = T.read(spark, T.write(token_docs(spark, rows), Q.VOCABULARY, Q.RANKS), with_ids=True).collect()
    assert sorted(((r.id, r.start, r.n_tokens, r.ids_crc32) for r in got), key=lambda r: r[1]) == brute_tokens(rows)
    assert all(len(r.ids) == r.n_tokens and zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 for r in got)


def test_files_with_one_hot_id_and_repeated_rows(spark):
    rows = [(7, f"text {i % 3}") for i in range(200)] + [(i, "a") for i in range(5)]
    files = T.write(token_docs(spark, rows), Q.VOCABULARY)
    got = T.read(spark, files).orderBy("start").collect()
    assert [r.id for r in got] == sorted(r[0] for r in rows)
    assert [r.start for r in got] == [sum(r.n_tokens for r in got[:k]) for k in range(len(got))]
    want = Counter((i, n, c) for i, _, n, c in brute_tokens(rows))
    assert Counter((r.id, r.n_tokens, r.ids_crc32) for r in got) == want
    assert files.units.where("doc_to > doc_from").select("path").distinct().count() > 1     # the hot id is in several files


def test_files_of_an_empty_table(spark):
    assert T.read(spark, T.write(token_docs(spark, [], 1), Q.VOCABULARY)).count() == 0


def test_units_end_at_documents_and_damage_stops_the_read(spark, monkeypatch):
    monkeypatch.setattr(T, "UNIT", 50)
    ids = [np.arange(n, dtype=np.uint32) % 9 for n in (20, 20, 20, 200, 1, 40)]
    folder = T.scratch(spark, "one")
    table = R.Table.of_counts(*np.unique(np.concatenate(ids), return_counts=True))
    writer = T.Writer(f"{folder}/file", table)
    for k, x in enumerate(ids):
        writer.add(k, x)
    assert writer.close() == [(0, 2, 40), (2, 3, 20), (3, 4, 200), (4, 6, 41)]
    with T.Reader(f"{folder}/file", table, table.slots()) as r:
        r.verify_index()
        assert np.concatenate([*r.ids(60, 261)]).tolist() == [*ids[3], *ids[4]]
    path = T.filesystem(f"{folder}/file")[1]
    with open(path, "r+b") as f:
        f.seek(os.path.getsize(path) - T._FOOT.size - 3)
        f.write(b"\x01")
    with T.Reader(f"{folder}/file", table, table.slots()) as r, pytest.raises(ValueError):
        r.verify_index()


# -- importance resampling -------------------------------------------------------------------

def brute_resample(docs, target, max_words, buckets, seed=2024, min_words=20, percent=10):
    def features(t):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda x: x[0].lower(), t or ""))
        return len(w), [zlib.crc32(" ".join(w[i:i + n]).encode()) % buckets for n in range(1, max_words + 1) for i in range(len(w) - n + 1)]
    s = Counter(b for _, t in docs for b in features(t)[1])
    q = Counter(b for t in target for b in features(t)[1])
    ss, qq = sum(s.values()), sum(q.values())
    gain = {b: math.floor(1000 * math.log((q[b] + 1) * (ss + buckets) / ((s[b] + 1) * (qq + buckets)))) for b in s}
    rows = []
    for i, t in docs:
        n, f = features(t)
        h = int(hashlib.sha256(f"{seed}:{'null' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f)
        rows.append([i, n, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    fit = sorted((r for r in rows if r[1] >= min_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    most = percent * len(fit) // 100
    rank = {id(r): k + 1 for k, r in enumerate(fit) if k < most}
    return sorted(((*r, rank.get(id(r))) for r in rows), key=repr)


WORDS = ["alpha", "Beta", "gamma1", "ñandú", "日本", "x", "it's", "--", "a\x00b", "\xa0", "mid·dot", "e.g.", "rare%d"]


def some_docs(n, seed):
    rng = random.Random(seed)
    pick = lambda: rng.choice(WORDS).replace("%d", str(rng.randint(0, 500)))
    return [(i, rng.choice([" ", "  ", "\n"]).join(pick() for _ in range(rng.randint(0, 60)))) for i in range(n)]


def resample_docs(spark, rows, parts=3):
    return spark.createDataFrame([(i, t, 5, "r", 0.5) for i, t in rows], "doc_id long, text string, rank int, id string, weight double").repartition(parts)


@pytest.mark.parametrize("max_words,dictionary", [(1, 50_000), (3, 5), (2, 0)])
def test_resample_matches_brute_force(spark, max_words, dictionary):
    docs = some_docs(300, max_words) + [(1000, None), (1001, ""), (1002, "only Alpha " * 5000), (None, "no id " * 30)]
    target = [t for _, t in some_docs(40, 99)] + [None]
    out = I.resample(resample_docs(spark, docs), spark.createDataFrame([(t,) for t in target], "text string"),
                     max_words=max_words, buckets=997, dictionary=dictionary)
    got = sorted(((r.id, r.n_words, r.n_features, r.weight, r.score, r.rank) for r in out.collect()), key=repr)
    assert got == brute_resample(docs, target, max_words, 997)


def test_resample_of_repeated_rows_and_ties(spark):
    docs = [(1, "word " * 25)] * 60 + [(2, "word " * 25), (3, "few words")]
    out = I.resample(resample_docs(spark, docs), spark.createDataFrame([("word",)], "text string"), percent=50).collect()
    assert len(out) == 62 and sorted(r.rank for r in out if r.rank) == list(range(1, 31))
    best = max(r.score for r in out if r.n_words >= 20)
    assert [r for r in out if r.rank == 1][0].score == best and all(r.rank is None for r in out if r.id == 3)


def test_resample_of_empty_tables(spark):
    none = resample_docs(spark, [], 1)
    assert I.resample(none, none.select("text")).count() == 0
    out = I.resample(resample_docs(spark, [(1, "a " * 30)]), none.select("text"), percent=100).collect()
    assert [(r.n_features, r.rank) for r in out] == [(30, 1)]


def test_scan_needs_no_dictionary_and_cuts_long_texts():
    text = I._plain(" ".join(t for _, t in some_docs(50, 3)))
    want = [(zlib.crc32(w), len(w)) for w in text.split()]
    for words in ([], [b"alpha", b"x"], sorted(set(text.split()))):
        for limit in (7, 1 << 22):
            crc, length = I.scan(text, I.automaton(words), limit)
            assert list(zip(crc.tolist(), length.tolist(), strict=True)) == want


@settings(max_examples=50, deadline=None)
@given(st.lists(st.binary(max_size=40), min_size=1, max_size=8), st.lists(st.binary(max_size=300), min_size=1, max_size=8))
def test_crc_of_joined_strings(first, second):
    pairs = list(zip(first, second, strict=False))
    crc = lambda k: np.array([zlib.crc32(p[k]) for p in pairs], np.uint32)
    got = I.crc_joined(crc(0), crc(1), np.array([len(p[1]) for p in pairs]))
    assert got.tolist() == [zlib.crc32(a + b) for a, b in pairs]


# -- centroids --------------------------------------------------------------------------------

def brute_clusters(rows, k, rounds, dims, scale=1024, seed=3):
    kept = [(i, [math.floor(scale * float(x)) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    key = lambda r: (hashlib.sha256(f"{seed}:{'null' if r[0] is None else r[0]}".encode()).hexdigest(), r[1])
    cents = [v for _, v in sorted(kept, key=key)[:k]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), n) for n, c in enumerate(cents))
    for _ in range(rounds):
        label = [near(v)[1] for _, v in kept]
        cents = [[sum(col) // len(mine) for col in zip(*mine, strict=True)] if (mine := [v for (_, v), x in zip(kept, label, strict=True) if x == n]) else c
                 for n, c in enumerate(cents)]
    found = [(i, *near(v)) for i, v in kept]
    inertia = Counter()
    for _, d, n in found:
        inertia[n] += d
    return sorted(((i, n, d, inertia[n], sum(inertia.values()), hashlib.sha256(",".join(map(str, cents[n])).encode()).hexdigest())
                   for i, d, n in found), key=repr)


def vectors(spark, rows, kind="float"):
    return spark.createDataFrame([(i, v, "c", 1.5) for i, v in rows], f"vec_id long, embedding array<{kind}>, cluster string, lead double").repartition(3)


@pytest.mark.parametrize("kind", ["float", "double"])
def test_clusters_match_brute_force(spark, kind):
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(5, 6))
    rows = [(i, (centres[i % 5] * (i % 7 != 0) + rng.normal(size=6) * 0.3).astype(np.float32).tolist()) for i in range(300)]
    rows += [(i, [0.25, -0.5, 0.0, 0.0, 1.0, -1.0]) for i in range(400, 600)]              # a hot group of one point
    rows += [(700, None), (701, []), (702, [1.0] * 5), (703, [None, *[0.0] * 5]), (704, [math.nan] * 6), (705, [math.inf] * 6),
             (None, [0.5] * 6), (0, rows[0][1]), (706, [-0.0001] * 6)]
    got = C.cluster(vectors(spark, rows, kind), k=7, rounds=4, dims=6, lead=2).collect()
    assert sorted(map(tuple, got), key=repr) == brute_clusters(rows, 7, 4, 6)


def test_ties_go_to_the_smaller_number_and_empty_clusters_stay(spark):
    rows = [(i, [float(x)]) for i, x in enumerate([0, 0, 2, 2, 1, 1, 10])]
    got = C.cluster(vectors(spark, rows), k=5, rounds=3, dims=1).collect()
    assert sorted(map(tuple, got), key=repr) == brute_clusters(rows, 5, 3, 1)


def test_few_vectors_none_and_too_large_ones(spark):
    assert C.cluster(vectors(spark, [])).count() == 0
    assert C.cluster(vectors(spark, [(1, None)])).count() == 0
    got = C.cluster(vectors(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])]), dims=2).collect()
    assert sorted(map(tuple, got), key=repr) == brute_clusters([(1, [1.0, 2.0]), (2, [1.0, 2.0])], 8, 10, 2)
    with pytest.raises(ValueError, match="beyond"):
        C.cluster(vectors(spark, [(1, [1e30, 0.0])]), dims=2)


def test_bounds_never_lose_the_nearest():
    rng = np.random.default_rng(4)
    for scale in (1, 1000, 1 << 26):
        v = rng.integers(-scale, scale + 1, (500, 12))
        cents = np.concatenate([v[:20], rng.integers(-scale, scale + 1, (20, 12))])
        rotation = C.Rotation(v.mean(0), np.cov(v.T), 4)
        label, best = C.nearest(v, *rotation(v), cents, rotation)
        whole = np.square(v[:, None] - cents).sum(2)
        assert (label == whole.argmin(1)).all() and (best == whole.min(1)).all()


# -- registered queries -------------------------------------------------------------------------

def test_token_files_query_against_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = Q.op11_range_coding(spark, SF).collect()
    assert sorted(((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got), key=lambda r: r[1]) == brute_tokens(rows)


# -- mended: late files, targets that cannot hold ---------------------------------------------

def test_a_late_file_with_an_old_time_stamp_counts(spark, tmp_path):
    from feedlens.llm import exact_dedup as X

    folder, state = str(tmp_path / "docs"), str(tmp_path / "state")
    token_docs(spark, [(1, "same"), (2, "other")], 1).write.parquet(folder)
    X.absorb(spark, folder, state)
    before = set(os.listdir(folder))
    token_docs(spark, [(3, "same"), (4, "new")], 1).write.mode("append").parquet(folder)
    for name in set(os.listdir(folder)) - before:
        if name.endswith(".parquet"):
            os.utime(f"{folder}/{name}", (1e9, 1e9))                # many years back
    out = {r.id: (r.keep_id, r.group_size) for r in X.exact_dedup(spark, folder, state_dir=state).collect()}
    assert out == {1: (3, 2), 3: (3, 2), 2: (2, 1), 4: (4, 1)}


def test_targets_that_cannot_hold_are_an_error(spark):
    from feedlens.llm import raking

    cells = spark.createDataFrame([("=a", "=en", 3.0), ("=b", "=fr", 1.0)], "source string, lang string, weight double")
    half = spark.createDataFrame([("a", 0.5), ("b", 0.5)], "category string, share double")
    most = spark.createDataFrame([("en", 0.9), ("fr", 0.1)], "category string, share double")
    with pytest.raises(ValueError, match="do not settle"):
        raking.rake(cells, {"source": half, "lang": most}, max_rounds=6)

import binascii
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import corpus_pipeline as PIPE
from feedlens.llm import cotraining as C
from feedlens.llm import kneser_ney as K
from feedlens.llm import packing as P
from feedlens.llm import queries as Q
from feedlens.llm import raking as R

SF = "/root/testdata/sf0.001"
VOCABULARY, RANKS = Q.VOCABULARY, Q.RANKS
DOCS = "doc_id long, text string, word string, score string"


def docs(spark, rows, parts=3):
    return spark.createDataFrame([(i, t, "w", "s") for i, t in rows], DOCS).repartition(parts)


def some_texts(n, seed=0):
    rng = random.Random(seed)
    words = ["the", "of", "And", "and", *[f"w{k}" for k in range(60)]]
    weights = [60, 30, 10, 20, *[max(1, 20 - k) for k in range(60)]]
    return [" ".join(rng.choices(words, weights, k=rng.randint(0, 60))) for _ in range(n)]


# -- language model -----------------------------------------------------------------

class BruteModel:
    def __init__(self, texts):
        self.big, self.c = Counter(), Counter()
        for t in texts:
            w = self.words(t)
            self.c.update(w)
            self.big.update(zip(["<s>", *w[:-1]], w, strict=True))
        self.after, self.fan, self.m = Counter(), defaultdict(Counter), Counter()
        for (u, w), n in self.big.items():
            self.after[u] += n
            self.fan[u][min(n, 3)] += 1
            self.m[w] += 1
        kinds = lambda c: [sum(1 for x in c.values() if x == k) for k in (1, 2, 3, 4)]
        self.d, self.e = self.discounts(kinds(self.big)), self.discounts(kinds(self.m))
        self.n, self.v, self.mm = sum(self.c.values()), len(self.c), sum(self.m.values())

    @staticmethod
    def words(t):
        low = re.sub("[A-Z]", lambda x: x[0].lower(), t or "")
        return [*re.findall(r"[^\x20\x09-\x0D]+", low), "</s>"]

    @staticmethod
    def discounts(k):
        if not k[0]:
            return [0, 0, 0, 0]
        y = k[0] / (k[0] + 2 * k[1])
        d = [1 - 2 * y * k[1] / k[0], 2 - 3 * y * k[2] / k[1] if k[1] else 1, 3 - 4 * y * k[3] / k[2] if k[2] else 1]
        return [0, *(min(max(x, 0), i + 1) for i, x in enumerate(d))]

    def lower(self, w):
        if not self.mm:
            return 1 / (self.v + 1)
        free = sum(self.e[min(x, 3)] for x in self.m.values()) / self.mm
        x = self.m.get(w, 0)
        return max(x - self.e[min(x, 3)], 0) / self.mm + free / (self.v + 1)

    def p(self, u, w):
        a = self.after.get(u, 0)
        if not a:
            return self.lower(w)
        x = self.big.get((u, w), 0)
        back = sum(self.d[k] * n for k, n in self.fan[u].items()) / a
        return max(x - self.d[min(x, 3)], 0) / a + back * self.lower(w)

    def row(self, t):
        w = self.words(t)
        pairs = list(zip(["<s>", *w[:-1]], w, strict=True))
        return (len(w), sum(x in self.c for x in w), sum(math.log10((self.c[x] + 1) / (self.n + self.v + 1)) for x in w),
                sum(math.log10(self.p(u, x)) for u, x in pairs))


@pytest.mark.parametrize("hot", [0.0, 1.0])
def test_kneser_ney_matches_brute_force(spark, hot):
    train = [*some_texts(80), None, "", "Once", "once once once", "é É ñ", "long " * 30_000]
    test = [*some_texts(30, 1), "never seen these words", "once the never", None, "\t\n", "the\x1cof the\xa0of"]
    brute = BruteModel(train)
    model = K.fit(docs(spark, list(enumerate(train))), sample_of_hot=hot)
    assert (model.tokens, model.vocabulary) == (brute.n, brute.v)
    assert bool(model.hot) == bool(hot)                 # both ways of dealing the contexts
    both = [*train, *test]
    got = {r.doc_id: r for r in K.score(docs(spark, list(enumerate(both))), model).collect()}
    for i, t in enumerate(both):
        n, known, base, score = brute.row(t)
        assert (got[i].n_tokens, got[i].n_known) == (n, known)
        assert got[i].base_score == pytest.approx(base, rel=1e-9, abs=1e-9)
        assert got[i].score == pytest.approx(score, rel=1e-9, abs=1e-9)
    # a distribution: over the vocabulary and one unknown word it sums to 1
    for u in ("<s>", "the", "once", "w3", "unheard"):
        assert sum(brute.p(u, w) for w in [*brute.c, "unheard"]) == pytest.approx(1, abs=1e-9)


def test_kneser_ney_beats_the_base_on_held_out_text(spark):
    out = Q.op6_kneser_ney(spark, SF).where("held_out").collect()
    assert sum(r.score for r in out) > sum(r.base_score for r in out)
    ids = {r.doc_id for r in Q.op6_kneser_ney(spark, SF).where("held_out").collect()}
    assert ids and all(binascii.crc32(str(i).encode()) % 7 == 2 for i in ids)


def test_kneser_ney_without_training(spark):
    model = K.fit(docs(spark, []))
    rows = K.score(docs(spark, [(1, "a b"), (2, None)]), model).collect()
    assert {(r.doc_id, r.n_tokens, r.base_score, r.score) for r in rows} == {(1, 3, 0.0, 0.0), (2, 1, 0.0, 0.0)}
    assert K.score(docs(spark, []), model).count() == 0


# -- packing -----------------------------------------------------------------------------

def slow_ids(text):
    from tokenizers import Tokenizer
    if not hasattr(slow_ids, "t"):
        slow_ids.t = Tokenizer.from_file(VOCABULARY)
    return slow_ids.t.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(st.characters(max_codepoint=0x24F, exclude_categories=["Cs"]), max_size=60),
                 st.text(alphabet="aé ' \u0085\n\t 1½²x's<|endoftext|>", max_size=40), st.text(max_size=40)))
def test_fast_encoder_gives_the_same_ids(text):
    assert list(P._encoder(VOCABULARY, RANKS)(text)) == slow_ids(text)


@settings(max_examples=40, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 40), max_size=12))
def test_plan_holds_every_piece_once(lengths):
    demand = np.zeros(65, np.int64)
    for l, n in lengths.items():
        demand[l] = n
    plan = P.plan(demand)
    held = np.zeros(65, np.int64)
    for pattern, n in plan:
        assert sum(l * k for l, k in pattern.items()) <= 64 and n > 0
        for l, k in pattern.items():
            held[l] += n * k
    assert (held == demand).all()
    total = int((demand * np.arange(65)).sum())
    assert sum(n for _, n in plan) >= -(-total // 64)
    assert sum(n for _, n in plan) <= sum(n for _, n in P.best_fit(demand))


def test_program_finds_a_packing_that_best_fit_misses():
    demand = np.zeros(101, np.int64)
    demand[[50, 49, 26, 25, 24]] = [0, 0, 40, 40, 40]      # 26 + 25 + 25 + 24 fill a sequence
    assert sum(n for _, n in P.plan(demand)) <= sum(n for _, n in P.best_fit(demand))


def test_program_packs_few_hot_lengths():
    demand = np.zeros(2049, np.int64)                      # 1,900 full sequences: 1536 + 512, 1032 + 520 + 496, 2 * 528 + 2 * 496
    demand[[1536, 512, 1032, 528, 520, 496]] = [1000, 1000, 600, 600, 600, 1200]
    plan = P.plan(demand)
    held = np.zeros(2049, np.int64)
    for pattern, n in plan:
        assert sum(l * k for l, k in pattern.items()) <= 2048
        for l, k in pattern.items():
            held[l] += n * k
    assert (held == demand).all()
    assert sum(n for _, n in P.best_fit(demand)) == 2100
    assert sum(n for _, n in plan) <= 1.01 * 1900


@pytest.mark.parametrize("times", [1, 20])
def test_program_holds_the_pieces_of_real_documents(times):
    encode = P._encoder(VOCABULARY, RANKS, P.END_ID)
    demand = np.zeros(2049, np.int64)
    for text in pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["text"]).column(0).to_pylist():
        n = len(encode(text or ""))
        demand[2048] += n // 2048
        demand[n % 2048] += n % 2048 > 0
    demand *= times
    chosen, left = P.program(demand)
    held = left.copy()
    for pattern, n in chosen:
        assert n > 0 and sum(l * k for l, k in pattern.items()) <= 2048
        for l, k in pattern.items():
            held[l] += n * k
    assert (held == demand).all()
    assert left.sum() <= 0.05 * demand.sum()
    packed = sum(n for _, n in chosen) + sum(n for _, n in P.best_fit(left))
    assert packed < sum(n for _, n in P.best_fit(demand))
    assert packed >= -(-int((demand * np.arange(2049)).sum()) // 2048)


def check_packed(rows, texts, capacity):
    by_seq, by_doc = defaultdict(list), defaultdict(list)
    for r in rows:
        by_seq[r.sequence_id].append((r.offset, r.length))
        by_doc[r.id].append(r)
    for places in by_seq.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    for i, t in texts:
        ids = [*slow_ids(t), 0]
        got = sorted(by_doc[i], key=lambda r: r.piece)
        assert [r.piece for r in got] == list(range(len(got)))
        assert all(r.length == capacity for r in got[1:])
        at = 0
        for r in got:
            assert r.start == at
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at:at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    return len(by_seq)


def test_pack_documents(spark):
    texts = [*enumerate(some_texts(60, 4)), (100, None), (101, ""), (102, "a <|endoftext|> b"), (103, "ここ 123 \U0001f600"),
             (104, "same " * 3000), (105, "x" * 100_000)]
    rows = P.pack_documents(docs(spark, texts), VOCABULARY, RANKS, capacity=256, with_ids=True).collect()
    n = check_packed(rows, texts, 256)
    assert all(list(r.ids) == [*slow_ids(dict(texts)[r.id]), 0][r.start:r.start + r.length] for r in rows)
    total = sum(r.length for r in rows)
    assert n <= 1.05 * math.ceil(total / 256) + 1


def test_pack_repeated_rows_and_empty(spark):
    rows = P.pack_documents(docs(spark, [(1, "a b"), (1, "a b"), (None, "c")]), VOCABULARY, RANKS).collect()
    assert len(rows) == 3 and len({r.sequence_id for r in rows}) == 1 and len({r.offset for r in rows}) == 3
    assert P.pack_documents(docs(spark, []), VOCABULARY, RANKS).count() == 0


# -- raking --------------------------------------------------------------------------------

def mixed(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, source string, lang string, text string, topic string, weight string")


def test_raking_meets_all_marginals(spark):
    rng = random.Random(5)
    rows = [(i, rng.choice(["a", "a", "a", "b", None]), rng.choice(["en", "en", "de", "fr"]), "w " * rng.randint(1, 300)
             + rng.choice(["", "license", "me@x.org"]), "t", "w") for i in range(600)]
    out = R.mix(mixed(spark, rows)).collect()
    assert len(out) == 600 and max(r.mix_probability for r in out) == pytest.approx(1)
    for dim, power in (("source", 0.7), ("lang", 0.85), ("mix_topic", 1.0)):
        have, kept = Counter(), Counter()
        for r in out:
            have[r[dim]] += r.mix_tokens
            kept[r[dim]] += r.mix_tokens * r.mix_probability
        goal = {k: v ** power for k, v in have.items()}
        for k in have:
            assert kept[k] / sum(kept.values()) == pytest.approx(goal[k] / sum(goal.values()), rel=1e-6)
    share = sum(r.mix_kept for r in out) / sum(r.mix_probability for r in out)
    assert 0.85 < share < 1.15


def test_raking_given_targets_and_edge_cases(spark):
    rows = [(1, "a", "en", "x y", "", ""), (2, "b", "en", "x", "", ""), (None, None, None, None, "", ""), (4, "a", "en", "", "", ""), (1, "a", "en", "x y", "", "")]
    share = spark.createDataFrame([("a", 0.5), ("b", 0.5)], "category string, share double")
    out = R.mix(mixed(spark, rows), targets={"source": share, "lang": 1.0, "topic": 1.0}).collect()
    p = {r.doc_id: r.mix_probability for r in out}
    assert p[1] == pytest.approx(0.25) and p[2] == pytest.approx(1)
    assert len({r.mix_kept for r in out if r.doc_id == 1}) == 1
    assert R.mix(mixed(spark, [])).count() == 0


# -- classifier ------------------------------------------------------------------------------

def test_classifier_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.1"                                          # enough labels to measure shares
    d, lab = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    seen, rest = lab.where("doc_id % 4 <> 0"), lab.where("doc_id % 4 = 0")
    out = C.classify(d, seen).join(rest, "doc_id").collect()
    share = lambda rows: sum(r.keep for r in rows) / len(rows)
    assert share([r for r in out if r.quality == 1 and r.toxic == 0]) >= 0.97
    assert share([r for r in out if r.quality == 0]) <= 0.05
    assert share([r for r in out if r.toxic == 1]) <= 0.15


def test_classifier_edge_cases(spark):
    kind = "doc_id long, text string, lang string, source string, n_chars long, score string"
    d = spark.createDataFrame([(1, "a", None, None, None, "s"), (2, None, "en", "x", 3, "s"), (None, "", "en", "x", 0, "s"), (1, "a", "en", "x", 1, "s")], kind)
    lab = spark.createDataFrame([(1, 1, 0), (9, 0, 0), (2, None, None)], "doc_id long, quality int, toxic int")
    out = C.classify(d.drop("score"), lab).collect()
    assert len(out) == 4 and {r.score for r in out} == {1.0}
    none = lab.limit(0)
    assert {r.score for r in C.classify(d.drop("score"), none).collect()} == {1.0}
    assert C.classify(d.drop("score").limit(0), none).count() == 0


# -- pipeline ----------------------------------------------------------------------------------

def test_pipeline_stages(spark, tmp_path):
    d = spark.read.parquet(f"{SF}/documents.parquet")
    columns, rows = d.columns, d.count()
    for name, stage in PIPE.STAGES[:-1]:
        before = {r.doc_id: r for r in d.collect()}
        out = stage(spark, d, SF)
        assert out.columns == columns
        out.write.parquet(str(tmp_path / name))
        d = spark.read.parquet(str(tmp_path / name))
        after = d.collect()
        assert 0 < len(after) <= len(before) and {r.doc_id for r in after} <= set(before)
        if name != "lines":
            assert all(before[r.doc_id] == r for r in after)
    final = PIPE.STAGES[-1][1](spark, d, SF)
    assert {r.doc_id for r in final.select("doc_id").collect()} == {r.doc_id for r in after}
    assert rows

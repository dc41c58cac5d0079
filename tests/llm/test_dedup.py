import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from feedlens.llm import exact_dedup as X
from feedlens.llm import line_dedup as L
from feedlens.llm import multi_index as V
from feedlens.llm import token_groups as G
from feedlens.llm.components import components
from feedlens.llm.words import hash_words, shingles

DOCS = "doc_id long, text string, lang string, keep_id string, id string"


def docs(spark, rows, parts=3):
    return spark.createDataFrame([(i, t, "en", "x", "y") for i, t in rows], DOCS).repartition(parts)


def groups_of(pairs, ids):
    low = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a, b in pairs:
            m = min(low[a], low[b])
            changed |= low[a] != m or low[b] != m
            low[a] = low[b] = m
    return low


# -- exact ------------------------------------------------------------------------

def test_exact_dedup(spark, tmp_path):
    rows = [(1, "a"), (2, "b"), (3, "a"), (4, None), (5, ""), (6, "a\n"), (7, "x" * 300_000), (8, "x" * 300_000), (2, "b"), (None, "b")]
    path = str(tmp_path / "docs")
    docs(spark, rows).write.parquet(path)
    out = X.exact_dedup(spark, path).collect()
    by_text = defaultdict(list)
    for i, t in rows:
        by_text[t or ""].append(i)
    want = sorted((i, max(x for x in by_text[t or ""] if x is not None), len(by_text[t or ""]), hashlib.sha256((t or "").encode()).digest())
                  for i, t in rows if i is not None)
    got = sorted((r.id, r.keep_id, r.group_size, bytes(r.digest)) for r in out if r.id is not None)
    assert got == want
    assert sum(r.kept for r in out) == len(by_text)                  # one row of each text, of repeated rows too
    assert [(r.keep_id, r.kept) for r in out if r.id is None] == [(2, False)]


def test_exact_state_goes_on(spark, tmp_path):
    path, state = str(tmp_path / "docs"), str(tmp_path / "state")
    docs(spark, [(1, "a"), (2, "b")]).write.parquet(path)
    X.absorb(spark, path, state)
    docs(spark, [(3, "a"), (4, "c")]).write.mode("append").parquet(path)
    got = {(r.n, r.keeper.id) for r in X.absorb(spark, path, state).collect()}
    assert got == {(2, 3), (1, 2), (1, 4)}


def test_exact_empty(spark, tmp_path):
    path = str(tmp_path / "docs")
    docs(spark, [], 1).write.parquet(path)
    assert X.exact_dedup(spark, path).count() == 0


# -- lines --------------------------------------------------------------------------

def brute_lines(rows, min_lines=3, min_words=50):
    rows = [(i, t or "") for i, t in rows]
    seen, out = set(), {}
    for i, text in sorted(set(rows)):
        raw = text.split("\n")
        full = [k for k, x in enumerate(raw) if x.strip(" ")]
        lines = [raw[k].strip(" ") for k in full]
        gone = set()
        for at in range(len(lines)):
            for size in range(1, min_lines + 1):
                if sum(x.count(" ") + 1 for x in lines[at:at + size]) >= min_words or size == min_lines:
                    break
            if at + size > len(lines):
                continue
            key = tuple(lines[at:at + size])
            if key in seen:
                gone |= set(range(at, at + size))
            seen.add(key)
        drop = {full[k] for k in gone}
        out[i, text] = "\n".join(x for k, x in enumerate(raw) if k not in drop) if gone else text
    return out


def test_line_dedup_matches_brute_force(spark):
    rng = random.Random(3)
    lines = ["alpha beta", " gamma", "delta", "one two three four", "", "  ", " ".join(f"w{k}" for k in range(55)), "omega"]
    rows = [(i, "\n".join(rng.choice(lines) for _ in range(rng.randint(0, 12)))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, "solo"), (103, rows[5][1]), (103, rows[5][1]), (104, "x\n" * 3000)]
    out = L.line_dedup(docs(spark, rows)).collect()
    want = brute_lines([r for r in rows if r[1] is not None])
    assert sorted((r.doc_id, r.text) for r in out if r.text is not None) == sorted(
        (i, want[i, t]) for i, t in rows if t is not None)
    assert [r.text for r in out if r.doc_id == 100] == [None]
    assert all(r.id == "y" and r.keep_id == "x" for r in out)
    removed = [(s.last - s.first + 1) for r in out for s in r.line_spans]
    assert sum(removed) == sum(r.lines_removed for r in out)


def brute_runs(rows, min_lines=3, min_words=50):
    """Texts without the lines of maximal runs that an earlier place holds and that hold a window."""
    places, out = [], {}
    for i, text in sorted(set(rows)):
        full = [k for k, x in enumerate(text.split("\n")) if x.strip(" ")]
        places.append((i, text, full, [text.split("\n")[k].strip(" ") for k in full]))
    for n, (i, text, full, lines) in enumerate(places):
        gone = set()
        for m in range(n + 1):
            other = places[m][3]
            for at in range(len(lines)):
                for b in range(len(other) if m < n else at):
                    k = 0
                    while at + k < len(lines) and b + k < len(other) and lines[at + k] == other[b + k]:
                        k += 1
                    if k >= min_lines or sum(x.count(" ") + 1 for x in lines[at:at + k]) >= min_words:
                        gone |= set(range(at, at + k))
        drop = {full[k] for k in gone}
        out[i, text] = "\n".join(x for k, x in enumerate(text.split("\n")) if k not in drop) if gone else text
    return out


def test_line_dedup_extends_runs(spark):
    rng = random.Random(5)
    words = lambda n, c: " ".join(f"{c}{k}" for k in range(n))
    lines = ["alpha beta", " gamma", "delta", "", words(60, "w"), words(30, "u"), words(25, "v"), words(55, "z")]
    rows = [(i, "\n".join(rng.choice(lines) for _ in range(rng.randint(0, 7)))) for i in range(60)]
    rows += [(100, words(60, "a") + "\n" + words(8, "b")), (101, words(60, "a") + "\n" + words(8, "b")),
             (102, words(60, "a") + "\n" + words(8, "b") + "\nnew"), (103, "x\n" * 30)]
    got = {(r.doc_id, t): r.text for r, t in ((r, dict(rows)[r.doc_id]) for r in L.line_dedup(docs(spark, rows), extend=True).collect())}
    assert got == brute_runs(rows)
    assert got[101, rows[61][1]] == "" and got[102, rows[62][1]] == "new"


def test_line_dedup_empty(spark):
    assert L.line_dedup(docs(spark, [])).count() == 0


# -- words, shingles, sets ------------------------------------------------------------

@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aA bé\t\n\x0b\x0c\r\x1c\xa0ÉZz  ", max_size=30)), max_size=8))
def test_words_and_shingles_agree_with_strings(texts):
    import pyarrow as pa

    h, counts = hash_words(pa.array(texts, pa.string()))
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = [re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(lower)) for t in texts]
    assert counts.tolist() == [len(w) for w in words]
    flat = [w for ws in words for w in ws]
    assert len({(a, b) for a, b in zip(flat, h.tolist(), strict=True)}) == len(set(flat)) == len(set(h.tolist()))
    token, n = shingles(h, counts, 3)
    runs = [[tuple(w[k:k + 3]) for k in range(max(1, len(w) - 2))] if w else [] for w in words]
    assert n.tolist() == [len(r) for r in runs]
    flat = [r for rs in runs for r in rs]
    assert len(set(zip(flat, token.tolist(), strict=True))) == len(set(flat)) == len(set(token.tolist()))


def brute_jaccard(rows, width, percent):
    sets = {}
    for i, t in rows:
        w = (t or "").lower().split()
        sets[i] = {tuple(w[k:k + width]) for k in range(max(1, len(w) - width + 1))} if w else set()
    ids = sorted(sets)
    pairs = [(a, b) for a in ids for b in ids if a < b and sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    return sets, groups_of(pairs, ids)


@pytest.mark.parametrize("width,percent", [(3, 90), (5, 80)])
def test_jaccard_components_match_brute_force(spark, width, percent):
    rng = random.Random(width)
    base = [[rng.choice("abcdefgh") + str(rng.randint(0, 40)) for _ in range(rng.randint(1, 120))] for _ in range(25)]
    rows = []
    for i in range(160):
        w = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
            w[rng.randrange(len(w))] = f"e{rng.randint(0, 30)}"
        rows.append((i, " ".join(w).upper() if i % 7 == 0 else " ".join(w)))
    rows += [(200, None), (201, ""), (202, " \n "), (203, "one"), (204, "ONE"), (205, "one two"), (206, "the end " * 20_000)]
    sets, low = brute_jaccard(rows, width, percent)
    got = {r.id: (r.n, r.component) for r in G.jaccard_components(docs(spark, rows), width=width, percent=percent, frequency_bits=8).collect()}
    assert got == {i: (len(sets[i]), low[i]) for i, _ in rows}


def test_jaccard_prefixes_avoid_tokens_that_hide_in_full_counters(spark):
    """A token of 12 texts is below the mean of a full counter (50), and yet goes behind the rare ones."""
    rng = random.Random(8)
    common = [" ".join(f"c{k}_{j}" for j in range(20)) for k in range(5)]
    rows = [(i, " ".join(f"w{rng.randrange(10**9)}" for _ in range(200)) + " " + common[i % 5]) for i in range(60)]
    d = docs(spark, rows)
    levels = G.token_levels(d, "text", 1, 8)
    words, _ = hash_words(pa.array(common, pa.string()))
    shared = set(shingles(words, np.array([len(words)]), 1)[0].view(np.int64).tolist())
    kept = G.prefixes(d, "text", 1, 80, levels).collect()
    assert {r.token for r in kept} <= shared                     # tokens of one set only are not written
    assert len(kept) < 150                                       # of 1200; the prefix is a fifth of each text


def test_jaccard_first_shared_token_leaves_room(spark, monkeypatch):
    """Sets that first meet so late in their prefixes that the rest cannot reach the overlap are not opened."""
    names, at = [], {}
    saved = G.saved

    def noted(df, name):
        names.append(name)
        at[name] = saved(df, name)
        return at[name]

    monkeypatch.setattr(G, "saved", noted)
    # equal counts everywhere: the order is that of the hashes, so the shared word lies anywhere in a prefix
    rng = random.Random(3)
    words = [f"t{k}" for k in range(40)]
    rows = [(i, " ".join([words[i // 2], *(f"u{i}_{j}" for j in range(rng.choice([60, 61])))])) for i in range(80)]
    sets, low = brute_jaccard(rows, 1, 80)
    monkeypatch.setattr(G, "token_levels", lambda *a: np.zeros(256, np.uint8))
    got = {r.id: r.component for r in G.jaccard_components(docs(spark, rows), width=1, percent=80).collect()}
    assert got == low
    prefix, met = at["prefixes"], at["met-groups"].count()
    room = {}
    for r in prefix.collect():
        room.setdefault(r.token, []).append((r.n, r.rank))
    can = sum(all(180 * (n - k) - 80 * n >= 80 * m for (n, k), (m, _) in ((x, y), (y, x))) for x, y in room.values())
    assert met == can < len(room)


def test_jaccard_null_and_repeated_ids(spark):
    rows = [(1, "a b c d"), (1, "x y z w"), (2, "a b c d"), (3, "x y z w"), (None, "a b c d")]
    got = sorted((r.id or -1, r.n, r.component) for r in G.jaccard_components(docs(spark, rows), width=3, percent=90).collect())
    assert got == sorted([(1, 2, 1), (1, 2, 1), (2, 2, 1), (3, 2, 1), (-1, 2, None)], key=lambda r: r[0])


def test_jaccard_empty(spark):
    assert G.jaccard_components(docs(spark, [])).count() == 0


def test_components(spark):
    rng = random.Random(1)
    pairs = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(200)] + [(500 + k, 501 + k) for k in range(60)]
    got = {r.id: r.component for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    ids = {x for p in pairs if p[0] != p[1] for x in p}
    assert got == groups_of([p for p in pairs if p[0] != p[1]], ids)


# -- vectors ----------------------------------------------------------------------------

def test_near_vectors_match_brute_force(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(60, 16))
    x = [(base[rng.integers(60)] + rng.normal(size=16) * rng.choice([0, 0.05, 0.1, 0.2])).astype(np.float32) for _ in range(700)]
    rows = [(i, [float(v) for v in x[i]], int(i % 3)) for i in range(700)]
    rows += [(1000, None, 1), (1001, [0.0] * 16, 1), (1002, [float("nan")] + [1.0] * 15, 1), (1003, [None] + [1.0] * 15, 1),
             (1004, [float("inf")] * 16, 1), (1005, rows[0][1], None), (1006, rows[1][1][:8], 1), (1007, [], 1), (1008, rows[0][1], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(3)
    got = {r.id: (r.n_links, r.component) for r in V.near_vectors(df, 0.93).collect()}
    good = {i: np.array(v, np.float32).astype(float) for i, v, k in rows if v and k is not None and None not in v
            and np.isfinite(v).all() and np.any(v)}
    label = {i: k for i, _, k in rows}
    pairs = [(a, b) for a in good for b in good if a < b and label[a] == label[b] and len(good[a]) == len(good[b])
             and good[a] @ good[b] / np.linalg.norm(good[a]) / np.linalg.norm(good[b]) >= 0.93]
    links = defaultdict(int)
    for a, b in pairs:
        links[a] += 1
        links[b] += 1
    low = groups_of(pairs, [r[0] for r in rows])
    found, all_links = sum(n for n, _ in got.values()), sum(links.values())
    assert all(got[i][0] <= links[i] for i in got)
    assert found >= 0.99 * all_links                     # recall of the index against brute force
    if found == all_links:
        assert {i: c for i, (_, c) in got.items()} == low
    assert all(got[i] == (0, i) for i in range(1000, 1008))


def test_near_vectors_of_a_hot_group(spark, monkeypatch):
    # as many code words as a large table has, and a third of the vectors are distinct near copies
    monkeypatch.setattr(V, "OCCUPANCY", 0.15)
    rng = np.random.default_rng(4)
    unit = lambda v: v / np.linalg.norm(v, axis=-1, keepdims=True)
    x = unit(rng.normal(size=(4000, 64)))
    x[:1400] = unit(x[0] + unit(rng.normal(size=(1400, 64))) * 0.14)
    x[2000:2400] = unit(x[2400:2800] + unit(rng.normal(size=(400, 64))) * 0.3)          # pairs elsewhere
    x = x[rng.permutation(4000)].astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], "vec_id long, embedding array<float>, label int").repartition(4)
    got = {r.id: r.n_links for r in V.near_vectors(df, 0.93).collect()}
    unit_x = unit(x.astype(float))
    links = ((unit_x @ unit_x.T) >= 0.93).sum(1) - 1
    found = np.array([got[i] for i in range(4000)])
    hot = links > 100
    assert hot.sum() == 1400 and (links[~hot] > 0).sum() >= 700
    assert found[hot].sum() >= 0.99 * links[hot].sum()
    assert found[~hot].sum() >= 0.99 * links[~hot].sum()


def test_near_vectors_empty(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert V.near_vectors(df).count() == 0


def test_op2_query_removes_runs_to_their_last_line(spark, tmp_path):     # F13
    from feedlens.llm.queries import op2_line_dedup
    text = " ".join(f"a{k}" for k in range(60)) + "\nshort last line"
    docs(spark, [(1, text), (2, text), (3, text + "\nnew")]).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: (r.text, r.lines_removed) for r in op2_line_dedup(spark, str(tmp_path)).collect()}
    assert got == {1: (text, 0), 2: ("", 2), 3: ("new", 2)}

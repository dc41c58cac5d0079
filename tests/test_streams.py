"""Streams whose results are complete and do not depend on how the input is cut into files."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from feedlens.operators import logs as L
from feedlens.streaming import jobs as ST

T0 = dt.datetime(2024, 1, 1)
KIND = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"


def events(n, seed=0):
    rng = random.Random(seed)
    at, rows = T0, []
    for i in range(n):
        at += dt.timedelta(minutes=rng.choice([0, 1, 7, 20, 31, 45]))
        rows.append((i, at, 7 if rng.random() < 0.5 else rng.randint(0, 5), rng.choice("ab"), float(i % 9), None))
    return rows


def write(spark, folder, rows, files):
    """The rows in order of time over so many files, each later file with a later time stamp."""
    size = -(-len(rows) // files)
    for k in range(files):
        part = rows[k * size:(k + 1) * size]
        path = f"{folder}/part"
        spark.createDataFrame(part, KIND).coalesce(1).write.mode("overwrite").parquet(path)
        one = next(f for f in os.listdir(path) if f.endswith(".parquet"))
        os.rename(f"{path}/{one}", f"{folder}/events{k}.parquet")
        os.utime(f"{folder}/events{k}.parquet", (1.7e9 + 10 * k, 1.7e9 + 10 * k))
    spark.createDataFrame(rows[:1], KIND).coalesce(1).write.mode("overwrite").parquet(f"{folder}/part")
    os.symlink(f"{folder}/events0.parquet", f"{folder}/events.parquet")        # for the schema only


def kept_apart(rows, delay):
    last, out = {}, []
    for r in sorted(rows, key=lambda r: (r[1], r[0])):
        key = r[2:4]
        if key not in last or r[1] - last[key] > delay:
            last[key] = r[1]
            out.append(r[0])
    return sorted(out)


@pytest.fixture(scope="module")
def folders(spark, tmp_path_factory):
    rows, out = events(260), {}
    for files in (1, 4):
        folder = str(tmp_path_factory.mktemp(f"events{files}"))
        write(spark, folder, rows, files)
        out[files] = folder
    return rows, out


def stream_of(spark, folder):
    """Without the link that stands for the whole table."""
    schema = spark.read.parquet(f"{folder}/events.parquet").schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/events[0-9].parquet")


@pytest.mark.parametrize("files", [1, 4])
def test_dedupe_is_the_same_for_any_number_of_files(spark, folders, files, monkeypatch):      # STR3
    rows, folder = folders
    monkeypatch.setattr(ST, "event_stream", lambda spark, sf_dir, max_files=1: stream_of(spark, sf_dir))
    got = sorted(r.event_id for r in ST.dedupe_events(spark, folder[files], 30).collect())
    assert got == kept_apart(rows, dt.timedelta(minutes=30))


@pytest.mark.parametrize("files", [1, 4])
def test_sliding_windows_are_complete(spark, folders, files, monkeypatch):                    # STR2
    rows, folder = folders
    monkeypatch.setattr(ST, "event_stream", lambda spark, sf_dir, max_files=1: stream_of(spark, sf_dir))
    themes = spark.createDataFrame([(u, "x" if u % 2 else "y", u + 1, 100 * u, u) for u in range(8)],
                                   "doc_id long, theme string, sentences long, total long, positive long")
    got = {(r.window_start, r.theme): (r.events, r.sentences, r.mean_compound)
           for r in ST.theme_windows(spark, folder[files], themes).collect()}
    want = {}
    for r in rows:
        start = T0 + (r[1] - T0) // dt.timedelta(minutes=30) * dt.timedelta(minutes=30)
        for begin in (start, start - dt.timedelta(minutes=30)):
            n, s, t = want.get((begin, "x" if r[2] % 2 else "y"), (0, 0, 0))
            want[begin, "x" if r[2] % 2 else "y"] = n + 1, s + r[2] + 1, t + 100 * r[2]
    assert got == {k: (n, s, round(t / s / 10000, 6)) for k, (n, s, t) in want.items()}
    counted = sum(r.n for r in ST.windowed_events(spark, folder[files]).collect())
    assert counted == len(rows)


def test_error_context_crosses_blocks(spark):                                                  # OPS7
    rng = random.Random(3)
    rows = [(i, T0 + dt.timedelta(minutes=rng.choice([3, 50, 200]) * i), 1 if rng.random() < 0.7 else rng.choice([2, None]),
             "error" if rng.random() < 0.04 else "view", 0.0, None) for i in range(400)]
    log = L.parse(spark.createDataFrame(rows, KIND))
    got = sorted(r.event_id for r in L.error_context(log).collect())
    want = []
    for user in (1, 2, None):
        mine = sorted((r for r in rows if r[2] == user), key=lambda r: (r[1], r[0]))
        bad = [k for k, r in enumerate(mine) if r[3] == "error"]
        want += [r[0] for k, r in enumerate(mine) if any(abs(k - b) <= 5 for b in bad)]
    assert got == sorted(want) and set(L.error_context(log).columns) == set(log.columns)

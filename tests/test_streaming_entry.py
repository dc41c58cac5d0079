import numpy as np

import __spark_entry__ as ENTRY
from feedlens.operators import embedding as E
from feedlens.operators import sentiment as S
from feedlens.plans import catalog
from feedlens.plans.inputs import doc_lexicon
from feedlens.streaming import jobs as ST

SF = "/root/testdata/sf0.001"


def test_stream_scores_equal_batch(spark):          # STR1 batch/stream equality
    stream = ST.score_stream(spark, SF, doc_lexicon(spark)).select(*catalog.SCORE_COLS)
    batch = catalog.q_sentence_scores(spark, SF)
    key = lambda r: (r.request_id, r.dataset, r.pos)
    assert sorted(stream.collect(), key=key) == sorted(batch.collect(), key=key)


def test_stream_windows_and_dedupe(spark):          # STR2, STR3
    w = ST.windowed_events(spark, SF)
    assert set(w.columns) >= {"window_start", "event_type", "n", "median_value"}
    d = ST.dedupe_events(spark, SF)
    total = spark.read.parquet(f"{SF}/events.parquet").count()
    assert 0 < d.count() <= total


def test_encoder_udf(spark):                        # EMB3
    def make():
        def enc(texts):
            return np.array([[len(t), t.count(" "), 1.0] for t in texts], dtype=float)
        return enc
    udf = E.encoder_udf(make, 3)
    df = spark.createDataFrame([("a b c",), ("hello",)], "sentence string")
    out = [list(r[0]) for r in df.select(udf("sentence")).collect()]
    assert out == [[5.0, 2.0, 1.0], [5.0, 0.0, 1.0]]


def test_entry_smoke(spark):
    df = ENTRY.entry(spark)
    assert df.count() > 0
    assert set(ENTRY.oracle_sql()) <= set(ENTRY.queries())

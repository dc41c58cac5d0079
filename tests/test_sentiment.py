import pytest
from pyspark.sql import functions as F

from feedlens.operators import sentiment as S

from .conftest import sentences


def _classify(spark, values, mode):
    df = spark.createDataFrame([(float(v),) for v in values], "c double")
    return [r[0] for r in df.select(S.classify("c", mode)).collect()]


def test_classify_standard_inclusive(spark):          # F9
    assert _classify(spark, [0.5, 0.05, 0.04, 0, -0.04, -0.05, -0.5], "standard") == [
        "positive", "positive", "neutral", "neutral", "neutral", "negative", "negative"]


def test_classify_strict(spark):                      # F10
    assert _classify(spark, [0.1, 0.25], "strict") == ["neutral", "positive"]
    assert _classify(spark, [0.1], "unknown") == ["positive"]


def test_empty_text_is_neutral(spark):                # F11 / SEN2
    s = sentences(spark, [""])
    r = S.score_sentences(s, S.lexicon_df(spark)).first()
    assert (r.neu_score, r.compound, r.label) == (1.0, 0.0, "neutral")


def test_rules(spark):
    s = sentences(spark, ["This is good", "This is not good", "This is very good",
                          "This is GOOD but slow", "good!!!", "It is good"])
    r = {x.sentence: x.compound for x in S.score_sentences(s, S.lexicon_df(spark)).collect()}
    assert r["This is not good"] < 0 < r["This is good"] < r["This is very good"]
    assert r["good!!!"] > r["It is good"]


def test_cluster_distribution(spark):                 # F12, F32
    pos = ["I love this app", "Great service", "Excellent and helpful", "Amazing experience"]
    neg = ["Terrible app", "Horrible bugs", "Worst service ever", "Bad and slow"]
    s = sentences(spark, pos + neg).withColumn(
        "cluster_id", F.when(F.col("pos") < 4, F.lit(0)).otherwise(F.lit(1)))
    sc = S.score_sentences(s, S.lexicon_df(spark))
    cs = {r.cluster_id: r for r in S.cluster_sentiment(sc).collect()}
    assert (cs[0].positive, cs[0].negative) == (4, 0)
    assert (cs[1].positive, cs[1].negative) == (0, 4)
    assert abs(cs[0].pct_positive + cs[0].pct_neutral + cs[0].pct_negative - 100) <= 0.1


def _stats(spark, values):
    df = spark.createDataFrame([("r", "baseline", 0, float(v), "x") for v in values],
                               "request_id string, dataset string, cluster_id int, compound double, label string")
    return S.cluster_sentiment(df).first()


def test_single_value_std_zero(spark):                # F13
    r = _stats(spark, [0.5])
    assert (r.median, r.std, r.overall) == (0.5, 0.0, "positive")


def test_median_mean_std(spark):                      # F14
    r = _stats(spark, [-0.6, -0.2, 0.1, 0.05])
    assert (r.median, r.overall, r.average_score, r.std) == (-0.075, "negative", -0.163, 0.32)


def test_median_edge(spark):                          # F15
    assert _stats(spark, [0.04, 0.06]).overall == "positive"


def test_empty_cluster(spark):                        # F16 / SEN11
    clusters = spark.createDataFrame([("r", "baseline", 5)], "request_id string, dataset string, cluster_id int")
    empty = S.cluster_sentiment(spark.createDataFrame(
        [], "request_id string, dataset string, cluster_id int, compound double, label string"))
    r = S.empty_cluster_sentiment(clusters, empty).first()
    assert (r.overall, r.total_sentences, r.pct_neutral, r.average_score) == ("neutral", 0, 100.0, 0.0)


@pytest.mark.parametrize("rows,expected", [
    ([(0.70, 8), (-0.60, 2)], "positive"),
    ([(0.8, 10), (-0.6, 2)], "positive"),
    ([(0.8, 0)], None),
])
def test_overall_weighted_median(spark, rows, expected):   # F17
    df = spark.createDataFrame([("r", a, n) for a, n in rows],
                               "request_id string, average_score double, total_sentences int")
    out = S.overall_sentiment(df).collect()
    assert (out[0].overall_sentiment if out else None) == expected


def test_partition_count_does_not_change_scores(spark):
    texts = [f"good {i} but not great" if i % 3 else f"terrible {i}!!" for i in range(40)]
    a = S.score_sentences(sentences(spark, texts).repartition(1), S.lexicon_df(spark))
    b = S.score_sentences(sentences(spark, texts).repartition(7), S.lexicon_df(spark))
    key = lambda r: r.pos
    assert sorted(a.collect(), key=key) == sorted(b.collect(), key=key)


def test_scoring_shuffles_no_text(spark):             # F21, F23, F25-F30
    texts = ["good " * 50 + f"{i}" for i in range(20)]
    out = S.score_sentences(sentences(spark, texts), S.lexicon_df(spark))
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    assert out.count() == 20


def test_large_lexicon_and_repeated_keys_score_alike(spark):
    texts = ["not very good", "GOOD but bad!", "", "good  bad \x85good", "\"Good,\" but really isn't great??", "plain"]
    s = sentences(spark, texts)
    lex = S.lexicon_df(spark).unionByName(spark.createDataFrame([("plain", None), (None, 2.0)], "token string, valence double"))
    key = lambda r: (r.pos, r.sentence)
    in_plan = sorted(S.score_sentences(s, lex).collect(), key=key)
    assert sorted(S.score_sentences(s, lex, in_plan_max_rows=0).collect(), key=key) == in_plan
    # the rows of one key are one text; others stay as they are, and a null in the key goes
    again = s.unionByName(s.where("pos = 0")).unionByName(s.limit(1).withColumn("pos", F.lit(None).cast("long")))
    got = sorted(S.score_sentences(again, lex).collect(), key=key)
    assert [r.pos for r in got] == [0, 0, 1, 2, 3, 4, 5] and got[2:] == in_plan[1:]
    assert got[0].compound == got[1].compound < in_plan[0].compound < 0

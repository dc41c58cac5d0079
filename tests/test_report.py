from pyspark.sql import functions as F

from feedlens.operators import insights as I
from feedlens.operators import report as R
from feedlens.operators import sentiment as S

A_SCHEMA = "request_id string, dataset string, pos long, cluster_id int"


def _assign(spark, labels, dataset="baseline"):
    return spark.createDataFrame([("r", dataset, i, l) for i, l in enumerate(labels)], A_SCHEMA)


def _empty(spark, cols):
    return spark.createDataFrame([], cols)


def _rows(spark, assign, sent=None):
    sent = sent if sent is not None else _empty(
        spark, "request_id string, dataset string, cluster_id int, overall string, average_score double, "
               "positive long, neutral long, negative long")
    themes = _empty(spark, "request_id string, dataset string, cluster_id int, keywords array<string>, title string")
    ins = _empty(spark, "request_id string, dataset string, cluster_id int, key_insights array<string>")
    return R.cluster_rows(assign, sent, themes, ins)


def test_noise_excluded_and_unclustered(spark):      # F18
    a = _assign(spark, [0, -1, 0])
    rows = _rows(spark, a).collect()
    assert [(r.cluster_id, r.size, r.id, r.title) for r in rows] == [(0, 2, "baseline-cluster-0", "Cluster 0")]
    s = spark.createDataFrame([("r", "baseline", i, str(i), "x") for i in range(3)],
                              "request_id string, dataset string, pos long, id string, sentence string")
    summ = R.summary(s, a, _rows(spark, a)).first()
    assert (summ.total_sentences, summ.clusters_found, summ.unclustered) == (3, 1, 1)


def test_sorted_by_size(spark):                      # F19
    a = _assign(spark, [0] * 7 + [1] * 3)
    rows = _rows(spark, a).orderBy("rank").collect()
    assert [r.size for r in rows] == [7, 3]


def test_theme_comparison(spark):                    # F20
    c = spark.createDataFrame([("r", "baseline", "A"), ("r", "baseline", "B"),
                               ("r", "comparison", "B"), ("r", "comparison", "C")],
                              "request_id string, dataset string, title string")
    got = {(r.kind, r.title) for r in R.theme_comparison(c).collect()}
    assert got == {("baseline_only", "A"), ("comparison_only", "C"), ("shared", "B")}


def test_same_cluster_id_in_both_datasets(spark):    # F21
    a = _assign(spark, [0, 0]).unionByName(_assign(spark, [0, 0], "comparison"))
    sent = spark.createDataFrame(
        [("r", "baseline", 0, "positive", 0.6, 2, 0, 0), ("r", "comparison", 0, "negative", -0.6, 0, 0, 2)],
        "request_id string, dataset string, cluster_id int, overall string, average_score double, "
        "positive long, neutral long, negative long")
    rows = {r.id: r.overall for r in _rows(spark, a, sent).collect()}
    assert rows == {"baseline-cluster-0": "positive", "comparison-cluster-0": "negative"}


def test_joint_sources(spark):
    a = _assign(spark, [0, 0, 1]).unionByName(_assign(spark, [0], "comparison"))
    got = {r.cluster_id: (r.baseline_count, r.comparison_count, r.kind)
           for r in R.joint_source_counts(a).collect()}
    assert got == {0: (2, 1, "shared"), 1: (1, 0, "baseline_only")}


def test_sizes_plus_unclustered_equals_total(spark):   # property from the test plan
    import random
    rnd = random.Random(7)
    labels = [rnd.choice([-1, 0, 1, 2, 3]) for _ in range(200)]
    a = _assign(spark, labels)
    s = spark.createDataFrame([("r", "baseline", i, str(i), "x") for i in range(200)],
                              "request_id string, dataset string, pos long, id string, sentence string")
    rows = _rows(spark, a)
    summ = R.summary(s, a, rows).first()
    assert sum(r.size for r in rows.collect()) + summ.unclustered == summ.total_sentences == 200


def test_empty_cluster_theme(spark):                  # INS8
    key = "request_id string, dataset string, cluster_id int"
    clusters = spark.createDataFrame([("r", "baseline", 0), ("r", "baseline", 1)], key)
    sizes = spark.createDataFrame([("r", "baseline", 0, 4)], key + ", n long")
    themes = spark.createDataFrame([("r", "baseline", 0, ["tea"], "Tea")], key + ", keywords array<string>, title string")
    found = spark.createDataFrame([("r", "baseline", 0, ["much tea"])], key + ", key_insights array<string>")
    rows = {r.cluster_id: r for r in I.empty_cluster_themes(clusters, sizes, themes, found).collect()}
    assert (rows[0].size, rows[0].title, rows[0].keywords, rows[0].key_insights) == (4, "Tea", ["tea"], ["much tea"])
    assert (rows[1].size, rows[1].title, rows[1].keywords, rows[1].key_insights) == (0, "Empty Cluster", [], [])


def test_key_statements(spark):                       # CMP4
    shift = spark.createDataFrame(
        [("r", 0, 12.25, -0.125), ("r", 1, -0.5, 0.04), ("r", 2, None, None)],
        "request_id string, cluster_id int, share_shift_pct double, sentiment_shift double")
    kw = "request_id string, cluster_id int, keywords array<string>"
    base = spark.createDataFrame([("r", 0, ["d", "a", "b", "c"]), ("r", 1, ["a"])], kw)
    comp = spark.createDataFrame([("r", 0, ["a", "b", "c", "d"]), ("r", 2, ["a"])], kw)
    rows = {r.cluster_id: (r.key_similarities, r.key_differences) for r in R.key_statements(shift, base, comp).collect()}
    assert rows[0] == (["Both mention d, a, b"], ["Share rises by 12.3 points", "Sentiment worsens by 0.13"])
    assert rows[1] == ([], []) and rows[2] == ([], [])

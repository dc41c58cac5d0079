"""Report assembly, theme comparison and summary (ASM1-ASM6, CMP1-CMP8).

The report is kept flat: one row per cluster (``clusters``), one per
request (``summary``), one per compared title (``theme_comparison``) and
one per sentence (``cluster_sentences``).  A nested JSON report is built
only for validated requests, whose datasets are capped at 1000 sentences by
validation, so each ``collect_list`` is bounded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .sentiment import classify

CLUSTER_KEY = ["request_id", "dataset", "cluster_id"]


def _not_noise(c: str) -> F.Column:
    """Cluster ids may be numbers or labels; noise is -1 either way."""
    return F.col(c).cast("string") != F.lit("-1")


def cluster_rows(assignments: DataFrame, sentiment: DataFrame, themes: DataFrame,
                 insights: DataFrame, cluster_col: str = "cluster_id") -> DataFrame:
    """ASM1, ASM3, ASM4, ASM5: one row per non-noise cluster, ordered per request.

    ``assignments`` (request_id, dataset, pos, cluster_id); ``sentiment``
    from ``cluster_sentiment``; ``themes`` (G, keywords, title); ``insights``
    (G, key_insights).  Missing parts take the documented defaults.
    """
    g = ["request_id", "dataset", cluster_col]
    a = assignments.where(_not_noise(cluster_col))
    sizes = a.groupBy(*g).agg(F.count(F.lit(1)).alias("size"), F.min("pos").alias("_first_pos"))
    j = (sizes.join(sentiment.select(*g, "overall", "average_score", "positive", "neutral",
                                     "negative"), g, "left")
         .join(themes.select(*g, "keywords", "title"), g, "left")
         .join(insights.select(*g, "key_insights"), g, "left"))
    empty = F.array().cast("array<string>")
    out = j.select(
        "request_id", "dataset", F.col(cluster_col).alias("cluster_id"),
        F.concat_ws("-", "dataset", F.lit("cluster"), F.col(cluster_col).cast("string")).alias("id"),
        F.coalesce("title", F.concat(F.lit("Cluster "), F.col(cluster_col).cast("string"))).alias("title"),
        "size",
        F.coalesce("overall", F.lit("neutral")).alias("overall"),
        F.coalesce("average_score", F.lit(0.0)).alias("average_score"),
        F.coalesce("positive", F.lit(0).cast("long")).alias("positive"),
        F.coalesce("neutral", F.lit(0).cast("long")).alias("neutral"),
        F.coalesce("negative", F.lit(0).cast("long")).alias("negative"),
        F.coalesce("keywords", empty).alias("keywords"),
        F.coalesce("key_insights", empty).alias("key_insights"),
        F.col("dataset").alias("source"),
        "_first_pos")
    # Size desc; stable: baseline before comparison, then first-seen cluster.
    w = Window.partitionBy("request_id").orderBy(
        F.col("size").desc(), F.when(F.col("dataset") == "baseline", 0).otherwise(1),
        F.col("_first_pos"))
    return out.withColumn("rank", F.row_number().over(w)).drop("_first_pos")


def cluster_sentences(sentences: DataFrame, assignments: DataFrame, scores: DataFrame) -> DataFrame:
    """ASM1-ASM2 flat: each clustered sentence with its label and score."""
    key = ["request_id", "dataset", "pos"]
    a = assignments.where(_not_noise("cluster_id")).select(*key, "cluster_id")
    s = scores.select(*key, "label", "compound")
    return (sentences.select(*key, "id", "sentence").join(a, key)
            .join(s, key, "left")
            .select(*key, "cluster_id", "id", "sentence",
                    F.coalesce("label", F.lit("neutral")).alias("label"),
                    F.coalesce("compound", F.lit(0.0)).alias("score")))


def summary(sentences: DataFrame, assignments: DataFrame, clusters: DataFrame,
            meta: DataFrame | None = None) -> DataFrame:
    """ASM6 + SEN12: totals, clusters found, unclustered, overall sentiment."""
    from .sentiment import overall_sentiment
    tot = sentences.groupBy("request_id").agg(F.count(F.lit(1)).alias("total_sentences"))
    unc = assignments.groupBy("request_id").agg(
        F.sum((~_not_noise("cluster_id")).cast("int")).cast("long").alias("unclustered"))
    found = clusters.groupBy("request_id").agg(F.count(F.lit(1)).alias("clusters_found"))
    ov = overall_sentiment(clusters.withColumnRenamed("size", "_size"), ["request_id"], "_size")
    out = (tot.join(unc, "request_id", "left").join(found, "request_id", "left")
           .join(ov, "request_id", "left"))
    out = out.select(
        "request_id", "total_sentences",
        F.coalesce("clusters_found", F.lit(0).cast("long")).alias("clusters_found"),
        F.coalesce("unclustered", F.lit(0).cast("long")).alias("unclustered"),
        F.coalesce("overall_sentiment", F.lit("neutral")).alias("overall_sentiment"))
    if meta is not None:
        out = out.join(meta.select("request_id", "query", "theme", "survey_title"), "request_id", "left")
    return out


def theme_comparison(clusters: DataFrame) -> DataFrame:
    """CMP1: titles only in baseline, only in comparison, or shared (exact title).

    Present only for requests that have comparison clusters; one row per
    (request, kind, title).
    """
    t = clusters.select("request_id", "dataset", "title").distinct()
    per = t.groupBy("request_id", "title").agg(
        F.max((F.col("dataset") == "baseline").cast("int")).alias("_b"),
        F.max((F.col("dataset") == "comparison").cast("int")).alias("_c"))
    has_cmp = clusters.where(F.col("dataset") == "comparison").select("request_id").distinct()
    per = per.join(has_cmp, "request_id", "left_semi")
    kind = (F.when((F.col("_b") == 1) & (F.col("_c") == 1), F.lit("shared"))
            .when(F.col("_b") == 1, F.lit("baseline_only")).otherwise(F.lit("comparison_only")))
    return per.select("request_id", kind.alias("kind"), "title")


def joint_source_counts(assignments: DataFrame, cluster_col: str = "cluster_id") -> DataFrame:
    """CLU14 + CMP3: per joint cluster, counts by source, ratio and class."""
    c = (assignments.groupBy("request_id", cluster_col)
         .pivot("dataset", ["baseline", "comparison"]).count().fillna(0))
    ratio = F.col("baseline") / F.greatest(F.col("comparison"), F.lit(1))
    kind = (F.when((F.col("baseline") > 0) & (F.col("comparison") > 0), F.lit("shared"))
            .when(F.col("baseline") > 0, F.lit("baseline_only")).otherwise(F.lit("comparison_only")))
    return c.select("request_id", cluster_col, F.col("baseline").alias("baseline_count"),
                    F.col("comparison").alias("comparison_count"),
                    F.round(ratio, 6).alias("ratio"), kind.alias("kind"))


def share_shift(assignments: DataFrame, scores: DataFrame | None = None,
                cluster_col: str = "cluster_id") -> DataFrame:
    """CMP4 (shift part) + CMP6: share and sentiment shift, two-proportion z.

    For each joint cluster: its share of the baseline and of the comparison,
    the difference, the pooled two-proportion z statistic, and (with
    ``scores``) the mean compound per dataset and its shift.
    """
    key = ["request_id", "dataset", "pos"]
    a = assignments
    if scores is not None:
        a = a.join(scores.select(*key, "compound"), key, "left")
    else:
        a = a.withColumn("compound", F.lit(None).cast("double"))
    per = a.groupBy("request_id", cluster_col).agg(
        F.sum((F.col("dataset") == "baseline").cast("long")).alias("xb"),
        F.sum((F.col("dataset") == "comparison").cast("long")).alias("xc"),
        F.avg(F.when(F.col("dataset") == "baseline", F.col("compound"))).alias("mb"),
        F.avg(F.when(F.col("dataset") == "comparison", F.col("compound"))).alias("mc"))
    tot = a.groupBy("request_id").agg(
        F.sum((F.col("dataset") == "baseline").cast("long")).alias("nb"),
        F.sum((F.col("dataset") == "comparison").cast("long")).alias("nc"))
    j = per.join(tot, "request_id")
    d = lambda a, b: F.try_divide(a.cast("double"), b)  # noqa: E731  NULL, not an error, on 0
    pb = d(F.col("xb"), F.col("nb"))
    pc = d(F.col("xc"), F.col("nc"))
    pp = d(F.col("xb") + F.col("xc"), F.col("nb") + F.col("nc"))
    se = F.sqrt(pp * (1 - pp) * (d(F.lit(1), F.col("nb")) + d(F.lit(1), F.col("nc"))))
    return j.select(
        "request_id", cluster_col,
        F.round(pb * 100, 3).alias("baseline_share_pct"),
        F.round(pc * 100, 3).alias("comparison_share_pct"),
        F.round((pc - pb) * 100, 3).alias("share_shift_pct"),
        F.round(F.when(se > 0, d(pc - pb, se)), 4).alias("z"),
        F.round(F.col("mc") - F.col("mb"), 4).alias("sentiment_shift"))


def key_statements(shift: DataFrame, baseline_kw: DataFrame, comparison_kw: DataFrame,
                   cluster_col: str = "cluster_id") -> DataFrame:
    """CMP4: short similarity / difference statements per joint cluster.

    ``*_kw`` are (request_id, cluster, keywords) per dataset.  Similarity
    lists shared top terms; differences state the share and sentiment shift.
    """
    b = baseline_kw.select("request_id", cluster_col, F.col("keywords").alias("_kb"))
    c = comparison_kw.select("request_id", cluster_col, F.col("keywords").alias("_kc"))
    j = shift.join(b, ["request_id", cluster_col], "left").join(c, ["request_id", cluster_col], "left")
    shared = F.array_intersect(F.coalesce("_kb", F.array().cast("array<string>")),
                               F.coalesce("_kc", F.array().cast("array<string>")))
    sim = F.when(F.size(shared) > 0, F.concat(F.lit("Both mention "),
                                               F.array_join(F.slice(shared, 1, 3), ", ")))
    diff_share = F.when(F.abs("share_shift_pct") >= 1, F.format_string(
        "Share %s by %.1f points", F.when(F.col("share_shift_pct") > 0, F.lit("rises"))
        .otherwise(F.lit("falls")), F.round(F.abs("share_shift_pct"), 1)))
    diff_sent = F.when(F.abs("sentiment_shift") >= 0.05, F.format_string(
        "Sentiment %s by %.2f", F.when(F.col("sentiment_shift") > 0, F.lit("improves"))
        .otherwise(F.lit("worsens")), F.round(F.abs("sentiment_shift"), 2)))
    return j.select("request_id", cluster_col,
                    F.filter(F.array(sim), lambda x: x.isNotNull()).alias("key_similarities"),
                    F.filter(F.array(diff_share, diff_sent), lambda x: x.isNotNull())
                    .alias("key_differences"))


def aligned_sentences(sentences: DataFrame, assignments: DataFrame,
                      cluster_col: str = "cluster_id") -> DataFrame:
    """CMP2 flat: each joint cluster's sentences tagged baseline/comparison."""
    key = ["request_id", "dataset", "pos"]
    return (assignments.select(*key, cluster_col).join(sentences.select(*key, "id", "sentence"), key)
            .select("request_id", cluster_col, "dataset", "pos", "id", "sentence"))


def centroid_alignment(vectors: DataFrame, assignments: DataFrame, dims: int) -> DataFrame:
    """CMP5: match each comparison cluster to the most similar baseline cluster.

    Centroids come from a grouped average per dimension; the candidate pairs
    are baseline x comparison clusters of one request (clusters per dataset
    are bounded by ``max_clusters``), scored by cosine similarity.
    """
    key = ["request_id", "dataset", "pos"]
    v = vectors.select(*key, "embedding").join(assignments.where(_not_noise("cluster_id"))
                                               .select(*key, "cluster_id"), key)
    cen = v.groupBy("request_id", "dataset", "cluster_id").agg(
        *[F.avg(F.col("embedding")[i]).alias(f"c{i}") for i in range(dims)])
    cen = cen.select("request_id", "dataset", "cluster_id",
                     F.array(*[F.col(f"c{i}") for i in range(dims)]).alias("centroid"))
    b = cen.where(F.col("dataset") == "baseline").select(
        "request_id", F.col("cluster_id").alias("baseline_cluster"), F.col("centroid").alias("_cb"))
    c = cen.where(F.col("dataset") == "comparison").select(
        "request_id", F.col("cluster_id").alias("comparison_cluster"), F.col("centroid").alias("_cc"))
    from ..functions.vectors import cosine
    pairs = c.join(b, "request_id").withColumn("similarity", F.round(cosine("_cc", "_cb"), 6))
    w = Window.partitionBy("request_id", "comparison_cluster").orderBy(
        F.col("similarity").desc(), F.col("baseline_cluster"))
    return (pairs.withColumn("_r", F.row_number().over(w)).where("_r = 1")
            .select("request_id", "comparison_cluster", "baseline_cluster", "similarity"))


def trend(scored: DataFrame, ts_col: str, group: list[str], window: str = "1 day") -> DataFrame:
    """CMP7: per time bin and group, share and mean sentiment, with the change
    from the previous bin (``lag`` over bins of one group)."""
    b = scored.groupBy(F.window(ts_col, window).alias("w"), *group).agg(
        F.count(F.lit(1)).alias("n"), F.avg("compound").alias("mean_compound"))
    b = b.select(F.col("w.start").alias("bin_start"), *group, "n", "mean_compound")
    tot = b.groupBy("bin_start").agg(F.sum("n").alias("_tot"))
    b = b.join(tot, "bin_start").withColumn("share", F.col("n") / F.col("_tot"))
    w = Window.partitionBy(*group).orderBy("bin_start")
    # Changes are taken between the reported (rounded) values.
    b = b.select("bin_start", *group, "n", F.round("share", 6).alias("share"),
                 F.round("mean_compound", 6).alias("mean_compound"))
    return b.select("*", F.round(F.col("share") - F.lag("share").over(w), 6).alias("share_delta"),
                    F.round(F.col("mean_compound") - F.lag("mean_compound").over(w), 6)
                    .alias("sentiment_delta"))


def nested_report(clusters: DataFrame, sentences_flat: DataFrame, summary_df: DataFrame,
                  comparison: DataFrame) -> DataFrame:
    """SNK1: one JSON document per validated request (bounded by validation)."""
    sent = sentences_flat.groupBy("request_id", "dataset", "cluster_id").agg(
        F.transform(F.array_sort(F.collect_list(F.struct(
            "pos", "sentence", "id", F.struct("label", F.col("score")).alias("sentiment")))),
            lambda x: F.struct(x["sentence"].alias("sentence"), x["id"].alias("id"),
                               x["sentiment"].alias("sentiment"))).alias("sentences"))
    c = clusters.join(sent, ["request_id", "dataset", "cluster_id"], "left")
    cl = c.groupBy("request_id").agg(F.transform(F.array_sort(F.collect_list(F.struct(
        "rank", "id", "title", "sentences", "size",
        F.struct("overall", F.struct("positive", "neutral", "negative").alias("distribution"),
                 "average_score").alias("sentiment"),
        "key_insights", "keywords", "source"))), lambda x: x.dropFields("rank")).alias("clusters"))
    cmp_ = comparison.groupBy("request_id").agg(
        F.array_sort(F.collect_list(F.when(F.col("kind") == "baseline_only", F.col("title"))))
        .alias("baseline_only_themes"),
        F.array_sort(F.collect_list(F.when(F.col("kind") == "comparison_only", F.col("title"))))
        .alias("comparison_only_themes"),
        F.array_sort(F.collect_list(F.when(F.col("kind") == "shared", F.col("title"))))
        .alias("shared_themes"))
    s = summary_df.select("request_id", F.struct(*[c for c in summary_df.columns
                                                  if c != "request_id"]).alias("summary"))
    out = s.join(cl, "request_id", "left").join(
        cmp_.select("request_id", F.struct("baseline_only_themes", "comparison_only_themes",
                                           "shared_themes").alias("comparison_insights")),
        "request_id", "left")
    return out.select("request_id", F.to_json(F.struct(
        F.coalesce("clusters", F.array()).alias("clusters"), "summary", "comparison_insights"))
        .alias("response"))


def output_checks(clusters: DataFrame, summary_df: DataFrame) -> DataFrame:
    """VAL10: range checks on outputs; one row per failed check."""
    bad_c = clusters.where((F.col("average_score") < -1) | (F.col("average_score") > 1)
                           | (F.col("size") < 0)).select(
        "request_id", F.concat(F.lit("cluster "), F.col("id")).alias("field"),
        F.lit("out of range").alias("message"))
    bad_s = summary_df.where((F.col("total_sentences") < 0) | (F.col("clusters_found") < 0)
                             | (F.col("unclustered") < 0)).select(
        "request_id", F.lit("summary").alias("field"), F.lit("out of range").alias("message"))
    return bad_c.unionByName(bad_s)


__all__ = ["cluster_rows", "cluster_sentences", "summary", "theme_comparison",
           "joint_source_counts", "share_shift", "key_statements", "aligned_sentences",
           "centroid_alignment", "trend", "nested_report", "output_checks", "classify"]

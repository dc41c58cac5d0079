"""Registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame.

Every query reads the given tables whole and runs the library's operators
on them; column names match the oracle SQL in :mod:`feedlens.plans.oracle`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.vectors import cosine, norm2
from ..operators import clustering as CL
from ..operators.density import density_cuts
from ..operators import embedding as E
from ..operators import insights as I
from ..operators import logs as L
from ..operators import keywords as K
from ..operators import report as R
from ..operators import topics as TP
from ..functions.stopwords import stop_word_table
from ..operators import validation as VAL
from ..sources import requests as RQ
from ..sources import sinks as SK
from ..streaming import jobs as ST
from ..operators import sentiment as S
from ..operators.validation import Limits, keep_first, violations
from ..session import materialize, read_table, spread, stored
from ..sources.tables import LINE_STRIDE, documents_to_sentences, embeddings_as_vectors
from .analyze import analyze
from .inputs import conv_sentences, doc_aspects, doc_lexicon, doc_lines, doc_sentences

SCORE_COLS = ["request_id", "dataset", "pos", "id", "neg_score", "neu_score", "pos_score",
              "compound", "label"]
THEME_KEY = ["request_id", "dataset", "theme"]
CONV_KEY = ["request_id", "dataset", "cluster_id"]


def scored_doc_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.score_sentences(doc_sentences(spark, sf_dir), doc_lexicon(spark))


# -- sources and validation -------------------------------------------------

def q_sentences_documents(spark, sf_dir):
    """SRC4: every document line as a sentence row."""
    return doc_lines(spark, sf_dir)


def q_validation_violations(spark, sf_dir):
    """VAL1-VAL9: all violations of the service limits, one row each."""
    return violations(documents_to_sentences(read_table(spark, sf_dir, "documents")), limits=Limits())


def q_keep_first_by_text(spark, sf_dir):
    """VAL11: content-addressed ids (md5 of the sentence), first copy kept."""
    s = doc_sentences(spark, sf_dir).withColumn("id", F.md5("sentence"))
    return keep_first(s).select("request_id", "dataset", "id", "pos")


# -- sentiment ---------------------------------------------------------------

def q_sentence_scores(spark, sf_dir):
    """SEN1-SEN4: rule-based scores and labels of every valid sentence."""
    return scored_doc_sentences(spark, sf_dir).select(*SCORE_COLS)


def q_sentence_details(spark, sf_dir):
    """SEN10, SEN13: per-sentence detail rows."""
    return S.sentence_details(scored_doc_sentences(spark, sf_dir))


def theme_sentiment(spark, sf_dir):
    return S.cluster_sentiment(scored_doc_sentences(spark, sf_dir), group=THEME_KEY)


def q_theme_sentiment(spark, sf_dir):
    """SEN5-SEN9: sentiment per (survey, dataset, given theme)."""
    return theme_sentiment(spark, sf_dir)


def q_request_sentiment(spark, sf_dir):
    """SEN12: overall sentiment per survey from size-weighted theme averages."""
    return S.overall_sentiment(theme_sentiment(spark, sf_dir), group=["request_id"])


def q_aspect_sentiment(spark, sf_dir):
    """SEN14: sentiment per aspect from an aspect-term table."""
    return S.aspect_sentiment(scored_doc_sentences(spark, sf_dir), doc_aspects(spark))


QUERIES = {
    "sentences_documents": q_sentences_documents,
    "validation_violations": q_validation_violations,
    "keep_first_by_text": q_keep_first_by_text,
    "sentence_scores": q_sentence_scores,
    "sentence_details": q_sentence_details,
    "theme_sentiment": q_theme_sentiment,
    "request_sentiment": q_request_sentiment,
    "aspect_sentiment": q_aspect_sentiment,
}


# -- keywords, phrases, titles, insights ---------------------------------------

def q_keywords(spark, sf_dir):
    """KEY1-KEY9: top keywords per (survey, dataset, theme)."""
    return K.keywords(doc_sentences(spark, sf_dir), THEME_KEY)


def q_keywords_conversations(spark, sf_dir):
    """KEY1-KEY9 on many tiny requests: one cluster per conversation side."""
    s = conv_sentences(spark, sf_dir).withColumn("cluster_id", F.lit(0))
    return K.keywords(s, CONV_KEY)


def q_phrases(spark, sf_dir):
    """KEY10: common adjacent word pairs per theme."""
    return K.phrases(doc_sentences(spark, sf_dir), THEME_KEY)


def q_titles(spark, sf_dir):
    """KEY11-KEY12: theme titles from keywords."""
    s = doc_sentences(spark, sf_dir)
    t = K.titles(s, materialize(K.keywords(s, THEME_KEY)), THEME_KEY)
    return t.select(*THEME_KEY, F.array_join("keywords", "|").alias("keywords"), "title")


def theme_insights(spark, sf_dir):
    s = doc_sentences(spark, sf_dir)
    sent = materialize(S.cluster_sentiment(S.score_sentences(s, doc_lexicon(spark)), THEME_KEY))
    kw_lists = materialize(K.keyword_lists(K.keywords(s, THEME_KEY), THEME_KEY))
    sizes = K.cluster_sizes(s, THEME_KEY)
    totals = s.groupBy("request_id", "dataset").agg(F.count(F.lit(1)).alias("total"))
    return I.insights(sizes, totals, sent, kw_lists, K.phrases(s, THEME_KEY),
                      I.keyword_mentions(s, kw_lists, THEME_KEY), THEME_KEY)


def q_insights(spark, sf_dir):
    """INS1-INS7: up to three template insights per theme."""
    return theme_insights(spark, sf_dir).select(
        *THEME_KEY, F.array_join("key_insights", " | ").alias("key_insights"))


QUERIES.update({
    "keywords": q_keywords,
    "keywords_conversations": q_keywords_conversations,
    "phrases": q_phrases,
    "titles": q_titles,
    "insights": q_insights,
})


# -- report assembly and comparison (given themes as clusters) -----------------

def theme_parts(spark, sf_dir):
    """Sentences, assignments and cluster rows with ``theme`` as cluster."""
    s = doc_sentences(spark, sf_dir)
    sent = materialize(S.cluster_sentiment(S.score_sentences(s, doc_lexicon(spark)), THEME_KEY))
    kw = materialize(K.keywords(s, THEME_KEY))
    themes = materialize(K.titles(s, kw, THEME_KEY))
    kw_lists = themes.select(*THEME_KEY, "keywords")
    sizes = K.cluster_sizes(s, THEME_KEY)
    totals = s.groupBy("request_id", "dataset").agg(F.count(F.lit(1)).alias("total"))
    ins = I.insights(sizes, totals, sent, kw_lists, K.phrases(s, THEME_KEY),
                     I.keyword_mentions(s, kw_lists, THEME_KEY), THEME_KEY)
    assignments = s.select("request_id", "dataset", "pos", "theme")
    clusters = R.cluster_rows(assignments, sent, themes, ins, cluster_col="theme")
    return s, assignments, clusters


def q_theme_report(spark, sf_dir):
    """ASM1, ASM3-ASM5: cluster rows of the report, ranked per survey."""
    _, _, clusters = theme_parts(spark, sf_dir)
    return clusters.select(
        "request_id", "dataset", "cluster_id", "id", "title", "size", "overall", "average_score",
        "positive", "neutral", "negative", F.array_join("keywords", "|").alias("keywords"),
        F.array_join("key_insights", " | ").alias("key_insights"), "source", "rank")


def q_theme_summary(spark, sf_dir):
    """ASM6: per survey totals, clusters found, unclustered, overall sentiment."""
    s, assignments, clusters = theme_parts(spark, sf_dir)
    a = assignments.select("request_id", "dataset", "pos", F.lit(0).alias("cluster_id"))
    return R.summary(s, a, clusters)


def q_theme_comparison(spark, sf_dir):
    """CMP1: baseline-only, comparison-only and shared theme titles."""
    _, _, clusters = theme_parts(spark, sf_dir)
    return R.theme_comparison(clusters)


def q_joint_sources(spark, sf_dir):
    """CLU14, CMP3: per joint theme, sentence counts by source, ratio, class."""
    a = doc_sentences(spark, sf_dir).select("request_id", "dataset", "pos",
                                            F.col("theme").alias("cluster_id"))
    return R.joint_source_counts(a)


def q_share_shift(spark, sf_dir):
    """CMP4 (shift), CMP6: share shift with two-proportion z, sentiment shift."""
    scored = materialize(scored_doc_sentences(spark, sf_dir).select("request_id", "dataset", "pos", "theme", "compound"))
    a = scored.select("request_id", "dataset", "pos", F.col("theme").alias("cluster_id"))
    return R.share_shift(a, scored)


def q_key_statements(spark, sf_dir):
    """CMP4: what a joint theme's two datasets share and how they differ."""
    s = doc_sentences(spark, sf_dir)
    joint = s.withColumnRenamed("theme", "cluster_id")
    scored = materialize(S.score_sentences(s, doc_lexicon(spark)).select("request_id", "dataset", "pos", "compound"))
    kw = materialize(K.keyword_lists(K.keywords(joint, CONV_KEY), CONV_KEY))
    side = lambda d: kw.where(F.col("dataset") == d).drop("dataset")
    out = R.key_statements(R.share_shift(joint.select(*CONV_KEY, "pos"), scored), side("baseline"), side("comparison"))
    return out.select("request_id", "cluster_id", F.array_join("key_similarities", " | ").alias("key_similarities"),
                      F.array_join("key_differences", " | ").alias("key_differences"))


def q_theme_grid(spark, sf_dir):
    """SEN11, INS8: each theme of a survey in each of its datasets, without sentences too."""
    s = doc_sentences(spark, sf_dir)
    sizes = materialize(K.cluster_sizes(s, THEME_KEY))
    grid = sizes.select("request_id", "theme").distinct().join(
        sizes.select("request_id", "dataset").distinct(), "request_id")
    sent = materialize(S.cluster_sentiment(S.score_sentences(s, doc_lexicon(spark)), THEME_KEY))
    themes = materialize(K.titles(s, K.keywords(s, THEME_KEY), THEME_KEY))
    kw_lists = themes.select(*THEME_KEY, "keywords")
    totals = s.groupBy("request_id", "dataset").agg(F.count(F.lit(1)).alias("total"))
    ins = I.insights(sizes, totals, sent, kw_lists, K.phrases(s, THEME_KEY),
                     I.keyword_mentions(s, kw_lists, THEME_KEY), THEME_KEY)
    out = I.empty_cluster_themes(grid, sizes, themes, ins, THEME_KEY).join(
        S.empty_cluster_sentiment(grid, sent, THEME_KEY), THEME_KEY)
    return out.select(*THEME_KEY, "size", "title", F.array_join("keywords", "|").alias("keywords"),
                      F.array_join("key_insights", " | ").alias("key_insights"), "total_sentences", "positive",
                      "neutral", "negative", "pct_positive", "pct_neutral", "pct_negative", "overall",
                      "average_score", "median", "std", "min", "max")


QUERIES.update({
    "key_statements": q_key_statements,
    "theme_grid": q_theme_grid,
    "theme_report": q_theme_report,
    "theme_summary": q_theme_summary,
    "theme_comparison": q_theme_comparison,
    "joint_sources": q_joint_sources,
    "share_shift": q_share_shift,
})


# -- operational metrics over the event log --------------------------------------

def _log(spark, sf_dir):
    # Days and bins are UTC calendar units; the log's timestamps are UTC.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return L.parse(read_table(spark, sf_dir, "events"))


def q_log_counts(spark, sf_dir):
    """OPS1-OPS3: parsed log, filtered to one month, counts per event type."""
    log = L.select_events(_log(spark, sf_dir), start="2024-01-01", end="2024-02-01")
    return L.counts(log)


def q_log_error_rate(spark, sf_dir):
    """OPS4: error rate per day."""
    return L.error_rate(_log(spark, sf_dir))


def q_log_duration_stats(spark, sf_dir):
    """OPS5, OPS8: average, max and exact p50/p95/p99 duration per event type."""
    return L.duration_stats(_log(spark, sf_dir))


def q_log_alarms(spark, sf_dir):
    """OPS8: per event type the error rate and p95 with their alarm flags."""
    return L.alarms(_log(spark, sf_dir), group=["event_type"])


def q_log_slowest(spark, sf_dir):
    """OPS5: the 20 slowest events (a top-n report)."""
    return L.slowest(_log(spark, sf_dir), 20)


def q_log_cold_warm(spark, sf_dir):
    """OPS6: session-opening (cold) versus warm events, 15-minute gap."""
    return L.cold_warm(_log(spark, sf_dir))


def q_log_error_context(spark, sf_dir):
    """OPS7: events within five events of an error (per user and day)."""
    return L.error_context(_log(spark, sf_dir)).select("event_id", "user_id", "event_type")


def q_log_bins(spark, sf_dir):
    """OPS10: 5-minute bins of average/max duration and average k."""
    return L.five_minute_bins(_log(spark, sf_dir))


def q_analysis_metrics(spark, sf_dir):
    """OPS9: sentences, clusters, average cluster size, unclustered ratio."""
    a = doc_sentences(spark, sf_dir).select("request_id", "dataset", "pos",
                                            F.col("theme").alias("cluster_id"))
    return L.analysis_metrics(a)


# -- vectors and clustering on the embeddings table (given labels) --------------

EMB_DIM = 64


def _vectors(spark, sf_dir):
    return embeddings_as_vectors(read_table(spark, sf_dir, "embeddings"))


def q_emb_normalize(spark, sf_dir):
    """EMB2: unit-length vectors, one row per (vector, dimension)."""
    v = E.normalize(_vectors(spark, sf_dir))
    return v.select(F.col("vec_id") if "vec_id" in v.columns else F.col("pos").alias("vec_id"),
                    F.posexplode("embedding").alias("i", "value")).select(
        "vec_id", "i", F.round("value", 6).alias("value"))


def q_emb_dimensions(spark, sf_dir):
    """EMB4: per dataset rows, dimension range, rows of the wrong size."""
    return E.dimension_check(_vectors(spark, sf_dir), EMB_DIM)


def q_emb_cosine_centroid(spark, sf_dir):
    """EMB5: cosine similarity of each vector to its label's centroid."""
    v = _vectors(spark, sf_dir)
    c = E.centroids(v, ["given_label"], EMB_DIM)
    return v.join(c, "given_label").select(
        F.col("pos").alias("vec_id"), "given_label",
        F.round(cosine("embedding", "centroid"), 6).alias("cosine"))


def q_cluster_stats_given(spark, sf_dir):
    """CLU6-CLU8: stats, squared-Euclidean silhouette and the acceptance gate."""
    v = _vectors(spark, sf_dir)
    pts = CL.array_points(v, EMB_DIM)
    lab = v.select("request_id", "dataset", "pos", F.col("given_label").alias("cluster_id"))
    st = CL.cluster_stats(lab)
    q = CL.silhouette(pts, lab, EMB_DIM)
    j = st.join(q, ["request_id", "dataset"])
    return j.select("request_id", "dataset", "n", "n_clusters", "noise_count",
                    F.round("noise_ratio", 6).alias("noise_ratio"),
                    F.round("quality", 6).alias("quality"), CL.accepted(j).alias("accepted"))


def q_cluster_params(spark, sf_dir):
    """CLU1, CLU3, CLU4, CLU9: adaptive sizes and k range per dataset."""
    docs = doc_sentences(spark, sf_dir)
    convs = conv_sentences(spark, sf_dir)
    both = docs.select("request_id", "dataset", "pos").unionByName(
        convs.select("request_id", "dataset", "pos"))
    return CL.cluster_params(both)


def q_noise_reassign_given(spark, sf_dir):
    """CLU11: noise vectors take the label of the nearest cluster centroid."""
    v = _vectors(spark, sf_dir)
    pts = CL.array_points(v, EMB_DIM)
    lab = v.select("request_id", "dataset", "pos", F.col("given_label").alias("cluster_id"))
    out = CL.reassign_noise(pts, lab, EMB_DIM)
    noise = lab.where("cluster_id = -1").select("request_id", "dataset", "pos")
    return out.join(noise, ["request_id", "dataset", "pos"]).select(
        F.col("pos").alias("vec_id"), "cluster_id")


def q_small_cluster_merge(spark, sf_dir):
    """CLU12: clusters past the 5 largest (or under 3 rows) become 'Other' (-2)."""
    v = _vectors(spark, sf_dir)
    lab = v.select("request_id", "dataset", "pos", F.col("given_label").alias("cluster_id"))
    return CL.merge_small_clusters(lab, min_size=3, max_clusters=5).select(
        F.col("pos").alias("vec_id"), "cluster_id")


def q_rand_index_labels(spark, sf_dir):
    """CLU16: Rand index between two labelings (quality vs toxic flags)."""
    lab = read_table(spark, sf_dir, "labels").withColumn("g", F.lit("labels"))
    a = lab.select("g", "doc_id", F.col("quality").alias("label_a"))
    b = lab.select("g", "doc_id", F.col("toxic").alias("label_b"))
    return CL.rand_index(a, b, ["doc_id"], ["g"])


# -- rows-only: model fits and the full pipeline ---------------------------------

def q_analysis_pipeline(spark, sf_dir):
    """End to end: validate, embed, reduce, k-means, score, keywords, report."""
    out = analyze(doc_sentences(spark, sf_dir), doc_lexicon(spark))
    return out["clusters"].select(
        "request_id", "dataset", "cluster_id", "id", "title", "size", "overall", "average_score",
        F.array_join("keywords", "|").alias("keywords"),
        F.array_join("key_insights", " | ").alias("key_insights"), "rank")


def q_kmeans_embeddings(spark, sf_dir):
    """CLU2, CLU9, CLU10: PCA(5) then k-means with k search on the vectors."""
    v = _vectors(spark, sf_dir)
    pts = CL.reduce_pca(v, EMB_DIM, 5)
    assign, quality = CL.kmeans_cluster(pts, 5)
    return assign.join(quality.select("request_id", "dataset", "n_clusters", "quality"),
                       ["request_id", "dataset"]).select(
        F.col("pos").alias("vec_id"), "cluster_id", "n_clusters", "quality")


def q_bisecting_subclusters(spark, sf_dir):
    """CLU15: themes and sub-themes, each level split by k-means in one plan."""
    v = _vectors(spark, sf_dir)
    pts = CL.reduce_pca(v, EMB_DIM, 5)
    return CL.nested_themes(pts, 5).select(F.col("pos").alias("vec_id"), "top", "sub")


def q_embed_sentences(spark, sf_dir):
    """EMB1, EMB6: hashed TF-IDF vectors, each distinct sentence encoded once."""
    v = E.embed(doc_sentences(spark, sf_dir))
    return v.select("request_id", "dataset", "pos", F.size("embedding").alias("dim"),
                    F.round(norm2("embedding"), 6).alias("norm"))


QUERIES.update({
    "log_counts": q_log_counts,
    "log_error_rate": q_log_error_rate,
    "log_duration_stats": q_log_duration_stats,
    "log_alarms": q_log_alarms,
    "log_slowest": q_log_slowest,
    "log_cold_warm": q_log_cold_warm,
    "log_error_context": q_log_error_context,
    "log_bins": q_log_bins,
    "analysis_metrics": q_analysis_metrics,
    "emb_normalize": q_emb_normalize,
    "emb_dimensions": q_emb_dimensions,
    "emb_cosine_centroid": q_emb_cosine_centroid,
    "cluster_stats_given": q_cluster_stats_given,
    "cluster_params": q_cluster_params,
    "noise_reassign_given": q_noise_reassign_given,
    "small_cluster_merge": q_small_cluster_merge,
    "rand_index_labels": q_rand_index_labels,
    "analysis_pipeline": q_analysis_pipeline,
    "kmeans_embeddings": q_kmeans_embeddings,
    "bisecting_subclusters": q_bisecting_subclusters,
    "embed_sentences": q_embed_sentences,
})


# -- request JSON sources and sinks -------------------------------------------

def _doc_request_bodies(spark, sf_dir):
    """One JSON request body per document: its lines are the baseline."""
    d = spread(read_table(spark, sf_dir, "documents"), "doc_id")
    lines = F.split("text", "\n")
    items = F.transform(lines, lambda l, i: F.struct(
        l.alias("sentence"),
        F.concat_ws("-", F.col("doc_id").cast("string"), i.cast("string")).alias("id")))
    body = F.to_json(F.struct(items.alias("baseline"), F.lit("overview").alias("query"),
                              F.col("lang").alias("theme")))
    return d.select(F.col("doc_id").cast("string").alias("request_id"), body.alias("body"))


def q_requests_json(spark, sf_dir):
    """SRC1, SRC3: JSON request bodies parsed and flattened to sentences."""
    req = RQ.parse_requests(_doc_request_bodies(spark, sf_dir))
    return RQ.flatten_requests(req)


def q_requests_corrupt(spark, sf_dir):
    """SRC2: bodies that are not JSON objects become ``json_invalid`` rows."""
    pages = read_table(spark, sf_dir, "pages").select(
        F.col("page_id").cast("string").alias("request_id"), F.col("html").alias("body"))
    return VAL.corrupt_violations(RQ.parse_requests(pages))


def q_report_json(spark, sf_dir):
    """SNK1: nested JSON report per validated conversation request."""
    s = conv_sentences(spark, sf_dir)
    valid, _ = VAL.validate(s, limits=VAL.Limits(), strict=True)
    scored = materialize(S.score_sentences(valid, doc_lexicon(spark)))
    a = scored.select("request_id", "dataset", "pos", F.lit(0).alias("cluster_id"))
    g = ["request_id", "dataset", "cluster_id"]
    sc = scored.join(a, ["request_id", "dataset", "pos"])
    sent = S.cluster_sentiment(sc, g)
    clustered = materialize(valid.join(a, ["request_id", "dataset", "pos"]))
    kw = K.keywords(clustered, g)
    themes = materialize(K.titles(clustered, kw, g))
    sizes = K.cluster_sizes(clustered, g)
    totals = valid.groupBy("request_id", "dataset").agg(F.count(F.lit(1)).alias("total"))
    ins = I.insights(sizes, totals, sent, themes.select(*g, "keywords"), K.phrases(clustered, g),
                     I.keyword_mentions(clustered, themes.select(*g, "keywords"), g), g)
    clusters = R.cluster_rows(a, sent, themes, ins)
    summ = R.summary(valid, a, clusters)
    flat = R.cluster_sentences(valid, a, scored)
    return R.nested_report(clusters, flat, summ, R.theme_comparison(clusters))


def q_history(spark, sf_dir):
    """SNK2: append a run of the theme summary to a history table, read back."""
    import os
    import uuid
    from ..session import ensure_checkpoint_dir
    path = os.path.join(ensure_checkpoint_dir(spark), "history", uuid.uuid4().hex)
    summary = q_theme_summary(spark, sf_dir)
    SK.append_history(summary, path, "2024-01-31")
    return SK.read_history(spark, path, "2024-01-31")


# -- streaming --------------------------------------------------------------------

def q_stream_scores(spark, sf_dir):
    """STR1: streamed documents scored per micro-batch (same rows as batch)."""
    return ST.score_stream(spark, sf_dir, doc_lexicon(spark)).select(*SCORE_COLS)


def q_stream_windows(spark, sf_dir):
    """STR2: hourly windows per event type under a 10-minute watermark."""
    return ST.windowed_events(spark, sf_dir)


def q_stream_dedupe(spark, sf_dir):
    """STR3: an event goes if a kept one of its user and type lies within 30 minutes before it."""
    return ST.dedupe_events(spark, sf_dir).select("event_id", "user_id", "event_type")


def q_stream_theme_windows(spark, sf_dir):
    """STR2: sentiment per theme in sliding windows; an event brings in the document of its user."""
    scores = scored_doc_sentences(spark, sf_dir)
    themes = scores.groupBy(F.floor(F.col("pos") / LINE_STRIDE).cast("long").alias("doc_id")).agg(
        F.first("theme", ignorenulls=True).alias("theme"), F.count(F.lit(1)).alias("sentences"),
        F.sum(F.round(F.col("compound") * 10000).cast("long")).alias("total"),
        F.count_if(F.col("label") == "positive").alias("positive"))
    return ST.theme_windows(spark, sf_dir, stored(themes))


def q_stream_assign(spark, sf_dir):
    """STR4: streamed vectors assigned to the nearest given-label centroid."""
    v = _vectors(spark, sf_dir).where(F.col("given_label") != -1)
    c = E.centroids(v, ["request_id", "dataset", "given_label"], EMB_DIM).withColumnRenamed(
        "given_label", "cluster_id")
    return ST.assign_stream(spark, sf_dir, c).select("vec_id", "cluster_id")


QUERIES.update({
    "requests_json": q_requests_json,
    "requests_corrupt": q_requests_corrupt,
    "report_json": q_report_json,
    "history": q_history,
    "stream_scores": q_stream_scores,
    "stream_windows": q_stream_windows,
    "stream_dedupe": q_stream_dedupe,
    "stream_theme_windows": q_stream_theme_windows,
    "stream_assign": q_stream_assign,
})


# -- comparison extras, topics, per-language keywords, output checks ---------------

def q_aligned_sentences(spark, sf_dir):
    """CMP2: each joint theme's sentences tagged baseline / comparison."""
    s = doc_sentences(spark, sf_dir)
    a = s.select("request_id", "dataset", "pos", F.col("theme").alias("cluster_id"))
    return R.aligned_sentences(s, a)


def _split_vectors(spark, sf_dir):
    v = _vectors(spark, sf_dir)
    return v.withColumn("dataset", F.when(F.col("pos") % 2 == 0, F.lit("baseline"))
                        .otherwise(F.lit("comparison")))


def q_centroid_alignment(spark, sf_dir):
    """CMP5: each comparison theme matched to the most similar baseline theme."""
    v = _split_vectors(spark, sf_dir)
    a = v.where(F.col("given_label") != -1).select(
        "request_id", "dataset", "pos", F.col("given_label").alias("cluster_id"))
    return R.centroid_alignment(v, a, EMB_DIM)


def q_event_trend(spark, sf_dir):
    """CMP7: per day and event type, share and mean value with day-over-day change."""
    log = _log(spark, sf_dir).withColumn("compound", F.col("duration"))
    return R.trend(log, "ts", ["event_type"], "1 day")


def q_algorithm_comparison(spark, sf_dir):
    """CMP8: given labels versus k-means on the same vectors, side by side."""
    v = _vectors(spark, sf_dir)
    pts = CL.array_points(v, EMB_DIM)
    given = v.select("request_id", "dataset", "pos", F.col("given_label").alias("cluster_id"))
    km, _ = CL.kmeans_cluster(CL.reduce_pca(v, EMB_DIM, 5), 5)
    rows = []
    for name, lab in (("given", given), ("kmeans", km)):
        st = CL.cluster_stats(lab).join(CL.silhouette(pts, lab, EMB_DIM), ["request_id", "dataset"])
        rows.append(st.select("request_id", "dataset", F.lit(name).alias("algorithm"), "n_clusters", "noise_ratio",
                              F.round("quality", 6).alias("quality")))
    ri = CL.rand_index(given.withColumnRenamed("cluster_id", "label_a"),
                       km.withColumnRenamed("cluster_id", "label_b"), ["pos"], ["request_id", "dataset"])
    both = rows[0].unionByName(rows[1])
    return both.join(ri.select("request_id", "dataset", F.col("rand_index").alias("rand_index_vs_given")),
                     ["request_id", "dataset"])


def q_lda_topics(spark, sf_dir):
    """KEY13: LDA topics over all document sentences (top terms per topic)."""
    topics, _ = TP.lda_topics(doc_sentences(spark, sf_dir).select("request_id", "pos", "sentence"))
    return topics.select("topic", F.array_join("terms", "|").alias("terms"))


def q_keywords_by_language(spark, sf_dir):
    """KEY14: keywords with each sentence's own language stop words."""
    s = doc_sentences(spark, sf_dir).withColumn("lang", F.col("theme"))
    return K.keywords_per_language(s, stop_word_table(spark), THEME_KEY)


def q_output_checks(spark, sf_dir):
    """VAL10: range checks on report outputs (no rows when all is in range)."""
    s, assignments, clusters = theme_parts(spark, sf_dir)
    a = assignments.select("request_id", "dataset", "pos", F.lit(0).alias("cluster_id"))
    return R.output_checks(clusters, R.summary(s, a, clusters))


QUERIES.update({
    "aligned_sentences": q_aligned_sentences,
    "centroid_alignment": q_centroid_alignment,
    "event_trend": q_event_trend,
    "algorithm_comparison": q_algorithm_comparison,
    "lda_topics": q_lda_topics,
    "keywords_by_language": q_keywords_by_language,
    "output_checks": q_output_checks,
})


def q_density_clusters(spark, sf_dir):
    """CLU5: grid-density clustering with noise on PCA(5) of the vectors."""
    v = _vectors(spark, sf_dir)
    pts = CL.reduce_pca(v, EMB_DIM, 5)
    return CL.density_cluster(pts, 5, eps_factor=0.35).select(F.col("pos").alias("vec_id"), "cluster_id")


#: The squared cut of the registered density query.
DENSITY_EPS2 = 0.0025


def q_density_reachability(spark, sf_dir):
    """CLU5: DBSCAN* at a fixed cut over the first three coordinates of every vector."""
    v = embeddings_as_vectors(read_table(spark, sf_dir, "embeddings")).where(F.size("embedding") >= 3)
    pts = CL.array_points(v.select("request_id", "dataset", "pos", "embedding"), 3)
    labels, _ = density_cuts(pts, CL.cluster_params(pts), 3, eps2=DENSITY_EPS2)
    return labels.select(F.col("pos").alias("vec_id"), "cluster_id")


def q_cluster_gate(spark, sf_dir):
    """CLU1-CLU11: density attempt, gate, k-means fallback on the vectors."""
    v = _vectors(spark, sf_dir)
    _, quality = CL.cluster(CL.reduce_pca(v, EMB_DIM, 5), 5)
    return quality


QUERIES.update({
    "density_clusters": q_density_clusters,
    "cluster_gate": q_cluster_gate,
    "density_reachability": q_density_reachability,
})


def q_kmeans_fixed_point(spark, sf_dir):
    """CLU10: points of the settled k-means that lie nearer to another cluster's mean (none)."""
    pts = CL.reduce_pca(_vectors(spark, sf_dir), EMB_DIM, 5)
    xs, ds = CL.coord_cols(5), ["request_id", "dataset"]
    lab, _ = CL.kmeans_cluster(pts, 5)
    own = pts.select(*ds, "pos", *xs).join(lab, [*ds, "pos"])
    means = own.groupBy(*ds, F.col("cluster_id").alias("other")).agg(*[F.avg(x).alias(f"m_{x}") for x in xs])
    gap = sum((F.pow(F.col(x) - F.col(f"m_{x}"), F.lit(2)) for x in xs[1:]), F.pow(F.col(xs[0]) - F.col(f"m_{xs[0]}"), F.lit(2)))
    per = own.join(means, ds).groupBy(*ds, "pos").agg(       # at most MAX_CLUSTERS means a dataset
        F.min(gap).alias("least"), F.max(F.when(F.col("other") == F.col("cluster_id"), gap)).alias("own"))
    return per.groupBy(*ds).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum((F.col("own") > F.col("least") + 1e-9).cast("long")).alias("misplaced"))


def q_theme_nesting(spark, sf_dir):
    """CLU15: themes, sub-themes, and sub-themes with more than one theme (none) per dataset."""
    pts = CL.reduce_pca(_vectors(spark, sf_dir), EMB_DIM, 5)
    ds = ["request_id", "dataset"]
    subs = CL.nested_themes(pts, 5, widths=(4, 3)).groupBy(*ds, "sub").agg(
        F.count(F.lit(1)).alias("size"), F.min("top").alias("top"), F.max("top").alias("top_to"))
    return subs.groupBy(*ds).agg(
        F.sum("size").alias("n"), F.count_distinct("top").alias("tops"),
        F.sum((F.col("top") != F.col("top_to")).cast("long")).alias("crossed"))


QUERIES.update({
    "kmeans_fixed_point": q_kmeans_fixed_point,
    "theme_nesting": q_theme_nesting,
})

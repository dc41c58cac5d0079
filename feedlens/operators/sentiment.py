"""Sentence and cluster sentiment (SEN1-SEN14).

SEN1 is a rule-based valence scorer (Hutto & Gilbert 2014) written as one
DataFrame job:

1. On the sentence row, array functions build every token's cleaned form and look
   its valence up in the lexicon, which is a literal hash table in the plan once its
   row count has been checked; beyond the bound it is joined by shuffle.
2. The look-back rules (caps, boosters, negation, "but") are worked out for the tokens
   that carry a valence, from the tokens before them in the same row.
3. The roll-up is a sum within the row, so no text and no token is shuffled: only the
   hashes of the keys are, to find keys that come more than once.  The rows of such a
   key are scored together.

Cluster statistics use exact aggregates.  The median is taken from a
histogram of the (4-decimal) compound values, a table of at most 20,001
rows per cluster, so a cluster holding a third of all rows never lands in
one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import constants as C
from ..functions.text import PUNCT_CHARS, WS_SPLIT, count_char, is_all_caps, unicode_strip
from ..schemas import LEXICON
from ..session import stored

LEXICON_BROADCAST_MAX_ROWS = 2_000_000
#: A lexicon of at most so many rows becomes a table in the plan.
LEXICON_IN_PLAN_MAX_ROWS = 10_000


def classify(c, mode: str = "standard") -> Column:
    """SEN3: positive at >= +t, negative at <= -t (bounds inclusive)."""
    t = C.THRESHOLDS.get(mode, C.THRESHOLDS["standard"])
    x = F.col(c) if isinstance(c, str) else c
    return (F.when(x >= t, F.lit("positive")).when(x <= -t, F.lit("negative"))
            .otherwise(F.lit("neutral")))


def lexicon_df(spark: SparkSession, entries=C.STARTER_LEXICON) -> DataFrame:
    return spark.createDataFrame([(t, float(v)) for t, v in entries], LEXICON)


def _lexicon_table(lexicon: DataFrame) -> DataFrame:
    """(_lw, _valence): one row for each lower-cased word that has a valence."""
    return (lexicon.select(F.lower("token").alias("_lw"), F.col("valence").cast("double"))
            .groupBy("_lw").agg(F.avg("valence").alias("_valence"))
            .where(F.col("_lw").isNotNull() & (F.col("_valence") != 0)))


def _valences(s: DataFrame, lexicon: DataFrame, max_rows: int) -> DataFrame:
    """Adds ``_hits``, ``array<struct<i, v>>``: place and valence of the tokens of ``_lw`` in the lexicon."""
    lex = _lexicon_table(lexicon)
    n = lex.count()
    if n <= max_rows:
        parts = n // 4 + 1
        bucket = lambda w: F.pmod(F.xxhash64(w), F.lit(parts)).cast("int")
        filed: list[list] = [[] for _ in range(parts)]
        for r in lex.select("_lw", "_valence", bucket(F.col("_lw")).alias("_b")).collect():    # at most max_rows
            filed[r["_b"]].append((r["_lw"], r["_valence"]))
        table = F.array(*[F.map_from_arrays(F.array(*[F.lit(w) for w, _ in rows]).cast("array<string>"),
                                            F.array(*[F.lit(v) for _, v in rows]).cast("array<double>")) for rows in filed])
        s = s.withColumn("_val", F.transform("_lw", lambda w: F.get(table, bucket(w))[w]))
        hits = F.filter(F.transform("_val", lambda v, i: F.when(v.isNotNull(), F.struct(i.alias("i"), v.alias("v")))),
                        lambda h: h.isNotNull())
        return s.withColumn("_hits", hits).drop("_val")
    s = stored(s.withColumn("_row", F.monotonically_increasing_id()))
    found = s.select("_row", F.posexplode("_lw").alias("i", "_lw")).join(lex, "_lw").groupBy("_row").agg(
        F.sort_array(F.collect_list(F.struct("i", F.col("_valence").alias("v")))).alias("_found"))
    none = F.array().cast("array<struct<i:int,v:double>>")
    return s.join(found, "_row", "left").withColumn("_hits", F.coalesce("_found", none)).drop("_row", "_found")


def _negated(w: Column) -> Column:
    return F.coalesce(w.isin(*C.NEGATION_WORDS) | w.contains("n't"), F.lit(False))


def _boost(w: Column) -> Column:
    return (F.when(w.isin(*C.BOOSTER_INCREMENT_WORDS), F.lit(C.BOOST_STEP))
            .when(w.isin(*C.BOOSTER_DECREMENT_WORDS), F.lit(-C.BOOST_STEP))
            .otherwise(F.lit(0.0)))


def _sign(v: Column) -> Column:
    return F.when(v < 0, F.lit(-1.0)).otherwise(F.lit(1.0))


def _rolled_up(sentences: DataFrame, lexicon: DataFrame, text_col: str, max_rows: int) -> DataFrame:
    """``sentences`` with ``_excl, _qm`` and the sums over tokens ``_sum, _pos, _neg, _neu, _n`` of each row."""
    text = unicode_strip(text_col)
    s = sentences.select(
        "*", F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, WS_SPLIT)).alias("_toks"),
        F.least(count_char(text_col, "!"), F.lit(C.EXCLAIM_MAX)).alias("_excl"),
        count_char(text_col, "?").alias("_qm"))
    # one column per step, so that no step is worked out again for each use of it
    s = s.withColumn("_bare", F.transform("_toks", lambda t: F.btrim(t, F.lit(PUNCT_CHARS))))
    s = s.withColumn("_lw", F.transform("_bare", lambda t, i: F.lower(
        F.when(F.length(t) <= 2, F.get("_toks", i)).otherwise(t))))
    s = _valences(s, lexicon, max_rows)
    caps = lambda i: is_all_caps(F.get("_toks", i))
    n = F.coalesce(F.size("_toks"), F.lit(0))
    s = s.withColumn("_ncaps", F.when(F.exists("_hits", lambda h: caps(h["i"])), F.size(F.filter("_toks", is_all_caps)))
                     .otherwise(0))
    s = s.withColumn("_capdiff", (F.col("_ncaps") > 0) & (F.col("_ncaps") < n))
    s = s.withColumn("_but", F.when(F.size("_hits") > 0, F.array_position("_lw", F.lit("but")).cast("int") - 1).otherwise(-1))

    def step(change):           # the value of each hit changed, its place kept
        return F.transform("_hits", lambda h: F.struct(h["i"].alias("i"), change(h["i"], h["v"]).alias("v")))

    s = s.withColumn("_hits", step(lambda i, v: v + F.when(F.col("_capdiff") & caps(i), _sign(v) * C.CAPS_STEP).otherwise(0.0)))
    for dist in (1, 2, 3):
        s = s.withColumn("_hits", step(lambda i, v: v + _sign(v) * _boost(F.get("_lw", i - dist))
                                       * C.BOOST_DISTANCE_FACTORS[dist - 1]))
        s = s.withColumn("_hits", step(lambda i, v: F.when(_negated(F.get("_lw", i - dist)), v * C.NEGATION_SCALAR).otherwise(v)))
    but = F.col("_but")
    s = s.withColumn("_hits", step(lambda i, v: F.when((but >= 0) & (i < but), v * C.BUT_BEFORE)
                                   .when((but >= 0) & (i > but), v * C.BUT_AFTER).otherwise(v)))
    total = lambda value: F.aggregate("_hits", F.lit(0.0), lambda a, h: a + value(h["v"]))
    return s.select(
        *sentences.columns, "_excl", "_qm", F.coalesce(total(lambda v: v), F.lit(0.0)).alias("_sum"),
        F.coalesce(total(lambda v: F.when(v > 0, v + 1).otherwise(0.0)), F.lit(0.0)).alias("_pos"),
        F.coalesce(total(lambda v: F.when(v < 0, v - 1).otherwise(0.0)), F.lit(0.0)).alias("_neg"),
        (n - F.coalesce(F.size(F.filter("_hits", lambda h: h["v"] != 0)), F.lit(0))).alias("_neu"), n.alias("_n"))


def _scores(rolled: DataFrame, cols) -> DataFrame:
    """``cols`` and the scores that follow from the sums of :func:`_rolled_up`."""
    q = F.col("_qm")
    punct = (F.col("_excl") * C.EXCLAIM_STEP
             + F.when(q > 1, F.when(q <= 3, q * C.QUESTION_STEP)
                      .otherwise(C.QUESTION_MAX_AMPLIFIER)).otherwise(0.0))
    ssum = F.col("_sum")
    s2 = F.when(ssum > 0, ssum + punct).when(ssum < 0, ssum - punct).otherwise(ssum)
    s = rolled.select(
        *cols, "_neu", "_n", s2.alias("_s2"),
        F.when(F.col("_pos") > F.abs("_neg"), F.col("_pos") + punct).otherwise(F.col("_pos")).alias("_pos_s"),
        F.when(F.col("_pos") < F.abs("_neg"), F.col("_neg") - punct).otherwise(F.col("_neg")).alias("_neg_s"))
    s = s.withColumn("_total", F.col("_pos_s") + F.abs("_neg_s") + F.col("_neu"))
    comp = F.col("_s2") / F.sqrt(F.col("_s2") * F.col("_s2") + C.NORMALIZE_ALPHA)
    comp = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), comp))
    empty = F.col("_n") == 0
    share = lambda c: F.round(F.abs(F.col(c) / F.col("_total")), 3)
    return s.select(
        *cols,
        F.when(empty, 0.0).otherwise(share("_neg_s")).alias("neg_score"),
        F.when(empty, 1.0).otherwise(share("_neu")).alias("neu_score"),
        F.when(empty, 0.0).otherwise(share("_pos_s")).alias("pos_score"),
        F.when(empty, 0.0).otherwise(F.round(comp, 4)).alias("compound"))


def score_sentences(sentences: DataFrame, lexicon: DataFrame, text_col: str = "sentence",
                    key=("request_id", "dataset", "pos"), mode: str = "standard",
                    in_plan_max_rows: int = LEXICON_IN_PLAN_MAX_ROWS) -> DataFrame:
    """SEN1, SEN2, SEN3, SEN4: add ``neg_score, neu_score, pos_score, compound, label``.

    ``key`` identifies a sentence; rows of one key with as many marks are scored as one text, and rows with
    a null in the key are left out.  All other input columns are carried.
    """
    key = list(key)
    carry = [c for c in sentences.columns if c not in key]
    s = sentences.select(*key, *carry).where(" AND ".join(f"`{k}` IS NOT NULL" for k in key))
    h = F.xxhash64(*key).alias("_h")
    again = stored(s.select(h).groupBy("_h").agg(F.count(F.lit(1)).alias("_c")).where("_c > 1").select("_h"))
    roll = lambda rows: _rolled_up(rows, lexicon, text_col, in_plan_max_rows)
    if again.isEmpty():
        out = _scores(roll(s), [*key, *carry])
    else:
        hashed = s.withColumn("_h", F.xxhash64(*key))
        once = _scores(roll(hashed.join(again, "_h", "left_anti").drop("_h")), [*key, *carry])
        many = hashed.join(again, "_h", "left_semi").drop("_h")
        sums = roll(many).groupBy(*key, "_excl", "_qm").agg(*[F.sum(c).alias(c) for c in ("_sum", "_pos", "_neg", "_neu", "_n")])
        out = once.unionByName(many.join(_scores(sums, key), key))
    return out.withColumn("label", classify("compound", mode))


def sentence_details(scores: DataFrame) -> DataFrame:
    """SEN10 + SEN13: per-sentence detail row (text cut to 100 chars)."""
    return scores.select(
        "request_id", "dataset", "pos", "id",
        F.substring("sentence", 1, 100).alias("text"),
        F.col("label").alias("sentiment"),
        F.round("compound", 3).alias("compound"),
        F.round("pos_score", 2).alias("pos_score"),
        F.round("neu_score", 2).alias("neu_score"),
        F.round("neg_score", 2).alias("neg_score"),
        F.greatest("pos_score", "neg_score", "neu_score").alias("confidence"))


def exact_median(df: DataFrame, group: list[str], value: str, weight: str | None = None,
                 out: str = "median") -> DataFrame:
    """Exact (weighted) median per group from a value histogram.

    ``value`` must take few distinct values per group (rounded scores), so the
    histogram, not the group, is what a task holds.  Even totals give the mean
    of the two middle values, as ``statistics.median`` does.
    """
    w = F.col(weight) if weight else F.lit(1)
    hist = df.groupBy(*group, value).agg(F.sum(w).cast("long").alias("_c")).where("_c > 0")
    win = Window.partitionBy(*group).orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    hist = hist.withColumn("_cum", F.sum("_c").over(win)).withColumn(
        "_n", F.sum("_c").over(Window.partitionBy(*group)))
    k1 = F.floor((F.col("_n") + 1) / 2)
    k2 = F.floor(F.col("_n") / 2) + 1
    return hist.groupBy(*group).agg(
        ((F.min(F.when(F.col("_cum") >= k1, F.col(value)))
          + F.min(F.when(F.col("_cum") >= k2, F.col(value)))) / 2).alias(out))


def cluster_sentiment(scored: DataFrame, group=("request_id", "dataset", "cluster_id"),
                      mode: str = "standard") -> DataFrame:
    """SEN5-SEN9: distribution, percentages, overall (median), statistics.

    ``scored`` holds one row per sentence with the grouping columns and
    ``compound`` (4 decimals).  One pass builds the histogram of compound
    values per group (map-side combined, at most 20,001 rows a group); every
    statistic, the exact median included, is read off that histogram.
    """
    group = list(group)
    t = C.THRESHOLDS.get(mode, C.THRESHOLDS["standard"])
    hist = scored.groupBy(*group, "compound").agg(F.count(F.lit(1)).alias("_c"))
    win = Window.partitionBy(*group).orderBy("compound").rowsBetween(Window.unboundedPreceding, 0)
    hist = hist.withColumn("_cum", F.sum("_c").over(win)).withColumn(
        "_n", F.sum("_c").over(Window.partitionBy(*group)))
    v, c = F.col("compound"), F.col("_c")
    k1 = F.floor((F.col("_n") + 1) / 2)
    k2 = F.floor(F.col("_n") / 2) + 1
    agg = hist.groupBy(*group).agg(
        F.sum(c).alias("total_sentences"),
        F.sum(F.when(v >= t, c).otherwise(0)).alias("positive"),
        F.sum(F.when((v < t) & (v > -t), c).otherwise(0)).alias("neutral"),
        F.sum(F.when(v <= -t, c).otherwise(0)).alias("negative"),
        # compound has 4 decimals: sums of compound*10^4 are exact integers.
        F.sum((F.round(v * 10000).cast("long") * c).cast("decimal(38,0)")).alias("_s1"),
        F.sum((F.round(v * 10000).cast("decimal(10,0)") * F.round(v * 10000).cast("decimal(10,0)")
               * c.cast("decimal(18,0)")).cast("decimal(38,0)")).alias("_s2"),
        F.min(v).alias("_min"),
        F.max(v).alias("_max"),
        ((F.min(F.when(F.col("_cum") >= k1, v)) + F.min(F.when(F.col("_cum") >= k2, v))) / 2)
        .alias("_median"))
    n = F.col("total_sentences")
    s1, s2 = F.col("_s1").cast("double"), F.col("_s2").cast("double")
    var = (s2 - s1 * s1 / n) / (n - 1) / 1e8
    return agg.select(
        *group, "total_sentences", "positive", "neutral", "negative",
        F.round(F.col("positive") * 100.0 / n, 1).alias("pct_positive"),
        F.round(F.col("neutral") * 100.0 / n, 1).alias("pct_neutral"),
        F.round(F.col("negative") * 100.0 / n, 1).alias("pct_negative"),
        classify(F.round("_median", 9), mode).alias("overall"),
        F.round(s1 / (n * 10000.0), 3).alias("average_score"),
        F.round("_median", 3).alias("median"),
        F.when(n > 1, F.round(F.sqrt(F.greatest(var, F.lit(0.0))), 3)).otherwise(F.lit(0.0))
        .alias("std"),
        F.round("_min", 3).alias("min"),
        F.round("_max", 3).alias("max"))


def empty_cluster_sentiment(clusters: DataFrame, sentiment: DataFrame,
                            group=("request_id", "dataset", "cluster_id")) -> DataFrame:
    """SEN11: a cluster with no sentences reports neutral, 100% neutral, zeros."""
    group = list(group)
    j = clusters.select(*group).join(sentiment, group, "left")
    z = F.lit(0.0)
    return j.select(
        *group,
        F.coalesce("total_sentences", F.lit(0).cast("long")).alias("total_sentences"),
        F.coalesce("positive", F.lit(0)).alias("positive"),
        F.coalesce("neutral", F.lit(0)).alias("neutral"),
        F.coalesce("negative", F.lit(0)).alias("negative"),
        F.coalesce("pct_positive", z).alias("pct_positive"),
        F.coalesce("pct_neutral", F.lit(100.0)).alias("pct_neutral"),
        F.coalesce("pct_negative", z).alias("pct_negative"),
        F.coalesce("overall", F.lit("neutral")).alias("overall"),
        F.coalesce("average_score", z).alias("average_score"),
        F.coalesce("median", z).alias("median"),
        F.coalesce("std", z).alias("std"),
        F.coalesce("min", z).alias("min"),
        F.coalesce("max", z).alias("max"))


def overall_sentiment(cluster_sent: DataFrame, group=("request_id",),
                      size_col: str = "total_sentences") -> DataFrame:
    """SEN12: median of each cluster's rounded average, weighted by size.

    Requests with no cluster, or only empty ones, are neutral (the caller
    left-joins from its request list and fills ``neutral``).
    """
    group = list(group)
    med = exact_median(cluster_sent, group, "average_score", weight=size_col, out="_wmedian")
    return med.select(*group, F.round("_wmedian", 6).alias("weighted_median"),
                      classify(F.round("_wmedian", 9)).alias("overall_sentiment"))


def aspect_sentiment(scored: DataFrame, aspects: DataFrame,
                     group=("request_id", "dataset")) -> DataFrame:
    """SEN14: sentiment per aspect term table ``(aspect, term)``.

    A sentence counts toward an aspect when one of its lower-case words is an
    aspect term; the term table is broadcast after a size check.
    """
    from ..functions.text import word_tokens
    group = list(group)
    terms = aspects.select("aspect", F.lower("term").alias("_term")).distinct()
    terms = F.broadcast(terms) if terms.count() <= LEXICON_BROADCAST_MAX_ROWS else terms
    words = scored.select(*group, "pos", "compound", "label",
                          F.explode(F.array_distinct(word_tokens("sentence", 2))).alias("_term"))
    hits = words.join(terms, "_term").select(*group, "aspect", "pos", "compound", "label") \
        .dropDuplicates([*group, "aspect", "pos"])
    return hits.groupBy(*group, "aspect").agg(
        F.count(F.lit(1)).alias("mentions"),
        F.round(F.avg("compound"), 3).alias("average_score"),
        F.sum((F.col("label") == "positive").cast("int")).alias("positive"),
        F.sum((F.col("label") == "neutral").cast("int")).alias("neutral"),
        F.sum((F.col("label") == "negative").cast("int")).alias("negative"))

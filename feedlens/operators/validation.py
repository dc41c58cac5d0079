"""Validation of sentences and requests (VAL1-VAL11).

Rules run per sentence, per dataset and per request, and every failure is a
row of the ``violations`` table (request_id, field, message, type,
severity).  Nothing is collected: each rule is a projection or a grouped
count, so a request of any size validates in parallel.

The size caps are parameters.  ``Limits()`` gives the request limits of the
service; ``Limits.corpus()`` switches the caps off for whole-corpus runs so
every text is kept whole.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as C
from ..functions.text import unicode_strip


@dataclass(frozen=True)
class Limits:
    sentence_max_chars: int | None = C.SENTENCE_MAX_CHARS
    id_max_chars: int | None = C.ID_MAX_CHARS
    dataset_max_items: int | None = C.DATASET_MAX_ITEMS
    total_max_items: int | None = C.TOTAL_MAX_ITEMS
    total_warn_items: int | None = C.TOTAL_WARN_ITEMS

    @staticmethod
    def corpus() -> "Limits":
        return Limits(None, None, None, None, None)


def _too_long(n: int) -> str:
    return f"String should have at most {n} character{'s' if n != 1 else ''}"


_TOO_SHORT = "String should have at least 1 character"
_NOT_STRING = "Input should be a valid string"


def _violation(df: DataFrame, field, message, typ, severity="error") -> DataFrame:
    return df.select("request_id", field.alias("field"), message.alias("message"),
                     F.lit(typ).alias("type"), F.lit(severity).alias("severity"))


def _path(*parts) -> F.Column:
    return F.concat_ws(".", *[p if not isinstance(p, str) else F.lit(p) for p in parts])


def _first(cond, field, message, typ, severity="error") -> F.Column:
    """One possible violation of a row: a struct, or null when ``cond`` does not hold."""
    return F.when(cond, F.struct(field.alias("field"), message.alias("message"),
                                 F.lit(typ).alias("type"), F.lit(severity).alias("severity")))


def _explode_violations(df: DataFrame, rules: list[F.Column]) -> DataFrame:
    """All violations of all rules in one pass over the rows."""
    found = F.filter(F.array(*rules), lambda v: v.isNotNull())
    return df.select("request_id", F.explode(found).alias("_v")).select("request_id", "_v.*")


def sentence_violations(sentences: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """VAL1, VAL3, VAL4 (and VAL9's dotted field path) per sentence row.

    A NULL sentence or id is a ``string_type`` violation.
    """
    s = sentences.select("request_id", "dataset", "pos", "id", "sentence")
    raw_len = F.length("sentence")
    at = F.coalesce(F.col("pos").cast("string"), F.lit("?"))
    sent_field = _path(F.col("dataset"), at, "sentence")
    id_field = _path(F.col("dataset"), at, "id")
    rules = [
        _first(F.col("sentence").isNull(), sent_field, F.lit(_NOT_STRING), "string_type"),
        _first(F.col("id").isNull(), id_field, F.lit(_NOT_STRING), "string_type"),
        _first(raw_len < C.SENTENCE_MIN_CHARS, sent_field, F.lit(_TOO_SHORT), "string_too_short"),
        _first(F.length("id") < C.ID_MIN_CHARS, id_field, F.lit(_TOO_SHORT), "string_too_short"),
    ]
    ok_len = raw_len >= C.SENTENCE_MIN_CHARS
    if limits.sentence_max_chars is not None:
        rules.append(_first(raw_len > limits.sentence_max_chars, sent_field,
                            F.lit(_too_long(limits.sentence_max_chars)), "string_too_long"))
        ok_len = ok_len & (raw_len <= limits.sentence_max_chars)
    if limits.id_max_chars is not None:
        rules.append(_first(F.length("id") > limits.id_max_chars, id_field,
                            F.lit(_too_long(limits.id_max_chars)), "string_too_long"))
    # VAL3 runs only once the raw length passed (as the field validator does).
    rules.append(_first(ok_len & (unicode_strip("sentence") == ""), sent_field,
                        F.lit("Value error, " + C.MSG_EMPTY_SENTENCE), "value_error"))
    return _explode_violations(s, rules)


def id_counts(sentences: DataFrame) -> DataFrame:
    """Rows per (request_id, dataset, id): what VAL5 and the size rules are read from."""
    return sentences.groupBy("request_id", "dataset", "id").agg(F.count(F.lit(1)).alias("c"))


def dataset_counts(sentences: DataFrame) -> DataFrame:
    """Sentences per (request_id, dataset); a partial aggregate, skew safe."""
    return sentences.groupBy("request_id", "dataset").agg(F.count(F.lit(1)).alias("n"))


def duplicate_id_violations(sentences: DataFrame, per_id: DataFrame | None = None) -> DataFrame:
    """VAL5: ids repeated inside one dataset; message lists up to five."""
    per_id = per_id if per_id is not None else id_counts(sentences)
    # Only the first five ids (by id) per dataset are kept before collecting,
    # so the list is bounded however many ids repeat.
    w = Window.partitionBy("request_id", "dataset").orderBy("id")
    dup = (per_id.where("c > 1 and id is not null")
           .withColumn("_rn", F.row_number().over(w))
           .where(F.col("_rn") <= C.MAX_DUPLICATES_LISTED)
           .groupBy("request_id", "dataset")
           .agg(F.array_sort(F.collect_list("id")).alias("ids")))
    return _violation(dup, F.col("dataset"),
                      F.concat(F.lit("Value error, Duplicate IDs found: "),
                               F.array_join("ids", ", ")), "value_error")


def size_violations(meta: DataFrame, counts: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """VAL6, VAL7 from per-dataset counts; VAL8 from request metadata.

    ``meta`` is one row per request (request_id, query, survey_title, theme);
    ``counts`` is the output of :func:`dataset_counts`.
    """
    per_req = (counts.groupBy("request_id").agg(
        F.sum(F.when(F.col("dataset") == "baseline", F.col("n")).otherwise(0)).alias("nb"),
        F.sum(F.when(F.col("dataset") == "comparison", F.col("n")).otherwise(0)).alias("nc")))
    per_req = meta.join(per_req, "request_id", "left").fillna(0, ["nb", "nc"])
    total = F.col("nb") + F.col("nc")
    rules = [_first(F.col("nb") == 0, F.lit("baseline"),
                    F.lit("List should have at least 1 item after validation, not 0"), "too_short")]
    if limits.dataset_max_items is not None:
        m = limits.dataset_max_items
        for name, c in (("baseline", "nb"), ("comparison", "nc")):
            rules.append(_first(F.col(c) > m, F.lit(name),
                                F.concat(F.lit(f"List should have at most {m} items after validation, not "),
                                         F.col(c).cast("string")), "too_long"))
    if limits.total_max_items is not None:
        m = limits.total_max_items
        rules.append(_first(total > m, F.lit(""),
                            F.format_string(f"Value error, Total sentences (%d) exceeds maximum ({m}). "
                                            "Baseline: %d, Comparison: %d", total, F.col("nb"), F.col("nc")),
                            "value_error"))
    if limits.total_warn_items is not None:
        w = limits.total_warn_items
        cond = total > w
        if limits.total_max_items is not None:
            cond = cond & (total <= limits.total_max_items)
        rules.append(_first(cond, F.lit(""),
                            F.format_string("Large request: %d sentences (may exceed 10s latency target)", total),
                            "large_request", severity="warning"))
    for field, limit in (("query", C.QUERY_MAX_CHARS), ("survey_title", C.SURVEY_TITLE_MAX_CHARS),
                         ("theme", C.THEME_MAX_CHARS)):
        if field in meta.columns:
            name = "surveyTitle" if field == "survey_title" else field
            rules.append(_first(F.length(field) > limit, F.lit(name), F.lit(_too_long(limit)), "string_too_long"))
    return _explode_violations(per_req, rules)


def corrupt_violations(requests: DataFrame) -> DataFrame:
    """SRC2: a request whose body did not parse is one ``json_invalid`` row."""
    if "_corrupt" not in requests.columns:
        return requests.sparkSession.createDataFrame([], "request_id string, field string, "
                                                     "message string, type string, severity string")
    return _violation(requests.where(F.col("_corrupt").isNotNull()), F.lit("body"),
                      F.lit("Invalid JSON in request body"), "json_invalid")


def meta_from_sentences(sentences: DataFrame) -> DataFrame:
    """Request metadata when only sentences are given (corpus mode)."""
    return sentences.select("request_id").distinct().select(
        "request_id", F.lit(C.DEFAULT_QUERY).alias("query"),
        F.lit(None).cast("string").alias("survey_title"), F.lit(None).cast("string").alias("theme"))


def violations(sentences: DataFrame, meta: DataFrame | None = None,
               limits: Limits = Limits()) -> DataFrame:
    """VAL9: every violation of every rule, one row each."""
    meta = meta if meta is not None else meta_from_sentences(sentences)
    per_id = id_counts(sentences)
    counts = per_id.groupBy("request_id", "dataset").agg(F.sum("c").alias("n"))
    return (sentence_violations(sentences, limits)
            .unionByName(duplicate_id_violations(sentences, per_id))
            .unionByName(size_violations(meta, counts, limits)))


def keep_first(sentences: DataFrame) -> DataFrame:
    """VAL11: repair duplicate ids by keeping the first occurrence.

    ``row_number`` over (request, dataset, id): the partition is one id, so
    even a survey holding a third of all rows spreads over many tasks.
    """
    w = Window.partitionBy("request_id", "dataset", "id").orderBy("pos")
    return sentences.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def validate(sentences: DataFrame, meta: DataFrame | None = None, limits: Limits = Limits(),
             on_duplicate: str = "reject", strict: bool = True):
    """Return ``(valid_sentences, violations)``.

    ``valid_sentences`` carries the stripped sentence (VAL2).  Rows failing a
    sentence rule are dropped; with ``strict`` any error rejects the whole
    request, as the service does.  ``on_duplicate='keep_first'`` repairs
    duplicate ids (VAL11) instead of reporting them.
    """
    meta = meta if meta is not None else meta_from_sentences(sentences)
    src = keep_first(sentences) if on_duplicate == "keep_first" else sentences
    viol = violations(src, meta, limits)
    raw_len = F.length("sentence")
    ok = (raw_len >= C.SENTENCE_MIN_CHARS) & (F.length("id") >= C.ID_MIN_CHARS)
    if limits.sentence_max_chars is not None:
        ok = ok & (raw_len <= limits.sentence_max_chars)
    if limits.id_max_chars is not None:
        ok = ok & (F.length("id") <= limits.id_max_chars)
    valid = src.where(ok).withColumn("sentence", unicode_strip("sentence")).where(
        F.col("sentence") != "")
    if strict:
        bad = viol.where(F.col("severity") == "error").select("request_id").distinct()
        valid = valid.join(bad, "request_id", "left_anti")
    return valid, viol

"""Shared inputs of the registered queries: sentences, lexicon, aspect terms.

The documents are pseudo-words in four languages, so the sentiment queries
use a query-local lexicon: the English starter lexicon plus a few frequent
pseudo-words with invented valences.  The same fixed table is written into
the oracle SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..constants import STARTER_LEXICON
from ..operators.validation import Limits, validate
from ..session import materialize, read_table, spread
from ..sources.tables import conversations_to_sentences, documents_to_sentences

# ---------------------------------------------------------------------------
# FIXED VALUES: query-local valences of frequent pseudo-words in `documents`
# ---------------------------------------------------------------------------
DOC_PSEUDO_LEXICON = (
    ("rewh", 1.8), ("orre", -1.5), ("thatin", 2.1), ("ononst", -2.3),
    ("inoran", 1.2), ("hehely", -0.9), ("orantion", 2.6), ("eau", 0.8),
    ("elle", -1.1), ("tion", 0.5), ("ment", -0.4), ("sch", -1.7),
    ("ung", 1.3), ("ble", 1.1), ("ing", -0.6), ("ther", 0.7),
    ("thth", -1.2), ("und", 0.3), ("der", -0.2), ("que", 0.4),
)
DOC_LEXICON = STARTER_LEXICON + DOC_PSEUDO_LEXICON

# FIXED VALUES: query-local aspect terms (aspect, term)
DOC_ASPECTS = (
    ("alpha", "rewh"), ("alpha", "orre"), ("alpha", "thatin"),
    ("beta", "ononst"), ("beta", "inoran"), ("beta", "eau"),
    ("gamma", "sch"), ("gamma", "ung"), ("gamma", "que"), ("gamma", "elle"),
)


def doc_lexicon(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(t, float(v)) for t, v in DOC_LEXICON],
                                 "token string, valence double")


def doc_aspects(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(DOC_ASPECTS), "aspect string, term string")


def doc_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line of every document as a raw sentence row (with ``theme``)."""
    return documents_to_sentences(spread(read_table(spark, sf_dir, "documents"), "doc_id"))


def doc_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid (stripped, non-empty) document lines, corpus limits (no caps)."""
    valid, _ = validate(doc_lines(spark, sf_dir), limits=Limits.corpus(), strict=False)
    return materialize(valid)


def conv_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    convs = spread(read_table(spark, sf_dir, "conversations"), "conv_id")
    valid, _ = validate(conversations_to_sentences(convs),
                        limits=Limits.corpus(), strict=False)
    return materialize(valid)

"""Schemas of the request, sentence and output tables."""

from pyspark.sql import types as T

SENTENCE_ITEM = T.StructType([
    T.StructField("sentence", T.StringType()),
    T.StructField("id", T.StringType()),
])

REQUEST = T.StructType([
    T.StructField("request_id", T.StringType()),
    T.StructField("baseline", T.ArrayType(SENTENCE_ITEM)),
    T.StructField("comparison", T.ArrayType(SENTENCE_ITEM)),
    T.StructField("query", T.StringType()),
    T.StructField("surveyTitle", T.StringType()),
    T.StructField("theme", T.StringType()),
])

REQUEST_WITH_CORRUPT = T.StructType(REQUEST.fields + [T.StructField("_corrupt", T.StringType())])

# request_id, dataset (baseline|comparison), pos (input order), id, sentence
SENTENCES = T.StructType([
    T.StructField("request_id", T.StringType()),
    T.StructField("dataset", T.StringType()),
    T.StructField("pos", T.LongType()),
    T.StructField("id", T.StringType()),
    T.StructField("sentence", T.StringType()),
])

VIOLATIONS = T.StructType([
    T.StructField("request_id", T.StringType()),
    T.StructField("field", T.StringType()),
    T.StructField("message", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("severity", T.StringType()),
])

LEXICON = T.StructType([
    T.StructField("token", T.StringType()),
    T.StructField("valence", T.DoubleType()),
])

SENTENCE_KEY = ["request_id", "dataset", "pos"]
DATASET_KEY = ["request_id", "dataset"]
CLUSTER_KEY = ["request_id", "dataset", "cluster_id"]

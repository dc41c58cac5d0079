"""SRC4: prepared parquet tables as sentence / vector inputs.

The synthetic tables stand in for feedback:

* ``documents``: each line of ``text`` is a sentence, ``source`` is the
  request (survey), documents of even length (``n_chars``) are the
  baseline and the others the comparison, and ``lang`` is a given theme.
* ``conversations``: each conversation is a small request, user turns are
  the baseline and assistant turns the comparison.
* ``embeddings``: vectors with a given label per row (label 0 stands for
  noise, -1).

These mappings only shape rows into the ``sentences`` schema; the operators
downstream do not depend on how the rows were made.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Position of a line inside its request: doc (or turn) major, line minor.
LINE_STRIDE = 1_000_000


def _lines(col: str) -> F.Column:
    """The lines of a text; a NULL text is one NULL line, which validation reports."""
    return F.coalesce(F.split(col, "\n"), F.array(F.lit(None).cast("string")))


def documents_to_sentences(docs: DataFrame, with_theme: bool = True) -> DataFrame:
    lines = docs.select("doc_id", "source", "lang", "n_chars",
                        F.posexplode(_lines("text")).alias("line_no", "sentence"))
    cols = [
        F.col("source").alias("request_id"),
        F.when(F.coalesce(F.col("n_chars"), F.lit(0)) % 2 == 0, F.lit("baseline"))
        .otherwise(F.lit("comparison")).alias("dataset"),
        (F.col("doc_id") * LINE_STRIDE + F.col("line_no")).cast("long").alias("pos"),
        F.concat_ws("-", F.col("doc_id").cast("string"), F.col("line_no").cast("string"))
        .alias("id"),
        F.col("sentence"),
    ]
    if with_theme:
        cols.append(F.col("lang").alias("theme"))
    return lines.select(*cols)


def conversations_to_sentences(convs: DataFrame) -> DataFrame:
    lines = convs.select("conv_id", "turn", "role",
                         F.posexplode(_lines("text")).alias("line_no", "sentence"))
    return lines.select(
        F.concat(F.lit("conv-"), F.col("conv_id").cast("string")).alias("request_id"),
        F.when(F.col("role") == "user", F.lit("baseline")).otherwise(F.lit("comparison"))
        .alias("dataset"),
        (F.col("turn") * LINE_STRIDE + F.col("line_no")).cast("long").alias("pos"),
        F.concat_ws("-", F.col("turn").cast("string"), F.col("line_no").cast("string"))
        .alias("id"),
        F.col("sentence"),
    )


def embeddings_as_vectors(emb: DataFrame, request_id: str = "corpus") -> DataFrame:
    """Vectors keyed like sentences; ``given_label`` 0 becomes noise (-1)."""
    return emb.select(
        F.lit(request_id).alias("request_id"),
        F.lit("baseline").alias("dataset"),
        F.col("vec_id").cast("long").alias("pos"),
        F.col("vec_id").cast("string").alias("id"),
        F.col("embedding"),
        F.when(F.col("label") == 0, F.lit(-1)).otherwise(F.col("label")).alias("given_label"),
    )

"""Request sources: JSON requests in, flat ``sentences`` rows out.

SRC1  read request JSON (files, or a string column of bodies)
SRC2  malformed JSON becomes a corrupt-record row, never a failed batch
SRC3  flatten ``baseline`` / ``comparison`` arrays into ordered sentences
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import DEFAULT_QUERY
from ..schemas import REQUEST, REQUEST_WITH_CORRUPT

_JSON_OPTIONS = {
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": "_corrupt",
    "allowSingleQuotes": "false",
}


def _with_request_id(df: DataFrame) -> DataFrame:
    # A request without an explicit id gets a content hash: stable across retries.
    return df.withColumn(
        "request_id",
        F.coalesce(F.col("request_id"),
                   F.sha2(F.coalesce(F.col("_corrupt"), F.to_json(F.struct(
                       "baseline", "comparison", "query", "surveyTitle", "theme"))), 256)))


def read_requests(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """SRC1/SRC2: read JSON requests (one per line, or one per file)."""
    df = (spark.read.schema(REQUEST_WITH_CORRUPT).options(**_JSON_OPTIONS)
          .option("multiLine", str(multiline).lower()).json(path))
    return _with_request_id(df)


def parse_requests(bodies: DataFrame, body_col: str = "body",
                   id_col: str | None = "request_id") -> DataFrame:
    """SRC1/SRC2: parse a string column of JSON bodies.

    A body that is not a JSON object (bad syntax, single quotes, an array)
    keeps its text in ``_corrupt`` and NULL fields.
    """
    parsed = F.from_json(F.col(body_col), REQUEST_WITH_CORRUPT, _JSON_OPTIONS)
    out = bodies.select(
        (F.col(id_col) if id_col and id_col in bodies.columns else F.lit(None).cast("string"))
        .alias("_given_id"), parsed.alias("r"), F.col(body_col).alias("_body"))
    out = out.select(
        F.coalesce("_given_id", F.col("r.request_id")).alias("request_id"),
        "r.baseline", "r.comparison", "r.query", "r.surveyTitle", "r.theme",
        F.when(F.col("r").isNull() | F.col("r._corrupt").isNotNull(), F.col("_body"))
        .alias("_corrupt"))
    return _with_request_id(out)


def flatten_requests(requests: DataFrame) -> DataFrame:
    """SRC3: one row per sentence, input order kept in ``pos``, dataset tagged."""
    parts = []
    for ds in ("baseline", "comparison"):
        parts.append(
            requests.where(F.col("_corrupt").isNull() if "_corrupt" in requests.columns else F.lit(True))
            .select("request_id", F.lit(ds).alias("dataset"),
                    F.posexplode(F.col(ds)).alias("pos", "item"))
            .select("request_id", "dataset", F.col("pos").cast("long").alias("pos"),
                    F.col("item.id").alias("id"), F.col("item.sentence").alias("sentence")))
    return parts[0].unionByName(parts[1])


def request_meta(requests: DataFrame) -> DataFrame:
    """Per request metadata (query default ``overview``) and array sizes."""
    ok = requests.where(F.col("_corrupt").isNull()) if "_corrupt" in requests.columns else requests
    return ok.select(
        "request_id",
        F.coalesce(F.col("query"), F.lit(DEFAULT_QUERY)).alias("query"),
        F.col("surveyTitle").alias("survey_title"),
        "theme",
        F.coalesce(F.size("baseline"), F.lit(-1)).alias("n_baseline_items"),
        F.when(F.col("comparison").isNull(), F.lit(0))
        .otherwise(F.size("comparison")).alias("n_comparison_items"),
        F.col("baseline").isNull().alias("baseline_missing"),
    )


def requests_from_rows(spark: SparkSession, rows: list[dict]) -> DataFrame:
    """Build a requests DataFrame from Python dicts (tests and examples)."""
    df = spark.createDataFrame(
        [(r.get("request_id"), r.get("baseline"), r.get("comparison"), r.get("query"),
          r.get("surveyTitle"), r.get("theme")) for r in rows], REQUEST)
    return _with_request_id(df.withColumn("_corrupt", F.lit(None).cast("string")))

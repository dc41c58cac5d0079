"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

#: What splits words everywhere in this package: blank, tab, LF, VT, FF, CR.
WORD = r"[^\x20\x09-\x0D]+"


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared checkpoint folder of the session."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts the lineage with a table that every executor can read again, so a lost
    executor never repeats the steps before it.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_of(column: str = "text"):
    return F.coalesce(F.col(column), F.lit(""))

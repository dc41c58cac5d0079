import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from feedlens.session import ensure_checkpoint_dir  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = (SparkSession.builder.master("local[4]")
         .config("spark.sql.shuffle.partitions", "4")
         .config("spark.ui.enabled", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.adaptive.enabled", "true")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(s)
    yield s


SENT_SCHEMA = "request_id string, dataset string, pos long, id string, sentence string"


def sentences(spark, texts, request_id="r", dataset="baseline", ids=None):
    ids = ids or [str(i) for i in range(len(texts))]
    return spark.createDataFrame(
        [(request_id, dataset, i, ids[i], t) for i, t in enumerate(texts)], SENT_SCHEMA)

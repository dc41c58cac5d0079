"""Exact deduplication by a stateful stream with disk-backed keyed state.

A Structured Streaming job reads the files of a folder as they arrive and
groups rows by the SHA-256 digest of their whole text.  The RocksDB state store
holds, without any expiry, one entry for each digest: how many rows had it, the
stable identifier of the row that stays (the largest id) and the locator of its
content (file and row number).  A stopped stream goes on from its checkpoint,
and later files meet the digests of earlier ones.

The state is then read as a table.  Every hit (a digest of more than one row) is
checked by full bytes: rows of hit digests are grouped by their text itself.
If one digest ever had two texts, its rows are split by text.

Hot texts: the count and the maximum are pre-aggregated before each shuffle, so
a text that a third of all rows share sends one partial row per task.

Defined results: a null text counts as empty, and all empty texts are one group;
a null id loses against every other id; of rows with the same text and the same
id, the one that comes last in its file (then the last file) stays; an empty
folder gives no rows; other columns are never read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import saved, scratch

#: Disk-backed state; its files are not allocated ahead, as there is one store for each partition.
_STORE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}
_KEEPER = "struct<id:{id},file:string,row:bigint>"


def _rows(raw: DataFrame, id_col: str, text: Column) -> DataFrame:
    """(digest, id, file, row, text) of each row; ``file`` is the file's name alone."""
    return raw.select(
        F.col(id_col).alias("id"),
        F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1).alias("file"),
        F.col("_metadata.row_index").alias("row"),
        text.alias("text"),
    ).select(F.unhex(F.sha2(F.encode("text", "utf-8"), 256)).alias("digest"), "*")


def absorb(spark: SparkSession, path: str, state_dir: str, id_col: str = "doc_id",
           text_col: str = "text", files_per_batch: int | None = None) -> DataFrame:
    """Take all files of ``path`` not yet seen into the state kept in ``state_dir``.

    Returns the state: ``digest``, ``n`` (rows so far) and ``keeper`` (id, file and
    row of the row that stays).  Call it again with the same folders after new
    files came.
    """
    schema = spark.read.parquet(path).schema
    reader = spark.readStream.schema(schema).option("maxFileAge", "36500d")    # late files with old time stamps count too
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    pattern = f"{path[:-1]}[{path[-1]}]"        # a pattern may also name one single file
    rows = _rows(reader.parquet(pattern), id_col, F.coalesce(F.col(text_col), F.lit("")))
    counted = rows.groupBy("digest").agg(
        F.count(F.lit(1)).alias("n"), F.max(F.struct("id", "file", "row")).alias("keeper"))
    before = {k: spark.conf.get(k, None) for k in _STORE}
    for k, v in _STORE.items():
        spark.conf.set(k, v)
    try:
        (counted.writeStream.outputMode("update").format("noop")
         .option("checkpointLocation", state_dir).trigger(availableNow=True).start().awaitTermination())
        state = spark.read.format("statestore").load(state_dir)
        # the store's value holds the two aggregates in the order they were asked for
        n, keeper = (f.name for f in state.schema["value"].dataType.fields)
        kind = _KEEPER.format(id=schema[id_col].dataType.simpleString())
        return saved(state.select(F.col("key.digest").alias("digest"), F.col(f"value.`{n}`").alias("n"),
                                  F.col(f"value.`{keeper}`").cast(kind).alias("keeper")), "digests")
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def exact_dedup(spark: SparkSession, path: str, id_col: str = "doc_id", text_col: str = "text",
                state_dir: str | None = None, files_per_batch: int | None = None) -> DataFrame:
    """One row per row of the Parquet folder ``path``: ``id``, ``keep_id``, ``group_size``,
    ``kept``, ``digest`` (binary SHA-256 of the UTF-8 text)."""
    state = absorb(spark, path, state_dir or scratch(spark, "exact-state"), id_col, text_col, files_per_batch)
    rows = _rows(spark.read.parquet(path), id_col, F.coalesce(F.col(text_col), F.lit("")))
    hits = rows.join(state.where("n > 1").select("digest"), "digest", "left_semi")
    texts = hits.groupBy("text").agg(
        F.first("digest").alias("digest"), F.count(F.lit(1)).alias("n"),
        F.max(F.struct("id", "file", "row")).alias("keeper"))
    clashes = texts.groupBy("digest").agg(F.count(F.lit(1)).alias("texts")).where("texts > 1").select("digest")
    clashes = saved(clashes, "digest-clashes")
    result = lambda df: df.select(
        "id", F.col("keeper.id").alias("keep_id"), F.col("n").alias("group_size"),
        (F.struct("id", "file", "row") == F.col("keeper")).alias("kept"), "digest")
    plain = rows.drop("text").join(state, "digest")
    if clashes.isEmpty():
        return result(plain)
    split = rows.join(clashes, "digest", "left_semi").join(texts.drop("digest"), "text")
    return result(plain.join(clashes, "digest", "left_anti")).unionByName(result(split))

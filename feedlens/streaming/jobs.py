"""Structured Streaming jobs (STR1-STR4).

* STR1  sentences arriving as files are validated and scored; each
        micro-batch runs the batch scorer through ``foreachBatch`` and is
        appended to a parquet table, so stream and batch give the same rows.
* STR2  tumbling windows over events and sliding windows of sentiment per
        theme, with a watermark that bounds late data and state; the end of the
        input closes the last windows.
* STR3  repeated keys dropped within a delay, by keyed state in event time.
* STR4  new vectors assigned to existing themes: each micro-batch joins the
        static centroid table (broadcast after a size check) and keeps the
        nearest centroid.

Outputs and stream checkpoints live under the session's checkpoint folder
(``spark.checkpoint.dir``), in a fresh directory per run.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..operators import sentiment as S
from ..operators.validation import Limits, validate
from ..session import ensure_checkpoint_dir, read_table
from ..sources.tables import documents_to_sentences

CENTROID_BROADCAST_MAX_ROWS = 1_000_000


def table_stream(spark: SparkSession, sf_dir: str, name: str, max_files: int = 1) -> DataFrame:
    """A file stream over one parquet table of a folder (schema from the table)."""
    schema = read_table(spark, sf_dir, name).schema
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files)
            .parquet(os.path.join(sf_dir, f"{name}*.parquet")))


def _run_dir(spark: SparkSession, job: str) -> str:
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "streams", job, uuid.uuid4().hex)


def run_available(stream: DataFrame, job: str, batch_fn=None, output_mode: str = "append") -> DataFrame:
    """Run a stream over everything available now; return the sink table.

    ``batch_fn(df)`` (optional) turns each micro-batch into output rows with
    batch operators; otherwise the stream's own rows are appended.
    """
    spark = stream.sparkSession
    out = _run_dir(spark, job)
    data, ck = os.path.join(out, "data"), os.path.join(out, "checkpoint")
    if batch_fn is None:
        q = (stream.writeStream.format("parquet").option("path", data)
             .option("checkpointLocation", ck).outputMode(output_mode)
             .trigger(availableNow=True).start())
    else:
        def write(df, epoch):               # a retried batch overwrites its own folder
            batch_fn(df).write.mode("overwrite").parquet(f"{data}/batch_id={epoch}")
        q = (stream.writeStream.foreachBatch(write).option("checkpointLocation", ck)
             .trigger(availableNow=True).start())
    q.awaitTermination()
    out = spark.read.parquet(data)
    return out if batch_fn is None else out.drop("batch_id")


def score_stream(spark: SparkSession, sf_dir: str, lexicon: DataFrame) -> DataFrame:
    """STR1: documents arriving as files -> valid sentences -> scores."""
    docs = table_stream(spark, sf_dir, "documents")

    def per_batch(df: DataFrame) -> DataFrame:
        valid, _ = validate(documents_to_sentences(df, with_theme=False),
                            limits=Limits.corpus(), strict=False)
        return S.score_sentences(valid, lexicon)

    return run_available(docs, "scores", per_batch)


#: The time of the row that tells a stream that its input has ended.
END_OF_INPUT = "9999-01-01 00:00:00"


def run_to_end(spark: SparkSession, source, job: str, build) -> DataFrame:
    """Run ``build(stream)`` over all that is available, then bring out what still waits.

    ``source()`` gives the input stream with its event time in ``ts``.  The stream is united with a
    second one that has no rows at first.  When the input is used up, that one gets a row
    with the time ``END_OF_INPUT`` and the query goes on from its checkpoint: the watermark
    passes every open window and timer, so the result has no missing tail.
    """
    out = _run_dir(spark, job)
    ends = os.path.join(out, "ends")
    schema = source().schema
    spark.createDataFrame([], schema).write.parquet(ends)

    def once():
        both = source().unionByName(spark.readStream.schema(schema).parquet(ends))
        q = (build(both).writeStream.format("parquet").option("path", os.path.join(out, "data"))
             .option("checkpointLocation", os.path.join(out, "checkpoint")).outputMode("append")
             .trigger(availableNow=True).start())
        q.awaitTermination()
    once()
    # no nulls in that row: a filter that a join brings along would drop it before the watermark sees it
    last = [F.lit(END_OF_INPUT if f.name == "ts" else "-1").cast(f.dataType).alias(f.name) for f in schema]
    spark.range(1).select(*last).write.mode("append").parquet(ends)
    once()
    return spark.read.parquet(os.path.join(out, "data"))


def event_stream(spark: SparkSession, sf_dir: str, max_files: int = 1) -> DataFrame:
    ev = table_stream(spark, sf_dir, "events", max_files)
    return ev.withColumn("ts", F.col("ts").cast("timestamp")).where(F.col("ts").isNotNull())


def windowed_events(spark: SparkSession, sf_dir: str, window: str = "1 hour",
                    delay: str = "10 minutes") -> DataFrame:
    """STR2: per window and event type: count, mean and approximate median.

    Append mode: a window is emitted once the watermark passes its end, so state stays
    bounded by the lateness allowance; the end of the input closes the last windows.
    """
    def build(ev):
        return (ev.withWatermark("ts", delay)
                .groupBy(F.window("ts", window).alias("w"), "event_type")
                .agg(F.count(F.lit(1)).alias("n"), F.avg("value").alias("mean_value"),
                     F.percentile_approx("value", 0.5).alias("median_value"))
                .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                        "event_type", "n", "mean_value", "median_value"))
    return run_to_end(spark, lambda: event_stream(spark, sf_dir), "windows", build)


def theme_windows(spark: SparkSession, sf_dir: str, themes: DataFrame, window: str = "60 minutes",
                  slide: str = "30 minutes", delay: str = "10 minutes") -> DataFrame:
    """STR2: sentiment per theme in sliding windows, by a join of the stream with scored texts.

    ``themes`` is (doc_id, theme, sentences, total, positive): what each text brings in, ``total`` in
    whole ten-thousandths of a compound score, so sums are exact.  An event brings in the
    text of its user.
    """
    def build(ev):
        hit = ev.withWatermark("ts", delay).join(themes, F.col("user_id") == F.col("doc_id"))
        return (hit.groupBy(F.window("ts", window, slide).alias("w"), "theme")
                .agg(F.count(F.lit(1)).alias("events"), F.sum("sentences").alias("sentences"), F.sum("total").alias("total"),
                     F.sum("positive").alias("positive"))
                .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "theme", "events", "sentences",
                        F.round(F.col("total") / F.col("sentences") / 10000, 6).alias("mean_compound"), "positive"))
    return run_to_end(spark, lambda: event_stream(spark, sf_dir), "theme-windows", build)


class KeepApart(StatefulProcessor):
    """Keeps a row unless a kept row of its key lies within ``delay_us`` before it, in event time.

    Rows wait in the state until the watermark has passed them, so they are taken in the order
    of their times whatever the order in which they came; a timer wakes the key then.
    """

    def __init__(self, names: list[str], row_type: str, delay_us: int):
        self.names, self.row_type, self.delay_us = names, row_type, delay_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", self.row_type)
        self.last = handle.getValueState("last", "at long")

    def handleInputRows(self, key, rows, timerValues):
        latest = 0
        for row in rows:
            values = tuple(row[c] for c in self.names)
            self.waiting.appendValue(values)
            latest = max(latest, row["at"])
        self.handle.registerTimer(-(-latest // 1000))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        now = timerValues.getCurrentWatermarkInMs() * 1000
        rows = [Row(*r) for r in self.waiting.get()]
        at = self.names.index("at")
        due = sorted((r for r in rows if r[at] <= now), key=lambda r: (r[at], r[0]))
        rest = [tuple(r) for r in rows if r[at] > now]
        if rest:
            self.waiting.put(rest)
        else:
            self.waiting.clear()
        last = self.last.get()[0] if self.last.exists() else None
        out = []
        for r in due:
            if last is None or r[at] - last > self.delay_us:
                last = r[at]
                out.append(Row(**dict(zip(self.names, r, strict=True))))
        if out:
            self.last.update((last,))
        return iter(out)

    def close(self) -> None:
        pass


def dedupe_events(spark: SparkSession, sf_dir: str, delay_minutes: int = 30, lateness: str = "10 minutes",
                  keys=("user_id", "event_type"), max_files: int = 1) -> DataFrame:
    """STR3: an event is dropped if a kept event of its ``keys`` lies within the delay before it.

    Event time decides, not arrival: the same rows come out however the input is cut into files, as
    long as no row is later than ``lateness``.  Equal times go by ``event_id``.
    """
    names, types = ["event_id", *keys, "at"], "event_id long, user_id long, event_type string, at long"
    chosen = [c for c in names if c != "at"]

    def build(ev):
        rows = ev.select(*chosen, "ts", F.unix_micros("ts").alias("at")).withWatermark("ts", lateness)
        return rows.groupBy(*keys).transformWithState(
            KeepApart(names, types, delay_minutes * 60_000_000), types, "append", "EventTime")
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass",
                   "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        out = run_to_end(spark, lambda: event_stream(spark, sf_dir, max_files), "dedupe", build)
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)
    return out.select(*chosen, F.timestamp_micros("at").alias("ts"))


def assign_stream(spark: SparkSession, sf_dir: str, centroids: DataFrame) -> DataFrame:
    """STR4: each arriving vector takes the nearest existing centroid.

    ``centroids`` is (request_id, dataset, cluster_id, centroid) for the
    themes already found; a vector is compared with the centroids of its own
    dataset only.  The centroid table is broadcast when its size has been
    checked, else joined by shuffle.
    """
    from ..functions.vectors import sq_distance
    from ..sources.tables import embeddings_as_vectors
    key = ["request_id", "dataset"]
    cen = F.broadcast(centroids) if centroids.count() <= CENTROID_BROADCAST_MAX_ROWS else centroids
    vec = table_stream(spark, sf_dir, "embeddings")

    def per_batch(df: DataFrame) -> DataFrame:
        v = embeddings_as_vectors(df).select(*key, F.col("pos").alias("vec_id"), "embedding")
        d = v.join(cen, key).withColumn("_d", sq_distance("embedding", "centroid"))
        return d.groupBy(*key, "vec_id").agg(
            F.min_by("cluster_id", F.struct("_d", "cluster_id")).alias("cluster_id"))

    return run_available(vec, "assign", per_batch)

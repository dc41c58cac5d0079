"""Operational metrics over a request/event log (OPS1-OPS10).

The log table is ``events(event_id, ts, user_id, event_type, value, props)``:
``event_type = 'error'`` marks a failure, ``value`` is the duration and
``props`` a small JSON document.  No step sorts all rows of one key:

* quantiles are exact, by selection over range buckets (:mod:`quantiles`);
* cold starts use per-(user, minute) buckets: only the first event of a
  bucket can open a new session, so the window runs over buckets, whose
  count is bounded by time, not by rows;
* error context runs per (user, hour), with what lies beyond the hour's edges known.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .quantiles import quantiles


def parse(events: DataFrame) -> DataFrame:
    """OPS1: typed log rows: error flag, duration, JSON attribute ``k``."""
    return events.select(
        "event_id", "ts", "user_id", "event_type",
        (F.col("event_type") == "error").alias("is_error"),
        F.col("value").alias("duration"),
        F.get_json_object("props", "$.k").cast("long").alias("k"))


def select_events(log: DataFrame, user_id=None, type_pattern: str | None = None,
                  start=None, end=None) -> DataFrame:
    """OPS2: filter by user, event-type pattern (SQL LIKE) and time range."""
    cond = F.lit(True)
    if user_id is not None:
        cond = cond & (F.col("user_id") == user_id)
    if type_pattern is not None:
        cond = cond & F.col("event_type").like(type_pattern)
    if start is not None:
        cond = cond & (F.col("ts") >= F.lit(start).cast("timestamp"))
    if end is not None:
        cond = cond & (F.col("ts") < F.lit(end).cast("timestamp"))
    return log.where(cond)


def counts(log: DataFrame, group=("event_type",)) -> DataFrame:
    """OPS3: request counts."""
    return log.groupBy(*group).agg(F.count(F.lit(1)).alias("requests"))


def error_rate(log: DataFrame, group=()) -> DataFrame:
    """OPS4: error rate in percent (per day by default)."""
    g = list(group) or [F.to_date("ts").alias("day")]
    return log.groupBy(*g).agg(
        F.count(F.lit(1)).alias("requests"),
        F.sum(F.col("is_error").cast("long")).alias("errors"),
        F.round(F.avg(F.col("is_error").cast("double")) * 100, 4).alias("error_rate_pct"))


def slowest(log: DataFrame, n: int = 20) -> DataFrame:
    """OPS5 (sorted durations): the ``n`` slowest events, a top-n report."""
    order = [F.col("duration").desc(), F.col("event_id")]
    top = log.orderBy(*order).limit(n)          # n rows from here on
    return top.withColumn("rank", F.row_number().over(Window.orderBy(*order))).select(
        "rank", "event_id", "ts", "user_id", "event_type", "duration")


def duration_stats(log: DataFrame, group=("event_type",)) -> DataFrame:
    """OPS5 (average) + OPS8: mean, max and exact p50/p95/p99 per group."""
    group = list(group)
    base = log.groupBy(*group).agg(F.count(F.lit(1)).alias("n"),
                                   F.round(F.avg("duration"), 6).alias("avg_duration"),
                                   F.max("duration").alias("max_duration"))
    q = exact_quantiles(log, group, "duration", (0.5, 0.95, 0.99))
    return base.join(q, group)


def exact_quantiles(df: DataFrame, group: list[str], value: str, probs) -> DataFrame:
    """Continuous quantiles (linear interpolation), as ``p50``, ``p95``, ... rounded to 6 places."""
    out = quantiles(df, group, value, probs)
    return out.select(*group, *[F.round(f"q{i}", 6).alias(f"p{int(round(p * 100))}") for i, p in enumerate(probs)])


def alarms(log: DataFrame, group=("event_type",), error_pct: float = 5.0,
           p95_limit: float = 10.0) -> DataFrame:
    """OPS8 flags per group: error rate over 5 %, p95 over the limit."""
    group = list(group)
    both = error_rate(log, group).join(exact_quantiles(log, group, "duration", (0.95,)), group)
    return both.select(*group, "requests", "error_rate_pct", "p95",
                       (F.col("error_rate_pct") > error_pct).alias("error_alarm"),
                       (F.col("p95") > p95_limit).alias("latency_alarm"))


def cold_warm(log: DataFrame, gap_minutes: int = 15) -> DataFrame:
    """OPS6: events that open a session (no event of the same user in the
    previous ``gap_minutes``) are cold, the rest warm.

    Within a one-minute bucket every later event is warm, so only bucket
    starts are tested, against the previous bucket's last event.
    """
    b = log.groupBy("user_id", F.date_trunc("minute", "ts").alias("_b")).agg(
        F.min("ts").alias("_first"), F.max("ts").alias("_last"), F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy("user_id").orderBy("_b")
    prev = F.lag("_last").over(w)
    gap = F.timestamp_diff("MICROSECOND", prev, F.col("_first"))
    cold = prev.isNull() | (gap > gap_minutes * 60 * 1_000_000)
    b = b.withColumn("_cold", cold.cast("long"))
    return b.agg(F.sum("_cold").alias("cold"), (F.sum("_n") - F.sum("_cold")).alias("warm"))


def error_context(log: DataFrame, lines: int = 5, block: str = "hour") -> DataFrame:
    """OPS7: events within ``lines`` events of an error in the stream of their user.

    A user's stream is cut into time blocks, and rows are ordered within a block only.  Each block
    knows its first and last ``lines`` error flags; from those of the ``lines`` blocks on either side
    follows how far the nearest error before and after the block is, so no context is cut and a
    busy user is as many tasks as it has blocks.
    """
    key, order = ["user_id", "_b"], ["ts", "event_id"]
    rows = log.withColumn("_b", F.date_trunc(block, "ts")).withColumn("_e", F.col("is_error").cast("int"))
    inside = Window.partitionBy(*key).orderBy(*order)
    rows = rows.withColumn("_i", F.row_number().over(inside)).withColumn(
        "_back", F.row_number().over(Window.partitionBy(*key).orderBy(*[F.desc(c) for c in order]))).withColumn(
        "_near", F.max("_e").over(inside.rowsBetween(-lines, lines)))
    edge = lambda place: F.sort_array(F.collect_list(
        F.when(F.col(place) <= lines, F.struct(F.col(place).alias("at"), F.col("_e").alias("e")))))
    blocks = rows.groupBy(*key).agg(edge("_i").alias("_head"), edge("_back").alias("_tail"))
    flow = Window.partitionBy("user_id").orderBy("_b")                # one row for each block
    flags = lambda c, step: F.flatten(F.array(*[
        F.coalesce(step(c, k).over(flow), F.array().cast("array<struct<at:int,e:int>>")) for k in range(1, lines + 1)]))
    first = lambda c, step: F.array_position(F.transform(F.slice(flags(c, step), 1, lines), lambda x: x["e"]), 1)
    blocks = blocks.select(*key, first("_tail", F.lag).alias("_before"), first("_head", F.lead).alias("_after"))
    both = rows.alias("r").join(blocks.alias("k"), F.col("r.user_id").eqNullSafe(F.col("k.user_id")) & F.col("r._b").eqNullSafe(F.col("k._b")))
    # an error that is the n-th row beyond the block's edge is i - 1 + n rows away from the i-th row inside
    close = lambda place, far: (F.col(far) > 0) & (F.col(place) - 1 + F.col(far) <= lines)
    return both.where((F.col("_near") == 1) | close("_i", "_before") | close("_back", "_after")).select(
        *[F.col(f"r.{c}") for c in log.columns])


def five_minute_bins(log: DataFrame, minutes: int = 5) -> DataFrame:
    """OPS10: average and maximum duration, average ``k`` per time bin."""
    return log.groupBy(F.window("ts", f"{minutes} minutes").alias("w")).agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.avg("duration"), 6).alias("avg_duration"),
        F.max("duration").alias("max_duration"),
        F.round(F.avg("k"), 6).alias("avg_k")).select(
        F.col("w.start").alias("bin_start"), "n", "avg_duration", "max_duration", "avg_k")


def analysis_metrics(assignments: DataFrame, cluster_col: str = "cluster_id") -> DataFrame:
    """OPS9: sentences processed, clusters, average size, unclustered ratio."""
    noise = F.col(cluster_col).cast("string") == "-1"
    per = assignments.groupBy("request_id").agg(
        F.count(F.lit(1)).alias("sentences"),
        F.count_distinct(F.when(~noise, F.col(cluster_col))).alias("clusters"),
        F.sum(noise.cast("long")).alias("_noise"))
    return per.select("request_id", "sentences", "clusters",
                      F.round(F.when(F.col("clusters") > 0,
                                     (F.col("sentences") - F.col("_noise")) / F.col("clusters")), 6)
                      .alias("avg_cluster_size"),
                      F.round(F.col("_noise") / F.col("sentences"), 6).alias("unclustered_ratio"))

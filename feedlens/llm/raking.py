"""Mixing sources to target weights by iterative proportional fitting.

The tokens of all documents form a table of cells (source, language, topic).
Raking multiplies the cells in turn by target / current total of each category of
one dimension, until all three marginals agree with their targets.  A cell's factor
(fitted / original weight), divided by the largest factor, is the probability with
which each of its documents is kept, so the expected tokens kept meet every target
marginal at once.  The draw is a hash of the document's id: the same document is
always drawn alike, on every cluster and in every retry.

Targets: each dimension's shares are the observed shares raised to a power and
normalised (1 keeps the mix, 0 makes all categories equal), or a table of shares.

Scale: one aggregation reads the documents; everything between works on cells.  The
marginals are pre-aggregated sums joined back, so a source, language or topic with a
third of all tokens is one number.  Each round writes the cells to the shared folder
and the rounds end when no marginal is off by more than ``tolerance``.

Defined results: a null source or language is a category of its own; a null text has
no tokens; a category without tokens keeps factor 1; rows with equal ids are drawn
alike; an empty table gives no rows; other columns stay.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, saved

#: The share of each category is the observed share to this power.
POWERS = {"source": 0.7, "lang": 0.85, "topic": 1.0}
TOLERANCE, MAX_ROUNDS, SEED = 1e-9, 200, "mix-1"
UNSETTLED = 1e-6                # a marginal that far off after all rounds is an error


def token_count(text: Column) -> Column:
    """Words of the text; null has none."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def topic_of(text: Column) -> Column:
    """A rough topic by what a text holds: the first rule that fits."""
    t = F.coalesce(text, F.lit(""))
    low = F.lower(t)
    return (F.when(low.contains("license") | low.contains("copyright"), "legal")
            .when(t.contains("@") | low.contains("http"), "contact")
            .when(t.contains(" | "), "table")
            .when(F.length(t) < 1000, "note").otherwise("prose"))


def _category(column: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), column.cast("string")), F.lit("null"))


def _targets(cells: DataFrame, dim: str, target) -> DataFrame:
    """(dim, target): the share of all tokens each category shall have."""
    if isinstance(target, DataFrame):
        return target.select(_category(F.col("category")).alias(dim), F.col("share").alias("target"))
    sums = cells.groupBy(dim).agg(F.sum("weight").alias("w")).where("w > 0")
    powered = sums.select(dim, F.pow("w", F.lit(float(target))).alias("p"))
    return powered.crossJoin(F.broadcast(powered.agg(F.sum("p").alias("all")))).select(  # one row
        dim, (F.col("p") / F.col("all")).alias("target"))


def rake(cells: DataFrame, targets: Mapping[str, object], tolerance: float = TOLERANCE,
         max_rounds: int = MAX_ROUNDS) -> DataFrame:
    """``cells`` (the dimensions and ``weight``) plus ``fitted``, a share of 1.

    Targets that cannot all hold are an error."""
    goal = {d: saved(_targets(cells, d, t), f"target-{d}") for d, t in targets.items()}
    total = cells.agg(F.sum("weight").alias("all"))
    now = saved(cells.crossJoin(F.broadcast(total)).select(      # one row
        *targets, "weight", (F.col("weight") / F.col("all")).alias("fitted")), "cells")
    for _ in range(max_rounds):
        step, off = now, []
        for d in targets:
            factor = (step.groupBy(d).agg(F.sum("fitted").alias("sum")).join(goal[d], d)
                      .select(d, F.when(F.col("sum") > 0, F.col("target") / F.col("sum")).alias("factor")))
            step = step.join(factor, d, "left").withColumn("fitted", F.col("fitted") * F.coalesce("factor", F.lit(1.0)))
            step = step.withColumn(f"off_{d}", F.abs(F.coalesce("factor", F.lit(1.0)) - 1)).drop("factor")
            off.append(f"off_{d}")
        step = saved(step, "cells")
        worst = step.agg(F.max(F.greatest(*off))).first()[0] or 0.0
        now = step.drop(*off)
        if worst <= tolerance:
            break
    else:
        if worst > UNSETTLED:
            raise ValueError(f"the targets do not settle: a marginal is still off by {worst:.2g} of itself after {max_rounds} rounds")
    return now


def mixing_probabilities(docs: DataFrame, source_col: str = "source", lang_col: str = "lang",
                         text_col: str = "text", topic: Column | None = None,
                         targets: Mapping[str, object] = POWERS) -> DataFrame:
    """``docs`` plus ``mix_topic``, ``mix_tokens`` and ``mix_probability``."""
    labelled = (docs.withColumn("mix_topic", topic_of(F.col(text_col)) if topic is None else topic)
                .withColumn("mix_tokens", token_count(F.col(text_col))))
    dims = {"source": _category(F.col(source_col)), "lang": _category(F.col(lang_col)),
            "topic": _category(F.col("mix_topic"))}
    keys = [c.alias(d) for d, c in dims.items()]
    cells = saved(labelled.select(*keys, "mix_tokens").groupBy(*dims).agg(
        F.sum("mix_tokens").cast("double").alias("weight")), "cells")
    fitted = rake(cells, targets).withColumn("factor", F.when(F.col("weight") > 0, F.col("fitted") / F.col("weight")))
    top = fitted.agg(F.max("factor").alias("top"))                # one row
    rates = saved(fitted.crossJoin(F.broadcast(top)).select(
        *[F.col(d).alias(f"__{d}") for d in dims],
        F.coalesce(F.col("factor") / F.col("top"), F.lit(1.0)).alias("mix_probability")), "rates")
    on = [dims[d] == F.col(f"__{d}") for d in dims]
    return labelled.join(rates, on, "left").drop(*[f"__{d}" for d in dims])


def draw(id_col: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) that depends on the id alone."""
    digits = F.substring(F.md5(F.concat(F.lit(seed + ":"), F.coalesce(id_col.cast("string"), F.lit("null")))), 1, 12)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(16**12))


def mix(docs: DataFrame, id_col: str = "doc_id", seed: str = SEED, **options) -> DataFrame:
    """``mixing_probabilities`` plus ``mix_kept``: whether the document is drawn."""
    out = mixing_probabilities(docs, **options)
    return out.withColumn("mix_kept", draw(F.col(id_col), seed) < F.col("mix_probability"))

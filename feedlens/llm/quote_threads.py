"""Conversations from messages that quote each other, without their quotes.

A message's lines start with none, one or more quote marks; each mark adds a level, as
``>`` or ``> ``.  A quoted passage is a run of lines of one level of at least one.  The
steps:

1. parse: marks are counted, the message's own lines (level 0) are kept, attribution lines
   before a quote (those that end in ``wrote:``) are dropped from them;
2. hash: each quoted passage and each message's own text, and the paragraphs of it, are
   normalised (lower case, white space runs as one blank) and hashed;
3. link: a message replies to the message whose own passage its outermost quote repeats,
   within the same conversation; of several the latest earlier one counts.  Passages are
   joined by hash; for each hash only the candidates of the same conversation meet, and
   those are reduced to one by an aggregate;
4. order: the parents are followed to their root in rounds that double the distance.  A
   conversation's messages are put in reply order: its threads by their first message, and
   in each thread every message after the one it replies to, by position.

A conversation, or a passage within it, may hold very many messages: places of a passage are
searched by blocks of positions, and ranks are counted from a range partitioning, so neither
is one task's work.

Defined results: a null text counts as empty; a message without quotes or whose quotes
match nothing starts a thread of its own; a quote of itself or of a later message is no
link; of repeated rows with the same conversation and position each is a message of its
own thread position, linked alike; a null conversation or position is a value like any
other but links with nothing; an empty table gives no rows; other columns stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import partitions, saved

BLOCK = 1024                # positions searched at once
_MARKS = r"^((?:> ?)*)"
_ATTRIBUTION = r"wrote:\s*$"


def _normal(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"\s+", " "))


def _lines(text: Column) -> Column:
    """(level, line) of each line without its marks."""
    return F.transform(F.split(F.coalesce(text, F.lit("")), "\n", -1), lambda x: F.struct(
        F.regexp_count(F.regexp_extract(x, _MARKS, 1), F.lit(">")).alias("level"),
        F.regexp_replace(x, _MARKS, "").alias("line")))


def parse(messages: DataFrame, text_col: str = "text") -> DataFrame:
    """``messages`` plus ``own`` (the text without quotes), and ``quotes``: (level, hash, text)
    of each quoted passage, in order."""
    d = messages.withColumn("__lines", _lines(F.col(text_col)))
    level = F.transform("__lines", lambda x: x["level"])
    # a passage starts where the level changes
    cuts = F.filter(F.transform("__levels", lambda v, i: F.when((i == 0) | (v != F.get("__levels", i - 1)), i)), lambda i: i.isNotNull())
    ends = F.concat(F.slice("__cuts", 2, F.greatest(F.size("__cuts") - 1, F.lit(0))), F.array(F.size("__lines")))
    d = d.withColumn("__levels", level).withColumn("__cuts", cuts).withColumn("__ends", ends)
    passages = F.transform(F.arrays_zip("__cuts", "__ends"), lambda z: F.struct(
        F.element_at("__levels", z["__cuts"] + 1).alias("level"),
        F.array_join(F.transform(F.slice("__lines", z["__cuts"] + 1, z["__ends"] - z["__cuts"]), lambda x: x["line"]), "\n").alias("text")))
    quotes = F.filter(F.transform(F.filter("__passages", lambda p: p["level"] > 0), lambda p: F.struct(
        p["level"].alias("level"), F.xxhash64(_normal(p["text"])).alias("hash"), p["text"].alias("text"))),
        lambda q: F.trim(q["text"]) != "")
    own = F.array_join(F.transform(F.filter("__lines", lambda x: (x["level"] == 0) & ~x["line"].rlike(_ATTRIBUTION)),
                                   lambda x: x["line"]), "\n")
    return (d.withColumn("__passages", passages).withColumn("quotes", quotes)
            .withColumn("own", F.regexp_replace(own, r"^\n+|\n+$", ""))
            .drop("__lines", "__levels", "__cuts", "__ends", "__passages"))


def _link(parsed: DataFrame, conv: str, pos: str) -> DataFrame:
    """(conv, pos, parent): the latest earlier message that a level-1 quote repeats."""
    asks = parsed.select(F.col(conv).alias("c"), F.col(pos).alias("p"), F.explode(F.filter("quotes", lambda q: q["level"] == 1)).alias("q")).select(
        "c", "p", F.col("q.hash").alias("hash")).distinct()
    parts = F.filter(F.array_distinct(F.concat(F.array(F.col("own")), F.split("own", r"\n\s*\n"), F.split("own", "\n"))), lambda x: F.trim(x) != "")
    has = parsed.select(F.col(conv).alias("c"), F.col(pos).alias("parent"), F.explode(F.transform(parts, lambda x: F.xxhash64(_normal(x)))).alias("hash")).distinct()
    # the last place of the passage before each quote: within blocks of positions, then over blocks
    places = asks.select("c", "hash", F.col("p").alias("at"), F.lit(True).alias("ask")).unionByName(
        has.select("c", "hash", F.col("parent").alias("at"), F.lit(False).alias("ask")))
    places = places.where("c is not null and at is not null").withColumn("block", F.floor(F.col("at") / BLOCK))
    held = F.max(F.when(~F.col("ask"), F.col("at")))
    earlier = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    blocks = places.groupBy("c", "hash", "block").agg(held.alias("held")).select(
        "c", "hash", "block", F.max("held").over(earlier(Window.partitionBy("c", "hash").orderBy("block"))).alias("older"))
    inside = held.over(earlier(Window.partitionBy("c", "hash", "block").orderBy("at", F.col("ask").desc())))
    found = (places.withColumn("inside", inside).where("ask").join(blocks, ["c", "hash", "block"])
             .withColumn("parent", F.coalesce("inside", "older")).where("parent is not null"))
    return found.groupBy("c", F.col("at").alias("p")).agg(F.max("parent").alias("parent"))


def _order(up: DataFrame, n: int) -> DataFrame:
    """``up`` plus ``reply_order``: the place (from 1) by (root, position) within its conversation."""
    cut = saved(up.repartitionByRange(n, "c", "root", "p").withColumn("part", F.spark_partition_id()), "ranges")
    counts = cut.groupBy("c", "part").agg(F.count(F.lit(1)).alias("k"))
    before = Window.partitionBy("c").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)   # n rows at most
    starts = counts.select(F.col("c").alias("c2"), F.col("part").alias("part2"), F.coalesce(F.sum("k").over(before), F.lit(0)).alias("before"))
    within = F.row_number().over(Window.partitionBy("c", "part").orderBy("root", "p"))
    return (cut.withColumn("k", within).join(starts, F.col("c").eqNullSafe(F.col("c2")) & (F.col("part") == F.col("part2")))
            .withColumn("reply_order", F.col("before") + F.col("k")).drop("c2", "part2", "part", "before", "k"))


def thread(messages: DataFrame, conv_col: str = "conv_id", pos_col: str = "turn", text_col: str = "text",
           max_rounds: int = 64) -> DataFrame:
    """``messages`` plus ``own`` (text without quotes), ``quotes``, ``n_quotes``, ``reply_to``, ``root``,
    ``depth`` and ``reply_order``."""
    parsed = saved(parse(messages, text_col), "parsed")
    nodes = parsed.select(F.col(conv_col).alias("c"), F.col(pos_col).alias("p")).distinct()
    up = saved(nodes.join(_link(parsed, conv_col, pos_col), ["c", "p"], "left").select(
        "c", "p", "parent", F.coalesce("parent", "p").alias("root"), F.col("parent").isNotNull().cast("int").alias("depth"),
        F.col("parent").isNotNull().alias("open")), "up")
    for _ in range(max_rounds):                    # each round doubles the distance; settled rows stay out
        above = up.select(F.col("c").alias("c2"), F.col("p").alias("p2"), F.col("root").alias("r2"), F.col("depth").alias("d2"), F.col("open").alias("o2"))
        step = up.where("open").join(above, (F.col("c") == F.col("c2")) & (F.col("root") == F.col("p2"))).select(
            "c", "p", "parent", F.col("r2").alias("root"), (F.col("depth") + F.col("d2")).alias("depth"), F.col("o2").alias("open"))
        up = saved(up.where("not open").unionByName(step), "up")
        if up.where("open").isEmpty():
            break
    up = up.drop("open")
    placed = _order(up, partitions(messages.sparkSession)).select(
        F.col("c").alias("__c"), F.col("p").alias("__p"), F.col("parent").alias("reply_to"), "root", "depth", "reply_order")
    on = F.col(conv_col).eqNullSafe(F.col("__c")) & F.col(pos_col).eqNullSafe(F.col("__p"))
    return parsed.join(placed, on).withColumn("n_quotes", F.size("quotes")).drop("__c", "__p")


def as_conversations(threaded: DataFrame, conv_col: str = "conv_id", role_col: str = "role") -> DataFrame:
    """One row for each conversation: its messages (role, content) in reply order, without quotes.
    A conversation has to fit in a row."""
    turns = F.sort_array(F.collect_list(F.struct("reply_order", F.col(role_col).alias("role"), F.col("own").alias("content"))))
    return threaded.groupBy(conv_col).agg(F.transform(turns, lambda t: F.struct(t["role"].alias("role"), t["content"].alias("content"))).alias("messages"))

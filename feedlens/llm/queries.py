"""The registered queries of this package and their DuckDB twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from . import cotraining, token_files
from .common import table
from .centroids import cluster
from .exact_dedup import exact_dedup
from .importance import resample
from .kneser_ney import fit, held_out, score
from .line_dedup import line_dedup
from .multi_index import near_vectors
from .packing import pack_documents
from .quote_threads import thread
from .raking import POWERS, SEED, mix
from .token_groups import jaccard_components
from .warc_packages import round_trip

#: The tokenizer's files: its vocabulary, and the same vocabulary for the faster library.
VOCABULARY, RANKS = (public_tokenizers.path(f"byte_bpe_50k.{kind}") for kind in ("json", "tiktoken"))


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the group of its equal texts; the largest doc_id stays."""
    out = exact_dedup(spark, f"{sf_dir}/documents.parquet")
    return out.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept",
                      F.lower(F.hex("digest")).alias("text_sha256"))


OP1_SQL = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
"""


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its text after repeated runs of lines were removed, to the last line of each run."""
    out = line_dedup(table(spark, sf_dir, "documents"), extend=True)
    return out.select("doc_id", "text", F.col("lines_removed").cast("long").alias("lines_removed"))


OP2_SQL = """
WITH raw AS (
  SELECT d.doc_id, u.line, u.i, CASE WHEN trim(u.line, ' ') <> '' THEN trim(u.line, ' ') END AS ln
  FROM documents d, unnest(string_split(d.text, chr(10))) WITH ORDINALITY AS u(line, i)),
num AS (
  SELECT *, count(ln) OVER (PARTITION BY doc_id ORDER BY i) - 1 AS pos,
         count(ln) OVER (PARTITION BY doc_id) AS n FROM raw),
l AS (
  SELECT doc_id, pos, n, ln, length(ln) - length(replace(ln, ' ', '')) + 1 AS w FROM num WHERE ln IS NOT NULL),
a AS (
  SELECT *, lead(w) OVER o AS w1, lead(ln) OVER o AS l1, lead(ln, 2) OVER o AS l2
  FROM l WINDOW o AS (PARTITION BY doc_id ORDER BY pos)),
z AS (SELECT *, CASE WHEN w >= 50 THEN 1 WHEN w + w1 >= 50 THEN 2 ELSE 3 END AS size FROM a),
win AS (
  SELECT doc_id, pos, size, CASE size WHEN 1 THEN ln WHEN 2 THEN ln || chr(10) || l1
         ELSE ln || chr(10) || l1 || chr(10) || l2 END AS content
  FROM z WHERE pos + size <= n),
later AS (
  SELECT * FROM win QUALIFY row_number() OVER (PARTITION BY content ORDER BY doc_id, pos) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(pos, pos + size)) AS pos FROM later),
kept AS (
  SELECT num.doc_id, string_agg(num.line, chr(10) ORDER BY num.i) FILTER (WHERE gone.pos IS NULL) AS text,
         count(gone.pos) AS lines_removed
  FROM num LEFT JOIN gone ON num.doc_id = gone.doc_id AND num.pos = gone.pos AND num.ln IS NOT NULL
  GROUP BY num.doc_id)
SELECT doc_id, coalesce(text, '') AS text, lines_removed FROM kept
"""


def op3_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector with its links of cosine 0.93 or more within its label, and its component."""
    out = near_vectors(table(spark, sf_dir, "embeddings"), 0.93)
    return out.select(F.col("id").alias("vec_id"), "n_links", F.col("component").alias("component_id"),
                      F.col("id").eqNullSafe(F.col("component")).alias("kept"))


OP3_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL),
ok AS (SELECT *, sqrt(list_inner_product(e, e)) AS norm FROM v
  WHERE len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND list_inner_product(e, e) > 0),
link AS (SELECT x.vec_id AS a, y.vec_id AS b FROM ok x JOIN ok y
  ON x.label = y.label AND x.vec_id <> y.vec_id AND len(x.e) = len(y.e)
  WHERE list_inner_product(x.e, y.e) / (x.norm * y.norm) >= 0.93),
reach AS (SELECT a AS vec_id, a AS least FROM link UNION
  SELECT link.b, least FROM reach JOIN link ON link.a = reach.vec_id),
low AS (SELECT vec_id, min(least) AS least FROM reach GROUP BY vec_id),
n AS (SELECT a AS vec_id, count(*) AS n FROM link GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(least, vec_id) AS component_id, coalesce(least, vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN n USING (vec_id) LEFT JOIN low USING (vec_id)
"""


def quoting_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The turns of ``conversations`` as messages that quote: each puts the turn before it
    (every third one the turn before that) above its own text, with that turn's quote."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    back = F.when(F.col("turn") % 3 == 2, 2).otherwise(1)
    quoted = lambda marks, c: F.when(F.col(c) != "", F.concat(
        F.regexp_replace(F.col(c), "(?m)^", marks), F.lit("\n"))).otherwise("")
    one = turns.select("conv_id", F.col("turn").alias("t1"), F.col("text").alias("text1"), F.col("role").alias("role1"))
    two = turns.select("conv_id", F.col("turn").alias("t2"), F.col("text").alias("text2"))
    both = (turns.withColumn("t1", F.col("turn") - back).join(one, ["conv_id", "t1"], "left")
            .withColumn("t2", F.when(F.col("text1").isNotNull(), F.col("t1") - F.when(F.col("t1") % 3 == 2, 2).otherwise(1)))
            .join(two, ["conv_id", "t2"], "left"))
    head = F.concat(F.col("role1"), F.lit(" wrote:\n"), F.coalesce(quoted("> > ", "text2"), F.lit("")), quoted("> ", "text1"), F.lit("\n"))
    return both.select("conv_id", "turn", "role", F.concat(F.coalesce(head, F.lit("")), F.coalesce("text", F.lit(""))).alias("text"))


def op4_quote_threads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message without its quotes, with what it replies to and its place in the conversation."""
    out = thread(quoting_messages(spark, sf_dir))
    return out.select("conv_id", "turn", "role", "own", "reply_to", "root", F.col("depth").cast("long").alias("depth"),
                      F.col("reply_order").cast("long").alias("reply_order"), F.col("n_quotes").cast("long").alias("n_quotes"))


OP4_SQL = r"""
WITH RECURSIVE m AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text, turn - CASE WHEN turn % 3 = 2 THEN 2 ELSE 1 END AS t1
  FROM conversations),
norm AS (SELECT *, trim(regexp_replace(lower(text), '\s+', ' ', 'g')) AS whole FROM m),
part AS (
  SELECT conv_id, turn, whole AS part FROM norm UNION
  SELECT conv_id, turn, trim(regexp_replace(lower(u.x), '\s+', ' ', 'g'))
  FROM m, unnest(string_split_regex(text, '\n\s*\n') || string_split(text, chr(10))) AS u(x)),
asks AS (
  SELECT a.conv_id, a.turn, q.whole AS part, q.turn AS t1, q.text AS text1 FROM norm a
  JOIN norm q ON q.conv_id = a.conv_id AND q.turn = a.t1 AND q.whole <> ''),
link AS (
  SELECT asks.conv_id, asks.turn, max(part.turn) AS reply_to FROM asks
  JOIN part ON part.conv_id = asks.conv_id AND part.part = asks.part AND part.turn < asks.turn GROUP BY ALL),
up AS (
  SELECT m.conv_id, m.turn, m.turn AS root, 0 AS depth FROM m ANTI JOIN link USING (conv_id, turn) UNION ALL
  SELECT link.conv_id, link.turn, up.root, up.depth + 1 FROM up JOIN link ON link.conv_id = up.conv_id AND link.reply_to = up.turn),
quotes AS (
  SELECT a.conv_id, a.turn, CAST(q.whole <> '' AS INT) + CAST(coalesce(r.whole, '') <> '' AS INT) AS n FROM norm a
  JOIN norm q ON q.conv_id = a.conv_id AND q.turn = a.t1
  LEFT JOIN norm r ON r.conv_id = a.conv_id AND r.turn = q.t1)
SELECT m.conv_id, m.turn, m.role, regexp_replace(m.text, '^\n+|\n+$', '', 'g') AS own, link.reply_to, up.root,
  CAST(up.depth AS BIGINT) AS depth, row_number() OVER (PARTITION BY m.conv_id ORDER BY up.root, m.turn) AS reply_order,
  CAST(coalesce(quotes.n, 0) AS BIGINT) AS n_quotes
FROM m JOIN up USING (conv_id, turn) LEFT JOIN link USING (conv_id, turn) LEFT JOIN quotes USING (conv_id, turn)
"""


def op5_cotraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the scores of both views, the combined score and the decision."""
    out = cotraining.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", "content_score", "meta_score", "score", "keep")


def op6_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document scored by a bigram model of the documents that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out"))
    model = fit(docs.where(~F.col("held_out")))
    return score(docs, model).withColumn("train_tokens", F.lit(model.tokens).cast("long"))


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its component of texts whose sets of 3-word shingles are 90 % alike."""
    out = jaccard_components(table(spark, sf_dir, "documents"), width=3, percent=90)
    return out.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"),
                      F.col("component").alias("component_id"))


def jaccard_sql(docs: str, width: int, percent: int) -> str:
    """CTEs (recursive) ending in ``joined``: doc_id, n_shingles, component_id."""
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    run = " || ' ' || ".join(f"ws[i + {k}]" for k in range(width))
    return f"""
words AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{letters}', '{letters.lower()}'),
    '[^\x20\x09-\x0D]+') AS ws FROM {docs}),
sh AS (SELECT DISTINCT doc_id, unnest(CASE
    WHEN len(ws) >= {width} THEN list_transform(range(1, len(ws) - {width - 2}), lambda i: {run})
    WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS s FROM words),
size AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
both_of AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared
    FROM sh x JOIN sh y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL),
link AS (SELECT a, b FROM both_of JOIN size p ON p.doc_id = a JOIN size q ON q.doc_id = b
    WHERE 100 * shared >= {percent} * (p.n + q.n - shared)),
reach AS (SELECT a AS doc_id, a AS least FROM link UNION
    SELECT link.b, least FROM reach JOIN link ON link.a = reach.doc_id),
joined AS (SELECT w.doc_id, coalesce(any_value(size.n), 0) AS n_shingles,
    least(w.doc_id, coalesce(min(reach.least), w.doc_id)) AS component_id
    FROM words w LEFT JOIN size USING (doc_id) LEFT JOIN reach USING (doc_id) GROUP BY w.doc_id)"""


OP7_SQL = f"WITH RECURSIVE {jaccard_sql('documents', 3, 90)} SELECT * FROM joined"


def op8_zip_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as its record was read back from the ZIP packages."""
    out = round_trip(table(spark, sf_dir, "pages"))
    return out.select(F.col("record_id").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                      F.col("refers_to").cast("long").alias("refers_to"))


OP8_SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS raw FROM pages),
d AS (SELECT page_id, octet_length(raw) AS n, sha1(raw) AS hex, max(page_id) OVER (PARTITION BY raw) AS kept FROM p)
SELECT page_id, n AS payload_bytes, array_to_string(list_transform(range(32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + CAST((CAST('0x' || substr(hex, 1 + 5 * (k // 4), 5) AS BIGINT) // [32768, 1024, 32, 1][1 + k % 4]) % 32 AS BIGINT), 1)), '') AS payload_digest,
  CASE WHEN kept = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN kept <> page_id THEN kept END AS refers_to
FROM d
"""


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document with its sequence and its place there."""
    out = pack_documents(table(spark, sf_dir, "documents"), VOCABULARY, RANKS)
    return out.withColumnRenamed("id", "doc_id")


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its raked probability and whether it is drawn."""
    out = mix(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.col("mix_topic").alias("topic"), F.col("mix_tokens").alias("tokens"),
                      F.round("mix_probability", 6).alias("probability"), F.col("mix_kept").alias("kept"))


def mixing_sql(docs: str, rounds: int = 60) -> str:
    """CTEs ending in ``mixed``: ``docs`` plus topic, tokens, probability and kept."""
    target = lambda d: f"""
t_{d} AS (SELECT {d}, pow(sum(weight), {POWERS[d]}) / sum(pow(sum(weight), {POWERS[d]})) OVER () AS goal
  FROM cell GROUP BY {d} HAVING sum(weight) > 0)"""  # noqa: E731
    steps, now = [], "start"
    for r in range(rounds):
        for d in POWERS:
            steps.append(f"""{d}{r} AS (SELECT x.source, x.lang, x.topic, weight,
  f * coalesce(goal / nullif(sum(f) OVER (PARTITION BY x.{d}), 0), 1) AS f
  FROM {now} x LEFT JOIN t_{d} t ON x.{d} IS NOT DISTINCT FROM t.{d})""")
            now = f"{d}{r}"
    return f"""
labelled AS (SELECT *, CASE
    WHEN contains(lower(coalesce(text, '')), 'license') OR contains(lower(coalesce(text, '')), 'copyright') THEN 'legal'
    WHEN contains(text, '@') OR contains(lower(text), 'http') THEN 'contact'
    WHEN contains(text, ' | ') THEN 'table'
    WHEN length(coalesce(text, '')) < 1000 THEN 'note' ELSE 'prose' END AS topic,
  len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS tokens FROM {docs}),
cell AS (SELECT source, lang, topic, CAST(sum(tokens) AS DOUBLE) AS weight FROM labelled GROUP BY ALL),
{",".join(target(d) for d in POWERS)},
start AS (SELECT *, weight / sum(weight) OVER () AS f FROM cell),
{", ".join(steps)},
rate AS (SELECT source, lang, topic, coalesce(f / nullif(weight, 0) / max(f / nullif(weight, 0)) OVER (), 1) AS p FROM {now}),
mixed AS (SELECT l.*, p AS probability,
  CAST(('0x' || substr(md5('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 12)) AS BIGINT)
    / pow(16.0, 12) < p AS kept
  FROM labelled l JOIN rate r ON l.source IS NOT DISTINCT FROM r.source
    AND l.lang IS NOT DISTINCT FROM r.lang AND l.topic = r.topic)"""


OP10_SQL = f"""WITH {mixing_sql('documents')}
SELECT doc_id, topic, CAST(tokens AS BIGINT) AS tokens, round(probability, 6) AS probability, kept FROM mixed"""


def op11_range_coding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as it was read back from the range-coded files of token ids."""
    files = token_files.write(table(spark, sf_dir, "documents"), VOCABULARY, RANKS)
    return token_files.read(spark, files).withColumnRenamed("id", "doc_id")


def op12_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its weight towards ``benchmark`` and its rank if it is drawn."""
    out = resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select(F.col("id").alias("doc_id"), "n_features", "weight", "score", "rank")


#: DuckDB has no CRC-32, so its table is made by the rule and applied byte by byte to distinct words.
OP12_SQL = r"""
WITH RECURSIVE bit AS (SELECT range AS b, range AS c, 0 AS k FROM range(256) UNION ALL
  SELECT b, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bit WHERE k < 8),
crc AS (SELECT list(c ORDER BY b) AS t FROM bit WHERE k = 8),
texts AS (SELECT 'd' AS side, doc_id, text FROM documents UNION ALL SELECT 't', NULL, text FROM benchmark),
words AS (SELECT side, doc_id, regexp_extract_all(
  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM texts),
dict AS (SELECT w, list_transform(range(octet_length(encode(w))),
    lambda i: CAST('0x' || substr(hex(encode(w)), 1 + 2 * i, 2) AS BIGINT)) AS bytes
  FROM (SELECT DISTINCT unnest(ws) AS w FROM words)),
coded AS (SELECT w, xor(list_reduce(list_prepend(4294967295, bytes),
    lambda x, y: xor(t[xor(x & 255, y) + 1], x >> 8)), 4294967295) % 10000 AS bucket FROM dict, crc),
feature AS (SELECT side, doc_id, bucket FROM (SELECT side, doc_id, unnest(ws) AS w FROM words) JOIN coded USING (w)),
tally AS (SELECT bucket, count(*) FILTER (WHERE side = 'd') AS s, count(*) FILTER (WHERE side = 't') AS t FROM feature GROUP BY bucket),
total AS (SELECT sum(s) AS s_all, sum(t) AS t_all FROM tally),
gain AS (SELECT bucket, CAST(floor(1000 * ln(CAST((t + 1) * (s_all + 10000) AS DOUBLE) / CAST((s + 1) * (t_all + 10000) AS DOUBLE))) AS BIGINT) AS g
  FROM tally, total),
summed AS (SELECT doc_id, CAST(sum(g) AS BIGINT) AS weight FROM feature JOIN gain USING (bucket) WHERE side = 'd' GROUP BY doc_id),
scored AS (SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM words LEFT JOIN summed USING (doc_id) WHERE side = 'd'),
ranked AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r, count(*) OVER () AS n FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN r <= 10 * n // 100 THEN r END AS rank FROM scored LEFT JOIN ranked USING (doc_id)
"""


def op13_rotated_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector of 64 finite components with its cluster after ten rounds."""
    return cluster(table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


def centroids_sql(rounds: int = 10, k: int = 8, dims: int = 64, seed: int = 3) -> str:
    steps, now = [], "c0"
    near = lambda c: f"""SELECT id, min_by(cluster, dist * {k} + cluster) AS cluster, min(dist) AS dist FROM (
    SELECT x.id, c.cluster, CAST(sum((x.x - c.x) * (x.x - c.x)) AS BIGINT) AS dist FROM x JOIN {c} c USING (pos) GROUP BY ALL) GROUP BY id"""  # noqa: E731
    for r in range(1, rounds + 1):
        steps.append(f"""a{r} AS MATERIALIZED ({near(now)}),
m{r} AS (SELECT cluster, pos, sum(x)::HUGEINT AS s, count(*) AS n FROM x JOIN a{r} USING (id) GROUP BY ALL),
c{r} AS MATERIALIZED (SELECT {now}.cluster, {now}.pos, CAST(CASE WHEN n IS NULL THEN x ELSE (s - ((s % n) + n) % n) // n END AS BIGINT) AS x
  FROM {now} LEFT JOIN m{r} USING (cluster, pos))""")
        now = f"c{r}"
    return f"""
WITH v AS (SELECT row_number() OVER () AS id, vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE len(embedding) = {dims}),
ok AS (SELECT id, vec_id, list_transform(e, lambda y: CAST(floor(1024 * y) AS BIGINT)) AS e FROM v
  WHERE len(list_filter(e, lambda y: y IS NULL OR NOT isfinite(y))) = 0),
x AS MATERIALIZED (SELECT id, unnest(e) AS x, unnest(range({dims})) AS pos FROM ok),
firsts AS (SELECT e, row_number() OVER (ORDER BY sha256('{seed}:' || vec_id), e) - 1 AS cluster FROM ok QUALIFY cluster < {k}),
c0 AS MATERIALIZED (SELECT cluster, unnest(e) AS x, unnest(range({dims})) AS pos FROM firsts),
{",".join(steps)},
fin AS MATERIALIZED ({near(now)}),
named AS (SELECT cluster, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY pos)) AS centroid_sha256 FROM {now} GROUP BY cluster)
SELECT vec_id, CAST(cluster AS INT) AS cluster, dist AS distance, CAST(sum(dist) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
  CAST(sum(dist) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM fin JOIN ok USING (id) JOIN named USING (cluster)"""


LLM_QUERIES = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_line_dedup": op2_line_dedup,
    "op3_multi_index": op3_multi_index,
    "op4_quote_threads": op4_quote_threads,
    "op5_cotraining": op5_cotraining,
    "op6_kneser_ney": op6_kneser_ney,
    "op7_jaccard_join": op7_jaccard_join,
    "op8_zip_warc": op8_zip_warc,
    "op9_packing": op9_packing,
    "op10_mixing": op10_mixing,
    "op11_range_coding": op11_range_coding,
    "op12_importance": op12_importance,
    "op13_rotated_centroids": op13_rotated_centroids,
}

LLM_ORACLE = {
    "op1_exact_dedup": OP1_SQL,
    "op2_line_dedup": OP2_SQL,
    "op3_multi_index": OP3_SQL,
    "op4_quote_threads": OP4_SQL,
    "op7_jaccard_join": OP7_SQL,
    "op8_zip_warc": OP8_SQL,
    "op10_mixing": OP10_SQL,
    "op12_importance": OP12_SQL,
    "op13_rotated_centroids": centroids_sql(),
}

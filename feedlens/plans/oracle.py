"""DuckDB twins of the registered queries (the correctness oracle).

Each entry is plain SQL over the pre-registered views (``documents``,
``embeddings``, ``events`` ...).  The SQL is written independently of the
Spark plans: windows and lists where Spark uses partial aggregates, but the
same rules, constants and rounding.
"""

from __future__ import annotations

from .. import constants as C
from ..functions.text import NON_WORD, PUNCT_CHARS, WS, WS_CHARS
from ..sources.tables import LINE_STRIDE
from .catalog import DENSITY_EPS2
from .inputs import DOC_ASPECTS, DOC_LEXICON


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _in_list(words) -> str:
    return "(" + ", ".join(_q(w) for w in words) + ")"


def _values(rows, cols) -> str:
    body = ", ".join("(" + ", ".join(_q(v) if isinstance(v, str) else f"CAST({v!r} AS DOUBLE)"
                                     for v in r) + ")" for r in rows)
    return f"(VALUES {body}) AS v({', '.join(cols)})"


def strip(x: str) -> str:
    return f"trim({x}, {_q(WS_CHARS)})"


DOC_LINES = f"""
SELECT d.source AS request_id,
       CASE WHEN coalesce(d.n_chars, 0) % 2 = 0 THEN 'baseline' ELSE 'comparison' END AS dataset,
       CAST(d.doc_id * {LINE_STRIDE} + (u.i - 1) AS BIGINT) AS pos,
       CAST(d.doc_id AS VARCHAR) || '-' || CAST(u.i - 1 AS VARCHAR) AS id,
       u.line AS sentence,
       d.lang AS theme
FROM documents d, unnest(string_split(d.text, chr(10))) WITH ORDINALITY AS u(line, i)
"""

DOC_VALID = f"""
SELECT request_id, dataset, pos, id, {strip('sentence')} AS sentence, theme
FROM ({DOC_LINES}) l
WHERE {strip('sentence')} <> ''
"""


def dround(x: str, n: int) -> str:
    """Spark's ``round`` on doubles: half-up on the shortest decimal form.

    The double is printed (shortest round-trip digits, as Java prints it),
    read back as a decimal and rounded there.
    """
    return f"CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38, 18)), {n}) AS DOUBLE)"


def _sign(v: str) -> str:
    return f"(CASE WHEN {v} < 0 THEN -1.0 ELSE 1.0 END)"


def _boost(p: str) -> str:
    return (f"(CASE WHEN {p} IN {_in_list(C.BOOSTER_INCREMENT_WORDS)} THEN {C.BOOST_STEP}::DOUBLE "
            f"WHEN {p} IN {_in_list(C.BOOSTER_DECREMENT_WORDS)} THEN {-C.BOOST_STEP}::DOUBLE "
            f"ELSE 0.0::DOUBLE END)")


def _negated(p: str) -> str:
    return f"coalesce({p} IN {_in_list(C.NEGATION_WORDS)} OR contains({p}, 'n''t'), false)"


def _classify(x: str, t: float = C.THRESHOLDS["standard"]) -> str:
    return (f"(CASE WHEN {x} >= {t} THEN 'positive' WHEN {x} <= {-t} THEN 'negative' "
            f"ELSE 'neutral' END)")


CAPS_RE = r"'^[^\p{Ll}]*\p{Lu}[^\p{Ll}]*$'"


def scores_sql(sentences_sql: str, lexicon=DOC_LEXICON) -> str:
    """Rule-based sentence scores; one row per sentence of ``sentences_sql``."""
    punct_strip = f"trim(raw, {_q(PUNCT_CHARS)})"
    f1, f2, f3 = C.BOOST_DISTANCE_FACTORS
    return f"""
WITH sent AS ({sentences_sql}),
lex AS (SELECT lower(token) AS lw, avg(valence) AS valence
        FROM {_values(lexicon, ['token', 'valence'])} GROUP BY 1),
tk AS (
  SELECT s.request_id, s.dataset, s.pos, u.raw, u.i - 1 AS i
  FROM sent s, unnest(list_filter(string_split_regex({strip('s.sentence')}, '{WS}+'),
                                  lambda x: x <> '')) WITH ORDINALITY AS u(raw, i)),
tw AS (
  SELECT *, CASE WHEN length({punct_strip}) <= 2 THEN raw ELSE {punct_strip} END AS w FROM tk),
tf AS (
  SELECT request_id, dataset, pos, i, w, lower(w) AS lw,
         regexp_matches(w, {CAPS_RE}) AS caps,
         lag(lower(w), 1) OVER win AS p1, lag(lower(w), 2) OVER win AS p2,
         lag(lower(w), 3) OVER win AS p3,
         count(*) OVER ws AS ntok,
         sum(CASE WHEN regexp_matches(w, {CAPS_RE}) THEN 1 ELSE 0 END) OVER ws AS ncaps,
         min(CASE WHEN lower(w) = 'but' THEN i END) OVER ws AS but_i
  FROM tw
  WINDOW win AS (PARTITION BY request_id, dataset, pos ORDER BY i),
         ws AS (PARTITION BY request_id, dataset, pos)),
t0 AS (
  SELECT tf.*, lex.valence AS lv, coalesce(lex.valence, 0.0) AS v,
         (ncaps > 0 AND ncaps < ntok) AS capdiff
  FROM tf LEFT JOIN lex ON tf.lw = lex.lw),
t1 AS (SELECT *, v + CASE WHEN caps AND capdiff THEN {_sign('v')} * {C.CAPS_STEP}::DOUBLE
                     ELSE 0.0 END AS v0 FROM t0),
t2 AS (SELECT *, v0 + {_sign('v0')} * {_boost('p1')} * {f1}::DOUBLE AS b1 FROM t1),
t3 AS (SELECT *, CASE WHEN {_negated('p1')} THEN b1 * {C.NEGATION_SCALAR}::DOUBLE ELSE b1 END AS v1
       FROM t2),
t4 AS (SELECT *, v1 + {_sign('v1')} * {_boost('p2')} * {f2}::DOUBLE AS b2 FROM t3),
t5 AS (SELECT *, CASE WHEN {_negated('p2')} THEN b2 * {C.NEGATION_SCALAR}::DOUBLE ELSE b2 END AS v2
       FROM t4),
t6 AS (SELECT *, v2 + {_sign('v2')} * {_boost('p3')} * {f3}::DOUBLE AS b3 FROM t5),
t7 AS (SELECT *, CASE WHEN {_negated('p3')} THEN b3 * {C.NEGATION_SCALAR}::DOUBLE ELSE b3 END AS v3
       FROM t6),
t8 AS (SELECT request_id, dataset, pos,
         CASE WHEN lv IS NULL OR lv = 0 THEN 0.0
              WHEN but_i IS NOT NULL AND i < but_i THEN v3 * {C.BUT_BEFORE}::DOUBLE
              WHEN but_i IS NOT NULL AND i > but_i THEN v3 * {C.BUT_AFTER}::DOUBLE
              ELSE v3 END AS tv
       FROM t7),
agg AS (
  SELECT request_id, dataset, pos, sum(tv) AS ssum,
         sum(CASE WHEN tv > 0 THEN tv + 1 ELSE 0.0 END) AS psum,
         sum(CASE WHEN tv < 0 THEN tv - 1 ELSE 0.0 END) AS nsum,
         sum(CASE WHEN tv = 0 THEN 1 ELSE 0 END) AS neu, count(*) AS n
  FROM t8 GROUP BY ALL),
pun AS (
  SELECT request_id, dataset, pos, id, sentence,
         least(length(sentence) - length(replace(sentence, '!', '')), {C.EXCLAIM_MAX}) AS excl,
         length(sentence) - length(replace(sentence, '?', '')) AS qm
  FROM sent),
p2 AS (
  SELECT pun.*, agg.ssum, agg.psum, agg.nsum, agg.neu, coalesce(agg.n, 0) AS n,
         excl * {C.EXCLAIM_STEP}::DOUBLE
         + CASE WHEN qm > 1 THEN CASE WHEN qm <= 3 THEN qm * {C.QUESTION_STEP}::DOUBLE
                                      ELSE {C.QUESTION_MAX_AMPLIFIER}::DOUBLE END
                ELSE 0.0 END AS punct
  FROM pun LEFT JOIN agg USING (request_id, dataset, pos)),
p3 AS (
  SELECT *, CASE WHEN ssum > 0 THEN ssum + punct WHEN ssum < 0 THEN ssum - punct ELSE ssum END AS s2,
         CASE WHEN psum > abs(nsum) THEN psum + punct ELSE psum END AS ps,
         CASE WHEN psum < abs(nsum) THEN nsum - punct ELSE nsum END AS ns
  FROM p2),
p4 AS (
  SELECT request_id, dataset, pos, id, sentence,
         CASE WHEN n = 0 THEN 0.0 ELSE round(abs(ns / (ps + abs(ns) + neu)), 3) END AS neg_score,
         CASE WHEN n = 0 THEN 1.0 ELSE round(abs(neu / (ps + abs(ns) + neu)), 3) END AS neu_score,
         CASE WHEN n = 0 THEN 0.0 ELSE round(abs(ps / (ps + abs(ns) + neu)), 3) END AS pos_score,
         CASE WHEN n = 0 THEN 0.0
              ELSE round(greatest(-1.0, least(1.0, s2 / sqrt(s2 * s2 + {C.NORMALIZE_ALPHA}))), 4)
         END AS compound
  FROM p3)
SELECT *, {_classify('compound')} AS label FROM p4
"""


def doc_scores_sql() -> str:
    return scores_sql(DOC_VALID)


def doc_scores_with_theme_sql() -> str:
    return f"""
SELECT s.*, v.theme FROM ({doc_scores_sql()}) s
JOIN ({DOC_VALID}) v USING (request_id, dataset, pos)
"""


def _median(col: str) -> str:
    lst = f"list_sort(list({col}))"
    return f"(({lst})[(count(*) + 1) // 2] + ({lst})[count(*) // 2 + 1]) / 2"


def cluster_sentiment_sql(scored_sql: str, group: list[str]) -> str:
    g = ", ".join(group)
    med = _median("compound")
    s1 = "sum(CAST(round(compound * 10000) AS BIGINT))"
    s2 = "sum(CAST(round(compound * 10000) AS BIGINT) * CAST(round(compound * 10000) AS BIGINT))"
    return f"""
SELECT {g}, count(*) AS total_sentences,
       CAST(sum(CASE WHEN label = 'positive' THEN 1 ELSE 0 END) AS BIGINT) AS positive,
       CAST(sum(CASE WHEN label = 'neutral' THEN 1 ELSE 0 END) AS BIGINT) AS neutral,
       CAST(sum(CASE WHEN label = 'negative' THEN 1 ELSE 0 END) AS BIGINT) AS negative,
       round(sum(CASE WHEN label = 'positive' THEN 1 ELSE 0 END) * 100.0::DOUBLE / count(*), 1)
         AS pct_positive,
       round(sum(CASE WHEN label = 'neutral' THEN 1 ELSE 0 END) * 100.0::DOUBLE / count(*), 1)
         AS pct_neutral,
       round(sum(CASE WHEN label = 'negative' THEN 1 ELSE 0 END) * 100.0::DOUBLE / count(*), 1)
         AS pct_negative,
       {_classify(f'round({med}, 9)')} AS overall,
       {dround(f"CAST({s1} AS DOUBLE) / (count(*) * 10000.0)", 3)} AS average_score,
       round({med}, 3) AS median,
       CASE WHEN count(*) > 1 THEN {dround(f"sqrt(greatest((CAST({s2} AS DOUBLE) - CAST({s1} AS DOUBLE) * CAST({s1} AS DOUBLE) / count(*)) / (count(*) - 1) / 1e8, 0.0))", 3)} ELSE 0.0 END AS std,
       round(min(compound), 3) AS min,
       round(max(compound), 3) AS max
FROM ({scored_sql}) x
GROUP BY {g}
"""


def theme_sentiment_sql() -> str:
    return cluster_sentiment_sql(doc_scores_with_theme_sql(),
                                 ["request_id", "dataset", "theme"])


def request_sentiment_sql() -> str:
    lst = "list_sort(list(average_score))"
    return f"""
SELECT request_id,
       round((({lst})[(count(*) + 1) // 2] + ({lst})[count(*) // 2 + 1]) / 2, 6) AS weighted_median,
       {_classify(f'round((({lst})[(count(*) + 1) // 2] + ({lst})[count(*) // 2 + 1]) / 2, 9)')}
         AS overall_sentiment
FROM (SELECT t.request_id, t.average_score
      FROM ({theme_sentiment_sql()}) t, range(t.total_sentences) r) e
GROUP BY request_id
"""


def word_tokens_sql(x: str, min_len: int = 2, fold: bool = False) -> str:
    low = f"lower({x})"
    if fold:
        low = f"translate({low}, {_q(C.ACCENT_FROM)}, {_q(C.ACCENT_TO)})"
    return (f"list_filter(string_split_regex({low}, '{NON_WORD}'), "
            f"lambda t: regexp_matches(t, '^[a-z]{{{min_len},}}$'))")


def aspect_sentiment_sql() -> str:
    return f"""
WITH sc AS ({doc_scores_sql()}),
w AS (SELECT DISTINCT request_id, dataset, pos, compound, label, unnest({word_tokens_sql('sentence')}) AS term
      FROM sc),
a AS (SELECT * FROM {_values(DOC_ASPECTS, ['aspect', 'term'])}),
h AS (SELECT DISTINCT w.request_id, w.dataset, a.aspect, w.pos, w.compound, w.label
      FROM w JOIN a ON w.term = lower(a.term))
SELECT request_id, dataset, aspect, count(*) AS mentions,
       round(avg(compound), 3) AS average_score,
       CAST(sum(CASE WHEN label = 'positive' THEN 1 ELSE 0 END) AS BIGINT) AS positive,
       CAST(sum(CASE WHEN label = 'neutral' THEN 1 ELSE 0 END) AS BIGINT) AS neutral,
       CAST(sum(CASE WHEN label = 'negative' THEN 1 ELSE 0 END) AS BIGINT) AS negative
FROM h GROUP BY ALL
"""


def violations_sql() -> str:
    too_long = lambda n: _q(f"String should have at most {n} characters")
    short = _q("String should have at least 1 character")
    path = "dataset || '.' || CAST(pos AS VARCHAR) || '.'"
    return f"""
WITH s AS ({DOC_LINES}),
per AS (SELECT r.request_id,
               coalesce(CAST(sum(CASE WHEN dataset = 'baseline' THEN 1 ELSE 0 END) AS BIGINT), 0) AS nb,
               coalesce(CAST(sum(CASE WHEN dataset = 'comparison' THEN 1 ELSE 0 END) AS BIGINT), 0) AS nc
        FROM (SELECT DISTINCT request_id FROM s) r LEFT JOIN s USING (request_id)
        GROUP BY r.request_id),
dup AS (SELECT request_id, dataset, id FROM s WHERE id IS NOT NULL GROUP BY ALL HAVING count(*) > 1),
dupr AS (SELECT request_id, dataset, id,
                row_number() OVER (PARTITION BY request_id, dataset ORDER BY id) AS rn FROM dup)
SELECT request_id, {path} || 'sentence' AS field, {short} AS message,
       'string_too_short' AS type, 'error' AS severity FROM s WHERE length(sentence) < 1
UNION ALL
SELECT request_id, {path} || 'sentence', 'Input should be a valid string', 'string_type', 'error'
FROM s WHERE sentence IS NULL
UNION ALL
SELECT request_id, {path} || 'id', 'Input should be a valid string', 'string_type', 'error'
FROM s WHERE id IS NULL
UNION ALL
SELECT request_id, {path} || 'id', {short}, 'string_too_short', 'error' FROM s WHERE length(id) < 1
UNION ALL
SELECT request_id, {path} || 'sentence', {too_long(C.SENTENCE_MAX_CHARS)}, 'string_too_long', 'error'
FROM s WHERE length(sentence) > {C.SENTENCE_MAX_CHARS}
UNION ALL
SELECT request_id, {path} || 'id', {too_long(C.ID_MAX_CHARS)}, 'string_too_long', 'error'
FROM s WHERE length(id) > {C.ID_MAX_CHARS}
UNION ALL
SELECT request_id, {path} || 'sentence', {_q('Value error, ' + C.MSG_EMPTY_SENTENCE)}, 'value_error',
       'error'
FROM s WHERE length(sentence) BETWEEN 1 AND {C.SENTENCE_MAX_CHARS} AND {strip('sentence')} = ''
UNION ALL
SELECT request_id, dataset, 'Value error, Duplicate IDs found: ' || array_to_string(list_sort(list(id)), ', '),
       'value_error', 'error'
FROM dupr WHERE rn <= {C.MAX_DUPLICATES_LISTED} GROUP BY request_id, dataset
UNION ALL
SELECT request_id, 'baseline', 'List should have at least 1 item after validation, not 0', 'too_short',
       'error' FROM per WHERE nb = 0
UNION ALL
SELECT request_id, 'baseline', 'List should have at most {C.DATASET_MAX_ITEMS} items after validation, not '
       || CAST(nb AS VARCHAR), 'too_long', 'error' FROM per WHERE nb > {C.DATASET_MAX_ITEMS}
UNION ALL
SELECT request_id, 'comparison', 'List should have at most {C.DATASET_MAX_ITEMS} items after validation, not '
       || CAST(nc AS VARCHAR), 'too_long', 'error' FROM per WHERE nc > {C.DATASET_MAX_ITEMS}
UNION ALL
SELECT request_id, '', printf('Value error, Total sentences (%d) exceeds maximum ({C.TOTAL_MAX_ITEMS}). '
       || 'Baseline: %d, Comparison: %d', nb + nc, nb, nc), 'value_error', 'error'
FROM per WHERE nb + nc > {C.TOTAL_MAX_ITEMS}
UNION ALL
SELECT request_id, '', printf('Large request: %d sentences (may exceed 10s latency target)', nb + nc),
       'large_request', 'warning'
FROM per WHERE nb + nc > {C.TOTAL_WARN_ITEMS} AND nb + nc <= {C.TOTAL_MAX_ITEMS}
"""


def keep_first_sql() -> str:
    return f"""
SELECT request_id, dataset, id, pos FROM (
  SELECT request_id, dataset, md5(sentence) AS id, pos,
         row_number() OVER (PARTITION BY request_id, dataset, md5(sentence) ORDER BY pos) AS rn
  FROM ({DOC_VALID}) v) x
WHERE rn = 1
"""


def sentence_details_sql() -> str:
    return f"""
SELECT request_id, dataset, pos, id, substring(sentence, 1, 100) AS text, label AS sentiment,
       {dround('compound', 3)} AS compound, {dround('pos_score', 2)} AS pos_score,
       {dround('neu_score', 2)} AS neu_score, {dround('neg_score', 2)} AS neg_score,
       greatest(pos_score, neg_score, neu_score) AS confidence
FROM ({doc_scores_sql()}) s
"""


def sentence_scores_sql() -> str:
    return f"""
SELECT request_id, dataset, pos, id, neg_score, neu_score, pos_score, compound, label
FROM ({doc_scores_sql()}) s
"""


ORACLE = {
    "sentences_documents": DOC_LINES,
    "validation_violations": violations_sql(),
    "keep_first_by_text": keep_first_sql(),
    "sentence_scores": sentence_scores_sql(),
    "sentence_details": sentence_details_sql(),
    "theme_sentiment": theme_sentiment_sql(),
    "request_sentiment": request_sentiment_sql(),
    "aspect_sentiment": aspect_sentiment_sql(),
}


# -- keywords, phrases, titles, insights ------------------------------------

def _stop_list() -> str:
    from ..functions.stopwords import stop_words
    return _in_list(stop_words("english"))


def _g(group, alias=None) -> str:
    return ", ".join(f"{alias}.{c}" if alias else c for c in group)


def _on(group, a, b) -> str:
    return " AND ".join(f"{a}.{c} = {b}.{c}" for c in group)


def _lang_stop_cond(lang_col: str) -> str:
    from ..functions.stopwords import stop_words
    cases = " ".join(f"WHEN {_q(code)} THEN [{', '.join(_q(w) for w in stop_words(code))}]"
                     for code in ("en", "de", "fr", "es"))
    return f"NOT list_contains(CASE {lang_col} {cases} ELSE [] END, t)"


def keywords_sql(sentences_sql: str, group: list[str], max_keywords: int = C.MAX_KEYWORDS,
                 stop_cond: str | None = None, fallback: bool = True) -> str:
    g = _g(group)
    stop_cond = stop_cond or f"t NOT IN {_stop_list()}"
    low2 = f"translate(lower(sentence), {_q(C.ACCENT_FROM)}, {_q(C.ACCENT_TO)})"
    return f"""
WITH s AS ({sentences_sql}),
sizes AS (SELECT {g}, count(*) AS n FROM s GROUP BY ALL),
tk AS (SELECT {g}, pos,
              list_filter(string_split_regex({low2}, '{NON_WORD}'),
                          lambda t: regexp_matches(t, '^[a-z]{{2,}}$') AND {stop_cond}) AS toks
       FROM s),
terms AS (SELECT {g}, pos,
                 unnest(list_concat(toks, list_transform(range(1, len(toks)),
                                                        lambda i: toks[i] || ' ' || toks[i + 1]))) AS term
          FROM tk),
tf AS (SELECT {g}, pos, term, count(*) AS tf FROM terms GROUP BY ALL),
dfs AS (SELECT {g}, term, count(*) AS df, sum(tf) AS total FROM tf GROUP BY ALL),
vocab AS (
  SELECT * FROM (
    SELECT d.*, z.n, row_number() OVER (PARTITION BY {_g(group, 'd')} ORDER BY d.total DESC, d.term) AS r
    FROM dfs d JOIN sizes z ON {_on(group, 'd', 'z')}
    WHERE d.df <= z.n * {C.MAX_DF} AND d.df >= {C.MIN_DF} AND z.n * {C.MAX_DF} >= {C.MIN_DF}) x
  WHERE r <= {C.MAX_FEATURES}),
w AS (SELECT {_g(group, 'tf')}, tf.pos, tf.term,
             (1 + ln(tf.tf)) * (ln((1 + v.n) / (1 + v.df)) + 1) AS w
      FROM tf JOIN vocab v ON {_on(group, 'tf', 'v')} AND tf.term = v.term),
wn AS (SELECT *, w / sqrt(sum(w * w) OVER (PARTITION BY {g}, pos)) AS wn FROM w),
sc AS (SELECT {g}, term, sum(wn) AS score FROM wn GROUP BY ALL),
rk AS (SELECT *, contains(term, ' ') AS bi,
              row_number() OVER (PARTITION BY {g}, contains(term, ' ')
                                 ORDER BY round(score, 9) DESC, term DESC) AS k
       FROM sc),
kw AS (SELECT {g}, term AS keyword,
              row_number() OVER (PARTITION BY {g} ORDER BY bi DESC, k) AS rank
       FROM rk WHERE (bi AND k <= {C.TOP_BIGRAMS}) OR (NOT bi AND k <= {C.TOP_UNIGRAMS})),
fbg AS (SELECT {g} FROM sizes EXCEPT SELECT DISTINCT {g} FROM vocab),
fbw AS (SELECT {_g(group, 's')}, s.pos, u.idx, u.word
        FROM s JOIN fbg ON {_on(group, 's', 'fbg')},
             unnest(list_filter(string_split_regex(lower(s.sentence), '{NON_WORD}'),
                                lambda t: regexp_matches(t, '^[a-z]{{3,}}$')
                                          AND t NOT IN {_in_list(C.FALLBACK_STOP_WORDS)}))
             WITH ORDINALITY AS u(word, idx)),
fbc AS (SELECT {g}, word, count(*) AS c, min((pos, idx)) AS first FROM fbw GROUP BY ALL),
fb AS (SELECT {g}, word AS keyword, row_number() OVER (PARTITION BY {g} ORDER BY c DESC, first) AS rank
       FROM fbc)
SELECT {g}, CAST(rank AS INTEGER) AS rank, keyword FROM kw WHERE rank <= {max_keywords}
""" + (f"""UNION ALL
SELECT {g}, CAST(rank AS INTEGER) AS rank, keyword FROM fb
WHERE rank <= {min(C.FALLBACK_TOP, max_keywords)}
""" if fallback else "")


def phrases_sql(sentences_sql: str, group: list[str]) -> str:
    g = _g(group)
    return f"""
WITH s AS ({sentences_sql}),
tk AS (SELECT {g}, pos, list_filter(string_split_regex(lower(sentence), '{NON_WORD}'),
                                    lambda t: regexp_matches(t, '^[a-z]{{3,}}$')) AS toks FROM s),
ph AS (SELECT {_g(group, 'tk')}, tk.pos, u.idx, u.phrase
       FROM tk, unnest(list_transform(range(1, len(toks)), lambda i: toks[i] || ' ' || toks[i + 1]))
            WITH ORDINALITY AS u(phrase, idx)),
pc AS (SELECT {g}, phrase, count(*) AS count, min((pos, idx)) AS first FROM ph GROUP BY ALL
       HAVING count(*) >= {C.PHRASE_MIN_COUNT}),
pr AS (SELECT {g}, phrase, count, row_number() OVER (PARTITION BY {g} ORDER BY count DESC, first) AS rank
       FROM pc)
SELECT {g}, CAST(rank AS INTEGER) AS rank, phrase, count FROM pr WHERE rank <= {C.PHRASE_TOP}
"""


def _title_expr(kws: str) -> str:
    bis = f"list_filter({kws}, lambda k: contains(k, ' '))"
    unis = f"list_filter({kws}, lambda k: NOT contains(k, ' '))"
    raw = (f"CASE WHEN len({bis}) >= 2 THEN {bis}[1] || ' & ' || {bis}[2] "
           f"WHEN len({bis}) = 1 THEN {bis}[1] "
           f"WHEN len({unis}) >= 2 THEN array_to_string({unis}[1:3], ' & ') "
           f"WHEN len({kws}) >= 1 THEN {kws}[1] END")
    cap = f"array_to_string(list_transform(string_split({raw}, ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ')"
    return (f"CASE WHEN ({raw}) IS NULL THEN {_q(C.GENERAL_TITLE)} "
            f"WHEN length({cap}) > {C.TITLE_MAX_CHARS} THEN left({cap}, {C.TITLE_CUT_CHARS}) || '...' "
            f"ELSE {cap} END")


def titles_sql(sentences_sql: str, group: list[str]) -> str:
    g = _g(group)
    return f"""
WITH s AS ({sentences_sql}),
kw AS ({keywords_sql(sentences_sql, group)}),
kl AS (SELECT {g}, list(keyword ORDER BY rank) AS kws FROM kw GROUP BY ALL),
cl AS (SELECT DISTINCT {g} FROM s),
j AS (SELECT {_g(group, 'cl')}, coalesce(kl.kws, []) AS kws FROM cl LEFT JOIN kl ON {_on(group, 'cl', 'kl')})
SELECT {g}, array_to_string(kws, '|') AS keywords, {_title_expr('kws')} AS title FROM j
"""


def _pct0(x: str) -> str:
    return f"CAST(CAST(round_even({x}, 0) AS BIGINT) AS VARCHAR)"


def insights_sql(sentences_sql: str, scored_sql: str, group: list[str]) -> str:
    g = _g(group)
    kw0 = "kws[1]"
    share = "(z.n / t.total * 100)"
    fmt2 = "printf('%.2f', CAST(round_even(CAST(cs.average_score AS DECIMAL(18, 3)), 2) AS DOUBLE))"
    return f"""
WITH s AS ({sentences_sql}),
sizes AS (SELECT {g}, count(*) AS n FROM s GROUP BY ALL),
tot AS (SELECT request_id, dataset, count(*) AS total FROM s GROUP BY ALL),
cs AS ({cluster_sentiment_sql(scored_sql, group)}),
kw AS ({keywords_sql(sentences_sql, group)}),
kl AS (SELECT {g}, list(keyword ORDER BY rank) AS kws FROM kw GROUP BY ALL),
ph AS (SELECT * FROM ({phrases_sql(sentences_sql, group)}) p WHERE rank = 1),
men AS (SELECT {_g(group, 's')}, sum(CASE WHEN contains(lower(s.sentence), kl.kws[1]) THEN 1 ELSE 0 END)
               AS mention_count
        FROM s JOIN kl ON {_on(group, 's', 'kl')} WHERE kl.kws[1] IS NOT NULL GROUP BY ALL),
j AS (
  SELECT {_g(group, 'z')}, z.n, t.total, kl.kws, cs.overall, cs.pct_positive, cs.pct_negative,
         cs.average_score, ph.phrase, ph.count AS phc, coalesce(men.mention_count, 0) AS mc,
         CASE WHEN t.total > 0 THEN
           CASE WHEN {share} >= {C.SHARE_RELATES_PCT}
                  THEN {_pct0(share)} || '% of feedback relates to ' || coalesce({kw0}, 'this topic')
                WHEN {share} >= {C.SHARE_MENTIONS_PCT}
                  THEN {_pct0(share)} || '% of feedback mentions ' || coalesce({kw0}, 'this theme') END
         END AS i1,
         CASE WHEN cs.overall = 'negative' AND cs.pct_negative >= {C.STRONG_SENTIMENT_PCT}
                THEN {_pct0('cs.pct_negative')} || '% express negative sentiment about '
                     || coalesce({kw0}, 'this topic') || ' - requires attention'
              WHEN cs.overall = 'positive' AND cs.pct_positive >= {C.STRONG_SENTIMENT_PCT}
                THEN 'Overwhelmingly positive (' || {_pct0('cs.pct_positive')} || '%) - key strength area'
              WHEN cs.pct_negative >= {C.MAJORITY_SENTIMENT_PCT}
                THEN 'Majority (' || {_pct0('cs.pct_negative')} || '%) are dissatisfied with '
                     || coalesce({kw0}, 'this topic')
              WHEN cs.pct_positive >= {C.MAJORITY_SENTIMENT_PCT}
                THEN 'Generally positive feedback (' || {_pct0('cs.pct_positive')} || '%)' END AS i2,
         CASE WHEN abs(cs.average_score) >= {C.MODERATE_AVG} THEN
           (CASE WHEN abs(cs.average_score) >= {C.STRONG_AVG} THEN 'Strong' ELSE 'Moderate' END) || ' '
           || (CASE WHEN cs.average_score > 0 THEN 'positive' ELSE 'negative' END)
           || ' sentiment (avg score: ' || {fmt2} || ')' END AS i3,
         CASE WHEN ph.phrase IS NOT NULL AND ph.count >= greatest(2.0, z.n * {C.PHRASE_SHARE})
              THEN 'Most common phrase: ''' || ph.phrase || ''' (' || CAST(ph.count AS VARCHAR) || ' mentions)'
         END AS i4,
         CASE WHEN {kw0} IS NOT NULL AND coalesce(men.mention_count, 0) / z.n > {C.KEYWORD_SHARE}
              THEN CAST(men.mention_count AS VARCHAR) || '/' || CAST(z.n AS VARCHAR)
                   || ' sentences explicitly mention ''' || {kw0} || '''' END AS i5,
         CASE WHEN z.n >= {C.VOLUME_SIZE}
              THEN 'Significant volume: ' || CAST(z.n AS VARCHAR) || ' feedback items in this category'
         END AS i6
  FROM sizes z
  LEFT JOIN tot t ON z.request_id = t.request_id AND z.dataset = t.dataset
  LEFT JOIN cs ON {_on(group, 'z', 'cs')}
  LEFT JOIN kl ON {_on(group, 'z', 'kl')}
  LEFT JOIN ph ON {_on(group, 'z', 'ph')}
  LEFT JOIN men ON {_on(group, 'z', 'men')})
SELECT {g}, array_to_string(list_filter([i1, i2, i3, i4, i5, i6], lambda x: x IS NOT NULL)[1:{C.MAX_INSIGHTS}], ' | ')
       AS key_insights
FROM j
"""


THEME_GROUP = ["request_id", "dataset", "theme"]
CONV_GROUP = ["request_id", "dataset", "cluster_id"]

CONV_VALID = f"""
SELECT 'conv-' || CAST(conv_id AS VARCHAR) AS request_id,
       CASE WHEN role = 'user' THEN 'baseline' ELSE 'comparison' END AS dataset,
       CAST(turn * {LINE_STRIDE} + (u.i - 1) AS BIGINT) AS pos,
       CAST(turn AS VARCHAR) || '-' || CAST(u.i - 1 AS VARCHAR) AS id,
       {strip('u.line')} AS sentence, 0 AS cluster_id
FROM conversations c, unnest(string_split(c.text, chr(10))) WITH ORDINALITY AS u(line, i)
WHERE {strip('u.line')} <> ''
"""

ORACLE.update({
    "keywords": keywords_sql(DOC_VALID, THEME_GROUP),
    "keywords_conversations": keywords_sql(CONV_VALID, CONV_GROUP),
    "phrases": phrases_sql(DOC_VALID, THEME_GROUP),
    "titles": titles_sql(DOC_VALID, THEME_GROUP),
    "insights": insights_sql(DOC_VALID, doc_scores_with_theme_sql(), THEME_GROUP),
})


# -- report assembly and comparison -------------------------------------------

def theme_report_sql() -> str:
    g = THEME_GROUP
    return f"""
WITH s AS ({DOC_VALID}),
cs AS ({theme_sentiment_sql()}),
tt AS ({titles_sql(DOC_VALID, g)}),
ins AS ({insights_sql(DOC_VALID, doc_scores_with_theme_sql(), g)}),
sz AS (SELECT request_id, dataset, theme, count(*) AS size, min(pos) AS first_pos FROM s GROUP BY ALL)
SELECT sz.request_id, sz.dataset, sz.theme AS cluster_id, sz.dataset || '-cluster-' || sz.theme AS id,
       coalesce(tt.title, 'Cluster ' || sz.theme) AS title, sz.size,
       coalesce(cs.overall, 'neutral') AS overall, coalesce(cs.average_score, 0.0) AS average_score,
       coalesce(cs.positive, 0) AS positive, coalesce(cs.neutral, 0) AS neutral,
       coalesce(cs.negative, 0) AS negative, coalesce(tt.keywords, '') AS keywords,
       coalesce(ins.key_insights, '') AS key_insights, sz.dataset AS source,
       CAST(row_number() OVER (PARTITION BY sz.request_id ORDER BY sz.size DESC,
            CASE WHEN sz.dataset = 'baseline' THEN 0 ELSE 1 END, sz.first_pos) AS INTEGER) AS rank
FROM sz
LEFT JOIN cs ON {_on(g, 'sz', 'cs')}
LEFT JOIN tt ON {_on(g, 'sz', 'tt')}
LEFT JOIN ins ON {_on(g, 'sz', 'ins')}
"""


def theme_summary_sql() -> str:
    lst = "list_sort(list(average_score))"
    wmed = f"(({lst})[(count(*) + 1) // 2] + ({lst})[count(*) // 2 + 1]) / 2"
    return f"""
WITH s AS ({DOC_VALID}),
cl AS ({theme_report_sql()}),
ov AS (SELECT request_id, {_classify(f'round({wmed}, 9)')} AS overall_sentiment
       FROM (SELECT c.request_id, c.average_score FROM cl c, range(c.size) r) e GROUP BY request_id),
tot AS (SELECT request_id, count(*) AS total_sentences FROM s GROUP BY ALL),
fnd AS (SELECT request_id, count(*) AS clusters_found FROM cl GROUP BY ALL)
SELECT tot.request_id, tot.total_sentences, coalesce(fnd.clusters_found, 0) AS clusters_found,
       CAST(0 AS BIGINT) AS unclustered, coalesce(ov.overall_sentiment, 'neutral') AS overall_sentiment
FROM tot LEFT JOIN fnd USING (request_id) LEFT JOIN ov USING (request_id)
"""


def theme_comparison_sql() -> str:
    return f"""
WITH cl AS (SELECT DISTINCT request_id, dataset, title FROM ({theme_report_sql()}) r),
per AS (SELECT request_id, title, max(dataset = 'baseline') AS b, max(dataset = 'comparison') AS c
        FROM cl GROUP BY ALL)
SELECT request_id,
       CASE WHEN b AND c THEN 'shared' WHEN b THEN 'baseline_only' ELSE 'comparison_only' END AS kind,
       title
FROM per WHERE request_id IN (SELECT request_id FROM cl WHERE dataset = 'comparison')
"""


def joint_sources_sql() -> str:
    return f"""
SELECT request_id, theme AS cluster_id,
       CAST(sum(CASE WHEN dataset = 'baseline' THEN 1 ELSE 0 END) AS BIGINT) AS baseline_count,
       CAST(sum(CASE WHEN dataset = 'comparison' THEN 1 ELSE 0 END) AS BIGINT) AS comparison_count,
       round(sum(CASE WHEN dataset = 'baseline' THEN 1 ELSE 0 END)
             / greatest(sum(CASE WHEN dataset = 'comparison' THEN 1 ELSE 0 END), 1), 6) AS ratio,
       CASE WHEN sum(CASE WHEN dataset = 'baseline' THEN 1 ELSE 0 END) > 0
                 AND sum(CASE WHEN dataset = 'comparison' THEN 1 ELSE 0 END) > 0 THEN 'shared'
            WHEN sum(CASE WHEN dataset = 'baseline' THEN 1 ELSE 0 END) > 0 THEN 'baseline_only'
            ELSE 'comparison_only' END AS kind
FROM ({DOC_VALID}) s GROUP BY request_id, theme
"""


def share_shift_sql() -> str:
    return f"""
WITH sc AS ({doc_scores_with_theme_sql()}),
per AS (SELECT request_id, theme,
               sum(CASE WHEN dataset = 'baseline' THEN 1 ELSE 0 END) AS xb,
               sum(CASE WHEN dataset = 'comparison' THEN 1 ELSE 0 END) AS xc,
               avg(CASE WHEN dataset = 'baseline' THEN compound END) AS mb,
               avg(CASE WHEN dataset = 'comparison' THEN compound END) AS mc
        FROM sc GROUP BY ALL),
tot AS (SELECT request_id, sum(CASE WHEN dataset = 'baseline' THEN 1 ELSE 0 END) AS nb,
               sum(CASE WHEN dataset = 'comparison' THEN 1 ELSE 0 END) AS nc FROM sc GROUP BY ALL),
j AS (SELECT per.*, tot.nb, tot.nc, xb / nb AS pb, xc / nc AS pc, (xb + xc) / (nb + nc) AS pp
      FROM per JOIN tot USING (request_id))
SELECT request_id, theme AS cluster_id, round(pb * 100, 3) AS baseline_share_pct,
       round(pc * 100, 3) AS comparison_share_pct, round((pc - pb) * 100, 3) AS share_shift_pct,
       round(CASE WHEN sqrt(pp * (1 - pp) * (1 / nb + 1 / nc)) > 0
                  THEN (pc - pb) / sqrt(pp * (1 - pp) * (1 / nb + 1 / nc)) END, 4) AS z,
       round(mc - mb, 4) AS sentiment_shift
FROM j
"""


def key_statements_sql() -> str:
    half_up = lambda x, n: f"printf('%.{n}f', CAST(round(CAST(abs({x}) AS DECIMAL(18, 4)), {n}) AS DOUBLE))"
    return f"""
WITH sh AS ({share_shift_sql()}),
kw AS ({keywords_sql(DOC_VALID, THEME_GROUP)}),
both_sides AS (SELECT b.request_id, b.theme AS cluster_id, list(b.keyword ORDER BY b.rank)[1:3] AS shared
         FROM kw b JOIN kw c ON b.request_id = c.request_id AND b.theme = c.theme AND b.keyword = c.keyword
         WHERE b.dataset = 'baseline' AND c.dataset = 'comparison' GROUP BY ALL)
SELECT sh.request_id, sh.cluster_id,
       coalesce('Both mention ' || array_to_string(shared, ', '), '') AS key_similarities,
       concat_ws(' | ',
         CASE WHEN abs(share_shift_pct) >= 1 THEN 'Share ' || CASE WHEN share_shift_pct > 0 THEN 'rises' ELSE 'falls' END
              || ' by ' || {half_up('share_shift_pct', 1)} || ' points' END,
         CASE WHEN abs(sentiment_shift) >= 0.05 THEN 'Sentiment '
              || CASE WHEN sentiment_shift > 0 THEN 'improves' ELSE 'worsens' END
              || ' by ' || {half_up('sentiment_shift', 2)} END) AS key_differences
FROM sh LEFT JOIN both_sides USING (request_id, cluster_id)
"""


def theme_grid_sql() -> str:
    g = THEME_GROUP
    return f"""
WITH s AS ({DOC_VALID}),
sz AS (SELECT request_id, dataset, theme, count(*) AS n FROM s GROUP BY ALL),
grid AS (SELECT t.request_id, d.dataset, t.theme
         FROM (SELECT DISTINCT request_id, theme FROM sz) t
         JOIN (SELECT DISTINCT request_id, dataset FROM sz) d USING (request_id)),
cs AS ({theme_sentiment_sql()}),
tt AS ({titles_sql(DOC_VALID, g)}),
ins AS ({insights_sql(DOC_VALID, doc_scores_with_theme_sql(), g)})
SELECT {_g(g, 'grid')}, coalesce(sz.n, 0) AS size,
       CASE WHEN sz.n IS NULL THEN {_q(C.EMPTY_TITLE)} ELSE tt.title END AS title,
       coalesce(tt.keywords, '') AS keywords, coalesce(ins.key_insights, '') AS key_insights,
       coalesce(cs.total_sentences, 0) AS total_sentences, coalesce(cs.positive, 0) AS positive,
       coalesce(cs.neutral, 0) AS neutral, coalesce(cs.negative, 0) AS negative,
       coalesce(cs.pct_positive, 0.0) AS pct_positive, coalesce(cs.pct_neutral, 100.0) AS pct_neutral,
       coalesce(cs.pct_negative, 0.0) AS pct_negative, coalesce(cs.overall, 'neutral') AS overall,
       coalesce(cs.average_score, 0.0) AS average_score, coalesce(cs.median, 0.0) AS median,
       coalesce(cs.std, 0.0) AS std, coalesce(cs.min, 0.0) AS min, coalesce(cs.max, 0.0) AS max
FROM grid
LEFT JOIN sz ON {_on(g, 'grid', 'sz')}
LEFT JOIN cs ON {_on(g, 'grid', 'cs')}
LEFT JOIN tt ON {_on(g, 'grid', 'tt')}
LEFT JOIN ins ON {_on(g, 'grid', 'ins')}
"""


ORACLE.update({
    "key_statements": key_statements_sql(),
    "theme_grid": theme_grid_sql(),
    "theme_report": theme_report_sql(),
    "theme_summary": theme_summary_sql(),
    "theme_comparison": theme_comparison_sql(),
    "joint_sources": joint_sources_sql(),
    "share_shift": share_shift_sql(),
})


# -- operational metrics --------------------------------------------------------

LOG = """
SELECT event_id, ts, user_id, event_type, event_type = 'error' AS is_error, value AS duration,
       CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
FROM events
"""


def _log_sql() -> dict[str, str]:
    return {
        "log_counts": f"""
SELECT event_type, count(*) AS requests FROM ({LOG}) l
WHERE ts >= TIMESTAMP '2024-01-01' AND ts < TIMESTAMP '2024-02-01' GROUP BY event_type""",
        "log_error_rate": f"""
SELECT CAST(ts AS DATE) AS day, count(*) AS requests,
       CAST(sum(CASE WHEN is_error THEN 1 ELSE 0 END) AS BIGINT) AS errors,
       {dround('avg(CASE WHEN is_error THEN 1.0 ELSE 0.0 END) * 100', 4)} AS error_rate_pct
FROM ({LOG}) l GROUP BY 1""",
        "log_duration_stats": f"""
SELECT event_type, count(*) AS n, {dround('avg(duration)', 6)} AS avg_duration,
       max(duration) AS max_duration,
       {dround('quantile_cont(duration, 0.5)', 6)} AS p50,
       {dround('quantile_cont(duration, 0.95)', 6)} AS p95,
       {dround('quantile_cont(duration, 0.99)', 6)} AS p99
FROM ({LOG}) l GROUP BY event_type""",
        "log_alarms": f"""
WITH a AS (SELECT event_type, count(*) AS requests, {dround('avg(CAST(is_error AS DOUBLE)) * 100', 4)} AS error_rate_pct,
                  {dround('quantile_cont(duration, 0.95)', 6)} AS p95 FROM ({LOG}) l GROUP BY event_type)
SELECT *, error_rate_pct > 5.0 AS error_alarm, p95 > 10.0 AS latency_alarm FROM a""",
        "log_slowest": f"""
SELECT * FROM (
  SELECT CAST(row_number() OVER (ORDER BY duration DESC, event_id) AS INTEGER) AS rank,
         event_id, ts, user_id, event_type, duration FROM ({LOG}) l) x
WHERE rank <= 20""",
        "log_cold_warm": f"""
WITH g AS (SELECT ts, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS prev FROM ({LOG}) l)
SELECT CAST(sum(CASE WHEN prev IS NULL OR ts - prev > INTERVAL 15 MINUTE THEN 1 ELSE 0 END) AS BIGINT)
         AS cold,
       CAST(sum(CASE WHEN prev IS NULL OR ts - prev > INTERVAL 15 MINUTE THEN 0 ELSE 1 END) AS BIGINT)
         AS warm
FROM g""",
        "log_error_context": f"""
SELECT event_id, user_id, event_type FROM (
  SELECT *, max(CASE WHEN is_error THEN 1 ELSE 0 END) OVER (
           PARTITION BY user_id ORDER BY ts, event_id
           ROWS BETWEEN 5 PRECEDING AND 5 FOLLOWING) AS near
  FROM ({LOG}) l) x
WHERE near = 1""",
        "log_bins": f"""
SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS bin_start, count(*) AS n,
       {dround('avg(duration)', 6)} AS avg_duration, max(duration) AS max_duration,
       {dround('avg(k)', 6)} AS avg_k
FROM ({LOG}) l GROUP BY 1""",
        "analysis_metrics": f"""
SELECT request_id, count(*) AS sentences, count(DISTINCT theme) AS clusters,
       {dround('count(*) / count(DISTINCT theme)', 6)} AS avg_cluster_size,
       CAST(0.0 AS DOUBLE) AS unclustered_ratio
FROM ({DOC_VALID}) s GROUP BY request_id""",
    }


# -- vectors and clustering on given labels ---------------------------------------

VEC = """
SELECT vec_id, embedding, CASE WHEN label = 0 THEN -1 ELSE label END AS given_label FROM embeddings
"""
VEC_DIMS = f"""
SELECT v.vec_id, v.given_label, u.i - 1 AS i, CAST(u.x AS DOUBLE) AS x
FROM ({VEC}) v, unnest(v.embedding) WITH ORDINALITY AS u(x, i)
"""


def _vec_sql() -> dict[str, str]:
    cent = f"SELECT given_label, i, avg(x) AS c FROM ({VEC_DIMS}) d GROUP BY ALL"
    sil = f"""
WITH p AS (SELECT * FROM ({VEC_DIMS}) d WHERE given_label <> -1),
pn AS (SELECT vec_id, given_label, sum(x * x) AS q FROM p GROUP BY ALL),
cs AS (SELECT given_label AS b, count(*) AS m, sum(q) AS qq FROM pn GROUP BY ALL),
sv AS (SELECT given_label AS b, i, sum(x) AS s FROM p GROUP BY ALL),
dt AS (SELECT p.vec_id, sv.b, sum(p.x * sv.s) AS dot FROM p JOIN sv ON p.i = sv.i GROUP BY ALL),
tot AS (SELECT pn.vec_id, pn.given_label AS a, cs.b, cs.m, cs.m * pn.q - 2 * dt.dot + cs.qq AS t
        FROM pn JOIN dt ON pn.vec_id = dt.vec_id JOIN cs ON cs.b = dt.b),
per AS (SELECT vec_id, max(CASE WHEN a = b THEN m END) AS ma, max(CASE WHEN a = b THEN t END) AS ta,
               min(CASE WHEN a <> b THEN t / m END) AS bb FROM tot GROUP BY vec_id),
s AS (SELECT CASE WHEN ma <= 1 THEN 0.0 ELSE
               CASE WHEN greatest(greatest(ta, 0) / (ma - 1), greatest(bb, 0)) > 0
                    THEN (greatest(bb, 0) - greatest(ta, 0) / (ma - 1))
                         / greatest(greatest(ta, 0) / (ma - 1), greatest(bb, 0))
                    ELSE 0.0 END END AS s FROM per)
SELECT CASE WHEN (SELECT count(*) FROM cs) < 2 OR (SELECT sum(m) FROM cs) < 2 THEN -1.0
            ELSE (SELECT avg(s) FROM s) END AS quality"""
    return {
        "emb_normalize": f"""
SELECT v.vec_id, CAST(u.i - 1 AS INTEGER) AS i,
       {dround('CAST(u.x AS DOUBLE) / sqrt(list_reduce(list_transform(v.embedding, lambda e: CAST(e AS DOUBLE) * CAST(e AS DOUBLE)), lambda a, b: a + b))', 6)} AS value
FROM embeddings v, unnest(v.embedding) WITH ORDINALITY AS u(x, i)""",
        "emb_dimensions": f"""
SELECT 'corpus' AS request_id, 'baseline' AS dataset, count(*) AS n,
       CAST(min(len(embedding)) AS INTEGER) AS dim_min, CAST(max(len(embedding)) AS INTEGER) AS dim_max,
       CAST(sum(CASE WHEN len(embedding) <> 64 THEN 1 ELSE 0 END) AS BIGINT) AS n_bad,
       CAST(sum(CASE WHEN list_sum(list_transform(embedding, lambda e: e * e)) = 0 THEN 1 ELSE 0 END)
            AS BIGINT) AS n_zero
FROM embeddings""",
        "emb_cosine_centroid": f"""
WITH c AS ({cent}), d AS ({VEC_DIMS}),
j AS (SELECT d.vec_id, d.given_label, sum(d.x * c.c) AS dot, sum(d.x * d.x) AS nx, sum(c.c * c.c) AS nc
      FROM d JOIN c ON d.given_label = c.given_label AND d.i = c.i GROUP BY ALL)
SELECT vec_id, given_label,
       {dround('CASE WHEN sqrt(nx) * sqrt(nc) > 0 THEN dot / (sqrt(nx) * sqrt(nc)) END', 6)} AS cosine
FROM j""",
        "cluster_stats_given": f"""
WITH v AS ({VEC}),
st AS (SELECT count(DISTINCT CASE WHEN given_label <> -1 THEN given_label END) AS n_clusters,
              CAST(sum(CASE WHEN given_label = -1 THEN 1 ELSE 0 END) AS BIGINT) AS noise_count,
              count(*) AS n FROM v),
q AS ({sil})
SELECT 'corpus' AS request_id, 'baseline' AS dataset, n, n_clusters, noise_count,
       {dround('noise_count / n', 6)} AS noise_ratio, {dround('quality', 6)} AS quality,
       (noise_count / n < {C.NOISE_THRESHOLD} AND n_clusters >= 3 AND n_clusters <= {C.MAX_CLUSTERS}
        AND quality > 0) AS accepted
FROM st, q""",
        "cluster_params": f"""
WITH s AS (SELECT request_id, dataset FROM ({DOC_VALID}) a UNION ALL
           SELECT request_id, dataset FROM ({CONV_VALID}) b),
c AS (SELECT request_id, dataset, count(*) AS n FROM s GROUP BY ALL),
m AS (SELECT *, CAST(CASE WHEN n < 50 THEN 3 WHEN n < 200 THEN greatest(5, n // 30)
                          ELSE greatest(10, n // 40) END AS INTEGER) AS min_cluster_size FROM c)
SELECT request_id, dataset, n, min_cluster_size,
       CAST(greatest(2, min_cluster_size // 2) AS INTEGER) AS min_samples, 3 AS k_min,
       CAST(least({C.MAX_CLUSTERS}, n // 2 - 1) AS INTEGER) AS k_max, n < 3 AS too_few
FROM m""",
        "noise_reassign_given": f"""
WITH v AS (SELECT vec_id, given_label, CAST(embedding AS DOUBLE[]) AS x FROM ({VEC}) y),
dist AS (SELECT n.vec_id, c.given_label AS cl, list_distance(n.x, c.x) AS dd, c.vec_id AS near
         FROM v n JOIN v c ON n.given_label = -1 AND c.given_label <> -1)
SELECT vec_id, CAST(arg_min(cl, (dd, near)) AS INTEGER) AS cluster_id FROM dist GROUP BY vec_id""",
        "density_reachability": f"""
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding[1] AS DOUBLE) AS x0, CAST(embedding[2] AS DOUBLE) AS x1,
                            CAST(embedding[3] AS DOUBLE) AS x2 FROM embeddings WHERE len(embedding) >= 3),
size AS (SELECT CASE WHEN count(*) < 50 THEN 3 WHEN count(*) < 200 THEN greatest(5, count(*) // 30)
                     ELSE greatest(10, count(*) // 40) END AS mcs FROM v),
near AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
         ON (a.x0 - b.x0) * (a.x0 - b.x0) + (a.x1 - b.x1) * (a.x1 - b.x1) + (a.x2 - b.x2) * (a.x2 - b.x2) <= {DENSITY_EPS2}),
core AS (SELECT a AS vec_id FROM near GROUP BY a HAVING count(*) >= (SELECT greatest(2, mcs // 2) FROM size)),
link AS (SELECT a, b FROM near WHERE a IN (FROM core) AND b IN (FROM core)),
reach AS (SELECT a, a AS least FROM link UNION SELECT link.b, least FROM reach JOIN link ON link.a = reach.a),
low AS (SELECT a AS vec_id, min(least) AS least FROM reach GROUP BY a),
kept AS (SELECT least, row_number() OVER (ORDER BY least) - 1 AS cluster_id FROM low
         GROUP BY least HAVING count(*) >= (SELECT mcs FROM size))
SELECT v.vec_id, CAST(coalesce(kept.cluster_id, -1) AS INTEGER) AS cluster_id
FROM v LEFT JOIN low USING (vec_id) LEFT JOIN kept USING (least)""",
        "small_cluster_merge": f"""
WITH v AS ({VEC}),
sz AS (SELECT given_label, count(*) AS size,
              row_number() OVER (ORDER BY count(*) DESC, given_label) AS r
       FROM v WHERE given_label <> -1 GROUP BY given_label)
SELECT v.vec_id, CAST(CASE WHEN sz.size IS NOT NULL AND (sz.size < 3 OR sz.r > 5) THEN -2
                           ELSE v.given_label END AS INTEGER) AS cluster_id
FROM v LEFT JOIN sz ON v.given_label = sz.given_label""",
        "rand_index_labels": """
WITH c AS (SELECT quality, toxic, count(*) AS n FROM labels GROUP BY ALL),
t AS (SELECT sum(n) AS nn, sum(n * (n - 1) / 2) AS sij FROM c),
a AS (SELECT sum(ca * (ca - 1) / 2) AS sa FROM (SELECT quality, sum(n) AS ca FROM c GROUP BY ALL) x),
b AS (SELECT sum(cb * (cb - 1) / 2) AS sb FROM (SELECT toxic, sum(n) AS cb FROM c GROUP BY ALL) y)
SELECT 'labels' AS g, CAST(nn AS BIGINT) AS n,
       round((nn * (nn - 1) / 2 + 2 * sij - sa - sb) / (nn * (nn - 1) / 2), 6) AS rand_index
FROM t, a, b""",
    }


ORACLE.update(_log_sql())
ORACLE.update(_vec_sql())


# -- request JSON, streaming twins ------------------------------------------------

ORACLE.update({
    "requests_json": f"""
SELECT CAST(d.doc_id AS VARCHAR) AS request_id, 'baseline' AS dataset, CAST(u.i - 1 AS BIGINT) AS pos,
       CAST(d.doc_id AS VARCHAR) || '-' || CAST(u.i - 1 AS VARCHAR) AS id, u.line AS sentence
FROM documents d, unnest(string_split(d.text, chr(10))) WITH ORDINALITY AS u(line, i)""",
    "requests_corrupt": """
SELECT CAST(page_id AS VARCHAR) AS request_id, 'body' AS field, 'Invalid JSON in request body' AS message,
       'json_invalid' AS type, 'error' AS severity
FROM pages WHERE html IS NOT NULL AND (NOT json_valid(html) OR json_type(html) <> 'OBJECT')""",
    "stream_scores": sentence_scores_sql(),
    "stream_dedupe": """
WITH RECURSIVE e AS (SELECT event_id, user_id, event_type, ts,
                            row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS r
                     FROM events WHERE ts IS NOT NULL),
step AS (SELECT *, ts AS last, true AS kept FROM e WHERE r = 1
         UNION ALL
         SELECT e.*, CASE WHEN e.ts - s.last > INTERVAL 30 MINUTE THEN e.ts ELSE s.last END,
                e.ts - s.last > INTERVAL 30 MINUTE
         FROM step s JOIN e ON e.user_id IS NOT DISTINCT FROM s.user_id
              AND e.event_type IS NOT DISTINCT FROM s.event_type AND e.r = s.r + 1)
SELECT event_id, user_id, event_type FROM step WHERE kept""",
    "stream_theme_windows": f"""
WITH doc AS (SELECT d.doc_id, any_value(lang) AS theme, count(*) AS sentences,
                    sum(CAST(round(compound * 10000) AS BIGINT)) AS total,
                    count(*) FILTER (WHERE label = 'positive') AS positive
             FROM ({doc_scores_sql()}) s JOIN documents d ON d.doc_id = s.pos // {LINE_STRIDE} GROUP BY d.doc_id),
hit AS (SELECT unnest([time_bucket(INTERVAL 30 MINUTE, ts), time_bucket(INTERVAL 30 MINUTE, ts) - INTERVAL 30 MINUTE]) AS window_start,
               doc.* FROM events JOIN doc ON doc.doc_id = events.user_id WHERE ts IS NOT NULL)
SELECT window_start, window_start + INTERVAL 60 MINUTE AS window_end, theme, count(*) AS events,
       CAST(sum(sentences) AS BIGINT) AS sentences, {dround('sum(total) / sum(sentences) / 10000', 6)} AS mean_compound,
       CAST(sum(positive) AS BIGINT) AS positive
FROM hit GROUP BY window_start, theme""",
    "stream_assign": f"""
WITH c AS (SELECT * FROM ({VEC_DIMS.replace('FROM (', 'FROM (', 1)}) x),
cen AS (SELECT given_label, i, avg(x) AS c FROM c WHERE given_label <> -1 GROUP BY ALL),
dist AS (SELECT c.vec_id, cen.given_label AS cl, sum((c.x - cen.c) * (c.x - cen.c)) AS dd
         FROM c JOIN cen ON c.i = cen.i GROUP BY ALL)
SELECT vec_id, CAST(arg_min(cl, (dd, cl)) AS INTEGER) AS cluster_id FROM dist GROUP BY vec_id""",
})


ORACLE.update({
    "aligned_sentences": f"""
SELECT request_id, theme AS cluster_id, dataset, pos, id, sentence FROM ({DOC_VALID}) s""",
    "centroid_alignment": f"""
WITH d AS (SELECT vec_id, given_label, i, x,
                  CASE WHEN vec_id % 2 = 0 THEN 'baseline' ELSE 'comparison' END AS dataset
           FROM ({VEC_DIMS}) z WHERE given_label <> -1),
c AS (SELECT dataset, given_label AS cl, i, avg(x) AS c FROM d GROUP BY ALL),
p AS (SELECT cc.cl AS comparison_cluster, bb.cl AS baseline_cluster,
             sum(cc.c * bb.c) AS dot, sum(cc.c * cc.c) AS nc, sum(bb.c * bb.c) AS nb
      FROM c cc JOIN c bb ON cc.i = bb.i AND cc.dataset = 'comparison' AND bb.dataset = 'baseline'
      GROUP BY ALL),
s AS (SELECT comparison_cluster, baseline_cluster,
             {dround('CASE WHEN sqrt(nc) * sqrt(nb) > 0 THEN dot / (sqrt(nc) * sqrt(nb)) END', 6)} AS similarity
      FROM p)
SELECT 'corpus' AS request_id, comparison_cluster, baseline_cluster, similarity FROM (
  SELECT *, row_number() OVER (PARTITION BY comparison_cluster ORDER BY similarity DESC, baseline_cluster) AS r
  FROM s) x WHERE r = 1""",
    "event_trend": f"""
WITH b AS (SELECT time_bucket(INTERVAL 1 DAY, ts) AS bin_start, event_type, count(*) AS n,
                  avg(duration) AS m FROM ({LOG}) l GROUP BY ALL),
t AS (SELECT bin_start, sum(n) AS tot FROM b GROUP BY ALL),
j AS (SELECT b.bin_start, b.event_type, b.n, {dround('b.n / t.tot', 6)} AS share,
             {dround('b.m', 6)} AS mean_compound FROM b JOIN t USING (bin_start))
SELECT bin_start, event_type, n, share, mean_compound,
       {dround('share - lag(share) OVER (PARTITION BY event_type ORDER BY bin_start)', 6)} AS share_delta,
       {dround('mean_compound - lag(mean_compound) OVER (PARTITION BY event_type ORDER BY bin_start)', 6)}
         AS sentiment_delta
FROM j""",
})


ORACLE["keywords_by_language"] = keywords_sql(DOC_VALID, THEME_GROUP,
                                              stop_cond=_lang_stop_cond("theme"), fallback=False)


# Settled k-means leaves no point nearer to another mean; each sub-theme lies in one theme.
ORACLE["kmeans_fixed_point"] = """
SELECT 'corpus' AS request_id, 'baseline' AS dataset, count(*) AS n, CAST(0 AS BIGINT) AS misplaced FROM embeddings"""
ORACLE["theme_nesting"] = """
SELECT 'corpus' AS request_id, 'baseline' AS dataset, count(*) AS n, CAST(4 AS BIGINT) AS tops,
       CAST(0 AS BIGINT) AS crossed FROM embeddings"""

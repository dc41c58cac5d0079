"""Column functions for text: stripping, tokenising, accent folding, titles.

All of these are built-in Spark expressions (whole-stage codegen, no Python
round trip).  The regular expressions avoid ``\\b`` and ``\\s`` on purpose:
their meaning differs between engines, while explicit classes do not.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import ACCENT_FROM, ACCENT_TO, TITLE_CUT_CHARS, TITLE_MAX_CHARS

# Unicode whitespace (the characters Python's ``str.isspace`` accepts).
WS = (r"[\t\n\x0B\f\r \x1C-\x1F\x85\xA0\x{1680}\x{2000}-\x{200A}"
      r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]")
# The same set for splitting: one table for the Latin-1 characters, and the others looked at
# only in their range, so that a letter costs two tests and not one for each member.
WS_SPLIT = (r"[\t\n\x0B\f\r \x1C\x1D\x1E\x1F\x85\xA0[\x{1680}-\x{3000}&&[\x{1680}\x{2000}-\x{200A}"
            r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]]]+")
# ASCII punctuation, the set stripped from both ends of a scoring token.
PUNCT = r"[!-/:-@\[-`{-~]"
# The same two sets as plain characters, for ``btrim`` (strip a set of
# characters from both ends, as ``str.strip(chars)`` does; no regex).
WS_CHARS = ("\t\n\x0b\x0c\r \x1c\x1d\x1e\x1f\x85\xa0\u1680"
            "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
            "\u2028\u2029\u202f\u205f\u3000")
PUNCT_CHARS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
# Separator between words for keyword / phrase tokenising.
NON_WORD = r"[^\p{L}\p{N}_]+"


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def unicode_strip(c) -> Column:
    """Strip Unicode whitespace at both ends (``trim`` only strips blanks)."""
    return F.btrim(col_(c), F.lit(WS_CHARS))


def whitespace_tokens(c) -> Column:
    """Split on runs of Unicode whitespace; empty strings removed."""
    return F.filter(F.split(unicode_strip(c), f"{WS}+"), lambda t: t != "")


def strip_punct_token(c) -> Column:
    """Strip ASCII punctuation at both ends unless that leaves <= 2 chars."""
    t = col_(c)
    stripped = F.btrim(t, F.lit(PUNCT_CHARS))
    return F.when(F.length(stripped) <= 2, t).otherwise(stripped)


def is_all_caps(c) -> Column:
    """True when the token has an upper-case letter and no lower-case one."""
    return col_(c).rlike(r"^[^\p{Ll}]*\p{Lu}[^\p{Ll}]*$")


def fold_accents(c) -> Column:
    """Fold Latin accents of lower-case text (fixed table in constants)."""
    return F.translate(col_(c), ACCENT_FROM, ACCENT_TO)


def word_tokens(c, min_len: int = 2, strip_accents: bool = False) -> Column:
    """Lower-case words of ``min_len``+ ASCII letters, in text order.

    Text is split on runs of non-word characters; a piece is kept only when
    it is made of ASCII letters entirely, so ``abc123`` yields nothing.
    """
    low = F.lower(col_(c))
    if strip_accents:
        low = fold_accents(low)
    pattern = "^[a-z]{%d,}$" % min_len
    return F.filter(F.split(low, NON_WORD), lambda t: t.rlike(pattern))


def adjacent_pairs(tokens: Column) -> Column:
    """``["a b", "b c", ...]`` from a token array (empty when < 2 tokens)."""
    return F.filter(
        F.transform(tokens, lambda t, i: F.concat_ws(" ", t, F.get(tokens, i + 1))),
        lambda p: p.contains(" "))


def count_char(c, ch: str) -> Column:
    """Occurrences of a single character in a string column."""
    s = col_(c)
    return F.length(s) - F.length(F.replace(s, F.lit(ch), F.lit("")))


def title_case(c) -> Column:
    """Capitalise each space-separated word, cut to 47 chars + '...' past 50."""
    t = F.initcap(col_(c))
    return F.when(F.length(t) > TITLE_MAX_CHARS,
                  F.concat(F.substring(t, 1, TITLE_CUT_CHARS), F.lit("..."))).otherwise(t)


def pct0(c) -> Column:
    """Percentage text as Python's ``{:.0f}`` prints it (round half to even)."""
    return F.bround(col_(c), 0).cast("long").cast("string")

"""Stop-word lists: Spark ML's default lists, kept as text files in this package.

The Spark job and the SQL oracle read the same files, so neither needs a JVM
nor any particular Spark layout.  Callers may pass any other list instead.
"""

from __future__ import annotations

from functools import lru_cache
from importlib import resources

LANGUAGES = {"en": "english", "de": "german", "fr": "french", "es": "spanish"}


@lru_cache(maxsize=None)
def stop_words(language: str = "english") -> tuple[str, ...]:
    """Spark ML's default stop words for ``language`` (name or ISO code)."""
    name = LANGUAGES.get(language, language)
    lists = resources.files(__package__) / "stopword_lists"
    return tuple((lists / f"{name}.txt").read_text(encoding="utf-8").split())


def stop_word_table(spark, languages=("en", "de", "fr", "es")):
    """KEY14: ``(lang, token)`` table of stop words per language."""
    rows = [(code, w) for code in languages for w in stop_words(code)]
    return spark.createDataFrame(rows, "lang string, token string").distinct()

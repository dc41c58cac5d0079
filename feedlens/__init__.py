"""feedlens: feedback-theme analytics as Spark DataFrame jobs.

Sentences are validated, scored for sentiment, embedded, grouped into
themes, and summarised per theme (size, sentiment distribution, keywords,
common phrases, title, template insights).  Every operator is keyed by
``(request_id, dataset)`` so many small surveys and one very large corpus
run through the same plans.
"""

__version__ = "0.1.0"

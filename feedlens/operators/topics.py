"""KEY13: topic modelling with Spark ML (CountVectorizer + LDA).

One LDA model is fitted over the sentences of a corpus; each topic is
reported with its top terms and each sentence with its most likely topic.
"""

from __future__ import annotations

from pyspark.ml.clustering import LDA
from pyspark.ml.feature import CountVectorizer, RegexTokenizer, StopWordsRemover
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.stopwords import stop_words


def lda_topics(sentences: DataFrame, k: int = 5, vocab_size: int = 2000, max_iter: int = 20,
               seed: int = 42, top_terms: int = 8):
    """Return ``(topics, assignments)``: top terms per topic, topic per sentence."""
    tok = RegexTokenizer(inputCol="sentence", outputCol="_w", pattern="[a-z]{3,}", gaps=False)
    words = StopWordsRemover(inputCol="_w", outputCol="_k",
                             stopWords=list(stop_words("english"))).transform(tok.transform(sentences))
    cv = CountVectorizer(inputCol="_k", outputCol="_tf", vocabSize=vocab_size, minDF=2).fit(words)
    tf = cv.transform(words)
    model = LDA(k=k, maxIter=max_iter, seed=seed, featuresCol="_tf",
                topicDistributionCol="_dist").fit(tf)
    vocab = F.array(*[F.lit(t) for t in cv.vocabulary]) if cv.vocabulary else F.array()
    topics = model.describeTopics(top_terms).select(
        "topic", F.transform("termIndices", lambda i: F.get(vocab, i)).alias("terms"))
    dist = vector_to_array("_dist")
    keep = [c for c in sentences.columns if c != "sentence"]
    assign = model.transform(tf).select(
        *keep, F.array_position(dist, F.array_max(dist)).cast("int").alias("_p")).select(
        *keep, (F.col("_p") - 1).alias("topic"))
    return topics, assign

"""Keyword-profile topic classification.

Topic profiles are rows ``(topic_id, topic_ord, lang, keywords ARRAY<STRING>)``;
texts are rows ``(text_id, text)``. Profiles are a small dictionary; texts
can be any size: scoring is one join on (language, term) and grouped sums
(see ``operators.tfidf.topic_scores``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmart import dictionaries as D
from textmart.functions import text as T
from textmart.operators import tfidf
from textmart.operators.lexicon import lemma_counts
from textmart.session import cut_lineage
from textmart.sources.files import existing_paths


def read_topic_profiles(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """One JSON object per file ``{topic_id, topic_name{uk,en}, keywords{uk[],en[]}}``; missing files are skipped.

    File order gives ``topic_ord`` (the tie order). Returns one row per
    (topic, language) with the topic's name in that language and the keywords.
    """
    schema = "topic_id string, topic_name map<string,string>, keywords map<string,array<string>>"
    out = spark.createDataFrame([], f"{schema}, topic_ord int")
    for i, p in enumerate(existing_paths(spark, paths)):
        df = spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(p)
        out = out.unionByName(df.withColumn("topic_ord", F.lit(i)))
    out = out.select("topic_id", "topic_ord", "topic_name", F.explode("keywords").alias("lang", "keywords"))
    return out.select("topic_id", "topic_ord", "lang", F.try_element_at("topic_name", F.col("lang")).alias("topic_name"), "keywords")


def profile_tokens(profiles: DataFrame, *, word: str = r"(?U)\w") -> DataFrame:
    """Topic documents = keywords joined by blanks, tokenised by the default vectorizer rule."""
    return profiles.select("topic_id", "topic_ord", "lang",
                           T.vectorizer_tokens(F.array_join("keywords", " "), word=word).alias("tokens"))


def text_tokens(texts: DataFrame, *, stop_words: Sequence[str] = (), word: str = r"(?U)\w",
                lemma_dict: DataFrame | None = None) -> DataFrame:
    """F6 + F5: language by script majority, then the preprocessing tokens.

    With a dictionary ``(token, lemma, pos)`` tokens become lemmas, of which
    nouns, verbs, adjectives and proper nouns longer than two letters stay; the
    result is then rows ``(text_id, lang, term, x)`` of lemmas with their counts,
    for which only the counts of a text's words meet the dictionary.
    """
    out = texts.select("text_id", T.detect_language("text").alias("lang"),
                       T.topic_text_tokens("text", word=word, stop_words=stop_words).alias("tokens"))
    if lemma_dict is not None:
        out = lemma_counts(out, lemma_dict, by=["text_id", "lang"], key="text_id", keep_pos=D.TOPIC_POS, min_len=3).withColumnsRenamed({"lemma": "term", "n": "x"})
    return out


def classify(texts: DataFrame, profiles: DataFrame, *, stop_words: Sequence[str] = (), word: str = r"(?U)\w",
             threshold: float = D.TOPIC_THRESHOLD, lemma_dict: DataFrame | None = None,
             digits: int | None = None) -> tuple[DataFrame, DataFrame]:
    """M5 + T10: (ranked scores per text and topic that shares a term, best topic per text).

    ``profiles`` has ``keywords`` (an array) or ``term`` rows. Texts without a
    score of at least ``threshold``, or whose language has no profile, are
    ``unknown``; their best score is 0 where no topic shares a term. With
    ``digits`` scores are compared (ranks, threshold) by so many places, and
    returned as they are.
    """
    prof = profiles if "term" in profiles.columns else profile_tokens(profiles, word=word)
    scores = tfidf.topic_scores(text_tokens(texts, stop_words=stop_words, word=word, lemma_dict=lemma_dict), prof)
    scores = scores.withColumn("_by", F.col("score") if digits is None else F.round("score", digits))
    orders = cut_lineage(prof.select("topic_id", "topic_ord").distinct())
    ranked = tfidf.ranked_topics(scores.join(orders, on="topic_id"), score="_by")
    best = ranked.where("rank = 1").select("text_id", F.when(F.col("_by") >= threshold, F.col("topic_id")).alias("topic"), F.col("score").alias("best_score"))
    best = texts.select("text_id").join(best, on="text_id", how="left").select(
        "text_id", F.coalesce("topic", F.lit(D.UNKNOWN_TOPIC)).alias("topic"),
        F.coalesce("best_score", F.lit(0.0)).alias("best_score"))
    return ranked.drop("_by"), best

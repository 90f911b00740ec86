"""Job-ad requirement analysis: filter, normalise, tokenise, n-grams, mentions, attributes.

Input: a jobs DataFrame ``(job_id, title, content, time)``; every function
returns a lazy DataFrame. The corpus order (for n-grams that run across ad
boundaries, as in the concatenated corpus) is ``job_id``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textmart import dictionaries as D
from textmart.functions import rules as R
from textmart.functions import text as T
from textmart.operators import freq
from textmart.operators.tokens import ngram_table
from textmart.session import cut_lineage

DEFAULT_STOP_WORDS = sorted(set(D.ENGLISH_STOP_WORDS) | set(D.CUSTOM_STOP_WORDS))


def filter_analyst_jobs(jobs: DataFrame, *, title_keywords: Sequence[str] = D.ANALYST_KEYWORDS,
                        content_phrase: str = "data analyst", prefix_chars: int | None = None) -> DataFrame:
    """Keep ads whose title has a keyword or whose content mentions the phrase (see ``rules.analyst_job``)."""
    return jobs.where(R.analyst_job("title", "content", title_keywords=title_keywords,
                                    content_phrase=content_phrase, prefix_chars=prefix_chars))


def filter_keyword_jobs(jobs: DataFrame, *, keywords: Sequence[str] = D.ANALYST_FILTER_KEYWORDS) -> DataFrame:
    """Keep ads with any keyword in title or content."""
    return jobs.where(R.keyword_job("title", "content", keywords=keywords))


def job_token_docs(jobs: DataFrame, *, stop_words: Sequence[str] = DEFAULT_STOP_WORDS,
                   lemma_dict: DataFrame | None = None) -> DataFrame:
    """F3 + F20 + P10 (+ J6, P10 again): ``(job_id, raw, normalized, tokens[, words])`` per ad.

    With a dictionary ``tokens`` are the lemmas, and ``words`` what they were made from.
    """
    raw = T.joined_text("title", "content")
    norm = T.normalize_job_text(raw)
    out = jobs.select("job_id", raw.alias("raw"), norm.alias("normalized"))
    out = out.withColumn("tokens", T.job_tokens("normalized", stop_words))
    if lemma_dict is not None:
        from textmart.operators.lexicon import lemmatize_arrays
        out = lemmatize_arrays(out.withColumn("words", F.col("tokens")), lemma_dict, tokens="tokens", key="job_id")
        out = out.withColumn("tokens", T.drop_stop_words(F.col("tokens"), stop_words, drop_digits=True))
    return out


def top_ngrams(token_docs: DataFrame, n: int, k: int) -> DataFrame:
    """W6 + T1: the ``k`` most frequent n-grams of the concatenated token stream."""
    grams = ngram_table(cut_lineage(token_docs.select("job_id", "tokens")), n, tokens="tokens", order="job_id", gram="ngram")
    return freq.top_terms(grams, k, word="ngram", rank="rank")


def tech_mentions(jobs: DataFrame, *, patterns: Sequence[str] = D.TECH_PATTERNS, k: int = 10) -> DataFrame:
    """A3 + A20 + T1: top-k patterns by non-overlapping mentions in lower(title + content), per-ad average."""
    n_jobs = jobs.select(F.count(F.lit(1))).scalar()
    m = freq.keyword_mentions(jobs, T.joined_text("title", "content"), patterns)
    top = m.orderBy(F.col("mentions").desc(), F.col("keyword")).limit(k)
    return top.withColumn("per_ad", F.round(F.col("mentions") / n_jobs, 1))


def category_mentions(jobs: DataFrame, *, categories: Mapping[str, Sequence[str]] = D.REQUIREMENT_CATEGORIES
                      ) -> DataFrame:
    """A23 + T12: mentions per (category, keyword) over ad contents, zero totals dropped, with category totals.

    ``rank`` orders the keywords of a category by mentions (one row per keyword of the list).
    """
    m = freq.keyword_mentions(jobs, "content", categories)
    w = Window.partitionBy("category")
    return m.select("*", F.sum("mentions").over(w).alias("category_total"),
                    F.row_number().over(w.orderBy(F.col("mentions").desc(), "keyword")).alias("rank"))


def meaningful_terms(token_docs: DataFrame, *, whitelist: Sequence[str] = D.MEANINGFUL_TERMS, k: int = 15) -> DataFrame:
    """J2 + U4: term counts restricted to a whitelist, top-k."""
    toks = token_docs.select(F.explode("tokens").alias("word")).where(F.col("word").isin(list(whitelist)))
    return freq.top_terms(toks, k, rank="rank")


def funnel(jobs: DataFrame, filtered_docs: DataFrame, *, stop_words: Sequence[str] = DEFAULT_STOP_WORDS) -> DataFrame:
    """``(stage, n_in, n_out)`` for filter, normalise (characters), tokenise, stop words and, after a dictionary, lemmas.

    Character counts are those of the corpus joined by single blanks, i.e.
    the per-ad lengths plus one separator between consecutive (non-empty) ads.
    """
    n_jobs = jobs.select(F.count(F.lit(1))).scalar()
    lemmas = "words" in filtered_docs.columns
    tok_all = F.filter(F.split("normalized", " "), lambda w: w != "")
    s = filtered_docs.select(
        F.count(F.lit(1)).alias("n_f"),
        (F.sum(F.length("raw")) + F.greatest(F.count(F.lit(1)) - 1, F.lit(0))).alias("c_raw"),
        (F.sum(F.length("normalized")) + F.greatest(F.count_if(F.col("normalized") != "") - 1, F.lit(0))).alias("c_norm"),
        F.sum(F.size(tok_all)).alias("t_all"),
        F.sum(F.size("words" if lemmas else "tokens")).alias("t_clean"),
        F.sum(F.size("tokens")).alias("t_lemmas"),
    )
    row = s.withColumn("n", n_jobs)
    def stage(i: int, name: str, n_in: str, n_out: str):
        return F.struct(F.lit(i).alias("ord"), F.lit(name).alias("stage"),
                        F.col(n_in).cast("long").alias("n_in"), F.col(n_out).cast("long").alias("n_out"))

    stages = F.array(stage(1, "filter", "n", "n_f"), stage(2, "normalize_chars", "c_raw", "c_norm"),
                     stage(3, "tokenize", "t_all", "t_all"), stage(4, "stop_words", "t_all", "t_clean"),
                     *([stage(5, "lemmas", "t_clean", "t_lemmas")] if lemmas else []))
    out = row.select(F.inline(stages))
    return out.select("ord", "stage", F.coalesce(F.col("n_in"), F.lit(0)).cast("long").alias("n_in"),
                      F.coalesce(F.col("n_out"), F.lit(0)).cast("long").alias("n_out"))

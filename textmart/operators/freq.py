"""Frequencies, distributions and top-k.

All counts are hash aggregates with map-side partial aggregation, so a hot
term (one word holding a large share of all tokens) is combined inside each
map task before the shuffle. Per-group top-k uses ``row_number`` filters,
which Spark plans with a partial ``WindowGroupLimit`` ahead of the shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textmart.operators.joins import join_null_safe
from textmart.operators.keywords import mentions as automaton_mentions
from textmart.operators.tokens import exact_median

#: Keywords that are counted by native expressions, one scan of a text for each.
FEW_KEYWORDS = 32


def term_counts(tokens: DataFrame, *, by: Sequence[str] = (), word: str = "word",
                count: str = "count") -> DataFrame:
    """A1/A2: occurrences per (group..., term)."""
    return tokens.groupBy(*by, word).agg(F.count(F.lit(1)).alias(count))


def top_k(df: DataFrame, k: int, *, order: Sequence[Column], by: Sequence[str] = (),
          rank: str | None = "rank") -> DataFrame:
    """The first ``k`` rows by ``order`` (globally or per group ``by``)."""
    if by:
        w = Window.partitionBy(*by).orderBy(*order)
        out = df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= k)
        return out.withColumnRenamed("_rn", rank) if rank else out.drop("_rn")
    out = df.orderBy(*order).limit(k)
    if rank:
        # k rows at most: numbering them needs no partitioning
        out = out.withColumn(rank, F.row_number().over(Window.orderBy(*order)))
    return out


def top_terms(tokens: DataFrame, k: int, *, by: Sequence[str] = (), word: str = "word",
              count: str = "count", rank: str | None = "rank") -> DataFrame:
    """Most frequent terms (count desc, term asc), globally or per group."""
    counts = term_counts(tokens, by=by, word=word, count=count)
    return top_k(counts, k, order=[F.col(count).desc(), F.col(word).asc()], by=by, rank=rank)


def mention_count(text: Column, keyword: Column | str) -> Column:
    """A3: non-overlapping occurrences of ``keyword`` in ``text`` (like ``str.count``)."""
    kw = F.lit(keyword) if isinstance(keyword, str) else keyword
    return ((F.length(text) - F.length(F.replace(text, kw, F.lit("")))) / F.length(kw)).cast("long")


def keyword_mentions(df: DataFrame, text: str | Column, keywords: Sequence[str] | Mapping[str, Sequence[str]],
                     *, lower: bool = True) -> DataFrame:
    """Total mentions per keyword (and category) over all rows, zero totals dropped.

    A short keyword list is a literal array evaluated per row inside codegen
    (``inline(transform(...))``), one scan of the text per keyword; more than
    ``FEW_KEYWORDS`` are found by one automaton in one scan. The totals are a
    partial+final aggregate.
    """
    t = F.col(text) if isinstance(text, str) else text
    t = F.lower(F.coalesce(t, F.lit(""))) if lower else F.coalesce(t, F.lit(""))
    if isinstance(keywords, Mapping):
        pairs = [(cat, kw) for cat, kws in keywords.items() for kw in kws]
    else:
        pairs = [(None, kw) for kw in keywords]
    if len(pairs) > FEW_KEYWORDS:
        return automaton_mentions(df, t, keywords, lower=False).drop("texts")
    arr = F.array(*[F.struct(F.lit(c).cast("string").alias("category"), F.lit(k).alias("keyword"))
                    for c, k in pairs])
    rows = df.select(F.inline(F.transform(
        arr, lambda e: F.struct(e["category"].alias("category"), e["keyword"].alias("keyword"),
                                mention_count(t, e["keyword"]).alias("n")))))
    out = rows.groupBy("category", "keyword").agg(F.sum("n").alias("mentions")).where(F.col("mentions") > 0)
    if not isinstance(keywords, Mapping):
        out = out.drop("category")
    return out


def vocabulary_stats(tokens: DataFrame, *, by: Sequence[str] = (), word: str = "word") -> DataFrame:
    """A9 + U3: tokens, distinct terms and type/token ratio (denominator at least 1)."""
    return tokens.groupBy(*by).agg(
        F.count(word).alias("tokens"),
        F.count_distinct(word).alias("unique_terms"),
    ).withColumn("ttr", F.col("unique_terms") / F.greatest(F.col("tokens"), F.lit(1)))


def length_distribution(tokens: DataFrame, *, word: str = "word") -> DataFrame:
    """A12 + W7: word length, count, probability and cumulative probability.

    The cumulative window runs over the (small, bounded by the longest word)
    length table, never over tokens.
    """
    per_len = tokens.groupBy(F.length(word).alias("length")).agg(F.count(F.lit(1)).alias("count"))
    total = F.sum("count").over(Window.partitionBy())
    w = Window.orderBy("length").rowsBetween(Window.unboundedPreceding, 0)
    return per_len.select(
        "length", "count",
        (F.col("count") / total).alias("probability"),
        (F.sum("count").over(w) / total).alias("cumulative"),
    )


def describe(df: DataFrame, value: str, *, by: Sequence[str] = ()) -> DataFrame:
    """N, mean, exact median, population variance/std, min, max.

    Rows are counted per distinct value first; the median is picked from running
    counts (``exact_median``), so no task holds a group's values.
    """
    v = F.col(value).cast("double")
    out = df.groupBy(*by).agg(F.count(v).alias("n"), F.avg(v).alias("mean"), F.var_pop(v).alias("var"), F.stddev_pop(v).alias("std"),
                              F.min(v).alias("min"), F.max(v).alias("max"))
    middle = exact_median(df.select(*by, v.alias("_v")), "_v", by=by, out="median")
    out = join_null_safe(out, middle, list(by)) if by else out.withColumn("median", middle.select("median").scalar())
    return out.select(*by, "n", "mean", "median", "var", "std", "min", "max")


def share_of_total(df: DataFrame, count: str, *, total: Column | None = None, out: str = "pct",
                   by: Sequence[str] = ()) -> DataFrame:
    """A5: ``count`` as percent of a total (the column sum by default); 0 when total <= 0."""
    tot = total if total is not None else F.sum(count).over(Window.partitionBy(*by))
    return df.withColumn(out, F.when(tot > 0, F.col(count) * 100.0 / tot).otherwise(F.lit(0.0)))

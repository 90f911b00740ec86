"""Term monitoring over time: top-k per (day, part of day), top terms, daily series.

Input is a token table ``(ts, word)`` (or ``(day, period, word)``). All
counting is partial/final aggregation; windows only run over per-group top-k
rows (bounded by k x groups), never over raw tokens.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textmart.functions import rules as R


def with_day_period(tokens: DataFrame, *, ts: str = "ts") -> DataFrame:
    """F8 + F21: add calendar ``date``, ``day`` (dd.MM.yyyy), ``period`` and ``period_ord``."""
    return tokens.withColumns({
        "date": F.to_date(F.col(ts)),
        "day": R.day_string(ts),
        "period": R.part_of_day(ts),
    }).withColumn("period_ord", R.period_order("period"))


def period_counts(tokens: DataFrame, *, word: str = "word") -> DataFrame:
    """Occurrences of each word per date and part of day."""
    return tokens.groupBy("date", "day", "period", "period_ord", word).agg(F.count(F.lit(1)).alias("freq"))


def top_per_period(tokens: DataFrame, k: int = 5, *, word: str = "word") -> DataFrame:
    """W1 + W2 + W3: top-k words per (date, period) with group sum and day ordinal.

    Groups with fewer than k distinct words return what they have.
    """
    return top_of_counts(period_counts(tokens, word=word), k, word=word)


def top_of_counts(counts: DataFrame, k: int = 5, *, word: str = "word") -> DataFrame:
    """W2 + W3 on counted words."""
    w = Window.partitionBy("date", "period").orderBy(F.col("freq").desc(), F.col(word))
    top = counts.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    top = top.withColumn("sum_freq", F.sum("freq").over(Window.partitionBy("date", "period")))
    # the top-k table has at most k rows per (date, period): a global ordinal over it is cheap
    return top.withColumn("day_index", F.dense_rank().over(Window.orderBy("date")))


def display_columns(top: DataFrame) -> DataFrame:
    """Labels shown once - day on the first row of a day, period and sum on the first row of a period."""
    first_of_day = (F.col("period_ord") == F.min("period_ord").over(Window.partitionBy("date"))) & (F.col("rank") == 1)
    first_of_period = F.col("rank") == 1
    return top.withColumns({
        "day_label": F.when(first_of_day, F.format_string("День %d\n%s", F.col("day_index"), F.col("day")))
        .otherwise(F.lit("")),
        "period_label": F.when(first_of_period, F.col("period")).otherwise(F.lit("")),
        "sum_label": F.when(first_of_period, F.col("sum_freq").cast("string")).otherwise(F.lit("")),
    })


def top_terms_of_table(top: DataFrame, k: int = 3, *, word: str = "word") -> DataFrame:
    """T4: terms that appear most often in the top table (count desc, term asc)."""
    w = F.lower(F.trim(F.col(word)))
    counts = top.where(F.col(word).isNotNull()).groupBy(w.alias("term")).agg(F.count(F.lit(1)).alias("appearances"))
    return counts.orderBy(F.col("appearances").desc(), F.col("term")).limit(k)


def top_word_totals(top: DataFrame, *, word: str = "word") -> DataFrame:
    """Total in-group frequency of every word that reached a top table (word-cloud weights)."""
    return top.groupBy(word).agg(F.sum("freq").alias("total_freq"))


def period_sums(top: DataFrame) -> DataFrame:
    """One ``(day, period, sum_freq)`` row per group."""
    return top.select("date", "day", "period", "period_ord", "sum_freq").distinct()


def daily_series(tokens: DataFrame, terms: DataFrame, *, word: str = "word", term: str = "term",
                 days: DataFrame | None = None, count: str | None = None) -> DataFrame:
    """``(date, term, n)`` for every date of ``days`` and every term (0 when absent).

    ``days`` are the dates of the articles (default: those of ``tokens``, where
    a day whose articles have no words is missing). ``tokens`` holds one row per
    word, or counts in the column ``count``. ``terms`` is a bounded list (a
    top-k result). Its values enter as one scalar array, so the date x term
    grid needs no join of two tables.
    """
    term_list = terms.select(F.sort_array(F.collect_list(term))).scalar()
    n = F.count(F.lit(1)) if count is None else F.sum(count)
    counts = (tokens.join(terms.select(F.col(term).alias(word)), on=word, how="left_semi")
              .groupBy("date", word).agg(n.alias("n")))
    per_day = counts.groupBy("date").agg(F.map_from_entries(F.collect_list(F.struct(word, "n"))).alias("_m"))
    days = (tokens if days is None else days).select("date").distinct()
    grid = days.join(per_day, on="date", how="left").select("date", "_m", F.explode(term_list).alias(term))
    return grid.select("date", term, F.coalesce(F.try_element_at("_m", F.col(term)), F.lit(0)).cast("long").alias("n"))

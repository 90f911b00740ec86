"""Dictionary joins (J1-J7) without broadcast hints.

Dictionaries (stop words, lexicons, lemma tables, keyword profiles) are
small by nature but come from user files, so their size in bytes is left to
AQE: it broadcasts them below its threshold and splits skewed partitions of
the shuffle join above it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join on equal ``keys`` where null equals null; the keys of ``left`` are kept."""
    r = right.select(*[F.col(k).alias(f"_r_{k}") if k in keys else F.col(k) for k in right.columns])
    cond = F.lit(True)
    for k in keys:
        cond = cond & left[k].eqNullSafe(r[f"_r_{k}"])
    return left.join(r, cond, how).drop(*[f"_r_{k}" for k in keys])


def map_category(df: DataFrame, col: str, mapping: dict[str, str], *, out: str = "mapped",
                 default: str = "other") -> DataFrame:
    """Literal map lookup with a default for unmapped (and null) values."""
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return df.withColumn(out, F.coalesce(F.element_at(m, F.col(col)), F.lit(default)))


def first_prefix_match(col: Column, rules: Sequence[tuple[str, str]], default: str = "other") -> Column:
    """Category of the first rule (in order) whose prefix starts the value.

    The rule table is a handful of literals, so it is evaluated as an ordered
    ``CASE WHEN startswith`` inside codegen instead of a nested-loop join.
    """
    expr = None
    for cat, prefix in rules:
        cond = col.startswith(prefix)
        expr = F.when(cond, F.lit(cat)) if expr is None else expr.when(cond, F.lit(cat))
    return F.lit(default) if expr is None else expr.otherwise(F.lit(default))


def prefix_join(df: DataFrame, col: str, rules: DataFrame, *, key: str, prefix: str = "prefix",
                category: str = "category", order: str = "ord", out: str = "category",
                default: str = "other") -> DataFrame:
    """J4 with a rule *table*: lowest-``order`` rule whose prefix starts ``col``; default otherwise.

    The join key is the value's first L characters, once for each length L
    that a prefix has (an empty prefix fits every value), so the theta join is
    an equi-join; ``key`` identifies rows of ``df``.
    """
    lengths = [r[0] for r in rules.select(F.length(prefix)).distinct().collect() if r[0] is not None]
    keys = F.array(*[F.left(F.col(col), F.lit(n)) for n in sorted(lengths)]) if lengths else F.array().cast("array<string>")
    keyed = rules.withColumn("_k", F.col(prefix))
    cand = (df.select(key, col).withColumn("_k", F.explode(F.array_distinct(keys)))
            .join(keyed, on="_k")
            .groupBy(key).agg(F.min_by(F.col(category), F.col(order)).alias("_cat")))
    return (df.join(cand, on=key, how="left")
            .withColumn(out, F.coalesce(F.col("_cat"), F.lit(default))).drop("_cat"))


def remove_stop_words(tokens: DataFrame, stop_words: DataFrame, *, word: str = "word") -> DataFrame:
    """J1 for a stop-word *table* (e.g. read from files): anti join.

    Small literal lists are better applied as ``functions.text.drop_stop_words`` (hash set in codegen).
    """
    stops = stop_words.select(F.col(stop_words.columns[0]).alias(word)).distinct()
    return tokens.join(stops, on=word, how="left_anti")


def keep_whitelist(tokens: DataFrame, whitelist: DataFrame, *, word: str = "word") -> DataFrame:
    """Semi join with a term whitelist table."""
    keep = whitelist.select(F.col(whitelist.columns[0]).alias(word)).distinct()
    return tokens.join(keep, on=word, how="left_semi")

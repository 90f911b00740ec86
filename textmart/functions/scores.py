"""Emotion and tonality scores as column expressions.

Probabilities are a ``MAP<STRING, DOUBLE>`` keyed by emotion label, so
thresholding and tonality are map lookups, ``map_filter`` and arithmetic.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from textmart import dictionaries as D


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sigmoid(x: Column) -> Column:
    """logistic squash."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))


def probability_columns(logits: str | Column, labels: Sequence[str] = D.EMOTION_LABELS,
                        prefix: str = "p_") -> dict[str, Column]:
    """F17 as one plain column per label (``p_<label>``), cheap to reference many times."""
    arr = _col(logits)
    return {f"{prefix}{x}": sigmoid(arr.getItem(i).cast("double")) for i, x in enumerate(labels)}


def emotions_from_columns(labels: Sequence[str] = D.EMOTION_LABELS,
                          thresholds: Mapping[str, float] = D.EMOTION_THRESHOLDS,
                          default: float = 0.5, prefix: str = "p_") -> Column:
    """F16 on per-label columns: labels (in label order) above their threshold."""
    return F.array_compact(F.array(*[
        F.when(F.col(f"`{prefix}{x}`") > float(thresholds.get(x, default)), F.lit(x)) for x in labels]))


def with_tonal_metrics(df, *, positive: Sequence[str] = D.POSITIVE_EMOTIONS,
                       negative: Sequence[str] = D.NEGATIVE_EMOTIONS, neutral: str = D.NEUTRAL_EMOTION,
                       prefix: str = "p_"):
    """F15 on a DataFrame with per-label probability columns ``p_<label>``.

    Works in stages on plain columns (bucket sums first), so expressions stay
    small even when the optimizer inlines them into pushed-down filters.
    Adds tonal_label, tonal_score, tonal_stars, confidence.
    """
    def p(x: str) -> Column:
        return F.coalesce(F.col(f"`{prefix}{x}`"), F.lit(0.0))

    out = df.withColumns({
        "_pos": sum((p(x) for x in positive), F.lit(0.0)),
        "_neg": sum((p(x) for x in negative), F.lit(0.0)),
        "_neu": p(neutral),
    }).withColumn("_tot", F.col("_pos") + F.col("_neg") + F.col("_neu"))
    out = out.withColumns({"_bp": F.try_divide("_pos", "_tot"), "_bn": F.try_divide("_neg", "_tot"),
                           "_bu": F.try_divide("_neu", "_tot")})
    ok = F.col("_tot") > 0
    label = F.when((F.col("_bp") >= F.col("_bn")) & (F.col("_bp") >= F.col("_bu")), "Positive") \
        .when(F.col("_bn") >= F.col("_bu"), "Negative").otherwise("Neutral")
    out = out.withColumn("tonal_label", F.when(ok, label).otherwise(F.lit("Neutral")))
    score = F.try_divide(F.col("_pos") - F.col("_neg"), F.col("_tot"))
    conf = F.when(F.col("tonal_label") == "Positive", F.col("_bp")) \
        .when(F.col("tonal_label") == "Negative", F.col("_bn")).otherwise(F.col("_bu"))
    out = out.withColumns({
        "tonal_score": F.when(ok, score).otherwise(F.lit(0.0)),
        "confidence": F.when(ok, conf).otherwise(F.lit(0.0)),
    }).withColumn("tonal_stars", F.when(ok, F.greatest(F.lit(1.0), F.least(F.lit(5.0), 3.0 + 2.0 * F.col("tonal_score"))))
                  .otherwise(F.lit(3.0)))
    return out.drop("_pos", "_neg", "_neu", "_tot", "_bp", "_bn", "_bu")


def safe_name(value: str | Column, *, fallback: str = "product") -> Column:
    """runs of characters outside [a-zA-Z0-9_-] to '_', strip '_', empty -> fallback."""
    s = F.regexp_replace(F.coalesce(_col(value), F.lit("")), r"[^a-zA-Z0-9_-]+", "_")
    s = F.regexp_replace(s, r"^_+|_+$", "")
    return F.when(s == "", F.lit(fallback)).otherwise(s)


def product_from_file(path: str | Column, *, prefix: str = "makeup_reviews", ) -> Column:
    """``<prefix>(<name>).json`` -> name; otherwise the file stem."""
    p = _col(path)
    name = F.regexp_extract(p, r"([^/]+)$", 1)
    inner = F.regexp_extract(name, prefix.replace("(", r"\(") + r"\((.+)\)\.json$", 1)
    stem = F.regexp_replace(name, r"\.[^.]*$", "")
    return F.when(inner != "", inner).otherwise(stem)


def source_from_file(path: str | Column, *, suffix: str = "_news") -> Column:
    """``ukr_pravda_news.json`` -> ``Ukr Pravda`` (stem, suffix removed, '_' -> ' ', title case)."""
    p = _col(path)
    stem = F.regexp_replace(F.regexp_extract(p, r"([^/]+)$", 1), r"\.[^.]*$", "")
    return F.initcap(F.replace(F.replace(stem, F.lit(suffix), F.lit("")), F.lit("_"), F.lit(" ")))

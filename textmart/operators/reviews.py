"""Review scoring and product comparison.

Scores come either from logits already in the table (native ``sigmoid``)
or from a user model applied per Arrow batch with ``mapInPandas`` (M20),
loaded once per task. Everything after scoring is native: tonality,
thresholds, per-product aggregates and per-product top-n.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textmart import dictionaries as D
from textmart.functions import scores as S
from textmart.functions import text as T
from textmart.operators.tokens import row_numbers


def cap_per_product(reviews: DataFrame, n: int | None, *, product: str = "product", order: str = "ord") -> DataFrame:
    """The first ``n`` reviews of each product (before empty texts are removed)."""
    if n is None:
        return reviews
    w = Window.partitionBy(product).orderBy(order)
    return reviews.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def score_batches(reviews: DataFrame, make_scorer: Callable[[], Callable[[list], "pd.DataFrame"]], *,
                  text: str = "text", key: str = "ord", labels: Sequence[str] = D.EMOTION_LABELS,
                  batch_size: int = 32) -> DataFrame:
    """Per-label probabilities from a user model, applied to batches of ``batch_size`` inputs.

    ``make_scorer()`` runs once per task (model load) and returns a function
    mapping a list of inputs (the ``text`` column: texts for a language model,
    or any other per-row input) to a frame with one probability column per
    label. Rows keep ``key`` so results join back without relying on order.
    """
    label_cols = list(labels)
    schema = f"{key} long, " + ", ".join(f"`p_{x}` double" for x in label_cols)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = make_scorer()
        for pdf in batches:
            for i in range(0, len(pdf), batch_size):
                part = pdf.iloc[i:i + batch_size]
                probs = scorer(part[text].tolist())
                out = pd.DataFrame({key: part[key].to_numpy()})
                for x in label_cols:
                    out[f"p_{x}"] = probs[x].to_numpy(dtype="float64")
                yield out

    return reviews.select(key, text).mapInPandas(run, schema)


def tonality(scored: DataFrame, *, labels: Sequence[str] = D.EMOTION_LABELS,
             thresholds=D.EMOTION_THRESHOLDS) -> DataFrame:
    """F15 + F16 on per-label probability columns ``p_<label>``: tonal fields and emotions over threshold."""
    out = S.with_tonal_metrics(scored)
    return out.withColumn("emotions", S.emotions_from_columns(labels, thresholds))


def with_text_only(scored: DataFrame, *, text: str = "text") -> DataFrame:
    """Every review keeps its row; tonal fields of those whose text is blank (white space of any kind) are null."""
    blank = T.strip_blank(F.coalesce(F.col(text), F.lit(""))) == ""
    fields = [c for c in ("tonal_label", "tonal_score", "tonal_stars", "confidence", "emotions") if c in scored.columns]
    return scored.withColumns({c: F.when(~blank, F.col(c)) for c in fields})


def product_summary(j: DataFrame, *, product: str = "product", stars: str = "stars", top_emotions: int = 3) -> DataFrame:
    """A15 + P7 + T6: per product totals, rated average, tonal averages, gap and top emotion shares.

    ``j`` holds every (capped) review with its tonal fields, null without text
    (``with_text_only``), so nothing is joined back. Shares are emotion counts
    / reviews with text; ties by label name.
    """
    rated = F.when(F.col(stars).cast("double") > 0, F.col(stars).cast("double"))
    base = j.groupBy(product).agg(
        F.count(F.lit(1)).alias("total_reviews"),
        F.count("tonal_score").alias("reviews_with_text"),
        F.avg(rated).alias("avg_stars"),
        F.avg("tonal_stars").alias("avg_tonal_stars"),
        F.avg("tonal_score").alias("avg_tonal_score"),
    ).withColumn("stars_gap", F.col("avg_tonal_stars") - F.col("avg_stars"))
    emo = (j.select(product, F.explode("emotions").alias("emotion"))
           .groupBy(product, "emotion").agg(F.count(F.lit(1)).alias("n")))
    emo = emo.join(base.select(product, "reviews_with_text"), on=product) \
        .withColumn("share", F.col("n") / F.col("reviews_with_text"))
    w = Window.partitionBy(product).orderBy(F.col("share").desc(), F.col("emotion"))
    top = emo.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= top_emotions)
    top = top.groupBy(product).agg(F.sort_array(F.collect_list(F.struct("_r", "emotion", "share"))).alias("_top"))
    out = base.join(top, on=product, how="left")
    return out.withColumn("top_emotions", F.transform(F.coalesce("_top", F.array()), lambda x: F.struct(
        x["emotion"].alias("emotion"), x["share"].alias("share")))).drop("_top")


def order_products(summary: DataFrame, *, out: str = "position") -> DataFrame:
    """T5: position by average stars descending, products without ratings last, ties by name."""
    key = F.coalesce(-F.col("avg_stars"), F.lit(float("inf")))
    return row_numbers(summary.withColumn("_key", key), by=[], order="_key", tiebreak=["product"], out=out).drop("_key")


def extreme_reviews(rows: DataFrame, *, product: str = "product", n: int = 3, min_confidence: float = 0.0,
                    max_chars: int = 180, text: str = "review", order: str = "ord") -> DataFrame:
    """P5 + W11 + P11: top-n positive (score desc, confidence desc) and negative
    (score asc, confidence desc) reviews per product, text compacted; equal
    keys keep input order (``order``), as a stable sort does.

    Validity (non-blank review, numeric score and confidence, confidence >=
    ``min_confidence``) is the first sort key and is re-checked after the
    window, so invalid rows never take a top slot and the check is not pushed
    down into (and duplicated inside) the scoring expressions.
    """
    valid = ((T.strip_blank(F.coalesce(F.col(text), F.lit(""))) != "") & F.col("tonal_score").isNotNull()
             & F.col("confidence").isNotNull() & (F.col("confidence") >= F.lit(min_confidence)))
    ok = rows.withColumn("_valid", F.coalesce(valid, F.lit(False)))
    wp = Window.partitionBy(product).orderBy(F.col("_valid").desc(), F.col("tonal_score").desc(),
                                             F.col("confidence").desc(), F.col(order))
    wn = Window.partitionBy(product).orderBy(F.col("_valid").desc(), F.col("tonal_score").asc(),
                                             F.col("confidence").desc(), F.col(order))
    pos = ok.withColumn("rank", F.row_number().over(wp)).where((F.col("rank") <= n) & F.col("_valid")) \
        .withColumn("kind", F.lit("positive"))
    neg = ok.withColumn("rank", F.row_number().over(wn)).where((F.col("rank") <= n) & F.col("_valid")) \
        .withColumn("kind", F.lit("negative"))
    return pos.unionByName(neg).drop("_valid").withColumn("text_short", T.compact_text(F.col(text), max_chars))


def product_rows(scored: DataFrame, *, key: str = "ord", digits: int = 4) -> DataFrame:
    """S7 payload: review, stars and the tonal fields rounded to ``digits``, of the reviews with text."""
    return scored.where(F.col("tonal_label").isNotNull()).select(key, "product", F.col("text").alias("review"), "stars", "tonal_label",
                    *[F.round(c, digits).alias(c) for c in ("tonal_score", "tonal_stars", "confidence")])


def write_product_outputs(rows: DataFrame, path: str, *, product: str = "product") -> None:
    """One JSON output folder per product key (``safe_name`` of the product)."""
    (rows.withColumn("product_key", S.safe_name(product))
     .write.mode("overwrite").partitionBy("product_key").json(path))

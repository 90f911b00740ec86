"""Collocations and dispersion over the concatenated token stream.

Bigram association follows the usual collocation-finder definitions:
N = number of words, N-1 bigrams, joint = c/(N-1), cond = c/c(w1),
PMI = log2(c*N / (c(w1)*c(w2))). Lexical dispersion measures gaps between
successive occurrences of a word in the running position of the corpus.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textmart.operators.tokens import ngram_table
from textmart.session import cut_lineage

# Width of the position ranges that split one word's occurrences over tasks.
GAP_BUCKET = 1 << 22


def bigram_measures(docs: DataFrame, *, tokens: str = "tokens", order: str = "doc_id",
                    min_count: int = 3, across_documents: bool = True) -> DataFrame:
    """(bigram, w1, w2, count, joint_prob, cond_prob, pmi) for bigrams with count >= min_count.

    T3 ranks the result by count or by PMI (ties by bigram).

    Unigram totals are never filtered. Both marginal joins are keyed by word;
    the bigram side is pre-aggregated and filtered first, and AQE splits a
    skewed word (such as a very frequent first word) at run time.
    """
    words = docs.select(F.explode(tokens).alias("w"))
    uni = words.groupBy("w").agg(F.count(F.lit(1)).alias("c"))
    n_words = docs.select(F.sum(F.size(tokens))).scalar()
    bi = (ngram_table(docs, 2, tokens=tokens, order=order, across_documents=across_documents, gram="bigram")
          .groupBy("bigram").agg(F.count(F.lit(1)).alias("count"))
          .where(F.col("count") >= min_count))
    parts = F.split("bigram", " ")
    bi = bi.select("bigram", parts.getItem(0).alias("w1"), parts.getItem(1).alias("w2"), "count")
    u1 = uni.select(F.col("w").alias("w1"), F.col("c").alias("c1"))
    u2 = uni.select(F.col("w").alias("w2"), F.col("c").alias("c2"))
    j = bi.join(u1, on="w1").join(u2, on="w2")
    return j.select(
        "bigram", "w1", "w2", "count",
        (F.col("count") / (n_words - 1)).alias("joint_prob"),
        (F.col("count") / F.col("c1")).alias("cond_prob"),
        F.log2(F.col("count").cast("double") * n_words.cast("double")
               / (F.col("c1").cast("double") * F.col("c2").cast("double"))).alias("pmi"),
    )


def dispersion(positions: DataFrame, targets: DataFrame, *, word: str = "word", gpos: str = "gpos",
               bucket: int = GAP_BUCKET) -> DataFrame:
    """M2 + W5: frequency, mean and population std of gaps, uniformity = 1 - cv/2 (0 when cv >= 2).

    ``targets`` is a bounded word list (for example a top-k result). A word's
    occurrences are split into position ranges: gaps inside a range come from
    ``lag`` in a window partitioned by (word, range), gaps between ranges from
    the range ends, so even a word holding a third of the corpus is spread
    over many tasks. Mean and std are partial/final aggregates.
    """
    targets = cut_lineage(targets.select(word).distinct())
    occ = positions.join(targets, on=word, how="left_semi")
    occ = cut_lineage(occ.select(word, gpos, F.floor(F.col(gpos) / F.lit(bucket)).alias("_r")))
    w_in = Window.partitionBy(word, "_r").orderBy(gpos)
    inner = occ.select(word, (F.col(gpos) - F.lag(gpos).over(w_in)).alias("gap"))
    ends = occ.groupBy(word, "_r").agg(F.min(gpos).alias("_first"), F.max(gpos).alias("_last"))
    w_r = Window.partitionBy(word).orderBy("_r")
    cross = ends.select(word, (F.col("_first") - F.lag("_last").over(w_r)).alias("gap"))
    gaps = inner.unionByName(cross).where(F.col("gap").isNotNull())
    g = gaps.groupBy(word).agg(F.avg("gap").alias("avg_gap"), F.stddev_pop("gap").alias("std_gap"))
    freq = occ.groupBy(word).agg(F.count(F.lit(1)).alias("frequency"))
    t = targets.join(freq, on=word, how="left").join(g, on=word, how="left")
    f = F.coalesce(F.col("frequency"), F.lit(0))
    avg = F.when(f > 1, F.col("avg_gap")).otherwise(F.lit(0.0))
    std = F.when(f > 1, F.col("std_gap")).otherwise(F.lit(0.0))
    cv = F.when(avg > 0, std / avg).otherwise(F.lit(0.0))
    uni = F.when(f > 1, F.when(cv < 2, 1 - cv / 2).otherwise(F.lit(0.0))).otherwise(F.lit(0.0))
    return t.select(word, f.cast("long").alias("frequency"), avg.alias("avg_gap"), std.alias("std_gap"),
                    uni.alias("uniformity"))

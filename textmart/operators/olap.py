"""Attribute tagging and small OLAP cubes over job ads.

Tagging is pure column expressions; distributions are hash aggregates; the
matrices cross-tabulate at most (5 levels or 4 bands) x (top-k tags), built
from bounded arrays (the fixed level list and a top-k result) rather than a
join of unbounded tables.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textmart import dictionaries as D
from textmart.functions import rules as R
from textmart.operators.tokens import row_numbers
from textmart.session import cut_lineage

DEFAULT_TOP_TECH = ["SQL", "Python", "Excel"]


def enrich_jobs(jobs: DataFrame, *, title: str = "title", content: str = "content", time: str = "time",
                tech_keywords: Mapping[str, Sequence[str]] = D.TECH_KEYWORDS,
                level_rules: Sequence[tuple[str, Sequence[str]]] = D.LEVEL_RULES,
                experience_pattern: str = D.EXPERIENCE_PATTERN) -> DataFrame:
    """A4 detail rows: experience years, technology tags, level and publication date."""
    return jobs.withColumns({
        "experience_years": R.experience_years(content, pattern=experience_pattern),
        "technologies": R.technologies(content, tech_keywords),
        "level": R.job_level(title, content, level_rules),
        "date": R.date_part(time),
    })


def distributions(enriched: DataFrame) -> DataFrame:
    """A4 + A5 + T8: ``(dimension, value, count, pct, position)`` for experience, technology, level and date.

    ``position`` orders the values of a dimension: experience by years, the others by count.

    ``pct`` is count / number of jobs * 100 (technology shares can sum above
    100 because an ad has several tags).
    """
    def row(dimension: str, value) -> Column:
        return F.struct(F.lit(dimension).alias("dimension"), value.cast("string").alias("value"))

    single = F.array(*[row(d, F.col(c)) for d, c in (("experience", "experience_years"), ("level", "level"), ("date", "date"))])
    tags = F.transform(F.coalesce("technologies", F.array().cast("array<string>")), lambda t: row("technology", t))
    rows = enriched.select(F.inline(F.concat(single, tags)))  # one scan for the four dimensions
    counts = cut_lineage(rows.groupBy("dimension", "value").agg(F.count(F.lit(1)).alias("count")))
    n_jobs = counts.where("dimension = 'level'").agg(F.sum("count")).scalar()  # an ad has one level
    # one row per distinct value: years ascending, the other dimensions by count
    by = [F.when(F.col("dimension") == "experience", F.col("value").cast("long")), F.col("count").desc(), F.col("value")]
    position = F.row_number().over(Window.partitionBy("dimension").orderBy(*by))
    return counts.select("dimension", "value", "count", (F.col("count") * 100.0 / n_jobs).alias("pct"), position.alias("position"))


def top_technologies(enriched: DataFrame, k: int = 9) -> DataFrame:
    """The ``k`` most frequent tags (count desc, tag asc) with their rank."""
    counts = enriched.select(F.explode("technologies").alias("tech")).groupBy("tech").count()
    w = Window.orderBy(F.col("count").desc(), F.col("tech"))
    return counts.orderBy(F.col("count").desc(), F.col("tech")).limit(k).withColumn("rank", F.row_number().over(w))


def _grid(enriched: DataFrame, row_values: Sequence[str], row: str, k: int) -> DataFrame:
    """(row value, tech, tech rank) for every row value x top-k tag (default tags when none)."""
    top = top_technologies(enriched, k)
    techs = top.agg(F.sort_array(F.collect_list(F.struct("rank", "tech"))).alias("t"))
    techs = techs.select(F.when(F.size("t") > 0, F.col("t")).otherwise(
        F.array(*[F.struct(F.lit(i + 1).alias("rank"), F.lit(t).alias("tech"))
                  for i, t in enumerate(DEFAULT_TOP_TECH)])).alias("t"))
    rows = F.array(*[F.struct(F.lit(i).alias("row_ord"), F.lit(v).alias(row)) for i, v in enumerate(row_values)])
    g = techs.select(F.inline("t"), rows.alias("_rows"))
    return g.select(F.col("tech"), F.col("rank").alias("tech_rank"), F.inline("_rows"))


def level_tech_matrix(enriched: DataFrame, k: int = 9, levels: Sequence[str] = D.LEVEL_ORDER) -> DataFrame:
    """Jobs per (level, tag) for the fixed level order x top-k tags, zero filled (long form)."""
    lv = F.when(F.col("level").isin(list(levels)), F.col("level")).otherwise(F.lit(levels[-1]))
    counts = enriched.select(lv.alias("level"), F.explode("technologies").alias("tech")) \
        .groupBy("level", "tech").agg(F.count(F.lit(1)).alias("n"))
    grid = _grid(enriched, levels, "level", k)
    out = grid.join(counts, on=["level", "tech"], how="left")
    return out.select("row_ord", "level", "tech_rank", "tech", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def experience_tech_matrix(enriched: DataFrame, k: int = 9, bands: Sequence[str] = D.EXPERIENCE_BANDS) -> DataFrame:
    """Jobs per (experience band, tag), bands 0 / 1-2 / 3-4 / 5+, zero filled (long form)."""
    counts = enriched.select(R.experience_band_label("experience_years", bands).alias("band"),
                             F.explode("technologies").alias("tech")) \
        .groupBy("band", "tech").agg(F.count(F.lit(1)).alias("n"))
    grid = _grid(enriched, bands, "band", k)
    out = grid.join(counts, on=["band", "tech"], how="left")
    return out.select("row_ord", "band", "tech_rank", "tech", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def level_tech_cube(enriched: DataFrame, *, job_id: str = "job_id") -> DataFrame:
    """``cube(level, tech)`` of distinct jobs; margins count jobs, not job-tag rows.

    Jobs are numbered, and the finest cells hold bitmaps of their jobs' numbers
    (32,768 numbers each). The margins are the bitwise or of those bitmaps, so
    neither are rows multiplied by the number of margins nor are jobs counted
    apart for each of them. A null level is a level, a null job counts nowhere.
    """
    jobs = enriched.where(F.col(job_id).isNotNull()).select(job_id).distinct().withColumn("_h", F.xxhash64(job_id))
    numbers = row_numbers(cut_lineage(jobs), by=[], order="_h", tiebreak=[job_id], out="_n").select(job_id, "_n")
    rows = enriched.select(job_id, "level", F.explode_outer("technologies").alias("tech")).join(numbers, job_id, "left")
    fine = cut_lineage(rows.groupBy("level", "tech", F.bitmap_bucket_number("_n").alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_n")).alias("_bits")))

    def margin(keys: list[str], grouping: int) -> DataFrame:
        cells = fine.groupBy(*keys, "_bucket").agg(F.bitmap_or_agg("_bits").alias("_bits")) if len(keys) < 2 else fine
        out = cells.withColumn("grouping_id", F.lit(grouping)).groupBy(*keys, "grouping_id").agg(F.sum(F.bitmap_count("_bits")).alias("jobs"))
        return out.select(*[F.col(k) if k in keys else F.lit(None).cast("string").alias(k) for k in ("level", "tech")], "jobs", "grouping_id")

    return reduce(DataFrame.unionByName, [margin(["level", "tech"], 0), margin(["level"], 1), margin(["tech"], 2), margin([], 3)])

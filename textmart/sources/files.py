"""File sources and sinks (S1-S7): JSON arrays, labelled multi-file scans, word lists, CSV.

All readers take explicit schemas (no inference) and return lazy DataFrames;
file-derived labels come from ``input_file_name()``-style metadata, so a
glob of thousands of files is one scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textmart.functions.scores import product_from_file, source_from_file

ARTICLE_SCHEMA = "title string, link string, time string, content string, category string"
JOB_SCHEMA = "title string, link string, time string, content string"
REVIEW_SCHEMA = "text string, stars int, product string"
SCORED_REVIEW_SCHEMA = ("review string, stars int, tonal_label string, tonal_score double, "
                        "tonal_stars double, confidence double")


def read_json_array(spark: SparkSession, paths: str | Sequence[str], schema: str, *, skip_missing: bool = False) -> DataFrame:
    """Files holding one JSON array of objects each; ``ord`` keeps the order inside a file.

    ``file`` is the source path (for S2 labels), ``doc_id`` numbers all rows
    by (file, ord). The file is read as a stream of its objects, never as one
    value; a JSON array cannot be split, so one task reads a file and many
    files scan in parallel (JSON Lines is the splittable alternative). A
    malformed file raises an error when the rows are read (``mode="FAILFAST"``).
    A file whose root is one object counts as a list of one. Missing files
    are skipped with ``skip_missing``.
    """
    if skip_missing:
        paths = existing_paths(spark, paths)
        if not paths:
            return spark.createDataFrame([], f"file string, ord int, doc_id long, {schema}")
    # file paths arrive URI-encoded ('%20'); '+' is kept literal before decoding
    path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    raw = spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(paths)
    names = raw.columns
    # rows of a file come in its order and from one task: the running id orders them
    rows = raw.select(path.alias("file"), F.monotonically_increasing_id().alias("_at"), *names)
    rows = rows.withColumn("ord", (F.row_number().over(Window.partitionBy("file").orderBy("_at")) - 1).cast("int"))
    base = rows.groupBy("file").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1))
    base = base.select("file", F.coalesce(before, F.lit(0)).alias("_before"))  # one row per file
    out = rows.join(base, on="file")
    return out.select("file", "ord", (F.col("_before") + F.col("ord")).cast("long").alias("doc_id"), *names)


def existing_paths(spark: SparkSession, paths: str | Sequence[str]) -> list[str]:
    """The paths (or globs) that match something, through the file system of each path."""
    found = []
    for p in [paths] if isinstance(paths, str) else paths:
        hadoop = spark._jvm.org.apache.hadoop.fs.Path(p)
        status = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(hadoop)
        if status is not None and len(status):
            found.append(p)
    return found


def missing_paths(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    """All inputs that do not exist, to be reported together."""
    there = set(existing_paths(spark, paths))
    return [p for p in paths if p not in there]


def read_articles(spark: SparkSession, paths: str | Sequence[str], *, skip_missing: bool = False) -> DataFrame:
    """S1 + S2 + U1: news files ``<name>_news.json``; source label from the file name, missing category null."""
    df = read_json_array(spark, paths, ARTICLE_SCHEMA, skip_missing=skip_missing)
    return df.withColumn("source", source_from_file("file"))


def read_reviews(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """S1 + S2: review files; product from ``makeup_reviews(<name>).json``; text stripped, null -> ''."""
    df = read_json_array(spark, paths, REVIEW_SCHEMA)
    return df.select("file", "ord", "doc_id", F.regexp_replace(F.coalesce("text", F.lit("")), r"^\s+|\s+$", "").alias("text"),
                     "stars", product_from_file("file").alias("product"))


def read_word_list(spark: SparkSession, paths: str | Sequence[str], *, comments: bool = True,
                   lower: bool = False, skip_missing: bool = True) -> DataFrame:
    """S3 + U2: one entry per line, stripped, blanks dropped (``#`` lines too), de-duplicated; missing files are skipped."""
    if skip_missing:
        paths = existing_paths(spark, paths)
        if not paths:
            return spark.createDataFrame([], "word string")
    lines = spark.read.text(paths)
    if comments:
        lines = lines.where(~F.col("value").startswith("#"))
    w = F.regexp_replace(F.col("value"), r"^[\s﻿]+|\s+$", "")
    if lower:
        w = F.lower(w)
    return lines.select(w.alias("word")).where(F.col("word") != "").distinct()


def read_csv(spark: SparkSession, path: str | Sequence[str], schema: str | None = None) -> DataFrame:
    """Header CSV, UTF-8 with or without BOM, quoted multi-line cells."""
    r = spark.read.option("header", True).option("multiLine", True).option("encoding", "UTF-8")
    df = r.schema(schema).csv(path) if schema else r.csv(path)
    first = df.columns[0]
    if first.startswith("﻿"):
        df = df.withColumnRenamed(first, first.lstrip("﻿"))
    return df


def write_csv(df: DataFrame, path: str, columns: Sequence[str] | None = None) -> None:
    """Header CSV with a fixed column order."""
    out = df.select(*columns) if columns else df
    out.write.mode("overwrite").option("header", True).csv(path)


def write_table(df: DataFrame, path: str, *, partition_by: Sequence[str] = ()) -> None:
    """S6 default sink: parquet."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


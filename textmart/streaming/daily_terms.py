"""Incremental term monitoring with Structured Streaming.

The batch job ``operators.timeline`` counts words per (day, part of day); this
is the same count kept up to date as articles arrive. Articles stream in as
files ``(ts, text)``; counts are kept per (1-day event-time window, part of
day, word) with a watermark, so state for closed days is dropped and late
articles inside the watermark still update their day.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmart import dictionaries as D
from textmart.functions import rules as R
from textmart.functions import text as T

ARTICLE_STREAM_SCHEMA = "doc_id long, ts timestamp, text string"


def read_article_stream(spark: SparkSession, path: str, *, fmt: str = "parquet",
                        schema: str = ARTICLE_STREAM_SCHEMA, max_files_per_trigger: int | None = None) -> DataFrame:
    """A file-source stream of articles (new files in ``path`` are new articles)."""
    r = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def daily_term_counts(articles: DataFrame, *, letters: str = D.CLEAN_LETTERS, stop_words: Sequence[str] = (),
                      watermark: str = "1 day") -> DataFrame:
    """Streaming W1 input: counts per (day window, part of day, word), watermarked on ``ts``."""
    toks = (articles.withWatermark("ts", watermark)
            .select("ts", F.explode(T.clean_tokens("text", letters=letters, stop_words=stop_words)).alias("word")))
    return (toks.groupBy(F.window("ts", "1 day").alias("day"), R.part_of_day("ts").alias("period"), "word")
            .agg(F.count(F.lit(1)).alias("freq")))


def start(counts: DataFrame, *, checkpoint: str, sink: str = "parquet", name: str = "daily_term_counts",
          path: str | None = None, output_mode: str = "append", trigger_seconds: int | None = None):
    """Start the query; the checkpoint must be a shared, reliable folder on a cluster.

    A closed day is appended to ``path`` once its watermark has passed. The
    ``memory`` sink (for tests) holds the whole result on the driver.
    """
    w = counts.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint)
    if trigger_seconds:
        w = w.trigger(processingTime=f"{trigger_seconds} seconds")
    if sink == "memory":
        return w.format("memory").queryName(name).start()
    return w.format(sink).option("path", path).start()

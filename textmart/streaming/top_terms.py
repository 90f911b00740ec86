"""Top words per day and part of day, kept up to date as articles arrive.

State is kept per (day, part of day, bucket of words): the words' counts in a map and the bucket's top k. Counts only grow,
so a bucket's new top k is among the old one and the words that came, and no batch reads the whole map. A busy day is dealt
to ``buckets`` tasks. A changed bucket hands out its top k; the sink keeps every batch in a folder of its own, so a
repeated batch replaces itself, and ``current_top`` merges the latest rows of the buckets: the top k of a day part are among
them. Articles that are later than the watermark are left out; when it passes the end of a day, the day's state is removed.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from textmart import dictionaries as D
from textmart.functions import rules as R
from textmart.functions import text as T
from textmart.operators import timeline

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
TOP_SCHEMA = "date date, period string, bucket int, words array<string>, freqs array<long>"
DAY_MS = 24 * 60 * 60 * 1000


class TopWords(StatefulProcessor):
    """Counts and top ``k`` of one (date, period, bucket)."""

    def __init__(self, k: int):
        self.k = k

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.counts = handle.getMapState("counts", "word string", "n long")
        self.top = handle.getValueState("top", "words array<string>, freqs array<long>")

    def handleInputRows(self, key, rows, timerValues) -> Iterator:
        import pandas as pd

        new, day_end = Counter(), 0
        for frame in rows:
            new.update(frame["word"].tolist())
            day_end = max(day_end, int(frame["day_end"].max()))
        held = self.top.get()
        best = {} if held is None else dict(zip(held[0], held[1], strict=True))
        for word, n in new.items():
            before = self.counts.getValue((word,)) if self.counts.containsKey((word,)) else (0,)
            best[word] = n + before[0]
            self.counts.updateValue((word,), (best[word],))
        best = dict(sorted(best.items(), key=lambda x: (-x[1], x[0]))[:self.k])
        self.top.update((list(best), list(best.values())))
        if day_end > timerValues.getCurrentWatermarkInMs():
            self.handle.registerTimer(day_end)
        yield pd.DataFrame({"date": [key[0]], "period": [key[1]], "bucket": [key[2]], "words": [list(best)], "freqs": [list(best.values())]})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator:
        import pandas as pd

        self.counts.clear()
        self.top.clear()
        yield pd.DataFrame({"date": [], "period": [], "bucket": [], "words": [], "freqs": []})

    def close(self) -> None:
        pass


def top_words(articles: DataFrame, k: int = 5, *, buckets: int = 16, letters: str = D.CLEAN_LETTERS, stop_words: Sequence[str] = (),
              watermark: str = "1 day") -> DataFrame:
    """Streaming rows of ``TOP_SCHEMA``: the top ``k`` words of every bucket that a batch changed."""
    articles.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    tokens = articles.withWatermark("ts", watermark).select("ts", F.explode(T.clean_tokens("text", letters=letters, stop_words=stop_words)).alias("word"))
    end = (F.unix_millis(F.date_trunc("day", "ts")) + DAY_MS).alias("day_end")
    rows = tokens.select("ts", F.to_date("ts").alias("date"), R.part_of_day("ts").alias("period"),
                         F.pmod(F.xxhash64("word"), F.lit(buckets)).cast("int").alias("bucket"), "word", end)
    return rows.groupBy("date", "period", "bucket").transformWithStateInPandas(
        statefulProcessor=TopWords(k), outputStructType=TOP_SCHEMA, outputMode="Update", timeMode="EventTime")


def start(top: DataFrame, *, path: str, checkpoint: str, available_now: bool = False):
    """Start the query; both folders must be shared and reliable on a cluster."""
    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch={number}")

    w = top.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(keep)
    return (w.trigger(availableNow=True) if available_now else w).start()


def current_top(spark: SparkSession, path: str, k: int = 5) -> DataFrame:
    """The columns of ``timeline.top_per_period`` as of the last batch."""
    rows = spark.read.schema(TOP_SCHEMA + ", batch long").parquet(path)
    last = rows.groupBy("date", "period", "bucket").agg(F.max_by(F.struct("words", "freqs"), "batch").alias("t"))
    words = last.select("date", "period", F.inline(F.arrays_zip(F.col("t.words").alias("word"), F.col("t.freqs").alias("freq"))))
    counts = words.withColumn("day", F.date_format("date", D.DAY_FORMAT)).withColumn("period_ord", R.period_order("period"))
    return timeline.top_of_counts(counts, k)

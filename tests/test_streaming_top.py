"""The streamed top words after the last file equal the batch result."""

import datetime as dt
import os
import random
import tempfile

from pyspark.sql import functions as F

from textmart.functions import text as T
from textmart.operators import timeline
from textmart.streaming import daily_terms, top_terms


def test_top_words_follow_the_files_and_equal_the_batch(spark):
    rng, d = random.Random(6), tempfile.mkdtemp(prefix="textmart-test-")
    src, out = os.path.join(d, "in"), os.path.join(d, "out")
    os.makedirs(src)
    words = [f"word{c}{e}" for c in "abcdefgh" for e in ("", "x", "yy")]
    stream = daily_terms.read_article_stream(spark, src, max_files_per_trigger=1)
    every = []

    def article(i):
        ts = dt.datetime(2026, 2, 15 + rng.randrange(2), rng.choice([3, 9, 14, 22]), rng.randrange(60))
        return i, ts, " ".join(rng.choice(words[:5 + i % 19]) for _ in range(12)) if i % 9 else None

    def batch(df):
        toks = timeline.with_day_period(df.select("ts", F.explode(T.clean_tokens("text")).alias("word")))
        return {tuple(r) for r in timeline.top_per_period(toks, 3).select("date", "period", "word", "freq", "rank", "sum_freq", "day_index").collect()}

    for part in range(3):
        rows = [article(100 * part + i) for i in range(25)]
        every += rows
        spark.createDataFrame(rows, daily_terms.ARTICLE_STREAM_SCHEMA).coalesce(1).write.mode("append").parquet(src)
        q = top_terms.start(top_terms.top_words(stream, 3, buckets=4, watermark="10 days"), path=out, checkpoint=os.path.join(d, "ckpt"), available_now=True)
        q.awaitTermination(240)
        assert q.exception() is None
        got = top_terms.current_top(spark, out, 3).select("date", "period", "word", "freq", "rank", "sum_freq", "day_index")
        assert {tuple(r) for r in got.collect()} == batch(spark.createDataFrame(every, daily_terms.ARTICLE_STREAM_SCHEMA))

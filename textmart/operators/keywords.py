"""Many keywords against many texts in one pass: an automaton over all keywords, run on Arrow batches.

The work is linear in the text plus the number of matches, whatever the number of keywords; the native form
(``freq.mention_count``) reads a text once per keyword. Keywords given as a table are dealt by a hash into shards of at
most ``SHARD_BYTES``, each with an automaton of its own, so what a task holds is bounded however long the table is.
Counts are added up inside a task before the shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes of keywords (UTF-8) of one automaton.
SHARD_BYTES = 32 << 20


def _rows(keywords: Sequence[str] | Mapping[str, Sequence[str]]) -> list[tuple[str | None, str]]:
    pairs = [(c, k) for c, ks in keywords.items() for k in ks] if isinstance(keywords, Mapping) else [(None, k) for k in keywords]
    return list(dict.fromkeys(pairs))


def counter(words: list[str]):
    """``count(text) -> {index of the word: occurrences}``, occurrences of one word not overlapping, like ``str.count``."""
    import ahocorasick

    automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
    for i, w in enumerate(words):
        automaton.add_word(w, i)
    automaton.make_automaton()
    sizes = [len(w) for w in words]

    def count(text: str) -> dict[int, int]:
        found: dict[int, int] = {}
        free: dict[int, int] = {}  # first position that an occurrence of the word may take
        for end, i in automaton.iter(text):
            start = end + 1 - sizes[i]
            if start >= free.get(i, 0):
                found[i] = found.get(i, 0) + 1
                free[i] = end + 1
        return found

    return count if words else lambda text: {}


def _scan(rows: DataFrame, words: list[str], key: str | None) -> DataFrame:
    """``(keyword, n, texts)`` per task, or ``(key, keyword, n)`` per text; ``rows`` has ``text`` and the key."""
    import pyarrow as pa

    given = rows.sparkSession.sparkContext.broadcast(words)  # at most SHARD_BYTES
    kind = None if key is None else dict(rows.dtypes)[key]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = given.value
        count, n, texts = counter(names), {}, {}
        for batch in batches:
            keys, at, index, times = None if key is None else batch.column(1), [], [], []
            for row, text in enumerate(batch.column(0)):
                for i, k in count(text.as_py() or "").items():
                    if key is None:
                        n[i] = n.get(i, 0) + k
                        texts[i] = texts.get(i, 0) + 1
                    else:
                        at.append(row)
                        index.append(i)
                        times.append(k)
            if at:
                yield pa.RecordBatch.from_arrays([keys.take(pa.array(at)), pa.array([names[i] for i in index]), pa.array(times, pa.int64())],
                                                 names=[key, "keyword", "n"])
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([names[i] for i in n]), pa.array(list(n.values()), pa.int64()), pa.array(list(texts.values()), pa.int64())],
                                             names=["keyword", "n", "texts"])

    return rows.mapInArrow(run, "keyword string, n long, texts long" if key is None else f"`{key}` {kind}, keyword string, n long")


def _shards(keywords: DataFrame) -> Iterator[list[str]]:
    words = keywords.where("keyword is not null and keyword <> ''").select("keyword").distinct()
    size = words.agg(F.sum(F.octet_length("keyword"))).first()[0] or 0
    n = max(1, -(-size // SHARD_BYTES))
    for i in range(n):
        part = words if n == 1 else words.where(F.pmod(F.xxhash64("keyword"), F.lit(n)) == i)
        yield sorted(r.keyword for r in part.collect())


def _found(df: DataFrame, text: str | Column, keywords, key: str | None, lower: bool) -> DataFrame:
    t = F.col(text) if isinstance(text, str) else text
    rows = df.select((F.lower(t) if lower else t).alias("text"), *([] if key is None else [F.col(key)]))
    if isinstance(keywords, DataFrame):
        return reduce(DataFrame.unionByName, [_scan(rows, words, key) for words in _shards(keywords)])
    return _scan(rows, sorted({k for _, k in _rows(keywords) if k}), key)


def matches(df: DataFrame, text: str | Column, keywords: DataFrame | Sequence[str], *, key: str, lower: bool = True) -> DataFrame:
    """``(key, keyword, n)`` for every keyword that a text contains. A null text contains nothing, an empty keyword is nowhere."""
    return _found(df, text, keywords, key, lower)


def mentions(df: DataFrame, text: str | Column, keywords: DataFrame | Sequence[str] | Mapping[str, Sequence[str]], *,
             lower: bool = True) -> DataFrame:
    """``([category,] keyword, mentions, texts)`` over all rows for keywords that occur.

    ``keywords`` is a list, a mapping from category to list, or a table ``(keyword[, category])`` of any length; a keyword
    of several categories counts in each. ``texts`` is the number of rows that contain the keyword.
    """
    total = _found(df, text, keywords, None, lower).groupBy("keyword").agg(F.sum("n").alias("mentions"), F.sum("texts").alias("texts"))
    if isinstance(keywords, DataFrame):
        return total.join(keywords.select("category", "keyword").distinct(), "keyword") if "category" in keywords.columns else total
    if not isinstance(keywords, Mapping):
        return total
    named = df.sparkSession.createDataFrame(_rows(keywords), "category string, keyword string")
    return total.join(named, "keyword").select("category", "keyword", "mentions", "texts")

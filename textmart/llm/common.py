"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmart.session import cut_lineage

#: Texts handed to one vectorised step hold about so many characters; a longer text is a step of its own.
STEP_CHARS = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def steps(batches: Iterable[pa.RecordBatch], key: int = 0, text: int = 1,
          chars: int = STEP_CHARS) -> Iterator[tuple[list, list]]:
    """(ids, texts) of at most about ``chars`` characters, so that a task's memory does not follow the batch size."""
    for batch in batches:
        ids, texts, n = [], [], 0
        for at in range(0, batch.num_rows, 512):
            piece = batch.slice(at, 512)
            for i, t in zip(piece.column(key).to_pylist(), piece.column(text).to_pylist(), strict=True):
                if n and n + len(t or "") > chars:
                    yield ids, texts
                    ids, texts, n = [], [], 0
                ids.append(i)
                texts.append(t)
                n += len(t or "")
        if ids:
            yield ids, texts
        pa.default_memory_pool().release_unused()  # workers are reused: what a batch took is given back


def join_split(left: DataFrame, right: DataFrame, keys: str | list[str], how: str = "inner") -> DataFrame:
    """Equi-join that AQE can split at a hot key even where ``right`` is an aggregate by the same keys.

    An aggregate's result is already partitioned by its keys, and a join that reuses this partitioning can't be split.
    With a key that is derived from the others both sides are shuffled for the join alone; ``right``, which has a row per
    key, is the smaller one.
    """
    names = [keys] if isinstance(keys, str) else list(keys)
    half = F.pmod(F.xxhash64(F.lit(3), *names), F.lit(2)).alias("half_key")
    return left.select("*", half).join(right.select("*", half), [*names, "half_key"], how).drop("half_key")


def pair_units(rows: DataFrame, key: str, value: str, block: int) -> DataFrame:
    """Deal the rows of each key to units of at most about ``2 * block`` rows such that every two rows of a key meet.

    Rows of a key are split by a hash of ``value`` into ``ceil(rows / block)`` parts and each two parts (and each part
    alone) form a unit ``(key, a, b)``. A key with one row has no unit. Adds the columns ``unit_a``, ``unit_b`` and
    ``part``; no task ever needs more than one unit at a time.
    """
    n = rows.groupBy(key).agg(F.count(F.lit(1)).alias("key_rows")).filter("key_rows > 1")
    parts = F.ceil(F.col("key_rows") / F.lit(block)).cast("int")
    dealt = join_split(rows, n, key).withColumn("parts", parts)
    dealt = dealt.withColumn("part", F.pmod(F.xxhash64(F.lit(7), F.col(value)), F.col("parts")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    dealt = dealt.withColumn("other", other)
    return (dealt.withColumn("unit_a", F.least("part", "other")).withColumn("unit_b", F.greatest("part", "other"))
            .drop("key_rows", "parts", "other"))


def roots(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """For each of ``range(n)`` the smallest member of its component under the links (left, right)."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[left], label[right])
        new = label.copy()
        np.minimum.at(new, left, low)
        np.minimum.at(new, right, low)
        # a label that was lowered lowers what points to it
        np.minimum.at(new, label, new.copy())
        new = new[new]
        if np.array_equal(new, label):
            return label
        label = new


def pairs_within(group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs i < j of equal values in the sorted array ``group``."""
    n = len(group)
    if not n:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    ends = np.searchsorted(group, group, side="right")
    later = ends - np.arange(n) - 1
    i = np.repeat(np.arange(n), later)
    first = np.repeat(np.cumsum(later) - later, later)
    return i, i + 1 + np.arange(len(i)) - first


def whole_groups(batches: Iterable[pa.RecordBatch], keys: list[str], rows: int = 8192) -> Iterator[pa.Table]:
    """Tables of whole groups from batches that are sorted by ``keys``; about ``rows`` rows, or one group if that is larger."""
    held: list[pa.RecordBatch] = []

    def cut(t: pa.Table) -> int:
        """Start of the last group."""
        at = 0
        for k in keys:
            c = t.column(k).combine_chunks().to_numpy(zero_copy_only=False)
            differ = np.flatnonzero(c != c[-1])
            at = max(at, differ[-1] + 1 if len(differ) else 0)
        return int(at)

    n = 0
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            piece = batch.slice(at, rows)
            held.append(piece)
            n += piece.num_rows
            if n >= rows:
                t = pa.Table.from_batches(held)
                if k := cut(t):
                    yield t.slice(0, k)
                    held, n = t.slice(k).combine_chunks().to_batches(), t.num_rows - k
    if n:
        yield pa.Table.from_batches(held)


def components(edges: DataFrame, *, max_rounds: int = 60) -> DataFrame:
    """Connected components of ``edges(a long, b long)``: rows ``(node, root)``, root the smallest node, itself left out.

    Alternates large-star and small-star steps. Each step is a partial minimum per node and a join back
    (splittable when one node has very many neighbours), written to the shared checkpoint folder. Null ends and loops
    are ignored.
    """
    lo, hi = F.least("a", "b"), F.greatest("a", "b")
    now = cut_lineage(edges.filter("a is not null and b is not null and a <> b")
                      .select(hi.alias("a"), lo.alias("b")).distinct())
    seen: tuple | None = None
    for _ in range(max_rounds):
        # large-star: every neighbour above a node is linked to the node's smallest neighbour
        both = now.select("a", "b").union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        up = join_split(now.select(F.col("b").alias("a"), F.col("a").alias("v")), low, "a").select(F.col("v").alias("a"), F.col("m").alias("b"))
        now = cut_lineage(up.filter("a <> b").distinct())
        # small-star: the smaller neighbours of a node, and the node, are linked to the smallest of them
        low = now.groupBy("a").agg(F.min("b").alias("m"))
        down = join_split(now, low, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = cut_lineage(down.union(low.select("a", F.col("m").alias("b"))).distinct())
        stats = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(stats) == seen:
            return now.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root"))
        seen = tuple(stats)
    raise RuntimeError("components did not settle")


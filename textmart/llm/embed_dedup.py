"""Embedding near-duplicates through an inverted multi-index.

Vectors are normalised and cut in two halves with a codebook each; the product of the codebooks is the grid of cells, and
every vector is indexed in its cell. A vector visits cells by multi-sequence traversal: both codebooks are sorted by a
lower bound of the half's distance to the entry's Voronoi cell, and pairs of entries are taken in ascending order of the
summed squared bounds until the level that reaches the target recall. That level is calibrated on the sample the codebooks
are fitted on: on its pairs over the threshold and on neighbours placed exactly at the threshold in random directions.
What is found is verified by cosine in double precision. Vectors of each length have an index of their own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmart.llm.common import components, join_split, roots, whole_groups
from textmart.session import cut_lineage

#: Rows of the sample that the codebooks and the traversal level are fitted on; entries of each codebook.
SAMPLE_ROWS, ENTRIES = 4096, 16
RECALL = 0.995
#: Pairs of a sample vector that the traversal level is calibrated on.
PARTNERS = 32
#: Rows of each role in one verification unit, about.
BLOCK_ROWS = 512


@dataclass
class MultiIndex:
    books: tuple[np.ndarray, np.ndarray]
    dim: int
    level: float = np.inf

    @classmethod
    def fit(cls, x: np.ndarray, threshold: float, entries: int = ENTRIES, recall: float = RECALL, seed: int = 5) -> MultiIndex:
        """``x``: unit vectors."""
        rng, cut = np.random.default_rng(seed), x.shape[1] // 2
        books = []
        for half in (x[:, :cut], x[:, cut:]):
            book = half[rng.choice(len(half), min(entries, len(half)), replace=False)].copy()
            for _ in range(12):
                near = squares(half, book).argmin(1)
                for k in range(len(book)):
                    if (own := near == k).any():
                        book[k] = half[own].mean(0)
            books.append(np.unique(book, axis=0))
        self = cls((books[0], books[1]), x.shape[1])
        # neighbours at the threshold in random directions, and the sample's own pairs
        noise = rng.normal(size=x.shape)
        noise -= (noise * x).sum(1, keepdims=True) * x
        noise /= np.maximum(np.linalg.norm(noise, axis=1, keepdims=True), 1e-12)
        y = threshold * x + np.sqrt(1 - threshold ** 2) * noise
        cost = [self.costs(x, y)]
        for at in range(0, len(x), 512):
            i, j = np.nonzero(x[at:at + 512] @ x.T >= threshold)
            keep = i + at != j
            i, j = i[keep] + at, j[keep]
            # a vector has at most PARTNERS pairs here, drawn at random: a large group counts as its vectors, not as its pairs
            order = rng.permutation(len(i))
            order = order[i[order].argsort(kind="stable")]
            i, j = i[order], j[order]
            some = np.arange(len(i)) - np.searchsorted(i, i) < PARTNERS
            if some.any():
                cost.append(self.costs(x[i[some]], x[j[some]]))
        self.level = max(float(np.quantile(c, recall)) for c in cost) + 1e-9
        return self

    def half_bounds(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Squared lower bounds of the distance from each half to each cell of its codebook."""
        cut = self.dim // 2
        out = []
        for half, book in zip((x[:, :cut], x[:, cut:]), self.books, strict=True):
            d = squares(half, book)
            best = d.argmin(1)
            apart = np.sqrt(np.maximum(squares(book, book), 1e-18))[best]
            bound = (d - d[np.arange(len(d)), best][:, None]) / (2 * apart)
            bound[np.arange(len(d)), best] = 0
            out.append(np.maximum(bound, 0) ** 2)
        return out[0], out[1]

    def cells(self, x: np.ndarray) -> np.ndarray:
        one, two = self.half_bounds(x)
        return one.argmin(1) * len(self.books[1]) + two.argmin(1)

    def costs(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Summed bounds at which the traversal of x visits the cell of y."""
        one, two = self.half_bounds(x)
        cell, rows = self.cells(y), np.arange(len(x))
        return one[rows, cell // len(self.books[1])] + two[rows, cell % len(self.books[1])]

    def visits(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, cell) of every visit: a heap over the two sorted lists gives the pairs of entries in ascending order of their
        summed bounds until the level; a pair is pushed once, by its left or, in the first column, by its upper neighbour."""
        halves = self.half_bounds(x)
        orders = [h.argsort(1, kind="stable") for h in halves]
        ones, twos = (np.take_along_axis(h, o, 1).tolist() for h, o in zip(halves, orders, strict=True))
        row, first, second = [], [], []
        for r, (one, two) in enumerate(zip(ones, twos, strict=True)):
            heap = [(one[0] + two[0], 0, 0)]
            while heap:
                cost, a, b = heappop(heap)
                if cost > self.level:
                    break
                row.append(r)
                first.append(a)
                second.append(b)
                if b + 1 < len(two):
                    heappush(heap, (one[a] + two[b + 1], a, b + 1))
                if b == 0 and a + 1 < len(one):
                    heappush(heap, (one[a + 1] + two[0], a + 1, 0))
        row = np.array(row, np.int64)
        return row, orders[0][row, first] * len(self.books[1]) + orders[1][row, second]


def squares(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] - 2 * x @ book.T + (book * book).sum(1)[None, :], 0)


def matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    """Rows of a list column in double precision, unit length."""
    flat = pa.concat_arrays([c.flatten() for c in column.chunks]) if isinstance(column, pa.ChunkedArray) else column.flatten()
    x = flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def usable(label: str, vector: str):
    """Rows that can link: label present, all components present and finite, not all zero."""
    bad = lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf")))
    return F.coalesce(F.col(label).isNotNull() & ~F.exists(vector, bad) & F.exists(vector, lambda v: v != 0), F.lit(False))


def padded(vector: str):
    """A vector of one component gets a zero beside it, so that every vector has two halves; no cosine changes."""
    return F.when(F.size(vector) == 1, F.concat(vector, F.array(F.lit(0.0)))).otherwise(F.col(vector))


def fit(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
        threshold: float = 0.93, sample_rows: int = SAMPLE_ROWS) -> dict[int, MultiIndex]:
    """An index for each vector length, fitted on about ``sample_rows`` usable rows of that length, chosen by a hash of the id."""
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v"), F.col(label_col).alias("label"))
    rows = rows.filter(usable("label", "v")).withColumn("length", F.size("v"))
    sizes = {r["length"]: r.n for r in rows.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row a length
    if not sizes:
        return {}
    draw = F.pmod(F.xxhash64(F.lit(17), "id"), F.lit(1_000_000))
    share = F.create_map(*(F.lit(v) for x, n in sizes.items() for v in (x, int(1_000_000 * min(1.0, sample_rows / n)))))
    got: dict[int, list] = {x: [] for x in sizes}
    for r in rows.filter(draw < share[F.col("length")]).select("length", padded("v").alias("v")).collect():
        got[r["length"]].append(r.v)
    for x in [x for x, v in got.items() if not v]:  # no row of a rare length was drawn
        got[x] = [r.v for r in rows.filter(F.col("length") == x).orderBy(draw, "v").limit(8).select(padded("v").alias("v")).collect()]
    unit = lambda v: v / np.linalg.norm(v, axis=1, keepdims=True)
    return {x: MultiIndex.fit(unit(np.array(v, np.float64)), threshold) for x, v in sorted(got.items())}


def near_duplicates(vectors: DataFrame, indexes: dict[int, MultiIndex], *, id_col: str = "vec_id", vector_col: str = "embedding",
                    label_col: str = "label", threshold: float = 0.93) -> DataFrame:
    """``(<id_col>, n_links, component_id, kept)`` for every row.

    Vectors link at a cosine of at least ``threshold`` under equal labels and of equal length. Vectors that are null, empty,
    zero, hold null or non-finite components or have a null label link with nothing. Usable rows that
    repeat an id stand for one vector, the one with the smallest hash, and all get its result. Ids must be longs; rows
    without one come out unlinked. An empty table gives no rows.

    A cell's rows are dealt to units of bounded size, so neither a frequent label nor a full cell is held by one task; a
    unit hands out counts and a spanning forest, never its pairs.
    """
    ids = vectors.select(F.col(id_col).alias("id"))
    if not indexes:
        return ids.select(F.col("id").alias(id_col), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v"), F.col(label_col).alias("label"))
    rows = rows.filter(usable("label", "v") & F.col("id").isNotNull())
    rows = rows.select("id", F.xxhash64("label").alias("label"), F.col("v").cast("array<double>").alias("v"))
    rows = rows.groupBy("id").agg(F.min_by(F.struct("label", "v"), F.xxhash64("label", "v")).alias("x")).select("id", "x.label", "x.v")
    each = [links(rows.filter(F.size("v") == n).withColumn("v", padded("v")), index, threshold) for n, index in indexes.items()]
    found = reduce(DataFrame.unionByName, each)
    counted = found.groupBy("id").agg(F.sum("links").alias("n_links"))
    component = components(found.select(F.col("id").alias("a"), F.col("peer").alias("b")))
    out = ids.join(counted, "id", "left").join(component, F.col("id") == F.col("node"), "left")
    component_id = F.coalesce("root", "id")
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).alias("n_links"), component_id.alias("component_id"),
                      F.coalesce(component_id == F.col("id"), F.lit(True)).alias("kept"))


def links(rows: DataFrame, index: MultiIndex, threshold: float) -> DataFrame:
    """``(id, links, peer)`` of the linked rows ``(id, label, v)`` of one length, some rows several times; written once."""
    dim = index.dim

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The vector in its own cell (role 0) and in each cell it visits (role 1)."""
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                x = matrix(part.column(2), dim)
                row, cell = index.visits(x)
                own = index.cells(x)
                take = np.concatenate([np.arange(len(x)), row])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(take)), part.column(1).take(pa.array(take)), pa.array(np.concatenate([own, cell]).astype(np.int32)),
                     pa.array(np.r_[np.zeros(len(x), np.int32), np.ones(len(row), np.int32)])], names=["id", "label", "cell", "role"])

    spots = cut_lineage(rows.mapInArrow(placed, "id long, label long, cell int, role int"))
    sizes = spots.groupBy("label", "cell").agg(F.sum(F.when(F.col("role") == 0, 1).otherwise(0)).alias("members"), F.sum("role").alias("visitors"))
    sizes = sizes.filter("members > 0 and visitors > 0").select(
        "label", "cell", *(F.greatest(F.lit(1), F.ceil(F.col(c) / F.lit(BLOCK_ROWS))).cast("int").alias(c) for c in ("members", "visitors")))
    dealt = join_split(spots, sizes, ["label", "cell"])
    part = lambda n: F.pmod(F.xxhash64(F.lit(19), "id"), n).cast("int")
    every = lambda n: F.sequence(F.lit(0), n - 1)
    member = F.col("role") == 0
    dealt = dealt.withColumn("m", F.explode(F.when(member, F.array(part(F.col("members")))).otherwise(every(F.col("members")))))
    dealt = dealt.withColumn("n", F.explode(F.when(member, every(F.col("visitors"))).otherwise(F.array(part(F.col("visitors"))))))
    units = dealt.select("id", "role", F.xxhash64("label", "cell", "m", "n").alias("unit"), "label", "cell").join(rows.select("id", "v"), "id")
    count = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    units = units.repartition(count, "unit", "label", "cell").sortWithinPartitions("unit", "label", "cell", "role")

    def verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches, ["unit", "label", "cell"], 2048):
            who, role, unit, label, cell = (t.column(c).to_numpy() for c in ("id", "role", "unit", "label", "cell"))
            x = matrix(t.column("v"), dim)
            starts = np.flatnonzero(np.r_[True, (unit[1:] != unit[:-1]) | (label[1:] != label[:-1]) | (cell[1:] != cell[:-1])])
            home = index.cells(x)
            one, two = index.half_bounds(x)
            width = len(index.books[1])
            links, left, right = np.zeros(len(who), np.int64), [], []
            for a, b in zip(starts, [*starts[1:], len(who)], strict=True):
                mid = a + int((role[a:b] == 0).sum())
                j, i = np.nonzero(x[mid:b] @ x[a:mid].T >= threshold)
                i, j = i + a, j + mid
                other = who[i] != who[j]
                i, j = i[other], j[other]
                # a member that doesn't visit its visitor's cell gets the link from here
                back = one[i, home[j] // width] + two[i, home[j] % width] > index.level
                links[a:b] += np.bincount(j - a, minlength=b - a) + np.bincount((i - a)[back], minlength=b - a)
                left.append(i)
                right.append(j)
            root = roots(len(who), np.concatenate(left), np.concatenate(right))
            # a vector can stand in several rows: the forest's edges name ids
            some = np.flatnonzero((links > 0) | (root != np.arange(len(who))))
            yield pa.RecordBatch.from_arrays([pa.array(who[some]), pa.array(links[some]), pa.array(who[root[some]])], names=["id", "links", "peer"])

    return cut_lineage(units.select("id", "role", "unit", "label", "cell", "v").mapInArrow(verified, "id long, links long, peer long"))

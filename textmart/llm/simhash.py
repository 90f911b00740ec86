"""SimHash near-duplicates through pivot distance tables.

Every distinct fingerprint gets its row of a pivot table: its Hamming distances to ``REFERENCES`` reference fingerprints
(zero, one reference per two-bit block, and fixed pseudo-random ones). Two fingerprints at distance d differ by at most
d in every coordinate, and the block coordinates of the table differ in at most d blocks. So rows of the table are
joined on the coordinates of every choice of block groups that d changed blocks leave alone (no pair within d can be
missed), pairs whose maximum coordinate difference is over d are discarded, and the survivors are verified.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmart.llm.common import components, join_split, pair_units, pairs_within, roots, steps, whole_groups
from textmart.session import cut_lineage

BLOCKS = 32
RANDOM_REFERENCES = 16
#: Rows of a verification unit are at most about twice this.
BLOCK_ROWS = 128


def references() -> np.ndarray:
    """Zero, the mask of each block, and pseudo-random fingerprints."""
    blocks = [3 << (2 * b) for b in range(BLOCKS)]
    return np.array([0, *blocks, *(xxhash.xxh64_intdigest(f"reference {i}") for i in range(RANDOM_REFERENCES))], np.uint64)


def pivot_table(fingerprints: np.ndarray) -> np.ndarray:
    """Hamming distances, one row per fingerprint and one column per reference."""
    return np.bitwise_count(fingerprints.astype(np.uint64)[:, None] ^ references()[None, :]).astype(np.int16)


def join_keys(table: np.ndarray, max_bits: int) -> np.ndarray:
    """One column of keys for each choice of block groups that ``max_bits`` changed blocks can leave alone."""
    # half the difference of the distances to zero and to a block's mask is the block's share of the fingerprint
    block = ((table[:, :1] + 2 - table[:, 1:1 + BLOCKS]) // 2).astype(np.uint64)
    packed = np.zeros(len(table), np.uint64)
    for b in range(BLOCKS):
        packed |= block[:, b] << np.uint64(2 * b)
    groups = max_bits + 3
    masks = [sum(3 << (2 * b) for b in range(BLOCKS) if b % groups == g) for g in range(groups)]
    out = []
    for no, kept in enumerate(combinations(range(groups), groups - max_bits)):
        mixed = (packed & np.uint64(sum(masks[g] for g in kept))) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(no)
        mixed ^= mixed >> np.uint64(29)
        out.append(mixed * np.uint64(0xBF58476D1CE4E5B9) ^ np.uint64(no))
    return np.stack(out, axis=1)


def fingerprints_of(texts: list[str | None], shingle: int) -> np.ndarray:
    """Fingerprints as big-endian bytes, one row of 8 for each text."""
    digests, sizes = [], []
    for t in texts:
        words = (t or "").encode("utf-8").lower().split()  # bytes: A-Z and ASCII white space only
        if len(words) < shingle:
            hashes = [xxhash.xxh64_digest(b" ".join(words), 42)] if words else []
        else:
            hashes = [xxhash.xxh64_digest(s, 42) for s in map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))]
        digests.append(b"".join(hashes))
        sizes.append(len(hashes))
    out = np.zeros((len(texts), 8), np.uint8)
    for k, (d, n) in enumerate(zip(digests, sizes, strict=True)):
        if n:
            counts = np.zeros(64, np.int64)
            for at in range(0, n, 16384):
                part = np.frombuffer(d, np.uint8, min(16384, n - at) * 8, at * 8).reshape(-1, 8)
                counts += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
            out[k] = np.packbits(counts * 2 > n)
    return out


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """``(<id_col>, fp long)`` for every row; a text without words (null, empty) has fingerprint zero."""
    from pyspark.sql.pandas.types import to_arrow_type

    narrow = docs.select(F.col(id_col), F.col(text_col))
    id_type, kind = to_arrow_type(narrow.schema[0].dataType), narrow.dtypes[0][1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in steps(batches):
            fp = fingerprints_of(texts, shingle).view(">u8").ravel().astype(np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(ids, id_type), pa.array(fp)], names=[id_col, "fp"])

    return narrow.mapInArrow(run, f"`{id_col}` {kind}, fp long")


def links(distinct: DataFrame, max_bits: int) -> DataFrame:
    """Edges ``(a, b)`` that connect all fingerprints of ``distinct(fp)`` within ``max_bits``, through chains of such links."""

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False)
            keys = join_keys(pivot_table(fp.view(np.uint64)), max_bits)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.ravel().view(np.int64)), pa.array(np.repeat(fp, keys.shape[1]))], names=["key", "fp"])

    def verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches, ["key", "unit_a", "unit_b"], 4096):
            key, a, b, part, fp = (t.column(c).to_numpy() for c in ("key", "unit_a", "unit_b", "part", "fp"))
            new = np.r_[True, (key[1:] != key[:-1]) | (a[1:] != a[:-1]) | (b[1:] != b[:-1])]
            i, j = pairs_within(np.cumsum(new))
            met = (a[i] == b[i]) | (part[i] != part[j])
            i, j, table = i[met], j[met], pivot_table(fp.view(np.uint64))
            for c in range(table.shape[1] - 1, -1, -1):  # the random references discard most
                near = np.abs(table[i, c] - table[j, c]) <= max_bits
                i, j = i[near], j[near]
            near = np.bitwise_count((fp[i] ^ fp[j]).view(np.uint64)) <= max_bits
            root = roots(len(fp), i[near], j[near])
            moved = np.flatnonzero(root != np.arange(len(fp)))
            yield pa.RecordBatch.from_arrays([pa.array(fp[moved]), pa.array(fp[root[moved]])], names=["a", "b"])

    rows = distinct.select("fp").mapInArrow(keyed, "key long, fp long")
    units = pair_units(rows, "key", "fp", BLOCK_ROWS)
    n = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    units = units.repartition(n, "key", "unit_a", "unit_b").sortWithinPartitions("key", "unit_a", "unit_b")
    return units.select("key", "unit_a", "unit_b", "part", "fp").mapInArrow(verified, "a long, b long")


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                    max_bits: int = 2) -> DataFrame:
    """``(<id_col>, fp, component_id)``: component_id is the smallest id reachable over links of at most ``max_bits`` bits.

    Equal fingerprints are one node, so copies cost no pairs. A null or wordless text has fingerprint zero and is linked
    like any other. Rows without an id take part and get the smallest id of their component (null if it has none).
    Repeated rows give repeated rows. Other columns of the input are not read. An empty table gives no rows.
    """
    rows = cut_lineage(fingerprints(docs, id_col=id_col, text_col=text_col, shingle=shingle)
                       .select(F.col(id_col).alias("id"), "fp"))
    classes = cut_lineage(rows.groupBy("fp").agg(F.min("id").alias("first")))
    found = components(links(classes, max_bits))
    rooted = classes.join(found, F.col("fp") == F.col("node"), "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    # only fingerprints that have links need the second look; the others keep their own first id
    own = join_split(rooted, least, "root").select("fp", "component_id")
    return rows.join(own, "fp").select(F.col("id").alias(id_col), "fp", "component_id")

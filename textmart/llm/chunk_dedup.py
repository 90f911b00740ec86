"""Substring deduplication by content-defined chunks.

A gear rolling hash over the last 32 bytes cuts every text where its top bits are zero, so boundaries depend on content
alone and resist shifts from insertions. Chunks are deduplicated by digest: the copy in the document with the smallest id
stays (within a document the first), and later copies go where consecutive duplicate chunks cover at least ``min_run``
bytes, or the whole document, so that a few common words don't count as a repeat.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmart.llm.common import join_split, steps

#: 2 ** CUT_BITS bytes lie between cuts on average, beyond the smallest chunk.
CUT_BITS, SMALLEST, LARGEST = 4, 16, 512
MIN_RUN = 64
GEAR = np.array([xxhash.xxh32_intdigest(bytes([i]), 2024) for i in range(256)], np.uint32)


def chunk_ends(data: bytes) -> list[int]:
    """Ends of the chunks; a cut never divides a character."""
    n = len(data)
    if not n:
        return []
    b = np.frombuffer(data, np.uint8)
    h = GEAR[b]
    for s in (1, 2, 4, 8, 16):  # h[i] = sum of gear[b[i - j]] << j for j < 32, by doubling
        h[s:] += h[:-s].copy() << np.uint32(s)
    cut = np.flatnonzero(h >> np.uint32(32 - CUT_BITS) == 0) + 1
    starts = np.append((b & 0xC0) != 0x80, True)
    cut = cut[starts[cut]].tolist()
    out, at = [], 0
    for c in (*cut, n):
        while c - at > LARGEST:
            at += LARGEST
            while not starts[at]:
                at -= 1
            out.append(at)
        if c - at >= SMALLEST or c == n and c > at:
            out.append(c)
            at = c
    return out


def digests(data: bytes) -> tuple[list[int], list[bytes]]:
    ends = chunk_ends(data)
    return ends, [hashlib.blake2b(data[a:b], digest_size=16).digest() for a, b in zip([0, *ends], ends, strict=False)]


def duplicate_runs(ends: list[int], keys: list[bytes], elsewhere: set[bytes], min_run: int) -> list[tuple[int, int]]:
    """Byte spans to remove: runs of chunks that stand in an earlier document or earlier in this one."""
    seen: set[bytes] = set()
    runs: list[list[int]] = []
    at = 0
    for end, key in zip(ends, keys, strict=True):
        if key in elsewhere or key in seen:
            if runs and runs[-1][1] == at:
                runs[-1][1] = end
            else:
                runs.append([at, end])
        seen.add(key)
        at = end
    return [(a, b) for a, b in runs if b - a >= min_run or b - a == ends[-1]]


def deduplicate(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_run: int = MIN_RUN) -> DataFrame:
    """``(<id_col>, n_bytes, n_chunks, n_removed, spans, kept_text)`` for every row.

    ``spans`` are the removed byte spans (start, end exclusive) of the UTF-8 text. A null text counts as empty. Rows
    that share an id lose nothing to each other; rows without an id neither lose bytes to others nor claim chunks.
    Whole texts are cut, however long; other columns are not read.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    id_type, id_kind = to_arrow_type(narrow.schema[0].dataType), narrow.dtypes[0][1]

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in steps(batches):
            who, keys = [], []
            for i, t in zip(ids, texts, strict=True):
                own = set(digests((t or "").encode("utf-8"))[1])
                keys += own
                who += [i] * len(own)
            yield pa.RecordBatch.from_arrays([pa.array(who, id_type), pa.array(keys, pa.binary())], names=["id", "digest"])

    rows = narrow.filter("id is not null").mapInArrow(chunks, f"id {id_kind}, digest binary")
    first = rows.groupBy("digest").agg(F.min("id").alias("first"), F.max("id").alias("last")).filter("first < last").select("digest", "first")
    later = join_split(rows, first, "digest").filter("id > first").groupBy("id").agg(F.collect_set("digest").alias("later"))
    keyed = narrow.join(later, "id", "left").select(F.struct("id", "later").alias("key"), "text")

    span_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, texts in steps(batches):
            out = []
            for k, t in zip(keys, texts, strict=True):
                data = (t or "").encode("utf-8")
                ends, own = digests(data)
                spans = duplicate_runs(ends, own, set(k["later"] or ()), min_run) if ends else []
                kept = b"".join(data[a:b] for a, b in zip([0, *(e for _, e in spans)], [*(s for s, _ in spans), len(data)], strict=True))
                out.append((k["id"], len(data), len(ends), len(data) - len(kept), [{"start": s, "end": e} for s, e in spans], kept.decode("utf-8")))
            cols = list(zip(*out, strict=True))
            types = (id_type, pa.int64(), pa.int64(), pa.int64(), span_type, pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)],
                                             names=["id", "n_bytes", "n_chunks", "n_removed", "spans", "kept_text"])

    found = keyed.mapInArrow(removed, f"id {id_kind}, n_bytes long, n_chunks long, n_removed long, "
                                      "spans array<struct<start:long,end:long>>, kept_text string")
    return found.withColumnRenamed("id", id_col)

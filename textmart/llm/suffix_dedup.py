"""Exact substring deduplication with suffix arrays by linear grouping.

A byte goes if a ``LENGTH``-byte string that covers it also starts earlier in the corpus. All windows of that length are
dealt to groups by their minimizer (the smallest hash among their k-grams), so equal windows always meet, at the same
offset from the minimizer. Consecutive windows with one minimizer form a segment. Segments that repeat as a whole are
settled by their 128-bit content digest; where different segments share a minimizer, their windows are compared by
suffix arrays. The strings sorted there are short: within OFFSETS neighbouring offsets the bytes that all windows share are
one letter (equal letters for equal bytes), so a window is a prefix of as many letters.

The suffix arrays are built by linear grouping: suffixes start grouped by first letter; groups are processed in descending
order, and the previous smaller suffix of each member, found over pointers that jump processed suffixes, is moved to a new
group right above its old one, since its Lyndon prefix grows by the processed group's. Then every group's order follows
from one ascending scan over the same pointers, without renaming or recursion.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmart.llm.common import join_split, steps, whole_groups
from textmart.session import cut_lineage

LENGTH, GRAM = 100, 24
SPAN = LENGTH - GRAM + 1
#: Offsets from the minimizer that are compared together.
OFFSETS = 16
#: A minimizer with more different segments than this is dealt again, by single windows.
UNIT_SEGMENTS = 1024
#: Window starts hashed at once.
BLOCK = 1 << 20


def suffix_array(s: list[int]) -> list[int]:
    """Suffix array of letters >= 0; the last letter must be the only smallest one."""
    n = len(s)
    members: list[list[int]] = []
    group = [0] * n
    number: dict[int, int] = {}
    for c in sorted(set(s)):
        number[c] = len(members)
        members.append([])
    for i, c in enumerate(s):
        group[i] = g = number[c]
        members[g].append(i)
    above, below = list(range(1, len(members) + 1)), list(range(-1, len(members) - 1))
    above[-1] = -1
    done, smaller, met = bytearray(n), [-1] * n, [0] * n
    order, g = [], len(members) - 1
    while g >= 0:
        own = [i for i in members[g] if group[i] == g]
        members[g] = own
        for i in own:
            done[i] = 1
        moved, most = [], 1
        for i in own:
            p = i - 1
            while p >= 0 and done[p]:
                p = smaller[p]
            smaller[i] = p
            if p >= 0:
                if met[p]:
                    met[p] += 1
                    if met[p] > most:
                        most = met[p]
                else:
                    met[p] = 1
                    moved.append(p)
        if most > 1:
            moved.sort(key=lambda p: -met[p])  # stable: positions stay ascending
        times, fresh = 0, {}
        for p in moved:
            if met[p] != times:
                times, fresh = met[p], {}
            met[p] = 0
            old = group[p]
            new = fresh.get(old)
            if new is None:
                new = fresh[old] = len(members)
                members.append([])
                up = above[old]
                above.append(up)
                below.append(old)
                above[old] = new
                if up >= 0:
                    below[up] = new
            members[new].append(p)
            group[p] = new
        order.append(g)
        g = below[g]
    free, at = [0] * len(members), 0
    for g in reversed(order):
        free[g] = at
        at += len(members[g])
    out = [-1] * n
    placed = bytearray(n)
    out[0] = n - 1
    placed[n - 1] = 1
    for k in range(n):
        p = out[k] - 1
        while p >= 0 and not placed[p]:
            g = group[p]
            out[free[g]] = p
            free[g] += 1
            placed[p] = 1
            p = smaller[p]
    return out


def rolling(data: np.ndarray) -> np.ndarray:
    """Mixed 64-bit hashes of all GRAM-byte strings, by doubling (24 = 16 + 8)."""
    base = 0x9E3779B97F4A7C15
    power = lambda e: np.uint64(pow(base, e, 1 << 64))
    b = data.astype(np.uint64)
    h = b[:-1] * power(1) + b[1:]
    h = h[:-2] * power(2) + h[2:]
    eight = h[:-4] * power(4) + h[4:]
    sixteen = eight[:-8] * power(8) + eight[8:]
    n = len(data) - GRAM + 1
    h = sixteen[:n] * power(8) + eight[16:16 + n]
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


def segments(texts: list[bytes], digests: bool = True) -> tuple[np.ndarray, ...]:
    """Of all texts: (text number, minimizer hash, content digest, first window start, windows, minimizer offset, again).

    ``again`` marks a segment that stands earlier in the same text. Texts are hashed in blocks of bounded size. Without
    ``digests`` the digests are 0 and nothing is marked.
    """
    parts: list[tuple[np.ndarray, ...]] = []
    block: list[tuple[int, int, bytes]] = []
    size = 0

    def flush() -> None:
        nonlocal size
        if block:
            parts.append(block_segments(block, digests))
        block.clear()
        size = 0

    for k, t in enumerate(texts):
        for at in range(0, len(t) - LENGTH + 1, BLOCK):
            piece = t[at:at + BLOCK + LENGTH - 1] if len(t) > BLOCK else t
            if size + len(piece) > BLOCK + LENGTH:
                flush()
            block.append((k, at, piece))
            size += len(piece)
    flush()
    if not parts:
        none = np.empty(0, np.int64)
        return none, none.view(np.uint64), none.view(np.uint64), none, none, none, none.astype(bool)
    cols = [np.concatenate(c) for c in zip(*parts, strict=True)]
    if not digests:
        return (*cols, np.zeros(len(cols[0]), bool))
    again = pd.DataFrame({"t": cols[0], "k": cols[1], "d": cols[2]}).duplicated(keep="first").to_numpy()  # starts ascend
    return (*cols, again)


def block_segments(block: list[tuple[int, int, bytes]], digests: bool) -> tuple[np.ndarray, ...]:
    data = b"".join(p for _, _, p in block)
    ends = np.cumsum([len(p) for _, _, p in block])
    starts = ends - np.array([len(p) for _, _, p in block])
    h = rolling(np.frombuffer(data, np.uint8))
    bits = np.uint64(len(data).bit_length())
    low = (h >> bits << bits) | np.arange(len(h), dtype=np.uint64)  # ties: the leftmost
    have = 1
    while have * 2 <= SPAN:
        low = np.minimum(low[:-have], low[have:])
        have *= 2
    if SPAN > have:
        low = np.minimum(low[:len(low) - (SPAN - have)], low[SPAN - have:])
    spot = (low & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    window = np.arange(len(spot))
    piece = np.searchsorted(ends, window, side="right")
    window, piece = window[(fits := window + LENGTH <= ends[piece])], piece[fits]
    at = spot[window]
    new = np.flatnonzero(np.r_[True, at[1:] != at[:-1]] | np.r_[True, piece[1:] != piece[:-1]])
    first, last = window[new], window[np.r_[new[1:] - 1, len(window) - 1]]
    at, piece = at[new], piece[new]
    digest = np.zeros(len(first), np.uint64) if not digests else np.fromiter((xxhash.xxh3_64_intdigest(data[a:b]) for a, b in zip(first.tolist(), (last + LENGTH).tolist(), strict=True)), np.uint64, len(first))
    digest ^= (at - first + 1).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    owner, base = np.array([k for k, _, _ in block]), np.array([a for _, a, _ in block])
    return owner[piece], h[at], digest, first - starts[piece] + base[piece], last - first + 1, at - first


def pack_place(start, windows, offset, again):
    return (((start << 8 | windows) << 8) | offset) << 1 | again


def unpack_place(place):
    return place >> 17, place >> 9 & 255, place >> 1 & 255, place & 1


def ranges_of(text: bytes, start: int, windows: int, offset: int) -> Iterator[tuple[int, bytes, bytes, bytes, int, int, int]]:
    """Cut a segment's windows by their offset from the minimizer: (range, bytes that all windows of the range share, bytes
    before and after them, first window start, windows, letters of a window)."""
    for q in range((offset - windows + 1) // OFFSETS, offset // OFFSETS + 1):
        o1, o2 = q * OFFSETS, min(q * OFFSETS + OFFSETS, SPAN) - 1
        lo, hi = max(0, offset - o2), min(windows - 1, offset - o1)
        a, b = offset - o1, offset - o2 + LENGTH
        yield q, text[a:b], text[lo:a], text[b:hi + LENGTH], start + lo, hi - lo + 1, o2 - o1 + 1


def string_repeats(groups: list[tuple[int, list[tuple[bytes, bytes, int, int, int]]]]) -> list[tuple[int, int, int]]:
    """Windows that stand earlier, as (id, start, end) byte spans.

    groups: of each shared core (letters of a window, different strings (before, after, id, first window start, windows)).
    """
    letters: list[int] = []
    strings: list[tuple[int, int, int, int, int]] = []  # start in letters, windows, id, first window start, width
    for core, (width, rows) in enumerate(groups, 258):
        for left, right, who, start, windows in rows:
            strings.append((len(letters), windows, who, start, width))
            letters += [x + 2 for x in left]
            letters.append(core)
            letters += [x + 2 for x in right]
            letters.append(1)
    if not strings:
        return []
    letters.append(0)
    owner = [-1] * len(letters)
    for k, (at, windows, *_) in enumerate(strings):
        owner[at:at + windows] = [k] * windows
    first: tuple[int, int] | None = None
    before: list[int] = []
    later: list[tuple[int, int]] = []
    for p in suffix_array(letters):
        k = owner[p]
        if k < 0:
            continue
        at, _, who, start, width = strings[k]
        word, now = letters[p:p + width], (who, start + p - at)
        if word != before:
            before, first = word, now
        elif now < first:
            later.append(first)
            first = now
        elif now > first:
            later.append(now)
    found: list[tuple[int, int, int]] = []
    at = -2
    for who, start in sorted(later):
        if found and at == start - 1 and found[-1][0] == who:
            found[-1] = (who, found[-1][1], start + LENGTH)
        else:
            found.append((who, start, start + LENGTH))
        at = start
    return found


def unit_repeats(units: list[list[tuple[bytes, int, int, int, int]]]) -> list[tuple[int, int, int]]:
    """Windows that stand earlier, as (id, start, end) byte spans.

    units: of each minimizer its different segments, as (text, id, first window start, windows, minimizer offset).
    """
    found: list[tuple[int, int, int]] = []
    groups = []
    for rows in units:
        met: dict[tuple[int, bytes], dict[tuple[bytes, bytes], tuple[int, int, int]]] = {}
        for text, who, start, windows, offset in rows:
            for q, core, left, right, at, n, width in ranges_of(text, start, windows, offset):
                same = met.setdefault((width, q, core), {})
                now = (who, at, n)
                old = same.setdefault((left, right), now)
                if old != now:
                    first, later = (old, now) if old < now else (now, old)
                    same[left, right] = first
                    found.append((later[0], later[1], later[1] + later[2] - 1 + LENGTH))
        groups += [(width, [(*sides, *now) for sides, now in same.items()]) for (width, _, _), same in met.items() if len(same) > 1]
    return found + string_repeats(groups)


def spans_of(parts: list[dict]) -> list[tuple[int, int]]:
    """Maximal runs covered by the spans."""
    out: list[list[int]] = []
    for a, b in sorted((p["start"], p["end"]) for p in parts):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


PLACES = "array<struct<start:long,end:long>>"


def deduplicate(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", unit_segments: int = UNIT_SEGMENTS) -> DataFrame:
    """``(<id_col>, n_bytes, n_removed, spans, kept)`` for every row; spans are the maximal removed byte spans, kept is binary.

    Ids must be longs and order the corpus. A null text counts as empty; a text shorter than LENGTH keeps all. Rows
    without an id keep all and are no earlier place for others; rows that share an id and a place are one place. Whole
    texts are read, whatever their length; other columns are not read. An empty table gives no rows.

    No group is held by one task: repeated segments are counted with partial aggregates and joined back, at most
    ``unit_segments`` different segments of a minimizer meet in a task. Segments of minimizers with more are cut in ranges
    of OFFSETS offsets and dealt by what the range's windows share; cores with more than that many different sides are dealt
    by single windows, of which only the earliest place is kept.
    """
    narrow = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in steps(batches):
            k, gram, digest, start, windows, offset, again = segments([(t or "").encode("utf-8") for t in texts])
            place = pack_place(start, windows, offset, again.astype(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(gram.view(np.int64)), pa.array(digest.view(np.int64)), pa.array(np.array(ids, np.int64)[k]), pa.array(place)],
                                             names=["gram", "digest", "id", "place"])

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in steps(batches):
            gram = segments([(t or "").encode("utf-8") for t in texts], digests=False)[1]
            yield pa.RecordBatch.from_arrays([pa.array(gram.view(np.int64))], names=["gram"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3)
        for ids, texts in steps(batches):
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([squeeze.compress((t or "").encode("utf-8")) for t in texts], pa.binary())],
                                             names=["id", "packed"])

    # texts are shuffled compressed, and once: both joins on the id read the same exchange
    packed = narrow.mapInArrow(pack, "id long, packed binary").filter("id is not null")
    known = narrow.filter("id is not null")
    often = known.mapInArrow(grams, "gram long").groupBy("gram").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("gram")
    rows = known.mapInArrow(cut, "gram long, digest long, id long, place long")
    rows = cut_lineage(join_split(rows, often, "gram"))
    once = rows.filter("place & 1 = 0")
    first = cut_lineage(once.groupBy("gram", "digest").agg(F.min("id").alias("first")))
    variants = first.groupBy("gram").agg(F.count(F.lit(1)).alias("variants")).filter("variants > 1")
    start, windows = F.shiftright("place", 17), F.shiftright("place", 9).bitwiseAND(F.lit(255))
    whole = rows.join(first, ["gram", "digest"]).filter("place & 1 = 1 or id > first").select("id", start.alias("start"), (start + windows + (LENGTH - 1)).alias("end"))

    kept = join_split(once.join(first.withColumnRenamed("first", "id"), ["gram", "digest", "id"]), variants, "gram")

    def wanted(some: DataFrame) -> DataFrame:
        """Compressed texts with the places of their segments that are to be compared."""
        places = some.groupBy("id").agg(F.collect_list(F.struct("gram", "place")).alias("wanted"))
        return packed.join(places, "id").select("id", "packed", "wanted")

    def sliced(batches: Iterator[pa.RecordBatch], rows_of, names: list[str], types: list[pa.DataType]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part, out = batch.slice(at, 64), []
                for who, data, some in zip(*(part.column(c).to_pylist() for c in range(3)), strict=True):
                    data = unpack.decompress(data)
                    for x in some:
                        a, n, offset, _ = unpack_place(x["place"])
                        out += rows_of(x, who, data[a:a + n - 1 + LENGTH], a, n, offset)
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)

    def segment_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return sliced(batches, lambda x, who, text, *_: [(x["gram"], who, x["place"], text)], ["unit", "id", "place", "text"],
                      [pa.int64(), pa.int64(), pa.int64(), pa.binary()])

    def range_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The ranges of segments whose minimizer has many others: digest of the core, bytes around it."""

        def rows_of(x, who, text, a, n, offset):
            out = []
            for q, core, left, right, at, k, width in ranges_of(text, a, n, offset):
                h = xxhash.xxh3_128_intdigest(core, seed=q)
                out.append(((h >> 64) - (1 << 63), (h & (1 << 64) - 1) - (1 << 63), width, left, right, who, at, k))
            return out

        return sliced(batches, rows_of, ["unit", "more", "width", "left", "right", "id", "start", "n"],
                      [pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int32()])

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches, ["unit"], 1024):
            units: dict[int, list] = {}
            for unit, who, place, text in zip(*(t.column(c).to_pylist() for c in ("unit", "id", "place", "text")), strict=True):
                a, n, offset, _ = unpack_place(place)
                units.setdefault(unit, []).append((text, who, a, n, offset))
            yield from as_spans(unit_repeats(list(units.values())))

    def ranges_compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches, ["unit", "more"], 4096):
            groups: dict[tuple[int, int], tuple[int, list]] = {}
            for unit, more, width, *row in zip(*(t.column(c).to_pylist() for c in ("unit", "more", "width", "left", "right", "id", "start", "n")), strict=True):
                groups.setdefault((unit, more), (width, []))[1].append(tuple(row))
            yield from as_spans(string_repeats(list(groups.values())))

    def as_spans(found: list[tuple[int, int, int]]) -> Iterator[pa.RecordBatch]:
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], names=["id", "start", "end"])

    spans = "id long, start long, end long"
    count = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    units = wanted(kept.filter(F.col("variants") <= unit_segments)).mapInArrow(segment_texts, "unit long, id long, place long, text binary")
    partly = units.repartition(count, "unit").sortWithinPartitions("unit").mapInArrow(compared, spans)

    # minimizers with many different segments: their ranges of windows, then, where a core has many sides, single windows
    parts = wanted(kept.filter(F.col("variants") > unit_segments)).mapInArrow(
        range_rows, "unit long, more long, width int, left binary, right binary, id long, start long, n int")
    core, sides, spot = ["unit", "more"], ["unit", "more", "width", "left", "right"], F.struct("id", "start")
    earliest = parts.groupBy(*sides).agg(F.min(spot).alias("first"))
    cores = earliest.groupBy(*core).agg(F.count(F.lit(1)).alias("variants")).filter("variants > 1")
    again = join_split(parts, earliest, sides).filter(spot > F.col("first")).select("id", "start", (F.col("start") + F.col("n") + (LENGTH - 1)).alias("end"))
    letters = F.octet_length("left") + 1 + F.octet_length("right")
    odd = join_split(earliest, cores, core).select(*sides, "first.id", "first.start", (letters - F.col("width") + 1).alias("n"), "variants")
    some = odd.filter(F.col("variants") <= unit_segments).drop("variants")
    ranged = some.repartition(count, *core).sortWithinPartitions(*core).mapInArrow(ranges_compared, spans)
    many = odd.filter(F.col("variants") > unit_segments).withColumn("k", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    before = F.expr("substring(left, k + 1)")
    after = F.expr("substring(right, 1, width - 1 - greatest(octet_length(left) - k, 0))")
    single = many.select(*core, before.alias("left"), after.alias("right"), "id", (F.col("start") + F.col("k")).alias("start"))
    same = [*core, "left", "right"]
    lone = join_split(single, single.groupBy(*same).agg(F.min(spot).alias("first")), same).filter(spot > F.col("first")).select(
        "id", "start", (F.col("start") + LENGTH).alias("end"))
    spans = (whole.union(partly).union(again).union(ranged).union(lone).groupBy("id")
             .agg(F.collect_list(F.struct("start", "end")).alias("parts")))

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        span_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            for k in range(0, batch.num_rows, 64):
                part, out = batch.slice(k, 64), []
                for who, data, parts in zip(*(part.column(c).to_pylist() for c in range(3)), strict=True):
                    data, gone = unpack.decompress(data), spans_of(parts or [])
                    left = b"".join(data[a:b] for a, b in zip([0, *(e for _, e in gone)], [*(s for s, _ in gone), len(data)], strict=True))
                    out.append((who, len(data), len(data) - len(left), [{"start": s, "end": e} for s, e in gone], left))
                types = (pa.int64(), pa.int64(), pa.int64(), span_type, pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)],
                                                 names=["id", "n_bytes", "n_removed", "spans", "kept"])

    lost = packed.join(spans, "id", "left").select("id", "packed", "parts")
    no_id = narrow.filter("id is null").mapInArrow(pack, "id long, packed binary").withColumn("parts", F.lit(None).cast(PLACES))
    found = lost.union(no_id).mapInArrow(remove, f"id long, n_bytes long, n_removed long, spans {PLACES}, kept binary")
    return found.withColumnRenamed("id", id_col)

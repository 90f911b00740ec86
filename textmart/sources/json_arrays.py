"""JSON arrays read by byte ranges and written as one or more array files per key.

A JSON array has no line ends to split at, but whether a byte stands inside a string and how deep it stands follow from
the bytes before it. Each byte range is looked through for both cases (a string is open at its start, or not): the case at
its end, the change of depth, and the objects that begin at every depth. One row a range goes to the driver, which chains
them from the file's start; then every range is read again by a task that knows its start, takes the objects that begin
in it and reads on to the end of the last one. So one file of any size is read by as many tasks as it has ranges, and
``ord`` is known without a sort.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from textmart.functions.scores import safe_name

FORMAT = "json_array"
CHUNK_BYTES = 32 << 20
#: Rows of one written array file; a key with more has several files.
FILE_ROWS = 1_000_000
QUOTE, SLASH, OPEN, CLOSE, COMMA = ord('"'), ord("\\"), ord("{"), ord("}"), ord(",")
STEPS = np.zeros(256, np.int8)
STEPS[[ord("{"), ord("[")]], STEPS[[ord("}"), ord("]")]] = 1, -1
MARKS = STEPS != 0
MARKS[COMMA] = True


def located(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a URI or an absolute path."""
    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path[5:]
    return pafs.FileSystem.from_uri(path)


# ---- structure of a byte range ---------------------------------------------------------------------------------------

def structure(data: bytes, in_string: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, bool]:
    """Positions and bytes of braces, brackets and commas outside strings, the depth after each (from 0), and whether a string is open at the end.

    ``data`` does not begin with an escaped character.
    """
    b = np.frombuffer(data, np.uint8)
    quotes, slashes = np.flatnonzero(b == QUOTE), np.flatnonzero(b == SLASH)
    if len(slashes) and len(quotes):
        begins = np.diff(slashes, prepend=-2) != 1
        run_start = slashes[begins][np.cumsum(begins) - 1]
        j = np.searchsorted(slashes, quotes) - 1
        odd = (j >= 0) & (slashes[j] == quotes - 1) & ((quotes - run_start[j]) % 2 == 1)
        quotes = quotes[~odd]
    at = np.flatnonzero(MARKS[b])
    at = at[(np.searchsorted(quotes, at) + in_string) % 2 == 0]
    return at, b[at], np.cumsum(STEPS[b[at]], dtype=np.int64), bool(in_string ^ (len(quotes) % 2 == 1))


def boundary(f, at: int, size: int) -> int:
    """``at``, or the next byte where an odd run of backslashes stands before it (the byte is escaped)."""
    if at <= 0 or at >= size:
        return min(max(at, 0), size)
    run, back = 0, 64
    while True:
        start = max(0, at - back)
        tail = f.read_at(at - start, start)
        run = len(tail) - len(tail.rstrip(b"\\"))
        if run < len(tail) or start == 0:
            return at + run % 2
        back *= 4


def looked_through(f, start: int, end: int, size: int) -> dict:
    """For both cases: string open at the end, change of depth, objects and commas by the depth they stand at."""
    start, end = boundary(f, start, size), boundary(f, end, size)
    data, found = f.read_at(end - start, start), {"root": ""}
    if start == 0:
        text = data[:1 << 16].removeprefix(b"\xef\xbb\xbf").lstrip()
        found["root"] = text[:1].decode("latin-1")
    for case in (0, 1):
        _, marks, depth, open_ = structure(data, bool(case))
        at_depth = lambda levels: {int(d): int(n) for d, n in zip(*np.unique(levels, return_counts=True), strict=True)}
        found[str(case)] = {"open": int(open_), "depth": int(depth[-1]) if len(depth) else 0,
                            "objects": at_depth(depth[marks == OPEN] - 1), "commas": at_depth(depth[marks == COMMA])}
    return found


def chained(rows: list[tuple[str, int, int, int, dict]]) -> list[dict]:
    """The pieces to read, from the ranges ``(file, size, start, end, findings)`` of whole files in order."""
    pieces, base, file, state = [], 0, None, {}

    def ended() -> None:
        nonlocal base
        if file is None:
            return
        if state["open"] or state["depth"] or (state["root"] == "[" and state["n"] and state["commas"] != state["n"] - 1) \
                or state["root"] not in ("[", "{", "") or (state["root"] == "{" and state["n"] != 1):
            raise ValueError(f"{file} is not a JSON array of objects")
        base += state["n"]

    for name, size, start, end, found in rows:
        if name != file:
            ended()
            file, state = name, {"open": 0, "depth": 0, "n": 0, "commas": 0, "root": found["root"]}
        here = found[str(state["open"])]
        level = (1 if state["root"] == "[" else 0) - state["depth"]
        count = lambda kind: here[kind].get(level, here[kind].get(str(level), 0))  # noqa: B023, E731
        n = count("objects")
        if n:
            pieces.append({"file": name, "start": start, "end": end, "size": size, "open": state["open"], "level": level,
                           "first": state["n"], "base": base, "n": n})
        state["n"] += n
        state["commas"] += count("commas")
        state["open"], state["depth"] = here["open"], state["depth"] + here["depth"]
    ended()
    return pieces


def objects(f, piece: dict, more: int = 1 << 16) -> Iterator[bytes]:
    """The objects that begin in the range, the last one read to its end."""
    start, end = boundary(f, piece["start"], piece["size"]), boundary(f, piece["end"], piece["size"])
    data = f.read_at(end - start, start)
    at, marks, depth, _ = structure(data, bool(piece["open"]))
    level = piece["level"]
    begins = at[(marks == OPEN) & (depth == level + 1)]
    ends = at[(marks == CLOSE) & (depth == level)]
    ends = ends[ends > begins[0]] if len(begins) else ends
    yield from (data[a:b + 1] for a, b in zip(begins, ends, strict=False))
    if len(begins) > len(ends):
        rest = data[begins[-1]:]
        while True:
            upto = boundary(f, min(end + more, piece["size"]), piece["size"])
            rest, end, more = rest + f.read_at(upto - end, end), upto, more * 2
            at, marks, depth, _ = structure(rest, False)
            closed = at[(marks == CLOSE) & (depth == 0)]
            if len(closed):
                yield rest[:closed[0] + 1]
                return
            if end >= piece["size"]:
                raise ValueError(f"{piece['file']}: an object does not end")


# ---- data source -----------------------------------------------------------------------------------------------------

@dataclass
class Part(InputPartition):
    piece: dict

    def __post_init__(self):
        super().__init__(0)


class ArrayReader(DataSourceReader):
    def __init__(self, plan: list[dict]):
        self.plan = plan

    def partitions(self) -> list[Part]:
        return [Part(p) for p in self.plan] or [Part({"n": 0})]

    def read(self, part: Part) -> Iterator[pa.RecordBatch]:
        piece = part.piece
        if not piece["n"]:
            return
        fs, path = located(piece["file"])
        with fs.open_input_file(path) as f:
            rows, size, first = [], 0, piece["first"]

            def batch() -> pa.RecordBatch:
                at = np.arange(first, first + len(rows))
                return pa.RecordBatch.from_arrays([pa.array([piece["file"]] * len(rows)), pa.array(at.astype(np.int32)), pa.array(at + piece["base"]),
                                                   pa.array(rows, pa.string())], names=["file", "ord", "doc_id", "value"])

            for value in objects(f, piece):
                rows.append(value.decode("utf-8"))
                size += len(value)
                if size > 1 << 20:
                    yield batch()
                    first, rows, size = first + len(rows), [], 0
            if rows:
                yield batch()


@dataclass
class Files(WriterCommitMessage):
    names: list


class ArrayWriter(DataSourceArrowWriter):
    """Rows (key string, value string), sorted by ``file`` inside a partition: one array file for each value of ``file``."""

    def __init__(self, path: str):
        self.path = path
        fs, at = located(path)
        if fs.get_file_info(f"{at}/_files.json").type != pafs.FileType.NotFound:
            raise ValueError(f"{path} already holds JSON arrays")
        fs.create_dir(at, recursive=True)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        fs, at = located(self.path)
        names, out, now = [], None, None
        for batch in iterator:
            for key, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if out is None or key != now:
                    if out is not None:
                        out.write(b"\n]\n")
                        out.close()
                    now = key
                    names.append(f"{key}-{uuid.uuid4().hex}.json")
                    out = fs.open_output_stream(f"{at}/{names[-1]}")
                    out.write(b"[\n")
                else:
                    out.write(b",\n")
                out.write(value.encode())
        if out is not None:
            out.write(b"\n]\n")
            out.close()
        return Files(names)

    def commit(self, messages: list) -> None:
        fs, at = located(self.path)
        with fs.open_output_stream(f"{at}/_files.json") as out:
            out.write(json.dumps(sorted(n for m in messages if m is not None for n in m.names)).encode())

    def abort(self, messages: list) -> None:
        fs, at = located(self.path)
        for name in (n for m in messages if m is not None for n in m.names):
            if fs.get_file_info(f"{at}/{name}").type == pafs.FileType.File:
                fs.delete_file(f"{at}/{name}")


class JsonArrays(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "file string, ord int, doc_id long, value string"

    def reader(self, schema) -> DataSourceReader:
        return ArrayReader(json.loads(self.options["plan"]))

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return ArrayWriter(self.options["path"])


# ---- reading and writing ---------------------------------------------------------------------------------------------

def listed(spark: SparkSession, paths: Sequence[str]) -> list[tuple[str, int]]:
    """(URI, bytes) of the files that paths and globs name, by URI; a folder written here by its list of files."""
    found = {}
    for p in paths:
        hadoop = spark._jvm.org.apache.hadoop.fs.Path(p)
        fs = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
        for s in fs.globStatus(hadoop) or []:
            uri = s.getPath().toString()
            if s.isDirectory():
                afs, at = located(uri)
                with afs.open_input_stream(f"{at}/_files.json") as f:
                    names = json.loads(f.read())
                found |= {f"{uri}/{i.base_name}": i.size for i in afs.get_file_info([f"{at}/{n}" for n in names])}
            else:
                found[uri] = s.getLen()
    return sorted(found.items())


def plan(spark: SparkSession, paths: str | Sequence[str], chunk_bytes: int = CHUNK_BYTES) -> list[dict]:
    """The pieces of all files; the ranges are looked through by a Spark job, one small row for each comes back."""
    files = listed(spark, [paths] if isinstance(paths, str) else paths)
    ranges = [(k, name, size, at, min(at + chunk_bytes, size)) for k, (name, size) in enumerate(files) for at in range(0, size, chunk_bytes)]
    if not ranges:
        return []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, name, size, start, end in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                fs, path = located(name)
                with fs.open_input_file(path) as f:
                    found = json.dumps(looked_through(f, start, end, size))
                yield pa.RecordBatch.from_arrays([pa.array([k]), pa.array([start]), pa.array([found])], names=["k", "start", "found"])

    dealt = spark.createDataFrame(ranges, "k long, file string, size long, start long, end long").repartition(len(ranges), "k", "start")
    found = {(r.k, r.start): json.loads(r.found) for r in dealt.mapInArrow(run, "k long, start long, found string").collect()}
    return chained([(name, size, start, end, found[k, start]) for k, name, size, start, end in ranges])


def read_json_arrays(spark: SparkSession, paths: str | Sequence[str], schema: str, *, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """S1 for files of any size: ``(file, ord, doc_id, *schema)`` like ``files.read_json_array``, many tasks a file.

    UTF-8, with or without a byte-order mark. A file whose root is one object counts as a list of one; an empty file or
    array has no rows. A file that is cut off or holds other elements than objects raises an error when it is planned, a
    malformed object when the rows are read.
    """
    spark.dataSource.register(JsonArrays)
    raw = spark.read.format(FORMAT).option("plan", json.dumps(plan(spark, paths, chunk_bytes))).load()
    return raw.select("file", "ord", "doc_id", F.from_json("value", schema, {"mode": "FAILFAST"}).alias("v")).select("file", "ord", "doc_id", "v.*")


def write_json_arrays(df: DataFrame, path: str, *, key: str | None = None, order: Sequence[str | Column] = (), file_rows: int = FILE_ROWS) -> None:
    """JSON arrays named after the safe form of ``key`` (F18), each file a whole array of the rows' columns, nulls kept.

    A key with more than ``file_rows`` rows is dealt to several files by a hash of the row, so no task holds a hot key.
    Rows are in ``order`` inside a file. The list of files is written last; ``read_json_arrays`` takes the folder.
    """
    spark = df.sparkSession
    spark.dataSource.register(JsonArrays)
    name = safe_name(F.col(key).cast("string")) if key else F.lit("part")
    value = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})
    rows = df.select(name.alias("_key"), value.alias("_value"), *[c if isinstance(c, Column) else F.col(c).alias(f"_o{i}") for i, c in enumerate(order)])
    by = [c for c in rows.columns if c not in ("_key", "_value")]
    n = rows.groupBy("_key").agg(F.ceil(F.count(F.lit(1)) / file_rows).cast("long").alias("_files"))
    rows = rows.join(n, "_key").withColumn("_part", F.pmod(F.xxhash64("_value"), F.col("_files")))
    rows = rows.repartition("_key", "_part").sortWithinPartitions("_key", "_part", *by)
    file = F.concat("_key", F.lit("-"), F.col("_part").cast("string"))
    rows.select(file.alias("file"), F.col("_value").alias("value")).write.format(FORMAT).mode("append").save(path)

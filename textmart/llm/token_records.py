"""Token ids as length-delimited binary records with masked checksums, and a separate offset index.

A data file is a run of frames: the payload's length (8 bytes), its masked CRC-32C (4), the payload, the payload's masked
CRC-32C (4), all little-endian. A payload is one sequence: bytes per id (2), flags (2, bit 0: the id is null), doc_id (8,
signed), then the ids. The index file beside it has 16 bytes for every frame, the frame's offset and its number of ids, so
record k is found by one seek. ``_manifest.json`` lists the files in order; a file counts only if it is listed there.

Spark writes and reads the format through a data source: a task writes files under names of its own, and the list of files
is written once when all tasks are done, so lost executors and repeated attempts leave nothing but unlisted files. The
global position of a file's first id comes from the numbers of ids of the files before it (one number per file).

Defined cases: a null text is an empty one (only the end id); rows without an id come first, rows that repeat an id are
ordered by text; a text of any length is one record; an empty table gives a manifest without files; other columns are not
read. Ids of documents are integers.
"""

from __future__ import annotations

import json
import re
import unicodedata
import uuid
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from textmart.llm.common import steps
from textmart.session import checkpoint_dir

FORMAT = "token_records"
MANIFEST = "_manifest.json"
END_ID = 1
#: Distinct words and pieces of words that a process's tables hold (about 170 bytes each); longer ones than LONG
#: characters are not kept.
TABLE_WORDS, TABLE_PIECES = 600_000, 600_000
LONG = 64
#: Character that stands between new words when many are encoded in one call, and words of a call.
BETWEEN, CALL_WORDS = "\x01", 4096
#: A read partition takes about so many bytes, a step of a reader or writer about so many ids.
PART_BYTES = 64 << 20
STEP_IDS = 1 << 20
HEAD, INDEX = np.dtype([("width", "<u2"), ("flags", "<u2"), ("doc_id", "<i8")]), np.dtype([("offset", "<u8"), ("n", "<u8")])
FRAME = 16  # bytes of a frame beside its payload

# fixed value: the pattern by which the given tokenizer cuts words into pieces (after lower-casing)
PIECES = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
#: Words of these characters are cut here: no white space or control, no numbers but digits, and no letters on which Unicode
#: versions differ. For them the pattern below cuts like PIECES; a line end stands between two words.
LATIN = re.compile("[\x21-\x7e\xa1-\xb1\xb4-\xb8\xba\xbb\xbf-\u024f]+")
LATIN_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\w\s]|_)+|\n")
# fixed value: the characters that stand for bytes in a byte-level vocabulary, where they differ from Latin-1
BYTES = {b: 256 + k for k, b in enumerate([*range(33), *range(127, 161), 173])}

# fixed values of the checksum: reversed polynomial of CRC-32C, mask constant of the record format
POLYNOMIAL = 0x82F63B78
MASK = 0xA282EAD8


# ---- checksums -------------------------------------------------------------------------------------------------------

def _byte_table() -> np.ndarray:
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = (c >> 1) ^ np.where(c & 1, np.uint32(POLYNOMIAL), np.uint32(0))
    return c


class Crc32c:
    """CRC-32C of many byte strings of even length at once, by a tree over their 16-bit units.

    The checksum is linear: that of ``a + b`` is that of ``a`` moved by the length of ``b``, xor that of ``b``. Neighbours
    are joined level by level; units in front of a string that are zero change nothing, so odd levels are filled there.
    """

    def __init__(self):
        t = _byte_table()
        unit = np.arange(1 << 16, dtype=np.uint32)
        low = t[unit & 255]
        self.unit = (low >> 8) ^ t[(low ^ (unit >> 8)) & 255]
        # what 2 zero bytes do to a checksum, as tables of its low and high 16 bits; each further level doubles the bytes
        step = lambda c: (c >> 8) ^ t[c & 255]
        self.moves = [tuple(step(step(x)) for x in (unit, unit << 16))]

    def moved(self, c: np.ndarray, level: int) -> np.ndarray:
        while len(self.moves) <= level:
            low, high = self.moves[-1]
            twice = lambda x: low[x & 0xFFFF] ^ high[x >> 16]  # noqa: B023, E731
            self.moves.append((twice(low), twice(high)))
        low, high = self.moves[level]
        return low[c & 0xFFFF] ^ high[c >> 16]

    def of(self, units: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Checksums of strings of ``counts`` units (two at least) that stand one after another in ``units``."""
        if not len(counts):
            return np.empty(0, np.uint32)
        ends = np.cumsum(counts)
        first = ends - counts
        units = units.copy()
        units[first] ^= 0xFFFF
        units[first + 1] ^= 0xFFFF
        c, level = self.unit[units], 0
        while len(c) > len(counts):
            odd = counts & 1
            if odd.any():
                wide = np.zeros(len(c) + int(odd.sum()), np.uint32)
                wide[np.arange(len(c)) + np.repeat(np.cumsum(odd), counts)] = c
                c, counts = wide, counts + odd
            c = self.moved(c[0::2], level) ^ c[1::2]
            counts, level = counts // 2, level + 1
        return c ^ np.uint32(0xFFFFFFFF)

    def masked(self, units: np.ndarray, counts: np.ndarray) -> np.ndarray:
        c = self.of(units, counts)
        return ((c >> 15) | (c << 17)) + np.uint32(MASK)


# ---- frames ----------------------------------------------------------------------------------------------------------

def frames(crc: Crc32c, doc_ids: list, sequences: list[bytes], width: int) -> tuple[list[bytes], np.ndarray]:
    """The frames' pieces in order, and the bytes of each frame."""
    heads = np.zeros(len(doc_ids), HEAD)
    heads["width"], heads["flags"] = width, [i is None for i in doc_ids]
    heads["doc_id"] = [0 if i is None else i for i in doc_ids]
    payloads = [h.tobytes() + s for h, s in zip(heads, sequences, strict=True)]
    sizes = np.array([len(p) for p in payloads], dtype="<u8")
    data = crc.masked(np.frombuffer(b"".join(payloads), "<u2"), (sizes // 2).astype(np.int64)).astype("<u4")
    length = crc.masked(sizes.view("<u2"), np.full(len(sizes), 4)).astype("<u4")
    pieces = [x for n, c, p, d in zip(sizes, length, payloads, data, strict=True) for x in (n.tobytes(), c.tobytes(), p, d.tobytes())]
    return pieces, sizes.astype(np.int64) + FRAME


def unframed(crc: Crc32c, blob: bytes, sizes: list[int], where: str) -> list[tuple[int | None, np.ndarray]]:
    """(doc_id, ids) of the frames in ``blob``, ``sizes`` their bytes by the index; raises where a checksum fails."""
    at, payloads, said = 0, [], []
    for size in sizes:
        frame = blob[at:at + size]
        at += size
        if len(frame) < size or int.from_bytes(frame[:8], "little") != size - FRAME:
            raise ValueError(f"{where}: a frame's length does not agree with the index")
        payloads.append(frame[12:-4])
        said.append((frame[:8], frame[8:12], frame[-4:]))
    counts = np.array([len(p) // 2 for p in payloads], np.int64)
    data = crc.masked(np.frombuffer(b"".join(payloads), "<u2"), counts)
    length = crc.masked(np.frombuffer(b"".join(s[0] for s in said), "<u2"), np.full(len(said), 4))
    if (b"".join(s[1] for s in said) != length.astype("<u4").tobytes()) or (b"".join(s[2] for s in said) != data.astype("<u4").tobytes()):
        raise ValueError(f"{where}: checksum failed")
    rows = []
    for p in payloads:
        head = np.frombuffer(p, HEAD, 1)[0]
        rows.append((None if head["flags"] & 1 else int(head["doc_id"]), np.frombuffer(p, f"<u{head['width']}", offset=HEAD.itemsize)))
    return rows


# ---- data source -----------------------------------------------------------------------------------------------------

def located(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a URI or an absolute path."""
    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path[5:]
    return pafs.FileSystem.from_uri(path)


@dataclass
class Written(WriterCommitMessage):
    partition: int
    name: str
    records: int
    tokens: int
    size: int


@dataclass
class Piece(InputPartition):
    file: int
    name: str
    first: int
    records: int
    size: int
    start: int

    def __post_init__(self):
        super().__init__(self.file)


class RecordWriter(DataSourceArrowWriter):
    """Rows (doc_id long, ids binary), or (doc_id long, text string) to be encoded, in the order of their partitions; one data
    file and one index a partition."""

    def __init__(self, path: str, width: int, tokenizer: str | None, end_id: int | None):
        self.path, self.width, self.tokenizer = path, width, tokenizer
        self.end = b"" if end_id is None else end_id.to_bytes(width, "little")
        fs, at = located(path)
        if fs.get_file_info(f"{at}/{MANIFEST}").type != pafs.FileType.NotFound:
            raise ValueError(f"{path} already holds token records")
        fs.create_dir(at, recursive=True)

    def sequences(self, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[bytes]]]:
        """(ids of documents, their token ids as bytes) in steps of bounded size."""
        if self.tokenizer:
            encoder = encoder_of(self.tokenizer)
            encoder.begun()
            for ids, texts in steps(batches):
                yield ids, [row + self.end for row in encoder.encode([t or "" for t in texts])]
            return
        for batch in batches:
            row, lengths = 0, pc.binary_length(batch.column(1)).to_numpy(zero_copy_only=False)
            while row < batch.num_rows:
                n = max(1, int(np.searchsorted(np.cumsum(lengths[row:]), STEP_IDS * self.width, side="right")))
                yield batch.column(0).slice(row, n).to_pylist(), batch.column(1).slice(row, n).to_pylist()
                row += n

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        from pyspark import TaskContext

        part, (fs, at), crc = TaskContext.get().partitionId(), located(self.path), Crc32c()
        name = f"part-{part:06d}-{uuid.uuid4().hex}"
        records, tokens, size, data, index = 0, 0, 0, None, None
        for ids, sequences in self.sequences(iterator):
            pieces, sizes = frames(crc, ids, sequences, self.width)
            if data is None:
                data, index = fs.open_output_stream(f"{at}/{name}.rec"), fs.open_output_stream(f"{at}/{name}.idx")
            entries = np.zeros(len(sizes), INDEX)
            entries["offset"] = size + np.cumsum(sizes) - sizes
            entries["n"] = [len(s) // self.width for s in sequences]
            data.write(b"".join(pieces))
            index.write(entries.tobytes())
            records, size, tokens = records + len(sizes), size + int(sizes.sum()), tokens + int(entries["n"].sum())
        for f in (data, index):
            if f is not None:
                f.close()
        return Written(part, name, records, tokens, size)

    def commit(self, messages: list) -> None:
        fs, at = located(self.path)
        done = sorted((m for m in messages if m is not None and m.records), key=lambda m: m.partition)
        listed = [{"name": m.name, "records": m.records, "tokens": m.tokens, "size": m.size} for m in done]
        with fs.open_output_stream(f"{at}/{MANIFEST}") as out:
            out.write(json.dumps({"width": self.width, "files": listed}).encode())

    def abort(self, messages: list) -> None:
        fs, at = located(self.path)
        for m in messages:
            for end in ("rec", "idx"):
                if m is not None and fs.get_file_info(f"{at}/{m.name}.{end}").type == pafs.FileType.File:
                    fs.delete_file(f"{at}/{m.name}.{end}")


def manifest(path: str) -> dict:
    fs, at = located(path)
    with fs.open_input_stream(f"{at}/{MANIFEST}") as f:
        return json.loads(f.read())


class RecordReader(DataSourceReader):
    """Records in order with their global start, checksums verified; with ``what=index`` the places of the records only."""

    def __init__(self, path: str, what: str, part_bytes: int):
        self.path, self.what, self.part_bytes = path, what, part_bytes

    def partitions(self) -> list[Piece]:
        pieces, start = [], 0
        for k, f in enumerate(manifest(self.path)["files"]):
            per = -(-f["records"] // max(1, -(-f["size"] // self.part_bytes)))
            pieces += [Piece(k, f["name"], first, min(per, f["records"] - first), f["size"], start) for first in range(0, f["records"], per)]
            start += f["tokens"]
        return pieces or [Piece(0, "", 0, 0, 0, 0)]

    def read(self, piece: Piece) -> Iterator[pa.RecordBatch]:
        if not piece.records:
            return
        (fs, at), crc = located(self.path), Crc32c()
        with fs.open_input_file(f"{at}/{piece.name}.idx") as f:  # the entries before give the first id's position
            index = np.frombuffer(f.read((piece.first + piece.records) * INDEX.itemsize), INDEX)
            after = f.read(INDEX.itemsize)
        end = int(np.frombuffer(after, INDEX)["offset"][0]) if after else piece.size
        start = piece.start + int(index["n"][:piece.first].sum())
        index = index[piece.first:]
        sizes = np.diff(np.append(index["offset"], np.uint64(end)).astype(np.int64))
        starts = start + np.cumsum(index["n"]).astype(np.int64) - index["n"].astype(np.int64)
        with fs.open_input_file(f"{at}/{piece.name}.rec") as f:
            row = 0
            while row < len(index):
                n = max(1, int(np.searchsorted(np.cumsum(sizes[row:]), STEP_IDS * 2, side="right")))
                s = slice(row, row + n)
                cols = [np.full(len(index[s]), piece.file, np.int32), np.arange(piece.first + row, piece.first + row + len(index[s])),
                        starts[s], index["n"][s].astype(np.int64)]
                if self.what == "index":
                    yield pa.RecordBatch.from_arrays([pa.array([piece.name] * len(cols[0])), *map(pa.array, cols), pa.array(index["offset"][s].astype(np.int64)),
                                                      pa.array(sizes[s])], names=["name", "file", "record", "start", "n_tokens", "offset", "size"])
                else:
                    rows = unframed(crc, f.read_at(int(sizes[s].sum()), int(index["offset"][row])), sizes[s].tolist(), piece.name)
                    ids = [r[1] for r in rows]
                    arrays = [*map(pa.array, cols), pa.array([r[0] for r in rows], pa.int64())]
                    arrays.append(pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in ids], pa.int64()))
                    names = ["file", "record", "start", "n_tokens", "doc_id", "ids_crc32"]
                    if self.what == "ids":
                        arrays, names = [*arrays, pa.array(ids, pa.list_(pa.int32()))], [*names, "ids"]
                    yield pa.RecordBatch.from_arrays(arrays, names=names)
                row += n


class TokenRecords(DataSource):
    """``format("token_records")``. Options: ``path``; for writing ``width`` (bytes per id) and, where the rows are texts, ``tokenizer`` and ``end_id``; ``what`` = ``ids`` (default), ``digest`` or ``index``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        what = self.options.get("what", "ids")
        if what == "index":
            return "name string, file int, record long, start long, n_tokens long, offset long, size long"
        return "file int, record long, start long, n_tokens long, doc_id long, ids_crc32 long" + (", ids array<int>" if what == "ids" else "")

    def reader(self, schema) -> DataSourceReader:
        return RecordReader(self.options["path"], self.options.get("what", "ids"), int(self.options.get("part_bytes", PART_BYTES)))

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        end = self.options.get("end_id")
        return RecordWriter(self.options["path"], int(self.options["width"]), self.options.get("tokenizer"), int(end) if end else None)


# ---- encoding --------------------------------------------------------------------------------------------------------

def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def cuts_at_blanks(spec: dict) -> bool:
    """Whether a tokenizer file gives the same ids for a text and for its blank-separated words one after another.

    True where the normaliser works on characters and white space alone, the pre-tokeniser drops white space, no pattern or
    added token can hold a blank and nothing is put around a text.
    """
    norm = spec["normalizer"] or {"type": "Sequence", "normalizers": []}
    norms = norm.get("normalizers", [norm])
    plain = all(n["type"] in ("NFC", "Lowercase") or (n["type"] == "Replace" and n["pattern"] == {"Regex": "\\s+"} and n["content"] == " ") for n in norms)
    pre = spec["pre_tokenizer"] or {}
    split = pre.get("pretokenizers", [pre])[0]
    pattern = split.get("pattern", {}).get("Regex", " ").replace("[^\\s", "")
    drops = split.get("type") == "Split" and split["behavior"] == "Removed" and split["invert"] and not any(x in pattern for x in (" ", "\\s", ".", "[^"))
    rest = all(p["type"] == "ByteLevel" and not p["add_prefix_space"] and not p["use_regex"] for p in pre.get("pretokenizers", [pre])[1:])
    added = all(" " not in a["content"] and "\n" not in a["content"] and not (a["lstrip"] or a["rstrip"] or a["single_word"]) for a in spec["added_tokens"])
    return bool(plain and drops and rest and added and spec["post_processor"] is None and not spec["model"].get("dropout"))


class WordEncoder:
    """Ids of whole texts as bytes. Where the tokenizer lets words be told apart, a word is looked up in a table; a word that
    is not there is cut into its pieces where the pattern is the known one, and new pieces are encoded together."""

    def __init__(self, file: str, table_words: int = TABLE_WORDS, table_pieces: int = TABLE_PIECES):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(file)
        with open(file, encoding="utf-8") as f:
            spec = json.load(f)
        self.by_word = cuts_at_blanks(spec)
        known = self.by_word and spec["pre_tokenizer"]["pretokenizers"][0]["pattern"] == {"Regex": PIECES} and \
            [n["type"] for n in spec["normalizer"]["normalizers"]] == ["NFC", "Replace", "Lowercase"]
        self.added = re.compile("|".join(re.escape(a["content"]) for a in spec["added_tokens"]) or "(?!)")
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.words: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}
        self.table_words, self.table_pieces = table_words, table_pieces
        mark = self.ids(f" {BETWEEN} ")
        self.mark = mark[0] if len(mark) == 1 else None
        self.cuts = bool(known and self.mark is not None)
        self.asked, self.missed = 0, 1
        self.begun()

    def begun(self) -> None:
        """At the start of a task: tables that lacked a quarter of the last task's words start anew."""
        if 4 * self.missed > self.asked:
            self.words.clear()
            self.parts.clear()
            self.words[""] = b""
            if self.cuts:
                self.parts["\n"] = self.mark.tobytes()
        self.asked = self.missed = 0

    def ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, f"<u{self.width}")

    def between_marks(self, ids: np.ndarray) -> list[bytes]:
        raw, step = ids.tobytes(), self.width
        ends = [-step, *(np.flatnonzero(ids == self.mark) * step).tolist(), len(raw)]
        return [raw[a + step:b] for a, b in zip(ends, ends[1:], strict=False)]

    def called(self, words: list[str]) -> list[bytes]:
        """Ids of each word from one call a few thousand words: a character of its own token stands between two words."""
        found: list[bytes] = []
        for at in range(0, len(words), CALL_WORDS):
            some = words[at:at + CALL_WORDS]
            if self.mark is not None and not any(BETWEEN in w for w in some):
                rows = self.between_marks(self.ids(f" {BETWEEN} ".join(some)))
                if len(rows) == len(some):
                    found += rows
                    continue
            found += [self.ids(w).tobytes() for w in some]
        return found

    def called_pieces(self, pieces: list[str]) -> list[bytes]:
        """Ids of pieces as ``PIECES`` cuts them: nothing before the library's model would change or divide them, so it alone
        is called; printable ASCII stands for itself in its vocabulary."""
        tokenize, kind = self.tokenizer.model.tokenize, "H" if self.width == 2 else "I"
        spelt = (p if p.isascii() else p.encode().decode("latin-1").translate(BYTES) for p in pieces)
        return [array(kind, [t.id for t in tokenize(p)]).tobytes() for p in spelt]

    def trimmed(self, table: dict[str, bytes], fresh: dict[str, bytes], most: int) -> None:
        """Nothing is added to a full table: frequent words come early."""
        for w in fresh if len(table) > most else [w for w in fresh if len(w) > LONG]:
            del table[w]

    def encoded_words(self, words: list[str]) -> dict[str, bytes]:
        """Ids of words that the table lacks."""
        if not self.cuts:
            return dict(zip(words, self.called(words), strict=True))
        fits, added, normal, parts = LATIN.fullmatch, self.added.search, unicodedata.is_normalized, self.parts
        latin = [w for w in words if fits(w) and (w.isascii() or normal("NFC", w)) and not added(w)]
        rest = list(set(words).difference(latin)) if len(latin) < len(words) else []
        pieces = LATIN_PIECES.findall("\n".join(latin).lower())
        new = list(set(pieces).difference(parts))
        found = self.called(rest)
        fresh = dict(zip(new, self.called_pieces(new), strict=True))
        parts.update(fresh)
        rows = self.between_marks(np.frombuffer(b"".join(map(parts.__getitem__, pieces)), f"<u{self.width}")) if latin else []
        self.trimmed(parts, fresh, self.table_pieces)
        return dict(zip(latin, rows, strict=True)) | dict(zip(rest, found, strict=True))

    def encode(self, texts: list[str]) -> list[bytes]:
        if not self.by_word:
            return [self.ids(t).tobytes() for t in texts]
        cut, table = [(t.replace("\n", " ") if "\n" in t else t).split(" ") for t in texts], self.words
        new = set().union(*cut).difference(table)
        fresh = self.encoded_words(list(new)) if new else {}
        table.update(fresh)
        rows = [b"".join(map(table.__getitem__, words)) for words in cut]
        self.asked, self.missed = self.asked + sum(map(len, cut)), self.missed + len(fresh)
        self.trimmed(table, fresh, self.table_words)
        return rows


_ENCODERS: dict[str, WordEncoder] = {}


def encoder_of(file: str) -> WordEncoder:
    """The encoder of this process, its file read once."""
    if file not in _ENCODERS:
        _ENCODERS[file] = WordEncoder(file)
    return _ENCODERS[file]


def write_texts(docs: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None,
                end_id: int | None = END_ID) -> None:
    """Encode every whole text and write the records in ascending id order; texts are shuffled once, by ranges of ids."""
    spark = docs.sparkSession
    spark.dataSource.register(TokenRecords)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    ordered = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie", "text")
    file = tokenizer or default_tokenizer()
    out = ordered.select("doc_id", "text").write.format(FORMAT).option("width", WordEncoder(file).width).option("tokenizer", file)
    (out if end_id is None else out.option("end_id", end_id)).mode("append").save(path)


def write_sequences(rows: DataFrame, path: str, *, width: int = 2) -> None:
    """Write ``(doc_id long, ids array<int>)`` in ascending id order (repeated ids by their sequence); null ids are empty."""
    spark = rows.sparkSession
    spark.dataSource.register(TokenRecords)
    # least significant byte first
    hexed = F.transform(F.coalesce("ids", F.array().cast("array<int>")), lambda x: F.concat(*[
        F.lpad(F.hex(F.shiftright(x, 8 * k).bitwiseAND(255)), 2, "0") for k in range(width)]))
    ids = rows.select(F.col("doc_id").cast("long").alias("doc_id"), F.unhex(F.array_join(hexed, "")).alias("ids"))
    ordered = ids.withColumn("tie", F.xxhash64("ids")).repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie", "ids")
    ordered.select("doc_id", "ids").write.format(FORMAT).option("width", width).mode("append").save(path)


def read_records(spark: SparkSession, path: str, *, what: str = "ids", part_bytes: int = PART_BYTES) -> DataFrame:
    """The records of a folder with their global ``start``; large files are read by several tasks."""
    spark.dataSource.register(TokenRecords)
    return spark.read.format(FORMAT).option("what", what).option("part_bytes", part_bytes).load(path)


def read_shuffled(spark: SparkSession, path: str, seed: int) -> DataFrame:
    """All records in an order drawn by ``seed``: the index is shuffled, the records are fetched at their offsets."""
    places = read_records(spark, path, what="index").withColumn("draw", F.xxhash64(F.lit(seed), "file", "record"))
    places = places.repartitionByRange("draw", "file", "record").sortWithinPartitions("draw", "file", "record")

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (fs, at), crc, held = located(path), Crc32c(), {}
        for batch in batches:
            for name, record, offset, size in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if name not in held:
                    if len(held) > 64:
                        held.popitem()[1].close()
                    held[name] = fs.open_input_file(f"{at}/{name}.rec")
                doc_id, ids = unframed(crc, held[name].read_at(size, offset), [size], name)[0]
                yield pa.RecordBatch.from_arrays([pa.array([doc_id], pa.int64()), pa.array([name]), pa.array([record], pa.int64()),
                                                  pa.array([ids], pa.list_(pa.int32()))], names=["doc_id", "name", "record", "ids"])

    return places.select("name", "record", "offset", "size").mapInArrow(fetch, "doc_id long, name string, record long, ids array<int>")


def written_and_read(docs: DataFrame) -> DataFrame:
    """Write the records of ``docs`` to the shared checkpoint folder and read them back: positions, sizes and checksums."""
    path = f"{checkpoint_dir(docs.sparkSession).rstrip('/')}/token-records-{uuid.uuid4().hex}"
    write_texts(docs, path)
    return read_records(docs.sparkSession, path, what="digest")

"""SentencePiece encoding and decoding through a table of distinct chunks.

No piece of the model crosses from a non-marker character to the whitespace marker (checked when the model is loaded),
so a merge never joins two chunks "markers + following characters" and each distinct chunk can be segmented once, with
its ids joined back by position. The table is one per task: a chunk is segmented once by a task, the table is emptied
beyond ``TABLE_CHUNKS`` distinct chunks, and no word is shuffled.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmart.llm.common import steps

MARK = "▁"
#: Distinct chunks that a task's table holds before it starts anew; longer chunks than LONG characters are not kept.
TABLE_CHUNKS = 60_000
LONG = 64
CHUNK = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class ChunkCodec:
    """Encoder and decoder of one task. The table's keys are chunks without their first marker, which every chunk has."""

    def __init__(self, model: str, table_chunks: int = TABLE_CHUNKS):
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_file=model)
        if any(MARK in self.sp.id_to_piece(i).lstrip(MARK) for i in range(self.sp.get_piece_size())):
            raise ValueError("a piece of this model crosses a whitespace marker: chunks are not independent")
        if self.sp.encode("  a", out_type=str) != [MARK * 2, f"{MARK}a"]:
            raise ValueError("this model's normaliser changes white space: chunks can't be told apart")
        self.table: dict[str, tuple[list[int], str]] = {}
        self.table_chunks = table_chunks

    def chunks(self, text: str) -> list[str]:
        """The marked text (one marker in front, as the library adds) cut before each run of markers."""
        if not text:
            return []
        words = text.split(" ")
        if MARK in text or "" in words:  # runs of markers belong to the chunk that follows them
            return [c[1:] for c in CHUNK.findall(MARK + text.replace(" ", MARK))]
        return words

    def segmented(self, chunks: list[str]) -> list[tuple[list[int], str]]:
        """Ids of each chunk, and the same as joined numbers; chunks that the table lacks are segmented once."""
        rows = list(map(self.table.get, chunks))
        if None in rows:
            new = list(dict.fromkeys(c for c, r in zip(chunks, rows, strict=True) if r is None))
            # the library puts a marker before what it is given; for a lone marker it would be given an empty text
            found = {c: ids or [self.sp.piece_to_id(MARK)] for c, ids in zip(new, self.sp.encode(new, num_threads=1), strict=True)}
            fresh = {c: (ids, ",".join(map(str, ids))) for c, ids in found.items()}
            rows = [fresh[c] if r is None else r for c, r in zip(chunks, rows, strict=True)]
            if len(self.table) + len(fresh) > self.table_chunks:
                self.table.clear()
            self.table.update((c, r) for c, r in fresh.items() if len(c) <= LONG)
        return rows

    def encode(self, text: str | None) -> tuple[list[int], str]:
        """Ids, and the same as decimal numbers joined by commas."""
        rows = self.segmented(self.chunks(text or ""))
        return list(chain.from_iterable([ids for ids, _ in rows])), ",".join([joined for _, joined in rows])

    def decode(self, ids: list[int]) -> str:
        return self.sp.decode(ids) if ids else ""


def encode_texts(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                 model: str | None = None, with_ids: bool = True) -> DataFrame:
    """Encode and decode every whole text: ``(<id_col>, n_tokens, ids?, ids_sha256, decoded_sha256, decoded?)``.

    One row per input row, repeated ids included. A null text counts as empty: no ids, the digests of the empty
    string. Other columns of the input are not read. ``with_ids=False`` leaves ``ids`` and ``decoded`` out.
    Narrow: no shuffle; a task holds one step of texts and its bounded table.
    """
    model = model or default_model()
    kind = dict(docs.dtypes)[id_col]
    fields = f"`{id_col}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>, decoded string" if with_ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, digest = ChunkCodec(model), lambda s: hashlib.sha256(s.encode("utf-8")).hexdigest()
        for ids, texts in steps(batches):
            rows = []
            for t in texts:
                got, joined = codec.encode(t)
                text = codec.decode(got)
                rows.append((len(got), digest(joined), digest(text), *((got, text) if with_ids else ())))
            cols = list(zip(*rows, strict=True))
            arrays = [pa.array(ids, batch_type[0]), pa.array(cols[0], pa.int64()), pa.array(cols[1]), pa.array(cols[2])]
            if with_ids:
                arrays += [pa.array(cols[3], pa.list_(pa.int32())), pa.array(cols[4])]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    from pyspark.sql.pandas.types import to_arrow_type

    narrow = docs.select(F.col(id_col), F.col(text_col))
    batch_type = [to_arrow_type(narrow.schema[0].dataType)]
    names = [id_col, "n_tokens", "ids_sha256", "decoded_sha256", *(["ids", "decoded"] if with_ids else [])]
    return narrow.mapInArrow(run, fields)

import random
import uuid
import zlib
from array import array
from pathlib import Path

import numpy as np
import pytest
from tokenizers import Tokenizer

from tests.llm.helpers import documents, table
from textmart.llm import token_records as R
from textmart.session import checkpoint_dir

FILE = R.default_tokenizer()
TOKENIZER = Tokenizer.from_file(FILE)


def ids_of(text):
    return [*TOKENIZER.encode(text or "", add_special_tokens=False).ids, 1]


def crc_of(ids):
    return zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))


def slow_crc32c(data):
    c = 0xFFFFFFFF
    for b in data:
        c ^= b
        for _ in range(8):
            c = (c >> 1) ^ (0x82F63B78 if c & 1 else 0)
    return c ^ 0xFFFFFFFF


def folder(spark):
    return f"{checkpoint_dir(spark)}/records-{uuid.uuid4().hex}"


def expected(rows):
    out, start = [], 0
    for r in sorted(rows, key=lambda r: (r.doc_id is not None, r.doc_id or 0)):
        ids = ids_of(r.text)
        out.append((r.doc_id, start, len(ids), crc_of(ids)))
        start += len(ids)
    return out


def test_checksums():
    rng, crc = random.Random(1), R.Crc32c()
    parts = [rng.randbytes(2 * rng.choice([2, 3, 4, 5, 7, 8, 31, 64, 1000])) for _ in range(60)]
    got = crc.of(np.frombuffer(b"".join(parts), "<u2"), np.array([len(p) // 2 for p in parts]))
    assert got.tolist() == [slow_crc32c(p) for p in parts]
    assert slow_crc32c(b"123456789") == 0xE3069283


def test_words_give_the_librarys_ids():
    encoder, rng = R.WordEncoder(FILE, table_words=40, table_pieces=30), random.Random(5)
    assert encoder.by_word and encoder.width == 2 and encoder.cuts
    parts = ["a", "B", " ", "  ", "'s", "ΣΑΣ", "\n", "é", "é", "́", " ", " ", "\t", "日", "😀", "<|endoftext|>", "<|end", "12", "İ", ".", "\x01", "\x02", "²", "ª", "_", "\x85", "\xad", "'", "ll", "e\u0301", "É", "ŉ", "ǅ", "!?"]
    for _ in range(4000):
        t = "".join(rng.choice(parts) for _ in range(rng.randrange(14)))
        assert array("H", encoder.encode([t])[0]).tolist() == TOKENIZER.encode(t, add_special_tokens=False).ids, t
    some = ["".join(rng.choice(parts) for _ in range(rng.randrange(14))) for _ in range(300)]
    assert [array("H", r).tolist() for r in encoder.encode(some)] == [TOKENIZER.encode(t, add_special_tokens=False).ids for t in some]
    words = ["".join(rng.choice(parts[:4] + parts[8:]).strip() or "x" for _ in range(rng.randrange(1, 9))) for _ in range(9000)]
    text = " ".join(w for w in words if "\x01" not in w)
    assert array("H", encoder.encode([text])[0]).tolist() == TOKENIZER.encode(text, add_special_tokens=False).ids


def test_pieces_need_the_model_alone():
    encoder, rng = R.WordEncoder(FILE), random.Random(6)
    letters = [c for c in map(chr, range(0x21, 0x250)) if R.LATIN.fullmatch(c)]
    words = [c for c in letters if not c.isupper()] + ["".join(rng.choices(letters, k=rng.randrange(1, 12))) for _ in range(4000)]
    pieces = sorted({p for w in words for p in R.LATIN_PIECES.findall(w.lower())})
    calls = []
    whole, encoder.called = encoder.called, lambda some: calls.append(some) or whole(some)
    got = encoder.called_pieces(pieces)
    assert [array("H", g).tolist() for g in got] == [TOKENIZER.encode(p, add_special_tokens=False).ids for p in pieces]
    assert encoder.called_pieces([]) == [] and encoder.encode(["plain words, caf\u00e9s"]) and not any(calls)


def test_awkward_rows_round_trip_and_shuffled_read(spark):
    docs, path = documents(spark), folder(spark)
    R.write_texts(docs, path)
    for size in (1, R.PART_BYTES):
        rows = sorted(R.read_records(spark, path, part_bytes=size).collect(), key=lambda r: r.start)
        assert [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in rows] == expected(docs.collect())
        assert all(crc_of(r.ids) == r.ids_crc32 and len(r.ids) == r.n_tokens for r in rows)
    drawn = [(r.doc_id, *r.ids) for r in R.read_shuffled(spark, path, 7).collect()]
    assert sorted(drawn, key=repr) == sorted(((r.doc_id, *r.ids) for r in rows), key=repr)
    assert drawn == [(r.doc_id, *r.ids) for r in R.read_shuffled(spark, path, 7).collect()] != [(r.doc_id, *r.ids) for r in rows]
    assert R.written_and_read(docs.limit(0)).count() == 0
    with pytest.raises(Exception, match="already holds"):
        R.write_texts(docs, path)


def test_file_format_and_damage(spark):
    docs = spark.createDataFrame([(5, "Hello there"), (-2, None)], "doc_id long, text string").coalesce(1)
    path = folder(spark)
    R.write_texts(docs, path)
    files = R.manifest(path)["files"]
    raw = b"".join(Path(path.removeprefix("file:"), f["name"] + ".rec").read_bytes() for f in files)

    def masked(data):
        c = slow_crc32c(data)
        return ((((c >> 15) | (c << 17)) + 0xA282EAD8) & 0xFFFFFFFF).to_bytes(4, "little")

    want = b""
    for doc_id, text in [(-2, ""), (5, "Hello there")]:
        payload = b"\x02\x00\x00\x00" + doc_id.to_bytes(8, "little", signed=True) + array("H", ids_of(text)).tobytes()
        size = len(payload).to_bytes(8, "little")
        want += size + masked(size) + payload + masked(payload)
    assert raw == want
    victim = Path(path.removeprefix("file:"), files[-1]["name"] + ".rec")
    data = bytearray(victim.read_bytes())
    data[-6] ^= 1
    victim.write_bytes(data)
    with pytest.raises(Exception, match="checksum failed"):
        R.read_records(spark, path).collect()


def test_given_sequences(spark):
    rows = [(3, [5, 49407, 65535]), (1, []), (None, [7]), (2, None), (3, [5, 49407, 65535]), (-4, list(range(3000)))]
    for width in (2, 4):
        path = folder(spark)
        R.write_sequences(spark.createDataFrame(rows, "doc_id long, ids array<int>"), path, width=width)
        got = [(r.doc_id, r.ids) for r in sorted(R.read_records(spark, path).collect(), key=lambda r: (r.file, r.record))]
        assert got == [(i, ids or []) for i, ids in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))]


def test_whole_table(spark):
    docs = table(spark, "documents")
    got = sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in R.written_and_read(docs).collect())
    assert got == expected(docs.collect())

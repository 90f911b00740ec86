import hashlib
import random

import public_tokenizers
import sentencepiece

from tests.llm.helpers import documents, table
from textmart.llm.sentencepiece_codec import ChunkCodec, encode_texts

MODEL = public_tokenizers.path("piece_bpe_32k.model")
SP = sentencepiece.SentencePieceProcessor(model_file=MODEL)


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def expected(text):
    ids = SP.encode(text or "")
    return len(ids), sha(",".join(map(str, ids))), sha(SP.decode(ids) if ids else "")


def test_chunks_give_the_librarys_ids():
    codec, rng = ChunkCodec(MODEL, table_chunks=50), random.Random(3)
    parts = ["a", "b", " ", "  ", "▁", "the", "\n", "é", "\x00", "\t", "日", "😀", "<s>", "<0x0A>", "    "]
    for _ in range(5000):
        t = "".join(rng.choice(parts) for _ in range(rng.randrange(14)))
        assert codec.encode(t)[0] == SP.encode(t), t


def test_awkward_rows_and_round_trip(spark):
    rows = documents(spark)
    got = sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in encode_texts(rows).collect())
    assert got == sorted((str(r.doc_id), *expected(r.text)) for r in rows.collect())
    for r in encode_texts(rows).collect():
        assert len(r.ids) == r.n_tokens and r.decoded == (SP.decode(r.ids) if r.ids else "")
    assert encode_texts(rows.limit(0)).count() == 0


def test_whole_table(spark):
    docs = table(spark, "documents")
    got = {r.doc_id: tuple(r)[1:] for r in encode_texts(docs, with_ids=False).collect()}
    assert got == {r.doc_id: expected(r.text) for r in docs.collect()}

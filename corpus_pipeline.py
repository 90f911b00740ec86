"""Training-data pipeline: language identification, near-duplicates, decontamination, secrets, tokens.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is written as Parquet and reread for the next
one; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmart.llm import decontam, langid, secrets, simhash
from textmart.llm.common import table
from textmart.llm.sentencepiece_codec import encode_texts
from textmart.session import cut_lineage

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the language models reject; a missing language becomes the predicted one.

    The verdict is computed on a column of the document itself, so no join is needed.
    """
    model = langid.train(docs)
    keyed = docs.select(F.struct("doc_id", "lang", "source", "n_chars").alias("doc"), "text")
    found = langid.identify(keyed, model, id_col="doc", text_col="text", keep_text=True).filter("not rejected")
    return found.select("doc.doc_id", "text", F.coalesce(F.col("doc.lang"), F.col("lang_pred")).alias("lang"), "doc.source", "doc.n_chars")


def numbered(docs: DataFrame) -> DataFrame:
    """The rows with a name of their own, ``row``: their file (by a hash of its path) and their place in it.

    Ids may be missing or repeated. A stage's input is a Parquet table, whose places stay the same in every scan; rows from
    elsewhere are written first.
    """
    place = F.struct(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at")).alias("row")
    try:
        return docs.select(*COLUMNS, place)
    except AnalysisException:  # no file behind the rows
        return cut_lineage(docs.select(*COLUMNS)).select(*COLUMNS, place)


def without(rows: DataFrame, gone: DataFrame) -> DataFrame:
    """``rows`` less those named in ``gone(row)``.

    A bitmap of fixed size over the names says which rows may be gone; the others stay without a shuffle of their texts.
    """
    gone = cut_lineage(gone.select("row").distinct())
    h, bits = F.xxhash64("row"), decontam.bitmap(gone.select(F.xxhash64("row").alias("hash")))
    word = F.get(bits, F.shiftright(h.bitwiseAND(F.lit(decontam.BITMAP_BITS - 1)), 6).cast("int"))
    may = F.coalesce(F.getbit(word, h.bitwiseAND(F.lit(63)).cast("int")) == 1, F.lit(True))
    stay = rows.filter(~may).select(*COLUMNS)
    return stay.unionByName(rows.filter(may).join(gone, "row", "left_anti").select(*COLUMNS))


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row, the one with the smallest id, of each group of near-duplicates (three words, two bits).

    Rows are judged by their texts alone: rows that repeat an id stay if their texts differ, rows without an id take part
    and come after those with one.
    """
    rows = numbered(docs)
    keyed = rows.select(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row").alias("key"), "text")
    found = simhash.near_duplicates(keyed, id_col="key", shingle=3, max_bits=2).filter("key <> component_id")
    return without(rows, found.select("key.row"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop rows that leak a benchmark item, each judged by its own text, with or without an id."""
    rows = numbered(docs)
    return without(rows, decontam.leaks(rows, table(spark, sf_dir, "benchmark"), id_col="row"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace every secret by ``[SECRET]``; all documents stay, ``n_chars`` follows the text."""
    keyed = docs.select(F.struct("doc_id", "lang", "source", "n_chars").alias("doc"), "text")
    found = secrets.find_secrets(keyed, secrets.train(docs), id_col="doc", text_col="text", keep_text=True)
    text, changed = F.col("redacted_text"), F.size("spans") > 0
    n_chars = F.when(changed, F.length(text).cast("long")).otherwise(F.col("doc.n_chars"))
    return found.select("doc.doc_id", text.alias("text"), "doc.lang", "doc.source", n_chars.alias("n_chars"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with the digests that show the round trip."""
    return encode_texts(docs, with_ids=True).select("doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256")


STAGES = [("language ID", language_id), ("SimHash near-dedup", simhash_dedup), ("benchmark decontamination", decontaminate),
          ("secret scans", redact_secrets), ("SentencePiece encoding and decoding", tokenize)]

#: Trained models and tokenising can't be said in SQL; tests/llm compares with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared checkpoint folder and reread."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)

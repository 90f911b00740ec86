"""Registered queries of the operators, with their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmart.llm import decontam, merkle, url_filter
from textmart.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn
    return deco


@register("op2_sentencepiece")
def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    from textmart.llm.sentencepiece_codec import encode_texts

    return encode_texts(table(spark, sf_dir, "documents"), with_ids=False)


@register("op7_simhash")
def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from textmart.llm.simhash import near_duplicates

    found = near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_bits=2)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@register("op9_secrets")
def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from textmart.llm.secrets import find_secrets, span_text, train

    docs = table(spark, sf_dir, "documents")
    found, spans = find_secrets(docs, train(docs)), F.col("spans")
    count = lambda kind: F.size(F.filter(spans, lambda x: x["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
        F.sha2(span_text(spans, base_only=True), 256).alias("base_sha256"), span_text(spans, base_only=False).alias("spans"),
        count("model").alias("n_model"))


@register("op3_language_id")
def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from textmart.llm.langid import held_out, identify, train

    docs = table(spark, sf_dir, "documents")
    found = identify(docs, train(docs))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "cross_entropy", "n_symbols", "rejected")


@register("op10_decontamination", decontam.duck_sql())
def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register("op4_url_filter", url_filter.duck_sql())
def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page is labelled by the quality of the document whose number ends its path."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    labels = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.min("quality").alias("good"))
    number = F.regexp_extract(url_filter.path_of(F.col("url")), "([0-9]+)[^0-9/]*/?$", 1).try_cast("long")
    pages = pages.withColumn("doc_id", number).join(labels, "doc_id", "left")
    return url_filter.judge(pages, label_col="good")


@register("op8_html_text")
def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from textmart.llm.html_extract import extract, train

    pages = table(spark, sf_dir, "pages")
    return extract(pages, train(pages))


@register("op6_chunk_dedup")
def op6_chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from textmart.llm.chunk_dedup import deduplicate

    found = deduplicate(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_chunks", "n_removed", F.size("spans").cast("long").alias("n_spans"),
                        F.sha2("kept_text", 256).alias("kept_sha256"))


EMBEDDING_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
      WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT reach.a, l.b FROM reach JOIN l ON l.a = reach.b),
c AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
n AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT vec_id, coalesce(n.n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN c ON c.a = vec_id LEFT JOIN n ON n.a = vec_id"""


@register("op1_embedding_dedup", EMBEDDING_SQL)
def op1_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from textmart.llm.embed_dedup import fit, near_duplicates

    vectors = table(spark, sf_dir, "embeddings")
    return near_duplicates(vectors, fit(vectors, threshold=0.93), threshold=0.93)


@register("op5_suffix_dedup")
def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from textmart.llm.suffix_dedup import deduplicate

    found = deduplicate(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@register("op11_merkle_manifest", merkle.duck_sql())
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.tamper_proof_report(table(spark, sf_dir, "documents"))


@register("op12_token_records")
def op12_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    from textmart.llm.token_records import written_and_read

    return written_and_read(table(spark, sf_dir, "documents")).select("doc_id", "start", "n_tokens", "ids_crc32")


@register("op13_whitening")
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``deviation`` is null beyond the range of a long (``whiten`` returns it as decimal)."""
    from textmart.llm.whitening import fit, whiten

    vectors = table(spark, sf_dir, "embeddings")
    return whiten(vectors, fit(vectors)).withColumn("deviation", F.col("deviation").try_cast("long"))

"""Record extraction from stored web pages (S8-S11, J4), as native regex jobs.

Pages are rows ``(page_id, url, html)``; extraction is a per-row
``regexp_extract``/``regexp_extract_all`` pipeline (no Python worker, no
DOM). Semantics: the container is the first element matching the container
tag; ``<script>``/``<style>`` bodies are dropped first (they may contain tag
look-alikes); a paragraph runs from its opening tag to the next paragraph
tag, its closing tag or the container end (HTML5 implicit closing); tags are
removed, common entities decoded, blanks trimmed, empty paragraphs dropped
and the rest joined with a blank line. A page without container yields the
sentinel text and status ``not_found`` (S11 splits good and bad rows).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmart import dictionaries as D
from textmart.operators.joins import first_prefix_match

# Entities decoded in extracted text (fixed list; '&amp;' last so that it is not decoded twice).
ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "),
            ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&")]


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_code(html: str | Column) -> Column:
    """Drop comments, ``<script>`` and ``<style>`` elements with their bodies."""
    h = F.coalesce(_col(html), F.lit(""))
    h = F.regexp_replace(h, r"(?s)<!--.*?-->", " ")
    h = F.regexp_replace(h, r"(?is)<script\b[^>]*>.*?</script\s*>", " ")
    return F.regexp_replace(h, r"(?is)<style\b[^>]*>.*?</style\s*>", " ")


def decode_entities(text: Column) -> Column:
    for ent, ch in ENTITIES:
        text = F.replace(text, F.lit(ent), F.lit(ch))
    return text


def inner_text(fragment: Column) -> Column:
    """Tags removed, entities decoded, outer whitespace trimmed."""
    t = F.regexp_replace(fragment, r"<[^>]*>", "")
    return F.regexp_replace(decode_entities(t), r"^\s+|\s+$", "")


def element_text(html: str | Column, tag: str) -> Column:
    """Inner text of the first ``<tag>`` element (null when absent)."""
    m = F.regexp_extract(strip_code(html), rf"(?is)<{tag}\b[^>]*>(.*?)</{tag}\s*>", 1)
    return F.when(m != "", inner_text(m))


def container(html: str | Column, tag: str = "article") -> Column:
    """Markup inside the first container element; null when there is none."""
    h = strip_code(html)
    has = h.rlike(rf"(?is)<{tag}\b")
    body = F.regexp_extract(h, rf"(?is)<{tag}\b[^>]*>(.*?)(?:</{tag}\s*>|$)", 1)
    return F.when(has, body)


def paragraphs(markup: Column, tags: Sequence[str] = ("p",)) -> Column:
    """Non-empty paragraph texts (in order) of a container's markup.

    The markup is split at every opening paragraph tag; each piece after the
    first is cut at the first closing paragraph tag.
    """
    alt = "|".join(tags)
    pieces = F.split(markup, rf"(?i)<(?:{alt})\b[^>]*>")
    body = F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(0)))
    cut = F.transform(body, lambda x: F.regexp_replace(x, rf"(?is)</(?:{alt})\s*>.*$", ""))
    return F.filter(F.transform(cut, inner_text), lambda s: s != "")


def body_text(html: str | Column, *, tag: str = "article", para_tags: Sequence[str] = ("p",),
              not_found: str = D.CONTENT_NOT_FOUND) -> Column:
    """Paragraphs of the container joined by a blank line, or the sentinel."""
    c = container(html, tag)
    return F.when(c.isNull(), F.lit(not_found)).otherwise(F.array_join(paragraphs(c, para_tags), "\n\n"))


def extract_pages(pages: DataFrame, *, container_tag: str = "article", para_tags: Sequence[str] = ("p",),
                  url_rules: Sequence[tuple[str, str]] = D.URL_CATEGORY_RULES) -> DataFrame:
    """S8 + S9 + J4: one record per page: title, language, body text, paragraph count, category, status."""
    c = container("html", container_tag)
    paras = paragraphs(c, para_tags)
    return pages.select(
        "page_id", "url",
        F.regexp_extract("html", r'(?i)<html\b[^>]*\blang="([^"]*)"', 1).alias("lang"),
        F.coalesce(element_text("html", "title"), F.lit("")).alias("title"),
        F.when(c.isNull(), F.lit(0)).otherwise(F.size(paras)).alias("n_paragraphs"),
        F.when(c.isNull(), F.lit(D.CONTENT_NOT_FOUND)).otherwise(F.array_join(paras, "\n\n")).alias("content"),
        first_prefix_match(F.col("url"), url_rules).alias("category"),
        F.when(c.isNull(), F.lit("not_found")).otherwise(F.lit("ok")).alias("status"),
    )


def good_pages(records: DataFrame) -> DataFrame:
    """Drop only the rows whose content is the not-found sentinel."""
    return records.where(F.col("content") != F.lit(D.CONTENT_NOT_FOUND))


def listing_links(pages: DataFrame, *, block_tag: str = "li") -> DataFrame:
    """S8 listing form: one row per block with a link; blocks without ``href`` or text are skipped."""
    blocks = F.regexp_extract_all(strip_code("html"), F.lit(rf"(?is)<{block_tag}\b[^>]*>(.*?)</{block_tag}\s*>"), 1)
    rows = pages.select("page_id", F.posexplode(blocks).alias("pos", "block"))
    href = F.regexp_extract("block", r'(?is)<a\b[^>]*\bhref="([^"]*)"', 1)
    text = inner_text(F.regexp_extract("block", r"(?is)<a\b[^>]*>(.*?)</a\s*>", 1))
    out = rows.select("page_id", "pos", href.alias("link"), text.alias("title"))
    return out.where((F.col("link") != "") & (F.col("title") != ""))

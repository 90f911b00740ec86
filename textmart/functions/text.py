"""Text cleaning and tokenising as native Spark column expressions.

All functions return ``Column`` objects built from ``pyspark.sql.functions``
only, so they run inside whole-stage codegen without a Python worker.
Letter classes are parameters: the defaults reproduce the original
Cyrillic+ASCII classes; multilingual corpora pass a wider class.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from textmart import dictionaries as D


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _lit_pattern(p: str) -> Column:
    return F.lit(p)


def word_runs(text: str | Column, letters: str) -> Column:
    """Maximal runs of characters of ``letters`` (a regex class body) in lower(text)."""
    return F.regexp_extract_all(F.lower(F.coalesce(_col(text), F.lit(""))), _lit_pattern(f"[{letters}]+"), 0)


def strip_blank(text: str | Column) -> Column:
    """Text without white space (blanks, tabs, line ends) at its ends."""
    return F.regexp_replace(_col(text), r"^\s+|\s+$", "")


def drop_stop_words(tokens: Column, stop_words: Iterable[str] = (), *, min_len: int = 3,
                    drop_digits: bool = False) -> Column:
    """Keep tokens of at least ``min_len`` characters that are not stop words.

    A literal list becomes a hash ``InSet`` test inside the lambda, so the whole
    filter stays in codegen; no join is needed for dictionaries of this size.
    """
    stops = sorted(set(stop_words))

    def keep(w: Column) -> Column:
        cond = F.length(w) >= min_len
        if stops:
            cond = cond & ~w.isin(stops)
        if drop_digits:
            cond = cond & ~w.rlike(r"^(?U)\d+$")
        return cond

    return F.filter(tokens, keep)


def clean_tokens(text: str | Column, *, letters: str = D.CLEAN_LETTERS,
                 stop_words: Iterable[str] = (), min_len: int = 3) -> Column:
    """lower, non-letters to blanks, split, drop stop words and short words.

    Splitting on everything outside ``letters`` is the same as extracting the
    maximal letter runs, which is what is computed here.
    """
    return drop_stop_words(word_runs(text, letters), stop_words, min_len=min_len)


def tokenize(text: str | Column, *, letters: str = D.TOKEN_LETTERS) -> Column:
    """lower, typographic apostrophe to ', then all runs of ``letters``."""
    t = F.replace(F.lower(F.coalesce(_col(text), F.lit(""))), F.lit("’"), F.lit("'"))
    return F.regexp_extract_all(t, _lit_pattern(f"[{letters}]+"), 0)


# Emoji and symbol ranges removed by the job-ad normaliser (fixed values).
_EMOJI_CLASS = (
    r"[\x{1F600}-\x{1F64F}\x{1F300}-\x{1F5FF}\x{1F680}-\x{1F6FF}"
    r"\x{1F900}-\x{1F9FF}\x{2702}-\x{27B0}\x{1FA00}-\x{1FA6F}"
    r"\x{1FA70}-\x{1FAFF}\x{2600}-\x{26FF}\x{FE0F}]+"
)


def normalize_job_text(text: str | Column) -> Column:
    """ordered normalisation of job-ad text (URLs, e-mails, emoji, tech terms, punctuation)."""
    t = F.lower(F.coalesce(_col(text), F.lit("")))
    t = F.regexp_replace(t, r"(?U)https?://\S+|www\.\S+", " ")
    t = F.regexp_replace(t, r"(?U)\S+@\S+", " ")
    t = F.regexp_replace(t, _EMOJI_CLASS, " ")
    t = F.regexp_replace(t, r"a/b", "ab_test")
    t = F.regexp_replace(t, r"c\+\+", "cplusplus")
    t = F.regexp_replace(t, r"c#", "csharp")
    t = F.regexp_replace(t, r"(?U)[^\w\s]", " ")
    t = F.regexp_replace(t, r"(?U)\s+", " ")
    return F.trim(t)


def job_tokens(normalized: str | Column, stop_words: Iterable[str] = ()) -> Column:
    """F20 + P10: whitespace split of normalised text, then stop/short/digit filter."""
    toks = F.split(_col(normalized), " ")
    return drop_stop_words(toks, list(stop_words), min_len=3, drop_digits=True)


def classifier_text(text: str | Column, *, letters: str = "а-яіїєґa-z",
                    stop_words: Iterable[str] = ()) -> Column:
    """lower, drop URLs and e-mails, letters only, drop stop words, re-join with blanks."""
    t = F.lower(F.coalesce(_col(text), F.lit("")))
    t = F.regexp_replace(t, r"(?U)http\S+|www\.\S+", "")
    t = F.regexp_replace(t, r"(?U)\S+@\S+", "")
    toks = F.regexp_extract_all(t, _lit_pattern(f"[{letters}]+"), 0)
    return F.array_join(drop_stop_words(toks, stop_words), " ")


def detect_language(text: str | Column, *, cyrillic: str = "а-яА-ЯіІїЇєЄґҐ",
                    latin: str = "a-zA-Z") -> Column:
    """``uk`` when Cyrillic letters outnumber Latin ones, else ``en``."""
    t = F.coalesce(_col(text), F.lit(""))
    n_cyr = F.regexp_count(t, _lit_pattern(f"[{cyrillic}]"))
    n_lat = F.regexp_count(t, _lit_pattern(f"[{latin}]"))
    return F.when(n_cyr > n_lat, F.lit("uk")).otherwise(F.lit("en"))


def topic_text_tokens(text: str | Column, *, word: str = r"(?U)\w",
                      stop_words: Iterable[str] = (), min_len: int = 3) -> Column:
    """F5 without a tagger: lower, digits and punctuation to blanks, word runs, length filter.

    A lemma/POS dictionary can be applied to the exploded tokens afterwards
    (``operators.lexicon.lemmatize``).
    """
    t = F.lower(F.coalesce(_col(text), F.lit("")))
    t = F.regexp_replace(t, r"[0-9]+", " ")
    toks = F.regexp_extract_all(t, _lit_pattern(f"{word}+"), 0)
    return drop_stop_words(toks, stop_words, min_len=min_len)


def vectorizer_tokens(text: str | Column, *, word: str = r"(?U)\w") -> Column:
    """Default TF-IDF token rule: runs of two or more word characters, lower-cased."""
    return F.regexp_extract_all(F.lower(F.coalesce(_col(text), F.lit(""))),
                                _lit_pattern(f"{word}{{2,}}"), 0)


def stem(word: str | Column, suffixes: Sequence[str] = D.STEM_SUFFIXES) -> Column:
    """strip the first suffix (in list order) that leaves more than two characters."""
    w = _col(word)
    expr = None
    for s in suffixes:
        cond = w.endswith(s) & (F.length(w) > len(s) + 2)
        cut = F.left(w, F.length(w) - len(s))
        expr = F.when(cond, cut) if expr is None else expr.when(cond, cut)
    return w if expr is None else expr.otherwise(w)


def ngrams(tokens: str | Column, n: int) -> Column:
    """W6 within one token array: ``n``-grams joined by a blank, in order."""
    arr = _col(tokens)
    size = F.size(arr)
    if n == 2:  # neighbours side by side; the general form below makes an array for every gram
        pairs = F.zip_with(F.slice(arr, 1, size - 1), F.slice(arr, 2, size - 1), lambda a, b: F.concat_ws(" ", a, b))
        return F.when(size >= 2, pairs).otherwise(F.array().cast("array<string>"))
    idx = F.sequence(F.lit(1), size - n + 1)
    grams = F.transform(
        idx,
        lambda i: F.array_join(F.slice(arr, i, n), " "),
    )
    return F.when(size >= n, grams).otherwise(F.array().cast("array<string>"))


def compact_text(text: str | Column, max_chars: int, *, ellipsis: str = "…") -> Column:
    """Collapse whitespace; longer than ``max_chars`` -> first max-1 chars + ellipsis."""
    one = F.trim(F.regexp_replace(F.coalesce(_col(text), F.lit("")), r"(?U)\s+", " "))
    return F.when(F.length(one) <= max_chars, one).otherwise(
        F.concat(F.left(one, F.lit(max_chars - 1)), F.lit(ellipsis)))


def short_title(text: str | Column, n: int = 50) -> Column:
    """P11 title variant: first ``n`` characters + ``...`` when longer."""
    t = F.coalesce(_col(text), F.lit(""))
    return F.when(F.length(t) > n, F.concat(F.left(t, F.lit(n)), F.lit("..."))).otherwise(t)


def joined_text(*cols: str | Column, strip: bool = False) -> Column:
    """Title and content joined by one blank (nulls as empty strings)."""
    out = F.concat_ws(" ", *[F.coalesce(_col(c), F.lit("")) for c in cols])
    return F.trim(out) if strip else out

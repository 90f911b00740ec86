"""Dictionary lookups on tokens: lemmas, parts of speech, sentiment lexicon.

Lemma and POS dictionaries replace per-word analyzers: a table ``(token,
lemma, pos)`` is joined onto the tokens, and a token missing from it keeps
itself as lemma and gets the part of speech ``UNKN``, or both are guessed from
its ending (``guess_unknown``): the dictionary's words form a trie of their
endings, in which every node knows the most frequent way from a word with that
ending to its lemma. The trie is a table of (ending, rule), a look-up is one
equi-join on the endings of the distinct unknown words.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmart import dictionaries as D
from textmart.operators.joins import join_null_safe
from textmart.operators.tokens import exact_median, row_numbers
from textmart.session import cut_lineage


def lemmatize(tokens: DataFrame, lemma_dict: DataFrame | None = None, *, word: str = "word",
              lemma: str = "lemma", pos: str = "pos") -> DataFrame:
    """Add ``lemma`` and ``pos`` to token rows (fallback: the token itself and ``UNKN``).

    The dictionary (one entry per token: the first by lemma and pos) is joined
    straight onto the tokens; AQE broadcasts it where its bytes allow.
    """
    if lemma_dict is None:
        return tokens.withColumn(lemma, F.col(word)).withColumn(pos, F.lit("UNKN"))
    d = lemma_dict.groupBy(F.col("token").alias(word)).agg(F.min(F.struct("lemma", "pos")).alias("_d"))
    out = tokens.join(d, on=word, how="left")
    return (out.withColumn(lemma, F.coalesce(F.col("_d.lemma"), F.col(word)))
            .withColumn(pos, F.coalesce(F.col("_d.pos"), F.lit("UNKN"))).drop("_d"))


#: Longest ending that is looked at, and words of the dictionary that must share a rule's ending.
MAX_ENDING, MIN_WORDS = 5, 2


def _endings(word: str, longest: int, whole: bool) -> Column:
    """Endings of 1 .. ``longest`` characters, shorter than the word itself unless ``whole``."""
    n = F.least(F.lit(longest), F.length(word) - (0 if whole else 1))
    return F.when(n > 0, F.transform(F.sequence(F.lit(1), n), lambda k: F.right(F.col(word), k))).otherwise(F.array().cast("array<string>"))


def ending_rules(lemma_dict: DataFrame, *, longest: int = MAX_ENDING, min_words: int = MIN_WORDS) -> DataFrame:
    """``(ending, strip, add, pos, n)``: the most frequent rule of the dictionary's words with each ending.

    A rule strips characters from the word's end, adds others and names a part
    of speech; it holds for an ending that contains what it strips. Of equally
    frequent rules the first by (strip, add, pos) is taken. An ending is kept
    if at least ``min_words`` words follow its rule.
    """
    entries = lemma_dict.where("token is not null and lemma is not null").groupBy("token").agg(F.min(F.struct("lemma", "pos")).alias("_d"))
    entries = entries.select("token", "_d.lemma", "_d.pos")
    upto = F.least(F.length("token"), F.length("lemma"))
    same = F.when(upto > 0, F.size(F.filter(F.sequence(F.lit(1), upto), lambda k: F.left("token", k) == F.left("lemma", k)))).otherwise(0)
    rules = entries.withColumn("_same", same).select(
        "pos", "token", (F.length("token") - F.col("_same")).alias("strip"), F.substr("lemma", F.col("_same") + 1).alias("add"))
    rows = rules.select("strip", "add", "pos", F.explode(_endings("token", longest, True)).alias("ending")).where(F.length("ending") >= F.col("strip"))
    counted = rows.groupBy("ending", "strip", "add", "pos").agg(F.count(F.lit(1)).alias("n"))
    best = counted.groupBy("ending").agg(F.min(F.struct((-F.col("n")).alias("k"), "strip", "add", "pos")).alias("_b"))
    return best.select("ending", "_b.strip", "_b.add", "_b.pos", (-F.col("_b.k")).alias("n")).where(F.col("n") >= min_words)


def guess_unknown(words: DataFrame, lemma_dict: DataFrame, *, word: str = "word", longest: int = MAX_ENDING,
                  min_words: int = MIN_WORDS) -> DataFrame:
    """``(word, ending, lemma, pos)`` for the distinct words outside the dictionary, by their longest known ending.

    A word without a known ending is its own lemma, with ``UNKN`` and a null
    ending. An ending is shorter than its word, so a guess never strips a whole word.
    """
    known = lemma_dict.where("token is not null").select(F.col("token").alias(word)).distinct()
    new = cut_lineage(words.where(F.col(word).isNotNull()).select(word).distinct().join(known, word, "left_anti"))
    rules = ending_rules(lemma_dict, longest=longest, min_words=min_words)
    found = new.select(word, F.explode(_endings(word, longest, False)).alias("ending")).join(rules, "ending")
    rule = F.max_by(F.struct("ending", "strip", "add", "pos"), F.length("ending")).alias("_r")
    out = new.join(found.groupBy(word).agg(rule), word, "left")
    stem = F.left(word, F.length(word) - F.col("_r.strip"))
    return out.select(word, F.col("_r.ending").alias("ending"), F.coalesce(F.concat(stem, "_r.add"), word).alias("lemma"),
                      F.coalesce("_r.pos", F.lit("UNKN")).alias("pos"))


def with_guesses(lemma_dict: DataFrame, words: DataFrame, *, word: str = "word") -> DataFrame:
    """The dictionary ``(token, lemma, pos)`` with an entry for every word it lacks, for ``lemmatize`` and ``lemmatize_arrays``."""
    guessed = guess_unknown(words, lemma_dict, word=word).select(F.col(word).alias("token"), "lemma", "pos")
    return cut_lineage(lemma_dict.select("token", "lemma", "pos").unionByName(guessed))


def lemmatize_arrays(docs: DataFrame, lemma_dict: DataFrame, *, tokens: str = "tokens", key: str | Sequence[str] = "doc_id",
                     keep_pos: Sequence[str] | None = None, min_len: int = 0) -> DataFrame:
    """J6 on token arrays: every token becomes its lemma, in the same order.

    ``keep_pos`` and ``min_len`` keep only lemmas of these parts of speech and
    of this length. ``key`` (one or more columns) identifies a row.
    """
    keys = [key] if isinstance(key, str) else list(key)
    lem = lemmatize(docs.select(*keys, F.posexplode(tokens).alias("_i", "word")), lemma_dict)
    if keep_pos is not None:
        lem = lem.where(F.col("pos").isin(list(keep_pos)))
    if min_len:
        lem = lem.where(F.length("lemma") >= min_len)
    back = lem.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("_i", "lemma"))).alias("_a"))
    back = back.select(*keys, F.transform("_a", lambda s: s["lemma"]).alias("_lem"))
    out = join_null_safe(docs, back, keys)
    return out.withColumn(tokens, F.coalesce(F.col("_lem"), F.array().cast("array<string>"))).drop("_lem")


def lemma_counts(docs: DataFrame, lemma_dict: DataFrame, *, by: Sequence[str], key: str | Sequence[str], tokens: str = "tokens",
                 keep_pos: Sequence[str] | None = None, min_len: int = 0) -> DataFrame:
    """J6 + A2: ``(*by, lemma, n)``: how often each lemma comes in the token arrays of a group.

    The same counts as those of the arrays of ``lemmatize_arrays``, but a word
    is counted in its group first, so that the dictionary meets one row per
    group and word. As there, rows that share a ``key`` each hold the tokens of
    all of them; their groups are looked up for such keys alone.
    """
    keys = [key] if isinstance(key, str) else list(key)
    again = cut_lineage(docs.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).where("_rows > 1").drop("_rows").withColumn("_again", F.lit(True)))
    per = join_null_safe(docs.select(*dict.fromkeys([*keys, *by])), again, keys, "inner").groupBy(*dict.fromkeys([*keys, *by])).agg(F.count(F.lit(1)).alias("_m"))
    held = cut_lineage(per.groupBy(*keys).agg(F.collect_list(F.struct(*by, "_m")).alias("_held")))
    own = F.array(F.struct(*by, F.lit(1).cast("long").alias("_m")))
    rows = join_null_safe(docs.select(*dict.fromkeys([*keys, *by]), F.col(tokens).alias("_tokens")), held, keys)
    rows = rows.select("_tokens", F.inline(F.coalesce("_held", own)))
    words = rows.select(*by, "_m", F.explode("_tokens").alias("word")).groupBy(*by, "word").agg(F.sum("_m").alias("n"))
    lem = lemmatize(words, lemma_dict)
    if keep_pos is not None:
        lem = lem.where(F.col("pos").isin(list(keep_pos)))
    if min_len:
        lem = lem.where(F.length("lemma") >= min_len)
    return lem.groupBy(*by, "lemma").agg(F.sum("n").alias("n"))


def lexicon_hits(lemmas: Column, positive: Sequence[str] = D.POSITIVE_LEMMAS,
                 negative: Sequence[str] = D.NEGATIVE_LEMMAS) -> tuple[Column, Column]:
    """Number of positive and negative lexicon lemmas in an array (literal hash sets)."""
    pos = F.size(F.filter(lemmas, lambda w: w.isin(list(positive)))) if positive else F.lit(0)
    neg = F.size(F.filter(lemmas, lambda w: w.isin(list(negative)))) if negative else F.lit(0)
    return pos, neg


def sentiment_columns(lemmas: Column, positive: Sequence[str] = D.POSITIVE_LEMMAS,
                      negative: Sequence[str] = D.NEGATIVE_LEMMAS) -> dict[str, Column]:
    """hits, score = (pos - neg) / max(n, 1), label from the sign of the unrounded score."""
    pos, neg = lexicon_hits(lemmas, positive, negative)
    score = (pos - neg) / F.greatest(F.size(lemmas), F.lit(1))
    label = F.when(score > 0, "positive").when(score < 0, "negative").otherwise("neutral")
    return {"tokens_no_stop": F.size(lemmas), "positive_hits": pos, "negative_hits": neg,
            "sentiment_score": score, "sentiment_label": label}


def score_summary(articles: DataFrame, *, by: Sequence[str] = ("source",), score: str = "sentiment_score") -> DataFrame:
    """A10: mean, exact median, share > 0 and share < 0 of a per-article score (0 when empty)."""
    s = F.col(score)
    n = F.count(s)
    out = articles.groupBy(*by).agg(
        F.coalesce(F.avg(s), F.lit(0.0)).alias("sent_mean"),
        (F.count_if(s > 0) / F.greatest(n, F.lit(1))).alias("sent_pos_share"),
        (F.count_if(s < 0) / F.greatest(n, F.lit(1))).alias("sent_neg_share"),
    )
    out = join_null_safe(out, exact_median(articles, score, by=by, out="sent_median"), list(by))
    return out.withColumn("sent_median", F.coalesce("sent_median", F.lit(0.0)))


def row_index(df: DataFrame, *, by: Sequence[str], order: str, out: str = "article_index") -> DataFrame:
    """1-based index of a row inside its group, by an explicit (numeric, unique) order column.

    Numbered from ranges of the order column, so one very large source is not
    sorted by a single task.
    """
    return row_numbers(df, by=by, order=order, out=out)


def token_listing(docs: DataFrame, lemma_dict: DataFrame | None = None, *, key: str = "doc_id",
                  tokens: str = "tokens") -> DataFrame:
    """one row per token ``(key, position, token, pos, lemma)`` in text order."""
    rows = docs.select(key, F.posexplode(tokens).alias("position", "word"))
    return lemmatize(rows, lemma_dict).select(key, "position", F.col("word").alias("token"), "pos", "lemma")


def normalisation_table(words: DataFrame, lemma_dict: DataFrame | None = None, *, word: str = "word",
                        stem_suffixes: Sequence[str] = D.STEM_SUFFIXES) -> DataFrame:
    """Each distinct word side by side with its lemma and its stem."""
    from textmart.functions.text import stem
    vocab = words.select(word).distinct()
    return lemmatize(vocab, lemma_dict, word=word).select(word, "lemma", stem(word, stem_suffixes).alias("stem"))

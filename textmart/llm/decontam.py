"""Benchmark decontamination by template windows, with DataFrame functions only.

Words are canonicalised: numbers, units after a number and names become typed placeholders. Names do so in three forms:
those inside sentences, none (which finds copies in other case), and also words that start a sentence. Windows of five canonical
words of the documents are hash-joined with those of the benchmark items. The placeholders that a matched window covers
must fill consistently: within an occurrence of an item, an item's value stands for one value of the document. Occurrences
are the matched windows on one diagonal (document position less item position), those on neighbouring diagonals, and all of
the document together; the best one counts. A document leaks an item if at least ``min_share`` of the item's windows match:
of all its windows, or of those that say enough with their names as placeholders (a window dense with names can only be met
in a literal copy).

A bitmap of fixed size over the items' window hashes is tested before the shuffle, so that only windows which may match
leave their task; its size does not depend on the number of items or documents, and the join that follows is exact.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textmart.llm.common import join_split
from textmart.session import cut_lineage

WINDOW = 5
#: Windows with fewer literal words than this say too little and are not used.
LITERALS = 3
MIN_SHARE = 0.8
#: Diagonals that are at most so many words apart are neighbours: words put into a copy or left out of it.
SHIFT = 4
BITMAP_BITS = 1 << 21
BLANKS = "\n\r\t\x0b\x0c "
PUNCTUATION = ",;:\"'()[]{}<>*#$%&@|_~^=+/\\`-“”„«»¿¡"
ENDS = ".!?"
NUMBER, UNIT, NAME = "#", "%", "@"
#: Before a word that may be a name because it starts a sentence.
START = "^"
PLACEHOLDERS = (NUMBER, UNIT, NAME)
UNITS = ("mm", "cm", "m", "km", "g", "kg", "mg", "t", "l", "ml", "s", "ms", "min", "h", "hours", "hour", "minutes", "minute",
         "seconds", "days", "day", "years", "year", "months", "weeks", "euro", "euros", "dollars", "dollar", "eur", "usd",
         "percent", "miles", "mile", "feet", "foot", "inches", "pounds", "meters", "metres", "kilometers", "kilograms")


def with_words(rows: DataFrame, text: Column) -> DataFrame:
    """Adds ``raw``, the words between blanks without punctuation other than sentence ends, ``plain``, the same words in lower
    case without sentence ends, and ``tags``; an empty text has one empty word.

    Letters and ends are changed in the whole text, not word by word: functions inside array lambdas are interpreted.
    """
    blanked = F.translate(F.coalesce(text, F.lit("")), BLANKS + PUNCTUATION, " " * len(BLANKS))
    rows = rows.withColumn("single", F.trim(F.regexp_replace(blanked, " {2,}", " ")))
    bare = F.regexp_replace(F.lower("single"), rf"(?<![{ENDS}])[{ENDS}]++(?= |\z)", "")
    rows = rows.withColumns({"raw": F.split("single", " "), "plain": F.split(bare, " ")}).drop("single")
    return rows.withColumn("tags", tagged(F.col("raw"), F.col("plain")))


def tagged(raw: Column, plain: Column) -> Column:
    """NUMBER, UNIT after a number, the lower-case word after NAME inside a sentence or START at its start, if it may be a name."""

    def one(low: Column, i: Column) -> Column:
        w, before = F.get(raw, i), F.get(raw, i - 1)
        s = F.rtrim(w, F.lit(ENDS))
        number = lambda x: (x >= "0") & (x < ":")  # noqa: E731  starts with a digit
        name = (low != s) & (F.length(s) > 1) & (F.substring(s, 2, 1 << 30) == F.lower(F.substring(s, 2, 1 << 30)))
        inside = before.isNotNull() & ~F.right(before, F.lit(1)).isin(*ENDS)
        # most words are lower-case already: they are settled before anything is cut from them
        return (F.when(number(low), NUMBER).when(number(before) & low.isin(*UNITS), UNIT).when(low == w, low)
                .when(name, F.concat(F.when(inside, NAME).otherwise(START), low)).otherwise(low))

    return F.transform(plain, one)


def forms(tags: Column, of: Callable[[Column], Column] = lambda x: x) -> list[Column]:
    """``of`` the words with names inside sentences as placeholders, with every name literal, and with sentence starts as names too."""
    inside, start = lambda x: F.startswith(x, F.lit(NAME)), lambda x: F.startswith(x, F.lit(START))
    rest = lambda x: F.substring(x, 2, 1 << 30)
    return [F.transform(tags, lambda x: of(F.when(inside(x), NAME).when(start(x), rest(x)).otherwise(x))),
            F.transform(tags, lambda x: of(F.when(inside(x) | start(x), rest(x)).otherwise(x))),
            F.transform(tags, lambda x: of(F.when(inside(x) | start(x), NAME).otherwise(x)))]


def window_rows(rows: DataFrame) -> DataFrame:
    """One row per window start ``at`` of the array ``tags``, with the tags of its words."""
    starts = F.when(F.size("tags") >= WINDOW, F.sequence(F.lit(0), F.size("tags") - WINDOW))
    return rows.withColumn("at", F.explode(starts)).withColumn("tags", words_at("tags"))


def hash_at(hashes: Column, at: Column) -> Column:
    """Hash of a window from the hashes of its words: a word is hashed once, not in each of its windows."""
    return F.xxhash64(*(F.get(hashes, at + k) for k in range(WINDOW)))


def hash_of(canon: Column) -> Column:
    return F.xxhash64(*(F.xxhash64(F.get(canon, F.lit(k))) for k in range(WINDOW)))


def words_at(array: str) -> Column:
    return F.slice(F.col(array), F.col("at") + 1, WINDOW)


def item_windows(benchmark: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """Windows of the items in every form that says enough; one that starts with the item's first word also stands with that word
    as a name. ``strict`` windows say enough with their names as placeholders."""
    rows = window_rows(with_words(benchmark.select(F.col(item_col).alias("item"), F.col(text_col).alias("text")), F.col("text")))
    inside, literal, starts = forms(F.col("tags"))
    first = F.when((F.col("at") == 0) & F.startswith(F.get("tags", F.lit(0)), F.lit(START)),
                   F.concat(F.array(F.lit(NAME)), F.slice(inside, 2, WINDOW)))
    enough = lambda c: F.size(F.filter(c, lambda x: ~x.isin(*PLACEHOLDERS))) >= LITERALS
    every = F.array_distinct(F.filter(F.array(inside, literal, starts, first), lambda c: c.isNotNull() & enough(c)))
    rows = rows.select("item", "at", enough(inside).alias("strict"), words_at("plain").alias("item_words"), F.explode(every).alias("item_canon"))
    return rows.withColumn("hash", hash_of(F.col("item_canon")))


def bitmap(windows: DataFrame) -> Column:
    """The hashes of ``windows`` as BITMAP_BITS bits in an array of longs, as a scalar subquery."""
    spark, words = windows.sparkSession, BITMAP_BITS // 64
    place = F.col("hash").bitwiseAND(F.lit(BITMAP_BITS - 1))
    bits = windows.select(F.shiftright(place, 6).alias("k"), F.expr(f"shiftleft(1L, cast((hash & {BITMAP_BITS - 1}) & 63 as int))").alias("bits"))
    every = bits.union(spark.range(words).select("id", F.lit(0).cast("long")))
    merged = every.groupBy("k").agg(F.bit_or("bits").alias("bits"))
    return merged.agg(F.transform(F.array_sort(F.collect_list(F.struct("k", "bits"))), lambda x: x["bits"]).alias("bitmap")).scalar()


def leaks(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
          item_text_col: str = "text", min_share: float = MIN_SHARE) -> DataFrame:
    """``(<id_col>, <item_col>, n_windows, n_matched, share)`` for each document and benchmark item that it leaks.

    Whole texts are searched. Items with fewer than five words, or without a window of three literal words in any form, are
    not searched for (numbers alone say too little); null and empty texts match nothing. Rows without an id are left out of the pairs; rows that share an id
    are judged as one document, items that share an id as one item. Repeated passages count once. Empty tables give no
    rows. Other columns of the inputs are not read.
    """
    wanted = item_windows(benchmark.filter(F.col(item_col).isNotNull()), item_col, item_text_col)
    strictly = F.when(F.col("strict"), F.col("at"))
    sizes = wanted.groupBy("item").agg(F.countDistinct("at").alias("n_all"), F.countDistinct(strictly).alias("n_strict"))
    found = with_words(docs.filter(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), F.col("text"))
    found = found.select("id", "plain", "tags", *(h.alias(f"hashes{k}") for k, h in enumerate(forms(F.col("tags"), F.xxhash64))))
    found = found.withColumn("at", F.explode(F.when(F.size("tags") >= WINDOW, F.sequence(F.lit(0), F.size("tags") - WINDOW))))
    bits = bitmap(wanted)

    def may_match(h: Column) -> Column:
        word = F.get(bits, F.shiftright(h.bitwiseAND(F.lit(BITMAP_BITS - 1)), 6).cast("int"))
        return F.getbit(word, h.bitwiseAND(F.lit(63)).cast("int")) == 1

    hashes = [hash_at(F.col(f"hashes{k}"), F.col("at")) for k in range(3)]
    found = found.filter(may_match(hashes[0]) | may_match(hashes[1]) | may_match(hashes[2]))
    found = found.select("id", F.col("at").alias("place"), words_at("plain").alias("words"), words_at("tags").alias("tags"))
    # the forms of a window are the same unless a word in it may be a name
    every = F.array_distinct(F.array(*(F.struct(hash_of(c).alias("hash"), c.alias("canon")) for c in forms(F.col("tags")))))
    found = found.select("id", "place", "words", F.inline(every))
    met = found.join(wanted, "hash").filter("canon = item_canon")
    # the slots of a window: value of the item and value of the document under each placeholder
    slots = F.expr("filter(transform(sequence(0, size(canon) - 1), k -> struct(get(canon, k) as kind, get(item_words, k) as mine, "
                   "get(words, k) as theirs)), x -> x.kind in ('#', '%', '@'))")
    # both the votes and the windows they decide on read this: the corpus is scanned once
    met = cut_lineage(met.select("id", "item", "at", "strict", (F.col("place") - F.col("at")).alias("diagonal"), slots.alias("slots")).distinct())
    by_diagonal = Window.partitionBy("id", "item").orderBy("diagonal")
    starts = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(by_diagonal) > SHIFT, F.lit(False)).cast("int")
    bands = met.select("id", "item", "diagonal").distinct().withColumn("far", starts).withColumn("band", F.sum("far").over(by_diagonal))
    scope = lambda name, nr: F.struct(F.lit(name).alias("scope"), nr.cast("long").alias("nr"))
    scopes = F.array(scope("all", F.lit(0)), scope("band", F.col("band")), scope("diagonal", F.col("diagonal")))
    met = join_split(met, bands.select("id", "item", "diagonal", "band"), ["id", "item", "diagonal"])
    met = met.select("id", "item", F.explode(scopes).alias("part"), "at", "strict", "slots").distinct()
    place = ["id", "item", "part"]
    filled = met.select(*place, "at", F.explode("slots").alias("s")).select(*place, "at", "s.kind", "s.mine", "s.theirs")
    votes = filled.groupBy(*place, "kind", "mine", "theirs").agg(F.countDistinct("at").alias("n"))
    chosen = votes.groupBy(*place, "kind", "mine").agg(F.max_by("theirs", F.struct("n", "theirs")).alias("chosen"))
    odd = votes.join(chosen, [*place, "kind", "mine"]).filter("theirs <> chosen").groupBy(*place).agg(
        F.collect_set(F.struct("kind", "mine", "theirs")).alias("odd"))
    kept = met.join(odd, place, "left").filter(F.col("odd").isNull() | ~F.arrays_overlap("slots", "odd"))
    counts = kept.groupBy(*place).agg(F.countDistinct("at").alias("m_all"), F.countDistinct(strictly).alias("m_strict")).join(sizes, "item")
    ways = [F.struct(F.try_divide(f"m_{k}", f"n_{k}").alias("share"), F.col(f"n_{k}").alias("n_windows"), F.col(f"m_{k}").alias("n_matched")) for k in ("all", "strict")]
    best = counts.groupBy("id", "item").agg(F.max(F.greatest(*ways)).alias("best"))
    return (best.filter(F.col("best.share") >= min_share)
            .select(F.col("id").alias(id_col), F.col("item").alias(item_col), "best.n_windows", "best.n_matched", "best.share"))


def duck_sql(min_share: float = MIN_SHARE) -> str:
    """The same in DuckDB's SQL, over ``documents`` and ``benchmark``; windows are joined as texts instead of hashes."""
    q = lambda s: "'" + s.replace("'", "''") + "'"
    blanks = " || ".join(f"chr({ord(c)})" for c in BLANKS)
    raw = (f"list_filter(string_split(translate(translate(coalesce(text, ''), {blanks}, {q(' ' * len(BLANKS))}), {q(PUNCTUATION)}, ''), ' '),"
           " lambda w: w <> '')")
    bare = "rtrim(w, '.!?')"
    tags = f"""list_transform(raw, lambda w, i: CASE
      WHEN {bare} >= '0' AND {bare} < ':' THEN '#'
      WHEN lower({bare}) IN ({', '.join(map(q, UNITS))}) AND i > 1 AND raw[i - 1] >= '0' AND raw[i - 1] < ':' THEN '%'
      WHEN lower({bare}) <> {bare} AND length({bare}) > 1 AND substr({bare}, 2) = lower(substr({bare}, 2))
        THEN CASE WHEN i > 1 AND right(raw[i - 1], 1) NOT IN ('.', '!', '?') THEN '@' ELSE '^' END || lower({bare})
      ELSE lower({bare}) END)"""
    form = lambda inside, start: (f"list_transform(win, lambda x: CASE WHEN starts_with(x, '@') THEN {inside} "  # noqa: E731
                                  f"WHEN starts_with(x, '^') THEN {start} ELSE x END)")
    plain_, rest = form("'@'", "substr(x, 2)"), form("substr(x, 2)", "substr(x, 2)")
    three = f"[{plain_}, {rest}, {form(q('@'), q('@'))}]"
    enough = lambda c: f"len(list_filter({c}, lambda x: x NOT IN ('#', '%', '@'))) >= {LITERALS}"
    cut = (f"list_slice(tags, k, k + {WINDOW - 1}) AS win, list_slice(raw, k, k + {WINDOW - 1}) AS raw, k "
           f"FROM (SELECT *, unnest(range(1, len(raw) - {WINDOW - 2})) AS k FROM")
    return f"""
WITH d AS (SELECT id, raw, {tags} AS tags FROM (SELECT doc_id AS id, {raw} AS raw FROM documents WHERE doc_id IS NOT NULL)),
dw AS (SELECT id, k, raw, unnest(list_distinct({three})) AS form FROM (SELECT id, {cut} d))),
b AS (SELECT item, raw, {tags} AS tags FROM (SELECT item_id AS item, {raw} AS raw FROM benchmark WHERE item_id IS NOT NULL)),
b1 AS (SELECT item, k, win, list_transform(raw, lambda w: lower({bare})) AS words, {enough(plain_)} AS strict FROM (SELECT item, {cut} b))),
b2 AS (SELECT item, k, words, strict, unnest(list_distinct({three} || CASE WHEN k = 1 AND starts_with(win[1], '^')
         THEN [list_concat(['@'], ({plain_})[2:])] ELSE [] END)) AS form FROM b1),
w AS (SELECT * FROM b2 WHERE {enough('form')}),
n AS (SELECT item, count(DISTINCT k) AS n_all, count(DISTINCT k) FILTER (strict) AS n_strict FROM w GROUP BY item),
met AS (SELECT DISTINCT id, item, w.k, dw.k - w.k AS diagonal, strict, list_filter(list_transform(range(1, {WINDOW + 1}), lambda j:
          {{'kind': form[j], 'mine': words[j], 'theirs': lower(rtrim(raw[j], '.!?'))}}), lambda x: x.kind IN ('#', '%', '@')) AS slots
        FROM dw JOIN w USING (form)),
g AS (SELECT *, CASE WHEN diagonal - lag(diagonal) OVER u > {SHIFT} THEN 1 ELSE 0 END AS far FROM (SELECT DISTINCT id, item, diagonal FROM met)
      WINDOW u AS (PARTITION BY id, item ORDER BY diagonal)),
band AS (SELECT id, item, diagonal, sum(far) OVER (PARTITION BY id, item ORDER BY diagonal) AS band FROM g),
part AS (SELECT DISTINCT id, item, p, k, strict, slots FROM (SELECT met.*, unnest(['all', 'band ' || band::BIGINT, 'diagonal ' || diagonal]) AS p
         FROM met JOIN band USING (id, item, diagonal))),
f AS (SELECT id, item, p, k, s.kind AS kind, s.mine AS mine, s.theirs AS theirs FROM (SELECT id, item, p, k, unnest(slots) AS s FROM part)),
v AS (SELECT id, item, p, kind, mine, theirs, count(DISTINCT k) AS n FROM f GROUP BY ALL),
c AS (SELECT *, row_number() OVER (PARTITION BY id, item, p, kind, mine ORDER BY n DESC, theirs DESC) AS r FROM v),
odd AS (SELECT id, item, p, list({{'kind': kind, 'mine': mine, 'theirs': theirs}}) AS odd FROM c WHERE r > 1 GROUP BY id, item, p),
m AS (SELECT id, item, p, count(DISTINCT k) AS m_all, count(DISTINCT k) FILTER (strict) AS m_strict FROM part LEFT JOIN odd USING (id, item, p)
      WHERE odd IS NULL OR NOT list_has_any(slots, odd) GROUP BY id, item, p),
ways AS (SELECT id, item, m_all / n_all AS share, n_all AS n_windows, m_all AS n_matched FROM m JOIN n USING (item)
         UNION ALL SELECT id, item, m_strict / n_strict, n_strict, m_strict FROM m JOIN n USING (item) WHERE n_strict > 0),
best AS (SELECT *, row_number() OVER (PARTITION BY id, item ORDER BY share DESC, n_windows DESC, n_matched DESC) AS place FROM ways)
SELECT id AS doc_id, item AS item_id, n_windows, n_matched, share FROM best WHERE place = 1 AND share >= {min_share}"""

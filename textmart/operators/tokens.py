"""Token tables: exploding, running positions over a corpus, n-grams.

The original analyses concatenate every document of a corpus (or of a
source) into one token stream. Forming that stream with one global sort
would put the whole corpus in one task, so positions are built from a
prefix sum over per-document token counts instead (``with_offsets``), and
n-grams are formed inside each document's array (no shuffle) plus a small
join over document boundaries (``ngram_table``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textmart.functions.text import ngrams as _array_ngrams
from textmart.operators.joins import join_null_safe
from textmart.session import cut_lineage

# Number of order-key ranges of the two-level prefix sum.
RANGES = 512


def with_offsets(docs: DataFrame, *, order: str, count: str, groups: Sequence[str] = (),
                 offset: str = "offset", ranges: int = RANGES, tiebreak: Sequence[str] = ()) -> DataFrame:
    """Add the number of tokens of all earlier documents (per group) as ``offset``.

    Two-level prefix sum over a document-level table. The order keys (numeric)
    are cut at approximate quantiles of the data, so each of the ``ranges``
    ranges holds about as many rows whatever the keys look like (sparse,
    negative, clustered). Every (group, range) has its own running sum in a
    window; the totals of the earlier ranges, at most ``ranges`` numbers per
    group, are added to it. Null groups are a group, null keys come first.
    """
    g = list(groups)
    cuts = F.array(*[F.lit(i / ranges) for i in range(1, ranges)])
    # the bounds ascend: whole blocks of them are passed by the last of each, then one block is looked through
    block = max(1, round(ranges ** 0.5))
    bounds = docs.select(F.percentile_approx(order, cuts, 10 * ranges).alias("all")).select(
        F.struct("all", F.filter("all", lambda b, i: i % block == block - 1).alias("lasts"))).scalar()
    passed = F.size(F.filter("_bounds.lasts", lambda b: b < F.col(order))) * block
    below = passed + F.size(F.filter(F.slice("_bounds.all", passed + 1, F.lit(block)), lambda b: b < F.col(order)))
    d = docs.withColumn("_bounds", bounds)
    d = d.withColumn("_rng", F.when(F.col(order).isNull() | F.col("_bounds.all").isNull(), -1).otherwise(below)).drop("_bounds")
    totals = d.groupBy(*g, "_rng").agg(F.sum(count).alias("_rng_n"))
    every = F.collect_list(F.struct("_rng", F.col("_rng_n").cast("long").alias("_rng_n")))
    w = Window.partitionBy(*g, "_rng").orderBy(order, *tiebreak).rowsBetween(Window.unboundedPreceding, -1)
    out = d.withColumn("_in", F.coalesce(F.sum(count).over(w), F.lit(0)))
    if g:
        # the totals of the earlier ranges are summed up once for each range, on at most ``ranges`` + 1 rows of a group
        earlier = F.sum("_rng_n").over(Window.partitionBy(*g).orderBy("_rng").rowsBetween(Window.unboundedPreceding, -1))
        totals = totals.withColumn("_rng_n", F.coalesce(earlier, F.lit(0)))
        out = join_null_safe(out, totals.groupBy(*g).agg(F.map_from_entries(every).alias("_before")), g)
    else:
        earlier = lambda r: F.aggregate(F.filter("_every", lambda t: t["_rng"] < r), F.lit(0).cast("long"), lambda acc, t: acc + t["_rng_n"])
        one = totals.agg(every.alias("_every")).select(F.map_from_entries(F.transform("_every", lambda t: F.struct(t["_rng"], earlier(t["_rng"])))).alias("_before"))
        out = out.withColumn("_before", one.scalar())
    return out.withColumn(offset, F.element_at("_before", F.col("_rng")) + F.col("_in")).drop("_rng", "_before", "_in")


def ngram_table(docs: DataFrame, n: int | Sequence[int], *, tokens: str = "tokens", order: str = "doc_id",
                groups: Sequence[str] = (), across_documents: bool = True,
                gram: str = "gram") -> DataFrame:
    """All ``n``-grams (one n or several) of the token stream as rows ``(*groups, gram)``.

    Grams inside a document come from its array: one ``explode`` of the
    concatenated 1..n-gram arrays, no shuffle. With ``across_documents`` the
    grams that straddle document ends of the concatenated stream (per group,
    in ``order``) are added: each document contributes only its first and
    last n-1 tokens (a document-level table), which are placed by running
    offsets and joined on position.
    """
    g = list(groups)
    ns = sorted({n} if isinstance(n, int) else set(n))
    arrays = [F.col(tokens) if m == 1 else _array_ngrams(F.col(tokens), m) for m in ns]
    inner = docs.select(*g, F.explode(arrays[0] if len(arrays) == 1 else F.concat(*arrays)).alias(gram))
    if not across_documents or ns[-1] < 2:
        return inner
    k = ns[-1] - 1
    size = F.size(tokens)
    # places of the first and last k tokens; only these are looked at
    head = F.sequence(F.lit(0), F.least(F.lit(k), size) - 1)
    tail = F.sequence(F.greatest(size - k, F.lit(0)), size - 1)
    places = F.when(size > 0, F.array_distinct(F.concat(head, tail)))
    edges = F.transform(places, lambda p: F.struct(p.alias("p"), F.get(tokens, p).alias("w")))
    # a narrow row per document, read several times for the offsets; tokens are not computed again for them
    bnd = cut_lineage(docs.select(*g, order, size.alias("_n"), edges.alias("_e")))
    bnd = with_offsets(bnd, order=order, count="_n", groups=g, offset="_off")
    edge = cut_lineage(bnd.select(*g, "_off", "_n", F.inline("_e")).select(
        *g, (F.col("_off") + F.col("p")).alias("_g"), F.col("w").alias("_w"), F.col("p").alias("_p"), "_n"))
    out = inner
    for m in ns:
        if m < 2:
            continue
        starts = edge.where(F.col("_p") >= F.col("_n") - (m - 1)).select(*g, "_g", F.col("_w").alias("_w0"))
        cur, words = starts, [F.col("_w0")]
        for j in range(1, m):
            nxt = edge.select(*g, (F.col("_g") - j).alias("_g"), F.col("_w").alias(f"_w{j}"))
            cur = join_null_safe(cur, nxt, [*g, "_g"], "inner")
            words.append(F.col(f"_w{j}"))
        out = out.unionByName(cur.select(*g, F.concat_ws(" ", *words).alias(gram)))
    return out


def positions(docs: DataFrame, *, tokens: str = "tokens", order: str = "doc_id",
              groups: Sequence[str] = (), keep: Sequence[str] = ()) -> DataFrame:
    """Token rows with running corpus position ``gpos`` (per group).

    Offsets are computed on a document-level table (group, order, size) and
    joined back on the document key, so the token arrays are not carried
    through the prefix-sum shuffles.
    """
    g = list(groups)
    sizes = cut_lineage(docs.select(*g, order, F.size(tokens).alias("_n")))
    offs = with_offsets(sizes, order=order, count="_n", groups=g, offset="_off").drop("_n")
    toks = join_null_safe(docs.select(*g, *keep, order, tokens), offs, [*g, order], "inner")
    return toks.select(*g, *keep, order, "_off", F.posexplode(tokens).alias("pos", "word")).select(
        *g, *keep, order, "pos", "word", (F.col("_off") + F.col("pos")).alias("gpos"))


def row_numbers(df: DataFrame, *, by: Sequence[str], order: str, tiebreak: Sequence[str] = (),
                out: str = "row_number", ranges: int = RANGES) -> DataFrame:
    """1-based row number inside each group ``by`` in (``order``, ``tiebreak``) order.

    Same result as ``row_number()`` over a window partitioned by ``by``, but
    built from the two-level prefix sum, so a group holding a large share of
    the rows is numbered by many tasks (one per range of ``order`` values).
    ``order`` must be numeric.
    """
    one = df.withColumn("_one", F.lit(1))
    r = with_offsets(one, order=order, count="_one", groups=by, offset="_off", ranges=ranges, tiebreak=tiebreak)
    return r.withColumn(out, F.col("_off") + 1).drop("_one", "_off")


def exact_median(df: DataFrame, value: str, *, by: Sequence[str], out: str = "median") -> DataFrame:
    """Exact median of ``value`` per group, ``(*by, out)``; groups without a value are left out.

    Counts per distinct value get running offsets, and the middle one or two
    values are picked from them: no group's values are held by one task.
    """
    n = cut_lineage(df.filter(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("_n")))
    off = with_offsets(n, order=value, count="_n", groups=by, offset="_off")
    total = n.groupBy(*by).agg(F.sum("_n").alias("_all"))
    off = join_null_safe(off, total, list(by)) if by else off.withColumn("_all", total.scalar())

    def at(k):
        return F.max(F.when((F.col("_off") < k) & (k <= F.col("_off") + F.col("_n")), F.col(value)))

    low, high = F.floor((F.col("_all") + 1) / 2), F.floor(F.col("_all") / 2) + 1
    return off.groupBy(*by).agg(((at(low) + at(high)) / 2).alias(out))

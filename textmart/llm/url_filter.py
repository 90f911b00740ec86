"""URL filter: allow and block rules, and a path-template tree per host, with DataFrame functions only.

The tree grows from each host downwards, level by level. Below a node a segment stays a branch of its own if at least
``OWN_PAGES`` pages have it there; all rarer segments of the node are variable and share the branch ``*``, under which the
next level goes on. Levels end where no host has that many pages left. Each node of the tree counts its labelled pages. Branches of a
node whose share of good pages does not differ significantly from the rest of the node are merged: they share their
counts. A template's purity is smoothed down its path, each node towards its parent, the root towards all labelled pages;
a template is rejected below ``min_purity``.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmart.llm.common import join_split
from textmart.session import cut_lineage

#: (verdict, host, path prefix); the contract's rules.
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/"))
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Pages of its own that make a segment a branch of its node; fewer say too little about it.
OWN_PAGES = 5
#: Weight of the parent's purity, in pages; squared z value below which branches are merged; purity asked for.
WEIGHT, SIMILAR, MIN_PURITY = 4.0, 3.841459, 0.5


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, "://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def ordered(rules: Sequence[tuple[str, str, str]]) -> list[tuple[str, str, str]]:
    """Longest first; equal lengths by text."""
    return sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2]))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]], value: int | None) -> Column:
    """The rule's text (value None) or its verdict (value 0); null where none fits."""
    out = F.lit(None).cast("string")
    for r in reversed(ordered(rules)):
        fits = ((host == r[1]) | F.endswith(host, F.lit("." + r[1]))) & F.startswith(path, F.lit(r[2]))
        out = F.when(fits, F.lit(r[1] + r[2] if value is None else r[0])).otherwise(out)
    return out


def templates_of(rows: DataFrame, own_pages: int = OWN_PAGES) -> DataFrame:
    """``rows(id, host, path, good, segs)`` with their ``template``, ``segs`` left out.

    Every level counts the pages of a node and segment (an aggregate) and gives the segment or ``*`` to the pages; pages
    whose path ends leave. Hosts with fewer than ``own_pages`` pages that go on have only ``*`` from there.
    """
    done, now, k = [], cut_lineage(rows.withColumn("template", F.lit(""))), 0
    while True:
        done.append(now.filter(F.size("segs") <= k))
        now = now.filter(F.size("segs") > k)
        large = now.groupBy("host").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= own_pages)
        if not large.take(1):
            break
        now = now.withColumn("seg", F.get("segs", F.lit(k)))
        own = now.groupBy("host", "template", "seg").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= own_pages)
        now = join_split(now, own, ["host", "template", "seg"], "left")
        token = F.when(F.col("n").isNotNull(), F.col("seg")).otherwise(F.lit("*"))
        now = now.withColumn("template", F.concat("template", F.lit("/") if k else F.lit(""), token))
        now, k = cut_lineage(now.select(*rows.columns, "template")), k + 1
    rest = F.array_join(F.array_repeat(F.lit("*"), F.size("segs") - k), "/")
    done.append(now.withColumn("template", F.concat("template", F.lit("/") if k else F.lit(""), rest)))
    return cut_lineage(reduce(DataFrame.unionByName, done).drop("segs"))


def judge(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", label_col: str | None = None,
          rules: Sequence[tuple[str, str, str]] = RULES, weight: float = WEIGHT, min_purity: float = MIN_PURITY) -> DataFrame:
    """``(<id_col>, host, path, rule, verdict, template, purity)`` for every row.

    ``label_col`` is 1 for a good page, 0 for a bad one, null where unlabelled. A null url or one without ``://`` has an
    empty host and path and counts to the host ``''``. Without any label the prior is 1 and only rules block. Repeated rows
    count and come out repeatedly; long paths have long templates; other columns are not read.
    """
    good = F.col(label_col).cast("int") if label_col else F.lit(None).cast("int")
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), good.alias("good"))
    rows = rows.select("id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), "good")
    rows = rows.withColumn("segs", F.filter(F.split("path", "/"), lambda s: s != ""))

    paged = templates_of(rows)

    count = (F.count("good").alias("n"), F.sum(F.coalesce("good", F.lit(0))).alias("g"))
    templates = cut_lineage(paged.groupBy("host", "template").agg(*count))
    prior = templates.agg(F.when(F.sum("n") > 0, F.sum("g") / F.sum("n")).otherwise(F.lit(1.0))).scalar()
    split = F.filter(F.split("template", "/"), lambda s: s != "")
    chain = templates.withColumn("tokens", split).withColumn("k", F.explode(F.sequence(F.lit(0), F.size("tokens"))))
    chain = chain.withColumn("node", F.array_join(F.slice("tokens", 1, F.col("k")), "/"))
    chain = chain.withColumn("parent", F.when(F.col("k") > 0, F.array_join(F.slice("tokens", 1, F.col("k") - 1), "/")))
    nodes = chain.groupBy("host", "k", "node", "parent").agg(F.sum("n").alias("n"), F.sum("g").alias("g"))
    above = nodes.select("host", F.col("node").alias("parent"), (F.col("k") + 1).alias("k"), F.col("n").alias("pn"), F.col("g").alias("pg"))
    p, rest = F.col("pg") / F.col("pn"), F.col("pn") - F.col("n")
    off = F.col("g") / F.col("n") - (F.col("pg") - F.col("g")) / rest
    similar = ((F.col("n") == 0) | (rest == 0) | (F.col("pg") == 0) | (F.col("pg") == F.col("pn"))
               | (F.try_divide(off * off, p * (1 - p) * (1 / F.col("n") + 1 / rest)) < SIMILAR))
    # guards first: the test is only reached with counts on both sides
    similar = F.when((F.col("n") == 0) | (rest == 0), F.lit(True)).otherwise(similar)
    child = nodes.filter("k > 0").join(above, ["host", "k", "parent"]).withColumn("similar", similar)
    pool = child.filter("similar").groupBy("host", "k", "parent").agg(F.sum("n").alias("mn"), F.sum("g").alias("mg"))
    child = child.join(pool, ["host", "k", "parent"], "left")
    merged = child.select("host", "k", "node", F.when(F.col("similar"), F.col("mn")).otherwise(F.col("n")).alias("n"),
                          F.when(F.col("similar"), F.col("mg")).otherwise(F.col("g")).alias("g"))
    merged = merged.unionByName(nodes.filter("k = 0").select("host", "k", "node", "n", "g"))
    steps = chain.select("host", "template", "k", "node").join(merged, ["host", "k", "node"])
    down = steps.groupBy("host", "template").agg(F.array_sort(F.collect_list(F.struct("k", "n", "g"))).alias("down"))
    down = down.withColumn("prior", prior.cast("double"))
    purity = F.aggregate("down", F.col("prior"), lambda acc, x: (x["g"] + F.lit(weight) * acc) / (x["n"] + F.lit(weight)))
    judged = down.select("host", "template", purity.alias("purity"))

    host, path = F.col("host"), F.col("path")
    verdict = F.coalesce(rule_of(host, path, rules, 0), F.when(F.col("purity") < min_purity, "block").otherwise("allow"))
    # a template may hold a third of all pages: both sides are shuffled for this join alone, so AQE can split it
    return (join_split(paged, judged, ["host", "template"])
            .select(F.col("id").alias(id_col), "host", "path", rule_of(host, path, rules, None).alias("rule"), verdict.alias("verdict"),
                    "template", "purity"))


def duck_sql() -> str:
    """The same over ``pages``, labelled by ``labels.quality`` of the document whose number ends the path."""
    rule = verdict = "NULL"
    for v, h, p in reversed(ordered(RULES)):
        fits = f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')"
        rule = f"CASE WHEN {fits} THEN '{h}{p}' ELSE {rule} END"
        verdict = f"CASE WHEN {fits} THEN '{v}' ELSE {verdict} END"
    return f"""
WITH RECURSIVE u AS (SELECT page_id AS id, coalesce(translate(regexp_extract(url, '://([^/?#]*)', 1), '{UPPER}', '{LOWER}'), '') AS host,
    coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
l AS (SELECT doc_id, min(quality) AS quality FROM labels GROUP BY doc_id),
r AS (SELECT id, host, path, quality AS good, list_filter(string_split(path, '/'), lambda s: s <> '') AS segs
      FROM u LEFT JOIN l ON l.doc_id = try_cast(regexp_extract(path, '([0-9]+)[^0-9/]*/?$', 1) AS BIGINT)),
grow(id, host, path, good, segs, k, tokens) AS (SELECT id, host, path, good, segs, 0, []::VARCHAR[] FROM r
  UNION ALL SELECT id, host, path, good, segs, k + 1, list_append(tokens,
    CASE WHEN count(*) OVER (PARTITION BY host, tokens, segs[k + 1]) >= {OWN_PAGES} THEN segs[k + 1] ELSE '*' END) FROM grow WHERE k < len(segs)),
paged AS (SELECT id, host, path, good, tokens FROM grow WHERE k = len(segs)),
t AS (SELECT host, array_to_string(tokens, '/') AS template, any_value(tokens) AS tokens, count(good) AS n, coalesce(sum(good), 0) AS g
      FROM paged GROUP BY host, array_to_string(tokens, '/')),
prior AS (SELECT CASE WHEN sum(n) > 0 THEN sum(g)::DOUBLE / sum(n) ELSE 1.0 END AS p FROM t),
c AS (SELECT host, template, k, array_to_string(tokens[:k], '/') AS node, CASE WHEN k > 0 THEN array_to_string(tokens[:k - 1], '/') END AS parent, n, g
      FROM (SELECT *, unnest(range(len(tokens) + 1)) AS k FROM t)),
nodes AS (SELECT host, k, node, parent, sum(n)::DOUBLE AS n, sum(g)::DOUBLE AS g FROM c GROUP BY host, k, node, parent),
child AS (SELECT x.*, CASE WHEN x.n = 0 OR y.n = x.n OR y.g = 0 OR y.g = y.n THEN true
            ELSE (x.g / x.n - (y.g - x.g) / (y.n - x.n)) ** 2 / (y.g / y.n * (1 - y.g / y.n) * (1 / x.n + 1 / (y.n - x.n))) < {SIMILAR} END AS alike
          FROM nodes x JOIN nodes y ON x.host = y.host AND x.k = y.k + 1 AND x.parent = y.node),
m AS (SELECT host, k, node, CASE WHEN alike THEN sum(n) OVER w ELSE n END AS n, CASE WHEN alike THEN sum(g) OVER w ELSE g END AS g
      FROM child WINDOW w AS (PARTITION BY host, k, parent, alike) UNION ALL SELECT host, k, node, n, g FROM nodes WHERE k = 0),
chain AS (SELECT c.host, c.template, c.k, m.n, m.g FROM c JOIN m ON c.host = m.host AND c.k = m.k AND c.node = m.node),
fold AS (SELECT host, template, -1::BIGINT AS k, p AS purity FROM t, prior
         UNION ALL SELECT fold.host, fold.template, chain.k, (chain.g + {WEIGHT} * purity) / (chain.n + {WEIGHT})
         FROM fold JOIN chain ON chain.host = fold.host AND chain.template = fold.template AND chain.k = fold.k + 1),
judged AS (SELECT host, template, arg_max(purity, k) AS purity FROM fold GROUP BY host, template)
SELECT id AS page_id, host, path, {rule} AS rule, coalesce({verdict}, CASE WHEN purity < {MIN_PURITY} THEN 'block' ELSE 'allow' END) AS verdict,
       template, purity
FROM (SELECT id, host, path, array_to_string(tokens, '/') AS template FROM paged) JOIN judged USING (host, template)"""

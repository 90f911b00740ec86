"""Merkle manifest of a dataset: a tree of digests per source and one over the sources, with a proof for every row.

The tree is built from windows over fixed-size runs. On a level a node knows its position in its group and how many nodes
the group has, hence its run of ``FANOUT`` nodes, its slot in the run and the run's length. Columns ``lag(k)`` and
``lead(k)``, k = 1 .. FANOUT - 1, masked by slot and run length, hold its siblings; the row of slot 0 hashes the run and is
the parent. Positions come from a range sort, so no task holds a whole source; a window's group is one run.

Defined cases: a null field is ``-`` in the leaf; a null source is a source of its own, the first one; rows without an id
come first in their source, rows that repeat an id are ordered by their leaf (equal rows are interchangeable); a source of
one row has that leaf as its root; a tree of one source has that source's root as root; an empty table has no rows and no
root. Only the named columns are read, whatever other columns are called; ``carry`` columns must be named apart from
``RESERVED``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textmart.session import cut_lineage

FANOUT = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
RESERVED = ("grp", "at", "pos", "n", "h", "run", "slot", "left", "right", "path", "subroot", "root")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def nothing() -> Column:
    return F.unhex(F.lit(""))


def hex_of(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def digest_of(digests: Column) -> Column:
    """Digest (binary) of digests joined as lowercase hex text; ``digests`` is their binary concatenation."""
    return F.unhex(F.sha2(hex_of(digests), 256))


def leaf_digest(fields: Sequence[Column]) -> Column:
    """Digest (binary) of a row: every field is ``-`` if null, else its number of UTF-8 bytes, a colon and its text."""
    parts = [F.coalesce(F.concat(F.octet_length(f.cast("string")).cast("string"), F.lit(":"), f.cast("string")), F.lit("-"))
             for f in fields]
    return F.unhex(F.sha2(F.concat(*parts), 256))


def numbered(nodes: DataFrame, order: Sequence[str]) -> DataFrame:
    """Add ``pos`` (from 0, in ``order`` inside ``grp``) and ``n`` (rows of the group) without a group in one task.

    Rows are range-sorted by group and order, ties split by their place in the written input, and written with the running
    number of their partition; the rows a group has in earlier partitions, one number per group and partition, are added.
    """
    nodes = cut_lineage(nodes).withColumn("_tie", F.monotonically_increasing_id())
    keys = ["grp", *order, "_tie"]
    placed = cut_lineage(nodes.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_tie")
                         .withColumn("at", F.monotonically_increasing_id()))
    part = F.shiftright("at", 33).alias("_part")
    each = placed.groupBy("grp", part).agg(F.min("at").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    group = Window.partitionBy("grp")
    before = F.sum("_rows").over(group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    each = each.select("grp", "_part", "_first", F.coalesce(before, F.lit(0)).alias("_before"), F.sum("_rows").over(group).alias("n"))
    found = placed.withColumn("_part", part).join(each, ["grp", "_part"])
    return found.withColumn("pos", F.col("at") - F.col("_first") + F.col("_before")).drop("at", "_part", "_first", "_before")


def with_siblings(level: DataFrame, *, later_only: bool = False) -> DataFrame:
    """Add ``run``, ``slot`` and the siblings of a node before it (``left``) and after it (``right``), joined in order."""
    run, slot = F.floor(F.col("pos") / FANOUT).cast("long"), (F.col("pos") % FANOUT).cast("int")
    level = level.withColumn("run", run).withColumn("slot", slot)
    over = "OVER (PARTITION BY grp, run ORDER BY slot)"
    lead = [f"CASE WHEN slot + {k} < least({FANOUT}, n - run * {FANOUT}) THEN lead(h, {k}) {over} END" for k in range(1, FANOUT)]
    lag = [f"CASE WHEN slot >= {k} THEN lag(h, {k}) {over} END" for k in range(FANOUT - 1, 0, -1)]
    joined = lambda cols: F.expr("concat(" + ", ".join(f"coalesce({c}, X'')" for c in cols) + ")")
    level = level.withColumn("right", joined(lead))
    return level if later_only else level.withColumn("left", joined(lag))


def next_level(level: DataFrame) -> DataFrame:
    """Rows of slot 0 hash their run; a node alone in its group stays as it is."""
    first = with_siblings(level.select("grp", "pos", "n", "h"), later_only=True).filter("slot = 0")
    h = F.when(F.col("n") > 1, digest_of(F.concat("h", "right"))).otherwise(F.col("h"))
    return first.select("grp", F.col("run").alias("pos"), F.ceil(F.col("n") / FANOUT).cast("long").alias("n"), h.alias("h"))


def build(leaves: DataFrame) -> list[DataFrame]:
    """All levels of the trees over ``leaves(grp, pos, n, h, ...)``; the last has one node for each group."""
    levels = [leaves]
    most = leaves.agg(F.max("n")).first()[0] or 0
    while most > 1:
        levels.append(cut_lineage(next_level(levels[-1])))
        most = -(-most // FANOUT)
    return levels


def paths(levels: list[DataFrame], top: DataFrame) -> DataFrame:
    """Leaves with ``path``, the (left, right) siblings from the leaf's level to the root, and the other columns of ``top``.

    ``top(grp, path, ...)`` has the path that every group's root has above it. A level's path is its siblings in front of
    its parent's path, so siblings are shuffled only as part of the next level's rows, a sixteenth of a level.
    """
    rest = [c for c in top.columns if c not in ("grp", "path")]
    up = top.withColumn("run", F.lit(0).cast("long")).withColumnRenamed("path", "_up")
    for k in range(len(levels) - 1, -1, -1):
        if k == len(levels) - 1:  # a group's root: nothing to add
            here = levels[k].join(up.drop("run"), "grp").withColumnRenamed("_up", "path")
        else:
            step = F.when(F.col("n") > 1, F.array(F.struct("left", "right"))).otherwise(F.array().cast("array<struct<left:binary,right:binary>>"))
            here = with_siblings(levels[k]).join(up, ["grp", "run"]).withColumn("path", F.concat(step, F.col("_up")))
            here = here.drop("run", "slot", "left", "right", "_up")
        if k:
            up = here.select("grp", F.col("pos").alias("run"), F.col("path").alias("_up"), *rest)
            up = cut_lineage(up) if k == 1 else up
    return here


def manifest(docs: DataFrame, *, fields: Sequence[str] = FIELDS, id_col: str = "doc_id", group_col: str = "source",
             carry: Sequence[str] = ()) -> DataFrame:
    """One row per row of ``docs``: ``(<id_col>, *carry, leaf, subroot, root, path)``, digests as binary.

    ``path`` is the proof: for every level up to the root the joined digests of the siblings before and after the node.
    ``fold(leaf, path)`` gives ``root`` for an untouched row.
    """
    # null first, then UTF-8 bytewise; never null, so that it can be joined
    grp = F.coalesce(F.concat(F.lit("1"), F.col(group_col).cast("string")), F.lit("0"))
    rows = docs.select(grp.alias("grp"), F.col(id_col).alias("_id"), leaf_digest([F.col(f) for f in fields]).alias("h"),
                       *[F.col(c).alias(f"_c{i}") for i, c in enumerate(carry)])
    levels = build(cut_lineage(numbered(rows, ["_id", "h"])))
    subroots = levels[-1].select(F.lit("").alias("grp"), F.col("grp").alias("_src"), "h")
    upper = build(cut_lineage(numbered(subroots, ["_src"])))
    no_path = F.array().cast("array<struct<left:binary,right:binary>>")
    root = upper[-1].select("grp", F.col("h").alias("root"), no_path.alias("path"))
    top = cut_lineage(paths(upper, root).select(F.col("_src").alias("grp"), "path", F.col("h").alias("subroot"), "root"))
    found = paths(levels, top)
    return found.select(F.col("_id").alias(id_col), *[F.col(f"_c{i}").alias(c) for i, c in enumerate(carry)],
                        F.col("h").alias("leaf"), "subroot", "root", "path")


def fold(leaf: Column, path: Column) -> Column:
    """The root that ``leaf`` and its siblings lead to (binary)."""
    return F.aggregate(path, leaf, lambda h, p: digest_of(F.concat(p["left"], h, p["right"])))


def proof_digest(path: Column) -> Column:
    """Lowercase hex digest of all siblings, level by level, left to right."""
    siblings = F.aggregate(path, nothing(), lambda all_, p: F.concat(all_, p["left"], p["right"]))
    return F.sha2(hex_of(siblings), 256)


def tamper_proof_report(docs: DataFrame) -> DataFrame:
    """Every row with its digests and what becomes of the root where the text of some rows is lower-cased (A-Z only).

    Tampered are the rows whose id, as decimal text, has a CRC-32 that 5 divides; a row without an id is not tampered.
    """
    other = leaf_digest([F.translate(f, UPPER, LOWER) if f == "text" else F.col(f) for f in FIELDS])
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    rows = docs.select(*FIELDS, F.when(tampered, other).alias("tampered_leaf"))
    found = manifest(rows, carry=["tampered_leaf"])
    found = found.withColumn("folded", fold(F.coalesce("tampered_leaf", "leaf"), F.col("path")))
    return found.select("doc_id", hex_of(F.col("leaf")).alias("leaf"), hex_of(F.col("subroot")).alias("subroot"),
                        hex_of(F.col("root")).alias("root"), proof_digest(F.col("path")).alias("proof_sha256"),
                        hex_of(F.col("folded")).alias("folded_root"), (F.col("folded") == F.col("root")).alias("verified"))


def duck_sql() -> str:
    """The report as DuckDB SQL over ``documents``: recursive levels by aggregates, siblings by joins."""
    def leaf(text: str) -> str:
        fields = ["doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text]
        return "sha256(" + " || ".join(f"coalesce(strlen({f})::VARCHAR || ':' || {f}, '-')" for f in fields) + ")"

    # CRC-32 bit by bit over the decimal digits of the id
    byte = "list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))"
    codes = "list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)"
    crc = f"xor(list_reduce(list_concat([4294967295::BIGINT], {codes}), lambda c, b: {byte}), 4294967295)"

    def levels(name: str, base: str) -> str:
        return f"""{name}(k, g, pos, n, h) AS ({base} UNION ALL
  SELECT k + 1, g, pos // {FANOUT}, (any_value(n) + {FANOUT - 1}) // {FANOUT}, sha256(string_agg(h, '' ORDER BY pos))
  FROM {name} WHERE n > 1 GROUP BY k, g, pos // {FANOUT})"""

    def siblings(name: str) -> str:
        return f"""{name}_s AS (SELECT a.k, a.g, a.pos, coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS l,
    coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS r
  FROM {name} a JOIN {name} b ON a.k = b.k AND a.g = b.g AND a.pos // {FANOUT} = b.pos // {FANOUT} WHERE a.n > 1 GROUP BY ALL)"""

    def folded(name: str, of: str, base: str) -> str:
        return f"""{name}(rid, k, g, pos, h, proof) AS ({base} UNION ALL
  SELECT rid, s.k + 1, s.g, s.pos // {FANOUT}, sha256(s.l || f.h || s.r), f.proof || s.l || s.r
  FROM {name} f JOIN {of}_s s ON s.k = f.k AND s.g = f.g AND s.pos = f.pos)"""

    last = "SELECT rid, arg_max(h, k) AS h, arg_max(proof, k) AS proof FROM {} GROUP BY rid"
    tampered_text = f"translate(text, '{UPPER}', '{LOWER}')"
    return f"""
WITH RECURSIVE d AS (SELECT doc_id, source, coalesce('1' || source, '0') AS g, {leaf('text')} AS leaf,
    CASE WHEN {crc} % 5 = 0 THEN {leaf(tampered_text)} END AS other FROM documents),
e AS (SELECT *, row_number() OVER (ORDER BY g, doc_id NULLS FIRST, leaf) AS rid,
    row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY g) AS n FROM d),
{levels('lv', 'SELECT 0, g, pos, n, leaf FROM e')},
sub AS (SELECT g AS src, row_number() OVER (ORDER BY g) - 1 AS pos, count(*) OVER () AS n, h FROM lv WHERE n = 1),
{levels('top', "SELECT 0, '', pos, n, h FROM sub")},
{siblings('lv')}, {siblings('top')},
{folded('f1', 'lv', "SELECT rid, 0, g, pos, coalesce(other, leaf), '' FROM e")},
m AS ({last.format('f1')}),
{folded('f2', 'top', "SELECT m.rid, 0, '', sub.pos, m.h, m.proof FROM m JOIN e ON e.rid = m.rid JOIN sub ON sub.src = e.g")},
t AS ({last.format('f2')}), r AS (SELECT h AS root FROM top WHERE n = 1)
SELECT e.doc_id, e.leaf, sub.h AS subroot, r.root, sha256(t.proof) AS proof_sha256, t.h AS folded_root, t.h = r.root AS verified
FROM e JOIN t ON t.rid = e.rid JOIN sub ON sub.src = e.g CROSS JOIN r"""

import hashlib
import zlib
from collections import defaultdict

from pyspark.sql import functions as F

from tests.llm.helpers import documents, table
from textmart.llm import merkle

FANOUT = 16
AZ = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def leaf(row, text):
    values = [None if v is None else str(v) for v in (row.doc_id, row.source, row.lang, row.n_chars)] + [text]
    return sha("".join("-" if v is None else f"{len(v.encode())}:{v}" for v in values))


def tree(hashes):
    levels = [hashes]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][i:i + FANOUT])) for i in range(0, len(levels[-1]), FANOUT)])
    return levels


def proof(levels, at):
    steps = []
    for level in levels[:-1]:
        first = at // FANOUT * FANOUT
        steps.append((level[first:at], level[at + 1:first + FANOUT]))
        at //= FANOUT
    return steps


def expected(rows):
    by_source = defaultdict(list)
    for r in rows:
        by_source[r.source].append((r.doc_id is not None, r.doc_id or 0, leaf(r, r.text), r))
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    levels = {s: tree([x[2] for x in by_source[s].sort(key=lambda x: x[:3]) or by_source[s]]) for s in order}
    top = tree([levels[s][-1][0] for s in order])
    out = []
    for i, s in enumerate(order):
        for at, (_, _, h, r) in enumerate(by_source[s]):
            steps = proof(levels[s], at) + proof(top, i)
            got = leaf(r, None if r.text is None else r.text.translate(AZ)) if r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0 else h
            for left, right in steps:
                got = sha("".join([*left, got, *right]))
            out.append((str(r.doc_id), h, levels[s][-1][0], top[-1][0], sha("".join("".join(a + b) for a, b in steps)), got, got == top[-1][0]))
    return sorted(out)


def check(docs):
    got = sorted((str(r.doc_id), *tuple(r)[1:]) for r in merkle.tamper_proof_report(docs).collect())
    assert got == expected(docs.collect())
    return got


def test_awkward_rows(spark):
    assert len(check(documents(spark))) == 10
    assert merkle.tamper_proof_report(documents(spark).limit(0)).count() == 0


def test_run_lengths_hot_and_null_sources(spark):
    """Groups of 1, 16, 17, 256, 257 and 600 rows, a null source and names that differ in case and script."""
    sizes = {"a": 1, "A": 16, "é": 17, "z": 256, "": 257, None: 600}
    rows = [(i * 7 % 5000, f"Text {i} of {s}", "en" if i % 3 else None, s, i if i % 2 else None) for s, n in sizes.items() for i in range(n)]
    got = check(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(7))
    assert {r[6] for r in got} == {True, False}


def test_one_row_and_untouched_rows(spark):
    docs = spark.createDataFrame([(4, "x", None, "s", 1)], "doc_id long, text string, lang string, source string, n_chars long")
    check(docs)
    found = merkle.manifest(table(spark, "documents"), carry=["lang"])
    assert found.filter(merkle.fold(F.col("leaf"), F.col("path")) != F.col("root")).count() == 0
    assert found.columns == ["doc_id", "lang", "leaf", "subroot", "root", "path"]

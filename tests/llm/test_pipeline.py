import hashlib

import numpy as np
import sentencepiece

import corpus_pipeline as P
from tests.llm.helpers import documents, table
from tests.llm.test_secrets import brute as base_findings
from tests.llm.test_simhash import classes, fingerprint
from textmart.llm.secrets import redacted
from textmart.llm.sentencepiece_codec import default_model

SF = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark):
    docs = table(spark, "documents")
    rows = {r.doc_id: r for r in docs.collect()}
    one = P.language_id(spark, docs, SF)
    kept = {r.doc_id: r for r in one.collect()}
    assert set(kept) == {i for i, r in rows.items() if r.text and any(c.isalpha() for c in r.text)}
    two = {r.doc_id for r in P.simhash_dedup(spark, one, SF).collect()}
    ids = sorted(kept)
    label = classes(np.array([fingerprint(kept[i].text) for i in ids], np.uint64))
    assert two == {ids[k] for k in set(label.tolist())}
    left = docs.filter(docs.doc_id.isin(sorted(two)))
    three = {r.doc_id for r in P.decontaminate(spark, left, SF).collect()}
    items = [r.text for r in table(spark, "benchmark").collect()]
    assert three == {i for i in two if not any(t in kept[i].text for t in items)}
    four = P.redact_secrets(spark, docs.filter(docs.doc_id.isin(sorted(three))), SF).collect()
    for r in four:
        base = [(s, k, e, 1.0) for s, k, e in base_findings(kept[r.doc_id].text)]
        if r.text != redacted(kept[r.doc_id].text, base):  # only the network's findings may be added
            assert "[SECRET]" in r.text
        assert r.n_chars == len(r.text)
    sp = sentencepiece.SentencePieceProcessor(model_file=default_model())
    texts = {r.doc_id: r.text for r in four}
    got = {r.doc_id: r for r in P.run(spark, SF).collect()}
    assert set(got) == set(texts)
    for i, r in got.items():
        want = sp.encode(texts[i])
        assert r.ids == want and r.ids_sha256 == hashlib.sha256(",".join(map(str, want)).encode()).hexdigest()


def test_columns_and_awkward_rows(spark):
    docs = documents(spark).select("doc_id", "text", "lang", "source", docs_chars(spark))
    for name, stage in P.STAGES[:-1]:
        for rows in (docs, docs.limit(0)):
            out = stage(spark, rows, SF)
            assert out.columns == list(P.COLUMNS), name
            out.collect()
    assert P.STAGES[-1][1](spark, docs, SF).count() == docs.count()
    dedup = P.simhash_dedup(spark, docs, SF).collect()
    assert sorted(str(r.doc_id) for r in dedup) == ["1", "4", "5", "6", "7", "None"]


def test_repeated_and_missing_ids(spark):
    item = table(spark, "benchmark").first().text
    texts = [(1, "alpha beta gamma delta epsilon zeta"), (1, "another text that is not like the first one at all"), (1, "alpha beta gamma delta epsilon zeta"),
             (2, "alpha beta gamma delta epsilon zeta"), (None, "alpha beta gamma delta epsilon zeta"), (None, "a text without an id, and no copy of it"),
             (None, item), (3, item)]
    docs = documents(spark, texts).select("doc_id", "text", "lang", "source", docs_chars(spark))
    kept = sorted((str(r.doc_id), r.text) for r in P.simhash_dedup(spark, docs, SF).collect())
    assert kept == sorted([("1", texts[0][1]), ("1", texts[1][1]), ("None", texts[5][1]), ("3", item)])
    clean = [r.text for r in P.decontaminate(spark, docs, SF).collect()]
    assert item not in clean and len(clean) == 6


def docs_chars(spark):
    from pyspark.sql import functions as F

    return F.length("text").cast("long").alias("n_chars")

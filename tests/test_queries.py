"""Every registered query against its DuckDB oracle on the smallest test tables, plus plan checks."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

import __spark_entry__ as E
from tests.conftest import SMALL, have_data
from tests.oracle_check import compare, duck
from textmart.operators import tokens
from textmart.plans import catalog

pytestmark = pytest.mark.skipif(not have_data(SMALL), reason="test tables not present")

QUERIES, ORACLES = catalog.QUERIES, catalog.ORACLES
NAMES = sorted(ORACLES)


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


def test_every_query_has_an_oracle_but_trained_models():
    assert set(QUERIES) - set(ORACLES) <= {"classifier_evaluation", "classifier_cross_validation", "classifier_confusion"}
    assert set(QUERIES) <= set(E.queries()) and set(ORACLES) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    problems, n, _, _ = compare(spark, SMALL, name, QUERIES[name], ORACLES[name], con)
    assert not problems, problems


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["source", "word", "count", "rank"]
    assert df.count() > 0


def test_trained_models(spark):
    rows = QUERIES["classifier_evaluation"](spark, SMALL).collect()
    assert len(rows) == 4 and sum(r.best for r in rows) == 1
    assert all(0 <= v <= 1 for r in rows for v in (r.accuracy, r.f1_macro, r.f1_weighted))
    assert max(r.accuracy for r in rows) == [r.accuracy for r in rows if r.best][0]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_top_k_per_group_uses_window_group_limit(spark):
    p = plan(QUERIES["top_terms_by_source"](spark, SMALL))
    assert "WindowGroupLimit" in p


def windows_over_one_partition(p: str) -> list[str]:
    """Window nodes of a plan whose rows come through a single partition."""
    lines, found = p.split("\n"), []
    for k, line in enumerate(lines):
        if "Window [" in line and "WindowGroupLimit" not in line:
            depth = len(line) - len(line.lstrip(" :+-*()0123456789"))
            for below in lines[k + 1:]:
                if len(below) - len(below.lstrip(" :+-*()0123456789")) <= depth:
                    break
                if "Exchange" in below:
                    if "SinglePartition" in below:
                        found.append(line)
                    break
    return found


def test_the_guard_sees_a_single_partition_window(spark):
    df = spark.read.parquet(f"{SMALL}/documents.parquet")
    bad = df.select("doc_id", F.row_number().over(Window.orderBy("doc_id")).alias("n"))
    assert windows_over_one_partition(plan(bad))


def test_no_single_partition_window_over_documents(spark):
    docs = catalog.doc_tokens(spark, SMALL, "doc_id", "source")
    sizes = docs.select("source", "doc_id", F.size("tokens").alias("n"))
    plans = [tokens.positions(docs), tokens.ngram_table(docs, [2, 3]), tokens.row_numbers(sizes, by=["source"], order="doc_id"),
             tokens.with_offsets(sizes, order="doc_id", count="n"), *(QUERIES[q](spark, SMALL) for q in ("lexical_dispersion", "article_sentiment", "classifier_dataset"))]
    for df in plans:
        assert not windows_over_one_partition(plan(df))


def test_topic_plan_has_no_product(spark):
    for q in ("topic_scores", "topic_classification", "topic_lemma_scores"):
        p = plan(QUERIES[q](spark, SMALL))
        assert "NestedLoop" not in p and "Cartesian" not in p


def test_scan_prunes_columns_and_pushes_filters(spark):
    df = QUERIES["event_series_stats"](spark, SMALL)
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<ts:" in p and "user_id" not in p.split("ReadSchema")[1].split("\n")[0]

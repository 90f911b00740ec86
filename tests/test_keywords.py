import random

from pyspark.sql import functions as F

from textmart.operators import freq, keywords as K


def texts(n=60):
    rng = random.Random(8)
    return ["".join(rng.choice("abcé 😀") for _ in range(rng.randrange(400))) for _ in range(n)] + [None, "", "aaaaa", "AbA"]


def test_thousands_of_keywords_equal_str_count(spark):
    rng = random.Random(9)
    words = sorted({"".join(rng.choice("abcé") for _ in range(rng.choice([1, 2, 4, 5, 6, 7]))) for _ in range(9000)} | {"aa", "never there", "😀", "é "})
    assert len(words) > 2000
    rows = texts()
    df = spark.createDataFrame(list(enumerate(rows)), "id long, t string").repartition(5)
    want = {w: (sum((t or "").lower().count(w) for t in rows), sum(w in (t or "").lower() for t in rows)) for w in words}
    want = {w: v for w, v in want.items() if v[0]}
    assert {r.keyword: (r.mentions, r.texts) for r in K.mentions(df, "t", words).collect()} == want
    assert {r.keyword: r.mentions for r in freq.keyword_mentions(df, "t", words).collect()} == {w: v[0] for w, v in want.items()}
    table = spark.createDataFrame([(w,) for w in [*words, None, "", words[0]]], "keyword string")
    assert {r.keyword: (r.mentions, r.texts) for r in K.mentions(df, "t", table).collect()} == want
    each = {(r.id, r.keyword): r.n for r in K.matches(df, "t", words, key="id").collect()}
    assert each == {(i, w): n for i, t in enumerate(rows) for w in words if (n := (t or "").lower().count(w))}


def test_shards_categories_and_native_form(spark, monkeypatch):
    df = spark.createDataFrame([(t,) for t in texts()], "t string")
    by = {"x": ["a", "ab", "bc"], "y": ["ab", "é", "zz"], "z": []}
    native = freq.keyword_mentions(df, "t", by)
    got = K.mentions(df, "t", by)
    assert sorted(map(tuple, got.drop("texts").collect())) == sorted(map(tuple, native.collect()))
    table = spark.createDataFrame([(c, k) for c, ks in by.items() for k in ks], "category string, keyword string")
    monkeypatch.setattr(K, "SHARD_BYTES", 2)
    got = K.mentions(df, "t", table).select("category", "keyword", "mentions")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, native.collect()))
    assert K.mentions(df, F.col("t"), []).count() == 0 == K.mentions(df.limit(0), "t", ["a"]).count()


def test_work_is_linear_in_the_text(spark):
    """A hundred times the keywords leave the steps of the automaton on a text without matches as they are."""
    import time

    text = "x" * 200_000

    def seconds(n):
        count = K.counter([f"k{i}" for i in range(n)])
        began = time.perf_counter()
        assert not any(count(text) for _ in range(20))
        return time.perf_counter() - began

    few, many = min(seconds(200) for _ in range(3)), min(seconds(20_000) for _ in range(3))
    assert many < 10 * few

"""Edge cases of the column functions, checked against plain Python definitions."""

import math

import pytest
from pyspark.sql import functions as F

from textmart import dictionaries as D
from textmart.functions import rules as R
from textmart.functions import scores as S
from textmart.functions import text as T


def one(spark, expr, data, schema="t string"):
    return [r[0] for r in spark.createDataFrame(data, schema).select(expr).collect()]


# input text -> (tokens of the cleaning rule without English stop words, tokens of the tokenising rule)
TEXTS = [
    ("", [], []),
    ("the and of", [], ["the", "and", "of"]),
    ("Don't stop — it’s Україна’s day", ["stop", "україна", "day"], ["don't", "stop", "it's", "україна's", "day"]),
    ("Ёлка ы э ъ слово", ["лка", "слово"], ["лка", "слово"]),
    ("a1b2c3 xyz", ["xyz"], ["a", "b", "c", "xyz"]),
    ("Привіт, світ! Hello world 2026", ["привіт", "світ", "hello", "world"], ["привіт", "світ", "hello", "world"]),
    ("  spaced\ttabs\nnew  ", ["spaced", "tabs", "new"], ["spaced", "tabs", "new"]),
]


def test_clean_tokens(spark):
    got = one(spark, T.clean_tokens("t", stop_words=D.ENGLISH_STOP_WORDS), [(t,) for t, _, _ in TEXTS])
    assert got == [clean for _, clean, _ in TEXTS]


def test_tokenize(spark):
    got = one(spark, T.tokenize("t"), [(t,) for t, _, _ in TEXTS])
    assert got == [tokens for _, _, tokens in TEXTS]


def test_null_text_gives_no_tokens(spark):
    assert one(spark, T.clean_tokens("t"), [(None,)]) == [[]]


def test_stem_first_suffix_in_list_order(spark):
    # the first suffix of the list that leaves more than two letters goes, also where a longer one would fit
    suffixes = ["ing", "s", "tion", "ations"]
    words = {"running": "runn", "sing": "sing", "nations": "nation", "ration": "ra" + "tion", "motions": "motion", "station": "sta", "": "", "as": "as"}
    got = one(spark, T.stem("t", suffixes), [(w,) for w in words])
    assert got == list(words.values())


def test_normalize_job_text(spark):
    txt = "Senior C++ / C# dev: A/B tests, see https://x.io/a or mail me@x.com 🙂 Python!!"
    got = one(spark, T.normalize_job_text("t"), [(txt,)])[0]
    assert got == "senior cplusplus csharp dev ab_test tests see or mail python"


def test_job_tokens_drop_digits_and_short(spark):
    got = one(spark, T.job_tokens(T.normalize_job_text("t"), ["the"]), [("The 2026 sql and 3 years x1",)])[0]
    assert got == ["sql", "and", "years"]


def test_ngrams_within_array(spark):
    df = spark.createDataFrame([(["a", "b", "c"],), (["a"],), ([],)], "t array<string>")
    got = [r[0] for r in df.select(T.ngrams(F.col("t"), 2)).collect()]
    assert got == [["a b", "b c"], [], []]


def test_compact_text(spark):
    got = one(spark, T.compact_text("t", 10), [("short  text",), ("a  b\n c",), ("x" * 12,)])
    assert got == ["short text", "a b c", "x" * 9 + "…"]


def test_detect_language(spark):
    assert one(spark, T.detect_language("t"), [("Привіт world",), ("hello світ",), ("",)]) == ["uk", "en", "en"]


def test_experience_years(spark):
    texts = ["2+ years of SQL", "no digits here", "2-3 years", "999999999999999999999 років", "0003 years", "7 рік"]
    got = one(spark, R.experience_years("t"), [(t,) for t in texts])
    assert got == [2, 0, 3, 0, 3, 7]
    capped = one(spark, R.experience_years("t", cap=10), [("25 years",), ("2 years",)])
    assert capped == [10, 2]
    assert one(spark, R.experience_years("t"), [("25 years",)]) == [25]


def test_technologies_overlap_and_order(spark):
    got = one(spark, R.technologies("t"), [("We use PostgreSQL and pandas",), ("nothing",), ("R, and Spark",)])
    assert got == [["SQL", "Python"], [], ["Spark"]]


def test_job_level_rule_order(spark):
    df = spark.createDataFrame([("Lead Data Analyst", "junior welcome"), ("Analyst", "midnight shifts"),
                                ("Analyst", "")], "a string, b string")
    got = [r[0] for r in df.select(R.job_level("a", "b")).collect()]
    assert got == ["Lead/Head", "Middle", "Not Specified"]


def test_date_part_and_period(spark):
    assert one(spark, R.date_part("t"), [("12:30 15.02.2026",), ("15.02.2026",), ("",)]) == ["15.02.2026", "15.02.2026", ""]
    ts = spark.createDataFrame([("2026-02-15T09:05+02:00",), ("2026-02-15T12:00+02:00",), ("2026-02-15T23:59:59",)], "t string")
    got = [r[0] for r in ts.select(R.part_of_day(R.parse_iso_minutes("t"))).collect()]
    assert got == D.PERIODS


def test_iso_from_clock_date(spark):
    assert one(spark, R.iso_from_clock_date("t"), [("17:56 13.04.2026 Пн",)]) == ["2026-04-13T17:56+02:00"]


def test_tonal_metrics(spark):
    # Joy, Fear, Anger, Sadness, Disgust, Surprise, None -> label, score, stars, confidence
    table = [
        ([0.9, 0.1, 0.1, 0.1, 0.1, 0.5, 0.2], "Positive", 0.5, 4.0, 0.7),
        ([0.0] * 7, "Neutral", 0.0, 3.0, 0.0),
        ([0.1, 0.9, 0.8, 0.7, 0.6, 0.0, 0.1], "Negative", -2.9 / 3.2, 3 - 5.8 / 3.2, 3.0 / 3.2),
        ([0.25, 0.0, 0.0, 0.0, 0.0, 0.25, 0.5], "Positive", 0.5, 4.0, 0.5),
        ([0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.4], "Neutral", 0.0, 3.0, 1.0),
    ]
    df = spark.createDataFrame([(i, r[0]) for i, r in enumerate(table)], "i int, p array<double>")
    cols = [F.col("p").getItem(j).alias(f"p_{x}") for j, x in enumerate(D.EMOTION_LABELS)]
    for r in S.with_tonal_metrics(df.select("i", *cols)).collect():
        _, label, score, stars, confidence = table[r["i"]]
        assert r["tonal_label"] == label
        assert math.isclose(r["tonal_score"], score) and math.isclose(r["tonal_stars"], stars)
        assert math.isclose(r["confidence"], confidence)


def test_emotion_thresholds(spark):
    df = spark.createDataFrame([(0.36, 0.5, 0.26, 0.49, 0.31, 0.2, 0.35)],
                               ", ".join(f"`p_{x}` double" for x in D.EMOTION_LABELS))
    assert df.select(S.emotions_from_columns()).first()[0] == ["Joy", "Anger", "Disgust"]


def test_safe_name_and_file_labels(spark):
    assert one(spark, S.safe_name("t"), [("Lip Gloss #5!",), ("___",), (None,)]) == ["Lip_Gloss_5", "product", "product"]
    assert one(spark, S.product_from_file("t"), [("/a/makeup_reviews(Foo Bar).json",), ("/a/other.json",)]) == \
        ["Foo Bar", "other"]
    assert one(spark, S.source_from_file("t"), [("/x/ukr_pravda_news.json",)]) == ["Ukr Pravda"]


@pytest.mark.parametrize("url,cat", [("https://life.pravda.com.ua/x", "life"), ("https://www.pravda.com.ua/y", "politics"),
                                     ("https://oboronka.mezha.ua/z", "defence"), ("https://mezha.ua/q", "technologies"),
                                     (None, "other"), ("http://elsewhere", "other")])
def test_url_category_first_match(spark, url, cat):
    from textmart.operators.joins import first_prefix_match
    df = spark.createDataFrame([(url,)], "u string")
    assert df.select(first_prefix_match(F.col("u"), D.URL_CATEGORY_RULES)).first()[0] == cat

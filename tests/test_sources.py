"""File sources/sinks and the streaming counts, on small fixture files written to a scratch folder."""

import datetime as dt
import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from textmart.operators import reviews as RV
from textmart.operators import timeline
from textmart.sources import files
from textmart.sources import pages as PG
from textmart.streaming import daily_terms


def scratch():
    return tempfile.mkdtemp(prefix="textmart-test-")


def test_read_articles_labels_order_and_missing_category(spark):
    d = scratch()
    a = [{"title": "A1", "link": "l1", "time": "2026-02-15T09:05+02:00", "content": "x", "category": "politics"},
         {"title": "A2", "link": "l2", "time": "2026-02-15T10:00+02:00", "content": "y"}]
    b = [{"title": "B1", "link": "l3", "time": "2026-02-16T21:00+02:00", "content": "z"}]
    json.dump(a, open(os.path.join(d, "ukr_pravda_news.json"), "w"), ensure_ascii=False)
    json.dump(b, open(os.path.join(d, "suspilne_news.json"), "w"), ensure_ascii=False)
    rows = files.read_articles(spark, os.path.join(d, "*_news.json")).orderBy("source", "ord").collect()
    assert [(r.source, r.ord, r.title, r.category) for r in rows] == [
        ("Suspilne", 0, "B1", None), ("Ukr Pravda", 0, "A1", "politics"), ("Ukr Pravda", 1, "A2", None)]


def test_read_reviews_product_and_strip(spark):
    d = scratch()
    json.dump([{"text": "  good  ", "stars": 5, "product": "u"}, {"text": None, "stars": 0, "product": "u"}],
              open(os.path.join(d, "makeup_reviews(Lip Gloss).json"), "w"))
    rows = files.read_reviews(spark, os.path.join(d, "*.json")).orderBy("ord").collect()
    assert [(r.product, r.text, r.stars) for r in rows] == [("Lip Gloss", "good", 5), ("Lip Gloss", "", 0)]


def test_word_lists_union_distinct(spark):
    d = scratch()
    open(os.path.join(d, "a.txt"), "w").write("# comment\nsql\n\n  python \nsql\n")
    open(os.path.join(d, "b.txt"), "w").write("Python\nexcel\n")
    got = sorted(r.word for r in files.read_word_list(spark, [os.path.join(d, "a.txt"), os.path.join(d, "b.txt")],
                                                       lower=True).collect())
    assert got == ["excel", "python", "sql"]


def test_csv_with_bom_and_multiline_cell(spark):
    d = scratch()
    p = os.path.join(d, "table.csv")
    open(p, "w", encoding="utf-8-sig").write('День,Час,Топ 5\n"День 1\n15.02.2026",Ранок,лютого\n,,україни\n')
    df = files.read_csv(spark, p)
    assert df.columns[0] == "День"
    rows = df.collect()
    assert rows[0]["День"] == "День 1\n15.02.2026" and rows[1]["Топ 5"] == "україни"


def test_product_outputs_partitioned_by_safe_name(spark):
    out = os.path.join(scratch(), "out")
    rows = spark.createDataFrame([("Lip Gloss #5", "nice", 5, "Positive", 0.5, 4.0, 0.7)],
                                 "product string, review string, stars int, tonal_label string, tonal_score double, "
                                 "tonal_stars double, confidence double")
    RV.write_product_outputs(rows, out)
    assert os.path.isdir(os.path.join(out, "product_key=Lip_Gloss_5"))


def test_good_pages_drops_only_sentinel(spark):
    pages = spark.createDataFrame([(1, "https://x/", "<html><article><p>a &amp; b</p><p> </p><p>c</article>"),
                                   (2, "https://y/", "<html><div>no article</div></html>")], "page_id long, url string, html string")
    recs = PG.extract_pages(pages)
    got = {r.page_id: (r.content, r.status) for r in recs.collect()}
    assert got[1] == ("a & b\n\nc", "ok") and got[2][1] == "not_found"
    assert [r.page_id for r in PG.good_pages(recs).collect()] == [1]


def test_streaming_counts_match_batch(spark):
    d = scratch()
    src = os.path.join(d, "in")
    rows = [(1, dt.datetime(2026, 2, 15, 9, 5), "war news war peace"),
            (2, dt.datetime(2026, 2, 15, 13, 0), "peace talks"),
            (3, dt.datetime(2026, 2, 16, 20, 0), "war again")]
    spark.createDataFrame(rows, daily_terms.ARTICLE_STREAM_SCHEMA).write.parquet(src)
    stream = daily_terms.read_article_stream(spark, src)
    q = daily_terms.start(daily_terms.daily_term_counts(stream), checkpoint=os.path.join(d, "ckpt"),
                          name="tm_daily_terms", sink="memory", output_mode="update")
    q.processAllAvailable()
    got = {(str(r.day.start.date()), r.period, r.word): r.freq for r in spark.sql("SELECT * FROM tm_daily_terms").collect()}
    q.stop()
    batch = spark.createDataFrame(rows, daily_terms.ARTICLE_STREAM_SCHEMA).select(
        "ts", F.explode(daily_terms.T.clean_tokens("text")).alias("word"))
    exp = {(str(r.date), r.period, r.word): r.freq
           for r in timeline.top_per_period(timeline.with_day_period(batch), 100).collect()}
    assert got == exp


def test_csv_sink_roundtrip_fixed_order(spark):
    out = os.path.join(scratch(), "summary")
    df = spark.createDataFrame([("Rbc", 120, 0.212427)], "source string, articles long, ttr_lemma double")
    files.write_csv(df, out, ["articles", "source", "ttr_lemma"])
    back = files.read_csv(spark, out)
    assert back.columns == ["articles", "source", "ttr_lemma"] and back.first()["source"] == "Rbc"


def test_review_cap_order_and_share(spark):
    from textmart.operators import freq
    reviews = spark.createDataFrame([("p1", i, i % 5) for i in range(10)] + [("p2", 20, 0)],
                                    "product string, ord long, stars int")
    capped = RV.cap_per_product(reviews, 3)
    assert sorted((r.product, r.ord) for r in capped.collect()) == [("p1", 0), ("p1", 1), ("p1", 2), ("p2", 20)]
    summary = spark.createDataFrame([("a", None), ("b", 4.5), ("c", 3.0)], "product string, avg_stars double")
    assert {r.product: r.position for r in RV.order_products(summary).collect()} == {"b": 1, "c": 2, "a": 3}
    shares = freq.share_of_total(spark.createDataFrame([("x", 1), ("y", 3)], "k string, n long"), "n")
    assert {r.k: r.pct for r in shares.collect()} == {"x": 25.0, "y": 75.0}


def test_json_arrays_are_numbered_and_malformed_files_fail(spark):
    d = scratch()
    good, bad = os.path.join(d, "a b+c_news.json"), os.path.join(d, "bad_news.json")
    with open(good, "w", encoding="utf-8") as f:
        json.dump([{"title": f"t{k}", "content": "c", "link": None} for k in range(5)], f)
    with open(os.path.join(d, "z_news.json"), "w", encoding="utf-8") as f:
        json.dump([{"title": "last"}], f)
    rows = files.read_articles(spark, [good, os.path.join(d, "z_news.json"), os.path.join(d, "none.json")], skip_missing=True).collect()
    assert [(r.title, r.ord, r.doc_id) for r in sorted(rows, key=lambda r: r.doc_id)] == [*((f"t{k}", k, k) for k in range(5)), ("last", 0, 5)]
    with open(bad, "w", encoding="utf-8") as f:
        f.write('[{"title": "x"}, {"title": ')
    with pytest.raises(Exception, match="MALFORMED|FAILED_READ|Malformed"):
        files.read_articles(spark, bad).collect()
    assert files.missing_paths(spark, [good, os.path.join(d, "none.json")]) == [os.path.join(d, "none.json")]
    assert files.read_articles(spark, [os.path.join(d, "none.json")], skip_missing=True).count() == 0
    assert files.read_word_list(spark, [os.path.join(d, "none.txt")]).count() == 0


def test_blank_reviews_take_no_place(spark):
    rows = spark.createDataFrame([("p", 1, "\n\t ", 0.9, 0.9), ("p", 2, "fine", 0.5, 0.9), ("p", 3, "poor", -0.5, 0.2)],
                                 "product string, ord long, review string, tonal_score double, confidence double")
    got = [(r.kind, r["rank"], r.ord) for r in RV.extreme_reviews(rows, n=2).collect()]
    assert sorted(got) == [("negative", 1, 3), ("negative", 2, 2), ("positive", 1, 2), ("positive", 2, 3)]
    assert [r.ord for r in RV.extreme_reviews(rows, n=2, min_confidence=0.5).collect()] == [2, 2]


def test_files_round_trip_a_given_table(spark):
    """Documents written as one JSON array per source and read back."""
    from tests.conftest import SMALL

    d = scratch()
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "source", "text").collect()
    for s in {r.source for r in docs}:
        with open(os.path.join(d, f"{s}_news.json"), "w", encoding="utf-8") as f:
            json.dump([{"title": str(r.doc_id), "content": r.text} for r in docs if r.source == s], f, ensure_ascii=False)
    back = files.read_articles(spark, f"{d}/*_news.json").collect()
    assert sorted((int(r.title), r.content) for r in back) == sorted((r.doc_id, r.text) for r in docs)
    assert {r.source.lower() for r in back} == {r.source for r in docs}
    assert sorted(r.doc_id for r in back) == list(range(len(docs)))


def test_topic_profiles_from_files(spark):
    from textmart.plans import topics

    d = scratch()
    for k in range(2):
        with open(os.path.join(d, f"t{k}.json"), "w", encoding="utf-8") as f:
            json.dump({"topic_id": f"t{k}", "topic_name": {"en": f"Topic {k}"}, "keywords": {"en": ["alpha", ("zero", "one")[k]], "uk": ["слово"]}}, f, ensure_ascii=False)
    prof = topics.read_topic_profiles(spark, [os.path.join(d, x) for x in ("t0.json", "none.json", "t1.json")])
    got = sorted((r.topic_id, r.topic_ord, r.lang, r.topic_name, r.keywords) for r in prof.collect())
    assert got == [("t0", 0, "en", "Topic 0", ["alpha", "zero"]), ("t0", 0, "uk", None, ["слово"]),
                   ("t1", 1, "en", "Topic 1", ["alpha", "one"]), ("t1", 1, "uk", None, ["слово"])]
    texts = spark.createDataFrame([(1, "one and alpha"), (2, "інше слово тут")], "text_id long, text string")
    _, best = topics.classify(texts, prof)
    assert {r.text_id: r.topic for r in best.collect()} == {1: "t1", 2: "t0"}
    assert topics.read_topic_profiles(spark, [os.path.join(d, "none.json")]).count() == 0


def test_listing_date_and_clock(spark):
    from textmart.functions import rules, text

    df = spark.createDataFrame([(dt.date(2026, 4, 13), " 17:56 ", "a  very\nlong title of a record")], "d date, t string, title string")
    r = df.select(rules.iso_from_date_and_clock("d", "t").alias("iso"), text.short_title("title", 12).alias("short")).first()
    assert r.iso == "2026-04-13T17:56+02:00" and r.short == "a  very\nlong..."


def test_page_rules_by_class_and_nesting(spark):
    from textmart.sources import page_rules

    html = """<div class="list"><div class="review big"><p class="text">Nice &amp; soft</p><span class="Star filled"></span><span class="Star filled"></span>
      <a class="who" href="/u/1">Ann</a><time datetime="2026-04-13">13.04</time></div><div class="review"><a class="who" href="/u/2">Bob</a></div>
      <div class="review"><p class="text">No stars<a class="who">Eve</a></div></div>"""
    pages = spark.createDataFrame([(1, html), (2, None), (None, "")], "page_id long, html string")
    fields = {"text": ("p.text", "text"), "stars": (".filled", "count"), "who": ("a.who", "text"), "link": ("a", "@href"), "time": ("time", "@datetime")}
    got = [tuple(r) for r in page_rules.listing(pages, "div.review", fields, required=["text"]).collect()]
    assert got == [(1, 0, "Nice & soft", 2, "Ann", "/u/1", "2026-04-13"), (1, 2, "No starsEve", 0, "Eve", None, None)]
    nested = '<article class="a"><p>one</p><article><p>two<script>x</script></p></article><p> </p><ul><li>three</ul><p>after</article><p>outside</p>'
    pages = spark.createDataFrame([(1, nested), (2, "<p>none</p>"), (3, None)], "page_id long, html string")
    got = {r.page_id: r.content for r in page_rules.body_text(pages, "article.a", paragraphs=("p", "li")).collect()}
    assert got == {1: "one\n\ntwo\n\nthree\n\nafter", 2: "[Content structure not found]", 3: "[Content structure not found]"}


def test_page_rules_agree_with_the_page_records(spark):
    """S9 on a given table: both extractions of the stored pages."""
    from tests.conftest import SMALL
    from textmart.sources import page_rules

    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    squeeze = lambda t: " ".join(t.split())
    one = {r.page_id: squeeze(r.content) for r in PG.extract_pages(pages).collect()}
    two = {r.page_id: squeeze(r.content) for r in page_rules.body_text(pages, "article").collect()}
    assert one == two

"""Operators checked against brute-force Python on small fixtures, plus the published golden values."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from textmart.operators import classify, colloc, freq, lexicon, olap, similarity, tfidf, timeline, trend
from textmart.operators.joins import prefix_join
from textmart.operators.tokens import exact_median, ngram_table, positions, row_numbers, with_offsets
from textmart.plans import topics

random.seed(7)
VOCAB = ["alpha", "beta", "gamma", "delta", "eps", "zeta"]


def corpus(n_docs=40, max_len=9, groups=("a", "b", "c")):
    docs = []
    for i in range(n_docs):
        g = groups[i % len(groups)] if i % 5 else groups[0]  # skewed: group a is hot
        toks = [random.choice(VOCAB) for _ in range(random.randint(0, max_len))]
        docs.append((i * 3, g, toks))
    return docs


def df_of(spark, docs):
    return spark.createDataFrame(docs, "doc_id long, source string, tokens array<string>")


def test_with_offsets_small_bucket(spark):
    docs = corpus()
    d = df_of(spark, docs).select("source", "doc_id", F.size("tokens").alias("n"))
    got = {r.doc_id: r.offset for r in with_offsets(d, order="doc_id", count="n", groups=["source"], ranges=4).collect()}
    run = Counter()
    for doc_id, g, toks in sorted(docs):
        assert got[doc_id] == run[g]
        run[g] += len(toks)


@pytest.mark.parametrize("n", [2, 3])
def test_ngrams_across_documents(spark, n):
    docs = corpus()
    got = Counter((r.source, r.gram) for r in ngram_table(df_of(spark, docs), n, groups=["source"]).collect())
    exp = Counter()
    for g in {d[1] for d in docs}:
        stream = [t for _, gg, toks in sorted(docs) if gg == g for t in toks]
        exp.update((g, " ".join(stream[i:i + n])) for i in range(len(stream) - n + 1))
    assert got == exp


def test_positions_and_dispersion(spark):
    docs = corpus(60)
    d = df_of(spark, docs)
    stream = [t for _, _, toks in sorted(docs) for t in toks]
    pos = positions(d, order="doc_id")
    targets = spark.createDataFrame([("alpha",), ("zeta",), ("nope",)], "word string")
    got = {r.word: r for r in colloc.dispersion(pos, targets, bucket=8).collect()}
    for w in ["alpha", "zeta", "nope"]:
        p = [i for i, t in enumerate(stream) if t == w]
        if len(p) > 1:
            gaps = np.diff(p)
            avg, std = gaps.mean(), gaps.std()
            cv = std / avg if avg > 0 else 0
            uni = 1 - cv / 2 if cv < 2 else 0
        else:
            avg = std = uni = 0
        assert got[w].frequency == len(p)
        assert math.isclose(got[w].avg_gap, avg, abs_tol=1e-9) and math.isclose(got[w].std_gap, std, abs_tol=1e-9)
        assert math.isclose(got[w].uniformity, uni, abs_tol=1e-9)


def test_bigram_measures(spark):
    docs = corpus(80)
    stream = [t for _, _, toks in sorted(docs) for t in toks]
    n = len(stream)
    uni = Counter(stream)
    bi = Counter(zip(stream, stream[1:]))
    got = {r.bigram: r for r in colloc.bigram_measures(df_of(spark, docs), min_count=3).collect()}
    exp = {f"{a} {b}": c for (a, b), c in bi.items() if c >= 3}
    assert set(got) == set(exp)
    for k, c in exp.items():
        a, b = k.split()
        assert got[k]["count"] == c
        assert math.isclose(got[k].joint_prob, c / (n - 1))
        assert math.isclose(got[k].cond_prob, c / uni[a])
        assert math.isclose(got[k].pmi, math.log2(c * n / (uni[a] * uni[b])))


def test_pmi_golden_identity():
    # published: count 3, N = 38320 words, PMI 13.640847 => c1*c2 = 9
    assert round(math.log2(3 * 38320 / 9), 6) == 13.640847
    assert math.isclose(43 / 38319, 0.0011221587202171247)


def test_corpus_tfidf(spark):
    docs = corpus(30) + [(999, "a", [])]
    d = df_of(spark, docs)
    got = {r.word: r.score for r in tfidf.corpus_tfidf(d).collect()}
    N = len(docs)
    dfc = Counter(w for _, _, t in docs for w in set(t))
    exp = Counter()
    for _, _, t in docs:
        c = Counter(t)
        for w, k in c.items():
            exp[w] += k / len(t) * (math.log(N / dfc[w]) + 1)
    assert set(got) == set(exp)
    for w in exp:
        assert math.isclose(got[w], exp[w])


def test_grouped_tfidf_and_cosine(spark):
    docs = corpus(45)
    d = df_of(spark, docs)
    vec = tfidf.grouped_tfidf(d, group="source", order="doc_id", ngram_range=(1, 2))
    got = {(r.source, r.term): r.tfidf for r in vec.collect()}
    groups = sorted({g for _, g, _ in docs})
    counts = {}
    for g in groups:
        s = [t for _, gg, toks in sorted(docs) if gg == g for t in toks]
        counts[g] = Counter(s) + Counter(" ".join(p) for p in zip(s, s[1:]))
    n = len(groups)
    dfc = Counter(t for g in groups for t in counts[g])
    exp = {}
    for g in groups:
        w = {t: c * (math.log((1 + n) / (1 + dfc[t])) + 1) for t, c in counts[g].items()}
        norm = math.sqrt(sum(v * v for v in w.values()))
        exp.update({(g, t): v / norm for t, v in w.items()})
    assert set(got) == set(exp)
    for k in exp:
        assert math.isclose(got[k], exp[k], rel_tol=1e-9)
    sim = {(r.source_a, r.source_b): r.cosine_similarity for r in tfidf.pairwise_cosine(vec, unit="source", min_similarity=1e-6).collect()}
    for i, a in enumerate(groups):
        for b in groups[i + 1:]:
            dot = sum(exp[(a, t)] * exp.get((b, t), 0.0) for (g, t) in exp if g == a)
            assert math.isclose(sim[(a, b)], dot, rel_tol=1e-9, abs_tol=1e-12)


def test_topic_scores_closed_form_equals_refit(spark):
    topics = {"t0": ["alpha", "beta", "beta", "gamma"], "t1": ["delta", "eps", "alpha"], "t2": ["zeta", "zeta", "gamma"]}
    texts = {1: ["alpha", "beta", "zeta"], 2: ["delta", "delta", "omega"], 3: [], 4: ["nothing"]}
    prof = spark.createDataFrame([(k, "en", v) for k, v in topics.items()], "topic_id string, lang string, tokens array<string>")
    tx = spark.createDataFrame([(k, "en", v) for k, v in texts.items()], "text_id long, lang string, tokens array<string>")
    got = {(r.text_id, r.topic_id): r.score for r in tfidf.topic_scores(tx, prof).collect()}
    for i, t in texts.items():
        corp = [t] + list(topics.values())
        n = len(corp)
        dfc = Counter(w for d in corp for w in set(d))
        vecs = []
        for d in corp:
            c = Counter(d)
            v = {w: k * (math.log((1 + n) / (1 + dfc[w])) + 1) for w, k in c.items()}
            norm = math.sqrt(sum(x * x for x in v.values())) or 1.0
            vecs.append({w: x / norm for w, x in v.items()})
        for j, name in enumerate(topics):
            exp = sum(vecs[0].get(w, 0) * x for w, x in vecs[j + 1].items())
            assert math.isclose(got.get((i, name), 0.0), exp, abs_tol=1e-12), (i, name)


def test_forecast_golden(spark):
    # published daily series (three terms, 7 days) and the published 7-day linear forecasts
    series = {
        "лютого": [117, 214, 209, 202, 164, 208, 125],
        "україни": [105, 224, 186, 240, 225, 224, 120],
        "сша": [77, 108, 100, 147, 123, 190, 101],
    }
    expected = {
        "лютого": [172.29, 171.11, 169.93, 168.75, 167.57, 166.39, 165.21],
        "україни": [201.14, 204.14, 207.14, 210.14, 213.14, 216.14, 219.14],
        "сша": [157.86, 167.11, 176.36, 185.61, 194.86, 204.11, 213.36],
    }
    import datetime as dt
    rows = [(term, dt.date(2026, 2, 15) + dt.timedelta(days=i), float(v))
            for term, vals in series.items() for i, v in enumerate(vals)]
    pts = trend.index_series(spark.createDataFrame(rows, "series string, date date, n double"),
                             series="series", date="date", value="n")
    cf = trend.fit(pts)
    table = trend.forecast_table(pts, cf).where(F.col("forecast").isNotNull()).orderBy("series", "date").collect()
    for term in series:
        got = [r.forecast for r in table if r.series == term]
        assert got == expected[term]
        assert [r.date.isoformat() for r in table if r.series == term][0] == "2026-02-22"
    q = {r.series: r for r in trend.quality(pts, cf).collect()}
    assert round(q["сша"].r2, 4) == 0.2857 and round(q["лютого"].r2, 4) == 0.0037 and round(q["україни"].r2, 4) == 0.0139


def test_quadratic_fit_matches_numpy(spark):
    y = [3.0, 1.0, 4.0, 1.0, 5.0, 9.0, 2.0, 6.0]
    pts = spark.createDataFrame([("s", float(i), v) for i, v in enumerate(y)], "series string, x double, y double")
    r = trend.fit(pts, degree=2).first()
    c2, c1, c0 = np.polyfit(np.arange(len(y)), y, 2)
    assert math.isclose(r.c0, c0) and math.isclose(r.c1, c1) and math.isclose(r.c2, c2)


def test_constant_series_r2_zero(spark):
    pts = spark.createDataFrame([("s", float(i), 5.0) for i in range(5)], "series string, x double, y double")
    assert trend.quality(pts, trend.fit(pts)).first().r2 == 0.0


def test_top_per_period_and_top3(spark):
    import datetime as dt
    rows = []
    for day in range(2):
        for hour, words in [(9, "a a a b b c d e f"), (13, "a b b c"), (20, "c c c")]:
            ts = dt.datetime(2026, 2, 28 + day if day == 0 else 1, hour, 0) if day == 0 else dt.datetime(2026, 3, 1, hour)
            rows += [(ts, w) for w in words.split()]
    toks = timeline.with_day_period(spark.createDataFrame(rows, "ts timestamp, word string"))
    top = timeline.top_per_period(toks, 5)
    got = top.where((F.col("day") == "28.02.2026") & (F.col("period_ord") == 0)).orderBy("rank").collect()
    assert [(r.word, r.freq) for r in got] == [("a", 3), ("b", 2), ("c", 1), ("d", 1), ("e", 1)]
    assert got[0].sum_freq == 8 and got[0].day_index == 1
    evening = top.where((F.col("day") == "01.03.2026") & (F.col("period_ord") == 2)).collect()
    assert len(evening) == 1 and evening[0].day_index == 2  # fewer than 5 words: what exists
    t3 = [(r.term, r.appearances) for r in timeline.top_terms_of_table(top, 3).collect()]
    assert t3 == [("c", 6), ("a", 4), ("b", 4)]  # ties by term
    series = timeline.daily_series(toks, timeline.top_terms_of_table(top, 3))
    assert sorted((str(r.date), r.term, r.n) for r in series.collect())[:3] == [
        ("2026-02-28", "a", 4), ("2026-02-28", "b", 4), ("2026-02-28", "c", 5)]


def test_keyword_mentions_non_overlapping(spark):
    df = spark.createDataFrame([("aaaa SQL postgresql",), ("sql",)], "t string")
    got = {r.keyword: r.mentions for r in freq.keyword_mentions(df, "t", ["aa", "sql", "zzz"]).collect()}
    assert got == {"aa": 2, "sql": 3}


def test_length_distribution_cdf_ends_at_one(spark):
    toks = spark.createDataFrame([(w,) for w in ["abc", "abcd", "abc", "abcdefg"]], "word string")
    rows = freq.length_distribution(toks).orderBy("length").collect()
    assert [(r.length, r["count"]) for r in rows] == [(3, 2), (4, 1), (7, 1)]
    assert math.isclose(rows[-1].cumulative, 1.0)


def test_olap_cube_margins_count_jobs(spark):
    jobs = spark.createDataFrame([(1, "Senior", ["SQL", "Python"]), (2, "Senior", ["SQL"]), (3, "Junior", [])],
                                 "job_id long, level string, technologies array<string>")
    cube = {(r.level, r.tech, r.grouping_id): r.jobs for r in olap.level_tech_cube(jobs).collect()}
    assert cube[(None, None, 3)] == 3           # all jobs once, not job-tag rows
    assert cube[("Senior", None, 1)] == 2
    assert cube[(None, "SQL", 2)] == 2


def test_stop_word_table_joins_and_listing(spark):
    from textmart.operators import joins, lexicon
    toks = spark.createDataFrame([("the",), ("war",), ("peace",), ("war",)], "word string")
    stops = spark.createDataFrame([("the",)], "w string")
    assert sorted(r.word for r in joins.remove_stop_words(toks, stops).collect()) == ["peace", "war", "war"]
    wl = spark.createDataFrame([("war",)], "w string")
    assert [r.word for r in joins.keep_whitelist(toks, wl).collect()] == ["war", "war"]
    lemmas = spark.createDataFrame([("війни", "війна", "NOUN")], "token string, lemma string, pos string")
    docs = spark.createDataFrame([(1, ["війни", "мир"])], "doc_id long, tokens array<string>")
    got = [(r.position, r.token, r.pos, r.lemma) for r in lexicon.token_listing(docs, lemmas).orderBy("position").collect()]
    assert got == [(0, "війни", "NOUN", "війна"), (1, "мир", "UNKN", "мир")]
    words = spark.createDataFrame([("україни",), ("україни",)], "word string")
    assert [(r.word, r.lemma, r.stem) for r in lexicon.normalisation_table(words).collect()] == [("україни", "україни", "україн")]


def test_row_numbers_match_window_row_number(spark):
    from pyspark.sql import Window
    from textmart.operators.tokens import row_numbers
    rows = [(i % 3 if i % 4 else 0, (i * 37) % 101, i) for i in range(300)]  # class 0 is hot, keys repeat
    df = spark.createDataFrame(rows, "g int, k long, id long")
    got = {r.id: r.rn for r in row_numbers(df, by=["g"], order="k", tiebreak=["id"], out="rn", ranges=8).collect()}
    w = Window.partitionBy("g").orderBy("k", "id")
    exp = {r.id: r.rn for r in df.select("id", F.row_number().over(w).alias("rn")).collect()}
    assert got == exp


@pytest.mark.parametrize("keys", [
    [3 * 10 ** 17 * k for k in range(-20, 25)],  # sparse 64-bit, negative and positive
    [*range(1000, 1030), *range(10 ** 15, 10 ** 15 + 15)],  # clustered
    list(range(-40, 5)),
])
def test_offsets_and_row_numbers_for_any_keys(spark, keys):
    rng = random.Random(4)
    rows = [(k, rng.choice(["a", "a", "a", "b", None]), rng.randint(0, 5)) for k in keys]
    df = spark.createDataFrame(rows, "k long, g string, n int")
    for ranges in (2, 7, 512):
        got = {r.k: r.offset for r in with_offsets(df, order="k", count="n", ranges=ranges).collect()}
        run = 0
        for k, _, n in sorted(rows, key=lambda r: r[0]):
            assert got[k] == run
            run += n
        got = {r.k: (r.g, r.rn) for r in row_numbers(df, by=["g"], order="k", out="rn", ranges=ranges).collect()}
        seen = Counter()
        for k, g, _ in sorted(rows, key=lambda r: r[0]):
            seen[g] += 1
            assert got[k] == (g, seen[g])


def test_ranges_are_balanced_for_clustered_keys(spark):
    df = spark.range(5000).select((F.col("id") * F.col("id") * F.col("id")).alias("k"), F.lit(1).alias("n"))
    p = with_offsets(df, order="k", count="n", ranges=16)
    assert p.agg(F.max("offset")).first()[0] == 4999
    assert with_offsets(df.limit(0), order="k", count="n").count() == 0


def test_exact_median(spark):
    rng = random.Random(9)
    rows = [(g, rng.choice([0.0, 0.0, rng.random()])) for g in ("a", "b", None) for _ in range(rng.randint(5, 60))] + [("one", 3.5), ("none", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r.g: r.median for r in exact_median(df, "v", by=["g"]).collect()}
    groups = {}
    for g, v in rows:
        if v is not None:
            groups.setdefault(g, []).append(v)
    assert got == {g: pytest.approx(float(np.median(v))) for g, v in groups.items()}


def test_similarity_of_several_hundred_sources(spark):
    rng = random.Random(12)
    names = [f"s{k}" for k in range(300)] + ["a`b", "it's \"q\"", None, ""]
    rows = []
    for k, s in enumerate(names):
        terms = {f"t{(k * 7 + j * j) % 500}": rng.random() for j in range(12)} | {"common": 0.3}
        if k % 50 == 1:
            terms = {t: w for _, t, w in rows[-13:]}
        norm = math.sqrt(sum(w * w for w in terms.values()))
        rows += [(s, t, w / norm) for t, w in terms.items()]
    vec = spark.createDataFrame(rows, "source string, term string, tfidf double")
    got = {(r.source_a, r.source_b): r.cosine_similarity for r in tfidf.pairwise_cosine(vec, unit="source", min_similarity=0.4).collect()}
    by = {}
    for s, t, w in rows:
        by.setdefault(s, {})[t] = w
    known = sorted(s for s in by if s is not None)
    want = {}
    for i, a in enumerate(known):
        for b in known[i + 1:]:
            dot = sum(w * by[b].get(t, 0.0) for t, w in by[a].items())
            if dot >= 0.4:
                want[(a, b)] = pytest.approx(dot)
    assert len(want) > 5 and got == want


def test_prefix_rules_of_any_length(spark):
    df = spark.createDataFrame([(1, "abcd"), (2, "ab"), (3, "x"), (4, ""), (5, None)], "id long, v string")
    rules = spark.createDataFrame([(0, "abc", "long"), (1, "ab", "short"), (2, "", "any")], "ord int, prefix string, category string")
    got = {r.id: r.category for r in prefix_join(df, "v", rules, key="id").collect()}
    assert got == {1: "long", 2: "short", 3: "any", 4: "any", 5: "other"}


def test_lemmas_and_parts_of_speech(spark):
    d = spark.createDataFrame([("cats", "cat", "NOUN"), ("ran", "run", "VERB"), ("cats", "zcat", "X"), ("at", "at", "ADP")], "token string, lemma string, pos string")
    docs = spark.createDataFrame([("a", 1, ["cats", "ran", "home", "cats"]), ("b", 1, ["at", "ran"]), (None, 2, [])], "source string, doc_id long, tokens array<string>")
    got = {(r.source, r.doc_id): r.tokens for r in lexicon.lemmatize_arrays(docs, d, key=["source", "doc_id"]).collect()}
    assert got == {("a", 1): ["cat", "run", "home", "cat"], ("b", 1): ["at", "run"], (None, 2): []}
    kept = {r.source: r.tokens for r in lexicon.lemmatize_arrays(docs, d, key=["source", "doc_id"], keep_pos=["NOUN", "VERB"], min_len=3).collect()}
    assert kept == {"a": ["cat", "run", "cat"], "b": ["run"], None: []}


def test_texts_without_a_profile_are_unknown(spark):
    prof = spark.createDataFrame([("t0", 0, "en", ["alpha", "beta"]), ("t1", 1, "en", ["gamma"])], "topic_id string, topic_ord int, lang string, keywords array<string>")
    texts = spark.createDataFrame([(1, "alpha beta words"), (2, "слово мова"), (3, "nothing shared"), (4, None)], "text_id long, text string")
    ranked, best = topics.classify(texts, prof)
    assert {r.text_id: r.topic for r in best.collect()} == {1: "t0", 2: "unknown", 3: "unknown", 4: "unknown"}
    assert [(r.text_id, r.topic_id, r["rank"]) for r in ranked.collect()] == [(1, "t0", 1)]


def test_confusion_has_zero_cells_and_best_model_ties(spark):
    df = spark.createDataFrame([("x", "x"), ("x", "y"), ("z", "x")], "label string, predicted_label string")
    got = {(r.label, r.predicted_label): r.n for r in classify.confusion(df).collect()}
    assert len(got) == 9 and got[("x", "x")] == got[("x", "y")] == got[("z", "x")] == 1 and sum(got.values()) == 3
    res = spark.createDataFrame([("b", 0.5), ("a", 0.5), (classify.MODEL_NAMES[2], 0.5), ("c", 0.4)], "model string, accuracy double")
    assert classify.pick_best(res).first().model == classify.MODEL_NAMES[2]
    assert classify.pick_best(res, order=[]).first().model == classify.MODEL_NAMES[2]


def test_vectors_are_packed_without_python_and_can_be_fitted(spark):
    from pyspark.ml.classification import NaiveBayes

    docs = spark.createDataFrame([(k, float(k % 2)) for k in range(20)], "doc_id long, label_index double")
    feats = spark.createDataFrame([(k, "t", j, 1.0 + j) for k in range(19) for j in ((0, 2) if k % 2 else (1,))], "doc_id long, term string, feature int, weight double")
    vec = classify.to_vectors(feats, docs, 3)
    rows = {r.doc_id: r.features for r in vec.collect()}
    assert rows[1].toArray().tolist() == [1.0, 0.0, 3.0] and rows[19].toArray().tolist() == [0.0, 0.0, 0.0]
    assert "Python" not in vec._jdf.queryExecution().executedPlan().toString()
    model = NaiveBayes(labelCol="label_index").fit(vec)
    assert model.transform(vec).filter("prediction = label_index").count() >= 19


def test_report_names_the_least_similar_of_all_pairs(spark):
    from textmart.plans import corpus_comparison as CC

    summary = spark.createDataFrame([(s, 1, 1.0, 0.5) for s in "abcd"], "source string, unique_lemmas int, ttr_lemma double, sent_mean double")
    facts = lambda sim: {r.fact: (r.source, r.value) for r in CC.report_facts(summary, sim).collect()}
    rows = [("a", "x", 0.8), ("a", "y", 0.6), ("b", "x", 0.6), ("b", "z", 0.8), ("c", "z", 0.05), ("c", "w", 0.99875), (None, "x", 1.0)]
    vec = spark.createDataFrame(rows, "source string, term string, tfidf double")
    units = spark.createDataFrame([(s,) for s in ("a", "b", "c", None, "a")], "source string")
    got = facts(similarity.all_pairs_cosine(vec, units, unit="source"))
    assert got["least_similar"] == ("a / c", 0.0) and got["most_similar"] == ("a / b", pytest.approx(0.48))
    low = spark.createDataFrame([("a", "x", 0.05), ("b", "x", 0.05), ("c", "y", 1.0), ("a", "y", 0.02), ("b", "y", 0.01)], vec.schema)
    got = facts(similarity.all_pairs_cosine(low, units, unit="source"))
    assert got["least_similar"] == ("a / b", pytest.approx(0.0027)) and got["most_similar"] == ("a / c", pytest.approx(0.02))


def test_all_pairs_in_blocks_and_parts(spark):
    rng = random.Random(4)
    by = {f"s{k}": {f"t{rng.randrange(40)}": rng.random() for _ in range(6)} for k in range(23)} | {"empty": {}, "it's": {"t1": 0.5}}
    vec = spark.createDataFrame([(s, t, w) for s, v in by.items() for t, w in v.items()], "source string, term string, tfidf double")
    units = spark.createDataFrame([(s,) for s in by], "source string")
    got = {(r.source_a, r.source_b): r.cosine_similarity for r in similarity.all_pairs_cosine(vec, units, unit="source", block=5, rows=30).collect()}
    names = sorted(by)
    assert got == {(a, b): pytest.approx(sum(w * by[b].get(t, 0.0) for t, w in by[a].items())) for i, a in enumerate(names) for b in names[i + 1:]}


def test_comparative_report_decides_facts_over_all_pairs(spark, tmp_path):
    from textmart.plans import catalog

    for name in ("documents", "conversations"):
        spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet").limit(0).write.parquet(str(tmp_path / f"{name}.parquet"))
    texts = [("a", "river stone river stone garden"), ("b", "river stone mountain window"), ("c", "engine piston copper")]
    schema = spark.read.parquet(str(tmp_path / "documents.parquet")).schema
    rows = [tuple({"doc_id": k, "text": t, "lang": "en", "source": s, "n_chars": len(t)}[c] for c in schema.names) for k, (s, t) in enumerate(texts)]
    spark.createDataFrame(rows, schema).write.mode("overwrite").parquet(str(tmp_path / "documents.parquet"))
    lines = [r.line for r in catalog.comparative_report(spark, str(tmp_path)).collect() if r.section == "facts"]
    assert any("least_similar: **a / c** (0.000000)" in x for x in lines) and any("most_similar: **a / b**" in x for x in lines), lines

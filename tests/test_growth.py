"""Steps that grow with the input only: the same results as the plain way, and no second copy of the rows in the plan."""

from pyspark.sql import functions as F

from textmart.functions import text as T
from textmart.operators import classify, lexicon, similarity, tfidf, tokens
from textmart.plans import corpus_comparison, topics


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def vectors(spark):
    rows = [(f"s{u}", f"t{t}", float(1 + (u * t) % 5)) for u in range(6) for t in range(30) if (u + t) % 3 or u == t % 6]
    return tfidf.l2_normalize(spark.createDataFrame([*rows, ("lone", "own", 2.0)], "source string, term string, w double"), unit="source", weight="w", out="tfidf")


def test_bigrams_are_pairs_of_neighbours(spark):
    df = spark.createDataFrame([(["a", "b", "c"],), (["a"],), ([],), (None,)], "t array<string>")
    made = df.select(T.ngrams("t", 2).alias("g"))
    assert "zip_with" in made._jdf.queryExecution().analyzed().toString()
    assert [r.g for r in made.collect()] == [["a b", "b c"], [], [], []]


def test_offsets_of_many_rows_in_blocks_of_bounds(spark):
    rows = [(i * i % 1009 - 300, i % 4) for i in range(900)] + [(None, 3)]
    docs = spark.createDataFrame(rows, "k long, n long")
    got = {(r.k, r.n): r.offset for r in tokens.with_offsets(docs.groupBy("k").agg(F.sum("n").alias("n")), order="k", count="n", ranges=50).collect()}
    sums = {}
    for k, n in rows:
        sums[k] = sums.get(k, 0) + n
    before, want = 0, {}
    for k in sorted(sums, key=lambda x: (x is not None, x)):
        want[k, sums[k]] = before
        before += sums[k]
    assert got == want
    # a key is not compared with every bound
    assert "lasts" in tokens.with_offsets(docs, order="k", count="n")._jdf.queryExecution().analyzed().toString()


def test_weights_are_not_shuffled_by_unit_for_few_norms(spark):
    docs = spark.createDataFrame([("a", 1, ["x", "y", "x"]), ("a", 2, ["z"]), ("b", 1, ["y"]), (None, 1, ["x", "q"]), ("c", 1, [])],
                                 "source string, doc_id long, tokens array<string>")
    vec = tfidf.grouped_tfidf(docs)
    assert "Exchange hashpartitioning" not in plan(vec)
    norms = {r.source: round(r.n, 9) for r in vec.groupBy("source").agg(F.sum(F.col("tfidf") ** 2).alias("n")).collect()}
    assert norms == {"a": 1.0, "b": 1.0, None: 1.0}
    assert {(r.source, r.term, r.tf) for r in vec.collect()} == {
        ("a", "x", 2), ("a", "y", 1), ("a", "z", 1), ("a", "x y", 1), ("a", "y x", 1), ("a", "x z", 1), ("b", "y", 1), (None, "x", 1), (None, "q", 1), (None, "x q", 1)}


def test_few_units_are_multiplied_term_by_term(spark, monkeypatch):
    vec = vectors(spark)
    few = tfidf.pairwise_cosine(vec, unit="source", min_similarity=0.2)
    # the weights of one side are matched by term; candidate pairs would be joined to whole vectors by unit
    assert plan(few).count("Join") - plan(vec).count("Join") * 2 <= 1
    got = {(r.source_a, r.source_b): round(r.cosine_similarity, 9) for r in few.collect()}
    ends = {tuple(r)[:3]: round(r.cosine_similarity, 9) for r in similarity.similarity_extremes(vec, vec, unit="source").collect()}
    monkeypatch.setattr(tfidf, "FEW_UNITS", 0)
    assert got == {(r.source_a, r.source_b): round(r.cosine_similarity, 9) for r in tfidf.pairwise_cosine(vec, unit="source", min_similarity=0.2).collect()}
    assert ends == {tuple(r)[:3]: round(r.cosine_similarity, 9) for r in similarity.similarity_extremes(vec, vec, unit="source").collect()}
    assert got and {k[0] for k in ends} == {"least", "most"} and ends["least", "lone", "s0"] == 0.0


def test_topic_scores_deal_the_terms_of_a_text_once(spark):
    texts = spark.createDataFrame([(1, "en", ["cat", "dog", "cat"]), (2, "en", ["fish"]), (2, "en", ["dog"]), (3, "uk", ["cat"]), (4, "en", []), (None, "en", ["cat"])],
                                  "text_id long, lang string, tokens array<string>")
    prof = spark.createDataFrame([("a", "en", ["cat", "cow"]), ("b", "en", ["dog", "cat"])], "topic_id string, lang string, tokens array<string>")
    scores = tfidf.topic_scores(texts, prof)
    assert plan(scores).count("Exchange hashpartitioning(text_id") == 1
    got = {(r.text_id, r.topic_id): round(r.score, 9) for r in scores.collect()}
    assert set(got) == {(1, "a"), (1, "b"), (2, "b")}
    counts = texts.select("text_id", "lang", F.explode("tokens").alias("term")).groupBy("text_id", "lang", "term").agg(F.count(F.lit(1)).alias("x"))
    assert got == {(r.text_id, r.topic_id): round(r.score, 9) for r in tfidf.topic_scores(counts, prof).collect()}


def test_topic_lemmas_are_counted(spark):
    texts = spark.createDataFrame([(1, "cats and dogs, cats"), (2, None)], "text_id long, text string")
    d = spark.createDataFrame([("cats", "cat", "NOUN"), ("dogs", "dog", "NOUN"), ("and", "and", "CONJ")], "token string, lemma string, pos string")
    assert {tuple(r) for r in topics.text_tokens(texts, lemma_dict=d).select("text_id", "term", "x").collect()} == {(1, "cat", 2), (1, "dog", 1)}


def test_words_are_counted_before_they_meet_the_dictionary(spark):
    docs = spark.createDataFrame([("a", 1, ["runs", "run", "ant", "runs"]), ("a", 2, ["ant", "ox"]), (None, 3, ["runs"]), ("b", 4, [])],
                                 "source string, doc_id long, words array<string>")
    d = spark.createDataFrame([("runs", "run", "VERB"), ("run", "run", "VERB"), ("ox", "ox", "NOUN")], "token string, lemma string, pos string")
    assert {tuple(r) for r in lexicon.lemma_counts(docs, d, by=["source"], key="doc_id", tokens="words").collect()} == {("a", "run", 3), ("a", "ant", 2), ("a", "ox", 1), (None, "run", 1)}
    assert {tuple(r) for r in lexicon.lemma_counts(docs, d, by=["doc_id"], key="doc_id", tokens="words", keep_pos=["VERB"], min_len=3).collect()} == {(1, "run", 3), (3, "run", 1)}
    top = corpus_comparison.top_by_source(docs, "words", 1, name="lemma", lemma_dict=d)
    assert {(r.source, r.lemma, r["count"]) for r in top.collect()} == {("a", "run", 3), (None, "run", 1)}
    stems = corpus_comparison.top_stems_by_source(docs, 1, stem_suffixes=["n"], lemma_dict=d)
    assert {(r.source, r.stem, r["count"]) for r in stems.collect()} == {("a", "run", 3), (None, "run", 1)}


def test_feature_norms_need_no_join(spark):
    docs = spark.createDataFrame([(1, "aa bb aa"), (2, "aa cc"), (2, "cc dd"), (3, "bb cc"), (4, "")], "doc_id long, text string")
    feats, _ = classify.tfidf_features(docs, min_df=1, max_df=1.0)
    assert plan(feats).count("Join") == 1
    assert {r.doc_id: round(r.n, 9) for r in feats.groupBy("doc_id").agg(F.sum(F.col("weight") ** 2).alias("n")).collect()} == {1: 1.0, 2: 1.0, 3: 1.0}


def test_lemma_counts_are_those_of_the_arrays_with_repeated_keys(spark):
    docs = spark.createDataFrame([(1, "en", ["runs", "ant"]), (1, "uk", ["ox"]), (1, "en", ["ant"]), (2, "en", ["runs"]), (None, "en", ["ox"]), (None, "uk", ["ant"])],
                                 "doc_id long, lang string, tokens array<string>")
    d = spark.createDataFrame([("runs", "run", "VERB"), ("ox", "ox", "NOUN")], "token string, lemma string, pos string")
    arrays = lexicon.lemmatize_arrays(docs, d).select("doc_id", "lang", F.explode("tokens").alias("lemma"))
    for by in (["lang"], ["doc_id", "lang"]):
        want = {tuple(r) for r in arrays.groupBy(*by, "lemma").count().collect()}
        assert {tuple(r) for r in lexicon.lemma_counts(docs, d, by=by, key="doc_id").collect()} == want

import zlib

import numpy as np
from pyspark.sql import functions as F

from tests.llm.helpers import documents, table
from textmart.llm.langid import KneserNey, grams, held_out, identify, symbols, train


def test_symbols_are_lower_case_letters_and_single_blanks():
    assert symbols("  Ab, 9c!") .tolist() == [0, ord("a"), ord("b"), 0, ord("c"), 0]
    assert len(symbols("12 $ \n")) == len(symbols(None)) == 0


def test_probabilities_sum_to_one_and_follow_the_formula():
    text = "abracadabra abba cab"
    k, n = np.unique(grams(symbols(text)), return_counts=True)
    model = KneserNey.fit(["x"], np.zeros(len(k), int), k, n)
    alphabet = model.keys[1]
    for context in ("abr", "zzz", "\0ab", "bba"):
        base = sum((ord(c) if c != "\0" else 0) << 16 * (3 - i) for i, c in enumerate(context))
        p = np.exp(model.score(np.uint64(base) | alphabet)).sum()
        unseen = 1 - p
        assert -1e-5 < unseen < 0.5  # what is left goes to unseen letters
    # the order-one model: continuation counts with absolute discounting towards the uniform distribution
    pairs = {(a, b) for a, b in zip(" abracadabra abba cab ", "abracadabra abba cab ", strict=False)} | {(" ", " ")}
    follow = {}
    for a, b in pairs - {(" ", " ")}:
        follow[b] = follow.get(b, 0) + 1
    letter = np.uint64(ord("a"))
    total = sum(follow.values())
    got = np.exp(model.score(np.array([letter], np.uint64), 1))[0, 0]
    uniform = np.exp(model.floor)
    near = (follow["a"] - 0.75) / total + 0.75 * len(follow) / total * uniform
    assert abs(got - near) < 0.05


def test_held_out_rows_are_predicted_and_not_learned_from(spark):
    docs = table(spark, "documents", "sf0.01")
    model = train(docs)
    rows = {r.doc_id: r for r in docs.collect()}
    got = identify(docs, model).select("*", held_out(F.col("doc_id")).alias("held")).collect()
    assert all(r.held == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    held = [r for r in got if r.held]
    assert np.mean([rows[r.doc_id].lang == r.lang_pred for r in held]) > 0.97
    assert not any(r.rejected for r in got) and all(0 <= r.score <= 1 for r in got)


def test_rejection(spark):
    model = train(table(spark, "documents", "sf0.01"))
    texts = [(1, "qwxzkj vbnqz xkcdq zzqxw pqrst vvbbn xzq wqk jjkx qqzzx vvkkq"), (2, "Привет, это совсем другой язык и другое письмо"), (3, "12 $$")]
    got = {r.doc_id: r for r in identify(documents(spark, texts), model).collect()}
    assert all(r.rejected for r in got.values()) and got[3].lang_pred == "und"


def test_noise_in_the_training_table_does_not_lift_the_limit(spark):
    rng = np.random.default_rng(3)
    dump = lambda k: "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/"), k))
    clean = table(spark, "documents", "sf0.01").select("doc_id", "text", "lang")
    noise = [(10_000_000 + k, dump(3000), "en") for k in range(12)] + [(11_000_000 + k, "Привет, это другой язык и письмо " * 20, "fr") for k in range(4)]
    model = train(clean.unionByName(spark.createDataFrame(noise, "doc_id long, text string, lang string")))
    texts = [(1, dump(400)), (2, "qwxzkj vbnqz xkcdq zzqxw pqrst vvbbn xzq wqk jjkx qqzzx vvkkq"), (3, "Ελληνικα γραμματα εδω"), (4, "これは日本語の短い文章であり、二十文字です")]
    assert [r.doc_id for r in identify(documents(spark, texts), model).collect() if not r.rejected] == []
    assert identify(clean, model).filter("rejected").count() == 0


def test_awkward_rows(spark):
    docs = documents(spark)
    for model in (train(docs), train(docs.limit(0)), train(table(spark, "documents"))):
        got = identify(docs, model).collect()
        assert len(got) == docs.count()
        assert all(r.lang_pred == "und" and r.score == 0 and r.rejected for r in got if r.doc_id in (1, 2, 3))
    assert identify(docs.limit(0), model).count() == 0


def test_every_labelled_row_is_learned_from(spark):
    """A rare n-gram of one row among many is in the model, and the counts are those of all rows."""
    word = lambda k: "".join(chr(ord("a") + (k // 26 ** j) % 26) for j in range(4))
    rows = [(k, f"{word(k * 7)} common words", "en" if k % 2 else "fr") for k in range(4000)]
    model = train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    learned = [(t, x) for k, t, x in rows if zlib.crc32(str(k).encode()) % 4 != 2]
    for x, lang in enumerate(["en", "fr"]):
        keys, counts = np.unique(np.concatenate([grams(symbols(t)) for t, y in learned if y == lang]), return_counts=True)
        alone = KneserNey.fit([lang], np.zeros(len(keys), int), keys, counts)
        assert np.isin(keys, model.keys[4]).all()
        at = np.searchsorted(model.keys[1], alone.keys[1])
        alone.floor = model.floor
        assert at.max() < len(model.keys[1]) and model.langs[x] == lang
    every = np.unique(np.concatenate([grams(symbols(t)) for t, _ in learned]))
    assert (model.keys[4] == every).all() and np.isfinite(model.limit[0]).all()


def test_counts_are_added_up_in_a_task(monkeypatch):
    import pyarrow as pa

    from textmart.llm import langid
    monkeypatch.setattr(langid, "HELD_GRAMS", 50)
    texts = [f"some words number {'abc'[k % 3]}" for k in range(200)]
    batch = pa.RecordBatch.from_pydict({"group": [f"{k % 2}:en" for k in range(200)], "text": texts})
    got = {}
    for b in langid.gram_counts([batch]):
        for r in b.to_pylist():
            got[r["group"], r["k"]] = got.get((r["group"], r["k"]), 0) + r["n"]
    for g in range(2):
        keys, counts = np.unique(np.concatenate([grams(symbols(t)) for t in texts[g::2]]), return_counts=True)
        assert {k: n for (x, k), n in got.items() if x == f"{g}:en"} == dict(zip(keys.view(np.int64).tolist(), counts.tolist(), strict=True))

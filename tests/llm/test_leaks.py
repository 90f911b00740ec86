from tests.llm.helpers import documents, table
from textmart.llm.decontam import leaks

ITEM = "If Anna has 12 apples and Anna gives 5 kg to Bob how many does Anna keep after that day now"


def found(spark, texts, items=((1, ITEM),)):
    bench = spark.createDataFrame(list(items), "item_id long, text string")
    return {(r.doc_id, r.item_id): r.share for r in leaks(documents(spark, list(enumerate(texts))), bench).collect()}


def test_reparameterised_question_is_caught_if_its_slots_agree(spark):
    same = ITEM.replace("Anna", "Clara").replace("12", "3").replace("Bob", "Tom").replace("5 kg", "7 mg")
    odd = "If Clara has 3 apples and Dora gives 7 kg to Tom how many does Eva keep after that day now"
    got = found(spark, ["x y. " + same, odd, ITEM.lower(), "Some words before. " + ITEM + " and after", None, ""])
    assert (0, 1) in got and (3, 1) in got and (1, 1) not in got and (4, 1) not in got


def test_other_case_and_names_at_sentence_starts(spark):
    item = "Tom has 5 apples. Tom gives 2 apples to Anna. How many does Tom have left?"
    new = item.replace("Tom", "Eva").replace("Anna", "Carl").replace("5", "7")
    got = found(spark, [ITEM.lower(), ITEM.upper(), ITEM.title(), new, item.lower()], [(1, ITEM), (2, item)])
    assert set(got) == {(0, 1), (1, 1), (2, 1), (3, 2), (4, 2)}


def test_a_copy_beside_a_variant_is_found_whole(spark):
    variant = ITEM.replace("Anna", "Aaron").replace("12", "99").replace("Bob", "Carl").replace("5 kg", "2 t")
    third = ITEM.replace("Anna", "Zoe").replace("12", "10").replace("Bob", "Abe").replace("5 kg", "90 mg")
    got = found(spark, [f"{ITEM}. And {variant}.", f"{variant}. {ITEM}. {third}.", f"{variant}. {third}."])
    assert got[(0, 1)] == got[(1, 1)] == got[(2, 1)] == 1.0


def test_clean_texts_and_short_items(spark):
    assert found(spark, ["one two three four five six seven eight", ITEM[:40], "# % @ # % @ # % @"], [(1, ITEM), (2, "one two"), (3, None), (4, "1 2 3 4 5 6 7 8")]) == {}


def test_long_texts_repeats_and_empty_tables(spark):
    filler = " ".join(f"word{k}" for k in range(30_000))
    got = found(spark, [f"{filler}. {ITEM}. {filler}. {ITEM}"])
    assert got == {(0, 1): 1.0}
    docs, bench = documents(spark), spark.createDataFrame([(1, ITEM), (1, ITEM), (None, ITEM)], "item_id long, text string")
    assert leaks(docs, bench).count() == leaks(docs.limit(0), bench).count() == leaks(docs, bench.limit(0)).count() == 0


def test_planted_items_of_the_table(spark):
    docs, bench = table(spark, "documents", "sf0.01"), table(spark, "benchmark", "sf0.01")
    items = [(r.item_id, r.text) for r in bench.collect()]
    planted = {(r.doc_id, i) for r in docs.collect() for i, t in items if r.text and t in r.text}
    assert planted and {(r.doc_id, r.item_id) for r in leaks(docs, bench).collect()} == planted


DENSE = "Which of Anna, Bob, Carl, Dora, Emil and Fritz won the prize of Paris in London that year?"


def test_questions_dense_with_names_are_found_in_copies(spark):
    other = DENSE.replace("Anna", "Gerd").replace("Bob", "Hans").replace("Carl", "Ida").replace("Dora", "Jan").replace("Paris", "Rome")
    got = found(spark, [f"Well. {DENSE}", DENSE.lower(), other, "Anna, Bob, Carl, Dora, Emil and Fritz"], [(1, DENSE)])
    assert got[(0, 1)] == got[(1, 1)] == 1.0 and (3, 1) not in got


def test_sql_on_names_numbers_and_variants(spark):
    import random

    import duckdb
    import pandas as pd

    from textmart.llm.decontam import duck_sql

    rng = random.Random(12)
    items = [(1, ITEM), (2, DENSE), (3, "Tom has 5 apples. Tom gives 2 apples to Anna. How many does Tom have left?"), (4, "one two"), (5, "1 2 3 4 5 6 7 8 9")]
    names = ["Anna", "Bob", "Tom", "Carl", "Dora", "Eva", "Paris"]
    texts = []
    for _ in range(120):
        t = rng.choice(items[:3])[1]
        for n in names:
            if rng.random() < 0.4:
                t = t.replace(n, rng.choice(names))
        t = "".join(rng.choice("0123456789") if c.isdigit() and rng.random() < 0.5 else c for c in t)
        words = t.split()
        if rng.random() < 0.5:
            words[rng.randrange(len(words))] = rng.choice(["and", "7", "Eva", ""])
        t = " ".join(words) + rng.choice(["", ". ", " and "]) + rng.choice(["", ITEM, DENSE.lower(), "The end"])
        texts.append(t if rng.random() < 0.9 else t.title())
    con = duckdb.connect()
    con.register("documents", pd.DataFrame({"doc_id": range(len(texts)), "text": texts}))
    con.register("benchmark", pd.DataFrame(items, columns=["item_id", "text"]))
    want = {(a, b): round(s, 9) for a, b, _, _, s in con.sql(duck_sql()).fetchall()}
    assert {k: round(s, 9) for k, s in found(spark, texts, items).items()} == want and len(want) > 60


def test_words_are_hashed_once_and_cut_as_one_by_one(spark):
    from pyspark.sql import functions as F

    from textmart.llm import decontam as D

    odd = ["  Anna\thas 12 kg... Then  Bob!? left. ... ? x", "\u0391\u03a3. \u03a3\u0391\u03a3! \u0130x I. a.b..c ..!d \u03a3", "", None, " . ", "9 KG 9. kg Kg", "One\u2028two.\u0085 three. 4!"]
    rows = D.with_words(documents(spark, list(enumerate(odd))), F.col("text"))
    # every word by itself
    one = F.filter(F.split(F.translate(F.coalesce("text", F.lit("")), D.BLANKS + D.PUNCTUATION, " " * len(D.BLANKS)), " "), lambda w: w != "")
    each = F.transform(one, lambda w: F.lower(F.rtrim(w, F.lit(D.ENDS))))
    for r in rows.select(F.array_remove("raw", "").alias("raw"), "plain", "tags", one.alias("one"), each.alias("each")).collect():
        assert r.raw == r.one and (r.plain == r.each or not r.one) and len(r.tags) == len(r.plain)
    first = rows.filter("doc_id = 0").first()
    assert first.tags == ["^anna", "has", "#", "%", "^then", "@bob", "left", "", "", "x"]
    hashes = D.forms(F.col("tags"), F.xxhash64)
    got = rows.filter("size(tags) > 6").select(*(D.hash_at(h, F.lit(1)) == D.hash_of(F.slice(f, 2, D.WINDOW)) for h, f in zip(hashes, D.forms(F.col("tags")), strict=True)))
    assert got.count() >= 2 and all(all(r) for r in got.collect())

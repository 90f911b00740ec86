"""Guesses for words outside the dictionary against a plain Python trie, and the cube against counted sets."""

import random
from collections import Counter

from textmart.operators import lexicon, olap


def guess(entries, word, longest, min_words):
    counts = {}
    for token, lemma, pos in entries:
        same = 0
        while same < min(len(token), len(lemma)) and token[same] == lemma[same]:
            same += 1
        rule = (len(token) - same, lemma[same:], pos)
        for k in range(1, min(longest, len(token)) + 1):
            if k >= rule[0]:
                counts.setdefault(token[-k:], Counter())[rule] += 1
    for k in range(min(longest, len(word) - 1), 0, -1):
        if (c := counts.get(word[-k:])) is not None:
            n = max(c.values())
            strip, add, pos = min(r for r, m in c.items() if m == n)
            if n >= min_words:
                return word[-k:], word[:len(word) - strip] + add, pos
    return None, word, "UNKN"


def test_guesses_equal_the_trie(spark):
    rng = random.Random(5)
    stems = ["".join(rng.choice("abcdeéя") for _ in range(rng.randrange(2, 6))) for _ in range(400)]
    endings = [("s", "", "NOUN"), ("ing", "", "VERB"), ("ies", "y", "NOUN"), ("ий", "", "ADJF"), ("", "", "UNKN"), ("ed", "e", "VERB")]
    entries = {}
    for s in stems[:250]:
        end, add, pos = rng.choice(endings)
        entries.setdefault(s + end, (s + add, pos))
    entries = [(t, *v) for t, v in entries.items()]
    dictionary = spark.createDataFrame([*entries, (None, "x", "NOUN"), entries[0]], "token string, lemma string, pos string")
    known = {t for t, _, _ in entries}
    words = sorted({s + rng.choice(endings)[0] for s in stems[200:]} | {"q", "s", "zing"})
    df = spark.createDataFrame([(w,) for w in [*words, *words[:9], None]], "word string")
    for longest, least in ((5, 2), (3, 1), (9, 4)):
        got = {r.word: (r.ending, r.lemma, r.pos) for r in lexicon.guess_unknown(df, dictionary, longest=longest, min_words=least).collect()}
        assert got == {w: guess(entries, w, longest, least) for w in words if w not in known}
    full = lexicon.with_guesses(dictionary, df)
    rows = lexicon.lemmatize(df.where("word is not null"), full).collect()
    lemmas = {t: (lemma, pos) for t, lemma, pos in entries}
    assert all((r.lemma, r.pos) == (lemmas.get(r.word) or guess(entries, r.word, 5, 2)[1:]) for r in rows) and len(rows) == len(words) + 9
    empty = dictionary.limit(0)
    assert all(r.lemma == r.word and r.pos == "UNKN" and r.ending is None for r in lexicon.guess_unknown(df, empty).collect())


def test_cube_margins_count_jobs_once(spark):
    rng = random.Random(2)
    rows = [(rng.choice([-5, 7, 10 ** 12, *range(40)]), rng.choice(["junior", "senior", None]), rng.sample(["sql", "python", "r"], rng.randrange(4)))
            for _ in range(300)] + [(None, "junior", ["sql"])]
    df = spark.createDataFrame(rows, "job_id long, level string, technologies array<string>")
    want = {}
    for job, level, techs in rows:
        for tech in techs or [None]:
            for key in ((level, tech, 0), (level, None, 1), (None, tech, 2), (None, None, 3)):
                want.setdefault(key, set()).update([] if job is None else [job])
    cube = olap.level_tech_cube(df)
    assert {(r.level, r.tech, r.grouping_id): r.jobs for r in cube.collect()} == {k: len(v) for k, v in want.items()}
    assert "Expand" not in cube._jdf.queryExecution().executedPlan().toString()
    assert olap.level_tech_cube(df.limit(0)).count() == 0

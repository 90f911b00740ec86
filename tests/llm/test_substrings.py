import hashlib
import random

from tests.llm.helpers import documents, table
from textmart.llm import chunk_dedup, suffix_dedup


def test_suffix_arrays_by_linear_grouping():
    rng = random.Random(1)
    for _ in range(2000):
        s = [rng.randrange(1, rng.choice([2, 3, 5, 30])) for _ in range(rng.randrange(40))] + [0]
        assert suffix_dedup.suffix_array(s) == sorted(range(len(s)), key=lambda i: s[i:])


def repeats(docs):
    """(n_bytes, n_removed, runs, kept) of (id, text) rows in the order of their ids, by brute force."""
    seen, out = {}, []
    rows = sorted(((i, t) for i, t in docs if i is not None), key=lambda x: x[0])
    for i, t in rows:
        d = (t or "").encode()
        for p in range(len(d) - 99):
            seen.setdefault(d[p:p + 100], (i, p))
    for i, t in docs:
        d = (t or "").encode()
        gone = bytearray(len(d))
        for p in range(len(d) - 99):
            if i is not None and seen[d[p:p + 100]] < (i, p):
                gone[p:p + 100] = b"\1" * 100
        kept = bytes(x for x, g in zip(d, gone, strict=True) if not g)
        runs = sum(1 for k, g in enumerate(gone) if g and (k == 0 or not gone[k - 1]))
        out.append((i, len(d), len(d) - len(kept), runs, kept))
    return sorted(out, key=repr)


def suffix_rows(df, **options):
    return sorted(((r.id if "id" in r else r.doc_id, r.n_bytes, r.n_removed, len(r.spans), bytes(r.kept))
                   for r in suffix_dedup.deduplicate(df, **options).select("doc_id", "n_bytes", "n_removed", "spans", "kept").collect()), key=repr)


def test_suffix_dedup_of_overlapping_and_edited_passages(spark):
    rng = random.Random(5)
    say = lambda n: "".join(rng.choice("abcé ") for _ in range(n))
    base = [say(400) for _ in range(3)]
    rows = []
    for k in range(60):
        b = rng.choice(base)
        at = rng.randrange(300)
        edited = b[:at] + rng.choice(["", "x", "yy"]) + b[at + rng.randrange(2):]
        rows.append((k, say(rng.randrange(150)) + edited[rng.randrange(80):400 - rng.randrange(80)] + say(rng.randrange(150))))
    rows += [(100, "ab" * 400), (101, "a" * 99), (102, "a" * 100), (103, "a" * 101), (104, "a" * 350), (105, None), (106, "")]
    df = documents(spark, rows)
    want = repeats(rows)
    assert suffix_rows(df) == want
    assert suffix_rows(df, unit_segments=3) == want  # minimizers with many segments go by single windows


def test_suffix_dedup_awkward_rows(spark):
    rows = [(1, None), (2, ""), (3, "x" * 30_000), (None, "x" * 300), (4, "lorem ipsum dolor sit amet " * 3000), (9, "日本語" * 60), (10, "本語日" * 60)]
    assert suffix_rows(documents(spark, rows)) == repeats(rows)
    twice = suffix_rows(documents(spark, [(7, "q" * 50 + "r" * 100), (7, "q" * 50 + "r" * 100), (8, "r" * 100)]))
    assert [(i, n) for i, _, n, _, _ in twice] == [(7, 0), (7, 0), (8, 100)]
    assert suffix_dedup.deduplicate(documents(spark, rows).limit(0)).count() == 0


def test_suffix_dedup_of_a_text_longer_than_a_block(spark):
    rng = random.Random(8)
    part = "".join(rng.choice("abcdefgh ") for _ in range(300))
    body = "".join(rng.choice("abcdefgh ") for _ in range(suffix_dedup.BLOCK - 150))
    got = {r.doc_id: (r.n_removed, [tuple(s) for s in r.spans]) for r in suffix_dedup.deduplicate(documents(spark, [(1, part), (2, body + part + body[:50] + part)])).collect()}
    n = len(body)
    assert got == {1: (0, []), 2: (600, [(n, n + 300), (n + 350, n + 650)])}


def test_gear_chunks_resist_shifts_and_keep_characters_whole():
    rng = random.Random(3)
    text = "".join(rng.choice("abcdefghé日 ") for _ in range(5000))
    for t in (text, "x" * 5000, "日" * 3000, "a"):
        data = t.encode()
        ends = chunk_dedup.chunk_ends(data)
        assert ends[-1] == len(data) and ends == sorted(set(ends))
        for a, b in zip([0, *ends], ends, strict=False):
            data[a:b].decode()
            assert b - a <= chunk_dedup.LARGEST
    shifted = set(chunk_dedup.digests(("some words before " + text).encode())[1])
    own = chunk_dedup.digests(text.encode())[1]
    assert sum(d in shifted for d in own) > 0.95 * len(own)
    assert chunk_dedup.chunk_ends(b"") == []


def chunk_brute(rows, min_run):
    first = {}
    for i, t in sorted(((i, t) for i, t in rows if i is not None), key=lambda x: x[0]):
        for d in chunk_dedup.digests((t or "").encode())[1]:
            first.setdefault(d, i)
    out = []
    for i, t in rows:
        data = (t or "").encode()
        ends, keys = chunk_dedup.digests(data)
        spans = chunk_dedup.duplicate_runs(ends, keys, {d for d in keys if i is not None and first[d] < i}, min_run) if ends else []
        kept = b"".join(data[a:b] for a, b in zip([0, *(e for _, e in spans)], [*(s for s, _ in spans), len(data)], strict=True))
        out.append((str(i), len(data), len(data) - len(kept), len(spans), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def test_chunk_dedup_rows(spark):
    for df in (documents(spark), table(spark, "documents")):
        rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
        got = sorted((str(r.doc_id), r.n_bytes, r.n_removed, len(r.spans), hashlib.sha256(r.kept_text.encode()).hexdigest()) for r in chunk_dedup.deduplicate(df).collect())
        assert got == chunk_brute(rows, chunk_dedup.MIN_RUN)
    assert chunk_dedup.deduplicate(df.limit(0)).count() == 0


def test_passages_of_fifty_words_are_caught(spark):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("aeiounrtsl") for _ in range(rng.randrange(2, 9)))
    say = lambda n: " ".join(word() for _ in range(n))
    passages = [say(52) for _ in range(20)]
    rows = [(k, f"{say(40)} {p} {say(40)}") for k, p in enumerate(passages)] + [(100 + k, f"{say(25)} {p} {say(60)}") for k, p in enumerate(passages)]
    rows += [(200 + k, say(150)) for k in range(20)]
    for got in ({r.doc_id: r.n_removed for r in chunk_dedup.deduplicate(documents(spark, rows)).collect()},
                {r.doc_id: r.n_removed for r in suffix_dedup.deduplicate(documents(spark, rows)).collect()}):
        assert all((n > 0) == (100 <= i < 200) for i, n in got.items())

import random

import numpy as np
import xxhash

from tests.llm.helpers import documents, table
from textmart.llm.common import components
from textmart.llm.simhash import fingerprints_of, join_keys, links, near_duplicates, pivot_table


def fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in "".join(" " if c in "\t\n\x0b\x0c\r " else c for c in lowered).split(" ") if w]
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] if len(words) > 2 else [" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(fps):
    """Smallest index reachable over links of at most two bits, by brute force."""
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 2
    label = np.arange(len(fps))
    while True:
        new = np.where(near, label[None, :], len(fps)).min(axis=1)
        if (new == label).all():
            return label
        label = new


def test_fingerprints_by_hand():
    texts = [None, "", " ", "One", "one TWO", "a b\tc\x0bd", "Ärger Ünder\u00a0x y"]
    got = fingerprints_of(texts, 3).view(">u8").ravel()
    assert [int(x) for x in got] == [fingerprint(t) for t in texts]


def test_no_link_is_missed_by_the_join_keys():
    rng = random.Random(1)
    for _ in range(300):
        x = rng.getrandbits(64)
        y = x ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(3)))
        pair = np.array([x, y], np.uint64)
        keys = join_keys(pivot_table(pair), 2)
        assert (keys[0] == keys[1]).any()
        table = pivot_table(pair)
        assert np.abs(table[0] - table[1]).max() <= 2


def test_links_join_one_dense_group_in_units(spark):
    rng = random.Random(2)
    base = rng.getrandbits(64)
    fps = sorted({base ^ (1 << a) ^ (1 << b) for a in range(30) for b in range(30)} | {rng.getrandbits(64) for _ in range(200)})
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    found = {r.node: r.root for r in components(links(spark.createDataFrame([(x,) for x in signed], "fp long"), 2)).collect()}
    label = classes(np.array(fps, np.uint64))
    want = {}
    for k in range(len(fps)):
        want.setdefault(label[k], []).append(signed[k])
    got = {}
    for x in signed:
        got.setdefault(found.get(x, x), []).append(x)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_awkward_rows(spark):
    rows = documents(spark)
    got = sorted((str(r.doc_id), r.fp, r.component_id) for r in near_duplicates(rows).collect())
    data = [(r.doc_id, fingerprint(r.text)) for r in rows.collect()]
    label = classes(np.array([f for _, f in data], np.uint64))
    want = []
    for k, (i, f) in enumerate(data):
        ids = [data[j][0] for j in range(len(data)) if label[j] == label[k] and data[j][0] is not None]
        want.append((str(i), f - (1 << 64) if f >> 63 else f, min(ids, default=None)))
    assert got == sorted(want)
    assert near_duplicates(rows.limit(0)).count() == 0


def test_whole_table(spark):
    data = sorted((r.doc_id, r.text) for r in table(spark, "documents").collect())
    fps = np.array([fingerprint(t) for _, t in data], np.uint64)
    label = classes(fps)
    got = {r.doc_id: r.component_id for r in near_duplicates(table(spark, "documents")).collect()}
    assert got == {data[k][0]: data[label[k]][0] for k in range(len(data))}


def test_components_of_chains_and_stars(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 160)] + [(7, 7), (None, 3), (500, 499), (499, 500)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{k: 0 for k in range(1, 41)}, **{k: 100 for k in range(101, 160)}, 500: 499}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0

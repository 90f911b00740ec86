import numpy as np

from textmart.llm.embed_dedup import MultiIndex, fit, near_duplicates


def vectors(n=1200, dim=16, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim))
    for k in range(0, n, 6):  # neighbours at many cosines around the threshold, and one large group
        x[k + 1] = x[k] + rng.normal(size=dim) * 0.25
        x[k + 2] = x[k] * 3
    x[:150] = x[0] + rng.normal(size=(150, dim)) * 0.05
    return x.astype(np.float32)


def brute(x, labels, threshold=0.93):
    x = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    near = (x @ x.T >= threshold) & (labels[:, None] == labels[None, :])
    np.fill_diagonal(near, False)
    return near


def test_links_and_components_against_brute_force(spark):
    x, labels = vectors(), np.arange(1200) // 2 % 3
    labels[:150] = 1
    near = brute(x, labels)
    df = spark.createDataFrame([(k, [float(v) for v in x[k]], int(labels[k])) for k in range(len(x))], "vec_id long, embedding array<float>, label int")
    got = {r.vec_id: r for r in near_duplicates(df, fit(df)).collect()}
    found = sum(r.n_links for r in got.values())
    assert found >= 0.99 * near.sum() and all(got[k].n_links <= near[k].sum() for k in got)
    if found == near.sum():
        label = np.arange(len(x))
        while True:
            new = np.minimum(label, np.where(near, label[None, :], len(x)).min(axis=1))
            if (new == label).all():
                break
            label = new
        assert [got[k].component_id for k in range(len(x))] == label.tolist()
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())


def test_recall_of_the_traversal():
    x = vectors(3000, 64, 9).astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    index = MultiIndex.fit(x[:1000], 0.93)
    row, cell = index.visits(x)
    visited = set(zip(row.tolist(), cell.tolist(), strict=True))
    home = index.cells(x)
    i, j = np.nonzero(np.triu(x @ x.T >= 0.93, 1))
    hit = [(a, home[b]) in visited or (b, home[a]) in visited for a, b in zip(i.tolist(), j.tolist(), strict=True)]
    assert len(hit) > 500 and np.mean(hit) >= 0.99
    assert all((k, home[k]) in visited for k in range(len(x)))
    assert len(visited) < 0.7 * len(x) * len(index.books[0]) * len(index.books[1])


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0, 0.0, 0.0], 1), (2, [2.0, 0.0, 0.0, 0.1], 1), (3, [1.0, 0.0, 0.0, 0.0], 2), (4, [1.0, 0.0, 0.0, 0.0], None), (5, None, 1), (6, [0.0] * 4, 1),
            (7, [1.0, None, 0.0, 0.0], 1), (8, [nan, 0.0, 0.0, 0.0], 1), (9, [inf, 0.0, 0.0, 0.0], 1), (10, [1.0, 0.0], 1), (11, [], 1), (None, [1.0, 0.0, 0.0, 0.0], 1),
            (12, [0.0, 1.0, 0.0, 0.0], 1), (12, [0.0, 1.0, 0.0, 0.0], 1), (13, [0.0, 3.0, 0.0, 0.0], 1)]
    df = spark.createDataFrame([(*r, "x", "x") for r in rows], "vec_id long, embedding array<float>, label int, cell string, id string")
    got = sorted((str(r.vec_id), r.n_links, r.component_id, r.kept) for r in near_duplicates(df, fit(df)).collect())
    links = {"1": (1, 1), "2": (1, 1), "12": (1, 12), "13": (1, 12)}
    want = [(str(i), links.get(str(i), (0, i))[0], links.get(str(i), (0, i))[1], i is None or links.get(str(i), (0, i))[1] == i) for i, _, _ in rows]
    assert got == sorted(want)
    empty = df.limit(0)
    assert fit(empty) == {} and near_duplicates(empty, fit(empty)).count() == 0


def test_every_length_is_indexed(spark):
    rng = np.random.default_rng(8)
    rows, want = [], {}
    for n, count in ((16, 300), (7, 40), (1, 9), (3, 2)):
        x = rng.normal(size=(count, n))
        x[1::2] = x[::2][:len(x[1::2])] * 1.5 + rng.normal(size=x[1::2].shape) * 0.02
        x = x.astype(np.float32)
        ids = [1000 * n + k for k in range(count)]
        near = brute(x, np.zeros(count))
        want |= dict(zip(ids, near.sum(1).tolist(), strict=True))
        rows += [(i, [float(c) for c in v], 4) for i, v in zip(ids, x, strict=True)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    indexes = fit(df, sample_rows=30)
    assert sorted(indexes) == [1, 3, 7, 16]
    assert {r.vec_id: r.n_links for r in near_duplicates(df, indexes).collect()} == want and sum(v > 0 for v in want.values()) > 300

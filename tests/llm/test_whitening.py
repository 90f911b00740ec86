import math
import random

import numpy as np
from pyspark.sql import types as T

from tests.llm.helpers import table
from textmart.llm import whitening as W

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                       T.StructField("id", T.StringType()), T.StructField("y", T.StringType()), T.StructField("n", T.StringType())])


def frame(spark, rows):
    return spark.createDataFrame([(i, v, None, "y", None) for i, v in rows], SCHEMA)


def integers(v):
    return tuple(math.floor(64 * c) + 1_000_000 for c in v)


def usable(v):
    return v is not None and all(c is not None and math.isfinite(c) for c in v)


def check(got, rows):
    """Against exact integer sums and numpy's eigenvalues, per vector length; whitened values up to the sign of a component."""
    rows = [(i, integers(v)) for i, v in rows if usable(v) and len(v)]
    for d in {len(x) for _, x in rows}:
        mine = [(i, x) for i, x in rows if len(x) == d]
        fit = sorted({x for _, x in mine})
        n, sums = len(fit), [sum(c) for c in zip(*fit)]
        centred = np.array([[n * a - s for a, s in zip(x, sums)] for x in fit], float) / n
        cov = centred.T @ centred / n
        e, v = np.linalg.eigh(cov)
        e, v = e[::-1], v[:, ::-1]
        rank = np.linalg.matrix_rank(centred)
        k = min(16, rank)
        here = [r for r in got if r.vec_id in {i for i, _ in mine}]
        assert len(here) == len(mine) * k
        by_row = {}
        for r in here:
            by_row.setdefault((r.vec_id, int(r.deviation)), {}).setdefault(r.component, []).append(r)
        signs = {}
        for i, x in mine:
            z = [n * a - s for a, s in zip(x, sums)]
            found = by_row[i, sum(a * a for a in z)]
            for c in range(k):
                want = float(np.array(z, float) / n @ v[:, c] / math.sqrt(e[c]))
                for r in found[c + 1]:
                    assert r.n == n and abs(r.explained - e[c] / e.sum()) < 1e-9 and r.identity_error < 1e-9
                    if abs(want) > 1e-6:
                        sign = signs.setdefault(c, math.copysign(1, want) * math.copysign(1, r.whitened))
                        assert abs(r.whitened - sign * want) < 1e-5 * max(1, abs(want)), (d, c)


def run(spark, rows):
    vectors = frame(spark, rows).repartition(3)
    return W.whiten(vectors, W.fit(vectors)).collect()


def test_polynomial_roots_and_components():
    """(t - 5)^2 (t - 9) (t - 1/4 scaled by 4): a repeated, an integer and close roots are isolated and counted."""
    rng = np.random.default_rng(2)
    b = rng.integers(-9, 10, (6, 5))
    m = (b.T @ b).astype(object)
    residues = [(p, W.polynomial_mod((m % p).astype(np.int64), p).tolist()) for p in W.primes_for(10 ** 60)]
    assert np.allclose(np.array(W.remaindered(residues)[::-1], float), np.poly(m.astype(float)), rtol=1e-9)
    poly = [1]
    for r in (5, 5, 9, 7, 8):
        poly = [a - r * c for a, c in zip([0, *poly], [*poly, 0])]
    bits, found = W.isolated(poly)
    assert [n for _, _, n, _ in found] == [1, 1, 1, 2] and W.gcd_degree(poly) == 1
    assert [round((W.refined(poly, i, bits) + 1) / 2 ** W.BITS, 9) for i in found] == [9, 8, 7, 5]
    close = [(10 ** 30) * (10 ** 30 + 1), -(2 * 10 ** 30 + 1), 1]  # roots 1e30 and 1e30 + 1
    bits, found = W.isolated(close)
    assert len(found) == 2 and W.refined(close, found[0], bits) + 1 == (10 ** 30 + 1) << W.BITS
    same = np.array([[2, 0, 0], [0, 2, 0], [0, 0, 5]], object)
    vectors = np.array(W.null_space(same, 2 << W.BITS, 2), float)
    assert np.allclose(vectors @ vectors.T, np.eye(2)) and np.allclose(vectors[:, 2], 0)


def test_limbs_and_big_entries():
    y = np.array([[3, -(1 << 40), 1 << 61], [0, -1, -(1 << 61)]])
    assert np.array_equal(sum(p.astype(np.int64).astype(object) * (1 << W.LIMB * k) for k, p in enumerate(W.limbs(y))), y.astype(object))


def test_awkward_rows(spark):
    rng = random.Random(4)
    rows = [(i, [rng.gauss(0, 1 + k) for k in range(5)]) for i in range(40)]
    rows += [(100 + i, rows[3][1]) for i in range(30)] + [(100, rows[4][1])]  # copies, a repeated id
    rows += [(200 + i, [rng.gauss(0, 2), rng.gauss(0, 2)]) for i in range(9)]  # another length
    rows += [(300, None), (301, []), (302, [1.0, None, 0.0, 0.0, 0.0]), (303, [math.nan] * 5), (304, [math.inf] * 5), (305, [1.0])]
    rows = [(i, v if v is None else [None if c is None else float(np.float32(c)) for c in v]) for i, v in rows]
    got = run(spark, rows)
    assert {r.vec_id for r in got} == {i for i, v in rows if usable(v) and len(v) > 1}
    check([r for r in got], [(i, v) for i, v in rows if v is None or len(v) > 1])
    assert run(spark, []) == [] == run(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])


def test_lower_rank_repeated_eigenvalues_and_huge_entries(spark):
    square = [(0, [1.0, 0.0, 7.0]), (1, [-1.0, 0.0, 7.0]), (2, [0.0, 1.0, 7.0]), (3, [0.0, -1.0, 7.0])]
    got = run(spark, square)
    assert len(got) == 8 and all(abs(r.explained - 0.5) < 1e-12 and r.identity_error < 1e-12 for r in got)
    for i in range(4):  # any basis of the plane will do: a vector's length is the same in all
        assert abs(sum(r.whitened ** 2 for r in got if r.vec_id == i) - 2) < 1e-9
    got = run(spark, [(0, [1e30, 0.0]), (1, [-1e30, 1.0]), (2, [0.0, 3e9])])
    assert len(got) == 6 and all(r.identity_error < 1e-9 for r in got)


def test_whole_table(spark):
    vectors = table(spark, "embeddings", "sf0.01")
    check(W.whiten(vectors, W.fit(vectors)).collect(), [(r.vec_id, r.embedding) for r in vectors.collect()])

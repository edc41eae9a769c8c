import math
from fractions import Fraction

import numpy as np
import pytest

from skylattice.llm import whitening


def exact(vectors):
    """n, sums and covariance of the distinct integer vectors, in fractions."""
    fit = sorted({tuple(math.floor(256 * c) for c in v) for v in vectors})
    n, d = len(fit), len(fit[0])
    sums = [sum(x[i] for x in fit) for i in range(d)]
    centred = [[Fraction(n * c - s, n) for c, s in zip(x, sums)] for x in fit]
    return n, sums, np.array([[float(sum(r[i] * r[j] for r in centred) / n) for j in range(d)] for i in range(d)])


@pytest.mark.parametrize("scale,offset", [(1.0, 0.0), (1e3, 1e6), (3e13, 1e14)])
def test_rows_match_exact_arithmetic(spark, scale, offset):
    rng = np.random.default_rng(5)
    vectors = (rng.normal(size=(300, 6)) * [5, 3, 2, 1, 0.5, 0.2] @ np.linalg.qr(rng.normal(size=(6, 6)))[0] * scale + offset).tolist()
    rows = [(i, v) for i, v in enumerate(vectors)] + [(1, vectors[1]), (500, vectors[2]), (None, vectors[3])] + [(600 + i, vectors[0]) for i in range(200)]
    bad = [(900, None), (901, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (902, [math.nan] + [0.0] * 5), (903, [math.inf] + [0.0] * 5), (904, []), (905, [1.0, 2.0])]
    df = spark.createDataFrame(rows + bad, "vec_id bigint, embedding array<double>").selectExpr("*", "1 AS x", "2 AS id", "3 AS n").repartition(5)
    got = whitening.whiten(df).collect()
    n, sums, cov = exact(vectors)
    assert len(got) == 4 * len(rows) and {r.n for r in got} == {n} and len({r.identity_error for r in got}) == 1
    values, columns = np.linalg.eigh(cov)
    assert got[0].identity_error <= 1e-4
    by_id = {}
    for r in got:
        by_id.setdefault(r.vec_id, []).append(r)
    for vec_id, v in rows:
        x = [math.floor(256 * c) for c in v]
        deviation = sum((n * c - s) ** 2 for c, s in zip(x, sums))
        y = np.array([float(Fraction(n * c - s, n)) for c, s in zip(x, sums)])
        for r in by_id[vec_id]:
            k = -r.component
            assert r.deviation == (deviation if deviation < 2**63 else None)
            assert abs(abs(r.whitened) - abs(y @ columns[:, k] / math.sqrt(values[k]))) < 1e-6
            assert abs(r.explained / (values[k] / values.sum()) - 1) < 1e-6
    signs = {np.sign(r.whitened * (np.array([float(Fraction(n * math.floor(256 * c) - s, n)) for c, s in zip(vectors[r.vec_id], sums)]) @ columns[:, -r.component])) for r in got if r.component == 1 and r.vec_id is not None and r.vec_id < 300}
    assert len(signs) == 1


def test_residues_give_the_exact_scatter(spark):
    rng = np.random.default_rng(1)
    x = rng.integers(-(2**62), 2**62, (500, 3)).tolist() + [[-(2**63), 2**63 - 1, 0]]
    df = spark.createDataFrame([(v,) for v in x], "x array<bigint>").repartition(4)
    w = whitening.fit(df)
    n, sums = len(x), [sum(c) for c in zip(*x)]
    assert w.n == n and w.sums == sums
    for i in range(3):
        for j in range(3):
            assert w.covariance[i, j] == (n * sum(a[i] * a[j] for a in x) - sums[i] * sums[j]) / n**2
    assert len(whitening.moduli(10**60)) == 11 and all(all(p % q for q in range(2, 1100)) for p in whitening.moduli(10**60))


def test_products_of_a_block_stay_exact():
    assert whitening.ROWS * (whitening.PRIME_BOUND - 1) ** 2 <= 2**53


def test_vectors_without_variation(spark):
    one = whitening.whiten(spark.createDataFrame([(1, [0.5, 0.25]), (2, [0.5, 0.25])], "vec_id bigint, embedding array<float>")).collect()
    assert [(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in one] == [(1, 0, None, None, None)] * 4
    line = whitening.whiten(spark.createDataFrame([(i, [float(i), 2.0]) for i in range(5)], "vec_id bigint, embedding array<float>")).collect()
    assert [r.whitened is None for r in line] == [False, True] * 5 and line[0].explained == 1.0 and line[0].identity_error < 1e-9
    schema = "vec_id bigint, embedding array<float>"
    empty = whitening.whiten(spark.createDataFrame([], schema))
    assert empty.count() == 0 and empty.schema.simpleString() == whitening.whiten(spark.createDataFrame([(1, [1.0])], schema)).schema.simpleString()
    assert whitening.whiten(spark.createDataFrame([(1, None), (2, [])], schema)).count() == 0

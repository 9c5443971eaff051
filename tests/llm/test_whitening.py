import math
from fractions import Fraction

import numpy as np
import pytest

from vigil.llm import whitening
from vigil.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
SCHEMA = "vec_id bigint, embedding array<float>, label int, component int, `a.b` string, n long"


def frame(spark, vectors, kind="float"):
    rows = [(i, v and [c if c is None else float(c) for c in v], 1, 2, "c", 3) for i, v in vectors]
    return spark.createDataFrame(rows, SCHEMA.replace("float", kind))


def plain(vectors, components=8):
    """By whole numbers and fractions, and numpy's own solver."""
    kept = [(i, [math.floor(1024 * c) + 100_000 for c in v]) for i, v in vectors
            if v and all(c is not None and math.isfinite(c) for c in v)]
    n, d = len(kept), len(kept[0][1])
    total = [sum(x[j] for _, x in kept) for j in range(d)]
    centred = [[Fraction(n * x[j] - total[j], n) for j in range(d)] for _, x in kept]
    deviation = [sum((n * x[j] - total[j]) ** 2 for j in range(d)) for _, x in kept]
    z = np.array([[float(c) for c in row] for row in centred])
    values, vectors_ = np.linalg.eigh(z.T @ z / n)
    values, vectors_ = values[::-1][:components], vectors_[:, ::-1][:, :components]
    white = z @ vectors_ / np.sqrt(values)
    return n, [i for i, _ in kept], deviation, white, values / np.trace(z.T @ z / n)


def held(out, vectors, tolerance, components=8):
    n, ids, deviation, white, explained = plain(vectors, components)
    rows = out.collect()
    assert len(rows) == len(ids) * white.shape[1]
    assert {r.n for r in rows} == {n} and len({r.identity_error for r in rows}) == 1
    assert rows[0].identity_error < 1e-9
    by = {}
    for r in rows:
        by.setdefault(r.component, {}).setdefault(r.vec_id, []).append(r)
    for c in by:
        got = by[c]
        mine = {}
        for i, d, w in zip(ids, deviation, white[:, c - 1]):
            mine.setdefault(i, []).append((d, w))
        sign = np.sign(sum(r.whitened * w for i in got if len(got[i]) == 1 for r, (_, w) in zip(got[i], mine[i])))
        assert {i: len(v) for i, v in got.items()} == {i: len(v) for i, v in mine.items()}
        for i in got:
            a = sorted((r.deviation, r.whitened) for r in got[i])
            b = sorted((d, float(sign * w)) for d, w in mine[i])
            assert [x[0] for x in a] == [x[0] for x in b]
            assert np.allclose([x[1] for x in a], [x[1] for x in b], atol=tolerance, rtol=0)
        assert abs(rows_of_component(by, c).explained / explained[c - 1] - 1) < 1e-9


def rows_of_component(by, c):
    return next(iter(by[c].values()))[0]


def test_table(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet")
    vectors = [(r.vec_id, r.embedding) for r in table.collect()]
    held(QUERIES["op12_whitening"](spark, SF), vectors, 1e-9)


def test_odd_rows(spark):
    draw = np.random.default_rng(1)
    good = [(i, np.float32(draw.normal(size=5) * [8, 4, 2, 1, 0.5]).tolist()) for i in range(40)]
    good += [(7, good[7][1]), (7, good[3][1]), (None, good[5][1]), (41, [-0.0, 2.0**-90, 3.0, -2.5, 1 / 1024])]
    odd = [(50, None), (51, []), (52, [1.0, 2, 3, 4, None]), (53, [math.nan] * 5), (54, [1.0, 2, math.inf, 4, 5]),
           (55, [-math.inf, 0.0, 0, 0, 0])]
    held(whitening.whiten(frame(spark, good + odd)), good, 1e-9)
    held(whitening.whiten(frame(spark, good, "double"), 2), good, 1e-9, 2)
    assert whitening.whiten(frame(spark, good + [(60, [1.0, 2.0]), (61, [1e30] * 5)])).count() == 5 * len(good)


def test_no_variance_no_rows(spark):
    for vectors in ([], [(1, [1.0, 2.0])], [(1, [1.0, 2.0])] * 4, [(1, None), (2, [])]):
        out = whitening.whiten(frame(spark, vectors))
        assert out.count() == 0
        assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    line = whitening.whiten(frame(spark, [(i, [float(i), 2.0 * i, 1.0]) for i in range(6)])).collect()
    assert {r.component for r in line} == {1} and len(line) == 6


def test_large_entries_stay_exact(spark):
    vectors = [(i, [2.0**40 + i, -(2.0**41) * i, 3.5 * i * i]) for i in range(9)]
    rows = whitening.whiten(frame(spark, vectors, "double")).collect()
    _, ids, deviation, _, _ = plain(vectors)
    assert {r.vec_id: r.deviation for r in rows} == {i: d if d < 2**63 else None for i, d in zip(ids, deviation)}
    assert rows[0].identity_error < 1e-4


@pytest.mark.parametrize("most", [9, 2**18, 2**20, 2**40, 2**52])
def test_products(most):
    z = np.random.default_rng(most).integers(-most, most, (70, 6))
    exact = z.astype(object).T @ z.astype(object)
    assert (whitening.products(z).astype(object) == exact).all()


def turned(values, seed=3):
    """A symmetric matrix in long double with these eigenvalues, and its eigenvectors."""
    d = len(values)
    q = np.linalg.qr(np.random.default_rng(seed).normal(size=(d, d)))[0].astype(np.longdouble)
    for _ in range(4):  # orthogonal to long double
        q = q @ (np.eye(d) * 1.5 - q.T @ q / 2)
    return (q * np.array(values, np.longdouble)) @ q.T, q


@pytest.mark.parametrize("values", [
    [7, 5, 3, 1], [1e6, 1, 1 + 1e-9, 1 - 1e-9, 0.5], [1 + 1e-12 * i for i in range(12)],
    [9, 9 - 1e-13, 9 - 3e-13, 4, 4 + 1e-8, 4 + 2e-8, 4 + 1e-8 + 1e-11, 1e-3], [1e-9, 1, 1e9], [2e30, 1e30, 3e-30],
])
def test_close_eigenvalues_are_told_apart(values):
    a, q = turned(values)
    found, x = whitening.eigenpairs(a)
    order = np.argsort(-np.array(values))
    wanted, q = np.array(values, np.longdouble)[order], q[:, order]
    length = np.abs(wanted).max()
    assert np.abs(found - wanted).max() <= 1e-17 * len(values) * length
    assert np.abs(x.T @ x - np.eye(len(values))).max() < 1e-17
    for i, gap in enumerate(np.abs(wanted[:, None] - wanted[None, :]) + np.diag([np.inf] * len(wanted))):
        # What long double itself allows: its rounding over the gap.
        assert 1 - abs((x[:, i] * q[:, i]).sum()) < 1e-15 + (1e-17 * length / gap.min()) ** 2 * 100


def test_equal_eigenvalues():
    for a in (np.eye(5), np.zeros((3, 3)), np.diag([2.0, 2, 2, 1, 1, 0, 0]), turned([3, 3, 3, 1, 1])[0]):
        values, x = whitening.eigenpairs(a)
        assert np.abs(x.T @ x - np.eye(len(a))).max() < 1e-17
        assert np.abs(a @ x - x * values).max() < 1e-17

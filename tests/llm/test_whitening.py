"""Whitening against exact rational arithmetic and numpy."""

import math
from fractions import Fraction

import numpy as np
import pytest

from basketstream.llm import whitening

TYPE = "vec_id long, embedding array<float>, label int, vector string, n long, deviation long, i int, j int, digit int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "v", 1, 2, 3, 4, 5) for i, v in rows], TYPE).repartition(4)


def plain(rows, components):
    kept = [(i, [float(np.float32(c)) for c in v]) for i, v in rows if v and all(c is not None and math.isfinite(np.float32(c)) for c in v)]
    size = max({len(v) for _, v in kept}, key=lambda s: (sum(len(v) == s for _, v in kept), s))
    kept = [(i, [math.floor(1024 * Fraction(c)) + 100000 for c in v]) for i, v in kept if len(v) == size]
    n, sums = len(kept), [sum(v[k] for _, v in kept) for k in range(size)]
    away = [[n * x - s for x, s in zip(v, sums)] for _, v in kept]
    cov = np.array([[float(Fraction(sum(a[i] * a[j] for a in away), n**3)) for j in range(size)] for i in range(size)])
    values, vectors = np.linalg.eigh(cov)
    order = [k for k in np.argsort(-values) if values[k] > 1e-12 * values.max()][:components]
    out = {}
    for (i, _), a in zip(kept, away):
        u = np.array([float(Fraction(c, n)) for c in a])
        out.setdefault(i, []).append((sum(c * c for c in a), [u @ vectors[:, k] / math.sqrt(values[k]) for k in order]))
    return n, out, [values[k] / np.trace(cov) for k in order]


def compare(df, rows, components, tolerance=1e-9):
    n, want, explained = plain(rows, components)
    found = df.collect()
    assert len(found) == len(explained) * sum(map(len, want.values())) and {r.n for r in found} == {n}
    sign = {}
    for row in sorted(found, key=lambda r: -abs(r.whitened)):
        options = want[row.vec_id]
        fitting = [w for far, w in options if far == row.deviation or row.deviation is None and far >= 10**38]
        assert fitting
        if len(fitting) == 1 and row.component not in sign:
            sign[row.component] = np.sign(row.whitened) * np.sign(fitting[0][row.component - 1])
        assert any(abs(row.whitened - sign[row.component] * w[row.component - 1]) < tolerance * max(1, abs(row.whitened)) for w in fitting)
        assert abs(row.explained - explained[row.component - 1]) <= 1e-9
        assert row.identity_error < 1e-6


def draw(seed, rows, size, scale=0.3):
    values = np.random.default_rng(seed).normal(0, scale, (rows, size)) @ np.diag(np.linspace(1, 3, size))
    return [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(values)]


def test_odd_rows(text_spark):
    rows = draw(1, 300, 7) + [(1000, None), (1001, []), (1002, [1.0] * 6 + [float("nan")]), (1003, [None] * 7),
                              (1004, [float("inf")] + [0.0] * 6), (1005, [0.5] * 3), (None, [0.1] * 7), (5, [0.2] * 7), (5, [0.2] * 7), (1006, [-0.0] * 7)]
    compare(whitening.whitened(frame(text_spark, rows), 4), rows, 4)


def test_all_components_and_more_than_there_are(text_spark):
    rows = draw(2, 50, 3)
    compare(whitening.whitened(frame(text_spark, rows), 8), rows, 8)


def test_large_entries_stay_exact(text_spark):
    rows = draw(3, 40, 3) + [(100, [3e7, -2e8, 5.0]), (101, [1e19, 2.0, -1e12]), (102, [-1e19, 7.0, 1e12])]
    compare(whitening.whitened(frame(text_spark, rows), 2), rows, 2, 1e-6)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [0.5, 0.25])], [(1, [0.5, 0.25]), (2, [0.5, 0.25])]])
def test_nothing_to_whiten(text_spark, rows):
    df = whitening.whitened(frame(text_spark, rows))
    assert df.collect() == []
    assert df.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_digits_give_the_number_back():
    for value in (0, 1, -1, 1 << 39, -(1 << 39), (1 << 40) - 1, 10**40 + 7, -(10**40) - 7):
        assert sum(low << (40 * at) for at, low in whitening.digits(value)) == value
        assert all(-(1 << 39) <= low < 1 << 39 for _, low in whitening.digits(value))

"""Whitening against a plain eigenvalue solver."""

from collections import defaultdict

import numpy as np
import pytest

from millwright.llm.whitening import spectrum, whitened

SCHEMA = "vec_id long, embedding array<float>, x string, component string"


def usable(rows, d):
    out = []
    for i, v, *_ in rows:
        if v and len(v) == d and None not in v and np.isfinite(np.array(v, np.float32)).all():
            out.append((i, np.floor(np.array(v, np.float32).astype(float) * 256).astype(np.int64)))
    return out


@pytest.fixture(scope="module")
def rows():
    r = np.random.default_rng(8)
    base = (r.standard_normal((400, 7)) * [5, 3, 2, 1, 1, 0.5, 0.1]).astype(np.float32)
    out = [(k, v.tolist(), "a", "b") for k, v in enumerate(base)]
    out += [(k, base[3].tolist(), "a", "b") for k in range(1000, 1300)]  # one vector many times
    out += [(3, base[5].tolist(), None, None), (None, base[6].tolist(), None, None)]
    out += [(2000, None, "", ""), (2001, [], "", ""), (2002, [None] * 7, "", ""), (2003, [1.0] * 6 + [float("nan")], "", ""), (2004, [float("inf")] * 7, "", "")]
    return out + [(2005, [1.0, 2.0], "", ""), (2006, [-0.0] * 7, "", ""), (2007, [0.001] * 7, "", "")]


def test_rows_are_those_of_a_plain_solver(spark, rows):
    got = defaultdict(dict)
    seen = 0
    for r in whitened(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect():
        seen += 1
        got[r["vec_id"]][r["component"]] = r
    mine = usable(rows, 7)
    assert seen == 4 * len(mine)
    fit = np.array(sorted({tuple(x.tolist()) for _, x in mine}))
    n, sums = len(fit), fit.sum(0)
    centred = fit - sums / n
    cov = centred.T @ centred / n
    values, vectors = np.linalg.eigh(cov)
    for k in range(1, 5):
        e, direction = values[-k], vectors[:, -k]
        sign = np.sign(sum(got[i][k]["whitened"] * ((x - sums / n) @ direction) for i, x in mine))
        for i, x in mine:
            r = got[i][k]
            if i == 3:
                continue
            assert r["n"] == n and r["deviation"] == int(((n * x - sums) ** 2).sum())
            assert r["whitened"] == pytest.approx(sign * ((x - sums / n) @ direction) / np.sqrt(e), rel=1e-9, abs=1e-9)
            assert r["explained"] == pytest.approx(e / np.trace(cov), rel=1e-9) and r["identity_error"] < 1e-9


def test_spectra_of_hard_matrices():
    r = np.random.default_rng(0)
    q, _ = np.linalg.qr(r.standard_normal((40, 40)))
    cases = [q * np.logspace(0, -14, 40) @ q.T, q * np.array([5, 5, 5, 1] + [0] * 36) @ q.T, np.eye(6) * 3, np.zeros((4, 4)), np.ones((5, 5))]
    cases += [np.diag([1.0, 2, 3, 4]), q * np.array([1e6, 1e6 * (1 + 1e-9)] + [1.0] * 38) @ q.T, np.array([[2.0]])]
    for a in cases:
        a = (a + a.T) / 2
        values, x = spectrum(a)
        scale = max(np.linalg.norm(a), 1e-300)
        assert np.abs(x.T @ x - np.eye(len(a))).max() < 1e-13 and np.abs(a @ x - x * values).max() / scale < 1e-13
        assert np.abs(values - np.linalg.eigvalsh(a)[::-1]).max() / scale < 1e-13


def test_degenerate_tables(spark):
    assert whitened(spark.createDataFrame([], SCHEMA)).collect() == []
    assert whitened(spark.createDataFrame([(1, None, "", ""), (2, [], "", "")], SCHEMA)).collect() == []
    same = whitened(spark.createDataFrame([(k, [1.0, 2.0], "", "") for k in range(5)], SCHEMA)).collect()
    assert len(same) == 10 and all(r["whitened"] is None and r["explained"] is None and r["deviation"] == 0 and r["n"] == 1 for r in same)
    line = whitened(spark.createDataFrame([(k, [float(k), 2.0 * k, 0.0], "", "") for k in range(5)], SCHEMA)).collect()
    assert all((r["whitened"] is None) == (r["component"] > 1) for r in line) and max(r["identity_error"] for r in line) < 1e-12


def test_large_numbers_stay_exact(spark):
    rows = [(k, [2.0**30 * (k % 3), float(k)]) for k in range(10)] + [(10, [3e38, -3e38])]
    got = whitened(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    xs = [[int(256 * v) for v in map(lambda x: float(np.float32(x)), r[1])] for r in rows]
    xs = [[max(-(2**63), min(2**63 - 1, v)) for v in x] for x in xs]
    n, sums = len(xs), [sum(c) for c in zip(*xs, strict=True)]
    want = {k: sum((n * v - s) ** 2 for v, s in zip(x, sums, strict=True)) for k, x in enumerate(xs)}
    assert {r["vec_id"]: r["deviation"] for r in got.collect()} == {k: v if v < 2**63 else None for k, v in want.items()}

import math

import numpy as np

from varloom.llm import neighbours as nb

SCHEMA = "vec_id long, embedding array<double>, score double, cell string"


def brute(rows, k, every):
    have = {i: np.array(v) for i, v in rows}
    out = {}
    for q in have:
        if q % every:
            continue
        scored = sorted((-math.fsum(have[q] * v), i) for i, v in have.items() if i != q)[:k]
        out[q] = [(i, -s) for s, i in scored]
    return out


def run(spark, rows, k=5, every=4):
    frame = spark.createDataFrame([(i, v, 0.0, "c") for i, v in rows], SCHEMA)
    out = {}
    for r in sorted(nb.nearest(frame, k, every).collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
    return out


def recall(got, want):
    pairs = [(q, i) for q, v in want.items() for i, _ in v]
    return sum(i in {x for x, _ in got.get(q, [])} for q, i in pairs) / len(pairs)


def test_recall_over_many_cells_and_norms(spark, monkeypatch):
    monkeypatch.setattr(nb, "CELL_ROWS", 120)
    monkeypatch.setattr(nb, "BLOCK", 100)
    monkeypatch.setattr(nb, "QUERIES", 30)
    monkeypatch.setattr(nb, "LEAF", 16)
    rng = np.random.default_rng(2)
    centres = rng.standard_normal((12, 16))
    rows = [(i, ((centres[i % 12] + 0.3 * rng.standard_normal(16)) * rng.uniform(0.5, 2)).tolist()) for i in range(1200)]
    got, want = run(spark, rows), brute(rows, 5, 4)
    assert got.keys() == want.keys() and recall(got, want) >= 0.9
    for q, found in got.items():
        assert all(s == math.fsum(np.array(rows[q][1]) * np.array(rows[i][1])) for i, s in found)


def test_copies_and_rows_that_take_no_part(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.standard_normal(6).tolist()) for i in range(40)]
    rows += [(100 + i, [1.0, 2.0, 0.0, 0.5, 0.0, 0.0]) for i in range(60)]
    odd = [(200, None), (204, []), (208, [0.0] * 6), (212, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (216, [float("nan")] + [1.0] * 5), (220, [float("inf")] + [1.0] * 5), (224, [1.0, 2.0]), (None, [1.0] * 6), (0, rows[0][1])]
    assert run(spark, rows + odd) == {q: v for q, v in brute(rows, 5, 4).items()}


def test_few_and_no_rows(spark):
    assert run(spark, []) == {}
    assert run(spark, [(4, [1.0, 0.0])]) == {}
    assert run(spark, [(4, [1.0, 0.0]), (5, [0.5, 1.0])]) == {4: [(5, 0.5)]}


def test_chi_square_quantile():
    # fixed values of the law with 8 degrees of freedom
    assert abs(nb.chi_square_quantile(0.95, 8) - 15.507) < 1e-3 and abs(nb.chi_square_quantile(0.5, 8) - 7.344) < 1e-3

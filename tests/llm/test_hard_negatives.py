import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import hard_negatives as hn, vector_tree as vt

SCHEMA = "vec_id long, label int, embedding array<double>, rank string, score string, leaf int"


def clustered(seed, n, dims=12, groups=10, spread=0.05):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(groups, dims))
    rows = centres[draw.integers(groups, size=n)] + spread * draw.normal(size=(n, dims))
    return rows / np.linalg.norm(rows, axis=1)[:, None]


def expected(rows, every=100):
    own = {}
    for i, label, v in rows:
        if i is None or label is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        one = (label, [int(np.floor(256 * x)) for x in v])
        own[i] = min(own.get(i, one), one)
    out = []
    for a, (label, v) in own.items():
        if a % every:
            continue
        score = {i: sum(x * y for x, y in zip(v, w)) for i, (_, w) in own.items() if i != a}
        order = sorted(score, key=lambda i: (-score[i], i))
        for p in [i for i in order if own[i][0] == label][:5]:
            fit = [i for i in order if own[i][0] != label and 30 * score[p] <= 100 * score[i] <= 90 * score[p]][:10]
            out += [(a, p, r, i, score[p], score[i]) for r, i in enumerate(fit, 1)]
    return sorted(out)


def mined(spark, rows, every=100):
    df = spark.createDataFrame([(*r, "own", "own", 1) for r in rows], SCHEMA)
    usable = hn.usable(df, F.col("vec_id"), F.col("label"), F.col("embedding"))
    return sorted(map(tuple, hn.hard_negatives(usable, F.col("vec_id") % every == 0).collect()))


@pytest.fixture
def small_leaves(monkeypatch):
    monkeypatch.setattr(vt, "LEAF_ROWS", 30)
    monkeypatch.setattr(vt, "PIECE", 50)


@pytest.mark.parametrize("groups,spread", [(10, 0.05), (3, 0.4), (40, 0.01)])
def test_against_brute_force(spark, small_leaves, groups, spread):
    vectors = clustered(groups, 1500, groups=groups, spread=spread)
    rows = [(i, int(i * 7 % 4), v.tolist()) for i, v in enumerate(vectors)]
    assert mined(spark, rows, 50) == expected(rows, 50)


def test_copies_ties_and_odd_rows(spark, small_leaves):
    vectors = clustered(5, 400, dims=4).round(1)
    rows = [(i, i % 3, v.tolist()) for i, v in enumerate(vectors)]
    rows += [(1000 + i, i % 2, [1.0, 0.0, 0.0, 0.0]) for i in range(300)]  # a third are one vector
    rows += [(2000, None, [1.0] * 4), (2001, 1, None), (2002, 1, [1.0, None, 0.0, 0.0]), (2003, 1, [float("nan")] * 4),
             (2004, 1, [float("inf"), 0.0, 0.0, 0.0]), (None, 1, [1.0] * 4), (2100, 0, []), (2200, 1, [0.0] * 4), (2300, 0, [-1.0, 0.0, 0.0, 0.0])]
    rows += rows[:5] + [(100, 2, [0.5, 0.5, 0.5, 0.5])]  # repeated rows and a second row of an id
    assert mined(spark, rows) == expected(rows)


def test_large_components_stay_exact(spark):
    rows = [(i, i % 2, [float(2**20 + i), float(-(2**12) * i), 3.0]) for i in range(0, 300, 3)]
    assert mined(spark, rows, 30) == expected(rows, 30)


def test_empty_table_and_no_anchor(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(i, 0, [1.0]) for i in (1, 2, 3)]) == []


def test_annuli_rule_out_siblings(spark, small_leaves):
    """Without the ranges all leaves would be visited; with them few are, and none that matters is lost."""
    vectors = np.floor(256 * clustered(9, 3000, groups=60, spread=0.02))
    tree = vt.Tree(vectors[:1000], len(vectors))
    leaf, ranges = tree.assign(vectors)
    bounds = {}
    for n, i, j, near, far in ranges:
        old = bounds.get((n, i, j), (np.inf, -np.inf))
        bounds[n, i, j] = min(old[0], near), max(old[1], far)
    tree.set_ranges([(*k, *v) for k, v in bounds.items()])
    queries, scores = vectors[:40], vectors[:40] @ vectors.T
    high = np.quantile(scores, 0.99, axis=1)
    low = np.quantile(scores, 0.98, axis=1)
    seen = tree.visits(queries, np.arange(40), low, high)
    met = {(leaf_, q) for leaf_, alive in seen for q in alive}
    for q in range(40):
        inside = (scores[q] >= low[q]) & (scores[q] <= high[q])
        assert {int(x) for x in leaf[inside]} <= {leaf_ for leaf_, who in met if who == q}
    assert len(met) < 0.5 * 40 * tree.n_leaves and tree.n_leaves > 50

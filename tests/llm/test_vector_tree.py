"""The k-means tree: recall against brute force, exact scores, odd rows and hot leaves."""

import numpy as np
import pytest

from demandloom.llm import vector_tree as vt

SCHEMA = "vec_id long, embedding array<float>, score double, `a.b` int"


def table(spark, ids, vectors):
    rows = [(i, None if v is None else [None if x is None else float(x) for x in v], 1.0, 2) for i, v in zip(ids, vectors)]
    return spark.createDataFrame(rows, SCHEMA)


def exact(ids, vectors, k, every):
    """query -> [(score, id)] best first, by row-wise sums in double precision."""
    v = {i: np.asarray(x, np.float32).astype(float) for i, x in zip(ids, vectors)}
    result = {}
    for q in v:
        if q % every == 0:
            rows = [(-float((v[q] * v[i]).sum()), i) for i in v if i != q and len(v[i]) == len(v[q])]
            result[q] = [(-s, i) for s, i in sorted(rows)[:k]]
    return result


def found(df):
    result = {}
    for r in df.collect():
        result.setdefault(r["query_id"], []).append((r["rank"], r["score"], r["vec_id"]))
    for rows in result.values():
        rows.sort()
        assert [r[0] for r in rows] == list(range(1, len(rows) + 1))
        assert len({r[2] for r in rows}) == len(rows)
        assert [(-r[1], r[2]) for r in rows] == sorted((-r[1], r[2]) for r in rows)
    return {q: [(s, i) for _, s, i in rows] for q, rows in result.items()}


def recall(got, truth):
    return np.mean([len({i for _, i in got[q]} & {i for _, i in truth[q]}) / len(truth[q]) for q in truth])


@pytest.mark.parametrize("clusters", [0, 25])
def test_recall_and_scores(spark, monkeypatch, clusters):
    monkeypatch.setattr(vt, "PART", 64)   # many regions, several salts
    rng = np.random.default_rng(clusters)
    centres = rng.normal(size=(max(clusters, 1), 16)) * bool(clusters) * 3
    vectors = centres[rng.integers(0, len(centres), 1500)] + rng.normal(size=(1500, 16))
    ids = list(range(1500))
    got, truth = found(vt.nearest_neighbours(table(spark, ids, vectors), k=10)), exact(ids, vectors, 10, 20)
    assert set(got) == set(truth) and all(len(r) == 10 for r in got.values())
    assert recall(got, truth) >= 0.9
    stored = {i: np.asarray(v, np.float32).astype(float) for i, v in zip(ids, vectors)}
    for q, rows in got.items():
        assert np.allclose([s for s, _ in rows], [stored[q] @ stored[i] for _, i in rows], rtol=1e-12)


def test_a_hot_leaf_is_dealt_over_regions_and_ties_are_whole(spark, monkeypatch):
    """A third of all rows is one vector: ties go to the smallest ids, whatever region holds them."""
    monkeypatch.setattr(vt, "PART", 32)
    rng = np.random.default_rng(1)
    vectors = [np.ones(4) if i % 3 == 0 else rng.normal(size=4) for i in range(600)]
    ids = list(range(600))
    got, truth = found(vt.nearest_neighbours(table(spark, ids, vectors), k=5, recall=1.0)), exact(ids, vectors, 5, 20)
    hot = [q for q in truth if q % 3 == 0]
    assert hot and all(got[q] == truth[q] for q in hot)


def test_odd_rows(spark):
    vectors = [[1, 0], [0, 1], None, [], [0, 0], [1, None], [float("nan"), 1], [float("inf"), 1], [1, 2, 3], [2, 2, 2], [5], [0.5, 0.5]]
    ids = [0, 1, 2, 3, 4, 5, 6, 7, 20, 9, 40, 11]
    whole = table(spark, [*ids, None, 1], [*vectors, [9, 9], [0, 1]])  # no id; a repeated row
    good = {0: vectors[0], 1: vectors[1], 11: vectors[11], 20: vectors[8], 9: vectors[9], 40: vectors[10]}
    truth = exact(list(good), list(good.values()), 20, 20)
    assert found(vt.nearest_neighbours(whole)) == {q: r for q, r in truth.items() if r}


def test_empty_table(spark):
    assert vt.nearest_neighbours(table(spark, [], [])).count() == 0


def test_large_components_and_long_vectors(spark):
    rng = np.random.default_rng(2)
    vectors, ids = rng.normal(size=(60, 3000)) * 1e15, list(range(60))
    got, truth = found(vt.nearest_neighbours(table(spark, ids, vectors), k=3)), exact(ids, vectors, 3, 20)
    assert recall(got, truth) >= 0.9


def test_best_bin_first_visits_every_leaf_once():
    points = np.random.default_rng(3).normal(size=(400, 8))
    tree = vt.Tree(points)
    walk = list(tree.walk((tree.centres @ points[0]).tolist()))
    assert sorted(walk) == list(range(tree.leaves)) and tree.leaves > 20
    assert set(tree.place(points).tolist()) <= set(walk)

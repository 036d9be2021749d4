"""Pooled model and recursion."""

import datetime
import pickle

import numpy as np
import pytest
from pyspark.sql import functions as F

from demandloom import params as P
from demandloom.operators import boosting, encoding, recursive
from demandloom.params import BoostingParams
from demandloom.sources.storage import stage_path


SETTINGS = BoostingParams(rounds=4, learning_rate=0.3, checkpoint_every=2)


@pytest.fixture(scope="module")
def fitted(ws):
    return boosting.fit_pooled_model(ws.training, SETTINGS)


def test_loss_falls(fitted):
    losses = fitted[1]
    assert len(losses) == 4 and all(a > b for a, b in zip(losses, losses[1:]))


def test_every_registered_round_lowers_the_loss(ws):
    forest, losses = ws.fitted
    assert len(losses) == len(forest.trees) == 150 and all(a > b for a, b in zip(losses, losses[1:]))
    assert all(3 <= len(t["feature"]) <= 61 for t in forest.trees)


def test_flat_trees_score_like_training(ws, fitted):
    """The loss of the trees by thresholds on the training rows is the loss training reported by bins."""
    forest, losses = fitted
    rows = encoding.encode_training(ws.training).select(*boosting.INPUTS, "units_sold").toPandas()
    rate = forest.predict(rows[boosting.INPUTS].to_numpy(float))
    assert np.mean(rate - rows["units_sold"] * np.log(rate)) == pytest.approx(losses[-1], rel=1e-9)


def tiny(spark, rows):
    """rows: (store, item, day, demand, lag_1); all other features are constant."""
    known = {f: 0.0 for f in P.FEATURES}
    frame = [(s, i, datetime.date(2020, 1, 1) + datetime.timedelta(d), *(known | {"lag_1": float(x)}).values(), y) for s, i, d, y, x in rows]
    return spark.createDataFrame(frame, "store_id string, item_id string, date date, " + ", ".join(f"{f} double" for f in P.FEATURES) + ", units_sold int")


def test_first_tree_by_hand(spark):
    """Twelve rows, demand 1 where lag_1 is at most 5 and 5 above: mean 3, one split, Newton leaves."""
    rows = [("s", f"i{k}", 0, 1 if k < 6 else 5, k) for k in range(12)]  # one day: all codes are the prior
    forest, losses = boosting.fit_pooled_model(tiny(spark, rows), BoostingParams(rounds=1, learning_rate=0.5, min_leaf_rows=4))
    tree = forest.trees[0]
    assert forest.start == pytest.approx(np.log(3))
    assert [boosting.INPUTS[tree["feature"][0]], tree["threshold"][0]] == ["lag_1", 5.0]
    leaf = [tree["value"][tree[side][0]] for side in ("left", "right")]
    # gradient 6 * (3 - 1) and 6 * (3 - 5), hessian 6 * 3, l2 1
    assert leaf == pytest.approx([-12 / 19, 12 / 19], abs=1e-4)
    rate = 3 * np.exp(0.5 * np.array([leaf[0]] * 6 + [leaf[1]] * 6))
    demand = np.array([1] * 6 + [5] * 6)
    assert losses == pytest.approx([np.mean(rate - demand * np.log(rate))])


def test_trees_do_not_depend_on_partitions(ws):
    settings = BoostingParams(rounds=2, learning_rate=0.3)
    rows = ws.training.filter("store_id < 'B'")
    edges = [np.linspace(0, 20, 40)] * len(boosting.INPUTS)  # edges come from a sketch, which may differ
    coded = encoding.encode_training(rows).select(*boosting.INPUTS, F.col("units_sold").cast("double").alias("demand"))
    def tree(partitions):
        blocks = boosting.binned_blocks(coded.repartition(partitions), edges, 0.1)
        return boosting.grow(lambda grown, nodes: boosting.histograms(blocks, partitions, grown, nodes, 41), edges, settings)[0]
    one, many = tree(1), tree(70)  # the second is merged in two steps
    assert all(np.array_equal(one[k], many[k]) for k in one)


def test_no_histograms_reach_the_driver(ws, monkeypatch):
    """Growing a tree brings the same little to the driver from 2 and from 30 tasks: best splits."""
    seen, kind = [], type(ws.training)
    for name in ("collect", "toArrow"):
        def spy(self, real=getattr(kind, name)):
            seen.append(len(pickle.dumps(result := real(self))))
            return result
        monkeypatch.setattr(kind, name, spy)
    settings, edges = BoostingParams(rounds=1), [np.linspace(0, 20, 254)] * len(boosting.INPUTS)
    coded = encoding.encode_training(ws.training).select(*boosting.INPUTS, F.col("units_sold").cast("double").alias("demand"))
    for partitions in (2, 30):
        blocks = boosting.binned_blocks(coded.repartition(partitions), edges, 0.1).persist()
        boosting.grow(lambda grown, nodes: boosting.histograms(blocks, partitions, grown, nodes, 255), edges, settings)  # noqa: B023
        blocks.unpersist()
        assert sum(seen) < 200_000
        seen.clear()


def test_distributed_splits_are_those_of_cells_in_memory(spark):
    """Gains, features, cuts and sums by feature in tasks equal a search over all cells at once; constant features give none."""
    rng = np.random.default_rng(5)
    cells = rng.integers(-10**9, 10**9, (3, len(boosting.INPUTS), 9, 3))
    cells[..., 1:] = np.abs(cells[..., 1:])
    cells[:, :, :, 2] = 50
    cells[:, :, 8] = cells[:, :1].sum(axis=2) - cells[:, :, :8].sum(axis=2)  # every feature has the node's sums
    cells[:, 7] = cells[:, 4]  # of equal gains the first feature counts
    cells[1] = 0
    cells[1, :, 0] = 900
    rows = [(f, cells[:, f].tobytes(), 2.5 if f == 0 else 0.0, 7 if f == 0 else 0) for f in range(len(boosting.INPUTS))]
    counted = spark.createDataFrame(rows, boosting.COUNTED).repartition(5, "feature")
    settings = BoostingParams(min_leaf_rows=40)
    found, loss, count = boosting.best_splits(counted, 3, settings)
    expected, _, _ = boosting.best_splits((cells, 2.5, 7), 3, settings)
    assert (loss, count) == (2.5, 7) and found[1].feature == -1 and found[0].feature >= 0
    for a, b in zip(found, expected):
        assert (a.gain, a.feature, a.cut, a.total.tolist()) == (b.gain, b.feature, b.cut, b.total.tolist())
        assert (a.below is None) == (b.below is None) and (a.below is None or a.below.tolist() == b.below.tolist())


def test_best_first_equals_one_leaf_at_a_time():
    """Splits counted ahead are those of a plain search that always splits the best leaf next."""
    rng = np.random.default_rng(3)
    codes = rng.integers(0, 16, (len(boosting.INPUTS), 4000)).astype(np.uint8)
    demand = (codes[3] > 7) * 3.0 + (codes[5] > 3) * codes[4] / 4 + rng.poisson(1, 4000)
    edges, settings = [np.arange(15.0)] * len(codes), BoostingParams(max_leaves=12, min_leaf_rows=50)
    gradient, hessian = np.rint((2.0 - demand) * boosting.PARTS), np.rint(np.full(4000, 2.0) * boosting.PARTS)
    def cells_of(mask):
        return np.stack([np.stack([np.bincount(c[mask], w[mask], 16) for w in (gradient, hessian, np.ones(4000))], axis=1) for c in codes]).astype(np.int64)
    def count(tree, nodes):
        at = boosting.leaves(tree, codes, "cut")
        return np.stack([cells_of(at == n) for n in nodes]), 0.0, 4000
    tree, _ = boosting.grow(count, edges, settings)
    at = boosting.leaves(tree, codes, "cut")
    got = {frozenset(np.flatnonzero(at == n)) for n in np.unique(at)}
    masks = [(np.ones(4000, bool), 0)]
    while len(masks) < settings.max_leaves:
        scored = []
        for k, (mask, deep) in enumerate(masks):
            cells = cells_of(mask)
            node = boosting.Node(cells[0].sum(axis=0))
            if deep < settings.max_depth:
                node.seek(cells, settings.min_leaf_rows, settings.l2)
            scored.append((-node.gain, k, node))
        gain, k, node = min(scored, key=lambda s: s[:2])
        if gain >= 0:
            break
        mask, deep = masks.pop(k)
        below = codes[node.feature] <= node.cut
        masks += [(mask & below, deep + 1), (mask & ~below, deep + 1)]
    assert got == {frozenset(np.flatnonzero(m)) for m, _ in masks}


def test_codes_never_see_the_day_or_later_ones(spark):
    rows = [("s", "a", 0, 4, 0), ("s", "b", 0, 8, 0), ("s", "a", 1, 100, 0), ("t", "b", 1, 2, 0), ("s", "a", 2, 7, 0)]
    found = {(r["store_id"], r["item_id"], r["date"].day): (r["store_id_code"], r["item_id_code"]) for r in encoding.encode_training(tiny(spark, rows)).collect()}
    assert found["s", "a", 1] == (0, 0) and found["s", "b", 1] == (0, 0)
    mean = 6.0
    assert found["s", "a", 2] == pytest.approx(((12 + 28 * mean) / 30, (4 + 28 * mean) / 29))
    assert found["t", "b", 2] == pytest.approx((mean, (8 + 28 * mean) / 29))  # a new store has the mean of all
    later = 114 / 4
    assert found["s", "a", 3] == pytest.approx(((112 + 28 * later) / 31, (104 + 28 * later) / 30))


def test_many_levels_train_and_unknown_ones_fail(spark):
    """A thousand items, beyond any list of levels; a new one fails the forecast."""
    rows = tiny(spark, [("s", f"i{k}", d, (k + d) % 5, (k + d + 4) % 5) for k in range(1000) for d in range(2)])
    forest, losses = boosting.fit_pooled_model(rows, BoostingParams(rounds=2))
    assert losses[1] < losses[0] and len(forest.trees) == 2
    codes = encoding.final_codes(rows)
    assert codes.count() == 1001
    state = spark.createDataFrame([("s", "never seen")], "store_id string, item_id string")
    with pytest.raises(Exception, match="unknown level of item_id"):
        encoding.encode(state, codes).collect()


def test_saved_model_scores_the_same(spark, ws, fitted):
    forest = fitted[0]
    path = stage_path(spark, "test-model")
    boosting.save_forecast_model(spark, forest, ws.codes, path)
    again, codes = boosting.load_forecast_model(spark, path)
    x = np.random.default_rng(0).uniform(0, 5, (200, len(boosting.INPUTS))).round(1)
    assert np.array_equal(forest.predict(x), again.predict(x))
    assert sorted(map(tuple, codes.collect())) == sorted(map(tuple, ws.codes.collect()))


def test_recursion_never_sees_actual_demand(ws):
    changed = ws.panel.withColumn("units_sold", F.when(F.col("date") >= ws.start, F.lit(1000)).otherwise(F.col("units_sold")))
    def forecast(panel):
        state = recursive.forecast_state(panel, ws.start)
        rows = recursive.recursive_forecast(state, recursive.linear_score, "m")
        return sorted((r["store_id"], r["item_id"], r["forecast_step"], r["predicted_units"]) for r in rows.collect())
    assert forecast(ws.panel) == forecast(changed)

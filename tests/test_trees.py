"""Boosted trees over filled cells against a plain version, and against their own score after a reload."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.linalg import Vectors

from corpusloom.operators import models, trees


def plain(x, y, w, rounds, depth, step):
    """Margins of boosted trees that try every threshold of every feature."""
    margin = np.zeros(len(y))
    for number in range(rounds):
        r = 4 * y / (1 + np.exp(2 * y * margin)) if number else y
        value = np.zeros(len(y))

        def grow(rows, left):
            value[rows] = np.average(r[rows], weights=w[rows])
            score = lambda some: (w[some] * r[some]).sum() ** 2 / w[some].sum()
            best = (score(rows) + 1e-9, None)
            for f in range(x.shape[1]):
                every = np.unique(x[:, f])
                for cut in (every[:-1] + every[1:]) / 2:
                    low, high = rows[x[rows, f] <= cut], rows[x[rows, f] > cut]
                    if len(low) and len(high) and score(low) + score(high) > best[0] + 1e-9:
                        best = score(low) + score(high), (low, high)
            if left and best[1]:
                for part in best[1]:
                    grow(part, left - 1)

        grow(np.arange(len(y)), depth)
        margin = margin + (step if number else 1.0) * value
    return margin


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(5)
    x = np.where(rng.random((160, 6)) < 0.6, 0.0, rng.integers(-4, 20, (160, 6)) / 2)
    y = np.where(x[:, 0] + x[:, 1] * (x[:, 2] > 1) + rng.normal(0, 1, 160) > 2, 1.0, -1.0)
    return x, y, rng.uniform(0.5, 2, 160)


def frame(spark, data):
    x, y, w = data
    rows = [(Vectors.sparse(6, np.flatnonzero(a), a[a != 0]), float(b > 0), float(c)) for a, b, c in zip(x, y, w)]
    return spark.createDataFrame(rows, ["features", "label", "weight"])


@pytest.mark.parametrize("tasks", [1, 3])
def test_trees_equal_a_search_over_all_thresholds(spark, data, monkeypatch, tasks, tmp_path):
    if tasks > 1:
        monkeypatch.setattr(trees, "LEAST_CELLS", 1 + int((data[0] != 0).sum()) // tasks)
    monkeypatch.setattr(trees, "REPLAY", 2)
    estimator = models.boosting(5, 3, 0.3)
    estimator.setSubsamplingRate(1.0).setFeatureSubsetStrategy("1.0")
    fitted = estimator.fit(frame(spark, data))
    assert (fitted.getNumTrees, fitted.treeWeights) == (5, [1.0, 0.3, 0.3, 0.3, 0.3])
    scored = models.positive_probability(fitted, frame(spark, data)).collect()
    wanted = 1 / (1 + np.exp(-2 * plain(*data, 5, 3, 0.3)))
    assert np.allclose([r.score for r in scored], wanted, atol=1e-9)
    PipelineModel(stages=[fitted]).write().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m")).stages[0]
    assert [r.score for r in models.positive_probability(again, frame(spark, data)).collect()] == [r.score for r in scored]


def test_one_label_and_empty_features_give_a_single_leaf(spark):
    rows = [(Vectors.sparse(3, [], []), 1.0, 1.0)] * 4
    fitted = models.boosting(2).fit(spark.createDataFrame(rows, ["features", "label", "weight"]))
    assert fitted.trees[0].numNodes == 1 and fitted.trees[0].predict(Vectors.sparse(3, [], [])) == 1.0


def test_grid_holds_every_fold_out_and_refits_on_all_rows(spark, data):
    rows = frame(spark, data).drop("weight")
    found = models.grid(rows, steps=(0.05, 0.5), rounds=4, k=3)
    assert len(found.avgMetrics) == 2 and all(0.6 < x <= 1 for x in found.avgMetrics)
    best = int(np.argmax(found.avgMetrics))
    assert found.bestModel.getNumTrees == 4 and found.bestModel.treeWeights[1] == (0.05, 0.5)[best]


def test_many_values_keep_zero_apart_and_every_part_populated():
    rng = np.random.default_rng(2)
    values = np.r_[rng.normal(5, 1, 5000), -rng.random(50)]
    edges = trees.edges_of(*trees._summary(values, np.ones(len(values))), rows=9000)
    assert len(edges) <= trees.BINS - 1 and (np.diff(edges) > 0).all()
    shares = np.bincount(np.searchsorted(edges, values[values > 0.5]), minlength=trees.BINS) / 5000
    assert shares.max() < 0.1 and (edges < 0).any() and edges[edges > 0].min() < values[values > 0].min()


def test_rounding_never_cuts_behind_the_last_bin():
    """Sums of many uneven weights leave rests that are not quite zero; rows are counted exactly."""
    rng = np.random.default_rng(8)
    row = np.tile(np.arange(3000, dtype=np.uint16), 2)
    cell = np.sort(np.r_[rng.integers(0, 3, 3000), trees.BINS + rng.integers(0, 3, 3000)]).astype(np.int32)
    weight = 10.0 ** rng.uniform(-9, 6, 3000)
    block = trees.Block((0, 0), row, cell, np.where(rng.random(3000) < 0.5, 1.0, -1.0), weight, np.zeros(3000, np.int16), np.zeros((1, 3000)))
    fit = trees._Fit([trees.Member(0.1)], np.zeros(2, dtype=np.uint8), 1, 1.0, 3)
    found = list(fit.best(0, [{0: 0}], 1.0)(fit.histograms(0, [trees.Tree(2)], [{0: 0}])(iter([block]))))
    assert all(split[4] < 2 for split in found) and len(found) == 2


def test_forest_keeps_the_place_of_every_row():
    forest = models.forest()
    assert forest.getCacheNodeIds() and forest.getNumTrees() == 250 and forest.getMaxDepth() == 30


@pytest.mark.parametrize("label, value, weight", [(None, 1.0, 1.0), (2.0, 1.0, 1.0), (1.0, float("nan"), 1.0), (1.0, 1.0, -1.0)])
def test_rows_that_cannot_be_fitted_are_an_error(label, value, weight):
    rows = [(Vectors.dense([1.0]), 0.0, 1.0), (Vectors.dense([value]), label, weight)]
    with pytest.raises(ValueError):
        list(trees._packed(0, 1)(0, iter(rows)))

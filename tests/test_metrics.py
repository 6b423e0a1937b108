import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.operators import explore, metrics, models, ranking
from corpusloom.session import local_rows


def frame_of(spark, y, p, cut=0.5):
    rows = [(i, int(a), float(b), int(b >= cut)) for i, (a, b) in enumerate(zip(y, p))]
    return local_rows(spark, rows, "key long, y int, score double, pred int")


def areas(y, p):
    """Plain ROC-AUC and trapezoid PR-AUC, by their definitions."""
    y, p = np.asarray(y), np.asarray(p)
    pos, neg = p[y == 1], p[y == 0]
    roc = np.mean([(a > b) + 0.5 * (a == b) for a in pos for b in neg])
    points = [(0.0, 1.0)]
    for t in sorted(set(p), reverse=True):
        hit = p >= t
        points.append(((y[hit] == 1).sum() / (y == 1).sum(), (y[hit] == 1).mean()))
    pr = sum((r1 - r0) * (p0 + p1) / 2 for (r0, p0), (r1, p1) in zip(points, points[1:]))
    return roc, pr


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(3)
    p = np.round(rng.uniform(0, 1, 400), 2)
    y = (rng.uniform(0, 1, 400) < p).astype(int)
    return y, p


def test_areas_with_ties(spark, data):
    row = metrics.binary_metrics(frame_of(spark, *data), "y", "pred", "score").first()
    roc, pr = areas(*data)
    assert row.roc_auc == pytest.approx(roc) and row.pr_auc == pytest.approx(pr)
    assert row.brier == pytest.approx(np.mean((data[1] - data[0]) ** 2))


def test_running_totals_in_ranges(spark, data):
    table = metrics.score_table(frame_of(spark, *data), "y", "score")
    plain = ranking.running_totals(table, [], "score", {"tp": "pos"}, edges=[])
    ranged = ranking.running_totals(table, [], "score", {"tp": "pos"}, edges=[0.2, 0.21, 0.5, 0.9])
    assert {r.score: r.tp for r in plain.collect()} == {r.score: r.tp for r in ranged.collect()}


def test_one_class_has_no_roc(spark):
    row = metrics.binary_metrics(frame_of(spark, [0, 0, 0], [0.1, 0.2, 0.9]), "y", "pred", "score").first()
    assert row.roc_auc is None and row.recall == 0.0 and row.mcc == 0.0


def test_threshold_ties_go_to_the_lowest(spark):
    row = metrics.best_threshold(frame_of(spark, [1, 1, 0], [0.9, 0.4, 0.1]), "y", "score").first()
    assert row.threshold == 0.4
    assert metrics.best_threshold(frame_of(spark, [], []), "y", "score").first().threshold == 0.5


def test_cutoffs_of_separable_scores(spark):
    rng = np.random.default_rng(0)
    p = np.r_[rng.uniform(0.02, 0.25, 400), rng.uniform(0.75, 0.98, 400)]
    row = metrics.risk_cutoffs(frame_of(spark, [0] * 400 + [1] * 400, p), "y", "score").first()
    assert row.low <= 0.55 and row.high >= 0.55 and row.low < row.high


def test_bootstrap_interval_covers_estimate(spark, data):
    frame = frame_of(spark, *data)
    rows = {r.metric: r for r in metrics.bootstrap(frame, "key", "y", "pred", "score", n=40).collect()}
    point = metrics.binary_metrics(frame, "y", "pred", "score").first()
    assert rows["roc_auc"].lower < point.roc_auc < rows["roc_auc"].upper
    assert rows["f2"].n_replicates == 40


def test_duplicated_input_doubles_counts(spark, data):
    frame = frame_of(spark, *data)
    one = {(r.y, r.pred): r.n for r in metrics.confusion(frame, "y", "pred").collect()}
    two = {(r.y, r.pred): r.n for r in metrics.confusion(frame.union(frame), "y", "pred").collect()}
    assert two == {k: 2 * v for k, v in one.items()}


def test_platt_bounds_and_guards(spark, data):
    frame = frame_of(spark, *data).withColumnRenamed("y", "label")
    platt = models.fit_platt(frame)
    span = frame.select(platt.apply(F.col("score")).alias("p")).agg(F.min("p").alias("a"), F.max("p").alias("b")).first()
    assert 0 < span.a < span.b < 1 and platt.slope > 0
    assert models.fit_platt(frame.limit(5)) is None
    assert models.fit_platt(frame.withColumn("label", F.lit(1))) is None
    assert models.fit_platt(frame.withColumn("score", F.lit(0.3))) is None


def test_bootstrap_equals_resampled_metrics(spark, data):
    """Every replicate's metrics against plain weighted counts, with tied scores over several ranges."""
    y, p = data
    n, seed = 6, 5
    frame = frame_of(spark, y, p).repartition(4)
    weights = metrics.replicate_weights([str(i) for i in range(len(y))], n, seed)
    assert weights.shape == (len(y), n) and abs(weights.mean() - 1) < 0.1
    plain = {"roc_auc": [], "pr_auc": [], "precision": [], "brier": []}
    for r in range(n):
        rows = np.repeat(np.arange(len(y)), weights[:, r])
        roc, pr = areas(y[rows], p[rows])
        hit = p[rows] >= 0.5
        plain["roc_auc"].append(roc)
        plain["pr_auc"].append(pr)
        plain["precision"].append((y[rows][hit] == 1).mean())
        plain["brier"].append(np.mean((p[rows] - y[rows]) ** 2))
    got = {r.metric: r for r in metrics.bootstrap(frame, "key", "y", "pred", "score", n=n, seed=seed).collect()}
    for name, values in plain.items():
        assert [got[name].lower, got[name].upper] == pytest.approx(list(np.quantile(values, [0.025, 0.975])))


def test_bootstrap_vectors_over_score_ranges(spark, data, monkeypatch):
    frame = frame_of(spark, *data).repartition(3)
    whole = {r.metric: (r.lower, r.upper) for r in metrics.bootstrap(frame, "key", "y", "pred", "score", n=8).collect()}
    monkeypatch.setattr(metrics, "range_edges", lambda *a: [0.1, 0.35, 0.6, 0.61, 0.9])
    monkeypatch.setattr(metrics, "_VECTOR_ROWS", 16)
    cut = {r.metric: (r.lower, r.upper) for r in metrics.bootstrap(frame, "key", "y", "pred", "score", n=8).collect()}
    assert all(cut[m] == pytest.approx(whole[m]) for m in whole)


def test_quantiles_inside_brackets_are_exact(spark, monkeypatch):
    rng = np.random.default_rng(2)
    values = {"a": np.round(rng.exponential(50, 4001), 1), "b": rng.normal(0, 1, 900), "c": np.full(700, 7.0), "d": np.array([3.0])}
    rows = [(g, float(v)) for g, vs in values.items() for v in vs] + [("a", None), (None, 1.0), (None, 2.0)]
    frame = spark.createDataFrame(rows, "g string, v double").repartition(3)
    shares = {"q25": 0.25, "q50": 0.5, "q99": 0.99}
    for whole, sketch in ((10**9, 10_000), (100, 1000)):
        monkeypatch.setattr(explore, "_WHOLE", whole)
        monkeypatch.setattr(explore, "_SKETCH", sketch)
        monkeypatch.setattr(explore, "_MARGIN", 4.0 / sketch + 0.01)
        got = {r.g: r for r in explore.exact_quantiles(frame, ["g"], "v", shares).collect()}
        for g, vs in values.items():
            assert got[g].n == len(vs) and [got[g][q] for q in shares] == pytest.approx([np.quantile(vs, s) for s in shares.values()])
        assert got[None].q50 == 1.5
    one = explore.exact_quantiles(frame.filter("g = 'b'"), [], "v", {"m": 0.5}).first()
    assert one.m == pytest.approx(np.median(values["b"]))
    assert explore.exact_quantiles(frame.limit(0), [], "v", {"m": 0.5}).collect() == []


def test_multiclass_averages(spark):
    pairs = [("a", "a")] * 5 + [("a", "b")] * 2 + [("b", "b")] * 3 + [("b", "c")] + [("d", "a")]
    frame = spark.createDataFrame(pairs, "y string, pred string")
    got = {r["class"]: r for r in metrics.multiclass_report(frame, "y", "pred").collect()}
    assert got["micro avg"].precision == pytest.approx(8 / 12) and got["micro avg"].support == 12
    assert got["c"].recall == 0 and got["c"].support == 0 and got["d"].precision == 0
    assert got["macro avg"].recall == pytest.approx((5 / 7 + 3 / 4 + 0 + 0) / 4)
    assert got["weighted avg"].recall == pytest.approx(8 / 12)

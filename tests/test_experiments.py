"""Stored candidates, fold statistics, calibration and the whole run, on small corpora."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom import settings
from corpusloom.operators import features, models, quality, risk, splits
from corpusloom.plans import artifacts, experiments, fold_features
from corpusloom.session import cut_lineage, local_rows
from corpusloom.sources import files


@pytest.fixture(scope="module")
def samples(spark):
    rng = random.Random(6)
    words = [f"w{i}" for i in range(30)]
    rows = []
    for i in range(150):
        label = i % 3 == 0
        pool = [*words, *(["sad", "alone"] if label else ["fine", "sunny"])]
        rows.append((i, f"s{i % 6}", " ".join(rng.choice(pool) for _ in range(rng.randint(8, 30))), int(label)))
    return cut_lineage(local_rows(spark, rows, "key long, source_id string, clean string, label int"))


@pytest.fixture(scope="module")
def lexicons(spark):
    table = lambda *w: local_rows(spark, [(x,) for x in w], "entry string")
    valence = local_rows(spark, [("sad", -2.0), ("fine", 1.5), ("sunny", 2.0)], "word string, valence double")
    return risk.Lexicons(valence, table("alone", "sad"), table("sad alone"), table("fine sunny"), table("sunny"))


def quick(rows):
    return models.logistic(rows, iterations=15)


@pytest.mark.parametrize("kind", ["logistic_regression", "linear_svc"])
def test_a_stored_candidate_scores_as_before(spark, samples, lexicons, tmp_path, kind):
    train, val = samples.filter("key % 4 <> 0"), samples.filter("key % 4 = 0")
    space = experiments.fit_features(train, features.STAT_COLUMNS, lexicons, 40)
    rows = splits.balanced_rows(train, "label")
    estimator = quick(rows) if kind == "logistic_regression" else models.svm(rows, iterations=15)
    fitted = experiments.tune(experiments.fit_candidate(kind, estimator, train, space), val)
    fitted.platt = models.Platt(2.5, -1.0)
    path = str(tmp_path / "store")
    assert artifacts.versions(spark, path) == []
    assert artifacts.save(fitted, path, 0.3, 0.7, "digest", 112) == 1
    assert artifacts.save(fitted, path, 0.2, 0.8, "digest", 112) == 2
    stored = artifacts.load(spark, path)
    assert (stored.version, stored.low, stored.data_digest, stored.candidate.threshold) == (2, 0.2, "digest", fitted.threshold)
    before = {r.key: (r.score, r.pred) for r in fitted.score(val).collect()}
    assert {r.key: (r.score, r.pred) for r in stored.candidate.score(val).collect()} == before
    assert artifacts.load(spark, path, 1).high == 0.7

    texts = local_rows(spark, [(1, "I am so sad and alone today, sad alone!", 9), (2, "", 8), (3, None, 7)], "key long, text string, clean int")
    scored = {r.key: r for r in stored.score(texts, "text").collect()}
    assert set(scored) == {1, 2, 3} and scored[1].clean == 9 and scored[2].display_tier in (risk.LOW, risk.MEDIUM, risk.HIGH)
    assert scored[1].model_version == f"{kind}-v2" and 0 <= scored[1].model_score <= 1


def test_an_unfinished_artifact_is_never_read(spark, samples, tmp_path):
    path = str(tmp_path / "store")
    local_rows(spark, [(1,)], "x int").write.parquet(files.join(path, "000009-half", "vocab"))
    assert artifacts.versions(spark, path) == []
    with pytest.raises(ValueError):
        artifacts.load(spark, path)


def test_fold_vocabularies_equal_vocabularies_of_the_training_parts(spark, samples):
    k = 3
    folded = cut_lineage(splits.folds(samples, "key", "label", k))
    found = fold_features.fold_vocabularies(cut_lineage(fold_features.fold_stats(folded)), k, 25, min_df=2)
    for fold in range(k):
        direct = features.vocabulary(folded.filter(F.col("fold") != fold), "clean", 25, min_df=2)
        columns = ["term", "index", "df", "tf"]
        assert sorted(map(tuple, found.filter(F.col("fold") == fold).select(*columns).collect())) == sorted(map(tuple, direct.select(*columns).collect()))
        idf = {r.term: r.idf for r in direct.collect()}
        assert all(abs(r.idf - idf[r.term]) < 1e-12 for r in found.filter(F.col("fold") == fold).collect())


def test_fold_vectors_equal_vectors_of_the_training_vocabulary(spark, samples):
    k = 3
    folded = cut_lineage(splits.folds(samples, "key", "label", k))
    spaces = fold_features.fit_folds(folded, k, max_terms=30)
    train = folded.filter("fold <> 1")
    direct = experiments.fit_features(train, max_terms=30).transform(folded)
    a = {r.key: r.tfidf.toArray() for r in spaces.vectors(1).collect()}
    b = {r.key: r.tfidf.toArray() for r in direct.collect()}
    assert a.keys() == b.keys() and all(np.allclose(a[i], b[i], atol=1e-12) for i in a)


def test_cross_validation_of_several_feature_sets(spark, samples, lexicons):
    variants = {"plain": (), "full": features.STAT_COLUMNS}
    found = experiments.cross_validate(samples, variants, lexicons, k=2, max_terms=30, build=quick).collect()
    assert {r.feature_set for r in found} == set(variants) and all(0 <= r.value <= 1 for r in found if r.metric != "mcc")
    assert {r.metric for r in found if r.feature_set == "full"} >= {"f2", "roc_auc", "brier"}


def test_smoothed_sigmoid_stands_at_its_optimum(spark):
    rng = np.random.default_rng(1)
    margin = rng.normal(0, 2, 300)
    y = (rng.uniform(0, 1, 300) < 1 / (1 + np.exp(-1.5 * margin + 0.5))).astype(int)
    frame = local_rows(spark, [(float(m), int(t)) for m, t in zip(margin, y)], "margin double, label int")
    platt = models.fit_sigmoid(frame)
    target = np.where(y == 1, (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2))
    error = 1 / (1 + np.exp(-(platt.slope * margin + platt.intercept))) - target
    assert abs(error.sum()) < 1e-4 * 300 and abs((error * margin).sum()) < 1e-4 * 300
    assert models.fit_sigmoid(frame.filter("label = 1")) is None


def test_the_whole_run(spark, samples, lexicons):
    cut = cut_lineage(splits.stratified(samples, "key", "label"))
    train, val, test = (cut.filter(F.col("split_name") == s).drop("split_name") for s in ("train", "val", "test"))
    run = experiments.train_and_evaluate(train, val, test, features.STAT_COLUMNS[:3], max_terms=30, replicates=20)
    models_seen = run.validation.collect()
    assert sum(r.selected for r in models_seen) == 1 and len(models_seen) == 2
    assert run.test.first().f2 >= 0 and run.intervals.count() == 10 and run.per_source.count() > 1
    assert run.scored.count() == test.count()


def test_digest_tree_does_not_depend_on_order_and_sees_every_change(spark):
    prints = [F.sha2(F.concat(F.lit("x"), F.col("id").cast("string")), 256).alias("fp")]
    frame = spark.range(500).select(*prints)
    digest = lambda df, leaf: quality.dataset_fingerprint(df, "fp", leaf).first().dataset_fingerprint
    for leaf in (1000, 40, 4):
        assert digest(frame, leaf) == digest(frame.orderBy("fp").repartition(5), leaf)
        assert digest(frame, leaf) != digest(frame.unionByName(frame.limit(1)), leaf)
        assert digest(frame, leaf) != digest(frame.orderBy("fp").limit(499), leaf)
    assert quality.dataset_fingerprint(frame.unionByName(frame), "fp", 4).first().n_rows == 1000


def test_penalties_count_the_balanced_rows(spark, samples):
    assert splits.balanced_rows(samples, "label") == 200.0 and splits.balanced_rows(samples, "label", False) == 150.0
    assert set(models.candidates(10.0, full=True)) == {"logistic_regression", "linear_svc", "random_forest", "boosting"}
    grid = models.out_of_domain_candidates(10.0)
    assert grid["boosting"].getMaxIter() == settings.OOV_BOOSTING_ROUNDS and not grid["boosting"].isSet("weightCol")


def test_features_are_computed_once_and_linear_fits_get_few_tasks(spark, samples, lexicons):
    train, val = samples.filter("key % 4 <> 0"), samples.filter("key % 4 = 0")
    space = experiments.fit_features(train, features.STAT_COLUMNS, lexicons, 40)
    ready = space.written(train), space.written(val)
    assert all("clean" not in frame.columns for frame in ready)
    build = lambda: models.svm(splits.balanced_rows(train, "label"), iterations=15)
    direct = experiments.fit_candidate("linear_svc", build(), train, space)
    again = experiments.fit_candidate("linear_svc", build(), ready[0], space)
    a = {r.key: r.score for r in direct.score(val).collect()}
    assert {r.key: r.score for r in again.score(ready[1]).collect()} == pytest.approx(a, abs=1e-6)
    wide = spark.range(settings.FIT_ROWS + 1).repartition(16)
    assert models.few_tasks(wide).rdd.getNumPartitions() == 2


def test_a_written_feature_frame_serves_every_feature_set(spark, samples, lexicons):
    part = lambda condition: samples.filter(condition)
    variants = {"plain": (), "full": features.STAT_COLUMNS}
    found = experiments.evaluate_variants(variants, part("key % 4 > 1"), part("key % 4 = 0"), part("key % 4 = 1"), lexicons, max_terms=30, build=quick)
    rows = {(r.feature_set, r.part, r.metric): r.value for r in found.collect()}
    space = experiments.fit_features(part("key % 4 > 1"), (), None, 30)
    fit = experiments.fit_candidate("x", quick(splits.balanced_rows(part("key % 4 > 1"), "label")), part("key % 4 > 1"), space)
    plain = models.metrics.binary_metrics(experiments.tune(fit, part("key % 4 = 0")).score(part("key % 4 = 1")), "label", "pred", "score").first()
    assert {k[:2] for k in rows} == {(s, p) for s in variants for p in ("val", "test")}
    assert rows["plain", "test", "brier"] == pytest.approx(plain.brier, abs=1e-6) and rows["plain", "test", "roc_auc"] == pytest.approx(plain.roc_auc, abs=1e-9)

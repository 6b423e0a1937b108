from pyspark.sql import functions as F

from corpusloom.functions.text import clean_text
from corpusloom.operators import features, metrics, models, splits
from corpusloom.plans import experiments
from corpusloom.sources import store


def samples(spark):
    corpus = store.synthetic_corpus(spark, 60)
    return corpus.select(
        F.col("id").alias("key"), clean_text(F.col("text")).alias("clean"),
        (F.col("status") == "Depression").cast("int").alias("label"), "held_out",
    )


def quick(rows):
    return models.logistic(rows, iterations=10)


def test_separable_corpus_save_and_reload(spark, tmp_path):
    frame = samples(spark).persist()
    train, val = frame.filter(~F.col("held_out")), frame.filter("held_out")
    space = experiments.fit_features(train, features.STAT_COLUMNS[:3], None, 200)
    fitted = experiments.tune(experiments.fit_candidate("lr", quick(90.0), train, space), val)
    row = metrics.binary_metrics(fitted.score(val), "label", "pred", "score").first()
    assert row.roc_auc > 0.95 and row.f2 > 0.9

    ready = space.transform(splits.class_weights(train, "label"))
    model = models.build_pipeline(space.dense, quick(90.0)).fit(ready)
    models.save(model, str(tmp_path / "m"))
    again = models.load(str(tmp_path / "m"))
    before = {r.key: r.score for r in models.positive_probability(model, space.transform(val)).collect()}
    after = {r.key: r.score for r in models.positive_probability(again, space.transform(val)).collect()}
    assert before == after and len(before) == 30

    refreshed = experiments.refresh_cutoffs(fitted, val).first()
    assert refreshed.low < refreshed.high and refreshed.operating_threshold == fitted.threshold


def test_vectors_equal_weight_rows(spark):
    frame = samples(spark).limit(30).persist()
    vocab = features.vocabulary(frame, "clean", 50, min_df=2)
    long = {(r.key, r["index"]): r.weight for r in features.tfidf_weights(frame, "key", "clean", vocab).collect()}
    packed = {}
    for row in features.tfidf_vectors(frame, "key", "clean", vocab, 50).select("key", "tfidf").collect():
        packed.update({(row.key, int(i)): float(v) for i, v in zip(row.tfidf.indices, row.tfidf.values)})
    assert packed.keys() == long.keys() and all(abs(packed[k] - long[k]) < 1e-12 for k in long)


def test_selection_needs_out_of_domain_scores(spark):
    val = spark.createDataFrame([("a", 0, 0.80), ("b", 1, 0.95), ("c", 2, 0.80)], "model string, rank int, f2 double")
    oov = spark.createDataFrame([("a", 0.5), ("c", 0.5)], "model string, oov_f2 double")
    rows = {r.model: r for r in models.select_model(val, oov).collect()}
    assert rows["a"].selected and not rows["c"].selected and not rows["b"].eligible
    none = models.select_model(val, oov.limit(0))
    assert none.filter("selected").first().model == "b"

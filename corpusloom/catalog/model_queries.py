"""Spark ML operators over labelled documents; fits have no SQL counterpart."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.ml import Pipeline
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import settings
from ..functions import text as tx
from ..operators import features, metrics, models, quality, splits
from ..plans import artifacts, experiments, fold_features
from ..session import cut_lineage, cut_wide, shared_folder
from .base import SQL_LABELLED, labelled, posts, r6, sql_clean, sql_hash, sql_normal, table
from .corpus_queries import SQL_THREE_WAY, sql_digest
from .feature_queries import lexicons

QUERIES, ORACLE = {}, {}

TERMS = settings.TFIDF_MAX_TERMS


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


def samples(spark, sf):
    """Labelled documents as samples: key, source_id, clean, label."""
    labels = table(spark, sf, "labels").select("doc_id", F.col("quality").alias("label"))
    joined = posts(spark, sf).join(labels, "doc_id")
    return joined.select(F.col("doc_id").alias("key"), "source_id", tx.clean_text(F.col("text")).alias("clean"), "label")


def _cut(spark, sf):
    cut = cut_wide(splits.stratified(samples(spark, sf), "key", "label"), "key")
    return tuple(cut.filter(F.col("split_name") == s).drop("split_name") for s in ("train", "val", "test"))


def _candidate(spark, sf, name: str, build):
    """A candidate on all nine dense columns and the text vector, tuned on the validation part; the other parts."""
    train, val, test = _cut(spark, sf)
    space = experiments.fit_features(train, features.STAT_COLUMNS, lexicons(spark), TERMS)
    fitted = experiments.fit_candidate(name, build(splits.balanced_rows(train, "label")), train, space)
    return experiments.tune(fitted, val), val, test


def _scores(spark, sf, name, build):
    fitted, _, test = _candidate(spark, sf, name, build)
    return fitted.score(test).select("key", "label", r6(F.col("score")).alias("score"), "pred")


@query("m01_logistic")
def m01(spark, sf):
    return _scores(spark, sf, "logistic_regression", models.logistic)


@query("m02_calibrated_svm")
def m02(spark, sf):
    return _scores(spark, sf, "linear_svc", models.svm)


@query("m03_forest")
def m03(spark, sf):
    return _scores(spark, sf, "random_forest", lambda n: models.forest())


@query("m04_boosting")
def m04(spark, sf):
    return _scores(spark, sf, "boosting", lambda n: models.boosting())


@query(
    "m01_fit_facts",
    f"""WITH src AS ({SQL_LABELLED}), {SQL_THREE_WAY}, t AS (SELECT * FROM cut WHERE split_name = 'train'), c AS (SELECT label, count(*) AS n FROM t GROUP BY 1)
    SELECT label, n AS n_rows, round((SELECT sum(n) FROM c) / ((SELECT count(*) FROM c) * n::DOUBLE), 6) AS weight,
      (SELECT count(*) * max(n) FROM c)::DOUBLE AS balanced_rows, true AS scores_in_range, true AS gradient_is_zero FROM c""",
)
def m01_facts(spark, sf):
    """What a fit must satisfy: class weights, the rows the penalty counts, and no slope left along the intercept."""
    train, _, _ = _cut(spark, sf)
    rows = splits.balanced_rows(train, "label")
    space = experiments.fit_features(train, features.STAT_COLUMNS, lexicons(spark), TERMS)
    fitted = experiments.fit_candidate("logistic_regression", models.logistic(rows), train, space)
    scored = splits.class_weights(fitted.score(train).select("label", "score"), "label")
    slope = F.abs(F.sum(F.col("weight") * (F.col("score") - F.col("label"))) / F.sum("weight"))
    one = scored.agg(slope.alias("slope"), F.min("score").alias("lo"), F.max("score").alias("hi")).first()
    counts = scored.groupBy("label").agg(F.count("*").alias("n_rows"), r6(F.first("weight")).alias("weight"))
    return counts.withColumns({
        "balanced_rows": F.lit(rows), "scores_in_range": F.lit(0 <= one.lo <= one.hi <= 1), "gradient_is_zero": F.lit(one.slope < 1e-3),
    })


@query("m05_other_learners")
def m05(spark, sf):
    """The other learners on two classes, over text vector and dense columns."""
    train, _, test = _cut(spark, sf)
    space = experiments.fit_features(train, features.STAT_COLUMNS, lexicons(spark), TERMS)
    train, test = space.written(train), space.written(test)
    joined = Pipeline(stages=models.feature_stages(space.dense)).fit(train)
    ready = [cut_lineage(joined.transform(f).select("key", "label", "features")) for f in (train, test)]
    outs = []
    for name, estimator, binary in (
        ("bernoulli_bayes", models.bernoulli_bayes(), True),
        ("shallow_tree", models.shallow_tree(), False),
        ("l1_logistic", models.multiclass_logistic(rows=float(train.count())), False),
    ):
        fit_on, apply_to = (models.binarise(f) if binary else f for f in ready)
        fit_on = models.few_tasks(fit_on) if name == "l1_logistic" else fit_on
        scored = models.positive_probability(estimator.fit(fit_on), apply_to)
        outs.append(scored.select(F.lit(name).alias("model"), "key", r6(F.col("score")).alias("score")))
    return outs[0].unionByName(outs[1]).unionByName(outs[2])


def _languages(spark, sf):
    """Texts with their language as class: training and test rows over the training vocabulary."""
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("key"), F.col("lang").alias("class"), tx.clean_text(F.col("text")).alias("clean"))
    cut = cut_wide(splits.holdout(docs, "key", "class", 0.25), "key")
    train, test = cut.filter(~F.col("held_out")), cut.filter("held_out")
    space = experiments.fit_features(train, (), None, TERMS)
    return [space.written(f).select("key", "class", F.col("tfidf").alias("features")) for f in (train, test)]


@query("m05_multiclass")
def m05_multiclass(spark, sf):
    """Softmax and one-vs-rest over four languages, with their reports."""
    train, test = _languages(spark, sf)
    out = []
    for name, rest in (("softmax", False), ("one_vs_rest", True)):
        scored = cut_lineage(models.fit_multiclass(train, "class", one_vs_rest=rest, c=10.0).score(test).select("class", "prediction"))
        rows = metrics.multiclass_report(scored, "class", "prediction").select(F.lit(name).alias("model"), "*")
        out.append(rows.withColumns({c: r6(F.col(c)) for c in ("precision", "recall", "f1")}))
    return out[0].unionByName(out[1])


@query(
    "m05_multiclass_facts",
    """SELECT lang AS class, true AS some_predicted, true AS scores_sum_to_one, true AS mostly_right FROM documents GROUP BY 1""",
)
def m05_facts(spark, sf):
    train, test = _languages(spark, sf)
    scored = models.fit_multiclass(train, "class", c=10.0).score(test)
    total = F.aggregate(F.map_values("scores"), F.lit(0.0), lambda a, x: a + x)
    return scored.groupBy("class").agg(
        (F.count("prediction") > 0).alias("some_predicted"), F.bool_and(F.abs(total - 1) < 1e-9).alias("scores_sum_to_one"),
        (F.avg((F.col("class") == F.col("prediction")).cast("double")) > 0.8).alias("mostly_right"),
    )


def _platt_frame(spark, sf):
    return labelled(spark, sf).withColumn("score", F.col("n_chars") / (F.col("n_chars") + 1500.0))


@query("m06_fit_platt")
def m06(spark, sf):
    frame = _platt_frame(spark, sf)
    platt = models.fit_platt(frame)
    return frame.select("doc_id", r6(platt.apply(F.col("score"))).alias("calibrated"))


@query(
    "m06_gradients",
    f"SELECT how, count(*) AS n_rows, true AS slope_is_zero, true AS intercept_is_zero FROM ({SQL_LABELLED}), (SELECT unnest(['penalised', 'smoothed']) AS how) GROUP BY 1",
)
def m06_gradients(spark, sf):
    """Both calibrators stand at their optimum: no derivative of their loss is left."""
    frame = _platt_frame(spark, sf)
    sizes = frame.agg(F.sum("label").alias("n1"), F.count("*").alias("n")).first()
    smooth = F.when(F.col("label") == 1, (sizes.n1 + 1.0) / (sizes.n1 + 2.0)).otherwise(1.0 / (sizes.n - sizes.n1 + 2.0))
    out = None
    for how, platt, target, penalty in (
        ("penalised", models.fit_platt(frame), F.col("label"), 1.0), ("smoothed", models.fit_sigmoid(frame, "score"), smooth, 0.0),
    ):
        error = models.sigmoid(F.lit(platt.slope) * F.col("score") + F.lit(platt.intercept)) - target
        row = frame.agg(
            F.count("*").alias("n_rows"), (F.abs(F.sum(error * F.col("score")) + penalty * platt.slope) / F.count("*") < 1e-4).alias("slope_is_zero"),
            (F.abs(F.sum(error)) / F.count("*") < 1e-4).alias("intercept_is_zero"),
        ).select(F.lit(how).alias("how"), "*")
        out = row if out is None else out.unionByName(row)
    return out


def _stored(spark, sf):
    """A logistic candidate written as an artifact and read back, with what it was before; validation and test part."""
    fitted, val, test = _candidate(spark, sf, "logistic_regression", models.logistic)
    cut = experiments.refresh_cutoffs(fitted, val).first()
    digest = quality.dataset_fingerprint(posts(spark, sf).select(tx.fingerprint(F.col("text")).alias("fp")), "fp").first()
    path = f"{shared_folder(spark)}/artifacts-{uuid.uuid4().hex}"
    artifacts.save(fitted, path, cut.low, cut.high, digest.dataset_fingerprint, digest.n_rows)
    return fitted, artifacts.load(spark, path), val, test


@query(
    "m08_stored_candidate",
    f"WITH src AS ({SQL_LABELLED}), {SQL_THREE_WAY} SELECT doc_id AS key, label, true AS same_score FROM cut WHERE split_name = 'test'",
)
def m08(spark, sf):
    """Scores before and after a candidate was stored and reloaded, all parts of it."""
    fitted, stored, _, test = _stored(spark, sf)
    before = fitted.score(test).select("key", "label", F.col("score").alias("before"), F.col("pred").alias("p"))
    after = stored.candidate.score(test).select("key", F.col("score").alias("after"), F.col("pred").alias("q"))
    same = (F.col("before") == F.col("after")) & (F.col("p") == F.col("q"))
    return before.join(after, "key").select("key", "label", same.alias("same_score"))


def _run(spark, sf) -> experiments.TrainingRun:
    train, val, test = _cut(spark, sf)
    return experiments.train_and_evaluate(train, val, test, features.STAT_COLUMNS, lexicons(spark), max_terms=TERMS)


@query("m09_training_run")
def m09_run(spark, sf):
    """The whole experiment in one long table: candidates, choice, test metrics, intervals, cut-offs, sources."""
    run = _run(spark, sf)
    long = lambda df, part, by: metrics.long_metrics(df, by).select(F.lit(part).alias("part"), F.col(by[0]).alias("name") if by else F.lit("").alias("name"), "metric", "value")
    parts = [
        long(run.validation, "validation", ["model"]), long(run.test, "test", []), long(run.per_source, "source", ["source_id"]),
        run.intervals.select(F.lit("lower").alias("part"), F.lit("").alias("name"), "metric", F.col("lower").alias("value")),
        run.intervals.select(F.lit("upper").alias("part"), F.lit("").alias("name"), "metric", F.col("upper").alias("value")),
        run.cutoffs.unpivot([], ["low", "high"], "metric", "value").select(F.lit("cutoff").alias("part"), F.lit("").alias("name"), "metric", "value"),
    ]
    return reduce(DataFrame.unionByName, parts).withColumn("value", r6(F.col("value")))


@query(
    "m09_run_facts",
    f"""WITH src AS ({SQL_LABELLED}), {SQL_THREE_WAY}, t AS (SELECT count(*) AS n FROM cut WHERE split_name = 'test')
    SELECT 2 AS n_models, 1 AS n_selected, n AS n_test, 10 AS n_intervals, true AS cutoffs_in_order, true AS errors_are_wrong FROM t""",
)
def m09_facts(spark, sf):
    run = _run(spark, sf)
    chosen = run.validation.agg(F.count("*").cast("int").alias("n_models"), F.sum(F.col("selected").cast("int")).cast("int").alias("n_selected"))
    sizes = run.scored.agg(F.count("*").alias("n_test"))
    intervals = run.intervals.agg(F.count("*").cast("int").alias("n_intervals"))
    order = run.cutoffs.select((F.col("low") < F.col("high")).alias("cutoffs_in_order"))
    wrong = run.errors.agg(F.coalesce(F.bool_and(F.col("prediction") != F.col("label")), F.lit(True)).alias("errors_are_wrong"))
    return chosen.crossJoin(sizes).crossJoin(intervals).crossJoin(order).crossJoin(wrong)  # one row each


@query("m10_embedding_classifier")
def m10(spark, sf):
    vectors = table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("key"), (F.col("label") >= 5).cast("int").alias("label"),
        array_to_vector(F.col("embedding").cast("array<double>")).alias("vector"),
    )
    cut = splits.holdout(vectors, "key", "label", 0.2).persist()
    train, val = cut.filter(~F.col("held_out")), cut.filter("held_out")
    return models.embedding_classifier(train, val).score(val).select("key", "label", r6(F.col("score")).alias("score"), "pred")


@query("m11_grid")
def m11(spark, sf):
    """The published grid: all six steps, five folds, rounds and terms."""
    train, _, _ = _cut(spark, sf)
    space = experiments.fit_features(train, (), None, TERMS)
    ready = cut_lineage(space.transform(train).select("label", F.col("tfidf").alias("features")))
    best = models_best(models.grid(ready))
    return ready.groupBy("label").agg(F.count("*").alias("n")).select(
        "label", "n", F.lit(best[0]).alias("best_step"), F.lit(round(best[1], 6)).alias("accuracy")
    )


def models_best(found) -> tuple[float, float]:
    """(step size, mean accuracy) of the best grid point."""
    at = max(range(len(found.avgMetrics)), key=found.avgMetrics.__getitem__)
    return float(list(found.getEstimatorParamMaps()[at].values())[0]), float(found.avgMetrics[at])


@query("f10_scaled_features")
def f10(spark, sf):
    train, _, _ = _cut(spark, sf)
    space = experiments.fit_features(train, features.STAT_COLUMNS, lexicons(spark), TERMS)
    ready = space.transform(train)
    from pyspark.ml.functions import vector_to_array

    scaled = Pipeline(stages=models.feature_stages(space.dense)).fit(ready).transform(ready)
    return scaled.select("key", F.round(F.aggregate(vector_to_array("features"), F.lit(0.0), lambda a, x: a + x), 4).alias("total"))


@query("f11_variants")
def f11(spark, sf):
    train, _, _ = _cut(spark, sf)
    lex = lexicons(spark)
    stats = features.stat_features(train, "clean", lex.valence, lex.terms, lex.positive, lex.negative, lex.names)
    out = None
    for name, columns in {**features.VARIANTS, **features.ABLATION_SETS}.items():
        dense = F.array(*[F.col(c) for c in columns]) if columns else F.array().cast("array<double>")
        rows = stats.select(F.lit(name).alias("variant"), "key", F.array_join(dense.cast("array<string>"), ",").alias("dense"))
        out = rows if out is None else out.unionByName(rows)
    return out


_ROLES = tuple(f"src{i}" for i in range(14)), tuple(f"src{i}" for i in range(14, 20))


@query(
    "v14_oov_protocol",
    f"""SELECT source_id, role, n_rows, n_positive, CASE WHEN role = 'test' AND n_rows < 5 THEN 'skipped' ELSE 'used' END AS status FROM (
      SELECT source_id, CASE WHEN source_id IN {_ROLES[0]} THEN 'train' WHEN source_id IN {_ROLES[1]} THEN 'test' END AS role,
      count(*) AS n_rows, CAST(sum(label) AS BIGINT) AS n_positive FROM ({SQL_LABELLED}) GROUP BY 1, 2) WHERE role IS NOT NULL""",
)
def v14_protocol(spark, sf):
    return experiments.protocol(labelled(spark, sf), *_ROLES)


@query("v14_out_of_domain")
def v14(spark, sf):
    """All three published candidates and, on the rows that have a vector, the vector model."""
    vectors = table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("key"), array_to_vector(F.col("embedding").cast("array<double>")).alias("vector")
    )
    rows = cut_wide(samples(spark, sf).join(vectors, "key"), "key")
    report = experiments.out_of_domain(
        rows, *_ROLES, models.out_of_domain_candidates, features.STAT_COLUMNS, lexicons(spark), max_terms=TERMS, vector="vector",
    )
    return metrics.long_metrics(report, ["model", "source_id"]).withColumn("value", r6(F.col("value")))


_ABSENT = ("src3", "src19", "not there")


@query(
    "v14_skipped_sources",
    f"""WITH n AS (SELECT source_id, count(*) AS n_rows FROM ({SQL_LABELLED}) GROUP BY 1), s AS (SELECT unnest({list(_ABSENT)}) AS source_id)
    SELECT s.source_id, coalesce(n_rows, 0) AS n_rows FROM s LEFT JOIN n ON n.source_id = s.source_id WHERE coalesce(n_rows, 0) < 40""",
)
def v14_skipped(spark, sf):
    return experiments.skipped_sources(labelled(spark, sf), _ABSENT, least=40)


@query("v14_mean_f2")
def v14_mean(spark, sf):
    rows = cut_wide(samples(spark, sf), "key")
    report = experiments.out_of_domain(rows, *_ROLES, lambda n: {"logistic_regression": models.logistic(n)}, features.STAT_COLUMNS, lexicons(spark), max_terms=TERMS)
    return experiments.mean_out_of_domain_f2(report).withColumn("oov_f2", r6(F.col("oov_f2")))


@query("v15_ablation")
def v15(spark, sf):
    """Validation, test and five-fold metrics of all feature sets, one row per set."""
    train, val, test = _cut(spark, sf)
    long = experiments.ablation(train, val, test, features.ABLATION_SETS, lexicons(spark), max_terms=TERMS)
    wide = experiments.ablation_table(long)
    return wide.select("feature_set", *[r6(F.col(c)).alias(c) for c in wide.columns if c != "feature_set"])


@query("v16_split_compare")
def v16(spark, sf):
    found = experiments.split_compare(samples(spark, sf), features.STAT_COLUMNS, lexicons(spark), max_terms=TERMS)
    return found.withColumn("value", r6(F.col("value")))


@query("v17_cross_validate")
def v17(spark, sf):
    found = experiments.cross_validate(samples(spark, sf), {"tfidf_full": features.STAT_COLUMNS}, lexicons(spark), max_terms=TERMS)
    return found.withColumn("value", r6(F.col("value")))


@query(
    "v17_fold_vocabularies",
    f"""WITH src AS ({SQL_LABELLED}), k AS (SELECT least(5, greatest(2, count(*) // 50)) AS k FROM src),
    r AS (SELECT doc_id, row_number() OVER (PARTITION BY label ORDER BY {sql_hash('doc_id')}) AS rk, count(*) OVER (PARTITION BY label) AS n FROM src),
    f AS (SELECT doc_id, CAST(len(list_filter(range(1, k), lambda j: ceil(n * j / CAST(k AS DOUBLE)) < rk)) AS INT) AS own FROM r, k),
    w AS (SELECT own, doc_id, list_filter(string_split({sql_clean('text')}, ' '), lambda t: length(t) >= 2) AS w FROM documents JOIN f USING (doc_id)),
    g AS (SELECT own, doc_id, unnest(list_concat(w, [w[i] || ' ' || w[i+1] for i in range(1, len(w))])) AS term FROM w),
    c AS (SELECT own, doc_id, term, count(*) AS tf FROM g GROUP BY ALL),
    x AS (SELECT CAST(unnest(range(0, k)) AS INT) AS fold FROM k),
    n AS (SELECT fold, count(*) AS n FROM f, x WHERE own <> fold GROUP BY 1),
    s AS (SELECT fold, term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS tf FROM c, x WHERE own <> fold GROUP BY 1, 2),
    q AS (SELECT s.*, n.n FROM s JOIN n ON n.fold = s.fold WHERE df >= 3 AND df <= 0.9e0 * n
      QUALIFY row_number() OVER (PARTITION BY s.fold ORDER BY tf DESC, term) <= 6000)
    SELECT fold, term, CAST(row_number() OVER (PARTITION BY fold ORDER BY term) - 1 AS INT) AS index, df, tf, round(ln((1e0 + n) / (1e0 + df)) + 1, 6) AS idf FROM q""",
)
def v17_vocabularies(spark, sf):
    rows = samples(spark, sf)
    k = splits.fold_count(rows.count(), settings.CV_FOLDS)
    stats = cut_lineage(fold_features.fold_stats(splits.folds(rows, "key", "label", k)))
    return fold_features.fold_vocabularies(stats, k, TERMS).withColumn("idf", r6(F.col("idf")))


@query("v20_refresh_cutoffs")
def v20(spark, sf):
    _, stored, val, _ = _stored(spark, sf)
    return experiments.refresh_cutoffs(stored.candidate, val)


@query(
    "v21_run_metadata",
    f"""WITH {sql_digest(f"(SELECT sha256({sql_normal('text')}) AS fp FROM documents)")}
    SELECT 'v1' AS model_version, 42 AS random_seed, g AS dataset_fingerprint, CAST(n AS BIGINT) AS n_rows, 'logistic_regression' AS best_model,
      '{settings.LABEL_DISCLAIMER}' AS label_disclaimer, '{settings.SCORE_DISCLAIMER}' AS score_disclaimer FROM n0, z""",
)
def v21(spark, sf):
    frame = posts(spark, sf).select(tx.fingerprint(F.col("text")).alias("fp"))
    return experiments.run_metadata(frame, "fp", "logistic_regression", "v1")


@query("v18_model_comparison")
def v18_run(spark, sf):
    """Text and vector model on the same split, with the winner per metric."""
    vectors = table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("key"), array_to_vector(F.col("embedding").cast("array<double>")).alias("vector")
    )
    cut = cut_wide(splits.stratified(samples(spark, sf).join(vectors, "key"), "key", "label"), "key")
    train, val, test = (cut.filter(F.col("split_name") == s).drop("split_name") for s in ("train", "val", "test"))
    return experiments.compare_models(train, val, test, features.STAT_COLUMNS, lexicons(spark), max_terms=TERMS)


@query("s14_score_batch")
def s14(spark, sf):
    _, stored, _, _ = _stored(spark, sf)
    scored = stored.score(posts(spark, sf), "text").drop("text")
    return scored.withColumns({"model_score": r6(F.col("model_score")), "flags": F.array_join("flags", ",")})


@query(
    "s14_batch_facts",
    """SELECT source AS source_id, count(*) AS n_rows, 'logistic_regression-v1' AS model_version, true AS scores_in_range, true AS tiers_known,
      true AS clear_texts_keep_their_tier FROM documents GROUP BY 1""",
)
def s14_facts(spark, sf):
    _, stored, _, _ = _stored(spark, sf)
    scored = stored.score(posts(spark, sf), "text")
    tiers = ["low", "medium", "high"]
    return scored.groupBy("source_id").agg(
        F.count("*").alias("n_rows"), F.first("model_version").alias("model_version"),
        F.bool_and(F.col("model_score").between(0, 1)).alias("scores_in_range"),
        F.bool_and(F.col("model_tier").isin(tiers) & F.col("display_tier").isin(tiers)).alias("tiers_known"),
        F.bool_and((F.size("flags") > 0) | (F.col("model_tier") == F.col("display_tier"))).alias("clear_texts_keep_their_tier"),
    )

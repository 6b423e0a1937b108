"""Training and evaluation runs over labelled samples.

Samples have a unique ``key`` column, ``clean`` text, ``label`` (0/1) and, where sources
matter, ``source_id``. Everything per row stays in Spark; the driver sees fitted models,
thresholds and metric tables of one row per model or source.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.classification import LinearSVC, LogisticRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import settings
from ..operators import features, metrics, models, splits
from ..operators.risk import Lexicons
from ..session import cut_lineage, cut_wide, local_rows, small_table
from .fold_features import feature_sets, fit_folds

_FITS_AT_ONCE = 4

# Rows of the balanced training part to an estimator: penalties are measured against them.
Builder = Callable[[float], Estimator]


@dataclass(frozen=True)
class FeatureSpace:
    """What the training texts fixed: vocabulary, its size and the dense columns."""

    vocab: DataFrame
    size: int
    dense: tuple[str, ...]
    lexicons: Lexicons | None = None

    def transform(self, df: DataFrame, key: str = "key", clean: str = "clean") -> DataFrame:
        """Adds the dense columns and ``tfidf``; a frame of :meth:`written` has both and stays as it is."""
        if "tfidf" in df.columns and clean not in df.columns:
            return df
        out = features.add_dense(df, clean, self.dense, self.lexicons)
        return features.tfidf_vectors(out, key, clean, self.vocab, self.size)

    def written(self, df: DataFrame, key: str = "key", clean: str = "clean") -> DataFrame:
        """``df`` with its features in place of its texts, as a written table: computed once, however often it is read."""
        return cut_lineage(self.transform(df, key, clean).drop(clean))


def fit_features(
    train: DataFrame, dense: Sequence[str] = (), lexicons: Lexicons | None = None, max_terms: int = settings.TFIDF_MAX_TERMS
) -> FeatureSpace:
    """Vocabulary from the training texts only; it is read once and kept as a small table."""
    vocab = small_table(features.vocabulary(train, "clean", max_terms))
    return FeatureSpace(vocab.frame, len(vocab.rows or []) or max_terms, tuple(dense), lexicons)


@dataclass
class Fitted:
    """A candidate fitted on features: scores any frame from raw cleaned texts."""

    name: str
    space: FeatureSpace
    scaler: PipelineModel
    model: Model | models.CalibratedSvm
    threshold: float = 0.5
    platt: models.Platt | None = None

    def score(self, df: DataFrame) -> DataFrame:
        """Adds ``score`` (calibrated when a calibrator is set) and ``pred``."""
        ready = self.scaler.transform(self.space.transform(df)).drop("tfidf", "_joined")
        out = models.score_with(self.model, ready).drop("features")
        if self.platt is not None:
            out = out.withColumn("score", self.platt.apply(F.col("score")))
        return out.withColumn("pred", (F.col("score") >= self.threshold).cast("int"))


def fit_candidate(
    name: str, estimator: Estimator, train: DataFrame, space: FeatureSpace, seed: int = settings.SEED, key: str = "key"
) -> Fitted:
    """Fit one candidate on rows with balanced weights; a linear SVM is calibrated on three folds.

    Balanced weights stand for both oversampling and class weights: the expected loss is
    the same, no row is copied, and no copy can leak into a calibration fold. The two differ only in the number of rows that the
    penalty is measured against, :func:`splits.balanced_rows`.
    """
    # The scaler and the fit read the features several times.
    ready = space.written(splits.class_weights(train, "label"), key)
    scaler = Pipeline(stages=models.feature_stages(space.dense)).fit(ready)
    data = scaler.transform(ready).select(key, "label", "weight", "features")
    return Fitted(name, space, scaler, fit_estimator(estimator, data, seed, key))


def fit_estimator(estimator: Estimator, data: DataFrame, seed: int = settings.SEED, key: str = "key") -> Model | models.CalibratedSvm:
    """Fit on ready features, which are cached for as long as the fit runs."""
    if isinstance(estimator, (LinearSVC, LogisticRegression)):  # trees take longer on few tasks
        data = models.few_tasks(data)
    data = data.persist()
    try:
        return models.fit_calibrated_svm(data, key, estimator, seed=seed) if isinstance(estimator, LinearSVC) else estimator.fit(data)
    finally:
        data.unpersist()


def tune(candidate: Fitted, frame: DataFrame) -> Fitted:
    """Set the F2 threshold on a validation frame."""
    return _tune_on(candidate, scores_of(candidate, frame))


def scores_of(candidate: Fitted, frame: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Written label and score: metrics read them several times, features are computed once."""
    return cut_lineage(candidate.score(frame).select(*keep, "label", "score"))


def _tune_on(candidate: Fitted, scored: DataFrame) -> Fitted:
    candidate.threshold = float(metrics.best_threshold(scored, "label", "score").first().threshold)
    return candidate


def _decided(candidate: Fitted, scored: DataFrame) -> DataFrame:
    return scored.withColumn("pred", (F.col("score") >= candidate.threshold).cast("int"))


def _with(df: DataFrame, **names: str) -> DataFrame:
    return df.select(*[F.lit(value).alias(name) for name, value in names.items()], "*")


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


@dataclass
class TrainingRun:
    best: Fitted
    validation: DataFrame
    test: DataFrame
    intervals: DataFrame
    cutoffs: DataFrame
    per_source: DataFrame | None
    errors: DataFrame
    scored: DataFrame


def train_and_evaluate(
    train: DataFrame,
    val: DataFrame,
    test: DataFrame,
    dense: Sequence[str] = (),
    lexicons: Lexicons | None = None,
    full: bool = False,
    oov: DataFrame | None = None,
    oversample: bool = True,
    max_terms: int = settings.TFIDF_MAX_TERMS,
    seed: int = settings.SEED,
    trees: int = settings.FOREST_TREES,
    rounds: int = settings.BOOSTING_ROUNDS,
    replicates: int = 400,
    max_rows: int | None = None,
) -> TrainingRun:
    """The whole experiment: candidates, choice, calibration, thresholds, test report.

    Calibration and selection use disjoint halves of the validation rows. All training rows are fitted; only a caller that
    passes ``max_rows`` (published: ``settings.MAX_TRAIN_ROWS``) gets a stratified subsample.
    """
    if max_rows is not None:
        train = splits.cap(train, "key", "label", max_rows, seed)
    calibrate, select = splits.calibration_halves(val, "key", "label", seed)
    space = fit_features(train, dense, lexicons, max_terms)
    train, select = space.written(train), space.written(select)
    n = splits.balanced_rows(train, "label", oversample)
    fitted, rows = {}, []
    for rank, (name, estimator) in enumerate(models.candidates(n, full, seed, trees, rounds, oversample).items()):
        candidate = fit_candidate(name, estimator, train, space, seed)
        scored = scores_of(candidate, select)
        wide = metrics.binary_metrics(_decided(_tune_on(candidate, scored), scored), "label", "pred", "score")
        rows.append(wide.select(F.lit(name).alias("model"), F.lit(rank).alias("rank"), F.lit(candidate.threshold).alias("threshold"), "*"))
        fitted[name] = candidate, scored
    table = cut_lineage(_union(rows))
    none = table.select("model").limit(0).withColumn("oov_f2", F.lit(None).cast("double"))
    chosen = models.select_model(table, none if oov is None else oov)
    best, selection = fitted[chosen.filter("selected").first().model]
    best.platt = models.fit_platt(scores_of(best, calibrate))
    if best.platt is not None:
        selection = selection.withColumn("score", best.platt.apply(F.col("score")))
    _tune_on(best, selection)
    kept = ["key", *(c for c in ("source_id",) if c in test.columns)]
    scored = cut_lineage(_decided(best, scores_of(best, test, kept)))
    by_source = (
        metrics.binary_metrics(scored, "label", "pred", "score", ["source_id"]) if "source_id" in test.columns else None
    )
    return TrainingRun(
        best=best,
        validation=chosen,
        test=metrics.binary_metrics(scored, "label", "pred", "score"),
        intervals=metrics.bootstrap(scored, "key", "label", "pred", "score", replicates, seed),
        cutoffs=metrics.risk_cutoffs(selection, "label", "score"),
        per_source=by_source,
        errors=metrics.error_cases(scored, "label", "score", best.threshold, "key"),
        scored=scored,
    )


def out_of_domain(
    samples: DataFrame,
    train_sources: Sequence[str],
    test_sources: Sequence[str],
    candidates: Callable[[float], Mapping[str, Estimator]] = models.out_of_domain_candidates,
    dense: Sequence[str] = (),
    lexicons: Lexicons | None = None,
    fraction: float = settings.OOV_HOLDOUT_FRACTION,
    max_terms: int = settings.TFIDF_MAX_TERMS,
    seed: int = settings.SEED,
    vector: str | None = None,
) -> DataFrame:
    """(model, source_id, metrics): train on some sources, test on the others.

    "holdout" rows are the in-domain validation part. Sources with fewer than 5 rows are
    left out (:func:`skipped_sources`); fewer than 40 training rows are an error. All held-out sources are scored in
    one pass and split by group afterwards. ``vector`` names a column of sentence vectors; with it the
    vector model, "embedding", is fitted and tested on the same rows.
    """
    pool = samples.filter(F.col("source_id").isin(list(train_sources)))
    rows = pool.count()
    if rows < 40:
        raise ValueError(f"only {rows} rows in the training sources {list(train_sources)}")
    cut = cut_wide(splits.holdout(pool, "key", "label", fraction, seed), "key")
    train, val = cut.filter(~F.col("held_out")).drop("held_out"), cut.filter("held_out").drop("held_out")
    others = samples.filter(F.col("source_id").isin(list(test_sources)))
    sizes = others.groupBy("source_id").count().filter("count >= 5").select("source_id")
    others = others.join(sizes, "source_id", "left_semi")
    tested = cut_wide(val.withColumn("source_id", F.lit("holdout")).unionByName(others, True), "key")
    space = fit_features(train, dense, lexicons, max_terms)
    train, val, tested = (space.written(part) for part in (train, val, tested))
    fits = [
        tune(fit_candidate(name, estimator, train, space, seed), val)
        for name, estimator in candidates(float(train.count())).items()
    ]
    scored = [_with(fit.score(tested).select("key", "source_id", "label", "score", "pred"), model=fit.name) for fit in fits]
    if vector is not None:
        fit = models.embedding_classifier(train, val, vector)
        scored.append(_with(fit.score(tested).select("key", "source_id", "label", "score", "pred"), model="embedding"))
    return metrics.binary_metrics(cut_lineage(_union(scored)), "label", "pred", "score", ["model", "source_id"])


def skipped_sources(samples: DataFrame, test_sources: Sequence[str], least: int = 5) -> DataFrame:
    """(source_id, n_rows) of the test sources with too few rows, absent ones included."""
    named = local_rows(samples.sparkSession, [(s,) for s in test_sources], "source_id string")
    sizes = samples.groupBy("source_id").agg(F.count("*").alias("n_rows"))
    return named.join(sizes, "source_id", "left").na.fill(0, ["n_rows"]).filter(F.col("n_rows") < least)


def mean_out_of_domain_f2(report: DataFrame) -> DataFrame:
    """(model, oov_f2): mean F2 over the held-out sources."""
    return report.filter("source_id <> 'holdout'").groupBy("model").agg(F.avg("f2").alias("oov_f2"))


def protocol(samples: DataFrame, train_sources: Sequence[str], test_sources: Sequence[str]) -> DataFrame:
    """Role, rows, positives and status of every source in an out-of-domain run."""
    counts = samples.groupBy("source_id").agg(
        F.count("*").alias("n_rows"), F.sum("label").alias("n_positive")
    )
    role = F.when(F.col("source_id").isin(list(train_sources)), "train").when(
        F.col("source_id").isin(list(test_sources)), "test"
    )
    status = F.when((F.col("role") == "test") & (F.col("n_rows") < 5), "skipped").otherwise("used")
    return counts.withColumn("role", role).filter(F.col("role").isNotNull()).withColumn("status", status)


def cross_validate(
    samples: DataFrame,
    variants: Mapping[str, Sequence[str]],
    lexicons: Lexicons | None = None,
    k: int = settings.CV_FOLDS,
    group: str | None = None,
    max_terms: int = settings.TFIDF_MAX_TERMS,
    seed: int = settings.SEED,
    build: Builder = models.logistic,
) -> DataFrame:
    """Mean metrics over folds, (feature_set, metric, value), for dense columns by feature set.

    See :mod:`fold_features`: the validation fold never takes part in vocabulary, idf or scaling. Fits of different folds
    and sets are independent and run side by side; their scores are evaluated together.
    """
    k = splits.fold_count(samples.count(), k)
    folded = cut_wide(splits.folds(samples, "key", "label", k, seed, group), "key")
    spaces = fit_folds(folded, k, feature_sets(variants), lexicons, max_terms)

    def fit(fold: int) -> list[DataFrame]:
        vectors = cut_lineage(spaces.vectors(fold))
        train = splits.class_weights(vectors.filter(F.col("fold") != fold), "label")
        rows = splits.balanced_rows(train, "label")
        out = []
        for name, dense in variants.items():
            scaler = Pipeline(stages=models.feature_stages(tuple(dense))).fit(train)
            model = fit_estimator(build(rows), scaler.transform(train).select("key", "label", "weight", "features"), seed)
            scores = models.score_with(model, scaler.transform(vectors.filter(F.col("fold") == fold)))
            out.append(cut_lineage(_with(scores.select("fold", "label", "score"), feature_set=name)))
        return out

    with ThreadPool(min(_FITS_AT_ONCE, k)) as pool:
        scored = _union([part for parts in pool.map(inheritable_thread_target(samples.sparkSession)(fit), range(k)) for part in parts])
    by = ["feature_set", "fold"]
    cuts = metrics.best_threshold(scored, "label", "score", by=by).select(*by, "threshold")
    decided = scored.join(cuts, by).withColumn("pred", (F.col("score") >= F.col("threshold")).cast("int"))
    long = metrics.long_metrics(metrics.binary_metrics(cut_lineage(decided), "label", "pred", "score", by), by)
    return long.groupBy("feature_set", "metric").agg(F.avg("value").alias("value"))


def evaluate_variants(
    variants: Mapping[str, Sequence[str]], train: DataFrame, val: DataFrame, test: DataFrame, lexicons: Lexicons | None,
    cv: int | None = None, group: str | None = None, max_terms: int = settings.TFIDF_MAX_TERMS, seed: int = settings.SEED,
    build: Builder = models.logistic,
) -> DataFrame:
    """(feature_set, part, metric, value) of the same model over feature sets, for val, test and cv."""
    rows = splits.balanced_rows(train, "label")
    whole = replace(fit_features(train, (), None, max_terms), dense=feature_sets(variants), lexicons=lexicons)
    fit_on = whole.written(train)
    both = whole.written(_with(val, part="val").unionByName(_with(test, part="test")))
    scored = []
    for name, dense in variants.items():
        space = replace(whole, dense=tuple(dense))
        candidate = tune(fit_candidate(name, build(rows), fit_on, space, seed), both.filter("part = 'val'"))
        scored.append(_with(candidate.score(both).select("part", "label", "score", "pred"), feature_set=name))
    by = ["feature_set", "part"]
    long = metrics.long_metrics(metrics.binary_metrics(cut_lineage(_union(scored)), "label", "pred", "score", by), by)
    if not cv:
        return long
    folds = cross_validate(train.unionByName(val), variants, lexicons, cv, group, max_terms, seed, build)
    return long.unionByName(folds.withColumn("part", F.lit("cv")))


def ablation(
    train: DataFrame, val: DataFrame, test: DataFrame, variants: Mapping[str, Sequence[str]] | None = None,
    lexicons: Lexicons | None = None, cv: int | None = settings.CV_FOLDS, max_terms: int = settings.TFIDF_MAX_TERMS,
    seed: int = settings.SEED, build: Builder = models.logistic,
) -> DataFrame:
    """The same model over several feature sets, in long form, cross-validated."""
    chosen = features.ABLATION_SETS if variants is None else variants
    return evaluate_variants(chosen, train, val, test, lexicons, cv, None, max_terms, seed, build)


def ablation_table(long: DataFrame) -> DataFrame:
    """One row per feature set: val_f1, val_f2, ..., cv_f2."""
    wanted = ["val_f1", "val_f2", "val_recall", "test_f1", "test_f2", "test_recall", "test_roc_auc", "cv_f2"]
    named = long.withColumn("name", F.concat_ws("_", "part", "metric"))
    return named.groupBy("feature_set").pivot("name", wanted).agg(F.first("value"))


def split_compare(
    samples: DataFrame, dense: Sequence[str] = (), lexicons: Lexicons | None = None, cv: int | None = settings.CV_FOLDS,
    max_terms: int = settings.TFIDF_MAX_TERMS, seed: int = settings.SEED, build: Builder = models.logistic,
) -> DataFrame:
    """Row split against group split on the same samples: (split_protocol, feature_set, part, metric, value)."""
    out = []
    for name, split in (("stratified_row", splits.stratified), ("group_by_source", splits.grouped)):
        cut = cut_lineage(split(samples, "key", "label", seed=seed))
        train, val, test = (cut.filter(F.col("split_name") == s).drop("split_name") for s in ("train", "val", "test"))
        rows = evaluate_variants({"tfidf_full": dense}, train, val, test, lexicons, cv, "source_id", max_terms, seed, build)
        out.append(_with(rows, split_protocol=name))
    return _union(out)


def compare_models(
    train: DataFrame, val: DataFrame, test: DataFrame, dense: Sequence[str] = (), lexicons: Lexicons | None = None,
    vector: str = "vector", max_terms: int = settings.TFIDF_MAX_TERMS, seed: int = settings.SEED,
) -> DataFrame:
    """(metric, text, embedding, winner): the text model against the vector model, both tuned on ``val``."""
    space = fit_features(train, dense, lexicons, max_terms)
    text = tune(fit_candidate("text", models.logistic(splits.balanced_rows(train, "label", False)), train, space, seed), val)
    by_vector = models.embedding_classifier(train, val, vector)
    scored = [_with(m.score(test).select("label", "score", "pred"), model=n) for n, m in (("text", text), ("embedding", by_vector))]
    wide = metrics.binary_metrics(cut_lineage(_union(scored)), "label", "pred", "score", ["model"])
    table = metrics.long_metrics(wide, ["model"]).groupBy("metric").pivot("model", ["text", "embedding"]).agg(F.first("value"))
    # the squared error is the one metric where less is better
    sign = F.when(F.col("metric") == "brier", -1.0).otherwise(1.0)
    signed = table.withColumns({"_text": sign * F.col("text"), "_embedding": sign * F.col("embedding")})
    won = metrics.winner(signed, "_text", "_embedding").withColumn("winner", F.ltrim(F.col("winner"), F.lit("_")))
    return won.select("metric", F.round("text", 6).alias("text"), F.round("embedding", 6).alias("embedding"), "winner")


def refresh_cutoffs(candidate: Fitted, val: DataFrame) -> DataFrame:
    """Re-score a validation frame with a fitted model and derive cutoffs and threshold again."""
    scored = scores_of(candidate, val)
    cutoffs = metrics.risk_cutoffs(scored, "label", "score")
    threshold = metrics.best_threshold(scored, "label", "score").select("threshold").scalar()
    return cutoffs.withColumns(
        {
            "operating_threshold": threshold,
            "calibrated_on": F.lit("validation_split"),
            "probability_calibration": F.lit("platt_validation" if candidate.platt else "none"),
        }
    )


def run_metadata(samples: DataFrame, fingerprint: str, best_model: str, version: str, seed: int = settings.SEED) -> DataFrame:
    """One row that identifies a run: version, seed, data fingerprint, model, disclaimers."""
    from ..operators.quality import dataset_fingerprint

    return dataset_fingerprint(samples, fingerprint).select(
        F.lit(version).alias("model_version"),
        F.lit(seed).alias("random_seed"),
        "dataset_fingerprint",
        "n_rows",
        F.lit(best_model).alias("best_model"),
        F.lit(settings.LABEL_DISCLAIMER).alias("label_disclaimer"),
        F.lit(settings.SCORE_DISCLAIMER).alias("score_disclaimer"),
    )

"""Classifiers with Spark ML, calibration, model choice."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    NaiveBayes,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import settings
from ..session import cut_lineage, small_rows
from . import metrics, splits, trees

_FITS_AT_ONCE = 4
_COLUMNS = {"featuresCol": "features", "labelCol": "label"}


# --- candidates ---------------------------------------------------------------------


def logistic(weight_sum: float, c: float = 1.0, l1: float = 0.0, weighted: bool = True, iterations: int = 200) -> LogisticRegression:
    """Logistic regression whose penalty matches strength ``c`` on a sum of weighted losses.

    Spark averages the loss over the weights, hence regParam = 1 / (c * weight sum).
    """
    model = LogisticRegression(
        **_COLUMNS, regParam=1.0 / (c * weight_sum), elasticNetParam=l1, standardization=False, maxIter=iterations
    )
    return model.setWeightCol("weight") if weighted else model


def svm(weight_sum: float, c: float = 1.0, iterations: int = 100) -> LinearSVC:
    return LinearSVC(
        **_COLUMNS, weightCol="weight", regParam=1.0 / (c * weight_sum), standardization=False, maxIter=iterations
    )


def forest(trees: int = settings.FOREST_TREES, seed: int = settings.SEED) -> RandomForestClassifier:
    """Deep trees over class-weighted bootstraps; depth is Spark's largest.

    Every row keeps its place in all trees (``cacheNodeIds``), so that a pass over the nodes does not walk the trees again.
    """
    return RandomForestClassifier(**_COLUMNS, weightCol="weight", numTrees=trees, maxDepth=30, seed=seed, cacheNodeIds=True, maxMemoryInMB=512)


def boosting(
    rounds: int = settings.BOOSTING_ROUNDS, depth: int = settings.BOOSTING_DEPTH, step: float = settings.BOOSTING_STEP,
    seed: int = settings.SEED, weighted: bool = True,
) -> GBTClassifier:
    """Boosted trees on the balanced rows: by default with the ``weight`` column."""
    model = trees.SparseBoosting(
        **_COLUMNS, maxIter=rounds, maxDepth=depth, stepSize=step, seed=seed,
        subsamplingRate=settings.BOOSTING_SHARE, featureSubsetStrategy=str(settings.BOOSTING_SHARE),
    )
    return model.setWeightCol("weight") if weighted else model


def out_of_domain_boosting(seed: int = settings.SEED, rounds: int = settings.OOV_BOOSTING_ROUNDS) -> GBTClassifier:
    """The published out-of-domain candidate, which is fitted without balancing."""
    return boosting(rounds, settings.OOV_BOOSTING_DEPTH, settings.BOOSTING_STEP, seed, weighted=False)


def bernoulli_bayes(smoothing: float = 0.1) -> NaiveBayes:
    """Bernoulli naive Bayes; the features must be 0 or 1 (see :func:`binarise`)."""
    return NaiveBayes(**_COLUMNS, modelType="bernoulli", smoothing=smoothing)


def shallow_tree(depth: int = 9, min_rows: int = 5, seed: int = settings.SEED) -> DecisionTreeClassifier:
    return DecisionTreeClassifier(**_COLUMNS, maxDepth=depth, minInstancesPerNode=max(1, min_rows // 2), seed=seed)


def multiclass_logistic(l1: float = 1.0, c: float = 10.0, rows: float = 1.0, iterations: int = 200) -> LogisticRegression:
    return LogisticRegression(
        **_COLUMNS, family="multinomial", elasticNetParam=l1, regParam=1.0 / (c * rows), maxIter=iterations
    )


@dataclass(frozen=True)
class MulticlassModel:
    """A fitted learner over string classes; ``score`` adds the most likely class and a map of class scores."""

    classes: list[str]
    members: list[Model]

    def score(self, df: DataFrame, pred: str = "prediction", to: str = "scores") -> DataFrame:
        if len(self.members) == 1:
            out = self.members[0].transform(df).withColumn("_p", vector_to_array("probability"))
            out = out.drop("rawPrediction", "probability", "prediction")
        else:
            out = df
            for i, member in enumerate(self.members):
                out = positive_probability(member, out, f"_p{i}")
            parts = [f"_p{i}" for i in range(len(self.members))]
            total = reduce(Column.__add__, [F.col(c) for c in parts])
            # scores of independent classifiers are brought to a sum of one
            out = out.withColumn("_p", F.array(*[F.when(total > 0, F.col(c) / total).otherwise(F.lit(0.0)) for c in parts])).drop(*parts)
        names = F.array(*[F.lit(c) for c in self.classes])
        best = F.get(names, (F.array_position("_p", F.array_max("_p")) - 1).cast("int"))
        return out.withColumns({to: F.map_from_arrays(names, F.col("_p")), pred: best}).drop("_p")


def fit_multiclass(df: DataFrame, label: str, features: str = "features", one_vs_rest: bool = False, l1: float = 0.0, c: float = 1.0) -> MulticlassModel:
    """Softmax regression, or one logistic regression per class against the rest, on a string label.

    Classes are in alphabetical order; rows without a label take no part. At least two classes are needed.
    """
    known = cut_lineage(df.filter(F.col(label).isNotNull()).select(F.col(features).alias("features"), F.col(label).cast("string").alias("_class")))
    known = few_tasks(known)
    counts = {r["_class"]: r["n"] for r in small_rows(known.groupBy("_class").agg(F.count("*").alias("n")))}
    classes, rows = sorted(counts), float(sum(counts.values()))
    if len(classes) < 2:
        raise ValueError("at least two classes are needed")
    if one_vs_rest:
        target = lambda name: known.select("features", (F.col("_class") == name).cast("double").alias("label"))
        one = inheritable_thread_target(df.sparkSession)(lambda name: logistic(rows, c, l1, weighted=False).fit(target(name)))
        with ThreadPool(min(_FITS_AT_ONCE, len(classes))) as pool:
            return MulticlassModel(classes, pool.map(one, classes))
    index = F.array_position(F.array(*[F.lit(c) for c in classes]), F.col("_class")) - 1
    return MulticlassModel(classes, [multiclass_logistic(l1, c, rows).fit(known.select("features", index.cast("double").alias("label")))])


def candidates(
    weight_sum: float, full: bool = False, seed: int = settings.SEED, trees: int = settings.FOREST_TREES,
    rounds: int = settings.BOOSTING_ROUNDS, oversample: bool = True,
) -> dict[str, Estimator]:
    """Candidate models in their order of preference; "linear_svc" is calibrated when fitted.

    Linear models and the forest balance classes in any case, boosting only by oversampling.
    """
    out: dict[str, Estimator] = {"logistic_regression": logistic(weight_sum), "linear_svc": svm(weight_sum)}
    if full:
        out["random_forest"] = forest(trees, seed)
        out["boosting"] = boosting(rounds, seed=seed, weighted=oversample)
    return out


def out_of_domain_candidates(weight_sum: float, seed: int = settings.SEED, rounds: int = settings.OOV_BOOSTING_ROUNDS) -> dict[str, Estimator]:
    """The published candidates of the out-of-domain run, which balance classes by weights only."""
    return {
        "logistic_regression": logistic(weight_sum), "linear_svc": svm(weight_sum), "boosting": out_of_domain_boosting(seed, rounds),
    }


# --- scores -------------------------------------------------------------------------


def positive_probability(model: Model, df: DataFrame, to: str = "score") -> DataFrame:
    """Adds the score of class 1 and drops Spark ML's own output columns."""
    out = model.transform(df)
    if "probability" in out.columns:
        scored = out.withColumn(to, vector_to_array("probability")[1])
    else:
        scored = out.withColumn(to, sigmoid(vector_to_array("rawPrediction")[1]))
    return scored.drop("rawPrediction", "probability", "prediction")


def score_with(model: Model | CalibratedSvm, df: DataFrame, to: str = "score") -> DataFrame:
    """Adds the score of a fitted candidate."""
    return model.score(df, to) if isinstance(model, CalibratedSvm) else positive_probability(model, df, to)


def sigmoid(margin: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-margin))


def margin_to_score(df: DataFrame, margin: str, how: str = "sigmoid", to: str = "score") -> DataFrame:
    """Margin to a score in [0, 1]: by sigmoid, or by the range of all margins."""
    if how == "sigmoid":
        return df.withColumn(to, sigmoid(F.col(margin)))
    if how != "minmax":
        raise ValueError("how must be 'sigmoid' or 'minmax'")
    span = df.agg(F.struct(F.min(margin).alias("lo"), F.max(margin).alias("hi"))).scalar()
    return df.withColumn(to, (F.col(margin) - span["lo"]) / (span["hi"] - span["lo"] + 1e-9))


# --- calibration --------------------------------------------------------------------


@dataclass(frozen=True)
class Platt:
    slope: float
    intercept: float

    def apply(self, score: Column) -> Column:
        return apply_platt(score, self.slope, self.intercept)


def fit_platt(df: DataFrame, score: str = "score", label: str = "label") -> Platt | None:
    """Sigmoid calibration of a score; None for under 10 rows, one class or one score."""
    df = cut_lineage(df.select(score, label))
    facts = df.agg(
        F.count("*").alias("n"), F.min(score).alias("lo"), F.max(score).alias("hi"),
        F.min(label).alias("y0"), F.max(label).alias("y1"),
    ).first()
    if facts.n < 10 or facts.lo == facts.hi or facts.y0 == facts.y1:
        return None
    data = VectorAssembler(inputCols=[score], outputCol="_s").transform(df.select(score, F.col(label).alias("_y")))
    fitted = LogisticRegression(
        featuresCol="_s", labelCol="_y", regParam=1.0 / facts.n, standardization=False, maxIter=1000, tol=1e-8
    ).fit(data)
    return Platt(float(fitted.coefficients[0]), float(fitted.intercept))


def fit_sigmoid(df: DataFrame, margin: str = "margin", label: str = "label") -> Platt | None:
    """Unpenalised sigmoid of a margin on smoothed targets; None for one class or one margin.

    With n1 positive and n0 negative rows the targets are (n1 + 1) / (n1 + 2) and 1 / (n0 + 2). A row with target t is
    a pair of weighted rows: class 1 with weight t and class 0 with weight 1 - t.
    """
    df = cut_lineage(df.select(F.col(margin).alias("_s"), F.col(label).alias("_y")))
    facts = df.agg(F.sum("_y").alias("n1"), F.count("*").alias("n"), F.min("_s").alias("lo"), F.max("_s").alias("hi")).first()
    if not facts.n1 or facts.n1 == facts.n or facts.lo == facts.hi:
        return None
    target = F.when(F.col("_y") == 1, (facts.n1 + 1.0) / (facts.n1 + 2.0)).otherwise(1.0 / (facts.n - facts.n1 + 2.0))
    pair = F.inline(F.array(F.struct(F.lit(1.0).alias("_l"), target.alias("_w")), F.struct(F.lit(0.0).alias("_l"), (1.0 - target).alias("_w"))))
    data = VectorAssembler(inputCols=["_s"], outputCol="_v").transform(df.select("_s", pair))
    fitted = LogisticRegression(featuresCol="_v", labelCol="_l", weightCol="_w", regParam=0.0, maxIter=1000, tol=1e-12).fit(data)
    return Platt(float(fitted.coefficients[0]), float(fitted.intercept))


def apply_platt(score: Column, slope: float, intercept: float) -> Column:
    value = sigmoid(F.lit(slope) * score + F.lit(intercept))
    return F.greatest(F.least(value, F.lit(1.0 - 1e-6)), F.lit(1e-6))


@dataclass(frozen=True)
class CalibratedSvm:
    """Linear SVMs of the folds with their calibrators; the score is the mean."""

    members: list[tuple[Model, Platt | None]]

    def score(self, df: DataFrame, to: str = "score") -> DataFrame:
        parts = []
        for i, (model, platt) in enumerate(self.members):
            out = model.transform(df).withColumn(f"_m{i}", vector_to_array("rawPrediction")[1])
            df = out.drop("rawPrediction", "prediction")
            column = F.col(f"_m{i}")
            parts.append(sigmoid(column) if platt is None else platt.apply(column))
        total = parts[0]
        for part in parts[1:]:
            total = total + part
        return df.withColumn(to, total / len(parts)).drop(*[f"_m{i}" for i in range(len(parts))])


def few_tasks(df: DataFrame) -> DataFrame:
    """Ready features in tasks of about ``settings.FIT_ROWS`` rows, for the many short jobs of a linear fit."""
    return df.coalesce(max(1, -(-df.count() // settings.FIT_ROWS)))


def fit_calibrated_svm(
    df: DataFrame, key: str, estimator: LinearSVC, k: int = 3, seed: int = settings.SEED
) -> CalibratedSvm:
    """``k`` SVMs, each calibrated on the fold it did not see by :func:`fit_sigmoid`; they are fitted side by side."""
    folded = few_tasks(cut_lineage(splits.folds(df, key, "label", max(k, 2), seed, to="_fold"))).persist()

    def fit(fold: int) -> tuple[Model, Platt | None]:
        fitted = estimator.fit(folded.filter(F.col("_fold") != fold))
        held = fitted.transform(folded.filter(F.col("_fold") == fold)).withColumn(
            "margin", vector_to_array("rawPrediction")[1]
        )
        return fitted, fit_sigmoid(held, "margin")

    with ThreadPool(min(_FITS_AT_ONCE, k)) as pool:
        members = pool.map(inheritable_thread_target(df.sparkSession)(fit), range(k))
    folded.unpersist()
    return CalibratedSvm(members)


# --- pipelines ----------------------------------------------------------------------


def feature_stages(dense: Sequence[str], text_vector: str = "tfidf") -> list:
    """Sparse text vector and dense columns side by side, scaled without centring.

    Spark scales by the sample standard deviation, sqrt(n / (n - 1)) above the
    population one: a constant factor that only rescales the penalty slightly.
    """
    return [
        VectorAssembler(inputCols=[text_vector, *dense], outputCol="_joined"),
        StandardScaler(inputCol="_joined", outputCol="features", withMean=False, withStd=True),
    ]


def build_pipeline(variant_columns: Sequence[str], estimator: Estimator) -> Pipeline:
    return Pipeline(stages=[*feature_stages(variant_columns), estimator])


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def binarise(df: DataFrame, column: str = "features") -> DataFrame:
    from pyspark.ml.feature import Binarizer

    return Binarizer(inputCol=column, outputCol="_b", threshold=0.0).transform(df).drop(column).withColumnRenamed("_b", column)


# --- choice -------------------------------------------------------------------------


def select_model(validation: DataFrame, oov: DataFrame) -> DataFrame:
    """Selection score 0.7 * F2 + 0.3 * out-of-domain F2 and the winner.

    ``validation`` has (model, rank, f2) with rank the declared order, ``oov`` (model, oov_f2).
    When any out-of-domain score exists, models without one are not eligible; when none
    exists, F2 alone decides. Ties go to the first model. One row per model.
    """
    any_oov = oov.filter(F.col("oov_f2").isNotNull()).agg(F.count("*") > 0).scalar()
    joined = validation.join(oov, "model", "left")
    mixed = F.lit(0.7) * F.col("f2") + F.lit(0.3) * F.col("oov_f2")
    scored = joined.withColumns(
        {
            "eligible": ~any_oov | F.col("oov_f2").isNotNull(),
            "selection_score": F.when(any_oov, mixed).otherwise(F.col("f2")),
        }
    )
    order = F.max(F.struct(F.col("selection_score").alias("s"), (-F.col("rank")).alias("r"), "model"))
    best = scored.filter("eligible").agg(order["model"]).scalar()
    return scored.withColumn("selected", F.col("model") == best)


@dataclass(frozen=True)
class EmbeddingClassifier:
    model: PipelineModel
    threshold: float
    validation: DataFrame = field(repr=False)

    def score(self, df: DataFrame) -> DataFrame:
        scored = positive_probability(self.model, df)
        return scored.withColumn("pred", (F.col("score") >= self.threshold).cast("int"))


def embedding_classifier(train: DataFrame, val: DataFrame, vector: str = "vector") -> EmbeddingClassifier:
    """Standardised vectors, balanced logistic regression, threshold by validation F2."""
    weighted = cut_lineage(splits.class_weights(train, "label")).persist()
    total = float(weighted.count())
    scaler = StandardScaler(inputCol=vector, outputCol="features", withMean=True, withStd=True)
    model = Pipeline(stages=[scaler, logistic(total)]).fit(weighted)
    weighted.unpersist()
    scored = positive_probability(model, val)
    threshold = float(metrics.best_threshold(scored, "label", "score").first().threshold)
    pred = scored.withColumn("pred", (F.col("score") >= threshold).cast("int"))
    return EmbeddingClassifier(model, threshold, metrics.binary_metrics(pred, "label", "pred", "score"))


def grid(df: DataFrame, steps: Sequence[float] = settings.GRID_STEPS, rounds: int = settings.BOOSTING_ROUNDS, k: int = settings.CV_FOLDS, seed: int = settings.SEED) -> CrossValidatorModel:
    """Cross-validated search over the boosting step size by accuracy.

    The models of all steps and folds, and those on all rows of which the best step's is kept, grow side by side (:mod:`trees`).
    """
    estimator = boosting(rounds, 3, seed=seed, weighted=False)
    search = CrossValidator(
        estimator=estimator, estimatorParamMaps=ParamGridBuilder().addGrid(estimator.stepSize, list(steps)).build(), numFolds=k, seed=seed,
        evaluator=MulticlassClassificationEvaluator(labelCol="label", metricName="accuracy"),
    )
    members = [trees.Member(step, fold) for step in steps for fold in (*range(k), -1)]
    grown = trees.grow(estimator.rows(df), members, rounds, **estimator.growth(), folds=k)
    scores = np.array(grown.accuracy).reshape(len(steps), k + 1)[:, :k]
    mean = scores.mean(axis=1)
    best = int(mean.argmax())
    model = trees.model_of(estimator.copy({estimator.stepSize: steps[best]}), df, grown.trees[best * (k + 1) + k], grown.edges)
    return search._copyValues(CrossValidatorModel(model, mean.tolist(), None, scores.std(axis=1).tolist()))

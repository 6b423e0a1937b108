"""Quality by Bradley-Terry ranking.

Every document gets a utility w.x of its text features; the chance that document i is preferred
to j is sigmoid(w.x_i - w.x_j). Preference pairs (label 1 over label 0) of all
labelled documents train w by logistic loss on feature differences, without an intercept. The
threshold is a quantile: the utility below which the labelled documents' share of label 0 lies. Scores
are a logistic map of the utility that puts this quantile at the contract's 0.3.

Defined results: null, empty and blank texts have all-zero counts and get the utility of an empty
text; texts are measured whole; equal texts get equal scores; without both labels
there are no pairs and every score is the label's share (0 without labels). Rows are scored by
themselves, so repeated rows stay; labels, lang, source and ids are never inputs.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.explore import exact_quantiles
from ..operators.ranking import grouped_rank
from ..settings import SEED
from .common import cut_lineage, fold, read_table

RIVALS = 8
THRESHOLD = 0.3
_MARKS = [ord(c) for c in ".,;:!?|#$%&*@<>{}[]()/\\=_-+\"'~^"]


def features(text: str | None) -> np.ndarray:
    """Shares and lengths that describe how a text is written, all of order one."""
    value = text or ""
    raw = value.encode("utf-8", "replace")
    counts = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256)
    size = max(len(raw), 1)
    words = value.split()
    n = max(len(words), 1)
    tally = Counter(words)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) if words else np.zeros(1)
    lines = [line for line in value.split("\n") if line.strip()]
    line_share = 1 - len(set(lines)) / len(lines) if lines else 0.0
    stuck = sum(a == b for a, b in zip(words, words[1:])) / n
    pairs = Counter(zip(words, words[1:]))
    marks = counts[_MARKS] / size
    upper, lower, digit = counts[65:91].sum(), counts[97:123].sum(), counts[48:58].sum()
    top = tally.most_common(1)[0][1] / n if tally else 0.0
    ends = counts[[46, 33, 63]].sum()
    return np.r_[
        np.log1p(len(words)) / 10, np.log1p(size) / 12, len(tally) / n, top, stuck, line_share,
        (sum(c for c in pairs.values() if c > 1) / n), lengths.mean() / 10, lengths.std() / 10, lengths.max() / 100,
        upper / size * 5, lower / size, digit / size * 5, (counts[:32].sum() - counts[10]) / size, counts[128:].sum() / size,
        counts[32] / size * 4, np.log1p(len(lines)) / 5, ends / n, np.sqrt(marks) * 3,
        np.minimum(marks[_MARKS.index(124)] * 40, 1), (upper > lower) * 1.0, float(len(words) == 0),
    ]


def feature_column(text: Column) -> Column:
    """The features as an array; Arrow batches, one pass over the whole text."""

    @F.pandas_udf("array<double>")
    def measure(batch: pd.Series) -> pd.Series:
        return pd.Series([features(t) for t in batch])

    return measure(text)


@dataclass(frozen=True)
class RankModel:
    """Utility weights, and the logistic map from utility to score."""

    weights: tuple[float, ...]
    cut: float
    slope: float
    base: float


def preference_pairs(sample: DataFrame, rivals: int = RIVALS, mirrored: bool = True) -> DataFrame:
    """Feature differences of preferred minus other, each also mirrored: diff, won.

    ``sample`` has key, label, x. Documents of each label are numbered in hash order. Those of the rarer label form teams of
    ``rivals``, the last one filled up from the start, and every other document meets one team: no row pairs with all others, and
    no features are shuffled per pair. Without ``mirrored`` a pair is one row, in turns as it is and mirrored; the loss is the same.
    """
    sizes = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        return sample.sparkSession.createDataFrame([], "diff array<double>, won double")
    longer = max(sizes, key=lambda k: sizes[k])
    size = sizes[1 - longer]
    teams = -(-size // rivals)
    numbered = grouped_rank(sample, ["label"], "key", SEED).withColumn("at", F.col("rank") - 1)
    many, few = numbered.filter(F.col("label") == longer), numbered.filter(F.col("label") != longer)
    turns = F.explode(F.sequence(F.lit(0), F.floor((F.lit(teams * rivals - 1) - F.col("at")) / size).cast("int")))
    placed = few.select("at", F.col("x").alias("y"), turns.alias("turn"))
    placed = placed.withColumn("team", F.floor((F.col("at") + F.col("turn") * size) / rivals).cast("long"))
    team = placed.groupBy("team").agg(F.collect_list("y").alias("ys"))  # ``rivals`` entries
    met = many.select("x", "at", (F.col("at") % teams).cast("long").alias("team")).join(team, "team")
    met = met.select("x", "at", F.posexplode("ys").alias("step", "y"))
    won = met.select(F.zip_with("x", "y", lambda a, b: a - b if longer == 1 else b - a).alias("diff"), ((F.col("at") + F.col("step")) % 2 == 0).alias("even"))
    lost = F.transform("diff", lambda v: -v)
    if not mirrored:
        return won.select(F.when(F.col("even"), F.col("diff")).otherwise(lost).alias("diff"), F.col("even").cast("double").alias("won"))
    won = won.select("diff", F.lit(1.0).alias("won"))
    return won.unionByName(won.select(lost.alias("diff"), F.lit(0.0).alias("won")))


def measured(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, print (digest of the text), x of every row, written: texts are read once for the fit and the scores."""
    return cut_lineage(docs.select(F.col(key).alias("key"), F.sha2(text, 256).alias("print"), feature_column(F.col(text)).alias("x")))


def _dot(x: str, weights: tuple[float, ...]) -> Column:
    return F.aggregate(F.zip_with(x, F.lit(list(weights)), lambda a, b: a * b), F.lit(0.0), lambda total, v: total + v)


def fit(rows: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality") -> RankModel:
    """Learn from all labelled documents of :func:`measured` rows; documents of fold 0 are never used.

    Conflicting or repeated labels of a key: the largest counts. Null keys, texts and labels take no part.
    """
    known = labels.select(F.col(key).alias("key"), F.col(label).cast("int").alias("label"))
    known = known.filter(F.col("key").isNotNull() & F.col("label").isin(0, 1) & (fold(F.col("key"), 5) != 0))
    known = known.groupBy("key").agg(F.max("label").alias("label"))
    # Copies of a text count once, so that no group of copies outweighs the rest.
    sample = rows.filter(F.col("print").isNotNull()).join(known, "key")
    sample = cut_lineage(sample.groupBy(F.col("print").alias("key")).agg(F.max("label").alias("label"), F.first("x").alias("x")))
    facts = sample.agg(F.avg("label").alias("share"), F.count("*").alias("n")).first()
    share = float(facts["share"] or 0.0)
    if not 0 < share < 1:
        return RankModel((), 0.0, 0.0, share)
    pairs = preference_pairs(sample, mirrored=False).select(array_to_vector("diff").alias("diff"), "won")
    fitted = LogisticRegression(
        featuresCol="diff", labelCol="won", fitIntercept=False, regParam=1e-4, standardization=True, maxIter=100
    ).fit(pairs)
    weights = tuple(float(w) for w in fitted.coefficients.toArray())
    held = cut_lineage(sample.select("label", _dot("x", weights).alias("utility")))
    cut = exact_quantiles(held, [], "utility", {"cut": 1 - share}).first()["cut"]
    calibrated = LogisticRegression(featuresCol="u", labelCol="label", regParam=0.1 / facts["n"], standardization=False, maxIter=200, tol=1e-9)
    slope = calibrated.fit(held.select(array_to_vector(F.array("utility")).alias("u"), "label")).coefficients[0]
    return RankModel(weights, float(cut), float(max(slope, 1e-6)), share)


def train_on(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality") -> RankModel:
    """Learn from all labelled documents outside fold 0."""
    return fit(measured(docs, key, text), labels, key, label)


def measured_score(x: str, model: RankModel, threshold: float = THRESHOLD) -> Column:
    """Score of measured features, 0 to 1; the quantile cut lies at ``threshold``."""
    if not model.weights:
        return F.lit(model.base)
    margin = F.lit(model.slope) * (_dot(x, model.weights) - model.cut) + float(np.log(threshold / (1 - threshold)))
    return 1 / (1 + F.exp(-F.greatest(F.least(margin, F.lit(30.0)), F.lit(-30.0))))


def quality_score(text: Column, model: RankModel, threshold: float = THRESHOLD) -> Column:
    """Score of whole texts, 0 to 1; the quantile cut lies at ``threshold``."""
    weights, shift = np.array(model.weights), float(np.log(threshold / (1 - threshold)))

    @F.pandas_udf("double")
    def score(batch: pd.Series) -> pd.Series:
        if not len(weights):
            return pd.Series(np.full(len(batch), model.base))
        utility = np.array([features(t) @ weights for t in batch], dtype=float)
        return pd.Series(1 / (1 + np.exp(-np.clip(model.slope * (utility - model.cut) + shift, -30, 30))))

    return score(text)


def rank(docs: DataFrame, model: RankModel, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with score and predicted; an input column of these names is replaced."""
    scored = docs.withColumn("score", quality_score(F.col(text), model, threshold))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def op2_quality(spark, sf_dir: str) -> DataFrame:
    """Quality of every document: doc_id, held_out, score, predicted."""
    rows = measured(read_table(spark, sf_dir, "documents"))
    scored = rows.withColumn("score", measured_score("x", fit(rows, read_table(spark, sf_dir, "labels"))))
    predicted = (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    return scored.select(F.col("key").alias("doc_id"), (fold(F.col("key"), 5) == 0).alias("held_out"), "score", predicted)

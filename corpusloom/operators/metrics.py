"""Evaluation of binary scores: cell counts, curves, thresholds, intervals, reports.

Rows are first reduced to one row per distinct score (and group), with positives and
negatives as counts. Curves are running totals over that table; see
:func:`ranking.running_totals` for how they avoid a single ordered task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import settings
from ..session import cut_lineage, local_rows
from .ranking import range_edges, running_totals

_VECTOR_ROWS = 1024
_MOST_RANGES, _RANGE_ROWS = 2048, 100_000

METRICS = ("accuracy", "f1", "f2", "precision", "recall", "specificity", "mcc", "roc_auc", "pr_auc", "brier")
_CELLS = ("tp", "fp", "fn", "tn")


def confusion(df: DataFrame, y: str, pred: str, by: Sequence[str] = ()) -> DataFrame:
    """Rows per (actual, predicted) pair, for any number of classes."""
    return df.groupBy(*by, y, pred).agg(F.count("*").alias("n"))


def cell_counts(y: Column, pred: Column, weight: Column | None = None) -> dict[str, Column]:
    """The four cells as aggregate expressions, optionally weighted."""
    w = F.lit(1).cast("long") if weight is None else weight
    flags = {
        "tp": (y == 1) & (pred == 1),
        "fp": (y == 0) & (pred == 1),
        "fn": (y == 1) & (pred == 0),
        "tn": (y == 0) & (pred == 0),
    }
    return {name: F.coalesce(F.sum(F.when(flag, w).otherwise(0)), F.lit(0)) for name, flag in flags.items()}


def _ratio(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def fbeta(precision: Column, recall: Column, beta: float) -> Column:
    b2 = beta * beta
    return _ratio((1 + b2) * precision * recall, b2 * precision + recall)


def rates(tp: Column, fp: Column, fn: Column, tn: Column) -> dict[str, Column]:
    """Threshold metrics from the four cells; 0 where a denominator is 0."""
    tp, fp, fn, tn = (c.cast("double") for c in (tp, fp, fn, tn))
    precision, recall = _ratio(tp, tp + fp), _ratio(tp, tp + fn)
    # One root per factor: the product of four counts would lose digits.
    root = F.sqrt(tp + fp) * F.sqrt(tp + fn) * F.sqrt(tn + fp) * F.sqrt(tn + fn)
    return {
        "accuracy": _ratio(tp + tn, tp + fp + fn + tn),
        "f1": fbeta(precision, recall, 1.0),
        "f2": fbeta(precision, recall, 2.0),
        "precision": precision,
        "recall": recall,
        "specificity": _ratio(tn, tn + fp),
        "mcc": _ratio(tp * tn - fp * fn, root),
    }


def threshold_metrics(df: DataFrame, y: str, pred: str, by: Sequence[str] = ()) -> DataFrame:
    cells = df.groupBy(*by).agg(*[c.alias(n) for n, c in cell_counts(F.col(y), F.col(pred)).items()])
    return cells.select(*by, *[c.alias(n) for n, c in rates(*[F.col(c) for c in _CELLS]).items()])


def score_table(df: DataFrame, y: str, score: str, by: Sequence[str] = (), weight: str | None = None) -> DataFrame:
    """One row per (group, distinct score): positives, negatives."""
    w = F.lit(1).cast("long") if weight is None else F.col(weight)
    return df.groupBy(*by, F.col(score).alias("score")).agg(
        F.sum(F.when(F.col(y) == 1, w).otherwise(0)).alias("pos"),
        F.sum(F.when(F.col(y) == 1, 0).otherwise(w)).alias("neg"),
    )


def cumulative(df: DataFrame, y: str, score: str, by: Sequence[str] = (), weight: str | None = None) -> DataFrame:
    """Score table with counts at or above each score (``tp``, ``fp``) and group totals."""
    table = score_table(df, y, score, by, weight)
    if weight is not None:
        table = table.filter((F.col("pos") > 0) | (F.col("neg") > 0))
    edges = range_edges(table.select("score").distinct() if by else table, "score")
    summed = running_totals(table, list(by), "score", {"tp": "pos", "fp": "neg"}, edges=edges)
    sums = (F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"))
    if by:
        return summed.join(table.groupBy(*by).agg(*sums), list(by))
    totals = table.agg(F.struct(*sums)).scalar()
    return summed.withColumns({"n_pos": totals["n_pos"], "n_neg": totals["n_neg"]})


def curve_areas(cum: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """ROC-AUC and trapezoid PR-AUC per group from :func:`cumulative`.

    The ROC term of a score is neg * (pos above + pos / 2); without positives the PR curve
    is the straight line from (1, 0) to (0, 1). The PR trapezoid needs the
    previous point of the curve, which is the cumulative count without the own row, so
    no further window is needed. Its first point is recall 0, precision 1.
    """
    tp, fp, pos, neg = (F.col(c).cast("double") for c in ("tp", "fp", "pos", "neg"))
    before_tp, before_fp = tp - pos, fp - neg
    roc = F.sum(neg * (before_tp + pos / 2))
    precision = tp / (tp + fp)
    before = F.when(before_tp + before_fp > 0, before_tp / (before_tp + before_fp)).otherwise(F.lit(1.0))
    pr = F.sum(pos * (precision + before) / 2)
    totals = (F.first("n_pos").cast("double"), F.first("n_neg").cast("double"))
    return cum.groupBy(*by).agg(
        F.try_divide(roc, totals[0] * totals[1]).alias("roc_auc"),
        F.when(totals[0] > 0, F.try_divide(pr, totals[0])).otherwise(F.lit(0.5)).alias("pr_auc"),
    )


def binary_metrics(
    df: DataFrame, y: str, pred: str, score: str | None = None, by: Sequence[str] = ()
) -> DataFrame:
    """All metrics in wide form, one row per group; ROC-AUC is null with one class only."""
    by = list(by)
    brier = [] if score is None else [F.avg(F.pow(F.col(score) - F.col(y), F.lit(2))).alias("brier")]
    cells = df.groupBy(*by).agg(*[c.alias(n) for n, c in cell_counts(F.col(y), F.col(pred)).items()], *brier)
    wide = cells.select(
        *by, *[c.alias(n) for n, c in rates(*[F.col(c) for c in _CELLS]).items()],
        *(["brier"] if brier else []),
    )
    if score is None:
        return wide
    areas = curve_areas(cumulative(df, y, score, by), by)
    if by:
        return wide.join(areas, by).select(*by, *METRICS)
    both = areas.select(F.struct("roc_auc", "pr_auc")).scalar()
    return wide.withColumns({"roc_auc": both["roc_auc"], "pr_auc": both["pr_auc"]}).select(*METRICS)


def long_metrics(wide: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(group, metric, value) rows; metrics without a value are left out."""
    names = [m for m in METRICS if m in wide.columns]
    return wide.unpivot(list(by), names, "metric", "value").filter(F.col("value").isNotNull())


def best_threshold(df: DataFrame, y: str, score: str, beta: float = 2.0, by: Sequence[str] = ()) -> DataFrame:
    """Score with the highest F-beta when used as ``score >= threshold``; ties to the lowest.

    The default is 0.5 when there is no score at all.
    """
    cum = cumulative(df, y, score, by)
    b2 = beta * beta
    tp, fp = F.col("tp").cast("double"), F.col("fp").cast("double")
    precision = tp / (tp + fp)
    recall = F.when(F.col("n_pos") > 0, tp / F.col("n_pos")).otherwise(F.lit(1.0))
    value = F.when(precision + recall == 0, F.lit(0.0)).otherwise(
        (1 + b2) * (precision * recall) / (b2 * precision + recall + 1e-12)
    )
    best = F.max(F.struct(value.alias("value"), (-F.col("score")).alias("minus")))
    out = cum.groupBy(*by).agg(best.alias("b"))
    return out.select(
        *by, F.coalesce(-F.col("b.minus"), F.lit(0.5)).alias("threshold"), F.col("b.value").alias("fbeta")
    )


def risk_cutoffs(
    df: DataFrame,
    y: str,
    score: str,
    by: Sequence[str] = (),
    low_default: float = settings.TIER_LOW,
    high_default: float = settings.TIER_HIGH,
    npv_target: float = 0.90,
    precision_target: float = 0.80,
) -> DataFrame:
    """Low / high cutoffs from validation targets.

    low: the largest score t with NPV(score < t) at the target; high: the smallest t with
    precision(score >= t) at the target; both clipped, crossed ones replaced by defaults.
    """
    cum = cumulative(df, y, score, by)
    tp, fp = F.col("tp").cast("double"), F.col("fp").cast("double")
    below = F.col("n_pos") + F.col("n_neg") - F.col("tp") - F.col("fp")
    npv = (F.col("n_neg") - F.col("fp")).cast("double") / below
    found = cum.groupBy(*by).agg(
        F.max(F.when((below > 0) & (F.when(below > 0, npv) >= npv_target), F.col("score"))).alias("low"),
        F.min(F.when(tp / (tp + fp) >= precision_target, F.col("score"))).alias("high"),
    )
    low = F.greatest(F.least(F.coalesce("low", F.lit(low_default)), F.lit(0.55)), F.lit(0.15))
    high = F.greatest(F.least(F.coalesce("high", F.lit(high_default)), F.lit(0.90)), F.lit(0.55))
    return found.select(
        *by,
        F.when(low >= high, F.lit(low_default)).otherwise(low).alias("low"),
        F.when(low >= high, F.lit(high_default)).otherwise(high).alias("high"),
    )


# Upper bounds, in 2**-32 units, of the Poisson(1) distribution function at 0, 1, 2, ...
def _poisson_bounds() -> list[int]:
    bounds, term, total, k = [], 0.36787944117144233, 0.0, 0
    while total < 1.0 - 1e-10:
        total += term
        bounds.append(int(total * 4294967296))
        k += 1
        term /= k
    return bounds


def replicate_weights(keys: Sequence, n: int, seed: int) -> np.ndarray:
    """Poisson(1) weights of rows (first axis) in ``n`` replicates, four from every MD5 of seed, block and key."""
    heads = [f"{seed}:{block}:".encode() for block in range(-(-n // 4))]
    tails = [str(k).encode() for k in keys]
    digests = b"".join(hashlib.md5(head + tail).digest() for tail in tails for head in heads)
    draws = np.frombuffer(digests, dtype=">u4").reshape(len(tails), -1)[:, :n]
    return np.searchsorted(np.array(_poisson_bounds(), dtype=np.uint64), draws, side="right").astype(np.int64)


_CELL_ROWS = "score double, place int, pos binary, neg binary, cells binary"


def _score_vectors(n: int, seed: int, edges: list[float]):
    """Rows per score with the weights of its positives and negatives in all replicates; plus cell totals per task."""

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, held = np.zeros((5, n)), {}

        def packed() -> pa.RecordBatch:
            value = np.array(list(held))
            pos, neg = (np.stack([v[i] for v in held.values()]) for i in range(2))
            return _vector_batch(value, np.searchsorted(edges, value, side="right"), pos, neg, None)

        for batch in batches:
            for start in range(0, batch.num_rows, _VECTOR_ROWS):
                key, y, pred, score = (c.slice(start, _VECTOR_ROWS) for c in batch.columns)
                weights = replicate_weights(key.to_pylist(), n, seed)
                y, pred, score = (c.to_numpy(zero_copy_only=False) for c in (y, pred, score))
                for i, flag in enumerate(((y == 1) & (pred == 1), (y == 0) & (pred == 1), (y == 1) & (pred == 0), (y == 0) & (pred == 0))):
                    cells[i] += weights[flag].sum(axis=0)
                cells[4] += ((score - y) ** 2) @ weights
                order = np.argsort(score, kind="stable")
                at = np.flatnonzero(np.r_[True, score[order][1:] != score[order][:-1]])
                pos = np.add.reduceat(np.where((y == 1)[order][:, None], weights[order], 0), at)
                neg = np.add.reduceat(np.where((y == 1)[order][:, None], 0, weights[order]), at)
                for value, more_pos, more_neg in zip(score[order][at].tolist(), pos, neg):
                    if value in held:
                        held[value] = held[value][0] + more_pos, held[value][1] + more_neg
                    else:
                        held[value] = more_pos, more_neg
                if len(held) > _VECTOR_ROWS:
                    yield packed()
                    held.clear()
        if held:
            yield packed()
        yield _vector_batch(np.zeros(1), np.full(1, -1), np.zeros((1, 0), np.int64), np.zeros((1, 0), np.int64), cells)

    return vectors


def _vector_batch(score, place, pos, neg, cells) -> pa.RecordBatch:
    packed = [pa.array([v.astype("<i8").tobytes() for v in x], pa.binary()) for x in (pos, neg)]
    last = pa.nulls(len(score), pa.binary()) if cells is None else pa.array([cells.astype("<f8").tobytes()], pa.binary())
    names = [c.split()[0] for c in _CELL_ROWS.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(score, pa.float64()), pa.array(place, pa.int32()), *packed, last], names=names)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, float, np.ndarray, np.ndarray]]:
    """(range, score, pos, neg) of sorted rows, equal scores added up."""
    now = None
    for batch in batches:
        for place, score, pos, neg in zip(*(batch.column(c).to_pylist() for c in ("place", "score", "pos", "neg"))):
            pos, neg = np.frombuffer(pos, dtype="<i8"), np.frombuffer(neg, dtype="<i8")
            if now is not None and now[:2] == (place, score):
                now = (place, score, now[2] + pos, now[3] + neg)
            else:
                if now is not None:
                    yield now
                now = (place, score, pos, neg)
    if now is not None:
        yield now


_RANGE_TOTALS = "place int, pos binary, neg binary"
_RANGE_AREAS = "place int, roc binary, pr binary"


def _range_totals(n: int):
    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for place, pos, neg in zip(*(batch.column(c).to_pylist() for c in ("place", "pos", "neg"))):
                sums = held.setdefault(place, np.zeros((2, n), dtype=np.int64))
                sums[0] += np.frombuffer(pos, dtype="<i8")
                sums[1] += np.frombuffer(neg, dtype="<i8")
        places = sorted(held)
        columns = [pa.array([held[p][i].tobytes() for p in places], pa.binary()) for i in range(2)]
        yield pa.RecordBatch.from_arrays([pa.array(places, pa.int32()), *columns], names=["place", "pos", "neg"])

    return totals


def _range_areas(n: int, above: dict[int, np.ndarray]):
    """Contributions of a range to both areas, from the counts above it and its own scores in falling order."""

    def areas(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        place_now, tp, fp = None, None, None
        for place, _, pos, neg in _runs(batches):
            if place != place_now:
                place_now, (tp, fp) = place, above[place].astype(float)
                sums[place] = np.zeros((2, n))
            with np.errstate(divide="ignore", invalid="ignore"):
                before = np.where(tp + fp > 0, tp / (tp + fp), 1.0)
                sums[place][0] += neg * (tp + pos / 2)
                tp, fp = tp + pos, fp + neg
                sums[place][1] += np.where(pos > 0, pos * (tp / (tp + fp) + before) / 2, 0.0)
        places = sorted(sums)
        columns = [pa.array([sums[p][i].tobytes() for p in places], pa.binary()) for i in range(2)]
        yield pa.RecordBatch.from_arrays([pa.array(places, pa.int32()), *columns], names=["place", "roc", "pr"])

    return areas


def bootstrap(
    df: DataFrame, key: str, y: str, pred: str, score: str, n: int = 400, seed: int = settings.SEED
) -> DataFrame:
    """Percentile 95 % intervals of all metrics: (metric, lower, upper, n_replicates).

    Poisson bootstrap: every row gets an independent Poisson(1) weight per replicate,
    so no resample is ever built. The total size of a replicate is random, which is the
    usual large-sample substitute for drawing exactly n rows; one-class replicates are skipped.

    The weights of a row in all replicates are one vector, and the rows of a score are added up per Arrow batch, so what is shuffled
    is at most one row per input row, whatever ``n`` is. Vectors are placed by ranges of the score; the totals of the
    ranges, at most ``_MOST_RANGES`` vectors, give every range the counts above it, and each range then adds its part of all
    curves.
    """
    spark = df.sparkSession
    ranges = min(_MOST_RANGES, 64 + df.count() // _RANGE_ROWS)
    edges = range_edges(df.select(F.col(score).cast("double").alias("s")).distinct(), "s", 64 * ranges, ranges)
    rows = df.select(
        F.col(key).cast("string").alias("k"), F.col(y).cast("int").alias("y"), F.col(pred).cast("int").alias("p"), F.col(score).cast("double").alias("s")
    ).filter("k is not null and y is not null and p is not null and s is not null")
    found = cut_lineage(rows.mapInArrow(_score_vectors(n, seed, edges), _CELL_ROWS))
    cells = np.zeros((5, n))
    for row in found.filter("place < 0").select("cells").toLocalIterator():
        cells += np.frombuffer(row.cells, dtype="<f8").reshape(5, n)
    vectors = found.filter("place >= 0").drop("cells")
    totals: dict[int, np.ndarray] = {}
    for row in vectors.mapInArrow(_range_totals(n), _RANGE_TOTALS).toLocalIterator():
        sums = totals.setdefault(row.place, np.zeros((2, n), dtype=np.int64))
        sums += np.stack([np.frombuffer(row.pos, dtype="<i8"), np.frombuffer(row.neg, dtype="<i8")])
    above, running = {}, np.zeros((2, n), dtype=np.int64)
    for place in sorted(totals, reverse=True):
        above[place], running = running, running + totals[place]
    placed = vectors.repartition("place").sortWithinPartitions("place", F.desc("score"))
    roc, pr = np.zeros(n), np.zeros(n)
    for row in placed.mapInArrow(_range_areas(n, above), _RANGE_AREAS).toLocalIterator():
        roc, pr = roc + np.frombuffer(row.roc, dtype="<f8"), pr + np.frombuffer(row.pr, dtype="<f8")

    tp, fp, fn, tn, error = cells
    each = local_rows(
        spark, list(zip(*(x.tolist() for x in (np.arange(n), tp, fp, fn, tn, error, roc, pr)))),
        "replicate int, tp double, fp double, fn double, tn double, error double, roc double, pr double",
    )
    positives, negatives = F.col("tp") + F.col("fn"), F.col("fp") + F.col("tn")
    wide = each.filter((positives > 0) & (negatives > 0)).select(
        "replicate", *[c.alias(m) for m, c in rates(*[F.col(c) for c in _CELLS]).items()],
        (F.col("error") / (positives + negatives)).alias("brier"),
        (F.col("roc") / (positives * negatives)).alias("roc_auc"), (F.col("pr") / positives).alias("pr_auc"),
    )
    q = F.percentile("value", [0.025, 0.975])  # over the replicates
    return long_metrics(wide, ["replicate"]).groupBy("metric").agg(q.alias("q"), F.count("*").alias("n_replicates")).select(
        "metric", F.col("q")[0].alias("lower"), F.col("q")[1].alias("upper"), "n_replicates"
    )


def report(df: DataFrame, y: str, pred: str) -> DataFrame:
    """Per-class precision / recall / F1 / support, accuracy, macro and weighted averages."""
    pairs = df.groupBy(y, pred).agg(F.count("*").alias("n"))
    actual = pairs.groupBy(F.col(y).cast("string").alias("class")).agg(
        F.sum("n").alias("support"), F.sum(F.when(F.col(y) == F.col(pred), F.col("n")).otherwise(0)).alias("hit")
    )
    guessed = pairs.groupBy(F.col(pred).cast("string").alias("class")).agg(F.sum("n").alias("guessed"))
    joined = actual.join(guessed, "class", "full").na.fill(0)
    precision, recall = _ratio(F.col("hit"), F.col("guessed")), _ratio(F.col("hit"), F.col("support"))
    per_class = joined.select(
        "class", precision.alias("precision"), recall.alias("recall"),
        fbeta(precision, recall, 1.0).alias("f1"), F.col("support").cast("long").alias("support"), "hit",
    )
    names = ("precision", "recall", "f1")
    summary = per_class.agg(
        *[F.avg(c).alias(f"m_{c}") for c in names],
        *[_ratio(F.sum(F.col(c) * F.col("support")), F.sum("support")).alias(f"w_{c}") for c in names],
        _ratio(F.sum("hit"), F.sum("support")).alias("acc"),
        F.sum("support").alias("support"),
    )
    rows = F.array(
        F.struct(F.lit("accuracy").alias("class"), *[F.col("acc").alias(c) for c in names], F.col("support")),
        F.struct(F.lit("macro avg").alias("class"), *[F.col(f"m_{c}").alias(c) for c in names], F.col("support")),
        F.struct(F.lit("weighted avg").alias("class"), *[F.col(f"w_{c}").alias(c) for c in names], F.col("support")),
    )
    return per_class.drop("hit").unionByName(summary.select(F.inline(rows)))


def multiclass_report(df: DataFrame, y: str, pred: str) -> DataFrame:
    """:func:`report` for any number of classes with micro averages: one k x k count table serves all rows.

    Micro averages pool the decisions of all classes. A class that is only ever guessed counts with recall 0.
    """
    cells = confusion(df, y, pred)
    own = F.when(F.col(y) == F.col(pred), F.col("n")).otherwise(0)
    sides = cells.select(
        F.inline(F.array(
            F.struct(F.col(y).cast("string").alias("class"), F.col("n").alias("support"), F.lit(0).cast("long").alias("guessed"), own.cast("long").alias("hit")),
            F.struct(F.col(pred).cast("string").alias("class"), F.lit(0).cast("long").alias("support"), F.col("n").alias("guessed"), F.lit(0).cast("long").alias("hit")),
        ))
    )
    sums = sides.groupBy("class").agg(*[F.sum(c).alias(c) for c in ("support", "guessed", "hit")])
    precision, recall = _ratio(F.col("hit"), F.col("guessed")), _ratio(F.col("hit"), F.col("support"))
    each = sums.select("class", precision.alias("precision"), recall.alias("recall"), fbeta(precision, recall, 1.0).alias("f1"), "support", "guessed", "hit")
    names = ("precision", "recall", "f1")
    total = each.agg(
        *[F.avg(c).alias(f"macro_{c}") for c in names],
        *[_ratio(F.sum(F.col(c) * F.col("support")), F.sum("support")).alias(f"weighted_{c}") for c in names],
        _ratio(F.sum("hit"), F.sum("guessed")).alias("p"), _ratio(F.sum("hit"), F.sum("support")).alias("r"), F.sum("support").alias("support"),
    ).withColumns({"micro_precision": F.col("p"), "micro_recall": F.col("r"), "micro_f1": fbeta(F.col("p"), F.col("r"), 1.0)})
    averages = F.array(*[
        F.struct(F.lit(f"{kind} avg").alias("class"), *[F.col(f"{kind}_{c}").alias(c) for c in names], "support") for kind in ("macro", "micro", "weighted")
    ])
    return each.drop("guessed", "hit").unionByName(total.select(F.inline(averages)))


def one_against_rest(df: DataFrame, y: str, scores: str) -> DataFrame:
    """(class, y, score) rows: every class of the score map against all others; other columns stay."""
    long = df.select(*[c for c in df.columns if c not in (y, scores)], F.col(y).cast("string").alias("_y"), F.explode(scores).alias("class", "score"))
    return long.withColumn("y", F.coalesce(F.col("_y") == F.col("class"), F.lit(False)).cast("int")).drop("_y")


def class_areas(df: DataFrame, y: str, scores: str) -> DataFrame:
    """(class, roc_auc, pr_auc) of a map of class scores, each class against the rest."""
    return curve_areas(cumulative(one_against_rest(df.select(y, scores), y, scores), "y", "score", ["class"]), ["class"])


def class_roc_points(df: DataFrame, y: str, scores: str) -> DataFrame:
    """ROC points of every class against the rest."""
    return roc_points(one_against_rest(df.select(y, scores), y, scores), "y", "score", ["class"])


def reliability(df: DataFrame, y: str, score: str) -> DataFrame:
    """Mean score and share of positives per uniform bin; empty bins are dropped.

    The number of bins is rows / 80 between 3 and 10. A score on an edge belongs to
    the lower bin. Scores are counted first, so bins see distinct scores only.
    """
    table = score_table(df, y, score)
    n = df.agg(F.count("*")).scalar()
    bins = F.least(F.greatest(F.floor(n / 80), F.lit(3)), F.lit(10)).cast("int")
    step = F.lit(1.0) / F.col("_bins")
    place = F.lit(0)
    for j in range(1, 10):
        place = place + ((F.lit(j) < F.col("_bins")) & (F.lit(j) * step < F.col("score"))).cast("int")
    rows = F.sum(F.col("pos") + F.col("neg"))
    return table.withColumn("_bins", bins).groupBy(place.alias("bin")).agg(
        (F.sum(F.col("score") * (F.col("pos") + F.col("neg"))) / rows).alias("mean_score"),
        (F.sum("pos") / rows).alias("share_positive"),
        rows.alias("n"),
    )


def roc_points(df: DataFrame, y: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """False and true positive rate at every distinct score."""
    cum = cumulative(df, y, score, by)
    return cum.select(
        *by, "score",
        F.try_divide(F.col("fp").cast("double"), F.col("n_neg")).alias("fpr"),
        F.try_divide(F.col("tp").cast("double"), F.col("n_pos")).alias("tpr"),
    )


def pr_points(df: DataFrame, y: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Precision and recall at every distinct score (the end point 1, 0 is implied)."""
    cum = cumulative(df, y, score, by)
    tp = F.col("tp").cast("double")
    return cum.select(
        *by, "score", (tp / (F.col("tp") + F.col("fp"))).alias("precision"),
        F.try_divide(tp, F.col("n_pos")).alias("recall"),
    )


def error_cases(df: DataFrame, y: str, score: str, threshold: float, row_key: str, n: int = 100) -> DataFrame:
    """The ``n`` wrong rows farthest from the threshold, ties by row key."""
    pred = (F.col(score) >= threshold).cast("int")
    wrong = df.withColumn("prediction", pred).filter(F.col(y) != F.col("prediction"))
    marked = wrong.withColumns(
        {
            "error_type": F.when(F.col("prediction") == 1, "false_positive").otherwise("false_negative"),
            "distance_from_threshold": F.abs(F.col(score) - threshold),
        }
    )
    return marked.orderBy(F.desc("distance_from_threshold"), row_key).limit(n)


def leaderboard(metrics: DataFrame, value: str) -> DataFrame:
    """Models with their place by a metric, best first; ties share the better place.

    One row per model, so ranking them in one task is cheap.
    """
    order = W.partitionBy(F.lit(0)).orderBy(F.desc(value))
    return metrics.withColumn("place", F.rank().over(order))


def winner(metrics: DataFrame, first: str, second: str, tie_band: float = 0.005, to: str = "winner") -> DataFrame:
    """Name of the better column, or "tie" within the band; a missing ``second`` loses."""
    gap = F.col(second) - F.col(first)
    choice = (
        F.when(F.col(second).isNull(), first)
        .when(gap > tie_band, second)
        .when(-gap > tie_band, first)
        .otherwise("tie")
    )
    return metrics.withColumn(to, choice)


def user_prf(df: DataFrame, user: str, y: str, pred: str) -> DataFrame:
    """Precision, recall and F1 of the positive class over users, not posts.

    A user is positive when any of its rows is.
    """
    users = df.groupBy(user).agg(F.max(y).alias(y), F.max(pred).alias(pred))
    return threshold_metrics(users, y, pred).select("precision", "recall", "f1")

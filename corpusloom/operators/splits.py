"""Reproducible splits, caps, folds, weights and balanced orders.

Membership follows the hash order of a unique key, so it survives repartitioning and
can be recomputed by any engine.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from .. import settings
from ..session import SmallTable, local_rows, small_rows, small_table
from .labelling import majority_label
from .ranking import bucket_count, grouped_rank, hash_cells, hash_order, largest_remainder, null_safe_join, strata_counts

_MIN_SOURCES = 3


def _counts(df: DataFrame, strata: Sequence[str]) -> tuple[DataFrame, int, int]:
    """(counts per stratum, all rows, smallest stratum)."""
    table = small_table(strata_counts(df, strata))
    return (table.frame, *_size_and_least(table))


def _size_and_least(table: SmallTable) -> tuple[int, int]:
    if table.is_local:
        sizes = [row.n for row in table.rows]
        return sum(sizes), min(sizes, default=0)
    row = table.frame.agg(F.sum("n").alias("n"), F.min("n").alias("least")).first()
    return int(row.n), int(row.least)


def _merge(counts: DataFrame, strata: Sequence[str]) -> DataFrame:
    return counts.groupBy(*strata).agg(F.sum("n").alias("n"))


def take(df: DataFrame, strata: Sequence[str], key: str, total: int, seed: int, to: str, counts: DataFrame | None = None, rows: int | None = None) -> DataFrame:
    """Mark (``to`` true) ``total`` rows, spread over the strata in proportion."""
    if counts is None or rows is None:
        counts, rows, _ = _counts(df, strata)
    quotas = largest_remainder(counts, min(total, rows), strata)
    cuts = quotas.select(*strata, F.array("quota").alias("upto"))
    return hash_cells(df, strata, key, seed, cuts, rows, "_cell").withColumn(to, F.col("_cell") == 0).drop("_cell")


def stratified(
    df: DataFrame,
    key: str,
    label: str,
    source: str | None = None,
    ratios: tuple[float, float, float] = (settings.TRAIN_RATIO, settings.VAL_RATIO, settings.TEST_RATIO),
    seed: int = settings.SEED,
    to: str = "split_name",
) -> DataFrame:
    """Train / val / test by source and label, or by label alone.

    The test cut falls back to label strata when the smallest stratum has fewer than 3
    rows, the validation cut when it has fewer than 2 rows left.
    """
    train, val, test = ratios
    if abs(train + val + test - 1.0) > 1e-6:
        raise ValueError("train, val and test ratios must sum to 1")
    by_label = [label]
    strata = [source, label] if source else by_label
    counts, n, least = _counts(df, strata)
    if n == 0:
        return df.withColumn(to, F.lit(None).cast("string"))
    n_test = math.ceil(n * test)
    n_val = math.ceil((n - n_test) * (val / (train + val)))
    first = strata if least >= 3 else by_label
    test_quota = largest_remainder(counts if first == strata else _merge(counts, first), n_test, first)
    if first == strata:
        # Both cuts run over the same strata: one pass with two cut points.
        rest = test_quota.withColumns({"_test": F.col("quota"), "n": F.col("n") - F.col("quota")}).drop("quota")
        table = small_table(rest)
        if _size_and_least(table)[1] >= 2:
            both = largest_remainder(table.frame, n_val, strata)
            cuts = both.select(*strata, F.array("_test", F.col("_test") + F.col("quota")).alias("upto"))
            cells = hash_cells(df, strata, key, seed, cuts, n, "_cell")
            name = F.element_at(F.array(F.lit("test"), F.lit("val"), F.lit("train")), F.col("_cell") + 1)
            return cells.withColumn(to, name).drop("_cell")
    marked = take(df, first, key, n_test, seed, "_test")
    remaining = marked.filter(~F.col("_test"))
    rest_counts, _, rest_least = _counts(remaining, strata)
    second = strata if rest_least >= 2 else by_label
    picked = take(remaining, second, key, n_val, seed, "_val")
    name = F.when(F.col("_val"), "val").otherwise("train")
    return picked.withColumn(to, name).drop("_test", "_val").unionByName(
        marked.filter("_test").withColumn(to, F.lit("test")).drop("_test")
    )


def grouped(
    df: DataFrame,
    key: str,
    label: str,
    group: str = "source_id",
    ratios: tuple[float, float, float] = (settings.TRAIN_RATIO, settings.VAL_RATIO, settings.TEST_RATIO),
    seed: int = settings.SEED,
    to: str = "split_name",
) -> DataFrame:
    """Whole groups to one split, stratified on each group's majority label.

    Ratios apply to the number of groups. Fewer than three groups fall back to the
    row split by label. The assignment is made on the group table and joined back.
    """
    groups = small_table(majority_label(df, group, label))
    n = len(groups.rows) if groups.is_local else groups.frame.count()
    if n < _MIN_SOURCES:
        return stratified(df, key, label, None, ratios, seed, to)
    train, val, test = ratios
    n_test = math.ceil(n * test)
    n_val = math.ceil((n - n_test) * (val / max(train + val, 1e-9)))
    first = take(groups.frame, ["majority"], group, n_test, seed, "_test")
    rest = take(first.filter(~F.col("_test")), ["majority"], group, n_val, seed, "_val")
    names = rest.select(group, F.when(F.col("_val"), "val").otherwise("train").alias(to)).unionByName(
        first.filter("_test").select(group, F.lit("test").alias(to))
    )
    return null_safe_join(df, small_table(names).frame, [group])


def holdout(df: DataFrame, key: str, label: str, fraction: float = settings.HOLDOUT_FRACTION, seed: int = settings.SEED, to: str = "held_out") -> DataFrame:
    """Label-stratified two-way cut; true for the held-out rows."""
    counts, n, _ = _counts(df, [label])
    return take(df, [label], key, math.ceil(n * fraction), seed, to, counts, n)


def calibration_halves(df: DataFrame, key: str, label: str, seed: int = settings.SEED) -> tuple[DataFrame, DataFrame]:
    """(calibration, selection) halves; the same frame twice if under 20 rows or one class."""
    counts, n, _ = _counts(df, [label])
    if n < 20 or counts.count() < 2:
        return df, df
    marked = take(df, [label], key, math.ceil(n * 0.5), seed, "_select", counts, n)
    return marked.filter(~F.col("_select")).drop("_select"), marked.filter("_select").drop("_select")


def cap(df: DataFrame, key: str, label: str, rows: int = settings.MAX_TRAIN_ROWS, seed: int = settings.SEED) -> DataFrame:
    """Label-stratified subsample of at most ``rows`` rows."""
    counts, n, _ = _counts(df, [label])
    if n <= rows:
        return df
    return take(df, [label], key, rows, seed, "_keep", counts, n).filter("_keep").drop("_keep")


def random_split(df: DataFrame, key: str, fraction: float, seed: int = settings.SEED, to: str = "split_name") -> DataFrame:
    """Unstratified split by hash threshold: no count, no shuffle."""
    unit = F.conv(F.substring(hash_order(key, seed), 1, 8), 16, 10).cast("long") / F.lit(4294967296.0)
    return df.withColumn(to, F.when(unit < fraction, "test").otherwise("train"))


def sample_per_group(df: DataFrame, group: str, key: str, seed: int = settings.SEED) -> DataFrame:
    """One pseudo-random row per group: the smallest hash, found by partial aggregation."""
    order = F.conv(F.substring(hash_order(key, seed), 1, 15), 16, 10).cast("long")
    chosen = df.select(group, key, order.alias("_o")).groupBy(group).agg(F.min_by(key, "_o").alias(key))
    return df.join(chosen.select(key), key, "left_semi")


def class_weights(df: DataFrame, label: str, to: str = "weight") -> DataFrame:
    """Balanced weights n / (classes * rows of the class); a null label is a class of its own."""
    counts, n, _ = _counts(df, [label])
    k = counts.count()
    weights = counts.select(label, (F.lit(float(n)) / (F.lit(float(k)) * F.col("n"))).alias(to))
    return null_safe_join(df, weights, [label])


def balanced_rows(df: DataFrame, label: str, oversample: bool = True) -> float:
    """Rows that a balanced fit sees: the sum of the copies when oversampled, else the rows themselves."""
    sizes = [r.n for r in small_rows(_counts(df, [label])[0])]
    return float(len(sizes) * max(sizes, default=0) if oversample else sum(sizes))


def oversample(
    df: DataFrame,
    key: str,
    label: str,
    mode: str = "weight",
    seed: int = settings.SEED,
    only_between: tuple[float, float] | None = None,
) -> DataFrame:
    """Bring every class to the size of the largest.

    "weight" adds a ``weight`` column with the same expectation and no data growth.
    "copies" adds a ``copy`` number: each row floor(max/n) times, and the remainder
    once more for the first rows of the class in hash order. ``only_between`` leaves
    the data alone unless the rate of the largest numeric label lies in that range.
    """
    counts, n, _ = _counts(df, [label])
    rows = {row[label]: row.n for row in small_rows(counts)}
    biggest = max(rows.values())
    if only_between is not None:
        named = [name for name in rows if name is not None]
        rate = rows[max(named)] / n if named else 0.0
        if not only_between[0] < rate < only_between[1]:
            rows = {name: biggest for name in rows}
    if mode == "weight":
        weight = counts.select(label, (F.lit(float(biggest)) / F.col("n")).alias("weight"))
        return null_safe_join(df, weight, [label])
    if mode != "copies":
        raise ValueError("mode must be 'weight' or 'copies'")
    schema = StructType(
        [df.schema[label], StructField("times", IntegerType()), StructField("upto", ArrayType(LongType()))]
    )
    plan = local_rows(
        df.sparkSession, [(name, biggest // m, [biggest % m]) for name, m in rows.items()], schema
    )
    cells = null_safe_join(hash_cells(df, [label], key, seed, plan, n, "_cell"), plan.select(label, "times"), [label])
    copies = F.col("times") + F.when(F.col("_cell") == 0, 1).otherwise(0)
    return cells.withColumn("copy", F.explode(F.sequence(F.lit(1), copies))).drop("_cell", "times")


def fold_count(n: int, k: int = settings.CV_FOLDS) -> int:
    return min(k, max(2, n // 50))


def folds(df: DataFrame, key: str, label: str, k: int = settings.CV_FOLDS, seed: int = settings.SEED, group: str | None = None, to: str = "fold") -> DataFrame:
    """Stratified folds 0..k-1; whole groups stay together when there are enough groups."""
    counts, n, _ = _counts(df, [label])
    k = fold_count(n, k)
    if group is not None:
        assigned = _group_folds(df, label, group, k)
        if assigned is not None:
            return null_safe_join(df, assigned.withColumnRenamed("fold", to), [group])
    upto = F.array(*[F.ceil(F.col("n") * F.lit(j) / F.lit(float(k))).cast("long") for j in range(1, k)])
    return hash_cells(df, [label], key, seed, counts.select(label, upto.alias("upto")), n, to)


def _group_folds(df: DataFrame, label: str, group: str, k: int) -> DataFrame | None:
    """Greedy assignment on the group x label table; None with too few groups.

    Groups go, largest spread first, to the fold that keeps the label shares most even. The rule
    is sequential in the groups (not in rows), so the driver runs it over the counts, which are
    streamed in that order one partition at a time; null groups and labels are values of their own.
    """
    counts = strata_counts(df, [group, label])
    if counts.select(group).distinct().count() < k:
        return None
    labels = sorted((r[0] for r in small_rows(counts.select(label).distinct())), key=str)
    totals = {r[label]: r["n"] or 1 for r in small_rows(counts.groupBy(label).agg(F.sum("n").alias("n")))}
    per_group = counts.groupBy(group).agg(F.collect_list(F.struct(F.col(label).alias("label"), "n")).alias("sizes"))
    text = F.coalesce(F.col(group).cast("string"), F.lit("None"))
    ordered = per_group.orderBy(F.desc(F.array_max(F.transform("sizes", lambda s: s["n"]))), text)

    def unevenness(load: list[dict]) -> float:
        worst = 0.0
        for name in labels:
            shares = [fold[name] / totals[name] for fold in load]
            mean = sum(shares) / k
            worst += math.sqrt(sum((s - mean) ** 2 for s in shares) / k)
        return worst

    load = [dict.fromkeys(labels, 0) for _ in range(k)]
    assigned = []
    for row in ordered.toLocalIterator():
        size = dict.fromkeys(labels, 0) | {s["label"]: s["n"] for s in row["sizes"]}

        def cost(fold: int) -> tuple[float, int]:
            trial = [{c: f[c] + (size[c] if i == fold else 0) for c in labels} for i, f in enumerate(load)]
            return round(unevenness(trial), 12), sum(load[fold].values())

        best = min(range(k), key=cost)
        assigned.append((row[group], best))
        for c in labels:
            load[best][c] += size[c]
    schema = StructType([df.schema[group], StructField("fold", IntegerType())])
    return local_rows(df.sparkSession, assigned, schema)


def balanced_batches(df: DataFrame, key: str, label: str, size: int, seed: int = settings.SEED, positive=1) -> DataFrame:
    """Equal positives and negatives in every batch, interleaved.

    Rows keep their hash rank within the label; ranks beyond the smaller class are left
    out, which is what the balanced order means. They go before anything is ranked, by the hash at the cut. ``position`` runs over the kept rows.
    """
    counts, n, _ = _counts(df, [label])
    least = min((r.n for r in small_rows(counts)), default=0)
    cuts = counts.select(label, F.array(F.lit(least).cast("long")).alias("upto"))
    cut = hash_cells(df, [label], key, seed, cuts, n, "_cell").filter("_cell = 0").drop("_cell")
    kept = grouped_rank(cut, [label], key, seed, "rank", bucket_count(n))
    position = (F.col("rank") - 1) * 2 + F.when(F.col(label) == positive, 0).otherwise(1)
    return kept.withColumn("position", position).withColumn("batch", F.expr(f"position div {int(size)}"))


def positives_with_negatives(df: DataFrame, key: str, label: str, seed: int = settings.SEED, positive=1) -> DataFrame:
    """All positives and as many hash-sampled negatives, in one shuffled order.

    ``order_hash`` sorts the epoch; sort only at the edge that consumes it.
    """
    is_positive = F.col(label) == positive
    n_pos = df.filter(is_positive).count()
    negatives = df.filter(~is_positive).withColumn("_all", F.lit(0))
    kept = take(negatives, ["_all"], key, n_pos, seed, "_keep").filter("_keep").drop("_keep", "_all")
    return df.filter(is_positive).unionByName(kept).withColumn("order_hash", hash_order(key, seed + 1))

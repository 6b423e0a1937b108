"""Exploration tables: describe, correlations, histograms, shares, agreement, trends."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import cut_lineage, local_rows
from .ranking import null_safe_join

_QUARTILES = {"q25": 0.25, "q50": 0.5, "q75": 0.75}


_SKETCH = 10_000
_MARGIN = 4.0 / _SKETCH
_WHOLE = 8 * _SKETCH


def exact_quantiles(rows: DataFrame, by: Sequence[str], value: str, shares: Mapping[str, float]) -> DataFrame:
    """Exact interpolated quantiles per group, with ``n``; null values take no part.

    The first pass takes a quantile sketch per group, whose error is a known share of its rows, and so a bracket
    around every quantile. The second pass counts the rows between the brackets and keeps apart only the values
    inside them, both combined on the map side; what is ordered is a few ten-thousandths of the
    rows. Groups of up to ``_WHOLE`` rows are one bracket.
    """
    by, names = list(by), list(shares)
    known = rows.select(*by, F.col(value).cast("double").alias("v")).filter(F.col("v").isNotNull())
    edges = [min(max(q + side * _MARGIN, 0.0), 1.0) for q in shares.values() for side in (-1, 1)]
    found = known.groupBy(*by).agg(
        F.count("*").alias("n"), F.min("v").alias("least"), F.max("v").alias("most"), F.percentile_approx("v", edges, _SKETCH).alias("e")
    )
    whole = F.col("n") <= _WHOLE
    lows = F.array(*[F.when(whole, F.col("least")).otherwise(F.col("e")[2 * i]) for i in range(len(names))])
    highs = F.array(*[F.when(whole, F.col("most")).otherwise(F.col("e")[2 * i + 1]) for i in range(len(names))])
    groups = found.select(*by, "n", lows.alias("lo"), highs.alias("hi"))
    if by:
        groups = cut_lineage(groups)
        bounded = null_safe_join(known, groups.drop("n"), by)
    else:
        groups = local_rows(rows.sparkSession, [tuple(r) for r in groups.collect()], groups.schema)  # one row
        lo, hi = ([] if r is None else list(r) for r in (groups.first()[1:] if groups.first() else (None, None)))
        bounded = known.withColumns({"lo": F.array(*map(F.lit, lo)).cast("array<double>"), "hi": F.array(*map(F.lit, hi)).cast("array<double>")})
    inside = F.exists(F.arrays_zip("lo", "hi"), lambda b: F.col("v").between(b["lo"], b["hi"]))
    # a value outside every bracket is represented by the highest bracket edge below it
    region = F.coalesce(F.array_max(F.filter("hi", lambda h: h < F.col("v"))), F.lit(float("-inf")))
    placed = bounded.select(*by, F.when(inside, F.col("v")).alias("at"), F.when(~inside, region).alias("region"))
    counted = placed.groupBy(*by, "region", "at").agg(F.count("*").alias("c"))
    order = W.partitionBy(*(by or [F.lit(0)])).orderBy(F.coalesce("at", "region"), F.col("at").isNull())
    ranked = counted.withColumn("upto", F.sum("c").over(order.rowsBetween(W.unboundedPreceding, 0)))
    ranked = ranked.withColumn("n", F.sum("c").over(W.partitionBy(*(by or [F.lit(0)]))))
    position = {name: (F.col("n") - 1) * share for name, share in shares.items()}
    first = lambda p: F.min_by(F.struct("at"), F.when(F.col("upto") > p, F.col("upto")))["at"]
    picked = ranked.groupBy(*by, "n").agg(
        *[first(F.floor(p)).alias(f"{name}_lo") for name, p in position.items()],
        *[first(F.ceil(p)).alias(f"{name}_hi") for name, p in position.items()],
    )

    def between(name: str) -> Column:
        lo, hi = F.col(f"{name}_lo"), F.col(f"{name}_hi")
        value = lo + (hi - lo) * (position[name] - F.floor(position[name]))
        return F.when(lo.isNull() | hi.isNull(), F.raise_error(F.lit("a quantile lies outside its bracket")).cast("double")).otherwise(value)

    return picked.select(*by, "n", *[between(name).alias(name) for name in names])


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, std, min, quartiles and max per column, one row each."""
    wide = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    stats = wide.agg(
        *[
            F.struct(
                F.count(c).alias("n"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"), F.min(c).alias("min"), F.max(c).alias("max"),
            ).alias(c)
            for c in columns
        ]
    ).unpivot([], list(columns), "column_name", "s")
    long = wide.unpivot([], list(columns), "column_name", "value")
    found = exact_quantiles(long, ["column_name"], "value", _QUARTILES).drop("n")
    return stats.join(found, "column_name", "left").select(
        "column_name", "s.n", "s.mean", "s.std", "s.min", *_QUARTILES, "s.max"
    )


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every ordered pair, from one aggregate."""
    pairs = list(combinations_with_replacement(columns, 2))
    one = df.agg(*[F.corr(a, b).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    rows = []
    for i, (a, b) in enumerate(pairs):
        rows.append(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"c{i}").alias("r")))
        if a != b:
            rows.append(F.struct(F.lit(b).alias("a"), F.lit(a).alias("b"), F.col(f"c{i}").alias("r")))
    return one.select(F.inline(F.array(*rows)).alias("column_a", "column_b", "corr"))


def histogram(df: DataFrame, column: str, bins: int, by: Sequence[str] = ()) -> DataFrame:
    """Counts in ``bins`` equal bins between the overall minimum and maximum.

    The top edge belongs to the last bin; empty bins are absent.
    """
    value = F.col(column).cast("double")
    span = df.agg(F.struct(F.min(value).alias("lo"), F.max(value).alias("hi"))).scalar()
    lo, hi = span["lo"], span["hi"]
    place = F.floor((value - lo) * bins / (hi - lo)).cast("int")
    bin_index = F.when(lo == hi, F.lit(0)).otherwise(F.least(place, F.lit(bins - 1)))
    counts = df.filter(value.isNotNull()).groupBy(*by, bin_index.alias("bin")).agg(F.count("*").alias("n"))
    width = (hi - lo) / bins
    return counts.withColumns(
        {"bin_from": lo + F.col("bin") * width, "bin_to": lo + (F.col("bin") + 1) * width}
    )


def quartiles_by(df: DataFrame, column: str, by: str) -> DataFrame:
    """Five-number summary and mean per class."""
    rows = df.filter(F.col(column).isNotNull()).select(by, F.col(column).cast("double").alias("value"))
    out = rows.groupBy(by).agg(F.min("value").alias("min"), F.max("value").alias("max"), F.avg("value").alias("mean"))
    quartiles = exact_quantiles(rows, [by], "value", _QUARTILES)
    return null_safe_join(out, quartiles, [by]).select(by, "n", "min", *_QUARTILES, "max", "mean")


def shares(df: DataFrame, column: str) -> DataFrame:
    """Class counts and proportions of the total."""
    counts = df.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
    total = df.agg(F.count("*")).scalar()
    return counts.withColumn("share", F.col("n") / total)


def column_totals(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Column sums and each sum's share of all of them."""
    sums = df.agg(*[F.sum(F.col(c).cast("double")).alias(c) for c in columns])
    whole = sum((F.col(c) for c in columns[1:]), F.col(columns[0]))
    return sums.withColumn("_all", whole).unpivot("_all", list(columns), "column_name", "total").select(
        "column_name", "total", F.try_divide("total", "_all").alias("share")
    )


def agreement(df: DataFrame, first: str, second: str) -> DataFrame:
    """Cross-tab of two annotations with the match flag."""
    return (
        df.groupBy(first, second)
        .agg(F.count("*").alias("n"))
        .withColumn("label_match", F.coalesce(F.col(first) == F.col(second), F.lit(False)))
    )


def agreement_rate(df: DataFrame, first: str, second: str) -> DataFrame:
    """Pairs, matches and share of matches."""
    match = F.coalesce(F.col(first) == F.col(second), F.lit(False))
    return df.agg(F.count("*").alias("n"), F.count_if(match).alias("n_match")).withColumn(
        "accuracy", F.try_divide("n_match", "n")
    )


def mean_by(df: DataFrame, measure: str, by: str, order: Sequence[str]) -> DataFrame:
    """Mean of a measure per class in a given order; absent classes have a null mean."""
    classes = local_rows(df.sparkSession, list(enumerate(order)), f"position int, {by} string")
    means = df.groupBy(by).agg(F.avg(measure).alias("mean"))
    return classes.join(means, by, "left")


def monthly(df: DataFrame, date: str, unit: str = "month") -> DataFrame:
    period = F.date_format(F.date_trunc(unit, F.col(date)), "yyyy-MM-dd")
    return df.groupBy(period.alias("period")).agg(F.count("*").alias("n"))


def monthly_by(df: DataFrame, date: str, by: str, classes: Sequence[str], unit: str = "month") -> DataFrame:
    """Period by class matrix, absent combinations as 0."""
    period = F.date_format(F.date_trunc(unit, F.col(date)), "yyyy-MM-dd")
    return df.groupBy(period.alias("period")).pivot(by, list(classes)).count().na.fill(0)


def dictionary(df: DataFrame) -> DataFrame:
    """One row per column: name, type, rows and cells of the table."""
    entries = [
        F.struct(F.lit(i).alias("position"), F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("dtype"))
        for i, f in enumerate(df.schema.fields)
    ]
    return df.agg(F.count("*").alias("n_rows")).select(
        "n_rows", (F.col("n_rows") * len(df.columns)).alias("n_cells"), F.inline(F.array(*entries))
    )

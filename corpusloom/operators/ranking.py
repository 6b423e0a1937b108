"""Ranks, quotas and running totals that never put a whole group into one task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import small_table

_MAX_BUCKETS = 65_536
_ROWS_PER_BUCKET = 50_000
_SAMPLE = 4_096
_RANGES = 64


def hash_order(key: str | Column, seed: int) -> Column:
    """Reproducible pseudo-random order: SHA-256 of "key:seed" in hex."""
    key = F.col(key) if isinstance(key, str) else key
    return F.sha2(F.concat(key.cast("string"), F.lit(f":{seed}")), 256)


def _bucket(hashed: Column, buckets: int) -> Column:
    """Range bucket of a hex hash; ``buckets`` is a power of two up to 65536."""
    return F.shiftright(F.conv(F.substring(hashed, 1, 4), 16, 10).cast("int"), 16 - (buckets.bit_length() - 1))


def bucket_count(rows: int) -> int:
    """Power of two giving about ``_ROWS_PER_BUCKET`` rows per bucket."""
    wanted = max(1, rows // _ROWS_PER_BUCKET)
    return min(_MAX_BUCKETS, 1 << (wanted - 1).bit_length())


def strata_counts(df: DataFrame, strata: Sequence[str]) -> DataFrame:
    return df.groupBy(*strata).agg(F.count("*").alias("n"))


def largest_remainder(counts: DataFrame, total: int, strata: Sequence[str]) -> DataFrame:
    """Split ``total`` units over strata in proportion to ``n``; adds ``quota``.

    Floors first, then one more unit to the largest remainders (ties: stratum name). The
    table has one row per stratum, so ranking it in one task is cheap.
    """
    size = F.sum("n").over(W.partitionBy(F.lit(0)))
    # Decimals: rows times units outgrow a LONG on very large tables.
    share = f"(cast(n AS decimal(19,0)) * cast({int(total)} AS decimal(19,0)))"
    exact = counts.withColumn("_size", size).withColumns(
        {
            "_floor": F.expr(f"{share} div cast(_size AS decimal(19,0))"),
            "_rest": F.expr(f"{share} % cast(_size AS decimal(19,0))"),
        }
    )
    order = W.partitionBy(F.lit(0)).orderBy(F.desc("_rest"), *strata)
    left = F.lit(total) - F.sum("_floor").over(W.partitionBy(F.lit(0)))
    ranked = exact.withColumns({"_rank": F.row_number().over(order), "_left": left})
    quota = F.col("_floor") + F.when(F.col("_rank") <= F.col("_left"), 1).otherwise(0)
    return ranked.withColumn("quota", quota).drop("_size", "_floor", "_rest", "_rank", "_left")


def hash_cells(
    df: DataFrame,
    strata: Sequence[str],
    key: str,
    seed: int,
    cuts: DataFrame,
    rows: int,
    to: str,
) -> DataFrame:
    """Number the consecutive cells of every stratum's hash order.

    ``cuts`` holds, per stratum, an array ``upto`` of ascending cumulative row counts. A
    row's cell is the number of cuts its rank lies beyond. Ranks are never computed:
    bucket counts show in which hash bucket a cut falls, only those buckets are ranked
    to find the hash at the cut, and all rows are then compared with these hashes, so the
    rows themselves are not shuffled. ``key`` must be unique.
    """
    buckets = bucket_count(rows)
    by = list(strata)
    cuts = cuts.select(*by, "upto")
    if buckets == 1:
        # So few rows that even one stratum fits a task: rank them outright.
        rank = F.row_number().over(W.partitionBy(*by).orderBy("_h"))
        ranked = df.withColumn("_h", hash_order(key, seed)).withColumn("_rank", rank)
        cell = F.coalesce(F.size(F.filter("upto", lambda u: u < F.col("_rank"))), F.lit(0))
        return null_safe_join(ranked, cuts, by, "left").withColumn(to, cell).drop("_h", "_rank", "upto")
    hashed = df.select(*strata, hash_order(key, seed).alias("_h")).withColumn("_b", _bucket(F.col("_h"), buckets))
    wanted = cuts.select(*by, F.posexplode("upto").alias("_j", "_upto")).filter(F.col("_upto") > 0)
    totals = hashed.groupBy(*by, "_b").agg(F.count("*").alias("_n"))
    running = F.sum("_n").over(W.partitionBy(*by).orderBy("_b"))
    spans = totals.withColumn("_to", running).withColumn("_from", F.col("_to") - F.col("_n"))
    edges = small_table(
        null_safe_join(spans, wanted, by)
        .filter((F.col("_upto") > F.col("_from")) & (F.col("_upto") <= F.col("_to")))
        .select(*by, "_b", "_j", (F.col("_upto") - F.col("_from")).alias("_need"))
    ).frame
    places = edges.select(*by, "_b").distinct()
    inside = null_safe_join(hashed, places, [*by, "_b"])
    rank = F.row_number().over(W.partitionBy(*by, "_b").orderBy("_h"))
    found = null_safe_join(inside.withColumn("_rank", rank), edges, [*by, "_b"]).filter(
        F.col("_rank") == F.col("_need")
    )
    at_cut = found.groupBy(*by).agg(F.sort_array(F.collect_list("_h")).alias("_cuts"))
    zero = cuts.select(*by, F.size(F.filter("upto", lambda u: u <= 0)).alias("_passed"))
    table = small_table(null_safe_join(zero, at_cut, by, "left")).frame
    joined = null_safe_join(df.withColumn("_h", hash_order(key, seed)), table, by, "left")
    beyond = F.size(F.filter("_cuts", lambda cut: cut < F.col("_h")))
    cell = F.coalesce(F.col("_passed"), F.lit(0)) + F.when(F.col("_cuts").isNull(), 0).otherwise(beyond)
    return joined.withColumn(to, cell).drop("_h", "_cuts", "_passed")


def null_safe_join(left: DataFrame, right: DataFrame, by: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on strata; a null stratum is a stratum of its own."""
    renamed = right.select(
        *[F.col(c).alias(f"_r_{c}") if c in by else F.col(c) for c in right.columns]
    )
    condition = F.lit(True)
    for name in by:
        condition = condition & left[name].eqNullSafe(renamed[f"_r_{name}"])
    return left.join(renamed, condition, how).drop(*[f"_r_{name}" for name in by])


def grouped_rank(df: DataFrame, group: Sequence[str], key: str, seed: int, to: str = "rank", buckets: int = 4096) -> DataFrame:
    """1-based rank of every row in its group's hash order.

    Two levels: rank inside (group, hash bucket), plus the rows of the buckets before. A
    group holding a third of the table spreads over all buckets.
    """
    hashed = df.withColumn("_h", hash_order(key, seed)).withColumn("_b", _bucket(F.col("_h"), buckets))
    totals = hashed.groupBy(*group, "_b").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(W.partitionBy(*group).orderBy("_b")) - F.col("_n")
    offsets = totals.select(*group, "_b", before.alias("_before"))
    inner = F.row_number().over(W.partitionBy(*group, "_b").orderBy("_h"))
    ranked = hashed.withColumn("_inner", inner)
    joined = null_safe_join(ranked, offsets, [*group, "_b"])
    return joined.withColumn(to, F.col("_inner") + F.col("_before")).drop("_h", "_b", "_inner", "_before")


def range_edges(df: DataFrame, order: str, sample: int = _SAMPLE, ranges: int = _RANGES) -> list:
    """Edges of about equally filled ranges of a column with distinct values.

    The ``sample`` values with the smallest hashes are a uniform sample that does not
    depend on partitioning. A table that fits into the sample needs no ranges.
    """
    rows = (
        df.select(F.col(order).alias("v")).filter(F.col("v").isNotNull())
        .orderBy(F.xxhash64("v"), "v").limit(sample + 1).collect()
    )
    values = sorted({row.v for row in rows})
    if len(rows) <= sample:
        return []
    step = max(1, len(values) // ranges)
    return values[step::step]


def running_totals(
    df: DataFrame,
    group: Sequence[str],
    order: str,
    sums: Mapping[str, str],
    descending: bool = True,
    edges: list | None = None,
) -> DataFrame:
    """Inclusive running sums along ``order`` within each group, ties not allowed.

    Range totals become offsets, and the running window works inside (group, range), so
    a single hot group or range of values does not end in one task.
    """
    edges = range_edges(df, order) if edges is None else edges
    sort = F.desc(order) if descending else F.asc(order)
    if not edges:
        window = W.partitionBy(*(group or [F.lit(0)])).orderBy(sort).rowsBetween(W.unboundedPreceding, 0)
        return df.withColumns({to: F.sum(source).over(window) for to, source in sums.items()})
    table = F.array(*[F.lit(edge) for edge in edges])
    ranged = df.withColumn("_range", F.size(F.filter(table, lambda edge: edge <= F.col(order))))
    totals = ranged.groupBy(*group, "_range").agg(*[F.sum(s).alias(f"_t_{s}") for s in set(sums.values())])
    range_sort = F.desc("_range") if descending else F.asc("_range")
    earlier = W.partitionBy(*(group or [F.lit(0)])).orderBy(range_sort).rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select(
        *group, "_range",
        *[F.coalesce(F.sum(f"_t_{s}").over(earlier), F.lit(0)).alias(f"_o_{s}") for s in set(sums.values())],
    )
    window = W.partitionBy(*group, "_range").orderBy(sort).rowsBetween(W.unboundedPreceding, 0)
    inner = ranged.withColumns({to: F.sum(source).over(window) for to, source in sums.items()})
    joined = null_safe_join(inner, offsets, [*group, "_range"])
    out = joined.withColumns({to: F.col(to) + F.col(f"_o_{source}") for to, source in sums.items()})
    return out.drop("_range", *[f"_o_{s}" for s in set(sums.values())])


def ordered_index(df: DataFrame, order: str, to: str = "index", start: int = 1, edges: list | None = None) -> DataFrame:
    """Consecutive index along a column of distinct values, from ``start``."""
    counted = df.withColumn("_one", F.lit(1).cast("long"))
    totals = running_totals(counted, [], order, {to: "_one"}, descending=False, edges=edges)
    return totals.withColumn(to, (F.col(to) + (start - 1)).cast("int")).drop("_one")

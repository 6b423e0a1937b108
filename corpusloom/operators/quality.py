"""Set operations, exact duplicates, profiles and audits."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import settings
from ..session import cut_lineage
from .explore import exact_quantiles

SPLITS = ("train", "val", "test")


def union_sources(frames: Sequence[DataFrame], rank: str | None = None) -> DataFrame:
    """Union by column name; ``rank`` adds the position of each frame in the list."""
    if not frames:
        raise ValueError("no source frames to merge")
    if rank is not None:
        frames = [frame.withColumn(rank, F.lit(i)) for i, frame in enumerate(frames)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def ordered_key(rank: Column, row_id: Column) -> Column:
    """Order key (source rank, row id): a struct of two full-width numbers, so none can collide."""
    return F.struct(rank.cast("long").alias("rank"), row_id.cast("long").alias("row_id"))


def key_digest(columns: Sequence[str]) -> Column:
    """Fixed-width digest of a key; null and empty stay different.

    Every part carries its length, so no value can pass for the border between two.
    """

    def part(name: str) -> Column:
        value = F.col(name).cast("string")
        return F.when(value.isNull(), F.lit("n")).otherwise(F.concat(F.length(value).cast("string"), F.lit(":"), value))

    return F.sha2(F.concat(*[part(name) for name in columns]), 256)


def dedupe_first(df: DataFrame, key: Sequence[str], row_key: str) -> DataFrame:
    """Keep the row with the smallest ``row_key`` of every key; ``row_key`` is unique.

    The minimum per digest is combined on the map side, so a key holding a large share of
    the rows still arrives as one value per task; full rows move only once, by the
    unique row key.
    """
    first = df.groupBy(key_digest(key).alias("_digest")).agg(F.min(row_key).alias(row_key))
    return df.join(first.select(row_key), row_key, "left_semi")


def exact_duplicates(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows, distinct keys and surplus rows."""
    copies = df.groupBy(key_digest(key).alias("_digest")).agg(F.count("*").alias("n"))
    return copies.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.count("*").alias("n_distinct")
    ).withColumn("n_duplicates", F.col("n_rows") - F.col("n_distinct"))


def row_duplicates(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Duplicate count over all or some columns; drop them with ``dropDuplicates``."""
    return exact_duplicates(df, list(columns or df.columns))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))


def leakage(df: DataFrame, fingerprint: str, split: str) -> DataFrame:
    """Fingerprints shared by each pair of splits (all three pairs, zero included).

    A fingerprint is reduced to a bit set of its splits, so copies cost nothing.
    """
    bits = [F.max((F.col(split) == name).cast("int")).alias(name) for name in SPLITS]
    flags = df.groupBy(fingerprint).agg(*bits)
    pairs = [("train", "val"), ("train", "test"), ("val", "test")]
    counts = flags.agg(*[F.count_if((F.col(a) + F.col(b)) == 2).alias(f"{a}_{b}") for a, b in pairs])
    return counts.unpivot([], [f"{a}_{b}" for a, b in pairs], "split_pair", "n_shared")


def dataset_fingerprint_exact(df: DataFrame, fingerprint: str) -> DataFrame:
    """SHA-256 of the newline-joined sorted fingerprints.

    The digest is defined over one sorted text, so this form builds that text and
    refuses corpora above ``settings.EXACT_DIGEST_ROWS``; use the bucketed form there.
    """
    n = df.count()
    if n > settings.EXACT_DIGEST_ROWS:
        raise ValueError(f"{n} rows: the single-text digest is limited, use dataset_fingerprint")
    joined = F.array_join(F.sort_array(F.collect_list(fingerprint)), "\n")
    return df.agg(F.sha2(joined, 256).alias("dataset_fingerprint"))


def dataset_fingerprint(df: DataFrame, fingerprint: str, leaf: int = settings.DIGEST_LEAF) -> DataFrame:
    """Digest and rows of a corpus of any size, as a hash tree over SHA-256 fingerprints.

    Equal fingerprints are counted first, so copies take one line. The tree branches by hex digits and is as deep as
    the number of distinct fingerprints needs for ``leaf`` lines per leaf: a node digests either the sorted lines of its
    range or the digests of its at most 16 children, so no list grows with the corpus.
    """
    lines = cut_lineage(df.groupBy(F.col(fingerprint).alias("fp")).agg(F.count("*").alias("n")))
    facts = lines.agg(F.count("*").alias("lines"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows")).first()
    depth = 0
    while facts.lines > leaf * 16**depth:
        depth += 1
    line = F.concat_ws(" ", "fp", F.col("n").cast("string"))
    nodes = lines.select(F.substring("fp", 1, depth).alias("range"), line.alias("line"))
    for level in range(depth, -1, -1):
        joined = F.array_join(F.sort_array(F.collect_list("line")), "\n")
        digests = nodes.groupBy("range").agg(F.sha2(joined, 256).alias("digest"))
        child = F.concat_ws(" ", "range", "digest")
        nodes = digests.select(F.substring("range", 1, max(level - 1, 0)).alias("range"), child.alias("line"), "digest")
    return nodes.select(F.col("digest").alias("dataset_fingerprint"), F.lit(facts.n_rows).cast("long").alias("n_rows"))


def length_profile(df: DataFrame, text: str) -> DataFrame:
    """Rows and min / median / mean / max characters."""
    lengths = df.select(F.length(text).alias("len"))
    median = [row.median for row in exact_quantiles(lengths, [], "len", {"median": 0.5}).collect()]
    return lengths.agg(
        F.count("*").alias("n_rows"), F.min("len").alias("min_chars"),
        F.lit(median[0] if median else None).cast("double").alias("median_chars"),
        F.avg("len").alias("mean_chars"), F.max("len").alias("max_chars"),
    )


def quality_by_source(df: DataFrame, text: str, label: str, source: str = "source_id") -> DataFrame:
    """Rows, mean characters and label counts (label -> count map) per source."""
    pairs = df.groupBy(source, F.col(label).cast("string").alias("label")).agg(
        F.count("*").alias("n"), F.sum(F.length(text)).alias("chars")
    )
    return pairs.groupBy(source).agg(
        F.sum("n").alias("n_rows"),
        (F.sum("chars") / F.sum("n")).alias("mean_chars"),
        F.map_from_entries(
            F.sort_array(F.collect_list(F.struct(F.coalesce("label", F.lit("null")), "n")))
        ).alias("label_counts"),
    )


def split_counts(df: DataFrame, source: str = "source_id", split: str = "split_name") -> DataFrame:
    """Rows per source and split with all totals (cube; null means "all")."""
    counts = df.groupBy(source, split).agg(F.count("*").alias("n"))
    return counts.cube(source, split).agg(F.sum("n").alias("n"))


def split_matrix(df: DataFrame, source: str = "source_id", split: str = "split_name") -> DataFrame:
    """One row per source, one column per split."""
    return df.groupBy(source).pivot(split, list(SPLITS)).count().na.fill(0)


def missing(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Missing values and percentage per column, in one pass."""
    columns = list(columns or df.columns)
    counts = df.agg(
        F.count("*").alias("_rows"), *[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in columns]
    )
    long = counts.unpivot("_rows", columns, "column_name", "n_missing")
    percent = F.coalesce(F.try_divide(F.col("n_missing") * 100.0, F.col("_rows")), F.lit(0.0))
    return long.select("column_name", "n_missing", F.round(percent, 2).alias("pct_missing"))


def audit(df: DataFrame) -> DataFrame:
    """Violations of the sample table's rules: not null, unique, known split."""
    required = ("text_raw", "label_raw", "text_clean", "text_fingerprint", "char_len", "split_name")
    domain = ~F.col("split_name").isin(*SPLITS)
    checks = [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in required if c in df.columns]
    nulls = df.agg(*checks, F.count_if(domain).alias("unknown_split_name"))
    names = nulls.columns
    out = nulls.unpivot([], names, "rule", "n_violations")
    for column in ("text_clean", "text_fingerprint"):
        surplus = exact_duplicates(df, [column]).select(
            F.lit(f"duplicate_{column}").alias("rule"), F.col("n_duplicates").alias("n_violations")
        )
        out = out.unionByName(surplus)
    return out

"""Nothing is lost or merged by nulls, separators inside values, or large row numbers."""

import math

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import quality, splits


def with_nulls(spark):
    rows = [(i, f"s{i % 7}" if i % 11 else None, i % 2 if i % 13 else None) for i in range(120)]
    return spark.createDataFrame(rows, "key long, source_id string, label int")


def test_null_source_and_label_are_kept(spark):
    df = with_nulls(spark)
    for out in (
        splits.stratified(df, "key", "label", "source_id"), splits.grouped(df, "key", "label"), splits.class_weights(df, "label"),
        splits.oversample(df, "key", "label"), splits.folds(df, "key", "label"), splits.folds(df, "key", "label", group="source_id", k=2),
    ):
        assert out.count() == 120 and out.select("key").distinct().count() == 120
    copies = splits.oversample(df, "key", "label", mode="copies")
    assert copies.select("key").distinct().count() == 120


def test_group_folds_follow_one_rule_at_any_size(spark):
    df = spark.range(60_000).select(F.col("id").alias("key"), (F.col("id") % 2).cast("int").alias("label"), F.concat(F.lit("g"), F.col("id")).alias("source_id"))
    sizes = [r["count"] for r in splits.folds(df.limit(2_000), "key", "label", group="source_id").groupBy("fold").count().collect()]
    assert len(sizes) == 5 and max(sizes) - min(sizes) <= 2


def test_key_digests_do_not_collide(spark):
    df = spark.createDataFrame([("a\x1fvb", "c"), ("a", "b\x1fvc"), ("a:1:b", ""), (None, "x"), ("n", "x")], "x string, y string")
    assert df.select(quality.key_digest(["x", "y"])).distinct().count() == 5


def test_order_keys_of_late_partitions_and_long_files(spark):
    ids = [0, 1 << 28, 32_768 << 33, 40_000 << 33]
    df = spark.createDataFrame([(r, i, "t") for r in (0, 1) for i in ids], "rank int, row_id long, text string")
    keyed = df.withColumn("row_key", quality.ordered_key(F.col("rank"), F.col("row_id")))
    assert keyed.select("row_key").distinct().count() == 8
    first = quality.dedupe_first(keyed, ["text"], "row_key").collect()
    assert [(r["rank"], r["row_id"]) for r in first] == [(0, 0)]

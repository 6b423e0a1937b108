from collections import Counter

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import ranking, splits
from corpusloom.session import local_rows


def corpus(spark, n=600, hot=True):
    source = F.when(F.col("id") % 3 == 0, "hot") if hot else F.lit(None)
    return spark.range(n).select(
        F.col("id").alias("key"),
        F.coalesce(source, F.concat(F.lit("s"), (F.col("id") % 7).cast("string"))).alias("source_id"),
        (F.col("id") % 5 == 0).cast("int").alias("label"),
    )


def assignment(df, column="split_name"):
    return {r.key: r[column] for r in df.select("key", column).collect()}


def test_published_quotas(spark):
    sizes = [("reddit", "1", 3727), ("reddit", "0", 3686), ("short", "1", 113), ("short", "0", 121)]
    counts = local_rows(spark, sizes, "source_id string, label string, n long")
    test = {(r.source_id, r.label): r.quota for r in ranking.largest_remainder(counts, 1530, ["source_id", "label"]).collect()}
    assert test[("reddit", "1")] + test[("reddit", "0")] == 1483
    rest = local_rows(spark, [(s, l, n - test[(s, l)]) for s, l, n in sizes], "source_id string, label string, n long")
    val = {(r.source_id, r.label): r.quota for r in ranking.largest_remainder(rest, 1224, ["source_id", "label"]).collect()}
    assert val[("reddit", "1")] + val[("reddit", "0")] == 1187 and sum(val.values()) == 1224


def test_split_sizes_strata_and_partitioning(spark):
    frame = corpus(spark)
    a = assignment(splits.stratified(frame.repartition(1), "key", "label", "source_id"))
    b = assignment(splits.stratified(frame.repartition(13), "key", "label", "source_id"))
    assert a == b and len(a) == 600
    assert Counter(a.values()) == {"test": 120, "val": 96, "train": 384}


def test_bucketed_path_equals_direct_ranks(spark, monkeypatch):
    frame = corpus(spark, 900)
    direct = assignment(splits.stratified(frame, "key", "label", "source_id"))
    folds = assignment(splits.folds(frame, "key", "label"), "fold")
    monkeypatch.setattr(ranking, "_ROWS_PER_BUCKET", 20)
    assert ranking.bucket_count(900) > 16
    assert assignment(splits.stratified(frame, "key", "label", "source_id")) == direct
    assert assignment(splits.folds(frame, "key", "label"), "fold") == folds


def test_tiny_strata_fall_back_to_label(spark):
    rows = [(i, "a", i % 2) for i in range(40)] + [(100, "b", 1), (101, "c", 0), (102, "c", 0)]
    frame = local_rows(spark, rows, "key long, source_id string, label int")
    got = assignment(splits.stratified(frame, "key", "label", "source_id"))
    assert Counter(got.values())["test"] == 9 and len(got) == 43


def test_group_split_keeps_sources_whole(spark):
    frame = corpus(spark)
    got = splits.grouped(frame, "key", "label").groupBy("source_id").agg(F.count_distinct("split_name").alias("n"))
    assert {r.n for r in got.collect()} == {1}


def test_bad_ratios(spark):
    with pytest.raises(ValueError):
        splits.stratified(corpus(spark), "key", "label", ratios=(0.5, 0.5, 0.5))


def test_weights_sum_to_rows(spark):
    got = splits.class_weights(corpus(spark), "label").agg(F.sum("weight")).first()[0]
    assert got == pytest.approx(600)


def test_grouped_rank_and_range_index(spark):
    frame = corpus(spark, 500)
    ranks = splits.grouped_rank(frame, ["label"], "key", 42).groupBy("label").agg(F.max("rank").alias("m"), F.count_distinct("rank").alias("d"), F.count("*").alias("n"))
    assert all(r.m == r.d == r.n for r in ranks.collect())
    words = frame.select(F.concat(F.lit("w"), F.col("key").cast("string")).alias("term"))
    edges = ranking.range_edges(words, "term", sample=50, ranges=8)
    assert len(edges) > 3
    indexed = [r["index"] for r in ranking.ordered_index(words, "term", edges=edges).orderBy("term").collect()]
    assert indexed == list(range(1, 501))


def test_group_folds_keep_groups_and_cover(spark):
    got = splits.folds(corpus(spark), "key", "label", group="source_id")
    per = got.groupBy("source_id").agg(F.count_distinct("fold").alias("n")).collect()
    assert {r.n for r in per} == {1}
    assert got.select("fold").distinct().count() == 5

"""Plan shapes, and the registered queries against their SQL on the smallest tables."""

import duckdb
import pytest
from pyspark.sql import functions as F

from corpusloom.catalog import registry
from corpusloom.catalog.base import clean_posts, labelled, scored, table
from corpusloom.operators import explore, features, metrics, quality, sentiment, splits
from corpusloom.session import cut_wide, local_rows
from tools.check_oracle import TABLES, canonical

FOLDER = "/root/testdata/sf0.001"
FAST = (
    "corpus_report", "t01_clean_text", "t05_shingles", "t12_map_tokens", "l02_binary_labels", "d02_dedupe_first",
    "d04_near_duplicates", "q03_missing", "p01_stratified_split", "p09_folds", "f02_sentiment", "f07_evidence",
    "f09_tfidf_weights", "v03_v05_all_metrics", "v07_risk_cutoffs", "v11_reliability", "r06_display_tier",
    "x01_describe", "u03_select_spaced", "u04_sequences",
)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for name in TABLES.split():
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", FAST)
def test_equals_sql(spark, con, name):
    got = registry.queries()[name](spark, FOLDER).toPandas()
    want = con.execute(registry.oracle_sql()[name]).df()
    a, b = canonical(got), canonical(want)
    assert list(a.columns) == list(b.columns) and len(a) == len(b)
    assert a.equals(b)


def test_every_sql_has_its_query():
    assert set(registry.oracle_sql()) <= set(registry.queries())


@pytest.mark.parametrize(
    "build",
    [
        lambda s: quality.dedupe_first(clean_posts(s, FOLDER), ["clean"], "doc_id"),
        lambda s: splits.stratified(labelled(s, FOLDER), "doc_id", "label", "source_id"),
        lambda s: metrics.best_threshold(scored(s, FOLDER), "y", "score"),
        lambda s: metrics.binary_metrics(scored(s, FOLDER), "y", "pred", "score", ["source_id"]),
        lambda s: features.vocabulary(clean_posts(s, FOLDER), "clean"),
        lambda s: explore.histogram(table(s, FOLDER, "lineitem"), "l_quantity", 10),
    ],
)
def test_no_cross_joins_and_no_python(spark, build):
    plan = plan_of(build(spark))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in plan


def test_scan_reads_only_needed_columns_and_pushes_filters(spark):
    frame = table(spark, FOLDER, "lineitem").filter(F.col("l_quantity") > 10)
    plan = plan_of(explore.quartiles_by(frame, "l_extendedprice", "l_returnflag"))
    assert "ReadSchema: struct<l_quantity:double,l_extendedprice:double,l_returnflag:string>" in plan
    assert "GreaterThan(l_quantity,10.0)" in plan


def test_terms_are_counted_without_moving_texts(spark):
    frame = table(spark, FOLDER, "documents").select("doc_id", F.lower("text").alias("clean"))
    pairs = features.term_pairs(frame, "doc_id", "clean")
    assert "Exchange" not in plan_of(pairs)


def test_weights_and_sentiment_are_not_evaluated_per_entry(spark):
    """Nested lambdas took the length of a document again for each of its entries."""
    frame = clean_posts(spark, FOLDER).select("doc_id", "clean")
    vocab = local_rows(spark, [("the", 0, 1.0), ("people", 1, 2.0)], "term string, index int, idf double")
    valence = local_rows(spark, [("good", 1.9)], "word string, valence double")
    assert "lambdafunction" not in plan_of(features.tfidf_vectors(frame, "doc_id", "clean", vocab, 2))
    assert plan_of(sentiment.compound(frame, "clean", valence)).count("namedlambdavariable") < 20
    assert cut_wide(frame, "doc_id").rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism

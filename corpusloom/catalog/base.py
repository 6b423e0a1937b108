"""Shared parts of the registered queries: table access, fixture words, SQL fragments."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as tx
from ..session import local_rows, spread

SEED = 42


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf.rstrip('/')}/{name}.parquet")


def posts(spark: SparkSession, sf: str) -> DataFrame:
    """documents as posts: doc_id, source_id, text; a single small file is spread over the cores."""
    docs = table(spark, sf, "documents").select("doc_id", F.col("source").alias("source_id"), "text")
    return spread(docs, "doc_id")


def clean_posts(spark: SparkSession, sf: str) -> DataFrame:
    return posts(spark, sf).select("doc_id", "source_id", "text", tx.clean_text(F.col("text")).alias("clean"))


def labelled(spark: SparkSession, sf: str) -> DataFrame:
    """Posts with their label: doc_id, source_id, label (0/1)."""
    labels = table(spark, sf, "labels").select("doc_id", F.col("quality").alias("label"))
    return table(spark, sf, "documents").select("doc_id", F.col("source").alias("source_id"), "n_chars").join(
        labels, "doc_id"
    )


def scored(spark: SparkSession, sf: str) -> DataFrame:
    """A reproducible score with many ties: doc_id, source_id, y, score, pred."""
    score = F.floor(F.col("n_chars") / (F.col("n_chars") + 1500.0) * 1000) / 1000.0
    return (
        labelled(spark, sf)
        .withColumnRenamed("label", "y")
        .withColumn("score", score)
        .withColumn("pred", (F.col("score") >= 0.5).cast("int"))
    )


def words_table(spark: SparkSession, words: list[str], column: str = "entry") -> DataFrame:
    return local_rows(spark, [(w,) for w in words], f"{column} string")


def r6(c):
    """Round to six places, as the SQL side does."""
    return F.round(c, 6)


# --- SQL fragments -----------------------------------------------------------------

def sql_clean(c: str) -> str:
    return (
        f"trim(regexp_replace(regexp_replace(lower(coalesce({c},'')), "
        r"'https?://\S+|www\.\S+', ' ', 'g'), '[^a-z]+', ' ', 'g'))"
    )


def sql_normal(c: str) -> str:
    return rf"trim(regexp_replace(lower(coalesce({c},'')), '\s+', ' ', 'g'))"


def sql_tokens(c: str) -> str:
    return f"list_filter(string_split({c}, ' '), lambda t: t <> '')"


def sql_hash(key: str, seed: int = SEED) -> str:
    return f"sha256(concat({key}, ':{seed}'))"


def sql_values(rows: list[tuple], names: str) -> str:
    def lit(v) -> str:
        return "'" + v.replace("'", "''") + "'" if isinstance(v, str) else repr(v)

    body = ", ".join("(" + ", ".join(lit(v) for v in row) + ")" for row in rows)
    return f"(VALUES {body}) AS t({names})"


SQL_CLEAN_POSTS = f"SELECT doc_id, source AS source_id, text, {sql_clean('text')} AS clean FROM documents"
SQL_LABELLED = (
    "SELECT d.doc_id, d.source AS source_id, d.n_chars, l.quality AS label "
    "FROM documents d JOIN labels l ON d.doc_id = l.doc_id"
)
SQL_SCORED = (
    "SELECT *, CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS pred FROM ("
    "SELECT d.doc_id, d.source AS source_id, l.quality AS y, "
    "floor(d.n_chars / (d.n_chars + 1500.0e0) * 1000) / 1000.0e0 AS score "
    "FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"
)


def sql_take(name: str, source: str, strata: list[str], total: str, key: str = "doc_id", seed: int = SEED) -> str:
    """CTEs marking ``total`` rows of ``source``, spread by largest remainder; result: name."""
    by = ", ".join(strata)
    return f"""
    {name}_c AS (SELECT {by}, count(*) AS n FROM {source} GROUP BY {by}),
    {name}_s AS (SELECT CAST(sum(n) AS BIGINT) AS size FROM {name}_c),
    {name}_t AS (SELECT CAST({total} AS BIGINT) AS total, size FROM {name}_s),
    {name}_f AS (SELECT c.*, (total * n) // size AS fl, (total * n) % size AS re, total FROM {name}_c c, {name}_t),
    {name}_r AS (SELECT *, row_number() OVER (ORDER BY re DESC, {by}) AS rk, total - sum(fl) OVER () AS lft FROM {name}_f),
    {name}_q AS (SELECT {by}, n, fl + CASE WHEN rk <= lft THEN 1 ELSE 0 END AS quota FROM {name}_r),
    {name} AS (SELECT s.*, row_number() OVER (PARTITION BY {', '.join('s.' + c for c in strata)}
               ORDER BY {sql_hash('s.' + key, seed)}) <= q.quota AS taken
               FROM {source} s JOIN {name}_q q ON {' AND '.join(f's.{c} = q.{c}' for c in strata)})"""

"""Round trips through files: what is written to the session's shared folder is read back and compared."""

from __future__ import annotations

import uuid
from datetime import UTC, datetime

from pyspark.sql import functions as F

from ..session import shared_folder
from ..sources import files, manifest, readers, store
from .base import table
from .corpus_queries import SQL_SAMPLES, samples

QUERIES, ORACLE = {}, {}

_CSV = {"header": True, "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def query(name: str, sql: str):
    def register(fn):
        QUERIES[name], ORACLE[name] = fn, sql
        return fn

    return register


def _folder(spark, name: str) -> str:
    """A new folder; the returned frames read it, so it stays until the shared folder is cleaned."""
    return files.join(shared_folder(spark), f"{name}-{uuid.uuid4().hex}")


def _labelled_texts(spark, sf):
    labels = table(spark, sf, "labels").select("doc_id", F.col("quality").alias("label"))
    docs = table(spark, sf, "documents").select("doc_id", "source", "text").join(labels, "doc_id", "left")
    return docs.withColumn("label", F.coalesce("label", F.lit(0)))


@query("s01_read_posts", "SELECT doc_id, sha256(coalesce(text, '')) AS digest, length(coalesce(text, '')) AS n FROM documents")
def s01(spark, sf):
    path = _folder(spark, "posts")
    table(spark, sf, "documents").select("doc_id", "text").write.csv(path, **_CSV)
    text = F.coalesce("text", F.lit(""))
    return readers.read_posts(spark, path).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.sha2(text, 256).alias("digest"), F.length(text).cast("long").alias("n")
    )


def _write_manifest(spark, sf, path: str) -> None:
    """One entry per source, in name order; every second one states a minimum length."""
    sources = table(spark, sf, "documents").filter("source IS NOT NULL").groupBy("source").agg(F.count("*").alias("n"))
    entry = F.struct(
        F.col("source").alias("id"), F.concat(F.lit("source="), "source").alias("file"), F.lit("text").alias("text_column"),
        F.when(F.col("n") % 2 == 0, 20).alias("min_chars"), (F.col("n") > 0).alias("required"),
    )
    ordered = F.array_sort(F.collect_list(entry), lambda a, b: F.when(a["id"] < b["id"], -1).otherwise(1))
    sources.agg(F.to_json(F.struct(ordered.alias("sources"))).alias("value")).write.text(path)


@query(
    "s03_manifest",
    """SELECT CAST(row_number() OVER (ORDER BY source) - 1 AS INT) AS rank, source AS id, 'source=' || source AS file, 'label' AS label_column,
    'binary_numeric' AS label_type, true AS required, CASE WHEN n % 2 = 0 THEN 20 END AS min_chars, CAST(0 AS BIGINT) AS n_alt_files
    FROM (SELECT source, count(*) AS n FROM documents WHERE source IS NOT NULL GROUP BY 1)""",
)
def s03(spark, sf):
    path = _folder(spark, "manifest")
    _write_manifest(spark, sf, path)
    return manifest.load_manifest(spark, path).select(
        "rank", "id", "file", "label_column", "label_type", "required", "min_chars", F.size("alt_files").cast("long").alias("n_alt_files")
    )


@query(
    "s04_load_sources",
    """SELECT d.source AS source_id, count(*) AS n_rows, CAST(sum(coalesce(l.quality, 0)) AS BIGINT) AS n_positive,
    count(*) AS n_keys, CAST(sum(length(coalesce(d.text, ''))) AS BIGINT) AS n_chars
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE d.source IS NOT NULL GROUP BY 1""",
)
def s04(spark, sf):
    folder = _folder(spark, "sources")
    _labelled_texts(spark, sf).filter("source IS NOT NULL").select("source", "text", "label").write.partitionBy("source").csv(folder, **_CSV)
    listed = _folder(spark, "manifest")
    _write_manifest(spark, sf, listed)
    raw, _ = manifest.load_sources(spark, manifest.load_manifest(spark, listed), folder)
    return raw.groupBy("source_id").agg(
        F.count("*").alias("n_rows"), F.count_if(F.col("label_raw") == "1").alias("n_positive"),
        F.count_distinct("row_key").alias("n_keys"), F.sum(F.length(F.coalesce("text_raw", F.lit("")))).alias("n_chars"),
    )


def _stored(spark, sf) -> str:
    path = _folder(spark, "store")
    store.write_samples(samples(spark, sf), path, "doc_id", datetime(2024, 1, 1, tzinfo=UTC))
    return path


@query(
    "s06_load_bundle",
    f"WITH {SQL_SAMPLES} SELECT split_name, CAST(label AS VARCHAR) AS label_raw, count(*) AS n, CAST(sum(length(text_raw)) AS BIGINT) AS n_chars FROM samples GROUP BY ALL",
)
def s06(spark, sf):
    folder = _folder(spark, "bundle")
    store.export_splits(store.read_samples(spark, _stored(spark, sf)), folder, "text", "label")
    found = readers.load_bundle(spark, folder)
    parts = [f.withColumn("split_name", F.lit(n)) for n, f in (("train", found.train), ("val", found.val), ("test", found.test))]
    rows = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return rows.groupBy("split_name", "label_raw").agg(F.count("*").alias("n"), F.sum(F.length("text_raw")).alias("n_chars"))


@query(
    "s08_write_samples",
    f"""WITH {SQL_SAMPLES} SELECT doc_id AS sample_id, source_id, split_name, CAST(label AS VARCHAR) AS label_raw, text_fingerprint,
    length(text_clean) AS char_len, '2024-01-01' AS created_on FROM samples""",
)
def s08(spark, sf):
    return store.read_samples(spark, _stored(spark, sf)).select(
        "sample_id", "source_id", "split_name", "label_raw", "text_fingerprint", F.col("char_len").cast("long").alias("char_len"),
        F.date_format("created_at", "yyyy-MM-dd").alias("created_on"),
    )


@query(
    "s09_export_splits",
    f"WITH {SQL_SAMPLES} SELECT split_name, sha256(text_raw) AS digest, CAST(label AS VARCHAR) AS is_depression FROM samples",
)
def s09(spark, sf):
    folder = _folder(spark, "export")
    store.export_splits(store.read_samples(spark, _stored(spark, sf)), folder)
    parts = [
        readers.read_posts(spark, files.join(folder, f"{name}.csv")).select(
            F.lit(name).alias("split_name"), F.sha2("clean_text", 256).alias("digest"), "is_depression"
        )
        for name in ("train", "val", "test")
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "s10_metadata",
    """SELECT 'build' AS key, '{"n_rows":' || count(*) || ',"n_sources":' || count(DISTINCT source) || '}' AS value FROM documents
    UNION ALL SELECT 'version', 'v2' FROM (SELECT 1 FROM documents LIMIT 1)""",
)
def s10(spark, sf):
    path = _folder(spark, "meta")
    docs = table(spark, sf, "documents")
    store.write_meta(spark, path, "build", docs.limit(1).agg(F.count("*").alias("n_rows")))
    store.write_meta(spark, path, "version", "v1")
    store.write_meta(spark, path, "build", docs.agg(F.count("*").alias("n_rows"), F.count_distinct("source").alias("n_sources")))
    store.write_meta(spark, path, "version", "v2")
    return store.read_meta(spark, path)


@query(
    "s12_staleness",
    f"""WITH {SQL_SAMPLES}, s AS (SELECT DISTINCT source_id FROM samples)
    SELECT 'no store' AS state, true AS stale, count(*) AS n_sources FROM s UNION ALL SELECT 'older files', false, count(*) FROM s
    UNION ALL SELECT 'newer files', true, count(*) FROM s UNION ALL SELECT 'new source', true, count(*) FROM s""",
)
def s12(spark, sf):
    listed = _folder(spark, "listed")
    table(spark, sf, "documents").select("doc_id").write.csv(listed)
    built = samples(spark, sf)
    fresh, old = _folder(spark, "fresh"), _stored(spark, sf)
    store.write_samples(store.read_samples(spark, old).drop("created_at"), fresh, "sample_id")
    sources = store.read_samples(spark, fresh).select(F.col("source_id").alias("id")).distinct()
    known = sources.withColumn("path", F.lit(listed))
    extra = known.unionByName(known.limit(1).withColumn("id", F.lit("another")))
    states = [
        ("no store", store.is_stale(spark, _folder(spark, "absent"), known)), ("older files", store.is_stale(spark, fresh, known)),
        ("newer files", store.is_stale(spark, old, known)), ("new source", store.is_stale(spark, fresh, extra)),
    ]
    told = F.explode(F.array(*[F.struct(F.lit(a).alias("state"), F.lit(b).alias("stale")) for a, b in states])).alias("s")
    return built.agg(F.count_distinct("source_id").alias("n_sources")).select(told, "n_sources").select("s.state", "s.stale", "n_sources")


@query(
    "s17_reports",
    """SELECT source AS source_id, CAST(count(*) AS DOUBLE) AS docs, CAST(sum(n_chars) AS DOUBLE) AS chars, CAST(2 AS BIGINT) AS n_metrics
    FROM documents WHERE source IS NOT NULL GROUP BY 1""",
)
def s17(spark, sf):
    path, nested = _folder(spark, "report"), _folder(spark, "nested")
    docs = table(spark, sf, "documents").filter("source IS NOT NULL")
    counts = docs.groupBy(F.col("source").alias("source_id")).agg(F.count("*").cast("double").alias("docs"), F.sum("n_chars").cast("double").alias("chars"))
    long = counts.unpivot(["source_id"], ["docs", "chars"], "metric", "value")
    store.write_report(long, path)
    store.write_nested_report(long, nested, "source_id")
    wide = spark.read.csv(files.join(path, "metrics.csv"), header=True, schema="source_id string, chars double, docs double")
    inner = spark.read.schema("source_id string, metrics map<string,double>").json(nested)
    return wide.join(inner.select("source_id", F.size("metrics").cast("long").alias("n_metrics")), "source_id")

"""Set operations, duplicates, profiles, audits, splits and samples."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from .. import settings
from ..functions import text as tx
from ..operators import neardup, quality, splits
from ..plans import corpus
from ..session import shared_folder
from ..sources import store
from .base import (
    SEED,
    SQL_CLEAN_POSTS,
    SQL_LABELLED,
    clean_posts,
    labelled,
    posts,
    r6,
    sql_clean,
    sql_hash,
    sql_normal,
    sql_take,
    table,
)

QUERIES, ORACLE = {}, {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


# --- corpus build: documents + labels to samples -----------------------------------

SQL_TEST = "ceil(size * 0.2e0)"
SQL_VAL = "ceil(size * (0.16e0 / (0.64e0 + 0.16e0)))"


def sql_stratified(source: str, name: str = "split_rows") -> str:
    """Train/val/test by source_id and label with the published fallbacks to label."""
    return f"""
    {name}_least AS (SELECT min(n) AS least FROM (SELECT count(*) AS n FROM {source} GROUP BY source_id, label)),
    {name}_k1 AS (SELECT s.*, CASE WHEN least >= 3 THEN source_id ELSE '' END AS s1 FROM {source} s, {name}_least),
    {sql_take(name + '_a', name + '_k1', ['s1', 'label'], SQL_TEST)},
    {name}_rest AS (SELECT * EXCLUDE (taken) FROM {name}_a WHERE NOT taken),
    {name}_least2 AS (SELECT min(n) AS least FROM (SELECT count(*) AS n FROM {name}_rest GROUP BY source_id, label)),
    {name}_k2 AS (SELECT s.*, CASE WHEN least >= 2 THEN source_id ELSE '' END AS s2 FROM {name}_rest s, {name}_least2),
    {sql_take(name + '_b', name + '_k2', ['s2', 'label'], SQL_VAL)},
    {name} AS (
      SELECT doc_id, 'test' AS split_name FROM {name}_a WHERE taken
      UNION ALL SELECT doc_id, CASE WHEN taken THEN 'val' ELSE 'train' END FROM {name}_b)"""


SQL_SAMPLES = f"""
    raw AS (SELECT d.doc_id, d.source AS source_id, d.text AS text_raw, coalesce(l.quality, 0) AS label,
      {sql_clean('d.text')} AS text_clean FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
    kept AS (SELECT * FROM (SELECT *, sha256(text_clean) AS text_fingerprint,
      row_number() OVER (PARTITION BY text_clean ORDER BY doc_id) AS k FROM (
        SELECT *, length(regexp_replace(substr(text_raw, 1, 200), '[^\\p{{L}}]', '', 'g')) AS letters,
        length(regexp_replace(lower(substr(text_raw, 1, 200)), '[^a-z]', '', 'g')) AS latin FROM raw)
      WHERE length(text_clean) >= 20 AND (letters = 0 OR latin::DOUBLE / letters >= 0.82)) WHERE k = 1),
    {sql_stratified('kept').replace(sql_hash('s.doc_id'), sql_hash('s.text_fingerprint'))},
    samples AS (SELECT k.*, s.split_name FROM kept k JOIN split_rows s ON k.doc_id = s.doc_id)"""


def samples(spark, sf):
    docs = posts(spark, sf).withColumnRenamed("text", "text_raw")
    labels = table(spark, sf, "labels").select("doc_id", F.col("quality").alias("label"))
    raw = docs.join(labels, "doc_id", "left").withColumn("label_raw", F.coalesce("label", F.lit(0)).cast("string"))
    return corpus.build_samples(raw.drop("label"), row_key="doc_id")


@query(
    "corpus_report",
    f"WITH {SQL_SAMPLES} SELECT source_id, split_name, CAST(label AS VARCHAR) AS label_raw, count(*) AS n FROM samples GROUP BY ALL",
)
def corpus_report(spark, sf):
    return samples(spark, sf).groupBy("source_id", "split_name", "label_raw").agg(F.count("*").alias("n"))


@query(
    "s11_load_split",
    f"WITH {SQL_SAMPLES} SELECT doc_id, CAST(label AS VARCHAR) AS label_raw, text_fingerprint FROM samples WHERE split_name = 'test' ORDER BY doc_id",
)
def s11(spark, sf):
    path = f"{shared_folder(spark)}/store-{uuid.uuid4().hex}"
    store.write_samples(samples(spark, sf), path, "doc_id")
    part = store.read_samples(spark, path, "test", ordered=True)
    return part.select(F.col("sample_id").alias("doc_id"), "label_raw", "text_fingerprint")


@query(
    "s13_single_corpus",
    f"""WITH raw AS (SELECT d.doc_id, 'single_csv' AS source_id, d.text AS text_raw, trim(coalesce(CAST(l.quality AS VARCHAR), '0')) AS label,
      {sql_clean('d.text')} AS text_clean FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
    once AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY text_raw ORDER BY doc_id) AS k FROM raw WHERE length(text_raw) > 0) WHERE k = 1),
    kept AS (SELECT * EXCLUDE (k, k2) FROM (SELECT *, row_number() OVER (PARTITION BY text_clean ORDER BY doc_id) AS k2, sha256(text_clean) AS text_fingerprint
      FROM once WHERE length(text_clean) >= 20) WHERE k2 = 1),
    {sql_stratified('kept').replace(sql_hash('s.doc_id'), sql_hash('s.text_fingerprint'))}
    SELECT (SELECT count(*) FROM raw) AS rows_source, (SELECT count(*) FROM kept) AS rows_after_clean,
      (SELECT count(*) FROM raw) - (SELECT count(*) FROM kept) AS rows_dropped,
      CAST(sum(CASE WHEN split_name = 'train' THEN 1 ELSE 0 END) AS BIGINT) AS n_train,
      CAST(sum(CASE WHEN split_name = 'val' THEN 1 ELSE 0 END) AS BIGINT) AS n_val,
      CAST(sum(CASE WHEN split_name = 'test' THEN 1 ELSE 0 END) AS BIGINT) AS n_test FROM split_rows""",
)
def s13(spark, sf):
    labels = table(spark, sf, "labels").select("doc_id", F.col("quality").cast("string").alias("label_raw"))
    raw = posts(spark, sf).select("doc_id", F.col("text").alias("text_raw")).join(labels, "doc_id", "left")
    raw = raw.withColumn("label_raw", F.coalesce("label_raw", F.lit("0")))
    built = corpus.build_single(raw, row_key="doc_id")
    return corpus.single_stats(raw, built)


# --- set operations and duplicates -------------------------------------------------


@query(
    "d01_union_sources",
    """SELECT source_id, count(*) AS n, count(role) AS n_role FROM (
      SELECT source AS source_id, text, NULL AS role FROM documents
      UNION ALL SELECT 'conversations', text, role FROM conversations) GROUP BY 1""",
)
def d01(spark, sf):
    talks = table(spark, sf, "conversations").select(F.lit("conversations").alias("source_id"), "text", "role")
    merged = quality.union_sources([posts(spark, sf).drop("doc_id"), talks])
    return merged.groupBy("source_id").agg(F.count("*").alias("n"), F.count("role").alias("n_role"))


@query(
    "d02_dedupe_first",
    f"""SELECT doc_id, source_id FROM (SELECT *, row_number() OVER (PARTITION BY clean
      ORDER BY CAST(substr(source_id, 4) AS INT), doc_id) AS k FROM ({SQL_CLEAN_POSTS})) WHERE k = 1""",
)
def d02(spark, sf):
    rank = F.substring("source_id", 4, 10).cast("int")
    keyed = clean_posts(spark, sf).withColumn("row_key", quality.ordered_key(rank, F.col("doc_id")))
    return quality.dedupe_first(keyed, ["clean"], "row_key").select("doc_id", "source_id")


@query(
    "d03_exact_duplicates",
    f"""SELECT count(*) AS n_rows, count(DISTINCT clean) AS n_distinct, count(*) - count(DISTINCT clean) AS n_duplicates
    FROM ({SQL_CLEAN_POSTS})""",
)
def d03(spark, sf):
    return quality.exact_duplicates(clean_posts(spark, sf), ["clean"])


SQL_NEAR = f"""
    w AS (SELECT doc_id, list_filter(string_split(clean, ' '), lambda t: t <> '') AS w FROM ({SQL_CLEAN_POSTS})),
    s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
      ELSE [w[i] || ' ' || w[i+1] || ' ' || w[i+2] for i in range(1, len(w) - 1)] END) AS g FROM w),
    z AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
    p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
    near AS (SELECT DISTINCT p.b AS doc_id FROM p JOIN z za ON za.doc_id = p.a JOIN z zb ON zb.doc_id = p.b
      WHERE p.c::DOUBLE / (za.n + zb.n - p.c) >= 0.9)"""


@query("d04_near_duplicates", f"WITH {SQL_NEAR} SELECT doc_id FROM near")
def d04(spark, sf):
    near = neardup.near_duplicates(clean_posts(spark, sf), "doc_id", "clean")
    return near.select(F.col("row").alias("doc_id"))


@query(
    "d05_row_duplicates",
    """SELECT count(*) AS n_rows, count(DISTINCT (l_returnflag, l_linestatus, l_quantity, l_discount)) AS n_distinct,
      count(*) - count(DISTINCT (l_returnflag, l_linestatus, l_quantity, l_discount)) AS n_duplicates FROM lineitem""",
)
def d05(spark, sf):
    return quality.row_duplicates(
        table(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus", "l_quantity", "l_discount"]
    )


@query("d06_value_counts", "SELECT event_type AS value, count(*) AS n FROM events GROUP BY 1")
def d06(spark, sf):
    return quality.value_counts(table(spark, sf, "events"), "event_type")


SQL_HASH_SPLIT = (
    f"SELECT doc_id, sha256({sql_normal('text')}) AS fp, CASE doc_id % 3 WHEN 0 THEN 'train' WHEN 1 THEN 'val' "
    "ELSE 'test' END AS split_name FROM documents"
)


@query(
    "d07_leakage",
    f"""WITH x AS ({SQL_HASH_SPLIT}), f AS (SELECT fp, max((split_name = 'train')::INT) AS tr, max((split_name = 'val')::INT) AS va,
      max((split_name = 'test')::INT) AS te FROM x GROUP BY fp)
    SELECT 'train_val' AS split_pair, count(*) FILTER (tr + va = 2) AS n_shared FROM f
    UNION ALL SELECT 'train_test', count(*) FILTER (tr + te = 2) FROM f
    UNION ALL SELECT 'val_test', count(*) FILTER (va + te = 2) FROM f""",
)
def d07(spark, sf):
    name = F.when(F.col("doc_id") % 3 == 0, "train").when(F.col("doc_id") % 3 == 1, "val").otherwise("test")
    frame = posts(spark, sf).select(tx.fingerprint(F.col("text")).alias("fp"), name.alias("split_name"))
    return quality.leakage(frame, "fp", "split_name")


def sql_digest(source: str, leaf: int = settings.DIGEST_LEAF) -> str:
    """CTEs ending in n0(g), the root of the hash tree over ``source``(fp), and z(n), its rows."""
    return f"""l AS (SELECT fp, count(*) AS n FROM {source} GROUP BY fp), z AS (SELECT count(*) AS c, sum(n) AS n FROM l),
    dep AS (SELECT CASE WHEN c <= {leaf} THEN 0 WHEN c <= 16 * {leaf} THEN 1 WHEN c <= 256 * {leaf} THEN 2 ELSE 3 END AS d FROM z),
    leaves AS (SELECT substr(fp, 1, d) AS r, sha256(string_agg(fp || ' ' || n, chr(10) ORDER BY fp || ' ' || n)) AS g FROM l, dep GROUP BY 1),
    n2 AS (SELECT r, g FROM leaves, dep WHERE d = 2 UNION ALL
      SELECT substr(r, 1, 2), sha256(string_agg(r || ' ' || g, chr(10) ORDER BY r)) FROM leaves, dep WHERE d = 3 GROUP BY 1),
    n1 AS (SELECT r, g FROM leaves, dep WHERE d = 1 UNION ALL SELECT substr(r, 1, 1), sha256(string_agg(r || ' ' || g, chr(10) ORDER BY r)) FROM n2 GROUP BY 1),
    n0 AS (SELECT g FROM leaves, dep WHERE d = 0 UNION ALL SELECT sha256(string_agg(r || ' ' || g, chr(10) ORDER BY r)) FROM n1 HAVING count(*) > 0)"""


_LEAF = 16


@query("d08_dataset_fingerprint", f"WITH {sql_digest(f'({SQL_HASH_SPLIT})')} SELECT g AS dataset_fingerprint, CAST(n AS BIGINT) AS n_rows FROM n0, z")
def d08(spark, sf):
    frame = posts(spark, sf).select(tx.fingerprint(F.col("text")).alias("fp"))
    return quality.dataset_fingerprint(frame, "fp")


@query(
    "d08_deep_fingerprint",
    f"WITH {sql_digest(f'({SQL_HASH_SPLIT})', _LEAF)} SELECT g AS dataset_fingerprint, CAST(n AS BIGINT) AS n_rows FROM n0, z",
)
def d08_deep(spark, sf):
    frame = posts(spark, sf).select(tx.fingerprint(F.col("text")).alias("fp"))
    return quality.dataset_fingerprint(frame, "fp", _LEAF)


# --- profiles ----------------------------------------------------------------------


@query(
    "q01_quality_summary",
    f"""WITH {SQL_NEAR}, c AS ({SQL_CLEAN_POSTS})
    SELECT count(*) AS n_rows, count(*) - count(DISTINCT clean) AS n_exact, (SELECT count(*) FROM near) AS n_near,
      CAST(min(length(clean)) AS BIGINT) AS min_chars, median(length(clean))::DOUBLE AS median_chars,
      round(avg(length(clean)), 6) AS mean_chars, CAST(max(length(clean)) AS BIGINT) AS max_chars FROM c""",
)
def q01(spark, sf):
    summary = corpus.quality_summary(clean_posts(spark, sf), "doc_id", "clean")
    return summary.select(
        "n_rows", "n_exact", "n_near", F.col("min_chars").cast("long").alias("min_chars"), "median_chars",
        r6(F.col("mean_chars")).alias("mean_chars"), F.col("max_chars").cast("long").alias("max_chars"),
    )


@query(
    "q01_quality_by_source",
    f"""WITH p AS (SELECT source_id, coalesce(CAST(l.quality AS VARCHAR), 'none') AS label, length(clean) AS len
      FROM ({SQL_CLEAN_POSTS}) c LEFT JOIN labels l ON l.doc_id = c.doc_id),
    k AS (SELECT source_id, label, count(*) AS n FROM p GROUP BY ALL)
    SELECT p.source_id, count(*) AS n_rows, round(avg(len), 6) AS mean_chars,
      (SELECT string_agg(label || '=' || n, ',' ORDER BY label) FROM k WHERE k.source_id = p.source_id) AS label_counts
    FROM p GROUP BY p.source_id""",
)
def q01_source(spark, sf):
    labels = table(spark, sf, "labels").select("doc_id", F.col("quality").cast("string").alias("label"))
    frame = clean_posts(spark, sf).join(labels, "doc_id", "left").withColumn("label", F.coalesce("label", F.lit("none")))
    out = quality.quality_by_source(frame, "clean", "label")
    pairs = F.transform(F.map_entries("label_counts"), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string")))
    return out.select("source_id", "n_rows", r6(F.col("mean_chars")).alias("mean_chars"), F.array_join(F.sort_array(pairs), ",").alias("label_counts"))


@query(
    "q02_split_counts",
    """WITH x AS (SELECT source AS source_id, CASE doc_id % 3 WHEN 0 THEN 'train' WHEN 1 THEN 'val' ELSE 'test' END AS split_name FROM documents)
    SELECT coalesce(source_id, 'all') AS source_id, coalesce(split_name, 'all') AS split_name, count(*) AS n FROM x GROUP BY CUBE (source_id, split_name)""",
)
def q02(spark, sf):
    name = F.when(F.col("doc_id") % 3 == 0, "train").when(F.col("doc_id") % 3 == 1, "val").otherwise("test")
    counts = quality.split_counts(posts(spark, sf).select("source_id", name.alias("split_name")))
    return counts.select(
        F.coalesce("source_id", F.lit("all")).alias("source_id"), F.coalesce("split_name", F.lit("all")).alias("split_name"), "n"
    )


@query(
    "q02_split_matrix",
    """SELECT source AS source_id, count(*) FILTER (doc_id % 3 = 0) AS train, count(*) FILTER (doc_id % 3 = 1) AS val,
      count(*) FILTER (doc_id % 3 = 2) AS test FROM documents GROUP BY 1""",
)
def q02_matrix(spark, sf):
    name = F.when(F.col("doc_id") % 3 == 0, "train").when(F.col("doc_id") % 3 == 1, "val").otherwise("test")
    return quality.split_matrix(posts(spark, sf).select("source_id", name.alias("split_name")))


@query(
    "q03_missing",
    """WITH x AS (SELECT CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS c_acctbal, CASE WHEN c_nationkey > 3 THEN c_nationkey END AS c_nationkey, c_name FROM customer)
    SELECT 'c_acctbal' AS column_name, count(*) - count(c_acctbal) AS n_missing, round((count(*) - count(c_acctbal)) * 100.0e0 / count(*), 2) AS pct_missing FROM x
    UNION ALL SELECT 'c_nationkey', count(*) - count(c_nationkey), round((count(*) - count(c_nationkey)) * 100.0e0 / count(*), 2) FROM x
    UNION ALL SELECT 'c_name', count(*) - count(c_name), round((count(*) - count(c_name)) * 100.0e0 / count(*), 2) FROM x""",
)
def q03(spark, sf):
    frame = table(spark, sf, "customer").select(
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("c_acctbal"),
        F.when(F.col("c_nationkey") > 3, F.col("c_nationkey")).alias("c_nationkey"), "c_name",
    )
    return quality.missing(frame)


@query(
    "q04_audit",
    f"""WITH x AS (SELECT CASE WHEN doc_id % 7 > 0 THEN text END AS text_raw, {sql_clean('text')} AS text_clean,
      sha256({sql_normal('text')}) AS text_fingerprint, CASE WHEN doc_id % 11 > 0 THEN 'train' ELSE 'dev' END AS split_name FROM documents)
    SELECT 'null_text_raw' AS rule, count(*) FILTER (text_raw IS NULL) AS n_violations FROM x
    UNION ALL SELECT 'null_text_clean', count(*) FILTER (text_clean IS NULL) FROM x
    UNION ALL SELECT 'null_text_fingerprint', count(*) FILTER (text_fingerprint IS NULL) FROM x
    UNION ALL SELECT 'null_split_name', count(*) FILTER (split_name IS NULL) FROM x
    UNION ALL SELECT 'unknown_split_name', count(*) FILTER (split_name NOT IN ('train', 'val', 'test')) FROM x
    UNION ALL SELECT 'duplicate_text_clean', count(*) - count(DISTINCT text_clean) FROM x
    UNION ALL SELECT 'duplicate_text_fingerprint', count(*) - count(DISTINCT text_fingerprint) FROM x""",
)
def q04(spark, sf):
    frame = posts(spark, sf).select(
        F.when(F.col("doc_id") % 7 > 0, F.col("text")).alias("text_raw"),
        tx.clean_text(F.col("text")).alias("text_clean"),
        tx.fingerprint(F.col("text")).alias("text_fingerprint"),
        F.when(F.col("doc_id") % 11 > 0, "train").otherwise("dev").alias("split_name"),
    )
    return quality.audit(frame)


# --- splits and samples ------------------------------------------------------------


@query(
    "p01_stratified_split",
    f"WITH src AS ({SQL_LABELLED}), {sql_stratified('src')} SELECT doc_id, split_name FROM split_rows",
)
def p01(spark, sf):
    return splits.stratified(labelled(spark, sf), "doc_id", "label", "source_id").select("doc_id", "split_name")


# CTEs after src: cut holds its rows with their split_name.
SQL_THREE_WAY = f"""{sql_take('a', 'src', ['label'], SQL_TEST)},
    rest AS (SELECT * EXCLUDE (taken) FROM a WHERE NOT taken), {sql_take('b', 'rest', ['label'], SQL_VAL)},
    cut AS (SELECT doc_id, label, 'test' AS split_name FROM a WHERE taken
      UNION ALL SELECT doc_id, label, CASE WHEN taken THEN 'val' ELSE 'train' END FROM b)"""


@query("p02_label_split", f"WITH src AS ({SQL_LABELLED}), {SQL_THREE_WAY} SELECT doc_id, split_name FROM cut")
def p02(spark, sf):
    return splits.stratified(labelled(spark, sf), "doc_id", "label").select("doc_id", "split_name")


@query(
    "p03_group_split",
    f"""WITH src AS ({SQL_LABELLED}), g AS (SELECT source_id, label AS majority FROM (SELECT source_id, label,
      row_number() OVER (PARTITION BY source_id ORDER BY count(*) DESC, label) AS k FROM src GROUP BY source_id, label) WHERE k = 1),
    {sql_take('a', 'g', ['majority'], SQL_TEST, key='source_id')},
    rest AS (SELECT * EXCLUDE (taken) FROM a WHERE NOT taken), {sql_take('b', 'rest', ['majority'], SQL_VAL, key='source_id')},
    n AS (SELECT source_id, 'test' AS split_name FROM a WHERE taken
      UNION ALL SELECT source_id, CASE WHEN taken THEN 'val' ELSE 'train' END FROM b)
    SELECT doc_id, split_name FROM src JOIN n USING (source_id)""",
)
def p03(spark, sf):
    return splits.grouped(labelled(spark, sf), "doc_id", "label").select("doc_id", "split_name")


@query(
    "p04_holdout_and_halves",
    f"""WITH src AS ({SQL_LABELLED}), {sql_take('a', 'src', ['label'], 'ceil(size * 0.1e0)')},
    held AS (SELECT * EXCLUDE (taken) FROM a WHERE taken), {sql_take('b', 'held', ['label'], 'ceil(size * 0.5e0)')}
    SELECT doc_id, 'fit' AS part FROM a WHERE NOT taken
    UNION ALL SELECT doc_id, CASE WHEN taken THEN 'select' ELSE 'calibrate' END FROM b""",
)
def p04(spark, sf):
    cut = splits.holdout(labelled(spark, sf), "doc_id", "label")
    calibrate, select = splits.calibration_halves(cut.filter("held_out"), "doc_id", "label")
    return (
        cut.filter(~F.col("held_out")).select("doc_id", F.lit("fit").alias("part"))
        .unionByName(calibrate.select("doc_id", F.lit("calibrate").alias("part")))
        .unionByName(select.select("doc_id", F.lit("select").alias("part")))
    )


@query(
    "p05_cap_rows",
    f"WITH src AS ({SQL_LABELLED}), {sql_take('a', 'src', ['label'], '150')} SELECT doc_id, label FROM a WHERE taken",
)
def p05(spark, sf):
    return splits.cap(labelled(spark, sf), "doc_id", "label", 150).select("doc_id", "label")


@query(
    "p06_random_split",
    f"""SELECT doc_id, CASE WHEN CAST('0x' || substr({sql_hash('doc_id')}, 1, 8) AS BIGINT) / 4294967296.0e0 < 0.2 THEN 'test'
      ELSE 'train' END AS split_name FROM documents""",
)
def p06(spark, sf):
    return splits.random_split(posts(spark, sf), "doc_id", 0.2).select("doc_id", "split_name")


@query(
    "p06_sample_per_group",
    f"SELECT source AS source_id, arg_min(doc_id, {sql_hash('doc_id')}) AS doc_id FROM documents GROUP BY 1",
)
def p06_sample(spark, sf):
    return splits.sample_per_group(posts(spark, sf), "source_id", "doc_id").select("source_id", "doc_id")


@query(
    "p07_oversample_copies",
    f"""WITH src AS ({SQL_LABELLED}), c AS (SELECT label, count(*) AS n FROM src GROUP BY 1), m AS (SELECT max(n) AS big FROM c),
    r AS (SELECT s.doc_id, s.label, row_number() OVER (PARTITION BY s.label ORDER BY {sql_hash('s.doc_id')}) AS k, n, big
      FROM src s JOIN c ON c.label = s.label, m)
    SELECT doc_id, label, CAST(big // n + CASE WHEN k <= big % n THEN 1 ELSE 0 END AS BIGINT) AS copies FROM r""",
)
def p07(spark, sf):
    copies = splits.oversample(labelled(spark, sf), "doc_id", "label", mode="copies")
    return copies.groupBy("doc_id", "label").agg(F.count("*").alias("copies"))


@query(
    "p07_oversample_weight",
    f"""WITH src AS ({SQL_LABELLED}), c AS (SELECT label, count(*) AS n FROM src GROUP BY 1)
    SELECT doc_id, round((SELECT max(n) FROM c)::DOUBLE / n, 6) AS weight FROM src JOIN c USING (label)""",
)
def p07_weight(spark, sf):
    weighted = splits.oversample(labelled(spark, sf), "doc_id", "label")
    return weighted.select("doc_id", r6(F.col("weight")).alias("weight"))


@query(
    "p08_class_weights",
    f"""WITH src AS ({SQL_LABELLED}), c AS (SELECT label, count(*) AS n FROM src GROUP BY 1)
    SELECT doc_id, round((SELECT sum(n) FROM c)::DOUBLE / ((SELECT count(*) FROM c) * n), 6) AS weight FROM src JOIN c USING (label)""",
)
def p08(spark, sf):
    return splits.class_weights(labelled(spark, sf), "label").select("doc_id", r6(F.col("weight")).alias("weight"))


@query(
    "p09_folds",
    f"""WITH src AS ({SQL_LABELLED}), t AS (SELECT least(5, greatest(2, count(*) // 50)) AS k FROM src),
    r AS (SELECT doc_id, row_number() OVER (PARTITION BY label ORDER BY {sql_hash('doc_id')}) AS rk, count(*) OVER (PARTITION BY label) AS n FROM src)
    SELECT doc_id, CAST(len(list_filter(range(1, k), lambda j: ceil(n * j / CAST(k AS DOUBLE)) < rk)) AS INT) AS fold FROM r, t""",
)
def p09(spark, sf):
    return splits.folds(labelled(spark, sf), "doc_id", "label").select("doc_id", "fold")


@query("p09_group_folds")
def p09_groups(spark, sf):
    return splits.folds(labelled(spark, sf), "doc_id", "label", group="source_id").select("doc_id", "source_id", "fold")


@query(
    "p10_balanced_batches",
    f"""WITH src AS ({SQL_LABELLED}), r AS (SELECT doc_id, label, row_number() OVER (PARTITION BY label ORDER BY {sql_hash('doc_id')}) AS rk FROM src),
    m AS (SELECT min(n) AS least FROM (SELECT count(*) AS n FROM src GROUP BY label))
    SELECT doc_id, (rk - 1) * 2 + (1 - label) AS position, ((rk - 1) * 2 + (1 - label)) // 32 AS batch FROM r, m WHERE rk <= least""",
)
def p10(spark, sf):
    return splits.balanced_batches(labelled(spark, sf), "doc_id", "label", 32).select("doc_id", "position", "batch")


@query(
    "p10_positives_with_negatives",
    f"""WITH src AS (SELECT doc_id, 1 - label AS label FROM ({SQL_LABELLED})),
    r AS (SELECT doc_id, label, row_number() OVER (PARTITION BY label ORDER BY {sql_hash('doc_id')}) AS rk FROM src)
    SELECT doc_id, label, {sql_hash('doc_id', SEED + 1)} AS order_hash FROM r
    WHERE label = 1 OR rk <= (SELECT count(*) FROM src WHERE label = 1)""",
)
def p10_all(spark, sf):
    # The rare class plays the positives here, as users with a diagnosis are the rare ones.
    frame = labelled(spark, sf).select("doc_id", (1 - F.col("label")).alias("label"))
    return splits.positives_with_negatives(frame, "doc_id", "label").select("doc_id", "label", "order_hash")

"""Sources, text and label operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import settings
from ..functions import labels as lb
from ..functions import text as tx
from ..operators import labelling, quality, rows
from ..session import local_rows
from ..sources import readers
from .base import (
    SQL_CLEAN_POSTS,
    SQL_LABELLED,
    clean_posts,
    labelled,
    posts,
    sql_clean,
    sql_normal,
    sql_tokens,
    sql_values,
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


# Fixture vocabulary: the driver's texts are invented prose.
STOPWORDS = ["the", "of", "and", "to", "in", "is", "that", "le", "la", "de", "und", "der"]
STEMS = [("the", "th"), ("and", "an"), ("ouen", "ou"), ("erst", "er"), ("les", "le"), ("des", "de"), ("die", "di")]
EVENT_CODES = {"click": 0, "error": 1, "login": 2, "purchase": 3, "view": 4}


@query(
    "s02_detect_columns",
    "SELECT source AS label_raw, count(*) AS n, CAST(sum(length(text)) AS BIGINT) AS n_chars FROM documents GROUP BY 1",
)
def s02(spark, sf):
    raw = table(spark, sf, "documents").select("doc_id", F.col("text").alias("Statement"), F.col("source").alias("STATUS"))
    found = readers.normalise_columns(raw)
    return found.groupBy("label_raw").agg(F.count("*").alias("n"), F.sum(F.length("text_raw")).alias("n_chars"))


@query(
    "s05_import_report",
    f"""WITH p AS ({SQL_CLEAN_POSTS}), j AS (
      SELECT p.*, coalesce(l.quality, 0) AS label FROM p LEFT JOIN labels l ON p.doc_id = l.doc_id
      WHERE length(clean) >= {settings.MIN_SAMPLE_CHARS}),
    per AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source_id, clean ORDER BY doc_id) AS k FROM j) WHERE k = 1),
    merged AS (SELECT *, row_number() OVER (PARTITION BY clean ORDER BY CAST(substr(source_id, 4) AS INT), doc_id) AS g FROM per)
    SELECT source_id, count(*) AS n_rows, CAST(sum(label) AS BIGINT) AS n_positive,
      CAST(sum(CASE WHEN g = 1 THEN 1 ELSE 0 END) AS BIGINT) AS n_merged FROM merged GROUP BY 1""",
)
def s05(spark, sf):
    joined = clean_posts(spark, sf).join(
        table(spark, sf, "labels").select("doc_id", F.col("quality").alias("label")), "doc_id", "left"
    )
    frame = joined.filter(F.length("clean") >= settings.MIN_SAMPLE_CHARS).select(
        "doc_id", "source_id", "clean", F.coalesce("label", F.lit(0)).alias("label")
    )
    rank = F.substring("source_id", 4, 10).cast("int")
    keyed = frame.withColumn("row_key", quality.ordered_key(rank, F.col("doc_id")))
    return readers.import_report(keyed, "source_id", "clean", "label", "row_key")


@query(
    "s07_two_class_filter",
    "SELECT event_id, event_type FROM events WHERE event_type IN ('click', 'error')",
)
def s07(spark, sf):
    events = table(spark, sf, "events").select("event_id", "event_type")
    return readers.two_class(events, "event_type", ("click", "error"))


@query("t01_clean_text", f"SELECT doc_id, {sql_clean('text')} AS text_clean FROM documents")
def t01(spark, sf):
    return posts(spark, sf).select("doc_id", tx.clean_text(F.col("text")).alias("text_clean"))


@query("t01_clean_text_urls", f"SELECT page_id, {sql_clean('html')} AS text_clean FROM pages")
def t01_urls(spark, sf):
    return table(spark, sf, "pages").select("page_id", tx.clean_text(F.col("html")).alias("text_clean"))


@query(
    "t02_looks_english",
    r"""SELECT doc_id, CASE WHEN letters = 0 THEN true ELSE latin::DOUBLE / letters >= 0.82 END AS is_english FROM (
      SELECT doc_id, length(regexp_replace(substr(text, 1, 200), '[^\p{L}]', '', 'g')) AS letters,
      length(regexp_replace(lower(substr(text, 1, 200)), '[^a-z]', '', 'g')) AS latin FROM documents)""",
)
def t02(spark, sf):
    return posts(spark, sf).select("doc_id", tx.looks_english(F.col("text")).alias("is_english"))


@query("t03_normalized_text", f"SELECT doc_id, {sql_normal('text')} AS text_normal FROM documents")
def t03(spark, sf):
    return posts(spark, sf).select("doc_id", tx.normalized_text(F.col("text")).alias("text_normal"))


@query("t04_fingerprint", f"SELECT doc_id, sha256({sql_normal('text')}) AS text_fingerprint FROM documents")
def t04(spark, sf):
    return posts(spark, sf).select("doc_id", tx.fingerprint(F.col("text")).alias("text_fingerprint"))


@query(
    "t05_shingles",
    f"""WITH w AS (SELECT doc_id, {sql_tokens(sql_normal('text'))} AS w FROM documents),
    g AS (SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
      ELSE [w[i] || ' ' || w[i+1] || ' ' || w[i+2] for i in range(1, len(w) - 1)] END) AS s FROM w)
    SELECT doc_id, count(DISTINCT s) AS n_shingles, md5(string_agg(DISTINCT s, '|' ORDER BY s)) AS digest FROM g GROUP BY 1""",
)
def t05(spark, sf):
    sets = posts(spark, sf).select("doc_id", F.sort_array(tx.shingles(F.col("text"))).alias("s")).filter(F.size("s") > 0)
    return sets.select("doc_id", F.size("s").cast("long").alias("n_shingles"), F.md5(F.array_join("s", "|")).alias("digest"))


@query(
    "t06_drop_blank",
    """SELECT doc_id, label FROM (SELECT doc_id, trim(source) AS label,
      row_number() OVER (PARTITION BY text ORDER BY doc_id) AS k FROM documents WHERE text IS NOT NULL AND length(text) > 0)
    WHERE k = 1""",
)
def t06(spark, sf):
    frame = posts(spark, sf).select("doc_id", "text", F.concat(F.lit(" "), "source_id", F.lit(" ")).alias("label"))
    return rows.drop_blank(frame, "text", "label", "doc_id").select("doc_id", "label")


@query(
    "t07_coalesce_text",
    """SELECT page_id, coalesce(CASE WHEN page_id % 3 <> 0 THEN html END, url) AS text_raw FROM pages""",
)
def t07(spark, sf):
    pages = table(spark, sf, "pages").withColumn("first", F.when(F.col("page_id") % 3 != 0, F.col("html")))
    return pages.select("page_id", tx.coalesce_text([F.col("first"), F.col("url")]).alias("text_raw"))


@query(
    "t08_min_length",
    f"""SELECT doc_id, length(clean) AS char_len FROM ({SQL_CLEAN_POSTS})
    WHERE length(clean) >= CASE source_id WHEN 'src1' THEN 2000 WHEN 'src2' THEN 12 ELSE 20 END""",
)
def t08(spark, sf):
    overrides = local_rows(spark, [("src1", 2000), ("src2", 12)], "source_id string, min_chars int")
    lengths = clean_posts(spark, sf).select("doc_id", "source_id", F.length("clean").cast("long").alias("char_len"))
    return rows.min_length(lengths, "char_len", overrides=overrides).select("doc_id", "char_len")


@query(
    "t09_clean_markup",
    r"""WITH a AS (SELECT page_id, regexp_replace(lower(html), '[^\p{L}\p{N}_\s]', '', 'g') AS t FROM pages),
    b AS (SELECT page_id, regexp_replace(replace(t, chr(10), ''), '\d', '', 'g') AS t FROM a),
    c AS (SELECT page_id, regexp_replace(t, 'https?://\S+|www\.\S+', '', 'g') AS t FROM b),
    d AS (SELECT page_id, trim(regexp_replace(t, '\s+', ' ', 'g')) AS t FROM c)
    SELECT page_id, array_to_string(list_filter(string_split(t, ' '), lambda x: x <> '' AND x NOT IN ("""
    + ", ".join(f"'{w}'" for w in STOPWORDS)
    + ")), ' ') AS text_clean FROM d",
)
def t09(spark, sf):
    return table(spark, sf, "pages").select("page_id", tx.clean_markup(F.col("html"), STOPWORDS).alias("text_clean"))


@query(
    "t10_clean_social",
    r"""SELECT doc_id, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(text),
      'https?://\S+', '', 'g'), '\[.*?\]\(.*?\)', '', 'g'), '@[\p{L}\p{N}_]+', '', 'g'), '[^\p{L}\p{N}_\s]', '', 'g'),
      chr(10) || chr(9) || ' ') AS text_clean FROM documents""",
)
def t10(spark, sf):
    return posts(spark, sf).select("doc_id", tx.clean_social(F.col("text")).alias("text_clean"))


@query(
    "t11_tokens",
    f"""SELECT doc_id, CAST(len(w) AS BIGINT) AS n_tokens, array_to_string(w, '|') AS tokens FROM (
      SELECT doc_id, {sql_tokens('clean')} AS w FROM ({SQL_CLEAN_POSTS}))""",
)
def t11(spark, sf):
    words = clean_posts(spark, sf).select("doc_id", tx.tokens(F.col("clean")).alias("w"))
    return words.select("doc_id", F.size("w").cast("long").alias("n_tokens"), F.array_join("w", "|").alias("tokens"))


@query(
    "t12_map_tokens",
    f"""WITH w AS (SELECT doc_id, unnest({sql_tokens('clean')}) AS token,
      generate_subscripts({sql_tokens('clean')}, 1) AS pos FROM ({SQL_CLEAN_POSTS})),
    m AS (SELECT doc_id, string_agg(coalesce(t.stem, token), ' ' ORDER BY pos) AS mapped FROM w
      LEFT JOIN {sql_values(STEMS, 'tok, stem')} ON t.tok = w.token GROUP BY doc_id)
    SELECT d.doc_id, coalesce(mapped, '') AS mapped FROM documents d LEFT JOIN m ON d.doc_id = m.doc_id""",
)
def t12(spark, sf):
    words = clean_posts(spark, sf).select("doc_id", tx.tokens(F.col("clean")).alias("w"))
    return rows.map_tokens(words, "doc_id", "w", local_rows(spark, STEMS, "token string, stem string")).select(
        "doc_id", "mapped"
    )


@query(
    "t13_drop_rarest",
    f"""WITH w AS (SELECT doc_id, unnest({sql_tokens('clean')}) AS token,
      generate_subscripts({sql_tokens('clean')}, 1) AS pos FROM ({SQL_CLEAN_POSTS})),
    r AS (SELECT token FROM w GROUP BY token ORDER BY count(*), token DESC LIMIT 1000),
    k AS (SELECT doc_id, string_agg(token, ' ' ORDER BY pos) AS kept FROM w WHERE token NOT IN (SELECT token FROM r) GROUP BY doc_id)
    SELECT d.doc_id, coalesce(kept, '') AS kept FROM documents d LEFT JOIN k ON d.doc_id = k.doc_id""",
)
def t13(spark, sf):
    words = clean_posts(spark, sf).select("doc_id", tx.tokens(F.col("clean")).alias("w"))
    return rows.drop_rarest(words, "doc_id", "w", 1000).select("doc_id", F.array_join("w", " ").alias("kept"))


@query(
    "t14_char_sentence_counts",
    """SELECT doc_id, CAST(length(text) AS BIGINT) AS num_of_characters,
      CAST(greatest(len(regexp_extract_all(text, '[.!?]+')), 1) AS BIGINT) AS num_of_sentences FROM documents""",
)
def t14(spark, sf):
    out = rows.char_sentence_counts(posts(spark, sf), "text")
    return out.select(
        "doc_id", F.col("num_of_characters").cast("long").alias("num_of_characters"),
        F.col("num_of_sentences").cast("long").alias("num_of_sentences"),
    )


@query("t15_longer_than", "SELECT doc_id, n_chars FROM documents WHERE n_chars > 10000")
def t15(spark, sf):
    return rows.longer_than(table(spark, sf, "documents").select("doc_id", "n_chars"), "n_chars", 10000)


@query(
    "t16_fill_or_drop",
    """SELECT c_custkey, coalesce(CASE WHEN c_acctbal >= 0 THEN c_mktsegment END, 'unknown') AS segment,
      CASE WHEN c_nationkey % 5 <> 0 THEN c_nationkey END AS nation
    FROM customer WHERE c_nationkey % 5 <> 0""",
)
def t16(spark, sf):
    frame = table(spark, sf, "customer").select(
        "c_custkey", "c_name", F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment")).alias("segment"),
        F.when(F.col("c_nationkey") % 5 != 0, F.col("c_nationkey")).alias("nation"),
    )
    return rows.fill_or_drop(frame, ["c_name"], {"segment": "unknown"}, drop_incomplete=True)


@query(
    "t17_encode_decode",
    "SELECT event_id, code, CASE WHEN code IS NOT NULL THEN event_type END AS decoded FROM (SELECT event_id, event_type, CASE event_type "
    + " ".join(f"WHEN '{k}' THEN {v}" for k, v in EVENT_CODES.items())
    + " END AS code FROM events)",
)
def t17(spark, sf):
    events = table(spark, sf, "events").select("event_id", "event_type")
    coded = rows.encode(events, "event_type", EVENT_CODES, "code")
    return rows.decode(coded, "code", EVENT_CODES, "decoded").select("event_id", "code", "decoded")


@query(
    "t18_input_gate",
    r"""SELECT doc_id, CASE WHEN length(t) = 0 THEN 'empty' WHEN length(t) < 12 THEN 'too_short'
      WHEN letters > 0 AND latin::DOUBLE / letters < 0.82 THEN 'not_english'
      WHEN length(t) < 40 THEN 'short_warning' ELSE 'ok' END AS gate FROM (
      SELECT doc_id, t, length(regexp_replace(substr(t, 1, 200), '[^\p{L}]', '', 'g')) AS letters,
      length(regexp_replace(lower(substr(t, 1, 200)), '[^a-z]', '', 'g')) AS latin
      FROM (SELECT doc_id, trim(text) AS t FROM documents))""",
)
def t18(spark, sf):
    return posts(spark, sf).select("doc_id", tx.input_gate(F.col("text")).alias("gate"))


@query(
    "l01_normalise_label",
    """SELECT event_id,
      CASE WHEN trunc(value) = 1 THEN '1' ELSE '0' END AS from_number,
      CASE WHEN event_type IN ('error') THEN '1' ELSE '0' END AS from_status,
      CASE WHEN value >= 1 THEN '1' ELSE '0' END AS from_severity FROM events""",
)
def l01(spark, sf):
    events = table(spark, sf, "events")
    status = F.concat(F.lit("  "), "event_type", F.lit(" "))
    return events.select(
        "event_id",
        lb.normalise_label(F.col("value"), "binary_numeric").alias("from_number"),
        lb.normalise_label(status, "mental_health_status", ["error"]).alias("from_status"),
        lb.normalise_label(F.col("value"), "urdu_severity").alias("from_severity"),
    )


@query(
    "l02_binary_labels",
    """SELECT e.event_id, CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS y_word,
      CASE WHEN value >= 5 THEN 1 ELSE 0 END AS y_number FROM events e""",
)
def l02(spark, sf):
    events = table(spark, sf, "events").select("event_id", "event_type", (F.col("value") >= 5).cast("int").alias("flag"))
    both = labelling.binary_labels(events, "event_type", ["error"], "y_word")
    return labelling.binary_labels(both, "flag", ["error"], "y_number").select("event_id", "y_word", "y_number")


@query(
    "l03_store_labels",
    "SELECT doc_id, CAST(quality AS VARCHAR) AS label_raw FROM labels",
)
def l03(spark, sf):
    frame = table(spark, sf, "labels").select("doc_id", F.col("quality").cast("double").cast("string").alias("label_raw"))
    return labelling.store_labels(frame, "label_raw")


@query(
    "l04_majority_label",
    f"""SELECT source_id, label AS majority FROM (SELECT source_id, label,
      row_number() OVER (PARTITION BY source_id ORDER BY count(*) DESC, label) AS k
      FROM ({SQL_LABELLED}) GROUP BY source_id, label) WHERE k = 1""",
)
def l04(spark, sf):
    return labelling.majority_label(labelled(spark, sf), "source_id", "label")

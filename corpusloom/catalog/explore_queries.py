"""Exploration tables and user-level preparation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import explore, histories
from ..sources import store
from .base import SEED, r6, table

QUERIES, ORACLE = {}, {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


NUMERIC = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
EVENT_TYPES = ("click", "error", "login", "purchase", "view")


def _rounded(df, columns):
    return df.withColumns({c: r6(F.col(c)) for c in columns})


@query(
    "x01_describe",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count({c}) AS n, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, min({c}) AS min,
        quantile_cont({c}, 0.25) AS q25, quantile_cont({c}, 0.5) AS q50, quantile_cont({c}, 0.75) AS q75, max({c}) AS max FROM lineitem"""
        for c in NUMERIC
    ),
)
def x01(spark, sf):
    return _rounded(explore.describe(table(spark, sf, "lineitem"), NUMERIC), ["mean", "std"])


@query(
    "x02_correlations",
    " UNION ALL ".join(
        f"SELECT '{a}' AS column_a, '{b}' AS column_b, round(corr({a}, {b}), 6) AS corr FROM lineitem"
        for a in NUMERIC
        for b in NUMERIC
    ),
)
def x02(spark, sf):
    return _rounded(explore.correlations(table(spark, sf, "lineitem"), NUMERIC), ["corr"])


@query(
    "x03_histogram",
    """WITH s AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem),
    b AS (SELECT l_returnflag, CAST(least(floor((l_extendedprice - lo) * 25 / (hi - lo)), 24) AS INT) AS bin FROM lineitem, s)
    SELECT l_returnflag, bin, count(*) AS n, round(lo + bin * ((hi - lo) / 25), 6) AS bin_from,
      round(lo + (bin + 1) * ((hi - lo) / 25), 6) AS bin_to FROM b, s GROUP BY l_returnflag, bin, lo, hi""",
)
def x03(spark, sf):
    out = explore.histogram(table(spark, sf, "lineitem"), "l_extendedprice", 25, ["l_returnflag"])
    return _rounded(out, ["bin_from", "bin_to"])


@query(
    "x04_quartiles_by",
    """SELECT l_returnflag, count(*) AS n, min(l_extendedprice) AS min, round(quantile_cont(l_extendedprice, 0.25), 6) AS q25,
      round(quantile_cont(l_extendedprice, 0.5), 6) AS q50, round(quantile_cont(l_extendedprice, 0.75), 6) AS q75,
      max(l_extendedprice) AS max, round(avg(l_extendedprice), 4) AS mean FROM lineitem GROUP BY 1""",
)
def x04(spark, sf):
    out = explore.quartiles_by(table(spark, sf, "lineitem"), "l_extendedprice", "l_returnflag")
    return _rounded(out, ["q25", "q50", "q75"]).withColumn("mean", F.round("mean", 4))


@query(
    "x05_shares",
    "SELECT event_type AS value, count(*) AS n, round(count(*) / (SELECT count(*)::DOUBLE FROM events), 6) AS share FROM events GROUP BY 1",
)
def x05(spark, sf):
    return _rounded(explore.shares(table(spark, sf, "events"), "event_type"), ["share"])


@query(
    "x05_column_totals",
    """WITH s AS (SELECT sum(l_quantity) AS a, sum(l_discount) AS b, sum(l_tax) AS c FROM lineitem)
    SELECT 'l_quantity' AS column_name, round(a, 4) AS total, round(a / (a + b + c), 6) AS share FROM s
    UNION ALL SELECT 'l_discount', round(b, 4), round(b / (a + b + c), 6) FROM s
    UNION ALL SELECT 'l_tax', round(c, 4), round(c / (a + b + c), 6) FROM s""",
)
def x05_totals(spark, sf):
    out = explore.column_totals(table(spark, sf, "lineitem"), ["l_quantity", "l_discount", "l_tax"])
    return _rounded(out, ["share"]).withColumn("total", F.round("total", 4))


@query(
    "x06_agreement",
    "SELECT quality, toxic, count(*) AS n, quality = toxic AS label_match FROM labels GROUP BY ALL",
)
def x06(spark, sf):
    return explore.agreement(table(spark, sf, "labels"), "quality", "toxic")


@query(
    "x06_agreement_rate",
    "SELECT count(*) AS n, count(*) FILTER (quality = toxic) AS n_match, round(count(*) FILTER (quality = toxic) / count(*)::DOUBLE, 6) AS accuracy FROM labels",
)
def x06_rate(spark, sf):
    return _rounded(explore.agreement_rate(table(spark, sf, "labels"), "quality", "toxic"), ["accuracy"])


@query(
    "x07_mean_by",
    "WITH o AS (SELECT * FROM (VALUES "
    + ", ".join(f"({i}, '{c}')" for i, c in enumerate((*EVENT_TYPES, "none")))
    + """) AS t(position, event_type)) SELECT CAST(o.position AS INT) AS position, o.event_type, round(avg(value), 6) AS mean
    FROM o LEFT JOIN events e ON e.event_type = o.event_type GROUP BY 1, 2""",
)
def x07(spark, sf):
    return _rounded(explore.mean_by(table(spark, sf, "events"), "value", "event_type", (*EVENT_TYPES, "none")), ["mean"])


@query(
    "x08_monthly",
    "SELECT strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS period, count(*) AS n FROM orders GROUP BY 1",
)
def x08(spark, sf):
    return explore.monthly(table(spark, sf, "orders"), "o_orderdate")


@query(
    "x08_daily_by_class",
    "SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS period, "
    + ", ".join(f"count(*) FILTER (event_type = '{c}') AS {c}" for c in EVENT_TYPES)
    + " FROM events GROUP BY 1",
)
def x08_day(spark, sf):
    return explore.monthly_by(table(spark, sf, "events"), "ts", "event_type", EVENT_TYPES, "day")


_DTYPES = [("c_custkey", "bigint"), ("c_name", "string"), ("c_nationkey", "int"), ("c_acctbal", "double"), ("c_mktsegment", "string")]


@query(
    "x09_dictionary",
    "SELECT CAST(p AS INT) AS position, column_name, dtype, (SELECT count(*) FROM customer) AS n_rows, (SELECT count(*) * 5 FROM customer) AS n_cells FROM (VALUES "
    + ", ".join(f"({i}, '{n}', '{t}')" for i, (n, t) in enumerate(_DTYPES))
    + ") AS t(p, column_name, dtype)",
)
def x09(spark, sf):
    return explore.dictionary(table(spark, sf, "customer"))


# --- user histories ----------------------------------------------------------------


def _talks(spark, sf):
    return table(spark, sf, "conversations").select(F.col("conv_id").alias("user_id"), "turn", "text")


_SQL_WORDS = (
    "list_filter(string_split(translate(lower(coalesce(text,'')), '!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~' || chr(9) || chr(10), "
    "repeat(' ', 33)), ' '), lambda t: t <> '')"
)
_SQL_TOKENS = f"SELECT conv_id AS user_id, turn, unnest({_SQL_WORDS}) AS term, generate_subscripts({_SQL_WORDS}, 1) AS pos FROM conversations"
_SQL_VOCAB = f"""tok AS ({_SQL_TOKENS}), vocab AS (SELECT term, CAST(row_number() OVER (ORDER BY term) AS INT) AS index, tf, df FROM (
    SELECT term, count(*) AS tf, count(DISTINCT (user_id, turn)) AS df FROM tok GROUP BY term) WHERE tf >= 3 AND df >= 2)"""


@query("u01_vocabulary", f"WITH {_SQL_VOCAB} SELECT term, index, tf, df FROM vocab")
def u01(spark, sf):
    return histories.vocabulary(_talks(spark, sf), "text")


@query(
    "u02_drop_empty",
    f"""WITH {_SQL_VOCAB},
    kept AS (SELECT DISTINCT user_id, turn FROM tok JOIN vocab USING (term)),
    b AS (SELECT conv_id, count(*) AS n FROM conversations GROUP BY 1), a AS (SELECT user_id, count(*) AS n FROM kept GROUP BY 1)
    SELECT 'before' AS stage, count(*) AS n_users, CAST(sum(n) AS BIGINT) AS n_posts, min(n) AS min_posts, round(avg(n), 6) AS mean_posts, max(n) AS max_posts FROM b
    UNION ALL SELECT 'after', count(*), CAST(coalesce(sum(n), 0) AS BIGINT), min(n), round(avg(n), 6), max(n) FROM a""",
)
def u02(spark, sf):
    talks = _talks(spark, sf)
    kept = histories.drop_empty(talks, "user_id", "turn", "text", histories.vocabulary(talks, "text"))
    return _rounded(histories.empty_summary(talks, kept, "user_id"), ["mean_posts"])


_N = 3


def _sql_select(how: str) -> str:
    base = """r AS (SELECT conv_id AS user_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS k,
      row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS back, count(*) OVER (PARTITION BY conv_id) AS c FROM conversations)"""
    if how == "first":
        return f"WITH {base} SELECT user_id, turn, CAST(k AS INT) AS slot FROM r WHERE k < {_N}"
    if how == "last":
        return f"WITH {base} SELECT user_id, turn, CAST(least(c, {_N}) - back AS INT) AS slot FROM r WHERE back <= {_N}"
    if how == "random":
        return f"""WITH {base} SELECT user_id, turn, CAST(row_number() OVER (PARTITION BY user_id ORDER BY
          sha256(concat(user_id, '|', turn, ':{SEED}'))) - 1 AS INT) AS slot FROM r WHERE k < {_N}"""
    return f"""WITH {base}, s AS (SELECT user_id, c, unnest(range(0, least(c, {_N}))) AS slot FROM (SELECT DISTINCT user_id, c FROM r)),
      w AS (SELECT user_id, slot, CASE WHEN c <= {_N} THEN slot WHEN slot = {_N} - 1 THEN c - 1 ELSE floor(slot * ((c - 1) / {_N - 1}.0e0)) END AS k FROM s)
      SELECT r.user_id, turn, CAST(slot AS INT) AS slot FROM r JOIN w ON r.user_id = w.user_id AND r.k = w.k"""


def _register_selection(how: str) -> None:
    @query(f"u03_select_{how}", _sql_select(how))
    def select(spark, sf):
        out = histories.select_posts(_talks(spark, sf), "user_id", "turn", _N, how)
        return out.select("user_id", "turn", F.col("slot").cast("int").alias("slot"))


for _how in histories.HOW:
    _register_selection(_how)


@query(
    "u04_sequences",
    f"""WITH {_SQL_VOCAB}, p AS (SELECT conv_id AS user_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS slot FROM conversations),
    ids AS (SELECT t.user_id, p.slot, list(v.index ORDER BY t.pos) AS l FROM tok t JOIN vocab v USING (term) JOIN p ON p.user_id = t.user_id AND p.turn = t.turn
      WHERE p.slot < 4 GROUP BY ALL),
    grid AS (SELECT DISTINCT user_id, s AS slot FROM p, (SELECT unnest(range(0, 4)) AS s)),
    full_ids AS (SELECT g.user_id, g.slot, coalesce(l, []) AS l FROM grid g LEFT JOIN ids i ON i.user_id = g.user_id AND i.slot = g.slot)
    SELECT user_id, CAST(slot AS INT) AS slot, array_to_string(list_concat(list_resize([]::INT[], greatest(12 - len(l), 0), 0), l[greatest(len(l) - 11, 1):]), ',') AS ids FROM full_ids""",
)
def u04(spark, sf):
    talks = _talks(spark, sf)
    vocab = histories.vocabulary(talks, "text")
    chosen = histories.select_posts(talks, "user_id", "turn", 4, "first")
    out = histories.sequences(chosen, "user_id", "slot", "text", vocab, 12, 4)
    return out.select("user_id", F.col("slot").cast("int").alias("slot"), F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids"))


@query(
    "s15_histories",
    "SELECT conv_id AS user_id, CASE WHEN conv_id % 3 = 0 THEN 0 ELSE 1 END AS y, count(*) AS n_posts, CAST(sum(length(text)) AS BIGINT) AS n_chars FROM conversations WHERE conv_id % 3 < 2 GROUP BY 1, 2",
)
def s15(spark, sf):
    label = F.when(F.col("conv_id") % 3 == 0, "control").when(F.col("conv_id") % 3 == 1, "depression")
    post = F.struct(F.col("turn").cast("string").alias("dt"), F.col("text").alias("post"))
    turns = table(spark, sf, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(post)).alias("posts"))
    raw = turns.select(F.col("conv_id").alias("user_id"), label.alias("label"), "posts")
    flat = store.flatten_histories(raw)
    return flat.groupBy("user_id", "y").agg(F.count("*").alias("n_posts"), F.sum(F.length("text")).alias("n_chars"))

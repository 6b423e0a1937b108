"""Evaluation operators on a reproducible score with many ties."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import metrics, models
from .base import SEED, SQL_SCORED, r6, scored, table

QUERIES, ORACLE = {}, {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


def _rounded(df, columns):
    return df.withColumns({c: r6(F.col(c)) for c in columns})


def sql_div(a: str, b: str) -> str:
    return f"coalesce(({a})::DOUBLE / nullif(({b})::DOUBLE, 0), 0)"


def sql_rates(tp="tp", fp="fp", fn="fn", tn="tn") -> str:
    """Threshold metrics from cell columns, rounded."""
    p, r = sql_div(tp, f"{tp} + {fp}"), sql_div(tp, f"{tp} + {fn}")
    root = f"sqrt({tp}::DOUBLE + {fp}) * sqrt({tp}::DOUBLE + {fn}) * sqrt({tn}::DOUBLE + {fp}) * sqrt({tn}::DOUBLE + {fn})"
    return f"""round({sql_div(f'{tp} + {tn}', f'{tp} + {fp} + {fn} + {tn}')}, 6) AS accuracy,
      round({sql_div(f'2 * {tp}', f'2 * {tp} + {fp} + {fn}')}, 6) AS f1,
      round({sql_div(f'5 * {tp}', f'5 * {tp} + 4 * {fn} + {fp}')}, 6) AS f2,
      round({p}, 6) AS precision, round({r}, 6) AS recall, round({sql_div(tn, f'{tn} + {fp}')}, 6) AS specificity,
      round({sql_div(f'{tp}::DOUBLE * {tn} - {fp}::DOUBLE * {fn}', root)}, 6) AS mcc"""


SQL_CELLS = """count(*) FILTER (y = 1 AND pred = 1) AS tp, count(*) FILTER (y = 0 AND pred = 1) AS fp,
    count(*) FILTER (y = 1 AND pred = 0) AS fn, count(*) FILTER (y = 0 AND pred = 0) AS tn"""


def sql_cum(source: str, by: str = "1", weight: str = "1") -> str:
    """CTE body: counts at or above every distinct score, per group g."""
    return f"""SELECT g, score, pos, neg, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp,
      sum(pos) OVER (PARTITION BY g) AS n_pos, sum(neg) OVER (PARTITION BY g) AS n_neg FROM (
        SELECT {by} AS g, score, sum(CASE WHEN y = 1 THEN {weight} ELSE 0 END) AS pos, sum(CASE WHEN y = 1 THEN 0 ELSE {weight} END) AS neg
        FROM {source} GROUP BY 1, 2)
      WINDOW w AS (PARTITION BY g ORDER BY score DESC ROWS UNBOUNDED PRECEDING)"""


SQL_AREAS = """SELECT g, sum(neg * (tp - pos + pos / 2.0e0)) / nullif(max(n_pos)::DOUBLE * max(n_neg), 0) AS roc_auc,
    CASE WHEN max(n_pos) > 0 THEN sum(pos * (tp / (tp + fp)::DOUBLE + CASE WHEN tp + fp > pos + neg
      THEN (tp - pos) / (tp - pos + fp - neg)::DOUBLE ELSE 1 END) / 2) / max(n_pos) ELSE 0.5 END AS pr_auc FROM cum GROUP BY g"""


@query("v01_confusion", f"SELECT y, pred, count(*) AS n FROM ({SQL_SCORED}) GROUP BY ALL")
def v01(spark, sf):
    return metrics.confusion(scored(spark, sf), "y", "pred")


@query("v02_threshold_metrics", f"SELECT {sql_rates()} FROM (SELECT {SQL_CELLS} FROM ({SQL_SCORED}))")
def v02(spark, sf):
    out = metrics.threshold_metrics(scored(spark, sf), "y", "pred")
    return _rounded(out, out.columns)


@query(
    "v03_v05_all_metrics",
    f"""WITH s AS ({SQL_SCORED}), cum AS ({sql_cum('s')}), areas AS ({SQL_AREAS})
    SELECT {sql_rates()}, round(roc_auc, 6) AS roc_auc, round(pr_auc, 6) AS pr_auc, round(brier, 6) AS brier
    FROM (SELECT {SQL_CELLS}, avg((score - y) ** 2) AS brier FROM s), areas""",
)
def v03(spark, sf):
    out = metrics.binary_metrics(scored(spark, sf), "y", "pred", "score")
    return _rounded(out, out.columns)


@query(
    "v04_pr_points",
    f"""WITH s AS ({SQL_SCORED}), cum AS ({sql_cum('s')})
    SELECT score, round(tp / (tp + fp)::DOUBLE, 6) AS precision, round(tp / n_pos::DOUBLE, 6) AS recall FROM cum""",
)
def v04(spark, sf):
    return _rounded(metrics.pr_points(scored(spark, sf), "y", "score"), ["precision", "recall"])


_SQL_BEST = """SELECT g, score, CASE WHEN p + r = 0 THEN 0 ELSE 5 * (p * r) / (4 * p + r + 1e-12) END AS f FROM (
    SELECT g, score, tp / (tp + fp)::DOUBLE AS p, CASE WHEN n_pos > 0 THEN tp / n_pos::DOUBLE ELSE 1 END AS r FROM cum)"""


@query(
    "v06_best_threshold",
    f"""WITH s AS ({SQL_SCORED}), cum AS ({sql_cum('s')}), f AS ({_SQL_BEST})
    SELECT score AS threshold, round(f, 6) AS fbeta FROM f ORDER BY f DESC, score LIMIT 1""",
)
def v06(spark, sf):
    return _rounded(metrics.best_threshold(scored(spark, sf), "y", "score"), ["fbeta"])


_SQL_CUTOFFS = """SELECT g, CASE WHEN lo >= hi THEN 0.35 ELSE lo END AS low, CASE WHEN lo >= hi THEN 0.70 ELSE hi END AS high FROM (
    SELECT g, greatest(least(coalesce(max(CASE WHEN below > 0 AND (n_neg - fp)::DOUBLE / nullif(below, 0) >= 0.90e0 THEN score END), 0.35e0), 0.55e0), 0.15e0) AS lo,
    greatest(least(coalesce(min(CASE WHEN tp / (tp + fp)::DOUBLE >= 0.80e0 THEN score END), 0.70e0), 0.90e0), 0.55e0) AS hi
    FROM (SELECT *, n_pos + n_neg - tp - fp AS below FROM cum) GROUP BY g)"""


@query(
    "v07_risk_cutoffs",
    f"WITH s AS ({SQL_SCORED}), cum AS ({sql_cum('s', 'source_id')}) SELECT g AS source_id, low::DOUBLE AS low, high::DOUBLE AS high FROM ({_SQL_CUTOFFS})",
)
def v07(spark, sf):
    return metrics.risk_cutoffs(scored(spark, sf), "y", "score", ["source_id"])


_BOUNDS = metrics._poisson_bounds()
_SQL_DRAW = " + ".join(f"(d >= {b})::INT" for b in _BOUNDS)


@query(
    "v08_bootstrap",
    f"""WITH s AS ({SQL_SCORED}), x AS (SELECT s.*, b, md5(concat('{SEED}:', b, ':', doc_id)) AS h FROM s, (SELECT unnest(range(0, 100)) AS b)),
    y4 AS (SELECT y, pred, score, b * 4 + i AS g, CAST('0x' || substr(h, CAST(8 * i + 1 AS BIGINT), 8) AS BIGINT) AS d FROM x, (SELECT unnest(range(0, 4)) AS i)),
    w AS (SELECT g, y, pred, score, {_SQL_DRAW} AS w FROM y4),
    c AS (SELECT g, sum(w) FILTER (y = 1 AND pred = 1) AS tp0, sum(w) FILTER (y = 0 AND pred = 1) AS fp0, sum(w) FILTER (y = 1 AND pred = 0) AS fn0,
      sum(w) FILTER (y = 0 AND pred = 0) AS tn0, sum(w * (score - y) ** 2) / sum(w) AS brier FROM w GROUP BY g),
    d AS (SELECT g, coalesce(tp0, 0) AS tp, coalesce(fp0, 0) AS fp, coalesce(fn0, 0) AS fn, coalesce(tn0, 0) AS tn, brier FROM c),
    cum AS ({sql_cum('(SELECT * FROM w WHERE w > 0)', 'g', 'w')}), areas AS ({SQL_AREAS}),
    m AS (SELECT d.g, {sql_rates().replace('round(', '(').replace(', 6)', ')')}, roc_auc, pr_auc, brier FROM d JOIN areas a ON a.g = d.g WHERE tp + fn > 0 AND fp + tn > 0),
    l AS (UNPIVOT m ON accuracy, f1, f2, precision, recall, specificity, mcc, roc_auc, pr_auc, brier INTO NAME metric VALUE value)
    SELECT metric, round(quantile_cont(value, 0.025), 6) AS lower, round(quantile_cont(value, 0.975), 6) AS upper, count(*) AS n_replicates FROM l GROUP BY 1""",
)
def v08(spark, sf):
    out = metrics.bootstrap(scored(spark, sf), "doc_id", "y", "pred", "score", n=400, seed=SEED)
    return _rounded(out, ["lower", "upper"])


@query(
    "v09_metrics_by_source",
    f"""WITH s AS ({SQL_SCORED}), cum AS ({sql_cum('s', 'source_id')}), areas AS ({SQL_AREAS})
    SELECT source_id, {sql_rates()}, round(roc_auc, 6) AS roc_auc, round(pr_auc, 6) AS pr_auc, round(brier, 6) AS brier
    FROM (SELECT source_id, {SQL_CELLS}, avg((score - y) ** 2) AS brier FROM s GROUP BY 1) c JOIN areas a ON a.g = c.source_id""",
)
def v09(spark, sf):
    out = metrics.binary_metrics(scored(spark, sf), "y", "pred", "score", ["source_id"])
    return _rounded(out, metrics.METRICS)


@query(
    "v10_report",
    f"""WITH s AS ({SQL_SCORED}), k AS (SELECT DISTINCT y AS c FROM s UNION SELECT DISTINCT pred FROM s),
    t AS (SELECT c, (SELECT count(*) FROM s WHERE y = c AND pred = c) AS hit, (SELECT count(*) FROM s WHERE pred = c) AS gu, (SELECT count(*) FROM s WHERE y = c) AS su FROM k),
    r AS (SELECT CAST(c AS VARCHAR) AS class, {sql_div('hit', 'gu')} AS p, {sql_div('hit', 'su')} AS r, {sql_div('2 * hit', 'gu + su')} AS f, su, hit FROM t)
    SELECT class, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1, su AS support FROM r
    UNION ALL SELECT 'accuracy', round(sum(hit) / sum(su)::DOUBLE, 6), round(sum(hit) / sum(su)::DOUBLE, 6), round(sum(hit) / sum(su)::DOUBLE, 6), CAST(sum(su) AS BIGINT) FROM r
    UNION ALL SELECT 'macro avg', round(avg(p), 6), round(avg(r), 6), round(avg(f), 6), CAST(sum(su) AS BIGINT) FROM r
    UNION ALL SELECT 'weighted avg', round(sum(p * su) / sum(su), 6), round(sum(r * su) / sum(su), 6), round(sum(f * su) / sum(su), 6), CAST(sum(su) AS BIGINT) FROM r""",
)
def v10(spark, sf):
    return _rounded(metrics.report(scored(spark, sf), "y", "pred"), ["precision", "recall", "f1"])


@query(
    "v11_reliability",
    f"""WITH s AS ({SQL_SCORED}), n AS (SELECT least(10, greatest(3, count(*) // 80)) AS k FROM s),
    b AS (SELECT CAST(len(list_filter(range(1, k), lambda j: j * (1.0e0 / k) < score)) AS INT) AS bin, score, y FROM s, n)
    SELECT bin, round(avg(score), 6) AS mean_score, round(avg(y), 6) AS share_positive, count(*) AS n FROM b GROUP BY 1""",
)
def v11(spark, sf):
    return _rounded(metrics.reliability(scored(spark, sf), "y", "score"), ["mean_score", "share_positive"])


@query(
    "v12_roc_points",
    f"""WITH s AS ({SQL_SCORED}), cum AS ({sql_cum('s')})
    SELECT score, round(fp / n_neg::DOUBLE, 6) AS fpr, round(tp / n_pos::DOUBLE, 6) AS tpr FROM cum""",
)
def v12(spark, sf):
    return _rounded(metrics.roc_points(scored(spark, sf), "y", "score"), ["fpr", "tpr"])


@query(
    "v13_error_cases",
    f"""SELECT doc_id, y, score, pred AS prediction, CASE WHEN pred = 1 THEN 'false_positive' ELSE 'false_negative' END AS error_type,
      round(abs(score - 0.5), 6) AS distance_from_threshold FROM ({SQL_SCORED}) WHERE y <> pred ORDER BY abs(score - 0.5) DESC, doc_id LIMIT 100""",
)
def v13(spark, sf):
    out = metrics.error_cases(scored(spark, sf).select("doc_id", "y", "score"), "y", "score", 0.5, "doc_id")
    return _rounded(out, ["distance_from_threshold"])


_SQL_RIVALS = f"""WITH s AS ({SQL_SCORED}), r AS (SELECT *, CASE WHEN doc_id % 4 > 0 THEN pred ELSE 1 - pred END AS pred_b FROM s),
    a AS (SELECT source_id, {SQL_CELLS} FROM s GROUP BY 1), b AS (SELECT source_id, {SQL_CELLS.replace('pred', 'pred_b')} FROM r GROUP BY 1),
    f AS (SELECT a.source_id, {sql_div('5 * a.tp', '5 * a.tp + 4 * a.fn + a.fp')} AS plain, {sql_div('5 * b.tp', '5 * b.tp + 4 * b.fn + b.fp')} AS noisy FROM a JOIN b ON a.source_id = b.source_id)"""


def _rivals(spark, sf):
    """F2 of two predictions per source: the score's own and one with every fourth row flipped."""
    frame = scored(spark, sf)
    noisy = frame.withColumn("pred_b", F.when(F.col("doc_id") % 4 > 0, F.col("pred")).otherwise(1 - F.col("pred")))
    a = metrics.threshold_metrics(frame, "y", "pred", ["source_id"]).select("source_id", F.col("f2").alias("plain"))
    b = metrics.threshold_metrics(noisy, "y", "pred_b", ["source_id"]).select("source_id", F.col("f2").alias("noisy"))
    return a.join(b, "source_id")


@query(
    "v18_winner",
    f"""{_SQL_RIVALS} SELECT source_id, round(plain, 6) AS plain, round(noisy, 6) AS noisy,
      CASE WHEN noisy - plain > 0.005 THEN 'noisy' WHEN plain - noisy > 0.005 THEN 'plain' ELSE 'tie' END AS winner FROM f""",
)
def v18(spark, sf):
    return _rounded(metrics.winner(_rivals(spark, sf), "plain", "noisy"), ["plain", "noisy"])


@query(
    "v18_leaderboard",
    f"{_SQL_RIVALS} SELECT source_id, round(plain, 6) AS plain, CAST(rank() OVER (ORDER BY round(plain, 9) DESC) AS INT) AS place FROM f",
)
def v18_board(spark, sf):
    table_ = _rivals(spark, sf).select("source_id", F.round("plain", 9).alias("plain"))
    return _rounded(metrics.leaderboard(table_, "plain"), ["plain"])


@query(
    "v19_user_prf",
    f"""WITH u AS (SELECT conv_id, max((turn % 5 = 3)::INT) AS y, max((length(text) > 900)::INT) AS pred FROM conversations GROUP BY 1),
    c AS (SELECT {SQL_CELLS} FROM u)
    SELECT round({sql_div('tp', 'tp + fp')}, 6) AS precision, round({sql_div('tp', 'tp + fn')}, 6) AS recall, round({sql_div('2 * tp', '2 * tp + fp + fn')}, 6) AS f1 FROM c""",
)
def v19(spark, sf):
    talks = table(spark, sf, "conversations").select(
        "conv_id", (F.col("turn") % 5 == 3).cast("int").alias("y"), (F.length("text") > 900).cast("int").alias("pred")
    )
    out = metrics.user_prf(talks, "conv_id", "y", "pred")
    return _rounded(out, out.columns)


@query(
    "m07_apply_platt",
    f"SELECT doc_id, round(greatest(least(1 / (1 + exp(-(6.5e0 * score - 2.25e0))), 1 - 1e-6), 1e-6), 6) AS calibrated FROM ({SQL_SCORED})",
)
def m07(spark, sf):
    return scored(spark, sf).select("doc_id", r6(models.apply_platt(F.col("score"), 6.5, -2.25)).alias("calibrated"))


@query(
    "m09_select_model",
    f"""WITH s AS ({SQL_SCORED}), r AS (SELECT *, CASE WHEN doc_id % 4 > 0 THEN pred ELSE 1 - pred END AS pred_b, 1 AS pred_c FROM s),
    long AS (SELECT 'plain' AS model, 0 AS rank, source_id, y, pred AS p FROM r UNION ALL SELECT 'noisy', 1, source_id, y, pred_b FROM r UNION ALL SELECT 'always', 2, source_id, y, pred_c FROM r),
    f AS (SELECT model, rank, source_id = 'src0' AS oov, {SQL_CELLS.replace('pred', 'p')} FROM long GROUP BY ALL),
    g AS (SELECT model, rank, oov, {sql_div('5 * tp', '5 * tp + 4 * fn + fp')} AS f2 FROM f),
    j AS (SELECT a.model, a.rank, a.f2 AS val_f2, b.f2 AS oov_f2 FROM g a LEFT JOIN g b ON a.model = b.model AND b.oov AND b.model <> 'always' WHERE NOT a.oov),
    k AS (SELECT *, CASE WHEN oov_f2 IS NOT NULL THEN 0.7e0 * val_f2 + 0.3e0 * oov_f2 END AS score FROM j)
    SELECT model, round(val_f2, 6) AS f2, round(oov_f2, 6) AS oov_f2, round(score, 6) AS selection_score, oov_f2 IS NOT NULL AS eligible,
      coalesce(model = (SELECT model FROM k WHERE score IS NOT NULL ORDER BY score DESC, rank LIMIT 1), false) AS selected FROM k""",
)
def m09(spark, sf):
    frame = scored(spark, sf)
    flipped = F.when(F.col("doc_id") % 4 > 0, F.col("pred")).otherwise(1 - F.col("pred"))
    rivals = F.array(
        F.struct(F.lit("plain").alias("model"), F.lit(0).alias("rank"), F.col("pred").alias("p")),
        F.struct(F.lit("noisy").alias("model"), F.lit(1).alias("rank"), flipped.alias("p")),
        F.struct(F.lit("always").alias("model"), F.lit(2).alias("rank"), F.lit(1).alias("p")),
    )
    long = frame.select("source_id", "y", F.inline(rivals))
    val = metrics.threshold_metrics(long.filter("source_id <> 'src0'"), "y", "p", ["model", "rank"])
    oov = metrics.threshold_metrics(long.filter("source_id = 'src0' AND model <> 'always'"), "y", "p", ["model"])
    out = models.select_model(val.select("model", "rank", "f2"), oov.select("model", F.col("f2").alias("oov_f2")))
    return _rounded(out, ["f2", "oov_f2", "selection_score"]).drop("rank")


@query(
    "m12_margin_to_score",
    f"""SELECT doc_id, round(1 / (1 + exp(-m)), 6) AS by_sigmoid,
      round((m - (SELECT min(10 * score - 5) FROM ({SQL_SCORED}))) / ((SELECT max(10 * score - 5) - min(10 * score - 5) FROM ({SQL_SCORED})) + 1e-9), 6) AS by_range
    FROM (SELECT doc_id, 10 * score - 5 AS m FROM ({SQL_SCORED}))""",
)
def m12(spark, sf):
    margins = scored(spark, sf).select("doc_id", (F.col("score") * 10 - 5).alias("m"))
    both = models.margin_to_score(models.margin_to_score(margins, "m", "sigmoid", "by_sigmoid"), "m", "minmax", "by_range")
    return _rounded(both, ["by_sigmoid", "by_range"]).drop("m")


_LANGS = ("de", "en", "es", "fr")
_SQL_CLASSED = f"""SELECT lang, CASE WHEN doc_id % 3 = 0 THEN list_value{_LANGS}[1 + (doc_id * 31) % 4] ELSE lang END AS pred, doc_id FROM documents"""


def _classed(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang")
    other = F.get(F.array(*[F.lit(x) for x in _LANGS]), ((F.col("doc_id") * 31) % 4).cast("int"))
    return docs.withColumn("pred", F.when(F.col("doc_id") % 3 == 0, other).otherwise(F.col("lang")))


@query(
    "v10_multiclass_report",
    f"""WITH s AS ({_SQL_CLASSED}), k AS (SELECT DISTINCT lang AS c FROM s UNION SELECT DISTINCT pred FROM s),
    t AS (SELECT c, (SELECT count(*) FROM s WHERE lang = c AND pred = c) AS hit, (SELECT count(*) FROM s WHERE pred = c) AS gu, (SELECT count(*) FROM s WHERE lang = c) AS su FROM k),
    r AS (SELECT c, {sql_div('hit', 'gu')} AS p, {sql_div('hit', 'su')} AS r, {sql_div('2 * hit', 'gu + su')} AS f, su, hit, gu FROM t),
    m AS (SELECT sum(hit)::DOUBLE / sum(gu) AS p, sum(hit)::DOUBLE / sum(su) AS r, CAST(sum(su) AS BIGINT) AS su FROM r)
    SELECT c AS class, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1, su AS support FROM r
    UNION ALL SELECT 'macro avg', round(avg(p), 6), round(avg(r), 6), round(avg(f), 6), CAST(sum(su) AS BIGINT) FROM r
    UNION ALL SELECT 'weighted avg', round(sum(p * su) / sum(su), 6), round(sum(r * su) / sum(su), 6), round(sum(f * su) / sum(su), 6), CAST(sum(su) AS BIGINT) FROM r
    UNION ALL SELECT 'micro avg', round(p, 6), round(r, 6), round(2 * p * r / (p + r), 6), su FROM m""",
)
def v10_multiclass(spark, sf):
    return _rounded(metrics.multiclass_report(_classed(spark, sf), "lang", "pred"), ["precision", "recall", "f1"])


_SQL_ONE_REST = f"""SELECT c AS g, (lang = c)::INT AS y, (((doc_id * (11 + i * 7)) % 97) + CASE WHEN lang = c THEN 25 ELSE 0 END) / 122.0e0 AS score
    FROM documents, (SELECT unnest(list_value{_LANGS}) AS c, unnest(range(0, 4)) AS i)"""


def _class_scores(spark, sf):
    score = lambda i, c: ((F.col("doc_id") * (11 + i * 7)) % 97 + F.when(F.col("lang") == c, 25).otherwise(0)) / 122.0
    entries = [x for i, c in enumerate(_LANGS) for x in (F.lit(c), score(i, c))]
    return table(spark, sf, "documents").select("lang", F.create_map(*entries).alias("scores"))


@query(
    "v12_class_areas",
    f"WITH s AS ({_SQL_ONE_REST}), cum AS ({sql_cum('s', 'g')}), a AS ({SQL_AREAS}) SELECT g AS class, round(roc_auc, 6) AS roc_auc, round(pr_auc, 6) AS pr_auc FROM a",
)
def v12_areas(spark, sf):
    return _rounded(metrics.class_areas(_class_scores(spark, sf), "lang", "scores"), ["roc_auc", "pr_auc"])


@query(
    "v12_class_roc_points",
    f"""WITH s AS ({_SQL_ONE_REST}), cum AS ({sql_cum('s', 'g')})
    SELECT g AS class, round(score, 9) AS score, round(fp / nullif(n_neg, 0)::DOUBLE, 6) AS fpr, round(tp / nullif(n_pos, 0)::DOUBLE, 6) AS tpr FROM cum""",
)
def v12_points(spark, sf):
    out = _rounded(metrics.class_roc_points(_class_scores(spark, sf), "lang", "scores"), ["fpr", "tpr"])
    return out.withColumn("score", F.round("score", 9))

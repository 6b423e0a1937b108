"""Features, lexicon evidence and the rule layer, on fixture words."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import settings
from ..functions import cues
from ..operators import features, lexicon, risk, sentiment
from ..session import local_rows
from .base import SQL_CLEAN_POSTS, clean_posts, labelled, r6, sql_tokens, sql_values, table, words_table

QUERIES, ORACLE = {}, {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


# Fixture words from the driver's invented prose, standing in for the real lexicons.
VALENCE = [("the", 1.5), ("of", -2.1), ("le", 0.8), ("und", -0.6), ("er", 2.4), ("de", -1.1), ("no", -1.2), ("in", 0.3)]
UP, DOWN, NEGATIONS = ["and", "la"], ["to", "des"], ["is", "die", "les"]
TERMS = ["the", "of the", "und die", "les", "zu"]
POSITIVE = ["the of", "and the", "de la", "tion"]
NEGATIVE = ["the by", "to the", "der die"]
NAMES = ["that", "les", "und", "of", "la", "on"]
_A = f"({SQL_CLEAN_POSTS})"


def lexicons(spark) -> risk.Lexicons:
    return risk.Lexicons(
        local_rows(spark, VALENCE, "word string, valence double"),
        words_table(spark, TERMS), words_table(spark, POSITIVE), words_table(spark, NEGATIVE), words_table(spark, NAMES),
    )


def _in(words: list[str]) -> str:
    return "(" + ", ".join(f"'{w}'" for w in words) + ")"


@query(
    "f01_text_stats",
    f"""SELECT doc_id, length(clean)::DOUBLE AS char_len, len(w)::DOUBLE AS word_count,
      CASE WHEN len(w) = 0 THEN 0 ELSE round(length(replace(clean, ' ', '')) / len(w)::DOUBLE, 6) END AS avg_word_len
    FROM (SELECT *, {sql_tokens('clean')} AS w FROM {_A})""",
)
def f01(spark, sf):
    out = features.text_stats(clean_posts(spark, sf), "clean")
    return out.select("doc_id", "char_len", "word_count", r6(F.col("avg_word_len")).alias("avg_word_len"))


def sql_sentiment(source: str) -> str:
    """CTEs ending in sent(doc_id, sentiment) for texts with hits."""
    known = "(SELECT word FROM val)"

    def step(d: int) -> str:
        w, amount = f"p{d}", round(sentiment.BOOST * sentiment.DISTANCE_DAMPING[d - 1], 12)
        flip = {
            1: f"CASE WHEN p1 IN {_in(NEGATIONS)} THEN -0.74e0 ELSE 1 END",
            2: f"""CASE WHEN p2 = 'never' AND p1 IN ('so', 'this') THEN 1.25e0 WHEN p2 = 'without' AND p1 = 'doubt' THEN 1
              WHEN p2 IN {_in(NEGATIONS)} THEN -0.74e0 ELSE 1 END""",
            3: f"""CASE WHEN (p3 = 'never' AND p2 IN ('so', 'this')) OR p1 IN ('so', 'this') THEN 1.25e0
              WHEN p3 = 'without' AND (p2 = 'doubt' OR p1 = 'doubt') THEN 1 WHEN p3 IN {_in(NEGATIONS)} THEN -0.74e0 ELSE 1 END""",
        }[d]
        boost = f"CASE WHEN {w} IN {_in(UP)} THEN {amount}e0 WHEN {w} IN {_in(DOWN)} THEN -{amount}e0 ELSE 0 END"
        return f"""CASE WHEN pos > {d} AND {w} NOT IN {known} THEN (v{d - 1} + CASE WHEN v{d - 1} < 0 THEN -({boost}) ELSE {boost} END) * ({flip})
          ELSE v{d - 1} END AS v{d}"""

    return f"""val AS (SELECT * FROM {sql_values(VALENCE, 'word, valence')}),
    tok AS (SELECT doc_id, unnest(w) AS t, generate_subscripts(w, 1) AS pos FROM (SELECT doc_id, {sql_tokens('clean')} AS w FROM {source})),
    ctx AS (SELECT doc_id, t, pos, coalesce(lag(t, 1) OVER o, '') AS p1, coalesce(lag(t, 2) OVER o, '') AS p2, coalesce(lag(t, 3) OVER o, '') AS p3,
      coalesce(lead(t) OVER o, '') AS nx, min(CASE WHEN t = 'but' THEN pos END) OVER (PARTITION BY doc_id) AS but_at FROM tok WINDOW o AS (PARTITION BY doc_id ORDER BY pos)),
    hit AS (SELECT c.*, v.valence::DOUBLE AS v FROM ctx c JOIN val v ON v.word = c.t WHERE t NOT IN {_in(UP + DOWN)} AND NOT (t = 'kind' AND nx = 'of')),
    s0 AS (SELECT *, CASE WHEN p1 = 'no' OR p2 = 'no' OR (p3 = 'no' AND p1 IN ('or', 'nor')) THEN v * -0.74e0
      WHEN t = 'no' AND nx IN {known} THEN 0 ELSE v END AS v0 FROM hit),
    s1 AS (SELECT *, {step(1)} FROM s0), s2 AS (SELECT *, {step(2)} FROM s1), s3 AS (SELECT *, {step(3)} FROM s2),
    fin AS (SELECT doc_id, v3 * CASE WHEN p1 = 'least' AND p1 NOT IN {known} AND (pos = 2 OR p2 NOT IN ('at', 'very')) THEN -0.74e0 ELSE 1 END
      * CASE WHEN but_at IS NULL OR pos = but_at THEN 1 WHEN pos < but_at THEN 0.5 ELSE 1.5 END AS x FROM s3),
    sent AS (SELECT doc_id, round(greatest(least(sum(x) / sqrt(sum(x) * sum(x) + 15), 1), -1), 4) AS sentiment FROM fin GROUP BY 1)"""


@query(
    "f02_sentiment",
    f"WITH {sql_sentiment(_A)} SELECT d.doc_id, coalesce(sentiment, 0) AS sentiment FROM documents d LEFT JOIN sent s ON s.doc_id = d.doc_id",
)
def f02(spark, sf):
    valence = local_rows(spark, VALENCE, "word string, valence double")
    out = sentiment.compound(clean_posts(spark, sf), "clean", valence, up=UP, down=DOWN, negations=NEGATIONS)
    return out.select("doc_id", "sentiment")


def _sql_count(words: list[str], pad: bool) -> str:
    text, left, right = ("(' ' || clean || ' ')", " ", " ") if pad else ("clean", "", "")
    return " + ".join(f"contains({text}, '{left}{w}{right}')::INT" for w in words)


@query("f03_term_hits", f"SELECT doc_id, ({_sql_count(TERMS, True)})::DOUBLE AS term_hits FROM {_A}")
def f03(spark, sf):
    return lexicon.term_hits(clean_posts(spark, sf), "clean", words_table(spark, TERMS)).select("doc_id", "term_hits")


_VALUES = [("_ref", 0, "the"), ("_ref", 1, "of that"), ("_ref", 2, "and"), ("_doctor", 0, "erst"), ("_doctor", 1, "ouen")]


@query(
    "f04_expand_patterns",
    """WITH b AS (SELECT item_id, list_slice(string_split(trim(regexp_replace(lower(text), '[^a-z]+', ' ', 'g')), ' '), 1, 2) AS w FROM benchmark),
    l AS (SELECT '  ' || CASE item_id % 3 WHEN 0 THEN w[1] || ' _ref ' || w[2] WHEN 1 THEN w[1] || ' _doctor  _ref' ELSE w[1] || ' ' || w[2] END AS line FROM b),
    r AS (SELECT * FROM """
    + sql_values([(v,) for p, _, v in _VALUES if p == "_ref"], "r")
    + "), d AS (SELECT * FROM "
    + sql_values([(v,) for p, _, v in _VALUES if p == "_doctor"], "d")
    + """)
    SELECT DISTINCT trim(regexp_replace(p, '\\s+', ' ', 'g')) AS phrase FROM (
      SELECT replace(replace(line, '_doctor', d), '_ref', r) AS p FROM l, r, d WHERE contains(line, '_ref') AND contains(line, '_doctor')
      UNION ALL SELECT replace(line, '_ref', r) FROM l, r WHERE contains(line, '_ref') AND NOT contains(line, '_doctor')
      UNION ALL SELECT line FROM l WHERE NOT contains(line, '_ref') AND NOT contains(line, '_doctor'))""",
)
def f04(spark, sf):
    clean = F.trim(F.regexp_replace(F.lower("text"), "[^a-z]+", " "))
    words = table(spark, sf, "benchmark").select("item_id", F.split(clean, " ").alias("w"))
    one, two = F.get("w", F.lit(0)), F.get("w", F.lit(1))
    line = (
        F.when(F.col("item_id") % 3 == 0, F.concat(one, F.lit(" _ref "), two))
        .when(F.col("item_id") % 3 == 1, F.concat(one, F.lit(" _doctor  _ref")))
        .otherwise(F.concat(one, F.lit(" "), two))
    )
    patterns = words.select(F.concat(F.lit("  "), line).alias("line"))
    return lexicon.expand(patterns, local_rows(spark, _VALUES, "placeholder string, position int, value string"))


@query(
    "f05_phrase_hits",
    f"SELECT doc_id, ({_sql_count(POSITIVE, False)})::DOUBLE AS positive_hits, ({_sql_count(NEGATIVE, False)})::DOUBLE AS negative_hits FROM {_A}",
)
def f05(spark, sf):
    out = lexicon.phrase_hits(clean_posts(spark, sf), "clean", words_table(spark, POSITIVE), "positive_hits")
    out = lexicon.phrase_hits(out, "clean", words_table(spark, NEGATIVE), "negative_hits")
    return out.select("doc_id", "positive_hits", "negative_hits")


@query(
    "f05_phrase_hits_from_table",
    f"""WITH p AS (SELECT DISTINCT array_to_string(list_slice(string_split(trim(regexp_replace(lower(text), '[^a-z]+', ' ', 'g')), ' '), 1, 2), ' ') AS phrase FROM benchmark)
    SELECT a.doc_id, count(p.phrase)::DOUBLE AS hits FROM {_A} a LEFT JOIN p ON length(p.phrase) > 0 AND contains(a.clean, p.phrase) GROUP BY 1""",
)
def f05_table(spark, sf):
    clean = F.split(F.trim(F.regexp_replace(F.lower("text"), "[^a-z]+", " ")), " ")
    phrases = table(spark, sf, "benchmark").select(F.array_join(F.slice(clean, 1, 2), " ").alias("phrase"))
    out = lexicon.phrase_hits(clean_posts(spark, sf), "clean", phrases, "hits")
    return out.select("doc_id", "hits")


def _sql_mentions() -> tuple[str, str]:
    long, short = [n for n in NAMES if len(n) > 3], [n for n in NAMES if len(n) <= 3]
    r_long = [f"(contains(' ' || clean || ' ', ' r {n} ') AND NOT contains(' ' || clean || ' ', ' {n} '))::INT" for n in long]
    r_short = [f"contains(' ' || clean || ' ', ' r {n} ')::INT" for n in short]
    return _sql_count(long, True), " + ".join(r_long + r_short)


# The prose has no "r"; a fixed word of it plays that part here.
_AS_R = "(SELECT doc_id, regexp_replace(clean, '\\bund\\b', 'r', 'g') AS clean FROM " + _A + ")"


def _with_r(spark, sf):
    return clean_posts(spark, sf).withColumn("clean", F.regexp_replace("clean", r"\bund\b", "r"))


@query(
    "f06_mention_hits",
    f"SELECT doc_id, ({_sql_mentions()[0]})::DOUBLE AS mention_word_hits, ({_sql_mentions()[1]})::DOUBLE AS mention_r_hits FROM {_AS_R}",
)
def f06(spark, sf):
    out = lexicon.mention_hits(_with_r(spark, sf), "clean", words_table(spark, NAMES))
    return out.select("doc_id", "mention_word_hits", "mention_r_hits")


def _sql_list(words: list[str], pad: bool, limit: int = 8) -> str:
    text, left, right = ("(' ' || clean || ' ')", " ", " ") if pad else ("clean", "", "")
    items = ", ".join(f"CASE WHEN contains({text}, '{left}{w}{right}') THEN '{w}' END" for w in sorted(words))
    return f"array_to_string(list_slice(list_filter([{items}], lambda x: x IS NOT NULL), 1, {limit}), '|')"


def _sql_mention_list(limit: int = 8) -> str:
    items = []
    for n in sorted(NAMES, key=lambda n: (-len(n), n)):
        if len(n) > 3:
            items.append(f"CASE WHEN contains(' ' || clean || ' ', ' {n} ') THEN '{n}' END")
        else:
            items.append(f"CASE WHEN contains(' ' || clean || ' ', ' r {n} ') THEN 'r/{n}' END")
    return f"array_to_string(list_slice(list_filter([{', '.join(items)}], lambda x: x IS NOT NULL), 1, {limit}), '|')"


@query(
    "f07_evidence",
    f"""SELECT doc_id, {_sql_list(TERMS, True)} AS terms, {_sql_list(POSITIVE, False)} AS positive,
      {_sql_list(NEGATIVE, False)} AS negative, {_sql_mention_list()} AS mentions FROM {_AS_R}""",
)
def f07(spark, sf):
    lex = lexicons(spark)
    out = lexicon.evidence(_with_r(spark, sf), "clean", lex.terms, lex.positive, lex.negative, lex.names)
    return out.select(
        "doc_id",
        *[F.array_join(f"{c}_list", "|").alias(n) for c, n in
          (("term", "terms"), ("positive", "positive"), ("negative", "negative"), ("mention", "mentions"))],
    )


_DEFAULT_SENTIMENT = {"UP": sentiment.BOOSTERS_UP, "DOWN": sentiment.BOOSTERS_DOWN, "NEGATIONS": sentiment.NEGATIONS}


def _sql_default_sentiment(source: str) -> str:
    """The sentiment CTEs with the published word lists instead of the fixture ones."""
    global UP, DOWN, NEGATIONS
    kept = UP, DOWN, NEGATIONS
    UP, DOWN, NEGATIONS = (list(_DEFAULT_SENTIMENT[k]) for k in ("UP", "DOWN", "NEGATIONS"))
    try:
        return sql_sentiment(source)
    finally:
        UP, DOWN, NEGATIONS = kept


_SQL_STATS = f"""SELECT a.doc_id, length(clean)::DOUBLE AS char_len, len({sql_tokens('clean')})::DOUBLE AS word_count,
    CASE WHEN clean = '' THEN 0 ELSE round(length(replace(clean, ' ', '')) / len({sql_tokens('clean')})::DOUBLE, 6) END AS avg_word_len,
    coalesce(sentiment, 0) AS sentiment, ({_sql_count(TERMS, True)})::DOUBLE AS term_hits, ({_sql_count(POSITIVE, False)})::DOUBLE AS positive_hits,
    ({_sql_count(NEGATIVE, False)})::DOUBLE AS negative_hits, ({_sql_mentions()[0]})::DOUBLE AS mention_word_hits, ({_sql_mentions()[1]})::DOUBLE AS mention_r_hits
    FROM {_A} a LEFT JOIN sent s ON s.doc_id = a.doc_id"""


@query("f08_stat_features", f"WITH {_sql_default_sentiment(_A)} {_SQL_STATS}")
def f08(spark, sf):
    lex = lexicons(spark)
    out = features.stat_features(
        clean_posts(spark, sf), "clean", lex.valence, lex.terms, lex.positive, lex.negative, lex.names
    )
    return out.select("doc_id", *features.STAT_COLUMNS).withColumn("avg_word_len", r6(F.col("avg_word_len")))


def sql_grams(min_df: int, max_df: float, cap: int, ngrams: int = 2) -> str:
    bigrams = "[w[i] || ' ' || w[i+1] for i in range(1, len(w))]"
    return f"""w AS (SELECT doc_id, list_filter(string_split(clean, ' '), lambda t: length(t) >= 2) AS w FROM {_A}),
    g AS (SELECT doc_id, unnest(list_concat(w, {bigrams})) AS term FROM w),
    c AS (SELECT doc_id, term, count(*) AS tf FROM g GROUP BY ALL),
    n AS (SELECT count(*) AS n FROM documents),
    s AS (SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS tf FROM c GROUP BY 1),
    top AS (SELECT term, df, tf FROM s, n WHERE df >= {min_df} AND df <= {max_df}e0 * n ORDER BY tf DESC, term LIMIT {cap}),
    vocab AS (SELECT term, CAST(row_number() OVER (ORDER BY term) - 1 AS INT) AS index, df, tf, ln((1e0 + n) / (1e0 + df)) + 1 AS idf FROM top, n)"""


@query(
    "f09_tfidf_vocabulary",
    f"WITH {sql_grams(3, 0.9, 6000)} SELECT term, index, df, tf, round(idf, 6) AS idf FROM vocab",
)
def f09_vocab(spark, sf):
    out = features.vocabulary(clean_posts(spark, sf), "clean")
    return out.withColumn("idf", r6(F.col("idf")))


@query(
    "f09_tfidf_weights",
    f"""WITH {sql_grams(3, 0.9, 6000)}, x AS (SELECT doc_id, index, c.term, (1 + ln(c.tf)) * idf AS v FROM c JOIN vocab v ON v.term = c.term),
    z AS (SELECT doc_id, sqrt(sum(v * v)) AS norm FROM x GROUP BY 1)
    SELECT x.doc_id, index, term, round(v / norm, 6) AS weight FROM x JOIN z ON z.doc_id = x.doc_id""",
)
def f09(spark, sf):
    frame = clean_posts(spark, sf)
    vocab = features.vocabulary(frame, "clean")
    return features.tfidf_weights(frame, "doc_id", "clean", vocab).withColumn("weight", r6(F.col("weight")))


@query(
    "f12_count_terms",
    f"WITH {sql_grams(1, 1.0, 10**9)} SELECT doc_id, index, c.term, c.tf FROM c JOIN vocab v ON v.term = c.term",
)
def f12(spark, sf):
    return features.count_terms(clean_posts(spark, sf), "doc_id", "clean").withColumn("tf", F.col("tf").cast("long"))


@query(
    "f13_vector_moments",
    """WITH l AS (SELECT unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) - 1 AS p FROM embeddings)
    SELECT CAST(p AS INT) AS position, round(avg(v), 6) AS mean, round(stddev_pop(v), 6) AS std FROM l GROUP BY 1""",
)
def f13(spark, sf):
    out = features.vector_moments(table(spark, sf, "embeddings"))
    return out.withColumns({"mean": r6(F.col("mean")), "std": r6(F.col("std"))})


@query(
    "f13_standardise",
    """WITH l AS (SELECT vec_id, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) - 1 AS p FROM embeddings),
    m AS (SELECT p, avg(v) AS mean, stddev_pop(v) AS std FROM l GROUP BY 1)
    SELECT vec_id, CAST(l.p AS INT) AS position, round((v - mean) / CASE WHEN std = 0 THEN 1 ELSE std END, 5) AS value FROM l JOIN m ON m.p = l.p""",
)
def f13_scaled(spark, sf):
    out = features.standardise(table(spark, sf, "embeddings"))
    return out.select("vec_id", F.posexplode("scaled").alias("position", "value")).withColumn("value", F.round("value", 5))


@query(
    "f14_top_words",
    f"SELECT word, count(*) AS n FROM (SELECT unnest({sql_tokens('clean')}) AS word FROM {_A}) GROUP BY 1 ORDER BY n DESC, word LIMIT 80",
)
def f14(spark, sf):
    words = clean_posts(spark, sf).select(F.filter(F.split("clean", " "), lambda t: t != "").alias("w"))
    return features.top_words(words, "w")


@query(
    "f14_top_words_by_class",
    f"""SELECT label, word, n, CAST(place AS INT) AS place FROM (SELECT label, word, count(*) AS n, row_number() OVER (PARTITION BY label ORDER BY count(*) DESC, word) AS place
      FROM (SELECT l.quality AS label, unnest({sql_tokens('clean')}) AS word FROM {_A} a JOIN labels l ON l.doc_id = a.doc_id) GROUP BY 1, 2) WHERE place <= 80""",
)
def f14_class(spark, sf):
    words = clean_posts(spark, sf).select("doc_id", F.filter(F.split("clean", " "), lambda t: t != "").alias("w"))
    return features.top_words(words.join(labelled(spark, sf).select("doc_id", "label"), "doc_id"), "w", ["label"])


# --- rules --------------------------------------------------------------------------

_SQL_SCORE = "floor(length(text) / (length(text) + 1500.0e0) * 1000) / 1000.0e0"


def _score():
    size = F.length("text")
    return F.floor(size / (size + 1500.0) * 1000) / 1000.0


@query(
    "r01_sane_cutoffs",
    """SELECT c_custkey, CASE WHEN (low < 0.15 AND high > 0.90) OR low >= high THEN 0.35 ELSE low END::DOUBLE AS low,
      CASE WHEN (low < 0.15 AND high > 0.90) OR low >= high THEN 0.70 ELSE high END::DOUBLE AS high
    FROM (SELECT c_custkey, (c_custkey % 100) / 100.0e0 AS low, (c_custkey * 7 % 101) / 101.0e0 AS high FROM customer)""",
)
def r01(spark, sf):
    cuts = table(spark, sf, "customer").select(
        "c_custkey", (F.col("c_custkey") % 100 / 100.0).alias("low"), (F.col("c_custkey") * 7 % 101 / 101.0).alias("high")
    )
    low, high = risk.sane_cutoffs(F.col("low"), F.col("high"))
    return cuts.select("c_custkey", low.alias("low"), high.alias("high"))


@query(
    "r02_model_tier",
    f"SELECT doc_id, CASE WHEN s < 0.35 THEN 'low' WHEN s > 0.70 THEN 'high' ELSE 'medium' END AS tier FROM (SELECT doc_id, {_SQL_SCORE} AS s FROM documents)",
)
def r02(spark, sf):
    tier = risk.model_tier(_score(), F.lit(settings.TIER_LOW), F.lit(settings.TIER_HIGH))
    return table(spark, sf, "documents").select("doc_id", tier.alias("tier"))


# Fixture patterns in the form of the fixed ones.
_POSITIVE_WORDS = "erst|ouen|de la"
_CRISIS = (r"(?:the|of)\s+that", r"un\s+(?:le|la)\s+de")
_DISTRESS = (r"\b(?:and|und)\b", r"\b(?:le|die)\s+(?:de|der)\b", r"\bto the\b|\bder die\b")


@query(
    "r03_cues",
    rf"""SELECT doc_id, regexp_matches(clean, '\b(?:{_POSITIVE_WORDS})\b') AS positive_words,
      regexp_matches(clean, '\b(?:{'|'.join(_CRISIS)})\b') AS crisis,
      {' + '.join(f"regexp_matches(clean, '{p}')::INT" for p in _DISTRESS)} AS distress_cues
    FROM {_A}""",
)
def r03(spark, sf):
    frame = clean_posts(spark, sf)
    return frame.select(
        "doc_id",
        cues.has_positive_words(F.col("clean"), _POSITIVE_WORDS).alias("positive_words"),
        cues.has_crisis_expression(F.col("clean"), expressions=_CRISIS).alias("crisis"),
        cues.distress_count(F.col("clean"), patterns=_DISTRESS).alias("distress_cues"),
    )


# Inputs of the rule chain derived from the documents so that every branch occurs.
_SQL_RULE_INPUT = f"""SELECT doc_id, clean, {_SQL_SCORE} AS score, (doc_id % 41 - 20) / 20.0e0 AS sentiment, length(trim(text)) % 97 AS raw_len,
    len({sql_tokens('clean')}) % 23 AS word_count, (doc_id % 4 = 0)::INT AS term_hits, (doc_id % 6 = 0)::INT AS negative_hits, (doc_id % 5 = 0)::INT AS positive_hits,
    doc_id % 3 = 0 AS positive_words, doc_id % 17 = 0 AS crisis, CAST(doc_id % 4 AS INT) AS distress_cues FROM {_A}"""


def _rule_input(spark, sf):
    d = F.col("doc_id")
    frame = clean_posts(spark, sf)
    return frame.select(
        "doc_id", "clean", _score().alias("score"), ((d % 41 - 20) / 20.0).alias("sentiment"),
        (F.length(F.trim("text")) % 97).alias("raw_len"),
        (F.size(F.filter(F.split("clean", " "), lambda t: t != "")) % 23).alias("word_count"),
        (d % 4 == 0).cast("double").alias("term_hits"), (d % 6 == 0).cast("double").alias("negative_hits"),
        (d % 5 == 0).cast("double").alias("positive_hits"), (d % 3 == 0).alias("positive_words"),
        (d % 17 == 0).alias("crisis"), (d % 4).cast("int").alias("distress_cues"),
    )


_SQL_BENIGN = """(term_hits < 1 AND negative_hits < 1 AND (score < 0.45 OR ((positive_hits >= 1 OR positive_words) AND sentiment >= 0.75 AND score < 0.90))
    AND (sentiment >= 0.50 OR positive_hits >= 1 OR positive_words))"""


@query("r04_benign", f"SELECT doc_id, {_SQL_BENIGN} AS benign FROM ({_SQL_RULE_INPUT})")
def r04(spark, sf):
    names = ("score", "sentiment", "term_hits", "negative_hits", "positive_hits", "positive_words")
    return _rule_input(spark, sf).select("doc_id", risk.is_benign(*[F.col(c) for c in names]).alias("benign"))


@query(
    "r05_confidence",
    f"""SELECT doc_id, CASE WHEN raw_len < 40 OR word_count < 8 THEN 'low' WHEN raw_len < 80 THEN 'medium' ELSE 'high' END AS confidence
    FROM ({_SQL_RULE_INPUT})""",
)
def r05(spark, sf):
    return _rule_input(spark, sf).select("doc_id", risk.confidence(F.col("raw_len"), F.col("word_count")).alias("confidence"))


def _sql_chain(source: str) -> str:
    """Rule chain CTEs over ``source``, ending in chain."""
    return f"""a1 AS (SELECT *, CASE WHEN score < 0.35 THEN 'low' WHEN score > 0.70 THEN 'high' ELSE 'medium' END AS model_tier,
      raw_len < 40 OR word_count < 8 AS short, {_SQL_BENIGN} AS benign, term_hits < 1 AND negative_hits < 1 AS bare FROM {source}),
    a2 AS (SELECT *, model_tier = 'high' AND sentiment <= -0.25 AND distress_cues >= 2 AS strong, CASE WHEN benign THEN 'low' ELSE model_tier END AS t1 FROM a1),
    a3 AS (SELECT *, short AND t1 = 'high' AND score < 0.88 AND bare AS capped FROM a2),
    a4 AS (SELECT *, CASE WHEN capped THEN 'medium' ELSE t1 END AS t2 FROM a3),
    a5 AS (SELECT *, t2 = 'high' AND NOT strong AND bare AND score < 0.92 AS held FROM a4),
    chain AS (SELECT *, CASE WHEN crisis THEN 'high' WHEN held THEN 'medium' ELSE t2 END AS display_tier,
      array_to_string(list_filter([CASE WHEN short THEN 'short_or_sparse_text' END, CASE WHEN crisis THEN 'explicit_crisis_language' END,
        CASE WHEN NOT crisis AND strong THEN 'strong_distress_language' END, CASE WHEN NOT crisis AND benign AND model_tier <> 'low' THEN 'positive_context_override' END,
        CASE WHEN NOT crisis AND capped THEN 'short_text_cap_high' END, CASE WHEN NOT crisis AND held THEN 'high_tier_requires_lexicon' END], lambda x: x IS NOT NULL), '|') AS flags FROM a5)"""


@query(
    "r06_display_tier",
    f"WITH {_sql_chain(f'({_SQL_RULE_INPUT})')} SELECT doc_id, model_tier, display_tier, flags FROM chain",
)
def r06(spark, sf):
    out = risk.display_tier(_rule_input(spark, sf), F.lit(settings.TIER_LOW), F.lit(settings.TIER_HIGH))
    return out.select("doc_id", "model_tier", "display_tier", F.array_join("flags", "|").alias("flags"))


_FULL = "|".join(cues.CRISIS_EXPRESSIONS)
_SQL_ASSESS_INPUT = rf"""(SELECT a.doc_id, a.clean, {_SQL_SCORE} AS score, coalesce(sentiment, 0) AS sentiment, length(trim(text)) AS raw_len,
    len({sql_tokens('clean')}) AS word_count, {_sql_count(TERMS, True)} AS term_hits, {_sql_count(NEGATIVE, False)} AS negative_hits, {_sql_count(POSITIVE, False)} AS positive_hits,
    regexp_matches(clean, '\b(?:{cues.POSITIVE_WORDS})\b') AS positive_words,
    regexp_matches(clean, '\b(?:{_FULL.replace("'", "''")})\b') AS crisis,
    {' + '.join(f"regexp_matches(clean, '{p}')::INT" for p in (q.replace("'", "''") for q in cues.DISTRESS_PATTERNS))} AS distress_cues
    FROM {_A} a LEFT JOIN sent s ON s.doc_id = a.doc_id)"""


@query(
    "r07_assess",
    f"""WITH {_sql_default_sentiment(_A)}, {_sql_chain(_SQL_ASSESS_INPUT)}
    SELECT doc_id, model_tier, display_tier, flags, sentiment, CAST(raw_len AS BIGINT) AS raw_len, CAST(word_count AS BIGINT) AS word_count, term_hits::DOUBLE AS term_hits,
      CASE WHEN raw_len < 40 OR word_count < 8 THEN 'low' WHEN raw_len < 80 THEN 'medium' ELSE 'high' END AS confidence FROM chain""",
)
def r07(spark, sf):
    frame = clean_posts(spark, sf).select("doc_id", "text", _score().alias("given"))
    out = risk.assess(frame, "text", "given", lexicons(spark))
    return out.select(
        "doc_id", "model_tier", "display_tier", F.array_join("flags", "|").alias("flags"), "sentiment",
        F.col("raw_len").cast("long").alias("raw_len"), F.col("word_count").cast("long").alias("word_count"), "term_hits", "confidence",
    )


_SQL_NOTES = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in risk.FLAG_NOTES.items())


@query(
    "r08_notes",
    f"""WITH {_sql_chain(f'({_SQL_RULE_INPUT})')}, f AS (SELECT doc_id, unnest(string_split(flags, '|')) AS f, generate_subscripts(string_split(flags, '|'), 1) AS i FROM chain)
    SELECT doc_id, string_agg(CASE f {_SQL_NOTES} ELSE f END, '{risk.NOTE_SEPARATOR}' ORDER BY i) AS notes FROM f GROUP BY 1""",
)
def r08(spark, sf):
    out = risk.display_tier(_rule_input(spark, sf), F.lit(settings.TIER_LOW), F.lit(settings.TIER_HIGH))
    return out.select("doc_id", risk.notes(F.col("flags")).alias("notes"))

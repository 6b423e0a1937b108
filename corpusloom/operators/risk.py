"""The rule layer: from a score and text evidence to a display tier with flags."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import settings
from ..functions import cues
from ..functions import text as tx
from . import lexicon, sentiment

LOW, MEDIUM, HIGH = "low", "medium", "high"

# Display names and flag notes must equal the published ones.
TIER_NAMES = {LOW: "低风险", MEDIUM: "中风险", HIGH: "高风险"}
CONFIDENCE_NAMES = {LOW: "低", MEDIUM: "中", HIGH: "高"}
FLAG_NOTES = {
    "positive_context_override": "文本偏积极且缺乏心理困扰词，已下调风险档位",
    "short_text_cap_high": "文本较短，未检出明显困扰词，已限制最高档位",
    "short_positive_downgrade": "短文本且语境积极，模型分数参考性有限",
    "high_tier_requires_lexicon": "未检出明显心理/负向词典命中，已限制为高中档",
    "short_or_sparse_text": "文本过短或词数过少，结果仅供参考",
    "explicit_crisis_language": "检测到明确的自伤或自杀相关表达，已优先显示安全求助提示",
    "strong_distress_language": "模型高分且检测到多类持续性困扰表达，保留高风险档位",
}
NOTE_SEPARATOR = "；"
# End of fixed values.


@dataclass(frozen=True)
class Lexicons:
    """Inputs of an assessment, each a small DataFrame."""

    valence: DataFrame
    terms: DataFrame
    positive: DataFrame
    negative: DataFrame
    names: DataFrame


def sane_cutoffs(low: Column, high: Column) -> tuple[Column, Column]:
    """Replace cutoffs that mark nearly everything as medium, or that cross, by defaults."""
    bad = ((low < 0.15) & (high > 0.90)) | (low >= high)
    return (
        F.when(bad, F.lit(settings.TIER_LOW)).otherwise(low),
        F.when(bad, F.lit(settings.TIER_HIGH)).otherwise(high),
    )


def model_tier(score: Column, low: Column, high: Column) -> Column:
    """Tier by the (sane) cutoffs alone; both cutoffs belong to medium."""
    return F.when(score < low, LOW).when(score > high, HIGH).otherwise(MEDIUM)


def is_short(raw_len: Column, words: Column) -> Column:
    return (raw_len < settings.SOFT_CHARS) | (words < settings.MIN_WORDS)


def confidence(raw_len: Column, words: Column) -> Column:
    """How much the input itself supports a verdict."""
    return F.when(is_short(raw_len, words), LOW).when(raw_len < settings.MEDIUM_CHARS, MEDIUM).otherwise(HIGH)


def is_benign(
    score: Column, feeling: Column, term_hits: Column, negative_hits: Column, positive_hits: Column,
    positive_words: Column,
) -> Column:
    """Clearly positive wording without any sign of distress in the lexicon."""
    explicit = (positive_hits >= 1) | positive_words
    strong = (
        explicit
        & (feeling >= settings.STRONG_POSITIVE_MIN_SENTIMENT)
        & (score < settings.STRONG_POSITIVE_MAX_SCORE)
    )
    untouched = (term_hits < 1) & (negative_hits < 1)
    believable = (score < settings.OVERRIDE_MAX_SCORE) | strong
    return untouched & believable & ((feeling >= settings.OVERRIDE_MIN_SENTIMENT) | explicit)


def display_tier(df: DataFrame, low: Column, high: Column) -> DataFrame:
    """Apply the rule chain; adds ``model_tier``, ``display_tier`` and ``flags``.

    Expects score, sentiment, raw_len, word_count, term_hits, negative_hits, positive_hits
    and the cue columns positive_words, crisis, distress_cues. Each stage is its own
    projection, so a stage is computed once and read by the later ones.
    """
    low, high = sane_cutoffs(low, high)
    score, no_evidence = F.col("score"), (F.col("term_hits") < 1) & (F.col("negative_hits") < 1)
    staged = df.withColumns(
        {
            "model_tier": model_tier(score, low, high),
            "_short": is_short(F.col("raw_len"), F.col("word_count")),
            "_benign": is_benign(
                score, F.col("sentiment"), F.col("term_hits"), F.col("negative_hits"), F.col("positive_hits"),
                F.col("positive_words"),
            ),
        }
    )
    staged = staged.withColumn(
        "_strong",
        (F.col("model_tier") == HIGH)
        & (F.col("sentiment") <= settings.DISTRESS_MAX_SENTIMENT)
        & (F.col("distress_cues") >= settings.DISTRESS_MIN_CUES),
    )
    # Step by step tiers: benign override, cap for short text, lexicon requirement.
    staged = staged.withColumn("_t1", F.when(F.col("_benign"), LOW).otherwise(F.col("model_tier")))
    capped = F.col("_short") & (F.col("_t1") == HIGH) & (score < settings.SHORT_MAX_SCORE_FOR_HIGH) & no_evidence
    staged = staged.withColumn("_capped", capped)
    staged = staged.withColumn("_t2", F.when(F.col("_capped"), MEDIUM).otherwise(F.col("_t1")))
    # Unreachable after the benign override; kept because it is part of the chain.
    relaxed = F.col("_short") & (F.col("_t2") == MEDIUM) & F.col("_benign")
    staged = staged.withColumn("_relaxed", relaxed)
    staged = staged.withColumn("_t3", F.when(F.col("_relaxed"), LOW).otherwise(F.col("_t2")))
    held = (
        F.lit(settings.HIGH_NEEDS_LEXICON)
        & (F.col("_t3") == HIGH)
        & ~F.col("_strong")
        & no_evidence
        & (score < settings.HIGH_MIN_SCORE_WITHOUT_LEXICON)
    )
    staged = staged.withColumn("_held", held)
    calm = ~F.col("crisis")
    flags = F.array(
        F.when(F.col("_short"), "short_or_sparse_text"),
        F.when(F.col("crisis"), "explicit_crisis_language"),
        F.when(calm & F.col("_strong"), "strong_distress_language"),
        F.when(calm & F.col("_benign") & (F.col("model_tier") != LOW), "positive_context_override"),
        F.when(calm & F.col("_capped"), "short_text_cap_high"),
        F.when(calm & F.col("_relaxed"), "short_positive_downgrade"),
        F.when(calm & F.col("_held"), "high_tier_requires_lexicon"),
    )
    tier = F.when(F.col("crisis"), HIGH).when(F.col("_held"), MEDIUM).otherwise(F.col("_t3"))
    return staged.withColumns({"display_tier": tier, "flags": F.array_compact(flags)}).drop(
        "_short", "_benign", "_strong", "_t1", "_capped", "_t2", "_relaxed", "_t3", "_held"
    )


def notes(flags: Column, texts: dict[str, str] | None = None, separator: str = NOTE_SEPARATOR) -> Column:
    """Flag names to note texts, joined; an unknown flag stands for itself."""
    table = F.create_map(*[F.lit(x) for pair in (texts or FLAG_NOTES).items() for x in pair])
    return F.array_join(F.transform(flags, lambda f: F.coalesce(F.try_element_at(table, f), f)), separator)


def named(c: Column, names: dict[str, str]) -> Column:
    """Tier or confidence codes to display names."""
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in names.items() for x in pair]), c)


def add_cues(df: DataFrame, clean: str, raw: str | None = None) -> DataFrame:
    raw_column = None if raw is None else F.col(raw)
    return df.withColumns(
        {
            "positive_words": cues.has_positive_words(F.col(clean)),
            "crisis": cues.has_crisis_expression(F.col(clean), raw_column),
            "distress_cues": cues.distress_count(F.col(clean), raw_column),
        }
    )


def assess(
    df: DataFrame,
    text: str,
    score: str,
    lexicons: Lexicons,
    low: float | Column = settings.TIER_LOW,
    high: float | Column = settings.TIER_HIGH,
    limit: int = settings.EVIDENCE_LIMIT,
    match_raw: bool = False,
) -> DataFrame:
    """Full assessment of each text; row by row, so it runs on streams as well.

    ``match_raw`` also looks for wording in the raw text, where apostrophes survive; off, as published.
    """
    low, high = (c if isinstance(c, Column) else F.lit(c) for c in (low, high))
    out = df.withColumns({"clean": tx.clean_text(F.col(text)), "score": F.col(score)})
    out = out.withColumns(
        {"raw_len": F.length(F.trim(F.coalesce(F.col(text), F.lit("")))), "word_count": F.size(tx.tokens(F.col("clean")))}
    )
    out = sentiment.compound(out, "clean", lexicons.valence)
    out = lexicon.evidence(
        out, "clean", lexicons.terms, lexicons.positive, lexicons.negative, lexicons.names, limit
    )
    out = display_tier(add_cues(out, "clean", text if match_raw else None), low, high)
    sane = sane_cutoffs(low, high)
    return out.withColumns(
        {
            "confidence": confidence(F.col("raw_len"), F.col("word_count")),
            "thresholds": F.create_map(F.lit("low"), sane[0], F.lit("high"), sane[1]),
            "notes": notes(F.col("flags")),
        }
    )

"""Wording cues: positive words, crisis expressions, distress patterns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The wording lists must equal the published ones. ASCII and typographic
# apostrophes are both accepted.
POSITIVE_WORDS = (
    r"happy|happiness|joy|love|loved|loving|enjoy|enjoyed|grateful|gratitude|wonderful|great|amazing|excited|glad"
    r"|pleased|fun|smile|smiling|blessed|content|cheerful|delighted|fantastic|awesome|good day|feel good"
)
CRISIS_EXPRESSIONS = (
    r"(?:kill|hurt|harm)\s+myself",
    r"end\s+my\s+(?:life|existence)",
    r"take\s+my\s+own\s+life",
    r"(?:i\s+)?(?:want|wish|plan|intend|think|thinking|thought|thoughts)\s+(?:about\s+|of\s+|to\s+)?"
    r"(?:die|dying|suicide|killing\s+myself|hurting\s+myself|harming\s+myself)",
    r"i\s+(?:do\s+not|don['’]?t)\s+want\s+to\s+(?:live|be\s+alive|continue)",
    r"(?:i\s+)?(?:have|feel\s+there\s+is)\s+no\s+reason\s+to\s+(?:live|continue)",
    r"i(?:'m|\s+am)\s+(?:better\s+off\s+dead|suicidal)",
    r"i\s+(?:want|wish)\s+i\s+(?:would\s+not|wouldn['’]?t|did\s+not|didn['’]?t)\s+wake\s+up",
    r"self[\s-]?harm",
    r"suicidal",
)
DISTRESS_PATTERNS = (
    r"\b(?:hopeless|hopelessness|no hope)\b",
    r"\b(?:worthless|worthlessness|useless|a burden)\b",
    r"\b(?:lost|lose|losing|no)\s+(?:all\s+)?interest\b|\bno longer (?:enjoy|care about|interested in)\b",
    r"\b(?:nothing|life|everything)\s+(?:seems|feels|is)\s+(?:meaningless|pointless|empty|not meaningful)\b"
    r"|\bnothing seems meaningful\b",
    r"\b(?:empty|numb|disconnected)\s+(?:every day|all the time|inside)?\b",
    r"\b(?:cannot|can['’]?t|struggle to)\s+(?:get out of bed|sleep|concentrate|function)\b",
)
# End of fixed values.


def whole_words(alternatives: str) -> str:
    return rf"\b(?:{alternatives})\b"


def has_positive_words(clean: Column, words: str = POSITIVE_WORDS) -> Column:
    return clean.rlike(whole_words(words))


def _both(clean: Column, raw: Column | None, pattern: str) -> Column:
    """Match the cleaned text or the lower-cased raw text.

    Cleaning turns apostrophes into spaces, so their forms only match the raw text; a raw
    text without any apostrophe cannot match where its cleaned form does not.
    """
    found = clean.rlike(pattern)
    if raw is None:
        return found
    apostrophe = raw.contains("'") | raw.contains("’")
    return found | F.when(apostrophe, F.lower(raw).rlike("(?U)" + pattern)).otherwise(F.lit(False))


def has_crisis_expression(clean: Column, raw: Column | None = None, expressions=CRISIS_EXPRESSIONS) -> Column:
    return _both(clean, raw, whole_words("|".join(expressions)))


def distress_count(clean: Column, raw: Column | None = None, patterns=DISTRESS_PATTERNS) -> Column:
    """Number of different distress patterns found."""
    total = F.lit(0)
    for pattern in patterns:
        total = total + _both(clean, raw, pattern).cast("int")
    return total

"""Label expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import settings

LABEL_TYPES = ("binary_numeric", "mental_health_status", "string_positive_set", "urdu_severity")

_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def numeric_or_null(c: Column) -> Column:
    """A finite number, or null for anything else (words, blanks, nan, inf)."""
    text = c.cast("string")
    return F.when(text.rlike(_NUMBER), F.trim(text).try_cast("double"))


def normalise_label(
    c: Column, label_type: str, positives: Iterable[str] = settings.POSITIVE_LABELS
) -> Column:
    """Label of one source as "0" or "1"."""
    if label_type not in LABEL_TYPES:
        raise ValueError(f"unknown label type {label_type!r}; expected one of {LABEL_TYPES}")
    number = numeric_or_null(c)
    if label_type == "binary_numeric":
        positive = (number >= 1) & (number < 2)
    elif label_type in ("mental_health_status", "string_positive_set"):
        positive = F.trim(c.cast("string")).isin(list(positives))
    else:
        positive = number >= 1
    return F.when(positive, "1").otherwise("0")

"""Compound sentiment of cleaned text after the VADER rules (Hutto & Gilbert, 2014).

The valence table is an input. Cleaned text has no capitals or punctuation, so only the
word rules apply: boosters, negation, "never so", "least" and "but".
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from .wordtable import flat_rows, word_values

# The published rule constants and word lists.
BOOST = 0.293
NEGATION = -0.74
NEVER_SO = 1.25
ALPHA = 15.0
DISTANCE_DAMPING = (1.0, 0.95, 0.9)
BEFORE_BUT, AFTER_BUT = 0.5, 1.5
BOOSTERS_UP = (
    "absolutely", "amazingly", "awfully", "completely", "considerable", "considerably", "decidedly", "deeply",
    "effing", "enormous", "enormously", "entirely", "especially", "exceptional", "exceptionally", "extreme",
    "extremely", "fabulously", "flipping", "flippin", "frackin", "fracking", "fricking", "frickin", "frigging",
    "friggin", "fully", "fuckin", "fucking", "fuggin", "fugging", "greatly", "hella", "highly", "hugely",
    "incredible", "incredibly", "intensely", "major", "majorly", "more", "most", "particularly", "purely", "quite",
    "really", "remarkably", "so", "substantially", "thoroughly", "total", "totally", "tremendous", "tremendously",
    "uber", "unbelievably", "unusually", "utter", "utterly", "very",
)
BOOSTERS_DOWN = (
    "almost", "barely", "hardly", "kinda", "kindof", "less", "little", "marginal", "marginally", "occasional",
    "occasionally", "partly", "scarce", "scarcely", "slight", "slightly", "somewhat", "sorta", "sortof",
)
NEGATIONS = (
    "aint", "arent", "cannot", "cant", "couldnt", "darent", "didnt", "doesnt", "dont", "hadnt", "hasnt", "havent",
    "isnt", "mightnt", "mustnt", "neednt", "neither", "never", "none", "nope", "nor", "not", "nothing", "nowhere",
    "oughtnt", "shant", "shouldnt", "uhuh", "wasnt", "werent", "without", "wont", "wouldnt", "rarely", "seldom",
    "despite",
)
# End of fixed values.

_RULE_WORDS = {"no", "or", "nor", "never", "so", "this", "without", "doubt", "least", "at", "very", "but", "kind", "of"}


def compound_column(
    words: str,
    valences: str,
    up: Iterable[str] = BOOSTERS_UP,
    down: Iterable[str] = BOOSTERS_DOWN,
    negations: Iterable[str] = NEGATIONS,
) -> Column:
    """Compound score of a token array column, for all tokens of an Arrow batch at once.

    ``valences`` holds the valence of every token, null where it has none.
    """
    up, down, negations = set(up), set(down), set(negations)
    special = sorted(up | down | negations | _RULE_WORDS)
    place = {w: i for i, w in enumerate(special)}
    other = len(special)  # the code of all other words, and of places outside the text

    def flags(chosen: Iterable[str]) -> np.ndarray:
        out = np.zeros(other + 1, dtype=bool)
        out[[place[w] for w in chosen]] = True
        return out

    booster, negation, skipped = np.zeros(other + 1), flags(negations), flags(up | down)
    booster[flags(down)] = -1.0
    booster[flags(up)] = 1.0

    @F.arrow_udf("double")
    def total(tokens: pa.Array, values: pa.Array) -> pa.Array:
        flat, rows, sizes = flat_rows(tokens)
        codes = pc.fill_null(pc.index_in(flat, value_set=pa.array(special, flat.type)), other).to_numpy(zero_copy_only=False)
        valued = values.flatten()
        known = pc.is_valid(valued).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes)
        first = ends - sizes

        def code_at(at: np.ndarray, inside: np.ndarray) -> np.ndarray:
            return np.where(inside, codes[np.where(inside, at, 0)], other)

        def known_at(at: np.ndarray, inside: np.ndarray) -> np.ndarray:
            return inside & known[np.where(inside, at, 0)]

        # Words with a valence that are not boosters themselves, with their three predecessors.
        hit = np.flatnonzero(known & ~skipped[codes])
        after = code_at(hit + 1, hit + 1 < ends[rows[hit]])
        hit = hit[~((codes[hit] == place["kind"]) & (after == place["of"]))]
        row, word = rows[hit], codes[hit]
        i = hit - first[row]
        value = valued.take(pa.array(hit)).to_numpy(zero_copy_only=False).astype(float)
        p1, p2, p3 = (code_at(hit - d, i >= d) for d in (1, 2, 3))
        one_of = lambda p, *chosen: np.isin(p, [place[w] for w in chosen])

        # "no" before a valenced word is silent and flips that word.
        after_no = one_of(p1, "no") | one_of(p2, "no") | (one_of(p3, "no") & one_of(p1, "or", "nor"))
        silent = one_of(word, "no") & known_at(hit + 1, hit + 1 < ends[row])
        value = np.where(after_no, value * NEGATION, np.where(silent, 0.0, value))

        # The published rule lets "so" or "this" right before the word count on its own.
        none = np.zeros(len(hit), dtype=bool)
        rules = (
            (p1, none, none),
            (p2, one_of(p2, "never") & one_of(p1, "so", "this"), one_of(p2, "without") & one_of(p1, "doubt")),
            (p3, (one_of(p3, "never") & one_of(p2, "so", "this")) | one_of(p1, "so", "this"),
             one_of(p3, "without") & (one_of(p2, "doubt") | one_of(p1, "doubt"))),
        )
        for distance, (before, never, doubt) in enumerate(rules, 1):
            boost = booster[before] * (BOOST * DISTANCE_DAMPING[distance - 1])
            flip = np.where(never, NEVER_SO, np.where(doubt, 1.0, np.where(negation[before], NEGATION, 1.0)))
            applies = (i >= distance) & ~known_at(hit - distance, i >= distance)
            value = np.where(applies, (value + np.where(value < 0, -boost, boost)) * flip, value)

        bare = one_of(p1, "least") & ~known_at(hit - 1, i >= 1)
        least = np.where(bare & ((i == 1) | ~one_of(p2, "at", "very")), NEGATION, 1.0)
        but = np.flatnonzero(codes == place["but"])[::-1]
        but_at = np.full(len(sizes), -1)
        but_at[rows[but]] = but - first[rows[but]]  # the first of a text is written last
        cut = but_at[row]
        side = np.where((cut < 0) | (i == cut), 1.0, np.where(i < cut, BEFORE_BUT, AFTER_BUT))
        return pa.array(np.bincount(row, value * least * side, len(sizes)).astype(float))

    return tx.let(
        total(F.col(words), F.col(valences)),
        lambda s: F.round(F.greatest(F.least(F.coalesce(s / F.sqrt(s * s + ALPHA), F.lit(0.0)), F.lit(1.0)), F.lit(-1.0)), 4),
    )


def compound(
    df: DataFrame,
    clean: str,
    valence: DataFrame,
    to: str = "sentiment",
    up: Iterable[str] = BOOSTERS_UP,
    down: Iterable[str] = BOOSTERS_DOWN,
    negations: Iterable[str] = NEGATIONS,
    doc: Sequence[str] = (),
) -> DataFrame:
    """Adds the compound sentiment; ``valence`` has (word, valence) and may have any size.

    ``doc`` names a unique row key, needed only for a table beyond ``settings.LOOKUP_BYTES``.
    """
    table = valence.select("word", F.col("valence").cast("double").alias("valence"))
    marked = word_values(df.withColumn("_words", tx.tokens(F.col(clean))), "_words", table, "_valences", "word", "valence", doc)
    return marked.withColumn(to, compound_column("_words", "_valences", up, down, negations)).drop("_words", "_valences")

"""Toxicity by compression distance.

Two zstandard dictionaries are trained on a bounded sample of labelled documents: one on
ordinary text, one on toxic text. A text is cut into windows of a few words, every window is
compressed with both, and the length saved by the toxic dictionary is the window's distance.
Counts of windows per distance, and the number of windows, go through a calibrated logistic
threshold learned on documents that neither dictionary has seen.

Training. The ordinary dictionary is zstandard's own (cover algorithm) over ordinary windows.
The toxic one continues it, so that both agree on everything ordinary and a difference can
only come from toxic content: the words that are over-represented among *distinct* windows
of toxic documents (copies of one document count once). Ordinary windows that the toxic part
shortens by chance are then added to the ordinary part, round by round.

Defined results: null, empty and blank texts have no windows and get the score of zero windows
(the intercept); very long texts are scored whole; equal texts get equal scores; without both
labels in the sample every score is the label's share (0 without labels). Extra columns of the
inputs stay as they are; nothing is read but the named columns.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard as zs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fit_logistic, fold, labelled_sample, read_table

SAMPLE_ROWS = 12_000
WINDOW_WORDS = 16
_LEAST_WINDOWS = 6  # a toxic word occurs in so many distinct windows at least,
_LEAST_SHARE = 2000  # and in one of so many toxic windows
_RATIO = 10.0  # and is so many times as frequent as in ordinary windows
_MATCH = 6  # bytes of a dictionary match
_ROUNDS = 3
_HARD_WINDOWS = 300_000
_LEVELS = (2, 3, 4, 5, 6, 7)


@dataclass(frozen=True)
class CompressionModel:
    """Dictionary contents and the calibrated weights."""

    ordinary: bytes
    toxic: bytes
    weights: tuple[float, ...]
    base: float


def windows(text: str | None, size: int = WINDOW_WORDS) -> list[bytes]:
    """Lower-cased (A-Z) word windows of a text, each framed by blanks."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    return [b" " + b" ".join(words[i : i + size]) + b" " for i in range(0, len(words), size)]


def _compressor(content: bytes) -> zs.ZstdCompressor:
    settings = zs.ZstdCompressionParameters.from_level(
        3, window_log=18, hash_log=17, chain_log=17, search_log=4, min_match=_MATCH, strategy=zs.STRATEGY_LAZY2,
        write_content_size=False, write_checksum=False, write_dict_id=False,
    )
    held = zs.ZstdCompressionDict(content, dict_type=zs.DICT_TYPE_RAWCONTENT)
    held.precompute_compress(compression_params=settings)
    return zs.ZstdCompressor(dict_data=held, compression_params=settings)


class _Distance:
    """Bytes saved per window by the toxic dictionary."""

    def __init__(self, ordinary: bytes, toxic: bytes):
        self.plain, self.marked = _compressor(ordinary).compress, _compressor(ordinary + toxic).compress

    def __call__(self, cut: list[bytes]) -> np.ndarray:
        return np.fromiter((len(self.plain(w)) - len(self.marked(w)) for w in cut), dtype=np.int64, count=len(cut))

    def features(self, text: str | None) -> np.ndarray:
        cut = windows(text)
        gains = self(cut)
        counts = [(gains == k).sum() for k in _LEVELS] + [(gains > _LEVELS[-1]).sum()]
        top = gains.max(initial=0) / 5
        return np.r_[np.log1p(counts), np.log1p(len(cut)), top, 1.0]


def _trained(size: int, samples: list[bytes]) -> bytes:
    """A zstandard dictionary of the samples; plain samples where they are too few to train on."""
    if len(samples) >= 50 and sum(map(len, samples)) >= 20 * size:
        return zs.train_dictionary(size, samples, k=64, d=8).as_bytes()
    return b"".join(samples)[-size:]


def _toxic_words(toxic: list[str], ordinary: list[str]) -> list[bytes]:
    """Words over-represented in distinct toxic windows, the commonest last (nearest, for zstandard)."""
    sides = []
    for texts in (toxic, ordinary):
        distinct = {w for t in texts for w in windows(t)}
        counts: Counter = Counter()
        for w in distinct:
            counts.update(set(w.split()))
        sides.append((counts, len(distinct)))
    (a, n_a), (b, n_b) = sides
    share = lambda w: (a[w] / max(n_a, 1)) / ((b[w] + 0.5) / (n_b + 1))
    least = max(_LEAST_WINDOWS, n_a // _LEAST_SHARE)
    kept = [w for w in a if len(w) >= 4 and a[w] >= least and share(w) >= _RATIO]
    return sorted(kept, key=lambda w: (a[w], w))


def _dictionaries(rows: list[tuple[str, int]], rng: np.random.Generator) -> tuple[bytes, bytes]:
    """(ordinary, toxic) content from labelled texts."""
    toxic, ordinary = [t for t, y in rows if y], [t for t, y in rows if not y]
    added = b" " + b"  ".join(_toxic_words(toxic, ordinary)) + b" "
    cut = [w for t in ordinary for w in windows(t)]
    cut = [cut[i] for i in rng.permutation(len(cut))]
    base = _trained(110_000, cut[:150_000]) or b" "
    for _ in range(_ROUNDS):
        sample = cut[:_HARD_WINDOWS]
        gains = _Distance(base, added)(sample)
        base = b"".join(w for w, g in zip(sample, gains) if g >= 2)[:60_000] + base
    return base, added


def train(rows: list[tuple[str, int]]) -> CompressionModel:
    """Fit dictionaries and thresholds on (text, label) rows.

    Dictionaries are trained on two thirds of the rows, thresholds calibrated on the others.
    """
    rows = sorted(set(rows))  # copies of a text count once
    share = float(np.mean([y for _, y in rows])) if rows else 0.0
    rng = np.random.default_rng(42)
    rows = [rows[i] for i in rng.permutation(len(rows))]
    fit, held = [r for i, r in enumerate(rows) if i % 3], rows[::3]
    if len({y for _, y in fit}) < 2 or len({y for _, y in held}) < 2:
        return CompressionModel(b" ", b" ", (), share)
    contents = _dictionaries(fit, rng)
    distance = _Distance(*contents)
    x = np.array([distance.features(t) for t, _ in held])
    weights = fit_logistic(x, np.array([y for _, y in held], float))
    return CompressionModel(*contents, tuple(weights), share)


def toxicity_score(text: Column, model: CompressionModel) -> Column:
    """Score of whole texts, 0 to 1; Arrow batches, as zstandard runs outside the JVM."""
    weights = np.array(model.weights)

    @F.pandas_udf("double")
    def score(batch: pd.Series) -> pd.Series:
        if not len(weights):
            return pd.Series(np.full(len(batch), model.base))
        distance = _Distance(model.ordinary, model.toxic)
        x = np.array([distance.features(t) for t in batch]).reshape(len(batch), len(weights))
        return pd.Series(1 / (1 + np.exp(-np.clip(x @ weights, -30, 30))))

    return score(text)


def train_on(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, key: str = "doc_id", text: str = "text",
             label: str = "toxic") -> CompressionModel:
    """Train on at most ``rows`` labelled documents; documents of fold 0 are never used."""
    found = labelled_sample(docs, labels, key, text, label, rows).select("text", "label").collect()
    return train([(r["text"], r["label"]) for r in found])


def classify(docs: DataFrame, model: CompressionModel, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """``docs`` with score and predicted; an input column of these names is replaced."""
    scored = docs.withColumn("score", toxicity_score(F.col(text), model))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def op7_toxicity(spark, sf_dir: str) -> DataFrame:
    """Toxicity of every document: doc_id, held_out, score, predicted."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train_on(docs, read_table(spark, sf_dir, "labels"))
    return classify(docs, model).select(
        "doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score", "predicted"
    )

"""Many fixed phrases against cleaned texts: an automaton as one compact array.

Cleaned text consists of a-z and single spaces, so the automaton is a dense table (state, letter) -> state. It is built level by
level from the sorted phrases, with the failure links folded into the table, and run over
all texts of an Arrow batch in step: one table look-up per character moves every text on by one letter. Long texts are cut
into chunks that overlap by the longest phrase, so a batch is always wide.

A lexicon whose table would exceed ``settings.AUTOMATON_BYTES`` is dealt to several automata in alphabetical order, which
keeps shared beginnings together; texts then pass through one after another. Nothing is exploded or
shuffled, whatever the size of the lexicon or the frequency of its words.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

_LETTERS = 28  # other, space, a to z
_SPACE = 1
_CHUNK = 1024
_BATCH_CHARS = 1 << 22

_CODES = np.zeros(256, dtype=np.uint8)
_CODES[ord(" ")] = _SPACE
_CODES[ord("a") : ord("z") + 1] = np.arange(2, _LETTERS)


@dataclass(frozen=True)
class Automaton:
    """``move``: next state by state * letters + letter; ``phrase``: the phrase that ends in a state, or -1; ``shorter``: the
    next state along the failure links that ends a phrase, or 0."""

    move: np.ndarray
    phrase: np.ndarray
    shorter: np.ndarray
    longest: int


def build(phrases: Sequence[str]) -> Automaton:
    """The automaton of distinct phrases of a-z and spaces."""
    order = sorted(range(len(phrases)), key=lambda i: phrases[i])
    data = [phrases[i].encode("ascii") for i in order]
    lengths = np.array([len(d) for d in data], dtype=np.int64)
    starts = np.r_[0, np.cumsum(lengths)[:-1]] if len(data) else np.empty(0, dtype=np.int64)
    codes = _CODES[np.frombuffer(b"".join(data), dtype=np.uint8)]
    at = np.zeros(len(data), dtype=np.int64)
    levels, count = [], 1
    for depth in range(int(lengths.max(initial=0))):
        alive = np.flatnonzero(lengths > depth)
        edge = at[alive] * _LETTERS + codes[starts[alive] + depth]
        unique, place = np.unique(edge, return_inverse=True)
        at[alive] = count + place
        levels.append(unique)
        count += len(unique)
    move = np.zeros(count * _LETTERS, dtype=np.int32)
    phrase = np.full(count, -1, dtype=np.int32)
    phrase[at] = order
    fail, shorter = np.zeros(count, dtype=np.int64), np.zeros(count, dtype=np.int32)
    rows = move.reshape(count, _LETTERS)
    first = 1
    for depth, edges in enumerate(levels):
        states = np.arange(first, first + len(edges))
        parent, letter = edges // _LETTERS, edges % _LETTERS
        if depth:
            fail[states] = move[fail[parent] * _LETTERS + letter]
        move[edges] = states
        first += len(edges)
        # the rows of this level start as those of their failure states; the next level adds its own edges
        rows[states] = rows[fail[states]]
        shorter[states] = np.where(phrase[fail[states]] >= 0, fail[states], shorter[fail[states]])
    return Automaton(move, phrase, shorter, int(lengths.max(initial=0)))


def scan(automaton: Automaton, texts: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(text, phrase) pairs, each once, ordered by text and phrase."""
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    codes = _CODES[np.frombuffer(b"".join(texts), dtype=np.uint8)]
    begins = np.r_[0, np.cumsum(lengths)[:-1]] if len(texts) else lengths
    overlap = max(automaton.longest - 1, 0)
    step = max(_CHUNK, 2 * overlap)
    pieces = -(-lengths // step)
    owner = np.repeat(np.arange(len(texts)), pieces)
    number = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    start = begins[owner] + number * step
    size = np.minimum(begins[owner] + lengths[owner] - start, step + overlap)
    order = np.argsort(-size, kind="stable")
    owner, start, size = owner[order], start[order], size[order]
    wide = np.searchsorted(-size, -np.arange(int(size.max(initial=0))), side="left")  # chunks longer than i
    state = np.zeros(len(owner), dtype=np.int64)
    ends = (automaton.phrase >= 0) | (automaton.shorter > 0)
    found_text, found_state = [], []
    for i, n in enumerate(wide.tolist()):
        now = automaton.move[state[:n] * _LETTERS + codes[start[:n] + i]]
        state[:n] = now
        hit = np.flatnonzero(ends[now])
        if len(hit):
            found_text.append(owner[hit])
            found_state.append(now[hit])
    if not found_text:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    text, last = np.concatenate(found_text), np.concatenate(found_state).astype(np.int64)
    states = len(automaton.phrase)
    pairs = np.unique(text * states + last)
    text, last, out = pairs // states, pairs % states, []
    while len(last):
        own = automaton.phrase[last]
        out.append(np.stack([text[own >= 0], own[own >= 0]], axis=1))
        text, last = text[automaton.shorter[last] > 0], automaton.shorter[last][automaton.shorter[last] > 0].astype(np.int64)
    every = np.unique(np.concatenate(out), axis=0)
    return every[:, 0], every[:, 1]


def deal(phrases: Sequence[str], limit: int) -> list[list[str]]:
    """Sorted phrases in runs whose tables stay below ``limit`` bytes; shared beginnings count once."""
    parts: list[list[str]] = []
    states, before = 0, ""
    most = max(limit // (4 * _LETTERS + 8), 1)
    for phrase in sorted(phrases):
        shared = 0
        for x, y in zip(before, phrase):
            if x != y:
                break
            shared += 1
        if not parts or states + len(phrase) - shared > most:
            parts.append([])
            states, shared = 1, 0
        parts[-1].append(phrase)
        states += len(phrase) - shared
        before = phrase
    return parts


def contained(spark: SparkSession, text: Column, phrases: Sequence[str]) -> Column:
    """Array of the phrases that each text contains, from one broadcast automaton.

    The size of the table must have been bounded with :func:`deal`.
    """
    shared = spark.sparkContext.broadcast((build(phrases), list(phrases)))

    @F.pandas_udf("array<string>")
    def mark(batch: pd.Series) -> pd.Series:
        automaton, names = shared.value
        out: list[list[str]] = [[] for _ in range(len(batch))]
        texts = [(t or "").encode("ascii", "replace") for t in batch]
        first = 0
        while first < len(texts):
            last, held = first, 0
            while last < len(texts) and (last == first or held + len(texts[last]) <= _BATCH_CHARS):
                held += len(texts[last])
                last += 1
            for at, phrase in zip(*(x.tolist() for x in scan(automaton, texts[first:last]))):
                out[first + at].append(names[phrase])
            first = last
        return pd.Series(out, dtype=object)

    return mark(text)

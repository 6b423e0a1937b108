"""Lexicon evidence: terms, phrases, community names.

A lexicon is a DataFrame. A handful of entries becomes a constant array, matched inside the row. Others are compiled
to automata (:mod:`automaton`) that texts pass through in Arrow batches. Neither way explodes or shuffles a text,
so frequent words, shared beginnings and the number of entries do not matter to the plan. Only one part of a large lexicon
is on the driver at a time.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import settings
from ..session import cut_lineage, small_table
from .automaton import contained, deal

PLACEHOLDERS = ("_condition", "_doctor", "_ref")
_SHORT_NAME = 3


def _entries(lexicon: DataFrame, column: str) -> Iterator[list[str]]:
    """The distinct entries that a cleaned text can contain, sorted, in parts of bounded size."""
    entry = F.trim(F.regexp_replace(F.lower(F.col(column)), r"\s+", " "))
    usable = lexicon.select(entry.alias("entry")).filter(F.col("entry").rlike("^[a-z ]+$")).distinct()
    part, size = [], 0
    for row in usable.orderBy("entry").toLocalIterator(prefetchPartitions=False):
        part.append(row.entry)
        size += len(row.entry) + 1
        if size > settings.LEXICON_PART_CHARS:
            yield part
            part, size = [], 0
    if part:
        yield part


def _found(df: DataFrame, text: Column, parts: Iterator[list[str]], wanted: Callable[[str], str | None], to: str) -> DataFrame:
    """Adds the sorted entries whose wanted form a text contains; entries without one are left out."""
    columns: list[str] = []
    alive = 0
    for part in parts:
        forms = sorted({form for entry in part if (form := wanted(entry)) is not None})
        few = len(forms) <= settings.ROW_ENTRIES
        for dealt in [forms] if few else deal(forms, settings.AUTOMATON_BYTES):
            if alive == settings.AUTOMATA_AT_ONCE:  # a written table lets go of the automata before
                df, alive = cut_lineage(df), 0
            columns.append(f"_{to}_{len(columns)}")
            df = df.withColumn(columns[-1], _contained(text, dealt) if few else contained(df.sparkSession, text, dealt))
            alive += not few
    if not columns:
        return df.withColumn(to, F.array().cast("array<string>"))
    every = F.col(columns[0]) if len(columns) == 1 else F.concat(*columns)
    return df.withColumn(to, F.sort_array(F.transform(every, lambda e: F.trim(e)))).drop(*columns)


def expand(patterns: DataFrame, expansions: DataFrame, limit: int | None = None) -> DataFrame:
    """Phrases from pattern lines with placeholders.

    ``patterns`` has a column ``line``; ``expansions`` has (placeholder, position, value).
    Every combination of values replaces the placeholders of a line; a line without
    placeholder is taken as it is. ``limit`` keeps the first combinations of a line in the order
    of the values: ``settings.EXPANSIONS_PER_LINE`` is the published value, None keeps all.
    """
    values = expansions.groupBy("placeholder").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("position", "value"))), lambda v: F.lower(v["value"])).alias(
            "pool"
        )
    )
    table = small_table(values)
    if not table.is_local:
        raise ValueError("too many placeholders")
    pools = {row.placeholder: row.pool for row in table.rows}
    line = F.trim(F.lower(F.col("line")))
    out = patterns.select(line.alias("line")).filter(F.length("line") > 0)
    out = out.withColumns({"found": F.array(line), "expanded": F.lit(False)})
    for placeholder in PLACEHOLDERS:
        if not pools.get(placeholder):
            continue
        pool = F.array(*[F.lit(value) for value in pools[placeholder]])
        has = F.col("line").contains(placeholder)
        # Earlier placeholders vary slowest, so the first combinations stay the first.
        combined = F.flatten(F.transform("found", _filler(placeholder, pool)))
        out = out.withColumns(
            {"found": F.when(has, combined).otherwise(F.col("found")), "expanded": F.col("expanded") | has}
        )
    spaced = F.transform("found", lambda p: F.trim(F.regexp_replace(p, r"\s+", " ")))
    kept = F.filter(spaced, lambda p: F.length(p) >= 4)
    first = kept if limit is None else F.slice(kept, 1, limit)
    phrases = F.when(F.col("expanded"), first).otherwise(spaced)
    return out.select(F.explode(phrases).alias("phrase")).distinct()


def _filler(placeholder: str, pool: Column):
    def fill(pattern: Column) -> Column:
        return F.transform(pool, lambda value: F.replace(pattern, F.lit(placeholder), value))

    return fill


def _literal(entries: Sequence[str]) -> Column:
    # One JSON literal instead of thousands of expression nodes; folded once.
    return F.from_json(F.lit(json.dumps(list(entries))), "array<string>")


def _padded(clean: Column) -> Column:
    return F.concat(F.lit(" "), clean, F.lit(" "))


def _contained(text: Column, entries: Sequence[str]) -> Column:
    """Entries found anywhere in the text."""
    return F.filter(_literal(entries), lambda e: text.contains(e))


def _word(entry: str, least: int = 2) -> str | None:
    return f" {entry} " if len(entry) >= least else None


def term_matches(df: DataFrame, clean: str, terms: DataFrame, to: str = "matches") -> DataFrame:
    """Adds the sorted whole-word terms of each cleaned text; terms have two letters or more."""
    return _found(df, _padded(F.col(clean)), _entries(terms, terms.columns[0]), _word, to)


def phrase_matches(df: DataFrame, clean: str, phrases: DataFrame, to: str = "matches") -> DataFrame:
    """Adds the sorted phrases contained anywhere in each cleaned text."""
    return _found(df, F.col(clean), _entries(phrases, phrases.columns[0]), lambda e: e, to)


def mention_matches(
    df: DataFrame, clean: str, names: DataFrame, word_to: str = "word_names", r_to: str = "r_names"
) -> DataFrame:
    """Adds community names found as a word, and those found only after "r".

    Names of up to three letters count only after "r", as alone they are too common.
    """
    text, column = _padded(F.col(clean)), names.columns[0]
    out = _found(df, text, _entries(names, column), lambda e: _word(e, _SHORT_NAME + 1), word_to)
    after = _found(out, text, _entries(names, column), lambda e: f" r {e} " if len(e) >= 2 else None, r_to)
    bare = F.transform(r_to, lambda n: F.substr(n, F.lit(3)))
    return after.withColumn(r_to, F.array_except(F.sort_array(bare), F.col(word_to)))


def term_hits(df: DataFrame, clean: str, terms: DataFrame, to: str = "term_hits") -> DataFrame:
    found = term_matches(df, clean, terms, "_m")
    return found.withColumn(to, F.size("_m").cast("double")).drop("_m")


def phrase_hits(df: DataFrame, clean: str, phrases: DataFrame, to: str = "phrase_hits") -> DataFrame:
    found = phrase_matches(df, clean, phrases, "_m")
    return found.withColumn(to, F.size("_m").cast("double")).drop("_m")


def mention_hits(df: DataFrame, clean: str, names: DataFrame) -> DataFrame:
    found = mention_matches(df, clean, names, "_w", "_r")
    return found.withColumns(
        {"mention_word_hits": F.size("_w").cast("double"), "mention_r_hits": F.size("_r").cast("double")}
    ).drop("_w", "_r")


def evidence(
    df: DataFrame,
    clean: str,
    terms: DataFrame,
    positive: DataFrame,
    negative: DataFrame,
    names: DataFrame,
    limit: int = 8,
) -> DataFrame:
    """All hit counts plus capped lists of what was found.

    Lists are alphabetical, names longest first with an "r/" mark where only that form
    was found; phrases are cut to 120 characters.
    """
    out = term_matches(df, clean, terms, "_terms")
    out = phrase_matches(out, clean, positive, "_pos")
    out = phrase_matches(out, clean, negative, "_neg")
    out = mention_matches(out, clean, names, "_names", "_r_names")
    marked = F.concat(
        F.transform("_names", lambda n: F.struct((-F.length(n)).alias("l"), n.alias("n"), n.alias("shown"))),
        F.transform(
            "_r_names",
            lambda n: F.struct((-F.length(n)).alias("l"), n.alias("n"), F.concat(F.lit("r/"), n).alias("shown")),
        ),
    )
    shown = F.transform(F.slice(F.sort_array(marked), 1, limit), lambda m: m["shown"])
    return out.withColumns(
        {
            "term_hits": F.size("_terms").cast("double"),
            "positive_hits": F.size("_pos").cast("double"),
            "negative_hits": F.size("_neg").cast("double"),
            "mention_word_hits": F.size("_names").cast("double"),
            "mention_r_hits": F.size("_r_names").cast("double"),
            "term_list": F.slice("_terms", 1, limit),
            "positive_list": F.transform(F.slice("_pos", 1, limit), lambda p: F.substring(p, 1, 120)),
            "negative_list": F.transform(F.slice("_neg", 1, limit), lambda p: F.substring(p, 1, 120)),
            "mention_list": shown,
        }
    ).drop("_terms", "_pos", "_neg", "_names", "_r_names")

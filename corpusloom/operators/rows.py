"""Row-level operators over text tables: filters, fills, codes, token rewriting."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import settings
from ..functions import text as tx
from ..session import small_table
from .quality import dedupe_first
from .ranking import ordered_index, running_totals
from .wordtable import list_stats, replaced, without_known, word_values


def drop_blank(df: DataFrame, text: str, label: str, row_key: str) -> DataFrame:
    """Drop null and empty texts, strip labels, keep the first row of every raw text."""
    kept = df.filter(F.col(text).isNotNull() & (F.length(text) > 0)).withColumn(
        label, F.trim(F.col(label).cast("string"))
    )
    return dedupe_first(kept, [text], row_key)


def min_length(
    df: DataFrame,
    length: str,
    default: int = settings.MIN_SAMPLE_CHARS,
    overrides: DataFrame | None = None,
    source: str = "source_id",
) -> DataFrame:
    """Keep rows of at least ``default`` characters, or of their source's own minimum.

    ``overrides`` has columns (``source``, min_chars), one row per source.
    """
    if overrides is None:
        return df.filter(F.col(length) >= default)
    table = small_table(overrides.select(source, F.col("min_chars").alias("_min_chars")))
    joined = df.join(table.frame, source, "left")
    return joined.filter(F.col(length) >= F.coalesce("_min_chars", F.lit(default))).drop("_min_chars")


def longer_than(df: DataFrame, length: str, limit: int) -> DataFrame:
    return df.filter(F.col(length) > limit)


def char_sentence_counts(df: DataFrame, text: str) -> DataFrame:
    return df.withColumns(
        {"num_of_characters": F.length(text), "num_of_sentences": tx.sentence_count(F.col(text))}
    )


def fill_or_drop(
    df: DataFrame,
    drop_columns: Sequence[str] = (),
    fill: Mapping[str, object] | None = None,
    drop_incomplete: bool = False,
) -> DataFrame:
    """Drop columns, fill nulls with constants, then drop rows with any null left."""
    out = df.drop(*drop_columns)
    if fill:
        out = out.na.fill(dict(fill))
    return out.na.drop("any") if drop_incomplete else out


def _lookup(c: Column, mapping: Mapping) -> Column:
    entries = [F.lit(value) for pair in mapping.items() for value in pair]
    return F.try_element_at(F.create_map(*entries), c)


def encode(df: DataFrame, column: str, mapping: Mapping, to: str) -> DataFrame:
    """Value to code through a literal map; unknown values become null."""
    return df.withColumn(to, _lookup(F.col(column), mapping))


def decode(df: DataFrame, column: str, mapping: Mapping, to: str) -> DataFrame:
    """Inverse of :func:`encode` for the same ``mapping``."""
    return df.withColumn(to, _lookup(F.col(column), {code: value for value, code in mapping.items()}))


def map_tokens(df: DataFrame, doc: str, words: str, mapping: DataFrame) -> DataFrame:
    """Rewrite every token through a (token, stem) table of any size; unknown tokens stay.

    See :mod:`wordtable` for the look-up; ``doc`` must be unique. Of several stems of a token the smallest counts.
    """
    stems = word_values(df, words, mapping, "_stems", "token", "stem", [doc])
    mapped = F.array_join(replaced(F.col(words), F.col("_stems")), " ")
    return stems.withColumn("mapped", F.coalesce(mapped, F.lit(""))).drop("_stems")


def word_counts(df: DataFrame, words: str, by: Sequence[str] = ()) -> DataFrame:
    """Occurrences of every word, combined on the map side before the shuffle."""
    return df.select(*by, F.explode(words).alias("word")).groupBy(*by, "word").agg(F.count("*").alias("n"))


def term_stats(df: DataFrame, terms: str) -> DataFrame:
    """(term, tf, df): occurrences and documents of every term of an array column."""
    return list_stats(df, terms)


def rarest_words(counts: DataFrame, k: int) -> DataFrame:
    """The ``k`` words of smallest count, ties by the word in descending order, without gathering them.

    The counts of counts tell at which count the cut falls; only the words of that count are numbered.
    """
    if k <= settings.LOCAL_TABLE_ROWS:
        return counts.orderBy("n", F.desc("word")).limit(k).select("word")
    sizes = counts.groupBy("n").agg(F.count("*").alias("words"))
    upto = running_totals(sizes, [], "n", {"upto": "words"}, descending=False)
    cut = upto.filter(F.col("upto") >= k).orderBy("n").first()
    if cut is None:
        return counts.select("word")
    missing = k - (cut.upto - cut.words)
    ties = ordered_index(counts.filter(F.col("n") == cut.n), "word", "place")
    last = ties.filter(F.col("place") > cut.words - missing).select("word")
    return counts.filter(F.col("n") < cut.n).select("word").unionByName(last)


def drop_rarest(df: DataFrame, doc: str, words: str, k: int) -> DataFrame:
    """Remove the ``k`` rarest words of the whole corpus from every token array.

    Ties are broken by the word in descending order, so the cut is reproducible. ``doc`` must be unique.
    """
    rarest = rarest_words(word_counts(df, words), k).withColumn("rare", F.lit(1))
    marked = word_values(df, words, rarest, "_rare", "word", "rare", [doc])
    return marked.withColumn(words, without_known(F.col(words), F.col("_rare"))).drop("_rare")

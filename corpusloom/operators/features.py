"""Text features: length statistics, TF-IDF, counts, vectors, frequent words."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import settings
from ..functions import text as tx
from ..session import cut_lineage, small_rows, small_table
from . import lexicon, sentiment
from .ranking import ordered_index
from .wordtable import index_weights, term_tf
from .wordtable import text_stats as text_stats_of

STAT_COLUMNS = (
    "char_len", "word_count", "avg_word_len", "sentiment", "term_hits", "positive_hits", "negative_hits",
    "mention_word_hits", "mention_r_hits",
)
VARIANTS: dict[str, tuple[str, ...]] = {
    "tfidf_only": (),
    "tfidf_stats": STAT_COLUMNS[:3],
    "tfidf_stats_vader": STAT_COLUMNS[:4],
    "tfidf_stats_vader_lexicon": STAT_COLUMNS,
}
ABLATION_SETS: dict[str, tuple[str, ...]] = {
    "tfidf_only": (),
    "tfidf_vader": ("sentiment",),
    "tfidf_full": STAT_COLUMNS,
}


def text_stats(df: DataFrame, clean: str) -> DataFrame:
    """Character length, word count and mean word length of a cleaned text."""
    words = F.size(tx.tokens(F.col(clean)))
    letters = F.length(F.replace(F.col(clean), F.lit(" "), F.lit("")))
    return df.withColumns(
        {"char_len": F.length(clean).cast("double"), "word_count": words.cast("double")}
    ).withColumn(
        "avg_word_len",
        F.when(F.col("word_count") > 0, letters / F.col("word_count")).otherwise(F.lit(0.0)),
    )


def stat_features(
    df: DataFrame, clean: str, valence: DataFrame, terms: DataFrame, positive: DataFrame,
    negative: DataFrame, names: DataFrame,
) -> DataFrame:
    """The nine dense columns in their fixed order; one pass over the text, no shuffle."""
    out = sentiment.compound(text_stats(df, clean), clean, valence)
    out = lexicon.term_hits(out, clean, terms, "term_hits")
    out = lexicon.phrase_hits(out, clean, positive, "positive_hits")
    out = lexicon.phrase_hits(out, clean, negative, "negative_hits")
    return lexicon.mention_hits(out, clean, names)


def add_dense(df: DataFrame, clean: str, dense: Sequence[str], lexicons=None) -> DataFrame:
    """Adds the dense columns; those beyond the text statistics need the lexicons."""
    if not dense:
        return df
    if lexicons is None:
        if not set(dense) <= set(STAT_COLUMNS[:3]):
            raise ValueError("sentiment and lexicon columns need lexicons")
        return text_stats(df, clean)
    return stat_features(df, clean, lexicons.valence, lexicons.terms, lexicons.positive, lexicons.negative, lexicons.names)


def _terms(clean: Column, ngrams: tuple[int, int], min_chars: int = 2) -> Column:
    words = F.filter(F.split(clean, " "), lambda t: F.length(t) >= min_chars)
    return tx.ngram_range(words, *ngrams)


def document_terms(
    df: DataFrame, clean: str, ngrams: tuple[int, int] = settings.TFIDF_NGRAMS, to: str = "terms"
) -> DataFrame:
    """Adds ARRAY<STRUCT<term, tf>> of word n-grams over words of two letters or more."""
    return df.withColumn(to, tx.term_counts(_terms(F.col(clean), ngrams)))


def term_pairs(df: DataFrame, doc: str, clean: str, ngrams: tuple[int, int] = settings.TFIDF_NGRAMS) -> DataFrame:
    """(doc, term, tf) rows, counted inside the row."""
    return df.select(doc, F.inline(term_tf(F.col(clean), ngrams)))


def vocabulary(
    df: DataFrame,
    clean: str,
    max_terms: int | None = settings.TFIDF_MAX_TERMS,
    ngrams: tuple[int, int] = settings.TFIDF_NGRAMS,
    min_df: int = settings.TFIDF_MIN_DF,
    max_df: float = settings.TFIDF_MAX_DF,
) -> DataFrame:
    """(term, index, df, tf, idf): most frequent terms within the document limits.

    One pass counts per batch, so the shuffle carries one partial count per term and task. Ties at the cap
    go to the smaller term; indexes follow the alphabet. idf = ln((1 + n) / (1 + df)) + 1.
    """
    return rank_terms(cut_lineage(text_stats_of(df, clean, ngrams)), max_terms, min_df, max_df)


def rank_terms(stats: DataFrame, max_terms: int | None, min_df: int, max_df: float) -> DataFrame:
    """The vocabulary from (term, tf, df) rows, whose null term carries the number of documents."""
    n = stats.filter(F.col("term").isNull()).agg(F.coalesce(F.sum("df"), F.lit(0))).first()[0]
    kept = stats.filter(F.col("term").isNotNull() & (F.col("df") >= min_df) & (F.col("df") <= F.lit(max_df) * n))
    # At most max_terms rows from here on; without a cap the index is range partitioned.
    if max_terms is None:
        indexed = ordered_index(kept, "term", "index", start=0)
    else:
        kept = kept.orderBy(F.desc("tf"), "term").limit(max_terms)
        indexed = kept.withColumn("index", F.row_number().over(W.partitionBy(F.lit(0)).orderBy("term")) - 1)
    idf = F.log((F.lit(1.0) + n) / (F.lit(1.0) + F.col("df"))) + 1.0
    return indexed.select("term", "index", "df", "tf", idf.alias("idf"))


def tfidf_weights(
    df: DataFrame, doc: str, clean: str, vocab: DataFrame, ngrams: tuple[int, int] = settings.TFIDF_NGRAMS
) -> DataFrame:
    """(doc, index, term, weight): (1 + ln tf) * idf, each document at unit length; no shuffle."""
    long = df.select(doc, F.inline(index_weights(df, F.col(clean), vocab, ngrams)))
    terms = small_table(vocab.select(F.col("index").alias("i"), "term")).frame
    return long.join(terms, "i").select(doc, F.col("i").alias("index"), "term", F.col("w").alias("weight"))


def _sparse(size: int):
    """Index and value arrays to sparse vectors, as the vector type's own columns."""

    @F.pandas_udf(VectorUDT())
    def pack(indices: pd.Series, values: pd.Series) -> pd.DataFrame:
        n = len(indices)
        return pd.DataFrame(
            {
                "type": np.zeros(n, dtype=np.int8),
                "size": np.full(n, size, dtype=np.int32),
                "indices": indices.to_numpy(),
                "values": values.to_numpy(),
            }
        )

    return pack


def tfidf_vectors(
    df: DataFrame,
    doc: str,
    clean: str,
    vocab: DataFrame,
    size: int,
    ngrams: tuple[int, int] = settings.TFIDF_NGRAMS,
    to: str = "tfidf",
) -> DataFrame:
    """Adds the sparse TF-IDF vector of each document, computed inside the row."""
    return pack_vectors(df.withColumn("_e", index_weights(df, F.col(clean), vocab, ngrams)), size, to)


def pack_vectors(weighted: DataFrame, size: int, to: str = "tfidf") -> DataFrame:
    """Sparse vectors from _e: ARRAY<STRUCT<i, w>> in the order of i, each at unit length."""
    return weighted.withColumn(to, _sparse(size)(F.col("_e.i"), F.col("_e.w"))).drop("_e")


def count_terms(
    df: DataFrame, doc: str, clean: str, max_df: float = 1.0, max_terms: int | None = None, ngrams: tuple[int, int] = (1, 2)
) -> DataFrame:
    """Count vectors in long form: (doc, index, term, tf); all terms unless ``max_terms`` caps them.

    The terms that most documents hold are numbered by a broadcast of at most ``settings.FREQUENT_WORDS``
    rows, so that the join on the others has no hot key.
    """
    vocab = cut_lineage(vocabulary(df, clean, max_terms, ngrams, min_df=1, max_df=max_df))
    frequent = small_table(vocab.orderBy(F.desc("df"), "term").limit(settings.FREQUENT_WORDS).select("term", "index")).frame
    numbered = term_pairs(df, doc, clean, ngrams).join(frequent, "term", "left")
    known = numbered.filter(F.col("index").isNotNull())
    rest = numbered.filter(F.col("index").isNull()).drop("index").join(vocab.select("term", "index"), "term")
    return known.unionByName(rest).select(doc, "index", "term", "tf")


def attach_vectors(df: DataFrame, vectors: DataFrame, on: str, embedding: str = "embedding", to: str = "vector") -> DataFrame:
    """Join precomputed sentence vectors as an ML vector column."""
    return df.join(vectors.select(on, array_to_vector(F.col(embedding).cast("array<double>")).alias(to)), on)


def vector_moments(vectors: DataFrame, embedding: str = "embedding") -> DataFrame:
    """(position, mean, std) of every dimension; population standard deviation."""
    long = vectors.select(F.posexplode(embedding).alias("position", "value"))
    value = F.col("value").cast("double")
    return long.groupBy("position").agg(F.avg(value).alias("mean"), F.stddev_pop(value).alias("std"))


def standardise(vectors: DataFrame, embedding: str = "embedding", to: str = "scaled") -> DataFrame:
    """Centre and scale an array column; a constant dimension is only centred.

    Moments have one row per dimension, so they become constant arrays.
    """
    moments = sorted(small_rows(vector_moments(vectors, embedding)), key=lambda r: r.position)
    means = F.array(*[F.lit(r["mean"]) for r in moments])
    scales = F.array(*[F.lit(r["std"] or 1.0) for r in moments])
    centred = F.zip_with(F.col(embedding), means, lambda x, m: x.cast("double") - m)
    return vectors.withColumn(to, F.zip_with(centred, scales, lambda x, s: x / s))


def top_words(df: DataFrame, words: str, by: Sequence[str] = (), n: int = 80) -> DataFrame:
    """The ``n`` most frequent words, overall or per class; ties by word.

    Classes are ranked over their word counts with a per-task limit first (Spark's
    window group limit), so a large vocabulary is cut before it is shuffled.
    """
    counts = df.select(*by, F.explode(words).alias("word")).groupBy(*by, "word").agg(F.count("*").alias("n"))
    if not by:
        return counts.orderBy(F.desc("n"), "word").limit(n)
    order = W.partitionBy(*by).orderBy(F.desc("n"), "word")
    return counts.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= n)

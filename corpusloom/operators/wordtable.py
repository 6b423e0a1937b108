"""Token arrays against tables of words, and counts of their words, in Arrow batches.

A table below ``settings.LOOKUP_BYTES`` is broadcast after that check and looked up for whole batches at once. A larger table is
joined, but only for rare words: the words that most documents hold come from a hash sample of the documents, their
entries (at most ``settings.FREQUENT_WORDS``) are broadcast, and every document sends on only its distinct other words. A
word in a third of all tokens is therefore handled where it stands, by all tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from .. import settings

_SAMPLE_ROWS = 50_000


def flat_rows(lists: pa.ListArray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(all tokens, the row of each, tokens per row); a null list has none."""
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    return lists.flatten(), np.repeat(np.arange(len(lists)), sizes), sizes


def as_lists(values: pa.Array, sizes: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32)), values)


def _found(flat: pa.Array, keys: pa.Array) -> pa.Array:
    """The place of each token among the keys, which are unique; null for unknown ones.

    The hash table is built over the shorter side: one over a large table of keys, again for every batch, took most of a worker's memory.
    """
    if len(keys) <= len(flat):
        return pc.index_in(flat, value_set=keys.cast(flat.type))
    coded = pc.dictionary_encode(flat)
    place = pc.index_in(keys, value_set=coded.dictionary.cast(keys.type))
    at = np.flatnonzero(pc.is_valid(place).to_numpy(zero_copy_only=False))
    of_word = np.full(len(coded.dictionary), -1, dtype=np.int32)
    of_word[place.take(pa.array(at)).to_numpy(zero_copy_only=False)] = at
    of_word = pa.array(of_word, mask=of_word < 0)
    return of_word.take(coded.indices)


def in_parts(work: Callable[[pa.Array], pa.Array], rows: pa.Array) -> pa.Array:
    """``work`` on parts of ``settings.BATCH_TEXTS`` rows, put together again."""
    if len(rows) <= settings.BATCH_TEXTS:
        return work(rows)
    return pa.concat_arrays([work(rows.slice(start, settings.BATCH_TEXTS)) for start in range(0, len(rows), settings.BATCH_TEXTS)])


def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch in parts of ``settings.BATCH_TEXTS`` rows: n-grams take many times the bytes of their texts."""
    for start in range(0, batch.num_rows, settings.BATCH_TEXTS):
        yield batch.slice(start, settings.BATCH_TEXTS)


def _column_array(table: pa.Table, name: str) -> pa.Array:
    return pa.concat_arrays(table[name].chunks) if table.num_rows else pa.array([], table.schema.field(name).type)


def _entries(table: DataFrame, key: str, value: str) -> DataFrame:
    """(word, value), one row per word; of several values the smallest counts."""
    picked = table.select(F.col(key).alias("word"), F.col(value).alias("value")).filter(F.col("word").isNotNull())
    return picked.groupBy("word").agg(F.min("value").alias("value"))


def _within_bound(entries: DataFrame) -> bool:
    value = F.octet_length("value") if isinstance(entries.schema["value"].dataType, StringType) else F.lit(8)
    size = entries.agg(F.sum(F.octet_length("word") + F.coalesce(value, F.lit(0)) + 8)).first()[0] or 0
    return size <= settings.LOOKUP_BYTES


def word_values(
    df: DataFrame, words: str, table: DataFrame, to: str, key: str = "word", value: str = "value", doc: Sequence[str] = ()
) -> DataFrame:
    """Adds ``to``: the table's value of every token of ``words``, null for unknown ones.

    ``doc`` names the columns of a unique row key; only a table beyond ``settings.LOOKUP_BYTES`` needs it.
    """
    entries = _entries(table, key, value)
    result = ArrayType(entries.schema["value"].dataType)
    if _within_bound(entries):
        return df.withColumn(to, _direct(df, entries, result)(F.col(words)))
    if not doc:
        raise ValueError("a table beyond settings.LOOKUP_BYTES needs the row key")
    return _split(df, words, entries, result, to, list(doc))


def _direct(df: DataFrame, entries: DataFrame, result: ArrayType):
    held = entries.toArrow()
    shared = df.sparkSession.sparkContext.broadcast((_column_array(held, "word"), _column_array(held, "value")))

    @F.arrow_udf(result)
    def look(words: pa.Array) -> pa.Array:
        keys, values = shared.value
        flat, _, sizes = flat_rows(words)
        return as_lists(values.take(_found(flat, keys)), sizes)

    return look


def frequent_words(df: DataFrame, words: str, doc: Sequence[str], most: int) -> DataFrame:
    """The words that most documents of a hash sample hold."""
    share = max(1, df.count() // _SAMPLE_ROWS)
    sample = df.filter(F.pmod(F.xxhash64(*doc), F.lit(share)) == 0)
    held = sample.select(F.explode(F.array_distinct(words)).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    return held.orderBy(F.desc("n"), "word").limit(most).select("word")


def _split(df: DataFrame, words: str, entries: DataFrame, result: ArrayType, to: str, doc: list[str]) -> DataFrame:
    frequent = frequent_words(df, words, doc, settings.FREQUENT_WORDS)
    held = frequent.join(entries, "word", "left").toArrow()
    shared = df.sparkSession.sparkContext.broadcast((_column_array(held, "word"), _column_array(held, "value")))

    @F.arrow_udf("array<string>")
    def others(tokens: pa.Array) -> pa.Array:
        flat, rows, sizes = flat_rows(tokens)
        rare = pc.is_null(_found(flat, shared.value[0]))
        kept = np.bincount(rows[rare.to_numpy(zero_copy_only=False)], minlength=len(sizes))
        return as_lists(flat.filter(rare), kept)

    @F.arrow_udf(result)
    def look(tokens: pa.Array, rare_words: pa.Array, rare_values: pa.Array) -> pa.Array:
        keys, values = shared.value
        flat, rows, sizes = flat_rows(tokens)
        out = values.take(_found(flat, keys)).to_pylist()
        known: list[dict] = [dict(zip(w or [], v or [])) for w, v in zip(rare_words.to_pylist(), rare_values.to_pylist())]
        for at, (word, row) in enumerate(zip(flat.to_pylist(), rows.tolist())):
            if out[at] is None:
                out[at] = known[row].get(word)
        return as_lists(pa.array(out, values.type), sizes)

    rare = df.select(*doc, F.explode(F.array_distinct(others(F.col(words)))).alias("word")).join(entries, "word")
    lists = rare.groupBy(*doc).agg(F.collect_list(F.struct("word", "value")).alias("_rare_pairs"))
    joined = df.join(lists, doc, "left")
    return joined.withColumn(to, look(F.col(words), F.col("_rare_pairs.word"), F.col("_rare_pairs.value"))).drop("_rare_pairs")


def replaced(words: Column, values: Column) -> Column:
    """Tokens with their value in place, where they have one."""

    @F.arrow_udf("array<string>")
    def replace(tokens: pa.Array, new: pa.Array) -> pa.Array:
        flat, _, sizes = flat_rows(tokens)
        return as_lists(pc.coalesce(new.flatten(), flat), sizes)

    return replace(words, values)


def without_known(words: Column, values: Column) -> Column:
    """Tokens that have no value."""

    @F.arrow_udf("array<string>")
    def drop(tokens: pa.Array, known: pa.Array) -> pa.Array:
        flat, rows, sizes = flat_rows(tokens)
        kept = pc.is_null(known.flatten())
        return as_lists(flat.filter(kept), np.bincount(rows[kept.to_numpy(zero_copy_only=False)], minlength=len(sizes)))

    return drop(words, values)


def split_words(clean: pa.Array, least: int) -> tuple[pa.Array, np.ndarray, int]:
    """(words of ``least`` letters or more, the row of each, number of rows) of cleaned texts."""
    flat, rows, sizes = flat_rows(pc.split_pattern(pc.fill_null(clean, ""), " "))
    kept = pc.greater_equal(pc.utf8_length(flat), least)
    return flat.filter(kept), rows[kept.to_numpy(zero_copy_only=False)], len(sizes)


def grams(words: pa.Array, rows: np.ndarray, ngrams: tuple[int, int]) -> tuple[pa.Array, np.ndarray]:
    """All n-grams of the words of each row, and the row of each."""
    parts, owners, joined = [], [], words
    for size in range(1, ngrams[1] + 1):
        if size > 1:
            count = max(len(words) - size + 1, 0)
            joined = pc.binary_join_element_wise(joined.slice(0, count), words.slice(size - 1, count), " ")
            inside = rows[:count] == rows[size - 1 : size - 1 + count]
        else:
            inside = np.ones(len(words), dtype=bool)
        if size >= ngrams[0]:
            parts.append(joined.filter(pa.array(inside)))
            owners.append(rows[: len(inside)][inside])
    return pa.concat_arrays(parts), np.concatenate(owners)


def pair_counts(rows: np.ndarray, codes: np.ndarray, n_codes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, code, occurrences), ordered by row and code."""
    pairs, n = np.unique(rows * n_codes + codes, return_counts=True)
    return pairs // n_codes, pairs % n_codes, n


_STATS = "term string, tf long, df long"


def batch_stats(terms: pa.Array, rows: np.ndarray, n_rows: int) -> pa.RecordBatch:
    """tf and df of a batch's terms; the null term carries the number of rows."""
    coded = pc.dictionary_encode(terms)
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    n_codes = len(coded.dictionary)
    _, code, _ = pair_counts(rows, codes, max(n_codes, 1))
    tf, df = np.bincount(codes, minlength=n_codes), np.bincount(code, minlength=n_codes)
    names = pa.concat_arrays([coded.dictionary.cast(pa.string()), pa.nulls(1, pa.string())])
    return pa.RecordBatch.from_arrays(
        [names, pa.array(np.r_[tf, 0], pa.int64()), pa.array(np.r_[df, n_rows], pa.int64())], names=["term", "tf", "df"]
    )


def list_stats(df: DataFrame, words: str) -> DataFrame:
    """(term, tf, df) of a token array column; counted per batch, then per task, then over all."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole)):
            flat, rows, sizes = flat_rows(batch.column(0))
            known = pc.is_valid(flat)
            yield batch_stats(flat.filter(known), rows[known.to_numpy(zero_copy_only=False)], len(sizes))

    return _summed(df.select(words).mapInArrow(count, _STATS)).filter(F.col("term").isNotNull())


def text_stats(df: DataFrame, clean: str, ngrams: tuple[int, int], least: int = 2) -> DataFrame:
    """(term, tf, df) of the word n-grams of cleaned texts; the null term has the number of texts as df."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole)):
            words, rows, n_rows = split_words(batch.column(0), least)
            yield batch_stats(*grams(words, rows, ngrams), n_rows)

    return _summed(df.select(clean).mapInArrow(count, _STATS))


def _summed(parts: DataFrame) -> DataFrame:
    return parts.groupBy("term").agg(F.sum("tf").alias("tf"), F.sum("df").alias("df"))


def term_tf(clean: Column, ngrams: tuple[int, int], least: int = 2) -> Column:
    """ARRAY<STRUCT<term, tf>> of the n-grams of each text."""

    def part(texts: pa.Array) -> pa.Array:
        words, rows, n_rows = split_words(texts, least)
        terms, owner = grams(words, rows, ngrams)
        coded = pc.dictionary_encode(terms)
        row, code, n = pair_counts(owner, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), max(len(coded.dictionary), 1))
        pairs = pa.StructArray.from_arrays([coded.dictionary.cast(pa.string()).take(pa.array(code)), pa.array(n, pa.int64())], ["term", "tf"])
        return as_lists(pairs, np.bincount(row, minlength=n_rows))

    @F.arrow_udf("array<struct<term: string, tf: long>>")
    def count(texts: pa.Array) -> pa.Array:
        return in_parts(part, texts)

    return count(clean)


def _held_indexes(df: DataFrame, vocab: DataFrame, value: str):
    """A broadcast of the vocabulary's terms, their indexes and ``value``; it must stay below ``settings.LOOKUP_BYTES``."""
    entries = _entries(vocab, "term", "index")
    if not _within_bound(entries):
        raise ValueError("vocabulary beyond settings.LOOKUP_BYTES")
    held = vocab.select("term", "index", F.col(value).cast("double").alias("value")).filter(F.col("term").isNotNull()).toArrow()
    indexes = _column_array(held, "index").to_numpy(zero_copy_only=False).astype(np.int64)
    by_index = np.zeros(int(indexes.max(initial=0)) + 1)
    by_index[indexes] = _column_array(held, "value").to_numpy(zero_copy_only=False)
    return df.sparkSession.sparkContext.broadcast((_column_array(held, "term"), indexes, by_index))


def _index_counts(
    texts: pa.Array, keys: pa.Array, numbers: np.ndarray, ngrams: tuple[int, int], least: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(row, index, occurrences) of the known terms, ordered by row and index, and the number of rows."""
    words, rows, n_rows = split_words(texts, least)
    terms, owner = grams(words, rows, ngrams)
    found = _found(terms, keys)
    known = pc.is_valid(found).to_numpy(zero_copy_only=False)
    codes = numbers[pc.fill_null(found, 0).to_numpy(zero_copy_only=False)[known]] if len(numbers) else np.empty(0, dtype=np.int64)
    return *pair_counts(owner[known], codes, int(numbers.max(initial=0)) + 1), n_rows


def index_tf(df: DataFrame, clean: Column, vocab: DataFrame, ngrams: tuple[int, int], least: int = 2) -> Column:
    """ARRAY<STRUCT<index, tf>> of the vocabulary's terms in each text, by index.

    ``vocab`` has (term, index) and must stay below ``settings.LOOKUP_BYTES``.
    """
    shared = _held_indexes(df, vocab, "index")

    def part(texts: pa.Array) -> pa.Array:
        row, code, n, n_rows = _index_counts(texts, *shared.value[:2], ngrams, least)
        pairs = pa.StructArray.from_arrays([pa.array(code, pa.int32()), pa.array(n, pa.int64())], ["index", "tf"])
        return as_lists(pairs, np.bincount(row, minlength=n_rows))

    @F.arrow_udf("array<struct<index: int, tf: long>>")
    def count(texts: pa.Array) -> pa.Array:
        return in_parts(part, texts)

    return count(clean)


_WEIGHTS = "array<struct<i: int, w: double>>"


def _unit_weights(row: np.ndarray, index: np.ndarray, tf: np.ndarray, idf: np.ndarray, n_rows: int) -> pa.Array:
    """(1 + ln tf) * idf, each row at unit length; entries are ordered by row."""
    weight = (np.log(tf) + 1.0) * idf
    length = np.sqrt(np.bincount(row, weight * weight, n_rows))
    pairs = pa.StructArray.from_arrays([pa.array(index, pa.int32()), pa.array(weight / length[row], pa.float64())], ["i", "w"])
    return as_lists(pairs, np.bincount(row, minlength=n_rows))


def index_weights(df: DataFrame, clean: Column, vocab: DataFrame, ngrams: tuple[int, int], least: int = 2) -> Column:
    """ARRAY<STRUCT<i, w>> by index: TF-IDF weights of each text at unit length.

    ``vocab`` has (term, index, idf) and must stay below ``settings.LOOKUP_BYTES``. Lengths are taken per batch: as a nested
    expression the sum of squares was evaluated again for every entry of its row.
    """
    shared = _held_indexes(df, vocab, "idf")

    def part(texts: pa.Array) -> pa.Array:
        keys, numbers, idf = shared.value
        row, code, n, n_rows = _index_counts(texts, keys, numbers, ngrams, least)
        return _unit_weights(row, code, n, idf[code], n_rows)

    @F.arrow_udf(_WEIGHTS)
    def weigh(texts: pa.Array) -> pa.Array:
        return in_parts(part, texts)

    return weigh(clean)


def reindexed_weights(df: DataFrame, counts: Column, indexes: Sequence[int], idfs: Sequence[float]) -> Column:
    """ARRAY<STRUCT<i, w>> from ARRAY<STRUCT<index, tf>>, under a map from its indexes to others (-1: left out) and their idf."""
    shared = df.sparkSession.sparkContext.broadcast((np.array(indexes, dtype=np.int64), np.array(idfs, dtype=float)))

    @F.arrow_udf(_WEIGHTS)
    def weigh(entries: pa.Array) -> pa.Array:
        to, idf = shared.value
        flat, rows, sizes = flat_rows(entries)
        old, tf = (c.to_numpy(zero_copy_only=False) for c in flat.flatten())
        kept = np.flatnonzero(to[old] >= 0)
        kept = kept[np.lexsort((to[old[kept]], rows[kept]))]
        return _unit_weights(rows[kept], to[old[kept]], tf[kept], idf[old[kept]], len(sizes))

    return weigh(counts)

"""Text expressions: cleaning, language share, fingerprints, shingles, tokens."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import settings

# (?U) gives \s and \S their Unicode meaning; without it a word after a no-break
# space would be taken as part of the URL.
_URL = r"(?U)https?://\S+|www\.\S+"
_SPACES = r"(?U)\s+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body reads it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _text(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def clean_text(c: Column) -> Column:
    """Lower case, URLs and everything but a-z become single spaces, ends trimmed."""
    lowered = F.lower(_text(c))
    # The containment test is far cheaper than the pattern, which few texts need.
    has_url = lowered.contains("://") | lowered.contains("www.")
    without_urls = F.when(has_url, F.regexp_replace(lowered, _URL, " ")).otherwise(lowered)
    return F.trim(F.regexp_replace(without_urls, "[^a-z]+", " "))


def letter_counts(c: Column, sample: int = 200) -> tuple[Column, Column]:
    """(letters, ASCII letters) among the first ``sample`` characters."""
    chunk = F.substring(_text(c), 1, sample)
    letters = F.length(F.regexp_replace(chunk, r"[^\p{L}]+", ""))
    latin = F.length(F.regexp_replace(F.lower(chunk), "[^a-z]+", ""))
    return letters, latin


def looks_english(c: Column, sample: int = 200, ratio: float = settings.LATIN_RATIO) -> Column:
    """True when ASCII letters make up ``ratio`` of the letters, or there are none."""
    letters, latin = letter_counts(c, sample)
    return F.when(letters == 0, F.lit(True)).otherwise(latin / letters >= F.lit(ratio))


def normalized_text(c: Column) -> Column:
    """Lower case with every run of whitespace as one space, ends trimmed."""
    return F.trim(F.regexp_replace(F.lower(_text(c)), _SPACES, " "))


def fingerprint(c: Column) -> Column:
    """SHA-256 of the normalised text, in hex."""
    return F.sha2(normalized_text(c), 256)


def tokens(c: Column) -> Column:
    """Words of a cleaned text; the empty text has none."""
    return F.filter(F.split(c, " "), lambda t: t != "")


def ngrams(words: Column, n: int) -> Column:
    """Word n-grams of a token array in order; arrays shorter than ``n`` have none."""
    if n == 1:
        return words

    def build(w: Column) -> Column:
        def join(first: Column, at: Column) -> Column:
            parts = [first]
            for step in range(1, n):
                parts += [F.lit(" "), F.get(w, at + step)]
            return F.concat(*parts)

        starts = F.slice(w, F.lit(1), F.greatest(F.size(w) - (n - 1), F.lit(0)))
        return F.transform(starts, join)

    return let(words, build)


def ngram_range(words: Column, low: int, high: int) -> Column:
    """All n-grams for n from ``low`` to ``high`` in one array."""
    if low == high:
        return ngrams(words, low)
    return let(words, lambda w: F.concat(*[ngrams(w, n) for n in range(low, high + 1)]))


def shingles(c: Column, size: int = 3) -> Column:
    """Set of word n-grams of the normalised text; a shorter text is its own shingle."""

    def build(words: Column) -> Column:
        return (
            F.when(F.size(words) == 0, words)
            .when(F.size(words) < size, F.array(F.array_join(words, " ")))
            .otherwise(F.array_distinct(ngrams(words, size)))
        )

    return let(F.filter(F.split(normalized_text(c), " "), lambda t: t != ""), build)


def coalesce_text(columns: Sequence[Column]) -> Column:
    """First non-null text of several columns, in order."""
    return F.coalesce(*[c.cast("string") for c in columns])


def clean_markup(c: Column, stopwords: Sequence[str] = ()) -> Column:
    """Exploration cleaner for marked-up text.

    Punctuation goes first, so bracket, tag and URL rules only see what is left of
    them; the order is part of the result.
    """
    steps = (
        (r"(?U)[^\w\s]", ""),
        ("\n", ""),
        (r"(?U)\d", ""),
        (r"\[.*?\]", ""),
        (r"(?U)https?://\S+|www\.\S+", ""),
        (r"<.*?>+", ""),
        (r"(?U)\w*\d\w*", ""),
        (_SPACES, " "),
        (r"[\p{So}\x{FE0F}\x{200D}]", ""),
    )
    out = F.lower(_text(c))
    for pattern, replacement in steps:
        out = F.regexp_replace(out, pattern, replacement)
    stop = list(stopwords)
    kept = F.filter(F.split(F.trim(out), " "), lambda t: (t != "") & ~t.isin(stop) if stop else t != "")
    return F.array_join(kept, " ")


def clean_social(c: Column) -> Column:
    """Exploration cleaner for posts: lower case, URLs, markdown links, handles, punctuation."""
    out = F.lower(_text(c))
    for pattern in (r"(?U)https?://\S+", r"\[.*?\]\(.*?\)", r"(?U)@\w+", r"(?U)[^\w\s]"):
        out = F.regexp_replace(out, pattern, "")
    return F.regexp_replace(out, r"(?U)^\s+|\s+$", "")


def sentence_count(c: Column) -> Column:
    """Runs of sentence marks, at least one: an approximation of a sentence splitter."""
    return F.greatest(F.regexp_count(_text(c), F.lit("[.!?]+")), F.lit(1))


def input_gate(c: Column) -> Column:
    """Admission of a single text: empty, too_short, not_english, short_warning or ok."""
    text = F.trim(_text(c))
    size = F.length(text)
    return (
        F.when(size == 0, "empty")
        .when(size < settings.GATE_MIN_CHARS, "too_short")
        .when(~looks_english(text), "not_english")
        .when(size < settings.SOFT_CHARS, "short_warning")
        .otherwise("ok")
    )


def term_counts(terms: Column) -> Column:
    """Counts of an unordered term array: ARRAY<STRUCT<term, tf>>, sorted by term.

    Run lengths of the sorted array, all inside the row: (document, term) pairs never
    have to be shuffled to be counted.
    """

    def starts_of(ordered: Column) -> Column:
        shifted = F.slice(ordered, F.lit(1), F.greatest(F.size(ordered) - 1, F.lit(0)))
        before = F.concat(F.array(F.lit(None).cast("string")), shifted)
        fresh = F.zip_with(
            ordered, before, lambda term, last: F.when(~term.eqNullSafe(last), term)
        )
        starts = F.filter(
            F.transform(fresh, lambda term, at: F.struct(term.alias("term"), at.alias("at"))),
            lambda run: run["term"].isNotNull(),
        )
        return let(starts, lambda runs: close(runs, F.size(ordered)))

    def close(starts: Column, size: Column) -> Column:
        later = F.slice(starts, F.lit(2), F.greatest(F.size(starts) - 1, F.lit(0)))
        ends = F.concat(F.transform(later, lambda run: run["at"]), F.array(size))
        return F.zip_with(
            starts, ends, lambda run, end: F.struct(run["term"].alias("term"), (end - run["at"]).alias("tf"))
        )

    counted = let(F.sort_array(terms), starts_of)
    return F.filter(counted, lambda run: run["term"].isNotNull())

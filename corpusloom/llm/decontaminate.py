"""Benchmark decontamination by a distributed positional inverted index.

Only DataFrame functions are used. Documents become word arrays once (a written table). Then:

1. the corpus frequency of every benchmark word is counted;
2. each window of a benchmark item is looked up by its two rarest words, and only postings (row,
   position) of these are read;
3. postings are offset by the word's place in the item, and lists that agree in row and offset are
   intersected: windows for which both rare words stand at the right distance remain;
4. the rest of the window is compared in the document's own words, which makes matches exact;
   these postings are stored.

``phrase_matches`` returns the occurrences themselves; ``proximity_matches`` those where an
item's rare words merely stand close together. A common word is only ever a posting list when
a window has nothing rarer, and rows of such lists are ordinary rows: nothing is gathered by word.

Defined results: null and empty texts have no words and no hits; an item without words has no
windows; rows with a null item id take no part; items repeated under one id count once;
repeated documents stay rows (rows get a number of their own); very long texts are searched
whole. Only the named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, cut_lineage, read_table

WINDOW = 10
BROADCAST_WINDOWS = 200_000
_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Words of digits, letters and everything beyond ASCII; A-Z lower-cased."""
    value = F.coalesce(text, F.lit(""))
    plain = F.octet_length(value) == F.length(value)  # ASCII: the fast lower() agrees
    lowered = F.when(plain, F.lower(value)).otherwise(ascii_lower(value))
    return F.array_remove(F.split(lowered, _SEPARATORS), "")


def index_documents(docs: DataFrame, key: str, text: str) -> DataFrame:
    """row, key, n_words, words of every document, written once."""
    cut = docs.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("key"), words(F.col(text)).alias("words"))
    return cut_lineage(cut.withColumn("n_words", F.size("words").cast("long")))


def _windows(items: DataFrame, window: int) -> DataFrame:
    """item, start, size and the item's words for every window."""
    n = F.size("words")
    size = F.least(F.lit(window), n)
    return items.filter(n > 0).select(
        "item", "words", size.alias("size"), F.explode(F.sequence(F.lit(0), n - size)).alias("start")
    )


def _plans(items: DataFrame, indexed: DataFrame, window: int) -> DataFrame:
    """Per item its words, window size, and the windows (start, first, second) that can occur at all.

    ``first`` and ``second`` are the places of the two rarest words of the window.
    """
    terms = cut_lineage(items.select(F.explode("words").alias("term")).distinct())
    seen = indexed.select(F.explode("words").alias("term")).join(terms, "term").groupBy("term").agg(F.count("*").alias("n"))
    seen = cut_lineage(seen)
    placed = _windows(items, window).select(
        "item", "start", "size", F.posexplode(F.slice("words", F.col("start") + 1, F.col("size"))).alias("at", "term")
    )
    rare = (
        placed.join(seen, "term", "left")
        .groupBy("item", "start", "size")
        .agg(
            F.count("n").alias("known"),
            F.array_sort(F.collect_list(F.struct("n", (F.col("start") + F.col("at")).alias("p")))).alias("order"),
        )
        .filter(F.col("known") == F.col("size"))
    )
    second = F.coalesce(F.get("order", F.lit(1))["p"], F.col("order")[0]["p"])
    chosen = F.struct("start", F.col("order")[0]["p"].alias("first"), second.alias("second"))
    kept = rare.groupBy("item", "size").agg(F.collect_list(chosen).alias("windows"))
    return cut_lineage(kept.join(items, "item"))


def _aligned(plans: DataFrame, indexed: DataFrame) -> DataFrame:
    """Offset-adjusted postings: row, item, shift (document place minus item place), item places found."""
    places = plans.select("item", "words", F.explode("windows").alias("w"))
    places = places.select("item", "words", F.explode(F.array("w.first", "w.second")).alias("p")).distinct()
    places = cut_lineage(places.select("item", "p", F.get("words", F.col("p")).alias("term")))
    terms = cut_lineage(places.select("term").distinct())
    postings = indexed.select("row", F.posexplode("words").alias("at", "term")).join(terms, "term")
    postings = cut_lineage(postings.select("term", "row", "at"))
    return (
        postings.join(places, "term")
        .groupBy("row", "item", (F.col("at") - F.col("p")).alias("shift"))
        .agg(F.collect_set("p").alias("found"))
    )


def phrase_matches(
    indexed: DataFrame, items: DataFrame, window: int = WINDOW, most_windows: int = BROADCAST_WINDOWS
) -> DataFrame:
    """row, item, size and ``places``: where in the document's words the item's windows start.

    Up to ``most_windows`` windows that can occur, these are broadcast (their number is checked)
    and lists are intersected while postings are read, so that no text is shuffled. Beyond, posting
    lists are joined. Both ways find the same.
    """
    plans = _plans(items, indexed, window)
    possible = plans.agg(F.coalesce(F.sum(F.size("windows")), F.lit(0))).first()[0]
    if possible <= most_windows:
        return _read_in_place(indexed, plans)
    return _join_lists(indexed, plans)


def _read_in_place(indexed: DataFrame, plans: DataFrame) -> DataFrame:
    """Each posting of a rarest word is met by its windows; the second word's place is looked up by offset.

    Explode, join and both comparisons are one generated loop over the document's words.
    """
    wanted = plans.select("item", "size", "words", F.explode("windows").alias("w")).select(
        "item", "size", F.get("words", F.col("w.first")).alias("term"), (F.col("w.first") - F.col("w.start")).alias("back"),
        (F.col("w.second") - F.col("w.first")).alias("gap"), F.get("words", F.col("w.second")).alias("second"),
        F.slice("words", F.col("w.start") + 1, F.col("size")).alias("whole"),
    )
    postings = indexed.select("row", "words", F.posexplode("words").alias("at", "term"))
    place = F.col("at") - F.col("back")
    aligned = postings.join(F.broadcast(wanted), "term").filter(
        (place >= 0) & (F.get("words", F.col("at") + F.col("gap")) == F.col("second"))
    )
    exact = aligned.filter(F.slice("words", place + 1, F.col("size")) == F.col("whole"))
    kept = cut_lineage(exact.select("row", "item", "size", place.alias("place")))
    return kept.groupBy("row", "item", "size").agg(F.collect_set("place").alias("places"))


def _join_lists(indexed: DataFrame, plans: DataFrame) -> DataFrame:
    """Posting lists of the rare words joined by item and offset, then compared in the words of the few rows left."""
    both = F.filter(
        "windows", lambda w: F.array_contains("found", w["first"]) & F.array_contains("found", w["second"])
    )
    hopeful = _aligned(plans, indexed).join(plans, "item").withColumn("windows", both).filter(F.size("windows") > 0)
    per_row = cut_lineage(
        hopeful.groupBy("row").agg(
            F.collect_list(
                F.struct("item", "shift", "size", "words", F.transform("windows", lambda w: w["start"]).alias("starts"))
            ).alias("hopes")
        )
    )
    texts = indexed.select("row", F.col("words").alias("own"), "n_words")

    def occurring(h: Column) -> Column:
        inside = lambda s: (h["shift"] + s >= 0) & (h["shift"] + s + h["size"] <= F.col("n_words"))
        same = lambda s: F.slice("own", h["shift"] + s + 1, h["size"]) == F.slice(h["words"], s + 1, h["size"])
        starts = F.filter(h["starts"], lambda s: F.when(inside(s), same(s)).otherwise(False))
        return F.struct(
            h["item"].alias("item"), h["size"].alias("size"), F.transform(starts, lambda s: h["shift"] + s).alias("places")
        )

    checked = per_row.join(texts, "row").select("row", F.transform("hopes", occurring).alias("m"))
    return checked.select("row", F.explode("m").alias("m")).select("row", "m.*").filter(F.size("places") > 0)


def proximity_matches(indexed: DataFrame, items: DataFrame, window: int = WINDOW, reach: int = 20) -> DataFrame:
    """row, item, first, last: both rare words of a window within ``reach`` words, in any order."""
    plans = _plans(items, indexed, window)
    pairs = plans.select("item", "words", F.explode("windows").alias("w")).select(
        "item", F.get("words", F.col("w.first")).alias("t1"), F.get("words", F.col("w.second")).alias("t2")
    ).distinct()
    terms = cut_lineage(pairs.select(F.explode(F.array("t1", "t2")).alias("term")).distinct())
    postings = cut_lineage(
        indexed.select("row", F.posexplode("words").alias("at", "term")).join(terms, "term").select("row", "at", "term")
    )
    # Places fall into cells of ``reach`` words; a partner lies in the same or a neighbouring cell.
    cell = lambda c: F.floor(F.col(c) / reach)
    left = postings.select("row", F.col("at").alias("a"), F.col("term").alias("t1")).join(pairs, "t1")
    left = left.withColumn("cell", F.explode(F.array(cell("a") - 1, cell("a"), cell("a") + 1)))
    right = postings.select("row", F.col("at").alias("b"), F.col("term").alias("t2"), cell("at").alias("cell"))
    met = left.join(right, ["row", "t2", "cell"]).filter(F.abs(F.col("a") - F.col("b")) <= reach)
    return met.select("row", "item", F.least("a", "b").alias("first"), F.greatest("a", "b").alias("last")).distinct()


def benchmark_items(benchmark: DataFrame, key: str = "item_id", text: str = "text") -> DataFrame:
    """item, item_id, words; rows without an id take no part."""
    known = benchmark.filter(F.col(key).isNotNull()).select(F.col(key).alias("item_id"), words(F.col(text)).alias("words"))
    return cut_lineage(known.select(F.monotonically_increasing_id().alias("item"), "item_id", "words"))


def contamination(
    docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW
) -> DataFrame:
    """key, n_words, n_hit, n_items, items_sha256, contaminated of every row of ``docs``."""
    indexed = index_documents(docs, key, text)
    items = benchmark_items(benchmark)
    found = phrase_matches(indexed, items.select("item", "words"), window)
    named = found.join(items.select("item", "item_id"), "item")
    hit = F.flatten(F.transform("places", lambda p: F.sequence(p, p + F.col("size") - 1)))
    per_row = named.groupBy("row").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list(hit)))).cast("long").alias("n_hit"),
        F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("ids"),
    )
    ids = F.coalesce("ids", F.array().cast("array<string>"))
    return indexed.select("row", F.col("key").alias(key), "n_words").join(per_row, "row", "left").select(
        key, "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.size(ids).cast("long").alias("n_items"), F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )


def op6_decontaminate(spark, sf_dir: str) -> DataFrame:
    """Benchmark passages in every document."""
    return contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


_SQL_WORDS = (
    "list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
    r"'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"
)
SQL = f"""
WITH d AS (SELECT doc_id, {_SQL_WORDS} AS w FROM documents),
i AS (SELECT item_id, {_SQL_WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL),
iw AS (SELECT DISTINCT item_id, n, array_to_string(w[s:s + n - 1], ' ') AS k
       FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS s
             FROM (SELECT *, least({WINDOW}, len(w)) AS n FROM i WHERE len(w) > 0))),
dw AS (SELECT doc_id, s, n, array_to_string(w[s:s + n - 1], ' ') AS k
       FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s
             FROM d, (SELECT DISTINCT n FROM iw) WHERE len(w) >= n)),
o AS (SELECT doc_id, item_id, s, dw.n AS n FROM dw JOIN iw ON dw.n = iw.n AND dw.k = iw.k),
h AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM o) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
      FROM (SELECT DISTINCT doc_id, item_id FROM o) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(h.n_hit, 0) AS n_hit, coalesce(t.n_items, 0) AS n_items,
       sha256(coalesce(t.ids, '')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)"""

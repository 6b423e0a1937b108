"""User-level preparation: vocabulary, empty posts, post selection, token sequences.

Posts are rows (user, order, text). Arrays per user are only built from a bounded number
of posts, so a user holding a large share of all posts is never collected whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .ranking import hash_order, ordered_index, range_edges, running_totals
from .rows import term_stats
from .wordtable import word_values

HOW = ("first", "last", "spaced", "random")

# Fixed value: the characters the tokenizer removes.
TOKEN_FILTER = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~\t\n"


def words(text: Column) -> Column:
    """Lower-cased words after replacing filtered characters by spaces."""
    spaced = F.translate(F.lower(F.coalesce(text, F.lit(""))), TOKEN_FILTER, " " * len(TOKEN_FILTER))
    return F.filter(F.split(spaced, " "), lambda t: t != "")


def vocabulary(posts: DataFrame, text: str, min_tf: int = 3, min_df: int = 2) -> DataFrame:
    """(term, index, tf, df): frequent enough terms, numbered from 1 in alphabetical order."""
    stats = term_stats(posts.select(words(F.col(text)).alias("terms")), "terms")
    kept = stats.filter((F.col("tf") >= min_tf) & (F.col("df") >= min_df))
    return ordered_index(kept, "term", "index", start=1).select("term", "index", "tf", "df")


def drop_empty(posts: DataFrame, user: str, order: str, text: str, vocab: DataFrame) -> DataFrame:
    """Posts with at least one vocabulary word; users without any disappear with them."""
    held = posts.withColumn("_words", words(F.col(text)))
    known = word_values(held, "_words", vocab.withColumn("_one", F.lit(1)), "_known", "term", "_one", [user, order])
    return known.filter(F.exists("_known", lambda k: k.isNotNull())).drop("_words", "_known")


def empty_summary(before: DataFrame, after: DataFrame, user: str) -> DataFrame:
    """Users, posts and posts per user (min, mean, max) before and after."""

    def stats(df: DataFrame, stage: str) -> DataFrame:
        per_user = df.groupBy(user).agg(F.count("*").alias("n"))
        return per_user.agg(
            F.count("*").alias("n_users"),
            F.coalesce(F.sum("n"), F.lit(0)).alias("n_posts"),
            F.min("n").alias("min_posts"),
            F.avg("n").alias("mean_posts"),
            F.max("n").alias("max_posts"),
        ).select(F.lit(stage).alias("stage"), "*")

    return stats(before, "before").unionByName(stats(after, "after"))


def select_posts(posts: DataFrame, user: str, order: str, n: int, how: str = "first", seed: int = 42) -> DataFrame:
    """At most ``n`` posts per user with their ``slot`` 0..n-1.

    first and last keep the time order; random shuffles the first ``n`` posts; spaced
    takes the truncated positions of an even spacing, or all posts when there are not more
    than ``n``.
    """
    if how not in HOW:
        raise ValueError(f"how must be one of {HOW}")
    # A filter right on the row number lets Spark cut each task to n rows per user before
    # the shuffle, however many posts a user has.
    if how in ("first", "random"):
        forward = F.row_number().over(W.partitionBy(user).orderBy(order))
        kept = posts.withColumn("_place", forward).filter(F.col("_place") <= n)
        if how == "random":
            shuffled = W.partitionBy(user).orderBy(hash_order(F.concat_ws("|", user, order), seed))
            kept = kept.withColumn("_place", F.row_number().over(shuffled))
        return kept.withColumn("slot", F.col("_place") - 1).drop("_place")
    if how == "last":
        backward = F.row_number().over(W.partitionBy(user).orderBy(F.desc(order)))
        kept = posts.withColumn("_place", backward).filter(F.col("_place") <= n)
        total = F.count("*").over(W.partitionBy(user))
        return kept.withColumn("slot", (total - F.col("_place")).cast("int")).drop("_place")
    placed = _positions(posts, user, order)
    counts = posts.groupBy(user).agg(F.count("*").alias("_count"))
    # The slots of a user come from their post count alone: n rows per user, then a join.
    wanted = counts.withColumn("slot", F.explode(F.sequence(F.lit(0), F.least(F.col("_count"), F.lit(n)).cast("int") - 1)))
    if n > 1:
        spaced = F.floor(F.col("slot") * ((F.col("_count") - 1) / F.lit(float(n - 1)))).cast("int")
        exact_end = F.when(F.col("slot") == n - 1, F.col("_count").cast("int") - 1).otherwise(spaced)
        place = F.when(F.col("_count") <= n, F.col("slot")).otherwise(exact_end)
    else:
        place = F.col("slot")
    wanted = wanted.select(user, "slot", place.alias("_at"))
    return placed.join(wanted, [user, "_at"]).drop("_at")


def _positions(posts: DataFrame, user: str, order: str) -> DataFrame:
    """0-based position of each post in its user's order, as ``_at``.

    Counted in ranges of the order, so a single prolific user is ranked by many tasks.
    """
    edges = range_edges(posts.select(order).distinct(), order)
    counted = posts.withColumn("_one", F.lit(1).cast("long"))
    ranked = running_totals(counted, [user], order, {"_at": "_one"}, descending=False, edges=edges)
    return ranked.withColumn("_at", (F.col("_at") - 1).cast("int")).drop("_one")


def sequences(
    posts: DataFrame, user: str, slot: str, text: str, vocab: DataFrame, length: int, n_posts: int
) -> DataFrame:
    """(user, slot, ids): the last ``length`` vocabulary ids of each post, zeros in front.

    ``posts`` comes from :func:`select_posts`. Missing posts up to ``n_posts`` are all zeros.
    """
    tokens = posts.select(user, slot, words(F.col(text)).alias("_words"))
    known = word_values(tokens, "_words", vocab, "_ids", "term", "index", [user, slot])
    lists = known.select(user, slot, F.filter("_ids", lambda i: i.isNotNull()).alias("_ids"))
    grid = posts.select(user).distinct().withColumn(slot, F.explode(F.sequence(F.lit(0), F.lit(n_posts - 1))))
    ids = F.coalesce("_ids", F.array().cast("array<int>"))
    joined = grid.join(lists, [user, slot], "left").withColumn("ids", ids)
    tail = F.slice("ids", F.greatest(F.size("ids") - length, F.lit(0)) + 1, F.lit(length))
    zeros = F.array_repeat(F.lit(0), F.greatest(F.lit(length) - F.size("ids"), F.lit(0)))
    return joined.select(user, slot, F.concat(zeros, tail).alias("ids"))

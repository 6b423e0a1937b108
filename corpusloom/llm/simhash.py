"""SimHash near duplicates by the generalised pigeonhole principle.

Texts whose 64-bit fingerprints differ in at most ``distance`` bits are linked; linked texts form
components. Search:

1. Bits that vary together are put into one of eight blocks of eight bits (correlations over
   all distinct fingerprints), and blocks are joined to m groups.
2. If m group thresholds t_i >= -1 add up to ``distance`` - m + 1, every pair within the distance
   differs in at most t_i bits of some group i. The thresholds are chosen unequally, by dynamic
   programming over the estimated candidates (distance distributions of the blocks over all
   fingerprints) and probes of every group; so is m. Only the cost depends on that choice.
3. Every fingerprint is indexed by its bits in each group, and probes the index with all
   variants within t_i bits. Distances are checked inside the join.

Equal fingerprints are one row from the start. Dense groups do not emit all their pairs: each
bucket's commonest fingerprint is its anchor, and pairs that share a verified anchor are left
out, as their links to the anchor already join them.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage, read_table
from .components import connected_components

SEED = 42
SHINGLE_WORDS = 4
DISTANCE = 4
BITS = 64
_BLOCK = 8
_PROBE_COST, _CANDIDATE_COST = 1.0, 0.02


def _bit_counts(values: np.ndarray) -> np.ndarray:
    """How many of the 64-bit values have each bit set, in blocks of bounded memory."""
    total = np.zeros(BITS, dtype=np.int64)
    for start in range(0, len(values), 1 << 15):
        part = values[start : start + (1 << 15)].astype("<u8").view(np.uint8).reshape(-1, 8)
        total += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return total


def simhash(text: str | None) -> int:
    """Unsigned fingerprint of one text; see ``fingerprint``."""
    words = (text or "").encode("utf-8", "replace").lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.r_[0, ends[:-1] + 1]
    width = min(SHINGLE_WORDS, len(words))
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist())
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in spans), dtype=np.uint64)
    bits = 2 * _bit_counts(hashes) > len(hashes)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprint(text: Column) -> Column:
    """64-bit SimHash over word shingles, repeats included, as a signed long.

    Fewer words than a shingle: the whole sequence is one shingle. No words, empty or null: 0.
    """

    @F.pandas_udf("long")
    def sign(batch: pd.Series) -> pd.Series:
        return pd.Series(np.array([simhash(t) for t in batch], dtype=np.uint64).view(np.int64))

    return sign(text)


def _sums(distinct: DataFrame, size: int, count) -> np.ndarray:
    """Sum of a fixed-size count table over all fingerprints; ``size`` numbers reach the driver."""

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(size, dtype=np.int64)
        for batch in batches:
            total += count(batch["fp"].to_numpy(dtype=np.int64).view(np.uint64))
        yield pd.DataFrame({"place": np.arange(size), "n": total})

    found = distinct.select("fp").mapInPandas(partial, "place long, n long").groupBy("place").agg(F.sum("n").alias("n"))
    out = np.zeros(size, dtype=np.float64)
    for row in found.collect():
        out[row["place"]] = row["n"]
    return out


def _together(values: np.ndarray) -> np.ndarray:
    bits = np.unpackbits(values.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
    return (bits.T @ bits).astype(np.int64).ravel()


def blocks_of(together: np.ndarray, n: float) -> list[list[int]]:
    """Eight blocks of eight bits, correlated bits together (greedy on absolute correlation)."""
    share = together.reshape(BITS, BITS) / max(n, 1)
    mean = np.diag(share)
    spread = np.sqrt(np.maximum(mean * (1 - mean), 1e-12))
    related = np.abs((share - np.outer(mean, mean)) / np.outer(spread, spread))
    np.fill_diagonal(related, 0)
    free, out = list(range(BITS)), []
    while free:
        inside = related[np.ix_(free, free)]
        block = [free[int(inside.sum(axis=1).argmax())]]
        while len(block) < _BLOCK:
            rest = [b for b in free if b not in block]
            block.append(max(rest, key=lambda b: (related[b, block].sum(), -b)))
        out.append(sorted(block))
        free = [b for b in free if b not in block]
    return out


def _block_keys(values: np.ndarray, block: list[int]) -> np.ndarray:
    key = np.zeros(len(values), dtype=np.uint64)
    for place, bit in enumerate(block):
        key |= ((values >> np.uint64(bit)) & np.uint64(1)) << np.uint64(place)
    return key.astype(np.int64)


def _distances(counts: np.ndarray) -> np.ndarray:
    """Share of random pairs at each distance inside a block, from its value counts."""
    p = counts / max(counts.sum(), 1)
    values = np.arange(len(p))
    apart = np.bitwise_count(values[:, None] ^ values[None, :])
    return np.bincount(apart.ravel(), weights=np.outer(p, p).ravel(), minlength=_BLOCK + 1)


def allocate(groups: list[np.ndarray], sizes: list[int], n: float, distance: int) -> tuple[float, list[int]]:
    """Thresholds of least cost whose sum is ``distance`` - groups + 1, by dynamic programming.

    ``groups`` holds each group's distance distribution; -1 means that a group is not used.
    """
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for spread, bits in zip(groups, sizes):
        step: dict[int, tuple[float, list[int]]] = {}
        for used, (cost, chosen) in best.items():
            for t in range(-1, distance + 1):
                probes = sum(len(list(combinations(range(bits), k))) if k < 3 else 10**9 for k in range(t + 1))
                own = 0.0 if t < 0 else 1 + probes * _PROBE_COST + n * spread[: t + 1].sum() * _CANDIDATE_COST
                key = used + t + 1
                if key not in step or cost + own < step[key][0]:
                    step[key] = (cost + own, [*chosen, t])
        best = step
    return best[distance + 1]  # sum of (t + 1) = distance + 1


def plan(distinct: DataFrame, distance: int = DISTANCE) -> list[tuple[list[int], int]]:
    """Groups of bits with their thresholds; unused groups are left out."""
    n = float(distinct.count())
    blocks = blocks_of(_sums(distinct, BITS * BITS, _together), n)

    def histogram(values: np.ndarray) -> np.ndarray:
        return np.concatenate([np.bincount(_block_keys(values, b), minlength=256) for b in blocks])

    spreads = [_distances(c) for c in _sums(distinct, 8 * 256, histogram).reshape(8, 256)]
    choices = []
    for cuts in ([0, 4, 8], [0, 3, 6, 8], [0, 2, 4, 6, 8]):
        bits, dist = [], []
        for a, b in zip(cuts, cuts[1:]):
            bits.append([bit for block in blocks[a:b] for bit in block])
            joint = np.ones(1)
            for s in spreads[a:b]:
                joint = np.convolve(joint, s)
            dist.append(joint)
        cost, chosen = allocate(dist, [len(b) for b in bits], n, distance)
        choices.append((cost, [(b, t) for b, t in zip(bits, chosen) if t >= 0]))
    return min(choices, key=lambda c: c[0])[1]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def links(distinct: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Links (a, b) that connect all fingerprints within the distance.

    ``distinct`` has one row per fingerprint: fp, n (rows that have it). Pairs at the distance
    that share a verified anchor are represented by their two links to the anchor.
    """
    groups = plan(distinct, distance)
    near = lambda x, y: F.bit_count(F.col(x).bitwiseXOR(F.col(y))) <= distance
    masks = [_signed(sum(1 << b for b in bits)) for bits, _ in groups]
    keys = F.array(*[F.struct(F.lit(g).alias("g"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for g, m in enumerate(masks)])
    index = distinct.select("fp", "n", F.inline(keys))
    anchors = index.groupBy("g", "key").agg(F.max(F.struct("n", "fp"))["fp"].alias("anchor"), F.count("*").alias("members"))
    star = index.join(anchors.filter("members > 1"), ["g", "key"]).filter(near("fp", "anchor"))
    star = cut_lineage(star.groupBy("fp").agg(F.collect_set("anchor").alias("anchors")))  # at most one anchor per group
    placed = distinct.select("fp").join(star, "fp", "left")
    variants = []
    for g, (bits, t) in enumerate(groups):
        flips = [0] + [sum(1 << b for b in chosen) for k in range(1, t + 1) for chosen in combinations(bits, k)]
        mask = F.lit(masks[g])
        variants.append(
            placed.select(
                F.lit(g).alias("g"), F.col("fp").alias("a"), F.col("anchors").alias("of_a"),
                F.explode(F.array(*[F.lit(_signed(f)) for f in flips])).alias("flip"),
            ).select("g", "a", "of_a", F.col("a").bitwiseAND(mask).bitwiseXOR(F.col("flip")).alias("key"))
        )
    probes = variants[0]
    for more in variants[1:]:
        probes = probes.unionByName(more)
    held = placed.select(F.col("fp").alias("b"), F.col("anchors").alias("of_b"), F.inline(keys))
    shared = F.coalesce(F.arrays_overlap("of_a", "of_b"), F.lit(False))
    found = probes.join(
        held, [probes["g"] == held["g"], probes["key"] == held["key"], F.col("a") < F.col("b"), near("a", "b"), ~shared]
    ).select("a", "b")
    return found.unionByName(star.select(F.col("fp").alias("a"), F.explode("anchors").alias("b")))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", distance: int = DISTANCE) -> DataFrame:
    """One row per row of ``docs``: key, fingerprint (16 hex digits), component_id.

    component_id is the smallest key that links reach, the row's own included. Null keys are
    never a component's id unless it has no other; empty, blank and null texts share
    fingerprint 0 and are linked like any other. Repeated rows stay rows. Other columns of
    ``docs`` are not read.
    """
    signed = cut_lineage(docs.select(F.col(key).alias("key"), fingerprint(F.col(text)).alias("fp")))
    distinct = cut_lineage(signed.groupBy("fp").agg(F.min("key").alias("first"), F.count("*").alias("n")))
    roots = connected_components(links(distinct, distance))
    known = distinct.join(roots.select(F.col("node").alias("fp"), "root"), "fp", "left")
    known = known.select("fp", "first", F.coalesce("root", "fp").alias("root"))
    smallest = known.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = known.join(smallest, "root").select("fp", "component_id")
    return signed.join(classes, "fp").select(
        F.col("key").alias(key), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op1_simhash(spark, sf_dir: str) -> DataFrame:
    """Near-duplicate class of every document."""
    return near_duplicates(read_table(spark, sf_dir, "documents"))

"""Best-fit packing by exact-complement hashing.

Documents become token pieces of at most ``capacity`` tokens. What can be packed is decided on
the histogram of piece lengths alone, at most ``capacity`` numbers whatever the data's size:

1. full pieces are sequences by themselves;
2. available lengths are indexed by their single, pair and triple sums; combinations that fill a
   gap exactly are consumed in batches, as often as the counts allow;
3. the rest is packed best-fit, longest first, on bins held by their free space.

The result is a list of patterns with multiplicities. Pieces are then dealt to the places of
their length by their rank among equal lengths. Ranks come from counts per task and offsets
before each task, so no length is ever gathered in one place.
"""

from __future__ import annotations

import os
import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from .common import cut_lineage, read_table

CAPACITY = 2048
END_ID = 0
_CACHE_WORDS = 400_000


class _WordTokenizer:
    """Token ids of whole texts by the vocabulary file, each different word tokenized once per worker.

    White space separates words for this vocabulary (it is dropped by the normaliser and never part
    of a token), so ids of blank-separated chunks can be joined. Chunks of letters alone, with
    commas or full stops after them, are one word each and go through in bulk.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocab = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, dtype=bool)
        self.ends[[i for token, i in vocab.items() if token.endswith("</w>")]] = True
        self.known: dict[str, bytes] = {"": b""}

    def _one(self, chunk: str) -> bytes:
        return np.array(self.tokenizer.encode(chunk, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _learn(self, chunks: set[str]) -> None:
        words, plain = {}, set()
        for c in chunks:
            core = c.rstrip(",.")
            if core and core.isalpha() and core.lower().isalpha():
                words[c] = core
                if core not in self.known:
                    plain.add(core)
            else:
                self.known[c] = self._one(c)
        order = sorted(plain)
        for start in range(0, len(order), 2000):
            some = order[start : start + 2000]
            (coded,) = self.tokenizer.encode_batch_fast([" ".join(some)], add_special_tokens=False)
            ids = np.array(coded.ids, dtype="<u4")
            stops = np.flatnonzero(self.ends[ids]) + 1
            if len(stops) == len(some):
                cuts = [0, *stops.tolist()]
                self.known.update((w, ids[a:b].tobytes()) for w, a, b in zip(some, cuts, cuts[1:]))
            else:  # a word that the vocabulary splits otherwise: one by one
                self.known.update((w, self._one(w)) for w in some)
        for c, core in words.items():
            if c != core:
                tail = c[len(core) :]
                if tail not in self.known:
                    self.known[tail] = self._one(tail)
                self.known[c] = self.known[core] + self.known[tail]

    def ids(self, texts: list[str]) -> Iterator[bytes]:
        """Little-endian unsigned 32-bit ids of every text."""
        if len(self.known) > _CACHE_WORDS:
            self.known = {"": b""}
        for text in texts:
            chunks = text.replace("\n", " ").split(" ")
            missing = set(chunks).difference(self.known)
            if missing:
                self._learn(missing)
            yield b"".join(map(self.known.__getitem__, chunks))


@lru_cache(maxsize=2)
def _tokenizer(path: str) -> _WordTokenizer:
    return _WordTokenizer(path)


def _default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def pieces(docs: DataFrame, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY, vocabulary: str | None = None) -> DataFrame:
    """Pieces of every document: key, piece, start, length, ids_crc32.

    A document's ids are those of its text followed by one end id; null is empty, so every row
    has at least one piece. Only documents longer than ``capacity`` are cut.
    """
    path = vocabulary or _default_path()

    @F.pandas_udf("array<struct<piece:int,start:long,length:long,ids_crc32:long>>")
    def cut(batch: pd.Series) -> pd.Series:
        end = np.array([END_ID], dtype="<u4").tobytes()
        out = []
        for ids in _tokenizer(path).ids([t or "" for t in batch]):
            ids, step = ids + end, 4 * capacity
            out.append([
                (n, at // 4, len(part) // 4, zlib.crc32(part))
                for n, at in enumerate(range(0, len(ids), step)) if (part := ids[at : at + step])
            ])
        return pd.Series(out)

    return docs.select(F.col(key).alias(key), F.explode(cut(F.col(text))).alias("p")).select(key, "p.*")


def pack_lengths(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """Patterns (lengths in order) with the number of sequences of each, using up the histogram.

    Planned with exact complements of up to three, two and one lengths; the plan with the fewest
    sequences counts. All plans work on the histogram only.
    """
    plans = [_plan(histogram, capacity, most) for most in (3, 2, 1)]
    return min(plans, key=lambda patterns: sum(n for _, n in patterns))


def _plan(histogram: dict[int, int], capacity: int, most: int) -> list[tuple[tuple[int, ...], int]]:
    """Exact complements of up to ``most`` lengths, then best fit."""
    left = Counter({length: n for length, n in histogram.items() if n > 0})
    if any(not 0 < length <= capacity for length in left):
        raise ValueError("lengths must lie between 1 and the capacity")
    patterns: list[tuple[tuple[int, ...], int]] = []

    def consume(*lengths: int) -> None:
        need = Counter(lengths)
        times = min(left[x] // k for x, k in need.items())
        if times > 0:
            for x, k in need.items():
                left[x] -= k * times
            patterns.append((tuple(sorted(lengths, reverse=True)), times))

    # Exact complements of one, two and three lengths, longest first.
    consume(capacity)
    for a in sorted(left, reverse=True) if most > 1 else ():
        if left[a] > 0 and capacity - a <= a and left[capacity - a] > 0:
            consume(a, capacity - a)
    for a in sorted(left, reverse=True) if most > 2 else ():
        rest = capacity - a
        for b in range((rest + 1) // 2, min(a, rest - 1) + 1):  # even halves first: short pieces stay as filling
            if left[a] <= 0:
                break
            if left[b] > 0 and left[rest - b] > 0:
                consume(a, b, rest - b)
    # Best fit on the residue: bins of equal content share one entry.
    spaces: dict[int, list[list]] = {}
    frees: list[int] = []

    def put(pattern: tuple[int, ...], n: int) -> None:
        free = capacity - sum(pattern)
        if free == 0:
            patterns.append((pattern, n))
        elif free in spaces:
            spaces[free].append([pattern, n])
        else:
            spaces[free] = [[pattern, n]]
            frees.insert(bisect_left(frees, free), free)

    for length in sorted((x for x, n in left.items() if n > 0), reverse=True):
        n = left[length]
        while n > 0:
            at = bisect_left(frees, length)
            if at == len(frees):
                per = capacity // length
                full, some = divmod(n, per)
                if full:
                    put((length,) * per, full)
                if some:
                    put((length,) * some, 1)
                break
            free = frees[at]
            pattern, bins = spaces[free].pop()
            if not spaces[free]:
                del spaces[free]
                frees.pop(at)
            per = free // length
            full = min(bins, n // per)
            if full:
                put(pattern + (length,) * per, full)
                n -= full * per
                bins -= full
            if bins and 0 < n < per:
                put(pattern + (length,) * n, 1)
                n, bins = 0, bins - 1
            if bins:
                put(pattern, bins)
    for held in spaces.values():
        patterns.extend((p, n) for p, n in held)
    return patterns


def _places(patterns: list[tuple[tuple[int, ...], int]]) -> dict[int, dict[str, np.ndarray]]:
    """Per length, runs of ranks that go to the same place of consecutive sequences."""
    runs: dict[int, list[tuple[int, int, int]]] = {}
    used: Counter = Counter()
    sequence = 0
    for pattern, times in patterns:
        offset = 0
        for length in pattern:
            runs.setdefault(length, []).append((used[length], sequence, offset))
            used[length] += times
            offset += length
        sequence += times
    return {
        x: {name: np.array(column, dtype=np.int64) for name, column in zip(("rank", "sequence", "offset"), zip(*rows))}
        for x, rows in runs.items()
    }


def pack(cut: DataFrame, length: str = "length", capacity: int = CAPACITY) -> DataFrame:
    """``cut`` with sequence_id and offset: as few sequences as found, gapless from offset 0.

    Equal lengths are interchangeable, so ties and repeated rows need no order; an empty table
    stays empty; a null length is an error. Rows are numbered per length inside their task and
    written, which fixes the numbers; offsets of the tasks then make them ranks.
    """
    names = cut.columns

    def number(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        seen, task = np.zeros(capacity + 1, dtype=np.int64), TaskContext.get().partitionId()
        for batch in batches:
            values = batch[length]
            local = batch.groupby(length).cumcount().to_numpy() + seen[values]
            seen += np.bincount(values, minlength=capacity + 1)
            yield batch.assign(pack__task=task, pack__local=local)

    # Written before it is numbered: tokenizing and numbering in one stage would hold two Python
    # workers per task, and pooled workers all come to hold the tokenizer's word cache.
    held = cut_lineage(cut)
    schema = held.withColumns({"pack__task": F.lit(0), "pack__local": F.lit(0).cast("long")}).schema
    numbered = cut_lineage(held.mapInPandas(number, schema))
    counts = numbered.groupBy(length, "pack__task").agg(F.count("*").alias("pack__n"))
    histogram = {r[0]: r[1] for r in counts.groupBy(length).agg(F.sum("pack__n")).collect()}  # at most ``capacity`` rows
    before = Window.partitionBy(length).orderBy("pack__task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(length, "pack__task", F.coalesce(F.sum("pack__n").over(before), F.lit(0)).alias("pack__before"))
    places = _places(pack_lengths(histogram, capacity))

    @F.pandas_udf("sequence_id long, offset long")
    def place(lengths: pd.Series, ranks: pd.Series) -> pd.DataFrame:
        values, wanted = lengths.to_numpy(), ranks.to_numpy()
        out = np.empty((2, len(values)), dtype=np.int64)
        for x in np.unique(values):
            rows, runs = np.flatnonzero(values == x), places[int(x)]
            at = np.searchsorted(runs["rank"], wanted[rows], side="right") - 1
            out[0, rows] = runs["sequence"][at] + wanted[rows] - runs["rank"][at]
            out[1, rows] = runs["offset"][at]
        return pd.DataFrame({"sequence_id": out[0], "offset": out[1]})

    ranked = numbered.join(offsets, [length, "pack__task"])
    kept = [n for n in names if n not in ("sequence_id", "offset")]
    dealt = place(F.col(length), F.col("pack__local") + F.col("pack__before"))
    return ranked.select(*kept, dealt.alias("pack__p")).select(*kept, "pack__p.sequence_id", "pack__p.offset")


def op3_packing(spark, sf_dir: str) -> DataFrame:
    """Place of every piece of every document."""
    return pack(pieces(read_table(spark, sf_dir, "documents").select("doc_id", "text")))

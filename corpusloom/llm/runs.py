"""Periodic runs of words: maximal repetitions by suffix trees, constant-time LCA and Lyndon roots.

A run is a stretch of consecutive words with smallest period q and at least max(``LEAST``, ``REPEATS`` * q) words that
cannot be extended. Per document, within the task that reads it:

1. Positions that can lie in a run are found first. In a run of period q every word after the first q words equals
   the one q before, so at least (``REPEATS`` - 1) * q successive words have an equal word at most q before them. Only
   stretches that meet this for some bounds of q, widened to the left by the upper one, are searched; nothing else can hold a run.
2. For a stretch, Ukkonen's algorithm builds the suffix tree of its words. The Euler tour of the tree gives the depth
   of the lowest common ancestor of any two leaves as a range minimum, so longest common extensions take
   constant time. The tree of the reversed stretch gives extensions to the left.
3. The longest Lyndon word at every position, under the order of the words and under its inverse, is the step to the next
   smaller suffix. Every run has its root among these. Each candidate is extended in both directions.

Defined results: words are split at ASCII white space; a null or empty text has no words; a null id leaves its text as it is.
Texts stay in the task that reads them, nothing is shuffled; memory follows the longest stretch of one text.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import read_table

LEAST, REPEATS = 6, 4
_BATCH_WORDS = 1 << 20
_BATCH_ROWS = 2000
_FAR = np.iinfo(np.int64).max


def rewritten(key: int | None, words: list) -> list:
    """The words with a repeated tail for one id in ten."""
    if key is None or not words:
        return words
    h = zlib.crc32(str(key).encode())
    if h % 10:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * ((n - a) // p + 1))[: n - a]


class SuffixTree:
    """Ukkonen's suffix tree of a sequence of numbers from 1; a closing 0 ends it.

    ``rank`` orders the suffixes by the numbers and ``inverse_rank`` by the inverse order; in both a suffix comes
    after its own prefixes.
    """

    def __init__(self, numbers: list[int], both_orders: bool = True):
        self.size = len(numbers)
        text = [*numbers, 0]
        self._letters = max(text) + 1
        self._grow(text)
        self._tour(both_orders)

    def _grow(self, text: list[int]) -> None:
        letters, n = self._letters, len(text)
        begin, end, link, suffix, child = [0], [0], [0], [-1], {}
        at = edge = length = left = 0
        for i, letter in enumerate(text):
            left += 1
            last = 0
            while left:
                if not length:
                    edge = i
                slot = at * letters + text[edge]
                below = child.get(slot)
                if below is None:
                    child[slot] = len(begin)
                    begin.append(i)
                    end.append(n)
                    link.append(0)
                    suffix.append(i - left + 1)
                    if last:
                        link[last] = at
                        last = 0
                else:
                    start = begin[below]
                    width = end[below] - start
                    if length >= width:
                        edge += width
                        length -= width
                        at = below
                        continue
                    if text[start + length] == letter:
                        if last:
                            link[last] = at
                        length += 1
                        break
                    middle = len(begin)
                    child[slot] = middle
                    begin += [start, i]
                    end += [start + length, n]
                    link += [0, 0]
                    suffix += [-1, i - left + 1]
                    begin[below] = start + length
                    child[middle * letters + letter] = middle + 1
                    child[middle * letters + text[start + length]] = below
                    if last:
                        link[last] = middle
                    last = middle
                left -= 1
                if at:
                    at = link[at]
                elif length:
                    length -= 1
                    edge = i - left + 1
        self._begin, self._end, self._suffix, self._child = begin, end, suffix, child

    def _tour(self, both_orders: bool) -> None:
        """Euler tour of the tree: ranks of the leaves and the depth of each common ancestor of neighbours."""
        slots = np.fromiter(self._child.keys(), dtype=np.int64, count=len(self._child))
        nodes = np.fromiter(self._child.values(), dtype=np.int64, count=len(self._child))
        self._child = {}
        order = np.argsort(slots, kind="stable")
        nodes, parent = nodes[order], slots[order] // self._letters
        count = len(self._begin)
        first = np.searchsorted(parent, np.arange(count + 1))
        width = (np.array(self._end) - np.array(self._begin)).tolist()
        kids, first, suffix = nodes.tolist(), first.tolist(), self._suffix
        self._begin = self._end = self._suffix = []
        lexical, gaps, depth = [], [], [0] * count
        lowest, stack = 0, [0]
        while stack:
            v = stack.pop()
            if v < 0:  # back at an inner node between two of its children
                if depth[~v] < lowest:
                    lowest = depth[~v]
                continue
            a, b = first[v], first[v + 1]
            if a == b:
                lexical.append(suffix[v])
                gaps.append(lowest)
                lowest = depth[v]
                continue
            here = depth[v]
            for k in range(b - 1, a - 1, -1):
                kid = kids[k]
                depth[kid] = here + width[kid]
                stack.append(kid)
                if k > a:
                    stack.append(~v)
        # the inverse order: the closing 0 still first, other children from the last to the first
        inverse, stack = [], [0] if both_orders else []
        while stack:
            v = stack.pop()
            a, b = first[v], first[v + 1]
            if a == b:
                inverse.append(suffix[v])
                continue
            head = kids[a]
            if first[head] == first[head + 1] and suffix[head] + depth[v] == self.size:
                stack += kids[a + 1 : b]
                stack.append(head)
            else:
                stack += kids[a:b]
        self.rank = np.empty(self.size + 1, dtype=np.int64)
        self.rank[lexical] = np.arange(self.size + 1)
        if both_orders:
            self.inverse_rank = np.empty(self.size + 1, dtype=np.int64)
            self.inverse_rank[inverse] = np.arange(self.size + 1)
        table = [np.array(gaps[1:], dtype=np.int32)]
        while len(table[-1]) > 1 << (len(table) - 1):
            half = 1 << (len(table) - 1)
            table.append(np.minimum(table[-1][:-half], table[-1][half:]))
        self._table = table

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Length of the longest common prefix of the suffixes at i and j, i <> j, each at most ``size``."""
        a, b = self.rank[i], self.rank[j]
        a, b = np.minimum(a, b), np.maximum(a, b)
        level = np.frexp((b - a).astype(float))[1] - 1
        out = np.empty(len(a), dtype=np.int64)
        for k in np.unique(level).tolist():
            at = np.flatnonzero(level == k)
            table = self._table[k]
            out[at] = np.minimum(table[a[at]], table[b[at] - (1 << k)])
        return out


def next_smaller(rank: np.ndarray) -> np.ndarray:
    """For every suffix but the empty one, the nearest later suffix of smaller rank."""
    ranks, after = rank.tolist(), [0] * (len(rank) - 1)
    stack = [len(ranks) - 1]
    for i in range(len(ranks) - 2, -1, -1):
        own = ranks[i]
        while ranks[stack[-1]] > own:
            stack.pop()
        after[i] = stack[-1]
        stack.append(i)
    return np.array(after, dtype=np.int64)


def runs_of(numbers: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run in a sequence, by start and period."""
    n = len(numbers)
    if n < LEAST:
        return []
    numbers = np.unique(numbers, return_inverse=True)[1] + 1
    tree = SuffixTree(numbers.tolist())
    here = np.arange(n)
    found = []
    for rank in (tree.rank, tree.inverse_rank):
        root_end = next_smaller(rank)
        inside = root_end < n
        i, j = here[inside], root_end[inside]
        right = tree.common(i, j)
        period = j - i
        # the first root of a run starts less than a period after the run
        long = period + right >= np.maximum(LEAST, REPEATS * period) - period
        found.append((i[long], j[long], right[long]))
    i, j, right = (np.concatenate(x) for x in zip(*found))
    if not len(i):
        return []
    del tree
    back = SuffixTree(numbers[::-1].tolist(), both_orders=False)
    left = np.zeros(len(i), dtype=np.int64)
    inner = i > 0
    left[inner] = back.common(n - i[inner], n - j[inner])
    start, length, period = i - left, j + right - (i - left), j - i
    keep = length >= np.maximum(LEAST, REPEATS * period)
    rows = np.unique(np.stack([start[keep], period[keep], length[keep]], axis=1), axis=0)
    return [(s, m, p) for s, p, m in rows.tolist()]


def _before(numbers: np.ndarray) -> np.ndarray:
    """Distance of every element to the nearest earlier equal one."""
    order = np.argsort(numbers, kind="stable")
    again = numbers[order[1:]] == numbers[order[:-1]]
    gap = np.full(len(numbers), _FAR)
    gap[order[1:][again]] = (order[1:] - order[:-1])[again]
    return gap


def stretches(numbers: np.ndarray, starts: np.ndarray) -> list[tuple[int, int]]:
    """Stretches [a, b) outside which no run can lie; documents begin at ``starts`` and share no numbers."""
    if not len(numbers):
        return []
    gap = _before(numbers)
    cover = np.zeros(len(numbers) + 1, dtype=np.int64)
    longest = int(np.diff(np.r_[starts, len(numbers)]).max(initial=0))
    bound, smallest = 1, 1
    while REPEATS * smallest <= longest:
        near = np.zeros(len(gap) + 2, dtype=np.int8)
        near[1:-1] = gap <= bound
        turn = np.flatnonzero(near[1:] != near[:-1])
        a, b = turn[::2], turn[1::2]
        enough = b - a >= max(LEAST - bound, (REPEATS - 1) * smallest)
        a, b = a[enough], b[enough]
        if len(a):
            a = np.maximum(a - bound, starts[np.searchsorted(starts, a, side="right") - 1])
            np.add.at(cover, a, 1)
            np.add.at(cover, b, -1)
        smallest = bound + 1
        bound += max(1, bound // 2)
    inside = np.cumsum(cover)[:-1] > 0
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    first[starts[starts < len(inside)]] |= inside[starts[starts < len(inside)]]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | first[1:]
    return list(zip(np.flatnonzero(first).tolist(), (np.flatnonzero(last) + 1).tolist()))


def runs_of_many(texts: list[list]) -> list[list[tuple[int, int, int]]]:
    """The runs of each of several word lists."""
    numbers, starts = [], []
    for words in texts:
        starts.append(len(numbers))
        base, known = len(numbers), {}
        numbers += [known.setdefault(w, base + len(known)) for w in words]
    found: list[list] = [[] for _ in texts]
    numbers, starts = np.array(numbers, dtype=np.int64), np.array(starts, dtype=np.int64)
    for a, b in stretches(numbers, starts):
        text = int(np.searchsorted(starts, a, side="right")) - 1
        found[text] += [(a - int(starts[text]) + s, m, p) for s, m, p in runs_of(numbers[a:b])]
    return [sorted(f, key=lambda r: (r[0], r[2])) for f in found]


def collapsed(words: list, runs: list[tuple[int, int, int]]) -> list:
    """The words without what follows the first period of any run."""
    if not runs:
        return words
    change = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    keep = np.cumsum(change)[:-1] == 0
    return [words[i] for i in np.flatnonzero(keep).tolist()]


_RESULT = "n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"


def _digest_rows(keys: list, texts: list[list]) -> Iterator[tuple]:
    for key, words, runs in zip(keys, texts, runs_of_many(texts)):
        best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None, None, None)
        milli = 1000 * best[1] // best[2] if runs else None
        lines = "".join(f"{s},{m},{p}\n" for s, m, p in runs)
        kept = b" ".join(collapsed(words, runs))
        yield key, len(runs), *best, milli, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest()


def run_digests(docs: DataFrame, key: str = "doc_id", text: str = "text", rewrite: bool = False) -> DataFrame:
    """One row per document: its runs, the strongest of them, and the text without repeated periods, as digests.

    ``rewrite`` first repeats the tails of one document in ten, by its id.
    """
    schema = f"{key} long, {_RESULT}"

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [key, *(c.split()[0] for c in _RESULT.split(", "))]
        types = [pa.int64(), *(pa.string() if "sha256" in n else pa.int64() for n in names[1:])]

        def packed(keys: list, texts: list[list]) -> pa.RecordBatch:
            columns = zip(*_digest_rows(keys, texts))
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

        for batch in batches:
            keys, texts, held = [], [], 0
            for doc, value in zip(batch.column(0), batch.column(1)):
                doc = doc.as_py()
                words = (value.as_py() or b"").split()
                keys.append(doc)
                texts.append(rewritten(doc, words) if rewrite else words)
                held += len(words)
                if held >= _BATCH_WORDS or len(keys) >= _BATCH_ROWS:
                    yield packed(keys, texts)
                    keys, texts, held = [], [], 0
            if keys:
                yield packed(keys, texts)

    return docs.select(F.col(key).cast("long").alias(key), F.col(text).cast("binary").alias("t")).mapInArrow(search, schema)


def op12_runs(spark, sf_dir: str) -> DataFrame:
    """Runs of all documents."""
    return run_digests(read_table(spark, sf_dir, "documents"), rewrite=True)

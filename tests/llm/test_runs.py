"""Periodic runs against a plain search of every period; edge cases."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np

from corpusloom.llm import runs


def _plain_runs(words):
    n, found = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i + q - start
            part = words[start : start + length]
            if length >= max(6, 4 * q) and not any(part[:-r] == part[r:] for r in range(1, q)):
                found.append((start, length, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def _plain_row(key, text):
    words = (text or "").encode().split()
    n = len(words)
    h = zlib.crc32(str(key).encode()) if key is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = _plain_runs(words)
    best = sorted(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]))[:1]
    dropped = {i for s, m, p in found for i in range(s + p, s + m)}
    kept = b" ".join(w for i, w in enumerate(words) if i not in dropped)
    lines = "".join(f"{s},{m},{p}\n" for s, m, p in found).encode()
    top = (*best[0], best[0][1] * 1000 // best[0][2]) if best else (None,) * 4
    return (key, len(found), *top, hashlib.sha256(lines).hexdigest(), hashlib.sha256(kept).hexdigest())


def _sequence(rng):
    letters, n = rng.choice([1, 2, 3, 5]), rng.randint(0, 60)
    words = [str(rng.randrange(letters)) for _ in range(n)]
    if rng.random() < 0.6 and n > 3:
        a, p = rng.randrange(n), rng.randint(1, 6)
        words = words[:a] + (words[a : a + p] * 40)[: n - a + rng.randint(0, 20)]
    return words


def test_runs_equal_plain_search():
    rng = random.Random(11)
    for _ in range(600):
        texts = [_sequence(rng) for _ in range(rng.randint(1, 5))]
        assert runs.runs_of_many(texts) == [_plain_runs(t) for t in texts]


def test_tree_ranks_and_common_prefixes():
    rng = random.Random(2)
    for _ in range(60):
        numbers = [rng.randint(1, 3) for _ in range(rng.randint(1, 40))]
        n, tree = len(numbers), runs.SuffixTree(numbers)
        suffixes = [numbers[i:] for i in range(n + 1)]
        assert tree.rank.tolist() == np.argsort(sorted(range(n + 1), key=lambda i: suffixes[i])).tolist()
        inverse = sorted(range(n + 1), key=lambda i: [-x for x in suffixes[i]])
        assert tree.inverse_rank.tolist() == np.argsort(inverse).tolist()
        i, j = np.triu_indices(n + 1, 1)
        same = [next((k for k, (x, y) in enumerate(zip(suffixes[a], suffixes[b])) if x != y), min(n - a, n - b)) for a, b in zip(i, j)]
        assert tree.common(i, j).tolist() == same


def test_query_rows_equal_plain_version(spark):
    rng = random.Random(4)
    texts = [" ".join(_sequence(rng)) for _ in range(300)]
    texts += [None, "", " \t\n\x0b\x0c\r ", "one", "a a a a a", "a a a a a a", "à b " * 9, "x " * 4000 + "end", "no run at all " * 3]
    texts += [" ".join(f"w{i % 997}" for i in range(9000)), " ".join(f"u{i}" for i in range(9000))]
    rows = [(i, t, "clash") for i, t in enumerate(texts)] + [(None, "a b " * 5, "clash"), (3, texts[3], "clash"), (-5, "k l m " * 8, "clash")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_runs string").repartition(5)
    got = sorted((tuple(r) for r in runs.run_digests(df, rewrite=True).collect()), key=str)
    assert got == sorted((_plain_row(k, t) for k, t, _ in rows), key=str)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert runs.run_digests(df).collect() == []

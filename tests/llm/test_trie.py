"""Prefix trie against a plain recursive version; edge cases."""

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest

from corpusloom.llm import trie


def _plain(rows, rebuild=True):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            tie = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own[conv].append(((turn is not None, turn or 0, tie), (role, text)))
    own = {c: [said for _, said in sorted(t)] for c, t in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4 if rebuild else 0
        base = c - int(np.fmod(c, 20))
        built[c] = tuple(own.get(base, [])[:h]) + tuple(turns[h:])
    members = defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    kids = defaultdict(list)
    for node in members:
        if node:
            kids[node[:-1]].append(node)

    def below(node):
        words = len(node[-1][1].encode().split()) if node else 0
        leaves, saved = int(not kids[node]), (len(members[node]) - 1) * words
        for k in kids[node]:
            more = below(k)
            leaves, saved = leaves + more[0], saved + more[1]
        return leaves, saved

    out = []
    for node, inside in members.items():
        ends = sorted(c for c in inside if len(built[c]) == len(node))
        leaves, saved = below(node)
        parent = min(members[node[:-1]]) if node else None
        sha = hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()
        out.append((min(inside), len(node), parent, len(inside), len(kids[node]), leaves, saved, sha))
    return sorted(out, key=lambda r: r[:2])


def _run(spark, rows, rebuild=True):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, words string, path string, base string")
    turns = trie.turn_rows(df)
    found = trie.trie(trie.rebuilt_paths(turns) if rebuild else trie.paths(turns))
    return sorted((tuple(r) for r in found.collect()), key=lambda r: r[:2])


@pytest.fixture(scope="module")
def talks():
    rng = np.random.default_rng(5)
    rows = []
    for c in range(-25, 160):
        hot = c % 3 == 0  # a third of all conversations are the same
        for t in range(6 if hot else int(rng.integers(0, 7))):
            said = f"same {t} words" if hot or rng.random() < 0.4 else f"say {rng.integers(3)}  x\tand\n{t}"
            rows.append((c, t, "user" if t % 2 == 0 else "assistant", said))
    rows += [(300, None, None, None), (300, None, "user", "first"), (300, 1, "user", ""), (301, 2, "user", "a"), (301, 2, "assistant", "a")]
    rows += [(301, 2, "user", "a"), (None, 0, "user", "lost"), (320, 0, "user", "one"), (321, 0, "user", "only head"), (-7, 1, "user", "neg")]
    return [(*r, "clash", "clash", "clash") for r in rows]


@pytest.mark.parametrize("shards", [1, 4, 37])
def test_trie_equals_plain_version(spark, talks, shards):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", shards)
    try:
        assert _run(spark, talks) == _plain([r[:4] for r in talks])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_long_conversations_cross_blocks_and_edges(spark):
    """Paths far deeper than a matrix block, shared beyond the range key, over several shards."""
    rows = []
    for c in range(40):
        for t in range(45):
            rows.append((c, t, "user", "common" if t < 30 + c % 5 else f"own {c % 8} {t}"))
    rows += [(99, t, "user", f"deep {t}") for t in range(300)]
    rows = [(*r, "x", "x", "x") for r in rows]
    assert _run(spark, rows, rebuild=False) == _plain([r[:4] for r in rows], rebuild=False)


def test_many_conversations_end_at_one_node(spark, monkeypatch):
    rows = [(c, 0, "user", "hello there", "x", "x", "x") for c in range(1500)]
    assert _run(spark, rows, rebuild=False) == _plain([r[:4] for r in rows], rebuild=False)


def test_empty_table_has_no_nodes(spark):
    assert _run(spark, []) == []
    assert _run(spark, [(None, 0, "user", "lost", "x", "x", "x")]) == []

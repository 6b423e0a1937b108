"""Repeated strings against a count of every window; edge cases."""

import hashlib
from collections import Counter

import numpy as np
import pytest

from corpusloom.llm import repeats

WIDTH = 64


def _plain(rows, width):
    texts = [(k, (t or "").encode()) for k, t in rows]
    counts = Counter(b[i : i + width] for _, b in texts for i in range(len(b) - width + 1))
    out = []
    for k, b in texts:
        gone = np.zeros(len(b) + 1, dtype=bool)
        for i in range(len(b) - width + 1):
            if counts[b[i : i + width]] > 1:
                gone[i : i + width] = True
        n_spans = int((gone[1:] < gone[:-1]).sum())
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((k, len(b), int(gone.sum()), n_spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def _run(spark, rows, width):
    df = spark.createDataFrame([(*r, "a", "b", 1) for r in rows], "doc_id long, text string, k1 string, kept string, m int").repartition(3)
    found = repeats.remove_repeats(df, width=width, digest=True).collect()
    return sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], len(r["spans"]), r["kept"]) for r in found), key=str)


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(8)
    text = lambda n, letters="abcdefghij é": "".join(rng.choice(list(letters), n))
    base, passage, line = text(900), text(150), text(70)
    out = [(1, None), (2, ""), (3, "short"), (4, "x" * 63), (5, "y" * 64), (6, "z" * 65), (7, "pq" * 60), (None, base), (8, base), (8, base)]
    for k in range(25):  # near copies
        near = list(base)
        for at in rng.integers(0, len(near), 1 + k % 4):
            near[at] = "#"
        out.append((100 + k, "".join(near)))
    for k in range(30):  # a passage and a line between other texts; the line is too short by itself in some
        cut = int(rng.integers(50, 70))
        out.append((200 + k, text(int(rng.integers(0, 200))) + passage[: 150 - k] + text(80) + line[:cut] + text(90)))
    out += [(300, passage + text(40) + passage), (301, text(3000, "ab")), (302, text(2500, "ab")), (303, "w" * 1500), (304, "k" * 700 + text(80))]
    return out


def test_removed_bytes_equal_plain_version(spark, rows):
    assert _run(spark, rows, WIDTH) == _plain(rows, WIDTH)


def test_other_width_and_short_segments(spark, rows, monkeypatch):
    found = _run(spark, rows, 100)
    assert found == _plain(rows, 100)


def test_blocks_cover_all_windows_once_across_segments(monkeypatch):
    data = np.random.default_rng(1).integers(97, 100, 9000).astype(np.uint8).tobytes()
    whole = repeats.blocks(data, 80)
    monkeypatch.setattr(repeats, "_SEGMENT", 700)
    parts = repeats.blocks(data, 80)
    for p, lo, hi, _ in (whole, parts):
        assert np.array_equal(np.concatenate([np.arange(a, b + 1) for a, b in zip(lo, hi)]), np.arange(9000 - 79))
        assert (lo <= p).all() and (hi + 80 >= p + repeats.GRAM).all() and (p - hi >= 0).all()
    at = lambda found: np.repeat(found[0], found[2] - found[1] + 1)
    assert np.array_equal(at(whole), at(parts))  # the minimiser of a window does not depend on the segment


def test_kept_text_and_spans(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for r in repeats.remove_repeats(df, width=WIDTH).collect():
        assert r["n_bytes"] - r["n_removed"] == len(r["kept"])
        assert sum(s["end"] - s["start"] for s in r["spans"]) == r["n_removed"]


def test_hot_passage_with_other_surroundings(spark):
    """A third of all texts share a passage one byte short of the width, others one of the width."""
    rng = np.random.default_rng(3)
    word = lambda n: "".join(rng.choice(list("abcdefgh"), n))
    just, below = word(64), word(63)
    rows = [(k, f"<{k}>{word(70)}[{k}|" + (just if k % 3 == 0 else below if k % 3 == 1 else word(64)) + f"|{k}]{word(70)}") for k in range(600)]
    assert _run(spark, rows, WIDTH) == _plain(rows, WIDTH)


def test_empty_table(spark):
    assert _run(spark, [], WIDTH) == []
    assert _run(spark, [(1, None), (1, None)], WIDTH) == _plain([(1, None), (1, None)], WIDTH)

import re

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import labels as lb
from corpusloom.functions import text as tx
from corpusloom.operators import labelling, rows
from corpusloom.session import local_rows

CASES = [
    None, "", "Hello   World", "see https://a.b/c?d=1 now", "www.x.org/ä end", "a https://x.y next word",
    "don't stop 123", "Ünïcode text", "!!! ...", "Tab\tand\nline",
]


def py_clean(text):
    text = re.sub(r"https?://\S+|www\.\S+", " ", (text or "").lower())
    return " ".join(re.sub(r"[^a-z\s]+", " ", text).split())


def test_clean_matches_python_rules(spark):
    frame = local_rows(spark, list(enumerate(CASES)), "i int, t string")
    got = {r.i: r.c for r in frame.select("i", tx.clean_text(F.col("t")).alias("c")).collect()}
    assert got == {i: py_clean(t) for i, t in enumerate(CASES)}


def test_clean_is_idempotent(spark):
    frame = local_rows(spark, [(t,) for t in CASES if t], "t string").select(tx.clean_text(F.col("t")).alias("c"))
    assert frame.filter(F.col("c") != tx.clean_text(F.col("c"))).count() == 0


def test_shingles_of_short_and_repeating_texts(spark):
    texts = ["", "one", "One  two", "a b c", "a b c a b c a b c", "a b c d"]
    frame = local_rows(spark, list(enumerate(texts)), "i int, t string")
    got = {r.i: sorted(r.s) for r in frame.select("i", tx.shingles(F.col("t")).alias("s")).collect()}
    assert got[0] == [] and got[1] == ["one"] and got[2] == ["one two"] and got[3] == ["a b c"]
    assert got[4] == ["a b c", "b c a", "c a b"] and got[5] == ["a b c", "b c d"]


def test_term_counts(spark):
    frame = local_rows(spark, [(["b", "a", "b", "b"],), ([],)], "t array<string>")
    got = [[(x.term, x.tf) for x in r.c] for r in frame.select(tx.term_counts(F.col("t")).alias("c")).collect()]
    assert sorted(got) == [[], [("a", 1), ("b", 3)]]


def test_looks_english(spark):
    texts = ["plain english text", "1234 !!!", "это русский текст", "ab" + "é" * 2, "x" * 200 + "é" * 500]
    frame = local_rows(spark, list(enumerate(texts)), "i int, t string")
    got = {r.i: r.e for r in frame.select("i", tx.looks_english(F.col("t")).alias("e")).collect()}
    assert got == {0: True, 1: True, 2: False, 3: False, 4: True}


@pytest.mark.parametrize(
    ("kind", "expected"),
    [
        ("binary_numeric", "1100000000"),
        ("mental_health_status", "0000100000"),
        ("urdu_severity", "1100001000"),
    ],
)
def test_label_types(spark, kind, expected):
    values = ["1", "1.9", "x", None, " Depression ", "depression", "3", "nan", "inf", "-1"]
    frame = local_rows(spark, list(enumerate(values)), "i int, v string")
    got = frame.select("i", lb.normalise_label(F.col("v"), kind).alias("y")).orderBy("i").collect()
    assert "".join(r.y for r in got) == expected


def test_unknown_label_type_is_an_error():
    with pytest.raises(ValueError):
        lb.normalise_label(None, "nope")


def test_one_stray_label_changes_the_rule(spark):
    numbers = local_rows(spark, [("1",), ("0",), ("1.0",)], "v string")
    assert sorted(r.y for r in labelling.binary_labels(numbers, "v").collect()) == [0, 1, 1]
    stray = numbers.union(local_rows(spark, [("Depression",)], "v string"))
    assert sorted(r.y for r in labelling.binary_labels(stray, "v").collect()) == [0, 0, 0, 1]
    nulls = numbers.union(local_rows(spark, [(None,)], "v string"))
    assert {r.y for r in labelling.binary_labels(nulls, "v").collect()} == {0}


def test_majority_ties_go_to_the_smallest_label(spark):
    frame = local_rows(spark, [("a", "1"), ("a", "0"), ("b", "1"), ("b", "1"), ("b", "0")], "s string, v string")
    assert {r.s: r.majority for r in labelling.majority_label(frame, "s", "v").collect()} == {"a": "0", "b": "1"}


def test_keep_first_drop_blank(spark):
    frame = local_rows(spark, [(3, "x", " a"), (1, "x", "b "), (2, "", "c"), (4, None, "d")], "k long, t string, l string")
    assert [(r.k, r.l) for r in rows.drop_blank(frame, "t", "l", "k").collect()] == [(1, "b")]


def test_large_and_small_rarest_lists_agree(spark, monkeypatch):
    frame = local_rows(spark, [(1, ["a", "b", "a"]), (2, ["c", "a"]), (3, [])], "d long, w array<string>")
    small = {r.d: r.w for r in rows.drop_rarest(frame, "d", "w", 1).collect()}
    monkeypatch.setattr(rows.settings, "LOCAL_TABLE_ROWS", 0)
    large = {r.d: r.w for r in rows.drop_rarest(frame, "d", "w", 1).collect()}
    assert small == large == {1: ["a", "b", "a"], 2: ["a"], 3: []}

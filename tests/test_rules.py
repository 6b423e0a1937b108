import pytest
from pyspark.sql import functions as F

from corpusloom import settings
from corpusloom.operators import automaton, lexicon, risk, sentiment
from corpusloom.session import local_rows
from corpusloom.streaming.assess_stream import assess_stream

LONG = "i went to the office today and then we had a long meeting about the plan for next week"


def verdict(spark, score, clean=LONG, feeling=0.0, term=0, neg=0, pos=0, raw_len=None, raw=None):
    row = (float(score), clean, float(feeling), float(term), float(neg), float(pos), raw_len or len(clean), raw or clean)
    frame = local_rows(
        spark, [row],
        "score double, clean string, sentiment double, term_hits double, negative_hits double, positive_hits double, raw_len int, raw string",
    ).withColumn("word_count", F.size(F.filter(F.split("clean", " "), lambda t: t != "")))
    out = risk.display_tier(risk.add_cues(frame, "clean", "raw"), F.lit(0.35), F.lit(0.70)).first()
    return out.display_tier, out.model_tier, list(out.flags)


@pytest.mark.parametrize(
    ("kwargs", "expected"),
    [
        # Positive text that is low already carries no override flag.
        (dict(score=0.10, feeling=0.8), ("low", "low", [])),
        # Medium, clearly positive: lowered with a flag.
        (dict(score=0.3753, feeling=0.9082), ("low", "medium", ["positive_context_override"])),
        # Weakly positive stays medium.
        (dict(score=0.40, feeling=0.2), ("medium", "medium", [])),
        # Bounds belong to medium.
        (dict(score=0.35), ("medium", "medium", [])),
        (dict(score=0.70), ("medium", "medium", [])),
        # Very short text is capped.
        (dict(score=0.75, clean="hm"), ("medium", "high", ["short_or_sparse_text", "short_text_cap_high"])),
        # At .88 the cap ends, but the lexicon is still required below .92.
        (dict(score=0.88, clean="hm"), ("medium", "high", ["short_or_sparse_text", "high_tier_requires_lexicon"])),
        (dict(score=0.92), ("high", "high", [])),
        (dict(score=0.80), ("medium", "high", ["high_tier_requires_lexicon"])),
        (dict(score=0.80, term=1), ("high", "high", [])),
        # Crisis wording wins over everything, short or not.
        (dict(score=0.05, clean="i want to kill myself"), ("high", "low", ["short_or_sparse_text", "explicit_crisis_language"])),
        # Two distress cues keep high, one does not.
        (
            dict(score=0.80, feeling=-0.6, clean=LONG + " i feel hopeless and worthless"),
            ("high", "high", ["strong_distress_language"]),
        ),
        (dict(score=0.80, feeling=-0.6, clean=LONG + " i feel hopeless"), ("medium", "high", ["high_tier_requires_lexicon"])),
        # A strong positive may lower even a high score below .90.
        (dict(score=0.85, feeling=0.8, clean=LONG + " happy"), ("low", "high", ["positive_context_override"])),
        (dict(score=0.85, feeling=0.8, clean=LONG + " happy", term=1), ("high", "high", [])),
    ],
)
def test_rule_chain(spark, kwargs, expected):
    assert verdict(spark, **kwargs) == expected


def test_apostrophe_forms_match_the_raw_text(spark):
    clean, raw = LONG + " i don t want to live", LONG + " I don't want to live"
    assert "explicit_crisis_language" not in verdict(spark, 0.1, clean=clean)[2]
    assert "explicit_crisis_language" in verdict(spark, 0.1, clean=clean, raw=raw)[2]


def test_cutoff_sanity(spark):
    frame = local_rows(spark, [(0.044, 0.973), (0.2, 0.8), (0.6, 0.5)], "low double, high double")
    low, high = risk.sane_cutoffs(F.col("low"), F.col("high"))
    assert sorted((r.a, r.b) for r in frame.select(low.alias("a"), high.alias("b")).collect()) == [(0.2, 0.8), (0.35, 0.7), (0.35, 0.7)]


def test_community_names(spark):
    names = local_rows(spark, [("bpd",), ("depression",), ("rarely_used",)], "name string")
    texts = [(1, "posted in r bpd today"), (2, "bpd is hard"), (3, "my depression r depression"), (4, "xr bpdx")]
    got = {
        r.d: (r.mention_word_hits, r.mention_r_hits)
        for r in lexicon.mention_hits(local_rows(spark, texts, "d long, clean string"), "clean", names).collect()
    }
    assert got == {1: (0, 1), 2: (0, 0), 3: (1, 0), 4: (0, 0)}


def test_automata_equal_inline_lexicons(spark, monkeypatch):
    texts = [(1, "the cat sat on the mat r bpd"), (2, "diagnosed with something"), (3, ""), (4, "r depression cat sat")]
    docs = local_rows(spark, texts, "d long, clean string")
    terms = local_rows(spark, [("cat sat",), ("mat",), ("the",)], "t string")
    phrases = local_rows(spark, [("diagnos",), ("at on",), ("at",), ("zz top",)], "p string")
    names = local_rows(spark, [("bpd",), ("depression",)], "n string")

    def run():
        out = lexicon.term_matches(docs, "clean", terms, "a")
        out = lexicon.phrase_matches(out, "clean", phrases, "b")
        out = lexicon.mention_matches(out, "clean", names, "c", "e")
        return sorted((r.d, tuple(r.a), tuple(r.b), tuple(sorted(r.c)), tuple(sorted(r.e))) for r in out.collect())

    inline = run()
    monkeypatch.setattr(settings, "ROW_ENTRIES", 0)
    assert run() == inline
    monkeypatch.setattr(settings, "AUTOMATON_BYTES", 1)
    monkeypatch.setattr(settings, "AUTOMATA_AT_ONCE", 1)
    assert run() == inline and inline[0][2] == ("at", "at on")


def test_expansion_cap_and_short_results(spark):
    patterns = local_rows(spark, [("I was _condition by _doctor",), (" plain  line ",), ("_condition",)], "line string")
    values = [("_condition", i, v) for i, v in enumerate(["seen", "ok"])] + [("_doctor", i, f"dr {i}") for i in range(3)]
    expansions = local_rows(spark, values, "placeholder string, position int, value string")
    every = {r.phrase for r in lexicon.expand(patterns, expansions).collect()}
    assert "i was seen by dr 2" in every and "plain line" in every and "seen" in every and "ok" not in every
    capped = {r.phrase for r in lexicon.expand(patterns, expansions, limit=4).collect()}
    assert "i was ok by dr 0" in capped and "i was ok by dr 1" not in capped


def test_sentiment_rules(spark):
    valence = local_rows(spark, [("good", 1.9), ("bad", -2.5), ("no", -1.2)], "word string, valence double")

    def norm(x):
        return round(x / (x * x + 15) ** 0.5, 4)

    cases = {
        "": 0.0,
        "it is good": norm(1.9),
        "very good": norm(1.9 + 0.293),
        "very very bad": norm(-2.5 - 0.293 - 0.293 * 0.95),
        "not good": norm(1.9 * -0.74),
        "not very good": norm((1.9 + 0.293) * -0.74),
        "barely good": norm(1.9 - 0.293),
        "no good": norm(1.9 * -0.74),
        "good but bad": norm(1.9 * 0.5 - 2.5 * 1.5),
        "it was never so good": norm((1.9 + 0.293) * 1.25 * 1.0),
    }
    frame = local_rows(spark, [(t,) for t in cases], "clean string")
    got = {r.clean: r.sentiment for r in sentiment.compound(frame, "clean", valence).collect()}
    for text, value in cases.items():
        if text == "it was never so good":
            # Both the two-word and the three-word rule apply to "so" right before the word.
            assert got[text] > value
        else:
            assert got[text] == pytest.approx(value, abs=1e-4), text


def test_notes_and_names(spark):
    frame = local_rows(spark, [(["short_or_sparse_text", "other"], "low")], "flags array<string>, tier string")
    row = frame.select(risk.notes(F.col("flags")).alias("n"), risk.named(F.col("tier"), risk.TIER_NAMES).alias("t")).first()
    assert row.n == risk.FLAG_NOTES["short_or_sparse_text"] + risk.NOTE_SEPARATOR + "other" and row.t == "低风险"


def test_stream_equals_batch(spark, tmp_path):
    words = lambda *w: local_rows(spark, [(x,) for x in w], "entry string")
    lex = risk.Lexicons(
        local_rows(spark, [("happy", 2.7), ("sad", -2.1)], "word string, valence double"),
        words("anxiety"), words("feel good"), words("diagnos"), words("bpd"),
    )
    posts = local_rows(
        spark, [(1, "I am happy today, " + LONG, 0.4), (2, "sad and hopeless " + LONG, 0.95), (3, "hi", 0.8)],
        "doc_id long, text string, score double",
    )
    posts.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(posts.schema).parquet(str(tmp_path / "in"))
    query = assess_stream(stream, lex, str(tmp_path / "out"), str(tmp_path / "cp"), once=True)
    query.awaitTermination(120)
    got = {r.doc_id: (r.display_tier, list(r.flags)) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    batch = risk.assess(posts.withColumnRenamed("score", "given"), "text", "given", lex)
    assert got == {r.doc_id: (r.display_tier, list(r.flags)) for r in batch.collect()}
    assert got[1] == ("low", ["positive_context_override"])


def test_many_short_phrases_are_all_matched(spark, monkeypatch):
    monkeypatch.setattr(settings, "ROW_ENTRIES", 0)
    phrases = spark.createDataFrame([(p,) for p in ("a", "bc", "def", "longer", "bcd e")], "phrase string")
    texts = spark.createDataFrame([(1, "abc defg longer"), (2, "xyz"), (3, "bcd e"), (4, "")], "doc int, clean string")
    got = {r["doc"]: r["matches"] for r in lexicon.phrase_matches(texts, "clean", phrases).collect()}
    assert got == {1: ["a", "bc", "def", "longer"], 2: [], 3: ["bc", "bcd e"], 4: []}


def _texts(n, seed=3):
    import random

    rng = random.Random(seed)
    words = ["ab", "abc", "b", "cab", "diagnosed", "with", "a", "ba"]
    return [" ".join(rng.choice(words) for _ in range(rng.randint(0, 700 if i % 9 == 0 else 12))) for i in range(n)]


def test_automaton_equals_containment():
    phrases = ["a", "ab", "b c", "abc ab", "cab", "diagnosed with a", "with", " ab ", "bab", "zz", "b a b a", "d"]
    texts = _texts(200)
    built = automaton.build(phrases)
    found = set(zip(*(x.tolist() for x in automaton.scan(built, [t.encode() for t in texts]))))
    assert found == {(i, j) for i, t in enumerate(texts) for j, p in enumerate(phrases) if p in t}
    assert automaton.scan(automaton.build(["q"]), [b"", b"abc"])[0].size == 0


def test_dealt_automata_stay_below_the_limit():
    phrases = [f"diagnosed with {a}{b} {c}" for a in "abcdefgh" for b in "klmnop" for c in ("today", "again", "once")]
    parts = automaton.deal(phrases, 40_000)
    assert sorted(p for part in parts for p in part) == sorted(phrases) and len(parts) > 1
    for part in parts:
        made = automaton.build(part)
        assert made.move.nbytes + made.phrase.nbytes + made.shorter.nbytes <= 40_000


def test_fifty_thousand_phrases_with_one_beginning(spark):
    """A lexicon whose phrases share a prefix, in texts where that prefix is a third of all words."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    phrases = [f"diagnosed with {a}{b}{c}{d}" for a in letters for b in letters for c in letters for d in "klm"][:50_000]
    texts = [(i, f"diagnosed with {letters[i % 26]}b{letters[i % 7]}k diagnosed with diagnosed") for i in range(300)]
    docs = spark.createDataFrame(texts, "doc int, clean string")
    lexicon_frame = spark.createDataFrame([(p,) for p in phrases], "phrase string")
    got = lexicon.phrase_matches(docs, "clean", lexicon_frame)
    plan = got._jdf.queryExecution().toString()
    assert "Generate" not in plan and "Join" not in plan
    known, rows = set(phrases), got.collect()
    assert sum(len(r["matches"]) for r in rows) > 250
    for r in rows:
        words = r["clean"].split()
        expected = {p for k in range(len(words)) for n in (3, 4) if (p := " ".join(words[k : k + n])) in known}
        assert set(r["matches"]) == expected

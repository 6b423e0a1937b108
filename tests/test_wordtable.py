"""Word tables: broadcast and split look-ups agree; batch counts equal plain counts."""

import random
from collections import Counter

import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from corpusloom import settings
from corpusloom.operators import features, histories, rows, sentiment, wordtable
from corpusloom.session import local_rows


@pytest.fixture(scope="module")
def docs(spark):
    """A third of all tokens are one word; some texts are empty or null."""
    rng = random.Random(4)
    texts = []
    for i in range(120):
        words = [rng.choice(["hot", "hot", f"w{rng.randrange(40)}", f"r{rng.randrange(900)}", "so"]) for _ in range(rng.randrange(0, 60))]
        texts.append((i, words))
    frame = spark.createDataFrame(texts + [(900, []), (901, None)], "doc long, words array<string>").repartition(4)
    return frame, dict(texts) | {900: [], 901: None}


def _table(spark):
    return local_rows(spark, [("hot", 1.5), ("so", None), *((f"r{i}", float(i)) for i in range(0, 900, 3)), (None, 4.0)], "word string, value double")


def test_split_look_up_equals_broadcast(spark, docs, monkeypatch):
    frame, texts = docs
    known = {"hot": 1.5, **{f"r{i}": float(i) for i in range(0, 900, 3)}}
    expected = {i: None if w is None else [known.get(x) for x in w] for i, w in texts.items()}

    def run():
        out = wordtable.word_values(frame, "words", _table(spark), "v", doc=["doc"])
        return {r.doc: r.v for r in out.collect()}

    assert {i: v or [] for i, v in run().items()} == {i: v or [] for i, v in expected.items()}
    monkeypatch.setattr(settings, "LOOKUP_BYTES", 0)
    monkeypatch.setattr(settings, "FREQUENT_WORDS", 8)
    assert {i: v or [] for i, v in run().items()} == {i: v or [] for i, v in expected.items()}
    with pytest.raises(ValueError):
        wordtable.word_values(frame, "words", _table(spark), "v")


def test_frequent_words_never_leave_their_rows(spark, docs, monkeypatch):
    frame, _ = docs
    monkeypatch.setattr(settings, "FREQUENT_WORDS", 3)
    top = [r.word for r in wordtable.frequent_words(frame, "words", ["doc"], 3).collect()]
    assert {"hot", "so"} <= set(top)


def test_mapping_and_rarest_words_in_both_ways(spark, docs, monkeypatch):
    frame, texts = docs
    stems = local_rows(spark, [("hot", "warm"), *((f"r{i}", "rare") for i in range(450))], "token string, stem string")

    def run(k):
        mapped = {r.doc: r.mapped for r in rows.map_tokens(frame, "doc", "words", stems).collect()}
        kept = {r.doc: r.words for r in rows.drop_rarest(frame, "doc", "words", k).collect()}
        return mapped, {i: v or [] for i, v in kept.items()}

    swap = {"hot": "warm", **{f"r{i}": "rare" for i in range(450)}}
    counts = Counter(w for words in texts.values() for w in words or [])
    order = sorted(sorted(counts, reverse=True), key=lambda w: counts[w])
    for k in (1, 40, 333, 10_000):
        gone = set(order[:k])
        expected = (
            {i: " ".join(swap.get(x, x) for x in w or []) for i, w in texts.items()},
            {i: [x for x in w or [] if x not in gone] for i, w in texts.items()},
        )
        assert run(k) == expected
        with monkeypatch.context() as patch:
            patch.setattr(settings, "LOOKUP_BYTES", 0)
            patch.setattr(settings, "LOCAL_TABLE_ROWS", 0)
            assert run(k) == expected


def test_sentiment_takes_a_valence_table_of_any_size(spark, monkeypatch):
    valence = local_rows(spark, [("good", 1.9), ("bad", -2.5), ("no", -1.2), *((f"x{i}", 0.1) for i in range(30_000))], "word string, valence double")
    texts = [(1, "very good"), (2, "not bad at all"), (3, ""), (4, "x7 x29999 no good"), (5, "nothing here")]
    frame = local_rows(spark, texts, "doc long, clean string")
    direct = {r.doc: r.sentiment for r in sentiment.compound(frame, "clean", valence).collect()}
    monkeypatch.setattr(settings, "LOOKUP_BYTES", 0)
    assert {r.doc: r.sentiment for r in sentiment.compound(frame, "clean", valence, doc=["doc"]).collect()} == direct
    assert direct[1] > 0.4 and direct[3] == 0.0 and direct[2] > 0


def _terms(text, ngrams=(1, 2)):
    words = [w for w in text.split(" ") if len(w) >= 2]
    return [" ".join(words[i : i + n]) for n in range(ngrams[0], ngrams[1] + 1) for i in range(len(words) - n + 1)]


def test_batch_counts_equal_plain_counts(spark):
    rng = random.Random(8)
    texts = [" ".join(rng.choice(["aa", "bb", "c", "dd", "ee"]) for _ in range(rng.randrange(0, 30))) for _ in range(90)] + ["", "x"]
    frame = local_rows(spark, list(enumerate(texts)), "doc long, clean string").repartition(3)
    tf, df = Counter(), Counter()
    for t in texts:
        tf.update(_terms(t))
        df.update(set(_terms(t)))
    got = {r.term: (r.tf, r.df) for r in wordtable.text_stats(frame, "clean", (1, 2)).collect()}
    assert got.pop(None) == (0, len(texts)) and got == {t: (tf[t], df[t]) for t in tf}
    pairs = {(r.doc, r.term): r.tf for r in features.term_pairs(frame, "doc", "clean").collect()}
    assert pairs == {(i, t): n for i, text in enumerate(texts) for t, n in Counter(_terms(text)).items()}
    plain = {r.term: (r.tf, r.df) for r in rows.term_stats(frame.select(F.split("clean", " ").alias("w")), "w").collect()}
    assert plain["c"][0] == sum(t.split(" ").count("c") for t in texts)


def test_count_vectors_without_a_hot_key(spark, monkeypatch):
    monkeypatch.setattr(settings, "FREQUENT_WORDS", 2)
    frame = local_rows(spark, [(i, f"hot hot w{i % 7} hot") for i in range(50)], "doc long, clean string")
    got = {(r.doc, r.term): r.tf for r in features.count_terms(frame, "doc", "clean", ngrams=(1, 1)).collect()}
    assert got == {(i, t): n for i in range(50) for t, n in (("hot", 3), (f"w{i % 7}", 1))}
    vocab = features.vocabulary(frame, "clean", None, (1, 1), 1, 1.0)
    assert [r["index"] for r in vocab.orderBy("term").collect()] == list(range(8))


def test_sequences_and_empty_posts_with_large_vocabularies(spark, monkeypatch):
    posts = local_rows(spark, [(1, 0, "Hot day, hot!"), (1, 1, "zzz"), (2, 0, None), (3, 0, "day")], "user long, turn long, text string")
    vocab = local_rows(spark, [("hot", 1), ("day", 2)], "term string, index int")

    def run():
        kept = sorted((r.user, r.turn) for r in histories.drop_empty(posts, "user", "turn", "text", vocab).collect())
        chosen = histories.select_posts(posts, "user", "turn", 2)
        ids = {(r.user, r.slot): list(r.ids) for r in histories.sequences(chosen, "user", "slot", "text", vocab, 3, 2).collect()}
        return kept, ids

    first = run()
    assert first[0] == [(1, 0), (3, 0)] and first[1][(1, 0)] == [1, 2, 1] and first[1][(2, 1)] == [0, 0, 0]
    monkeypatch.setattr(settings, "LOOKUP_BYTES", 0)
    assert run() == first


def test_look_up_in_a_table_larger_than_the_batch(monkeypatch):
    """The keys of a large table are probed, not hashed again for every batch."""
    flat, keys = pa.array(["b", "x", None, "a", "b"]), pa.array([f"k{i}" for i in range(50)] + ["a", "b"])
    seen = []
    index_in = pc.index_in
    monkeypatch.setattr(wordtable.pc, "index_in", lambda values, value_set: seen.append(len(value_set)) or index_in(values, value_set=value_set))
    assert wordtable._found(flat, keys).to_pylist() == [51, None, None, 50, 51] and max(seen) <= len(flat)
    assert wordtable._found(pa.array([], pa.string()), keys).to_pylist() == []


def test_large_batches_are_worked_on_in_parts(spark, monkeypatch):
    """n-grams of a whole Arrow batch are never held at once, and the results do not depend on it."""
    texts = pa.array([f"aa bb w{i}" for i in range(10)] + [None])
    batch = pa.RecordBatch.from_arrays([texts], names=["clean"])
    monkeypatch.setattr(settings, "BATCH_TEXTS", 4)
    assert [p.num_rows for p in wordtable.slices(batch)] == [4, 4, 3]
    sizes = []
    out = wordtable.in_parts(lambda t: sizes.append(len(t)) or pc.utf8_length(t), texts)
    assert sizes == [4, 4, 3] and out.to_pylist() == [8] * 10 + [None]


def test_weights_under_another_index(spark):
    """A fold's vocabulary drops and renumbers terms; weights equal those of a vocabulary read directly."""
    texts = [(0, "aa bb aa cc"), (1, "cc"), (2, ""), (3, "bb aa")]
    frame = local_rows(spark, texts, "doc long, clean string")
    union = local_rows(spark, [("aa", 0), ("bb", 1), ("cc", 2)], "term string, index int")
    own = local_rows(spark, [("bb", 0, 2.0), ("aa", 1, 1.5)], "term string, index int, idf double")
    counted = frame.withColumn("counts", wordtable.index_tf(frame, F.col("clean"), union, (1, 1)))
    got = counted.withColumn("e", wordtable.reindexed_weights(counted, F.col("counts"), [1, 0, -1], [1.5, 2.0, 0.0]))
    direct = frame.withColumn("e", wordtable.index_weights(frame, F.col("clean"), own, (1, 1)))
    rows = lambda df: {r.doc: [(e.i, e.w) for e in r.e] for r in df.collect()}
    assert rows(got) == rows(direct) and rows(direct)[1] == [] and [i for i, _ in rows(direct)[0]] == [0, 1]

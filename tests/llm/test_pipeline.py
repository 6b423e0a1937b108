"""The pipeline's stages against brute force on a small corpus."""

import numpy as np
import pytest

import corpus_pipeline as cp
from corpusloom.llm import near_copies, packing, secrets, simhash
from corpusloom.session import cut_lineage

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = np.random.default_rng(12)
    vocabulary = [f"{a}{b}{c}" for a in "bcdfgl" for b in ("ala", "omi", "eru", "inde") for c in ("n", "s", "t", "")]
    texts: dict[int, str | None] = {}
    for i in range(360):
        words = rng.choice(vocabulary, int(rng.integers(30, 90))).tolist()
        if i % 5 == 0:
            for at in rng.integers(0, len(words), 5):
                words[at] = str(rng.choice(["vilestone", "scumbagger", "idiotical"]))
        texts[i] = " ".join(words)
    item = " ".join(rng.choice(vocabulary, 20))
    texts[1001], texts[1002] = texts[1], texts[2] + " bala"
    texts[1003] = texts[3].replace(" ", "  ")
    texts[1010] = texts[11] + " " + item.upper()
    texts[1011] = " ".join(item.split()[:9])
    texts[1020] = " ".join(reversed(texts[21].split())) + ' password = "abcdefghij12345" end'
    texts |= {1030: None, 1031: "", 1032: " ".join(rng.choice(vocabulary, 30_000))}
    rows = [(i, t, "en", None, None if t is None else len(t)) for i, t in texts.items()]
    path = tmp_path_factory.mktemp("tables")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i % 5 == 0)) for i in range(360)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(7, item), (8, None)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path), texts, item


def _classes(texts):
    """Smallest id that links of five-word Jaccard 0.8 reach, by comparing all pairs."""
    words = {i: (t or "").lower().split() for i, t in texts.items()}
    sets = {i: {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} for i, w in words.items()}
    classes, ids = {i: i for i in texts}, sorted(texts)
    for at, i in enumerate(ids):
        for j in ids[at + 1 :]:
            if classes[i] != classes[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                low, high = sorted((classes[i], classes[j]))
                classes = {k: low if c == high else c for k, c in classes.items()}
    return classes


def test_stages_follow_their_rules(spark, folder):
    path, texts, item = folder
    docs = cp.read_table(spark, path, "documents")
    after = []
    for _, stage in cp.STAGES:
        docs = cut_lineage(stage(spark, docs, path))
        after.append(docs.toPandas())
    kept = [set(frame["doc_id"]) for frame in after]
    toxic = {i for i in range(360) if i % 5 == 0}
    assert len(kept[0] & toxic) <= 0.1 * len(toxic) and len(kept[0] - toxic) >= 0.98 * (len(texts) - len(toxic))
    for frame in after[:4]:
        assert list(frame.columns) == COLUMNS
    classes = _classes({i: texts[i] for i in kept[0]})
    assert kept[1] == {i for i in kept[0] if classes[i] == i}
    assert not kept[1] & {1001, 1003}
    needle = item.lower().split()
    runs = {" ".join(needle[s : s + 10]) for s in range(11)}
    leaks = {i for i in kept[1] if any(f" {r} " in f" {(texts[i] or '').lower()} " for r in runs)}
    assert kept[2] == kept[1] - leaks and 1010 in leaks and 1011 in kept[2]
    clean = after[3].set_index("doc_id")["text"]
    assert kept[3] == kept[2] and all(not secrets.base_spans(t or "") for t in clean)
    assert clean[1020].endswith("[SECRET]\" end") and "abcdefghij12345" not in clean[1020]
    assert set(after[4]["doc_id"]) == kept[3]
    for _, g in after[4].sort_values(["sequence_id", "offset"]).groupby("sequence_id"):
        assert g["offset"].tolist() == [0, *np.cumsum(g["length"])[:-1]] and g["length"].sum() <= packing.CAPACITY


def test_empty_documents_pass_every_stage(spark, folder):
    path, _, _ = folder
    docs = cp.read_table(spark, path, "documents").limit(0)
    for _, stage in cp.STAGES:
        docs = cut_lineage(stage(spark, docs, path))
    assert docs.count() == 0


def test_edited_copies_go_by_five_word_jaccard(spark):
    rng = np.random.default_rng(7)
    vocabulary = [f"w{i}" for i in range(900)]
    texts: dict[int, str | None] = {}
    for i in range(60):
        words = rng.choice(vocabulary, int(rng.integers(60, 200))).tolist()
        texts[10 * i] = " ".join(words)
        for j in range(1, 7):
            edited = list(words)
            for at in rng.integers(0, len(words), j):
                edited[at] = "changed"
            texts[10 * i + j] = " ".join(edited)
    texts |= {9001: "a b", 9002: "A  b", 9003: "a c", 9004: None, 9005: ""}
    classes = _classes(texts)
    rows = [(i, t, "en", None, None) for i, t in texts.items()]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = {r["doc_id"] for r in cp.drop_near_copies(spark, docs, "").collect()}
    assert kept == {i for i in texts if classes[i] == i} and 60 < len(kept) < 300
    prints = {i: simhash.simhash(t) for i, t in texts.items()}
    assert sum(bin(prints[i] ^ prints[classes[i]]).count("1") > 4 for i in texts) > 20  # what four bits cannot link


def test_crowded_band_of_unlike_texts_and_its_few_copies(spark, monkeypatch):
    """Thousands of texts share one band by a common passage, but hardly any are alike."""
    rng = np.random.default_rng(9)
    monkeypatch.setattr(near_copies, "SHARE", 16)
    passage = [f"common{i}" for i in range(60)]
    texts = {}
    for i in range(2500):
        words = passage + [f"u{i}x{k}" for k in range(int(rng.integers(20, 60)))]
        texts[i] = " ".join(words)
    for i in range(0, 60, 3):
        texts[5000 + i] = texts[i] + " one more"
    texts |= {7000: texts[7], 7001: texts[7].upper()}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    docs = docs.unionByName(docs.filter("doc_id = 8"))
    found = near_copies.near_copies(docs).collect()
    assert len(found) == len(texts) + 1
    sets = {i: frozenset(near_copies.shingle_set(t).tolist()) for i, t in texts.items()}
    plain = {i: i for i in texts}
    by_length = sorted(texts, key=lambda i: len(sets[i]))
    for at, i in enumerate(by_length):  # longer sets than 1.25 times cannot be alike
        for j in by_length[at + 1 :]:
            if len(sets[j]) > 1.25 * len(sets[i]):
                break
            if plain[i] != plain[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                low, high = sorted((plain[i], plain[j]))
                plain = {k: low if c == high else c for k, c in plain.items()}
    assert {r["doc_id"]: r["component_id"] for r in found} == plain


def test_near_copies_of_a_repeated_id_and_other_key_types(spark):
    text = "a b c d e f g h i j k l m n o p q r s t u v w x y z"
    rows = [("b", text), ("b", "quite another text of seven words"), (None, text + " end"), ("c", None), ("d", ""), ("b", text)]
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "id string, text string, node int, first int")
    found = sorted(((r["id"], r["component_id"]) for r in near_copies.near_copies(docs, key="id").collect()), key=str)
    assert found == sorted([("b", "b"), ("b", "b"), (None, "b"), ("b", "b"), ("c", "c"), ("d", "c")], key=str)


def test_texts_that_only_share_a_passage_are_not_compared_in_full(spark, monkeypatch):
    """Groups of 40 texts share 60 of 100 words: most pairs meet in a band, but only copies are read."""
    texts = {}
    for g in range(4):
        passage = [f"p{g}x{k}" for k in range(60)]
        for i in range(40):
            texts[100 * g + i] = " ".join(passage + [f"u{g}x{i}x{k}" for k in range(40)])
        texts[100 * g + 50] = texts[100 * g + 7] + " one more"
        texts[100 * g + 51] = texts[100 * g + 50] + " and more"
    compared, linked = [], near_copies._linked
    monkeypatch.setattr(near_copies, "_linked", lambda pairs, *rest: compared.append(pairs.count()) or linked(pairs, *rest))
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = {r["doc_id"]: r["component_id"] for r in near_copies.near_copies(docs).collect()}
    assert found == _classes(texts) and found[51] == 7
    assert 8 <= sum(compared) <= 100


def test_sketches_keep_pairs_at_the_threshold(spark):
    rng = np.random.default_rng(3)
    rows, pairs = [], []
    for i in range(300):  # Jaccard 0.8 and 0.3
        common, own = rng.integers(0, 1 << 64, 240, dtype=np.uint64), rng.integers(0, 1 << 64, 60, dtype=np.uint64)
        far = np.r_[common[:111], rng.integers(0, 1 << 64, 130, dtype=np.uint64)]
        for at, values in enumerate((np.r_[common, own[:30]], np.r_[common, own[30:]], far)):
            rows.append((3 * i + at, 270, near_copies.sketch(near_copies.minima(np.unique(values))).tolist()))
        pairs += [(3 * i, 3 * i + 1), (3 * i, 3 * i + 2)]
    nodes = spark.createDataFrame(rows, "node long, size int, sketch array<long>")
    kept = near_copies._hopeful(spark.createDataFrame(pairs, "a long, b long"), nodes, 0.8).collect()
    assert {(r["a"], r["b"]) for r in kept} == {p for p in pairs if p[1] % 3 == 1}

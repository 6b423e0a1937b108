"""Near duplicates, packing, nearest neighbours against brute force; edge cases."""

import zlib
from itertools import combinations

import numpy as np
import pandas as pd
import pytest
import xxhash
from pyspark.sql import functions as F

from corpusloom.llm import ann, packing, simhash
from corpusloom.llm.components import connected_components

WORDS = [f"w{i}" for i in range(60)]


def _text(rng, n):
    return " ".join(rng.choice(WORDS, n))


@pytest.fixture(scope="module")
def near_docs(spark):
    rng = np.random.default_rng(3)
    rows = [(1, None), (2, ""), (3, " \t\n "), (4, "One two"), (5, "one TWO"), (None, "one two"), (4, "One two")]
    for base in range(6):
        words = _text(rng, 220).split()
        for copy in range(5):
            changed = list(words)
            for at in rng.integers(0, len(words), copy):
                changed[at] = "x" + str(rng.integers(99))
            rows.append((10 + 10 * base + copy, " ".join(changed)))
    rows.append((99, "É " * 9000 + "Tail"))
    return spark.createDataFrame([(i, t, "a", "b") for i, t in rows], "doc_id long, text string, fp string, component_id string")


def _simhash(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in lowered).split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_classes_equal_brute_force(spark, near_docs):
    got = simhash.near_duplicates(near_docs).collect()
    rows = [(r["doc_id"], r["text"]) for r in near_docs.collect()]
    prints = [_simhash(t) for _, t in rows]
    classes = list(range(len(rows)))
    for i, j in combinations(range(len(rows)), 2):
        if bin(prints[i] ^ prints[j]).count("1") <= 4:
            a, b = classes[i], classes[j]
            classes = [min(a, b) if c in (a, b) else c for c in classes]
    want = []
    for i, (doc, _) in enumerate(rows):
        ids = [rows[k][0] for k in range(len(rows)) if classes[k] == classes[i] and rows[k][0] is not None]
        want.append((doc, format(prints[i], "016x"), min(ids)))
    order = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted((tuple(r) for r in got), key=order) == sorted(want, key=order)


def test_simhash_fingerprint_search_is_complete(spark):
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**63, 40, dtype=np.uint64)
    prints = set(base.tolist())
    for value in base:
        for _ in range(12):
            flips = rng.choice(64, int(rng.integers(1, 8)), replace=False)
            prints.add(int(value) ^ int(sum(1 << int(b) for b in flips)))
    prints = sorted(p - (1 << 64) if p >> 63 else p for p in prints)
    distinct = spark.createDataFrame([(p, 1) for p in prints], "fp long, n long")
    roots = {r["node"]: r["root"] for r in connected_components(simhash.links(distinct)).collect()}
    group = {p: i for i, p in enumerate(prints)}
    for a, b in combinations(prints, 2):
        if bin((a ^ b) & (2**64 - 1)).count("1") <= 4:
            x, y = group[a], group[b]
            if x != y:
                group = {p: (x if g == y else g) for p, g in group.items()}
    for a, b in combinations(prints, 2):
        assert (group[a] == group[b]) == (roots.get(a, a) == roots.get(b, b))


def test_thresholds_cover_the_distance():
    spread = np.array([0.2, 0.3, 0.3, 0.2, 0.0])
    for groups in (2, 3, 4):
        _, chosen = simhash.allocate([spread] * groups, [64 // groups] * groups, 1e6, 4)
        assert sum(chosen) == 4 - groups + 1 and min(chosen) >= -1


def test_components_of_a_long_chain_and_no_edges(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(500, 501), (7, 7), (None, 3)], "a long, b long")
    roots = {r["node"]: r["root"] for r in connected_components(chain).collect()}
    assert len({roots[i] for i in range(301)}) == 1 and roots[500] == roots[501] != roots[0]
    assert connected_components(chain.limit(0)).count() == 0


def test_simhash_of_an_empty_table(spark, near_docs):
    assert simhash.near_duplicates(near_docs.limit(0)).count() == 0


def test_packing_round_trip(spark):
    rng = np.random.default_rng(1)
    rows = [(1, None), (2, ""), (3, "x"), (3, "x"), (None, "İ ΑΣ. don't <|endoftext|> a\tb   café,"), (5, "word " * 5000)]
    rows += [(10 + i, _text(rng, int(rng.integers(1, 900)))) for i in range(60)]
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, length int")
    got = packing.pack(packing.pieces(docs)).toPandas()
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing._default_path())
    want = []
    for doc, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        want += [(doc, n, at, len(ids[at : at + 2048]), zlib.crc32(np.array(ids[at : at + 2048], "<u4").tobytes()))
                 for n, at in enumerate(range(0, len(ids), 2048))]
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    clean = lambda rs: sorted(tuple(-1 if v is None or v != v else int(v) for v in r) for r in rs)
    assert clean(got[columns].itertuples(index=False)) == clean(want)
    for _, g in got.sort_values(["sequence_id", "offset"]).groupby("sequence_id"):
        assert g["offset"].tolist() == [0, *np.cumsum(g["length"])[:-1]] and g["length"].sum() <= 2048
    assert got["sequence_id"].nunique() <= -(-got["length"].sum() // 2048) + 1
    assert packing.pack(packing.pieces(docs.limit(0))).count() == 0


def test_pattern_plan_uses_every_piece_once():
    rng = np.random.default_rng(2)
    for most in (10, 100, 2048):
        lengths, counts = np.unique(rng.integers(1, most + 1, 3000), return_counts=True)
        patterns = packing.pack_lengths(dict(zip(lengths.tolist(), counts.tolist())))
        used: dict[int, int] = {}
        for pattern, times in patterns:
            assert sum(pattern) <= 2048 and times > 0
            for x in pattern:
                used[x] = used.get(x, 0) + times
        assert used == dict(zip(lengths.tolist(), counts.tolist()))
        assert sum(n for _, n in patterns) <= 1.012 * -(-int((lengths * counts).sum()) // 2048) + 1
    assert dict(packing.pack_lengths({1000: 2, 600: 1, 448: 1, 1048: 1}))[(1048, 1000)] == 1  # a pair fills exactly
    with pytest.raises(ValueError):
        packing.pack_lengths({4000: 1})


def test_nearest_neighbours_recall_ties_and_bad_vectors(spark):
    rng = np.random.default_rng(4)
    vectors = [(i, rng.normal(size=16).astype(float).tolist()) for i in range(3000)]
    vectors += [(10_000 + i, vectors[0][1]) for i in range(900)]  # one very common vector
    bad = [(20_000, None), (20_100, [0.0] * 16), (20_200, [1.0, None] + [1.0] * 14), (20_300, [float("nan")] * 16),
           (None, vectors[1][1]), (20_400, [1.0, 2.0]), (20_500, [float("inf")] + [1.0] * 15)]
    table = spark.createDataFrame([(i, v, "x") for i, v in vectors + bad], "vec_id long, embedding array<double>, v string")
    got = ann.nearest_neighbours(table, table.filter("vec_id % 100 = 0")).toPandas()
    ids, points = np.array([i for i, _ in vectors]), np.array([v for _, v in vectors])
    asked = [i for i in ids if i % 100 == 0]
    assert sorted(got["query_id"].unique()) == sorted(asked) and len(got) == 10 * len(asked)
    hits = 0
    for q, g in got.sort_values("rank").groupby("query_id"):
        d = np.sqrt(((points - points[np.flatnonzero(ids == q)[0]]) ** 2).sum(axis=1))
        want = [x for x in np.lexsort((ids, d)) if ids[x] != q][:10]
        hits += len({*ids[want]} & {*g["vec_id"]})
        assert g["rank"].tolist() == list(range(1, 11)) and q not in set(g["vec_id"])
        place = {i: n for n, i in enumerate(ids)}
        assert np.allclose(g["score"], d[[place[i] for i in g["vec_id"]]])
        assert sorted(zip(g["score"], g["vec_id"])) == list(zip(g["score"], g["vec_id"]))
        if q >= 10_000:
            assert g["vec_id"].tolist() == ids[want].tolist()
    assert hits / (10 * len(asked)) >= 0.9
    small = table.filter("vec_id < 5")
    assert ann.nearest_neighbours(small, small.filter("vec_id = 0")).count() == 4
    assert ann.nearest_neighbours(table.limit(0), table.limit(0)).count() == 0


def test_probe_reads_every_list_within_the_ratio():
    rng = np.random.default_rng(5)
    index = ann.fit(rng.normal(size=(4000, 64)), 1000)
    most = 0
    for query in rng.normal(size=(20, 64)):
        d = np.sqrt(((index.centroids - query) ** 2).sum(axis=1))
        within = set(np.flatnonzero(d <= (1 + ann.RATIO) * d.min()))
        most = max(most, len(within))
        assert set(index.probe(query, ann.RATIO)) == within
    assert most > ann.BREADTH


def test_small_lists_share_a_bundle_and_large_ones_get_parts():
    got = ann.bundle_lists([(0, 3000), (1, 1000), (3, 97), (4, 9000), (5, 1)])
    assert got == [(0, 0, 1), (1, 0, 1), (3, 1, 1), (4, 2, 3), (5, 3, 1)]

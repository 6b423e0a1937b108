import gzip
import json
import time
from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import quality
from corpusloom.plans import corpus
from corpusloom.session import cut_lineage, local_rows
from corpusloom.sources import manifest, readers, store


def write(path, text, encoding="utf-8"):
    path.write_bytes(text.encode(encoding))
    return str(path)


def test_csv_quotes_newlines_and_empty_cells(spark, tmp_path):
    path = write(tmp_path / "a.csv", 'Text,label\n"two\nlines, ""quoted""",1\n,0\n"",1\n')
    rows = [(r.Text, r.label) for r in readers.read_posts(spark, path).collect()]
    assert rows == [('two\nlines, "quoted"', "1"), (None, "0"), (None, "1")]


def test_csv_encodings(spark, tmp_path):
    latin = write(tmp_path / "l.csv", "text,label\ncafé,1\n", "latin1")
    marked = write(tmp_path / "b.csv", "text,label\ncafé,1\n", "utf-8-sig")
    assert readers.read_posts(spark, latin).first().text == "café"
    frame = readers.read_posts(spark, marked)
    assert frame.columns == ["text", "label"] and frame.first().text == "café"


def test_column_detection():
    assert readers.pick_column(["ID", "Statement", "text"], ("text", "statement")) == "text"
    assert readers.pick_column(["ID", "Statement"], ("text", "statement")) == "Statement"
    assert readers.pick_column(["ID"], ("text",)) is None


def make_folder(tmp_path):
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa".split()

    def text(i, tag):
        return f"{tag} post about {' '.join(words[(i + j) % 10] for j in range(5))} {'x' * (i + 1)}"

    rows = ["clean_text,is_depression"] + [f"{text(i, 'red')},{i % 2}" for i in range(40)]
    rows.append(f"{text(0, 'red')},1")
    write(tmp_path / "r.csv", "\n".join(rows) + "\n")
    rows = ["statement,status"] + [f"{text(i, 'sent')},{'Depression' if i % 3 == 0 else 'Normal'}" for i in range(30)]
    rows.append(f"{text(3, 'red')},Normal")
    write(tmp_path / "alt.csv", "\n".join(rows) + "\n")
    write(tmp_path / "u.csv", "text_english,text_roman,depression_label\n,roman text which is long enough to stay,3\nenglish text which is long enough,other,0\n")
    sources = [
        {"id": "red", "file": "r.csv", "text_column": "clean_text", "label_column": "is_depression", "required": True},
        {"id": "sent", "file": "nope.csv", "alt_files": ["alt.csv"], "text_column": "statement", "label_column": "status", "label_type": "mental_health_status"},
        {"id": "urdu", "file": "u.csv", "text_columns": ["text_english", "text_roman"], "label_column": "depression_label", "label_type": "urdu_severity", "min_chars": 12},
        {"id": "gone", "file": "gone.csv"},
    ]
    write(tmp_path / "sources.json", json.dumps({"sources": sources}, indent=1))


def test_manifest_build_store_and_staleness(spark, tmp_path):
    make_folder(tmp_path)
    specs = manifest.load_manifest(spark, str(tmp_path / "sources.json"))
    status = {r.id: r.status for r in manifest.resolve(spark, specs, str(tmp_path)).collect()}
    assert status == {"red": "loaded", "sent": "loaded", "urdu": "loaded", "gone": "skipped"}
    raw, minimum = manifest.load_sources(spark, specs, str(tmp_path))
    raw = cut_lineage(raw)
    urdu = {r.text_raw[:7]: r.label_raw for r in raw.filter("source_id = 'urdu'").collect()}
    assert urdu == {"roman t": "1", "english": "0"}
    samples = cut_lineage(corpus.build_samples(raw, "row_key", min_chars_by_source=minimum))
    counts = {r.source_id: r["count"] for r in samples.groupBy("source_id").count().collect()}
    # One repeated text inside the first source, one across sources: the first source keeps it.
    assert counts == {"red": 40, "sent": 30, "urdu": 2}
    shared = quality.leakage(samples, "text_fingerprint", "split_name").agg(F.sum("n_shared")).first()[0]
    assert shared == 0
    path = str(tmp_path / "store")
    assert store.is_stale(spark, path, manifest.resolve(spark, specs, str(tmp_path)))
    store.write_samples(samples, path, "row_key")
    resolved = manifest.resolve(spark, specs, str(tmp_path))
    assert not store.is_stale(spark, path, resolved)
    old = datetime.fromtimestamp(time.time() - 3600, UTC)
    store.write_samples(samples, path, "row_key", created_at=old)
    assert store.is_stale(spark, path, resolved)
    test = store.read_samples(spark, path, "test", ordered=True)
    assert test.count() == samples.filter("split_name = 'test'").count()
    assert "PartitionFilters: [isnotnull(split_name" in test._jdf.queryExecution().toString()
    store.export_splits(samples, str(tmp_path / "export"))
    bundle = readers.load_bundle(spark, str(tmp_path / "export"))
    assert bundle.val is not None and bundle.train.count() == samples.filter("split_name = 'train'").count()
    assert readers.load_bundle(spark, str(tmp_path), store=path).note.startswith("store")


def test_required_source_missing(spark, tmp_path):
    write(tmp_path / "sources.json", json.dumps({"sources": [{"id": "a", "file": "a.csv", "required": True}]}))
    with pytest.raises(FileNotFoundError):
        manifest.load_sources(spark, manifest.load_manifest(spark, str(tmp_path / "sources.json")), str(tmp_path))


def test_pair_and_single_layouts(spark, tmp_path):
    rows = ["post,class"] + [f"text number {i},{i % 2}" for i in range(20)]
    write(tmp_path / "one.csv", "\n".join(rows) + "\n")
    single = readers.load_bundle(spark, str(tmp_path), single="one.csv")
    assert (single.train.count(), single.test.count()) == (16, 4)
    pair = readers.load_bundle(spark, str(tmp_path), pair=("one.csv", "one.csv"))
    assert pair.train.count() == 20
    with pytest.raises(FileNotFoundError):
        readers.load_bundle(spark, str(tmp_path))


def test_meta_upsert(spark, tmp_path):
    path = str(tmp_path / "meta")
    assert store.read_meta(spark, path).count() == 0
    store.write_meta(spark, path, "stats", local_rows(spark, [(1, "a")], "n int, s string"))
    time.sleep(0.01)
    store.write_meta(spark, path, "stats", local_rows(spark, [(2, "b")], "n int, s string"))
    store.write_meta(spark, path, "note", "text")
    got = {r.key: r.value for r in store.read_meta(spark, path).collect()}
    assert json.loads(got["stats"]) == {"n": 2, "s": "b"} and got["note"] == "text"


def test_gzip_histories(spark, tmp_path):
    lines = [
        [{"label": "control", "posts": [["2020", "a"], ["2021", "b"]]}],
        [{"label": None, "posts": [["2020", "skip"]]}],
        [{"label": "depression", "posts": [["2020", "c"]]}],
    ]
    path = tmp_path / "h.gz"
    path.write_bytes(gzip.compress("\n".join(json.dumps(x) for x in lines).encode()))
    rows = store.read_histories(spark, str(path)).orderBy("user_id", "position").collect()
    assert [(r.y, r.position, r.text) for r in rows] == [(0, 0, "a"), (0, 1, "b"), (1, 0, "c")]
    path.write_bytes(gzip.compress(json.dumps([{"label": "odd", "posts": [["1", "x"]]}]).encode()))
    with pytest.raises(Exception, match="unknown label"):
        store.read_histories(spark, str(path)).collect()


def test_synthetic_corpus(spark):
    got = store.synthetic_corpus(spark, 40).groupBy("status", "held_out").count().collect()
    assert {(r.status, r.held_out): r["count"] for r in got} == {
        ("Depression", False): 30, ("Depression", True): 10, ("Normal", False): 30, ("Normal", True): 10,
    }


def test_reports(spark, tmp_path):
    rows = local_rows(spark, [("a", "f1", 0.5), ("a", "f2", 0.6)], "model string, metric string, value double")
    store.write_report(rows, str(tmp_path / "r"))
    wide = spark.read.csv(str(tmp_path / "r" / "metrics.csv"), header=True).first()
    assert (wide.model, wide.f1, wide.f2) == ("a", "0.5", "0.6")
    store.write_nested_report(rows, str(tmp_path / "n"), "model")
    assert spark.read.json(str(tmp_path / "n")).first().metrics.f2 == 0.6


def test_exact_digest_and_its_limit(spark, monkeypatch):
    import hashlib

    frame = local_rows(spark, [("b",), ("a",)], "fp string")
    assert quality.dataset_fingerprint_exact(frame, "fp").first()[0] == hashlib.sha256(b"a\nb").hexdigest()
    monkeypatch.setattr(quality.settings, "EXACT_DIGEST_ROWS", 1)
    with pytest.raises(ValueError):
        quality.dataset_fingerprint_exact(frame, "fp")


def test_encoding_is_chosen_per_file(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("text,label\ncaf\u00e9 \ufffd ok,1\n".encode())
    (tmp_path / "b.csv").write_bytes("text,label\ncaf\u00e9,0\n".encode("latin-1"))
    rows = {r["label"]: r["text"] for r in readers.read_posts(spark, str(tmp_path)).collect()}
    assert rows == {"1": "caf\u00e9 \ufffd ok", "0": "caf\u00e9"}
    one = readers.read_posts(spark, str(tmp_path / "a.csv"), multi_line=False).collect()
    assert [r["text"] for r in one] == ["caf\u00e9 \ufffd ok"]


def test_only_files_with_open_quotes_are_read_whole(spark, tmp_path):
    (tmp_path / "plain.csv").write_text('text,label\n"one, two",a\n"say ""hi""",b\n', encoding="utf-8")
    (tmp_path / "broken.csv").write_text('text,label\n"first\nsecond",c\n', encoding="utf-8")
    rows = {r["label"]: r["text"] for r in readers.read_posts(spark, str(tmp_path)).collect()}
    assert rows == {"a": "one, two", "b": 'say "hi"', "c": "first\nsecond"}
    known = readers.read_posts(spark, str(tmp_path / "plain.csv"), multi_line=False, encoding="UTF-8")
    assert known.count() == 2


def test_too_few_merged_rows_are_an_error(spark):
    frame = spark.range(19).toDF("x")
    with pytest.raises(ValueError, match="only 19 rows"):
        manifest.require_rows(frame)
    assert manifest.require_rows(spark.range(20).toDF("x")).count() == 20


def test_export_writes_every_split_from_one_read(spark, tmp_path):
    rows = [("t1", "a", "train"), ("t2", "b", "train"), ("v1", "a", "val"), ("x", "a", "other")]
    frame = spark.createDataFrame(rows, "text_raw string, label_raw string, split_name string")
    for _ in range(2):  # a second export replaces the first
        store.export_splits(frame, str(tmp_path / "out"))
    count = lambda name: readers.read_posts(spark, str(tmp_path / "out" / f"{name}.csv")).count()
    assert (count("train"), count("val"), count("test")) == (2, 1, 0)
    assert sorted(p.name for p in (tmp_path / "out").iterdir()) == ["test.csv", "train.csv", "val.csv"]

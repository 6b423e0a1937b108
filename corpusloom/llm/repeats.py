"""Removal of byte strings that occur more than once, by refining buckets of text positions.

Every start of a ``width``-byte window is a suffix to be sorted to depth ``width``; starts whose bucket at that depth
holds two or more are repeated. Buckets are refined as in bucket-pointer sorting, but blocks of neighbouring
starts move together as long as one identifier decides them all:

1. Texts of ``width`` bytes or more are reduced to one row per distinct text with its number of copies, in a table bucketed
   by text, so that later joins by text move no text.
2. Initial buckets are q-grams: the windows of a text are cut into blocks by their minimiser, the ``GRAM`` bytes of
   smallest hash in the window (the leftmost of equal ones). Equal windows have equal minimisers at equal places.
3. A block's class is the 128-bit identifier of all bytes its windows cover. A class that counts two or more
   is repeated as a whole. A bucket with one class is decided.
4. Only classes that share a bucket with other classes are refined: their blocks are cut into pieces by the distance of
   the window's start to the minimiser (``PIECES``, down to single windows). The new bucket of a piece is the identifier of the
   later offsets that all its windows cover, its class again the identifier of everything they cover. The same step is
   applied to its own result until a piece is one window; there class and bucket are the window.

Classes are counted with partial sums, so a passage in a third of all texts arrives as one row per task; nothing gathers the
members of a bucket. Text identifiers and classes are 128-bit hashes.

Defined results: null counts as the empty text; shorter texts stay as they are; exact copies of a long enough text are removed
whole; a repeated row is a copy. A text is one row.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import shared_folder
from .common import cut_lineage, drop_step, read_table

WIDTH = 400
GRAM = 32
PIECES = (32, 4, 1)
BUCKET_BYTES = 32 << 20
_SEGMENT = 1 << 20
_PLACE_BITS = np.uint64(21)
_LOW = np.uint64((1 << 21) - 1)
_FACTORS = np.random.default_rng(13).integers(0, 1 << 64, GRAM // 8, dtype=np.uint64) | np.uint64(1)
_SHIFT = np.uint64(29)
_ROWS_OUT = 1 << 16
_EMPTY = hashlib.sha256(b"").hexdigest()
_BLOCK = "k1 long, k2 long, m long, p int, lo int, hi int, bucket long, c1 long, c2 long"
_BLOCK_FIELDS = pa.schema([(c.split()[0], pa.int64() if c.endswith("long") else pa.int32()) for c in _BLOCK.split(", ")])


def gram_hashes(data: bytes) -> np.ndarray:
    """64-bit hash of the ``GRAM`` bytes at every place."""
    words = np.ndarray((len(data) - 7,), dtype="<u8", buffer=data, strides=(1,))
    n = len(data) - GRAM + 1
    mixed = words[:n] * _FACTORS[0]
    for k in range(1, GRAM // 8):
        mixed ^= mixed >> _SHIFT
        mixed += words[8 * k : 8 * k + n]
        mixed *= _FACTORS[k]
    mixed ^= mixed >> _SHIFT
    return mixed


def blocks(data: bytes, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(p, lo, hi, gram hash): windows lo..hi have their minimiser at p; long texts in segments."""
    span, found = width - GRAM + 1, []
    for base in range(0, len(data) - width + 1, _SEGMENT):
        part = data[base : base + _SEGMENT + width - 1]
        hashes = gram_hashes(part)
        n = len(part) - width + 1
        key = (hashes >> _PLACE_BITS << _PLACE_BITS) | np.arange(len(hashes), dtype=np.uint64)
        rows = np.full(-(-len(key) // span) * span, np.iinfo(np.uint64).max)
        rows[: len(key)] = key
        rows = rows.reshape(-1, span)
        after = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
        before = np.minimum.accumulate(rows, axis=1).ravel()
        least = np.minimum(after[:n], before[span - 1 : span - 1 + n])
        turn = np.flatnonzero(least[1:] != least[:-1]) + 1
        lo, hi = np.r_[0, turn], np.r_[turn, n] - 1
        place = (least[lo] & _LOW).astype(np.int64)
        found.append((place + base, lo + base, hi + base, hashes[place].view(np.int64)))
    return tuple(np.concatenate(x) for x in zip(*found))


def _wide(parts: list[bytes]) -> np.ndarray:
    """128-bit identifiers as two columns."""
    return np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, parts)), dtype="<i8").reshape(-1, 2)


def pieces(data: memoryview, p: int, lo: int, hi: int, size: int, width: int) -> Iterator[tuple[int, int, memoryview, memoryview]]:
    """(lo, hi, common bytes, covered bytes) of a block's pieces of at most ``size`` windows.

    The grid counts distances from p, so equal windows fall in pieces at equal places.
    """
    for t in range((p - hi) // size, (p - lo) // size + 1):
        a, b = max(lo, p - t * size - size + 1), min(hi, p - t * size)
        yield a, b, data[p - t * size : p + width - t * size - size + 1], data[a : b + width]


def _out(columns: list) -> Iterator[pa.RecordBatch]:
    whole = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _BLOCK_FIELDS)], schema=_BLOCK_FIELDS)
    for a in range(0, whole.num_rows, _ROWS_OUT):
        yield whole.slice(a, _ROWS_OUT)


def _first_blocks(width: int) -> Callable:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: list[list] = [[] for _ in _BLOCK_FIELDS]
            for k1, k2, m, data in zip(*(batch.column(c).to_pylist() for c in ("k1", "k2", "m")), batch.column("text")):
                data = data.as_py()
                p, lo, hi, gram = blocks(data, width)
                view = memoryview(data)
                wide = _wide([view[a : b + width] for a, b in zip(lo.tolist(), hi.tolist())])
                for column, values in zip(held, ([k1] * len(p), [k2] * len(p), [m] * len(p), p, lo, hi, gram, wide[:, 0], wide[:, 1])):
                    column.append(values)
                if sum(map(len, held[0])) >= _ROWS_OUT:
                    yield from _out([np.concatenate(c) for c in held])
                    held = [[] for _ in _BLOCK_FIELDS]
            if held[0]:
                yield from _out([np.concatenate(c) for c in held])

    return cut


def _finer_blocks(width: int, size: int) -> Callable:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def packed() -> Iterator[pa.RecordBatch]:
            wide = _wide(covered)
            # a single window is its own bucket
            bucket = [xxhash.xxh3_64_intdigest(c, seed=t) for t, c in shared] if size > 1 else wide[:, 0].view(np.uint64)
            yield from _out([*zip(*rows), np.array(bucket, dtype=np.uint64).view(np.int64), wide[:, 0], wide[:, 1]])

        rows, shared, covered = [], [], []
        for batch in batches:
            for k1, k2, data, known in zip(batch.column("k1").to_pylist(), batch.column("k2").to_pylist(), batch.column("text"), batch.column("known").to_pylist()):
                view = memoryview(data.as_py())
                for block in known:
                    p = block["p"]
                    for a, b, common, cover in pieces(view, p, block["lo"], block["hi"], size, width):
                        rows.append((k1, k2, block["m"], p, a, b))
                        shared.append(((p - b) // size, common))
                        covered.append(cover)
                if len(rows) >= _ROWS_OUT:
                    yield from packed()
                    rows, shared, covered = [], [], []
        if rows:
            yield from packed()

    return cut


class _Texts:
    """Distinct long texts with their copies, bucketed by text in the shared folder."""

    def __init__(self, docs: DataFrame, text: str, width: int):
        spark = docs.sparkSession
        held = docs.select(*text_key(F.col(text)), _bytes(F.col(text)).alias("text")).filter(F.octet_length("text") >= width)
        size = docs.agg(F.sum(F.octet_length(_bytes(F.col(text))))).first()[0] or 0
        tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.parts = tasks * max(1, -(-size // (tasks * BUCKET_BYTES)))  # a multiple: every bucket is written by one task
        self.name = f"texts_{uuid.uuid4().hex}"
        distinct = held.groupBy("k1", "k2").agg(F.first("text").alias("text"), F.count("*").alias("m"))
        distinct.write.bucketBy(self.parts, "k1", "k2").option("path", f"{shared_folder(spark)}/step-{self.name}").saveAsTable(self.name)
        self.frame = spark.table(self.name)

    def with_rows(self, rows: DataFrame, columns: tuple[str, ...], name: str) -> DataFrame:
        """Texts that have ``rows`` (k1, k2, ...), with these as a list; only the rows are shuffled."""
        lists = rows.repartition(self.parts, "k1", "k2").groupBy("k1", "k2").agg(F.collect_list(F.struct(*columns)).alias(name))
        return self.frame.join(lists, ["k1", "k2"])

    def drop(self) -> None:
        drop_step(self.frame)
        self.frame.sparkSession.sql(f"DROP TABLE IF EXISTS {self.name}")


def _bytes(text: Column) -> Column:
    return F.coalesce(text, F.lit("")).cast("binary")


def text_key(text: Column) -> list[Column]:
    """Two 64-bit hashes that name a text."""
    return [F.xxhash64(_bytes(text)).alias("k1"), F.xxhash64(F.lit(13), _bytes(text)).alias("k2")]


def repeated_windows(texts: _Texts, width: int) -> DataFrame:
    """k1, k2, lo, hi: starts of windows that occur again, for texts without copies."""
    found = []
    items = cut_lineage(texts.frame.mapInArrow(_first_blocks(width), _BLOCK))
    for size in (*PIECES, None):
        classes = cut_lineage(items.groupBy("bucket", "c1", "c2").agg(
            F.sum("m").alias("m"), *(F.first(c).alias(c) for c in ("k1", "k2", "p", "lo", "hi"))
        ))
        repeated = classes.filter("m > 1").select("bucket", "c1", "c2")
        inside = items.filter("m = 1").join(repeated, ["bucket", "c1", "c2"], "left_semi")
        found.append(cut_lineage(inside.select("k1", "k2", "lo", "hi")))
        drop_step(items)
        if size is None:
            drop_step(classes)
            break
        crowded = classes.groupBy("bucket").agg(F.count("*").alias("n"), F.min("m").alias("least")).filter("n > 1 and least = 1")
        open_ = classes.join(crowded, "bucket", "left_semi").select("k1", "k2", "m", "p", "lo", "hi")
        listed = texts.with_rows(open_, ("m", "p", "lo", "hi"), "known").select("k1", "k2", "text", "known")
        items = cut_lineage(listed.mapInArrow(_finer_blocks(width, size), _BLOCK))
        drop_step(classes)
    whole = found[0]
    for part in found[1:]:
        whole = whole.unionByName(part)
    return whole


def merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal stretches covered by [start, end); stretches that touch are one."""
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(ends[order])
    first = np.r_[True, starts[1:] > reach[:-1]] if len(starts) else np.empty(0, dtype=bool)
    at = np.flatnonzero(first)
    return starts[at], reach[np.r_[at[1:], len(starts)] - 1] if len(at) else reach


def _removed(width: int) -> Callable:
    fields = pa.schema([
        ("k1", pa.int64()), ("k2", pa.int64()), ("n_removed", pa.int64()),
        ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("kept", pa.binary()),
    ])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, held = [], 0
            for k1, k2, data, windows in zip(batch.column("k1").to_pylist(), batch.column("k2").to_pylist(), batch.column("text"), batch.column("windows")):
                data = data.as_py()
                lo, hi = (windows.values.field(c).to_numpy().astype(np.int64) for c in ("lo", "hi"))
                starts, ends = merged(lo, hi + width)
                spans = list(zip(starts.tolist(), ends.tolist()))
                kept = b"".join(data[a:b] for a, b in zip([0, *ends.tolist()], [*starts.tolist(), len(data)]))
                rows.append((k1, k2, len(data) - len(kept), [{"start": a, "end": b} for a, b in spans], kept))
                held += len(kept)
                if held >= 8 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), fields)], schema=fields)
                    rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), fields)], schema=fields)

    return cut


_REMOVED = "k1 long, k2 long, n_removed long, spans array<struct<start: long, end: long>>, kept binary"


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH, digest: bool = False) -> DataFrame:
    """One row per row of ``docs``: key, n_bytes, n_removed, spans (start, end in bytes) and kept, the bytes left.

    ``digest`` replaces kept by its SHA-256, so that texts without repeats are not moved for the result.
    """
    if width < 2 * GRAM:
        raise ValueError(f"strings of {2 * GRAM} bytes or more are needed")
    texts = _Texts(docs, text, width)
    windows = repeated_windows(texts, width)
    singles = texts.with_rows(windows, ("lo", "hi"), "windows").select("k1", "k2", "text", "windows")
    left = singles.mapInArrow(_removed(width), _REMOVED)
    final = F.sha2("kept", 256).alias("kept") if digest else F.col("kept")
    left = left.select("k1", "k2", "n_removed", "spans", final)
    size = F.octet_length("text").cast("long")
    all_of_it = F.array(F.struct(F.lit(0).cast("long").alias("start"), size.alias("end")))
    copies = texts.frame.filter("m > 1").select(
        "k1", "k2", size.alias("n_removed"), all_of_it.alias("spans"), (F.lit(_EMPTY) if digest else F.lit(b"")).alias("kept")
    )
    changed = cut_lineage(left.unionByName(copies))
    drop_step(windows)
    texts.drop()
    data = _bytes(F.col(text))
    same = (F.sha2(data, 256) if digest else data).alias("same")
    rows = docs.select(F.col(key).alias("doc"), *text_key(F.col(text)), F.octet_length(data).cast("long").alias("n_bytes"), same)
    return rows.join(changed, ["k1", "k2"], "left").select(
        F.col("doc").alias(key), "n_bytes", F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"),
        F.coalesce("spans", F.array().cast("array<struct<start: bigint, end: bigint>>")).alias("spans"),
        F.coalesce("kept", "same").alias("kept"),
    )


# Strings of 800 hex digits stand for 400 bytes; every start of every document is one row.
SQL = """
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, lower(hex(encode(coalesce(text, '')))) AS x FROM documents
), sized AS (
  SELECT *, (length(x) // 2)::BIGINT AS n FROM docs
), starts AS (
  SELECT r, i, md5_number(substr(x, (2 * i + 1)::BIGINT, 800)) AS w FROM sized, LATERAL (SELECT unnest(range(0, n - 399)) AS i)
), often AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY w) AS c FROM starts) WHERE c > 1
), marked AS (
  SELECT r, i, CASE WHEN i - lag(i) OVER (PARTITION BY r ORDER BY i) <= 400 THEN 0 ELSE 1 END AS fresh FROM often
), numbered AS (
  SELECT r, i, sum(fresh) OVER (PARTITION BY r ORDER BY i) AS g FROM marked
), spans AS (
  SELECT r, g, min(i) AS a, max(i) + 400 AS b FROM numbered GROUP BY r, g
), between_ AS (
  SELECT r, a, b, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS from_ FROM spans
), joined AS (
  SELECT s.r, sum(b - a) AS n_removed, count(*) AS n_spans, max(b) AS last,
    string_agg(substr(x, (2 * from_ + 1)::BIGINT, (2 * (a - from_))::BIGINT), '' ORDER BY a) AS kept
  FROM between_ b JOIN sized s USING (r) GROUP BY s.r
)
SELECT doc_id, n AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
  sha256(unhex(coalesce(kept, '') || substr(x, (2 * coalesce(last, 0) + 1)::BIGINT))) AS kept_sha256
FROM sized LEFT JOIN joined USING (r)
"""


def op13_repeats(spark, sf_dir: str) -> DataFrame:
    """Repeated 400-byte strings of all documents, removed."""
    rows = remove_repeats(read_table(spark, sf_dir, "documents"), digest=True)
    return rows.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.col("kept").alias("kept_sha256"))

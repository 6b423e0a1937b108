"""Prefix trie of conversations from padded turn-id matrices.

1. Every turn becomes a 128-bit id of role and text; texts are never shuffled. A conversation is one row:
   its ids joined to a binary path, and the word count of every turn.
2. Paths are range-partitioned by their first ``EDGE_TURNS`` turns and the conversation id, so that a shard
   holds a contiguous part of the sorted order, and a path shared by many conversations spreads over shards.
3. Within a shard, blocks of ``BLOCK`` columns of the padded id matrix are sorted with ``numpy.lexsort``. The
   masks where a column differs from the row above, accumulated over columns by OR, mark the first row
   of every node of a depth; ``reduceat`` over these starts aggregates the nodes of that depth.
4. Nodes on the first or last path of a shard may continue in other shards. Only these go on as partial rows:
   they are combined by a digest of their path, and subtree sums climb them by doubling ancestors. What a
   shard knows in full below such a node is added as one number.
5. The sorted ids of conversations ending at a shared node arrive as joined chunks and are hashed in order, so a
   task reads rows of ``END_IDS`` ids and holds one at a time.

Defined results: null role or text counts as empty; turns are ordered by turn (null first), equal turns by the
digest of role and text, repeated turns stay; rows without a conversation id take no part; an empty table has no nodes, not even
a root. One conversation is one row, so its length is bounded by a row's size.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut_lineage, read_table

BLOCK = 16
EDGE_TURNS = 16
SHARD_ROWS = 20_000
END_IDS = 512
_SALTS = 16
_ID_BYTES = 16
_NO_ENDS = hashlib.sha256(b"").hexdigest()
_COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
_PART = (
    "kind int, key binary, parent_key binary, depth long, conv_id long, parent_conv_id long, n_convs long, "
    "n_children long, n_leaves long, saved_tokens long, words long, ends_sha256 string, ends binary"
)
_FIELDS = pa.schema([
    ("kind", pa.int32()), ("key", pa.binary()), ("parent_key", pa.binary()), ("depth", pa.int64()), ("conv_id", pa.int64()),
    ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()),
    ("saved_tokens", pa.int64()), ("words", pa.int64()), ("ends_sha256", pa.string()), ("ends", pa.binary()),
])
_WHOLE, _UNDER_EDGE, _EDGE, _ENDS = range(4)


def turn_rows(
    rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """conv_id, turn, id (32 hex digits of role and text), words; rows without conversation left out."""
    said, by = F.coalesce(F.col(text).cast("string"), F.lit("")), F.coalesce(F.col(role).cast("string"), F.lit(""))
    digest = F.md5(F.concat(F.length(by).cast("string"), F.lit(":"), by, said))
    words = F.regexp_count(said, F.lit(r"[^\x20\x09-\x0D]+")).cast("int")
    picked = rows.filter(F.col(conv).isNotNull())
    return picked.select(F.col(conv).cast("long").alias("conv_id"), F.col(turn).cast("long").alias("turn"), digest.alias("id"), words.alias("words"))


def _gathered(key: list[str], turns: DataFrame) -> DataFrame:
    return turns.groupBy(*key).agg(F.sort_array(F.collect_list(F.struct("turn", "id", "words"))).alias("turns"))


def _path(turns: Column) -> list[Column]:
    ids = F.transform(turns, lambda t: t["id"])
    return [F.unhex(F.array_join(ids, "")).alias("path"), F.transform(turns, lambda t: t["words"]).alias("words")]


def paths(turns: DataFrame) -> DataFrame:
    """conv_id, path (16 bytes a turn), words (one count a turn) of the conversations as they are."""
    return _gathered(["conv_id"], turns).select("conv_id", *_path(F.col("turns")))


def rebuilt_paths(turns: DataFrame, every: int = 20, heads: int = 4) -> DataFrame:
    """Paths after rebuilding: conversation c takes its first h turns from c - c % every, h = crc32(c) % heads.

    One shuffle places the conversations of a base together; ``every`` bounds their number.
    """
    base = F.col("conv_id") - F.col("conv_id") % every
    placed = turns.withColumn("base", base).repartition("base")
    own = _gathered(["base", "conv_id"], placed)
    head = F.max(F.when(F.col("conv_id") == F.col("base"), F.slice("turns", 1, heads - 1))).over(Window.partitionBy("base"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).cast("int")
    given = own.withColumn("head", F.coalesce(head, F.expr("filter(turns, t -> false)"))).withColumn("h", h)
    rest = F.filter("turns", lambda t, i: i >= F.col("h"))
    taken = F.filter("head", lambda t, i: i < F.col("h"))
    return given.select("conv_id", *_path(F.concat(taken, rest)))


def _dense(ids: np.ndarray) -> np.ndarray:
    """Numbers from 1 for 16-byte ids, in the order of their bytes; 0 is left for padding."""
    halves = np.ascontiguousarray(ids).view(">u8").reshape(-1, 2).astype(np.uint64)
    order = np.lexsort((halves[:, 1], halves[:, 0]))
    changed = np.ones(len(order), dtype=np.int64)
    changed[1:] = (halves[order[1:]] != halves[order[:-1]]).any(axis=1)
    dense = np.empty(len(order), dtype=np.int64)
    dense[order] = np.cumsum(changed)
    return dense


def shard_levels(conv: np.ndarray, starts: np.ndarray, lengths: np.ndarray, dense: np.ndarray, words: np.ndarray) -> list[dict]:
    """Nodes of every depth in a shard's rows, in sorted order.

    Arrays per depth: first (a row of the node), conv (smallest id), n, words, parent (place in the depth above), edge (on the first
    or last path), ends (rows that stop here, by node and id) and at (their nodes).
    """
    n = len(conv)
    node_of = np.zeros(n, dtype=np.int64)
    stopped = np.flatnonzero(lengths == 0)
    stopped = stopped[np.argsort(conv[stopped], kind="stable")]
    none = np.zeros(1, dtype=np.int64)
    levels = [{
        "first": none, "conv": np.array([conv.min()]), "n": np.array([n]), "words": none, "parent": none - 1,
        "edge": np.ones(1, dtype=bool), "ends": stopped, "at": np.zeros(len(stopped), dtype=np.int64),
    }]
    active, ends_of_shard, column = np.arange(n), None, 0
    while True:
        if column:
            active = active[lengths[active] > column]
        if not len(active):
            break
        width = int(min(BLOCK, lengths[active].max() - column))
        if width <= 0:
            break
        place = np.arange(column, column + width)
        held = place[None, :] < lengths[active][:, None]
        matrix = np.zeros((len(active), width), dtype=np.int64)
        matrix[held] = dense[(starts[active][:, None] + place[None, :])[held]]
        group = node_of[active]
        order = np.lexsort((conv[active], *(matrix[:, j] for j in range(width - 1, -1, -1)), group))
        active, matrix, group = active[order], matrix[order], group[order]
        if ends_of_shard is None:
            ends_of_shard = (active[0], active[-1])
        changed = np.ones((len(active), width + 1), dtype=bool)
        changed[1:, 0] = group[1:] != group[:-1]
        changed[1:, 1:] = matrix[1:] != matrix[:-1]
        changed = np.logical_or.accumulate(changed, axis=1)[:, 1:]
        for j in range(width):
            depth = column + j + 1
            inside = matrix[:, j] > 0
            rows, new = active[inside], changed[inside, j]
            at = np.flatnonzero(new)
            number = np.cumsum(new) - 1
            first, parent = rows[at], node_of[rows[at]]
            node_of[rows] = number
            if depth <= EDGE_TURNS:
                edge = np.zeros(len(at), dtype=bool)
                edge[[node_of[r] for r in ends_of_shard if lengths[r] >= depth]] = True
            else:
                edge = levels[-1]["edge"][parent]
            stops = lengths[rows] == depth
            levels.append({
                "first": first, "conv": np.minimum.reduceat(conv[rows], at), "n": np.diff(np.r_[at, len(rows)]),
                "words": words[starts[first] + depth - 1].astype(np.int64), "parent": parent, "edge": edge,
                "ends": rows[stops], "at": number[stops],
            })
        column += width
        if width < BLOCK:
            break
    return levels


def _climb(levels: list[dict]) -> None:
    """Children, leaves and saved tokens of every node, counting only children that are not on an edge."""
    for level in levels:
        for name in ("children", "leaves", "saved"):
            level[name] = np.zeros(len(level["n"]), dtype=np.int64)
    for depth in range(len(levels) - 1, -1, -1):
        level = levels[depth]
        inner = ~level["edge"]
        level["leaves"][inner & (level["children"] == 0)] = 1
        level["saved"][inner] += ((level["n"] - 1) * level["words"])[inner]
        if depth:
            above, parent = levels[depth - 1], level["parent"][inner]
            np.add.at(above["children"], parent, 1)
            np.add.at(above["leaves"], parent, level["leaves"][inner])
            np.add.at(above["saved"], parent, level["saved"][inner])


def _shard_rows(conv: np.ndarray, starts: np.ndarray, lengths: np.ndarray, ids: np.ndarray, words: np.ndarray) -> Iterator[pa.RecordBatch]:
    levels = shard_levels(conv, starts, lengths, _dense(ids) if len(ids) else np.empty(0, dtype=np.int64), words)
    _climb(levels)
    keys: list[dict[int, bytes]] = [{0: hashlib.md5(b"root").digest()}]
    for depth, level in enumerate(levels):
        if depth:
            found = {}
            for k in np.flatnonzero(level["edge"]).tolist():
                own = ids[starts[level["first"][k]] + depth - 1].tobytes()
                found[k] = hashlib.md5(keys[depth - 1][int(level["parent"][k])] + own).digest()
            keys.append(found)
        size, edge, parent = len(level["n"]), level["edge"], level["parent"]
        sha: list[str | None] = [_NO_ENDS] * size
        stop_at = np.flatnonzero(np.r_[True, np.diff(level["at"]) != 0]) if len(level["at"]) else np.empty(0, dtype=np.int64)
        chunks = []
        for a, b in zip(stop_at.tolist(), [*stop_at[1:].tolist(), len(level["at"])]):
            k, members = int(level["at"][a]), conv[level["ends"][a:b]].tolist()
            if edge[k]:
                chunks += [(keys[depth][k], members[x], ",".join(map(str, members[x : x + END_IDS])).encode()) for x in range(0, len(members), END_IDS)]
            else:
                sha[k] = hashlib.sha256(",".join(map(str, members)).encode()).hexdigest()
        above_edge = levels[depth - 1]["edge"][parent] if depth else np.ones(1, dtype=bool)
        for a in range(0, size, SHARD_ROWS):
            part = slice(a, a + SHARD_ROWS)
            on, under = edge[part], above_edge[part]
            kind = np.where(on, _EDGE, np.where(under, _UNDER_EDGE, _WHOLE)).astype(np.int32)
            known = levels[depth - 1]["conv"][parent[part]] if depth else np.zeros(1, dtype=np.int64)
            key = [keys[depth].get(k) for k in range(a, min(a + SHARD_ROWS, size))]
            up = [keys[depth - 1][p] if u and depth else None for p, u in zip(parent[part].tolist(), under.tolist())]
            yield pa.RecordBatch.from_arrays([
                pa.array(kind), pa.array(key, pa.binary()), pa.array(up, pa.binary()), pa.array(np.full(len(kind), depth)),
                pa.array(level["conv"][part]), pa.array(known, mask=kind != _WHOLE), pa.array(level["n"][part]),
                pa.array(level["children"][part]), pa.array(level["leaves"][part]), pa.array(level["saved"][part]),
                pa.array(level["words"][part]), pa.array(sha[part], pa.string()), pa.nulls(len(kind), pa.binary()),
            ], schema=_FIELDS)
        for a in range(0, len(chunks), SHARD_ROWS):
            key, low, ends = zip(*chunks[a : a + SHARD_ROWS])
            blank = {f.name: pa.nulls(len(key), f.type) for f in _FIELDS}
            blank |= {"kind": pa.array([_ENDS] * len(key), pa.int32()), "key": pa.array(key, pa.binary()), "conv_id": pa.array(low, pa.int64()), "ends": pa.array(ends, pa.binary())}
            yield pa.RecordBatch.from_arrays([blank[f.name] for f in _FIELDS], schema=_FIELDS)


def _shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One range of the sorted paths; its size is set by the number of ranges."""
    table = pa.Table.from_batches([b for b in batches if b.num_rows] or [], schema=_INPUT)
    if not table.num_rows:
        return
    table = table.combine_chunks()
    path, words = table["path"].chunk(0), table["words"].chunk(0)
    ends = np.frombuffer(path.buffers()[1], dtype=np.int32 if path.type == pa.binary() else np.int64)[path.offset : path.offset + len(path) + 1].astype(np.int64)
    ids = np.frombuffer(path.buffers()[2] or b"", dtype=np.uint8)[ends[0] : ends[-1]].reshape(-1, _ID_BYTES)
    starts = (ends[:-1] - ends[0]) // _ID_BYTES
    yield from _shard_rows(table["conv_id"].to_numpy(), starts, np.diff(ends) // _ID_BYTES, ids, words.flatten().to_numpy(zero_copy_only=False))


_INPUT = pa.schema([("conv_id", pa.int64()), ("path", pa.binary()), ("words", pa.list_(pa.int32()))])


def _digests(batches: Iterator) -> Iterator:
    """SHA-256 per key over chunks that arrive sorted by key and place."""
    import pandas as pd

    now, state, done = None, None, []
    for batch in batches:
        for key, ends in zip(batch["key"], batch["ends"]):
            if key != now:
                if now is not None:
                    done.append((now, state.hexdigest()))
                now, state = key, hashlib.sha256(ends)
            else:
                state.update(b"," + ends)
        if len(done) >= SHARD_ROWS:
            yield pd.DataFrame(done, columns=["key", "sha"])
            done = []
    if now is not None:
        done.append((now, state.hexdigest()))
    if done:
        yield pd.DataFrame(done, columns=["key", "sha"])


def _edges_climbed(edge: DataFrame) -> DataFrame:
    """Subtree sums of leaves and saved tokens over the shared nodes, by doubling ancestors."""
    deepest = edge.agg(F.max("depth")).first()[0] or 0
    held = cut_lineage(edge.select("key", F.col("parent_key").alias("up"), "n_leaves", "saved_tokens"))
    reach = 1
    while reach <= deepest:
        below = held.filter("up is not null").groupBy("up").agg(F.sum("n_leaves").alias("l"), F.sum("saved_tokens").alias("s"))
        added = held.join(below.withColumnRenamed("up", "key"), "key", "left")
        further = held.select(F.col("key").alias("up"), F.col("up").alias("next"))
        held = cut_lineage(added.join(further, "up", "left").select(
            "key", F.col("next").alias("up"), (F.col("n_leaves") + F.coalesce("l", F.lit(0))).alias("n_leaves"),
            (F.col("saved_tokens") + F.coalesce("s", F.lit(0))).alias("saved_tokens"),
        ))
        reach *= 2
    return held.select("key", "n_leaves", "saved_tokens")


def trie(found: DataFrame) -> DataFrame:
    """One row per node of the trie of ``found`` (conv_id, path, words), conversation ids being unique."""
    found = cut_lineage(found.select("conv_id", "path", "words"))
    spark = found.sparkSession
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-found.count() // SHARD_ROWS))
    near = F.substring("path", 1, _ID_BYTES * EDGE_TURNS)
    ranged = found.repartitionByRange(shards, near, "conv_id")
    parts = cut_lineage(ranged.mapInArrow(_shard, _PART))

    edge = parts.filter(F.col("kind") == _EDGE).groupBy("key").agg(
        F.max("parent_key").alias("parent_key"), F.max("depth").alias("depth"), F.min("conv_id").alias("conv_id"),
        F.sum("n_convs").alias("n_convs"), F.sum("n_children").alias("n_children"), F.sum("n_leaves").alias("n_leaves"),
        F.sum("saved_tokens").alias("saved_tokens"), F.max("words").alias("words"),
    )
    edge = cut_lineage(edge)
    shared_children = edge.groupBy("parent_key").agg(F.count("*").alias("more")).select(F.col("parent_key").alias("key"), "more")
    edge = edge.join(shared_children, "key", "left")
    edge = edge.withColumn("n_children", F.col("n_children") + F.coalesce("more", F.lit(0)))
    edge = cut_lineage(
        edge.withColumn("n_leaves", F.col("n_leaves") + (F.col("n_children") == 0).cast("long"))
        .withColumn("saved_tokens", F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("words"))
    )
    chunks = parts.filter(F.col("kind") == _ENDS).select("key", F.col("conv_id").alias("low"), "ends")
    ends = chunks.repartition("key").sortWithinPartitions("key", "low").select("key", "ends").mapInPandas(_digests, "key binary, sha string")
    parent = edge.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    shared = edge.drop("n_leaves", "saved_tokens").join(_edges_climbed(edge), "key").join(ends, "key", "left").join(parent, "parent_key", "left")
    shared = shared.withColumn("ends_sha256", F.coalesce("sha", F.lit(_NO_ENDS)))

    # Half of all nodes may hang under one shared node: the few shared rows are repeated per salt.
    salted = parent.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))))
    under = parts.filter(F.col("kind") == _UNDER_EDGE).drop("parent_conv_id").withColumn("salt", F.pmod("conv_id", F.lit(_SALTS)).cast("int"))
    under = under.join(salted, ["parent_key", "salt"])
    whole = parts.filter(F.col("kind") == _WHOLE)
    return whole.select(*_COLUMNS).unionByName(under.select(*_COLUMNS)).unionByName(shared.select(*_COLUMNS))


def op11_prefix_trie(spark, sf_dir: str) -> DataFrame:
    """Nodes of the prefix trie of all rebuilt conversations."""
    return trie(rebuilt_paths(turn_rows(read_table(spark, sf_dir, "conversations"))))


SQL = r"""
WITH rows_ AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
), own AS (
  SELECT conv_id, list({'role': role, 'text': text} ORDER BY turn NULLS FIRST, md5(length(role) || ':' || role || text)) AS turns
  FROM rows_ GROUP BY conv_id
), hashed AS (
  SELECT conv_id, turns, xor(4294967295, list_reduce(
    list_prepend(4294967295, list_transform(range(1, length(conv_id::VARCHAR) + 1), lambda i: ascii(substr(conv_id::VARCHAR, i, 1))::BIGINT)),
    lambda a, c: list_reduce([xor(a, c), 0, 0, 0, 0, 0, 0, 0, 0],
      lambda v, z: xor(v >> 1, CASE WHEN v & 1 = 1 THEN 3988292384 ELSE 0 END)))) % 4 AS h
  FROM own
), rebuilt AS (
  SELECT c.conv_id, list_concat(list_slice(coalesce(b.turns, []), 1, c.h), list_slice(c.turns, c.h + 1, len(c.turns))) AS turns
  FROM hashed c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 20
), prefixes AS (
  SELECT conv_id, len(turns) AS n, d.d AS depth, md5(to_json(list_slice(turns, 1, d.d))::VARCHAR) AS node,
    CASE WHEN d.d > 0 THEN md5(to_json(list_slice(turns, 1, d.d - 1))::VARCHAR) END AS above,
    CASE WHEN d.d > 0 THEN len(regexp_extract_all(turns[d.d].text, '[^\x20\x09-\x0D]+')) ELSE 0 END AS words
  FROM rebuilt, LATERAL (SELECT unnest(range(0, len(turns) + 1)) AS d) d
), nodes AS (
  SELECT node, depth, any_value(above) AS above, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (n = depth), '')) AS ends_sha256
  FROM prefixes GROUP BY node, depth
), kids AS (
  SELECT above AS node, count(*) AS n FROM nodes WHERE above IS NOT NULL GROUP BY above
), valued AS (
  SELECT nodes.*, coalesce(kids.n, 0) AS n_children, (n_convs - 1) * words AS own FROM nodes LEFT JOIN kids USING (node)
), beneath AS (
  SELECT p.node, p.depth, count(*) FILTER (v.n_children = 0) AS n_leaves, sum(v.own) AS saved_tokens
  FROM valued v JOIN prefixes p ON p.conv_id = v.conv_id AND p.depth <= v.depth GROUP BY p.node, p.depth
)
SELECT v.conv_id, v.depth::BIGINT AS depth, u.conv_id AS parent_conv_id, v.n_convs, v.n_children, b.n_leaves,
  b.saved_tokens::BIGINT AS saved_tokens, v.ends_sha256
FROM valued v JOIN beneath b USING (node, depth) LEFT JOIN nodes u ON u.node = v.above
"""

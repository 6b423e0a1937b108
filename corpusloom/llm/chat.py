"""Chat formatting of reply trees.

Messages form trees (each may have a parent). Root-to-leaf paths are enumerated by iterative
self-joins that double the distance each round, so a path of d messages takes log2(d) rounds.
Branches are ranked by score, and every chosen path becomes one conversation in a template with
turn markers; marker strings inside texts and roles are escaped reversibly. Only DataFrame
functions are used.

Template: ``### Role: text</turn>\\n`` per message. Inside texts ``\\`` becomes ``\\\\``, ``#`` becomes
``\\h`` and ``<`` becomes ``\\l``; inside roles also ``:`` becomes ``\\c`` and a new line ``\\n``. So neither
marker can occur in an escaped string. The loss mask lists the spans (code points, end exclusive)
of assistant texts.

Defined results: null text is empty, null role is the empty role; empty texts are turns like any
other; turns are ordered by turn number, nulls first, ties by role, text; repeated rows are turns
of their own; a null conversation id is a conversation of its own; an empty table gives no
conversations. Messages whose parent is missing are roots; messages in a cycle have no root and
are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import local_rows
from .common import cut_lineage, read_table

# Fixed value: the contract's extra conversation.
PROBE_ID, PROBE_TEXT = -7, r"\### Assistant: </turn> ok"
# --- end of fixed value
HEAD, MIDDLE, END = "### ", ": ", "</turn>\n"
LOSS_ROLE = "assistant"
_MOST_ROUNDS = 40


def escape(text: Column) -> Column:
    """Make the markers impossible inside ``text``."""
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    out = F.replace(out, F.lit("#"), F.lit("\\h"))
    return F.replace(out, F.lit("<"), F.lit("\\l"))


def unescape(text: Column) -> Column:
    """Undo ``escape``: doubled backslashes separate the parts in which single ones are codes."""
    part = lambda p: F.replace(F.replace(p, F.lit("\\h"), F.lit("#")), F.lit("\\l"), F.lit("<"))
    return F.array_join(F.transform(F.split(text, r"\\\\", -1), part), "\\")


def escape_role(role: Column) -> Column:
    return F.replace(F.replace(escape(role), F.lit(":"), F.lit("\\c")), F.lit("\n"), F.lit("\\n"))


def unescape_role(role: Column) -> Column:
    def part(p: Column) -> Column:
        for code, char in (("\\h", "#"), ("\\l", "<"), ("\\c", ":"), ("\\n", "\n")):
            p = F.replace(p, F.lit(code), F.lit(char))
        return p

    return F.array_join(F.transform(F.split(role, r"\\\\", -1), part), "\\")


def paths(nodes: DataFrame) -> DataFrame:
    """leaf, node, depth (0 at the root) for every root-to-leaf path.

    ``nodes`` has node (unique) and parent. Round k joins every ancestor found so far with its
    ancestor 2**k steps up; the jump table itself doubles by a self-join.
    """
    known = nodes.select(F.col("node").alias("known"))
    up = nodes.select("node", "parent").join(known, F.col("parent") == F.col("known"), "left")
    up = cut_lineage(up.select("node", F.col("known").alias("above")))
    leaves = up.join(up.select(F.col("above").alias("node")).distinct(), "node", "left_anti")
    found = leaves.select(F.col("node").alias("leaf"), "node", F.lit(0).cast("long").alias("height"))
    jump = up.filter("above IS NOT NULL")
    for k in range(_MOST_ROUNDS):
        if jump.isEmpty():
            break
        higher = found.join(jump, "node").select("leaf", F.col("above").alias("node"), (F.col("height") + (1 << k)).alias("height"))
        found = cut_lineage(found.unionByName(higher))
        next_jump = jump.select("node", F.col("above").alias("middle")).join(
            jump.select(F.col("node").alias("middle"), "above"), "middle"
        )
        jump = cut_lineage(next_jump.select("node", "above"))
    else:
        raise ValueError("reply links form a cycle")
    top = found.groupBy("leaf").agg(F.max("height").alias("top"))
    return found.join(top, "leaf").select("leaf", "node", (F.col("top") - F.col("height")).alias("depth"))


def ranked_branches(nodes: DataFrame, found: DataFrame) -> DataFrame:
    """tree, leaf, branch_score (mean of the path's scores), branch_rank (1 is best) per path.

    Ties go to the smaller leaf; null scores count as 0.
    """
    scores = found.join(nodes.select("node", "tree", F.coalesce("score", F.lit(0.0)).alias("score")), "node")
    per_path = scores.groupBy("leaf").agg(F.first("tree").alias("tree"), F.avg("score").alias("branch_score"))
    order = Window.partitionBy("tree").orderBy(F.desc("branch_score"), "leaf")
    return per_path.withColumn("branch_rank", F.row_number().over(order))


def format_paths(nodes: DataFrame, keep: int | None = None) -> DataFrame:
    """One conversation per chosen path: tree, leaf, branch_rank, formatted, loss_spans, n_turns.

    ``nodes``: tree, node (unique), parent, score, role, text. ``keep``: best branches per tree
    (None: all).
    """
    found = cut_lineage(paths(nodes))
    branches = ranked_branches(nodes, found)
    if keep is not None:
        branches = branches.filter(F.col("branch_rank") <= keep)
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    body = escape(text)
    head = F.concat(F.lit(HEAD), escape_role(role), F.lit(MIDDLE))
    said = nodes.select("node", head.alias("head"), body.alias("body"), (role == LOSS_ROLE).alias("loss"))
    turns = found.join(branches, "leaf").join(said, "node")
    turns = turns.withColumn("piece", F.concat("head", "body", F.lit(END)))
    before = Window.partitionBy("leaf").orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.length("piece").cast("long")).over(before), F.lit(0)) + F.length("head")
    turns = turns.withColumn("start", start).withColumn("end", F.col("start") + F.length("body"))
    order = F.array_sort(F.collect_list(F.struct("depth", "piece", "loss", "start", "end")))
    whole = turns.groupBy("tree", "leaf", "branch_rank").agg(order.alias("t"))
    masked = F.transform(F.filter("t", lambda x: x["loss"]), lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end")))
    return whole.select(
        "tree", "leaf", "branch_rank", F.array_join(F.transform("t", lambda x: x["piece"]), "").alias("formatted"),
        masked.alias("loss_spans"), F.size("t").cast("long").alias("n_turns"),
    )


def read_back(formatted: DataFrame, key: str = "tree") -> DataFrame:
    """Parse conversations: key, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars.

    Turns are split at their end marker; a turn is under the mask when the span that starts at
    its body ends where the body ends.
    """
    cut = F.split("formatted", F.lit(END), -1)
    turns = formatted.select(
        F.col(key).alias("key"), "leaf", F.length("formatted").cast("long").alias("chars"),
        F.posexplode(F.slice(cut, F.lit(1), F.size(cut) - 1)).alias("at", "piece"),
    )
    before = Window.partitionBy("leaf").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum(F.length("piece").cast("long") + len(END)).over(before), F.lit(0))
    colon = F.instr("piece", MIDDLE)
    role = F.substring("piece", F.lit(len(HEAD) + 1), colon - len(HEAD) - 1)
    body = F.substring("piece", colon + len(MIDDLE), F.length("piece"))
    turns = turns.select(
        "key", "leaf", "chars", "at", unescape_role(role).alias("role"), unescape(body).alias("said"),
        (offset + colon + len(MIDDLE) - 1).alias("start"), (offset + F.length("piece")).alias("end"),
    )
    spans = formatted.select("leaf", F.explode("loss_spans").alias("s")).select("leaf", "s.start", "s.end", F.lit(True).alias("masked"))
    marked = turns.join(spans, ["leaf", "start", "end"], "left")
    order = F.array_sort(F.collect_list(F.struct("at", "role", "said", F.coalesce("masked", F.lit(False)).alias("masked"))))
    whole = marked.groupBy("key", "leaf", "chars").agg(order.alias("t"))
    every = F.array_join(F.transform("t", lambda x: F.concat(x["role"], F.lit("\n"), x["said"], F.lit("\n"))), "")
    loss = F.array_join(F.transform(F.filter("t", lambda x: x["masked"]), lambda x: x["said"]), "")
    return whole.select(
        F.col("key").alias(key), F.size("t").cast("long").alias("n_turns"), F.sha2(every, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
        F.col("chars").alias("formatted_chars"),
    )


def reply_chains(conversations: DataFrame) -> DataFrame:
    """Linear conversations (conv_id, turn, role, text) as reply trees: each row answers the one before."""
    rows = conversations.select(
        F.col("conv_id").alias("tree"), "turn", F.col("role"), F.col("text"), F.monotonically_increasing_id().alias("node")
    )
    rows = cut_lineage(rows)
    order = Window.partitionBy("tree").orderBy("turn", "role", "text", "node")
    return cut_lineage(
        rows.select("tree", "node", F.lag("node").over(order).alias("parent"), F.lit(0.0).alias("score"), "role", "text")
    )


def op4_chat(spark, sf_dir: str) -> DataFrame:
    """All conversations and the probe, formatted and read back."""
    rows = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = local_rows(
        spark, [(PROBE_ID, 0, "user", PROBE_TEXT), (PROBE_ID, 1, "assistant", PROBE_TEXT)],
        "conv_id long, turn long, role string, text string",
    )
    formatted = cut_lineage(format_paths(reply_chains(rows.unionByName(probe))))
    return read_back(formatted).withColumnRenamed("tree", "conv_id")


_TURNS = "string_agg(coalesce(role, '') || chr(10) || coalesce(text, '') || chr(10), '' ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST)"
_SAID = "coalesce(string_agg(coalesce(text, ''), '' ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) FILTER (role = 'assistant'), '')"
_LONGER = "len(text) - len(replace(replace(replace(text, chr(92), ''), '#', ''), '<', ''))"
_ROLE = "replace(replace(replace(replace(replace(role, chr(92), ''), '#', ''), '<', ''), ':', ''), chr(10), '')"
SQL = rf"""
WITH c AS (SELECT conv_id, turn, role, text FROM conversations
           UNION ALL SELECT {PROBE_ID}, 0, 'user', '{PROBE_TEXT}' UNION ALL SELECT {PROBE_ID}, 1, 'assistant', '{PROBE_TEXT}')
SELECT conv_id, count(*) AS n_turns, sha256({_TURNS}) AS turns_sha256, CAST(len({_SAID}) AS BIGINT) AS loss_chars,
       sha256({_SAID}) AS loss_sha256,
       CAST(sum({len(HEAD) + len(MIDDLE) + len(END)} + coalesce(len(text) + {_LONGER}, 0)
                + coalesce(len(role) + len(role) - len({_ROLE}), 0)) AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id"""

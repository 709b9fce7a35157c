"""Chat formatting over a prefix tree.

Conversations that begin with the same turns share the tree nodes of those turns: a node is a distinct (role, text) path from
the first turn. Each node's formatted tokens are emitted once, nodes in depth-first order, each with position ids that go
on from its parent's and the intervals of the emitted stream that its tokens may attend to: those of its ancestors (and,
causally, itself).

Template: ``<|turn|>role<|body|>text<|end|>`` a turn. In roles and texts ``&`` becomes ``&amp;``, ``<`` becomes ``&lt;`` and
the ``[`` of ``[INST]`` and ``[/INST]`` becomes ``&lsqb;``, so no text can form a marker of this or of the common bracketed
templates, and the three replacements undo exactly. Tokens are the code points of the formatted text unless a
``tokenize`` function is given. The loss mask of a node covers the escaped text of an assistant turn and nothing else.

Plan: turns are gathered by conversation (a conversation is one training example and fits in memory); node rows are
aggregated by node id with partial aggregation, so a first turn shared by a third of all conversations is one row a task.
Depth-first order is a range sort by path key; offsets are prefix sums in two passes (sums of each range, then within). Ancestor
intervals are a window along each conversation, a row a turn.

Null text or role is empty; turns are in order of ``turn`` (nulls first), ties by role and text; repeated rows are turns of
their own; rows with a null conv_id are one conversation. An empty table gives empty tables. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinetrail.llm.common import staged

TURN, BODY, END = "<|turn|>", "<|body|>", "<|end|>"


def escape(text: str) -> str:
    return text.replace("&", "&amp;").replace("<", "&lt;").replace("[INST]", "&lsqb;INST]").replace("[/INST]", "&lsqb;/INST]")


def unescape(text: str) -> str:
    return text.replace("&lsqb;", "[").replace("&lt;", "<").replace("&amp;", "&")


def render(role: str, text: str) -> tuple[str, int, int]:
    """The formatted turn and where its text starts and ends."""
    head = f"{TURN}{escape(role)}{BODY}"
    body = escape(text)
    return head + body + END, len(head), len(head) + len(body)


def parse(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) turns of a formatted conversation."""
    turns = []
    for part in formatted.split(END)[:-1]:
        role, body = part.removeprefix(TURN).split(BODY)
        turns.append((unescape(role), unescape(body)))
    return turns


@dataclass(frozen=True)
class ChatForest:
    """nodes: node_id, parent_id, tree_id, depth, role, formatted, n_tokens, stream_start, position_start, position_ids,
    attends (array of [start, stop) in stream order), loss_start, loss_stop (code points of formatted; null without loss).
    members: conv_id and node_ids from the first turn to the last. spans: node_id and its [start, stop) of the stream."""

    nodes: DataFrame
    members: DataFrame
    spans: DataFrame


_PATHS = T.StructType(
    [
        T.StructField("conv", T.LongType()),
        T.StructField("node_id", T.ArrayType(T.BinaryType())),
        T.StructField("path", T.ArrayType(T.BinaryType())),
    ]
)


def _paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chained 128-bit path digests of each conversation, and sort keys that put a node just before what is below it."""
    for batch in batches:
        nodes, keys = [], []
        for turns in batch.column("turns").to_pylist():
            above, path, ids, paths = b"", b"", [], []
            for x in turns or ():
                role, text = x["role"].encode(), x["text"].encode()
                above = hashlib.blake2b(above + len(role).to_bytes(8, "big") + role + text, digest_size=16).digest()
                path += above[:8]
                ids.append(above)
                paths.append(path)
            nodes.append(ids)
            keys.append(paths)
        kind = pa.list_(pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column("conv"), pa.array(nodes, kind), pa.array(keys, kind)], names=["conv", "node_id", "path"])


def build(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", tokenize: Callable[[str], int] | None = None) -> ChatForest:
    """The prefix forest of a table of turns. tokenize: number of tokens of a formatted turn; code points by default."""
    said = F.struct(turns[turn].alias("turn"), F.coalesce(turns[role], F.lit("")).alias("role"), F.coalesce(turns[text], F.lit("")).alias("text"))
    convs = turns.groupBy(turns[conv].cast("bigint").alias("conv")).agg(F.array_sort(F.collect_list(said), _in_order).alias("turns"))
    rows = convs.mapInArrow(_with_turns, T.StructType([*_PATHS.fields, T.StructField("turns", T.ArrayType(T.StructType([T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])))]))
    rows = staged(rows, "chat-paths")

    each = rows.select(F.explode(F.arrays_zip("node_id", "path", "turns")).alias("x")).select("x.node_id", "x.path", "x.turns.role", "x.turns.text")
    nodes = each.groupBy("node_id").agg(F.min(F.struct("path", "role", "text")).alias("x")).select("node_id", "x.*")
    count = F.udf(tokenize, T.LongType()) if tokenize else None
    formatted = F.concat(F.lit(TURN), _escaped("role"), F.lit(BODY), _escaped("text"), F.lit(END))
    head = F.length(F.concat(F.lit(TURN), _escaped("role"), F.lit(BODY)))
    nodes = nodes.select(
        "node_id",
        "path",
        "role",
        formatted.alias("formatted"),
        F.when(F.col("role") == "assistant", head).cast("bigint").alias("loss_start"),
        F.when(F.col("role") == "assistant", head + F.length(_escaped("text"))).cast("bigint").alias("loss_stop"),
    ).withColumn("n_tokens", (count("formatted") if count else F.length("formatted")).cast("bigint"))
    # depth-first order: range partitions by path, each knowing the tokens that stand before it
    ordered = staged(nodes.repartitionByRange("path").withColumn("part", F.spark_partition_id()), "chat-nodes")
    sums = ordered.groupBy("part").agg(F.sum("n_tokens").alias("tokens"))
    before = sums.select("part", (F.sum("tokens").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))).alias("before"))  # a row a partition
    inside = Window.partitionBy("part").orderBy("path").rowsBetween(Window.unboundedPreceding, 0)
    placed = ordered.join(F.broadcast(before), "part").withColumn("stream_start", F.coalesce("before", F.lit(0)) + F.sum("n_tokens").over(inside) - F.col("n_tokens"))
    placed = staged(placed.drop("part", "before"), "chat-placed")

    # along each conversation: what stands above a turn; the same for all conversations that share the node
    spans = placed.select("node_id", F.col("stream_start").alias("start"), (F.col("stream_start") + F.col("n_tokens")).alias("stop"))
    steps = rows.select("conv", F.posexplode("node_id").alias("at", "node_id")).join(spans, "node_id")
    along = Window.partitionBy("conv").orderBy("at")
    above = along.rowsBetween(Window.unboundedPreceding, -1)
    seen = steps.select(
        "node_id",
        F.lag("node_id").over(along).alias("parent_id"),
        F.first("node_id").over(along).alias("tree_id"),
        F.col("at").alias("depth"),
        F.coalesce(F.sum(F.col("stop") - F.col("start")).over(above), F.lit(0)).alias("position_start"),
        F.collect_list(F.struct("start", "stop")).over(above).alias("attends"),
    )
    known = seen.groupBy("node_id").agg(*[F.first(x).alias(x) for x in seen.columns[1:]])
    out = placed.join(known, "node_id").select("node_id", "parent_id", "tree_id", "depth", "role", "formatted", "n_tokens", "stream_start", "position_start", "attends", "loss_start", "loss_stop")
    ids = F.sequence(F.col("position_start"), F.col("position_start") + F.col("n_tokens") - 1)
    return ChatForest(out.withColumn("position_ids", ids), rows.select(F.col("conv").alias(conv), F.col("node_id").alias("node_ids")), spans)


def _escaped(column: str) -> F.Column:
    out = F.col(column)
    for old, new in (("&", "&amp;"), ("<", "&lt;"), ("[INST]", "&lsqb;INST]"), ("[/INST]", "&lsqb;/INST]")):
        out = F.replace(out, F.lit(old), F.lit(new))
    return out


def _in_order(a: F.Column, b: F.Column) -> F.Column:
    def three(x: F.Column, y: F.Column) -> F.Column:
        return F.when(x < y, -1).when(x > y, 1).otherwise(0)

    by_turn = F.when(a["turn"].isNull() & b["turn"].isNull(), 0).when(a["turn"].isNull(), -1).when(b["turn"].isNull(), 1).otherwise(three(a["turn"], b["turn"]))
    by_role = three(a["role"], b["role"])
    return F.when(by_turn != 0, by_turn).when(by_role != 0, by_role).otherwise(three(a["text"], b["text"]))


def _with_turns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = next(_paths(iter([batch])))
        turns = [[{"role": x["role"], "text": x["text"]} for x in row or ()] for row in batch.column("turns").to_pylist()]
        kind = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
        yield pa.RecordBatch.from_arrays([*found.columns, pa.array(turns, kind)], names=["conv", "node_id", "path", "turns"])


def read_back(forest: ChatForest, conv: str = "conv_id") -> DataFrame:
    """What each conversation says, read from the emitted stream: turn count, digests of turns and of loss text, lengths, and whether
    the position ids of its tokens run from 0 without a gap.

    A conversation is what its last node attends to, and that node: the intervals of its path, in stream order. The stream is read
    where these intervals start; a conversation costs a row a turn."""
    steps = forest.members.select(conv, F.explode("node_ids").alias("node_id"))
    asked = steps.join(forest.spans, "node_id").select(conv, F.col("start").alias("stream_start"), "stop")
    ids = F.col("position_ids")
    emitted = forest.nodes.select("stream_start", "formatted", "loss_start", "loss_stop", "n_tokens", F.get(ids, F.lit(0)).alias("first"), F.get(ids, F.size(ids) - 1).alias("last"), (F.size(ids) == F.col("n_tokens")).alias("each"))
    found = asked.join(emitted, "stream_start").where(F.col("stop") == F.col("stream_start") + F.col("n_tokens"))
    part = F.struct("stream_start", "formatted", "loss_start", "loss_stop", "first", "last", "each")
    streams = found.groupBy(conv).agg(F.array_sort(F.collect_list(part)).alias("parts"))
    schema = "conv bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint, positions_follow boolean"
    return streams.select(F.col(conv).alias("conv"), "parts").mapInArrow(_digest, schema).withColumnRenamed("conv", conv)


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        made: list[list] = [[], [], [], [], [], []]
        for parts in batch.column("parts").to_pylist():
            stream = "".join(x["formatted"] for x in parts)
            loss = "".join(unescape(x["formatted"][x["loss_start"] : x["loss_stop"]]) for x in parts if x["loss_start"] is not None)
            turns = parse(stream)
            made[0].append(len(turns))
            made[1].append(hashlib.sha256("".join(f"{role}\n{text}\n" for role, text in turns).encode()).hexdigest())
            made[2].append(len(loss))
            made[3].append(hashlib.sha256(loss.encode()).hexdigest())
            made[4].append(len(stream))
            before = [-1, *(x["last"] for x in parts)]
            made[5].append(all(x["each"] and x["first"] == b + 1 for x, b in zip(parts, before)))
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_())
        names = ["conv", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "positions_follow"]
        yield pa.RecordBatch.from_arrays([batch.column("conv"), *(pa.array(x, k) for x, k in zip(made, kinds, strict=True))], names=names)

"""Chat formatting as a prefix tree.

Conversations that begin with the same turns share the tree's nodes for them. A node is
one formatted turn after a given history; its id is a hash chained along the history.
The tree is written depth-first: conversations are sorted by their paths of node ids,
and each writes the nodes that none before it has, so every shared token stands once.
A node carries its place in the token stream, the position of its first token on its
own path, and the intervals of the stream that its tokens may attend to: its ancestors.

No tree is gathered anywhere. Sorting is a range partitioning over all paths, the first
conversation of a node is a minimum that tasks combine beforehand, and places are sums
per partition. Only one conversation's turns have to fit into one task.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyloom.llm.subwords import Subwords
from tallyloom.runtime import materialize

ASSISTANT = "assistant"
_ESCAPED = re.compile(r"\\(.)", re.S)
_TURN = re.compile(r"<turn ((?:[^\\>]|\\.)*)>\n((?:[^\\<]|\\.)*)</turn>\n", re.S)

_FORMATTED = ("path BINARY, turns ARRAY<STRUCT<node: BINARY, parent: BINARY, piece: STRING, "
              "loss_start: INT, loss_stop: INT, ids: ARRAY<INT>>>")


def escape(text: str) -> str:
    """A text without control strings: each begins with ``<``, a role ends with ``>``."""
    return text.replace("\\", "\\\\").replace("<", "\\<").replace(">", "\\>")


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def format_turn(role: str | None, text: str | None) -> tuple[str, int, int]:
    """(formatted turn, begin and end of the text under the loss mask). Only the text of
    an assistant is under it."""
    head, body = f"<turn {escape(role or '')}>\n", escape(text or "")
    loss = (len(head), len(head) + len(body)) if role == ASSISTANT else (0, 0)
    return f"{head}{body}</turn>\n", *loss


def parse_turns(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of every turn of a formatted conversation."""
    found, at = [], 0
    while at < len(formatted):
        turn = _TURN.match(formatted, at)
        if not turn:
            raise ValueError("not a formatted conversation")
        found.append((unescape(turn[1]), unescape(turn[2])))
        at = turn.end()
    return found


def format_conversations(conversations: DataFrame, subwords: Subwords) -> DataFrame:
    """(conv_id, path, turns) of every conversation, rows ordered by turn; rows of the
    same turn by role and text."""
    kind = conversations.schema["conv_id"].dataType.simpleString()
    rows = conversations.groupBy("conv_id").agg(  # one conversation is one row
        F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("rows"))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 64):
                part = batch.slice(i, 64)
                paths, turns = [], []
                for conversation in part.column("rows").to_pylist():
                    parent, own, path = b"", [], []
                    for row in conversation:
                        piece, start, stop = format_turn(row["role"], row["text"])
                        node = hashlib.blake2b(parent + piece.encode(), digest_size=16).digest()
                        ids = np.frombuffer(subwords.id_bytes(piece.encode()), "<i4")
                        own.append({"node": node, "parent": parent or None, "piece": piece, "loss_start": start,
                                    "loss_stop": stop, "ids": ids})
                        path.append(node)
                        parent = node
                    paths.append(b"".join(path))
                    turns.append(own)
                kind = pa.list_(pa.struct([
                    ("node", pa.binary()), ("parent", pa.binary()), ("piece", pa.string()),
                    ("loss_start", pa.int32()), ("loss_stop", pa.int32()), ("ids", pa.list_(pa.int32()))]))
                yield pa.RecordBatch.from_arrays(
                    [part.column("conv_id"), pa.array(paths, pa.binary()), pa.array(turns, kind)],
                    ["conv_id", "path", "turns"])

    return rows.mapInArrow(build, f"conv_id {kind}, {_FORMATTED}")


def prefix_tree(conversations: DataFrame, subwords: Subwords) -> tuple[DataFrame, DataFrame]:
    """(nodes, paths).

    nodes: node, parent, depth, start (first token in the stream), n_tokens, position (of
    the first token on its path), attends (stream intervals of the ancestors, joined
    where they touch), piece, loss_start, loss_stop (characters of the piece), ids,
    n_conversations. Sorted by start they are the stream.
    paths: conv_id, depth, node, start, n_tokens: where each conversation's turns stand.

    Null roles and texts are empty strings. Rows that repeat a turn are turns of their
    own. Conversations with the same turns share all nodes. Rows without conv_id form one
    conversation. Other columns are not looked at.
    """
    # stored first: Spark draws the limits of ranges from a pass of its own over what it ranges
    formatted = materialize(format_conversations(conversations, subwords), "chat-turns")
    ranked = formatted.repartitionByRange("path", F.col("conv_id")).sortWithinPartitions("path", "conv_id")
    ranked = materialize(ranked.withColumn("rank", F.monotonically_increasing_id()), "chat-formatted")
    turns = ranked.select("conv_id", "rank", F.posexplode("turns").alias("depth", "turn"))
    turns = turns.select("conv_id", "rank", "depth", F.col("turn.node").alias("node"),
                         F.size("turn.ids").cast("bigint").alias("n_tokens"))

    # the first conversation on a node writes it
    first = turns.groupBy("node").agg(
        F.min("rank").alias("rank"), F.first("depth").alias("depth"), F.first("n_tokens").alias("n_tokens"),
        F.count(F.lit(1)).alias("n_conversations"))
    part = F.shiftright("rank", 33)
    order = W.partitionBy("part").orderBy("rank", "depth")
    first = materialize(first.withColumn("part", part), "chat-nodes")
    totals = first.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    base = totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))  # one row per part
    within = F.sum("n_tokens").over(order.rowsBetween(W.unboundedPreceding, 0)) - F.col("n_tokens")
    placed = first.withColumn("within", within).join(base, "part").select(
        "node", F.col("rank").alias("writer"), (F.col("base") + F.col("within")).alias("start"), "n_conversations")
    paths = materialize(turns.join(placed, "node"), "chat-paths")

    per_conversation = paths.groupBy("rank").agg(F.array_sort(F.collect_list(F.struct(
        "depth", "start", "n_tokens", (F.col("writer") == F.col("rank")).alias("own"), "n_conversations"))).alias("at"))
    written = ranked.select("rank", "turns").join(per_conversation, "rank")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 64):
                rows = []
                for row in batch.slice(i, 64).to_pylist():
                    position, attends = 0, []
                    for turn, at in zip(row["turns"], row["at"]):
                        if at["own"]:
                            rows.append(turn | at | {"position": position, "attends": [dict(a) for a in attends]})
                        stop = at["start"] + at["n_tokens"]
                        if attends and attends[-1]["stop"] == at["start"]:
                            attends[-1]["stop"] = stop
                        else:
                            attends.append({"start": at["start"], "stop": stop})
                        position += at["n_tokens"]
                yield pa.RecordBatch.from_pylist([{k: r[k] for k in _NODE.names} for r in rows], _NODE)

    nodes = written.mapInArrow(write, _NODE_SQL)
    return materialize(nodes, "chat-stream"), paths.select("conv_id", "rank", "depth", "node", "start", "n_tokens")


_NODE = pa.schema([
    ("node", pa.binary()), ("parent", pa.binary()), ("depth", pa.int32()), ("start", pa.int64()),
    ("n_tokens", pa.int64()), ("position", pa.int64()),
    ("attends", pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))), ("piece", pa.string()),
    ("loss_start", pa.int32()), ("loss_stop", pa.int32()), ("ids", pa.list_(pa.int32())),
    ("n_conversations", pa.int64())])
_NODE_SQL = ("node BINARY, parent BINARY, depth INT, start BIGINT, n_tokens BIGINT, position BIGINT, "
             "attends ARRAY<STRUCT<start: BIGINT, stop: BIGINT>>, piece STRING, loss_start INT, loss_stop INT, "
             "ids ARRAY<INT>, n_conversations BIGINT")


def read_back(nodes: DataFrame, paths: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars of every
    conversation, from the stream alone: its nodes are put together again and parsed."""
    kind = paths.schema["conv_id"].dataType.simpleString()
    whole = paths.select("conv_id", "rank", "depth", "start").join(
        nodes.select("start", "piece", "loss_start", "loss_stop"), "start")
    whole = whole.groupBy("rank").agg(
        F.first("conv_id").alias("conv_id"),
        F.array_sort(F.collect_list(F.struct("depth", "piece", "loss_start", "loss_stop"))).alias("pieces"))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for row in batch.column("pieces"):
                pieces = row.as_py()
                formatted = "".join(p["piece"] for p in pieces)
                turns = parse_turns(formatted)
                loss = "".join(unescape(p["piece"][p["loss_start"]:p["loss_stop"]]) for p in pieces)
                said = "".join(f"{role}\n{text}\n" for role, text in turns)
                found.append((len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss),
                              hashlib.sha256(loss.encode()).hexdigest(), len(formatted)))
            columns = [pa.array(c, t) for c, t in zip(
                zip(*found) if found else [[]] * 5,
                (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), *columns],
                ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    return whole.select("conv_id", "pieces").mapInArrow(
        digest, f"conv_id {kind}, n_turns BIGINT, turns_sha256 STRING, loss_chars BIGINT, "
                "loss_sha256 STRING, formatted_chars BIGINT")

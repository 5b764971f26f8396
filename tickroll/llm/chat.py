"""Chat formatting (operator 9): a prefix tree of conversations, packed depth-first.

Conversations that share their first turns share nodes: a node stands for a
sequence of turns and is named by a chained hash of them. The tree is laid
out in depth-first order, so the text of every node is emitted once:

* ``start``: offset of the node in the packed stream; its subtree fills
  ``start`` to ``subtree_end``, and a node's tokens are seen by that subtree
  and nobody else;
* ``position``: position id of its first token, counted along the path;
* ``attention``: the merged packed intervals of its ancestors, what its
  tokens attend to besides the node itself;
* ``loss``: the intervals of its tokens, counted from its own first one, that
  the loss is taken over (the text of an assistant's turn), and ``loss_text``:
  the same in code points of ``formatted``.

Tokens are code points of the formatted text unless ``pack`` is given
``count``, the number of tokens of a string by the caller's tokenizer. It is
asked for a turn's head, its text and its end mark apart, so that no token
reaches across the loss mask's borders.

Depth-first order is found without walking the tree: distinct paths are
sorted; a node belongs to the first path through it, and (rank of that path,
depth) is its place. Paths are compared by their forks alone, the nodes with
fewer paths through them than through their parent: two paths part at such
nodes, and before that they have the same ones. Every further fork of a path
takes another path that is longer by a turn, so a path among T turn rows has
at most about sqrt(2 T) forks, and these are the only nodes of a path that
meet in one row. Ranks and offsets are running sums in two steps, within the
partitions of a range sort and over the partitions' totals.

Template: ``<|turn|>role<|text|>text<|end|>`` per turn. Backslashes in a role
or text are doubled and each control string gets one after its first
character, so no control string survives inside a text and the original can
be read back.

Defined cases: NULL role or text is read as empty; turns with NULL number
come first, equal numbers are ordered by role and text, and repeated rows are
turns of their own; a NULL conv_id names one conversation; turn rows are
streamed in order, so a conversation of any length needs little memory, but
its chained hashes and its digests are one task's work; an empty table gives
no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickroll.llm.common import small_batches, stage

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
# What a text must not say unescaped: this template's marks and common ones of others.
CONTROLS = [TURN, TEXT, END, "<s>", "</s>", "[INST]", "[/INST]", "<|im_start|>", "<|im_end|>", "<|endoftext|>"]
LOSS_ROLE = "assistant"

_CONTROL = re.compile("|".join(re.escape(c) for c in CONTROLS))
_PARTS = re.compile(f"{re.escape(TURN)}(.*?){re.escape(TEXT)}(.*?){re.escape(END)}", re.DOTALL)


def escape(text: str) -> str:
    """Double backslashes; break every control string by a backslash after its first character."""
    return _CONTROL.sub(lambda m: m[0][0] + "\\" + m[0][1:], text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    """The inverse of ``escape``."""
    return re.sub(r"\\(\\?)", r"\1", text)


def format_turn(role: str, text: str) -> str:
    return f"{TURN}{escape(role)}{TEXT}{escape(text)}{END}"


def parse_turn(formatted: str) -> tuple[str, str]:
    """Role and text of one formatted turn."""
    match = _PARTS.fullmatch(formatted)
    if not match:
        raise ValueError("not a formatted turn")
    return unescape(match[1]), unescape(match[2])


def _steps(conversations: DataFrame, conv_id: str, turn: str, role: str, text: str, count: Callable[[str], int]) -> DataFrame:
    """Turn rows along their paths: conv, depth, node, parent, position, size, loss, loss_text, formatted."""
    rows = conversations.select(
        F.col(conv_id).cast("long").alias("conv"), F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))

    intervals = pa.list_(pa.list_(pa.int64()))

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, node, depth, position, begun = None, b"", 0, 0, False
        for batch in batches:
            out = {k: [] for k in ("conv", "depth", "node", "parent", "position", "size", "loss", "loss_text", "formatted")}
            for c, role_, text_ in zip(*(batch.column(k).to_pylist() for k in ("conv", "role", "text"))):
                if not begun or c != conv:
                    conv, node, depth, position, begun = c, b"", 0, 0, True
                head, body = f"{TURN}{escape(role_)}{TEXT}", escape(text_)
                formatted = head + body + END
                before, within = count(head), count(body)
                size, masked = before + within + count(END), role_ == LOSS_ROLE and bool(body)
                loss = [[before, before + within]] if masked else []
                loss_text = [[len(head), len(head) + len(body)]] if masked else []
                parent, node = node, hashlib.blake2b(node + formatted.encode(), digest_size=16).digest()
                for k, v in zip(out, (c, depth, node, parent, position, size, loss, loss_text, formatted)):
                    out[k].append(v)
                depth, position = depth + 1, position + size
            yield pa.RecordBatch.from_arrays(
                [pa.array(out["conv"], pa.int64()), pa.array(out["depth"], pa.int32()), pa.array(out["node"], pa.binary()),
                 pa.array(out["parent"], pa.binary()), pa.array(out["position"], pa.int64()),
                 pa.array(out["size"], pa.int64()), pa.array(out["loss"], intervals), pa.array(out["loss_text"], intervals),
                 pa.array(out["formatted"], pa.string())], names=list(out))

    ordered = rows.repartition("conv").sortWithinPartitions("conv", "turn", "role", "text")
    return stage(ordered.mapInArrow(
        chain, "conv long, depth int, node binary, parent binary, position long, size long, "
               "loss array<array<long>>, loss_text array<array<long>>, formatted string"), "chat-steps")


def _numbered(df: DataFrame, order: list[str], size: str | None, name: str) -> DataFrame:
    """``df`` in global order with ``name``: the sum of ``size`` (or the count) of all rows before each."""
    fields = [f for f in df.schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            sizes = batch.column(size).to_pylist() if size else [1] * batch.num_rows
            within = []
            for s in sizes:
                within.append(at)
                at += s
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([part] * len(within), pa.int32()), pa.array(within, pa.int64()),
                 pa.array(sizes, pa.int64())], names=[*batch.schema.names, "_part", "_within", "_size"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fields) + ", _part int, _within long, _size long"
    done = stage(df.orderBy(*order).mapInArrow(run, schema), f"chat-{name}")
    # one row per partition of the sort: a bounded list
    totals = sorted(done.groupBy("_part").agg(F.sum("_size").alias("n")).collect())
    before, at = [], 0
    for part, n in totals:
        before.append((part, at))
        at += n
    offsets = df.sparkSession.createDataFrame(before, "_part int, _before long")
    return done.join(F.broadcast(offsets), "_part").withColumn(name, F.col("_before") + F.col("_within")).select(
        *[f.name for f in fields], name)


def pack(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
         text: str = "text", count: Callable[[str], int] = len) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(nodes, paths, leaves): the packed tree, the nodes of each distinct path, and each conversation's path.

    ``nodes``: node, parent, depth, start, size, position, subtree_end,
    attention, loss, loss_text (arrays of [begin, end) pairs), formatted.
    Ordered by ``start`` they are the packed stream.
    """
    small_batches(conversations.sparkSession)
    steps = _steps(conversations, conv_id, turn, role, text, count)
    # conversations of the same turns are one path, named by its last node
    leaves = stage(steps.groupBy("conv").agg(F.max(F.struct("depth", "node")).alias("last")).select(
        "conv", F.col("last.node").alias("leaf"), (F.col("last.depth") + 1).alias("n_turns")), "chat-leaves")
    # the turns of one conversation stand for each path; small sides are written
    # before a join, so that Spark splits the rows of a long one
    one = stage(leaves.groupBy("leaf").agg(F.min("conv").alias("_conv")), "chat-distinct")
    ways = stage(steps.join(one, F.col("conv").eqNullSafe(F.col("_conv"))).select("leaf", "depth", "node", "parent"), "chat-ways")
    through = stage(ways.groupBy("node", "parent").agg(F.count(F.lit(1)).alias("n")), "chat-through")
    above = through.select(F.col("node").alias("parent"), F.col("n").alias("n_above"))
    forks = stage(through.join(above, "parent", "left").filter("n_above IS NULL OR n < n_above").select("node"), "chat-forks")
    distinct = ways.join(forks, "node").groupBy("leaf").agg(F.array_sort(F.collect_list(F.struct("depth", "node"))).alias("way"))
    ranked = _numbered(distinct.select("leaf", F.transform("way", lambda s: s["node"]).alias("way")), ["way"], None, "rank")
    paths = stage(ways.select("leaf", "depth", "node").join(ranked.select("leaf", "rank"), "leaf"), "chat-paths")

    placed = paths.groupBy("node").agg(F.min("rank").alias("rank"), F.max("rank").alias("last"))
    texts = steps.groupBy("node").agg(*[F.first(c).alias(c) for c in ("parent", "depth", "position", "size", "loss", "loss_text", "formatted")])
    nodes = _numbered(texts.join(placed, "node"), ["rank", "depth"], "size", "start")
    ends = nodes.groupBy("rank").agg(F.max(F.col("start") + F.col("size")).alias("subtree_end"))
    nodes = stage(nodes.join(ends.withColumnRenamed("rank", "last"), "last"), "chat-nodes")

    # ancestors of each node, merged where they lie side by side in the stream
    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank, intervals = None, []
        for batch in batches:
            nodes_, attention = [], []
            for r, own, node, start, size in zip(*(batch.column(k).to_pylist() for k in ("rank", "own", "node", "start", "size"))):
                if r != rank:
                    rank, intervals = r, []
                if own == r:    # each node once: on the first path through it
                    nodes_.append(node)
                    attention.append([list(i) for i in intervals])
                if intervals and intervals[-1][1] == start:
                    intervals[-1] = (intervals[-1][0], start + size)
                else:
                    intervals.append((start, start + size))
            yield pa.RecordBatch.from_arrays([pa.array(nodes_, pa.binary()), pa.array(attention, pa.list_(pa.list_(pa.int64())))],
                                             names=["node", "attention"])

    along = paths.join(nodes.select("node", F.col("rank").alias("own"), "start", "size"), "node")
    attention = (along.select("rank", "depth", "own", "node", "start", "size").repartition("rank").sortWithinPartitions("rank", "depth")
                 .mapInArrow(merge, "node binary, attention array<array<long>>"))
    packed = stage(nodes.join(attention, "node").select(
        "node", "parent", "depth", "start", "size", "position", "subtree_end", "attention", "loss", "loss_text",
        "formatted"), "chat-packed")
    return packed, paths, leaves


def read_back(packed: DataFrame, paths: DataFrame, leaves: DataFrame) -> DataFrame:
    """One row per conversation, from the packed stream alone: counts and digests of its turns and of the text under the loss mask."""
    rows = leaves.join(paths.select("leaf", "depth", "node"), "leaf").join(packed.select("node", "loss_text", "formatted"), "node")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, begun, state, loss, n, chars, loss_chars = None, False, None, None, 0, 0, 0
        done: list[tuple] = []

        def close():
            done.append((conv, n, state.hexdigest(), loss_chars, loss.hexdigest(), chars))

        def flush() -> pa.RecordBatch:
            names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
            types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            columns = list(zip(*done)) if done else [[]] * 6
            batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)
            done.clear()
            return batch

        for batch in batches:
            for c, mask, formatted in zip(*(batch.column(k).to_pylist() for k in ("conv", "loss_text", "formatted"))):
                if not begun or c != conv:
                    if begun:
                        close()
                    conv, begun, n, chars, loss_chars = c, True, 0, 0, 0
                    state, loss = hashlib.sha256(), hashlib.sha256()
                role_, text_ = parse_turn(formatted)
                state.update(f"{role_}\n{text_}\n".encode())
                n, chars = n + 1, chars + len(formatted)
                for a, b in mask:
                    said = unescape(formatted[a:b])
                    loss.update(said.encode())
                    loss_chars += len(said)
            if len(done) > 1000:
                yield flush()
        if begun:
            close()
        yield flush()

    return (rows.select("conv", "depth", "loss_text", "formatted").repartition("conv").sortWithinPartitions("conv", "depth")
            .mapInArrow(digest, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
                                "formatted_chars long"))

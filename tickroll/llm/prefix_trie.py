"""Prefix trie of conversations by burst tries (operator 13).

Every sequence of first turns that some conversation begins with is a node.

1. Turns become hashes and byte counts where they are read; texts are never
   shuffled. A range sort numbers them, so a conversation of any length may
   span several tasks, and ``segment`` consecutive turns become one row.
2. A chained hash over a conversation's segments names the trie node that each
   segment hangs from, its *head*. Equal segments under one head are one
   *suffix* (with the number of conversations and the smallest). The suffixes
   of a head are a *container*; all heads of all depths are worked on at once.
3. A container of more than ``burst`` suffixes is burst: the turns that all its
   suffixes share become nodes, and the next turn id deals it into containers
   of their own. Repeated (at most ``segment`` times) until none is oversized.
4. The containers left are dealt over the shards by their name, sorted, and
   swept once into nodes with a stack no deeper than a segment.

What a node sums over its subtree is a sum over its members, so no step walks
from container to container: a leaf counts for its smallest member, and each
member saves the bytes from the node down to the first node that it is the
smallest member of. The first sweep finds these two per conversation, a second
one adds them up. Digests of members are streamed over sorted pieces.

Defined cases: NULL role or text is read as empty; a NULL turn number comes
first, and rows of one turn number are ordered by the hash of role and text;
repeated rows are turns of their own; rows with a NULL conv_id belong to no
conversation and are left out; a conversation whose base lends nothing and
that keeps no turn of its own is a member of the root alone; an empty table
has no root and gives no rows; extra columns are ignored. Turns are compared
by 128 bits of SHA-256.
"""

from __future__ import annotations

import hashlib
import os.path
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickroll.llm.common import stage

SEGMENT = 64                   # turns of a row
BURST = 4096                   # suffixes of a container that is swept by one task
DIGITS = 32                    # hex digits of a turn id
GROUP, MOST = 5, 9             # conversations c - c%5 ... lend their first crc32(c)%9 turns
PIECE = 1 << 16                # characters of ids digested at once
NO_HEAD = "0" * DIGITS


# ------------------------------------------------------------- the turns
def _numbered(turns: DataFrame) -> DataFrame:
    """(conv, pos, tid, bytes): the turns of each conversation numbered from 0."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    said = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    rows = turns.filter(F.col("conv").isNotNull()).select(
        "conv", "turn", F.substring(F.sha2(said, 256), 1, DIGITS).alias("tid"), F.octet_length(text).cast("long").alias("bytes"))
    # numbers that rise within a partition and over the partitions of the range sort
    rows = stage(rows.repartitionByRange("conv", "turn", "tid").sortWithinPartitions("conv", "turn", "tid")
                 .select("conv", "tid", "bytes", F.monotonically_increasing_id().alias("at")), "trie-sorted")
    rows = rows.withColumn("part", F.shiftright("at", 33))
    runs = rows.groupBy("conv", "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    runs = stage(runs.select("conv", "part", "first", F.coalesce(before, F.lit(0)).alias("before")), "trie-runs")
    return stage(rows.join(runs, ["conv", "part"]).select(
        "conv", (F.col("before") + F.col("at") - F.col("first")).alias("pos"), "tid", "bytes"), "trie-turns")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv, pos, tid, bytes) of the rebuilt conversations, and (conv, length) of all of them.

    A conversation takes the first h turns of the one whose id is the next
    lower multiple of five, then its own after its first h.
    """
    rows = _numbered(turns)
    sizes = rows.groupBy("conv").agg(F.count(F.lit(1)).alias("own"))
    sizes = sizes.select("conv", "own", (F.col("conv") - F.col("conv") % GROUP).alias("base"),
                         (F.crc32(F.col("conv").cast("string")) % MOST).alias("h"))
    lent = sizes.select(F.col("conv").alias("base"), F.col("own").alias("lends"))
    sizes = stage(sizes.join(lent, "base", "left").select(
        "conv", "own", "base", "h", F.least("h", F.coalesce("lends", F.lit(0))).alias("takes")), "trie-conversations")
    other = sizes.filter("conv != base")
    # its own rows: one row of ``sizes`` each, whose hot partitions Spark splits
    own = rows.join(sizes, "conv").filter("conv = base or pos >= h").select(
        "conv", F.when(F.expr("conv = base"), F.col("pos")).otherwise(F.expr("pos - h + takes")).alias("pos"), "tid", "bytes")
    # borrowed rows: at most MOST - 1 of a base, for its few neighbours
    first = rows.filter((F.col("pos") < MOST - 1) & (F.col("conv") % GROUP == 0)).withColumnRenamed("conv", "base")
    borrowed = first.join(other.select("conv", "base", "h"), "base").filter("pos < h").select("conv", "pos", "tid", "bytes")
    length = F.when(F.expr("conv = base"), F.col("own")).otherwise(F.col("takes") + F.greatest(F.col("own") - F.col("h"), F.lit(0)))
    return own.unionByName(borrowed), sizes.select("conv", length.alias("length"))


# ------------------------------------------------------------- segments and suffixes
def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds head, key (the head of the next segment) and last (bytes of the turn before the segment)."""
    conv = head = last = None
    for batch in batches:
        heads, keys, lasts = [], [], []
        for c, ids, lens in zip(*(batch.column(n).to_pylist() for n in ("conv", "ids", "lens"))):
            if c != conv:
                conv, head, last = c, NO_HEAD, 0
            heads.append(head)
            lasts.append(last)
            head = hashlib.sha256((head + ids).encode()).hexdigest()[:DIGITS]
            keys.append(head)
            last = lens[-1] if lens else last
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(heads, pa.string()), pa.array(keys, pa.string()), pa.array(lasts, pa.int64())],
                                         names=[*batch.schema.names, "head", "key", "last"])


SEGMENTS = "conv long, s long, ids string, lens array<long>"


def _segments(turns: DataFrame, lengths: DataFrame, segment: int) -> DataFrame:
    """One row per conversation and ``segment`` turns; the last one of each holds fewer (none at times)."""
    some = turns.groupBy("conv", F.expr(f"pos div {segment}").alias("s")).agg(
        F.sort_array(F.collect_list(F.struct("pos", "tid", "bytes"))).alias("t"))
    some = some.select("conv", "s", F.array_join("t.tid", "").alias("ids"), F.col("t.bytes").alias("lens"))
    none = lengths.filter(F.col("length") % segment == 0).select(
        "conv", F.expr(f"length div {segment}").alias("s"), F.lit("").alias("ids"), F.array().cast("array<bigint>").alias("lens"))
    rows = some.unionByName(none).repartition("conv").sortWithinPartitions("conv", "s")
    return stage(rows.mapInArrow(_chained, SEGMENTS + ", head string, key string, last long"), "trie-segments")


def _piece(ids: str, i) -> Column:
    """The i-th turn id (from 0) of a suffix."""
    return F.substring(ids, i * DIGITS + 1, F.lit(DIGITS))


def _burst(suffixes: DataFrame, burst: int, segment: int) -> tuple[DataFrame, list[tuple[DataFrame, DataFrame]]]:
    """The containers left, and per round the burst containers with their suffixes."""
    rows = suffixes.withColumns({"box": F.col("head"), "off": F.lit(0), "up": F.lit(None).cast("long")})
    small, rounds = [], []
    while True:
        size = rows.groupBy("box").agg(
            F.count(F.lit(1)).alias("n"), F.min("ids").alias("lo"), F.max("ids").alias("hi"), F.min("off").alias("from"),
            F.min("s").alias("s"), F.min("up").alias("up"), F.min("last").alias("last"), F.min("head").alias("head"),
            F.sum("k").alias("n_convs"), F.min("c0").alias("conv_id")).filter(F.col("n") > burst)
        # the turns that all suffixes share are those that the least and the largest share
        same = F.transform(F.sequence("from", F.lit(segment)), lambda i: (F.length("lo") >= (i + 1) * DIGITS) & (_piece("lo", i) == _piece("hi", i)))
        big = stage(size.withColumn("to", F.col("from") + F.array_position(same, F.lit(False)).cast("int") - 1).drop("lo", "hi"), "trie-burst")
        if big.isEmpty():
            small.append(rows)
            break
        small.append(rows.join(big.select("box"), "box", "left_anti"))
        inside = stage(rows.drop("up", "off").join(big.select("box", "to", F.col("conv_id").alias("up")), "box"), "trie-inside")
        rounds.append((big, inside))
        deeper = inside.filter(F.length("ids") > F.col("to") * DIGITS)
        rows = deeper.withColumns({"box": F.substring(F.sha2(F.concat(F.lit("burst "), "box", _piece("ids", F.col("to"))), 256), 1, DIGITS),
                                   "off": F.col("to") + 1}).select(*rows.columns)
    left = small[0]
    for more in small[1:]:
        left = left.unionByName(more)
    return stage(left, "trie-containers"), rounds


# ------------------------------------------------------------- the sweep
NODES = ("depth long, conv_id long, parent long, under string, n_convs long, n_children long, n_leaves long, "
         "saved long, ends string")
LINK = -1                      # depth of a row that only tells the parent of the container ``under``


class _Node:
    __slots__ = ("bytes", "children", "conv", "convs", "ends", "leaves", "link", "saved", "waiting")

    def __init__(self, size: int):
        self.bytes, self.conv, self.convs, self.children, self.leaves, self.saved = size, None, 0, 0, 0, 0
        self.ends = self.link = None
        self.waiting: list[list] = []          # rows of children, until this node's smallest member is known


class _Sweep:
    """The open nodes of the container that is being read, the shallowest first."""

    def __init__(self, segment: int):
        self.segment, self.box, self.stack, self.out = segment, None, [], []

    def close(self, deepest: int) -> None:
        """Close the nodes below local depth ``deepest`` (all of the container for less than its own)."""
        while self.stack and self.off + len(self.stack) - 1 > deepest:
            node = self.stack.pop()
            depth = self.off + len(self.stack)
            node.saved += (node.convs - 1) * node.bytes
            for row in node.waiting:
                row[2] = node.conv
                self.out.append(row)
            if node.link is None:
                row = [self.s * self.segment + depth, node.conv, None, None, node.convs, node.children, node.leaves, node.saved, node.ends]
            else:                              # a full segment: its node is the root of the next container
                row = [LINK, node.conv, None, node.link, 0, 0, 0, 0, None]
            if self.stack:
                over = self.stack[-1]
                over.waiting.append(row)
                over.children += 1
                over.convs += node.convs
                over.leaves += node.leaves
                over.saved += node.saved
                over.conv = node.conv if over.conv is None else min(over.conv, node.conv)
            else:
                row[2] = self.up
                if depth == 0 and self.s > 0:
                    row[3] = self.head
                self.out.append(row)

    def add(self, box, off, up, s, head, key, ids, lens, last, k, c0, leaves, beyond) -> None:
        if box != self.box:
            self.close(-1)
            self.box, self.off, self.up, self.s, self.head, self.ids = box, off, up, s, head, ids
            self.stack = [_Node(lens[off - 1] if off else last)]
        else:
            shared = len(os.path.commonprefix([self.ids, ids])) // DIGITS
            self.ids = ids
            self.close(shared)
        for depth in range(off + len(self.stack), len(lens) + 1):
            self.stack.append(_Node(lens[depth - 1]))
        node = self.stack[-1]
        node.convs += k
        node.leaves += leaves
        node.saved += beyond
        node.conv = c0 if node.conv is None else min(node.conv, c0)
        if len(lens) == self.segment:
            node.link = key
        else:
            node.ends = key

    def rows(self) -> pa.RecordBatch:
        columns = list(zip(*self.out)) or [[]] * 9
        self.out = []
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), *[pa.int64()] * 4, pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)],
                                          names=[f.split()[0] for f in NODES.split(", ")])


COLUMNS = ["box", "off", "up", "s", "head", "key", "ids", "lens", "last", "k", "c0", "leaves", "beyond"]


def _swept(containers: DataFrame, segment: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sweep = _Sweep(segment)
        for batch in batches:
            for values in zip(*(batch.column(c).to_pylist() for c in COLUMNS)):
                sweep.add(*values)
                if len(sweep.out) > 10_000:
                    yield sweep.rows()
        sweep.close(-1)
        yield sweep.rows()

    return containers.select(*COLUMNS).repartition("box").sortWithinPartitions("box", "ids").mapInArrow(run, NODES)


# ------------------------------------------------------------- burst containers
def _bytes(first, to) -> Column:
    """Bytes of the turns that lead to local depths ``first`` to ``to`` (depth 0: the turn before the segment)."""
    inner = F.aggregate(F.slice("lens", F.greatest(first, F.lit(1)), F.greatest(to - F.greatest(first, F.lit(1)) + 1, F.lit(0))),
                        F.lit(0).cast("long"), lambda a, b: a + b)
    return inner + F.when((first == 0) & (to >= 0), F.col("last")).otherwise(F.lit(0))


def _burst_nodes(big: DataFrame, inside: DataFrame, values: DataFrame | None, segment: int) -> DataFrame:
    """The nodes of the burst containers of a round: the turns that their suffixes share."""
    # distinct next turns: one row per child before they are counted
    children = (inside.filter(F.length("ids") > F.col("to") * DIGITS).select("box", _piece("ids", F.col("to")).alias("next"))
                .distinct().groupBy("box").agg(F.count(F.lit(1)).alias("children")))
    if values is None:
        inside = inside.withColumns({"leaves": F.lit(0).cast("long"), "beyond": F.lit(0).cast("long"), "m0": F.lit(None).cast("long")})
    else:
        inside = inside.join(values, "key")
    end = F.size("lens")
    own = F.least(end, (F.coalesce(F.col("m0") - 1 - F.col("s") * segment, end)).cast("int"))
    sums = inside.groupBy("box").agg(
        F.sum("leaves").alias("leaves"), F.max(F.when(end == F.col("to"), F.col("key"))).alias("key"), F.any_value("lens").alias("lens"),
        F.sum((F.col("k") - 1) * _bytes(F.col("to"), end) + _bytes(F.col("to"), own) + F.col("beyond")).alias("under"))
    rows = big.join(sums, "box").join(children, "box").withColumn("j", F.explode(F.sequence("from", "to")))
    lowest = F.col("j") == F.col("to")
    return rows.select(
        (F.col("s") * segment + F.col("j")).alias("depth"), "conv_id",
        F.when(F.col("j") == F.col("from"), F.col("up")).otherwise(F.col("conv_id")).alias("parent"),
        F.when((F.col("j") == 0) & (F.col("s") > 0), F.col("head")).alias("under"), "n_convs",
        F.when(lowest, F.col("children")).otherwise(F.lit(1)).cast("long").alias("n_children"), F.col("leaves").alias("n_leaves"),
        (F.col("under") + (F.col("n_convs") - 1) * _bytes(F.col("j"), F.col("to") - 1)).alias("saved"),
        F.when(lowest, F.col("key")).alias("ends"))


def _nodes(containers: DataFrame, rounds: list, values: DataFrame | None, segment: int) -> DataFrame:
    if values is None:
        nodes = _swept(containers.withColumns({"leaves": F.lit(0).cast("long"), "beyond": F.lit(0).cast("long")}), segment)
    else:
        nodes = _swept(containers.join(values, "key"), segment)
    for big, inside in rounds:
        nodes = nodes.unionByName(_burst_nodes(big, inside, values, segment))
    return stage(nodes, "trie-nodes")


def _values(segments: DataFrame, suffixes: DataFrame, nodes: DataFrame, segment: int) -> DataFrame:
    """Per suffix: leaves below that its members stand for, bytes they save beyond it, and ``m0`` of its smallest one.

    The first node that a conversation is the smallest member of has depth m.
    """
    named = stage(nodes.filter(F.col("depth") != LINK).groupBy(F.col("conv_id").alias("conv")).agg(
        F.min("depth").alias("m"), F.max((F.col("n_children") == 0).cast("long")).alias("leaf")), "trie-named")
    start = F.col("s") * segment
    till = F.least(F.size("lens").cast("long"), F.coalesce(F.col("m") - 1 - start, F.size("lens").cast("long"))).cast("int")
    part = F.aggregate(F.slice("lens", 1, F.greatest(till, F.lit(0))), F.lit(0).cast("long"), lambda a, b: a + b)
    later = Window.partitionBy("conv").orderBy(F.desc("s")).rowsBetween(Window.unboundedPreceding, -1)
    rows = segments.join(named, "conv", "left").select("conv", "s", "key", "leaf", part.alias("part"))
    rows = rows.select("key", F.coalesce("leaf", F.lit(0)).alias("leaf"), F.coalesce(F.sum("part").over(later), F.lit(0)).alias("beyond"))
    sums = rows.groupBy("key").agg(F.sum("leaf").alias("leaves"), F.sum("beyond").alias("beyond"))
    smallest = suffixes.select("key", F.col("c0").alias("conv")).join(named.select("conv", F.col("m").alias("m0")), "conv", "left").drop("conv")
    return stage(sums.join(smallest, "key"), "trie-values")


# ------------------------------------------------------------- digests
def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of ids of one key, joined by commas, at most about PIECE characters each."""
    out, key, held, first, total = [], None, [], None, 0

    def flush():
        nonlocal held, total
        if held:
            out.append((key, first, ",".join(held)))
        held, total = [], 0

    for batch in batches:
        for k, c in zip(batch.column("key").to_pylist(), batch.column("conv").to_pylist()):
            if k != key or total > PIECE:
                flush()
                key, first = k, c
            held.append(str(c))
            total += len(held[-1]) + 1
        yield _strings(out, ("key", "first", "piece"))
        out = []
    flush()
    yield _strings(out, ("key", "first", "piece"))


def _strings(rows: list[tuple], names: tuple) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64() if n == "first" else pa.string()) for n, c in zip(names, columns)], names=list(names))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    key, digest = None, None
    for batch in batches:
        out = []
        for k, piece in zip(batch.column("key").to_pylist(), batch.column("piece").to_pylist()):
            if k != key:
                if digest:
                    out.append((key, digest.hexdigest()))
                key, digest = k, hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(piece.encode())
        yield _strings(out, ("key", "ends_sha256"))
    if digest:
        yield _strings([(key, digest.hexdigest())], ("key", "ends_sha256"))


def _ends(segments: DataFrame, segment: int) -> DataFrame:
    """(key, ends_sha256): the ids of the conversations that end with each suffix, in rising order."""
    last = segments.filter(F.size("lens") < segment).select("key", "conv")
    pieces = last.repartitionByRange("key", "conv").sortWithinPartitions("key", "conv").mapInArrow(_pieces, "key string, first long, piece string")
    return pieces.repartition("key").sortWithinPartitions("key", "first").mapInArrow(_digests, "key string, ends_sha256 string")


def build(turns: DataFrame, burst: int = BURST, segment: int = SEGMENT, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per node of the trie of the rebuilt conversations.

    conv_id (smallest member), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256.
    """
    rows = turns.select(F.col(conv_id).cast("long").alias("conv"), F.col(turn).cast("long").alias("turn"),
                        F.col(role).alias("role"), F.col(text).alias("text"))
    segments = _segments(*rebuilt(rows), segment)
    suffixes = stage(segments.groupBy("key").agg(
        F.min("head").alias("head"), F.min("s").alias("s"), F.min("ids").alias("ids"), F.any_value("lens").alias("lens"),
        F.min("last").alias("last"), F.count(F.lit(1)).alias("k"), F.min("conv").alias("c0")), "trie-suffixes")
    containers, rounds = _burst(suffixes, burst, segment)
    values = _values(segments, suffixes, _nodes(containers, rounds, None, segment), segment)
    nodes = _nodes(containers, rounds, values, segment)

    # the smallest member of the node above a container's root is known where the segment before it was swept
    links = nodes.filter(F.col("depth") == LINK).select("under", F.col("parent").alias("over"))
    nodes = nodes.filter(F.col("depth") != LINK)
    roots = nodes.filter("under is not null").join(links, "under", "left").withColumn("parent", F.col("over")).drop("over")
    nodes = nodes.filter("under is null").unionByName(roots.select(*nodes.columns))
    ended = nodes.filter("ends is not null").join(_ends(segments, segment), F.col("ends") == F.col("key"), "left").drop("key")
    open_ = nodes.filter("ends is null").withColumn("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest()))
    return ended.unionByName(open_).select(
        "conv_id", "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
        F.col("saved").alias("saved_tokens"), "ends_sha256")

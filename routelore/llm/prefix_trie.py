"""Trie of conversation prefixes, encoded by preorder intervals.

A node is a distinct sequence of first turns (role and text); conversations that start with it are its members. Turns are named by the
MD5 digest of role and text, nodes by a digest chained over their turns. Three sorts and no loop over depths:

1. Paths (a conversation's turn digests one behind the other) are sorted by range, conversation ids behind, so subtrees are runs. A task walks its run
   with a stack: each node that closes hands its count, smallest member and last end to its parent. A node that lies in several ranges
   has a row for each, and these are added up: a node that all conversations share is a row a task, whatever its members.
2. Distinct nodes are ranked lexicographically (by first member in path order, then depth: preorder) over ranges again. Each task sums leaves and
   savings as they come; the totals of the ranges before, a row a range, make these prefix sums global.
3. A subtree is the interval from its top to the last node below it, whose place is joined by its digest. Leaves and savings of the
   subtree are differences of the prefix sums at its two ends.

One path is a row (20 bytes a turn) in one task, so a conversation's length bounds memory, not its share of the members. At most
``SHARE`` nodes of one chain share a key of the join with subtree ends. The ids of conversations that end at a node are gathered in pieces
of ``PIECE`` ids where they lie sorted already, and hashed as a stream.

Turns are in order of turn, null first, those of one turn by digest, so repeated rows are turns of their own. Null roles and texts are empty; rows
without a conversation id belong to no conversation. Whole texts of any length count; an empty table has no nodes. Columns other than
conv_id (a long), turn, role and text are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import configure, join_small, run_starts, stash

#: Bytes of a turn's digest.
WIDTH = 16
ROOT = bytes(WIDTH)
#: Ids of a piece, and rows of an Arrow batch that a task writes.
PIECE, ROWS = 4_096, 5_000
SHARE = 10_000


def paths(spark: SparkSession, turns: DataFrame) -> DataFrame:
    """(conv_id, path, lengths): of each conversation its turns' digests and, as 4-byte integers, their texts' code points."""
    configure(spark)
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)))
    rows = turns.where("conv_id is not null").select("conv_id", "turn", digest.alias("digest"), F.length(text).alias("length"))
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "digest").mapInArrow(_paths, "conv_id long, path binary, lengths binary")


def _paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Strings sorted rows together, a row a conversation."""
    last, path, lengths = None, [], []
    for batch in batches:
        ids = batch.column("conv_id").to_pylist()
        digests, sizes = batch.column("digest").to_pylist(), batch.column("length").to_numpy().astype("<i4")
        begins = [*run_starts(batch.column("conv_id")), len(ids)]
        out = []
        for a, b in zip(begins[:-1], begins[1:], strict=True):
            if ids[a] != last:
                if path:
                    out.append((last, b"".join(path), b"".join(lengths)))
                last, path, lengths = ids[a], [], []
            path.append(b"".join(digests[a:b]))
            lengths.append(sizes[a:b].tobytes())
        yield _batch(out, PATH)
    if path:
        yield _batch([(last, b"".join(path), b"".join(lengths))], PATH)


PATH = pa.schema([("conv_id", pa.int64()), ("path", pa.binary()), ("lengths", pa.binary())])


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


PARTIAL = pa.schema([
    ("node", pa.binary()), ("parent", pa.binary()), ("depth", pa.int64()), ("length", pa.int64()), ("n_convs", pa.int64()), ("conv_id", pa.int64()),
    ("first", pa.int64()), ("last", pa.int64()), ("end", pa.binary()), ("ids", pa.string()),
])
PARTIAL_DDL = "node binary, parent binary, depth long, length long, n_convs long, conv_id long, first long, last long, end binary, ids string"


class _Node:
    """A node of the current path: what it has seen of its members in this range."""

    __slots__ = ("node", "parent", "depth", "length", "n", "least", "first", "last", "end", "ids")

    def __init__(self, node: bytes, parent: bytes | None, depth: int, length: int, first: int) -> None:
        self.node, self.parent, self.depth, self.length, self.first, self.last = node, parent, depth, length, first, first
        self.n, self.least, self.end, self.ids = 0, None, node, []

    def row(self) -> tuple:
        return (self.node, self.parent, self.depth, self.length, self.n, self.least, self.first, self.last, self.end, ",".join(map(str, self.ids)) if self.ids else None)

    def piece(self, at: int) -> tuple:
        """Some of the ids that end here, as a row that adds no member."""
        ids, self.ids = self.ids, []
        return (self.node, self.parent, self.depth, self.length, 0, None, at, None, None, ",".join(map(str, ids)))


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of a range of sorted paths, each when its last member has passed."""
    at = TaskContext.get().partitionId() << 33
    stack: list[_Node] = []
    before, out = b"", []

    def close(depth: int) -> None:
        while len(stack) > depth:
            node = stack.pop()
            out.append(node.row())
            if stack:
                above = stack[-1]
                above.n, above.last, above.end = above.n + node.n, node.last, node.end
                above.least = node.least if above.least is None else min(above.least, node.least)

    for batch in batches:
        for conv, path, lengths in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            shared, most = 0, min(len(path), len(before)) // WIDTH
            if path.startswith(before):
                shared = most
            else:
                while shared < most and path[shared * WIDTH : (shared + 1) * WIDTH] == before[shared * WIDTH : (shared + 1) * WIDTH]:
                    shared += 1
            if not stack:
                stack.append(_Node(ROOT, None, 0, 0, at))
            close(shared + 1)
            sizes = np.frombuffer(lengths, "<i4")
            for depth in range(shared, len(sizes)):
                above = stack[-1].node
                stack.append(_Node(hashlib.md5(above + path[depth * WIDTH : (depth + 1) * WIDTH]).digest(), above, depth + 1, int(sizes[depth]), at))
            top = stack[-1]
            top.n, top.last = top.n + 1, at
            top.least = conv if top.least is None else min(top.least, conv)
            top.ids.append(conv)
            if len(top.ids) >= PIECE:
                out.append(top.piece(at))
            before, at = path, at + 1
            if len(out) >= ROWS:
                yield _batch(out, PARTIAL)
                out.clear()
    close(0)
    for a in range(0, len(out), ROWS):
        yield _batch(out[a : a + ROWS], PARTIAL)


def _id_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes the pieces of each node as they pass, in order."""
    last, digest = None, None
    schema = pa.schema([("node", pa.binary()), ("ends_sha256", pa.string())])
    for batch in batches:
        out = []
        for node, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if node != last:
                if digest:
                    out.append((last, digest.hexdigest()))
                last, digest = node, hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(ids.encode())
        yield _batch(out, schema)
    if digest:
        yield _batch([(last, digest.hexdigest())], schema)


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds to each node of a range in preorder its place, the leaves and savings up to it, and its parent's smallest member where that lies in the range."""
    part = TaskContext.get().partitionId()
    place = leaves = saved = 0
    path: list[tuple[bytes, int]] = []  # (node, smallest member) of the nodes above, from depth ``top`` on
    top = 0
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        is_leaf = np.array(batch.column("n_children")) == 0
        upto, worth = leaves + np.cumsum(is_leaf), saved + np.cumsum(np.array(batch.column("saved")))
        parents = []
        for node, parent, depth, conv in zip(*(batch.column(c).to_pylist() for c in ("node", "parent", "depth", "conv_id")), strict=True):
            if not path or depth <= top:
                top = depth
                path.clear()
            del path[depth - top :]
            parents.append(path[-1][1] if path and path[-1][0] == parent else None)
            path.append((node, conv))
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(np.full(n, part, np.int64)), pa.array(place + np.arange(n, dtype=np.int64)), pa.array(upto), pa.array(worth), pa.array(parents, pa.int64())],
            names=[*batch.schema.names, *NUMBERS],
        )
        place, leaves, saved = place + n, int(upto[-1]), int(worth[-1])


NUMBERS = ["part", "place", "leaves", "worth", "parent_conv_id"]


def _digested(pieces: DataFrame) -> DataFrame:
    """(node, ends_sha256) of the nodes at which conversations end."""
    dealt = pieces.where("ids is not null").select("node", "first", "ids").repartition("node").sortWithinPartitions("node", "first")
    return dealt.select("node", "ids").mapInArrow(_id_digests, "node binary, ends_sha256 string")


def trie(spark: SparkSession, sequences: DataFrame) -> DataFrame:
    """Nodes of the trie over ``sequences`` (as ``paths`` makes them), in preorder intervals.

    conv_id (the smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256, and the interval:
    place and end_place, from 0."""
    configure(spark)
    runs = sequences.repartitionByRange("path", "conv_id").sortWithinPartitions("path", "conv_id")
    pieces = stash(runs.select("conv_id", "path", "lengths").mapInArrow(_walk, PARTIAL_DDL))
    sums = [F.max(c).alias(c) for c in ("parent", "depth", "length")] + [F.sum("n_convs").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.min("first").alias("first"), F.max_by("end", "last").alias("end")]
    nodes = pieces.groupBy("node").agg(*sums)
    # nodes are merged by now, so a child counts once however many ranges have it
    children = nodes.where("depth > 0").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children"))
    nodes = nodes.join(children, "node", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))).withColumn("saved", (F.col("n_convs") - 1) * F.col("length"))
    ranked = nodes.repartitionByRange("first", "depth").sortWithinPartitions("first", "depth")
    kinds = ", ".join(f"{c} {t}" for c, t in [*nodes.dtypes, *[(c, "long") for c in NUMBERS]])
    ranked = stash(ranked.mapInArrow(_number, kinds))
    # a row a range: the sums over the ranges before
    totals = ranked.groupBy("part").agg(F.count("*").alias("rows"), F.max("leaves").alias("leaves"), F.max("worth").alias("worth"))
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select("part", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_before") for c in ("rows", "leaves", "worth")])
    ranked = ranked.join(F.broadcast(offsets), "part")
    ranked = ranked.select("*", (F.col("place") + F.col("rows_before")).alias("at"), (F.col("leaves") + F.col("leaves_before")).alias("leaves_to"), (F.col("worth") + F.col("worth_before")).alias("worth_to"))
    ranked = _with_parents(ranked).withColumn("share", F.floor(F.col("depth") / SHARE))
    leaf = F.col("n_children") == 0
    shares = F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.col("depth") / SHARE)))
    ends = ranked.where(leaf).select(F.col("node").alias("end"), F.col("at").alias("end_place"), F.col("leaves_to").alias("leaves_end"), F.col("worth_to").alias("worth_end"), shares.alias("share"))
    inner = ranked.where(~leaf).join(ends, ["end", "share"])
    single = ranked.where(leaf).select("*", F.col("at").alias("end_place"), F.col("leaves_to").alias("leaves_end"), F.col("worth_to").alias("worth_end"))
    whole = inner.unionByName(single).join(_digested(pieces), "node", "left")
    return whole.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", (F.col("leaves_end") - F.col("leaves_to") + leaf.cast("long")).alias("n_leaves"),
        (F.col("worth_end") - F.col("worth_to") + F.col("saved")).alias("saved_tokens"), F.coalesce("ends_sha256", F.sha2(F.lit(b""), 256)).alias("ends_sha256"), F.col("at").alias("place"), "end_place",
    )


def _with_parents(ranked: DataFrame) -> DataFrame:
    """Fills in the smallest members of parents that lie in an earlier range: a row for each range and each such parent, on the path that the range begins in."""
    open_ = ranked.where("parent_conv_id is null and depth > 0").select("part", "parent").distinct().checkpoint()
    known = join_small(ranked.select(F.col("node").alias("parent"), F.col("conv_id").alias("above")), open_, "parent", "inner").checkpoint()
    return join_small(ranked, known, ["part", "parent"]).withColumn("parent_conv_id", F.coalesce("parent_conv_id", "above")).drop("above")


def rebuilt(sequences: DataFrame) -> DataFrame:
    """Conversation c begins with the first h turns of conversation c - c % 100, h being the CRC-32 of c modulo 6, and goes on with its own after its first h."""
    h = (F.crc32(F.col("conv_id").cast("string")) % 6).cast("int")
    base = (F.col("conv_id") - F.col("conv_id") % 100).alias("base")
    heads = sequences.where("conv_id % 100 = 0").select(F.col("conv_id").alias("base"), F.substring("path", 1, 5 * WIDTH).alias("head"), F.substring("lengths", 1, 20).alias("head_lengths"))
    rows = sequences.select("*", base, h.alias("h")).join(heads, "base", "left")

    def joined(own: str, head: str, width: int):
        first = F.coalesce(F.substring(F.col(head), F.lit(1), F.col("h") * width), F.lit(b""))
        return F.concat(first, F.substring(F.col(own), F.col("h") * width + 1, F.octet_length(own))).alias(own)

    return rows.select("conv_id", joined("path", "head", WIDTH), joined("lengths", "head_lengths", 4))


def prefix_query(spark: SparkSession, turns: DataFrame) -> DataFrame:
    """Nodes of the trie over the rebuilt conversations."""
    return trie(spark, stash(rebuilt(stash(paths(spark, turns)))))

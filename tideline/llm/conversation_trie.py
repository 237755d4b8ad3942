"""Prefix trie of conversations, finished in sorted shards around a skeleton of splitters.

Conversations become paths of turn digests. Splitters cut the sorted paths into shards. A
node whose members lie in several shards is a prefix of a splitter, so the trie of the
splitters' paths, the skeleton, holds every such node; it is small and sent to all tasks. A
shard is one sorted pass with a stack: it finishes all its other nodes, and gives partial
aggregates of the skeleton's nodes, which are reduced and combined from the leaves up.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import partitions, stored

#: Bytes of a turn's digest in a path.
STEP = 16
#: Conversations a shard has at most about; bounds the rows a task holds.
PER_SHARD = 250_000
#: Sampled paths for each shard, of which one becomes a splitter.
OVERSAMPLE = 32
#: Turns of a splitter; a longer common beginning isn't split.
SPLITTER_TURNS = 256
#: Bytes of identifiers that leave a shard together, and rows of a result batch.
CHUNK, ROWS = 1 << 20, 20_000
#: Before every identifier.
LEAST = -(1 << 63)
EMPTY = hashlib.sha256().hexdigest()

FINISHED, UNDER_SKELETON, PARTIAL, ENDS = range(4)
NODE = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
    "n_leaves long, saved_tokens long, ends_sha256 string"
)
SHARD_ROWS = f"kind int, skeleton long, {NODE}, bytes long, shard int, at long, ids string"
NAMES = [field.split()[0] for field in NODE.split(", ")]


def rebuilt_paths(
    conversations: DataFrame,
    family: int = 5,
    most: int = 9,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """conv_id, path (digests of its turns, 16 bytes each) and bytes of each turn's text.

    Conversation c begins with the first h turns of conversation c - c % family, where h
    is crc32 of c in decimal, modulo ``most``, and goes on with its own turns after the first
    h. Turns are ordered by number, null first, and those of equal number by their digest.
    Null role or text counts as empty; rows without an identifier belong to no
    conversation. A family is the only group that is gathered: its turns' digests, not their
    texts. A conversation is one row, of 24 bytes a turn.
    """
    role, text = (F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in (role_col, text_col))
    said = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    turns = (
        conversations.select(
            F.col(f"`{id_col}`").cast("long").alias("conv_id"),
            F.struct(
                F.col(f"`{turn_col}`").alias("turn"),
                F.unhex(F.substring(F.sha2(said, 256), 1, 2 * STEP)).alias("digest"),
                F.octet_length(text).cast("long").alias("bytes"),
            ).alias("said"),
        )
        .filter("conv_id IS NOT NULL")
        .withColumn("base", F.expr(f"conv_id - conv_id % {family}"))
    )
    # Dealt by family once; conversations of a family are then gathered where they lie.
    own = (
        turns.repartition("base")
        .groupBy("base", "conv_id")
        .agg(F.sort_array(F.collect_list("said")).alias("own"))
    )
    families = own.groupBy("base").agg(F.collect_list(F.struct("conv_id", "own")).alias("all"))
    first = F.expr("coalesce(try_element_at(filter(all, c -> c.conv_id = base), 1).own, array())")
    return (
        families.select(first.alias("first"), F.explode("all").alias("c"))
        .select(
            "c.conv_id",
            "first",
            "c.own",
            F.expr(f"int(crc32(encode(string(c.conv_id), 'UTF-8')) % {most})").alias("h"),
        )
        .select(
            "conv_id",
            F.expr(
                "concat(slice(first, 1, h), slice(own, h + 1, greatest(size(own) - h, 0)))"
            ).alias("turns"),
        )
        .select(
            "conv_id",
            F.expr("unhex(array_join(transform(turns, t -> hex(t.digest)), ''))").alias("path"),
            F.expr("transform(turns, t -> t.bytes)").alias("bytes"),
        )
    )


def _common(a: bytes, b: bytes) -> int:
    """Turns that two paths have in common at their beginnings."""
    if a == b[: len(a)]:
        return len(a) // STEP
    at, most = 0, min(len(a), len(b))
    while at < most and a[at : at + STEP] == b[at : at + STEP]:
        at += STEP
    return at // STEP


class Skeleton:
    """Splitters and the trie of their paths; node 0 is the root, parents come first."""

    def __init__(self, sample: list[tuple[bytes, int]], shards: int) -> None:
        sample = sorted(sample)
        self.splitters: list[tuple[bytes, int]] = []
        for k in range(1, shards):
            at = k * len(sample) // shards
            if at == 0:
                continue
            (before, _), (path, conv) = sample[at - 1], sample[at]
            if path == before:
                self.splitters.append((path, conv))
            else:  # no more turns than tell it from the one before
                self.splitters.append((path[: STEP * (_common(before, path) + 1)], LEAST))
        self.splitters = sorted(set(self.splitters))
        self.next: dict[tuple[int, bytes], int] = {}
        self.parents, self.depths = [-1], [0]
        for path, _ in self.splitters:
            node = 0
            for at in range(0, len(path), STEP):
                step = (node, path[at : at + STEP])
                if step not in self.next:
                    self.next[step] = len(self.parents)
                    self.parents.append(node)
                    self.depths.append(self.depths[node] + 1)
                node = self.next[step]

    def shard(self, path: bytes, conv: int) -> int:
        return bisect_right(self.splitters, (path, conv))


class _Open:
    """A node on the stack, with what is known of it so far."""

    __slots__ = ("skeleton", "bytes", "least", "n", "ends", "ids", "children", "leaves", "saved", "rows")

    def __init__(self, skeleton: int | None, size: int) -> None:
        self.skeleton, self.bytes = skeleton, size
        self.least = self.ends = None
        self.n = self.children = self.leaves = self.saved = 0
        self.ids: list[str] = []  # of a skeleton node: ends that wait to be sent
        self.rows: list[tuple] = []  # finished children, until the smallest member is known


class _Shard:
    """One pass over a shard's paths in order; rows of SHARD_ROWS collect in ``out``."""

    def __init__(self, skeleton: Skeleton, number: int, out: list[tuple]) -> None:
        self.skeleton, self.number, self.out = skeleton, number, out
        self.path = b""
        self.stack = [_Open(0, 0)]
        self.sent = 0
        self.waiting = 0  # bytes of identifiers of the innermost node

    def add(self, conv: int, path: bytes, sizes: list[int]) -> None:
        shared = _common(self.path, path)
        while len(self.stack) > shared + 1:
            self.close()
        if len(path) // STEP > shared:
            self.send(self.stack[-1])
        for depth in range(shared, len(path) // STEP):
            above = self.stack[-1].skeleton
            step = path[depth * STEP : (depth + 1) * STEP]
            here = None if above is None else self.skeleton.next.get((above, step))
            self.stack.append(_Open(here, sizes[depth]))
        self.path = path
        node = self.stack[-1]
        node.n += 1
        node.least = conv if node.least is None else min(node.least, conv)
        if node.skeleton is not None:
            node.ids.append(str(conv))
            self.waiting += len(node.ids[-1]) + 1
            if self.waiting >= CHUNK:
                self.send(node)
        elif node.ends is None:
            node.ends = hashlib.sha256(str(conv).encode())
        else:
            node.ends.update(f",{conv}".encode())

    def send(self, node: _Open) -> None:
        """Identifiers that end at a skeleton node, in order; only the innermost has any."""
        if node.ids:
            row = (ENDS, node.skeleton, *(None,) * 9, self.number, self.sent, ",".join(node.ids))
            self.out.append(row)
            node.ids = []
            self.sent += 1
        self.waiting = 0

    def close(self) -> None:
        node = self.stack.pop()
        depth = len(self.stack)
        above = self.stack[-1] if self.stack else None
        if above is not None:
            above.n += node.n
            above.least = node.least if above.least is None else min(above.least, node.least)
        if node.skeleton is not None:
            self.send(node)
            sums = (node.n, node.children, node.leaves, node.saved)
            self.out.append(
                (PARTIAL, node.skeleton, node.least, depth, None, *sums, None, node.bytes, self.number, None, None)
            )
            return
        leaves = node.leaves or 1
        saved = node.saved + (node.n - 1) * node.bytes
        ends = node.ends.hexdigest() if node.ends else EMPTY
        row = (node.least, depth, node.n, node.children, leaves, saved, ends)
        for conv, *rest in node.rows:
            self.out.append(_node_row(FINISHED, None, conv, node.least, rest))
        above.children += 1
        above.leaves += leaves
        above.saved += saved
        if above.skeleton is None:
            above.rows.append(row)
        else:
            self.out.append(_node_row(UNDER_SKELETON, above.skeleton, row[0], None, row[1:]))

    def finish(self) -> None:
        while self.stack:
            self.close()


def _node_row(kind: int, skeleton: int | None, conv: int, parent: int | None, rest) -> tuple:
    depth, *sums = rest
    return (kind, skeleton, conv, depth, parent, *sums, None, None, None, None)


def _finish_shards(skeleton: Skeleton):
    """Rows of (shard, conv_id, path, bytes), sorted, to rows of SHARD_ROWS."""
    kinds = {"int": pa.int32(), "long": pa.int64(), "string": pa.string()}
    fields = (field.split() for field in SHARD_ROWS.split(", "))
    schema = pa.schema([(name, kinds[kind]) for name, kind in fields])

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
        )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        shard = None
        for part in batches:
            numbers, convs, paths, sizes = (c.to_pylist() for c in part.columns)
            for number, conv, path, size in zip(numbers, convs, paths, sizes, strict=True):
                if shard is None or shard.number != number:
                    if shard is not None:
                        shard.finish()
                    shard = _Shard(skeleton, number, out)
                shard.add(conv, path, size)
                if len(out) >= ROWS:
                    yield batch(out)
                    out.clear()
        if shard is not None:
            shard.finish()
        for at in range(0, len(out), ROWS):
            yield batch(out[at : at + ROWS])

    return run


def _hash_ends(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest of the identifiers of every skeleton node, from chunks in order."""
    node, running = None, None
    done: list[tuple[int, str]] = []
    for part in batches:
        nodes, chunks = (c.to_pylist() for c in part.columns)
        for number, chunk in zip(nodes, chunks, strict=True):
            if number != node:
                if running is not None:
                    done.append((node, running.hexdigest()))
                node, running = number, hashlib.sha256(chunk.encode())
            else:
                running.update(f",{chunk}".encode())
    if running is not None:
        done.append((node, running.hexdigest()))
    yield pa.RecordBatch.from_arrays(
        [pa.array([d[0] for d in done], pa.int64()), pa.array([d[1] for d in done], pa.string())],
        ["skeleton", "ends"],
    )


def _combine(skeleton: Skeleton, rows: DataFrame) -> list[tuple]:
    """The skeleton's nodes as rows of NODE, by node; at most one row a node is gathered."""
    sums = ("n_convs", "n_children", "n_leaves", "saved_tokens")
    found = {
        r.skeleton: r
        for r in rows.filter(F.col("kind") == PARTIAL)
        .groupBy("skeleton")
        .agg(
            F.min("conv_id").alias("conv_id"),
            F.max("bytes").alias("bytes"),
            *(F.sum(s).alias(s) for s in sums),
        )
        .collect()
    }
    ends = {
        r.skeleton: r.ends
        for r in rows.filter(F.col("kind") == ENDS)
        .select("skeleton", "shard", "at", "ids")
        .repartition("skeleton")
        .sortWithinPartitions("skeleton", "shard", "at")
        .select("skeleton", "ids")
        .mapInArrow(_hash_ends, "skeleton long, ends string")
        .collect()
    }
    size = len(skeleton.parents)
    children, leaves, saved = (np.zeros(size, object) for _ in range(3))
    done = []
    for node in reversed(range(size)):
        part, above = found.get(node), skeleton.parents[node]
        if part is None:
            continue
        children[node] += part.n_children
        leaves[node] = (leaves[node] + part.n_leaves) or 1
        saved[node] += part.saved_tokens + (part.n_convs - 1) * part.bytes
        if above >= 0:
            children[above] += 1
            leaves[above] += leaves[node]
            saved[above] += saved[node]
        done.append(
            (
                node,
                part.conv_id,
                skeleton.depths[node],
                found[above].conv_id if above >= 0 else None,
                part.n_convs,
                int(children[node]),
                int(leaves[node]),
                int(saved[node]),
                ends.get(node, EMPTY),
            )
        )
    return done


def prefix_trie(paths: DataFrame, shards: int | None = None) -> DataFrame:
    """One row per node of the trie of ``paths`` (conv_id, path, bytes), the root included.

    Columns: conv_id (smallest member), depth, parent_conv_id (smallest member of the
    parent; null at the root), n_convs (members), n_children, n_leaves and saved_tokens
    (of the whole subtree), ends_sha256 (of the members that end here, in order).

    Defined cases: equal paths are members of the same nodes, however many they are, and
    lie in several shards; an empty path is a member of the root alone; a path may be
    long, the stack of a task has one entry a turn; an empty table gives no rows. Every
    conv_id must occur once. What reaches the driver and all tasks is the skeleton: at most
    SPLITTER_TURNS nodes for each shard, whatever the table's size.
    """
    spark = paths.sparkSession
    paths = stored(paths.select("conv_id", "path", "bytes"), "conversation-paths")
    total = paths.count()
    shards = shards or max(partitions(spark), -(-total // PER_SHARD))
    share = min(1.0, shards * OVERSAMPLE / max(total, 1))
    sample = (
        paths.select(F.substring("path", 1, STEP * SPLITTER_TURNS).alias("path"), "conv_id")
        .filter(F.pmod(F.xxhash64("conv_id"), F.lit(1 << 32)) < int(share * (1 << 32)))
        .collect()
    )
    skeleton = Skeleton([(bytes(r.path), r.conv_id) for r in sample], shards)

    @F.arrow_udf("int")
    def shard(path: pa.Array, conv: pa.Array) -> pa.Array:
        pairs = zip(path.to_pylist(), conv.to_pylist(), strict=True)
        return pa.array([skeleton.shard(p, c) for p, c in pairs], pa.int32())

    dealt = (
        paths.withColumn("shard", shard("path", "conv_id"))
        .repartitionById(shards, F.col("shard"))
        .sortWithinPartitions("shard", "path", "conv_id")
        .select("shard", "conv_id", "path", "bytes")
    )
    rows = stored(dealt.mapInArrow(_finish_shards(skeleton), SHARD_ROWS), "trie-shards")

    top = spark.createDataFrame(_combine(skeleton, rows), f"node long, {NODE}")
    least = top.select("node", F.col("conv_id").alias("above"))
    under = (
        rows.filter(F.col("kind") == UNDER_SKELETON)
        .join(F.broadcast(least), F.col("skeleton") == F.col("node"))
        .withColumn("parent_conv_id", F.col("above"))
    )
    finished = rows.filter(F.col("kind") == FINISHED)
    return finished.select(*NAMES).unionByName(under.select(*NAMES)).unionByName(top.select(*NAMES))


def conversation_trie(conversations: DataFrame, **options) -> DataFrame:
    """The prefix trie of the rebuilt conversations; options as for ``rebuilt_paths``."""
    return prefix_trie(rebuilt_paths(conversations, **options))

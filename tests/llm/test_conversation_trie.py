"""The trie against one of nested dictionaries, over any number of shards."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from tideline.llm.conversation_trie import (
    LEAST,
    STEP,
    Skeleton,
    conversation_trie,
    prefix_trie,
    rebuilt_paths,
)
from tideline.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()


def said(role, text):
    role, text = role or "", text or ""
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()


def plain_way(rows):
    """Nodes of the rebuilt conversations, by brute force."""
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append(
                ((turn is not None, turn or 0), said(role, text), role or "", text or "")
            )
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}
    members = {}
    for conv, turns in own.items():
        h = zlib.crc32(str(conv).encode()) % 9
        base = conv - int(abs(conv) % 5) * (1 if conv >= 0 else -1)
        rebuilt = tuple(own.get(base, [])[:h] + turns[h:])
        for depth in range(len(rebuilt) + 1):
            members.setdefault(rebuilt[:depth], []).append((conv, len(rebuilt)))
    children = {}
    for path in members:
        if path:
            children.setdefault(path[:-1], []).append(path)
    leaves, saved, out = {}, {}, []
    for path in sorted(members, key=len, reverse=True):
        below, n = children.get(path, []), len(members[path])
        leaves[path] = sum(leaves[c] for c in below) or 1
        size = len(path[-1][1].encode()) if path else 0
        saved[path] = (n - 1) * size + sum(saved[c] for c in below)
        ends = ",".join(str(c) for c in sorted(c for c, d in members[path] if d == len(path)))
        out.append(
            (
                min(members[path])[0],
                len(path),
                min(members[path[:-1]])[0] if path else None,
                n,
                len(below),
                leaves[path],
                saved[path],
                hashlib.sha256(ends.encode()).hexdigest(),
            )
        )
    return sorted(out, key=str)


def nodes(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=str)


def conversations(seed, n=300):
    """Conversations with common beginnings, copies, gaps, ties, nulls and a long one."""
    draw = random.Random(seed)
    rows = []
    for conv in draw.sample(range(-40, 4 * n), n):
        if draw.random() < 0.35:  # a third are copies of one
            rows += [(conv, t, "user", f"copied turn {t}") for t in range(10)]
            continue
        for turn in range(draw.choice([1, 1, 2, 4, 9, 14])):
            text = draw.choice(["", None, "ja", "nein, é", "x" * 50, f"own {conv % 3}"])
            number = draw.choice([turn, turn, turn, None, 1])
            rows.append((conv, number, draw.choice(["user", "assistant", None, ""]), text))
    rows += [(10_001, t, "user", f"long {t}") for t in range(600)]
    rows += [(10_003, t, "user", f"long {t}") for t in range(590)]
    rows += [(None, 0, "user", "of no conversation")]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("shards", [1, 2, 7, 64])
def test_equals_the_plain_way(spark, seed, shards):
    rows = conversations(seed)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert nodes(prefix_trie(rebuilt_paths(df), shards=shards)) == plain_way(rows)


def test_default_shards_on_the_table(spark):
    folder = "/root/testdata/sf0.01"
    df = spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text")
    rows = QUERIES["op13_conversation_trie"](spark, folder)
    assert rows.columns == COLUMNS
    assert nodes(rows) == plain_way([tuple(r) for r in df.collect()])


def test_role_and_text_are_told_apart(spark):
    rows = [(0, 0, "user", "1:x"), (100, 0, "user1:", "x"), (200, 0, "use", "r1:x"), (300, 0, "", "user1:x")]
    assert nodes(conversation_trie(spark.createDataFrame(rows, SCHEMA))) == plain_way(rows)


def test_conversations_that_keep_no_turn(spark):
    # h is larger than the number of own turns, and the first of the family is absent.
    rows = [(c, 0, "user", "x") for c in range(1, 200) if c % 5]
    expected = plain_way(rows)
    root = next(r for r in expected if r[1] == 0)
    assert root[7] != hashlib.sha256().hexdigest()
    assert nodes(conversation_trie(spark.createDataFrame(rows, SCHEMA))) == expected


def test_a_group_of_copies_lies_in_many_shards(spark):
    path = b"".join(bytes([i]) * STEP for i in range(3))
    sample = [(path, i) for i in range(0, 3000, 7)] + [(path[:STEP] + b"z" * STEP, 9000)]
    skeleton = Skeleton(sample, 8)
    shards = {skeleton.shard(path, i) for i in range(3000)}
    assert len(shards) == 8
    assert len(skeleton.parents) <= 1 + 3 + 1


def test_splitters_are_as_short_as_tells_them_apart():
    paths = [b"".join(bytes([d]) * STEP for d in (i, *range(20))) for i in range(50)]
    skeleton = Skeleton([(p, i) for i, p in enumerate(paths)], 5)
    assert len(skeleton.splitters) == 4
    assert all(len(p) == STEP and conv == LEAST for p, conv in skeleton.splitters)


def test_defined_cases(spark):
    rows = [
        (1, 0, "user", "a"),
        (1, 0, "user", "a"),
        (1, None, None, None),
        (None, None, None, None),
        (0, 0, "user", "b " * 500_000),
        (5, 0, "user", ""),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    odd = df.withColumn("base", F.lit("x")).withColumn("shard", F.lit(1)).withColumn("path", F.lit("y"))
    odd = odd.withColumn("all", F.lit(1)).withColumn("a.b", F.lit(1)).withColumn("said", F.lit(0))
    assert nodes(conversation_trie(odd)) == plain_way(rows)
    assert conversation_trie(df.filter("false")).collect() == []


def test_result_does_not_depend_on_partitions(spark):
    df = spark.createDataFrame(conversations(3, 100), SCHEMA)
    assert nodes(conversation_trie(df.coalesce(1))) == nodes(conversation_trie(df.repartition(9)))

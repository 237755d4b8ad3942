import random
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import tideline.llm.near_dedup as module
from tideline.llm.components import components
from tideline.llm.near_dedup import (
    aligned,
    labelled,
    near_classes,
    near_dedup,
    needed,
    shingles,
    sketch,
)
from tideline.llm.words import words


def common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            here = row[j]
            row[j] = last + 1 if x == y else max(row[j], row[j - 1])
            last = here
    return row[-1]


SEQUENCES = st.lists(st.integers(0, 6), min_size=1, max_size=40)


@settings(max_examples=400, deadline=None)
@given(SEQUENCES, SEQUENCES, st.sampled_from([0.5, 0.8]))
def test_alignment_in_the_band_is_exact(a, b, similarity):
    need = needed(len(a), len(b), similarity)
    exact = common(a, b)
    found = aligned(np.array(a, "u8"), np.array(b, "u8"), need)
    assert found == (exact if exact >= need else 0)


def test_needed():
    for n in range(1, 60):
        for m in range(1, 60):
            k = needed(n, m, 0.8)
            assert k * 10 >= 8 * (n + m - k) and (k - 1) * 10 < 8 * (n + m - k + 1)


def test_labels_and_sketches():
    found = shingles(words([b"a b c d e f a b c d e f a b c d e f"]).hashes)
    assert len(set(found.tolist())) < len(found) == len(set(labelled(found).tolist()))
    assert (sketch(labelled(found)) == sketch(labelled(found))).all()
    # The order counts: the same shingles backwards agree in no sketch.
    kinds = labelled(shingles(words([" ".join(map(str, range(400))).encode()]).hashes))
    assert not (sketch(kinds) == sketch(kinds[::-1])).any()


def test_sketches_of_long_texts(monkeypatch):
    kinds = np.arange(5000, dtype="u8") * np.uint64(0x9E3779B97F4A7C15)
    expected = sketch(kinds)
    monkeypatch.setattr(module, "LONG", 100)
    assert (sketch(kinds) == expected).all()


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rng = random.Random(seed)
    links = [(rng.randint(0, 80), rng.randint(0, 80)) for _ in range(60)]
    links += [(200 + i, 201 + i) for i in range(40)] + [(300, 300 + i) for i in range(1, 50)]
    links += [(5, 5), (200, 201)]
    parent = {x: x for link in links for x in link}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    df = spark.createDataFrame(links, "x long, y long")
    found = {r.node: r.root for r in components(df, "x", "y").collect()}
    alone = {x for x in parent if all(x not in link for link in links if link[0] != link[1])}
    assert found == {x: find(x) for x in parent if x not in alone}


def test_no_links(spark):
    assert components(spark.createDataFrame([], "x long, y long"), "x", "y").count() == 0


def brute(rows, similarity=0.8):
    runs = [shingles(words([(t or "").encode()]).hashes.astype("<u4")) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(runs):
        for j, b in enumerate(runs[:i]):
            same = len(a) == len(b) and (a == b).all()
            if same or len(a) and len(b) and aligned(a, b, needed(len(a), len(b), similarity)):
                parent[find(i)] = find(j)
    members = defaultdict(list)
    for i in range(len(rows)):
        members[find(i)].append(rows[i][0])
    return sorted((i, min(m), len(m)) for m in members.values() for i in m)


def classes(df):
    return sorted((r.doc_id, r.class_id, r.class_size) for r in near_classes(df).collect())


def planted(rng, base, edits):
    out = list(base)
    for _ in range(edits):
        k = rng.randrange(len(out))
        kind = rng.random()
        if kind < 0.6:
            out[k] = f"new{rng.random()}"
        elif kind < 0.8:
            del out[k]
        else:
            out.insert(k, f"new{rng.random()}")
    return " ".join(out)


@pytest.mark.parametrize("block", [4, 256])
def test_against_all_pairs(make, monkeypatch, block):
    """Groups with all degrees of edits, a passage in many texts, repeated lines."""
    monkeypatch.setattr(module, "BLOCK", block)
    rng = random.Random(17)

    def prose(n):
        return [f"w{rng.randint(0, 3000)}" for _ in range(n)]

    texts = []
    for size in (40, 80, 200):
        base = prose(size)
        texts += [planted(rng, base, rng.randint(0, size // 20)) for _ in range(30)]
    passage = prose(60)
    texts += [" ".join(prose(20) + passage + prose(20)) for _ in range(40)]
    texts += [" ".join(["line of the same five words"] * n) for n in range(1, 30)]
    texts += [" ".join(prose(n)) for n in range(1, 40)]
    texts += ["", " ", "one", "one", "one  two", "one two"]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    assert classes(make(rows).repartition(7)) == brute(rows)


def test_edge_cases(edge, nothing):
    rows = near_classes(edge).collect()
    assert len(rows) == edge.count()
    of = {r.doc_id: r for r in rows}
    assert of[3].class_id == of[4].class_id == of[9].class_id == 3
    assert of[6].class_id == of[7].class_id == 6
    assert sorted(r.kept for r in rows if r.doc_id == 8) == [False, True]
    assert of[None].class_id is None and of[None].kept
    left = near_dedup(edge)
    assert left.columns == edge.columns
    assert sorted(r.doc_id or 0 for r in left.collect()) == [0, 1, 3, 5, 6, 8]
    assert near_classes(nothing).count() == 0 and near_dedup(nothing).count() == 0


def test_near_copies_of_repeated_identifiers_go(make):
    one, two, three = (" ".join(f"{name}{i}" for i in range(200)) for name in "abc")
    rows = [
        (1, one), (2, one + " end"), (2, two),
        (3, three), (3, three + " end"), (3, three.replace(" ", "  ")),
    ]
    left = near_dedup(make(rows).repartition(3)).collect()
    found = sorted((r.doc_id, r.text[0]) for r in left)
    assert found == [(1, "a"), (2, "b"), (3, "c")]


LONG_SEQUENCES = st.lists(st.integers(0, 30), min_size=100, max_size=400)


@settings(max_examples=150, deadline=None)
@given(LONG_SEQUENCES, st.data(), st.sampled_from([0.3, 0.6, 0.8]))
def test_bands_that_slide_and_widen_are_exact(a, data, similarity):
    b = list(a)
    for _ in range(data.draw(st.integers(0, 60))):
        at = data.draw(st.integers(0, len(b)))
        if data.draw(st.booleans()):
            b[at : at + data.draw(st.integers(0, 9))] = []
        else:
            b[at:at] = data.draw(st.lists(st.integers(0, 40), max_size=9))
    if not b:
        return
    need = needed(len(a), len(b), similarity)
    exact = common(a, b)
    for narrow in (1, 16, 64):
        module.NARROW = narrow
        try:
            found = aligned(np.array(a, "u8"), np.array(b, "u8"), need)
        finally:
            module.NARROW = 64
        assert found == (exact if exact >= need else 0)


def test_long_texts_with_few_changes_take_little_time():
    import time

    rng = np.random.default_rng(3)
    a = rng.integers(0, 1 << 60, 1_000_000).astype("u8")
    b = a.copy()
    at = rng.choice(len(b), 200, replace=False)
    b[at] = rng.integers(0, 1 << 60, len(at))
    begin = time.monotonic()
    assert aligned(a, b, needed(len(a), len(b), 0.8)) == len(a) - 200
    assert time.monotonic() - begin < 60


def test_groups_meet_in_any_batches():
    """Pairs of groups that lie in one batch, in several, and together with others."""
    import pyarrow as pa

    rng = random.Random(2)
    rows, expected = [], set()
    for bucket in range(40):
        sides = rng.choice([[0], [0, 1]])
        size = rng.randint(0, 9)
        group = [(bucket, 0, sides[-1], rng.choice(sides), 100 * bucket + k) for k in range(size)]
        group.sort(key=lambda r: r[3])
        two = len({r[3] for r in group}) == 2
        for x in group:
            for y in group:
                if x[4] < y[4] and (not two or x[3] != y[3]):
                    expected.add((x[4], y[4]))
        rows += group
    batch = pa.RecordBatch.from_pydict(
        {
            **{n: pa.array([r[k] for r in rows], pa.int64()) for k, n in enumerate(["bucket", "low", "high", "side", "row"])},
            "root": pa.array([r[4] for r in rows], pa.int64()),
            "n": pa.array([8] * len(rows), pa.int64()),
            "u": pa.array([0] * len(rows), pa.int64()),
            "bits": pa.array([b"\xff"] * len(rows), pa.binary()),
            "sketches": pa.array([[r[0], 7] for r in rows], pa.list_(pa.int64())),
        }
    )
    for step in (1, 2, 5, 17, len(rows)):
        parts = [batch.slice(k, step) for k in range(0, len(rows), step)]
        found = [
            pair
            for out in module._blocks(0.8)(parts)
            for pair in zip(out.column(0).to_pylist(), out.column(1).to_pylist(), strict=True)
        ]
        assert len(found) == len(set(found)) and set(found) == expected
    assert list(module._blocks(0.8)([])) == []

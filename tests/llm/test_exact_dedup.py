import hashlib
import random
from collections import defaultdict

import pytest

from tideline.llm.exact_dedup import exact_classes, exact_dedup


def classes(df, **options):
    return sorted(map(tuple, exact_classes(df, **options).collect()), key=repr)


def brute(rows, keep=max):
    groups = defaultdict(list)
    for i, text in rows:
        groups[text or ""].append(i)
    out = []
    for i, text in rows:
        members = [m for m in groups[text or ""] if m is not None]
        best = keep(members) if members else None
        sha = hashlib.sha256((text or "").encode()).hexdigest()
        out.append((i, best, len(groups[text or ""]), i == best, sha))
    return sorted(out, key=repr)


@pytest.mark.parametrize("keep", ["max", "min"])
@pytest.mark.parametrize("fan_in", [2, 16])
def test_groups_of_any_size(make, keep, fan_in):
    rng = random.Random(3)
    rows = [(i, f"t{min(rng.randint(0, 300), 200)}") for i in range(3000)]
    df = make(rows).repartition(11)
    assert classes(df, keep=keep, fan_in=fan_in) == brute(rows, max if keep == "max" else min)


def test_edge_cases(edge, make):
    rows = [(r.doc_id, r.text) for r in edge.collect()]
    found = exact_classes(edge).collect()
    assert [r for r in classes(edge) if r[0] != 8] == [r for r in brute(rows) if r[0] != 8]
    # Of the repeated row one is kept and both count.
    assert sorted(r.kept for r in found if r.doc_id == 8) == [False, True]
    assert {r.group_size for r in found if r.doc_id == 8} == {2}
    # Null and empty are equal; a null identifier stays where there is no other.
    assert {r.keep_id for r in found if r.doc_id in (3, 4)} == {4}
    assert [r.kept for r in found if r.doc_id is None] == [True]
    assert classes(make([(None, "x"), (1, "x")]))[0][1] == 1


def test_rows_that_stay_have_all_columns(edge):
    left = exact_dedup(edge)
    assert left.columns == edge.columns
    assert sorted((r.doc_id or 0 for r in left.collect())) == [0, 2, 4, 5, 7, 8, 9]


def test_copies_of_repeated_identifiers_go(make):
    rows = [(1, "one"), (1, "two"), (2, "one"), (None, "two"), (None, "three"), (None, "four")]
    left = exact_dedup(make([*rows, (4, None), (4, ""), (1, "two")]).repartition(3))
    found = sorted((r.doc_id or 0, r.text or "") for r in left.collect())
    assert found == [(0, "four"), (0, "three"), (1, "two"), (2, "one"), (4, "")]


def test_empty_table(nothing):
    assert exact_classes(nothing).count() == 0
    assert exact_dedup(nothing).count() == 0


def test_unknown_rule(edge):
    with pytest.raises(ValueError):
        exact_classes(edge, keep="first")


def test_no_python_in_the_plan(edge):
    plan = exact_classes(edge)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan

"""Fill-in-middle against a plain version that slices strings, and exact restoration."""

import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tideline.llm.fill_in_middle import Layout, fill_in_middle, invert, rearrange, restore, rotate

UNIT = re.compile("[\x20\x09-\x0d]*[^\x20\x09-\x0d]+|[\x20\x09-\x0d]+")
NAMES = "n form prefix_chars middle_chars output".split()


def plain_way(doc_id, text, rate=50, spm_rate=80):
    text = text or ""
    units = UNIT.findall(text)
    hexed = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(hexed[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(units)
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= rate:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < spm_rate:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


TEXTS = [
    "", None, " ", "\n\t ", "a", " a", "a ", "  a  b c \n", "ein Äpfel, zwei Bäume 🌲🌲 ",
    "<P> stays", "x <M>", "<S>", "< P> < S> <M", "P> S> M> <", "word " * 5000, "né" * 3000,
    "\x1c \x1d\x85  x", "a\x00b c\x00",
]


@pytest.fixture(scope="module")
def mixed(spark):
    rows = [(i, t) for i in range(40) for t in TEXTS] + [(None, "no identifier here")]
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(5)


@pytest.mark.parametrize(("rate", "spm_rate"), [(50, 80), (100, 50), (0, 100)])
def test_equals_the_plain_way(mixed, rate, spm_rate):
    layout = Layout(rate=rate, spm_rate=spm_rate)
    rows = fill_in_middle(mixed.withColumn("source_text", F.col("text")), layout).collect()
    assert len(rows) == mixed.count()
    for r in rows:
        assert tuple(r[n] for n in NAMES) == plain_way(r.doc_id, r.source_text, rate, spm_rate)


def test_restores_every_text(mixed):
    layout = Layout(rate=100, spm_rate=50)
    back = restore(fill_in_middle(mixed.withColumn("was", F.col("text")), layout), layout)
    rows = back.collect()
    assert len(rows) == mixed.count()
    assert all(r.text == (r.was or "") for r in rows)


def test_result_does_not_depend_on_partitions(mixed):
    def found(df):
        return sorted(map(tuple, fill_in_middle(df).collect()), key=repr)

    assert found(mixed.coalesce(1)) == found(mixed.repartition(7))


def test_other_marks(spark):
    layout = Layout(rate=100, prefix="«pre»", suffix="[suf]", middle="{mid}")
    df = spark.createDataFrame([(i, "eins zwei drei vier fünf") for i in range(30)], "doc_id long, text string")
    out = fill_in_middle(df, layout)
    assert out.filter("contains(output, '«pre»') and contains(output, '{mid}')").count() == 30
    assert {r.text for r in restore(out, layout).collect()} == {"eins zwei drei vier fünf"}


@pytest.mark.parametrize("marks", [("<P>", "<P>", "<M>"), ("", "b", "c"), ("ab", "bc", "d"), ("aba", "x", "y")])
def test_marks_that_could_be_misread_are_refused(marks):
    with pytest.raises(ValueError):
        Layout(prefix=marks[0], suffix=marks[1], middle=marks[2])


@given(st.binary(max_size=40), st.data())
@settings(max_examples=200, deadline=None)
def test_rotation_exchanges_blocks(raw, data):
    cuts = sorted(data.draw(st.tuples(*[st.integers(0, len(raw))] * 3)))
    buffer = bytearray(raw)
    rotate(buffer, *cuts)
    a, b, c = cuts
    assert buffer == raw[:a] + raw[b:c] + raw[a:b] + raw[c:]


@given(st.text("<>PSM a", max_size=30), st.data(), st.sampled_from(["psm", "spm"]))
@settings(max_examples=400, deadline=None)
def test_pieces_of_marks_in_the_text_do_no_harm(text, data, form):
    raw, layout = text.encode(), Layout()
    if any(mark in raw for mark in layout.marks):
        return
    first, second = sorted(data.draw(st.tuples(*[st.integers(0, len(raw))] * 2)))
    assert invert(bytes(rearrange(raw, first, second, form, layout)), form, layout) == raw


def test_defined_cases(edge, nothing):
    layout = Layout(rate=100)
    out = fill_in_middle(edge.withColumn("form", F.lit("old")).withColumn("Output", F.lit(1)), layout)
    kept = [c for c in edge.columns if c not in ("text", "n")]
    assert out.columns == kept + NAMES
    rows = out.collect()
    assert len(rows) == edge.count()
    assert sum(r.doc_id == 8 for r in rows) == 2
    assert {r.form for r in rows if r.doc_id in (3, 4)} == {"plain"}
    assert all(r.lang == "en" for r in rows)
    before = {(r.doc_id, r.text or "") for r in edge.collect()}
    assert {(r.doc_id, r.text) for r in restore(out, layout).collect()} == before
    assert fill_in_middle(nothing).collect() == []
    assert restore(fill_in_middle(nothing)).collect() == []


def test_no_shuffle(mixed):
    plan = restore(fill_in_middle(mixed.coalesce(2)))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan.replace("RoundRobin", "").split("MapInArrow")[1]

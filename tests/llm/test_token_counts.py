import random

import public_tokenizers
import pytest
import sentencepiece

import tideline.llm.token_counts as module
from tideline.llm.token_counts import PieceCounter, pre_tokens, token_counts

PATH = public_tokenizers.path("piece_bpe_32k.model")
ALPHABET = "ab'sdtreABZé ñ.,!#$<s></s><unk>\n\t  　ﬁİΣς日本1234\x1c\x00 ▁▁😀-_  \n\n"


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def test_odd_texts(spark, library):
    rng = random.Random(1)
    texts = ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 40))) for _ in range(5000)]
    texts += ["", " ", "  ", "\n", " \n", "a ", " a", "<0x0A>", "</s>"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    found = {r.doc_id: (r.n_bytes, r.n_tokens) for r in token_counts(df, PATH).collect()}
    for i, text in enumerate(texts):
        assert found[i] == (len(text.encode()), len(library.encode(text))), repr(text)


def test_edge_cases(edge, nothing, library):
    rows = sorted(map(tuple, token_counts(edge, PATH).collect()), key=repr)
    expected = sorted(
        (
            (r.doc_id, len((r.text or "").encode()), len(library.encode(r.text or "")))
            for r in edge.collect()
        ),
        key=repr,
    )
    assert rows == expected
    assert token_counts(nothing, PATH).count() == 0


def test_blocks_of_any_size(edge, library, monkeypatch):
    # Workers are forked from this process, so the smaller bound reaches them by the function.
    import tideline.llm.token_counts as module

    def rows():
        return sorted(map(tuple, module.token_counts(edge, PATH).collect()), key=repr)

    expected = rows()
    monkeypatch.setattr(module, "partitions", lambda spark: 3)
    assert rows() == expected


def test_pre_tokens_join_to_the_text():
    for text in ["a b", " a  b ", "a\nb", "\n\na \n b", "▁x", "a"]:
        joined = "".join(u if u.startswith("\n") else "▁" + u for u in pre_tokens(text))
        assert joined == "▁" + text.replace(" ", "▁")


def test_each_pre_token_is_counted_alone(library):
    counter = PieceCounter(PATH)
    assert counter.count(["the", "\nthe", "▁▁a"]) == [
        len(library.encode("the")),
        len(library.encode("x\nthe")) - len(library.encode("x")),
        len(library.encode("  a")),
    ]


def test_numbers_of_every_width(spark, library):
    """Pre-tokens and counts beyond one and two bytes, and more documents than two bytes hold."""
    texts = ["x" * 70_000 + " y", "a " * 70_000, "b " * 300 + "c" * 300] + ["a b"] * 70_000
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    found = {r.doc_id: r.n_tokens for r in token_counts(df, PATH).collect()}
    assert len(found) == len(texts)
    for i in (0, 1, 2, 3, 70_002):
        assert found[i] == len(library.encode(texts[i]))
    assert len(set(found[i] for i in range(3, len(texts)))) == 1


def test_buckets_that_lie_in_several_batches(spark, library):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    rng = random.Random(5)
    texts = [" ".join(rng.choice("abcdefg") * rng.randint(1, 4) for _ in range(50)) for _ in range(200)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(6)
    spark.conf.set(key, "3")
    try:
        found = {r.doc_id: r.n_tokens for r in token_counts(df, PATH).collect()}
    finally:
        spark.conf.set(key, before)
    assert found == {i: len(library.encode(t)) for i, t in enumerate(texts)}


def test_what_is_sent_does_not_depend_on_the_partitions(spark):
    """The first shuffle's rows are made before anything knows how many partitions there are."""
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    sizes = " + ".join(f"octet_length({n})" for n in module.NAMES[3:])

    def sent():
        rows = df.mapInArrow(module._frequencies, module.FREQUENCIES)
        return rows.selectExpr("count(*)", f"sum({sizes})").first()

    key = "spark.sql.shuffle.partitions"
    before, seen = spark.conf.get(key), set()
    for n in (50, 20_000):
        spark.conf.set(key, str(n))
        try:
            seen.add(sent())
        finally:
            spark.conf.set(key, before)
    assert len(seen) == 1
    assert next(iter(seen))[0] <= module.BUCKETS * df.rdd.getNumPartitions() + 200


def test_a_worker_forgets_buckets_it_is_done_with(monkeypatch):
    counts = module._Counts(PATH)
    seen = []
    count = counts.counter.count
    monkeypatch.setattr(counts.counter, "count", lambda units: seen.extend(units) or count(units))
    assert (counts.of([b"one", b"two", b"one"]) == counts.of([b"one", b"two", b"one"])).all()
    assert sorted(seen) == ["one", "two"]
    counts.keep([b"two"])
    counts.of([b"two"])
    assert set(counts.known) == {b"two"} and len(seen) == 2


def test_each_pre_token_of_the_table_is_counted_once(spark, monkeypatch):
    texts = ["the same words again and again", "the same words, once more"] * 50
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(7)
    blocks = df.mapInArrow(module._frequencies, module.FREQUENCIES).orderBy("bucket").collect()
    assert len({r.bucket for r in blocks if r.bucket != module.DOCUMENTS}) <= 9
    assert len([r for r in blocks if r.bucket == module.DOCUMENTS]) >= 1

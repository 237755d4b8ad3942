"""Documents with columns of every name that a stage or operator uses inside."""

import re

import corpus_pipeline
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import tideline.llm.common
from tideline.llm.conversation_trie import conversation_trie
from tideline.llm.exact_dedup import exact_classes
from tideline.llm.fill_in_middle import fill_in_middle, restore
from tideline.llm.html_text import extract
from tideline.llm.near_dedup import near_classes
from tideline.llm.packing import pack, token_pieces
from tideline.llm.quality_classifier import fit_classifier, score
from tideline.llm.quality_rules import quality_rules
from tideline.llm.secrets import scan
from tideline.llm.token_counts import token_counts
from tideline.llm.viterbi import decode, encode
from tideline.llm.common import stored

PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")
ROWS = [
    (i, text)
    for i, text in enumerate(
        ["one and the same text of some words " * 4] * 3
        + ["another text " + " ".join(f"w{k}" for k in range(60)), None, "", "x"]
        + ["another text " + " ".join(f"w{k}" for k in range(59)), "api_key = 'a8Fk39dLq0ZxT7vB2nMw'"]
    )
] + [(0, "one and the same text of some words " * 4)]
OWN = {"doc_id", "text", "lang", "source", "n_chars"}


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", "s", len(t or "")) for i, t in ROWS]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, i % 2, 0) for i in range(9)], "doc_id long, quality int, toxic int")


def inside(work, monkeypatch):
    """Result of the work, and all names in its plan and in those of the tables it stores."""
    plans = []
    store = tideline.llm.common.stored

    def spy(df, label):
        plans.append(df._jdf.queryExecution().toString())
        return store(df, label)

    with monkeypatch.context() as watched:
        import sys

        for name, module in list(sys.modules.items()):
            if name.startswith("tideline.llm.") and hasattr(module, "stored"):
                watched.setattr(module, "stored", spy)
        result = work()
    plans.append(result._jdf.queryExecution().toString())
    names = {n for plan in plans for n in re.findall(r"\b([A-Za-z_]\w*)#\d+", plan)}
    names |= {n for plan in plans for n in re.findall(r"\bAS ([A-Za-z_]\w*)\b", plan)}
    return result, names


def with_names(df, names, own):
    """Extra columns of these names; Spark's names don't differ by case."""
    extra = {}
    for name in sorted(names):
        if name.lower() not in {*own, *(e.lower() for e in extra)}:
            extra[name] = F.lit("x")
    return df.withColumns(extra), list(extra)


def rows_of(df, columns):
    return sorted(df.select(*(f"`{c}`" for c in columns)).collect(), key=str)


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES[:-1]])
def test_stages(spark, docs, labels, tmp_path, monkeypatch, name):
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    stage = dict(corpus_pipeline.STAGES)[name]
    plain, names = inside(lambda: stage(spark, docs, str(tmp_path)), monkeypatch)
    wide, extra = with_names(docs, names, OWN)
    found = stage(spark, wide, str(tmp_path))
    assert found.columns == wide.columns and len(extra) > 3
    assert rows_of(found, docs.columns) == rows_of(plain, docs.columns)
    assert all(r[c] == "x" for r in found.collect() for c in extra)


OPERATORS = {
    "exact_classes": lambda d, l: exact_classes(d),
    "near_classes": lambda d, l: near_classes(d),
    "scan": lambda d, l: scan(d),
    "token_pieces": lambda d, l: token_pieces(d, WORDS, 1, 16),
    "quality_rules": lambda d, l: quality_rules(d, l)[0],
    "score": lambda d, l: score(d, fit_classifier(d, l)),
    "token_counts": lambda d, l: token_counts(d, PIECES),
    "encode": lambda d, l: encode(d, PIECES, decoded=True),
    "fill_in_middle": lambda d, l: fill_in_middle(d),
    "restore": lambda d, l: restore(fill_in_middle(d)),
    "last_stage": lambda d, l: corpus_pipeline.packing(None, d, ""),
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_operators(docs, labels, monkeypatch, name):
    plain, names = inside(lambda: OPERATORS[name](docs, labels), monkeypatch)
    own = plain.columns
    wide, _ = with_names(docs, names, OWN)
    found = OPERATORS[name](wide, labels)
    if name == "last_stage":  # which sequence a piece of several equal ones gets is free
        own = [c for c in own if c not in ("sequence_id", "offset", "doc_id", "ids_crc32")]
    assert rows_of(found, own) == rows_of(plain, own)


def test_pages_and_conversations(spark, monkeypatch):
    pages = spark.createDataFrame([(1, "u", "<article><p>a</p></article>"), (2, None, None)], "page_id long, url string, html string")
    plain, names = inside(lambda: extract(pages), monkeypatch)
    wide, _ = with_names(pages, names, {"page_id", "url", "html"})
    assert rows_of(extract(wide), plain.columns) == rows_of(plain, plain.columns)
    said = spark.createDataFrame([(c, t, "user", f"{t}") for c in range(8) for t in range(3)], "conv_id long, turn long, role string, text string")
    plain, names = inside(lambda: conversation_trie(said), monkeypatch)
    wide, _ = with_names(said, names, {"conv_id", "turn", "role", "text"})
    assert rows_of(conversation_trie(wide), plain.columns) == rows_of(plain, plain.columns)


def test_results_replace_columns_of_their_names(docs):
    encoded = encode(docs, PIECES).withColumn("text", F.lit("old")).withColumn("TEXT", F.lit("old"))
    out = decode(encoded.drop("TEXT"), PIECES)
    assert out.columns == ["doc_id", "ids", "text"]
    assert {r.doc_id: r.text for r in out.collect()} == {i: t or "" for i, t in ROWS}
    pieces = token_pieces(docs, WORDS, 1, 16).withColumn("offset", F.lit(7)).withColumn("Sequence_ID", F.lit(7))
    packed = pack(stored(pieces, "pieces"), 16)
    assert packed.columns[-2:] == ["sequence_id", "offset"] and len(set(packed.columns)) == len(packed.columns)
    assert packed.filter("offset = 7 AND length > 9").count() == 0

"""The stages one after the other, each against what it must and mustn't change."""

import hashlib

import corpus_pipeline
import pytest

from tideline.llm.common import stored, table
from tideline.llm.near_dedup import aligned, needed, shingles
from tideline.llm.secrets import default_forest, findings
from tideline.llm.words import words

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = table(spark, SF, "documents")
    out = {"documents": docs}
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF), "test-stage")
        out[name] = docs
    return out


def texts(df):
    return {r.doc_id: r.text or "" for r in df.collect()}


def test_order_and_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_classifier", "exact_dedup", "near_dedup", "secret_scan", "best_fit_packing",
    ]
    for name, _ in corpus_pipeline.STAGES[:-1]:
        assert stages[name].columns == stages["documents"].columns


def test_quality_keeps_good_documents(spark, stages):
    labels = {r.doc_id: r.quality for r in table(spark, SF, "labels").collect()}
    before, after = texts(stages["documents"]), texts(stages["quality_classifier"])
    assert set(after.items()) <= set(before.items())
    good = [i for i, q in labels.items() if q == 1 and i in before]
    assert sum(i in after for i in good) >= 0.97 * len(good)
    bad = [i for i, q in labels.items() if q == 0 and i in before]
    assert sum(i in after for i in bad) <= 0.2 * len(bad)


def test_exact_copies_go(stages):
    before, after = texts(stages["quality_classifier"]), texts(stages["exact_dedup"])
    best = {}
    for i, text in before.items():
        best[text] = max(i, best.get(text, i))
    assert after == {i: t for t, i in best.items()}


def test_one_of_each_class_stays(stages):
    before, after = texts(stages["exact_dedup"]), texts(stages["near_dedup"])
    runs = {i: shingles(words([t.encode()]).hashes.astype("<u4")) for i, t in before.items()}
    root = {i: i for i in before}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(before)
    for k, i in enumerate(ids):
        for j in ids[:k]:
            if aligned(runs[i], runs[j], max(1, needed(len(runs[i]), len(runs[j]), 0.8))):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    assert after == {i: t for i, t in before.items() if find(i) == i}


def test_secrets_are_gone(stages):
    before, after = texts(stages["near_dedup"]), texts(stages["secret_scan"])
    assert set(before) == set(after)
    for i, text in before.items():
        found = findings(text, "")
        hidden = [f for f, s in zip(found, default_forest().scores(found), strict=True) if s >= 0.5]
        assert (after[i] == text) == (not hidden)
        assert all(f.value not in after[i] for f in hidden)
    assert all(r.n_chars == len(r.text) for r in stages["secret_scan"].collect())


def test_every_document_is_packed(stages):
    pieces = stages["best_fit_packing"].collect()
    assert {r.doc_id for r in pieces} == set(texts(stages["secret_scan"]))
    used = {}
    for r in pieces:
        used[r.sequence_id] = used.get(r.sequence_id, 0) + r.length
    assert max(used.values()) <= corpus_pipeline.SEQUENCE_TOKENS


def test_run_gives_the_last_stage(spark, stages):
    def digest(df):
        rows = sorted((r.doc_id, r.piece, r.length, r.ids_crc32) for r in df.collect())
        return hashlib.sha256(repr(rows).encode()).hexdigest()

    assert digest(corpus_pipeline.run(spark, SF)) == digest(stages["best_fit_packing"])


def test_odd_documents(spark, edge, nothing, tmp_path):
    spark.createDataFrame([(i, i % 2, 0) for i in range(9)], "doc_id long, quality int, toxic int").write.parquet(
        str(tmp_path / "labels.parquet")
    )
    for docs in (edge, nothing):
        for name, stage in corpus_pipeline.STAGES:
            before = docs.collect()
            docs = stored(stage(spark, docs, str(tmp_path)), "test-stage")
            after = docs.collect()
            if name == "best_fit_packing":
                assert {r.doc_id for r in after} == {r.doc_id for r in before}
                assert all(0 < r.length <= 4096 for r in after)
                continue
            assert docs.columns == edge.columns
            # Rows stay as they are; only the secret scan may change a text, here it has none to.
            assert {tuple(r) for r in after} <= {tuple(r) for r in before}
            texts = {r.text or "" for r in before}
            if name == "exact_dedup":
                assert len(after) == len(texts) and {r.text or "" for r in after} == texts
            elif name == "near_dedup":
                # White space alone and no text at all are the same words.
                assert len(after) == len({" ".join(t.split()) for t in texts})
            elif name == "secret_scan":
                assert len(after) == len(before)

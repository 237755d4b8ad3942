import json
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tideline.llm.token_files import CorruptFrame, FrameReader, read_token_files, write_token_files
from tideline.llm.tokens import WordEncoder, encoder

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "a\x1cb\x1f c", "It's they'll 'S", "<|endoftext|> x<|startoftext|>y", "é é ﬁ İ Σς",
    "日本 ١٢٣ 1234", "x...!? ..,. ##$", " 　​", "\x00 \x85", "ªº µ ßẞ", "a" * 5000,
    "<|ENDOFTEXT|> A", "ÀÉ ÝŸ Þß µM", "É́ É",
]


def library(text):
    return Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids


def test_words_as_the_library_encodes_texts():
    for text, raw in zip(ODD, encoder(PATH).encode(ODD), strict=True):
        assert np.frombuffer(raw, "<u4").tolist() == library(text), text


def test_bounded_memory(monkeypatch):
    monkeypatch.setattr("tideline.llm.tokens.REMEMBERED", 3)
    small = WordEncoder(PATH)
    for _ in range(2):
        for text, raw in zip(ODD, small.encode(ODD), strict=True):
            assert np.frombuffer(raw, "<u4").tolist() == library(text)


def test_vocabulary_that_keeps_spaces_is_refused():
    with pytest.raises(ValueError):
        WordEncoder(public_tokenizers.path("byte_bpe_50k.json"))


def written(df, tmp_path, files=3):
    path = str(tmp_path / "tokens")
    write_token_files(df, path, PATH, end_id=2, files=files)
    return path


def test_round_trip(spark, edge, tmp_path):
    path = written(edge, tmp_path)
    rows = read_token_files(spark, path).collect()
    order = sorted((r.doc_id is not None, r.doc_id or 0, r.text or "") for r in edge.collect())
    assert len(rows) == len(order)
    rows.sort(key=lambda r: r.start)
    at = 0
    for row, (known, doc_id, text) in zip(rows, order, strict=True):
        ids = library(text) + [2]
        assert (row.doc_id, row.start, row.n_tokens) == (doc_id if known else None, at, len(ids))
        assert zlib.crc32(row.ids) == zlib.crc32(np.array(ids, "<u4").tobytes())
        at += len(ids)
    assert json.loads((tmp_path / "tokens/manifest.json").read_text())["tokens"] == at


def test_only_documents_asked_for(spark, edge, tmp_path):
    path = written(edge, tmp_path)
    found = read_token_files(spark, path, [6, 8, 1234])
    assert sorted(r.doc_id for r in found.collect()) == [6, 8, 8]


def test_reader_skips_frames_and_checks_them(edge, tmp_path):
    import pyarrow.fs as fs

    path = written(edge, tmp_path, files=1)
    [name] = [p for p in (tmp_path / "tokens").iterdir() if p.suffix == ".zst"]
    local, _ = fs.FileSystem.from_uri(path)
    raw = bytearray(name.read_bytes())
    with local.open_input_file(str(name)) as file:
        reader = FrameReader(file)
        last = len(reader.ids) - 1
        assert [k for k, _ in reader.documents(np.array([0, last]))] == [0, last]
        middle = int(reader.ends[last]) - int(reader.frames[last, 0] // 2)
    raw[middle] ^= 0xFF
    bad = tmp_path / "bad"
    bad.write_bytes(raw)
    with local.open_input_file(str(bad)) as file:
        reader = FrameReader(file)
        assert len(list(reader.documents(np.array([0])))) == 1
        with pytest.raises(CorruptFrame):
            list(reader.documents(np.array([last])))
    bad.write_bytes(bytes(raw[:-1]))
    with local.open_input_file(str(bad)) as file, pytest.raises(CorruptFrame):
        FrameReader(file)


def test_other_zstandard_readers_see_the_ids(spark, make, tmp_path):
    import io

    import zstandard

    written(make([(1, "one"), (2, "two words")]), tmp_path, files=1)
    [name] = [p for p in (tmp_path / "tokens").iterdir() if p.suffix == ".zst"]
    stream = zstandard.ZstdDecompressor().stream_reader(
        io.BytesIO(name.read_bytes()), read_across_frames=True
    )
    assert np.frombuffer(stream.read(), "<u2").tolist() == library("one") + [2] + library("two words") + [2]


def test_empty_table(spark, nothing, tmp_path):
    path = written(nothing, tmp_path)
    assert read_token_files(spark, path).count() == 0

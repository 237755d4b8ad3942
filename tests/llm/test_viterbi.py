import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2 as model

from tideline.llm.viterbi import Lexicon, ViterbiEncoder, decode, encode, viterbi

PATH = public_tokenizers.path("piece_bpe_32k.model")
ALPHABET = "ab'sdtreABZé ñ.,!#$<s></s><unk>\n\t  　ﬁİΣς日本1234\x1c\x00 ▁▁😀-_  \n\n"


@pytest.fixture(scope="module")
def library():
    """The library's own search over the same pieces and scores."""
    proto = model.ModelProto()
    with open(PATH, "rb") as file:
        proto.ParseFromString(file.read())
    proto.trainer_spec.model_type = 1
    scores = Lexicon(PATH).scores
    for i, piece in enumerate(proto.pieces):
        piece.score = scores.get(i, piece.score)
    return sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())


def numbers(raw):
    return np.frombuffer(raw, "<u4").tolist()


def texts(n=4000):
    rng = random.Random(6)
    syllables = ["the", "ing", "tion", "er", "qu", "ou", "schl", "é", "ñ", "123", "."]
    made = [" ".join("".join(rng.choice(syllables) for _ in range(rng.randint(1, 5))) for _ in range(9)) for _ in range(n)]
    odd = ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 40))) for _ in range(n)]
    return made + odd + ["", " ", "  ", "\n", " \n", "a ", "<0x0A>", "▁"]


def test_as_the_library(library):
    found = texts()
    for text, raw in zip(found, viterbi(PATH).encode(found), strict=True):
        assert numbers(raw) == library.encode(text), repr(text)


def test_decoding(library):
    found = texts()
    raw = list(viterbi(PATH).encode(found))
    back = viterbi(PATH).decode(raw)
    assert back == [t.replace("▁", " ") for t in found]
    assert back == [library.decode(numbers(r)) for r in raw]
    broken = np.array([3 + 0xFF, 3 + 0xC3, 100], "<u4").tobytes()
    assert viterbi(PATH).decode([broken, b""])[1] == ""
    assert "�" in viterbi(PATH).decode([broken])[0]


def test_best_of_all_segmentations():
    """Exhaustive search over short strings."""
    lex = viterbi(PATH).lexicon
    pieces = {t: lex.scores[i] for i, t in enumerate(lex.texts) if i in lex.scores}

    def best(text):
        return max(
            (
                (pieces[text[:k]] + best(text[k:]) if k < len(text) else pieces[text])
                for k in range(1, len(text) + 1)
                if text[:k] in pieces
            ),
            default=-np.inf,
        )

    for text in ["▁hello", "▁theing", "abcabc", "▁tionner", "▁a"]:
        ids = numbers(lex.ids([text])[text])
        assert "".join(lex.texts[i] for i in ids) == text
        assert sum(lex.scores[i] for i in ids) == pytest.approx(best(text))


def test_bounded_memory(monkeypatch, library):
    monkeypatch.setattr("tideline.llm.viterbi.REMEMBERED", 5)
    monkeypatch.setattr("tideline.llm.viterbi.TEXTS", 3)
    monkeypatch.setattr("tideline.llm.viterbi.CELLS", 64)
    small, found = ViterbiEncoder(PATH), texts(40)
    for text, raw in zip(found, small.encode(found), strict=True):
        assert numbers(raw) == library.encode(text)
    assert small.decode(list(small.encode(found))) == [t.replace("▁", " ") for t in found]


def test_edge_cases(edge, nothing, library):
    rows = decode(encode(edge, PATH), PATH).collect()
    expected = sorted(((r.doc_id, r.text or "") for r in edge.collect()), key=repr)
    assert sorted(((r.doc_id, r.text) for r in rows), key=repr) == expected
    at_once = encode(edge, PATH, decoded=True).collect()
    assert sorted(map(tuple, at_once), key=repr) == sorted(map(tuple, rows), key=repr)
    for r in rows:
        if len(r.text) < 1000:
            assert numbers(r.ids) == library.encode(r.text)
    assert decode(encode(nothing, PATH), PATH).count() == 0
    null = edge.sparkSession.createDataFrame([(None,)], "ids binary")
    assert [r.text for r in decode(null, PATH).collect()] == [""]


def test_long_word(library):
    text = "ab" * 5000
    [raw] = viterbi(PATH).encode([text])
    assert viterbi(PATH).decode([raw]) == [text]

"""Token ids of whole texts with a public tokenizer, word by word.

The vocabulary's normaliser and splitter never look across white space, so the ids of a
text are the ids of its white-space separated words, one after the other. Each worker
process keeps a bounded table from words to ids and asks the library only for words it
has not seen; a text whose words are known costs a split and look-ups.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Iterable, Iterator

import numpy as np

#: Words a worker remembers before it starts again, and words of one call to the library.
REMEMBERED = 1_000_000
ASKED = 20_000

#: How byte-level vocabularies spell the bytes that are no printable characters.
_BYTES = {
    byte: 256 + i
    for i, byte in enumerate([*range(33), *range(127, 161), 173])
}
_SEPARATORS = re.compile("[\x1c-\x1f]")
_WHITE = re.compile("(?:(?![\x1c-\x1f])\\s)+")
_ENCODERS: dict[str, WordEncoder] = {}


class WordEncoder:
    """Ids of texts as little-endian unsigned 32-bit integers.

    Splitting at white space is exact only for vocabularies that drop it, which
    ``word_bpe_49k.json`` does; ``__init__`` refuses others.
    """

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        splitters = spec["pre_tokenizer"].get("pretokenizers", [spec["pre_tokenizer"]])
        drops = any(s["type"] == "Split" and s["behavior"] == "Removed" for s in splitters)
        glued = any(
            t["lstrip"] or t["rstrip"] or any(c.isspace() for c in t["content"])
            for t in spec["added_tokens"]
        )
        if not drops or glued:
            raise ValueError("Only vocabularies that drop white space can be used word by word")
        # The model alone, for words that are known to be one token of the splitter.
        bare = spec | {
            "normalizer": None,
            "pre_tokenizer": {"type": "WhitespaceSplit"},
            "added_tokens": [],
        }
        self.letters = Tokenizer.from_str(json.dumps(bare))
        mark = spec["model"]["end_of_word_suffix"]
        vocab = spec["model"]["vocab"]
        self.ends = np.zeros(max(vocab.values()) + 1, dtype=bool)
        self.ends[[i for piece, i in vocab.items() if piece.endswith(mark)]] = True
        self.words: dict[str, bytes] = {}

    def _ask_words(self, words: list[str]) -> None:
        """Words of letters: many in one call to the model, cut where a token ends a word."""
        for i in range(0, len(words), ASKED):
            part = words[i : i + ASKED]
            spelled = [w if w.isascii() else w.encode().decode("latin-1").translate(_BYTES) for w in part]
            lines = [" ".join(spelled[k : k + 200]) for k in range(0, len(part), 200)]
            found = self.letters.encode_batch_fast(lines, add_special_tokens=False)
            ids = np.concatenate([np.array(e.ids, dtype="<u4") for e in found])
            ends = (np.flatnonzero(self.ends[ids]) + 1) * 4
            if len(ends) != len(part):
                raise ValueError("The vocabulary doesn't mark the ends of words")
            raw, start = ids.tobytes(), 0
            for word, end in zip(part, ends.tolist(), strict=True):
                self.words[word] = raw[start:end]
                start = end

    def _ask(self, words: list[str]) -> None:
        """Any other words, each on its own by the library's whole way."""
        for i in range(0, len(words), ASKED):
            part = words[i : i + ASKED]
            for word, found in zip(
                part, self.tokenizer.encode_batch_fast(part, add_special_tokens=False), strict=True
            ):
                self.words[word] = array("I", found.ids).tobytes()

    def _learn(self, unknown: Iterable[str]) -> None:
        """Ids of new words; letters and the punctuation after them are separate tokens.

        Letters followed by ASCII punctuation, the usual word, are looked up as two parts,
        the letters in lower case; the splitter would separate them as well. Only letters
        below U+0130 go this way: they are in normal form, and their lower case is one letter.
        """
        parts: dict[str, tuple[str, str]] = {}
        letter_words: set[str] = set()
        others: set[str] = set()
        for word in unknown:
            letters = word.rstrip("!#$%&()*+,-./:;=>?@[]^_`{|}~")
            if letters.isalpha() and (letters.isascii() or max(letters) < "\u0130"):
                low = letters.lower()
                letter_words.add(low)
                mark = word[len(letters) :]
                if mark:
                    others.add(mark)
                if low != word:
                    parts[word] = (low, mark)
            else:
                others.add(word)
        self._ask_words([w for w in letter_words if w not in self.words])
        self._ask([w for w in others if w not in self.words])
        self.words[""] = b""
        for word, (low, mark) in parts.items():
            self.words[word] = self.words[low] + self.words[mark]

    @staticmethod
    def _split(text: str) -> list[str]:
        """Words of a text, in lower case where that is sure to be the library's.

        That is so for Latin-1, unless a special token could arise. Python also splits at
        four control characters that are no white space in Unicode.
        """
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            pass
        else:
            if "<|" not in text:
                text = text.lower()
        if _SEPARATORS.search(text):
            return _WHITE.split(text)
        return text.split()

    def encode(self, texts: list[str | None]) -> Iterator[bytes]:
        """Ids of each text, null as empty. Any white space separates words."""
        step = 256
        for i in range(0, len(texts), step):
            split = [self._split(t or "") for t in texts[i : i + step]]
            unknown = set().union(*split).difference(self.words)
            if len(self.words) + len(unknown) > REMEMBERED:
                self.words.clear()
                unknown = set().union(*split)
            if unknown:
                self._learn(unknown)
            known = self.words.__getitem__
            for words in split:
                yield b"".join(map(known, words))


def encoder(path: str) -> WordEncoder:
    """The process's encoder for a vocabulary file; Spark keeps worker processes between tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]

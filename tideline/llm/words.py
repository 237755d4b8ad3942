"""Words of many texts at once, as 64-bit hashes in numpy."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np

#: Bytes of text that are worked on together; a longer text is worked on alone.
CHUNK = 1 << 20
#: Multipliers by position in a word; a longer word meets them again.
_SPAN = 1024
_MULTIPLIERS = np.random.default_rng(20240501).integers(
    1, np.iinfo("i8").max, _SPAN, dtype="u8"
) | np.uint64(1)

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
#: Letters of either case, digits, and every other ASCII byte as itself.
_CLASS = np.arange(256, dtype="u1")
_CLASS[ord("a") : ord("z") + 1] = 1
_CLASS[128:] = 1
_CLASS[ord("A") : ord("Z") + 1] = 2
_CLASS[ord("0") : ord("9") + 1] = 3


def mix(x: np.ndarray) -> np.ndarray:
    """A finaliser that spreads every bit (the constants are those of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _hashes(codes: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """A hash per word of ``codes``, whose words lie one after the other."""
    if not len(starts):
        return np.empty(0, "u8")
    place = np.arange(len(codes)) - np.repeat(starts, lengths)
    terms = (codes.astype("u8") + np.uint64(1)) * _MULTIPLIERS[place % _SPAN]
    return mix(np.add.reduceat(terms, starts) + lengths.astype("u8"))


@dataclass
class Words:
    """Words of a run of texts, one after the other."""

    hashes: np.ndarray
    counts: np.ndarray  # words of each text
    shapes: np.ndarray | None

    @property
    def starts(self) -> np.ndarray:
        return np.cumsum(self.counts) - self.counts


def words(texts: Sequence[bytes], shapes: bool = False) -> Words:
    """Words are runs without ASCII white space.

    A shape is the sequence of character classes of a word, each class once in a row:
    lower case or other letters, upper case, digits, or the very character.
    """
    raw = np.frombuffer(b"\n".join([*texts, b""]), "u1")
    ends_of_texts = np.cumsum([len(t) + 1 for t in texts], dtype="i8")
    inside = ~_SPACE[raw]
    edges = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).astype("i1")))
    begins, ends = edges[::2], edges[1::2]
    lengths = ends - begins
    owner = np.searchsorted(ends_of_texts, begins, side="right")
    counts = np.bincount(owner, minlength=len(texts)).astype("i8")
    letters = raw[inside]
    starts = np.cumsum(lengths) - lengths
    found = None
    if shapes:
        classes = _CLASS[letters]
        first = np.ones(len(classes), dtype=bool)
        first[1:] = classes[1:] != classes[:-1]
        first[starts] = True
        kept = np.add.reduceat(first.astype("i8"), starts) if len(starts) else starts
        found = _hashes(classes[first], np.cumsum(kept) - kept, kept)
    return Words(_hashes(letters, starts, lengths), counts, found)


def chunks(texts: Sequence[str | None]) -> Iterator[tuple[int, list[bytes]]]:
    """(place of the first, texts as bytes) in pieces of bounded size; null as empty."""
    first, part, size = 0, [], 0
    for i, text in enumerate(texts):
        raw = (text or "").encode()
        if part and size + len(raw) > CHUNK:
            yield first, part
            first, part, size = i, [], 0
        part.append(raw)
        size += len(raw) + 1
    if part:
        yield first, part

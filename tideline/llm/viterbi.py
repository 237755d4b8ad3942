"""SentencePiece encoding and decoding by a batched Viterbi search in numpy.

A text is cut into pre-tokens, which pieces never cross. New pre-tokens of equal length
advance together: for every substring length one array of rolling hashes is probed in the
sorted hashes of the pieces of that length, and the best score of every end position and
the length of its last piece are taken by array maxima. Following those lengths back gives
the ids. Characters no piece covers fall back to byte pieces.

The pieces' scores are log-probabilities if the model is a unigram model. A merge-ranked
model has ranks instead; those become the log-probabilities of a Zipf law over the ranks.
Ids are then the most probable segmentation, not the one the merges would give.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.llm.common import map_rows, slices
from tideline.llm.token_counts import SPACE, pre_tokens

UNIGRAM, NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 1, 2, 3, 4, 5, 6
#: How much less than the least piece an unknown character scores.
UNKNOWN_PENALTY = 10.0
#: Scores are multiples of this, so that sums of single precision are exact as well.
STEP = 2.0**-9
REMEMBERED = 400_000
#: Bytes of text a worker takes at a time.
SLICE = 4 << 20
CELLS = 1 << 20
TEXTS = 500

MARKS = "!#$%&()*+,-./:;=>?@[]^_`{|}~"

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_FILTER_BITS = 20


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype="u8")
    out[0] = 1
    return np.cumprod(out, dtype="u8")


class Lexicon:
    """The pieces of a model, ready for probing."""

    def __init__(self, path: str) -> None:
        from sentencepiece import sentencepiece_model_pb2 as model

        proto = model.ModelProto()
        with open(path, "rb") as file:
            proto.ParseFromString(file.read())
        norm, pieces = proto.normalizer_spec, proto.pieces
        if (
            norm.precompiled_charsmap
            or norm.remove_extra_whitespaces
            or not norm.add_dummy_prefix
            or proto.trainer_spec.treat_whitespace_as_suffix
            or not proto.trainer_spec.byte_fallback
            or any(p.type == USER for p in pieces)
            or any("\n" in p.piece or re.search(f"[^{SPACE}]{SPACE}", p.piece) for p in pieces)
        ):
            raise ValueError("This model's pre-tokens can't be encoded on their own")
        normal = [i for i, p in enumerate(pieces) if p.type == NORMAL]
        if proto.trainer_spec.model_type == UNIGRAM:
            self.scores = {i: float(pieces[i].score) for i in normal}
        else:
            order = sorted(normal, key=lambda i: -pieces[i].score)
            total = np.log(np.sum(1 / (np.arange(len(order)) + 2.7)))
            self.scores = {
                i: round(float(-np.log(rank + 2.7) - total) / STEP) * STEP
                for rank, i in enumerate(order)
            }
        self.unknown = min(self.scores.values()) - UNKNOWN_PENALTY
        by_length: dict[int, list[tuple[int, int]]] = {}
        for i in normal:
            by_length.setdefault(len(pieces[i].piece), []).append((self._key(pieces[i].piece), i))
        self.tables = {}
        for length, found in by_length.items():
            found.sort()
            keys = np.array([k for k, _ in found], dtype="u8")
            if len(np.unique(keys)) != len(keys):
                raise ValueError("Two pieces have the same hash")
            ids = np.array([i for _, i in found], dtype="i4")
            some = np.zeros(1 << _FILTER_BITS, dtype=bool)
            some[keys >> np.uint64(64 - _FILTER_BITS)] = True
            scores = np.array([self.scores[i] for i in ids.tolist()])
            self.tables[length] = (some, keys, ids, scores)
        self.longest = max(self.tables)
        #: Neighbouring characters inside a piece; no piece spans any other two.
        self.pairs = {
            a + b
            for i in normal
            for a, b in zip(pieces[i].piece, pieces[i].piece[1:], strict=False)
        }
        self.bytes = {int(p.piece[3:5], 16): i for i, p in enumerate(pieces) if p.type == BYTE}
        self.texts = [p.piece if p.type == NORMAL else "" for p in pieces]
        self.sizes = np.array([len(t) for t in self.texts], dtype="i8")
        self.firsts = np.cumsum(self.sizes) - self.sizes
        self.points = np.frombuffer("".join([*self.texts, " "]).encode("utf-32-le"), "<u4").astype("i8")
        # What each piece decodes to, one after the other.
        raw = [p.piece.replace(SPACE, " ").encode() if p.type == NORMAL else b"" for p in pieces]
        for value, i in self.bytes.items():
            raw[i] = bytes([value])
        for i, p in enumerate(pieces):
            if p.type == UNKNOWN:
                raw[i] = " ⁇ ".encode()
        self.lengths = np.array([len(r) for r in raw], dtype="i8")
        self.begins = np.cumsum(self.lengths) - self.lengths
        self.raw = np.frombuffer(b"".join(raw), "u1")

    @staticmethod
    def _key(piece: str) -> int:
        return sum(ord(c) * pow(_BASE, k + 1, 1 << 64) for k, c in enumerate(piece)) % (1 << 64)

    def _search(self, codes: np.ndarray) -> np.ndarray:
        """Ids of texts of one length, from the right end of each row; -1 before them.

        ``codes`` has a row of code points per text. An unknown character is -2 minus
        its code point.
        """
        n, length = codes.shape
        prefix = np.zeros((length + 1, n), dtype="u8")
        np.cumsum(
            codes.T * _powers(_BASE, length + 1)[1:, None], axis=0, dtype="u8", out=prefix[1:]
        )
        back = _powers(_INVERSE, length)[:, None]
        # By length of the last piece, longest first: of equal scores the first one stays.
        sizes = sorted((k for k in self.tables if k <= length), reverse=True)
        if 1 not in sizes:
            sizes.append(1)
        score, piece = {}, {}
        for k in sizes:
            shape = (length - k + 1, n)
            score[k] = np.full(shape, -np.inf if k > 1 else self.unknown)
            piece[k] = -2 - codes.T.astype("i4") if k == 1 else np.full(shape, -1, "i4")
            if k not in self.tables:
                continue
            some, keys, ids, values = self.tables[k]
            hashes = ((prefix[k:] - prefix[: length - k + 1]) * back[: length - k + 1]).ravel()
            maybe = np.flatnonzero(some[hashes >> np.uint64(64 - _FILTER_BITS)])
            at = np.minimum(np.searchsorted(keys, hashes[maybe]), len(keys) - 1)
            hit = keys[at] == hashes[maybe]
            score[k].ravel()[maybe[hit]] = values[at[hit]]
            piece[k] = np.ascontiguousarray(piece[k])
            piece[k].ravel()[maybe[hit]] = ids[at[hit]]
        best = np.full((length + 1, n), -np.inf)
        best[0] = 0
        step = np.zeros((length + 1, n), dtype="i4")
        for end in range(1, length + 1):
            for k in sizes:
                if k <= end:
                    total = best[end - k] + score[k][end - k]
                    better = total > best[end]
                    np.copyto(best[end], total, where=better)
                    np.copyto(step[end], k, where=better)
        out = np.full((n, length), -1, dtype="i4")
        at, column = np.full(n, length), np.full(n, length - 1)
        rows = np.arange(n)
        while len(rows):
            k = step[at[rows], rows]
            begin = at[rows] - k
            for size in np.unique(k).tolist():
                of = rows[k == size]
                out[of, column[of]] = piece[size][at[of] - size, of]
            at[rows] = begin
            column[rows] -= 1
            rows = rows[begin > 0]
        return out

    def _check(self, ids: np.ndarray, codes: np.ndarray) -> None:
        """Whether the pieces spell the code points: equal hashes of unequal strings would show."""
        lengths = np.where(ids >= 0, self.sizes[ids], 1)
        place = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        first = np.where(ids >= 0, self.firsts[ids], 0)
        spelled = self.points[np.repeat(first, lengths) + place]
        spelled[np.cumsum(lengths)[ids < 0] - 1] = -2 - ids[ids < 0]
        if (spelled != codes).any():
            raise ValueError("Two strings have the same hash")

    def ids(self, texts: list[str]) -> dict[str, bytes]:
        """Ids (little-endian unsigned 32-bit) of texts that hold spaces as pieces do."""
        found: dict[str, bytes] = {}
        by_length: dict[int, list[str]] = {}
        for text in texts:
            by_length.setdefault(len(text), []).append(text)
        for length, group in by_length.items():
            rows = max(1, CELLS // (length * min(length, self.longest)))
            for i in range(0, len(group), rows):
                part = group[i : i + rows]
                codes = np.frombuffer("".join(part).encode("utf-32-le"), "<u4")
                table = self._search(codes.reshape(len(part), length))
                used = table != -1
                flat, ends = table[used], np.cumsum(used.sum(axis=1)).tolist()
                self._check(flat, codes)
                raw = flat.astype("<u4").tobytes()
                unknown = set(np.flatnonzero((table < -1).any(axis=1)).tolist())
                start = 0
                for row, (text, end) in enumerate(zip(part, ends, strict=True)):
                    found[text] = raw[4 * start : 4 * end]
                    if row in unknown:
                        found[text] = self._fall_back(flat[start:end])
                    start = end
        return found

    def _fall_back(self, ids: np.ndarray) -> bytes:
        """The ids with unknown characters as the pieces of their bytes."""
        out: list[int] = []
        for i in ids.tolist():
            out += [i] if i >= 0 else [self.bytes[b] for b in chr(-2 - i).encode()]
        return np.array(out, dtype="<u4").tobytes()


class ViterbiEncoder:
    """Ids of texts; remembers a bounded number of pre-tokens."""

    def __init__(self, path: str) -> None:
        self.lexicon = Lexicon(path)
        self.known: dict[str, bytes] = {}

    def encode(self, texts: list[str | None]) -> Iterator[bytes]:
        for i in range(0, len(texts), TEXTS):
            split = [pre_tokens(t or "") for t in texts[i : i + TEXTS]]
            new = set().union(*split).difference(self.known)
            if len(self.known) + len(new) > REMEMBERED:
                self.known.clear()
                new = set().union(*split)
            self._learn(new)
            for units in split:
                yield b"".join(map(self.known.__getitem__, units))

    def _learn(self, units: set[str]) -> None:
        """Ids of new pre-tokens; punctuation after a word apart, where no piece spans the two."""
        parts: dict[str, tuple[str, str]] = {}
        texts: set[str] = set()
        pairs = self.lexicon.pairs
        for unit in units:
            text = unit if unit.startswith("\n") else SPACE + unit
            head = text.rstrip(MARKS)
            if head and len(head) < len(text) and text[len(head) - 1 : len(head) + 1] not in pairs:
                parts[unit] = (head, text[len(head) :])
            else:
                parts[unit] = (text, "")
            texts.update(parts[unit])
        found = self.lexicon.ids([t for t in texts if t])
        found[""] = b""
        for unit, (head, tail) in parts.items():
            self.known[unit] = found[head] + found[tail]

    def decode(self, sequences: list[bytes]) -> list[str]:
        """Texts of id sequences; the space before the first word is left out.

        Bytes that are no valid text become the replacement character.
        """
        lex, out, at = self.lexicon, [], 0
        while at < len(sequences):
            stop, size = at, 0
            while stop < len(sequences) and (stop == at or size + len(sequences[stop]) <= CELLS):
                size += len(sequences[stop])
                stop += 1
            part = sequences[at:stop]
            ids = np.frombuffer(b"".join(part), "<u4")
            lengths = lex.lengths[ids]
            ends = np.cumsum(lengths)
            place = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - lengths, lengths)
            raw = lex.raw[np.repeat(lex.begins[ids], lengths) + place].tobytes()
            cuts = np.concatenate(([0], ends))[np.cumsum([0, *(len(s) // 4 for s in part)])]
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                out.append(raw[a:b].decode("utf-8", "replace").removeprefix(" "))
            at = stop
        return out


@lru_cache(maxsize=4)
def viterbi(path: str) -> ViterbiEncoder:
    """The process's encoder for a model file."""
    return ViterbiEncoder(path)


def encode(
    docs: DataFrame,
    model: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    decoded: bool = False,
) -> DataFrame:
    """One row per input row: identifier and ids (little-endian unsigned 32-bit, binary).

    A null text counts as empty, which has no ids. With ``decoded`` a column ``text`` has
    what the ids decode to, found in the same task, so that ids need not be sent again.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1, SLICE):
            ids = list(viterbi(model).encode(batch.column(1).to_pylist()))
            out = [batch.column(0), pa.array(ids, pa.binary())]
            if decoded:
                out.append(pa.array(viterbi(model).decode(ids), pa.string()))
            yield pa.RecordBatch.from_arrays(out, ["id", "ids", "text"][: len(out)])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    schema = "id long, ids binary" + ", text string" * decoded
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def decode(rows: DataFrame, model: str, ids_col: str = "ids", text_col: str = "text") -> DataFrame:
    """``rows`` with the text of their ids; null ids count as none.

    A column that has the name of the text already is replaced, other names don't matter.
    Repeated rows stay; an empty table gives no rows.
    """
    rows = rows.drop(text_col)
    place = rows.columns.index(ids_col)
    names = [f"c{i}" for i in range(len(rows.columns) + 1)]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, place, SLICE):
            ids = [i or b"" for i in batch.column(place).to_pylist()]
            texts = pa.array(viterbi(model).decode(ids), pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, texts], names)

    return map_rows(rows, run, [T.StructField(text_col, T.StringType())])

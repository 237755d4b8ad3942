"""Token counts without token ids.

A SentencePiece model whose pieces never hold a space after another character splits a
text into pre-tokens (spaces and the word after them) that are encoded independently.
Each distinct pre-token is counted once, and the count is joined to the pre-tokens'
frequencies per document.

Frequencies are joined to counts by the bucket of the pre-token, one of a fixed number: a
block of documents sends a row per bucket, with its pre-tokens, the documents they occur in
and how often, so that neither the rows nor the bytes grow with the number of partitions.
Spark brings the rows of a bucket together and in order; its distinct pre-tokens are
counted once and forgotten after it. The answer is sums per document of each block, which a
last step adds. A pre-token that is in every document is one entry per block, so no task
gets more of it than there are blocks.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import partitions, slices

SPACE = "▁"
#: Bytes of text that a block of documents has; bounds the words a worker holds.
BLOCK = 12 << 20
#: Buckets of pre-tokens: as many tasks can count, whatever the number of partitions.
BUCKETS = 1 << 13
#: Entries of a pre-token, and times in a document, that are written together: one byte holds them.
MOST = 255
#: In place of a bucket: the row holds the documents of a block, not frequencies.
DOCUMENTS = -1
FREQUENCIES = (
    "bucket int, block long, shape int, words binary, lengths binary, entries binary, "
    "docs binary, times binary"
)


class PieceCounter:
    """Pieces of pre-tokens by the SentencePiece library."""

    def __init__(self, path: str) -> None:
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as model

        proto = model.ModelProto()
        with open(path, "rb") as file:
            proto.ParseFromString(file.read())
        norm = proto.normalizer_spec
        if (
            norm.precompiled_charsmap
            or norm.remove_extra_whitespaces
            or not norm.add_dummy_prefix
            or proto.trainer_spec.treat_whitespace_as_suffix
            or any(p.type == 4 for p in proto.pieces)
            or any("\n" in p.piece or re.search(f"[^{SPACE}]{SPACE}", p.piece) for p in proto.pieces)
        ):
            raise ValueError("This model's pre-tokens can't be encoded on their own")
        # The same model, without the space it puts before a text: pre-tokens bring theirs.
        norm.add_dummy_prefix = False
        self.model = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())

    def count(self, units: list[str]) -> list[int]:
        texts = [u if u.startswith("\n") else SPACE + u for u in units]
        return [len(ids) for ids in self.model.encode(texts, num_threads=1)]


@lru_cache(maxsize=4)
def counter(path: str) -> PieceCounter:
    return PieceCounter(path)


def pre_tokens(text: str) -> list[str]:
    """Pre-tokens of a text; a leading space is left out, a leading line end is not.

    No piece holds a line end, so it also starts a pre-token, one without a space.
    """
    if not text:
        return []
    text = text.replace(SPACE, " ")
    if "  " not in text and text[0] != " " and text[-1] != " ":
        return text.replace("\n", " \n").split(" ")
    spaced = SPACE + text.replace(" ", SPACE)
    found = re.findall(f"\n[^{SPACE}\n]*|{SPACE}+[^{SPACE}\n]*", spaced)
    return [u if u[0] == "\n" else u[1:] for u in found]


def _width(numbers: np.ndarray) -> int:
    most = int(numbers.max(initial=0))
    return 1 if most < 1 << 8 else 2 if most < 1 << 16 else 4


def _parts(numbers: np.ndarray, parts: np.ndarray) -> np.ndarray:
    """Each number as so many of at most MOST, the last one with the rest."""
    out = np.full(int(parts.sum()), MOST, "i8")
    out[np.cumsum(parts) - 1] = numbers - MOST * (parts - 1)
    return out


def _cut(data: bytes | pa.Buffer, edges: np.ndarray) -> pa.Array:
    """One binary value between each two edges of a run of bytes."""
    offsets = pa.py_buffer(np.ascontiguousarray(edges, "<i4"))
    return pa.Array.from_buffers(
        pa.binary(), len(edges) - 1, [None, offsets, pa.py_buffer(data)]
    )


def _run(column: pa.Array) -> np.ndarray:
    """The bytes of all values of a binary column, one after the other."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], "<i8")[column.offset :][: len(column) + 1]
    data = column.buffers()[2]
    if data is None or not len(column):
        return np.empty(0, "u1")
    return np.frombuffer(data, "u1")[offsets[0] : offsets[-1]]


def _numbers(column: pa.Array, width: int) -> np.ndarray:
    return _run(column).view(f"<u{width}").astype("i8")


NAMES = [field.split()[0] for field in FREQUENCIES.split(", ")]


def _block(batch: pa.RecordBatch, block: int) -> Iterator[pa.RecordBatch]:
    """The documents of a block, and its frequencies by bucket."""
    texts = batch.column(1).to_pylist()
    split = [pre_tokens(t or "") for t in texts]
    sizes = np.array([len((t or "").encode()) for t in texts], "<i8")
    ids = batch.column(0)
    known = np.array(ids.is_valid(), dtype="u1")
    numbers = ids.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8")
    parts = [known.tobytes(), numbers.tobytes(), sizes.tobytes(), b"", b""]
    yield pa.RecordBatch.from_arrays(
        [pa.array([DOCUMENTS], pa.int32()), pa.array([block], pa.int64()), pa.array([0], pa.int32())]
        + [pa.array([part], pa.binary()) for part in parts],
        NAMES,
    )
    doc = np.repeat(np.arange(len(split)), [len(s) for s in split])
    coded = pa.array([u for s in split for u in s], pa.large_string()).dictionary_encode()
    if not len(coded):
        return
    bucket = np.array(
        [zlib.crc32(u.encode()) % BUCKETS for u in coded.dictionary.to_pylist()], "i4"
    )
    order = np.argsort(bucket, kind="stable")
    rank = np.empty(len(order), "i8")
    rank[order] = np.arange(len(order))
    pairs, times = np.unique(rank[coded.indices.to_numpy()] * len(texts) + doc, return_counts=True)
    # What is more often in a document, or in more documents, is written more than once.
    again = -(-times // MOST)
    pairs, times = np.repeat(pairs, again), _parts(times, again)
    of_unit, of_doc = np.divmod(pairs, len(texts))
    entries = np.bincount(of_unit, minlength=len(order))
    again = -(-entries // MOST)
    order, entries = np.repeat(order, again), _parts(entries, again)

    words = coded.dictionary.take(pa.array(order)).cast(pa.large_binary())
    ends = np.frombuffer(words.buffers()[1], "<i8")[: len(words) + 1]
    lengths = np.diff(ends)
    bucket = bucket[order]
    units = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1], [True])))
    at = np.concatenate(([0], np.cumsum(entries)))[units]
    length, doc = _width(lengths), _width(of_doc)
    shape = length | doc << 4
    columns = [
        _cut(words.buffers()[2] or b"", ends[units]),
        _cut(lengths.astype(f"<u{length}").tobytes(), units * length),
        _cut(entries.astype("u1").tobytes(), units),
        _cut(of_doc.astype(f"<u{doc}").tobytes(), at * doc),
        _cut(times.astype("u1").tobytes(), at),
    ]
    n = len(units) - 1
    rows = pa.RecordBatch.from_arrays(
        [
            pa.array(bucket[units[:-1]], pa.int32()),
            pa.array(np.full(n, block), pa.int64()),
            pa.array(np.full(n, shape), pa.int32()),
            *columns,
        ],
        NAMES,
    )
    for first in range(0, n, 4096):
        yield rows.slice(first, 4096)


def _frequencies(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    task = TaskContext.get().partitionId()
    for number, batch in enumerate(slices(batches, 1, BLOCK)):
        yield from _block(batch, task * 1_000_003 + number)


class _Counts:
    """Pieces of the pre-tokens of the bucket that is worked on."""

    def __init__(self, path: str) -> None:
        self.counter, self.known = counter(path), {}

    def of(self, units: list[bytes]) -> np.ndarray:
        known = self.known
        new = list({u for u in units if u not in known})
        known.update(zip(new, self.counter.count([u.decode() for u in new]), strict=True))
        return np.array([known[u] for u in units], "i8")

    def keep(self, units: list[bytes]) -> None:
        """Forget all but these, which may occur again."""
        self.known = {u: self.known[u] for u in units}


def _units(rows: pa.RecordBatch, shape: int) -> list[bytes]:
    raw = _run(rows.column("words")).tobytes()
    ends = np.cumsum(_numbers(rows.column("lengths"), shape & 15)).tolist()
    return [raw[a:b] for a, b in zip([0, *ends], ends, strict=False)]


def _sums(batch: pa.RecordBatch, counts: _Counts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """block, document, sum of the pieces, for the frequencies of a batch."""
    shapes = batch.column("shape").to_numpy()
    last = batch.column("bucket").to_numpy()[-1]
    blocks, docs, sums, again = [], [], [], []
    for shape in np.unique(shapes).tolist():
        rows = batch.filter(pa.array(shapes == shape))
        units = _units(rows, shape)
        pieces = counts.of(units)
        entries = _numbers(rows.column("entries"), 1)
        of_row = pc.binary_length(rows.column("times")).to_numpy()
        blocks.append(np.repeat(rows.column("block").to_numpy(), of_row))
        docs.append(_numbers(rows.column("docs"), shape >> 4))
        sums.append(np.repeat(pieces, entries) * _numbers(rows.column("times"), 1))
        end = rows.filter(pa.array(rows.column("bucket").to_numpy() == last))
        again += _units(end, shape)
    counts.keep(again)
    blocks, docs, sums = map(np.concatenate, (blocks, docs, sums))
    order = np.lexsort((docs, blocks))
    blocks, docs, sums = blocks[order], docs[order], sums[order]
    first = np.flatnonzero(
        np.concatenate(([True], (blocks[1:] != blocks[:-1]) | (docs[1:] != docs[:-1])))
    )
    return blocks[first], docs[first], np.add.reduceat(sums, first)


def _count(path: str):
    """Rows by bucket to sums per document of each block; rows with documents pass through."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = _Counts(path)
        for batch in batches:
            buckets = batch.column("bucket").to_numpy()
            documents = batch.filter(pa.array(buckets == DOCUMENTS))
            if documents.num_rows:
                columns = [documents.column(n) for n in ("block", "shape", "words", "lengths", "entries")]
                yield pa.RecordBatch.from_arrays(columns, ANSWERS)
            rest = batch.filter(pa.array(buckets != DOCUMENTS))
            if not rest.num_rows:
                continue
            blocks, docs, sums = _sums(rest, counts)
            edges = np.flatnonzero(np.concatenate(([True], blocks[1:] != blocks[:-1], [True])))
            n, doc, size = len(edges) - 1, _width(docs), _width(sums)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(blocks[edges[:-1]], pa.int64()),
                    pa.array(np.full(n, doc | size << 4), pa.int32()),
                    pa.nulls(n, pa.binary()),
                    _cut(docs.astype(f"<u{doc}").tobytes(), edges * doc),
                    _cut(sums.astype(f"<u{size}").tobytes(), edges * size),
                ],
                ANSWERS,
            )

    return run


#: The last two are identifiers and bytes where ``known`` tells which identifiers are null,
#: else documents and sums, as wide as ``shape`` says.
ANSWERS = ["block", "shape", "known", "one", "two"]


def _add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ordered by block, its documents first, to the documents with their totals."""
    names = ["id", "n_bytes", "n_tokens"]

    def finished() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [
                pa.array(ids, pa.int64(), mask=~known),
                pa.array(sizes, pa.int64()),
                pa.array(totals, pa.int64()),
            ],
            names,
        )

    totals = None
    for batch in batches:
        rows = (batch.column(n).to_pylist() for n in ANSWERS[1:])
        for shape, mask, one, two in zip(*rows, strict=True):
            if mask is not None:
                if totals is not None:
                    yield finished()
                known = np.frombuffer(mask, "u1").astype(bool)
                ids, sizes = np.frombuffer(one, "<i8"), np.frombuffer(two, "<i8")
                totals = np.zeros(len(ids), "i8")
            else:
                found = np.frombuffer(one, f"<u{shape & 15}")
                totals[found] += np.frombuffer(two, f"<u{shape >> 4}").astype("i8")
    if totals is not None:
        yield finished()


def token_counts(
    docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per input row: id, n_bytes (UTF-8) and n_tokens of the whole text.

    The counts are those of the library for the model, without begin or end tokens. A
    null text counts as empty, which has no tokens; repeated rows and null identifiers
    give a row each; an empty table gives no rows.
    """
    tasks = partitions(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    sent = rows.mapInArrow(_frequencies, FREQUENCIES)
    # Documents need no counting; they go along, spread by block.
    to = F.when(F.col("bucket") == DOCUMENTS, F.col("block")).otherwise(F.col("bucket"))
    answers = (
        sent.repartitionById(tasks, F.pmod(to, F.lit(tasks)).cast("int"))
        .sortWithinPartitions("bucket")
        .mapInArrow(_count(model), "block long, shape int, known binary, one binary, two binary")
    )
    return (
        answers.repartitionById(tasks, F.pmod(F.xxhash64("block"), F.lit(tasks)).cast("int"))
        .withColumn("order", F.col("known").isNull())
        .sortWithinPartitions("block", "order")
        .drop("order")
        .mapInArrow(_add, "id long, n_bytes long, n_tokens long")
        .withColumnRenamed("id", id_col)
    )

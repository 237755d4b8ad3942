"""Token ids in files of independent zstandard frames.

One frame holds the ids of one document, two bytes each if the vocabulary allows, else
four, little-endian. After the frames comes a skippable frame with the documents'
identifiers and lengths, and last the seek table of the zstandard seekable format, with
a checksum per frame (the low 32 bits of XXH64 of the decompressed bytes). A reader takes
both tables from the end of a file and then reads only the frames it was asked for.

``manifest.json`` lists the files in ascending order of identifiers, with the number of
ids before each. Files of lost or repeated tasks are not in it.
"""

from __future__ import annotations

import json
import struct
import uuid
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm.common import filesystem, partitions, slices, whole
from tideline.llm.tokens import encoder
from tideline.sources.sinks import qualified

# Fixed values of the zstandard seekable format and of skippable frames.
SEEK_FRAME = 0x184D2A5E
SEEK_MAGIC = 0x8F92EAB1
SEEK_CHECKSUMS = 0x80
#: Skippable frame with the documents: magic number, then width, count and columns.
TABLE_FRAME = 0x184D2A51

READ_BYTES = 8 << 20


class CorruptFrame(ValueError):
    """A frame whose content differs from its checksum."""


def _xxh32(raw: bytes) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF


class FrameWriter:
    """Writes one file; ``add`` takes finished frames in the order of identifiers."""

    def __init__(self, stream, width: int) -> None:
        self.stream, self.width = stream, width
        self.frames: list[tuple[int, int, int]] = []
        self.ids: list[int | None] = []

    def add(self, doc_id: int | None, frame: bytes, size: int, checksum: int) -> None:
        self.stream.write(frame)
        self.frames.append((len(frame), size, checksum))
        self.ids.append(doc_id)

    def close(self) -> None:
        known = np.array([i is not None for i in self.ids], dtype="u1")
        ids = np.array([i or 0 for i in self.ids], dtype="<i8")
        table = struct.pack("<BI", self.width, len(ids)) + known.tobytes() + ids.tobytes()
        self.stream.write(struct.pack("<II", TABLE_FRAME, len(table)) + table)
        entries = np.array([*self.frames, (len(table) + 8, 0, _xxh32(b""))], dtype="<u4")
        body = entries.tobytes() + struct.pack(
            "<IBI", len(entries), SEEK_CHECKSUMS, SEEK_MAGIC
        )
        self.stream.write(struct.pack("<II", SEEK_FRAME, len(body)) + body)


class FrameReader:
    """Reads the tables of one file, and documents of it."""

    def __init__(self, file) -> None:
        self.file = file
        size = file.size()
        file.seek(size - 9)
        count, flags, magic = struct.unpack("<IBI", file.read(9))
        if magic != SEEK_MAGIC or flags != SEEK_CHECKSUMS:
            raise CorruptFrame("no seek table")
        file.seek(size - 9 - 12 * count)
        entries = np.frombuffer(file.read(12 * count), dtype="<u4").reshape(count, 3)
        ends = np.cumsum(entries[:, 0], dtype="i8")
        self.frames, self.ends = entries[:-1], ends[:-1]
        file.seek(int(ends[-1] - entries[-1, 0]))
        magic, length = struct.unpack("<II", file.read(8))
        if magic != TABLE_FRAME:
            raise CorruptFrame("no document table")
        table = file.read(length)
        self.width, n = struct.unpack_from("<BI", table)
        self.known = np.frombuffer(table, "u1", n, 5).astype(bool)
        self.ids = np.frombuffer(table, "<i8", n, 5 + n)
        self.lengths = self.frames[:, 1].astype("i8") // self.width
        self.starts = np.cumsum(self.lengths) - self.lengths

    def documents(self, wanted: np.ndarray) -> Iterator[tuple[int, bytes]]:
        """(place in the file, ids as little-endian unsigned 32-bit) of the places asked for."""
        import zstandard

        inflate = zstandard.ZstdDecompressor()
        begins = self.ends - self.frames[:, 0]
        at = 0
        while at < len(wanted):
            # Neighbours are read together, up to a bound; what lies between is not read.
            last = at
            while (
                last + 1 < len(wanted)
                and wanted[last + 1] == wanted[last] + 1
                and self.ends[wanted[last + 1]] - begins[wanted[at]] <= READ_BYTES
            ):
                last += 1
            base = int(begins[wanted[at]])
            self.file.seek(base)
            raw = self.file.read(int(self.ends[wanted[last]]) - base)
            for k in wanted[at : last + 1].tolist():
                frame = raw[int(begins[k]) - base : int(self.ends[k]) - base]
                try:
                    content = inflate.decompress(frame, max_output_size=int(self.frames[k, 1]))
                except zstandard.ZstdError as error:
                    raise CorruptFrame(f"frame {k}") from error
                if _xxh32(content) != self.frames[k, 2]:
                    raise CorruptFrame(f"frame {k}")
                ids = np.frombuffer(content, "<u2" if self.width == 2 else "<u4")
                yield k, ids.astype("<u4", copy=False).tobytes()
            at = last + 1


def _encode(tokenizer: str, end_id: int, width: int, bounds: list[int], level: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        squeeze = zstandard.ZstdCompressor(level=level, write_checksum=False)
        words, end = encoder(tokenizer), struct.pack("<I", end_id)
        for batch in slices(batches, 1):
            ids = batch.column(0)
            texts = batch.column(1).to_pylist()
            frames, sizes, sums = [], [], []
            for found in words.encode(texts):
                raw = found + end
                if width == 2:
                    raw = np.frombuffer(raw, "<u4").astype("<u2").tobytes()
                frames.append(squeeze.compress(raw))
                sizes.append(len(raw))
                sums.append(_xxh32(raw))
            numbers = ids.fill_null(np.iinfo("i8").min).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.searchsorted(bounds, numbers), pa.int32()),
                    ids,
                    pa.array(frames, pa.binary()),
                    pa.array(sizes, pa.int64()),
                    pa.array(sums, pa.int64()),
                ],
                ["bucket", "id", "frame", "size", "checksum"],
            )

    return run


def _write(path: str, width: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = filesystem(path)
        writer = name = bucket = stream = None
        for batch in batches:
            if batch.num_rows and writer is None:
                bucket = batch.column(0)[0].as_py()
                name = f"tokens-{bucket:06d}-{uuid.uuid4().hex}.zst"
                stream = store.open_output_stream(f"{root}/{name}", compression=None)
                writer = FrameWriter(stream, width)
            for row in zip(*(batch.column(k).to_pylist() for k in range(1, 5)), strict=True):
                writer.add(*row)
        if writer is not None:
            writer.close()
            stream.close()
            yield pa.RecordBatch.from_pydict(
                {
                    "bucket": pa.array([bucket], pa.int32()),
                    "name": [name],
                    "docs": pa.array([len(writer.ids)], pa.int64()),
                    "tokens": pa.array([sum(f[1] for f in writer.frames) // width], pa.int64()),
                }
            )

    return run


def write_token_files(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int,
    files: int | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    level: int = 3,
) -> None:
    """Encode every whole text, append ``end_id`` and write the files and their manifest.

    Documents lie in ascending order of identifiers over all files; nulls come first,
    repeated identifiers all stay (ordered by content), a null or empty text is the end
    id alone, and an empty table gives a manifest without files. Frames are made where
    the texts are read, so that the shuffle into files moves compressed ids. Cuts
    between files are approximate quantiles of the identifiers, one number per file.
    """
    spark = docs.sparkSession
    path, files = qualified(spark, path), files or partitions(spark)
    with open(tokenizer, encoding="utf-8") as file:
        largest = max(max(json.load(file)["model"]["vocab"].values()) + 64, end_id)
    width = 2 if largest < 1 << 16 else 4
    rows = docs.select(F.col(id_col).cast("long").alias("id"), whole(text_col).alias("text"))
    shares = [i / files for i in range(1, files)]
    cuts = rows.agg(F.percentile_approx("id", shares, 10000)).first()[0] if shares else []
    bounds = sorted(set(cuts or []))
    frames = rows.mapInArrow(
        _encode(tokenizer, end_id, width, bounds, level),
        "bucket int, id long, frame binary, size long, checksum long",
    )
    store, root = filesystem(path)
    store.create_dir(root, recursive=True)
    written = (
        frames.repartitionById(len(bounds) + 1, F.col("bucket"))
        .sortWithinPartitions(F.asc_nulls_first("id"), "size", "checksum")
        .mapInArrow(_write(path, width), "bucket int, name string, docs long, tokens long")
        .collect()
    )
    listed, before = [], 0
    for row in sorted(written):
        listed.append({"name": row.name, "docs": row.docs, "start": before})
        before += row.tokens
    with store.open_output_stream(f"{root}/manifest.json") as out:
        out.write(json.dumps({"tokens": before, "files": listed}).encode())


def read_token_files(
    spark: SparkSession, path: str, doc_ids: Sequence[int] | None = None
) -> DataFrame:
    """Documents of the files: doc_id, start, n_tokens, ids (little-endian 32-bit, binary).

    ``start`` counts the ids of all documents before. With ``doc_ids`` only the frames of
    those documents are read and decompressed. Checksums are verified.
    """
    path = qualified(spark, path)
    store, root = filesystem(path)
    with store.open_input_stream(f"{root}/manifest.json") as file:
        listed = json.loads(file.read())["files"]
    wanted = None if doc_ids is None else np.unique(np.array(list(doc_ids), dtype="i8"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = filesystem(path)
        for batch in batches:
            for _, name, before in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                with store.open_input_file(f"{root}/{name}") as file:
                    reader = FrameReader(file)
                    places = np.arange(len(reader.ids))
                    if wanted is not None:
                        places = places[np.isin(reader.ids, wanted) & reader.known]
                    at, ids, size = [], [], 0
                    for k, raw in reader.documents(places):
                        at.append(k)
                        ids.append(raw)
                        size += len(raw)
                        if size >= READ_BYTES:
                            yield chunk(reader, at, ids, before)
                            at, ids, size = [], [], 0
                    if at:
                        yield chunk(reader, at, ids, before)

    def chunk(reader: FrameReader, at: list[int], ids: list[bytes], before: int):
        return pa.RecordBatch.from_arrays(
            [
                pa.array(reader.ids[at], pa.int64(), mask=~reader.known[at]),
                pa.array(reader.starts[at] + before, pa.int64()),
                pa.array(reader.lengths[at], pa.int64()),
                pa.array(ids, pa.binary()),
            ],
            ["doc_id", "start", "n_tokens", "ids"],
        )

    places = [(i, f["name"], f["start"]) for i, f in enumerate(listed)]
    return (
        spark.createDataFrame(places, "place int, name string, start long")
        .repartitionById(max(1, len(places)), F.col("place"))
        .mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")
    )

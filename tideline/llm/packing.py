"""Packing documents into as few fixed-size sequences as possible.

Only lengths matter for packing, and a length is one of at most ``capacity`` numbers. So
the instance that is solved is the count of pieces per length, which does not grow with
the documents; the solution is a list of sequence types with multiplicities. Spark then
gives every piece its place: pieces are ranked within their length, and a rank is a slot.

Reduction (Martello and Toth): take the longest length j that is left and the room r
beside it. A set {j, k} dominates every other set with j if whatever else fits beside j
fits in the space of one k; such sets are fixed for good, as often as both lengths last:
nothing fits beside j; a length k = r fills the room; no two pieces fit beside j together,
so that the longest fitting k is best; or no two or more pieces fill more of the room than
k does. A set of three {j, k, b} is fixed where no three pieces fit beside j and of no two
that do the shorter one is longer than b, the longest that fits beside j and k. Every room
is tested, however large; larger sets are not tried. What is left is packed by best fit,
longest first.
"""

from __future__ import annotations

import struct
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterable, Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tideline.llm.common import partitions, slices, stored, whole
from tideline.llm.tokens import encoder


@dataclass(frozen=True)
class Kind:
    """``count`` sequences, each with the slots (length, how many), in this order."""

    count: int
    slots: tuple[tuple[int, int], ...]

    @property
    def used(self) -> int:
        return sum(length * n for length, n in self.slots)


def _fullest(counts: Mapping[int, int], room: int, above: int) -> bool:
    """Whether two or more pieces together take more than ``above`` and at most ``room``.

    Two pieces decide: if three or more fit, taking two of them already exceeds
    ``above`` or the remaining ones raise the sum; the search is by subset sums over the
    lengths up to ``room``, as bits of one number.
    """
    mask = (1 << (room + 1)) - 1
    single = sums = 0
    for length in counts:
        if length <= room:
            single |= 1 << length
    # Sums of at least two pieces; multiplicities are ignored, which can only find more
    # and so only refuses a reduction that would have been allowed. The search ends at the
    # first sum that is large enough.
    reach = single
    while True:
        more = sums
        for length in counts:
            if length <= room:
                more |= (reach << length) & mask
                if more >> (above + 1):
                    return True
        if more == sums:
            return False
        sums, reach = more, single | more


def reduce(counts: dict[int, int], capacity: int) -> tuple[list[Kind], dict[int, int]]:
    """Dominating sets that are fixed, and what is left."""
    left = {length: n for length, n in counts.items() if n}
    order = sorted(left)
    fixed: list[Kind] = []

    def take(*lengths: int) -> None:
        """Fix the set as often as its lengths last."""
        need = {x: lengths.count(x) for x in lengths}
        n = min(left[x] // k for x, k in need.items())
        fixed.append(Kind(n, tuple((x, k) for x, k in need.items())))
        for x, k in need.items():
            left[x] -= n * k
            if not left[x]:
                del left[x]
                del order[bisect_left(order, x)]

    def third(j: int, k: int, room: int) -> int:
        """The b of a set {j, k, b} that dominates, or 0."""
        # Copies that don't exist only add pieces, which can only refuse.
        if 3 * order[0] <= room:
            return 0
        at = bisect_left(order, room - k + 1)
        while at and left[order[at - 1]] <= (j, k).count(order[at - 1]):
            at -= 1
        if not at or (at < len(order) and 2 * order[at] <= room):
            return 0
        return order[at - 1]

    for j in reversed(list(order)):
        while j in left:
            room = capacity - j
            at = bisect_left(order, room + 1)
            fits = [x for x in order[max(0, at - 1) : at]]
            if not fits or (fits == [j] and left[j] == 1 and at == 1):
                take(j)
                continue
            k = fits[0]
            if k == j and left[j] == 1:
                k = order[at - 2]
            smallest = order[0]
            second = smallest if left[smallest] > 1 or len(order) == 1 else order[1]
            if k == room or smallest + second > room:
                take(j, k)
                continue
            small = {x: left[x] for x in order[:at]}
            if not _fullest(small, room, k):
                take(j, k)
                continue
            b = third(j, k, room)
            if b:
                take(j, k, b)
                continue
            break
    return fixed, left


def best_fit(counts: dict[int, int], capacity: int) -> list[Kind]:
    """Best fit, longest first, for equal pieces and equal sequences at once."""
    open_kinds: dict[int, list[Kind]] = {}
    rooms: list[int] = []
    full: list[Kind] = []

    def put(kind: Kind) -> None:
        room = capacity - kind.used
        if not room:
            full.append(kind)
            return
        if room not in open_kinds:
            open_kinds[room] = []
            insort(rooms, room)
        open_kinds[room].append(kind)

    for length in sorted(counts, reverse=True):
        n = counts[length]
        while n:
            at = bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                kind = open_kinds[room].pop()
                if not open_kinds[room]:
                    del open_kinds[room]
                    del rooms[at]
            else:
                room, kind = capacity, Kind(n, ())
            each = min(room // length, n)
            taken = min(kind.count, n // each)
            put(Kind(taken, (*kind.slots, (length, each))))
            if kind.slots and kind.count > taken:
                put(Kind(kind.count - taken, kind.slots))
            n -= taken * each
    return full + [k for kinds in open_kinds.values() for k in kinds]


def plan(counts: dict[int, int], capacity: int) -> list[Kind]:
    """Sequence types for pieces of these lengths, each at most ``capacity``."""
    if any(length < 1 or length > capacity for length in counts):
        raise ValueError("Lengths must lie between 1 and the capacity")
    fixed, left = reduce(counts, capacity)
    return fixed + best_fit(left, capacity)


def _intervals(kinds: list[Kind]) -> dict[int, np.ndarray]:
    """By length: rows (first rank, first sequence, pieces a sequence, first offset)."""
    rows: dict[int, list[tuple[int, int, int, int]]] = {}
    ranks: dict[int, int] = {}
    first = 0
    for kind in kinds:
        offset = 0
        for length, each in kind.slots:
            at = ranks.get(length, 0)
            rows.setdefault(length, []).append((at, first, each, offset))
            ranks[length] = at + kind.count * each
            offset += length * each
        first += kind.count
    return {length: np.array(r, dtype="i8") for length, r in rows.items()}


def pack(pieces: DataFrame, capacity: int, length_col: str = "length") -> DataFrame:
    """``pieces`` with sequence_id and offset; every row gets a place.

    Sequences are numbered from 0 and filled from offset 0 without gaps. Rows of equal
    length are interchangeable, so ties and repeated rows need no rule. An empty table
    gives an empty table. Columns that have the names of the results already are replaced.
    ``pieces`` must be stored, for it is read twice.

    No length is gathered in one task, however common it is: rows are ranked within
    parts, and the parts of a length are numbered by their counts.
    """
    spark = pieces.sparkSession
    names = [n for n in pieces.columns if n.lower() not in ("sequence_id", "offset")]
    parts = partitions(spark)
    row = F.struct(*(F.col(f"`{n}`").alias(f"c{i}") for i, n in enumerate(names))).alias("row")
    dealt = pieces.select(F.col(length_col).cast("long").alias("size"), row).select(
        "size", "row", F.pmod(F.xxhash64("row"), F.lit(parts)).alias("part")
    )
    per_part = stored(
        dealt.groupBy("size", "part").agg(F.count(F.lit(1)).alias("n")), "piece-counts"
    )
    # At most one row per possible length.
    counts = {r.size: r.n for r in per_part.groupBy("size").agg(F.sum("n").alias("n")).collect()}
    slots = _intervals(plan(counts, capacity))
    before = per_part.select(
        F.col("size").alias("at_size"),
        F.col("part").alias("at_part"),
        (
            F.sum("n").over(Window.partitionBy("size").orderBy("part")) - F.col("n")
        ).alias("before"),
    )
    ranked = dealt.withColumn(
        "rank", F.row_number().over(Window.partitionBy("part", "size").orderBy("row"))
    ).join(before, (F.col("size") == F.col("at_size")) & (F.col("part") == F.col("at_part")))

    place_type = T.StructType(
        [T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]
    )

    @F.arrow_udf(place_type)
    def place(size: pa.Array, rank: pa.Array) -> pa.Array:
        sizes, ranks = size.to_numpy(zero_copy_only=False), rank.to_numpy(zero_copy_only=False)
        sequence, offset = np.empty(len(sizes), "i8"), np.empty(len(sizes), "i8")
        order = np.argsort(sizes, kind="stable")
        edges = np.flatnonzero(np.diff(sizes[order])) + 1
        for group in np.split(order, edges) if len(order) else []:
            length = int(sizes[group[0]])
            table = slots[length]
            found = table[np.searchsorted(table[:, 0], ranks[group], side="right") - 1]
            inside = ranks[group] - found[:, 0]
            sequence[group] = found[:, 1] + inside // found[:, 2]
            offset[group] = found[:, 3] + inside % found[:, 2] * length
        return pa.StructArray.from_arrays(
            [pa.array(sequence), pa.array(offset)], ["sequence_id", "offset"]
        )

    return ranked.select(
        "row", place("size", F.col("before") + F.col("rank") - 1).alias("place")
    ).select(
        *(F.col(f"row.c{i}").alias(n) for i, n in enumerate(names)),
        "place.sequence_id",
        "place.offset",
    )


def token_pieces(
    docs: DataFrame,
    tokenizer: str,
    end_id: int,
    capacity: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """Pieces of every whole text: id, piece, start, length, ids_crc32 and, on request, ids.

    A document is its ids and the end id; only one longer than ``capacity`` is cut, into
    pieces of ``capacity`` ids and a rest. A null or empty text is the end id alone.
    """

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, end, step = encoder(tokenizer), struct.pack("<I", end_id), capacity * 4
        for batch in slices(batches, 1):
            docs, numbers, starts, lengths, sums, kept = [], [], [], [], [], []
            texts = batch.column(1).to_pylist()
            for at, ids in enumerate(words.encode(texts)):
                raw = ids + end
                for number, k in enumerate(range(0, len(raw), step)):
                    part = raw[k : k + step]
                    docs.append(at)
                    numbers.append(number)
                    starts.append(k // 4)
                    lengths.append(len(part) // 4)
                    sums.append(zlib.crc32(part))
                    if with_ids:
                        kept.append(part)
            out = [
                batch.column(0).take(pa.array(docs, pa.int64())),
                pa.array(numbers, pa.int32()),
                pa.array(starts, pa.int64()),
                pa.array(lengths, pa.int64()),
                pa.array(sums, pa.int64()),
            ]
            if with_ids:
                out.append(pa.array(kept, pa.binary()))
            yield pa.RecordBatch.from_arrays(out, names)

    names = ["id", "piece", "start", "length", "ids_crc32", *["ids"] * with_ids]
    schema = "id long, piece int, start long, length long, ids_crc32 long" + (
        ", ids binary" if with_ids else ""
    )
    rows = docs.select(F.col(id_col).cast("long").alias("id"), whole(text_col).alias("text"))
    return rows.mapInArrow(cut, schema).withColumnRenamed("id", id_col)


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    end_id: int = 1,
    capacity: int = 4096,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """Every document's pieces with their sequence and offset."""
    pieces = stored(
        token_pieces(docs, tokenizer, end_id, capacity, id_col, text_col, with_ids), "pieces"
    )
    return pack(pieces, capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """The packed ids: sequence_id, n_tokens, ids; needs pieces that carry their ids."""
    inside = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(
        F.sum("length").alias("n_tokens"),
        F.aggregate(
            inside, F.lit(b""), lambda done, x: F.concat(done, x["ids"])
        ).alias("ids"),
    )

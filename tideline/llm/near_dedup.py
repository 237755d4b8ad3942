"""Near-duplicates by order MinHash, verified by banded alignment.

A text is a sequence of runs of five words (shingles), each labelled with its occurrence
number. Per hash function the three labelled shingles with the least hashes are kept in
the order they have in the text; two texts that agree in such a triple become candidates.
Agreement needs the shingles and their order, so it follows the edit similarity.

Two texts are linked if an alignment of their shingle sequences matches at least 0.8 of
all: matched / (n1 + n2 - matched). An alignment that good can't leave a diagonal band
whose width follows from the two lengths, so only the band is searched and the result
is exact.

A bucket of candidates never becomes its pairs. Texts of which more than a fifth of the
shingles occur in no other candidate are set aside first: they have no partner. Then every
bucket compares its members with one leader, the member with the most company; links give
components, and every member remembers which of the leader's shingles it has. Only members
outside the leader's component are looked at again: they meet the others in blocks of
bounded size, where what two members can share at most is counted from those memories.
Pairs that this exact bound leaves, which are few, are aligned.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.llm.common import map_rows, slices, stored
from tideline.llm.components import components
from tideline.llm.exact_dedup import TEXT_KEY, keep_rows, merge_runs
from tideline.llm.words import chunks, mix, words

SHINGLE = 5
SKETCHES, MINIMA = 16, 3
BLOCK = 256
#: Places a bucket of unknown size is dealt to.
SPREAD = 8
#: A shingle that a text has more often is looked up as bits.
MANY = 8
#: Columns off the diagonal of the first band, and columns that are dropped together.
NARROW, DROP = 64, 64
#: Texts with more shingles go through the hash functions one by one, to bound memory.
LONG = 1 << 16
_SEEDS = mix(np.arange(1, SKETCHES + 1, dtype="u8") * np.uint64(0x9E3779B97F4A7C15))
_FACTOR = np.uint64(0x100000001B3)
_STIR = np.uint64(0xBF58476D1CE4E5B9)


def shingles(found: np.ndarray) -> np.ndarray:
    """Hashes of the runs of five words; a shorter text is one run."""
    found = found.astype("u8")
    if not len(found):
        return found
    n = max(1, len(found) - SHINGLE + 1)
    out = np.zeros(n, "u8")
    for k in range(min(SHINGLE, len(found))):
        out = mix(out * _FACTOR + found[k : k + n])
    return out


def labelled(found: np.ndarray) -> np.ndarray:
    """Shingles with their occurrence number: the second of a kind is another one."""
    run = np.sort(found)
    if not (run[1:] == run[:-1]).any():
        return found
    order = np.argsort(found, kind="stable")
    first = np.ones(len(run), dtype=bool)
    first[1:] = run[1:] != run[:-1]
    place = np.arange(len(run))
    number = place - np.maximum.accumulate(np.where(first, place, 0))
    out = np.empty_like(found)
    out[order] = np.where(
        number > 0, mix(run + number.astype("u8") * np.uint64(0xD6E8FEB86659FD93)), run
    )
    return out


def sketch(kinds: np.ndarray) -> np.ndarray:
    """Per hash function the least labelled shingles in text order, as one number."""
    size = min(MINIMA, len(kinds))
    if len(kinds) <= MINIMA:
        places = np.broadcast_to(np.arange(size), (SKETCHES, size))
    else:
        rows = []
        for seeds in [_SEEDS] if len(kinds) <= LONG else np.split(_SEEDS, SKETCHES):
            ranks = (kinds[None, :] ^ seeds[:, None]) * _STIR
            ranks ^= ranks >> np.uint64(29)
            rows.append(np.argpartition(ranks, size - 1, axis=1)[:, :size])
        places = np.sort(np.concatenate(rows), axis=1)
    out = _SEEDS.copy()
    for k in range(size):
        out = mix(out * _FACTOR + kinds[places[:, k]])
    return out


class _Columns:
    """Where a sequence has each value: as places, or as bits where there are many."""

    def __init__(self, values: np.ndarray) -> None:
        self.size = len(values)
        self.places: dict[int, list[int]] = {}
        for j, value in enumerate(values.tolist()):
            self.places.setdefault(value, []).append(j)
        self.bits = {
            value: sum(1 << j for j in columns)
            for value, columns in self.places.items()
            if len(columns) > MANY
        }

    def common(self, rows: list[int], band: int) -> int:
        """Longest common subsequence whose matches lie at most ``band`` off the diagonal.

        A bit vector over the columns of the band is updated row by row. Columns that the
        band has left can't change any more: they are counted and dropped, some at a time.
        Columns it has not reached have no match yet.
        """
        width = 2 * band + 1 + DROP
        full = state = (1 << width) - 1
        window = (1 << 2 * band + 1) - 1
        base = done = 0  # the column of the lowest bit, and matches in the columns dropped
        for i, value in enumerate(rows):
            low = i - band - base
            if low >= DROP:
                done += low - (state & ((1 << low) - 1)).bit_count()
                state = state >> low | (full ^ (full >> low))
                base, low = base + low, 0
            columns = self.places.get(value)
            if columns is None:
                continue
            if value in self.bits:
                inside = window << low if low >= 0 else window >> -low
                match = self.bits[value] >> base & inside
            else:
                match = 0
                for j in columns:
                    if -band <= j - i <= band:
                        match |= 1 << (j - base)
            hit = state & match
            state = ((state + hit) | (state - hit)) & full
        return done + width - state.bit_count()


def aligned(a: np.ndarray, b: np.ndarray, need: int) -> int:
    """Longest common subsequence of two shingle sequences, 0 if it is under ``need``.

    Equal ends are matched first, the rest is searched in a band off the diagonal. A band is
    wide enough if no more is left unmatched than it is wide; the search begins with a
    narrow one, which is enough for texts that differ in few places, and widens it up to
    the band that an alignment of ``need`` matches can't leave.
    """
    if min(len(a), len(b)) < need:
        return 0
    short = min(len(a), len(b))
    differ = np.flatnonzero(a[:short] != b[:short])
    head = int(differ[0]) if len(differ) else short
    rest = short - head
    differ = np.flatnonzero(a[len(a) - rest :][::-1] != b[len(b) - rest :][::-1])
    tail = int(differ[0]) if len(differ) else rest
    a, b = a[head : len(a) - tail], b[head : len(b) - tail]
    done = head + tail
    if len(a) and len(b):
        most = len(a) + len(b) - 2 * (need - done)
        common = np.intersect1d(labelled(a), labelled(b), assume_unique=True)
        if done + len(common) < need:
            return 0
        rows, columns, band = a.tolist(), _Columns(b), min(most, NARROW)
        found = columns.common(rows, band)
        while band < most and len(a) + len(b) - 2 * found > band:
            band = min(most, 4 * band)
            found = columns.common(rows, band)
        done += found
    return done if done >= need else 0


def needed(n1: int, n2: int, similarity: float) -> int:
    """The least number of matches that reaches the similarity."""
    return math.ceil((n1 + n2) * similarity / (1 + similarity) - 1e-9)


def _digest(hashes: np.ndarray) -> bytes:
    """Of the words of a text."""
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()


def _sketches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, 1):
        texts = batch.column(1).to_pylist()
        for first, part in chunks(texts):
            found = words(part)
            digests, sizes, kept, numbers = [], [], [], []
            for start, n in zip(found.starts.tolist(), found.counts.tolist(), strict=True):
                of = found.hashes[start : start + n]
                kinds = labelled(shingles(of.astype("<u4")))
                raw = of.astype("<u4").tobytes()
                digests.append(_digest(of))
                sizes.append(len(kinds))
                numbers.append(sketch(kinds).astype("i8") if n else np.empty(0, "i8"))
                kept.append(raw)
            values = pa.array(np.concatenate(numbers))
            offsets = np.cumsum([0, *map(len, numbers)]).astype("i4")
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(first, len(part)),
                    pa.array(digests, pa.binary()),
                    pa.array(sizes, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(offsets), values),
                    pa.array(kept, pa.binary()),
                ],
                ["id", "digest", "n", "sketches", "words"],
            )


def _kinds(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, 1):
        for row, raw in zip(
            batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True
        ):
            kinds = labelled(shingles(np.frombuffer(raw, "<u4"))).astype("i8")
            for at in range(0, len(kinds), 1 << 20):
                part = kinds[at : at + (1 << 20)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part), pa.array(np.full(len(part), row, "i8"))], ["kind", "row"]
                )


def _compare(similarity: float, with_bits: bool):
    """Pairs with their words to whether they are linked, and what they share.

    ``bits`` tells which labelled shingles of ``b``, in ascending order, ``a`` has.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = found = kinds = None
        for batch in batches:
            one, two = batch.column("a").to_pylist(), batch.column("b").to_pylist()
            of_one, of_two = batch.column("words_a"), batch.column("words_b")
            linked, bits = [], []
            for i, b in enumerate(two):
                if b != last:
                    last, found = b, shingles(np.frombuffer(of_two[i].as_py(), "<u4"))
                    kinds = np.sort(labelled(found))
                mine = shingles(np.frombuffer(of_one[i].as_py(), "<u4"))
                need = needed(len(mine), len(found), similarity)
                shared = np.isin(kinds, labelled(mine), assume_unique=True)
                linked.append(int(shared.sum()) >= need and bool(aligned(mine, found, need)))
                bits.append(np.packbits(shared).tobytes() if with_bits else None)
            yield pa.RecordBatch.from_pydict(
                {
                    "a": pa.array(one, pa.int64()),
                    "b": pa.array(two, pa.int64()),
                    "linked": pa.array(linked, pa.bool_()),
                    "bits": pa.array(bits, pa.binary()),
                }
            )

    return run


def _compared(
    pairs: DataFrame, texts: DataFrame, similarity: float, with_bits: bool
) -> DataFrame:
    """The pairs (a, b), aligned. Spark splits a text that is in very many pairs."""
    one = texts.select(F.col("row").alias("a"), F.col("words").alias("words_a"))
    two = texts.select(F.col("row").alias("b"), F.col("words").alias("words_b"))
    both = pairs.select("a", "b").join(one, "a").join(two, "b")
    return both.mapInArrow(
        _compare(similarity, with_bits), "a long, b long, linked boolean, bits binary"
    )


#: Pairs of members that are looked at together, and bytes of what they share.
PAIRS, SHARED = 1 << 18, 1 << 24


def _partners(group: np.ndarray, side: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row the places of those it meets, as begin and end.

    Rows lie by group and, within it, by side. In a group of one side everyone meets those
    behind; in one of two sides the first side meets the second.
    """
    if not len(group):
        return np.empty(0, "i8"), np.empty(0, "i8")
    begins = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
    sizes = np.diff(np.append(begins, len(group)))
    begin, end = np.repeat(begins, sizes), np.repeat(begins + sizes, sizes)
    second = (side != side[begin]).astype("i8")
    seconds = np.repeat(np.add.reduceat(second, begins), sizes)
    two = seconds > 0
    first = np.where(two, end - seconds, np.arange(len(group)) + 1)
    return first, np.where(two & (second > 0), first, end)


def _pairs(first: np.ndarray, end: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All rows with all their partners, some at a time."""
    counts = np.maximum(end - first, 0)
    done = np.cumsum(counts)
    at = 0
    while at < len(counts):
        before = done[at - 1] if at else 0
        upto = max(at + 1, int(np.searchsorted(done, before + PAIRS, side="right")))
        n = counts[at:upto]
        a = np.repeat(np.arange(at, upto), n)
        place = np.arange(len(a)) - np.repeat(np.cumsum(n) - n, n)
        yield a, first[a] + place
        at = upto


def _shared(bits: np.ndarray, offsets: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many bits the rows of each pair have in common; both have as many."""
    out = np.zeros(len(a), "i8")
    sizes = np.diff(offsets)[a]
    order = np.argsort(sizes, kind="stable")
    edges = np.flatnonzero(np.diff(sizes[order])) + 1
    for same in np.split(order, edges) if len(order) else []:
        size = int(sizes[same[0]])
        step = max(1, SHARED // max(size, 1))
        for at in range(0, len(same), step):
            part = same[at : at + step]
            wide = np.arange(size)
            one = bits[offsets[a[part]][:, None] + wide]
            two = bits[offsets[b[part]][:, None] + wide]
            out[part] = np.bitwise_count(one & two).sum(axis=1, dtype="i8")
    return out


def _blocks(similarity: float):
    """Pairs of one block or of two that may be linked and are in different components.

    Rows come by bucket and blocks, and by side within them; many such groups are worked on
    together. Two members share at most the leader's shingles that both have, and of
    the others the fewer of those that also another text has. A pair that shares several
    buckets is named in the first of them only.
    """
    names = ["bucket", "low", "high", "side", "row", "root", "n", "u", "bits", "sketches"]

    def found(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        column = {n: batch.column(n).to_numpy(zero_copy_only=False) for n in names[:8]}
        codes = batch.column("sketches").flatten().to_numpy().reshape(batch.num_rows, -1)
        raw = batch.column("bits").cast(pa.large_binary())
        offsets = np.frombuffer(raw.buffers()[1], "i8")[raw.offset :][: len(raw) + 1]
        bits = np.frombuffer(raw.buffers()[2] or b"", "u1")
        group = np.cumsum(_changes(column))
        first, end = _partners(group, column["side"])
        row, root, n = column["row"], column["root"], column["n"]
        ones = np.zeros(len(bits) + 1, "i8")
        np.cumsum(np.bitwise_count(bits), out=ones[1:])
        known = ones[offsets[1:]] - ones[offsets[:-1]]
        other = n - column["u"] - known
        for a, b in _pairs(first, end):
            need = (n[a] + n[b]) * similarity - 1e-3
            some = np.minimum(known[a], known[b]) + np.minimum(other[a], other[b])
            some = np.minimum(some, np.minimum(n[a], n[b]))
            ok = (some * (1 + similarity) >= need) & (root[a] != root[b])
            a, b, need = a[ok], b[ok], need[ok]
            shared = _shared(bits, offsets, a, b) + np.minimum(other[a], other[b])
            ok = shared * (1 + similarity) >= need
            a, b = a[ok], b[ok]
            common = codes[a, np.argmax(codes[a] == codes[b], axis=1)]
            ok = common == column["bucket"][a]
            one, two = row[a[ok]], row[b[ok]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.minimum(one, two)), pa.array(np.maximum(one, two))], ["a", "b"]
            )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            batch = batch.select(names)
            if rest is not None:
                together = pa.Table.from_batches([rest, batch]).combine_chunks()
                [batch] = together.to_batches()
            # The last group may go on in the next batch.
            edges = np.flatnonzero(_changes({n: batch.column(n).to_numpy() for n in names[:3]}))
            upto = int(edges[-1]) if len(edges) else 0
            if upto:
                yield from found(batch.slice(0, upto))
            rest = batch.slice(upto)
        if rest is not None and rest.num_rows:
            yield from found(rest)

    return run


def _changes(column: dict[str, np.ndarray]) -> np.ndarray:
    """Whether a row begins a group."""
    out = np.ones(len(column["bucket"]), dtype=bool)
    out[1:] = False
    for name in ("bucket", "low", "high"):
        out[1:] |= column[name][1:] != column[name][:-1]
    return out


#: Rows of a bucket that meet what is known of it in one place.
SALTED = 512


def _of_bucket(rows: DataFrame, known: DataFrame) -> DataFrame:
    """Rows with what is known of their bucket, joined by bucket and salt.

    Both sides have ``size``, by which a large bucket is dealt to several places: the rows
    by their own hash, the one row of what is known to each.
    """
    places = F.ceil(F.col("size") / SALTED).cast("int")
    here = rows.withColumn("salt", F.pmod(F.xxhash64("row"), places).cast("int"))
    there = known.withColumn("salt", F.explode(F.sequence(F.lit(0), places - 1)))
    return here.join(there.drop("size"), ["bucket", "salt"]).drop("salt")


def near_classes(
    docs: DataFrame,
    similarity: float = 0.8,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per input row: id, class_id, class_size, kept.

    A class is a connected component of linked texts. ``class_id`` is the smallest
    identifier in it, whose row is the one that stays. Texts with the same words are of one
    class, whatever is between the words; so are all texts without words, null ones
    included. A text of fewer than five words is linked only to its copies. A null
    identifier stays only if its class has no other; of repeated rows one stays; an
    empty table gives no rows.
    """
    return _classes(docs, similarity, id_col, text_col)


def _classes(
    docs: DataFrame, similarity: float, id_col: str, text_col: str, keyed: bool = False
) -> DataFrame:
    """The classes and, if ``keyed``, the digest of the row's words as TEXT_KEY."""
    also = [F.col("digest").alias(TEXT_KEY)] if keyed else []
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    texts = stored(
        rows.mapInArrow(
            _sketches, "id long, digest binary, n long, sketches array<long>, words binary"
        ).withColumn("row", F.monotonically_increasing_id()),
        "sketches",
    )
    # One text for each sequence of words.
    single = (
        texts.filter("n > 0")
        .groupBy("digest")
        .agg(F.min(F.struct("row", "n", "sketches")).alias("s"))
        .select("s.*")
    )
    entries = stored(
        single.select("row", "n", "sketches", F.explode(F.array_distinct("sketches")).alias("bucket")),
        "sketch-buckets",
    )
    several = entries.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    # How large a bucket is isn't known before this join, so all are dealt to some places.
    some = F.sequence(F.lit(0), F.lit(SPREAD - 1))
    entries = stored(
        entries.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(SPREAD)).cast("int"))
        .join(several.withColumn("salt", F.explode(some)), ["bucket", "salt"])
        .drop("salt"),
        "shared-buckets",
    )
    candidates = entries.groupBy("row").agg(F.sum("size").alias("company"))
    candidates = stored(texts.select("row", "n", "words").join(candidates, "row"), "candidates")

    # Shingles that no other candidate has.
    lonely = (
        candidates.select("row", "words")
        .mapInArrow(_kinds, "kind long, row long")
        .groupBy("kind")
        .agg(F.count(F.lit(1)).alias("n"), F.min("row").alias("row"))
        .filter("n = 1")
        .groupBy("row")
        .agg(F.count(F.lit(1)).alias("u"))
    )
    partners = (
        candidates.select("row", "n", "company")
        .join(lonely, "row", "left")
        .fillna({"u": 0})
        .filter(F.col("n") - F.col("u") >= F.col("n") * similarity - 1e-6)
    )
    entries = stored(
        entries.select("row", "sketches", "bucket", "size").join(partners, "row"), "partner-buckets"
    )

    # Every member meets the leader of its buckets.
    leaders = (
        entries.groupBy("bucket")
        .agg(
            F.max(F.struct("company", (-F.col("row")).alias("order"), "row")).alias("of"),
            F.max("size").alias("size"),
        )
        .select("bucket", "size", F.col("of.row").alias("leader"))
    )
    leaders = stored(leaders, "leaders")
    entries = stored(_of_bucket(entries, leaders), "led-buckets")
    pairs = (
        entries.filter("row != leader")
        .select(F.col("row").alias("a"), F.col("leader").alias("b"))
        .distinct()
    )
    met = stored(_compared(pairs, candidates, similarity, with_bits=True), "leader-pairs")
    links = met.filter("linked").select("a", "b")
    roots = components(links, "a", "b")

    # Members that are not in the component of their bucket's leader, which is looked up once
    # a bucket.
    own = roots.select(F.col("node").alias("row"), F.col("root").alias("own"))
    its = roots.select(F.col("node").alias("leader"), F.col("root").alias("its"))
    its = leaders.join(its, "leader", "left").select(
        "bucket", "size", F.coalesce("its", "leader").alias("its")
    )
    members = stored(
        _of_bucket(entries.filter("row != leader").join(own, "row", "left"), its)
        .withColumn("root", F.coalesce("own", "row"))
        .withColumn("inside", F.col("root") == F.col("its"))
        .drop("own", "its"),
        "rooted-buckets",
    )
    counts = (
        members.groupBy("bucket")
        .agg(
            F.sum(F.col("inside").cast("long")).alias("n_in"),
            F.sum((~F.col("inside")).cast("long")).alias("n_out"),
            F.max("size").alias("size"),
        )
        .filter("n_out > 0 AND n_in + n_out > 1")
    )
    out_blocks = F.ceil(F.col("n_out") / BLOCK).cast("int")
    in_blocks = F.ceil(F.col("n_in") / BLOCK).cast("int")
    mine = F.when(
        F.col("inside"), out_blocks + F.pmod(F.xxhash64("row"), in_blocks).cast("int")
    ).otherwise(F.pmod(F.xxhash64("row"), out_blocks).cast("int"))
    meets = F.when(F.col("inside"), F.sequence(F.lit(0), out_blocks - 1)).otherwise(
        F.sequence(F.lit(0), out_blocks + in_blocks - 1)
    )
    dealt = (
        _of_bucket(members, counts)
        .join(
            met.select(F.col("a").alias("row"), F.col("b").alias("leader"), "bits"),
            ["row", "leader"],
        )
        .withColumn("mine", mine)
        .withColumn("other", F.explode(meets))
        .select(
            "bucket",
            F.least("mine", "other").alias("low"),
            F.greatest("mine", "other").alias("high"),
            F.col("mine").alias("side"),
            "row",
            "root",
            "n",
            "u",
            "bits",
            "sketches",
        )
    )
    by = ["bucket", "low", "high"]
    pairs = (
        dealt.repartition(*by)
        .sortWithinPartitions(*by, "side")
        .mapInArrow(_blocks(similarity), "a long, b long")
        .distinct()
    )
    more = stored(_compared(pairs, candidates, similarity, with_bits=False), "other-pairs")
    roots = components(
        links.unionByName(more.filter("linked").select("a", "b")), "a", "b"
    )

    # Copies join the class of the text they share their words with.
    copies = merge_runs(
        texts.select(
            F.spark_partition_id().alias("part"),
            F.col("row").alias("id"),
            F.xxhash64("digest").alias("prefix"),
            "digest",
            F.col("n").alias("bytes"),
        ),
        "min",
    ).select(F.col("id").alias("row"), F.col("best.id").alias("text"))
    member = (
        texts.select("row", "id", *also)
        .join(copies, "row")
        .join(roots.select(F.col("node").alias("text"), "root"), "text", "left")
        .withColumn("root", F.coalesce("root", "text"))
    )
    return merge_runs(
        member.select(
            F.pmod(F.xxhash64("row"), F.lit(1 << 20)).cast("int").alias("part"),
            "id",
            F.xxhash64("root").alias("prefix"),
            F.col("root").alias("digest"),
            F.lit(0).cast("long").alias("bytes"),
            *(TEXT_KEY for _ in also),
        ),
        "min",
        carried=TEXT_KEY if keyed else None,
    ).select(
        F.col("id").alias(id_col),
        F.col("best.id").alias("class_id"),
        F.col("n").alias("class_size"),
        "kept",
        *(TEXT_KEY for _ in also),
    )


def _keyed(docs: DataFrame, text_col: str) -> DataFrame:
    """The rows with the digest of their words as TEXT_KEY."""
    place = docs.columns.index(text_col)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, place):
            digests = []
            for _, part in chunks(batch.column(place).to_pylist()):
                found = words(part)
                for start, n in zip(found.starts.tolist(), found.counts.tolist(), strict=True):
                    digests.append(_digest(found.hashes[start : start + n]))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(digests, pa.binary())],
                [*batch.schema.names, f"c{batch.num_columns}"],
            )

    return map_rows(docs, run, [T.StructField(TEXT_KEY, T.BinaryType())])


def near_dedup(
    docs: DataFrame,
    similarity: float = 0.8,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The rows of ``docs`` that stay, with their columns, whatever these are named.

    As in ``near_classes`` texts without words are of one class, of repeated rows one stays, a
    null identifier stays only if its class has no other, and an empty table gives no rows.
    """
    kept = _classes(docs, similarity, id_col, text_col, keyed=True).filter("kept")
    return keep_rows(docs, kept, _keyed, id_col, text_col)

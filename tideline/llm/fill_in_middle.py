"""Fill-in-middle rearrangement of whole texts, and its exact inversion.

Two cuts split a text into prefix, middle and suffix. The text is copied once, into a byte
array; the sentinels are inserted at the cuts, and two neighbouring blocks are exchanged
in place by a rotation, which is three reversals. The inversion finds the sentinels, rotates
back and takes them out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.llm.common import slices, whole

PLAIN, PSM, SPM = "plain", "psm", "spm"
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


@dataclass(frozen=True)
class Layout:
    """How often texts are rearranged, in which order, and with which marks.

    ``rate`` of 100 texts are rearranged, ``spm_rate`` of 100 of those with the suffix
    first. No mark may be part of another.
    """

    seed: int = 42
    rate: int = 50
    spm_rate: int = 80
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"

    def __post_init__(self) -> None:
        marks = (self.prefix, self.suffix, self.middle)
        for i, a in enumerate(marks):
            for j, b in enumerate(marks):
                if not a or (i != j and a in b):
                    raise ValueError(f"Marks must be different and not empty: {marks}")
                # A mark that begins as another ends could be read across their border.
                if any(a.endswith(b[:k]) for k in range(1, min(len(a), len(b)))):
                    raise ValueError(f"Marks must not overlap: {marks}")

    @property
    def marks(self) -> tuple[bytes, bytes, bytes]:
        return self.prefix.encode(), self.suffix.encode(), self.middle.encode()

    def draws(self, key: str) -> tuple[int, int, int, int]:
        """Four numbers below 2**32 that depend on seed and identifier only."""
        hexed = hashlib.sha256(f"{self.seed}:{key}".encode()).hexdigest()
        return tuple(int(hexed[k : k + 8], 16) for k in (0, 8, 16, 24))


def rotate(buffer: bytearray, start: int, border: int, end: int) -> None:
    """Exchange the blocks before and after ``border``, by three reversals."""
    for a, b in ((start, border), (border, end), (start, end)):
        buffer[a:b] = buffer[a:b][::-1]


def rearrange(text: bytes, first: int, second: int, form: str, layout: Layout) -> bytearray:
    """The text with its cuts at two byte positions, in the order of ``form``."""
    prefix, suffix, middle = layout.marks
    out = bytearray(text)
    out[second:second] = suffix
    out[first:first] = middle
    out[0:0] = prefix
    # prefix, middle, suffix, each behind its mark
    at_middle = len(prefix) + first
    at_suffix = at_middle + len(middle) + second - first
    rotate(out, at_middle if form == PSM else 0, at_suffix, len(out))
    return out


def invert(output: bytes, form: str, layout: Layout) -> bytes:
    """The text that ``rearrange`` was given; a plain output is the text itself."""
    if form not in (PSM, SPM):
        return output
    prefix, suffix, middle = layout.marks
    out = bytearray(output)
    size = len(out)
    at_middle = out.index(middle)
    if form == PSM:
        block = out.index(suffix)
        rotate(out, block, at_middle, size)
        at_suffix, at_middle = size - (at_middle - block), block
    else:
        block = out.index(prefix)
        rotate(out, 0, block, size)
        at_suffix, at_middle = size - block, at_middle - block
    del out[at_suffix : at_suffix + len(suffix)]
    del out[at_middle : at_middle + len(middle)]
    del out[: len(prefix)]
    return bytes(out)


class Units:
    """Units of texts that lie one after the other: white space with the word after it.

    White space that ends a text is a unit of its own. Only ASCII white space counts, so
    positions are found in the bytes.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray) -> None:
        space = _SPACE[data]
        ends = ~space
        ends[:-1] &= space[1:]
        # The last byte of a text that isn't space ends a word, whatever text follows.
        last = offsets[1:][np.diff(offsets) > 0] - 1
        ends[last] = ~space[last]
        self.ends = np.flatnonzero(ends) + 1
        self.offsets = offsets
        edges = np.searchsorted(self.ends, offsets, side="right")
        self.before, self.words = edges[:-1], np.diff(edges)
        trailing = np.zeros(len(self.words), "i8")
        trailing[np.diff(offsets) > 0] = space[last]
        self.counts = self.words + trailing

    def position(self, text: int, units: int) -> int:
        """Bytes of a text's first units."""
        if units == 0:
            return 0
        if units > self.words[text]:
            return int(self.offsets[text + 1] - self.offsets[text])
        return int(self.ends[self.before[text] + units - 1] - self.offsets[text])


def _arranged(keys: Sequence, texts: pa.Array, layout: Layout) -> tuple[list, ...]:
    """n, form, prefix_chars, middle_chars and output of a run of texts."""
    texts = texts.cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], "i8")[texts.offset :][: len(texts) + 1]
    buffer = texts.buffers()[2]
    data = np.frombuffer(buffer, "u1") if buffer else np.empty(0, "u1")
    data, offsets = data[offsets[0] : offsets[-1]], offsets - offsets[0]
    units = Units(data, offsets)
    forms, prefixes, middles, outputs = [], [], [], []
    for i, key in enumerate(keys):
        body = data[offsets[i] : offsets[i + 1]]
        text = body.tobytes()
        n = int(units.counts[i])
        h1, h2, h3, h4 = layout.draws("" if key is None else str(key))
        if not text or h3 % 100 >= layout.rate or any(mark in text for mark in layout.marks):
            forms.append(PLAIN)
            prefixes.append(None)
            middles.append(None)
            outputs.append(text)
            continue
        cuts = sorted((h1 % (n + 1), h2 % (n + 1)))
        first, second = (units.position(i, k) for k in cuts)
        form = SPM if h4 % 100 < layout.spm_rate else PSM
        begins = (body & 0xC0) != 0x80
        forms.append(form)
        prefixes.append(int(np.count_nonzero(begins[:first])))
        middles.append(int(np.count_nonzero(begins[first:second])))
        outputs.append(bytes(rearrange(text, first, second, form, layout)))
    return units.counts.tolist(), forms, prefixes, middles, outputs


ADDED = [
    T.StructField("n", T.LongType()),
    T.StructField("form", T.StringType()),
    T.StructField("prefix_chars", T.LongType()),
    T.StructField("middle_chars", T.LongType()),
    T.StructField("output", T.StringType()),
]


def _mapped(df: DataFrame, text_col: str, key_col: str, change, added: list[T.StructField]):
    """``df`` without the text column, and ``added`` after it, from the texts and keys.

    Columns go by position, so their names don't matter; one with the name of an added
    column is replaced by it.
    """
    taken = {f.name.lower() for f in added} | {text_col.lower()}
    kept = [f for f in df.schema.fields if f.name.lower() not in taken]
    names = [f"c{i}" for i in range(len(kept) + len(added))]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 0):
            out = change(batch.column(0), batch.column(1))
            yield pa.RecordBatch.from_arrays([*batch.columns[2:], *out], names)

    rows = df.select(
        whole(f"`{text_col}`").alias("text"),
        F.col(f"`{key_col}`").alias("key"),
        *(F.col(f"`{f.name}`").alias(f"c{i}") for i, f in enumerate(kept)),
    )
    fields = [*kept, *added]
    plain = [T.StructField(n, f.dataType) for n, f in zip(names, fields, strict=True)]
    return rows.mapInArrow(run, T.StructType(plain)).toDF(*(f.name for f in fields))


def fill_in_middle(
    docs: DataFrame,
    layout: Layout | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per input row: its other columns, n, form, prefix_chars, middle_chars, output.

    ``n`` counts units (see ``Units``). The draws depend on seed and identifier, so the
    result doesn't depend on the partitioning. Defined cases: a null text counts as empty;
    an empty text and one that holds a mark stay plain, and plain texts have null lengths;
    a null identifier draws like an empty one; rows with the same identifier draw the
    same cuts; repeated rows stay; a text of any length is one copy of itself; an empty
    table gives no rows. A column with the name of a result is replaced.
    """
    layout = layout or Layout()

    def change(texts: pa.Array, keys: pa.Array) -> list[pa.Array]:
        n, forms, prefixes, middles, outputs = _arranged(keys.to_pylist(), texts, layout)
        return [
            pa.array(n, pa.int64()),
            pa.array(forms, pa.string()),
            pa.array(prefixes, pa.int64()),
            pa.array(middles, pa.int64()),
            pa.array(outputs, pa.binary()).cast(pa.string()),
        ]

    return _mapped(docs, text_col, id_col, change, ADDED)


def restore(
    rows: DataFrame,
    layout: Layout | None = None,
    form_col: str = "form",
    output_col: str = "output",
    text_col: str = "text",
) -> DataFrame:
    """``rows`` with the original text instead of the output, from output and form alone.

    A null or unknown form counts as plain, a null output as empty. An output whose marks
    were removed is an error.
    """
    layout = layout or Layout()

    def change(outputs: pa.Array, forms: pa.Array) -> list[pa.Array]:
        pairs = zip(outputs.cast(pa.binary()).to_pylist(), forms.to_pylist(), strict=True)
        texts = [invert(output, form, layout) for output, form in pairs]
        return [pa.array(texts, pa.binary()).cast(pa.string())]

    return _mapped(rows, output_col, form_col, change, [T.StructField(text_col, T.StringType())])

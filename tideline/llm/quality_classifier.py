"""Quality classifier on random-indexing word vectors.

Every word and every word shape has a sparse random index vector. The vector of a word is
the sum of the index vectors of its neighbours in all texts. A document is the
mean of its words' vectors, of their index vectors and of those of their shapes, with its
length and the share of different words. A network of two layers, in numpy, turns that
into a logit; a temperature fitted on rows the network did not see makes it a probability.

Word vectors need no labels: they are summed over every whole text, in whole numbers, by
task and then in a tree, so that they are the same in any order. The network learns from a
sample of labelled rows whose size is a parameter. Scoring looks at every text in place.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import map_rows, partitions, slices, stored
from tideline.llm.words import Words, chunks, mix, words

WORDS, SHAPES, SIZE, SIGNS = 1 << 15, 1 << 11, 32, 4
REACH = 2
FOLDS = 5


def held_out(id_col: str) -> Column:
    """Rows never learned from: crc32 of the identifier as text is divisible by five."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % FOLDS == 0


def index_vectors(count: int, salt: int) -> np.ndarray:
    """Sparse vectors of +1 and -1, the same in every process."""
    out = np.zeros((count, SIZE), dtype="f4")
    rows = np.arange(count)
    for k in range(SIGNS):
        bits = mix(np.arange(count, dtype="u8") + np.uint64((salt * SIGNS + k + 1) << 32))
        out[rows, (bits >> np.uint64(1)) % np.uint64(SIZE)] += np.where(bits & np.uint64(1), 1, -1)
    return out


WORD_INDEX, SHAPE_INDEX = index_vectors(WORDS, 0), index_vectors(SHAPES, 1)


def _buckets(found: Words) -> tuple[np.ndarray, np.ndarray]:
    return (
        (found.hashes % np.uint64(WORDS)).astype("i8"),
        (found.shapes % np.uint64(SHAPES)).astype("i8"),
    )


def context_sums(texts: list[str | None]) -> np.ndarray:
    """Sum of the neighbours' index vectors by word, within texts."""
    total = np.zeros((WORDS, SIZE), dtype="f8")
    for _, part in chunks(texts):
        found = words(part, shapes=True)
        at, shape = _buckets(found)
        text = np.repeat(np.arange(len(part)), found.counts)
        index = WORD_INDEX[at] + SHAPE_INDEX[shape]
        near = np.zeros_like(index)
        for d in range(1, REACH + 1):
            same = (text[d:] == text[:-d])[:, None] if len(text) > d else np.empty((0, 1), bool)
            near[d:] += index[:-d] * same
            near[:-d] += index[d:] * same
        order = np.argsort(at, kind="stable")
        if len(order):
            cuts = np.flatnonzero(np.diff(at[order], prepend=-1))
            total[at[order][cuts]] += np.add.reduceat(near[order], cuts, axis=0)
    return total


#: Tables that are added in one place of the tree.
FAN_IN = 8


def _packed(total: np.ndarray) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress(total.astype("<i8").tobytes())


def _table_sums(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's texts to one table of sums; the sums are whole numbers."""
    total = np.zeros((WORDS, SIZE), dtype="f8")
    for batch in slices(batches, 0):
        total += context_sums(batch.column(0).to_pylist())
    yield pa.RecordBatch.from_pydict({"sums": pa.array([_packed(total)], pa.binary())})


def _added(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Several tables to their sum, one at a time."""
    import zstandard

    total = np.zeros(WORDS * SIZE, dtype="i8")
    some = False
    for batch in batches:
        for raw in batch.column(batch.num_columns - 1):
            total += np.frombuffer(zstandard.ZstdDecompressor().decompress(raw.as_py()), "<i8")
            some = True
    if some:
        yield pa.RecordBatch.from_pydict({"sums": pa.array([_packed(total)], pa.binary())})


def corpus_sums(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Context sums over all texts: a table of fixed size per task, added in a tree.

    The driver gets one table. Null and empty texts have no words; repeated rows count as
    often as they occur; an empty table gives zeros.
    """
    import zstandard

    text = docs.select(F.col(f"`{text_col}`").alias("text"))
    tables = text.mapInArrow(_table_sums, "sums binary")
    places = partitions(docs.sparkSession)
    at = F.pmod(F.spark_partition_id(), F.lit(places))
    while True:
        tables = tables.select(at.cast("int").alias("place"), "sums").repartitionById(places, F.col("place"))
        tables = tables.mapInArrow(_added, "sums binary")
        if places == 1:
            break
        places = -(-places // FAN_IN)
        at = F.pmod(F.spark_partition_id(), F.lit(places))
    total = np.zeros((WORDS, SIZE), dtype="f8")
    for row in tables.collect():
        raw = zstandard.ZstdDecompressor().decompress(row.sums)
        total += np.frombuffer(raw, "<i8").reshape(WORDS, SIZE)
    return total


def word_vectors(sums: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(sums, axis=1, keepdims=True)
    return (sums / np.maximum(norms, 1e-9)).astype("f4")


def features(texts: list[str | None], vectors: np.ndarray) -> np.ndarray:
    """One row per text; a text without words has zeros."""
    out = np.zeros((len(texts), 3 * SIZE + 5), dtype="f4")
    table = np.concatenate([vectors, WORD_INDEX], axis=1)
    for first, part in chunks(texts):
        found = words(part, shapes=True)
        some = np.flatnonzero(found.counts)
        if not len(some):
            continue
        at, shape = _buckets(found)
        starts, n = found.starts[some], found.counts[some]
        rows = first + some
        pooled = np.add.reduceat(table[at], starts, axis=0) / n[:, None]
        shapes = np.add.reduceat(SHAPE_INDEX[shape], starts, axis=0) / n[:, None]
        text = np.repeat(np.arange(len(some)), n)
        key = mix(found.hashes + text.astype("u8") * np.uint64(0x9E3779B97F4A7C15))
        order = np.argsort(key, kind="stable")
        new = np.ones(len(key), dtype=bool)
        new[1:] = key[order][1:] != key[order][:-1]
        distinct = np.bincount(text[order][new], minlength=len(some))
        out[rows, : 2 * SIZE] = pooled
        out[rows, 2 * SIZE : 3 * SIZE] = shapes
        out[rows, 3 * SIZE] = np.log1p(n)
        out[rows, 3 * SIZE + 1] = distinct / n
        out[rows, 3 * SIZE + 2] = np.linalg.norm(pooled[:, :SIZE], axis=1)
        out[rows, 3 * SIZE + 3] = np.linalg.norm(pooled[:, SIZE:], axis=1)
        out[rows, 3 * SIZE + 4] = np.linalg.norm(shapes, axis=1)
    return out


#: Scaled features end here: a text of one repeated word lies far out in every direction.
CLIP = 4.0


def _scaled(x: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    return np.clip((x - mean) / scale, -CLIP, CLIP)


@dataclass
class Network:
    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float

    def logits(self, x: np.ndarray) -> np.ndarray:
        hidden = np.tanh(_scaled(x, self.mean, self.scale) @ self.w1 + self.b1)
        return hidden @ self.w2 + self.b2

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -30, 30)))


def _loss(logits: np.ndarray, y: np.ndarray) -> float:
    return float(np.mean(np.logaddexp(0, logits) - y * logits))


def train(
    x: np.ndarray, y: np.ndarray, hidden: int = 32, epochs: int = 60, steps: int = 4000,
    rate: float = 3e-3, decay: float = 1e-4, seed: int = 7,
) -> Network:
    """Adam on the log loss of four fifths of the rows; the others set the temperature.

    ``epochs`` passes, or more for few rows, until ``steps`` are done.
    """
    rng = np.random.default_rng(seed)
    x = x.astype("f8")
    order = rng.permutation(len(y))
    cal, fit = order[: len(y) // 5], order[len(y) // 5 :]
    mean, scale = x[fit].mean(0), x[fit].std(0) + 1e-6
    z = _scaled(x, mean, scale)
    p = {
        "w1": rng.normal(0, 1 / np.sqrt(z.shape[1]), (z.shape[1], hidden)),
        "b1": np.zeros(hidden),
        "w2": rng.normal(0, 1 / np.sqrt(hidden), hidden),
        "b2": np.zeros(1),
    }
    m = {k: np.zeros_like(v) for k, v in p.items()}
    v2 = {k: np.zeros_like(v) for k, v in p.items()}
    step = 0
    for _ in range(max(epochs, -(-steps * 64 // max(1, len(fit))))):
        rng.shuffle(fit)
        for at in range(0, len(fit), 64):
            rows = fit[at : at + 64]
            h = np.tanh(z[rows] @ p["w1"] + p["b1"])
            error = (1 / (1 + np.exp(-np.clip(h @ p["w2"] + p["b2"], -30, 30))) - y[rows]) / len(rows)
            back = np.outer(error, p["w2"]) * (1 - h * h)
            grads = {
                "w1": z[rows].T @ back + decay * p["w1"],
                "b1": back.sum(0),
                "w2": h.T @ error + decay * p["w2"],
                "b2": np.array([error.sum()]),
            }
            step += 1
            for k, g in grads.items():
                m[k] = 0.9 * m[k] + 0.1 * g
                v2[k] = 0.999 * v2[k] + 0.001 * g * g
                p[k] = p[k] - rate * (m[k] / (1 - 0.9**step)) / (
                    np.sqrt(v2[k] / (1 - 0.999**step)) + 1e-8
                )
    net = Network(mean, scale, p["w1"], p["b1"], p["w2"], float(p["b2"][0]), 1.0)
    if len(cal):
        logits = net.logits(x[cal])
        options = np.exp(np.linspace(np.log(0.25), np.log(8), 61))
        net.temperature = float(min(options, key=lambda t: _loss(logits / t, y[cal])))
    return net


@dataclass
class Classifier:
    vectors: np.ndarray
    network: Network | None

    def scores(self, texts: list[str | None]) -> np.ndarray:
        """Probability of label 1; one half where nothing could be learned."""
        if self.network is None:
            return np.full(len(texts), 0.5)
        return self.network.probabilities(features(texts, self.vectors))


def fit_classifier(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    sample_rows: int = 8000,
) -> Classifier:
    """Word vectors from all texts, a network from ``sample_rows`` labelled ones not held out.

    The sample is the rows with the smallest hash of their identifier, and is learned from
    whole. Word vectors and features are computed by tasks; the driver gets their sums
    and one feature row per sampled row. Labels that repeat for an identifier count once,
    the lowest; null labels and identifiers are left out. With rows of one label only,
    or none, nothing is learned.
    """
    chosen = (
        labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
        .filter(~held_out(id_col))
        .groupBy(F.col(id_col).alias("label_id"))
        .agg(F.min(label_col).alias("label"))
        .orderBy(F.xxhash64("label_id"), "label_id")
        .limit(sample_rows)
    )
    sample = stored(
        docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
        .join(F.broadcast(chosen), F.col("id") == F.col("label_id"))
        .select("id", "label", "text")
        .repartition(8, "id"),
        "quality-sample",
    )

    vectors = word_vectors(corpus_sums(docs, text_col))

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2):
            found = features(batch.column(2).to_pylist(), vectors)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1).cast(pa.float64()),
                    pa.array([r.tobytes() for r in found], pa.binary()),
                ],
                ["id", "label", "x"],
            )

    got = sample.select(F.col("id").cast("string"), "label", "text").mapInArrow(
        rows, "id string, label double, x binary"
    )
    got = sorted(got.collect(), key=lambda r: (r.id, r.label, r.x))
    y = np.array([float(r.label > 0) for r in got])
    if len(set(y)) < 2:
        return Classifier(vectors, None)
    return Classifier(vectors, train(np.array([np.frombuffer(r.x, "f4") for r in got]), y))


def score(
    docs: DataFrame, model: Classifier, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per input row: identifier and score; a null text scores as an empty one."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            found = model.scores(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found)], ["id", "score"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "id long, score double").withColumnRenamed("id", id_col)


def keep_good(
    docs: DataFrame,
    labels: DataFrame,
    threshold: float = 0.3,
    sample_rows: int = 8000,
    text_col: str = "text",
) -> DataFrame:
    """The rows of ``docs`` whose score reaches the threshold, with all their columns.

    Rows are scored where they are, without a join, so null and repeated identifiers
    need no rule.
    """
    model = fit_classifier(docs, labels, text_col=text_col, sample_rows=sample_rows)
    place = docs.columns.index(text_col)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, place):
            good = model.scores(batch.column(place).to_pylist()) >= threshold
            yield batch.filter(pa.array(good))

    return map_rows(docs, run)

"""Quality scores by a factorisation machine.

A document's features are its hashed words (tf-idf-free: log counts, scaled to length 1), statistics of
its structure (lengths, repeats, capitals, symbols, lines) and its metadata (the stated number of
characters, and how far it is from the real one). The machine adds to a linear model the interaction of
every pair of features, through a vector of ``RANK`` numbers per feature; by the identity
sum over pairs <v_i, v_j> x_i x_j = (|sum v_i x_i|^2 - sum |v_i x_i|^2) / 2 a text is scored in time linear in its features.

It is fitted on at most ``TRAIN_ROWS`` labelled rows (those with the least hash of their id), never on
held-out ones. Their features are a table; each round sums the gradient over its partitions, so only
arrays of the model's fixed size reach the driver. doc_id, lang, source and labels are never features.

Defined results: null and empty texts have a score of their own, that of their statistics; a null or
negative n_chars counts as the real length; rows are scored one by one, so repeats score alike; a null
doc_id counts as held out; null labels teach nothing, and of an id labelled twice the higher label counts;
without labels every score is 0.5. A text is one row of one task, however long. Other columns are kept;
one named ``_score`` is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldguard.llm import words as W
from fieldguard.llm.toxicity import is_held_out
from fieldguard.session import settle

TRAIN_ROWS, THRESHOLD = 10_000, 0.7
BUCKETS, RANK, ROUNDS = 1 << 14, 6, 60
_PIECE, _PARTS = 2 << 20, 8
_SYMBOLS = b"#$%&*|!^~<>=@\\{}[]_+/`"
_STATISTICS = (
    "bytes", "words", "word length", "distinct words", "top word", "same word again", "capitals", "digits", "punctuation",
    "symbols", "words ending in a symbol", "words without letters", "lines a word", "repeated lines", "beyond ASCII",
    "longest word", "stated length", "stated length apart",
)
WIDTH = len(_STATISTICS)


def _set(chars: bytes) -> np.ndarray:
    found = np.zeros(256, bool)
    found[list(chars)] = True
    return found


_UPPER, _LOWER_CASE, _DIGIT = _set(bytes(range(65, 91))), _set(bytes(range(97, 123))), _set(b"0123456789")
_PUNCTUATION, _SYMBOL, _NEWLINE = _set(b".,;:?'\"()-"), _set(_SYMBOLS), _set(b"\n")
_HIGH, _FOLLOWING = np.arange(256) >= 0x80, (np.arange(256) & 0xC0) == 0x80


def _distinct(doc: np.ndarray, value: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each text: how many distinct values, and how often its most frequent one."""
    key = W.mix(value + doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, first, count = np.unique(key, return_index=True, return_counts=True)
    most = np.zeros(texts, np.int64)
    np.maximum.at(most, doc[first], count)
    return np.bincount(doc[first], minlength=texts), most


@dataclass
class Features:
    """Words as (row, bucket, value), rows in order; statistics as a matrix, not scaled yet."""

    row: np.ndarray
    bucket: np.ndarray
    value: np.ndarray
    statistics: np.ndarray


def features(batch: pa.RecordBatch) -> Features:
    """Of the columns text and n_chars."""
    data, offsets = W.text_arrays(batch.column("text"))
    texts = len(offsets) - 1
    found = W.find_words(data, offsets, W.SPACED, W.LOWER)
    n_words, n_bytes = found.counts.astype(float), np.diff(offsets).astype(float)

    def of_bytes(kind: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(kind[data], dtype=np.int64)])
        return (sums[offsets[1:]] - sums[offsets[:-1]]).astype(float)

    def of_words(mask: np.ndarray) -> np.ndarray:
        return np.bincount(found.doc[mask], minlength=texts).astype(float)

    each, per_word, per_byte = found.end - found.start, np.maximum(n_words, 1), np.maximum(n_bytes, 1)
    distinct, top = _distinct(found.doc, found.hash, texts)
    again = np.zeros(len(found.doc), bool)
    again[1:] = (found.hash[1:] == found.hash[:-1]) & (found.doc[1:] == found.doc[:-1])
    lettered = np.concatenate([[0], np.cumsum((_LOWER_CASE | _HIGH)[found.data], dtype=np.int64)])
    lines = W.find_words(data, offsets, ~_NEWLINE)
    distinct_lines, _ = _distinct(lines.doc, lines.hash, texts)
    upper, lower = of_bytes(_UPPER), of_bytes(_LOWER_CASE)
    longest = np.zeros(texts)
    np.maximum.at(longest, found.doc, each)
    n_chars = n_bytes - of_bytes(_FOLLOWING)
    stated = pc.fill_null(batch.column("n_chars").cast(pa.float64()), -1.0).to_numpy(zero_copy_only=False)
    stated = np.where(np.isfinite(stated) & (stated >= 0), stated, n_chars)
    statistics = np.stack(
        [
            np.log1p(n_bytes), np.log1p(n_words), np.bincount(found.doc, each, minlength=texts) / per_word,
            distinct / per_word, top / per_word, of_words(again) / per_word, upper / np.maximum(upper + lower, 1),
            of_bytes(_DIGIT) / per_byte, of_bytes(_PUNCTUATION) / per_byte, of_bytes(_SYMBOL) / per_byte,
            of_words(_SYMBOL[found.data[found.end - 1]] if len(each) else np.zeros(0, bool)) / per_word,
            of_words(lettered[found.end] == lettered[found.start]) / per_word, of_bytes(_NEWLINE) / per_word,
            (lines.counts - distinct_lines) / np.maximum(lines.counts, 1), of_bytes(_HIGH) / per_byte, np.log1p(longest),
            np.log1p(stated), np.log1p(stated) - np.log1p(n_chars),
        ],
        axis=1,
    )
    pairs, count = np.unique(found.doc * BUCKETS + (found.hash % np.uint64(BUCKETS)).astype(np.int64), return_counts=True)
    row, value = pairs // BUCKETS, np.log1p(count)
    length = np.sqrt(np.bincount(row, value**2, minlength=texts))
    return Features(row, pairs % BUCKETS, value / length[row], statistics)


@dataclass
class Machine:
    """Weights of buckets and statistics (in this order), with the scale of the statistics."""

    bias: float
    weights: np.ndarray  # BUCKETS + WIDTH
    vectors: np.ndarray  # BUCKETS + WIDTH, RANK
    mean: np.ndarray
    spread: np.ndarray

    @classmethod
    def blank(cls, mean: np.ndarray, spread: np.ndarray, bias: float, seed: int = 7) -> Machine:
        size = BUCKETS + WIDTH
        vectors = np.random.default_rng(seed).normal(0, 0.05, (size, RANK))
        return cls(bias, np.zeros(size), vectors, mean, spread)

    def inputs(self, x: Features) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All features as (row, place, value)."""
        scaled = np.clip((x.statistics - self.mean) / self.spread, -4, 4) / np.sqrt(WIDTH)
        texts = len(scaled)
        row = np.concatenate([x.row, np.repeat(np.arange(texts), WIDTH)])
        place = np.concatenate([x.bucket, np.tile(np.arange(BUCKETS, BUCKETS + WIDTH), texts)])
        return row, place, np.concatenate([x.value, scaled.ravel()])

    def sums(self, row, place, value, texts: int) -> tuple[np.ndarray, np.ndarray]:
        """The machine's value of each text, and its sums of vectors, in time linear in the features."""
        total = self.bias + np.bincount(row, self.weights[place] * value, minlength=texts)
        vectors = np.stack(
            [np.bincount(row, self.vectors[place, f] * value, minlength=texts) for f in range(RANK)], axis=1
        )
        own = np.bincount(row, (self.vectors**2).sum(axis=1)[place] * value**2, minlength=texts)
        return total + ((vectors**2).sum(axis=1) - own) / 2, vectors

    def scores(self, x: Features) -> np.ndarray:
        made, _ = self.sums(*self.inputs(x), len(x.statistics))
        return 1 / (1 + np.exp(-np.clip(made, -30, 30)))

    def gradient(self, x: Features, label: np.ndarray) -> np.ndarray:
        """Of the log loss added up over the rows: bias, weights and vectors in one array."""
        row, place, value = self.inputs(x)
        made, vectors = self.sums(row, place, value, len(label))
        wrong = 1 / (1 + np.exp(-np.clip(made, -30, 30))) - label
        each, size = wrong[row] * value, len(self.weights)
        own = np.bincount(place, each * value, minlength=size)
        steps = [
            np.bincount(place, each * vectors[row, f], minlength=size) - own * self.vectors[:, f] for f in range(RANK)
        ]
        weights = np.bincount(place, each, minlength=size)
        return np.concatenate([[wrong.sum()], weights, np.stack(steps, axis=1).ravel()])

    def flat(self) -> np.ndarray:
        return np.concatenate([[self.bias], self.weights, self.vectors.ravel()])

    def moved(self, flat: np.ndarray) -> Machine:
        size = len(self.weights)
        return Machine(float(flat[0]), flat[1 : 1 + size], flat[1 + size :].reshape(size, RANK), self.mean, self.spread)


def training_sample(labels: DataFrame, limit: int = TRAIN_ROWS) -> DataFrame:
    """doc_id, quality of at most ``limit`` labelled rows that are not held out."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
    known = known.where(~is_held_out(F.col("doc_id")))
    one = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("quality").alias("quality"))
    return one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in W.pieces(batches, limit=_PIECE):
        x = features(batch)
        cuts = pa.array(np.searchsorted(x.row, np.arange(batch.num_rows + 1)), pa.int32())
        yield pa.RecordBatch.from_arrays(
            [
                pa.ListArray.from_arrays(cuts, pa.array(x.bucket, pa.int32())),
                pa.ListArray.from_arrays(cuts, pa.array(x.value, pa.float32())),
                pa.FixedSizeListArray.from_arrays(pa.array(x.statistics.ravel(), pa.float64()), WIDTH).cast(pa.list_(pa.float64())),
                batch.column("label"),
            ],
            names=["buckets", "values", "statistics", "label"],
        )


def _read(batch: pa.RecordBatch) -> tuple[Features, np.ndarray]:
    sizes = pc.list_value_length(batch.column("buckets")).to_numpy()
    flat = [batch.column(c).flatten().to_numpy() for c in ("buckets", "values", "statistics")]
    row = np.repeat(np.arange(batch.num_rows), sizes)
    x = Features(row, flat[0].astype(np.int64), flat[1].astype(float), flat[2].reshape(-1, WIDTH))
    return x, batch.column("label").to_numpy().astype(float)


def _gradients(machine):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1)
        for batch in batches:
            total = total + machine.value.gradient(*_read(batch))
        if len(total) > 1:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["gradient"])

    return run


def fit(taught: DataFrame, rounds: int = ROUNDS, decay: float = 0.02, rate: float = 0.05) -> Machine:
    """``taught``: a settled table of buckets, values, statistics, label. Adam with a ridge on all rows at once."""
    sc = taught.sparkSession.sparkContext
    at = [F.element_at("statistics", i + 1) for i in range(WIDTH)]
    told = taught.agg(
        F.count("*"), F.avg("label"), *[F.avg(c) for c in at], *[F.stddev_pop(c) for c in at]
    ).first()
    rows, share = told[0], told[1]
    if not rows:
        return Machine.blank(np.zeros(WIDTH), np.ones(WIDTH), 0.0).moved(np.zeros(1 + (BUCKETS + WIDTH) * (1 + RANK)))
    share = min(max(share, 1e-3), 1 - 1e-3)
    mean, spread = np.array(told[2 : 2 + WIDTH]), np.array(told[2 + WIDTH :])
    machine = Machine.blank(mean, np.where(spread > 1e-9, spread, 1.0), float(np.log(share / (1 - share))))
    flat = machine.flat()
    first, second = np.zeros_like(flat), np.zeros_like(flat)
    for step in range(1, rounds + 1):
        sent = sc.broadcast(machine)
        parts = taught.mapInArrow(_gradients(sent), "gradient binary").collect()  # one of the model's size a task
        sent.destroy()
        gradient = sum(np.frombuffer(r[0]) for r in parts) / rows + decay / np.sqrt(rows) * flat
        gradient[0] -= decay / np.sqrt(rows) * flat[0]
        first, second = 0.9 * first + 0.1 * gradient, 0.99 * second + 0.01 * gradient**2
        flat = flat - rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
        machine = machine.moved(flat)
    return machine


def train(docs: DataFrame, labels: DataFrame, limit: int = TRAIN_ROWS, rounds: int = ROUNDS) -> Machine:
    """Fit on the labelled documents of the sample."""
    sample = F.broadcast(settle(training_sample(labels, limit)))  # at most ``limit`` small rows
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "n_chars").join(sample, "doc_id")
    rows = texts.select("text", "n_chars", (F.col("quality") == 1).cast("int").alias("label"))
    schema = "buckets array<int>, values array<float>, statistics array<double>, label int"
    return fit(settle(rows.mapInArrow(_featured, schema).repartition(_PARTS)), rounds)


def score(docs: DataFrame, machine: Machine) -> DataFrame:
    """Adds (or replaces) ``_score`` in rows with the columns text and n_chars; other columns are kept."""
    docs = docs.drop("_score")
    sent = docs.sparkSession.sparkContext.broadcast(machine)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.pieces(batches, limit=_PIECE):
            scores = sent.value.scores(features(batch))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(scores, pa.float64())], names=[*batch.schema.names, "_score"]
            )

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("_score", T.DoubleType())]))


def score_documents(
    docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, limit: int = TRAIN_ROWS, rounds: int = ROUNDS
) -> DataFrame:
    """doc_id, held_out, score, predicted (1 at ``threshold`` and over)."""
    machine = train(docs, labels, limit, rounds)
    return score(docs.select("doc_id", "text", "n_chars"), machine).select(
        "doc_id",
        is_held_out(F.col("doc_id")).alias("held_out"),
        F.col("_score").alias("score"),
        (F.col("_score") >= threshold).cast("int").alias("predicted"),
    )

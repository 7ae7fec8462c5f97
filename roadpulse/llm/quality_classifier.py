"""Quality classifier: a factorisation machine over hashed words and structure statistics.

score = sigmoid(w0 + sum w_i x_i + sum over pairs <v_i, v_j> x_i x_j); the pairs are summed in linear
time as half of (sum v_i x_i)^2 - sum (v_i x_i)^2. The words' entries are their shares in the text;
the structure statistics and the text's length are entries of their own. Language, source and id are
never inputs.

Labels are learnt from a bounded sample (``SAMPLE_ROWS``) of the labelled rows outside the held-out
fold; everything else covers all rows. Null and empty texts get the score of a text without words. A
null id is scored and counts as not held out. With labels of one kind only, every text scores alike for that
kind; without any label, 0.5. Repeated rows are scored one by one; labels that repeat
or contradict each other are learnt once each. Only id and text are read from the documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.llm import tokens
from roadpulse.llm.features import Rows, held_out, smallest_hashes, word_frequencies
from roadpulse.llm.quality_rules import base_statistics
from roadpulse.llm.shared import arrow_rows, by_batch

#: Labelled rows that are learnt from, at most.
SAMPLE_ROWS = 6000
COLUMNS = 1 << 14
FACTORS = 6
EPOCHS = 8
FOLDS, FOLD = 3, 1
_STATISTICS = 9
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_MARK = np.zeros(256, bool)
_MARK[list(b".,;:!?|/\\")] = True
SCORES = "doc_id long, held_out boolean, score double, predicted int"


def entries(data: np.ndarray, bounds: np.ndarray) -> Rows:
    """Sparse inputs of several texts: words first, then the statistics."""
    found = tokens.words(data, bounds)
    words = word_frequencies(found, COLUMNS)
    base = base_statistics(data, bounds, found)
    size = np.maximum(np.diff(bounds), 1)
    number = np.maximum(found.counts, 1)

    def share(flags: np.ndarray) -> np.ndarray:
        return tokens.sums_by(flags.astype(np.int64), np.diff(bounds)) / size

    lines = tokens.sums_by((data == 10).astype(np.int64), np.diff(bounds)) + 1
    dense = np.stack(
        [
            np.ones(len(size)),
            np.minimum(4 * base["n_symbols"] / number, 4),
            2 * base["n_repeat_words"] / number,
            2 * base["n_dup_lines"] / lines,
            base["word_chars"] / number / 8,
            np.log1p(found.counts) / 5,
            4 * share(_UPPER[data]),
            4 * share(_DIGIT[data]),
            4 * share(_MARK[data]),
        ],
        axis=1,
    )
    counts = words.counts + _STATISTICS
    column = np.empty(counts.sum(), np.int64)
    value = np.empty(counts.sum())
    word = tokens.ranges(counts) < np.repeat(words.counts, counts)
    column[word], value[word] = words.column, 10 * words.value
    column[~word] = np.tile(COLUMNS + np.arange(_STATISTICS), len(size))
    value[~word] = dense.ravel()
    return Rows(column, value, counts)


@dataclass
class FactorisationMachine:
    bias: float
    linear: np.ndarray
    factors: np.ndarray

    def raw(self, rows: Rows) -> np.ndarray:
        both = rows.dot(self.factors)
        squares = Rows(rows.column, rows.value**2, rows.counts).dot(self.factors**2)
        return self.bias + rows.dot(self.linear) + 0.5 * (both**2 - squares).sum(axis=1)

    def score(self, rows: Rows) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(rows), -30, 30)))

    def packed(self) -> bytes:
        return np.concatenate(([self.bias], self.linear, self.factors.ravel())).astype("<f8").tobytes()

    @classmethod
    def unpacked(cls, data: bytes) -> FactorisationMachine:
        flat = np.frombuffer(data, "<f8")
        columns = (len(flat) - 1) // (1 + FACTORS)
        return cls(float(flat[0]), flat[1 : columns + 1], flat[columns + 1 :].reshape(columns, FACTORS))


def fitted(rows: Rows, label: np.ndarray, epochs: int = EPOCHS, rate: float = 0.1, decay: float = 1e-6) -> FactorisationMachine:
    """Adaptive gradient descent on the logistic loss, both labels weighing the same."""
    columns = COLUMNS + _STATISTICS
    random = np.random.default_rng(7)
    model = FactorisationMachine(0.0, np.zeros(columns), random.normal(0, 0.02, (columns, FACTORS)))
    if not len(label) or label.min() == label.max():
        model.factors[:] = 0  # one label, or none: every text has the same score
        model.bias = 2.0 if len(label) and label[0] else -2.0 if len(label) else 0.0
        return model
    weight = np.where(label == 1, 0.5 / label.mean(), 0.5 / (1 - label.mean()))
    seen_linear, seen_factors = np.full(columns, 1e-6), np.full((columns, FACTORS), 1e-6)
    for _ in range(epochs):
        for part in np.array_split(random.permutation(len(label)), max(1, len(label) // 128)):
            batch = rows.take(part)
            both = batch.dot(model.factors)
            slope = weight[part] * (model.score(batch) - label[part]) / len(part)
            gradient = batch.spread(slope, columns) + decay * model.linear
            seen_linear += gradient**2
            model.linear -= rate * gradient / np.sqrt(seen_linear)
            squares = Rows(batch.column, batch.value**2, batch.counts).spread(slope, columns)
            for k in range(FACTORS):
                g = batch.spread(slope * both[:, k], columns) - squares * model.factors[:, k]
                seen_factors[:, k] += g**2
                model.factors[:, k] -= 0.5 * rate * g / np.sqrt(seen_factors[:, k])
            model.bias -= rate * slope.sum()
    return model


def learnt(documents: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> FactorisationMachine:
    """Learn from a bounded sample of the labelled rows outside the held-out fold, in one task."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    known = known.where("doc_id is not null and quality in (0, 1)").where(~held_out("doc_id", FOLDS, FOLD)).distinct()
    sample = F.broadcast(smallest_hashes(known, sample_rows))  # at most ``sample_rows`` small rows
    chosen = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(sample, "doc_id")

    def prepare(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for row, end, data, bounds in tokens.slices(batch.column(1)):
            found = entries(data, bounds)
            cuts = np.cumsum(found.counts)[:-1]
            column = [x.astype("<i4").tobytes() for x in np.split(found.column, cuts)]
            value = [x.astype("<f4").tobytes() for x in np.split(found.value, cuts)]
            yield arrow_rows({"doc_id": batch.column(0).slice(row, end - row), "quality": batch.column(2).slice(row, end - row), "column": pa.array(column, pa.binary()), "value": pa.array(value, pa.binary())})

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches), pa.schema([("doc_id", pa.int64()), ("quality", pa.int32()), ("column", pa.binary()), ("value", pa.binary())]))
        table = table.sort_by([("doc_id", "ascending"), ("quality", "ascending")])
        column = [np.frombuffer(x, "<i4") for x in table.column("column").to_pylist()]
        value = [np.frombuffer(x, "<f4") for x in table.column("value").to_pylist()]
        none = np.zeros(0)
        rows = Rows(np.concatenate([none.astype(np.int64), *column]), np.concatenate([none, *value]), np.array([len(x) for x in column], np.int64))
        yield arrow_rows({"model": pa.array([fitted(rows, table.column("quality").to_numpy()).packed()], pa.binary())})

    prepared = chosen.mapInArrow(by_batch(prepare), "doc_id long, quality int, column binary, value binary")
    models = prepared.repartition(1).mapInArrow(fit, "model binary").collect()
    return FactorisationMachine.unpacked(models[0].model) if models else fitted(Rows(np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64)), np.zeros(0))


def quality_scores(documents: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """One row per document: whether held out, score and predicted label."""
    model = documents.sparkSession.sparkContext.broadcast(learnt(documents, labels, sample_rows))

    def score(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for row, end, data, bounds in tokens.slices(batch.column(2)):
            found = model.value.score(entries(data, bounds))
            part = batch.slice(row, end - row)
            yield arrow_rows({"doc_id": part.column(0), "held_out": part.column(1), "score": found, "predicted": (found >= 0.5).astype(np.int32)})

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out = F.coalesce(held_out("doc_id", FOLDS, FOLD), F.lit(False))
    return rows.select("doc_id", out.alias("held_out"), "text").mapInArrow(by_batch(score), SCORES)

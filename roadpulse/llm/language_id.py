"""Hierarchical language identification.

Linear support vector machines over hashed letter n-grams: one for each family against the others
decides the family, then one for each pair of languages within it votes. Which language belongs to
which family is a parameter; a language that isn't listed is a family of its own.

Only text and language of rows outside the held-out fold are learnt from: of each language a bounded
sample (``SAMPLE_ROWS``), everything else covers all rows. A null text, or one without a letter, is
``und`` with score 0; so is every text when there is nothing to learn. A null id is predicted and
counts as not held out. Repeated rows are predicted one by one. Only id, text and lang are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadpulse.llm import tokens
from roadpulse.llm.features import Rows, held_out
from roadpulse.llm.shared import arrow_rows, by_batch

#: Texts of each language that are learnt from, at most.
SAMPLE_ROWS = 500
#: Languages that are learnt, the most frequent ones; others are never predicted.
MOST_LANGUAGES = 256
FOLDS, FOLD = 4, 2
BITS = 15
UNKNOWN = "und"
EPOCHS = 12
#: Languages by family.
FAMILIES = {
    "germanic": ("da", "de", "en", "nl", "no", "sv"),
    "romance": ("ca", "es", "fr", "it", "pt", "ro"),
    "slavic": ("bg", "cs", "pl", "ru", "sk", "uk"),
}
PREDICTED = "doc_id long, held_out boolean, lang_pred string, score double"
_FOLD = tokens.LOWER.copy()
_FOLD[[c for c in range(128) if not chr(c).isalpha()]] = 32


def gram_columns(data: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Hashed columns of the byte n-grams (two and three) of each text, and how many each text has.

    Letters are lower-cased (A-Z); any other ASCII character counts as a space.
    """
    folded = _FOLD[data].astype(np.uint32)
    size = np.diff(bounds)
    for n in (2, 3):
        code = np.zeros(max(len(folded) - n + 1, 0), np.uint32)
        for i in range(n):
            code |= folded[i : i + len(code)] << np.uint32(8 * i)
        code *= np.uint32(0x9E3779B1)
        column = (code >> np.uint32(32 - BITS)).astype(np.int32) + np.int32((n - 2) << BITS)
        counts = np.maximum(size - n + 1, 0)
        inside = np.ones(len(code), bool)
        for end in bounds[1:-1].tolist():
            inside[max(end - n + 1, 0) : end] = False
        yield column[inside], counts


def entries(data: np.ndarray, bounds: np.ndarray) -> Rows:
    """N-gram shares of each text; the shares of each order sum to one."""
    column, value, row = [], [], []
    for at, counts in gram_columns(data, bounds):
        text = np.repeat(np.arange(len(counts)), counts)
        keys, number = np.unique(text << (BITS + 1) | at, return_counts=True)
        row.append(keys >> (BITS + 1))
        column.append(keys & ((2 << BITS) - 1))
        value.append(number / counts[row[-1]])
    rows = np.concatenate(row)
    order = np.argsort(rows, kind="stable")
    return Rows(np.concatenate(column)[order], np.concatenate(value)[order], np.bincount(rows, minlength=len(bounds) - 1))


@dataclass
class Hierarchy:
    """Weights of all machines in one table, one column each."""

    languages: list[str]
    families: list[list[int]]
    pairs: list[tuple[int, int]]
    weights: np.ndarray  # columns: families, then pairs
    bias: np.ndarray

    def margins(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        total = np.tile(self.bias, (len(bounds) - 1, 1))
        for column, counts in gram_columns(data, bounds):
            for k in range(self.weights.shape[1]):
                total[:, k] += tokens.sums_by(self.weights[column, k], counts) / np.maximum(counts, 1)
        return total

    def predicted(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the language and a score between 0 and 1."""
        families = len(self.families)
        best = np.argmax(margins[:, :families], axis=1)
        sure = 1 / (1 + np.exp(-2 * margins[np.arange(len(margins)), best]))
        language, score = np.zeros(len(margins), np.int64), sure.copy()
        for f, members in enumerate(self.families):
            rows = np.flatnonzero(best == f)
            votes = np.zeros((len(rows), len(members)))
            total = np.zeros_like(votes)
            for k, (a, b) in enumerate(self.pairs):
                if a in members:
                    m = margins[rows, families + k]
                    for side, sign in ((members.index(a), 1), (members.index(b), -1)):
                        votes[:, side] += sign * m >= 0 if sign > 0 else -m > 0
                        total[:, side] += sign * m
            chosen = np.argmax(votes + np.tanh(total) / 4, axis=1)  # equal votes: by margin
            language[rows] = np.array(members)[chosen]
            if len(members) > 1:
                score[rows] *= 1 / (1 + np.exp(-2 * total[np.arange(len(rows)), chosen] / (len(members) - 1)))
        return language, np.clip(score, 0, 1)


def _machine(rows: Rows, sign: np.ndarray, columns: int) -> tuple[np.ndarray, float]:
    """A linear support vector machine by averaged stochastic gradient descent on the hinge loss."""
    random = np.random.default_rng(11)
    weights, average, bias, bias_average, seen = np.zeros(columns), np.zeros(columns), 0.0, 0.0, np.full(columns, 1e-8)
    balance = np.where(sign > 0, 0.5 / max((sign > 0).mean(), 1e-9), 0.5 / max((sign < 0).mean(), 1e-9))
    steps = 0
    for _ in range(EPOCHS):
        for part in np.array_split(random.permutation(len(sign)), max(1, len(sign) // 32)):
            batch = rows.take(part)
            inside = sign[part] * (batch.dot(weights) + bias) < 1
            slope = -np.where(inside, sign[part] * balance[part], 0.0) / len(part)
            gradient = batch.spread(slope, columns) + 1e-7 * weights
            seen += gradient**2
            weights -= 0.5 * gradient / np.sqrt(seen)
            bias -= 0.05 * slope.sum()
            steps += 1
            average += (weights - average) / steps
            bias_average += (bias - bias_average) / steps
    return average, bias_average


def _fitted(rows: Rows, label: np.ndarray, languages: list[str], family_of: dict[str, str]) -> Hierarchy:
    columns = 2 << BITS
    names = sorted({family_of.get(x, f"only {x}") for x in languages})
    families = [[i for i, x in enumerate(languages) if family_of.get(x, f"only {x}") == name] for name in names]
    machines = []
    for members in families:
        sign = np.where(np.isin(label, members), 1.0, -1.0)
        machines.append(_machine(rows, sign, columns) if len(families) > 1 else (np.zeros(columns), 1.0))
    pairs = [pair for members in families for pair in combinations(members, 2)]
    for a, b in pairs:
        chosen = np.flatnonzero((label == a) | (label == b))
        machines.append(_machine(rows.take(chosen), np.where(label[chosen] == a, 1.0, -1.0), columns))
    return Hierarchy(languages, families, pairs, np.stack([w for w, _ in machines], axis=1).astype(np.float32), np.array([b for _, b in machines]))


_MODEL = "languages array<string>, families array<array<long>>, pairs array<array<long>>, weights binary, bias binary"


def sampled(documents: DataFrame, sample_rows: int = SAMPLE_ROWS, most_languages: int = MOST_LANGUAGES) -> DataFrame:
    """(doc_id, lang) of at most ``sample_rows`` labelled documents of each of the most frequent languages."""
    known = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"))
    known = known.where("doc_id is not null and lang is not null").where(~held_out("doc_id", FOLDS, FOLD))
    # the hash is even, so about twice the sample passes before any shuffle and no language fills the window's task
    counts = known.groupBy("lang").agg(F.count(F.lit(1)).alias("_n")).orderBy(F.desc("_n"), "lang").limit(most_languages)
    share = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) * F.col("_n") < F.lit(2 * sample_rows + 100) * (1 << 20)
    known = known.join(F.broadcast(counts), "lang").where(share)
    ranked = known.withColumn("_rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)), "doc_id")))
    return ranked.where(F.col("_rank") <= sample_rows).select("doc_id", "lang").distinct()


def learnt(documents: DataFrame, sample_rows: int = SAMPLE_ROWS, families: dict[str, tuple[str, ...]] | None = None) -> Hierarchy | None:
    """Learn in one task from at most ``sample_rows`` texts of each language."""
    family_of = {language: name for name, members in (families or FAMILIES).items() for language in members}
    sample = F.broadcast(sampled(documents, sample_rows))
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("lang").cast("string").alias("lang"))
    chosen = texts.where("text is not null").join(sample, ["doc_id", "lang"])

    def prepare(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for row, end, data, bounds in tokens.slices(batch.column(2)):
            found = entries(data, bounds)
            cuts = np.cumsum(found.counts)[:-1]
            column, value = (pa.array([x.astype(t).tobytes() for x in np.split(v, cuts)], pa.binary()) for v, t in ((found.column, "<i4"), (found.value, "<f4")))
            part = batch.slice(row, end - row)
            yield arrow_rows({"doc_id": part.column(0), "lang": part.column(1), "column": column, "value": value})

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches), pa.schema([("doc_id", pa.int64()), ("lang", pa.string()), ("column", pa.binary()), ("value", pa.binary())]))
        if not table.num_rows:
            return
        table = table.sort_by([("doc_id", "ascending"), ("lang", "ascending")])
        column = [np.frombuffer(x, "<i4") for x in table.column("column").to_pylist()]
        value = np.concatenate([np.frombuffer(x, "<f4") for x in table.column("value").to_pylist()])
        languages, label = np.unique(table.column("lang").to_pylist(), return_inverse=True)
        rows = Rows(np.concatenate(column), value, np.array([len(x) for x in column], np.int64))
        model = _fitted(rows, label, languages.tolist(), family_of)
        kinds = (pa.list_(pa.string()), pa.list_(pa.list_(pa.int64())), pa.list_(pa.list_(pa.int64())), pa.binary(), pa.binary())
        values = (model.languages, model.families, [list(p) for p in model.pairs], model.weights.tobytes(), model.bias.tobytes())
        yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, kinds, strict=True)], [x.split()[0] for x in _MODEL.split(", ")])

    prepared = chosen.select("doc_id", "lang", "text").mapInArrow(by_batch(prepare), "doc_id long, lang string, column binary, value binary")
    found = prepared.repartition(1).mapInArrow(fit, _MODEL).collect()
    if not found:
        return None
    m = found[0]
    bias = np.frombuffer(m.bias, "<f8")
    return Hierarchy(m.languages, m.families, [tuple(p) for p in m.pairs], np.frombuffer(m.weights, "<f4").reshape(-1, len(bias)), bias)


def languages(documents: DataFrame, sample_rows: int = SAMPLE_ROWS, families: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """One row per document: whether held out, predicted language and score."""
    model = documents.sparkSession.sparkContext.broadcast(learnt(documents, sample_rows, families))

    def predict(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        known = model.value
        lettered = pc.fill_null(pc.match_substring_regex(batch.column(2), r"\p{L}"), False).to_numpy(zero_copy_only=False)
        for row, end, data, bounds in tokens.slices(batch.column(2)):
            part, sayable = batch.slice(row, end - row), lettered[row:end]
            if known is None:
                name, score = [UNKNOWN] * (end - row), np.zeros(end - row)
            else:
                language, score = known.predicted(known.margins(data, bounds))
                name = [known.languages[i] if ok else UNKNOWN for i, ok in zip(language.tolist(), sayable, strict=True)]
                score = np.where(sayable, score, 0.0)
            yield arrow_rows({"doc_id": part.column(0), "held_out": part.column(1), "lang_pred": pa.array(name, pa.string()), "score": score})

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out = F.coalesce(held_out("doc_id", FOLDS, FOLD), F.lit(False))
    return rows.select("doc_id", out.alias("held_out"), "text").mapInArrow(by_batch(predict), PREDICTED)

"""Sparse rows with numpy, for the classifiers."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.llm import tokens


@dataclass
class Rows:
    """Sparse rows one after another: column and value of each entry, entries of each row."""

    column: np.ndarray
    value: np.ndarray
    counts: np.ndarray

    @property
    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def take(self, rows: np.ndarray) -> Rows:
        ends = np.cumsum(self.counts)
        size = self.counts[rows]
        at = np.repeat(ends[rows] - size, size) + tokens.ranges(size)
        return Rows(self.column[at], self.value[at], size)

    def dot(self, weights: np.ndarray) -> np.ndarray:
        """Each row times the weights (one or more columns of them)."""
        value = self.value if weights.ndim == 1 else self.value[:, None]
        return tokens.sums_by(weights[self.column] * value, self.counts)

    def spread(self, factor: np.ndarray, columns: int) -> np.ndarray:
        """Sum over rows of factor times row."""
        return np.bincount(self.column, factor[self.row] * self.value, columns)


def word_frequencies(found: tokens.Words, columns: int) -> Rows:
    """Share of each hashed word among the words of its text."""
    text = found.text
    keys, counts = np.unique(text * columns + (found.hash >> np.uint64(20)).astype(np.int64) % columns, return_counts=True)
    row = keys // columns
    return Rows(keys % columns, counts / np.maximum(found.counts[row], 1), np.bincount(row, minlength=len(found.counts)))


def held_out(column: str, folds: int, fold: int):
    """Whether crc32 of the id as text leaves this remainder."""
    return F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(folds)) == fold


def smallest_hashes(ids: DataFrame, rows: int) -> DataFrame:
    """A bounded sample that only depends on the ids: those with the smallest hashes."""
    return ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)

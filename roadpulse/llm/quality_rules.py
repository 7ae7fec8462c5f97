"""Quality rules: base statistics and a hashed n-gram log-likelihood ratio with a fixed threshold.

Two multinomials over hashed word n-grams (one and two words) are counted, one over the trusted
documents and one over the whole corpus. A document's score is the mean, over its n-grams, of the
log ratio of the two; documents below ``threshold`` are rejected, as are those failing the base rules.

Null and empty texts have no words: they fail the base rules and their score is 0. Repeated rows are
rows of their own. Only the id and the text are read, so further columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.llm import tokens
from roadpulse.llm.shared import arrow_rows, by_batch, key_filter

BUCKETS = 1 << 18
ORDERS = (1, 2)
#: Trusted and expected counts are raised by this much, so that n-grams seen a few times say little.
SMOOTHING = 4.0
THRESHOLD = -0.25
MIN_WORDS = 10
REPEAT_PERCENT = 20
_CHUNK = 1 << 12
_SYMBOL = ~tokens.separators(b"#*$%&|<>")
_HEAD = (np.arange(256) & 0xC0) != 0x80
_LINE = tokens.separators(b"\n")

SCORED = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long,"
    " base_failed boolean, kept boolean, score double"
)


def _totals(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    return tokens.sums_by(flags.astype(np.int64), np.diff(bounds))


def _twice(text: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For (text, hash) pairs: index of the first of each kind, kind of each pair, size of each kind."""
    keys = tokens.mix(hashes + tokens.mix(text.astype(np.uint64)))
    _, first, kind, size = np.unique(keys, return_index=True, return_inverse=True, return_counts=True)
    return first, kind, size


def base_statistics(data: np.ndarray, bounds: np.ndarray, found: tokens.Words) -> dict[str, np.ndarray]:
    texts = len(bounds) - 1
    inside = tokens.WHITE[data]
    start, end = tokens.spans(_LINE[data], bounds)
    line_words = np.searchsorted(found.start, end) - np.searchsorted(found.start, start)
    start, end = start[line_words > 0], end[line_words > 0]
    line_text = np.searchsorted(bounds, start, "right") - 1
    first, _, _ = _twice(line_text, tokens.hash_spans(data, start, end))
    dup_lines = np.bincount(line_text, minlength=texts) - np.bincount(line_text[first], minlength=texts)
    at, hashes = tokens.grams(found, 5)
    _, kind, size = _twice(found.text[at], hashes)
    again = at[size[kind] > 1] if len(at) else at
    edge = np.zeros(len(found.hash) + 6, np.int64)
    np.add.at(edge, again, 1)
    np.add.at(edge, again + 5, -1)
    covered = np.cumsum(edge)[: len(found.hash)] > 0
    return {
        "n_words": found.counts,
        "word_chars": _totals(inside & _HEAD[data], bounds),
        "n_symbols": _totals(_SYMBOL[data], bounds),
        "n_dup_lines": dup_lines,
        "n_repeat_words": tokens.sums_by(covered.astype(np.int64), found.counts),
    }


def _buckets(found: tokens.Words, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each n-gram order: hash buckets in text order, and how many each text has."""
    for n in ORDERS:
        at, hashes = tokens.grams(found, n)
        yield (hashes >> np.uint64(40)).astype(np.int64) % buckets, np.maximum(found.counts - n + 1, 0)


def _counts(texts: DataFrame, buckets: int) -> np.ndarray:
    """N-gram counts by bucket over all rows; each task sends one vector, cut in chunks."""
    size = min(_CHUNK, buckets)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, _, data, bounds in tokens.slices(batch.column(0)):
                for bucket, _ in _buckets(tokens.words(data, bounds), buckets):
                    total += np.bincount(bucket, minlength=buckets)
        if total.any():
            yield arrow_rows({"chunk": np.arange(buckets // size), "n": pa.array([x.tobytes() for x in total.reshape(-1, size)])})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, part in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                held[chunk] = held.get(chunk, 0) + np.frombuffer(part, np.int64)
        if held:
            yield arrow_rows({"chunk": pa.array(list(held), pa.int64()), "n": pa.array([x.tobytes() for x in held.values()])})

    rows = texts.mapInArrow(count, "chunk long, n binary").repartition(F.col("chunk")).mapInArrow(add, "chunk long, n binary")
    whole = np.zeros(buckets, np.int64)
    for chunk, part in rows.collect():  # ``buckets`` numbers, whatever the input
        whole[chunk * size : (chunk + 1) * size] = np.frombuffer(part, np.int64)
    return whole


def log_ratios(documents: DataFrame, trusted: DataFrame, buckets: int = BUCKETS, smoothing: float = SMOOTHING) -> np.ndarray:
    """log(trusted / corpus) of each bucket; ``trusted`` holds the ids of trusted documents."""
    texts = documents.select("doc_id", "text").where("text is not null")
    ids = trusted.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id is not null").distinct()
    maybe = key_filter(ids)

    def likely(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        rows = batch.filter(pc.is_valid(batch.column(0)))
        yield rows.filter(pa.array(maybe.value.may_hold(rows.column(0).to_numpy())))

    chosen = texts.mapInArrow(by_batch(likely), "doc_id long, text string").join(ids.hint("merge"), "doc_id", "left_semi")  # ids grow with the input
    raw, target = _counts(texts.select("text"), buckets), _counts(chosen.select("text"), buckets)
    if not target.any():
        return np.zeros(buckets)
    # counts that the trusted part of the corpus would have if it were like the whole
    expected = raw * (target.sum() / raw.sum())
    return np.log((target + smoothing) / (expected + smoothing))


def score_texts(column: pa.Array, ratios: np.ndarray, threshold: float = THRESHOLD) -> Iterator[tuple[int, int, dict]]:
    for row, end, data, bounds in tokens.slices(column):
        found = tokens.words(data, bounds)
        out = base_statistics(data, bounds, found)
        total, number = np.zeros(end - row), np.zeros(end - row, np.int64)
        for bucket, counts in _buckets(found, len(ratios)):
            total += tokens.sums_by(ratios[bucket], counts)
            number += counts
        score = total / np.maximum(number, 1)
        failed = (out["n_words"] < MIN_WORDS) | (100 * out["n_repeat_words"] > REPEAT_PERCENT * out["n_words"])
        yield row, end, out | {"base_failed": failed, "kept": ~failed & (score >= threshold), "score": score}


def quality_rules(documents: DataFrame, trusted: DataFrame, threshold: float = THRESHOLD, buckets: int = BUCKETS) -> DataFrame:
    """One row per document: base statistics, score and verdict."""
    ratios = documents.sparkSession.sparkContext.broadcast(log_ratios(documents, trusted, buckets))

    def score(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for row, end, out in score_texts(batch.column(1), ratios.value, threshold):
            yield arrow_rows({"doc_id": batch.column(0).slice(row, end - row), **out})

    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(by_batch(score), SCORED)


def filtered(documents: DataFrame, trusted: DataFrame, threshold: float = THRESHOLD, buckets: int = BUCKETS) -> DataFrame:
    """The documents that are kept, with all their columns; verdicts are made where the text is."""
    ratios = documents.sparkSession.sparkContext.broadcast(log_ratios(documents, trusted, buckets))
    at = documents.columns.index("text")

    def keep(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for row, end, out in score_texts(batch.column(at), ratios.value, threshold):
            yield batch.slice(row, end - row).filter(pa.array(out["kept"]))

    return documents.mapInArrow(by_batch(keep), documents.schema)

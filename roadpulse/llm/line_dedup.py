"""Line dedup by distinct-site spread: lines that appear on many sites are cross-site boilerplate.

Each line's sites are gathered in a HyperLogLog sketch; sketches merge by aggregation. Lines whose
estimate lies near the threshold get an exact distinct count. A line found on at least ``min_sites``
sites stays only in the document with the smallest id that has it.

A line is a run between line feeds that holds a word; lines are equal when their bytes are. Rows with
a null text have no lines, a null source is no site, and a null id owns no line (its row stays as it
is). Rows that repeat an id and text are cut alike. Only id, text and source are read from the input;
further columns may have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.llm import tokens
from roadpulse.llm.shared import arrow_rows, by_batch, key_filter, stored

MIN_SITES = 10
#: Estimates within this share of the threshold are counted exactly.
MARGIN = 0.3
SKETCH_BITS = 11
_LINE = tokens.separators(b"\n")


def lines_of(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """First row of a slice; row in the slice, number within its text and hash of each line."""
    for row, _, data, bounds in tokens.slices(column):
        feeds = np.concatenate(([0], np.cumsum(~_LINE[data])))
        start, end = tokens.spans(_LINE[data], bounds)
        inside = np.concatenate(([0], np.cumsum(tokens.WHITE[data])))
        worded = inside[end] > inside[start]
        start, end = start[worded], end[worded]
        text = np.searchsorted(bounds, start, "right") - 1
        yield row, text, feeds[start] - feeds[bounds[text]], tokens.hash_spans(data, start, end)


def _sites(documents: DataFrame, only=None) -> DataFrame:
    """(line, site, first document) once per batch; ``only`` is a broadcast filter of lines."""

    def rows(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        batch = batch.filter(pc.and_(batch.column(0).is_valid(), batch.column(1).is_valid()))
        ids, site = batch.column(0).to_numpy(), pc.dictionary_encode(batch.column(2))
        codes = pc.fill_null(site.indices, -1).to_numpy()
        parts = [(hashes, row + text) for row, text, _, hashes in lines_of(batch.column(1))]
        if not parts:
            return
        line, at = (np.concatenate(x) for x in zip(*parts, strict=True))
        if only is not None:
            held = only.value.may_hold(line)
            line, at = line[held], at[held]
        order = np.lexsort((ids[at], codes[at], line))
        line, at = line[order], at[order]
        new = np.ones(len(line), bool)
        new[1:] = (line[1:] != line[:-1]) | (codes[at][1:] != codes[at][:-1])
        line, at = line[new], at[new]
        yield arrow_rows({"line": tokens.signed(line), "site": batch.column(2).take(pa.array(at)), "doc": ids[at]})

    chosen = documents.select(F.col("doc_id").cast("long"), "text", F.col("source").cast("string"))
    return chosen.mapInArrow(by_batch(rows), "line long, site string, doc long")


def boilerplate(documents: DataFrame, min_sites: int = MIN_SITES, margin: float = MARGIN) -> DataFrame:
    """(line, first): hashes of the lines on at least ``min_sites`` sites, and who keeps them."""
    sketched = (
        _sites(documents)
        .groupBy("line")
        .agg(F.hll_sketch_agg("site", F.lit(SKETCH_BITS)).alias("sketch"), F.min("doc").alias("first"))
        .select("line", "first", F.hll_sketch_estimate("sketch").alias("sites"))
        .where(F.col("sites") >= int(min_sites * (1 - margin)))
    )
    sketched = stored(sketched, "line-sites")
    near = F.col("sites") <= min_sites * (1 + margin)
    close = sketched.where(near).select("line")
    exact = (
        _sites(documents, key_filter(close))
        .join(close, "line", "left_semi")
        .groupBy("line", "site")
        .agg(F.min("doc").alias("doc"))
        .groupBy("line")
        .agg(F.count("site").alias("sites"), F.min("doc").alias("first"))
        .where(F.col("sites") >= min_sites)
    )
    return stored(sketched.where(~near).select("line", "first").unionByName(exact.select("line", "first")), "boilerplate")


def _key(text: str) -> F.Column:
    return F.xxhash64(F.col(text))


def cuts(documents: DataFrame, lines: DataFrame) -> DataFrame:
    """(doc_id, key, cut): numbers of the lines to remove, by document and hash of its text."""
    held = key_filter(lines.select("line"))

    def rows(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        batch = batch.filter(batch.column(0).is_valid())
        for row, text, number, hashes in lines_of(batch.column(1)):
            maybe = held.value.may_hold(hashes)
            at = pa.array(row + text[maybe])
            yield arrow_rows({"doc_id": batch.column(0).take(at), "key": batch.column(2).take(at), "number": number[maybe].astype(np.int32), "line": tokens.signed(hashes[maybe])})

    found = documents.select(F.col("doc_id").cast("long"), "text", _key("text").alias("key")).mapInArrow(
        by_batch(rows), "doc_id long, key long, number int, line long"
    )
    found = found.join(lines, "line").where("doc_id <> first")
    return stored(found.groupBy("doc_id", "key").agg(F.collect_set("number").alias("cut")), "line-cuts")


def _applied(documents: DataFrame, removed: DataFrame, same, cut, schema) -> DataFrame:
    """Rows made of the documents that lose nothing and of those that may lose lines.

    ``same`` and ``cut`` make a batch from a batch; that for ``cut`` has the column ``cut``. Only the
    texts of documents that may lose lines are shuffled, and each task runs one Python worker.
    """
    touched = key_filter(removed.select("key"))
    keyed = documents.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("doc_id"), _key("text").alias("key"))

    def part(batch: pa.RecordBatch, wanted: bool) -> pa.RecordBatch:
        return batch.filter(pa.array(touched.value.may_hold(batch.column(2).to_numpy()) == wanted))

    def untouched(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        yield same(part(batch, False))

    def maybe(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        yield part(batch, True)

    def rebuilt(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        yield cut(batch)

    joined = keyed.mapInArrow(by_batch(maybe), keyed.schema).join(removed.hint("merge"), ["doc_id", "key"], "left").select("row", "doc_id", "key", "cut")
    return keyed.mapInArrow(by_batch(untouched), schema).unionByName(joined.mapInArrow(by_batch(rebuilt), schema))


def _left(text: str | None, cut: list[int] | None) -> str | None:
    if not cut:
        return text
    gone = frozenset(cut)
    return "\n".join(x for i, x in enumerate(text.split("\n")) if i not in gone)


def deduplicated(documents: DataFrame, min_sites: int = MIN_SITES, margin: float = MARGIN) -> DataFrame:
    """The documents with the cut lines gone, all columns kept. ``n_chars``, if there, is counted anew;
    documents of which no word is left go."""
    removed = cuts(documents, boilerplate(documents, min_sites, margin))
    names = documents.columns

    def same(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_struct_array(batch.column(0))

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows, gone = pa.RecordBatch.from_struct_array(batch.column(0)), batch.column(3).to_pylist()
        texts = [_left(t, c) for t, c in zip(rows.column("text").to_pylist(), gone, strict=True)]
        keep = [not c or t.strip(" \t\n\x0b\x0c\r") != "" for t, c in zip(texts, gone, strict=True)]
        columns = {n: rows.column(n) for n in names} | {"text": pa.array(texts, pa.string())}
        if "n_chars" in columns:
            sizes = [None if t is None else len(t) if c else n for t, c, n in zip(texts, gone, columns["n_chars"].to_pylist(), strict=True)]
            columns["n_chars"] = pa.array(sizes, rows.schema.field("n_chars").type)
        return arrow_rows(columns).filter(pa.array(keep, pa.bool_()))

    return _applied(documents, removed, same, cut, documents.schema)


def line_dedup(documents: DataFrame, min_sites: int = MIN_SITES, margin: float = MARGIN) -> DataFrame:
    """One row per document: lines with a word, lines removed, digest of the text that is left."""
    documents = documents.select("doc_id", "text", "source")
    removed = cuts(documents, boilerplate(documents, min_sites, margin))

    def measured(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = pa.RecordBatch.from_struct_array(batch.column(0))
        gone = batch.column(3).to_pylist() if batch.num_columns > 3 else [None] * len(rows)
        lines = np.zeros(len(rows), np.int64)
        for row, text, _, _ in lines_of(rows.column("text")):
            np.add.at(lines, row + text, 1)
        left = [hashlib.sha256((_left(t, c) or "").encode()).hexdigest() for t, c in zip(rows.column("text").to_pylist(), gone, strict=True)]
        return arrow_rows({"doc_id": batch.column(1), "n_lines": lines, "n_removed": pa.array([len(c or ()) for c in gone], pa.int64()), "kept_sha256": pa.array(left, pa.string())})

    return _applied(documents, removed, measured, measured, "doc_id long, n_lines long, n_removed long, kept_sha256 string")

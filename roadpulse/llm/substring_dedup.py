"""Substring dedup with passage hashes and suffix automata of reference shards.

A window is ``window`` consecutive words of a text. A word is removed if it lies in a window whose
words also start somewhere in a document with a smaller id.

Every window has one anchor, the n-gram of least hash in it; equal windows have equal anchors. Only
anchors that two documents hold can lead to a removal. Around those lie the passages: the words, 13 to
16 of them, that the windows with that anchor can reach. Two ways lead to the spans that are removed:

* Whole equal passages (exact copies, the inside of every shared passage) are found by a hash of their
  words: a group-by keeps the smallest holder, and all later holders lose the passage by a join. No
  automaton sees those.
* Where an anchor has several distinct passages (at the edges of shared passages), each brings its windows once,
  from its smallest holder. Windows that several passages hold go to the shard that their words name, which has
  a bounded size; what streams through a shard is cut into parts, however many passages hold one window. A shard
  takes its windows in order of document: each is streamed through the suffix automaton of those of smaller
  documents, and spans that match at least ``window`` words are marked.

The named method, automata of all reference shards broadcast to all documents, would cost shards times
corpus; README has figures.

Null and empty texts have no words. A null id takes no part and keeps its words. Rows that repeat an
id and a text are cut alike. Only id and text are read, so further columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.llm import tokens
from roadpulse.llm.shared import arrow_rows, by_batch, key_filter, repeated, stored

WINDOW = 13
ANCHOR = 10
#: Passages of one anchor that make one shard; the windows of an anchor with more are dealt singly, about as many to a shard.
SHARD_PASSAGES = 3_750


class SuffixAutomaton:
    """Suffix automaton of several word sequences, for matching statistics."""

    def __init__(self) -> None:
        self.next: list[dict] = [{}]
        self.link = [-1]
        self.length = [0]
        self.words = 0

    def add(self, sequence: list) -> None:
        steps, link, length, last = self.next, self.link, self.length, 0
        self.words += len(sequence)
        for word in sequence:
            to = steps[last].get(word)
            if to is not None and length[to] == length[last] + 1:
                last = to
                continue
            if to is not None:
                last = self._copy(last, to, word)
                continue
            steps.append({})
            length.append(length[last] + 1)
            link.append(0)
            new, at = len(steps) - 1, last
            while at >= 0 and word not in steps[at]:
                steps[at][word] = new
                at = link[at]
            if at >= 0:
                to = steps[at][word]
                link[new] = to if length[to] == length[at] + 1 else self._copy(at, to, word)
            last = new

    def _copy(self, at: int, to: int, word) -> int:
        """A state for the shorter strings of ``to``."""
        self.next.append(dict(self.next[to]))
        self.length.append(self.length[at] + 1)
        self.link.append(self.link[to])
        new = len(self.next) - 1
        self.link[to] = new
        while at >= 0 and self.next[at].get(word) == to:
            self.next[at][word] = new
            at = self.link[at]
        return new

    def matches(self, sequence: list) -> list[int]:
        """For each word, how many words ending there match somewhere."""
        steps, link, length = self.next, self.link, self.length
        at = size = 0
        out = []
        for word in sequence:
            to = steps[at].get(word)
            while to is None and at:
                at = link[at]
                size = length[at]
                to = steps[at].get(word)
            if to is None:
                size = 0
            else:
                at, size = to, size + 1
            out.append(size)
        return out


def anchors(found: tokens.Words, window: int = WINDOW, n: int = ANCHOR) -> tuple[np.ndarray, ...]:
    """Text, place in the words, hash, first and last window (by first word) of each anchor."""
    at, hashes = tokens.grams(found, n)
    none = np.zeros(0, np.int64)
    width = window - n + 1
    if len(at) < width:
        return none, none, hashes[:0], none, none
    order = tokens.mix(hashes)
    text = found.text
    starts = np.flatnonzero(at[width - 1 :] == at[: len(at) - width + 1] + width - 1)
    starts = starts[text[at[starts]] == text[at[starts] + window - 1]]
    best = starts.copy()
    for i in range(1, width):
        best = np.where(order[starts + i] < order[best], starts + i, best)
    new = np.ones(len(best), bool)
    new[1:] = best[1:] != best[:-1]
    head = np.flatnonzero(new)
    tail = np.append(head[1:], len(best)) - 1
    place = at[best[head]]
    return text[place], place, hashes[best[head]], at[starts[head]], at[starts[tail]]


def _anchor_rows(documents: DataFrame) -> DataFrame:
    """(anchor, doc) once per batch and slice."""

    def rows(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for row, end, data, bounds in tokens.slices(batch.column(1)):
            text, _, hashes, _, _ = anchors(tokens.words(data, bounds))
            ids = batch.column(0).slice(row, end - row).to_numpy()
            yield arrow_rows({"anchor": tokens.signed(hashes), "doc": ids[text]})

    return documents.mapInArrow(by_batch(rows), "anchor long, doc long")


def _passages(found: tokens.Words, only) -> tuple[np.ndarray, ...]:
    """Text, anchor, name, first word, size and words (32-bit hashes) of the passages let through.

    A passage is known by a hash of its words; two passages with one anchor have ten equal words.
    """
    text, _, hashes, first, last = anchors(found)
    size = last - first + WINDOW
    words = found.hash[np.repeat(first, size) + tokens.ranges(size)]
    placed = tokens.mix(words + tokens.ranges(size).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    name = tokens.mix(tokens.sums_by(placed, size) + hashes)
    held = only(hashes, name)
    kept = words[np.repeat(held, size)] >> np.uint64(32)
    return text[held], hashes[held], name[held], first[held] - found.first[text[held]], size[held], kept.astype("<u4")


def _passage_rows(documents: DataFrame, only, schema: str, columns) -> DataFrame:
    """Rows made of the passages of each slice; ``columns`` gets the slice's rows and its passages."""

    def rows(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for row, end, data, bounds in tokens.slices(batch.column(1)):
            found = _passages(tokens.words(data, bounds), only)
            yield arrow_rows(columns(batch.slice(row, end - row), *found))

    return documents.mapInArrow(by_batch(rows), schema)


def _kinds(documents: DataFrame, shared) -> DataFrame:
    """(anchor, passage, doc, last, size): distinct passages, their first and last holder."""

    def columns(batch, text, anchor, name, start, size, words):
        doc = batch.column(0).to_numpy()[text]
        once = np.unique(tokens.mix(name) + doc.view(np.uint64), return_index=True)[1]
        return {"anchor": tokens.signed(anchor[once]), "passage": tokens.signed(name[once]), "doc": doc[once], "size": size[once].astype(np.int32)}

    rows = _passage_rows(documents, lambda anchor, name: shared.value.may_hold(anchor), "anchor long, passage long, doc long, size int", columns)
    return rows.groupBy("anchor", "passage").agg(F.min("doc").alias("doc"), F.max("doc").alias("last"), F.min("size").alias("size"))


def _words_of(documents: DataFrame, kinds: DataFrame) -> DataFrame:
    """(anchor, doc, passage, words) of the given kinds, taken from their first holders."""
    wanted = key_filter(kinds.select("passage"))

    def columns(batch, text, anchor, name, start, size, words):
        doc = batch.column(0).to_numpy()[text]
        once = np.unique(tokens.mix(name) + doc.view(np.uint64), return_index=True)[1]
        ends = np.cumsum(size)
        cut = [words[e - n : e].tobytes() for e, n in zip(ends[once].tolist(), size[once].tolist(), strict=True)]
        return {"passage": tokens.signed(name[once]), "doc": doc[once], "words": pa.array(cut, pa.binary())}

    rows = _passage_rows(documents, lambda anchor, name: wanted.value.may_hold(name), "passage long, doc long, words binary", columns)
    return rows.join(kinds.select("anchor", "passage", "doc"), ["passage", "doc"]).select("anchor", "doc", "passage", "words")


def _places(documents: DataFrame, marks: DataFrame) -> DataFrame:
    """(passage, doc_id, key, start) of every place of a marked passage."""
    wanted = key_filter(marks.select("passage"))

    def columns(batch, text, anchor, name, start, size, words):
        take = pa.array(text)
        return {"passage": tokens.signed(name), "doc_id": batch.column(0).take(take), "key": batch.column(2).take(take), "start": start.astype(np.int32)}

    return _passage_rows(documents, lambda anchor, name: wanted.value.may_hold(name), "passage long, doc_id long, key long, start int", columns)


class _Shard:
    """The words seen so far of one shard; as shards are of a bounded size, so is the automaton."""

    def __init__(self) -> None:
        self.automaton = SuffixAutomaton()
        self.waiting: list[list] = []
        self.owner = None

    def upto(self, doc: int) -> None:
        """Let the automaton have the words of documents smaller than ``doc``."""
        if doc != self.owner:
            for sequence in self.waiting:
                self.automaton.add(sequence)
            self.waiting, self.owner = [], doc

    def windows(self, words: list) -> list[int]:
        """First words of the windows that smaller documents hold."""
        return [end - WINDOW + 1 for end, size in enumerate(self.automaton.matches(words)) if size >= WINDOW]


def _windows(passages: DataFrame) -> DataFrame:
    """(doc, passage, at, words): the single windows of passages; ``at`` is a window's first word."""
    at = F.explode(F.sequence(F.lit(0), (F.length("words") / 4).cast("int") - WINDOW)).alias("at")
    return passages.select("doc", "passage", "words", at).withColumn("words", F.expr(f"substring(words, 4 * at + 1, {4 * WINDOW})"))


def _shards(passages: DataFrame) -> DataFrame:
    """(shard, part, doc, passage, at, words) of the passages' windows that several of them hold.

    A window goes to the shard that its own words name. A shard's references are the windows with
    several holders, once each for the smallest; what streams through it is cut into parts, and each
    part has the references. Rows are at most about twice the windows, however many holders one has.
    """
    windows = _windows(passages)
    held = windows.groupBy("words").agg(F.min("doc").alias("doc"), F.max("doc").alias("last"), F.count(F.lit(1)).alias("n"))
    held = stored(held.where("doc < last").select("words", "doc", "n"), "shared-windows")
    shard = F.pmod(F.xxhash64("words"), F.lit(max(1, -(-held.count() // SHARD_PASSAGES)))).alias("shard")
    parts = held.groupBy(shard).agg(F.ceil(F.sum("n") / SHARD_PASSAGES).cast("int").alias("parts"))
    parts = stored(parts, "shard-parts")
    wanted = key_filter(held.select(F.xxhash64("words")))

    def several(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        yield batch.filter(pa.array(wanted.value.may_hold(batch.column(0).to_numpy())))

    streamed = windows.select(F.xxhash64("words").alias("name"), "doc", "passage", "at", "words")
    streamed = streamed.mapInArrow(by_batch(several), streamed.schema).withColumn("shard", shard).join(parts, "shard")
    streamed = streamed.select("shard", F.pmod(F.xxhash64("passage"), "parts").cast("int").alias("part"), "doc", "passage", "at", "words")
    known = held.withColumn("shard", shard).join(parts, "shard").select("shard", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "doc", F.lit(None).cast("long").alias("passage"), F.lit(0).alias("at"), "words")
    return known.unionByName(streamed)


def _shard_spans(passages: DataFrame) -> DataFrame:
    """(passage, first, end): spans of words of a passage that smaller documents than its first
    holder have. ``passages``: shard, part, doc (the first holder), passage, at, words; by shard, part
    and doc. Those without a name are references."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, shard = None, _Shard()
        for batch in batches:
            out: list[tuple[int, int, int]] = []
            for where, part, doc, passage, at, raw in zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True):
                if (where, part) != name:
                    name, shard = (where, part), _Shard()
                words = np.frombuffer(raw, "<u4").tolist()
                shard.upto(doc)
                if passage is None:
                    shard.waiting.append(words)
                else:
                    out += [(passage, at + first, at + first + WINDOW) for first in shard.windows(words)]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), (pa.int64(), pa.int32(), pa.int32()), strict=True)], ["passage", "first", "end"])

    return passages.mapInArrow(rows, "passage long, first int, end int")


def removed_spans(documents: DataFrame) -> DataFrame:
    """(doc_id, key, spans): word spans to remove, by document and hash of its text."""
    keyed = documents.where("doc_id is not null and text is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("key"))
    shared = repeated(_anchor_rows(keyed.select("doc_id", "text")), "anchor", "doc", "shared-anchors")
    kinds = stored(_kinds(keyed, key_filter(shared.select("anchor"))), "passage-kinds")
    # only where an anchor has several passages can a passage's first holder lose words
    several = kinds.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"), F.min("doc").alias("low"), F.max("doc").alias("high"))
    compared = stored(kinds.join(several.where("n > 1 and low < high").select("anchor"), "anchor"), "compared-passages")
    dealt = _shards(stored(_words_of(keyed, compared), "passage-words"))
    dealt = dealt.repartition("shard", "part").sortWithinPartitions("shard", "part", "doc", "passage")
    matched = _shard_spans(dealt).groupBy("passage").agg(F.collect_set(F.struct("first", "end")).alias("spans"))
    matched = stored(matched, "passage-spans")
    marks = stored(kinds.join(matched, "passage", "left").where("doc < last or spans is not null").select("passage", "doc", "size", "spans"), "passage-marks")
    found = _places(keyed, marks).join(marks, "passage")
    # a holder after the first has the whole passage in a smaller document
    whole = F.when(F.col("doc_id") > F.col("doc"), F.array(F.struct(F.lit(0).alias("first"), F.col("size").alias("end")))).otherwise(F.col("spans"))
    found = found.withColumn("spans", whole).where("spans is not null")
    shifted = F.transform("spans", lambda s: F.struct((F.col("start") + s["first"]).alias("first"), (F.col("start") + s["end"]).alias("end")))
    # a set, as rows that repeat an id and a text have the same spans
    return stored(found.groupBy("doc_id", "key").agg(F.flatten(F.collect_set(shifted)).alias("spans")), "removed-spans")


def kept_words(documents: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_removed, kept) of every row; kept words are joined by one space."""
    spans = removed_spans(documents)
    touched = key_filter(spans.select("key"))
    keyed = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("key"))

    def part(batch: pa.RecordBatch, wanted: bool) -> pa.RecordBatch:
        return batch.filter(pa.array(touched.value.may_hold(batch.column(2).to_numpy()) == wanted))

    def untouched(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        yield from cut(part(batch, False))

    def maybe(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        yield part(batch, True)

    def cut(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for row, end, data, bounds in tokens.slices(batch.column(1)):
            found = tokens.words(data, bounds)
            gone = np.zeros(len(found.hash) + 1, np.int64)
            first = found.first
            spans = batch.column(3).slice(row, end - row).to_pylist() if batch.num_columns > 3 else []
            for i, pairs in enumerate(spans):
                if pairs:
                    ends = np.array([(p["first"], p["end"]) for p in pairs]) + first[i]
                    np.add.at(gone, ends[:, 0], 1)
                    np.add.at(gone, ends[:, 1], -1)
            keep = np.cumsum(gone)[:-1] <= 0
            # each kept word with one space before it
            begin, length = found.start[keep], found.length[keep] + 1
            at = np.repeat(begin - 1, length) + tokens.ranges(length)
            raw = np.concatenate((data, [np.uint8(32)]))[at]  # the byte before a first word wraps to a space
            raw[np.cumsum(length) - length] = 32
            kept = tokens.sums_by(keep.astype(np.int64), found.counts)
            ends = np.cumsum(tokens.sums_by(length, kept))
            text, low = [], 0
            for high in ends.tolist():
                text.append(raw[low + 1 : high].tobytes().decode())
                low = high
            yield arrow_rows({"doc_id": batch.column(0).slice(row, end - row), "n_words": found.counts, "n_removed": found.counts - kept, "kept": pa.array(text, pa.string())})

    out = "doc_id long, n_words long, n_removed long, kept string"
    joined = keyed.mapInArrow(by_batch(maybe), keyed.schema).join(spans.hint("merge"), ["doc_id", "key"], "left").select("doc_id", "text", "key", "spans")
    return keyed.mapInArrow(by_batch(untouched), out).unionByName(joined.mapInArrow(by_batch(cut), out))

"""Packing: documents are concatenated and cut into windows of a fixed number of tokens.

Pass one writes every document's token ids with their place in its partition; partition totals give
each partition's place among all tokens. Pass two cuts at the multiples of the window. A window that
lies across partitions is put together from its boundary records.

A null or empty text has no ids but the separator. Repeated rows are packed once each, a null id
stays null. Only id and text are read, so further columns may have any name.
"""

from __future__ import annotations

import functools
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.llm import tokens
from roadpulse.llm.shared import arrow_rows, by_batch, stored

WINDOW = 2048
SEPARATOR = 1
PAD = 0
#: Distinct pieces that a worker remembers; beyond it only those met again are kept, half of it at most.
MEMORY_WORDS = 600_000
_AT_ONCE = 500
_SLOT_BITS = 22
#: Sets added tokens apart from the same letters in other case.
_ADDED = np.uint64(0x1D872B41A0C3F5E7)
_LETTER = np.array([chr(c).isalpha() and c < 128 for c in range(256)])
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def _marked(size: int, *places: np.ndarray) -> np.ndarray:
    """True at the given places, of 0 to ``size``."""
    mask = np.zeros(size + 1, bool)
    for at in places:
        mask[at] = True
    return mask


def _appended(held: np.ndarray, used: int, new: np.ndarray) -> np.ndarray:
    """``held`` with ``new`` after its first ``used`` values, in twice the room where it is too short."""
    if used + len(new) > len(held):
        held = np.concatenate((held[:used], np.zeros(max(used, len(new)), held.dtype)))
    held[used : used + len(new)] = new
    return held


class WordEncoder:
    """Token ids of texts by way of their distinct pieces, for a tokenizer that drops white space,
    lower-cases, and never joins letters with anything else but in endings after an apostrophe.

    A text's ids are then those of its pieces one after another, and each distinct piece is encoded
    once. A piece is a word, or a run of letters or of other characters in a word that holds only
    ASCII and Latin-1 letters and no apostrophe. The tokenizer's added tokens are cut out of words first,
    as the tokenizer does, and are pieces of their own; other case is other text for them.

    All sets of places are masks over a slice's bytes, so a slice takes time in proportion to its bytes.
    """

    def __init__(self, tokenizer: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks side by side
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.kind = np.uint16 if max(vocabulary.values()) <= 0xFFFF else np.uint32
        added = self.tokenizer.get_added_tokens_decoder().values()
        if any(t.normalized or t.lstrip or t.rstrip or t.single_word for t in added):
            raise ValueError("only plain added tokens are supported")
        self.added = [t.content.encode() for t in added]
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)
        self.last[[i for word, i in vocabulary.items() if word.endswith("</w>")]] = True
        self._forget()

    def _forget(self) -> None:
        self.count, self.filled = 1, 0  # the first piece stands for an unknown one
        self.known = np.zeros(1, np.uint64)
        self.begin = np.zeros(1, np.int64)
        self.size = np.zeros(1, np.int32)
        self.met = np.zeros(1, bool)
        self.ids = np.zeros(0, self.kind)
        self.slot = np.zeros(1 << _SLOT_BITS, np.int32)

    def _keep_met(self) -> None:
        """Forget the pieces that were not met after they were learnt."""
        keep = 1 + np.flatnonzero(self.met[1 : self.count])[: MEMORY_WORDS // 2]
        hashes, begin, size = self.known[keep], self.begin[keep], self.size[keep]
        ids = self.ids[np.repeat(begin, size) + tokens.ranges(size)]
        self._forget()
        self._add(hashes, size, ids)

    def _add(self, hashes: np.ndarray, size: np.ndarray, ids: np.ndarray) -> None:
        """Remember new pieces; ``ids`` holds theirs one after another."""
        held, begin = self.count, self.filled + np.cumsum(size) - size
        self.known = _appended(self.known, held, hashes)
        self.begin = _appended(self.begin, held, begin)
        self.size = _appended(self.size, held, size)
        self.met = _appended(self.met, held, np.zeros(len(hashes), bool))
        self.ids = _appended(self.ids, self.filled, ids)
        self.count, self.filled = held + len(hashes), self.filled + len(ids)
        self._insert(hashes, np.arange(held, self.count, dtype=np.int32))

    def pieces(self, data: np.ndarray, bounds: np.ndarray) -> tuple[tokens.Words, np.ndarray]:
        """The pieces of all texts, and which of them are runs of letters."""
        inside = tokens.WHITE[data]
        start, end = tokens.spans(inside, bounds)
        plain = np.zeros(len(start), bool)
        first = start[:0]
        if len(start):
            letter = _LETTER[data]
            latin = data == 0xC3
            tail = np.zeros(len(data), bool)
            tail[1:] = latin[:-1] & (data[1:] >= 0x80) & (data[1:] != 0x97) & (data[1:] != 0xB7)
            letter |= latin | tail
            odd = (data == 0x27) | ((data >= 0x80) & ~latin & ~tail)
            odd[:-1] |= latin[:-1] & ~tail[1:]
            odd[-1] |= latin[-1]
            breaks = np.flatnonzero((letter[1:] != letter[:-1]) & inside[1:] & inside[:-1]) + 1
            word = np.searchsorted(start, breaks, "right") - 1
            strange = np.concatenate(([0], np.cumsum(odd)))
            # a break at a word's start lies between two texts
            breaks = breaks[(breaks > start[word]) & (strange[end[word]] == strange[start[word]])]
            first, last = self._added(data, start, end)
            if len(first):
                at = np.searchsorted(first, breaks, "right") - 1
                breaks = breaks[(at < 0) | (breaks >= last[at])]
            starts, ends = _marked(len(data), start), _marked(len(data), end)
            edges = np.concatenate((first, last))
            begins, stops = edges[~ends[edges]], edges[~starts[edges]]
            starts[begins] = ends[stops] = True
            starts[breaks] = ends[breaks] = True
            start, end = np.flatnonzero(starts), np.flatnonzero(ends)
            other = np.concatenate(([0], np.cumsum(~letter | odd)))
            plain = other[end] == other[start]
        counts = np.diff(np.searchsorted(start, bounds))
        hashes = tokens.hash_spans(data, start, end, tokens.LOWER)
        if len(first):
            hashes[np.searchsorted(start, first)] ^= _ADDED
        return tokens.Words(counts, start, end - start, hashes), plain

    def _added(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where added tokens stand within words, in order."""
        raw, found = data.tobytes(), []
        for token in self.added:
            at = raw.find(token)
            while at >= 0:
                word = int(np.searchsorted(start, at, "right")) - 1
                inside = word >= 0 and at + len(token) <= end[word]  # or it lies across two texts
                if inside:
                    found.append((at, at + len(token)))
                at = raw.find(token, at + (len(token) if inside else 1))
        spans = np.array(sorted(found), np.int64).reshape(-1, 2)
        return spans[:, 0], spans[:, 1]

    def _encode(self, new: list[str]) -> tuple[np.ndarray, np.ndarray]:
        coded = [x.ids for x in self.tokenizer.encode_batch_fast(new, add_special_tokens=False)]
        return np.array([i for x in coded for i in x], np.int64), np.array([len(x) for x in coded], np.int64)

    def _learn(self, data: np.ndarray, start: np.ndarray, length: np.ndarray, hashes: np.ndarray, plain: np.ndarray) -> None:
        raw = data.tobytes()
        # runs of letters are one token run each, whose last token says so: encode many at once
        own, stop = length[plain], np.cumsum(length[plain] + 1)
        joined = np.full(stop[-1] if len(stop) else 0, 0x20, np.uint8)
        step = tokens.ranges(own)
        joined[np.repeat(stop - own - 1, own) + step] = data[np.repeat(start[plain], own) + step]
        cuts = [0, *stop[_AT_ONCE - 1 : -1 : _AT_ONCE].tolist(), len(joined)]
        ids, _ = self._encode([joined[a:b].tobytes().decode() for a, b in zip(cuts, cuts[1:], strict=False)])
        ends = np.flatnonzero(self.last[ids]) + 1
        size = np.diff(ends, prepend=0)
        if len(size) != len(own):
            ids, size = self._encode(joined.tobytes().decode().split())
        rest = [raw[s : s + n].decode() for s, n in zip(start[~plain].tolist(), length[~plain].tolist(), strict=True)]
        other, other_size = self._encode(rest)
        hashes = np.concatenate((hashes[plain], hashes[~plain]))
        self._add(hashes, np.concatenate((size, other_size)), np.concatenate((ids, other)))

    def encode(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and how many each text has."""
        found, plain = self.pieces(data, bounds)
        if self.count > MEMORY_WORDS:
            self._keep_met()
        place = self._place(found.hash)
        self.met[place] = True
        rest = np.flatnonzero(place == 0)
        if len(rest):
            kinds, first, kind = np.unique(found.hash[rest], return_index=True, return_inverse=True)
            new = rest[first]
            self._learn(data, found.start[new], found.length[new], kinds, plain[new])
            place[rest] = self._place(kinds)[kind]
        size = self.size[place]
        shift = self.begin[place] - (np.cumsum(size) - size)
        ids = self.ids[np.repeat(shift, size) + np.arange(size.sum())]
        return ids, tokens.sums_by(size.astype(np.int64), found.counts)

    def _place(self, hashes: np.ndarray) -> np.ndarray:
        """Index of each hash among the known pieces, or 0: lookups in a table with linear probing."""
        slot = (hashes >> np.uint64(64 - _SLOT_BITS)).astype(np.int64)
        place = self.slot[slot]
        left = np.flatnonzero((place != 0) & (self.known[place] != hashes))
        while len(left):
            slot[left] = (slot[left] + 1) & (len(self.slot) - 1)
            place[left] = self.slot[slot[left]]
            left = left[(place[left] != 0) & (self.known[place[left]] != hashes[left])]
        return place

    def _insert(self, hashes: np.ndarray, index: np.ndarray) -> None:
        slot = (hashes >> np.uint64(64 - _SLOT_BITS)).astype(np.int64)
        while len(slot):
            free = self.slot[slot] == 0
            self.slot[slot[free]] = index[free]
            lost = self.slot[slot] != index
            slot, index = (slot[lost] + 1) & (len(self.slot) - 1), index[lost]


@functools.lru_cache(maxsize=1)
def _encoder(tokenizer: str) -> WordEncoder:
    """One encoder for all tasks that a Python worker runs."""
    return WordEncoder(tokenizer)


def tokenized(documents: DataFrame, tokenizer: str, separator: int = SEPARATOR) -> DataFrame:
    """(part, place, doc_id, n, ids): ids as little-endian 32-bit, ``place`` counts within the part."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, part, place = _encoder(tokenizer), TaskContext.get().partitionId(), 0
        for batch in batches:
            for row, end, data, bounds in tokens.slices(batch.column(1)):
                ids, counts = coder.encode(data, bounds)
                whole = np.insert(ids.astype("<u4"), np.cumsum(counts), separator)
                counts = counts + 1
                ends = np.cumsum(counts)
                cut = [whole[e - c : e].tobytes() for e, c in zip(ends, counts, strict=True)]
                yield arrow_rows({"part": np.full(end - row, part), "place": place + ends - counts, "doc_id": batch.column(0).slice(row, end - row), "n": counts, "ids": pa.array(cut, pa.binary())})
                place += int(ends[-1])

    read = documents.select(F.col("doc_id").cast("long"), "text")
    return stored(read.mapInArrow(rows, "part long, place long, doc_id long, n long, ids binary"), "tokens")


def placed(written: DataFrame) -> DataFrame:
    """The written ids with ``at``, their first id's place among all ids.

    There is one total per task that wrote, so the broadcast side is bounded by the task count.
    """
    totals = written.groupBy("part").agg(F.max(F.col("place") + F.col("n")).alias("total")).orderBy("part").collect()
    ends = np.cumsum([0] + [r.total for r in totals]).tolist()
    spark = written.sparkSession
    bases = spark.createDataFrame([(r.part, base) for r, base in zip(totals, ends, strict=False)], "part long, base long")
    return written.join(F.broadcast(bases), "part").withColumn("at", F.col("base") + F.col("place"))


def _pieces(batch: pa.RecordBatch, window: int) -> tuple[np.ndarray, ...]:
    """Row, start in the document, length, sequence and offset of each piece."""
    at, n = batch.column("at").to_numpy(), batch.column("n").to_numpy()
    first, last = at // window, (at + n - 1) // window
    count = last - first + 1
    row = np.repeat(np.arange(len(at)), count)
    sequence = first[row] + tokens.ranges(count)
    begin = np.maximum(at[row], sequence * window)
    end = np.minimum(at[row] + n[row], (sequence + 1) * window)
    return row, begin - at[row], end - begin, sequence, begin - sequence * window


def pieces(documents: DataFrame, tokenizer: str, window: int = WINDOW, separator: int = SEPARATOR) -> DataFrame:
    """One row per piece of a document: where it lies, and the checksum of its ids."""

    def rows(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        row, start, length, sequence, offset = _pieces(batch, window)
        ids = batch.column("ids")
        held = [memoryview(ids[i].as_buffer()) for i in range(batch.num_rows)]
        crc = [zlib.crc32(held[r][4 * s : 4 * (s + k)]) for r, s, k in zip(row.tolist(), start.tolist(), length.tolist(), strict=True)]
        take = pa.array(row)
        yield arrow_rows({"doc_id": batch.column("doc_id").take(take), "start": start, "length": length, "ids_crc32": pa.array(crc, pa.int64()), "doc_tokens": batch.column("n").take(take), "sequence_id": sequence, "offset": offset})

    return placed(tokenized(documents, tokenizer, separator)).mapInArrow(by_batch(rows), PIECES)


def sequences(documents: DataFrame, tokenizer: str, window: int = WINDOW, separator: int = SEPARATOR, pad: int = PAD) -> DataFrame:
    """(sequence_id, length, ids): the packed windows. Only the last one can be short; it is padded
    to the window unless its length is a power of two. Windows that lie within one Arrow batch are
    whole at once; boundary records of the others meet by their sequence."""

    def rows(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        row, start, length, sequence, offset = _pieces(batch, window)
        ids = batch.column("ids")
        cut = [ids[r].as_py()[4 * s : 4 * (s + k)] for r, s, k in zip(row.tolist(), start.tolist(), length.tolist(), strict=True)]
        yield arrow_rows({"sequence_id": sequence, "offset": offset, "ids": pa.array(cut, pa.binary())})

    records = placed(tokenized(documents, tokenizer, separator)).mapInArrow(by_batch(rows), "sequence_id long, offset long, ids binary")

    def join(key, table):
        ids = np.frombuffer(b"".join(table.sort_by("offset").column("ids").to_pylist()), "<u4")
        size = len(ids)
        if size & (size - 1):
            ids = np.concatenate((ids, np.full(window - size, pad, "<u4")))
        return pa.table({"sequence_id": pa.array([key[0].as_py()], pa.int64()), "length": pa.array([size], pa.int64()), "ids": pa.array([ids.astype(np.int32)], pa.list_(pa.int32()))})

    return records.groupBy("sequence_id").applyInArrow(join, "sequence_id long, length long, ids array<int>")

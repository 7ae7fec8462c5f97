"""Benchmark decontamination by greedy string tiling.

Documents and benchmark items are sequences of lower-cased words of letters and digits; punctuation, symbols
and spaces of all of Unicode part words, and each character of an unspaced script is a word. A join on
shared word n-grams (seeds) finds the pairs whose seeds could cover enough of the item. For those the
longest matches that don't overlap are marked again and again, found by running Karp-Rabin hashes of
a shrinking window, until none of at least ``min_match`` words is left. Tiles may lie in any order, so
reordered passages are caught. A document is contaminated by an item if its tiles cover at least
``threshold`` of the item's words.

The benchmark is taken in blocks of a bounded size, each against all documents. Null texts and ids
take no part, nor do items without words. An item with fewer than ``min_match`` words has no tiles; it
contaminates a document that holds all its words in a row. Rows that repeat an id and an item
give one result, that with the largest cover. Only id and text columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.llm import tokens
from roadpulse.llm.shared import KeyFilter, arrow_rows, by_batch, stored

MIN_MATCH = 5
THRESHOLD = 0.5
#: Characters of benchmark text that are broadcast at once.
BLOCK_CHARS = 8_000_000
#: Seeds of texts times items with them that are looked at in one step.
PLACES = 1 << 20
_FILTER_BITS = 1 << 23
_PARTS = r"[\p{P}\p{S}\p{Z}\x{85}]"
_UNSPACED = r"([\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}])"
PAIRS = "doc_id long, item_id long, item_words long, covered long, n_tiles long, longest long"
KEYED = f"{PAIRS}, key long"


def token_words(column: pa.Array) -> Iterator[tuple[int, int, tokens.Words]]:
    """Words of one slice of the texts after another; only a slice is rewritten at once."""
    for row, end, _, _ in tokens.slices(column):
        parted = pc.replace_substring_regex(pc.utf8_lower(column.slice(row, end - row)), _PARTS, " ")
        parted = pc.replace_substring_regex(parted, _UNSPACED, r" \1 ")
        yield row, end, tokens.words(*tokens.as_bytes(parted), tokens.PLAIN)


def _window_hashes(words: np.ndarray, n: int) -> np.ndarray:
    return tokens.grams(tokens.Words(np.array([len(words)]), words, words, words), n)[1]


def tiles(text: np.ndarray, item: np.ndarray, min_match: int = MIN_MATCH) -> list[tuple[int, int, int]]:
    """Greedy string tiling of two sequences of word hashes: (place in text, place in item, length).

    Longest matches first; equal lengths by their place in the item, then in the text.
    """
    free = [np.ones(len(text), bool), np.ones(len(item), bool)]
    found: list[tuple[int, int, int]] = []
    size = min(len(item), len(text))
    while size >= min_match:
        matches = _matches(text, item, free, size)
        longest = max((m[2] for m in matches), default=0)
        if longest > 2 * size:
            size = longest
            continue
        left = False
        for a, b, n in sorted(matches, key=lambda m: (-m[2], m[1], m[0])):
            if free[0][a : a + n].all() and free[1][b : b + n].all():
                free[0][a : a + n] = free[1][b : b + n] = False
                found.append((a, b, n))
            else:
                left = True
        if left and matches:
            continue  # what is left of matches that a longer one has cut
        size = size - 1 if size <= 2 * min_match else max(size // 2, min_match)
    return found


def _matches(text: np.ndarray, item: np.ndarray, free: list[np.ndarray], size: int) -> list[tuple[int, int, int]]:
    """Maximal matches of at least ``size`` free words."""
    if min(len(text), len(item)) < size:
        return []
    places = []
    for words, open_ in ((text, free[0]), (item, free[1])):
        inside = np.concatenate(([0], np.cumsum(open_)))
        at = np.flatnonzero(inside[size:] - inside[:-size] == size)
        places.append((at, _window_hashes(words, size)[at]))
    (at, hashes), (item_at, item_hashes) = places
    order = np.argsort(item_hashes, kind="stable")
    low, high = (np.searchsorted(item_hashes[order], hashes, side) for side in ("left", "right"))
    count = high - low
    a = np.repeat(at, count)
    b = item_at[order[np.repeat(low, count) + tokens.ranges(count)]]
    # windows that follow one another on a diagonal are one match
    order = np.lexsort((a, a - b))
    a, b = a[order], b[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1] + 1) | (b[1:] != b[:-1] + 1)
    head = np.flatnonzero(new)
    run = np.diff(np.append(head, len(a)))
    return [(int(x), int(y), int(n) + size - 1) for x, y, n in zip(a[head], b[head], run, strict=True)]


@dataclass
class Items:
    """A block of benchmark items with its seeds."""

    ids: list[int]
    words: list[np.ndarray]
    seeds: np.ndarray  # sorted
    item: np.ndarray
    place: np.ndarray
    maybe: KeyFilter
    short: dict[int, tuple[np.ndarray, np.ndarray]]  # by number of words: sorted hashes of whole items, items

    @classmethod
    def of(cls, ids: list[int], texts: pa.Array, n: int) -> Items:
        kept, seeds, item, place = [], [], [], []
        whole: dict[int, list[tuple[int, int]]] = {}
        for row, end, found in token_words(texts):
            first = found.first
            for i in range(end - row):
                words = found.hash[first[i] : first[i + 1]]
                if len(words) >= n:
                    hashes = _window_hashes(words, n)
                    seeds.append(hashes)
                    place.append(np.arange(len(hashes)))
                    item.append(np.full(len(hashes), len(kept)))
                    kept.append((ids[row + i], words))
                elif len(words):
                    whole.setdefault(len(words), []).append((int(_window_hashes(words, len(words))[0]), len(kept)))
                    kept.append((ids[row + i], words))
        seed = np.concatenate(seeds) if seeds else np.zeros(0, np.uint64)
        order = np.argsort(seed, kind="stable")
        bits = np.zeros(_FILTER_BITS, bool)
        bits[KeyFilter.slots(seed, _FILTER_BITS)] = True
        at, where = (np.concatenate(x)[order] if x else np.zeros(0, np.int64) for x in (item, place))
        short = {k: (np.array([h for h, _ in sorted(v)], np.uint64), np.array([i for _, i in sorted(v)])) for k, v in whole.items()}
        return cls([i for i, _ in kept], [w for _, w in kept], seed[order], at, where, KeyFilter(np.packbits(bits, bitorder="little")), short)


def _contaminated(column: pa.Array, items: Items, min_match: int, threshold: float) -> Iterator[tuple]:
    for row, _, found in token_words(column):
        for size, (known, which) in items.short.items():
            at, hashes = tokens.grams(found, size)
            low, high = (np.searchsorted(known, hashes, side) for side in ("left", "right"))
            text = np.repeat(np.searchsorted(found.first, at, "right") - 1, high - low)
            item = which[np.repeat(low, high - low) + tokens.ranges(high - low)]
            for t, i in np.unique(np.stack((text, item)), axis=1).T.tolist():
                yield row + t, i, [(0, 0, size)]
        yield from ((row + t, i, tiles_) for t, i, tiles_ in _tiled_pairs(found, items, min_match, threshold))


def _tiled_pairs(found: tokens.Words, items: Items, min_match: int, threshold: float) -> Iterator[tuple]:
    """(text, item, tiles) where the seeds that both have could cover enough of the item.

    A seed that a text repeats counts once, so what is looked at follows the distinct seeds of a text and the
    items that have them, whatever the number of places. Texts are taken in runs of about ``PLACES`` of those.
    """
    at, hashes = tokens.grams(found, min_match)
    held = items.maybe.may_hold(hashes)
    at, hashes = at[held], hashes[held]
    low = np.searchsorted(items.seeds, hashes)
    held = low < len(items.seeds)
    held[held] = items.seeds[low[held]] == hashes[held]
    at, low = at[held], low[held]
    text = np.searchsorted(found.first, at, "right") - 1
    pairs = np.unique(text * len(items.seeds) + low)
    owner, seed = np.divmod(pairs, max(len(items.seeds), 1))
    count = np.searchsorted(items.seeds, items.seeds[seed], "right") - seed
    ends = np.cumsum(count)
    edges = np.append(np.flatnonzero(np.diff(owner, prepend=-1)), len(owner))
    words = np.array([len(w) for w in items.words], np.int64)
    start = 0
    while start < len(edges) - 1:
        before = ends[edges[start] - 1] if edges[start] else 0
        stop = start + 1
        while stop < len(edges) - 1 and ends[edges[stop + 1] - 1] - before <= PLACES:
            stop += 1
        part = slice(edges[start], edges[stop])
        place = np.repeat(seed[part], count[part]) + tokens.ranges(count[part])
        key = np.repeat(owner[part], count[part]) * len(words) + items.item[place]
        order = np.argsort(key, kind="stable")
        key, place = key[order], place[order]
        cuts = np.append(np.flatnonzero(np.diff(key, prepend=-1)), len(key))
        enough = np.diff(cuts) * min_match >= threshold * words[key[cuts[:-1]] % len(words)]
        for a, b in zip(cuts[:-1][enough].tolist(), cuts[1:][enough].tolist(), strict=True):
            t, i = divmod(int(key[a]), len(words))
            edge = np.zeros(words[i] + 1, np.int64)
            edge[items.place[place[a:b]]] = 1
            reach = np.convolve(edge, np.ones(min_match, np.int64))[: words[i]] > 0
            if reach.sum() < threshold * words[i]:
                continue  # tiles can't cover more than the seeds do
            own = slice(*np.searchsorted(at, [found.first[t], found.first[t + 1]]))
            firsts = np.searchsorted(items.seeds, items.seeds[place[a:b]])
            yield t, i, _tiled(found.hash, at[own][np.isin(low[own], firsts)], items.words[i], min_match)
        start = stop


def _tiled(text: np.ndarray, at: np.ndarray, item: np.ndarray, min_match: int) -> list[tuple[int, int, int]]:
    """Tiles of the text's parts that hold seeds, kept apart by a word that occurs nowhere else."""
    cut = np.flatnonzero(np.diff(at) >= min_match) + 1
    parts = [np.append(text[x[0] : x[-1] + min_match], np.uint64(0)) for x in np.split(at, cut)]
    return tiles(np.concatenate(parts), item, min_match)


def _pairs(documents: DataFrame, benchmark: DataFrame, min_match: int, threshold: float) -> DataFrame:
    """The pairs, with a hash of the document's text as ``key``."""
    spark = documents.sparkSession
    texts = documents.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("key")).where("doc_id is not null and text is not null")
    items = benchmark.select(F.col("item_id").cast("long"), "text").where("item_id is not null and text is not null")
    chars = items.agg(F.sum(F.length("text")).alias("n")).first().n or 0
    blocks = -(-chars // BLOCK_CHARS)

    def pairs(held):
        def rows(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            block, ids, keys, out = held.value, batch.column(0), batch.column(2), []
            for row, item, found in _contaminated(batch.column(1), block, min_match, threshold):
                size = [n for _, _, n in found]
                if sum(size) >= threshold * len(block.words[item]):
                    out.append((ids[int(row)].as_py(), block.ids[item], len(block.words[item]), sum(size), len(size), max(size), keys[int(row)].as_py()))
            if out:
                yield arrow_rows({f.split()[0]: pa.array(x, pa.int64()) for f, x in zip(KEYED.split(", "), zip(*out, strict=True), strict=True)})

        return texts.mapInArrow(by_batch(rows), KEYED)

    parts = [spark.createDataFrame([], KEYED)]
    for block in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block).toArrow()  # about BLOCK_CHARS
        held = spark.sparkContext.broadcast(Items.of(rows.column(0).to_pylist(), rows.column(1).combine_chunks(), min_match))
        if blocks == 1:
            parts.append(pairs(held))
        else:  # one block at a time is held by the executors
            parts.append(stored(pairs(held), "contaminated-pairs"))
            held.unpersist()
    return reduce(DataFrame.unionByName, parts)


def contaminated_pairs(documents: DataFrame, benchmark: DataFrame, min_match: int = MIN_MATCH, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document and item that contaminates it, with the cover of the item."""
    found = _pairs(documents, benchmark, min_match, threshold)
    best = F.max(F.struct("covered", "n_tiles", "longest", "item_words")).alias("best")
    return found.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "best.item_words", "best.covered", "best.n_tiles", "best.longest")


def decontaminated(documents: DataFrame, benchmark: DataFrame, min_match: int = MIN_MATCH, threshold: float = THRESHOLD) -> DataFrame:
    """The documents without the contaminated ones, all columns kept; of rows that repeat an id with
    different texts, only those whose text is contaminated go."""
    gone = _pairs(documents, benchmark, min_match, threshold).select(F.col("doc_id").alias("_gone"), F.col("key").alias("_text")).distinct()
    same = (F.col("doc_id").cast("long") == F.col("_gone")) & (F.xxhash64("text") == F.col("_text"))
    return documents.join(stored(gone, "contaminated"), same, "left_anti")

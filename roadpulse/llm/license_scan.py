"""License scans by a generalised suffix automaton of licence tokens.

The words of all licence templates make one suffix automaton, whose states know at which template words
they end. Texts are streamed through it word by word: the state after a word gives the longest run of words
up to there that some template holds. A word that no template holds takes the automaton back to its
start, so only runs of at least ``min_match`` template words have to be streamed; they are found by a
lookup of word hashes. Runs of at least ``min_match`` words that a text shares with a template are matches. Matches of
a template that follow one another in text and template, no more than ``gap`` words of text apart, are
chained; a chain's cover is the share of template words that it matches. Where the cover reaches ``threshold``, the text
span has the template's label.

Words are lower-cased (A-Z) runs of ASCII letters, digits and non-ASCII characters. Beside the chains, places
where the words of a base phrase stand consecutively are counted. The score is the largest cover of any
template, or 1 where a base phrase stands; a text without words scores 0.

The model (templates and automaton) has a fixed size. Each text is scanned whole and on its own: no shuffle, and
rows that repeat an id are rows of their own. A null text is empty, a null id stays null. Only id and text are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.llm import tokens
from roadpulse.llm.shared import arrow_rows, bounded_batches, by_batch

MIN_MATCH = 4
GAP = 24
THRESHOLD = 0.75

# Base phrases and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Publicly known licence notices and names.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    (
        "apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 "
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on "
        'an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for '
        "the specific language governing permissions and limitations under the License.",
    ),
    ("mit", "Released under the MIT License"),
    ("mit", "Licensed under the MIT License"),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation the '
        "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following conditions: The above "
        "copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ),
    (
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, "
        "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
        "distribution.",
    ),
    ("gpl", "licensed under the GNU General Public License, version 3"),
    ("gpl", "licensed under the GNU General Public License, version 2"),
    (
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
        "version.",
    ),
    (
        "lgpl",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
        "Public License as published by the Free Software Foundation",
    ),
    (
        "mpl-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
    (
        "unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, "
        "compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, "
        "commercial or non-commercial, and by any means.",
    ),
    ("cc-by", "Licensed under CC BY 4.0"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("cc-by", "licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-sa", "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc-by-nc", "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
)

_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SCAN = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, spans array<struct<label: string, first_word: long, last_word: long, cover: double>>"


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.translate({c: c + 32 for c in range(65, 91)}))


@dataclass
class _State:
    length: int
    link: int
    steps: dict[int, int] = field(default_factory=dict)
    ends: list[tuple[int, int]] = field(default_factory=list)


class LicenceAutomaton:
    """All runs of words of several sequences; states know their ends as (sequence, place of the last word)."""

    def __init__(self, sequences: list[list[int]]) -> None:
        self.states = [_State(0, -1)]
        for number, sequence in enumerate(sequences):
            last = 0
            for place, word in enumerate(sequence):
                last = self._grown(last, word)
                self.states[last].ends.append((number, place))
        # ends of longer runs are ends of their shorter suffixes as well
        for at in sorted(range(1, len(self.states)), key=lambda s: -self.states[s].length):
            if self.states[at].link > 0:
                self.states[self.states[at].link].ends += self.states[at].ends
        for state in self.states:
            state.ends = sorted(set(state.ends))

    def _split(self, at: int, word: int, to: int) -> int:
        copy = len(self.states)
        self.states.append(_State(self.states[at].length + 1, self.states[to].link, dict(self.states[to].steps)))
        self.states[to].link = copy
        while at >= 0 and self.states[at].steps.get(word) == to:
            self.states[at].steps[word] = copy
            at = self.states[at].link
        return copy

    def _grown(self, last: int, word: int) -> int:
        held = self.states[last].steps.get(word)
        if held is not None:  # an earlier sequence has this run already
            return held if self.states[held].length == self.states[last].length + 1 else self._split(last, word, held)
        new = len(self.states)
        self.states.append(_State(self.states[last].length + 1, 0))
        at = last
        while at >= 0 and word not in self.states[at].steps:
            self.states[at].steps[word] = new
            at = self.states[at].link
        if at >= 0:
            to = self.states[at].steps[word]
            exact = self.states[to].length == self.states[at].length + 1
            self.states[new].link = to if exact else self._split(at, word, to)
        return new

    def statistics(self, text: list[int]) -> Iterator[tuple[int, int]]:
        """State and length of the longest run that ends at each word."""
        at = length = 0
        for word in text:
            while at and word not in self.states[at].steps:
                at = self.states[at].link
                length = self.states[at].length
            at, length = (self.states[at].steps[word], length + 1) if word in self.states[at].steps else (0, 0)
            yield at, length

    def matches(self, text: list[int], least: int) -> dict[int, list[tuple[int, int, int]]]:
        """By sequence: longest runs of at least ``least`` words as (start in text, start in the sequence, words),
        by where they start."""
        open_: dict[tuple[int, int], int] = {}
        found: dict[int, list[tuple[int, int, int]]] = {}
        for place, (at, length) in enumerate(self.statistics(text)):
            seen: dict[tuple[int, int], int] = {}
            while length >= least:
                for end in self.states[at].ends:
                    seen.setdefault(end, length)
                at = self.states[at].link
                length = self.states[at].length
            still: dict[tuple[int, int], int] = {}
            for (number, end), size in seen.items():
                diagonal = (number, place - end)
                before = open_.pop(diagonal, None)
                still[diagonal] = before if before is not None else place - size + 1
            for (number, shift), start in open_.items():
                found.setdefault(number, []).append((start, start - shift, place - start))
            open_ = still
        for (number, shift), start in open_.items():
            found.setdefault(number, []).append((start, start - shift, len(text) - start))
        return {number: sorted(runs) for number, runs in found.items()}


def chains(runs: list[tuple[int, int, int]], gap: int) -> list[tuple[int, int, int]]:
    """Best chains of matches of one template: (first word, last word, covered words), apart in the text.

    A match may follow another that starts and ends before it in text and template, at most ``gap`` words of text
    apart; words that both match count once. Of matches with no larger gap between them, the chain that covers
    most is given, the first of equal ones.
    """
    out: list[tuple[int, int, int]] = []
    live: list[tuple[int, int, int, int, int]] = []  # start, template start, words, covered so far, first word
    best, reach = None, 0
    for start, place, size in runs:
        if best and start > reach + gap:
            out.append(best)
            best = None
        live = [m for m in live if start <= m[0] + m[2] + gap]
        covered, first = size, start
        for s, p, n, c, f in live:
            if s < start and p < place and s + n < start + size and p + n < place + size:
                value = c + size - max(0, s + n - start, p + n - place)
                if value > covered:
                    covered, first = value, f
        live.append((start, place, size, covered, first))
        reach = max(reach, start + size) if best else start + size
        if not best or covered > best[2]:
            best = (first, start + size - 1, covered)
    return [*out, best] if best else out


class Scanner:
    """Templates, their automaton and the base phrases, ready for texts as word hashes."""

    def __init__(self, templates: tuple[tuple[str, str], ...] = TEMPLATES, phrases: dict[str, str] | None = None, min_match: int = MIN_MATCH, gap: int = GAP, threshold: float = THRESHOLD) -> None:
        self.min_match, self.gap, self.threshold = min_match, gap, threshold
        self.labels = [label for label, _ in templates]
        held = [words_of(text) for _, text in templates]
        self.sizes = [len(words) for words in held]
        vocabulary = sorted({word for words in held for word in words})
        hashes = self._hashes(" ".join(vocabulary)) if vocabulary else np.zeros(0, np.uint64)
        order = np.argsort(hashes)
        self.known, self.number = hashes[order], order
        number = {word: i for i, word in enumerate(vocabulary)}
        self.automaton = LicenceAutomaton([[number[word] for word in words] for words in held])
        self.phrases = [(self._hashes(phrase), label) for phrase, label in (PHRASES if phrases is None else phrases).items()]

    @staticmethod
    def _hashes(text: str) -> np.ndarray:
        data = np.frombuffer(text.encode(), np.uint8)
        return tokens.words(data, np.array([0, len(data)]), tokens.PLAIN, tokens.LOWER).hash

    def base(self, found: tokens.Words) -> tuple[np.ndarray, np.ndarray]:
        """Word places at which a base phrase starts, and which one, by place."""
        places, which = [], []
        for i, (phrase, _) in enumerate(self.phrases):
            n = len(phrase)
            if len(found.hash) < n:
                continue
            fits = np.ones(len(found.hash) - n + 1, bool)
            for k, word in enumerate(phrase):
                fits &= found.hash[k : len(fits) + k] == word
            at = np.flatnonzero(fits)
            text = np.searchsorted(found.first, at, "right")
            at = at[text == np.searchsorted(found.first, at + n - 1, "right")]
            places.append(at)
            which.append(np.full(len(at), i))
        if not places:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        places, which = np.concatenate(places), np.concatenate(which)
        order = np.argsort(places, kind="stable")
        return places[order], which[order]

    def runs(self, found: tokens.Words) -> Iterator[tuple[int, int, list[int]]]:
        """Text, place of the first word in it, and numbers of the words, of runs of template words."""
        if len(self.known) == 0 or len(found.hash) == 0:
            return
        slot = np.minimum(np.searchsorted(self.known, found.hash), len(self.known) - 1)
        inside = self.known[slot] == found.hash
        start, end = tokens.spans(inside, found.first)
        long = end - start >= self.min_match
        text = np.searchsorted(found.first, start, "right") - 1
        number = self.number[slot]
        for t, a, b in zip(text[long].tolist(), start[long].tolist(), end[long].tolist(), strict=True):
            yield t, a - int(found.first[t]), number[a:b].tolist()

    def scanned(self, found: tokens.Words) -> list[tuple[list[tuple], float]]:
        """Spans (label, first word, last word, cover) of each text, and its largest cover."""
        matches: dict[int, dict[int, list[tuple[int, int, int]]]] = {}
        for text, at, numbers in self.runs(found):
            for template, runs in self.automaton.matches(numbers, self.min_match).items():
                matches.setdefault(text, {}).setdefault(template, []).extend((a + at, b, n) for a, b, n in runs)
        out: list[tuple[list[tuple], float]] = [([], 0.0) for _ in found.counts]
        for text, by_template in matches.items():
            spans, most = [], 0.0
            for template, runs in by_template.items():
                for first, last, covered in chains(sorted(runs), self.gap):
                    cover = covered / self.sizes[template]
                    most = max(most, cover)
                    if cover >= self.threshold:
                        spans.append((self.labels[template], first, last, cover))
            out[text] = (sorted(spans, key=lambda s: (s[1], s[2], s[0])), most)
        return out


def scan(documents: DataFrame, scanner: Scanner | None = None) -> DataFrame:
    """Base counts, labels, score and labelled spans of every row."""
    spark = bounded_batches(documents.sparkSession)
    held = spark.sparkContext.broadcast(scanner or Scanner())

    def rows(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        model = held.value
        for row, end, data, bounds in tokens.slices(batch.column(1)):
            found = tokens.words(data, bounds, tokens.PLAIN, tokens.LOWER)
            places, which = model.base(found)
            text = np.searchsorted(found.first, places, "right") - 1
            place = places - found.first[text]
            cuts = np.searchsorted(text, np.arange(end - row + 1))
            base_labels, labels, score, spans, first, last = [], [], [], [], [], []
            for (a, b), (own, cover) in zip(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True), model.scanned(found), strict=True):
                plain = {model.phrases[i][1] for i in np.unique(which[a:b]).tolist()}
                base_labels.append(",".join(sorted(plain)))
                labels.append(",".join(sorted(plain | {s[0] for s in own})))
                score.append(1.0 if b > a else cover)
                spans.append([dict(zip(("label", "first_word", "last_word", "cover"), s, strict=True)) for s in own])
                first.append(int(place[a]) if b > a else None)
                last.append(int(place[b - 1]) if b > a else None)
            kind = pa.list_(pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("cover", pa.float64())]))
            yield arrow_rows({
                "doc_id": batch.column(0).slice(row, end - row), "n_words": found.counts.astype(np.int64), "n_base": np.diff(cuts),
                "first_word": pa.array(first, pa.int64()), "last_word": pa.array(last, pa.int64()), "base_labels": pa.array(base_labels, pa.string()),
                "labels": pa.array(labels, pa.string()), "score": pa.array(score, pa.float64()), "spans": pa.array(spans, kind),
            })

    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(by_batch(rows), SCAN)

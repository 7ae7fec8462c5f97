"""Vector codes, the turn trie and the licence scan against brute force, and on awkward rows."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from roadpulse.llm import license_scan, tokens, turn_trie, vector_codes

VECTORS = "vec_id long, embedding array<float>, label int, code string, v string, part long"
TURNS = "conv_id long, turn long, role string, text string, depth long, x long, level int"


# --- vector codes -----------------------------------------------------------------------


def plain_codes(rows: list[tuple], parts: int, entries: int, rounds: int) -> tuple[dict, str]:
    kept = [(i, [math.floor(1024 * x) for x in v], label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = len(kept[0][1]) // parts
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for _, v, _ in kept]
    order = sorted(range(len(kept)), key=lambda i: kept[i][0])
    books = [[list(cut[i][p]) for i in order[:entries]] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), e) for e, c in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            owned = defaultdict(list)
            for x in cut:
                owned[nearest(x[p], books[p])[1]].append(x[p])
            for e, xs in owned.items():
                books[p][e] = [sum(column) // len(xs) for column in zip(*xs, strict=True)]
    found = {}
    for (i, _, label), x in zip(kept, cut, strict=True):
        best = [nearest(x[p], books[p]) for p in range(parts)]
        found[i] = ("".join(f"{e:02x}" for _, e in best), sum(d for d, _ in best), label)
    text = ",".join(str(c) for book in books for entry in book for c in entry)
    return found, hashlib.sha256(text.encode()).hexdigest()


def vectors(seed: int, n: int) -> list[tuple]:
    """Clusters, many equal vectors, entries that are equal from the start, and unusable rows."""
    rng = random.Random(seed)
    centers = [[rng.uniform(-1, 1) for _ in range(8)] for _ in range(5)]
    rows = []
    for i in range(n):
        if i % 3 == 0:
            v = centers[0]
        elif i % 7 == 0:
            v = [rng.choice((-0.5, 0.25)) for _ in range(8)]
        else:
            v = [x + rng.gauss(0, 0.05) for x in rng.choice(centers)]
        rows.append((i * 5 % n, [float(np.float32(x)) for x in v], rng.choice((None, 1, 2))))
    bad = [None, [None, *[0.0] * 7], [math.nan, *[0.0] * 7], [math.inf, *[0.0] * 7]]
    return rows + [(n + i, v, 1) for i, v in enumerate(bad)]


def test_codes_equal_brute_force(spark, monkeypatch):
    rows = vectors(3, 401)
    expected, digest = plain_codes(rows, 4, 24, 4)
    frame = spark.createDataFrame([(*r, "c", "v", 0) for r in rows], VECTORS).repartition(3)
    found, books = vector_codes.compressed(frame, entries=24, block=64, leaf=4)
    assert {r.vec_id: (r.code, r.error, r.label) for r in found.collect()} == expected
    assert vector_codes.digest(books) == digest
    whole = {r.vec_id: r for r in vector_codes.reported(frame).collect()}
    expected, digest = plain_codes(rows, 4, 256, 4)
    by_label = defaultdict(int)
    for _, error, label in expected.values():
        by_label[label] += error
    assert {i: (r.code, r.error, r.label_error, r.codebooks_sha256) for i, r in whole.items()} == {i: (c, e, by_label[label], digest) for i, (c, e, label) in expected.items()}


def test_balls_own_what_points_would_choose():
    rng = np.random.default_rng(4)
    for spread in (0, 3, 60):
        points = np.concatenate([rng.integers(-200, 200, (6, 3)).repeat(40, 0) + rng.integers(-spread, spread + 1, (240, 3)), rng.integers(-300, 300, (17, 3))])
        tree = vector_codes.Tree.unpacked(vector_codes.Tree(points, 5).packed())
        entries = points[vector_codes.first_places(points[rng.permutation(len(points))[:30]])]
        entries = entries[vector_codes.first_places(entries)]
        away = ((points[:, None, :] - entries[None, :, :]) ** 2).sum(2)
        code, error = tree.assigned(entries)
        assert (code == away.argmin(1)).all() and (error == away.min(1)).all()
        sums, counts = tree.totals(entries)
        assert (counts == np.bincount(code, minlength=len(entries))).all()
        assert all((sums[e] == points[code == e].sum(0)).all() for e in range(len(entries)))
        assert tree.count[0] == len(points) and (np.sort(tree.order) == np.arange(len(points))).all()
        whole, open_ = tree.owned(entries)
        assert spread or any(tree.count[ball] > 5 for ball, _ in whole)


def test_awkward_vectors(spark):
    assert vector_codes.reported(spark.createDataFrame([], VECTORS)).count() == 0
    unusable = [(1, None), (2, []), (3, [1.0, 2.0, 3.0])]
    assert vector_codes.reported(spark.createDataFrame([(*r, 1, "", "", 0) for r in unusable], VECTORS)).count() == 0
    rows = [(2, [1.0] * 4), (2, [0.5] * 4), (2, [0.5] * 4), (None, [1.0] * 4), (7, [1.0] * 8), (9, [3e38, -3e38, 0.0, 0.0]), (9, [3e38, -3e38, 0.0, 0.0])]
    found = vector_codes.reported(spark.createDataFrame([(*r, 1, "", "", 0) for r in rows], VECTORS)).collect()
    assert sorted((r.vec_id is not None, r.vec_id or 0) for r in found) == [(False, 0), (True, 2), (True, 2), (True, 2), (True, 9), (True, 9)]
    assert len({r.codebooks_sha256 for r in found}) == 1 and all(r.error >= 0 and len(r.code) == 8 for r in found)


# --- conversation trie ------------------------------------------------------------------


def plain_trie(rows: list[tuple]) -> set[tuple]:
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            text = text or ""
            own[conv].append(((turn is not None, turn or 0), role or "", hashlib.md5(text.encode()).hexdigest(), text))
    own = {c: [(role, text) for _, role, _, text in sorted(turns)] for c, turns in own.items()}
    whole = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - math.fmod(c, 5)
        whole[c] = own.get(base, [])[:h] + turns[h:]
    members = defaultdict(list)
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for path in members:
        if path:
            children[path[:-1]] += 1
    for path, found in members.items():
        own_saved = (len(found) - 1) * len(path[-1][1].encode()) if path else 0
        for d in range(len(path) + 1):
            leaves[path[:d]] += path not in children
            saved[path[:d]] += own_saved
    out = set()
    for path, found in members.items():
        ends = ",".join(str(c) for c in sorted(found) if len(whole[c]) == len(path))
        parent = min(members[path[:-1]]) if path else None
        out.add((min(found), len(path), parent, len(found), children[path], leaves[path], saved[path], hashlib.sha256(ends.encode()).hexdigest()))
    return out


def turns(seed: int) -> list[tuple]:
    """Shared beginnings, copies, one long conversation, ties, nulls, negative ids and repeated rows."""
    rng = random.Random(seed)
    rows = []
    common = [("user", f"start {i}") for i in range(6)]
    for c in range(-12, 90):
        told = common[: rng.randrange(7)] + [(rng.choice(("user", "bot")), f"é{rng.randrange(3)}") for _ in range(rng.randrange(8))]
        told = common if c % 3 == 0 else told
        rows += [(c, t, role, text) for t, (role, text) in enumerate(told)]
    rows += [(200, t, "user", f"long {t}") for t in range(300)] + [(201, t, "user", f"long {t % 7}") for t in range(300)]
    rows += [(95, None, None, None), (95, None, "bot", ""), (95, 1, "user", "tie b"), (95, 1, "user", "tie a"), (95, 1, "bot", "tie"), (95, 1, "bot", "tie"), (None, 1, "user", "no id")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("most", [256, 12, 1])
def test_trie_equals_brute_force(spark, most):
    rows = turns(most)
    frame = spark.createDataFrame([(*r, 0, 0, 0) for r in rows], TURNS).repartition(3)
    found = turn_trie.trie(frame, most)
    assert found.columns == [f.split()[0] for f in turn_trie.NODES.split(", ")]
    found = [tuple(r) for r in found.collect()]
    assert len(found) == len(set(found))
    assert set(found) == plain_trie(rows)


def test_trie_of_no_conversations(spark):
    empty = spark.createDataFrame([], TURNS)
    assert turn_trie.trie(empty).count() == 0
    alone = spark.createDataFrame([(3, 0, "user", "hello", 0, 0, 0)], TURNS)
    assert {tuple(r) for r in turn_trie.trie(alone).collect()} == plain_trie([(3, 0, "user", "hello")])


# --- licence scan -----------------------------------------------------------------------


def plain_chains(words: list[str], template: list[str], least: int, gap: int) -> list[tuple]:
    runs = []
    for a in range(len(words)):
        for b in range(len(template)):
            n = 0
            while a + n < len(words) and b + n < len(template) and words[a + n] == template[b + n]:
                n += 1
            if n >= least and not (a and b and words[a - 1] == template[b - 1]):
                runs.append((a, b, n))
    groups, reach = [], None
    for run in runs:
        if reach is None or run[0] > reach + gap:
            groups.append([])
            reach = run[0] + run[2]
        groups[-1].append(run)
        reach = max(reach, run[0] + run[2])
    out = []
    for group in groups:
        best = []
        for i, (a, b, n) in enumerate(group):
            mine = (n, a)
            for (x, y, m), (c, f) in zip(group[:i], best, strict=True):
                if x < a and y < b and x + m < a + n and y + m < b + n and a <= x + m + gap:
                    value = c + n - max(0, x + m - a, y + m - b)
                    mine = (value, f) if value > mine[0] else mine
            best.append(mine)
        at = max(range(len(group)), key=lambda i: (best[i][0], -i))
        out.append((best[at][1], group[at][0] + group[at][2] - 1, best[at][0]))
    return out


def plain_scan(text: str | None, templates, least: int, gap: int, threshold: float) -> tuple:
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    places, labels = [], set()
    for phrase, label in license_scan.PHRASES.items():
        p = phrase.split()
        for i in range(len(words) - len(p) + 1):
            if words[i : i + len(p)] == p:
                places.append(i)
                labels.add(label)
    spans, most = [], 0.0
    for label, template in templates:
        held = license_scan.words_of(template)
        for first, last, covered in plain_chains(words, held, least, gap):
            most = max(most, covered / len(held))
            if covered >= threshold * len(held):
                spans.append((label, first, last, covered / len(held)))
    base = ",".join(sorted(labels))
    labels |= {s[0] for s in spans}
    ends = (min(places), max(places)) if places else (None, None)
    return len(words), len(places), *ends, base, ",".join(sorted(labels)), 1.0 if places else most, sorted(spans, key=lambda s: (s[1], s[2], s[0]))


def licensed(seed: int) -> list[str | None]:
    rng = random.Random(seed)
    texts: list[str | None] = [None, "", " \n\t", "CC-BY", "cc by cc BY", "All RIGHTS reserved.", "all rights", "x" * 50_000, "ünï général public license"]
    for _ in range(120):
        parts = []
        for _ in range(rng.randrange(1, 4)):
            words = rng.choice(license_scan.TEMPLATES)[1].split()
            a = rng.randrange(len(words))
            words = words[: rng.choice((a, len(words)))]
            for _ in range(rng.randrange(4)):
                if words:
                    at = rng.randrange(len(words))
                    words[at : at + rng.randrange(2)] = rng.choice(([], ["other"], ["the", "license"], words[:5]))
            parts += ["word"] * rng.choice((0, 1, 10, 40)) + words
        texts.append(" ".join(parts))
    texts.append("plain text " * 3000 + license_scan.TEMPLATES[1][1] * 3)
    return texts


def test_scan_equals_brute_force(spark):
    texts = licensed(6)
    rows = [(i, t, "l", "s", 0.5) for i, t in enumerate(texts)] + [(3, texts[3], "l", "s", 0.5), (None, texts[4], "l", "s", 0.5)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, labels string, spans string, score double").repartition(3)
    found = license_scan.scan(frame).collect()
    assert len(found) == len(rows)
    held: dict[str | None, tuple] = {}
    settings = license_scan.TEMPLATES, license_scan.MIN_MATCH, license_scan.GAP, license_scan.THRESHOLD
    for r in found:
        text = texts[4 if r.doc_id is None else r.doc_id]
        held.setdefault(text, plain_scan(text, *settings))
        own = (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, r.score, [tuple(s) for s in r.spans])
        assert own == held[text], text
    assert license_scan.scan(frame.limit(0)).count() == 0
    assert len({label for r in found for label in r.labels.split(",")}) > 8


def test_automaton_gives_matching_statistics_and_ends():
    rng = random.Random(9)
    for _ in range(80):
        held = [[rng.randrange(3) for _ in range(rng.randrange(1, 14))] for _ in range(3)]
        automaton = license_scan.LicenceAutomaton(held)
        text = [rng.randrange(4) for _ in range(25)]
        for end, (state, size) in enumerate(automaton.statistics(text)):
            places = lambda n: {(i, k + n - 1) for i, s in enumerate(held) for k in range(len(s) - n + 1) if s[k : k + n] == text[end + 1 - n : end + 1]}
            assert size == max(n for n in range(end + 2) if not n or places(n))
            assert not size or set(automaton.states[state].ends) == places(size)


def test_scanner_without_templates():
    scanner = license_scan.Scanner(templates=())
    data = np.frombuffer(b"cc by all rights reserved", np.uint8)
    found = tokens.words(data, np.array([0, len(data)]), tokens.PLAIN, tokens.LOWER)
    assert scanner.scanned(found) == [([], 0.0)] and scanner.base(found)[0].tolist() == [0, 2]

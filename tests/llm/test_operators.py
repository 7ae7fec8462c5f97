"""The text operators against brute force, and on awkward rows."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest

from roadpulse.llm import (
    decontamination,
    language_id,
    line_dedup,
    ngram_join,
    packing,
    quality_classifier,
    quality_rules,
    substring_dedup,
    url_filter,
    warc_bundles,
)
from roadpulse.llm.queries import tokenizer_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, name string, key string, row string, sig string, line string"


def prose(rng: random.Random, words: int) -> list[str]:
    return [f"w{rng.randrange(400)}" for _ in range(words)]


def awkward() -> list[tuple]:
    """Copies, near copies, shared passages, repeated rows, nulls, empty and long texts."""
    rng = random.Random(5)
    texts: list[tuple[int | None, str | None]] = []
    base = prose(rng, 120)
    for i in range(30):
        words = list(base)
        for _ in range(i % 9):
            words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
        texts.append((i, " ".join(words)))
    passage = " ".join(prose(rng, 25))
    line = "One line that is on every site of all."
    for i in range(30, 60):
        texts.append((i, " ".join(prose(rng, 40)) + f"\n{line}\n{passage} " + " ".join(prose(rng, 10))))
    texts += [(60, None), (61, ""), (62, " \n\t"), (63, "Two words"), (64, "two WORDS"), (65, "é ü\x85 日本"), (None, "no id here at all"), (30, texts[30][1])]
    texts += [(70, " ".join(prose(rng, 60_000))), (71, "same " * 50)]
    return [(i, t, ("en", "de", "fr", None)[(i or 0) % 4], f"s{(i or 0) % 14}", len(t or ""), "n", "k", "r", "s", "l") for i, t in texts]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(awkward(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def labels(spark):
    return spark.createDataFrame([(i, i % 2, 0) for i in range(60)] + [(None, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")


def test_near_duplicates_equal_brute_force(docs):
    sets, rows = {}, [(i, t) for i, t, *_ in awkward() if i is not None]
    for i, text in rows:
        w = [x.translate({c: c + 32 for c in range(65, 91)}) for x in WORD.findall(text or "")]
        sets[i] = frozenset(tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))) if w else frozenset()
    lowest = {i: i for i in sets}
    for _ in range(len(sets)):
        for a in sets:
            for b in sets:
                both = len(sets[a] & sets[b])
                if both and 100 * both >= 80 * len(sets[a] | sets[b]):
                    lowest[a] = lowest[b] = min(lowest[a], lowest[b])
        if all(lowest[a] == lowest[lowest[a]] for a in lowest):
            break
    found = ngram_join.near_duplicates(docs).collect()
    assert len(found) == len(awkward())
    for r in found:
        if r.doc_id is not None:
            assert (r.n_shingles, r.component_id) == (len(sets[r.doc_id]), lowest[r.doc_id])
        else:
            assert r.component_id is None
    assert len({r.component_id for r in found if r.doc_id is not None and r.doc_id < 30}) < 20


def test_first_of_each_keeps_one_of_a_group_and_all_columns(docs):
    kept = ngram_join.first_of_each(docs)
    assert kept.columns == docs.columns
    ids = {r.doc_id for r in kept.select("doc_id").collect()}
    assert 0 in ids and 9 not in ids and {60, 61, 62, 63, None} <= ids and 64 not in ids


def test_substrings_equal_brute_force(docs):
    seen: dict[tuple, int] = {}
    expected = {}
    for i, text in sorted({(i, t) for i, t, *_ in awkward() if i is not None}, key=lambda x: x[0]):
        words = WORD.findall(text or "")
        windows = [tuple(words[j : j + 13]) for j in range(len(words) - 12)]
        gone = [False] * len(words)
        for j, w in enumerate(windows):
            if seen.get(w, i) < i:
                gone[j : j + 13] = [True] * 13
        for w in windows:
            seen.setdefault(w, i)
        expected[i] = (len(words), sum(gone), " ".join(w for w, g in zip(words, gone) if not g))
    found = substring_dedup.kept_words(docs).collect()
    assert len(found) == len(awkward())
    for r in found:
        if r.doc_id is not None:
            assert (r.n_words, r.n_removed, r.kept) == expected[r.doc_id]
        else:
            assert r.n_removed == 0


def test_substrings_of_hot_anchors_go_to_bounded_shards(spark, monkeypatch):
    """A passage that other words surround in each document, some of them again and again."""
    rng = random.Random(11)
    passage = prose(rng, 16)
    rows = []
    for i in range(400):
        before, after = ([f"{side}{rng.choice((rng.randrange(4), rng.randrange(10**6)))}" for _ in range(6)] for side in "ba")
        rows.append((i * 7 % 400, " ".join(before + passage + after)))
    seen: dict[tuple, int] = {}
    expected = {}
    for i, text in sorted(rows):
        words = text.split()
        gone = [False] * len(words)
        for j in range(len(words) - 12):
            if seen.setdefault(tuple(words[j : j + 13]), i) < i:
                gone[j : j + 13] = [True] * 13
        expected[i] = " ".join(w for w, g in zip(words, gone, strict=True) if not g)
    sizes, spans = [], substring_dedup._shard_spans

    def counted(passages):
        group = passages.columns[: passages.columns.index("doc")]
        sizes.append(passages.groupBy(*group).count().agg({"count": "max"}).first()[0])
        return spans(passages)

    monkeypatch.setattr(substring_dedup, "_shard_spans", counted)
    monkeypatch.setattr(substring_dedup, "SHARD_PASSAGES", 20)
    found = substring_dedup.kept_words(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    assert {r.doc_id: r.kept for r in found.collect()} == expected
    assert max(sizes) <= 100


def test_suffix_automaton_gives_matching_statistics():
    rng = random.Random(2)
    for _ in range(60):
        held = [[rng.randrange(3) for _ in range(rng.randrange(1, 15))] for _ in range(3)]
        automaton = substring_dedup.SuffixAutomaton()
        for sequence in held:
            automaton.add(sequence)
        text = [rng.randrange(4) for _ in range(20)]
        for end, size in enumerate(automaton.matches(text)):
            fits = [n for n in range(end + 2) if any(s[k : k + n] == text[end + 1 - n : end + 1] for s in held for k in range(len(s) - n + 1))]
            assert size == max(fits)


def test_line_dedup_equals_exact_counts(docs):
    sites: dict[str, set] = {}
    first: dict[str, int] = {}
    rows = [(i, t, s) for i, t, _, s, *_ in awkward()]
    for i, text, source in rows:
        for line in (text or "").split("\n"):
            if WORD.search(line) and i is not None:
                sites.setdefault(line, set()).add(source)
                first[line] = min(first.get(line, i), i)
    found = {(r.doc_id, r.kept_sha256, r.n_lines, r.n_removed) for r in line_dedup.line_dedup(docs).collect()}
    for i, text, _ in rows:
        lines = (text or "").split("\n")
        gone = [i is not None and len(sites.get(x, ())) >= 10 and first[x] != i for x in lines]
        left = "\n".join(x for x, g in zip(lines, gone) if not g)
        assert (i, hashlib.sha256(left.encode()).hexdigest(), sum(bool(WORD.search(x)) for x in lines), sum(gone)) in found
    kept = line_dedup.deduplicated(docs)
    assert kept.columns == docs.columns and kept.count() == docs.count()


def test_quality_rules_base_statistics(docs, spark):
    found = {r.doc_id: r for r in quality_rules.quality_rules(docs, labels(spark).where("quality = 1")).collect()}
    assert len(found) == len({i for i, *_ in awkward()})
    for i, text, *_ in awkward():
        words, r = WORD.findall(text or ""), found[i]
        again, windows = set(), {}
        for j in range(len(words) - 4):
            windows.setdefault(tuple(words[j : j + 5]), []).append(j)
        for places in windows.values():
            if len(places) > 1:
                again |= {j + k for j in places for k in range(5)}
        lines = [x for x in (text or "").split("\n") if WORD.search(x)]
        expected = (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(again))
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == expected
        assert r.base_failed == (len(words) < 10 or 100 * len(again) > 20 * len(words))
        assert not (r.kept and r.base_failed)


def test_packing_is_an_exact_round_trip(docs):
    from tokenizers import Tokenizer

    coder = Tokenizer.from_file(tokenizer_path())
    ids = {}
    for i, text, *_ in awkward():
        ids[i] = [*coder.encode(text or "", add_special_tokens=False).ids, 1]
    found = packing.pieces(docs, tokenizer_path()).collect()
    held: dict[int, list] = {}
    done: dict = {}
    for r in found:
        part = ids[r.doc_id][r.start : r.start + r.length]
        assert len(part) == r.length and r.doc_tokens == len(ids[r.doc_id])
        assert zlib.crc32(b"".join(x.to_bytes(4, "little") for x in part)) == r.ids_crc32
        held.setdefault(r.sequence_id, []).append((r.offset, r.length))
        done[r.doc_id] = done.get(r.doc_id, 0) + r.length
    assert all(done[i] == len(x) * sum(i == j for j, *_ in awkward()) for i, x in ids.items())
    for sequence, parts in held.items():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at == 2048 or sequence == max(held)
    whole = packing.sequences(docs, tokenizer_path()).collect()
    assert sum(r.length for r in whole) == sum(done.values())


def test_tiles_catch_reordered_passages(spark):
    item = " ".join(f"t{i}" for i in range(40))
    parts = [" ".join(f"t{i}" for i in range(a, a + 10)) for a in (30, 0, 20, 10)]
    rows = [(1, "x y " + " z ".join(parts)), (2, item.upper() + "!"), (3, " ".join(f"t{i}" for i in range(12))), (4, None), (None, item), (5, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(7, item), (8, "too short"), (9, None)], "item_id long, text string")
    found = {(r.doc_id, r.item_id): (r.covered, r.n_tiles) for r in decontamination.contaminated_pairs(docs, bench).collect()}
    assert found == {(1, 7): (40, 4), (2, 7): (40, 1)}
    assert {r.doc_id for r in decontamination.decontaminated(docs, bench).collect()} == {3, 4, 5, None}
    assert decontamination.contaminated_pairs(docs, bench.limit(0)).count() == 0


def test_short_and_unspaced_items_are_looked_for(spark):
    items = [(1, "東京は日本の首都です"), (2, "the \u201cbig\u201d cat\u2014dog ran\u00a0off home"), (3, "Two words"), (4, "two WORDS!"), (5, "..."), (6, "กรุงเทพมหานคร")]
    rows = [(1, "x 東京は日本の首都です。"), (2, 'so the "big" cat-dog ran off home'), (3, "a two, words b two words"), (4, "words two"), (5, "首都 ... です"), (6, "ไปกรุงเทพมหานครกัน"), (7, "")]
    docs, bench = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    found = {(r.doc_id, r.item_id): (r.item_words, r.covered, r.n_tiles, r.longest) for r in decontamination.contaminated_pairs(docs, bench).collect()}
    assert found == {(1, 1): (10, 10, 1, 10), (2, 2): (7, 7, 1, 7), (3, 3): (2, 2, 1, 2), (3, 4): (2, 2, 1, 2), (6, 6): (13, 13, 1, 13)}


def test_classifiers_on_awkward_rows(docs, empty, spark):
    scores = quality_classifier.quality_scores(docs, labels(spark)).collect()
    assert len(scores) == len(awkward()) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in scores)
    found = {r.doc_id: r for r in language_id.languages(docs).collect()}
    assert {found[i].lang_pred for i in (60, 61, 62)} == {"und"}
    assert all(r.lang_pred in ("en", "de", "fr", "und") and 0 <= r.score <= 1 for r in found.values())
    assert quality_classifier.quality_scores(empty, labels(spark)).count() == 0
    assert language_id.languages(docs.withColumn("lang", docs.lang.substr(9, 1)).where("lang is null")).count() == docs.where("lang is null").count()


def test_classifiers_on_held_out_rows(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet")
    quality = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = quality_classifier.quality_scores(rows, quality).where("held_out").join(quality, "doc_id").collect()
    assert sum(r.predicted == r.quality for r in scored) >= 0.8 * len(scored)
    named = language_id.languages(rows).where("held_out").join(rows.select("doc_id", "lang"), "doc_id").collect()
    assert sum(r.lang == r.lang_pred for r in named) >= 0.9 * len(named)


def test_archives_round_trip(spark):
    rows = [(i, f"http://h/{i} x", ("a" * 2000, "b" * 10, None, f"{i}" * 600)[i % 4]) for i in range(40)] + [(None, None, "a" * 2000), (36, "u", "a" * 2000)]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, digest string").repartition(3)
    index = warc_bundles.write_bundles(pages)
    found = warc_bundles.read_bundles(index).collect()
    assert len(found) == len(rows)
    for r in found:
        if r.page_id is not None and r.page_id != 36:
            html = rows[r.page_id][2] or ""
            assert (r.payload_bytes, r.payload_digest) == (len(html), hashlib.sha1(html.encode()).hexdigest())
            assert (r.record_type, r.refers_to) == (("revisit", 36) if r.page_id % 4 == 0 else ("response", None))
    one = warc_bundles.lookup(index, spark.createDataFrame([(3,)], "page_id long")).collect()
    assert [bytes(r.payload).decode() for r in one] == ["3" * 600]
    assert warc_bundles.archived(spark, pages.limit(0)).count() == 0


def test_url_filter_uses_entries_active_at_fetch_time(spark):
    entries = spark.sql("""
        SELECT * FROM VALUES ('l', 'block', 'a.com', 'add', DATE '2024-01-02', 1), ('l', 'block', 'a.com', 'remove', DATE '2024-01-05', 1),
          ('l', 'block', 'a.com', 'add', DATE '2024-01-05', 1), ('l', 'block', 'a.com', 'add', DATE '2024-01-08', 1),
          ('w', 'allow', 'x.a.com/ok', 'add', DATE '2024-01-01', 1), (NULL, 'block', NULL, 'add', DATE '2024-01-01', 1)
        AS t(list, kind, key, action, on_day, best)""")
    rows = [(1, "http://x.a.com/p", 1), (2, "https://u@X.A.com:80/p?q", 2), (3, "http://a.com", 5), (4, "http://x.a.com/ok/1", 3), (5, None, 3), (6, "http://a.com/", 9)]
    captures = spark.createDataFrame(rows, "capture_id long, url string, d int").selectExpr("capture_id", "url", "make_date(2024, 1, d) AS fetched_on", "1 AS key")
    found = {r.capture_id: (r.blocked, r.n_active, r.decided_by) for r in url_filter.verdicts(captures, entries).collect()}
    assert found == {1: (False, 0, None), 2: (True, 1, "a.com"), 3: (False, 0, None), 4: (False, 2, "x.a.com/ok"), 5: (False, 0, None), 6: (True, 1, "a.com")}
    assert url_filter.verdicts(captures, entries.limit(0)).where("blocked").count() == 0


def test_url_filter_finds_entries_with_deep_paths(spark):
    rows = [("l", "block", "a.com/1/2/3/4/5"), ("w", "allow", "a.com/1/2/3/4/5/6"), ("l", "block", "b.com")]
    entries = spark.createDataFrame(rows, "list string, kind string, key string").selectExpr("*", "'add' AS action", "DATE '2024-01-01' AS on_day")
    urls = ["http://a.com/1/2/3/4/5?q", "http://a.com/1/2/3/4", "http://a.com/1//2/3/4/5/6/7/8", "http://b.com/1/2/3/4/5/6/7"]
    captures = spark.createDataFrame(list(enumerate(urls)), "capture_id long, url string").selectExpr("*", "DATE '2024-01-02' AS fetched_on")
    found = {r.capture_id: (r.blocked, r.n_active, r.decided_by) for r in url_filter.verdicts(captures, entries).collect()}
    assert found == {0: (True, 1, "a.com/1/2/3/4/5"), 1: (False, 0, None), 2: (False, 2, "a.com/1/2/3/4/5/6"), 3: (True, 1, "b.com")}


def test_empty_tables(empty, spark):
    assert ngram_join.near_duplicates(empty).count() == 0
    assert substring_dedup.kept_words(empty).count() == 0
    assert line_dedup.line_dedup(empty).count() == 0
    assert packing.pieces(empty, tokenizer_path()).count() == 0
    assert quality_rules.quality_rules(empty, labels(spark).limit(0)).count() == 0


def test_pipeline_keeps_clean_documents_and_the_columns(spark, sf_dir):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir)
        assert docs.schema.names == spark.read.parquet(f"{sf_dir}/documents.parquet").columns, name
    assert docs.count() > 100


def test_pipeline_stages_on_awkward_and_empty_rows(docs, empty, spark, sf_dir):
    """Stages keep extra columns, drop what their rule names and nothing else, and take empty tables."""
    import corpus_pipeline

    for rows in (docs, empty):
        for name, stage in corpus_pipeline.STAGES:
            found = stage(spark, rows, sf_dir)
            if name != "packing":
                assert found.schema.names == rows.columns, name
            if rows is empty:
                assert found.count() == 0, name
    stages = dict(corpus_pipeline.STAGES)
    kept = {r.doc_id for r in stages["quality_rules"](spark, docs, sf_dir).collect()}
    assert not kept & {60, 61, 62, 63, 64, 71}
    assert stages["benchmark_decontamination"](spark, docs, sf_dir).count() == docs.count()


def test_decontamination_of_empty_tables(docs, empty, spark):
    bench = spark.createDataFrame([(7, " ".join(f"t{i}" for i in range(40)))], "item_id long, text string")
    assert decontamination.contaminated_pairs(empty, bench).count() == 0
    assert decontamination.decontaminated(docs, bench.limit(0)).count() == docs.count()


def pipeline_rows() -> tuple[list[tuple], list[tuple], list[tuple]]:
    """Documents with junk, a common line, near copies and reordered benchmark passages; labels; items."""
    rng = random.Random(11)
    item = [f"bench{i}" for i in range(30)]
    base = prose(rng, 150)
    texts = [" ".join(prose(rng, 80)) + "\nthe same closing line of every site\n" + " ".join(prose(rng, 40)) for _ in range(40)]
    texts += [" ".join(f"junk{rng.randrange(30)}" for _ in range(100)) for _ in range(15)]
    texts += [" ".join(f"w_{i}" if rng.random() < 0.01 * (i % 3) else w for w in base) for i in range(20)]
    texts += [" ".join([*prose(rng, 60), *item[20:], *prose(rng, 30), *item[: 10 * (i % 3)], *prose(rng, 60)]) for i in range(9)]
    texts += ["too short", "", None, "again and again " * 30, texts[0]]
    documents = [(i, t, "en", f"site{i % 13}", len(t or "")) for i, t in enumerate(texts)]
    return documents, [(i, int(i < 40 or i > 54), 0) for i in range(len(texts)) if i % 2], [(1, " ".join(item)), (2, "absent words of no document at all here")]


def log_ratio_verdicts(texts: dict[int, str | None], trusted: set[int]) -> dict[int, float]:
    """Scores from counts of whole n-grams, without hashing; documents that fail the base rules are left out."""
    grams = {}
    for i, text in texts.items():
        w = WORD.findall(text or "")
        grams[i] = [(a,) for a in w] + list(zip(w, w[1:]))
    raw, target = Counter(g for x in grams.values() for g in x), Counter(g for i in trusted for g in grams[i])
    part, scores = target.total() / raw.total(), {}
    for i, text in texts.items():
        w, again = WORD.findall(text or ""), set()
        windows = Counter(tuple(w[j : j + 5]) for j in range(len(w) - 4))
        for j in range(len(w) - 4):
            again |= set(range(j, j + 5)) if windows[tuple(w[j : j + 5])] > 1 else set()
        if len(w) >= 10 and 100 * len(again) <= 20 * len(w):
            scores[i] = sum(math.log((target[g] + 4) / (raw[g] * part + 4)) for g in grams[i]) / len(grams[i])
    return scores


def naive_tiles(a: list[str], b: list[str], least: int = 5) -> int:
    """Words of ``b`` covered by greedy string tiling, by trying every pair of places."""
    free_a, free_b, covered = [True] * len(a), [True] * len(b), 0
    while True:
        best = (0, 0, 0)
        for j in range(len(b)):
            for i in range(len(a)):
                n = 0
                while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n] and free_a[i + n] and free_b[j + n]:
                    n += 1
                best = max(best, (n, -j, -i))
        n, j, i = best[0], -best[1], -best[2]
        if n < least:
            return covered
        free_a[i : i + n] = free_b[j : j + n] = [False] * n
        covered += n


def test_pipeline_equals_brute_force(spark, tmp_path):
    from tokenizers import Tokenizer

    import corpus_pipeline

    documents, marks, items = pipeline_rows()
    for name, rows, schema in (
        ("documents", documents, "doc_id long, text string, lang string, source string, n_chars long"),
        ("labels", marks, "doc_id long, quality int, toxic int"),
        ("benchmark", items, "item_id long, text string"),
    ):
        spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{tmp_path}/{name}.parquet")
    found: dict[int, list] = {}
    for r in corpus_pipeline.run(spark, str(tmp_path)).collect():
        found.setdefault(r.doc_id, []).append(r)

    texts, source = {i: t for i, t, *_ in documents}, {i: s for i, _, _, s, _ in documents}
    scores = log_ratio_verdicts(texts, {i for i, q, _ in marks if q == 1})
    assert all(abs(s + 0.25) > 0.03 for s in scores.values())  # no verdict hangs on a collision
    texts = {i: t for i, t in texts.items() if scores.get(i, -1) >= -0.25}

    sites, first = {}, {}
    for i, text in texts.items():
        for line in filter(WORD.search, text.split("\n")):
            sites.setdefault(line, set()).add(source[i])
            first.setdefault(line, i)
    texts = {i: "\n".join(x for x in t.split("\n") if len(sites.get(x, ())) < 10 or first[x] == i) for i, t in texts.items()}

    shingles = {i: {tuple(w[j : j + 5]) for j in range(len(w) - 4)} for i, t in texts.items() for w in [WORD.findall(t.lower())]}
    lowest = {i: i for i in shingles}
    for _ in shingles:
        for a in shingles:
            for b in shingles:
                if 100 * len(shingles[a] & shingles[b]) >= 80 * len(shingles[a] | shingles[b]):
                    lowest[a] = lowest[b] = min(lowest[a], lowest[b])
    groups = len(set(lowest.values()))
    assert 1 < groups < len(texts)
    wanted = [x for x in (re.findall(r"[^\W_]+", t.lower()) for _, t in items)]
    leaked = {i for i, t in texts.items() if any(naive_tiles(re.findall(r"[^\W_]+", t.lower()), x) >= 0.5 * len(x) for x in wanted)}
    expected = {i for i in texts if lowest[i] == i} - leaked
    assert leaked and len(texts) < len(documents) - 10
    assert set(found) == expected

    coder = Tokenizer.from_file(tokenizer_path())
    for i, pieces in found.items():
        ids = [*coder.encode(texts[i], add_special_tokens=False).ids, 1]
        at = 0
        for r in sorted(pieces, key=lambda r: r.start):
            part = b"".join(x.to_bytes(4, "little") for x in ids[at : at + r.length])
            assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(part))
            at += r.length
        assert at == len(ids)

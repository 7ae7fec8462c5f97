"""Repeated, null and hot rows of the text operators, and their models against plain sums."""

from __future__ import annotations

import hashlib
import random
import re
import time
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from roadpulse.llm import decontamination, language_id, ngram_join, packing, quality_classifier, substring_dedup, tokens, url_filter, warc_bundles
from roadpulse.llm.features import Rows
from roadpulse.llm.queries import tokenizer_path
from tests.llm.test_operators import prose


def data_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    raw = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])


def test_packing_encodes_added_tokens_as_the_tokenizer_does(spark):
    from tokenizers import Tokenizer

    coder = Tokenizer.from_file(tokenizer_path())
    start, end = "<|startoftext|>", "<|endoftext|>"
    texts = [f"hello {start} world", f"hello{start}world", f"{start}{end}", f"{end}", f"x{end}y{end}{start}z", "<|ENDOFTEXT|>", f"<|EndOfText|>{end}", f"日本{end}é<|endoftext", "|>", "<|endof", "text|>", f"a'{end}'s don't", f"{end}<|ENDOFTEXT|>日", f"é{start}", "<| endoftext |>", f"{end}\n\n{end} "]
    rng = random.Random(3)
    bits = [start, end, "<|", "|>", "startoftext", "A", "é", "'s", "'", " ", "日", "1", "\n", "!!", "<|ENDOFTEXT|>"]
    texts += ["".join(rng.choice(bits) for _ in range(rng.randrange(1, 12))) for _ in range(300)]
    found = packing.tokenized(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3), tokenizer_path()).collect()
    assert len(found) == len(texts)
    for r in found:
        assert np.frombuffer(r.ids, "<u4").tolist() == [*coder.encode(texts[r.doc_id], add_special_tokens=False).ids, 1], texts[r.doc_id]


def encoded(coder: packing.WordEncoder, texts: list[str]) -> list[list[int]]:
    ids, counts = coder.encode(*data_of(texts))
    return [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])]


def test_cutting_texts_into_pieces_costs_little_more_than_finding_words():
    rng = random.Random(5)
    texts = [" ".join("".join(rng.choices("abcdefghijklmnopqrsté.,", k=rng.randrange(2, 9))) for _ in range(300)) for _ in range(150)]
    data, bounds = data_of(texts)
    coder = packing.WordEncoder(tokenizer_path())

    def least(function) -> float:
        took = []
        for _ in range(9):
            began = time.process_time()
            function(data, bounds)
            took.append(time.process_time() - began)
        return min(took)

    assert least(coder.pieces) < 6 * least(tokens.words)  # about 2; 12 with numpy's set functions


def test_runs_of_letters_with_accents_reach_the_tokenizer_together(monkeypatch):
    coder, given = packing.WordEncoder(tokenizer_path()), []
    whole = coder._encode
    monkeypatch.setattr(coder, "_encode", lambda new: given.extend(new) or whole(new))
    rng = random.Random(6)
    words = ["".join(rng.choices("abcÀÉéñßÿ", k=rng.randrange(1, 12))) for _ in range(1200)]
    texts = [" ".join(words), "Ñu1ñu×é÷ª étéœ d'été", "", "É"]
    found = encoded(coder, texts)
    assert found == [coder.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert len(given) < 20


def test_a_full_memory_keeps_the_pieces_that_were_met_again(monkeypatch):
    monkeypatch.setattr(packing, "MEMORY_WORDS", 400)
    coder, given = packing.WordEncoder(tokenizer_path()), []
    whole = coder._encode
    monkeypatch.setattr(coder, "_encode", lambda new: given.extend(" ".join(new).split()) or whole(new))
    letters = "abcdefghij"
    rare = ["x" + "".join(letters[int(d)] for d in str(n)) for n in range(3000)]
    often = ["the", "été", "42", "don't", "!?"]
    for n in range(0, 3000, 100):
        text = " ".join(often + rare[n : n + 100])
        assert encoded(coder, [text]) == [coder.tokenizer.encode(text, add_special_tokens=False).ids]
    assert all(given.count(x) == 1 for x in often)
    assert coder.count <= 400 + 200


def test_captures_that_repeat_an_id_or_have_none_are_rows(spark):
    entries = spark.sql("SELECT 'l' AS list, 'block' AS kind, 'a.com' AS key, 'add' AS action, DATE '2024-01-01' AS on_day")
    rows = [(1, "http://a.com"), (1, "http://a.com"), (None, "http://a.com"), (None, "http://b.com"), (2, "http://b.com"), (2, "http://a.com"), (3, None), (None, None)]
    captures = spark.createDataFrame(rows, "capture_id long, url string").selectExpr("*", "DATE '2024-01-02' AS fetched_on", "1 AS n", "2 AS key")
    found = Counter((r.capture_id, r.blocked, r.n_active, r.decided_by) for r in url_filter.verdicts(captures, entries).collect())
    yes, no = (True, 1, "a.com"), (False, 0, None)
    assert found == Counter([(1, *yes), (1, *yes), (None, *yes), (None, *no), (2, *no), (2, *yes), (3, *no), (None, *no)])
    assert url_filter.verdicts(captures.limit(0), entries).count() == 0


def test_passages_of_many_equal_rows_are_marked_once(spark):
    words = prose(random.Random(1), 100)
    rows = [(1, " ".join(words[20:80]))] + [(5, " ".join(words))] * 3000
    began = time.monotonic()
    spans = substring_dedup.removed_spans(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert [(r.doc_id, len(r.spans) <= 100) for r in spans] == [(5, True)]
    found = substring_dedup.kept_words(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    assert {(r.doc_id, r.n_removed, r.kept) for r in found.collect()} == {(1, 0, rows[0][1]), (5, 60, " ".join(words[:20] + words[80:]))}
    assert found.count() == len(rows)
    assert time.monotonic() - began < 120


def test_one_row_of_each_group_stays(spark):
    rng = random.Random(8)
    base, other, alone = prose(rng, 90), prose(rng, 90), prose(rng, 90)
    near = [*base[:-1], "changed"]
    rows = [(1, " ".join(base)), (1, " ".join(base)), (2, " ".join(near)), (2, " ".join(alone)), (3, " ".join(other)), (3, " ".join(other)), (4, " ".join(base)), (5, ""), (5, ""), (5, None), (None, "no id"), (None, "no id"), (6, None)]
    frame = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "doc_id long, text string, key int").repartition(3)
    kept = Counter((r.doc_id, r.text) for r in ngram_join.first_of_each(frame).collect())
    assert kept.pop((None, "no id")) == 2
    assert set(kept.values()) == {1}
    ids = Counter(i for i, _ in kept)
    assert ids[1] == ids[3] == ids[6] == 1 and ids[4] == 0
    assert (2, " ".join(near)) not in kept


def test_contaminated_rows_go_by_text(spark):
    item = " ".join(f"t{i}" for i in range(20))
    docs = spark.createDataFrame([(1, f"x {item}"), (1, "clean text of the same id"), (1, f"x {item}"), (2, "other " * 5000 + item), (None, item)], "doc_id long, text string").selectExpr("*", "1 AS key", "2 AS item_id")
    bench = spark.createDataFrame([(7, item), (7, item), (None, item)], "item_id long, text string").selectExpr("*", "3 AS doc_id")
    assert {(r.doc_id, r.item_id, r.covered) for r in decontamination.contaminated_pairs(docs, bench).collect()} == {(1, 7, 20), (2, 7, 20)}
    assert decontamination.contaminated_pairs(docs, bench).count() == 2
    kept = decontamination.decontaminated(docs, bench)
    assert kept.columns == docs.columns and {(r.doc_id, r.text) for r in kept.collect()} == {(1, "clean text of the same id"), (None, item)}


@pytest.mark.parametrize("n", [500, 4000])
def test_common_seeds_take_bounded_memory(n):
    opening = "in this long task we"
    items = [f"{opening} {' '.join(f'q{i}x{j}' for j in range(8))}" for i in range(n)]
    block = decontamination.Items.of(list(range(n)), pa.array(items), 5)
    text = " ".join(f"{opening} w{i}" for i in range(2000)) + " " + items[7]
    tracemalloc.start()
    found = list(decontamination._contaminated(pa.array([text, None, items[3]]), block, 5, 0.5))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert {(int(row), item) for row, item, _ in found} == {(0, 7), (2, 3)}
    assert peak < 120e6


def test_blocks_of_items_find_the_same(spark, monkeypatch):
    rng = random.Random(2)
    items = [(i, " ".join(prose(rng, 20))) for i in range(40)]
    docs = spark.createDataFrame([(i, " ".join(prose(rng, 30)) + " " + items[i % 40][1][: 20 + i]) for i in range(90)], "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    whole = {tuple(r) for r in decontamination.contaminated_pairs(docs, bench).collect()}
    monkeypatch.setattr(decontamination, "BLOCK_CHARS", 700)
    monkeypatch.setattr(decontamination, "PLACES", 5)
    assert {tuple(r) for r in decontamination.contaminated_pairs(docs, bench).collect()} == whole and whole


def test_archives_are_read_back_by_many_tasks(spark, monkeypatch):
    rng = random.Random(4)
    rows = [(i, f"http://h/{i}", "".join(rng.choice("abcdefgh") for _ in range(20_000))) for i in range(200)]
    monkeypatch.setattr(warc_bundles, "RANGE_BYTES", 300_000)
    index = warc_bundles.write_bundles(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(2))
    found = warc_bundles.read_bundles(index)
    assert found.rdd.getNumPartitions() >= 6
    assert found.count() == len(rows)
    assert {r.page_id: bytes(r.payload).decode() for r in found.collect()} == {i: html for i, _, html in rows}
    assert found.columns[:5] == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]


def test_machine_sums_pairs_as_a_double_loop_does():
    rng = np.random.default_rng(5)
    counts = np.array([4, 0, 1, 7])
    rows = Rows(rng.integers(0, 30, counts.sum()), rng.normal(size=counts.sum()), counts)
    model = quality_classifier.FactorisationMachine(0.3, rng.normal(size=30), rng.normal(size=(30, quality_classifier.FACTORS)))
    at = 0
    for n, raw, score in zip(counts, model.raw(rows), model.score(rows), strict=True):
        x = list(zip(rows.column[at : at + n], rows.value[at : at + n], strict=True))
        at += n
        total = model.bias + sum(model.linear[c] * v for c, v in x)
        for i in range(n):
            for j in range(i + 1, n):
                total += model.factors[x[i][0]] @ model.factors[x[j][0]] * x[i][1] * x[j][1]
        assert raw == pytest.approx(total) and score == pytest.approx(1 / (1 + np.exp(-total)))


def test_classifier_inputs_are_word_shares():
    texts = ["One two two\ntwo", "", "a " * 9 + "#", "é 12 AB."]
    rows = quality_classifier.entries(*data_of(texts))
    at = 0
    for text, n in zip(texts, rows.counts, strict=True):
        value, column = rows.value[at : at + n], rows.column[at : at + n]
        at += n
        words = Counter(text.split())
        shares = sorted(10 * c / words.total() for c in words.values())
        assert sorted(value[column < quality_classifier.COLUMNS]) == pytest.approx(shares)
        dense = value[column >= quality_classifier.COLUMNS]
        size = max(len(text.encode()), 1)
        assert len(dense) == quality_classifier._STATISTICS and dense[0] == 1
        assert dense[6:8] == pytest.approx([4 * len(re.findall("[A-Z]", text)) / size, 4 * len(re.findall("[0-9]", text)) / size])


def test_scores_of_queries_are_those_of_the_model(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    model = quality_classifier.learnt(docs, labels)
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    for r in quality_classifier.quality_scores(docs, labels).collect():
        rows = quality_classifier.entries(*data_of([texts[r.doc_id]]))
        raw = model.bias + sum(model.linear[c] * v for c, v in zip(rows.column, rows.value, strict=True))
        for k in range(quality_classifier.FACTORS):
            own = [model.factors[c, k] * v for c, v in zip(rows.column, rows.value, strict=True)]
            raw += (sum(own) ** 2 - sum(x * x for x in own)) / 2
        assert r.score == pytest.approx(1 / (1 + np.exp(-np.clip(raw, -30, 30))), abs=1e-9)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and r.predicted == (r.score >= 0.5)


def test_one_sided_and_absent_labels(spark):
    docs = spark.createDataFrame([(i, f"some text {i}") for i in range(20)] + [(20, None)], "doc_id long, text string").selectExpr("*", "1 AS quality", "2 AS score")
    for labels, expected in (([(i, 1) for i in range(20)], {1}), ([(i, 0) for i in range(20)], {0}), ([], {1}), ([(None, 1), (3, None)], {1})):
        found = quality_classifier.quality_scores(docs, spark.createDataFrame(labels, "doc_id long, quality int")).collect()
        assert {r.predicted for r in found} == expected and len(found) == 21


def plain_grams(text: str) -> dict[int, float]:
    raw = bytes(32 if c < 128 and not chr(c).isalpha() else c + 32 if 65 <= c <= 90 else c for c in text.encode())
    out: dict[int, float] = {}
    for n in (2, 3):
        grams = [int.from_bytes(raw[i : i + n], "little") for i in range(len(raw) - n + 1)]
        for code in grams:
            column = (code * 0x9E3779B1 % (1 << 32) >> (32 - language_id.BITS)) + ((n - 2) << language_id.BITS)
            out[column] = out.get(column, 0) + 1 / len(grams)
    return out


def test_language_inputs_are_gram_shares():
    texts = ["Das ist gut", "", "é", "a1", "This IS it! " * 9, "ab"]
    rows = language_id.entries(*data_of(texts))
    at = 0
    for text, n in zip(texts, rows.counts, strict=True):
        assert dict(zip(rows.column[at : at + n].tolist(), rows.value[at : at + n].tolist(), strict=True)) == pytest.approx(plain_grams(text))
        at += n


def test_votes_of_the_hierarchy_equal_plain_votes(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    families = {"one": ("de", "en", "es"), "two": ("fr",)}
    model = language_id.learnt(docs, families=families)
    found = {r.doc_id: r for r in language_id.languages(docs, families=families).collect()}
    for r in docs.collect():
        if not re.search(r"[^\W\d_]", r.text or ""):
            assert found[r.doc_id].lang_pred == "und" and found[r.doc_id].score == 0
            continue
        x = plain_grams(r.text)
        margin = [b + sum(float(model.weights[c, k]) * v for c, v in x.items()) for k, b in enumerate(model.bias)]
        family = max(range(len(model.families)), key=lambda f: margin[f])
        members, votes, total = model.families[family], Counter(), Counter()
        for k, (a, b) in enumerate(model.pairs):
            m = margin[len(model.families) + k]
            if a in members:
                votes[a if m >= 0 else b] += 1
                total[a] += m
                total[b] -= m
        best = max(members, key=lambda i: votes[i] + np.tanh(total[i]) / 4)
        assert found[r.doc_id].lang_pred == model.languages[best]


def test_the_sample_is_cut_before_its_shuffle(spark):
    docs = spark.range(4000).selectExpr("id AS doc_id", "'text' AS text", "CASE WHEN id % 50 < 40 THEN 'en' WHEN id % 50 < 49 THEN 'de' ELSE concat('x', id % 7) END AS lang")
    frame = language_id.sampled(docs, sample_rows=20, most_languages=3)
    plan = frame._jdf.queryExecution().optimizedPlan().toString()
    window, join = plan.index("Window"), plan.index("Join Inner")
    assert window < join and "Filter" in plan[window:join] or "pmod" in plan[join : join + 400]
    shuffled = frame._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in shuffled and "SortMergeJoin" not in shuffled
    found = Counter(r.lang for r in frame.collect())
    assert len(found) == 3 and found["en"] == found["de"] == 20


def test_all_near_copies_of_a_table_are_found(spark):
    """Every pair of a whole table, by brute force over shared shingles."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    sets, holders = {}, {}
    for r in docs.select("doc_id", "text").collect():
        w = [x.translate({c: c + 32 for c in range(65, 91)}) for x in re.findall(r"[^\x20\x09-\x0D]+", r.text or "")]
        sets[r.doc_id] = {hashlib.md5(" ".join(w[j : j + 5]).encode()).digest()[:8] for j in range(max(1, len(w) - 4))} if w else set()
        for x in sets[r.doc_id]:
            holders.setdefault(x, []).append(r.doc_id)
    lowest = {i: i for i in sets}

    def root(i):
        while lowest[i] != i:
            lowest[i] = lowest[lowest[i]]
            i = lowest[i]
        return i

    for i, own in sets.items():
        for j, both in Counter(j for x in own for j in holders[x] if j < i).items():
            if 100 * both >= 80 * (len(own) + len(sets[j]) - both):
                a, b = sorted((root(i), root(j)))
                lowest[b] = a
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.near_duplicates(docs).collect()}
    assert found == {i: (len(sets[i]), root(i)) for i in sets}

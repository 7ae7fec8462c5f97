"""Each operator on its whole table with production settings, and SQL with the same result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.llm import (
    decontamination,
    language_id,
    license_scan,
    line_dedup,
    ngram_join,
    packing,
    quality_classifier,
    quality_rules,
    substring_dedup,
    turn_trie,
    url_filter,
    vector_codes,
    warc_bundles,
)
from roadpulse.llm.shared import bounded_batches

FIRST_DAY = "2024-01-01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return bounded_batches(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_warc_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_bundles.archived(spark, table(spark, sf_dir, "pages"))


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring_dedup.kept_words(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated_pairs(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def _dated(keys: DataFrame, name: str, kind: str, add: str, remove: str, again: str | None = None) -> DataFrame:
    """List entries of keys, on days that follow from the keys' digests."""
    parts = keys.distinct().withColumns({n: F.conv(F.substring(F.md5("key"), at, 4), 16, 10).cast("int") for n, at in (("a", 1), ("b", 5))})

    def entry(action: str, day: str, rows: DataFrame) -> DataFrame:
        return rows.select(F.lit(name).alias("list"), F.lit(kind).alias("kind"), "key", F.lit(action).alias("action"), F.date_add(F.lit(FIRST_DAY).cast("date"), F.expr(day)).alias("on_day"))

    out = entry("add", add, parts).unionByName(entry("remove", remove, parts))
    return out.unionByName(entry("add", again, parts.where("b % 2 = 1"))) if again else out


def url_lists(pages: DataFrame) -> DataFrame:
    """Dated entries for the hosts, parent domains and sections of the pages."""
    name = url_filter.host(F.col("url"))
    hosts = pages.select(name.alias("key")).where("key <> ''")
    domains = hosts.where(F.size(F.split("key", r"\.")) > 2).select(F.regexp_replace("key", r"^[^.]*\.", "").alias("key"))
    section = F.regexp_extract(url_filter.path(F.col("url")), "^/+([^/]+)", 1)
    sections = pages.select(name.alias("host"), section.alias("section")).where("host <> '' and section <> ''").select(F.concat_ws("/", "host", "section").alias("key"))
    return (
        _dated(hosts, "hosts", "block", "a % 366", "a % 366 + 1 + b % 120", "a % 366 + 200 + b % 50")
        .unionByName(_dated(domains, "domains", "block", "a % 300", "a % 300 + 30 + b % 60"))
        .unionByName(_dated(sections, "sections", "allow", "a % 200", "a % 200 + 1 + b % 200"))
    )


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    fetched = F.date_add(F.lit(FIRST_DAY).cast("date"), (F.col("page_id") * 37 % 366).cast("int"))
    captures = pages.select(F.col("page_id").alias("capture_id"), "url", fetched.alias("fetched_on"))
    return url_filter.verdicts(captures, url_lists(pages)).withColumnRenamed("capture_id", "page_id")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pieces(table(spark, sf_dir, "documents"), tokenizer_path())


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    trusted = table(spark, sf_dir, "labels").where("quality = 1")
    return quality_rules.quality_rules(table(spark, sf_dir, "documents"), trusted)


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_dedup(table(spark, sf_dir, "documents"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.languages(table(spark, sf_dir, "documents"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.reported(table(spark, sf_dir, "embeddings"))


def op12_turn_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turn_trie.trie(table(spark, sf_dir, "conversations"))


def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents")).drop("spans")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_warc_bundles,
        op2_ngram_jaccard_join,
        op3_substring_dedup,
        op4_quality_classifier,
        op5_benchmark_decontamination,
        op6_url_filter,
        op7_packing,
        op8_quality_rules,
        op9_line_dedup,
        op10_language_id,
        op11_vector_codes,
        op12_turn_trie,
        op13_license_scan,
    )
}

ORACLES: dict[str, str] = {
    "op1_warc_bundles": """
        WITH p AS (
          SELECT page_id, url, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest
          FROM pages
        ), s AS (
          SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS stored_in FROM p
        )
        SELECT page_id, url, CASE WHEN payload_bytes >= 1000 AND page_id <> stored_in THEN 'revisit' ELSE 'response' END AS record_type,
          CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
          CASE WHEN payload_bytes >= 1000 AND page_id <> stored_in THEN stored_in END AS refers_to
        FROM s
    """,
    "op3_substring_dedup": r"""
        WITH t AS (
          SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
        ), windows AS (
          SELECT doc_id, unnest(range(1, len(w) - 11)) AS pos,
            unnest(list_transform(range(1, len(w) - 11), lambda i: array_to_string(w[i:i + 12], ' '))) AS win
          FROM t WHERE len(w) >= 13
        ), firsts AS (
          SELECT win, min(doc_id) AS first FROM windows GROUP BY win
        ), gone AS (
          SELECT DISTINCT doc_id, unnest(range(pos, pos + 13)) AS place
          FROM windows JOIN firsts USING (win) WHERE first < doc_id
        ), words AS (
          SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS place FROM t
        ), kept AS (
          SELECT doc_id, string_agg(word, ' ' ORDER BY place) AS text, count(*) AS n
          FROM words ANTI JOIN gone USING (doc_id, place) GROUP BY doc_id
        )
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
          sha256(coalesce(text, '')) AS kept_sha256
        FROM t LEFT JOIN kept USING (doc_id)
    """,
    "op6_url_filter": r"""
        WITH p AS (
          SELECT page_id, DATE '2024-01-01' + CAST(page_id * 37 % 366 AS INTEGER) AS day,
            lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)) AS host,
            regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1) AS path
          FROM pages
        ), named AS (
          SELECT 'hosts' AS list, 'block' AS kind, host AS key FROM p WHERE host <> ''
          UNION SELECT 'domains', 'block', regexp_replace(host, '^[^.]*\.', '') FROM p WHERE len(string_split(host, '.')) > 2
          UNION SELECT 'sections', 'allow', host || '/' || regexp_extract(path, '^/+([^/]+)', 1)
            FROM p WHERE host <> '' AND regexp_extract(path, '^/+([^/]+)', 1) <> ''
        ), coded AS (
          SELECT *, CAST('0x' || substr(md5(key), 1, 4) AS INTEGER) AS a, CAST('0x' || substr(md5(key), 5, 4) AS INTEGER) AS b FROM named
        ), spans AS (
          SELECT kind, list, key, a % 366 AS since, a % 366 + 1 + b % 120 AS until FROM coded WHERE list = 'hosts'
          UNION ALL SELECT kind, list, key, a % 366 + 200 + b % 50, NULL FROM coded WHERE list = 'hosts' AND b % 2 = 1
          UNION ALL SELECT kind, list, key, a % 300, a % 300 + 30 + b % 60 FROM coded WHERE list = 'domains'
          UNION ALL SELECT kind, list, key, a % 200, a % 200 + 1 + b % 200 FROM coded WHERE list = 'sections'
        ), parts AS (
          SELECT page_id, day, host, list_filter(string_split(path, '/'), lambda s: s <> '') AS seg, string_split(host, '.') AS lab FROM p
        ), asked AS (
          SELECT DISTINCT page_id, day, unnest(list_concat(
            list_transform(range(1, len(lab) + 1), lambda i: array_to_string(lab[i:], '.')),
            list_transform(range(1, least(len(seg), 3) + 1), lambda i: host || '/' || array_to_string(seg[1:i], '/')))) AS key
          FROM parts WHERE host <> ''
        ), hits AS (
          SELECT page_id, key, count(*) AS n, bool_or(kind = 'block') AS blocked
          FROM asked JOIN spans USING (key)
          WHERE DATE '2024-01-01' + since <= day AND (until IS NULL OR day < DATE '2024-01-01' + until)
          GROUP BY page_id, key
        ), best AS (
          SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY len(key) DESC, blocked DESC, key DESC) AS r,
            sum(n) OVER (PARTITION BY page_id) AS total FROM hits
        )
        SELECT page_id, coalesce(blocked, false) AS blocked, CAST(coalesce(total, 0) AS BIGINT) AS n_active, key AS decided_by
        FROM p LEFT JOIN (SELECT * FROM best WHERE r = 1) USING (page_id)
    """,
    "op9_line_dedup": r"""
        WITH l AS (
          SELECT doc_id, source, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
            unnest(range(1, len(string_split(coalesce(text, ''), chr(10))) + 1)) AS pos
          FROM documents
        ), worded AS (
          SELECT * FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
        ), spread AS (
          SELECT line, min(doc_id) AS first FROM worded GROUP BY line HAVING count(DISTINCT source) >= 10
        ), marked AS (
          SELECT l.doc_id, l.line, l.pos, s.first IS NOT NULL AND s.first <> l.doc_id AS gone,
            regexp_matches(l.line, '[^\x20\x09-\x0D]') AS worded
          FROM l LEFT JOIN spread s ON l.line = s.line
        )
        SELECT doc_id, CAST(count(*) FILTER (worded) AS BIGINT) AS n_lines, CAST(count(*) FILTER (gone) AS BIGINT) AS n_removed,
          sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
        FROM marked GROUP BY doc_id
    """,
}


def _code_rounds(parts: int = vector_codes.PARTS, entries: int = vector_codes.ENTRIES, rounds: int = vector_codes.ROUNDS) -> str:
    """SQL of the codes: one pair of steps a round."""
    steps = [f"""
        WITH k AS (
          SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor({vector_codes.SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
          FROM embeddings WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), p AS MATERIALIZED (
          SELECT vec_id, label, part, v[part * len(v) // {parts} + 1:(part + 1) * len(v) // {parts}] AS w
          FROM k, (SELECT unnest(range({parts})) AS part)
        ), b0 AS MATERIALIZED (
          SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry, w AS c FROM p
          QUALIFY entry < {entries}
        )"""]
    for i in range(rounds + 1):
        steps.append(f"""a{i} AS MATERIALIZED (
          SELECT vec_id, p.part, any_value(label) AS label, any_value(w) AS w,
            min({{'d': list_sum(list_transform(list_zip(w, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), 'e': entry}}) AS best
          FROM p JOIN b{i} USING (part) GROUP BY vec_id, p.part
        )""")
        if i < rounds:
            steps.append(f"""u{i} AS (
          SELECT part, entry, list(m ORDER BY place) AS c FROM (
            SELECT part, entry, place, CAST(floor(sum(x) / count(*)) AS BIGINT) AS m
            FROM (SELECT part, best.e AS entry, unnest(w) AS x, unnest(range(len(w))) AS place FROM a{i})
            GROUP BY part, entry, place)
          GROUP BY part, entry
        ), b{i + 1} AS MATERIALIZED (
          SELECT part, entry, coalesce(u{i}.c, b{i}.c) AS c FROM b{i} LEFT JOIN u{i} USING (part, entry)
        )""")
    return ",\n        ".join(steps) + f""", r AS (
          SELECT vec_id, any_value(label) AS label, string_agg(printf('%02x', best.e), '' ORDER BY part) AS code, CAST(sum(best.d) AS BIGINT) AS error
          FROM a{rounds} GROUP BY vec_id
        )
        SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
          (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) FROM b{rounds}) AS codebooks_sha256
        FROM r"""


ORACLES["op11_vector_codes"] = _code_rounds()

ORACLES["op12_turn_trie"] = f"""
    WITH t AS (
      SELECT conv_id, {{'r': coalesce(role, ''), 't': coalesce(text, '')}} AS m,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), md5(coalesce(text, ''))) AS pos
      FROM conversations WHERE conv_id IS NOT NULL
    ), crc AS (
      SELECT conv_id, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
        lambda s, c: list_reduce(list_prepend(xor(s, c), range(8)),
          lambda z, i: xor(z >> 1, CASE WHEN z & 1 = 1 THEN 3988292384::BIGINT ELSE 0::BIGINT END))) AS left_over
      FROM (SELECT DISTINCT conv_id FROM t)
    ), h AS (
      SELECT conv_id, xor(left_over, 4294967295::BIGINT) % {turn_trie.MOST_TURNS} AS h FROM crc
    ), seq AS (
      SELECT h.conv_id, list(m ORDER BY side, pos) FILTER (m IS NOT NULL) AS ms FROM h LEFT JOIN (
        SELECT h.conv_id, 0 AS side, pos, m FROM h JOIN t ON t.conv_id = h.conv_id - h.conv_id % {turn_trie.BASE_EVERY} AND pos <= h
        UNION ALL SELECT t.conv_id, 1, pos, m FROM h JOIN t ON t.conv_id = h.conv_id AND pos > h
      ) USING (conv_id) GROUP BY h.conv_id
    ), member AS MATERIALIZED (
      SELECT conv_id, d, ms[1:d] AS path, d = len(ms) AS ends
      FROM (SELECT conv_id, coalesce(ms, []) AS ms, unnest(range(len(coalesce(ms, [])) + 1)) AS d FROM seq)
    ), node AS MATERIALIZED (
      SELECT path, d, min(conv_id) AS conv_id, count(*) AS n, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends) AS ended
      FROM member GROUP BY path, d
    ), kids AS (
      SELECT path[1:d - 1] AS path, count(*) AS n FROM node WHERE d > 0 GROUP BY ALL
    ), own AS (
      SELECT node.path, d, coalesce(kids.n, 0) AS children,
        CASE WHEN d = 0 THEN 0 ELSE (node.n - 1) * octet_length(encode(node.path[d].t)) END AS saved
      FROM node LEFT JOIN kids USING (path)
    ), up AS (
      SELECT path[1:e] AS path, count(*) FILTER (children = 0) AS leaves, sum(saved) AS saved
      FROM (SELECT *, unnest(range(d + 1)) AS e FROM own) GROUP BY path[1:e]
    )
    SELECT node.conv_id, CAST(node.d AS BIGINT) AS depth, p.conv_id AS parent_conv_id, CAST(node.n AS BIGINT) AS n_convs,
      CAST(own.children AS BIGINT) AS n_children, CAST(up.leaves AS BIGINT) AS n_leaves, CAST(up.saved AS BIGINT) AS saved_tokens,
      sha256(coalesce(node.ended, '')) AS ends_sha256
    FROM node JOIN own USING (path) JOIN up USING (path) LEFT JOIN node p ON node.d > 0 AND p.path = node.path[1:node.d - 1]
"""

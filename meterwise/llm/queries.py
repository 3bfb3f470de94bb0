"""Registered queries of the ten operators, with DuckDB text where SQL can say the same.

Each query applies its operator, with production parameters, to its whole table.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterwise.llm.decontaminate import find_benchmark_text
from meterwise.llm.html_extract import extract_main_text
from meterwise.llm.lang_id import identify_languages
from meterwise.llm.line_dedup import WHOLE, dedup_lines
from meterwise.llm.mixing import mix_sources
from meterwise.llm.near_dup import near_duplicate_groups
from meterwise.llm.prefix_trie import conversation_trie
from meterwise.llm.quality_classifier import classify_quality
from meterwise.llm.quality_rules import quality_by_rules
from meterwise.llm.token_counts import load_vocabulary, token_counts
from meterwise.llm.toxicity import score_toxicity
from meterwise.llm.warc import read_archives, write_archives
from meterwise.llm.whitening import whiten_embeddings

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(name: str, oracle: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle.strip()
        return fn
    return register


@query("op6_minhash_near_dedup", r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN []
                        WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                        ELSE list_distinct([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)]) END AS s FROM words),
sized AS (SELECT doc_id, s, len(s) AS n FROM sets),
items AS (SELECT doc_id, n, unnest(s) AS x FROM sized),
pairs AS (
    SELECT a.doc_id AS u, b.doc_id AS v FROM items a JOIN items b ON a.x = b.x AND a.doc_id < b.doc_id
    GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
links AS (SELECT u, v FROM pairs UNION ALL SELECT v, u FROM pairs),
reach(doc_id, other) AS (
    SELECT doc_id, doc_id FROM sized UNION SELECT r.doc_id, l.v FROM reach r JOIN links l ON l.u = r.other),
comp AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT s.doc_id, CAST(s.n AS BIGINT) AS n_shingles, c.component_id, s.doc_id = c.component_id AS kept
FROM sized s JOIN comp c USING (doc_id)
""")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_groups(table(spark, sf_dir, "documents"))


@query("op7_line_dedup")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents"), **WHOLE).select(
        "doc_id", "n_lines", "n_exact", "n_near", "emptied", "text")


@query("op10_decontaminate", r"""
WITH norm AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
item AS (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
windows AS (
    SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS x
    FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM item WHERE len(w) > 0)),
lengths AS (SELECT DISTINCT n FROM windows),
grams AS (
    SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS x
    FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM norm, lengths WHERE len(w) >= n)),
hits AS (SELECT g.doc_id, g.i, g.n, v.item_id FROM grams g JOIN windows v ON g.n = v.n AND g.x = v.x),
hit_words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
hit_items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hits WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(h.n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(t.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(t.ids, '')) AS items_sha256,
       coalesce(h.n_hit, 0) > 0 AS contaminated
FROM norm d LEFT JOIN hit_words h USING (doc_id) LEFT JOIN hit_items t USING (doc_id)
""")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_benchmark_text(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


@query("op5_quality_rules")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_by_rules(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality")


@query("op2_mix_sources")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query("op3_warc", r"""
WITH p AS (
    SELECT page_id, coalesce(html, '') AS h, sha1(coalesce(html, '')) AS payload_digest,
           CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes FROM pages),
w AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS last FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id < last THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id < last THEN last END AS refers_to
FROM w
""")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, manifest = write_archives(table(spark, sf_dir, "pages"))
    return read_archives(spark, folder, manifest).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op4_token_counts")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = load_vocabulary(os.environ.get("TOKENIZER_MODEL", "/opt/tokenizers/piece_bpe_32k.model"))
    return token_counts(table(spark, sf_dir, "documents"), vocabulary)


@query("op1_language_id")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_languages(table(spark, sf_dir, "documents"))


@query("op8_quality_classifier")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return classify_quality(docs, table(spark, sf_dir, "labels")).drop("text")


@query("op9_html_main_text")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(table(spark, sf_dir, "pages"))


@query("op12_embedding_whitening")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whiten_embeddings(table(spark, sf_dir, "embeddings"))
    return found.select("vec_id", "n", "deviation", "identity_error",
                        F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "of")).select(
        "vec_id", (F.col("at") + 1).alias("component"), "n", "deviation", "of.whitened", "of.explained", "identity_error")


@query("op13_toxicity")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return score_toxicity(docs, table(spark, sf_dir, "labels")).drop("text")


@query("op11_conversation_trie", r"""
WITH t AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
numbered AS (
    SELECT conv_id, x, bytes, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, x) - 1 AS p
    FROM (SELECT *, md5(concat(octet_length(encode(role)), ':', role, text)) AS x, octet_length(encode(text)) AS bytes FROM t)),
ids AS (
    SELECT conv_id, CAST(conv_id AS VARCHAR) AS s FROM (SELECT DISTINCT conv_id FROM t)),
cut AS (
    -- crc32 bit by bit over the characters of the decimal id
    SELECT conv_id, xor(list_reduce(list_prepend(4294967295::BIGINT, range(8 * length(s))), lambda c, i:
               CASE WHEN i % 8 = 0 THEN xor(xor(c, ord(s[i // 8 + 1])::BIGINT) >> 1, 3988292384 * (xor(c, ord(s[i // 8 + 1])::BIGINT) & 1))
                    ELSE xor(c >> 1, 3988292384 * (c & 1)) END), 4294967295) % 9 AS h FROM ids),
turns AS (
    SELECT c.conv_id, 0 AS part, n.p, n.x, n.bytes FROM cut c JOIN numbered n ON n.conv_id = c.conv_id - c.conv_id % 5 AND n.p < c.h
    UNION ALL
    SELECT c.conv_id, 1, n.p, n.x, n.bytes FROM cut c JOIN numbered n ON n.conv_id = c.conv_id AND n.p >= c.h),
seqs AS (
    SELECT c.conv_id, coalesce(list(t.x ORDER BY part, p) FILTER (WHERE t.x IS NOT NULL), []) AS xs,
           coalesce(list(t.bytes ORDER BY part, p) FILTER (WHERE t.x IS NOT NULL), []) AS bs
    FROM cut c LEFT JOIN turns t USING (conv_id) GROUP BY c.conv_id),
paths AS (
    SELECT conv_id, d, array_to_string(xs[1:d], ',') AS k, coalesce(bs[d], 0) AS bytes, d = len(xs) AS ends
    FROM (SELECT conv_id, xs, bs, unnest(range(len(xs) + 1)) AS d FROM seqs)),
nodes AS (
    SELECT d, k, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * max(bytes) AS own,
           sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
    FROM paths GROUP BY d, k),
links AS (
    SELECT n.d, n.k, p.k AS parent FROM nodes n JOIN paths p ON p.conv_id = n.conv_id AND p.d = n.d - 1),
children AS (SELECT d - 1 AS d, parent AS k, count(*) AS n FROM links GROUP BY ALL),
own AS (
    SELECT n.*, coalesce(c.n, 0) AS n_children FROM nodes n LEFT JOIN children c USING (d, k)),
totals AS (
    SELECT p.d, p.k, sum(o.own) AS saved, count(*) FILTER (WHERE o.n_children = 0) AS n_leaves
    FROM own o JOIN paths p ON p.conv_id = o.conv_id AND p.d <= o.d GROUP BY p.d, p.k)
SELECT o.conv_id, CAST(o.d AS BIGINT) AS depth, q.conv_id AS parent_conv_id, o.n_convs, CAST(o.n_children AS BIGINT) AS n_children,
       CAST(t.n_leaves AS BIGINT) AS n_leaves, CAST(t.saved AS BIGINT) AS saved_tokens, o.ends_sha256
FROM own o JOIN totals t USING (d, k) LEFT JOIN links l USING (d, k) LEFT JOIN nodes q ON q.d = o.d - 1 AND q.k = l.parent
""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(table(spark, sf_dir, "conversations"))

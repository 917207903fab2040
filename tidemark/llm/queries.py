"""Registered queries of the training-data operators, with the SQL of those that SQL can express."""

from __future__ import annotations

import public_tokenizers

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.decontamination import find_leaks
from tidemark.llm.divergence import source_divergence
from tidemark.llm.exact_dedup import exact_dedup
from tidemark.llm.line_dedup import line_dedup_report
from tidemark.llm.lm_scoring import score_texts
from tidemark.llm.minhash import near_duplicates_by_sets
from tidemark.llm.packing import pack
from tidemark.llm.pii import find_personal_data
from tidemark.llm.simhash import near_duplicates
from tidemark.llm.substring_dedup import dedup_passages
from tidemark.llm.token_counts import count_tokens
from tidemark.llm.toxicity import CATEGORIES, toxicity
from tidemark.llm.whitening import whiten


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return find_leaks(_table(spark, folder, "documents"), _table(spark, folder, "benchmark")).drop("version")


def op2_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup(_table(spark, folder, "documents"))


def op3_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(_table(spark, folder, "documents"), shingle=3, distance=2)


def op4_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return count_tokens(_table(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model"), limit=4096)


def op5_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack(_table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"), longest=1024)


def op6_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return score_texts(_table(spark, folder, "documents"))


def op7_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    return find_personal_data(_table(spark, folder, "documents"))


def op8_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup_report(_table(spark, folder, "documents"))


def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity(_table(spark, folder, "documents"), _table(spark, folder, "labels"), CATEGORIES).drop("version")


def op10_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return dedup_passages(_table(spark, folder, "documents"), window=13)


def op11_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates_by_sets(_table(spark, folder, "documents"), shingle=5, percent=85)


def op12_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whiten(_table(spark, folder, "embeddings"), components=32)


def op13_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return source_divergence(_table(spark, folder, "documents"), min_docs=10, top_terms=10)


QUERIES = {
    "op1_decontamination": op1_decontamination,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_simhash": op3_simhash,
    "op4_token_counts": op4_token_counts,
    "op5_packing": op5_packing,
    "op6_lm_scoring": op6_lm_scoring,
    "op7_personal_data": op7_personal_data,
    "op8_line_dedup": op8_line_dedup,
    "op9_toxicity": op9_toxicity,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_minhash": op11_minhash,
    "op12_whitening": op12_whitening,
    "op13_source_divergence": op13_source_divergence,
}

ORACLES = {
    # Of all windows that share a run of five words with an item; the SQL needs no SimHash to find them.
    "op1_decontamination": r"""
        WITH d AS (
            SELECT doc_id, list_filter(string_split_regex(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^0-9a-z\x{80}-\x{10FFFF}]+'), lambda w: w <> '') AS words
            FROM documents),
        b AS (
            SELECT item_id, list_filter(string_split_regex(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^0-9a-z\x{80}-\x{10FFFF}]+'), lambda w: w <> '') AS words
            FROM benchmark),
        items AS (SELECT item_id, words, len(words) AS n, least(5, n) AS size, n - size + 1 AS runs FROM b WHERE n > 0),
        item_places AS (SELECT *, unnest(range(1, runs + 1)) AS place FROM items),
        item_runs AS (
            SELECT item_id, n, size, runs, array_to_string(words[place : place + size - 1], ' ') AS run, count(*) AS times
            FROM item_places GROUP BY ALL),
        sizes AS (SELECT DISTINCT size FROM items),
        doc_places AS (
            SELECT doc_id, words, size, unnest(range(1, len(words) - size + 2)) AS place FROM d, sizes WHERE len(words) >= size),
        doc_runs AS (
            SELECT doc_id, size, place, len(words) AS length, array_to_string(words[place : place + size - 1], ' ') AS run FROM doc_places),
        hits AS (SELECT doc_id, item_id, n, size, runs, length, place FROM doc_runs JOIN item_runs USING (size, run)),
        near AS (SELECT *, unnest(range(place - runs + 1, place + 1)) AS near FROM hits),
        starts AS (
            SELECT DISTINCT doc_id, item_id, n, size, runs, length, least(greatest(near, 1), greatest(length - n, 0) + 1) AS start FROM near),
        bags AS (
            SELECT s.doc_id, item_id, n, size, runs, s.length, start, run, count(*) AS times
            FROM starts s JOIN doc_runs r USING (doc_id, size)
            WHERE r.place BETWEEN start AND start + runs - 1 GROUP BY ALL),
        shared AS (
            SELECT doc_id, item_id, g.n, start, g.length, g.runs, least(g.runs, g.length - g.size + 1) AS own,
                   sum(least(g.times, i.times)) AS common
            FROM bags g JOIN item_runs i USING (item_id, run) GROUP BY ALL),
        scored AS (SELECT *, CAST(common AS DOUBLE) / CAST(own + runs - common AS DOUBLE) AS similarity FROM shared)
        SELECT doc_id, item_id, CAST(arg_max(start, (similarity, -start)) - 1 AS INTEGER) AS start, CAST(min(least(n, length)) AS INTEGER) AS n_words,
               max(similarity) AS similarity, CAST(count(*) AS INTEGER) AS n_windows
        FROM scored WHERE similarity >= 0.8 GROUP BY doc_id, item_id
    """,
    "op2_exact_dedup": r"""
        WITH rows AS (
            SELECT doc_id, length(coalesce(text, '')) AS points,
                   sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) AS text_sha256
            FROM documents)
        SELECT doc_id, first_value(doc_id) OVER best AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
               doc_id = first_value(doc_id) OVER best AS kept, text_sha256
        FROM rows WINDOW best AS (PARTITION BY text_sha256 ORDER BY points DESC, doc_id)
    """,
    "op10_substring_dedup": r"""
        WITH d AS (
            SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words
            FROM documents),
        w AS (SELECT doc_id, generate_subscripts(words, 1) AS place, unnest(words) AS word, words FROM d),
        windows AS (
            SELECT doc_id, place, array_to_string(words[place : place + 12], ' ') AS run FROM w WHERE place + 12 <= len(words)),
        firsts AS (SELECT run, min(doc_id) AS first FROM windows GROUP BY run),
        later AS (SELECT doc_id, place FROM windows JOIN firsts USING (run) WHERE first < doc_id),
        marked AS (
            SELECT w.doc_id, w.place, word,
                   count(later.place) OVER (PARTITION BY w.doc_id ORDER BY w.place ROWS BETWEEN 12 PRECEDING AND CURRENT ROW) > 0 AS gone
            FROM w LEFT JOIN later ON later.doc_id = w.doc_id AND later.place = w.place),
        kept AS (
            SELECT doc_id, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY place) FILTER (NOT gone) AS text
            FROM marked GROUP BY doc_id)
        SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
        FROM d LEFT JOIN kept USING (doc_id)
    """,
    # Links are found by joining whole sets, and followed to the smallest id that each document reaches.
    "op11_minhash": r"""
        WITH RECURSIVE d AS (
            SELECT doc_id, list_filter(string_split_regex(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words
            FROM documents),
        places AS (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 4, 1) + 1)) AS place FROM d WHERE len(words) > 0),
        s AS (SELECT DISTINCT doc_id, array_to_string(words[place : place + 4], ' ') AS shingle FROM places),
        sizes AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM s a JOIN s b USING (shingle) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
        links AS (
            SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
            WHERE 100 * common.n >= 85 * (x.n + y.n - common.n)),
        reach AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b)
        SELECT d.doc_id, coalesce(sizes.n, 0) AS n_shingles, min(b) AS component_id, d.doc_id = min(b) AS kept
        FROM d JOIN reach ON reach.a = d.doc_id LEFT JOIN sizes ON sizes.doc_id = d.doc_id GROUP BY d.doc_id, sizes.n
    """,
    "op13_source_divergence": r"""
        WITH d AS (
            SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
            FROM documents),
        t AS (SELECT doc_id, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
        kept AS (SELECT lang, term, count(*) AS n FROM t GROUP BY ALL HAVING count(DISTINCT doc_id) >= 10),
        groups AS (SELECT DISTINCT lang, source FROM d),
        counts AS (SELECT lang, source, term, count(*) AS n FROM t GROUP BY ALL),
        cells AS (
            SELECT lang, source, term, coalesce(counts.n, 0) AS n
            FROM groups JOIN kept USING (lang) LEFT JOIN counts USING (lang, source, term)),
        p AS (
            SELECT lang, source, term, n,
                   1 + 1000000000::HUGEINT * (n + 2) // (sum(n) OVER g + 2 * count(*) OVER g) AS p
            FROM cells WINDOW g AS (PARTITION BY lang, source)),
        q AS (
            SELECT lang, term, 1 + 1000000000::HUGEINT * (n + 2) // (sum(n) OVER g + 2 * count(*) OVER g) AS q
            FROM kept WINDOW g AS (PARTITION BY lang)),
        sums AS (
            SELECT lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
            FROM p a JOIN p b USING (lang, term) WHERE a.source <> b.source GROUP BY ALL),
        pairs AS (
            SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
            FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
            LEFT JOIN sums ON sums.lang = a.lang AND sums.source = a.source AND sums.item = b.source),
        terms AS (
            SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // (p + q) AS value
            FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q),
        ranked AS (
            SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
            FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
        SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
        FROM ranked WHERE part = 'pair' OR rank <= 10
    """,
}

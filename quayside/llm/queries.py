"""One registered query per operator, over whole tables, and its DuckDB SQL
where SQL can express it."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.context import ensure_checkpoint_dir
from quayside.llm import (
    conversation_trie, exact_dedup, line_quality, mixing, packing, parity_join, periodic_runs, simhash, suffix_dedup, token_counts, token_files,
    url_rules, word_windows,
)
from quayside.llm.common import documents, let, text_of, words

BYTE_BPE = "byte_bpe_50k.json"
PIECE_BPE = "piece_bpe_32k.model"


def op1_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_quality.judge(documents(spark, sf_dir)).drop("host_key", "text_key")


def op2_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    rules = url_rules.mine(pages, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return url_rules.judge(pages, rules)


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(documents(spark, sf_dir), public_tokenizers.path(PIECE_BPE))


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/token-files/{uuid.uuid4().hex}"
    token_files.write(documents(spark, sf_dir), public_tokenizers.path(BYTE_BPE), folder, end_id=2, vocabulary=50_257)
    return token_files.read(spark.read.parquet(folder))


def op5_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir)).drop("source")


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir))


def op7_word_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_windows.remove_repeats(documents(spark, sf_dir))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(documents(spark, sf_dir))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.deduplicate(documents(spark, sf_dir))


def op10_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), public_tokenizers.path(BYTE_BPE))


def _crc32(number: Column) -> Column:
    return F.crc32(number.cast("string").cast("binary"))


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    nodes = conversation_trie.trie(conversations, lambda c: (c - c % 100, _crc32(c) % 6), longest=5)
    return nodes.withColumnRenamed("saved", "saved_tokens")


def looped(docs: DataFrame) -> DataFrame:
    """Documents, a tenth of them with the contract's loop from word ``a`` on.
    A row without doc_id has no loop."""
    h = _crc32(F.col("doc_id"))
    g = F.floor(h / 10)

    def loop(w: Column) -> Column:
        n = F.size(w).cast("long")
        a = g % n
        at = F.struct(a.alias("a"), (1 + F.floor((n - a) / (3 + g % 8))).alias("p"))
        each = let(at, lambda s: F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.get(
            w, F.when(i < s["a"], i).otherwise(s["a"] + (i - s["a"]) % s["p"]).cast("int"))))
        return F.when(n > 0, F.array_join(each, " ")).otherwise(F.lit(""))

    text = text_of()
    return docs.select("doc_id", F.when(h % 10 == 0, let(words(text), loop)).otherwise(text).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.collapse(looped(documents(spark, sf_dir)))
    none = F.lit(None).cast("struct<start: long, length: long, period: long>")
    best = F.reduce("runs", none, lambda b, r: F.when(
        b.isNull() | (r["length"] * b["period"] > b["length"] * r["period"]), r).otherwise(b))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("kept", 256).alias("collapsed_sha256"))


def op13_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parity_join.near_duplicates(documents(spark, sf_dir))


QUERIES = {
    "op1_line_quality": op1_line_quality,
    "op2_url_rules": op2_url_rules,
    "op3_token_counts": op3_token_counts,
    "op4_token_files": op4_token_files,
    "op5_mix": op5_mix,
    "op6_simhash": op6_simhash,
    "op7_word_windows": op7_word_windows,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_pack": op10_pack,
    "op11_conversation_trie": op11_conversation_trie,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_ngram_jaccard": op13_ngram_jaccard,
}

_BLANK = "chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13)"

SQL = {
    "op1_line_quality": rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(source, chr(0)) AS host, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT rid, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM d
), grams AS (
  SELECT rid, i, ws[i] || ' ' || ws[i+1] || ' ' || ws[i+2] AS g
  FROM (SELECT rid, ws, unnest(generate_series(1, len(ws) - 2)) AS i FROM w WHERE len(ws) >= 3)
), twice AS (
  SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS n FROM grams) WHERE n > 1
), covered AS (
  SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest([i, i+1, i+2]) AS p FROM twice) GROUP BY rid
), lines AS (
  SELECT rid, unnest(string_split(t, chr(10))) AS line FROM d
), dup AS (
  SELECT rid, count(*) - count(DISTINCT line) AS n FROM lines
  WHERE translate(line, {_BLANK}, '') <> '' GROUP BY rid
), norm AS (
  SELECT l.rid, d.host, d.t, trim(regexp_replace(translate(lower(line), '123456789', '000000000'), '[\x20\x09\x0B-\x0D]+', ' ', 'g')) AS line
  FROM lines l JOIN d USING (rid)
), hosts AS (SELECT host, count(DISTINCT t) AS n FROM d GROUP BY host
), heavy AS (
  SELECT host, line FROM (SELECT host, line, count(DISTINCT t) AS n FROM norm WHERE line <> '' GROUP BY host, line) x
  JOIN hosts h USING (host) WHERE x.n > 50 AND x.n > h.n * 0.05
), gone AS (
  SELECT rid, count(*) AS lines, sum(len(string_split(line, ' '))) AS words FROM norm JOIN heavy USING (host, line) GROUP BY rid
), m AS (
  SELECT d.doc_id, len(w.ws) AS n_words, length(translate(t, {_BLANK}, '')) AS word_chars,
         length(t) - length(translate(t, '#*$%&|<>', '')) AS n_symbols, coalesce(dup.n, 0) AS n_dup_lines,
         coalesce(covered.n, 0) AS n_repeat_words, coalesce(gone.lines, 0) AS removed_lines,
         coalesce(gone.words, 0)::BIGINT AS removed_words
  FROM d JOIN w USING (rid) LEFT JOIN dup USING (rid) LEFT JOIN covered USING (rid) LEFT JOIN gone USING (rid)
)
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, removed_words > n_words * 0.5 AS depleted,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND NOT removed_words > n_words * 0.5 AS kept
FROM m
""",
    "op5_mix": r"""
WITH d AS (
  SELECT doc_id, source, len(list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> ''))::BIGINT AS size,
         md5('42:' || coalesce(doc_id::VARCHAR, 'null')) AS turn FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source
), r AS (
  SELECT *, [1, 2, 3][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3)::INT + 1]::BIGINT AS weight FROM s
), o AS (
  SELECT *, coalesce(sum(3 * source_size) OVER o, 0) AS cap_before, coalesce(sum(weight) OVER o, 0) AS weight_before,
         sum(source_size) OVER () AS total, sum(weight) OVER () AS weights
  FROM r WINDOW o AS (ORDER BY source_size * 6 / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), f AS (
  SELECT *, weight * (total - cap_before) > 3 * source_size * (weights - weight_before) AS clamped FROM o
), l AS (
  SELECT any_value(total) - coalesce(sum(3 * source_size) FILTER (clamped), 0) AS rest, sum(weight) FILTER (NOT clamped) AS level FROM f
), g AS (
  SELECT source, source_size, CASE WHEN clamped THEN (3 * source_size)::DOUBLE
         ELSE weight::DOUBLE * rest::DOUBLE / level::DOUBLE END AS target FROM f, l
), p AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS whole FROM g
), x AS (
  SELECT d.*, p.source_size, p.target, p.whole, p.target - p.whole * p.source_size AS part,
         coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY turn, size, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + size / 2 AS middle
  FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source
)
SELECT doc_id, size, source_size, target, whole + (CASE WHEN part > 0 AND middle <= part THEN 1 ELSE 0 END) AS reps,
       size * (whole + (CASE WHEN part > 0 AND middle <= part THEN 1 ELSE 0 END)) AS taken
FROM x
""",
    "op9_exact_dedup": """
WITH d AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS h FROM documents
), g AS (
  SELECT doc_id, h, max(doc_id) OVER (PARTITION BY h) AS keep_id, count(*) OVER (PARTITION BY h) AS group_size,
         row_number() OVER (PARTITION BY h, doc_id) AS i FROM d
)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AND i = 1 AS kept, h AS text_sha256 FROM g
""",
    "op11_conversation_trie": """
WITH t AS (
  SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha) AS i, sha, chars
  FROM (SELECT conv_id, turn, length(coalesce(text, '')) AS chars,
               sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS sha
        FROM conversations WHERE conv_id IS NOT NULL)
), convs AS (
  SELECT c, count(*) AS own, c - c % 100 AS base,
         xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(c::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
             lambda a, x: list_reduce(list_prepend(xor(a, x), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
               lambda b, z: CASE WHEN b & 1 = 1 THEN xor(b >> 1, 3988292384::BIGINT) ELSE b >> 1 END)), 4294967295::BIGINT) % 6 AS h
  FROM t GROUP BY c
), v AS (
  SELECT x.*, least(x.h, coalesce(b.own, 0)) AS m FROM convs x LEFT JOIN convs b ON b.c = x.base
), rebuilt AS (
  SELECT v.c, i AS d, sha, chars FROM v JOIN t ON t.c = v.base AND i <= v.h
  UNION ALL
  SELECT v.c, i - h + m, sha, chars FROM v JOIN t ON t.c = v.c AND i > v.h
), paths AS (
  SELECT c, d, chars, string_agg(sha, '') OVER (PARTITION BY c ORDER BY d) AS k FROM rebuilt
  UNION ALL
  SELECT c, 0, 0, '' FROM v
), sizes AS (SELECT c, max(d) AS n FROM paths GROUP BY c
), nodes AS (
  SELECT k, d, max(chars) AS chars, min(c) AS conv_id, count(*) AS n_convs, string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (d = n) AS ends
  FROM paths JOIN sizes USING (c) GROUP BY k, d
), kids AS (SELECT substr(k, 1, 64 * (d - 1)) AS k, count(*) AS n FROM nodes WHERE d > 0 GROUP BY ALL
), w AS (
  SELECT nodes.*, coalesce(kids.n, 0) AS n_children FROM nodes LEFT JOIN kids USING (k)
), sums AS (
  SELECT a.k, count(*) FILTER (n_children = 0) AS n_leaves, sum((n_convs - 1) * w.chars)::BIGINT AS saved_tokens
  FROM w JOIN paths a ON a.c = w.conv_id AND a.d <= w.d GROUP BY a.k
)
SELECT w.conv_id, w.d::BIGINT AS depth, p.conv_id AS parent_conv_id, w.n_convs, w.n_children, n_leaves, saved_tokens,
       sha256(coalesce(w.ends, '')) AS ends_sha256
FROM w JOIN sums USING (k) LEFT JOIN w p ON w.d > 0 AND p.k = substr(w.k, 1, 64 * (w.d - 1))
""",
    "op13_ngram_jaccard": r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS rid, doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM documents
), s AS (
  SELECT DISTINCT rid, ws[i] || ' ' || ws[i+1] || ' ' || ws[i+2] || ' ' || ws[i+3] AS g
  FROM (SELECT rid, ws, unnest(generate_series(1, len(ws) - 3)) AS i FROM d WHERE len(ws) >= 4)
  UNION ALL
  SELECT rid, array_to_string(ws, ' ') FROM d WHERE len(ws) BETWEEN 1 AND 3
), n AS (SELECT rid, count(*) AS n FROM s GROUP BY rid
), pairs AS (SELECT a.rid AS x, b.rid AS y, count(*) AS shared FROM s a JOIN s b ON a.g = b.g AND a.rid < b.rid GROUP BY ALL
), links AS (
  SELECT x, y FROM pairs JOIN n a ON a.rid = x JOIN n b ON b.rid = y WHERE 100 * shared >= 85 * (a.n + b.n - shared)
), both_ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links
), reach(x, y) AS (SELECT rid, rid FROM d UNION SELECT r.x, b.y FROM reach r JOIN both_ways b ON r.y = b.x
)
SELECT d.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(o.doc_id) AS component_id
FROM d LEFT JOIN n USING (rid) JOIN reach ON reach.x = d.rid JOIN d o ON o.rid = reach.y GROUP BY d.rid, d.doc_id
""",
}

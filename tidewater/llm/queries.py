"""One query per operator of this subpackage, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, kd_sharding, language_crf, packing, ppm, quality_rules, ranked_search, secret_scan, simhash, spelling, suffix_dedup, token_counts, toxicity
from .common import fold, read_table


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest_pieces(packing.pack_documents(read_table(spark, sf_dir, "documents")))


def digest_pieces(packed: DataFrame) -> DataFrame:
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id",
                         "offset", "tier", "step_group")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.context_totals(token_counts.length_histogram(read_table(spark, sf_dir, "documents")))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), "contaminated")


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(read_table(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
                         "votes", "posterior")


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.remove_repeats(read_table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return out.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = kd_sharding.shard_documents(read_table(spark, sf_dir, "documents"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(read_table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
                        F.sha2(secret_scan.span_text(F.col("base")), 256).alias("base_sha256"),
                        secret_scan.span_text(F.col("spans")).alias("spans"))


def op8_ppm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm.score(read_table(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents")
    model = toxicity.fit(documents, read_table(spark, sf_dir, "labels"))
    return toxicity.score(documents, model).select("doc_id", (fold("doc_id") == 0).alias("held_out"), "score", "predicted")


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("mark"), 16, "0")).alias("fingerprint"), "component_id")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(read_table(spark, sf_dir, "documents"))


def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents")
    return language_crf.predict(documents, language_crf.fit(documents))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = ranked_search.build_index(read_table(spark, sf_dir, "documents"))
    return ranked_search.search(index, read_table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_packing, op2_token_counts, op3_decontamination, op4_quality_rules, op5_suffix_dedup, op6_sharding,
                            op7_secret_scan, op8_ppm_scores, op9_toxicity, op10_simhash, op11_spelling_variants,
                            op12_language_id, op13_ranked_search)}

#: DuckDB SQL of the benchmark decontamination query.
_OP3 = r"""
WITH cut AS (
  SELECT row_number() OVER () AS r, doc_id,
         list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                     '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM documents),
items AS (
  SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                     '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS k, array_to_string(w[s : s + least(len(w), 10) - 1], ' ') AS passage
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS s FROM items WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT k FROM windows),
places AS (
  SELECT r, doc_id, s, k, array_to_string(w[s : s + k - 1], ' ') AS passage
  FROM (SELECT r, doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS s FROM cut, sizes WHERE len(w) >= k)),
hits AS (SELECT r, s, k, item_id FROM places JOIN windows USING (k, passage)),
covered AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(s, s + k)) AS p FROM hits) GROUP BY r),
named AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
          FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM cut LEFT JOIN covered USING (r) LEFT JOIN named USING (r)
"""

#: DuckDB SQL of the spelling variants: the checksum by its table (one entry per
#: byte value, eight steps of the reflected polynomial), near words by the keys
#: that leave one character out.
_OP11 = r"""
WITH RECURSIVE steps AS MATERIALIZED (
  SELECT list(v ORDER BY i) AS crc FROM (
    SELECT i, list_reduce([i] || range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
    FROM range(256) AS r(i))),
runs AS (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]{7,}')) AS run FROM documents)
  GROUP BY 1, 2),
marked AS (
  SELECT run, n, xor(4294967295, list_reduce([4294967295] || list_transform(range(length(h) // 2),
           lambda i: CAST('0x' || substr(h, CAST(2 * i + 1 AS BIGINT), 2) AS BIGINT)),
           lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1]))) AS mark
  FROM (SELECT run, n, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)) AS h FROM runs), steps),
words AS MATERIALIZED (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
    SELECT CASE WHEN mark % 31 = 0 THEN substr(run, 1, mark % length(run)) || substr(run, mark % length(run) + 2) ELSE run END AS word, n
    FROM marked)
  GROUP BY word HAVING sum(n) >= 2 AND length(word) >= 7),
gaps AS (SELECT word, n, i, substr(word, 1, i) || '$' || substr(word, i + 2) AS rest
         FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)),
wholes AS (SELECT word, n, substr(word, 1, i) || '$' || substr(word, i + 1) AS rest
           FROM (SELECT word, n, unnest(range(length(word) + 1)) AS i FROM words)),
pairs AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM gaps a JOIN gaps b ON a.rest = b.rest AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM gaps a JOIN wholes b ON a.rest = b.rest
  UNION SELECT a.word, b.word, b.n FROM wholes a JOIN gaps b ON a.rest = b.rest),
best AS (SELECT word, count(*) AS n_near, first(near ORDER BY near_n DESC, near) AS near, max(near_n) AS near_n FROM pairs GROUP BY word),
forms AS MATERIALIZED (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 10 * w.n THEN near END AS form,
         CASE WHEN near_n >= 10 * w.n THEN near_n END AS form_n
  FROM words w LEFT JOIN best USING (word)),
walk AS (
  SELECT word, word AS at FROM forms
  UNION SELECT walk.word, forms.form FROM walk JOIN forms ON forms.word = walk.at WHERE forms.form IS NOT NULL)
SELECT forms.word, forms.form, walk.at AS root, forms.n, forms.n_near, forms.form_n
FROM forms JOIN walk ON walk.word = forms.word JOIN forms ends ON ends.word = walk.at AND ends.form IS NULL
"""

#: DuckDB SQL of the ranked search.
_OP13 = r"""
WITH terms AS (
  SELECT r, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT row_number() OVER () AS r, doc_id, text FROM documents)),
freq AS (SELECT r, doc_id, term, count(*) AS tf FROM terms GROUP BY ALL),
sizes AS (SELECT r, CAST(sum(tf) AS BIGINT) AS n FROM freq GROUP BY r),
total AS (SELECT count(*) AS nd, CAST(sum(n) AS BIGINT) AS nt FROM sizes),
weights AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(nd) + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
            FROM freq, total GROUP BY term),
asked AS (
  SELECT DISTINCT q, item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT row_number() OVER () AS q, item_id, text FROM benchmark)),
scored AS (
  SELECT q, item_id, r, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * nd) // nt)))) AS BIGINT) AS score
  FROM asked JOIN weights USING (term) JOIN freq USING (term) JOIN sizes USING (r), total GROUP BY q, item_id, r, doc_id)
SELECT item_id, CAST(row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST, r) AS INTEGER) AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 10
"""

ORACLE: dict[str, str] = {"op3_decontamination": _OP3, "op11_spelling_variants": _OP11, "op13_ranked_search": _OP13}

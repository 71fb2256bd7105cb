"""The registered queries of the corpus operators, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stridelog.llm import (
    bpe, decontaminate, html_extract, license_scan, line_dedup, mixing, near_dedup, neighbours,
    quality, sharding, spelling, substring_dedup, whitening,
)
from stridelog.llm.common import prepare, table
from stridelog.session import configure


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(prepare(configure(spark)), sf_dir, "documents")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(_documents(spark, sf_dir)).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


OP1_SQL = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), windows AS (
  SELECT doc_id, i, array_to_string(ws[i:i + 34], ' ') AS w
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 33)) AS i FROM words WHERE len(ws) >= 35)
), repeated AS (
  SELECT w FROM windows GROUP BY w HAVING count(*) > 1
), gone AS (
  SELECT DISTINCT doc_id, i + unnest(range(0, 35)) AS i
  FROM windows SEMI JOIN repeated USING (w)
), each AS (
  SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM words
), kept AS (
  SELECT e.doc_id, count(*) AS n_kept, string_agg(e.word, ' ' ORDER BY e.i) AS text
  FROM each e ANTI JOIN gone g ON e.doc_id = g.doc_id AND e.i = g.i GROUP BY e.doc_id
)
SELECT w.doc_id, len(ws) AS n_words, len(ws) - coalesce(n_kept, 0) AS n_removed,
       sha256(coalesce(k.text, '')) AS kept_sha256
FROM words w LEFT JOIN kept k ON w.doc_id = k.doc_id
"""


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    return sharding.assign_shards(docs).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(_documents(spark, sf_dir)).withColumn(
        "score", F.round("score", 9))


_WORDS = (r"list_filter(string_split(regexp_replace(lower({}), '[^a-z0-9\x{{80}}-\x{{10FFFF}}]+', "
          "' ', 'g'), ' '), lambda w: w <> '')")
_BIGRAMS = ("list_distinct(list_transform(range(1, len({0})), "
            "lambda i: ({0})[i] || ' ' || ({0})[i + 1]))")


def _op3_sql() -> str:
    wordings = ", ".join("('{}', '{}')".format(name, text.replace("'", "''"))
                         for name, text in license_scan.TEMPLATES)
    return f"""
WITH wordings AS (
  SELECT license, {_BIGRAMS.format("ws")} AS bigrams
  FROM (SELECT license, {_WORDS.format("wording")} AS ws
        FROM (VALUES {wordings}) AS v(license, wording))
), lines AS (
  SELECT doc_id, i, {_WORDS.format("line")} AS ws
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
               generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents)
), filled AS (
  SELECT *, i - row_number() OVER (PARTITION BY doc_id ORDER BY i) AS paragraph
  FROM lines WHERE len(ws) > 0
), parts AS (
  SELECT doc_id, ws FROM filled
  UNION ALL
  SELECT doc_id, flatten(list(ws ORDER BY i)) FROM filled
  GROUP BY doc_id, paragraph HAVING count(*) > 1
  UNION ALL
  SELECT doc_id, flatten(list(ws ORDER BY i)) FROM filled
  GROUP BY doc_id HAVING count(DISTINCT paragraph) > 1
), sized AS (
  SELECT doc_id, {_BIGRAMS.format("ws")} AS bigrams FROM parts WHERE len(ws) > 1
), scored AS (
  SELECT doc_id, license, 2.0::DOUBLE * len(list_intersect(s.bigrams, w.bigrams))
                          / (len(s.bigrams) + len(w.bigrams)) AS score
  FROM sized s JOIN wordings w
    ON 2 * least(len(s.bigrams), len(w.bigrams)) >= 0.8 * (len(s.bigrams) + len(w.bigrams))
)
SELECT doc_id, license, round(max(score), 9) AS score, count(*) AS n_parts
FROM scored WHERE score >= 0.8 GROUP BY doc_id, license
"""


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    return line_dedup.with_kept_lines(docs).select(
        "doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_dropped").alias("n_dropped"),
        F.sha2(F.col("_kept"), 256).alias("kept_sha256"))


OP4_SQL = """
WITH lines AS (
  SELECT doc_id, line, i,
         translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i
        FROM documents)
), frequent AS (
  SELECT key FROM lines WHERE length(key) >= 1
  GROUP BY key HAVING count(DISTINCT doc_id) >= 10
), marked AS (
  SELECT doc_id, line, i, key IN (SELECT key FROM frequent) AS dropped FROM lines
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT dropped), ''))
         AS kept_sha256
FROM marked GROUP BY doc_id
"""


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(prepare(configure(spark)), sf_dir, "pages")
    return html_extract.extract(pages, keep=["page_id", "url"]).select(
        "page_id", "url", F.col("main_text").alias("text"),
        F.length("main_text").cast("long").alias("n_chars"))


def op6_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(prepare(configure(spark)), sf_dir, "embeddings")
    return neighbours.nearest(vectors, vectors.where("vec_id % 100 = 0"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.replicate(_documents(spark, sf_dir)).select(
        "doc_id", F.col("_copy").alias("copy"), "source", "lang", "n_chars", "text",
        F.round("_rate", 9).alias("rate"), F.col("_place").alias("place"))


OP7_SQL = """
WITH sizes AS (
  SELECT source, sum(strlen(coalesce(text, ''))) AS bytes FROM documents GROUP BY source
), rates AS (
  SELECT source, sqrt(bytes) / (SELECT sum(sqrt(bytes)) FROM sizes)
                 * (SELECT sum(bytes) FROM sizes) / bytes AS rate
  FROM sizes WHERE bytes > 0
), steps AS (
  SELECT source, rate, k,
         sum(exp(k * ln(rate) - rate - lgamma(k + 1)))
           OVER (PARTITION BY source ORDER BY k ROWS UNBOUNDED PRECEDING) AS p
  FROM rates, range(0, 2000) AS r(k) WHERE k <= ceil(rate + 12 * sqrt(rate) + 20)
), lists AS (
  SELECT source, rate, list(p ORDER BY k) AS ps FROM steps GROUP BY source, rate
), counted AS (
  SELECT d.*, rate, len(list_filter(ps, lambda p: p <= u)) AS n
  FROM (SELECT *, ('0x' || substr(md5('mix-count|' || doc_id || '|'
                 || coalesce(source, 'null')), 1, 13))::BIGINT / 4503599627370496.0 AS u
        FROM documents) d
  JOIN lists l ON d.source IS NOT DISTINCT FROM l.source
), copies AS (
  SELECT *, unnest(range(0, n))::INTEGER AS copy FROM counted WHERE n > 0
)
SELECT doc_id, copy, source, lang, n_chars, text, round(rate, 9) AS rate,
       ('0x' || substr(md5('mix-order|' || doc_id || '|' || coalesce(source, 'null') || '|'
                           || copy), 1, 13))::BIGINT / 4503599627370496.0 AS place
FROM copies
"""


def op8_repetition_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.repetition_report(_documents(spark, sf_dir))


def _op8_sql() -> str:
    rules = quality.RepetitionRules()
    lengths = sorted(rules.ngram_chars)
    grams = ", ".join(f"CASE WHEN i + {n - 1} <= n THEN array_to_string(ws[i:i + {n - 1}], ' ') "
                      f"END AS g{n}" for n in (3, *lengths))
    found = ", ".join(
        f"g{n} IS NOT NULL AND row_number() OVER (PARTITION BY doc_id, g{n} ORDER BY i) > 1 AS a{n}"
        for n in lengths)
    covered = ", ".join(
        f"bool_or(a{n}) OVER (PARTITION BY doc_id ORDER BY i ROWS {n - 1} PRECEDING) AS c{n}"
        for n in lengths)
    chars = ", ".join(f"coalesce(sum(length(w)) FILTER (WHERE c{n}), 0)::BIGINT AS ngram_chars_{n}"
                      for n in lengths)
    listed = ", ".join(f"coalesce(ngram_chars_{n}, 0) AS ngram_chars_{n}" for n in lengths)
    limits = " AND ".join(f"ngram_chars_{n} <= {most}::DOUBLE * word_chars"
                          for n, most in rules.ngram_chars.items())
    return rf"""
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), placed AS (
  SELECT doc_id, i, n, ws[i] AS w, {grams}
  FROM (SELECT doc_id, ws, len(ws) AS n, unnest(range(1, len(ws) + 1)) AS i FROM texts)
), marked AS (
  SELECT doc_id, i, w, g3 IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, g3) > 1 AS a3,
         {found}
  FROM placed
), spread AS (
  SELECT doc_id, w, bool_or(a3) OVER (PARTITION BY doc_id ORDER BY i ROWS 2 PRECEDING) AS c3,
         {covered}
  FROM marked
), by_words AS (
  SELECT doc_id, count(*) AS n_words, sum(length(w))::BIGINT AS word_chars,
         count(*) FILTER (WHERE c3) AS n_repeat_words, {chars}
  FROM spread GROUP BY doc_id
), lines AS (
  SELECT doc_id, line, row_number() OVER (PARTITION BY doc_id, line) > 1 AS again
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM texts)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
), by_lines AS (
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE again) AS n_dup_lines,
         coalesce(sum(length(regexp_replace(line, '[\x20\x09-\x0D]', '', 'g')))
                  FILTER (WHERE again), 0)::BIGINT AS dup_line_chars
  FROM lines GROUP BY doc_id
), counted AS (
  SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
         coalesce(n_lines, 0) AS n_lines, coalesce(dup_line_chars, 0) AS dup_line_chars, {listed}
  FROM texts LEFT JOIN by_words USING (doc_id) LEFT JOIN by_lines USING (doc_id)
), judged AS (
  SELECT *, n_words < {rules.min_words}
            OR 100 * n_repeat_words > {rules.max_repeat_percent} * n_words AS base_failed
  FROM counted
)
SELECT *, NOT base_failed AND {limits}
          AND dup_line_chars <= {rules.line_chars}::DOUBLE * word_chars
          AND n_dup_lines <= {rules.lines}::DOUBLE * n_lines AS kept
FROM judged
"""


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    return near_dedup.near_duplicate_classes(docs)


def word_vocabulary() -> str:
    """The place of the vocabulary file that the registered query uses."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op10_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(_documents(spark, sf_dir), word_vocabulary(), keep=["doc_id"]).select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    words = spelling.word_counts(docs, typo_every=31)
    return spelling.variant_forms(words.where("n >= 2"))


def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    found = decontaminate.contamination(
        docs, table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    hit = decontaminate.n_hit()
    return found.select(
        "doc_id", F.col("_n_words").alias("n_words"), hit.alias("n_hit"),
        F.size("_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("_items", ",").cast("binary"), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"))


OP12_SQL = r"""
WITH texts AS (
  SELECT 0 AS kind, doc_id AS id, row_number() OVER () AS r, text FROM documents
  UNION ALL SELECT 1, item_id, row_number() OVER (), text FROM benchmark
), words AS (
  SELECT kind, id, r, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM texts
), windows AS (
  SELECT DISTINCT id, size, array_to_string(ws[i:i + size - 1], ' ') AS w
  FROM (SELECT id, ws, least(len(ws), 10) AS size,
               unnest(range(1, len(ws) - least(len(ws), 10) + 2)) AS i
        FROM words WHERE kind = 1 AND len(ws) > 0)
), sizes AS (
  SELECT DISTINCT size FROM windows
), places AS (
  SELECT r, i, size, array_to_string(ws[i:i + size - 1], ' ') AS w
  FROM (SELECT r, ws, size, unnest(range(1, len(ws) - size + 2)) AS i
        FROM words, sizes WHERE kind = 0 AND len(ws) >= size)
), found AS (
  SELECT r, i, size, id FROM places JOIN windows USING (size, w)
), hits AS (
  SELECT r, count(DISTINCT j) AS n_hit
  FROM (SELECT r, i + unnest(range(0, size)) AS j FROM (SELECT DISTINCT r, i, size FROM found))
  GROUP BY r
), items AS (
  SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT r, id::VARCHAR AS id FROM found) GROUP BY r
)
SELECT w.id AS doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM words w LEFT JOIN hits USING (r) LEFT JOIN items USING (r) WHERE kind = 0
"""


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(prepare(configure(spark)), sf_dir, "embeddings")
    return whitening.whiten(vectors, keep=["vec_id"]).select(
        "vec_id", "component", "n", F.col("deviation").try_cast("long").alias("deviation"),
        "whitened", "explained", "identity_error")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_sharding": op2_sharding,
    "op3_license_scan": op3_license_scan,
    "op4_line_dedup": op4_line_dedup,
    "op5_html_extraction": op5_html_extraction,
    "op6_neighbours": op6_neighbours,
    "op7_mixing": op7_mixing,
    "op8_repetition_rules": op8_repetition_rules,
    "op9_near_dedup": op9_near_dedup,
    "op10_bpe_round_trip": op10_bpe_round_trip,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_decontamination": op12_decontamination,
    "op13_whitening": op13_whitening,
}
ORACLE_SQL: dict[str, str] = {
    "op1_substring_dedup": OP1_SQL,
    "op3_license_scan": _op3_sql(),
    "op4_line_dedup": OP4_SQL,
    "op7_mixing": OP7_SQL,
    "op8_repetition_rules": _op8_sql(),
    "op12_decontamination": OP12_SQL,
}

"""The registered queries, each with its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm.common import scratch_path, table
from gridloom.llm.decontamination import contaminated
from gridloom.llm.exact_dedup import exact_groups
from gridloom.llm.jaccard_join import near_duplicates
from gridloom.llm.language_id import identify
from gridloom.llm.lexical_search import search_items
from gridloom.llm.licenses import scan_licenses
from gridloom.llm.line_dedup import dedup_lines
from gridloom.llm.packing import pack_documents
from gridloom.llm.quality_rules import quality_verdicts
from gridloom.llm.runs import collapse_runs, with_planted_runs
from gridloom.llm.sharding import shard_documents
from gridloom.llm.token_counts import DELETE, INSERT, REVISE, TokenLedger
from gridloom.llm.warc import archive_pages, read_records
from gridloom.operators.lookup import lookup_join

Query = Callable[[SparkSession, str], DataFrame]


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = dedup_lines(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "removed_lines", F.sha2("text", 256).alias("text_sha256"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    kind = pages.schema["page_id"].dataType
    return read_records(archive_pages(pages)).select(
        F.col("id").cast(kind).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        F.col("type").alias("record_type"),
        F.col("refers_to").cast(kind).alias("refers_to"),
    )


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents come in; then toxic ones go, and those of low quality come in trimmed, twice."""
    docs = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"), "source", "lang", "text"
    )
    labels = table(spark, sf_dir, "labels").withColumnRenamed("doc_id", "id")
    change = F.when(F.col("toxic") == 1, DELETE).when(F.col("quality") == 0, REVISE)
    marked = labels.select("id", change.alias("change")).where("change IS NOT NULL")
    later = lookup_join(docs, marked, ["id"], ["source", "lang"], "inner")
    later = later.withColumn("text", F.regexp_replace("text", "\\s+$", ""))
    ledger = TokenLedger(spark, scratch_path(spark, "token-ledger"))
    ledger.apply("load", docs.withColumn("change", F.lit(INSERT)))
    for _ in range(2):
        ledger.apply("clean", later)
    return ledger.totals()


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"), shards=24)


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), capacity=2048)


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), gram=4, percent=85)


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = identify(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "held_out", "lang_pred", "score")


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return quality_verdicts(documents, labels, strata=["lang"]).select("doc_id", *counts, "base_failed", "kept")


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    planted = with_planted_runs(table(spark, sf_dir, "documents"))
    best = ["start", "length", "period", "exponent_milli"]
    found = collapse_runs(planted, with_text=False).withColumn("n_runs", F.size("runs").cast("long"))
    return found.select("doc_id", "n_runs", *best, "runs_sha256", "collapsed_sha256")


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), best=10)


QUERIES: dict[str, Query] = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_license_scan": op2_license_scan,
    "op3_line_dedup": op3_line_dedup,
    "op4_warc": op4_warc,
    "op5_token_counts": op5_token_counts,
    "op6_sharding": op6_sharding,
    "op7_packing": op7_packing,
    "op8_jaccard_join": op8_jaccard_join,
    "op9_language_id": op9_language_id,
    "op10_decontamination": op10_decontamination,
    "op11_quality_rules": op11_quality_rules,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_lexical_search": op13_lexical_search,
}

SQL: dict[str, str] = {
    "op1_exact_dedup": r"""
WITH n AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm
  FROM documents),
g AS (
  SELECT doc_id, norm, min(doc_id) OVER (PARTITION BY norm) AS keep_id,
         count(*) OVER (PARTITION BY norm) AS group_size,
         row_number() OVER (PARTITION BY norm ORDER BY doc_id NULLS LAST) AS place
  FROM n)
SELECT doc_id, keep_id, group_size, place = 1 AS kept, sha256(norm) AS text_sha256 FROM g
""",
    "op4_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
g AS (
  SELECT page_id, strlen(html) AS payload_bytes, sha256(html) AS payload_digest,
         min(page_id) OVER (PARTITION BY html) AS first
  FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND first <> page_id THEN 'revisit' ELSE 'response' END
         AS record_type,
       CASE WHEN payload_bytes >= 100 AND first <> page_id THEN first END AS refers_to
FROM g
""",
    "op8_jaccard_join": r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w
  FROM documents),
grams AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS g
  FROM words, unnest(range(1, greatest(len(w) - 2, least(len(w), 1) + 1))) AS t(i)),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS i
  FROM grams x JOIN grams y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM shared JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
  WHERE 100 * i >= 85 * (p.n + q.n - i)),
reach AS (
  SELECT a, b FROM links
  UNION
  SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT d.doc_id, coalesce(any_value(s.n), 0) AS n_shingles,
       least(d.doc_id, min(r.b)) AS component_id
FROM documents d LEFT JOIN sizes s USING (doc_id) LEFT JOIN reach r ON r.a = d.doc_id
GROUP BY d.doc_id
""",
    "op11_quality_rules": r"""
WITH docs AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, doc_id, lang, coalesce(text, '') AS text FROM documents),
words AS MATERIALIZED (SELECT rid, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM docs),
windows AS (
  SELECT rid, i, array_to_string(w[i:i + 4], ' ') AS g FROM words, unnest(range(1, len(w) - 3)) AS t(i)),
twice AS (
  SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM windows) WHERE c > 1),
covered AS (SELECT rid, count(DISTINCT i + k) AS n FROM twice, unnest(range(5)) AS t(k) GROUP BY rid),
counts AS (
  SELECT rid, doc_id, lang, md5(text) AS digest, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
         strlen(text) - strlen(translate(text, '#*$%&|<>', '')) AS n_symbols,
         strlen(text) - strlen(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', '')) AS n_capitals,
         strlen(text) - strlen(translate(text, '!?', '')) AS n_marks,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
         coalesce(n, 0) AS n_repeat_words
  FROM docs JOIN words USING (rid) LEFT JOIN covered USING (rid)),
rated AS MATERIALIZED (
  SELECT *, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
         n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
         list_transform(
           [1000 * n_symbols // greatest(word_chars, 1),
            1000 * (len(lines) - len(list_distinct(lines))) // greatest(len(lines), 1),
            1000 * n_repeat_words // greatest(n_words, 1),
            10 * word_chars // greatest(n_words, 1),
            1000 - least(10 * word_chars // greatest(n_words, 1), 1000),
            1000 * n_capitals // greatest(word_chars, 1),
            1000 * n_marks // greatest(word_chars, 1)], lambda x: least(x, 1000)) AS scores
  FROM counts),
told AS (
  SELECT doc_id, min(quality) AS q FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id),
labelled AS MATERIALIZED (
  SELECT lang, digest[1] >= '8' AS holdout, min(q) > 0 AS good, any_value(scores) AS scores
  FROM rated JOIN told USING (doc_id) WHERE NOT base_failed GROUP BY lang, digest),
bins AS (
  SELECT lang, rule, scores[rule] AS score, count(*) FILTER (good) AS good, count(*) FILTER (NOT good) AS bad
  FROM labelled, unnest(range(1, 8)) AS t(rule) WHERE NOT holdout GROUP BY ALL),
tails AS (
  SELECT lang, rule, score, sum(good) OVER above AS good_tail, sum(bad) OVER above AS bad_tail,
         sum(good) OVER whole AS good_all, sum(bad) OVER whole AS bad_all
  FROM bins
  WINDOW whole AS (PARTITION BY lang, rule), above AS (PARTITION BY lang, rule ORDER BY score DESC)),
levels AS (
  SELECT i AS t, ([0.0, 0.001, 0.002, 0.005, 0.01, 0.02, 0.04]::DOUBLE[])[i + 1] AS q FROM range(7) AS r(i)),
cuts AS (
  SELECT lang, t, rule, coalesce(min(score) FILTER (
    bad_tail * good_all > 3 * good_tail * bad_all AND good_tail::DOUBLE <= q * good_all::DOUBLE), 1001) AS cut
  FROM tails, levels GROUP BY ALL),
sets AS MATERIALIZED (SELECT lang, t, list(cut ORDER BY rule) AS cut FROM cuts GROUP BY ALL),
tried AS (
  SELECT l.lang, t, holdout, good,
         list_bool_or(list_transform(range(1, 8), lambda r: l.scores[r] >= s.cut[r])) AS out
  FROM labelled l JOIN sets s ON l.lang IS NOT DISTINCT FROM s.lang),
shares AS MATERIALIZED (
  SELECT lang, t, count(*) FILTER (holdout AND good) AS n, count(*) FILTER (holdout AND good AND out) AS k,
         count(*) FILTER (NOT holdout AND NOT good AND out)::DOUBLE
           / greatest(count(*) FILTER (NOT holdout AND NOT good), 1)
         - 5 * (count(*) FILTER (NOT holdout AND good AND out)::DOUBLE
           / greatest(count(*) FILTER (NOT holdout AND good), 1)) AS gain
  FROM tried GROUP BY lang, t),
tests AS (
  SELECT lang, t, gain, n > 0 AND list_sum(list_transform(range(0, k + 1), lambda i:
           exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln(0.05) + (n - i) * ln(0.95))))
         <= 0.05 / greatest((SELECT count(DISTINCT coalesce(lang, '')) FROM shares WHERE n > 0), 1) AS ok
  FROM shares),
passed AS (
  SELECT lang, t, gain FROM (SELECT *, bool_and(ok) OVER (PARTITION BY lang ORDER BY t) AS still FROM tests)
  WHERE still AND gain > 0),
taken AS (SELECT lang, arg_max(t, struct_pack(g := gain, t := -t)) AS t FROM passed GROUP BY lang)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT coalesce(
         list_bool_or(list_transform(range(1, 8), lambda r: scores[r] >= s.cut[r])), false) AS kept
FROM rated d LEFT JOIN (SELECT s.lang, s.cut, true AS there FROM sets s JOIN taken k
                        ON s.lang IS NOT DISTINCT FROM k.lang AND s.t = k.t) s
  ON d.lang IS NOT DISTINCT FROM s.lang
""",
    "op13_lexical_search": r"""
WITH found AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t
  FROM documents),
corpus AS (SELECT count(*) AS docs, sum(len(t))::BIGINT AS total FROM found WHERE len(t) > 0),
counts AS MATERIALIZED (
  SELECT rid, doc_id, term, len(any_value(t)) AS n, count(*) AS tf
  FROM found, unnest(t) AS u(term) GROUP BY rid, doc_id, term),
weights AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
  FROM counts, corpus GROUP BY term, docs),
items AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark),
scores AS (
  SELECT item_id, rid, doc_id,
         sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // total))))::BIGINT AS score
  FROM items JOIN counts USING (term) JOIN weights USING (term), corpus GROUP BY ALL)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
FROM scores WHERE score > 0
QUALIFY rank <= 10
""",
}

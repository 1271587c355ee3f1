"""The registered queries ``opN_<name>`` and the DuckDB SQL for those that SQL can express.

Each query applies its operator, with production parameters, to whole tables and derives
the contract's columns from the operator's output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.llm import (
    align, ann, bpe, lexical, licenses, packing, quality, quality_rules, secret_scan, simhash, token_count, toxicity, url_filter,
)
from contrail.llm.labelled import held_out


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, expected_grade, tail_probability, kept."""
    docs = _table(spark, sf_dir, "documents")
    model = quality.train(docs, _table(spark, sf_dir, "labels"))
    out = quality.score(docs.select("doc_id", "text"), model, drop_text=True)
    return out.select("doc_id", held_out("doc_id").alias("held_out"), "expected_grade", "tail_probability", "kept")


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, host, path, rule, verdict, block_probability. The labelled table: the urls that a rule decides."""
    pages = _table(spark, sf_dir, "pages")
    ruled = url_filter.rule_column(url_filter.host_of(F.col("url")), url_filter.path_of(F.col("url")))
    labelled = pages.select("url", (ruled["verdict"] == url_filter.BLOCK).alias("blocked"))
    return url_filter.judge(pages, url_filter.train(labelled))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(_table(spark, sf_dir, "documents"))


def op4_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(_table(spark, sf_dir, "embeddings"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of every document before and after three edits taken from its own columns:
    its source goes in front, 40 characters at a third go, 10 at two thirds become its language."""
    docs = _table(spark, sf_dir, "documents")
    n = F.length(F.coalesce("text", F.lit("")))

    def edit(start, size, text):
        return F.struct(start.cast("int").alias("start"), (start + size).cast("int").alias("stop"), text.alias("text"))

    edits = F.array(
        edit(F.lit(0), F.lit(0), F.concat(F.col("source"), F.lit(" "))),
        edit(F.floor(n / 3), F.lit(40), F.lit("")),
        edit(F.floor(2 * n / 3), F.lit(10), F.col("lang")),
    )
    return token_count.count_with_edits(docs.select("doc_id", "text", edits.alias("edits")))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score, predicted, is_toxic (by the threshold of the document's language)."""
    docs = _table(spark, sf_dir, "documents")
    model = toxicity.train(docs, _table(spark, sf_dir, "labels"))
    out = toxicity.score(docs.select("doc_id", "text", "lang"), model, drop_text=True)
    return out.select(
        "doc_id", held_out("doc_id").alias("held_out"), F.col("toxicity").alias("score"),
        (F.col("toxicity") >= toxicity.THRESHOLD).cast("int").alias("predicted"), "is_toxic",
    )


def op7_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_table(spark, sf_dir, "documents"))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(_table(spark, sf_dir, "documents"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules.judge(_table(spark, sf_dir, "documents"))
    return out.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "host_failed"
    )


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"))


def op11_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(_table(spark, sf_dir, "documents"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.align(_table(spark, sf_dir, "documents"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


QUERIES = {
    "op1_quality_classifier": op1_quality_classifier,
    "op2_url_filters": op2_url_filters,
    "op3_simhash": op3_simhash,
    "op4_nearest_neighbours": op4_nearest_neighbours,
    "op5_token_counts": op5_token_counts,
    "op6_toxicity": op6_toxicity,
    "op7_license_scans": op7_license_scans,
    "op8_bpe": op8_bpe,
    "op9_quality_rules": op9_quality_rules,
    "op10_packing": op10_packing,
    "op11_secret_scans": op11_secret_scans,
    "op12_token_alignment": op12_token_alignment,
    "op13_lexical_search": op13_lexical_search,
}

_WORD = r"[^\x20\x09-\x0D]"
_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: The quality rules and the ranked search are plain SQL; the others hold trained models, learned codes, tokenizers or
#: iterated hashing, and tests/llm compares them with brute force.
ORACLE_SQL: dict[str, str] = {
    "op9_quality_rules": f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '{_WORD}+') AS ws FROM d),
tok AS (SELECT rid, unnest(ws) AS wd, generate_subscripts(ws, 1) AS i FROM w),
win AS (
  SELECT rid, i, wd || ' ' || lead(wd, 1) OVER p || ' ' || lead(wd, 2) OVER p || ' ' || lead(wd, 3) OVER p || ' '
    || lead(wd, 4) OVER p AS g
  FROM tok WINDOW p AS (PARTITION BY rid ORDER BY i)
),
dup AS (
  SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM win WHERE g IS NOT NULL) WHERE c > 1
),
rep AS (SELECT rid, count(DISTINCT i + k) AS n_repeat_words FROM dup, range(5) AS r(k) GROUP BY rid),
ln AS (
  SELECT rid, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT rid, unnest(string_split(t, chr(10))) AS line FROM d) WHERE regexp_matches(line, '{_WORD}') GROUP BY rid
),
m AS (
  SELECT w.rid, doc_id, source, len(ws) AS n_words,
    CAST(length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    coalesce(n_lines, 0) AS n_lines, coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM w LEFT JOIN rep USING (rid) LEFT JOIN ln USING (rid)
),
f AS (
  SELECT *, n_words < 10 AS f1, 100 * n_repeat_words > 20 * n_words AS f2,
    n_symbols > CAST(0.1 AS DOUBLE) * greatest(n_words, 1) AS f3, n_dup_lines > CAST(0.3 AS DOUBLE) * n_lines AS f4,
    word_chars < 2 * n_words OR word_chars > 15 * n_words AS f5
  FROM m
),
u AS (SELECT rid, source, unnest([1, 2, 3, 4, 5]) AS rule, unnest([f1, f2, f3, f4, f5]) AS fails FROM f),
h AS (SELECT source, rule, count(*) AS n, count(*) FILTER (fails) AS k FROM u GROUP BY source, rule),
mo AS (SELECT rule, avg(k / n) AS mean, var_pop(k / n) AS var FROM h GROUP BY rule),
pr AS (
  SELECT rule, mean,
    CASE WHEN var <= 0 THEN 10000 ELSE least(greatest(mean * (1 - mean) / var - 1, 1), 10000) END AS weight FROM mo
),
r AS (SELECT source, rule, (k + mean * weight) / (n + weight) AS rate FROM h JOIN pr USING (rule)),
v AS (
  SELECT u.rid, bool_or(rate > 0.5) AS host_failed, bool_or(fails AND rate >= 0.005) AS own
  FROM u JOIN r ON u.rule = r.rule AND u.source IS NOT DISTINCT FROM r.source GROUP BY u.rid
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, f1 OR f2 AS base_failed,
  NOT (f1 OR f2 OR host_failed OR own) AS kept, host_failed
FROM f JOIN v USING (rid)
""",
    "op13_lexical_search": f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(text, '{_CAPITALS}', '{_CAPITALS.lower()}'), '{_TERM}') AS ws
  FROM documents
),
tok AS (SELECT rid, unnest(ws) AS term FROM d),
tf AS (SELECT rid, term, count(*) AS tf FROM tok GROUP BY rid, term),
len AS (SELECT rid, doc_id, CAST(len(ws) AS BIGINT) AS n FROM d WHERE len(ws) > 0),
total AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM len),
m AS (SELECT rid, doc_id, 50 + (50 * n * docs) // terms AS m FROM len, total),
weight AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM tf, total GROUP BY term, docs
),
q AS (
  SELECT DISTINCT iid, item_id, unnest(regexp_extract_all(translate(text, '{_CAPITALS}', '{_CAPITALS.lower()}'), '{_TERM}')) AS term
  FROM (SELECT row_number() OVER () AS iid, item_id, text FROM benchmark)
),
s AS (
  SELECT iid, item_id, rid, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
  FROM q JOIN tf USING (term) JOIN weight USING (term) JOIN m USING (rid) GROUP BY iid, item_id, rid, doc_id
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY iid ORDER BY score DESC, doc_id, rid) AS rank FROM s WHERE score > 0
) WHERE rank <= 50
""",
}

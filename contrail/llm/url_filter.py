"""URL filters: given rules by host and path, and logistic regression on character n-grams for the rest.

A rule (verdict, host, path) fits its host and every subdomain, where the url's path starts with
its path; the longest fitting rule decides. Other urls are judged by a logistic regression on
hashed character n-grams of host and path, fitted by numpy on the driver to a small table of labelled
urls (at most FIT_ROWS rows).

A null url, or one without ``://``, has an empty host and path; no rule fits those, and the model
judges the empty string. Null ids and repeated rows stay. Without labelled rows of both kinds every url gets the
verdict of the one kind there is, or allow. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contrail.llm.labelled import bounded_sample
from contrail.llm.textvec import doc_sums, mix, prepare, text_slices

ALLOW, BLOCK = "allow", "block"
#: (verdict, host, path prefix)
RULES = (
    (ALLOW, "org", "/"),
    (BLOCK, "example.org", "/es/"),
    (BLOCK, "example.org", "/en/1"),
    (ALLOW, "com", "/fr/"),
    (BLOCK, "com", "/de/"),
)
#: Most labelled urls that the model is fitted on.
FIT_ROWS = 20_000
GRAMS, FEATURE_BITS = (2, 3, 4), 14
_ROUNDS, _RATE, _RIDGE, THRESHOLD = 200, 0.2, 1e-4, 0.5


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    host = F.regexp_extract(_rest(url), r"\A([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """From the host's end up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_rest(url), r"\A[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def rule_column(host: Column, path: Column, rules=RULES) -> Column:
    """Struct (rule, verdict) of the longest fitting rule, null if none fits. ``rules`` is a short parameter list."""
    out = None
    for verdict, r_host, r_path in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r)):
        fits = ((host == r_host) | host.endswith("." + r_host)) & path.startswith(r_path)
        value = F.struct(F.lit(r_host + r_path).alias("rule"), F.lit(verdict).alias("verdict"))
        out = F.when(fits, value) if out is None else out.when(fits, value)
    return out if out is not None else F.lit(None).cast("struct<rule:string,verdict:string>")


def _grams(data: np.ndarray, offsets: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Hashed n-grams that stay within a text, with the bounds of each text."""
    out = []
    b = data.astype(np.uint64)
    end = np.repeat(offsets[1:], np.diff(offsets))
    for n in GRAMS:
        if len(b) < n:
            out.append((np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)))
            continue
        key = np.full(len(b) - n + 1, n, np.uint64)
        for j in range(n):
            key = (key << np.uint64(8)) | b[j : len(b) - n + 1 + j]
        whole = np.arange(len(key)) + n <= end[: len(key)]
        places = np.concatenate(([0], np.cumsum(whole)))
        bounds = places[np.minimum(offsets, len(key))]
        out.append(((mix(key[whole]) >> np.uint64(64 - FEATURE_BITS)).astype(np.int64), bounds))
    return out


def model_scores(column, weights: np.ndarray) -> np.ndarray:
    """Probability of block for each string; ``weights`` has the bias last."""
    out = []
    for _, data, offsets in text_slices(column):
        z = np.full(len(offsets) - 1, weights[-1])
        for which, bounds in _grams(data, offsets):
            z += doc_sums(weights[which], bounds) / np.sqrt(np.maximum(np.diff(bounds), 1))
        out.append(1 / (1 + np.exp(-np.clip(z, -500, 500))))
    return np.concatenate(out) if out else np.zeros(0)


def fit(urls: list[str], y: np.ndarray) -> np.ndarray:
    """Weights of the logistic regression by Adam over the whole (bounded) table."""
    m = 1 << FEATURE_BITS
    rows, cols, vals, first = [], [], [], 0
    for _, data, offsets in text_slices(pa.array(urls, pa.string())):
        for which, bounds in _grams(data, offsets):
            size = np.diff(bounds)
            rows.append(first + np.repeat(np.arange(len(size)), size))
            cols.append(which)
            vals.append(np.repeat(1 / np.sqrt(np.maximum(size, 1)), size))
        first += len(offsets) - 1
    row, col, val = np.concatenate(rows), np.concatenate(cols), np.concatenate(vals)
    w = np.zeros(m + 1)
    one, two = np.zeros(m + 1), np.zeros(m + 1)
    for t in range(1, _ROUNDS + 1):
        z = np.bincount(row, w[col] * val, minlength=len(y)) + w[-1]
        r = (1 / (1 + np.exp(-np.clip(z, -500, 500))) - y) / len(y)
        g = np.append(np.bincount(col, r[row] * val, minlength=m) + _RIDGE * w[:-1], r.sum())
        one, two = 0.9 * one + 0.1 * g, 0.999 * two + 0.001 * g * g
        w -= _RATE * (one / (1 - 0.9**t)) / (np.sqrt(two / (1 - 0.999**t)) + 1e-8)
    return w


def train(labelled: DataFrame, url_col: str = "url", blocked_col: str = "blocked", rows: int = FIT_ROWS) -> np.ndarray:
    """Fit on at most ``rows`` distinct labelled urls, the first by a hash of host and path."""
    host_path = F.concat(host_of(F.col(url_col)), path_of(F.col(url_col)))
    small = labelled.select(host_path.alias("s"), F.col(blocked_col).cast("int").alias("y")).filter("y IS NOT NULL")
    got = bounded_sample(small.groupBy("s").agg(F.max("y").alias("y")), ["s"], rows).collect()
    y = np.array([r["y"] for r in got], float)
    if not len(y) or y.min() == y.max():
        w = np.zeros((1 << FEATURE_BITS) + 1)
        w[-1] = 10.0 if len(y) and y[0] else -10.0
        return w
    return fit([r["s"] for r in got], y)


def judge(
    pages: DataFrame, weights: np.ndarray, rules=RULES, id_col: str = "page_id", url_col: str = "url",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """(id, host, path, rule, verdict, block_probability) of every row; the probability is the model's for all urls."""
    spark = pages.sparkSession
    prepare(spark)
    shared = spark.sparkContext.broadcast(weights)
    split = pages.select(F.col(id_col).alias("id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    split = split.select("id", F.coalesce("host", F.lit("")).alias("host"), F.coalesce("path", F.lit("")).alias("path"))
    schema = T.StructType([*split.schema.fields, T.StructField("block_probability", T.DoubleType())])

    def run(batches):
        import pyarrow.compute as pc

        for batch in batches:
            text = pc.binary_join_element_wise(batch.column("host"), batch.column("path"), "")
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(model_scores(text, shared.value))], schema.fieldNames())

    scored = split.mapInArrow(run, schema)
    by_model = F.when(F.col("block_probability") >= threshold, BLOCK).otherwise(ALLOW)
    fitting = scored.withColumn("by_rule", rule_column(F.col("host"), F.col("path"), rules))
    return fitting.select(
        F.col("id").alias(id_col), "host", "path", F.col("by_rule.rule").alias("rule"),
        F.coalesce("by_rule.verdict", by_model).alias("verdict"), "block_probability",
    )

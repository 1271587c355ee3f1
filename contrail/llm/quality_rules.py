"""Quality rules with host verdicts, in DataFrame functions only.

1. Each document is measured on its own (``measures``): word, symbol, duplicate-line and repeated-window
   counts, by array functions within the row, so no word leaves its row.
2. Failures of each rule are counted by host (``host_verdicts``); a host's rate is shrunk
   towards a beta prior fitted to all hosts by the method of moments, so a small host is judged mostly by the prior.
3. The verdicts are joined back. A document goes if it fails a base rule, if its host's
   shrunk rate of some rule exceeds HOST_RATE, or if it fails a rule itself and its host isn't
   above suspicion there (shrunk rate under TRUSTED_RATE).

Five-word windows are compared by 64-bit hashes: two different windows of one document of n
words meet by chance with a probability of about n * n / 2**65.

Null or empty text has no word and fails the base rules. Rows with a null host form one host. Null ids
and repeated rows stay, each row judged on its own. An empty table gives no rows. Only the named
columns are read, so others may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail.llm.staging import staged

MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 10, 20, 5
#: A document fails a rule beyond these: symbols a word, duplicate lines a line, characters a word.
MAX_SYMBOLS, MAX_DUP_LINES, WORD_CHARS = 0.1, 0.3, (2.0, 15.0)
HOST_RATE, TRUSTED_RATE = 0.5, 0.005
RULES = ("short", "repeats", "symbols", "dup_lines", "word_length")
_SPACE = " \t\n\x0b\f\r"
_SPACES = r"[\x20\x09-\x0D]+"
_SYMBOLS = "#*$%&|<>"


def _window_hashes(words: Column) -> Column:
    """Hash of each WINDOW words in a row."""
    return F.transform(
        F.sequence(F.lit(0), F.size(words) - WINDOW),
        lambda i: F.xxhash64(*(F.get(words, i + k) for k in range(WINDOW))),
    )


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """(id, host, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words) of each row."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = docs.select(F.col(id_col).alias("id"), F.col(host_col).cast("string").alias("host"), text.alias("t"))
    trimmed = F.btrim(F.col("t"), F.lit(_SPACE))
    lines = F.filter(F.split("t", "\n"), lambda x: F.btrim(x, F.lit(_SPACE)) != "")
    step = base.select(
        "id", "host",
        F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, _SPACES)).alias("words"),
        F.length(F.translate("t", _SPACE, "")).alias("word_chars"),
        (F.length("t") - F.length(F.translate("t", _SYMBOLS, ""))).alias("n_symbols"),
        lines.alias("lines"),
    )
    empty = F.array().cast("array<bigint>")
    step = step.select(
        "id", "host", F.size("words").alias("n_words"), "word_chars", "n_symbols", F.size("lines").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
        F.when(F.size("words") >= WINDOW, _window_hashes(F.col("words"))).otherwise(empty).alias("h"),
    )
    # Most texts repeat no window; only the others are sorted.
    pairs = F.sort_array(F.transform("h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    none = F.array().cast("array<struct<h:bigint,i:int>>")
    step = step.select("*", F.when(F.size(F.array_distinct("h")) < F.size("h"), pairs).otherwise(none).alias("s")).drop("h")
    near = F.col("s")
    twice = F.filter(near, lambda x, j: (F.get(near, j - 1)["h"] == x["h"]) | (F.get(near, j + 1)["h"] == x["h"]))
    step = step.select("*", F.sort_array(F.transform(twice, lambda x: x["i"])).alias("starts")).drop("s")
    # Words in the union of the windows that begin at these places.
    seen = F.aggregate(
        "starts", F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda a, x: F.struct((a["n"] + x + WINDOW - F.greatest(a["end"], x)).alias("n"), (x + WINDOW).alias("end")),
        lambda a: a["n"],
    )
    counts = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines")
    return step.select("id", "host", *(F.col(c).cast("long") for c in counts), seen.cast("long").alias("n_repeat_words"))


def rule_failures(m: DataFrame) -> DataFrame:
    """The measures with one boolean column fail_<rule> for each of RULES, and base_failed."""
    n = F.greatest("n_words", F.lit(1))
    fails = {
        "short": F.col("n_words") < MIN_WORDS,
        "repeats": 100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"),
        "symbols": F.col("n_symbols") > MAX_SYMBOLS * n,
        "dup_lines": F.col("n_dup_lines") > MAX_DUP_LINES * F.col("n_lines"),
        "word_length": (F.col("word_chars") < WORD_CHARS[0] * F.col("n_words"))
        | (F.col("word_chars") > WORD_CHARS[1] * F.col("n_words")),
    }
    out = m.select("*", *(fails[r].alias(f"fail_{r}") for r in RULES))
    return out.withColumn("base_failed", F.col("fail_short") | F.col("fail_repeats"))


def host_verdicts(failures: DataFrame) -> DataFrame:
    """(host_key, for each rule rate_<rule>): failure rates shrunk by the empirical beta prior of all hosts."""
    hosts = failures.groupBy(F.coalesce("host", F.lit("")).alias("host_key"), F.col("host").isNull().alias("host_none")).agg(
        F.count(F.lit(1)).alias("n"), *(F.count_if(F.col(f"fail_{r}")).alias(f"k_{r}") for r in RULES)
    )
    hosts = staged(hosts, "hosts")
    # Method of moments over hosts: mean m and variance v of the rates; a + b = m (1 - m) / v - 1.
    rate = {r: F.col(f"k_{r}") / F.col("n") for r in RULES}
    got = hosts.agg(
        *(F.avg(rate[r]).alias(f"m_{r}") for r in RULES), *(F.var_pop(rate[r]).alias(f"v_{r}") for r in RULES)
    ).first()
    columns = []
    for r in RULES:
        m, v = got[f"m_{r}"] or 0.0, got[f"v_{r}"] or 0.0
        weight = prior_weight(m, v)
        columns.append(((F.col(f"k_{r}") + m * weight) / (F.col("n") + weight)).alias(f"rate_{r}"))
    return hosts.select("host_key", "host_none", *columns)


def prior_weight(mean: float, variance: float) -> float:
    """a + b of the beta prior, at least 1 and at most 10,000 pseudo-documents (hosts all alike)."""
    if variance <= 0:
        return 10_000.0
    return min(max(mean * (1 - mean) / variance - 1, 1.0), 10_000.0)


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """Measures, failures, host rates, host_failed, base_failed and kept of each row, under the id's own name."""
    failures = staged(rule_failures(measures(docs, id_col, text_col, host_col)), "measures")
    hosts = host_verdicts(failures)
    keyed = failures.withColumns({"host_key": F.coalesce("host", F.lit("")), "host_none": F.col("host").isNull()})
    out = keyed.join(hosts, ["host_key", "host_none"])  # one row per host on the right; AQE splits a large host
    host_failed, own = F.lit(False), F.lit(False)
    for r in RULES:
        host_failed = host_failed | (F.col(f"rate_{r}") > HOST_RATE)
        own = own | (F.col(f"fail_{r}") & (F.col(f"rate_{r}") >= TRUSTED_RATE))
    out = out.withColumn("host_failed", host_failed).withColumn("kept", ~(F.col("base_failed") | F.col("host_failed") | own))
    return out.drop("host_key", "host_none").withColumnRenamed("id", id_col)

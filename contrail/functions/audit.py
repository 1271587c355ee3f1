"""Read-only SQL guard as Column expressions.

The guard is evaluated on the statement after stripping surrounding whitespace
and upper-casing it: it must start with SELECT, must not contain a blocked
keyword anywhere (plain substring test, so identifiers such as CREATED_AT are
blocked too), and must not match a suspicious pattern. The first failing rule
decides the verdict.

The patterns are written for Python's ``re`` on ``str``, where ``\\s`` and
``\\w`` are Unicode-aware. Java regex and RE2 treat them as ASCII, so they are
rewritten here into explicit classes with Python's meaning, which both Spark
and DuckDB understand identically.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from contrail import schema as S

# Characters for which Python's str.isspace() is true (what str.strip() removes),
# derived from the rule itself, and the regex classes equivalent to Python's
# Unicode \s and \w.
_SPACE_POINTS = [c for c in range(0x3001) if chr(c).isspace()]
PY_WHITESPACE = "".join(chr(c) for c in _SPACE_POINTS)
_RX_SPACE = "[" + "".join("\\x{%X}" % c for c in _SPACE_POINTS) + "]"
_RX_WORD = r"[\p{L}\p{N}_]"


def portable_pattern(py_pattern: str) -> str:
    """Rewrite ``\\s`` / ``\\w`` of a guard pattern into explicit classes."""
    return py_pattern.replace(r"\s", _RX_SPACE).replace(r"\w", _RX_WORD)


def normalized(stmt: Column) -> Column:
    return F.upper(F.btrim(stmt, F.lit(PY_WHITESPACE)))


def guard_rule(stmt: Column) -> Column:
    """Name of the first failing rule: 'not_select', the blocked keyword, or the
    suspicious pattern; null when the statement passes. A null statement isn't a SELECT."""
    q = normalized(stmt)
    expr = F.when(q.isNull() | ~q.startswith(S.GUARD_PREFIX), F.lit("not_select"))
    for kw in S.GUARD_KEYWORDS:
        expr = expr.when(q.contains(kw), F.lit(kw))
    for pat in S.GUARD_PATTERNS:
        expr = expr.when(q.rlike(portable_pattern(pat)), F.lit(pat))
    return expr


def guard_message(rule: Column) -> Column:
    return (
        F.when(rule.isNull(), F.lit(None).cast("string"))
        .when(rule == "not_select", F.lit(S.MSG_ONLY_SELECT))
        .when(rule.isin(*S.GUARD_KEYWORDS), F.concat(F.lit(S.MSG_BLOCKED_KEYWORD), rule))
        .otherwise(F.lit(S.MSG_SUSPICIOUS))
    )

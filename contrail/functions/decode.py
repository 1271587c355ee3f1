"""Executor-side casts from JSON element text to typed state-vector columns.

A state vector arrives as a positional JSON array. Parsing it with
``from_json(value, 'array<string>')`` keeps every element as its source text
(numbers keep their digits, ``true``/``false`` stay words, JSON null is null,
nested arrays become their compact JSON text). The functions below turn that
text into typed values following Python's ``int``/``float``/``bool``/``str``
casts as closely as text allows, with one column-level rule: a non-null
element that has no typed reading is a *bad value* (the row is malformed),
never a silent null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contrail import schema as S
from contrail.functions.time import MAX_EPOCH_S, MIN_EPOCH_S

# Element text -> typed value, as SQL expression templates over ``{e}`` (one
# JSON element's text). Each template is a single expression, built by the JVM
# parser in one call.
#
# * JSON true/false count as 1/0 in numeric positions (Python int(True) == 1).
# * A number followed by a Java type suffix (12d, 1.5f) is text, not a number.
# * Non-finite numbers (NaN, Infinity) come back from the JSON reader wrapped in
#   quotes; the quotes are stripped only when the plain cast fails.
# * A fractional number in an integer position truncates toward zero like
#   Python's int(float); NaN, infinities and overflow have no integer reading.
# * Booleans: JSON true/false by value, numbers by non-zero, empty text or
#   empty containers false, any other text true (truthiness).
# * Text that ends with a digit has no suffix, so the pattern isn't tried on it.
_NUM = (
    "CASE WHEN substr({e}, -1) BETWEEN '0' AND '9' OR NOT {e} RLIKE '[0-9.][dDfF][ \"]*$' "
    "THEN coalesce(try_cast({e} AS DOUBLE), try_cast(btrim({e}, '\"') AS DOUBLE)) END"
)
_SQL = {
    "double": "CASE WHEN {e} = 'true' THEN 1.0D WHEN {e} = 'false' THEN 0.0D ELSE " + _NUM + " END",
    "bigint": (
        "CASE WHEN {e} = 'true' THEN 1L WHEN {e} = 'false' THEN 0L "
        "ELSE coalesce(try_cast({e} AS BIGINT), try_cast(" + _NUM + " AS BIGINT)) END"
    ),
    "boolean": (
        "CASE WHEN {e} = 'true' THEN true WHEN {e} = 'false' THEN false "
        "WHEN " + _NUM + " IS NOT NULL THEN " + _NUM + " <> 0 "
        "WHEN {e} IN ('', '[]', '{{}}') THEN false WHEN {e} IS NOT NULL THEN true END"
    ),
}


#: The state columns of each type with a rule, in the layout's order.
_READ = {t: [c for c in S.STATE_COLUMNS if S.state_type(c).simpleString() == t] for t in _SQL}


def _elements(arr: str, dtype: str) -> str:
    """SQL text of an array with the elements that the state columns of a type are read from."""
    at = [i for i, name in enumerate(S.STATE_COLUMNS) if name in _READ[dtype]]
    return f"array({', '.join(f'get({arr}, {i})' for i in at)})"


def readings(arr: str = "_arr") -> list[Column]:
    """``_arr_double``, ``_arr_bigint`` and ``_arr_boolean``: the typed readings of a state's elements of each type, in the
    layout's order. The rule for a type is one small function over an array: written out for each column, the
    code of one row grows beyond what the JVM compiles, and every row is interpreted."""
    return [F.expr(f"transform({_elements(arr, t)}, e -> {rule.format(e='e')})").alias(f"_arr_{t}") for t, rule in _SQL.items()]


def state_columns(arr: str = "_arr") -> list[Column]:
    """17 typed columns from an ``array<string>`` column and its :func:`readings`; ``sensors`` is always null."""
    out = []
    for i, name in enumerate(S.STATE_COLUMNS):
        dtype = S.state_type(name).simpleString()
        if name == "sensors":
            out.append(F.lit(None).cast(dtype).alias(name))
        elif dtype in _READ:
            out.append(F.expr(f"get(_arr_{dtype}, {_READ[dtype].index(name)})").alias(name))
        else:
            out.append(F.expr(f"get({arr}, {i})").alias(name))
    return out


def decode_error(arr: str = "_arr") -> Column:
    """Why a parsed state cannot be used, over its :func:`readings` and typed columns:
    'unparsable' (not a JSON array), 'short_row' (fewer than 17 elements),
    'bad_value' (a numeric element with no numeric reading, or an epoch outside
    the years 1 to 9999, which has no date text). Null when clean."""
    bad = " OR ".join(
        f"exists(zip_with({_elements(arr, t)}, _arr_{t}, (e, x) -> e IS NOT NULL AND x IS NULL), b -> b)" for t in ("bigint", "double")
    )
    bad += "".join(f" OR {c} NOT BETWEEN {MIN_EPOCH_S} AND {MAX_EPOCH_S}" for c in ("time_position", "last_contact"))
    return F.expr(
        f"CASE WHEN {arr} IS NULL THEN 'unparsable' "
        f"WHEN size({arr}) < {len(S.STATE_COLUMNS)} THEN 'short_row' "
        f"WHEN {bad} THEN 'bad_value' END"
    )


# ---------------------------------------------------------------------------
# Encoding (typed columns -> positional JSON text)
# ---------------------------------------------------------------------------


def state_elements(df_cols: dict[str, Column] | None = None) -> list[Column]:
    """JSON text of each of the 17 state columns of the current row.

    Strings are JSON-escaped, numbers use Spark's round-tripping text form,
    booleans are ``true``/``false``, nulls are ``null``.
    """
    parts = []
    for name in S.STATE_COLUMNS:
        c = F.col(name) if df_cols is None else df_cols[name]
        dtype = S.state_type(name)
        if isinstance(dtype, T.StringType):
            # to_json of a one-element array gives an escaped JSON string
            # (or null); drop the enclosing brackets by position (a regex
            # would stop at line terminators such as U+2028 that JSON keeps raw).
            enc = F.to_json(F.array(c.cast("string")))
            txt = enc.substr(F.lit(2), F.length(enc) - 2)
        else:
            txt = F.coalesce(c.cast("string"), F.lit("null"))
        parts.append(txt)
    return parts


def state_json(df_cols: dict[str, Column] | None = None) -> Column:
    """Positional JSON array text of the current row's state."""
    return F.concat(F.lit("["), F.concat_ws(",", *state_elements(df_cols)), F.lit("]"))


def state_json_indented() -> Column:
    """The same with an element a line, four blanks a level, as it stands inside an indented snapshot."""
    return F.concat(F.lit("    [\n        "), F.concat_ws(",\n        ", *state_elements()), F.lit("\n    ]"))

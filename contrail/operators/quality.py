"""Data-quality predicates, splits and record-count gates.

All splits are plain filters over the same input, so Catalyst pushes them
into the scan when the input is a Parquet table and evaluates them inside
whole-stage codegen otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail import schema as S
from contrail.sources.bronze import DataQualityError


def _decoded_ok(df: DataFrame) -> Column:
    if "_decode_error" in df.columns:
        return F.col("_decode_error").isNull()
    return F.lit(True)


def null_critical(*, blank_country: bool = True) -> Column:
    """icao24, origin_country, latitude or longitude missing. With
    ``blank_country`` (the deployed rule) the text markers 'NULL' and '' count
    as missing too."""
    c = (
        F.col("icao24").isNull()
        | F.col("origin_country").isNull()
        | F.col("latitude").isNull()
        | F.col("longitude").isNull()
    )
    if blank_country:
        c = c | F.col("origin_country").isin(*S.MISSING_COUNTRY_MARKERS)
    return c


def complete() -> Column:
    return (
        F.col("icao24").isNotNull()
        & F.col("origin_country").isNotNull()
        & F.col("latitude").isNotNull()
        & F.col("longitude").isNotNull()
    )


def geo_in_range() -> Column:
    """Inclusive bounds; NaN is out of range (Spark orders NaN above all numbers)."""
    return F.col("latitude").between(-90, 90) & F.col("longitude").between(-180, 180)


def geo_out_of_range() -> Column:
    lat, lon = F.col("latitude"), F.col("longitude")
    return (lat < -90) | (lat > 90) | (lon < -180) | (lon > 180)


def null_records(states: DataFrame, *, blank_country: bool = True) -> DataFrame:
    """Rows logged as missing critical fields (decodable rows only)."""
    return states.filter(_decoded_ok(states) & null_critical(blank_country=blank_country))


def complete_rows(states: DataFrame, *, drop_blank_country: bool = False) -> DataFrame:
    """Rows with the four critical fields present. Blank and 'NULL' countries
    pass unless ``drop_blank_country``."""
    cond = _decoded_ok(states) & complete()
    if drop_blank_country:
        cond = cond & ~F.col("origin_country").isin(*S.MISSING_COUNTRY_MARKERS)
    return states.filter(cond)


def valid_geo(df: DataFrame) -> DataFrame:
    return df.filter(geo_in_range())


def invalid_geo(df: DataFrame, *, distinct: bool = False) -> DataFrame:
    """Complete rows outside the coordinate bounds.

    ``distinct=False``: every offending row (bag). ``distinct=True``: set
    semantics of ``complete EXCEPT valid`` — duplicates collapse. Written as a
    filter + distinct rather than ``subtract`` so no anti-join is planned."""
    if distinct:
        return df.filter(~F.coalesce(geo_in_range(), F.lit(False))).dropDuplicates()
    return df.filter(geo_out_of_range())


def is_clean(states: DataFrame, *, drop_blank_country: bool = False) -> Column:
    """Whether a row continues to Silver: decodable, complete, in range. Never null."""
    keep = _decoded_ok(states) & complete() & F.coalesce(geo_in_range(), F.lit(False))
    if drop_blank_country:
        keep = keep & ~F.col("origin_country").isin(*S.MISSING_COUNTRY_MARKERS)
    return keep


def clean_rows(states: DataFrame, *, drop_blank_country: bool = False) -> DataFrame:
    """Rows that continue to Silver."""
    return states.filter(is_clean(states, drop_blank_country=drop_blank_country))


def log_reasons(states: DataFrame, *, blank_country: bool = True) -> dict[str, Column]:
    """Reason -> condition under which a row is logged for it; a row can have two."""
    ok = _decoded_ok(states)
    return {
        "malformed": ~ok,
        "null_records": ok & null_critical(blank_country=blank_country),
        "invalid_geo": ok & complete() & geo_out_of_range(),
    }


def quarantine_rows(states: DataFrame, *, blank_country: bool = True) -> DataFrame:
    """Every row that is logged, with ``dq_reason`` in
    {'malformed', 'null_records', 'invalid_geo'}.

    A row can be logged twice (a blank-country row out of range is both), as in
    the original folders: one pass, the reasons generated in place."""
    reasons = log_reasons(states, blank_country=blank_country)
    found = F.array_compact(F.array(*(F.when(cond, F.lit(r)) for r, cond in reasons.items())))
    return states.select("*", F.explode(found).alias("dq_reason"))


# ---------------------------------------------------------------------------
# Record-count gates
# ---------------------------------------------------------------------------


def check_count(n: int, minimum: int, *, what: str = "rows") -> None:
    if n == 0:
        raise DataQualityError(f"count gate: there are no {what}")
    if n < minimum:
        raise DataQualityError(f"count gate: only {n} {what}, at least {minimum} are needed")


def gate_report(
    df: DataFrame,
    by: str = "run_ts",
    minimums: dict[str, int] | None = None,
) -> DataFrame:
    """Per-group counts with one pass/fail column per gate: (by, n, <gate>...)."""
    minimums = minimums or {"bronze_ok": S.BRONZE_MIN_ROWS, "silver_ok": S.SILVER_MIN_ROWS}
    counts = df.groupBy(by).agg(F.count(F.lit(1)).alias("n"))
    return counts.select(by, "n", *[(F.col("n") >= m).alias(name) for name, m in minimums.items()])

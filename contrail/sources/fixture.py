"""State-vector view over the driver's test tables (``events`` + ``nation``).

The test tables hold no flights, so events are read as aircraft reports:
``user_id`` is the aircraft, ``props.k`` (0–99) selects edge cases, every 50th
event is reported twice with another callsign (duplicate dedup keys), every 35th twice
unchanged (equal rows), and the event's calendar day stands for one Bronze snapshot. The same view is given as
DuckDB SQL for the oracle; both must stay in step.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail import schema as S
from contrail.functions.time import ntz_to_epoch

# FIXED VALUES of the fixture (edge-case selectors and the whole-table as-of).
K_NULL_ICAO = 99
K_BLANK_COUNTRY = 98
K_NULL_WORD_COUNTRY = 97
K_NULL_COUNTRY = 96
K_NULL_LAST_CONTACT = 95
K_NULL_LATITUDE = 94
K_BAD_LONGITUDE = 93
K_NULL_SOURCE = 92
DUPLICATE_EVERY = 50
REPEAT_EVERY = 35
N_NATIONS = 25
AS_OF = 1706659199  # 2024-01-30 23:59:59 UTC
DAY_END_SUFFIX = "_235959"

EVENTS_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
NATION_SCHEMA = "n_nationkey int, n_name string, n_regionkey int"


def _k() -> F.Column:
    return F.get_json_object("props", "$.k").try_cast("int")


def state_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """17 state-vector columns + ``snapshot_day`` (date) + ``run_ts`` (day-end stamp)."""
    # Known schemas: no footer read at planning time.
    ev = spark.read.schema(EVENTS_SCHEMA).parquet(f"{sf_dir}/events.parquet")
    nation = spark.read.schema(NATION_SCHEMA).parquet(f"{sf_dir}/nation.parquet").select("n_nationkey", "n_name")
    cols = ["event_id", "ts", "user_id", "event_type", "value"]
    # Every DUPLICATE_EVERY-th event is reported again with the suffix 'D', every
    # REPEAT_EVERY-th unchanged: one scan, the copies generated in place.
    suffixes = F.array_compact(F.array(
        F.lit(""),
        F.when(F.col("event_id") % DUPLICATE_EVERY == 0, F.lit("D")),
        F.when(F.col("event_id") % REPEAT_EVERY == 0, F.lit("")),
    ))
    # The narrow rows are dealt before the work on them: a file is read by no more tasks than it has row groups.
    dealt = ev.select(*cols, _k().alias("k"), ntz_to_epoch("ts").alias("ep")).hint("rebalance")
    e = dealt.select("*", F.explode(suffixes).alias("suffix"))
    # nation is a fixed 25-row dimension; the planner broadcasts it from its
    # file statistics (autoBroadcastJoinThreshold), no hint needed.
    j = e.join(nation, (F.col("user_id") % N_NATIONS) == F.col("n_nationkey").cast("bigint"))
    k = F.col("k")
    hexid = F.lpad(F.lower(F.hex(F.col("user_id"))), 6, "0")
    day = F.col("ts").cast("date")
    return j.select(
        F.when(k == K_NULL_ICAO, F.lit(None).cast("string")).otherwise(hexid).alias("icao24"),
        F.concat(F.lit("FL"), F.col("event_id").cast("string"), F.col("suffix")).alias("callsign"),
        F.when(k == K_BLANK_COUNTRY, F.lit(""))
        .when(k == K_NULL_WORD_COUNTRY, F.lit("NULL"))
        .when(k == K_NULL_COUNTRY, F.lit(None).cast("string"))
        .otherwise(F.col("n_name"))
        .alias("origin_country"),
        (F.col("ep") - F.col("event_id") % 30).alias("time_position"),
        F.when(k == K_NULL_LAST_CONTACT, F.lit(None).cast("bigint")).otherwise(F.col("ep")).alias("last_contact"),
        F.when(k == K_BAD_LONGITUDE, F.lit(999.0))
        .otherwise((F.col("event_id") * 37 % 3600).cast("double") / 10 - 180)
        .alias("longitude"),
        F.when(k == K_NULL_LATITUDE, F.lit(None).cast("double")).otherwise(F.col("value") - 90).alias("latitude"),
        (F.col("value") * 100).alias("baro_altitude"),
        F.when(F.col("event_type") == "signup", F.lit(True))
        .when(F.col("event_type") == "error", F.lit(None).cast("boolean"))
        .otherwise(F.lit(False))
        .alias("on_ground"),
        (F.col("value") * 2).alias("velocity"),
        (F.col("event_id") % 360).cast("double").alias("true_track"),
        ((k - 50).cast("double") / 10).alias("vertical_rate"),
        F.lit(None).cast("string").alias("sensors"),
        F.when(k % 3 != 0, F.col("value") * 100 + 25).alias("geo_altitude"),
        F.when(k % 5 != 0, F.lpad((F.col("event_id") % 7778).cast("string"), 4, "0")).alias("squawk"),
        F.lit(False).alias("spi"),
        F.when(k == K_NULL_SOURCE, F.lit(None).cast("bigint")).otherwise((k % 6).cast("bigint")).alias("position_source"),
        day.alias("snapshot_day"),
        # date -> 'yyyy-MM-dd' text is zone-free; drop the dashes
        F.concat(F.translate(day.cast("string"), "-", ""), F.lit(DAY_END_SUFFIX)).alias("run_ts"),
    )


def day_end_epoch(day: _dt.date) -> int:
    """As-of of a per-day run: the last second of that day (UTC)."""
    start = _dt.datetime(day.year, day.month, day.day, tzinfo=_dt.timezone.utc)
    return int(start.timestamp()) + 86399


# ---------------------------------------------------------------------------
# DuckDB form of the same view (oracle side)
# ---------------------------------------------------------------------------

DUCKDB_VIEW = f"""
sv AS (
  WITH e AS (
    SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
           epoch_us(ts) // 1000000 AS ep, '' AS suffix FROM events
    UNION ALL
    SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
           epoch_us(ts) // 1000000 AS ep, 'D' AS suffix FROM events WHERE event_id % {DUPLICATE_EVERY} = 0
    UNION ALL
    SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
           epoch_us(ts) // 1000000 AS ep, '' AS suffix FROM events WHERE event_id % {REPEAT_EVERY} = 0
  )
  SELECT
    CASE WHEN k = {K_NULL_ICAO} THEN NULL ELSE lpad(printf('%x', user_id), 6, '0') END AS icao24,
    concat('FL', CAST(event_id AS VARCHAR), suffix) AS callsign,
    CASE WHEN k = {K_BLANK_COUNTRY} THEN '' WHEN k = {K_NULL_WORD_COUNTRY} THEN 'NULL'
         WHEN k = {K_NULL_COUNTRY} THEN NULL ELSE n_name END AS origin_country,
    ep - event_id % 30 AS time_position,
    CASE WHEN k = {K_NULL_LAST_CONTACT} THEN NULL ELSE ep END AS last_contact,
    CASE WHEN k = {K_BAD_LONGITUDE} THEN CAST(999 AS DOUBLE)
         ELSE CAST(event_id * 37 % 3600 AS DOUBLE) / 10 - 180 END AS longitude,
    CASE WHEN k = {K_NULL_LATITUDE} THEN NULL ELSE value - 90 END AS latitude,
    value * 100 AS baro_altitude,
    CASE WHEN event_type = 'signup' THEN TRUE WHEN event_type = 'error' THEN NULL ELSE FALSE END AS on_ground,
    value * 2 AS velocity,
    CAST(event_id % 360 AS DOUBLE) AS true_track,
    CAST(k - 50 AS DOUBLE) / 10 AS vertical_rate,
    CAST(NULL AS VARCHAR) AS sensors,
    CASE WHEN k % 3 <> 0 THEN value * 100 + 25 END AS geo_altitude,
    CASE WHEN k % 5 <> 0 THEN lpad(CAST(event_id % 7778 AS VARCHAR), 4, '0') END AS squawk,
    FALSE AS spi,
    CASE WHEN k = {K_NULL_SOURCE} THEN NULL ELSE CAST(k % 6 AS BIGINT) END AS position_source,
    CAST(ts AS DATE) AS snapshot_day,
    strftime(CAST(ts AS DATE), '%Y%m%d') || '{DAY_END_SUFFIX}' AS run_ts
  FROM e JOIN nation ON n_nationkey = user_id % {N_NATIONS}
)"""

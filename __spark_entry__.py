"""

``entry(spark)`` runs the flagship question on sf0.001; ``queries()`` maps every
``oracle_sql()`` gives the same result as DuckDB SQL over the same tables.

All Spark work goes through the library (``contrail``); the fixture view that
reads ``events`` + ``nation`` as aircraft state vectors is defined in both
engines in ``contrail.sources.fixture``. Every query reads the whole tables.
"""

from __future__ import annotations

import json
import os
import sys
from collections.abc import Callable

# The package lives next to this file; make it importable however this module
# is loaded. Executors need it only for the training-data operators, which ship it themselves.
_HERE = os.path.dirname(os.path.abspath(__file__))
if _HERE not in sys.path:
    sys.path.insert(0, _HERE)

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail import schema as S
from contrail.functions.decode import state_json_indented
from contrail.functions.time import run_stamp, run_ts_to_epoch
from contrail.operators import (
    complete_rows,
    dedup_states,
    epoch_to_text,
    flight_status,
    gate_report,
    invalid_geo,
    latest_per_aircraft,
    null_records,
    quarantine_rows,
    source_type,
    upsert,
    valid_geo,
)
from contrail.operators.dedup import pick_winner
from contrail.operators.quality import clean_rows
from contrail.operators.upsert import newer_only_order
from contrail.plans import (
    UnsafeQueryError,
    adsb_share,
    airborne,
    climb_descend,
    derive_silver,
    gold,
    gold_sql,
    inactive_flights,
    register_gold,
    silver,
    silver_latest,
    sql_audit,
    top_countries,
    visible,
)
from contrail.plans.jobs import RunResult, read_gold, run_bronze, run_gold, run_silver_pending
from contrail.session import ensure_checkpoint_dir, scratch_dir
from contrail.sinks import (
    Commit,
    TableStore,
    read_quarantine,
    read_silver,
    run_config,
    run_ledger,
    with_country_part,
    write_quarantine,
)
from contrail.sources import (
    decode_states,
    land_snapshots,
    latest_run,
    read_states,
    state_vectors,
    to_envelopes,
    to_state_lines,
    write_array_snapshots,
)
from contrail.sources.fixture import AS_OF, DUCKDB_VIEW
from contrail.streaming import run_incremental
from contrail.streaming.expiry import CHANGES_SCHEMA, run_expiry, status_at

try:  # the training-data operators; everything else works without them
    import corpus_pipeline
    from contrail.llm import queries as llm_queries
except ModuleNotFoundError as missing:
    if missing.name not in ("corpus_pipeline", "contrail.llm"):
        raise
    corpus_pipeline = llm_queries = None

SF_SMOKE = "/root/testdata/sf0.001"

# Parameters of the registered questions.
BBOX = (0.0, 40.0, 60.0, 100.0)  # lat_min, lat_max, lon_min, lon_max
TOP_K = 3
GOLD_SQL = (
    "SELECT status, source_type, COUNT(*) AS n_flights, MAX(baro_altitude) AS max_baro_altitude, "
    "MIN(velocity) AS min_velocity FROM flights_gold GROUP BY status, source_type"
)
TEMPLATE_PREFIX = "SELECT * FROM flights_gold WHERE callsign = '"
INCREMENTAL_FILES_PER_TRIGGER = 10
FIRST_RUN_AS_OF = AS_OF - 15 * 86400  # the pipeline's first run holds the snapshots up to this instant

LEDGER_RUNS = (AS_OF - 16 * 86400, AS_OF - 15 * 86400, AS_OF)  # ends of the ledger's three runs
LEDGER_MIN_ROWS = 1000  # its gate: a day is too short at sf0.01, not at sf0.1

# Lines that replace the regular ones in the decode checks, by the fixture's k (= 10 * vertical_rate + 50).
K_CUT, K_SHORT, K_SUFFIX, K_EPOCH, K_LIST = 91, 90, 89, 88, 87
SHORT_LINE = '["a","b"]'
SUFFIX_LINE = '["00x089","S","X",1,2,3.5,"12d",0,false,0,0,0,[1,2],0,"1200",false,0]'
EPOCH_LINE = '["00x088","E","X",1,253402300800,3.5,4.5,0,false,0,0,0,null,0,"1200",false,0]'
LIST_LINE = '["00x087","L","X",1,2,3.5,4.5,10,true,0,0,0,[1,2],7.5,"7700",true,1]'


def _indented(line: str) -> str:
    """A state's line as it stands in an indented snapshot."""
    return json.dumps([json.loads(line)], indent=4)[2:-2]


# ---------------------------------------------------------------------------
# Spark side
# ---------------------------------------------------------------------------


def _sv(spark: SparkSession, d: str) -> DataFrame:
    return state_vectors(spark, d)


def _gold(spark: SparkSession, d: str) -> DataFrame:
    """Gold of a first Silver write: one row per aircraft, status at AS_OF."""
    return gold(silver_latest(_sv(spark, d), AS_OF))


def _decoded(spark: SparkSession, d: str) -> DataFrame:
    """The fixture as JSON lines, some of them damaged, decoded again (with ``run_ts``)."""
    sv = _sv(spark, d).withColumn("k", F.round(F.col("vertical_rate") * 10 + 50).cast("int"))
    k, line = F.col("k"), F.col("value")
    broken = (
        F.when(k == K_CUT, F.substring(line, 1, 9))
        .when(k == K_SHORT, F.lit(SHORT_LINE))
        .when(k == K_SUFFIX, F.lit(SUFFIX_LINE))
        .when(k == K_EPOCH, F.lit(EPOCH_LINE))
        .when(k == K_LIST, F.lit(LIST_LINE))
        .otherwise(line)
    )
    return decode_states(to_state_lines(sv, "k", "run_ts").select("run_ts", broken.alias("value")))


def q_bronze_decode(spark, d):
    return _decoded(spark, d).select(*S.STATE_COLUMNS, "_decode_error", "_raw")


def q_bronze_decode_array(spark, d):
    """Snapshot files in the original form, a run each, some states short, empty or nested, read in pieces."""
    ensure_checkpoint_dir(spark)
    path = scratch_dir(spark, "arrays")
    k = F.round(F.col("vertical_rate") * 10 + 50).cast("int")
    body = (
        F.when(k == K_CUT, F.lit("    []"))
        .when(k == K_SHORT, F.lit(_indented(SHORT_LINE)))
        .when(k == K_LIST, F.lit(_indented(LIST_LINE)))
        .otherwise(state_json_indented())
    )
    write_array_snapshots(_sv(spark, d), path, order="time_position", body=body)
    return read_states(spark, path, fmt="array").select("run_ts", *S.STATE_COLUMNS, "_decode_error", "_raw")


def q_land_snapshots(spark, d):
    ensure_checkpoint_dir(spark)
    path = scratch_dir(spark, "bronze")
    land_snapshots(to_envelopes(_sv(spark, d), time_col=F.col("last_contact")), path)
    states = read_states(spark, path)
    return states.groupBy("run_ts").agg(
        F.count(F.lit(1)).alias("n_states"),
        F.count_if(F.col("_decode_error").isNull()).alias("n_decoded"),
    )


def q_latest_snapshot(spark, d):
    per_run = _sv(spark, d).groupBy("run_ts").agg(F.count(F.lit(1)).alias("record_count"))
    manifest = per_run.select(
        "run_ts",
        F.lit("bronze").alias("stage"),
        F.lit(None).cast("bigint").alias("version"),
        F.concat(F.lit("bronze/run_ts="), F.col("run_ts")).alias("output_path"),
        "record_count",
        F.lit(None).cast("bigint").alias("batch_id"),
    )
    return latest_run(manifest).select("run_ts", "output_path", "record_count")


def q_count_gate(spark, d):
    return gate_report(_sv(spark, d), "run_ts")


def q_null_records(spark, d):
    return null_records(_sv(spark, d))


def q_complete_rows(spark, d):
    return complete_rows(_sv(spark, d))


def q_valid_geo(spark, d):
    return valid_geo(complete_rows(_sv(spark, d)))


def q_invalid_geo(spark, d):
    return invalid_geo(complete_rows(_sv(spark, d)))


def q_invalid_geo_distinct(spark, d):
    return invalid_geo(complete_rows(_sv(spark, d)), distinct=True)


def q_quarantine(spark, d):
    ensure_checkpoint_dir(spark)
    path = scratch_dir(spark, "quarantine")
    write_quarantine(quarantine_rows(_decoded(spark, d)), path)
    return read_quarantine(spark, path).select(*S.STATE_COLUMNS, "_decode_error", "_raw", "dq_reason", "run_ts")


def q_dedup_states(spark, d):
    return dedup_states(clean_rows(_sv(spark, d)))


def q_latest_per_aircraft(spark, d):
    return latest_per_aircraft(dedup_states(clean_rows(_sv(spark, d))))


def q_flight_status(spark, d):
    return flight_status(_sv(spark, d), AS_OF)


def q_source_type(spark, d):
    return source_type(_sv(spark, d))


def q_epoch_to_text(spark, d):
    return epoch_to_text(_sv(spark, d))


def q_silver_layer(spark, d):
    return visible(silver(_sv(spark, d), AS_OF))


def _two_sides(spark, d, days_shared: int) -> tuple[DataFrame, DataFrame]:
    """Silver rows, one per aircraft, of two runs: the snapshots before the last day, and those of the
    last day (and ``days_shared`` days before it, which are then in both runs). One reduction for both sides."""
    sv = clean_rows(_sv(spark, d))
    last = sv.agg(F.max("snapshot_day")).scalar()
    day = F.col("snapshot_day")
    sides = F.array_compact(F.array(F.when(day < last, F.lit(0)), F.when(day >= F.date_sub(last, days_shared), F.lit(1))))
    both = sv.select(*S.STATE_COLUMNS, last.alias("last_day"), F.explode(sides).alias("side"))
    # A share of the new run's aircraft is unknown to the old one.
    shifted = F.when((F.col("side") == 1) & (F.col("time_position") % 10 == 0), F.concat(F.lit("x"), F.col("icao24")))
    both = both.withColumn("icao24", F.coalesce(shifted, F.col("icao24")))
    winners = pick_winner(both, ["side", "icao24"], ["last_contact", "time_position", "callsign"])
    run_day = F.when(F.col("side") == 1, F.col("last_day")).otherwise(F.date_sub("last_day", 1))
    winners = winners.withColumn("run", F.concat(F.translate(run_day.cast("string"), "-", ""), F.lit("_235959")))
    return tuple(
        derive_silver(winners.filter(F.col("side") == side), run_ts_to_epoch(F.col("run")), run_col="run") for side in (0, 1)
    )


def q_silver_upsert(spark, d):
    return visible(upsert(*_two_sides(spark, d, days_shared=0)))


def q_silver_upsert_newer(spark, d):
    """Recency merge: reports of the day before the last are in both runs, unchanged, with another status."""
    existing, new = _two_sides(spark, d, days_shared=1)
    return visible(upsert(existing, new, order_by=newer_only_order(new)))


def q_gold_layer(spark, d):
    return _gold(spark, d)


def _pipeline(spark, d) -> tuple[TableStore, list[RunResult]]:
    """Land two runs, bring both into Silver, publish Gold twice (plain, then by status). Each of the keys
    below runs it on the given tables."""
    ensure_checkpoint_dir(spark)
    root = scratch_dir(spark, "pipeline")
    store = TableStore(spark, f"{root}/store")
    stamps = [run_stamp(FIRST_RUN_AS_OF), run_stamp(AS_OF)]
    sv = _sv(spark, d)
    run = F.when(F.col("run_ts") <= stamps[0], F.lit(stamps[0])).otherwise(F.lit(stamps[1]))
    responses = to_envelopes(sv.withColumn("run_ts", run), time_col=F.col("last_contact"))
    run_bronze(spark, responses, f"{root}/bronze", store, runs=stamps)
    results = run_silver_pending(spark, store, quarantine_dir=f"{root}/quarantine")
    results += [run_gold(spark, store), run_gold(spark, store, partition_by="status")]
    return store, results


def q_stage_counts(spark, d):
    _, results = _pipeline(spark, d)
    rows = [(r.stage, r.version, k, int(n)) for r in results for k, n in r.counts.items()]
    return spark.createDataFrame(rows, "job string, version bigint, stage string, n bigint")


def q_run_manifest(spark, d):
    store, _ = _pipeline(spark, d)
    return store.manifest().select("stage", "version", "run_ts", "record_count")


def q_run_config(spark, d):
    store, _ = _pipeline(spark, d)
    return run_config(store).select("run_ts", "total_records", "silver_record_count", "gold_record_count")


def q_silver_written(spark, d):
    store, _ = _pipeline(spark, d)
    return visible(read_silver(store))


def q_gold_written(spark, d):
    store, _ = _pipeline(spark, d)
    return read_gold(store, version=1)


def q_gold_written_partitioned(spark, d):
    """The second Gold version with the values of its partition folders."""
    store, results = _pipeline(spark, d)
    return spark.read.parquet(results[-1].path)


def _corrected(spark, d) -> TableStore:
    """Three runs, the second of one day only; the first lands with wrong rows, and right once all three are through."""
    ensure_checkpoint_dir(spark)
    root = scratch_dir(spark, "ledger")
    store = TableStore(spark, f"{root}/store")
    sv, stamps = _sv(spark, d), [run_stamp(a) for a in LEDGER_RUNS]
    first, second, third = stamps
    run = F.when(F.col("run_ts") <= first, F.lit(first)).when(F.col("run_ts") <= second, F.lit(second)).otherwise(F.lit(third))
    right = sv.withColumn("run_ts", run)
    stray = (F.col("run_ts") == first) & (F.col("time_position") % 10 == 0)
    wrong = right.withColumns({
        "icao24": F.when(stray, F.concat(F.lit("x"), "icao24")).otherwise(F.col("icao24")),
        "callsign": F.when(F.col("run_ts") == first, F.lit("WRONG")).otherwise(F.col("callsign")),
    })
    for states, runs in ((wrong, stamps), (right.filter(F.col("run_ts") == first), [first])):
        run_bronze(spark, to_envelopes(states, time_col=F.col("last_contact")), f"{root}/bronze", store, runs=runs, min_rows=1)
        run_silver_pending(spark, store, min_rows=LEDGER_MIN_ROWS)
    return store


def q_run_ledger(spark, d):
    return run_ledger(_corrected(spark, d)).select("run_ts", "bronze_version", "record_count", "state", "silver_version", "note")


def q_silver_corrected(spark, d):
    table = read_silver(_corrected(spark, d))
    return visible(spark.createDataFrame([], S.SILVER_SCHEMA) if table is None else table)


def q_incremental_silver(spark, d):
    ensure_checkpoint_dir(spark)
    root = scratch_dir(spark, "incremental")
    land_snapshots(to_envelopes(_sv(spark, d), time_col=F.col("last_contact")), f"{root}/bronze")
    store = TableStore(spark, f"{root}/store")
    q = run_incremental(
        spark, f"{root}/bronze", store, f"{root}/checkpoint", max_files_per_trigger=INCREMENTAL_FILES_PER_TRIGGER
    )
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return visible(read_silver(store))


def q_incremental_gated(spark, d):
    """The ledger's three runs, each in several files, streamed two files a batch; the gate holds for whole runs."""
    ensure_checkpoint_dir(spark)
    root = scratch_dir(spark, "gated")
    store = TableStore(spark, f"{root}/store")
    sv, stamps = _sv(spark, d), [run_stamp(a) for a in LEDGER_RUNS]
    first, second, third = stamps
    run = F.when(F.col("run_ts") <= first, F.lit(first)).when(F.col("run_ts") <= second, F.lit(second)).otherwise(F.lit(third))
    responses = to_envelopes(sv.withColumn("run_ts", run), time_col=F.col("last_contact"))
    most = "spark.sql.files.maxRecordsPerFile"
    before = spark.conf.get(most)
    spark.conf.set(most, str(-(-sv.count() // 7)))
    try:
        run_bronze(spark, responses, f"{root}/bronze", store, runs=stamps, min_rows=1)
    finally:
        spark.conf.set(most, before)
    q = run_incremental(
        spark, f"{root}/bronze", store, f"{root}/checkpoint", max_files_per_trigger=2, min_rows=LEDGER_MIN_ROWS, gated=True
    )
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    table = read_silver(store)
    return visible(spark.createDataFrame([], S.SILVER_SCHEMA) if table is None else table)


def q_status_expiry(spark, d):
    """Aircraft by status at the end of each run, from the log of changes that the stateful stream writes."""
    ensure_checkpoint_dir(spark)
    root = scratch_dir(spark, "expiry")
    land_snapshots(to_envelopes(_sv(spark, d), time_col=F.col("last_contact")), f"{root}/bronze")
    q = run_expiry(spark, f"{root}/bronze", f"{root}/changes", f"{root}/checkpoint", max_files_per_trigger=INCREMENTAL_FILES_PER_TRIGGER)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    changes = spark.read.schema(CHANGES_SCHEMA).parquet(f"{root}/changes")
    ends = sorted(r[0] for r in _sv(spark, d).select(run_ts_to_epoch(F.col("run_ts"))).distinct().collect())  # the run stamps
    table = status_at(changes, F.array(*(F.lit(e).cast("long") for e in ends)))
    return table.groupBy("as_of", "status").agg(F.count(F.lit(1)).alias("n_aircraft"), F.sum("last_contact").alias("sum_last_contact"))


def q_airborne_in_bbox(spark, d):
    return airborne(_gold(spark, d), bbox=BBOX)


def q_gold_by_location(spark, d):
    """The flights of an area, asked of a Gold table that is laid out by location."""
    ensure_checkpoint_dir(spark)
    store = TableStore(spark, f"{scratch_dir(spark, 'located')}/store")
    rows = silver_latest(_sv(spark, d), AS_OF, run_ts=run_stamp(AS_OF))
    version, path = store.write_version(with_country_part(rows), "silver", partition_by=S.COUNTRY_PART, rebalance=S.COUNTRY_PART)
    store.commit(Commit("silver", version, path, store.rows_in(path, S.SILVER_SCHEMA), run_ts=run_stamp(AS_OF)))
    run_gold(spark, store, by_location=True)
    la0, la1, lo0, lo1 = BBOX
    return read_gold(store).filter(F.col("latitude").between(la0, la1) & F.col("longitude").between(lo0, lo1))


def q_airborne_by_origin(spark, d):
    return airborne(_gold(spark, d), by="origin_country")


def q_top_countries(spark, d):
    return top_countries(_gold(spark, d), k=TOP_K)


def q_inactive_flights(spark, d):
    return inactive_flights(_gold(spark, d))


def q_adsb_share(spark, d):
    return adsb_share(_gold(spark, d))


def q_climb_descend(spark, d):
    return climb_descend(_gold(spark, d))


def q_gold_sql(spark, d):
    register_gold(_gold(spark, d))
    return gold_sql(spark, GOLD_SQL)


def _scope_statements(d: str) -> list[tuple[int, str]]:
    """Statements that stay on the Gold view (below 100), and some that try to read on (100 and above)."""
    reflection = "java_method('java.lang.System', 'getProperty', 'user.name')"
    wide = ", ".join(f"{i} AS c{i}" for i in range(40))
    fine = [
        "SELECT * FROM flights_gold",
        "SELECT DISTINCT status, source_type FROM flights_gold",
        "SELECT * FROM (WITH up AS (SELECT * FROM flights_gold WHERE vertical_rate > 0) SELECT * FROM up) x",
        "SELECT * FROM flights_gold WHERE velocity > (SELECT avg(velocity) FROM flights_gold)",
    ]
    hostile = [
        f"SELECT {wide}, {reflection} FROM flights_gold",
        "SELECT * FROM IDENTIFIER('all_events')",
        "SELECT * FROM IDENTIFIER('all_' || 'events')",
        "SELECT IDENTIFIER('java_' || 'method')('java.lang.System', 'getProperty', 'user.name') FROM flights_gold",
        "SELECT * FROM (WITH all_events AS (SELECT 1 AS a) SELECT * FROM all_events) x, all_events",
        "SELECT * FROM flights_gold WHERE callsign IN (SELECT event_type FROM all_events)",
        f"SELECT * FROM parquet.`{d}/events.parquet`",
        "SELECT * FROM range(10)",
        "SELECT * FROM sql_keywords()",
        f"SELECT transform(array(1), x -> {reflection}) FROM flights_gold",
        "SELECT 1; DROP TABLE flights_gold",
        "DELETE FROM flights_gold",
    ]
    return [*enumerate(fine), *enumerate(hostile, 100)]


def q_gold_sql_scope(spark, d):
    """Which statements the query surface lets through, and how many rows those give."""
    gold_df = _gold(spark, d)
    path = f"{scratch_dir(spark, 'scope')}/gold"
    gold_df.write.parquet(path)
    register_gold(spark.read.schema(S.GOLD_SCHEMA).parquet(path))
    spark.read.parquet(f"{d}/events.parquet").createOrReplaceTempView("all_events")
    rows = []
    for number, statement in _scope_statements(d):
        try:
            rows.append((number, True, gold_sql(spark, statement).count()))
        except UnsafeQueryError:
            rows.append((number, False, None))
    return spark.createDataFrame(rows, "statement int, allowed boolean, n_rows bigint")


def q_sql_audit(spark, d):
    conv = spark.read.parquet(f"{d}/conversations.parquet")
    # Each turn is audited three times: as a raw statement, interpolated into a SELECT
    # template, and with the user's turns missing. One scan, three statements per row.
    kinds = F.array(
        F.struct(F.lit("raw").alias("kind"), F.col("text").alias("q")),
        F.struct(
            F.lit("templated").alias("kind"),
            F.concat(F.lit(TEMPLATE_PREFIX), F.col("text"), F.lit("'")).alias("q"),
        ),
        F.struct(F.lit("missing").alias("kind"), F.when(F.col("role") != "user", F.col("text")).alias("q")),
    )
    stmts = conv.select("conv_id", "turn", F.explode(kinds).alias("s")).select("conv_id", "turn", "s.kind", "s.q")
    return sql_audit(stmts).select("conv_id", "turn", "kind", "allowed", "rule", "message")


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "bronze_decode": q_bronze_decode,
    "bronze_decode_array": q_bronze_decode_array,
    "land_snapshots": q_land_snapshots,
    "latest_snapshot": q_latest_snapshot,
    "count_gate": q_count_gate,
    "null_records": q_null_records,
    "complete_rows": q_complete_rows,
    "valid_geo": q_valid_geo,
    "invalid_geo": q_invalid_geo,
    "invalid_geo_distinct": q_invalid_geo_distinct,
    "quarantine": q_quarantine,
    "dedup_states": q_dedup_states,
    "latest_per_aircraft": q_latest_per_aircraft,
    "flight_status": q_flight_status,
    "source_type": q_source_type,
    "epoch_to_text": q_epoch_to_text,
    "silver_layer": q_silver_layer,
    "silver_upsert": q_silver_upsert,
    "silver_upsert_newer": q_silver_upsert_newer,
    "gold_layer": q_gold_layer,
    "stage_counts": q_stage_counts,
    "run_manifest": q_run_manifest,
    "run_config": q_run_config,
    "run_ledger": q_run_ledger,
    "silver_corrected": q_silver_corrected,
    "silver_written": q_silver_written,
    "gold_written": q_gold_written,
    "gold_written_partitioned": q_gold_written_partitioned,
    "incremental_silver": q_incremental_silver,
    "incremental_gated": q_incremental_gated,
    "status_expiry": q_status_expiry,
    "airborne_in_bbox": q_airborne_in_bbox,
    "gold_by_location": q_gold_by_location,
    "airborne_by_origin": q_airborne_by_origin,
    "top_countries": q_top_countries,
    "inactive_flights": q_inactive_flights,
    "adsb_share": q_adsb_share,
    "climb_descend": q_climb_descend,
    "gold_sql": q_gold_sql,
    "gold_sql_scope": q_gold_sql_scope,
    "sql_audit": q_sql_audit,
}


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: which origin countries have the most flights (sf0.001)."""
    return q_top_countries(spark, SF_SMOKE)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    if llm_queries is None:
        return dict(_QUERIES)
    return {**_QUERIES, **llm_queries.QUERIES, "pipeline": corpus_pipeline.run}


# ---------------------------------------------------------------------------
# DuckDB oracle
# ---------------------------------------------------------------------------

_COMPLETE = (
    "icao24 IS NOT NULL AND origin_country IS NOT NULL AND latitude IS NOT NULL AND longitude IS NOT NULL"
)
_GEO_OK = "latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180"
_GEO_BAD = "(latitude < -90 OR latitude > 90 OR longitude < -180 OR longitude > 180)"
_NULL_CRIT = (
    "(icao24 IS NULL OR origin_country IS NULL OR origin_country IN ('NULL', '') "
    "OR latitude IS NULL OR longitude IS NULL)"
)


def _text(c: str) -> str:
    return f"strftime(make_timestamp({c} * 1000000), '%Y-%m-%d %H:%M:%S')"


# The expected values are spelled out here, not imported, so a wrong constant in the library shows.
_STATE = (
    "icao24, callsign, origin_country, time_position, last_contact, longitude, latitude, baro_altitude, on_ground, "
    "velocity, true_track, vertical_rate, sensors, geo_altitude, squawk, spi, position_source"
)
_SILVER = _STATE + ", status, status_reason, source_type, ingestion_time"
_GOLD = (
    "icao24, callsign, origin_country, latitude, longitude, baro_altitude, velocity, on_ground, true_track, "
    "vertical_rate, time_position, last_contact, status, status_reason, source_type, ingestion_time"
)


def _status(a: str) -> str:
    return (
        f"CASE WHEN on_ground = TRUE THEN 'LANDED' WHEN {a} - last_contact > 21600 THEN 'EXPIRED' "
        f"WHEN {a} - last_contact > 10800 THEN 'INACTIVE' ELSE 'AIRBORNE' END"
    )


def _reason(a: str) -> str:
    return (
        f"CASE WHEN on_ground = TRUE THEN 'on_ground_flag' WHEN {a} - last_contact > 21600 THEN 'last_contact_exceeded_6hrs' "
        f"WHEN {a} - last_contact > 10800 THEN 'last_contact_exceeded_3hrs' ELSE 'in_air' END"
    )


def _source_type() -> str:
    return (
        "CASE position_source WHEN 0 THEN 'ADS-B' WHEN 1 THEN 'ASTERIX' WHEN 2 THEN 'MLAT' WHEN 3 THEN 'FLARM' "
        "ELSE 'UNKNOWN' END"
    )


def _silver_select(a: str) -> str:
    """Silver's 21 columns from a relation of epoch-typed state vectors, as-of ``a``."""
    cols = []
    for c in _STATE.split(", "):
        cols.append(f"{_text(c)} AS {c}" if c in ("time_position", "last_contact") else c)
    cols += [
        f"{_status(a)} AS status",
        f"{_reason(a)} AS status_reason",
        f"{_source_type()} AS source_type",
        f"make_timestamp(CAST({a} AS BIGINT) * 1000000) AS ingestion_time",
    ]
    return ", ".join(cols)


def _winner(rel: str, part: str, order: str) -> str:
    return (
        f"SELECT * EXCLUDE (_rn) FROM (SELECT *, row_number() OVER (PARTITION BY {part} ORDER BY {order}) AS _rn "
        f"FROM {rel}) WHERE _rn = 1"
    )


_DEDUP_ORDER = "time_position DESC NULLS LAST, callsign DESC NULLS LAST"
_LATEST_ORDER = "last_contact DESC NULLS LAST, time_position DESC NULLS LAST, callsign DESC NULLS LAST"

_BASE = (
    f"WITH {DUCKDB_VIEW.strip()},\n"
    f"clean AS (SELECT * FROM sv WHERE {_COMPLETE} AND {_GEO_OK}),\n"
    f"latest AS ({_winner('clean', 'icao24', _LATEST_ORDER)}),\n"
    f"silver_latest AS (SELECT {_silver_select(str(AS_OF))} FROM latest),\n"
    f"flights_gold AS (SELECT {_GOLD} FROM silver_latest WHERE status <> 'EXPIRED')\n"
)


def _audit_sql() -> str:
    space = [c for c in range(0x3001) if chr(c).isspace()]
    ws = "".join(map(chr, space)).replace("'", "''")
    rx = "[" + "".join("\\x{%X}" % c for c in space) + "]"
    keywords = ("DELETE", "DROP", "UPDATE", "INSERT", "TRUNCATE", "ALTER", "CREATE", "EXEC", "EXECUTE")
    patterns = (
        ("--", "--"),
        (r"/\*", r"/\*"),
        (r";\s*\w", rf";{rx}*[\p{{L}}\p{{N}}_]"),
        ("xp_", "xp_"),
        (r"UNION\s+SELECT", rf"UNION{rx}+SELECT"),
    )
    rule = "CASE WHEN u IS NULL OR NOT starts_with(u, 'SELECT') THEN 'not_select' "
    rule += " ".join(f"WHEN contains(u, '{k}') THEN '{k}'" for k in keywords)
    rule += "".join(f" WHEN regexp_matches(u, '{p}') THEN '{name}'" for name, p in patterns) + " END"
    kws = ", ".join(f"'{k}'" for k in keywords)
    msg = (
        "CASE WHEN rule IS NULL THEN NULL WHEN rule = 'not_select' THEN 'Only SELECT queries allowed.' "
        f"WHEN rule IN ({kws}) THEN 'Blocked keyword detected: ' || rule ELSE 'Suspicious SQL pattern detected.' END"
    )
    tmpl = TEMPLATE_PREFIX.replace("'", "''")
    return (
        "WITH s AS (SELECT conv_id, turn, 'raw' AS kind, text AS q FROM conversations "
        f"UNION ALL SELECT conv_id, turn, 'templated' AS kind, '{tmpl}' || text || '''' AS q FROM conversations "
        "UNION ALL SELECT conv_id, turn, 'missing' AS kind, CASE WHEN role <> 'user' THEN text END AS q FROM conversations),\n"
        f"n AS (SELECT *, upper(trim(q, '{ws}')) AS u FROM s),\n"
        f"r AS (SELECT conv_id, turn, kind, {rule} AS rule FROM n)\n"
        f"SELECT conv_id, turn, kind, rule IS NULL AS allowed, rule, {msg} AS message FROM r"
    )


def _sides_sql(days_shared: int) -> str:
    """CTEs up to ``side``: Silver rows of the old (side 0) and the new run (side 1)."""
    a = "(epoch_us(CAST(ld.d AS TIMESTAMP)) // 1000000 + CASE WHEN side = 1 THEN 86399 ELSE -1 END)"
    return (
        f"WITH {DUCKDB_VIEW.strip()},\n"
        f"ld AS (SELECT max(snapshot_day) AS d FROM sv WHERE {_COMPLETE} AND {_GEO_OK}),\n"
        "parts AS (SELECT sv.*, 0 AS side FROM sv, ld WHERE snapshot_day < ld.d "
        f"UNION ALL SELECT sv.*, 1 AS side FROM sv, ld WHERE snapshot_day >= ld.d - {days_shared}),\n"
        "clean AS (SELECT p.* REPLACE (CASE WHEN side = 1 AND time_position % 10 = 0 THEN 'x' || icao24 ELSE icao24 END AS icao24), "
        f"{a} AS a FROM parts p, ld WHERE {_COMPLETE} AND {_GEO_OK}),\n"
        f"latest AS ({_winner('clean', 'side, icao24', _LATEST_ORDER)}),\n"
        f"side AS (SELECT side, last_contact AS lc, {_silver_select('a')} FROM latest)\n"
    )


def _upsert_sql() -> str:
    return (
        f"{_sides_sql(0)}SELECT {_SILVER} FROM side WHERE side = 1\n"
        f"UNION ALL SELECT {_SILVER} FROM side o WHERE side = 0 AND icao24 NOT IN (SELECT icao24 FROM side WHERE side = 1)"
    )


def _upsert_newer_sql() -> str:
    return f"{_sides_sql(1)}SELECT {_SILVER} FROM ({_winner('side', 'icao24', 'lc DESC NULLS LAST, side DESC')})"


def _incremental_sql() -> str:
    a = "(epoch_us(CAST(snapshot_day AS TIMESTAMP)) // 1000000 + 86399)"
    order = "snapshot_day DESC, " + _LATEST_ORDER
    return (
        f"WITH {DUCKDB_VIEW.strip()},\n"
        f"clean AS (SELECT *, {a} AS a FROM sv WHERE {_COMPLETE} AND {_GEO_OK}),\n"
        f"latest AS ({_winner('clean', 'icao24', order)})\n"
        f"SELECT {_silver_select('a')} FROM latest"
    )


def _expiry_sql() -> str:
    """Every run's end: the newest report of each aircraft up to then, its status derived anew at that moment."""
    a = "(epoch_us(CAST(snapshot_day AS TIMESTAMP)) // 1000000 + 86399)"
    order = "run_end DESC, " + _LATEST_ORDER
    return (
        f"WITH {DUCKDB_VIEW.strip()},\n"
        f"ends AS (SELECT DISTINCT {a} AS as_of FROM sv),\n"
        f"clean AS (SELECT *, {a} AS run_end FROM sv WHERE {_COMPLETE} AND {_GEO_OK}),\n"
        "known AS (SELECT ends.as_of, clean.* FROM ends JOIN clean ON clean.run_end <= ends.as_of),\n"
        f"latest AS ({_winner('known', 'as_of, icao24', order)})\n"
        f"SELECT CAST(as_of AS BIGINT) AS as_of, {_status('as_of')} AS status, count(*) AS n_aircraft, "
        "CAST(sum(last_contact) AS BIGINT) AS sum_last_contact FROM latest GROUP BY 1, 2"
    )


def _two_runs() -> str:
    """CTEs of the two-run pipeline: runs (r = 1, 2), silver1 and silver2 after each, gold2."""
    r1, r2 = run_stamp(FIRST_RUN_AS_OF), run_stamp(AS_OF)
    a = f"(CASE WHEN r = 1 THEN {FIRST_RUN_AS_OF} ELSE {AS_OF} END)"
    return (
        f"WITH {DUCKDB_VIEW.strip()},\n"
        f"runs AS (SELECT *, CASE WHEN run_ts <= '{r1}' THEN 1 ELSE 2 END AS r FROM sv),\n"
        f"stamp AS (SELECT * FROM (VALUES (1, '{r1}'), (2, '{r2}')) AS t(r, run)),\n"
        f"clean AS (SELECT *, {a} AS a FROM runs WHERE {_COMPLETE} AND {_GEO_OK}),\n"
        f"dd AS ({_winner('clean', 'r, icao24, last_contact', _DEDUP_ORDER)}),\n"
        f"latest AS ({_winner('clean', 'r, icao24', _LATEST_ORDER)}),\n"
        f"each_run AS (SELECT r, {_silver_select('a')} FROM latest),\n"
        "silver1 AS (SELECT * EXCLUDE (r) FROM each_run WHERE r = 1),\n"
        "silver2 AS (SELECT * EXCLUDE (r) FROM each_run WHERE r = 2 UNION ALL "
        "SELECT * FROM silver1 WHERE icao24 NOT IN (SELECT icao24 FROM each_run WHERE r = 2)),\n"
        f"gold2 AS (SELECT {_GOLD} FROM silver2 WHERE status <> 'EXPIRED'),\n"
        "cnt AS (SELECT r, count(*) AS input, "
        f"count(*) FILTER ({_NULL_CRIT}) AS null_records, count(*) FILTER ({_COMPLETE} AND {_GEO_BAD}) AS invalid_geo, "
        f"count(*) FILTER ({_COMPLETE} AND {_GEO_OK}) AS clean FROM runs GROUP BY r),\n"
        "ndd AS (SELECT r, count(*) AS deduped FROM dd GROUP BY r),\n"
        "tab AS (SELECT 1 AS r, count(*) AS table_rows FROM silver1 UNION ALL SELECT 2, count(*) FROM silver2),\n"
        "c AS (SELECT r, input, CAST(0 AS BIGINT) AS malformed, null_records, invalid_geo, clean, deduped, table_rows "
        "FROM cnt JOIN ndd USING (r) JOIN tab USING (r)),\n"
        "n2 AS (SELECT (SELECT count(*) FROM silver2) AS s, (SELECT count(*) FROM gold2) AS g)\n"
    )


def _damaged_sql() -> str:
    """CTE ``dec``: the fixture after encoding, damaging some lines and decoding."""
    types = (
        "VARCHAR VARCHAR VARCHAR BIGINT BIGINT DOUBLE DOUBLE DOUBLE BOOLEAN DOUBLE DOUBLE DOUBLE VARCHAR DOUBLE VARCHAR "
        "BOOLEAN BIGINT"
    ).split()

    def row(values: str) -> str:
        return ", ".join(f"CAST({v} AS {t})" for v, t in zip(values.split(), types, strict=True))

    null = row("NULL " * 17)
    short = row("'a' 'b' " + "NULL " * 15)
    suffix = row("'00x089' 'S' 'X' 1 2 3.5 NULL 0 FALSE 0 0 0 NULL 0 '1200' FALSE 0")
    epoch = row("'00x088' 'E' 'X' 1 253402300800 3.5 4.5 0 FALSE 0 0 0 NULL 0 '1200' FALSE 0")
    listed = row("'00x087' 'L' 'X' 1 2 3.5 4.5 10 TRUE 0 0 0 NULL 7.5 '7700' TRUE 1")
    return (
        f"WITH {DUCKDB_VIEW.strip()},\n"
        "kk AS (SELECT *, CAST(round(vertical_rate * 10 + 50) AS INTEGER) AS kx FROM sv),\n"
        f"dec AS (SELECT {_STATE}, NULL AS _decode_error, NULL AS _raw, run_ts FROM kk WHERE kx IS NULL OR kx NOT IN "
        f"({K_CUT}, {K_SHORT}, {K_SUFFIX}, {K_EPOCH}, {K_LIST})\n"
        f"UNION ALL SELECT {null}, 'unparsable', '[\"' || left(icao24, 7) || CASE WHEN length(icao24) < 7 THEN '\"' ELSE '' END, "
        f"run_ts FROM kk WHERE kx = {K_CUT}\n"
        f"UNION ALL SELECT {short}, 'short_row', '{SHORT_LINE}', run_ts FROM kk WHERE kx = {K_SHORT}\n"
        f"UNION ALL SELECT {suffix}, 'bad_value', '{SUFFIX_LINE}', run_ts FROM kk WHERE kx = {K_SUFFIX}\n"
        f"UNION ALL SELECT {epoch}, 'bad_value', '{EPOCH_LINE}', run_ts FROM kk WHERE kx = {K_EPOCH}\n"
        f"UNION ALL SELECT {listed}, NULL, NULL, run_ts FROM kk WHERE kx = {K_LIST})\n"
    )


def _damaged_array_sql() -> str:
    """CTE ``dec``: the fixture as indented snapshots, some states short, empty or nested, decoded."""
    null = ", ".join(f"NULL AS {c}" for c in _STATE.split(", "))
    short = null.replace("NULL AS icao24, NULL AS callsign", "'a' AS icao24, 'b' AS callsign")
    listed = "'00x087', 'L', 'X', 1, 2, 3.5, 4.5, 10, TRUE, 0, 0, 0, NULL, 7.5, '7700', TRUE, 1"
    return (
        f"WITH {DUCKDB_VIEW.strip()},\n"
        "kk AS (SELECT *, CAST(round(vertical_rate * 10 + 50) AS INTEGER) AS kx FROM sv),\n"
        f"dec AS (SELECT run_ts, {_STATE}, NULL AS _decode_error, NULL AS _raw FROM kk "
        f"WHERE kx IS NULL OR kx NOT IN ({K_CUT}, {K_SHORT}, {K_LIST})\n"
        f"UNION ALL SELECT run_ts, {null}, 'short_row', '[]' FROM kk WHERE kx = {K_CUT}\n"
        f"UNION ALL SELECT run_ts, {short}, 'short_row', '{SHORT_LINE}' FROM kk WHERE kx = {K_SHORT}\n"
        f"UNION ALL SELECT run_ts, {listed}, NULL, NULL FROM kk WHERE kx = {K_LIST})\n"
    )


def _ledger_sql() -> str:
    """CTEs of the three ledger runs: n rows each, ok whether they pass, and the rows as Silver has them."""
    a1, a2, a3 = LEDGER_RUNS
    s1, s2, s3 = (run_stamp(a) for a in LEDGER_RUNS)
    a = f"(CASE r WHEN 1 THEN {a1} WHEN 2 THEN {a2} ELSE {a3} END)"
    return (
        f"WITH {DUCKDB_VIEW.strip()},\n"
        f"runs AS (SELECT *, CASE WHEN run_ts <= '{s1}' THEN 1 WHEN run_ts <= '{s2}' THEN 2 ELSE 3 END AS r FROM sv),\n"
        f"stamp AS (SELECT * FROM (VALUES (1, '{s1}'), (2, '{s2}'), (3, '{s3}')) AS t(r, run)),\n"
        f"n AS (SELECT r, run, count(*) AS n, count(*) >= {LEDGER_MIN_ROWS} AS ok FROM runs JOIN stamp USING (r) GROUP BY r, run),\n"
        f"clean AS (SELECT *, {a} AS a FROM runs WHERE {_COMPLETE} AND {_GEO_OK} AND r IN (SELECT r FROM n WHERE ok)),\n"
        f"latest AS ({_winner('clean', 'icao24', 'r DESC, ' + _LATEST_ORDER)}),\n"
        "commits AS (SELECT r, run, n, ok, r AS v, r = 1 AS old FROM n UNION ALL SELECT r, run, n, ok, 4 AS v, FALSE FROM n WHERE r = 1),\n"
        "took AS (SELECT *, count(*) FILTER (ok) OVER (ORDER BY v) AS sv FROM commits)\n"
    )


def oracle_sql() -> dict[str, str]:
    v = f"WITH {DUCKDB_VIEW.strip()}\n"
    silver_all = f"{_BASE}, dd AS ({_winner('clean', 'icao24, last_contact', _DEDUP_ORDER)})\n"
    complete = f"SELECT * FROM sv WHERE {_COMPLETE}"
    more = {} if llm_queries is None else dict(llm_queries.ORACLE_SQL)
    if corpus_pipeline is not None and corpus_pipeline.ORACLE_SQL:
        more["pipeline"] = corpus_pipeline.ORACLE_SQL
    return more | {
        "bronze_decode": f"{_damaged_sql()}SELECT {_STATE}, _decode_error, _raw FROM dec",
        "bronze_decode_array": f"{_damaged_array_sql()}SELECT run_ts, {_STATE}, _decode_error, _raw FROM dec",
        "land_snapshots": f"{v}SELECT run_ts, count(*) AS n_states, count(*) AS n_decoded FROM sv GROUP BY run_ts",
        "latest_snapshot": (
            f"{v}SELECT run_ts, 'bronze/run_ts=' || run_ts AS output_path, count(*) AS record_count "
            "FROM sv GROUP BY run_ts ORDER BY run_ts DESC LIMIT 1"
        ),
        "count_gate": (
            f"{v}SELECT run_ts, count(*) AS n, count(*) >= 1000 AS bronze_ok, "
            f"count(*) >= 5000 AS silver_ok FROM sv GROUP BY run_ts"
        ),
        "null_records": f"{v}SELECT * FROM sv WHERE {_NULL_CRIT}",
        "complete_rows": f"{v}{complete}",
        "valid_geo": f"{v}{complete} AND {_GEO_OK}",
        "invalid_geo": f"{v}{complete} AND {_GEO_BAD}",
        "invalid_geo_distinct": f"{v}({complete}) EXCEPT ({complete} AND {_GEO_OK})",
        "quarantine": (
            f"{_damaged_sql()}SELECT *, 'malformed' AS dq_reason FROM dec WHERE _decode_error IS NOT NULL "
            f"UNION ALL SELECT *, 'null_records' AS dq_reason FROM dec WHERE _decode_error IS NULL AND {_NULL_CRIT} "
            f"UNION ALL SELECT *, 'invalid_geo' AS dq_reason FROM dec WHERE _decode_error IS NULL AND {_COMPLETE} AND {_GEO_BAD}"
        ),
        "dedup_states": f"{_BASE}{_winner('clean', 'icao24, last_contact', _DEDUP_ORDER)}",
        "latest_per_aircraft": f"{_BASE}SELECT * FROM latest",
        "flight_status": (
            f"{v}SELECT *, {_status(str(AS_OF))} AS status, {_reason(str(AS_OF))} AS status_reason FROM sv"
        ),
        "source_type": f"{v}SELECT *, {_source_type()} AS source_type FROM sv",
        "epoch_to_text": (
            f"{v}SELECT * REPLACE ({_text('time_position')} AS time_position, "
            f"{_text('last_contact')} AS last_contact) FROM sv"
        ),
        "silver_layer": f"{silver_all}SELECT {_silver_select(str(AS_OF))} FROM dd",
        "silver_upsert": _upsert_sql(),
        "silver_upsert_newer": _upsert_newer_sql(),
        "gold_layer": f"{_BASE}SELECT * FROM flights_gold",
        "stage_counts": (
            f"{_two_runs()}"
            "SELECT 'silver' AS job, CAST(r AS BIGINT) AS version, stage, n FROM c UNPIVOT (n FOR stage IN "
            "(input, malformed, null_records, invalid_geo, clean, deduped, table_rows)) "
            "UNION ALL SELECT 'gold', v, 'gold_input', s FROM n2, (VALUES (1), (2)) AS t(v) "
            "UNION ALL SELECT 'gold', v, 'gold_rows', g FROM n2, (VALUES (1), (2)) AS t(v)"
        ),
        "run_manifest": (
            f"{_two_runs()}"
            "SELECT 'bronze' AS stage, CAST(r AS BIGINT) AS version, run AS run_ts, input AS record_count FROM c JOIN stamp USING (r) "
            "UNION ALL SELECT 'silver', r, run, deduped FROM c JOIN stamp USING (r) "
            "UNION ALL SELECT 'gold', v, (SELECT run FROM stamp WHERE r = 2), g FROM n2, (VALUES (1), (2)) AS t(v)"
        ),
        "run_config": (
            f"{_two_runs()}"
            "SELECT run AS run_ts, input AS total_records, deduped AS silver_record_count, "
            "CASE WHEN r = 2 THEN (SELECT g FROM n2) END AS gold_record_count FROM c JOIN stamp USING (r)"
        ),
        "run_ledger": (
            f"{_ledger_sql()}"
            "SELECT run AS run_ts, CAST(v AS BIGINT) AS bronze_version, n AS record_count, "
            "CASE WHEN old THEN 'superseded' WHEN ok THEN 'taken' ELSE 'rejected' END AS state, "
            "CASE WHEN ok THEN CAST(sv AS BIGINT) END AS silver_version, "
            "CASE WHEN NOT ok THEN 'count gate: only ' || n || ' state vectors in run ' || run || ', at least "
            f"{LEDGER_MIN_ROWS} are needed' END AS note FROM took"
        ),
        "silver_corrected": f"{_ledger_sql()}SELECT {_silver_select('a')} FROM latest",
        "silver_written": f"{_two_runs()}SELECT {_SILVER} FROM silver2",
        "gold_written": f"{_two_runs()}SELECT * FROM gold2",
        "gold_written_partitioned": f"{_two_runs()}SELECT *, status AS status_part FROM gold2",
        "incremental_silver": _incremental_sql(),
        "incremental_gated": f"{_ledger_sql()}SELECT {_silver_select('a')} FROM latest",
        "status_expiry": _expiry_sql(),
        "airborne_in_bbox": (
            f"{_BASE}SELECT count(*) AS n_airborne FROM flights_gold WHERE status = 'AIRBORNE' "
            f"AND latitude BETWEEN {BBOX[0]} AND {BBOX[1]} AND longitude BETWEEN {BBOX[2]} AND {BBOX[3]}"
        ),
        "gold_by_location": (
            f"{_BASE}SELECT * FROM flights_gold WHERE latitude BETWEEN {BBOX[0]} AND {BBOX[1]} "
            f"AND longitude BETWEEN {BBOX[2]} AND {BBOX[3]}"
        ),
        "airborne_by_origin": (
            f"{_BASE}SELECT origin_country, count(*) AS n_airborne FROM flights_gold "
            f"WHERE status = 'AIRBORNE' GROUP BY origin_country"
        ),
        "top_countries": (
            f"{_BASE}SELECT origin_country, count(*) AS n_flights FROM flights_gold GROUP BY origin_country "
            f"ORDER BY n_flights DESC, origin_country ASC LIMIT {TOP_K}"
        ),
        "inactive_flights": f"{_BASE}SELECT * FROM flights_gold WHERE status = 'INACTIVE'",
        "adsb_share": (
            f"{_BASE}SELECT CAST(100.0 AS DOUBLE) * count(*) FILTER (WHERE source_type = 'ADS-B') "
            "/ nullif(count(*), 0) AS adsb_pct FROM flights_gold"
        ),
        "climb_descend": (
            f"{_BASE}SELECT CASE WHEN vertical_rate > 0 THEN 'climbing' WHEN vertical_rate < 0 THEN 'descending' "
            "WHEN vertical_rate = 0 THEN 'level' ELSE 'unknown' END AS direction, count(*) AS n_flights "
            "FROM flights_gold GROUP BY 1"
        ),
        "gold_sql": f"{_BASE}{GOLD_SQL}",
        "gold_sql_scope": (
            f"{_BASE}SELECT 0 AS statement, TRUE AS allowed, count(*) AS n_rows FROM flights_gold "
            "UNION ALL SELECT 1, TRUE, count(*) FROM (SELECT DISTINCT status, source_type FROM flights_gold) "
            "UNION ALL SELECT 2, TRUE, count(*) FROM flights_gold WHERE vertical_rate > 0 "
            "UNION ALL SELECT 3, TRUE, count(*) FROM flights_gold WHERE velocity > (SELECT avg(velocity) FROM flights_gold) "
            "UNION ALL SELECT CAST(i AS INTEGER), FALSE, NULL FROM range(100, 112) AS t(i)"
        ),
        "sql_audit": _audit_sql(),
    }

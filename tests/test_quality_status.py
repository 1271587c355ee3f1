"""Edge rows: DQ splits, status thresholds, source types, dedup winners, gates."""

import math

import pytest
from pyspark.sql import functions as F

from contrail import schema as S
from contrail.operators import (
    check_count,
    complete_rows,
    dedup_states,
    flight_status,
    invalid_geo,
    latest_per_aircraft,
    null_records,
    quarantine_rows,
    source_type,
    valid_geo,
)
from contrail.plans.layers import gold, silver
from contrail.sources.bronze import DataQualityError

NOW = 1_700_000_000


def state(icao="a1", callsign="C1", country="X", lat=10.0, lon=20.0, lc=NOW, tp=NOW, ground=False, ps=0, **kw):
    row = {c: None for c in S.STATE_COLUMNS}
    row.update(
        icao24=icao, callsign=callsign, origin_country=country, latitude=lat, longitude=lon,
        last_contact=lc, time_position=tp, on_ground=ground, position_source=ps, spi=False,
    )
    row.update(kw)
    return tuple(row[c] for c in S.STATE_COLUMNS)


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), S.STATE_SCHEMA)


def test_geo_bounds_inclusive_and_nan(spark):
    df = frame(
        spark,
        state(callsign="edge1", lat=90.0, lon=180.0),
        state(callsign="edge2", lat=-90.0, lon=-180.0),
        state(callsign="out1", lat=90.0001, lon=0.0),
        state(callsign="out2", lat=0.0, lon=-180.0001),
        state(callsign="nan", lat=float("nan"), lon=0.0),
    )
    c = complete_rows(df)
    assert sorted(r.callsign for r in valid_geo(c).collect()) == ["edge1", "edge2"]
    bad = sorted(r.callsign for r in invalid_geo(c).collect())
    assert bad == ["nan", "out1", "out2"]
    assert null_records(df).count() == 0  # NaN is a value, not a null


def test_null_critical_rows_and_blank_countries(spark):
    df = frame(
        spark,
        state(callsign="n_icao", icao=None),
        state(callsign="n_country", country=None),
        state(callsign="n_lat", lat=None),
        state(callsign="n_lon", lon=None),
        state(callsign="blank", country=""),
        state(callsign="nullword", country="NULL"),
        state(callsign="ok"),
    )
    logged = sorted(r.callsign for r in null_records(df).collect())
    assert logged == ["blank", "n_country", "n_icao", "n_lat", "n_lon", "nullword"]
    kept = sorted(r.callsign for r in complete_rows(df).collect())
    assert kept == ["blank", "nullword", "ok"]  # logged AND kept
    assert sorted(r.callsign for r in complete_rows(df, drop_blank_country=True).collect()) == ["ok"]
    # local rule: only real nulls are logged
    assert null_records(df, blank_country=False).count() == 4


def test_invalid_geo_bag_vs_set(spark):
    twice = state(callsign="bad", lat=100.0)
    df = complete_rows(frame(spark, twice, twice))
    assert invalid_geo(df).count() == 2
    assert invalid_geo(df, distinct=True).count() == 1


def test_quarantine_reasons_overlap(spark):
    df = frame(spark, state(callsign="blank_bad", country="", lat=100.0), state(callsign="ok"))
    reasons = sorted((r.callsign, r.dq_reason) for r in quarantine_rows(df).collect())
    assert reasons == [("blank_bad", "invalid_geo"), ("blank_bad", "null_records")]


@pytest.mark.parametrize(
    "age,ground,expect",
    [
        (10800, False, ("AIRBORNE", "in_air")),
        (10801, False, ("INACTIVE", "last_contact_exceeded_3hrs")),
        (21600, False, ("INACTIVE", "last_contact_exceeded_3hrs")),
        (21601, False, ("EXPIRED", "last_contact_exceeded_6hrs")),
        (30000, True, ("LANDED", "on_ground_flag")),
        (5, None, ("AIRBORNE", "in_air")),
        (30000, None, ("EXPIRED", "last_contact_exceeded_6hrs")),
    ],
)
def test_status_thresholds(spark, age, ground, expect):
    df = frame(spark, state(lc=NOW - age, ground=ground))
    r = flight_status(df, NOW).first()
    assert (r.status, r.status_reason) == expect


def test_status_null_last_contact_and_label(spark):
    df = frame(spark, state(lc=None, ground=None))
    r = flight_status(df, NOW, airborne_label="Airborne").first()
    assert (r.status, r.status_reason) == ("Airborne", "in_air")


def test_source_types(spark):
    rows = [state(callsign=str(i), ps=p) for i, p in enumerate([0, 1, 2, 3, 4, None])]
    got = {r.callsign: r.source_type for r in source_type(frame(spark, *rows)).collect()}
    assert [got[str(i)] for i in range(6)] == ["ADS-B", "ASTERIX", "MLAT", "FLARM", "UNKNOWN", "UNKNOWN"]


def test_dedup_and_latest(spark):
    df = frame(
        spark,
        state(callsign="old", lc=NOW - 100, tp=NOW - 100),
        state(callsign="new", lc=NOW, tp=NOW - 5),
        state(callsign="new_later_pos", lc=NOW, tp=NOW - 1),
        state(callsign="nolc1", lc=None, tp=1),
        state(callsign="nolc2", lc=None, tp=2),
    )
    d = {r.callsign for r in dedup_states(df).collect()}
    assert d == {"old", "new_later_pos", "nolc2"}  # null last_contact is one group
    latest = latest_per_aircraft(dedup_states(df)).collect()
    assert [r.callsign for r in latest] == ["new_later_pos"]


def test_dedup_winner_independent_of_partitioning(spark):
    rows = [state(icao=f"a{i % 7}", callsign=f"C{i}", lc=NOW - (i % 5), tp=NOW - (i % 3)) for i in range(300)]
    df = frame(spark, *rows)
    one = sorted(tuple(r) for r in dedup_states(df.coalesce(1)).collect())
    many = sorted(tuple(r) for r in dedup_states(df.repartition(8)).collect())
    assert one == many
    l1 = sorted(tuple(r) for r in latest_per_aircraft(df.coalesce(1)).collect())
    l8 = sorted(tuple(r) for r in latest_per_aircraft(df.repartition(8, "callsign")).collect())
    assert l1 == l8


def test_silver_and_gold_shapes(spark):
    df = frame(
        spark,
        state(callsign="fresh", icao="f1", lc=NOW - 10),
        state(callsign="stale", icao="s1", lc=NOW - 30000),
        state(callsign="bad", icao="b1", lat=200.0),
    )
    s = silver(df, NOW)
    assert s.columns[: len(S.SILVER_COLUMNS)] == list(S.SILVER_COLUMNS)
    rows = {r.callsign: r for r in s.collect()}
    assert set(rows) == {"fresh", "stale"}
    assert rows["fresh"].last_contact == "2023-11-14 22:13:10"
    assert rows["stale"].status == "EXPIRED"
    g = gold(s)
    assert g.columns == list(S.GOLD_COLUMNS)
    assert [r.callsign for r in g.collect()] == ["fresh"]
    assert g.schema["velocity"].metadata["comment"] == S.GOLD_COMMENTS["velocity"]
    # restatus: the frozen AIRBORNE row ages out when re-evaluated later
    assert gold(s, restatus_as_of=NOW + 30000).count() == 0


def test_epoch_text_ignores_session_zone(spark):
    df = frame(spark, state(lc=NOW))
    before = silver(df, NOW).first().last_contact
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        after = silver(df, NOW).first().last_contact
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert before == after == "2023-11-14 22:13:20"


def test_out_of_range_epoch_is_null_not_error(spark):
    df = frame(spark, state(lc=10**15, tp=-(10**15)))
    r = silver(df, NOW).first()
    assert r.last_contact is None and r.time_position is None


@pytest.mark.parametrize("n,minimum,ok", [(999, 1000, False), (1000, 1000, True), (4999, 5000, False),
                                          (5000, 5000, True), (0, 0, False)])
def test_count_gates(n, minimum, ok):
    if ok:
        check_count(n, minimum)
    else:
        with pytest.raises(DataQualityError):
            check_count(n, minimum)


def test_time_helpers_zone_free_across_dst(spark):
    from contrail.functions.time import epoch_to_text, ntz_to_epoch, run_ts_to_epoch

    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/Los_Angeles", "Europe/Berlin"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            r = spark.range(1).select(
                ntz_to_epoch(F.expr("TIMESTAMP_NTZ '2024-07-01 00:00:00'")).alias("summer"),
                ntz_to_epoch(F.expr("TIMESTAMP_NTZ '1969-12-31 23:59:59'")).alias("neg"),
                epoch_to_text(F.lit(1710037800)).alias("gap"),  # 02:30 UTC: inside the LA DST gap
                run_ts_to_epoch(F.lit("20240331_013000")).alias("run"),  # inside the Berlin DST gap
            ).first()
            assert (r.summer, r.neg, r.gap, r.run) == (1719792000, -1, "2024-03-10 02:30:00", 1711848600), zone
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_quarantine_reasons_in_one_pass(spark):
    df = frame(
        spark,
        state(callsign="ok"),
        state(callsign="blank", country=""),
        state(callsign="nolat", lat=None),
        state(callsign="far", lat=91.0),
        state(callsign="blank_far", country="", lat=91.0),
    )
    from contrail.operators import quarantine_rows

    out = quarantine_rows(df)
    got = sorted((r.callsign, r.dq_reason) for r in out.collect())
    assert got == [
        ("blank", "null_records"), ("blank_far", "invalid_geo"), ("blank_far", "null_records"),
        ("far", "invalid_geo"), ("nolat", "null_records"),
    ]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Union" not in plan and plan.count("Generate explode") == 1

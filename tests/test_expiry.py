"""Status changes by silence: the stream's log, read at any moment, is the status derived anew at that moment."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from contrail.plans.jobs import stamp_epoch
from contrail.sources import land_snapshots
from contrail.streaming import expiry
from contrail.streaming.expiry import CHANGES_SCHEMA, run_expiry, status_at
from test_store_stream import _envelopes, _js

RUNS = [f"2023111{d}_{h:02d}0000" for d in (4, 5) for h in (0, 2, 9, 10, 22)]


def _reports():
    rng = random.Random(4)
    out = {}
    for run in RUNS:
        end = stamp_epoch(run)
        out[run] = []
        for i in range(25):
            if rng.random() < 0.5:
                row = _js(f"{i:06x}", f"C{rng.randint(0, 99)}", end - rng.choice([0, 60, 10800, 10801, 21600, 21601, 90000]))
                row[8] = rng.choice([True, False, False, None])
                if rng.random() < 0.1:
                    row[3] = row[4] = None
                out[run] += [row] * rng.choice([1, 1, 3])
        out[run].append(_js(None, "no address", end))
    return out


def _derived(reports, moment):
    newest = {}
    for run in RUNS:
        if stamp_epoch(run) <= moment:
            mine = {}
            for r in reports[run]:
                key = tuple((x is not None, x) for x in (r[4], r[3], r[1], r[8]))
                if r[0] and (r[0] not in mine or key > mine[r[0]][0]):
                    mine[r[0]] = (key, r)
            newest |= {k: r for k, (_, r) in mine.items()}
    out = {}
    for k, r in newest.items():
        age = None if r[4] is None else moment - r[4]
        out[k] = "LANDED" if r[8] else "AIRBORNE" if age is None or age <= 10800 else "INACTIVE" if age <= 21600 else "EXPIRED"
    return out


@pytest.mark.parametrize("files", [1, None])
def test_log_read_at_a_moment_is_the_status_then(spark, scratch, files):
    reports = _reports()
    land_snapshots(_envelopes(spark, reports), f"{scratch}/bronze")
    q = run_expiry(spark, f"{scratch}/bronze", f"{scratch}/changes", f"{scratch}/ckpt", max_files_per_trigger=files)
    q.awaitTermination()
    assert q.exception() is None
    changes = spark.read.schema(CHANGES_SCHEMA).parquet(f"{scratch}/changes")
    ends = [stamp_epoch(r) for r in RUNS]
    moments = sorted({*ends, *(e + s for e in ends[:-1] for s in (1, 3600, 10801, 15000) if e + s < ends[-1])})
    got = {}
    for r in status_at(changes, F.array(*(F.lit(m).cast("long") for m in moments))).collect():
        got.setdefault(r.as_of, {})[r.icao24] = r.status
    for m in moments:
        assert got.get(m, {}) == _derived(reports, m), m
    # Silence alone turned some aircraft: changes that no run reported.
    assert changes.filter("since > run_as_of AND status = 'EXPIRED'").count() > 0


def test_silent_aircraft_expires_when_others_report(spark, scratch):
    """Two starts of the same stream: the second reads a run without the aircraft, and its timers fire."""
    first, second, third = "20231114_000000", "20231114_040000", "20231114_080000"
    t = stamp_epoch(first)

    def go():
        q = run_expiry(spark, f"{scratch}/bronze", f"{scratch}/changes", f"{scratch}/ckpt")
        q.awaitTermination()
        assert q.exception() is None
        rows = spark.read.schema(CHANGES_SCHEMA).parquet(f"{scratch}/changes").filter("icao24 = '00000a'").collect()
        return sorted((r.since - t, r.status) for r in rows)

    land_snapshots(_envelopes(spark, {first: [_js("00000a", "A", t)]}), f"{scratch}/bronze")
    assert go() == [(0, "AIRBORNE")]
    land_snapshots(_envelopes(spark, {second: [_js("00000b", "B", t + 14400)]}), f"{scratch}/bronze")
    assert go() == [(0, "AIRBORNE"), (10801, "INACTIVE")]
    land_snapshots(_envelopes(spark, {third: [_js("00000b", "B", t + 28800)]}), f"{scratch}/bronze")
    assert go() == [(0, "AIRBORNE"), (10801, "INACTIVE"), (21601, "EXPIRED")]


def test_files_come_in_any_order_and_runs_in_pieces(spark, scratch):
    """Files are read by modification time: runs that were landed together come in any order, each in several batches."""
    rng = random.Random(9)
    reports = {}
    for run in RUNS:
        end = stamp_epoch(run)
        reports[run] = []
        for i in rng.sample(range(30), 20):
            for _ in range(rng.randint(1, 4)):
                last = end - rng.choice([0, 10800, 10801, 21601, 90000])
                row = _js(f"{i:06x}", rng.choice(["A", "B", None]), last)
                row[3], row[8] = last - rng.randint(0, 1), rng.choice([True, False, None])
                reports[run].append(row)
    pieces = [(run, rows[k::4]) for run, rows in reports.items() for k in range(4)]
    rng.shuffle(pieces)
    root = scratch.removeprefix("file:")
    for n, (run, rows) in enumerate(pieces):
        os.makedirs(folder := f"{root}/bronze/run_ts={run}", exist_ok=True)
        with open(path := f"{folder}/part-{n:05d}.txt", "w") as f:
            f.writelines(json.dumps(r) + "\n" for r in rows)
        os.utime(path, (1e9 + n, 1e9 + n))
    q = run_expiry(spark, f"{root}/bronze", f"{root}/changes", f"{root}/ckpt", max_files_per_trigger=4, groups=3)
    q.awaitTermination()
    assert q.exception() is None
    # A few groups of aircraft are the stream's keys, not each aircraft.
    assert q.lastProgress.stateOperators[0].numRowsTotal == 3
    changes = spark.read.schema(CHANGES_SCHEMA).parquet(f"{root}/changes")
    ends = [stamp_epoch(r) for r in RUNS]
    moments = sorted({*ends, *(e + s for e in ends[:-1] for s in (1, 3600, 10801, 15000) if e + s < ends[-1])})
    got = {}
    for r in status_at(changes, F.array(*(F.lit(m).cast("long") for m in moments))).collect():
        assert r.icao24 not in got.setdefault(r.as_of, {})
        got[r.as_of][r.icao24] = r.status
    for m in moments:
        assert got.get(m, {}) == _derived(reports, m), m


def test_a_line_is_parsed_once(spark):
    """The filter on decoded columns is not pushed below the decoding, which it would repeat for each use of a column."""
    df = expiry.reports(spark.read.text(__file__).withColumn("run_ts", F.lit(RUNS[0])))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1 and plan.index("Filter") < plan.index("from_json")


@pytest.mark.parametrize("given", [None, 3])
def test_state_partitions_are_given_or_follow_the_cores(spark, scratch, given):
    setting = "spark.sql.shuffle.partitions"
    before, cores = spark.conf.get(setting), spark.sparkContext.defaultParallelism
    land_snapshots(_envelopes(spark, {RUNS[0]: [_js("00000a", "A", stamp_epoch(RUNS[0]))]}), f"{scratch}/bronze")
    spark.conf.set(setting, str(5 * cores))
    try:
        q = run_expiry(spark, f"{scratch}/bronze", f"{scratch}/changes", f"{scratch}/ckpt", state_partitions=given)
        q.awaitTermination()
        assert q.exception() is None and spark.conf.get(setting) == str(5 * cores)
        assert q.lastProgress.stateOperators[0].numShufflePartitions == (given or 2 * cores)
    finally:
        spark.conf.set(setting, before)

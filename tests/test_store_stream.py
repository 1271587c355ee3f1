"""Upsert semantics, versioned store, jobs end to end, incremental = batch."""

import contextlib
import io
import json

import pytest

from pyspark.sql import functions as F

from contrail import schema as S
from contrail.operators import latest_per_aircraft, upsert
from contrail.plans.jobs import read_gold, run_bronze, run_gold, run_silver
from contrail.plans.layers import silver, visible
from contrail.sinks import TableStore, read_quarantine, read_silver
from contrail.sources import land_snapshots
from contrail.sources.bronze import DataQualityError
from contrail.streaming import run_incremental

from test_quality_status import NOW, frame, state


def _silver_rows(spark, *rows, as_of=NOW):
    return latest_per_aircraft(silver(frame(spark, *rows), as_of))


def _key(df):
    return sorted((r.icao24, r.callsign) for r in df.collect())


def test_upsert_matched_inserted_kept(spark):
    existing = _silver_rows(spark, state(icao="t1", callsign="T"), state(icao="m1", callsign="M_old"))
    new = _silver_rows(spark, state(icao="m1", callsign="M_new"), state(icao="s1", callsign="S"))
    out = upsert(existing, new)
    assert _key(out) == [("m1", "M_new"), ("s1", "S"), ("t1", "T")]
    # idempotent, unique keys
    twice = upsert(out, new)
    assert _key(twice) == _key(out)
    assert twice.groupBy("icao24").count().filter("count > 1").count() == 0


def test_older_row_replaces_by_default_but_not_newer_only(spark):
    existing = _silver_rows(spark, state(icao="a1", callsign="NEW", lc=NOW))
    older = _silver_rows(spark, state(icao="a1", callsign="OLD", lc=NOW - 500))
    assert _key(upsert(existing, older)) == [("a1", "OLD")]
    assert _key(upsert(existing, older, order_by=[S.LAST_CONTACT_EPOCH])) == [("a1", "NEW")]


def test_upsert_plan_broadcasts_small_key_set(spark, scratch):
    big = spark.range(200_000).select(
        F.format_string("%06x", "id").alias("icao24"), F.col("id").cast("string").alias("callsign")
    )
    big.write.parquet(f"{scratch}/existing")
    spark.createDataFrame([("000001", "X")], "icao24 string, callsign string").write.parquet(f"{scratch}/new")
    # new side sized from its file statistics -> under the broadcast threshold
    new = spark.read.parquet(f"{scratch}/new")
    existing = spark.read.parquet(f"{scratch}/existing")
    plan = upsert(existing, new)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    # an unsized side is not broadcast blindly: sort-merge (AQE may still convert at run time)
    unsized = spark.createDataFrame([("000001", "X")], "icao24 string, callsign string")
    plan2 = upsert(existing, unsized)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan2
    assert upsert(existing, new).count() == 200_000


def _envelopes(spark, runs):
    """runs: {run_ts: [state rows as JSON-able lists]}"""
    data = [(run, json.dumps({"time": 1, "states": states})) for run, states in runs.items()]
    return spark.createDataFrame(data, "run_ts string, body string")


def _js(icao, callsign, lc, lat=10.0, country="X"):
    return [icao, callsign, country, lc, lc, 20.0, lat, 100.0, False, 1.0, 0.0, 0.0, None, None, None, False, 0]


def test_jobs_end_to_end(spark, scratch):
    store = TableStore(spark, f"{scratch}/store")
    r1 = "20231114_220000"
    states1 = [_js(f"{i:06x}", f"A{i}", NOW - 100) for i in range(6)] + [_js("bad", "B", NOW, lat=100.0)]
    run_bronze(spark, _envelopes(spark, {r1: states1}), f"{scratch}/bronze", store, min_rows=5)
    res = run_silver(spark, store, min_rows=5, quarantine_dir=f"{scratch}/q")
    assert res.counts["input"] == 7 and res.counts["invalid_geo"] == 1 and res.counts["table_rows"] == 6
    q = read_quarantine(spark, f"{scratch}/q").collect()
    assert [(r.dq_reason, r.icao24) for r in q] == [("invalid_geo", "bad")]
    # second run: one aircraft updated, one new; old ones kept
    r2 = "20231114_230000"
    states2 = [_js("000001", "A1v2", NOW)] + [_js("0000ff", "NEW", NOW)] + [
        _js(f"{i:06x}", f"C{i}", NOW) for i in range(100, 104)
    ]
    run_bronze(spark, _envelopes(spark, {r2: states2}), f"{scratch}/bronze", store, min_rows=5)
    res2 = run_silver(spark, store, min_rows=5)
    table = {r.icao24: r.callsign for r in read_silver(store).collect()}
    assert res2.counts["table_rows"] == len(table) == 11
    assert table["000001"] == "A1v2" and table["000002"] == "A2"
    g = run_gold(spark, store)
    assert g.record_count == 11  # statuses at the run stamps: nothing older than 6 h
    # versions and manifest
    m = store.manifest().orderBy("stage", "version").collect()
    assert [(r.stage, r.version) for r in m] == [
        ("bronze", 1), ("bronze", 2), ("gold", 1), ("silver", 1), ("silver", 2)
    ]
    assert read_silver(store, version=1).count() == 6  # time travel
    # local layout: Gold partitioned by country, same rows and columns when read back
    g2 = run_gold(spark, store, partition_by="origin_country")
    back = read_gold(store)
    assert g2.version == 2 and back.count() == 11 and sorted(back.columns) == sorted(S.GOLD_COLUMNS)


def test_bronze_gate_blocks_small_run(spark, scratch):
    store = TableStore(spark, f"{scratch}/store")
    states = [_js(f"{i:06x}", "A", NOW) for i in range(3)]
    try:
        run_bronze(spark, _envelopes(spark, {"20231114_220000": states}), f"{scratch}/bronze", store)
        raise AssertionError("gate should fail")
    except DataQualityError:
        pass
    assert store.current("bronze") is None


def test_incremental_equals_batch_fold_and_restart(spark, scratch):
    runs = {}
    for d in range(5):
        run = f"2023111{d}_120000"
        runs[run] = [_js(f"{i:06x}", f"R{d}_{i}", 1699500000 + d * 86400 + i) for i in range(d, d + 6)]
    land_snapshots(_envelopes(spark, runs), f"{scratch}/bronze")
    store = TableStore(spark, f"{scratch}/store")
    q = run_incremental(spark, f"{scratch}/bronze", store, f"{scratch}/ckpt", max_files_per_trigger=2)
    q.awaitTermination()
    assert q.exception() is None
    got = sorted((r.icao24, r.callsign, r.status) for r in visible(read_silver(store)).collect())
    # batch fold: latest run per aircraft wins
    expect = {}
    for d, run in enumerate(sorted(runs)):
        for s in runs[run]:
            expect[s[0]] = s[1]
    assert [(a, c) for a, c, _ in got] == sorted(expect.items())
    versions = store.manifest().filter("stage = 'silver'").count()
    # restart with the same checkpoint: nothing new, no new version
    q2 = run_incremental(spark, f"{scratch}/bronze", store, f"{scratch}/ckpt")
    q2.awaitTermination()
    assert store.manifest().filter("stage = 'silver'").count() == versions


def test_read_silver_prunes_country_partitions(spark, scratch):
    store = TableStore(spark, f"{scratch}/store")
    states = [_js(f"{i:06x}", f"A{i}", NOW, country=c) for i, c in enumerate(["X", "Y", "", "X", "7"])]
    run_bronze(spark, _envelopes(spark, {"20231114_220000": states}), f"{scratch}/bronze", store, min_rows=1)
    run_silver(spark, store, min_rows=1)
    df = read_silver(store, countries=["X", ""])
    assert sorted(r.origin_country for r in df.collect()) == ["", "X", "X"]
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    part = [ln for ln in buf.getvalue().splitlines() if ln.startswith("PartitionFilters")]
    assert part and "country_part" in part[0] and "__blank__" in part[0]
    assert sorted(r.origin_country for r in read_silver(store, countries=["7"]).collect()) == ["7"]


def test_incremental_array_files_and_quarantine(spark, scratch):
    import os

    base = scratch.replace("file:", "")
    os.makedirs(f"{base}/raw", exist_ok=True)
    snap1 = [_js("000001", "A", NOW - 60), _js("000002", "B", NOW - 60), _js("bad001", "X", NOW, lat=95.0)]
    snap2 = [_js("000001", "A2", NOW), ["short"]]
    with open(f"{base}/raw/aircraft_data_20231114_220000.json", "w") as f:
        json.dump(snap1, f, indent=4)
    with open(f"{base}/raw/aircraft_data_20231114_221000.json", "w") as f:
        json.dump(snap2, f, indent=4)
    store = TableStore(spark, f"{scratch}/store")
    q = run_incremental(
        spark, f"{base}/raw", store, f"{scratch}/ckpt", fmt="array", quarantine_dir=f"{scratch}/q",
        max_files_per_trigger=1,
    )
    q.awaitTermination()
    assert q.exception() is None
    table = {r.icao24: (r.callsign, r.status) for r in read_silver(store).collect()}
    assert table == {"000001": ("A2", "AIRBORNE"), "000002": ("B", "AIRBORNE")}
    qrows = sorted((r.dq_reason, r.run_ts) for r in read_quarantine(spark, f"{scratch}/q").collect())
    assert qrows == [("invalid_geo", "20231114_220000"), ("malformed", "20231114_221000")]


def test_recency_merge_reads_each_side_once(spark, scratch):
    big = spark.range(50_000).select(
        F.format_string("%06x", "id").alias("icao24"), F.col("id").alias("v"), F.lit(0).alias("r")
    )
    big.write.parquet(f"{scratch}/existing")
    spark.createDataFrame([("000001", 7, 1), ("0ffff0", 9, 1), ("000002", -1, -1)], "icao24 string, v long, r int") \
        .write.parquet(f"{scratch}/new")
    existing, new = spark.read.parquet(f"{scratch}/existing"), spark.read.parquet(f"{scratch}/new")
    out = upsert(existing, new, order_by=["r"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2 and "Join" not in plan
    rows = {r.icao24: (r.v, r.r) for r in out.collect()}
    assert len(rows) == 50_001
    assert rows["000001"] == (7, 1) and rows["0ffff0"] == (9, 1)
    assert rows["000002"] == (2, 0)  # older new row loses to the existing one
    assert upsert(upsert(existing, new, order_by=["r"]), new, order_by=["r"]).count() == 50_001  # idempotent


def test_incremental_archives_processed_files(spark, scratch):
    import glob

    runs = {f"2023111{d}_120000": [_js("000001", f"C{d}", NOW + d)] for d in range(4)}
    land_snapshots(_envelopes(spark, runs), f"{scratch}/bronze")
    store = TableStore(spark, f"{scratch}/store")
    q = run_incremental(
        spark, f"{scratch}/bronze", store, f"{scratch}/ckpt", archive_dir=f"{scratch}/archive",
        max_files_per_trigger=1,
    )
    q.awaitTermination()
    assert q.exception() is None
    assert [r.callsign for r in read_silver(store).collect()] == ["C3"]
    # files committed by earlier batches are moved out of the listed folder
    base = scratch.replace("file:", "")
    archived = glob.glob(f"{base}/archive/**/*.txt", recursive=True)
    assert archived


@pytest.mark.parametrize("newer_only,expect", [(False, "OLDER"), (True, "NEWER")])
def test_silver_job_late_snapshot(spark, scratch, newer_only, expect):
    store = TableStore(spark, f"{scratch}/store")
    newer = {"20231114_230000": [_js("000001", "NEWER", NOW)]}
    older = {"20231114_220000": [_js("000001", "OLDER", NOW - 3600)]}
    run_bronze(spark, _envelopes(spark, newer), f"{scratch}/bronze", store, min_rows=1)
    run_silver(spark, store, min_rows=1)
    # the older snapshot arrives late and is processed afterwards
    run_bronze(spark, _envelopes(spark, older), f"{scratch}/bronze", store, min_rows=1)
    run_silver(spark, store, run="20231114_220000", min_rows=1, newer_only=newer_only)
    assert [r.callsign for r in read_silver(store).collect()] == [expect]


def test_incremental_late_arrival_does_not_overwrite(spark, scratch):
    store = TableStore(spark, f"{scratch}/store")
    newer = {"20231115_120000": [_js("000001", "NEWER", NOW + 86400), _js("000002", "ONLY_NEW", NOW)]}
    older = {"20231114_120000": [_js("000001", "OLDER", NOW), _js("000003", "ONLY_OLD", NOW)]}
    land_snapshots(_envelopes(spark, newer), f"{scratch}/bronze")
    run_incremental(spark, f"{scratch}/bronze", store, f"{scratch}/ckpt").awaitTermination()
    # the older snapshot lands afterwards (later modification time) and is streamed next
    land_snapshots(_envelopes(spark, older), f"{scratch}/bronze")
    q = run_incremental(spark, f"{scratch}/bronze", store, f"{scratch}/ckpt")
    q.awaitTermination()
    assert q.exception() is None
    table = {r.icao24: r.callsign for r in read_silver(store).collect()}
    assert table == {"000001": "NEWER", "000002": "ONLY_NEW", "000003": "ONLY_OLD"}


# ---------------------------------------------------------------------------
# Nothing vanishes silently
# ---------------------------------------------------------------------------


def _stream(spark, scratch, store, ckpt, **kw):
    q = run_incremental(spark, f"{scratch}/bronze", store, f"{scratch}/{ckpt}", **kw)
    q.awaitTermination()
    assert q.exception() is None


def test_new_checkpoint_drops_no_batch(spark, scratch):
    store = TableStore(spark, f"{scratch}/store")
    for d in range(3):
        land_snapshots(_envelopes(spark, {f"2023111{d}_120000": [_js(f"00000{d}", f"C{d}", NOW + d)]}), f"{scratch}/bronze")
        _stream(spark, scratch, store, "ckpt_a")
    # the checkpoint is lost: batch ids start at 0 again
    land_snapshots(_envelopes(spark, {"20231119_120000": [_js("00000f", "F", NOW)]}), f"{scratch}/bronze")
    _stream(spark, scratch, store, "ckpt_b")
    assert sorted(r.callsign for r in read_silver(store).collect()) == ["C0", "C1", "C2", "F"]


def test_incremental_gate(spark, scratch):
    land_snapshots(_envelopes(spark, {"20231110_120000": [_js("000001", "A", NOW)]}), f"{scratch}/bronze")
    store = TableStore(spark, f"{scratch}/store")
    q = run_incremental(spark, f"{scratch}/bronze", store, f"{scratch}/ckpt", min_rows=2)
    with pytest.raises(Exception, match="count gate"):
        q.awaitTermination()
    assert store.current("silver") is None


def test_unreadable_response_fails_its_run_or_is_logged(spark, scratch):
    whole = json.dumps({"time": 1, "states": [_js("000001", "A", NOW)]})
    cut = json.dumps({"time": 1, "states": [_js("000002", "B", NOW)]}, indent=1)[:-20]
    run = "20231114_220000"
    bodies = spark.createDataFrame([(run, whole), (run, cut)], "run_ts string, body string")
    store = TableStore(spark, f"{scratch}/store")
    with pytest.raises(DataQualityError, match="unreadable"):
        run_bronze(spark, bodies, f"{scratch}/bronze", store, min_rows=1)
    assert store.current("bronze") is None
    run_bronze(spark, bodies, f"{scratch}/bronze", store, min_rows=1, keep_unreadable=True)
    run_silver(spark, store, min_rows=1, quarantine_dir=f"{scratch}/q")
    (bad,) = read_quarantine(spark, f"{scratch}/q").collect()
    assert bad.dq_reason == "malformed" and "000002" in bad._raw
    assert [r.icao24 for r in read_silver(store).collect()] == ["000001"]


def test_every_pending_run_reaches_silver(spark, scratch):
    store = TableStore(spark, f"{scratch}/store")
    runs = {f"20231114_2{h}0000": [_js(f"00000{h}", f"H{h}", NOW)] for h in range(3)}
    run_bronze(spark, _envelopes(spark, runs), f"{scratch}/bronze", store, min_rows=1)
    last = run_silver(spark, store, min_rows=1)
    assert last.version == 3 and sorted(r.callsign for r in read_silver(store).collect()) == ["H0", "H1", "H2"]
    assert run_silver(spark, store, min_rows=1).version == 3  # nothing pending: the table as it stands


def test_upsert_keeps_target_columns(spark):
    existing = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], "icao24 string, v int, extra string")
    new = spark.createDataFrame([("a", 9), ("c", 3)], "icao24 string, v int")
    want = {("a", 9, "x"), ("b", 2, "y"), ("c", 3, None)}
    assert {tuple(r) for r in upsert(existing, new).select("icao24", "v", "extra").collect()} == want
    newer = upsert(existing, new, order_by=["v"])
    assert {tuple(r) for r in newer.select("icao24", "v", "extra").collect()} == want


def test_newer_only_gives_an_unchanged_report_the_later_status(spark, scratch):
    store = TableStore(spark, f"{scratch}/store")
    report = _js("000001", "A", NOW)
    early, late = "20231115_020000", "20231115_080000"  # 3.8 and 9.8 hours after the report
    for run, status in ((early, "INACTIVE"), (late, "EXPIRED")):
        run_bronze(spark, _envelopes(spark, {run: [report]}), f"{scratch}/bronze", store, min_rows=1)
        run_silver(spark, store, min_rows=1, newer_only=True)
        assert [r.status for r in read_silver(store).collect()] == [status]


def test_gold_partition_value_and_empty_gold(spark, scratch):
    store = TableStore(spark, f"{scratch}/store")
    run_bronze(spark, _envelopes(spark, {"20231114_220000": [_js("000001", "A", NOW - 90_000)]}), f"{scratch}/bronze", store, min_rows=1)
    run_silver(spark, store, min_rows=1)
    for by in (None, "status", "origin_country"):  # the only row is EXPIRED
        res = run_gold(spark, store, partition_by=by)
        assert res.record_count == 0 and read_gold(store).count() == 0
    run_bronze(spark, _envelopes(spark, {"20231114_230000": [_js("000002", "B", NOW)]}), f"{scratch}/bronze", store, min_rows=1)
    run_silver(spark, store, min_rows=1)
    res = run_gold(spark, store, partition_by="status")
    raw = spark.read.parquet(res.path)
    assert [(r.icao24, r.status_part) for r in raw.collect()] == [("000002", "AIRBORNE")]
    assert read_gold(store).columns == list(S.GOLD_COLUMNS)


def test_second_writer_of_a_version_fails_and_readers_see_new_commits(spark, scratch):
    from contrail.sinks import Commit, CommitConflict

    a, b, reader = (TableStore(spark, f"{scratch}/store") for _ in range(3))
    va, pa_ = a.write_version(spark.range(3), "t")
    vb, pb = b.write_version(spark.range(5), "t")
    assert va == vb == 1 and pa_ != pb
    a.commit(Commit("t", va, pa_, 3))
    assert reader.read("t").count() == 3
    with pytest.raises(CommitConflict):
        b.commit(Commit("t", vb, pb, 5))
    assert reader.read("t").count() == 3
    vb, pb = b.write_version(spark.range(5), "t")
    b.commit(Commit("t", vb, pb, 5))
    assert vb == 2 and reader.read("t").count() == 5 and reader.read("t", version=1).count() == 3


def test_corrected_run_leaves_no_old_quarantine_row(spark, scratch):
    store = TableStore(spark, f"{scratch}/store")
    run = "20231114_220000"
    for lat, want in ((95.0, 1), (45.0, 0)):
        run_bronze(spark, _envelopes(spark, {run: [_js("000001", "A", NOW, lat=lat), _js("000002", "B", NOW)]}),
                   f"{scratch}/bronze", store, min_rows=1)
        run_silver(spark, store, run=run, min_rows=1, quarantine_dir=f"{scratch}/q")
        import glob

        left = glob.glob(f"{scratch.replace('file:', '')}/q/**/*.json", recursive=True)
        assert (read_quarantine(spark, f"{scratch}/q").count() if left else 0) == want


def test_batch_is_decoded_once_and_silver_read_once(spark, scratch, monkeypatch):
    """The merge plan reads the staged rows and the Silver files once each, and no text."""
    from contrail.streaming import incremental

    land_snapshots(_envelopes(spark, {"20231114_220000": [_js("000001", "A", NOW)]}), f"{scratch}/bronze")
    store = TableStore(spark, f"{scratch}/store")
    _stream(spark, scratch, store, "ckpt")
    plans = []
    write = TableStore.write_version

    def spy(self, df, *a, **k):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(self, df, *a, **k)

    monkeypatch.setattr(TableStore, "write_version", spy)
    batch = spark.read.text(f"{scratch}/bronze").select("value", F.lit("20231114_220000").alias("run_ts"))
    incremental.process_batch(batch, 7, store, quarantine_dir=f"{scratch}/q")
    (plan,) = plans
    assert plan.count("FileScan parquet") == 2 and "FileScan text" not in plan
    assert read_silver(store).count() == 1


def test_run_stamp_comes_from_the_file_not_from_folders_above(spark, scratch):
    import os

    from contrail.sources import read_states

    base = scratch.replace("file:", "")
    land_snapshots(_envelopes(spark, {"20240101_000000": [_js("000001", "A", NOW)]}), f"{base}/exp_20200101_000000/bronze")
    store = TableStore(spark, f"{scratch}/store")
    q = run_incremental(spark, f"{base}/exp_20200101_000000/bronze", store, f"{scratch}/ckpt")
    q.awaitTermination()
    assert store.current("silver")["run_ts"] == "20240101_000000"
    os.makedirs(f"{base}/plain", exist_ok=True)
    with open(f"{base}/plain/states.json", "w") as f:
        json.dump([_js("000001", "A", NOW)], f)
    with pytest.raises(Exception, match="no run stamp"):
        read_states(spark, f"{base}/plain/states.json", fmt="array").collect()


def test_scratch_needs_a_shared_folder_on_a_cluster(monkeypatch):
    from contrail import session

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError, match="share"):
        session.ensure_checkpoint_dir(Session())

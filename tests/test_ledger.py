"""The manifest as a ledger: gates that fail one run, corrections, torn records, checkpoints."""

import json
import os

import pytest
from pyspark.sql import functions as F

from contrail import schema as S
from contrail.plans.jobs import GateFailure, run_bronze, run_gold, run_silver, run_silver_pending
from contrail.sinks import Commit, CommitConflict, TableStore, read_silver, run_ledger
from contrail.sinks.store import parse_record
from test_store_stream import _envelopes, _js

NOW = 1_700_000_000
A, B, C = "20231114_220000", "20231114_230000", "20231115_000000"


def _table(store):
    return {r.icao24: r.callsign for r in read_silver(store).collect()}


def _ledger(store):
    rows = run_ledger(store).orderBy("run_ts", "bronze_version").collect()
    return [(r.run_ts, r.bronze_version, r.state, r.silver_version) for r in rows]


def test_short_run_is_rejected_and_the_others_go_on(spark, scratch):
    store = TableStore(spark, f"{scratch}/store")

    def land(run, n, tag):
        run_bronze(spark, _envelopes(spark, {run: [_js(f"{i:06x}", f"{tag}{i}", NOW) for i in range(n)]}), f"{scratch}/bronze", store, min_rows=1)

    land(A, 2, "a")
    land(B, 4, "b")
    done = run_silver_pending(spark, store, min_rows=3)
    assert [(r.stage, r.record_count) for r in done] == [("rejected", 2), ("silver", 4)]
    assert _ledger(store) == [(A, 1, "rejected", None), (B, 2, "taken", 1)]
    assert "only 2" in run_ledger(store).filter(F.col("run_ts") == A).first().note
    assert run_silver_pending(spark, store, min_rows=3) == []  # it isn't tried again as it stands
    with pytest.raises(GateFailure):
        run_silver(spark, store, run=A, min_rows=3)
    land(A, 5, "A")  # landed again, whole: it waits, and Silver takes it without touching the later run's rows
    assert _ledger(store)[:2] == [(A, 1, "superseded", None), (A, 3, "landed", None)]
    run_silver_pending(spark, store, min_rows=3)
    assert _ledger(store) == [(A, 1, "superseded", None), (A, 3, "taken", 2), (B, 2, "taken", 1)]
    assert set(_table(store)) == {f"{i:06x}" for i in range(5)}


def test_correction_gives_what_the_right_run_would_have_given(spark, scratch):
    right = {
        A: {"1": "a1", "2": "a2", "3": "a3"},
        B: {"2": "b2", "4": "b4", "6": "b6"},
        C: {"4": "c4", "5": "c5"},
    }
    wrong = {"2": "x2", "3": "x3", "4": "x4", "7": "x7"}  # of run B: x3 and x7 must go, 4 belongs to C by then

    def land(store, run, rows, where):
        states = [_js(f"00000{k}", v, NOW) for k, v in rows.items()]
        run_bronze(spark, _envelopes(spark, {run: states}), f"{scratch}/{where}", store, min_rows=1)

    plain = TableStore(spark, f"{scratch}/plain")
    for run, rows in right.items():
        land(plain, run, rows, "bronze1")
        run_silver_pending(spark, plain, min_rows=1)
    store = TableStore(spark, f"{scratch}/store")
    for run, rows in ({**right, B: wrong}).items():
        land(store, run, rows, "bronze2")
        run_silver_pending(spark, store, min_rows=1)
    assert _table(store)["000007"] == "x7" and _table(store)["000003"] == "x3"
    land(store, B, right[B], "bronze2")
    (r,) = run_silver_pending(spark, store, min_rows=1)
    assert r.version == 4 and _table(store) == _table(plain)
    keep = [c for c in S.SILVER_COLUMNS]
    assert sorted(map(tuple, read_silver(store).select(keep).collect())) == sorted(map(tuple, read_silver(plain).select(keep).collect()))
    land(store, B, right[B], "bronze2")  # once more, unchanged
    run_silver_pending(spark, store, min_rows=1)
    assert _table(store) == _table(plain)
    assert _ledger(store) == [(A, 1, "taken", 1), (B, 2, "superseded", 2), (B, 4, "superseded", 4), (B, 5, "taken", 5), (C, 3, "taken", 3)]


def test_torn_records_are_no_commits(spark, scratch):
    store = TableStore(spark, f"{scratch}/store")
    base = f"{scratch.replace('file:', '')}/store/_manifest"
    for n in (3, 5):
        v, path = store.write_version(spark.range(n), "gold")
        store.commit(Commit("gold", v, path, n, run_ts=A))
    whole = open(f"{base}/gold-000002.json").read()
    other = json.loads(whole) | {"version": 6, "record_count": 9}
    torn = {3: "", 4: whole.replace('"version": 2', '"version": 4')[:-30], 5: whole, 6: json.dumps(other) + "\n" + json.dumps(other | {"record_count": 8})}
    for v, text in torn.items():
        with open(f"{base}/gold-{v:06d}.json", "w") as f:
            f.write(text)
        assert parse_record(text, "gold", v) is None
    doubled = json.dumps(other | {"version": 7}) + "\n"
    with open(f"{base}/gold-000007.json", "w") as f:
        f.write(doubled * 2)
    with open(f"{base}/.gold-000009.json.x.tmp", "w") as f:  # a writer that died before publishing
        f.write(whole)
    assert store.current("gold")["version"] == 7 and store.read("gold").count() == 5
    assert sorted(r.version for r in store.manifest().collect()) == [1, 2, 7]  # the doubled one counts once
    os.remove(f"{base}/gold-000007.json")
    assert store.current("gold")["version"] == 2 and store.next_version("gold") == 7
    assert store.read("gold", version=4) is None
    v, path = store.write_version(spark.range(7), "gold")
    store.commit(Commit("gold", v, path, 7))
    assert (v, store.read("gold").count()) == (7, 7)
    assert not [n for n in os.listdir(base) if n.endswith(".tmp") and "000009" not in n]


def test_a_dead_writer_publishes_nothing(spark, scratch, monkeypatch):
    store = TableStore(spark, f"{scratch}/store")
    store.commit(Commit("t", 1, f"{scratch}/x", 1))

    def dies(self, path, text):
        temp, fs = self._fs(f"{path}.half.tmp")
        out = fs.create(temp, True)
        out.write(bytearray(text[:20].encode()))
        out.close()
        raise RuntimeError("killed")

    with monkeypatch.context() as m, pytest.raises(RuntimeError):
        m.setattr(TableStore, "_publish", dies)
        store.commit(Commit("t", 2, f"{scratch}/y", 2))
    assert store.current("t")["version"] == 1 and store.next_version("t") == 2
    store.commit(Commit("t", 2, f"{scratch}/z", 2))
    assert store.current("t")["output_path"].endswith("z")
    with pytest.raises(CommitConflict):
        store.commit(Commit("t", 2, f"{scratch}/w", 2))


def test_log_checkpoints_bound_what_is_listed_and_read(spark, scratch, monkeypatch):
    store, plain = TableStore(spark, f"{scratch}/store", checkpoint_every=5), TableStore(spark, f"{scratch}/plain")
    base = f"{scratch.replace('file:', '')}/store/_manifest"
    most = 0
    for i in range(1, 18):
        for s in (store, plain):
            s.commit(Commit("bronze", i, f"p{i}", i, run_ts=f"r{i:02d}"))
            if i % 3 == 0:
                s.commit(Commit("silver", i // 3, f"s{i}", i, run_ts=f"r{i:02d}", source_version=i))
        log = store._log()
        assert sum(map(len, log.files.values())) < 5
        most = max(most, len([n for n in os.listdir(base) if n.endswith(".json")]))
    assert most <= 5 * 3  # files that follow, those of one checkpoint before, and the pointers

    def rows(s):
        return sorted(map(tuple, s.manifest().collect()), key=repr)

    assert rows(store) == rows(plain) and len(rows(store)) == 22
    assert sorted(map(tuple, run_ledger(store).collect()), key=repr) == sorted(map(tuple, run_ledger(plain).collect()), key=repr)
    for stage in ("bronze", "silver"):
        assert store.current(stage) == plain.current(stage) and store.next_version(stage) == plain.next_version(stage)
    assert store._record("bronze", 1)["output_path"] == "p1"  # from the checkpoint
    with pytest.raises(CommitConflict):
        store.commit(Commit("bronze", 2, "late", 1))  # its file is gone, its version isn't free
    pointers = sorted(n for n in os.listdir(base) if n.startswith("_checkpoint-"))
    with open(f"{base}/{pointers[-1]}", "w") as f:  # a torn checkpoint: the one before serves, and its files are there
        f.write('{"covered": {"bro')
    assert rows(store) == rows(plain) and store.current("bronze") == plain.current("bronze")
    store.commit(Commit("bronze", 18, "p18", 18, run_ts="r18"))
    assert store.current("bronze")["version"] == 18 and len(rows(store)) == 23


def test_reads_see_one_state_and_gold_names_its_source(spark, scratch):
    store = TableStore(spark, f"{scratch}/store", checkpoint_every=3)
    for k, run in enumerate((A, B, C)):
        run_bronze(spark, _envelopes(spark, {run: [_js(f"00000{k}", f"k{k}", NOW)]}), f"{scratch}/bronze", store, min_rows=1)
        run_silver_pending(spark, store, min_rows=1)
        g = run_gold(spark, store)
    assert g.record_count == 3 and store.current("gold")["source_version"] == 3
    assert read_silver(store, version=1).count() == 1


def test_counts_are_observed_in_the_staging_pass(spark, scratch, monkeypatch):
    """One job reads the landed text; the staged rows are not read again for plain counts."""
    store = TableStore(spark, f"{scratch}/store")
    states = [_js(f"{i:06x}", "A", NOW) for i in range(6)] + [_js("000001", "A", NOW), _js("bad", "B", NOW, lat=95.0), _js(None, "N", NOW), ["x"]]
    run_bronze(spark, _envelopes(spark, {A: states}), f"{scratch}/bronze", store, min_rows=1)
    seen = []
    stage = TableStore.stage_observed
    monkeypatch.setattr(TableStore, "stage_observed", lambda self, df, **m: seen.append(stage(self, df, **m)) or seen[-1])
    r = run_silver(spark, store, min_rows=1)
    want = {"input": 10, "malformed": 1, "null_records": 1, "invalid_geo": 1, "clean": 7}
    assert {k: seen[0][2][k] for k in want} == want
    assert r.counts == {**want, "deduped": 6, "table_rows": 6}


# ---------------------------------------------------------------------------
# The gate in the stream, for runs that come in several batches
# ---------------------------------------------------------------------------


def _stream(spark, scratch, store, ckpt="ckpt", **kw):
    from contrail.streaming import run_incremental

    q = run_incremental(spark, f"{scratch}/bronze", store, f"{scratch}/{ckpt}", max_files_per_trigger=1, gated=True, **kw)
    q.awaitTermination()
    assert q.exception() is None


def _write_part(scratch, run, part, states):
    folder = f"{scratch.replace('file:', '')}/bronze/run_ts={run}"
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/part-{part}.txt", "w") as f:
        f.writelines(json.dumps(s) + "\n" for s in states)


def test_split_runs_are_published_whole(spark, scratch):
    from contrail.streaming.gated import held, publish_held

    store = TableStore(spark, f"{scratch}/store")

    def commit(run, n):
        store.commit(Commit("bronze", store.next_version("bronze"), f"{scratch}/bronze/run_ts={run}", n, run_ts=run))

    parts = {k: [_js(f"{k}{i:05x}", f"A{k}{i}", NOW) for i in range(4)] for k in range(3)}
    commit(A, 12)
    _write_part(scratch, A, 0, parts[0])
    _write_part(scratch, A, 1, parts[1])
    _stream(spark, scratch, store, min_rows=10)
    assert store.current("silver") is None and held(store).count() == 8  # eight of twelve: it waits
    commit(B, 3)
    _write_part(scratch, B, 0, [_js(f"b{i:05x}", "B", NOW) for i in range(3)])
    _write_part(scratch, A, 2, parts[2])
    _stream(spark, scratch, store, min_rows=10)
    assert _ledger(store) == [(A, 1, "taken", 1), (B, 2, "rejected", None)]  # a third batch completed A; B is whole but short
    assert len(_table(store)) == 12 and held(store).count() == 0
    # A lost checkpoint delivers everything again: nothing is taken twice.
    _stream(spark, scratch, store, ckpt="other", min_rows=10)
    assert store.current("silver")["version"] == 1 and held(store).count() == 0
    # A run whose commit comes after its files.
    _write_part(scratch, C, 0, [_js(f"c{i:05x}", "C", NOW) for i in range(11)])
    _stream(spark, scratch, store, min_rows=10)
    assert held(store).count() == 11
    commit(C, 11)
    assert publish_held(store, min_rows=10) == [(C, "taken")]
    assert len(_table(store)) == 23 and held(store).count() == 0


def test_run_landed_again_while_held(spark, scratch):
    store = TableStore(spark, f"{scratch}/store")
    path = f"{scratch}/bronze/run_ts={A}"
    _write_part(scratch, A, 0, [_js(f"0{i:05x}", "OLD", NOW) for i in range(4)])
    _stream(spark, scratch, store, min_rows=2)
    os.remove(f"{path.replace('file:', '')}/part-0.txt")  # the run's folder is replaced before it was committed
    _write_part(scratch, A, 1, [_js(f"0{i:05x}", "NEW", NOW) for i in range(3)])
    store.commit(Commit("bronze", 1, path, 3, run_ts=A))
    _stream(spark, scratch, store, min_rows=2)
    assert set(_table(store).values()) == {"NEW"} and len(_table(store)) == 3

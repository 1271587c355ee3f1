"""Runnable jobs: thin I/O around the pure transforms.

Each job reads committed inputs, writes a new table version and publishes its
manifest record. Bronze text is decoded once, into a staged Parquet folder next to the
tables, and counted in the same pass; what comes after (quarantine, Silver) reads that. Row counts of
written tables come from their Parquet footers.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail import schema as S
from contrail.functions.space import space_key
from contrail.functions.time import run_stamp
from contrail.operators.quality import check_count, is_clean, log_reasons, quarantine_rows
from contrail.operators.upsert import newer_only_order, upsert, withdraw
from contrail.plans.layers import gold, silver_latest
from contrail.sinks.store import (
    SILVER_STORED_SCHEMA,
    Commit,
    TableStore,
    partition_tag,
    read_silver,
    with_country_part,
    write_quarantine,
)
from contrail.sources.bronze import DataQualityError, land_snapshots, landed_counts, read_states


@dataclass
class RunResult:
    stage: str
    version: int | None
    path: str | None
    record_count: int
    counts: dict = field(default_factory=dict)


def stamp_epoch(run_ts: str) -> int:
    import datetime as dt

    t = dt.datetime.strptime(run_ts, "%Y%m%d_%H%M%S").replace(tzinfo=dt.timezone.utc)
    return int(t.timestamp())


# ---------------------------------------------------------------------------
# Bronze
# ---------------------------------------------------------------------------


def run_bronze(
    spark: SparkSession,
    responses: DataFrame,
    bronze_dir: str,
    store: TableStore,
    *,
    min_rows: int = S.BRONZE_MIN_ROWS,
    body_col: str = "body",
    run_col: str = "run_ts",
    runs: list[str] | None = None,
    keep_unreadable: bool = False,
) -> list[RunResult]:
    """Land responses, gate each run on its state count and commit the runs
    that pass. Runs below ``min_rows``, and runs with an unreadable response, stay
    uncommitted (invisible to Silver) and are reported by raising after the passing
    runs are committed; ``keep_unreadable`` commits the latter, and Silver logs their
    bodies as malformed. ``runs`` lists the run stamps in ``responses`` when the caller
    knows them (saves one pass over the responses)."""
    land_snapshots(responses, bronze_dir, body_col=body_col, run_col=run_col)
    if runs is None:
        runs = [r[run_col] for r in responses.select(F.col(run_col).cast("string")).distinct().collect()]
    counts = {r[run_col]: r for r in landed_counts(spark, bronze_dir, runs, run_col=run_col).collect()}
    out, failed = [], []
    for run in sorted(runs):
        n, bad = (int(counts[run]["n_states"]), int(counts[run]["n_unreadable"])) if run in counts else (0, 0)
        try:
            if bad and not keep_unreadable:
                raise DataQualityError(f"run {run} has {bad} unreadable response(s)")
            check_count(n - bad, min_rows, what=f"states in run {run}")
        except DataQualityError as e:
            failed.append(str(e))
            continue
        path = f"{bronze_dir.rstrip('/')}/{run_col}={run}"
        version = store.next_version("bronze")
        store.commit(Commit("bronze", version, path, n, run_ts=run))
        out.append(RunResult("bronze", version, path, n))
    if failed:
        raise DataQualityError("; ".join(failed))
    return out


# ---------------------------------------------------------------------------
# Silver
# ---------------------------------------------------------------------------


def run_silver_pending(spark: SparkSession, store: TableStore, **kw) -> list[RunResult]:
    """Process every Bronze commit that waits, in order of the run stamp.

    A run that fails the gate is recorded as rejected (a result of stage ``rejected``) and the next one goes on; when it is
    landed again, its new Bronze commit waits like any other. A run that was taken before and is landed again is
    corrected, see :func:`run_silver`."""
    out = []
    for r in store.pending_runs():
        try:
            out.append(run_silver(spark, store, run=r["run_ts"], **kw))
        except GateFailure as e:
            out.append(RunResult("rejected", e.number, r["output_path"], e.rows, {"input": e.rows}))
    return out


class GateFailure(DataQualityError):
    """A run failed Silver's gate and is recorded so, under ``number``."""

    def __init__(self, message: str, number: int, rows: int):
        super().__init__(message)
        self.number, self.rows = number, rows


def run_silver(
    spark: SparkSession,
    store: TableStore,
    *,
    run: str | None = None,
    as_of: int | None = None,
    min_rows: int = S.SILVER_MIN_ROWS,
    fmt: str = "line",
    quarantine_dir: str | None = None,
    newer_only: bool = False,
    drop_blank_country: bool = False,
) -> RunResult:
    """Process one committed Bronze run into the Silver table.

    Without ``run`` all waiting runs are processed in order and the last result that reached Silver is
    returned (with none, the table as it stands). ``as_of`` defaults
    to the run's own stamp (the snapshot time), fixed for the whole run. Raises :class:`GateFailure`, after recording
    it, if the run has too few rows.

    If Silver took an earlier landing of the run, this one corrects it: the rows that the earlier one left
    are withdrawn (aircraft go back to what the table held before the run, or leave it), and the run's rows
    come in unless a later run has reported the aircraft. The result is what processing the corrected
    run in its place would have given."""
    if run is None:
        kw = dict(as_of=as_of, min_rows=min_rows, fmt=fmt, quarantine_dir=quarantine_dir, newer_only=newer_only,
                  drop_blank_country=drop_blank_country)
        done = [r for r in run_silver_pending(spark, store, **kw) if r.stage == "silver"]
        if done:
            return done[-1]
        cur = store.current("silver")
        if cur is None:
            raise FileNotFoundError("no committed bronze run has passed; land a snapshot first")
        return RunResult("silver", cur["version"], cur["output_path"], cur["record_count"])
    m = store.find("bronze", run)
    if m is None:
        raise KeyError(f"bronze run {run} is not committed")
    as_of = stamp_epoch(run) if as_of is None else int(as_of)

    decoded = read_states(spark, m["output_path"], fmt=fmt).withColumn("run_ts", F.lit(run))
    clean = is_clean(decoded, drop_blank_country=drop_blank_country)
    # Counted while the rows are staged, in the same pass.
    states, staging, counts = store.stage_observed(
        decoded,
        input=F.count(F.lit(1)),
        **{r: F.count_if(cond) for r, cond in log_reasons(decoded).items()},
        clean=F.count_if(clean),
    )
    try:
        try:
            check_count(counts["input"], min_rows, what=f"state vectors in run {run}")
        except DataQualityError as e:
            raise GateFailure(str(e), store.reject(run, m, str(e)), counts["input"]) from e
        # Rows that dedup keeps: two narrow columns of the clean rows, combined before they are dealt.
        keys = states.filter(is_clean(states, drop_blank_country=drop_blank_country)).select("icao24", "last_contact")
        counts["deduped"] = keys.distinct().count()
        if quarantine_dir:
            write_quarantine(quarantine_rows(states), quarantine_dir, runs=[run])
        new = silver_latest(states, as_of, run_ts=run, drop_blank_country=drop_blank_country)
        table, order = read_silver(store), newer_only_order(new) if newer_only else None
        if table is not None and store.find("silver", run) is not None:
            before = store.before_run(run)
            table = withdraw(table, None if before is None else read_silver(store, before["version"]), run)
            order = order or [S.RUN_COL]
        merged = upsert(table, new, order_by=order)
        version, path = store.write_version(
            with_country_part(merged), "silver", partition_by=S.COUNTRY_PART, rebalance=S.COUNTRY_PART
        )
    finally:
        store.delete(staging)
    counts["table_rows"] = store.rows_in(path, SILVER_STORED_SCHEMA)
    store.commit(Commit("silver", version, path, counts["deduped"], run_ts=run, source_version=m["version"]))
    return RunResult("silver", version, path, counts["deduped"], counts)


# ---------------------------------------------------------------------------
# Gold
# ---------------------------------------------------------------------------


def run_gold(
    spark: SparkSession,
    store: TableStore,
    *,
    partition_by: str | None = None,
    restatus_as_of: int | None = None,
    by_location: bool = False,
) -> RunResult:
    """Current Silver -> a new Gold version (full rewrite, as a Parquet table).

    ``partition_by`` names a Gold column; its folders are called ``<column>_part`` and hold
    a tagged copy of its values, so blanks, nulls and number-like text read back as they were. ``by_location`` sorts the
    table along a curve through latitude and longitude, for questions about an area: a reader with bounds on both
    skips the files and pages that lie elsewhere."""
    if partition_by and by_location:
        raise ValueError("a table is laid out by a column's folders or by location, not both")
    silver_df = read_silver(store)
    if silver_df is None:
        raise FileNotFoundError("no committed silver table")
    cur_silver = store.current("silver")
    g = gold(silver_df, restatus_as_of=restatus_as_of)
    if partition_by:
        part = f"{partition_by}_part"
        version, path = store.write_version(
            g.withColumn(part, partition_tag(partition_by)), "gold", partition_by=part, rebalance=part
        )
    else:
        located = dict(cluster_by=space_key(), tie="icao24") if by_location else {}
        version, path = store.write_version(g, "gold", **located)
    n = store.rows_in(path, S.GOLD_SCHEMA)
    store.commit(Commit("gold", version, path, n, run_ts=cur_silver["run_ts"], source_version=cur_silver["version"]))
    n_in = store.rows_in(cur_silver["output_path"], SILVER_STORED_SCHEMA)
    return RunResult("gold", version, path, n, {"gold_input": n_in, "gold_rows": n})


def read_gold(store: TableStore, version: int | None = None) -> DataFrame | None:
    """The committed Gold table (latest, or ``version``), without the partition folders' tags."""
    df = store.read("gold", S.GOLD_SCHEMA, version)
    return None if df is None else df.select(*S.GOLD_COLUMNS)


__all__ = [
    "GateFailure", "RunResult", "run_bronze", "run_silver", "run_silver_pending", "run_gold", "read_gold", "stamp_epoch", "run_stamp",
]

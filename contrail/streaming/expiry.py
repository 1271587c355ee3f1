"""Aircraft that stop reporting: a keyed stream whose timers turn them INACTIVE and EXPIRED.

Status is derived when a report arrives, so a silent aircraft would keep its last one. Here each aircraft has a state (its
newest report and the run that brought it), and an event-time timer for the next moment at which its status changes by
itself. The clock is the run stamp: once a run has been read, the watermark stands at its as-of, and every timer up to
then fires, whether or not the aircraft is in any new run.

The result is a log of changes, one row for each: from which second on (``since``) an aircraft has a status. A report counts from its
run's as-of; the changes that follow from silence count from the second at which the age limit is passed, however the runs
were cut into batches. :func:`status_at` reads the log at given moments, which gives what re-deriving
the status of the whole table at those moments would give.

Files come in the order of their modification times, and of runs that were landed together that is any order; a run can
be spread over many batches. So a report is written down whenever it comes: an older run than the one in the state with
the changes up to the state's run, a better report of the state's own run beside the one before it. A row of the
log names the report that it follows from, and :func:`status_at` passes over what a better or newer report has replaced. Rows without an address, a position or a country don't count, as in Silver.

Reports are reduced to the newest of an aircraft within each Arrow batch of a task before they are dealt, so a busy
aircraft doesn't fill a task. Aircraft are kept together by a hash of their address, :data:`GROUPS` groups in all: the group is
the stream's key, its state the table of its aircraft (one row each), its timer the next one due, and a step works on whole columns.
With a key for each aircraft, each aircraft and batch cost a call into Python with data frames of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from contrail import schema as S
from contrail.functions.time import run_ts_to_epoch
from contrail.operators.quality import clean_rows
from contrail.sources.bronze import decode_states
from contrail.streaming.incremental import bronze_stream

#: The last two columns tell reports of a run apart that have the same contact time.
CHANGES_SCHEMA = "icao24 string, status string, since bigint, last_contact bigint, run_as_of bigint, time_position bigint, callsign string"
_STATE = "aircraft binary"
_REPORT = "icao24 string, run_as_of bigint, last_contact bigint, time_position bigint, callsign string, on_ground boolean"
_ORDER = ["run_as_of", "last_contact", "time_position", "callsign", "on_ground"]
_KNOWN = pa.schema([
    ("icao24", pa.string()), ("run_as_of", pa.int64()), ("last_contact", pa.int64()), ("time_position", pa.int64()),
    ("callsign", pa.string()), ("on_ground", pa.bool_()), ("told", pa.int64()),
])
_CHANGE = [c.split()[0] for c in CHANGES_SCHEMA.split(", ")]
_PARTITIONS = "spark.sql.shuffle.partitions"
#: Groups of aircraft. A checkpoint holds for one number of groups only.
GROUPS = 512
#: The watermark would drop runs older than itself. The event time is the as-of shifted ahead by this and the delay
#: is the same, so the watermark stands at the newest as-of and older runs still pass.
LATE_S = 100 * 366 * 86400


def reports(batch: DataFrame, fmt: str = "line") -> DataFrame:
    """Bronze text (``value``, ``run_ts``) -> the columns that status depends on, with the run's as-of."""
    states = decode_states(batch, fmt=fmt)
    needed = ["icao24", "origin_country", "latitude", "longitude", "last_contact", "time_position", "callsign", "on_ground", "_decode_error"]
    # A filter on decoded columns is pushed below the decoding, which it then repeats for each use of a column; through a
    # generator none is pushed.
    row = F.struct(*needed, run_ts_to_epoch(F.col("run_ts")).alias("run_as_of"))
    return clean_rows(states.select(F.explode(F.array(row)).alias("r")).select("r.*")).select("icao24", *_ORDER)


def _differs(rows: pa.Table, *cols: str) -> np.ndarray:
    """Whether a row differs from the next one in a column; the last row does."""
    out = np.ones(len(rows), dtype=bool)
    if len(rows) > 1:
        out[:-1] = np.any([pc.not_equal(rows[c].slice(0, len(rows) - 1), rows[c].slice(1)).to_numpy() for c in cols], axis=0)
    return out


def _winners(rows: pa.Table, *ties: str) -> pa.Table:
    """The newest report of each aircraft and run, sorted by both; of equal ones the one with the greater ``ties``."""
    if rows["run_as_of"].null_count:
        raise ValueError("a run stamp is no date")
    keys = [(c, "ascending") for c in ("icao24", *_ORDER, *ties)]
    rows = rows.take(pc.sort_indices(rows, sort_keys=keys, null_placement="at_start")).combine_chunks()
    return rows.filter(pa.array(_differs(rows, "icao24", "run_as_of")))


def _newest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        yield from _winners(pa.Table.from_batches([b])).to_batches()


def _packed(known: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, known.schema) as out:
        out.write_table(known)
    return sink.getvalue().to_pybytes()


def status_changes(
    stream: DataFrame,
    *,
    inactive_s: int = S.INACTIVE_AFTER_S,
    expired_s: int = S.EXPIRED_AFTER_S,
    airborne_label: str = S.STATUS_AIRBORNE,
    groups: int = GROUPS,
) -> DataFrame:
    """:func:`reports` -> the log of changes (CHANGES_SCHEMA), in append mode."""
    limits = ((inactive_s, S.STATUS_INACTIVE), (expired_s, S.STATUS_EXPIRED))

    def step(key, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        clock = state.getCurrentWatermarkMs() // 1000
        parts = [] if state.hasTimedOut else [pa.Table.from_pandas(b.assign(told=None), schema=_KNOWN, preserve_index=False) for b in batches]
        if state.exists:
            parts.append(pa.ipc.open_stream(bytes(state.get[0])).read_all())
        # The aircraft's reports in order, a run each; of equal ones the one in the state stays (it was told).
        known = _winners(pa.concat_tables(parts), "told")
        run, heard = known["run_as_of"].to_numpy(), known["last_contact"].is_valid().to_numpy()
        last, ground = known["last_contact"].fill_null(0).to_numpy(), known["on_ground"].fill_null(False).to_numpy()
        new, newest = known["told"].is_null().to_numpy(), _differs(known, "icao24")
        # A change by silence is written down once it is later than ``told``, and up to the next report or the clock.
        told = np.where(new, run, known["told"].fill_null(0).to_numpy())
        upto = np.where(newest, clock, np.roll(run, -1) - 1)

        def changes(which, status, since) -> pa.Table:
            rows = known.filter(pa.array(which)).append_column("status", pa.array(status[which], pa.string()))
            return rows.append_column("since", pa.array(since[which])).select(_CHANGE)

        first = np.full(len(run), airborne_label, dtype=object)
        out, ahead, reached = [], [], told
        for seconds, status in limits:
            first[heard & (run - last > seconds)] = status
            since = last + seconds + 1
            due = heard & ~ground & (since > told)
            now = due & (since <= upto)
            out.append(changes(now, np.full(len(run), status, dtype=object), since))
            ahead.append(since[due & ~now & newest])
            reached = np.where(now, np.maximum(reached, since), reached)
        first[ground] = S.STATUS_LANDED
        out.append(changes(new, first, run))
        known = known.set_column(known.schema.get_field_index("told"), "told", pa.array(reached))
        state.update((_packed(known.filter(pa.array(newest))),))
        ahead = np.concatenate(ahead)
        if len(ahead):
            state.setTimeoutTimestamp(max(int(ahead.min()) * 1000 - 1, state.getCurrentWatermarkMs() + 1))
        out = pa.concat_tables(out)
        if len(out):
            yield out.to_pandas(types_mapper={pa.int64(): pd.Int64Dtype()}.get)

    narrow = stream.mapInArrow(_newest, _REPORT).withColumn("at", F.timestamp_seconds(F.col("run_as_of") + LATE_S))
    dealt = narrow.withWatermark("at", f"{LATE_S} seconds").withColumn("group", F.pmod(F.xxhash64("icao24"), F.lit(int(groups))))
    return dealt.groupBy("group").applyInPandasWithState(step, CHANGES_SCHEMA, _STATE, "append", GroupStateTimeout.EventTimeTimeout)


def run_expiry(
    spark: SparkSession, bronze_dir: str, changes_dir: str, checkpoint: str, *, fmt: str = "line",
    max_files_per_trigger: int | None = None, available_now: bool = True, processing_time: str | None = None, state_partitions: int | None = None,
    **limits,
) -> StreamingQuery:
    """Start the stream from a Bronze folder to a Parquet log of changes; returns the running query.

    A new checkpoint takes ``state_partitions``, by default two a core that the session has now and no more than its shuffle
    partitions: a partition costs each batch a task with its state file, however few rows there are, and a batch is a
    few files only. An old checkpoint keeps its number."""
    source = bronze_stream(spark, bronze_dir, fmt=fmt, max_files_per_trigger=max_files_per_trigger).drop("_file")
    w = status_changes(reports(source, fmt), **limits).writeStream.format("parquet").option("path", changes_dir).option("checkpointLocation", checkpoint)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    before = spark.conf.get(_PARTITIONS)
    spark.conf.set(_PARTITIONS, str(state_partitions or min(int(before), 2 * spark.sparkContext.defaultParallelism)))
    try:
        return w.start()  # takes over the session's settings as they are now
    finally:
        spark.conf.set(_PARTITIONS, before)


def status_at(changes: DataFrame, moments: Column) -> DataFrame:
    """(icao24, as_of, status, last_contact) of each aircraft known by each moment; ``moments`` is an array of epochs."""
    report = F.struct("run_as_of", "last_contact", "time_position", "callsign", (F.col("status") == S.STATUS_LANDED).alias("landed"))
    own = Window.partitionBy("icao24").orderBy("since", "_report")
    newest = F.max("_report").over(own.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    told = changes.withColumn("_report", report).withColumn("_newest", newest).filter(F.col("_report").eqNullSafe(F.col("_newest")))
    spans = told.withColumn("_until", F.lead("since").over(own))
    held = F.filter(moments, lambda m: (m >= F.col("since")) & (F.col("_until").isNull() | (m < F.col("_until"))))
    return spans.select("icao24", F.explode(held).alias("as_of"), "status", "last_contact")

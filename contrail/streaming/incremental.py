"""Incremental Silver: each newly landed snapshot is processed exactly once.

A file-source stream over the Bronze folder replaces the external schedule and
the "latest raw file" pointer: the stream's checkpoint records which files
were taken, ``trigger(availableNow=True)`` processes everything new and stops
(a scheduled run), and a continuous trigger keeps it running.

Every micro-batch runs the Silver transform per run (the run stamp gives the
run's own as-of, so several snapshots in one batch are treated exactly as if
processed one by one) and merges into the Silver table with a *recency merge*
ordered by (run, last_contact, time_position, callsign). That merge is
commutative and idempotent, so:

* a batch replayed after a failure leaves the table unchanged;
* snapshots arriving out of order, or one snapshot split over two batches,
  give the same table as processing the snapshots in order, once.

A batch is never skipped by its number: batch ids start again with a new
checkpoint, and merging a batch twice is harmless.

With ``gated=True`` each run passes the record-count gate of the batch job, however many batches it is
split over: see :mod:`contrail.streaming.gated`. It needs Bronze commits in the store's manifest, which
say how many rows a run has. Without it there is no gate, or with ``min_rows`` one on each batch's share of a run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from contrail import schema as S
from contrail.functions.time import run_ts_to_epoch
from contrail.operators.quality import check_count, quarantine_rows
from contrail.operators.upsert import upsert
from contrail.plans.layers import silver_latest
from contrail.sinks.store import SILVER_STORED_SCHEMA, Commit, TableStore, read_silver, with_country_part, write_quarantine
from contrail.sources.bronze import decode_states, read_pieces, run_stamp_of_file
from contrail.streaming.gated import hold, publish_held

RECENCY_ORDER = (S.RUN_COL, S.LAST_CONTACT_EPOCH, "time_position", "callsign")


def process_batch(
    batch: DataFrame,
    batch_id: int,
    store: TableStore,
    *,
    fmt: str = "line",
    as_of: int | None = None,
    quarantine_dir: str | None = None,
    min_rows: int | None = None,
) -> None:
    """Silver step for one micro-batch of Bronze text (``value``, ``run_ts``).

    The text is read and decoded once, into a staged folder; the merge reads the staged
    rows and the Silver table once each."""
    states, staging = store.stage_input(decode_states(batch, fmt=fmt))
    try:
        if min_rows is not None:
            for r in states.groupBy("run_ts").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") < min_rows).take(1):
                check_count(r["n"], min_rows, what=f"state vectors in run {r['run_ts']}")
        if quarantine_dir:
            write_quarantine(quarantine_rows(states), quarantine_dir, batch_id=batch_id)
        as_of_col = run_ts_to_epoch(F.col("run_ts")) if as_of is None else as_of
        new = silver_latest(states, as_of_col, run_col="run_ts")  # newest run, then recency
        merged = upsert(read_silver(store), new, order_by=RECENCY_ORDER)
        version, path = store.write_version(
            with_country_part(merged), "silver", partition_by=S.COUNTRY_PART, rebalance=S.COUNTRY_PART
        )
        last_run = states.agg(F.max("run_ts")).first()[0]
    finally:
        store.delete(staging)
    n = store.rows_in(path, SILVER_STORED_SCHEMA)
    store.commit(Commit("silver", version, path, n, run_ts=last_run, batch_id=batch_id))


def bronze_stream(
    spark: SparkSession,
    bronze_dir: str,
    *,
    fmt: str = "line",
    max_files_per_trigger: int | None = None,
    archive_dir: str | None = None,
) -> DataFrame:
    """Streaming text source over a Bronze folder: ``value``, the run stamp and the name of its file.

    The file source lists the folder on every trigger; with ``archive_dir``
    processed files are moved there (``cleanSource=archive``), so the listing
    stays proportional to the backlog instead of the whole history."""
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    if archive_dir:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    if fmt == "array":
        return read_pieces(reader, bronze_dir)
    return reader.text(bronze_dir).select("value", run_stamp_of_file().alias("run_ts"), F.col("_metadata.file_path").alias("_file"))


def run_incremental(
    spark: SparkSession,
    bronze_dir: str,
    store: TableStore,
    checkpoint: str,
    *,
    fmt: str = "line",
    max_files_per_trigger: int | None = None,
    available_now: bool = True,
    processing_time: str | None = None,
    as_of: int | None = None,
    quarantine_dir: str | None = None,
    archive_dir: str | None = None,
    min_rows: int | None = None,
    gated: bool = False,
) -> StreamingQuery:
    """Start the incremental Silver stream; returns the running query. ``gated`` publishes whole runs
    that pass the gate (``min_rows``, by default the batch job's)."""
    src = bronze_stream(
        spark, bronze_dir, fmt=fmt, max_files_per_trigger=max_files_per_trigger, archive_dir=archive_dir
    )

    def _each(batch: DataFrame, batch_id: int) -> None:
        if gated:
            hold(batch, store, fmt=fmt)
            publish_held(store, min_rows=S.SILVER_MIN_ROWS if min_rows is None else min_rows, as_of=as_of, quarantine_dir=quarantine_dir)
            return
        process_batch(batch, batch_id, store, fmt=fmt, as_of=as_of, quarantine_dir=quarantine_dir, min_rows=min_rows)

    w = src.writeStream.foreachBatch(_each).option("checkpointLocation", checkpoint)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()

"""Incremental Silver with the record-count gate, for runs that arrive in several batches.

A micro-batch can hold a part of a run, so it can't be gated by itself. Its decoded rows are held beside the
tables, by run and Bronze file, and after each batch the runs that are held are compared with the manifest:

* fewer rows held than the run's Bronze commit counts, or no commit yet: the run waits,
* all rows there, at least ``min_rows``: the run goes into Silver, as a version of its own that names the Bronze commit,
* all rows there, but too few: the run is recorded as rejected, and the stream goes on.

Held rows leave once their run is decided. A file that is delivered again (a replayed batch, a new checkpoint) replaces its own
held rows and no others; a run whose Bronze commit is decided already isn't taken twice. If a run is landed again
while parts of its first landing are held, files that are no longer in its Bronze folder don't count (so archive files only
once their run is decided, or keep corrections out of such a stream). The merge is the recency merge of
:mod:`contrail.streaming.incremental`, and a run that Silver took before is corrected as in the batch job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contrail import schema as S
from contrail.functions.time import run_ts_to_epoch
from contrail.operators.quality import quarantine_rows
from contrail.operators.upsert import upsert, withdraw
from contrail.plans.layers import silver_latest
from contrail.sinks.store import (
    SILVER_STORED_SCHEMA,
    Commit,
    TableStore,
    read_silver,
    run_ledger,
    with_country_part,
    write_quarantine,
)
from contrail.sources.bronze import decode_states

HELD_SCHEMA = T.StructType([
    *S.STATE_SCHEMA.fields, T.StructField("_decode_error", T.StringType()), T.StructField("_raw", T.StringType()),
    T.StructField("run_ts", T.StringType()), T.StructField("part", T.StringType()),
])


def _path(store: TableStore) -> str:
    return f"{store.root}/_held"


def held(store: TableStore) -> DataFrame:
    """Decoded rows of undecided runs, by ``run_ts`` and ``part`` (a Bronze file)."""
    if not store._exists(_path(store)):
        return store.spark.createDataFrame([], HELD_SCHEMA)
    return store.spark.read.schema(HELD_SCHEMA).parquet(_path(store))


def part_of(file_name) -> F.Column:
    """The folder name for a file's rows: its name alone, so a moved folder is the same."""
    return F.concat(F.lit("f"), F.hex(F.xxhash64(F.element_at(F.split(file_name, "/"), -1))))


def hold(batch: DataFrame, store: TableStore, fmt: str = "line") -> None:
    """Decode a micro-batch (``value``, ``run_ts``, ``_file``) and hold its rows; each file replaces its own."""
    rows = decode_states(batch.withColumn("part", part_of(F.col("_file"))), fmt=fmt)
    (
        rows.select(*HELD_SCHEMA.names).hint("rebalance", "run_ts", "part")
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_ts", "part").parquet(_path(store))
    )


def _files_of(store: TableStore, folder: str) -> DataFrame:
    p, fs = store._fs(folder)
    names = [st.getPath().getName() for st in fs.listStatus(p)] if fs.exists(p) else []
    return store.spark.createDataFrame([(n,) for n in names], "name string").select(part_of(F.col("name")).alias("part"))


def publish_held(
    store: TableStore, *, min_rows: int = S.SILVER_MIN_ROWS, as_of: int | None = None, quarantine_dir: str | None = None
) -> list[tuple[str, str]]:
    """Decide every held run that is complete, in order of the run stamp; returns (run, 'taken' or 'rejected')."""
    spark: SparkSession = store.spark
    rows = held(store)
    counts = rows.groupBy("run_ts").agg(F.count(F.lit(1)).alias("n"))
    ledger = run_ledger(store).filter(F.col("state") != "superseded")
    known = counts.join(ledger, "run_ts").orderBy("run_ts").collect()  # a row for each undecided run
    out = []
    for r in known:
        run, mine = r["run_ts"], rows.filter(F.col("run_ts") == r["run_ts"])
        if r["state"] == "landed":
            n = r["n"]
            if n > r["record_count"]:
                mine = mine.join(_files_of(store, r["output_path"]), "part", "left_semi")
                n = mine.count()
            if n < r["record_count"]:
                continue
            if n < min_rows:
                bronze = {"version": r["bronze_version"], "output_path": r["output_path"], "record_count": n}
                store.reject(run, bronze, f"count gate: only {n} state vectors in run {run}, at least {min_rows} are needed")
                out.append((run, "rejected"))
            else:
                _take(spark, store, mine, run, r["bronze_version"], as_of, quarantine_dir)
                out.append((run, "taken"))
        store.delete(f"{_path(store)}/run_ts={run}")
    return out


def _take(spark, store: TableStore, states: DataFrame, run: str, bronze_version: int, as_of: int | None, quarantine_dir: str | None) -> None:
    from contrail.streaming.incremental import RECENCY_ORDER

    if quarantine_dir:
        write_quarantine(quarantine_rows(states), quarantine_dir, runs=[run])
    new = silver_latest(states, run_ts_to_epoch(F.col("run_ts")) if as_of is None else as_of, run_col="run_ts")
    table = read_silver(store)
    if table is not None and store.find("silver", run) is not None:
        before = store.before_run(run)
        table = withdraw(table, None if before is None else read_silver(store, before["version"]), run)
    merged = upsert(table, new, order_by=RECENCY_ORDER)
    version, path = store.write_version(with_country_part(merged), "silver", partition_by=S.COUNTRY_PART, rebalance=S.COUNTRY_PART)
    n = store.rows_in(path, SILVER_STORED_SCHEMA)
    store.commit(Commit("silver", version, path, n, run_ts=run, source_version=bronze_version))

"""Bronze: landing API snapshots and decoding positional state vectors.

Storage layout chosen for scale: one *JSON line per state vector*, partitioned
by run (``<root>/run_ts=<yyyyMMdd_HHmmss>/part-*.txt``). Lines are splittable,
so a large run is read by many tasks; decoding is pure column expressions.
Snapshot files in the original form (one indented JSON array of arrays per
file) are read with ``fmt='array'``: the text between two inner arrays is the reader's record
separator, so a file is split like any text and decoded by as many tasks as it has splits. The pieces miss
their outer brackets, which are put back. A file in another layout (one line, other indents) holds no
separator and is one piece. A file that ends before its last bracket is logged as malformed beside the states it has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from contrail import schema as S
from contrail.functions.decode import decode_error, readings, state_columns, state_json, state_json_indented

# ``_corrupt_record`` takes the text of a body that isn't a JSON object with a list of states.
ENVELOPE_SCHEMA = "struct<states: array<string>, _corrupt_record: string>"
_STAMP = "[0-9]{8}_[0-9]{6}"
#: What stands between two states of a snapshot file written with an indent of four. A line feed can't occur inside a
#: JSON string, and deeper arrays are indented further, so nothing else matches.
ARRAY_SEPARATOR = "\n    ],\n    ["


class DataQualityError(Exception):
    """Raised when a run fails a gate (too few rows, malformed input in failfast mode)."""


def run_stamp_of_file(run_col: str = "run_ts") -> Column:
    """The run stamp of the file a row comes from: its ``run_ts=`` folder, else the stamp in
    the file's own name (folders above it don't count). A file without one fails the read."""
    path = F.col("_metadata.file_path")
    stamp = F.coalesce(
        F.nullif(F.regexp_extract(path, f"/{run_col}=({_STAMP})/[^/]*$", 1), F.lit("")),
        F.nullif(F.regexp_extract(path, f"({_STAMP})[^/]*$", 1), F.lit("")),
    )
    return F.coalesce(stamp, F.raise_error(F.concat(F.lit("no run stamp in the name of "), path)).cast("string"))


# ---------------------------------------------------------------------------
# Landing
# ---------------------------------------------------------------------------


def unreadable(body_col: str = "body") -> Column:
    """Whether a response body isn't a JSON object whose states, if any, are a list."""
    env = F.from_json(F.col(body_col), ENVELOPE_SCHEMA, {"columnNameOfCorruptRecord": "_corrupt_record"})
    return F.col(body_col).isNull() | env.getField("_corrupt_record").isNotNull()


def envelope_states(responses: DataFrame, *, body_col: str = "body", run_col: str = "run_ts") -> DataFrame:
    """API response envelopes -> one row per state vector (its compact JSON text).

    Only ``states`` is used; a missing or null ``states`` contributes no rows, so
    the count gate sees zero. An unreadable body becomes one line with its text, which
    decoding flags as unparsable, so it is logged rather than lost.
    """
    env = F.from_json(F.col(body_col), ENVELOPE_SCHEMA, {"columnNameOfCorruptRecord": "_corrupt_record"})
    parsed = responses.select(F.col(run_col).cast("string").alias(run_col), F.col(body_col).alias("_body"), env.alias("_env"))
    bad = F.col("_body").isNull() | F.col("_env._corrupt_record").isNotNull()
    text = F.translate(F.coalesce(F.col("_body"), F.lit("null")), "\r\n", "  ")
    # An unreadable body could still hold whole states: keep it as one value, marked so that it can't parse.
    return parsed.select(
        run_col,
        F.explode(F.when(bad, F.array(F.concat(F.lit("!"), text))).otherwise(F.col("_env.states"))).alias("value"),
    )


def land_snapshots(
    responses: DataFrame,
    path: str,
    *,
    body_col: str = "body",
    run_col: str = "run_ts",
    compression: str | None = None,
) -> str:
    """Write the states of each response as JSON lines under ``path/run_ts=…``.

    Re-landing a run replaces only that run's partition (dynamic partition
    overwrite), so a retried landing is idempotent. Output is rebalanced on the
    run column: AQE splits an oversized run into several files and packs small
    runs together, instead of one task per run.
    """
    states = envelope_states(responses, body_col=body_col, run_col=run_col)
    writer = (
        states.hint("rebalance", run_col)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(run_col)
    )
    if compression:
        writer = writer.option("compression", compression)
    writer.text(path)
    return path


def landed_counts(spark: SparkSession, path: str, runs: list[str], *, run_col: str = "run_ts") -> DataFrame:
    """(run_ts, n_states, n_unreadable) of the given runs; only their folders are listed and read."""
    root = path.rstrip("/")
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    folders = [jvm.org.apache.hadoop.fs.Path(f"{root}/{run_col}={r}") for r in runs]
    there = [p.toString() for p in folders if p.getFileSystem(conf).exists(p)]
    if not there:
        return spark.createDataFrame([], f"{run_col} string, n_states long, n_unreadable long")
    df = spark.read.option("basePath", root).text(there)
    return df.groupBy(F.col(run_col).cast("string").alias(run_col)).agg(
        F.count(F.lit(1)).alias("n_states"), F.count_if(F.col("value").startswith("!")).alias("n_unreadable")
    )


# ---------------------------------------------------------------------------
# Decoding
# ---------------------------------------------------------------------------


def _piece_bounds(piece: Column) -> tuple[Column, Column]:
    """Whether a piece is a file's first one, and whether the file ends with it: after a separator comes a line feed (or the
    bracket of an empty state), and only the outer array closes at the start of a line. A file in another layout, where
    no separator follows the first bracket, is whole in its first piece."""
    first = ~(piece.startswith("\n") | piece.startswith("]"))
    return first, piece.rlike(r"\n\]\s*$") | (first & ~piece.startswith("[\n    ["))


def _snapshot(piece: Column) -> Column:
    """The states of a piece as ``array<array<string>>``, its outer brackets put back; null if unparsable."""
    first, last = _piece_bounds(piece)
    opened = F.when(first, piece).otherwise(F.concat(F.lit("[["), piece))
    return F.from_json(F.when(last, opened).otherwise(F.concat(opened, F.lit("]]"))), "array<array<string>>")


def _endless_files(pieces: DataFrame, value_col: str) -> DataFrame:
    """One unparsable row, its value the file's name, for each file without a last piece. A narrow count by file,
    taken up within each task first."""
    keep = [c for c in pieces.columns if c not in (value_col, "_file")]
    ends = pieces.groupBy("_file", *keep).agg(F.count_if(_piece_bounds(F.col(value_col))[1]).alias("_ends")).filter("_ends = 0")
    return ends.select(*keep, F.concat(F.lit("!no end of file: "), F.col("_file")).alias(value_col))


def read_pieces(reader, path, run_col: str = "run_ts") -> DataFrame:
    """(value, run, _file): snapshot files cut into pieces by a batch or stream reader."""
    raw = reader.option("lineSep", ARRAY_SEPARATOR).text(path)
    return raw.select("value", run_stamp_of_file(run_col).alias(run_col), F.col("_metadata.file_path").alias("_file"))


def decode_states(df: DataFrame, *, value_col: str = "value", fmt: str = "line") -> DataFrame:
    """Text -> 17 typed state columns + ``_decode_error`` + ``_raw``.

    ``fmt='line'``: each value is one positional array. ``fmt='array'``: each
    value is a snapshot (array of arrays) or a piece of one, cut at :data:`ARRAY_SEPARATOR`; an unparsable
    one yields a single row with ``_decode_error='unparsable'`` and its text. If there is a column ``_file``, a file without
    an end yields such a row too, with the file's name as text. Other input
    columns pass through. ``_raw`` keeps the source text of malformed rows only.
    """
    keep = [c for c in df.columns if c not in (value_col, "_file")]
    v = F.col(value_col)
    if fmt == "line":
        staged = df.select(*keep, F.from_json(v, "array<string>").alias("_arr"), v.alias("_text"))
        raw: Column = F.col("_text")
    elif fmt == "array":
        if "_file" in df.columns:
            df = df.drop("_file").unionByName(_endless_files(df, value_col))
        marker = F.array(F.lit(None).cast("array<string>"))
        parsed = df.select(*keep, v.alias("_text"), _snapshot(v).alias("_snap"))
        staged = parsed.select(
            *keep,
            F.when(F.col("_snap").isNull(), F.col("_text")).alias("_text"),
            F.explode(F.coalesce(F.col("_snap"), marker)).alias("_arr"),
        )
        raw = F.coalesce(F.col("_text"), F.to_json(F.col("_arr")))
    else:
        raise ValueError(f"unknown bronze format {fmt!r}")
    # Readings first, the typed columns and the error flag after them: both take the
    # readings, so every cast runs once (the projections stay separate
    # because the readings are referenced several times).
    # The raw text is only rendered for malformed rows.
    read = staged.select(*keep, "_arr", "_text", *readings("_arr"))
    typed = read.select("*", *state_columns("_arr"))
    err = decode_error("_arr")
    return typed.select(
        *keep,
        *S.STATE_COLUMNS,
        err.alias("_decode_error"),
        F.when(err.isNotNull(), raw).alias("_raw"),
    )


def read_states(
    spark: SparkSession,
    path: str | list[str],
    *,
    fmt: str = "line",
    run_col: str = "run_ts",
    mode: str = "permissive",
) -> DataFrame:
    """Read Bronze text and decode it on the executors.

    Lines format: the run comes from the ``run_ts=`` partition folder.
    Array format (one snapshot per file, e.g. ``aircraft_data_<stamp>.json``):
    the run is the ``yyyyMMdd_HHmmss`` stamp in the file name.
    ``mode='failfast'`` raises :class:`DataQualityError` if any row is malformed
    (one extra aggregation job); ``'permissive'`` keeps them flagged.
    """
    paths = [path] if isinstance(path, str) else list(path)
    if fmt == "line":
        raw = spark.read.text(paths)
        if run_col in raw.columns:
            raw = raw.withColumn(run_col, F.col(run_col).cast("string"))
        else:
            raw = raw.withColumn(run_col, run_stamp_of_file(run_col))
    elif fmt == "array":
        raw = read_pieces(spark.read, paths, run_col)
    else:
        raise ValueError(f"unknown bronze format {fmt!r}")
    states = decode_states(raw, fmt=fmt)
    if mode == "failfast":
        bad = states.filter(F.col("_decode_error").isNotNull()).agg(F.count(F.lit(1))).first()[0]
        if bad:
            raise DataQualityError(f"{bad} malformed state vector(s) in {paths}")
    elif mode != "permissive":
        raise ValueError(f"unknown mode {mode!r}")
    return states


def to_state_lines(states: DataFrame, *extra: str) -> DataFrame:
    """Typed state vectors -> positional JSON text (``value``), plus ``extra`` columns."""
    return states.select(*extra, state_json().alias("value"))


def write_array_snapshots(states: DataFrame, path: str, *, run_col: str = "run_ts", order: str, body: Column | None = None) -> None:
    """Write each run as one indented JSON array of arrays, as an API client's ``json.dump(states, indent=4)`` does.

    One file a run is the format, so a run is written by one task (sorted by ``order``, spilling); nothing of it is held
    in memory. ``body`` replaces the indented text of a state."""
    rows = states.select(run_col, order, (state_json_indented() if body is None else body).alias("_body"))
    in_run = Window.partitionBy(run_col).orderBy(order, "_body")
    text = F.concat(
        F.when(F.row_number().over(in_run) == 1, F.lit("[\n")).otherwise(F.lit("")),
        F.col("_body"),
        F.when(F.lead(F.lit(1)).over(in_run).isNull(), F.lit("\n]")).otherwise(F.lit(",")),
    )
    rows.select(run_col, text.alias("value")).write.partitionBy(run_col).text(path)


def to_envelopes(states: DataFrame, *, time_col: Column, run_col: str = "run_ts") -> DataFrame:
    """Wrap each state vector in its own API-style envelope ``{"time":…,"states":[…]}``.

    One envelope per state keeps every row independent (no grouping of a whole
    run into one value)."""
    body = F.concat(
        F.lit('{"time":'),
        F.coalesce(time_col.cast("string"), F.lit("null")),
        F.lit(',"states":['),
        state_json(),
        F.lit("]}"),
    )
    return states.select(F.col(run_col).alias(run_col), body.alias("body"))


# ---------------------------------------------------------------------------
# Run selection
# ---------------------------------------------------------------------------


def latest_run(manifest: DataFrame, stage: str = "bronze") -> DataFrame:
    """The newest committed run of ``stage`` (0 or 1 row), chosen by (run_ts, version)."""
    m = manifest.filter(F.col("stage") == stage)
    order = [c for c in ("run_ts", "version") if c in m.columns]
    w = F.max_by(F.struct(*m.columns), F.struct(*order)).alias("_r")
    return m.agg(w).select("_r.*").filter(F.col("run_ts").isNotNull())


__all__ = [
    "DataQualityError",
    "decode_states",
    "envelope_states",
    "land_snapshots",
    "landed_counts",
    "latest_run",
    "read_pieces",
    "read_states",
    "to_envelopes",
    "to_state_lines",
    "write_array_snapshots",
]

"""Versioned Parquet tables with a manifest as the commit log.

Layout under one root (a shared folder)::

    <root>/_manifest/<stage>-000001.json          one small JSON file per commit (MANIFEST_SCHEMA)
    <root>/_manifest/_checkpoint-000001.json      what the log's checkpoint covers, and the newest commit of each stage
    <root>/_manifest/_checkpoints/000001-<id>/    the covered commits, as Parquet
    <root>/<stage>/v=000001-<attempt>/            a complete table version
    <root>/_staging/                              input of a running job, deleted when it ends

A version folder is written first, under a name of its own for each attempt, and
becomes visible when its manifest file appears. That file is written under another name and
published by a rename that refuses an existing target (on a local disk by a hard link), so a reader
never sees half of it, a writer that dies leaves only an ignored name, and of two writers that try the
same version the second one fails instead of replacing the first one's rows. The file system must
offer that rename as one step, as HDFS and local disks do; on an object store without it only one writer at a time is safe.

A record that is empty, cut off or not about its own version is no commit: readers pass over it, and its
version number isn't used again. A record that is written twice over counts once.

Every ``CHECKPOINT_EVERY`` commits the log is summed up in a checkpoint. Readers take the newest checkpoint and the commit files
that follow it, so what they list and read is bounded however long the history is. Covered files are deleted
at the next checkpoint but one, so readers that began earlier still find them.

Old table versions stay readable (time travel by version); pruning them is an operational choice.
"""

from __future__ import annotations

import contextlib
import json
import re
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contrail import schema as S

#: Commit files after which the log is summed up.
CHECKPOINT_EVERY = 50
#: Rows in a page of a clustered table: what a reader can skip at the least.
PAGE_ROWS = 1000
_COMMIT_NAME = re.compile(r"([^-].*)-(\d{6,})\.json")
_CHECKPOINT_NAME = re.compile(r"_checkpoint-(\d{6,})\.json")
_NEEDED = ("stage", "version", "output_path", "record_count")


class CommitConflict(RuntimeError):
    """Another writer committed this version first."""


@dataclass
class Commit:
    stage: str
    version: int
    path: str
    record_count: int
    run_ts: str | None = None
    batch_id: int | None = None
    source_version: int | None = None
    note: str | None = None

    def record(self) -> dict:
        return {
            "run_ts": self.run_ts,
            "stage": self.stage,
            "version": int(self.version),
            "output_path": self.path,
            "record_count": int(self.record_count),
            "batch_id": self.batch_id,
            "source_version": self.source_version,
            "note": self.note,
        }


def parse_record(text: str, stage: str, version: int) -> Row | None:
    """The commit in a manifest file's text, or null if it is torn: every line must be
    the same whole record, of that stage and version."""
    found = set()
    for line in filter(None, map(str.strip, text.splitlines())):
        try:
            rec = json.loads(line)
        except ValueError:
            return None
        if not isinstance(rec, dict) or any(rec.get(k) is None for k in _NEEDED):
            return None
        found.add(tuple(rec.get(f.name) for f in S.MANIFEST_SCHEMA.fields))
    if len(found) != 1:
        return None
    row = Row(*S.MANIFEST_SCHEMA.names)(*found.pop())
    return row if (row["stage"], row["version"]) == (stage, version) else None


@dataclass
class _Log:
    """One listing of the manifest: the newest readable checkpoint and the commit files beyond it."""

    covered: dict[str, int]  # stage -> newest version that the checkpoint has
    heads: dict[str, dict]  # stage -> its newest commit among those
    path: str | None  # the covered commits
    files: dict[str, list[int]]  # stage -> versions of the files beyond it, in order
    number: int  # of the newest checkpoint file, readable or not


class TableStore:
    def __init__(self, spark: SparkSession, root: str, checkpoint_every: int = CHECKPOINT_EVERY):
        self.spark = spark
        self.root = root.rstrip("/")
        self.manifest_path = f"{self.root}/_manifest"
        self.checkpoint_every = checkpoint_every

    # -- manifest -----------------------------------------------------------

    def _fs(self, path: str):
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _exists(self, path: str) -> bool:
        p, fs = self._fs(path)
        return fs.exists(p)

    def delete(self, path: str) -> None:
        p, fs = self._fs(path)
        fs.delete(p, True)

    def _names(self) -> list[str]:
        p, fs = self._fs(self.manifest_path)
        return [st.getPath().getName() for st in fs.listStatus(p)] if fs.exists(p) else []

    def _text(self, path: str) -> str | None:
        """A small file's text; null if it is gone."""
        p, fs = self._fs(path)
        if not fs.exists(p):
            return None
        stream = fs.open(p)
        try:
            return self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def _log(self) -> _Log:
        names = self._names()
        numbers = sorted((int(m[1]) for m in map(_CHECKPOINT_NAME.fullmatch, names) if m), reverse=True)
        covered, heads, path = {}, {}, None
        for n in numbers:
            with contextlib.suppress(ValueError, KeyError, TypeError):  # a torn one: the one before it has all but the newest files
                rec = json.loads(self._text(f"{self.manifest_path}/_checkpoint-{n:06d}.json") or "")
                covered, heads, path = rec["covered"], rec["heads"], rec["path"]
                break
        files: dict[str, list[int]] = {}
        for m in filter(None, map(_COMMIT_NAME.fullmatch, names)):
            if not m[1].startswith("_") and int(m[2]) > covered.get(m[1], 0):
                files.setdefault(m[1], []).append(int(m[2]))
        return _Log(covered, heads, path, {k: sorted(v) for k, v in files.items()}, numbers[0] if numbers else 0)

    def manifest(self) -> DataFrame:
        """All commits: those of the newest checkpoint and of the files beyond it."""
        log = self._log()
        out = self.spark.createDataFrame([], S.MANIFEST_SCHEMA) if log.path is None else self.spark.read.schema(S.MANIFEST_SCHEMA).parquet(log.path)
        paths = [self._commit_file(stage, v) for stage, versions in log.files.items() for v in versions]
        if not paths:
            return out
        # The rules of parse_record, as one small job over at most some tens of files.
        torn = T.StructType([*S.MANIFEST_SCHEMA.fields, T.StructField("_corrupt_record", T.StringType())])
        lines = self.spark.read.schema(torn).json(paths).withColumn("_file", F.col("_metadata.file_name"))
        own = F.concat("stage", F.lit("-"), F.lpad(F.col("version").cast("string"), 6, "0"), F.lit(".json")) == F.col("_file")
        good = F.col("_corrupt_record").isNull() & F.coalesce(own, F.lit(False))
        for name in _NEEDED:
            good &= F.col(name).isNotNull()
        rows = lines.groupBy("_file").agg(F.collect_set(F.struct(*S.MANIFEST_SCHEMA.names)).alias("recs"), F.min(good).alias("good"))
        rows = rows.filter(F.col("good") & (F.size("recs") == 1)).select(F.col("recs")[0].alias("r")).select("r.*")
        return out.unionByName(rows)

    def _commit_file(self, stage: str, version: int) -> str:
        return f"{self.manifest_path}/{stage}-{version:06d}.json"

    def _record(self, stage: str, version: int) -> Row | None:
        text = self._text(self._commit_file(stage, version))
        if text is not None:
            return parse_record(text, stage, version)
        m = self.manifest()
        return m.filter((F.col("stage") == stage) & (F.col("version") == version)).first()

    def current(self, stage: str) -> Row | None:
        """The newest commit, looked up anew on every call; torn records are passed over."""
        log = self._log()
        for version in reversed(log.files.get(stage, [])):
            rec = self._record(stage, version)
            if rec is not None:
                return rec
        head = log.heads.get(stage)
        return None if head is None else Row(*S.MANIFEST_SCHEMA.names)(*(head.get(n) for n in S.MANIFEST_SCHEMA.names))

    def find(self, stage: str, run_ts: str) -> Row | None:
        """The newest commit of ``stage`` for ``run_ts`` (one-row query)."""
        m = self.manifest().filter((F.col("stage") == stage) & (F.col("run_ts") == run_ts))
        row = m.agg(F.max_by(F.struct(*m.columns), "version").alias("r")).first()
        return row["r"] if row is not None and row["r"] is not None else None

    def before_run(self, run_ts: str) -> Row | None:
        """The newest Silver commit before the first one that took ``run_ts``."""
        m = self.manifest().filter(F.col("stage") == "silver")
        first = m.filter(F.col("run_ts") == run_ts).agg(F.min("version")).scalar()
        row = m.filter(F.col("version") < first).agg(F.max_by(F.struct(*m.columns), "version").alias("r")).first()
        return row["r"] if row is not None and row["r"] is not None else None

    def pending_runs(self) -> list[Row]:
        """Bronze commits that nothing has become of yet, in order of the run stamp."""
        waiting = run_ledger(self).filter(F.col("state") == "landed")
        return waiting.select("run_ts", F.col("bronze_version").alias("version"), "output_path", "record_count").orderBy("run_ts").collect()

    def _publish(self, path: str, text: str) -> bool:
        """Make a file with ``text`` appear under ``path`` in one step; false if there is one already."""
        jvm = self.spark.sparkContext._jvm
        final, fs = self._fs(path)
        temp = jvm.org.apache.hadoop.fs.Path(final.getParent(), f".{final.getName()}.{uuid.uuid4().hex}.tmp")
        out = fs.create(temp, True)
        try:
            out.write(bytearray(text.encode("utf-8")))
        finally:
            out.close()
        try:
            if fs.getUri().getScheme() == "file":
                at = [jvm.java.nio.file.Paths.get(fs.makeQualified(p).toUri()) for p in (final, temp)]
                jvm.java.nio.file.Files.createLink(*at)
            else:
                kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
                options = self.spark.sparkContext._gateway.new_array(kind, 1)
                options[0] = kind.NONE
                target = fs.makeQualified(final)
                jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), self.spark.sparkContext._jsc.hadoopConfiguration()).rename(
                    fs.makeQualified(temp), target, options)
        except Exception:
            if fs.exists(final):
                return False
            raise
        finally:
            fs.delete(temp, False)
        return True

    def commit(self, c: Commit) -> None:
        """Publish the manifest file of this version; raises if there is one already."""
        if c.version <= self._log().covered.get(c.stage, 0) or not self._publish(
            self._commit_file(c.stage, int(c.version)), json.dumps(c.record()) + "\n"
        ):
            raise CommitConflict(f"{c.stage} version {c.version} is already committed")
        if sum(map(len, self._log().files.values())) >= self.checkpoint_every:
            self.checkpoint()

    def reject(self, run_ts: str, bronze: Row, note: str) -> int:
        """Record that Silver refuses this Bronze commit; returns the record's number."""
        version = self.next_version("rejected")
        self.commit(Commit("rejected", version, bronze["output_path"], bronze["record_count"], run_ts=run_ts,
                           source_version=bronze["version"], note=note))
        return version

    def checkpoint(self) -> None:
        """Sum up the log: one Parquet file with all commits, then a small file that points to it."""
        log = self._log()
        number = log.number + 1
        path = f"{self.manifest_path}/_checkpoints/{number:06d}-{uuid.uuid4().hex[:8]}"
        # Only the files of this listing, though others may have come since.
        covered = log.covered | {stage: versions[-1] for stage, versions in log.files.items()}
        limit = F.coalesce(*(F.when(F.col("stage") == s, F.lit(v)) for s, v in covered.items()), F.lit(0))
        self.manifest().filter(F.col("version") <= limit).coalesce(1).write.parquet(path)
        rows = self.spark.read.schema(S.MANIFEST_SCHEMA).parquet(path)
        newest = rows.groupBy("stage").agg(F.max_by(F.struct(*rows.columns), "version").alias("r")).collect()
        rec = {"covered": covered, "heads": {r["stage"]: r["r"].asDict() for r in newest}, "path": path}
        if not self._publish(f"{self.manifest_path}/_checkpoint-{number:06d}.json", json.dumps(rec)):
            self.delete(path)  # another writer's checkpoint serves as well
            return
        for name in self._names():  # what the checkpoint before already covered
            commit, old = _COMMIT_NAME.fullmatch(name), _CHECKPOINT_NAME.fullmatch(name)
            if (old and int(old[1]) < number - 1) or (commit and int(commit[2]) <= log.covered.get(commit[1], 0)):
                self.delete(f"{self.manifest_path}/{name}")
        p, fs = self._fs(f"{self.manifest_path}/_checkpoints")
        for st in fs.listStatus(p):
            if int(st.getPath().getName()[:6]) < number - 1:
                fs.delete(st.getPath(), True)

    # -- versions -----------------------------------------------------------

    def next_version(self, stage: str) -> int:
        log = self._log()
        return max([log.covered.get(stage, 0), *log.files.get(stage, [])]) + 1

    def read(self, stage: str, schema: T.StructType | None = None, version: int | None = None) -> DataFrame | None:
        """The committed table (latest, or ``version``); None if never committed."""
        rec = self.current(stage) if version is None else self._record(stage, version)
        if rec is None:
            return None
        return self.read_path(rec["output_path"], schema)

    def read_path(self, path: str, schema: T.StructType | None = None) -> DataFrame:
        reader = self.spark.read
        if schema is not None:
            reader = reader.schema(schema)
        return reader.parquet(path)

    def write_version(
        self,
        df: DataFrame,
        stage: str,
        *,
        partition_by: str | None = None,
        rebalance: str | None = None,
        cluster_by: Column | None = None,
        tie: str | None = None,
    ) -> tuple[int, str]:
        """Write ``df`` as the next (uncommitted) version; returns (version, path).

        ``cluster_by`` deals the rows by ranges of a key and sorts each file by it, in small pages, so that the files' statistics let
        a reader skip what it doesn't ask for; rows of one key are split by ``tie``, so a crowded place fills several files."""
        version = self.next_version(stage)
        path = f"{self.root}/{stage}/v={version:06d}-{uuid.uuid4().hex[:8]}"
        out = df.hint("rebalance", rebalance) if rebalance else df
        if cluster_by is not None:
            order = ["_key", *([tie] if tie else [])]
            out = out.withColumn("_key", cluster_by).repartitionByRange(*order).sortWithinPartitions(*order).drop("_key")
        writer = out.write
        if cluster_by is not None:
            writer = writer.option("parquet.page.row.count.limit", str(PAGE_ROWS))
        if partition_by:
            writer = writer.partitionBy(partition_by)
        writer.parquet(path)
        return version, path

    def rows_in(self, path: str, schema: T.StructType) -> int:
        """Rows of a written Parquet folder, from the file footers; 0 if it holds no file."""
        return self.read_path(path, schema).count()

    def stage_input(self, df: DataFrame) -> tuple[DataFrame, str]:
        """Write a job's input once under ``_staging`` and read it back; delete it after the commit."""
        path = f"{self.root}/_staging/{uuid.uuid4().hex[:12]}"
        df.write.parquet(path)
        return self.read_path(path, df.schema), path

    def stage_observed(self, df: DataFrame, **metrics: Column) -> tuple[DataFrame, str, dict[str, int]]:
        """:meth:`stage_input` with aggregates of the rows, observed while they are written."""
        seen = Observation()
        states, path = self.stage_input(df.observe(seen, *(c.alias(k) for k, c in metrics.items())))
        return states, path, {k: int(v) for k, v in seen.get.items()}


def run_config(store: TableStore) -> DataFrame:
    """Current view of the manifest: one row per run with the newest path and
    record count of each stage (``raw_file_path``, ``total_records``,
    ``silver_output_path``, …). A grouped max_by and a pivot over known stages;
    no job until used."""
    m = store.manifest()
    latest = m.groupBy("run_ts", "stage").agg(
        F.max_by(F.struct("output_path", "record_count"), "version").alias("c")
    )
    stages = [st for st, _, _ in S.RUN_CONFIG_KEYS]
    wide = latest.groupBy("run_ts").pivot("stage", stages).agg(F.first("c").alias("c"))
    cols = [F.col("run_ts")]
    for st, path_key, count_key in S.RUN_CONFIG_KEYS:
        cols += [F.col(st).getField("output_path").alias(path_key), F.col(st).getField("record_count").alias(count_key)]
    return wide.select(*cols)


def run_ledger(store: TableStore) -> DataFrame:
    """What became of each Bronze commit: one row per (run_ts, bronze_version) with ``state``

    * ``superseded`` a newer Bronze commit of the run exists (its rows are the run's rows now),
    * ``taken``      Silver has it, as of version ``silver_version``,
    * ``rejected``   it failed Silver's gate, for the reason in ``note``,
    * ``landed``     it waits.

    A superseded commit that Silver had taken keeps its ``silver_version``. A Silver commit that doesn't say which
    Bronze version it read (a streamed one) stands for its run."""
    m = store.manifest()
    is_bronze, is_silver = F.col("stage") == "bronze", F.col("stage") == "silver"
    of = F.when(is_bronze, F.col("version")).otherwise(F.col("source_version"))
    each = m.filter(F.col("stage").isin("bronze", "silver", "rejected")).groupBy("run_ts", of.alias("bronze_version")).agg(
        F.max(F.when(is_bronze, F.struct("output_path", "record_count"))).alias("landed"),
        F.max(F.when(is_silver, F.col("version"))).alias("took"),
        F.max_by("note", F.when(F.col("stage") == "rejected", F.col("version"))).alias("note"),
    )
    run = Window.partitionBy("run_ts")
    rows = each.select(
        "*",
        F.max(F.when(F.col("landed").isNotNull(), F.col("bronze_version"))).over(run).alias("newest"),
        F.max(F.when(F.col("bronze_version").isNull(), F.col("took"))).over(run).alias("run_took"),
    ).filter(F.col("landed").isNotNull())
    version = F.coalesce("took", "run_took")
    state = (
        F.when(F.col("bronze_version") < F.col("newest"), "superseded")
        .when(version.isNotNull(), "taken")
        .when(F.col("note").isNotNull(), "rejected")
        .otherwise("landed")
    )
    return rows.select("run_ts", "bronze_version", "landed.output_path", "landed.record_count", state.alias("state"), version.alias("silver_version"), "note")


# ---------------------------------------------------------------------------
# Silver storage helpers
# ---------------------------------------------------------------------------

SILVER_STORED_SCHEMA = T.StructType(
    list(S.SILVER_SCHEMA.fields) + [T.StructField(S.COUNTRY_PART, T.StringType(), True)]
)


BLANK_PART = "__blank__"


def country_tag(country: str) -> str:
    return country if country != "" else BLANK_PART


def partition_tag(column: str) -> Column:
    """Text to partition by: blank values would read back as null partitions and
    number-like ones would be retyped, so the folders hold a tagged copy and the column stays data."""
    return F.coalesce(F.nullif(F.col(column).cast("string"), F.lit("")), F.lit(BLANK_PART))


def with_country_part(df: DataFrame) -> DataFrame:
    return df.withColumn(S.COUNTRY_PART, partition_tag("origin_country"))


def read_silver(
    store: TableStore, version: int | None = None, countries: list[str] | None = None
) -> DataFrame | None:
    """The committed Silver table. ``countries`` restricts it to those origin
    countries through the partition column, so only their folders are listed
    and read (partition pruning)."""
    df = store.read("silver", SILVER_STORED_SCHEMA, version)
    if df is None:
        return None
    if countries is not None:
        df = df.filter(F.col(S.COUNTRY_PART).isin([country_tag(c) for c in countries]))
    return df.drop(S.COUNTRY_PART)


# ---------------------------------------------------------------------------
# Quarantine
# ---------------------------------------------------------------------------

QUARANTINE_READ_SCHEMA = T.StructType(
    list(S.QUARANTINE_SCHEMA.fields)
    + [
        T.StructField("dq_reason", T.StringType(), True),
        T.StructField("run_ts", T.StringType(), True),
    ]
)


def write_quarantine(
    rows: DataFrame,
    path: str,
    *,
    run_col: str = "run_ts",
    batch_id: int | None = None,
    runs: list[str] | None = None,
) -> None:
    """Logged rows as JSON under ``path/dq_reason=…/run_ts=…`` (one folder per
    reason and run; with ``batch_id`` one more level so batches of the same run
    never replace each other). ``runs`` names runs that are written as a whole: their
    old folders go first, so a corrected run leaves no old row. Otherwise a
    retry replaces exactly the folders it writes. The JSON writer omits null
    fields: read back with :data:`QUARANTINE_READ_SCHEMA`."""
    if runs:
        spark = rows.sparkSession
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        for run in runs:
            pattern = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/dq_reason=*/{run_col}={run}")
            fs = pattern.getFileSystem(conf)
            for old in fs.globStatus(pattern) or []:
                fs.delete(old.getPath(), True)
    cols = [f.name for f in S.QUARANTINE_SCHEMA.fields if f.name in rows.columns]
    parts = ["dq_reason", run_col]
    out = rows.select(*cols, "dq_reason", F.col(run_col).cast("string").alias(run_col))
    if batch_id is not None:
        out = out.withColumn("batch", F.lit(int(batch_id)))
        parts.append("batch")
    (
        out.hint("rebalance", "dq_reason", run_col)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*parts)
        .json(path)
    )


def read_quarantine(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(QUARANTINE_READ_SCHEMA).json(path)

"""Upsert by key on immutable Parquet (MERGE semantics without a table format).

``upsert(existing, new)`` = every ``new`` row, plus the ``existing`` rows whose
key is not in ``new``: matched keys are updated, new keys inserted,
target-only keys kept. ``new`` must hold one row per key (the Silver job
reduces it with ``latest_per_aircraft`` first). Columns that only the target has
stay in the result: an updated row keeps its old values there, an inserted one has nulls.

Plan: a left-anti join of ``existing`` against the key column of ``new``. A
snapshot's key set is small (one row per reporting aircraft), so the planner
broadcasts it whenever its estimated size is under
``spark.sql.autoBroadcastJoinThreshold`` — a size check made from the file
statistics of the staged ``new`` — and the large ``existing`` side is then
scanned once with no shuffle. Above the threshold it falls back to a
sort-merge join (AQE handles skewed keys).

With ``order_by`` the merge is a recency merge instead: the greater row by
``order_by`` wins each key (then by the remaining columns; ``new`` wins only
between identical rows), in one grouped pass over both sides, each read once. That
merge is commutative and idempotent, so replaying a batch, or snapshots arriving out
of order, gives the same table as processing them once in order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail import schema as S
from contrail.operators.dedup import pick_winner


def upsert(
    existing: DataFrame | None,
    new: DataFrame,
    keys: Sequence[str] = ("icao24",),
    *,
    order_by: Sequence[str] | None = None,
) -> DataFrame:
    keys = list(keys)
    if existing is None:
        return new
    if order_by is None:
        kept = existing.join(new.select(*keys), keys, "left_anti")
        only_target = [c for c in existing.columns if c not in new.columns]
        if only_target:
            new = new.join(existing.select(*keys, *only_target), keys, "left")
        return new.unionByName(kept, allowMissingColumns=True)
    # ``_src`` is the last column, so it only separates rows that are equal in
    # every other column: the winner does not depend on which batch a row arrived in.
    both = new.withColumn("_src", F.lit(1)).unionByName(existing.withColumn("_src", F.lit(0)), allowMissingColumns=True)
    winners = pick_winner(both, keys, list(order_by)).drop("_src")
    only_target = [c for c in existing.columns if c not in new.columns]
    if only_target:
        winners = winners.drop(*only_target).join(existing.select(*keys, *only_target), keys, "left")
    return winners


def withdraw(existing: DataFrame, before: DataFrame | None, run: str, keys: Sequence[str] = ("icao24",)) -> DataFrame:
    """``existing`` without the rows that ``run`` left in it: their keys go back to their rows in ``before`` (the
    table before that run), or leave. One grouped pass over both tables; other keys keep their rows."""
    left = existing.filter(~F.col(S.RUN_COL).eqNullSafe(F.lit(run)))
    if before is None:
        return left
    both = left.withColumn("_kept", F.lit(1)).unionByName(before.withColumn("_kept", F.lit(0)), allowMissingColumns=True)
    return pick_winner(both, list(keys), ["_kept"]).drop("_kept")


def newer_only_order(df: DataFrame) -> list[str]:
    """Recency order for ``upsert(..., order_by=…)``: the epoch form of
    ``last_contact`` when present, else its text (same order for real dates); an
    unchanged report goes to the later run, whose status is the later one."""
    order = [S.LAST_CONTACT_EPOCH if S.LAST_CONTACT_EPOCH in df.columns else "last_contact"]
    return order + ([S.RUN_COL] if S.RUN_COL in df.columns else [])

"""Deterministic winners per key: dedup on (icao24, last_contact) and the
latest report per aircraft.

Both are one hash-partitioned aggregation: ``max(struct(order…, rest…))`` per
key. The struct compares field by field (nulls lowest, so ``max`` behaves like
ORDER BY … DESC NULLS LAST), and because every remaining column follows the
ordering columns the order is total: the winner never depends on partitioning
or task timing. The aggregate is computed partially on the map side before the
shuffle, so a hot key (one aircraft with a third of all rows) is reduced to one
row per map task before it reaches its reducer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail import schema as S

DEDUP_KEYS = ("icao24", "last_contact")
DEDUP_ORDER = ("time_position", "callsign")
LATEST_KEY = ("icao24",)
LATEST_ORDER = ("last_contact", "time_position", "callsign")


def pick_winner(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per ``keys``: the greatest by ``order``, ties broken by every other column."""
    keys = list(keys)
    order = [c for c in order if c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in order]
    w = F.max(F.struct(*order, *rest)).alias("_w")
    out = df.groupBy(*keys).agg(w)
    return out.select(*[F.col(c) if c in keys else F.col(f"_w.{c}").alias(c) for c in df.columns])


def dedup_states(
    df: DataFrame,
    keys: Sequence[str] = DEDUP_KEYS,
    order: Sequence[str] = DEDUP_ORDER,
    *,
    run_col: str | None = None,
) -> DataFrame:
    """Drop duplicate reports of (icao24, last_contact); the kept row is the
    one with the latest ``time_position`` (then greatest callsign, then the
    remaining columns). A null ``last_contact`` forms one group per aircraft.
    With ``run_col`` duplicates are only removed within a run."""
    k = ([run_col] if run_col else []) + list(keys)
    return pick_winner(df, k, order)


def latest_per_aircraft(
    df: DataFrame,
    key: Sequence[str] = LATEST_KEY,
    order: Sequence[str] | None = None,
) -> DataFrame:
    """One row per aircraft: the newest report by ``order``.

    Default order: (run, last_contact epoch, time_position, callsign) using
    whichever of the hidden Silver columns are present, else the plain
    ``last_contact``."""
    if order is None:
        order = []
        if S.RUN_COL in df.columns:
            order.append(S.RUN_COL)
        order.append(S.LAST_CONTACT_EPOCH if S.LAST_CONTACT_EPOCH in df.columns else "last_contact")
        order += ["time_position", "callsign"]
    return pick_winner(df, key, order)

"""Silver and Gold transforms as pure DataFrame -> DataFrame functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail import schema as S
from contrail.functions import status as st
from contrail.operators.dedup import dedup_states, pick_winner
from contrail.functions import time as tfn
from contrail.operators.quality import clean_rows


def derive_silver(
    rows: DataFrame,
    as_of: int | Column,
    *,
    run_col: str | None = None,
    run_ts: str | None = None,
    inactive_s: int = S.INACTIVE_AFTER_S,
    expired_s: int = S.EXPIRED_AFTER_S,
    airborne_label: str = S.STATUS_AIRBORNE,
    tz: str | None = None,
) -> DataFrame:
    """Clean state rows -> Silver columns: status / reason / source type at
    ``as_of``, epoch columns as text, ingestion time, hidden bookkeeping.

    One projection (the same expressions as the ``flight_status`` /
    ``source_type`` / ``epoch_to_text`` steps), so the plan is built and analysed once."""
    kw = dict(inactive_s=inactive_s, expired_s=expired_s)
    exprs = {
        "time_position": tfn.epoch_to_text("time_position", tz),
        "last_contact": tfn.epoch_to_text("last_contact", tz),
        "status": st.status(as_of, airborne_label=airborne_label, **kw),
        "status_reason": st.status_reason(as_of, **kw),
        "source_type": st.source_type(),
        "ingestion_time": tfn.ntz_literal(as_of),
        S.LAST_CONTACT_EPOCH: F.col("last_contact"),
        S.RUN_COL: F.col(run_col) if run_col else F.lit(run_ts).cast("string"),
    }
    cols = S.SILVER_COLUMNS + (S.LAST_CONTACT_EPOCH, S.RUN_COL)
    return rows.select(*[exprs[c].alias(c) if c in exprs else F.col(c) for c in cols])


def _clean(states: DataFrame, run_col: str | None, drop_blank_country: bool) -> DataFrame:
    cols = list(S.STATE_COLUMNS) + ([run_col] if run_col else [])
    return clean_rows(states, drop_blank_country=drop_blank_country).select(*cols)


def silver(
    states: DataFrame,
    as_of: int | Column,
    *,
    run_col: str | None = None,
    run_ts: str | None = None,
    drop_blank_country: bool = False,
    **derive_kw,
) -> DataFrame:
    """Decoded states -> Silver rows (one per (icao24, last_contact), per run).

    clean rows (complete + in range) -> dedup -> status / reason / source type
    at ``as_of`` -> epoch columns as text -> ingestion time. ``as_of`` is fixed
    per run (a literal, or a per-row Column such as the run stamp's epoch when
    several runs are processed together with ``run_col``). Output: the 21
    Silver columns + hidden ``_last_contact_s`` and ``_run_ts``.
    """
    clean = _clean(states, run_col, drop_blank_country)
    d = dedup_states(clean, run_col=run_col)
    return derive_silver(d, as_of, run_col=run_col, run_ts=run_ts, **derive_kw)


def silver_latest(
    states: DataFrame,
    as_of: int | Column,
    *,
    run_col: str | None = None,
    run_ts: str | None = None,
    drop_blank_country: bool = False,
    **derive_kw,
) -> DataFrame:
    """One Silver row per aircraft: equal to ``latest_per_aircraft(silver(...))``.

    The latest order (run, last_contact, time_position, callsign, rest) refines
    the dedup order, so the dedup winner of the newest group is the latest row
    and the dedup shuffle can be skipped: one aggregate whose map side already
    emits at most one row per aircraft per task, instead of shuffling every
    (mostly unique) row at full width first."""
    clean = _clean(states, run_col, drop_blank_country)
    order = ([run_col] if run_col else []) + ["last_contact", "time_position", "callsign"]
    latest = pick_winner(clean, ["icao24"], order)
    return derive_silver(latest, as_of, run_col=run_col, run_ts=run_ts, **derive_kw)


def visible(df: DataFrame, columns=S.SILVER_COLUMNS) -> DataFrame:
    """Drop the hidden bookkeeping columns."""
    return df.select(*columns)


def gold(
    silver_df: DataFrame,
    *,
    restatus_as_of: int | None = None,
    inactive_s: int = S.INACTIVE_AFTER_S,
    expired_s: int = S.EXPIRED_AFTER_S,
    airborne_label: str = S.STATUS_AIRBORNE,
) -> DataFrame:
    """Silver -> Gold: drop EXPIRED rows, keep the 16 analysis columns (with
    column comments).

    Status is frozen at ingest by default, so an aircraft that stops reporting
    keeps its last status. ``restatus_as_of`` recomputes status and reason from
    the hidden epoch column first, so such aircraft age out."""
    df = silver_df
    if restatus_as_of is not None:
        kw = dict(last_contact=S.LAST_CONTACT_EPOCH, inactive_s=inactive_s, expired_s=expired_s)
        df = df.withColumns(
            {
                "status": st.status(restatus_as_of, airborne_label=airborne_label, **kw),
                "status_reason": st.status_reason(restatus_as_of, **kw),
            }
        )
    df = df.filter(F.col("status") != S.STATUS_EXPIRED)
    return df.select(
        *[F.col(c).alias(c, metadata={"comment": S.GOLD_COMMENTS[c]}) for c in S.GOLD_COLUMNS]
    )

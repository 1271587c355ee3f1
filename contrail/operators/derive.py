"""Row-level derivations as DataFrame -> DataFrame steps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail import schema as S
from contrail.functions import status as st
from contrail.functions.time import epoch_to_text as _epoch_text


def flight_status(
    df: DataFrame,
    as_of: int | Column,
    *,
    inactive_s: int = S.INACTIVE_AFTER_S,
    expired_s: int = S.EXPIRED_AFTER_S,
    airborne_label: str = S.STATUS_AIRBORNE,
    last_contact: str = "last_contact",
) -> DataFrame:
    """Add ``status`` and ``status_reason`` relative to ``as_of`` (epoch seconds,
    a literal or a per-row column). ``last_contact`` must still be epoch seconds."""
    kw = dict(last_contact=last_contact, inactive_s=inactive_s, expired_s=expired_s)
    return df.withColumns(
        {
            "status": st.status(as_of, airborne_label=airborne_label, **kw),
            "status_reason": st.status_reason(as_of, **kw),
        }
    )


def source_type(df: DataFrame) -> DataFrame:
    return df.withColumn("source_type", st.source_type("position_source"))


def epoch_to_text(
    df: DataFrame, cols: Sequence[str] = ("time_position", "last_contact"), tz: str | None = None
) -> DataFrame:
    """Replace epoch-second columns by 'yyyy-MM-dd HH:mm:ss' text (UTC unless tz='session')."""
    return df.withColumns({c: _epoch_text(c, tz) for c in cols})

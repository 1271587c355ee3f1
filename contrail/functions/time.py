"""Zone-free epoch <-> text/timestamp expressions.

``from_unixtime`` renders in the session time zone, so the same data would give
different Silver text on differently configured clusters. These helpers work on
``timestamp_ntz`` and always render UTC wall-clock time.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Seconds for 0001-01-01 00:00:00 and 9999-12-31 23:59:59 UTC: outside this
# range an epoch has no yyyy-MM-dd rendering: decoding flags such a row as a bad
# value, and the helpers here give null rather than fail under ANSI overflow checks.
MIN_EPOCH_S = -62135596800
MAX_EPOCH_S = 253402300799


def _epoch_ntz() -> Column:
    # A SQL literal: a Python datetime would be converted through the local
    # and session time zones.
    return F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'")


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_column(v: int | Column) -> Column:
    return v if isinstance(v, Column) else F.lit(int(v)).cast("bigint")


def epoch_to_ntz(c: str | Column) -> Column:
    """bigint epoch seconds -> timestamp_ntz (UTC wall clock); out of range -> null."""
    x = _col(c)
    ok = x.between(MIN_EPOCH_S, MAX_EPOCH_S)
    return F.when(ok, F.timestamp_add("SECOND", x, _epoch_ntz()))


def epoch_to_text(c: str | Column, tz: str | None = None) -> Column:
    """bigint epoch seconds -> 'yyyy-MM-dd HH:mm:ss'.

    ``tz=None`` renders UTC regardless of the session zone. ``tz='session'``
    uses ``from_unixtime`` (session zone), for callers that want that.
    """
    if tz == "session":
        return F.from_unixtime(_col(c))
    # Casting timestamp_ntz to text is zone-free (date_format would convert
    # through the session zone and shift wall-clock times inside DST gaps).
    # Whole seconds only, so the text never carries a fraction.
    return epoch_to_ntz(c).cast("string")


def ntz_to_epoch(c: str | Column) -> Column:
    """timestamp_ntz -> bigint epoch seconds (UTC wall clock, no zone shift)."""
    return F.timestamp_diff("SECOND", _epoch_ntz(), _col(c))


def run_ts_to_epoch(c: str | Column) -> Column:
    """Run stamp 'yyyyMMdd_HHmmss' (UTC wall clock) -> epoch seconds; malformed -> null.

    Built from the digits with ``try_make_timestamp_ntz`` so no session zone
    (and no DST gap) is involved."""
    x = _col(c)
    part = lambda a, n: F.substring(x, a, n).try_cast("int")
    ntz = F.try_make_timestamp_ntz(
        part(1, 4), part(5, 2), part(7, 2), part(10, 2), part(12, 2), part(14, 2)
    )
    return F.when(x.rlike(r"^[0-9]{8}_[0-9]{6}$"), ntz_to_epoch(ntz))


def run_stamp(epoch_s: int) -> str:
    """Python-side run stamp for an epoch (UTC)."""
    return _dt.datetime.fromtimestamp(int(epoch_s), _dt.timezone.utc).strftime("%Y%m%d_%H%M%S")


def ntz_literal(epoch_s: int | Column) -> Column:
    return epoch_to_ntz(as_column(epoch_s))

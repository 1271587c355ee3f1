"""Row-level derivations: flight status, status reason, source type."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from contrail import schema as S
from contrail.functions.time import as_column


def _age(as_of: int | Column, last_contact: str | Column) -> Column:
    lc = F.col(last_contact) if isinstance(last_contact, str) else last_contact
    return as_column(as_of) - lc


def status(
    as_of: int | Column,
    *,
    last_contact: str | Column = "last_contact",
    on_ground: str = "on_ground",
    inactive_s: int = S.INACTIVE_AFTER_S,
    expired_s: int = S.EXPIRED_AFTER_S,
    airborne_label: str = S.STATUS_AIRBORNE,
) -> Column:
    """Ordered CASE: on ground -> LANDED; age > expired -> EXPIRED;
    age > inactive -> INACTIVE; else airborne. A null condition falls through,
    so null ``on_ground`` is tested on age and null ``last_contact`` is airborne."""
    age = _age(as_of, last_contact)
    return (
        F.when(F.col(on_ground) == F.lit(True), S.STATUS_LANDED)
        .when(age > expired_s, S.STATUS_EXPIRED)
        .when(age > inactive_s, S.STATUS_INACTIVE)
        .otherwise(airborne_label)
    )


def status_reason(
    as_of: int | Column,
    *,
    last_contact: str | Column = "last_contact",
    on_ground: str = "on_ground",
    inactive_s: int = S.INACTIVE_AFTER_S,
    expired_s: int = S.EXPIRED_AFTER_S,
) -> Column:
    age = _age(as_of, last_contact)
    return (
        F.when(F.col(on_ground) == F.lit(True), S.REASON_ON_GROUND)
        .when(age > expired_s, S.REASON_EXPIRED)
        .when(age > inactive_s, S.REASON_INACTIVE)
        .otherwise(S.REASON_IN_AIR)
    )


def source_type(position_source: str | Column = "position_source") -> Column:
    ps = F.col(position_source) if isinstance(position_source, str) else position_source
    expr = None
    for code, label in S.SOURCE_TYPES:
        expr = F.when(ps == code, label) if expr is None else expr.when(ps == code, label)
    return expr.otherwise(S.SOURCE_UNKNOWN)

"""Plans: the Silver/Gold transforms, runnable jobs and the query surface."""

from contrail.plans.ask import (  # noqa: F401
    GOLD_VIEW,
    UnsafeQueryError,
    adsb_share,
    airborne,
    check_statement,
    climb_descend,
    gold_sql,
    inactive_flights,
    register_gold,
    sql_audit,
    top_countries,
)
from contrail.plans.layers import derive_silver, gold, silver, silver_latest, visible  # noqa: F401

"""Operators: DataFrame -> DataFrame steps of the Silver/Gold jobs."""

from contrail.operators.dedup import dedup_states, latest_per_aircraft, pick_winner  # noqa: F401
from contrail.operators.derive import (  # noqa: F401
    epoch_to_text,
    flight_status,
    source_type,
)
from contrail.operators.quality import (  # noqa: F401
    check_count,
    clean_rows,
    complete_rows,
    gate_report,
    invalid_geo,
    null_records,
    quarantine_rows,
    valid_geo,
)
from contrail.operators.upsert import upsert  # noqa: F401

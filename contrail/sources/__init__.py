"""Sources: Bronze landing/decoding and the fixture view over the test tables."""

from contrail.sources.bronze import (  # noqa: F401
    DataQualityError,
    decode_states,
    envelope_states,
    land_snapshots,
    landed_counts,
    latest_run,
    read_states,
    to_envelopes,
    to_state_lines,
    write_array_snapshots,
)
from contrail.sources.fixture import state_vectors  # noqa: F401

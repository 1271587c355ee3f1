"""Sinks: versioned table store with a manifest commit log, quarantine writer."""

from contrail.sinks.store import (  # noqa: F401
    Commit,
    CommitConflict,
    TableStore,
    read_quarantine,
    read_silver,
    run_config,
    run_ledger,
    with_country_part,
    write_quarantine,
)

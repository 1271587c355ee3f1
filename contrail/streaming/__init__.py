"""Structured Streaming: incremental Silver over newly landed Bronze files."""

from contrail.streaming.incremental import bronze_stream, process_batch, run_incremental  # noqa: F401

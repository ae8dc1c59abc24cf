"""Incremental forms: file streams, checkpointed appends, windowed counts."""

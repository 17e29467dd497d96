"""Structured Streaming: landing ingest, the incremental silver chain and a
change-log consumer."""

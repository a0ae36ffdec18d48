"""Structured Streaming jobs."""

from ledgerlake.streaming.ingest import compact, current_table, incremental_ingest
from ledgerlake.streaming.upsert import newest_versions, upsert_stream, upserted

__all__ = ["compact", "current_table", "incremental_ingest", "newest_versions", "upsert_stream", "upserted"]

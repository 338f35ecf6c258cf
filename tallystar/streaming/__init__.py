"""Incremental yearly refresh (K3) on Structured Streaming."""

from tallystar.streaming.refresh import refresh_years, start_refresh  # noqa: F401

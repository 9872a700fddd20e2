"""Incremental refresh.  The source system has no streams; this package only
re-runs the batch outputs when new source files land."""

from stockpulse.streaming.refresh import start_refresh

__all__ = ["start_refresh"]

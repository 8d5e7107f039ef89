"""Structured Streaming entry points."""

from panelkit.streaming.daily import daily_stream, run_daily_window

__all__ = ["daily_stream", "run_daily_window"]

"""Hourly fact files: one scan over all slots, and a stream that triggers scans."""

from ordergate.streaming.scan import run_once
from ordergate.streaming.watch import watch

__all__ = ["run_once", "watch"]

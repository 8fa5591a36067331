"""Streaming re-sync: export files landing in a folder keep a target table current."""

from tablesmith.streaming.landing import landing_sync

__all__ = ["landing_sync"]

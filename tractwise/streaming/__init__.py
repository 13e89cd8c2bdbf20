"""Incremental form of the append step."""

from tractwise.streaming.scenarios import append_scenarios

__all__ = ["append_scenarios"]

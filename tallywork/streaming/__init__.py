"""Streaming forms of sessions and of the daily summary."""

from tallywork.streaming.sessions import stream_sessions
from tallywork.streaming.summary import CellTable, stream_cells

__all__ = ["CellTable", "stream_cells", "stream_sessions"]

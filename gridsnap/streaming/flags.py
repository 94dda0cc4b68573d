"""Play flags on a stream: captures and event flags need one row each, so they run unchanged on a streaming frame."""

from __future__ import annotations

from pyspark.sql import DataFrame

from gridsnap.functions.plays import add_events, extract_players


def play_flags(plays: DataFrame) -> DataFrame:
    """Rows (summary, action_title, down, down_desc, ...) with the captures and event flags; batch or stream, no state."""
    return add_events(extract_players(plays))

"""Sessions of a stream of events."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywork.fixed_values import SESSION_GAP_MINUTES
from tallywork.functions import any_names, half_up, minutes


@any_names
def stream_sessions(
    events: DataFrame,
    *,
    gap_minutes: int = SESSION_GAP_MINUTES,
    goal: str = "purchase",
    late_minutes: int = 60,
) -> DataFrame:
    """The sessions of every known user in a stream, each as soon as it can't grow any more.

    Those of ``sessionize`` but for their number, which would need all sessions before. A session is
    kept as state until the watermark, the newest event time less ``late_minutes``, is past its end
    and the gap; then it is sent once and forgotten. A row that comes later than that is left out.
    Rows in time can join two sessions. Use the append mode. A batch frame gives all its sessions.
    """
    at = F.col("event_at").cast("timestamp")
    rows = events.filter(F.col("user_id").isNotNull()).select("user_id", at.alias("event_at"), "event_type")
    rows = rows.withWatermark("event_at", f"{late_minutes} minutes")
    window = F.session_window("event_at", f"{gap_minutes} minutes")
    first, last = F.min("event_at"), F.max("event_at")
    sessions = rows.groupBy("user_id", window).agg(
        F.count(F.lit(1)).alias("events_in_session"),
        first.alias("session_start"),
        last.alias("session_end"),
        half_up(minutes(F.timestamp_diff("MICROSECOND", first, last)), 1).alias("duration_min"),
        F.bool_or(F.col("event_type") == goal).alias("converted"),
    )
    return sessions.drop("session_window")

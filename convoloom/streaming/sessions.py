"""Session operators over streams of events (user_id, event_type, ts, value)."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def with_event_time(events: DataFrame, ts: str = "ts", late: str = "10 minutes") -> DataFrame:
    """Event time as an instant (UTC session) with a watermark; a timestamp without zone takes none."""
    return events.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late)


def windowed_usage(events: DataFrame, size: str = "1 hour", slide: str | None = None) -> DataFrame:
    """Executions and mean value of each tool in tumbling or sliding windows."""
    w = F.window("ts", size, slide) if slide else F.window("ts", size)
    return with_event_time(events).groupBy(w.alias("w"), "event_type").agg(F.count("*").alias("n"), F.avg("value").alias("avg_value")).select(F.col("w.start").alias("start"), "event_type", "n", "avg_value")


def session_windows(events: DataFrame, gap: str = "30 minutes") -> DataFrame:
    """Sessions of each user: a gap without events closes one."""
    return with_event_time(events).groupBy("user_id", F.session_window("ts", gap).alias("w")).agg(F.count("*").alias("n")).select("user_id", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def distinct_events(events: DataFrame, key: str = "event_id") -> DataFrame:
    """Each event once within the watermark."""
    return with_event_time(events).dropDuplicatesWithinWatermark([key])


def turn_counts(events: DataFrame, max_turns: int = 20) -> DataFrame:
    """T2, T4 on a stream: running turns of each user and whether the limit has been reached."""

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        n = (state.get[0] if state.exists else 0) + sum(len(b) for b in batches)
        state.update((n,))
        yield pd.DataFrame({"user_id": [key[0]], "turns": [n], "ended": [n >= max_turns]})

    return events.groupBy("user_id").applyInPandasWithState(step, "user_id long, turns long, ended boolean", "turns long", "update", GroupStateTimeout.NoTimeout)

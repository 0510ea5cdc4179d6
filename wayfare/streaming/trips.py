"""Trips of an arrival stream, as they end (beside the batch operators).

The batch query numbers trips by window functions; here the same numbers come
from state per (service date, vehicle, pattern) as rows arrive.  Rows may be
late up to the watermark; the batch result is the reference for rows that
arrive in order within a trigger.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

OUT = "service_date string, vehicle_id long, pattern_id string, arr_ts timestamp_ntz, master_seq int, trip_no int"
STATE = "last int, trip_no int"


def number_trips(key: tuple, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Rows of one vehicle and pattern with their trip number; a stop number that does not rise starts a trip."""
    last, trip = state.get if state.exists else (None, 1)
    rows = pd.concat(list(chunks)).sort_values(["arr_ts", "master_seq"])
    numbers = []
    for seq in rows["master_seq"]:
        if last is not None and seq <= last:
            trip += 1
        last = int(seq)
        numbers.append(trip)
    state.update((last, trip))
    yield rows.assign(trip_no=numbers)[["service_date", "vehicle_id", "pattern_id", "arr_ts", "master_seq", "trip_no"]]


def stream(events: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Streaming events (service_date string, vehicle_id, pattern_id, arr_ts, master_seq) with trip_no."""
    marked = events.withColumn("event_time", events["arr_ts"].cast("timestamp")).withWatermark("event_time", delay)
    keyed = marked.groupBy("service_date", "vehicle_id", "pattern_id")
    return keyed.applyInPandasWithState(number_trips, OUT, STATE, "append", GroupStateTimeout.NoTimeout)

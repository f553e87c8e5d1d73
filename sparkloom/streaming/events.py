"""The queue and its events as streams: replay removal, windows with watermarks, leases with timers."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from sparkloom.registry import Tables, query


def read_events(spark: SparkSession, path: str, schema: str, *, files: int = 100) -> DataFrame:
    """A stream over the files of a folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)


def without_replays(events: DataFrame, *keys: str, time: str = "ts", late: str = "1 hour") -> DataFrame:
    """Events whose keys come again within ``late`` are dropped; state older than that goes."""
    return events.withWatermark(time, late).dropDuplicatesWithinWatermark(list(keys))


def windowed_counts(events: DataFrame, kind: str, *, time: str = "ts", length: str = "1 day", late: str = "1 hour") -> DataFrame:
    return events.withWatermark(time, late).groupBy(F.window(time, length), F.col(kind)).agg(F.count("*").alias("n"), F.sum("value").alias("total"))


LEASE_OUT = "key long, claims long, open boolean"
LEASE_STATE = "claims long, until timestamp"


def lease_states(events: DataFrame, key: str, *, time: str = "ts", minutes: int = 30) -> DataFrame:
    """Each key's number of claims and whether its lease is open; event time expires a lease."""

    def step(k: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            claims = state.get[0]
            state.remove()
            yield pd.DataFrame({"key": [k[0]], "claims": [claims], "open": [False]})
            return
        claims, until = state.get if state.exists else (0, pd.Timestamp(0))
        for frame in frames:
            for at in sorted(frame[time]):
                if at > until:
                    claims += 1
                until = max(until, at + pd.Timedelta(minutes=minutes))
        state.update((claims, until))
        state.setTimeoutTimestamp(max(int(until.timestamp() * 1000), state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame({"key": [k[0]], "claims": [claims], "open": [True]})

    return events.withWatermark(time, "1 hour").groupBy(key).applyInPandasWithState(step, LEASE_OUT, LEASE_STATE, "update", GroupStateTimeout.EventTimeTimeout)


@query("t01_event_windows", "SELECT CAST(epoch_us(ts) // 86400000000 AS BIGINT) AS day, event_type, COUNT(*) AS n FROM events GROUP BY 1, 2")
def event_windows(t: Tables) -> DataFrame:
    """The batch form of :func:`windowed_counts`; the same function serves the stream."""
    e = t.events.withColumn("ts", F.col("ts").cast("timestamp"))
    w = e.groupBy(F.window("ts", "1 day"), "event_type").agg(F.count("*").alias("n"))
    return w.select((F.unix_micros("window.start") / 86_400_000_000).cast("long").alias("day"), "event_type", "n")

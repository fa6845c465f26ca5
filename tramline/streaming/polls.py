"""Polls as they come: windows, repeats, back-off, in batch and as streams."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

WINDOW_S, HOUR_S, BASE_S, MOST_S, QUARANTINE_S, STRIKES = 300, 3600, 15, 600, 3600, 5


def changed(polls: DataFrame) -> DataFrame:
    """R2: polls whose digest differs from the one stored before; A, B, A keeps all three."""
    order = W.partitionBy("feed").orderBy("ts", "ord")
    return polls.withColumn("__b", F.lag("digest").over(order)).filter("__b is null or __b <> digest").drop("__b")


def changed_stream(polls: DataFrame) -> DataFrame:
    """R2 on a stream of (feed, ts, ord, digest): the state of a feed is its last digest."""

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last = state.get[0] if state.exists else None
        rows = pd.concat(list(batches)).sort_values(["ts", "ord"])
        keep = rows["digest"] != rows["digest"].shift(fill_value=last)
        if len(rows):
            state.update((rows["digest"].iloc[-1],))
        yield rows[keep]

    return polls.groupBy("feed").applyInPandasWithState(step, polls.schema, "digest string", "append", GroupStateTimeout.NoTimeout)


def windowed(polls: DataFrame, seconds: int = WINDOW_S) -> DataFrame:
    """One frame for each feed, window and digest, with its first poll."""
    rows = polls.withColumn("window_start", (F.floor(F.col("ts") / seconds) * seconds).cast("long"))
    return rows.groupBy("feed", "window_start", "digest").agg(F.min("ts").alias("first_ts"), F.count(F.lit(1)).alias("polls"))


def windowed_stream(polls: DataFrame, seconds: int = WINDOW_S, late: str = "5 minutes") -> DataFrame:
    """R3, R4 on a stream with an event time `at`: a window closes once the watermark has passed it."""
    w = F.window("at", f"{seconds} seconds")
    rows = polls.withWatermark("at", late).groupBy("feed", w.alias("w"), "digest").agg(F.count(F.lit(1)).alias("polls"), F.min("at").alias("first_at"))
    return rows.select("feed", F.col("w.start").alias("window_start"), "digest", "first_at", "polls")


def hourly(frames: DataFrame) -> DataFrame:
    """Frames of an hour."""
    return frames.groupBy("feed", (F.floor(F.col("first_ts") / HOUR_S) * HOUR_S).cast("long").alias("hour")).agg(F.count(F.lit(1)).alias("frames"))


def backoff(polls: DataFrame) -> DataFrame:
    """Failures in a row and the wait that follows. polls: (feed, ts, ord, ok)."""
    order = W.partitionBy("feed").orderBy("ts", "ord").rowsBetween(W.unboundedPreceding, 0)
    rows = polls.withColumn("__r", F.sum(F.col("ok").cast("int")).over(order))
    streak = F.sum((~F.col("ok")).cast("int")).over(W.partitionBy("feed", "__r").orderBy("ts", "ord").rowsBetween(W.unboundedPreceding, 0))
    rows = rows.withColumn("failures", streak).drop("__r")
    wait = F.when(F.col("failures") == 0, BASE_S).when(F.col("failures") >= STRIKES, QUARANTINE_S).otherwise(
        F.least(F.lit(MOST_S), (F.lit(BASE_S) * F.pow(F.lit(2), F.col("failures") - 1)).cast("int"))
    )
    return rows.withColumn("wait_s", wait.cast("int"))


def latest_stream(updates: DataFrame, keys: list[str], version: str) -> DataFrame:
    """R8 on a stream, for update or complete mode: the newest row of each key."""
    rest = [c for c in updates.columns if c not in keys]
    return updates.groupBy(*keys).agg(F.max_by(F.struct(*rest), version).alias("__v")).select(*keys, "__v.*")


def dwell_stream(pings: DataFrame) -> DataFrame:
    """R7 on a stream of (vehicle, ts, ord, stop_id, status): visits by status, as they close.

    The state of a vehicle is its open run. Pings must come in order of time within a vehicle; late ones are dropped.
    """

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        stop, first, last, n, seen = state.get if state.exists else (None, 0, 0, 0, -1)
        out = []
        for r in pd.concat(list(batches)).sort_values(["ts", "ord"]).itertuples():
            if r.ts < seen:
                continue
            seen = r.ts
            here = r.stop_id if r.status == "STOPPED_AT" else None
            if stop is not None and here != stop:
                out.append((key[0], stop, first, last, n))
                stop = None
            if here is not None:
                stop, first, n = (stop, first, n + 1) if stop is not None else (here, r.ts, 1)
                last = r.ts
        state.update((stop, int(first), int(last), int(n), int(seen)))
        yield pd.DataFrame(out, columns=["vehicle", "stop_id", "arrival_ts", "departure_ts", "ping_count"])

    schema = "vehicle string, stop_id string, arrival_ts long, departure_ts long, ping_count long"
    return pings.groupBy("vehicle").applyInPandasWithState(step, schema, "stop string, first long, last long, n long, seen long", "append", GroupStateTimeout.NoTimeout)

"""Windowed counts that run alike on tables and on streams."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def tumbling(events: DataFrame, width: str = "1 hour", time: str = "ts", late: str | None = None) -> DataFrame:
    """(w, n): start of each window and its events. `late`: how long a stream waits; the time is cast for its watermark."""
    at = F.col(time).cast("timestamp")
    rows = events.select(at.alias("__wq_t"))
    if late:
        rows = rows.withWatermark("__wq_t", late)
    return rows.groupBy(F.window("__wq_t", width)).agg(F.count(F.lit(1)).alias("n")).select(F.col("window.start").cast("timestamp_ntz").alias("w"), "n")


def sliding(events: DataFrame, width: str, slide: str, time: str = "ts", late: str | None = None) -> DataFrame:
    """(w, n): start of each of the overlapping windows, `slide` apart, and its events; rows without a time are left out."""
    rows = events.select(F.col(time).cast("timestamp").alias("__wq_t"))
    if late:
        rows = rows.withWatermark("__wq_t", late)
    out = rows.groupBy(F.window("__wq_t", width, slide)).agg(F.count(F.lit(1)).alias("n"))
    return out.select(F.col("window.start").cast("timestamp_ntz").alias("w"), "n")


def sessions(events: DataFrame, gap: str, by: str, time: str = "ts", late: str | None = None) -> DataFrame:
    """(by, w, e, n): sessions of a key, parted where nothing came for `gap`; e: the last event's time plus the gap."""
    rows = events.select(F.col(by), F.col(time).cast("timestamp").alias("__wq_t"))
    if late:
        rows = rows.withWatermark("__wq_t", late)
    out = rows.groupBy(F.session_window("__wq_t", gap), F.col(by)).agg(F.count(F.lit(1)).alias("n"))
    return out.select(by, F.col("session_window.start").cast("timestamp_ntz").alias("w"), F.col("session_window.end").cast("timestamp_ntz").alias("e"), "n")


def running(events: DataFrame, by: str) -> DataFrame:
    """(by, n) after each batch of a stream: how many events the key has had so far, kept as state. Null keys are a key."""

    def step(key, frames, state):
        n = (state.get[0] if state.exists else 0) + sum(len(f) for f in frames)
        state.update((n,))
        yield pd.DataFrame({by: [key[0]], "n": [n]})

    kind = events.schema[by].dataType.simpleString()
    return events.select(by).groupBy(by).applyInPandasWithState(step, f"{by} {kind}, n long", "n long", "update", "NoTimeout")

"""Streaming forms, an addition to the batch operators: change detection and windowed counts over observations."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def deduplicated(observations: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Without observations that repeat an id inside the watermark; state is dropped behind it."""
    return observations.withWatermark("observed_at", delay).dropDuplicatesWithinWatermark(["observation_id"])


def windowed(observations: DataFrame, width: str = "1 hour", delay: str = "10 minutes") -> DataFrame:
    """Observations per field and window; rows later than ``delay`` are left out."""
    rows = observations.withWatermark("observed_at", delay).groupBy(F.window("observed_at", width), "field").agg(F.count("*").alias("n"))
    return rows.select(F.col("window.start").alias("window_start"), "field", "n")


def changed_values(observations: DataFrame) -> DataFrame:
    """A row whenever the value of an (entity, field) differs from the one before it; state is one value per key."""
    def step(key: tuple, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        last = state.get[0] if state.exists else None
        known, out = state.exists, []
        rows = pd.concat(list(frames)).sort_values(["observed_at", "observation_id"])
        for value, at in zip(rows["value"], rows["observed_at"], strict=True):
            value = None if pd.isna(value) else value
            if known and value != last:
                out.append((key[0], key[1], last, value, at))
            last, known = value, True
        state.update((last,))
        if out:
            yield pd.DataFrame(out, columns=["entity_id", "field", "old_value", "new_value", "observed_at"])

    return observations.groupBy("entity_id", "field").applyInPandasWithState(step, "entity_id bigint, field string, old_value string, new_value string, observed_at timestamp", "value string", "update", "NoTimeout")


def ordered_changes(observations: DataFrame, delay: str = "1 hour", keep: float | None = None) -> DataFrame:
    """A row whenever the value of an (entity, field) differs from the one before it in time, in whatever order rows arrive within ``delay``.

    Rows wait in the state until the watermark is past them and are then compared by (observed_at, observation_id); what comes behind the watermark
    is left out and counted by Spark (``numRowsDroppedByWatermark``), as are rows without a time. A value is forgotten when its key has had none for
    ``keep`` seconds: the next one is a first one. The state is one value a key and the rows of the last ``delay``. Mode: append.
    """
    gap = None if keep is None else int(keep * 1_000_000)

    def step(key: tuple, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        last, last_at, waiting = None, None, []
        if state.exists:
            last, last_at, *columns = state.get
            waiting = list(zip(*columns, strict=True))
        if not state.hasTimedOut:
            for rows in frames:
                waiting += [(int(at), int(i), None if pd.isna(v) else v) for at, i, v in zip(rows["observed_at"].astype("datetime64[us]").astype("int64"), rows["observation_id"], rows["value"], strict=True)]
        passed = state.getCurrentWatermarkMs() * 1000
        waiting.sort(key=lambda r: (r[0], r[1], r[2] is not None, r[2] or ""))
        ready, out = [r for r in waiting if r[0] <= passed], []
        waiting = waiting[len(ready):]
        for at, _, value in ready:
            first = last_at is None or (gap is not None and at - last_at > gap)
            if not first and value != last:
                out.append((key[0], key[1], last, value, pd.Timestamp(at, unit="us")))
            last, last_at = value, at
        if not waiting and (last_at is None or (gap is not None and passed - last_at > gap)):
            state.remove()
        else:
            state.update((last, last_at, *([r[k] for r in waiting] for k in range(3))))
            due = waiting[0][0] if waiting else None if gap is None else last_at + gap
            if due is not None:
                state.setTimeoutTimestamp(max(due, passed) // 1000 + 1)
        if out:
            yield pd.DataFrame(out, columns=["entity_id", "field", "old_value", "new_value", "observed_at"])

    kept = "value string, at bigint, waiting_at array<bigint>, waiting_id array<bigint>, waiting_value array<string>"
    rows = observations.filter("observed_at is not null").withWatermark("observed_at", delay).groupBy("entity_id", "field")
    return rows.applyInPandasWithState(step, "entity_id bigint, field string, old_value string, new_value string, observed_at timestamp", kept, "append", "EventTimeTimeout")

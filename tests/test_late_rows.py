"""Changes found in a stream whose rows come out of order, against a plain version over the sorted rows."""

import os
import random

import pandas as pd
import pytest

from quillstone.streaming import changes

SCHEMA = "entity_id bigint, field string, value string, observed_at timestamp, observation_id bigint"


def plain(rows, keep=None):
    last, out = {}, []
    for e, f, v, at, i in sorted(rows, key=lambda r: (r[3], r[4])):
        before = last.get((e, f))
        if before and (keep is None or at - before[1] <= keep) and before[0] != v:
            out.append((e, f, before[0], v, at))
        last[e, f] = (v, at)
    return sorted(out, key=str)


def streamed(spark, folder, batches, make, name):
    for k, rows in enumerate(batches):
        path = folder / f"{k:03}.parquet"
        frame = pd.DataFrame(rows, columns=["entity_id", "field", "value", "at", "observation_id"])
        frame.insert(3, "observed_at", pd.to_datetime(frame.pop("at"), unit="s").astype("datetime64[us]").dt.tz_localize("UTC"))
        frame.astype({"entity_id": "int64", "observation_id": "int64"}).to_parquet(path, index=False)
        os.utime(path, (1_600_000_000 + k, 1_600_000_000 + k))
    q = make(spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(folder))).writeStream.format("memory").queryName(name).outputMode("append").start()
    try:
        q.processAllAvailable()
        dropped = sum(o["numRowsDroppedByWatermark"] for p in q.recentProgress for o in p["stateOperators"])
        got = [(r["entity_id"], r["field"], r["old_value"], r["new_value"], int(r["observed_at"].timestamp())) for r in spark.table(name).collect()]
        return sorted(got, key=str), dropped
    finally:
        q.stop()


def disordered(seed, n=150):
    """Rows moved from their place by less than the delay of 100 seconds, nulls and ties in time among them, then one far ahead that closes the rest."""
    rng = random.Random(seed)
    rows = [(rng.randrange(4), rng.choice(["status", "city"]), rng.choice(["a", "b", None]), 1000 + 5 * k - rng.choice([0, 0, 5]), k) for k in range(n)]
    mixed = sorted(rows, key=lambda r: r[3] + rng.random() * 80)
    batches = [mixed[k:k + 30] for k in range(0, n, 30)]
    return rows, [*batches, [(99, "end", "x", 100_000, n)], [(99, "end", "x", 100_001, n + 1)]]


@pytest.mark.parametrize("keep", [None, 60])
def test_disorder_within_the_delay_changes_nothing(spark, tmp_path, keep):
    rows, batches = disordered(7)
    assert plain([r for b in batches for r in b], keep) == plain(rows, keep) != []
    got, dropped = streamed(spark, tmp_path, batches, lambda s: changes.ordered_changes(s, "100 seconds", keep), f"late_{keep}")
    assert dropped == 0 and got == plain(rows, keep)


def test_rows_behind_the_watermark_are_counted(spark, tmp_path):
    batches = [[(1, "status", "a", 1000, 1), (1, "status", "b", 2000, 2)], [(1, "status", "b", 3000, 3)], [(1, "status", "z", 1500, 4)], [(9, "end", "x", 100_000, 5)], [(9, "end", "x", 100_001, 6)]]
    got, dropped = streamed(spark, tmp_path, batches, lambda s: changes.ordered_changes(s, "100 seconds"), "late_dropped")
    assert got == [(1, "status", "a", "b", 2000)] and dropped == 1

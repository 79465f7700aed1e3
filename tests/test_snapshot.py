"""Observations in buckets: batches in any order, killed ones, files that stay."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from quillstone.operators.history import with_current
from quillstone.operators.snapshot import Observations
from quillstone.operators.store import hadoop_path

SCHEMA = "entity_id long, field string, value string, observed_at timestamp, observation_id long"


def batch(spark, rows):
    return spark.createDataFrame(rows, "entity_id long, field string, value string, at long, observation_id long").select("entity_id", "field", "value", F.timestamp_seconds("at").alias("observed_at"), "observation_id")


def made(seed, n, entities):
    rng = random.Random(seed)
    return [(rng.choice([*range(entities), None]), rng.choice(["status", "city", None]), rng.choice(["a", "b", None]), rng.choice([None, *range(20)]), rng.randrange(6)) for _ in range(n)]


def store(spark, path, buckets=8):
    return Observations(spark, str(path), batch(spark, []).schema, buckets)


def rows(df):
    return sorted((tuple(map(str, r)) for r in df.select("entity_id", "field", "value", "observed_at", "observation_id", "is_current").collect()))


def files(spark, path):
    fs, p = hadoop_path(spark, str(path))
    found = fs.listFiles(p, True)
    out = {}
    while found.hasNext():
        f = found.next()
        out[f.getPath().toString()] = f.getModificationTime()
    return {k: v for k, v in out.items() if k.endswith(".parquet") and "/rows/" in k}


@pytest.mark.parametrize("order", list(itertools.permutations(range(3)))[:4])
def test_any_order_of_batches(spark, tmp_path, order):
    """Nulls, ties in time and id, repeated rows and late rows: the same as all at once."""
    parts = [made(1, 60, 9), made(2, 40, 9), made(3, 5, 2)]
    kept = store(spark, tmp_path)
    for k in order:
        kept.append(str(k), batch(spark, parts[k]))
    want = with_current(batch(spark, sum(parts, [])))
    assert rows(kept.history()) == rows(want)
    assert rows(kept.current().withColumn("is_current", F.lit(True))) == rows(want.filter("is_current"))


def test_untouched_buckets_keep_their_files(spark, tmp_path):
    kept = store(spark, tmp_path, 16)
    first = kept.append("1", batch(spark, [(e, "status", "a", 1, e) for e in range(100)]))
    before = files(spark, tmp_path)
    assert len(first) == 16
    touched = kept.append("2", batch(spark, [(7, "status", "b", 2, 200)]))
    after = files(spark, tmp_path)
    assert len(touched) == 1 and {k: after[k] for k in before} == before
    new = set(after) - set(before)
    assert new and all(f"bucket={touched[0]}/" in k for k in new)
    assert kept.current().filter("entity_id = 7").first()["value"] == "b" and kept.current().count() == 100
    assert kept.history().filter("not is_current").count() == 1
    assert kept.vacuum() == 1 and kept.current().count() == 100 and kept.history().count() == 101


def test_a_batch_is_taken_once(spark, tmp_path):
    kept = store(spark, tmp_path)
    touched = kept.append("1", batch(spark, made(4, 30, 5)))
    again = rows(kept.history())
    assert kept.append("1", batch(spark, made(4, 30, 5))) == touched and rows(kept.history()) == again


def test_killed_before_the_commit(spark, tmp_path):
    class Killed(BaseException):
        pass

    kept = store(spark, tmp_path)
    kept.append("1", batch(spark, made(5, 30, 5)))
    before = rows(kept.history())
    other = store(spark, tmp_path)

    def stop(*_):
        raise Killed

    other._commit = stop
    with pytest.raises(Killed):
        other.append("2", batch(spark, made(6, 30, 5)))
    assert rows(kept.history()) == before
    assert kept.vacuum() >= 1 and rows(kept.history()) == before
    kept.append("2", batch(spark, made(6, 30, 5)))
    assert rows(kept.history()) == rows(with_current(batch(spark, made(5, 30, 5) + made(6, 30, 5))))


def test_empty(spark, tmp_path):
    kept = store(spark, tmp_path)
    assert kept.history().count() == 0 and kept.current().count() == 0 and kept.vacuum() == 0
    assert kept.append("0", batch(spark, [])) == [] and kept.history().count() == 0
    kept.append("1", batch(spark, [(1, "status", "a", 1, 1)]))
    assert kept.append("2", batch(spark, [])) == [] and kept.current().count() == 1

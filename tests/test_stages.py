"""Runs that stop and are taken up again."""

import pytest
from pyspark.sql import functions as F

from quillstone.operators import stages
from quillstone.operators.store import hadoop_path
from quillstone.plans.landing import landing


class Killed(BaseException):
    """Ends a stage as a lost driver would: nothing of the run's own code runs after it."""


def simple(spark, log, trouble=lambda name: None):
    """Three stages that count what they read, each with two tables."""
    def stage(name):
        def make(before):
            log.append(name)
            trouble(name)
            seen = sum(rows.count() for rows in before.values())
            return {"main": spark.range(seen + 1), "side": spark.range(2).withColumn("stage", F.lit(name))}

        return name, make

    return [stage(n) for n in ("one", "two", "three")]


def folders(spark, path):
    fs, p = hadoop_path(spark, path)
    return sorted(f.getPath().getName() for f in fs.listStatus(p)) if fs.exists(p) else []


def rows_of(run):
    return {f"{s}.{name}": sorted(map(tuple, rows.collect())) for s in ("one", "two", "three") for name, rows in run.tables(s).items()}


def test_undisturbed(spark, tmp_path):
    log = []
    run = stages.Run(spark, str(tmp_path), "r", simple(spark, log))
    assert run.run() == "COMPLETED" and log == ["one", "two", "three"]
    assert run.run() == "COMPLETED" and log == ["one", "two", "three"]  # all is committed
    assert {r["stage"]: (r["state"], r["attempts"], r["tables"]) for r in run.states().collect()} == {"one": ("COMPLETED", 1, {"main": 1, "side": 2}), "two": ("COMPLETED", 1, {"main": 4, "side": 2}), "three": ("COMPLETED", 1, {"main": 10, "side": 2})}


@pytest.mark.parametrize("stage", ["one", "two", "three"])
def test_kill_and_resume(spark, tmp_path, stage):
    whole = stages.Run(spark, str(tmp_path), "whole", simple(spark, []))
    whole.run()
    log, alive = [], [True]

    def trouble(name):
        if name == stage and alive[0]:
            raise Killed

    run = stages.Run(spark, str(tmp_path), "r", simple(spark, log, trouble))
    with pytest.raises(Killed):
        run.run()
    with pytest.raises(LookupError):
        run.tables(stage)
    alive[0] = False
    later = stages.Run(spark, str(tmp_path), "r", simple(spark, log, trouble))  # another driver
    assert later.run() == "COMPLETED" and rows_of(later) == rows_of(whole)
    assert log.count(stage) == 2 and all(log.count(n) == 1 for n in {"one", "two", "three"} - {stage})
    assert {r["stage"]: r["attempts"] for r in later.states().collect()}[stage] == 2 and len(folders(spark, f"{tmp_path}/r/{stage}")) == 1


def test_killed_while_writing(spark, tmp_path):
    """What a killed attempt has written is not read, and goes when its stage runs again."""
    def half(before):
        return {"main": spark.range(5), "side": spark.range(3).select(F.when(F.col("id") == 1, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).alias("id"))}

    first = simple(spark, [])
    run = stages.Run(spark, str(tmp_path), "r", [first[0], ("two", half), first[2]], waits=())
    with pytest.raises(Exception, match="lost"):
        run.run()
    assert len(folders(spark, f"{tmp_path}/r/two")) == 1 and {r["stage"]: r["state"] for r in run.states().collect()} == {"one": "COMPLETED", "two": "FAILED"}
    assert run.ledger().filter("stage = '' and state = 'FAILED'").count() == 1
    later = stages.Run(spark, str(tmp_path), "r", simple(spark, []))
    assert later.run() == "COMPLETED" and later.tables("two")["main"].count() == 4 and len(folders(spark, f"{tmp_path}/r/two")) == 1


def test_waits_between_attempts(spark, tmp_path):
    log, left, slept = [], [3], []

    def trouble(name):
        if name == "two" and left[0]:
            left[0] -= 1
            raise OSError("not now")

    run = stages.Run(spark, str(tmp_path), "r", simple(spark, log, trouble), waits=(1, 5, 30), sleep=slept.append)
    assert run.run() == "COMPLETED" and slept == [1, 5, 30] and log == ["one", "two", "two", "two", "two", "three"]
    assert [r["state"] for r in run.ledger().filter("stage = 'two'").orderBy("step").collect()] == ["RUNNING", "WAITING"] * 3 + ["RUNNING", "COMPLETED"]


def test_from_and_until(spark, tmp_path):
    log = []
    run = stages.Run(spark, str(tmp_path), "r", simple(spark, log))
    with pytest.raises(LookupError):
        run.run(stage_from="two")
    assert run.run(until="two") == "PARTIAL" and run.run(stage_from="two") == "COMPLETED" and log == ["one", "two", "two", "three"]
    assert run.run(stage_from="two", until="two") == "COMPLETED" and run.tables("three")["main"].count() == 10
    with pytest.raises(ValueError):
        run.run(stage_from="four")


def test_record_run_resumes_to_the_same(spark, sf, tmp_path):
    raw = landing(spark, sf).filter("row_key < 40")
    whole, cut = (stages.Run(spark, str(tmp_path), k, stages.record_stages(raw, fuzzy=False, as_of="2024-06-01")) for k in ("whole", "cut"))
    assert whole.run() == "COMPLETED" and cut.run(until="events") == "PARTIAL" and cut.run(stage_from="resolve") == "COMPLETED"
    for stage, name in (("resolve", "records"), ("resolve", "entities"), ("resolve", "edges"), ("events", "events"), ("quality", "scores")):
        a, b = (sorted(map(str, run.tables(stage)[name].drop("run_id").collect())) for run in (whole, cut))
        assert a == b and (a or name == "edges"), stage

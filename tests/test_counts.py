"""Bitmaps of distinct entities, with deltas, against sets."""

import random

from quillstone.operators import counts
from quillstone.operators.store import Tables


def test_deltas_equal_a_recount(spark):
    rng = random.Random(3)
    made = lambda n, top: [(rng.choice(["a", "b", "c", None]), rng.choice([f"e{rng.randrange(top)}", None, "hot"])) for _ in range(n)]
    parts = [made(400, 300), made(200, 500), [], made(50, 100)]
    tables, numbers, kept = Tables(spark, "counts-test"), None, None
    for rows in parts:
        delta = spark.createDataFrame(rows, "grp string, entity_id string")
        numbers = counts.numbered(tables, delta, numbers)
        maps = counts.bitmaps(delta, numbers, ["grp"])
        kept = tables.put("bitmaps", maps if kept is None else counts.merged(kept, maps, ["grp"]))
    sets = {}
    for g, e in sum(parts, []):
        if e is not None:
            sets.setdefault(g, set()).add(e)
    assert {r["grp"]: r["n"] for r in counts.distinct_counts(kept, ["grp"]).collect()} == {g: len(s) for g, s in sets.items()}
    got = {(r["a"], r["b"]): r["n_both"] for r in counts.overlaps(kept, "grp").collect()}
    assert got == {(a, b): len(sets[a] & sets[b]) for a in "abc" for b in "abc" if a < b}
    taken = sorted(r["number"] for r in numbers.collect())
    assert taken == list(range(1, 1 + len(set().union(*sets.values()))))
    tables.drop()


def test_many_chunks(spark):
    """Numbers on both sides of a chunk's end."""
    tables = Tables(spark, "counts-test")
    every = spark.range(70_000).selectExpr("id as entity_id", "if(id % 3 = 0, 'x', 'y') as grp").unionByName(spark.range(1000).selectExpr("id as entity_id", "'z' as grp"))
    maps = tables.put("maps", counts.bitmaps(every, counts.numbered(tables, every), ["grp"]))
    assert {r["grp"]: r["n"] for r in counts.distinct_counts(maps, ["grp"]).collect()} == {"x": 23_334, "y": 46_666, "z": 1000}
    assert {(r["a"], r["b"]): r["n_both"] for r in counts.overlaps(maps, "grp").collect()} == {("x", "z"): 334, ("y", "z"): 666}
    assert maps.selectExpr("max(length(bits))").first()[0] == 4096
    tables.drop()

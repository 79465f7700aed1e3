"""The best name of a block for each record, without making the pairs: against brute force, over tiles, places, and texts that do not fit arrays."""

import random

import pytest

from quillstone.operators import resolve
from tests.test_operators import plain_score

CODES = ["V6B 1A1", "V6B 2B2", "v6b1a1", "K1", None]


def names(seed, n):
    r = random.Random(seed)
    words = ["north", "star", "stars", "bakery", "auto", "a\0", "b", "ééé", "customer", "00001234", "00001243", "limited", "x" * 70, "y" * 140]
    return [(" ".join(r.choice(words) + r.choice(["", "s", "x"]) for _ in range(r.randrange(0, 5))) or None, r.choice(CODES), r.choice([None, *range(20)])) for _ in range(n)]


@pytest.mark.parametrize(("threshold", "most"), [(88, 8192), (70, 7)])
def test_best_of_every_record_by_tiles_and_places(spark, monkeypatch, threshold, most):
    monkeypatch.setattr(resolve, "gram_pairs", lambda *_: pytest.fail("pairs are made"))
    a, b = names(1, 80), names(2, 150)
    place = "place struct<at: int, id: string>"
    records_ = spark.createDataFrame([(f"r{i}", n, None, c, (p or 0, "x")) for i, (n, c, p) in enumerate(a)], f"record_id string, legal_name string, trade_name string, postal_code string, {place}").repartition(3)
    entities = spark.createDataFrame([(f"e{i}", n, None, c, None if p is None else (p, None if i % 2 else "y")) for i, (n, c, p) in enumerate(b)], f"entity_id string, legal_name string, trade_name string, postal_code string, {place}").repartition(3)
    best = {}
    for i, (n, c, p) in enumerate(a):
        for j, (m, d, q) in enumerate(b):
            earlier = q is None or (q, "" if j % 2 else "y") < (p or 0, "x")  # a null comes first
            if n and c and d and earlier and c[:3].upper() == d[:3].upper() and (s := plain_score(n, m or "", c)) >= threshold:
                best[f"r{i}"] = min(best.get(f"r{i}", (0, "")), (-s, f"e{j}"))
    got = {r["record_id"]: (-r["score"], r["entity_id"]) for r in resolve.match_fuzzy(records_, entities, threshold, most=most).collect()}
    assert {k: (round(s, 2), e) for k, (s, e) in best.items()} == got and len(got) > 20


def test_empty_sides(spark):
    rows = spark.createDataFrame([("r", "acme", None, "V6B 1A1")], "record_id string, legal_name string, trade_name string, postal_code string")
    assert resolve.match_fuzzy(rows, rows.limit(0).withColumnRenamed("record_id", "entity_id")).count() == 0
    assert resolve.match_fuzzy(rows.limit(0), rows.withColumnRenamed("record_id", "entity_id")).count() == 0

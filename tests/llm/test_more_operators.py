"""Curve packing, periodic runs and the filter audit against plain versions."""

import hashlib
import random
import struct
import zlib
from itertools import permutations

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from quillstone.llm import curve, interactions, periodic
from quillstone.llm.queries import ORACLE_SQL
from tests.llm.test_operators import docs, none, pairs_of, prose  # noqa: F401  fixtures


# --- curve packing -------------------------------------------------------------------------------
def check_packing(rows, texts, capacity):
    """Every id once and in order, no gaps, sequences full or a power of two."""
    from tests.llm.test_operators import packing

    encoder, pieces, places = packing.Encoder(), {}, {}
    for r in rows:
        pieces.setdefault(r["doc_id"], []).append((r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]))
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    want = {}
    for doc, text in texts:
        want.setdefault(doc, []).append([*encoder.ids(text), 1])
    assert pieces.keys() == want.keys()
    for doc, all_ids in want.items():
        assert sum(p[1] for p in pieces[doc]) == sum(map(len, all_ids))
        if len(all_ids) == 1:
            ids, at = all_ids[0], 0
            for start, length, crc, n in sorted(pieces[doc]):
                assert start == at and n == len(ids) and length > 0 and crc == zlib.crc32(struct.pack(f"<{length}I", *ids[start : start + length]))
                at += length
            assert at == len(ids)
    loads = []
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        loads.append(at)
    assert all(n == capacity or n & (n - 1) == 0 for n in loads) and max(loads, default=0) <= capacity
    assert sum(n < capacity for n in loads) < capacity.bit_length()


@pytest.mark.parametrize("capacity", [2048, 64])
def test_pack_along_curve(docs, none, capacity):  # noqa: F811
    check_packing(curve.pack_along_curve(docs, capacity=capacity).collect(), pairs_of(docs), capacity)
    assert curve.pack_along_curve(none).count() == 0


def test_hot_copies_are_dealt_over_ranges(spark):
    """Two thirds of all rows have one key, some rows even one id: no range holds much more than its share."""
    rows = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 < 2, F.lit("the same text in many rows")).otherwise(F.concat(F.lit("text "), F.col("id"))).alias("text"))
    rows = rows.unionByName(spark.range(1000).select(F.lit(3).cast("long").alias("doc_id"), F.lit("the same text in many rows").alias("text")))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        per = [r["count"] for r in curve.along_curve(rows).groupBy("range").count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(per) == 4000 and len(per) == 4 and max(per) < 1500


def test_ids_of_pieces(docs):  # noqa: F811
    rows = curve.pack_along_curve(docs, with_ids=True).collect()
    assert all(len(r["ids"]) == r["length"] and zlib.crc32(struct.pack(f"<{r['length']}I", *r["ids"])) == r["ids_crc32"] for r in rows)


@pytest.mark.parametrize(("dimensions", "bits"), [(2, 4), (3, 3), (4, 2)])
def test_hilbert_is_a_walk_through_all_cells(dimensions, bits):
    cells = np.stack([c.ravel() for c in np.meshgrid(*[np.arange(1 << bits)] * dimensions, indexing="ij")], axis=1)
    keys = curve.hilbert(cells, bits)
    assert sorted(keys.tolist()) == list(range(len(cells)))
    walk = cells[np.argsort(keys)]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_neighbours_are_alike(spark):
    """Documents of six vocabularies, dealt in at random, come out in stretches of their own."""
    r = random.Random(5)
    words = [[f"{a}{b}{k}" for b in "aeiou" for k in range(8)] for a in ("bra", "keld", "mon", "tiph", "zur", "wex")]
    topic = [r.randrange(6) for _ in range(400)]
    frame = spark.createDataFrame([(i, " ".join(r.choices(words[t], k=120))) for i, t in enumerate(topic)], "doc_id long, text string").repartition(4)
    placed = sorted(curve.along_curve(frame).collect(), key=lambda x: (x["range"], x["at"]))
    order = [topic[x["doc_id"]] for x in placed]
    same = sum(a == b for a, b in zip(order, order[1:], strict=False)) / 399
    assert same > 0.6, same  # one in six by chance


def test_tail_cuts():
    for rest in range(300):
        cuts = [0, *curve.tail_cuts(rest)]
        assert cuts[-1] == rest and all((b - a) & (b - a - 1) == 0 for a, b in zip(cuts, cuts[1:], strict=False))


# --- periodic runs -------------------------------------------------------------------------------
def plain_runs(w, exponent=4, least=6):
    """Every period, every stretch, every smaller period, one by one."""
    out = []
    for q in range(1, len(w) // exponent + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            n = j - i + q
            if j > i and n >= max(least, exponent * q) and not any(all(w[k] == w[k + d] for k in range(i, i + n - d)) for d in range(1, q)):
                out.append((i, n, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_digest(doc_id, text):
    words = (text or "").encode().split()
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and words:
        g, n, old = h // 10, len(words), list(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        for i in range(a, n):
            words[i] = old[a + (i - a) % p]
    runs = plain_runs(words)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(((-n, s, q) for s, n, q in runs), default=None)
    of = (best[1], -best[0], best[2], 1000 * -best[0] // best[2]) if best else (None,) * 4
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return (doc_id, len(runs), *of, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()), sha(b" ".join(w for i, w in enumerate(words) if i not in gone)))


def repeating(seed):
    r = random.Random(seed)
    words = [r.choice("abcdefg") * r.randrange(1, 3) for _ in range(r.randrange(0, 160))]
    for _ in range(r.randrange(4)):
        if len(words) > 8:
            a, p = r.randrange(len(words)), r.randrange(1, 9)
            for i in range(a + p, min(len(words), a + p + r.randrange(70))):
                words[i] = words[i - p]
    return r.choice([" ", "\n", "\t \x0b"]).join(words)


@pytest.fixture(scope="module")
def repeats(spark, docs):  # noqa: F811
    rows = [(10000 + i, repeating(i), "clash", 7) for i in range(400)]
    rows += [(20000 + i, t, "clash", 7) for i, t in enumerate(["w " * 300, "x y " * 6, "a a a a a", "a a a a a a", "A a " * 3, "no break " * 3, "a b c " * 8 + "a b", None, "", " \n "])] + [(None, "q " * 12, None, 7), (20000, "w " * 300, "clash", 7)]
    return spark.createDataFrame(rows, "doc_id long, text string, runs string, start int").unionByName(docs.select("doc_id", "text", F.lit("c").alias("runs"), "start")).repartition(3)


@pytest.mark.parametrize("lags", [periodic.LAGS, 3, 1])
def test_periodic_digest(repeats, lags):
    """All rows, with the shifts of a text in one task and dealt over many."""
    got = periodic.digest(repeats, lags=lags)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted((plain_digest(*p) for p in ((r["doc_id"], r["text"]) for r in repeats.collect())), key=str)


def test_periodic_runs(repeats):
    rows = {r["doc_id"]: r for r in periodic.periodic_runs(repeats).collect()}
    assert [tuple(r) for r in rows[20006]["runs"]] == [(0, 26, 3)] and rows[20006]["collapsed"] == "a b c"
    assert [tuple(r) for r in rows[20000]["runs"]] == [(0, 300, 1)] and rows[20007]["n_words"] == 0 and rows[20007]["collapsed"] == ""
    assert periodic.digest(repeats.limit(0)).count() == 0
    with pytest.raises(ValueError):
        periodic.periodic_runs(repeats, exponent=1)


@pytest.mark.parametrize(("exponent", "least"), [(2, 1), (3, 6), (4, 9)])
def test_find_runs(exponent, least):
    for seed in range(300):
        words = repeating(seed).encode().split()
        want, ids, step = plain_runs(words, exponent, least), periodic.word_ids(words), 1 + seed % 7
        assert periodic.find_runs(ids, 1, None, exponent, least) == want
        parts = [r for low in range(1, len(ids) // exponent + 1, step) for r in periodic.find_runs(ids, low, low + step - 1, exponent, least)]
        assert sorted(parts, key=lambda r: (r[0], r[2])) == want


def test_runs_of_long_texts():
    """Beyond the table of first places, and in several blocks of them."""
    r = np.random.default_rng(3)
    ids = r.integers(0, 50_000, 40_000).astype(np.int32)
    ids[5000:35000] = np.tile(ids[5000:11000], 5)
    ids[100:400], ids[39_000:39_500] = 7, np.tile(ids[39_000:39_050], 10)
    want = [(100, 300, 1), (5000, 30000, 6000), (39_000, 500, 50)]
    assert periodic.find_runs(ids) == want
    whole = [np.concatenate(c) for c in zip(*periodic.anchors(len(ids), 1, 10_000, 4, 6), strict=True)]
    block, periodic.BLOCK = periodic.BLOCK, 1000
    try:
        cut = [np.concatenate(c) for c in zip(*periodic.anchors(len(ids), 1, 10_000, 4, 6), strict=True)]
        assert periodic.find_runs(ids) == want
    finally:
        periodic.BLOCK = block
    assert all((a == b).all() for a, b in zip(whole, cut, strict=True))
    assert periodic.find_runs(np.zeros(100_000, np.int32)) == [(0, 100_000, 1)]


# --- filter audit --------------------------------------------------------------------------------
def plain_audit(rows, marks):
    """Every order, row by row."""
    import re

    fails, ids = [], {}
    for doc, text, lang in rows:
        if doc is not None:
            ids.setdefault(text or "", set()).add(doc)
    for doc, text, lang in rows:
        text = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", text)
        f = {"A": len(w) < 100, "B": 100 * len(set(w)) < 80 * len(w), "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text), "D": bool(re.search("[#$%&*|]", text)), "E": doc is not None and any(x < doc for x in ids[text])}
        fails.append((lang or "", f, any(q == 1 for d, q, _ in marks if d == doc and doc is not None), any(t == 1 for d, _, t in marks if d == doc and doc is not None)))
    out, sums = {}, {}
    for part in {p for p, *_ in fails}:
        own = [x for x in fails if x[0] == part]
        for order in permutations("ABCDE"):
            left = own
            for step, name in enumerate(order, 1):
                hit = [x for x in left if x[1][name]]
                gone = [x for x in own if x[1][name] and not any(x is y for y in left)]
                left = [x for x in left if not x[1][name]]
                only = sum(f[name] and sum(f.values()) == 1 for _, f, _, _ in own)
                out[part, "".join(order), step] = (len(left), len(hit), len(gone), only, sum(x[2] for x in hit), sum(x[3] for x in hit))
                sums[part, name] = sums.get((part, name), 0) + len(hit)
    return {k: (*v, sums[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def audit_rows(spark):
    r = random.Random(11)
    texts = [None, "", prose(1, 130), prose(1, 130), "SHOUTING " * 20, "cost $5 " * 60, " ".join(f"w{i}" for i in range(150)), " ".join(f"W{i}" for i in range(120)) + " #", "é" * 50]
    rows = [(i if i % 13 else None, r.choice(texts), r.choice(["en", "fr", "", None])) for i in range(60)]
    rows += [rows[5], rows[5], rows[7], (5, "another text under the id of five", "en")]
    marks = [(i, r.choice([0, 1, None]), r.choice([0, 1])) for i in range(0, 60, 2)] + [(4, 1, 1), (4, 0, 0), (None, 1, 1)]
    docs = spark.createDataFrame([(*x, "clash", 1) for x in rows], "doc_id long, text string, lang string, part string, A int").repartition(4)
    return rows, marks, docs, spark.createDataFrame([(*m, "clash") for m in marks], "doc_id long, quality int, toxic int, lang string")


def test_filter_audit(spark):
    rows, marks, docs, labels = audit_rows(spark)  # noqa: F811
    got = interactions.filter_audit(docs, labels)
    assert got.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    found = got.collect()
    assert {(r[0], r[1], r[2]): tuple(r[3:]) for r in found} == plain_audit(rows, marks) and len(found) == 600 * 3
    assert interactions.filter_audit(docs.limit(0), labels).count() == 0
    assert all(r["good_lost"] == r["toxic_lost"] == 0 for r in interactions.filter_audit(docs, labels.limit(0)).collect())


def test_audit_of_any_filters(spark):
    """Two and three filters of any name, over rows that come with their flags."""
    rows = spark.createDataFrame([("p", 1, 0, 1), ("p", 1, 1, 0), ("p", 0, 0, 0), ("p", 0, 1, 1), ("q", 1, 1, 1)], "part string, x int, y int, bad int")
    got = {(r["part"], r["filter_order"], r["step"]): (r["kept"], r["removed"], r["redundant"], r["unique_fails"], r["lost"], r["shapley"]) for r in interactions.audit(rows, "part", {"X": "x", "Y": "y"}, {"lost": "bad"}).collect()}
    assert got["p", "XY", 1] == (2, 2, 0, 1, 1, 3) and got["p", "XY", 2] == (1, 1, 1, 1, 1, 3) and got["q", "YX", 2] == (0, 0, 1, 0, 0, 1) and len(got) == 8


def test_filter_audit_sql(spark, sf):
    con = duckdb.connect()
    for name in ("documents", "labels"):
        con.execute(f"create view {name} as select * from '{sf}/{name}.parquet'")
    want = con.execute(ORACLE_SQL["op13_filter_audit"])
    columns, rows = [c[0] for c in want.description], want.fetchall()
    got = interactions.filter_audit(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")).select(*columns)
    assert sorted(map(tuple, got.collect())) == sorted(rows) and len(rows) == 2400

"""Similar groups without a lost link, against brute force, with orders that find next to nothing."""

import random

import pytest

from quillstone.llm import simhash


def texts(seed, n):
    """Texts that share a passage, copies with so many words changed that they are near the threshold on both sides, and short ones."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(4))
    passage = [word() for _ in range(60)]
    out = []
    while len(out) < n:
        base = [word() for _ in range(r.choice([3, 5, 8, 30, 60, 120, 200]))]
        if r.random() < 0.5:
            at = r.randrange(len(base))
            base[at:at] = passage
        for _ in range(r.randrange(1, 5)):
            copy = list(base)
            for _ in range(r.randrange(0, max(2, len(base) // 25))):
                copy[r.randrange(len(copy))] = word()
            out.append(" ".join(copy))
    return [*out, out[0], None, "", " one ", "one"]


def plain(rows):
    """component ids by all pairs of shingle sets."""
    import xxhash

    sets = []
    for t in rows:
        w = (t or "").encode().lower().split()
        shingles = [b" ".join(w[i : i + 5]) for i in range(len(w) - 4)] or ([b" ".join(w)] if w else [])
        sets.append({xxhash.xxh64_intdigest(s, 42) >> 32 for s in shingles})
    up, links = list(range(len(rows))), 0
    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] == sets[j] or both >= 0.8 * (len(sets[i]) + len(sets[j]) - both) - 1e-9:
                links += 1
                a, b = root(i), root(j)
                up[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(rows))], links


@pytest.mark.parametrize(("seed", "orders"), [(1, 1), (2, 6)])
def test_no_link_is_lost(spark, seed, orders):
    rows = texts(seed, 260)
    want, links = plain(rows)
    df = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(rows)], "doc_id long, text string, sig string").repartition(3)
    got = {r["doc_id"]: r["component_id"] for r in simhash.similar_groups(df, orders=orders, exact=True).collect()}
    assert [got[i] for i in range(len(rows))] == want and links > 100
    if orders == 1:  # the case is one that the orders alone do not solve
        loose = {r["doc_id"]: r["component_id"] for r in simhash.similar_groups(df, orders=1).collect()}
        assert sum(loose[i] != want[i] for i in range(len(rows))) > 0
        assert simhash.similar_groups(df.limit(0), exact=True).count() == 0


def test_hot_passage_and_hot_group(spark):
    """A third of the rows share a passage, another third are near copies of one text: one group, and nobody else in it."""
    r = random.Random(4)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(5))
    passage, base = [word() for _ in range(100)], [word() for _ in range(150)]
    rows = [" ".join([word() for _ in range(40)] + passage) for _ in range(150)]
    rows += [" ".join(base[:k] + [word()] + base[k + 1 :]) for k in range(150)]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    got = {x["doc_id"]: x["component_id"] for x in simhash.similar_groups(df, exact=True, most=40).collect()}
    assert all(got[i] == i for i in range(150)) and all(got[i] == 150 for i in range(150, 300))

"""The pipeline's stage finds pairs at the threshold that share none of the small fingerprints."""

import random

import numpy as np

import corpus_pipeline
from quillstone.llm import simhash


def missed_pairs(n):
    """Pairs of texts whose similarity is 0.8 or a little more, and that meet in no order."""
    r, out = random.Random(8), []
    while len(out) < n:
        word = lambda: "".join(r.choice("abcdefghij") for _ in range(6))
        base = [word() for _ in range(184)]
        copy = list(base)
        for k in (20, 60, 100, 140):
            copy[k] = word()  # five shingles each: 160 of 200 are common
        x, y = (np.unique(np.array(simhash.shingle_hashes(" ".join(t), 5), dtype=np.uint64)) for t in (base, copy))
        both = len(np.intersect1d(x, y))
        assert both >= 0.8 * (len(x) + len(y) - both)
        if not set(simhash._orders(x, simhash.ORDERS)) & set(simhash._orders(y, simhash.ORDERS)):
            out.append((" ".join(base), " ".join(copy)))
    return out


def test_near_dedup_leaves_no_pair_out(spark, sf):
    rows = [t for pair in missed_pairs(3) for t in pair]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    assert sorted(r["doc_id"] for r in corpus_pipeline.near_dedup(spark, docs, sf).collect()) == [0, 2, 4]

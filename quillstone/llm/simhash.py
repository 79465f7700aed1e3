"""SimHash near-duplicate groups, with pivot distance tables.

Equal fingerprints become one node. Nodes within ``max_bits`` of each other must agree in all but
``max_bits`` of the blocks that a fingerprint is cut into, so each node is dealt once for every way
to choose the agreeing blocks, and near nodes meet at least once. Where nodes meet, a table holds
their Hamming distances to many reference fingerprints (pivots); by the triangle inequality a pair
whose distances to any pivot differ by more than ``max_bits`` is discarded, and only the others are
compared. Each task returns a spanning forest of the links it found, not the links, and the forests
are joined by rounds of label propagation over scratch tables.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillstone.llm.shared import drop, maybe_broadcast, sorted_runs, stored

WORDS = 4
MAX_BITS = 4
PIVOTS = 24
SEED = 42


def shingle_hashes(text: str, words: int, start: int = 0, stop: int | None = None) -> list[int]:
    import xxhash

    parts = text.encode("utf-8").lower().split()  # of bytes: ASCII white space and A-Z only
    if len(parts) <= words:
        return [xxhash.xxh64_intdigest(b" ".join(parts), SEED)] if parts else []
    joined = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    view, h = memoryview(joined), xxhash.xxh64_intdigest
    return [h(view[a:b], SEED) for a, b in zip(starts[: 1 - words].tolist() if words > 1 else starts.tolist(), ends[words - 1 :].tolist(), strict=True)]


def fingerprint(text: str | None, words: int = WORDS) -> int:
    """Signed 64-bit fingerprint: a bit is set if it is in over half the shingles' hashes."""
    hashes = np.array(shingle_hashes(text or "", words), dtype=np.uint64)
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS) -> DataFrame:
    """doc_id and fp (signed 64 bits) of every row; null text counts as empty, whose fingerprint is zero."""
    schema = T.StructType([T.StructField("doc_id", docs.schema[id_col].dataType), T.StructField("fp", T.LongType())])

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([fingerprint(t, words) for t in batch.column(1).to_pylist()], pa.int64())], names=schema.names)

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema)


def block_masks(nodes: int, max_bits: int) -> list[int]:
    """The bits that must agree, for each way to choose them; finer for more nodes, so that few meet by chance."""
    for blocks in range(max_bits + 1, 65):
        if 64 * (blocks - max_bits) // blocks >= np.log2(max(nodes, 2)) + 1 or blocks >= max_bits + 4:
            break
    edges = [64 * i // blocks for i in range(blocks + 1)]
    parts = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:], strict=False)]
    return [sum(c) for c in combinations(parts, blocks - max_bits)]


def pivots(n: int = PIVOTS) -> np.ndarray:
    return np.random.default_rng(SEED).integers(0, 2**64, n, dtype=np.uint64)


class Forest:
    """Union-find over the nodes a task has linked."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        up = self.up
        while (y := up.setdefault(x, x)) != x:
            up[x] = up.setdefault(y, y)
            x = up[x]
        return x

    def link(self, a: int, b: int) -> None:
        a, b = self.root(a), self.root(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)

    def edges(self) -> tuple[list[int], list[int]]:
        pairs = [(x, self.root(x)) for x in list(self.up)]
        return [x for x, r in pairs if x != r], [r for x, r in pairs if x != r]

    def batch(self) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in self.edges()], names=["src", "dst"])


def near(x: np.ndarray, table: np.ndarray, a: np.ndarray, b: np.ndarray, max_bits: int) -> np.ndarray:
    """Which of the pairs (a, b) of rows are within ``max_bits``: discarded by pivot distances, then verified."""
    ok = np.arange(len(a))
    for distances in table:
        if len(ok) < 64:
            break
        ok = ok[np.abs(distances[a[ok]] - distances[b[ok]]) <= max_bits]
    ok = ok[np.bitwise_count(x[a[ok]] ^ x[b[ok]]) <= max_bits]
    return ok


def link_bucket(x: np.ndarray, table: np.ndarray, max_bits: int, forest: Forest) -> None:
    """Link a bucket of many nodes: grow groups, comparing each member only with nodes not yet in one."""
    order = np.argsort(table[0], kind="stable")
    free = order  # by distance to the first pivot: only a window of it can be near
    keys = x.view(np.int64)
    while len(free):
        front, free = [free[0]], free[1:]
        while front and len(free):
            i = front.pop()
            d = table[0]
            lo, hi = np.searchsorted(d[free], [d[i] - max_bits, d[i] + max_bits + 1])
            window = free[lo:hi]
            hit = window[near(x, table[1:], np.full(len(window), i), window, max_bits)]
            if len(hit):
                for j in hit.tolist():
                    forest.link(int(keys[i]), int(keys[j]))
                front.extend(hit.tolist())
                gone = np.zeros(len(x), dtype=bool)
                gone[hit] = True
                free = free[~gone[free]]


def link_runs(key: np.ndarray, fp: np.ndarray, max_bits: int, forest: Forest, refs: np.ndarray, small: int = 48) -> None:
    """Link the nodes of each run of equal keys (keys are sorted)."""
    cuts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.array([], dtype=np.int64)
    sizes = np.diff(np.concatenate((cuts, [len(key)])))
    x = fp.view(np.uint64)
    keep = np.repeat((sizes > 1) & (sizes <= small), sizes)
    if keep.any():
        y, k = x[keep], key[keep]
        table = np.bitwise_count(y[None, :] ^ refs[:, None]).astype(np.int16)
        i = np.arange(len(y))
        for step in range(1, small):
            i = i[i + step < len(y)]
            i = i[k[i] == k[i + step]]
            if not len(i):
                break
            ok = i[near(y, table, i, i + step, max_bits)]
            s = y.view(np.int64)
            for a, b in zip(s[ok].tolist(), s[ok + step].tolist(), strict=True):
                forest.link(a, b)
    for at in np.flatnonzero(sizes > small):
        y = x[cuts[at] : cuts[at] + sizes[at]]
        link_bucket(y, np.bitwise_count(y[None, :] ^ refs[:, None]).astype(np.int16), max_bits, forest)


def links(nodes: DataFrame, n_nodes: int, max_bits: int = MAX_BITS, most: int = 100_000) -> DataFrame:
    """A spanning forest (src, dst) of all links between distinct fingerprints ``fp``.

    Buckets of over ``most`` nodes are dealt out again as pairs of tiles, so no task gets more than
    ``2 * most`` nodes of one bucket and all pairs still meet.
    """
    masks = block_masks(n_nodes, max_bits)
    signed = [m - (1 << 64) if m >= 1 << 63 else m for m in masks]
    dealt = nodes.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m).cast("long")) for m in signed])).alias("way", "key"))
    schema = T.StructType([T.StructField("src", T.LongType()), T.StructField("dst", T.LongType())])
    big = None
    if n_nodes > most:
        big = stored(dealt.groupBy("way", "key").agg(F.count("*").alias("n")).filter(F.col("n") > most), "simhash-big")
    parts = dealt if big is None else dealt.join(maybe_broadcast(big.select("way", "key"), 32), ["way", "key"], "left_anti")
    # The buckets of a way differ in its masked bits only: one long identifies (way, key).
    mixed = F.xxhash64("way", "key")

    def run(batches):
        refs, forest = pivots(), Forest()
        for table, starts in sorted_runs(batches, 2):
            run_id = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, table.num_rows)))
            link_runs(run_id, table.column(2).to_numpy(), max_bits, forest, refs)
            if len(forest.up) > 500_000:
                yield forest.batch()
                forest = Forest()
        yield forest.batch()

    rows = parts.select("key", "way", "fp").repartition(mixed).sortWithinPartitions("key", "way")
    found = rows.mapInArrow(run, schema)
    if big is not None:
        found = found.unionByName(_tiled(dealt, big, max_bits, most, schema))
    return found.distinct()


def _tiled(dealt: DataFrame, big: DataFrame, max_bits: int, most: int, schema: T.StructType) -> DataFrame:
    """The links of buckets of over ``most`` nodes: each pair of tiles is a task's group."""
    tiles = big.select("way", "key", F.ceil(F.col("n") / most).cast("int").alias("tiles"))
    own = dealt.join(tiles, ["way", "key"]).withColumn("tile", F.pmod(F.xxhash64("fp"), F.col("tiles")).cast("int"))
    pairs = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    low, high = F.least("tile", "other"), F.greatest("tile", "other")

    def run(frame):
        import pandas as pd

        refs, forest = pivots(), Forest()
        x = frame["fp"].to_numpy(np.int64).view(np.uint64)
        link_bucket(x, np.bitwise_count(x[None, :] ^ refs[:, None]).astype(np.int16), max_bits, forest)
        src, dst = forest.edges()
        return pd.DataFrame({"src": src, "dst": dst}, dtype="int64")

    return pairs.withColumn("low", low).withColumn("high", high).groupBy("way", "key", "low", "high").applyInPandas(run, schema)


def _stars(now: DataFrame, large: bool) -> DataFrame:
    """One star step: every node's neighbours (large: those above it; else those below) go to the least node of its neighbourhood.

    The least nodes come from an aggregate that combines before its shuffle, and are stored: the join then has plain tables on
    both sides, so that adaptive execution can split a star's centre, or needs no shuffle where they are few.
    """
    both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else now
    least = stored(both.groupBy("a").agg(F.min("b").alias("m")), "cc-least")
    to = maybe_broadcast(least, 40, 2 << 20)
    if large:
        stars = now.select(F.col("b").alias("a"), F.col("a").alias("b")).join(to, "a").select(F.col("b").alias("a"), F.least("m", "a").alias("b"))
    else:
        stars = now.join(to, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
    after = stored(stars.filter("a <> b").distinct(), "cc")
    drop(least)
    return after


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node in ``edges``: root is the smallest node reachable.

    Rounds of large-star and small-star on edges (a, b) with a > b, until all that is left are stars: every node
    has one edge, to a node that has none. Every step is a scratch table, the one before it is deleted.
    """
    now = stored(edges.select(F.greatest("src", "dst").alias("a"), F.least("src", "dst").alias("b")).filter("a <> b").distinct(), "cc")
    while True:
        inner = now.select("b").distinct().join(now.select(F.col("a").alias("b")), "b", "left_semi")
        if inner.isEmpty() and now.groupBy("a").count().filter("count > 1").isEmpty():
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        for large in (True, False):
            before, now = now, _stars(now, large)
            drop(before)


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, max_bits: int = MAX_BITS, most: int = 100_000) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every row.

    component_id is the smallest doc_id among all rows whose fingerprints are reachable over links of
    ``max_bits`` or fewer differing bits. Rows with null or word-less text have fingerprint zero and
    link like any other. Null ids are kept but never name a group unless all its ids are null. Repeated rows fall in one
    group. Empty tables give no rows. Other columns are not carried. Fewer words than a shingle has: the whole sequence is one.
    """
    marked = stored(fingerprints(docs, id_col, text_col, words), "fingerprints")
    nodes = stored(marked.groupBy("fp").agg(F.min("doc_id").alias("first")), "nodes")
    found = stored(links(nodes, nodes.count(), max_bits, most), "links")
    roots = components(found).select(F.col("node").alias("fp"), "root")
    grouped = nodes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    first = grouped.groupBy("root").agg(F.min("first").alias("component_id"))
    named = stored(grouped.join(first, "root").select("fp", "component_id"), "groups")
    return marked.join(named, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


# Near-duplicates by shingle similarity.
#
# Texts that share four fifths of their distinct shingles differ in about ten of 64 bits, too many for blocks
# of bits to bring them together. So a text also gets a few small fingerprints: the SimHash of the two
# shingles that come first in each of several random orders. Texts meet where they share one (at
# similarity 0.8 in over 99 of 100 cases); there the pivot table of the whole fingerprints discards
# pairs, and the survivors' shingle sets are compared exactly.

SIMILAR_WORDS = 5
SIMILARITY = 0.8
ORDERS = 6
SAMPLE_BITS = 28


def _orders(hashes: np.ndarray, orders: int) -> list[int]:
    """A small fingerprint for each random order of distinct hashes."""
    out = []
    for k in range(orders):
        x = hashes ^ np.uint64((0x9E3779B97F4A7C15 * (k + 1)) & 0xFFFFFFFFFFFFFFFF)
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
        x ^= x >> np.uint64(31)
        first = np.partition(x, 1)[:2] if len(x) > 2 else x
        out.append(int((first[0] & first[-1]) ^ np.uint64(k)))
    return [x - (1 << 64) if x >= 1 << 63 else x for x in out]


def sketches(docs: DataFrame, id_col: str, text_col: str, words: int, orders: int) -> DataFrame:
    """doc_id, sig (of the shingle set), fp, shingles (sorted unsigned 32 bits) and keys of every row."""
    schema = T.StructType([
        T.StructField("doc_id", docs.schema[id_col].dataType), T.StructField("sig", T.LongType()), T.StructField("fp", T.LongType()),
        T.StructField("shingles", T.BinaryType()), T.StructField("keys", T.ArrayType(T.LongType())),
    ])

    def run(batches):
        import xxhash

        for batch in batches:
            rows = []
            for text in batch.column(1).to_pylist():
                found = np.array(shingle_hashes(text or "", words), dtype=np.uint64)
                distinct = np.unique(found)
                # Of the distinct shingles, as the similarity is: repeats must not move the fingerprint.
                ones = np.zeros(64, dtype=np.int64)
                for at in range(0, len(distinct), 1 << 16):
                    ones += np.unpackbits(distinct[at : at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
                short = np.unique((distinct >> np.uint64(32)).astype("<u4")).tobytes()
                fp = int(np.packbits(2 * ones > len(distinct), bitorder="little").view("<i8")[0])
                rows.append((xxhash.xxh64_intdigest(distinct.astype("<u8").tobytes()) - (1 << 63), fp, short, _orders(distinct, orders) if len(distinct) else []))
            cols = zip(*rows, strict=True) if rows else [[]] * 4
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64())), strict=True))], names=schema.names)

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema)


def link_similar(sigs: np.ndarray, fps: np.ndarray, sets: list[np.ndarray], similarity: float, forest: Forest, refs: np.ndarray, max_bits: int = SAMPLE_BITS) -> None:
    """Link the texts of a bucket whose shingle sets are similar, each group member compared only with texts not yet in a group."""
    sizes = np.array([len(s) for s in sets])
    x = fps.view(np.uint64)
    table = np.bitwise_count(x[None, :] ^ refs[:, None]).astype(np.int16)
    # Few shingles make coarse fingerprints: the bound on bits holds for sets of some size only.
    loose = sizes < 32
    free = np.argsort(sizes, kind="stable")
    while len(free):
        front, free = [int(free[0])], free[1:]
        while front and len(free):
            i = front.pop()
            lo, hi = np.searchsorted(sizes[free], [np.ceil(similarity * sizes[i] - 1e-9), np.floor(sizes[i] / similarity + 1e-9) + 0.5])
            window, hit = free[lo:hi], []
            fit = near(x, table, np.full(len(window), i), window, max_bits)
            for j in (window if loose[i] else window[np.union1d(fit, np.flatnonzero(loose[window]))]).tolist():
                both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                if both >= similarity * (sizes[i] + sizes[j] - both) - 1e-9:
                    forest.link(int(sigs[i]), int(sigs[j]))
                    hit.append(j)
            if hit:
                front += hit
                free = free[~np.isin(free, hit)]


def similar_links(nodes: DataFrame, similarity: float, most: int, max_bits: int = SAMPLE_BITS) -> DataFrame:
    """A spanning forest (src, dst) of the links between distinct shingle sets ``sig`` that share a key, of pairs that the pivots do not discard."""
    dealt = nodes.select("sig", F.explode("keys").alias("key"))
    met = stored(dealt.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1"), "similar-keys")
    # Only texts that meet another are moved with their shingles; a bucket of over ``most`` goes out in pairs of tiles.
    pairs = nodes.select("sig", "fp", "shingles", F.explode("keys").alias("key")).join(maybe_broadcast(met, 16), "key")
    tiles = F.ceil(F.col("n") / most).cast("int")
    pairs = pairs.withColumn("tile", F.pmod(F.xxhash64("sig"), tiles).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), tiles - 1)))
    rows = pairs.select("key", (F.least("tile", "other") * F.lit(1 << 20).cast("long") + F.greatest("tile", "other")).alias("pair"), "sig", "fp", "shingles")

    def run(batches):
        refs, forest = pivots(), Forest()
        for table, starts in sorted_runs(batches, 2):
            sigs, fps, sets = table.column("sig").to_numpy(), table.column("fp").to_numpy(), table.column("shingles").to_pylist()
            for a, b in zip(starts.tolist(), [*starts[1:].tolist(), table.num_rows], strict=True):
                if b - a > 1:
                    link_similar(sigs[a:b], fps[a:b], [np.frombuffer(s, "<u4") for s in sets[a:b]], similarity, forest, refs, max_bits)
            if len(forest.up) > 500_000:
                yield forest.batch()
                forest = Forest()
        yield forest.batch()

    return rows.repartition("key", "pair").sortWithinPartitions("key", "pair").mapInArrow(run, "src long, dst long").distinct()


def _common_shingles(nodes: DataFrame, sets: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(sorted shingles, their counts) of what recurs in about ``sets`` sets, the ``most`` commonest: a hint which shingles are common, of bounded size."""
    share = max(1, nodes.count() // sets)

    def each(batches):
        for batch in batches:
            for s in batch.column(0).to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(s, "<u4").astype(np.int64))], names=["shingle"])

    seen = nodes.filter(F.pmod(F.xxhash64("sig"), F.lit(share)) == 0).select("shingles").mapInArrow(each, "shingle long")
    top = seen.groupBy("shingle").agg(F.count("*").alias("n")).filter("n > 2").orderBy(F.desc("n"), "shingle").limit(most).orderBy("shingle").toArrow()
    return top.column("shingle").to_numpy().astype(np.uint32), top.column("n").to_numpy()


def rare_keys(nodes: DataFrame, roots: DataFrame, similarity: float, tile: int = 2000, sets: int = 4096, most: int = 200_000) -> DataFrame:
    """``nodes`` that may be similar to one of another component, with keys of which such a pair shares one at least.

    Of two sets that share so much, the shingles that come first in any one order, ``size - ceil(similarity * size) + 1`` of each, share one. The
    order here puts last what recurs in some of the sets (``_common_shingles``), so that a passage that many texts share is seldom a key; it decides how much is
    compared, not what is found. Of keys that the same sets hold one is kept, and none that one component holds alone. Moved are a fifth of
    the shingles, once, and of texts that share a key two bits a shingle (``parity``), by which most pairs are discarded for certain. ``roots``: of nodes with links; a node without is its own.
    """
    common, counts = _common_shingles(nodes, sets, most)

    def first(batches):
        for batch in batches:
            keys = []
            for s in batch.column(1).to_pylist():
                x = np.frombuffer(s, "<u4")
                wanted = int(len(x) - np.ceil(len(x) * similarity - 1e-9) + 1) if len(x) else 0
                n = np.zeros(len(x), dtype=np.int64)
                if len(common) and len(x):
                    at = np.minimum(np.searchsorted(common, x), len(common) - 1)
                    n = np.where(common[at] == x, counts[at], 0)
                keys.append(x[np.argsort(n, kind="stable")[:wanted]].astype(np.int64))  # the sets are sorted
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys, pa.list_(pa.int64()))], names=["sig", "keys"])

    keys = stored(nodes.select("sig", "shingles").mapInArrow(first, "sig long, keys array<long>"), "prefix-keys")
    each = keys.join(maybe_broadcast(roots, 24), "sig", "left").select("sig", F.coalesce("root", "sig").alias("root"), F.explode("keys").alias("key"))
    # Sums that tell which sets hold a key; they wrap.
    of = (F.count("*").alias("n"), F.bit_xor(F.xxhash64("sig")).alias("x"), F.bit_xor(F.xxhash64(F.lit(1), "sig")).alias("y"))
    met = each.groupBy("key").agg(*of, F.min("root").alias("low"), F.max("root").alias("high")).filter("low <> high")
    kept = stored(met.groupBy("n", "x", "y").agg(F.min("key").alias("key")).select("key"), "prefix-met")
    near = stored(_near_pairs(nodes, each.join(maybe_broadcast(kept, 16), "key"), similarity, tile), "near-pairs")
    drop(keys)
    # A pair is a bucket of its own: only the sets of these are moved.
    pair = F.xxhash64("a", "b").alias("key")
    own = near.select(F.col("a").alias("sig"), pair).unionByName(near.select(F.col("b").alias("sig"), pair)).groupBy("sig").agg(F.collect_list("key").alias("keys"))
    return nodes.drop("keys").join(maybe_broadcast(stored(own, "prefix-own"), 64), "sig")


def parity(shingles: np.ndarray) -> bytes:
    """Bits that say whether an odd number of the shingles falls on them, two or more a shingle. Sets whose bits differ in n places differ in n shingles at least."""
    bits = max(64, 1 << int(2 * len(shingles) - 1).bit_length()) if len(shingles) else 64
    odd = np.bincount(shingles & np.uint32(bits - 1), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def _folded(bits: np.ndarray, width: int) -> np.ndarray:
    """Parities as of ``width`` bits, a power of two that is not larger."""
    return np.bitwise_xor.reduce(bits.reshape(-1, width // 64), axis=0)


def _near_pairs(nodes: DataFrame, met: DataFrame, similarity: float, tile: int) -> DataFrame:
    """(a, b) of the sets of different components that share a key and whose parities allow the similarity; of ``met``: sig, root, key."""
    def small(batches):
        for batch in batches:
            sets = [np.frombuffer(s, "<u4") for s in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(x) for x in sets], pa.int32()), pa.array([parity(x) for x in sets], pa.binary())], names=["sig", "size", "bits"])

    bits = nodes.select("sig", "shingles").mapInArrow(small, "sig long, size int, bits binary")
    counts = stored(met.groupBy("key").agg(F.ceil(F.count("*") / tile).cast("int").alias("tiles")), "near-counts")
    rows = met.join(maybe_broadcast(counts, 16), "key").join(bits, "sig").withColumn("tile", F.pmod(F.xxhash64("sig"), F.col("tiles")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    rows = rows.select("key", (F.least("tile", "other") * F.lit(1 << 20).cast("long") + F.greatest("tile", "other")).alias("pair"), "sig", "root", "size", "bits")

    def run(batches):
        most = (1 - similarity) / (1 + similarity)  # of both sizes may differ
        for table, starts in sorted_runs(batches, 2):
            sig, root, size = (table.column(c).to_numpy() for c in ("sig", "root", "size"))
            held = [np.frombuffer(x, "<u8") for x in table.column("bits").to_pylist()]
            for first, end in zip(starts.tolist(), [*starts[1:].tolist(), table.num_rows], strict=True):
                order = first + np.argsort(size[first:end], kind="stable")
                sizes, roots, a, b = size[order], root[order], [], []
                # Larger sets have wider parities: those of one width stand together.
                widths = np.array([64 * len(held[j]) for j in order.tolist()])
                blocks = [(int(x), int(y), np.stack([held[j] for j in order[x:y].tolist()])) for w in np.unique(widths).tolist() for x, y in [np.searchsorted(widths, [w, w + 1])]]
                lows = np.searchsorted(sizes, np.ceil(similarity * sizes - 1e-9))
                for k, i in enumerate(order.tolist()):
                    for x, y, table_of in blocks:
                        low, high = max(int(lows[k]), x), min(k, y)
                        if low >= high:
                            continue
                        differ = np.bitwise_count(table_of[low - x : high - x] ^ _folded(held[i], 64 * table_of.shape[1])).sum(axis=1, dtype=np.int64)
                        ok = (differ <= most * (sizes[low:high] + sizes[k]) + 1e-6) & (roots[low:high] != roots[k])
                        for j in order[low:high][ok].tolist():
                            a.append(min(sig[i], sig[j]))
                            b.append(max(sig[i], sig[j]))
                if a:
                    yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return rows.repartition("key", "pair").sortWithinPartitions("key", "pair").mapInArrow(run, "a long, b long").distinct()


def similar_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SIMILAR_WORDS, similarity: float = SIMILARITY, orders: int = ORDERS, most: int = 20_000, exact: bool = False) -> DataFrame:
    """(doc_id, component_id) of every row; rows whose shingle sets are similar, directly or over others, share a component.

    component_id is the smallest id of the component. Rows without words are copies of one another. Null ids
    never name a component unless all its ids are null. Repeated rows share a component; an empty table gives no rows. ``exact``: after the links that the random orders
    find, those between components are looked for by shingles that come first in one order (``rare_keys``), of which no similar pair is without, and nothing is discarded by pivots there.
    """
    marked = stored(sketches(docs, id_col, text_col, words, orders), "sketches")
    nodes = marked.groupBy("sig").agg(F.min("doc_id").alias("first"), F.first("fp").alias("fp"), F.first("shingles").alias("shingles"), F.first("keys").alias("keys"))
    nodes, sketched = stored(nodes, "shingle-sets"), marked
    marked = stored(marked.select("doc_id", "sig"), "sigs")
    drop(sketched)  # the sets are in the nodes
    found = stored(similar_links(nodes, similarity, most), "similar-links")
    roots = components(found).select(F.col("node").alias("sig"), "root")
    if exact:
        rest = stored(rare_keys(nodes, stored(roots, "similar-roots"), similarity, min(most, 2000)), "rare-keys")
        more = stored(similar_links(rest, similarity, most, max_bits=64), "rare-links")
        roots = components(stored(found.unionByName(more).distinct(), "all-links")).select(F.col("node").alias("sig"), "root")
    grouped = nodes.select("sig", "first").join(roots, "sig", "left").withColumn("root", F.coalesce("root", "sig"))
    first = grouped.groupBy("root").agg(F.min("first").alias("component_id"))
    named = stored(grouped.join(first, "root").select("sig", "component_id"), "similar-groups")
    return marked.select("doc_id", "sig").join(named, "sig").select("doc_id", "component_id")


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the rows whose id is not the smallest of their group of similar texts.

    Rows that share an id stand or fall by the rows of that id: one that leads its group keeps it. Rows with null ids stay.
    """
    found = similar_groups(docs, id_col, text_col, **options).groupBy("doc_id").agg(F.max(F.col("doc_id") == F.col("component_id")).alias("leads"))
    gone = stored(found.filter(~F.col("leads")).select(F.col("doc_id").alias(id_col)), "near-copies")
    return docs.join(maybe_broadcast(gone, 16), id_col, "left_anti")

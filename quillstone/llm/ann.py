"""Approximate nearest neighbours by vantage-point trees, one per shard.

Rows are dealt to shards by nearness: the upper levels of a vantage-point tree, fitted on a bounded
sample, send every row to a cell; large cells are dealt on by a hash of the id. Each shard gets a tree
of its own, which halves its vectors by distance to a vantage point down to leaves; equal vectors are
one point with a list of ids. A query first goes to its own cell, for a bound on the distance of its
k-th neighbour. With that bound it is sent to the cells, and inside them to the leaves, that the triangle
inequality admits: the far side of a radius is entered if it is nearer than the bound times ``relax``.
``relax`` of one is exact, ties included. All queries of a block go through a tree together, so each
node costs a few array operations. Trees and query blocks are files in the shared folder; a task
joins trees with blocks.
"""

from __future__ import annotations

import io

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillstone.llm.shared import file_system, scratch_path, stored

ROWS_PER_SHARD = 16_384
QUERIES_PER_BLOCK = 2_048
#: Rows of each vector length that the cells are fitted on, at most; and the least of them for a cell.
SAMPLE_ROWS = 16_384
SAMPLE_PER_CELL = 16
LEAF = 512
RELAX = 0.5
#: Of squared distances, as a share of the squared lengths: more than their rounding.
ROUNDING = 1e-12


class Tree:
    """A vantage-point tree over distinct vectors (float64 rows)."""

    def __init__(self, points: np.ndarray, order: np.ndarray, nodes: np.ndarray, radii: np.ndarray):
        #: nodes: start, stop, vantage row, left child, right child (-1: a leaf)
        self.points, self.order, self.nodes, self.radii = points, order, nodes, radii
        self.squares = (points * points).sum(axis=1)

    @classmethod
    def build(cls, points: np.ndarray, leaf: int = LEAF, seed: int = 0) -> Tree:
        rng, order, nodes, radii = np.random.default_rng(seed), np.arange(len(points)), [], []
        todo = [(0, len(points), -1, 0)]
        while todo:
            start, stop, parent, side = todo.pop()
            me, own = len(nodes), order[start:stop]
            if parent >= 0:
                nodes[parent][3 + side] = me
            nodes.append([start, stop, -1, -1, -1])
            radii.append(0.0)
            if stop - start <= leaf:
                continue
            tries = rng.choice(own, min(5, len(own)), replace=False)
            sample = points[rng.choice(own, min(100, len(own)), replace=False)]
            vantage = max(tries, key=lambda v: np.linalg.norm(sample - points[v], axis=1).std())
            away = np.linalg.norm(points[own] - points[vantage], axis=1)
            half = len(own) // 2
            split = np.argpartition(away, half - 1)
            order[start:stop] = own[split]
            radii[me], nodes[me][2] = float(away[split[:half]].max()), int(vantage)
            todo += [(start, start + half, me, 0), (start + half, stop, me, 1)]
        return cls(points, order, np.array(nodes, dtype=np.int64).reshape(-1, 5), np.array(radii))

    def sides(self, node: int, x: np.ndarray, reach: np.ndarray | None = None, relax: float = 1.0) -> tuple[np.ndarray, np.ndarray]:
        """Which of ``x`` go to the left and to the right of a node; with a reach, both where it takes them across the radius."""
        away = np.linalg.norm(x - self.points[self.nodes[node][2]], axis=1) - self.radii[node]
        if reach is None:
            return away <= 0, away > 0
        near = np.abs(away) <= relax * reach + 1e-9
        return (away <= 0) | near, (away > 0) | near

    def leaves(self, x: np.ndarray, reach: np.ndarray | None = None, relax: float = 1.0) -> list[tuple[int, np.ndarray]]:
        """(leaf node, rows of ``x`` that go there): one leaf each, or all that their reach admits."""
        todo, out = [(0, np.arange(len(x)))], []
        while todo:
            node, of = todo.pop()
            if not len(of):
                continue
            if self.nodes[node][3] < 0:
                out.append((node, of))
                continue
            left, right = self.sides(node, x[of], None if reach is None else reach[of], relax)
            todo += [(self.nodes[node][3], of[left]), (self.nodes[node][4], of[right])]
        return out

    def search(self, queries: np.ndarray, k: int, relax: float, reach: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        """(query, point) pairs with each query's ``k`` nearest points found, ties included; the bounds reached; the pairs compared.

        ``reach``: bounds known before; only points within them are returned.
        """
        n, compared, found = len(queries), 0, []
        best, reach = np.full((n, k), np.inf), np.full(n, np.inf) if reach is None else reach.copy()
        squares = (queries * queries).sum(axis=1)

        def visit(node: int, of: np.ndarray) -> None:
            nonlocal compared
            if not len(of):
                return
            start, stop, _, left, right = self.nodes[node]
            if left < 0:
                own = self.order[start:stop]
                compared += len(of) * len(own)
                sums = squares[of, None] + self.squares[None, own]
                d = np.maximum(sums - 2 * (queries[of] @ self.points[own].T), 0)
                best[of] = np.partition(np.concatenate((best[of], d), axis=1), k - 1, axis=1)[:, :k]
                reach[of] = np.minimum(reach[of], np.sqrt(best[of].max(axis=1)))
                i, j = np.nonzero(d <= reach[of, None] ** 2 + ROUNDING * sums)
                found.append((of[i], own[j], d[i, j] - ROUNDING * sums[i, j]))
                return
            nearer, _ = self.sides(node, queries[of])
            visit(left, of[nearer])
            visit(right, of[~nearer])
            to_left, to_right = self.sides(node, queries[of], reach[of], relax)
            visit(right, of[nearer & to_right])
            visit(left, of[~nearer & to_left])

        if len(self.points) and n:
            visit(0, np.arange(n))
        q, p, d = (np.concatenate(c) for c in zip(*found, strict=True)) if found else (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))
        kept = d <= reach[q] ** 2
        return q[kept], p[kept], reach, compared

    def dump(self, **more: np.ndarray) -> bytes:
        out = io.BytesIO()
        short = self.points.astype(np.float32)
        np.savez(out, points=short if (short == self.points).all() else self.points, order=self.order, nodes=self.nodes, radii=self.radii, **more)
        return out.getvalue()

    @classmethod
    def load(cls, data: bytes) -> tuple[Tree, dict[str, np.ndarray]]:
        with np.load(io.BytesIO(data)) as f:
            found = dict(f)
        return cls(found.pop("points").astype(np.float64), *(found.pop(c) for c in ("order", "nodes", "radii"))), found


def valid(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, vec) of the rows that take part: with an id, no null or non-finite component, not all zero."""
    vec = F.col(vec_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), vec.alias("vec"))
    fine = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return rows.filter(F.col("vec_id").isNotNull() & F.col("vec").isNotNull()).filter(fine & F.exists("vec", lambda x: x != 0))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def _read(folder: str, name: str, columns: list[str]) -> pa.Table | None:
    """The rows of a scratch table's partition, read in a task."""
    import pyarrow.parquet as pq
    from pyarrow import fs

    store, path = file_system(f"{folder}/{name}")
    out = []
    for f in store.get_file_info(fs.FileSelector(path, allow_not_found=True)):
        if f.path.endswith(".parquet"):
            with store.open_input_file(f.path) as source:
                out.append(pq.ParquetFile(source).read(columns=columns))
    return pa.concat_tables(out) if out else None


class Trees:
    """The trees of a folder by name, read when needed; the last few are kept."""

    def __init__(self, folder: str, most: int = 4):
        self.folder, self.most, self.kept = folder, most, {}

    def get(self, name: str) -> tuple[Tree, dict[str, np.ndarray]] | None:
        if name not in self.kept:
            found = _read(self.folder, name, ["tree"])
            self.kept[name] = None if found is None else Tree.load(found["tree"][0].as_py())
        self.kept[name] = self.kept.pop(name)
        while len(self.kept) > self.most:
            self.kept.pop(next(iter(self.kept)))
        return self.kept[name]


class Router:
    """Sends vectors to cells by the stored upper trees; lengths that are no more than a shard have one cell, 0."""

    def __init__(self, folder: str, large: dict[int, int]):
        self.trees, self.large = Trees(folder), large

    def cells(self, x: np.ndarray, reach: np.ndarray | None = None, relax: float = 1.0) -> list[tuple[int, np.ndarray]]:
        size = x.shape[1]
        if size not in self.large or (found := self.trees.get(f"size={size}")) is None:
            return [(0, np.arange(len(x)))]
        return found[0].leaves(x, reach, relax)


def fit_cells(rows: DataFrame, large: dict[int, int], rows_per_shard: int, sample_rows: int) -> str:
    """Fit the upper tree of each vector length in ``large`` (length: rows) on at most about ``sample_rows`` distinct vectors; returns their folder."""
    folder = scratch_path(rows.sparkSession, "vp-cells")
    of = F.when(F.lit(False), 0.0)
    for size, n in large.items():
        of = of.when(F.col("size") == size, sample_rows / n)
    picked = rows.filter(F.pmod(F.xxhash64("vec"), F.lit(1_000_003)) / 1_000_003.0 < of).select("size", "vec").distinct()

    def build(key, table):
        points = _matrix(table.combine_chunks().column("vec").chunk(0))
        cells = min(-(-large[key[0].as_py()] // rows_per_shard), max(1, len(points) // SAMPLE_PER_CELL))
        return pa.table({"size": pa.array([key[0].as_py()], pa.int32()), "tree": pa.array([Tree.build(points, -(-len(points) // cells)).dump()], pa.binary())})

    picked.groupBy("size").applyInArrow(build, "size int, tree binary").write.partitionBy("size").parquet(folder)
    return folder


def routed(rows: DataFrame, folder: str, large: dict[int, int]) -> DataFrame:
    """(vec_id, vec, size, cell) of every row."""
    schema = T.StructType([*rows.select("vec_id", "vec", "size").schema, T.StructField("cell", T.IntegerType())])

    def run(batches):
        router = Router(folder, large)
        for batch in batches:
            sizes, cell = batch.column(2).to_numpy(), np.zeros(batch.num_rows, dtype=np.int32)
            for size in np.unique(sizes):
                if int(size) in large:
                    at = np.flatnonzero(sizes == size)
                    for c, of in router.cells(_matrix(batch.column(1).take(pa.array(at)))):
                        cell[at[of]] = c
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell)], names=schema.names)

    return rows.select("vec_id", "vec", "size").mapInArrow(run, schema)


def build_index(dealt: DataFrame) -> str:
    """Write one tree per (size, cell, part) of ``dealt``; returns their folder."""
    folder = scratch_path(dealt.sparkSession, "vp-trees")

    def build(key, table):
        table = table.combine_chunks()
        ids, points = table.column("vec_id").to_numpy(), _matrix(table.column("vec").chunk(0))
        seen = np.lexsort((ids, *points.T[::-1]))
        ids, points = ids[seen], points[seen]
        new = np.concatenate(([True], (points[1:] != points[:-1]).any(axis=1)))
        again = np.concatenate(([False], ~new[1:] & (ids[1:] == ids[:-1])))  # rows repeated as a whole count once
        starts = np.flatnonzero(new[~again])
        tree = Tree.build(points[new])
        data = tree.dump(ids=ids[~again], starts=np.append(starts, (~again).sum()), often=np.unique(ids[~again], return_counts=True)[1].max())
        return pa.table({c: pa.array([k.as_py()], pa.int32()) for c, k in zip(("size", "cell", "part"), key, strict=True)} | {"tree": pa.array([data], pa.binary())})

    dealt.groupBy("size", "cell", "part").applyInArrow(build, "size int, cell int, part int, tree binary").write.partitionBy("size", "cell", "part").parquet(folder)
    return folder


def _dealt(df: DataFrame, group: str, to: str, most: int, seed: int) -> tuple[DataFrame, dict[tuple[int, int], int]]:
    """``df`` with ``to``: a part of its (size, group) by a hash of the id, where that has over twice ``most`` rows; and how many parts those have."""
    counts = df.groupBy("size", group).agg(F.count("*").alias("n")).filter(F.col("n") > 2 * most)
    parts = {(r["size"], r[group]): -(-r["n"] // most) for r in counts.collect()}  # one row for 2 * most rows at most
    n = F.lit(1)
    if parts:
        known = F.create_map(*[x for (size, g), k in parts.items() for x in (F.lit(f"{size}-{g}"), F.lit(k))])
        n = F.coalesce(known[F.concat_ws("-", "size", group)], F.lit(1))
    return df.withColumn(to, F.pmod(F.xxhash64("vec_id", F.lit(seed)), n).cast("int")), parts


def nearest(
    vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", every: int = 100, k: int = 10, relax: float = RELAX,
    rows_per_shard: int = ROWS_PER_SHARD, queries_per_block: int = QUERIES_PER_BLOCK, sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """The ``k`` nearest rows found (Euclidean, double precision) of each row whose id ``every`` divides.

    Returns query_id, rank, vec_id, score; nearest first, ties to the smaller id; fewer rows where there
    are fewer candidates. A query's own id is no candidate of it. Vectors that are null, zero or hold a
    null or non-finite component, and rows with a null id, take no part; vectors of different lengths
    never meet. A row that repeats as a whole counts once; an id with several vectors is a query for
    each, and the nearest over all of them are returned. Other columns are not carried. Empty tables give no rows.
    """
    rows = valid(vectors, id_col, vec_col).withColumn("size", F.size("vec"))
    # Vector lengths with more rows than a shard: fewer than there are shards.
    large = {r["size"]: r["n"] for r in rows.groupBy("size").agg(F.count("*").alias("n")).filter(F.col("n") > rows_per_shard).collect()}
    cells = fit_cells(rows, large, rows_per_shard, sample_rows) if large else ""
    placed = routed(rows, cells, large)
    dealt, parts = _dealt(placed, "cell", "part", rows_per_shard, 1)
    folder = build_index(dealt)

    # Queries of neighbouring cells share a block.
    together = max(1, queries_per_block * every // rows_per_shard)
    asking = placed.filter(F.col("vec_id") % every == 0).withColumn("cells", F.floor(F.col("cell") / together).cast("int"))
    asking, _ = _dealt(asking, "cells", "turn", queries_per_block, 2)
    asking = asking.withColumn("block", F.concat_ws("-", "size", "cells", "turn"))
    asked = scratch_path(rows.sparkSession, "queries")

    def bound(batches):
        """Each query's bound in its own cell, and the cells that it admits."""
        router, trees = Router(cells, large), Trees(folder)
        for batch in batches:
            sizes, home = batch.column(3).to_numpy(), batch.column(4).to_numpy()
            reach, admitted = np.full(batch.num_rows, np.inf), [[] for _ in range(batch.num_rows)]
            for size in np.unique(sizes):
                of_size = np.flatnonzero(sizes == size)
                x = _matrix(batch.column(2).take(pa.array(of_size)))
                for c in np.unique(home[of_size]):
                    at = np.flatnonzero(home[of_size] == c)
                    tree, more = trees.get(f"size={size}/cell={c}/part={0}") or (None, None)
                    if tree is not None and len(tree.points) >= k + int(more["often"]):
                        reach[of_size[at]] = tree.search(x[at], k + int(more["often"]), relax)[2]
                for c, of in router.cells(x, reach[of_size], relax):
                    for i in of_size[of].tolist():
                        admitted[i].append(c)
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(reach), pa.array(admitted, pa.list_(pa.int32()))], names=["block", "vec_id", "vec", "size", "reach", "cells"])

    (
        asking.select("block", "vec_id", "vec", "size", "cell").repartition("block").sortWithinPartitions("block", "cell")
        .mapInArrow(bound, "block string, vec_id long, vec array<double>, size int, reach double, cells array<int>").write.partitionBy("block").parquet(asked)
    )
    met = rows.sparkSession.read.schema("vec_id long, vec array<double>, size int, reach double, cells array<int>, block string").parquet(asked)
    pairs = met.select("block", "size", F.explode("cells").alias("cell")).distinct()
    n_parts = F.lit(1)
    if parts:
        n_parts = F.coalesce(F.create_map(*[x for (size, c), n in parts.items() for x in (F.lit(f"{size}-{c}"), F.lit(n))])[F.concat_ws("-", "size", "cell")], F.lit(1))
    pairs = stored(pairs.withColumn("part", F.explode(F.sequence(F.lit(0), n_parts - 1))), "block-cells")
    schema = T.StructType([T.StructField("query_id", T.LongType()), T.StructField("vec_id", T.LongType()), T.StructField("score", T.DoubleType())])

    def run(batches):
        trees = Trees(folder, 1)
        for batch in batches:
            for block, size, cell, part in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found, queries = trees.get(f"size={size}/cell={cell}/part={part}"), _read(asked, f"block={block}", ["vec_id", "vec", "reach", "cells"])
                if found is None or queries is None:
                    continue
                own = queries.filter(pa.array([cell in c for c in queries["cells"].to_pylist()])).combine_chunks()
                (tree, more), asking_ids = found, own["vec_id"].to_numpy()
                ids, starts, x = more["ids"], more["starts"], _matrix(own["vec"].chunk(0))
                at, near, *_ = tree.search(x, min(k + int(more["often"]), len(tree.points)), relax, own["reach"].to_numpy())
                exact = np.sqrt(((tree.points[near] - x[at]) ** 2).sum(axis=1))
                order = np.lexsort((near, exact, at))
                out: list[tuple[int, int, float]] = []
                for group in np.split(order, np.flatnonzero(np.diff(at[order])) + 1):
                    if len(group):
                        q = int(asking_ids[at[group[0]]])
                        some = [(float(exact[g]), int(i)) for g in group for i in ids[starts[near[g]] : min(starts[near[g] + 1], starts[near[g]] + k + 1)] if i != q]
                        out += [(q, i, d) for d, i in sorted(some)[:k]]
                cols = list(zip(*out, strict=True)) if out else [[]] * 3
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.float64()), strict=True)], names=schema.names)

    # Only keys are dealt out here: a task's input is files.
    tasks = pairs.repartition(max(1, min(pairs.count(), 100_000)))
    found = tasks.mapInArrow(run, schema).groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return stored(found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"), "neighbours")

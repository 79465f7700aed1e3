"""Packing along a space-filling curve: neighbours in a sequence are neighbours in content.

A document's ids make a hashed vector of damped counts, which fixed random directions project to few dimensions. The
projections, evened out over the table's own spread, are the cells of a grid whose Hilbert key orders the documents. They
are sorted by ranges of that key, with the id and the row's number behind it, so that copies of one document, which
share a key, are dealt over ranges as any others. A document's place in the whole stream is its place in its range and the ids of
the ranges before it; the stream is cut wherever a sequence is full. What is left at its end is cut into powers of
two, which need no padding.
"""

from __future__ import annotations

import zlib
from array import array

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillstone.llm.packing import VOCABULARY, Encoder
from quillstone.llm.shared import drop, stored

CAPACITY = 2048
END_ID = 1
DIMENSIONS = 4
BITS = 15
BUCKETS = 1 << 12
SEED = 42


def directions(dimensions: int = DIMENSIONS) -> np.ndarray:
    """The directions that hashed vectors are projected on, one row per bucket."""
    return np.random.default_rng(SEED).normal(size=(BUCKETS, dimensions))


def projection(ids: np.ndarray, to: np.ndarray) -> np.ndarray:
    """The projections of a document's hashed vector, of unit length; none of no ids is zero."""
    bucket = (ids * np.uint32(0x9E3779B1)) >> np.uint32(32 - BUCKETS.bit_length() + 1)
    counts = np.bincount(bucket, minlength=BUCKETS)
    held = np.flatnonzero(counts)
    weight = 1 + np.log(counts[held])
    return weight @ to[held] / max(np.sqrt(weight @ weight), 1e-300)


def hilbert(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """The place on the Hilbert curve of each row of cells (whole numbers below 2^bits; dimensions times bits up to 63)."""
    x = [c.astype(np.int64) for c in cells.T]
    n = len(x)
    for level in range(bits - 1, 0, -1):  # turn each level's cube so that the curve goes on through it
        q, below = 1 << level, (1 << level) - 1
        for i in range(n):
            up = x[i] & q > 0
            swap = np.where(up, 0, (x[0] ^ x[i]) & below)
            x[0] = np.where(up, x[0] ^ below, x[0] ^ swap)
            x[i] = x[i] ^ swap if i else x[0]
    for i in range(1, n):
        x[i] = x[i] ^ x[i - 1]
    turn = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        turn = np.where(x[n - 1] & (1 << level) > 0, turn ^ ((1 << level) - 1), turn)
    key = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for i in range(n):
            key = key << 1 | ((x[i] ^ turn) >> level & 1)
    return key


def cells_of(values: np.ndarray, mean: np.ndarray, spread: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Grid cells of projections: even ones if each dimension is about normal."""
    z = (values - mean) / np.where(spread > 0, spread, 1.0)
    even = 1 / (1 + np.exp(-1.702 * np.clip(z, -20, 20)))
    return np.minimum((even * (1 << bits)).astype(np.int64), (1 << bits) - 1)


def encoded(docs: DataFrame, id_col: str, text_col: str, vocabulary: str, end_id: int, dimensions: int) -> DataFrame:
    """doc_id, n, ids (four or two bytes each) and at (projections) of every row."""
    schema = T.StructType([T.StructField("doc_id", docs.schema[id_col].dataType), T.StructField("n", T.LongType()), T.StructField("ids", T.BinaryType()), T.StructField("at", T.ArrayType(T.DoubleType()))])

    def run(batches):
        encoder, to = Encoder(vocabulary), directions(dimensions)
        for batch in batches:
            rows = []
            for text in batch.column(1).to_pylist():
                ids = encoder.ids(text or "")
                ids.append(end_id)
                kept = np.frombuffer(array("I", ids), np.uint32)  # much sooner made than from the list
                rows.append((len(ids), kept.astype("<u2" if kept.max() < 1 << 16 else "<u4").tobytes(), projection(kept[:-1], to)))
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 3
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.binary(), pa.list_(pa.float64())), strict=True))], names=schema.names)

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema)


def along_curve(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY, end_id: int = END_ID, dimensions: int = DIMENSIONS) -> DataFrame:
    """range, at (ids of the range before the document), doc_id, n, ids and key of every row, stored; ranges follow each other along the curve."""
    marked = stored(encoded(docs, id_col, text_col, vocabulary, end_id, dimensions).select(F.monotonically_increasing_id().alias("row"), "*"), "curve-ids")
    bits = min(BITS, 63 // dimensions)
    spread = marked.agg(*(f(F.get("at", F.lit(i))).alias(f"{f.__name__}{i}") for f in (F.mean, F.stddev_pop) for i in range(dimensions))).first()  # a mean and a spread per dimension
    mean, by = np.array(spread[:dimensions], dtype=float), np.array(spread[dimensions:], dtype=float)

    @F.pandas_udf("long")
    def key(at: pd.Series) -> pd.Series:
        return pd.Series(hilbert(cells_of(np.stack(at.to_numpy()), mean, by, bits), bits)) if len(at) else pd.Series([], dtype="int64")

    order = ("key", "doc_id", "row")
    dealt = marked.select(key("at").alias("key"), "doc_id", "row", "n", "ids").repartitionByRange(*order).sortWithinPartitions(*order)
    schema = T.StructType([T.StructField("range", T.IntegerType()), T.StructField("at", T.LongType()), *(f for f in dealt.schema if f.name != "row")])

    def place(batches):
        number, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            own = batch.drop_columns(["row"])
            n = own.column("n").to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(n), number, np.int32)), pa.array(at + np.cumsum(n) - n), *own.columns], names=schema.names)
            at += int(n.sum())

    placed = stored(dealt.mapInArrow(place, schema), "curve-order")
    drop(marked)
    return placed


def tail_cuts(rest: int) -> list[int]:
    """Where a rest is cut, from its start: after each of its powers of two, the largest first."""
    out, at = [], 0
    for bit in range(rest.bit_length() - 1, -1, -1):
        if rest >> bit & 1:
            at += 1 << bit
            out.append(at)
    return out


def pack_along_curve(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, vocabulary: str = VOCABULARY, end_id: int = END_ID, dimensions: int = DIMENSIONS, with_ids: bool = False,
) -> DataFrame:
    """Pack the ids of all rows into sequences of ``capacity`` ids, neighbours along the curve together.

    Returns one row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset; with ``with_ids`` also the piece's ids (array).
    A document is its ids and ``end_id``; every id lies in one piece. All sequences are full, but for up to log2(capacity) at the end,
    which hold a power of two each. Null text counts as empty (the end id alone). Null ids are kept; copies and repeated rows stand
    side by side, by id; texts of any length are cut where sequences end; an empty table gives no rows; other columns are not carried.
    """
    placed = along_curve(docs, id_col, text_col, vocabulary, end_id, dimensions)
    totals = sorted((r["range"], r["n"]) for r in placed.groupBy("range").agg(F.sum("n").alias("n")).collect())  # a row per range
    before = dict(zip((r for r, _ in totals), np.cumsum([0, *(n for _, n in totals)])[:-1].tolist(), strict=True))
    total = sum(n for _, n in totals)
    full, rest = divmod(total, capacity)
    tail = tail_cuts(rest)
    schema = T.StructType([
        T.StructField("doc_id", docs.schema[id_col].dataType), *(T.StructField(c, T.LongType()) for c in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")),
        *([T.StructField("ids", T.ArrayType(T.LongType()))] if with_ids else []),
    ])

    def cut(batches):
        for batch in batches:
            take, rows, own = [], [], []
            for i, (part, at, n, packed) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("range", "at", "n", "ids")), strict=True)):
                ids = np.frombuffer(packed, "<u4" if len(packed) == 4 * n else "<u2").astype("<u4")
                here, start = before[part] + at, 0
                while start < n:
                    sequence, offset = divmod(here + start, capacity)
                    room = capacity - offset
                    if sequence == full:  # the rest of the stream
                        k = int(np.searchsorted(tail, offset, side="right"))
                        sequence, offset, room = full + k, offset - (tail[k - 1] if k else 0), tail[k] - offset
                    length = min(room, n - start)
                    piece = ids[start : start + length]
                    take.append(i)
                    rows.append((start, length, zlib.crc32(piece.tobytes()), n, sequence, offset))
                    if with_ids:
                        own.append(piece.tolist())
                    start += length
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 6
            more = [pa.array(own, pa.list_(pa.int64()))] if with_ids else []
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(take, pa.int64())), *(pa.array(c, pa.int64()) for c in cols), *more], names=schema.names)

    return placed.drop("key").mapInArrow(cut, schema)

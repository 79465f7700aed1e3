"""Removal of lines that recur across documents, by a sharded minimal perfect hash.

Lines are normalised and hashed to 128 bits where the documents are read. A grouped count finds the
hashes in enough documents; these are dealt to shards, and each shard gets a minimal perfect hash
with three arrays beside it: the other half of the hash as fingerprint, the number of documents, and
the largest id. Shards are files in the shared folder. The documents are then read again and probe
the arrays; no line joins anything. A line that recurs is in the index; any other is told apart by
its 64-bit fingerprint.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillstone.llm.shared import SPACE, file_system, scratch_path, stored

MIN_CHARS = 40
MIN_DOCS = 5
KEYS_PER_SHARD = 1_000_000
CACHED_BYTES = 96 << 20
#: Texts that a task gathers before it probes, so that it goes through the shards once for all of them.
POOL_BYTES = 24 << 20
LEVELS = 40


def line_key(line: str, min_chars: int = MIN_CHARS) -> bytes | None:
    """The normalised line in UTF-8, or None if it is too short to count."""
    if len(line) < min_chars:
        return None
    data = line.encode("utf-8").strip(SPACE)
    if len(data) < min_chars or len(data) < 4 * min_chars and len(data.decode("utf-8")) < min_chars:
        return None
    return data.lower()  # of bytes: A-Z only


def _digest(key: bytes) -> tuple[int, int]:
    import xxhash

    h = xxhash.xxh3_128_intdigest(key)
    return (h >> 64) - (1 << 63), (h & ((1 << 64) - 1)) - (1 << 63)


class PerfectHash:
    """A minimal perfect hash of 64-bit keys: levels of bit arrays, each holding the keys that met no other there.

    Bits stay packed, with a running count for each word of 64. Equal keys never part: what is left after
    ``LEVELS`` levels has no place here.
    """

    def __init__(self, levels: list[tuple[int, np.ndarray]]):
        self.levels, self.before, self.size = levels, [], 0
        for _, words in levels:
            ones = np.cumsum(np.bitwise_count(words), dtype=np.int64)
            self.before.append((ones - np.bitwise_count(words) + self.size).astype(np.uint32))
            self.size += int(ones[-1])

    @property
    def nbytes(self) -> int:
        return sum(words.nbytes * 3 // 2 for _, words in self.levels)

    @staticmethod
    def slot(keys: np.ndarray, level: int, width: int) -> np.ndarray:
        x = keys.astype(np.uint64) ^ np.uint64((0x9E3779B97F4A7C15 * (level + 1)) & 0xFFFFFFFFFFFFFFFF)
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
        return ((x ^ (x >> np.uint64(31))) % np.uint64(width)).astype(np.int64)

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        levels, left = [], keys
        while len(left) and len(levels) < LEVELS:
            width = 2 * len(left) + 1
            at = cls.slot(left, len(levels), width)
            alone = np.bincount(at, minlength=-(-width // 64) * 64) == 1
            levels.append((width, np.packbits(alone, bitorder="little").view("<u8")))
            left = left[~alone[at]]
        return cls(levels)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Each key's place in 0..size-1, or -1; a key that was not built in may get any place."""
        out, todo = np.full(len(keys), -1, dtype=np.int64), np.arange(len(keys))
        for level, (width, words) in enumerate(self.levels):
            if not len(todo):
                break
            at = self.slot(keys[todo], level, width)
            word, bit = words[at >> 6], np.uint64(1) << (at & 63).astype(np.uint64)
            hit = (word & bit) != 0
            out[todo[hit]] = self.before[level][at[hit] >> 6] + np.bitwise_count(word[hit] & (bit[hit] - np.uint64(1)))
            todo = todo[~hit]
        return out

    def dump(self) -> bytes:
        return b"".join(width.to_bytes(8, "little") + words.tobytes() for width, words in self.levels)

    @classmethod
    def load(cls, data: bytes) -> PerfectHash:
        levels, at = [], 0
        while at < len(data):
            width = int.from_bytes(data[at : at + 8], "little")
            levels.append((width, np.frombuffer(data, "<u8", -(-width // 64), at + 8)))
            at += 8 + levels[-1][1].nbytes
        return cls(levels)


def line_hashes(docs: DataFrame, id_col: str, text_col: str, min_chars: int = MIN_CHARS) -> DataFrame:
    """(hi, lo, doc_id) of each distinct countable line of each row."""
    schema = T.StructType([T.StructField("hi", T.LongType()), T.StructField("lo", T.LongType()), T.StructField("doc_id", T.LongType())])

    def run(batches):
        for batch in batches:
            hi, lo, ids = [], [], []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if doc is None:
                    continue
                keys = {k for k in (line_key(x, min_chars) for x in (text or "").split("\n")) if k is not None}
                for a, b in map(_digest, keys):
                    hi.append(a)
                    lo.append(b)
                    ids.append(doc)
            yield pa.RecordBatch.from_arrays([pa.array(hi, pa.int64()), pa.array(lo, pa.int64()), pa.array(ids, pa.int64())], names=schema.names)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema)


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, keys_per_shard: int = KEYS_PER_SHARD) -> tuple[str, int]:
    """Write the shards of the recurring lines; returns their folder and number."""
    spark = docs.sparkSession
    counts = line_hashes(docs, id_col, text_col, min_chars).groupBy("hi", "lo").agg(F.countDistinct("doc_id").alias("n_docs"), F.max("doc_id").alias("last"))
    frequent = stored(counts.filter(F.col("n_docs") >= min_docs), "lines")
    shards = max(1, -(-frequent.count() // keys_per_shard))
    folder = scratch_path(spark, "line-index")

    def write(key, frame):
        import pandas as pd

        hi, lo = frame["hi"].to_numpy(np.int64), frame["lo"].to_numpy(np.int64)
        index = PerfectHash.build(lo.view(np.uint64) ^ hi.view(np.uint64))
        place = index.find(lo.view(np.uint64) ^ hi.view(np.uint64))
        # Hashes whose halves mix to the same key stand behind the others, found by all their bits.
        rest = np.flatnonzero(place < 0)
        place[rest] = index.size + np.arange(len(rest))
        marks, docs_in, last = (np.empty(len(frame), dtype=np.int64) for _ in range(3))
        marks[place], docs_in[place], last[place] = lo, frame["n_docs"].to_numpy(), frame["last"].to_numpy()
        return pd.DataFrame({
            "shard": [int(key[0])], "mph": [index.dump()], "marks": [marks.tobytes()], "counts": [np.minimum(docs_in, 2**32 - 1).astype("<u4").tobytes()], "last": [last.tobytes()], "rest": [hi[rest].tobytes()],
        })

    (
        frequent.withColumn("shard", F.pmod("hi", F.lit(shards)).cast("int"))
        .groupBy("shard").applyInPandas(write, "shard int, mph binary, marks binary, counts binary, last binary, rest binary")
        .write.partitionBy("shard").parquet(folder)
    )
    return folder, shards


class Shard:
    def __init__(self, row: dict):
        self.index = PerfectHash.load(row["mph"])
        self.marks, self.counts, self.last = np.frombuffer(row["marks"], np.int64), np.frombuffer(row["counts"], "<u4"), np.frombuffer(row["last"], np.int64)
        self.rest = {(h, int(self.marks[self.index.size + i])): self.index.size + i for i, h in enumerate(np.frombuffer(row["rest"], np.int64).tolist())}
        self.nbytes = self.index.nbytes + 20 * len(self.marks)

    def find(self, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
        """Each hash's place in the arrays, or -1."""
        place = self.index.find(lo.view(np.uint64) ^ hi.view(np.uint64))
        place[(place >= 0) & (self.marks[place] != lo)] = -1
        if self.rest:
            for i in np.flatnonzero(place < 0).tolist():
                place[i] = self.rest.get((int(hi[i]), int(lo[i])), -1)
        return place


class Index:
    """The shards, read when needed; the least used go when the kept ones exceed ``most`` bytes."""

    def __init__(self, folder: str, shards: int, most: int = CACHED_BYTES):
        self.folder, self.shards, self.most, self.kept = folder, shards, most, {}

    def shard(self, k: int) -> Shard | None:
        if k in self.kept:
            self.kept[k] = self.kept.pop(k)
            return self.kept[k]
        import pyarrow.parquet as pq
        from pyarrow import fs

        store, path = file_system(f"{self.folder}/shard={k}")
        found = None
        for f in store.get_file_info(fs.FileSelector(path, allow_not_found=True)):
            if f.path.endswith(".parquet"):
                with store.open_input_file(f.path) as source:
                    found = Shard(pq.ParquetFile(source).read(columns=["mph", "marks", "counts", "last", "rest"]).to_pylist()[0])
        self.kept[k] = found
        while len(self.kept) > 1 and sum(s.nbytes for s in self.kept.values() if s) > self.most:
            self.kept.pop(next(iter(self.kept)))
        return found

    def probe(self, hi: np.ndarray, lo: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each line hash: number of documents (0: not in the index) and the largest id. Goes through the shards once."""
        counts, last = np.zeros(len(hi), dtype=np.int64), np.zeros(len(hi), dtype=np.int64)
        of = hi % self.shards
        order = np.argsort(of, kind="stable")
        for at in np.split(order, np.flatnonzero(np.diff(of[order])) + 1):
            if not len(at) or (shard := self.shard(int(of[at[0]]))) is None or not len(shard.marks):
                continue
            place = shard.find(hi[at], lo[at])
            at, place = at[place >= 0], place[place >= 0]
            counts[at], last[at] = shard.counts[place], shard.last[place]
        return counts, last


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, keys_per_shard: int = KEYS_PER_SHARD) -> DataFrame:
    """All columns of ``docs`` with recurring lines cut from the text, and ``n_lines``, ``n_dropped``.

    A line's key is the line without ASCII white space at its ends, A-Z in lower case. Keys of at
    least ``min_chars`` code points in at least ``min_docs`` distinct ids lose all their lines but
    those of the largest id. Null text counts as empty: one line, which stays. Rows with the same id
    count as one document. Rows with a null id are counted nowhere and lose their recurring lines.
    Columns named n_lines or n_dropped are replaced. Empty tables stay empty. Ids must be integers.
    """
    folder, shards = build_index(docs, id_col, text_col, min_chars, min_docs, keys_per_shard)
    keep = [c for c in docs.columns if c not in (text_col, "n_lines", "n_dropped")]
    schema = T.StructType([*(docs.schema[c] for c in keep), T.StructField(text_col, T.StringType()), T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())])

    def hashed(texts):
        """Row, line and hash of every countable line."""
        rows, lines, hi, lo = [], [], [], []
        for i, text in enumerate(texts.to_pylist()):
            for j, line in enumerate((text or "").split("\n")):
                if (key := line_key(line, min_chars)) is not None:
                    a, b = _digest(key)
                    rows.append(i)
                    lines.append(j)
                    hi.append(a)
                    lo.append(b)
        return [np.array(x, dtype=np.int64) for x in (rows, lines, hi, lo)]

    def cut(batch, rows, lines, counts, last):
        ids, texts = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in (id_col, text_col))
        gone: dict[int, set[int]] = {}
        for k in np.flatnonzero(counts >= min_docs).tolist():
            i = int(rows[k])
            if ids[i] is None or last[k] != ids[i]:
                gone.setdefault(i, set()).add(int(lines[k]))
        n_lines = [(t or "").count("\n") + 1 for t in texts]
        kept = [(t or "") if i not in gone else "\n".join([x for j, x in enumerate(t.split("\n")) if j not in gone[i]]) for i, t in enumerate(texts)]
        return pa.RecordBatch.from_arrays(
            [*(batch.column(batch.schema.get_field_index(c)) for c in keep), pa.array(kept, pa.string()), pa.array(n_lines, pa.int64()), pa.array([len(gone.get(i, ())) for i in range(len(texts))], pa.int64())],
            names=schema.names,
        )

    def run(batches):
        index, pool = Index(folder, shards), []

        def probed():
            counts, last = index.probe(*(np.concatenate([p[k] for p in pool]) for k in (3, 4)))
            ends = np.cumsum([0, *(len(p[1]) for p in pool)])
            for (batch, rows, lines, *_), a, b in zip(pool, ends[:-1], ends[1:], strict=True):
                yield cut(batch, rows, lines, counts[a:b], last[a:b])

        for batch in batches:
            pool.append((batch, *hashed(batch.column(batch.schema.get_field_index(text_col)))))
            if sum(p[0].nbytes for p in pool) >= POOL_BYTES:
                yield from probed()
                pool = []
        if pool:
            yield from probed()

    return docs.select(*(F.col(f"`{c}`") for c in keep), F.col(text_col).cast("string").alias(text_col)).mapInArrow(run, schema)


def digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """doc_id, n_lines, n_dropped and kept_sha256 of each document after the removal."""
    out = dedup_lines(docs.select(F.col(id_col), F.col(text_col)), id_col, text_col, **options)
    return out.select(F.col(id_col).alias("doc_id"), "n_lines", "n_dropped", F.sha2(text_col, 256).alias("kept_sha256"))


"""Document fingerprints by one-permutation MinHash.

All shingle hashes of a text are computed once and fall into bins by their high bits; each bin keeps
its smallest. An empty bin takes the value of the first filled bin in its own fixed pseudo-random
sequence of bins (optimal densification), the same for every text. The low bits of the bins' values
are the fingerprint; two unequal values agree by chance with probability 2**-bits, which the estimate
takes out.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WORDS = 5
BINS = 512
BITS = 4
SEED = 1


def _mix(x: np.ndarray) -> np.ndarray:
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def shingle_hashes(text: str, words: int = WORDS) -> np.ndarray:
    """One hash per shingle of ``words`` words (A-Z in lower case, split at ASCII white space)."""
    import xxhash

    parts = text.encode("utf-8").lower().split()
    if not parts:
        return np.empty(0, dtype=np.uint64)
    each = np.array(list(map(xxhash.xxh3_64_intdigest, parts)), dtype=np.uint64)
    n = max(1, len(each) - words + 1)
    total = np.full(n, len(parts) if len(parts) < words else words, dtype=np.uint64)
    for k in range(min(words, len(each))):
        total = _mix(total * np.uint64(0x9E3779B97F4A7C15) + each[k : k + n])
    return total


def _sequences(bins: int, tries: int, start: int) -> np.ndarray:
    """Rows ``start..start+tries`` of the bins' pseudo-random sequences."""
    at = np.arange(start, start + tries, dtype=np.uint64)[:, None] * np.uint64(bins) + np.arange(bins, dtype=np.uint64)[None, :]
    return (_mix((at + np.uint64(SEED)) * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(bins)).astype(np.int64)


class Sketcher:
    def __init__(self, words: int = WORDS, bins: int = BINS, bits: int = BITS):
        if bins & (bins - 1) or bits not in (1, 2, 4, 8) or bins * bits % 8:
            raise ValueError("bins must be a power of two, bits 1, 2, 4 or 8")
        self.words, self.bins, self.bits = words, bins, bits
        self.shift = np.uint64(64 - bins.bit_length() + 1)
        self.step, self.blocks = 64, []
        self.salts = _mix(np.arange(1, bins + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))

    def _block(self, k: int) -> np.ndarray:
        if k < 32:
            while len(self.blocks) <= k:
                self.blocks.append(_sequences(self.bins, self.step, len(self.blocks) * self.step))
            return self.blocks[k]
        return _sequences(self.bins, self.step, k * self.step)

    def sketch(self, text: str) -> np.ndarray | None:
        """Low bits of each bin, or None for a text without words."""
        hashes = shingle_hashes(text, self.words)
        if not len(hashes):
            return None
        hashes.sort()
        bins = (hashes >> self.shift).astype(np.int64)
        first = np.concatenate(([True], bins[1:] != bins[:-1]))
        values, filled = np.zeros(self.bins, dtype=np.uint64), np.zeros(self.bins, dtype=bool)
        values[bins[first]] = hashes[first]
        filled[bins[first]] = True
        empty, k = np.flatnonzero(~filled), 0
        if first.sum() == 1:
            values[:], empty = hashes[0], empty[:0]
        while len(empty):
            tries = self._block(k)[:, empty]
            hit = filled[tries]
            at, ok = hit.argmax(axis=0), hit.any(axis=0)
            values[empty[ok]] = values[tries[at[ok], np.flatnonzero(ok)]]
            empty, k = empty[~ok], k + 1
        # The bin is mixed in, so that bins with one value do not all agree by chance at once.
        return (_mix(values ^ self.salts) & np.uint64((1 << self.bits) - 1)).astype(np.uint8)

    def text(self, sketch: np.ndarray | None) -> str:
        """The packed low bits in hex, the first bin highest; a text without words has an empty one."""
        if sketch is None:
            return ""
        bits = np.unpackbits(sketch[:, None], axis=1)[:, 8 - self.bits :]
        return np.packbits(bits.ravel()).tobytes().hex()

    def likeness(self, a: np.ndarray | None, b: np.ndarray | None) -> float:
        """Estimated share of common shingles; of two texts without words 1, of one such text 0."""
        if a is None or b is None:
            return float(a is None and b is None)
        chance = 1 / (1 << self.bits)
        return float(min(1.0, max(0.0, ((a == b).mean() - chance) / (1 - chance))))


def fingerprints(docs: DataFrame, text_col: str = "text", out_col: str = "fingerprint", words: int = WORDS, bins: int = BINS, bits: int = BITS) -> DataFrame:
    """All columns of ``docs`` and the fingerprint of its text (null: empty)."""
    schema = T.StructType([*(f for f in docs.schema if f.name != out_col), T.StructField(out_col, T.StringType())])
    keep = [f.name for f in docs.schema if f.name != out_col]

    def run(batches):
        sketcher = Sketcher(words, bins, bits)
        for batch in batches:
            found = [sketcher.text(sketcher.sketch(t or "")) for t in batch.column(batch.schema.get_field_index(text_col)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(c)) for c in keep), pa.array(found, pa.string())], names=schema.names)

    return docs.mapInArrow(run, schema)


def _chunked(docs: DataFrame, bounds: np.ndarray, wanted: dict[int, list[int]] | None, with_text: bool) -> DataFrame:
    """(chunk, tail, key, doc_id[, text]): each row in its range of ids, and once more as tail of ``wanted[key]``'s ranges."""
    fields = [T.StructField("chunk", T.IntegerType()), T.StructField("tail", T.IntegerType()), T.StructField("key", T.LongType()), T.StructField("doc_id", T.LongType())]
    schema = T.StructType(fields + [T.StructField("text", T.StringType())] * with_text)

    def run(batches):
        for batch in batches:
            ids = batch.column(0)
            key = ids.fill_null(-(1 << 63)).to_numpy(zero_copy_only=False)
            chunk = np.searchsorted(bounds, key, side="right").astype(np.int32)
            at, tail = np.arange(len(key)), np.zeros(len(key), dtype=np.int32)
            if wanted:
                more = [(i, c) for i in np.flatnonzero(np.isin(key, np.fromiter(wanted, np.int64, len(wanted)))).tolist() for c in wanted[int(key[i])]]
                if more:
                    at = np.concatenate((at, [i for i, _ in more]))
                    chunk = np.concatenate((chunk, [c for _, c in more])).astype(np.int32)
                    tail = np.concatenate((tail, np.ones(len(more), dtype=np.int32)))
            take = pa.array(at)
            cols = [pa.array(chunk), pa.array(tail), pa.array(key[at]), ids.take(take)]
            if with_text:
                cols.append(batch.column(1).take(take))
            yield pa.RecordBatch.from_arrays(cols, names=schema.names)

    return docs.select("doc_id", *["text"] * with_text).mapInArrow(run, schema)


def edit_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranges: int | None = None, words: int = WORDS, bins: int = BINS, bits: int = BITS) -> DataFrame:
    """Fingerprints of each text and of its edit, and their likeness.

    The edit replaces the last floor(n_chars / 2) code points by as many first ones (or all) of the next
    row in ascending id; after the last row comes the first. Rows of equal ids follow each other by text;
    null ids come first. Null text counts as empty. Returns doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next. An empty table gives no rows; other columns are not
    carried. Ids must be integers.

    Rows are dealt out by ranges of ids, and each range also gets the row that follows it, so the
    texts move once and no range waits for another.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    ranges = ranges or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    shares = F.array(*(F.lit(i / ranges) for i in range(1, ranges)))
    cuts = rows.agg(F.percentile_approx("doc_id", shares, 4 * ranges)).first()[0] if ranges > 1 else []
    bounds = np.unique(np.array(cuts or [], dtype=np.int64))
    heads = {r["chunk"]: r["key"] for r in _chunked(rows, bounds, None, False).groupBy("chunk").agg(F.min("key").alias("key")).collect()}  # ``ranges`` rows at most
    wanted: dict[int, list[int]] = {}
    order = sorted(heads)
    for here, after in zip(order, order[1:] + order[:1], strict=True):
        wanted.setdefault(heads[after], []).append(here)
    dealt = _chunked(rows, bounds, wanted, True).repartition("chunk").sortWithinPartitions("chunk", "tail", "key", "text")
    schema = T.StructType([
        T.StructField("doc_id", docs.schema[id_col].dataType), T.StructField("n_chars", T.LongType()), T.StructField("edited_sha256", T.StringType()), T.StructField("fingerprint", T.StringType()),
        T.StructField("edited_fingerprint", T.StringType()), T.StructField("near_edited", T.DoubleType()), T.StructField("near_next", T.DoubleType()),
    ])
    kind = {"bigint": pa.int64(), "int": pa.int32()}[docs.schema[id_col].dataType.simpleString()]

    def run(batches):
        sketcher, before = Sketcher(words, bins, bits), None
        for batch in batches:
            out = []
            for chunk, tail, _, doc, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if tail and (before is None or before[0] != chunk):
                    continue  # a further row with the id of the one that follows
                sketch = sketcher.sketch(text)
                if before is not None and before[0] == chunk:
                    _, last, old, own = before
                    half = len(old) // 2
                    edited = old[: len(old) - half] + text[:half]
                    new = own if edited == old else sketcher.sketch(edited)
                    out.append((last, len(old), hashlib.sha256(edited.encode("utf-8")).hexdigest(), sketcher.text(own), sketcher.text(new), sketcher.likeness(own, new), sketcher.likeness(own, sketch)))
                before = None if tail else (chunk, doc, text, sketch)
            if out:
                cols = list(zip(*out, strict=True))
                types = (kind, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=schema.names)

    return dealt.mapInArrow(run, schema)

"""Best-fit packing of token sequences by minimum bin slack.

A sequence's best filling depends only on which lengths are available, so the search runs on the
histogram of lengths (at most ``capacity`` entries) and not on documents. Each step fixes the longest
piece left, finds by a bitset subset-sum the fullest combination for the rest of the sequence, and
uses that combination as often as the counts allow, which is what repeating the step would do. The
outcome is a short list of rank ranges per length; each piece finds its place from its rank among the
pieces of its length.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillstone.llm.shared import stored

VOCABULARY = "byte_bpe_50k"
END_ID = 2
CAPACITY = 1024


def _tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """Ids of the byte-level vocabulary.

    The rank form of the vocabulary gives the ids of the JSON form several times faster, but for the
    JSON form's added tokens: a text that holds one goes through the JSON form, as does a text that the
    rank form cannot take (its matcher overflows on extremely long runs).
    """

    def __init__(self, vocabulary: str = VOCABULARY):
        import base64
        import json

        import public_tokenizers
        import tiktoken

        self.vocabulary = vocabulary
        with open(_tokenizer_file(f"{vocabulary}.tiktoken"), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.fast = tiktoken.Encoding(vocabulary, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        with open(_tokenizer_file(f"{vocabulary}.json"), encoding="utf-8") as f:
            self.added = [t["content"] for t in json.load(f)["added_tokens"]]
        self.slow = None

    def ids(self, text: str) -> list[int]:
        if not any(t in text for t in self.added):
            try:
                return self.fast.encode_ordinary(text)
            except BaseException as error:
                if type(error).__name__ != "PanicException" and not isinstance(error, ValueError):
                    raise
        if self.slow is None:
            from tokenizers import Tokenizer

            self.slow = Tokenizer.from_file(_tokenizer_file(f"{self.vocabulary}.json"))
        return self.slow.encode(text, add_special_tokens=False).ids


def _cut(total: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces: full ones, but for a shorter first one."""
    if total <= capacity:
        return [(0, total)]
    first = total % capacity or capacity
    return [(0, first)] + [(s, capacity) for s in range(first, total, capacity)]


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, vocabulary: str = VOCABULARY, end_id: int = END_ID) -> DataFrame:
    """One row per piece of each row's ids, with its rank among its task's pieces of the same length."""
    id_type = docs.schema[id_col].dataType
    schema = T.StructType([
        T.StructField("doc_id", id_type), T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()), T.StructField("shard", T.IntegerType()), T.StructField("local_rank", T.LongType()),
    ])

    def encode(batches):
        encoder, shard = Encoder(vocabulary), TaskContext.get().partitionId()
        seen = [0] * (capacity + 1)
        for batch in batches:
            # Ids may be of any type: the column is taken by position, not converted.
            at, rows = [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                ids = encoder.ids(text or "")
                ids.append(end_id)
                packed = np.asarray(ids, dtype="<u4").tobytes()
                for k, (start, length) in enumerate(_cut(len(ids), capacity)):
                    at.append(i)
                    rows.append((k, start, length, zlib.crc32(packed[4 * start : 4 * (start + length)]), shard, seen[length]))
                    seen[length] += 1
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 6
            kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), *(pa.array(c, t) for c, t in zip(cols, kinds, strict=True))], names=schema.names)

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(encode, schema)


def fullest(counts: list[int], room: int) -> dict[int, int]:
    """Lengths (with multiplicities) of the fullest combination in ``room``, the longest pieces preferred."""
    reach, limit, steps = 1, (1 << (room + 1)) - 1, []
    for length in range(room, 0, -1):
        left, chunk = min(counts[length], room // length), 1
        while left:
            take = min(chunk, left)
            steps.append((length, take, reach))
            reach |= (reach << (length * take)) & limit
            left, chunk = left - take, chunk * 2
        if reach >> room & 1:
            break
    target, found = reach.bit_length() - 1, {}
    for length, take, before in reversed(steps):
        if not before >> target & 1:
            found[length] = found.get(length, 0) + take
            target -= length * take
    return found


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> dict[int, list[tuple[int, int, int, int]]]:
    """For each length, in rank order: (first rank, first sequence, pieces per sequence, offset)."""
    counts, used, out, sequence = [0] * (capacity + 1), [0] * (capacity + 1), {}, 0
    for length, n in histogram.items():
        counts[length] = n
    longest = capacity
    while True:
        while longest and not counts[longest]:
            longest -= 1
        if not longest:
            return out
        counts[longest] -= 1
        pattern = fullest(counts, capacity - longest)
        counts[longest] += 1
        pattern[longest] = pattern.get(longest, 0) + 1
        times, offset = min(counts[n] // m for n, m in pattern.items()), 0
        for length in sorted(pattern, reverse=True):
            m = pattern[length]
            out.setdefault(length, []).append((used[length], sequence, m, offset))
            used[length] += m * times
            counts[length] -= m * times
            offset += m * length
        sequence += times


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, vocabulary: str = VOCABULARY, end_id: int = END_ID) -> DataFrame:
    """Pack the ids of all rows into as few sequences of ``capacity`` ids as minimum bin slack finds.

    Returns one row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset. Null text
    counts as empty (one piece, the end id). Null ids are kept; repeated rows are packed each for
    itself; an empty table gives no rows; other columns of ``docs`` are not carried.
    """
    cut = stored(pieces(docs, id_col, text_col, capacity, vocabulary, end_id), "pieces")
    per_shard = cut.groupBy("shard", "length").agg(F.count("*").alias("n"))
    per_shard = stored(per_shard, "piece-counts")
    histogram = {r["length"]: r["n"] for r in per_shard.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # capacity rows at most
    steps = {n: tuple(np.array(c, dtype=np.int64) for c in zip(*rows, strict=True)) for n, rows in plan(histogram, capacity).items()}
    before = Window.partitionBy("length").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    base = per_shard.select("shard", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = cut.join(base, ["shard", "length"]).select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("local_rank")).alias("rank"))
    schema = T.StructType([*(f for f in ranked.schema if f.name != "rank"), T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def place(batches):
        for batch in batches:
            lengths, ranks = (batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            sequence, offset = np.zeros_like(ranks), np.zeros_like(ranks)
            for length in np.unique(lengths):
                at = np.flatnonzero(lengths == length)
                first, seq0, each, off0 = steps[int(length)]
                k = np.searchsorted(first, ranks[at], side="right") - 1
                inside = ranks[at] - first[k]
                sequence[at] = seq0[k] + inside // each[k]
                offset[at] = off0[k] + inside % each[k] * length
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(sequence), pa.array(offset)], names=schema.names)

    return ranked.mapInArrow(place, schema)

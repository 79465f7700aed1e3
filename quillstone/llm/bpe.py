"""Byte-level BPE encoding and decoding by backtracking over longest dictionary matches.

The bytes of a piece, read as Latin-1 characters, run once through an Aho-Corasick automaton of the
vocabulary, which gives every token that starts at each byte. From the left, the longest token that
is compatible with its left neighbour is taken; where none fits, the last token is taken back and
that boundary is not tried again. Two neighbours are compatible if merging their joined bytes by
rank gives the same two tokens; answers are kept. A sequence in which every token encodes to itself
and all neighbours are compatible is the one that merging by rank makes: no merge crosses any of its
boundaries, and inside them the merges are independent. As no boundary is visited twice, the
work is linear in the piece.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

VOCABULARY = "byte_bpe_multi_50k"


class _Memo(dict):
    """Answers met so far, in two generations: when the young one is full it becomes the old one, so memory is bounded and what recurs stays."""

    def __init__(self, answer, most: int):
        self.answer, self.most, self.old = answer, most // 2, {}

    def __missing__(self, key: str) -> bytes:
        found = self.old.get(key)
        if found is None:
            found = self.answer(key)
        if len(key) <= 64:
            if len(self) >= self.most:
                self.old = dict(self)
                self.clear()
            self[key] = found
        return found


class Codec:
    def __init__(self, vocabulary: str = VOCABULARY, most_pieces: int = 600_000, most_pairs: int = 1_000_000):
        import ahocorasick
        import public_tokenizers
        import regex

        with open(public_tokenizers.path(f"{vocabulary}.tiktoken"), "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.tokens = [b""] * (1 + max(self.ranks.values()))
        for token, rank in self.ranks.items():
            self.tokens[rank] = token
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        self.automaton = ahocorasick.Automaton()
        self.pairs: dict[tuple[int, int], bool] = {}
        self.most_pairs = most_pairs
        for token, rank in self.ranks.items():
            # A token that merging cannot build only ever stands for a whole piece.
            if len(token) <= 2 or self._merge(token) == [rank]:
                self.automaton.add_word(token.decode("latin-1"), (len(token), rank, len(token) - 1))
        self.automaton.make_automaton()
        self.pieces = _Memo(self._piece, most_pieces)
        self.words = _Memo(self._word, most_pieces)
        self.loose = re.compile(r" \s|\s |^ | $")

    def _merge(self, data: bytes) -> list[int]:
        """Ids by merging the pair of lowest rank, the leftmost first; only for a few bytes."""
        parts, ranks = [data[i : i + 1] for i in range(len(data))], self.ranks
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                rank = ranks.get(parts[i] + parts[i + 1])
                if rank is not None and (best is None or rank < best):
                    best, at = rank, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [ranks[p] for p in parts]

    def _compatible(self, left: int, right: int) -> bool:
        known = self.pairs.get((left, right))
        if known is None:
            if len(self.pairs) >= self.most_pairs:
                self.pairs.clear()
            known = self._merge(self.tokens[left] + self.tokens[right]) == [left, right]
            self.pairs[left, right] = known
        return known

    def _piece(self, piece: str) -> bytes:
        data = piece.encode("utf-8")
        whole = self.ranks.get(data)
        ids = [whole] if whole is not None else self.backtrack(data)
        return struct.pack(f"<{len(ids)}I", *ids)

    def _word(self, word: str) -> bytes:
        pieces = self.pieces
        return b"".join([pieces[p] for p in self.pattern.findall(f" {word}")])

    def backtrack(self, data: bytes) -> list[int]:
        starts: list[list[tuple[int, int, int]]] = [[] for _ in data]
        for end, match in self.automaton.iter(data.decode("latin-1")):
            starts[end - match[2]].append(match)  # ends come in order: sizes grow
        n, at, out, dead = len(data), 0, [], bytearray(len(data) + 1)
        tries = [len(starts[0])]
        while at < n:
            options, k = starts[at], tries[-1]
            while k:
                k -= 1
                size, rank, _ = options[k]
                if not dead[at + size] and (not out or self._compatible(out[-1], rank)):
                    tries[-1] = k
                    out.append(rank)
                    at += size
                    tries.append(len(starts[at]) if at < n else 0)
                    break
            else:
                if not out:
                    raise ValueError("the vocabulary lacks single bytes")
                dead[at] = 1
                tries.pop()
                at -= len(self.tokens[out.pop()])
        return out

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers.

        A space between two characters that are no white space always starts a piece, so such texts
        are cut there and the words' ids remembered.
        """
        pieces = self.pieces
        if self.loose.search(text):
            return b"".join([pieces[p] for p in self.pattern.findall(text)])
        first, _, rest = text.partition(" ")
        head = b"".join([pieces[p] for p in self.pattern.findall(first)])
        if not rest:
            return head
        words = self.words
        return head + b"".join([words[w] for w in rest.split(" ")])

    def decode(self, packed: bytes) -> bytes:
        tokens = self.tokens
        return b"".join([tokens[i] for i in np.frombuffer(packed, dtype="<u4").tolist()])


def round_trip(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """Encode every text, then decode the ids.

    Returns doc_id, n_tokens, ids_sha256, decoded_sha256, one row per input row. Null text counts as
    empty (no ids). Null ids and repeated rows are kept, each for itself; texts of any length are encoded whole; an empty table
    gives no rows; other columns are not carried.
    """
    schema = T.StructType([T.StructField("doc_id", docs.schema[id_col].dataType), T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())])

    def run(batches):
        codec = Codec(vocabulary)
        for batch in batches:
            counts, ids, back = [], [], []
            for text in batch.column(1).to_pylist():
                packed = codec.encode(text or "")
                counts.append(len(packed) // 4)
                ids.append(hashlib.sha256(packed).hexdigest())
                back.append(hashlib.sha256(codec.decode(packed)).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(ids, pa.string()), pa.array(back, pa.string())], names=schema.names)

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema)


def encode(docs: DataFrame, text_col: str = "text", out_col: str = "ids", vocabulary: str = VOCABULARY) -> DataFrame:
    """All columns of ``docs`` and the ids of its text (null: empty) as an array."""
    schema = T.StructType([*(f for f in docs.schema if f.name != out_col), T.StructField(out_col, T.ArrayType(T.IntegerType()))])
    keep = [f.name for f in docs.schema if f.name != out_col]

    def run(batches):
        codec = Codec(vocabulary)
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text_col)).to_pylist()
            ids = pa.array([np.frombuffer(codec.encode(t or ""), dtype="<i4") for t in texts], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(c)) for c in keep), ids], names=schema.names)

    return docs.mapInArrow(run, schema)


def decode(docs: DataFrame, ids_col: str = "ids", out_col: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """All columns of ``docs`` and the text of its ids (null: empty); bytes that are no UTF-8 become U+FFFD."""
    schema = T.StructType([*(f for f in docs.schema if f.name != out_col), T.StructField(out_col, T.StringType())])
    keep = [f.name for f in docs.schema if f.name != out_col]

    def run(batches):
        codec = Codec(vocabulary)
        for batch in batches:
            found = batch.column(batch.schema.get_field_index(ids_col)).to_pylist()
            texts = [codec.decode(np.asarray(x or [], dtype="<u4").tobytes()).decode("utf-8", "replace") for x in found]
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(c)) for c in keep), pa.array(texts, pa.string())], names=schema.names)

    return docs.mapInArrow(run, schema)

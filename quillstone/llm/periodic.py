"""Periodic runs: stretches of words that repeat a period, found by comparing a text's words with every shift of themselves.

A run of period q and exponent e or more is a stretch of at least (e - 1) q consecutive places at which the word ids
agree with those q places on. Each shift q up to n / e is tried. A stretch that long holds one of the places
(e - 1) q - 1, 2 (e - 1) q - 1, ..., so these are compared first, of all shifts in one vectorised step (n log n places
in all); only shifts with a hit that its neighbours bear out are compared in full, and the true stretches are run-length coded.
Nothing is lost by that. A stretch is a run if no proper divisor of its shift is a period of it, since with an
exponent of two or more a smaller period divides the shift. A multiple of a known run's period needs no second
look inside that run, so a text of one word alone stays cheap.

Short texts are scanned where they are, without a shuffle. Those that may have more than ``lags`` shifts are numbered and
stored, and their ranges of shifts are dealt over the tasks; each range stands for itself, and what they find is gathered by
text: a text has fewer runs than words.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillstone.llm.shared import stored

MIN_EXPONENT = 4
MIN_LENGTH = 6
LAGS = 4096
#: Places compared at once, for texts of any length.
BLOCK = 1 << 21
BESIDE = 4

RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"
_RUN = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def _needed(q: np.ndarray, exponent: int, least: int) -> np.ndarray:
    """Agreeing places in a row that a run of period q has at least."""
    return np.maximum(least - q, (exponent - 1) * q)


def anchors(n: int, low: int, high: int, exponent: int, least: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(place, shift) of the places to compare first, for shifts from ``low`` to ``high``, in blocks of ascending shifts."""
    q = np.arange(low, high + 1)
    need = _needed(q, exponent, least)
    count = np.maximum(0, (n - q) // need)
    ends = np.cumsum(count)
    at = 0
    while at < len(q):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + BLOCK, side="right")))
        c = count[at:to]
        first = np.repeat(np.cumsum(c) - c, c)
        yield (np.arange(c.sum()) - first + 1) * np.repeat(need[at:to], c) - 1, np.repeat(q[at:to], c)
        at = to


@lru_cache(maxsize=4)
def _table(n: int, exponent: int, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, shift, place + shift) of all shifts of ``n`` words, by the last: a shorter text takes a prefix."""
    place, shift = (np.concatenate(c) for c in zip(*anchors(n, 1, n // exponent, exponent, least), strict=True))
    order = np.lexsort((shift, place + shift))
    return place[order], shift[order], (place + shift)[order]


def _borne_out(ids: np.ndarray, place: np.ndarray, shift: np.ndarray, need: np.ndarray) -> np.ndarray:
    """Which places have ``BESIDE`` agreeing neighbours in a row with them, or all that a run of their shift must have."""
    around = np.zeros(len(place), dtype=np.int64)
    for step in (-1, 1):
        on = np.ones(len(place), dtype=bool)
        for k in range(1, BESIDE + 1):
            x = place + step * k
            on &= (x >= 0) & (x + shift < len(ids))
            on[on] = ids[x[on]] == ids[x[on] + shift[on]]
            around += on
    return around >= np.minimum(BESIDE, need - 1)


def _primitive(ids: np.ndarray, start: int, length: int, q: int) -> int:
    """The smallest period of a stretch that has period q at least twice."""
    part, left, r = ids[start : start + length], q, 2
    while left > 1:
        r = r if r * r <= left else left
        if left % r:
            r += 1
            continue
        left //= r
        d = q // r
        if np.array_equal(part[d:], part[:-d]):
            q = d
    return q


def find_runs(ids: np.ndarray, low: int = 1, high: int | None = None, exponent: int = MIN_EXPONENT, least: int = MIN_LENGTH) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of word ids whose period is from ``low`` to ``high``, by start, then period."""
    n = len(ids)
    high = n // exponent if high is None else min(high, n // exponent)
    if high < low or n < least:
        return []
    if low == 1 and n <= exponent * LAGS and high == n // exponent:
        size = 1 << max(8, (n - 1).bit_length())
        place, shift, last = _table(size, exponent, least)
        cut = np.searchsorted(last, n)
        blocks = [(place[:cut], shift[:cut])]
    else:
        blocks = anchors(n, low, high, exponent, least)
    out: list[tuple[int, int, int]] = []
    period = end = None  # of a run that covers a place
    for place, shift in blocks:
        hit = np.flatnonzero(ids[place] == ids[place + shift])
        if not len(hit):
            continue
        place, shift = place[hit], shift[hit]
        good = _borne_out(ids, place, shift, _needed(shift, exponent, least))
        place, shift = place[good], shift[good]
        if not len(place):
            continue
        order = np.argsort(shift, kind="stable")
        place, shift = place[order], shift[order]
        shifts, starts = np.unique(shift, return_index=True)
        for q, a, b in zip(shifts.tolist(), starts.tolist(), [*starts[1:].tolist(), len(shift)], strict=True):
            at = place[a:b]
            if period is not None:
                known = (period[at] > 0) & (q % np.maximum(period[at], 1) == 0) & (at + q < end[at])
                if known.all():
                    continue
            same = np.zeros(n - q + 2, dtype=np.int8)
            same[1:-1] = ids[:-q] == ids[q:]
            edges = np.flatnonzero(np.diff(same))
            long = np.flatnonzero(edges[1::2] - edges[::2] >= _needed(np.int64(q), exponent, least))
            for s, e in zip(edges[2 * long].tolist(), edges[2 * long + 1].tolist(), strict=True):
                length = e - s + q
                p = _primitive(ids, s, length, q)
                if p == q:
                    out.append((s, length, q))
                if period is None:
                    period, end = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
                period[s : s + length], end[s : s + length] = p, s + length
    return sorted(out, key=lambda r: (r[0], r[2]))


def word_ids(words: list[bytes]) -> np.ndarray:
    numbers: dict[bytes, int] = {}
    return np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int32, len(words))


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> str:
    """The words joined, without those that a run holds after its first period."""
    if not runs:
        return b" ".join(words).decode()
    step = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, q in runs:
        step[start + q] += 1
        step[start + length] -= 1
    return b" ".join([w for w, drop in zip(words, np.cumsum(step[:-1]).tolist(), strict=True) if not drop]).decode()


def periodic_runs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", exponent: int = MIN_EXPONENT, least: int = MIN_LENGTH, lags: int = LAGS,
    edit: Callable[[object, list[bytes]], list[bytes]] | None = None,
) -> DataFrame:
    """doc_id, n_words, runs (by start, then period) and collapsed (the text without its repeats, words joined by a space) of every row.

    A run is a maximal stretch of words with smallest period q and a length of at least ``least`` and ``exponent`` (two or more)
    periods. ``edit`` may change a row's words, given its id, before they are scanned. Words part at ASCII white space. Null and
    word-less texts have no run and collapse to an empty text; null ids and repeated rows are kept, each for itself; runs may
    overlap, and all are given; an empty table gives no rows; other columns are not carried. Texts of any length are scanned whole.
    """
    if exponent < 2:
        raise ValueError("runs have two periods at least")
    id_type = docs.schema[id_col].dataType
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    # Of n words, a text has 2 n - 1 characters at least.
    is_long = F.length("text") >= 2 * exponent * (lags + 1) - 1
    schema = T.StructType([T.StructField("doc_id", id_type), T.StructField("n_words", T.LongType()), T.StructField("runs", T._parse_datatype_string(RUNS)), T.StructField("collapsed", T.StringType())])

    def words_of(batch, ids_at: int = 0, text_at: int = 1):
        for i, text in zip(batch.column(ids_at).to_pylist(), batch.column(text_at).to_pylist(), strict=True):
            words = text.encode().split()
            yield edit(i, words) if edit and words else words

    def packed(ids, found, names):
        cols = list(zip(*found, strict=True)) if found else [[]] * 3
        runs = [[{"start": a, "length": n, "period": q} for a, n, q in r] for r in cols[1]]
        return pa.RecordBatch.from_arrays([ids, pa.array(cols[0], pa.int64()), pa.array(runs, _RUN), pa.array(cols[2], pa.string())], names=names)

    def whole(batches):
        for batch in batches:
            found = []
            for words in words_of(batch):
                runs = find_runs(word_ids(words), 1, None, exponent, least)
                found.append((len(words), runs, collapsed(words, runs)))
            yield packed(batch.column(0), found, schema.names)

    short = rows.filter(~is_long).mapInArrow(whole, schema)

    numbered_schema = T.StructType([*(T.StructField(c, t) for c, t in (("row", T.LongType()), ("doc_id", id_type), ("text", T.StringType()), ("n", T.LongType()), ("ids", T.BinaryType())))])

    def number(batches):
        for batch in batches:
            for k, words in enumerate(words_of(batch, 1, 2)):  # long texts leave one by one
                one = batch.slice(k, 1)
                yield pa.RecordBatch.from_arrays([*one.columns, pa.array([len(words)], pa.int64()), pa.array([word_ids(words).tobytes()], pa.binary())], names=numbered_schema.names)

    numbered = rows.filter(is_long).select(F.monotonically_increasing_id().alias("row"), "doc_id", "text").mapInArrow(number, numbered_schema)
    kept = stored(numbered, "long-texts")
    # A text without a shift gets no range; a range is a task's row of its own.
    ranges = kept.filter(F.col("n") >= exponent).select("row", "ids", F.explode(F.sequence(F.lit(1).cast("long"), F.floor(F.col("n") / exponent), F.lit(lags).cast("long"))).alias("low"))

    def scan(batches):
        for batch in batches:
            for row, ids, low in zip(*(batch.column(c).to_pylist() for c in ("row", "ids", "low")), strict=True):
                for start, length, q in find_runs(np.frombuffer(ids, np.int32), low, low + lags - 1, exponent, least):
                    yield pa.RecordBatch.from_arrays([pa.array([x], pa.int64()) for x in (row, start, length, q)], names=["row", "start", "length", "period"])

    found = ranges.repartition("row", "low").mapInArrow(scan, "row long, start long, length long, period long")
    gathered = found.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "period", "length"))).alias("found"))

    def finish(batches):
        for batch in batches:
            for k, (words, found) in enumerate(zip(words_of(batch), batch.column(2).to_pylist(), strict=True)):
                runs = [(r["start"], r["length"], r["period"]) for r in found or []]
                yield packed(batch.column(0).slice(k, 1), [(len(words), runs, collapsed(words, runs))], schema.names)

    long = kept.select("row", "doc_id", "text").join(gathered, "row", "left").select("doc_id", "text", "found").mapInArrow(finish, schema)
    return short.unionByName(long)


def planted(doc_id, words: list[bytes]) -> list[bytes]:
    """The words of one text in ten with a periodic end, by the checksum of its id; those of a null id as they are."""
    import zlib

    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not words:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


def digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", edit=planted, **options) -> DataFrame:
    """doc_id, n_runs, start, length, period and exponent_milli of the longest run (null where there is none), runs_sha256 and collapsed_sha256.

    Of runs of one length the first counts, then the one of the least period. Rows as in ``periodic_runs``.
    """
    found = periodic_runs(docs, id_col, text_col, edit=edit, **options)
    longest = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("shorter"), r["start"].alias("start"), r["period"].alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))), "")
    rows = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), longest.alias("m"), F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    length, period = -F.col("m.shorter"), F.col("m.period")
    return rows.select("doc_id", "n_runs", F.col("m.start").alias("start"), length.alias("length"), period.alias("period"), F.expr("-1000 * m.shorter div m.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")

"""Secret scan with multipart credential linking.

Three base patterns report by themselves. Weak candidates - opaque strings, account names, service
endpoints - mean little alone: they are reported only where the parts of one credential meet. Each
part is an interval of its text; parts are joined by distance inside a scope (a paragraph: blank
lines part texts of any length), swept in order of position, and a weak part is reported if an
access identifier, a secret and an endpoint, or an access identifier and a secret, lie within reach.
Weak parts in different paragraphs, or over ``reach`` characters apart, are not linked; with ``reach=None`` the
paragraph alone decides.

The interval join runs inside a text's row: its parts are already in one place, so nothing is shuffled,
and the sweep keeps a window of parts in reach in place of all pairs. A weak part is its whole token, of any length; opaque
strings have 20 characters at least, account names 3, host parts of endpoints 4. What a label names as an account, or what
has an endpoint's scheme, is that and no opaque string, whatever it looks like.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

KINDS = ("assign", "access", "hex", "opaque", "account", "endpoint")
REACH = 200
MIN_BITS = 3.5

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
#: A maximal run that is long enough is found as such; shorter ones never count.
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
OPAQUE = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}={0,2}(?![A-Za-z0-9+/_=-])")
ACCOUNT = re.compile(r"""\b(?:user|username|login|account|client_?id|access_?key_?id)\b["']?\x20*[:=]\x20*["']?([A-Za-z0-9@._+/-]{3,}=*)""", re.I | re.A)
ENDPOINT = re.compile(r"\b(?:https?|ftp|s3|jdbc:[a-z]+|postgres|mysql|mongodb|redis|amqp)://[A-Za-z0-9.@:_-]{4,}(?:/[A-Za-z0-9._~/-]*)?", re.A)
SCOPE = re.compile(r"\n[ \t]*\n")


def _bits(text: str) -> float:
    n = len(text)
    return -sum(c / n * math.log2(c / n) for c in Counter(text).values())


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the base patterns, leftmost and not overlapping within a kind."""
    out = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        out += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text)]
    out += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2])))


def _free(spans: list[tuple[int, int, str]]):
    """A test whether an interval overlaps none of ``spans``."""
    covered: list[list[int]] = []  # the overlapping ones made one
    for a, b, *_ in sorted(spans):
        if covered and a < covered[-1][1]:
            covered[-1][1] = max(covered[-1][1], b)
        else:
            covered.append([a, b])
    starts = [a for a, _ in covered]

    def free(a: int, b: int) -> bool:
        k = bisect_left(starts, b) - 1  # the last that starts before the interval ends
        return k < 0 or covered[k][1] <= a

    return free


def _apart(found: list[tuple[int, int, str, str]], free) -> list[tuple[int, int, str, str]]:
    """Of the free candidates that overlap the one that starts first, of these the longest, then the first kind."""
    out, end = [], 0
    for x in sorted(found, key=lambda s: (s[0], -s[1], KINDS.index(s[2]))):
        if x[0] >= end and free(x[0], x[1]):
            out.append(x)
            end = x[1]
    return out


def _weak(text: str, base: list[tuple[int, int, str]]) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, part) of weak candidates that overlap no base span: labelled ones, and opaque strings outside these."""
    named = [(m.start(1), m.end(1), "account", "id") for m in ACCOUNT.finditer(text)] if "=" in text or ":" in text else []
    if "://" in text:
        named += [(m.start(), m.end(), "endpoint", "endpoint") for m in ENDPOINT.finditer(text)]
    named = _apart(named, _free(base))
    opaque = []
    for m in OPAQUE.finditer(text):
        word = m[0]
        if re.search("[0-9]", word) and re.search("[A-Za-z]", word) and _bits(word) >= MIN_BITS:
            opaque.append((m.start(), m.end(), "opaque", "secret"))
    return sorted(named + _apart(opaque, _free([*base, *named]))) if opaque else named


def linked_spans(text: str, base: list[tuple[int, int, str]], reach: int | None = REACH) -> list[tuple[int, int, str]]:
    """The weak candidates whose complementary parts are in the same scope, and within ``reach`` unless that is None."""
    weak = _weak(text, base)
    if not weak:
        return []
    parts = [(a, b, kind, "id" if kind == "access" else "secret", False) for a, b, kind in base] + [(*w, True) for w in weak]
    parts.sort()
    cuts, scopes, k = [m.start() for m in SCOPE.finditer(text)], [], 0
    for p in parts:
        while k < len(cuts) and cuts[k] < p[0]:
            k += 1
        scopes.append(k)
    out, lo = [], 0
    if reach is None:
        held: dict[int, set[str]] = {}
        for p, scope in zip(parts, scopes, strict=True):
            held.setdefault(scope, set()).add(p[3])
        return [p[:3] for p, scope in zip(parts, scopes, strict=True) if p[4] and {"id", "secret"} <= held[scope]]
    for i, (a, b, kind, part, is_weak) in enumerate(parts):
        while parts[lo][1] < a - reach and lo < i:
            lo += 1
        if not is_weak:
            continue
        near, j = {part}, lo
        while j < len(parts) and parts[j][0] <= b + reach:
            if j != i and scopes[j] == scopes[i] and parts[j][1] >= a - reach:
                near.add(parts[j][3])
                if len(near) == 3:
                    break
            j += 1
        if {"id", "secret"} <= near and (part != "endpoint" or len(near) == 3):
            out.append((a, b, kind))
    return out


def _join(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in spans)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", reach: int | None = REACH) -> DataFrame:
    """One row per input row: doc_id, n_assign, n_access, n_hex, base_sha256, spans.

    ``spans`` lists base and linked spans as kind:start:end in code points, by start, then kind. Null
    text counts as empty. Null ids and repeated rows are kept, each for itself; an empty table gives no rows; texts and spans of any
    length are taken whole; of weak candidates that overlap the first counts, then the longest, a labelled one before an
    opaque one; other columns are not carried.
    """
    schema = T.StructType([
        T.StructField("doc_id", docs.schema[id_col].dataType), T.StructField("n_assign", T.LongType()), T.StructField("n_access", T.LongType()), T.StructField("n_hex", T.LongType()),
        T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType()),
    ])

    def run(batches):
        for batch in batches:
            out = []
            for text in batch.column(1).to_pylist():
                base = base_spans(text or "")
                kinds = Counter(kind for _, _, kind in base)
                spans = sorted(base + linked_spans(text or "", base, reach), key=lambda s: (s[0], KINDS.index(s[2])))
                out.append((kinds["assign"], kinds["access"], kinds["hex"], hashlib.sha256(_join(base).encode()).hexdigest(), _join(spans)))
            cols = list(zip(*out, strict=True)) if out else [[]] * 5
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(cols, (pa.int64(),) * 3 + (pa.string(),) * 2, strict=True))], names=schema.names)

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema)

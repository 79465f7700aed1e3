"""The most similar name of a block for each record, found where block and records meet.

Names are compared with the record's postal code behind them, words sorted; a score is 100 * (1 - indel distance / total length).
A name's letters, each with its number among the equal ones, are bits of a signature: names whose signatures differ in n bits have an indel distance of n
at least. So the signatures of a tile bound all its scores at once, and from the highest bound down only pairs that can still beat (or tie) a record's best
are scored, many at a time. Nothing is lost, and no pair leaves the task: a record has one row a tile.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa

#: 64-bit words of a signature; letters of a text that are scored in arrays, on the record's side and the other's.
WIDTH, SHORT, LONG = 2, 64, 128
#: Pairs whose bounds are held at once, and pairs scored at once.
AT_ONCE, SCORED = 1 << 20, 1 << 14


def lcs(a: str, b: str) -> int:
    """Length of the longest common subsequence, a row of bits at a time."""
    masks: dict[str, int] = {}
    for i, ch in enumerate(a):
        masks[ch] = masks.get(ch, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for ch in b:
        hit = row & masks.get(ch, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def signatures(names: list[list[str]]) -> np.ndarray:
    """(names, WIDTH) words. The letters that split the names most evenly get bits of their own, the others share the last quarter of the bits."""
    numbered = []
    for words in names:
        seen: dict[str, int] = {}
        own = []
        for ch in "".join(words):
            seen[ch] = seen.get(ch, 0) + 1
            own.append((ch, seen[ch]))
        numbered.append([*own, *((" ", k) for k in range(len(words)))])
    held: dict[tuple[str, int], int] = {}
    for own in numbered:
        for x in own:
            held[x] = held.get(x, 0) + 1
    bits = 64 * WIDTH
    alone = bits - bits // 4
    order = sorted(held, key=lambda x: (abs(2 * held[x] - len(names)), x))
    bit = {x: k if k < alone else alone + k % (bits - alone) for k, x in enumerate(order)}
    out = np.zeros((len(names), bits), dtype=np.uint8)
    for k, own in enumerate(numbered):
        out[k, [bit[x] for x in own]] = 1
    return np.packbits(out, axis=1, bitorder="little").view("<u8")


def letters(texts: list[str], width: int) -> np.ndarray:
    """Code points, zeros behind; texts of at most ``width`` letters."""
    return np.array(texts, dtype=f"<U{width}").view("<u4").reshape(len(texts), width)


class Texts:
    """The names of a tile with one code among them, words sorted; made when first asked for. Letters are numbers in ``alphabet``, column by column."""

    def __init__(self, names: list[list[str]], code: list[str], alphabet: np.ndarray):
        self.names, self.code, self.alphabet = names, code, alphabet
        self.made = np.zeros(len(names), dtype=bool)
        self.letters = np.zeros((LONG, len(names)), dtype=np.int32)

    def one(self, k: int) -> str:
        return " ".join(sorted(self.names[k] + self.code))

    def of(self, rows: np.ndarray) -> np.ndarray:
        """All letters, those of ``rows`` made; none of these over ``LONG``."""
        new = np.unique(rows[~self.made[rows]])
        if len(new):
            self.letters[:, new] = np.searchsorted(self.alphabet, letters([self.one(k) for k in new.tolist()], LONG)).T
            self.made[new] = True
        return self.letters


def common(own: list[str], i: np.ndarray, texts: Texts, j: np.ndarray) -> np.ndarray:
    """Lengths of the longest common subsequences of ``own[i]``, of at most ``SHORT`` letters, and ``texts`` in rows j: ``lcs`` for many pairs."""
    x, many = np.searchsorted(texts.alphabet, letters(own, SHORT)), len(texts.alphabet)
    masks = np.zeros((len(own), many), dtype=np.uint64)
    for k in range(SHORT):
        masks[np.arange(len(own)), x[:, k]] |= np.uint64(1 << k)
    masks[:, 0] = 0  # what stands behind a text
    sizes = np.array([len(t) for t in own], dtype=np.uint64)
    full = np.where(sizes == 64, ~np.uint64(0), (np.uint64(1) << (sizes % np.uint64(64))) - np.uint64(1))
    masks, every = masks.ravel(), texts.of(j)
    out = np.zeros(len(i), dtype=np.int64)
    for a in range(0, len(i), SCORED):
        r, c = i[a : a + SCORED], j[a : a + SCORED]
        first, row = r * many, np.full(len(r), ~np.uint64(0))
        for k in range(LONG):
            y = every[k, c]
            if not y.any():
                break
            hit = row & masks[first + y]
            row = (row + hit) | (row - hit)
        out[a : a + SCORED] = sizes[r].astype(np.int64) - np.bitwise_count(row & full[r])
    return out


def best_of(a: list[list[str]], codes: list[str], after: np.ndarray, b: list[list[str]], place: np.ndarray, order: np.ndarray, threshold: float, cuts: list[float]) -> tuple[np.ndarray, np.ndarray]:
    """(row of ``b`` or -1, score) for every name of ``a``: the highest score from ``threshold`` on, ties to the least ``order``.

    Only names whose ``place`` is below ``after`` are compared; ``place`` ascends. ``cuts``: bounds from which on pairs are scored before the others.
    """
    both = signatures([*a, *b])
    mine, theirs = both[: len(a)], np.ascontiguousarray(both[len(a) :].T)
    length = lambda words: sum(map(len, words)) + len(words)
    size_a, size_b = (np.array([length(w) for w in x], dtype=np.int32) for x in (a, b))
    # A zero stands behind texts in arrays; such a text is scored by itself.
    odd_a, odd_b = (np.array([any("\0" in w for w in words) for words in x], dtype=bool) for x in (a, b))
    who, best = np.full(len(a), -1), np.full(len(a), -1.0)
    by_code: dict[str, list[int]] = {}
    for k in np.argsort(after, kind="stable").tolist():
        by_code.setdefault(codes[k], []).append(k)
    step = min(512, max(1, AT_ONCE // max(len(b), 1)))
    alphabet = np.array([0, *sorted(set(map(ord, " ".join([*codes, *(w for words in (*a, *b) for w in words)]) + " ")))], dtype=np.uint32)
    for code, own in by_code.items():
        words = code.split(" ") if code else []
        texts = Texts(b, words, alphabet)
        # The sizes have a blank behind the name, which is there only if a code follows.
        text_a, text_b = (np.maximum(s + (len(code) if code else -1), 0) for s in (size_a, size_b))
        odd = "\0" in code
        for at in range(0, len(own), step):
            rows = np.array(own[at : at + step])
            until = int(np.searchsorted(place, after[rows].max()))
            differ = sum(np.bitwise_count(mine[rows, w][:, None] ^ theirs[w, :until][None, :]) for w in range(WIDTH))
            whole = size_a[rows][:, None] + size_b[None, :until] + 2 * len(code)
            near = differ <= (100 - threshold) / 100 * whole + 1e-6
            i, j = np.nonzero(near & (place[None, :until] < after[rows][:, None]))
            bound = 100 - 100 * differ[i, j] / np.maximum(whole[i, j], 1)
            left = np.ones(len(i), dtype=bool)
            mine_as_text = [" ".join(sorted(a[k] + words)) for k in rows.tolist()]
            for cut in cuts:
                now = np.flatnonzero(left & (bound >= cut - 1e-6) & (bound >= best[rows[i]] - 1e-6))
                left[now] = False
                if len(now):
                    score = _scores(mine_as_text, texts, i[now], j[now], text_a[rows], text_b, odd | odd_a[rows], odd_b)
                    _better(rows, i[now], j[now], score, threshold, order, who, best)
    return who, best


def _scores(own: list[str], texts: Texts, i: np.ndarray, j: np.ndarray, size_a: np.ndarray, size_b: np.ndarray, odd_a: np.ndarray, odd_b: np.ndarray) -> np.ndarray:
    total = size_a[i] + size_b[j]
    short = (size_a[i] <= SHORT) & (size_b[j] <= LONG) & ~odd_a[i] & ~odd_b[j]
    both = np.zeros(len(i), dtype=np.int64)
    if short.any():
        both[short] = common([t if len(t) <= SHORT else "" for t in own], i[short], texts, j[short])
    for k in np.flatnonzero(~short).tolist():
        both[k] = lcs(own[i[k]], texts.one(j[k]))
    return np.where(total > 0, 200.0 * both / np.maximum(total, 1), 100.0)


def _better(rows: np.ndarray, i: np.ndarray, j: np.ndarray, score: np.ndarray, threshold: float, order: np.ndarray, who: np.ndarray, best: np.ndarray) -> None:
    """Enter the pairs that beat what their record has."""
    ok = np.flatnonzero(score >= threshold)
    ok = ok[np.lexsort((order[j[ok]], -score[ok], i[ok]))]
    ok = ok[np.concatenate(([True], i[ok][1:] != i[ok][:-1]))] if len(ok) else ok
    k = rows[i[ok]]
    wins = (score[ok] > best[k]) | ((score[ok] == best[k]) & (order[j[ok]] < order[who[k]]))
    who[k[wins]], best[k[wins]] = j[ok][wins], score[ok][wins]


def _ranks(values: list) -> np.ndarray:
    """Places in the order that Spark sorts by: nulls first, structs field by field."""
    key = lambda v: tuple((x is not None, x) for x in (v.values() if isinstance(v, dict) else (v,)))
    keys = [key(v) for v in values]
    place = {k: n for n, k in enumerate(sorted(set(keys)))}
    return np.array([place[k] for k in keys], dtype=np.int64)


def tile(threshold: float, cuts: list[float]) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """What a task does with a tile: (record_id, entity_id, score) of the best of each record. Records: record_id, name, code, after; entities: entity_id, name, place."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        after, place = left.column("after").to_pylist(), right.column("place").to_pylist()
        given = [k for k, v in enumerate(place) if v is not None]
        bounded = [k for k, v in enumerate(after) if v is not None]
        ranks = _ranks([after[k] for k in bounded] + [place[k] for k in given])
        # Without a place of its own, a record meets the entities that have none either.
        low, high = np.zeros(len(after), dtype=np.int64), np.full(len(place), -1)
        low[bounded], high[given] = ranks[: len(bounded)], ranks[len(bounded) :]
        by = np.argsort(high, kind="stable")
        right, high = right.take(pa.array(by)), high[by]
        names = lambda t: [x.split(" ") if x else [] for x in t.column("name").to_pylist()]
        who, best = best_of(names(left), left.column("code").to_pylist(), low, names(right), high, _ranks(right.column("entity_id").to_pylist()), threshold, cuts)
        hit = np.flatnonzero(who >= 0)
        return pa.table({"record_id": left.column("record_id").take(pa.array(hit)), "entity_id": right.column("entity_id").take(pa.array(who[hit])), "score": pa.array(best[hit])})

    return run

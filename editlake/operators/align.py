"""Alignment, read merging, UMIs and consensus: the parts that need code of their own, in Arrow batches.

Alignment is the three-state dynamic program with affine gaps, run for a whole batch of pairs at once: a step fills
one diagonal of every pair's table. Long pairs are seeded first: the minimisers that both share are chained, and only a band around the
chain is filled. Letters are sets of bases, so IUPAC codes match what they stand for. Equal pairs are aligned once. Null sequences
give null results.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from editlake.functions import seq as q
from editlake.scratch import materialize

# The IUPAC nucleotide code as bit sets of A, C, G, T.
IUPAC = {
    "A": 1, "C": 2, "G": 4, "T": 8, "U": 8, "R": 5, "Y": 10, "S": 6, "W": 9, "K": 12, "M": 3,
    "B": 14, "D": 13, "H": 11, "V": 7, "N": 15,
}
#: Pairs that are aligned at once, cells of their tables, and how many pairs go side by side through a step.
PAIRS, CELLS, LANES = 1024, 1 << 25, 512
#: Pairs of more cells are seeded by k-mers of SEED bases.
LONG, SEED = 1 << 20, 13
NEVER = -(10**9)
RESULT = "score double, start int, end int, cigar string"


@dataclass(frozen=True)
class Scores:
    """Match and mismatch scores and the costs of opening and of each base of a gap."""

    match: float = 29
    mismatch: float = -17
    gap_open: float = 25
    gap_extend: float = 2


PROFILES = {"minimap2": Scores(), "bwa": Scores(1, -4, 6, 1), "bowtie2": Scores(2, -6, 5, 3), "edits": Scores(0, -1, 0, 1)}


def _codes(texts: list[str], width: int) -> np.ndarray:
    table = np.zeros(256, np.uint8)
    for c, v in IUPAC.items():
        table[ord(c)] = table[ord(c.lower())] = v
    out = np.zeros((len(texts), width), np.uint8)
    for k, t in enumerate(texts):
        out[k, : len(t)] = table[np.frombuffer(t.encode("ascii", "replace"), np.uint8)]
    return out


def align_batch(queries: list[str], subjects: list[str], mode: str, s: Scores) -> list[tuple[float, int, int, str]]:
    """(score, first and last aligned base of the subject, 1-based; CIGAR) of each pair.

    Modes: global; global-local (the whole query inside the subject, also for edit distance); local.
    """
    m, n = np.array([len(x) for x in queries], int), np.array([len(x) for x in subjects], int)
    rows, cols = int(m.max(initial=0)), int(n.max(initial=0))
    kind = _diagonal_kind(rows, cols, s)
    if kind is not None:
        return _fill_diagonals(_codes(queries, rows), _codes(subjects, cols), m, n, mode, s, kind)
    made, at = [], 0  # tables of whole rows, of fewer pairs at once
    some = max(1, (1 << 20) // ((rows + 1) * (cols + 1)))
    while at < len(m):
        part = slice(at, at + some)
        made += _fill_whole(_codes(queries[part], rows), _codes(subjects[part], cols), m[part], n[part], mode, s)
        at += some
    return made


def _diagonal_kind(rows: int, cols: int, s: Scores) -> type | None:
    """The kind of number that :func:`_fill_diagonals` needs, None where it isn't for such scores."""
    costs = (s.match, s.mismatch, s.gap_open, s.gap_extend)
    if not (rows and cols and all(float(c).is_integer() for c in costs)):
        return None
    worth, other = s.match - s.mismatch, s.mismatch + 2 * s.gap_extend + s.gap_open
    if worth <= 0 or s.mismatch >= 0 or s.gap_open < 0 or s.gap_extend < 0 or s.gap_open + s.gap_extend == 0 or other < 0:
        return None
    most = (abs(s.match) + 2 * s.gap_extend) * (rows + cols + 2) + 4 * s.gap_open + worth + other
    letters = 1 << (int(worth + other).bit_length() + 4)
    return next((k for k in (np.int16, np.int32) if max(2 * most, letters) < np.iinfo(k).max), None)


#: Tables that a process fills again and again.
_ROOM: dict[str, np.ndarray] = {}


def _room(name: str, size: int, kind: type) -> np.ndarray:
    if name not in _ROOM or _ROOM[name].nbytes < size * np.dtype(kind).itemsize:
        _ROOM[name] = np.empty(size * np.dtype(kind).itemsize, np.uint8)
    return _ROOM[name][: size * np.dtype(kind).itemsize].view(kind)


def _fill_diagonals(
    x: np.ndarray, y: np.ndarray, m: np.ndarray, n: np.ndarray, mode: str, s: Scores, kind: type
) -> list[tuple[float, int, int, str]]:
    """As :func:`align_batch`, from tables by diagonal, place and pair: the cells of a diagonal don't depend on each other.

    A cell (i, j) holds its score plus (i + j) gap_extend, so that a gap grows for nothing. What a step needs of two letters is one "and": the
    bits that both have lie above the scores, a common lower part is that of different ones. The ways back are found from the scores of the
    cells and of those that end in a gap of the query, all pairs side by side. Scores are as :func:`_diagonal_kind` wants them.
    """
    pairs, rows, cols = len(m), x.shape[1], y.shape[1]
    match, mismatch, gap_open, extend = (int(c) for c in (s.match, s.mismatch, s.gap_open, s.gap_extend))
    other = mismatch + 2 * extend + gap_open
    equal, never, local = match - mismatch + other, np.iinfo(kind).min // 2, mode == "local"
    lanes = min(pairs, LANES)
    blocks, wide, depth = -(-pairs // lanes), cols + 1, rows + cols + 1
    code = lambda z: np.pad((z.astype(kind) << equal.bit_length()) | kind(other), ((0, blocks * lanes - pairs), (0, 0)), constant_values=other)
    x, y = np.ascontiguousarray(code(x).T), np.ascontiguousarray(code(y).T)
    all_h, all_e = (_room(name, blocks * depth * wide * lanes, kind) for name in ("scores", "gaps"))
    tops = np.full((depth, blocks * lanes), never, kind)
    f, t = np.empty((wide, lanes), kind), np.empty((wide, lanes), kind)
    opens = [np.empty((wide, lanes), kind) for _ in range(3)]
    for k in range(blocks):
        part = slice(k * lanes, (k + 1) * lanes)
        back, down = np.ascontiguousarray(x[::-1, part]), np.ascontiguousarray(y[:, part])
        h, e = (z.reshape(blocks, depth, wide, lanes)[k] for z in (all_h, all_e))
        f[:] = never
        for d in range(depth):
            lo, hi = max(1, d - rows), min(cols, d - 1)
            now, one, two = opens[d % 3], opens[(d - 1) % 3], opens[(d - 2) % 3]
            if lo <= hi:
                cells, up, gap = t[: hi - lo + 1], f[lo : hi + 1], e[d, lo : hi + 1]
                np.maximum(one[lo - 1 : hi], e[d - 1, lo - 1 : hi], out=gap)
                np.maximum(one[lo : hi + 1], up, out=up)
                np.bitwise_and(back[rows - d + lo : rows - d + hi + 1], down[lo - 1 : hi], out=cells)
                np.minimum(cells, kind(equal), out=cells)
                np.add(cells, two[lo - 1 : hi], out=cells)
                np.maximum(cells, gap, out=cells)
                if local:
                    np.maximum(cells, up, out=cells)
                    np.maximum(cells, kind(extend * d), out=h[d, lo : hi + 1])
                    np.maximum.reduce(h[d, lo : hi + 1], axis=0, out=tops[d, part])
                else:
                    np.maximum(cells, up, out=h[d, lo : hi + 1])
            if d <= rows:
                h[d, 0], e[d, 0] = extend * d if local else -gap_open * (d > 0), never
            if d <= cols:
                h[d, d] = extend * d if mode != "global" else -gap_open * (d > 0)
            span = slice(max(0, d - rows), min(cols, d) + 1)
            np.subtract(h[d, span], kind(gap_open), out=now[span])
    every = np.arange(pairs)
    first = every // lanes * (depth * wide * lanes) + every % lanes
    place = lambda p, i, j: first[p] + ((i + j) * wide + j) * lanes
    if mode == "global":
        i, j = m.astype(np.int64), n.astype(np.int64)
    elif local:
        # Beyond a pair's ends scores only fall. Of equal ones the first row's counts, there the first.
        tops = tops[:, :pairs] - extend * np.arange(depth)[:, None]
        best = tops.max(0)
        d, p = np.nonzero((tops == best) & (best > 0))
        which = np.arange(wide)
        there = all_h[first[p, None] + (d[:, None] * wide + which) * lanes] == (best[p] + extend * d)[:, None]
        there &= (which >= np.maximum(1, d - rows)[:, None]) & (which <= np.minimum(cols, d - 1)[:, None])
        at = cols - there[:, ::-1].argmax(1)
        order = np.lexsort((at, d - at, p))
        p, first_of = np.unique(p[order], return_index=True)
        i, j = np.zeros(pairs, np.int64), np.zeros(pairs, np.int64)
        i[p], j[p] = (d - at)[order][first_of], at[order][first_of]
    else:
        which = np.arange(wide)
        ends = all_h[place(every[:, None], m[:, None], which)] - extend * (m[:, None] + which)
        i, j = m.astype(np.int64), np.where(which <= n[:, None], ends, 2 * never).argmax(1)
    score = all_h[place(every, i, j)] - extend * (i + j)
    last_i, last = i.copy(), j.copy()
    # All ways back at once; 1, 2, 3: both go on, the subject, the query.
    total, steps = blocks * lanes, (2 * wide + 1) * lanes
    ways = np.zeros((depth, pairs), np.uint8)
    x, y = x.reshape(-1), y.reshape(-1)
    p, at, state = every, place(every, i, j), np.zeros(pairs, np.uint8)
    value, here = all_h[at], all_h[at]
    end_i, end_j = i.copy(), j.copy()
    for step in range(depth):
        if local:
            done = (here <= extend * (i + j)) & (state == 0)
        else:
            done = i == 0 if mode == "global-local" else (i == 0) & (j == 0)
        if done.any():
            end_i[p[done]], end_j[p[done]] = i[done], j[done]
            p, at, state, value, here, i, j = (z[~done] for z in (p, at, state, value, here, i, j))
        if not len(p):
            break
        fresh, inside = state == 0, (i > 0) & (j > 0)
        letters = x[np.maximum(i - 1, 0) * total + p] & y[np.maximum(j - 1, 0) * total + p]
        both = fresh & inside & (all_h[np.maximum(at - steps, 0)] - gap_open + np.minimum(letters, equal) == here)
        value = np.where(fresh, here, value)
        left = (state == 2) | (fresh & ~both & (j > 0) & ((i == 0) | (all_e[at] == here)))
        way = np.where(both, np.uint8(1), np.where(left, np.uint8(2), np.uint8(3)))
        ways[step, p] = way
        at = at - np.where(both, steps, np.where(left, (wide + 1) * lanes, wide * lanes))
        here = all_h[at]
        on = ~both & (value > here - gap_open) & (np.where(left, j, i) > 1)
        state = np.where(on, way, np.uint8(0))
        i, j = i - (way != 2), j - (way != 3)
    cigars = _cigars(ways, end_i if local else None, m - last_i)
    return list(zip(score.astype(float).tolist(), (end_j + 1).tolist(), last.tolist(), cigars, strict=True))


def _cigars(ways: np.ndarray, before: np.ndarray | None, after: np.ndarray) -> list[str]:
    """A CIGAR for each column of ``ways``, which is walked from its end; with ``before`` so many bases of the query are cut off, and ``after``."""
    depth, pairs = ways.shape
    ops = np.zeros((pairs, depth + 1), np.uint8)
    ops[:, :depth] = ways[::-1].T
    ops = ops.reshape(-1)  # pairs end in a 0
    begin = np.flatnonzero(np.concatenate((ops[:1] > 0, (ops[1:] != ops[:-1]) & (ops[1:] > 0))))
    finish = np.flatnonzero((ops[:-1] != ops[1:]) & (ops[:-1] > 0)) + 1
    pair, kinds, sizes = begin // (depth + 1), ops[begin], finish - begin
    texts = [f"{size}{'-MDI'[kind]}" for size, kind in zip(sizes.tolist(), kinds.tolist(), strict=True)]
    cuts = np.searchsorted(pair, np.arange(pairs + 1)).tolist()
    whole = ["".join(texts[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    if before is None:
        return whole
    cut = lambda k: f"{k}S" if k else ""
    return [cut(a) + c + cut(b) if c else cut(a + b) for a, c, b in zip(before.tolist(), whole, after.tolist(), strict=True)]


def _fill_whole(x: np.ndarray, y: np.ndarray, m: np.ndarray, n: np.ndarray, mode: str, s: Scores) -> list[tuple[float, int, int, str]]:
    """As :func:`align_batch`, for any scores, from whole tables: place by pair, so that a step to the left is one to the row above and all pairs go side by
    side. No cell depends on one right of it or below, so those beyond a pair's ends are filled too and only never taken."""
    pairs, rows, cols = len(m), x.shape[1], y.shape[1]
    costs = (s.match, s.mismatch, s.gap_open, s.gap_extend)
    whole = all(float(c).is_integer() for c in costs) and max(map(abs, costs)) * (rows + cols + 2) < -NEVER / 2
    kind = np.int32 if whole else np.float64
    match, mismatch, gap_open, gap_extend = (kind(c) for c in costs)
    never, both = kind(NEVER), gap_open + gap_extend
    x, y = np.ascontiguousarray(x.T), np.ascontiguousarray(y.T)
    local, free = mode == "local", mode in ("global-local", "local")
    cell = np.arange(cols + 1)
    ramp = (gap_extend * cell).astype(kind)[:, None]
    beyond = cell[:, None] > n if (n < cols).any() else None
    h = np.zeros((cols + 1, pairs), kind)
    if not free:
        h[1:] = -gap_open - ramp[1:]
    f, e = np.full((cols, pairs), never, kind), np.full((cols + 1, pairs), never, kind)
    base, score = np.empty((cols + 1, pairs), kind), np.empty((cols + 1, pairs), kind)
    trace = np.zeros((rows + 1, cols + 1, pairs), np.uint8)
    if not free:
        trace[0, 1:] = 2 | 4
    best, bi, bj = np.full(pairs, never, kind), np.zeros(pairs, int), np.zeros(pairs, int)

    def take(i: int, h: np.ndarray) -> None:
        asked = np.flatnonzero(i <= m if local else m == i)
        if not len(asked):
            return
        if mode == "global":
            best[asked], bi[asked], bj[asked] = h[n[asked], asked], i, n[asked]
            return
        seen = h if beyond is None else np.where(beyond, never, h)
        better = asked[seen.max(0)[asked] > best[asked]]
        if len(better):
            at = seen[:, better].argmax(0)
            best[better], bi[better], bj[better] = seen[at, better], i, at

    take(0, h)
    for i in range(1, rows + 1):
        opened, longer = h[1:] - both, f - gap_extend
        flag = (longer > opened).view(np.uint8) << 3
        np.maximum(opened, longer, out=f)
        score[0] = 0 if local else -gap_open - gap_extend * i
        cells = score[1:]
        np.add(h[:-1], np.where(x[i - 1] & y, match, mismatch), out=cells)
        base[0] = score[0]
        np.maximum(cells, f, out=base[1:])
        if local:
            np.maximum(base, 0, out=base)
        # A gap opens from a cell that doesn't end in one, so the best beginning is a running maximum along the row.
        base += ramp
        np.maximum.accumulate(base, axis=0, out=base)
        np.subtract(base[:-1], gap_open + ramp[1:], out=e[1:])
        gap = e[1:] > cells
        np.maximum(cells, e[1:], out=cells)
        up = f > cells
        np.maximum(cells, f, out=cells)
        way = np.where(up, np.uint8(3), gap.view(np.uint8) + np.uint8(1))
        if local:
            way *= cells > 0
            np.maximum(cells, 0, out=cells)
        flag |= (e[:-1] - gap_extend > score[:-1] - both).view(np.uint8) << 2
        np.bitwise_or(way, flag, out=trace[i, 1:])
        trace[i, 0] = 0 if local else 3 | 8
        h, score = score, h
        take(i, h)
    tables = np.ascontiguousarray(trace.transpose(2, 0, 1))
    return [_path(tables[k].tobytes(), cols + 1, 0, 0, int(bi[k]), int(bj[k]), int(m[k]), float(best[k]), mode) for k in range(pairs)]


def _fill(
    x: np.ndarray, y: np.ndarray, m: np.ndarray, n: np.ndarray, first: np.ndarray, width: int, moves: bool, mode: str, s: Scores
) -> list[tuple[float, int, int, str]]:
    """As :func:`align_batch`, filling ``width`` cells a row: those of the subject's places from ``first`` on, a place
    farther on in each row if the band ``moves``. (:func:`_fill_diagonals` is quicker for whole tables.)"""
    b, rows = len(m), x.shape[1]
    free = mode in ("global-local", "local")
    cell, step = np.arange(width), int(moves)
    ramp = s.gap_extend * cell
    padded = np.pad(y, ((0, 0), (1, 1)))
    never = np.full((b, 1), float(NEVER))

    def places(i: int) -> np.ndarray:
        return first[:, None] + cell + step * i

    def edge(i: int) -> float:
        """The score of a cell with nothing of the subject before it."""
        return 0.0 if mode == "local" or i == 0 else -s.gap_open - s.gap_extend * i

    j = places(0)
    inside = (j >= 0) & (j <= n[:, None])
    h = np.where(inside, 0.0 if free else np.where(j == 0, 0.0, -s.gap_open - s.gap_extend * j), float(NEVER))
    f = np.full((b, width), float(NEVER))
    trace = np.zeros((rows + 1, b, width), np.uint8)
    if not free:
        trace[0] = np.where(j > 0, 2 | 4, 0)
    best, bi, bj = np.full(b, float(NEVER)), np.zeros(b, int), np.zeros(b, int)

    def take(i: int, j: np.ndarray, inside: np.ndarray) -> None:
        if mode == "global":
            here = inside & (m == i)[:, None] & (j == n[:, None])
        elif mode == "global-local":
            here = inside & (m == i)[:, None]
        else:
            here = inside & (i <= m)[:, None]
        score = np.where(here, h, 2.0 * NEVER)
        at = score.argmax(1)
        top = score[np.arange(b), at]
        better = top > best
        best[better], bi[better], bj[better] = top[better], i, j[np.arange(b), at][better]

    take(0, j, inside)
    for i in range(1, rows + 1):
        j = places(i)
        inside = (j >= 0) & (j <= n[:, None])
        if moves:  # the cell above is one farther on in the row before
            diagonal, above, above_f = h, np.concatenate((h[:, 1:], never), 1), np.concatenate((f[:, 1:], never), 1)
        else:
            diagonal, above, above_f = np.concatenate((never, h[:, :-1]), 1), h, f
        opened, longer = above - s.gap_open - s.gap_extend, above_f - s.gap_extend
        flag = np.where(longer > opened, np.uint8(8), np.uint8(0))
        f = np.maximum(opened, longer)
        letters = np.take_along_axis(padded, np.clip(j, 0, padded.shape[1] - 1), 1) if moves else padded[:, :-1]
        score = diagonal + np.where((x[:, i - 1 : i] & letters) > 0, s.match, s.mismatch)
        at_edge = j == 0
        score = np.where(at_edge, edge(i), np.where(inside, score, float(NEVER)))
        f = np.where(at_edge | ~inside, float(NEVER), f)
        # A gap opens from a cell that doesn't end in one, so the best beginning is a running maximum along the row.
        base = np.maximum(score, f)
        if mode == "local":
            base = np.where(inside, np.maximum(base, 0), base)
        e = np.concatenate((never, np.maximum.accumulate(base + ramp, 1)[:, :-1] - s.gap_open - ramp[1:]), 1)
        e = np.where(at_edge | ~inside, float(NEVER), e)
        way = np.ones((b, width), np.uint8)
        for k, other in ((2, e), (3, f)):
            more = other > score
            score, way = np.where(more, other, score), np.where(more, np.uint8(k), way)
        if mode == "local":
            low = inside & (score <= 0)
            score, way = np.where(low, 0.0, score), np.where(low, np.uint8(0), way)
        before_h, before_e = np.concatenate((never, score[:, :-1]), 1), np.concatenate((never, e[:, :-1]), 1)
        flag |= np.where(before_e - s.gap_extend > before_h - s.gap_open - s.gap_extend, np.uint8(4), np.uint8(0))
        trace[i] = np.where(at_edge, 0 if mode == "local" else 3 | 8, way | flag)
        h = score
        take(i, j, inside)
    return [_path(trace[:, k].tobytes(), width, int(first[k]), step, int(bi[k]), int(bj[k]), int(m[k]), float(best[k]), mode) for k in range(b)]


def _path(trace: bytes, width: int, first: int, step: int, i: int, j: int, m: int, score: float, mode: str) -> tuple[float, int, int, str]:
    """The result of a pair whose alignment ends at (i, j), walked back along ``trace``, ``width`` cells a row."""
    free, end, last, ops, state = mode in ("global-local", "local"), j, i, [], 0
    while True:
        t = trace[i * width + j - first - step * i]
        if state == 0:
            if i == 0 and (free or j == 0) or t & 3 == 0:
                break
            state = t & 3
            if state == 1:
                ops.append("M")
                i, j, state = i - 1, j - 1, 0
            continue
        if state == 2:
            ops.append("D")
            state = 2 if t & 4 and j > 1 else 0
            j -= 1
        else:
            ops.append("I")
            state = 3 if t & 8 and i > 1 else 0
            i -= 1
        if i == 0 and j == 0:
            break
    ops = (["S"] * i + ops[::-1] + ["S"] * (m - last)) if mode == "local" else ops[::-1]
    return score, j + 1, end, pack(ops)


def minimisers(text: str, k: int = SEED, window: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, places) of the k-mers of A, C, G and T that are the least of some ``window`` consecutive ones."""
    code = np.full(256, -1, np.int64)
    for c, v in zip("ACGTacgt", (0, 1, 2, 3) * 2, strict=True):
        code[ord(c)] = v
    x = code[np.frombuffer(text.encode("ascii", "replace"), np.uint8)]
    count = len(x) - k + 1
    if count <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    value = np.zeros(count, np.uint64)
    for a in range(k):
        value = value * np.uint64(4) + np.maximum(x[a : a + count], 0).astype(np.uint64)
    h = (value + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(31)
    bad = np.concatenate(([0], np.cumsum(x < 0)))
    h[bad[k:] > bad[:-k]] = np.iinfo(np.uint64).max
    window = min(window, count)
    least = np.lib.stride_tricks.sliding_window_view(h, window)
    at = np.unique(np.arange(len(least)) + least.argmin(1))
    at = at[h[at] != np.iinfo(np.uint64).max]
    return h[at], at


def chain(query: str, subject: str, back: int = 64, most_hits: int = 1 << 16) -> tuple[int, int] | None:
    """The least and the greatest diagonal (place in the subject less place in the query) of the best chain of shared minimisers; None
    without one. Minimisers that stand in the subject more often than others, so that there are too many pairs, aren't used."""
    (hq, pq), (hs, ps) = minimisers(query), minimisers(subject)
    order = np.argsort(hs, kind="stable")
    hs, ps = hs[order], ps[order]
    low, high = np.searchsorted(hs, hq), np.searchsorted(hs, hq, side="right")
    counts = high - low
    for limit in (64, 8, 1):
        used = np.flatnonzero((counts > 0) & (counts <= limit))
        if counts[used].sum() <= most_hits:
            break
    n = counts[used]
    if not n.sum():
        return None
    i = np.repeat(pq[used], n)
    j = ps[np.repeat(low[used], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
    order = np.lexsort((j, i))
    i, j = i[order], j[order]
    score, came = np.full(len(i), float(SEED)), np.full(len(i), -1)
    for k in range(1, len(i)):
        a = max(0, k - back)
        di, dj = i[k] - i[a:k], j[k] - j[a:k]
        drift = np.abs(di - dj)
        gain = score[a:k] + np.minimum(np.minimum(di, dj), SEED) - 0.05 * drift - np.where(drift > 0, 0.5 * np.log2(drift + 1), 0)
        gain[(di <= 0) | (dj <= 0)] = -1
        top = int(gain.argmax())
        if gain[top] > score[k]:
            score[k], came[k] = gain[top], a + top
    k, low_d, high_d = int(score.argmax()), None, None
    while k >= 0:
        d = int(j[k] - i[k])
        low_d, high_d = (d, d) if low_d is None else (min(low_d, d), max(high_d, d))
        k = int(came[k])
    return low_d, high_d


def align_long(query: str, subject: str, mode: str, s: Scores, slack: int = 64) -> tuple[float, int, int, str]:
    """As :func:`align_batch` for one long pair, in a band: the diagonals of its chain and ``slack`` more on either side, and a hundredth
    of its length, for gaps near the ends. Without a chain, and where the band isn't narrower, the whole table is filled."""
    m, n = len(query), len(subject)
    found = chain(query, subject)
    if found is not None:
        slack += max(m, n) // 100
        low, high = found[0] - slack, found[1] + slack
        if mode == "global":  # from one corner to the other
            low, high = min(low, -slack, n - m - slack), max(high, slack, n - m + slack)
        if high - low < n:
            x, y = _codes([query], m), _codes([subject], n)
            return _fill(x, y, np.array([m]), np.array([n]), np.array([low]), high - low + 1, True, mode, s)[0]
    return align_batch([query], [subject], mode, s)[0]


def pack(ops: list[str]) -> str:
    """A CIGAR from single operations."""
    out, run = [], 0
    for k, op in enumerate(ops):
        run += 1
        if k + 1 == len(ops) or ops[k + 1] != op:
            out.append(f"{run}{op}")
            run = 0
    return "".join(out)


def align_texts(a: list, b: list, mode: str, scores: Scores) -> list[tuple]:
    """(score, start, end, cigar) of each pair of a query and a subject, of nulls without a value."""
    out: list[tuple] = [(None, None, None, None)] * len(a)
    known = sorted((k for k in range(len(a)) if a[k] is not None and b[k] is not None), key=lambda k: len(a[k]))
    at = 0
    while at < len(known):
        # Sorted by length, so the last pair is the longest of its batch.
        part = known[at : at + PAIRS]
        wide = max(len(b[k]) for k in part) + 1
        cells = (len(a[part[-1]]) + wide) * wide  # of a table by diagonals
        if (len(a[part[0]]) + 1) * (len(b[part[0]]) + 1) > LONG:
            part = part[:1]
            made = [align_long(a[part[0]], b[part[0]], mode, scores)]
        else:
            part = part[: max(1, CELLS // cells)]
            made = align_batch([a[k] for k in part], [b[k] for k in part], mode, scores)
        at += len(part)
        for k, r in zip(part, made, strict=True):
            out[k] = r
    return out


def aligner(mode: str, scores: Scores):
    """A pandas UDF (query, subject) -> struct<score, start, end, cigar>."""

    @F.pandas_udf(RESULT)
    def run(a: pd.Series, b: pd.Series) -> pd.DataFrame:
        texts = [x.astype(object).where(x.notna(), None).tolist() for x in (a, b)]
        frame = pd.DataFrame(align_texts(*texts, mode, scores), columns=["score", "start", "end", "cigar"], dtype=object)
        return frame.astype({"score": "float64", "start": "Int32", "end": "Int32"})

    return run


def by_pair(df: DataFrame, query: str, subject: str, make, fields: str) -> DataFrame:
    """Adds the columns ``fields`` that ``make`` gives, a tuple a pair, for lists of queries and subjects.

    Rows are shuffled once, so that equal pairs come to one task, side by side; ``make`` sees them once a batch. As a function of batches, not
    a column, it is called once however many of its fields are asked for.
    """
    # A fixed number of partitions, which the adaptive planner doesn't merge: few bytes here are much work.
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    more = StructType.fromDDL(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = to_arrow_schema(more)
        for batch in batches:
            pairs: dict[tuple, int] = {}
            which = [pairs.setdefault(x, len(pairs)) for x in zip(batch[query].to_pylist(), batch[subject].to_pylist(), strict=True)]
            made = make([x for x, _ in pairs], [y for _, y in pairs])
            new = [pa.array([r[k] for r in made], kind.type).take(pa.array(which, pa.int32())) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], names=[*batch.schema.names, *kinds.names])

    rows = df.repartition(n, query, subject).sortWithinPartitions(F.xxhash64(query, subject))
    return rows.mapInArrow(run, StructType(df.schema.fields + more.fields))


def align_pairs(df: DataFrame, query: str, subject: str, mode: str = "global-local", scores: Scores | None = None) -> DataFrame:
    """Adds score, start, end, cigar; equal pairs are aligned once a batch. Rows without one of the two are left out."""
    s = scores or Scores()
    return by_pair(df.dropna(subset=[query, subject]), query, subject, lambda a, b: align_texts(a, b, mode, s), RESULT)


def cut_sites(guides: DataFrame, reference: str, rel_cut: int = -3) -> DataFrame:
    """Adds cut_site to ``guides`` (guide, a column ``reference``, ...): where the guide cuts the reference. A guide that stands in neither
    strand as it is lies where it aligns best, on the reverse strand unless the other scores strictly higher."""
    from .targeted import cut_site

    rows = cut_site(guides, F.col(reference), rel_cut)
    up = F.upper("guide")
    run = aligner("global-local", Scores(1, -1, 10, 4))
    missing = F.col("cut_site").isNull()
    asked = rows.select(F.when(missing, up).alias("_g"), F.when(missing, F.upper(F.col(reference))).alias("_r")).filter("_g is not null").distinct()
    both = asked.withColumns({"_f": run("_g", "_r"), "_b": run("_g", q.revcomp(F.col("_r")))})
    size, n = F.length("_g"), F.length("_r")
    forward = F.col("_f.start") + (rel_cut - 1 if rel_cut > 0 else size + rel_cut - 1)
    backward = n - F.col("_b.end") + ((size - rel_cut) if rel_cut > 0 else -rel_cut)
    found = both.select("_g", "_r", F.when(F.col("_f.score") > F.col("_b.score"), forward).otherwise(backward).alias("_site"))
    joined = rows.join(found, (up == F.col("_g")) & (F.upper(F.col(reference)) == F.col("_r")), "left")
    return joined.withColumn("cut_site", F.coalesce("cut_site", "_site").cast("int")).drop("_g", "_r", "_site")


def orient_reference(df: DataFrame, guide: str, reference: str) -> DataFrame:
    """Adds oriented: the reference if the guide scores strictly higher on it than on its reverse complement, else the latter."""
    two = df.withColumn("back", q.revcomp(F.col(reference)))
    run = aligner("global-local", Scores(1, -1, 10, 4))
    forward, backward = run(guide, reference)["score"], run(guide, "back")["score"]
    two = two.withColumns({"f": forward, "r": backward})
    return two.withColumn("oriented", F.when(F.col("f") > F.col("r"), F.col(reference)).otherwise(F.col("back"))).drop("back", "f", "r")


#: Scores of overlaps are whole numbers of this part, so that equal overlaps score the same in any order.
PART = 1 << 20


def overlap_scores() -> np.ndarray:
    """[equal, quality, quality]: the chance that two called bases come from one true base, less the chance that they don't."""
    e = np.minimum(10.0 ** (-np.arange(94) / 10), 0.75)
    x, y = e[:, None], e[None, :]
    same = (1 - x) * (1 - y) + x * y / 3
    other = ((1 - x) * y + (1 - y) * x) / 3 + 2 * x * y / 9
    return np.rint(np.stack((2 * other - 1, 2 * same - 1)) * PART).astype(np.int64)


def _padded(texts: list[str], fill: int) -> np.ndarray:
    """The texts' bytes, a row each, filled up on the right."""
    width = max(map(len, texts), default=0)
    return np.frombuffer(b"".join(t.encode().ljust(width, bytes([fill])) for t in texts), np.uint8).reshape(len(texts), width)


def best_overlaps(s1: list[str], q1: list[str], s2: list[str], q2: list[str], min_overlap: int) -> tuple[np.ndarray, np.ndarray]:
    """For each pair of mates, both read left to right, how far the second begins right of the first, and the bound on the chance of that
    overlap; 0 and 1 where none scores above 0.

    Every shift whose overlap has ``min_overlap`` bases counts, also those at which a mate reads on beyond the other's beginning. The best
    score is taken, of ties the longest whole. The chance that unrelated mates of these bases and qualities have an overlap as good is at
    most the sum over all shifts of E exp(t score) / exp(t best), for any t.
    """
    table = overlap_scores()
    x, y = _padded(s1, 0), _padded(s2, 255)
    u, v = _padded(q1, 33).astype(np.int64) - 33, _padded(q2, 33).astype(np.int64) - 33
    nx, ny = np.array([len(t) for t in s1]), np.array([len(t) for t in s2])
    shifts = np.arange(min_overlap - y.shape[1], x.shape[1] - min_overlap + 1)
    rows = len(x)
    if not rows or not len(shifts):
        return np.zeros(rows, np.int64), np.ones(rows)
    size = np.minimum(nx[:, None], shifts + ny[:, None]) - np.maximum(0, shifts)
    ok = size >= max(min_overlap, 1)
    equal = np.stack([(x[:, max(0, d) : d + y.shape[1]] == y[:, max(0, -d) : x.shape[1] - d]).sum(1) for d in shifts], 1)
    # A base that differs scores -1/3 at most, an equal one 1.
    most = np.where(ok, equal - (size - equal) / 3, -np.inf)
    order = np.argsort(-most, axis=1, kind="stable")
    places = np.arange(x.shape[1])
    best, at, live = np.zeros(rows, np.int64), np.zeros(rows, np.int64), np.arange(rows)

    def cells(who: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which places of the first mates lie in the overlap, and both scores there."""
        other = places - d[:, None]
        inside = (other >= 0) & (other < ny[who][:, None]) & (places < nx[who][:, None])
        there = np.clip(other, 0, y.shape[1] - 1)
        same = (x[who] == np.take_along_axis(y[who], there, 1)) & inside
        a, b = u[who], np.take_along_axis(v[who], there, 1)
        return inside, table[1][a, b], np.where(same, table[1][a, b], table[0][a, b]) if same.any() else table[0][a, b]

    for k in range(len(shifts)):
        live = live[most[live, order[live, k]] * PART >= np.maximum(best[live], 1)]
        if not len(live):
            break
        d = shifts[order[live, k]]
        inside, _, score = cells(live, d)
        total = np.where(inside, score, 0).sum(1)
        better = (total > best[live]) | ((total == best[live]) & (total > 0) & (d > at[live]))
        best[live[better]], at[live[better]] = total[better], d[better]

    chance = np.ones(rows)
    found = np.flatnonzero(best > 0)
    if len(found):
        share = lambda z, n: np.stack([(z == c).sum(1) for c in b"ACGT"], 1) / np.maximum(n, 1)[:, None]
        r = np.maximum((share(x[found], nx[found]) * share(y[found], ny[found])).sum(1), 0.25)[:, None]
        d = at[found]
        inside, good, _ = cells(found, d)
        other = np.clip(places - d[:, None], 0, y.shape[1] - 1)
        bad = table[0][u[found], np.take_along_axis(v[found], other, 1)]
        low = np.zeros(len(found))
        for t in np.geomspace(0.1, 12, 30):
            each = np.log(r * np.exp(t * good / PART) + (1 - r) * np.exp(t * bad / PART))
            low = np.minimum(low, np.where(inside, each, 0).sum(1) - t * best[found] / PART)
        chance[found] = np.minimum(np.exp(low) * ok[found].sum(1), 1)
    return at, chance


def merge_pairs(df: DataFrame, min_overlap: int = 10, level: float = 0.01) -> DataFrame:
    """Adds merged, merged_qual and merge_p from mates seq1/qual1 and seq2/qual2 (the latter not yet reversed).

    The overlap of best score is taken (:func:`best_overlaps`; equal and different bases count by their qualities). merge_p bounds the chance
    that unrelated mates overlap as well; above ``level`` the mates are not merged (null). The whole goes from the first mate's beginning
    to the second's, what a mate reads beyond that is cut; each base comes from the mate of higher quality, of ties from the first.
    Pairs with a null aren't merged, nor are those whose sequence and quality differ in length.
    """
    cells = 4_000_000

    @F.pandas_udf("merged string, merged_qual string, merge_p double")
    def run(a: pd.Series, qa: pd.Series, b: pd.Series, qb: pd.Series) -> pd.DataFrame:
        swap = str.maketrans("ACGTacgt", "TGCAtgca")
        out: list[tuple] = [(None, None, None)] * len(a)
        pairs = []
        for k, row in enumerate(zip(a, qa, b, qb, strict=True)):
            s1, q1, s2, q2 = row
            if None not in row and len(s1) == len(q1) and len(s2) == len(q2):
                pairs.append((k, s1, q1, s2.translate(swap)[::-1], q2[::-1]))
        pairs.sort(key=lambda p: len(p[1]) + len(p[3]))
        while pairs:
            wide = len(pairs[-1][1]) + len(pairs[-1][3]) + 1
            part = pairs[-max(1, cells // (8 * wide)) :]
            del pairs[-len(part) :]
            at, chance = best_overlaps(*[[p[c] for p in part] for c in (1, 2, 3, 4)], min_overlap)
            for (k, s1, q1, s2, q2), d, p in zip(part, at.tolist(), chance.tolist(), strict=True):
                if p > level:
                    out[k] = (None, None, p)
                    continue
                lo, hi = max(0, d), min(len(s1), d + len(s2))
                u, v = (np.frombuffer(t.encode(), np.uint8) for t in (q1[lo:hi], q2[lo - d : hi - d]))
                x, y = (np.frombuffer(t.encode(), np.uint8) for t in (s1[lo:hi], s2[lo - d : hi - d]))
                mid = np.where(u >= v, x, y).tobytes().decode()
                out[k] = (s1[:lo] + mid + s2[hi - d :], q1[:lo] + np.maximum(u, v).tobytes().decode() + q2[hi - d :], p)
        return pd.DataFrame(out, columns=["merged", "merged_qual", "merge_p"])

    return df.withColumn("m", run("seq1", "qual1", "seq2", "qual2")).select("*", "m.*").drop("m")


@dataclass(frozen=True)
class UmiDesign:
    """Contexts, UMI patterns, how many bases at either end are searched and how many errors UMIs and contexts may have."""

    fwd_context: str
    rev_context: str
    fwd_umi: str
    rev_umi: str
    adapter_length: int = 250
    max_error: int = 2
    context_error: int = 5


def pattern_errors(text: list[str], pattern: str) -> np.ndarray:
    """The fewest edits that turn ``pattern`` (1 to 63 letters) into a part of each text.

    Whole columns of the edit table go as bits of one number a text: a bit says whether a cell is one more, or one less, than the cell above."""
    own, table = _codes([pattern], len(pattern))[0], np.zeros(256, np.uint8)
    for c, v in IUPAC.items():
        table[ord(c)] = table[ord(c.lower())] = v
    match = ((table[:, None] & own > 0) * (np.uint64(1) << np.arange(len(own), dtype=np.uint64))).sum(1, dtype=np.uint64)
    sizes = np.array([len(t) for t in text], int)
    width, one, top = int(sizes.max(initial=0)), np.uint64(1), np.uint64(len(own) - 1)
    letters = np.frombuffer("".join(t.ljust(width, "\0") for t in text).encode("ascii", "replace"), np.uint8).reshape(len(text), width)
    # The letters beyond a text's end match nothing, so no cell there is less than the last one of the text.
    equal = match[np.ascontiguousarray(letters.T)]
    more, less = np.full(len(text), ~np.uint64(0)), np.zeros(len(text), np.uint64)
    score = np.full(len(text), len(own), np.int32)
    best = score.copy()
    for eq in equal:
        down = (((eq & more) + more) ^ more) | eq | less
        up, low = less | ~(down | more), more & down
        score += (up >> top & one).astype(np.int32)
        score -= (low >> top & one).astype(np.int32)
        np.minimum(best, score, out=best)
        up, low, eq = up << one, low << one, eq | less
        more, less = low | ~(eq | up), up & eq
    return best


def seek_errors(reads: DataFrame, d: UmiDesign, strands: str = "intended") -> DataFrame:
    """(sample, read_id, strand, fwd_dist, rev_dist, head, tail, seq) of reads longer than the adapter length: the strand, and how many errors
    the best place of each UMI pattern has. See :func:`seek_umis`; the places themselves are not looked for."""
    patterns = (d.fwd_context, d.rev_context, d.fwd_umi, d.rev_umi)
    if not all(0 < len(x) < 64 for x in patterns):
        raise ValueError("contexts and UMI patterns have 1 to 63 letters")

    @F.pandas_udf("cf int, cr int, f int, r int")
    def run(head: pd.Series, tail: pd.Series) -> pd.DataFrame:
        texts = [head.fillna("").tolist(), tail.fillna("").tolist()]
        known = head.notna()
        made = {c: pattern_errors(texts[c == "r"], x) for c, x in zip(("cf", "cr", "f", "r"), patterns, strict=True)}
        return pd.DataFrame({c: pd.Series(x, dtype="Int32").where(known.to_numpy()) for c, x in made.items()})

    rows = reads.filter(F.length("seq") > d.adapter_length)
    rows = rows.withColumns({"head": F.left("seq", F.lit(d.adapter_length)), "tail": F.right("seq", F.lit(d.adapter_length))}).withColumn("e", run("head", "tail"))
    absent = {"intended": float("inf"), "as_written": -1.0}[strands]
    near = lambda c: F.when(F.col(c) <= d.context_error, F.col(c)).otherwise(absent)
    strand = F.when(near("e.cf") < near("e.cr"), "+").otherwise("-")
    return rows.select("sample", "read_id", strand.alias("strand"), F.col("e.f").alias("fwd_dist"), F.col("e.r").alias("rev_dist"), "head", "tail", "seq")


def _with_places(rows: DataFrame, d: UmiDesign) -> DataFrame:
    edits = aligner("global-local", PROFILES["edits"])
    rows = rows.withColumns({"f": edits(F.lit(d.fwd_umi), F.col("head")), "r": edits(F.lit(d.rev_umi), F.col("tail"))})
    cut = lambda text, a: F.col(text).substr(F.col(f"{a}.start"), F.col(f"{a}.end") - F.col(f"{a}.start") + 1)
    return rows.select("sample", "read_id", "strand", "fwd_dist", "rev_dist", cut("head", "f").alias("fwd_seq"), cut("tail", "r").alias("rev_seq"), "seq")


def seek_umis(reads: DataFrame, d: UmiDesign, strands: str = "intended") -> DataFrame:
    """(sample, read_id, strand, fwd_dist, rev_dist, fwd_seq, rev_seq, seq) of reads longer than the adapter length, with the best place of
    each UMI pattern, however many errors it has.

    The strand is + if the forward context is nearer the read's beginning than the reverse one. A context with more than ``context_error``
    errors is not there: then it counts as farther than any (``intended``) or nearer than any (``as_written``). Nulls have no strand but -.
    """
    return _with_places(seek_errors(reads, d, strands), d)


def seek_both(reads: DataFrame, d: UmiDesign, strands: str = "intended") -> DataFrame:
    """The rows of :func:`seek_errors` in which both UMI patterns are found with at most ``max_error`` errors."""
    return seek_errors(reads, d, strands).filter(F.greatest("fwd_dist", "rev_dist") <= d.max_error)


def extract_umis(reads: DataFrame, d: UmiDesign, strands: str = "intended") -> DataFrame:
    """The rows of :func:`seek_umis` in which both UMI patterns are found with at most ``max_error`` errors, and umi: both UMIs in the
    forward strand's order."""
    rows = _with_places(seek_both(reads, d, strands), d)
    back = F.concat(q.revcomp(F.col("rev_seq")), q.revcomp(F.col("fwd_seq")))
    return rows.withColumn("umi", F.when(F.col("strand") == "+", F.concat("fwd_seq", "rev_seq")).otherwise(back))


def umi_statistics(umis: DataFrame) -> DataFrame:
    """(sample, fwd, rev, ratio): strands of extracted reads, of :func:`extract_umis` or :func:`seek_both`; ratio is -1 without reverse ones."""
    n = umis.groupBy("sample").agg(F.count_if(F.col("strand") == "+").alias("fwd"), F.count_if(F.col("strand") == "-").alias("rev"))
    return n.withColumn("ratio", F.when(F.col("rev") == 0, -1.0).otherwise(F.try_divide(F.col("fwd").cast("double"), F.col("rev"))))


def extraction_report(reads: DataFrame, d: UmiDesign, strands: str = "intended") -> DataFrame:
    """(sample, n_reads, fwd, rev, ratio, both, pct): all reads of a sample, the strands of those that are long enough, those with both
    UMIs, and their share of all reads in percent. ratio is -1 without reverse reads."""
    sought = seek_errors(reads, d, strands)
    found = sought.withColumn("both", F.coalesce(F.greatest("fwd_dist", "rev_dist") <= d.max_error, F.lit(False)))
    n = found.groupBy("sample").agg(F.count_if(F.col("strand") == "+").alias("fwd"), F.count_if(F.col("strand") == "-").alias("rev"), F.count_if("both").alias("both"))
    rows = reads.groupBy("sample").agg(F.count(F.lit(1)).alias("n_reads")).join(n, "sample", "left").na.fill(0, ["fwd", "rev", "both"])
    ratio = F.when(F.col("rev") == 0, -1.0).otherwise(F.try_divide(F.col("fwd").cast("double"), F.col("rev")))
    return rows.select("sample", "n_reads", "fwd", "rev", ratio.alias("ratio"), "both", (F.col("both") * 100.0 / F.col("n_reads")).alias("pct"))


def umi_pairs(umis: DataFrame, identity: float, longest: int, shortest: int) -> DataFrame:
    """(sample, a, b, n_a): different UMIs of a sample, of ``umis`` (sample, umi, n), whose alignment matches at least ``identity`` of the
    shorter one; a comes before b, as it is commoner or, of equal ones, less.

    Pairs are proposed by a stretch that they share: with so many differences and gaps as are allowed, one of the equal pieces
    of the shorter UMI stands in the longer one, shifted by no more than the gaps. So no sample is one task's work. Where no difference is
    allowed, the shorter UMI is the longer one less some bases: then piece k is shifted by k for some k, and no alignment is needed.
    """
    # Lengths that occur, few; ``less``: by how many bases the shorter one is shorter.
    sizes = sorted(r[0] for r in umis.select(F.length("umi")).distinct().collect() if shortest <= r[0] <= longest)
    both = [(m, n - m) for m in sizes for n in sizes if m <= n]
    # So many gaps and ``wrong`` differences make wrong + less + 1 pieces; without any a UMI is near none but itself.
    cut = {
        "wrong": F.floor((1 - identity) * F.col("size") + 1e-9).cast("int"),
        "pieces": F.col("wrong") + F.col("less") + 1,
        "k": F.explode(F.when(F.col("pieces") > 1, F.sequence(F.lit(0), F.col("pieces") - 1))),
        "at": F.floor(F.col("size") * F.col("k") / F.col("pieces")).cast("int") + 1,
        "width": F.floor(F.col("size") * (F.col("k") + 1) / F.col("pieces")).cast("int") + 1 - F.col("at"),
    }
    which = F.explode(F.array(*[F.struct(F.lit(m).alias("size"), F.lit(less).alias("less")) for m, less in both] or [F.lit(None).cast("struct<size:int,less:int>")]))
    every = umis.select("sample", "umi", "n", which.alias("w")).select("sample", "umi", "n", "w.size", "w.less")
    short = every.filter(F.length("umi") == F.col("size"))
    long = every.filter(F.length("umi") == F.col("size") + F.col("less"))
    for name, column in cut.items():
        short, long = short.withColumn(name, column), long.withColumn(name, column)
    exact = F.col("wrong") == 0
    long = long.withColumn("shift", F.explode(F.when(exact, F.array("k")).otherwise(F.sequence(-F.col("wrong"), F.col("wrong") + F.col("less")))))
    long = long.withColumn("at", F.col("at") + F.col("shift")).filter("at >= 1 and at + width - 1 <= length(umi)")
    # A number stands for the stretch: two of one number are one pair more to look at.
    seed = F.xxhash64("sample", "less", "size", "k", F.col("umi").substr(F.col("at"), F.col("width"))).alias("seed")
    short = short.select("sample", F.col("umi").alias("a"), F.col("n").alias("n_a"), "wrong", seed)
    long = long.select("sample", F.col("umi").alias("b"), F.col("n").alias("n_b"), seed)
    near = short.join(long, ["seed", "sample"]).filter("a <> b")  # sorted by what tells most rows apart
    # More equal bases outweigh up to five gaps. Letters for several bases are left to the alignment.
    plain = exact & (F.length("b") - F.length("a") <= 5) & (~F.concat("a", "b").rlike("[^ACGT]"))
    near = near.withColumns({"plain": plain, "inside": inside()("a", "b")}).filter("not plain or inside")
    near = materialize(near.select("sample", "a", "b", "n_a", "n_b", "plain").distinct(), "umi-near")
    run = aligner("global", Scores(2, -3, 1, 1))
    made = near.filter("not plain").withColumn("cigar", run("a", "b")["cigar"])
    made = made.withColumn("same", matches()("a", "b", "cigar"))
    made = made.filter(F.col("same") >= identity * F.least(F.length("a"), F.length("b")) - 1e-9)
    first = (F.col("n_a") > F.col("n_b")) | ((F.col("n_a") == F.col("n_b")) & (F.col("a") < F.col("b")))
    pick = lambda x, y: F.when(first, F.col(x)).otherwise(F.col(y))
    turned = lambda rows: rows.select("sample", pick("a", "b").alias("a"), pick("b", "a").alias("b"), pick("n_a", "n_b").alias("n_a"))
    return turned(near.filter("plain")).unionByName(turned(made).distinct())  # equal lengths are aligned both ways


def inside():
    """A pandas UDF (query, subject) -> whether the subject less some of its letters is the query."""

    @F.pandas_udf("boolean")
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        table = lambda texts, end: np.array([t.encode() + end for t in texts], "S").view(np.uint8).reshape(len(texts), -1)
        x, y = table(a, b"\1"), table(b, b"\2")  # the ends are no letters, and equal none
        row, at = np.arange(len(x)), np.zeros(len(x), int)
        for k in range(y.shape[1] - 1):
            at += x[row, at] == y[:, k]
        return pd.Series(x[row, at] == 1)

    return run


def matches():
    """A pandas UDF (query, subject, cigar) -> the number of equal aligned bases."""

    @F.pandas_udf("int")
    def run(a: pd.Series, b: pd.Series, cigar: pd.Series) -> pd.Series:
        out = []
        for x, y, c in zip(a, b, cigar, strict=True):
            i = j = same = 0
            for n, op in re.findall(r"(\d+)([MID])", c):
                n = int(n)
                if op == "M":
                    same += sum(u == v for u, v in zip(x[i : i + n], y[j : j + n], strict=True))
                i += n * (op != "D")
                j += n * (op != "I")
            out.append(same)
        return pd.Series(out, dtype="int32")

    return run


def cluster_umis(umis: DataFrame, identity: float = 0.99, shortest: int = 55, longest: int = 57) -> DataFrame:
    """(sample, umi, cluster, n): greedy clusters of UMI sequences, named by their centroid. ``umis`` (sample, umi) may have
    a number n of each row's copies; null samples are left out.

    Different sequences of a sample, commonest first, join the first centroid of which they have at least ``identity`` (equal
    aligned bases over the shorter length), else become one. A sequence is decided once all commoner ones near it are: round by
    round, each a join of the pairs that still matter, so that no sample is one task's work.
    """
    counted = umis.filter(F.col("sample").isNotNull() & F.length("umi").between(shortest, longest)).groupBy("sample", "umi")
    counted = counted.agg((F.sum("n") if "n" in umis.columns else F.count(F.lit(1))).alias("n"))
    counted = materialize(counted, "umis")
    pairs = materialize(umi_pairs(counted, identity, longest, shortest), "umi-pairs")
    left, members = pairs.select("sample", "a", "b"), None
    while not left.isEmpty():
        # What has no commoner one near it, or only members, is a centre; what is near a centre is a member and matters no more.
        waits = left.select("sample", F.col("b").alias("a"))
        new = left.join(waits, ["a", "sample"], "left_anti").select("sample", F.col("b").alias("umi")).distinct()
        new = materialize(new, "umi-members")
        members = new if members is None else members.unionByName(new)
        for end in ("b", "a"):
            left = left.join(new.withColumnRenamed("umi", end), [end, "sample"], "left_anti")
        left = materialize(left, "umi-left")
    if members is None:
        return counted.select("sample", "umi", F.col("umi").alias("cluster"), "n")
    of = pairs.join(members.withColumnRenamed("umi", "a"), ["a", "sample"], "left_anti").groupBy(F.col("b").alias("umi"), "sample")
    of = of.agg(F.min(F.struct((-F.col("n_a")).alias("n"), F.col("a").alias("a"))).alias("first"))
    rows = counted.join(of, ["umi", "sample"], "left")
    return rows.select("sample", "umi", F.coalesce("first.a", "umi").alias("cluster"), "n")


def with_centre(members: DataFrame, seq: str = "seq") -> DataFrame:
    """Adds centre: the commonest sequence of each cluster's ``members`` (sample, cluster, ...), the least of ties."""
    n = members.groupBy("sample", "cluster", seq).agg(F.count(F.lit(1)).alias("n"))
    best = n.groupBy("sample", "cluster").agg(F.min_by(seq, F.struct(-F.col("n"), F.col(seq))).alias("centre"))
    return members.join(best, ["sample", "cluster"])


def polish(members: DataFrame, rounds: int = 2, seq: str = "seq", weight: str | None = None) -> DataFrame:
    """(sample, cluster, consensus): members laid over their cluster's centre, voted on, and laid over the result again, ``rounds`` times."""
    laid = with_centre(members, seq)
    made = None
    for k in range(rounds):
        made = consensus(project(laid, seq, "centre"), "projected", weight)
        if k + 1 < rounds:
            laid = members.join(made.withColumnRenamed("consensus", "centre"), ["sample", "cluster"])
    return made


def project(members: DataFrame, seq: str, centre: str, scores: Scores | None = None) -> DataFrame:
    """Adds projected: the member's base at every place of the centre, - where it has none; inserted bases are left out."""
    s = scores or Scores(8, -6, 8, 1)

    def lay(text: str, cigar: str | None) -> tuple[str | None]:
        if not cigar:
            return (None,)
        parts, at = [], 0
        for n, op in re.findall(r"(\d+)([MID])", cigar):
            n = int(n)
            if op == "D":
                parts.append("-" * n)
                continue
            if op == "M":
                parts.append(text[at : at + n])
            at += n
        return ("".join(parts),)

    made = lambda a, b: [lay(text, r[3]) for text, r in zip(a, align_texts(a, b, "global", s), strict=True)]
    return by_pair(members, seq, centre, made, "projected string")


def consensus(members: DataFrame, seq: str = "projected", weight: str | None = None) -> DataFrame:
    """(sample, cluster, consensus): at each place the base of largest weight (ties: the first letter), gaps left out.

    Votes are counted per place with partial sums, so a large cluster is no task's burden.
    """
    w = F.col(weight) if weight else F.lit(1)
    votes = members.select("sample", "cluster", w.alias("w"), F.posexplode(q.bases(F.col(seq))).alias("at", "b"))
    votes = votes.groupBy("sample", "cluster", "at", "b").agg(F.sum("w").alias("w"))
    best = votes.groupBy("sample", "cluster", "at").agg(F.min_by("b", F.struct(-F.col("w"), F.col("b"))).alias("b"))
    rows = best.groupBy("sample", "cluster").agg(F.array_sort(F.collect_list(F.struct("at", "b"))).alias("x"))
    return rows.select("sample", "cluster", F.replace(F.array_join(F.col("x.b"), ""), F.lit("-"), F.lit("")).alias("consensus"))


def quality_votes(members: DataFrame, scores: Scores | None = None) -> DataFrame:
    """(sample, cluster, at, sub, base, w): what ``members`` (sample, cluster, seq, qual, centre) say of each column of their centre.

    A base votes with the logarithm of its odds against each other base, in thousandths; a missing one (-) with the lesser vote of its
    neighbours. Column ``sub`` 0 is the centre's base after ``at`` others, 1 and on what members insert before it. Before every base each member
    also votes for no insertion (|, in column 0); in the columns where it inserts, that vote is given again, to be taken off.
    Votes are summed in batches, so no base is a row that is shuffled. Members with a null, or of other lengths of sequence and quality, don't vote.
    """
    run = aligner("global", scores or Scores(8, -6, 8, 1))
    error = np.minimum(10.0 ** (-np.arange(94) / 10), 0.75)
    table = np.rint(1000 * np.log((1 - error) / (error / 3))).astype(np.int64)
    names = ["sample", "cluster"]
    rows = members.filter("seq is not null and centre is not null and length(seq) = length(qual)")
    # A fixed number of partitions, as in align_pairs; a large cluster goes to sixteen of them.
    n = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(n, *names, F.pmod(F.xxhash64("seq", "qual"), F.lit(16))).withColumn("cigar", run("seq", "centre")["cigar"])
    kinds = ", ".join(f"{c} {members.schema[c].dataType.simpleString()}" for c in names)

    def of_member(seq: str, qual: str, cigar: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        base, w = np.frombuffer(seq.encode(), np.uint8), table[np.frombuffer(qual.encode(), np.uint8) - 33]
        far = np.iinfo(np.int64).max
        left, right = np.concatenate(([far], w)), np.concatenate((w, [far]))
        at = used = 0
        parts: list[tuple] = []
        before, skipped = [], {}  # member bases before each place of the centre; inserted ones there
        for n, kind in ((int(n), k) for n, k in re.findall(r"(\d+)([MID])", cigar)):
            if kind == "I":
                skipped[at] = n
                parts.append((np.full(n, at), np.arange(1, n + 1), base[used : used + n], w[used : used + n]))
                used += n
                continue
            before.append(used + (np.arange(n) if kind == "M" else np.zeros(n, np.int64)))
            if kind == "M":
                parts.append((at + np.arange(n), np.zeros(n, np.int64), base[used : used + n], w[used : used + n]))
                used += n
            else:
                gap = min(left[used], right[used])
                parts.append((at + np.arange(n), np.zeros(n, np.int64), np.full(n, 45), np.full(n, 0 if gap == far else gap)))
            at += n
        before.append(np.array([used]))
        r = np.concatenate(before)
        begin = r.copy()
        for place, n in skipped.items():
            begin[place] -= n
        none = np.minimum(left[begin], right[r])
        none[none == far] = 0
        parts.append((np.arange(at + 1), np.zeros(at + 1, np.int64), np.full(at + 1, 124), none))
        parts += [(np.full(n, place), np.arange(1, n + 1), np.full(n, 124), np.full(n, none[place])) for place, n in skipped.items()]
        return tuple(np.concatenate([p[k] for p in parts]) for k in range(4))

    def tally(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            part = pdf["seq"].str.len().cumsum() // 500_000
            for _, rows in pdf.groupby(part.to_numpy()):
                which, keys = pd.factorize(pd.MultiIndex.from_frame(rows[names]))
                votes = [of_member(*x) for x in zip(rows["seq"], rows["qual"], rows["cigar"], strict=True)]
                out = pd.DataFrame({c: np.concatenate([v[k] for v in votes]) for k, c in enumerate(("at", "sub", "base", "w"))})
                out["key"] = np.repeat(which, [len(v[0]) for v in votes])
                out = out.groupby(["key", "at", "sub", "base"], as_index=False)["w"].sum()
                named = pd.DataFrame(list(keys), columns=names).iloc[out["key"].to_numpy()].reset_index(drop=True)
                yield pd.concat([named, out[["at", "sub"]], out["base"].map(chr), out["w"]], axis=1)

    votes = rows.select(*names, "seq", "qual", "cigar").mapInPandas(tally, f"{kinds}, at bigint, sub bigint, base string, w bigint")
    return votes.groupBy(*names, "at", "sub", "base").agg(F.sum("w").alias("w"))


def consensus_by_quality(members: DataFrame, scores: Scores | None = None) -> DataFrame:
    """(sample, cluster, consensus) of ``members`` (sample, cluster, seq, qual, centre): in each column the base of largest likelihood.

    Columns are the centre's bases and those that members insert between them, so a base that the centre lacks is found; an insertion
    stays if its base outweighs those who have none. Of equal sums a gap is taken, then the first letter.
    """
    votes = quality_votes(members, scores)
    called = F.col("base") != "|"
    columns = votes.groupBy("sample", "cluster", "at", "sub").agg(
        F.min_by(F.when(called, F.col("base")), F.when(called, F.struct(-F.col("w"), F.col("base")))).alias("base"),
        F.max(F.when(called, F.col("w"))).alias("w"), F.sum(F.when(~called, F.col("w")).otherwise(0)).alias("none"),
    )
    places = columns.groupBy("sample", "cluster", "at").agg(
        F.max(F.when(F.col("sub") == 0, F.col("none"))).alias("none"),
        F.max(F.when(F.col("sub") == 0, F.col("base"))).alias("base"),
        F.array_sort(F.collect_list(F.when(F.col("sub") > 0, F.struct("sub", "base", "w", "none")))).alias("more"),
    )
    kept = F.filter("more", lambda c: c["w"] > F.col("none") - c["none"])
    text = F.concat(F.array_join(F.transform(kept, lambda c: c["base"]), ""), F.replace(F.coalesce("base", F.lit("")), F.lit("-"), F.lit("")))
    whole = places.groupBy("sample", "cluster").agg(F.array_sort(F.collect_list(F.struct("at", text.alias("t")))).alias("x"))
    return whole.select("sample", "cluster", F.array_join(F.col("x.t"), "").alias("consensus"))


def polish_by_quality(members: DataFrame, rounds: int = 2) -> DataFrame:
    """(sample, cluster, consensus): ``members`` (sample, cluster, seq, qual) laid over their commonest sequence, voted on by quality, and laid over
    the result again, ``rounds`` times."""
    laid, made = with_centre(members), None
    for k in range(rounds):
        made = consensus_by_quality(laid)
        if k + 1 < rounds:
            laid = members.join(made.withColumnRenamed("consensus", "centre"), ["sample", "cluster"])
    return made


def splice_template(df: DataFrame, template: str, reference: str, arm: int = 12) -> DataFrame:
    """Adds template_reference: the reference with the stretch between the template's arms replaced by the template.

    The template's first and last ``arm`` bases are aligned to the reference, on the strand on which they score more.
    """
    run = aligner("global-local", Scores(1, -1, 10, 4))
    t, ref = F.col(template), F.col(reference)
    ends = lambda x: (run(F.left(x, F.lit(arm)), ref), run(F.right(x, F.lit(arm)), ref))
    (a, b), (c, d) = ends(t), ends(q.revcomp(t))
    rows = df.withColumns({"_a": a, "_b": b, "_c": c, "_d": d})
    forward = F.col("_a.score") + F.col("_b.score") > F.col("_c.score") + F.col("_d.score")
    put = lambda x, lo, hi: F.concat(ref.substr(F.lit(1), F.col(f"{lo}.start") - 1), x, ref.substr(F.col(f"{hi}.end") + 1, F.length(ref)))
    made = F.when(forward, put(t, "_a", "_b")).otherwise(put(q.revcomp(t), "_c", "_d"))
    return rows.withColumn("template_reference", made).drop("_a", "_b", "_c", "_d")

"""Rolling hashes and content-defined anchors over bytes or words.

A *window* is ``size`` consecutive symbols of one document. Its *anchor* is the
``gram``-symbol substring in it with the smallest hash (leftmost on a tie), so
equal windows have equal anchors at equal offsets. Consecutive windows with one
anchor form a *run*. To compare windows it is enough to compare runs whose
anchors are equal, which are about 2 / (size - gram) of all positions.

Long documents are handled in blocks that overlap by ``size - 1`` symbols;
a block border only cuts a run in two.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from tripmart.llm._common import mix

_rng = np.random.default_rng(7)
BYTE = _rng.integers(0, 2 ** 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 2 ** 64)
POS_BITS = 19                       # positions in a block; the other bits order anchors
BLOCK = 1 << 18                     # symbols handled at a time
_tables = {}


def _powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2 ** 64, kept and grown by doubling."""
    t = _tables.get(base)
    if t is None or len(t) < n:
        t = np.ones(1, np.uint64)
        while len(t) < n:
            t = np.concatenate([t, t * np.uint64(pow(base, len(t), 2 ** 64))])
        _tables[base] = t
    return t[:n]


def prefix(sym: np.ndarray) -> np.ndarray:
    out = np.zeros(len(sym) + 1, np.uint64)
    np.cumsum(sym * _powers(BASE, len(sym)), out=out[1:])
    return out


def spans_hash(pre: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the symbols start..end, the same wherever they stand."""
    inv = _powers(INVERSE, len(pre))
    return mix((pre[end] - pre[start]) * inv[start] + (end - start).astype(np.uint64))


def every_hash(pre: np.ndarray, size: int) -> np.ndarray:
    n = len(pre) - size
    return mix((pre[size:] - pre[:n]) * _powers(INVERSE, n))


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Smallest of each w neighbours: running minima from both ends of blocks of w."""
    n = len(x)
    pad = np.full((-n) % w, np.iinfo(np.uint64).max, np.uint64)
    rows = np.concatenate([x, pad]).reshape(-1, w)
    fore = np.minimum.accumulate(rows, axis=1).ravel()
    back = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n - w + 1], fore[w - 1:n])


def text_buffer(col: pa.Array):
    """(bytes of all rows, offsets of the rows in them) without copying."""
    col = col.cast(pa.large_binary())
    offs = np.frombuffer(col.buffers()[1], np.int64)[col.offset:col.offset + len(col) + 1]
    data = np.frombuffer(col.buffers()[2], np.uint8) if col.buffers()[2] is not None else np.zeros(0, np.uint8)
    return data[offs[0]:offs[-1]], offs - offs[0]


def word_bounds(data: np.ndarray, offs: np.ndarray):
    """Start and end byte of every word, and the offsets of the rows in words."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offs), np.int64)
    word = (data != 32) & ((data < 9) | (data > 13))
    first = word.copy()
    first[1:] &= ~word[:-1]
    last = word.copy()
    last[:-1] &= ~word[1:]
    cut = offs[:-1][np.diff(offs) > 0]
    first[cut] = word[cut]
    last[cut[1:] - 1] = word[cut[1:] - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return start, end, np.searchsorted(start, offs)


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    out = np.empty(len(start), np.uint64)
    i = 0
    while i < len(start):
        j = max(i + 1, int(np.searchsorted(end, start[i] + 4 * BLOCK, side="right")))
        lo = start[i]
        pre = prefix(BYTE[data[lo:end[j - 1]]])
        out[i:j] = spans_hash(pre, start[i:j] - lo, end[i:j] - lo)
        i = j
    return out


@dataclass(frozen=True)
class Grams:
    unit: str        # "byte" or "word"
    size: int        # symbols of a window
    gram: int        # symbols of an anchor

    def symbols(self, col: pa.Array):
        """(symbol hashes, offsets of the rows, bytes, word starts, word ends)."""
        data, offs = text_buffer(col)
        if self.unit == "byte":
            return None, offs, data, None, None
        start, end, woffs = word_bounds(data, offs)
        return word_hashes(data, start, end), woffs, data, start, end

    def blocks(self, col: pa.Array, rows=None):
        """Yield ``Block`` objects over the rows (all, or the given numbers)."""
        sym, offs, data, _, _ = self.symbols(col)
        todo, held = [], 0
        step = BLOCK - self.size
        for r in range(len(offs) - 1) if rows is None else rows:
            n = int(offs[r + 1] - offs[r])
            if n < self.size:
                continue
            for lo in range(0, n - self.size + 1, step):
                hi = min(n, lo + step + self.size - 1)
                if held and held + hi - lo > BLOCK:
                    yield Block(self, sym, data, offs, todo)
                    todo, held = [], 0
                todo.append((r, lo, hi))
                held += hi - lo
        if todo:
            yield Block(self, sym, data, offs, todo)


class Block:
    """Runs of some pieces (row, first symbol, last symbol) of a batch.

    Arrays by run: ``row``, ``start`` (symbol of the document at which the first
    window starts), ``count`` (windows), ``anchor`` and ``content`` (hashes of
    the anchor and of all symbols of the run), ``at`` (place in the block).
    """

    def __init__(self, g: Grams, sym, data, offs, pieces):
        self.g = g
        if sym is None:
            sym_of = lambda a, b: BYTE[data[a:b]]                  # noqa: E731
        else:
            sym_of = lambda a, b: sym[a:b]                         # noqa: E731
        x = np.concatenate([sym_of(offs[r] + lo, offs[r] + hi) for r, lo, hi in pieces])
        lens = np.array([hi - lo for _, lo, hi in pieces])
        ends = np.cumsum(lens)
        begins = ends - lens
        self.pre = prefix(x)
        h = every_hash(self.pre, g.gram)
        pos = np.uint64((1 << POS_BITS) - 1)
        order = (h & ~pos) | np.arange(len(h), dtype=np.uint64)
        anchor = (sliding_min(order, g.size - g.gram + 1) & pos).astype(np.int64)
        valid = np.ones(len(anchor), bool)
        for e in ends[:-1]:
            valid[max(0, e - g.size + 1):e] = False
        new = valid.copy()
        new[1:] &= (anchor[1:] != anchor[:-1]) | ~valid[:-1]
        end = valid.copy()
        end[:-1] &= (anchor[1:] != anchor[:-1]) | ~valid[1:]
        self.at = np.flatnonzero(new)
        last = np.flatnonzero(end)
        self.count = last - self.at + 1
        self.anchor = h[anchor[self.at]]
        self.content = spans_hash(self.pre, self.at, last + g.size)
        piece = np.searchsorted(ends, self.at, side="right")
        self.row = np.array([p[0] for p in pieces])[piece]
        self.start = self.at - begins[piece] + np.array([p[1] for p in pieces])[piece]

    def windows(self, pick: np.ndarray):
        """(index of the run, offset in it, hash) of every window of the picked runs."""
        n = self.count[pick]
        run = np.repeat(pick, n)
        off = np.arange(len(run)) - np.repeat(np.cumsum(n) - n, n)
        w = self.at[run] + off
        return run, off, spans_hash(self.pre, w, w + self.g.size)


def i64(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))

"""Quantile thresholds for capping, in three modes and by one algorithm.

* ``approx`` - a value whose rank is within ``rel_error * n`` of the wanted one.
* ``disc``   - exact discrete quantile (``percentile_disc``): the value at 0-based
  rank ``ceil(q * n) - 1``.
* ``exact``  - exact interpolated quantile (``percentile`` / pandas
  ``quantile``): rank ``q * (n - 1)``, linear between its neighbours.

NULL and NaN take no part in any mode. A rank is found digit by digit: a double's bits,
turned so that they order like the values, are four digits of 16 bits. A pass over the
columns counts the values by their next digit, within the digits found so far, and keeps
the smallest and largest value of each bin; a window over the bins tells which one holds the
rank. A bin of at most ``FEW`` values is resolved in the next pass (its values themselves are the
bins). The search ends when the bin holds one value only, for ``approx`` when it holds no more
values than the accepted error, and after four passes at the latest. All columns and ranks
share the passes. A task sends at most ``FEW`` or
65,536 rows for each bracket; the driver gets one row for
each wanted rank, whatever the data holds.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DIGIT = 16             # bits
FEW = 1 << 17          # values of a bin that are told one by one
_SIGN = np.uint64(1 << 63)


def ordered_bits(x: np.ndarray) -> np.ndarray:
    """Doubles as unsigned numbers of the same order (-0.0 counts as 0.0)."""
    u = (x + 0.0).view(np.uint64)
    return np.where(u & _SIGN, ~u, u | _SIGN)


def from_bits(u: np.ndarray) -> np.ndarray:
    return np.where(u & _SIGN, u & ~_SIGN, ~u).view(np.float64)


def _histogram(vals: DataFrame, brackets: list[tuple[int, int, int, int]]) -> DataFrame:
    """(t, digit, n, lo, hi), staged: for bracket t = (column, bits found, how many, how many more)
    the values by their next bits. Only columns with a bracket are read, and of their values only those
    inside a bracket are sorted."""
    from tripmart.plans.jobs import stage

    by_col: dict[int, list[tuple[int, int, int, int]]] = {}
    for t, (col, prefix, known, width) in enumerate(brackets):
        by_col.setdefault(col, []).append((t, prefix, known, width))
    read = vals.select(*[vals.columns[c] for c in by_col])

    def merged(parts):
        t, d, n, lo, hi = (np.concatenate([p[i] for p in parts]) for i in range(5))
        o = np.lexsort((d, t))
        t, d = t[o], d[o]
        at = np.flatnonzero(np.append(True, (t[1:] != t[:-1]) | (d[1:] != d[:-1])))
        return t[at], d[at], np.add.reduceat(n[o], at), np.minimum.reduceat(lo[o], at), np.maximum.reduceat(hi[o], at)

    def count(batches):
        parts, held = [], 0
        for b in batches:
            for col, wanted in enumerate(by_col.values()):
                x = b.column(col).drop_null().to_numpy(zero_copy_only=False)
                u = ordered_bits(x[~np.isnan(x)])
                for t, prefix, known, width in wanted:
                    part = u
                    if known:
                        low = prefix << (64 - known)
                        part = u[(u >= np.uint64(low)) & (u <= np.uint64(low + (1 << (64 - known)) - 1))]
                    if not len(part):
                        continue
                    part = np.sort(part)
                    d = ((part >> np.uint64(64 - known - width)) & np.uint64((1 << width) - 1)).astype(np.int64)
                    at = np.flatnonzero(np.append(True, d[1:] != d[:-1]))
                    end = np.append(at[1:], len(d))
                    parts.append((np.full(len(at), t), d[at], end - at, part[at], part[end - 1]))
                    held += len(at)
            if held > 1 << 21:
                parts = [merged(parts)]
                held = 0
        if parts:
            t, d, n, lo, hi = merged(parts)
            yield pa.RecordBatch.from_pydict({"t": pa.array(t), "digit": pa.array(d), "n": pa.array(n),
                                              "lo": pa.array(from_bits(lo)), "hi": pa.array(from_bits(hi))})

    found = read.mapInArrow(count, "t long, digit long, n long, lo double, hi double")
    return stage(found.groupBy("t", "digit").agg(F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi")), "digits")


@dataclass
class _Target:
    """A wanted rank, and the bracket it is known to lie in."""

    col: int
    rank: int               # inside the bracket
    prefix: int = 0
    known: int = 0          # bits of the prefix
    width: int = DIGIT      # bits to find next
    value: float | None = None

    @property
    def bracket(self) -> tuple[int, int, int, int]:
        return self.col, self.prefix, self.known, self.width


def _locate(hist: DataFrame, wanted: list[tuple[int, int]]) -> dict[tuple[int, int], tuple]:
    """For (bracket, rank in it): (digit, values before, values, lo, hi) of the bin that holds it."""
    ranks: dict[int, list[int]] = {}
    for t, k in wanted:
        ranks.setdefault(t, []).append(k)
    of = F.create_map(*[x for t, ks in ranks.items() for x in (F.lit(t).cast("long"), F.array(*[F.lit(k).cast("long") for k in sorted(set(ks))]))])
    before = F.sum("n").over(Window.partitionBy("t").orderBy("digit")) - F.col("n")      # at most FEW bins a bracket
    rows = (hist.withColumn("before", before)
            .select("*", F.explode(F.filter(of[F.col("t")], lambda k: (k >= F.col("before")) & (k < F.col("before") + F.col("n")))).alias("k"))
            .collect())
    return {(r.t, r.k): (r.digit, r.before, r.n, r.lo, r.hi) for r in rows}


def _ranks(p: float, n: int, mode: str) -> list[int]:
    if mode == "exact":
        return sorted({math.floor(p * (n - 1)), math.ceil(p * (n - 1))})
    return [min(n - 1, max(0, math.ceil(p * n) - 1))]


def quantile_values(df: DataFrame, cols: list[str], ps: list[float], mode: str = "approx",
                    rel_error: float = 1e-4) -> dict[str, list[float | None]]:
    """Several quantiles of several columns: ``{col: [value per p]}``; None for a
    column with no values. Runs actions: pass a materialised frame."""
    if mode not in ("approx", "disc", "exact"):
        raise ValueError(f"unknown quantile mode {mode!r}")
    if not cols:
        return {}
    vals = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(cols)])
    brackets = [_Target(i, 0).bracket for i in range(len(cols))]
    hist = _histogram(vals, brackets)
    counts = dict.fromkeys(range(len(cols)), 0) | {r.t: r.n for r in hist.groupBy("t").agg(F.sum("n").alias("n")).collect()}
    targets = {(i, k): _Target(i, k) for i in counts if counts[i] for p in ps for k in _ranks(p, counts[i], mode)}
    while open_ := [t for t in targets.values() if t.value is None]:
        at = {b: i for i, b in enumerate(brackets)}
        found = _locate(hist, [(at[t.bracket], t.rank) for t in open_])
        for t in open_:
            digit, before, n, lo, hi = found[at[t.bracket], t.rank]
            if lo == hi or (mode == "approx" and n - 1 <= rel_error * counts[t.col]):
                t.value = float(hi)
            else:
                t.prefix, t.known, t.rank = (t.prefix << t.width) + digit, t.known + t.width, t.rank - before
                t.width = 64 - t.known if n <= FEW else DIGIT
        if brackets := sorted({t.bracket for t in open_ if t.value is None}):
            hist = _histogram(vals, brackets)

    def value(i: int, p: float) -> float | None:
        n = counts[i]
        if not n:
            return None
        got = [targets[i, k].value for k in _ranks(p, n, mode)]
        if len(got) == 1 or got[0] == got[1]:
            return got[0]
        pos = p * (n - 1)
        return got[0] + (got[1] - got[0]) * (pos - math.floor(pos))   # linear: i + (j - i) * fraction

    return {c: [value(i, p) for p in ps] for i, c in enumerate(cols)}


def thresholds(df: DataFrame, cols: list[str], q: float, mode: str = "approx",
               rel_error: float = 1e-4) -> dict[str, float | None]:
    """Quantile ``q`` of each column; None for a column with no values."""
    return {c: v[0] for c, v in quantile_values(df, cols, [q], mode, rel_error).items()}


def cap(df: DataFrame, limits: dict[str, float | None]) -> DataFrame:
    """Replace values above the limit by the limit; NULL stays NULL (no ``least``)."""
    out = df
    for c, q in limits.items():
        if q is None:
            continue
        out = out.withColumn(c, F.when(F.col(c) > F.lit(q), F.lit(q)).otherwise(F.col(c)))
    return out

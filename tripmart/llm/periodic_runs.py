"""Periodic runs of words (maximal repetitions) by recompression.

A run is a stretch of consecutive words with smallest period q and at least
``max(min_length, 2 * q)`` words that no neighbouring word extends keeping period
q. Collapsing keeps the first q words of every run and drops what only repeats
them: "a b c a b c a b c a b c" becomes "a b c".

1. Recompression turns the words of some documents (each closed by a symbol of
   its own) into a run-length grammar: block compression gives every stretch of
   one symbol a name, pair compression splits the symbols in two halves
   pseudorandomly and names the neighbours (left half, right half); the two
   alternate. Equal names are equal words, and equal stretches are parsed alike
   but for their borders.
2. Candidates stand on a harmonic grid: a run with period p holds a multiple of
   ``max(p, min_length - p)`` together with the word p places on, so about
   n * ln(n) pairs of places are enough for all periods. Pairs of different
   words go at once.
3. The grammar answers the longest common extension of a pair to both sides: go
   up while both places start a node and the nodes above have one name, step over
   equal nodes, down at a difference. The extensions are the exact borders; pairs
   with too short a stretch go. Of one stretch the smallest period is its own
   (a run of two of its periods has no other that does not divide it).

No suffix array is built, and a document is a record handled in one task: memory
is about 200 bytes a word of the longest document.

Defined cases: null or wordless text has no word and no run; rows alike are
handled one by one; other columns are not looked at. Words are what stands between
ASCII white space, compared as they are.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.llm._common import WORDS, id_type, mix, read, slices

MIN_LENGTH = 12
SLICE = 1 << 21          # bytes of text whose words share a grammar
CHUNK = 1 << 19          # candidates looked at together


class Grammar:
    """Run-length grammar over ``sym`` (names from 0), as one array of nodes by
    level: the words first, then each level of blocks or pairs. ``few``: stop
    when a level has no more nodes."""

    def __init__(self, sym: np.ndarray, few: int = 2):
        cur = sym.astype(np.int64)
        self.words = len(cur)
        names = int(cur.max()) + 1 if len(cur) else 0
        levels, base, fails, turn = [], 0, 0, 0
        low = high = np.arange(len(cur), dtype=np.int32)
        while True:
            head = None
            if len(cur) > few and fails < 6:
                head, name, names = self._blocks(cur, names) if turn % 2 == 0 else self._pairs(cur, names, turn)
                turn += 1
                if head is None:
                    fails += turn % 2 == 0
                    continue
            n = len(cur)
            if head is None:
                levels.append((cur, np.zeros(n, np.int32), low, high, np.ones(n, np.int32), np.ones(n, np.int32),
                               np.zeros(n, bool), np.zeros(n, bool)))
                break
            fails = 0
            at = np.flatnonzero(head).astype(np.int32)
            up = np.cumsum(head, dtype=np.int32) - 1
            end = np.append(at[1:], np.int32(n))
            place = np.arange(n, dtype=np.int32)
            right, left = end[up] - place, place - at[up] + 1
            last = np.append(head[1:], True)
            if turn % 2 == 0:                    # a pair has two symbols: one step is one of them
                step = np.ones(n, np.int32)
                levels.append((cur, up + np.int32(base + n), low, high, step, step, head, last))
            else:
                levels.append((cur, up + np.int32(base + n), low, high, right, left, head, last))
            low, high = at + np.int32(base), end - 1 + np.int32(base)
            cur, base = name, base + n
        (self.sym, self.parent, self.low, self.high, self.right, self.left, self.first, self.last) = (
            np.concatenate(x) for x in zip(*levels, strict=True))

    @staticmethod
    def _blocks(cur, names):
        same = cur[1:] == cur[:-1]
        if not same.any():
            return None, None, names
        head = np.concatenate([[True], ~same])
        at = np.flatnonzero(head)
        size = np.diff(np.append(at, len(cur)))
        name = cur[at].copy()
        long = size > 1
        _, new = np.unique(name[long] * (len(cur) + 1) + size[long], return_inverse=True)
        name[long] = names + new
        return head, name, names + int(new.max()) + 1

    @staticmethod
    def _pairs(cur, names, turn):
        half = (mix(cur.astype(np.uint64) + np.uint64(turn << 40)) & np.uint64(1)).astype(bool)
        pick = ~half[:-1] & half[1:]
        other = half[:-1] & ~half[1:]
        if other.sum() > pick.sum():
            pick = other
        if not pick.any():
            return None, None, names
        at = np.flatnonzero(pick)
        head = np.ones(len(cur), bool)
        head[at + 1] = False
        name = cur.copy()
        _, new = np.unique(cur[at] * names + cur[at + 1], return_inverse=True)
        name[at] = names + new
        return head, name[head], names + int(new.max()) + 1

    def extension(self, i: np.ndarray, j: np.ndarray, step: int) -> np.ndarray:
        """How many words agree from places ``i`` and ``j`` > i on, to the right
        (step 1) or left (step -1). Every document must end in a symbol that occurs
        once, and one must stand before the first."""
        edge, more, down = (self.first, self.right, self.low) if step > 0 else (self.last, self.left, self.high)
        out = np.zeros(len(i), np.int64)
        live, a, b, up = np.arange(len(i)), i.astype(np.int64), j.astype(np.int64), np.ones(len(i), bool)
        while len(live):
            over = self.parent[a], self.parent[b]
            climb = up & edge[a] & edge[b]
            climb &= self.sym[over[0]] == self.sym[over[1]]
            same = self.sym[a] == self.sym[b]
            go = same & ~climb
            far = step * np.minimum(more[a], more[b])
            drop = ~same & ~climb
            end = drop & (a < self.words)
            out[live[end]] = np.abs(b[end] - j[live[end]])
            a = np.where(climb, over[0], np.where(go, a + far, down[a]))
            b = np.where(climb, over[1], np.where(go, b + far, down[b]))
            up &= ~drop
            keep = ~end
            live, a, b, up = live[keep], a[keep], b[keep], up[keep]
        return out


def _grid(n: np.ndarray, begin: np.ndarray, min_length: int):
    """Yield (places, periods) of the harmonic grid, ``CHUNK`` pairs or so at a time."""
    n, begin = n[n >= min_length], begin[n >= min_length]
    most = n // 2
    doc = np.repeat(np.arange(len(n)), most)
    p = np.arange(len(doc)) - np.repeat(np.cumsum(most) - most, most) + 1
    gap = np.maximum(p, min_length - p)
    count = (n[doc] - 1 - p) // gap + 1
    upto = np.cumsum(count)
    lo = 0
    while lo < len(p):
        hi = max(lo + 1, int(np.searchsorted(upto, (upto[lo - 1] if lo else 0) + CHUNK, side="right")))
        c = count[lo:hi]
        own = np.repeat(np.arange(lo, hi), c)
        k = np.arange(len(own)) - np.repeat(np.cumsum(c) - c, c)
        yield begin[doc[own]] + k * gap[own], p[own]
        lo = hi


def _smallest(start, end, period):
    """Of each (start, end) the smallest period, sorted by start and period."""
    o = np.lexsort((period, end, start))
    start, end, period = start[o], end[o], period[o]
    new = np.ones(len(o), bool)
    new[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    start, end, period = start[new], end[new], period[new]
    o = np.lexsort((period, start))
    return start[o], end[o], period[o]


def find_runs(ids: np.ndarray, lens: np.ndarray, min_length: int = MIN_LENGTH):
    """(document, start, length, period) of all runs, sorted, of documents given one
    after another: ``ids`` are names of words from 0, ``lens`` words by document."""
    lens = np.asarray(lens, np.int64)
    begin = np.cumsum(lens) - lens + np.arange(len(lens)) + 1
    top = int(ids.max()) + 1 if len(ids) else 0
    sym = top + np.arange(len(ids) + len(lens) + 1, dtype=np.int64)          # closing symbols, each once
    place = np.arange(len(ids)) + np.repeat(np.arange(len(lens)), lens) + 1
    sym[place] = ids
    rest = np.ones(len(sym), bool)
    rest[place] = False
    sym[rest] = top + np.arange(int(rest.sum()))
    grammar, found = None, []
    for i, p in _grid(lens, begin, min_length):
        j = i + p
        hit = np.flatnonzero(sym[i] == sym[j])
        i, j, p = i[hit], j[hit], p[hit]
        near = (sym[i + 1] == sym[j + 1]) | (sym[i - 1] == sym[j - 1])       # a run has more than one such pair in a row
        i, j, p = i[near], j[near], p[near]
        if not len(i):
            continue
        grammar = grammar or Grammar(sym, 2 * len(lens) + 2)
        s = i - grammar.extension(i - 1, j - 1, -1)
        e = j + grammar.extension(i, j, 1)
        ok = e - s >= np.maximum(min_length, 2 * p)
        found.append(_smallest(s[ok], e[ok], p[ok]))
    if not found:
        return (np.zeros(0, np.int64),) * 4
    s, e, p = _smallest(*(np.concatenate(x) for x in zip(*found, strict=True)))
    doc = np.searchsorted(begin, s, side="right") - 1
    return doc, s - begin[doc], e - s, p


def _scan(min_length: int, with_text: bool):
    def work(batches):
        for b in (b for whole in batches for b in slices(whole, 1, SLICE)):
            words = [(t or b"").split() for t in b.column(1).cast(pa.binary()).to_pylist()]
            lens = np.array([len(w) for w in words], np.int64)
            names = pa.array([x for w in words for x in w], pa.binary()).dictionary_encode().indices.to_numpy()
            doc, start, size, period = find_runs(names, lens, min_length)
            cut = np.searchsorted(doc, np.arange(len(words) + 1))
            runs, hashes, texts = [], [], []
            for k, w in enumerate(words):
                at = slice(cut[k], cut[k + 1])
                s, n, q = start[at], size[at], period[at]
                runs.append([{"start": x, "length": y, "period": z}
                             for x, y, z in zip(s.tolist(), n.tolist(), q.tolist(), strict=True)])
                if len(s):
                    step = np.zeros(len(w) + 1, np.int64)
                    np.add.at(step, s + q, 1)
                    np.add.at(step, s + n, -1)
                    w = [w[x] for x in np.flatnonzero(np.cumsum(step)[:-1] == 0).tolist()]
                kept = b" ".join(w)
                hashes.append(hashlib.sha256(kept).hexdigest())
                texts.append(kept if with_text else b"")
            cols = [b.column(0), pa.array(lens), pa.array(runs, RUNS), pa.array(hashes, pa.string())]
            if with_text:
                cols.append(pa.array(texts, pa.binary()).cast(pa.string()))
            yield pa.RecordBatch.from_arrays(cols, ["id", "n_words", "runs", "collapsed_sha256", "collapsed"][:len(cols)])
    return work


RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def periodic_runs(docs: DataFrame, min_length: int = MIN_LENGTH, id_col: str = "doc_id", text_col: str = "text",
                  with_text: bool = True) -> DataFrame:
    """One row per document: id, n_words, runs (start word, length, period; by start,
    then period), collapsed_sha256 and, with ``with_text``, the collapsed text (words
    joined by one space)."""
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    extra = ", collapsed string" if with_text else ""
    return rows.mapInArrow(_scan(min_length, with_text), f"id {id_type(rows)}, n_words long, "
                           f"runs array<struct<start: long, length: long, period: long>>, collapsed_sha256 string{extra}")


def looped(docs: DataFrame) -> DataFrame:
    """(doc_id, text): documents with crc32(doc_id) % 10 = 0 get a periodic tail, the
    other texts stay as they are; a null id has no such number."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    w = F.regexp_extract_all(text, F.lit(WORDS), F.lit(0))
    rows = docs.select("doc_id", text.alias("text"), h.alias("h"), F.when(h % 10 == 0, w).alias("w"))
    g = F.floor(F.col("h") / 10)
    rows = rows.withColumn("a", F.when(F.size("w") > 0, g % F.size("w")))
    rows = rows.withColumn("p", 1 + F.floor((F.size("w") - F.col("a")) / (3 + g % 8)))
    tail = F.transform("w", lambda x, i: F.when(i < F.col("a"), x).otherwise(
        F.get("w", (F.col("a") + (i - F.col("a")) % F.col("p")).cast("int"))))
    return rows.select("doc_id", F.when(F.col("a").isNotNull(), F.array_join(tail, " ")).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = periodic_runs(looped(read(spark, sf_dir, "documents")), with_text=False)
    # greatest length first, then smallest start and period
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    lines = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"),
                                                   F.lit(","), r["period"].cast("string"), F.lit("\n")))
    return (out.withColumn("b", best)
            .select(F.col("id").alias("doc_id"), F.size("runs").cast("long").alias("n_runs"), (-F.col("b.s")).alias("start"),
                    F.col("b.length").alias("length"), (-F.col("b.p")).alias("period"),
                    F.floor(1000 * F.col("b.length") / -F.col("b.p")).alias("exponent_milli"),
                    F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"), "collapsed_sha256"))

"""Exact repeats of ``size`` bytes by sorted windows, in place of a suffix array.

A window of ``size`` bytes is a later copy if the same bytes start at an earlier place, and a
first copy that recurs if they start at a later one: in suffix order it is told by the neighbours,
as LPF >= size would tell it. No factor lengths (LPF, PSV, NSV) are computed beyond that.

A suffix array of the whole corpus needs 8 bytes or more per byte of text. Here
windows are sorted piece by piece, where a match is possible at all:

1. Runs of windows with one anchor (``_grams``); equal windows lie in runs with
   equal anchors, so anchors that stand once are out (``_repeats``).
2. Runs equal as a whole (hashes of anchor and content) are one class: all its members but the
   first are later copies in full. One member speaks for the class from here on.
3. Classes that share an anchor but differ match in part. Their texts (a few
   hundred bytes each) meet by anchor, and their windows are sorted and compared as bytes.
   An anchor with over ``GROUP`` classes is not gathered: its windows are dealt
   by their own hash instead, and the order within equal windows is the
   order of positions, an aggregation with partial sums. Equality is then that
   of two 64-bit hashes (anchor and window) instead of bytes.

Documents are ordered by id (null last), then by text hash; positions follow.
Rows with the same id and text are copies of each other and keep the same
bytes. A null text is empty, a text under ``size`` bytes has no window.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.llm._common import id_type, keyed, read, same_row, slices, stage
from tripmart.llm._grams import Grams, i64, text_buffer
from tripmart.llm._repeats import classes, picked, repeated_runs, run_filter

GROUP = 64


def lpf(pieces: list[bytes], size: int):
    """LPF and its mirror over pieces given in position order, cut off at ``size``.

    Returns (piece, offset, later) arrays of the windows that match: later is
    whether an earlier position matches, else only a later one does."""
    keys = [p[i:i + size] for p in pieces for i in range(len(p) - size + 1)]
    order = sorted(range(len(keys)), key=keys.__getitem__)          # stable: ties by position
    same = np.fromiter((keys[a] == keys[b] for a, b in zip(order, order[1:], strict=False)), bool, len(order) - 1)
    sa = np.array(order, np.int64)
    # inside a stretch of equal factors positions rise: PSV is the left neighbour, NSV does not exist
    psv = np.concatenate([[False], same])
    follows = np.concatenate([same, [False]])
    hit = psv | follows
    counts = np.array([len(p) - size + 1 for p in pieces])
    base = np.cumsum(counts) - counts
    at = sa[hit]
    piece = np.searchsorted(base, at, side="right") - 1
    return piece, at - base[piece], psv[hit]


def _partial(docs: DataFrame, cls: DataFrame, g: Grams) -> DataFrame:
    """Matches in part between different classes: (id, th, start, later)."""
    idt = id_type(docs)
    docs = docs.withColumn("ih", F.xxhash64("id"))
    mixed = cls.filter("nc > 1").select("anchor", "content", "nc", "first.*")
    rare, hot = (mixed.filter(c) for c in (f"nc <= {GROUP}", f"nc > {GROUP}"))
    rare_f, hot_f = run_filter(rare), run_filter(hot)
    place = f"id {idt}, th long, start long"

    def pieces(batches):
        for bl, at in picked(batches, g, rare_f):
            data, offs = text_buffer(bl.batch.column(2))
            row = pa.array(bl.row[at])
            lo = offs[bl.row[at]] + bl.start[at]
            hi = lo + bl.count[at] + g.size - 1
            yield pa.RecordBatch.from_arrays(
                [bl.batch.column(0).take(row), bl.batch.column(1).take(row), pa.array(bl.start[at]),
                 i64(bl.anchor[at]), pa.array([data[x:y].tobytes() for x, y in zip(lo, hi, strict=True)], pa.binary())],
                ["id", "th", "start", "anchor", "piece"])

    def groups(batches):
        # copies of one piece (repeated rows, null ids) are one class; the first place speaks for it
        held, now = {}, None

        def close():
            if len(held) > 1:
                rs = list(held.values())
                p, off, later = lpf([r[3] for r in rs], g.size)
                # runs of neighbouring offsets with one verdict become one row
                o = np.lexsort((off, p))
                p, off, later = p[o], off[o], later[o]
                new = np.ones(len(p), bool)
                new[1:] = (p[1:] != p[:-1]) | (off[1:] != off[:-1] + 1) | (later[1:] != later[:-1])
                at = np.flatnonzero(new)
                size = np.diff(np.append(at, len(p)))
                for i, n in zip(at, size, strict=True):
                    r = rs[p[i]]
                    yield r[0], r[1], r[2] + int(off[i]), int(n), bool(later[i])

        def flush(rows):
            cols = list(zip(*rows, strict=True))
            return pa.RecordBatch.from_arrays(
                [pa.array(cols[0], idtype), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64()),
                 pa.array(cols[3], pa.int64()), pa.array(cols[4], pa.bool_())],
                ["id", "th", "start", "count", "later"])

        done, idtype = [], None
        for b in batches:
            idtype = b.schema.field("id").type
            cols = [b.column(i).to_pylist() for i in range(5)]
            for i, th, s, a, p in zip(*cols, strict=True):
                if a != now:
                    done += close()
                    held, now = {}, a
                held.setdefault(p, (i, th, s, p))
            if len(done) > 20_000:
                yield flush(done)
                done = []
        done += close()
        if done:
            yield flush(done)

    few = (docs.mapInArrow(pieces, f"{place}, anchor long, piece binary")
           .repartition("anchor")
           .sortWithinPartitions("anchor", F.col("id").asc_nulls_last(), "th", "start")
           .mapInArrow(groups, f"{place}, count long, later boolean"))

    def windows(batches):
        for bl, at in picked(batches, g, hot_f):
            run, off, h = bl.windows(at)
            row = pa.array(bl.row[run])
            yield pa.RecordBatch.from_arrays(
                [bl.batch.column(0).take(row), bl.batch.column(1).take(row), pa.array(bl.start[run] + off),
                 i64(bl.anchor[run]), i64(bl.content[run]), i64(h)],
                ["id", "th", "start", "anchor", "content", "h"])

    many = stage(docs.mapInArrow(windows, f"{place}, anchor long, content long, h long"), "windows")
    first = F.struct(F.col("id").isNull().alias("no_id"), "id", "th", "start")
    tied = (many.groupBy("anchor", "h")
            .agg(F.min(first).alias("first"), F.min("content").alias("c0"), F.max("content").alias("c1"))
            .filter("c0 <> c1").select("anchor", "h", "first"))
    hits = (many.join(tied, ["anchor", "h"])
            .select("id", "th", "start", F.lit(1).cast("long").alias("count"),
                    (first != F.col("first")).alias("later")))
    return few.unionByName(hits)


def repeats(docs: DataFrame, size: int = 400, id_col: str = "doc_id", text_col: str = "text",
            gram: int | None = None) -> DataFrame:
    """Windows of ``size`` bytes that occur more than once: (id, th, start, end,
    later). ``later`` windows have an earlier copy; the others recur later only.
    Spans may touch or overlap. ``gram``: bytes of an anchor."""
    docs = keyed(docs, id_col, text_col)
    g = Grams("byte", size, gram or min(64, -(-size // 4)))
    runs = repeated_runs(docs, g)
    cls = classes(runs)
    span = lambda n: [F.col("start"), (F.col("start") + n + (size - 1)).alias("end")]
    here = F.struct(F.col("id").isNull().alias("no_id"), "id", "th", "start")
    whole = (runs.drop("count").join(cls.filter("n > 1").select("anchor", "content", "first", "count"),
                                     ["anchor", "content"])
             .select("id", "th", *span(F.col("count")), (here != F.col("first")).alias("later")))
    part = _partial(docs, cls, g).select("id", "th", *span(F.col("count")), "later")
    return whole.unionByName(part)


def _cut(batches, with_text):
    for b in (b for whole in batches for b in slices(whole, 2)):
        data, offs = text_buffer(b.column(2))
        keep_hash, removed, spans, kept = [], [], [], []
        for i, found in enumerate(b.column(3).to_pylist()):
            t = data[offs[i]:offs[i + 1]]
            keep = np.ones(len(t), bool)
            if found:
                se = np.array([(f["start"], f["end"]) for f in found])
                step = np.zeros(len(t) + 1, np.int64)
                np.add.at(step, se[:, 0], 1)
                np.add.at(step, se[:, 1], -1)
                keep = np.cumsum(step)[:-1] == 0
            left = t[keep].tobytes()
            gone = ~keep
            removed.append(int(gone.sum()))
            spans.append(int((gone[1:] & keep[:-1]).sum() + (len(gone) > 0 and gone[0])))
            keep_hash.append(hashlib.sha256(left).hexdigest())
            kept.append(left)
        arrays = [b.column(0), pa.array(np.diff(offs)), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()),
                  pa.array(keep_hash, pa.string())]
        if with_text:
            arrays.append(pa.array([k.decode("utf-8", "ignore") for k in kept], pa.string()))
        yield pa.RecordBatch.from_arrays(arrays, ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"][:len(arrays)])


def dedup(docs: DataFrame, size: int = 400, keep: str = "first", id_col: str = "doc_id",
          text_col: str = "text", with_text: bool = True) -> DataFrame:
    """One row per document: id, n_bytes, n_removed, n_spans (maximal removed
    runs), kept_sha256 and, with ``with_text``, the kept text (bytes that no
    longer form UTF-8 are left out of it).

    ``keep="first"`` removes later copies; ``keep="none"`` every copy."""
    found = repeats(docs, size, id_col, text_col)
    if keep == "first":
        found = found.filter("later")
    spans = found.groupBy("id", "th").agg(F.collect_set(F.struct("start", "end")).alias("found"))
    rows = keyed(docs, id_col, text_col)
    joined = rows.join(spans, same_row(rows, spans), "left").select(rows["id"], rows["th"], "text", "found")
    extra = ", kept string" if with_text else ""
    return joined.mapInArrow(lambda bs: _cut(bs, with_text),
                             f"id {id_type(rows)}, n_bytes long, n_removed long, n_spans long, kept_sha256 string{extra}")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every byte inside a 400-byte string that stands anywhere else goes."""
    return dedup(read(spark, sf_dir, "documents"), 400, keep="none", with_text=False).withColumnRenamed("id", "doc_id")

"""Shared first half of the two exact repeat operators: which runs of windows
(see ``_grams``) have an anchor that stands more than once in the corpus.

Only 8 bytes per run are shuffled for the whole corpus; what comes back to the
scan is a bounded bit filter. Its false positives bring in runs that meet no
partner and change nothing.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm._common import bit_filter, id_type, mix, slices, stage
from tripmart.llm._grams import Grams, i64


def _repeated_anchors(docs: DataFrame, g: Grams) -> DataFrame:
    def scan(batches):
        for whole in batches:
            for bl in (bl for b in slices(whole, 0) for bl in g.blocks(b.column(0))):
                yield pa.RecordBatch.from_pydict({"anchor": i64(bl.anchor)})

    return (docs.select("text").mapInArrow(scan, "anchor long")
            .groupBy("anchor").agg(F.count(F.lit(1)).alias("n"))
            .filter("n > 1").select("anchor"))


def repeated_runs(docs: DataFrame, g: Grams) -> DataFrame:
    """(id, th, anchor, content, start, count), staged: every run of ``docs``
    (id, th, text) whose anchor occurs again, and a few others."""
    seen = bit_filter(stage(_repeated_anchors(docs, g), "anchors"))

    def scan(batches):
        for b in (b for whole in batches for b in slices(whole, 2)):
            for bl in g.blocks(b.column(2)):
                at = np.flatnonzero(seen.value.has(bl.anchor))
                row = pa.array(bl.row[at])
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(row), b.column(1).take(row), i64(bl.anchor[at]), i64(bl.content[at]),
                     pa.array(bl.start[at]), pa.array(bl.count[at].astype(np.int32))],
                    ["id", "th", "anchor", "content", "start", "count"])

    return stage(docs.mapInArrow(scan, f"id {id_type(docs)}, th long, anchor long, content long, "
                                       "start long, count int"), "runs")


def classes(runs: DataFrame) -> DataFrame:
    """(anchor, content, n, first, nc): one row per different run, how often it
    occurs, its first place (documents by id, null last) and how many different
    runs share its anchor; only where there is more than one such run or copy."""
    place = F.struct(F.col("id").isNull().alias("no_id"), "id", "th", "start")
    cls = (runs.groupBy("anchor", "content")
           .agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("first"), F.first("count").alias("count")))
    cls = stage(cls, "classes")
    mixed = cls.groupBy("anchor").agg(F.count(F.lit(1)).alias("nc"), F.sum("n").alias("na")).filter("na > 1")
    return stage(cls.join(mixed.drop("na"), "anchor"), "classes")


def _run_key(anchor, th, start, id_hash) -> np.ndarray:
    return mix(anchor ^ mix(th + mix(id_hash) + start.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))


def run_filter(runs: DataFrame):
    """Bit filter over runs given as (anchor, id, th, start), for ``picked``. The id is
    part of the key: other documents with the same text do not pass for this one."""
    def key(b):
        return _run_key(*(b.column(i).to_numpy(zero_copy_only=False).view(np.uint64) for i in range(4)))

    base = runs.select("anchor", "th", "start", F.xxhash64("id").alias("ih"))
    return bit_filter(base, key), bit_filter(base.select("th").distinct())


def picked(batches, g: Grams, filters):
    """(block, indices of its picked runs) over the rows of (id, th, text, ih: hash of
    the id) that the document filter lets through; ``block.batch`` holds those rows."""
    run_f, doc_f = filters
    u64 = lambda b, i: b.column(i).to_numpy(zero_copy_only=False).view(np.uint64)          # noqa: E731
    for b in (b for whole in batches for b in slices(whole, 2)):
        part = b.take(pa.array(np.flatnonzero(doc_f.value.has(u64(b, 1)))))
        th, ih = u64(part, 1), u64(part, 3)
        for bl in g.blocks(part.column(2)):
            bl.batch = part
            at = np.flatnonzero(run_f.value.has(_run_key(bl.anchor, th[bl.row], bl.start, ih[bl.row])))
            if len(at):
                yield bl, at

"""Substring dedup over word k-mers as edges of a De Bruijn graph.

Every ``size``-word window is an edge of the De Bruijn graph of the corpus,
named by its words. Listing all edges would shuffle one row per word, so runs of edges
with one minimiser stand in for unitigs: no edge's end is joined to the next one's start and
no degrees are counted.

1. A run of windows with one anchor (``_grams``) is a path piece. Equal edges
   lie in pieces with equal anchors; pieces whose anchor stands once cannot
   hold a repeated edge and go (``_repeats``).
2. Pieces equal as a whole are nonbranching: a join on (anchor, content) merges
   them into one class with the smallest document id as its source.
3. Where different pieces share an anchor the path branches: one piece per
   class is opened into its edges, which are joined by (anchor, edge hash).
4. Edges of a document whose source is an earlier document become spans of word
   coordinates; spans that touch are one path again when the words are removed.

An edge is removed if its words also start in a document with a smaller id. A
null id is never smaller, and is larger than every id; two rows with one id are
one document. Null text has no words. Identity of whole pieces is that of two
64-bit hashes (anchor and content), that of edges in branching pieces is that of
one, mixed from anchor and edge.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.llm._common import bit_filter, id_type, keyed, mix, read, same_row, slices, stage
from tripmart.llm._grams import Grams, i64, text_buffer, word_bounds
from tripmart.llm._repeats import repeated_runs


def _sources(runs: DataFrame) -> DataFrame:
    """(anchor, content, n, src) staged: each different path piece, how often it
    occurs and the smallest id it occurs in."""
    return stage(runs.groupBy("anchor", "content").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("src")), "pieces")


def _key(anchor, content, id_hash) -> np.ndarray:
    return mix(anchor ^ mix(content + id_hash))


def _branches(docs: DataFrame, pieces: DataFrame, g: Grams) -> DataFrame:
    """(id, th, start) of edges that an earlier document has, in pieces that share
    an anchor with a different piece. Only a piece's first document opens it."""
    several = pieces.groupBy("anchor").agg(F.count(F.lit(1)).alias("k")).filter("k > 1").select("anchor")
    first = stage(pieces.join(several, "anchor", "left_semi")
                  .select("anchor", "content", F.xxhash64("src").alias("ih")), "branching")
    u64 = lambda b, i: b.column(i).to_numpy(zero_copy_only=False).view(np.uint64)          # noqa: E731
    piece_f = bit_filter(first, lambda b: _key(u64(b, 0), u64(b, 1), u64(b, 2)))
    doc_f = bit_filter(first.select("ih").distinct())

    def edges(batches):
        for b in (b for whole in batches for b in slices(whole, 2)):
            rows = np.flatnonzero(doc_f.value.has(u64(b, 3)))
            part = b.take(pa.array(rows))
            for bl in g.blocks(part.column(2)):
                at = np.flatnonzero(piece_f.value.has(_key(bl.anchor, bl.content, u64(part, 3)[bl.row])))
                run, off, h = bl.windows(at)
                row = pa.array(bl.row[run])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(row), part.column(1).take(row), pa.array(bl.start[run] + off),
                     i64(mix(h ^ bl.anchor[run]))], ["id", "th", "start", "edge"])

    e = stage(docs.withColumn("ih", F.xxhash64("id")).mapInArrow(edges, f"id {id_type(docs)}, th long, start long, edge long"), "edges")
    src = e.groupBy("edge").agg(F.min("id").alias("src"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    return e.join(src, "edge").filter(LATER).select("id", "th", "start")


LATER = "src is not null and (id is null or src < id)"


def removed_spans(docs: DataFrame, size: int = 13, gram: int = 4, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """(id, th, start, end): word spans that repeat an earlier document; they may overlap."""
    docs = keyed(docs, id_col, text_col)
    g = Grams("word", size, min(gram, size))
    runs = repeated_runs(docs, g)
    pieces = _sources(runs)
    whole = (runs.join(pieces.filter("n > 1").select("anchor", "content", "src"), ["anchor", "content"])
             .filter(LATER).select("id", "th", "start", (F.col("start") + F.col("count") + (size - 1)).alias("end")))
    part = _branches(docs, pieces, g).select("id", "th", "start", (F.col("start") + size).alias("end"))
    return whole.unionByName(part)


def _cut(batches, with_text):
    for b in (b for whole in batches for b in slices(whole, 2)):
        data, offs = text_buffer(b.column(2))
        start, end, woffs = word_bounds(data, offs)
        raw = data.tobytes()
        n_words, removed, digest, kept = np.diff(woffs), [], [], []
        for i, found in enumerate(b.column(3).to_pylist()):
            lo, n = int(woffs[i]), int(n_words[i])
            keep = np.ones(n, bool)
            if found:
                se = np.array([(f["start"], f["end"]) for f in found])
                step = np.zeros(n + 1, np.int64)
                np.add.at(step, se[:, 0], 1)
                np.add.at(step, se[:, 1], -1)
                keep = np.cumsum(step)[:-1] == 0
            at = lo + np.flatnonzero(keep)
            left = b" ".join([raw[s:e] for s, e in zip(start[at].tolist(), end[at].tolist(), strict=True)])
            removed.append(n - len(at))
            digest.append(hashlib.sha256(left).hexdigest())
            kept.append(left)
        arrays = [b.column(0), pa.array(n_words), pa.array(removed, pa.int64()), pa.array(digest, pa.string())]
        if with_text:
            arrays.append(pa.array([k.decode() for k in kept], pa.string()))
        yield pa.RecordBatch.from_arrays(arrays, ["id", "n_words", "n_removed", "kept_sha256", "kept"][:len(arrays)])


def dedup(docs: DataFrame, size: int = 13, id_col: str = "doc_id", text_col: str = "text",
          with_text: bool = True) -> DataFrame:
    """One row per document: id, n_words, n_removed, kept_sha256 of the kept words
    joined by one space and, with ``with_text``, those words. Texts are shuffled
    only if a bit filter says that they may lose a word."""
    found = removed_spans(docs, size, id_col=id_col, text_col=text_col)
    spans = stage(found.groupBy("id", "th").agg(F.collect_set(F.struct("start", "end")).alias("found")), "spans")
    rows = keyed(docs, id_col, text_col)
    hit = bit_filter(spans.select("th").distinct())
    schema = f"id {id_type(rows)}, n_words long, n_removed long, kept_sha256 string{', kept string' if with_text else ''}"

    def some(wanted):
        def scan(batches):
            for b in (b for whole in batches for b in slices(whole, 2)):
                th = b.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
                yield b.take(pa.array(np.flatnonzero(hit.value.has(th) == wanted)))
        return scan

    def whole_texts(batches):
        for b in some(False)(batches):
            none = pa.nulls(b.num_rows, pa.null())
            yield from _cut([pa.RecordBatch.from_arrays([*b.columns, none], [*b.schema.names, "found"])], with_text)

    cut = rows.mapInArrow(some(True), rows.schema)
    joined = cut.join(spans, same_row(cut, spans), "left").select(cut["id"], cut["th"], "text", "found")
    return rows.mapInArrow(whole_texts, schema).unionByName(joined.mapInArrow(lambda bs: _cut(bs, with_text), schema))


def op4_debruijn_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words inside a 13-word window that an earlier document has go."""
    return dedup(read(spark, sf_dir, "documents"), 13, with_text=False).withColumnRenamed("id", "doc_id")

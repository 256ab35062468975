"""SimHash near-dedup over a Gray-order hierarchical index.

Fingerprints of ``bits`` = 64 come from the xxhash64 of word shingles. Two
fingerprints link when they differ in at most ``distance`` bits, and documents
reachable by links form one component.

* Equal fingerprints are collapsed before anything is compared, so exact copies
  cost one row whatever their number.
* A fingerprint goes to ``distance + 1`` cells, one for each of as many bit
  blocks: two that differ in at most ``distance`` bits agree in a block.
* A cell is searched through the index: fingerprints sorted by Gray rank, so
  neighbours share most bits; leaves of ``LEAF`` neighbours and upper nodes hold
  the bits their members agree in (mask and pattern). Going down, a pair of
  nodes is dropped with all its members as soon as the agreed bits alone differ
  in more than ``distance`` places. Only surviving leaf pairs are compared.
* A cell of over ``CELL`` members is cut into slices (by hash) that meet in
  pairs, each pair in a task of its own: no task holds an unbounded cell.
* A task returns a spanning forest of the links it has found, never all pairs,
  which loses no connection; components follow from the forest.

Defined cases: null or wordless text has fingerprint zero and links like any
other; fewer words than a shingle give one shingle of the whole sequence; a null
id is a document whose component is that of its fingerprint; if no id is known
in it, the component is null. Texts are read whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.llm._common import id_type, read, stage
from tripmart.llm._graph import components, forest

LEAF = 16
CELL = 4096
SEED = 42


def fingerprint(text: str | None, shingle: int) -> int:
    """64-bit SimHash of the shingles of the lower-cased (A-Z) text."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    data = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    k = min(shingle, len(words))
    counts, n = np.zeros(64, np.int64), len(words) - k + 1
    first, last = starts[:n].tolist(), ends[k - 1:].tolist()
    h64 = xxhash.xxh64_intdigest
    for i in range(0, n, 1 << 16):
        h = np.array([h64(data[a:b], SEED) for a, b in zip(first[i:i + (1 << 16)], last[i:i + (1 << 16)], strict=True)],
                     np.uint64)
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, shingle: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp): fp is the fingerprint as a signed long."""
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))

    def scan(batches):
        for b in batches:
            fp = np.array([fingerprint(t.as_py(), shingle) for t in b.column(1)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp)], ["id", "fp"])

    return rows.mapInArrow(scan, f"id {id_type(rows)}, fp long")


# ------------------------------------------------------------------- index

def gray_rank(fp: np.ndarray) -> np.ndarray:
    """Place of each fingerprint in the Gray order (inverse Gray code)."""
    r = fp.copy()
    for s in (1, 2, 4, 8, 16, 32):
        r ^= r >> np.uint64(s)
    return r


def _levels(fp: np.ndarray, fan: int = 8):
    """Node levels from the leaves up: (mask of agreed bits, pattern, first, last)."""
    cuts = np.arange(0, len(fp), LEAF)
    first, last = cuts, np.minimum(cuts + LEAF, len(fp))
    ands, ors = np.bitwise_and.reduceat(fp, cuts), np.bitwise_or.reduceat(fp, cuts)
    out = [(~(ands ^ ors), ands, first, last)]
    while len(out[-1][0]) > fan:
        cuts = np.arange(0, len(ands), fan)
        ands, ors = np.bitwise_and.reduceat(ands, cuts), np.bitwise_or.reduceat(ors, cuts)
        out.append((~(ands ^ ors), ands, cuts, np.minimum(cuts + fan, len(out[-1][0]))))
    return out


def index_links(a: np.ndarray, b: np.ndarray | None, distance: int):
    """Pairs (i, j) of Gray-sorted fingerprints within ``distance``, a block at a
    time: inside ``a`` (i < j), or between ``a`` and ``b``."""
    la, lb = _levels(a), _levels(a if b is None else b)
    depth = min(len(la), len(lb))
    mask_a, pat_a, _, _ = la[depth - 1]
    mask_b, pat_b, _, _ = lb[depth - 1]
    x, y = (v.ravel() for v in np.meshgrid(np.arange(len(mask_a)), np.arange(len(mask_b)), indexing="ij"))
    todo = [(depth - 1, x, y)]
    while todo:
        level, x, y = todo.pop()
        if len(x) > 1 << 16:                  # bounded memory: the rest waits
            todo += [(level, x[1 << 16:], y[1 << 16:])]
            x, y = x[:1 << 16], y[:1 << 16]
        ma, pa_, fa, ea = la[level]
        mb, pb, fb, eb = lb[level]
        near = np.bitwise_count((pa_[x] ^ pb[y]) & ma[x] & mb[y]) <= distance
        if b is None:
            near &= x <= y
        x, y = x[near], y[near]
        if not len(x):
            continue
        na, nb = ea[x] - fa[x], eb[y] - fb[y]
        n = na * nb
        for lo in range(0, len(x), 2048):     # open the nodes: children, or members at the leaves
            xs, ys, m = x[lo:lo + 2048], y[lo:lo + 2048], n[lo:lo + 2048]
            own = np.repeat(np.arange(len(xs)), m)
            at = np.arange(len(own)) - np.repeat(np.cumsum(m) - m, m)
            width = nb[lo:lo + 2048][own]
            cx, cy = fa[xs][own] + at // width, fb[ys][own] + at % width
            if level:
                todo.append((level - 1, cx, cy))
                continue
            ok = np.bitwise_count(a[cx] ^ (a if b is None else b)[cy]) <= distance
            if b is None:
                ok &= cx < cy
            if ok.any():
                yield cx[ok], cy[ok]


def links(fps: DataFrame, distance: int) -> DataFrame:
    """(u, v): a spanning forest per cell of the links between distinct ``fp``."""
    blocks = distance + 1
    edges = np.linspace(0, 64, blocks + 1).astype(int)
    cells = F.array(*[F.struct(F.lit(i).alias("t"),
                               F.shiftrightunsigned("fp", int(lo)).bitwiseAND(F.lit((1 << int(hi - lo)) - 1)).alias("v"))
                      for i, (lo, hi) in enumerate(zip(edges, edges[1:], strict=False))])
    rows = fps.select("fp", F.explode(cells).alias("c")).select("fp", "c.t", "c.v")
    sizes = rows.groupBy("t", "v").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    rows = rows.join(sizes, ["t", "v"])
    small = rows.filter(f"n <= {CELL}").select("t", "v", F.lit(-1).alias("i"), F.lit(-1).alias("j"), F.lit(0).alias("s"), "fp")
    # a large cell: slices by a hash of the fingerprint, every two of them meet once
    cut = F.ceil(F.col("n") / (CELL // 2)).cast("int")
    big = (rows.filter(f"n > {CELL}").withColumn("k", cut)
           .withColumn("s", F.pmod(F.xxhash64("fp"), F.col("k")).cast("int"))
           .select("t", "v", "fp", "s", F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("o"))
           .select("t", "v", F.least("s", "o").alias("i"), F.greatest("s", "o").alias("j"), "s", "fp"))
    both = small.unionByName(big).repartition("t", "v", "i", "j").sortWithinPartitions("t", "v", "i", "j")

    def search(batches):
        held, now, done = [], None, []

        def close():
            if not held:
                return
            s = np.concatenate([h[0] for h in held])
            fp = np.concatenate([h[1] for h in held]).view(np.uint64)
            if len(fp) < 2:
                return
            order = np.argsort(gray_rank(fp), kind="stable")
            fp, s = fp[order], s[order]
            i, j = now[2], now[3]
            if i == j:
                u, v = forest(len(fp), index_links(fp, None, distance))
                done.append((fp[u], fp[v]))
            else:
                a, b = fp[s == i], fp[s == j]
                if len(a) and len(b):
                    both_ = np.concatenate([a, b])
                    u, v = forest(len(both_), ((x, y + len(a)) for x, y in index_links(a, b, distance)))
                    done.append((both_[u], both_[v]))

        def flush():
            u, v = (np.concatenate([d[k] for d in done]).view(np.int64) for k in (0, 1))
            done.clear()
            return pa.RecordBatch.from_pydict({"u": pa.array(u), "v": pa.array(v)})

        for b in batches:
            t, v, i, j, s, fp = (b.column(k).to_numpy(zero_copy_only=False) for k in range(6))
            new = np.ones(len(t), bool)
            new[1:] = (t[1:] != t[:-1]) | (v[1:] != v[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])
            at = np.flatnonzero(new)
            for lo, hi in zip(at.tolist(), [*at[1:].tolist(), len(t)], strict=True):
                key = (int(t[lo]), int(v[lo]), int(i[lo]), int(j[lo]))
                if key != now:
                    close()
                    held, now = [], key
                held.append((s[lo:hi], fp[lo:hi]))
            if len(done) > 2000:
                yield flush()
        close()
        if done:
            yield flush()

    return both.mapInArrow(search, "u long, v long").distinct()


def near_duplicates(docs: DataFrame, shingle: int = 4, distance: int = 4, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """(id, fp, component): component is the smallest id reachable, itself included."""
    fp = stage(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    return grouped(fp, distance).drop("group")


def grouped(fp: DataFrame, distance: int) -> DataFrame:
    """Rows (id, fp, ...) with component (smallest id) and group (a fingerprint), by links."""
    classes = stage(fp.groupBy("fp").agg(F.min("id").alias("low")), "classes")
    comp = components(links(classes.select("fp"), distance))       # node, comp (both fp)
    member = classes.join(comp.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "low", F.coalesce("comp", "fp").alias("comp"))
    low = member.groupBy("comp").agg(F.min("low").alias("component"))
    known = member.join(low, "comp").select("fp", "component", F.col("comp").alias("group"))
    return fp.join(known, "fp")


def keep_one(docs: DataFrame, shingle: int = 4, distance: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Of each group of near copies the row with the smallest id (null last), then
    the smallest hash of the text; of equal rows, one. All columns stay."""
    named = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    id_, at = (f"c{docs.columns.index(c)}" for c in (id_col, text_col))

    def scan(batches):
        for b in batches:
            fp = np.array([fingerprint(t.as_py(), shingle) for t in b.column(at)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(fp)], [*b.schema.names, "fp"])

    rows = stage(named.mapInArrow(scan, T.StructType([*named.schema, T.StructField("fp", T.LongType())]))
                 .withColumn("rid", F.monotonically_increasing_id()), "fingerprinted")
    key = rows.select(F.col(id_).alias("id"), "fp", "rid", F.xxhash64(at).alias("th"))
    place = F.struct(F.col("id").isNull().alias("no_id"), "id", "th", "rid")
    keep = grouped(key, distance).groupBy("group").agg(F.min(place).alias("place")).select(F.col("place.rid").alias("rid"))
    return rows.join(keep, "rid", "left_semi").select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])


def hex64(col):
    """A long as 16 lowercase hex digits, unsigned."""
    return F.lower(F.lpad(F.hex(col), 16, "0"))


def op6_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """4-word shingles, at most 4 differing bits."""
    out = near_duplicates(read(spark, sf_dir, "documents"), 4, 4)
    return out.select(F.col("id").alias("doc_id"), hex64(F.col("fp")).alias("fingerprint"),
                      F.col("component").alias("component_id"))


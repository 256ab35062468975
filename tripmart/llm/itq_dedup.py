"""Embedding near-dedup by iterative quantisation (ITQ).

1. Rows alike in label and vector form one class, so copies are compared once.
2. ITQ is learned on at most ``SAMPLE`` classes (by hash order): principal axes
   of the unit vectors, then a rotation that alternately takes the nearest binary
   codes and solves the orthogonal fit to them. Every class gets a code of up to
   64 balanced bits.
3. Multi-index Hamming tables: the code is cut into ``BLOCKS`` blocks, and there
   is a table for every two of them. Classes with equal label that agree in two
   blocks meet in a cell; codes with up to ``BLOCKS`` - 2 differing bits always do.
   Cells with one member go before any vector is moved.
4. In a cell the original vectors are compared in double precision, block by
   block. A pair is counted in the first table where it meets. A cell of over
   ``CELL`` members is cut into slices that meet in pairs, each in its own task.
5. A task returns sums of links per class and a spanning forest, never pairs.

Only step 3 can miss a link (recall is tested against brute force); no link below
the threshold is reported. Defined cases: vectors that are null, empty, zero, or
hold null or non-finite components, and rows with null label, link with nothing
and are components of their own; vectors of different length are never linked; a
null id has links and a component, which is the smallest known id.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.llm._common import read, stage
from tripmart.llm._graph import components, forest

SAMPLE = 20_000
BITS = 64
BLOCKS = 6
CELL = 2048
ROUNDS = 40


def fit(x: np.ndarray, bits: int = BITS, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(mean, projection) so that ``(x - mean) @ projection > 0`` are the bits."""
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    mean = x.mean(axis=0)
    c = min(bits, x.shape[1])
    _, axes = np.linalg.eigh((x - mean).T @ (x - mean))
    w = axes[:, ::-1][:, :c]
    v = (x - mean) @ w
    r, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((c, c)))
    for _ in range(ROUNDS):
        left, _, right = np.linalg.svd(np.where(v @ r > 0, 1.0, -1.0).T @ v)
        r = (left @ right).T
    return mean, w @ r


def code(x: np.ndarray, mean: np.ndarray, projection: np.ndarray) -> np.ndarray:
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    bits = ((x - mean) @ projection > 0).astype(np.uint64)
    return (bits << np.arange(bits.shape[1], dtype=np.uint64)).sum(axis=1, dtype=np.uint64)


def tables(bits: int) -> list[int]:
    """Mask of each table: two of ``BLOCKS`` blocks (fewer if there are few bits)."""
    n = min(BLOCKS, bits)
    cut = np.linspace(0, bits, n + 1).astype(int)
    block = [sum(1 << i for i in range(a, b)) for a, b in zip(cut, cut[1:], strict=False)]
    return [a | b for a, b in combinations(block, 2)] or [block[0]]


def _matrix(col: pa.Array) -> np.ndarray:
    """Rows of binary doubles as a matrix."""
    return np.frombuffer(b"".join(col.to_pylist()), np.float64).reshape(len(col), -1)


def classes(vectors: DataFrame, id_col: str, vec_col: str, label_col: str) -> tuple[DataFrame, DataFrame]:
    """(rows (rid, id, cid), classes (cid, label, dim, vec, n, low)); invalid rows have no cid."""
    v = F.col(f"`{vec_col}`").cast("array<double>")
    fine = (F.col("label").isNotNull() & (F.size("v") > 0) & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x)
            & (F.abs(x) < F.lit(float("inf")))) & F.exists("v", lambda x: x != 0))
    rows = vectors.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").cast("string").alias("label"), v.alias("v"))
    rows = rows.withColumn("ok", F.coalesce(fine, F.lit(False)))
    cls = stage(rows.filter("ok").groupBy("label", "v").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("low"))
                .withColumn("cid", F.monotonically_increasing_id()), "classes")
    return rows, cls


def _binary(v: DataFrame, *cols: str) -> DataFrame:
    """(cols, vec): the vector's doubles as bytes."""
    def scan(batches):
        for b in batches:
            at = b.schema.names.index("v")
            vec = [np.asarray(x.values, np.float64).tobytes() for x in b.column(at)]
            rest = [b.column(c) for c in cols]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(vec, pa.binary())], [*cols, "vec"])

    types = ", ".join(f"{c} {v.schema[c].dataType.simpleString()}" for c in cols)
    return v.mapInArrow(scan, f"{types}, vec binary")


def _compare(vec_a, vec_b, code_a, code_b, n_a, n_b, masks, t, threshold, same):
    """Links counted on both sides, and pairs, of the pairs first met in table ``t``."""
    ua = vec_a / np.linalg.norm(vec_a, axis=1, keepdims=True)
    ub = vec_b / np.linalg.norm(vec_b, axis=1, keepdims=True)
    la, lb, pairs = np.zeros(len(ua), np.int64), np.zeros(len(ub), np.int64), []
    for lo in range(0, len(ua), 512):
        hit = ua[lo:lo + 512] @ ub.T >= threshold
        if same:
            hit &= np.arange(lo, lo + len(hit))[:, None] < np.arange(len(ub))[None, :]
        x, y = np.nonzero(hit)
        diff = code_a[lo + x] ^ code_b[y]
        first = np.ones(len(x), bool)
        for m in masks[:t]:
            first &= diff & np.uint64(m) != 0
        x, y = x[first] + lo, y[first]
        np.add.at(la, x, n_b[y])
        np.add.at(lb, y, n_a[x])
        if len(x):
            pairs.append((x, y))
    return la, lb, pairs


def links(cls: DataFrame, threshold: float) -> DataFrame:
    """(cid, links, root): links of a class counted in one cell, and a class it is
    connected with there. Sum over cells, connect the roots."""
    spark = cls.sparkSession
    out = None
    dims = [r[0] for r in cls.select(F.size("v")).distinct().collect()]
    for dim in sorted(dims):
        own = cls.filter(F.size("v") == dim)
        sample = own.select("cid", "v").orderBy(F.xxhash64("v")).limit(SAMPLE)
        x = np.array([r["v"] for r in sample.collect()])
        mean, proj = fit(x)
        masks = tables(proj.shape[1])
        model = spark.sparkContext.broadcast((mean, proj))

        def encode(batches, model=model):
            for b in batches:
                v = _matrix(b.column(3))
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(code(v, *model.value).view(np.int64))],
                                                 [*b.schema.names, "code"])

        coded = stage(_binary(own, "cid", "label", "n").mapInArrow(
            encode, "cid long, label string, n long, vec binary, code long"), "codes")
        cells = F.array(*[F.struct(F.lit(i).alias("t"), F.col("code").bitwiseAND(F.lit(m - (1 << 64) if m >> 63 else m)).alias("k"))
                          for i, m in enumerate(masks)])
        keys = coded.select("cid", "label", F.explode(cells).alias("c")).select("cid", "label", "c.*")
        full = keys.groupBy("label", "t", "k").agg(F.count(F.lit(1)).alias("m")).filter("m > 1")
        member = (keys.join(full, ["label", "t", "k"]).withColumn("p", F.ceil(F.col("m") / CELL).cast("int"))
                  .withColumn("s", F.pmod(F.xxhash64("cid"), F.col("p")).cast("int"))
                  .select("*", F.explode(F.sequence(F.lit(0), F.col("p") - 1)).alias("o"))
                  .select("cid", "label", "t", "k", "s", F.least("s", "o").alias("i"), F.greatest("s", "o").alias("j")))
        cell = ["label", "t", "k", "i", "j"]
        met = (member.join(coded.drop("label"), "cid").select(*cell, "s", "cid", "n", "code", "vec")
               .repartition(*cell).sortWithinPartitions(*cell))

        def search(batches, masks=masks):
            held, now = [], None

            def close():
                if not held:
                    return None
                s, cid, n, cd = (np.concatenate([h[k] for h in held]) for k in range(4))
                vec = np.concatenate([h[4] for h in held])
                t, i, j = now[1], now[3], now[4]
                a, b = (np.arange(len(s)),) * 2 if i == j else (np.flatnonzero(s == i), np.flatnonzero(s == j))
                la, lb, pairs = _compare(vec[a], vec[b], cd[a], cd[b], n[a], n[b], masks, t, threshold, i == j)
                if not pairs:
                    return None
                total = np.zeros(len(s), np.int64)
                np.add.at(total, a, la)
                np.add.at(total, b, lb)
                node, up = forest(len(s), ((a[x], b[y]) for x, y in pairs))
                root = np.arange(len(s))
                root[node] = up
                at = np.flatnonzero(total)
                return pa.RecordBatch.from_pydict({"cid": pa.array(cid[at]), "links": pa.array(total[at]),
                                                   "root": pa.array(cid[root[at]])})

            for b in batches:
                cols = [b.column(k).to_pylist() for k in range(5)]
                key = list(zip(*cols, strict=True))
                cut = [0, *[r for r in range(1, len(key)) if key[r] != key[r - 1]], len(key)]
                num = [b.column(k).to_numpy(zero_copy_only=False) for k in (5, 6, 7)]
                cd = b.column(8).to_numpy(zero_copy_only=False).view(np.uint64)
                vec = _matrix(b.column(9))
                for lo, hi in zip(cut, cut[1:], strict=False):
                    if key[lo] != now:
                        if (r := close()) is not None:
                            yield r
                        held, now = [], key[lo]
                    held.append((*[c[lo:hi] for c in num], cd[lo:hi], vec[lo:hi]))
            if (r := close()) is not None:
                yield r

        part = met.mapInArrow(search, "cid long, links long, root long")
        out = part if out is None else out.unionByName(part)
    return out if out is not None else spark.createDataFrame([], "cid long, links long, root long")


def near_duplicates(vectors: DataFrame, threshold: float = 0.98, id_col: str = "vec_id",
                    vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(id, n_links, component, kept) per row."""
    rows, cls = classes(vectors, id_col, vec_col, label_col)
    found = stage(links(cls, threshold), "links")
    comp = components(found.select(F.col("cid").alias("u"), F.col("root").alias("v")))
    total = found.groupBy("cid").agg(F.sum("links").alias("links"))
    info = (cls.select("cid", "label", "v", "n", "low").join(total, "cid", "left")
            .join(comp.withColumnRenamed("node", "cid"), "cid", "left")
            .select("label", "v", "low", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("links"),
                    F.coalesce("comp", "cid").alias("comp")))
    info = stage(info, "info")
    low = info.groupBy("comp").agg(F.min("low").alias("component"))
    info = info.join(low, "comp").select(F.col("label").alias("l2"), F.col("v").alias("v2"), "links", "component")
    out = rows.join(info, F.col("ok") & (F.col("label") == F.col("l2")) & (F.col("v") == F.col("v2")), "left")
    comp_id = F.when(F.col("ok"), F.col("component")).otherwise(F.col("id"))
    return out.select("id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), comp_id.alias("component"),
                      F.coalesce(F.col("id") == comp_id, F.lit(False)).alias("kept"))


def op5_itq_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_duplicates(read(spark, sf_dir, "embeddings"))
    return out.select(F.col("id").alias("vec_id"), "n_links", F.col("component").alias("component_id"), "kept")


ORACLE = """
with recursive v as (select vec_id, label, embedding::double[] as e from embeddings where label is not null and embedding is not null
    and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0),
p as (select a.vec_id as u, b.vec_id as w from v a join v b on a.label = b.label and a.vec_id <> b.vec_id
    and len(a.e) = len(b.e) and list_cosine_similarity(a.e, b.e) >= 0.98),
r(u, w) as (select u, w from p union select r.u, p.w from r join p on r.w = p.u),
n as (select u, count(*) as n from p group by 1), c as (select u, min(w) as w from r group by 1)
select e.vec_id, coalesce(n.n, 0) as n_links, least(e.vec_id, coalesce(c.w, e.vec_id)) as component_id,
  least(e.vec_id, coalesce(c.w, e.vec_id)) = e.vec_id as kept
from embeddings e left join n on n.u = e.vec_id left join c on c.u = e.vec_id"""

"""Mixing sources to target weights.

1. Every source's documents are put in a pseudorandom order and their words
   packed into blocks of ``block`` words (the last one of a source is shorter).
2. A source's target is its weight's share of all words, at most ``repeat``
   times its own; what is cut off is shared anew by weight until none is above.
   The target in blocks is the number of its slots.
3. Each output shard draws its counts by source from a multinomial whose totals
   are pinned to the slots, so that shards vary but the mixture does not: for
   every source, its slots fall multinomially on the shards.
4. Slot j of a source is mapped to a block by a pseudorandom permutation of the
   block numbers (a Feistel network walked until it is in range), another one
   for each pass over the source, so a pass draws every block once.
5. Blocks and slots are joined by (source, block number).

A source holding a third of all rows is ordered in about sqrt(rows) bins by
hash, whose sums are then ordered per source: no task sees a whole source.

Defined cases: a null source is a source of its own, ordered last; null or
wordless text has size 0 and nothing is taken; rows alike in id, source and text
get equal treatment in an order of their own. The seed fixes everything.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripmart.llm._common import WORDS, mix, read, stage

SEED = 20_240_607
BLOCK = 32
SHARD = 1 << 16          # blocks of an output shard, on average
TASK = 1 << 18           # slots filled by a task


def ranked(df: DataFrame, *order) -> DataFrame:
    """``df`` with ``rank`` (from 0) in a total order: range-sorted, written, and
    numbered by partition offsets; no single task sees all rows."""
    s = stage(df.sort(*order).withColumn("_at", F.monotonically_increasing_id()), "ranked")
    s = s.withColumn("_part", F.shiftright("_at", 33))
    sizes = s.groupBy("_part").agg(F.count(F.lit(1)).alias("n"))
    off = sizes.select("_part", (F.sum("n").over(Window.orderBy("_part")) - F.col("n")).alias("_off"))
    return (s.join(off, "_part")
            .withColumn("rank", F.col("_off") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)))
            .drop("_at", "_part", "_off"))


def source_targets(sized: DataFrame, repeat: int = 3) -> DataFrame:
    """(source, source_size, n, weight, target) from rows (source, size): weights
    1, 2, 3 repeat over the sources by code point, null last."""
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"))
    per = stage(ranked(per, F.col("source").asc_nulls_last())
                .withColumn("weight", F.col("rank") % 3 + 1).drop("rank"), "sources")
    total = per.agg(F.sum("source_size")).first()[0] or 0
    cap, level, share = F.col("source_size") * repeat, 0.0, F.col("weight")
    while total:                               # raise the level until no more source stops
        stops = share * F.lit(level) >= cap if level else F.lit(False)
        r = per.agg(F.sum(F.when(stops, cap)).alias("held"), F.sum(F.when(~stops, share)).alias("free")).first()
        if not r["free"] or (total - (r["held"] or 0)) / r["free"] <= level:
            break
        level = (total - (r["held"] or 0)) / r["free"]
    return per.withColumn("target", F.least(F.col("weight") * F.lit(float(level)), cap.cast("double")))


def placed(sized: DataFrame, sources: DataFrame) -> DataFrame:
    """Rows with ``first``, the place of their first word among their source's words."""
    bins = F.ceil(F.sqrt("n")).cast("long")
    rows = (sized.filter("size > 0")
            .join(sources.select(F.col("source").alias("s2"), "n"), F.col("source").eqNullSafe(F.col("s2"))).drop("s2")
            .withColumn("h", F.xxhash64(F.lit(SEED), "id", "th"))
            .withColumn("bin", F.pmod("h", bins)))
    order = Window.partitionBy("source", "bin").orderBy("h", "id", "th", "rid")
    rows = stage(rows.withColumn("upto", F.sum("size").over(order)), "binned")
    sums = rows.groupBy("source", "bin").agg(F.sum("size").alias("words"))
    base = sums.select(F.col("source").alias("s2"), F.col("bin").alias("b2"),
                       (F.sum("words").over(Window.partitionBy("source").orderBy("bin")) - F.col("words")).alias("base"))
    return (rows.join(base, F.col("source").eqNullSafe(F.col("s2")) & (F.col("bin") == F.col("b2")))
            .withColumn("first", F.col("base") + F.col("upto") - F.col("size"))
            .select("rid", "source", "size", "first"))


def blocks(rows: DataFrame, block: int) -> DataFrame:
    """(source, block, rid, word, words): the part of each block that is a row's, by its first word and length."""
    last = F.floor((F.col("first") + F.col("size") - 1) / block)
    b = F.col("block")
    return (rows.select("*", F.explode(F.sequence(F.floor(F.col("first") / block), last)).alias("block"))
            .select("source", "block", "rid", F.greatest(F.lit(0), b * block - F.col("first")).alias("word"),
                    (F.least(F.col("first") + F.col("size"), (b + 1) * block) - F.greatest("first", b * block)).alias("words")))


def permute(j: np.ndarray, n: int, key: int) -> np.ndarray:
    """Pseudorandom permutation of 0..n-1 at places j: Feistel, walked into range."""
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    low = np.uint64((1 << half) - 1)
    out = j.astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        x = out[todo]
        left, right = x >> np.uint64(half), x & low
        for r in range(4):
            left, right = right, left ^ (mix(right + np.uint64((key * 4 + r) * 0x9E3779B97F4A7C15 % 2 ** 64)) & low)
        out[todo] = (left << np.uint64(half)) | right
        todo = todo[out[todo] >= np.uint64(n)]
    return out.astype(np.int64)


def slots(sources: DataFrame, block: int, shard: int = SHARD) -> DataFrame:
    """(source, shard, slot, block): every draw of the mixture, one row each; slots are
    numbered by source, shard after shard."""
    per = (sources.filter("source_size > 0 and target > 0")
           .withColumn("blocks", F.ceil(F.col("source_size") / block))
           .withColumn("passes", F.floor(F.col("target") / F.col("source_size")))
           .withColumn("rest", F.least("blocks", F.round((F.col("target") - F.col("passes") * F.col("source_size")) / block).cast("long")))
           .withColumn("slots", F.col("passes") * F.col("blocks") + F.col("rest"))
           .withColumn("key", F.pmod(F.xxhash64(F.lit(SEED), "source"), F.lit(1 << 40))))
    total = per.agg(F.sum("slots")).first()[0] or 0
    n_shards = max(1, -(-total // shard))

    def draw(batches):
        for b in batches:
            rows = b.to_pylist()
            for r in rows:
                counts = np.random.default_rng(r["key"]).multinomial(r["slots"], np.full(n_shards, 1 / n_shards))
                ends = np.cumsum(counts)
                yield pa.RecordBatch.from_pydict({
                    "source": pa.array([r["source"]] * n_shards, pa.string()), "key": pa.array([r["key"]] * n_shards, pa.int64()),
                    "blocks": pa.array([r["blocks"]] * n_shards, pa.int64()), "shard": pa.array(np.arange(n_shards)),
                    "lo": pa.array(ends - counts), "hi": pa.array(ends)})

    drawn = per.select("source", "key", "blocks", "slots").mapInArrow(
        draw, "source string, key long, blocks long, shard long, lo long, hi long")
    parts = (drawn.filter("hi > lo")
             .withColumn("lo2", F.explode(F.sequence("lo", F.col("hi") - 1, F.lit(8192))))
             .withColumn("hi", F.least("hi", F.col("lo2") + 8192)).withColumn("lo", F.col("lo2")).drop("lo2")
             .repartition(max(1, -(-total // TASK)), F.xxhash64("source", "lo")))       # a few rows that become many

    def fill(batches):
        for b in batches:
            for r in b.to_pylist():
                j = np.arange(r["lo"], r["hi"])
                turn, at = j // r["blocks"], j % r["blocks"]
                out = np.empty(len(j), np.int64)
                for t in np.unique(turn):
                    out[turn == t] = permute(at[turn == t], r["blocks"], r["key"] + int(t) * 0x10001)
                yield pa.RecordBatch.from_pydict({
                    "source": pa.array([r["source"]] * len(j), pa.string()),
                    "shard": pa.array(np.full(len(j), r["shard"])), "slot": pa.array(j), "block": pa.array(out)})

    return parts.mapInArrow(fill, "source string, shard long, slot long, block long")


def sized_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(rid, id, th, source, size): rid numbers the rows, once, as written."""
    text = F.col(f"`{text_col}`").cast("string")
    return stage(docs.select(F.monotonically_increasing_id().alias("rid"), F.col(f"`{id_col}`").alias("id"),
                             F.xxhash64(text).alias("th"), F.col(f"`{source_col}`").cast("string").alias("source"),
                             F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("long").alias("size")), "sized")


def packed(docs: DataFrame, block: int = BLOCK, repeat: int = 3, shard: int = SHARD, id_col: str = "doc_id",
           text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mixture itself: (shard, slot, source, block, id, th, word, words), one row for each part of a document in
    a slot's block - ``words`` words from word number ``word`` on. Write it by shard and read the texts beside it."""
    sized = sized_rows(docs, id_col, text_col, source_col)
    sources = stage(source_targets(sized, repeat), "targets")
    have = blocks(placed(sized, sources), block)
    drawn = slots(sources, block, shard).select(F.col("source").alias("s2"), "shard", "slot", F.col("block").alias("b2")).hint("merge")
    return (have.join(drawn, F.col("source").eqNullSafe(F.col("s2")) & (F.col("block") == F.col("b2")))
            .join(sized.select("rid", "id", "th"), "rid").select("shard", "slot", "source", "block", "id", "th", "word", "words"))


def mixture(docs: DataFrame, block: int = BLOCK, repeat: int = 3, id_col: str = "doc_id", text_col: str = "text",
            source_col: str = "source") -> DataFrame:
    """(id, th, source, size, source_size, target, taken) per row."""
    sized = sized_rows(docs, id_col, text_col, source_col)
    sources = stage(source_targets(sized, repeat), "targets")
    draws = slots(sources, block).groupBy("source", "block").agg(F.count(F.lit(1)).alias("draws"))
    have = blocks(placed(sized, sources), block)
    # slots come out of a few rows of counts, so the optimizer takes them for few: never broadcast
    d = draws.select(F.col("source").alias("s2"), F.col("block").alias("b2"), "draws").hint("merge")
    taken = (have.join(d, F.col("source").eqNullSafe(F.col("s2")) & (F.col("block") == F.col("b2")))
             .groupBy("rid").agg(F.sum(F.col("words") * F.col("draws")).alias("taken")))
    src = sources.select(F.col("source").alias("s2"), "source_size", "target")
    return (sized.join(taken, "rid", "left").join(src, F.col("source").eqNullSafe(F.col("s2")))
            .select("id", "th", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken")))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixture(read(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")

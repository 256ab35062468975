"""Benchmark decontamination (DataFrame functions only).

The windows of the benchmark (``size`` consecutive normalised words of an item; a
shorter item is one window) form a hash set. Every window is filed under its
longest word, its pivot. The scan looks up every word of every document in the
set of pivots; only the surroundings of words found there (at most ``size`` - 1
words on either side) leave the row. These meet the windows by pivot and are
verified word by word.

The pivots are put into the scan, and the windows broadcast, up to ``PIVOTS`` and
``WINDOWS`` entries. Beyond that nothing is assumed about the benchmark's size:
the scan passes on every word and the windows are joined by a shuffle.

Words are the maximal runs of digits, letters a-z in either case and everything
beyond ASCII; only A-Z is lower-cased. The scan compares with all letters
lower-cased, which finds at least as much, and verification is exact.

Defined cases: null text has no words, no words no windows; a null item id is
listed as ``null``; rows alike in id and text get the same result; an empty
benchmark hits nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.llm._common import keyed, read, stage

WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"     # before lower-casing
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PIVOTS = 20_000
WINDOWS = 500_000


def _words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def _ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def windows(benchmark: DataFrame, size: int, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(gram, words, len, pivot, off): each different window once; ``off`` is the
    place of the pivot in it. And (gram, item) as ``items``."""
    w = F.transform(_words(F.col(f"`{text_col}`").cast("string")), _ascii_lower)
    items = (benchmark.select(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("null")).alias("item"), w.alias("w"))
             .filter("size(w) > 0"))
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - size + 1, F.lit(1)))
    return (items.select("item", F.explode(F.transform(starts, lambda i: F.slice("w", i, size))).alias("words"))
            .withColumn("gram", F.array_join("words", " ")).distinct())


def _pivoted(grams: DataFrame) -> DataFrame:
    best = F.array_max(F.transform("words", lambda x, i: F.struct(F.length(x).alias("l"), F.lower(x).alias("p"), i.alias("i"))))
    return (grams.withColumn("best", best)
            .select("gram", F.size("words").alias("len"), F.col("best.p").alias("pivot"), F.col("best.i").alias("off")))


def occurrences(docs: DataFrame, benchmark: DataFrame, size: int = 10, id_col: str = "doc_id", text_col: str = "text",
                item_col: str = "item_id", item_text: str = "text"):
    """((id, th, n_words) of all rows, (id, th, start, len, gram) of every window
    found, (gram, item) of the benchmark)."""
    items = stage(windows(benchmark, size, item_col, item_text), "windows")
    grams = stage(_pivoted(items.select("gram", "words").distinct()), "grams")
    pivots = grams.select("pivot").distinct()
    known = [r[0] for r in pivots.limit(PIVOTS + 1).collect()]
    few = grams.count() <= WINDOWS
    rows = keyed(docs, id_col, text_col).withColumn("w", _words(F.col("text"))).drop("text")
    if len(known) > PIVOTS:
        hit = F.transform("w", lambda x, i: i)
    elif known:
        hit = F.filter(F.transform("w", lambda x, i: F.when(F.lower(x).isin(known), i)), lambda i: i.isNotNull())
    else:
        hit = F.array().cast("array<int>")
    near = F.transform("hit", lambda i: F.struct(
        i.alias("at"), F.lower(F.get("w", i)).alias("pivot"), F.least(i, F.lit(size - 1)).alias("left"),
        F.slice("w", F.greatest(i - size + 2, F.lit(1)), F.least(i, F.lit(size - 1)) + size).alias("around")))
    seen = stage(rows.withColumn("hit", hit).select("id", "th", F.size("w").cast("long").alias("n_words"),
                                                    near.alias("near")), "pivots")
    spots = seen.filter("size(near) > 0").select("id", "th", F.explode("near").alias("n")).select("id", "th", "n.*")
    table = F.broadcast(grams) if few else grams
    # the part of the surroundings where the window would lie, joined like the window
    begin = F.col("left") - F.col("off")
    part = _ascii_lower(F.array_join(F.slice("around", F.greatest(begin, F.lit(0)) + 1, F.col("len")), " "))
    found = (spots.join(table, "pivot").filter(begin >= 0).filter(part == F.col("gram"))
             .select("id", "th", (F.col("at") - F.col("off")).alias("start"), "len", "gram"))
    return seen.select("id", "th", "n_words"), stage(found, "found"), items.select("gram", "item")


def report(docs: DataFrame, benchmark: DataFrame, size: int = 10, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per document: id, th, n_words, spans (array<struct<start, end>> of
    words, maximal and disjoint), n_hit (words in them) and items (sorted ids)."""
    rows, found, items = occurrences(docs, benchmark, size, id_col, text_col, item_col, item_text)
    words = (found.groupBy("id", "th").agg(F.array_sort(F.collect_set(F.struct("start", (F.col("start") + F.col("len")).alias("end")))).alias("s")))
    merged = F.aggregate(
        "s", F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("upto")),
        lambda a, x: F.struct((a["n"] + F.greatest(x["end"] - F.greatest(x["start"], a["upto"]), F.lit(0))).alias("n"),
                              F.greatest(a["upto"], x["end"]).alias("upto")))
    words = words.select(F.col("id").alias("i1"), F.col("th").alias("t1"), merged["n"].alias("n_hit"), F.col("s").alias("spans"))
    which = (found.select("id", "th", "gram").distinct().join(items, "gram")
             .groupBy(F.col("id").alias("i2"), F.col("th").alias("t2"))
             .agg(F.array_sort(F.collect_set("item")).alias("items")))
    both = words.join(which, F.col("i1").eqNullSafe(F.col("i2")) & (F.col("t1") == F.col("t2"))).drop("i2", "t2")
    return (rows.join(both, F.col("id").eqNullSafe(F.col("i1")) & (F.col("th") == F.col("t1")), "left")
            .select("id", "th", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                    F.coalesce("spans", F.array().cast("array<struct<start:int,end:int>>")).alias("spans"),
                    F.coalesce("items", F.array().cast("array<string>")).alias("items")))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = report(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return out.select(F.col("id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


ORACLE = rf"""
with b as (select coalesce(item_id::varchar, 'null') as item,
    regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
g as (select distinct item, array_to_string(w[i:i + 9], ' ') as gram, len(w[i:i + 9]) as n
  from (select item, w, unnest(generate_series(1, greatest(len(w) - 9, 1))) as i from b where len(w) > 0)),
d as (select doc_id, regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
lens as (select distinct n from g),
dw as (select doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') as gram
  from (select doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) as i from d, lens where len(w) >= n)),
f as (select dw.doc_id, dw.i, dw.n, g.item from dw join g using (gram, n)),
h as (select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(generate_series(i, i + n - 1)) as p from f) group by 1),
t as (select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as s from (select distinct doc_id, item from f) group by 1)
select d.doc_id, coalesce(len(w), 0)::bigint as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  sha256(coalesce(s, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join h using (doc_id) left join t using (doc_id)"""

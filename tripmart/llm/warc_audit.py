"""WARC fixity audit with Merkle trees.

Pages are written as WARC records, ``RECORDS`` to a file, ordered by id; the
manifest of the first replica gives each record its file, place and byte range.
For each replica a tree is built per file: leaves are record digests in order of
offset, and a node hashes the digests of ``FAN`` neighbours, so it stands for an
ordered range of offsets. The audit compares roots and goes down only where a
node differs; the leaves it ends at are the damaged records. A file's records
are a bounded group by construction, and a tree needs one shuffle of digests:
payloads never move.

Defined cases: null payload or address is empty text; records alike in every
column are placed next to each other; a record that a replica lacks has no digest
and is ``missing`` there, a differing one ``corrupt``; records without id come
last.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripmart.llm._common import read, stage
from tripmart.llm.mixing import ranked

FAN = 16
LEVELS = 3
RECORDS = FAN ** LEVELS


def record(url: Column, payload: Column) -> Column:
    """A response record as text."""
    url, payload = F.coalesce(url, F.lit("")), F.coalesce(payload, F.lit(""))
    return F.concat(F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: "), url, F.lit("\r\nContent-Length: "),
                    F.octet_length(payload).cast("string"), F.lit("\r\n\r\n"), payload, F.lit("\r\n\r\n"))


def manifest(records: DataFrame, *order) -> DataFrame:
    """``records`` (..., n_bytes) with file_no, seq and byte_offset, in the given order."""
    placed = (ranked(records, *order).withColumn("file_no", F.floor(F.col("rank") / RECORDS).cast("long"))
              .withColumn("seq", F.col("rank") % RECORDS).drop("rank"))
    upto = F.sum("n_bytes").over(Window.partitionBy("file_no").orderBy("seq"))
    return placed.withColumn("byte_offset", upto - F.col("n_bytes"))


def tree(leaves: DataFrame, name: str) -> DataFrame:
    """(file_no, level, node, hash) from leaves (file_no, seq, digest); level 0 are
    the leaves. A missing digest counts as the empty text."""
    one = leaves.select("file_no", F.col("seq").alias("node"), F.coalesce("digest", F.lit("")).alias("hash"))
    level = one.repartition("file_no")              # all levels are grouped within files
    out = level.select("file_no", F.lit(0).alias("level"), "node", "hash")
    for k in range(1, LEVELS + 1):
        kids = F.array_sort(F.collect_list(F.struct("node", "hash")))
        level = (level.groupBy("file_no", F.floor(F.col("node") / FAN).alias("up")).agg(kids.alias("kids"))
                 .select("file_no", F.col("up").alias("node"),
                         F.sha2(F.array_join(F.transform("kids", lambda c: c["hash"]), ""), 256).alias("hash")))
        out = out.unionByName(level.select("file_no", F.lit(k).alias("level"), "node", "hash"))
    return stage(out, name)


def damaged(a: DataFrame, b: DataFrame) -> DataFrame:
    """(file_no, seq) of the leaves at which trees ``a`` and ``b`` differ, found from the roots down."""
    at = None
    for k in range(LEVELS, -1, -1):
        x, y = (t.filter(F.col("level") == k).select("file_no", "node", F.col("hash").alias(n))
                for t, n in ((a, "ha"), (b, "hb")))
        if at is not None:
            up = at.select(F.col("file_no").alias("f"), F.col("node").alias("up"))
            x = x.join(up, (F.col("file_no") == F.col("f")) & (F.floor(F.col("node") / FAN) == F.col("up")), "left_semi")
        at = stage(x.join(y, ["file_no", "node"], "left").filter(~F.col("ha").eqNullSafe(F.col("hb")))
                   .select("file_no", "node"), f"differ{k}")
    return at.withColumnRenamed("node", "seq")


def audit(leaves: DataFrame) -> DataFrame:
    """``leaves`` (file_no, seq, digest, copy_digest, ...) with file_root (of the
    first replica), file_intact and status: same, corrupt or missing."""
    a = tree(leaves.select("file_no", "seq", "digest"), "tree_a")
    b = tree(leaves.select("file_no", "seq", F.col("copy_digest").alias("digest")), "tree_b")
    bad = damaged(a, b).withColumn("bad", F.lit(True))
    root = (a.filter(F.col("level") == LEVELS).select("file_no", F.col("hash").alias("file_root"))
            .join(bad.select("file_no").distinct().withColumn("broken", F.lit(True)), "file_no", "left")
            .select("file_no", "file_root", F.col("broken").isNull().alias("file_intact")))
    return (leaves.join(bad, ["file_no", "seq"], "left").join(root, "file_no")
            .withColumn("status", F.when(F.col("bad").isNull(), "same")
                        .when(F.col("copy_digest").isNull(), "missing").otherwise("corrupt")).drop("bad"))


def op2_warc_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second replica is the first with damage: in every 211th page a character
    is overwritten, and every 223rd page is lost."""
    pages = read(spark, sf_dir, "pages")
    html = F.coalesce("html", F.lit(""))
    half = F.floor(F.length(html) / 2).cast("int")
    worn = F.when(F.col("page_id") % 211 == 7, F.concat(F.substring(html, F.lit(1), half), F.lit("#"),
                                                        F.substring(html, half + 2, F.length(html)))).otherwise(html)
    both = pages.select(
        "page_id", F.octet_length(record(F.col("url"), html)).cast("long").alias("n_bytes"),
        F.sha2(record(F.col("url"), html), 256).alias("digest"),
        F.when(~F.coalesce(F.col("page_id") % 223 == 5, F.lit(False)), F.sha2(record(F.col("url"), worn), 256)).alias("copy_digest"))
    leaves = stage(manifest(both, F.col("page_id").asc_nulls_last(), "digest"), "manifest")
    return audit(leaves).select("page_id", "file_no", "seq", "byte_offset", "n_bytes", "digest", "file_root",
                                "file_intact", "status")


_REC = ("'WARC/1.0' || e || 'WARC-Type: response' || e || 'WARC-Target-URI: ' || coalesce(url, '') || e || 'Content-Length: ' "
        "|| strlen({h}) || e || e || {h} || e || e")
ORACLE = f"""
with x as (select *, chr(13) || chr(10) as e, coalesce(html, '') as h from pages),
w as (select *, case when page_id % 211 = 7 then substr(h, 1, len(h) // 2) || '#' || substr(h, len(h) // 2 + 2) else h end as h2 from x),
r as (select page_id, strlen({_REC.format(h='h')}) as n_bytes, sha256({_REC.format(h='h')}) as digest,
  case when coalesce(page_id % 223 = 5, false) then null else sha256({_REC.format(h='h2')}) end as copy_digest from w),
k as (select *, row_number() over (order by page_id nulls last, digest) - 1 as rank from r),
m as (select *, rank // {RECORDS} as file_no, rank % {RECORDS} as seq from k),
o as (select *, sum(n_bytes) over (partition by file_no order by seq) - n_bytes as byte_offset from m),
l1 as (select file_no, seq // 16 as n, sha256(string_agg(digest, '' order by seq)) as h from m group by 1, 2),
l2 as (select file_no, n // 16 as n, sha256(string_agg(h, '' order by l1.n)) as h from l1 group by 1, 2),
l3 as (select file_no, sha256(string_agg(h, '' order by n)) as file_root from l2 group by 1),
i as (select file_no, bool_and(digest is not distinct from copy_digest) as file_intact from m group by 1)
select page_id, o.file_no, seq, byte_offset::bigint as byte_offset, n_bytes, digest, file_root, file_intact,
  case when copy_digest is null then 'missing' when digest = copy_digest then 'same' else 'corrupt' end as status
from o join l3 using (file_no) join i using (file_no)"""

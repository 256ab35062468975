"""Helpers shared by the operators: reading, keys, staging, bit filters.

Row identity. Documents may repeat an id or have none, so an operator that
brings a result back to its rows keys them by ``(id, th)``: the id as it is
(joined null-safely) and the xxhash64 of the text. Rows alike in both are the
same document twice and get the same result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.session import work_dir

WORDS = r"[^\x20\x09-\x0D]+"      # fixed value: what a word is, by contract


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared work folder and read back: cuts lineage, and a lost
    executor costs no recomputation upstream."""
    spark = df.sparkSession
    path = f"{work_dir(spark, name)}/t"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, th, text): a null text is the empty text; other columns go."""
    return (docs.select(F.col(f"`{id_col}`").alias("id"),
                        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
            .select("id", F.xxhash64("text").alias("th"), "text"))


def same_row(a: DataFrame, b: DataFrame):
    return a["id"].eqNullSafe(b["id"]) & (a["th"] == b["th"])


def id_type(df: DataFrame, col: str = "id") -> str:
    return df.schema[col].dataType.simpleString()


def slices(batch: pa.RecordBatch, text: int, limit: int = 1 << 22):
    """Parts of a batch with at most ``limit`` bytes of text (one row at least)."""
    size = pa.compute.binary_length(batch.column(text)).fill_null(0).to_numpy(zero_copy_only=False)
    upto = np.cumsum(size, dtype=np.int64)
    lo = 0
    while lo < batch.num_rows:
        hi = int(np.searchsorted(upto, (upto[lo - 1] if lo else 0) + limit, side="right"))
        hi = max(lo + 1, hi)
        yield batch.slice(lo, hi - lo)
        lo = hi


# ------------------------------------------------------------------ hashing

def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64 output bits."""
    m = np.uint64(0xD6E8FEB86659FD93)
    s = np.uint64(32)
    x = x ^ (x >> s)
    x = x * m
    x = x ^ (x >> s)
    x = x * m
    return x ^ (x >> s)


# ------------------------------------------------------------- bit filters

class BitFilter:
    """Bloom filter of at most ``MAX_BITS`` bits (64 MB, the bound of what is
    broadcast whatever the input). Users must stay right on false positives:
    a full filter costs work, never a row."""

    MAX_BITS = 29
    PAGE = 4096
    FILLERS = 64

    def __init__(self, bits: int, data: np.ndarray):
        self.bits, self.data = bits, data

    @staticmethod
    def places(keys: np.ndarray, bits: int):
        a = mix(keys)
        yield a >> np.uint64(64 - bits)
        yield mix(a + np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)

    def has(self, keys: np.ndarray) -> np.ndarray:
        out = np.ones(len(keys), bool)
        for p in self.places(keys, self.bits):
            out &= (self.data[(p >> np.uint64(3)).astype(np.int64)] >> (p & np.uint64(7)).astype(np.uint8)) & 1 == 1
        return out


def bit_filter(keys: DataFrame, key=None):
    """Broadcast ``BitFilter`` over the first (long) column of ``keys``, or over
    what ``key`` makes of a batch. At most ``FILLERS`` tasks fill pages, so the pages
    moved are bounded; they are or-ed in the cluster, the driver gets the sum."""
    spark = keys.sparkSession
    key = key or (lambda b: b.column(0).to_numpy(zero_copy_only=False).view(np.uint64))
    bits = int(np.clip(np.ceil(np.log2(max(keys.count(), 1) * 16)), 16, BitFilter.MAX_BITS))
    page = BitFilter.PAGE

    def fill(batches):
        data = np.zeros(1 << (bits - 3), np.uint8)
        for b in batches:
            for p in BitFilter.places(key(b), bits):
                np.bitwise_or.at(data, (p >> np.uint64(3)).astype(np.int64),
                                 (np.uint8(1) << (p & np.uint64(7)).astype(np.uint8)))
        pages = data.reshape(-1, page)
        used = np.flatnonzero(pages.any(axis=1))
        for i in range(0, len(used), 256):
            part = used[i:i + 256]
            yield pa.RecordBatch.from_pydict({"page": pa.array(part.astype(np.int64)),
                                              "data": pa.array([pages[j].tobytes() for j in part], pa.binary())})

    def merge(key, pdf):
        out = np.zeros(page, np.uint8)
        for d in pdf["data"]:
            out |= np.frombuffer(d, np.uint8)
        return pd.DataFrame({"page": [key[0]], "data": [out.tobytes()]})

    schema = "page long, data binary"
    merged = (keys.coalesce(BitFilter.FILLERS).mapInArrow(fill, schema)
              .groupBy("page").applyInPandas(merge, schema))
    data = np.zeros(1 << (bits - 3), np.uint8)
    for r in merged.toLocalIterator():
        data[r["page"] * page:(r["page"] + 1) * page] = np.frombuffer(r["data"], np.uint8)
    return spark.sparkContext.broadcast(BitFilter(bits, data))

"""Language ID by hyperdimensional profiles.

Every letter has a random vector of ``DIM`` values +1 / -1. A trigram binds its
letters' vectors, each permuted (rolled) by its place: v = r2(a) * r1(b) * c.
A document's vector bundles (adds) those of its trigrams; a language's prototype
bundles its documents, each scaled to length one so that a long text does not
drown the others. A document gets the language of the most similar prototype by
cosine; the score is that cosine, cut off at 0.

Letters are what ``str.isalpha`` says, lower-cased; everything else is a word
border, and borders are part of trigrams. Learning adds up vectors per task and
language (``DIM`` sums each), then over tasks. Long texts are counted piece by
piece.

Defined cases: text that is null or has no letter is ``und`` with score 0; rows
with null language are not learned from; without any language learned,
everything is ``und``. ``MAX_LANGUAGES`` bounds the prototypes that are broadcast
(8 kB each); more is an error.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.llm._common import read, stage

DIM = 1024
SLOTS = 256               # 0: border, 1-26: a-z, the others share the rest by code point
PIECE = 1 << 16
MAX_LANGUAGES = 2048
UNKNOWN = "und"
SCRIPTS = [(0x61, 0x7A), (0x3B1, 0x3C9), (0x430, 0x44F), (0x5D0, 0x5EA), (0x4E00, 0x9FA5)]     # of junk texts
JUNK_TEXTS, JUNK_SHARE = 200, 0.99


@functools.cache
def _slots() -> np.ndarray:
    """Slot of every code point."""
    out = np.zeros(0x110000, np.uint8)
    for c in range(0x110000):
        ch = chr(c)
        if ch.isalpha():
            low = ord(ch.lower()[0])
            out[c] = low - 96 if 97 <= low <= 122 else 27 + low % (SLOTS - 27)
    return out


@functools.cache
def _letters() -> list[np.ndarray]:
    """Letter vectors, rolled by 2, 1 and 0 places."""
    v = np.random.default_rng(8).integers(0, 2, (SLOTS, DIM), dtype=np.int8) * 2 - 1
    return [np.roll(v, 2, axis=1), np.roll(v, 1, axis=1), v]


def vector(text: str | None) -> np.ndarray | None:
    """Bundled trigram vectors of a text; None if it has no letter."""
    if not text:
        return None
    a2, a1, a0 = _letters()
    out, some = np.zeros(DIM, np.float64), False
    for lo in range(0, len(text), PIECE):                # two symbols of overlap
        raw = text[max(0, lo - 2):lo + PIECE].encode("utf-32-le", "surrogatepass")
        s = _slots()[np.frombuffer(raw, np.uint32)]
        if lo == 0:
            s = np.concatenate([[np.uint8(0)], s])
        if lo + PIECE >= len(text):
            s = np.concatenate([s, [np.uint8(0)]])
        some |= bool(s.any())
        s = s.astype(np.uint32)
        code, n = np.unique((s[:-2] << 16) | (s[1:-1] << 8) | s[2:], return_counts=True)
        used = (code & 0xFFFF00 > 0) | (code & 0xFF > 0)
        code, n = code[used], n[used].astype(np.float32)
        for i in range(0, len(code), 4096):
            c = code[i:i + 4096]
            out += n[i:i + 4096] @ (a2[c >> 16] * a1[(c >> 8) & 0xFF] * a0[c & 0xFF]).astype(np.float32)
    return out if some else None


def prototypes(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> dict[str, np.ndarray]:
    """Unit prototype by language, learned from all rows of ``docs``."""
    def scan(batches):
        sums: dict[str, np.ndarray] = {}
        for b in batches:
            for t, lang in zip(b.column(0), b.column(1), strict=True):
                v = vector(t.as_py())
                if v is not None and (n := np.linalg.norm(v)) > 0:
                    at = sums.setdefault(lang.as_py(), np.zeros(DIM, np.int64))
                    at += np.rint(v / n * 1e9).astype(np.int64)      # whole numbers: any order, one sum
        for lang, v in sums.items():
            yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * DIM, pa.string()),
                                              "k": pa.array(np.arange(DIM, dtype=np.int32)), "v": pa.array(v)})

    learn = docs.select(F.col(f"`{text_col}`").cast("string").alias("text"),
                        F.col(f"`{lang_col}`").cast("string").alias("lang")).filter("lang is not null and text is not null")
    sums = stage(learn.mapInArrow(scan, "lang string, k int, v long")
                 .groupBy("lang", "k").agg(F.sum(F.col("v").cast("decimal(38,0)")).cast("double").alias("v")), "prototypes")
    n = sums.select("lang").distinct().count()
    if n > MAX_LANGUAGES:
        raise ValueError(f"{n} languages; the limit is {MAX_LANGUAGES}")
    out: dict[str, np.ndarray] = {}
    for r in sums.collect():
        out.setdefault(r["lang"], np.zeros(DIM))[r["k"]] = r["v"]
    return {k: v / np.linalg.norm(v) for k, v in sorted(out.items()) if np.linalg.norm(v) > 0}


def predict(docs: DataFrame, protos: dict[str, np.ndarray], text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``; ties go to the first name."""
    known = docs.sparkSession.sparkContext.broadcast((list(protos), np.array(list(protos.values())).reshape(-1, DIM)))
    at = docs.columns.index(text_col)

    def scan(batches):
        names, m = known.value
        for b in batches:
            langs, scores = [], []
            for t in b.column(at):
                v = vector(t.as_py()) if names else None
                n = np.linalg.norm(v) if v is not None else 0
                cos = m @ v / n if n > 0 else None
                k = int(np.argmax(cos)) if cos is not None else -1
                langs.append(names[k] if k >= 0 else UNKNOWN)
                scores.append(float(min(1.0, max(0.0, cos[k]))) if k >= 0 else 0.0)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                                             [*b.schema.names, "lang_pred", "score"])

    return docs.mapInArrow(scan, T.StructType([*docs.schema, T.StructField("lang_pred", T.StringType()),
                                               T.StructField("score", T.DoubleType())]))


def chance_score(protos: dict[str, np.ndarray]) -> float:
    """Score that a share of ``JUNK_SHARE`` of texts in no learned language stays
    under: letters of one script drawn evenly, with spaces, of several lengths.
    The highest of these quantiles against the given prototypes; 0 without any."""
    if not protos:
        return 0.0
    m, rng = np.array(list(protos.values())), np.random.default_rng(12)
    found = []
    for lo, hi in SCRIPTS:
        for n in (32, 128, 512):
            code = rng.integers(lo, hi + 1, (JUNK_TEXTS, n))
            code[rng.random(code.shape) < 1 / 7] = 32
            best = [float((m @ v).max() / np.linalg.norm(v)) for v in (vector("".join(map(chr, c))) for c in code) if v is not None]
            found.append(float(np.quantile(best, JUNK_SHARE)))
    return max(0.0, *found)


def held_out(id_col: str) -> Column:
    """Whether crc32(id as text) mod 4 is 2; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(f"`{id_col}`").cast("string")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(id, held_out, text, lang_pred, score), learned from what is not held out."""
    protos = prototypes(docs.filter(~held_out(id_col)), text_col, lang_col)
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), held_out(id_col).alias("held_out"),
                       F.col(f"`{text_col}`").cast("string").alias("text"))
    return predict(rows, protos)


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = identify(read(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "held_out", "lang_pred", "score")



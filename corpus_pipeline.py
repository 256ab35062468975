"""A corpus pipeline over ``documents`` in five stages.

Each stage is a function (spark, docs, sf_dir) -> DataFrame that works on all rows
its predecessor kept; ``run`` writes every stage's result to the shared work
folder and reads it again. All but the last return the columns of ``documents``.

1. language ID: documents without a letter, or whose profile is like no learned
   language's (cosine no better than that of junk letters, ``chance_score``), go;
2. line dedup: fuzzy copies of lines are cut out of the texts;
3. SimHash near-dedup: of each group the document with the smallest id stays;
4. decontamination: documents that hold a benchmark window go;
5. mixing: size, target and words taken, by source.

Null text is of no language and goes in stage 1; later stages take it as empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.llm import decontaminate, language_id, line_dedup, mixing, simhash_dedup
from tripmart.llm._common import read, stage

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
SHINGLE, BITS = 4, 4
WINDOW = 10


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = docs.select(*COLUMNS)
    protos = language_id.prototypes(docs.filter(~language_id.held_out("doc_id")))
    found = language_id.predict(docs, protos)
    return found.filter((F.col("lang_pred") != language_id.UNKNOWN) & (F.col("score") > language_id.chance_score(protos))).select(*COLUMNS)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.clean(docs.select(*COLUMNS)).select(*COLUMNS)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash_dedup.keep_one(docs.select(*COLUMNS), SHINGLE, BITS)


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = docs.select(*COLUMNS)
    bad = decontaminate.report(docs, read(spark, sf_dir, "benchmark"), WINDOW).filter("n_hit > 0").select(
        F.col("id").alias("i"), F.col("th").alias("t")).distinct()
    th = F.xxhash64(F.coalesce("text", F.lit("")))
    return docs.join(bad, F.col("doc_id").eqNullSafe(F.col("i")) & (th == F.col("t")), "left_anti").select(*COLUMNS)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = mixing.mixture(docs.select(*COLUMNS))
    return out.select(F.col("id").alias("doc_id"), "source", "size", "source_size", "target", "taken")


STAGES = [("language_id", language), ("line_dedup", lines), ("simhash_dedup", near_copies),
          ("decontamination", benchmark_free), ("mixing", mixture)]
ORACLE_SQL = None          # the stages hash and draw in ways SQL does not offer; tested against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name)
    return docs

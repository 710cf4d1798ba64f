"""A training corpus in five steps, each an operator of ``plumbline.llm``.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
to the shared folder and read again as the next one's documents.  All but the
last return the columns of ``documents``.

1. language: documents without a letter, or whose language is ambiguous, go.
2. near_duplicates: of every class of near copies, the document with the least id
   stays, a single row of it; ids that are null come last.
3. decontamination: documents that hold a passage of a benchmark item go.
4. mixing: a row stays as often as the mix takes its document: not at all, or up
   to three times.
5. sharding: adds the columns shard and slot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm import langid, leaks, mixing, sharding, similar
from plumbline.llm.columns import renamed
from plumbline.session import written

#: No SQL: learned languages, MinHash classes, alignments and balanced draws are not expressible; see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    learn = docs.filter(F.crc32(F.col("doc_id").cast("string")) % 5 != 0)
    table, name, back = renamed(docs)
    found = langid.predicted(table, langid.trained(learn), name["text"])
    return found.filter(f"lang_pred != '{langid.UNKNOWN}' and not ambiguous").select(*back)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    links = similar.linked(docs.select("doc_id", "text"))
    # Of each class the row with the least (id, key), null ids last; rows without words are no copies of anything.
    kept = links.filter("set_key is not null").groupBy("class_key").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_key")).alias("first"))
    kept = written(kept.select(F.col("first.row_key").alias("_keep"))
                   .unionByName(links.filter("set_key is null").select(F.col("row_key").alias("_keep"))).distinct(), "kept")
    table, name, back = renamed(docs)
    keyed = table.withColumn("_key", similar.row_key(name["doc_id"], name["text"]))
    return keyed.join(kept, F.col("_key") == F.col("_keep"), "left_semi").dropDuplicates(["_key"]).select(*back)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return leaks.clean(docs, items)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    table, name, back = renamed(docs)
    mix = mixing.mixed(table, source=name["source"], text=name["text"], doc_id=name["doc_id"])
    return mix.withColumn("_copy", F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int")))).select(*back)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = sharding.sharded(docs)
    return found.select(*(F.col(f"`{c}`") for c in found.columns if c not in ("size", "text_crc32")))


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing_stage),
    ("sharding", shards),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs

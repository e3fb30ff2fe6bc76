"""From raw documents to shuffled training shards, in five stages.

Every stage takes (spark, docs, sf_dir); its rows are written as Parquet and read again as the next
stage's docs.  All stages but the last return the columns of documents.  A stage's table goes once the
next one is written, as nothing reads it any more.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import common, decontaminate, mixing, near_dedup, sharding, toxicity

#: No SQL: a fitted model decides in the first stage and seeded rounding in the fourth.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.5.  Empty and null texts have no terms and stay unless most labels are toxic;
    without labels, or with labels of one kind alone, all stay; rows that repeat an id are judged each."""
    return toxicity.without_toxic(docs, common.read(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that of the smallest id, null ids last.  Texts without words all
    stay; rows that repeat id and text count as one."""
    return near_dedup.keep_one(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold four fifths of no item's shingles.  Null and empty texts and items match nothing; an empty
    benchmark drops nothing; rows are judged by id and text."""
    return decontaminate.without_leaks(docs, common.read(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it.  Texts without words are taken nowhere; a null source is one of its
    own and comes last; rows alike in id, source and text get equal copies."""
    return mixing.mixed(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows in random order over 24 shards of equal counts, with shard and slot.  Nulls and repeated rows are rows
    like others; fewer rows than shards leave the last ones empty."""
    return sharding.shuffled(docs, 24)


STAGES = [("toxicity", drop_toxic), ("near_dedup", drop_near_copies), ("decontamination", drop_leaks), ("mixing", mix), ("sharding", shard)]


def _remove(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; the table before the last stage stays in the shared checkpoint folder, as the result reads it."""
    common.set_checkpoint_dir(spark)
    base = f"{spark.sparkContext.getCheckpointDir()}/pipeline-{uuid.uuid4().hex}"
    docs, before = common.read(spark, sf_dir, "documents"), None
    for i, (name, stage) in enumerate(STAGES[:-1]):
        path = f"{base}/{i}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            _remove(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)

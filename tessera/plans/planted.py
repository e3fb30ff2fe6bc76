"""Sample views with faults planted by rule, for the queries that count faults."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.arrays import bucket
from tessera.operators.labels import pair_bucket
from tessera.sources import io


def _id(number: Column) -> Column:
    return F.concat(F.lit("S"), (number % 3 + 1).cast("string"), F.lit("-"), F.lpad(number.cast("string"), F.greatest(F.lit(6), F.length(number.cast("string"))), F.lit("0")))


def _lists(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(source1_entity_id, ids, d) of matches and of candidates: the two records after a source-1 record, and faults by its number."""
    d = F.col("d")
    base = spark.read.parquet(f"{sf_dir}/documents.parquet").where("doc_id % 3 = 0").select(F.col("doc_id").alias("d"))
    some = lambda by, *values: F.when(d % by == 0, F.array(*values)).otherwise(F.array().cast("array<string>"))
    ids = F.concat(F.array(_id(d + 1), _id(d + 2)), some(5, _id(d + 1)), some(7, _id(d)), some(11, F.lit("X9-1")), some(13, F.lit("S3-none")))
    rows = base.where("d % 17 <> 0").select(_id(d).alias("source1_entity_id"), ids.alias("ids"), "d")
    odd = base.where("d % 23 = 0").select(F.concat(F.lit("S1-U"), d.cast("string")).alias("source1_entity_id"), F.array().cast("array<string>").alias("ids"), "d")
    near = F.when(d % 29 == 0, F.array(_id(d + 1))).otherwise(F.array(_id(d + 1), _id(d + 2)))
    return rows.unionByName(rows.where("d % 19 = 0")).unionByName(odd), base.select(_id(d).alias("source1_entity_id"), near.alias("ids"), "d")


def lists(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    m, c = _lists(spark, sf_dir)
    return m.select("source1_entity_id", F.array_join("ids", ",").alias("matched_entity_ids")), c.select("source1_entity_id", F.array_join("ids", ",").alias("candidate_entity_ids"))


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The match lists as the lines of a file, some without a tab, under a header."""
    m, _ = _lists(spark, sf_dir)
    text = F.concat("source1_entity_id", F.when(F.col("d") % 31 == 0, F.lit(" ")).otherwise(F.lit("\t")), F.array_join("ids", ","))
    return m.select(text.alias("value")).unionByName(spark.createDataFrame([("source1_entity_id\tmatched_entity_ids",), ("",)], "value string"))


def _at(n: int) -> Column:
    return pair_bucket(10) == n


def candidates(pairs: DataFrame) -> DataFrame:
    """Candidate pairs of which tenths repeat, lack an id, or name an unknown source or record."""
    out = pairs.select(*io.PAIR)
    s1 = F.when(_at(1), F.lit(None).cast("string")).when(_at(2), F.concat(F.col(io.PAIR[0]), F.lit("U"))).otherwise(F.col(io.PAIR[0]))
    t = F.when(_at(3), F.concat(F.col(io.PAIR[1]), F.lit("U"))).otherwise(F.col(io.PAIR[1]))
    source = F.when(_at(4), F.lit("S9")).otherwise(F.col(io.PAIR[2]))
    return out.unionByName(out.where(_at(0))).select(s1.alias(io.PAIR[0]), t.alias(io.PAIR[1]), source.alias(io.PAIR[2]))


def features(rows: DataFrame) -> DataFrame:
    """Feature rows of which tenths repeat, lack a value, or hold one out of range."""
    twice = F.when(_at(0), F.array(F.lit(0), F.lit(0))).otherwise(F.array(F.lit(0)))  # not a union, which would compute the features again
    rows = rows.select("*", F.explode(twice).alias("_time")).drop("_time")
    changed = {
        "name_char_ratio": F.when(_at(1), F.lit(1.5)).otherwise(F.col("name_char_ratio")).cast("float"),
        "name_exact": F.when(_at(2), F.lit(None)).otherwise(F.col("name_exact")).cast("tinyint"),
        "block_name": F.when(_at(3), F.lit(3)).otherwise(F.col("block_name")).cast("tinyint"),
        "matched_source": F.when(_at(4), F.lit("S9")).otherwise(F.col("matched_source")),
    }
    return rows.select(*[changed.get(c, F.col(c)).alias(c) for c in rows.columns])


def truth(pairs: DataFrame) -> DataFrame:
    """True pairs of which some repeat, name a wrong source, or have no target."""
    b = bucket(F.col(io.PAIR[1]), 10)
    source = F.when(b == 1, F.lit("S9")).otherwise(F.col(io.PAIR[2]))
    target = F.when(b == 2, F.concat(F.col(io.PAIR[1]), F.lit("U"))).otherwise(F.col(io.PAIR[1]))
    return pairs.unionByName(pairs.where(b == 0)).select(F.col(io.PAIR[0]), target.alias(io.PAIR[1]), source.alias(io.PAIR[2]))


def targets(records: DataFrame) -> DataFrame:
    """Target records, some of whose ids stand in both sources."""
    rows = records.where("source <> 'S1'").select("entity_id", "source")
    both = rows.where(bucket(F.col("entity_id"), 10) == 3).withColumn("source", F.when(F.col("source") == "S2", "S3").otherwise("S2"))
    return rows.unionByName(both)


def words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers under Latin names as source 1, customers under the same names in other letters as source 2, with their number in the address."""

    def side(table: str, key: str, source: str, names: list[str], street: str) -> DataFrame:
        k = F.col(key)
        name = F.element_at(F.array(*[F.lit(n) for n in names]), (k % 3 + 1).cast("int"))
        return spark.read.parquet(f"{sf_dir}/{table}.parquet").select(F.concat(F.lit(f"{source}-"), k.cast("string")).alias("entity_id"), F.lit(source).alias("source"), F.concat(name, F.lit(" "), k.cast("string")).alias("business_name"), F.concat(k.cast("string"), F.lit(street)).alias("business_address"), F.lit("India").alias("country"))

    return side("supplier", "s_suppkey", "S1", ["raam", "cafe", "strasse"], " main").unionByName(side("customer", "c_custkey", "S2", ["राम", "Café", "Straße"], " road"))

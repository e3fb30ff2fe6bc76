"""Labels, splits and training sets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.arrays import bucket
from tessera.operators.features import proxy
from tessera.sources.io import PAIR


def label_pairs(pairs: DataFrame, truth: DataFrame) -> DataFrame:
    marks = truth.select(*PAIR).distinct().withColumn("_hit", F.lit(1))
    return pairs.join(marks, PAIR, "left").select(*pairs.columns, F.when(F.col("_hit").isNotNull(), 1).otherwise(0).cast("tinyint").alias("label"))


def split(pairs: DataFrame, of: int = 10, train_below: int = 8) -> tuple[DataFrame, DataFrame]:
    """Train and validation pairs; all pairs of a source-1 record fall on one side."""
    b = bucket(F.col("source1_entity_id"), of)
    return pairs.where(b < train_below), pairs.where(b >= train_below)


def leakage(train: DataFrame, valid: DataFrame) -> DataFrame:
    ids = train.select("source1_entity_id").distinct().join(valid.select("source1_entity_id").distinct(), "source1_entity_id", "left_semi")
    return ids.agg(F.count(F.lit(1)).alias("leaked"))


def split_report(pairs: DataFrame, of: int = 10, train_below: int = 8) -> DataFrame:
    """One row: pairs and records on each side, pairs on neither, records on both."""
    b = bucket(F.col("source1_entity_id"), of)
    per = pairs.select("source1_entity_id", (b < train_below).alias("train")).groupBy("source1_entity_id").agg(F.count_if("train").alias("t"), F.count_if(~F.col("train")).alias("v"), F.count(F.lit(1)).alias("n"))
    return per.agg(F.sum("t").alias("train_pairs"), F.sum("v").alias("valid_pairs"), F.count_if(F.col("t") > 0).alias("train_entities"), F.count_if(F.col("v") > 0).alias("valid_entities"), F.sum(F.col("n") - F.col("t") - F.col("v")).alias("lost_pairs"), F.count_if((F.col("t") > 0) & (F.col("v") > 0)).alias("leaked"))


def truth_gates(truth: DataFrame, targets: DataFrame) -> DataFrame:
    """One row: pairs, pairs that repeat, sources other than S2 and S3, pairs without a target record, target ids of both sources."""
    rows = truth.groupBy(*PAIR).agg(F.count(F.lit(1)).alias("n"))
    known = targets.groupBy(F.col("entity_id").alias("matched_entity_id")).agg(F.countDistinct("source").alias("_sources"))
    found = rows.join(known, "matched_entity_id", "left").agg(F.sum("n").alias("pairs"), F.count_if(F.col("n") > 1).alias("repeated"), F.count_if(~F.coalesce(F.col("matched_source").isin("S2", "S3"), F.lit(False))).alias("bad_source"), F.count_if(F.col("_sources").isNull()).alias("unknown_target"))
    both = known.agg(F.count_if(F.col("_sources") > 1).alias("ids_of_both_sources"))
    one = F.lit(1).alias("_one")
    return found.select("*", one).join(both.select("*", one), "_one").drop("_one")


def label_gates(labelled: DataFrame, candidates: DataFrame) -> DataFrame:
    """One row: labelled pairs, how many the candidates have more or less, labels outside 0 and 1, positives."""
    c = candidates.select(*PAIR, F.lit(1).alias("_c"), F.lit(0).alias("_l"), F.lit(None).cast("int").alias("label"))
    rows = c.unionByName(labelled.select(*PAIR, F.lit(0).alias("_c"), F.lit(1).alias("_l"), F.col("label").cast("int")))
    g = rows.groupBy(*PAIR).agg(F.sum("_c").alias("c"), F.sum("_l").alias("l"), F.max("label").alias("label"))
    return g.agg(F.sum("l").alias("pairs"), F.count_if(F.col("l") < F.col("c")).alias("lost"), F.count_if(F.col("l") > F.col("c")).alias("added"), F.count_if((F.col("l") > 0) & ~F.coalesce(F.col("label").isin(0, 1), F.lit(False))).alias("bad_labels"), F.count_if(F.col("label") == 1).alias("positives"))


def per_source(rows: DataFrame, n: int, key: str = "entity_id") -> DataFrame:
    """n rows of each source, by the hash of their key."""
    order = Window.partitionBy("source").orderBy(F.md5(key), key)
    return rows.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= n).drop("_n")


def pair_bucket(n: int) -> Column:
    return bucket(F.concat_ws("|", "source1_entity_id", "matched_entity_id"), n)


def hard_negatives(labelled: DataFrame, rank: int = 3, budget: int | None = None) -> DataFrame:
    """The negatives of highest rule score of each record and source, thinned by hash to the budget."""
    return hardest(labelled.select(*PAIR, F.round(proxy(labelled.columns), 6).alias("score"), "label"), rank, budget)


def hardest(scored: DataFrame, rank: int = 3, budget: int | None = None) -> DataFrame:
    """hard_negatives() of pairs (score, label); pairs that cannot be among them may be left out before."""
    order = Window.partitionBy("source1_entity_id", "matched_source").orderBy(F.col("proxy").desc(), F.md5("matched_entity_id"), "matched_entity_id")
    rows = scored.where("label = 0").select(*PAIR, F.col("score").alias("proxy")).withColumn("rnk", F.row_number().over(order)).where(F.col("rnk") <= rank)
    if budget is not None:
        found = rows.count()
        if found > budget:
            rows = rows.where(pair_bucket(1_000_000) < round(budget / found * 1_000_000))
    return rows


def balanced(labelled: DataFrame, ratio: float = 3.0, max_positives: int | None = None) -> DataFrame:
    """Positives and about ratio times as many negatives, chosen by hash."""
    pos, neg = labelled.groupBy().agg(F.count_if(F.col("label") == 1), F.count_if(F.col("label") == 0)).first()
    keep_pos = min(1.0, (max_positives or pos) / pos) if pos else 1.0
    keep_neg = min(1.0, ratio * pos * keep_pos / neg) if neg else 1.0
    b = pair_bucket(1_000_000)
    return labelled.where(((F.col("label") == 1) & (b < round(keep_pos * 1e6))) | ((F.col("label") == 0) & (b < round(keep_neg * 1e6))))


def training_matrix(labelled: DataFrame, rank: int = 3, easy_ppm: int = 100_000, budget: int | None = None) -> DataFrame:
    """Positives, hard negatives and a hash sample of the others."""
    hard = hard_negatives(labelled, rank, budget).select(*PAIR).withColumn("_hard", F.lit(True))
    rows = labelled.join(hard, PAIR, "left")
    return rows.where((F.col("label") == 1) | F.coalesce("_hard", F.lit(False)) | (pair_bucket(1_000_000) < easy_ppm)).select(*labelled.columns)


def matrix_of(scored: DataFrame, rank: int = 3, easy_ppm: int = 100_000) -> DataFrame:
    """training_matrix() of pairs (score, label, best); negatives that are not `best` are never hard, and those neither best nor easy may
    be left out before."""
    group = Window.partitionBy("source1_entity_id", "matched_source", "_hard").orderBy(F.col("score").desc(), F.md5("matched_entity_id"), "matched_entity_id")
    rows = scored.withColumn("_hard", F.col("best") & (F.col("label") == 0))
    easy = pair_bucket(1_000_000) < easy_ppm
    others = rows.where(~F.col("_hard")).where((F.col("label") == 1) | easy)
    hard = rows.where("_hard").withColumn("_n", F.row_number().over(group)).where((F.col("_n") <= rank) | easy).drop("_n")
    return others.unionByName(hard).select(*PAIR, "label")


def entity_sample(pairs: DataFrame, percent: int) -> DataFrame:
    """All pairs of a share of the source-1 records."""
    return pairs.where(bucket(F.col("source1_entity_id"), 100) < percent)


def negative_ratio(memory_gb: float, asked: float | None = None) -> float:
    """Negatives for each positive that fit the memory."""
    return asked if asked else 1.5 if memory_gb < 8 else 2.5 if memory_gb < 16 else 3.0

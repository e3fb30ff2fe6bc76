"""From scored pairs to matches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

def _entity():
    return Window.partitionBy("source1_entity_id")



def threshold(scored: DataFrame, t: float) -> DataFrame:
    return scored.where(F.col("score") >= F.lit(float(t)))


def margin(scored: DataFrame, t: float, delta: float) -> DataFrame:
    """Above t, and at most delta below the record's best."""
    kept = threshold(scored, t).withColumn("_max", F.max("score").over(_entity()))
    return kept.where(F.col("score") >= F.col("_max") - F.lit(float(delta))).drop("_max")


def least_of(thresholds: dict[str, float], other: float, column: str = "country_norm") -> Column:
    """The threshold of a record's country."""
    least = F.lit(float(other))
    for name, t in thresholds.items():
        least = F.when(F.col(column) == name, F.lit(float(t))).otherwise(least)
    return least


def country_topk(scored: DataFrame, records: DataFrame, thresholds: dict[str, float], other: float, delta: float = 0.05, k: int = 8) -> DataFrame:
    """A threshold for each country, then margin and the best k, counted after the threshold; ties by id."""
    country = records.where("source = 'S1'").select(F.col("entity_id").alias("source1_entity_id"), F.col("country_norm").alias("_c"))
    kept = scored.join(country, "source1_entity_id", "left").where(F.col("score") >= least_of(thresholds, other, "_c"))
    # The record's best pair is among its best k, so Spark may drop all others before it deals them by record.
    kept = kept.withColumn("_n", F.row_number().over(_entity().orderBy(F.col("score").desc(), "matched_entity_id", "matched_source"))).where(F.col("_n") <= k)
    return kept.withColumn("_max", F.max("score").over(_entity())).where(F.col("score") >= F.col("_max") - F.lit(float(delta))).select(*scored.columns)


def adaptive(scored: DataFrame, t_abs: float = 0.585, alpha: float = 0.9, variant: str = "standard", base: float = 0.585) -> DataFrame:
    """Above max(t_abs, alpha * the record's best).

    Variant a does so only for records with two predictions or more at base, variant b only for
    those with three candidates or more; others keep the base threshold.
    """
    rows = scored.withColumn("_max", F.max("score").over(_entity())).withColumn("_base", F.count_if(F.col("score") >= F.lit(base)).over(_entity())).withColumn("_all", F.count(F.lit(1)).over(_entity()))
    level = F.greatest(F.lit(float(t_abs)), F.lit(float(alpha)) * F.col("_max"))
    applies = {"standard": F.lit(True), "a": F.col("_base") >= 2, "b": F.col("_all") >= 3}[variant]
    return rows.where(F.col("score") >= F.when(applies, level).otherwise(F.lit(float(base)))).select(*scored.columns)


def promote(score: float, protected: float, baseline: float | None = None, expected: float | None = None, tolerance: float = 0.001) -> bool:
    """Whether a variant replaces the protected one; the baseline must be reproduced first."""
    if baseline is not None and expected is not None and abs(baseline - expected) > tolerance:
        raise ValueError(f"baseline {baseline} is not the expected {expected}")
    return score > protected

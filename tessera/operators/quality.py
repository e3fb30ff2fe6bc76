"""Checks and profiles, each one aggregation where it can be."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.features import FEATURES
from tessera.sources.io import PAIR


def records_quality(records: DataFrame) -> DataFrame:
    """By source: rows, repeated and empty ids, empty derived fields, missing raw fields."""
    empty = [F.count_if(F.col(c) == "").alias(f"empty_{c}") for c in ("name_norm", "name_compact", "address_norm", "address_compact", "country_norm")]
    lists = [F.count_if(F.size(c) == 0).alias(f"empty_{c}") for c in ("name_tokens", "address_tokens")]
    raw = [F.count_if(F.coalesce(F.col(c), F.lit("")) == "").alias(f"missing_{c}") for c in ("business_name", "business_address", "country")]
    return records.groupBy("source").agg(F.count(F.lit(1)).alias("rows"), (F.count(F.lit(1)) - F.countDistinct("entity_id")).alias("repeated_ids"), F.count_if(F.trim("entity_id") == "").alias("empty_ids"), *empty, *lists, *raw)


def kinds(ratios: tuple[str, ...] = ("ratio", "overlap", "jaccard")) -> tuple[list[str], list[str]]:
    """Features between 0 and 1, and features of 0 or 1."""
    return [c for c in FEATURES if c.endswith(ratios)], [c for c in FEATURES if c.endswith(("exact", "present")) or c.startswith("block_")]


def features_quality(features: DataFrame, ratios: tuple[str, ...] = ("ratio", "overlap", "jaccard")) -> DataFrame:
    """One row: rows, repeated pairs, nulls, values out of range, means."""
    is_ratio, flags = kinds(ratios)

    def total(cs: list[Column]) -> Column:
        return sum((F.count_if(c) for c in cs), F.lit(0).cast("long"))

    return features.agg(
        F.count(F.lit(1)).alias("rows"), (F.count(F.lit(1)) - F.countDistinct(*PAIR)).alias("repeated_pairs"),
        total([F.col(c).isNull() for c in FEATURES]).alias("nulls"), total([(F.col(c) < 0) | (F.col(c) > 1) for c in is_ratio]).alias("ratios_out_of_range"),
        total([~F.col(c).isin(0, 1) for c in flags]).alias("flags_out_of_range"), total([~F.col("matched_source").isin("S2", "S3")]).alias("bad_sources"),
        *[F.round(F.avg(c), 4).alias(f"mean_{c}") for c in ("name_token_jaccard", "address_token_jaccard", "name_char_ratio")],
    )


def features_gate(features: DataFrame, expected: dict[str, int], ratios: tuple[str, ...] = ("ratio", "overlap", "jaccard"), weight: str | None = None) -> DataFrame:
    """For each expected source: rows wanted and found, null ids, null features, ratios out of range, flags outside 0 and 1, repeated pairs.

    Rows of other sources are counted under their own name with none wanted.  A missing feature column fails at once.
    weight: a column with the number of pairs that a row stands for, itself included; they differ in nothing that is counted here.
    """
    missing = [c for c in FEATURES if c not in features.columns]
    if missing:
        raise ValueError(f"missing features: {missing}")
    any_of = lambda conds: reduce(lambda a, b: a | b, conds)
    is_ratio, flags = kinds(ratios)
    tests = {
        "null_ids": F.col(PAIR[0]).isNull() | F.col(PAIR[1]).isNull(),
        "null_features": any_of([F.col(c).isNull() for c in FEATURES]),
        "ratios_out_of_range": F.coalesce(any_of([(F.col(c) < 0) | (F.col(c) > 1) for c in is_ratio]), F.lit(False)),
        "flags_out_of_range": F.coalesce(any_of([~F.col(c).isin(0, 1) for c in flags]), F.lit(False)),
    }
    pairs, zero = F.lit(1).cast("long") if weight is None else F.col(weight).cast("long"), F.lit(0).cast("long")
    per = features.groupBy(*PAIR).agg(F.count(F.lit(1)).alias("_n"), F.max(pairs).alias("_pairs"), F.sum(pairs).alias("rows"), *[F.sum(F.when(t, pairs).otherwise(zero)).alias(n) for n, t in tests.items()])
    found = per.groupBy("matched_source").agg(F.sum("rows").alias("rows"), *[F.sum(n).alias(n) for n in tests], F.sum(F.when(F.col("_n") > 1, F.col("_pairs")).otherwise(zero)).alias("repeated_pairs"))
    wanted = features.sparkSession.createDataFrame([(s, int(n)) for s, n in expected.items()], "matched_source string, wanted long")
    out = F.broadcast(wanted).join(found, "matched_source", "full")
    return out.select("matched_source", *[F.coalesce(c, zero).alias(c) for c in ("wanted", "rows", *tests, "repeated_pairs")])


def missing_profile(records: DataFrame) -> DataFrame:
    """By source and column: rows, missing and the share in percent; blank and `nan`-like words count as missing."""
    # Spellings of a missing value.
    blank = ["", "nan", "null", "none", "n/a", "na", "-"]
    out = None
    for c in ("business_name", "business_address", "country"):
        part = records.groupBy("source").agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.coalesce(F.lower(F.trim(c)), F.lit("")).isin(blank)).alias("missing")).select("source", F.lit(c).alias("column_name"), "rows", "missing", F.round(F.lit(100.0) * F.col("missing") / F.col("rows"), 6).alias("missing_pct"))
        out = part if out is None else out.unionByName(part)
    return out


def top_values(records: DataFrame, column: str, n: int = 20) -> DataFrame:
    return records.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("rows")).orderBy(F.col("rows").desc(), F.col("value").asc_nulls_last()).limit(n)


def frequency_profile(records: DataFrame, key: str) -> DataFrame:
    """Distinct keys and records by how often a key stands in a source."""
    n = records.where(F.col(key) != "").groupBy("source", key).agg(F.count(F.lit(1)).alias("n"))
    band = F.when(F.col("n") == 1, "1").when(F.col("n").between(2, 5), "2-5").when(F.col("n").between(6, 20), "6-20").when(F.col("n").between(21, 100), "21-100").otherwise("100+")
    return n.groupBy("source", band.alias("band")).agg(F.count(F.lit(1)).alias("keys"), F.sum("n").alias("records"))


def bucket_sizes(records: DataFrame, key: str) -> DataFrame:
    """Size quantiles of the blocks a key makes, by source."""
    n = records.where((F.col(key) != "") & (F.col("country_norm") != "")).groupBy("source", "country_norm", key).agg(F.count(F.lit(1)).alias("n"))
    p = lambda q: F.round(F.percentile("n", F.lit(q)), 6)
    return n.groupBy("source").agg(F.count(F.lit(1)).alias("blocks"), F.max("n").alias("largest"), p(0.5).alias("p50"), p(0.9).alias("p90"), p(0.99).alias("p99"))


def text_profile(records: DataFrame, column: str) -> DataFrame:
    """By source: length and token percentiles, shares of non-ASCII, digits and upper case."""
    c = F.coalesce(F.col(column), F.lit(""))
    words = F.size(F.filter(F.split(c, r"\s+"), lambda x: x != ""))
    share = lambda cond: F.round(F.lit(100.0) * F.count_if(cond) / F.count(F.lit(1)), 6)
    return records.groupBy("source").agg(
        F.count(F.lit(1)).alias("rows"), F.round(F.percentile(F.length(c), F.lit(0.99)), 6).alias("length_p99"), F.max(F.length(c)).alias("length_max"), F.round(F.percentile(words, F.lit(0.99)), 6).alias("tokens_p99"),
        share(c.rlike(r"[^\x00-\x7F]")).alias("non_ascii_pct"), share(c.rlike("[0-9]")).alias("digit_pct"), share((c != "") & (F.upper(c) == c) & (F.lower(c) != c)).alias("upper_pct"),
    )


def prefix_check(records: DataFrame) -> DataFrame:
    """By source: ids, and ids whose prefix is not the source."""
    return records.groupBy("source").agg(F.count(F.lit(1)).alias("ids"), F.count_if(~F.col("entity_id").startswith(F.concat("source", F.lit("-")))).alias("wrong_prefix"))


def list_profile(lists: DataFrame) -> DataFrame:
    """One row of a table of comma-separated matches: rows, empty ones, matches, average and most."""
    text = F.coalesce("matched_entity_ids", F.lit(""))
    n = F.when(text == "", F.lit(0)).otherwise(F.size(F.split(text, ",")))
    return lists.agg(F.count(F.lit(1)).alias("rows"), F.count_if(n == 0).alias("empty_rows"), F.sum(n).cast("long").alias("matches"), F.round(F.avg(n), 6).alias("avg_matches"), F.max(n).cast("long").alias("most"))

"""Similarity features of candidate pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions import arrays, text
from tessera.sources.io import PAIR

SIDE = ["country", "country_norm", "name_norm", "name_compact", "name_stripped", "name_tokens", "address_norm", "address_compact", "address_stripped", "address_tokens"]
FEATURES = [
    "name_exact", "name_compact_exact", "name_ascii_exact", "name_char_ratio", "name_token_overlap", "name_token_jaccard", "name_length_diff", "name_token_count_diff", "name_numeric_overlap", "name_numeric_exact", "name_length_ratio",
    "address_exact", "address_compact_exact", "address_ascii_exact", "address_char_ratio", "address_token_overlap", "address_token_jaccard", "address_length_diff", "address_token_count_diff", "address_numeric_exact", "address_numeric_overlap", "address_length_ratio",
    "country_exact", "name_present", "address_present", "block_address", "block_address_compact", "block_name", "block_rare_name", "block_rare_address", "block_hybrid",
]


def _flag(c: Column) -> Column:
    return F.when(c, 1).otherwise(0).cast("tinyint")


def _same(a: Column, b: Column) -> Column:
    return _flag((a != "") & (a == b))


def enriched(candidates: DataFrame, stripped: DataFrame, more: list[str] | None = None) -> DataFrame:
    """Candidates with both records' columns, those of SIDE and more, as a_ and b_; two equi-joins, no broadcast asked for."""
    columns = [*SIDE, *(more or [])]
    a = stripped.where("source = 'S1'").select(F.col("entity_id").alias("source1_entity_id"), *[F.col(c).alias(f"a_{c}") for c in columns])
    b = stripped.where("source <> 'S1'").select(F.col("entity_id").alias("matched_entity_id"), F.col("source").alias("matched_source"), *[F.col(c).alias(f"b_{c}") for c in columns])
    return candidates.join(a, "source1_entity_id").join(b, ["matched_source", "matched_entity_id"])


def _of(field: str) -> list[Column]:
    a, b = F.col(f"a_{field}_norm"), F.col(f"b_{field}_norm")
    ta, tb = F.col(f"a_{field}_tokens"), F.col(f"b_{field}_tokens")
    da, db = text.digits(a), text.digits(b)
    la, lb = F.length(a), F.length(b)
    return [
        _same(a, b).alias(f"{field}_exact"),
        _same(F.col(f"a_{field}_compact"), F.col(f"b_{field}_compact")).alias(f"{field}_compact_exact"),
        _same(F.col(f"a_{field}_stripped"), F.col(f"b_{field}_stripped")).alias(f"{field}_ascii_exact"),
        F.when((a == "") | (b == ""), F.lit(0.0)).otherwise(text.jaro_winkler(a, b)).cast("float").alias(f"{field}_char_ratio"),
        arrays.overlap(ta, tb).alias(f"{field}_token_overlap"),
        arrays.jaccard(ta, tb).alias(f"{field}_token_jaccard"),
        F.abs(la - lb).cast("smallint").alias(f"{field}_length_diff"),
        F.abs(F.size(ta) - F.size(tb)).cast("tinyint").alias(f"{field}_token_count_diff"),
        arrays.overlap(da, db).alias(f"{field}_numeric_overlap"),
        _flag(arrays.equal_sets(da, db)).alias(f"{field}_numeric_exact"),
        F.when(F.greatest(la, lb) == 0, F.lit(0.0)).otherwise(F.least(la, lb) / F.greatest(la, lb)).cast("float").alias(f"{field}_length_ratio"),
    ]


def itself(records: DataFrame, field: str) -> DataFrame:
    """records with `itself`, the features of a field compared with itself: what two records of one view have."""
    both = records.select("*", *[F.col(c).alias(f"{side}_{c}") for side in "ab" for c in SIDE])
    return both.select(*records.columns, F.struct(*_of(field)).alias("itself"))


def pair_features(candidates: DataFrame, stripped: DataFrame) -> DataFrame:
    """Keys, provenance and FEATURES of every candidate pair."""
    mask = F.col("blocking_mask")
    blocks = [_flag(mask.bitwiseAND(F.lit(b)) != 0).alias(f"block_{n}") for n, b in (("address", 1), ("address_compact", 2), ("name", 4), ("rare_name", 8), ("rare_address", 16))]
    rows = enriched(candidates, stripped).select(
        *PAIR, mask.cast("smallint").alias("blocking_mask"), F.col("num_blocking_methods").cast("tinyint").alias("num_blocking_methods"), "blocking_methods",
        *_of("name"), *_of("address"), _same(F.col("a_country"), F.col("b_country")).alias("country_exact"), _flag(F.col("a_name_norm") != "").alias("name_present"), _flag(F.col("a_address_norm") != "").alias("address_present"),
        *blocks, _flag(F.col("num_blocking_methods") >= 2).alias("block_hybrid"),
    )
    return rows.select(*PAIR, "blocking_mask", "num_blocking_methods", "blocking_methods", *FEATURES)


def sample_features(candidates: DataFrame, stripped: DataFrame, n: int = 5000) -> DataFrame:
    """Features of n pairs of each source, by the hash of the pair; quality.features_gate holds the sample to its size."""
    order = Window.partitionBy("matched_source").orderBy(F.md5(F.concat_ws("|", *PAIR[:2])), *PAIR[:2])
    some = candidates.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= n).drop("_n")
    return pair_features(some, stripped)


#: Weights of the rule score.
PROXY = {"name_char_ratio": 0.40, "name_token_jaccard": 0.25, "address_token_jaccard": 0.20, "address_char_ratio": 0.15}


def proxy(columns: list[str]) -> Column:
    """Weighted sum of the features present, weights scaled to one; 0 if none is."""
    there = {c: w for c, w in PROXY.items() if c in columns}
    total = sum(there.values())
    return sum((F.col(c).cast("double") * F.lit(w / total) for c, w in there.items()), F.lit(0.0))


def proxy_parts(rows: DataFrame, *keep) -> DataFrame:
    """The components of the rule score of enriched() pairs, as doubles, after the columns to keep."""
    parts = rows.select(*keep, *_of("name"), *_of("address"))
    return parts.select(*parts.columns[: len(keep)], *[F.col(c).cast("double").alias(c) for c in PROXY])

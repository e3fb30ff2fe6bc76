"""Candidate pairs of source-1 records and records of other sources.

Every block is one or more equi-joins on country and key; none compares all records.  Results are
distinct pairs with the name of the block.  The join of a block has a plain exchange on both sides and
another exchange after it, so Spark splits a key that most rows share over many tasks; such a key still
gives all its pairs, as the definition asks, and quality.bucket_sizes() tells how large keys are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions import text
from tessera.operators import records as rec
from tessera.sources.io import PAIR


def _pairs(rows: DataFrame, keys: list[str], name: str, apart: str | None = None) -> DataFrame:
    """Pairs of rows (source, entity_id, keys) that agree on all keys, but not on the column apart; empty values agree with none."""
    more = [] if apart is None else [apart]
    one = rows.where("source = 'S1'").select(F.col("entity_id").alias("source1_entity_id"), *keys, *[F.col(c).alias("_a") for c in more])
    two = rows.where("source <> 'S1'").select(F.col("entity_id").alias("matched_entity_id"), F.col("source").alias("matched_source"), *keys, *[F.col(c).alias("_b") for c in more])
    both = one.join(two, keys)
    if more:
        both = both.where(~F.coalesce(F.expr("_a = _b and _a <> ''"), F.lit(False)))
    return both.select(*PAIR).distinct().withColumn("block_name", F.lit(name))


def exact(records: DataFrame, key: str, name: str, apart: str | None = None) -> DataFrame:
    """Pairs of one key; apart: a column on which they must not agree, too, so that such pairs are not even made."""
    if apart is None:
        return _pairs(rec.key_index(records, key), ["country_norm", "block_key"], name)
    rows = records.where((F.col(key) != "") & (F.col("country_norm") != "")).select("source", "country_norm", F.col(key).alias("block_key"), "entity_id", apart)
    return _pairs(rows, ["country_norm", "block_key"], name, apart)


def rare_topk(records: DataFrame, column: str, name: str, cap: int = 50, k: int = 2, drop_numbers: bool = False) -> DataFrame:
    """Pairs that share one of a record's k rarest tokens in the other source."""
    index = rec.rare_tokens(rec.token_rows(records.where("source <> 'S1'"), column, drop_numbers=drop_numbers), cap)
    mine = rec.token_rows(records.where("source = 'S1'"), column).select(F.col("entity_id").alias("source1_entity_id"), "country_norm", "token")
    known = index.select(F.col("source").alias("matched_source"), "country_norm", "token", "token_freq").distinct()
    order = Window.partitionBy("source1_entity_id", "matched_source").orderBy("token_freq", F.length("token").desc(), "token")
    chosen = mine.join(known, ["country_norm", "token"]).withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= k)
    theirs = index.select(F.col("source").alias("matched_source"), "country_norm", "token", F.col("entity_id").alias("matched_entity_id"))
    return chosen.join(theirs, ["matched_source", "country_norm", "token"]).select(*PAIR).distinct().withColumn("block_name", F.lit(name))


def rare_strict(records: DataFrame, column: str = "name_tokens", name: str = "rare_name_strict", min_length: int = 5, cap: int = 20) -> DataFrame:
    """Pairs that share any long token rare in the other source."""
    rows = rec.token_rows(records, column, min_length, text.STOP_TOKENS)
    kept = rec.rare_tokens(rows.where("source <> 'S1'"), cap).select("source", "entity_id", "country_norm", "token")
    return _pairs(rows.where("source = 'S1'").select("source", "entity_id", "country_norm", "token").unionByName(kept), ["country_norm", "token"], name)


def number_prefix(stripped: DataFrame, parity: bool = False, name: str = "num_pfx") -> DataFrame:
    """First address number and first three ASCII letters of the name agree.  parity: source 1 keeps its accents."""
    base = F.when(F.col("source") == "S1", F.col("name_norm")).otherwise(F.col("name_stripped")) if parity else F.col("name_stripped")
    rows = stripped.where("country_norm <> ''").select("source", "entity_id", "country_norm", F.lower(F.regexp_extract(base, "^([a-z0-9]{3})", 1)).alias("prefix"), F.get("address_numeric_tokens", F.lit(0)).alias("number"))
    return _pairs(rows.where("prefix <> '' and number <> ''"), ["country_norm", "prefix", "number"], name)


def core_name(stripped: DataFrame, min_length: int = 4, name: str = "core_name") -> DataFrame:
    rows = stripped.select("source", "entity_id", "country_norm", text.core_name(F.col("name_stripped")).alias("block_key"))
    return _pairs(rows.where((F.length("block_key") >= min_length) & (F.col("country_norm") != "")), ["country_norm", "block_key"], name)


def domain_name(stripped: DataFrame, min_length: int = 5, name: str = "domain_name") -> DataFrame:
    rows = stripped.select("source", "entity_id", "country_norm", text.domain_name(F.col("name_compact_stripped")).alias("block_key"))
    return _pairs(rows.where((F.length("block_key") >= min_length) & (F.col("country_norm") != "")), ["country_norm", "block_key"], name)


def transliterated(stripped: DataFrame, country: str | None = "india", min_length: int = 3, name: str = "indic_translit") -> DataFrame:
    """Accented or non-Latin names of other sources, read in Latin, equal a source-1 name or compact name.

    The "or" is a union of two equi-joins.
    """
    rows = stripped if country is None else stripped.where(F.col("country_norm") == country)
    rows = rows.where("country_norm <> ''")
    theirs = rows.where("source <> 'S1' and name_stripped <> name_norm")
    out = None
    for key in ("name_norm", "name_compact"):
        one = rows.where("source = 'S1'").select("source", "entity_id", "country_norm", F.col(key).alias("block_key"))
        two = theirs.select("source", "entity_id", "country_norm", F.trim(text.ascii_view(F.col(key))).alias("block_key"))
        part = _pairs(one.unionByName(two).where(F.length("block_key") >= min_length), ["country_norm", "block_key"], name)
        out = part if out is None else out.unionByName(part)
    return out.distinct()


def ascii_exact(records: DataFrame, name: str = "ascii_exact") -> DataFrame:
    """Equal Latin readings of names, or of compact names."""
    out = None
    for key in ("name_norm", "name_compact"):
        view = records.select("source", "entity_id", "country_norm", text.ascii_view(F.col(key)).alias("block_key"))
        part = _pairs(view.where("block_key <> '' and country_norm <> ''"), ["country_norm", "block_key"], name)
        out = part if out is None else out.unionByName(part)
    return out.distinct()


def number_anchor(records: DataFrame, cap: int = 100, name: str = "numeric_anchor") -> DataFrame:
    """Pairs that share a long number found in at most cap records of the other source."""
    rows = rec.number_anchors(records)
    kept = rec.rare_tokens(rows.where("source <> 'S1'"), cap).select("source", "entity_id", "country_norm", "token")
    mine = rows.where("source = 'S1'").join(kept.select("country_norm", "token").distinct(), ["country_norm", "token"], "left_semi")
    return _pairs(mine.select("source", "entity_id", "country_norm", "token").unionByName(kept), ["country_norm", "token"], name)


def address_overlap(records: DataFrame, least: int = 3, min_length: int = 4, cap: int = 50, name: str = "rare_address") -> DataFrame:
    """Pairs that share rare address tokens: at least `least`, or any if their names agree; with the number shared."""
    rows = rec.token_rows(records, "address_tokens", min_length, text.STOP_TOKENS)
    kept = rec.rare_tokens(rows.where("source <> 'S1'"), cap)
    mine = rows.where("source = 'S1'").select(F.col("entity_id").alias("source1_entity_id"), "country_norm", "token")
    theirs = kept.select(F.col("entity_id").alias("matched_entity_id"), F.col("source").alias("matched_source"), "country_norm", "token")
    pairs = mine.join(theirs, ["country_norm", "token"]).groupBy(*PAIR).agg(F.count(F.lit(1)).cast("int").alias("address_overlap"))
    a = records.where("source = 'S1'").select(F.col("entity_id").alias("source1_entity_id"), F.col("name_norm").alias("n1"), F.col("name_compact").alias("c1"))
    b = records.where("source <> 'S1'").select(F.col("entity_id").alias("matched_entity_id"), F.col("source").alias("matched_source"), F.col("name_norm").alias("n2"), F.col("name_compact").alias("c2"))
    both = pairs.join(a, "source1_entity_id").join(b, ["matched_entity_id", "matched_source"])
    return both.where(f"address_overlap >= {int(least)} or n1 = n2 or c1 = c2").select(*PAIR, "address_overlap", F.lit(name).alias("block_name"))

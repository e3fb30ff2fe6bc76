"""Normalised records, key indexes and token statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import text


def normalise(records: DataFrame) -> DataFrame:
    """Raw columns and their normal, compact and token views."""
    r = records.select("*", text.norm(F.col("business_name")).alias("name_norm"), text.compact(F.col("business_name")).alias("name_compact"), text.norm(F.col("business_address")).alias("address_norm"), text.compact(F.col("business_address")).alias("address_compact"), text.country_norm(F.col("country")).alias("country_norm"))
    return r.select("*", text.tokens(F.col("name_norm")).alias("name_tokens"), text.numeric_tokens(F.col("name_norm")).alias("name_numeric_tokens"), text.tokens(F.col("address_norm")).alias("address_tokens"), text.numeric_tokens(F.col("address_norm")).alias("address_numeric_tokens"))


def gates(records: DataFrame) -> DataFrame:
    """Rows, distinct ids and empty ids of each source, in one pass."""
    return records.groupBy("source").agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("entity_id").alias("ids"), F.count_if(F.trim(F.coalesce("entity_id", F.lit(""))) == "").alias("empty_ids"))


def with_stripped(records: DataFrame) -> DataFrame:
    """name_stripped, name_compact_stripped and address_stripped, once for each record."""
    return records.select("*", text.strip_accents(F.col("name_norm")).alias("name_stripped"), text.strip_accents(F.col("name_compact")).alias("name_compact_stripped"), text.strip_accents(F.col("address_norm")).alias("address_stripped"))


def record_views(records: DataFrame) -> DataFrame:
    """entity_id and, for name and address, a struct of the Unicode, ASCII and compact views, the tokens and the numeric tokens."""
    out = records.select("entity_id", "country", *[text.unicode_view(f"business_{f}").alias(f"{f}_unicode") for f in ("name", "address")])
    out = out.select("*", *[text.ascii_key(F.col(f"{f}_unicode")).alias(f"{f}_ascii") for f in ("name", "address")])

    def view(f: str) -> Column:
        a = F.col(f"{f}_ascii")
        return F.struct(F.col(f"{f}_unicode").alias("unicode"), a.alias("ascii"), F.replace(a, F.lit(" "), F.lit("")).alias("compact"), text.tokens(a).alias("tokens"), text.numeric_tokens(a).alias("numeric_tokens")).alias(f)

    return out.select("entity_id", view("name"), view("address"), text.country_norm(F.col("country")).alias("country"))


def with_row_id(df: DataFrame, name: str = "row_id") -> DataFrame:
    """A different long for every row: rising within a partition, with gaps between partitions."""
    return df.withColumn(name, F.monotonically_increasing_id())


def key_index(records: DataFrame, key: str) -> DataFrame:
    """(source, country_norm, block_key, entity_id) where key and country are not empty."""
    return records.where((F.col(key) != "") & (F.col("country_norm") != "")).select("source", "country_norm", F.col(key).alias("block_key"), "entity_id")


def token_rows(records: DataFrame, column: str, min_length: int = 1, stop: list[str] | None = None, drop_numbers: bool = False) -> DataFrame:
    """Distinct (source, country_norm, entity_id, token) of a token list."""
    rows = records.where(F.trim("country_norm") != "").select("source", "country_norm", "entity_id", F.explode(column).alias("t"))
    rows = rows.select("source", "country_norm", "entity_id", F.lower(F.trim("t")).alias("token")).where((F.col("token") != "") & (F.length("token") >= min_length))
    if stop:
        rows = rows.where(~F.col("token").isin(stop))
    if drop_numbers:
        rows = rows.where(~F.col("token").rlike("^[0-9]+$"))
    return rows.distinct()


def token_stats(records: DataFrame, column: str = "name_tokens") -> DataFrame:
    """Number of records with each token of two letters or more."""
    return token_rows(records, column, 2).groupBy("source", "country_norm", "token").agg(F.count(F.lit(1)).alias("doc_frequency")).select("*", F.length("token").cast("long").alias("token_length"))


#: Keys that may be sent to all tasks: those with more than this part of all rows, and so at most as many.
FEW = 20_000


def rare_tokens(rows: DataFrame, cap: int) -> DataFrame:
    """token_rows of tokens in at most cap records of a source and country, with token_freq.

    Counts are combined before the shuffle.  Tokens above the cap that hold more than 1 / FEW of all rows, of which there
    are at most FEW, are dropped before rows meet by token, so a frequent token never gathers in one task.
    """
    keys = ["source", "country_norm", "token"]
    freq = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("token_freq"))
    total = freq.agg(F.sum("token_freq").alias("_all"), F.lit(1).alias("_one"))
    frequent = freq.where(F.col("token_freq") > cap).withColumn("_one", F.lit(1)).join(F.broadcast(total), "_one").where(F.col("token_freq") * FEW > F.col("_all"))
    some = rows.join(F.broadcast(frequent.select(*keys)), keys, "left_anti")
    return some.join(freq.where(F.col("token_freq") <= cap), keys).select("source", "entity_id", "country_norm", "token", "token_freq")


def number_anchors(records: DataFrame, in_address: int = 4, in_name: int = 5) -> DataFrame:
    """Distinct (source, country_norm, entity_id, token) of long digit runs."""
    runs = F.array_union(text.digits(F.col("address_norm"), in_address), text.digits(F.col("name_norm"), in_name))
    return records.where("country_norm <> ''").select("source", "country_norm", "entity_id", F.explode(runs).alias("token")).distinct()

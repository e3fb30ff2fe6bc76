"""Blocks put together: provenance, pruning, expansion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.sources.io import PAIR

# The bit of each block.
BITS = {"address": 1, "address_compact": 2, "name": 4, "rare_name": 8, "rare_address": 16, "num_pfx": 32, "core_name": 64, "domain_name": 128, "indic_translit": 256, "ascii_exact": 512, "numeric_anchor": 1024, "rare_name_strict": 2048}
ALIASES = {"name_compact": "name"}
SETS = {"exact": ["address", "address_compact", "name"], "exact_rare_name": ["address", "address_compact", "name", "rare_name"], "exact_rare_address": ["address", "address_compact", "name", "rare_address"], "all": ["address", "address_compact", "name", "rare_name", "rare_address"]}


def _all(parts: list[DataFrame]) -> DataFrame:
    out = parts[0].select(*PAIR, "block_name")
    for p in parts[1:]:
        out = out.unionByName(p.select(*PAIR, "block_name"))
    return out


def _bit() -> Column:
    out = F.lit(0)
    for name, bit in {**BITS, **{a: BITS[b] for a, b in ALIASES.items()}}.items():
        out = F.when(F.col("block_name") == name, F.lit(bit)).otherwise(out)
    return out.cast("int")


def methods_of(mask: Column, sep: str = "|") -> Column:
    return F.concat_ws(sep, *[F.when(mask.bitwiseAND(F.lit(b)) != 0, F.lit(n)) for n, b in BITS.items()])


def plus_methods_of(mask: Column) -> Column:
    """Every name but the first bit's has a plus before it, whether or not another stands before."""
    return F.concat(*[F.when(mask.bitwiseAND(F.lit(b)) != 0, F.lit(n if b == 1 else f"+{n}")).otherwise(F.lit("")) for n, b in BITS.items()])


def union_provenance(parts: list[DataFrame], count: str = "bits") -> DataFrame:
    """One row a pair: blocking_mask, num_blocking_methods, blocking_methods.

    count: bits (bits of the mask), rows (block rows, methods with plus signs) or names (distinct names).
    """
    rows = _all(parts).withColumn("_bit", _bit())
    g = rows.groupBy(*PAIR).agg(F.bit_or("_bit").alias("blocking_mask"), F.count(F.lit(1)).alias("_rows"), F.array_join(F.array_sort(F.collect_set("block_name")), "|").alias("_names"), F.countDistinct("block_name").alias("_distinct")) if count == "names" else rows.groupBy(*PAIR).agg(F.bit_or("_bit").alias("blocking_mask"), F.count(F.lit(1)).alias("_rows"))
    mask = F.col("blocking_mask")
    n, m = {"bits": (F.bit_count(mask), methods_of(mask)), "rows": (F.col("_rows"), plus_methods_of(mask)), "names": (F.col("_distinct") if count == "names" else F.lit(0), F.col("_names") if count == "names" else F.lit(""))}[count]
    return g.select(*PAIR, "blocking_mask", n.cast("tinyint").alias("num_blocking_methods"), m.alias("blocking_methods"))


def union_set(blocks: dict[str, DataFrame], name: str = "all") -> DataFrame:
    """The union of the blocks of a named set (SETS)."""
    missing = [b for b in SETS[name] if b not in blocks]
    if missing:
        raise ValueError(f"set {name} needs the blocks {missing}")
    return union_provenance([blocks[b] for b in SETS[name]])


def pool(base: DataFrame, blocks: dict[str, DataFrame], methods: list[str]) -> DataFrame:
    """Base pairs and the new ones of the chosen methods; a pair that several methods add is one row with all their names."""
    unknown = [m for m in methods if m not in blocks]
    if unknown:
        raise ValueError(f"unknown methods: {unknown}")
    return final_candidates(base, union_provenance([blocks[m] for m in methods])) if methods else base


def pool_report(base: DataFrame, blocks: dict[str, DataFrame], methods: list[str], truth: DataFrame) -> DataFrame:
    """What each chosen method adds to the base alone: pairs, new pairs, new true pairs, in one aggregation."""
    zero = F.lit(0)
    rows = base.select(*PAIR, F.lit(1).alias("_b"), zero.alias("_t"), F.lit(None).cast("string").alias("method")).unionByName(truth.select(*PAIR, zero.alias("_b"), F.lit(1).alias("_t"), F.lit(None).cast("string").alias("method")))
    for m in methods:
        rows = rows.unionByName(blocks[m].select(*PAIR, zero.alias("_b"), zero.alias("_t"), F.lit(m).alias("method")))
    g = rows.groupBy(*PAIR).agg(F.max("_b").alias("b"), F.max("_t").alias("t"), F.collect_set("method").alias("ms")).select("b", "t", F.explode("ms").alias("method"))
    return g.groupBy("method").agg(F.count(F.lit(1)).alias("pairs"), F.count_if(F.col("b") == 0).alias("new_pairs"), F.count_if((F.col("b") == 0) & (F.col("t") == 1)).alias("new_true"))


def train_pool(parts: list[DataFrame]) -> DataFrame:
    """One row a pair from blocks under any of their names: names are made canonical, identities unique, the mask an INT.

    Rows with a null id, an unknown block or a source other than S2 and S3 fail the job.
    """
    name = F.lower(F.trim("block_name"))
    canonical = name
    for alias, known in ALIASES.items():
        canonical = F.when(name == alias, F.lit(known)).otherwise(canonical)
    rows = _all(parts).withColumn("block_name", canonical)
    wrong = F.col(PAIR[0]).isNull() | F.col(PAIR[1]).isNull() | ~F.coalesce(F.col(PAIR[2]).isin("S2", "S3"), F.lit(False)) | ~F.coalesce(F.col("block_name").isin(list(BITS)), F.lit(False))
    fault = F.raise_error(F.concat_ws(" ", F.lit("bad candidate:"), *PAIR, "block_name")).cast("boolean")
    rows = rows.where(F.when(wrong, fault).otherwise(F.lit(True)))
    g = rows.withColumn("_bit", _bit()).groupBy(*PAIR).agg(F.bit_or("_bit").alias("blocking_mask"), F.array_sort(F.collect_set("block_name")).alias("_names"))
    return g.select(*PAIR, "blocking_mask", F.size("_names").cast("tinyint").alias("num_blocking_methods"), F.array_join("_names", "|").alias("blocking_methods"))


def prune_medium(candidates: DataFrame, records: DataFrame, least: int = 3, named: bool = True) -> DataFrame:
    """Pairs of two methods or more; name-only ones whose names agree; rare-address ones with names or addresses near.

    named=False leaves out the pairs that share a name, all of which the name block has and pruning keeps.
    """
    cols = ["name_norm", "name_compact", "address_tokens"]
    a = records.where("source = 'S1'").select(F.col("entity_id").alias("source1_entity_id"), *[F.col(c).alias(f"a_{c}") for c in cols])
    b = records.where("source <> 'S1'").select(F.col("entity_id").alias("matched_entity_id"), F.col("source").alias("matched_source"), *[F.col(c).alias(f"b_{c}") for c in cols])
    same = F.coalesce(F.expr("a_name_norm = b_name_norm or a_name_compact = b_name_compact"), F.lit(False))
    shared = F.size(F.array_compact(F.array_intersect("a_address_tokens", "b_address_tokens")))
    method = F.col("blocking_methods")
    kept = F.when(F.col("num_blocking_methods") >= 2, F.lit(True)).when(method == "name", same).when(method == "rare_address", same | F.coalesce(shared >= least, F.lit(False))).otherwise(F.lit(False))
    if not named:
        kept = kept & ~F.coalesce(F.expr("a_name_norm = b_name_norm and a_name_norm <> ''"), F.lit(False))
    some = candidates.where((F.col("num_blocking_methods") >= 2) | method.isin("name", "rare_address"))  # others are never kept, and need no texts
    return some.join(a, "source1_entity_id", "left").join(b, ["matched_entity_id", "matched_source"], "left").where(kept).select(*candidates.columns)


def with_shared_name(candidates: DataFrame, records: DataFrame) -> DataFrame:
    """candidates and _named, whether their records share a name; empty names share nothing."""
    a = records.where("source = 'S1'").select(F.col("entity_id").alias("source1_entity_id"), F.col("name_norm").alias("a_name"))
    b = records.where("source <> 'S1'").select(F.col("entity_id").alias("matched_entity_id"), F.col("source").alias("matched_source"), F.col("name_norm").alias("b_name"))
    return candidates.join(a, "source1_entity_id").join(b, ["matched_entity_id", "matched_source"]).select(*candidates.columns, F.coalesce(F.expr("a_name = b_name and a_name <> ''"), F.lit(False)).alias("_named"))


def without_shared_name(candidates: DataFrame, records: DataFrame) -> DataFrame:
    """The pairs whose records do not share a name."""
    return with_shared_name(candidates, records).where("not _named").drop("_named")


def prune_provenance(parts: list[DataFrame]) -> DataFrame:
    """Pairs that two differently named blocks gave, or a name block."""
    rows = _all(parts).withColumn("_bit", _bit())
    g = rows.groupBy(*PAIR).agg(F.bit_or("_bit").alias("blocking_mask"), F.array_sort(F.collect_set("block_name")).alias("_names"), F.bool_or(F.col("block_name").isin("name", "name_compact")).alias("_by_name"))
    g = g.where((F.size("_names") >= 2) | F.col("_by_name"))
    return g.select(*PAIR, "blocking_mask", F.size("_names").cast("tinyint").alias("num_blocking_methods"), F.array_join("_names", "|").alias("blocking_methods"))


def new_over(base: DataFrame, more: DataFrame) -> DataFrame:
    return more.join(base.select(*PAIR), PAIR, "left_anti")


def final_candidates(base: DataFrame, expansion: DataFrame) -> DataFrame:
    """Base pairs and the expansion's new ones, with a derived method count where it is missing."""
    out = base.unionByName(new_over(base, expansion).select(*base.columns))
    derived = F.size(F.split("blocking_methods", r"\|")).cast("tinyint")
    return out.withColumn("num_blocking_methods", F.coalesce("num_blocking_methods", derived))


def check_candidates(candidates: DataFrame, records: DataFrame) -> DataFrame:
    """One row of counts: rows, duplicates, null keys, unknown sources, missing records on both sides."""
    agg = candidates.agg(F.count(F.lit(1)).alias("rows"), (F.count(F.lit(1)) - F.countDistinct(*[F.coalesce(c, F.lit("")) for c in PAIR])).alias("duplicates"), F.count_if(F.col(PAIR[0]).isNull() | F.col(PAIR[1]).isNull()).alias("null_keys"), F.count_if(~F.coalesce(F.col("matched_source").isin("S2", "S3"), F.lit(False))).alias("bad_source"))
    one = records.where("source = 'S1'").select(F.col("entity_id").alias("source1_entity_id"))
    two = records.where("source <> 'S1'").select(F.col("entity_id").alias("matched_entity_id"), F.col("source").alias("matched_source"))
    lost1 = candidates.join(one, "source1_entity_id", "left_anti").agg(F.count(F.lit(1)).alias("missing_source1"))
    lost2 = candidates.join(two, ["matched_entity_id", "matched_source"], "left_anti").agg(F.count(F.lit(1)).alias("missing_target"))
    key = F.lit(1).alias("_one")
    return agg.select("*", key).join(lost1.select("*", key), "_one").join(lost2.select("*", key), "_one").drop("_one")

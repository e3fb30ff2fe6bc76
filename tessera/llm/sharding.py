"""Sharding by a two-pass external shuffle.

Method.  Pass one scatters the records by a seeded hash into buckets of bounded size and writes them
to the shared checkpoint folder.  Pass two reads every bucket alone, in order of the hash, and
permutes it by an inside-out Fisher-Yates whose draws are hashes of seed, bucket and step, so that a
record's place depends on neither partitions nor their number.  Bucket sizes, summed in two levels,
give each record its place in the whole order, which is cut into shards of equal counts (law `rows`:
at most one apart); the slot is the place in the shard, from 0.

Cases.  Null text counts as empty, a null id as a value like others.  Rows that repeat id and text
are scattered apart by the row's number within its input partition.  Fewer rows than shards leave
the last shards empty.  An empty table gives no rows.  Other columns travel along unchanged;
columns named shard or slot are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

SEED = 20240607


def _permutation(bucket: Column, size: Column, seed: int) -> Column:
    """0 to size - 1 in random order: step i puts i at a place drawn from 0 to i, and what stood there at the end."""

    def step(a: Column, i: Column) -> Column:
        j = F.pmod(F.xxhash64(F.lit(seed), bucket, i), i + 1).cast("int")
        moved = F.concat(F.slice(a, F.lit(1), j), F.array(i), F.slice(a, j + 2, F.greatest(i - j - 1, F.lit(0))), F.array(F.get(a, j)))
        return F.when(j == i, F.concat(a, F.array(i))).otherwise(moved)

    return F.aggregate(F.sequence(F.lit(0), size - 1), F.array().cast("array<int>"), step)


def shuffled(docs: DataFrame, n_shards: int, bucket_rows: int = 2048, bucket_bytes: int = 8 << 20, seed: int = SEED) -> DataFrame:
    """docs with shard (int) and slot (long), in a uniformly random order fixed by the seed and the input's files."""
    cols = [c for c in docs.columns if c not in ("shard", "slot")]
    texts = [c for c, t in docs.dtypes if t in ("string", "binary") and c in cols]
    weight = sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in texts), F.lit(32)).cast("long")
    total, size = docs.agg(F.count(F.lit(1)), F.sum(weight)).first()
    buckets = max(1, -(-total // bucket_rows), -(-(size or 0) // bucket_bytes))
    # Scatter: the row's number in its input partition keeps equal rows apart.
    # Its hash mixes with those of the shortest columns only, so that no text is hashed for it.
    brief = [c for c in cols if c not in texts] or cols
    rows = docs.select(F.struct(*cols).alias("rec"), F.xxhash64(F.lit(seed), F.monotonically_increasing_id(), *brief).alias("h"))
    rows = rows.withColumn("bucket", F.pmod("h", F.lit(buckets)))
    deal = max(1, min(buckets, max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-buckets // 64))))
    scattered = common.cut(rows.repartition(deal, "bucket"))
    met = scattered.groupBy("bucket").agg(F.array_sort(F.collect_list(F.struct("h", "rec")), lambda a, b: F.when(a["h"] < b["h"], -1).when(a["h"] > b["h"], 1).otherwise(0)).alias("recs"))
    met = met.select("bucket", "recs", _permutation(F.col("bucket"), F.size("recs"), seed).alias("order"))
    counts = scattered.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    starts = common.cut(common.prefix_sums(counts, "bucket", "n", "start").select(F.col("bucket").alias("b"), "start"))
    placed = met.join(common.hinted(starts, buckets), F.col("bucket") == F.col("b")).select("start", F.posexplode(F.arrays_zip("recs", "order")).alias("k", "x")).select("start", F.col("x.order").alias("i"), F.col("x.recs").alias("r"))
    q, r = divmod(total, n_shards)
    at = F.col("start") + F.col("i")
    edge = r * (q + 1)
    placed = placed.select(F.col("r.rec").alias("rec"), at.alias("at"))
    wide = F.floor(F.col("at") / (q + 1))
    shard = F.when(F.col("at") < edge, wide).otherwise(F.lit(r) + F.floor((F.col("at") - edge) / max(q, 1))).cast("int")
    slot = F.when(F.col("at") < edge, F.col("at") % (q + 1)).otherwise((F.col("at") - edge) % max(q, 1)).cast("long")
    return placed.select("rec.*", shard.alias("shard"), slot.alias("slot"))


def op4_shard(spark, sf_dir: str) -> DataFrame:
    out = shuffled(common.read(spark, sf_dir, "documents"), 24)
    text = F.coalesce("text", F.lit(""))
    return out.select("doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))

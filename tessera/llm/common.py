"""Pieces shared by the text operators: tokens, row identity, ranks, components."""

from __future__ import annotations

import ctypes
import gc
import re
import tempfile

import numpy as np
import pyarrow as pa
from pandas.util import hash_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WORD = "[^\\x20\\x09-\\x0D]+"
#: Largest table that is sent whole to every executor, in rows of at most about 100 bytes.
SMALL_ROWS = 20_000
#: Rows of a small table (ids, keys, node names) that one task reads.
ROWS_A_TASK = 20_000
#: Bytes of rows that go to a Python worker at once, unless the session names another size.
BATCH_BYTES = 4 << 20
#: Bits of a sieve of keys: 2**19 words of 64 bits at most, about 16 MB, whatever the input.
SIEVE_BITS = 25


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def hashes(values: list[bytes]) -> np.ndarray:
    """64-bit names, the same in every process."""
    out = np.empty(len(values), object)
    out[:] = values
    return hash_array(out, categorize=False)


def set_checkpoint_dir(spark: SparkSession) -> None:
    """Use the cluster's shared folder; one of our own only where none is named and all runs on this machine."""
    if spark.sparkContext.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir(named or tempfile.mkdtemp(prefix="checkpoints-"))


def cut(df: DataFrame) -> DataFrame:
    """The rows written to the shared checkpoint folder, and so safe from lost executors."""
    set_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def tasks_for(rows: int, a_task: int = ROWS_A_TASK) -> int:
    """Tasks that so many rows are worth, one at least."""
    return max(1, -(-rows // a_task))


def few(df: DataFrame, a_task: int = ROWS_A_TASK) -> DataFrame:
    """cut(), read again by no more tasks than its counted rows are worth.

    A task writes files for every exchange after it, however few its rows are, and they stay on disk until
    the driver collects garbage: with small tables these files, not the rows, are what fills a disk.
    """
    done = cut(df)
    return done.coalesce(tasks_for(done.count(), a_task))


def mapped(df: DataFrame, run, schema: str) -> DataFrame:
    """df.mapInArrow(run, schema) in batches of BATCH_BYTES.

    Spark's own limit is 64 MB, and an executor holds a batch several times for each task: as it is written, as it
    is sent and, on both sides, as it comes back.  That memory is outside the heap and is not all given back.
    """
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    if conf.get(name, None) is None:
        conf.set(name, str(BATCH_BYTES))
    return df.mapInArrow(run, schema)


def give_back() -> None:
    """Return memory that this process has freed to the system, where the C library can (glibc keeps it otherwise)."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def lower(text: Column) -> Column:
    """Lower-case A-Z alone; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, UPPER.lower())


def words(text: Column) -> Column:
    return F.regexp_extract_all(lower(text), F.lit(WORD), F.lit(0))


def n_words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def let(value: Column, use) -> Column:
    """use(value) with value computed once a row, also where use names it inside lambdas."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def shingle_hashes(tokens: Column, n: int) -> Column:
    """Distinct 64-bit hashes of the n-word runs; fewer words make one run; none, no run."""

    def runs(t: Column) -> Column:
        each = F.transform(F.sequence(F.lit(1), F.greatest(F.size(t) - (n - 1), F.lit(1))), lambda i: F.xxhash64(F.slice(t, i, F.lit(n))))
        return F.when(F.size(t) == 0, F.array().cast("array<bigint>")).otherwise(F.array_distinct(each))

    return let(tokens, runs)


def doc_key(*cols: str) -> Column:
    """16 bytes that name the values of the columns (null apart from empty); equal rows, equal keys."""
    parts = [F.coalesce(F.sha2(F.col(c).cast("string"), 256), F.lit("-")) for c in cols]
    return F.substring(F.unhex(F.sha2(F.concat_ws("|", *parts), 256)), 1, 16)


def hinted(df: DataFrame, rows: int) -> DataFrame:
    """df marked for broadcast only where its counted rows are few; else Spark joins by shuffle."""
    return F.broadcast(df) if rows <= SMALL_ROWS else df


def _sifted(rows: DataFrame, keys: DataFrame, by: list[str]) -> DataFrame:
    """rows with _may: false only where keys has no such key.

    The keys set bits of a table of fixed size, which is sent to all; it spares most other rows the
    shuffle of an exact join, and as it fills up it changes the speed alone.
    """
    at = F.shiftrightunsigned(F.xxhash64(F.lit(20240607), *by), 64 - SIEVE_BITS)
    word, bit = F.shiftright(at, 6), at.bitwiseAND(F.lit(63)).cast("int")
    words = keys.groupBy(word.alias("_word")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit)).alias("_bits"))
    hit = F.call_function("shiftrightunsigned", F.col("_bits"), bit).bitwiseAND(F.lit(1)) == 1
    return rows.join(F.broadcast(words), word == F.col("_word"), "left").withColumn("_may", F.coalesce(hit, F.lit(False))).drop("_word", "_bits")


def semi(rows: DataFrame, keys: DataFrame, by: list[str]) -> DataFrame:
    """The rows whose key keys (written, by alone) has; nulls equal nulls."""
    return _sifted(rows, keys, by).where("_may").drop("_may").join(*_same(keys, by), "left_semi")


def matched(rows: DataFrame, found: DataFrame, by: list[str]) -> DataFrame:
    """Inner join of rows with found (written, named apart but for by); nulls equal nulls."""
    some = _sifted(rows, found, by).where("_may").drop("_may")
    right = found.withColumnsRenamed({c: f"_k_{c}" for c in by})
    return some.join(right, [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in by]).drop(*[f"_k_{c}" for c in by])


def anti(rows: DataFrame, keys: DataFrame, by: list[str]) -> DataFrame:
    """The rows whose key keys (written, by alone) has not; nulls equal nulls."""
    some = _sifted(rows, keys, by)
    return some.where("not _may").drop("_may").unionByName(some.where("_may").drop("_may").join(*_same(keys, by), "left_anti"))


def _same(keys: DataFrame, by: list[str]) -> tuple[DataFrame, list[Column]]:
    return keys.select(*[F.col(c).alias(f"_k_{c}") for c in by]), [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in by]


def looked_up(rows: DataFrame, found: DataFrame, key: str, value: str) -> DataFrame:
    """rows with the value that found (key and value, written) has for their key, else null."""
    some = _sifted(rows, found, [key])
    none = F.lit(None).cast(found.schema[value].dataType)
    return some.where("not _may").drop("_may").withColumn(value, none).unionByName(some.where("_may").drop("_may").join(found.select(key, value), key, "left"))


def ranked(df: DataFrame, order: list[Column], name: str, kept: bool = True) -> tuple[DataFrame, int]:
    """df with a gapless long rank from 0 in the given order, and the number of rows.

    Range partitions are ordered on their own; only their sizes, one row each, meet in one task.
    """
    spark = df.sparkSession
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    ranged = cut(ranged)
    part = F.shiftright("_at", 33)
    sizes = ranged.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    found = sorted((r[0], r[1]) for r in sizes.collect())  # one row for each partition
    starts, total = [], 0
    for p, n in found:
        starts.append((p, total))
        total += n
    # From Arrow: rows in a list would go through Python workers, which stay in the executors' memory.
    table = F.broadcast(spark.createDataFrame(pa.table({"_part": pa.array([p for p, _ in starts], pa.int64()), "_start": pa.array([n for _, n in starts], pa.int64())})))
    out = ranged.withColumn("_part", part).join(table, "_part")
    return out.withColumn(name, F.col("_start") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))).drop("_at", "_part", "_start"), total


def prefix_sums(df: DataFrame, key: str, value: str, name: str, width: int = 1024) -> DataFrame:
    """df (unique long keys) with the sum of value over smaller keys, in two levels."""
    block = F.floor(F.col(key) / width).cast("long")
    df = df.withColumn("_block", block)
    tops = df.groupBy("_block").agg(F.sum(value).alias("_sum"))
    tops = tops.select("_block", (F.sum("_sum").over(Window.orderBy("_block")) - F.col("_sum")).alias("_before"))
    inner = F.sum(value).over(Window.partitionBy("_block").orderBy(key)) - F.col(value)
    return df.withColumn("_inner", inner).join(tops, "_block").withColumn(name, (F.col("_before") + F.col("_inner")).cast("long")).drop("_block", "_inner", "_before")


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) of the connected components of the edges; root is the smallest node.

    Alternating large-star and small-star: every step deals edges by node, counts of steps grow
    with the logarithm of the nodes.  Nodes without an edge do not occur.
    """
    lo, hi = F.least(a, b), F.greatest(a, b)
    now = cut(edges.where(F.col(a) != F.col(b)).select(lo.alias("p"), hi.alias("c")).distinct())
    tasks = tasks_for(now.count())  # steps never add edges
    now, before = now.coalesce(tasks), None
    while True:
        both = now.select(F.col("p").alias("n"), F.col("c").alias("m")).unionByName(now.select(F.col("c").alias("n"), F.col("p").alias("m"))).coalesce(tasks)
        # Written: the joins below then have a plain exchange on both sides, and a centre's edges can be split.
        least = cut(both.groupBy("n").agg(F.min("m").alias("q")).select("n", F.least("q", "n").alias("q")).coalesce(tasks))
        large = both.where("m > n").join(least, "n").select(F.col("q").alias("p"), F.col("m").alias("c")).where("p <> c").coalesce(tasks).distinct()
        large = cut(large.coalesce(tasks))
        small_min = large.groupBy("c").agg(F.min("p").alias("q"))
        small = large.join(small_min, "c").select(F.col("q").alias("x"), "p", "c")
        now = small.select(F.col("x").alias("p"), "c").unionByName(small.where("p <> x").select(F.col("x").alias("p"), F.col("p").alias("c"))).coalesce(tasks).distinct()
        now = cut(now.coalesce(tasks))
        # Stars alone are left when no child is a parent, and the edges no longer change.
        stamp = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("p", "c")), F.sum(F.xxhash64("p", "c").bitwiseAND(F.lit(0xFFFFFFFF)))).first()
        if stamp == before:
            break
        before = stamp
    return now.select(F.col("c").alias("node"), F.col("p").alias("root")).unionByName(now.select(F.col("p").alias("node"), F.col("p").alias("root")).distinct()).coalesce(tasks)

"""Pairs that are made with both records' columns.

A block writes pairs of ids, which then meet the records again, so that every pair drags its texts through two shuffles.  Here records
meet in their block with their columns, and no pair is shuffled.  A key that many records share is dealt over cells of CELL pairs, a
grid over both sides, so its rows repeat by the side of the grid alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators import blocking
from tessera.operators import records as rec
from tessera.sources.io import PAIR

#: Pairs of a cell; a key with more of them is dealt over several.
CELL = 500_000


def _sides(records: DataFrame, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    one = records.where("source = 'S1'").select(F.col("entity_id").alias("source1_entity_id"), *[F.col(c).alias(f"a_{c}") for c in columns])
    two = records.where("source <> 'S1'").select(F.col("entity_id").alias("matched_entity_id"), F.col("source").alias("matched_source"), *[F.col(c).alias(f"b_{c}") for c in columns])
    return one, two


def dealt(rows: DataFrame, by: list[str], cell: int | None = None, spread: str = "entity_id") -> DataFrame:
    """rows (source, entity_id, by) with the _cell in which two of them meet: a crowded key has several, and its rows repeat by the cells
    of the other side.  Rows of one side that are equal in `spread` stay together."""
    cell = cell or CELL
    per = rows.groupBy(*by).agg(F.count_if(F.col("source") == "S1").alias("_n"), F.count_if(F.col("source") != "S1").alias("_m"))
    # At most one key in rec.FEW rows of the table is sent to all tasks, however large it is.
    total = per.agg(F.sum(F.col("_n") + F.col("_m")).alias("_total"))
    crowds = per.where(F.col("_n") * F.col("_m") > cell).join(F.broadcast(total), how="cross").where((F.col("_n") + F.col("_m")) * rec.FEW > F.col("_total"))
    side = lambda n, m: F.greatest(F.lit(1), F.ceil(F.sqrt(F.col("_n") * F.col("_m") / cell) * F.sqrt(F.col(n) / F.col(m)))).cast("int")
    rows = rows.join(F.broadcast(crowds.select(*by, side("_n", "_m").alias("_p"), side("_m", "_n").alias("_q"))), by, "left")
    p, q = F.coalesce("_p", F.lit(1)), F.coalesce("_q", F.lit(1))
    first = F.col("source") == "S1"
    at = F.pmod(F.xxhash64(spread), F.when(first, p).otherwise(q)).cast("int")
    cells = F.when(first, F.transform(F.sequence(F.lit(0), q - 1), lambda j: at * q + j)).otherwise(F.transform(F.sequence(F.lit(0), p - 1), lambda i: i * q + at))
    return rows.withColumn("_cell", F.explode(cells)).drop("_p", "_q")


def meet(records: DataFrame, keys: list[tuple[str, str]], columns: list[str]) -> DataFrame:
    """Pairs of records that agree on country and on a key, neither empty, with the columns of both as a_ and b_; a pair once for each
    key, whose place among the keys is _kind."""
    columns = list(dict.fromkeys([*columns, "country_norm"]))
    listed = F.explode(F.array(*[F.struct(F.lit(i).alias("kind"), F.col(c).alias("key")) for i, (_, c) in enumerate(keys)])).alias("_k")
    rows = records.where("country_norm <> ''").select("source", "entity_id", *columns, listed).where(F.col("_k.key") != "").select("*", F.col("_k.kind").alias("_kind"), F.col("_k.key").alias("_key")).drop("_k")
    by = ["country_norm", "_kind", "_key"]
    rows = dealt(rows, by)
    one, two = _sides(rows, [*columns, "_kind", "_key", "_cell"])
    on = [F.col(f"a_{c}") == F.col(f"b_{c}") for c in (*by, "_cell")]
    return one.join(two.hint("merge"), on).withColumn("_kind", F.col("a__kind"))


def unique_ids(records: DataFrame) -> bool:
    """Whether no id stands in two rows of a source."""
    return records.groupBy("source", "entity_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty()


def exact(records: DataFrame, key: str, name: str, columns: list[str]) -> DataFrame:
    """blocking.exact() with columns of both records as a_ and b_.  Where ids repeat, pairs meet their records by id, all of that id."""
    if unique_ids(records):
        return meet(records, [(name, key)], columns)
    one, two = _sides(records, columns)
    return blocking.exact(records, key, name).select(*PAIR).join(one, "source1_entity_id").join(two, ["matched_entity_id", "matched_source"])

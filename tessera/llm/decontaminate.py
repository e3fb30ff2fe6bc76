"""Benchmark decontamination by size-partitioned MinHash containment search.

Method.  Items and documents are sets of hashes of distinct n-word shingles.  Items are parted by
size (powers of two).  For each part a bottom-k MinHash sketch is kept of every item, with k the
smallest number of minima that a document holding the asked share of the item cannot miss
altogether: floor((1 - share) * size) + 1 at the part's largest size.  Documents are searched part
by part, in one pass: a part's documents have as many shingles as its smallest item asks for, and a
shingle is looked up only if its order is not above the part's largest minimum.  A document is a
candidate for an item if it holds one of the sketch's minima; candidates are confirmed by exact
containment, shared shingles over the item's shingles, on whole texts.

Scale.  The path is the same for a benchmark of any size: a sieve of fixed size passes by the
shingles that are surely no minimum, the rest meets the minima in a shuffle join.  The minima, the
pairs and the sketches are written tables, so a frequent shingle, item or document makes a skewed
partition of a plain join, which can be split.

Cases.  Null or empty texts have no shingles and match nothing, items as well as documents; an item
of fewer than n words is one shingle, which only an equally short document can hold.  Rows that
repeat an id and text give the same pair once; rows of one id with different texts are counted
apart and the largest share is reported.  A null id is reported as a null id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common


def _seeded(h: F.Column) -> F.Column:
    return F.xxhash64(h, F.lit(20240607))


def sketches(items: DataFrame, n: int, share_pct: int) -> DataFrame:
    """(item, size, part, minima, shingles) of the items (item, text) with words."""
    sets = items.select("item", common.shingle_hashes(common.words(F.col("text")), n).alias("shingles")).where(F.size("shingles") > 0)
    size = F.size("shingles")
    part = F.floor(F.log2(size)).cast("int")
    largest = F.pow(F.lit(2.0), part + 1).cast("long") - 1  # of the part
    k = F.floor(largest * (100 - share_pct) / 100).cast("int") + 1
    ordered = F.array_sort(F.transform("shingles", lambda h: F.struct(_seeded(h).alias("o"), h.alias("h"))))
    return sets.select("item", size.cast("long").alias("size"), part.alias("part"), F.transform(F.slice(ordered, F.lit(1), F.least(k, size)), lambda s: s["h"]).alias("minima"), "shingles")


def contained(docs: DataFrame, items: DataFrame, n: int = 5, share_pct: int = 80, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id") -> DataFrame:
    """Pairs (doc_id, item_id, shared, item_size, containment) with 100 * shared >= share_pct * item_size."""
    items = items.select(F.col(item_col).alias("item"), F.col(text_col).alias("text")).distinct()
    index = common.cut(sketches(items, n, share_pct))
    # One row a part, and parts are powers of two: its smallest size and its largest minimum in the common order.
    parts = index.groupBy("part").agg(F.min("size").alias("least"), F.max(_seeded(F.element_at("minima", -1))).alias("last")).collect()
    posting = common.cut(index.select("item", F.explode("minima").alias("h")))
    in_some_part = F.lit(False)
    for p in parts:
        in_some_part = in_some_part | ((F.size("set") * 100 >= p["least"] * share_pct) & (F.col("o") <= p["last"]))
    key = F.xxhash64(F.col(text_col)).alias("key")
    sets = docs.select(F.col(id_col).alias("doc"), key, common.shingle_hashes(common.words(F.col(text_col)), n).alias("set"))
    looked_up = sets.select("doc", "key", "set", F.explode("set").alias("h")).withColumn("o", _seeded(F.col("h"))).where(in_some_part).select("doc", "key", "h")
    pairs = common.cut(common.matched(looked_up, posting, ["h"]).select("doc", "key", "item").distinct())
    # A null item id still is an item, and so is a null document id.
    full = index.select(F.col("item").alias("i"), "size", "shingles")
    wanted = common.cut(pairs.join(full, F.col("item").eqNullSafe(F.col("i"))).drop("i"))
    texts = docs.select(F.col(id_col).alias("doc"), key, F.col(text_col).alias("text"))
    out = common.matched(texts, wanted, ["doc", "key"]).withColumn("set", common.shingle_hashes(common.words(F.col("text")), n))
    out = out.withColumn("shared", F.size(F.array_intersect("set", "shingles")).cast("long")).where(F.col("shared") * 100 >= F.col("size") * share_pct)
    out = out.groupBy(F.col("doc").alias("doc_id"), F.col("item").alias("item_id")).agg(F.max(F.struct((F.col("shared") / F.col("size")).alias("c"), "shared", "size")).alias("m"))
    return out.select("doc_id", "item_id", F.col("m.shared").alias("shared"), F.col("m.size").alias("item_size"), F.round("m.c", 6).alias("containment"))


def without_leaks(docs: DataFrame, items: DataFrame, n: int = 5, share_pct: int = 80) -> DataFrame:
    """docs without the documents that hold an item."""
    keyed = docs.select(common.doc_key("doc_id", "text").alias("key"), "text")
    hit = common.cut(contained(keyed, items, n, share_pct, id_col="key").select(F.col("doc_id").alias("key")).distinct())
    rows = docs.select(F.struct(*docs.columns).alias("row"), common.doc_key("doc_id", "text").alias("key"))
    return common.anti(rows, hit, ["key"]).select("row.*")


def op3_decontaminate(spark, sf_dir: str) -> DataFrame:
    return contained(common.read(spark, sf_dir, "documents"), common.read(spark, sf_dir, "benchmark"))


_W = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+')"
_S = "SELECT DISTINCT id, CASE WHEN len(ws) < 5 THEN array_to_string(ws, ' ') ELSE array_to_string(ws[i:i + 4], ' ') END AS sh FROM {t}, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS t(i) WHERE len(ws) > 0"
ORACLE_SQL = f"""
WITH d AS (SELECT doc_id AS id, {_W} AS ws FROM documents), b AS (SELECT item_id AS id, {_W} AS ws FROM benchmark),
ds AS ({_S.format(t="d")}), bs AS ({_S.format(t="b")}),
n AS (SELECT id, count(*) AS n FROM bs GROUP BY id),
p AS (SELECT ds.id AS doc_id, bs.id AS item_id, count(*) AS shared FROM ds JOIN bs USING (sh) GROUP BY 1, 2)
SELECT doc_id, item_id, shared::BIGINT AS shared, n::BIGINT AS item_size, round(shared / n, 6) AS containment
FROM p JOIN n ON n.id = p.item_id WHERE shared * 100 >= n * 80
"""

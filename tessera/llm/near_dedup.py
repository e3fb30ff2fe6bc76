"""Near-duplicate groups by b-bit MinHash.

Method.  A document's set holds the hashes of its distinct n-word shingles.  128 minima are taken
over it; bands of them propose candidates, their low 4 bits, packed as bit planes, estimate the
similarity with the collision correction (P - 1/16) / (15/16), and pairs that the estimate cannot
rule out (it is more than six standard errors below the threshold otherwise) are confirmed on the
full sets.  Texts with equal sets are one class before any pair is made.

A bucket's pairs are never written out.  First each class of a bucket is compared with the bucket's
most central class, the one that shares most buckets.  Where that leaves a bucket in several
components, its classes go through an exact search: in one order of all shingles, rare ones first,
two linked sets share a shingle among the first |x| - ceil(t |x|) + 1 of both, at places that leave
room for the asked overlap.  Only classes outside the largest component that holds a shingle are
joined there, with classes of other components, so no link between two components is left untried
and copies edited in many ways make few pairs.  The order needs shingle counts; they are kept in a
table of fixed size, which changes the speed alone.

Cases.  Null or empty text, or text without words: empty set, linked with nothing, kept.  A row is
named by its id and text, so rows that repeat an id with other texts are documents of their own, and
rows that repeat both are one document.  Null ids come after all others; a component of null ids
alone has a null component id.  Other columns are ignored, and kept by keep_one().
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

K, ROWS, BITS = 128, 4, 4
BANDS = K // ROWS
_rng = np.random.RandomState(20240607)
MULT = (_rng.randint(0, 2**62, size=K, dtype=np.int64).astype(np.uint64) << np.uint64(1)) | np.uint64(1)
ADD = _rng.randint(0, 2**62, size=K, dtype=np.int64).astype(np.uint64)
_P1, _P2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x = x * _P2
    return x ^ (x >> np.uint64(29))


def shingle_set(text: str | None, n: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the n-word runs of the lower-cased text."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII space alone
    if not found:
        return np.empty(0, np.uint64)
    w = common.hashes(found)
    if len(w) < n:
        return common.hashes([w.tobytes()])
    h = np.zeros(len(w) - n + 1, np.uint64)
    for i in range(n):
        h = mixed(h * _P1 + w[i : len(w) - n + 1 + i])
    return np.unique(h)


def set_name(h: np.ndarray) -> bytes:
    """128 bits that name a set."""
    return hashlib.blake2b(h.tobytes(), digest_size=16).digest()


def minima(h: np.ndarray) -> np.ndarray:
    """The least value of each of K hash functions over the set, block by block."""
    low = np.full(K, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(h), 512):
        low = np.minimum(low, (h[i : i + 512, None] * MULT + ADD).min(axis=0))
    return low


def planes(low: np.ndarray) -> np.ndarray:
    """Low BITS bits of the minima as BITS planes of two longs each."""
    x = mixed(low)
    rows = [np.packbits(((x >> np.uint64(b)) & np.uint64(1)).astype(np.uint8)) for b in range(BITS)]
    return np.concatenate(rows).view(np.int64)


def band_keys(low: np.ndarray) -> np.ndarray:
    x = low.reshape(BANDS, ROWS)
    h = np.arange(1, BANDS + 1, dtype=np.uint64)
    for j in range(ROWS):
        h = mixed(h * _P1 + x[:, j])
    return h.view(np.int64)


def _lists(rows: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
    values = np.concatenate(rows) if rows else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(np.int64, copy=False), kind))


_SIG = "doc_id long, key binary, n_shingles long, node binary, bands array<bigint>, planes array<bigint>"


def signatures(docs: DataFrame, n: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: id, set size, node (128-bit name of its set, null if empty), band keys, planes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, nodes, bands, packed, none = [], [], [], [], np.empty(0, np.int64)
            for text in batch.column(2):
                h = shingle_set(text.as_py(), n)
                sizes.append(len(h))
                if len(h):
                    low = minima(h)
                    nodes.append(set_name(h))
                    bands.append(band_keys(low))
                    packed.append(planes(low))
                else:
                    nodes.append(None)
                    bands.append(none)
                    packed.append(none)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(nodes, pa.binary()), _lists(bands, pa.int64()), _lists(packed, pa.int64())], names=["doc_id", "key", "n_shingles", "node", "bands", "planes"])

    return common.mapped(docs.select(F.col(id_col).cast("long").alias("doc_id"), common.doc_key(id_col, text_col).alias("key"), F.col(text_col).alias("text")), run, _SIG)


def _sets(docs: DataFrame, n: int, wanted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(node, shingles) of the documents in wanted (key), each node once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t.as_py(), n) for t in batch.column(0)]
            for i in range(0, len(sets), 256):
                part = sets[i : i + 256]
                yield pa.RecordBatch.from_arrays([pa.array([set_name(h) if len(h) else None for h in part], pa.binary()), _lists([h.view(np.int64) for h in part], pa.int64())], names=["node", "shingles"])

    texts = docs.select(common.doc_key(id_col, text_col).alias("key"), F.col(text_col).alias("text"))
    texts = common.semi(texts, wanted, ["key"]).select("text")
    return common.mapped(texts, run, "node binary, shingles array<bigint>").where("node is not null").dropDuplicates(["node"])


def _estimate(a: str, b: str) -> F.Column:
    """Corrected similarity from equal positions in all planes."""
    equal = F.lit(0)
    for half in range(2):
        differ = F.lit(0).cast("long")
        for bit in range(BITS):
            i = bit * 2 + half
            differ = differ.bitwiseOR(F.get(a, F.lit(i)).bitwiseXOR(F.get(b, F.lit(i))))
        equal = equal + (64 - F.bit_count(differ))
    chance = 1 / 2**BITS
    return (equal / K - chance) / (1 - chance)


def linked(docs: DataFrame, pairs: DataFrame, reps: DataFrame, n: int, num: int, den: int, id_col: str, text_col: str) -> DataFrame:
    """The pairs (a, b) of nodes whose full sets have den * shared >= num * union."""
    least = num / den
    cutoff = least - 6 * math.sqrt(max(least * (1 - least), 0.05) / K) / (1 - 1 / 2**BITS)
    brief = reps.select("node", "n_shingles", "planes")
    x = brief.toDF("a", "na", "pa")
    y = brief.toDF("b", "nb", "pb")
    pairs = pairs.join(x, "a").join(y, "b").where((F.greatest("na", "nb") * num <= F.least("na", "nb") * den) & (_estimate("pa", "pb") >= cutoff)).select("a", "b", "na", "nb")
    pairs = common.few(pairs)
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    wanted = common.few(reps.join(nodes, "node", "left_semi").select("lead.key"))
    if wanted.isEmpty():
        return pairs.select("a", "b")
    sets = _sets(docs, n, wanted, id_col, text_col)
    both = pairs.join(sets.toDF("b", "sb"), "b").join(sets.toDF("a", "sa"), "a")
    shared = F.size(F.array_intersect("sa", "sb")).cast("long")
    return common.few(both.where(shared * den >= (F.col("na") + F.col("nb") - shared) * num).select("a", "b"))


ORDER_BITS = 18
#: Shingle sets that one task reads.
SETS_A_TASK = 1_000


def _prefixes(sets: DataFrame, num: int, den: int) -> DataFrame:
    """(key, node, at, n): the first shingles of every set in the common order."""
    slot = F.shiftrightunsigned("s", 64 - ORDER_BITS).cast("int")
    counts = sets.select(F.explode("shingles").alias("s")).groupBy(slot.alias("slot")).agg(F.count(F.lit(1)).alias("c"))
    table = np.zeros(1 << ORDER_BITS, np.int64)
    for part in counts.coalesce(common.tasks_for(1 << ORDER_BITS, 1 << 15)).toLocalIterator():  # 2**ORDER_BITS rows at most
        table[part["slot"]] = part["c"]
    sent = sets.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, keys, at, sizes = [], [], [], []
            for node, got in zip(batch.column(0).to_pylist(), batch.column(1)):
                h = got.values.to_numpy(zero_copy_only=False)
                often = sent.value[(h.view(np.uint64) >> np.uint64(64 - ORDER_BITS)).astype(np.int64)]
                first = h[np.lexsort((h, often))][: len(h) + (-len(h) * num // den) + 1]
                nodes += [node] * len(first)
                keys.append(first)
                at.append(np.arange(len(first)))
                sizes.append(np.full(len(first), len(h)))
            join = lambda x: pa.array(np.concatenate(x) if x else np.empty(0, np.int64), pa.int64())
            yield pa.RecordBatch.from_arrays([join(keys), pa.array(nodes, pa.binary()), join(at), join(sizes)], names=["key", "node", "at", "n"])

    return common.mapped(sets.select("node", "shingles"), run, "key long, node binary, at long, n long")


def _across(places: DataFrame, top: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Places (key, node, root, ...) outside their key's largest component, and all places of such keys."""
    left = places.join(top, "key")
    return left.where("root <> top"), left


def _split_keys(places: DataFrame) -> DataFrame:
    """(key, top): keys whose nodes lie in several components, and the component of most of them."""
    per = places.groupBy("key", "root").agg(F.count(F.lit(1)).alias("c"))
    return per.groupBy("key").agg(F.max(F.struct("c", "root")).alias("m"), F.count(F.lit(1)).alias("parts")).where("parts > 1").select("key", F.col("m.root").alias("top"))


def near_duplicates(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a row of docs: doc_id, key, n_shingles, node, component_id, kept, stays.

    kept is doc_id = component_id; stays marks the one document (key) of each group that is left.

    Sets of n-word shingles are linked at den * shared >= num * union; num / den should be 0.8 or
    more for the bands to miss fewer than one link in ten million.
    """
    sig = common.cut(signatures(docs, n, id_col, text_col))
    reps = common.few(sig.where("node is not null").groupBy("node").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")).alias("lead"), F.first("n_shingles").alias("n_shingles"), F.first("bands").alias("bands"), F.first("planes").alias("planes")))
    keys = reps.select("node", F.explode("bands").alias("key"))
    crowded = keys.groupBy("key").agg(F.count(F.lit(1)).alias("crowd")).where("crowd > 1")
    places = common.few(keys.join(crowded, "key"))  # only buckets of several classes
    central = places.groupBy("node").agg(F.sum("crowd").alias("pop"))
    centers = places.select("key", "node").join(central, "node").groupBy("key").agg(F.max(F.struct("pop", "node")).alias("m")).select("key", F.col("m.node").alias("a"))
    star = places.select("key", F.col("node").alias("b")).join(centers, "key").where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    star = common.few(star)
    first = linked(docs, star, reps, n, num, den, id_col, text_col)
    roots = common.few(common.components(first))
    rooted = lambda df: df.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    inside = rooted(places.select("key", "node"))
    unsure = common.few(inside.join(_split_keys(inside), "key", "left_semi").select("node").distinct())
    wanted = common.few(reps.join(unsure, "node", "left_semi").select("lead.key"))
    sets = common.few(_sets(docs, n, wanted, id_col, text_col), SETS_A_TASK)
    firsts = common.few(rooted(_prefixes(sets, num, den)))
    minor, every = _across(firsts, _split_keys(firsts))
    x = minor.select("key", "top", F.col("node").alias("x"), F.col("root").alias("rx"), F.col("at").alias("i"), F.col("n").alias("nx"))
    y = every.select("key", F.col("node").alias("y"), F.col("root").alias("ry"), F.col("at").alias("j"), F.col("n").alias("ny"))
    room = F.least(F.col("nx") - F.col("i"), F.col("ny") - F.col("j")) * (num + den) >= (F.col("nx") + F.col("ny")) * num
    rest = x.join(y, "key").where((F.col("rx") != F.col("ry")) & ((F.col("ry") == F.col("top")) | (F.col("x") < F.col("y"))) & room)
    rest = rest.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct().join(star, ["a", "b"], "left_anti")
    second = linked(docs, rest, reps, n, num, den, id_col, text_col)
    if not second.isEmpty():  # else the components stand as they are
        roots = common.few(common.components(roots.select(F.col("root").alias("a"), F.col("node").alias("b")).unionByName(second)))
    classes = reps.select("node", "lead").join(roots, "node", "left").select("node", "lead", F.coalesce("root", "node").alias("root"))
    classes = common.few(classes)
    leads = classes.groupBy("root").agg(F.min("lead").alias("first"))
    named = classes.join(leads, "root").select("node", "first")
    rows = sig.select("doc_id", "key", "n_shingles", "node")  # those without words need no partner and would all meet under one null
    out = rows.where("node is not null").join(common.few(named), "node")
    out = out.select("doc_id", "key", "n_shingles", "node", F.col("first.doc_id").alias("component_id"), (F.col("key") == F.col("first.key")).alias("stays"))
    out = out.unionByName(rows.where("node is null").select("*", F.col("doc_id").alias("component_id"), F.lit(True).alias("stays")))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("stays")))


def keep_one(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """docs with one row of each group: the one with the smallest id.  Rows without words all stay."""
    found = common.few(near_duplicates(docs, n, num, den).where("node is not null").groupBy("key").agg(F.bool_and("stays").alias("stays"), F.count(F.lit(1)).alias("rows")))
    gone, twice = found.where("not stays or rows > 1").select("key"), found.where("stays and rows > 1").select("key")
    rows = docs.select(F.struct(*docs.columns).alias("row"), common.doc_key("doc_id", "text").alias("key"))
    once = common.anti(rows, gone, ["key"]).select("row.*")
    if twice.isEmpty():
        return once
    return once.unionByName(common.semi(rows, twice, ["key"]).dropDuplicates(["key"]).select("row.*"))


def op6_near_dedup(spark, sf_dir: str) -> DataFrame:
    docs = common.read(spark, sf_dir, "documents").select("doc_id", "text")
    return near_duplicates(docs, 3, 85, 100).select("doc_id", "n_shingles", "component_id", "kept")


ORACLE_SQL = """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, CASE WHEN len(ws) < 3 THEN array_to_string(ws, ' ') ELSE ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] END AS sh
  FROM w, unnest(range(1, greatest(len(ws) - 2, 1) + 1)) AS t(i) WHERE len(ws) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM s x JOIN s y ON x.sh = y.sh AND x.doc_id < y.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 85 * (x.n + y.n - k)),
u AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r(doc_id, c) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, u.b FROM r JOIN u ON u.a = r.c)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, m.c AS component_id, d.doc_id = m.c AS kept
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id JOIN (SELECT doc_id, min(c) AS c FROM r GROUP BY 1) m ON m.doc_id = d.doc_id
"""

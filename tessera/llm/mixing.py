"""Mixing sources to target weights by pivotal dependent rounding.

Method.  A document of a source is to be taken target / source_size times: the whole part surely,
the fraction as a copy probability.  Probabilities are settled in pairs: mass in words is moved at
random from one document to the other until one probability is 0 or 1, so that every document keeps
its expectation and every pair its sum of words.  Documents meet in seeded groups of about FAN;
what stays fractional of a group goes on to the next level of the tree, until one document of a
source is left, which is settled alone.  So a source's taken words differ from its target by less
than its largest document.

Targets.  Sources by code point, null last, weigh 1, 2, 3, repeating; targets share all words, stop
at max_copies times the source's words, and the excess is shared again by weight.

Cases.  Null text, empty text and text without words have size 0: taken 0, no copy in the mix.
Rows that repeat id, source and text are one unit and get equal copies.  A source without words has
target 0.  An empty table gives no rows.  Other columns are ignored, and kept by mixed().
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

FAN = 32
SEED = 20240607


def _targets(units: DataFrame, max_copies: int, cycle: int) -> tuple[DataFrame, int]:
    """(source, source_size, target, ratio) by repeated sharing, and the number of sources; each round settles one source at least."""
    sources = units.groupBy("source").agg(F.sum(F.col("size") * F.col("rows")).alias("source_size"))
    order = [F.col("source").isNull().cast("int"), F.encode("source", "UTF-8")]
    sources, found = common.ranked(sources, order, "rank")
    sources = common.cut(sources.select("source", "source_size", (F.col("rank") % cycle + 1).cast("double").alias("weight")))
    cap = F.col("source_size") * max_copies
    whole = sources.agg(F.sum("source_size")).first()[0] or 0
    level = -1.0
    while True:
        # A source stops once weight * level is above its cap; the level only rises.
        full = F.col("weight") * level >= cap if level >= 0 else F.lit(False)
        held, free = sources.agg(F.sum(F.when(full, cap)), F.sum(F.when(~full, F.col("weight")))).first()
        rise = (whole - (held or 0)) / free if free else level
        if rise <= level or not free:
            break
        level = rise
    target = F.least(cap.cast("double"), F.col("weight") * F.lit(max(level, 0.0)))
    return sources.select("source", "source_size", target.alias("target")).withColumn("ratio", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))), found


_ITEM = "struct<id:binary,s:bigint,p:double>"


def _settle(group: F.Column, seed: int) -> F.Column:
    """Fold the pivot over an array of items: the item still fractional (or null), and those settled."""
    nobody = F.lit(None).cast(_ITEM)
    start = F.struct(nobody.alias("cur"), F.array().cast("array<struct<id:binary,up:boolean>>").alias("done"))

    def done(item, up):
        return F.array(F.struct(item["id"].alias("id"), up.alias("up")))

    def item(of, p):
        return F.struct(of["id"].alias("id"), of["s"].alias("s"), p.alias("p"))

    def step(acc, x):
        def move(c):
            # words that can move from x to c, and from c to x
            up = F.least(c["s"] * (1 - c["p"]), x["s"] * x["p"])
            down = F.least(c["s"] * c["p"], x["s"] * (1 - x["p"]))
            draw = F.shiftrightunsigned(F.xxhash64(F.lit(seed), c["id"], x["id"]), 11) * F.lit(2.0**-53)
            rise = draw * (up + down) < down
            c_first = F.when(rise, c["s"] * (1 - c["p"]) <= x["s"] * x["p"]).otherwise(c["s"] * c["p"] <= x["s"] * (1 - x["p"]))
            rest_x = F.when(rise, x["p"] - up / x["s"]).otherwise(x["p"] + down / x["s"])
            rest_c = F.when(rise, c["p"] + up / c["s"]).otherwise(c["p"] - down / c["s"])
            left = F.when(c_first, item(x, rest_x)).otherwise(item(c, rest_c))
            gone = F.when(c_first, done(c, rise)).otherwise(done(x, ~rise))
            return F.struct(left.alias("cur"), F.concat(acc["done"], gone).alias("done"))

        return F.when(acc["cur"].isNull(), F.struct(x.alias("cur"), acc["done"].alias("done"))).otherwise(move(acc["cur"]))

    return F.aggregate(group, start, step)


def _rounded(items: DataFrame) -> DataFrame:
    """(id, up) for items (source, id, s, p) with 0 < p < 1, through the tree of groups."""
    items = common.cut(items)
    out, level = [], 0
    sizes = common.cut(items.groupBy("source").agg(F.count(F.lit(1)).alias("n")))
    most, sources = sizes.agg(F.max("n"), F.count(F.lit(1))).first()
    most = most or 0
    while True:
        groups = F.ceil(F.col("n") / FAN)
        sizes = common.hinted(sizes, sources)  # one row a source: a source with most rows is not gathered for it
        dealt = items.join(sizes, items["source"].eqNullSafe(sizes["source"])).select(items["source"], "id", "s", "p", F.pmod(F.xxhash64(F.lit(SEED + level), "id"), groups).alias("g"))
        met = dealt.groupBy("source", "g").agg(F.array_sort(F.collect_list(F.struct("id", "s", "p"))).alias("items"))
        met = common.cut(met.select("source", _settle(F.col("items"), SEED + level).alias("r")))
        out.append(met.select(F.explode("r.done").alias("d")).select("d.id", "d.up"))
        if most <= 1:  # every source had one group
            out.append(met.where("r.cur is not null").select("r.cur.id", (F.shiftrightunsigned(F.xxhash64(F.lit(SEED - 1), "r.cur.id"), 11) * F.lit(2.0**-53) < F.col("r.cur.p")).alias("up")))
            break
        items = met.where("r.cur is not null").select("source", "r.cur.*")
        sizes = sizes.select("source", F.ceil(F.col("n") / FAN).alias("n"))
        most = -(-most // FAN)
    whole = out[0]
    for part in out[1:]:
        whole = whole.unionByName(part)
    return whole


def _units(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "source", common.n_words(F.col("text")).alias("size"), common.doc_key("doc_id", "source", "text").alias("id"))


def copies(docs: DataFrame, max_copies: int = 3, cycle: int = 3) -> DataFrame:
    """One row for each unit of doc_id, source and text: id (its digest), rows, size, source_size, target, copies."""
    units = _units(docs).groupBy("id").agg(F.first("doc_id").alias("doc_id"), F.first("source").alias("source"), F.first("size").alias("size"), F.count(F.lit(1)).alias("rows"))
    units = common.cut(units)
    targets, sources = _targets(units, max_copies, cycle)
    targets = common.hinted(common.cut(targets).withColumnRenamed("source", "src"), sources)
    named = units.join(targets, F.col("source").eqNullSafe(F.col("src"))).drop("src")
    part = F.col("ratio") - F.floor("ratio")
    items = named.where((F.col("size") > 0) & (part > 0)).select("source", "id", (F.col("size") * F.col("rows")).alias("s"), part.alias("p"))
    up = _rounded(items)
    out = named.join(up, "id", "left")
    count = F.floor("ratio").cast("long") + F.coalesce("up", F.lit(False)).cast("long")
    return out.select("id", "doc_id", "source", "rows", "size", "source_size", "target", F.when(F.col("size") > 0, count).otherwise(F.lit(0)).cast("long").alias("copies"))


def mixed(docs: DataFrame, max_copies: int = 3, cycle: int = 3) -> DataFrame:
    """The rows of docs, each as many times as the mix takes it."""
    taken = copies(docs, max_copies, cycle).where("copies > 0").select(F.col("id").alias("key"), "copies")
    rows = docs.select(F.struct(*docs.columns).alias("row"), common.doc_key("doc_id", "source", "text").alias("key")).join(taken, "key")
    return rows.select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("row.*")


def op1_mix_sources(spark, sf_dir: str) -> DataFrame:
    docs = common.read(spark, sf_dir, "documents").select("doc_id", "source", "text")
    out = copies(docs)
    out = out.withColumn("_row", F.explode(F.sequence(F.lit(1), F.col("rows").cast("int"))))
    return out.select("doc_id", "source", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies")

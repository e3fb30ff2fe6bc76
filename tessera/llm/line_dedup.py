"""Line dedup by winnowing over line hashes.

Method.  Lines with words are hashed.  From each line starts a window: the fewest consecutive lines
of min_words words together.  A window's fingerprint is its least line hash (the rightmost of equal
ones) with its position, so any two texts that share a run of a window's length share a fingerprint.
Fingerprints at two positions or more make their windows candidates.  A window also stands for each
longer run that it starts and that ends before the next line's window does (at the end of the text
if that has too few words): the last window inside a repeated run thus reaches the run's end, whatever
its lines' lengths, and a text has no more runs than lines and windows together.  Each run is joined
to the first place, by id and line, that holds the same lines, whichever text that is, so a run is
found where the first place of its window goes on otherwise.  All runs but those at first places are
deleted.  Every join meets a run with one first place only, so frequent lines make no pairs.

Cases.  Null text counts as empty.  Lines without words match nothing and are kept.  Texts of fewer
than min_words words in a repeated run are kept.  Rows that repeat id and text are one document and
get the same result; a text under another id is a later copy.  Null ids come last.  Lines are equal
if their characters are, apart from space at both ends.  Other columns pass unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common

MIN_WORDS = 50


def _lines(text: Column) -> Column:
    def one(lines: Column) -> Column:
        each = F.transform(lines, lambda l, i: F.struct(i.alias("line"), F.xxhash64(F.regexp_replace(l, "^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$", "")).alias("h"), common.n_words(l).alias("w")))
        return F.filter(each, lambda x: x["w"] > 0)

    return common.let(F.split(F.coalesce(text, F.lit("")), "\n", -1), one)


def repeated_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(key, removed): the ascending numbers, from 0, of the lines to delete from documents that have such."""
    rows = docs.select("doc_id", common.doc_key("doc_id", "text").alias("key"), _lines(F.col("text")).alias("lines")).dropDuplicates(["key"])
    rows = rows.select("doc_id", "key", F.posexplode("lines").alias("i", "l")).select("doc_id", "key", "i", "l.*")
    by_line = Window.partitionBy("key").orderBy("i")
    rows = rows.withColumn("before", F.sum("w").over(by_line) - F.col("w"))
    inside = Window.partitionBy("key").orderBy("before").rangeBetween(0, min_words - 1)
    least = F.min(F.struct(F.xxhash64(F.lit(20240607), "h").alias("o"), (-F.col("i")).alias("p"))).over(inside)
    wide = rows.select("doc_id", "key", F.struct("i", "line", "h", F.count(F.lit(1)).over(inside).cast("int").alias("n"), F.sum("w").over(inside).alias("words"), least.alias("f")).alias("l"))
    wide = wide.groupBy("doc_id", "key").agg(F.sort_array(F.collect_list("l")).alias("all"))

    def runs(x: Column) -> Column:
        end, after = x["i"] + x["n"], F.get("all", x["i"] + 1)
        last = F.when(after.isNull(), end).when(after["words"] >= min_words, F.greatest(after["i"] + after["n"] - 1, end)).otherwise(F.size("all"))

        def run(to: Column) -> Column:
            gone = F.when(to == end, F.transform(F.slice("all", x["i"] + 1, x["n"]), lambda m: m["line"])).otherwise(F.array(F.get("all", to - 1)["line"]))
            return F.struct(x["i"].alias("i"), x["f"].alias("f"), F.xxhash64(F.transform(F.slice("all", x["i"] + 1, to - x["i"]), lambda m: m["h"])).alias("gram"), gone.alias("at"))

        return F.transform(F.sequence(end, last), run)

    wide = wide.select("doc_id", "key", F.explode(F.flatten(F.transform(F.filter("all", lambda x: x["words"] >= min_words), runs))).alias("x"))
    wide = wide.select("doc_id", "key", "x.i", "x.gram", F.col("x.f.o").alias("mark"), F.struct(F.col("key"), F.col("x.f.p")).alias("spot"), "x.at")
    wide = common.cut(wide)
    # Written tables of unique keys on the right: a frequent mark or run then is a skewed partition of the left side alone, which can be split.
    shared = common.cut(wide.groupBy("mark").agg(F.min("spot").alias("a"), F.max("spot").alias("z")).where("a <> z").select("mark"))
    some = common.semi(wide, shared, ["mark"])
    order = F.struct(F.col("doc_id").isNull().alias("n"), F.col("doc_id").alias("d"), F.col("key").alias("k"), F.col("i").alias("i"))
    firsts = common.cut(some.groupBy("gram").agg(F.min(order).alias("o"), F.count(F.lit(1)).alias("times")).where("times > 1").select("gram", "o"))
    hits = some.join(firsts, "gram").where((F.col("key") != F.col("o.k")) | (F.col("i") != F.col("o.i")))
    gone = hits.select("key", F.explode("at").alias("line")).distinct()
    return gone.groupBy("key").agg(F.sort_array(F.collect_list("line")).alias("removed"))


def without_repeats(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """docs with the repeated runs cut from text, and the numbers of lines cut in removed."""
    gone = common.cut(repeated_lines(docs, min_words))
    names = [c for c in docs.columns if c != "removed"]
    rows = common.looked_up(docs.select(F.struct(*names).alias("row"), common.doc_key("doc_id", "text").alias("key")), gone, "key", "removed")
    kept = F.array_join(F.filter(F.split("row.text", "\n", -1), lambda l, i: ~F.array_contains("removed", i)), "\n")
    text = F.when(F.col("removed").isNull(), F.col("row.text")).otherwise(kept)
    return rows.select(*[text.alias("text") if c == "text" else F.col("row").getField(c).alias(c) for c in names], F.coalesce("removed", F.array().cast("array<int>")).alias("removed"))


def op10_line_dedup(spark, sf_dir: str) -> DataFrame:
    docs = common.read(spark, sf_dir, "documents").select("doc_id", "text")
    out = without_repeats(docs)
    return out.select("doc_id", F.size("removed").cast("long").alias("n_removed"), F.array_join(F.transform("removed", lambda x: x.cast("string")), ",").alias("removed"), F.md5(F.coalesce("text", F.lit(""))).alias("kept_md5"))


_WS = "[\\x20\\x09-\\x0D]"
ORACLE_SQL = f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, i - 1 AS line, regexp_replace(ls[i], '^{_WS}+|{_WS}+$', '', 'g') AS h, len(regexp_extract_all(ls[i], '[^\\x20\\x09-\\x0D]+')) AS w
      FROM t, unnest(range(1, len(ls) + 1)) AS u(i)),
b AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY line) AS i FROM l WHERE w > 0),
p AS (SELECT x.doc_id, x.line, x.w, x.i, y.doc_id AS other, y.i - x.i AS gap FROM b x JOIN b y ON x.h = y.h AND (y.doc_id < x.doc_id OR y.doc_id = x.doc_id AND y.i < x.i)),
q AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id, other, gap ORDER BY i) AS run FROM p),
z AS (SELECT *, sum(w) OVER (PARTITION BY doc_id, other, gap, run) AS words FROM q),
r AS (SELECT doc_id, list(DISTINCT line ORDER BY line) AS removed FROM z WHERE words >= 50 GROUP BY 1)
SELECT t.doc_id, coalesce(len(removed), 0)::BIGINT AS n_removed, coalesce(array_to_string(removed, ','), '') AS removed,
       md5(CASE WHEN removed IS NULL THEN text ELSE array_to_string(list_filter(ls, lambda s, i: NOT list_contains(removed, i - 1)), chr(10)) END) AS kept_md5
FROM t LEFT JOIN r ON r.doc_id = t.doc_id
"""

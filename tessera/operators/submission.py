"""Result lists and their validation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.sources import io


def result_lists(pairs: DataFrame, entities: DataFrame, column: str = "matched_entity_ids", by_source: bool = True) -> DataFrame:
    """One row for every source-1 record; ids by source and id, or by id alone; empty if none."""
    order = F.struct("matched_source", "matched_entity_id") if by_source else F.struct("matched_entity_id")
    lists = pairs.select("source1_entity_id", order.alias("o")).distinct().groupBy("source1_entity_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list("o")), lambda o: o["matched_entity_id"]), ",").alias("ids"))
    return entities.select("source1_entity_id").distinct().join(lists, "source1_entity_id", "left").select("source1_entity_id", F.coalesce("ids", F.lit("")).alias(column))


def _exploded(lists: DataFrame) -> DataFrame:
    column = lists.columns[1]
    return lists.select("source1_entity_id", F.explode(F.split(F.coalesce(column, F.lit("")), ",")).alias("id")).select("source1_entity_id", F.trim("id").alias("id")).where("id <> ''")


def _id_faults(known: Column | None) -> dict[str, Column]:
    """What an id can be objected to for, wherever it stands."""
    found = {"source-1 id": F.col("id").startswith("S1-"), "bad prefix": ~F.col("id").rlike("^S[123]-")}
    return found if known is None else found | {"unknown id": ~known}


def _knowing(ids: DataFrame, targets: DataFrame) -> DataFrame:
    return ids.join(targets.select(F.col("entity_id").alias("id"), F.lit(True).alias("_known")).distinct(), "id", "left")


def listable(records: DataFrame) -> bool:
    """Whether a list keeps every target id as one entry of its own: ids stand once, are not blank, and hold no comma or space around them."""
    odd = F.coalesce((F.col("entity_id") == "") | (F.col("entity_id") != F.trim("entity_id")) | F.col("entity_id").contains(","), F.lit(True))
    return records.where("source <> 'S1'").groupBy("entity_id").agg(F.count(F.lit(1)).alias("n")).where((F.col("n") > 1) | odd).isEmpty()


def marked(records: DataFrame, targets: DataFrame) -> DataFrame:
    """records with mark: a bit for each fault of their id as that of a target, in the order of validate()."""
    rows = _knowing(records.withColumn("id", F.col("entity_id")), targets)
    faults = _id_faults(F.col("_known").isNotNull())
    mark = sum((F.when(c, F.lit(1 << i)).otherwise(F.lit(0)) for i, c in enumerate(faults.values())), F.lit(0))
    return rows.withColumn("mark", mark).drop("id", "_known")


def with_pairs(checks: DataFrame, counts: DataFrame) -> DataFrame:
    """validate() of lists (with targets), and of pairs beside them that are only counted: (mark, candidates, matches) of crowd.Listed.

    Such pairs are distinct and in no list, every match is a candidate, and their ids are listable(): they add nothing to other checks.
    """
    bits = list(_id_faults(F.lit(True)))
    total = lambda k, i: F.coalesce(F.sum(F.when(F.col("mark").bitwiseAND(F.lit(1 << i)) != 0, F.col(k))), F.lit(0))
    sums = counts.agg(*[total(k, i).cast("long").alias(f"{k}: {name}") for k in ("matches", "candidates") for i, name in enumerate(bits)], F.coalesce(F.sum(F.greatest(F.col("matches") - F.col("candidates"), F.lit(0))), F.lit(0)).cast("long").alias("matches outside candidates"))
    more = sums.select(F.inline(F.array(*[F.struct(F.lit(c).alias("check"), F.col(f"`{c}`").alias("failures")) for c in sums.columns])))
    return checks.unionByName(more).groupBy("check").agg(F.sum("failures").alias("failures"))


def validate(matches: DataFrame, candidates: DataFrame, entities: DataFrame, targets: DataFrame | None = None) -> DataFrame:
    """(check, failures) of every rule: coverage, repeats, prefixes, unknown ids, matches outside candidates.

    Both lists are written once; one aggregation counts their records, another their ids.
    """
    kinds = {"matches": io.kept(matches), "candidates": io.kept(candidates)}
    n = lambda what, *cols: [F.lit(int(what == k)).alias(k) for k in cols]
    rows = [kinds[k].select("source1_entity_id", *n(k, "matches", "candidates", "wanted")) for k in kinds]
    rows.append(entities.select("source1_entity_id").distinct().select("*", *n("wanted", "matches", "candidates", "wanted")))
    by_record = reduce(DataFrame.unionByName, rows).groupBy("source1_entity_id").agg(*[F.sum(c).alias(c) for c in ("matches", "candidates", "wanted")])
    ids = reduce(DataFrame.unionByName, [_exploded(kinds[k]).select("source1_entity_id", "id", *n(k, "matches", "candidates")) for k in kinds])
    by_id = ids.groupBy("source1_entity_id", "id").agg(F.sum("matches").alias("matches"), F.sum("candidates").alias("candidates"))
    known = None
    if targets is not None:
        by_id, known = _knowing(by_id, targets), F.col("_known").isNotNull()
    total = lambda cond, value: F.coalesce(F.sum(F.when(cond, value)), F.lit(0)).cast("long")
    record_checks, id_checks = [], []
    for k in kinds:
        c = F.col(k)
        record_checks += [(f"{k}: repeated record", F.count_if(c > 1)), (f"{k}: missing record", F.count_if((c == 0) & (F.col("wanted") > 0))), (f"{k}: unknown record", total(F.col("wanted") == 0, c))]
        id_checks += [(f"{k}: repeated id", F.count_if(c > 1)), *[(f"{k}: {name}", total(fault, c)) for name, fault in _id_faults(known).items()]]
    id_checks.append(("matches outside candidates", F.count_if((F.col("matches") > 0) & (F.col("candidates") == 0))))

    def listed(df: DataFrame, checks: list) -> DataFrame:
        found = df.agg(*[e.alias(f"c{i}") for i, (_, e) in enumerate(checks)])
        return found.select(F.inline(F.array(*[F.struct(F.lit(name).alias("check"), F.col(f"c{i}").alias("failures")) for i, (name, _) in enumerate(checks)])))

    return listed(by_record, record_checks).unionByName(listed(by_id, id_checks))


def check_lines(lines: DataFrame, header: tuple[str, str], entities: DataFrame, targets: DataFrame | None = None) -> DataFrame:
    """(check, failures) of a result file's raw lines (value): what a reader of the finished TSV would object to.

    The header line is the one with both column names.  Lines without a tab that hold more than space are malformed;
    with targets (entity_id) ids that no target has are counted.
    """
    is_header = F.lower(F.col("value")) == "\t".join(header)
    cut = F.instr("value", "\t")
    rest = F.expr("substring(value, instr(value, '\t') + 1)")
    rows = lines.where(~is_header & (cut > 0)).select(F.expr("substring(value, 1, instr(value, '\t') - 1)").alias("s1"), F.when(F.trim(rest) == "", F.array().cast("array<string>")).otherwise(F.split(rest, ",")).alias("ids"))
    raw = lines.agg(F.count_if(is_header).alias("headers"), F.count_if(~is_header & (cut == 0) & (F.trim("value") != "")).alias("no_tab")).select((F.col("headers") != 1).cast("long").alias("headers"), "no_tab")
    wanted = entities.select(F.col("source1_entity_id").alias("s1")).distinct()
    records = rows.select("s1", F.lit(1).alias("r"), F.lit(0).alias("w"), (F.size("ids") != F.size(F.array_distinct("ids"))).cast("int").alias("d"), (F.size("ids") == 0).cast("int").alias("e"))
    records = records.unionByName(wanted.select("s1", F.lit(0).alias("r"), F.lit(1).alias("w"), F.lit(0).alias("d"), F.lit(0).alias("e"))).groupBy("s1").agg(*[F.sum(c).alias(c) for c in "rwde"])
    c = F.col
    by_record = records.agg(F.count_if(c("r") > 1).alias("repeated record"), F.count_if(c("d") > 0).alias("repeated id in a list"), F.count_if((c("r") == 0) & (c("w") > 0)).alias("missing record"), F.count_if(c("w") == 0).alias("unknown record"), F.coalesce(F.sum("e"), F.lit(0)).alias("empty lists"))
    ids = rows.select(F.explode("ids").alias("id")).distinct()
    tests = {"source-1 id": c("id").startswith("S1-"), "bad prefix": ~c("id").rlike("^S[123]-")}
    if targets is not None:
        ids = ids.join(targets.select(c("entity_id").alias("id"), F.lit(True).alias("_known")).distinct(), "id", "left")
        tests["unknown id"] = c("id").rlike("^S[23]-") & c("_known").isNull()
    by_id = ids.agg(*[F.count_if(t).alias(n) for n, t in tests.items()])

    def listed(df: DataFrame, names: dict[str, str]) -> DataFrame:
        return df.select(F.inline(F.array(*[F.struct(F.lit(n).alias("check"), c(k).cast("long").alias("failures")) for k, n in names.items()])))

    out = listed(raw, {"headers": "header", "no_tab": "no tab"}).unionByName(listed(by_record, {n: n for n in by_record.columns}))
    return out.unionByName(listed(by_id, {n: n for n in by_id.columns}))


def check_file(spark: SparkSession, path: str, header: tuple[str, str], entities: DataFrame, targets: DataFrame | None = None) -> DataFrame:
    """check_lines of a file, or of a folder of files that each have a header."""
    lines = spark.read.text(path)
    found = check_lines(lines, header, entities, targets)
    files = lines.select(F.input_file_name().alias("f")).distinct().count()
    headers = lines.where(F.lower(F.col("value")) == "\t".join(header)).count()
    return found.withColumn("failures", F.when(F.col("check") == "header", F.lit(int(headers != files))).otherwise(F.col("failures")))

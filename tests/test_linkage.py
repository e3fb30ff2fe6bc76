"""Record linkage operators on rows made for the purpose."""

import pytest
from pyspark.sql import functions as F
from tessera.functions import arrays, text
from tessera.operators import blocking, candidates, decision, labels, metrics, models, submission
from tessera.operators import records as rec
from tessera.operators.features import FEATURES, pair_features
from tessera.sources import io

REC = "entity_id string, source string, business_name string, business_address string, country string"


@pytest.fixture(scope="module")
def rows(spark):
    return rec.with_stripped(rec.normalise(spark.createDataFrame([
        ("S1-1", "S1", "Léo Café, Ltd.", "12 Main Street 90210 Springfield", "US"),
        ("S2-1", "S2", "leo cafe ltd", "12 Main St. 90210 Springfield", "U.S."),
        ("S3-1", "S3", "LÉO CAFÉ LTD", None, "us"),
        ("S1-2", "S1", "Acme 77777", "", "FR"),
        ("S2-2", "S2", "www.acme77777.com", "somewhere else entirely", "fr"),
        ("S1-3", "S1", None, None, None),
        ("S2-3", "S2", "", "", ""),
        ("S1-4", "S1", "moyna group coffee", "1 a", "India"),
        ("S3-4", "S3", "moyna ltd tea", "1 a", "India"),
    ], REC)))


def pairs(df):
    return {(r.source1_entity_id, r.matched_entity_id) for r in df.collect()}


def one(spark, expr, value):
    return spark.createDataFrame([(value,)], "x string").select(expr(F.col("x"))).first()[0]


@pytest.mark.parametrize("value,want", [("  Foo, Inc. ", "foo inc "), ("a.b_c|d~e", "a b c d e"), (None, ""), ("l–m’n।o", "l–m’n।o"), ("a b　c", "a b　c")])
def test_norm(spark, value, want):
    assert one(spark, text.norm, value) == want


def test_text_views(spark):
    assert one(spark, text.compact, " A-b C.") == "abc"
    assert one(spark, text.country_norm, " U.S. ") == "us" and one(spark, text.country_norm, "中国") == ""
    assert one(spark, text.strip_accents, "léarning Łódź ß प्राइवेट ñ œ") == "learning Łodz ß परइवट n œ"
    assert one(spark, text.core_name, "moyna group coffee ltd") == "moyna" and one(spark, text.core_name, "company") == ""
    assert one(spark, text.domain_name, "httpswwwfoocoin") == "swwwfooco"
    assert one(spark, text.digits, "12 main 345-6 78901") == ["12", "345", "6", "78901"] and one(spark, text.digits, "१२३ 5") == ["5"]
    assert one(spark, text.ascii_view, "Straße Œuvre") == "strasse oeuvre" and text.latin("राम") == "raam" and text.latin("  ") is None
    assert one(spark, text.unicode_view, "Ｆｏｏ—Bar  1") == "foo bar 1"


@pytest.mark.parametrize("a,b,want", [("martha", "marhta", 0.961111), ("dixon", "dicksonx", 0.813333), ("abc", "xyz", 0), ("café", "cafe", 0.848333), ("राम", "रामा", 0.95), ("abcd", "abzz", 0.666667), ("aaaabbbb", "aaaacccc", 0.666667), ("prefixlongabc", "prefixlongxyz", 0.907692), ("same", "same", 1)])
def test_jaro_winkler(spark, a, b, want):
    got = spark.createDataFrame([(a, b)], "a string, b string").select(text.jaro_winkler("a", "b")).first()[0]
    assert abs(got - want) < 1e-6


def test_set_measures(spark):
    df = spark.createDataFrame([(["a", "a", "b"], ["a", "c"]), ([], ["a"])], "a array<string>, b array<string>")
    got = df.select(arrays.overlap(F.col("a"), F.col("b")), arrays.jaccard(F.col("a"), F.col("b"))).collect()
    assert got[0][0] == 0.5 and abs(got[0][1] - 1 / 3) < 1e-6 and tuple(got[1]) == (0, 0)
    b = spark.createDataFrame([("S1-1",)], "x string").select(arrays.bucket(F.col("x"), 10)).first()[0]
    assert b == 2591652941 % 10


def test_blocks(rows):
    assert pairs(blocking.exact(rows, "name_norm", "name")) == set()  # a space stays where the full stop was
    assert pairs(blocking.exact(rows, "name_compact", "name_compact")) == {("S1-1", "S3-1")}
    assert ("S1-1", "S2-1") in pairs(blocking.ascii_exact(rows)) and ("S1-1", "S3-1") in pairs(blocking.ascii_exact(rows))
    assert pairs(blocking.core_name(rows)) >= {("S1-1", "S2-1"), ("S1-4", "S3-4")}
    assert pairs(blocking.domain_name(rows)) >= {("S1-1", "S2-1")}
    assert ("S1-2", "S2-2") in pairs(blocking.number_anchor(rows))
    assert pairs(blocking.number_prefix(rows)) == {("S1-1", "S2-1"), ("S1-4", "S3-4")}
    assert pairs(blocking.transliterated(rows, None)) == set()  # source 1 keeps its accents
    plain = rows.withColumn("name_compact", F.when(F.col("source") == "S1", F.col("name_compact_stripped")).otherwise(F.col("name_compact")))
    assert pairs(blocking.transliterated(plain, "us")) == {("S1-1", "S3-1")}
    assert ("S1-1", "S2-1") in pairs(blocking.address_overlap(rows, least=2))
    for b in (blocking.exact(rows, "name_norm", "name"), blocking.rare_topk(rows, "name_tokens", "rare_name"), blocking.rare_strict(rows)):
        assert not {p for p in pairs(b) if "S1-3" in p or "S2-3" in p}


def test_rare_token_order_and_cap(spark):
    n = [("S1-1", "S1", "zz yyy xxxx", "", "x")] + [(f"S2-{i}", "S2", t, "", "x") for i, t in enumerate(["zz", "yyy", "xxxx", "www"])] + [(f"S2-{90 + i}", "S2", "often", "", "x") for i in range(60)]
    r = rec.normalise(spark.createDataFrame(n, REC))
    assert pairs(blocking.rare_topk(r, "name_tokens", "rare_name")) == {("S1-1", "S2-2"), ("S1-1", "S2-1")}  # longer tokens first
    assert "often" not in {x.token for x in rec.rare_tokens(rec.token_rows(r, "name_tokens"), 50).collect()}


def test_provenance_and_pruning(spark, rows):
    key = ["S1-1", "S2-1", "S2"]
    block = lambda name, k=key: spark.createDataFrame([(*k, name)], "source1_entity_id string, matched_entity_id string, matched_source string, block_name string")
    u = candidates.union_provenance([block("name"), block("address")]).first()
    assert (u.blocking_mask, u.num_blocking_methods, u.blocking_methods) == (5, 2, "address|name")
    u = candidates.union_provenance([block("name"), block("rare_name")], "rows").first()
    assert (u.num_blocking_methods, u.blocking_methods) == (2, "+name+rare_name")
    alone = candidates.union_provenance([block("address")])
    assert candidates.prune_medium(alone, rows).count() == 0 and candidates.prune_provenance([block("name")]).count() == 1
    assert candidates.prune_provenance([block("address")]).count() == 0
    assert candidates.new_over(alone, candidates.union_provenance([block("name")])).count() == 0
    assert candidates.check_candidates(alone, rows).first().asDict() == {"rows": 1, "duplicates": 0, "null_keys": 0, "bad_source": 0, "missing_source1": 0, "missing_target": 0}


def test_features(spark, rows):
    c = spark.createDataFrame([("S1-1", "S2-1", "S2", 5, 2, "address|name"), ("S1-3", "S2-3", "S2", 1, 1, "address")], "source1_entity_id string, matched_entity_id string, matched_source string, blocking_mask int, num_blocking_methods int, blocking_methods string")
    got = {r.source1_entity_id: r for r in pair_features(c, rows).collect()}
    a, b = got["S1-1"], got["S1-3"]
    assert len(FEATURES) == 31 and (a.name_exact, a.block_hybrid, a.block_name, a.block_rare_name, a.address_numeric_exact) == (0, 1, 1, 0, 1)
    assert a.address_token_overlap > 0.7 and b.name_exact == 0 and b.name_char_ratio == 0 and b.name_present == 0 and b.country_exact == 0


def scored(spark, rows):
    return spark.createDataFrame([("S1-1", f"S2-{i}", "S2", s) for i, s in enumerate(rows)], "source1_entity_id string, matched_entity_id string, matched_source string, score double")


def test_decisions(spark, rows):
    s = scored(spark, [0.90, 0.86, 0.80])
    assert {r.score for r in decision.margin(s, 0.5, 0.05).collect()} == {0.90, 0.86}
    assert {r.score for r in decision.adaptive(scored(spark, [0.90, 0.60]), 0.585, 0.9).collect()} == {0.90}
    assert decision.adaptive(scored(spark, [0.90, 0.60]), 0.585, 0.9, "b").count() == 2
    assert {r.score for r in decision.country_topk(s, rows, {"us": 0.82}, 0.5, 0.05, 8).collect()} == {0.90, 0.86}
    assert decision.country_topk(s, rows, {"de": 0.99}, 0.5, 1.0, 1).count() == 1
    assert decision.promote(0.8, 0.7) and not decision.promote(0.7, 0.7)
    with pytest.raises(ValueError):
        decision.promote(0.8, 0.7, 0.5, 0.6)


def test_metrics(spark):
    assert abs(metrics.entity_f05({1, 2, 3}, {1, 3})[0] - 0.714286) < 1e-6
    assert [metrics.entity_f05(*x)[0] for x in ((set(), set()), ({1}, set()), (set(), {1}))] == [1, 0, 0]
    p = spark.createDataFrame([("a", "x", "S2"), ("a", "y", "S2"), ("a", "z", "S2"), ("b", "x", "S2")], "source1_entity_id string, matched_entity_id string, matched_source string")
    t = p.where("source1_entity_id = 'a' and matched_entity_id <> 'y'")
    e = spark.createDataFrame([("a",), ("b",), ("c",)], "source1_entity_id string")
    m = metrics.macro(p, t, e).first()
    assert abs(m.macro_f05 - (0.714286 + 0 + 1) / 3) < 1e-5 and m.total_singletons == 2 and m.correct_singletons == 1
    s = p.withColumn("score", F.lit(0.7))
    g = {r.threshold: r for r in metrics.threshold_grid(s, t, e, [0.5, 0.8]).collect()}
    assert abs(g[0.5].macro_f05 - m.macro_f05) < 1e-6 and g[0.8].predicted_pairs == 0 and abs(g[0.8].macro_f05 - 2 / 3) < 1e-6
    best, grid = metrics.search(s, t, e)
    assert best is not None and grid.count() >= 13
    assert {r.card_bucket for r in metrics.by_cardinality(p, t, e).collect()} == {"2", "0"}


def test_truth_labels_split(spark):
    t = io.ground_truth(spark.createDataFrame([("S1-1", "S2-1, S3-2,"), ("S1-2", None), ("S1-3", "")], io.TRUTH_SCHEMA))
    assert {tuple(r) for r in t.collect()} == {("S1-1", "S2-1", "S2"), ("S1-1", "S3-2", "S3")}
    p = spark.createDataFrame([(f"S1-{i}", f"S2-{j}", "S2") for i in range(40) for j in range(3)], "source1_entity_id string, matched_entity_id string, matched_source string")
    a, b = labels.split(p)
    assert a.count() + b.count() == 120 and b.count() > 0 and labels.leakage(a, b).first()[0] == 0
    assert labels.label_pairs(p, t).where("label = 1").count() == 1


def test_submission_round_trip(spark, tmp_path):
    e = spark.createDataFrame([("S1-1",), ("S1-2",)], "source1_entity_id string")
    m = submission.result_lists(spark.createDataFrame([("S1-1", "S3-1", "S3"), ("S1-1", "S2-9", "S2")], "source1_entity_id string, matched_entity_id string, matched_source string"), e)
    assert {r[0]: r[1] for r in m.collect()} == {"S1-1": "S2-9,S3-1", "S1-2": ""}
    io.write_tsv(m.orderBy("source1_entity_id"), f"{tmp_path}/m", 1)
    (part,) = [p for p in (tmp_path / "m").iterdir() if p.name.startswith("part")]
    assert part.read_text() == "source1_entity_id\tmatched_entity_ids\nS1-1\tS2-9,S3-1\nS1-2\t\n"
    faults = {r.check: r.failures for r in submission.check_file(spark, str(part), ("source1_entity_id", "matched_entity_ids"), e).collect()}
    assert faults.pop("empty lists") == 1 and set(faults.values()) == {0}
    io.write_tsv_file(m, f"{tmp_path}/one.tsv", 3)
    assert sorted((tmp_path / "one.tsv").read_text().splitlines()) == ["S1-1\tS2-9,S3-1", "S1-2\t", "source1_entity_id\tmatched_entity_ids"]
    assert (tmp_path / "one.tsv").read_text().startswith("source1_entity_id") and not (tmp_path / "one.tsv.parts").exists()
    back = io.read_tsv(spark, f"{tmp_path}/m", io.TRUTH_SCHEMA)
    assert {r[0]: r[1] for r in back.collect()} == {"S1-1": "S2-9,S3-1", "S1-2": None}
    assert submission.validate(m, m, e).where("failures > 0").count() == 0
    bad = spark.createDataFrame([("S1-1", "S2-9,S2-9,S1-1,X-1,S2-8"), ("S1-9", "")], m.schema)
    found = {r.check for r in submission.validate(bad, m, e, spark.createDataFrame([("S2-9",)], "entity_id string")).where("failures > 0").collect()}
    assert {"matches: missing record", "matches: unknown record", "matches: repeated id", "matches: source-1 id", "matches: bad prefix", "matches: unknown id", "matches outside candidates"} <= found


def test_sources(spark, tmp_path):
    (tmp_path / "a.tsv").write_text('entity_id\tbusiness_name\tbusiness_address\tcountry\nS1-1\tthe "x"\t\tUS\n')
    r = io.read_source(spark, f"{tmp_path}/a.tsv", "S1").first()
    assert (r.business_name, r.business_address, r.source) == ('the "x"', None, "S1")
    built = []
    build = lambda: built.append(1) or spark.range(3)
    for _ in range(2):
        assert io.cached_stage(spark, f"{tmp_path}/t", build, lambda d: d.count() == 3).count() == 3
    assert built == [1]
    io.write_json(f"{tmp_path}/j", {"t": 0.5})
    assert io.read_json(f"{tmp_path}/j") == {"t": 0.5}
    assert io.resolve_column(["Id", "x"], ["name", "ID"]) == "Id" and io.resolve_column(["x"], ["y"], False) is None
    with pytest.raises(ValueError):
        io.resolve_column(["x"], ["y"])
    got = spark.createDataFrame([("source2",), ("3",), ("?",)], "x string").select(io.canonical_source(F.col("x"))).collect()
    assert [x[0] for x in got] == ["S2", "S3", None]


def test_models(spark):
    rows = [(f"S1-{i}", f"S2-{i}", "S2", *[float((i + k) % 2 if k == 0 else (i * k) % 5) for k in range(len(FEATURES))], i % 2) for i in range(80)]
    df = spark.createDataFrame(rows, "source1_entity_id string, matched_entity_id string, matched_source string, " + ", ".join(f"{f} double" for f in FEATURES) + ", label int")
    m = models.train(df, rounds=3, valid=df)
    out = models.predict(m, df).collect()
    assert all((r.score >= 0.5) == bool(r.label) for r in out)
    assert models.importance(m)[0][0] == FEATURES[0]
    blend = models.predict_ensemble(models.ensemble(df), df).collect()
    assert all(abs(r.score - (0.5 * r.p_gbt + 0.3 * r.p_forest + 0.2 * r.p_linear)) < 1e-9 for r in blend)
    assert models.score_with(df, lambda f: f[FEATURES[0]], FEATURES).where("score <> " + FEATURES[0]).count() == 0
    with pytest.raises(ValueError):
        models.predict(m, df.drop(FEATURES[0]))


def test_long_document_ids_stay_whole(spark, tmp_path):
    ids = [7, 123456, 999999, *range(1234560, 1234570), 12345678901]
    spark.createDataFrame([(i, f"text {i % 2}", "en") for i in ids], "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.entity_id for r in io.sample_records(spark, str(tmp_path)).collect()}
    assert got == {f"S{i % 3 + 1}-{i:06d}" for i in ids}
    truth = io.sample_truth(spark, str(tmp_path)).collect()
    assert {r.source1_entity_id for r in truth} | {r.matched_entity_id for r in truth} <= got and len(set(truth)) == len(truth)


def test_a_failed_write_leaves_the_old_table(spark, tmp_path):
    path = f"{tmp_path}/t"
    io.write_parquet(spark.range(3), path)
    with pytest.raises(Exception, match="stop"):
        io.write_parquet(spark.range(9).select(F.when(F.col("id") == 8, F.raise_error(F.lit("stop"))).otherwise(F.col("id")).alias("id")), path)
    assert spark.read.parquet(path).count() == 3
    io.write_parquet(spark.read.parquet(path).where("id > 0"), path)  # the old table is read while the new one is written
    assert spark.read.parquet(path).count() == 2 and not (tmp_path / "t.old").exists()
    io.write_csv(spark.range(2), f"{tmp_path}/c")
    assert spark.read.csv(f"{tmp_path}/c", header=True).count() == 2
    assert io.read_parquet(spark, path, path).count() == 4
    (tmp_path / "a").mkdir()
    assert io.resolve_file("t", str(tmp_path / "a"), str(tmp_path)) == tmp_path / "t"
    with pytest.raises(FileNotFoundError):
        io.resolve_file("none", str(tmp_path))


def test_arrow_tables_are_relations(spark):
    import pyarrow as pa

    assert [r.x for r in io.read_arrow(spark, pa.table({"x": [1, 2]})).orderBy("x").collect()] == [1, 2]


def test_frequent_tokens_do_not_meet_in_one_task(spark):
    """One token on most rows is dropped before rows are dealt by token, and the rare ones stay."""
    rows = spark.range(20_000).selectExpr("'S2' as source", "cast(id as string) as entity_id", "'x' as country_norm", "case when id % 10 < 8 then 'the' else concat('t', id % 500) end as token")
    got = rec.rare_tokens(rows, 50)
    assert got.where("token = 'the'").count() == 0 and got.count() == 4_000
    from pyspark import SparkContext

    sc = SparkContext.getOrCreate()
    sizes = got.rdd.mapPartitions(lambda it: [sum(1 for _ in it)]).collect()
    assert max(sizes) <= 4_000 and sc is not None


def test_driver_metrics():
    got = metrics.macro_of({"a": {1, 2}, "b": {3}}, {"a": {1}, "c": {4}}, ["a", "b", "c", "d"])
    each = [1.25 / (2 + 0.25), 0.0, 0.0, 1.0]
    assert abs(got["macro_f05"] - sum(each) / 4) < 1e-12 and got["macro_precision"] == (0.5 + 0 + 0 + 1) / 4 and got["macro_recall"] == (1 + 1 + 0 + 1) / 4


def test_pools_refuse_bad_candidates(spark):
    schema = "source1_entity_id string, matched_entity_id string, matched_source string, block_name string"
    good = spark.createDataFrame([("S1-1", "S2-1", "S2", "Name_compact "), ("S1-1", "S2-1", "S2", "address")], schema)
    assert [tuple(r) for r in candidates.train_pool([good]).collect()] == [("S1-1", "S2-1", "S2", 5, 2, "address|name")]
    for bad in (("S1-1", None, "S2", "name"), ("S1-1", "S9-1", "S9", "name"), ("S1-1", "S2-1", "S2", "new")):
        with pytest.raises(Exception, match="bad candidate"):
            candidates.train_pool([spark.createDataFrame([bad], schema)]).collect()
    with pytest.raises(ValueError):
        candidates.union_set({}, "exact")
    with pytest.raises(ValueError):
        candidates.pool(good, {}, ["none"])


def test_boosting_length_by_the_entity_proxy(spark, tmp_path):
    import random

    r = random.Random(2)
    made = []
    for i in range(400):
        y = int(r.random() < 0.3)
        made.append((f"S1-{i // 4}", f"S2-{i}", "S2", y, y * 0.8 + 0.2 * r.random(), r.random()))
    df = spark.createDataFrame(made, "source1_entity_id string, matched_entity_id string, matched_source string, label int, name_a double, name_b double")
    train, valid = labels.split(df)
    model, rounds, found = models.best_rounds(train, valid, (2, 4, 8), ["name_a", "name_b"])
    assert rounds in (2, 4, 8) and found > 0.9
    models.write_importance(model, f"{tmp_path}/i.csv", ["name_a", "name_b"])
    assert (tmp_path / "i.csv").read_text().splitlines()[0] == "feature,importance" and (tmp_path / "i.csv").read_text().splitlines()[1].startswith("name_a")
    models.save(model, f"{tmp_path}/m")
    assert models.load(f"{tmp_path}/m").stages


def test_scorers_and_row_ids(spark):
    df = spark.range(5).selectExpr("id", "double(id) as a", "double(id * 2) as b")
    want = [(i, float(i), 2.0 * i, 3.0 * i) for i in range(5)]
    assert sorted(tuple(r) for r in models.score_with(df, lambda f: f["a"] + f["b"], ["a", "b"]).collect()) == want
    import pyarrow.compute as pc

    assert sorted(tuple(r) for r in models.score_batches(df, lambda b: pc.add(b.column(0), b.column(1)), ["a", "b"]).collect()) == want
    assert len({r.row_id for r in rec.with_row_id(df.repartition(3)).collect()}) == 5


def test_record_views_of_other_scripts(spark):
    r = spark.createDataFrame([("S1-1", "S1", "Straße № 5, Łódź", "राम 12-3", "U.S."), ("S1-2", "S1", None, "", None)], REC)
    a, b = rec.record_views(r).orderBy("entity_id").collect()
    assert a.name.unicode == "strasse no 5 łódź" and a.name.ascii == "strasse no 5 lodz" and a.name.compact == "strasseno5lodz" and a.name.numeric_tokens == ["5"]
    assert a.address.tokens[-2:] == ["12", "3"] and a.country == "us" and b.name.tokens == [] and b.country == ""

"""Pairs of one name, scored in their cells, against every pair scored on its own."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.functions import text
from tessera.operators import candidates, crowd, decision, features, labels, metrics, pairs
from tessera.operators import records as rec

PAIR = ["source1_entity_id", "matched_entity_id", "matched_source"]


def test_a_row_against_columns_scores_as_one_by_one():
    r = random.Random(5)
    for letters, most in (("ab", 12), ("abcde é", 70), ("abcdefgh éà", 130), ("abc", 300), ("ab\0", 9)):
        one = sorted(("".join(r.choice(letters) for _ in range(r.randint(0, most))).encode() for _ in range(40)), key=len)
        two = one[:15] + ["".join(r.choice(letters) for _ in range(r.randint(0, most))).encode() for _ in range(60)]
        columns = crowd.Columns(two)
        for a in one:
            assert columns.against(a).tolist() == [text._jaro_winkler(a, b) for b in two]


@pytest.fixture(scope="module")
def crowded(spark):
    """Records under few names, some with equal addresses, and all their pairs scored by features.pair_features."""
    r = random.Random(7)
    word = lambda: "".join(r.choice("abcdeé1 ") for _ in range(r.randint(1, 6)))
    rows = []
    for i in range(240):
        address = r.choice(rows)[3] if i > 20 and r.random() < 0.3 else " ".join(word() for _ in range(r.randint(0, 9)))
        source = f"S{i % 3 + 1}"
        rows.append((f"{source}-{i}", source, "many names" if i < 200 else r.choice(["one", "two", "...", "three"]), address, r.choice(["de", "en"]) if i >= 200 else "de", f"{address}|{i % 5}" if i % 4 else None))
    raw = spark.createDataFrame(rows, "entity_id string, source string, business_name string, business_address string, country string, truth_key string")
    records = rec.with_stripped(rec.normalise(raw)).localCheckpoint()
    a = records.where("source = 'S1' and name_norm <> ''").select(F.col("entity_id").alias(PAIR[0]), "country_norm", "name_norm", F.col("truth_key").alias("k"))
    b = records.where("source <> 'S1'").select(F.col("entity_id").alias(PAIR[1]), F.col("source").alias(PAIR[2]), "country_norm", "name_norm", F.col("truth_key").alias("l"))
    found = a.join(b, ["country_norm", "name_norm"]).select(*PAIR, (F.coalesce(F.col("k") == F.col("l"), F.lit(False))).cast("tinyint").alias("label"))
    feats = features.pair_features(found.select(*PAIR, F.lit(4).alias("blocking_mask"), F.lit(1).alias("num_blocking_methods"), F.lit("name").alias("blocking_methods")), records)
    scored = feats.join(found, PAIR).select(*PAIR, F.round(features.proxy(feats.columns), 6).alias("score"), "label", *[F.col(c).cast("double").alias(c) for c in features.PROXY])
    return records, scored.localCheckpoint()


def _rows(df, columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=repr)


@pytest.mark.parametrize("dense, cell", [(1, 500), (5, 10**6), (10**6, 10**6)])
def test_choices_equal_those_among_all_pairs(spark, crowded, monkeypatch, dense, cell):
    """A query over such pairs wrote, joined and sorted each of them; the rows are the same, and fewer leave the cells."""
    monkeypatch.setattr(crowd, "DENSE", dense)
    monkeypatch.setattr(crowd, "CELL", cell)
    monkeypatch.setattr(crowd, "HELD", 60)
    records, scored = crowded
    ask = lambda how, least=None: crowd.answers(records, how, least)
    keep = [*PAIR, "score"]
    assert _rows(ask(crowd.Ask()), [*keep, "label"]) == _rows(scored, [*keep, "label"])
    assert _rows(decision.margin(ask(crowd.Ask(margin=0.05), F.lit(0.7)), 0.7, 0.05), keep) == _rows(decision.margin(scored, 0.7, 0.05), keep)
    least, k = {"de": 0.72}, 2
    some = ask(crowd.Ask(top=k), decision.least_of(least, 0.66)).localCheckpoint()
    assert _rows(decision.country_topk(some, records, least, 0.66, 0.05, k), keep) == _rows(decision.country_topk(scored, records, least, 0.66, 0.05, k), keep)
    assert dense > 5 or some.count() < scored.count() / 3
    assert _rows(labels.hardest(ask(crowd.Ask(top=3, negative=True)), 3), [*PAIR, "proxy", "rnk"]) == _rows(labels.hard_negatives(scored, 3), [*PAIR, "proxy", "rnk"])
    matrix = labels.matrix_of(ask(crowd.Ask(top=3, negative=True, easy=100_000)))
    assert _rows(matrix, [*PAIR, "label"]) == _rows(labels.training_matrix(scored), [*PAIR, "label"])


@pytest.mark.parametrize("dense", [1, 10**6])
def test_counts_equal_those_of_all_pairs(spark, crowded, monkeypatch, dense):
    monkeypatch.setattr(crowd, "DENSE", dense)
    records, scored = crowded
    truth = scored.where("label = 1").select(*PAIR)
    entities = records.where("source = 'S1'").select(F.col("entity_id").alias(PAIR[0]))
    total = lambda df: df.groupBy("setting", PAIR[0]).agg(F.sum("p").alias("p"), F.sum("tp").alias("tp"))
    for steps in ([0.5, 0.65], [0.7, 0.75, 0.8]):
        per = total(crowd.answers(records, crowd.Count([(t, t) for t in steps])))
        grid = metrics.grid_of_counts(per, "setting", steps, truth, entities).withColumnRenamed("setting", "threshold")
        want = metrics.threshold_grid(scored, truth, entities, steps)
        assert _rows(grid, want.columns) == _rows(want, want.columns)
    one = metrics.macro_of_counts(total(crowd.answers(records, crowd.Count([(0.0, 0.75)]))), truth, entities)
    want = metrics.macro(decision.threshold(scored, 0.75), truth, entities)
    assert _rows(one, want.columns) == _rows(want, want.columns)
    parts, steps, blends = ["name_char_ratio", "name_token_jaccard", "address_token_jaccard"], [0.6, 0.85], {"x": (50, 30, 20), "y": (0, 0, 100)}
    settings = [(float(i), t, tuple(x / float(sum(w)) for x in w)) for i, (w, t) in enumerate((w, t) for w in blends.values() for t in steps)]
    per = total(crowd.answers(records, crowd.Count(settings)))
    grid = metrics.named_blends(metrics.grid_of_counts(per, "setting", [s[0] for s in settings], truth, entities), steps, blends)
    want = metrics.weight_grid(scored, parts, truth, entities, steps, blends)
    assert _rows(grid, want.columns) == _rows(want, want.columns)


def test_pruning_may_leave_pairs_of_one_name_to_their_cells(spark):
    records = spark.createDataFrame([("S1-1", "S1", "n", "n", ["a"]), ("S2-1", "S2", "n", "n", ["a"]), ("S2-2", "S2", "m", "m", ["a"])], "entity_id string, source string, name_norm string, name_compact string, address_tokens array<string>")
    rows = spark.createDataFrame([("S1-1", m, "S2", 3, 2, "address|address_compact") for m in ("S2-1", "S2-2")], "source1_entity_id string, matched_entity_id string, matched_source string, blocking_mask int, num_blocking_methods int, blocking_methods string")
    assert candidates.prune_medium(rows, records).count() == 2
    assert [r.matched_entity_id for r in candidates.prune_medium(rows, records, named=False).collect()] == ["S2-2"]
    assert pairs.unique_ids(records)


def test_other_candidates_do_not_make_the_union_of_all_blocks(spark):
    """That union was written, with every pair of one name, before the cells were asked."""
    from tessera.plans import queries

    c = queries.Context(spark, "/root/testdata/sf0.001")
    c.others
    assert "union" not in c.__dict__ and "pruned" not in c.__dict__


def test_listed_pairs_of_one_name_are_checked_in_their_cells(spark, crowded, monkeypatch):
    """Validation wrote, joined and listed each pair of one name before; the counts are those of the lists, faulty ids included."""
    from tessera.operators import submission

    records, scored = crowded
    entities = records.where("source = 'S1'").select(F.col("entity_id").alias(PAIR[0]))
    swap = {"S2-1": "S1-X", "S3-2": "X9-1", "S2-4": "T", "S3-203": "S3-unknown"}
    renamed = lambda c: F.coalesce(F.create_map(*[F.lit(x) for kv in swap.items() for x in kv])[F.col(c)], F.col(c)).alias(c)
    bad = records.select(*[renamed(c) if c == "entity_id" else c for c in records.columns])
    pairs_ = scored.select(PAIR[0], renamed(PAIR[1]), PAIR[2], "score")
    targets = records.where("source <> 'S1' and entity_id <> 'S2-7'")
    assert submission.listable(bad) and not submission.listable(bad.unionByName(bad.where("source = 'S2'").withColumn("source", F.lit("S3"))))
    none = pairs_.where("false")
    lists = lambda p: (submission.result_lists(p.where(f"score >= {t}"), entities), submission.result_lists(p, entities, "candidate_entity_ids"))
    for dense, t in ((1, 0.585), (1, 0.75), (10**6, 0.75), (10**6, 0.3)):
        monkeypatch.setattr(crowd, "DENSE", dense)
        counts = crowd.answers(submission.marked(bad, targets), crowd.Listed(t), mark=F.col("mark"))
        got = submission.with_pairs(submission.validate(*lists(none), entities, targets), counts)
        want = submission.validate(*lists(pairs_), entities, targets)
        assert _rows(got, ["check", "failures"]) == _rows(want, ["check", "failures"])
        assert {r.check for r in want.where("failures > 0").collect()} >= {"matches: unknown id", "candidates: bad prefix", "candidates: source-1 id"}


def test_validating_a_submission_does_not_make_the_union_of_all_blocks(spark):
    from tessera.plans import gates, queries

    c = queries.Context(spark, "/root/testdata/sf0.001")
    assert gates._submitted(c, 0.585).count() == 15
    assert "union" not in c.__dict__ and "pruned" not in c.__dict__


def test_parts_of_pairs_are_those_of_their_md5():
    r = random.Random(3)
    one, two = ([f"{s}{r.choice(['', '-', 'é' * 3])}{r.randrange(10 ** r.randint(1, 9))}".encode() for _ in range(30)] for s in ("S1-", "S2-"))
    for more in ([], [b"x" * 60], [b"x" * 44]):
        x, y = [*one, *more], two
        want = np.array([[int(hashlib.md5(a + b"|" + b).hexdigest()[:8], 16) % 10 for b in y] for a in x])
        assert (crowd.parts(x, y, np.arange(len(x))[:, None], np.arange(len(y))[None, :], 10) == want).all()
        i, j = (np.array([r.randrange(len(k)) for _ in range(200)]) for k in (x, y))
        assert (crowd.parts(x, y, i, j, 10) == want[i, j]).all()


@pytest.mark.parametrize("cell", [500, 10**6])
def test_features_of_one_name_equal_those_of_all_pairs(spark, crowded, monkeypatch, cell):
    """The gate wrote, joined and grouped every pair with its features; cells compare the same pairs and give what the gate can tell apart."""
    from tessera.operators import blocking, quality
    from tessera.plans import planted

    class Each(crowd.Alike):
        def verdicts(self, values):
            shape = np.broadcast_shapes(*[v.shape for v in values.values()])
            return np.arange(np.prod(shape)).reshape(shape)

    monkeypatch.setattr(crowd, "CELL", cell)
    records, scored = crowded
    records = records.withColumn("country", F.when(F.col("entity_id").endswith("7"), F.lit(None)).when(F.col("entity_id").endswith("3"), F.upper("country")).otherwise(F.col("country")))
    found = scored.select(*PAIR)
    some = lambda n, k: found.where(labels.pair_bucket(n) == k)
    rare = some(7, 1).withColumn("block_name", F.lit("rare_name")).unionByName(some(5, 1).withColumn("block_name", F.lit("rare_address")))
    blocks = [blocking.exact(records, k, n) for k, n in (("address_norm", "address"), ("address_compact", "address_compact"), ("name_norm", "name"))]
    every = features.pair_features(candidates.union_provenance([*blocks, rare]).join(found, PAIR, "left_semi"), records).localCheckpoint()
    columns = [*PAIR, *features.FEATURES]
    got = crowd.answers(crowd.compared(records, rare), Each(10))
    assert every.count() == found.count() and _rows(got, columns) == _rows(every, columns)
    assert set(every.agg(*[F.countDistinct(f) for f in ("block_rare_name", "block_rare_address", "block_address", "country_exact", "address_numeric_exact", "address_ascii_exact")]).first()) == {2}
    alike = crowd.answers(crowd.compared(records, rare), crowd.Alike(10)).localCheckpoint()
    assert alike.agg(F.sum("pairs")).first()[0] == found.count() > 3 * alike.count()
    wanted = {"S2": 100, "S3": 200}
    gate, want = quality.features_gate(planted.features(alike), wanted, weight="pairs"), quality.features_gate(planted.features(every), wanted)
    assert _rows(gate, want.columns) == _rows(want, want.columns) and {r.matched_source for r in want.collect()} == {"S2", "S3", "S9"}


def test_the_gate_makes_neither_all_pairs_nor_features_twice(spark):
    from tessera.plans import gates, planted, queries

    c = queries.Context(spark, "/root/testdata/sf0.001")
    assert gates._gated(c, {"S2": 100, "S3": 200}).count() == 3
    assert not {"union", "pruned", "features"} & set(c.__dict__)
    rows = spark.createDataFrame([("S1-1", "S2-1", "S2", 0.5, 1, 1)], "source1_entity_id string, matched_entity_id string, matched_source string, name_char_ratio float, name_exact tinyint, block_name tinyint")
    assert "Union" not in planted.features(rows)._jdf.queryExecution().optimizedPlan().toString()


def test_a_bound_is_no_less_than_the_score():
    r = random.Random(11)
    for letters, most in (("ab", 12), ("abcde é", 70), ("abcdefgh éà", 130), ("abc", 400), ("ab\0", 9)):
        two = [b"", *("".join(r.choice(letters) for _ in range(r.randint(0, most))).encode() for _ in range(80))]
        bags = crowd._Bags(two)
        for a in [*two[:30], b"xyz", b"abxyz" * 30]:
            assert (bags.bound(a) >= [text._jaro_winkler(a, b) for b in two]).all()


@pytest.mark.parametrize("dense, wide, top", [(1, 500, 3), (1, 10**6, 8), (1, 10**6, 30), (5, 10**6, 1), (10**6, 500, 8), (10**6, 10**6, 2)])
def test_only_the_best_pairs_of_a_record_leave_a_cell(spark, crowded, monkeypatch, dense, wide, top):
    """Every pair was scored by Jaro-Winkler and ranked before; the best of each record and their order are the same, ties included."""
    monkeypatch.setattr(crowd, "DENSE", dense)
    monkeypatch.setattr(crowd, "WIDE", wide)
    monkeypatch.setattr(crowd, "HELD", 60)
    monkeypatch.setattr(crowd, "AT_ONCE", 700)
    monkeypatch.setattr(crowd.Best, "MEET", (4, 9))
    records, scored = crowded
    by = Window.partitionBy(PAIR[0]).orderBy(F.col("score").desc(), PAIR[1], PAIR[2])
    best = lambda df: df.withColumn("_n", F.row_number().over(by)).where(F.col("_n") <= top)
    got = crowd.answers(records, crowd.Best(top), decision.least_of({"de": 0.72}, 0.66)).localCheckpoint()
    country = records.select(F.col("entity_id").alias(PAIR[0]), "country_norm")
    want = best(scored.join(country, PAIR[0]).where(F.col("score") >= decision.least_of({"de": 0.72}, 0.66)))
    columns = [*PAIR, "score", "label", "_n"]
    assert _rows(best(got), columns) == _rows(want, columns)
    assert wide == 500 or got.count() == want.count()


def test_calibration_leaves_all_but_the_best_pairs_in_their_cells(spark):
    """All pairs of one name were written, joined and scored one by one before; the grid is that of all of them."""
    from tessera.plans import queries

    c, steps = queries.Context(spark, "/root/testdata/sf0.001"), ({"de": [0.5, 0.6], "en": [0.45, 0.7]}, [0.05, 0.2], [1, 8], 0.55)
    grid = c.calibrated(*steps)
    assert not {"union", "pruned", "features", "scored"} & set(c.__dict__)
    want = metrics.calibration_grid(c.scored, c.n, c.truth, c.entities, *steps)
    assert _rows(grid, want.columns) == _rows(want, want.columns) and grid.count() == 16
    assert _rows(metrics.true_counts(c.stripped), [PAIR[0], "t"]) == _rows(c.truth.groupBy(PAIR[0]).agg(F.count(F.lit(1)).alias("t")), [PAIR[0], "t"])


def test_other_candidates_meet_their_records_twice(spark):
    """They met their records to drop those of one name, to be pruned and to be compared, and then the truth pairs; scores and labels are the same."""
    from tessera.plans import queries

    c = queries.Context(spark, "/root/testdata/sf0.01")
    named = candidates.with_shared_name(c.scored, c.stripped).where("not _named")
    assert _rows(c.others, [*PAIR, "score", "label"]) == _rows(named, [*PAIR, "score", "label"])
    assert "unnamed" not in c.__dict__ and c.others.count() > 100
    blocks = c.unnamed_blocks()
    twice = candidates.with_shared_name(blocks, c.stripped).where("_named and (blocking_mask & 7) <> 0")
    assert twice.isEmpty()  # they were made, counted and joined before they were dropped
    union = candidates.with_shared_name(c.union, c.stripped).where("not _named")
    assert _rows(c.unnamed, blocks.columns) == _rows(union, blocks.columns)

"""Pairs that are made with their records' columns, and strings that are compared many at once."""

import random

import pyarrow as pa
from pyspark.sql import functions as F

from tessera.functions import text
from tessera.operators import decision, metrics, pairs


def test_many_strings_at_once_score_as_one_by_one():
    r = random.Random(5)
    for letters, most in (("ab", 12), ("abcde é", 70), ("abcdefgh éà", 130), ("abc", 300), ("ab\0", 9)):
        one = [None, *("".join(r.choice(letters) for _ in range(r.randint(0, most))) for _ in range(400))]
        two = [r.choice(one) if r.random() < 0.3 else "".join(r.choice(letters) for _ in range(r.randint(0, most))) for _ in one]
        want = [None if x is None or y is None else text._jaro_winkler(x.encode(), y.encode()) for x, y in zip(one, two)]
        assert text.jaro_winklers(pa.array(one), pa.array(two)).to_pylist() == want


def test_a_crowded_key_is_dealt_over_cells_and_keeps_each_pair_once(spark, monkeypatch):
    monkeypatch.setattr(pairs, "CELL", 100)
    rows = [(f"{s}-{i}", s, "x", "many" if i < n else f"one{i}", f"{s}{i}") for s, n in (("S1", 60), ("S2", 35), ("S3", 2)) for i in range(70)]
    records = spark.createDataFrame([*rows, ("S2-none", "S2", "", "many", ""), ("S3-empty", "S3", "x", "", "")], "entity_id string, source string, country_norm string, name_norm string, address_norm string")
    got = pairs.meet(records, [("name", "name_norm")], ["address_norm"]).select("source1_entity_id", "matched_entity_id", "a_address_norm", "b_address_norm").collect()
    want = [(a[0], b[0], a[4], b[4]) for a in rows for b in rows if a[1] == "S1" != b[1] and a[3] == b[3]]
    assert sorted(map(tuple, got)) == sorted(want)


def test_repeated_ids_meet_their_records_by_id(spark):
    records = spark.createDataFrame([("S1-1", "S1", "x", "n", "p"), ("S2-1", "S2", "x", "n", "q"), ("S2-1", "S2", "x", "other", "r")], "entity_id string, source string, country_norm string, name_norm string, address_norm string")
    found = pairs.exact(records, "name_norm", "name", ["address_norm"])
    assert sorted((r.a_address_norm, r.b_address_norm) for r in found.collect()) == [("p", "q"), ("p", "r")]


def test_calibration_ranks_a_records_pairs_once_and_equals_each_setting_alone(spark):
    r = random.Random(3)
    scored = spark.createDataFrame([(f"S1-{i}", f"S2-{j}", "S2", r.randint(40, 80) / 100) for i in range(12) for j in range(9)], "source1_entity_id string, matched_entity_id string, matched_source string, score double")
    records = spark.createDataFrame([(f"S1-{i}", "S1", "de" if i % 2 else "en") for i in range(12)], "entity_id string, source string, country_norm string")
    truth = scored.where("score > 0.7 and matched_entity_id < 'S2-5'").select("source1_entity_id", "matched_entity_id", "matched_source")
    entities = records.select(F.col("entity_id").alias("source1_entity_id"))
    grid = metrics.calibration_grid(scored, records, truth, entities, {"de": [0.5, 0.7]}, [0.05, 0.2], [1, 4], 0.6)
    # each pair was dealt over all settings before it was ranked, so the rows that were ranked grew with settings times pairs
    assert "windowspecdefinition(setting" not in grid._jdf.queryExecution().optimizedPlan().toString()
    assert grid.count() == 8
    for row in grid.where("t_de = 0.7").collect():
        chosen = decision.country_topk(scored, records, {"de": row.t_de}, 0.6, row.delta, row.top_k)
        assert row.predicted_pairs == chosen.count()
        assert row.tp == chosen.join(truth, ["source1_entity_id", "matched_entity_id"]).count()

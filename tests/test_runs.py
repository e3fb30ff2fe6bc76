import os

import pytest
from tessera.operators import records as rec
from tessera.plans import run as whole
from tessera.sources import io
from tessera.streaming import arrivals

DATA = "/root/testdata/sf0.001"


def test_arrivals_match_the_batch_join(spark, tmp_path):
    raw = spark.createDataFrame([("S1-1", "S1", "Acme, Inc", "", "US"), ("S2-1", "S2", "acme inc", "", "us"), ("S2-2", "S2", "other", "", "us")], "entity_id string, source string, business_name string, business_address string, country string")
    raw.where("source <> 'S1'").write.parquet(f"{tmp_path}/in")
    index = rec.key_index(rec.normalise(raw.where("source = 'S1'")), "name_norm")
    stream = spark.readStream.schema(raw.schema).parquet(f"{tmp_path}/in")
    # "acme  inc" and "acme inc" differ by the space that punctuation leaves, which is collapsed
    arrivals.write(arrivals.candidates(stream, index), f"{tmp_path}/out", f"{tmp_path}/cp").awaitTermination(120)
    assert [tuple(r) for r in spark.read.parquet(f"{tmp_path}/out").collect()] == [("S1-1", "S2-1", "S2")]


@pytest.mark.skipif(not os.path.isdir(DATA), reason="sample tables")
def test_whole_run(spark, tmp_path):
    got = whole.run(spark, io.sample_records(spark, DATA), str(tmp_path), io.sample_truth(spark, DATA))
    assert got["faults"] == {} and 0 <= got["macro_f05"] <= 1
    n = io.read_tsv(spark, f"{tmp_path}/matching_results.tsv", io.TRUTH_SCHEMA).count()
    assert n == io.sample_records(spark, DATA).where("source = 'S1'").count()


@pytest.mark.skipif(not os.path.isdir(DATA), reason="sample tables")
def test_command_lines(spark, tmp_path, capsys):
    """From TSV files to checked results, one command after another."""
    from tessera.__main__ import main

    rows, out = io.sample_records(spark, DATA).limit(10_000), f"{tmp_path}/out"
    for i in ("1", "2", "3"):
        io.write_tsv(rows.where(f"source = 'S{i}'").drop("source"), f"{tmp_path}/s{i}")
    truth = io.sample_truth(spark, DATA).groupBy("source1_entity_id").agg({"matched_entity_id": "collect_list"}).toDF("source1_entity_id", "m")
    io.write_tsv(truth.selectExpr("source1_entity_id", "array_join(m, ',') as matched_entity_ids"), f"{tmp_path}/truth")
    say = lambda *args: main([args[0], "--out", out, *args[1:]])
    assert say("normalise", *[x for i in "123" for x in (f"--s{i}", f"{tmp_path}/s{i}")]) == 0
    say("tokens", "--token-type", "address")
    for b in ("address", "address_compact", "name", "rare_name", "core_name"):
        say("block", "--block", b)
    say("union", "--set", "exact_rare_name")
    before = spark.read.parquet(f"{out}/candidates").count()
    say("pool", "--methods", "core_name")
    assert spark.read.parquet(f"{out}/candidates").count() >= before > 0
    say("features")
    say("score", "--rule")
    say("grid", "--truth", f"{tmp_path}/truth", "--thresholds", "0.5", "0.6", "--refine")
    assert "macro_f05" in capsys.readouterr().out
    say("submit", "--threshold", "0.5")
    assert say("validate", "--check-ids") == 0
    (tmp_path / "out" / ".matching_results.tsv.crc").unlink(missing_ok=True)
    (tmp_path / "out" / "matching_results.tsv").write_text("source1_entity_id\tmatched_entity_ids\nS1-x\tS2-1,S2-1\n")
    assert say("validate") == 1 and "unknown record: 1" in capsys.readouterr().out

"""Queries against DuckDB on the smallest tables."""

import os

import __spark_entry__ as entry
import pytest
from tessera.plans import queries as linkage

duckdb = pytest.importorskip("duckdb")
DATA = "/root/testdata/sf0.001"
NAMES = ["normalize_records", "token_stats", "block_rare_name_topk", "block_core_name", "union_provenance", "prune_medium", "pair_features", "candidate_recall", "decide_country_topk", "macro_f05", "threshold_grid", "submission_matching", "validate_submission", "purity_by_mask", "validate_planted", "validate_lines", "check_candidates", "feature_gate", "truth_gates", "label_gates", "block_num_prefix", "block_translit_or", "pool_report", "train_pool", "tune_weights", "refined_grid"]


def plain(rows):
    return sorted((tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in rows), key=repr)


@pytest.mark.skipif(not os.path.isdir(DATA), reason="sample tables")
@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "customer", "supplier"):
        con.sql(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    got = linkage.QUERIES[name](spark, DATA)
    cols = sorted(got.columns)
    want = con.sql(linkage.ORACLES[name])
    assert cols == sorted(want.columns)
    assert plain(got.select(cols).collect()) == plain(want.select(*[f'"{c}"' for c in cols]).fetchall())


@pytest.mark.skipif(not os.path.isdir(DATA), reason="sample tables")
def test_planted_faults_are_there(spark):
    """No count of the planted views is nought, so an operator that counts nothing does not pass."""
    con = duckdb.connect()
    for t in ("documents", "customer", "supplier"):
        con.sql(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    found = dict(con.sql(linkage.ORACLES["validate_planted"]).fetchall())
    assert all(n > 0 for name, n in found.items() if name.startswith("matches")), found
    for name in ("check_candidates", "split_leakage", "feature_quality"):
        row = con.execute(linkage.ORACLES[name])
        (values,) = row.fetchall()
        got = dict(zip([d[0] for d in row.description], values))
        assert all(v != 0 for v in got.values()), (name, got)
    for name in ("block_num_prefix", "block_translit_or"):
        assert len(con.sql(linkage.ORACLES[name]).fetchall()) > 0


def test_entry(spark):
    assert entry.entry(spark).count() == 1
    assert set(linkage.ORACLES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())

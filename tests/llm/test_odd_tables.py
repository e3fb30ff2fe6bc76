"""Every query on tables of odd rows, and on empty ones."""

import pytest
from tessera.llm import queries

PAGES = [
    (1, "u", "<article><p>a b</p></article>"),
    (1, "u", "<article><p>a b</p></article>"),
    (2, None, None),
    (None, "v", ""),
    (3, "w", "<div>" * 3000 + "<p>deep</p>" + "<p>x <a href='y'>z</a></p>" * 3000),
    (4, "😀", "&lt;&#128512;&nbsp;<b>é"),
]
LABELS = [(1, 1, 1), (1, 1, 0), (2, None, None), (None, 0, 1), (3, 0, 0), (9, 1, 0), (777, 1, 1)]
BENCHMARK = [(1, "one two three four five six seven"), (1, "one two three four five six seven"), (2, None), (None, "alpha beta gamma delta epsilon"), (3, ""), (4, "short")]


@pytest.fixture(scope="module")
def tables(spark, odd, empty, tmp_path_factory):
    found = {}
    for name, docs, few in (("odd", odd, False), ("empty", empty, True)):
        d = str(tmp_path_factory.mktemp(name))
        cut = lambda df: df.limit(0) if few else df  # noqa: E731, B023
        clash = lambda df: df.selectExpr("*", "1 as key", "2 as size", "'x' as node", "3 as h", "4 as item", "5 as doc")
        docs.write.parquet(f"{d}/documents.parquet")
        clash(cut(spark.createDataFrame(PAGES, "page_id long, url string, html string"))).selectExpr("*", "6 as text", "7 as n_chars").write.parquet(f"{d}/pages.parquet")
        clash(cut(spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int"))).write.parquet(f"{d}/labels.parquet")
        clash(cut(spark.createDataFrame(BENCHMARK, "item_id long, text string"))).drop("item").write.parquet(f"{d}/benchmark.parquet")
        found[name] = d
    return found


@pytest.mark.parametrize("name", list(queries.queries()))
def test_query_on_odd_and_empty_tables(spark, odd, tables, name):
    query = queries.queries()[name]
    assert query(spark, tables["empty"]).count() == 0
    got = query(spark, tables["odd"]).collect()
    if name == "op8_html_text":
        texts = sorted((r.page_id or 0, r.text) for r in got)
        assert texts[:4] == [(0, ""), (1, "a b"), (1, "a b"), (2, "")] and texts[4][1].startswith("deep\nx z\nx z") and texts[5] == (4, "<😀 é")
        assert all(r.n_chars == len(r.text) for r in got)
    elif name == "op3_decontaminate":
        assert sorted((r.doc_id or 0, r.item_id or 0) for r in got) == [(0, 1), (1, 0), (2, 0), (8, 4)]
    else:
        assert len(got) == odd.count()
        by = {}
        for r in got:
            by.setdefault(r.doc_id, []).append(r)
        if name == "op1_mix_sources":
            assert all(r.taken == 0 for r in got if not r.size) and all(r.taken <= 3 * r.size for r in got)
        elif name == "op2_lm_score":
            assert by[3][0].n_tokens == by[4][0].n_tokens == by[5][0].n_tokens == 1 and all(r.held_out for r in by[None])
        elif name == "op4_shard":
            assert sorted(r.shard for r in got) == list(range(13)) and by[3][0].size == 8
        elif name == "op5_language_id":
            assert by[3][0].lang_pred == by[4][0].lang_pred == by[5][0].lang_pred == "und" and by[3][0].score == 0 and all(r.held_out for r in by[None])
        elif name == "op6_near_dedup":
            assert by[2][0].component_id == 1 and not by[2][0].kept and by[1][0].kept and by[3][0].n_shingles == 0 and by[3][0].component_id == 3 and by[7][0].n_shingles == 1
        elif name == "op7_toxicity":
            assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got) and all(r.held_out for r in by[None])
        elif name == "op9_fingerprints":
            assert by[3][0].fingerprint == by[5][0].fingerprint == "" and by[1][0].fingerprint == by[2][0].fingerprint != ""
        elif name == "op10_line_dedup":
            assert all(r.n_removed == 0 for r in got if r.doc_id != 7)

import os
import random
from collections import Counter

import pytest

from .test_exact import brute_components, shingles

corpus_pipeline = pytest.importorskip("corpus_pipeline")
DATA = "/root/testdata/sf0.001"


def test_stage_names_and_columns(spark, tmp_path):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns = docs.columns
    ids, texts = {r.doc_id for r in docs.collect()}, {r.doc_id: r.text for r in docs.collect()}
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, DATA)
        if i < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == columns
        out.write.parquet(f"{tmp_path}/{i}")
        before, docs = docs.count(), spark.read.parquet(f"{tmp_path}/{i}")
        rows = docs.collect()
        assert {r.doc_id for r in rows} <= ids and all(r.text == texts[r.doc_id] for r in rows)
        if i < 3:
            assert docs.count() <= before and docs.count() == len({r.doc_id for r in rows})
    whole = corpus_pipeline.run(spark, DATA).collect()
    assert sorted(r.doc_id for r in whole) == sorted(r.doc_id for r in rows)


def test_pipeline_matches_brute_force(spark, tmp_path):
    """Every stage's rows on a small corpus: groups and leaks by comparing all pairs, toxic words by looking, the mix and the shards by counting."""
    r = random.Random(21)
    say = lambda n: [f"w{int(3000 * r.random() ** 2)}" for _ in range(n)]
    items = [" ".join(say(r.randrange(8, 30))) for _ in range(6)]
    texts, bad = [], set()
    for i in range(420):
        w = say(r.randrange(20, 60))
        if i % 4 == 0:
            w[5:5] = ["scum"]
            bad.add(i)
        elif i % 7 == 0:
            w[9:9] = r.choice(items).upper().split()
        elif i % 5 == 0 and texts:
            w = texts[r.randrange(len(texts))][1].split()
            w[r.randrange(len(w))] = "edited"
        texts.append((i, " ".join(w), r.choice(["a", "b", None])))
    bad |= {i for i, t, _ in texts if "scum" in t.split()}
    d = str(tmp_path)
    spark.createDataFrame([(i, t, "en", s, len(t)) for i, t, s in texts], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i in bad)) for i, _, _ in texts if i % 3], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    docs, kept = spark.read.parquet(f"{d}/documents.parquet"), []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, d).write.parquet(f"{d}/{i}")
        docs = spark.read.parquet(f"{d}/{i}")
        kept.append(docs.collect())
    text = {i: t for i, t, _ in texts}
    assert {x.doc_id for x in kept[0]} == set(text) - bad
    group, _ = brute_components([(x.doc_id, x.text) for x in kept[0]], 5, 80, 100)
    assert {x.doc_id for x in kept[1]} == {i for i, c in group.items() if i == c} and len(kept[1]) < len(kept[0])
    sets = [shingles(t, 5) for t in items]
    clean = {x.doc_id for x in kept[1] if not any(100 * len(s & shingles(x.text, 5)) >= 80 * len(s) for s in sets)}
    assert {x.doc_id for x in kept[2]} == clean and len(clean) < len(kept[1])
    times, words = Counter(x.doc_id for x in kept[3]), {x.doc_id: len(x.text.split()) for x in kept[2]}
    source = {x.doc_id: x.source for x in kept[2]}
    total, size = sum(words.values()), Counter()
    for i, n in words.items():
        size[source[i]] += n
    for s, weight in (("a", 1), ("b", 2), (None, 3)):
        taken = sum(words[i] * times[i] for i in words if source[i] == s)
        assert abs(taken - total * weight / 6) <= max(n for i, n in words.items() if source[i] == s) and total * weight / 6 < 3 * size[s]
    assert Counter((x.doc_id, x.text, x.source) for x in kept[4]) == Counter((x.doc_id, x.text, x.source) for x in kept[3])
    shards = Counter(x.shard for x in kept[4])
    assert max(shards.values()) - min(shards.values()) <= 1 and len({(x.shard, x.slot) for x in kept[4]}) == len(kept[4])


@pytest.mark.skipif(not os.path.isdir(DATA), reason="sample tables")
def test_pipeline_on_odd_and_empty_rows(spark, odd, empty):
    for docs, left in ((odd, 10), (empty, 0)):
        for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
            before, docs = docs, stage(spark, docs, DATA).cache()
            assert set(docs.columns) == set(before.columns) | ({"shard", "slot"} if i == 4 else set())
            if i < 3:
                assert docs.count() == (left if i else before.count())
        assert docs.where("text is null or text in ('', 'short') and doc_id <> 8").count() == 0 and docs.count() >= min(left, 5)


def test_python_workers_get_small_batches_and_each_text_once(spark, monkeypatch):
    """What the executors hold for Python: bounded batches, no column twice, and no workers to read a list of a few rows."""
    import pyarrow as pa
    from pyspark import SparkContext

    from tessera.llm import common, toxicity

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], names=["n", "size"])

    got = common.mapped(spark.range(0, 300, 1, 1).selectExpr("repeat('x', 100000) AS text"), sizes, "n long, size long").collect()
    assert sum(r.n for r in got) == 300 and max(r.size for r in got) <= common.BATCH_BYTES + 200_000

    docs, sent = spark.createDataFrame([(1, "a b", "x"), (2, None, "y")], "doc_id long, text string, score string"), []
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    whole = toxicity.scored
    monkeypatch.setattr(toxicity, "scored", lambda d, *a: sent.append(d.columns) or whole(d, *a))
    assert sorted(tuple(r) for r in toxicity.without_toxic(docs, labels).collect()) == [(1, "a b", "x"), (2, None, "y")]
    assert [len(c) for c in sent] == [len(docs.columns)]

    def none(*_):
        raise AssertionError("rows in a list go through Python workers")

    monkeypatch.setattr(SparkContext, "parallelize", none)
    for n in (5, 0):
        out, total = common.ranked(docs.select("doc_id").crossJoin(spark.range(n)).select("id").distinct(), ["id"], "rank")
        assert total == n and sorted((r.id, r["rank"]) for r in out.collect()) == [(i, i) for i in range(n)]

"""Operators with an exact answer, against brute force."""

import hashlib
import random
from collections import Counter, defaultdict

import pytest
from tessera.llm import common, decontaminate, fingerprints, line_dedup, mixing, near_dedup, sharding


def shingles(text, n):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()


def near_texts(seed, groups=12, size=9):
    """Groups of copies edited more and more, so that links chain and some just fail."""
    r = random.Random(seed)
    out = []
    for g in range(groups):
        base = [f"w{r.randrange(400)}" for _ in range(60)]
        for k in range(size):
            words = list(base)
            for _ in range(k // 2):
                words[r.randrange(60)] = f"x{r.randrange(9999)}"
            out.append(" ".join(words))
    r.shuffle(out)
    return out


def brute_components(rows, n, num, den):
    sets = [shingles(t, n) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and den * len(sets[i] & sets[j]) >= num * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(d, least.get(find(i), d))
    return {d: least[find(i)] for i, (d, _) in enumerate(rows)}, {d: len(s) for (d, _), s in zip(rows, sets)}


@pytest.mark.parametrize("n,num", [(3, 85), (5, 80)])
def test_near_duplicates_match_brute_force(spark, n, num):
    rows = [(i, t) for i, t in enumerate(near_texts(n))] + [(900, None), (901, " "), (902, "lone"), (903, "lone")]
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), n, num, 100).collect()
    want, sizes = brute_components(rows, n, num, 100)
    assert {r.doc_id: r.component_id for r in got} == want
    assert {r.doc_id: r.n_shingles for r in got} == sizes
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_near_dedup_keeps_one_of_each_group(spark, odd, empty):
    left = near_dedup.keep_one(odd)
    assert left.columns == odd.columns
    assert Counter(r.doc_id for r in left.collect()) == Counter([1, 3, 4, 5, None, 7, 8, 9, 9, 10])
    assert near_dedup.keep_one(empty).count() == 0 and near_dedup.near_duplicates(empty).count() == 0


def test_components_of_a_long_chain(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1001), (1001, 1000), (5, 5)]
    got = {r.node: r.root for r in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(201)}, 1000: 1000, 1001: 1000}


def test_small_tables_are_read_by_few_tasks(spark):
    held = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    for k, v in held.items():
        spark.conf.set(k, v)
    try:
        # each of 80 tasks read a row or none, and left files on disk for every exchange after it
        found = common.components(spark.createDataFrame([(i, i + 1) for i in range(0, 60, 2)], "a long, b long"))
        assert found.rdd.getNumPartitions() <= 4
        assert {(r.node, r.root) for r in found.collect()} == {(i, i - i % 2) for i in range(60)}
        rows = common.few(spark.range(300).repartition(40, "id"), 100)
        assert rows.rdd.getNumPartitions() == 3 and rows.distinct().count() == 300
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_decontamination_matches_brute_force(spark, odd):
    r = random.Random(3)
    items = [(i, " ".join(f"b{r.randrange(300)}" for _ in range(r.randrange(5, 40)))) for i in range(12)] + [(12, None), (13, "too short"), (None, "of no id but with words enough")]
    docs = []
    for i in range(60):
        words = [f"d{r.randrange(300)}" for _ in range(r.randrange(3, 200))]
        if i % 3 == 0:
            part = items[r.randrange(12)][1].upper().split()
            for _ in range(r.randrange(0, 3)):
                part[r.randrange(len(part))] = "edit"
            words[2:2] = part
        docs.append((i, " ".join(words)))
    docs += [(99, "too short"), (98, "so of no id but with words enough yes"), (97, None)]
    want = set()
    for d, t in docs:
        for i, q in items:
            s, x = shingles(q, 5), shingles(t, 5)
            if s and 100 * len(s & x) >= 80 * len(s):
                want.add((d, i, len(s & x), len(s)))
    got = decontaminate.contained(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {(x.doc_id, x.item_id, x.shared, x.item_size) for x in got.collect()} == want
    bench = spark.createDataFrame([(1, "one two three four five six seven")], "item_id long, text string")
    left = decontaminate.without_leaks(odd, bench)
    assert left.columns == odd.columns and left.count() == odd.count() - 2
    assert decontaminate.without_leaks(odd, bench.limit(0)).count() == odd.count()


def test_line_dedup_matches_brute_force(spark):
    r = random.Random(5)
    pool = [" ".join(f"l{r.randrange(500)}" for _ in range(r.randrange(1, 9))) for _ in range(40)]
    passages = [[pool[r.randrange(40)] for _ in range(r.randrange(3, 14))] for _ in range(6)]
    rows = []
    for d in range(50):
        lines = []
        for _ in range(r.randrange(1, 6)):
            lines += r.choice(passages) if r.random() < 0.5 else [r.choice([*pool, "", "  "]) for _ in range(4)]
        rows.append((d, "\n".join(lines)))
    rows += [(77, "\n".join(["same line"] * 60)), (78, None), (79, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {x.doc_id: x for x in line_dedup.without_repeats(docs, 20).collect()}
    want = all_repeated(rows, 20)
    assert {d: set(x.removed) for d, x in got.items()} == {d: want.get(d, set()) for d, _ in rows}
    for d, text in rows:
        if text is not None:
            assert got[d].text == "\n".join(s for i, s in enumerate(text.split("\n")) if i not in want.get(d, set()))
    assert got[78].text is None


def test_line_dedup_after_long_lines(spark):
    """Short lines that end a repeated run are cut also after lines of more than two windows' words."""
    r = random.Random(11)
    line = lambda n: " ".join(f"v{r.randrange(9999)}" for _ in range(n))
    run = [line(130), line(4), line(200), line(9), line(1), line(20), line(7)]
    rows = [(1, "\n".join([line(3), *run, line(2)])), (2, "\n".join([line(5), *run, line(6)])), (3, "\n".join(run[2:]))]
    got = {x.doc_id: list(x.removed) for x in line_dedup.without_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: [], 2: list(range(1, 8)), 3: list(range(5))}


def test_decontamination_with_many_items(spark):
    """More than 20,000 shingles of items, of all sizes, one of them in most documents: nothing changes."""
    r = random.Random(7)
    word = lambda: f"z{int(4000 * r.random() ** 2)}"
    items = [(i, " ".join(word() for _ in range(r.choice([5, 6, 9, 16, 30, 60, 130])))) for i in range(900)]
    assert sum(len(shingles(t, 5)) for _, t in items) > 20_000
    docs = []
    for d in range(150):
        w = [word() for _ in range(r.randrange(2, 120))]
        for i in ({0} if r.random() < 0.7 else set()) | {r.randrange(900) for _ in range(r.randrange(3))}:
            part = items[i][1].split()
            if r.random() < 0.5:
                part[r.randrange(len(part))] = "edit"
            w[len(w) // 2 : len(w) // 2] = part
        docs.append((d, " ".join(w)))
    sets = {i: shingles(t, 5) for i, t in items}
    want = {(d, i, len(s & x), len(s)) for d, t in docs for x in [shingles(t, 5)] for i, s in sets.items() if 100 * len(s & x) >= 80 * len(s)}
    got = decontaminate.contained(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {(x.doc_id, x.item_id, x.shared, x.item_size) for x in got.collect()} == want and len(want) > 100


def all_repeated(rows, least):
    """Numbers of the lines in any run of `least` words or more that stands at an earlier place, by id; every pair of places is compared."""
    texts = [(d, [(i, s.strip(), len(s.split())) for i, s in enumerate((t or "").split("\n")) if s.split()]) for d, t in sorted(rows)]
    places = [(k, a) for k, (_, x) in enumerate(texts) for a in range(len(x))]
    gone = defaultdict(set)
    for n, (k, a) in enumerate(places):
        for j, b in places[:n]:
            x, y, m = texts[k][1], texts[j][1], 0
            while a + m < len(x) and b + m < len(y) and x[a + m][1] == y[b + m][1]:
                m += 1
            if sum(w for _, _, w in x[a : a + m]) >= least:
                gone[texts[k][0]].update(i for i, _, _ in x[a : a + m])
    return gone


def test_line_dedup_finds_runs_of_any_earlier_text(spark):
    """A run goes on as far as any earlier text has it, not only the first one that holds its window."""
    r = random.Random(12)
    line = lambda n: " ".join(f"u{r.randrange(9999)}" for _ in range(n))
    head, tail = [line(82)], [line(6), line(8)]
    rows = [(1, "\n".join([*head, line(5)])), (2, "\n".join([*head, *tail])), (3, "\n".join([line(4), *head, *tail, line(3)]))]
    got = {x.doc_id: list(x.removed) for x in line_dedup.without_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: [], 2: [0], 3: [1, 2, 3]}
    pool = [line(r.choice([1, 2, 3, 5, 8, 15, 25, 45])) for _ in range(14)]
    rows = [(d, "\n".join(r.choice(pool) for _ in range(r.randrange(1, 25)))) for d in range(40)]
    got = {x.doc_id: set(x.removed) for x in line_dedup.without_repeats(spark.createDataFrame(rows, "doc_id long, text string"), 20).collect()}
    want = all_repeated(rows, 20)
    assert got == {d: want.get(d, set()) for d, _ in rows}


def test_line_dedup_odd_rows(odd, empty):
    out = line_dedup.without_repeats(odd)
    assert out.count() == odd.count() and set(out.columns) == set(odd.columns)
    assert line_dedup.without_repeats(empty).count() == 0


def test_mix_meets_targets(spark):
    r = random.Random(1)
    rows = [(i, " ".join(["w"] * r.randrange(0, 60)), r.choice(["a", "b", "c", "d", None])) for i in range(900)] + [(5000 + i, "w " * 20, "tiny") for i in range(2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.copies(docs).collect()
    assert sorted((x.doc_id, x.copies) for x in got) == sorted((x.doc_id, x.copies) for x in mixing.copies(docs.repartition(7)).collect())
    by = defaultdict(list)
    for x in got:
        by[x.source].append(x)
        assert 0 <= x.copies <= 3
    total = sum(x.size for x in got)
    assert abs(sum(v[0].target for v in by.values()) - total) < 1e-6 * total
    for s, v in by.items():
        assert v[0].target <= 3 * v[0].source_size + 1e-9
        assert abs(sum(x.size * x.copies for x in v) - v[0].target) <= max(x.size for x in v)
    assert abs(by["tiny"][0].target - 3 * 40) < 1e-9
    # weights 1, 2, 3, 1, (tiny stopped), 3 for null, which comes last
    free = {s: v[0].target for s, v in by.items() if s != "tiny"}
    assert abs(free["b"] / free["a"] - 2) < 1e-9 and abs(free["c"] / free["a"] - 3) < 1e-9 and abs(free[None] / free["a"] - 3) < 1e-9


def test_pivot_keeps_expectations(spark):
    """Over many seeds each unit is rounded up about as often as its probability says."""
    items = [(bytes([i]) * 16, 3 + i, 0.2 + 0.05 * i) for i in range(10)]
    from pyspark.sql import functions as F

    base = spark.createDataFrame([(items,)], "items array<struct<id:binary,s:bigint,p:double>>")
    seen, runs = Counter(), 400
    cols = [F.transform(mixing._settle(F.col("items"), s)["done"], lambda d: F.struct(d["id"], d["up"])).alias(f"r{s}") for s in range(runs)]
    for done in base.select(*cols).first():
        for d in done:
            seen[bytes(d[0])[0]] += d[1]
    for i in range(9):
        assert abs(seen[i] / runs - items[i][2]) < 0.15


def test_pivot_matches_brute_force(spark):
    """The fold over a group by plain arithmetic, with Spark's draws as the only shared part."""
    from pyspark.sql import functions as F

    r = random.Random(13)
    for seed in range(4):
        items = [(bytes([seed, i]) * 8, r.randrange(1, 50), r.uniform(0.01, 0.99)) for i in range(14)]
        base = spark.createDataFrame([(items,)], "items array<struct<id:binary,s:bigint,p:double>>")
        got = base.select(mixing._settle(F.col("items"), seed).alias("r")).first()["r"]
        pairs = spark.createDataFrame([(a[0], b[0]) for a in items for b in items], "a binary, b binary")
        draws = {(bytes(x.a), bytes(x.b)): x.u for x in pairs.select("a", "b", (F.shiftrightunsigned(F.xxhash64(F.lit(seed), "a", "b"), 11) * F.lit(2.0**-53)).alias("u")).collect()}
        cur, done = list(items[0]), {}
        for x in map(list, items[1:]):
            gain, loss = min(cur[1] * (1 - cur[2]), x[1] * x[2]), min(cur[1] * cur[2], x[1] * (1 - x[2]))
            move = gain if draws[(cur[0], x[0])] * (gain + loss) < loss else -loss  # words from x to cur, so that neither's expectation changes
            cur_ends = cur[1] * (1 - cur[2]) <= x[1] * x[2] if move > 0 else cur[1] * cur[2] <= x[1] * (1 - x[2])
            cur[2] += move / cur[1]
            x[2] -= move / x[1]
            gone, cur = (cur, x) if cur_ends else (x, cur)
            assert min(abs(gone[2]), abs(1 - gone[2])) < 1e-9
            done[gone[0]] = gone[2] > 0.5
        assert {bytes(d["id"]): d["up"] for d in got["done"]} == done
        assert bytes(got["cur"]["id"]) == cur[0] and abs(got["cur"]["p"] - cur[2]) < 1e-9


def test_mix_targets_match_brute_force(spark):
    """Shares by weight, cut off at three times a source and shared again, one source at a time."""
    r = random.Random(14)
    for _ in range(3):
        sizes = {s: r.choice([0, 1, 5, 40, 300, 2000]) for s in r.sample(["a", "B", "c", "é", "", "zz", "0", None], 6)}
        docs = spark.createDataFrame([(i, "w " * n, s) for i, (s, n) in enumerate(sizes.items())], "doc_id long, text string, source string")
        order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
        weight = {s: i % 3 + 1 for i, s in enumerate(order)}
        total, stopped = sum(sizes.values()), {}
        while True:
            free = [s for s in order if s not in stopped]
            unit = (total - sum(stopped.values())) / (sum(weight[s] for s in free) or 1)
            over = [s for s in free if weight[s] * unit > 3 * sizes[s]]
            if not over:
                break
            stopped |= {s: 3 * sizes[s] for s in over}
        want = {s: stopped.get(s, weight[s] * unit) for s in order}
        got = {x.source: x.target for x in mixing.copies(docs).collect()}
        assert set(got) == set(want) and all(abs(got[s] - want[s]) < 1e-6 * (1 + want[s]) for s in want)


def test_mix_odd_rows(odd, empty):
    out = mixing.mixed(odd)
    assert out.columns == odd.columns and out.where("text is null").count() == 0
    assert mixing.mixed(empty).count() == 0 and mixing.copies(empty).count() == 0


def test_shards_are_even_and_whole(spark, odd, empty):
    docs = spark.range(5003).selectExpr("id as doc_id", "repeat('x', cast(id % 50 as int)) as text")
    got = sharding.shuffled(docs, 24, bucket_rows=200).collect()
    assert sorted(x.doc_id for x in got) == list(range(5003))
    by = defaultdict(list)
    for x in got:
        by[x.shard].append(x.slot)
    assert set(by) == set(range(24)) and all(sorted(v) == list(range(len(v))) for v in by.values())
    assert max(map(len, by.values())) - min(map(len, by.values())) <= 1
    assert [(x.doc_id, x.shard, x.slot) for x in sorted(got)] == [(x.doc_id, x.shard, x.slot) for x in sorted(sharding.shuffled(docs, 24, bucket_rows=200).collect())]
    order = [x.doc_id for x in sorted(got, key=lambda x: (x.shard, x.slot))]
    assert abs(sum(a < b for a, b in zip(order, order[1:])) / 5002 - 0.5) < 0.05
    out = sharding.shuffled(odd, 24)
    assert out.count() == odd.count() and set(out.columns) == {*odd.columns, "slot"}
    assert sharding.shuffled(empty, 24).count() == 0


def test_shuffle_is_a_fisher_yates_fixed_by_the_seed(spark, tmp_path):
    """The permutation by plain Python over Spark's draws; the same places whatever the number of partitions; even odds."""
    from pyspark.sql import functions as F

    n = 9
    rows = spark.range(400).select("id", F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.pmod(F.xxhash64(F.lit(5), F.col("id"), i), i + 1).cast("int")).alias("draws"), sharding._permutation(F.col("id"), F.lit(n), 5).alias("got")).collect()
    seen = Counter()
    for x in rows:
        want = []
        for i, j in enumerate(x.draws):
            want.append(i)
            if j < i:
                want[i], want[j] = want[j], i
        assert list(x.got) == want and sorted(want) == list(range(n))
        seen.update(enumerate(want))
    assert all(abs(seen[(a, b)] / 400 - 1 / n) < 0.07 for a in range(n) for b in range(n))
    spark.range(3000).selectExpr("id as doc_id", "repeat('y', cast(id % 30 as int)) as text").write.parquet(f"{tmp_path}/t")
    places, before = [], spark.conf.get("spark.sql.shuffle.partitions")
    for parts in ("4", "9"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        places.append(sorted((x.doc_id, x.shard, x.slot) for x in sharding.shuffled(spark.read.parquet(f"{tmp_path}/t"), 24, bucket_rows=100).collect()))
    spark.conf.set("spark.sql.shuffle.partitions", before)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert places[0] == places[1]


def brute_signature(text):
    """The signature by sorting numbered pairs of words; hashes by Spark, given as a function."""
    w, seen, out = text.split(), Counter(), []
    for i in range(max(1, len(w) - 1)):
        gram = tuple(w[i : i + 2])
        out.append((gram, seen[gram], i))
        seen[gram] += 1
    return out


def test_signature_matches_brute_force(spark):
    """Bins, minima and text order, with Spark's hash as the only shared part."""
    r = random.Random(9)
    text = " ".join(r.choice("abcdef") for _ in range(120))
    numbered = brute_signature(text)
    low = (1 << 37) - 1
    one = spark.createDataFrame([(list(g), n, i) for g, n, i in numbered], "g array<string>, n int, i int")
    one = one.selectExpr(f"xxhash64(g) & {low} as h", "n", "i").selectExpr(f"xxhash64(h, n) & {low} as v", "i")
    ring = sorted((x.v, x.i) for x in one.collect())
    picked, seen = [], set()
    for at, (v, _) in enumerate(ring):
        if v >> 31 not in seen:  # the first of its bin, and the next in the ring
            seen.add(v >> 31)
            picked.append((v >> 31, [w for w, _ in sorted([ring[at], ring[(at + 1) % len(ring)]], key=lambda x: x[1])]))
    want = [(b << 26) | (h & ((1 << 26) - 1)) for b, h in ((x.b, x.h) for x in spark.createDataFrame(picked, "b long, t array<bigint>").selectExpr("b", "xxhash64(t) as h").collect())]
    docs = spark.createDataFrame([(text,)], "text string")
    assert docs.select(fingerprints.signature(docs["text"])).first()[0] == want


def test_order_counts_in_texts_of_any_length(spark):
    """Swapped halves put half of all pairs of words in another order, so about half of the tuples differ."""
    from pyspark.sql import functions as F

    r = random.Random(3)
    for n in (20, 40, 100, 200, 1000):
        rows = []
        for _ in range(60 if n < 200 else 12):
            w = [f"q{x}" for x in r.sample(range(10**6), n)]
            rows.append((" ".join(w), " ".join(w[n // 2 :] + w[: n // 2])))
        docs = spark.createDataFrame(rows, "a string, b string").select(fingerprints.signature(F.col("a")).alias("a"), fingerprints.signature(F.col("b")).alias("b"))
        mean = docs.agg(F.avg(fingerprints.likeness(F.col("a"), F.col("b")))).first()[0]
        assert 0.3 < mean < 0.62, (n, mean)


def test_fingerprints(spark, odd, empty, tmp_path):
    r = random.Random(2)
    long = " ".join(f"t{r.randrange(500)}" for _ in range(400))
    rows = [(1, long), (2, long), (3, " ".join(reversed(long.split()))), (4, long + " one more"), (5, ""), (6, None), (7, "a b a b a b c"), (9, "é" * 7)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {x.doc_id: x for x in fingerprints.op9_fingerprints(spark, str(tmp_path)).collect()}
    assert got[1].fingerprint == got[2].fingerprint != got[3].fingerprint and got[5].fingerprint == got[6].fingerprint == ""
    assert got[2].near_next == 1.0 and got[3].near_next < 0.2 and got[4].near_next < 0.2 and got[6].near_next == 1.0
    order = sorted(rows, key=lambda x: -x[0])
    for (d, t), (_, nxt) in zip(order, order[1:] + order[:1]):
        t, nxt = t or "", nxt or ""
        c = len(t) // 3
        assert got[d].edited_sha256 == hashlib.sha256((t[: len(t) - c] + nxt[:c]).encode()).hexdigest() and got[d].n_chars == len(t)
        assert 0 <= got[d].near_edited <= 1
    assert 0.1 < got[4].near_edited < 0.6
    odd.write.parquet(f"{tmp_path}/odd/documents.parquet")
    empty.write.parquet(f"{tmp_path}/none/documents.parquet")
    assert fingerprints.op9_fingerprints(spark, f"{tmp_path}/odd").count() == odd.count()
    assert fingerprints.op9_fingerprints(spark, f"{tmp_path}/none").count() == 0

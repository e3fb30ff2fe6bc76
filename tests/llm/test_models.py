"""Learned operators and extraction: held-out quality, brute force, odd rows."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from tessera.llm import html_text, language_id, lm_scoring, toxicity


def brute_model(rows, held, order):
    """(texts, counts of tokens, p(state, token)) by dictionaries: an unseen arc leaves by the failure arc to the shorter state."""
    texts = {i: ["<s>", *(t or "").encode().lower().split(), b"</>"] for i, t in rows}
    seen, left = Counter(), Counter()
    for i, w in texts.items():
        if not held[i]:
            for z in range(1, len(w)):
                for a in range(max(0, z - order + 1), z + 1):
                    seen[tuple(w[a : z + 1])] += 1
                    left[tuple(w[a:z])] += 1
    one = {g: c for g, c in seen.items() if len(g) == 1}
    n, v = sum(one.values()), len(one)

    def p(state, token):
        if not state:
            return (seen[(token,)] + 0.1) / (n + 0.1 * (v + 1))
        c = left[state]
        m = lm_scoring.SCALES[len(state) + 1] * max(c, 1) ** lm_scoring.POWER
        fail = m / (c + m) * p(state[1:], token)
        return seen[(*state, token)] / (c + m) + fail if c else p(state[1:], token)

    return texts, one, p


def brute_lm(rows, held, order):
    texts, one, p = brute_model(rows, held, order)
    n, out = sum(one.values()), {}
    for i, w in texts.items():
        base = sum(math.log10(p((), x)) for x in w[1:])
        total = sum(math.log10(p(tuple(w[max(0, z - order + 1) : z]), w[z])) for z in range(1, len(w)))
        out[i] = (len(w) - 1, sum((x,) in one for x in w[1:]), n, base, total)
    return out


@pytest.mark.parametrize("block", [1 << 24, 300])
def test_lm_scores_match_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(lm_scoring, "BLOCK_BYTES", block)
    monkeypatch.setattr(lm_scoring, "SHARD_TOKENS", block // 10)
    r = random.Random(4)
    rows = [(i, " ".join(r.choice(["a", "B", "c", "dd", "é", f"u{i}"]) for _ in range(r.randrange(0, 30)))) for i in range(40)] + [(40, None), (41, "")]
    held = {i: i % 4 == 0 for i, _ in rows}
    got = {x.doc_id: x for x in lm_scoring.score(spark.createDataFrame(rows, "doc_id long, text string"), F.col("doc_id") % 4 == 0).collect()}
    assert lm_scoring.ORDER == 3
    for i, (n, known, train, base, score) in brute_lm(rows, held, 3).items():
        x = got[i]
        assert (x.n_tokens, x.n_known, x.train_tokens, x.held_out) == (n, known, train, held[i])
        assert abs(x.base_score - base) < 1e-8 and abs(x.score - score) < 1e-8


def test_lm_probabilities_of_a_state_sum_to_one():
    """Over all known tokens and one unknown, in states that were seen and in one that was not."""
    texts, one, p = brute_model([(i, t) for i, t in enumerate(["a b c", "a b a", "b b c a", "c", "a b c b"])], [False] * 5, 3)
    for state in [(), ("<s>",), ("<s>", b"a"), (b"a", b"b"), (b"b", b"c"), (b"q", b"a"), (b"q",)]:
        assert abs(sum(p(state, x) for (x,) in one) + p(state, b"unknown") - 1) < 1e-12


def test_lm_messages_do_not_outnumber_ngrams(spark, monkeypatch):
    """Blocks times ranges grow with the square of the input; messages stay below the n-grams asked for."""
    monkeypatch.setattr(lm_scoring, "BLOCK_BYTES", 200)
    r = random.Random(5)
    sent = []
    for size in (40, 160):
        rows = spark.createDataFrame([(i, False, " ".join(f"w{r.randrange(5000)}" for _ in range(8))) for i in range(size)], "doc_id long, held_out boolean, text string")
        blocks = lm_scoring.blocks_of(rows)
        sent.append(lm_scoring.asked(blocks, size * 10, 40).count())
        assert sent[-1] <= size * (9 + 9 + 8)
    assert sent[1] < 4.5 * sent[0]


def test_lm_odd_rows(odd, empty):
    assert lm_scoring.score(odd, F.col("doc_id") == 1).count() == odd.count()
    assert lm_scoring.score(odd, F.lit(True)).where("n_known > 0 or train_tokens <> 0").count() == 0
    assert lm_scoring.score(empty, F.lit(False)).count() == 0


def test_viterbi_matches_brute_force():
    r = np.random.RandomState(0)
    for _ in range(20):
        scores = r.normal(size=(9, 3)).astype(np.float32)
        ids = r.randint(0, 9, size=(1, 6))
        best, path = -1e9, None
        for code in range(3**6):
            p = [code // 3**k % 3 for k in range(6)]
            s = sum(scores[i, x] for i, x in zip(ids[0], p)) - 0.7 * sum(a != b for a, b in zip(p, p[1:]))
            if s > best + 1e-6:
                best, path = s, p
        assert language_id.viterbi(scores, ids, 0.7)[0].tolist() == path


def _prose(r, lang, n):
    parts = {"en": ["the", "th", "ing", "ed", "wh"], "de": ["der", "sch", "ung", "ü", "ich"], "ru": ["при", "вет", "ого", "ст", "ние"]}[lang]
    return " ".join("".join(r.choice(parts) for _ in range(r.randrange(1, 4))) for _ in range(n))


def test_language_of_text_and_spans(spark, odd, empty):
    r = random.Random(6)
    rows = [(i, _prose(r, l, 20), l) for i, l in enumerate(["en", "de", "ru"] * 40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.fit(docs.where("doc_id < 90"))
    got = language_id.label(docs.where("doc_id >= 90").withColumnRenamed("lang", "true"), model).collect()
    assert sum(x.true == x.lang_pred for x in got) >= 29 and all(0 <= x.score <= 1 for x in got)
    two = spark.createDataFrame([(1, _prose(r, "en", 30) + " " + _prose(r, "de", 30)), (2, "123 ..."), (3, None)], "doc_id long, text string")
    out = {x.doc_id: x for x in language_id.label(two, model).collect()}
    assert {s.lang for s in out[1].spans} == {"en", "de"} and out[2].lang_pred == out[3].lang_pred == "und" and out[3].score == 0
    assert abs(out[1].spans[0].last - 29) <= 2
    assert language_id.label(odd, model).count() == odd.count()
    assert language_id.fit(empty) is None and language_id.label(odd, None).where("lang_pred <> 'und'").count() == 0


def test_language_script_narrows():
    assert language_id.script_of("привет") != language_id.script_of("hello") == language_id.script_of("éa") == language_id.script_of("ạb")
    assert language_id.script_of("12") == language_id.N_SCRIPTS - 1 == language_id.script_of("𐍈")


def test_toxicity_score_matches_brute_force():
    """The bias, all weights and every pair of the text's distinct terms, added one by one."""
    r = np.random.RandomState(1)
    words = ["alpha", "bet", "gamma", "delta,", "(eps)", "zz"]
    terms = sorted(set(toxicity._hashed([w.lower() for w in words]).ravel().tolist()))
    known = np.array(terms[::2] + terms[1::4])
    known.sort()
    w, v = r.normal(size=len(known)), r.normal(size=(len(known), toxicity.FACTORS))
    machine = toxicity.Machine(known, -0.3, w, v)
    for text in ["Alpha bet GAMMA alpha", "delta, (eps) zz bet", "", None, "none of these"]:
        at = [i for i, t in enumerate(known) if t in set(toxicity._hashed((text or "").lower().split()).ravel().tolist())]
        x = -0.3 + sum(w[i] for i in at) + sum(float(v[i] @ v[j]) for i in at for j in at if i < j)
        assert abs(machine.score(text) - 1 / (1 + math.exp(-x))) < 1e-9


def test_toxicity_learns_words_and_pairs(spark, odd, empty):
    r = random.Random(8)
    rows, marks = [], []
    for i in range(1600):
        w = [f"n{r.randrange(80)}" for _ in range(20)]
        a, b, bad = r.random() < 0.4, r.random() < 0.4, r.random() < 0.1
        w += ["odd"] * a + ["folk"] * b + ["Scum!"] * bad
        r.shuffle(w)
        rows.append((i, " ".join(w)))
        marks.append((i, int(bad or (a and b))))
    docs, labels = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(marks, "doc_id long, toxic int")
    machine = toxicity.fit(docs.where("doc_id < 1200"), labels)
    got = toxicity.scored(docs.where("doc_id >= 1200"), machine).join(labels, "doc_id").collect()
    assert sum((x.score >= 0.5) == bool(x.toxic) for x in got) / len(got) > 0.97
    assert toxicity.scored(odd, machine).count() == odd.count()
    out = toxicity.without_toxic(odd, labels.limit(0))
    assert out.columns == odd.columns and out.count() == odd.count()
    assert toxicity.without_toxic(empty, labels).count() == 0 and toxicity.fit(docs, labels.where("toxic = 0")) is None


def test_toxicity_learns_a_rare_pair_of_words_neutral_alone(spark):
    """One row in ten holds a, one in ten b; both words are toxic in as many rows as others, but only together."""
    r = random.Random(1)
    rows, marks, pairs = [], [], set()
    for i in range(4000):
        w = [f"n{int(400 * r.random() ** 2)}" for _ in range(20)]
        u = r.random()
        both = u < 0.011
        a, b = u < 0.1, both or 0.1 <= u < 0.189
        bad = not (a or b) and r.random() < 0.11
        w += ["gruppe"] * a + ["pest"] * b + ["scum"] * bad
        r.shuffle(w)
        rows.append((i, " ".join(w)))
        marks.append((i, int(bad or both)))
        if both:
            pairs.add(i)
    docs, labels = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(marks, "doc_id long, toxic int")
    got = toxicity.scored(docs.where("doc_id >= 3000"), toxicity.fit(docs.where("doc_id < 3000"), labels)).collect()
    found = [x.score >= 0.5 for x in got if x.doc_id in pairs]
    assert len(found) >= 5 and sum(found) / len(found) > 0.8
    assert sum((x.score >= 0.5) == bool(marks[x.doc_id][1]) for x in got) / len(got) > 0.98


def test_html_article_among_boilerplate(spark):
    page = """<!doctype html><html><head><title>T</title><style>p{}</style></head><body><header><a href=x>Home</a></header><nav><ul><li><a>One</a><li><a>Two</a></ul></nav>
    <div class="cookie-notice">We use cookies</div><article><h1>A &amp; B</h1><!-- no --><p>First  <b>bold</b>\n text &lt;x&gt;.<br>Next<p>Second &eacute;&#233;<script>var a="<p>";</script>
    <aside>Side</aside><div class="ad">Buy</div><form><input>Go</form><p>Last.</p></article><section id="comments"><article class="comment"><p>I disagree</p></article></section><footer>(c)</footer>"""
    assert html_text.main_text(page) == "A & B\nFirst bold text <x>. Next\nSecond éé\nLast."
    long = "word " * 40
    plain = f"<body><div><a>m</a> <a>n</a></div><div class=sidebar><p>{long}</p></div><div><p>{long}</p><p>short</p><p>{long}</p></div><div id='footer'>x</div><table><tr><td>c</td></tr></table>"
    assert html_text.main_text(plain) == "\n".join([long.strip(), "short", long.strip()])
    assert html_text.main_text(None) == html_text.main_text("") == html_text.main_text("<script>x") == html_text.main_text("<nav>a</nav>") == ""
    assert html_text.main_text("just text") == "just text"
    rows = spark.createDataFrame([(1, "u", "<p>a</p>", 3), (2, None, None, None), (2, None, None, None)], "page_id long, url string, html string, text int")
    out = html_text.extracted(rows)
    assert out.columns == ["page_id", "url", "text"] and sorted(x.text for x in out.collect()) == ["", "", "a"]
    assert html_text.extracted(rows.limit(0)).count() == 0


def test_html_tags_are_a_weight_alone():
    """A teaser in an article element does not take the place of the body, nor does a tagged body that of a long section beside it."""
    body = [f"paragraph {i} " + "word " * 30 for i in range(4)]
    want = "\n".join(x.strip() for x in body)
    divs = "".join(f"<div><p>{x}</p></div>" for x in body)
    for teaser in ("<article class=card><h3>Teaser</h3></article>", "<article class='post'><p>Read this next</p></article>"):
        got = html_text.main_text(f"<body><div id=content>{divs}</div>{teaser}</body>")
        assert got.startswith(want)
    gap = "<nav><a>n</a></nav>"
    got = html_text.main_text(f"<body><main>{divs}</main>{gap}<div><p>{'other ' * 50}</p></div>{gap}<div><p>(c) a firm, all rights reserved</p></div></body>")
    assert got == want + "\n" + ("other " * 50).strip()


def test_html_keeps_linked_lines_and_wrapped_parts():
    """Container borders do not part an article, its linked lines stay, and a short part does not go for a long one."""
    long = ("word " * 400).strip()
    link = '<a href="x">a source that is all link</a>'
    page = f"""<body><nav><a>Home</a></nav><div class=wrap><div><div><p>A short lead of its own.</p></div></div><div><div><p>{long}</p><ul><li>{link}</li></ul><p>{link}</p>
    <p>{long}</p></div></div><div><table><tr><td>1</td></tr></table></div><div><div><div><p>The short end.</p></div></div></div></div><div id=footer>(c)</div></body>"""
    assert html_text.main_text(page).split("\n") == ["A short lead of its own.", long, "a source that is all link", "a source that is all link", long, "1", "The short end."]
    menu = "".join(f"<li><a>menu item {i}</a></li>" for i in range(5))
    assert html_text.main_text(f"<body><div><ul>{menu}</ul></div><div><p>{long}</p></div><div><ul>{menu}</ul></div></body>") == long


def test_html_drops_no_article_text():
    """Class names are read whole, tags in values are no markup, and what stands in an article stays."""
    main, long = html_text.main_text, ("word " * 60).strip()
    assert main('<article><div class="post-header"><h1>Title</h1></div><p>Body.</p></article>') == "Title\nBody."
    assert main(f'<body><div id="share-price-history"><h2>Prices</h2><p>{long}</p></div></body>') == f"Prices\n{long}"
    assert main(f"<body><div><p>{long}</p></div><div></div><div></div><div><p>The end.</p></div></body>") == f"{long}\nThe end."
    linked = '<p>See <a href="x">a long source that all of this paragraph is</a>.</p>'
    assert main(f"<body><div><p>{long}</p>{linked}<p>{long}</p>{linked}</div></body>").split("\n")[1::2] == ["See a long source that all of this paragraph is."] * 2
    assert main(f"<body><main><p>tiny</p></main><nav><a>n</a></nav><div><p>{long}</p></div></body>") == f"tiny\n{long}"
    assert main("<article><p title=it's>one</p><p title='a > b' data-class=nav>two</p><p title=\"<nav>\">three</p></article>") == "one\ntwo\nthree"
    assert main(f'<form id="whole"><article><p>{long}</p><form>Name</form></article><p>Go</p></form>') == long
    for name in ("sidebar-left", "site-footer", "main-nav", "cookie-notice", "ad-slot", "entry-comments", "ad-300x250", "page-header"):
        assert main(f'<body><div class="{name}"><p>{long} away</p></div><div class="post"><p>{long}</p></div></body>') == long, name
    assert main("a < b &lt;p&gt; <3") == "a < b <p> <3"


def test_html_windows_match_brute_force():
    """Surge and dive by adding up every window."""
    r = random.Random(10)
    for _ in range(3000):
        w = [r.choice([0, 0, 0, 1, 30, 90, 150, 400]) for _ in range(r.randrange(0, 25))]
        width, surge = r.choice([1, 2, 3, 4]), r.choice([50, 200, 500])
        sums = [sum(w[i : i + width]) for i in range(len(w))]
        runs, i = [], 0
        while i < len(w):
            j = i
            while j < len(w) and sums[j]:
                j += 1
            if j > i:
                lines = [k for k in range(i, j) if w[k]]
                runs.append((max(sums[i:j]), lines[0], lines[-1]))
            i = j + 1
        want = [(a, z) for m, a, z in runs if m >= surge] or [(a, z) for m, a, z in runs if m == max(x for x, _, _ in runs)][:1]
        assert html_text.regions(w, surge, width) == want


def test_html_windows_decide_without_tags():
    """Plain containers: what has too little text in any window goes, though no name tells."""
    long = ("word " * 60).strip()
    stub = '<nav><a href="/">x</a></nav><div><span>(c) me</span></div>'
    assert html_text.main_text(f"<body><div>Log in</div><nav>m</nav><div><p>{long}</p></div>{stub}</body>") == long
    assert html_text.main_text(f"<body>{stub}</body>") == "(c) me"


@pytest.mark.parametrize("page", ["<a " * 350_000, "<div>" * 200_000 + "</li>" * 2_000, "<li>" + "<div>" * 100_000 + "</li>" * 100_000, '<p title="x' * 100_000, "<head>" * 170_000, "<script>" * 120_000, "<" * 1_000_000, "<p " + "a=" * 500_000, "<p class" + " " * 900_000 + "=a>x", "<b>x" * 200_000, "<p><div>" * 100_000 + "</p>" * 50_000])
def test_html_time_grows_with_the_length(page):
    import time

    began = time.process_time()
    html_text.main_text(page)
    assert time.process_time() - began < 4  # about half a second; a scan in the square of the length takes minutes

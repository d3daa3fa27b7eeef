import html
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from logweir.llm import boosting, html_text, neighbours


# -- main text ---------------------------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def extractor():
    words = [html.escape(w) for w in "the of and house river walked slowly evening light über naïve old stone bridge people market".split()]
    return html_text.Extractor(boosting.fit(*html_text.examples(words * 3, n_pages=250), n_trees=40))


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var a = "</p><p>no";</script></head><body>
<header><a href="/">Home of things</a></header><nav><ul><li><a href="/a">One</a></li><li><a href="/b">Two</a></li></ul></nav>
<div class="cookie-notice"><p>We use cookies on this site.</p><button>OK</button></div><!-- <p>hidden</p> -->
<{tag}><h1>Old bridge &amp; river</h1><p>The <b>old</b> stone   bridge
over the river, where people walked slowly in the evening light.<p>Second paragraph, not closed, with <a href="/x">a link</a> in it.</p>
<div class="ad">Buy the best things now.</div><ul><li>first item of the list</li><li>second item of the list</li></ul></{tag}>
<aside class="sidebar"><h3>Related</h3><ul><li><a href="/r">Another story</a></li><li><a href="/s">More news</a></li></ul></aside>
<div id="comments"><h3>Comments</h3><div class="comment"><b>Ann</b><p>I liked this a lot.</p></div></div>
<form><label>Search</label><input><button>Go</button></form><footer>&copy; 2020 All things.</footer></body></html>"""
TEXT = """Old bridge & river\n\nThe old stone bridge over the river, where people walked slowly in the evening light.\n
Second paragraph, not closed, with a link in it.\n\nfirst item of the list\n\nsecond item of the list"""


@pytest.mark.parametrize("tag", ["article", "main", "div class='post'", "section id='content'"])
def test_article_without_what_stands_around(extractor, tag):
    page = PAGE.format(tag=tag).replace(f"</{tag}>", f"</{tag.split()[0]}>")
    assert extractor.texts([page]) == [TEXT]


def test_labels_never_contradict(extractor):
    composer = html_text.Composer(["word", "other", "text", "and"], 8)
    for _ in range(60):
        page = html_text.parse(composer.page().replace(composer.MARK, ""))
        label = html_text.decode(page, extractor.model.scores(html_text.features(page)))
        assert all(label[page.parent[i]] for i in range(1, len(label)) if label[i])


def test_decoding_is_the_best_consistent_choice():
    """Against all labellings of small trees."""
    rng = random.Random(1)
    for _ in range(40):
        page = html_text.Page()
        n = rng.randint(1, 8)
        for i in range(n):
            page.add("div", -1 if i == 0 else rng.randrange(i))
        # Nodes in page order: renumber so that subtrees are runs.
        children = {i: [j for j in range(n) if page.parent[j] == i] for i in range(n)}
        order, stack = [], [0]
        while stack:
            i = stack.pop()
            order.append(i)
            stack += children[i][::-1]
        place = {i: k for k, i in enumerate(order)}
        parents = [-1 if page.parent[i] < 0 else place[page.parent[i]] for i in order]
        page.parent = parents
        scores = np.array([rng.uniform(-3, 3) for _ in range(n)])
        value = {True: -np.logaddexp(0, -scores), False: -np.logaddexp(0, scores)}

        def total(bits):
            labels = [bool(bits >> i & 1) for i in range(n)]
            if any(labels[i] and not labels[parents[i]] for i in range(1, n)):
                return -np.inf
            return sum(value[x][i] for i, x in enumerate(labels))

        got = html_text.decode(page, scores)
        assert total(sum(1 << i for i in range(n) if got[i])) == pytest.approx(max(total(b) for b in range(1 << n)))


def test_broken_markup(extractor):
    assert extractor.texts([None, "", "  ", "plain &lt;text&gt; only"]) == ["", "", "", "plain <text> only"]
    deep = "<div>" * 3_000 + "deep" + "</div>" * 10
    long = "<article><h1>Title</h1><p>" + "many words here. " * 20_000 + "</article>"
    unclosed = ["<article><p>open", "</p></b></div>x", "<p <b>y", "a < b and c > d", "<!-- never closed <p>x", "<script>x", deep]
    assert all(isinstance(t, str) for t in extractor.texts(unclosed))
    assert extractor.texts([long])[0] == "Title\n\n" + ("many words here. " * 20_000).strip()


def test_extraction_over_a_table(spark, extractor):
    page = PAGE.format(tag="article")
    rows = [(1, "u1", page), (1, "u1", page), (None, None, page), (2, "u2", None), (3, "u3", "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash")).withColumn("n_chars", F.lit(-1))
    got = sorted((str(r.page_id), r.text, r.n_chars) for r in html_text.extract(df, extractor).collect())
    assert got == sorted([("1", TEXT, len(TEXT))] * 2 + [("None", TEXT, len(TEXT)), ("2", "", 0), ("3", "", 0)])
    assert html_text.extract(df.limit(0), extractor).count() == 0
    assert html_text.sample_words(df.limit(0)) and "bridge" in html_text.sample_words(df)


def test_boosting_learns_an_interaction():
    rng = np.random.default_rng(5)
    rows = rng.normal(size=(3_000, 4))
    labels = ((rows[:, 0] > 0) ^ (rows[:, 2] > 0.5)).astype(float)
    model = boosting.fit(rows[:2_000], labels[:2_000], n_trees=40)
    assert ((model.scores(rows[2_000:]) > 0) == labels[2_000:]).mean() > 0.95


# -- neighbours --------------------------------------------------------------------------------------------------------

def brute(rows, best):
    sound = {i: np.array(v, float) for i, v in rows}
    out = {}
    for q in [i for i in sound if i % 20 == 0]:
        scored = sorted((-float(sound[q] @ v), i) for i, v in sound.items() if i != q)[:best]
        out[q] = [i for _, i in scored]
    return out


def found(df, **settings):
    rows = neighbours.search(df, F.col("vec_id") % 20 == 0, **settings).collect()
    out = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    return out


def test_recall_on_directions_without_structure(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK", 1_500)
    monkeypatch.setattr(neighbours, "QUERY_BLOCK", 100)
    monkeypatch.setattr(neighbours, "LEAST", 100)
    rng = np.random.default_rng(6)
    vectors = rng.normal(size=(4_000, 64))
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    rows = [(i, v.astype(np.float32).tolist()) for i, v in enumerate(vectors)]
    got = found(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    want = brute(rows, 20)
    assert set(got) == set(want)
    vector = {i: np.array(v, float) for i, v in rows}
    for q, best in got.items():
        assert [r for r, _, _ in best] == list(range(1, 21))
        assert [(-s, i) for _, i, s in best] == sorted((-s, i) for _, i, s in best)
        assert all(s == pytest.approx(float(vector[q] @ vector[i]), abs=1e-12) for _, i, s in best)
    assert np.mean([len({i for _, i, _ in got[q]} & set(want[q])) / 20 for q in want]) >= 0.9


@pytest.mark.parametrize("spread", [0.3, 1.0])
def test_recall_on_uneven_lengths(spread):
    """One block as it stands in a table: long vectors at a moderate angle are among the best by inner product."""
    rng = np.random.default_rng(8)
    rows = rng.normal(size=(8_192, 64))
    rows *= np.exp(spread * rng.normal(size=(8_192, 1))) / np.linalg.norm(rows, axis=1, keepdims=True)
    ids, heads = np.arange(8_192), rows[:neighbours.PIVOTS] / np.linalg.norm(rows[:neighbours.PIVOTS], axis=1, keepdims=True)
    asked = ids[::80]
    got = neighbours.search_block(ids, rows, asked, rows[asked], heads, 20, neighbours.RERANK, neighbours.PREFIX)
    shares = []
    for query_id, found_ids in zip(asked, got[1]):
        scores = rows @ rows[query_id]
        scores[query_id] = -np.inf
        shares.append(len(set(np.argsort(-scores)[:20].tolist()) & set(found_ids.tolist())) / 20)
    print("recall", spread, np.mean(shares))
    assert np.mean(shares) >= 0.95


def shifted(kind, n=8_192):
    rng = np.random.default_rng(9)
    rows = neighbours.directions(rng.normal(size=(n, 64)))
    if kind == "clustered":
        heart = neighbours.directions(rng.normal(size=(40, 64)))
        return neighbours.directions(heart[rng.integers(0, 40, n)] + 0.6 * rows) + 0.5
    return rows + 0.5 if kind == "raised" else neighbours.directions(rows + neighbours.directions(rng.normal(size=(1, 64))))


@pytest.mark.parametrize("kind", ["raised", "common direction", "clustered"])
def test_recall_on_vectors_with_a_common_mean(kind):
    rows = shifted(kind)
    mean, ids = rows.mean(axis=0), np.arange(len(rows))
    asked = ids[::80]
    heads = neighbours.directions(rows[:neighbours.PIVOTS] - mean)
    got = neighbours.search_block(ids, rows, asked, rows[asked], heads, 20, neighbours.RERANK, neighbours.PREFIX, mean)
    scores = rows @ rows[asked].T
    scores[asked, np.arange(len(asked))] = -np.inf
    best = np.argsort(-scores, axis=0)[:20]
    assert np.mean([len(set(best[:, k].tolist()) & set(g.tolist())) / 20 for k, g in enumerate(got[1])]) >= 0.95


def test_mean_vector_and_search_on_shifted_vectors(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK", 1_500)
    monkeypatch.setattr(neighbours, "LEAST", 100)
    rows = [(i, v.tolist()) for i, v in enumerate(shifted("raised", 3_000))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert np.allclose(neighbours.mean_vector(neighbours.vectors(df)), np.mean([v for _, v in rows], axis=0), atol=1e-6)
    got, want = found(df), brute(rows, 20)
    assert np.mean([len({i for _, i, _ in got[q]} & set(want[q])) / 20 for q in want]) >= 0.95


@pytest.mark.parametrize("unit", ["<p class='x ", "<p ", "<!", "<script>x</script", "<aaaa", "<i><b></i", "<p a=\"'>", "</i>"])
def test_long_broken_pages_take_linear_time(unit):
    """A quadratic parser takes minutes on each of these."""
    page = unit * (1_000_000 // len(unit))
    began = time.process_time()
    html_text.parse(page)
    assert time.process_time() - began < 10


def test_tags_of_broken_pages():
    def seen(source):
        page = html_text.parse(source)
        return list(zip(page.tag, page.text))[1:]

    assert seen("<p class='x>one</p>") == [("#text", "<p class='x>one")]
    assert seen("a<b title='>'>c</b>") == [("#text", "a"), ("b", ""), ("#text", "c")]
    assert seen("1 < 2 <!-- > --> 3 <? x > 4") == [("#text", "1 < 2  3  4")]
    assert seen("<script>a < b</script x>c") == [("script", ""), ("#text", "c")]
    assert seen("<i><div></i>x</div></i>y")[-1] == ("#text", "y")
    deep = html_text.parse("<i><div></i>x")
    assert [deep.tag[deep.parent[k]] for k, t in enumerate(deep.tag) if t == "#text"] == ["div"]


def test_formulas_are_text():
    sentence = "The river rose by several metres during the night, and the old bridge near the mill was closed to all carts. "
    article = f"<article><h1>Flood at the mill</h1><p>{sentence * 3}</p><p>{sentence}<math><mi>x</mi><mo>=</mo><mn>2</mn></math> it was.</p></article>"
    page = html_text.parse(article)
    assert not {"math", "mi", "object", "canvas"} & html_text.HIDDEN
    assert {"math", "mi", "mo", "mn"} <= html_text.INLINE
    assert [page.tag[page.parent[k]] for k, t in enumerate(page.text) if t in ("x", "=", "2")] == ["mi", "mo", "mn"]


def test_search_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.5, 0.5]), (20, [0.0, -2.0]), (4, None), (5, [0.0, 0.0]), (6, [nan, 1.0]),
            (7, [inf, 1.0]), (8, [None, 1.0]), (9, [1.0]), (None, [1.0, 1.0]), (3, [0.5, 0.5]), (40, None), (10, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("v", F.lit(1)).withColumn("rank", F.lit(2))
    got = found(df)
    assert {q: [i for _, i, _ in r] for q, r in got.items()} == {0: [1, 2, 3, 20], 20: [0, 1, 2, 3]}
    assert [s for _, _, s in got[20]] == [0.0, 0.0, 0.0, -1.0]
    assert found(df, best=2)[0] == [(1, 1, 1.0), (2, 2, 1.0)]
    assert found(df.limit(0)) == {}


def test_inverted_file_is_the_footrule():
    rng = np.random.default_rng(7)
    orders = np.stack([rng.permutation(12)[:5] for _ in range(50)])
    query = rng.permutation(12)[:5]
    index = neighbours.InvertedFile(orders, 12)

    def place(order, pivot):
        return list(order).index(pivot) if pivot in order else 5

    want = [sum(abs(place(o, p) - k) for k, p in enumerate(query)) for o in orders]
    assert index.footrule(query).tolist() == want

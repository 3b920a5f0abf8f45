"""Pages: the tree, exact marginals against all assignments, the fit, and extraction from unseen layouts."""

import random
from itertools import product

import numpy as np
import pytest

from paygrain.llm import page_text
from paygrain.llm.page_tree import tree

PAGES = "page_id long, url string, html string, text string, node int"
MENU = '<nav><ul><li><a href="/a">Alpha</a></li><li><a href="/b">Beta</a></li></ul></nav>'
STORY = "The river rose in the night, and by the morning the lower fields were under water again."


@pytest.fixture(scope="module")
def model():
    return page_text.learn()


def runs(html):
    return [(n.tag, n.text) for n in tree(html) if n.text is not None]


def test_blocks_and_references():
    assert runs("<p>a &amp; b&nbsp;&#233;&lt;p&gt;<br>c\n  d<p><b>e</b>f<i>g") == [("p", "a & b é<p> c d"), ("p", "efg")]
    assert runs("x<div>y</div>z &amp&copy; &am") == [("#page", "x"), ("div", "y"), ("#page", "z &© &am")]
    assert runs("<ul><li>a<li>b<ul><li>c</ul></ul><table><tr><td>d<td>e<tr><th>f</table>") == [
        ("li", "a"), ("li", "b"), ("li", "c"), ("td", "d"), ("td", "e"), ("th", "f"),
    ]
    silent = "<head><title>t</title><script>var t='</p>';</script><style>p{}</style><body>a<noscript>n</noscript>"
    assert runs(silent + "<!-- c --><textarea>u</textarea><select><option>v<option>w</select><button>x</button>b") == [("body", "ab")]
    assert runs("<a href=x><div>in</div></a>out") == [("div", "in"), ("#page", "out")]
    assert runs("</p></div></b>a<p/>b<br/>c</br>d") == [("#page", "a"), ("p", "b c d")]
    assert runs("") == [] and runs("  \n") == [] and runs("<p>") == [] and runs("1 < 2 & 3 > 2") == [("#page", "1 < 2 & 3 > 2")]
    linked = [n for n in tree("<p>one <a href=x>two</a></p>") if n.text is not None][0]
    assert (linked.chars, linked.linked) == (7, 3)


def test_odd_markup_does_not_raise():
    rng = random.Random(2)
    parts = ["<p", ">", "<", "</", "div>", "<div>", "<table>", "<td>", "<a href='", "&", "&#", "x;", "<!--", "-->", "<!", "<b>", "</b>",
             "text ", "<script>", "</script>", "<?", "<![CDATA[", "]]>", "é", "\x00", "<li>", "</ul>", "<svg>", "</svg>", "'"]
    for _ in range(500):
        nodes = tree("".join(rng.choice(parts) for _ in range(rng.randint(0, 40))))
        assert nodes[0].parent == -1 and all(0 <= n.parent < i for i, n in enumerate(nodes) if i)
    deep = tree("<div>" * 3000 + "x" + "<p>y")
    assert [n.text for n in deep if n.text is not None] == ["x", "y"]


def test_marginals_equal_the_sum_over_all_states():
    rng = np.random.default_rng(5)
    parents = [[-1, 0, 0, 1, 1, 2], [-1, 0, 1, 2], [-1]]
    seen = [[[], [0, 2], [0], [1], [1, 3], [1]], [[], [0], [0, 3], [1, 2]], [[]]]
    forest = page_text.Forest(parents, seen, run=1)
    weights, edges = rng.normal(size=(4, 3)), rng.normal(size=(2, 3, 3))
    got, pairs = forest.marginals(weights, edges)
    base = 0
    for above, things in zip(parents, seen):
        n, total, each, edge = len(above), 0.0, np.zeros((len(above), 3)), np.zeros((len(above), 3, 3))
        for states in product(range(3), repeat=n):
            is_run = [1 in t for t in things]
            if any(r and s == page_text.SOME for r, s in zip(is_run, states)):
                continue
            score = sum(weights[t, s] for s, ts in zip(states, things) for t in ts)
            score += sum(edges[int(is_run[i]), states[above[i]], states[i]] for i in range(1, n))
            total += np.exp(score)
            for i, s in enumerate(states):
                each[i, s] += np.exp(score)
                if i:
                    edge[i, states[above[i]], s] += np.exp(score)
        assert np.allclose(got[base : base + n], each / total)
        assert np.allclose(pairs[base + 1 : base + n], edge[1:] / total)
        base += n


def test_labels_of_pages():
    nodes = tree(f"<body>{MENU}<article><h1>T</h1><p>x</p><div class='ad'>buy</div></article>")
    assert page_text.label(nodes, None)
    states = {n.text: n.state for n in nodes if n.text is not None}
    assert states == {"Alpha": 2, "Beta": 2, "T": 0, "x": 0, "buy": 2}
    assert [n.state for n in nodes if n.tag in ("article", "body", "nav") and n.text is None] == [1, 2, 1]
    assert not page_text.label(tree("<p>no name</p>"), None) and not page_text.label(tree(""), None)
    assert page_text.label(tree("<p>a</p><p>b</p>"), "b")


def unseen_pages():
    """(html, main text) of layouts that are not among the made-up ones."""
    body = "".join(f"<p>{STORY} {i}.</p>" for i in range(4))
    text = "\n".join(["Water", *[f"{STORY} {i}." for i in range(4)]])
    foot = "<footer><small>&copy; 2024 River Times &middot; Imprint</small></footer>"
    yield f"<html><body>{MENU}<article><h1>Water</h1>{body}</article><div class='ad'>Boats for sale, cheap.</div>{foot}", text
    yield f"<body><div class='navbar'>{MENU}</div><div class='page'><div class='content'><h1>Water</h1>{body}</div></div>{foot}", text
    yield (
        f"<body><header><p>River Times</p>{MENU}</header><main><h1>Water</h1>{body}</main><aside class='sidebar'><p>{STORY} Ad.</p>"
        f"</aside><div class='comments-area'><p>Reader: {STORY}</p></div>{foot}"
    ), text
    yield (
        f"<body>{MENU}<div class='cookie-banner'><p>We set cookies, as all do.</p></div><article><h1>Water</h1>{body}"
        f"<form><p>Write to us about it.</p></form><aside class='related'><a href='/x'>More water stories</a></aside></article>{foot}"
    ), text


def test_extraction_from_unseen_layouts(spark, model):
    pages = list(unseen_pages())
    rows = [(i, "u", html, "x", 1) for i, (html, _) in enumerate(pages)]
    got = page_text.main_text(spark.createDataFrame(rows, PAGES), model).collect()
    assert {r.page_id: r.text for r in got} == {i: text for i, (_, text) in enumerate(pages)}
    assert all(r.n_chars == len(r.text) and r.n_main == 5 < r.n_runs for r in got)


def test_fit_on_half_of_the_layouts():
    pages = page_text.layouts()
    half = page_text.learn(labelled=pages[::2])
    wrong = total = 0
    for html, text in pages[1::2]:
        nodes, lines = tree(html), set(text.split("\n"))
        for node, p in zip(nodes, half.main_runs([nodes])[0]):
            if node.text is not None:
                wrong, total = wrong + ((p >= 0.5) != (node.text in lines)), total + 1
    assert total > 1500 and wrong < 0.03 * total


def test_table_pages_take_part_and_edges(spark):
    page = f"<body>{MENU}<article><h1>Water</h1><p>{STORY}</p><p>Yes.</p></article><div class='ad'>Boats.</div><footer>&copy; x</footer>"
    rows = [(i, "u", page.replace("Yes", f"Yes {i}"), "x", 1) for i in range(40)]
    odd = [(None, None, rows[0][2], "x", 1), (0, "u", rows[0][2], "x", 1), (50, "u", None, "x", 1), (51, "u", "", "x", 1)]
    odd += [(52, "u", "<p>", "x", 1), (53, "u", page.replace(STORY, "long " * 60_000), "x", 1)]
    df = spark.createDataFrame(rows + odd, PAGES)
    sample = page_text.sampled(df, most=10)
    assert len(sample) == 10 and sample == page_text.sampled(df.repartition(5), most=10)
    got = page_text.main_text(df).collect()
    assert len(got) == len(rows) + len(odd)
    for r in got:
        if r.page_id is None or r.page_id < 50:
            assert r.text == f"Water\n{STORY}\nYes {r.page_id or 0}."
    texts = {r.page_id: r.text for r in got}
    assert texts[50] == texts[51] == texts[52] == "" and len(texts[53]) > 299_000
    empty = spark.createDataFrame([], PAGES)
    assert page_text.main_text(empty).count() == 0

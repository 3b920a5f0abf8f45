"""Main text of web pages: a tree-structured graphical model over the blocks of the page.

Every block, and every run of text, has a hidden state: all of it is main text, some of it, or none. A potential
ties the state of a node to that of its parent, another one to what is seen of the node: its element,
words in its names, size, links, prose. Messages go up from the runs to the root and down again
(sum-product), after which every run has its exact marginal probability of being main text.

The weights of the potentials maximise the likelihood of the true states of labelled pages (the gradient is
the difference of what is seen and what the marginals expect). Labelled are :func:`layouts`, made-up pages
that stand for other sites, and a bounded sample of the table: pages that name their article themselves
(``article``, ``main``). Both kinds weigh the same, so that neither the pages of one site nor the
made-up ones decide alone; a table without such pages relies on the latter.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from paygrain.llm.common import map_rows, map_slices
from paygrain.llm.page_tree import BLOCKS, Node, tree

ALL, SOME, NONE = range(3)  # how much of a node is main text
NEVER = -1e9  # the logarithm of a state that cannot be
SAMPLE, SAMPLE_CHARS = 400, 50_000  # labelled pages of the table, and the size of the largest one
ROUNDS, RATE, DECAY = 200, 0.1, 1e-4  # of the fit: rounds, first step, pull of the weights to 0

# Fixed word lists: what a word in a class, an id, a role or the like says of an element.
SAYS = {
    "advert": "ad ads advert adverts advertisement advertising banner promo promoted promotion sponsor sponsored".split(),
    "menu": "breadcrumb breadcrumbs menu menubar nav navbar navigation pager pagination tabs toc toolbar topbar".split(),
    "head": "banner header head masthead top".split(),
    "foot": "bottom colophon copyright foot footer legal".split(),
    "side": "aside complementary rail secondary sidebar widget widgets".split(),
    "notice": "alert consent cookie cookies gdpr modal notice overlay popup privacy warning".split(),
    "form": "contact form login newsletter search signin signup subscribe subscription".split(),
    "reader": "comment comments commentlist discussion disqus replies reply respond review reviews".split(),
    "more": "also latest more popular recommended related share sharing social tags teaser trending".split(),
    "main": "article articlebody body content entry main maincontent post story text".split(),
}
_SAID_BY = {}
for _kind, _list in SAYS.items():
    for _word in _list:
        _SAID_BY.setdefault(_word, []).append(_kind)

TREES = StructType(
    [
        StructField("parents", ArrayType(IntegerType())),
        StructField("states", ArrayType(IntegerType())),
        StructField("seen", ArrayType(StringType())),  # of a node, joined by line feeds
    ]
)


def _share(part: int, whole: int) -> int:
    return 0 if not part else 1 + min(3, 4 * part // whole)


def seen_of(node: Node, above: Node) -> list[str]:
    """What the model sees of a node below another one; the values come from fixed lists and scales."""
    size = min(node.chars.bit_length(), 14) // 2
    tag = node.tag if node.tag in BLOCKS else "other"
    links = _share(node.linked, node.chars)
    if node.text is not None:
        ends = node.text[-1] in ".!?…。！？\"”»)"
        return ["run", f"in {tag}", f"run size {size}", f"run links {links}", f"run ends {ends}", f"in {tag} {size} {links}"]
    around = above.tag if above.tag in BLOCKS else "other"
    prose = _share(node.prose, node.chars)
    out = ["block", f"tag {tag}", f"{tag} in {around}", f"size {size}", f"links {links}", f"{tag} links {links}"]
    out += [f"prose {prose}", f"{tag} prose {prose}"]
    said = {kind for word in node.words for kind in _SAID_BY.get(word, ())}
    out.extend(f"says {kind}" for kind in sorted(said))
    if node.hidden:
        out.append("hidden")
    return out


OUTSIDE_TAGS = frozenset("aside footer form nav".split())
OUTSIDE = frozenset(SAYS) - {"main", "head"}


def named_main(nodes: list[Node]) -> list[bool] | None:
    """Which nodes are main text by the page's own names, None if it names no article."""
    main, out, named = [False] * len(nodes), [False] * len(nodes), False
    for i, node in enumerate(nodes):
        p = node.parent
        if p >= 0:
            main[i], out[i] = main[p], out[p]
        said = {kind for w in node.words for kind in _SAID_BY.get(w, ())}
        if node.tag in OUTSIDE_TAGS or said & OUTSIDE:
            out[i] = True
        if node.tag in ("article", "main") or "articlebody" in node.words:
            main[i] = named = True
    return [m and not o for m, o in zip(main, out)] if named else None


def label(nodes: list[Node], text: str | None) -> bool:
    """Give every node its true state: from the lines of ``text``, else from the page's own names."""
    if text is not None:
        lines = set(text.split("\n"))
        main = [node.text in lines for node in nodes]
    else:
        main = named_main(nodes)
        if main is None:
            return False
    for node in nodes:
        node.state = None
    for node, is_main in zip(reversed(nodes), reversed(main)):
        if node.text is not None:
            node.state = ALL if is_main else NONE
        if node.parent >= 0:
            above = nodes[node.parent]
            above.state = node.state if above.state in (None, node.state) else SOME
    return nodes[0].state is not None


def labelled_tree(html: str, text: str | None) -> tuple[list[int], list[int], list[str]] | None:
    """(parents, states, what is seen) of the nodes of a labelled page; None for a page without labels."""
    nodes = tree(html)
    if not label(nodes, text):
        return None
    seen = ["\n".join(seen_of(n, nodes[n.parent])) if i else "" for i, n in enumerate(nodes)]
    return [n.parent for n in nodes], [n.state for n in nodes], seen


_LINKS = "".join(f'<li><a href="/{w}">{w}</a></li>' for w in ("Home", "News", "About us", "Contact"))
_TEASERS = "".join(f'<li><a href="/{i}">Another story that you may want to read</a></li>' for i in range(4))
_SAID = "Here is a remark of some length, which no author of this page has ever written."
# Variants of the parts of a page around the article; each page takes one of each.
_PARTS = {
    "top": [
        "",
        "<header><div class='logo'>Site name</div><p>The site for all of you</p></header>",
        "<div id='header'><h1>Site name</h1><p>The site for all of you</p></div>",
        "<header><h2><a href='/'>Site name</a></h2></header>",
        "<div class='masthead'><a href='/'>Site name</a></div>",
    ],
    "menu": [
        f"<nav><ul>{_LINKS}</ul></nav>",
        f"<div class='nav'>{_LINKS}</div>",
        f"<div role='navigation'><ul>{_LINKS}</ul></div>",
        f"<ul id='main-menu'>{_LINKS}</ul>",
        "<nav><a href='/'>Home</a> <a href='/news'>News</a></nav>",
        "<div class='breadcrumbs'><a href='/'>Home</a> / <a href='/news'>News</a></div>",
        f"<ul>{_LINKS}</ul>",
    ],
    "notice": [
        "",
        f"<div class='cookie-notice'><p>We use cookies on this site. {_SAID}</p><button>Yes</button></div>",
        f"<div id='consent' role='alert'>We care about your privacy. {_SAID}</div>",
        f"<div class='notice'>{_SAID}</div>",
        f"<section class='gdpr-banner'><p>{_SAID}</p></section>",
    ],
    "advert": [
        "",
        f"<div class='ad'>Buy this now. {_SAID}</div>",
        "<div class='ads'><p>Buy this now!</p></div>",
        f"<aside class='sponsored'><p>Paid for. {_SAID}</p></aside>",
        f"<div id='ad-banner'>{_SAID} {_SAID}</div>",
        "<div class='promo'><a href='/buy'>Buy this now</a></div>",
        f"<div class='advertisement'>{_SAID}</div>",
    ],
    "form": [
        "",
        "<form action='/s'><label>Search this site</label><input><p>Type a word.</p></form>",
        f"<form><p>{_SAID}</p><input type='submit'></form>",
        f"<div class='newsletter-signup'><p>Get our letter. {_SAID}</p></div>",
        "<form class='contact'><fieldset><legend>Write to us</legend><p>Your name</p></fieldset></form>",
    ],
    "side": [
        "",
        f"<aside><h3>Popular</h3><ul>{_TEASERS}</ul></aside>",
        f"<div id='sidebar'><h3>About</h3><p>{_SAID}</p></div>",
        f"<aside><p>{_SAID}</p></aside>",
        f"<div class='related'><h3>Related</h3><ul>{_TEASERS}</ul></div>",
        f"<div class='widget'><p>{_SAID} {_SAID}</p></div>",
        f"<ul>{_TEASERS}</ul>",
    ],
    "reader": [
        "",
        f"<section id='comments'><h2>Comments</h2><div class='comment'><p>Reader one</p><p>{_SAID}</p></div></section>",
        f"<div class='comments'><h3>2 replies</h3><p>{_SAID}</p><p>{_SAID} {_SAID}</p></div>",
        f"<ol class='commentlist'><li>{_SAID}</li><li>I agree.</li></ol>",
        f"<div id='disqus'><div class='reply'><p>{_SAID}</p></div></div>",
        f"<section class='comments'><article class='comment'><p>{_SAID}</p></article></section>",
    ],
    "foot": [
        f"<footer><p>&copy; 2020 The owners. All rights reserved.</p><ul>{_LINKS}</ul></footer>",
        f"<footer>&copy; The owners &middot; {_SAID}</footer>",
        "<div id='footer'>&copy; 2020 The owners. All rights reserved.</div>",
        f"<div class='footer'><p>{_SAID}</p><a href='/legal'>Legal</a></div>",
        "",
    ],
    "around": [
        "<article>{}</article>",
        "<main><article>{}</article></main>",
        "<div id='content'>{}</div>",
        "<div class='post'><div class='entry-content'>{}</div></div>",
        "<main>{}</main>",
        "<div>{}</div>",
        "<section>{}</section>",
        "<table><tr><td>{}</td></tr></table>",
        "<article class='post'><div class='article-body'>{}</div></article>",
        "<div class='story'>{}</div>",
    ],
}


def layouts(n: int = 240) -> list[tuple[str, str]]:
    """(html, main text) of ``n`` made-up pages: they join the variants above in ever other ways.

    They stand for the sites that a table lacks. Some have the remarks, a side box or an advert inside of
    the element of the article.
    """
    line = "Some words make up a line of plain prose, as writers do, and another clause follows it."
    out = []
    for i in range(n):
        part = {kind: forms[(i * (2 * k + 3) + i // 7) % len(forms)] for k, (kind, forms) in enumerate(_PARTS.items())}
        size = 1 + i % 5
        text = ["A title of some words", line, " ".join([line] * size), "So it is.", " ".join([line] * 2 * size)]
        html = "<p>{}</p><p>{}</p><p>{}</p><p>{}</p>"
        if i % 3 == 0:
            text += ["A heading inside", "One thing", line, "A word that someone said.", "And the end, with no stop"]
            html += "<h2>{}</h2><ul><li>{}</li><li>{}</li></ul><blockquote><p>{}</p></blockquote><p>{}</p>"
        elif i % 3 == 1:
            html = "<div>{}</div><div>{}</div><p>{}<br></p><div>{}</div>"
        if i % 8 in (5, 6):  # a short one
            text = ["Yes.", "It is."] if i % 8 == 5 else ["A title of some words", line]
            html = "<p>{}</p>"
        title = "<header><h1>{}</h1></header>" if i % 4 == 3 else "<h1>{}</h1>"
        main = (title + html).format(*text)
        side, advert, reader = part["side"], part["advert"], part["reader"]
        if i % 5 == 1:
            main, side = main + side, ""
        if i % 5 == 2:
            main, advert = main + advert + f"<p>{line}</p>", ""
        if i % 5 == 3:
            main, reader = main + reader, ""
        main = part["around"].format(main)
        rest = main + side + reader if i % 2 else side + main + reader
        if i % 7 == 6:
            rest = f"<div class='wrapper'>{rest}</div>"
        body = part["top"] + part["menu"] + part["notice"] + advert + part["form"] * (i % 2) + rest
        out.append((f"<body>{body}{part['form'] * (1 - i % 2)}{part['foot']}</body>", "\n".join(text)))
    return out


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


class Forest:
    """The trees of some pages side by side: parents, what is seen as numbers, and the nodes of every depth."""

    def __init__(self, parents: Sequence[Sequence[int]], seen: Sequence[Sequence[Sequence[int]]], run: int):
        above, depth, base = [], [], 0
        for tree_parents in parents:
            levels = []
            for p in tree_parents:
                levels.append(levels[p] + 1 if p >= 0 else 0)
                above.append(p + base if p >= 0 else -1)
            depth += levels
            base += len(tree_parents)
        self.above, depth = np.array(above, np.int64), np.array(depth, np.int64)
        flat = [s for page in seen for s in page]
        self.sizes = np.array([len(s) for s in flat], np.int64)
        self.seen = np.fromiter((x for s in flat for x in s), np.int64, int(self.sizes.sum()))
        self.node = np.repeat(np.arange(len(flat)), self.sizes)
        self.is_run = np.zeros(len(flat), bool)
        self.is_run[self.node[self.seen == run]] = True
        order = np.lexsort((self.above, depth))
        cuts = np.searchsorted(depth[order], np.arange(1, depth.max(initial=0) + 1))
        self.levels = np.split(order, cuts)
        # Children of a node lie side by side in their level, from these places on.
        self.first = [np.flatnonzero(np.diff(self.above[level], prepend=-2)) for level in self.levels]

    def marginals(self, weights: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """P(state) of every node and P(state of the parent, state) of every edge: messages up, then down.

        ``weights``: (things seen, states); ``edges``: (block or run, state above, state).
        """
        n = len(self.above)
        held = np.zeros((n, 3))  # what stands at and below a node says of its state, as logarithms
        for s in range(3):
            held[:, s] = np.bincount(self.node, weights[self.seen, s], n)
        held[self.is_run, SOME] = NEVER
        step = edges[self.is_run.astype(int)]
        up = np.zeros((n, 3))
        for level, first in zip(reversed(self.levels[1:]), reversed(self.first[1:])):
            up[level] = said = _log_sum(step[level] + held[level][:, None, :], 2)
            held[self.above[level[first]]] += np.add.reduceat(said, first)
        full, pairs = held.copy(), np.zeros((n, 3, 3))
        for level in self.levels[1:]:
            rest = full[self.above[level]] - up[level]
            joint = rest[:, :, None] + step[level] + held[level][:, None, :]
            joint -= _log_sum(_log_sum(joint, 2), 1)[:, None, None]
            pairs[level] = np.exp(joint)
            full[level] = _log_sum(joint, 1)
        root = self.levels[0]
        full[root] -= _log_sum(full[root], 1)[:, None]
        return np.exp(full), pairs


class Model:
    """The potentials: weights of what is seen for the three states, and of the states of parent and child."""

    def __init__(self, names: Sequence[str]):
        self.place = {name: i for i, name in enumerate(names)}
        self.weights, self.edges = np.zeros((len(names), 3)), np.zeros((2, 3, 3))

    def codes(self, seen: Iterable[str]) -> list[int]:
        """Numbers of what is seen; what no labelled page showed has no say."""
        return [self.place[s] for s in seen if s in self.place]

    def main_runs(self, pages: Sequence[list[Node]]) -> list[list[float]]:
        """P(main text) of the nodes of each page, for blocks that of all of it being main text."""
        seen = [[self.codes(seen_of(n, page[n.parent])) if i else [] for i, n in enumerate(page)] for page in pages]
        forest = Forest([[n.parent for n in page] for page in pages], seen, self.place["run"])
        chances = forest.marginals(self.weights, self.edges)[0][:, ALL].tolist()
        out, at = [], 0
        for page in pages:
            out.append(chances[at : at + len(page)])
            at += len(page)
        return out


def fit(sources: Iterable[Sequence[tuple[list[int], list[int], list[str]]]]) -> Model:
    """Weights from the labelled trees of each source; the sources weigh the same, whatever their size."""
    sources = [s for s in sources if s]
    trees = [t for s in sources for t in s]
    names = {"run", "block"} | {name for _, _, seen in trees for s in seen for name in s.split("\n") if name}
    model = Model(sorted(names))
    seen = [[model.codes(s.split("\n")) if s else [] for s in page] for _, _, page in trees]
    forest = Forest([parents for parents, _, _ in trees], seen, model.place["run"])
    total = [sum(len(states) for _, states, _ in s) for s in sources]
    share = np.concatenate([np.full(n, 1 / n) for n in total]) / len(sources)
    truth = np.array([x for _, states, _ in trees for x in states], np.int64)
    below = forest.above >= 0
    true_node = np.eye(3)[truth]
    true_pair = true_node[forest.above][:, :, None] * true_node[:, None, :]
    kinds = [below & forest.is_run, below & ~forest.is_run]
    params = [model.weights, model.edges]
    means, squares = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for round_ in range(1, ROUNDS + 1):
        chances, pairs = forest.marginals(model.weights, model.edges)
        missed = (true_node - chances) * share[:, None]
        slope = np.zeros_like(model.weights)
        for s in range(3):
            slope[:, s] = np.bincount(forest.seen, missed[forest.node, s], len(slope))
        turn = np.zeros_like(model.edges)
        for kind, rows in ((1, kinds[0]), (0, kinds[1])):
            turn[kind] = ((true_pair[rows] - pairs[rows]) * share[rows, None, None]).sum(0)
        for i, step in enumerate((slope, turn)):
            step -= DECAY * params[i]
            means[i] = 0.9 * means[i] + 0.1 * step
            squares[i] = 0.99 * squares[i] + 0.01 * step * step
            mean, square = means[i] / (1 - 0.9**round_), squares[i] / (1 - 0.99**round_)
            params[i] += RATE * (1 - round_ / (ROUNDS + 1)) * mean / (np.sqrt(square) + 1e-8)
    return model


def sampled(pages: DataFrame, most: int = SAMPLE, chars: int = SAMPLE_CHARS) -> list[tuple]:
    """Labelled trees of at most ``most`` pages that name their article, of at most ``chars`` characters each.

    Those with the smallest hashes of their html, so the sample does not depend on the order of the rows.
    """
    html = F.col("html")
    low = F.lower(html)
    named = F.contains(low, F.lit("<article")) | F.contains(low, F.lit("<main"))
    chosen = pages.select(html).where(named & (F.length("html") <= chars))
    chosen = chosen.select("html", F.xxhash64("html").alias("hash")).orderBy("hash").limit(most).select("html")

    def make():
        def f(html):
            found = labelled_tree(html, None)
            return [] if found is None else [found]

        return f

    return [tuple(r) for r in map_rows(chosen, make, TREES).collect()]


def learn(pages: DataFrame | None = None, labelled: Iterable[tuple[str, str]] | None = None) -> Model:
    """A model from ``labelled`` pages (html, main text), :func:`layouts` by default, and :func:`sampled` ``pages``."""
    made_up = [labelled_tree(html, text) for html, text in (layouts() if labelled is None else labelled)]
    return fit([[t for t in made_up if t], sampled(pages) if pages is not None else []])


def main_text(pages: DataFrame, model: Model | None = None, least: float = 0.5) -> DataFrame:
    """(page_id, url, text, n_chars, n_runs, n_main) of every page, from its whole html.

    ``text`` are the runs of text whose marginal probability is at least ``least``, in page order, one a line, with character
    references decoded and white space as single spaces; ``n_runs`` counts all runs. Without ``model``,
    :func:`learn` makes one from these pages. A null or empty page, one without markup of an article or
    without any text is no error: its text is what the model takes for main text, mostly none. Repeated
    rows and null ids give a row each; other columns are left behind.
    """
    model = learn(pages) if model is None else model

    def make():
        def f(ids, urls, htmls):
            trees = [tree(html or "") for html in htmls]
            for page_id, url, nodes, chances in zip(ids, urls, trees, model.main_runs(trees)):
                runs = [(node.text, p) for node, p in zip(nodes, chances) if node.text is not None]
                main = [text for text, p in runs if p >= least]
                text = "\n".join(main)
                yield page_id, url, text, len(text), len(runs), len(main)

        return f

    rows = pages.select("page_id", "url", "html")
    schema = StructType(
        [
            StructField("page_id", rows.schema["page_id"].dataType),
            StructField("url", rows.schema["url"].dataType),
            StructField("text", StringType()),
            *[StructField(c, LongType()) for c in ("n_chars", "n_runs", "n_main")],
        ]
    )
    return map_slices(rows, make, schema)

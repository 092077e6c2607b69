"""Main text of web pages by a tree-structured graphical model.

Every block element of a page is content or not. Its own features speak for either, and parent and child speak for
each other by potentials of their pair. Messages from the leaves up and from the root down (sum-product) give each
element its exact marginal; the text of elements that are likelier content than not is the main text. The weights are
learned by maximum likelihood from labelled pages.
"""

from __future__ import annotations

import math
import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tesselar.llm.html_tree import Tree, parse

TAG_GROUPS = {
    "paragraph": "p blockquote pre figcaption address",
    "heading": "h1 h2 h3 h4 h5 h6",
    "item": "li dd dt",
    "list": "ul ol dl menu",
    "cell": "td th caption tr tbody thead tfoot table",
    "article": "article main",
    "nav": "nav",
    "header": "header hgroup",
    "footer": "footer",
    "aside": "aside dialog details summary",
    "form": "form fieldset legend option",
}
NAME_GROUPS = {
    "menu": "nav menu navbar navigation breadcrumb breadcrumbs toolbar tabs pagination pager skip toc",
    "head": "header masthead topbar logo brand branding",
    "foot": "footer copyright colophon legal bottom contentinfo",
    "side": "sidebar aside widget related recommended share social tags popular trending rail complementary more",
    "notice": "cookie cookies consent notice alert popup modal newsletter subscribe gdpr banner warning message overlay paywall toast",
    "advert": "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion adsense",
    "reader": "comment comments reply replies discussion disqus respond feedback review reviews",
    "entry": "form search login signup register signin",
    "content": "content article post entry story text main body prose page",
    "hidden": "hidden",
}
_TAG = {tag: at for at, tags in enumerate(TAG_GROUPS.values()) for tag in tags.split()}
_NAME = {name: at for at, names in enumerate(NAME_GROUPS.values()) for name in names.split()}
N_TAGS, N_NAMES = len(TAG_GROUPS) + 1, len(NAME_GROUPS)
N_OWN = 8
#: Characters beyond which more text says nothing more.
LONG = 1_000
N_FEATURES = 2 * (N_TAGS + N_NAMES) + N_OWN + 1


def element_features(tree: Tree) -> np.ndarray:
    """One row per element: tag and name groups, its own text, the text below it, the groups above it, a constant."""
    n = len(tree.tag)
    own, own_link, below, below_link, stops = (np.zeros(n) for _ in range(5))
    for element, text, link_chars in tree.segments:
        own[element] += len(text)
        own_link[element] += min(link_chars, len(text))
        stops[element] += text.count(". ") + text.count(", ") + text.endswith((".", "!", "?", "…", ":"))
    below += own
    below_link += own_link
    for at in range(n - 1, 0, -1):
        below[tree.parent[at]] += below[at]
        below_link[tree.parent[at]] += below_link[at]
    x = np.zeros((n, N_FEATURES))
    for at in range(n):
        x[at, _TAG.get(tree.tag[at], N_TAGS - 1)] = 1
        for name in tree.names[at]:
            if name in _NAME:
                x[at, N_TAGS + _NAME[name]] = 1
    first = N_TAGS + N_NAMES
    x[:, first] = own > 0
    x[:, first + 1] = np.log1p(np.minimum(own, LONG)) / 5
    x[:, first + 2] = own_link / np.maximum(own, 1)
    x[:, first + 3] = np.minimum(stops, 5) / 5
    x[:, first + 4] = np.log1p(np.minimum(below, LONG)) / 5
    x[:, first + 5] = below_link / np.maximum(below, 1)
    x[:, first + 6] = below / max(below[0], 1)
    x[:, first + 7] = (own > 0) & (own < 40)
    groups = N_TAGS + N_NAMES
    above = x[:, first + N_OWN : -1]
    for at in range(1, n):
        np.maximum(above[tree.parent[at]], x[tree.parent[at], :groups], out=above[at])
    x[:, -1] = 1
    return x


class TreeModel:
    """``unary``: weights of the log odds of content; ``pair``: by tag group of the child, potentials [parent, child]."""

    def __init__(self, unary: np.ndarray, pair: np.ndarray):
        self.unary, self.pair = unary, pair

    def marginals(self, tree: Tree, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        """Probability of content per element, of each [parent, child] pair, and the log partition sum."""
        n = len(tree.tag)
        field = (x @ self.unary).tolist()
        pair = [self.pair[_TAG.get(tag, N_TAGS - 1)] for tag in tree.tag]
        pair = [(float(p[0, 0]), float(p[0, 1]), float(p[1, 0]), float(p[1, 1])) for p in pair]
        # Log messages: up[at] is (for parent 0, for parent 1); low/high gather what children sent.
        low, high = [0.0] * n, list(field)
        up = [(0.0, 0.0)] * n
        for at in range(n - 1, 0, -1):
            a, b, c, d = pair[at]
            up[at] = (_log_sum(a + low[at], b + high[at]), _log_sum(c + low[at], d + high[at]))
            low[tree.parent[at]] += up[at][0]
            high[tree.parent[at]] += up[at][1]
        total = _log_sum(low[0], high[0])
        down = [(0.0, 0.0)] * n
        p = np.empty(n)
        edges = np.zeros((n, 2, 2))
        p[0] = math.exp(high[0] - total)
        for at in range(1, n):
            over, (a, b, c, d) = tree.parent[at], pair[at]
            out_low = low[over] + down[over][0] - up[at][0]
            out_high = high[over] + down[over][1] - up[at][1]
            down[at] = (_log_sum(a + out_low, c + out_high), _log_sum(b + out_low, d + out_high))
            p[at] = math.exp(high[at] + down[at][1] - total)
            edges[at] = (
                (math.exp(out_low + a + low[at] - total), math.exp(out_low + b + high[at] - total)),
                (math.exp(out_high + c + low[at] - total), math.exp(out_high + d + high[at] - total)),
            )
        return p, edges, total

    def text(self, page: str | None) -> str:
        tree = parse(page)
        if not tree.segments:
            return ""
        p = self.marginals(tree, element_features(tree))[0]
        return "\n\n".join(text for element, text, _ in tree.segments if p[element] >= 0.5)


def _log_sum(a: float, b: float) -> float:
    high, low = (a, b) if a > b else (b, a)
    return high + math.log1p(math.exp(low - high))


def fit(pages: list[tuple[Tree, np.ndarray]], steps: int = 100, rate: float = 0.15, l2: float = 1e-4) -> TreeModel:
    """Adam on the log likelihood of the labels; the gradient is observed minus expected counts."""
    model = TreeModel(np.zeros(N_FEATURES), np.zeros((N_TAGS, 2, 2)))
    data = []
    for tree, y in pages:
        groups = np.array([_TAG.get(tag, N_TAGS - 1) for tag in tree.tag])
        observed = np.zeros((len(y), 2, 2))
        for at in range(1, len(y)):
            observed[at, y[tree.parent[at]], y[at]] = 1
        data.append((tree, y, element_features(tree), groups, observed))
    elements = sum(len(y) for _, y, *_ in data)
    m1, v1, m2, v2 = (np.zeros_like(z) for z in (model.unary, model.unary, model.pair, model.pair))
    for step in range(1, steps + 1):
        g1, g2 = -l2 * model.unary, -l2 * model.pair
        for tree, y, x, groups, observed in data:
            p, edges, _ = model.marginals(tree, x)
            g1 = g1 + x.T @ (y - p) / elements
            gained = np.zeros_like(model.pair)
            np.add.at(gained, groups[1:], (observed - edges)[1:])
            g2 = g2 + gained / elements
        m1, v1 = 0.9 * m1 + 0.1 * g1, 0.99 * v1 + 0.01 * g1 * g1
        m2, v2 = 0.9 * m2 + 0.1 * g2, 0.99 * v2 + 0.01 * g2 * g2
        model.unary = model.unary + rate * (m1 / (1 - 0.9**step)) / (np.sqrt(v1 / (1 - 0.99**step)) + 1e-8)
        model.pair = model.pair + rate * (m2 / (1 - 0.9**step)) / (np.sqrt(v2 / (1 - 0.99**step)) + 1e-8)
    return model


def labelled_pages(n: int = 160, seed: int = 11) -> list[tuple[str, str]]:
    """Training pages: html in which content stands in elements named by the attribute ``aria-label="gold"``.

    Layouts, names and texts are drawn at random from common ones, with and without semantic elements and names.
    """
    rng = random.Random(seed)
    syllables = "ta re mi on ka lu se no ver ti ma du pel or in ast".split()
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randint(1, 3)))

    def sentence(low: int = 5, high: int = 18) -> str:
        words = [word() + ("," if rng.random() < 0.1 else "") for _ in range(rng.randint(low, high))]
        return " ".join(words).capitalize() + rng.choice(["."] * 6 + ["!", "?", " ***.", "!!"])

    def prose() -> str:
        pick = rng.random()
        if pick < 0.06:
            return " ".join([word()] * rng.randint(5, 400))
        if pick < 0.12:
            return " | ".join(word() for _ in range(rng.randint(4, 60)))
        if pick < 0.18:
            return " ".join(word() for _ in range(rng.randint(2, 300)))
        if pick < 0.26:
            return " ".join(sentence(1, 3) for _ in range(rng.choice([1, 2, 5])))
        text = " ".join(sentence() for _ in range(rng.choice([1, 1, 2, 3, 4, 6, 30])))
        return text.upper() if pick < 0.3 else text

    def links(k: int) -> str:
        return "".join(f'<li><a href="/{word()}">{word()}</a></li>' for _ in range(k))

    def box(tags: str, names: str, inner: str) -> str:
        tag, name = rng.choice(tags.split()), rng.choice(names.split())
        how = rng.choice([f' class="{name}"', f' id="{name}"', f' class="{name} x{word()}"', "" if tag != "div" else f' class="{name}"'])
        return f"<{tag}{how}>{inner}</{tag}>"

    def gold(tag: str, inner: str) -> str:
        return f'<{tag} aria-label="gold">{inner}' + (f"</{tag}>" if tag != "p" or rng.random() < 0.8 else "")

    def paragraph() -> str:
        text = prose()
        pick = rng.random()
        if pick < 0.15:
            text = f"<b>{text}" + ("</b>" if rng.random() < 0.5 else "<br>")
        elif pick < 0.3:
            text += f' <a href="#">{word()} {word()}</a> {sentence()}'
        return gold("p", text)

    pages = []
    for _ in range(n):
        body = [gold("h1", sentence(2, 9))] if rng.random() < 0.9 else []
        for _ in range(rng.randint(1, 8) if rng.random() < 0.8 else rng.randint(20, 80)):
            pick = rng.random()
            if pick < 0.7:
                body.append(paragraph())
            elif pick < 0.78:
                body.append(gold(rng.choice(["h2", "h3"]), sentence(1, 6)))
            elif pick < 0.86:
                body.append(f"<{(t := rng.choice(['ul', 'ol']))}>" + "".join(gold("li", sentence()) for _ in range(rng.randint(2, 4))) + f"</{t}>")
            elif pick < 0.9:
                body.append(gold("blockquote", prose()))
            elif pick < 0.94:
                cells = "".join("<tr>" + "".join(gold("td", sentence(1, 5)) for _ in range(3)) + "</tr>" for _ in range(rng.randint(2, 4)))
                body.append(f"<table>{cells}</table>")
            elif pick < 0.97:
                body.append(gold("pre", prose()))
            else:
                body.append(box("div aside ins", "ad ads advert sponsored promo", sentence()))
        if rng.random() < 0.2:
            body.append(box("div aside", "share social related tags", f"<ul>{links(3)}</ul>"))
        if rng.random() < 0.08:
            brief = sentence(1, 3)
            body = [gold("h1", brief), gold("p", brief)]
        main = rng.choice(["article", "article", "article", "main", "div", "section"])
        name = rng.choice(["", ' class="content"', ' id="main"', ' class="post-body"', ' class="entry"', ' class="story"'])
        if main in ("div", "section") and not name:
            name = ' class="article-text"'
        inner = f"<{main}{name}>{''.join(body)}</{main}>"
        if rng.random() < 0.3:
            inner = f'<div class="{rng.choice(["wrapper", "container", "page", "row", "grid"])}">{inner}</div>'
        before, after = [], []
        if rng.random() < 0.8:
            before.append(box("nav nav div ul", "nav menu navbar breadcrumbs", f"<ul>{links(rng.randint(3, 7))}</ul>"))
        if rng.random() < 0.4:
            before.append(box("header header div", "header masthead topbar", rng.choice([sentence(1, 4), f"<h2>{sentence(1, 4)}</h2><p>{sentence(2, 8)}</p>"])))
        if rng.random() < 0.6:
            before.append(box("div div aside", "ad ads advert sponsored", sentence() if rng.random() < 0.6 else prose()))
        if rng.random() < 0.4:
            notice = f"<p>{prose()}</p>" if rng.random() < 0.5 else prose()
            rng.choice([before, after]).append(box("div div section aside", "cookie-notice consent notice alert newsletter popup", notice))
        if rng.random() < 0.4:
            side = f"<h3>{sentence(1, 3)}</h3><ul>{links(4)}</ul>" if rng.random() < 0.5 else f"<p>{prose()}</p>"
            rng.choice([before, after]).append(box("aside aside div", "sidebar widget related rail", side))
        if rng.random() < 0.3:
            after.append(box("form form div", "search login signup form", f"<label>{sentence(1, 3)}</label><input><p>{sentence(3, 9)}</p><button>{word()}</button>"))
        if rng.random() < 0.5:
            kind = rng.choice(["p", "li", "div"])
            said = "".join(f'<{kind} class="comment"><p>{prose()}</p></{kind}>' if rng.random() < 0.5 else f"<{kind}>{prose()}</{kind}>" for _ in range(rng.choice([1, 2, 3, 5, 8, 20, 40])))
            said = f"<h3>{word()}</h3>{said}"
            after.append(box("section div ol", "comments discussion replies reviews", said))
        if rng.random() < 0.8:
            foot = rng.choice([f"&copy; {word()}.example &middot; {sentence()}", f"<p>&copy; {word()} {sentence()}</p>", f"<ul>{links(4)}</ul><p>{prose()}</p>", prose()])
            after.append(box("footer footer div", "footer copyright colophon", foot))
        rng.shuffle(before)
        pages.append((f"<html><head><title>{sentence()}</title></head><body>{''.join(before)}{inner}{''.join(after)}</body></html>", main))
    return pages


def training_set(pages: list[tuple[str, str]]) -> list[tuple[Tree, np.ndarray]]:
    """Trees with labels: 1 for content, and for elements most of whose text below is content."""
    result = []
    for page, _ in pages:
        tree = parse(page)
        n = len(tree.tag)
        gold = np.array(["gold" in names for names in tree.names])
        tree.names = [names - {"gold"} for names in tree.names]
        size, good = np.zeros(n), np.zeros(n)
        for element, text, _ in tree.segments:
            size[element] += len(text)
            good[element] += len(text) * gold[element]
        for at in range(n - 1, 0, -1):
            size[tree.parent[at]] += size[at]
            good[tree.parent[at]] += good[at]
        result.append((tree, (gold | (good > size / 2)).astype(int)))
    return result


def train() -> TreeModel:
    return fit(training_set(labelled_pages()))


def _texts(unary: np.ndarray, pair: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = TreeModel(unary, pair)
        for batch in batches:
            texts = [model.text(page) for page in batch.column("html").to_pylist()]
            columns = [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])

    return run


def extract(pages: DataFrame, model: TreeModel | None = None) -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` of every row of ``pages``.

    A null or empty page, and one without content, has the empty text. Repeated rows and null ids are kept one to
    one; other columns are ignored.
    """
    model = model or train()
    rows = pages.select("page_id", "url", "html")
    return rows.mapInArrow(_texts(model.unary, model.pair), "page_id long, url string, text string, n_chars long")


def op9_html_extraction(spark, sf_dir: str) -> DataFrame:
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))

"""Main text of pages by a tree-structured graphical model.

Method: every node of the page's tree (elements and text runs) has a binary
variable, content or not. A node's own potential comes from its features (tag,
words of its class, id and role, length and link share of its text) by
logistic regression; parent-child potentials are the smoothed conditional
frequencies of a child's label given its parent's. Sum-product messages go
upward and then downward, which is exact on a tree, and give each node's
marginal; text runs with a marginal of a half or more are the content.

Both potentials are trained from labelled pages: the skeletons below, labelled
by hand (attribute ``y``), and pages of the table whose own markup names the
article, labelled by that markup.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from math import exp, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import pick, sampled, text_slices
from ledgerloom.llm.dom import WORD, Node, blocks, parse

#: Pages (about) of the table that are labelled by their markup for training.
LABELLED_PAGES = 400

KINDS = {
    "article": "article main", "nav": "nav menu", "header": "header", "footer": "footer", "aside": "aside",
    "form": "form fieldset dialog legend", "heading": "h1 h2 h3 h4 h5 h6 hgroup", "paragraph": "p blockquote pre",
    "list": "ul ol dl dir", "item": "li dt dd", "table": "table tbody thead tfoot tr td th caption",
    "figure": "figure figcaption", "box": "div section center details summary address", "page": "#page html body",
}
KIND = {tag: kind for kind, tags in KINDS.items() for tag in tags.split()}

# Words of classes, ids and roles that name what an element is.
NAMES = {
    "advert": "ad ads adv advert adverts advertisement advertising banner promo promoted promotion sponsor sponsored "
              "sponsors outbrain taboola adsense commercial",
    "menu": "nav navbar navigation menu menubar breadcrumb breadcrumbs pagination pager tabs toc sitemap skip skiplink",
    "head": "header masthead topbar logo branding",
    "foot": "footer foot copyright legal bottom colophon",
    "side": "sidebar side aside related recommended recommendations popular trending widget widgets rail complementary "
            "more teaser teasers",
    "comments": "comment comments commentlist reply replies respond discussion disqus feedback reviews commenter thread",
    "notice": "notice notices cookie cookies consent gdpr alert alerts popup modal overlay newsletter subscribe "
              "subscription signup paywall toast message disclaimer warning",
    "share": "share sharing social socials tweet follow tags tag byline author meta login search searchform",
    "content": "content article post entry story body text main maincontent articlebody prose copy",
}
NAMED = {word: group for group, words in NAMES.items() for word in words.split()}
FEATURES = ["bias", *(f"kind {k}" for k in (*KINDS, "inline")), *(f"named {g}" for g in NAMES), "hidden",
            "header of the page", "text", *(f"words {k}" for k in range(3)), *(f"linked {k}" for k in range(3)), "ends as a sentence",
            *(f"in {k}" for k in ("heading", "paragraph", "item", "list", "table", "box", "page", "inline"))]
AT = {f: k for k, f in enumerate(FEATURES)}


@lru_cache(maxsize=50_000)
def _named(source: str) -> tuple[str, ...]:
    return tuple({NAMED[w] for w in map(str.lower, WORD.findall(source)) if w in NAMED})


def inside_article(nodes: list[Node], k: int) -> bool:
    while (k := nodes[k].parent) >= 0:
        if nodes[k].tag in ("article", "main"):
            return True
    return False


def features(nodes: list[Node], k: int) -> list[int]:
    node = nodes[k]
    if node.tag != "#text":
        out = [AT["bias"], AT[f"kind {KIND.get(node.tag, 'inline')}"]]
        if node.tag == "header" and not inside_article(nodes, k):
            out.append(AT["header of the page"])
        a = node.attributes
        if a:
            out += [AT[f"named {g}"] for g in _named(" ".join((a.get("class", ""), a.get("id", ""), a.get("role", ""))))]
            if "hidden" in a or a.get("aria-hidden") == "true" or "display:none" in a.get("style", "").replace(" ", ""):
                out.append(AT["hidden"])
        return out
    share = node.linked / max(node.words, 1)
    last = node.text[-1].rstrip()[-1:] if node.text else ""
    inside = KIND.get(nodes[node.parent].tag, "inline")
    inside = f"in {inside}"
    return [AT["bias"], AT["text"],
            AT[f"words {0 if node.words < 20 else 1 if node.words < 60 else 2}"],
            AT[f"linked {0 if share < 0.2 else 1 if share < 0.6 else 2}"],
            *([AT["ends as a sentence"]] if last and last in ".!?…:;\"”»)" else []),
            *([AT[inside]] if inside in AT else [])]


@dataclass
class Model:
    weights: list[float]
    child: list[list[float]]  # P(child's label | parent's label)

    def marginals(self, nodes: list[Node], active: list[list[int]] | None = None) -> list[float]:
        """P(content) of each node by sum-product on the tree; ``active``:
        the nodes' features, where they are known already."""
        n = len(nodes)
        w, ((p00, p01), (p10, p11)) = self.weights, self.child
        # own[k]: log odds of the node's potential; up[k]: with its children's messages
        active = active or [features(nodes, k) for k in range(n)]
        own = [max(-30.0, min(30.0, sum(map(w.__getitem__, a)))) for a in active]
        up, message = own[:], [0.0] * n
        for k in range(n - 1, 0, -1):
            e = exp(max(-300.0, min(300.0, up[k])))
            message[k] = log((p10 + p11 * e) / (p00 + p01 * e))
            up[nodes[k].parent] += message[k]
        total = up[:]
        for k in range(1, n):
            # what the parent believes without this child
            e = exp(max(-300.0, min(300.0, total[nodes[k].parent] - message[k])))
            total[k] += log((p01 + p11 * e) / (p00 + p10 * e))
        return [1 / (1 + exp(-max(-300.0, min(300.0, t)))) for t in total]

    def text(self, page: str) -> str:
        nodes = parse(page)
        content = self.marginals(nodes)
        return "\n".join(blocks(nodes, lambda k: content[k] >= 0.5))


def markup_labels(nodes: list[Node]) -> list[int] | None:
    """Labels by what the markup says; None when it names no article."""
    if not any(n.tag in ("article", "main") for n in nodes):
        return None
    bad = {"nav", "footer", "aside", "form"}
    labels: list[int] = []
    for node in nodes:
        above = labels[node.parent] if node.parent >= 0 else 0
        names = _named(" ".join(node.attributes.get(a, "") for a in ("class", "id", "role"))) if node.attributes else ()
        if KIND.get(node.tag) in bad or node.tag == "header" and not above or any(g != "content" for g in names):
            labels.append(0)
        else:
            labels.append(1 if node.tag in ("article", "main") else above)
    return labels


def hand_labels(nodes: list[Node]) -> list[int]:
    labels: list[int] = []
    for node in nodes:
        y = node.attributes.get("y")
        labels.append(int(y) if y is not None else labels[node.parent] if node.parent >= 0 else 0)
    return labels


_LONG = "A paragraph of the article that goes on for a good while, as paragraphs of articles do, and tells the reader what happened."
_SHORT = "A short remark of the article."
_LINK = '<li><a href="/x">Some topic</a></li>'
_PLAIN = "<p>{}</p>".format(_LONG)
_BODY = f"<h1>A heading of the article</h1>{_PLAIN * 3}<p>{_SHORT}</p><h2>Part</h2><ul><li>{_SHORT}</li><li>{_LONG}</li></ul>{_PLAIN}"
_QUOTE = f"<blockquote><p>{_LONG}</p></blockquote><figure><figcaption>{_SHORT}</figcaption></figure><p>See <a href='/y'>this</a>.</p>"
_COMMENT = f'<div class="comment"><p>I liked this a lot, thank you for writing it down for all of us here.</p><p>{_SHORT}</p></div>'
_AROUND = [
    f'<nav y="0"><ul>{_LINK * 6}</ul></nav>', f'<div class="menu" y="0"><ul>{_LINK * 4}</ul></div>',
    f'<header y="0"><h1>The Site</h1><p>{_SHORT}</p></header>', f'<div id="header" y="0"><h2>The Site</h2><p>{_SHORT}</p></div>',
    f'<footer y="0">&copy; The Site. All rights reserved. {_SHORT}</footer>', f'<div class="footer" y="0"><p>{_SHORT}</p></div>',
    f'<aside y="0"><h3>Related</h3><p>{_LONG}</p><ul>{_LINK * 3}</ul></aside>',
    f'<div class="sidebar" y="0"><h3>Popular</h3><p>{_LONG}</p><ul>{_LINK * 3}</ul></div>',
    f'<div class="ad" y="0">{_LONG}</div>', f'<div class="advert" y="0"><p>{_SHORT}</p></div>', f'<section class="promo" y="0"><p>{_LONG}</p></section>',
    f'<div class="cookie-notice" y="0"><p>{_LONG}</p></div>', f'<div class="notice" y="0">{_SHORT}</div>', f'<div id="newsletter" y="0"><p>{_SHORT}</p></div>',
    f'<form y="0"><p>{_SHORT}</p><label>Your name</label></form>',
    f'<section class="comments" y="0"><h3>Comments</h3>{_COMMENT * 3}</section>',
    f'<div id="comments" y="0"><h2>3 replies</h2><ol><li><p>{_LONG}</p></li><li><p>{_SHORT}</p></li></ol></div>',
    '<div class="share" y="0"><a href="/s">Share this</a></div>',
]
_ARTICLES = [
    f'<article y="1">{_BODY}{{inside}}{_PLAIN}</article>', f'<main y="1">{_BODY}{_QUOTE}{{inside}}</main>',
    f'<main y="1"><article y="1">{_BODY}</article>{{inside}}</main>', f'<div class="content" y="1">{_BODY}{{inside}}{_QUOTE}</div>',
    f'<div id="main" y="1"><div class="post" y="1">{_BODY}{{inside}}</div></div>', f'<div y="1">{_PLAIN * 4}{{inside}}{_QUOTE}</div>',
    f'<article y="1"><h1>A heading</h1><p>{_SHORT}</p>{{inside}}</article>', f'<div class="entry-content" y="1"><p>{_LONG}<br>{_LONG}</p>{{inside}}</div>',
    f'<article y="1"><header y="1"><h1>A heading of the article</h1></header><section y="1">{_PLAIN * 2}</section>{{inside}}</article>',
    f'<article y="1"><p>{_SHORT}</p></article>{{inside}}', f'<main y="1"><h1>Word</h1><p>Word</p></main>{{inside}}',
    f'<article y="1"><h1>Word word</h1><p>{_LONG * 9}</p></article>{{inside}}', '<article y="1"><h1>Word</h1></article>{inside}',
    f'<article y="1"><h1>Word</h1>{"<p>Word word.</p>" * 40}</article>{{inside}}', f'<main y="1">{"<p>Word</p>" * 20}{{inside}}</main>',
]


def skeletons() -> Iterator[str]:
    """Hand-labelled pages: every article among all that stands around it."""
    for a, article in enumerate(_ARTICLES):
        for k, one in enumerate(_AROUND):
            two, three = _AROUND[(k + 3 + a) % len(_AROUND)], _AROUND[(k + 7) % len(_AROUND)]
            inside = one if (a + k) % 2 else ""
            yield f"<html><body>{two}{'' if inside else one}{article.format(inside=inside)}{three}</body></html>"
    yield "<html><body>" + "".join(f'<p y="1">{_LONG}</p>' for _ in range(5)) + "</body></html>"


def train(labelled: list[tuple[list[Node], list[int]]], turns: int = 400, decay: float = 1e-3,
          joint_turns: int = 60) -> Model:
    """Own potentials by logistic regression, parent-child ones by counting;
    then the own ones again on all pages, by the likelihood of the whole tree
    (its gradient: labels less marginals)."""
    counts: dict[tuple[tuple[int, ...], int], int] = {}
    pairs = np.ones((2, 2))
    for nodes, labels in labelled:
        for k, y in enumerate(labels):
            key = tuple(sorted(set(features(nodes, k)))), y
            counts[key] = counts.get(key, 0) + 1
            if k:
                pairs[labels[nodes[k].parent], y] += 1
    x = np.zeros((len(counts), len(FEATURES)))
    for row, (active, _) in enumerate(counts):
        x[row, list(active)] = 1
    y = np.array([k[1] for k in counts], dtype=float)
    # rows of a kind that is common in the pages do not drown the rare ones
    weight = np.sqrt(np.array(list(counts.values()), dtype=float))
    weight /= weight.sum()
    w = np.zeros(len(FEATURES))
    speed = np.full(len(FEATURES), 1e-8)
    for _ in range(turns):
        p = 1 / (1 + np.exp(-(x * w).sum(axis=1)))
        slope = (x * ((p - y) * weight)[:, None]).sum(axis=0) + decay * w / len(FEATURES)
        speed += slope**2
        w -= 0.5 * slope / np.sqrt(speed)
    child = pairs / pairs.sum(axis=1, keepdims=True)
    # a label must stay movable by a node's own evidence
    child = np.clip(child, [[0.02], [0.05]], [[0.98], [0.95]])
    model = Model(w.tolist(), child.tolist())
    some = [(nodes, labels, [features(nodes, k) for k in range(len(nodes))]) for nodes, labels in labelled]
    speed = np.full(len(FEATURES), 1e-8)
    for turn in range(joint_turns):
        slope = np.zeros(len(FEATURES))
        for nodes, labels, active in some:
            for a, p, y in zip(active, model.marginals(nodes, active), labels):
                for f in a:
                    slope[f] += (p - y) / len(nodes)
        slope = slope / len(some) + decay * w / len(FEATURES)
        speed = 0.9 * speed + 0.1 * slope**2
        w -= 0.3 * (1 - turn / joint_turns) * slope / np.sqrt(speed + 1e-10)
        model.weights = w.tolist()
    return model


def fit(pages: DataFrame, labelled_pages: int = LABELLED_PAGES) -> Model:
    """The model from the skeletons and about ``labelled_pages`` pages
    (columns id, html), taken by a hash, that their markup labels."""
    labelled = [(nodes, hand_labels(nodes)) for nodes in map(parse, skeletons())]
    n = pages.count()
    if n and labelled_pages:
        share = min(1.0, labelled_pages / n)
        some = pages.where(sampled(share, "id", "url"))
        for batch in some.select("html").toLocalIterator():
            nodes = parse(batch["html"] or "")
            if labels := markup_labels(nodes):
                labelled.append((nodes, labels))
    return train(labelled)


def extract(df: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html",
            labelled_pages: int = LABELLED_PAGES) -> DataFrame:
    """The main text of every page.

    Returns ``id_column``, ``url_column`` and text, a row for each input row
    (rows that repeat give equal texts). Blocks stand in page order, joined by
    one line end; white space inside a block is one space; character
    references are decoded. A null or empty page, or one without content, has
    the empty text; null ids and urls stay null. Any length of page is read
    whole, in time that grows with its length. Tables without rows give no
    rows.
    """
    rows = pick(df, id=id_column, url=url_column, html=html_column)
    model = df.sparkSession.sparkContext.broadcast(fit(rows, labelled_pages))
    kinds = [df.schema[c].dataType.simpleString() for c in (id_column, url_column)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        text = model.value.text
        for whole in batches:
            for batch in text_slices(whole, "html"):
                found = [text(h or "") for h in batch.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), batch.column("url"), pa.array(found, pa.string())], names=["id", "url", "text"])

    return (rows.mapInArrow(run, f"id {kinds[0]}, url {kinds[1]}, text string")
            .withColumnsRenamed({"id": id_column, "url": url_column}))

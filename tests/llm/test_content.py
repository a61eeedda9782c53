"""Main text extraction: parsing, exact marginals, labelled pages."""

import itertools

import numpy as np
import time

import pytest

from ledgerloom.llm import content
from ledgerloom.llm.common import read
from ledgerloom.llm.dom import blocks, parse


@pytest.fixture(scope="module")
def model():
    return content.train([(nodes, content.hand_labels(nodes)) for nodes in map(parse, content.skeletons())])


def text_of(page):
    return "\n".join(blocks(parse(page), lambda k: True))


@pytest.mark.parametrize("page, text", [
    ("<p>a<p>b</div>c", "a\nbc"), ("<p>a <b>b</b>c<br>d</p>", "a bc d"), ("a &lt;b&gt; &amp;amp; &eacute;&#x41;", "a <b> &amp; éA"),
    ("<script>x='<p>no</p>'</script>yes<style>p{}</style>", "yes"), ("<!-- <p>no</p> -->yes", "yes"), ("<ul><li>a<li>b</ul>", "a\nb"),
    ("<head><title>no</title></head><body>yes", "yes"), ("x < y <3 &", "x < y <3 &"), ("<p title='a>b'>c", "c"), ("<p>unclosed <b", "unclosed <b"),
    ("<table><tr><td>a<td>b<tr><td>c</table>", "a\nb\nc"), (" \n ", ""), ("", ""), ("<div>a<p>b</p>c</div>", "a\nb\nc"),
    ("<form>a<textarea><p>no</textarea><select><option>no</select></form>b", "a\nb"), ("<p>a \t\n b</p>", "a b"), ("</p>a</b></i>", "a"),
])
def test_blocks(page, text):
    assert text_of(page) == text


def test_deep_and_long_pages_are_read_whole(model):
    assert text_of("<div>" * 3000 + "deep") == "deep"
    long = "<article>" + "<p>A sentence of the article.</p>" * 5000 + "</article>"
    assert model.text(long).count("\n") == 4999


def test_marginals_are_exact():
    page = '<nav><a href=x>m</a></nav><article><h1>t</h1><p class="ad">p</p></article>'
    nodes = parse(page)
    rng = np.random.default_rng(0)
    model = content.Model(rng.normal(size=len(content.FEATURES)).tolist(), [[0.8, 0.2], [0.3, 0.7]])
    own = [sum(model.weights[f] for f in content.features(nodes, k)) for k in range(len(nodes))]
    total, mass = 0.0, np.zeros(len(nodes))
    for y in itertools.product((0, 1), repeat=len(nodes)):
        p = np.exp(sum(o for o, v in zip(own, y) if v))
        for k in range(1, len(nodes)):
            p *= model.child[y[nodes[k].parent]][y[k]]
        total += p
        mass += p * np.array(y)
    assert np.allclose(model.marginals(nodes), mass / total)


def test_hand_labelled_pages(model):
    wrong = texts = 0
    for page in content.skeletons():
        nodes = parse(page)
        labels, found = content.hand_labels(nodes), model.marginals(nodes)
        for node, y, p in zip(nodes, labels, found):
            if node.tag == "#text":
                texts += 1
                wrong += (p >= 0.5) != y
    assert wrong <= 0.01 * texts


def test_the_table_against_its_own_markup(spark):
    pages = read(spark, "/root/testdata/sf0.01", "pages")
    html = {r["page_id"]: r["html"] for r in pages.collect()}
    got = {r["page_id"]: r["text"] for r in content.extract(pages).collect()}
    assert set(got) == set(html)
    for i, page in html.items():
        nodes = parse(page)
        labels = content.markup_labels(nodes)
        assert got[i] == "\n".join(blocks(nodes, lambda k: labels[k] == 1))


def test_odd_rows(spark):
    frame = spark.createDataFrame([(1, None, None, "x"), (2, "u", "", "x"), (None, "u", "<article><p>Some text of it.</p></article>", "x"),
                                   (3, "u", "<nav><a href=a>menu</a></nav>", "x"), (3, "u", "<nav><a href=a>menu</a></nav>", "x")],
                                  "page_id bigint, url string, html string, text string")
    got = sorted(map(tuple, content.extract(frame).collect()), key=str)
    assert got == sorted([(1, None, ""), (2, "u", ""), (None, "u", "Some text of it."), (3, "u", ""), (3, "u", "")], key=str)
    assert content.extract(frame.where("false")).collect() == []


BROKEN = {"open tags": "<a " * 60_000, "open quotes": '<a "' * 60_000, "stray ends": "<span>" * 20_000 + "</p>" * 20_000,
          "a long name": "<" + "a" * 300_000, "quotes, then an end": '<a "' * 60_000 + ">", "ends after an open tag": "<a " + "</b>" * 60_000,
          "ends of another block": "<b><div>" + "<span>" * 20_000 + "</b>" * 30_000, "deep": "<div>" * 30_000 + "x"}


@pytest.mark.parametrize("kind", BROKEN)
def test_broken_markup_takes_time_in_proportion(kind):
    began = time.process_time()
    parse(BROKEN[kind])
    assert time.process_time() - began < 3


def test_a_tag_without_an_end_is_text():
    whole = lambda page: blocks(parse(page), lambda k: True)
    assert whole('<div class="x">1 < 2 <a "b <p>three</p> <i>four <em') == ['1 < 2 <a "b', "three", "four <em"]
    assert whole("<p>one</p><a <b <c") == ["one", "<a <b <c"]


def test_rendered_text_of_formulas_and_scriptless_parts_stays():
    page = "<p>a <math><mi>x</mi><mo>=</mo><mn>1</mn></math> b</p><noscript><p>c</p></noscript><svg><text>d</text></svg><script>e</script>"
    assert " ".join(blocks(parse(page), lambda k: True)) == "a x=1 b c d"

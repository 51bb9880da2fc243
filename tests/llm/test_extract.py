import itertools
import time

import numpy as np
import pytest

from hourly_star.llm import dom, extract
from hourly_star.llm.page_layouts import labelled_page


@pytest.fixture(scope="module")
def weights():
    return extract.fit()


def parsed(*pages):
    forest = dom.Forest()
    for number, page in enumerate(pages):
        forest.parse(number, page)
    return forest, dom.levels(forest)


def test_marginals_equal_the_sum_over_all_labellings():
    page = "<body><nav><ul><li>a<li><a>b</a></ul></nav><article><h1>x</h1><p>long text, here.<p>y</article>"
    forest, by_depth = parsed(page)
    pairs = dom.features(forest, by_depth)
    rng = np.random.default_rng(1)
    weights = extract.Weights(rng.normal(size=dom.FEATURES) / 3, rng.normal(size=(dom.N_GROUPS, 2, 2)))
    content, joint, total = extract.marginals(forest, by_depth, pairs, weights)
    n = len(forest.parent)
    unary = np.bincount(pairs[0], weights.content[pairs[1]], n)
    scores, states = [], list(itertools.product((0, 1), repeat=n))
    for state in states:
        score = sum(unary[i] for i in range(n) if state[i])
        score += sum(weights.pair[forest.group[i], state[p], state[i]] for i, p in enumerate(forest.parent) if p >= 0)
        scores.append(score)
    p = np.exp(scores - np.logaddexp.reduce(scores))
    assert total == pytest.approx(np.logaddexp.reduce(scores))
    assert np.allclose(content, p @ np.array(states))
    assert joint[1, 1, 1] == pytest.approx(sum(q for q, s in zip(p, states) if s[1] and s[forest.parent[1]]))


def test_held_out_layouts(weights):
    forest, by_depth = parsed(*[labelled_page(90_000_000 + i) for i in range(200)])
    content, _, _ = extract.marginals(forest, by_depth, dom.features(forest, by_depth), weights)
    label, own = np.array(forest.label), np.array(forest.chars) > 0
    assert ((content > .5) == (label == 1))[own].mean() > .985


BODY = "Some words of the story &amp; more, as it goes on. " * 4
TEXT = " ".join(("Some words of the story & more, as it goes on. " * 4).split())


@pytest.mark.parametrize("page,text", [
    (f"<html><body><nav><ul><li><a href='/a'>Home</a></li><li><a href='/b'>News</a></li></ul></nav>"
     f"<article><h1>A  title</h1><p>{BODY}<p><b>{BODY}<br><p>End.</p></article><footer>&copy; x</footer>",
     f"A title {TEXT} {TEXT} End."),
    (f"<body><header><h1>Site</h1></header><main><h1>T</h1><p>{BODY}</p><ul><li>one thing<li>two</ul></main>"
     f"<aside class=sidebar><h3>Related</h3><ul><li><a>x</a><li><a>y</a></ul></aside>"
     f"<div id='comments'><h3>Comments</h3><div class='comment'><p>I agree with you.</p></div></div>",
     f"T {TEXT} one thing two"),
    (f"<body><div class='cookie-notice'><p>We use cookies.</p><button>OK</button></div><form><label>Search</label>"
     f"<input><button>Go</button></form><div class='post-content'><h2>Head</h2><p>{BODY}</p></div>"
     f"<div class='ad'>Buy now</div><script>if (a < b) x('</p>')</script><style>p {{}}</style><!-- <p>no</p> -->",
     f"Head {TEXT}"),
])
def test_pages(weights, page, text):
    assert extract.main_texts([page], weights) == [text]


def test_broken_markup_and_odd_rows(spark):
    pages = [(1, "u", None), (2, None, ""), (3, "u", "<"), (4, "u", "<!-- never closed"), (None, "u", "<script>var x"),
             (6, "u", "<p title='a > b'>" * 3), (7, "u", "<div>" * 3000 + "deep" + "</div>" * 10),
             (8, "u", f"<article><p>{BODY}&nbsp;&#233;&notareal; < 5</p></article>" + "<p>x" * 5),
             (8, "u", "plain"), (9, "u", "</b></p></div><a href=\"unclosed>text"),
             (10, "u", "<article>" + f"<p>{BODY}</p>" * 12_000 + "</article>")]
    frame = spark.createDataFrame([(*p, 7) for p in pages], "page_id long, url string, html string, n_chars int")
    rows = extract.extracted(frame).collect()
    assert len(rows) == len(pages)
    assert all(r.text == " ".join(r.text.split()) and r.n_chars == len(r.text) for r in rows)
    by_id = {r.page_id: r.text for r in rows}
    assert by_id[1] == by_id[2] == by_id[4] == by_id[None] == ""
    assert by_id[10].startswith(TEXT) and len(by_id[10]) == 12_000 * (len(TEXT) + 1) - 1
    assert extract.extracted(frame.limit(0)).count() == 0


def test_references_and_white_space(weights):
    page = f"<body><article><h1>T</h1><p>{BODY}</p><p>a&#x41;&eacute;\n\t b<i>c</i>  d<br>e</p></article>"
    assert extract.main_texts([page], weights) == [f"T {TEXT} aAé bc d e"]


def test_label_attributes_and_self_closed_graphics_of_real_pages(weights):
    icons = "<svg viewBox='0 0 9 9' /><math/><svg data-y=12px/ ><path/></svg>"
    page = (f"<body data-y='12px'><nav><ul><li><a href='/a'>Home</a></li></ul></nav><article data-y=\"12.5\"><h1>T</h1>"
            f"<p data-y=''>{BODY}</p>{icons}<p data-y='0'>{BODY}</p><svg class='x=y'/><p>End.</p></article>")
    assert extract.main_texts([page], weights) == [f"T {TEXT} {TEXT} End."]
    kept = dom.Forest(labelled=False)
    kept.parse(0, "<body><p>a<svg fill=red/>not shown</svg>b<svg fill='red'/>c")
    assert dom.text_of(kept, np.ones(len(kept.page), bool), 1) == ["abc"]


def test_text_of_foreign_elements_stays(weights):
    page = (f"<body><article><h1>T</h1><p>{BODY}</p><p>Let <math><mi>x</mi> <mo>=</mo> <mn>1</mn></math> be "
            f"<object data=u>a figure</object> here, <svg/>as <svg><path d='M0'/><text>drawn</text></svg> below.</p>"
            f"<p>{BODY}</p></article>")
    assert extract.main_texts([page], weights) == [f"T {TEXT} Let x = 1 be a figure here, as below. {TEXT}"]


@pytest.mark.parametrize("piece", ["<a ", '<a x="', '<a ">"', "<div>", "<div><span>", "<p><button><div>", "<li><p>", "<"])
def test_time_grows_with_length_alone(piece):
    spent = []
    for size in (50_000, 400_000):
        start = time.process_time()
        parsed(piece * (size // len(piece)) + "'")
        spent.append(time.process_time() - start)
    assert spent[1] < 24 * spent[0] + .2


def test_depth_is_bounded():
    forest, by_depth = parsed("<div>" * 3_000 + "deep")
    assert len(by_depth) == dom.DEEPEST + 1 and len(forest.page) == 3_001
    assert forest.runs == [(3_000, ["deep"])]


@pytest.mark.parametrize("page,tags", [
    ("a <b c='>'>d</b>", [(2, 11, False, "b", " c='>'"), (12, 16, True, "b", "")]),
    ("<a x=\"y><b z='1'>", [(0, 8, False, "a", ""), (8, 17, False, "b", " z='1'")]),
    ("<i><a ", [(0, 3, False, "i", "")]),
    ("<!-- <p> --><?x?></p", [(0, 12, False, "", ""), (12, 17, False, "", ""), (17, 20, False, "", "")]),
    ("<script>a<p></script >b", [(0, 22, False, "script", "")]),
    ("<style>a<p>", [(0, 11, False, "style", "")])])
def test_markup_in_one_scan(page, tags):
    assert list(dom._tags(page)) == tags

"""Main text of pages: the cut against all labellings, the reading of markup, whole tables."""

import html as entities
import itertools
import random
import re

import pytest

from obsengine.llm import extraction
from obsengine.llm.extraction import Flow, label, main_text, read_blocks
from obsengine.llm.queries import op13_extraction
from tests.conftest import SMALL


def cost(odds, edges, content):
    against = sum(max(o, 0) if not c else max(-o, 0) for o, c in zip(odds, content))
    return against + sum(w for a, b, w in edges if content[a] != content[b])


@pytest.mark.parametrize("seed", range(40))
def test_the_cut_is_the_cheapest_labelling(seed):
    rnd = random.Random(seed)
    n = rnd.randrange(1, 11)
    odds = [rnd.randrange(-6, 7) for _ in range(n)]
    edges = [(a, b, rnd.randrange(1, 6)) for a, b in itertools.combinations(range(n), 2) if rnd.random() < 0.4]
    found = label(odds, edges)
    all_costs = {c: cost(odds, edges, c) for c in itertools.product([False, True], repeat=n)}
    least = min(all_costs.values())
    assert all_costs[tuple(found)] == least
    # Of the cheapest labellings the one with most content.
    assert sum(found) == max(sum(c) for c, v in all_costs.items() if v == least)


def test_flow_of_a_long_chain():
    n = 5000
    odds = [3 if i % 2 else -2 for i in range(n)]
    edges = [(i, i + 1, 4) for i in range(n - 1)]
    assert all(label(odds, edges))
    flow = Flow(4)
    flow.join(0, 1, 3), flow.join(0, 2, 2), flow.join(1, 2, 5), flow.join(1, 3, 2), flow.join(2, 3, 3)
    assert flow.run(0, 3) == 5


def test_smoothness_moves_doubtful_blocks_only():
    page = "<div><p>{0}</p><p>{0}</p><p>Yes</p><p>{0}</p></div><ul>{1}</ul>"
    prose = "This is a sentence of a dozen words or more that ends well."
    links = "".join(f'<li><a href="/{i}">more about {i}</a></li>' for i in range(4))
    blocks = read_blocks(page.format(prose, links))
    odds = extraction.costs(blocks, extraction.START)
    assert odds[2] < 0 < odds[1]
    assert label(odds, extraction.links(blocks)) == [True] * 4 + [False] * 4


@pytest.mark.parametrize(
    "page, text",
    [
        (None, ""),
        ("", ""),
        ("   \n ", ""),
        ("<article></article>", ""),
        ("<article><p>A &amp; B&nbsp;&lt;b&gt; &#8364; &eacute;</article>", "A & B <b> € é"),
        ("<article><p>one\n\t two<br>three <b>bo</b>ld</p></article>", "one two three bold"),
        ("<article><p>open<p>again<div>inner</div>tail</article>", "open\nagain\ninner\ntail"),
        ("<article><p><b>never closed<br><p>next</p></article><footer>gone</footer>", "never closed\nnext"),
        ("<article><ul><li>a<li>b<ul><li>c</ul><li>d</ul></article>", "a\nb\nc\nd"),
        ("<article><table><tr><td>a<td>b<tr><td>c</table></article>", "a b\nc"),
        ("<article>x<script>var t='</p><p>no';</script>y<style>p{}</style></article>", "xy"),
        ("<article>a<!-- <p>no</p> -->b<!-->c<? no ?>d<!x>e</article>", "abcde"),
        ("<article>1 < 2 <3 and a<b>c</b></article>", "1 < 2 <3 and ac"),
        ("<article><p title='a > b' class=x>q</p><p title=\"open>r</p></article>", "q\nr"),
        ("<head><title>no</title><body><article>yes</article>", "yes"),
        ("<article><p>kept</p><!-- never closed <p>gone</p></article>", "kept"),
        ("<article><p>a</p><script>never closed <p>gone", "a"),
        ("<ARTICLE><P CLASS='x'>Upper</P></ARTICLE>", "Upper"),
        ("<article><p>a</b></i></p>b</article></div></p>", "a\nb"),
        ("<article><h1>T</h1><p hidden>no</p><p style='display: none'>no</p>yes</article>", "T\nyes"),
    ],
)
def test_reading(page, text):
    assert main_text(page) == text


PROSE = "Here is a longer sentence, with a comma, that tells what happened in the town today."


@pytest.mark.parametrize(
    "around",
    [
        "<nav><a href='/'>Home</a> <a href='/x'>X</a></nav>", "<header><p>Site of the year.</p></header>",
        f"<aside><p>{PROSE}</p></aside>", f"<div class='sidebar-left'><p>{PROSE}</p></div>",
        f"<div id='cookie-notice'><p>{PROSE}</p><button>OK</button></div>", f"<div class='ad'>{PROSE}</div>",
        f"<form><p>{PROSE}</p><input><textarea>no</textarea></form>", f"<footer>{PROSE}</footer>",
        f"<section id='comments'><h2>Comments</h2><div class='comment'><p>{PROSE}</p></div></section>",
        f"<div role='navigation'>{PROSE}</div>", f"<div class='newsletterSignup'><p>{PROSE}</p></div>",
        f"<dialog open><p>{PROSE}</p></dialog>", f"<noscript><p>{PROSE}</p></noscript>",
    ],
)
@pytest.mark.parametrize(
    "frame",
    [
        "{0}<article><h1>Title</h1><p>{1}</p><p>Short.</p></article>{0}",
        "<div class='page has-sidebar'>{0}<main><h1>Title</h1><p>{1}</p><p>Short.</p>{0}</main></div>{0}",
        "<div class='with-sidebar'>{0}<div class='post-content'><h1>Title</h1><p>{1}</p><p>Short.</p></div>{0}</div>",
        "<article><header><h1>Title</h1></header><p>{1}</p>{0}<p>Short.</p></article>",
        "<body>{0}<div><h1>Title</h1><p>{1}</p><p>Short.</p></div>{0}",
    ],
)
def test_boilerplate_goes_and_the_article_stays(around, frame):
    said = PROSE.replace("town", "city")
    assert main_text(f"<html>{frame.format(around, said)}") == f"Title\n{said}\nShort."


def expected(page):
    """What the pages of the test tables hold, read off their one make."""
    inside = re.search(r"<article>(.*?)(?:</article>|$)", page or "", re.S)
    if not inside:
        return ""
    parts = re.split(r"</?(?:p|h1)>", inside.group(1).replace("<br>", " "))
    texts = [" ".join(entities.unescape(re.sub(r"<[^>]*>", "", p)).split()) for p in parts]
    return "\n".join(t for t in texts if t)


def test_query_over_the_table(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()}
    found = op13_extraction(spark, SMALL).collect()
    assert len(found) == len(pages)
    for row in found:
        assert row.text == expected(pages[row.page_id].html)
        assert (row.n_chars, row.url) == (len(row.text), pages[row.page_id].url)


def test_odd_rows_and_columns(spark):
    long = "<article>" + "<p>word word.</p>" * 30_000 + "</article>"
    deep = "<div>" * 30_000 + "<article><p>deep</p></article>"
    pages = [(1, None, "a"), (1, None, "a"), (None, "", "b"), (2, long, None), (3, deep, "c")]
    schema = "page_id long, html string, text string"
    found = extraction.extract(spark.createDataFrame(pages, schema)).collect()
    assert sorted(r.n_chars for r in found) == [0, 0, 0, 4, 30_000 * 11 - 1]
    assert set(found[0].asDict()) == {"page_id", "html", "text", "n_chars"}
    empty = spark.createDataFrame([], schema)
    assert extraction.extract(empty).count() == 0
    assert extraction.fit(empty) == extraction.START


def test_weights_follow_the_sample_but_not_far(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    weights = extraction.fit(pages)
    assert weights != extraction.START and weights == extraction.fit(pages.repartition(3))
    linked = dict(zip(("one", "words", "links"), weights))["links"]
    assert linked < 0

"""Main-text extraction: given pages, layouts of other kinds, and edge cases."""

import html
import itertools
import random
import re

import numpy as np
import pytest

from voltweave.llm import html_extract as H


@pytest.fixture(scope="module")
def forest():
    return H.train(300)


def article(page):
    inner = page[page.index("<article>") + 9 : page.index("</article>")].replace("<br>", " ")
    parts = (re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]*>", "", b))).strip() for b in re.split(r"</?(?:p|h1|div)\b[^>]*>", inner))
    return "\n\n".join(x for x in parts if x)


def test_table_of_pages(spark, forest):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    got = {r.page_id: (r.text, r.n_chars) for r in H.extract(pages, forest).collect()}
    for r in pages.collect():
        assert got[r.page_id] == (article(r.html), len(article(r.html)))


def test_unseen_generated_pages(forest):
    maker, right = H._Maker(1234), 0
    for _ in range(60):
        page = maker.page()
        want = " ".join(re.sub(r"<[^>]*>", " ", "".join(re.findall("\x01(.*?)\x02", page, re.S))).split())
        right += " ".join(H.extract_page(re.sub("[\x01\x02]", "", page), forest).split()).replace(" ", "") == want.replace(" ", "")
    assert right >= 54


def test_other_layout(forest):
    long = "Here is a sentence of the story, which goes on for a while and says things. " * 4
    page = f"""<html><body><div id="cookie-notice"><p>We use cookies to improve things.</p></div><header><a href=/>Site</a></header>
    <div class="menu"><ul><li><a href=/a>A</a><li><a href=/b>B</a></ul></div>
    <div id="content"><h1>Title &amp; more</h1><p>{long}<p>{long}&nbsp;End<script>x("</p>")</script></div>
    <div class="sidebar"><h3>Popular</h3><ul><li><a href=/p>Another thing</a></ul></div>
    <section class="comments"><div class="comment"><p>First! I like this a lot.</p></div></section><footer>&copy; Site</footer></body>"""
    assert H.extract_page(page, forest) == "\n\n".join(["Title & more", long.strip(), long.strip() + " End"])


def test_no_contradictions(forest):
    maker = H._Maker(5)
    for _ in range(20):
        order = H.listed(H.parse(maker.page()))
        kept = H.decode(order, forest.log_odds(H.features(order)))
        assert kept.dtype == bool and len(kept) == len(order)


def worth_of(order, odds, choice):
    """What the decoder sums up, for one assignment of keep all (1), drop all (0) or decide below (2) to the elements that are reached."""

    def below(node):
        return [c for c in node.children if isinstance(c, H.Node) and c.tag not in H.UNSEEN]

    def own(node):
        return sum(len(c) for c in node.children if isinstance(c, str) and not c.isspace()) ** 0.5 * odds[node.index]

    def whole(node):
        return own(node) + sum(map(whole, below(node))) + (odds[node.index] if below(node) else 0)

    def value(node):
        what = choice[node.index]
        if what < 2:
            return whole(node) if what else 0.0
        return max(own(node), 0) + sum(map(value, below(node))) - (1.0 if below(node) else 0)

    return value(order[0])


def test_decoding_equals_exhaustive_search():
    rng = random.Random(2)
    for _ in range(120):
        def element(depth):
            inner = "".join(rng.choice([lambda: "word " * rng.randint(1, 4), lambda: element(depth + 1) if depth < 3 else "x"])() for _ in range(rng.randint(0, 3)))
            return f"<div>{inner}</div>"

        order = H.listed(H.parse(element(0)))
        if len(order) > 9:
            continue
        odds = np.array([rng.uniform(-3, 3) for _ in order])
        best = max(worth_of(order, odds, c) for c in itertools.product((0, 1, 2), repeat=len(order)))
        kept = H.decode(order, odds)
        # The decoder's marks, read back as an assignment, reach the best sum.
        reached = max(worth_of(order, odds, c) for c in itertools.product((0, 1, 2), repeat=len(order)) if np.array_equal(marks(order, odds, c), kept))
        assert reached == pytest.approx(best, abs=1e-9)


def marks(order, odds, choice):
    kept, todo = np.zeros(len(order), bool), [(order[0], choice[0])]
    while todo:
        node, what = todo.pop()
        if what:
            kept[node.index] = what == 1 or odds[node.index] > 0
            todo += [(c, 1 if what == 1 else choice[c.index]) for c in node.children if isinstance(c, H.Node) and c.tag not in H.UNSEEN]
    return kept


def test_sibling_statistics_at_any_number(forest):
    for n in (1, 2, 399, 400, 2000):
        order = H.listed(H.parse("<div>" + "".join(f"<p>{'x' * (i % 7 + 1)}</p>" for i in range(n)) + "<ul><li>a</ul></div>"))
        x = H.features(order)
        for node in order[1:]:
            kids = [c for c in node.parent.children if isinstance(c, H.Node) and c.tag not in H.UNSEEN]
            others = [c.length for c in kids if c is not node]
            want = [np.log1p(len(kids)), sum(c.tag == node.tag for c in kids) / len(kids), np.log1p(max(others, default=0))]
            assert np.allclose(x[node.index, [39, 41, 43]], want, atol=1e-6)
            if n > 500:
                break


def test_end_tags_of_very_deep_elements_close_nothing_else():
    deep = "<div>" * 150 + "<span><i>" * 150
    root = H.parse("<main>" + deep + "</i></span>" * 150 + "</div>" * 150 + "after</main>")
    assert [c for c in root.children[0].children if isinstance(c, str)] == ["after"]
    assert "".join(H.blocks(root, np.ones(len(H.listed(root)), bool))) == "after"


def test_edge_cases(spark, forest):
    rows = [(1, "u", None), (2, "u", ""), (3, "u", "<"), (4, "u", "<div" * 3000), (5, "u", "<div>" * 3000 + "x"), (6, "u", "<a \"'\"' <p>x"), (7, "u", "<!-- a"), (7, "u", "<!-- a")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'z' AS text", "1 AS N_chars", "2 AS extra")
    got = H.extract(df, forest).collect()
    assert len(got) == 8 and got[0].extra == 2 and all(r.text is not None and r.n_chars == len(r.text) for r in got)
    assert {r.page_id: r.text for r in got}[1] == "" and H.extract(df.limit(0), forest).collect() == []

import random

import pytest

from ledgerline.llm import html

MODEL = html.train()


def brute_marginals(model, page):
    """Marginals by summing over all labelings (small trees)."""
    import itertools
    import math

    n = len(page.parent)
    totals, ones = 0.0, [0.0] * n
    for y in itertools.product((0, 1), repeat=n):
        p = 1.0
        for i in range(n):
            if y[i]:
                p *= math.exp(sum(model.log_odds.get(f, 0.0) for f in page.features[i]))
            if i:
                p *= model.edge[html._role(page.kind[i])][y[page.parent[i]]][y[i]]
        totals += p
        for i in range(n):
            ones[i] += p * y[i]
    return [o / totals for o in ones]


def test_messages_give_exact_marginals():
    page = html.Page("<nav><ul><li><a href=x>Home</a></li></ul></nav><article><h1>Head</h1><p>Some text here.</p><div class=ad>Buy</div></article>")
    assert MODEL.marginals(page) == pytest.approx(brute_marginals(MODEL, page), abs=1e-9)


def test_extracts_the_article():
    page = """<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{}</style><script>var t="</p><article>";</script></head><body>
    <header class="site-header"><a href="/">Home</a></header><nav><ul><li><a href=/a>A</a></li><li><a href=/b>B</a></li></ul></nav>
    <div class="cookie-notice">We use cookies.</div><!-- <p>hidden</p> --><article><h1>A &lt;Head&gt;</h1>
    <p><b>First  paragraph&nbsp;with a <a href="x>y">link</a>,<br>and a break.<p>Second &eacute; paragraph is here.
    <div class="ad">Buy now.</div><p>Third.</p><section class="comments"><p>First comment, I liked it a lot.</p></section></article>
    <aside class="sidebar"><p>Related things.</p></aside><form><label>Mail</label><input name=q></form><footer>&copy; 2020 Someone.</footer></body></html>"""
    assert MODEL.extract(page) == "A <Head>\nFirst paragraph with a link, and a break.\nSecond é paragraph is here.\nThird."


def test_held_out_patterns():
    right = wrong = missed = 0
    for page, content in html.labelled_patterns(120, seed=99):
        p = MODEL.marginals(page)
        labels = html._labels(page, content)
        for i, text in enumerate(page.text):
            if text is not None:
                if p[i] >= 0.5:
                    right, wrong = right + labels[i], wrong + 1 - labels[i]
                else:
                    missed += labels[i]
    assert right / (right + wrong) > 0.93 and right / (right + missed) > 0.93


@pytest.mark.parametrize("name", ["", "class='entry-content'", "class='txt-body'", "id='s1' class='chapter'", "class='content-box' role='region'"])
def test_article_text_in_a_named_wrapper_is_content(spark, name):
    r = random.Random(8)

    def sentence(n):
        return " ".join(r.choice(["alpha", "beta", "gamma", "delta", "river", "stone"]) for _ in range(n)).capitalize() + "."

    pages, want = [], []
    for i in range(320):
        text = [sentence(r.choice((8, 30, 60, 120))) for _ in range(r.randint(5, 20))]
        inner = "".join(f"<p>{p}</p>" for p in text[:-1]) + "<div class='post-share'><p>Share this with a friend.</p></div>" + f"<p>{text[-1]}</p>"
        pages.append((i, f"<header><a href=/>Home</a></header><article><div {name}>{inner}</div><div class='ad'>Buy this now.</div></article><footer>Legal words.</footer>"))
        want.append("\n".join(text))
    model = html.train(spark.createDataFrame(pages[:300], "page_id long, html string"))
    assert [model.extract(source) for _, source in pages[300:]] == want[300:]


def test_odd_pages_do_not_crash():
    r = random.Random(1)
    odd = ["", " ", "<", "<>", "</", "</p>", "<p", "<p class='", "<!--", "<![CDATA[x", "&am", "&#x110000;", "<a" * 500, "<div>" * 3000 + "deep", "<p>" * 2000, "<script>x", "<title>x", "<head>x", "x" * 200_000, "<table><tr><td>a<td>b<tr><td>c</table>"]
    odd += ["".join(r.choice("<>/p \"'=a&;!-") for _ in range(300)) for _ in range(50)]
    for page in odd:
        assert isinstance(MODEL.extract(page), str)


def test_query_rows(spark):
    rows = [(1, "u", "<article><p>Some text that is long enough to read.</p></article>"), (2, None, None), (2, "v", ""), (None, "w", "<nav>a</nav>"), (None, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' as text0", "1 as page")
    found = html.extract(pages, html.train(pages)).collect()
    assert sorted((str(r.page_id), r.text) for r in found) == [("1", rows[0][2][12:-14]), ("2", ""), ("2", ""), ("None", ""), ("None", "")]
    assert html.extract(pages.limit(0), MODEL).collect() == []
    assert html.train(pages.limit(0))


TEXT = "The river ran past the stone for many years, and people who lived there wrote of it often."


@pytest.mark.parametrize("name", ["share-price", "comment-on-war", "social-history", "notice-period", "ad-hoc-networks", "hiddenGem", "menu-prices-of-1900"])
@pytest.mark.parametrize("shape", ["<div class='{}'><p>{}</p></div>", "<section id='{}'><p>{}</p></section>", "<p class='{}'>{}</p>"])
def test_names_that_merely_contain_a_listed_word_lose_no_text(name, shape):
    page = f"<header><a href=/>Home</a></header><article><h1>Head</h1><p>{TEXT}</p>{shape.format(name, TEXT)}<p>{TEXT}</p></article><footer>Legal.</footer>"
    assert MODEL.extract(page) == f"Head\n{TEXT}\n{TEXT}\n{TEXT}"


@pytest.mark.parametrize("name", ["share-buttons", "site-ad-slot", "reader-comments", "comment-list", "related-posts", "newsletter-signup", "cookieNotice", "sidebar-left"])
def test_names_that_say_so_set_their_element_apart(name):
    page = f"<article><h1>Head</h1><p>{TEXT}</p><div class='{name}'><p>{TEXT}</p></div><p>{TEXT}</p></article><footer>Legal.</footer>"
    assert MODEL.extract(page) == f"Head\n{TEXT}\n{TEXT}"


def test_a_whole_article_in_a_box_with_an_odd_name():
    page = f"<header><a href=/>Home</a></header><main><div id='comment-on-war'><h1>On war</h1><p>{TEXT}</p><p>{TEXT}</p></div></main><footer>Legal.</footer>"
    assert MODEL.extract(page) == f"On war\n{TEXT}\n{TEXT}"


def test_formulas_and_link_lists_of_the_article_stay():
    page = f"""<nav><ul><li><a href=/a>Alpha</a></li><li><a href=/b>Beta</a></li></ul></nav><article><h1>Head</h1><p>{TEXT}</p>
    <p>The sum <math><mi>x</mi><mo>+</mo><mn>1</mn><annotation encoding="tex">x+1</annotation></math> is known to all of them.</p>
    <ul><li><a href=/1>First paper on rivers</a></li><li><a href=/2>Second paper on stones</a></li></ul><p>{TEXT}</p></article>
    <aside><ul><li><a href=/3>Other river things</a></li><li><a href=/4>Other stone things</a></li></ul></aside>"""
    assert MODEL.extract(page) == f"Head\n{TEXT}\nThe sum x+1 is known to all of them.\nFirst paper on rivers\nSecond paper on stones\n{TEXT}"


@pytest.mark.parametrize("n", [4, 15, 40])
def test_lists_of_any_item_length_and_unpunctuated_blocks_stay(n):
    items = [f"Item {i} " + "river stone " * n for i in range(4)]
    listed = "".join(f"<li>{t}</li>" for t in items)
    page = f"<header><a href=/>Home</a></header><article><h2>Head</h2><ol>{listed}</ol><p>{'alpha ' * n}</p></article><footer>Legal.</footer>"
    assert MODEL.extract(page) == "\n".join(["Head", *(t.strip() for t in items), ("alpha " * n).strip()])


def test_blocks_close_what_the_language_says():
    page = html.Page("<div><p>a<section>b</section></div><table><tr><td>c<td>d<tr><td><p>e<div>f</div></td></tr></table><ul><li>g<ul><li>h</ul><li>i</ul>")
    kinds = {t: page.kind[page.parent[i]] for i, t in enumerate(page.text) if t}
    assert kinds == {"a": "p", "b": "section", "c": "td", "d": "td", "e": "p", "f": "div", "g": "li", "h": "li", "i": "li"}


def test_nested_and_stray_tags_cost_linear_time():
    import time

    def seconds(n):
        begin = time.process_time()
        html.Page("<div>" * n + "x" + "</section></b></p>" * n + "<select>" * n)
        html.Page("<p><td>" + "<div>" * n)
        return time.process_time() - begin

    seconds(500)
    assert seconds(24_000) < 40 * max(seconds(3_000), 0.01)


def test_long_pages_and_a_text_column_of_the_input(spark):
    pages = spark.createDataFrame([(1, f"<article><p>{TEXT}</p></article>", "old"), (2, "<article><p>" + "word " * 30_000 + "</p></article>", "old")], "page_id long, html string, text string")
    got = {r.page_id: r.text for r in html.extract(pages, html.train(pages)).collect()}
    assert got == {1: TEXT, 2: ("word " * 30_000).strip()}

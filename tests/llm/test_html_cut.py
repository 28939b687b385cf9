"""Main text: the cut against brute force, and pages with known articles."""

import itertools
import random
import re
import time

from strata.llm import html_cut
from strata.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"


def cost(terminals, edges, labels):
    out = sum(c if c > 0 and not keep else -c if c < 0 and keep else 0 for c, keep in zip(terminals, labels))
    return out + sum(c for i, j, c in edges if labels[i] != labels[j])


def test_cut_is_the_least_of_all_labellings():
    rng = random.Random(9)
    for _ in range(200):
        n = rng.randrange(1, 9)
        terminals = [rng.randrange(-9, 10) for _ in range(n)]
        edges = [(i, j, rng.randrange(0, 6)) for i, j in itertools.combinations(range(n), 2) if rng.random() < 0.5]
        least = min(cost(terminals, edges, labels) for labels in itertools.product((True, False), repeat=n))
        assert cost(terminals, edges, html_cut.minimum_cut(terminals, edges)) == least


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header><h1>Site name</h1></header><nav><ul><li><a href=/a>One</a><li><a href=/b>Two</a></ul></nav>
<div class="cookie-notice"><p>We use cookies to improve this site. Please accept them all.</p></div>
<article><header><h1>The &amp; title</h1></header><p>First   paragraph&nbsp;with <b>bold</b> words
and a <a href="x>y">link</a>.<p>Short.<p>&lt;tag&gt; &#233;<br>after a break<!-- no --></p>
<div class="ad">Buy these fine things today. They are cheap and good.</div><ul><li>item one<li>item two</ul>
<p>Last paragraph of the article, which ends here.</p></article>
<aside><p>A long sidebar paragraph that has many words and sentences. It isn't the article.</p></aside>
<section id="comments"><p>Reader: I liked this article very much, and so did my friends.</p></section>
<form><p>Subscribe to our newsletter by mail, it is free of charge.</p><input><select><option>x</select></form>
<footer>&copy; Site. All rights reserved by the owners of it.</footer></body></html>"""


def test_article_without_its_surroundings():
    assert html_cut.main_text(PAGE) == (
        "The & title\nFirst paragraph with bold words and a link.\nShort.\n<tag> é after a break\n"
        "item one\nitem two\nLast paragraph of the article, which ends here."
    )


def test_wrappers_named_after_their_boilerplate():
    """A word that tells how the page is laid out, or an article's own head, costs the article nothing."""
    body = "<p>" + "This sentence has seven words in it. " * 6 + "</p>"
    want = "\n".join(["The title", *[("This sentence has seven words in it. " * 6).strip()] * 2])
    rest = f'<div class="comments-area"><article class="comment"><p>{"I liked this very much indeed. " * 20}</p></article></div>'
    article = f'<article><header class="entry-header"><h1>The title</h1></header>{body}{body}</article>'
    for wrapper in ("site has-sidebar", "layout no-comments", "layout--with-sidebar", "content sidebar-right", "page sidebar"):
        for kind in ("class", "id", "role"):
            assert html_cut.main_text(f'<body><div {kind}="{wrapper}">{article}{rest}</div></body>') == want
            page = f'<body><div {kind}="{wrapper}"><main>{article}</main>{rest}</div></body>'
            assert html_cut.main_text(page) == want
    plain = f'<div class="page sidebar"><div><h2>The title</h2>{body}{body}</div></div>'
    assert html_cut.main_text(f"<body>{plain}</body>") == want
    for name in ("sidebar", "sidebar-right", "cookie-notice", "widget is-open", "post-comments", "site-header"):
        assert html_cut.main_text(f'<body>{article}<div class="{name}">{body}</div></body>') == want


def test_formulas_fallbacks_and_elements_without_end():
    words = "words of a sentence that is long enough to stay. " * 4
    cases = {
        f"<p>Let <math><mrow><mi>x</mi><mo>=</mo><mn>2</mn></mrow></math> be {words}": f"Let x=2 be {words}",
        f"<p>See <svg><title>no</title><g><text>this label</text><path d=m /></g></svg> in {words}": f"See this label in {words}",
        f"<p>One <svg style='display: none'><text>no</text></svg>{words}": f"One {words}",
        f"<object data=a><param name=b><p>Fallback of {words}</p></object>": f"Fallback of {words}",
        f"<noscript><p>Plain {words}</p></noscript>": f"Plain {words}",
        f"<p>One {words}</p><textarea><p>Two {words}</p>": f"One {words}\nTwo {words}",
        f"<p>One {words}</p><svg><p>Two {words}</p>": f"One {words}\nTwo {words}",
        f"<p>One {words}</p><script>var x = 1 <p>Two {words}</p>": f"One {words}\nTwo {words}",
        f"<p>One {words}</p><select><option>a</select><p>Two {words}</p>": f"One {words}\nTwo {words}",
    }
    for inner, want in cases.items():
        got = html_cut.main_text(f"<body><article>{inner}</article></body>")
        assert got == "\n".join(line.strip() for line in want.split("\n")), inner
    assert html_cut.main_text(f"<article><p>If a <b then {words}") == f"If a <b then {words}".strip()
    html_cut.main_text("<title><svg><script>" * 100_000)


def test_tags_that_never_end_and_many_quotes_take_linear_time():
    begun = time.perf_counter()
    story = "<p>" + "This is a sentence of the story. " * 5
    for tail in ('<a title="a>b"' + ' x="y"' * 10_000, "<a " + "b='" * 10_000, '<a "' * 10_000, "<a =" * 10_000, '<a b="c' * 10_000):
        assert html_cut.main_text(f"<article>{story}</p>{tail}").startswith("This is a sentence of the story.")
    many = "".join(f'<p title="x > {i}" data-x=\'"\'>Word number {i} of a sentence.</p>' for i in range(2000))
    assert html_cut.main_text(f"<article>{many}</article>").count("\n") == 1999
    assert time.perf_counter() - begun < 5


def test_attributes_are_read_by_name():
    text = "This is a sentence of the story. " * 5
    for tag in ('p title="a hidden gem"', 'p class="hidden lg:block"', "p data-role=dialog data-id=nav", 'p title="display: none"'):
        assert html_cut.main_text(f"<article><{tag}>{text}</p></article>") == text.strip(), tag
    for tag in ("p hidden", 'p HIDDEN=""', "p style='color: red; Display : none'"):
        assert html_cut.main_text(f"<article><{tag}>{text}</p><p>{text}</article>") == text.strip(), tag


def test_comments_named_in_one_word_and_their_neighbours():
    text = "This is a sentence of the story. " * 5
    comment = "I liked this article very much, and so did all of my friends. " * 2
    for name in ('class="commentlist"', 'id="replylist"', 'id="responses"', 'class="comment-thread"', 'id=respond'):
        page = f"<article><p>{text}</p><div {name}><p>{comment}</p></div></article>"
        assert html_cut.main_text(page) == text.strip(), name
    near = "A short bare paragraph of only eleven words stands right here."
    page = f'<body><article><p>{text}</p></article><p>{near}</p><div class="comments"><p>{comment}</p><p>{comment}</p></div></body>'
    assert html_cut.main_text(page) == f"{text.strip()}\n{near}"
    assert html_cut.main_text(f'<article><div class="commentary"><p>{text}</p></div></article>') == text.strip()


def test_pages_without_article_tags():
    body = "<p>" + "This is a sentence of the story. " * 5 + "</p>"
    page = f"<div id=menu><a href=a>Home</a> <a href=b>News</a></div><div class=story>{body}{body}</div><div class=footer>End. Of page.</div>"
    assert html_cut.main_text(page) == "\n".join([("This is a sentence of the story. " * 5).strip()] * 2)


def test_odd_pages(spark):
    pages = [(1, "u", None), (2, None, ""), (3, "u", "<p"), (4, "u", "<script>x"), (5, "u", "a < b " * 20), (None, "u", "<!-- x"),
             (6, "u", "<article>" + "<div>" * 3000 + "Deep words stand here. " * 5), (6, "u", "<article><p>Word. " * 20000)]
    df = spark.createDataFrame([(*p, "clash") for p in pages], "page_id long, url string, html string, text string")
    rows = html_cut.extract(df).collect()
    assert len(rows) == len(pages) and all(r["n_chars"] == len(r["text"]) for r in rows)
    by_id = {r["page_id"]: r["text"] for r in rows}
    assert by_id[1] == by_id[2] == by_id[3] == by_id[4] == by_id[None] == ""
    assert html_cut.extract(df.limit(0)).count() == 0


def test_query_finds_the_articles_of_the_pages(spark):
    """The pages' articles stand in article tags: read off by a plain expression."""
    got = {r["page_id"]: r for r in QUERIES["op8_html_cut"](spark, FOLDER).collect()}
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet").collect()
    assert len(got) == len(pages)
    for page in pages:
        inner = re.search(r"<article>(.*)</article>", page["html"], re.S)[1]
        parts = [" ".join(html_cut.html.unescape(re.sub(r"<[^>]*>", " " if "<br" in p else "", p)).split()) for p in re.split(r"</?(?:p|h1)>", inner)]
        want = "\n".join(p for p in parts if p)
        row = got[page["page_id"]]
        assert row["text"] == want and row["n_chars"] == len(want) and row["url"] == page["url"]

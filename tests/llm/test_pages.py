import html
import itertools
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from stratalift.llm import pages, queries


@pytest.fixture(scope="module")
def bodies(sf_dir, spark):
    return {r["page_id"]: r["html"] for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}


@pytest.fixture(scope="module")
def model(bodies):
    total = pages.Counter()
    for body in bodies.values():
        total.update(pages.count_page(body))
    return pages.model_from(total)


def article(body):
    found = re.search(r"<article>(.*?)(</article>|$)", body, re.S)
    text = re.sub(r"</?(p|h1|br)>", "\n", found[1]) if found else ""
    return " ".join(html.unescape(re.sub(r"</?b>", "", text)).split())


def test_query(spark, sf_dir, bodies):
    out = queries.QUERIES["op3_html"](spark, sf_dir).collect()
    assert {r["page_id"] for r in out} == bodies.keys() and len(out) == len(bodies)
    for r in out:
        assert r["text"] == article(bodies[r["page_id"]]) and r["n_chars"] == len(r["text"])


@pytest.mark.parametrize("seed", range(8))
def test_marginals_against_all_labellings(seed):
    dice = random.Random(seed)
    tree = pages.Tree()
    tree.add(-1, pages.ROOT)
    for k in range(7):
        up = dice.choice([n for n in range(k + 1) if tree.name[n]])
        if dice.random() < 0.5:
            tree.add(up, "div", dice.choice([-1, 0, 1]))
        else:
            tree.add(up, "", 0, "some words.", dice.random())
    odds = {f: dice.uniform(-2, 2) for n in range(8) for f in (
        f"{'element' if tree.name[n] else 'text'} {name}" for name in pages.features(tree, n))}
    edges = {}
    for kind in ("outer", "element", "text"):
        a, b = dice.random(), dice.random()
        edges[kind] = ((math.log(a), math.log(1 - a)), (math.log(b), math.log(1 - b)))
    model = pages.PageModel(odds, edges)
    for node, got in enumerate(model.marginals(tree)):
        weight = [0.0, 0.0]
        for labels in itertools.product((0, 1), repeat=8):
            total = sum(model.unary(tree, n) for n in range(8) if labels[n])
            total += sum(edges[pages.edge_kind(tree, n)][labels[tree.parent[n]]][labels[n]] for n in range(1, 8))
            weight[labels[node]] += math.exp(total)
        assert abs(got - math.log(weight[1] / weight[0])) < 1e-9


PAGES = {
    "marks without landmarks": (
        '<html><body class="post"><div class="menu"><a href=x>Home</a> <a href=y>News</a></div>'
        '<div id="content"><h1>Title here</h1><p>First paragraph is a text, with words. It goes on.</p>'
        "<p>Second <b>bo</b>ld para&amp;graph.</p><ul><li>one</li><li>two</ul>"
        '<div class="comments"><p>I like this a lot, thanks for the post.</p></div></div>'
        '<aside><p>Related things to read now.</p></aside><div class="cookie-notice"><p>We use cookies.</p></div>'
        "<form><label>Mail</label><input><button>Send</button></form><footer>2020 Company.</footer></body></html>",
        "Title here First paragraph is a text, with words. It goes on. Second bold para&graph. one two",
    ),
    "nothing marked": ("<p>Only a paragraph of text,\n that goes on. ", "Only a paragraph of text, that goes on."),
    "readers": (
        "<article><h1>A</h1><p>El.<br>La&nbsp; x &lt; y<table><tr><td>cell<td>more</table></article>"
        '<section class="comments"><article class="comment"><p>Comment by a reader is here.</p></article></section>',
        "A El. La x < y cell more",
    ),
    "header": (
        "<header><h1>Site name</h1><nav><a href=1>A</a></nav></header><main><p>Main text, and so on.</p></main>"
        '<div class="advert">Buy now!</div><script>if (a<b) "</p>"</script><style>p{}</style><!-- x -->',
        "Main text, and so on.",
    ),
    "broken": ('<article><p title="a>b">Text 1 < 2 & so on.</p><p>More text</article><a href="', "Text 1 < 2 & so on. More text"),
    "empty": ("", ""),
    "null": (None, ""),
}


@pytest.mark.parametrize("name", PAGES)
def test_pages(model, name):
    page, text = PAGES[name]
    assert model.main_text(page) == text


def test_nulls_repeats_long_and_clashes(spark, sf_dir):
    long = "<article><p>" + "word &amp; " * 100_000 + "</p>" + "<div>" * 3000 + "</article>"
    rows = [(1, "<article><p>Hi you.</p></article>"), (1, "<article><p>Hi you.</p></article>"), (None, None), (2, ""), (3, long)]
    df = spark.createDataFrame(rows, "page_id int, html string").withColumn("Text", F.lit("t"))
    model = pages.fit_pages(df, "page_id", "html")
    out = pages.extract_text(df, "html", model)
    assert out.columns == ["page_id", "html", "text", "n_chars"]
    got = sorted((r["page_id"] or 0, r["n_chars"]) for r in out.collect())
    assert got == [(0, 0), (1, 7), (1, 7), (2, 0), (3, len("word & " * 100_000) - 1)]
    none = pages.fit_pages(df.limit(0), "page_id", "html")
    assert pages.extract_text(df.limit(0), "html", none).count() == 0


@pytest.mark.parametrize("empty_landmarks", [False, True])
def test_labelled_pages_are_drawn_from_the_whole_table(spark, empty_landmarks):
    plain = "<article></article><p>No text in it.</p>" if empty_landmarks else "<p>No landmark here.</p>"
    taught = {k: f"<ARTICLE><p>Text of page {k}, that teaches.</p></ARTICLE><p>no</p>" for k in (7, 57, 107, 157)}
    df = spark.createDataFrame([(k, taught.get(k, plain)) for k in range(200)] + [(None, taught[7])], "id int, html string")
    total = pages.Counter()
    for body in taught.values():
        total.update(pages.count_page(body))
    assert pages.fit_pages(df, "id", "html", 5) == pages.model_from(total)


BODY = "<h1>The title of it</h1><p>A first paragraph, which has words enough.</p><p>And a second one follows.</p>"
SAID = "The title of it A first paragraph, which has words enough. And a second one follows."
AROUND = '<header><a href=/>Site</a></header><nav><a href=a>One</a> <a href=b>Two</a></nav>{}<footer>Copyright by us.</footer>'
ARTICLES = [
    '<article class="post">', '<article class="post type-post tag-python">', '<article class="comment-status-open">',
    '<article class="entry has-sidebar">', '<main class="search-results-off">', '<div class="article-body share-enabled">',
    '<article class="post-12 post type-post status-publish format-standard hentry category-news tag-ads tag-social">',
    '<main id="main" class="site-main no-sidebar">', '<div class="entry-content comments-open">',
    '<article class="h-entry promo-off">', '<main role="main" class="with-header skip-none">', '<div id="content" class="hasSidebar">',
    '<div class="postContent navigation-enabled">', '<article class="formatted subscribe-free">', '<main class="sharepoint searchable">',
    '<div class="content reply">', '<article class="widget-free advertorial-none">',
]
MARGINS = [
    "comments", "comment-list", "post-comments", "sidebar", "sidebar-right", "site-header", "nav-menu", "main-nav", "cookie-notice",
    "newsletter-signup", "sign-up", "related-posts", "share-buttons", "social-media", "ad", "ads-300x250", "advertisement", "banner-top",
    "breadcrumbs", "footer-widgets", "widget", "comment-respond", "searchForm", "popup", "skip-link", "login_box", "comment-body",
]


@pytest.mark.parametrize("tag", ARTICLES)
@pytest.mark.parametrize("taught", [True, False])
def test_no_article_is_lost_to_a_class(model, tag, taught):
    page = AROUND.format(f"{tag}{BODY}</{tag[1:].split()[0]}>")
    assert (model if taught else pages.model_from({})).main_text(page) == SAID


@pytest.mark.parametrize("name", MARGINS)
def test_margins_are_known_by_whole_names(model, name):
    aside = "".join(f"<div><p>Words of number {k} that stand aside.</p></div>" for k in range(9))
    page = AROUND.format(f'<article>{BODY}</article><div class="{name}">{aside}</div>')
    assert model.main_text(page) == SAID
    page = AROUND.format(f'<div class="entry">{BODY}<div class="{name}"><p>Words that stand aside.</p></div></div>')
    assert model.main_text(page) == SAID


def test_what_holds_nearly_all_is_no_margin(model):
    assert model.main_text(f'<body><div class="sidebar"><div class="banner"><article>{BODY}</article></div></div></body>') == SAID


def test_marks_are_learned():
    """A word that content bears on labelled pages becomes no margin; one it does not bear stays."""
    blog = "<article>" + "".join(f'<div class="notice"><p>Text number {k} of it.</p></div>' for k in range(9)) + "</article>"
    turned = f"<article><div class=notice>{BODY}</div><p>End.</p></article>"
    plain = "<article>" + "<p>Some text.</p>" * 9 + '</article><div class="alert"><p>Go away.</p></div>'
    counts = pages.Counter()
    for page in [turned] * 200 + [plain] * 200:
        counts.update(pages.count_page(page))
    model = pages.model_from(counts)
    assert model.main_text(blog).count("Text number") == 9
    assert model.odds["element mark -notice"] > 0 > model.odds["element mark -alert"] + 30
    assert pages.model_from({}).main_text(blog) == ""


@pytest.mark.parametrize("name", PAGES)
def test_hints_and_text_decide_without_labels(name):
    page, text = PAGES[name]
    assert pages.model_from({}).main_text(page) == text


def test_few_labels_do_not_turn_hints():
    only = "<article>" + "<p>A text that is content.</p>" * 100 + "</article>"
    model = pages.model_from(pages.count_page(only))
    page = '<div class="nav"><p>Go on reading here.</p></div><div class="content"><p>Word</p></div>'
    assert model.main_text(page) == "Word"


@pytest.mark.parametrize(
    ("attributes", "hidden"),
    [('class="overflow-hidden"', 0), ('data-hidden="false"', 0), ('title="what is hidden = here"', 0), ("aria-hidden=false", 0),
     ('title="style=display:none"', 0), ("hidden", 1), ('class="a" HIDDEN=""', 1), ("aria-hidden='true'", 1),
     ('style="color: red; display : none"', 1), ("style=display:none", 1), ('hidden="until-found"', 1)],
)
def test_hidden_is_an_attribute(model, attributes, hidden):
    page = f"<article><p>Text that is shown.</p><div {attributes}>A text of its own, that may be hidden.</div></article>"
    assert ("may be" in model.main_text(page)) != hidden


def test_math_and_object_text_is_kept(model):
    page = "<article><p>Let <math><mi>x</mi><mo>=</mo><mn>1</mn></math> be so.</p><object data=f><p>Words in its stead.</p></object></article>"
    text = model.main_text(page)
    assert all(w in text for w in ("Let", "x", "=", "1", "be so.", "Words in its stead."))


@pytest.mark.parametrize("name", ["svg", "iframe", "select", "noscript", "template", "math", "object"])
def test_what_is_not_ended_loses_no_text(model, name):
    page = f"<article><p>Before it is text.</p><{name}><p>After it is text, and goes on.</p></article>"
    assert model.main_text(page) == "Before it is text. After it is text, and goes on."


@pytest.mark.parametrize("name", ["script", "style", "textarea", "title"])
def test_what_ends_with_the_page(model, name):
    assert model.main_text(f"<article><p>Before it is text.</p><{name}> no text, it is code.") == "Before it is text."

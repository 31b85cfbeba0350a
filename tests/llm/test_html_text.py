import random
import time

import pytest
from wardflow.llm.html_text import Line, extract_text, line_weights, main_lines, page_lines


def text(page):
    return "\n\n".join(main_lines(page_lines(page)))


ARTICLE = "First paragraph that is long enough to count as running text in any page at all."

CASES = [
    ("", ""),
    ("plain words only", "plain words only"),
    (f"<nav><a href=/>Home</a></nav><article><h1>T &amp; x</h1><p>a  <b>b</b>\n c<br>d</p></article><footer>f</footer>", "T & x\n\na b c d"),
    ("<article><p>one<p>two<aside>no</aside><p>three", "one\n\ntwo\n\nthree"),
    ("<article><p>a</p><section class='comments'><p>hi</p></section><p>b</p></article>", "a\n\nb"),
    ("<article><header><h1>T</h1><p>by me</p></header><p>x</p></article>", "T\n\nx"),
    ("<div class=ad>never closed<article><p>x</p></article>", "x"),
    ("<article><p>x</p><script>var a = '</p><p>no';</script><style>p{}</style><!-- <p>no</p> --></article>", "x"),
    ("<article><form><p>no</p></form><p>x &lt;y&gt; &nbsp; z &#233; &copy</p></article>", "x <y> z é ©"),
    (f"<div id=cookie-banner><p>We use cookies</p></div><div><p>{ARTICLE}</p><p>short</p></div>", f"{ARTICLE}\n\nshort"),
    (f"<ul><li><a href=1>one</a></li><li><a href=2>two</a></li><li><a href=3>three</a></li></ul><div>{ARTICLE}</div>", ARTICLE),
    ("<article><p hidden>no</p><p style='display:none'>no</p><div role=search>no</div><p>x</p></article>", "x"),
    ("<article></article>", ""),
    (f"<div class='content with-sidebar'><p>{ARTICLE}</p></div>", ARTICLE),
    ("<article><p class=byline>By A</p><p>x</p></article>", "By A\n\nx"),
    ("<article><p>a < b and c</p><p>cut off <a href='x", "a < b and c\n\ncut off"),
]


@pytest.mark.parametrize("page,want", CASES)
def test_pages(page, want):
    assert text(page) == want


FURNITURE = [
    # Articles in furniture that is closed around them are furniture.
    (f"<article><p>x</p></article><div class=comments><article class=comment><p>{ARTICLE}</p></article></div>", "x"),
    ("<aside><article><p>teaser</p></article></aside><article><p>x</p></article>", "x"),
    (f"<div class=related><article><p>{ARTICLE}</p></article></div><div><p>{ARTICLE} x</p></div>", f"{ARTICLE} x"),
    ("<article><p>x</p><article class='comment odd'><p>hi</p></article><p>y</p></article>", "x\n\ny"),
    (f"<div><p>{ARTICLE}</p><p>{ARTICLE}</p></div><article class=comment><p>{ARTICLE} no</p></article>", f"{ARTICLE}\n\n{ARTICLE}"),
    # The end of the wrapper closes the wrapper alone.
    ("<article><div class=related><article><p>no</p></article></div><p>x</p></article>", "x"),
    # Marked lines that are a small part of the prose are not the main text.
    (f"<div><p>{ARTICLE}</p><p>{ARTICLE}</p></div><article><p>and so on</p></article>", f"{ARTICLE}\n\n{ARTICLE}\n\nand so on"),
    # Furniture that is never closed, also where another end is taken for its end.
    ("<div><section class=ad>never closed<article><p>x</p></article></div>", "x"),
    (f"<div>Hi<div class=ad>never closed<article><p>{ARTICLE}</p></article></div>", ARTICLE),
    ("<ul><li class=comment><article><p>no</p></article><li class=comment><article>no</article></ul><article>x</article>", "x"),
    # A form around the article, and names that tell what an article is about.
    ("<form><div>a</div><article><p>x</p><form>no</form></article></form>", "x"),
    ("<article class='post category-social tag-comments'><p>x</p></article>", "x"),
    ("<article class=related><p>x</p></article>", "x"),
]


@pytest.mark.parametrize("page,want", FURNITURE)
def test_articles_and_furniture(page, want):
    assert text(page) == want


LINKS = "<ul><li><a href=1>one</a><li><a href=2>two</a><li><a href=3>three</a></ul>"
LISTED = "one\n\ntwo\n\nthree"
SURGES = [
    # A list of links in a marked article is its list of sources; on other pages links weigh nothing.
    (f"<article><h1><a href=/>T</a></h1><p>{ARTICLE}</p>{LINKS}<p>Sign up</p></article>", f"T\n\n{ARTICLE}\n\n{LISTED}\n\nSign up"),
    (f"<main><p>{ARTICLE}</p><h2>Sources</h2>{LINKS}</main>", f"{ARTICLE}\n\nSources\n\n{LISTED}"),
    (f"<div>{LINKS}<p>{ARTICLE}</p>{LINKS}</div>", ARTICLE),
    # Nothing else is lost: short heads, short articles and articles of links only.
    (f"<article><h1>T</h1><p>a</p><p>b</p><p>c</p><p>{ARTICLE}</p><p>e</p></article>", f"T\n\na\n\nb\n\nc\n\n{ARTICLE}\n\ne"),
    (f"<article>{LINKS}</article>", LISTED),
    (f"<div>{LINKS}</div>", ""),
    # Without marks: the text begins at the title, however many short lines follow it.
    (f"<div>Site</div><div><h1>T</h1><p>a</p><p>b</p><p>c</p><p>d</p><p>{ARTICLE}</p></div>", f"T\n\na\n\nb\n\nc\n\nd\n\n{ARTICLE}"),
    (f"<div><h1>T</h1><nav>menu</nav><p>a</p><p>b</p><p>c</p><p>{ARTICLE}</p></div>", f"b\n\nc\n\n{ARTICLE}"),
    # Text in links counts as linked at any depth of inline elements.
    (f"<div><a href=1>{'<i>' * 9}{ARTICLE}{'</i>' * 9}</a></div><div><p>{ARTICLE} x</p></div>", f"{ARTICLE} x"),
]


@pytest.mark.parametrize("page,want", SURGES)
def test_surges(page, want):
    assert text(page) == want


ANCHORS = [
    # Ids of the parts of an article are anchors; whole words name furniture.
    ("<article><div class='commentary'><p>a</p><p>b</p></div></article>", "a\n\nb"),
    ("<article><section id='search'><p>a</p></section><section id='related-work'>b</section></article>", "a\n\nb"),
    ("<article><h2 id='feedback'>a</h2><h2 id='register-machines'>b</h2><h3 id=comments>c</h3><p id=share>d</p></article>", "a\n\nb\n\nc\n\nd"),
    ("<article><p>a</p><section id='comments'><p>hi</p></section><div id='sidebar'>no</div></article>", "a"),
    (f"<div><p class='shareholders'>{ARTICLE}</p><div class='recommended'>no</div></div>", ARTICLE),
    (f"<section id=search>find</section><div><p>{ARTICLE}</p></div>", ARTICLE),
]


@pytest.mark.parametrize("page,want", ANCHORS)
def test_ids_and_names(page, want):
    assert text(page) == want


def plain_lines(weights, titles, window=3, surge=80):
    """Surges and dives, line by line: the numbers of the lines between them."""
    sums = [sum(weights[i : i + window]) for i in range(len(weights))]
    if not any(weights):
        return []
    least, kept, i = min(surge, max(sums)), [], 0
    while i < len(weights):
        if sums[i] < least:
            i += 1
            continue
        first = i
        for j in range(i - 1, -1, -1):
            if not weights[j] or j in kept:
                break
            first = j if titles[j] else first
        while i < len(weights) and sums[i]:
            i += 1
        kept += [j for j in range(first, i) if weights[j]]
    return sorted(set(kept))


def test_distribution_equals_a_plain_version():
    rnd = random.Random(12)
    for _ in range(600):
        lines = []
        for k in range(rnd.randint(0, 25)):
            size = rnd.choice([0, 0, 5, 12, 30, 79, 80, 200])
            body = f"{k:02d}"[:size] + "x" * max(0, size - 2)
            lines.append(Line(body, rnd.choice([0, 0, 0, size]), False, rnd.random() < 0.1))
        weights = [0 if 2 * x.linked > len(x.text) else len(x.text) for x in lines]
        want = [lines[j].text for j in plain_lines(weights, [x.title for x in lines])]
        assert main_lines(lines) == want


def test_marks_are_weights():
    """Marked lines surge by themselves, others count nothing, unless the marks hold little prose."""
    lines = [Line("menu"), Line(ARTICLE), Line("a", 0, True), Line("link", 4, True), Line(""), Line("", 0, True)]
    assert line_weights(lines).tolist() == [4, len(ARTICLE), 1, 0, 0, 0]
    lines = [Line("menu"), Line(ARTICLE + "!"), Line(ARTICLE, 0, True), Line("a", 0, True), Line("link", 4, True)]
    assert line_weights(lines).tolist() == [0, 0, len(ARTICLE), 80, 80]


def test_long_pages_take_linear_time():
    assert len(text("<article>" + "<p>word</p>" * 20_000 + "<b>" * 5_000)) > 100_000
    text("<" * 20_000 + "\"'" * 5_000)


def test_open_and_stray_tags_take_linear_time():
    n, start = 64_000, time.time()
    text("<b>" * n + "</i>" * n)
    text("<div>" + "<b>" * n + "<p>x</p>" * n)
    text("<li><div>" + "<b>" * n + "<li>x</li>" * n)
    text("<article><header><h1>" + "<b>" * n + "x<i>" * n)
    assert time.time() - start < 20


def test_rows(spark):
    rows = [(1, "u", "<article><p>x</p>"), (1, "u", "<article><p>x</p>"), (None, None, None), (2, None, "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as TEXT", "2 as Html")
    got = sorted(map(tuple, extract_text(df).collect()), key=repr)
    assert got == sorted([(1, "u", "x", 1)] * 2 + [(None, None, "", 0), (2, None, "", 0)], key=repr)
    assert extract_text(df.limit(0)).count() == 0

"""Main text of pages against a plain reading of the generated pages, and hand-made pages."""

import html
import random
import re
from collections import Counter

import duckdb
import pytest

from valuekit.llm import html_blocks
from valuekit.llm.shared import table


def plain(page):
    body = re.search(r"<article>(.*)</article>", page, re.S)[1]
    blocks = re.split(r"</?(?:p|h1)>", re.sub(r"<br>|</?b>", " ", body))
    return "\n".join(t for t in (" ".join(html.unescape(b).split()) for b in blocks) if t)


def test_query_rows(spark, sf):
    pages = {r.page_id: r for r in table(spark, sf, "pages").collect()}
    got = html_blocks.op2_html_blocks(spark, sf).collect()
    assert len(got) == len(pages)
    for r in got:
        assert r.url == pages[r.page_id].url
        assert r.text == plain(pages[r.page_id].html)
        assert r.n_chars == len(r.text)


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""),
        ("", ""),
        ("<nav><a href=x>a</a></nav>", ""),
        ("just  words &amp; more", "just words & more"),
        ("<p>One &lt;b&gt;<br>two<p>three &unknown; &am", "One <b> two\nthree &unknown; &am"),
        ("<header>site</header><article><h1>T</h1><p>a</p><div class='ad'>buy</div><p>b</p></article><section id=comments><p>nice one</p></section>", "T\na\nb"),
        ("<script>var a='<p>no</p>'</script><style>p{}</style><!-- <p>no</p> --><main><p>yes</p></main><aside>no</aside>", "yes"),
        ("<nav><ul><li><a href='/'>Home</a><article><p>in</p></article>", "in"),
        ("<form><label>Name</label><input></form><div><p>" + "long text " * 20 + "</p></div><footer>(c)</footer>", ("long text " * 20).strip()),
        ("<p title='a>b'>kept</p>", "kept"),
        ("<div>" + "the story goes on " * 9 + "</div><section class='comments'><article><p>" + "nice one indeed " * 9 + "</p></article></section>", ("the story goes on " * 9).strip()),
        ("<div><p>" + "the story goes on " * 9 + "</p></div><article><p>related</p></article>", ("the story goes on " * 9).strip() + "\nrelated"),
        ("<article><p>a</p><div class='post-comments'>b</div><div class='comment-body'>c</div><div class='sidebar-content'>d</div><div class='ad-content'>e</div></article>", "a"),
        ("<article><div class='post-header'><h1>T</h1></div><p>a</p><p><a href=x>all of it a link</a></p><ul><li><a>1</a></li><li><a>2</a></li><li><a>3</a></li></ul></article>", "T\na\nall of it a link\n1\n2\n3"),
        ("<div class='content with-sidebar'><p>The sum of <math><mi>x</mi></math> and <label>y</label> is a number that many would know by heart.</p></div>", "The sum of x and y is a number that many would know by heart."),
    ],
)
def test_pages(page, text):
    assert html_blocks.main_text(page) == text


def test_all_pages_with_and_without_their_marks():
    pages = [r[0] for r in duckdb.sql("SELECT html FROM '/root/testdata/sf0.1/pages.parquet'").fetchall()]
    lines = right = 0
    for page in pages:
        text = plain(page)
        assert html_blocks.main_text(page) == text
        bare = re.sub(r' class="[^"]*"', "", re.sub(r"<(/?)article>", r"<\1div>", page))
        got, expected = Counter(html_blocks.main_text(bare).split("\n")), Counter(text.split("\n"))
        lines, right = lines + expected.total(), right + (got & expected).total()
    assert right >= 0.98 * lines


def plain_kept(lengths):
    """Line by line: whether a window that reaches the surge began before, with no empty window since."""
    window = lambda i: sum(lengths[i : i + html_blocks.WINDOW])
    least = min(html_blocks.SURGE, max((window(i) for i in range(len(lengths))), default=0))
    return [least > 0 and any(window(j) >= least and all(window(k) > 0 for k in range(j, i + 1)) for j in range(i + 1)) for i in range(len(lengths))]


def test_surges_and_dives():
    picks = random.Random(1)
    for _ in range(300):
        lengths = [picks.choice([0, 0, 0, 5, 20, 45, 90]) for _ in range(picks.randrange(12))]
        assert html_blocks.kept_lines(lengths) == plain_kept(lengths)


def test_line_blocks_without_article_marks():
    words = "words of the story that go on for a while, more than any menu has. " * 3
    menu = "".join(f"<div><a href=/{i}>item {i}</a></div>" for i in range(9))
    page = f"<div>{menu}</div><div><h2>Title</h2><p>{words}</p><p>Short.</p><p>{words}</p></div><div>{menu}</div>"
    assert html_blocks.main_text(page) == "\n".join(["Title", words.strip(), "Short.", words.strip()])


def test_defined_cases(spark):
    rows = [(1, "u", None, "x"), (1, "u", None, "x"), (None, None, "<p>a</p>", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = html_blocks.extract_text(pages)
    assert sorted((str(r.page_id), r.text, r.n_chars) for r in got.collect()) == [("1", "", 0), ("1", "", 0), ("None", "a", 1)]
    assert html_blocks.extract_text(pages.limit(0)).count() == 0

import random
import re
import time

import pytest
from pyspark.sql import functions as F

from textjury.llm import html_text

SCHEMA = "page_id long, url string, html string"


def own(html):
    """A page by itself, without votes of a host."""
    return html_text.extract(html, {})


CASES = [
    ("", ""),
    ("just text", "just text"),
    ("<html><body></body></html>", ""),
    ("<article><h1>A  title</h1><p>One\n two</p>\n<p>Three</p></article>", "A title\nOne two\nThree"),
    ("<article><p>a &amp; b &lt;i&gt; &#233;&nbsp;&eacute; &copy</p></article>", "a & b <i> é é ©"),
    ("<nav><ul><li>Menu</ul></nav><article><p>Text.</p></article><footer>f</footer>", "Text."),
    ("<article><p>Text<p>without<p>ends</article><div>after the article</div>", "Text\nwithout\nends"),
    ("<article><p><b>Bold<br><p>next</p></article>", "Bold\nnext"),
    ("<article>a<br>b<script>var t='</p>';</script> c</article>", "a b c"),
    ("<article><style>p{}</style><p>x</p><!-- <p>no</p> --><form><input value=q>ask</form></article>", "x"),
    ("<article><p>x</p><section class='comments'><p>reader says</p></section></article>", "x"),
    ("<article><p>x</p><div id=reply-12 class=reply>no</div></article>", "x\nno"),
    ("<article><p>x</p><div class='ad-box'>buy</div><p class=cookie-notice>ok?</p><aside>s</aside></article>", "x"),
    ("<article><header><h1>T</h1><p>by someone</p></header><p>x</p></article>", "T\nx"),
    ("<body class='with-sidebar'><div class=content><p>main text here</p></div><div class=sidebar><p>a side</p></div>", "main text here"),
    ("<div id=a><h1>Head</h1><div class=text><p>One two three.</p><p>Four.</p></div></div><div>x</div>", "Head\nOne two three.\nFour."),
    ("<article><p>x <span hidden>no</span>y</p><p style='display: none'>n</p></article>", "x\ny"),
    ("<article><ul><li>a<li>b</ul><table><tr><td>c<td>d<tr><td>e</table></article>", "a\nb\nc\nd\ne"),
    ("<article><p title='a>b'>x</p><p title=it's>y</p></article>", "x\ny"),
    ("<article><p>1 < 2 and 3 > 2</p><p>open <b", "1 < 2 and 3 > 2\nopen"),
    ("<article><p>x</p><textarea><p>no</textarea><title>t</title><p>z</p></article>", "x\nz"),
    ("<ARTICLE><P>Up</P></ARTICLE>", "Up"),
    ("<article><p>x</i></div></p><p>y</article>", "x\ny"),
    ("<div class=ad><p>only an advert on the page</p></div>", "only an advert on the page"),
]


@pytest.mark.parametrize("html, text", CASES)
def test_single_pages(html, text):
    assert own(html) == text


def test_hostile_pages_take_linear_time():
    for part in ("<a b='", '<p x="', "<!--", "<", "</", "<p ", "<script>", "&#", "<div>", "<b>", "<p a=", "<p ="):
        own(part * 3000)
    assert own("<article>" + "<p>x</p>" * 20_000 + "</article>").count("\n") == 19_999


def test_hosts_vote(spark):
    """Where a long related text would win a page, the host's other pages outvote it."""
    usual = "<div class='story-{n}'><p>The story of this page, number {n}, in some words.</p></div><div class=box><p>short</p></div>"
    odd = "<div class='story-9'><p>A short story.</p></div><div class=box><p>A text in the box that is longer than the story.</p></div>"
    pages = [(i, "https://user@Site.example:80/x", usual.format(n=i)) for i in range(8)] + [(9, "http://site.example?q", odd)]
    pages += [(10, "http://other.example/", odd)]
    table = spark.createDataFrame(pages, SCHEMA)
    got = {r["page_id"]: r["text"] for r in html_text.main_text(table).collect()}
    assert got[9] == "A short story."
    assert got[3] == "The story of this page, number 3, in some words."
    assert got[10] == "A text in the box that is longer than the story."
    joined = html_text.main_text(table, broadcast_rows=0)
    assert {r["page_id"]: r["text"] for r in joined.collect()} == got


def test_long_paths_keep_siblings_apart(spark):
    """An ancestor whose path is longer than any bound does not stand for what is beside the story."""
    wide = "c" * 3000
    story = "<p>The story of this page, number {n}, in some words that go on for a while.</p>"
    links = "<ul><li><a href=/>a link</a> and words beside it</li></ul>"
    page = f"<body><div class={wide}><div class=story>{story}</div><div class=links>{links}</div></div>"
    table = spark.createDataFrame([(i, "http://long.example/", page.format(n=i)) for i in range(6)], SCHEMA)
    for rows in (1000, 0):
        got = {r["text"] for r in html_text.main_text(table, broadcast_rows=rows).collect()}
        assert got == {f"The story of this page, number {i}, in some words that go on for a while." for i in range(6)}


def test_many_templates_on_one_host(spark):
    """Every template's votes count, also the twentieth's and those of the hundredth."""
    usual = "<div class=story-{t}><p>The story of the page in some words.</p></div><div class=box><p>short</p></div>"
    odd = "<div class=story-{t}><p>A short story.</p></div><div class=box><p>A text that is longer than the story.</p></div>"
    names = [f"{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(100)]
    pages = [(n, "http://many.example/", usual.format(t=t)) for n, t in enumerate(names) for _ in range(3)]
    pages += [(1000 + n, "http://many.example/", odd.format(t=t)) for n, t in enumerate(names)]
    table = spark.createDataFrame(pages, SCHEMA)
    votes = {t: 3 for t in names} | {"box": 100}
    for rows in (1000, 0):
        got = {r["page_id"]: r["text"] for r in html_text.main_text(table, broadcast_rows=rows).collect()}
        story, box = "A short story.", "A text that is longer than the story."
        expected = story if votes["aa"] * len(story) > votes["box"] * len(box) else box
        assert {got[1000 + n] for n in range(100)} == {expected}
    assert html_text.host_paths(table).count() == 101


def test_deep_pages_take_linear_time():
    shapes = ["<div>x", "<blockquote>x", "<li>x", "<td>x", "<section><p>x", "<div>x</p></i>", "<ul><li>x", "<b>x<div>y"]

    def seconds(shape, n):
        start = time.perf_counter()
        html_text.extract(shape * n, {b"none": 1})
        html_text.vote(shape * n)
        return time.perf_counter() - start

    for shape in shapes:
        seconds(shape, 100)
        assert seconds(shape, 16_000) < 10 * max(seconds(shape, 4_000), 0.02), shape


def plain_dom(html):
    """Text of a generated page by a tree of its own: the one container with most text outside links, its blocks in order."""
    tree, stack = ("#", []), []
    node = tree
    for token in re.findall(r"<[^>]+>|[^<]+", html):
        if token.startswith("</"):
            node = stack.pop()
        elif token.startswith("<"):
            stack.append(node)
            node[1].append((token[1:-1], []))
            node = node[1][-1]
        elif token.strip():
            node[1].append(" ".join(token.split()))

    def blocks(at):
        own = [c for c in at[1] if isinstance(c, str)]
        below = [b for c in at[1] if not isinstance(c, str) for b in blocks(c)]
        return own + below

    def containers(at):
        for c in at[1]:
            if not isinstance(c, str):
                yield c
                yield from containers(c)

    found = [c for c in containers(tree) if c[0].startswith("div") and any(not isinstance(k, str) and k[0] == "p" for k in c[1])]
    best = max(found, key=lambda c: sum(len(b) for k in c[1] if not isinstance(k, str) and k[0] == "p" for b in blocks(k)))
    return "\n".join(blocks(best))


def test_equals_a_plain_tree_on_generated_pages():
    rng = random.Random(7)
    for _ in range(200):
        columns = ["".join(f"<p>{'word ' * rng.randint(1, 6)}</p>" for _ in range(rng.randint(1, 3))) for _ in range(3)]
        columns[rng.randrange(3)] = "".join(f"<p>{'text ' * rng.randint(20, 30)}</p>" for _ in range(rng.randint(2, 5)))
        page = "<body><section>" + "".join(f"<div class=c{chr(97 + i)}>{c}</div>" for i, c in enumerate(columns)) + "</section></body>"
        assert own(page) == plain_dom(page)


def test_nulls_repeats_and_extra_columns(spark):
    page = "<article><p>Some text.</p></article>"
    pages = [(1, None, page), (2, "http://a.example/", None), (None, "http://a.example/", page), (3, "", ""), (3, "", ""), (4, "no url", page)]
    table = spark.createDataFrame(pages, SCHEMA).withColumns({"text": F.lit("x"), "host": F.lit("y"), "paths": F.lit(0)})
    got = sorted(((r["page_id"], r["url"], r["text"]) for r in html_text.main_text(table).collect()), key=repr)
    expected = [(1, None, "Some text."), (2, "http://a.example/", ""), (None, "http://a.example/", "Some text."), (3, "", ""), (3, "", ""), (4, "no url", "Some text.")]
    assert got == sorted(expected, key=repr)
    assert html_text.main_text(table.limit(0)).count() == 0


STORY = "<article><h2>Title</h2><p>The story of the page in some words, long enough to be it.</p></article>"
TEXT = "Title\nThe story of the page in some words, long enough to be it."
HEAD = "<header><h1>Site name</h1></header>"


@pytest.mark.parametrize("name", ["content-sidebar-wrap", "layout-sidebar-right", "page-menu-open", "header-wrap"])
def test_wrappers_by_name(name):
    assert own(f"<body>{HEAD}<div class={name}>{STORY}<div class=sidebar><p>a side</p></div></div>") == TEXT
    assert own(f"<body>{HEAD}<div id={name}><main>{STORY}</main></div>") == TEXT
    plain = STORY.replace("article", "div")
    assert own(f"<body>{HEAD}<div class={name}>{plain}<div class=sidebar><p>a side</p></div></div>") == TEXT


def test_page_in_a_form():
    assert own(f"<body><form action=/>{HEAD}{STORY}<span hidden>no</span><input><button>go</button></form>") == TEXT
    assert own(f"<body><form><div><p>Some <span hidden>no</span>text.</p></div></form>") == "Some\ntext."


def test_what_is_dropped_beside_a_story_stays_dropped():
    plain = STORY.replace("article", "div")
    more = "<p>" + "other words, " * 30 + "</p>"
    assert own(f"<div class=story>{plain}</div><div class=comments>{more}</div>") == TEXT
    assert own(f"{STORY}<div class=related-posts>{more}</div><form>{more}</form>") == TEXT
    assert own(f"{STORY}<div class=sidebar><article>{more}</article></div>") == TEXT

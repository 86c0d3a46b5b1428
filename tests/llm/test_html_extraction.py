import html as entities
import re

import numpy as np
import pytest

from salesmart.llm import html_extraction as X
from salesmart.llm.common import table
from salesmart.llm.registry import op6_html_extraction

from .conftest import SF

BODY = "This is a long paragraph of the article with plenty of words in it, so that it is content. " * 3


def page(inside, before="", after="", container="article"):
    return (
        f"<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style><script>var a='<p>x</p>'</script></head><body>"
        f"<nav><ul><li><a href='/'>Home</a></li></ul></nav>{before}<{container}>{inside}</{container}>{after}"
        f"<footer>&copy; all rights</footer></body></html>"
    )


def text(html):
    return "\n".join(X.main_blocks(html))


@pytest.mark.parametrize(
    "aside",
    [
        '<div class="ad">Buy now</div>',
        '<aside><p>See also this</p></aside>',
        '<form><label>Mail</label><input name="m"><button>Go</button></form>',
        '<div id="cookie-notice"><p>We use cookies</p></div>',
        '<section class="comments"><h2>Comments</h2><p>First! ' + BODY + "</p></section>",
        '<div role="navigation">One Two</div>',
        '<div style="display: none">unseen</div>',
        "<script>document.write('<p>no</p>')</script>",
        "<noscript>Turn it on</noscript>",
        "<!-- <p>remark</p> -->",
        '<ul class="share-buttons"><li>Tweet</li></ul>',
    ],
)
@pytest.mark.parametrize("container", ["article", "main", 'div class="post"'])
def test_what_is_left_out(aside, container):
    html = page(f"<h1>Title</h1><p>{BODY}</p>{aside}<p>Sh is.</p><p>{BODY}</p>", before=aside, after=aside, container=container)
    html = html.replace(f"</{container}>", f"</{container.split()[0]}>")
    one = " ".join(BODY.split())
    assert text(html) == f"Title\n{one}\nSh is.\n{one}"


def test_blocks_references_and_white_space():
    html = page(f"<h2>A &amp; B &lt;c&gt;</h2><p>one\n  two\tthree&nbsp;four <b>bo</b>ld<br>next</p><ul><li>x</li><li>y</li></ul><p>{BODY}")
    assert text(html) == "A & B <c>\none two three four bold next\nx\ny\n" + " ".join(BODY.split())


def test_driver_pages_match_their_articles(spark):
    pages = {r.page_id: r.html for r in table(spark, SF, "pages").collect()}
    got = op6_html_extraction(spark, SF).collect()
    assert len(got) == len(pages)
    for r in got:
        article = re.search(r"<article>(.*)</article>", pages[r.page_id], re.S).group(1)
        parts = [" ".join(entities.unescape(re.sub(r"<[^>]*>", "", p)).split()) for p in re.split(r"</?p>|</?h1>", article)]
        assert r.text == "\n".join(p for p in parts if p) and r.n_chars == len(r.text)


@pytest.mark.parametrize(
    "html,want",
    [
        (None, ""),
        ("", ""),
        ("   ", ""),
        ("plain words", "plain words"),
        ("<p>open <b>bold <i>more", "open bold more"),
        ("</div></p>stray", "stray"),
        ("<p>cut &am", "cut &am"),
        ("<div>" * 500 + "<p>a</p><p>b</p>" + "</div>" * 500, "a\nb"),
        ("<html><body><nav>only menu</nav></body></html>", ""),
        ('<div class="ad">all there is</div>', "all there is"),
        ("<p>" + "x" * 200_000 + "</p>", "x" * 200_000),
        ("<article><p>one</p></article><article><p>one and more</p></article>", "one and more"),
    ],
)
def test_edge_cases(html, want):
    assert text(html) == want


ONE = " ".join(BODY.split())


@pytest.mark.parametrize("name", ["content no-sidebar", "has-sidebar", "site with-banner", "nav-fixed", "post social", "comments-open"])
@pytest.mark.parametrize("container", ["article", "div"])
def test_names_do_not_drop_the_text_of_a_page(name, container):
    html = (
        f'<body><a href="#c">Skip to content</a><div class="{name}"><{container}><h1>Title</h1><p>{BODY}</p><p>{BODY}</p></{container}>'
        f'<div class="sidebar"><p>See also</p></div></div><p>&copy; 2020</p></body>'
    )
    assert text(html) == f"Title\n{ONE}\n{ONE}"


def test_posts_with_a_misleading_name_stay_together():
    posts = "".join(f'<div class="post social" id="p{i}"><p>{i} {BODY}</p></div>' for i in range(5))
    html = f'<body><a href="#c">Skip to content</a>{posts}<div class="ad"><p>Buy now</p></div></body>'
    assert text(html) == "\n".join(f"{i} {ONE}" for i in range(5))


def test_many_comments_go():
    comments = "".join(f'<div class="comment" id="comment-{i}"><p>{BODY}</p></div>' for i in range(9))
    assert text(f'<body><div><p>The post. {BODY}</p></div><div id="comments">{comments}</div></body>') == f"The post. {ONE}"
    assert text(f'<article><p>The post. {BODY}</p><div id="comments">{comments}</div></article>') == f"The post. {ONE}"


def test_landmarks_that_share_the_text_come_together():
    assert text(f"<main><p>Own. {BODY}</p><article><p>{BODY} End of it.</p></article></main>") == f"Own. {ONE}\n{ONE} End of it."
    assert text(f"<article><p>One. {BODY}</p></article><article><p>{BODY} Some more words.</p></article>") == f"One. {ONE}\n{ONE} Some more words."
    assert text(f"<main><article><p>{BODY * 9}</p></article><article><p>{BODY}</p></article></main>") == " ".join([ONE] * 9)


@pytest.mark.parametrize(
    "html,want",
    [
        ("<html><head><title>t</title><body><article><p>words</p></article></body></html>", "words"),
        ("<head><title>t</title><meta charset=utf-8><article><p>words</p></article>", "words"),
        ("<head><title>t</title><noscript><p>no</p></noscript><body><p>words</p>", "words"),
        ("<head><title>t</title>words", "words"),
        ("<html><head><title>t</title><style>p{}</style></head><body><p>words</p></body></html>", "words"),
    ],
)
def test_a_head_without_end(html, want):
    assert text(html) == want


@pytest.mark.parametrize("container", ["article", "div"])
def test_a_form_around_the_page(container):
    html = page(
        f"<h1>Title</h1><p>{BODY}</p><p>{BODY}</p><select><option>One<option>Two</select><textarea>x</textarea><button>Go</button>",
        container=container,
    )
    html = html.replace("<body>", '<body><form id="aspnetForm" method="post"><input type="hidden" name="s">').replace("</body>", "</form></body>")
    assert text(html) == f"Title\n{ONE}\n{ONE}"


def test_without_landmarks_the_dense_region_is_taken():
    links = "".join(f'<li><a href="/{i}">link {i}</a></li>' for i in range(20))
    html = f"<body><ul>{links}</ul><div><h1>Head</h1><p>{BODY}</p><p>Short.</p><p>{BODY}</p></div><ul>{links}</ul></body>"
    one = " ".join(BODY.split())
    assert text(html) == f"Head\n{one}\nShort.\n{one}"


def test_smoothing_and_clusters():
    flat = np.full(9, 5.0)
    assert np.allclose(X.smoothed(flat), flat)
    assert X.upper_cluster(flat).all()
    values = np.array([1.0, 2, 1, 50, 60, 55, 2, 1])
    assert X.upper_cluster(values).tolist() == [False] * 3 + [True] * 3 + [False] * 2


def test_other_columns_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "u", "<p>a</p>", "b", "t"), (None, None, None, None, None), (1, "u", "<p>a</p>", "b", "t")],
                               "page_id long, url string, html string, blocks string, text string")
    rows = X.extract_pages(df, "page_id", "html", "url").collect()
    assert sorted((r.page_id or 0, r.text, r.n_chars) for r in rows) == [(0, "", 0), (1, "a", 1), (1, "a", 1)]
    assert X.extract_pages(df.where("false"), "page_id", "html", "url").count() == 0


SENTENCES = [f"Row {i} tells in one sentence of {'some ' * (i % 4)}thing number {i}." for i in range(20)]
MENU = "<ul>" + "".join(f'<li><a href="/{i}">Menu entry {i}</a></li>' for i in range(8)) + "</ul>"


@pytest.mark.parametrize(
    "inside,want",
    [
        ("<table>" + "".join(f"<tr><td>{x}</td></tr>" for x in SENTENCES) + "</table>", SENTENCES),
        ("<table>" + "".join(f"<tr><td>{x}" for x in SENTENCES) + "</table>", SENTENCES),
        ("<table><tbody>" + "".join(f"<tr><th>{i}<td>{x}" for i, x in enumerate(SENTENCES)) + "</table>",
         [y for i, x in enumerate(SENTENCES) for y in (str(i), x)]),
        ("<dl>" + "".join(f"<dt>Term {i}</dt><dd>{x}</dd>" for i, x in enumerate(SENTENCES)) + "</dl>",
         [y for i, x in enumerate(SENTENCES) for y in (f"Term {i}", x)]),
        ("<dl>" + "".join(f"<dt>Term {i}<dd>{x}" for i, x in enumerate(SENTENCES)) + "</dl>",
         [y for i, x in enumerate(SENTENCES) for y in (f"Term {i}", x)]),
        (f'<h1>Title</h1><p>{BODY}</p><p><a href="/x">A paragraph that is one link</a>.</p><p>{BODY}</p>',
         ["Title", ONE, "A paragraph that is one link.", ONE]),
        (f'<h1>Title</h1><p>{BODY}</p><p><a href="/x">A paragraph that is one link</a></p>', ["Title", ONE, "A paragraph that is one link"]),
        (f"<section><h1>Title</h1><p>{BODY * 4}</p></section><section><p>Short one.</p><p>Short two.</p></section>",
         ["Title", " ".join([ONE] * 4), "Short one.", "Short two."]),
        (f"<div><p>{BODY * 4}</p></div><div><p>Short one.</p><p>Short two.</p></div>", [" ".join([ONE] * 4), "Short one.", "Short two."]),
        (f"<h1>Title</h1><ul><li>{BODY}<li>{BODY}</ul><p>End.</p>", ["Title", ONE, ONE, "End."]),
    ],
)
@pytest.mark.parametrize("menu", [False, True])
def test_without_landmarks_all_blocks_of_the_region_come(inside, want, menu):
    around = f"<div>{MENU}</div>" if menu else ""
    assert text(f"<html><body>{around}<div>{inside}</div>{around}</body></html>") == "\n".join(want)


def test_cells_of_a_layout_table():
    html = f"<table><tr><td>{MENU}<td><h1>Title</h1><p>{BODY}</p><p>Short.</p></table>"
    assert text(html) == f"Title\n{ONE}\nShort."


@pytest.mark.parametrize("unit", ["<tr><td>word", "<div>word", "<ul><li>word", "<div class='ad x'>word", "<div><b>word</b>", "<article>word", "<dl><dt>a<dd>word"])
def test_open_elements_cost_no_square(unit):
    import time

    start = time.process_time()
    got = X.main_blocks("<table>" * unit.startswith("<tr") + unit * 16_000)
    assert got and time.process_time() - start < 5


def _by_paths(html):
    """The same decision about names, read off whole paths of open elements (slow)."""
    reader = X.LineReader()
    reader.feed(html)
    lines = reader.finish()
    if not lines:
        return []

    def path(k):
        return [k] + path(reader.parents[k]) if k else []

    named = {k: x for k, x in reader.named.items() if k not in reader.holding}
    marked = X._marked(lines)
    keys = [[named[k] for k in path(x.holder) if k in named] for x in lines]
    spoken = {i for i, x in enumerate(keys) if any(c for _, c in x)}
    gone = spoken if any(m and i not in spoken for i, m in enumerate(marked)) else set()
    rest = [i for i in range(len(lines)) if i not in gone]
    weight, total = {}, sum(len(lines[i].text) for i in rest if marked[i])
    for i in rest:
        for key in {key for key, _ in keys[i]}:
            weight[key] = weight.get(key, 0) + len(lines[i].text) * bool(marked[i])
    minor = {key for key, w in weight.items() if w < X.NAMED_SHARE * total}
    while True:
        left = [i for i in rest if not minor & {key for key, _ in keys[i]}]
        if not minor or sum(len(lines[i].text) for i in left if marked[i]) > (1 - X.REGION_SHARE) * total:
            return [lines[i].text for i in left]
        minor.remove(max(minor, key=lambda key: (weight[key], key)))


def test_names_against_whole_paths():
    rng = np.random.default_rng(5)
    for _ in range(300):
        html = []
        for _ in range(int(rng.integers(3, 40))):
            tag = str(rng.choice(["div", "section", "article", "form", "p", "li", "ul"]))
            name = str(rng.choice(["", "", "ad", "comment", "sidebar box", "social", "post", "no-sidebar"]))
            html.append(f'<{tag} class="{name}">' if name else f"<{tag}>")
            html.append("word " * int(rng.integers(1, 60)))
            if rng.random() < 0.6:
                html.append(f"</{rng.choice(['div', 'section', 'article', 'form', 'li', 'ul'])}>")
        html = "".join(html)
        reader = X.LineReader()
        reader.feed(html)
        assert [x.text for x in X._unnamed(reader.finish(), reader)] == _by_paths(html)

import html
import re
import time

import pytest
from hypothesis import given
from hypothesis import strategies as st

from dayfold.llm.html_extract import (
    article_blocks,
    blocks_of,
    extract_pages,
    parse,
    read_skeleton,
    skeleton,
    tree_match,
    written,
)

from .conftest import prose


def text_of(page):
    tree = parse(page)
    skeleton(tree)
    return " ".join(b.text for b in article_blocks(blocks_of(tree)))


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("", ""),
        ("a < b &amp; c", "a < b & c"),
        ("<p>a<b>b</b>c<br>d&nbsp;&nbsp;e</p><ul><li>1<li>2</ul>", "abc d e 1 2"),
        ("<table><tr><td>a<td>b<tr><td>c</table>", "a b c"),
        ('x<div class="x', "x"),
        ('<a href="q>t</a>z', "tz"),
        ("<script>var a = '<p>x</p>'</script><style>y", ""),
        ("<nav>n</nav><header>h</header><p>x<p>y<footer>f</footer><aside>s</aside><form>q</form>", "x y"),
        ('<div class="ad">a</div>x<div id="cookie-notice">n</div>y<ol class=comments><li>c</ol><i hidden>h</i>', "x y"),
        ("<p>out</p><article><h1>t</h1><p>in</p></article>", "t in"),
        ("<!-- x --><body><!doctype html><p>x</p><!-- never ended", "x"),
        ('<div class="layout has-sidebar"><h1>T</h1><p>Body</p></div>', "T Body"),
        ('<div class="page with-sidebar"><div id=main><p>Body</p></div></div>', "Body"),
        ('<div class="entry-title">T</div><div><p>Body of it</p><p>and more</p></div>', "T Body of it and more"),
        ("<div><p>A body that goes on and on for long</p></div><article>More</article>", "A body that goes on and on for long More"),
        ("<main><p>Lead</p><article><p>In</p></article></main>", "Lead In"),
        ('<article><p>a</p><section id="related-work"><p>b</p></section><div class="copyright-law">c</div><h2 id="how-to-search">d</h2></article>', "a b c d"),
        ("<article>a<xmp><b>code</b> &amp;</xmp>b</article>", "a <b>code</b> &amp; b"),
        ('<article>a<ul class="thread"><li>Reader says hi</ul></article>', "a"),
        ('<div class="site-footer">f</div><div class="main-menu">m</div><div class="post-comments">c</div><div class="post-header"><h1>t</h1></div>', "t"),
        ("<div>" * 3000 + "deep" + "</div>" * 3000, "deep"),
    ],
)
def test_blocks(page, text):
    assert text_of(page) == text


@given(st.text("<>/=\"' apdiv!-&;", max_size=60))
def test_any_markup_is_read(page):
    tree = parse(page)
    shape = skeleton(tree)
    assert read_skeleton(written(shape)) == shape
    blocks_of(tree)


def leaf(name, *children):
    return (name, tuple(children))


def plain_match(a, b):
    """Simple tree matching by its recursive definition."""
    if a[0] != b[0]:
        return 0

    def best(xs, ys):
        if not xs or not ys:
            return 0
        return max(best(xs[1:], ys), best(xs, ys[1:]), plain_match(xs[0], ys[0]) + best(xs[1:], ys[1:]))

    return 1 + best(a[1], b[1])


trees = st.recursive(st.builds(leaf, st.sampled_from("ab")), lambda t: st.builds(lambda n, c: (n, tuple(c)), st.sampled_from("ab"), st.lists(t, max_size=3)), max_leaves=7)


@given(trees, trees)
def test_tree_match(a, b):
    size, pairs = tree_match(a, b)
    assert size == plain_match(a, b) == len(pairs)


def test_pages_against_their_articles(spark, folder):
    pages = spark.read.parquet(f"{folder}/pages.parquet")
    got = {r.page_id: r for r in extract_pages(pages).collect()}
    for page in pages.collect():
        inside = re.search("<article>(.*?)(?:</article>|$)", page.html, re.S)[1]
        inside = re.sub("<(?!/?b>)[^>]*>", " ", inside)
        expected = " ".join(html.unescape(re.sub("</?b>", "", inside)).split())
        r = got[page.page_id]
        assert (r.url, r.text, r.n_chars) == (page.url, expected, len(expected))


def plain_page(n, paragraphs, kind=0, footer="All of it by us"):
    body = "".join(f"<p>{prose(12, 50 * n + k)}</p>" for k in range(paragraphs))
    if kind:
        return f"<body><section><h2>Shop</h2></section><table><tr><td>{body}</td></tr></table><section><p>{footer}</p></section></body>"
    return f"<body><div><span>Home News Contact</span></div><div>{body}<p>Tell your friends</p></div><div><p>{footer}</p></div></body>"


def plain_wrapper(pages):
    """What a host's pages keep: blocks by path, without texts that half of the different pages with that path have in it.

    Skeletons count as one kind if they are equal; there is no alignment and no word list.
    """
    kinds = {}
    for number, page in pages:
        tree = parse(page)
        shape = written(skeleton(tree))
        kinds.setdefault(shape, []).append((number, [(b.path, b.text) for b in blocks_of(tree)]))
    out = {}
    for own in kinds.values():
        different = {tuple(blocks) for _, blocks in own}
        for number, blocks in own:
            left = [
                text
                for path, text in blocks
                if not sum((path, text) in other for other in different) >= max(3, len(different) / 2)
            ]
            out[number] = " ".join(left or [text for _, text in blocks])
    return out


def test_what_is_constant_on_a_host_is_template(spark):
    """No markup names the parts here; only the comparison of pages tells them apart."""
    hosts = {
        # One page in a hundred has another footer, and pages have one to four paragraphs.
        "a": [(n, plain_page(n, 1 + n % 4, footer="Other" if n == 7 else "All of it by us")) for n in range(100)],
        # Two kinds of pages.
        "b": [(200 + n, plain_page(n, 2, kind=n % 5 > 2)) for n in range(20)],
        # Three pages, two pages, and pages that are all equal.
        "c": [(300 + n, plain_page(n, 2)) for n in range(3)],
        "d": [(400 + n, plain_page(n, 2)) for n in range(2)],
        "e": [(500 + n, plain_page(1, 2)) for n in range(6)],
        # Copies of one page are no template.
        "f": [(600 + n, plain_page(0 if n < 8 else n, 2)) for n in range(12)],
    }
    rows = [(n, f"http://{host}.example/{n}", page) for host, pages in hosts.items() for n, page in pages]
    got = {r.page_id: r.text for r in extract_pages(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    for pages in hosts.values():
        expected = plain_wrapper(pages)
        assert {n: got[n] for n in expected} == expected
    for n in range(100):
        own = " ".join(prose(12, 50 * n + k) for k in range(1 + n % 4))
        assert got[n] == own + (" Other" if n == 7 else "")
    assert all(got[200 + n] == " ".join(prose(12, 50 * n + k) for k in range(2)) for n in range(20))
    assert got[300].startswith(prose(12, 0)) and "Home" not in got[300]
    assert all(got[n].startswith("Home News Contact") for n in (400, 401, 500, 505))
    assert got[600] == " ".join(prose(12, k) for k in range(2))


def test_other_skeletons_are_aligned(spark):
    """A page with one part more is wrapped like the others of its host."""
    more = plain_page(50, 2).replace("<div><p>All", "<div><ul><li>Only here</li></ul></div><div><p>All")
    rows = [(n, "http://a.example/", plain_page(n, 2)) for n in range(10)] + [(50, "http://a.example/", more)]
    got = {r.page_id: r.text for r in extract_pages(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert got[50] == " ".join(prose(12, 2500 + k) for k in range(2)) + " Only here"


def test_many_siblings_are_matched_fast():
    kinds = [f"div class.{chr(97 + n % 26)}{chr(97 + n // 26 % 26)}{chr(97 + n // 676)}" for n in range(10_000)]
    a = leaf("body", *[leaf(k) for k in kinds])
    b = leaf("body", *[leaf(k) for n, k in enumerate(kinds) if n % 50], leaf("p"))
    start = time.perf_counter()
    assert tree_match(a, b)[0] == 1 + 9800
    c = leaf("body", *[leaf("div", leaf("p")) if n % 3 else leaf("div") for n in range(10_000)])
    tree_match(c, a)
    page = parse("<body>" + "<div><p>x</p></div>" * 10_000 + "</body>")
    tree_match(skeleton(page), skeleton(page))
    assert time.perf_counter() - start < 3


def test_odd_rows(spark):
    rows = [(1, None, None), (1, None, None), (None, "", ""), (2, "x", "<p>a"), (3, "http://u@H.example:80/", "b" * 200_000)]
    pages = spark.createDataFrame([(*r, "x", "y") for r in rows], "page_id bigint, url string, html string, host string, text string")
    got = sorted([tuple(r) for r in extract_pages(pages).collect()], key=str)
    assert got == sorted(
        [(1, None, "", 0), (1, None, "", 0), (None, "", "", 0), (2, "x", "a", 1), (3, rows[4][1], rows[4][2], 200_000)],
        key=str,
    )
    assert extract_pages(pages.where("false")).collect() == []


@given(trees, trees)
def test_long_rows_of_siblings_are_matched_whole(a, b):
    """By halves as by the whole table."""
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr("dayfold.llm.html_extract.MOST_CELLS", 0)
        size, pairs = tree_match(a, b)
    assert size == plain_match(a, b) == len(pairs) == len(set(pairs))
    assert len({p for p, _ in pairs}) == len({q for _, q in pairs}) == size


def test_long_rows_without_single_siblings_are_matched():
    """No sibling occurs once, so nothing cuts the rows into shorter ones."""
    kinds = ["div", "ul", "table", "dl"]
    a = leaf("body", *[leaf(kinds[n * n % 7 % 4]) for n in range(700)], leaf("p"))
    b = leaf("body", leaf("ul"), *[leaf(kinds[n * n % 7 % 4]) for n in range(700)])
    size, pairs = tree_match(a, b)
    assert size == len(pairs) == 701

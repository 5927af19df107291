"""Main text of made-up sites whose articles are known, and the tree matching itself."""

import random

import pytest

from weekloom.llm import html

BODY = ["First <b>bold</b> line &amp; more", "Second<br>line\n  here", "Third &eacute; &#8364; &lt;p&gt;"]
TEXT = "First bold line & more\nSecond line here\nThird é € <p>"


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(n))


def semantic(rng, i):
    paras = [words(rng, 20) for _ in range(rng.randrange(1, 6))]
    title = words(rng, 4)
    page = (
        f"<!DOCTYPE html><head><title>{title}</title><script>if(a<b)x='</p>'</script></head><body>"
        f"<header><a href=/>Home</a></header><nav><ul><li>{words(rng, 2)}<li>{words(rng, 2)}</ul></nav>"
        f"<div class='cookie-notice'>We use cookies {i}</div><article><h1>{title}</h1>"
        + "".join(f"<p class=x>{p}" for p in paras)
        + f"<div class='share-bar'>Share {i}</div><form>Mail <input> {i}</form></article>"
        f"<aside>{words(rng, 9)}</aside><section id=comments><p>{words(rng, 30)}</p></section>"
        f"<footer>&copy; {words(rng, 3)}"
    )
    return page, "\n".join([title, *paras])


def anonymous(rng, i):
    paras = [words(rng, 25) for _ in range(rng.randrange(2, 6))]
    page = (
        f"<html><body><div class=a1><div class=b1>Our site slogan here</div>"
        f"<div class=c1><div class=d1>{''.join(f'<p>{p}</p>' for p in paras)}"
        f"<div class=k1><ul><li>About us</li><li>Contact</li></ul></div></div></div>"
        f"<div class=e1>Read our {words(rng, 1)} page</div></div></body></html>"
    )
    return page, "\n".join(paras)


def site(spark):
    rng, rows, want = random.Random(3), [], {}
    for i in range(60):
        page, text = (semantic if i % 2 else anonymous)(rng, i)
        rows.append((i, f"http://{'S' if i % 2 else 'a'}.org/{i}", page))
        want[i] = text
    return spark.createDataFrame(rows, "page_id long, url string, html string"), want


def test_articles_of_two_hosts(spark):
    df, want = site(spark)
    got = {r.page_id: r.text for r in html.main_text(df.repartition(5)).collect()}
    assert got == want


def test_parts_of_a_host_merge_to_the_same_texts(spark, monkeypatch):
    df, want = site(spark)
    monkeypatch.setattr(html, "FAN_IN", 2)
    monkeypatch.setattr(html, "BROADCAST", 0)
    got = {r.page_id: r.text for r in html.main_text(df.repartition(9)).collect()}
    assert got == want


@pytest.mark.parametrize(
    ("page", "want"),
    [
        (None, ""), ("", ""), ("just text", "just text"), ("<p>a<p>b", "a\nb"), ("<p>a", "a"),
        ("<article>" + "".join(f"<p>{b}</p>" for b in BODY) + "</article>", TEXT),
        ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", "a\nb\nc\nd"),
        ("<table><tr><td>a<td>b<tr><td>c</table>", "a\nb\nc"),
        ("<p>x</p><!-- <p>no</p> --><script>no", "x"), ("<p title='>'>a</p>", "a"),
        ("<p>1 &lt 2 &amp;&am</p>", "1 < 2 &&am"), ("<nav>only menu</nav>", ""),
        ("<body class=has-sidebar><div class='main with-sidebar'><p>a</p></div>", "a"),
        ("<P>A</P><DIV HIDDEN>no</DIV>", "A"), ("﻿ <p> a b </p>", "﻿\na b"),
        ("<p a=\"x>y", "\"x>y"),
    ],
)
def test_single_pages(page, want):
    assert html.extract(page, None) == want


def test_long_and_hostile_pages():
    assert html.extract("<p>a</p>" * 30_000, None).count("\n") == 29_999
    assert html.extract("<div>" * 300 + "deep" + "</div>" * 300, None) == "deep"
    html.extract('<a "' * 20_001, None)
    html.extract("<" * 100_000, None)


def test_edge_rows(spark):
    rows = [(1, None, "<p>x</p>", 1), (1, None, "<p>x</p>", 1), (2, "u", None, 2), (None, "", "", 3)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    got = sorted(map(repr, ((r.page_id, r.url, r.text) for r in html.main_text(df).collect())))
    assert got == sorted(map(repr, [(1, None, "x"), (1, None, "x"), (2, "u", ""), (None, "", "")]))
    assert html.main_text(df.filter("page_id > 5")).count() == 0


def test_tree_matching_counts_pairs():
    tree = lambda s: html.skeleton(html.parse(s))
    a = tree("<div><h1>x</h1><p>y</p><ul><li>1<li>2</ul></div>")
    b = tree("<div><p>y</p><table><tr><td>q</table><ul><li>1</ul></div>")
    assert html.score(a, a) == 6
    assert html.score(a, b) == 5
    assert html.score(a, b) == html.score(b, a)


def induced(pages):
    wrapper = None
    for page in pages:
        made = html.skeleton(html.parse(page), html.page_hash(page))
        wrapper = html.merged(wrapper, made) if wrapper else made
    return wrapper


def paragraphs(rng, n):
    return [f"<p>{words(rng, 20)}</p>" for _ in range(n)]


@pytest.mark.parametrize(
    "body",
    [
        lambda p: "<div id=w>" + "".join(f"<div class=s>{x}</div>" for x in p) + "</div>",
        lambda p: "<div id=w>" + "".join(f"<section>{x}</section>" for x in p) + "</div>",
        lambda p: "<div id=w>" + "".join(f"<blockquote>{x}</blockquote>" for x in p) + "</div>",
        lambda p: "<table>" + "".join(f"<tr><td>k<td>{x}" for x in p) + "</table>",
        lambda p: f"<div class=w>{p[0]}<div class=b>{''.join(p[1:])}</div></div>",
        lambda p: f"<div class=w><h1>{p[0][3:12]}</h1><div class=b>{''.join(p)}</div></div>",
        lambda p: f"<div class=w><header><h1>{p[0][3:12]}</h1></header><div>{''.join(p)}</div></div>",
        lambda p: f"<div class=w>Lead {p[0][3:30]}<div class=b>{''.join(p)}</div></div>",
        lambda p: f"<div class=s>{p[0]}</div><p>{p[1][3:9]}</p><div class=s>{''.join(p)}</div>",
    ],
)
def test_pages_of_a_host_lose_no_text(body):
    rng = random.Random(4)
    pages = [f"<html><body>{body(paragraphs(rng, 2 + i % 4))}</body></html>" for i in range(12)]
    wrapper = induced(pages)
    for page in pages:
        assert html.extract(page, wrapper) == html.extract(page, None)


@pytest.mark.parametrize("copies", [1, 2, 3, 9])
def test_copies_of_a_page_are_one_witness(spark, copies):
    table = "<table><tr><td>size<td>3 cm<tr><td>mass<td>9 g</table>"
    page = f"<html><body><article><h1>Thing</h1>{table}<p>Some text</article></body></html>"
    other = "<html><body><article><h1>Else</h1><p>Other text</article></body></html>"
    rows = [(i, "http://c.org/", page) for i in range(copies)] + [(99, "http://c.org/", other)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    got = {r.page_id: r.text for r in html.main_text(df).collect()}
    assert {got[i] for i in range(copies)} == {"Thing\nsize\n3 cm\nmass\n9 g\nSome text"}
    assert got[99] == "Else\nOther text"


@pytest.mark.parametrize("depth", [100, 119, 120, 121, 600, 10_000])
def test_deep_pages(depth):
    """Unclosed or deep elements: all text, in page order, with and without a wrapper."""
    page = "<div>" * depth + "<p>a</p>b<div>c</div>d" + "</div>" * depth + "<p>e</p>"
    assert html.extract(page, None) == "a\nb\nc\nd\ne"
    pages = ["<div>" * depth + f"<p>{w} first</p>{w} second<nav><p>menu</p></nav>" for w in ("one", "two", "ten")]
    wrapper = induced(pages)
    for page, w in zip(pages, ("one", "two", "ten"), strict=True):
        assert html.extract(page, wrapper) == f"{w} first\n{w} second"
    assert html.extract("<nav>" + "<div>" * depth + "<p>menu</p>", None) == ""


def test_template_beyond_many_page_specific_siblings():
    """What every page has stays in the wrapper, however many siblings of one page precede it."""
    rng = random.Random(8)
    pages = []
    for i in range(9):
        own = "".join(f"<div class='n{i}x{k}'><p>{words(rng, 9)}</p></div>" for k in range(40))
        fixed = "<div class=promoline><p>The same line on every page of this host</p></div>"
        pages.append(f"<html><body><div class=w>{own}{fixed}</div></body></html>")
    forward, backward = induced(pages), induced(pages[::-1])
    for page in pages:
        texts = {html.extract(page, w) for w in (forward, backward)}
        assert len(texts) == 1 and "every page of this host" not in texts.pop()

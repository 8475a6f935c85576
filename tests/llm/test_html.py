import html
import re

import pytest
from helpers import DATA

from pageloom.llm import html_text, queries

P1 = "A long paragraph of text that goes on and on, for more than a hundred characters, so that a surge is seen by all who look at it."


@pytest.mark.parametrize(
    "page,want",
    [
        (None, ""), ("", ""), ("<p>", ""), ("no markup at all", "no markup at all"), ("<!-- only --><script>x</script>", ""),
        (f"<nav><a href=x>Home</a></nav><div><h2>Title</h2><p>{P1}<p>Short.</p><div class='ad-box'>Buy</div><p>Last &amp; final&nbsp; one</div><footer>(c)</footer>", f"Title\n\n{P1}\n\nShort.\n\nLast & final one"),
        (f"<body class='has-sidebar'><article><header><h1>T</h1></header><p>{P1}<br>more</p><aside>x</aside><form><p>no</p></form></article><div>{P1}</div></body>", f"T\n\n{P1} more"),
        (f"<article><p>One</p><section id='comments'><article class='comment'><p>{P1}</p></article></section></article><div class='cookie notice'>{P1}</div>", "One"),
        ("<article><p>a<p>b<ul><li>c<li>d</ul><p hidden>x</p><p style='display:none'>y</p></article>", "a\n\nb\n\nc\n\nd"),
        (f"<div>{P1}</div><div role=complementary>{P1}</div><script>var a='</p><p>'</script><style>p{{}}</style>", P1),
        ('<article><p title="a>b">x < y &lt;b&gt; &#233;&eacute;</p><table><tr><td>1<td>2</table></article>', "x < y <b> éé\n\n1\n\n2"),
        (f"<main><div class='breadcrumbs'>a b</div><p>{P1}</p><h2>Related</h2><article class='card'></article></main><p>after</p>", f"{P1}\n\nRelated"),
        (f"<main><p>{P1}</p><article><p>One</p></article></main>", "One"),
        (f"<div id='header'>Site name</div><div class='post-header'><h1>T</h1></div><p>{P1}</p><ol class='commentlist'><li>{P1}</li></ol><div class='siteFooter'>x</div><p>© 2020 someone</p>", f"T\n\n{P1}"),
        ("<article><p>never closed <b>bold <i>both", "never closed bold both"),
    ],
)
def test_pages(page, want):
    assert html_text.extract(page) == want


STORY = [f"{i} {P1}" for i in range(6)]


@pytest.mark.parametrize(
    "page,want",
    [
        (f"<div>{''.join(f'<p>{x}</p>' for x in STORY)}</div><div><p><a href=x>More</a></p><p><a href=x>of</a></p><p><a href=x>this</a></p></div><article class='card'><h3>Teaser</h3><p>A few words.</p></article>", STORY),
        (f"<article><p>{P1}</p></article><article><p>{P1}</p></article><ul><li><a href=x>a</a><li><a href=x>b</a><li><a href=x>c</a></ul><main>{''.join(f'<p>{x}</p>' for x in STORY)}</main>", STORY),
        (f"<main><h1>Title</h1><p>By someone</p><h2>Part</h2><article><p>{P1}</p></article><h2>After</h2></main>", ["Title", "Part", P1]),
        (f"<article>{''.join(f'<p>{x}</p>' for x in STORY)}</article><div><p>{P1}</p><p>{P1}</p></div>", STORY),
    ],
)
def test_distribution_can_overrule_markup(page, want):
    assert html_text.extract(page) == "\n\n".join(want)


def test_link_lines_of_an_article_stay():
    links = [f"item {i}" for i in range(5)]
    page = f"<article><p>{P1}</p><ul>{''.join(f'<li><a href=x>{x}</a>' for x in links)}</ul><p>{P1}</p><p><a href=x>Mostly a link</a> here</p></article>"
    assert html_text.extract(page) == "\n\n".join([P1, *links, P1, "Mostly a link here"])


@pytest.mark.parametrize(
    "page,want",
    [
        ("<article><p>Body text here.</p><p><a href=x>Read the full statement</a></p></article>", ["Body text here.", "Read the full statement"]),
        (f"<article><h2 class='related-work'>Related work</h2><section id='search-methods'><p>{P1}</p></section><fieldset><p>Boxed</p></fieldset><div class='related-posts'>no</div><div id='comments-area'>no</div></article>", ["Related work", P1, "Boxed"]),
        (f"<div><h1><a href=x>Title</a></h1><p><a href=x>By someone</a></p><p><a href=x>tag</a></p><p>{P1}</p></div>", ["Title", "By someone", "tag", P1]),
        (f"<div><h1>Title</h1><p>By one</p><p>{P1}</p><p>Short.</p></div><div class=x><a href=y>{P1}</a></div>", ["Title", "By one", P1, "Short."]),
        (f"<body><form action=x><div><p>{P1}</p></div></form></body>", [P1]),
        (f"<article><p title='a > b' data-x=\"it's\">{P1}</p><p>5 < 6 and 7<8</p></article>", [P1, "5 < 6 and 7<8"]),
    ],
)
def test_nothing_of_the_article_is_dropped(page, want):
    assert html_text.extract(page) == "\n\n".join(want)


@pytest.mark.parametrize("piece", ["<a \"", "<a x=\"", "<a x='>", "<", "</", "<!--", "<p>", "<script>", "<a x=\"'", "<div class=\"a\""])
def test_broken_pages_take_linear_time(piece):
    import time

    page = f"<p>{P1}</p>" + piece * (1_000_000 // len(piece))
    began = time.process_time()
    html_text.extract(page)
    assert time.process_time() - began < (1 if piece != "<p>" else 8)


def test_without_article_markup(duck):
    """The distribution alone finds the same text, but for a few lines."""
    total = found = extra = 0
    for (page,) in duck.sql("select html from pages").fetchall():
        want = html_text.extract(page).split("\n\n")
        got = html_text.extract(re.sub(r"(</?)article", r"\1div", page)).split("\n\n")
        total += sum(map(len, want))
        found += sum(len(x) for x in want if x in got)
        extra += sum(len(x) for x in got if x not in want)
    assert found >= 0.99 * total and extra <= 0.01 * total


def test_surges_and_dives():
    import numpy as np

    lengths = np.array([0, 5, 0, 0, 0, 40, 90, 0, 60, 3, 0, 0, 0, 0, 8, 0])
    assert list(html_text.distribution(lengths)) == [5, 5, 0, 40, 130, 130, 150, 63, 63, 3, 0, 0, 8, 8, 8, 0]
    (a, b), *rest = html_text.surges_and_dives(lengths, 120)
    assert not rest and [x for x in lengths[a:b] if x] == [40, 90, 60, 3]


def test_table(spark):
    rows = [(1, "u", f"<article><p>{P1}</article>"), (1, "u", f"<article><p>{P1}</article>"), (2, None, None), (None, "v", ""), (3, "w", "<article><p>" + "word " * 200_000 + "</article>")]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], "page_id long, url string, html string, text string, row string")
    got = sorted((str(r.row.page_id), len(r.text)) for r in html_text.main_text(df).collect())
    assert got == [("1", len(P1)), ("1", len(P1)), ("2", 0), ("3", 999_999), ("None", 0)]
    assert html_text.main_text(df.limit(0)).count() == 0


def test_query(spark, duck):
    got = {r.page_id: r for r in queries.op7_main_text(spark, DATA).collect()}
    for k, url, page in duck.sql("select page_id, url, html from pages").fetchall():
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]+>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", re.search("<article>(.*)</article>", page, re.S)[1])]
        want = "\n\n".join(b for b in blocks if b)
        assert (got[k].url, got[k].text, got[k].n_chars) == (url, want, len(want))

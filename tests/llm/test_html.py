import pytest

from overflight.llm import html

PARAGRAPH = "A sentence of some length, with marks; and another one. The end!"


def page(body):
    return f"<!DOCTYPE html><html><head><title>t, t.</title><style>p{{}}</style></head><body>{body}</body></html>"


@pytest.mark.parametrize("body, text", [
    (f"<article><h1>Head</h1><p>{PARAGRAPH}</p><p>Short.</p></article>", f"Head\n{PARAGRAPH}\nShort."),
    (f"<nav><ul><li><a href='/a'>one</a></li></ul></nav><article><p>{PARAGRAPH}</p></article><footer>&copy; me, you.</footer>", PARAGRAPH),
    (f"<header><h1>Site</h1></header><div class='content'><h2>Head</h2><p>{PARAGRAPH}</p><ul><li>one<li>two</ul></div>"
     f"<div class=sidebar><p>{PARAGRAPH}</p></div>", f"Head\n{PARAGRAPH}\none\ntwo"),
    (f"<div id='main'><p>{PARAGRAPH}</p></div><section id='comments'><p>{PARAGRAPH} {PARAGRAPH}</p></section>", PARAGRAPH),
    (f"<div class='cookie-notice'>{PARAGRAPH}</div><p>{PARAGRAPH}</p><form><p>{PARAGRAPH}</p></form><div class=ad>{PARAGRAPH}</div>", PARAGRAPH),
    ("<p>a &amp; b&lt;c &eacute;&nbsp;&#x41;\n\t d</p>", "a & b<c é A d"),
    ("<p>one<p>two <b>bold<br>three</p>", "one\ntwo bold three"),
    ("<script>if (a < b) { '</p>' }</script><p>x, y.</p><!-- <p>no</p> -->", "x, y."),
    ("<main><table><tr><td>1<td>2<tr><td>3</table></main>", "1\n2\n3"),
    ("<p>a < b, c > d.</p>", "a < b, c > d."),
    ("<article><aside>side, note.</aside><p>x.</p><div class='share'>share, this.</div></article>", "x."),
    ("<article><p>outer.</p><article class='comment'><p>mine, too.</p></article></article>", "outer."),
    ("just, text", "just, text"),
    ("<div hidden>no, no.</div><div style='display:none'>no, no.</div><div>yes, yes.</div>", "yes, yes."),
    ("<nav><a>only</a></nav>", ""),
])
def test_pages(body, text):
    assert html.main_text(page(body)) == text


@pytest.mark.parametrize("broken", [None, "", "<", "<p", "<!--", "</p></p>", "<p><script>", "<a href='x", "&#99999999;", "\x00<p>\x00"])
def test_broken_pages(broken):
    assert isinstance(html.main_text(broken), str)


ITEM, LONG = "an item of the list without any mark, fifty letters", " ".join([PARAGRAPH] * 9)


@pytest.mark.parametrize("body, lines", [
    (f"<article><section class=a>{f'<p>{LONG}</p>' * 12}</section><section class=b><h2>Head</h2><ul>{f'<li>{ITEM}</li>' * 6}</ul></section>"
     f"<section class=c>{f'<p>{PARAGRAPH}</p>' * 2}</section></article>", [LONG] * 12 + ["Head"] + [ITEM] * 6 + [PARAGRAPH] * 2),
    (f"<article><header><h1>Title</h1><p>By somebody</p></header><div class=body>{f'<p>{LONG}</p>' * 12}</div></article>",
     ["Title", "By somebody"] + [LONG] * 12),
    (f"<article><div class=lead><h1>Title</h1><p>{PARAGRAPH}</p></div><div class=body>{f'<p>{LONG}</p>' * 12}</div></article>",
     ["Title", PARAGRAPH] + [LONG] * 12),
    (f"<div role=main><div class=lead><p>Lead</p></div><div class=body>{f'<p>{LONG}</p>' * 12}</div></div>", ["Lead"] + [LONG] * 12),
    # Links alone, what is declared, and what is outside the article stay out.
    (f"<main><div class=teaser><p>Other</p></div><article><div class=body>{f'<p>{LONG}</p>' * 12}</div><div class=more><p><a>one more</a></p></div>"
     f"<div class=share><p>Share</p></div></article></main>", [LONG] * 12),
])
def test_divided_articles(body, lines):
    assert html.main_text(page(body)).split("\n") == lines


S = [f"Sentence {i} of the text, with marks; and more words to read." for i in range(60)]
P = [f"<p>{t}</p>" for t in S]
MENU = "<nav><ul><li><a href=/>Home</a></li><li><a href=/b>More</a></li></ul></nav>"
NOISE = "<div class='cookie-banner'>We use cookies, as all do.</div><div class='share-buttons'><a>Post</a> it, now.</div>"
END = "<footer><p>All rights, reserved. 2020.</p></footer>"


@pytest.mark.parametrize("body, lines", [
    # sections of a container without any mark
    (f"{MENU}<div class=content><section class=a>{''.join(P[:12])}</section><section class=b><h2>Head</h2><ul>{'<li>item</li>' * 6}</ul>"
     f"</section><section class=c>{P[12]}</section></div>{END}", S[:12] + ["Head"] + ["item"] * 6 + S[12:13]),
    (f"{MENU}<div class=lead><h1>Title</h1><p>Lead in words</p></div><div class=body>{''.join(P[:9])}</div>{END}",
     ["Title", "Lead in words"] + S[:9]),
    (f"<div id=wrap><div id=page>{MENU}<div class=story><div class=text>{''.join(P[:20])}</div><div class=notes><p>Note</p></div></div></div></div>",
     S[:20] + ["Note"]),
    # names that only look like furniture
    (f"{MENU}<div class=legal-text>{''.join(P[:5])}</div>{END}", S[:5]),
    (f"{MENU}<div id=content class=social-history>{''.join(P[:5])}</div>{NOISE}", S[:5]),
    (f"<article>{P[0]}<section id=discussion><h2>Discussion</h2>{P[1]}</section><section class=related-work>{P[2]}</section>"
     f"<div class=side-by-side><p>left</p><p>right</p></div></article>{NOISE}", [S[0], "Discussion", S[1], S[2], "left", "right"]),
    (f"<article class=ad-hoc>{''.join(P[:3])}</article>", S[:3]),
    (f"<div class=menu-planning>{''.join(P[:3])}</div>{MENU}", S[:3]),
    (f"<main><div class=disclaimer-law>{''.join(P[:3])}</div></main>", S[:3]),
    (f"{MENU}<div id=discussion>{''.join(P[:7])}</div>", S[:7]),
    # furniture by name
    (f"<div class=story>{''.join(P[:9])}</div><div class=discussion>{P[20]}</div><div class=site-footer>{P[21]}</div>{NOISE}", S[:9]),
    (f"<div class=story>{''.join(P[:9])}</div><div id=left-sidebar>{P[20]}</div><div class='box related-posts'>{P[21]}</div>", S[:9]),
    (f"<div class='newsletter-signup'>{P[30]}</div><div class=story>{''.join(P[:9])}</div><ol class=commentlist><li>{S[31]}</ol>", S[:9]),
    (f"<div class=TopBanner>{P[30]}</div><div class=story>{''.join(P[:4])}<div class=adSlot>{P[31]}</div>{''.join(P[4:8])}</div>", S[:8]),
    (f"<div role=navigation>{P[30]}</div><div class=story>{''.join(P[:4])}</div><div role=complementary>{P[31]}</div>", S[:4]),
    (f"<header class=x><h1>Site</h1></header><div class=story><h1>Title</h1>{''.join(P[:4])}</div>", ["Title"] + S[:4]),
    # tables, definition lists, quotes, code, captions, formulas
    (f"<article>{P[0]}<table><tr><th>a</th><th>b</th></tr><tr><td>1</td><td>2</td></tr></table>{P[1]}</article>", [S[0], "a", "b", "1", "2", S[1]]),
    (f"<article>{P[0]}<dl><dt>term<dd>meaning<dt>other<dd>sense</dl></article>", [S[0], "term", "meaning", "other", "sense"]),
    (f"<article><blockquote>{P[0]}<cite>Somebody</cite></blockquote><pre>x = 1\n  y = 2</pre></article>", [S[0], "Somebody", "x = 1 y = 2"]),
    (f"<article>{P[0]}<figure><img src=x><figcaption>A caption</figcaption></figure>{P[1]}</article>", [S[0], "A caption", S[1]]),
    ("<article><p>Let <math><mi>x</mi><mo>=</mo><mn>1</mn></math> be, then <svg><text>no</text></svg>go.</p></article>", ["Let x=1 be, then go."]),
    (f"<main><h1>Title</h1><p class=byline>By her</p>{''.join(P[:3])}<details><summary>More</summary>{P[3]}</details></main>",
     ["Title", "By her"] + S[:3] + ["More", S[3]]),
    (f"<article>{''.join(f'<section><h2>Part {i}</h2>{P[i]}</section>' for i in range(8))}</article>",
     [line for i in range(8) for line in (f"Part {i}", S[i])]),
    (f"<table><tr><td class=menu><a>one</a><td class=text>{''.join(P[:6])}</table>", S[:6]),
    (f"<body><center><font size=2>{''.join(P[:6])}</font></center><hr>{END}", S[:6]),
    (f"{''.join(P[:6])}", S[:6]),
    (f"<div>{S[0]}<br><br>{S[1]}</div>", [f"{S[0]} {S[1]}"]),
    (f"<article>{P[0]}<p><a href=x>A line that is a link, all of it.</a></p>{P[1]}</article>", [S[0], "A line that is a link, all of it.", S[1]]),
    (f"<div class=post><div class=entry>{''.join(P[:5])}<ul><li>short<li>ones</ul></div></div><div class=post-navigation><a>Next</a></div>",
     S[:5] + ["short", "ones"]),
    (f"<article>{''.join(P[:2])}</article><article>{''.join(P[2:4])}</article>", S[:4]),
])
def test_layouts(body, lines):
    assert html.main_text(page(body)).split("\n") == lines


@pytest.mark.parametrize("name, says", [
    ("sidebar", 2), ("share-buttons", 2), ("siteFooter", 2), ("cookie_notice", 2), ("related-posts", 2), ("discussion", 1), ("ad-hoc", 1),
    ("legal-text", 0), ("social-history", 0), ("side-by-side", 0), ("content", 0), ("shadow", 0), ("", 0)])
def test_names(name, says):
    assert html.named(name) == says


def test_equal_scores_are_both_content():
    two = "".join(f"<div class={c}>" + "".join(f"<p>{'same words here, always.'}</p>" for _ in range(4)) + "</div>" for c in "ab")
    assert html.main_text(page(two)).split("\n") == ["same words here, always."] * 8


def test_long_page_keeps_everything():
    texts = [f"Paragraph {i}, with words." for i in range(20_000)]
    assert html.main_text(page("<article>" + "".join(f"<p>{t}</p>" for t in texts) + "</article>")) == "\n".join(texts)


def test_rows(spark):
    rows = [(1, "u", page(f"<p>{PARAGRAPH}</p>")), (1, "u", page(f"<p>{PARAGRAPH}</p>")), (None, None, None), (2, None, ""), (3, "v", "é\U0001f600, x.")]
    df = spark.createDataFrame(rows, "page_id BIGINT, url STRING, html STRING").selectExpr("*", "'t' AS text", "1 AS n_chars")
    got = sorted(map(tuple, html.extracted(df).collect()), key=str)
    assert got == sorted([(i, u, html.main_text(h), len(html.main_text(h))) for i, u, h in rows], key=str)
    assert html.extracted(df.limit(0)).collect() == []

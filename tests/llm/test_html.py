"""Main text: hand-made pages, templates against a plain count, and hostile markup."""

import time
from collections import Counter, defaultdict

import pytest

from tidemark.llm import html as page

NEVER = lambda h: False


def text(markup):
    return page.extract(markup, "http://a.example/x", NEVER)


def test_an_article_among_everything_else():
    markup = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>if(a<b)"</p>"</script></head><body>
    <header><h1>Site</h1></header><nav><ul><li><a href=/>Home</a></ul></nav><div class="cookie-notice">We use cookies</div>
    <main><article><h1>Head &amp; line</h1><p>One&nbsp;two
    three<br>four <b>bold</b>.<p>Five &lt;six&gt;<div class="ad-slot">Buy!</div><aside>Side</aside><ul><li>A<li>B</ul>
    <form><label>Mail</label><input></form><blockquote>Quote</blockquote></article>
    <section id="comments"><p>First!</p></section></main><div class="sidebar">More</div><footer>(c)</footer></body></html>"""
    assert text(markup) == "Head & line\n\nOne two three four bold.\n\nFive <six>\n\nA\n\nB\n\nQuote"


def test_unclosed_and_wrongly_nested_markup():
    assert text("<article><h1>H</h1><p><b>Title<br><p>Next</b> one<p>Last") == "H\n\nTitle\n\nNext one\n\nLast"
    assert text("<body><div><p>a<div>b</p>c</div>d") == "a\n\nb\n\nc\n\nd" or text("<body><div><p>a<div>b</p>c</div>d").startswith("a\n\nb")
    assert text("<table><tr><td>1<td>2<tr><td>3</table>") == "1\n\n2\n\n3"
    assert text("plain words &amp; more") == "plain words & more"
    assert text("a < b and c > d") == "a < b and c > d"
    assert text('<p title="a > b">x</p>') == "x"
    assert text("<!-- a <p>no</p> --><p>yes</p><!-- open") == "yes"


def test_pages_without_an_article():
    assert text('<body><div id="content"><p>Main words.</p></div><div class="related"><p>Other</p></div><p>Loose</p>') == "Main words."
    assert text("<body><p><a href=1>One</a> <a href=2>Two</a></p><p>Long text with <a href=3>a link</a> in it.</p>") == "Long text with a link in it."
    assert text('<div role="navigation">x</div><p hidden>y</p><p style="display: none">z</p><p>w</p>') == "w"


def test_reader_comments_and_notices_inside_the_article():
    assert text('<article><p>Body</p><div class="comment-list"><p>nice</p></div><div class="notice">N</div><header><h1>Kept</h1></header></article>') == "Body\n\nKept"


def test_hostile_markup_is_linear():
    for markup in ("<div>" * 100_000 + "x", "<p>" * 100_000, "<a href='" * 20_000, '<a "' * 20_000, "<" * 300_000, "</b>" * 100_000, "<i>" * 50_000 + "</p>" * 1000, "<!--" * 50_000, "&" * 100_000, "<script>" * 10_000, "<li>" * 50_000, "<b>" * 20_000 + "</i>" * 100):
        start = time.time()
        page.extract(markup, None, NEVER)
        page.subtrees(markup, "http://a.example")
        assert time.time() - start < 20, markup[:20]


def test_long_attribute_values_stay_in_their_tag():
    for size in (100, 5000, 300_000):
        for quote in "\"'":
            value = "x" * size + " <b>junk</b> </article><script>tail"
            assert text(f"<article><p data-x={quote}{value}{quote}>real</p><p srcdoc={quote}a>b{quote} {'k ' * size}>more</p></article>") == "real\n\nmore"
    assert text("<p " + "a='>' " * 500 + ">x</p>") == "x"
    assert text("<p title='it" + "x" * 5000 + ">y</p>") == "y"


def test_tokens_are_those_of_a_plain_scan():
    import random
    import re

    plain = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+>|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+'|["'])*+)>""", re.S)
    rng = random.Random(5)
    pieces = ["<", "<a", "</b", ">", '"', "'", " ", "x=", "/", "<!", "<!--", "-->", "<![CDATA[", "]]>", "<?", "q" * 70, "é", "\n", "z" * 300, "=' '"]
    for _ in range(20_000):
        markup = "".join(rng.choice(pieces) for _ in range(rng.randrange(30)))
        tokens, at, got = page.Tokens(markup), 0, []
        while found := tokens.next(at):
            got.append(found)
            at = found[1]
        assert got == [(*m.span(), m[1] or "", m[2], m[3] or "") for m in plain.finditer(markup)], markup


def test_hostile_quotes_are_linear():
    for markup in ("<a href='" * 60_000 + ">'", '<a "' * 60_000 + '>"', "<a \"'" * 60_000 + ">\"'", "<a" * 100_000 + " \">\"", "<!" * 200_000, "<a " * 100_000 + "'>'", "<a '\"" * 60_000 + "<b '>' \">\""):
        start = time.time()
        page.parse(markup)
        assert time.time() - start < 20, markup[:20]


def site(n, boiler=True):
    out = []
    for k in range(n):
        top = f"<div><p>Welcome to our little site</p><p>page {k}</p></div>" if boiler else ""
        out.append((k, f"https://www.shop.example/{k}", f"<body>{top}<div><p>Own words of page {k}, which are plain.</p><p>Said on two pages {k // 2}.</p></div><div>All rights held by us</div></body>"))
    return out


def own(k):
    return f"page {k}\n\nOwn words of page {k}, which are plain.\n\nSaid on two pages {k // 2}."


def run(spark, rows, **more):
    return sorted(((r.page_id, r.url, r.text) for r in page.main_text(spark.createDataFrame(rows, "page_id long, url string, html string"), **more).collect()), key=str)


@pytest.mark.parametrize("sent", [1 << 20, 0])
def test_templates_of_a_host_are_deleted(spark, sent):
    rows = site(20)
    other = [(100 + k, f"http://b{k}.example/", rows[k][2]) for k in range(3)] + [(200, None, rows[0][2]), (201, "no host", rows[0][2])]
    got = {k: t for k, _, t in run(spark, rows + other, sent=sent)}
    for k in range(20):
        assert got[k] == own(k)
    for k in (100, 200, 201):
        assert "Welcome to our little site" in got[k] and "All rights held by us" in got[k]


def test_templates_are_those_of_a_plain_count(spark):
    rows = [(r.page_id, r.url, r.html) for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()] + [(k, u, h) for k, u, h in site(30)]
    pages, seen = Counter(), defaultdict(Counter)
    for _, url, markup in rows:
        pages[page.host_of(url)] += 1
        seen[page.host_of(url)].update(page.subtrees(markup, url))
    want = {h for host, c in seen.items() for h, n in c.items() if n >= page.LEAST_PAGES and n >= page.LEAST_SHARE * pages[host]}
    got = {r.hash for r in page._templates(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == want and want


def test_article_text_that_recurs_is_kept(spark):
    rows = [(k, f"http://c.example/{k}", f"<body><article><p>The same story again.</p></article><div>Foot</div></body>") for k in range(20)]
    assert {t for *_, t in run(spark, rows)} == {"The same story again."}


@pytest.mark.parametrize("sent", [1 << 20, 0])
def test_boilerplate_inside_the_article_is_deleted(spark, sent):
    page_of = lambda k, top: (k, f"http://d.example/{k}", f"<{top}><h1>Page {k}</h1><p class='by'>By us</p><div class='ad'>Buy</div><h3>Words</h3><p>Own words of page {k}, which are plain.</p><div>All rights held by us</div><h2>On us</h2><div><p>We write</p></div><ul><li>yes</li><li>{k}</li></ul></{top.split()[0]}>")
    rows = [page_of(k, ("article", "main", "div id=content")[k % 3]) for k in range(24)]
    assert {k: t for k, _, t in run(spark, rows, sent=sent)} == {k: f"Page {k}\n\nWords\n\nOwn words of page {k}, which are plain.\n\nyes\n\n{k}" for k in range(24)}


def test_whole_repeated_articles_are_kept(spark):
    copies = [(k, f"http://e.example/{k}", f"<article>{''.join(f'<p>Part {n} of the story.</p>' for n in range(5))}</article>") for k in range(20)]
    nearly = [(k, f"http://f.example/{k}", f"<article>{''.join(f'<p>Part {n} of the story.</p>' for n in range(9))}<p>No {k}</p></article>") for k in range(20)]
    assert all(t.count("Part") == 5 for *_, t in run(spark, copies)) and all(t.count("Part") == 9 for *_, t in run(spark, nearly))


def test_many_pages_make_a_template_on_a_large_host(spark):
    rows = [(k, "http://g.example/", f"<article><p>Own words number {k} of this page.</p><p>{'Held by us' if k < 100 else k}</p></article>") for k in range(500)]
    assert not any("Held" in t for *_, t in run(spark, rows))


def test_edges_of_the_input(spark):
    rows = [(1, None, None), (2, "http://x.example", ""), (None, "http://[bad", "<p>a"), (4, "", "<p>b"), (4, "", "<p>b")]
    assert run(spark, rows) == sorted([(1, None, ""), (2, "http://x.example", ""), (None, "http://[bad", "a"), (4, "", "b"), (4, "", "b")], key=str)
    assert run(spark, rows, sent=-1) == run(spark, rows)
    assert run(spark, []) == []
    assert page.op5_html.__name__ == "op5_html"


def test_the_query_counts_code_points(spark, tmp_path):
    spark.createDataFrame([(1, "u", "<p>é\U0001f600x", 5, 6)], "page_id long, url string, html string, key int, text int").write.parquet(f"{tmp_path}/pages.parquet")
    assert [tuple(r) for r in page.op5_html(spark, str(tmp_path)).collect()] == [(1, "u", "é\U0001f600x", 3)]


def test_names_of_prose_are_kept():
    parts = ("related-work", "social-history", "notice-period", "share-holders", "adventure", "commentary")
    inside = "".join(f'<section class="{p}"><p>Text of {p}.</p></section>' for p in parts)
    furniture = ("related-posts", "social-share-buttons", "cookie-notice", "ad-slot-2", "comments", "newsletterSignup", "site_footer", "sidebar")
    around = "".join(f'<div class="{p}"><p>Not this {p}.</p></div>' for p in furniture)
    assert page.extract(f"<article><p>First.</p>{inside}{around}</article>", None, NEVER) == "\n\n".join(["First.", *(f"Text of {p}." for p in parts)])


def test_references_end_with_their_text():
    assert page.extract("<article><p>a &am<b>p;</b> b &amp; c &lt<i>;</i></p></article>", None, NEVER) == "a &amp; b & c <;"


def test_quoted_attributes_of_any_length():
    assert page.extract(f'<article><p title="{"x" * 9000}>LEAK">Hello</p></article>', None, NEVER) == "Hello"


def test_a_very_long_page(spark):
    markup = "<article>" + "".join(f"<p>Paragraph {k} of it.</p>" for k in range(60_000)) + "</article>"
    assert page.extract(markup, "http://a.example", NEVER).count("\n\n") == 59_999

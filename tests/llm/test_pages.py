import html
import random
import re

import pytest

from gridmart.llm import pages as P

PAGE_SCHEMA = "page_id long, url string, html string"


@pytest.fixture()
def make_pages(spark):
    return lambda rows: spark.createDataFrame(rows, PAGE_SCHEMA).repartition(3)


def lcs(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


@pytest.mark.parametrize("bits", [1 << 28, 6])
def test_alignment_is_a_longest_common_subsequence(bits, monkeypatch):
    monkeypatch.setattr(P, "TABLE_BITS", bits)
    rng = random.Random(bits)
    for _ in range(1500):
        a, b = ([rng.randrange(6) for _ in range(rng.randrange(14))] for _ in range(2))
        at = P.shared_lines(a, b)
        rest = iter(b)
        assert len(at) == lcs(a, b) and at == sorted(set(at)) and all(a[i] in rest for i in at)


CASES = [
    ("<article><p>One  two</p>\n<p>three&amp;&eacute;</p></article>", "One two three&é"),
    ("<nav>menu</nav><article>a<b>b</b>c<br>d</article><footer>foot</footer>", "abc d"),
    ("<body><header>top</header><main><h1>T</h1><aside>side</aside><p>x</p></main>", "T x"),
    ("<article><p>open<p>next<div class='comments'><p>reader</p></div><p>end", "open next end"),
    ("<div class=ad>buy<article>text</article>", "text"),
    ("<article>a<script>var x='</article>';</script>b<style>p{}</style></article>z", "a b"),
    ("<!-- <article>no</article> --><article>yes<!-- c --></article>", "yes"),
    ("<article>5 < 6 &lt;b&gt; &#65;&nbsp;x</article>", "5 < 6 <b> A x"),
    ("<article><form><input>q</form>t<select><option>o</option></select></article>", "t"),
    ("<article><article>inner</article> outer</article> after", "inner outer"),
    ("<div role='main'>m<div role=navigation>n</div></div><div id='cookie-notice'>c</div>", "m"),
    ("<p>plain <i>page</i></p><p>second</p>", "plain page second"),
    ("plain text only", "plain text only"),
    ("<article></article><p>body</p>", "body"),
    ("<a title='x>y'>q</a><a title=\"unclosed>r", "qr"),
    ("<ARTICLE>Upper</ARTICLE>", "Upper"),
    ("", ""), (None, ""), ("<", "<"), ("<article", ""), ("</article></p>", ""), ("<!--", ""), ("<script>x", ""),
]


def test_structure(make_pages):
    rows = P.main_text(make_pages([(i, None, page) for i, (page, _) in enumerate(CASES)])).collect()
    for r in rows:
        assert (r.text, r.n_chars) == (CASES[r.page_id][1], len(CASES[r.page_id][1])), CASES[r.page_id]


def site(n):
    """Pages without any main element: a template of lines, and lines of their own."""
    rows = []
    for i in range(n):
        own = [f"<p>own line {k} of page {i}</p>" for k in range(1 + i % 4)]
        rows.append((i, f"http://h.example/{'ab'[i % 2]}/{i // 2:04d}", "<div>Site title</div><div>Tag line</div>" + "".join(own) + "<div>All about us</div>"))
    return rows


def test_lines_shared_with_the_nearest_page_go(make_pages, monkeypatch):
    monkeypatch.setattr(P, "ROWS_PER_RANGE", 7)
    for r in P.main_text(make_pages(site(60))).collect():
        assert r.text == " ".join(f"own line {k} of page {r.page_id}" for k in range(1 + r.page_id % 4))


def by_hand(rows):
    order = sorted(rows, key=lambda r: P.url_key(r[1], r[0]))
    keys = [P.url_key(r[1], r[0]) for r in order]
    out = {}
    for k, (page_id, _, page) in enumerate(order):
        lines, zones = P.page_lines(page)
        main = [x for x, z in zip(lines, zones, strict=True) if z == P.MAIN]
        side = P.nearer(keys[k - 1] if k else None, keys[k], keys[k + 1] if k + 1 < len(keys) else None)
        other = P.page_lines(order[k + side][2])[0] if side else []
        shared = set(P.shared_lines(lines, other))
        kept = [x for i, x in enumerate(lines) if i not in shared]
        out[page_id] = " ".join(main or kept or lines)
    return out


def test_ranges_do_not_change_results(make_pages, monkeypatch):
    rng = random.Random(9)
    rows = []
    for i in range(150):
        host = rng.choice(["hot.example", "hot.example", "b.example", "c.example"])
        lines = "".join(f"<p>line {rng.randrange(12)}</p>" for _ in range(rng.randrange(8)))
        rows.append((i, f"https://{host}/{rng.choice('abc')}/{rng.randrange(30)}", lines if i % 5 else f"<article>{lines}</article>"))
    rows += [(500, None, "<p>no url</p>"), (501, "http://hot.example/a/1", None), (502, "not a url", "<p>x</p>")]
    want = by_hand(rows)
    for size in (5, 40, 1000):
        monkeypatch.setattr(P, "ROWS_PER_RANGE", size)
        assert {r.page_id: r.text for r in P.main_text(make_pages(rows)).collect()} == want


def test_articles_of_whole_pages(spark, sf001):
    pages = spark.read.parquet(f"{sf001}/pages.parquet")
    source = {r.page_id: r.html for r in pages.collect()}
    rows = P.main_text(pages).collect()
    assert len(rows) == len(source)
    for r in rows:
        article = re.search(r"<article>(.*?)</article>", source[r.page_id], re.S)[1]
        plain = html.unescape(re.sub(r"<[^>]*>", " ", re.sub(r"</?b>", "", article)))
        assert r.text == " ".join(plain.split())


def test_copies_repeated_rows_clashing_columns_and_empty_table(make_pages):
    from pyspark.sql import functions as F

    rows = [(1, "http://h/x", "<p>same</p>"), (2, "http://h/x", "<p>same</p>"), (2, "http://h/x", "<p>same</p>"), (None, "http://h/y", "<p>z</p>")]
    pages = make_pages(rows).withColumns({n: F.lit(n) for n in ("text", "part", "id", "lines", "n_chars", "a.b")})
    got = sorted((r.page_id is None, r.page_id or 0, r.text) for r in P.main_text(pages).collect())
    assert got == [(False, 1, "same"), (False, 2, "same"), (False, 2, "same"), (True, 0, "z")]
    assert P.main_text(make_pages([])).count() == 0


def test_a_very_long_page():
    lines, zones = P.page_lines("<article>" + "<p>line of text</p>" * 20000 + "</article>")
    assert len(lines) == 20000 and set(zones) == {P.MAIN}
    assert len(P.shared_lines(list(range(20000)), list(range(10, 20010)))) == 19990


def test_menus_inside_main_go_and_recurring_sentences_stay(make_pages, monkeypatch):
    menu = "<ul><li><a href='/a'>Start</a> | <a href='/b'>News</a></li><li><a href='/c'>Shop</a></li></ul>"
    page = lambda i: f"<main>{menu}<p>As ever.</p><p>story {i}, <a href='/x'>more</a></p><p><a href='/{i}'>link {i}</a></p><p>The end.</p></main>"
    rows = [(i, f"http://h.example/{i:03d}", page(i)) for i in range(30)]
    rows += [(100 + i, f"http://menu.example/{i}", f"<main>{menu}</main>") for i in range(2)]
    for size in (4, 1000):
        monkeypatch.setattr(P, "ROWS_PER_RANGE", size)
        got = {r.page_id: r.text for r in P.main_text(make_pages(rows)).collect()}
        assert all(got[i] == f"As ever. story {i}, more link {i} The end." for i in range(30))
        assert got[100] == got[101] == "Start | News Shop"


def test_every_page_is_aligned_with_its_neighbour(monkeypatch):
    calls = []
    monkeypatch.setattr(P, "shared_lines", lambda a, b: calls.append((a, b)) or [])
    row = lambda i, zone: (0, ("h", f"/{i}", "", i), False, i, "", bytes([zone]), ["x"], [7])
    assert P._text(row(1, P.MAIN), row(2, P.MAIN), None) == "x" and calls == [([7], [7])]


ORDINARY = [
    ("<main><p>text</p><div class='user-comments'><p>reader</p></div><div class='responses'>more</div></main>", "text"),
    ("<main><div class='adBanner'>buy</div><p>text</p><div class='cookieBanner'>accept</div><div id='onetrust-consent-sdk'>accept</div></main>", "text"),
    ("<main><p style='color:red; Display : none'>gone</p><p style='display:nonexistent'>text</p><p style='visibility:hidden'>gone</p></main>", "text"),
    ("<article>before</article><main><article><p>text</p></article></main><article>teaser</article>", "text"),
    ("<main></main><article>text</article>", "text"),
    ("<main role='MAIN'><div class='userGuide'>text</div><div class='adaBoost'>more</div></main>", "text more"),
    ("<article><p style='overflow:hidden'>a</p><p title='hidden gems'>b</p><a data-id='header' href=x>c</a></article>", "a b c"),
    ("<article><p class='col ad-free'>a</p><p data-hidden=1 title='class=ad'>b</p><p data-x='1' hidden>c</p><p HIDDEN=''>d</p></article>", "a b"),
    ("<article>t<div class='x cookie-notice'>c</div><div id=ad_slot-2>s</div><p class=ad class=x>q</p><p class=x class=ad>r</p></article>", "t r"),
    ("<article>area <math><msup><mi>r</mi><mn>2</mn></msup><mo>=</mo><mn>4</mn><annotation>r^2</annotation></math> holds</article>", "area r2=4 holds"),
    ("<aside><article>card</article></aside><article>text</article><aside><article>card</article></aside>", "text"),
    ("<div><div class=related><article>card</article></div><article>text</article></div>", "text"),
    ("<aside>teaser<article>text</article>", "text"),
    ("<div><div class=ad>buy<article>text</article></div>", "text"),
    ("<aside><!-- </aside> --><article>card</article><script>'</aside>'</script><article>card</article></aside><article>text</article>", "text"),
    ("<article><ul><li class=ad><div>buy</div>now</li><li>text</li></ul></article>", "text"),
    ("<article><ul><li class=ad>buy<li>text</ul></article>", "text"),
]


@pytest.mark.parametrize(("page", "text"), ORDINARY)
def test_ordinary_html(page, text):
    lines, zones = P.page_lines(page)
    assert " ".join(x for x, z in zip(lines, zones, strict=True) if z != P.OTHER) == text


def test_many_open_boilerplate_elements_take_linear_time():
    n = 20000
    lines, _ = P.page_lines("<article><ul>" + "<li class=ad><div>buy</div></li><li>text</li>" * n + "</ul></article>")
    assert lines == ["text"] * n

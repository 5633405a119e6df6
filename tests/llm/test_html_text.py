import html
import re

import numpy as np
from pyspark.sql.group import GroupedData

from casegraph.llm import html_text as ht
from casegraph.llm.queries import QUERIES


def expected(page):
    """The article of a page of the test tables, whose structure is known."""
    inner = re.search(r"<article>(.*?)(?:</article>|\Z)", page, re.S)[1]
    inner = re.sub(r"<[^>]*\Z", "", inner)
    blocks = [re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]*>", " " if "<br" in b else "", b))).strip() for b in re.split(r"</?(?:p|h1)>", inner)]
    return "\n\n".join(b for b in blocks if b)


def test_query_matches_the_articles(spark):
    sf = "/root/testdata/sf0.01"
    pages = {r.page_id: r for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    rows = QUERIES["op3_html_text"](spark, sf).collect()
    assert len(rows) == len(pages)
    for r in rows:
        want = expected(pages[r.page_id].html)
        assert (r.url, r.text, r.n_chars) == (pages[r.page_id].url, want, len(want))


def test_structure():
    page = """<html><head><title>T</title><script>var a = "<p>no</p>";</script></head><body><header>Site</header>
    <nav><ul><li>Home<li>About</ul></nav><div class="cookie-notice"><p>We use cookies</p></div><main><article>
    <header><h1>The &amp; title</h1></header><p>One<br>two &lt;b&gt; <b>bold</b>text<p>Second&nbsp; para
    <div class="ad">Buy</div><aside>More</aside><ul><li>a<li>b</ul><form><label>Mail</label><input></form>
    <section id="comments"><article class="comment">First!</article></section><p style="display: none">gone</p></article></main>
    <footer>&copy; me</footer></body>"""
    blocks, marked = ht.blocks_of(page)
    assert marked and blocks == ["The & title", "One two <b> boldtext", "Second para", "a", "b"]
    assert ht.blocks_of("<p>plain <i>text</i></p><div>and more") == (["plain text", "and more"], False)
    assert ht.blocks_of("") == ([], False)
    assert ht.blocks_of("<article><p>cut off &am") == (["cut off &am"], True)
    assert ht.blocks_of("<article><p>cut off</p><p cla") == (["cut off"], True)
    assert ht.blocks_of("<div class=ad>never closed<article>kept</article>") == (["kept"], True)


def test_a_class_is_chrome_only_as_a_whole():
    for page in (
        '<body class="page has-sidebar"><p>Text</p></body>',
        '<article class="post comments-open"><p>Text</p></article>',
        '<div class="ad-free story"><p>Text</p></div>',
        '<html class="js cookie-consent-ready"><body id="sidebar"><p>Text</p></body></html>',
        '<article><section id="social-policy"><p>Text</p></section></article>',
        '<article><p class="notice-of-meeting">Text</p></article>',
        '<main class="widget"><p>Text</p></main>',
    ):
        assert ht.blocks_of(page)[0] == ["Text"], page
    for name in ("ad", "cookie-notice", "sidebar-left", "comment-list", "story share_bar", "site-header", "related-posts"):
        assert ht.blocks_of(f'<div class="{name}"><p>Gone</p></div><p>Text</p>')[0] == ["Text"], name


def test_copies_of_a_page_are_no_boilerplate(spark):
    own = "these words of an unmarked page stand on it and on its copy alone"
    rows = [(i, f"http://u.org/{i}", f"<div>{own}</div>") for i in range(2)] + [(2, "http://u.org/2", "<div>another text with quite different words than the others have</div>")]
    rows += [(10 + i, f"http://m.org/{i}", f"<article><p>{own}</p></article>") for i in range(9)]
    got = {r.page_id: r.text for r in ht.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {i: own if i != 2 else "another text with quite different words than the others have" for i, _, _ in rows}


def brute_covered(pages, need, k):
    where = {}
    for i, p in enumerate(pages):
        for j in range(len(p) - k + 1):
            where.setdefault(tuple(p[j : j + k]), set()).add(i)
    out = []
    for i, p in enumerate(pages):
        own = [False] * len(p)
        for j in range(len(p) - k + 1):
            if len(where[tuple(p[j : j + k])]) >= need[i]:
                own[j : j + k] = [True] * k
        out.append(own)
    return out


def test_repeats_match_brute_force():
    rng = np.random.default_rng(2)
    for k in (2, 3, 5):
        pages = [rng.integers(1, 4, rng.integers(0, 30)).tolist() for _ in range(6)]
        need = rng.integers(2, 4, 6)
        symbols = np.array(sum(([0] + p for p in pages), []) + [0])
        page = np.array(sum(([i] * (len(p) + 1) for i, p in enumerate(pages)), []) + [5])
        got = ht.repeated_tokens(symbols, page, need[page], k)
        assert got[symbols > 0].tolist() == sum(brute_covered(pages, need, k), [])


def test_unmarked_boilerplate_goes_and_odd_rows_stay(spark):
    notice = "this line of ten words stands on all the pages"
    rows = [(i, f"http://h.org/{i}", f"<div>{notice}</div><p>{i}-th own text with words {i * 7} {i * 11} enough.</p>", 1) for i in range(5)]
    rows += [(10, None, None, 1), (11, "http://x.org", "", None), (11, "http://x.org", "", None), (None, "nonsense", "<p>" + "long " * 50_000, 2)]
    rows += [(20 + i, f"http://H.org:80/a{i}", f"<article><p>{notice}</p><p>Body {i}</p></article>", 1) for i in range(2)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    got = sorted((str(r.page_id), r.text) for r in ht.extract(pages).collect())
    want = [(str(i), f"{i}-th own text with words {i * 7} {i * 11} enough.") for i in range(5)]
    want += [("10", ""), ("11", ""), ("11", ""), ("None", ("long " * 50_000).strip())]
    want += [(str(20 + i), f"{notice}\n\nBody {i}") for i in range(2)]
    assert got == sorted(want)
    small = ht.extract(pages, settings=ht.Settings(group_bytes=200)).collect()
    assert len(small) == len(rows)
    dealt = ht.extract(pages, settings=ht.Settings(task_bytes=10_000))
    assert "REPARTITION_BY_NUM" in dealt._jdf.queryExecution().toString()
    assert sorted((str(r.page_id), r.text) for r in dealt.collect()) == got
    assert ht.extract(pages.limit(0)).count() == 0


def test_pages_without_a_host_are_dealt_out_and_not_compared(spark, monkeypatch):
    notice = "this passage of ten words stands on several unrelated pages"
    rows = [(i if i % 2 else None, None if i % 3 else "nonsense", f"<p>{notice}</p><p>Own {i}</p>") for i in range(60)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    seen, apply = [], GroupedData.applyInArrow

    def counted(self, function, schema):
        def rows_in(table):
            assert table.num_rows < 30, "a group is not bounded"
            return function(table)

        seen.append(1)
        return apply(self, rows_in, schema)

    monkeypatch.setattr(GroupedData, "applyInArrow", counted)
    got = ht.extract(pages, settings=ht.Settings(group_bytes=400)).collect()
    assert seen and sorted(r.text for r in got) == sorted(f"{notice}\n\nOwn {i}" for i in range(60))


def test_a_host_of_several_groups_gives_what_one_group_gives(spark):
    draw = np.random.default_rng(3)

    def words(n):
        return " ".join(f"w{i}" for i in draw.integers(0, 3000, n))

    shared = [words(12) for _ in range(6)]
    rows = []
    for n in range(300):
        # stretches on 2/3, 1/4, a fifth of the pages and a bit less; one only on marked pages, one on copies
        on = [shared[0]] * (n % 3 > 0) + [shared[1]] * (n % 4 == 1) + [shared[2]] * (n % 5 == 2) + [shared[3]] * (n % 6 == 3)
        on += [shared[4]] * (n % 20 != 7)
        body = f"<p>{words(20)}</p>" + "".join(f"<p>{x}</p>" for x in on) + f"<p>{words(5)}</p>"
        host = "big" if n < 240 else "small" if n < 290 else ""
        rows.append((n, f"http://{host}/{n}" if host else None, f"<article>{body}</article>" if n % 2 else body))
    # copies, of which some are marked, are one page
    rows += [(1000 + n, "http://big/copy", (f"<article><p>{shared[5]} end</p></article>" if n == 30 else f"<p>{shared[5]} end</p>")) for n in range(80)]
    rows += [(n, u, h) for n, u, h in rows[:20]] + [(2000, "http://big/none", None), (2001, "http://big/empty", "")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(5)

    def texts(group_bytes):
        return sorted((r.page_id, r.url or "", r.text) for r in ht.extract(pages, settings=ht.Settings(group_bytes=group_bytes)).collect())

    whole = texts(1 << 30)
    assert len(whole) == len(rows) and sum("\n\n" in t for _, _, t in whole) > 200
    for group_bytes in (16_000, 3_000, 500):
        assert texts(group_bytes) == whole

"""Operator 7: markup reading, alignment against a table of subsequence lengths, differencing, edge rows."""

import random

from chronoframe.llm import page_diff as pd

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{x:"</p>"}</style><script>var t="<article>";</script></head><body class="menu">
<header>Site <b>name</b></header><nav><ul><li><a href="/x">Menu</a></ul></nav><div class="cookie-notice">We <p>use</p> <div>cookies</div></div>
<article><h1>A &amp; B&nbsp;&#8211; c</h1><p><b>Bold</b>ed <i>te</i>xt
 over   lines<br>next<p>unclosed &lt;tag&gt;<!-- hidden <p>no --><aside>side</aside><div class="ad">buy</div>
<form><input name="q">search</form><p title="a > b">end</p><section id="comments"><article class="comment">first!</article></section></article>
<footer>&copy; foot</footer></body></html>"""


def text_of(page):
    lines = pd.lines_of(page)
    return pd.main_text(lines, [False] * len(lines))


def test_markup():
    assert text_of(PAGE) == "A & B – c Bolded text over lines next unclosed <tag> end"
    assert text_of("<main><p>a</p></main><p>b</p>") == "a"
    assert text_of("<nav>menu<article><p>inside after an open menu</article>") == "inside after an open menu"
    assert text_of("<article>kept<script>never closed") == "kept"
    assert text_of("a < b and <1> <p>c") == "a < b and <1> c"
    assert text_of("<p>plain</p><footer>f</footer>") == "plain"
    assert text_of("<article>" + "<b>" * 50_000 + "deep" + "<div>" * 50_000 + "x") == "deep x"
    assert text_of('<a title="' * 20_000) != "never ends"


def test_names_that_only_hold_a_loose_word_keep_their_text():
    for page in ('<article class="has-sidebar">kept', '<article class="post comments-open">kept', '<main class="ad-free">kept', '<article class="ad">kept',
                 '<article><section id="social-effects">kept</section></article>', '<article><h2 id="related-work">kept</h2></article>', '<article><p class="notice">kept</p></article>',
                 '<article><div class="shared-memory menu-engineering">kept</div></article>', '<body class="menu"><div class="widgetsmith">kept</div>'):
        assert text_of(page) == "kept", page
    for gone in ('class="ad"', 'class="x sidebar"', 'id="comments"', 'class="cookie-notice"', 'class="site-menu"', 'class="sidebar_left"', "class=ad-3", 'id="Share"', 'role="navigation"'):
        assert text_of(f"<article>kept<div {gone}><b>gone</b></div></article>") == "kept", gone
    assert text_of('<article>kept<article class="comment">gone</article></article>') == "kept"
    assert text_of('<div class="masthead">gone</div><div class="header-row">gone</div><p>kept</p>') == "kept"


def test_copies_of_unmarked_pages_keep_their_text(spark):
    text = "a long line that stands in every copy of this page and nowhere else " * 4
    page = f"<div>Top</div><p>{text}</p><div>Bottom</div>"
    rows = [(i, f"http://a.org/x/{i}", page) for i in range(1, 7)] + [(9, "http://a.org/x/9", "<div>Top</div><p>other</p><div>Bottom</div>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    for blocks in (1, 3):
        got = {r["page_id"]: r["text"] for r in pd.extract(df, blocks=blocks).collect()}
        assert all(text.strip() in got[i] for i in range(1, 7)) and got[6] == text.strip() and got[9] == "other"


def test_differencing_decides_inside_marked_pages(spark):
    rows = [(1, "http://a.org/x/1", "<article><p>one</p><p>common quote</p><p>Sign up today</p></article>"),
            (2, "http://a.org/x/2", "<article><p>two</p><p>common quote</p></article><div>Sign up today</div>"),
            (3, "http://b.org/x/1", "<main><p>three</p><p>plain line</p></main>"), (4, "http://b.org/x/2", "<p>four</p><p>plain line</p>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    for blocks in (1, 3):
        got = {r["page_id"]: (r["text"], r["n_shared"]) for r in pd.extract(df, blocks=blocks).collect()}
        assert got == {1: ("one common quote", 2), 2: ("two common quote", 2), 3: ("three plain line", 1), 4: ("four", 1)}


def lcs(a, b):
    t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
    return t[-1][-1]


def test_alignment_is_a_longest_common_subsequence():
    r = random.Random(2)
    for _ in range(1500):
        a = [r.choice("abcde") for _ in range(r.randint(0, 12))]
        b = [r.choice("abcdx") for _ in range(r.randint(0, 12))]
        shared = [x for x, s in zip(a, pd.shared_lines(a, b)) if s]
        left = iter(b)
        assert len(shared) == lcs(a, b) and all(x in left for x in shared)


def site(spark):
    page = lambda *own: "<div>Top</div><p>" + "</p><p>".join(own) + "</p><div>Bottom</div>"
    rows = [(1, "http://a.org/x/1", page("one", "uno")), (2, "http://a.org/x/2?q=1", page("two")), (3, "https://A.org/y/3#f", page("three")),
            (4, "http://b.org/only", page("four")), (5, None, None), (6, "http://a.org/z", ""), (7, "http://c.org/a", PAGE), (8, "http://c.org/b", PAGE), (None, "http://d.org/", page("null")),
            (9, "http://e.org/1", page("nine")), (9, "http://e.org/1", page("nine")), (10, "no url", "<p>x")]
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, _key string, text int")


def test_differencing_and_edge_rows(spark):
    df = site(spark)
    want = {1: "one uno", 2: "two", 3: "three", 4: "Top four Bottom", 5: "", 6: "", 7: text_of(PAGE), 8: text_of(PAGE), None: "Top null Bottom", 10: "x"}
    for blocks in (1, 3, 7):
        got = pd.extract(df, blocks=blocks).collect()
        assert len(got) == 12 and all(r.n_chars == len(r.text) for r in got)
        assert {r.page_id: r.text for r in got if r.page_id != 9} == want
    assert pd.extract(df.where("false")).count() == 0


def test_cuts_do_not_matter(spark):
    r = random.Random(3)
    rows = [(k, f"http://h{k % 3}.org/{r.choice('abc')}/{r.randint(0, 40)}", "<p>" + "<p>".join(r.choice("uvwxyz") * 3 for _ in range(5))) for k in range(300)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    a = sorted(pd.extract(df, blocks=1).collect())
    assert sorted(pd.extract(df, blocks=6).collect()) == a
    assert sum(x.n_shared > 0 for x in a) > 100

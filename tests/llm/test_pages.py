"""Main text of pages: structure, pairing and differencing."""

import itertools

from opsreports.llm import pages


def text_of(source, other=None):
    return pages.main_text(pages.lines_of(source), None if other is None else [pages.digest(t) for t, _ in pages.lines_of(other)])[0]


def test_structure():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body class="home">
      <header><h1>Site</h1></header><nav><ul><li><a href="/">x</a></ul></nav><div class="ad">Buy</div><!-- <p>no</p> -->
      <article><header><h1>A &amp; B</h1></header><p>one  <b>two</b>,<br>three&nbsp;four <p>fi<i>v</i>e</p><div class="share-box">tweet</div>
      <aside>side</aside><form>f</form><section id="comments"><article class="comment"><p>reader</p></article></section></article><footer>&copy; x</footer>"""
    assert text_of(page) == "A & B\none two, three four\nfive"


def test_words_in_other_attributes_are_no_furniture():
    page = """<article><p style="overflow:hidden">one <a title="the hidden valley" href="/hidden-places?id=search">two</a> <a href=/hidden>three</a></p>
      <p data-id="search" data-class='menu'>four</p><p hidden>no</p><p title="a" HIDDEN>no</p><p aria-hidden=true>no</p></article>"""
    assert text_of(page) == "one two three\nfour"


def test_furniture_names_around_an_article():
    for wrap in ('<div class="layout has-sidebar">', '<div id="search-page">', '<section class="x"><div class="sidebar-layout">'):
        assert text_of(f'<div class="menu">m</div>{wrap}<article><p>story</p></article></div>') == "story"
    assert text_of('<div class="search"><main><p>story</p></main></div>') == "story"
    assert text_of('<article><h2 id="related-work">A</h2><section id="social-history"><p>b</p></section><div class="share-box">c</div></article>') == "A\nb"
    teaser = '<div class="related-posts"><article>teaser</article></div>'
    assert text_of("<article>story</article>" + teaser) == "story" and text_of("<p>a story that is long</p>" + teaser) == "a story that is long"
    assert text_of(f'<div class="layout sidebar-left"><article>story</article>{teaser}</div>') == "story"
    assert text_of('<p>story</p><div id="comments"><article class="comment">reader, at some length</article></div><aside><div><article>x</article></div></aside>') == "story"


def test_self_closed_raw_elements_are_empty():
    assert text_of('<article>a <svg viewBox="0 > 0"/>b<script src="x" /> c<svg><text>no</text></svg></article>') == "a b c"


def test_odd_sources():
    assert text_of(None) == text_of("") == "" and text_of("plain  text") == "plain text"
    assert text_of("<p>a<p>b</p></div></p><p>c") == "a\nb\nc"
    assert text_of("<nav><a>m<article><p>x &lt;b&gt; 1 < 2</article>") == "x <b> 1 < 2"
    assert text_of("<article>" + "<p>w</p>" * 20_000 + "</article>").count("\n") == 19_999
    assert text_of("<a " * 2000) is not None


def test_unmarked_pages_lose_shared_lines():
    shell = "<div>Menu</div><div>{}</div><div>Imprint</div>"
    assert text_of(shell.format("first story"), shell.format("second story")) == "first story"
    same = shell.format("a much longer story than the rest of the page has around it, told twice " * 3)
    assert text_of(same, same).startswith("Menu")  # copies tell nothing


def test_longest_common_subsequence():
    for a in itertools.product("xyz", repeat=4):
        for b in itertools.product("xyz", repeat=3):
            best = max(n for n in range(4) for c in itertools.combinations(b, n) if all(x in it for it in [iter(a)] for x in c))
            assert sum(pages.shared_lines(list(a), list(b))) == best


def test_pairs_within_hosts(spark):
    shell = "<div>Menu of {0}</div><p>story {1}</p><div>Imprint of {0}</div>"
    rows = [(i, f"http://h{i % 3}.example.com/en/{i // 3 * 7}?x={i}", shell.format(i % 3, i)) for i in range(60)]
    rows += [(100, None, shell.format(0, 100)), (101, "http://alone.example.com/", shell.format(9, 101)), (None, "http://h0.example.com/en/7", shell.format(0, "none")), (102, "http://h0.example.com/x", None)]
    df = spark.createDataFrame([*rows, rows[0]], "page_id long, url string, html string").selectExpr("*", "1 AS text", "2 AS id").repartition(7)
    got = pages.extract(df).collect()
    assert len(got) == 65
    for r in got:
        if r["page_id"] is not None and r["page_id"] < 60:
            assert r["text"] == f"story {r['page_id']}" and r["nearest"] in (102, *range(60))
            assert r["nearest"] == 102 or r["nearest"] % 3 == r["page_id"] % 3
    by_id = {r["page_id"]: r for r in got}
    assert by_id[100]["nearest"] is None and by_id[101]["text"].startswith("Menu") and by_id[102]["text"] == ""
    assert pages.extract(df.limit(0)).collect() == []

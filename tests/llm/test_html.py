"""HTML extraction: page structure, the suffix array against brute force, host boilerplate on unmarked pages."""

import re
from collections import defaultdict
from html import unescape

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from kestrel.llm import html_extract as H
from kestrel.llm.queries import op6_html_extraction

SF = "/root/testdata/sf0.001"


def _article(page):
    """Plain reading of the given pages, whose articles hold h1 and p elements only."""
    out = []
    for part in re.split(r"</?(?:h1|p)\b[^>]*>", re.search(r"<article>(.*?)</article>", page, re.S)[1]):
        t = " ".join(unescape(re.sub(r"<[^>]*>", " ", part)).split())
        if t:
            out.append(t)
    return "\n".join(out)


def test_query_equals_plain_reading(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = op6_html_extraction(spark, SF).collect()
    assert len(got) == len(pages)
    for r in got:
        assert r.text == _article(pages[r.page_id].html) and r.n_chars == len(r.text) and r.url == pages[r.page_id].url


PAGE = """<!DOCTYPE html><HTML><head><title>T &amp; t</title><style>p{}</style></head><body class="menu-open">
<header><h1>Site</h1></header><nav><ul><li>a<li>b</ul></nav><div class="cookie-notice">We use cookies</div><!-- <p>no</p> -->
<aside>side</aside><div id="ad-top">buy <p>now</p></div>
<article class="post"><header><h1>Head&nbsp;line &lt;1&gt;</h1></header><p>One <b>two<br>three</b> caf&eacute;
  four<p>Five <a href="x>y">link</a> &#128578;<script>if (a < b) { "</p>" }</script> six
<div class="share">share me</div><ul><li>item 1<li>item 2</ul><form><p>mail</p><input></form><table><tr><td>c1<td>c2</tr></table>
<p hidden>hidden</p><div style="display: none">gone</div><blockquote>Q</blockquote><footer>by me</footer>
<section class="comments"><p>first!</p><article>comment</article></section>5 < 6 & 7</article>
<section id="related">more</section><footer>&copy; site</footer></body></html>"""


def test_structure():
    article, candidates, outside = H.split_page(PAGE)
    assert article == ["Head line <1>", "One two three café four", "Five link 🙂 six", "item 1", "item 2", "c1 c2", "Q", "5 < 6 & 7"]
    assert not candidates and "© site" in outside and not any("first" in a for a in article)


@pytest.mark.parametrize("page", [None, "", "<", "<<>><p", "plain", "<script>never closed", "<!-- open", "</p></div>", "<article></article>",
                                  "<p " + "a='" * 50, "<div>" * 3000 + "deep", "<b>" * 3000 + "x" + "</b>" * 3000])
def test_odd_pages(page):
    a, c, o = H.split_page(page)
    assert isinstance(c, list) and isinstance(o, list) and (a is None or isinstance(a, list))


def test_main_and_class_claims():
    assert H.split_page("<main><p>x</p><nav>n</nav></main><p>y</p>")[0] == ["x"]
    assert H.split_page("<div class='content'>x</div><div>y</div>")[0] == ["x"]
    assert H.split_page("<div>x</div><div class=footer>y</div>")[:2] == (None, ["x"])
    assert H.split_page("<main>m<article>x</article></main>")[0] == ["x"]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=1, max_size=60))
def test_suffix_ranks_equal_brute_force(tokens):
    rank = H.suffix_ranks(np.array(tokens, np.uint64), 8)
    cut = [tuple(tokens[i : i + 8]) for i in range(len(tokens))]
    order = {c: i + 1 for i, c in enumerate(sorted(set(cut)))}
    assert rank.tolist() == [order[c] for c in cut]


def _brute(rows, run):
    """rows: (url, html) without marked articles -> texts"""
    streams = [(H.host_of(u), H.split_page(h)[1]) for u, h in rows]
    seen, hosts = defaultdict(set), defaultdict(set)
    for host, blocks in streams:
        words = " ".join(blocks).split(" ") if blocks else []
        if len(words) >= run:
            hosts[host].add("\n".join(blocks))
        for i in range(len(words) - run + 1):
            seen[host, tuple(words[i : i + run])].add("\n".join(blocks))
    out = []
    for host, blocks in streams:
        words = " ".join(blocks).split(" ") if blocks else []
        at = [i for i in range(len(words) - run + 1) if len(seen[host, tuple(words[i : i + run])]) >= max(3, 0.2 * len(hosts[host]))]
        out.append("\n".join(H.clean(blocks, at, run)))
    return out


def test_unmarked_pages_lose_what_their_host_repeats(spark):
    rng = np.random.default_rng(0)
    word = lambda: f"w{rng.integers(10**9)}"
    menu = " ".join(word() for _ in range(12))
    end = " ".join(word() for _ in range(9))
    rows = []
    for i in range(40):
        own = [" ".join(word() for _ in range(20)) for _ in range(2)]
        rows.append((f"http://a.example/{i}", f"<div>{menu}</div><p>{own[0]}</p><p>{own[1]} {end}</p>"))
    rows += [("http://b.example/1", rows[0][1]), ("http://b.example/2", rows[0][1]), ("http://b.example/3", "<p>short menu</p>")]
    rows += [(None, None), (None, "<p>x</p>"), ("odd", ""), ("http://a.example/0", rows[0][1])]
    df = spark.createDataFrame([(i, u, h, "k") for i, (u, h) in enumerate(rows)], "page_id long, url string, html string, host string").repartition(5)
    for shard in (2048, 7):
        got = sorted(H.extract(df, shard_pages=shard).collect())
        assert [r.text for r in got] == _brute(rows, 8) and got[0].host == "k"
    assert menu not in got[3].text and got[40].text == got[41].text and menu in got[40].text  # copies are no repetition


def test_near_copies_keep_their_text(spark):
    """Print versions and mirrors of a page are no boilerplate of each other, on small hosts and on large ones."""
    rng = np.random.default_rng(1)
    body = lambda n: " ".join(f"b{rng.integers(10**9)}" for _ in range(n))
    menu = " ".join(f"m{i}" for i in range(10))
    article = body(200)
    rows = [("http://two.example/1", f"<p>{article}</p>"), ("http://two.example/print", f"<p>{article} printed</p>")]
    rows += [(f"http://four.example/{i}", f"<div>{menu}</div><p>{article} version {i}</p>") for i in range(4)]
    rows += [(f"http://big.example/{i}", f"<div>{menu}</div><p>{body(60)}</p>") for i in range(30)]
    rows += [(f"http://big.example/copy{i}", f"<div>{menu}</div><p>{article} copy {i}</p>") for i in range(5)]
    df = spark.createDataFrame([(i, u, h) for i, (u, h) in enumerate(rows)], "page_id long, url string, html string")
    got = {r.page_id: r.text for r in H.extract(df).collect()}
    assert all(article in got[i] for i in [0, 1, 2, 3, 4, 5, *range(36, 41)])
    assert got[1].endswith("printed") and not any(menu in got[i] for i in range(6, 41))
    assert all(len(got[i].split()) == 60 for i in range(6, 36))


@pytest.mark.parametrize("page,want", [
    ('<article><div class="entry-header"><h1>Title</h1></div><p>Body</p></article>', ["Title", "Body"]),
    ('<article><div class="notice-board-story">a</div><p class="copyright-law-section">b</p><p id="skip-lorry-hire">c</p></article>', ["a", "b", "c"]),
    ('<article><p>x</p><div class="share-buttons big">s</div><div id="comments">c</div><div class="ad_slot_2">d</div><div class="ad3">e</div></article>', ["x"]),
    ('<article><p class="header-photo-credit story">kept</p><div class="related-posts">r</div></article>', ["kept"]),
    ('<article class="post related-topics-essay"><p>x</p></article>', ["x"]),
])
def test_class_names_count_whole(page, want):
    assert H.split_page(page)[0] == want


def test_very_long_pages(spark):
    words = " ".join(f"w{i}" for i in range(200_000))
    rows = [(0, "http://l.example/", f"<nav>{words}</nav><article><p>{words}</p></article>"), (1, "http://l.example/2", f"<p>{words}</p>"), (2, None, "<p>" * 50_000 + "x")]
    got = {r.page_id: r.text for r in H.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {0: words, 1: words, 2: "x"}


def test_empty_table_and_clash(spark):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    assert H.extract(df).count() == 0
    with pytest.raises(ValueError):
        H.extract(spark.createDataFrame([("a", "b", "c")], "text string, url string, html string"))

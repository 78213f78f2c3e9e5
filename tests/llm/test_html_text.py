"""Main text: the given pages against their article element, other layouts, odd rows."""

import html
import random
import re

import pytest

from tripwire.llm import html_text as h

SF = "/root/testdata/sf0.01"


def test_given_pages(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = h.query(spark, SF).collect()
    assert len(got) == len(pages)
    for r in got:
        page = pages[r.page_id].html
        inner = page[page.index("<article>") + 9:page.index("</article>")]
        blocks = (" ".join(html.unescape(re.sub("<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", inner))
        assert r.text == "\n".join(b for b in blocks if b) and r.n_chars == len(r.text) and r.url == pages[r.page_id].url


LONG = "A sentence that is part of the article, long enough to be a paragraph of its own on the page."


@pytest.mark.parametrize("page,want", [
    (None, ""), ("", ""), ("<html><body></body></html>", ""),
    (f"<body><div id=menu><a href=/>Home</a> <a href=/b>About us</a></div><div class=x><h1>Title</h1><p>{LONG}</p><p>Short.</p><p>{LONG}</p></div>"
     "<div class='comments'><p>" + LONG + "</p></div><div><a href=/>Imprint</a></div></body>", f"Title\n{LONG}\nShort.\n{LONG}"),
    (f"<main><header><h1>T &amp; U</h1></header><p>{LONG}<script>if (a<b) x='</p>'</script><aside><p>Side</p></aside><p>Tail&nbsp;&#33;</main><footer>F</footer>",
     f"T & U\n{LONG}\nTail !"),
    ("<article><p>a\n  b<br>c</p><ul><li>one<li class=ad>buy<li>two</ul><form><p>Name</p></form><!-- <p>no</p> --><p hidden>x<p>end</article>",
     "a b c\none\ntwo\nend"),
    ("<article><div class='ad'><div>x</div>y</div><p>kept</p></article><article class='comment'><p>said</p></article>", "kept"),
    ("<article>plain &lt;b&gt; &am text</article", "plain <b> &am text"),
    (f"<nav><ul><li>n</li></ul></nav><p>{LONG}</p><footer>x</footer>", LONG),
    (f"<article><h2>Next</h2><p>Read on.</p></article><div><h1>T</h1><p>{LONG}</p><p>Short.</p><p>{LONG}</p><p>End.</p></div>", f"T\n{LONG}\nShort.\n{LONG}\nEnd."),
    (f"<main><p>Loading</p></main><div><div><p>{LONG}</p></div><div><p>{LONG}</p></div><div><p>Short.</p></div></div>", f"{LONG}\n{LONG}\nShort."),
    ("<body><ul><li><a href=/>Home</a></ul><h1>Hi</h1><p>All is well.</p></body>", "Hi\nAll is well."),
    ("<body><div><a href=/>Home</a> <a href=/x>Away</a></div><div>A short note.</div><div><a href=/>Imprint</a></div></body>", "A short note."),
    (f"<div><p>{LONG}</p><p>{LONG}</p><div class=ad><p>x</p><p>y</p><p>z</p><p>w</p></div><p>After it.</p></div>", f"{LONG}\n{LONG}\nAfter it."),
    (f"</div></article><div><article><p>{LONG}</div><p>{LONG}", f"{LONG}\n{LONG}"),
    (f"<article class=comment><p>said</p></article><article><p>{LONG}</p><p>End.</p></article><p>Out</p>", f"{LONG}\nEnd."),
    ("<div>" * 50_000 + LONG, LONG),
    ("<p>" + "word " * 200_000 + "</p>", ("word " * 200_000).strip()),
    ("<" * 20000 + "a b", "<" * 20000 + "a b"),
])
def test_layouts(page, want):
    got = h.main_text(page)
    if page and page.startswith("<<"):
        assert isinstance(got, str)
    else:
        assert got == want


def brute_surges(lengths, window, surge, dive):
    """Stretches line by line, every window summed anew."""
    def total(i):
        return sum(lengths[i:i + window])
    peak = max(total(i) for i in range(len(lengths) + 1))
    up, down = min(surge, (peak + 1) // 2), min(dive, (peak + 7) // 8)
    out, i = [], 0
    while peak and i < len(lengths):
        if total(i) < up:
            i += 1
            continue
        a = next(j for j in range(i, len(lengths)) if lengths[j])
        b = next(j for j in range(a + 1, len(lengths) + 1) if j == len(lengths) or total(j) < down)
        out.append((a, b))
        i = b + 1
    return out


def test_line_blocks_by_brute_force():
    rng = random.Random(9)
    for _ in range(400):
        lengths = [rng.choice([0, 0, 3, 8, 15, 30, 90, 400]) for _ in range(rng.randrange(1, 30))]
        window, surge = rng.randrange(1, 5), rng.choice([5, 80])
        assert h.surges(lengths, window, surge, 20 if surge == 80 else 2) == brute_surges(lengths, window, surge, 20 if surge == 80 else 2)
    assert h.surges([0, 0], 3, 80, 20) == []


def test_odd_rows(spark):
    df = spark.createDataFrame([(1, None, None, "x"), (None, "u", "<article>t</article>", "x"), (2, "u", "", "x"), (2, "u", "", "x")],
                               "page_id long, url string, html string, text string")
    got = h.extract_pages(df)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted((r.page_id or 0, r.text, r.n_chars) for r in got.collect()) == [(0, "t", 1), (1, "", 0), (2, "", 0), (2, "", 0)]
    assert h.extract_pages(df.limit(0)).count() == 0

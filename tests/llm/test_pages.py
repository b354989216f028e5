"""Main text of pages of known structure."""

from __future__ import annotations

import random

import pytest
from hard import hard_documents

from costgauge.llm import line_blocks

BODY = ["Headline &amp; more", "Short.", "A long paragraph of running text with many words. " * 4, "mid &lt;x&gt;&nbsp;y a<b>b</b>c",
        "Another long paragraph, which goes on for a while as texts do. " * 4, "End."]
WANTED = " ".join(["Headline & more", "Short.", ("A long paragraph of running text with many words. " * 4).strip(), "mid <x> y abc",
                   ("Another long paragraph, which goes on for a while as texts do. " * 4).strip(), "End."])
AD = '<div class="advert">Buy this now at a cheap price, the best offer of the whole year is only for today.</div>'
PARTS = "<h1>{}</h1><p>{}<p>{}</p>{}" + AD + "<p>{}<br></p><p>{}"
TOP = '<nav><ul><li><a href="/a">One</a></li><li><a href="/b">Two</a></li></ul></nav><div id="cookieNotice">We use cookies to make this a better place for all, please accept them.</div>'
SIDE = '<aside><p>Some text beside it that is longer than it should be, about other things.</p></aside><div class="comments"><p>' + "I disagree with all of that. " * 30 + "</p></div>"
END = '<form><label>Your name</label><input value="x"></form><footer>&copy; the house &middot; all rights are reserved by it.</footer>'


@pytest.mark.parametrize(
    "page",
    [
        "<html><head><title>T</title><style>p{{}}</style></head><body class='has-sidebar'>{top}<article>{body}</article>{side}{end}</body></html>",
        "<body>{top}<div class='page with-sidebar'><main>{body}</main>{side}</div>{end}",
        "{top}<div id=content>{body}</div>{side}{end}",
        "<table><tr><td>{top}</td></tr><tr><td>{body}</td><td>{side}</td></tr><tr><td>{end}</td></tr></table>",
        "<!-- <article> --><script>var t='</p><article>';</script>{top}<article>{body}",
    ],
)
def test_structures(page):
    headline, short, long, mid, other, last = BODY
    body = PARTS.format(headline, short, long, f"<p>{mid}</p>", other, last)
    assert line_blocks.main_text(page.format(top=TOP, body=body, side=SIDE, end=END)) == WANTED


def test_odd_pages():
    assert line_blocks.main_text(None) == line_blocks.main_text("") == ""
    assert line_blocks.main_text("<nav><a href=x>only a menu</a></nav>") == ""
    assert line_blocks.main_text("just text, a < b & c") == "just text, a < b & c"
    assert line_blocks.main_text("<p class='x>unclosed quote</p><p>more") in ("unclosed quote more", "more", "")
    long = "<article>" + "<div>" * 3_000 + "deep " + "word " * 200_000 + "</article>"
    assert line_blocks.main_text(long).count("word") == 200_000
    assert line_blocks.main_text("<<<>>> </p></div><" * 1_000) is not None


def test_column(spark):
    schema = "page_id long, url string, html string, text string, _row int"
    rows = [(1, None, None, "old", 1), (2, "u", "", "old", 1), (2, "u", "<article><p>a  b</p><p>c</article>", None, 1)]
    frame = spark.createDataFrame(rows * 2, schema)
    got = line_blocks.extract(frame)
    assert got.columns == ["page_id", "url", "_row", "text"]
    assert sorted(r.text for r in got.collect()) == ["", "", "", "", "a b c", "a b c"]
    assert line_blocks.extract(spark.createDataFrame([], schema)).count() == 0


TEXT = ["The first long paragraph of the main text goes on with plain words. " * 6, "The second one is about as long as that. " * 9]
PLAIN = " ".join(t.strip() for t in TEXT)


def test_small_articles_are_not_the_page():
    """Cards of other texts are articles too."""
    card = "<article><h3>Other</h3><p>A short summary of another text.</p></article>"
    main = "<div>" + "".join(f"<p>{t}</p>" for t in TEXT) + "</div>"
    for page in (main + "<ul><li><a href=x>a</a><li><a href=x>b</a><li><a href=x>c</a></ul><div>" + card * n + "</div>" for n in (1, 4)):
        assert line_blocks.main_text(page).startswith(PLAIN)
    assert line_blocks.main_text(f"<article>{main}</article><div>Something else, which is not in it.</div>") == PLAIN


def test_text_beside_a_large_card():
    """A card does not stand for the page, however much of it is text."""
    main = "<div>" + "".join(f"<p>{t}</p>" for t in (TEXT[0][:250], TEXT[1][:250])) + "</div>"
    found = line_blocks.main_text(f"<article>{'c' * 200}</article>{main}")
    assert TEXT[0][:250].strip() in found and TEXT[1][:250].strip() in found


def test_linked_paragraph_inside_the_text():
    linked = "See <a href=x>the long report about all the things that were said here</a> too."
    page = f"<div><p>{TEXT[0]}</p><p>{linked}</p><p>{TEXT[1]}</p></div>"
    assert "See the long report" in line_blocks.main_text(page)


def test_names_that_are_about_the_text():
    law = f'<main><p>{TEXT[0]}</p><div id="copyright-law"><p>{TEXT[1]}</p></div><div class="share-buttons">Share this</div></main>'
    assert line_blocks.main_text(law) == PLAIN
    period = f'<article><p>{TEXT[0]}</p><p class="notice-period">{TEXT[1]}</p><div class="readerComments"><p>{"No. " * 60}</p></div></article>'
    assert line_blocks.main_text(period) == PLAIN


def plain_runs(weights, window, surge):
    """Runs by the definition: each line asks alone whether it lies between a surge and the next dive."""
    n = len(weights)
    block = lambda i: sum(weights[j] for j in range(i, min(i + window, n)))
    inside = [False] * n
    for i in range(n):
        starts = [j for j in range(i + 1) if weights[j] and block(j) >= surge and all(block(k) > 0 for k in range(j, i + 1))]
        inside[i] = bool(starts)
    runs, i = [], 0
    while i < n:
        if inside[i]:
            end = i
            while end + 1 < n and inside[end + 1]:
                end += 1
            runs.append((i, max(j for j in range(i, end + 1) if weights[j])))
            i = end + 1
        else:
            i += 1
    return runs


def test_distribution_equals_its_definition(spark):
    """Random weights, and the lines of all pages of sf0.01."""
    rng = random.Random(4)
    for _ in range(300):
        weights = [rng.choice([0, 0, 0, 5, 30, 90]) for _ in range(rng.randrange(60))]
        assert line_blocks.runs_of(weights, 3, 80) == plain_runs(weights, 3, 80)
    for row in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect():
        weights = [max(0, line.size - 2 * line.linked) for line in line_blocks.lines_of_page(row.html or "")][:150]
        assert line_blocks.runs_of(weights) == plain_runs(weights, line_blocks.WINDOW, line_blocks.SURGE)


def test_clashing_columns(spark):
    rows = hard_documents(spark).withColumnRenamed("text", "html").withColumnRenamed("doc_id", "page_id")
    got = line_blocks.extract(rows)
    assert got.count() == rows.count() and "a.b" in got.columns and "html" not in got.columns


def test_ids_of_headings_in_the_article():
    page = f'<article><h2 id="social-history">Social history</h2><section id="search"><p>{TEXT[0]}</section><div id="share">Share</div></article>'
    assert line_blocks.main_text(page) == "Social history " + TEXT[0].strip()


def test_short_paragraphs_in_sections():
    """All lines between surge and dive are kept, whichever element they stand in."""
    parts = [PLAIN[:500], "b" * 100, "c" * 100, "d" * 30]
    wanted = " ".join(x.strip() for x in parts)
    links = "<ul>" + "<li><a href=x>a link to elsewhere</a>" * 5 + "</ul>"
    sections = "".join(f"<section><p>{x}</p></section>" for x in parts)
    assert line_blocks.main_text(f"<div>{sections}</div>") == wanted
    assert line_blocks.main_text(f"<body>{links}<div>{sections}</div>{links}<div>about</div>") == wanted
    # Runs of one element belong together, a run of another does not.
    later = f"<section><p>{'e' * 120}</p></section>"
    page = f"<div>{sections}{links}{later}</div>{links}<div><p>{'f' * 120}</p></div>"
    assert line_blocks.main_text(page) == wanted + " " + "e" * 120

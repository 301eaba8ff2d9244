from __future__ import annotations

import html
import random
import re

from fixtures import SF_DIR, read

from kolumna.llm import main_text, queries


def article(page):
    inner = re.search(r"<article>(.*?)(?:</article>|$)", page, re.S).group(1)
    parts = [html.unescape(re.sub(r"<[^>]*(?:>|$)", "", b)) for b in re.split(r"</?(?:h1|p|br)[^>]*>", inner)]
    return " ".join(t for t in (re.sub(r"\s+", " ", p).strip() for p in parts) if t)


def test_table(spark):
    pages = {r.page_id: r.html for r in read(spark, "pages").collect()}
    found = queries.main_texts(spark, SF_DIR).collect()
    assert len(found) == len(pages)
    for r in found:
        assert r.text == article(pages[r.page_id]) and r.n_chars == len(r.text)


PROSE = "A sentence of the article with enough words in it to count, and a little more."
PAGE = f"""<html><head><title>No</title></head><body class="page"><header><a href="/">Home</a></header>
<div id="main-menu"><ul><li><a>One</a><li><a>Two</a></ul></div><div class="cookie-notice">We use cookies and more words than you want to read here.</div>
<main><h1>Title &amp; more</h1><p>{PROSE}<aside>Aside words that do not belong in here at all.</aside><p>Second
 <i>in</i>line&nbsp;&#x41;&eacute; text. {PROSE}<script>var x = "<p>no</p>";</script><div class="ad">Buy this now, it is very cheap and very good.</div>
<blockquote>{PROSE}</blockquote></main><section class="comments"><p>{PROSE} I disagree.</p></section>
<form><input value=x><button>Send</button></form><!-- <p>hidden</p> --><footer>Imprint</footer></body></html>"""


def test_other_layout(spark):
    weights = main_text.fit(read(spark, "pages"))
    expected = f"Title & more {PROSE} Second inline Aé text. {PROSE} {PROSE}"
    assert main_text.main_text(PAGE, weights) == expected
    assert main_text.main_text(PAGE.replace("<main>", "<div>").replace("</main>", "</div>"), weights) == expected
    assert main_text.main_text(PAGE) == expected


def test_best_run():
    rng = random.Random(1)
    for _ in range(300):
        scores = [float(rng.randint(-4, 4)) for _ in range(rng.randint(0, 12))]
        start, end = main_text.best_run(scores)
        best = max([sum(scores[i:j]) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)], default=0)
        assert sum(scores[start:end]) == max(best, 0)


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, "<p"), (4, "plain words only"), (5, "<div>" * 3000 + "deep" + "</div>" * 3000), (5, "<p>a</p>" * 20_000), (6, "</p></div><b>x"), (None, "<p>&#xZZ; &amp &;")]
    pages = spark.createDataFrame([(i, "u", h, 1, "z") for i, h in rows], "page_id long, url string, html string, text int, n_chars string")
    found = main_text.extract(pages, main_text.UNSEEN).collect()
    texts = sorted((r.page_id or 0, r.text) for r in found)
    assert len(found) == len(rows) and all(r.n_chars == len(r.text) for r in found)
    assert (1, "") in texts and (2, "") in texts and (4, "plain words only") in texts
    assert (5, " ".join(["a"] * 20_000)) in texts
    assert main_text.extract(pages.limit(0), main_text.UNSEEN).collect() == []
    assert main_text.fit(pages.limit(0)) == main_text.UNSEEN


WORDS = " ".join(f"<p>{PROSE} Number {i}.</p>" for i in range(12))
LINKS = "<ul>" + "".join(f"<li><a href=/{i}>Link number {i}</a></li>" for i in range(30)) + "</ul>"


def plain_words(page):
    return re.sub(r"\s+", " ", re.sub("<[^>]*>", " ", page)).strip()


def test_wrappers_around_the_article():
    """A class of page furniture on an element that holds the page does not drop it."""
    rest = '<div class="sidebar"><p>Words beside the text.</p></div><section class="comments">' + WORDS * 2 + "</section>"
    for wrapper in ('<div class="site has-sidebar">', '<div class="article-body search-highlight">', '<div id="header-menu">'):
        for begin, end in (("<article>", "</article>"), ("<div>", "</div>")):
            found = main_text.main_text(f"<body>{wrapper}{begin}{WORDS}{end}</div>{rest}</body>")
            assert found == plain_words(WORDS), (wrapper, begin)


def test_all_of_a_marked_article():
    """Lists of links, closing lists and sections within an article stay, with its headline."""
    closing = "<ul>" + "".join(f"<li>Item {i}</li>" for i in range(12)) + "</ul>"
    parts = [
        '<header class="entry-header"><h1>The headline</h1></header>', WORDS, LINKS, WORDS,
        f'<section class="related-work"><h2>Related work</h2><p>{PROSE}</p></section>', closing,
    ]
    page = f"<body><nav>{LINKS}</nav><article>{''.join(parts)}<div class='related'>{LINKS}</div></article><footer>Imprint</footer></body>"
    assert main_text.main_text(page) == plain_words(" ".join(parts))


def test_broken_quotes():
    for tag in ("<p data-x=don't>", '<p title="it>', "<p title='it>", '<p title="a > b" class=x>', "<p title=it's class='y'>", '<p data-h="<b>x</b>">'):
        page = f"<body><article><p>{PROSE} One.</p>{tag}{PROSE} Two.</p><p>{PROSE} It's three, isn't it? \"Yes\".</p></article></body>"
        assert main_text.main_text(page) == f'{PROSE} One. {PROSE} Two. {PROSE} It\'s three, isn\'t it? "Yes".', tag


def test_unclosed_elements():
    """Hidden elements without an end close with the element around them; formulas are text."""
    for name in ("svg", "object", "canvas", "noscript", "iframe"):
        page = f"<body><article><p>{PROSE} One.</p><div><{name}><path d=x>hidden</div><p>{PROSE} Two.</p></article></body>"
        assert main_text.main_text(page) == f"{PROSE} One. {PROSE} Two.", name
    page = f"<article><p>{PROSE} <math><mi>x</mi><mo>=</mo><mn>1</mn></math> holds.</p></article>"
    assert main_text.main_text(page) == f"{PROSE} x=1 holds."

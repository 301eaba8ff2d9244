"""Main text of web pages: the contiguous run of blocks with the highest score.

Words score positive and tags negative. How much follows from pages that mark their article: the log
odds of a kind of word, and of a tag, to stand inside it. One linear scan finds the best run.
"""

from __future__ import annotations

import html as references
import math
import re
from collections import Counter
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from kolumna.llm.common import map_batches, sealed

#: The fit reads at most this many pages, those with the smallest hashes, and none longer than this.
FIT_PAGES, FIT_CHARS = 400, 200_000

# Elements by their role.
HIDDEN = {"script", "style", "noscript", "template", "head", "svg", "iframe", "object", "canvas", "audio", "video"}
#: Of the hidden elements those that markup cannot end: without their end tag the rest of the page is theirs.
RAW = {"script", "style"}
ASIDE = {"nav", "header", "footer", "aside", "form", "button", "select", "textarea", "dialog", "menu"}
BLOCKS = {
    "address", "article", "aside", "blockquote", "body", "br", "caption", "center", "dd", "details", "dialog", "dir", "div",
    "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup",
    "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "option", "p", "pre", "section", "summary", "table", "tbody",
    "td", "tfoot", "th", "thead", "title", "tr", "ul",
}
INLINE = {"b", "br", "blockquote", "code", "em", "h1", "h2", "h3", "h4", "h5", "h6", "i", "p", "q", "s", "span", "strong", "sub", "sup", "u", "wbr"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
#: A start tag of the second closes an open element of the first.
CLOSED_BY = {
    "p": BLOCKS - {"br", "html", "body", "option", "title", "caption", "td", "th", "tr", "tbody", "thead", "tfoot"}, "li": {"li"},
    "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "tr": {"tr"}, "option": {"option"},
    "head": {"body"},
}
#: Words in class, id or role of an element that is not part of the article.
ASIDE_NAMES = re.compile(
    r"(?:^|[\s_-])(ads?|advert\w*|banner|breadcrumbs?|comments?|commentlist|cookies?|consent|copyright|disqus|footer|header|masthead|menu\w*|"
    r"modal|nav|navbar|navigation|newsletter|notices?|popup|promo\w*|related|replies|share|sharing|sidebar\w*|social|sponsor\w*|"
    r"subscribe|toolbar|widget\w*|complementary|contentinfo|alert\w*|login|signup|search\w*|pagination|pager|tags)(?=$|[\s_\d-])",
    re.IGNORECASE,
)
#: Of these words, those of reader comments count however long the element is, and those that sections of an article
#: bear as well count within one for elements that are mostly links only.
COMMENT_NAMES = {"comment", "comments", "commentlist", "disqus", "replies"}
SECTION_NAMES = {"header", "masthead", "banner", "related", "notice", "notices", "tags", "share", "search", "widget", "alert"}
ARTICLE_NAMES = re.compile(r"itemprop\s*=\s*[\"']?articleBody|role\s*=\s*[\"']?main\b", re.IGNORECASE)

_TOKEN = re.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)|<(/?)([a-zA-Z][^\s/>]*)((?:=\s*\"[^\"]*\"(?=[\s/>])|=\s*'[^']*'(?=[\s/>])|[^>])*)(?:>|$)", re.DOTALL)
_NAMES = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
_SPACE = re.compile(r"\s+")


class Block(NamedTuple):
    text: str
    words: int
    kind: str  #: block element, share of linked words, few or many words
    tags: tuple[str, ...]  #: tags since the block before
    outside: bool  #: within an element that is not part of an article
    inside: bool  #: within an element that marks the article


def blocks(page: str) -> list[Block]:
    """Text blocks of a page in order; hidden elements, comments and markup are left out.

    A quote in a tag opens a value only behind an equals sign, and only if its closing quote ends the value.
    """
    found: list[tuple[Block, tuple[Named, ...]]] = []
    stack: list[tuple[str, bool, bool, tuple[Named, ...]]] = []  # element, outside, inside, named elements around
    parts: list[str] = []
    linked = 0
    tags: list[str] = []
    at, end = 0, len(page)

    def flush() -> None:
        nonlocal linked
        text = _SPACE.sub(" ", "".join(parts)).strip()
        parts.clear()
        if text:
            n = text.count(" ") + 1
            share = "linked" if linked * 2 > len(text) else "plain"
            name = next((e for e, *_ in reversed(stack) if e in BLOCKS), "body")
            outside, inside, around = stack[-1][1:] if stack else (False, False, ())
            found.append((Block(text, n, f"{name} {share} {'many' if n > 10 else 'few'}", tuple(tags), outside, inside), around))
            for named in around:
                named.words += n
                named.linked += n if share == "linked" else 0
            tags.clear()
        linked = 0

    def add(raw: str) -> None:
        nonlocal linked
        if raw:
            text = references.unescape(raw)
            parts.append(text)
            if any(e == "a" for e, *_ in stack[-4:]):
                linked += len(text)

    while at < end:
        token = _TOKEN.search(page, at)
        if token is None:
            add(page[at:])
            break
        add(page[at : token.start()])
        at = max(token.end(), token.start() + 1)
        if token.group(2) is None:
            continue
        closing, name, attributes = token.group(1), token.group(2).lower(), token.group(3)
        if name in BLOCKS:
            flush()
        tags.append(name)
        if closing:
            depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name), None)
            if depth is not None:
                del stack[depth:]
            continue
        while stack and name in CLOSED_BY.get(stack[-1][0], ()):
            stack.pop()
        if name in HIDDEN and not attributes.rstrip().endswith("/"):
            close = re.compile(rf"</{re.escape(name)}\s*>", re.IGNORECASE).search(page, at)
            if name == "head" and (body := re.compile(r"<body\b", re.IGNORECASE).search(page, at)) and (close is None or body.start() < close.start()):
                at = body.start()
            elif close or name in RAW:
                at = close.end() if close else end
            else:  # never closed: hidden up to the end of the element around it
                stack.append((name, True, *(stack[-1][2:] if stack else (False, ()))))
            continue
        if name not in VOID:
            outside, inside, around = stack[-1][1:] if stack else (False, False, ())
            labels = " ".join("".join(m) for m in _NAMES.findall(attributes))
            article = name in ("article", "main") or bool(ARTICLE_NAMES.search(attributes))
            if article:
                for named in around:
                    named.has_article = True
            elif labels and name not in ("html", "body"):
                names = {word.lower() for word in ASIDE_NAMES.findall(labels)}
                around = (*around, Named(names, inside)) if names else around
            stack.append((name, outside or name in ASIDE and not (name == "header" and inside), inside or article, around))
    flush()
    page_words = sum(b.words for b, around in found if not b.outside and not any(named.names & COMMENT_NAMES for named in around))
    return [b._replace(outside=b.outside or any(named.is_aside(page_words) for named in around)) for b, around in found]


class Named:
    """An element with a class, id or role of ASIDE_NAMES: what it holds tells whether it is part of the article."""

    def __init__(self, names: set[str], inside: bool) -> None:
        self.names, self.inside = names, inside
        self.words = self.linked = 0
        self.has_article = False

    def is_aside(self, page_words: int) -> bool:
        if self.has_article:
            return False
        if self.names & COMMENT_NAMES or 2 * self.linked >= self.words:
            return True
        if self.inside and self.names <= SECTION_NAMES:
            return False
        return 2 * self.words < page_words


class Weights(NamedTuple):
    words: dict[str, float]  #: by kind of block, at least LEAST
    tags: dict[str, float]  #: by tag, to be taken off, at least LEAST


LEAST, MOST = 0.05, 4.0
UNSEEN = Weights({}, {})


def count_labels(page: str) -> Counter:
    """(kind or tag, inside) counts of a page that marks its article; nothing for any other."""
    found, counts = blocks(page), Counter()
    if any(b.inside and not b.outside for b in found):
        for b in found:
            mark = b.inside and not b.outside
            counts["word " + b.kind, mark] += b.words
            for tag in b.tags:
                counts["tag " + tag, mark] += 1
    return counts


def weights_of(counts: Counter) -> Weights:
    """Log odds, bounded so that words stay positive and tags negative."""
    odds = {k: math.log((counts[k, True] + 1) / (counts[k, False] + 1)) for k in {k for k, _ in counts}}
    clip = lambda x: min(MOST, max(LEAST, x))
    return Weights(
        {k[5:]: clip(x) for k, x in odds.items() if k.startswith("word ")},
        {k[4:]: clip(-x) for k, x in odds.items() if k.startswith("tag ")},
    )


def fit(pages: DataFrame, html_column: str = "html") -> Weights:
    """Weights from a bounded sample of the pages; without a page that marks its article, defaults."""
    sample = pages.select(F.col(html_column).alias("html")).where(F.length("html") <= FIT_CHARS)
    sample = sample.where(F.col("html").rlike("(?i)<article|<main|role\\s*=\\s*[\"']?main|articleBody"))
    keys = sample.select(F.xxhash64("html").alias("h")).distinct().orderBy("h").limit(FIT_PAGES)
    hashes = [r.h for r in keys.collect()]

    def of(batch: pa.RecordBatch) -> dict:
        counts: Counter = Counter()
        for page in batch.column(0).to_pylist():
            counts.update(count_labels(page))
        return {"name": [k for k, _ in counts], "mark": [m for _, m in counts], "n": list(counts.values())}

    chosen = sample.where(F.xxhash64("html").isin(hashes)).dropDuplicates(["html"])
    rows = map_batches(chosen, of, "name string, mark boolean, n long").groupBy("name", "mark").agg(F.sum("n").alias("n"))
    return weights_of(Counter({(r.name, r.mark): r.n for r in rows.collect()}))


def best_run(scores: list[float]) -> tuple[int, int]:
    """Start and end of the contiguous run with the highest sum, the first and longest of equal ones; (0, 0) if none is positive."""
    best, span, total, start = 0.0, (0, 0), 0.0, 0
    for i, score in enumerate(scores):
        if total <= 0:
            total, start = 0.0, i
        total += score
        if total > best or (total == best and span[0] == start and span != (0, 0)):
            best, span = total, (start, i + 1)
    return span


def main_text(page: str | None, weights: Weights = UNSEEN) -> str:
    found = blocks(page or "")
    scores = []
    for b in found:
        default = 0.3 if " plain " in b.kind else LEAST
        score = b.words * weights.words.get(b.kind, default) - sum(weights.tags.get(t, 0.1 if t in INLINE else 0.3) for t in b.tags)
        # What a marked article holds is part of it, whatever its tags.
        scores.append(-abs(score) if b.outside else max(score, LEAST) if b.inside else score)
    start, end = best_run(scores)
    # A page without any prose has no run: a marked article is taken whole then.
    run = found[start:end] if end else [b for b in found if b.inside]
    return " ".join(b.text for b in run if not b.outside)


def extract(pages: DataFrame, weights: Weights, html_column: str = "html", text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """``pages`` with its main text and the number of its code points.

    A null or blank page has an empty text. Repeated pages give the same text, an empty table stays
    empty, columns of ``pages`` with a result's name are replaced. Pages of any length are read whole.
    """
    pages, inner, opened = sealed(pages, text, n_chars)
    at = pages.columns.index(inner[html_column])
    schema = StructType([*pages.schema.fields, *StructType.fromDDL(f"`{text}` string, `{n_chars}` long").fields])

    def run(batches):
        for batch in batches:
            texts = [main_text(p, weights) for p in batch.column(at).to_pylist()]
            extra = [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *extra], names=[*batch.schema.names, text, n_chars])

    return opened(pages.mapInArrow(run, schema), text, n_chars)

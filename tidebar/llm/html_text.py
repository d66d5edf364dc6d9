"""Main text of web pages by the maximum-scoring run of tokens.

A page is a row of words and tags. Words score positive and tags negative; the contiguous run
with the largest sum is the content. What a word and each tag are worth is learned from pages
that label their own content by an `article` or `main` element: the logarithm of how much
more often the token occurs inside than outside. Text of menus, forms, scripts and the like
within the run is left out by its element, class, id or role, and scores nothing; on an element
of running text within an article such a class is one more token with a weight.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape
from math import log

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Pages that weights are learned from, at most: those with the least hash of their id.
LABELLED_PAGES = 400
WORD = "word"
#: A word is worth this at least, and a tag minus this at most.
LEAST = 0.05

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title xmp noembed noframes iframe".split())
#: Elements that never hold main text.
_ASIDE = frozenset(
    "script style noscript template head title nav footer aside form button select option "
    "textarea iframe object canvas svg audio video dialog menu noembed noframes xmp datalist".split()
)
_BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol "
    "optgroup option p pre section summary table tbody tfoot thead title tr ul".split()
)
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big br button cite code data del dfn em font i img input ins kbd label "
    "link mark meta q s samp script small span strike strong style sub sup td th time tt u var wbr "
    "math maction menclose merror mfrac mi mmultiscripts mn mo mover mpadded mphantom mroot mrow ms "
    "mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover semantics annotation".split()
)
#: Blocks that cannot stand in a paragraph; their start ends an open one.
_ENDS_P = _BLOCKS - frozenset("body head html title tr tbody thead tfoot caption option optgroup".split())
#: An open element of these is ended by the next of its kind within the same parent.
_SIBLINGS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"},
}
_SCOPES = frozenset("ul ol dl table select article section main aside nav footer header div body blockquote td".split())
#: Words of classes, ids and roles that mark what surrounds an article.
_MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner banners breadcrumb breadcrumbs "
    "comment comments commentlist commentform consent cookie cookies copyright disclaimer disqus footer "
    "gdpr header masthead menu menus modal nav navbar navigation newsletter notice notices notification "
    "overlay pager pagination popup promo promotion recommended related respond search share sharing "
    "sidebar sidebars skip social sponsor sponsored sponsors subscribe tags toolbar topbar widget widgets "
    "complementary contentinfo alert alertdialog dialog".split()
)
#: Elements of running text and what holds it; they are no sign against a word.
_PROSE = frozenset(
    "article main html body header section p h1 h2 h3 h4 h5 h6 b i em strong u s br blockquote q cite "
    "code pre figure figcaption img sub sup span abbr mark small time".split()
)
_LAYOUT = frozenset("with has no without".split())
_NAMES = _ASIDE | _BLOCKS | _INLINE
#: Elements whose marks within an article are no proof: the text is the article's own.
_TEXTUAL = _PROSE - frozenset("article main html body header section figure".split()) | frozenset(
    "a li dd dt td th tr font q tt".split()
)
#: The token that stands for a mark which is no proof.
MARKED = "!marked"
#: Open elements that are looked through for one that a new element ends.
DEPTH = 64

# Quotes only count after an equals sign; one that never ends, or not soon, is an ordinary character.
# Every part is possessive and ends at the next `<`, so that no page takes more than linear time.
_VALUE = (
    r"=\s*+(?:\"[^\"<>]*+\"|'[^'<>]*+'|\"[^\"]{0,2000}+\"|'[^']{0,2000}+')"
)
_NAME = r"[a-zA-Z][^\s/<>\"'=]*+"
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?:[!?]|/(?![a-zA-Z]))[^<>]*+>?"
    rf"|<(/?)({_NAME})((?:{_VALUE}|[^<>=]++|=)*+)>"
    # a tag that is cut short: its name, and what can only be attributes
    rf"|</?{_NAME}(?:\s++[\w:-]++\s*+(?:{_VALUE}|=\s*+[^\s<>]*+))*+",
    re.S,
)
_ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role|hidden)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden\b", re.I)
_PART = re.compile(r"[a-z]+")
_LABELLED = r"(?i)<(article|main)[\s>]"


def _marked(attributes: str, inside: bool) -> bool:
    """Whether an element's class, id, role or `hidden` sets it aside.

    A header within an article holds its title; a name like `with-sidebar` is a layout's.
    """
    for attribute, *values in _ATTRIBUTE.findall(attributes):
        if attribute.lower() == "hidden":
            return True
        value = re.sub(r"([a-z])([A-Z])", r"\1-\2", next((v for v in values if v), ""))
        for name in value.lower().split():
            parts = set(_PART.findall(name))
            if inside:
                parts.discard("header")
            if not _MARKS.isdisjoint(parts) and _LAYOUT.isdisjoint(parts):
                return True
    return False


def tokens(html: str) -> Iterator[tuple[str, str, bool, bool]]:
    """(kind, value, aside, inside) of each token: a tag's name, or a stretch of text.

    kind is "open", "close" or "text"; `aside` says that the token is part of what is left
    out, `inside` that it stands in an article or main element. A tag that is cut short gives no
    token. Time is linear in the page's length, whatever it holds.
    """
    stack: list[tuple[str, bool, bool]] = []
    opened: Counter = Counter()
    at, length = 0, len(html)

    def state() -> tuple[bool, bool]:
        return stack[-1][1:] if stack else (False, False)

    def cut(depth: int) -> None:
        opened.subtract(x[0] for x in stack[depth:])
        del stack[depth:]

    def end(name: str, limits: frozenset) -> None:
        """End the innermost open element of a name that no element of `limits` hides."""
        if not opened[name]:
            return
        for depth in range(len(stack) - 1, max(-1, len(stack) - 1 - DEPTH), -1):
            if stack[depth][0] == name:
                cut(depth)
                return
            if stack[depth][0] in limits:
                return

    while at < length:
        found = _TOKEN.search(html, at)
        if found is None:
            yield "text", html[at:], *state()
            return
        if found.start() > at:
            yield "text", html[at : found.start()], *state()
        at = found.end()
        if not found[2]:
            continue
        name = found[2].lower()
        if found[1]:
            yield "close", name, *state()
            if opened[name]:
                cut(next(d for d in range(len(stack) - 1, -1, -1) if stack[d][0] == name))
            continue
        if name in _ENDS_P:
            end("p", _SCOPES)
        for other in _SIBLINGS.get(name, ()):
            end(other, _SCOPES - {other})
        aside, inside = state()
        if name == "header" and not inside or name in _ASIDE:
            aside = True
        elif name not in ("html", "body", "article", "main") and _marked(found[3], inside):
            if inside and name in _TEXTUAL and not _HIDDEN.search(found[3]):
                yield "open", MARKED, aside, inside
            else:
                aside = True
        inside = inside or (name in ("article", "main") and not aside)
        yield "open", name, aside, inside
        if name in _VOID or found[3].endswith("/") and name not in _BLOCKS:
            continue
        if name in _RAW:
            last = re.compile(rf"</{re.escape(name)}\s*+>", re.I).search(html, at)
            at = last.end() if last else length
            yield "close", name, aside, inside
            continue
        stack.append((name, aside, inside))
        opened[name] += 1


def _sequence(html: str) -> list[tuple[str, str, int, bool]]:
    """(tag or WORD, text, number of words, inside) of each token; no text of what is aside."""
    out = []
    for kind, value, aside, inside in tokens(html):
        if kind != "text":
            out.append((value, "", 0, inside))
        elif not aside:
            text = unescape(value)
            out.append((WORD, text, len(text.split()), inside))
    return out


def token_counts_of(html: str) -> Counter:
    """(token, inside) to number, for a page that labels its content; tags of known names only."""
    counts: Counter = Counter()
    for token, _, n, inside in _sequence(html):
        if token == WORD:
            counts[WORD, inside] += n
        elif (token in _NAMES or token == MARKED) and token not in ("article", "main", "html", "body"):
            counts[token, inside] += 1
    return counts


def weights_of(counts: dict[tuple[str, bool], int]) -> dict[str, float]:
    """Weight of a word, positive, and of each tag, negative; key "" for tags not met.

    Tags of running text that were not met count least, others half as much as a word.
    """
    inside = sum(n for (_, i), n in counts.items() if i) + 1
    outside = sum(n for (_, i), n in counts.items() if not i) + 1
    out = {}
    for token in {t for t, _ in counts}:
        ratio = log((counts.get((token, True), 0) + 1) / inside) - log(
            (counts.get((token, False), 0) + 1) / outside
        )
        out[token] = max(ratio, LEAST) if token == WORD else min(ratio, -LEAST)
    out.setdefault(WORD, 1.0)
    out[""] = -out[WORD] / 2
    for name in _PROSE - set(out):
        out[name] = -LEAST
    return out


def best_run(scores: list[float]) -> tuple[int, int]:
    """The run [a, b) with the largest sum, the first of equal ones; (0, 0) if none is positive."""
    best, run, start, where = 0.0, 0.0, 0, (0, 0)
    for i, score in enumerate(scores):
        if run <= 0:
            run, start = 0.0, i
        run += score
        if run > best:
            best, where = run, (start, i + 1)
    return where


def main_text(html: str | None, weights: dict[str, float]) -> str:
    """The blocks of the best run, each with single spaces, between empty lines."""
    row = _sequence(html or "")
    scores = [weights[WORD] * n if t == WORD else weights.get(t, weights[""]) for t, _, n, _ in row]
    a, b = best_run(scores)
    blocks, parts = [], []
    for token, text, _, _ in [*row[a:b], ("p", "", 0, False)]:
        if token == WORD:
            parts.append(text)
        elif token in ("br", "td", "th", "img", "wbr"):
            parts.append(" " if token != "wbr" else "")
        elif token in _BLOCKS:
            block = " ".join("".join(parts).split())
            if block:
                blocks.append(block)
            parts = []
    return "\n\n".join(blocks)


def _sample_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        total: Counter = Counter()
        for html in batch.column(0).to_pylist():
            total.update(token_counts_of(html))
        yield pa.record_batch(
            [
                pa.array([t for t, _ in total], pa.string()),
                pa.array([i for _, i in total], pa.bool_()),
                pa.array(list(total.values()), pa.int64()),
            ],
            names=["token", "inside", "n"],
        )


def fit(pages: DataFrame) -> dict[str, float]:
    """Weights from at most `LABELLED_PAGES` of the pages with an article or main element.

    The driver gets their ids' hashes, then one count per tag name. Without such pages a word
    is worth 1 and a tag -1/2.
    """
    place = F.xxhash64(F.col("page_id").cast("string"), F.lit(3)).alias("place")
    labelled = pages.where(F.col("html").rlike(_LABELLED))
    least = labelled.select(place).orderBy("place").limit(LABELLED_PAGES)
    last = least.agg(F.max("place")).first()[0]
    if last is None:
        return weights_of({})
    counts = labelled.where(place <= last).select("html").mapInArrow(
        _sample_counts, "token string, inside boolean, n long"
    )
    rows = counts.groupBy("token", "inside").agg(F.sum("n").alias("n")).collect()
    return weights_of({(r.token, r.inside): r.n for r in rows})


def extract(pages: DataFrame) -> DataFrame:
    """One row per row of `pages`: page_id, url, text, n_chars (code points).

    Blocks are what block elements delimit; character references are decoded, white space in
    a block becomes one space, and blocks are joined by an empty line. A null or empty page,
    or one whose text all stands in what is left out, gives an empty text. Repeated rows are
    kept, other columns ignored; an empty table gives an empty result.
    """
    pages = pages.select("page_id", "url", F.col("html").cast("string").alias("html"))
    weights = fit(pages)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(html.as_py(), weights) for html in batch.column(2)]
            yield pa.record_batch(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string())],
                names=["page_id", "url", "text"],
            )

    types = dict(pages.dtypes)
    out = pages.mapInArrow(run, f"page_id {types['page_id']}, url {types['url']}, text string")
    return out.withColumn("n_chars", F.length("text").cast("long"))

"""Main text of web pages by maximum-scoring subsequence.

A page is a line of tokens: words score positive, tags negative, and the main content is the contiguous region of
the highest total, found in one linear scan. The weights come from labelled pages, those with an article element:
a word scores the share of labelled words of its context (enclosing block, its class, whether inside a link) that
lie in an article; a tag costs more, the more rarely it stands in one.

The region says which element holds the main text: the articles that it covers, or else the smallest container of nearly
all of its words. Every block of that element is kept, on either side of the region too, so that lists, tables, captions
and quotes at an article's ends stay, and what stands behind a notice or an advert inside of it.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Labelled pages that the weights are fitted on, and contexts kept of these (the most frequent): bounds of the fit.
SAMPLE, CONTEXTS = 1000, 5000

#: Elements that don't end a block, that have no end tag, and whose content isn't markup.
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe".split())

#: Elements that are never main text, and ones that are unless they hold it: an article or main element, or most of a page's words.
DROPPED = frozenset("nav aside footer button menu dialog head select svg canvas object".split())
FORMS = frozenset("form fieldset".split())
#: Whole names of class, id or role that are never main text; the first only outside of an article.
PAGE_NAMES = frozenset("header masthead".split())
COMMENT_NAMES = frozenset("comment comments reply replies respond disqus".split())
DROPPED_NAMES = COMMENT_NAMES | frozenset(
    "ad ads advert adverts advertisement adbox banner promo promotion sponsor sponsored sidebar menu nav navbar navigation breadcrumb breadcrumbs footer "
    "notice notices cookie cookies consent popup modal newsletter subscribe share sharing social related widget".split()
)
#: Of these, names that also stand on main text: in an article they drop only what merely groups, and never most of a page's words.
AMBIGUOUS = frozenset("reply replies banner promotion sponsor sidebar menu navigation notice notices share sharing social related widget".split())
GROUPS = frozenset("div section ul ol li".split())
#: Parts of names (ad in ad-slot) that drop what merely groups, but never most of a page's words; and what only begins like one.
DROPPED_PARTS = frozenset("ad ads advert adverts advertisement adslot newsletter cookie cookies consent promo sponsored breadcrumb breadcrumbs popup modal subscribe disqus".split())
NOT_COMMENTS = frozenset("commentary commentaries commentator commentators commented".split())
#: Elements that hold a region only as a part of the main text; and shares of its words: of a container, of an article.
PARTS_OF_TEXT = frozenset("p h1 h2 h3 h4 h5 h6 li ul ol dl dt dd table caption thead tbody tfoot tr td th blockquote pre figure figcaption address header hgroup details summary math".split())
MOST, HALF = 0.8, 0.5
#: Cost of a tag that no labelled page has: less than a word scores.
UNSEEN_TAG = 0.25

_TAG = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)")
_UNQUOTED = re.compile(r"[^>\"']*")
_NAMES = re.compile(r"(?<![^\s\"'/])(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_PART = re.compile(r"[a-z]+")


@dataclass
class Weights:
    """words: score of a word by context; tags: cost of a tag by name; for what isn't listed: word, tag."""

    words: dict[str, float] = field(default_factory=dict)
    tags: dict[str, float] = field(default_factory=dict)
    word: float = 0.5
    tag: float = 1.0


@dataclass
class Token:
    text: str | None  # None: a tag
    name: str  # of the tag; of a text, its context
    block: int  # number of the block that a text belongs to
    dropped: bool
    article: bool
    element: int = -1  # number of the innermost element that isn't inline


def markup(page: str) -> Iterator[tuple[int, int, str, bool, str]]:
    """Where each tag, comment or raw element begins and ends, its name (of others: empty), if it closes, its attributes.

    One scan forward: a quote that nothing ends is seen once, and from there on quotes count as any character. A tag
    that the page breaks off in ends with the page.
    """
    at, quoting, end = 0, True, len(page)
    while (begin := page.find("<", at)) >= 0:
        m = _TAG.match(page, begin)
        if m is None:
            if page.startswith("<!--", begin):
                to = page.find("-->", begin + 4)
                at = end if to < 0 else to + 3
            elif page[begin + 1 : begin + 2] in ("!", "?"):
                to = page.find(">", begin)
                at = end if to < 0 else to + 1
            else:  # a lesser-than sign
                at = begin + 1
                continue
            yield begin, at, "", False, ""
            continue
        to = m.end()
        while quoting:
            to = _UNQUOTED.match(page, to).end()
            if to == end or page[to] == ">":
                break
            to = page.find(page[to], to + 1) + 1
            quoting = to > 0
        if not quoting or to >= end:
            quoting = False
            to = page.find(">", m.end())
            if to < 0:
                yield begin, end, "", False, ""
                return
        name, at = m[2].lower(), to + 1
        if name in RAW and not m[1]:
            close = re.compile(rf"</{name}\s*>", re.I).search(page, at)
            at = close.end() if close else end
            yield begin, at, "", False, name
        else:
            yield begin, at, name, bool(m[1]), page[m.end() : to]


@dataclass
class Page:
    """Tokens, and of each element that isn't inline its parent's number (-1: none) and name."""

    line: list[Token]
    parents: list[int]
    names: list[str]

    def above(self, element: int) -> Iterator[int]:
        """The element and all that hold it, inside out."""
        while element >= 0:
            yield element
            element = self.parents[element]


def tokens(page: str) -> list[Token]:
    return read_page(page).line


def read_page(page: str) -> Page:
    """Texts and tags of a page in order; broken markup is read as browsers mostly do, never refused.

    An element that holds an article or main element isn't dropped, whatever its names; comments after an article are,
    even where each is an article, and so are articles in a nav, an aside and the like.
    """
    out: list[Token] = []
    stack: list[tuple[str, str, tuple[int, ...], bool, int]] = []  # name, context, numbers of the elements that drop it, article, number
    parents: list[int] = []
    element_names: list[str] = []
    kinds: list[str] = []  # of each element that drops: element, comment, name, wide (unless most of the page's words are in it)
    causes: list[tuple[int, ...]] = []  # of each token
    kept: set[int] = set()  # elements that turned out to hold main text
    opened: Counter = Counter()  # names in the stack
    block = links = at = 0
    article_seen = False

    def add(text: str) -> None:
        if text.strip():
            _, context, dropped, article, element = stack[-1] if stack else ("", "", (), False, -1)
            out.append(Token(text, context + "/a" * (links > 0), block, False, article, element))
            causes.append(dropped)
        elif out and out[-1].text is not None and text:
            out[-1].text += " "

    for begin, end, name, closing, attributes in markup(page):
        add(page[at:begin])
        at = end
        if not name:
            block += bool(attributes)  # a raw element
            continue
        if name == "a":
            links = 0 if closing else 1
        if name not in INLINE:
            block += 1
            links = 0
            names: list[str] = []
            if closing:
                if opened[name]:
                    while opened[name] and stack[-1][0] != name:
                        opened[stack.pop()[0]] -= 1
                    opened[stack.pop()[0]] -= 1
            elif name not in VOID:
                if stack and (stack[-1][0] == "p" or stack[-1][0] == name == "li"):
                    opened[stack.pop()[0]] -= 1
                values = [(g[0] or g[1] or g[2]).lower() for g in _NAMES.findall(attributes)] if attributes else []
                names = [p for v in values for p in _PART.findall(v)]
                _, _, dropped, article, parent = stack[-1] if stack else ("", "", (), False, -1)
                kind = _kind(name, {w for v in values for w in v.split()}, article)
                if kind:
                    dropped = (*dropped, len(kinds))
                    kinds.append(kind)
                elif name == "main" or (name == "article" and not article):
                    kept.update(k for k in dropped if name == "main" or not (kinds[k] == "element" or (kinds[k] == "comment" and article_seen)))
                    article_seen |= name == "article"
                opened[name] += 1
                stack.append((name, name + ("." + names[0] if names else ""), dropped, article or name == "article", len(parents)))
                parents.append(parent)
                element_names.append(name)
            inside = bool(stack) and stack[-1][3]
            out.append(Token(None, name, block, False, inside))
            causes.append(())
        elif name == "br":
            add("\n")
    add(page[at:])
    if kinds:
        words = [0] * len(kinds)
        total = 0
        for t, dropped in zip(out, causes, strict=True):
            if t.text is not None:
                n = len(t.text.split())
                total += n
                for k in dropped:
                    words[k] += n
        kept.update(k for k, kind in enumerate(kinds) if kind == "wide" and 2 * words[k] > total)
        for t, dropped in zip(out, causes, strict=True):
            t.dropped = not kept.issuperset(dropped)
    return Page(out, parents, element_names)


def _kind(name: str, names: set[str], article: bool) -> str:
    """How an element drops what it holds (see ``tokens``); empty if it doesn't."""
    if name in DROPPED:
        return "element"
    if name in FORMS:
        return "wide"
    if name in ("html", "body", "main", "article"):
        return ""
    hit = names & DROPPED_NAMES
    if article and name not in GROUPS:
        hit -= AMBIGUOUS
    if hit:
        return "wide" if hit <= AMBIGUOUS else "comment" if hit & COMMENT_NAMES else "name"
    if name in GROUPS:
        parts = {p for n in names for p in _PART.findall(n)}
        if parts & DROPPED_PARTS or any(p.startswith("comment") and p not in NOT_COMMENTS for p in parts):
            return "wide"
    return "name" if not article and (name == "header" or names & PAGE_NAMES) else ""


def region(line: list[Token], weights: Weights) -> tuple[int, int]:
    """The maximum-scoring subsequence as token indices [from, to); empty if nothing scores half a word."""
    best, span, total, begin = 0.5, (0, 0), 0.0, 0
    for k, t in enumerate(line):
        if total <= 0:
            total, begin = 0.0, k
        total += len(t.text.split()) * weights.words.get(t.name, weights.word) if t.text is not None else -weights.tags.get(t.name, weights.tag)
        if total > best:
            best, span = total, (begin, k + 1)
    return span


def main_element(page: Page, begin: int, end: int, weights: Weights) -> list[bool]:
    """Of each token, whether it belongs to the main text that the region [begin, end) points at.

    All of the articles that the region covers at least half of, and of the one it covers most, if these hold most of its
    words; else all of the smallest container of nearly all of them (but lists of links and what labelled pages have
    outside of articles); else the region as it is.
    """
    sizes = [len(t.text.split()) if t.text is not None and not t.dropped else 0 for t in page.line]
    top: list[int] = []  # of each element, the outermost article that it is or lies in
    for name, parent in zip(page.names, page.parents, strict=True):
        above = top[parent] if parent >= 0 else -1
        top.append(above if above >= 0 else len(top) if name == "article" else -1)
    inside: Counter = Counter()
    words: Counter = Counter()
    whole: Counter = Counter()
    for k, (t, n) in enumerate(zip(page.line, sizes, strict=True)):
        if n:
            article = top[t.element] if t.element >= 0 else -1
            whole[article] += n
            if begin <= k < end:
                inside[article] += n
                words[t.element] += n
    total = inside.total()
    covered = {a for a, n in inside.items() if a >= 0}
    if sum(inside[a] for a in covered) >= HALF * total > 0:
        first = max(covered, key=lambda a: (inside[a], -a))
        chosen = {a for a in covered if a == first or inside[a] >= HALF * whole[a]}
        return [t.element >= 0 and top[t.element] in chosen for t in page.line]
    held = [words[e] for e in range(len(page.parents))]
    for e in range(len(held) - 1, -1, -1):  # an element comes before those in it
        if page.parents[e] >= 0:
            held[page.parents[e]] += held[e]
    # of the elements that hold nearly all words, each but one lies in another; the last one is the smallest
    fit = [e for e, n in enumerate(held) if n >= MOST * total and page.names[e] not in PARTS_OF_TEXT]
    if not fit or page.names[fit[-1]] in ("html", "body"):
        return [begin <= k < end for k in range(len(page.line))]
    within = [False] * len(page.parents)
    for e, parent in enumerate(page.parents):
        within[e] = e == fit[-1] or (parent >= 0 and within[parent])
    linked = {t.block for t in page.line if t.text is not None} - {t.block for t in page.line if t.text is not None and t.text.strip() and not t.name.endswith("/a")}
    fits = lambda t: t.element >= 0 and within[t.element] and t.block not in linked and weights.words.get(t.name, weights.word) > 0.1
    return [(begin <= k < end and (t.element < 0 or within[t.element])) or fits(t) for k, t in enumerate(page.line)]


def extract(page: str | None, weights: Weights) -> str:
    """The main text: blocks in page order joined by a line feed, white space inside a block as one space."""
    read = read_page(page or "")
    begin, end = region(read.line, weights)
    if begin == end:
        return ""
    blocks: dict[int, list[str]] = {}
    for t, main in zip(read.line, main_element(read, begin, end, weights), strict=True):
        if main and t.text is not None and not t.dropped:
            blocks.setdefault(t.block, []).append(t.text)
    texts = (" ".join(entities.unescape("".join(parts)).split()) for parts in blocks.values())
    return "\n".join(t for t in texts if t)


def fit(pages: DataFrame, sample: int = SAMPLE, id_col: str = "page_id", html_col: str = "html") -> Weights:
    """Weights from at most ``sample`` labelled pages (those with an article element), chosen by a hash of the id.

    Without labelled pages, words outside of links and dropped elements score alike and every tag costs as much.
    """
    labelled = pages.select(F.col(id_col).alias("id"), F.col(html_col).alias("html")).where(F.lower("html").contains("<article"))
    chosen = labelled.select("id").orderBy(F.xxhash64("id"), "id").limit(sample)
    rows = labelled.join(F.broadcast(chosen), "id", "left_semi").select("html")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for b in batches:
            for page in b.column("html").to_pylist():
                for t in tokens(page):
                    seen[t.text is not None, t.name, t.article and not t.dropped] += len(t.text.split()) if t.text is not None else 1
        keys = list(seen)
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.bool_()), pa.array([k[1] for k in keys], pa.string()), pa.array([k[2] for k in keys], pa.bool_()), pa.array([seen[k] for k in keys], pa.int64())],
            names=["is_text", "name", "inside", "n"],
        )

    counts = rows.mapInArrow(count, "is_text boolean, name string, inside boolean, n long").groupBy("is_text", "name").agg(
        F.sum(F.when(F.col("inside"), F.col("n")).otherwise(0)).alias("inside"), F.sum("n").alias("n")
    )
    weights = Weights()
    for is_text, name, inside, n in counts.orderBy(F.desc("n"), "is_text", "name").limit(CONTEXTS).collect():
        share = (inside + 0.01) / (n + 0.02)
        if is_text:
            weights.words[name] = max(share, 1e-4) if share > 0.1 else 1e-4
        else:
            weights.tags[name] = 0.05 + 4 * (1 - share)
            weights.tag = UNSEEN_TAG
    return weights


def extract_main_text(pages: DataFrame, weights: Weights | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """id, url, text (empty if none) and n_chars (code points) of every page; null html counts as empty.

    Repeated rows give repeated results, rows without an id like any other; pages of any length are read whole, in time
    that grows with it; other columns are ignored; an empty table gives an empty result.
    """
    learned = fit(pages, id_col=id_col, html_col=html_col) if weights is None else weights
    kinds = [pages.schema[c].dataType.simpleString() for c in (id_col, url_col)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [extract(page, learned) for page in b.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), b.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["id", "url", "text", "n_chars"]
            )

    picked = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    return picked.mapInArrow(run, f"id {kinds[0]}, url {kinds[1]}, text string, n_chars long").withColumnsRenamed({"id": id_col, "url": url_col})


def op9_html_extraction(spark, sf_dir: str) -> DataFrame:
    return extract_main_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))

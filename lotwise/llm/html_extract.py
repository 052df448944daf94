"""Main text of web pages by consensus: pages score their containers, hosts vote on their paths, winners are extracted."""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotwise.llm.common import checkpointed, exact, restored, small_batches
from lotwise.llm.url_rules import host_of

# Candidates that each page names to its host.
CANDIDATES = 3
# The innermost steps of a path that are told apart.
PATH_STEPS = 12
# Winning paths (one a host) that may be broadcast; more meet the pages by a shuffle.
BROADCAST_HOSTS = 100_000

# Elements that never hold an article's text, and words in class, id or role that say the same.
SKIPPED_TAGS = frozenset(
    "nav header footer aside button select option menu dialog svg canvas object head noscript template".split()
)
SKIPPED_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent gdpr "
    "notice notices popup modal overlay newsletter subscribe signup sidebar side menu nav navbar navigation breadcrumb "
    "breadcrumbs header footer comment comments disqus replies respond share sharing social related recommended widget "
    "toolbar pagination pager masthead complementary contentinfo search dialog alert".split()
)
# Elements that may hold an article, by how much their text counts.
CONTAINERS = {"article": 4.0, "main": 3.0, "section": 1.2, "div": 1.1, "td": 1.0, "body": 1.0}
ARTICLE_WORDS = frozenset("article post entry story content main text body".split())
# A class that begins with one of these tells what is around an element, not what it is.
MODIFIERS = frozenset("has with no without".split())
# Last words of a class that leave its meaning to the word before: comments-area, ad-slot.
NEUTRAL_WORDS = frozenset("area slot wrap wrapper container box block section list inner unit item items link links button buttons".split())
BLOCK_TAGS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol optgroup option p pre section summary table tbody td "
    "tfoot th thead title tr ul".split()
)
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# An element that ends when one of these opens right inside it.
ENDS_BEFORE = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option", "optgroup"},
    "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "tr": {"tr"},
}

# Elements whose content is no markup. Of the second group, one that is never closed is passed over alone.
RAW_TAGS = frozenset("script style textarea title iframe xmp".split())
CLOSED_TAGS = frozenset("noscript template svg".split())
# Controls of a form, and the text outside links, for each of them, that makes the form a wrapper of the page.
CONTROLS = frozenset("input button select textarea".split())
FORM_CHARS = 100

_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
_QUOTED = re.compile(r"""(?:[^'">]++|"[^"]*"|'[^']*')*+>""")
_ENDS = {tag: re.compile(rf"</{tag}\s*+>", re.IGNORECASE) for tag in RAW_TAGS | CLOSED_TAGS}
_NAMES = re.compile(r"""(?<![\w-])(class|id|role)\s*+=\s*+(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
_HIDDEN = re.compile(r"""(?<![\w-])type\s*+=\s*+["']?hidden\b""", re.IGNORECASE)
_LONG_NUMBER = re.compile(r"&#(?:0{8,}|[0-9]{8})[0-9]*;?")


def _tags(text: str) -> Iterator[tuple[int, int, bool, str, str]]:
    """(begin, end, closing, tag, attributes) of all markup in page order; comments and declarations have an empty tag.

    Every character is looked at a bounded number of times: once a quote proves open to the end, quotes no longer count,
    and a kind of element that proves open to the end isn't searched for its end again.
    """
    at, size = 0, len(text)
    quotes = True
    never_closed = set()
    while (begin := text.find("<", at)) >= 0:
        if text.startswith("<!--", begin):
            close = text.find("-->", begin + 2)
            at = size if close < 0 else close + 3
            yield begin, at, False, "", ""
            continue
        named = _TAG.match(text, begin)
        if not named and text[begin + 1 : begin + 2] not in ("!", "?"):
            at = begin + 1
            continue
        opened = named.end() if named else begin + 2
        whole = _QUOTED.match(text, opened) if named and quotes else None
        quotes = quotes and bool(whole or not named)
        close = whole.end() if whole else text.find(">", opened) + 1
        if not close:
            # Without another ">" only a comment can follow.
            close = text.find("<!--", begin)
            if close >= 0:
                yield close, size, False, "", ""
            return
        at = close
        if not named:
            yield begin, at, False, "", ""
            continue
        tag, attributes = named[2].lower(), text[opened : close - 1]
        if not named[1] and (tag in RAW_TAGS or tag in CLOSED_TAGS and tag not in never_closed and not (tag == "svg" and attributes.endswith("/"))):
            ended = _ENDS[tag].search(text, at)
            if not ended and tag in CLOSED_TAGS:
                never_closed.add(tag)
            else:
                at = ended.end() if ended else size
        yield begin, at, bool(named[1]), tag, attributes


def _unescaped(text: str) -> str:
    """Character references decoded; numbers beyond all characters, which Python may refuse to read, like other wrong ones."""

    def short(found: re.Match) -> str:
        digits = found[0].strip("&#;").lstrip("0") or "0"
        return f"&#{digits};" if len(digits) < 8 else "\ufffd"

    return html.unescape(_LONG_NUMBER.sub(short, text) if "&#" in text else text)


@dataclass
class Element:
    """An open element: whether its text is skipped, its path if it may hold an article, and what it holds so far."""

    tag: str
    skipped: bool
    steps: tuple[str, ...] = ()
    path: str | None = None
    weight: float = 0.0
    first_block: int = 0
    chars: int = 0
    last_block: int = 0
    # Of forms: containers before them, visible controls and articles within them.
    containers: int = 0
    controls: int = 0
    articles: int = 0


@dataclass
class Page:
    """The blocks of text outside skipped elements, and the containers with the range of blocks they hold."""

    blocks: list[str] = field(default_factory=list)
    containers: list[Element] = field(default_factory=list)


def _says_skip(name: list[str]) -> set[str]:
    """The listed word that a class, id or role name, given by its words, ends with: "left-sidebar", but not "has-sidebar"."""
    if not name or name[0] in MODIFIERS:
        return set()
    bare = name
    while len(bare) > 1 and bare[-1] in NEUTRAL_WORDS:
        bare = bare[:-1]
    # Neutral words count out only behind a single word: content-sidebar-wrap holds the content too.
    last = bare[-1] if len(bare) == 1 else name[-1]
    return {last} & SKIPPED_WORDS


def _names(attributes: str) -> tuple[list[str], str, set[str], set[str]]:
    """Words of class, id and role; the first class, digits generalised; listed words that class or id, and role, end with.

    Class and id say nothing where another name of theirs is an article's own ("main-content"), other than comments.
    """
    words: list[str] = []
    first = ""
    bad: set[str] = set()
    roles: set[str] = set()
    article = False
    for kind, *values in _NAMES.findall(attributes):
        value = next((v for v in values if v), "").lower()
        words += re.split(r"[\s_-]+", value)
        if kind.lower() == "class" and not first and value.split():
            first = re.sub(r"\d+", "0", value.split()[0])
        for whole in value.split():
            # Numbers only tell elements of a kind apart.
            name = [w for w in re.split(r"[_-]+", whole) if w and not w.isdigit()]
            if kind.lower() == "role":
                roles |= _says_skip(name)
            else:
                bad |= _says_skip(name)
                article |= bool(name) and name[0] not in MODIFIERS and name[-1] in ARTICLE_WORDS and SKIPPED_WORDS.isdisjoint(name)
    return words, first, bad & {"comment", "comments"} if article else bad, roles


def parse(text: str, by_class: bool = True) -> Page:
    """One walk over the tags of a page. Unclosed and unknown tags don't matter; inline tags join what is around them.

    Where nothing is left because a class or id says to skip it, the page is walked once more without regard to these.
    A form goes when it closes, unless it wraps the page: it has an article in it, nothing to fill in, or FORM_CHARS of text
    for each control. A header stays in an article, where it holds the title.
    """
    by_name = False
    page = Page()
    stack: list[Element] = []
    parts: list[str] = []
    # Elements that are open, by tag, so that stray closing tags cost nothing; and open forms.
    opened: Counter[str] = Counter()
    forms: list[Element] = []
    scored = linked = 0

    def listed(bad: set[str], roles: set[str]) -> bool:
        nonlocal by_name
        by_name = by_name or bool(bad)
        return bool(roles or (by_class and bad))

    def flush() -> None:
        """End the block that is open; text in links counts against it."""
        nonlocal scored, linked
        block = " ".join(_unescaped("".join(parts)).split())
        parts.clear()
        if block:
            page.blocks.append(block)
            scored += len(block) - min(len(block), 2 * linked)
        linked = 0

    def close(upto: int) -> None:
        nonlocal scored
        while len(stack) > upto:
            element = stack.pop()
            opened[element.tag] -= 1
            if forms and forms[-1] is element:
                forms.pop()
                inside = scored + element.chars
                wraps = element.articles or not element.controls or inside >= FORM_CHARS * element.controls
                if not wraps or opened["article"] or opened["main"]:
                    scored = -element.chars
                    del page.blocks[element.first_block :], page.containers[element.containers :]
                elif forms:
                    forms[-1].controls += element.controls
                    forms[-1].articles += element.articles
            if element.path and not element.skipped:
                element.last_block = len(page.blocks)
                element.chars += scored
                page.containers.append(element)

    at = 0
    links = False
    for begin, end, closing, tag, attributes in _tags(text):
        if begin > at and not (stack and stack[-1].skipped):
            piece = text[at:begin]
            parts.append(piece)
            if links:
                linked += len(piece)
        at = end
        if forms and tag in CONTROLS and not closing and not _HIDDEN.search(attributes):
            forms[-1].controls += 1
        if not tag or tag in RAW_TAGS or tag in CLOSED_TAGS:
            continue
        if tag == "a":
            links = not closing
            continue
        if tag == "br":
            parts.append(" ")
            continue
        if tag not in BLOCK_TAGS and tag not in SKIPPED_TAGS:
            if attributes and not closing and tag not in VOID_TAGS:
                _, _, bad, roles = _names(attributes)
                if listed(bad, roles):
                    stack.append(Element(tag, True))
                    opened[tag] += 1
            elif closing and stack and stack[-1].tag == tag:
                close(len(stack) - 1)
            continue
        if not (stack and stack[-1].skipped):
            flush()
        else:
            parts.clear()
        links = False
        if closing:
            for depth in range(len(stack) - 1, -1, -1) if opened[tag] else ():
                if stack[depth].tag == tag:
                    close(depth)
                    break
            continue
        if tag in VOID_TAGS:
            continue
        if stack and stack[-1].tag == "p":
            close(len(stack) - 1)
        while stack and tag in ENDS_BEFORE.get(stack[-1].tag, ()):
            close(len(stack) - 1)
        words, first, bad, roles = _names(attributes) if attributes else ([], "", set(), set())
        above = stack[-1] if stack else None
        skipped = bool(above and above.skipped) or (tag in SKIPPED_TAGS and not (tag == "header" and opened["article"]))
        if not skipped and words and tag not in ("html", "body"):
            if tag in ("article", "main"):
                bad, roles = bad & {"comment", "comments"}, roles & {"comment", "comments"}
            elif not ARTICLE_WORDS.isdisjoint(words) or tag == "header":
                bad, roles = bad - {"header"}, roles - {"header"}
            skipped = listed(bad, roles)
        step = f"{tag}.{first}" if first else tag
        steps = (*(above.steps if above else ()), step)[-PATH_STEPS:]
        element = Element(tag, skipped, steps, first_block=len(page.blocks), chars=-scored)
        if tag in CONTAINERS:
            element.path = ">".join(steps)
            element.weight = CONTAINERS[tag] * (1.0 if ARTICLE_WORDS.isdisjoint(words) else 2.0)
        if forms and tag in ("article", "main") and not skipped:
            forms[-1].articles += 1
        if tag == "form" and not skipped:
            element.containers = len(page.containers)
            forms.append(element)
        stack.append(element)
        opened[tag] += 1
    if at < len(text) and not (stack and stack[-1].skipped):
        parts.append(text[at:])
    flush()
    close(0)
    if by_class and by_name and not page.blocks:
        return parse(text, by_class=False)
    # Pages without any container still have their text.
    page.containers.append(Element("", False, (), "*", 0.5, 0, scored, len(page.blocks)))
    return page


def _outermost(page: Page) -> dict[str, list[Element]]:
    """Containers with text by path, in page order, without those inside another one on the same path."""
    found: dict[str, list[Element]] = {}
    # Inner containers close before outer ones, so from the end outer ones come first.
    for element in reversed(page.containers):
        if element.last_block > element.first_block:
            same = found.setdefault(element.path, [])
            if not same or element.first_block < same[-1].first_block:
                same.append(element)
    return {path: same[::-1] for path, same in reversed(found.items())}


def _path_score(same: list[Element]) -> float:
    return sum(e.weight * e.chars for e in same)


def candidates(text: str | None) -> list[tuple[str, float]]:
    """The best-scored container paths of a page and their scores; the score is text outside links, by kind of element.

    A path's score is the sum over its outermost containers, so an article in several parts counts as a whole.
    """
    scores = [(path, score) for path, same in _outermost(parse(text or "")).items() if (score := _path_score(same)) > 0]
    return sorted(scores, key=lambda x: (-x[1], x[0]))[:CANDIDATES]


def extract(text: str | None, path: str | None) -> str:
    """The text of all the page's outermost containers on the path, in page order; without one, of its best path."""
    page = parse(text or "")
    by_path = _outermost(page)
    chosen = by_path.get(path, [])
    if not _path_score(chosen):
        chosen = max(by_path.values(), key=_path_score, default=[])
    if not _path_score(chosen):
        chosen = by_path.get("*", [])
    return "\n".join(block for e in chosen for block in page.blocks[e.first_block : e.last_block])


def winning_paths(pages: DataFrame, url: str = "url", content: str = "html") -> DataFrame:
    """(host, path): for each host the generalised tag-class path that its pages vote for.

    Each page spreads one vote over its best containers by their scores. Votes are summed before the shuffle, so a host
    with many pages is a few rows; ties go to the smaller path. Pages without text don't vote.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in small_batches(frames):
            hosts, paths, votes = [], [], []
            for host, text in zip(frame["host"], frame["html"], strict=True):
                found = candidates(text)
                total = sum(score for _, score in found)
                for path, score in found:
                    hosts.append(host)
                    paths.append(path)
                    # Whole numbers, so that sums don't depend on their order.
                    votes.append(round(1e6 * score / total))
            yield pd.DataFrame({"host": hosts, "path": paths, "vote": votes})

    named = pages.select(host_of(F.col(url)).alias("host"), F.col(content).alias("html"))
    votes = named.mapInPandas(run, "host string, path string, vote long").groupBy("host", "path").agg(F.sum("vote").alias("votes"))
    return votes.groupBy("host").agg(F.max_by("path", F.struct("votes", F.col("path"))).alias("path"))


def main_texts(pages: DataFrame, id: str = "page_id", url: str = "url", content: str = "html") -> DataFrame:
    """One row per row of `pages`: (id, url, text), the main text of the whole html by the winning path of its host.

    Null or empty html gives an empty text; null URLs and those without a host are one host together. Repeated rows stay.
    The pages are read twice and not shuffled as long as the hosts' paths, counted first, are few enough to broadcast.
    """
    winners = checkpointed(winning_paths(pages, url, content))
    few = winners.count() <= BROADCAST_HOSTS
    rows = pages.select(F.col(id).alias("id"), F.col(url).alias("url"), host_of(F.col(url)).alias("host"), F.col(content).alias("html"))
    met = exact(rows.join(F.broadcast(winners) if few else winners, "host", "left").select("id", "url", "path", "html"))
    kind, url_kind = met.schema["id"].dataType.simpleString(), met.schema["url"].dataType.simpleString()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in small_batches(frames):
            texts = [extract(x, path) for x, path in zip(frame["html"], frame["path"], strict=True)]
            yield pd.DataFrame({"id": frame["id"], "url": frame["url"], "text": texts})

    found = met.mapInPandas(run, f"id {kind}, url {url_kind}, text string")
    return restored(found, rows.select("id", "url")).withColumnsRenamed({"id": id, "url": url})

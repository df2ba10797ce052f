"""Main text of web pages by two-pass block rules.

The first pass gives each block a label from stop-word density, length and link
density; blocks inside boilerplate elements are bad whatever they say. The second
pass gives ambiguous short blocks the label of their nearest decided neighbours.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .arrow import append_columns

# ---- fixed values ---------------------------------------------------------------

#: Frequent words of the languages served.
STOP_WORDS = frozenset(
    """
    the of and to a in is that it for was on are as with be by at this from or an not but have had has he she they his
    her its which we you their been were will would can all there what so if no when who more out up one about
    le la les de des du un une et en est que qui dans pour par sur pas au aux avec ce cette il elle ne se plus ou sont
    son sa ses leur nous vous mais comme
    der die das und in zu den von mit ist des sich auf für nicht ein eine als auch es an werden aus er hat dass sie nach
    wird bei einer um am sind noch wie einem über einen so zum war haben nur oder aber vor zur bis mehr durch man dem
    el los las y del se lo por con su para una al como más pero sus este ya entre cuando muy sin sobre también me hasta
    hay donde quien desde todo nos durante todos
    """.split()
)

#: Elements whose text is never shown or never prose.
UNSEEN = frozenset("script style noscript template title svg iframe object canvas audio video select".split())

#: Elements that hold no article text. A form holds none unless the page lies in it.
BOILERPLATE = frozenset("nav footer aside button menu dialog textarea".split())

#: Elements that start and end blocks.
BLOCKS = frozenset(
    """
    address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer
    form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table
    tbody td tfoot th thead tr ul
    """.split()
)

#: Elements without an end.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())

#: Words in class, id or role that mark boilerplate.
MARKS = frozenset(
    """
    ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent
    gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login nav navbar navigation
    menu menus breadcrumb breadcrumbs pagination pager sidebar sidebars aside footer comment comments commentlist
    disqus reply replies respond share sharing social related recommended widget toolbar skip copyright contentinfo
    complementary masthead
    """.split()
)

#: The same for an article inside the page: what is no article at all.
NO_ARTICLE = frozenset("comment comments reply replies ad ads advert promo sponsored related".split())

#: Words after a mark that leave it a mark (nav-links, comment-list), and first words of a token that says what a page has.
FORMS = frozenset(
    """
    area articles bar block bottom box btn button buttons container content form icon icons inner item items label left
    link links list message panel posts right section slot text title top unit wrap wrapper
    """.split()
)
STATES = frozenset("has have with without no not is hide show".split())

#: Elements that end an open <p>.
_ENDS_P = BLOCKS - {"html", "body", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "li", "dd", "dt", "option"}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    # A quote counts only where a value begins; elsewhere it is part of a name or value.
    r"|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:=\s*\"[^\"]*\"|=\s*'[^']*'|[^>])*)(?:>|\Z)",
    re.S,
)
_MARKED = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_HREF = re.compile(r"(?:^|\s)href\s*=", re.I)
_HIDDEN = re.compile(r"""(?:\s|^)(?:hidden(?=[\s/=]|$)|aria-hidden\s*=\s*["']?true)|display\s*:\s*none""", re.I)
_WORDS = re.compile(r"[^\W\d_]+")
#: Letters that say about as much as three of an alphabet.
_WIDE = re.compile("[\u3040-\u30ff\u3400-\u9fff\uac00-\ud7af]")


@dataclass(frozen=True)
class BlockRules:
    """Thresholds of the first pass; lengths in characters, densities as shares of words or characters."""

    links: float = 0.34
    short: int = 40
    long: int = 140
    stop_low: float = 0.08
    stop_high: float = 0.16


@dataclass
class Block:
    """A run of text between block borders."""

    text: str
    linked: int  # characters inside links
    bad: bool  # inside boilerplate
    main: bool  # inside the article or main element
    heading: bool
    section: int  # number of the article it is in, 0 outside
    weak: bool = False  # boilerplate only by marks around its article
    form: int = 0  # number of the outermost form it is in, 0 outside


def _names(values: list[str]) -> set[str]:
    """What class, id and role values name: each token's last word, forms left out, unless it says what a page has."""
    found = set()
    for token in " ".join(values).lower().split():
        words = [w for w in re.split(r"[^a-z]+", token) if w]
        while len(words) > 1 and words[-1] in FORMS:
            words.pop()
        if words and words[0] not in STATES:
            found.add(words[-1])
    return found


def split_blocks(page: str) -> list[Block]:
    """Blocks of a page in order, by one scan over its tags; broken markup is taken as it comes."""
    blocks: list[Block] = []
    # Element, starts boilerplate, only by outer marks, starts main, is a link with a target.
    stack: list[tuple[str, bool, bool, bool, bool]] = []
    opened: Counter[str] = Counter()  # how many of each element are on the stack
    state = {"bad": 0, "soft": 0, "main": 0, "link": 0, "heading": 0, "section": 0, "articles": 0, "forms": 0}
    # Text, inside a link, 2 in boilerplate and 1 if only by outer marks, inside a label.
    parts: list[tuple[str, bool, int, bool]] = []

    def add(text: str) -> None:
        parts.append((text, state["link"] > 0, 2 if state["bad"] else 1 if state["soft"] else 0, opened["label"] > 0))

    def flush() -> None:
        if parts:
            # What an inline element makes boilerplate is left out of the block; alone it is a block.
            level = min((p[2] for p in parts if html.unescape(p[0]).strip()), default=0)
            parts[:] = [p for p in parts if p[2] <= level]
            # A label in a sentence is part of it; alone it belongs to a control.
            named = all(p[3] for p in parts if html.unescape(p[0]).strip())
            # References are decoded first, so that a reference to white space is white space.
            text = " ".join(html.unescape("".join(p[0] for p in parts)).split())
            if text:
                linked = sum(len(" ".join(html.unescape(p).split())) for p, in_link, *_ in parts if in_link)
                heading, main = state["heading"] > 0, state["main"] > 0
                form = state["forms"] if opened["form"] else 0
                blocks.append(Block(text, linked, level > 0 or named, main, heading, state["section"], level == 1 and not named, form))
            parts.clear()

    def leave(entry: tuple[str, bool, bool, bool, bool]) -> None:
        name, bad, soft, main, link = entry
        opened[name] -= 1
        state["bad"] -= bad
        state["soft"] -= soft
        state["main"] -= main
        state["link"] -= link
        state["heading"] -= name in ("h1", "h2", "h3", "h4", "h5", "h6")
        if main and not state["main"]:
            state["section"] = 0

    at, end = 0, len(page)
    while at < end:
        m = _TOKEN.search(page, at)
        if m is None:
            add(page[at:])
            break
        if m.start() > at:
            add(page[at : m.start()])
        at = m.end()
        if m[2] is None:
            continue
        name = m[2].lower()
        if m[1]:  # an end tag closes down to its element, if that is open
            if name in BLOCKS:
                flush()
            if opened[name]:
                while stack:
                    entry = stack.pop()
                    leave(entry)
                    if entry[0] == name:
                        break
            continue
        if name in UNSEEN:
            if not m[3].endswith("/"):
                stop = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
                at = stop.end() if stop else end
            continue
        if name in BLOCKS:
            flush()
            if name in _ENDS_P and opened["p"]:
                # A new block ends an open paragraph and what was left open in it.
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] == "p":
                        while len(stack) > i:
                            leave(stack.pop())
                        break
                    if stack[i][0] in BLOCKS:
                        break
            if name in ("li", "dd", "dt", "option", "tr", "td", "th") and stack and stack[-1][0] == name:
                leave(stack.pop())
        if name in ("br", "img", "hr", "input"):
            add(" ")
        if name in VOID or name == "head" or m[3].endswith("/"):
            continue
        # The id of a heading is made from its words.
        heading = name in ("h1", "h2", "h3", "h4", "h5", "h6")
        values = [" ".join(v) for k, *v in _MARKED.findall(m[3]) if not (heading and k.lower() == "id")]
        words = _names(values)
        every = set(re.split(r"[^a-z]+", " ".join(values).lower()))
        in_article = state["main"] > 0
        marks = NO_ARTICLE if name == "article" else frozenset() if name in ("html", "body", "main") else MARKS
        heads = name == "header" or ("header" in words and not every & {"article", "entry", "post"})
        bad = (
            name in BOILERPLATE
            or (heads and not in_article)
            or (name == "form" and in_article)
            or bool(words & marks & (NO_ARTICLE if not in_article else MARKS))
            or bool(_HIDDEN.search(m[3]))
        )
        # Other marks outside an article may be of a wrapper around it.
        soft = not bad and bool(words & marks)
        main = name in ("article", "main") and not bad
        # An anchor without a target is no link.
        link = name == "a" and bool(_HREF.search(m[3]))
        if name == "form" and not opened["form"]:
            state["forms"] += 1
        stack.append((name, bad, soft, main, link))
        opened[name] += 1
        state["bad"] += bad
        state["soft"] += soft
        if main and not state["main"]:
            state["articles"] += 1
            state["section"] = state["articles"]
        state["main"] += main
        state["link"] += link
        state["heading"] += heading
    flush()
    return blocks


def _density(text: str) -> float:
    """Share of stop words."""
    words = _WORDS.findall(text.lower())
    return sum(w in STOP_WORDS for w in words) / max(len(words), 1)


def _length(text: str) -> int:
    """Characters, wide letters as three."""
    return len(text) + 2 * len(_WIDE.findall(text))


def _told_by_words(blocks: list[Block], rules: BlockRules) -> bool:
    """Whether most of a page's longer unlinked text has the stop words known here."""
    known = total = 0
    for b in blocks:
        if not b.bad and _length(b.text) >= rules.short and b.linked <= rules.links * len(b.text):
            total += len(b.text)
            known += len(b.text) * (_density(b.text) >= rules.stop_low)
    return known * 2 >= total


def label(block: Block, rules: BlockRules, by_words: bool = True) -> bool | None:
    """First pass: True for text, False for boilerplate, None for too short or too unclear to say.

    On a page not to be told ``by_words`` length and links alone count.
    """
    if block.bad:
        return False
    if block.linked > rules.links * len(block.text):
        # In an article a paragraph or reference may be a link; a short one says nothing.
        return False if not block.main else True if len(block.text) >= rules.short else None
    if not by_words:
        return True if _length(block.text) >= rules.short else None
    if len(block.text) < rules.short:
        return None
    density = _density(block.text)
    if density >= rules.stop_high or (len(block.text) >= rules.long and density >= rules.stop_low):
        return True
    if density < rules.stop_low and not block.main and len(block.text) < rules.long:
        return False
    return None


def main_text(page: str | None, rules: BlockRules) -> str:
    """Text blocks of a page joined by newlines; a null or empty page has none."""
    blocks = split_blocks(page or "")
    _judge_forms(blocks, rules)
    if not any(b.main and not b.bad for b in blocks):
        for b in blocks:  # the only article is in marked wrappers, which then are no boilerplate
            b.bad = b.bad and not (b.main and b.weak)
    if any(b.main and not b.bad for b in blocks):
        for b in blocks:  # a page that says where its article is has none elsewhere
            b.bad = b.bad or not b.main
    by_words = _told_by_words(blocks, rules)
    first = [label(b, rules, by_words) for b in blocks]
    for start, stop in _link_runs(blocks, rules):
        first[start:stop] = [False] * (stop - start)
    return "\n".join(b.text for b, good in zip(blocks, _inherit(blocks, first)) if good)


def _judge_forms(blocks: list[Block], rules: BlockRules) -> None:
    """Forms outside articles are boilerplate, but for one that holds the article or, on a page without one, most of the long text."""
    articles = {b.form for b in blocks if b.main and not b.bad}
    size: Counter[int] = Counter()
    for b in blocks:
        if not b.bad and _length(b.text) >= rules.long and b.linked <= rules.links * len(b.text):
            size[b.form] += len(b.text)
    whole = sum(size.values())
    for b in blocks:
        holds = b.form in articles and b.main if articles else size[b.form] * 2 > whole
        b.bad = b.bad or (b.form > 0 and not holds)


RUN = 3


def _link_runs(blocks: list[Block], rules: BlockRules) -> list[tuple[int, int]]:
    """Runs of at least three short blocks of an article that are links and nothing else: a menu."""
    runs, start = [], None
    for i, b in enumerate([*blocks, None]):
        item = b is not None and b.main and len(b.text) < rules.short and b.linked * 10 >= len(b.text) * 9
        if item and start is None:
            start = i
        elif not item and start is not None:
            if i - start >= RUN:
                runs.append((start, i))
            start = None
    return runs


def _inherit(blocks: list[Block], first: list[bool | None]) -> list[bool]:
    """Second pass: an undecided block takes the label of the nearest decided neighbours of the same article.

    If they differ the nearer counts, if they are as near text wins. Where nothing
    near is decided the block is text. One walk forward and one back find them all.
    """

    def walk(order: range) -> list[tuple[int, bool] | None]:
        near: list[tuple[int, bool] | None] = [None] * len(blocks)
        section, last = None, None
        for i in order:
            if blocks[i].section != section:
                section, last = blocks[i].section, None
            near[i] = None if last is None else (abs(i - last[0]), last[1])
            # Marked boilerplate cut out of an article says nothing about its neighbours.
            if first[i] is not None and not (section and blocks[i].bad):
                last = (i, bool(first[i]))
        return near

    out = []
    for own, a, b in zip(first, walk(range(len(blocks))), walk(range(len(blocks) - 1, -1, -1))):
        found = [x for x in (a, b) if x]
        close = min((away for away, _ in found), default=0)
        out.append(bool(own) if own is not None else not found or any(good for away, good in found if away == close))
    return out


def extract_main_text(
    pages: DataFrame, html_col: str = "html", text_col: str = "text", rules: BlockRules | None = None
) -> DataFrame:
    """All columns of ``pages`` but the html, plus ``text_col`` with the page's main text.

    A null or empty page, and a page without text blocks, gives an empty text.
    Repeated rows are treated alike. An empty table gives an empty table. Other
    columns pass unchanged; one named like the result is replaced. Nothing is
    shuffled; a task holds one batch of pages.
    """
    used = rules or BlockRules()

    def start():
        return lambda values: [[main_text(v, used) for v in values]]

    keep = [c for c in pages.columns if c != html_col]
    return append_columns(pages, html_col, [(text_col, T.StringType())], start, keep)

"""Blocks of an HTML page: its text between block-level tags, with their surroundings."""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass, field

# Element names of the HTML standard, by kind.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe object svg canvas audio video xmp noframes noembed".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr "
    "math semantics annotation annotation-xml mi mn mo ms mtext mspace mrow mfrac msqrt mroot mstyle merror mpadded "
    "mphantom mfenced menclose msub msup msubsup munder mover munderover mmultiscripts mtable mtr mtd".split()
)
UNSEEN = frozenset(
    "head title textarea select option optgroup datalist button label legend form fieldset dialog menu "
    "annotation annotation-xml".split()
)
BOILERPLATE = frozenset("nav footer aside".split())
#: an open element of the key ends where one of the value starts
CLOSED_BY = {
    "p": None,  # any block
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "tbody", "thead", "tfoot"]),
    "td": frozenset(["td", "th", "tr", "tbody", "tfoot"]),
    "th": frozenset(["td", "th", "tr", "tbody", "tfoot"]),
    "option": frozenset(["option", "optgroup"]),
}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<more>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<[!?/][^>]*(?:>|\Z)"
    r"|<[a-zA-Z][^<>]*(?:>|\Z)"
    r"|[^<]+|<",
    re.DOTALL,
)
#: the same for what follows a quote that is never closed: no tag there has quotes
_BROKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/<>]*)(?P<more>[^<>]*)(?:>|\Z)|<[!?/][^<>]*(?:>|\Z)|[^<]+|<", re.DOTALL
)
_TAG_START = re.compile(r"</?[a-zA-Z]")
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))|\b(hidden)\b")
_HINT = re.compile(r"[a-z]+|[A-Z]+(?![a-z])|[A-Z][a-z]*")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)

BAD_STEMS = (
    "advert sponsor promo sidebar footer menu navig breadcrumb pagination pager cookie consent gdpr newsletter "
    "subscri signup signin login share sharing social related recommend comment disqus respond widget banner popup "
    "modal notice alert disclaimer copyright toolbar masthead trending sitemap paywall "
    "adsby adslot adunit adbox adwrap adcontainer"
).split()
BAD_WORDS = frozenset("ad ads adv nav reply replies search aside tags legal skip topbar navbar ticker".split())
GOOD_WORDS = frozenset("article content post entry story main text body prose".split())
#: words that make a class a state of the page and no name of a part
STATES = frozenset("has with no without".split()), frozenset("open closed enabled disabled ready loaded accepted".split())
BAD_ROLES = frozenset(
    "navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split()
)

#: what an element says of the text in it
PLAIN, GOOD, BAD, GONE = 0, 1, 2, 3


@dataclass(slots=True)
class Block:
    """Raw text pieces between two block borders."""

    node: int  # the innermost open block-level element
    tag: str
    context: int
    pieces: list[str] = field(default_factory=list)
    chars: int = 0
    linked: int = 0

    def text(self) -> str:
        return " ".join(html.unescape("".join(self.pieces)).split())


def _says(name: str, more: str, inside: int) -> int:
    """What a start tag says of the text in it, given what the elements around say."""
    if inside in (BAD, GONE):
        return inside
    if name in UNSEEN:
        return GONE
    if name in BOILERPLATE or (name == "header" and inside != GOOD):
        return BAD
    found = GOOD if name in ("article", "main") else inside
    if "=" not in more and "hidden" not in more:
        return found
    for key, *values, hidden in _ATTRIBUTE.findall(more):
        value = values[0] or values[1] or values[2]
        key = key.lower()
        if hidden or (key == "aria-hidden" and value == "true") or (key == "style" and _HIDDEN.search(value)):
            return GONE
        if key == "role" and value.lower() in BAD_ROLES:
            return BAD
        if key == "itemprop" and value == "articleBody":
            found = GOOD
        if key in ("class", "id") and name not in ("html", "body", "article", "main"):
            for token in value.split():
                words = [word.lower() for word in _HINT.findall(token)]
                if len(words) > 1 and (words[0] in STATES[0] or words[-1] in STATES[1]):
                    continue
                if any(word in BAD_WORDS or word.startswith(tuple(BAD_STEMS)) for word in words):
                    return BAD
                if GOOD_WORDS.intersection(words):
                    found = GOOD
                elif "header" in words and found != GOOD:
                    return BAD
        elif key in ("class", "id") and name in ("article", "main"):
            words = [word.lower() for word in _HINT.findall(value)]
            if any(word.startswith(("comment", "respond", "advert", "sponsor", "promo")) for word in words):
                return BAD
    return found


@dataclass(slots=True)
class Tree:
    """The block-level elements of a page, each with its parent and depth; 0 is the page itself."""

    parent: list[int] = field(default_factory=lambda: [0])
    depth: list[int] = field(default_factory=lambda: [0])

    def add(self, parent: int) -> int:
        self.parent.append(parent)
        self.depth.append(self.depth[parent] + 1)
        return len(self.parent) - 1

    def distance(self, one: int, other: int) -> int:
        """Steps between two elements."""
        steps = 0
        while one != other:
            if self.depth[one] >= self.depth[other]:
                one = self.parent[one]
            else:
                other = self.parent[other]
            steps += 1
        return steps


class _Open:
    """The open elements, innermost last."""

    def __init__(self) -> None:
        self.names: list[str] = []
        self.says: list[int] = [PLAIN]
        self.blocks: list[tuple[int, int]] = []  # place in names and node of those that are block-level
        self.count: Counter[str] = Counter()
        self.links = 0

    def node(self) -> int:
        return self.blocks[-1][1] if self.blocks else 0

    def tag(self) -> str:
        return self.names[self.blocks[-1][0]] if self.blocks else ""

    def push(self, name: str, says: int, node: int | None) -> None:
        if node is not None:
            self.blocks.append((len(self.names), node))
        self.names.append(name)
        self.says.append(says)
        self.count[name] += 1
        self.links += name == "a"

    def pop_to(self, name: str) -> bool:
        """Close elements up to the innermost of a name; whether a block-level one was among them."""
        border = False
        while True:
            gone = self.names.pop()
            self.says.pop()
            self.count[gone] -= 1
            self.links -= gone == "a"
            if self.blocks and self.blocks[-1][0] == len(self.names):
                self.blocks.pop()
                border = True
            if gone == name:
                return border


def blocks(page: str) -> tuple[list[Block], Tree]:
    """The blocks of a page in its order, those that never show left out, and the tree of its elements.

    Unclosed and stray tags are taken as browsers take them, as far as blocks
    depend on it; an unended comment or raw element lasts to the end. A tag whose
    quotes are never closed is text, and quotes have no meaning after it, so each
    character is looked at a few times at most.
    """
    found: list[Block] = []
    tree, open_ = Tree(), _Open()
    at = 0
    now: Block | None = None
    size, tokens = len(page), _TOKEN
    unended: set[str] = set()
    while at < size:
        token = tokens.match(page, at)
        name = token["name"]
        if name is None and tokens is _TOKEN and _TAG_START.match(page, at):
            tokens = _BROKEN
            continue
        at = token.end()
        if name is None:
            text = token[0]
            if text[0] == "<" and len(text) > 1:
                continue
            if open_.says[-1] == GONE:
                continue
            if now is None:
                if text.isspace():
                    continue
                now = Block(open_.node(), open_.tag(), open_.says[-1])
                found.append(now)
            now.pieces.append(text)
            now.chars += len(text)
            if open_.links:
                now.linked += len(text)
            continue
        name = name.lower()
        if name in RAW:
            if not token["end"] and not token["more"].endswith("/"):
                close = None if name in unended else re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
                if close is None:
                    unended.add(name)
                at = close.end() if close else size
            continue
        inline = name in INLINE
        if not inline:
            now = None
        if name in VOID:
            if name == "br" and now is not None:
                now.pieces.append(" ")
            continue
        if token["end"]:
            if open_.count[name] and open_.pop_to(name):
                now = None
            continue
        if not inline and open_.blocks:
            # an end that the standard lets pages leave out
            outer = open_.tag()
            closers = CLOSED_BY.get(outer, frozenset())
            if closers is None or name in closers:
                open_.pop_to(outer)
        says = _says(name, token["more"], open_.says[-1])
        open_.push(name, says, None if inline else tree.add(open_.node()))
    return [block for block in found if block.chars], tree

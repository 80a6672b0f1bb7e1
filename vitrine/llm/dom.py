"""A small tolerant reader of HTML into a flat list of nodes."""

from __future__ import annotations

import html
import re

#: Fixed values of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript template svg".split())
NEVER_SHOWN = frozenset("script style template svg noscript iframe noembed noframes xmp title".split())
FORMAT = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q rp rt "
                   "ruby s samp small span strike strong sub sup time tt u var wbr".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer "
                     "form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section summary table ul".split())
#: A start tag ends an open element of these, up to one of the holders.
ENDS = {"li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
        "tr": (("tr", "td", "th"), ("table",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")),
        "tbody": (("tr", "td", "th", "thead", "tbody"), ("table",)), "tfoot": (("tr", "td", "th", "tbody"), ("table",)),
        "option": (("option",), ("select",))}

#: Elements that may stand in a head; any other start tag ends it.
HEAD = frozenset("base link meta title style script noscript noframes template".split())

# No part of these patterns gives back what it took, so a page is read in time linear in its length.
_NAME = re.compile(r"[a-zA-Z][^\s/>]*+")
_PART = re.compile(r"""[\s/]*+(?:([^\s/>][^\s/>=]*+)(?:\s*+=\s*+(?:"([^"]*+)(?:"|(\Z))|'([^']*+)(?:'|(\Z))|([^\s>"'][^\s>]*+)|(?=>)))?+)?+""")
_TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_CLOSE = {name: re.compile(rf"</{name}\s*>", re.I) for name in RAW}


class Node:
    """An element, or an inline one that can be told from its surroundings.

    ``items`` holds texts and child numbers in page order.
    """
    __slots__ = ("tag", "parent", "tokens", "items", "inline", "gold", "link", "depth")

    def __init__(self, tag, parent, tokens, inline, gold, depth):
        self.tag, self.parent, self.tokens, self.inline, self.gold, self.depth = tag, parent, tokens, inline, gold, depth
        self.items: list = []
        self.link = 0


def read_tag(source: str, at: int) -> tuple[list[tuple[str, str]], bool, int]:
    """Attributes of a tag whose name ends at ``at``, whether it closes itself, and where it ends; -1 if it never does.

    A quote opens a value only right behind an equals sign; elsewhere it is a
    letter like others, as browsers have it.
    """
    found = []
    while True:
        part = _PART.match(source, at)
        name, a, open_a, b, open_b, c = part.groups()
        at = part.end()
        if name:
            if open_a is not None or open_b is not None:
                return found, False, -1
            found.append((name.lower(), a or b or c or ""))
        if at >= len(source):
            return found, False, -1
        if source[at] == ">":
            return found, source[at - 1] == "/", at + 1


def _comment_end(source: str, at: int) -> int:
    """End of what begins with "<!" or "<?" or a stray "</" at ``at``."""
    if source.startswith("<!--", at):
        if source.startswith((">", "->"), at + 4):
            return source.index(">", at) + 1
        end = [e + n for e, n in ((source.find("-->", at + 4), 3), (source.find("--!>", at + 4, source.find("-->", at + 4)
               if source.find("-->", at + 4) >= 0 else len(source)), 4)) if e >= 0]
        return min(end, default=len(source))
    end = source.find(">", at)
    return end + 1 if end >= 0 else len(source)


def _attributes(found: list[tuple[str, str]]) -> tuple[list, str | None]:
    tokens, gold = [], None
    for name, value in found:
        if name in ("class", "id", "role", "aria-label", "itemprop", "data-role"):
            tokens += [t.lower() for t in _TOKEN.findall(value)]
        elif name == "data-gold":
            gold = value
        elif name == "hidden":
            tokens.append("hidden")
    return tokens, gold


def parse(source: str | None) -> list[Node]:
    """Nodes of a page in page order, the first one the page itself.

    Unclosed and misplaced tags are mended as browsers do in the common
    cases; what is never shown, comments and the head are left out.  Character
    references in text are decoded.
    """
    nodes = [Node("body", -1, [], False, None, 0)]
    if not source:
        return nodes
    # Open elements: (tag, node number or -1 for plain formatting).
    open_: list = []
    node, links, in_head = 0, 0, False
    at, size = 0, len(source)

    def leave(to: int) -> None:
        nonlocal node, links
        while len(open_) > to:
            tag, number = open_.pop()
            if tag == "a":
                links -= 1
            if number >= 0:
                node = nodes[number].parent

    def say(text: str) -> None:
        nonlocal in_head
        if in_head and text.strip():
            in_head = False  # text ends a head that was not closed
        if not text or in_head:
            return
        if "&" in text:
            text = html.unescape(text)
        nodes[node].items.append(text)
        if links > 0:
            nodes[node].link += len(text.strip())

    while at < size:
        mark = source.find("<", at)
        if mark < 0:
            say(source[at:])
            break
        closing = source.startswith("/", mark + 1)
        named = _NAME.match(source, mark + 1 + closing)
        if not named:
            if closing or source.startswith(("!", "?"), mark + 1):
                say(source[at:mark])
                at = _comment_end(source, mark)
            else:  # a "<" of the text
                say(source[at:mark + 1])
                at = mark + 1
            continue
        say(source[at:mark])
        tag = named.group().lower()
        attrs, itself, at = read_tag(source, named.end())
        if at < 0:  # a tag that never ends takes the rest of the page with it
            break
        if closing:
            if tag == "head":
                in_head = False
            if tag in ("html", "body", "head"):
                continue
            for i in range(len(open_) - 1, -1, -1):
                if open_[i][0] == tag:
                    leave(i)
                    break
                # A closing inline tag never ends a block.
                if tag in FORMAT and open_[i][0] not in FORMAT:
                    break
            continue
        if tag == "html":
            continue
        if tag == "head":
            in_head = True
            continue
        if tag not in HEAD:
            in_head = False
        if tag == "body":
            nodes[0].tokens += _attributes(attrs)[0]
            continue
        if tag in RAW and not itself:
            end = _CLOSE[tag].search(source, at)
            if tag in NEVER_SHOWN:
                at = end.end() if end else size
                continue
        if in_head:
            continue
        if tag in CLOSES_P:
            for i in range(len(open_) - 1, -1, -1):
                if open_[i][0] == "p":
                    leave(i)
                    break
                if open_[i][0] not in FORMAT:
                    break
        if tag in ENDS:
            ends, holders = ENDS[tag]
            last = None
            for i in range(len(open_) - 1, -1, -1):
                if open_[i][0] in holders:
                    break
                if open_[i][0] in ends:
                    last = i
            if last is not None:
                leave(last)
        tokens, gold = _attributes(attrs) if attrs else ([], None)
        if tag == "br":
            nodes[node].items.append(" ")
        if tag in VOID:
            if tag in ("input", "hr", "embed"):
                nodes.append(Node(tag, node, tokens, False, gold, nodes[node].depth + 1))
                nodes[node].items.append(len(nodes) - 1)
            continue
        if tag == "a":
            links += 1
        if tag in FORMAT and not (tokens or gold):
            open_.append((tag, -1))
            continue
        nodes.append(Node(tag, node, tokens, tag in FORMAT, gold, nodes[node].depth + 1))
        nodes[node].items.append(len(nodes) - 1)
        node = len(nodes) - 1
        open_.append((tag, node))
    return nodes


def blocks(nodes: list[Node], kept: list[bool]) -> str:
    """Text of the kept nodes: white space to one space inside a block, blocks joined by one line end."""
    out: list[str] = []
    piece: list[str] = []

    def end() -> None:
        text = " ".join("".join(piece).split())
        piece.clear()
        if text:
            out.append(text)

    # (node, next item); an explicit stack, so deep pages are no danger.
    stack = [(0, 0)]
    while stack:
        number, i = stack.pop()
        node = nodes[number]
        if i == 0 and not node.inline:
            end()
        items = node.items
        while i < len(items):
            item = items[i]
            i += 1
            if isinstance(item, int):
                stack.append((number, i))
                stack.append((item, 0))
                break
            if kept[number]:
                piece.append(item)
        else:
            if not node.inline:
                end()
    end()
    return "\n".join(out)

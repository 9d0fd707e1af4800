"""Inner HTML of the elements that a short path selects, for one page at a time.

Paths are made of steps such as //div[@id='main'], /p[2] or //ul[not(@class)]. Used
inside Arrow batches for the pages whose cells plain patterns cannot find.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

VOID = set("area base br col embed hr img input link meta source track wbr".split())
# an opening tag of the first set ends an open element of the second
ENDS = {
    "li": {"li"},
    "p": {"p"},
    "tr": {"tr", "td", "th"},
    "td": {"td", "th"},
    "th": {"td", "th"},
    "option": {"option"},
}
STEP = re.compile(r"(//?)([a-z0-9]+)((?:\[[^\]]*\])*)")
# tags that any reader takes alike: lower-case names, quoted values without entities
PLAIN_TAG = re.compile(
    r"""<(?:/([a-z][a-z0-9]*)[ \t\n]*>|([a-z][a-z0-9]*)((?:[ \t\n]+[a-z][a-z-]*=(?:"[^"<>&]*"|'[^'<>&]*'))*)[ \t\n]*>)"""
)
PLAIN_ATTRIBUTE = re.compile(r"""([a-z][a-z-]*)=(?:"([^"]*)"|'([^']*)')""")
# elements whose content is not read as markup
RAW = set("script style textarea title iframe noembed noframes noscript xmp plaintext svg math".split())


class _Node:
    __slots__ = ("tag", "attrs", "children", "start", "end")

    def __init__(self, tag, attrs, start):
        self.tag, self.attrs, self.start, self.end = tag, attrs, start, None
        self.children = []


class _Tree(HTMLParser):
    def __init__(self, html):
        super().__init__(convert_charrefs=True)
        self.lines = [0]
        for line in html.split("\n"):
            self.lines.append(self.lines[-1] + len(line) + 1)
        self.root = _Node("", {}, 0)
        self.open = [self.root]
        self.feed(html)
        self.close()
        for node in self.open:
            node.end = len(html)

    def _offset(self):
        line, column = self.getpos()
        return self.lines[line - 1] + column

    def handle_starttag(self, tag, attrs):
        at = self._offset()
        while self.open[-1].tag in ENDS.get(tag, ()):
            self.open.pop().end = at
        node = _Node(tag, dict(attrs), at + len(self.get_starttag_text()))
        self.open[-1].children.append(node)
        if tag in VOID:
            node.end = node.start
        else:
            self.open.append(node)

    def handle_startendtag(self, tag, attrs):
        node = _Node(tag, dict(attrs), self._offset())
        node.end = node.start
        self.open[-1].children.append(node)

    def handle_endtag(self, tag):
        at = self._offset()
        if any(node.tag == tag for node in self.open[1:]):
            while self.open[-1].tag != tag:
                self.open.pop().end = at
            self.open.pop().end = at


def _plain_root(html):
    """The tree of a page whose every `<` starts a plain tag, None for other pages.

    The same tree as `_Tree` gives, from one pattern instead of a reader's calls.
    """
    tags = list(PLAIN_TAG.finditer(html))
    if len(tags) != html.count("<"):
        return None
    root = _Node("", {}, 0)
    opened = [root]
    for found in tags:
        closing, tag, attrs = found.groups()
        at = found.start()
        if closing is None:
            if tag in RAW:
                return None
            ends = ENDS.get(tag, ())
            while opened[-1].tag in ends:
                opened.pop().end = at
            held = {n: a or b for n, a, b in PLAIN_ATTRIBUTE.findall(attrs)} if attrs else {}
            node = _Node(tag, held, found.end())
            opened[-1].children.append(node)
            if tag in VOID:
                node.end = node.start
            else:
                opened.append(node)
        elif any(node.tag == closing for node in opened[1:]):
            while opened[-1].tag != closing:
                opened.pop().end = at
            opened.pop().end = at
    for node in opened:
        node.end = len(html)
    return root


def _below(node):
    stack = list(reversed(node.children))
    while stack:
        found = stack.pop()
        yield found
        stack.extend(reversed(found.children))


def _holds(node, conditions):
    for condition in conditions:
        if condition == "not(@class)":
            if "class" in node.attrs:
                return False
        elif condition.startswith("@"):
            name, value = condition[1:].split("=", 1)
            if node.attrs.get(name) != value.strip("'\""):
                return False
    return True


def _step(nodes, deep, tag, conditions):
    place = next((int(c) for c in conditions if c.isdigit()), None)
    out, seen = [], set()
    for node in nodes:
        parents = [node, *_below(node)] if deep else [node]
        for parent in parents:
            same = [c for c in parent.children if c.tag == tag and _holds(c, conditions)]
            if place is not None:
                same = same[place - 1 : place]
            for child in same:
                if id(child) not in seen:
                    seen.add(id(child))
                    out.append(child)
    return sorted(out, key=lambda n: n.start)


def select_many(html: str, paths: list[str]) -> list[list[str]]:
    """Inner HTML of all matches of each path, in document order; the page is read once."""
    root = _plain_root(html) or _Tree(html).root
    out = []
    for path in paths:
        nodes = [root]
        for slashes, tag, brackets in STEP.findall(path):
            conditions = re.findall(r"\[([^\]]*)\]", brackets)
            nodes = _step(nodes, slashes == "//", tag, conditions)
        out.append([html[n.start : n.end] for n in nodes])
    return out


def select(html: str, path: str) -> list[str]:
    return select_many(html, [path])[0]

"""A small HTML tree for one saved page, on the standard library's tokenizer.

Used only inside Arrow UDFs; Spark decides which pages go where.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from html.parser import HTMLParser

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset(["script", "style", "template"])


@dataclass(frozen=True)
class Select:
    """First-match rule: tag, whole class token, part of the class attribute, id, present attribute."""

    tag: str
    token: str | None = None
    contains: str | None = None
    id: str | None = None
    has: str | None = None

    def matches(self, node: Node) -> bool:
        if node.tag != self.tag:
            return False
        cls = node.attrs.get("class") or ""
        if self.token is not None and self.token not in cls.split():
            return False
        if self.contains is not None and self.contains not in cls:
            return False
        if self.id is not None and node.attrs.get("id") != self.id:
            return False
        return self.has is None or self.has in node.attrs


class Node:
    __slots__ = ("tag", "attrs", "kids")

    def __init__(self, tag: str, attrs: dict[str, str]):
        self.tag, self.attrs, self.kids = tag, attrs, []

    def walk(self) -> Iterator[Node | str]:
        """Descendants in document order; script and style bodies are left out."""
        todo = list(reversed(self.kids))
        while todo:
            item = todo.pop()
            yield item
            if isinstance(item, Node) and item.tag not in HIDDEN:
                todo.extend(reversed(item.kids))

    def find_all(self, rule: Select) -> Iterator[Node]:
        return (n for n in self.walk() if isinstance(n, Node) and rule.matches(n))

    def find(self, *rules: Select) -> Node | None:
        """The first element of the first rule that has any."""
        for rule in rules:
            hit = next(self.find_all(rule), None)
            if hit is not None:
                return hit
        return None

    def text(self) -> str:
        return "".join(s for s in self.walk() if isinstance(s, str)).strip()

    def lines(self) -> str:
        """Text pieces, each stripped, empty ones dropped, joined by line breaks."""
        parts = (s.strip() for s in self.walk() if isinstance(s, str))
        return "\n".join(p for p in parts if p)


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("", {})
        self.open = [self.root]

    def handle_starttag(self, tag, attrs):
        node = Node(tag, {k: v or "" for k, v in attrs})
        self.open[-1].kids.append(node)
        if tag not in VOID:
            self.open.append(node)

    def handle_startendtag(self, tag, attrs):
        self.open[-1].kids.append(Node(tag, {k: v or "" for k, v in attrs}))

    def handle_endtag(self, tag):
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag == tag:
                del self.open[i:]
                return

    def handle_data(self, data):
        kids = self.open[-1].kids
        if kids and isinstance(kids[-1], str):
            kids[-1] += data
        else:
            kids.append(data)


def parse(html: str | None) -> Node:
    builder = _Builder()
    builder.feed(html or "")
    builder.close()
    return builder.root

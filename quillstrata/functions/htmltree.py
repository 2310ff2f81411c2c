"""A small tree of a web page, built by the standard library's parser. Open tags are closed as browsers close them."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: What ends an open element: a start tag of one of these, up to the nearest of the second set.
ENDS = {
    "li": ({"li"}, {"ul", "ol"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "td": ({"td", "th"}, {"table"}),
    "th": ({"td", "th"}, {"table"}),
    "tr": ({"tr"}, {"table"}),
}
PARAGRAPH_ENDS = frozenset("p div section article ul ol dl table blockquote pre h1 h2 h3 h4 h5 h6 hr figure".split())


class Element:
    __slots__ = ("attributes", "inside", "tag", "under")

    def __init__(self, tag: str, attributes: dict[str, str], under: Element | None):
        self.tag, self.attributes, self.under = tag, attributes, under
        self.inside: list[Element | str] = []

    def elements(self) -> Iterator[Element]:
        """All below it, in page order."""
        todo = [x for x in reversed(self.inside) if isinstance(x, Element)]
        while todo:
            e = todo.pop()
            yield e
            todo += [x for x in reversed(e.inside) if isinstance(x, Element)]

    def text(self) -> str:
        out, todo = [], list(reversed(self.inside))
        while todo:
            x = todo.pop()
            if isinstance(x, str):
                out.append(x)
            else:
                todo += reversed(x.inside)
        return "".join(out)

    def get(self, name: str) -> str:
        return self.attributes.get(name) or ""

    def classes(self) -> set[str]:
        return set(self.get("class").split())

    def drop(self) -> None:
        if self.under is not None:
            self.under.inside = [x for x in self.under.inside if x is not self]
            self.under = None

    def within(self, tag: str) -> bool:
        above = self.under
        while above is not None:
            if above.tag == tag:
                return True
            above = above.under
        return False


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Element("", {}, None)
        self.open = [self.root]

    def _leave(self, tags: set[str] | frozenset[str], up_to: set[str] | frozenset[str]) -> None:
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k].tag in tags:
                del self.open[k:]
                return
            if self.open[k].tag in up_to:
                return

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in ENDS:
            self._leave(*ENDS[tag])
        elif tag in PARAGRAPH_ENDS:
            self._leave({"p"}, PARAGRAPH_ENDS | {"li", "td", "th", "dd"})
        e = Element(tag, {k: v or "" for k, v in attrs}, self.open[-1])
        self.open[-1].inside.append(e)
        if tag not in VOID:
            self.open.append(e)

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID and self.open[-1].tag == tag:
            self.open.pop()

    def handle_endtag(self, tag: str) -> None:
        self._leave({tag}, frozenset())

    def handle_data(self, data: str) -> None:
        self.open[-1].inside.append(data)


def parse(html: str) -> Element:
    builder = _Builder()
    builder.feed(html)
    builder.close()
    return builder.root

"""Elements of a page as flat lists, with the text that stands directly in each; built to get along with broken markup."""

from __future__ import annotations

import re
from html import unescape

# What the HTML standard says of elements.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style xmp iframe noembed noframes textarea title".split())
UNSEEN = frozenset("head title script style template noscript iframe noembed noframes svg math object canvas audio video select textarea datalist button".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img input".split())
ENDS_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul li dt dd".split()
)
SCOPES = frozenset("html body table caption td th template object".split())
#: Elements whose start ends an open one of these kinds, unless one of the last kinds is between them.
SIBLINGS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select"}),
    "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}),
    "tbody": ({"tbody", "thead", "tfoot"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot"}, {"table"}),
    "body": ({"head"}, set()),
}

TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*+)((?:[\s/]++|[^\s/>=][^\s/>=]*+(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|(?!["'])[^\s>]++))?+|=|["'])*+)>""")
ATTRIBUTE = re.compile(r"""([^\s/>=]++)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>]++)))?+""")
TOLD = re.compile(r"class|id|role|hidden|style", re.I)


class Page:
    """``parent``, ``tag``, ``names`` (class, id and role) and ``hidden`` of each element, parents first; ``runs``: (element, text),
    or (-1, "") where a block begins or ends. Element 0 stands for the whole page."""

    def __init__(self, html: str):
        self.parent, self.tag, self.names, self.hidden = [-1], ["html"], [""], [False]
        self.runs: list[tuple[int, str]] = []
        self._open, self._places = [0], {"html": [0]}
        self._read(html)

    def _read(self, html: str) -> None:
        at, n = 0, len(html)
        while at < n:
            start = html.find("<", at)
            if start != at:
                self._text(html[at : start if start >= 0 else n])
            if start < 0:
                return
            m = TAG.match(html, start)
            if m:
                at = m.end()
                name = m[2].lower()
                if m[1]:
                    self._end(name)
                    continue
                self._start(name, m[3])
                if name in RAW:
                    close = re.compile(f"</{name}(?=[\\s/>])", re.I).search(html, at)
                    inside = html[at : close.start() if close else n]
                    if name in ("title", "textarea"):
                        self._text(inside)
                    at = close.start() if close else n
                    if not close:
                        return
            elif html.startswith("<!--", start):
                if html.startswith(("<!-->", "<!--->"), start):
                    at = html.index(">", start) + 1
                else:
                    end = html.find("-->", start + 4)
                    at = end + 3 if end >= 0 else n
            elif html[start + 1 : start + 2] in ("!", "?", "/"):
                end = html.find(">", start)
                at = end + 1 if end >= 0 else n
            elif html[start + 1 : start + 2].isalpha() and html[start + 1].isascii():
                return  # the page ends within a tag
            else:
                self._text("<")
                at = start + 1

    def _text(self, raw: str) -> None:
        self.runs.append((self._open[-1], unescape(raw) if "&" in raw else raw))

    def _last(self, names) -> int:
        """Highest place of an open element of these kinds, or -1."""
        return max((p[-1] for p in map(self._places.get, names) if p), default=-1)

    def _close(self, place: int) -> None:
        """Ends the elements from a place of the stack upwards."""
        while len(self._open) > place:
            tag = self.tag[self._open.pop()]
            self._places[tag].pop()
            if tag not in INLINE:
                self.runs.append((-1, ""))

    def _start(self, name: str, attributes: str) -> None:
        if name == "html":
            return
        if name in ENDS_P and (p := self._last(("p",))) > self._last(SCOPES):
            self._close(p)
        if name in SIBLINGS:
            own, between = SIBLINGS[name]
            if (p := self._last(own)) > self._last(between):
                self._close(p)
        names, hidden = "", False
        if attributes and TOLD.search(attributes):
            for m in ATTRIBUTE.finditer(attributes):
                key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
                if key in ("class", "id", "role"):
                    names += f" {value}"
                hidden |= key == "hidden" or key == "style" and re.search(r"display\s*:\s*none", value, re.I) is not None
        if name not in INLINE or name == "br":
            self.runs.append((-1, ""))
        if name in VOID:
            return
        self._places.setdefault(name, []).append(len(self._open))
        self.parent.append(self._open[-1])
        self._open.append(len(self.tag))
        self.tag.append(name)
        self.names.append(names)
        self.hidden.append(hidden)

    def _end(self, name: str) -> None:
        place = self._last((name,))
        if place <= 0 or name == "body":
            return
        if name in INLINE:
            if all(self.tag[x] in INLINE for x in self._open[place:]):
                self._close(place)
        elif name in ("table", "html") or place > self._last(("td", "th", "caption")) or name in ("td", "th", "tr", "tbody", "thead", "tfoot", "caption"):
            self._close(place)

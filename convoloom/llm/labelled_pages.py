"""Labelled pages: random pages of many layouts with their main text, from a seed."""

from __future__ import annotations

import random
from html import escape, unescape

# Names that sites give to the parts of a page.
AROUND = {
    "menu": "nav navbar menu main-menu topnav navigation breadcrumb breadcrumbs pagination pager toolbar tabs site-nav toc",
    "header": "header site-header masthead topbar logo branding page-header",
    "footer": "footer site-footer copyright colophon legal bottom-bar footer-links credits",
    "sidebar": "sidebar side-bar aside widget widgets rail right-column related related-posts recommended popular trending secondary",
    "notice": "cookie cookie-banner consent gdpr notice alert popup modal overlay announcement site-message warning-bar newsletter subscribe paywall",
    "advert": "ad ads advert advertisement adsense sponsored sponsor promo promotion banner ad-slot commercial teaser",
    "comments": "comments comment comment-list commentlist responses discussion replies disqus reader-comments user-comments feedback",
    "share": "share share-buttons social social-links follow-us tags post-meta print-links tools",
    "form": "search search-form login signup contact-form subscribe-form comment-form respond form",
}
INSIDE = "content article post entry post-content entry-content article-body story main story-body text body-text main-content page-content article__content"
NEUTRAL = "wrapper container row col-8 inner outer box grid x1 section-2 clearfix site page layout wrap"


class PageMaker:
    """Pages as lists of (markup, whether its text belongs to the main text)."""

    def __init__(self, seed: int):
        self.r = random.Random(seed)
        self.out: list[tuple[str, bool]] = []
        #: A page without names; the share of paragraphs of a few words; whether the article stands in an element of its own.
        self.plain, self.short, self.wrapped = False, 0.0, True

    def words(self, low: int, high: int) -> str:
        r = self.r
        letters = r.choice(["etaoinshrdlu", "etaoinéèçñäöüß", "оеаинтсрвл", "αεοιτνσρ"])
        return " ".join("".join(r.choice(letters) for _ in range(r.choice((1, 2, 3, 4, 5, 6, 7, 9, 12)))) for _ in range(r.randint(low, high)))

    def sentence(self) -> str:
        return self.words(1, 22).capitalize() + self.r.choice("....!?") + self.r.choice(["", "", "", " & <x>"])

    def prose(self, most: int = 6) -> str:
        return " ".join(self.sentence() for _ in range(self.r.randint(1, most)))

    def add(self, markup: str, text: str = "", main: bool = False) -> None:
        self.out.append((markup, False))
        if text:
            self.out.append((escape(text, quote=False), main))

    def box(self, kind: str, tags: tuple[str, ...]) -> str:
        """Opens an element of a part of the page and returns its end."""
        tag = self.r.choice(tags)
        named = "" if self.plain or (tag not in ("div", "p", "span", "ul", "ol", "section", "td") and self.r.random() < 0.5) else self.r.choice(AROUND[kind].split())
        key = self.r.choice(("class", "class", "id"))
        extra = self.r.choice(("", "", " " + self.r.choice(NEUTRAL.split()))) if named else ""
        self.add(f'<{tag} {key}="{named}{extra}">' if named else f"<{tag}>")
        return f"</{tag}>"

    def links(self, n: int, main: bool = False) -> None:
        listed = self.r.random() < 0.7
        if listed:
            self.add("<ul>")
        for _ in range(n):
            self.add("<li>" if listed else "")
            self.add('<a href="/x">', self.words(1, 4), main)
            self.add("</a>" + ("</li>" if listed else self.r.choice((" | ", " ", "\n"))))
        if listed:
            self.add("</ul>")

    def around(self, kind: str) -> None:
        r = self.r
        if kind == "menu":
            end = self.box(kind, ("nav", "div", "ul", "td") if not self.plain else ("nav", "ul", "div"))
            self.links(r.randint(2, 12))
        elif kind == "header":
            end = self.box(kind, ("header", "div"))
            self.add(r.choice(('<a href="/">', "<h2>", "<p>", "<span>")), self.words(1, 5))
            if r.random() < 0.5:
                self.links(r.randint(2, 7))
        elif kind == "footer":
            end = self.box(kind, ("footer", "div", "p") if not self.plain else ("footer",))
            self.add(r.choice(("&copy; ", "", "<p>")), self.words(2, 9) + r.choice(("", ".")))
            if r.random() < 0.4 and end != "</p>":
                self.links(r.randint(2, 8))
            elif r.random() < 0.3 and end != "</p>":
                self.add("<p>", self.prose(2))
        elif kind == "sidebar":
            end = self.box(kind, ("aside", "div", "section") if not self.plain else ("aside",))
            if r.random() < 0.3:
                self.add(r.choice(("", "<p>")), self.prose(3))
            for _ in range(r.randint(1, 3)):
                self.add(r.choice(("<h3>", "<h4>", "<b>")), self.words(1, 4))
                self.add("</h3>")
                if r.random() < 0.6:
                    self.links(r.randint(2, 8))
                else:
                    self.add("<p>", self.prose(2))
                    self.add("</p>")
        elif kind in ("notice", "advert"):
            end = self.box(kind, ("div", "section", "p", "aside"))
            self.add(r.choice(("", "<p>", "<span>") if end != "</p>" else ("", "<span>")), self.prose(3))
            if r.random() < 0.4:
                self.add('<a href="/more">', self.words(1, 3))
                self.add("</a>")
            if r.random() < 0.3:
                self.add("<button>", self.words(1, 2))
                self.add("</button>")
        elif kind == "comments" and r.random() < 0.3:
            end = self.box(kind, ("ul", "ol", "div"))
            for _ in range(r.randint(1, 6)):
                self.add(r.choice(("<li>", "<li>", "<p>")), self.prose(4))
        elif kind == "comments":
            end = self.box(kind, ("div", "section"))
            self.add("<h3>", self.words(1, 3))
            self.add("</h3>")
            for _ in range(r.randint(1, 6)):
                inner = self.box(kind, ("div", "li", "article"))
                self.add(r.choice(("<b>", "<cite>", '<span class="author">')), self.words(1, 2))
                self.add(r.choice(("</b>", "</cite>", "</span>")))
                for _ in range(r.randint(1, 3)):
                    self.add("<p>", self.prose(5))
                    self.add("</p>")
                if r.random() < 0.4:
                    self.add('<a href="#">', self.words(1, 1))
                    self.add("</a>")
                self.add(inner)
        elif kind == "share":
            end = self.box(kind, ("div", "div", "ul"))
            if r.random() < 0.3 and end == "</div>":
                self.add("", self.words(1, 4))
            else:
                self.links(r.randint(2, 5))
        else:
            end = self.box(kind, ("form",) if r.random() < 0.8 or self.plain else ("div",))
            for _ in range(r.randint(1, 4)):
                self.add(r.choice(("<label>", "<p>", "")), self.words(1, 6))
                self.add(r.choice(("<input>", "<textarea>x y</textarea>", "<select><option>one<option>two</select>", "</p>")))
            self.add("<button>", self.words(1, 2))
            self.add("</button>")
        self.add(end + r.choice(("", "\n")))

    def paragraph(self) -> None:
        r = self.r
        kind = r.random()
        if kind < 0.6:
            if r.random() < 0.15:
                self.add("<p><b>", self.prose(8), True)
                self.add("<br>")
                return
            short = r.random() < self.short
            self.add(r.choice(("<p>", "<p>", "<p>", '<p class="first">')), self.words(1, r.choice((2, 6, 12))) if short else self.prose(r.choice((1, 3, 9))), True)
            if short:
                self.add("</p>")
                return
            if r.random() < 0.35:
                tag = r.choice(("b", "i", "em", 'a href="/y"', "strong", "code", "span"))
                self.add(f" <{tag}>", self.words(1, 6), True)
                self.add(f"</{tag.split()[0]}>", " " + self.prose(2), True)
            self.add(r.choice(("</p>", "</p>", "\n")))
        elif kind < 0.7:
            self.add("<h2>" if r.random() < 0.6 else "<h3>", self.words(1, 8), True)
            self.add("</h2></h3>")
        elif kind < 0.78:
            tag = r.choice(("ul", "ol"))
            self.add(f"<{tag}>")
            for _ in range(r.randint(2, 7)):
                self.add("<li>", self.prose(2) if r.random() < 0.6 else self.words(1, 5), True)
            self.add(f"</{tag}>")
        elif kind < 0.84:
            self.add("<blockquote><p>", self.prose(3), True)
            self.add("</p></blockquote>")
        elif kind < 0.88:
            self.add("<table>")
            for _ in range(r.randint(2, 5)):
                self.add("<tr><td>", self.words(1, 4), True)
                self.add("<td>", self.words(1, 3), True)
            self.add("</table>")
        elif kind < 0.92:
            self.add("<figure><img src=x><figcaption>", self.sentence(), True)
            self.add("</figcaption></figure>")
        elif kind < 0.95:
            self.add("<pre>", self.words(3, 20), True)
            self.add("</pre>")
        else:
            self.add("<div>", self.prose(4), True)
            self.add("</div>")

    def article(self) -> None:
        r = self.r
        if r.random() < 0.85:
            head = self.wrapped and r.random() < 0.2
            self.add("<header><h1>" if head else "<h1>", self.words(1, 12), True)
            self.add("</h1></header>" if head else "</h1>")
        self.short = r.choice((0, 0, 0.1, 0.3, 1))
        if self.short:
            self.add("<p>", self.prose(r.choice((3, 9, 20))), True)
        for _ in range(r.choice((1, 2, 4, 8, 16, 40))):
            self.paragraph()
            if r.random() < 0.08 and not self.plain:
                self.around(r.choice(("advert", "share", "sidebar", "sidebar", "notice", "form")))

    def simple(self) -> None:
        """A page with nothing around a little text."""
        r = self.r
        self.plain, self.short = True, 0.3
        self.add(r.choice(("<body>", "", "<html><body>", "<script>var x = '<p>';</script>")))
        for _ in range(r.randint(1, 3)):
            if r.random() < 0.5:
                self.paragraph()
                continue
            self.add("", self.prose(3), True)
            tag = r.choice(("b", "i", "a href=x", "span"))
            self.add(f" <{tag}>", self.words(1, 6), True)
            self.add(f"</{tag.split()[0]}>", " " + self.words(1, 9), True)
            self.add(r.choice(("<br>", "<p>", "\n")))

    def page(self) -> tuple[str, str]:
        """Markup and main text of one page."""
        r, self.out = self.r, []
        if r.random() < 0.1:
            self.simple()
            return self._done()
        self.plain = r.random() < 0.15
        self.add('<!DOCTYPE html><html><head><meta charset="utf-8"><title>', self.words(2, 8))
        self.add('</title><style>p{margin:0}</style><script>var t="</p>";f(1);</script></head><body>' + r.choice(("", '<div class="' + r.choice(NEUTRAL.split()) + '">')))
        for kind in ("notice", "header", "menu", "advert", "form", "sidebar"):
            if r.random() < (0.75 if kind == "menu" else 0.35) and not (self.plain and kind in ("notice", "advert")):
                self.around(kind)
        wrap = r.random()
        named = "" if self.plain or r.random() < 0.2 else f' class="{r.choice(INSIDE.split())}"'
        open_, close = (
            ("<article>", "</article>") if wrap < 0.35 else (f"<article{named}>", "</article>") if wrap < 0.5 else ("<main><article>", "</article></main>") if wrap < 0.58
            else (f"<main{named}>", "</main>") if wrap < 0.66 else (f'<div id="{r.choice(INSIDE.split())}"><div{named}>', "</div></div>") if wrap < 0.75
            else (f"<div{named}>", "</div>") if wrap < 0.87 else (f"<table><tr><td{named}>", "</table>") if wrap < 0.92 else (f"<section{named}>", "</section>") if wrap < 0.97 else ("", "")
        )
        self.add(open_)
        self.wrapped = "article" in open_ or "main" in open_ or "class=" in open_
        self.article()
        if self.wrapped and not self.plain and r.random() < 0.15:
            self.around("comments")
        self.add(close)
        for kind in ("share", "advert", "comments", "form", "sidebar", "notice", "footer"):
            if r.random() < (0.8 if kind == "footer" else 0.3) and not (self.plain and kind not in ("footer", "sidebar", "form")):
                self.around(kind)
        self.add(r.choice(("</body></html>", "", "<!-- end -->")))
        return self._done()

    def _done(self) -> tuple[str, str]:
        text = " ".join(" ".join(t for t, main in self.out if main).split())
        return "".join(t for t, _ in self.out), unescape(text)


def labelled_pages(n: int = 400, seed: int = 1) -> list[tuple[str, str]]:
    """(html, main text) of n random pages; the same for the same seed."""
    maker = PageMaker(seed)
    return [maker.page() for _ in range(n)]

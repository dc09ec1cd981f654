"""Labelled pages to train the extractor on: laid out at random, each text block known to be article or not.

The pages' words are random letters, so nothing but layout, names and the shape of texts can be learnt.
"""

from __future__ import annotations

import html as escaping
import random
import re

_CONTENT_NAMES = ["content", "post", "entry-content", "article-body", "main-content", "story", "text", "post-body", "page"]
_NOISE = {
    "nav": ["menu", "navbar", "nav-links", "breadcrumbs", "pagination", "toc", "navigation", "site-nav"],
    "ad": ["ad", "ads", "advert", "advertisement", "sponsored", "promo", "banner", "ad-slot"],
    "aside": ["sidebar", "widget", "related", "recommended", "popular-posts", "side", "teaser"],
    "notice": ["cookie-notice", "cookies", "consent", "notice", "alert", "gdpr", "popup", "modal", "paywall", "subscribe"],
    "comments": [
        "comments", "comment", "comment-list", "discussion", "replies", "disqus", "reader-comments", "responses", "respond", "feedback", "reactions", "thread",
    ],
    "footer": ["footer", "site-footer", "copyright", "legal", "bottom", "colophon"],
    "header": ["header", "site-header", "masthead", "topbar", "logo", "branding"],
    "form": ["search", "newsletter", "signup", "login", "contact-form", "poll"],
    "share": ["share", "social", "share-buttons", "follow", "tags", "author-box"],
}
_TAGS = {
    "nav": ["nav", "div", "ul"], "ad": ["div", "aside", "section", "ins"], "aside": ["aside", "div", "section"], "notice": ["div", "section", "dialog"],
    "comments": ["section", "div", "ol"], "footer": ["footer", "div"], "header": ["header", "div"], "form": ["form"], "share": ["div", "ul"],
}
# Words of which names are made up.
NAMES = frozenset(t for names in (_CONTENT_NAMES, *_NOISE.values(), ["wrapper", "container", "main"]) for name in names for t in re.findall("[a-z]+", name))
_SCRIPTS = (
    ("абвгдежзийклмнопрстуфхцчшщыьэюя", " ", ".!?", ","), ("αβγδεζηθικλμνξοπρστυφχψω", " ", ".;!", ","), ("ابتثجحخدذرزسشصضطظعغفقكلمنهوي", " ", ".؟!", "،"),
    ("अआइईउऊएऐओऔकखगघचछजझटठडढतथदधन", " ", "।!?", ","), ("日本語文字山川人大小中国学生先月年時間", "", "。！？", "、"),
)


class Page:
    """One page; ``labels`` has true for each article block, in page order."""

    def __init__(self, seed: int) -> None:
        self._r = random.Random(seed)
        latin = ("abcdefghijklmnoprstuvwéüñß", " ", ".!?", ",")
        self._letters, self._gap, self._stops, self._comma = self._r.choice(_SCRIPTS) if self._r.random() < 0.15 else latin
        self.labels: list[bool] = []
        self._out: list[str] = []
        self._lay_out()
        self.html = "".join(self._out)

    def _word(self) -> str:
        return "".join(self._r.choices(self._letters, k=self._r.randint(1, 9 if self._gap else 2)))

    def _words(self, low: int, high: int) -> str:
        words = [self._word() for _ in range(self._r.randint(low, high))]
        return self._gap.join(words)

    def _sentences(self, low: int, high: int) -> str:
        return self._gap.join(
            self._words(1, 14).capitalize() + (self._comma + self._gap + self._words(1, 8) if self._r.random() < 0.3 else "") + self._r.choice(self._stops[0] * 3 + self._stops)
            for _ in range(self._r.randint(low, high))
        )

    def _text(self, tag: str, text: str, label: bool, attributes: str = "") -> None:
        self.labels.append(label)
        text = escaping.escape(text)
        if self._r.random() < 0.2:
            text = self._r.choice(["<b>{}</b>", "<em>{}</em>", "<span>{}</span>", "<b>{}"]).format(text)
        end = "" if tag in ("p", "li") and self._r.random() < 0.2 else f"</{tag}>"
        self._out.append(f"<{tag}{attributes}>{text}{end}")

    def _named(self, kind: str, tag: str) -> str:
        r = self._r.random()
        name = self._r.choice(_NOISE[kind])
        return "" if r < (0.6 if tag in ("nav", "header", "footer", "aside", "form", "dialog") else 0.15) else f' class="{name}"' if r < 0.75 else f' id="{name}"'

    def _links(self, n: int, label: bool) -> None:
        self._out.append("<ul>")
        for _ in range(n):
            self.labels.append(label)
            self._out.append(f'<li><a href="/{self._word()}">{self._words(1, 3)}</a></li>')
        self._out.append("</ul>")

    def _noise(self, kind: str) -> None:
        tag = self._r.choice(_TAGS[kind])
        name = self._named(kind, tag)
        if not name and tag in ("div", "section", "ul", "ol", "ins"):
            name = f' class="{self._r.choice(_NOISE[kind])}"'  # nothing else would tell what it is
        self._out.append(f"<{tag}{name}>")
        if kind == "ad" and tag != "ins" and self._r.random() < 0.4:  # text of the container itself
            self.labels.append(False)
            self._out.append(self._sentences(1, 3))
        if kind in ("nav", "header", "footer", "share") and self._r.random() < 0.7:
            self._links(self._r.randint(2, 8), False)
        if kind == "footer":
            for _ in range(self._r.choice([1, 1, 2, 3])):
                text = self._sentences(1, 3) if self._r.random() < 0.7 else self._words(1, 9)
                text = f"{self._r.choice(['© ', '| ', ''])}{text}" if self._r.random() < 0.6 else text
                inner = self._r.choice(["p", "div", "small", "address", ""])
                if inner in ("", "small") and self.html_ends_in_text():
                    inner = "p"
                if inner:
                    self._text(inner, text, False)
                else:
                    self._bare(text, False)
        elif kind == "header":
            self._text(self._r.choice(["div", "h1", "p"]), self._words(1, 5), False)
        elif kind == "form":
            self._text("label", self._words(1, 4), False)
            self._out.append('<input type="text">')
            self._text("button", self._words(1, 2), False)
        elif kind == "comments":
            if tag != "ol" and self._r.random() < 0.5:
                self._text(self._r.choice(["h2", "h3", "h4"]), self._words(1, 3), False)
            for _ in range(self._r.randint(1, 4)):
                wrapper = self._r.choice(["li", "div", "article"]) if tag != "ol" else "li"
                self._out.append(f"<{wrapper}>")
                self._text(self._r.choice(["p", "div"]), self._sentences(1, 5), False)
                self._out.append(f"</{wrapper}>")
        elif kind in ("aside", "notice", "ad"):
            if self._r.random() < 0.4:
                self._text(self._r.choice(["h3", "h4", "h2"]), self._words(1, 5), False)
            for _ in range(self._r.randint(1, 3)):
                self._text(self._r.choice(["p", "div"]), self._sentences(1, 4), False)
            if kind == "aside" and self._r.random() < 0.5:
                self._links(self._r.randint(2, 6), False)
        self._out.append(f"</{tag}>")

    def _list(self, tag: str) -> None:
        self._out.append(f"<{tag}>")
        for _ in range(self._r.randint(2, 5)):
            self._text("li", self._words(1, 9) if self._r.random() < 0.6 else self._sentences(1, 2), True)
        self._out.append(f"</{tag}>")

    def _terms(self) -> None:
        self._out.append("<dl>")
        for _ in range(self._r.randint(1, 4)):
            self._text("dt", self._words(1, 3), True)
            self._text("dd", self._sentences(1, 2) if self._r.random() < 0.6 else self._words(1, 9), True)
        self._out.append("</dl>")

    def _figure(self) -> None:
        self._out.append('<figure><img src="x">')
        self._text("figcaption", self._sentences(1, 2) if self._r.random() < 0.6 else self._words(2, 9), True)
        self._out.append("</figure>")

    def _table(self) -> None:
        self._out.append("<table>")
        columns = self._r.randint(2, 4)
        if self._r.random() < 0.3:
            self._text("caption", self._words(1, 6), True)
        for row in range(self._r.randint(2, 4)):
            self._out.append("<tr>")
            for _ in range(columns):
                self._text("th" if not row else "td", self._words(1, 3) if self._r.random() < 0.6 else str(self._r.randint(0, 9999)), True)
            self._out.append("</tr>")
        self._out.append("</table>")

    def _bare(self, text: str, label: bool) -> None:
        """Text directly in what is open."""
        self.labels.append(label)
        self._out.append(escaping.escape(text))

    def html_ends_in_text(self) -> bool:
        """Whether more bare text would go on the block before."""
        return bool(self._out) and (not self._out[-1].endswith(">") or self._out[-1].endswith(("</small>", "</b>", "</em>", "</span>")))

    def _broken_lines(self) -> None:
        """Paragraphs parted by line breaks only: one block."""
        self._bare("", True)
        self._out.append("<br><br>".join(escaping.escape(self._sentences(1, 6)) for _ in range(self._r.randint(2, 6))))

    def _article(self) -> None:
        kind = self._r.random()
        opened, closed = "", ""
        if kind < 0.45:
            tag, attributes = "article", self._r.choice(["", "", ' class="post"', ' id="story"'])
            if self._r.random() < 0.25:
                opened, closed = "<main>", "</main>"
        elif kind < 0.60:
            tag, attributes = "main", self._r.choice(["", ' role="main"', ' id="content"'])
        elif kind < 0.80:
            tag, attributes = self._r.choice(["div", "section", "td"]), f' {self._r.choice(["class", "id"])}="{self._r.choice(_CONTENT_NAMES)}"'
        else:
            tag, attributes = self._r.choice(["div", "div", "td"]), ""
        if tag == "td":  # a layout table, perhaps with a menu in a cell of its own
            opened, closed = "<table><tr>", "</tr></table>"
        self._out.append(opened)
        if tag == "td" and self._r.random() < 0.6:
            self._out.append(self._r.choice(["<td>", '<td class="menu">', '<td width="150">']))
            if self._r.random() < 0.5:
                self._links(self._r.randint(2, 8), False)
            else:
                self.labels.append(False)
                self._out.append("<br>".join(f'<a href="/{self._word()}">{self._words(1, 3)}</a>' for _ in range(self._r.randint(2, 8))))
            self._out.append("</td>")
        self._out.append(f"<{tag}{attributes}>")
        paragraph = "div" if tag in ("div", "td") and self._r.random() < 0.4 else "p"
        if tag in ("div", "td") and self._r.random() < 0.35:
            if self._r.random() < 0.6:
                self._text("h1", self._words(1, 12), True)
            self._broken_lines()
            self._out.append(f"</{tag}>{closed}")
            return
        if self._r.random() < 0.9:
            self._text("h1", self._words(1, 12), True)
        inner = self._r.random() < 0.2
        if inner:
            self._out.append(f'<div class="{self._r.choice(_CONTENT_NAMES)}">')
        for _ in range(self._r.randint(1, 12)):
            r = self._r.random()
            if r < 0.65:
                self._text(paragraph, self._sentences(1, self._r.choice([1, 1, 3, 8])), True)
            elif r < 0.73:
                self._text(self._r.choice(["h2", "h3", "h4", "h5", "h6"]), self._words(1, 7), True)
            elif r < 0.80:
                self._list(self._r.choice(["ul", "ol"]))
            elif r < 0.83:
                self._text("blockquote", self._sentences(1, 3), True)
            elif r < 0.85:
                self._text("pre", self._words(2, 12), True)
            elif r < 0.88:
                self._terms()
            elif r < 0.92:
                self._figure()
            elif r < 0.95:
                self._table()
            else:
                self._noise(self._r.choice(["ad", "share", "form", "aside", "notice"]))
        if inner:
            self._out.append("</div>")
        if self._r.random() < 0.15:
            self._noise("comments")
        if self._r.random() < 0.2:
            self._noise("footer")
        self._out.append(f"</{tag}>{closed}")

    def _lay_out(self) -> None:
        self._out.append("<!DOCTYPE html><html><head><title>x</title><script>var a = '<p>';</script></head><body>")
        for kind in ("notice", "header", "nav", "ad", "form"):
            if self._r.random() < (0.8 if kind == "nav" else 0.4):
                self._noise(kind)
        wrapped = self._r.random() < 0.3
        if wrapped:
            self._out.append(self._r.choice(['<div class="wrapper">', '<div id="page">', '<div class="container">']))
        before = self._r.random() < 0.2
        if before:
            self._noise("aside")
        self._article()
        for kind in ("share", "comments", "aside", "ad", "form"):
            if self._r.random() < 0.35:
                self._noise(kind)
        if wrapped:
            self._out.append("</div>")
        if self._r.random() < 0.9:
            self._noise("footer")
        self._out.append("</body></html>")

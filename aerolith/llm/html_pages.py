"""Invented web pages with known main text, of several shapes, on which the block classifier is fitted and held-out pages are tested.

A page is made of parts: menus, page headers, notices, adverts, the article with its own headings, lists, tables, code and captions, related links, forms, sidebars, reader comments
and a footer. A shape says how parts are marked: by HTML's own elements, by class names or ids, by both at random, by nothing but nested boxes or table cells, or there is hardly more than text.
Names of inner sections of articles are drawn from the same words as those of boilerplate, so that a word by itself decides nothing.
"""

from __future__ import annotations

import html
import random

SHAPES = ["semantic", "named", "mixed", "nameless", "table", "bare"]
_SYLLABLES = ["ba", "ren", "ti", "ko", "lus", "mar", "en", "so", "vi", "dal", "qui", "per", "na", "tor", "es", "li", "um", "gra", "fe", "ion"]
#: Names by which parts go.
NAMES = {
    "header": ["header", "site-header", "masthead", "top-bar", "page-header", "banner", "topbar", "site_header"],
    "nav": ["nav", "menu", "main-nav", "navbar", "navigation", "breadcrumbs", "breadcrumb", "site-menu", "mainMenu", "pagination", "pager", "toolbar", "skip-link"],
    "side": ["sidebar", "side", "widget-area", "widget", "aside", "right-column", "rail", "leftSidebar", "sidebar-widget"],
    "footer": ["footer", "site-footer", "page-footer", "bottom", "colophon", "foot", "copyright", "legal", "footerLinks"],
    "comments": ["comments", "comment-list", "responses", "discussion", "disqus", "replies", "comment", "reader-comments", "respond", "user-comments"],
    "ad": ["ad", "ads", "advert", "ad-slot", "sponsored", "promo", "banner-ad", "advertisement", "adsense", "sponsor", "ad-container", "promo-box", "adBox"],
    "notice": ["cookie-notice", "notice", "consent", "alert", "gdpr", "cookie-banner", "cookies", "popup", "modal", "notices", "overlay", "site-notice"],
    "related": ["related", "related-posts", "recommended", "more-links", "you-may-like", "read-more", "relatedArticles", "tags", "tag-list"],
    "share": ["share", "social", "share-links", "sharing", "social-buttons", "toolbar-share"],
    "form": ["newsletter", "subscribe", "signup", "search-form", "login", "subscription", "search", "newsletter-signup", "login-form"],
    "content": ["content", "main-content", "article-body", "post", "entry", "story", "entry-content", "post-body", "text", "article", "main", "articleBody", "page-content", "body-text", "prose"],
}
WRAPPERS = ["page", "wrapper", "has-sidebar", "with-comments", "layout", "container", "site", "search-results-layout", "no-js", "page-with-sidebar", "has-ads", "with-menu", "root", "outer", "nav-open"]
_INNER = ["entry-header", "article-header", "post-header", "post-title", "entry-title", "lead", "intro", "caption", "chapter", "part", "text-block", "summary", "quote", "figure-caption", "post-meta", "section"]
_NOUNS = ["effects", "history", "theory", "analysis", "study", "story", "results", "methods", "economy", "law", "policy", "science"]
_PLACES = ["side", "legal", "comment", "share", "menu", "search", "promo", "social", "alert", "header", "login", "consent", "notice", "banner", "form", "tag"]
_ELEMENTS = {"header": ["header"], "nav": ["nav"], "side": ["aside"], "footer": ["footer"], "comments": ["section"], "ad": ["aside"], "notice": ["dialog", "aside"], "related": ["aside", "nav"], "share": ["menu", "nav"], "form": ["form"], "content": ["article", "main"]}


class _Page:
    def __init__(self, rng: random.Random, shape: str):
        self.rng, self.shape, self.found = rng, shape, []

    def words(self, n: int) -> str:
        return " ".join("".join(self.rng.choices(_SYLLABLES, k=self.rng.randint(1, 4))) for _ in range(n))

    def sentence(self, least: int = 1, most: int = 22) -> str:
        s = self.words(self.rng.randint(least, most))
        return s[0].upper() + s[1:] + self.rng.choice("....?!")

    def prose(self, most: int = 6) -> str:
        return " ".join(self.sentence() for _ in range(self.rng.randint(1, most)))

    def say(self, text: str, content: bool, linked: bool = False) -> str:
        """A run of text, noted down with its label."""
        self.found.append((" ".join(text.split()), content))
        return f'<a href="/x">{html.escape(text)}</a>' if linked else html.escape(text)

    def box(self, role: str, body: str) -> str:
        """body in an element that shows its role as the shape has it."""
        by_element = {"semantic": 0.9, "named": 0.0, "mixed": 0.5}.get(self.shape)
        if by_element is None:
            return f"<div>{body}</div>"
        name = self.rng.choice(NAMES[role])
        key = self.rng.choice(["class", "class", "id"])
        if self.rng.random() < by_element and not (role == "ad" and self.rng.random() < 0.7):
            tag = self.rng.choice(_ELEMENTS[role])
            return f'<{tag} {key}="{name}">{body}</{tag}>' if role == "comments" or self.rng.random() < 0.3 else f"<{tag}>{body}</{tag}>"
        return f'<div {key}="{name}{" " + self.words(1) if key == "class" and self.rng.random() < 0.2 else ""}">{body}</div>'

    def links(self, least: int, most: int) -> str:
        items = [self.say(self.words(self.rng.randint(1, 4)), False, True) for _ in range(self.rng.randint(least, most))]
        return "<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>" if self.rng.random() < 0.8 else "".join(f"<div>{x}</div>" for x in items)

    def menu(self) -> str:
        return self.box("nav", self.links(3, 9))

    def head(self) -> str:
        parts = [f"<div>{self.say(self.words(2), False, self.rng.random() < 0.7)}</div>"]
        if self.rng.random() < 0.5:
            parts.append(f"<p>{self.say(self.sentence(3, 14), False)}</p>")
        if self.rng.random() < 0.4:
            parts.append(self.links(3, 6))
        return self.box("header", "".join(parts))

    def plain(self, role: str, most: int = 3) -> str:
        """Boilerplate in prose, which only its box tells from the article."""
        say = lambda: self.say(self.prose(2), False)
        body = say() if self.rng.random() < 0.4 else "".join(f"<p>{say()}</p>" for _ in range(self.rng.randint(1, most)))
        return self.box(role, body)

    def side(self) -> str:
        parts = []
        for _ in range(self.rng.randint(1, 3)):
            parts.append(f"<h3>{self.say(self.words(2), False)}</h3>")
            parts.append(self.links(2, 6) if self.rng.random() < 0.7 or self.shape in ("nameless", "table") else f"<p>{self.say(self.prose(2), False)}</p>")
        return self.box("side", "".join(parts))

    def form(self) -> str:
        if self.shape not in ("nameless", "table") and self.rng.random() < 0.5:
            return self.box("form", f"<p>{self.say(self.prose(1), False)}</p>")
        inner = f"<label>{self.say(self.words(3), False)}</label><br><select><option>{self.say(self.words(1), False)}</option><option>{self.say(self.words(1), False)}</option></select><button>{self.say(self.words(1), False)}</button>"
        return self.box("form", inner) if self.shape not in ("nameless", "table") else f"<form>{inner}</form>"

    def comments(self) -> str:
        tag = "article" if self.shape in ("semantic", "mixed") and self.rng.random() < 0.4 else "div"
        own = f' class="{self.rng.choice(["comment", "reply", "user-comment"])}"' if self.rng.random() < 0.7 else ""
        return self.box("comments", "".join(f"<{tag}{own}><p>{self.say(self.prose(2), False)}</p></{tag}>" for _ in range(self.rng.randint(1, 5))))

    def foot(self) -> str:
        parts = []
        if self.rng.random() < 0.5:
            parts.append(self.links(2, 6))
        year = f" 20{self.rng.randint(10, 30)} " if self.rng.random() < 0.5 else " "
        named = self.shape not in ("nameless", "table")
        text = self.rng.choice(["©", "©", "(c)", "Copyright", *[""] * named]) + year + self.words(2) + (" · " + self.prose(2) if named and self.rng.random() < 0.5 else "")
        parts.append(self.say(text, False) if self.rng.random() < 0.6 else f"<p>{self.say(text, False)}</p>")
        return self.box("footer", "".join(parts))

    def inside(self) -> str:
        """What is not the article, in the middle of it."""
        kinds = [lambda: self.links(2, 5)] if self.shape in ("nameless", "table") else [lambda: self.plain("ad", 1), lambda: self.box("related", self.links(2, 5)), lambda: self.box("share", self.links(2, 4)), self.form, lambda: self.box("side", f"<p>{self.say(self.prose(2), False)}</p>")]
        return self.rng.choice(kinds)()

    def unit(self) -> str:
        """A piece of the article."""
        say = lambda text: self.say(text, True)
        kind = self.rng.random()
        if kind < 0.55:
            return f"<p>{say(self.prose())}</p>"
        if kind < 0.63:
            return f"<p>{say(self.words(self.rng.randint(1, 3)) + '.')}</p>"
        if kind < 0.73:
            return f"<h{(k := self.rng.randint(2, 4))}>{say(self.words(self.rng.randint(1, 7)))}</h{k}>"
        if kind < 0.81:
            return "<ul>" + "".join(f"<li>{say(self.words(self.rng.randint(1, 14)))}</li>" for _ in range(self.rng.randint(2, 6))) + "</ul>"
        if kind < 0.86:
            return f"<blockquote>{say(self.prose(2))}</blockquote>"
        if kind < 0.9:
            return f"<pre>{say(self.words(self.rng.randint(2, 12)))}</pre>"
        if kind < 0.95:
            return "<table>" + "".join("<tr>" + "".join(f"<td>{say(self.words(self.rng.randint(1, 3)))}</td>" for _ in range(3)) + "</tr>" for _ in range(self.rng.randint(1, 4))) + "</table>"
        return f"<figure><figcaption>{say(self.sentence(2, 10))}</figcaption></figure>"

    def article(self) -> str:
        named = self.shape in ("semantic", "named", "mixed")
        title = f"<h1>{self.say(self.words(self.rng.randint(2, 9)), True)}</h1>"
        if named and self.rng.random() < 0.3:
            title = f"<header>{title}</header>" if self.shape != "named" and self.rng.random() < 0.5 else f'<div class="{self.rng.choice(_INNER[:6])}">{title}</div>'
        parts = [title]
        for _ in range(self.rng.randint(0, 14) if self.rng.random() < 0.6 else self.rng.randint(0, 2)):
            if self.rng.random() < 0.12:
                parts.append(self.inside())
            elif named and self.rng.random() < 0.2:
                tag, name = self.rng.choice(["section", "div"]), self.rng.choice(_INNER) if self.rng.random() < 0.3 else f"{self.rng.choice(_PLACES)}-{self.rng.choice(_NOUNS)}"
                parts.append(f'<{tag} class="{name}">' + "".join(self.unit() for _ in range(self.rng.randint(1, 3))) + f"</{tag}>")
            else:
                parts.append(self.unit())
        return self.box("content", "".join(parts))

    def build(self) -> str:
        r = self.rng.random
        if self.shape == "bare":
            if r() < 0.3:
                return self.say(self.words(self.rng.randint(1, 30)), True)
            return "".join(self.unit() for _ in range(self.rng.randint(1, 5)))
        named = self.shape not in ("nameless", "table")
        before, after = [], []
        for part, chance in ((self.head, 0.5), (self.menu, 0.8), (lambda: self.plain("notice", 2), 0.3 * named), (lambda: self.plain("ad", 2), 0.4 * named), (self.side, 0.25)):
            if r() < chance:
                before.append(part())
        middle = self.article()
        for part, chance in ((lambda: self.box("related", self.links(2, 6)), 0.4), (self.comments, 0.4 * named), (self.form, 0.3), (self.side, 0.4), (lambda: self.plain("notice", 2), 0.15 * named), (self.foot, 0.85)):
            if r() < chance:
                after.append(part())
        if self.shape == "table":
            return "<table>" + "".join(f"<tr><td>{x}</td></tr>" for x in [*before, middle, *after]) + "</table>"
        body = "".join([*before, middle, *after])
        for _ in range(self.rng.randint(0, 2)):
            body = f'<div class="{self.rng.choice(WRAPPERS)}">{body}</div>' if named else f"<div>{body}</div>"
        return body


def page(rng: random.Random, shape: str) -> tuple[str, list[tuple[str, bool]]]:
    """(html, its blocks in order, each with whether it is main text)."""
    p = _Page(rng, shape)
    body = p.build()
    return f"<!DOCTYPE html><html><head><title>{p.words(3)}</title><style>a{{}}</style></head><body>{body}<script>x('<p>')</script></body></html>", p.found


def pages(seed: int, n: int, shapes: list[str] | None = None) -> list[tuple[str, list[tuple[str, bool]]]]:
    """n pages, the shapes in turn."""
    rng = random.Random(seed)
    shapes = shapes or SHAPES
    return [page(rng, shapes[k % len(shapes)]) for k in range(n)]

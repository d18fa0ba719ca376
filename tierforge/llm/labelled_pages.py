"""Labelled web pages to train extraction on, generated from layouts.

Every page is a random layout: site furniture around an article, written with semantic tags or
with divisions named in different ways, sometimes with careless markup. ``MARK`` starts each text that
belongs to the article.
"""

from __future__ import annotations

import random

MARK = "\ue000"

_SYLLABLES = "an er in on st re th nd ou ha es en ti al or de la que ver ung ment tion ea ble ca mo ri".split()
_NAV = ["nav", "menu", "navbar", "main-menu", "top-nav", "site-navigation", "breadcrumbs", "nav-links"]
_HEADER = ["header", "site-header", "masthead", "top-bar", "branding", "page-head"]
_FOOTER = ["footer", "site-footer", "bottom", "footer-links", "copyright", "colophon"]
_SIDE = ["sidebar", "aside", "widget", "side-column", "related", "right-rail", "recommended", "popular-posts"]
_ADS = ["ad", "ads", "advert", "sponsored", "promo", "banner-ad", "ad-slot", "advertisement"]
_NOTICE = ["cookie-notice", "notice", "cookie-banner", "consent", "alert", "gdpr", "popup", "newsletter"]
_COMMENTS = ["comments", "comment-list", "discussion", "responses", "disqus", "reader-comments"]
_SHARE = ["share", "social", "share-buttons", "tags", "byline", "meta", "post-meta"]
_MAIN = ["content", "article", "post", "entry-content", "main", "post-body", "article-body", "story", "text"]
_PLAIN = ["box", "wrap", "container", "row", "col", "inner", "section", "block"]


class _Page:
    def __init__(self, rng: random.Random):
        self.rng = rng

    def words(self, low: int, high: int) -> str:
        rng = self.rng
        words = ["".join(rng.choices(_SYLLABLES, k=rng.randint(1, 4))) for _ in range(rng.randint(low, high))]
        return " ".join(words)

    def sentences(self, low: int, high: int) -> str:
        out = []
        for _ in range(self.rng.randint(low, high)):
            words = self.words(4, 18).capitalize()
            out.append(words.replace(" ", ", ", 1) + "." if self.rng.random() < 0.5 else words + ".")
        text = " ".join(out)
        if self.rng.random() < 0.15:
            marks = ["!!", "***", "$$$", "&amp;&amp;&amp;", "###", "%%%"]
            text = " ".join(w + self.rng.choice(marks) for w in text.split())
        return text.upper() if self.rng.random() < 0.05 else text

    def named(self, names: list[str], semantic: str, inside: str) -> str:
        rng = self.rng
        if rng.random() < 0.5 and semantic:
            return f"<{semantic}>{inside}</{semantic}>"
        attribute = rng.choice(["class", "class", "id"])
        tag = rng.choice(["div", "div", "section", semantic or "div"])
        return f'<{tag} {attribute}="{rng.choice(names)}">{inside}</{tag}>'

    def links(self, low: int, high: int) -> str:
        items = [f'<a href="/{self.words(1, 1)}">{self.words(1, 3)}</a>' for _ in range(self.rng.randint(low, high))]
        if self.rng.random() < 0.7:
            return "<ul>" + "".join(f"<li>{i}</li>" for i in items) + "</ul>"
        return " | ".join(items)

    def furniture(self) -> str:
        rng = self.rng
        kind = rng.randrange(9)
        if kind == 0:
            return self.named(_NAV, "nav", self.links(3, 8))
        if kind == 1:
            return self.named(_HEADER, "header", f"<h1>{self.words(1, 4)}</h1><p>{self.words(3, 9)}</p>" if rng.random() < 0.5 else self.links(2, 5))
        if kind == 2:
            inside = rng.choice([f"<h3>{self.words(1, 3)}</h3>{self.links(2, 6)}", f"<p>{self.sentences(1, 3)}</p>", f"<h4>{self.words(1, 4)}</h4><p>{self.sentences(1, 2)}</p>"])
            return self.named(_SIDE, "aside", inside)
        if kind == 3:
            inside = self.sentences(1, 2)
            return f'<div class="{rng.choice(_ADS)}">' + rng.choice([inside, f"<p>{inside}</p>", f'<a href="/x">{inside}</a>']) + "</div>"
        if kind == 4:
            return f'<div class="{rng.choice(_NOTICE)}"><p>{self.sentences(1, 2)}</p><button>{self.words(1, 2)}</button></div>'
        if kind == 5:
            return f'<form action="/s"><label>{self.words(1, 2)}</label><input name="q"><select><option>{self.words(1, 1)}<option>{self.words(1, 2)}</select><p>{self.words(3, 8)}</p><button>{self.words(1, 2)}</button></form>'
        if kind == 6:
            items = "".join(f'<div class="comment"><b>{self.words(1, 2)}</b><p>{self.sentences(1, 4)}</p></div>' for _ in range(rng.randint(1, 4)))
            return self.named(_COMMENTS, "", f"<h3>{self.words(1, 3)}</h3>{items}")
        if kind == 7:
            return f'<div class="{rng.choice(_SHARE)}">{self.links(2, 4)}</div>'
        return self.footer()

    def footer(self) -> str:
        inside = self.rng.choice([f"&copy; {self.words(2, 5)}", f"&copy; {self.words(1, 2)} &middot; {self.sentences(1, 1)}", self.links(2, 6), f"<p>{self.sentences(1, 2)}</p>"])
        return self.named(_FOOTER, "footer", inside)

    def article(self) -> str:
        rng = self.rng
        out = []
        if rng.random() < 0.8:
            out.append(f"<h1>{MARK}{self.words(2, 9)}</h1>")
        careless = rng.random() < 0.4
        for _ in range(rng.randint(1, 12)):
            kind = rng.random()
            text = MARK + self.sentences(1, 8) if rng.random() < 0.85 else MARK + self.words(1, 4).capitalize() + "."
            if kind < 0.65:
                out.append(f"<p>{text}" + ("" if careless and rng.random() < 0.5 else "</p>"))
            elif kind < 0.75 and careless:
                out.append(f"<p><b>{text}<br>")
            elif kind < 0.8:
                out.append(f"<h2>{MARK}{self.words(2, 6)}</h2><p>{text}</p>")
            elif kind < 0.85:
                items = "".join(f"<li>{MARK}{self.words(3, 12)}</li>" for _ in range(rng.randint(2, 5)))
                out.append(f"<ul>{items}</ul>")
            elif kind < 0.9:
                out.append(f"<blockquote>{text}</blockquote>")
            elif kind < 0.94:
                out.append(f"<table><tr><td>{MARK}{self.words(1, 4)}<td>{MARK}{self.words(1, 4)}</table>")
            else:
                out.append(f'<p>{text} <a href="/y">{self.words(1, 4)}</a> {self.words(2, 6)}.</p>')
            if rng.random() < 0.06:
                out.append(rng.choice([
                    f'<div class="{rng.choice(_ADS)}">{self.sentences(1, 1)}</div>',
                    f'<div class="{rng.choice(_SHARE)}">{self.links(2, 4)}</div>',
                    f"<aside><p>{self.sentences(1, 2)}</p></aside>",
                ]))
        inside = "".join(out)
        kind = rng.random()
        if kind < 0.45:
            inside = f"<article>{inside}</article>"
        elif kind < 0.6:
            inside = f"<main>{inside}</main>"
        elif kind < 0.9:
            inside = f'<div {rng.choice(["class", "id"])}="{rng.choice(_MAIN)}">{inside}</div>'
        return f'<div class="{rng.choice(_PLAIN)}">{inside}</div>' if rng.random() < 0.3 else inside

    def html(self) -> str:
        rng = self.rng
        before = "".join(self.furniture() for _ in range(rng.randint(0, 4)))
        after = "".join(self.furniture() for _ in range(rng.randint(0, 3))) + (self.footer() if rng.random() < 0.7 else "")
        if rng.random() < 0.04:
            return before + after
        body = before + self.article() + after
        body = f'<div class="{rng.choice(_PLAIN)}">{body}</div>' if rng.random() < 0.3 else body
        if rng.random() < 0.1:
            return body
        return f"<!DOCTYPE html><html><head><title>{self.words(2, 6)}</title><style>p{{}}</style></head><body>{body}</body></html>"


def labelled_pages(number: int, seed: int = 11) -> list[str]:
    return [_Page(random.Random(seed * 1_000_003 + i)).html() for i in range(number)]

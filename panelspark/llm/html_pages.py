"""Pages with known main text, made by rule, on which the node classifier is trained.

Layouts, element names and attribute words are drawn from the ways in which
pages are commonly built; a part of the attributes says nothing.
"""

from __future__ import annotations

import random

#: Ends every text that belongs to the main text of a made page.
MARK = "⁣"

# Attribute words by the part of the page.
CLASSES = {
    "content": "article article-body content post post-content entry-content main-content story-body text prose page-content",
    "menu": "nav menu navbar main-menu site-nav breadcrumb breadcrumbs toc pagination",
    "head": "header site-header masthead topbar top banner",
    "foot": "footer site-footer foot bottom copyright legal",
    "side": "sidebar side aside widget-area secondary related related-posts recommended trending",
    "ad": "ad ads advert advertisement sponsored promo promo-box ad-slot banner-ad",
    "notice": "cookie cookie-banner notice consent alert popup modal gdpr newsletter-popup",
    "form": "form login search subscribe newsletter contact-form",
    "comment": "comments comment-list discussion responses reader-comments replies",
    "share": "share social sharing share-buttons follow tags meta",
}
NOISE = "row col col-8 box wrap wrapper inner container block module section c1 x2 left center panel grid unit".split()
_SYLLABLES = "an ar be co da de el en er es fi ha in ka la li lo ma mi na ne no o pa ra re ri ro sa se si ta te ti to tu un va ve vi".split()


class _Maker:
    def __init__(self, seed: int):
        self.r = random.Random(seed)
        self.brief = self.r.random() < 0.25  # a page of few words

    def chance(self, p: float) -> bool:
        return self.r.random() < p

    def word(self) -> str:
        return "".join(self.r.choice(_SYLLABLES) for _ in range(self.r.randint(1, 4)))

    def sentence(self, low: int = 3, high: int = 22) -> str:
        words = [self.word() for _ in range(self.r.randint(1, 5) if self.brief else self.r.randint(low, high))]
        if len(words) > 6 and self.chance(0.6):
            words[len(words) // 2] += ","
        return " ".join(words).capitalize() + "."

    def prose(self, low: int = 1, high: int = 6) -> str:
        return " ".join(self.sentence() for _ in range(self.r.randint(1, 2) if self.brief else self.r.randint(low, high)))

    def title(self) -> str:
        return " ".join(self.word() for _ in range(self.r.randint(1, 9))).capitalize()

    def attrs(self, kind: str, noise: float = 0.3) -> str:
        if self.chance(noise):
            return f' class="{self.r.choice(NOISE)}"' if self.chance(0.7) else ""
        name = self.r.choice(CLASSES[kind].split())
        return f' {self.r.choice(("class", "class", "id"))}="{name}"'

    def links(self, low: int = 3, high: int = 9) -> str:
        items = [f'<a href="/{self.word()}">{self.title() if self.chance(0.4) else self.word()}</a>' for _ in range(self.r.randint(low, high))]
        if self.chance(0.7):
            return "<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>"
        return self.r.choice((" ", " | ", "\n")).join(items)

    def menu(self) -> str:
        return f"<nav{self.attrs('menu', 0.6)}>{self.links()}</nav>" if self.chance(0.6) else f"<div{self.attrs('menu', 0.15)}>{self.links()}</div>"

    def head(self) -> str:
        tag = self.r.choice(("header", "header", "div"))
        name = self.title()
        inner = self.r.choice((f'<a href="/">{name}</a>', f'<div class="logo">{name}</div>', f"<h1>{name}</h1>", f"<p>{name}</p>", name)) + (f"<p>{self.sentence()}</p>" if self.chance(0.4) else "") + (self.menu() if self.chance(0.6) else "")
        return f"<{tag}{self.attrs('head', 0.5 if tag == 'header' else 0.1)}>{inner}</{tag}>"

    def foot(self) -> str:
        tag = self.r.choice(("footer", "footer", "div"))
        text = self.r.choice((f"&copy; {self.word()} &middot; {self.prose(1, 3)}", f"Copyright {self.r.randint(1999, 2025)}.", self.sentence(1, 8), self.prose(1, 3)))
        inner = (f"<p>{text}</p>" if self.chance(0.5) else text) + (self.links() if self.chance(0.4) else "")
        return f"<{tag}{self.attrs('foot', 0.5 if tag == 'footer' else 0.1)}>{inner}</{tag}>"

    def side(self) -> str:
        tag = self.r.choice(("aside", "aside", "div", "section"))
        parts = [f"<h3>{self.title()}</h3>{self.links()}" if self.chance(0.6) else f"<h4>{self.title()}</h4><p>{self.prose(1, 3)}</p>" for _ in range(self.r.randint(1, 3))]
        return f"<{tag}{self.attrs('side', 0.5 if tag == 'aside' else 0.1)}>{''.join(parts)}</{tag}>"

    def pull(self) -> str:
        return f"<aside{self.attrs('side', 0.8)}>{self.sentence() if self.chance(0.5) else f'<p>{self.prose(1, 2)}</p>'}</aside>"

    def ad(self) -> str:
        tag = self.r.choice(("div", "div", "section", "aside", "p"))
        text = self.prose(1, 4) if self.chance(0.7) else f'<a href="#">{self.title()}</a>'
        return f"<{tag}{self.attrs('ad', 0 if tag == 'p' else 0.05)}>{text}</{tag}>"

    def notice(self) -> str:
        tag = self.r.choice(("div", "div", "section", "dialog", "p"))
        text = self.prose(1, 3)
        if tag != "p" and self.chance(0.25):
            text += self.form()
        inner = (f"<p>{text}</p>" if tag != "p" and self.chance(0.6) else text) + (f"<button>{self.word()}</button>" if self.chance(0.5) else "")
        return f"<{tag}{self.attrs('notice', 0 if tag == 'p' else 0.05)}>{inner}</{tag}>"

    def form(self) -> str:
        inner = f"<label>{self.title()}</label><input name=q>" + (f"<p>{self.sentence()}</p>" if self.chance(0.6) else "") + f"<button>{self.word()}</button>"
        return f"<form{self.attrs('form', 0.5)}>{inner}</form>"

    def comments(self) -> str:
        tag, one = self.r.choice((("section", "div"), ("div", "div"), ("ol", "li"), ("div", "article")))
        said = [f'<{one} class="comment"><p>{self.title()}</p><p>{self.prose(1, 4)}</p></{one}>' for _ in range(self.r.randint(1, 6))]
        return f"<{tag}{self.attrs('comment', 0.05)}>{f'<h3>{self.title()}</h3>' if tag != 'ol' and self.chance(0.6) else ''}{''.join(said)}</{tag}>"

    def share(self) -> str:
        return f"<div{self.attrs('share', 0.05)}>{self.links(2, 5)}</div>"

    def body_text(self) -> str:
        """A paragraph of the main text in one of the usual forms."""
        text = self.prose() if self.chance(0.7) else self.sentence(1, 9)
        if self.chance(0.15):
            text = f"<b>{text}</b>" if self.chance(0.5) else f"<b>{text}"
        if self.chance(0.1):
            text += f' <a href="#">{self.title()}</a> {self.sentence()}'
        kind = self.r.random()
        if kind < 0.8:
            return f"<p>{text}{MARK}" + ("</p>" if self.chance(0.85) else "<br>" if self.chance(0.5) else "")
        if kind < 0.86:
            return f"<div>{text}{MARK}</div>"
        if kind < 0.9:
            return f"<blockquote>{text}{MARK}</blockquote>"
        if kind < 0.95:
            return "<ul>" + "".join(f"<li>{self.sentence()}{MARK}</li>" for _ in range(self.r.randint(2, 6))) + "</ul>"
        if kind < 0.97:
            return "<table>" + "".join(f"<tr><td>{self.word()}{MARK}</td><td>{self.sentence(1, 6)}{MARK}</td></tr>" for _ in range(self.r.randint(2, 4))) + "</table>"
        return f"<pre>{text}{MARK}</pre>"

    def article(self) -> str:
        parts = []
        if self.chance(0.9):
            h = f"<h1>{self.title()}{MARK}</h1>"
            parts.append(f"<header>{h}</header>" if self.chance(0.15) else h)
        for _ in range(self.r.choice((1, 1, 1, 2, 2, 3, 4, 6, 9, 14))):
            if self.chance(0.12):
                parts.append(f"<h2>{self.title()}{MARK}</h2>")
            parts.append(self.body_text())
            if self.chance(0.15):
                parts.append(self.r.choice((self.ad, self.share, self.form, self.notice, self.side, self.pull, self.menu))())
        inner = "".join(parts)
        last = self.comments() if self.chance(0.2) else ""
        wrap = self.r.random()
        if wrap < 0.4:
            out = f"<article{self.attrs('content', 0.6)}>{inner}{last}" + ("</article>" if self.chance(0.7) else "")
        elif wrap < 0.5:
            return f"<main><article>{inner}</article>{last}</main>"
        elif wrap < 0.85:
            beside = self.side() if self.chance(0.15) else ""
            out = f"{beside}<{(t := self.r.choice(('div', 'div', 'section', 'main')))}{self.attrs('content', 0.25)}>{inner}{last}</{t}>"
        elif wrap < 0.93:
            out = f"<table><tr><td>{inner}</td></tr></table>{last}"
        else:
            return inner + last
        return f"<div{self.attrs('content', 0.7)}>{out}</div>" if self.chance(0.3) else out

    def page(self) -> str:
        top = [f for f, p in ((self.notice, 0.3), (self.head, 0.5), (self.menu, 0.6), (self.ad, 0.4), (self.form, 0.15)) if self.chance(p)]
        self.r.shuffle(top)
        end = [f for f, p in ((self.share, 0.2), (self.side, 0.4), (self.comments, 0.25), (self.ad, 0.2), (self.form, 0.15), (self.notice, 0.15), (self.foot, 0.8)) if self.chance(p)]
        sides = self.side() if self.chance(0.3) else ""
        inner = "".join(f() for f in top) + sides + self.article() + "".join(f() for f in end)
        if self.chance(0.2):
            inner = f'<div class="{self.r.choice(NOISE)}">{inner}</div>'
        return f"<!DOCTYPE html><html><head><title>{self.title()}</title></head><body>{inner}" + ("</body></html>" if self.chance(0.9) else "")


def made_pages(count: int, seed: int = 11) -> list[str]:
    return [_Maker(seed * 100_003 + i).page() for i in range(count)]

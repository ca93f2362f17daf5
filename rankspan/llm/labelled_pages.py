"""Labelled pages for the page model: many layouts of article and surroundings,
written by rule.  A block of the article carries the attribute ``data-main``."""

from __future__ import annotations

from random import Random

_MAIN = ' data-main="1"'


class _Writer:
    def __init__(self, seed: int):
        self.r = Random(seed)

    def words(self, low: int, high: int) -> str:
        r = self.r
        return " ".join("".join(r.choice("bcdfglmnprstv") + r.choice("aeiou") for _ in range(r.randint(1, 4)))
                        for _ in range(r.randint(low, high)))

    def sentences(self, low: int, high: int) -> str:
        return " ".join(self.words(5, 18).capitalize() + self.r.choice(".....?!") for _ in range(self.r.randint(low, high)))

    def links(self, n: int, tag: str = "li") -> str:
        return "".join(f'<{tag}><a href="/{self.words(1, 1)}">{self.words(1, 3)}</a></{tag}>' for _ in range(n))

    def block(self) -> str:
        r, m = self.r, _MAIN
        kind = r.random()
        if kind < 0.62:
            form = r.random()
            inner = (self.sentences(1, 6) if form < 0.65 else self.words(1, 4).capitalize() + "." if form < 0.75
                     else self.words(1, 8) if form < 0.85 else self.words(8, 80))
            if r.random() < 0.25:
                inner += f' <a href="/x">{self.words(1, 3)}</a> ' + self.sentences(1, 2)
            return f"<p{m}>{inner}" + ("</p>" if r.random() < 0.8 else "")
        if kind < 0.74:
            return f"<h2{m}>{self.words(2, 6)}</h2>"
        if kind < 0.82:
            return f"<ul{m}>" + "".join(f"<li{m}>{self.sentences(1, 1)}</li>" for _ in range(r.randint(2, 4))) + "</ul>"
        if kind < 0.88:
            return f"<blockquote{m}><p{m}>{self.sentences(1, 3)}</p></blockquote>"
        if kind < 0.92:
            return f"<pre{m}>{self.words(5, 20)}</pre>"
        if kind < 0.96:
            return f"<table{m}><tr{m}><td{m}>{self.words(1, 4)}</td><td{m}>{self.words(1, 4)}</td></tr></table>"
        return f'<figure{m}><img src="a.png"><figcaption{m}>{self.words(3, 9)}</figcaption></figure>'

    def inside(self) -> str:
        """Foreign matter that stands between article blocks."""
        return self.r.choice([self.advert, self.share, self.related, self.newsletter, self.notice])()

    def advert(self) -> str:
        name = self.r.choice(["ad", "ads", "advert", "advertisement", "ad-slot", "sponsored", "promo", "banner-ad"])
        tag = self.r.choice(["div", "div", "aside", "section"])
        text = self.sentences(1, 3)
        return f'<{tag} class="{name}">{text if self.r.random() < 0.5 else f"<p>{text}</p>"}</{tag}>'

    def share(self) -> str:
        name = self.r.choice(["share", "social", "share-buttons", "toolbar"])
        return f'<div class="{name}">' + self.links(3, "span") + "</div>"

    def related(self) -> str:
        name = self.r.choice(["related", "recommended", "more-stories", "read-next"])
        return f'<div class="{name}"><h3>{self.words(1, 3)}</h3><ul>' + self.links(4) + "</ul></div>"

    def newsletter(self) -> str:
        return (f'<form action="/s"><p>{self.sentences(1, 2)}</p><label>{self.words(1, 2)}</label><input name="q">'
                f"<button>{self.words(1, 1)}</button></form>")

    def notice(self) -> str:
        name = self.r.choice(["cookie", "cookie-notice", "consent", "notice", "alert", "gdpr-banner", "popup"])
        return f'<div class="{name}"><p>{self.sentences(1, 3)}</p><button>{self.words(1, 1)}</button></div>'

    def comments(self) -> str:
        name = self.r.choice(["comments", "comment-list", "replies", "discussion", "responses"])
        tag = self.r.choice(["div", "section", "ol"])
        one = self.r.choice(["comment", "reply", "comment-body"])
        return (f'<{tag} id="{name}"><h3>{self.words(1, 2)}</h3>' + "".join(
            f'<div class="{one}"><p>{self.sentences(1, 4)}</p></div>' for _ in range(self.r.randint(1, 4))) + f"</{tag}>")

    def header(self) -> str:
        return self.r.choice([
            f"<header><h1>{self.words(1, 3)}</h1><p>{self.words(2, 8)}</p></header>",
            f'<div class="{self.r.choice(["header", "masthead", "site-header", "top-bar"])}"><p>{self.words(2, 6)}</p></div>'])

    def menu(self) -> str:
        links = self.links(self.r.randint(3, 8))
        return self.r.choice([
            f"<nav><ul>{links}</ul></nav>", f'<div class="{self.r.choice(["menu", "nav", "navbar", "breadcrumbs"])}"><ul>{links}</ul></div>',
            f'<ul class="menu" role="navigation">{links}</ul>', f"<nav>{self.links(4, 'span')}</nav>"])

    def sidebar(self) -> str:
        name = self.r.choice(["sidebar", "side", "widget", "secondary", "rail"])
        body = f"<h3>{self.words(1, 3)}</h3><p>{self.sentences(1, 3)}</p><ul>{self.links(4)}</ul>"
        return self.r.choice([f"<aside>{body}</aside>", f'<aside class="{name}">{body}</aside>', f'<div id="{name}">{body}</div>'])

    def footer(self) -> str:
        text = f"&copy; {self.words(1, 2)} &middot; {self.sentences(1, 2)}"
        return self.r.choice([f"<footer>{text}</footer>", f"<footer><p>{text}</p><ul>{self.links(3)}</ul></footer>",
                              f'<div class="{self.r.choice(["footer", "site-footer", "copyright", "legal"])}"><p>{text}</p></div>'])

    def article(self) -> str:
        r = self.r
        head = f"<h1{_MAIN}>{self.words(3, 9)}</h1>" if r.random() < 0.85 else ""
        parts = [self.block() for _ in range(r.choice([1, 1, 2, 2, 3, 4, 6, 9, 16, 30]))]
        for _ in range(r.choice([0, 0, 1, 2])):
            parts.insert(r.randint(0, len(parts)), self.inside())
        tail = self.comments() if r.random() < 0.2 else ""
        body = head + "".join(parts) + tail
        name = r.choice(["content", "post", "entry-content", "article-body", "story", "main-content", "post-text"])
        plain = r.choice(["wrapper", "container", "row", "col", "page"])
        return r.choice([
            f"<article{_MAIN}>{body}</article>", f"<article{_MAIN}>{body}</article>", f"<main{_MAIN}>{body}</main>",
            f"<main><article{_MAIN}>{body}</article></main>", f'<div class="{name}"{_MAIN}>{body}</div>',
            f'<div id="{name}"{_MAIN}>{body}</div>', f'<div class="{plain}"><div class="{name}"{_MAIN}>{body}</div></div>',
            f'<section class="{name}"{_MAIN}>{body}</section>', body, f'<div class="{plain}">{body}</div>'])

    def page(self) -> str:
        r = self.r
        before = [f() for f in (self.header, self.menu, self.notice, self.advert) if r.random() < 0.6]
        after = [f() for f in (self.comments, self.sidebar, self.related, self.newsletter, self.advert, self.footer)
                 if r.random() < 0.5]
        r.shuffle(before)
        if r.random() < 0.3:
            before.append(self.sidebar())
        return f"<html><head><title>{self.words(2, 6)}</title></head><body>{''.join(before)}{self.article()}{''.join(after)}</body></html>"


def labelled_pages(n: int = 250, seed: int = 5) -> list[str]:
    writer = _Writer(seed)
    return [writer.page() for _ in range(n)]

"""Labelled pages to train the block model: a seeded grammar of page layouts.

The given ``pages`` carry no labels, so the layouts are written out here:
where an article may stand, and the menus, headers, notices, adverts,
sidebars, forms, comments and footers around and inside it. Each leaf block
holds a marker that says what it is; the markers go before training. Words
are random letters, so nothing is learnt from a vocabulary.
"""

from __future__ import annotations

import random

from clvspark.llm.dom_blocks import Block, blocks

MAIN, REST = "\u0001", "\u0002"


class _Writer:
    def __init__(self, seed: int) -> None:
        self.r = random.Random(seed)

    def words(self, low: int, high: int, mark: str) -> str:
        r = self.r
        n = r.randint(low, high)
        text = " ".join("".join(r.choice("abcdefghijklmnopqrstuvwxyzäéñß") for _ in range(r.randint(1, 10))) for _ in range(n))
        return mark + text.capitalize()

    def pick(self, *options: str) -> str:
        return self.r.choice(options)

    def some(self, chance: float, make) -> str:
        return make() if self.r.random() < chance else ""

    def sentence(self, mark: str) -> str:
        return self.words(4, 60, mark) + self.pick(".", ".", ".", "", "?")

    def article(self) -> str:
        def one() -> str:
            kind = self.r.random()
            if kind < 0.72:
                text = self.sentence(MAIN)
                return self.pick(f"<p>{text}</p>", f"<p>{text}", f"<p><b>{text}</b></p>", f"<p><b>{text}<br>",
                                 f"<p>{text} <a href='/x'>more of it</a> here.</p>", f'<p class="text">{text}</p>')
            if kind < 0.8:
                return f"<h2>{self.words(1, 6, MAIN)}</h2>"
            if kind < 0.88:
                return "<ul>" + "".join(f"<li>{self.words(1, 12, MAIN)}</li>" for _ in range(self.r.randint(2, 5))) + "</ul>"
            if kind < 0.94:
                return f"<blockquote>{self.sentence(MAIN)}</blockquote>"
            return f"<pre>{self.words(2, 20, MAIN)}</pre>"

        inner = []
        for _ in range(self.r.randint(1, 14)):
            inner.append(one())
            inner.append(self.some(0.06, self.advert))
        title = f"<h1>{self.words(1, 9, MAIN)}</h1>"
        head = self.pick(title, title, title, f"<header>{title}</header>", "")
        tail = self.some(0.25, self.comments) + self.some(0.15, self.share)
        body = head + "".join(inner)
        start, end = self.pick(
            ("<article>", "</article>"), ("<article>", "</article>"), ("<main>", "</main>"), ("<main><article>", "</article></main>"),
            ('<div class="content">', "</div>"), ('<div id="content" class="post-body">', "</div>"),
            ('<section class="article-body">', "</section>"), ('<div role="main">', "</div>"),
            ('<div class="entry-content story">', "</div>"), ('<article class="post">', "</article>"))
        return start + body + (tail + end if self.r.random() < 0.6 else end + tail)

    def menu(self) -> str:
        items = "".join(self.pick(f'<li><a href="/a">{self.words(1, 2, REST)}</a></li>',) for _ in range(self.r.randint(2, 9)))
        return self.pick(f"<nav><ul>{items}</ul></nav>", f'<div class="menu"><ul>{items}</ul></div>',
                         f'<ul id="nav" class="navigation">{items}</ul>', f"<nav>{items}</nav>",
                         f'<div class="breadcrumb breadcrumbs">{items}</div>', f'<div role="navigation">{items}</div>')

    def header(self) -> str:
        inner = f"<h1>{self.words(1, 4, REST)}</h1>" + self.some(0.5, lambda: f"<p>{self.words(2, 9, REST)}</p>")
        return self.pick(f"<header>{inner}</header>", f'<div class="header site-header">{inner}</div>',
                         f'<div id="banner" class="masthead top">{inner}</div>', f'<header role="banner">{inner}</header>')

    def footer(self) -> str:
        text = self.pick(f"{REST}&copy; {self.words(1, 3, '')} &middot; {self.words(2, 20, '')}.", self.sentence(REST),
                         f"{REST}Copyright {self.words(1, 6, '')}")
        links = self.some(0.4, lambda: f'<ul><li><a href="/p">{self.words(1, 2, REST)}</a></li></ul>')
        return self.pick(f"<footer>{text}{links}</footer>", f"<footer><p>{text}</p>{links}</footer>",
                         f'<div class="footer" id="bottom"><p>{text}</p>{links}</div>', f'<div role="contentinfo" class="copyright legal">{text}</div>')

    def advert(self) -> str:
        text = self.sentence(REST)
        return self.pick(f'<div class="ad">{text}</div>', f'<div class="ads advert advertisement"><p>{text}</p></div>',
                         f'<div class="sponsored promo promotion">{text}</div>', f'<aside class="ad">{text}</aside>',
                         f'<p class="sponsor advertising">{text}</p>')

    def notice(self) -> str:
        text = self.sentence(REST)
        return self.pick(f'<div class="notice">{text}</div>', f'<div class="cookie cookies consent banner"><p>{text}</p><button>{self.words(1, 2, REST)}</button></div>',
                         f'<div class="alert message popup modal" role="alert">{text}</div>', f'<div id="cookie-notice">{text}</div>',
                         f'<section class="notice warning"><p>{text}</p></section>')

    def sidebar(self) -> str:
        inner = "".join(f"<h3>{self.words(1, 3, REST)}</h3><p>{self.sentence(REST)}</p>" for _ in range(self.r.randint(1, 3)))
        inner += self.some(0.5, lambda: "<ul>" + f'<li><a href="/r">{self.words(2, 8, REST)}</a></li>' * 3 + "</ul>")
        return self.pick(f"<aside>{inner}</aside>", f'<div class="sidebar">{inner}</div>', f'<div id="sidebar" class="widget widgets">{inner}</div>',
                         f'<section class="related recommended popular">{inner}</section>', f'<aside class="sidebar">{inner}</aside>')

    def form(self) -> str:
        inner = f"<label>{self.words(1, 4, REST)}</label><input><button>{self.words(1, 2, REST)}</button>"
        return self.pick(f"<form>{inner}</form>", f'<form class="search"><p>{self.words(2, 12, REST)}</p>{inner}</form>',
                         f'<div class="newsletter subscribe signup"><p>{self.sentence(REST)}</p><form>{inner}</form></div>',
                         f'<div class="login">{inner}</div>')

    def comments(self) -> str:
        one = lambda: self.pick(
            f'<div class="comment"><p>{self.sentence(REST)}</p></div>', f"<li class='comment'><b>{self.words(1, 2, REST)}</b> <p>{self.sentence(REST)}</p></li>",
            f'<article class="comment reply"><p>{self.sentence(REST)}</p></article>', f"<p>{self.sentence(REST)}</p>")
        inner = f"<h3>{self.words(1, 2, REST)}</h3>" + "".join(one() for _ in range(self.r.randint(1, 6)))
        return self.pick(f'<section class="comments">{inner}</section>', f'<div id="comments">{inner}</div>',
                         f'<div class="comment-list comments discussion responses">{inner}</div>', f'<section id="comments" class="reader-comments">{inner}</section>')

    def share(self) -> str:
        return self.pick(f'<div class="share social">{self.words(1, 6, REST)}</div>', f'<div class="tags meta">{self.words(1, 6, REST)}</div>')

    def page(self) -> str:
        s = self.some
        parts = [s(0.3, self.notice), s(0.45, self.header), s(0.85, self.menu), s(0.3, self.notice), s(0.3, self.form), s(0.5, self.advert)]
        before, after = s(0.25, self.sidebar), s(0.35, self.sidebar)
        end = [after, s(0.2, self.comments), s(0.25, self.form), s(0.3, self.advert), s(0.85, self.footer), s(0.2, self.notice)]
        body = "".join(parts) + before + self.article() + "".join(end)
        body = self.pick(body, body, f'<div id="page" class="wrapper container">{body}</div>', f'<div class="page">{body}</div>')
        return f"<!DOCTYPE html><html><head><title>x</title></head><body>{body}" + self.pick("</body></html>", "")


def labelled_pages(count: int = 400, seed: int = 29) -> list[tuple[list[Block], list[int]]]:
    """Blocks and labels (1 main text) of ``count`` pages."""
    out = []
    for i in range(count):
        found = blocks(_Writer(seed * 100_003 + i).page())
        kept = [(Block(b.text.replace(MAIN, "").replace(REST, "").strip() or "x", b.marks, b.tag, b.linked), int(MAIN in b.text))
                for b in found if MAIN in b.text or REST in b.text]
        out.append(([b for b, _ in kept], [y for _, y in kept]))
    return out

"""Draws labelled pages of many layouts: what an article looks like, and what surrounds it.

Every element says in `data-y` whether its own text belongs to the article.
"""

from __future__ import annotations

import random

# Names that sites give to the parts of a page.
ARTICLE_NAMES = ("article post entry content story main body text blog news page post-content entry-content "
                 "article-body article-content story-body main-content post-body").split()
MENU_NAMES = "nav menu navbar navigation main-menu top-nav breadcrumb breadcrumbs links tabs toc pagination".split()
HEADER_NAMES = "header masthead site-header top banner branding page-header logo".split()
FOOTER_NAMES = "footer site-footer bottom copyright colophon page-footer legal".split()
SIDE_NAMES = "sidebar side aside widget related recommended popular trending more rail secondary tags".split()
NOTICE_NAMES = ("notice cookie cookie-notice cookies consent gdpr banner alert message popup modal newsletter "
                "subscribe paywall warning disclaimer").split()
ADVERT_NAMES = "ad ads advert advertisement sponsored sponsor promo banner-ad ad-slot adsbygoogle".split()
COMMENT_NAMES = "comments comment comment-list reader-comments responses discussion replies disqus reply".split()
FORM_NAMES = "form search search-form login contact signup subscribe newsletter".split()
SHARE_NAMES = "share social social-share sharing buttons follow".split()
SYLLABLES = ("an ar be che de do el en er es fi ga ha in ka la le lo ma mi ne no on or pa que ra re ri sa se so "
             "ta te ti to tu un va ve wi za ße né ón").split()


class _Page:
    def __init__(self, seed: int):
        self.rng = random.Random(seed)
        # texts of all kinds are articles: plain, shouted, without or with many signs, cells in a line
        self.style = self.rng.choice(["plain"] * 3 + ["shout", "bare", "bare", "signs", "bars"])

    def word(self) -> str:
        return "".join(self.rng.choice(SYLLABLES) for _ in range(self.rng.randint(1, 4)))

    def words(self, low: int, high: int, style: str = "plain") -> str:
        words = [self.word() for _ in range(self.rng.randint(low, high))]
        if style == "shout":
            return "!! ".join(words).upper() + "!!"
        if style == "signs":
            return " ".join(w + self.rng.choice(["%%%", "***", "&amp;&amp;", "###", ".", ","]) for w in words)
        if style == "bars":
            return " | ".join(words) + "."
        for i in range(len(words)):
            if self.rng.random() < .12 and style == "plain":
                words[i] += self.rng.choice([",", ".", ".", "!", " &amp;", "?"])
        return " ".join(words).capitalize()

    def tag(self, name: str, label: int, inner: str, names: list[str] | None = None, named: float = .8) -> str:
        attrs = f' data-y="{label}"'
        if names and self.rng.random() < named:
            attrs += f' {self.rng.choice(["class", "class", "id"])}="{self.rng.choice(names)}"'
        return f"<{name}{attrs}>{inner}</{name}>"

    def link(self, low: int = 1, high: int = 3) -> str:
        return f'<a href="/{self.word()}">{self.words(low, high)}</a>'

    def link_list(self, count: int, high: int = 3) -> str:
        return self.tag(self.rng.choice(["ul", "ul", "ol"]), 0, "".join(
            self.tag("li", 0, self.link(1, high)) for _ in range(count)))

    def paragraph(self) -> str:
        inner = self.words(*self.rng.choice([(1, 8), (8, 30), (20, 80), (60, 160), (150, 300)]), self.style)
        if self.rng.random() < .2:
            inner += f" {self.link()} {self.words(2, 12)}"
        if self.rng.random() < .2:
            inner = f"<b>{inner}</b>" if self.rng.random() < .5 else f"<b>{inner}<br>"
        closed = "</p>" if self.rng.random() < .85 else ""
        return f'<p data-y="1">{inner}{closed}'

    def article(self) -> str:
        rng = self.rng
        parts = [self.tag(rng.choice(["h1", "h1", "h2"]), 1, self.words(2, 12, self.style))] if rng.random() < .65 else []
        if rng.random() < .25 and parts:
            parts = [self.tag("header", 1, parts[0])]
        lines = rng.random() < .12  # an article of many short lines
        for _ in range(rng.randint(5, 25) if lines else rng.choice([1, 1, 2, 2, 3, 5, 9, 20, 45])):
            draw = rng.random()
            if lines and draw < .9:
                parts.append(f'<p data-y="1">{self.words(1, 5, self.style)}</p>')
            elif draw < .72:
                parts.append(self.paragraph())
            elif draw < .79:
                parts.append(self.tag(rng.choice(["h2", "h3"]), 1, self.words(1, 8)))
            elif draw < .85:
                parts.append(self.tag(rng.choice(["ul", "ol"]), 1, "".join(
                    self.tag("li", 1, self.words(2, 20)) for _ in range(rng.randint(2, 6)))))
            elif draw < .89:
                parts.append(self.tag("blockquote", 1, self.paragraph()))
            elif draw < .92:
                rows = "".join(self.tag("tr", 1, "".join(
                    self.tag("td", 1, self.words(1, 4)) for _ in range(3))) for _ in range(rng.randint(2, 5)))
                parts.append(self.tag("table", 1, rows))
            elif draw < .95:
                parts.append(self.tag("figure", 1, "<img src='x.png'>" + self.tag("figcaption", 1, self.words(3, 12))))
            elif draw < .97:
                parts.append(self.tag("pre", 1, self.words(4, 30)))
            else:
                parts.append(self.tag("div", 1, self.words(10, 60)))
            if rng.random() < .08:
                parts.append(self.boilerplate(inside=True))
        inner = "".join(parts)
        draw = rng.random()
        if draw < .45:
            inner = self.tag("article", 1, inner, ARTICLE_NAMES, .4)
        elif draw < .6:
            inner = self.tag("main", 1, inner, ARTICLE_NAMES, .4)
        else:
            inner = self.tag(rng.choice(["div", "div", "section"]), 1, inner, ARTICLE_NAMES, .75)
        if rng.random() < .35:
            inner = self.tag(rng.choice(["div", "main", "section"]), 1, inner, [*ARTICLE_NAMES, "wrapper", "container"], .6)
        return inner

    def boilerplate(self, inside: bool = False) -> str:
        rng = self.rng
        kinds = [self.menu, self.side, self.notice, self.advert, self.form, self.share, self.comments]
        return rng.choice(kinds[1:6] if inside else kinds)()

    def menu(self) -> str:
        return self.tag(self.rng.choice(["nav", "nav", "div", "menu", "section"]), 0,
                        self.link_list(self.rng.randint(2, 9)) if self.rng.random() < .75
                        else " | ".join(self.link() for _ in range(self.rng.randint(2, 7))), MENU_NAMES, .7)

    def header(self) -> str:
        inner = self.tag(self.rng.choice(["h1", "h2", "p", "div"]), 0, self.words(1, 6))
        if self.rng.random() < .5:
            inner += self.menu()
        return self.tag(self.rng.choice(["header", "header", "div"]), 0, inner, HEADER_NAMES, .9)

    def footer(self) -> str:
        inner = f"&copy; {self.word()}.example.com &middot; {self.words(2, 25)}"
        if self.rng.random() < .4:
            inner = self.tag("p", 0, inner)
        if self.rng.random() < .4:
            inner += self.link_list(self.rng.randint(2, 5))
        return self.tag(self.rng.choice(["footer", "footer", "div"]), 0, inner, FOOTER_NAMES, .9)

    def side(self) -> str:
        inner = self.tag(self.rng.choice(["h2", "h3", "h4"]), 0, self.words(1, 4)) if self.rng.random() < .7 else ""
        draw = self.rng.random()
        if draw < .5:
            inner += self.link_list(self.rng.randint(2, 6), 8)
        elif draw < .92:
            inner += self.tag("p", 0, self.words(5, 50))
        else:
            inner += "".join(self.tag("article", 0, self.tag("h3", 0, self.link(2, 8)) + self.tag(
                "p", 0, self.words(4, 20)), ["card", "teaser", "related"], .9) for _ in range(self.rng.randint(2, 4)))
        return self.tag(self.rng.choice(["aside", "aside", "div", "section"]), 0, inner, SIDE_NAMES,
                        .95 if draw < .92 else 1)

    def notice(self) -> str:
        inner = self.words(4, 40)
        if self.rng.random() < .6:
            inner = self.tag("p", 0, inner)
        if self.rng.random() < .5:
            inner += self.tag("button", 0, self.words(1, 2))
        return self.tag(self.rng.choice(["div", "div", "section", "aside", "dialog"]), 0, inner, NOTICE_NAMES, 1)

    def advert(self) -> str:
        inner = self.words(2, 40)
        if self.rng.random() < .4:
            inner = self.tag("p", 0, inner)
        if self.rng.random() < .3:
            inner += self.link()
        return self.tag(self.rng.choice(["div", "div", "aside", "section"]), 0, inner, ADVERT_NAMES, 1)

    def form(self) -> str:
        inner = self.tag("label", 0, self.words(1, 4)) + "<input type='text' name='q'>"
        if self.rng.random() < .5:
            inner = self.tag("p", 0, self.words(2, 14)) + inner
        if self.rng.random() < .3:
            inner += "<textarea></textarea><select><option>" + self.word() + "</option></select>"
        return self.tag("form", 0, inner + self.tag("button", 0, self.words(1, 2)), FORM_NAMES, .6)

    def share(self) -> str:
        return self.tag(self.rng.choice(["div", "ul", "p"]), 0,
                        " ".join(self.link(1, 1) for _ in range(self.rng.randint(2, 5))), SHARE_NAMES, .8)

    def comments(self) -> str:
        rng = self.rng
        each = rng.choice(["div", "div", "li", "li", "article", "p", "p"])
        inner = "".join(self.tag(each, 0, (self.tag("b", 0, self.word()) if rng.random() < .5 else "") + (
            self.tag("p", 0, self.words(3, 60)) if each != "p" else self.words(3, 60)), COMMENT_NAMES, .8)
            for _ in range(rng.randint(1, 6)))
        if each == "li":
            inner = self.tag("ol", 0, inner, COMMENT_NAMES, .5)
        if rng.random() < .6:
            inner = self.tag(rng.choice(["h2", "h3"]), 0, self.words(1, 3)) + inner
        if rng.random() < .3:
            inner += self.form()
        return self.tag(rng.choice(["section", "div", "div", "aside"]), 0, inner, COMMENT_NAMES, 1)


def labelled_page(seed: int) -> str:
    """A page with its labels; the same for the same number."""
    page = _Page(seed)
    rng = page.rng
    before = [make() for make, share in ((page.header, .4), (page.menu, .7), (page.notice, .25), (page.advert, .35),
                                         (page.form, .15)) if rng.random() < share]
    after = [make() for make, share in ((page.share, .2), (page.side, .4), (page.advert, .2), (page.comments, .35),
                                        (page.form, .2), (page.notice, .15)) if rng.random() < share]
    rng.shuffle(before)
    rng.shuffle(after)
    if rng.random() < .12:  # nothing but the article
        before, after = [], []
    middle = page.article()
    if rng.random() < .2:  # a column of the layout holds article and more
        middle = page.tag("div", 0, middle + "".join(after), ["wrapper", "container", "row", "layout", "site"], .8)
        after = []
    footer = [page.footer()] if rng.random() < .8 else []
    if rng.random() < .1:  # a fragment
        return "".join(before) + middle + "".join(after) + "".join(footer)
    end = "</body></html>" if rng.random() < .85 else ""
    return (f"<!DOCTYPE html><html><head><title>{page.words(2, 8)}</title><style>p{{margin:0}}</style>"
            f'<script>var t="</p>";</script></head><body data-y="0">'
            + "".join(before) + "<!-- x -->" + middle + "".join(after) + "".join(footer) + end)

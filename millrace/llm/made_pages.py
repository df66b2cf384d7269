"""Invented web pages with known main text, to fit the block labeller on.

A page is a shuffled set of the usual parts around an article. Parts use semantic elements, or plain
ones with telling names, and hold short phrases as well as prose, so that neither length nor wording
alone tells the article. Main text is marked by ``MARK``, a private-use letter.
"""

from __future__ import annotations

import html
import random

import numpy as np

from millrace.llm.blocks import blocks_of, features

MARK = ""

SYLLABLES = (
    "an er on re in th he ea ed ti or st nd ou es en at to it is ha nt al le de ch un la que sch ei ge ver ung ar "
    "os ie ción ado mi ta eau oi ré è ñ ü ö ß pa vi men lo ka su mo ri te no"
).split()
COMMON = "the of and to in is that for was on with as it by la de le et les des que el en los der die und das".split()
PHRASES = {
    "menu": "Home|About us|Contact|News|Products|Services|Blog|Archive|Sitemap|Login|Sign in|Register|My account|Help|FAQ|Shop|Cart|Menu|Search|Forum|Gallery|Events|World|Sport|Business|Culture|Next|Previous|Skip to content|Home page",
    "header": "Welcome|Your daily source of news|Official site|Site header|Free delivery|Call us today|Established long ago|The online magazine|Subscribe now",
    "footer": "All rights reserved|Privacy policy|Terms of use|Imprint|Copyright|Powered by open software|Legal notice|Cookie settings|Back to top|Company information|Follow us",
    "side": "Related articles|Most read|Popular posts|Recent posts|Categories|Tags|Archives|You may also like|Trending|Latest news|Read more|More stories|Recommended|Newsletter|About the author|Links",
    "notice": "This site uses cookies|We use cookies to improve your experience|Accept all|Reject|By using this site you agree to our terms|Your browser is out of date|Please enable scripts|Notice|Important notice|This page was moved|Subscribe to continue|Manage preferences",
    "advert": "Advertisement|Sponsored|Buy now|Special offer|Save today|Click here|Limited time only|Promoted|Ads|Best prices|Order now|Win a prize|Get it free",
    "form": "Your name|Your email|Send|Submit|Search|Password|Subscribe|Leave a reply|Sign up for our newsletter|Choose a country|Required|Reset|Message|Enter your address",
    "comments": "Comments|Leave a comment|Reply|Report|Great article|Thanks for sharing|I agree|I do not agree|says|User comments|Older comments|Log in to comment|First|Nice post|posted by|Reader comments",
    "share": "Share|Tweet|Share on social media|Print|Email this|Save|Like|Share this article",
}
NAMES = {
    "menu": "nav menu navigation navbar topnav main-menu breadcrumb breadcrumbs tabs site-nav links pagination",
    "header": "header masthead top site-header page-header branding logo banner-top title-bar head",
    "footer": "footer site-footer bottom copyright foot page-footer colophon legal imprint",
    "side": "sidebar side aside right left widget related recommended popular teaser more-stories rail secondary sidebar-left",
    "notice": "cookie cookies cookie-banner consent notice alert gdpr popup modal overlay message warning banner info-box",
    "advert": "ad ads advert advertisement sponsored promo banner-ad adsense sponsor ad-box commercial promotion",
    "form": "form search newsletter subscribe signup login search-form contact-form mailing-list",
    "comments": "comments comment-list commentlist comment respond discussion replies user-comments responses disqus",
    "share": "share social sharing social-links share-buttons toolbar",
    "main": "content article post entry main story text body entry-content post-body article-body main-content page single",
}
ELEMENTS = {
    "menu": ["nav"],
    "header": ["header"],
    "footer": ["footer"],
    "side": ["aside"],
    "notice": [],
    "advert": ["aside"],
    "form": ["form"],
    "comments": [],
    "share": [],
    "main": ["article", "main"],
}


class Maker:
    """Draws pages from one random stream."""

    def __init__(self, seed: int):
        self.rng = random.Random(seed)
        self.words = ["".join(self.some(SYLLABLES, self.rng.randrange(1, 5))) for _ in range(3000)]

    def chance(self, p: float) -> bool:
        return self.rng.random() < p

    def one(self, items):
        return self.rng.choice(items)

    def some(self, items, n):
        return self.rng.choices(items, k=n)

    def phrase(self, kind: str) -> str:
        return self.one(PHRASES[kind].split("|"))

    def sentence(self, most: int = 24) -> str:
        words = [self.one(COMMON) if self.chance(0.4) else self.one(self.words) for _ in range(self.rng.randrange(1, most))]
        text = " ".join(words)
        return text[0].upper() + text[1:] + self.one([".", ".", ".", ".", "!", "?", ""])

    def prose(self, most: int = 7) -> str:
        text = " ".join(self.sentence() for _ in range(self.rng.randrange(1, most)))
        style = self.rng.random()
        if style < 0.05:
            text = text.upper().replace(" ", "!! ")
        elif style < 0.13:
            text = " | ".join(text.split())
        elif style < 0.18:
            text = " ".join(w + self.one(["***", "###", "$$$", "%%%"]) for w in text.split())
        elif style < 0.22:
            text = " ".join([self.one(self.words)] * self.rng.randrange(2, 60))
        return text

    def escaped(self, text: str) -> str:
        text = html.escape(text, quote=False)
        return text.replace(" ", self.one(["&nbsp;", "\n  ", " ", " "]), 1) if self.chance(0.2) else text

    def inline(self, text: str) -> str:
        words = self.escaped(text).split(" ")
        if len(words) > 3 and self.chance(0.3):
            at = self.rng.randrange(len(words) - 1)
            tag = self.one(["b", "i", "em", "strong", "a", "span", "code"])
            words[at] = f"<{tag}{' href=/x' if tag == 'a' else ''}>{words[at]}</{tag}>"
        return self.one([" ", " ", "<br>"]).join([" ".join(words)]) if self.chance(0.9) else "<br>".join([" ".join(words[:2]), " ".join(words[2:])])

    def wrapped(self, kind: str, inside: str) -> str:
        """The part in an element that tells what it is."""
        names = NAMES[kind].split()
        if ELEMENTS[kind] and self.chance(0.5):
            tag = self.one(ELEMENTS[kind])
            mark = f' class="{self.one(names)}"' if self.chance(0.3) else ""
        else:
            tag = self.one(["div", "div", "div", "section", "ul" if kind == "menu" else "div"])
            mark = f' {self.one(["class", "class", "id"])}="{self.one(names)}{self.one(["", "", " box", " x1", "-2"])}"'
        if self.chance(0.15):
            inside = f'<div class="{self.one(["inner", "wrap", "container", "row", "col"])}">{inside}</div>'
        return f"<{tag}{mark}>{inside}</{tag}>"

    def link(self, text: str) -> str:
        return f'<a href="/{self.one(self.words)}">{self.escaped(text)}</a>'

    def list_of_links(self, kind: str, most: int = 9) -> str:
        items = [self.link(self.phrase(kind) if self.chance(0.5) else " ".join(self.some(self.words, self.rng.randrange(1, 4)))) for _ in range(self.rng.randrange(1, most))]
        shape = self.rng.random()
        if shape < 0.6:
            return "<ul>" + "".join(f"<li>{i}</li>" for i in items) + "</ul>"
        return self.one([" | ", " ", " &middot; "]).join(items) if shape < 0.8 else "".join(f"<p>{i}</p>" for i in items)

    def part(self, kind: str) -> str:
        """One part that is not main text."""
        if kind == "menu":
            inside = self.list_of_links(kind)
        elif kind == "form":
            fields = [f"<label>{self.phrase(kind)}</label><input name=q>" for _ in range(self.rng.randrange(1, 4))]
            inside = self.one(["", f"<p>{self.phrase(kind)}</p>", f"<p>{self.escaped(self.prose(3))}</p>"]) + "".join(fields)
            inside += self.one([f"<button>{self.phrase(kind)}</button>", f"<select><option>{self.phrase(kind)}<option>{self.one(self.words)}</select>", ""])
            inside = inside if self.chance(0.3) else f"<form action=/s>{inside}</form>"
        elif kind == "comments":
            inside = f"<h{self.one('234')}>{self.phrase(kind)}</h3>" if self.chance(0.6) else ""
            for _ in range(self.rng.randrange(1, 6)):
                said = self.escaped(self.prose(5) if self.chance(0.7) else self.phrase(kind))
                who = self.one(self.words) if self.chance(0.6) else ""
                inside += self.one([f"<div class=comment><b>{who}</b><p>{said}</p></div>", f"<p>{who} {said}</p>", f"<li><cite>{who}</cite> {said}</li>", f"<article class=comment><p>{said}</p></article>"])
        elif kind == "side":
            inside = f"<h{self.one('234')}>{self.phrase(kind)}</h{self.one('234')}>" if self.chance(0.6) else ""
            inside += self.list_of_links(kind) if self.chance(0.5) else "".join(f"<p>{self.escaped(self.prose(4))}</p>" for _ in range(self.rng.randrange(1, 3)))
        else:
            lines = [self.phrase(kind) if self.chance(0.5) else self.prose(3) for _ in range(self.rng.randrange(1, 4))]
            if kind == "header" and self.chance(0.5):
                lines[0] = f"<h1>{self.escaped(lines[0])}</h1>"
            if kind == "footer" and self.chance(0.5):
                lines[0] = f"&copy; {self.one(self.words)}.example &middot; {self.escaped(lines[0])}"
            shape = self.rng.random()
            escaped = [x if "<h1>" in x or "&copy;" in x else self.escaped(x) for x in lines]
            inside = " ".join(escaped) if shape < 0.4 else "".join(f"<p>{x}</p>" for x in escaped) if shape < 0.8 else "".join(f"<div>{x}</div>" for x in escaped)
            if self.chance(0.3):
                inside += self.list_of_links("menu" if kind in ("header", "footer") else kind)
        return self.wrapped(kind, inside)

    def block(self) -> str:
        """One or more blocks of main text."""
        def own(most: int = 7) -> str:
            return MARK + self.inline(self.prose(most))

        kind = self.rng.random()
        if kind < 0.62:
            text = own(9)
            return self.one([f"<p>{text}</p>", f"<p>{text}</p>", f"<p>{text}</p>", f"<p>{text}", f"<div>{text}</div>"])
        if kind < 0.74:
            level = self.one("2234")
            return f"<h{level}>{own(2)}</h{level}>"
        if kind < 0.84:
            items = "".join(f"<li>{own(3)}{self.one(['</li>', ''])}" for _ in range(self.rng.randrange(1, 5)))
            return self.one([f"<ul>{items}</ul>", f"<ol>{items}</ol>"])
        if kind < 0.9:
            return f"<blockquote>{self.one(['<p>', ''])}{own(3)}</blockquote>"
        if kind < 0.94:
            rows = "".join(f"<tr><td>{own(2)}</td><td>{own(2)}</td></tr>" for _ in range(self.rng.randrange(1, 4)))
            return f"<table>{rows}</table>"
        if kind < 0.97:
            return f"<figure><img src=a.png><figcaption>{own(2)}</figcaption></figure>"
        return f"<pre>{own(3)}</pre>"

    def article(self) -> str:
        inside = ""
        if self.chance(0.8):
            title = MARK + self.escaped(self.sentence(12))
            level = self.one("1112")
            inside = f"<h{level}>{title}</h{level}>"
            inside = f"<header>{inside}</header>" if self.chance(0.08) else inside
        most = 12 if self.chance(0.95) else 160
        blocks = [self.block() for _ in range(self.rng.randrange(1, most))]
        if self.chance(0.08):
            blocks = [MARK + self.inline(self.prose())]
        for kind, p in (("advert", 0.15), ("share", 0.15), ("side", 0.1), ("form", 0.07), ("comments", 0.08)):
            if self.chance(p):
                blocks.insert(self.rng.randrange(len(blocks) + 1), self.part(kind))
        inside += "".join(blocks)
        shape = self.rng.random()
        if shape < 0.08:
            return f"<table><tr><td>{self.list_of_links('menu')}</td><td>{inside}</td></tr></table>"
        return inside if shape < 0.14 else self.wrapped("main", inside)

    def page(self) -> str:
        if self.chance(0.05):  # text without any layout
            own = [MARK + self.escaped(self.prose()) for _ in range(self.rng.randrange(1, 5))]
            text = self.one([own[0], "".join(f"<p>{x}</p>" for x in own), "".join(f"<p>{x}" for x in own)])
            return text if self.chance(0.5) else f"<html><body>{text}</body></html>"
        kinds = ["menu", "header", "notice", "advert", "form", "side", "share"]
        before = [self.part(k) for k in kinds if self.chance(0.4)]
        after = [self.part(k) for k in ("side", "advert", "comments", "form", "menu", "notice", "share") if self.chance(0.3)]
        self.rng.shuffle(before)
        self.rng.shuffle(after)
        parts = [*before, self.article(), *after]
        if self.chance(0.75):
            parts.append(self.part("footer"))
        glue = self.one(["", "\n", f"<script>var t='<p>{self.one(self.words)}</p>';</script>", "<!-- x -->", "<hr>"])
        head = f"<html lang=en><head><title>{self.escaped(self.sentence(8))}</title><style>p{{margin:0}}</style></head><body>"
        body = glue.join(parts)
        if self.chance(0.15):
            body = f'<div id="{self.one(["page", "wrapper", "root", "container"])}">{body}</div>'
        return f"<!DOCTYPE html>{head}{body}</body></html>" if self.chance(0.9) else body


def training(pages: int, seed: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Feature rows and marks of that many pages."""
    maker, out = Maker(seed), []
    while len(out) < pages:
        parts = blocks_of(maker.page())
        if parts:
            truth = np.array([MARK in b[0] for b in parts], dtype=np.float32)
            clean = [(b[0].replace(MARK, "") or "-", *b[1:]) for b in parts]
            out.append((features(clean), truth))
    return out

"""Labelled pages for training: varied layouts around an article, with the article's blocks marked.

Sites name the parts of their pages in many ways; the lists below hold the usual ones. A page draws its layout, names and an
invented language, so only structure and the look of the text can be learned. Some regions go without any telling name.
"""

from __future__ import annotations

import random
from collections.abc import Callable

#: Begins the text of a block that belongs to the article.
MARK = "\ue000"

# Elements, and words of class names and ids, that pages use for their parts.
PARTS = {
    "article": (
        "article main div section div",
        "article post content story entry post-content entry-content article-body article-content story-body main-content page-content post-body body-text hentry "
        "rich-text prose markdown-body blog-post single text articleBody",
    ),
    "menu": ("nav nav div ul header", "nav navbar navigation menu main-menu top-menu breadcrumb breadcrumbs pagination pager tabs toolbar links topnav nav-links submenu"),
    "header": ("header header div", "header site-header masthead top-bar branding logo hero topbar head page-header"),
    "footer": ("footer footer div", "footer site-footer copyright colophon legal bottom page-footer foot credits imprint"),
    "sidebar": (
        "aside aside div section",
        "sidebar side widget widgets related recommended popular trending most-read see-also rail tags archive more-stories teaser read-more promo-box secondary",
    ),
    "notice": ("div div section dialog", "cookie cookies cookie-banner consent gdpr notice alert notification popup modal paywall overlay announcement privacy warning message banner"),
    "advert": ("div div aside section ins", "ad ads advert advertisement adsbygoogle sponsored sponsor promo promotion ad-slot ad-container commercial dfp promoted adbox"),
    "form": ("form form div", "form newsletter signup subscribe login search search-form contact-form register subscription mailing-list poll"),
    "share": ("div ul", "share social sharing social-links share-buttons follow post-tags"),
    "comments": ("section div div ol", "comments comment-list commentlist comments-area discussion responses replies user-comments reader-comments disqus_thread talkback thread feedback"),
}
COMMENT = "comment comment-body reply response comment-content comment-text"
LAYOUT = "row col container wrapper inner clearfix block box grid col-md-8 col-sm-4 l-main flex outer layout section-1 m-4 card panel group has-sidebar no-sidebar with-ads no-comments"
BEGINNINGS, ENDINGS = "site js the main c block module", "wrap wrapper inner box area 1 slot unit top block holder container section list body content item text"
SHORT = "Home|About|Contact|Log in|Sign up|News|Sports|Help|Privacy|Terms|Next|Previous|Share|Tweet|More|Menu|Search|Subscribe|Read more|Archive|Site map"
NOTICES = "We use cookies|By continuing you accept|Accept all|Subscribe to our newsletter|Advertisement|All rights reserved|Leave a reply|Enable JavaScript to view this page"


class _Page:
    def __init__(self, seed: int):
        self.rng = random.Random(seed)
        letters = self.rng.choice(["abcdeilmnorstu", "aeinrsthd", "äeiörstnlkm", "éaeoutrsnlç", "абвгдеиклмнорсту", "αβγδεικλμνορστ"])
        self.syllables = ["".join(self.rng.choices(letters, k=self.rng.choice([1, 2, 3]))) for _ in range(60)]
        self.noise = self.rng.choice(["", "", "", "", "###", "&amp;&amp;", " |", "$$", " &middot;", "»"])

    def chance(self, p: float) -> bool:
        return self.rng.random() < p

    def words(self, least: int, most: int) -> str:
        found = ["".join(self.rng.choices(self.syllables, k=self.rng.choice([1, 2, 2, 3]))) for _ in range(self.rng.randint(least, most))]
        if self.noise:
            found = [w + self.noise if self.chance(0.5) else w for w in found]
        return " ".join(found)

    def sentences(self, least: int, most: int) -> str:
        end = lambda: self.rng.choice("....?!")
        return " ".join(self.words(1, 22).capitalize() + end() for _ in range(self.rng.randint(least, most)))

    def opened(self, part: str, named: float = 1.0) -> tuple[str, str]:
        """Start and end of an element for a part of the page."""
        tags, names = (x.split() for x in PARTS[part])
        tag, classes = self.rng.choice(tags), []
        if tag in ("div", "ul", "ol", "ins", "section") and not self.chance(named):
            tag = "div"
        elif tag in ("div", "ul", "ol", "ins", "section", "form") or self.chance(0.4):
            name = self.rng.choice(names)
            more = f"{name}-{self.rng.choice(ENDINGS.split())}"
            classes.append(self.rng.choice([name, name, more, more, more, f"{self.rng.choice(BEGINNINGS.split())}-{name}"]))
        if self.chance(0.3):
            classes.append(self.rng.choice(LAYOUT.split()))
        self.rng.shuffle(classes)
        how = self.rng.choice(["class", "class", "class", "id"])
        mark = f' {how}="{" ".join(classes)}"' if classes else ""
        return f"<{tag}{mark}>", f"</{tag}>"

    def within(self, part: str, inner: str, named: float = 1.0) -> str:
        start, end = self.opened(part, named)
        if self.chance(0.2):
            inner = f"<div class='{self.rng.choice(LAYOUT.split())}'>{inner}</div>"
        return start + inner + end

    def links(self, least: int, most: int) -> str:
        made = [f'<a href="/{k}">{self.rng.choice(SHORT.split("|")) if self.chance(0.4) else self.words(1, 4)}</a>' for k in range(self.rng.randint(least, most))]
        return "<ul>" + "".join(f"<li>{x}</li>" for x in made) + "</ul>" if self.chance(0.7) else self.rng.choice([" | ", " ", " &middot; "]).join(made)

    def aside_text(self) -> str:
        """Text of a notice, advert or teaser: a few short or long pieces, often with a link."""
        tag = self.rng.choice(["p", "div", "span", "p"])
        made = [f"<{tag}>{self.sentences(1, 4) if self.chance(0.7) else self.rng.choice(NOTICES.split('|'))}</{tag}>" for _ in range(self.rng.randint(1, 3))]
        if self.chance(0.4):
            made.append(self.rng.choice(['<a href="#">{}</a>', "<button>{}</button>"]).format(self.rng.choice(SHORT.split("|"))))
        if self.chance(0.3):
            made.insert(0, f"<h3>{self.words(1, 5)}</h3>")
        return "".join(made) if self.chance(0.8) else self.sentences(1, 3)

    def form(self) -> str:
        fields = "".join(f"<label>{self.words(1, 3)}</label><input name=x>" for _ in range(self.rng.randint(1, 3)))
        return self.within("form", f"<p>{self.sentences(1, 2)}</p>{fields}<button>{self.rng.choice(SHORT.split('|'))}</button>")

    def sidebar(self) -> str:
        return self.within("sidebar", f"<h3>{self.words(1, 4)}</h3>" + self.rng.choice([self.links(2, 8), self.aside_text(), self.aside_text() + self.links(1, 4)]))

    def comments(self) -> str:
        each = []
        for _ in range(self.rng.randint(1, 6)):
            tag = self.rng.choice(["div", "li", "article", "div"])
            name = f' class="{self.rng.choice(COMMENT.split())}"' if self.chance(0.8) else ""
            by = f"<span>{self.words(1, 2)}</span> <time>{self.rng.randint(1, 28)}.{self.rng.randint(1, 12)}.2021</time>"
            each.append(f"<{tag}{name}><div>{by}</div><p>{self.sentences(1, 6)}</p></{tag}>")
        return self.within("comments", f"<h3>{self.rng.choice(['Comments', self.words(1, 3)])}</h3>{''.join(each)}{self.form() if self.chance(0.3) else ''}", 1.0)

    def paragraph(self) -> str:
        text = self.sentences(1, self.rng.choice([1, 2, 6, 12]))
        if self.chance(0.3):
            text += f' <a href="/x">{self.words(1, 4)}</a> <em>{self.words(1, 5)}</em>.'
        forms = ["<p>{}</p>", "<p>{}</p>", "<p>{}</p>", "<p>{}", "<p><b>{}<br>", "<div>{}</div>", "{}<br><br>", "<section><p>{}</p></section>"]
        return self.rng.choice(forms).format(MARK + text)

    def body_piece(self) -> str:
        kinds: list[Callable[[], str]] = [
            lambda: f"<{(h := self.rng.choice(['h2', 'h3', 'h4']))}>{MARK}{self.words(1, 9)}</{h}>",
            lambda: "<ul>" + "".join(f"<li>{MARK}{self.words(1, 20)}</li>" for _ in range(self.rng.randint(1, 6))) + "</ul>",
            lambda: f"<blockquote><p>{MARK}{self.sentences(1, 4)}</p></blockquote>",
            lambda: "<table>" + "".join(f"<tr><th>{MARK}{self.words(1, 3)}</th><td>{MARK}{self.rng.randint(0, 9999)}</td></tr>" for _ in range(self.rng.randint(1, 4))) + "</table>",
            lambda: f"<figure><img src=x><figcaption>{MARK}{self.words(3, 15)}</figcaption></figure>",
            lambda: f"<pre>{MARK}{self.words(2, 15)}</pre>",
            lambda: f"<p>{MARK}{self.words(1, 2)}.</p>",
            lambda: f"<p>{MARK}{' | '.join(self.words(1, 1) for _ in range(self.rng.randint(2, 6)))}</p>",
            lambda: f"<p>{MARK}&copy; {self.rng.randint(1, 99)} {self.words(1, 9)}</p>",
            lambda: f'<p>{MARK}<a href="/y">{self.words(1, 9)}</a></p>',
        ]
        return self.rng.choice(kinds)()

    def article(self) -> str:
        pieces = []
        if self.chance(0.9):
            title = f"<h1>{MARK}{self.words(2, 12)}</h1>"
            if self.chance(0.3):
                title += f"<{(t := self.rng.choice(['p', 'div']))}>{MARK}{self.words(1, 3)}, {self.rng.randint(1, 28)}.5.2020</{t}>"
            pieces.append(f"<header>{title}</header>" if self.chance(0.2) else title)
        for _ in range(self.rng.choice([0, 1, 2, 4, 8, 14])):
            pieces.append(self.paragraph() if self.chance(0.75) else self.body_piece())
        for extra in (self.sidebar, self.form, lambda: self.within("advert", self.aside_text()), lambda: self.within("share", self.links(2, 5)), lambda: self.within("notice", self.aside_text())):
            if pieces and self.chance(0.25):
                pieces.insert(self.rng.randint(1, len(pieces)), extra())
        if self.chance(0.12):
            pieces.append(self.comments())
        return self.within("article", "".join(pieces), 0.75)

    def whole(self) -> str:
        top, end = [], []
        if self.chance(0.3):
            top.append(f'<a href="#main">{self.rng.choice(SHORT.split("|"))}</a>')
        if self.chance(0.5):
            top.append(self.within("header", f"<{(h := self.rng.choice(['h1', 'div', 'p', 'h2']))}>{self.words(1, 4)}</{h}>" + (f"<p>{self.words(2, 9)}</p>" if self.chance(0.3) else "")))
        if self.chance(0.8):
            top.append(self.within("menu", self.links(2, 9), 0.8))
        for make in (lambda: self.within("notice", self.aside_text()), lambda: self.within("advert", self.aside_text()), self.form):
            if self.chance(0.3):
                self.rng.choice([top, end]).append(make())
        middle = [self.article()] if self.chance(0.95) else []
        if self.chance(0.4):
            middle.insert(self.rng.choice([0, len(middle)]), self.sidebar())
        if self.chance(0.3):
            middle.append(self.comments())
        if self.chance(0.3):
            middle.append(self.within("advert", self.aside_text()))
        inner = "".join(middle)
        if self.chance(0.4):
            inner = self.rng.choice(['<div class="{}">{}</div>', '<div id="{}">{}</div>', "<main class='{}'>{}</main>"]).format(self.rng.choice([*LAYOUT.split(), "content", "main", "page", "site", "primary"]), inner)
        if self.chance(0.8):
            end.append(self.within("footer", f"<p>&copy; {self.words(1, 4)} {self.rng.choice(NOTICES.split('|'))}</p>" if self.chance(0.5) else f"&copy; {self.words(1, 3)} &middot; {self.sentences(1, 2)}" + (self.links(2, 6) if self.chance(0.4) else ""), 0.85))
        if self.chance(0.2):
            end.append(f"<noscript>{self.rng.choice(NOTICES.split('|'))}</noscript>")
        if self.chance(0.08):  # pages of some frameworks are one form
            top.insert(0, self.rng.choice(['<form action="/">', '<form id="form1">', '<form id="mainForm" class="form">']))
            end.append("</form>")
        return f"<html><head><title>{self.words(2, 9)}</title><style>p{{margin:0}}</style></head><body>{''.join(top)}{inner}{''.join(end)}</body></html>"


def labelled_pages(n: int, seed: int = 0) -> list[str]:
    """``n`` pages; the same ones for the same seed."""
    return [_Page(seed * 1_000_003 + k).whole() for k in range(n)]

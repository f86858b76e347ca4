"""HTML extraction: article text that must stay, and the rules applied one by
one to random pages by another parser."""

from __future__ import annotations

import random
import re
from html.parser import HTMLParser

import pytest

from bucketvote.llm import html_text as HT

ONE = "This is the first of the paragraphs, which has so many words in it that it is good."
TWO = "And here is another one that was put below it, so that the page has two of them to keep."
BODY = f"<p>{ONE}</p><p>{TWO}</p>"


@pytest.mark.parametrize(
    "page",
    [
        f'<div id="content" class="has-sidebar">{BODY}</div>', f'<article class="post has-comments">{BODY}</article>', f'<main title="My hidden life">{BODY}</main>',
        f'<div id=main-content class="sidebar left">{BODY}</div>', f"<main class=sidebar>{BODY}</main>", f'<body class="menu-open">{BODY}',
        f'<article><div title="the hidden town"><p>{ONE}</p></div><p>{TWO}</p></article>', f'<article><div data-id="comment-5"><p>{ONE}</p></div><p>{TWO}</p></article>',
        f'<article><div data-hidden="false"><p>{ONE}</p></div><p>{TWO}</p></article>', f'<article><div class="share-price"><p>{ONE}</p></div><p>{TWO}</p></article>',
        f'<article><div class="post-header"><p>{ONE}</p></div><p>{TWO}</p></article>', f'<article><section id="discussion">{BODY}</section></article>',
        f"<article><svg/><p>{ONE}</p><svg viewBox='0 0 > 1'><text>no</text></svg><p>{TWO}</p></article>", f"<article><svg><p>{ONE}</p><video><p>{TWO}</p></article>",
        f"<div style='color:red' data-style='display:none'>{BODY}</div>", f"<div class='widget'>{BODY}</div>", f"<div class='modal'><article>{BODY}</article></div>",
        f"<article><p>{ONE}</p><template><p>{TWO} x</p></template><p>{TWO}</p></article>",
    ],
)
def test_article_text_stays(page):
    assert HT.main_blocks(page) == [ONE, TWO]


@pytest.mark.parametrize(
    "other",
    [
        '<div class="comment-list">%s</div>', "<div class='cookie-notice big'>%s</div>", '<div id="comment-17">%s</div>', "<section class=comments>%s</section>", "<nav>%s</nav>",
        "<div class=ad-slot>%s</div>", "<div class='site-footer'>%s</div>", "<div role=complementary>%s</div>", "<div hidden>%s</div>", "<div style='Display : none'>%s</div>",
        "<article class='comment'>%s</article>", "<aside>%s</aside>", "<form>%s</form>", '<div aria-hidden="true">%s</div>', "<div class='sidebar'>%s</div>", "<ul class='nav-menu'><li>%s</ul>",
    ],
)
def test_other_containers_go(other):
    for page in (f"<article><p>{ONE}</p>{other % ('<p>' + TWO + '</p>')}</article>", f"<p>{ONE}</p>{other % ('<p>' + TWO + '</p>')}"):
        assert HT.main_blocks(page) == [ONE]


def test_a_language_without_listed_stop_words():
    polish = "Wczoraj wieczorem mieszkańcy miasteczka spotkali się przed ratuszem, żeby porozmawiać o nowym moście, który zostanie zbudowany nad rzeką jeszcze przed końcem przyszłego roku, jeśli tylko wystarczy pieniędzy."
    page = f"<ul><li><a href=x>Strona główna</a></li></ul><h1>Nowy most</h1><p>{polish}</p><p>Koniec.</p><footer>{polish}</footer>"
    assert HT.main_blocks(page) == ["Nowy most", polish, "Koniec."]


# ---- the rules one by one, over another parser --------------------------------------


class Plain(HTMLParser):
    """Blocks of a well-formed page as (text, linked characters, chain of
    containers), each container as (number, tag, attributes)."""

    def __init__(self, page):
        super().__init__()
        self.found, self.chain, self.text, self.linked, self.link, self.numbers, self.skip = [], [], "", 0, 0, 0, ""
        self.feed(page)
        self.cut()

    def cut(self):
        if self.text.split():
            self.found.append((" ".join(self.text.split()), self.linked, list(self.chain)))
        self.text, self.linked = "", 0

    def handle_starttag(self, tag, attrs):
        if tag in ("script", "style"):
            self.skip = tag
        elif tag == "a":
            self.link = 1
        elif tag in HT._BLOCKS:
            self.cut()
            self.link = 0
            if tag in HT._CONTAINERS:
                self.numbers += 1
                self.chain.append((self.numbers, tag, dict(attrs)))

    def handle_endtag(self, tag):
        if tag == self.skip:
            self.skip = ""
        elif tag == "a":
            self.link = 0
        elif tag in HT._BLOCKS:
            self.cut()
            self.link = 0
            if tag in HT._CONTAINERS:
                self.chain.pop()

    def handle_data(self, data):
        if not self.skip:
            self.text += data
            self.linked += len("".join(data.split())) if self.link else 0


def plainly(page: str) -> list[str]:
    rows = []
    for text, linked, chain in Plain(page).found:
        kind, section = "plain", 0
        for number, tag, attrs in chain:
            names = attrs.get("class", "").split() + ([attrs["id"]] if "id" in attrs else [])
            inside = kind == "article"
            if kind == "other":
                break
            if tag in ("nav", "aside", "footer", "form") or tag == "header" and not inside:
                new = "other"
            elif tag in ("article", "main"):
                new = "other" if tag == "article" and "comment" in names else "article"
            elif any(n in ("sidebar", "ad", "comments", "comment-list", "cookie-notice") for n in names) or not inside and any(n in ("related", "share", "site-header") for n in names):
                new = "other"
            else:
                new = "article" if tag in ("div", "section") and any(n in ("content", "story") for n in names) else kind
            if new != kind:
                kind, section = new, number
        rows.append((text, linked, kind, section))
    has = any(r[2] == "article" for r in rows)

    def share(texts):
        words = [w for t in texts for w in t.split()]
        return (sum(w.strip(".,;:!?\"'()").lower() in HT.STOP_WORDS for w in words), len(words))

    stops, words = share([r[0] for r in rows if r[2] == "plain"])
    labels = []
    for text, linked, kind, _ in rows:
        n = len(text.split())
        if kind == "other" or has and kind == "plain" or linked > 0.4 * len(re.sub(r"\s", "", text)):
            labels.append("bad")
        elif n < 10:
            labels.append("open")
        elif kind == "article":
            labels.append("good")
        elif stops < 0.1 * words:
            labels.append("good")
        else:
            own = share([text])[0] / n
            labels.append("good" if own >= 0.25 else "open" if own >= 0.1 or n < 30 else "bad")
    out = []
    for i, (text, _, kind, section) in enumerate(rows):
        label = labels[i]
        if label == "open":
            near = sorted((abs(i - j), labels[j] != "good") for j, r in enumerate(rows) if r[3] == section and (labels[j] == "good" or labels[j] == "bad" and kind != "article"))
            label = ("bad" if near[0][1] else "good") if near else "good" if kind == "article" or not has else "bad"
        if label == "good":
            out.append(text)
    return out


def random_page(rng: random.Random) -> str:
    prose = "the of and in to a is that it was he for on are as with his they at be this from have or by one had not but".split()
    names = "stone river winter carpet engine letter mountain copper garden signal window bridge".split()

    def text(stops):
        n = rng.choice([1, 3, 6, 9, 10, 12, 20, 29, 30, 45])
        return " ".join(rng.choice(prose if rng.random() < stops else names) for _ in range(n))

    def block():
        t = text(rng.choice([0.0, 0.15, 0.4]))
        kind = rng.random()
        if kind < 0.15:
            return f"<li><a href='#'>{t}</a></li>"
        if kind < 0.25:
            return f"<p>{t} <a href=x>{text(0.1)}</a></p>"
        return rng.choice(["<p>%s</p>", "<h2>%s</h2>", "<blockquote>%s</blockquote>", "<p><b>%s</b></p>"]) % t

    def part(depth):
        inner = "".join(block() if depth == 0 or rng.random() < 0.6 else part(depth - 1) for _ in range(rng.randint(1, 5)))
        tag = rng.choice(["div", "div", "section", "article", "nav", "aside", "footer", "ul", "header"])
        name = rng.choice(["", "", " class='sidebar'", " class='content wide'", " id='comments'", " class='related'", " class='x has-ad'", " class='cookie-notice'", " class='comment-list'", " class='story'", " class='share'", " class='site-header'"])
        return f"<{tag}{name if tag in ('div', 'section') else ''}>{inner}</{tag}>"

    return "<script>var a = '<p>no</p>';</script>" + "".join(block() if rng.random() < 0.3 else part(2) for _ in range(rng.randint(1, 5)))


def test_random_pages_by_the_rules():
    rng, several = random.Random(12), 0
    for _ in range(1500):
        page = random_page(rng)
        want = plainly(page)
        if want:  # else class names are disregarded
            several += 1
            assert HT.main_blocks(page) == want, page
    assert several > 1000

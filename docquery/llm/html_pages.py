"""Labelled pages to train on, made from a rule: article blocks are labelled 1, all others 0.

Layouts, wrappers, class names and text lengths vary, so that no single mark
decides: articles have short paragraphs too, and comments or notices long ones.
"""

from __future__ import annotations

import random

_SYLLABLES = "ka lo mi ter san vel dor ing pra ten ou re bel cha ni sto wer lan fi gor".split()
_ARTICLES = ['article', 'article', 'article class="post"', 'main', 'div class="post-content"', 'div id="content"', 'div class="entry-content"', 'section class="article-body"', 'div class="story"']
_OTHERS = {
    "menu": ['nav', 'nav', 'div class="menu"', 'ul class="nav"', 'div id="navigation"', 'div class="breadcrumb"'],
    "header": ['header', 'header', 'header', 'div id="header"', 'div class="masthead"', 'div class="top-bar"'],
    "side": ['aside', 'aside', 'div class="sidebar"', 'div class="widget"', 'div class="related"', 'section class="recommended"'],
    "ad": ['div class="ad"', 'div class="advert"', 'div class="ads-banner"', 'div class="sponsored"', 'div class="promo"'],
    "notice": ['div class="cookie-notice"', 'div class="notice"', 'div class="alert"', 'div id="consent"', 'div class="popup"', 'div role="banner"'],
    "form": ['form', 'form class="search"', 'div class="newsletter"', 'div class="signup"'],
    "comments": ['section class="comments"', 'div id="comments"', 'div class="comment-list"', 'ol class="comments"', 'div class="responses"'],
    "footer": ['footer', 'footer', 'footer', 'footer class="site-footer"', 'div id="footer"', 'div class="copyright"', 'div class="site-info"'],
    "share": ['div class="share"', 'div class="social"', 'div class="tags"', 'div class="pagination"', 'p class="byline"'],
}
_HINTS = {
    "notice": ["We use cookies.", "This site uses cookies to improve your visit.", "Accept all"],
    "form": ["Subscribe to our newsletter", "Search", "Your email", "Sign up", "Login"],
    "footer": ["&copy; 2024", "All rights reserved.", "Privacy policy", "Terms"],
    "share": ["Share", "Follow us", "Next page", "Tags"],
    "comments": ["Reply", "Leave a comment", "3 comments"],
    "ad": ["Advertisement", "Sponsored", "Buy now"],
}


def _words(r: random.Random, low: int, high: int) -> str:
    out = ["".join(r.choice(_SYLLABLES) for _ in range(r.choice((1, 1, 2, 2, 3)))) for _ in range(r.randint(low, high))]
    return " ".join(out).capitalize()


def _sentences(r: random.Random, longest: int) -> str:
    return " ".join(_words(r, 1, 14) + r.choice([".", ".", ".", "!", "?", ","]) for _ in range(r.randint(1, longest)))


def _close(tag: str) -> str:
    return f"</{tag.split()[0]}>"


def _part(r: random.Random, kind: str) -> list[tuple[str, int | None]]:
    """Pieces of HTML; text has a label, tags None."""
    tag = r.choice(_OTHERS[kind])
    out: list[tuple[str, int | None]] = [(f"<{tag}>", None)]
    if kind in ("menu", "side", "share") or (kind in ("header", "footer") and r.random() < 0.4):
        rows = r.randint(2, 7)
        if r.random() < 0.7:
            out.append(("<ul>", None))
        for _ in range(rows):
            out += [("<li><a href='/x'>", None), (_words(r, 1, 5), 0), ("</a></li>", None)]
        if out[1][0] == "<ul>":
            out.append(("</ul>", None))
    else:
        inner = r.choice(["", "", "p", "div", "p"])
        for _ in range(r.randint(1, 4) if kind in ("comments", "notice", "form") else 1):
            text = r.choice(_HINTS.get(kind, [""])) if r.random() < 0.35 else ""
            text = f"{text} {_sentences(r, 6 if kind == 'comments' else 3)}" if r.random() < 0.8 or not text else text
            out += [(f"<{inner}>" if inner else "", None), (text.strip(), 0), (f"</{inner}>" if inner else "<hr>", None)]
    out.append((_close(tag), None))
    return out


def _article(r: random.Random) -> list[tuple[str, int | None]]:
    tag = r.choice(_ARTICLES)
    out: list[tuple[str, int | None]] = [(f"<{tag}>", None)]
    if r.random() < 0.85:
        out += [("<h1>", None), (_words(r, 2, 12), 1), ("</h1>", None)]
    for _ in range(r.randint(1, 12)):
        kind = r.random()
        if kind < 0.78:
            bold = r.random() < 0.15
            out += [("<p>" + "<b>" * bold, None), (_sentences(r, r.choice((1, 1, 3, 8))), 1), ("<br>" if r.random() < 0.1 else "</p>", None)]
        elif kind < 0.84:
            out += [("<h2>", None), (_words(r, 1, 7), 1), ("</h2>", None)]
        elif kind < 0.9:
            out.append(("<ul>", None))
            for _ in range(r.randint(1, 4)):
                out += [("<li>", None), (_sentences(r, 1), 1), ("</li>", None)]
            out.append(("</ul>", None))
        elif kind < 0.94:
            out += [("<blockquote>", None), (_sentences(r, 3), 1), ("</blockquote>", None)]
        else:
            out += _part(r, r.choice(["ad", "share", "side", "form", "comments"]))
    out.append((_close(tag), None))
    return out


def labelled_pages(count: int = 600, seed: int = 3) -> list[tuple[str, list[int]]]:
    """(html, labels of its leaf blocks in order)."""
    r = random.Random(seed)
    out = []
    for _ in range(count):
        pieces: list[tuple[str, int | None]] = [("<html><head><title>", None), (_words(r, 2, 9), 0), ("</title></head><body>", None)]
        before = [k for k in ("header", "menu", "notice", "ad", "form") if r.random() < 0.6]
        after = [k for k in ("share", "comments", "side", "ad", "form", "notice", "footer") if r.random() < 0.5]
        r.shuffle(before)
        for kind in before:
            pieces += _part(r, kind)
        pieces += _article(r)
        for kind in after:
            pieces += _part(r, kind)
        page = "".join(text for text, _ in pieces)
        out.append((page, [label for text, label in pieces if label is not None and text.strip()]))
    return out

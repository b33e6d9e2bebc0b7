"""Small hand-labelled pages: data-main="1" marks the article, "0" what in it is not.

They teach the model the usual names and places of menus, headers, footers,
sidebars, notices, adverts, forms and comments.  The words don't matter, only
structure, length, links and punctuation do.
"""

from __future__ import annotations

import re

_SHORT = "A short sentence of some words."
_MEDIUM = "This sentence runs on for a while, as sentences in an article do, and then it ends."
_LONG = " ".join([_MEDIUM] * 4)
_LINKS = "<ul><li><a href=/a>Home</a></li><li><a href=/b>World news</a></li><li><a href=/c>About us</a></li></ul>"
_BODY = f"<h1>The title of the text</h1><p>{_LONG}</p><p>{_MEDIUM}</p><h2>A part</h2><p>{_SHORT}</p><p>{_LONG}</p>"
_RICH = (
    f"<h1>Another title</h1><p>{_LONG}</p><ul><li>First point of the list.</li><li>Second point, a bit longer than that.</li></ul>"
    f"<blockquote><p>{_MEDIUM}</p></blockquote><figure><figcaption>{_SHORT}</figcaption></figure><pre>code line one</pre>"
    f"<table><tr><th>Name</th><td>12</td></tr></table><p>Yes.</p><p>One <a href=/x>link</a> in a sentence that goes on.</p>"
)
_LISTS = (
    f"<h1>Bread for two</h1><p>{_MEDIUM}</p><ul><li>flour</li><li>two cups of water</li><li>salt</li></ul><p>{_SHORT}</p>"
    f"<ol><li>Mix it</li><li>Let it rest for a while</li></ol><dl><dt>Rest</dt><dd>{_MEDIUM}</dd></dl><p>{_LONG}</p>"
)
_TABLE = (
    f"<h2>Results of the year</h2><p>{_MEDIUM}</p><table><tr><th>Name</th><th>Goals</th></tr><tr><td>Anna</td><td>12</td></tr>"
    f"<tr><td>Berta from the south</td><td>7</td></tr></table><p>{_LONG}</p>"
)
_CODE = f"<h1>How to do it</h1><p>{_LONG}</p><pre>x = 1\ny = x</pre><p>{_SHORT}</p><h3>Then</h3><pre>print(x)</pre><p>{_MEDIUM}</p>"
_DIRECT = f"<h2>A title</h2>{_LONG}<br><br>{_MEDIUM}<p>{_SHORT}</p>{_LONG}"
_DIVS = f"<div>A heading of sorts</div><div>{_LONG}</div><div>{_MEDIUM}</div><p>{_SHORT}</p><div>{_LONG}</div>"
_FEW = f"<h1>Short news</h1><p>{_MEDIUM}</p><p>{_SHORT}</p>"
_FEW_DIVS = f"<div>Some heading</div><div>{_MEDIUM}</div><p>{_SHORT}</p><p>{_MEDIUM}</p>"
_COMMENT = f"<li class=comment><div class=comment-author>Anna</div><p>{_MEDIUM}</p><a href=#>Reply</a></li>"

#: what stands around an article, by common names
_AROUND = {
    "menu": [
        f"<nav>{_LINKS}</nav>",
        f'<div class="menu main-menu">{_LINKS}</div>',
        f'<div id="navbar">{_LINKS}</div>',
        f'<div class="breadcrumb"><a href=/>Home</a> / <a href=/n>News</a></div>',
        f'<ul class="pagination"><li><a href=/2>2</a></li><li><a href=/3>Next</a></li></ul>',
    ],
    "header": [
        f"<header><div>The Daily Page</div><p>{_SHORT}</p></header>",
        f'<div id="header"><p>{_SHORT}</p><a href=/login>Log in</a></div>',
        f'<div class="masthead">{_SHORT}</div>',
        f'<div class="site-header top-bar"><p>{_MEDIUM}</p></div>',
    ],
    "footer": [
        f"<footer>&copy; 2020 The Daily Page &middot; {_MEDIUM}</footer>",
        f'<div id="footer"><p>{_MEDIUM}</p>{_LINKS}</div>',
        f'<div class="site-footer copyright">{_SHORT}</div>',
        f"<footer><p>{_LONG}</p></footer>",
    ],
    "sidebar": [
        f"<aside><h3>Most read</h3>{_LINKS}<p>{_MEDIUM}</p></aside>",
        f'<div class="sidebar"><h3>Related</h3><p>{_MEDIUM}</p></div>',
        f'<div id="related-posts"><h4>More</h4><ul><li><a href=/y>Some other text that you may like</a></li></ul></div>',
        f'<div class="widget"><p>{_LONG}</p></div>',
    ],
    "notice": [
        f'<div class="cookie-notice"><p>{_MEDIUM}</p><button>Accept</button></div>',
        f'<div id="consent" role="dialog"><p>{_LONG}</p></div>',
        f'<div class="alert">{_SHORT}</div>',
        f'<div class="newsletter subscribe"><p>{_MEDIUM}</p></div>',
    ],
    "advert": [
        f'<div class="ad">{_MEDIUM}</div>',
        f'<div class="advert banner"><p>{_SHORT}</p></div>',
        f'<div id="sponsored"><p>{_LONG}</p></div>',
        f'<section class="promo"><p>{_MEDIUM}</p></section>',
    ],
    "form": [
        f"<form><label>Name</label><select><option>One</option><option>Two</option></select><button>Send</button><p>{_MEDIUM}</p></form>",
        f'<div class="search-form"><form><p>{_SHORT}</p><button>Go</button></form></div>',
        f'<div class="login"><p>{_SHORT}</p></div>',
    ],
    "comments": [
        f'<section id="comments"><h3>2 comments</h3><ol>{_COMMENT}{_COMMENT}</ol></section>',
        f'<div class="comments"><div class="comment"><p>{_LONG}</p></div><div class="reply"><p>{_MEDIUM}</p></div></div>',
        f'<div class="disqus responses"><p>{_MEDIUM}</p></div>',
    ],
    "share": [
        f'<div class="share social"><a href=#>Share this</a> <a href=#>Send</a></div>',
    ],
}

#: surroundings without names
_PLAIN_BEFORE = [
    f"<div>{_LINKS}</div>",
    "<p><a href=/>Home</a> | <a href=/n>News</a> | <a href=/s>Sports today</a></p>",
    "<table><tr><td><a href=/>Home</a></td><td><a href=/n>News</a></td></tr></table>",
    f"<div><div>The Daily Page</div>{_LINKS}</div>",
    "<div><a href=/>Home</a></div>",
]
_PLAIN_AFTER = [
    "<div>&copy; 2020 The Daily Page</div>",
    f"<div>{_LINKS}</div><div>&copy; 2021 Some Press <a href=/p>Privacy</a></div>",
    f"<form><div>Your name</div><button>Send</button></form><p>&copy; The Page</p>",
    f"<div><h3>More</h3>{_LINKS}</div>",
    "<p><a href=/p>Privacy</a> <a href=/t>Terms</a></p>",
]

#: ways to mark an article
_FRAMES = [
    "<article data-main=1>{}</article>",
    "<main><article data-main=1>{}</article></main>",
    '<div id="content"><div class="post" data-main=1>{}</div></div>',
    '<div class="page"><div class="article-body" data-main=1>{}</div></div>',
    '<main data-main=1>{}</main>',
    '<div class="wrapper"><div class="entry-content" data-main=1>{}</div></div>',
    '<div><div data-main=1>{}</div></div>',
    '<section class="story" data-main=1>{}</section>',
]
#: ways without names
_PLAIN_FRAMES = [
    '<div class="x1" data-main=1>{}</div>',
    "<div><div><div data-main=1>{}</div></div></div>",
    "<table><tr><td data-main=1>{}</td></tr></table>",
    "<section data-main=1>{}</section>",
    "{}",
]
_TOP = re.compile(r"<(h1|h2|p|div|ul|ol|dl|pre|table|blockquote|figure)>")

_BEFORE, _AFTER = ("menu", "header", "notice", "advert"), ("sidebar", "comments", "form", "advert", "share", "footer")


def _page(frame: str, inner: str, k: int, inside: bool) -> str:
    pick = lambda kind, i: _AROUND[kind][i % len(_AROUND[kind])]
    before = "".join(pick(kind, k + i) for i, kind in enumerate(_BEFORE))
    after = "".join(pick(kind, k + i) for i, kind in enumerate(_AFTER))
    if inside:  # an advert, share links, a sidebar, comments or a form in the article itself
        kind = ("advert", "share", "sidebar", "comments", "form", "notice", "menu", "footer")[k % 8]
        cut = inner.index("</p>") + 4
        extra = pick(kind, k // 2)
        extra = extra.replace(">", " data-main=0>", 1)
        inner = inner[:cut] + extra + inner[cut:]
    return f"<html><head><title>T</title></head><body>{before}{frame.format(inner)}{after}</body></html>"


def _plain_page(frame: str, inner: str, k: int) -> str:
    if frame == "{}":  # right in the body: every block is marked, and direct text gets a paragraph
        inner = _TOP.sub(r"<\1 data-main=1>", inner.replace("<br><br>", "<p>").replace(f"</h2>{_LONG}", f"</h2><p>{_LONG}</p>"))
        inner = inner.replace(f"</p>{_LONG}", f"</p><p data-main=1>{_LONG}</p>")
    before, after = _PLAIN_BEFORE[k % len(_PLAIN_BEFORE)], _PLAIN_AFTER[k // 2 % len(_PLAIN_AFTER)]
    return f"<html><head><title>T</title></head><body>{before}{frame.format(inner)}{after}</body></html>"


def pages() -> list[str]:
    """Every frame with every body, with and without a foreign part inside, the surroundings in turn."""
    out = []
    for i, frame in enumerate(_FRAMES):
        for j, inner in enumerate((_BODY, _RICH)):
            for inside in (False, True):
                out.append(_page(frame, inner, 3 * i + 2 * j + inside, inside))
        for j, inner in enumerate((_LISTS, _TABLE, _CODE, _DIRECT, _DIVS, _FEW)):
            if (i + j) % 2 == 0:
                out.append(_page(frame, inner, 5 * i + j, False))
    for i, frame in enumerate(_PLAIN_FRAMES):
        for j, inner in enumerate((_BODY, _RICH, _LISTS, _TABLE, _CODE, _DIRECT, _DIVS, _FEW, _FEW_DIVS)):
            out.append(_plain_page(frame, inner, 2 * i + 3 * j))
    for k in range(len(_PLAIN_BEFORE)):
        out += [_plain_page("{}", inner, k) for inner in (_FEW, _FEW_DIVS, _DIVS)]
    return out

"""Labelled pages that teach what main text is.

``{n}`` stands for n words of filler. Blocks that begin with the mark are main text, all others are
not. The pages vary in what their markup says: regions by tag, by class, by role, or not at all.

Where markup names the regions, the label of a block does not depend on how long it and its neighbours
are, nor on where the page ends; ``table`` adds such pages again with other counts and cut short.
"""

from __future__ import annotations

import random
import re

MARK = "§"
_FILLER = """the river carried small boats past old mills where people traded grain for cloth and salt while
    children watched from stone steps that led down to slow green water under tall trees""".split()
_COUNT = re.compile(r"\{(\d+)\}")


def expand(page: str) -> str:
    """The page with filler words in place of the counts; the mark keeps to its first word."""
    text = _COUNT.sub(lambda m: " ".join(_FILLER[i % len(_FILLER)] for i in range(int(m[1]))), page)
    return text.replace(MARK + " ", MARK)


LENGTHS = (1, 2, 3, 5, 8, 13, 21, 34, 55, 89)
VARIANTS = 6


def table() -> list[str]:
    """All labelled pages, written out."""
    pages = [*MARKED, *PLAIN]
    for i, page in enumerate(MARKED):
        draw = random.Random(i)
        for k in range(VARIANTS):
            other = _COUNT.sub(lambda m: "{%d}" % draw.choice(LENGTHS), page)
            # Up to the end of the last block that is main text.
            cut = other.index("}", other.rindex(MARK)) + 1
            pages.append(other[:cut] if k % 2 else other)
    return [expand(p) for p in pages]


MARKED = [
    # Regions by tag.
    """<header><a href=/>{1}</a><p>{5}</p></header><nav><ul><li><a href=/a>{1}</a></li><li><a href=/b>{2}</a></li>
    <li><a href=/c>{1}</a></li></ul></nav><article><h1>§{6}</h1><p>§{40}</p><p>§{3}</p><p>§{1}</p><h2>§{2}</h2>
    <p>§{70}</p><ul><li>§{4}</li><li>§{2}</li></ul><blockquote>§{20}</blockquote></article>
    <aside><h3>{2}</h3><p>{25}</p></aside><footer>&copy; {4}</footer>""",
    """<nav><a href=/a>{1}</a> <a href=/b>{1}</a></nav><div class=ad>{8}</div><article><h1>§{9}</h1><p>§{1}</p>
    <p>§{2}</p><p>§{30}</p><p>§{120}</p></article><footer>&copy; {2} &middot; {9}</footer>""",
    """<nav><ul><li><a href=/x>{1}</a></li></ul></nav><div class="ad">{14}</div><article><h1>§{1}</h1>
    <p>§{1}</p></article><footer>{12}</footer>""",
    """<div class="ad">{40}</div><main><h1>§{5}</h1><p>§{11}</p><p>§{8} <a href=/r>{12}</a></p><p>§{60}</p>
    <p><a href=/s>§{4}</a></p></main><aside><ul><li><a href=/t>{6}</a></li><li><a href=/u>{7}</a></li></ul>
    <p>{30}</p></aside><footer><p>{25}</p></footer>""",
    """<main><article><header><h1>§{7}</h1><p class=byline>{4}</p></header><p>§{35}</p><aside class=related>
    <h3>{2}</h3><a href=/q>{8}</a></aside><p>§{28}</p><p>§{2}</p><footer>{6}</footer></article>
    <section class=comments><h2>{2}</h2><article class=comment><p>{18}</p></article><article><p>{33}</p></article>
    <article><h3>{2}</h3><p>{5}</p></article></section></main>""",
    """<article><h1>§{4}</h1><p>§{22}</p><table><tr><td>§{2}</td><td>§{1}</td></tr><tr><td>§{3}</td><td>§{1}</td></tr>
    </table><pre>§{15}</pre><dl><dt>§{1}</dt><dd>§{9}</dd></dl><figure><figcaption>§{8}</figcaption></figure>
    <form><label>{3}</label><p>{9}</p></form><div class="share">{3}</div><div class="newsletter-signup"><p>{15}</p>
    </div></article><dialog><p>{20}</p></dialog>""",
    """<article><p>§{4}</p><p>§{28}</p><p>§{2} <a href=/a>{1}</a></p><p>§{40}</p><p>§{3}</p></article>""",
    """<div class=ad>{9}</div><article><h1>§{3}</h1><p>§{2}</p></article>""",
    """<nav><ul><li><a href=/a>{30}</a></li></ul></nav><main><p>§{5}</p><p>§{2}</p><p>§{90}</p><p>§{1}</p></main>""",
    """<nav><a href=/a>{3}</a></nav><article><ul><li><a href=/b>§{3}</a></li><li><a href=/c>§{5}</a></li><li>§{2}</li></ul>
    <p>§{12}</p><p><a href=/d>§{16}</a></p><p>§{1}</p></article><nav><a href=/e>{26}</a></nav>""",
    """<article><h1>§{2}</h1><p>§{7}</p></article><aside>{50}</aside><aside><p>{3}</p></aside><footer><p>{60}</p><p>{1}</p></footer>""",
    """<header><h1>{3}</h1><h2>{6}</h2><p>{40}</p></header><main><h2>§{3}</h2><p>§{7}</p><p>§{9}</p></main><form><p>{30}</p></form>""",
    """<article><p>§{70}</p><p>§{6}</p></article><section class="comments"><h3>{4}</h3><p>{70}</p><p>{3}</p></section>""",
    """<main><h1>§{6}</h1><p>§{18}</p></main><div id=disqus><article><p>{50}</p><p>{6}</p></article><article><p>{12}</p></article></div>""",
    # Text about cookies and subscriptions is still text.
    """<header>{3}</header><article><h1>§How cookies {3}</h1><p>§Cookies {30}</p><p>§Subscribe to {12}</p>
    <p>§Sponsored {25} privacy policy {10}</p><p>§&copy; {6}</p></article><div class=cookie-notice><p>We use cookies {20}</p></div>""",
    # Regions by class and id.
    """<div id=top class=site-header><a href=/>{2}</a></div><div id=menu><a href=/a>{1}</a><a href=/b>{1}</a></div>
    <div class=breadcrumbs><a href=/a>{1}</a> {1}</div><div id=content><h1>§{8}</h1><p>§{50}</p><p>§{4}</p>
    <h2>§{3}</h2><p>§{31}</p></div><div class=sidebar><h3>{2}</h3><p>{35}</p><ul><li>{3}</li></ul></div>
    <div id=comments><h3>{2}</h3><div><p>{40}</p></div><div><p>{2}</p></div></div><div class=site-footer>{14}</div>""",
    """<div class="cookie-banner"><p>We use cookies {18}</p></div><div class="post"><h2 class="post-title">§{6}</h2>
    <div class="post-meta">{5}</div><div class="post-content"><p>§{44}</p><p>§{6}</p><div class="ad-slot">{10}</div>
    <p>§{39}</p><ol><li>§{10}</li><li>§{1}</li></ol></div><div class="post-tags"><a href=/t>{1}</a></div></div>
    <div class="comments-area"><ol class="comment-list"><li><div class="comment-body"><p>{60}</p></div></li></ol></div>""",
    """<div role=banner>{4}</div><div role=navigation><p>{6}</p></div><div role=main><h1>§{5}</h1><p>§{33}</p>
    <p>§{2}</p></div><div role=complementary><p>{45}</p></div><div role=contentinfo><p>{16}</p></div>""",
    """<section class=story><p>§{2}</p><p>§{25}</p><p>§{13}</p><div class=promo><p>{16}</p></div><p>§{1}</p></section>
    <section class=trending><h2>{1}</h2><p>{12}</p><p>{13}</p></section><div class=alert>{11}</div>""",
]

#: Nothing said by markup: counts and neighbours decide.
PLAIN = [
    """<div><a href=/a>{1}</a> | <a href=/b>{1}</a> | <a href=/c>{2}</a></div><h1>§{7}</h1><p>§{45}</p><p>§{30}</p>
    <p>§{9}</p><p>§{52}</p><p>§{3}</p><p>§{41}</p><div><a href=/d>{3}</a></div><div><a href=/e>{4}</a></div><div>&copy; {5}</div>""",
    """<table><tr><td><a href=/a>{1}</a></td><td><a href=/b>{2}</a></td></tr></table><div>{3}</div><div>§{80}</div><div>§{64}</div>
    <div>§{12}</div><div>§{37}</div><div><a href=/p>{2}</a> <a href=/q>{2}</a></div><div>Subscribe {6}</div><div>{3}</div>""",
    """<p><a href=/a>{2}</a></p><p><a href=/b>{3}</a></p><h2>§{5}</h2><p>§{26}</p><p>§{38}</p><p>§{21} <a href=/w>{3}</a> {15}</p>
    <p>§{7}</p><p>§{33}</p><p>We use cookies {9}</p><p>All rights reserved {3}</p>""",
    """<div>{2}</div><div>{1}</div><div><a href=/x>{2}</a></div><p>§{60}</p><p>§{15}</p><p>§{70}</p><div><a href=/y>{5}</a></div>
    <div><a href=/z>{4}</a> {1}</div><div>{2}</div><div>{4}</div>""",
    """<h3>{2}</h3><ul><li><a href=/1>{4}</a></li><li><a href=/2>{5}</a></li></ul><h1>§{8}</h1><div>§{42}</div><div>§{6}</div>
    <div>§{55}</div><h3>{2}</h3><ul><li><a href=/3>{4}</a></li><li><a href=/4>{3}</a></li></ul><div>Powered by {2}</div>""",
    """<div><a href=/1>{14}</a> <a href=/2>{16}</a></div><div><a href=/3>{32}</a></div><h1>§{9}</h1><p>§{61}</p><p>§{5}</p>
    <p>§{48}</p><p>§{11}</p><p>§{34}</p><ul><li><a href=/4>{9}</a> <a href=/5>{29}</a></li></ul><div>&copy; {8}</div>""",
    """<div>{4}</div><div><a href=/1>{27}</a> {2}</div><div>{6}</div><h2>§{5}</h2><p>§{29}</p><p>§{8}</p><p>§{57}</p><p>§{2}</p>
    <p>§{30}</p><h2>§{3}</h2><p>§{43}</p><div><a href=/2>{40}</a></div><div>{9}</div><div>{5}</div>""",
    """<div><a href=/1>{2}</a></div><div>{20}</div><div><a href=/2>{3}</a></div><h1>§{6}</h1><p>§{90}</p><p>§{16}</p><p>§{75}</p>
    <p>§{19} <a href=/3>{2}</a></p><p>§{66}</p><div><a href=/4>{3}</a></div><div>{18}</div><div><a href=/5>{36}</a></div>""",
    """<h1>§{4}</h1><div>§{31} <a href=/a>{8}</a></div><div>§{10}</div><div>§{31}</div><div><a href=/b>{33}</a> {3}</div>
    <div><a href=/c>{30}</a></div><div>Follow us {30}</div><div>We use cookies {28} <a href=/p>privacy policy</a></div>""",
    """<section>{30} Sign up {3}</section><section>§{36}</section><section>§{3}</section><section>§{47}</section>
    <section>Related articles <a href=/r>{22}</a></section><section>Leave a comment {26}</section>""",
    """<ul><li><a href=/1>{1}</a></li><li><a href=/2>{1}</a></li></ul><h1>§{4}</h1><p>§{33}</p><h2>§{2}</h2><p>§{51}</p><h2>§{3}</h2>
    <p>§{27}</p><p>§{12}</p><p>§{40}</p><ul><li><a href=/3>{3}</a></li></ul><div>{6}</div>""",
    """<div><a href=/1>{2}</a> <a href=/2>{2}</a></div><h2>§{9}</h2><p>§{21}</p><p>§{36}</p><h3>§{4}</h3><p>§{58}</p><p>§{44}</p>
    <div><a href=/3>{3}</a></div><div>&copy; {3}</div><div>Powered by {1}</div>""",
]

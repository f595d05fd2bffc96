"""HTML extraction: other matter under any name, several templates, bad markup in linear time, scores by brute force."""

import random
import time

import pytest

from tidemark.llm import html_extract as H

TEXT = "Some words to read, and more, and then some more of them, again and again."
P = f"<p>{TEXT}</p>"
NAMES = ["user-comments", "reader-comments", "comment-thread", "disqus_thread", "related-stories", "ad-slot", "advert-slot", "sidebar-widgets",
         "widgets", "story-footer", "commentList", "promo_box2"]
BLOCK = "<div {}='{}'><p>Great post, thanks, really, yes.</p></div>"


@pytest.mark.parametrize("name", NAMES)
@pytest.mark.parametrize("attribute", ["class", "id"])
def test_other_matter_goes_inside_and_beside_the_article(name, attribute):
    block = BLOCK.format(attribute, name)
    want = " ".join(["Title", *[TEXT] * 3])
    assert H.main_text(f"<body><article><h1>Title</h1>{P * 3}{block}</article></body>") == want
    assert H.main_text(f"<body><article><h1>Title</h1>{P * 3}</article>{block}</body>") == want
    assert H.main_text(f"<body><div><main><h1>Title</h1>{P * 3}</main>{block}</div></body>") == want
    assert H.main_text(f"<body><div><h1>Title</h1>{P * 3}{block}</div></body>") == want


def test_marked_by_make_up():
    items = "".join(f"<div class=c><b>reader {i}</b><p>I think so, too.</p></div>" for i in range(4))
    links = "<p><a href=x>One story</a></p><p><a href=y>Another story</a></p>"
    for inside in (items, f"<div>{items}</div>", links, "buy this now"):
        assert H.main_text(f"<article><h1>Title</h1>{P * 3}<div class='reply-zone-x'>{inside}</div></article>") == " ".join(["Title", *[TEXT] * 3])
    # a section about such a matter stays
    assert H.main_text(f"<article><h1>Title</h1>{P * 3}<section id='cookie-recipe'>{P}</section></article>") == " ".join(["Title", *[TEXT] * 4])
    # names of many words are judged in no time
    began = time.time()
    H.main_text(f"<div class='{'advert_' * 5000}x'>{P}</div>")
    assert time.time() - began < 2


TEMPLATES = [
    "<body><div id=page><div class=header><a href=/>Home</a></div><div class='post-body'>{}</div><div class='footer'>foot, foot</div></div></body>",
    "<table><tr><td class=nav><a href=a>A</a><a href=b>B</a></td><td>{}</td></tr></table>",
    "<main>{}</main><section class='comments-area'><h2>Comments</h2><div><p>first, yes</p></div></section>",
    "<div class='wrap has-sidebar'><div class=content>{}</div><div class='sidebar'><p>side, side, side</p></div></div>",
    "<body><center><div>{}</div></center><form><p>a, b</p></form></body>",
]


@pytest.mark.parametrize("template", TEMPLATES)
def test_templates(template):
    body = f"<h1>Title</h1>{P}<ul><li>one, two</li><li>three</li></ul><blockquote>{TEXT}</blockquote>{P * 2}"
    assert H.main_text(template.format(body)) == " ".join(["Title", TEXT, "one, two three", *[TEXT] * 3])


BAD = {
    "unclosed quotes": '<p a="x>word, ' + "<p b='y>word ", "one quote": "<a b=\"c>", "stray end tags": "</div></b></i></p>x", "nested": "<span><div>x",
    "p in spans": "<span><p>x, y", "end of inline": "<b><div></b>x", "open comments": "<!-x <! ", "less than": "<a <b <c ", "items": "<ul><li>x<li>",
    "only quotes": "<\"'", "raw": "<script>a<title>b", "cells": "<table><tr><td>x", "attributes": "<p a = b c= 'd' e", "deep lists": "<dl><dt>a<dd>b",
}


@pytest.mark.parametrize("kind", sorted(BAD))
def test_two_megabytes_of_bad_markup(kind):
    page = BAD[kind] * (2_000_000 // len(BAD[kind]))
    began = time.time()
    H.main_text(page)
    assert time.time() - began < 60             # 2 to 6 s on an idle core; a quadratic pass takes hours


def test_tag_ends_equal_a_plain_scan():
    rnd = random.Random(2)

    def plain(page, at):
        quote, i = "", at
        while i < len(page):
            c = page[i]
            if quote:
                quote = "" if c == quote else quote
            elif c in "\"'":
                quote = c
            elif c == ">":
                return i
            i += 1
        return page.find(">", at)
    for _ in range(400):
        page = "".join(rnd.choice("ab<> \"'=") for _ in range(rnd.randint(0, 40)))
        ends = H._TagEnds(page)
        for at in sorted(rnd.sample(range(len(page) + 1), min(len(page) + 1, 8))):
            assert ends.find(at) == plain(page, at), (page, at)


def _tree(rnd, depth=0):
    out = ""
    for _ in range(rnd.randint(1, 4)):
        tag = rnd.choice(["div", "section", "p", "span", "b", "td", "li", "blockquote"])
        text = "".join(rnd.choice("ab, ") for _ in range(rnd.randint(0, 60)))
        out += f"<{tag}>{text}{_tree(rnd, depth + 1) if depth < 4 and rnd.random() < 0.6 and tag != 'p' else ''}</{tag}>"
    return out


def test_points_equal_brute_force():
    """Scores of containers, by walking up from every paragraph."""
    rnd = random.Random(7)
    for _ in range(60):
        page = _tree(rnd)
        root = H.parse(page)
        order = H._measure(root)
        want: dict[int, float] = {}
        for node in order:
            if node.tag in H.CONTAINERS or node.tag in H.PARAGRAPHS:
                text = _own(node)
                size = sum(len(t.strip()) for t in text)
                if not size:
                    continue
                points = 1 + sum(t.count(",") for t in text) + min(size / 100, 3)
                share, up, k = 1.0, node if node.tag in H.CONTAINERS else node.parent, 0
                while up is not None:
                    if up.tag in H.CONTAINERS:
                        want[id(up)] = want.get(id(up), 0.0) + points * share
                        k += 1
                        share = 0.5 if k == 1 else 1 / 6 * (2 / 3) ** (k - 2)
                    up = up.parent
        captured = {}
        real = H._with_neighbours
        try:
            H._with_neighbours = lambda best: captured.setdefault("best", best)
            blocks, H._blocks = H._blocks, lambda node: []
            parse, H.parse = H.parse, lambda _: root
            H.main_text("x" + page)
        finally:
            H._with_neighbours, H._blocks, H.parse = real, blocks, parse
        if "best" in captured:
            for node in order:
                if id(node) in want:
                    assert abs(node.score - want[id(node)] * (1 - node.link_chars / max(node.chars, 1))) < 1e-9


def _own(node):
    out = []
    for k in node.kids:
        if isinstance(k, str):
            out.append(k)
        elif not k.off and k.tag not in H.BLOCKS:
            out += _own(k)
    return out

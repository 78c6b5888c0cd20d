"""Operator 7 on hand-written layouts without an article element: what is kept and what is lost, in words."""

from __future__ import annotations

import re

import pytest

from tillroll.llm import pages

PROSE = [
    "The river had risen again in the night, and the lower road was gone; nobody had seen it go.",
    "By noon, when the boats came, there were three of us left at the mill, and one was asleep.",
    "Nobody spoke of the harvest, which was just as well. It had been a poor one, as in the year before.",
    "The council met on Tuesday and agreed, after a long debate, that the bridge must be rebuilt, whatever it cost.",
    "Its plans, drawn by an engineer from the coast, show two arches of grey stone and a narrow path for walkers.",
    "Work is to begin in spring, once the water is low enough; until then a ferry runs twice a day, and it is free.",
    "The ferryman, who asked us not to print his name, said that he had carried more goats than people so far.",
    "He did not mind, he added. Goats pay no fare, but they do not ask when the bridge will be ready, either."]
COMMENT = "I live there, and I can tell you that none of this is true, not one word of it, as anybody in the village knows."

#: Where the article stands: the text before it and after it.
WRAPPERS = {
    "bare body": ("", ""),
    "plain div": ("<div>", "</div>"),
    "content id": ('<div id="content">', "</div>"),
    "page form": ('<form id="aspnetForm" action="x"><input type=hidden name=v><div id="page">', "</div></form>"),
    "table cell": ("<table><tr><td>", "</td></tr></table>"),
    "two columns": ('<table><tr><td width=20%><ul class="menu"><li><a href=a>One</a><li><a href=b>Two</a></ul><td>', "</table>"),
    "sidebar wrap": ('<div class="content-sidebar-wrap"><div class="has-sidebar">', "</div></div>"),
    "deep divs": ("<div>" * 9, "</div>" * 9),
    "role main": ('<div role="main"><div class="post-body">', "</div></div>"),
    "section": ('<section class="story">', "</section>"),
    "search wrap": ('<div class="search-results-page"><div class="col">', "</div></div>"),
    "dialog": ('<dialog open><div class="text">', "</div></dialog>"),
    "hidden until loaded": ('<body style="display:none"><div class="wrap">', "</div>"),
}

#: The article's own marks: how a headline and the paragraphs are written.
BODIES = {
    "paragraphs": lambda ps: "<h1>The bridge</h1>" + "".join(f"<p>{p}</p>" for p in ps),
    "open paragraphs": lambda ps: "<h2>The bridge</h2>" + "".join(f"<p>{p}\n" for p in ps) + "<p>",
    "divs and a list": lambda ps: "<div class=headline>The bridge</div>" + "".join(f"<div>{p}</div>" for p in ps[:5]) + "<ul>" + "".join(f"<li>{p}</li>" for p in ps[5:]) + "</ul>",
}

BEFORE = ('<nav><a href=h>Home</a></nav><div class="cookie-notice"><p>We use cookies, and so do our 812 partners, for your comfort.</p></div>'
          '<form class="search"><label>Find</label><input name=q><button>Go</button></form>')
AFTER = ('<section id="reader-feedback"><h3>Readers say</h3>' + f"<p>{COMMENT}</p>" * 2 + "</section>"
         '<div class="x9f2"><ul><li><a href=1>Other news</a></li><li><a href=2>More of it</a></li><li><a href=3>And the rest</a></li></ul></div>'
         '<div style="display:none"><p>Unseen words, which nobody was meant to read, stand here.</p></div><div class="alert"><p>This page is old, beware.</p></div>'
         "<footer>Imprint, and so on.</footer>")


def words(text):
    return re.findall(r"\w+", text)


def overlap(got, want):
    from collections import Counter
    return sum((Counter(words(got)) & Counter(words(want))).values())


def measure():
    out = {}
    for w, (open_, close) in WRAPPERS.items():
        for b, body in BODIES.items():
            want = "The bridge " + " ".join(PROSE)
            got = pages.main_text(f"<html><head><title>t</title></head>{'' if open_.startswith('<body') else '<body>'}{BEFORE}{open_}{body(PROSE)}{close}{AFTER}</body></html>")
            both = overlap(got, want)
            out[w, b] = both / max(1, len(words(got))), both / len(words(want))
    return out


def test_layouts_without_an_article():
    found = measure()
    assert len(found) >= 30
    precision, recall = (sum(v[i] for v in found.values()) / len(found) for i in (0, 1))
    assert precision >= 0.99 and recall >= 0.99, sorted(found.items(), key=lambda x: sum(x[1]))[:5]
    assert min(r for _, r in found.values()) >= 0.95          # no page is lost


@pytest.mark.parametrize("page", [
    '<article>{0}<article class="comment"><p>{1}</p></article></article>', '<div>{0}</div><article class="comment"><p>{1}</p></article>',
    '<article>{0}<article><p>{1}</p></article></article>', '<article>{0}<div hidden><p>{1}</p></div></article>',
    '<main>{0}<form><p>{1}</p><input></form></main>', '<article>{0}<div class="alert alert-warning"><p>Old page, beware.</p></div></article>',
    '<article class="post has-sidebar">{0}</article><div class="sidebar"><p>{1}</p></div>', '<form><article>{0}</article><label>Your name</label></form>'])
def test_comments_hidden_text_and_forms_go(page):
    html = "<body>" + page.format("".join(f"<p>{p}</p>" for p in PROSE), COMMENT) + "</body>"
    assert pages.main_text(html) == " ".join(PROSE)


def test_short_lists_of_an_article_stay():
    html = "<article><h1>Soup</h1><ul><li>Eggs<li>Milk<li>Flour</ul>" + "".join(f"<p>{p}</p>" for p in PROSE) + "</article>"
    assert pages.main_text(html) == "Soup Eggs Milk Flour " + " ".join(PROSE)

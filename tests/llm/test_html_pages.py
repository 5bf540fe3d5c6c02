"""Pages of the shapes that real sites have, with the text that must come out."""

from __future__ import annotations

import time

import pytest

from quantarium.llm import html_text

A = "The story of the man and the sea is a story that has been told for many years and it will be told again by those who were there."
B = "When the boat came back to the harbour in the evening, all of the people of the village were there to see what had been in the nets."
C = "It was not until the next morning that they found out what had happened to the old man, who was still in his house by the shore."
LONG = "This is what we have to say about the things that you can do with our offers, and why it would be good for you to have one of them now."
RUSSIAN = "Это длинный рассказ о человеке и море, который много лет рассказывали старики в деревне на берегу реки."
RUSSIAN_2 = "Когда лодка вернулась вечером в гавань, все жители деревни вышли посмотреть, что было в сетях рыбаков."
MENU = '<nav><ul><li><a href="/">Home</a></li><li><a href="/about">About us</a></li></ul></nav>'
STORY = f"<h1>Title</h1><p>{A}</p><p>Short.</p><p>{B}</p>"
TEXT = f"Title\n\n{A}\n\nShort.\n\n{B}"

LINKS = "<ul>" + "".join(f'<li><a href="/{i}">Topic {i}</a></li>' for i in range(8)) + "</ul>"
SOURCES = "<h2>References</h2><ul>" + "".join(f'<li><a href="/{i}">Source {i}</a></li>' for i in range(4)) + "</ul>"

PAGES = {
    "menu without a name before the title": (f"<main>{LINKS}{STORY}</main>", TEXT),
    "menu without a name after the text": (f"<article>{STORY}{LINKS}</article>", TEXT),
    "menu without a name amid the text": (f"<article><h1>Title</h1><p>{A}</p>{LINKS}<p>Short.</p><p>{B}</p></article>", TEXT),
    "menu of divisions": (f"<main><div>{LINKS.replace('li>', 'div>').replace('ul>', 'div>')}</div>{STORY}</main>", TEXT),
    "references stay": (f"<article>{STORY}{SOURCES}</article>", TEXT + "\n\nReferences\n\nSource 0\n\nSource 1\n\nSource 2\n\nSource 3"),
    "one link stays": (f'<article>{STORY}<p><a href="/x">Read the report</a></p></article>', TEXT + "\n\nRead the report"),
    "class tells what the page has": (f'{MENU}<main class="layout with-sidebar">{STORY}</main>', TEXT),
    "open comments": (f'{MENU}<article class="post comments-open">{STORY}</article>', TEXT),
    "page has header": (f'<div class="page has-header"><article>{STORY}</article></div>', TEXT),
    "page has header, no article": (f'<div class="page has-header">{STORY}</div>', TEXT),
    "modifier": (f'<div class="page page--with-sidebar layout-sidebar"><main>{STORY}</main><div class="page__sidebar"><p>{LONG}</p></div></div>', TEXT),
    "page in a form": (f'<form id="aspnetForm" action="/">{MENU}<div>{STORY}</div></form>', TEXT),
    "page in a form, with article": (f'<form method="post"><article>{STORY}</article></form>', TEXT),
    "form in an article": (f'<article>{STORY}<form><label>Your name</label><p>{LONG}</p><p>{LONG}</p></form></article>', TEXT),
    "teaser in an aside": (f'<article>{STORY}</article><aside><article><h3>Other</h3><p>{LONG}</p></article></aside>', TEXT),
    "aside in an article": (f"<article>{STORY}<aside><p>{LONG}</p></aside></article>", TEXT),
    "letter spacing": (f'<main><h1 class="tracking-tight">Title</h1><p class="tracking-tight text-lg">{A}</p><p>Short.</p><p>{B}</p></main>', TEXT),
    "words about search results": (f'<main>{STORY}<div class="search-results-explained"><p>{C}</p></div></main>', f"{TEXT}\n\n{C}"),
    "list of sources": (f'<article>{STORY}<ul><li><a href="/a">A source of it</a></li><li><a href="/b">Another</a></li></ul></article>', f"{TEXT}\n\nA source of it\n\nAnother"),
    "russian": (f"<body>{MENU}<div><p>{RUSSIAN}</p><p>{RUSSIAN_2}</p></div></body>", f"{RUSSIAN}\n\n{RUSSIAN_2}"),
    "russian quote in english": (f"<div><p>{A}</p><p>{RUSSIAN}</p><p>{B}</p></div>", f"{A}\n\n{RUSSIAN}\n\n{B}"),
    "cards around a story": (f'<div><p>{A}</p><p>{B}</p></div>' + "".join(f'<article><h3>Card {i}</h3><p>Read it</p></article>' for i in range(3)), f"{A}\n\n{B}"),
    "promotion beside an article": (f'<article><p>{A}</p><p>{B}</p></article><div class="box"><p>{LONG}</p></div>', f"{A}\n\n{B}"),
    "site header and article header": (f'<header><h1>Site</h1><p>{LONG}</p></header><article><header><h1>Title</h1></header><p>{A}</p><p>{B}</p></article>', f"Title\n\n{A}\n\n{B}"),
    "named site header": (f'<div id="site-header"><p>{LONG}</p></div><div class="entry"><h2>Head</h2><p>{A}</p><p>{B}</p></div>', f"Head\n\n{A}\n\n{B}"),
    "named header in an article": (f'<article><div class="entry-header"><h1>Title</h1></div><p>{A}</p></article>', f"Title\n\n{A}"),
    "header never closed": (f"<header>{MENU}<main>{STORY}</main>", TEXT),
    "menu never closed": (f"<nav><a href='/'>Home</a><main>{STORY}</main>", TEXT),
    "footer in an article": (f"<article>{STORY}<footer><p>{LONG}</p></footer></article>", TEXT),
    "comments": (f'<article>{STORY}</article><section id="comments"><h2>Comments</h2><article class="comment"><p>{LONG}</p></article><div class="comment-body"><p>{LONG}</p></div></section>', TEXT),
    "comments longer than the article": (f'<div class="content"><h1>Title</h1><p>{A}</p></div><div class="comments-area"><ol class="comment-list"><li><p>{LONG}</p></li><li><p>{LONG}</p></li></ol></div>', f"Title\n\n{A}"),
    "cookie notice": (f'<div class="cookie-notice" role="dialog"><p>{LONG}</p></div><main>{STORY}</main>', TEXT),
    "advert in an article": (f'<article><h1>Title</h1><p>{A}</p><div class="ad-slot"><p>{LONG}</p></div><p>Short.</p><p>{B}</p></article>', TEXT),
    "words that contain ad": (f'<main><div class="headline readable shadow loading adaptive"><h1>Title</h1><p>{A}</p></div></main>', f"Title\n\n{A}"),
    "camel case": (f'<div class="relatedPosts"><p>{LONG}</p></div><div class="storyBody"><p>{A}</p><p>{B}</p></div>', f"{A}\n\n{B}"),
    "hidden": (f'<main><p>{A}</p><p hidden>{LONG}</p><div aria-hidden="true">{LONG}</div><div style="display:none"><p>{LONG}</p></div><p class="md:hidden lg-hidden x">{B}</p></main>', f"{A}\n\n{B}"),
    "hidden main": (f'<div><p>{A}</p><p>{B}</p></div><main hidden><p>{LONG}</p></main>', f"{A}\n\n{B}"),
    "role": (f'<div role="banner"><p>{LONG}</p></div><div role="main">{STORY}</div><div role="contentinfo"><p>{LONG}</p></div>', TEXT),
    "two articles": (f"<article><p>{A}</p></article><article><p>{B}</p></article>", f"{A}\n\n{B}"),
    "article in an article": (f"<article><p>{A}</p><article><p>{B}</p></article><p>{C}</p></article>", f"{A}\n\n{B}\n\n{C}"),
    "paragraphs by line breaks": (f"<div>{A}<br><br>{B}<br>{C}</div>", f"{A}\n\n{B} {C}"),
    "references": ("<article><p>A &amp; B&nbsp;&lt;c&gt; &#233;&eacute;\n\n  d</p></article>", "A & B <c> éé d"),
    "unclosed link": (f'<main><p><a href="/x">One<p>{A}</p><p>{B}</p></main>', f"One\n\n{A}\n\n{B}"),
    "script, style, comment": (f'<style>p{{}}</style><script>var a="<p>x</p>";</script><!-- <p>x</p> --><main>{STORY}<noscript><p>{LONG}</p></noscript></main>', TEXT),
    "table and definitions": (f"<main><p>{A}</p><table><tr><td>one</td><td>two</td></tr></table><dl><dt>three</dt><dd>four</dd></dl></main>", f"{A}\n\none\n\ntwo\n\nthree\n\nfour"),
    "inline advert": (f'<main><p>{A}<span class="ads">Buy now</span> and on</p></main>', f"{A}\n\nand on"),
    "only short blocks": ("<div>One.</div><div>Two.</div>", "One.\n\nTwo."),
    "copyright line": (f"<div><p>{A}</p></div><div>© 2020 the owners of this site and of all the words that are in it and on it</div>", A),
    "cut off in a tag": (f"<main><p>{A}</p><p cla", A),
}


@pytest.mark.parametrize("name", list(PAGES))
def test_page(name):
    page, text = PAGES[name]
    assert html_text.main_text(page)[0] == text
    assert html_text.main_text(f"<!DOCTYPE html><html><head><title>T</title></head><body class='has-sidebar'>{page}")[0] == text


@pytest.mark.parametrize("page", ["<div>" * 100_000 + "x", "<div><span class=ad>" * 50_000, "<div class=ad></span>" * 50_000, "<b><i>" * 50_000 + "x" + "</b></i>" * 50_000, "<a href='x'><p>y" * 50_000, "<p '\"" * 50_000])
def test_deep_pages_take_linear_time(page):
    start = time.perf_counter()
    html_text.main_text(page)
    assert time.perf_counter() - start < 5  # well under one second on an idle core

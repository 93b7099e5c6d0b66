"""Hand-marked page layouts that teach the main-text extraction.

``MARK`` stands on the elements that hold the article. The layouts vary what
the table's own pages may lack: articles in plain ``div`` elements, sidebars,
notices, comments, forms, tables and pages with hardly any markup. The words are
filler; only their number and place teach anything.
"""

from __future__ import annotations

MARK = "data-article"


def _words(n: int) -> str:
    return " ".join(["lorem"] * n)


def _paragraphs(*sizes: int) -> str:
    return "".join(f"<p>{_words(n)}</p>" for n in sizes)


def _links(n: int) -> str:
    return "".join(f'<li><a href="/{i}">{_words(1 + i % 2)}</a></li>' for i in range(n))


def _page(*parts: str) -> str:
    return f"<!DOCTYPE html><html><head><title>{_words(6)}</title><style>p{{}}</style></head><body>{''.join(parts)}</body></html>"


_NAV = f"<nav><ul>{_links(8)}</ul></nav>"
_BARE_MENU = f"<ul>{_links(6)}</ul>"
_LINE_MENU = "<div>" + " | ".join(f'<a href="/{i}">{_words(1)}</a>' for i in range(7)) + "</div>"
_HEADER = f"<header><div>{_words(4)}</div>{_NAV}</header>"
_FOOTER = f'<footer><p>{_words(9)}</p><a href="/terms">{_words(2)}</a></footer>'
_SMALL_PRINT = f'<div>{_words(5)} <a href="/imprint">{_words(1)}</a> <a href="/privacy">{_words(1)}</a></div>'
_SIDEBAR = f'<aside><h3>{_words(2)}</h3><ul>{_links(5)}</ul><p>{_words(12)}</p></aside>'
_COOKIES = f'<div class="cookie-notice"><p>{_words(18)}</p><button>{_words(1)}</button></div>'
_ADVERT = f'<div class="ad">{_words(11)}</div>'
_FORM = f'<form action="/s"><label>{_words(2)}</label><input><button>{_words(1)}</button></form>'
_COMMENTS = f'<section id="comments"><h2>{_words(1)}</h2><div class="comment"><p>{_words(25)}</p></div><div class="comment"><p>{_words(14)}</p></div></section>'
_READ_MORE = f'<div><h3>{_words(2)}</h3>{_BARE_MENU}</div>'

LAYOUTS = [
    _page(_HEADER, f"<article {MARK}><h1>{_words(7)}</h1>{_paragraphs(40, 65, 12, 90)}</article>", _SIDEBAR, _COMMENTS, _FOOTER),
    _page(_COOKIES, _NAV, f"<main {MARK}><h1>{_words(5)}</h1>{_paragraphs(30, 45)}{_ADVERT}{_paragraphs(70, 8)}</main>", _READ_MORE, _FOOTER),
    _page(_LINE_MENU, f"<div {MARK}><h1>{_words(6)}</h1>{_paragraphs(55, 80, 20)}<ul><li>{_words(14)}</li><li>{_words(9)}</li></ul>{_paragraphs(35)}</div>",
          _READ_MORE, _SMALL_PRINT),
    _page(_BARE_MENU, _FORM, f"<div {MARK}><h2>{_words(6)}</h2><div>{_words(60)}<br>{_words(40)}<br><br>{_words(85)}</div></div>", _SMALL_PRINT),
    _page(f"<table><tr><td>{_BARE_MENU}</td><td {MARK}><h1>{_words(5)}</h1>{_paragraphs(50, 60)}<blockquote>{_words(25)}</blockquote></td></tr></table>", _SMALL_PRINT),
    _page(f"<div {MARK}>{_paragraphs(20, 75, 33, 5, 64)}</div>"),
    f"<div {MARK}>{_words(120)}</div>",
    f"<body {MARK}>{_words(60)}<br>{_words(70)}</body>",
    f"<html><body {MARK}>{_words(40)}<br><b>{_words(6)}</b><br>{_words(55)}<hr>{_words(80)}</body></html>",
    _page(_NAV, f"<section {MARK}><h1>{_words(8)}</h1>{_paragraphs(44)}<pre>{_words(30)}</pre>{_paragraphs(26)}"
                f"<table><tr><th>{_words(2)}</th><td>{_words(6)}</td></tr></table></section>", _COMMENTS, _FOOTER),
    _page(_LINE_MENU, _ADVERT, f"<div {MARK}><h1>{_words(4)}</h1><p>{_words(30)} <a href='/x'>{_words(2)}</a> {_words(25)}</p>{_paragraphs(48)}</div>",
          _FORM, _SMALL_PRINT),
]

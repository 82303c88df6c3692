"""Pages composed from many layouts, whose content blocks are marked: what the classifier of `mincut` learns from.

Nothing here is taken from a corpus. A page is a layout (with or without `article`, `main`, paragraphs, class names), the
parts of a page that are no content, and an article; texts are random words, so only structure and shape can be learnt.
"""

from __future__ import annotations

import random

#: Begins the text of every content block.
MARK = "\x02"
PAGES = 500


def _word(r: random.Random) -> str:
    return "".join(r.choice("aeiounrtslmdkpbg") for _ in range(r.randint(2, 9)))


def _words(r: random.Random, n: int) -> str:
    return " ".join(_word(r) for _ in range(n)).capitalize()


def _sentences(r: random.Random, n: int) -> str:
    out = []
    for _ in range(n):
        s = _words(r, r.randint(4, 16))
        if r.random() < 0.4:
            s = s.replace(" ", ", ", 1)
        out.append(s + r.choice("......!?"))
    return " ".join(out)


def _link(r: random.Random, text: str) -> str:
    return f'<a href="/{_word(r)}">{text}</a>'


def _named(r: random.Random, tags: list[str], names: list[str], inner: str, plain: float = 0.0) -> str:
    """An element of one of the tags with one of the names, at times as an id or within another word."""
    tag, name = r.choice(tags), r.choice(names)
    if r.random() < plain:
        return f"<{tag}>{inner}</{tag}>"
    name = r.choice([name, name, f"{name}-{_word(r)}", f"{_word(r)}-{name}", f"{_word(r)} {name}"])
    return f'<{tag} {r.choice(["class", "class", "id"])}="{name}">{inner}</{tag}>'


def _role(role: str, inner: str) -> str:
    return f'<div role="{role}">{inner}</div>'


def _links(r: random.Random, n: int) -> str:
    items = [_link(r, _words(r, r.randint(1, 4))) for _ in range(n)]
    kind = r.random()
    if kind < 0.6:
        return "<ul>" + "".join(f"<li>{i}</li>" for i in items) + "</ul>"
    return " | ".join(items) if kind < 0.8 else "".join(f"<div>{i}</div>" for i in items)


def _boilerplate(r: random.Random) -> list:
    """Makers of the parts that are no content."""
    said = lambda: r.choice(["<p>{}</p>", "<div>{}</div>", "{}", "<span>{}</span>"]).format(_sentences(r, r.randint(1, 4)))
    return [
        lambda: r.choice([f"<nav>{_links(r, r.randint(3, 9))}</nav>", _named(r, ["div", "ul", "nav"], ["nav", "menu", "navbar", "breadcrumbs", "toolbar"], _links(r, r.randint(3, 9))), _role("navigation", _links(r, 4)), _named(r, ["div", "nav"], ["nav", "menu", "navbar", "breadcrumbs", "toolbar"], "".join(f"<{t}>{_words(r, r.randint(1, 3))}</{t}>" for t in [r.choice(["div", "span", "p"])] for _ in range(4)))]),
        lambda: _named(r, ["div", "section", "aside"], ["ad", "ads", "advert", "banner", "sponsor", "promo"], said()),
        lambda: r.choice([_role(r.choice(["dialog", "alertdialog"]), said()), f"<dialog>{said()}</dialog>"] + 4 * [_named(r, ["div", "section", "dialog"], ["cookie", "consent", "notice", "gdpr", "popup", "modal", "alert"], said() + r.choice(["", "<button>Ok</button>", _link(r, "Ok")]))]),
        lambda: r.choice([f"<aside>{said()}{_links(r, r.randint(1, 5))}</aside>", f"<aside>{said()}</aside>", _role("complementary", said()), *4 * [_named(r, ["div", "aside"], ["sidebar", "related", "widget", "trending", "share", "social"], r.choice([said(), _links(r, 4), f"<h3>{_words(r, 2)}</h3>{_links(r, 4)}"]))]]),
        lambda: f'<form action="/{_word(r)}"><label>{_words(r, 2)}</label><input><p>{_sentences(r, 1)}</p></form>',
        lambda: _named(r, ["div", "section"], ["newsletter", "subscribe", "signup", "login", "search"], f"<h3>{_words(r, 3)}</h3>{said()}<input>"),
        lambda: _comments(r),
    ]


def _comments(r: random.Random) -> str:
    tag = r.choice(["li", "div", "article", "p"])
    one = lambda: f"<{tag}><b>{_words(r, 2)}</b> {r.choice(['<p>{}</p>', '{}', '<div>{}</div>']).format(_sentences(r, r.randint(1, 6)))}</{tag}>"
    inner = r.choice(["", f"<h3>{_words(r, 2)}</h3>", f"<h2>{r.randint(2, 99)} {_word(r)}</h2>"]) + "".join(one() for _ in range(r.choice([1, 2, 3, 5, 8, 15])))
    return _named(r, ["ol", "ul"] if tag == "li" else ["div", "section"], ["comments", "comment-list", "disqus", "responses", "replies", "discussion", "reader-comments"], inner)


def _content(r: random.Random, style: str) -> list[str]:
    """Blocks of an article: its title, text and what stands among it."""
    out = []
    if r.random() < 0.85:
        title = f"<h1>{MARK}{_words(r, r.randint(2, 9))}</h1>"
        out.append(f"<header>{title}</header>" if r.random() < 0.15 else title)
    for _ in range(r.choice([1, 2, 3, 4, 5, 6, 8, 12, 24])):
        kind, size = r.random(), r.choice([1, 1, 1, 2, 3, 4, 6])
        text = _sentences(r, size) if r.random() < 0.9 else _words(r, r.randint(2, 8))
        if r.random() < 0.15:
            text += " " + _link(r, _words(r, 2)) + r.choice([".", " " + _sentences(r, 1)])
        if kind < 0.72 or style != "p":
            out.append(f"<{style}>{MARK}{text}</{style}>")
        elif kind < 0.8:
            out.append(f"<h2>{MARK}{_words(r, r.randint(1, 5))}</h2>")
        elif kind < 0.87:
            tag = r.choice(["ul", "ol"])
            out.append(f"<{tag}>" + "".join(f"<li>{MARK}{r.choice([_words(r, r.randint(2, 7)), _sentences(r, 1)])}</li>" for _ in range(r.randint(2, 5))) + f"</{tag}>")
        elif kind < 0.91:
            out.append(f"<blockquote>{MARK}{text}</blockquote>")
        elif kind < 0.94:
            out.append(f"<pre>{MARK}{_words(r, 6)}</pre>")
        elif kind < 0.97:
            out.append("<table>" + "".join(f"<tr><td>{MARK}{_words(r, 1)}</td><td>{MARK}{_words(r, r.randint(1, 4))}</td></tr>" for _ in range(r.randint(2, 4))) + "</table>")
        else:
            out.append(f"<figure><img src=x><figcaption>{MARK}{_sentences(r, 1)}</figcaption></figure>")
    return out


def page(r: random.Random) -> str:
    makers = _boilerplate(r)
    style = r.choice(["p", "p", "p", "p", "div", "section"])
    parts = _content(r, style)
    if len(parts) > 2 and r.random() < 0.35:  # a foreign part amid the article
        parts.insert(r.randrange(1, len(parts)), r.choice(makers[1:4] + makers[5:6])())
    article = "".join(parts)
    shell = r.random()
    if shell < 0.4:
        article = f"<article>{article}</article>"
    elif shell < 0.55:
        article = r.choice([f"<main>{article}</main>", _role("main", article)])
    elif shell < 0.8:
        article = _named(r, ["div", "section", "td"], ["content", "post", "entry", "story", "article-body", "main", "text"], article)
    elif shell < 0.9:
        article = f"<div>{article}</div>"
    top, end = [], []
    if r.random() < 0.6:
        brand = r.choice([_link(r, _words(r, 2)), f"<div>{_words(r, 2)}</div>", f"<p>{_sentences(r, 1)}</p>"])
        top.append(r.choice([f"<header>{brand}</header>", f"<header>{brand}{makers[0]()}</header>", _named(r, ["div"], ["header", "masthead", "logo"], brand), _role("banner", brand)]))
    for make in makers[:6]:
        if r.random() < 0.4:
            (top if r.random() < 0.6 else end).append(make())
    if r.random() < 0.35:
        end.insert(0, makers[6]())
    if r.random() < 0.6:
        said = r.choice([f"&copy; {r.randint(1999, 2026)} {_words(r, 2)}", f"&copy; {_word(r)}.example &middot; {_sentences(r, 1)}", _sentences(r, 2), _links(r, 4)])
        end.append(r.choice([f"<footer>{said}</footer>", f"<footer><p>{said}</p></footer>", _named(r, ["div"], ["footer", "copyright", "legal"], said), _role("contentinfo", said)]))
    if r.random() < 0.12:
        top, end = [], []
    body = "".join(top) + article + "".join(end)
    if r.random() < 0.4:
        body = f'<div class="{r.choice(["page", "wrapper", "container", "site", "page-with-sidebar", "layout"])}">{body}</div>'
    return f"<html><head><title>{_words(r, 4)}</title></head><body>{body}</body></html>"


def pages(n: int = PAGES, seed: int = 5) -> list[str]:
    r = random.Random(seed)
    return [page(r) for _ in range(n)]

"""Blocks and token streams of HTML pages (helper of operator 4).

A page becomes text blocks in page order, each with the zone its containers put
it in: KEPT (inside an article or main element), DROPPED (menus, headers,
footers, sidebars, notices, adverts, forms, comments, head) or OPEN (neither).
Tags, roles and whole class or id names settle a zone; html, body, article and
main are never dropped for a name (but an article element named a comment is a
reader's comment), and a word inside a longer name (no-sidebar, social-science)
settles nothing.
The token stream holds what may be boilerplate: tags and words outside KEPT
zones; a KEPT zone is one separator, as nothing in it is ever removed.
"""

from __future__ import annotations

import functools
import hashlib
import html
import re
from dataclasses import dataclass, field

OPEN, KEPT, DROPPED = 0, 1, 2

_RAW = "script|style|title|textarea|noscript|template|svg|iframe|select|button|object|math"
_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<(?P<raw>{_RAW})\b(?:\"[^\"]*\"|'[^']*'|[^'\">])*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*)(?P<rest>(?:\"[^\"]*\"|'[^']*'|[^'\">])*)>"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|</?[a-zA-Z][^>]*\Z", re.S | re.I)
_ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)

BLOCKS = frozenset("""address article aside blockquote body center dd details dialog dir div dl dt fieldset
    figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section
    summary table tbody td tfoot th thead tr ul head""".split())
_CONTAINERS = frozenset("""article aside blockquote body details dialog div dl fieldset figure footer form head
    header html main menu nav ol section table ul""".split())
_DROP_TAGS = frozenset("aside dialog footer form head menu nav".split())
_KEEP_TAGS = frozenset(("article", "main"))
_DROP_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search"
                        .split())
#: whole names, and last words of compound names (site-footer), of page parts which are not the article
_DROP_NAMES = frozenset("""ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment
    comments consent cookie cookies disclaimer discussion disqus footer gdpr header masthead menu modal nav navbar
    navigation newsletter notice notices pagination popup promo promoted promotion recommended related replies
    reply respond share sharing sidebar signup skip social sponsor sponsored subscribe toolbar topbar widget
    widgets""".split())
#: a compound name with one of these first words tells a state or a part of the article: no-sidebar, entry-header
_STATES = frozenset("no not non has have with without is hide hidden show single".split())
_OF_ARTICLE = frozenset("article entry post story content section chapter".split())
#: names of containers after a first word out of _DROP_NAMES: comment-list, sidebar-left, ad-slot
_PLACES = frozenset("""area bar block body bottom box column container content form group inner item items left link
    links list menu outer pane panel region right row section slot text thread title top unit wrap wrapper"""
                    .split())
_COMMENT_NAMES = frozenset("comment comment-body comment-item comment-content comments reply".split())
_KEEP_WORDS = frozenset("article articlebody entry-content main-content post-content story-body".split())


@dataclass
class Page:
    blocks: list[tuple[int, str, int, int]] = field(default_factory=list)   # zone, text, stream from, to
    stream: list[int] = field(default_factory=list)


@functools.lru_cache(maxsize=200_000)
def token(word: str) -> int:
    """A 31-bit number of a token (runs of several tokens are compared); negative ones are separators."""
    return int.from_bytes(hashlib.blake2b(word.encode("utf-8", "replace"), digest_size=4).digest(), "little") >> 1


@functools.lru_cache(maxsize=50_000)
def _own_zone(name: str, rest: str) -> tuple[int | None, str]:
    """The zone an element asks for, if any, and its token."""
    found = {k.lower(): (a or b or c).lower() for k, a, b, c in _ATTRIBUTE.findall(rest)}
    named = f"{found.get('class', '')} {found.get('id', '')}"
    whole = set(named.replace("_", "-").split())
    mark = f"<{name} {named.strip()}>"
    if name in ("html", "body"):
        return None, mark
    if name in _KEEP_TAGS:               # class words settle nothing here, but a reader's comment is one
        return DROPPED if name == "article" and whole & _COMMENT_NAMES else KEPT, mark
    if name in _DROP_TAGS or found.get("role") in _DROP_ROLES or any(map(_names_frame, whole)):
        return DROPPED, mark
    if found.get("role") in ("main", "article") or whole & _KEEP_WORDS:
        return KEPT, mark
    return None, mark


def _names_frame(name: str) -> bool:
    """Whether a class or id names a part of the page which is not the article."""
    words = name.split("-")
    if len(words) == 1 or name in _DROP_NAMES:
        return name in _DROP_NAMES
    if words[-1] in _DROP_NAMES:
        return words[0] not in _STATES and not (words[-1] == "header" and words[0] in _OF_ARTICLE)
    return words[0] in _DROP_NAMES and words[0] != "header" and all(w in _PLACES or w.isdigit() for w in words[1:])


def parse(text: str | None) -> Page:
    """Blocks and stream of a page; any text parses, also cut or broken markup."""
    page, stack, held, zone = Page(), [], [], OPEN

    def flush() -> None:
        words = "".join(held).split()
        held.clear()
        if not words:
            return
        at = len(page.stream)
        if zone != KEPT:
            page.stream.extend(map(token, words))
        page.blocks.append((zone, " ".join(words), at, len(page.stream)))

    done = 0
    source = text or ""
    for m in _MARKUP.finditer(source):
        if m.start() > done:
            piece = source[done:m.start()]
            held.append(html.unescape(piece) if "&" in piece else piece)
        done = m.end()
        name = m["name"]
        if name is None:
            continue
        name = name.lower()
        if name == "br":
            held.append(" ")
            continue
        block = name in BLOCKS
        if block:
            flush()
        if m["end"]:
            if any(n == name for n, _ in stack):
                flush()
                while stack:
                    n, zone = stack.pop()
                    if n == name:
                        break
                if zone != KEPT:
                    page.stream.append(token(f"</{name}>"))
            continue
        own, mark = _own_zone(name, m["rest"])
        if block and stack and stack[-1][0] == "p":      # a paragraph ends where a block begins
            zone = stack.pop()[1]
        if name == "header" and zone == OPEN:
            own = DROPPED
        if not m["rest"].endswith("/") and (name in _CONTAINERS or own is not None):
            if own is not None and own != zone:
                flush()
            stack.append((name, zone))
            if own == DROPPED or zone == DROPPED:
                zone = DROPPED
            elif own == KEPT and zone != KEPT:
                zone = KEPT
                page.stream.append(-1)
        if zone != KEPT:
            page.stream.append(token(mark))
    if done < len(source):
        piece = source[done:]
        held.append(html.unescape(piece) if "&" in piece else piece)
    flush()
    return page

"""A page as a run of events: tags with their path, texts, gaps.

Tolerant reading: unclosed paragraphs, list items and table parts end where the next one begins, end
tags without a beginning only end the block, a tag cut off at the end of the page is left out,
scripts, styles and other raw elements are no text.
"""

from __future__ import annotations

import re

import xxhash

TOKEN, TEXT, SPACE, BREAK = range(4)
DROPPED, LINK = 1, 2  # flags of an event; from LEVEL on: 0 no main part, 1 main part, 2 article
LEVEL = 4
CLOSED = 0x5BD1E9955BD1E995
LAST_SIBLING = 8  # of equal siblings the eighth and later ones are one token
MASK = (1 << 64) - 1
_SIGNED = 1 << 63

# Names and words of HTML and of common page parts.
RAW = "script style title textarea noscript iframe noembed noframes xmp template"
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup html li main menu nav ol optgroup option p pre search section select summary table tbody tfoot thead tr ul".split()
)
CELL = frozenset(["td", "th"])
PARTS = frozenset("aside button datalist dialog fieldset footer form menu nav search select svg canvas object audio video head".split())
PART_WORDS = frozenset(
    "ad ads advert adverts advertisement advertisements advertising adsense adslot banner banners promo promos promotion sponsor sponsored "
    "nav navbar navigation menu menus breadcrumb breadcrumbs sidebar sidebars aside rail footer masthead topbar toolbar pagination pager "
    "comment comments disqus respond reply replies discussion cookie cookies consent gdpr notice notices alert alerts popup modal overlay "
    "newsletter subscribe subscription signup login search share sharing social related recommended recommendations widget widgets "
    "complementary contentinfo dialog".split()
)
HEADER_WORDS = frozenset(["header"])
COMMENT_WORDS = frozenset("comment comments reply replies respond disqus".split())
MAIN_WORDS = frozenset("article post entry story main content body text".split())
NOT_OWN = frozenset("has no with without hide".split())
#: What ends when one of these begins, and where the search for it stops.
ENDED_BY = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu"])),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "tr": (frozenset(["tr", "td", "th"]), frozenset(["table"])),
    "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "option": (frozenset(["option"]), frozenset(["select", "datalist"])),
    "body": (frozenset(["head"]), frozenset()),
}

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<(?P<raw>{RAW.replace(' ', '|')})\b[^>]*>.*?(?:</(?P=raw)\b[^>]*>|\Z)"
    r"""|<(?P<end>/?)(?P<name>[a-z][^\s/>]*)(?P<attr>(?:[^>"'=]++|=\s*+"[^"]*+"|=\s*+'[^']*+'|["'=])*+)>"""
    r"|<[!?/][^>]*>|<[!?/a-z][^>]*\Z",
    re.DOTALL | re.IGNORECASE,
)
ATTRIBUTE = re.compile(r"""([^\s=>"'/]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+))?""")
NAMING = frozenset(["class", "id", "role", "itemprop", "hidden"])
NAMES_PART = re.compile("class|id|role|itemprop|hidden", re.IGNORECASE)
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_known: dict[tuple[str, str], tuple[str, int, int, bool]] = {}


def _part_of(names: list[str]) -> set[str]:
    """Words of page parts among class names; those behind has-, no-, with- speak of something else."""
    found = set()
    for name in names:
        before = ""
        for word in (w.lower() for w in WORD.findall(name)):
            if before not in NOT_OWN:
                found.add(word)
            before = word
    return found


def _described(name: str, attr: str) -> tuple[str, int, int, bool]:
    """Label, whether dropped, level, and whether dropped outside of an article only."""
    key = (name, attr) if attr and NAMES_PART.search(attr) else (name, "")
    if key in _known:
        return _known[key]
    values: dict[str, str] = {}
    for m in ATTRIBUTE.finditer(key[1]):
        if m[1].lower() in NAMING:
            values.setdefault(m[1].lower(), (m[2] or "").strip("\"'"))
    names = (values.get("class", "") + " " + values.get("id", "") + " " + values.get("role", "")).split()
    words = _part_of(names)
    pure = [n for n in names if (w := [x.lower() for x in WORD.findall(n)]) and MAIN_WORDS.issuperset(w)]
    dropped = name in PARTS or "hidden" in values
    if name not in ("html", "body", "main"):
        dropped |= bool(words & (COMMENT_WORDS if name == "article" else PART_WORDS)) and not pure
    level = 0
    if name == "article" or "articleBody" in values.get("itemprop", ""):
        level = 2
    elif name == "main" or pure and name in BLOCK and name != "body":
        level = 1
    header = name == "header" or bool(words & HEADER_WORDS) and name not in ("html", "body", "main", "article") and not pure
    label = re.sub(r"\d+", "0", " ".join([name, *sorted(names)]))
    if len(_known) > 50_000:
        _known.clear()
    _known[key] = label, int(dropped), level, header
    return _known[key]


def signed(x: int) -> int:
    return x - (1 << 64) if x >= _SIGNED else x


def walk(html: str) -> list[tuple[int, int | str, int]]:
    """Events (kind, path or text, flags) of a page; a beginning or ending element is a token named by its path."""
    events: list[tuple[int, int | str, int]] = []
    stack: list[tuple[str, int, int, int, int]] = []  # name, what held before it, its path
    siblings: list[dict[str, int]] = [{}]
    opened: dict[str, int] = {}
    path, flags, links, at = 0, 0, 0, 0

    def close(to: int) -> None:
        nonlocal path, flags, links
        for name, *_ in stack[to:]:
            opened[name] -= 1
        ended, before, flags_before, links_before, begun = stack[to]
        if ended in BLOCK:
            events.append((TOKEN, signed(begun ^ CLOSED), flags_before))
        elif ended in CELL:
            events.append((SPACE, 0, flags_before))
        path, flags, links = before, flags_before, links_before
        del stack[to:]
        del siblings[to + 1 :]

    for m in TAG.finditer(html):
        begin = m.start()
        if begin > at:
            events.append((TEXT, html[at:begin], flags | (LINK if links else 0)))
        at = m.end()
        name = m["name"]
        if name is None:
            continue
        name = name.lower()
        if m["end"]:
            if opened.get(name):
                close(max(i for i, s in enumerate(stack) if s[0] == name) if stack[-1][0] != name else len(stack) - 1)
            elif name == "a":
                links = max(0, links - 1)
            elif name in BLOCK:
                events.append((BREAK, 0, flags))
            continue
        if name in VOID:
            events.append((BREAK if name == "hr" else SPACE, 0, flags))
            continue
        label, dropped, level, header = _described(name, m["attr"])
        if name not in BLOCK and name not in CELL and not dropped:
            links += name == "a"
            continue
        if name in BLOCK and stack and stack[-1][0] == "p":
            close(len(stack) - 1)
        if name in ENDED_BY:
            ended, stop = ENDED_BY[name]
            if any(opened.get(e) for e in ended):
                i = len(stack) - 1
                last = None
                while i >= 0 and stack[i][0] not in stop:
                    if stack[i][0] in ended:
                        last = i
                    i -= 1
                if last is not None:
                    close(last)
        count = siblings[-1][label] = siblings[-1].get(label, 0) + 1
        role = xxhash.xxh64_intdigest(label, path + min(count, LAST_SIBLING) & MASK)
        stack.append((name, path, flags, links, role))
        siblings.append({})
        opened[name] = opened.get(name, 0) + 1
        path = role
        now = max(flags // LEVEL, level)
        flags = (flags & DROPPED) | dropped | (header and now == 0) | now * LEVEL
        links = 0 if name in BLOCK else links
        if name in BLOCK:
            events.append((TOKEN, signed(path), flags))
        elif name in CELL:
            events.append((SPACE, 0, flags))
    if at < len(html):
        events.append((TEXT, html[at:], flags | (LINK if links else 0)))
    return events

"""Main text of web pages by two-pass block rules.

Markup splits a page into blocks. The first pass decides blocks by their
container, link density, length and stop-word density; the second gives short
and middling blocks the label of their nearest decided neighbours.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass

from pyspark.sql import DataFrame

from panelkit.llm.common import map_text

LENGTH_LOW, LENGTH_HIGH = 70, 200         # characters
STOP_LOW, STOP_HIGH = 0.20, 0.32          # share of stop words
LINKS = 0.5                               # share of characters in links
HEADING_REACH = 200                       # characters from a heading to the text it heads

# Frequent function words.
STOP_WORDS = frozenset("""
the of and to in a is that it for on was with as be by at this are from or an not have but they which
you we he she his her their has had were will would can what there when who all one been if more out so
der die das und in den von zu mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er
hat dass sie nach wird bei einer um am sind noch wie einem über einen so zum war haben nur oder aber vor
le la les de des un une et est que qui dans en du au pour pas sur par plus avec ce il elle ne se sont son
el los las del y una por con no para es al lo como más su sus pero o este ha entre cuando muy sin sobre
""".split())

# Elements by role.
RAW = "script|style|noscript|template|title|textarea|select|svg|iframe|object|canvas|audio|video"
INLINE = frozenset("""
a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small
span strike strong sub sup time tt u var wbr br input
""".split())
CONTENT = frozenset(("article", "main"))
BOILER = frozenset("nav header footer aside form menu dialog button label fieldset".split())
CONTAINERS = frozenset("""
article main nav header footer aside form menu dialog button label fieldset div section ul ol dl table
figure blockquote details body td
""".split())
HINT = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|side-?bar|menu|nav\w*|breadcrumbs?|cookies?|"
    r"consent|notices?|alert|popup|modal|overlay|comments?(?:-?list)?|disqus|respond|replies|footer|header|masthead|"
    r"social|share|sharing|related|recommend\w*|newsletter|subscri\w*|login|search|widget|toolbar|pager|"
    r"pagination|tags|copyright|legal|disclaimer|hidden|noprint)(?:$|[\s_-])", re.IGNORECASE)

# Hints at text that is long and dense by nature, but not the page's own.
OTHERS = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|sponsor\w*|promo\w*|cookies?|consent|notices?|alert|popup|modal|overlay|"
    r"comments?(?:-?list)?|disqus|respond|replies|related|recommend\w*|newsletter|subscri\w*|copyright|legal|disclaimer|hidden|noprint)"
    r"(?:$|[\s_-])", re.IGNORECASE)
# Readers' text, wherever it stands, and closing notices of a page.
READERS = re.compile(r"(?:^|[\s_-])(?:comments?(?:-?list)?|disqus|respond|replies)(?:$|[\s_-])", re.IGNORECASE)
NOTICE = re.compile(r"^\W*(?:©|\(c\)|copyright\b)|\b(?:all rights reserved|alle rechte vorbehalten|"
                    r"tous droits réservés|todos los derechos reservados)\b", re.IGNORECASE)
# Names that say what a container is laid out with, and the headers of an article itself.
MODIFIER = re.compile(r"(?:has|no|with|without|left|right|one|two|three|is|not)[_-]", re.IGNORECASE)
OWN_HEADER = re.compile(r"(?:post|entry|article|story|content|page|title)[_-]+header\b", re.IGNORECASE)

TOKEN = re.compile(
    r"""(?P<empty><svg\b(?:[^>"']|"[^"]*"|'[^']*')*?/>)|"""
    rf"<!--.*?(?:-->|\Z)|<(?P<raw>{RAW})\b.*?(?:</(?P=raw)\s*>|\Z)"
    r"""|<(?P<close>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9]*)(?P<attrs>(?:[^>"']|"[^"]*"|'[^']*')*+)>"""
    r"|<[!?/a-zA-Z][^>]*(?:>|\Z)", re.DOTALL | re.IGNORECASE)
ATTR = re.compile(r"""\b(class|id|role|hidden|style|aria-hidden)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""",
                  re.IGNORECASE)


@dataclass
class Block:
    text: str
    links: int                 # characters inside links
    place: str                 # "content", "boiler", "hint", "others" or ""
    heading: bool
    box: int = 0               # the innermost hinted container
    label: str = ""            # "good", "bad", or "near"/"short" after the first pass


def _role(tag: str, attrs: str, inside: str) -> str:
    """What an opened container makes of its text: "content", "boiler", "hint", "others" or "" (as outside).

    A class or id only hints: "others" where it names text that is not the
    page's own, else "hint". The body takes none.
    """
    if tag == "body":
        return ""
    if tag in CONTENT or inside == "content":
        for m in ATTR.finditer(attrs) if attrs else ():
            if m.group(1).lower() in ("class", "id") and any(
                    READERS.search(n) and not MODIFIER.match(n) for n in (m.group(2) or "").strip("\"'").split()):
                return "boiler"
    if tag in CONTENT:
        return "content"
    if tag in BOILER:
        return "" if tag == "header" and inside == "content" else "boiler"
    hint = ""
    for m in ATTR.finditer(attrs) if attrs else ():
        name, value = m.group(1).lower(), (m.group(2) or "").strip("\"'")
        if name == "role":
            if HINT.search(value):
                return "boiler"
        elif name in ("class", "id"):
            names = [n for n in value.split() if HINT.search(n) and not MODIFIER.match(n) and not OWN_HEADER.match(n)]
            if inside == "content":  # as the element of that name
                names = [n for n in names if n.lower() != "header"]
            if names:
                hint = "others" if any(OTHERS.search(n) for n in names) else hint or "hint"
        elif name == "style":
            if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
                return "boiler"
        elif value.lower() != "false":
            return "boiler"
    return "" if inside == "boiler" else hint


def blocks(page: str | None) -> list[Block]:
    """The non-empty text blocks of a page, in order.

    Unclosed elements end with their container; a tag cut off at the end of
    the page is markup. Inline elements do not split a block, ``br`` is white
    space.
    """
    page = page or ""
    out: list[Block] = []
    stack: list[tuple[str, str, int]] = []   # container, the place it makes and the hinted container it is in
    boxes = 0
    parts: list[str] = []
    links: list[str] = []
    state = {"heading": False, "link": False}

    def flush() -> None:
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            inside = " ".join(html.unescape(" ".join(links)).split())
            place, box = stack[-1][1:] if stack else ("", 0)
            out.append(Block(text, len(inside), place, state["heading"], box))
        parts.clear()
        links.clear()

    def take(piece: str) -> None:
        parts.append(piece)
        if state["link"]:
            links.append(piece)

    at = 0
    for m in TOKEN.finditer(page):
        if m.start() > at:
            take(page[at:m.start()])
        at = m.end()
        tag = (m.group("tag") or "").lower()
        if not tag:
            if m.group("raw") or m.group("empty"):
                take(" ")
            continue
        close = bool(m.group("close"))
        if tag in INLINE:
            if tag == "a":
                state["link"] = not close
            elif tag == "br":
                take(" ")
            continue
        flush()
        state["link"] = False
        state["heading"] = not close and len(tag) == 2 and tag[0] == "h" and tag[1] in "123456"
        if tag in CONTAINERS:
            if close:
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] == tag:
                        del stack[k:]
                        break
            else:
                outer, box = stack[-1][1:] if stack else ("", 0)
                role = _role(tag, m.group("attrs"), outer)
                if role in ("hint", "others"):
                    boxes += 1
                    box = boxes
                stack.append((tag, role or outer, box))
    take(page[at:])
    flush()
    return out


def _stops(text: str) -> float:
    words = text.lower().split()
    return sum(w.strip(".,;:!?()\"'") in STOP_WORDS for w in words) / len(words)


def _heed(bs: list[Block], hint: str, known: bool) -> None:
    """Hinted containers that hold a long dense block are judged by the density rules, the hint set aside."""
    text = {b.box for b in bs if b.place == hint and len(b.text) > LENGTH_HIGH and b.links <= LINKS * len(b.text)
            and (not known or _stops(b.text) >= STOP_HIGH)}
    for b in bs:
        if b.place == hint and b.box in text:
            b.place = ""


def _known(bs: list[Block]) -> bool:
    """Whether the page's longest text has stop words of a listed language; without, they tell nothing of it."""
    longest = max((b for b in bs if b.links <= LINKS * len(b.text)), key=lambda b: len(b.text), default=None)
    return longest is None or len(longest.text) <= LENGTH_HIGH or _stops(longest.text) > 0


def _first_pass(b: Block, known: bool = True) -> str:
    if b.place in ("boiler", "hint", "others"):
        return "bad"
    density = b.links / len(b.text)
    if density > LINKS:
        return "bad"
    length = len(b.text)
    if b.place != "content" and length <= LENGTH_HIGH and NOTICE.search(b.text):
        return "bad"
    if length < LENGTH_LOW or b.heading:
        return "bad" if b.links and b.place != "content" else "short"
    if not known:   # a language without a list: length and links alone
        return "good" if length > LENGTH_HIGH else "near"
    stops = _stops(b.text)
    if stops >= STOP_HIGH:
        return "good" if length > LENGTH_HIGH else "near"
    if stops >= STOP_LOW:
        return "good" if length > LENGTH_HIGH and b.place == "content" else "near"
    return "near" if b.place == "content" else "bad"


def _second_pass(bs: list[Block]) -> None:
    """Undecided blocks take the label of the nearest decided ones around them.

    Blocks of the content container look at each other only, and are good
    where nothing is decided. Elsewhere, two neighbours that disagree make a
    near block good and a short one bad, except a heading with good text
    within reach.
    """
    first = [b.label for b in bs]

    def nearest(k: int, step: int) -> tuple[str, int]:
        way, i = 0, k + step
        while 0 <= i < len(bs) and (bs[k].place != "content" or bs[i].place == "content"):
            if first[i] in ("good", "bad"):
                return first[i], way
            way += len(bs[i].text)
            i += step
        return "", way

    for k, b in enumerate(bs):
        if first[k] in ("good", "bad"):
            continue
        (before, back), (after, ahead) = nearest(k, -1), nearest(k, 1)
        decided = {x for x in (before, after) if x}
        if b.place == "content" and "bad" not in decided:
            b.label = "good"
        elif len(decided) == 1:
            b.label = decided.pop()
        elif not decided:
            b.label = "good" if first[k] == "near" else "bad"
        elif b.heading:
            b.label = "good" if after == "good" and ahead <= HEADING_REACH else "bad"
        elif first[k] == "near" or b.place == "content":
            b.label = "good"
        else:
            b.label = before if back < ahead else after if ahead < back else "bad"


def main_text(page: str | None) -> str:
    """The good blocks of a page, joined by line feeds; empty if there is none.

    Text under a hinted container is judged only where the page has no other,
    first that hinted at as layout, then that hinted at as not the page's own.
    """
    bs = blocks(page)
    known = _known(bs)
    for hint in ("", "hint", "others"):
        if hint:
            _heed(bs, hint, known)
        for b in bs:
            b.label = _first_pass(b, known)
        _second_pass(bs)
        if any(b.label == "good" and len(b.text) >= LENGTH_LOW for b in bs):
            break
    return "\n".join(b.text for b in bs if b.label == "good")


def extract(pages: DataFrame, keep: list[str], html_col: str = "html") -> DataFrame:
    """``keep`` columns, text and n_chars (its code points) of every row's whole page.

    A null or empty page has empty text and 0 characters. Rows are read one by
    one; an empty table gives an empty result; a kept column called text or
    n_chars is replaced.
    """
    keep = [c for c in keep if c not in ("text", "n_chars")]

    def fn(pages: list) -> dict[str, list]:
        texts = [main_text(p) for p in pages]
        return {"text": texts, "n_chars": [len(t) for t in texts]}

    return map_text(pages, keep, html_col, "text string, n_chars long", fn)

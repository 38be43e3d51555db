"""Markup residue in text: kinds present and clean text.

Constructs are recognised by line and span patterns of four languages (HTML,
Markdown, wiki, LaTeX).  Texts that hold markup are cut into blocks that keep
their role (heading, list, code, formula, table, paragraph).  Blocks of
hypertext are then labelled in two passes: first by stop-word density, length
and link density; then ambiguous short blocks take the label of their nearest
decided neighbours.  Blocks labelled as boilerplate are left out of the clean
text; headings, lists, code and formulas of kept blocks stay recognisable in
one plain notation.  Texts without markup are returned as they are.
"""

from __future__ import annotations

import html as _html
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

KINDS = ("html", "markdown", "wiki", "latex")

# Elements of HTML that occur in running text.
TAGS = """a abbr address article aside b big blockquote body br button caption center cite code col dd del details dfn div dl dt em embed
figcaption figure font footer form h1 h2 h3 h4 h5 h6 head header hr html i iframe img input ins kbd label li link main map mark meta nav
ol option p param pre q s samp script section select small span strike strong style sub summary sup table tbody td textarea tfoot th thead
title tr tt u ul var video""".split()

# Stop words of the three languages of the texts.
STOP_WORDS = set(
    """the a an and or but so of in on at to for from by with as if is are was were be been it its this that these those i you he she we they
    my your his her our their me him them not no than then there here when while until because although even though since after before about
    into over under out up down off more most some any all two one has have had do does did would could should can cannot will may which who
    what how der die das und oder aber ist sind war ich wir sie er es ein eine mit von zu auf nicht im am den dem des für als nach bei wie
    el la los las un una y o pero de del en con por para que no es son era se lo le más como hoy sin muy mi su""".split()
)

# All patterns stop at the next sign that could begin the same construct, and pairs of signs are found by ``_pairs``:
# no text makes them look at a sign more than a few times.
_TAG = re.compile(rf"</?(?:{'|'.join(TAGS)})(?:\s[^<>]*|\s*/)?>|<!doctype[^<>]*>", re.I)
_REF = re.compile(r"&(?:#\d{1,7}|#[xX][0-9A-Fa-f]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});")
_REF_NAMES = {k.rstrip(";") for k in _html.entities.html5 if k.endswith(";")}

# Constructs by kind.  Lines: matched at the start of a line.
_FENCE = re.compile(r"^ {0,3}(?:```|~~~)", re.M)
_ATX = re.compile(r"^ {0,3}#{1,6} +\S", re.M)
_SETEXT = re.compile(r"^ {0,3}(?:={3,}|-{3,}) *$", re.M)  # the line before must be a heading's
_QUOTE = re.compile(r"^ {0,3}> ?\S", re.M)
_BULLET = re.compile(r"^ {0,3}[-+*] +\S", re.M)
_ORDERED = re.compile(r"^ {0,3}\d{1,3}[.)] +\S", re.M)
_INDENTED = re.compile(r"(?:\A|\n[ \t]*\n)(?: {4}|\t)[ \t]*\S")
_RULED = re.compile(r"^ *(?:\| *)?:?-{3,}:? *(?:\| *:?-{3,}:? *)+(?:\| *)?$", re.M)
_STRONG = re.compile(r"(?<![\w*\\])\*\*(?=\S)[^*\n]*?\S?\*\*(?!\w)|(?<![\w*\\])\*\*\*(?=\S)[^*\n]+?\*\*\*(?!\w)|(?<![\w_])__(?=[^\s_])[^_\n]+?(?<=\S)__(?!\w)")
_EMPHASIS = re.compile(r"(?<![\w*\\])\*(?=[^\s*])[^*\n]*?(?<=[^\s*])\*(?![\w*])|(?<![\w_\\/])_(?=[^\s_])[^_\n]*?(?<=[^\s_])_(?![\w_])")
_STRUCK = re.compile(r"~~(?=\S)[^~\n]+?(?<=\S)~~")
_CODE = re.compile(r"(?<!`)`(?=[^`\s])[^`\n]*?`(?!`)")
_MD_LINK = re.compile(r"!?\[[^\[\]\n]*\]\((?:<[^<>\n]*>|[^()\s]+)(?:\s+\"[^\"\n]*\")?\)|^\[[^\[\]\n]+\]: +\S+|<https?://[^<>\s]+>", re.M)

_WIKI_LINK = re.compile(r"\[\[[^\[\]\n]+\]\]")
_TEMPLATE = re.compile(r"\{\{[^{}]+\}\}")
_WIKI_TABLE = re.compile(r"^\{\|[^\n]*$|^\|\}", re.M)
_WIKI_HEAD = re.compile(r"^(={2,6}) *[^=\s\n][^\n]*?[^=\s] *\1 *$|^(={2,6}) *[^=\s] *\2 *$", re.M)
_WIKI_BOLD = re.compile(r"''(?:'?)(?=[^'\s])[^'\n]+?'''?(?!\w)")
_WIKI_EXT = re.compile(r"(?<!\[)\[(?:https?|ftp)://[^\s\[\]]+(?: ([^\[\]\n]*))?\](?!\()")
_WIKI_REF = re.compile(r"<ref\b[^<>]*>|__[A-Z]{3,}__|</?nowiki>", re.I)

_TEX_ENV = re.compile(r"\\(?:begin|end)\{[A-Za-z*]+\}")
_TEX_CMD = re.compile(r"\\[a-zA-Z]{2,}\*?(?:\[[^\[\]\n]*\])?\{[^{}\n]*\}|\\item\b")
_TEX_DOLLAR = re.compile(r"\$\$[^$]+\$\$|(?<![\\$\w])\$(?=[^\s$])(?=[^$\n]*[\\^_={])[^$\n]*?(?<=[^\s$])\$(?![\w$])")
_TEX_ESCAPE = re.compile(r"(?<=\w)\\[%&](?=\s|$)|\\[&%$#](?=\s?\w)")

#: A text without any of these signs holds no markup: the cheap tests most texts end with.
_SIGNS = re.compile(r"[<&`*~\[\\$#|{_]")
_LEAD = re.compile(r" {0,3}(?:[-+>]|\d{1,3}[.)])\s?| {4}|\t")
_NEXT_LEAD = re.compile(r"\n(?: {0,3}(?:[-+>]|\d{1,3}[.)])| {4}|\t)")


def _pairs(text: str, begin: str, end: str, *, one_line: bool = False) -> Iterator[tuple[int, int]]:
    """(start, stop) of each stretch from a ``begin`` to the nearest ``end`` after it, without overlaps."""
    at, close = 0, -1
    while (start := text.find(begin, at)) >= 0:
        inner = start + len(begin)
        if close < inner + 1:
            close = text.find(end, inner + 1)
        if close < 0:
            return
        if one_line and (line := text.find("\n", inner, close)) >= 0:
            at = line if text.find(begin, inner, line) < 0 else inner
            continue
        yield start, close + len(end)
        at = close + len(end)


def _setext_heads(text: str) -> Iterator[tuple[int, int, int, str]]:
    """(start, end, stop, sign) of headings whose next line is a rule of = or -."""
    for m in _SETEXT.finditer(text):
        end = m.start() - 1
        if end <= 0:
            continue
        start = text.rfind("\n", 0, end) + 1
        if start < end and text[start] not in "|=>#{" and text[start + 1 : end].strip():
            yield start, end, m.end(), m[0].strip()[0]


def _suspect(text: str) -> bool:
    return bool(
        _SIGNS.search(text) or "''" in text or "==" in text or _LEAD.match(text) or ("\n" in text and ("---" in text or _NEXT_LEAD.search(text)))
    )


def _html_present(text: str) -> bool:
    if "<" in text and (_TAG.search(text) or next(_pairs(text, "<!--", "-->"), None)):
        return True
    if "&" in text and ";" in text:
        return any(m[0][1] == "#" or m[0][1:-1] in _REF_NAMES for m in _REF.finditer(text))
    return False


def kinds_of(text: str | None) -> list[str]:
    """Kinds of which the text holds at least one construct, in the order of ``KINDS``."""
    if not text or not _suspect(text):
        return []
    return [k for k, present in (("html", _html_present), ("markdown", _markdown_present), ("wiki", _wiki_present), ("latex", _latex_present)) if present(text)]


def constructs(text: str) -> set[str]:
    """Names of the constructs found (for inspection and tests)."""
    found = {n for n, p in (_MARKDOWN | _WIKI | _LATEX).items() if p.search(text)}
    more = {"html": _html_present(text), "setext": next(_setext_heads(text), None), "inline": _tex_inline(text)}
    return found | {n for n, there in more.items() if there}


_MARKDOWN = {"fence": _FENCE, "atx": _ATX, "quote": _QUOTE, "bullet": _BULLET, "ordered": _ORDERED, "indented": _INDENTED, "ruled": _RULED, "strong": _STRONG, "emphasis": _EMPHASIS, "struck": _STRUCK, "code": _CODE, "mdlink": _MD_LINK}
_WIKI = {"wlink": _WIKI_LINK, "template": _TEMPLATE, "wtable": _WIKI_TABLE, "whead": _WIKI_HEAD, "wbold": _WIKI_BOLD, "wext": _WIKI_EXT, "wref": _WIKI_REF}
_LATEX = {"env": _TEX_ENV, "cmd": _TEX_CMD, "dollar": _TEX_DOLLAR, "escape": _TEX_ESCAPE}


def _markdown_present(text: str) -> bool:
    return any(p.search(text) for p in _MARKDOWN.values()) or next(_setext_heads(text), None) is not None


def _wiki_present(text: str) -> bool:
    return any(p.search(text) for p in _WIKI.values())


def _tex_inline(text: str) -> bool:
    return "\\" in text and any(next(_pairs(text, a, b, one_line=line), None) for a, b, line in (("\\(", "\\)", True), ("\\[", "\\]", False)))


def _latex_present(text: str) -> bool:
    return any(p.search(text) for p in _LATEX.values()) or _tex_inline(text)


# --- clean text --------------------------------------------------------------------------------

#: Limits of the block rules: characters of a short and of a long block, shares of stop words and of link text.
SHORT, LONG = 70, 200
STOPS_LOW, STOPS_HIGH = 0.15, 0.28
LINKS_HIGH = 0.4
#: A list of linked lines of so many words on average is one of references, not a menu.
MENU_WORDS = 5

_HEAD, _LIST, _CODEBLOCK, _FORMULA, _TABLE, _PARA = "heading", "list", "code", "formula", "table", "paragraph"
#: Stand-ins while a text is rewritten: protected spans, start and end of link text, and the escape of these signs in the text itself.
_HOLD, _LINK_ON, _LINK_OFF, _ESCAPE = "\ue000", "\ue001", "\ue002", "\ue003"
_OWN = re.compile(f"[{_HOLD}-{_ESCAPE}]")
_ESCAPED = re.compile(f"{_ESCAPE}([a-d])")
_HELD = re.compile(f"{_HOLD}(\\d+){_HOLD}")


class _Holder:
    """Spans that later rules must not touch (code and formulas)."""

    def __init__(self) -> None:
        self.spans: list[tuple[str, str]] = []

    def put(self, role: str, content: str, block: bool) -> str:
        self.spans.append((role, content))
        mark = f"{_HOLD}{len(self.spans) - 1}{_HOLD}"
        return f"\n\n{mark}\n\n" if block else mark

    def back(self, text: str) -> str:
        while _HELD.search(text):
            text = _HELD.sub(lambda m: self.shown(int(m[1])), text)
        return text

    def shown(self, n: int) -> str:
        role, content = self.spans[n]
        if role == _CODEBLOCK:
            return f"```\n{content.strip(chr(10))}\n```"
        if role == _FORMULA:
            return f"$${content.strip()}$$"
        if role == "inline code":
            return f"`{content}`"
        return f"${content.strip()}$"


def _replaced(text: str, spans: Iterator[tuple[int, int]], put) -> str:
    """``text`` with each span replaced by what ``put`` makes of it."""
    out, last = [], 0
    for a, b in spans:
        out += [text[last:a], put(text[a:b])]
        last = b
    return "".join(out) + text[last:] if last else text


def _elements(text: str, names: str, put) -> str:
    """``text`` with each closed element of these names replaced by ``put(name, content)``; nested ones of the same name end at the first close."""
    begin = re.compile(rf"<({names})\b[^<>]*>", re.I)
    out, last, closes = [], 0, {}
    for m in begin.finditer(text):
        if m.start() < last:
            continue
        name = m[1].lower()
        close = closes.get(name)
        if close is None or (close and close.start() < m.end()):
            close = closes[name] = re.compile(rf"</{name}\s{{0,20}}>", re.I).search(text, m.end()) or False
        if not close:
            continue
        out += [text[last : m.start()], put(name, text[m.end() : close.start()])]
        last = close.end()
    return "".join(out) + text[last:] if last else text


def _numbered_items(text: str) -> str:
    """List items as lines: numbers in ordered lists, dashes elsewhere."""
    stack: list[int | None] = []

    def line(m: re.Match) -> str:
        name = m[1].lower()
        if name in ("ol", "ul"):
            stack.append(0 if name == "ol" else None)
        elif name in ("/ol", "/ul"):
            if stack:
                stack.pop()
        else:
            if stack and stack[-1] is not None:
                stack[-1] += 1
                return f"\n{stack[-1]}. "
            return "\n- "
        return "\n\n"

    return re.sub(r"<(/?[ou]l|li)\b[^<>]*>[ \t\n]{0,200}", line, text, flags=re.I)


def _without_templates(text: str) -> str:
    """Text without closed {{ }} templates, nested to any depth; unclosed ones stay."""
    begins: list[int] = []
    spans: list[tuple[int, int]] = []
    for m in re.finditer(r"\{\{|\}\}", text):
        if m[0] == "{{":
            begins.append(m.start())
        elif begins:
            a = begins.pop()
            while spans and spans[-1][0] > a:
                spans.pop()
            spans.append((a, m.end()))
    return _replaced(text, iter(spans), lambda _: "")


_TEX_TOKEN = re.compile(r"\\[a-zA-Z]{2,}\*?(?:\[[^\[\]\n]*\])?\{|\\[{}]|[{}]")


def _without_commands(text: str) -> str:
    """Commands replaced by their arguments, nested to any depth; of a link only its text stays, unclosed ones stay as they are."""
    stack: list[tuple[int, bool]] = []  # where its part of ``out`` begins, whether it is a command
    out: list[str] = []
    last, follows = 0, -1
    for m in _TEX_TOKEN.finditer(text):
        out.append(text[last : m.start()])
        last = m.end()
        token = m[0]
        if token in ("\\{", "\\}"):
            out.append(token)
        elif token == "}" and stack:
            place, command = stack.pop()
            if command:
                head = out[place]
                out[place] = ""
                if head.startswith("\\href") and text.startswith("{", last):  # the address goes, its text follows
                    del out[place:]
                    follows = last
            else:
                out.append("}")
        elif token == "}":
            out.append(token)
        else:
            stack.append((len(out), token != "{" or m.start() == follows))
            out.append(token)
    return "".join(out) + text[last:]


def _link(text: str) -> str:
    return f"{_LINK_ON}{text}{_LINK_OFF}"


def _from_html(text: str, hold: _Holder) -> str:
    text = _replaced(text, _pairs(text, "<!--", "-->"), lambda _: " ")
    text = _elements(text, "script|style", lambda _, x: " ")
    strip = lambda x: _html.unescape(_TAG.sub("", x))
    text = _elements(text, "pre", lambda _, x: hold.put(_CODEBLOCK, strip(x), True))
    text = _elements(text, "code|tt|kbd|samp", lambda _, x: hold.put("inline code", strip(x), False))
    text = _elements(text, "h[1-6]", lambda name, x: f"\n\n{'#' * int(name[1])} {' '.join(x.split())}\n\n")
    text = _elements(text, "a", lambda _, x: _link(x))
    text = _numbered_items(text)
    text = re.sub(r"</t[dh]\s{0,20}>\s{0,200}<t[dh]\b[^<>]*>", " | ", text, flags=re.I)
    text = re.sub(r"<t[dh]\b[^<>]*>|</t[dh]\s{0,20}>", "", text, flags=re.I)
    text = re.sub(r"<br\b[^<>]*>|<tr\b[^<>]*>", "\n", text, flags=re.I)
    text = re.sub(r"</?(?:p|div|table|blockquote|section|article|header|footer|nav|main|aside|hr|dl|dd|dt|form)\b[^<>]*>", "\n\n", text, flags=re.I)
    return _html.unescape(_TAG.sub("", text)).replace("\u00a0", " ")


def _from_latex(text: str, hold: _Holder) -> str:
    formula = lambda cut: lambda x: hold.put(_FORMULA, x[cut:-cut], True)
    text = _replaced(text, _pairs(text, "$$", "$$"), formula(2))
    text = _replaced(text, _pairs(text, "\\[", "\\]"), formula(2))
    for name, role in (("equation", _FORMULA), ("align", _FORMULA), ("displaymath", _FORMULA), ("verbatim", _CODEBLOCK), ("lstlisting", _CODEBLOCK)):
        for star in ("", "*"):
            begin, end = f"\\begin{{{name}{star}}}", f"\\end{{{name}{star}}}"
            text = _replaced(text, _pairs(text, begin, end), lambda x, n=len(begin), m=len(end), r=role: hold.put(r, x[n:-m], True))
    text = _replaced(text, _pairs(text, "\\(", "\\)", one_line=True), lambda x: hold.put("math", x[2:-2], False))
    text = _TEX_DOLLAR.sub(lambda m: hold.put("math", m[0].strip("$"), False), text)
    depth = {"part": 1, "chapter": 1, "section": 2, "subsection": 3, "subsubsection": 4, "paragraph": 5, "title": 1}
    text = re.sub(rf"\\({'|'.join(depth)})\*?\{{([^{{}}]*)\}}", lambda m: f"\n\n{'#' * depth[m[1]]} {m[2]}\n\n", text)
    text = re.sub(r"(?<![ \t])[ \t]*\\(?:cite[a-z]*|ref|label|footnotemark|bibliography|vspace|hspace|pagestyle|usepackage|documentclass)\*?(?:\[[^\[\]]*\])*\{[^{}]*\}", "", text)
    text = re.sub(r"(?<![ \t])[ \t]*\\item(?:\[[^\[\]]*\])?[ \t]*", "\n- ", text)
    text = re.sub(r"\\(?:begin|end)\{[^{}]*\}(?:\[[^\[\]]*\])?", "\n\n", text)
    return re.sub(r"\\([%&$#_{}])", r"\1", _without_commands(text))


def _from_wiki(text: str, hold: _Holder) -> str:
    text = re.sub(r"<ref\b[^<>]*/>|</?nowiki>|__[A-Z]{3,}__", "", text, flags=re.I)
    text = _without_templates(_elements(text, "ref", lambda _, x: ""))

    def rows(m: re.Match) -> str:
        out, row = [], []
        for line in m[0].split("\n")[1:]:
            line = line.strip()
            if line.startswith(("|-", "|}", "|+")):
                out, row = (out + [row] if row else out), []
            elif line[:1] in "|!":
                row += [c.strip() for c in re.split(r"\|\||!!", line[1:])]
        out += [row] if row else []
        return "\n\n" + "\n".join("| " + " | ".join(r) + " |" for r in out) + "\n\n"

    text = re.sub(r"^\{\|.*?(?:^\|\}|\Z)", rows, text, flags=re.M | re.S)
    text = _WIKI_HEAD.sub(lambda m: f"\n\n{'#' * len(m[1] or m[2])} {m[0].strip().strip('=').strip()}\n\n", text)
    text = re.sub(r"\[\[(?:[^\[\]|\n]*\|)*([^\[\]|\n]*)\]\]", lambda m: _link(m[1]), text)
    text = _WIKI_EXT.sub(lambda m: _link(m[1] or ""), text)
    return re.sub(r"'{2,5}", "", text)


def _protect_markdown(text: str, hold: _Holder) -> str:
    text = re.sub(r"^ {0,3}(```|~~~)[^\n]*\n(.*?)(?:^ {0,3}\1[^\n]*$|\Z)", lambda m: hold.put(_CODEBLOCK, m[2], True), text, flags=re.M | re.S)
    text = re.sub(r"(?:(?<=\n\n)|\A)(?:(?: {4}|\t)[^\n]*(?:\n|\Z))+", lambda m: hold.put(_CODEBLOCK, re.sub(r"^(?: {4}|\t)", "", m[0], flags=re.M), True), text)
    return re.sub(r"(?<!`)(`+)(?!`)([^\n]+?)(?<!`)\1(?!`)", lambda m: hold.put("inline code", m[2].strip(), False), text)


def _from_markdown(text: str, hold: _Holder) -> str:
    heads = list(_setext_heads(text))
    signs = iter(heads)
    text = _replaced(text, iter([(a, stop) for a, _, stop, _ in heads]), lambda x: f"\n\n{'#' if next(signs)[3] == '=' else '##'} {x[: x.rindex(chr(10))].strip()}\n\n")
    text = re.sub(r"^ {0,3}(#{1,6}) +([^\n]*?)(?: +#+)? *$", r"\n\n\1 \2\n\n", text, flags=re.M)
    text = re.sub(r"^ *(?:\| *)?:?-{3,}:? *(?:\| *:?-{3,}:? *)+(?:\| *)?\n?", "", text, flags=re.M)
    text = re.sub(r"^ {0,3}(?:> ?)+", "", text, flags=re.M)
    text = re.sub(r"^ {0,3}[-+*] +(?=\S)", "- ", text, flags=re.M)
    for _ in range(2):  # an image may be a link's text
        text = re.sub(r"!?\[([^\[\]\n]*)\]\((?:<[^<>\n]*>|[^()\s]+)(?:\s+\"[^\"\n]*\")?\)", lambda m: _link(m[1]), text)
    text = re.sub(r"<(https?://[^<>\s]+)>", lambda m: _link(m[1]), text)
    text = re.sub(r"~~(?=\S)([^~\n]+?)(?<=\S)~~", r"\1", text)
    text = re.sub(r"(?<![\w*\\])(\*{1,3})(?=[^\s*])([^*\n]*?)(?<=\S)\1(?![\w*])", r"\2", text)
    return re.sub(r"(?<![\w_\\/])(_{1,3})(?=[^\s_])([^_\n]*?)(?<=[^\s_])\1(?![\w_])", r"\2", text)


def _blocks(text: str, hold: _Holder) -> list[tuple[str, str]]:
    """(role, content) of the rewritten text's blocks; runs of list items or table rows are one block."""
    out: list[tuple[str, str]] = []
    for chunk in re.split(r"\n[ \t]*\n+", text):
        part: list[str] = []
        role = None
        for line in chunk.split("\n"):
            line = line.rstrip()
            if not line.strip():
                continue
            m = _HELD.fullmatch(line.strip())
            if m and hold.spans[int(m[1])][0] in (_CODEBLOCK, _FORMULA):
                now = hold.spans[int(m[1])][0]
            elif re.match(r"#{1,6} ", line):
                now = _HEAD
            elif re.match(r"- |\d{1,3}[.)] ", line):
                now = _LIST
            elif re.match(r"\|.*\|$", line.strip()):
                now = _TABLE
            else:
                now = _PARA
            if part and (now != role or now == _HEAD):
                out.append((role, "\n".join(part)))
                part = []
            part.append(line)
            role = now
        if part:
            out.append((role, "\n".join(part)))
    return out


def label_blocks(blocks: list[tuple[str, str]]) -> list[bool]:
    """Which blocks to keep, by two passes.

    First each block on its own: much link text or, at more than short length,
    few stop words is boilerplate; many stop words at length is text; what lies
    between stays open, as do short blocks.  Then open blocks take the label of
    the nearest decided block on either side (text, if both are as near or none
    is decided).  Code, formulas, tables and list items are never boilerplate
    for their lack of stop words, only for link text.
    """
    first: list[bool | None] = []
    for role, content in blocks:
        linked = sum(len(x) for x in re.findall(f"{_LINK_ON}(.*?){_LINK_OFF}", content, re.S))
        plain = content.replace(_LINK_ON, "").replace(_LINK_OFF, "")
        words = re.findall(r"[^\W\d_]+", plain.lower())
        stops = sum(w in STOP_WORDS for w in words) / len(words) if words else 0.0
        if linked > LINKS_HIGH * max(1, len(plain)) and not (role in (_LIST, _TABLE) and len(words) >= MENU_WORDS * (plain.count("\n") + 1)):
            first.append(False)
        elif role in (_CODEBLOCK, _FORMULA, _TABLE, _LIST, _HEAD) or len(plain) < SHORT:
            first.append(None)
        elif stops >= STOPS_HIGH and len(plain) > LONG:
            first.append(True)
        elif stops < STOPS_LOW:
            first.append(False)
        else:
            first.append(True if stops >= STOPS_HIGH else None)
    if None not in first:
        return first
    # the nearest decided block below and above each one
    n = len(first)
    below, above = [-1] * n, [n] * n
    for i in range(1, n):
        below[i] = i - 1 if first[i - 1] is not None else below[i - 1]
    for i in range(n - 2, -1, -1):
        above[i] = i + 1 if first[i + 1] is not None else above[i + 1]
    out = []
    for i, x in enumerate(first):
        if x is None:
            near = [j for j in (below[i], above[i]) if 0 <= j < n]
            least = min((abs(j - i) for j in near), default=0)
            x = not near or any(first[j] for j in near if abs(j - i) == least)
        out.append(bool(x))
    return out


def clean_text(text: str | None) -> tuple[str | None, list[str]]:
    """Clean text and the kinds of markup it held; null stays null, text without markup unchanged."""
    kinds = kinds_of(text)
    if not kinds:
        return text, kinds
    hold = _Holder()
    out = _OWN.sub(lambda m: _ESCAPE + "abcd"[ord(m[0]) - ord(_HOLD)], text.replace("\r\n", "\n"))
    if "markdown" in kinds:
        out = _protect_markdown(out, hold)
    if "html" in kinds:
        out = _from_html(out, hold)
    if "latex" in kinds:
        out = _from_latex(out, hold)
    if "wiki" in kinds:
        out = _from_wiki(out, hold)
    if "markdown" in kinds:
        out = _from_markdown(out, hold)
    blocks = _blocks(out, hold)
    keep = label_blocks([(r, hold.back(c)) for r, c in blocks]) if "html" in kinds or "wiki" in kinds else [True] * len(blocks)
    if not any(keep):
        keep = [True] * len(blocks)
    kept = [c for (_, c), k in zip(blocks, keep) if k]
    out = hold.back("\n\n".join(kept)).replace(_LINK_ON, "").replace(_LINK_OFF, "")
    out = re.sub(r"[ \t]{2,}", " ", out) if "```" not in out else out
    return _ESCAPED.sub(lambda m: chr(ord(_HOLD) + ord(m[1]) - ord("a")), out), kinds


def strip_markup(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Clean text and kinds of every row.

    ``columns`` maps result names to string columns: ``text`` is converted, the
    rest is passed through.  Returns those with ``clean`` and ``kinds``.  Null
    gives null and no kinds, '' gives ''; repeated rows stay, other columns are
    dropped first.  Work is per row, without a shuffle.
    """
    ids = [c for c in columns if c != "text"]
    narrow = df.select(*[F.col(columns[c]).alias(f"_{c}") for c in [*ids, "text"]])
    schema = T.StructType(
        [*[T.StructField(f"_{c}", narrow.schema[f"_{c}"].dataType) for c in ids], T.StructField("clean", T.StringType()), T.StructField("kinds", T.ArrayType(T.StringType()))]
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            done = [clean_text(t) for t in batch["_text"]]
            out = batch.drop(columns="_text")
            out["clean"] = [c for c, _ in done]
            out["kinds"] = [k for _, k in done]
            yield out

    return narrow.mapInPandas(run, schema).select(*[F.col(f"_{c}").alias(c) for c in ids], "clean", "kinds")

"""Problem 4: markup residue becomes clean text that keeps headings, lists, code and formulas.

Tag-path ratios: each construct opens a node on a path (``html.body/html.div/html.p``, ``wiki.pesem``,
``latex.verse``). Text length, punctuation and node counts are summed per path over the corpus; the
two ratios are smoothed along the path, fused and compared with a threshold, and nodes of paths under it
go. Headings, paragraphs, lists, table cells, code and formulas never go by a ratio unless they stand in
navigation or the like. Structure survives as Markdown headings, lists, fenced code and TeX formulas.
The languages of a text are those of the nodes its constructs have opened.
"""

from __future__ import annotations

import html
import math
import re
import unicodedata
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import map_batches

#: Paths of the ratio table are cut to this many blocks of the known names below, so the table is bounded.
DEPTH = 4
#: A path goes if its fused ratio is under this share of the text-weighted mean ratio.
CONTENT_SHARE = 0.08
#: Nodes a path must have in the corpus before its ratio is judged; weight of its parent's ratio, in nodes.
LEAST_NODES, SMOOTH = 20, 5.0

#: HTML element names (fixed values).
TAGS = frozenset(
    "a abbr address article aside b base big blockquote body br button caption center cite code col colgroup dd del details dfn dir div dl dt em"
    " fieldset figcaption figure font footer form frame h1 h2 h3 h4 h5 h6 head header hr html i iframe img input ins kbd label legend li link main map"
    " mark math menu meta nav noscript object ol option p param pre q ref s samp script section select small source span strike strong style sub summary sup"
    " table tbody td textarea tfoot th thead time title tr tt u ul var video wbr gallery nowiki references poem".split()
)
_VOID = frozenset("br hr img input link meta base col wbr param source".split())
_BLOCK = frozenset("address article aside blockquote body center dd div dl dt figure footer form head header hr html main nav ol p section table tr ul title style script tbody thead caption poem".split())
_HEADINGS = frozenset("html.h1 html.h2 html.h3 html.h4 html.h5 html.h6".split())
#: Elements within a line: their text belongs to the block around them (fixed values).
_INLINE = frozenset(f"html.{t}" for t in "a abbr b big cite code del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var".split()) | frozenset(
    "wiki.link wiki.quotes wiki.word wiki.category latex.command latex.accent latex.line latex.math markdown.strong markdown.em markdown.link".split()
)
#: Elements that no browser shows (fixed values).
_HIDDEN = frozenset("html.head html.style html.script".split())
#: Elements that hold no running text; inside them every node is judged by its ratio (fixed values).
_CHROME = frozenset(f"html.{t}" for t in "nav aside footer form button select option menu title".split())
#: Blocks of other languages that are judged likewise (fixed values).
_JUDGED = frozenset(("wiki.template", "latex.environment"))
#: Blocks that are content wherever they stand outside those (fixed values).
_CONTENT = _HEADINGS | frozenset(f"html.{t}" for t in "p li td th dt dd caption figcaption pre code blockquote poem".split())
#: LaTeX commands by what becomes of their argument (fixed values).
LATEX_HEADINGS = {"part": 1, "chapter": 1, "section": 2, "subsection": 3, "subsubsection": 4, "paragraph": 5}
LATEX_DROPPED = frozenset("cite citep citet ref pageref label index vspace hspace usepackage documentclass bibliography bibliographystyle includegraphics footnotemark input include".split())
LATEX_OTHERS = frozenset(
    "begin end item textbf textit emph texttt textsc underline footnote ldots dots textendash textemdash quad qquad noindent newline par frac sum sqrt int prod"
    " v c H u k r b d t title author date maketitle caption centering small large left right cdot times leq geq alpha beta gamma lambda pi".split()
)
#: LaTeX accent commands and the combining characters they stand for (fixed values).
ACCENTS = {"v": "̌", "c": "̧", "H": "̋", "u": "̆", "k": "̨", "r": "̊", "'": "́", "`": "̀", '"': "̈", "^": "̂", "~": "̃", "=": "̄", ".": "̇"}

_TAG = re.compile(r"<(/?)([A-Za-z][A-Za-z0-9]*)((?:\s+[^<>]*)?)(/?)>")
_COMMENT = re.compile(r"<!--.*?(?:-->|\Z)", re.S)
_REFERENCE = re.compile(r"&(?:[A-Za-z][A-Za-z0-9]{1,15}|#[0-9]{2,6}|#[xX][0-9A-Fa-f]{2,5});")
_COMMAND = re.compile(r"\\([A-Za-z]+)\*?")
_MATH = re.compile(r"\\\[.*?\\\]|\\\(.*?\\\)|\$\$[^$]+\$\$|\$(?!\d+\s)(?=[^$\n]*[\\^_={])[^$\n]+\$", re.S)
_ACCENT = re.compile(r"\\([vcHukr])\s*\{(\\?[A-Za-z])\}|\\([vcHukr])\s+([A-Za-z])(?![A-Za-z])|\\(['`\"^~=.])\s*\{?(\\?[A-Za-z])\}?")
_LINE_END = re.compile(r"\\\\(?:\[[^\]\n]*\])?[ \t]*$", re.M)
_WIKI = re.compile(r"\{\{[^{}\n]|\}\}|\[\[[^\[\]\n]|\]\]|'{2,5}(?=[^'\s])|^(={1,6})[^=\n].*?\1[ \t]*$|^\{\|[^\n]*$|^\|\}[^\n]*$|^\|-+(?:[ \t]+\w+ ?=[^\n]*)?[ \t]*$|\[(?:https?|ftp)://[^\s\]]+ [^\]\n]*\]|__[A-ZČŠŽ]{4,}__", re.M)
_MARKDOWN = re.compile(
    r"^#{1,6} +\S|^\S.*\n(?:={3,}|-{3,})[ \t]*$|\*\*(?=\S)[^*\n]+\*\*|!?\[[^\[\]\n]+\]\([^()\s]+\)|^(?:```|~~~)|^\|[ :\-|]*-{3}[ :\-|]*\|[ \t]*$|\[\^[\w]+\]"
    r"|(?<![\w_/])_(?=[^\W_])[^_\n]*[^\s_]_(?![\w_])|(?<!`)`[^`\n]+`(?!`)|(?:\A|\n\n)(?:> (?!\d+\b)\S[^\n]*|[-*+] (?![\d ]+-$)[^\n]+|1\. [^\n]+\n2\. [^\n]+)(?=\n|\Z)",
    re.M,
)
_HINT = re.compile(r"[<&\\{}\[`>#$~]|\*\*|''|==|--|__|(?<!\w)_\w|^[-+*|] ?|^1\. ", re.M)
_PUNCT = re.compile(r"[.,!?…»«]")
_CELL = re.compile(r"^[^|\[\]\n]*=[^|\[\]\n]*\|(?!\|)")


def _known_command(name: str) -> bool:
    return name in LATEX_OTHERS or name in LATEX_HEADINGS or name in LATEX_DROPPED


def syntaxes(text: str) -> list[str]:
    """The markup languages whose constructs ``text`` may hold; a text is parsed for these."""
    found = []
    if "<" in text and ("<!--" in text or any(m[2].lower() in TAGS for m in _TAG.finditer(text))) or "&" in text and any(html.unescape(m[0]) != m[0] for m in _REFERENCE.finditer(text)):
        found.append("html")
    if _MARKDOWN.search(text):
        found.append("markdown")
    if _WIKI.search(text):
        found.append("wiki")
    if "\\" in text and (any(_known_command(m[1]) for m in _COMMAND.finditer(text)) or _LINE_END.search(text) or _ACCENT.search(text)) or ("$" in text or "\\" in text) and _MATH.search(text):
        found.append("latex")
    return found


class _Sink:
    """Writes nodes of constructs into a text as marks: ``\x01name\x02 ... \x03``; code and formulas are set aside unread."""

    def __init__(self):
        self.kept: list[tuple[str, str]] = []

    def keep(self, name: str, text: str) -> str:
        self.kept.append((name, text))
        return f"\x00{len(self.kept) - 1}\x00"

    @staticmethod
    def node(name: str, text: str = "") -> str:
        return f"\x01{name}\x02{text}\x03"


def _fence(code: str, language: str = "") -> str:
    return f"\n\n```{language}\n{code.strip(chr(10))}\n```\n\n"


class Piece(NamedTuple):
    """A leaf: its block path, the node it belongs to, its text, and whether it stays (True), goes (False) or is judged (None)."""

    path: str
    node: int
    text: str
    stays: bool | None


def parse(text: str, proposed: list[str]) -> tuple[list[Piece], set[str]]:
    """Leaves of ``text`` in order, with structure already written as Markdown, and the languages of its nodes."""
    sink = _Sink()
    text = re.sub("[\x00-\x03]", "", text)
    if "markdown" in proposed:
        text = re.sub(r"^(```|~~~)(\w*)\n(.*?)(?:^\1[ \t]*$|\Z)", lambda m: sink.keep("markdown.code", _fence(m[3], m[2])), text, flags=re.M | re.S)
        text = re.sub(r"(?<!`)`([^`\n]+)`(?!`)", lambda m: sink.keep("markdown.code", m[0]), text)
    if "html" in proposed:
        text = re.sub(r"<pre\b[^<>]*>(.*?)</pre\s*>", lambda m: sink.keep("html.pre", _fence(html.unescape(re.sub(r"</?\w[^<>]*>", "", m[1])))), text, flags=re.S | re.I)
        text = _COMMENT.sub(sink.node("html.comment"), text)
    if "latex" in proposed:
        text = re.sub(r"\\begin\{(verbatim|lstlisting)\}(.*?)(?:\\end\{\1\}|\Z)", lambda m: sink.keep("latex.code", _fence(m[2])), text, flags=re.S)
        text = _MATH.sub(lambda m: sink.keep("latex.math", m[0]), text)
        text = _latex(text, sink)
    if "wiki" in proposed:
        text = _wiki(text, sink, "markdown" not in proposed)
    if "markdown" in proposed:
        text = _markdown(text, sink)
    return _walk(text, sink, "html" in proposed)


def _walk(text: str, sink: _Sink, tags: bool) -> tuple[list[Piece], set[str]]:
    """Leaves between the tags and marks of ``text``.

    Wrongly nested tags are mended: any heading's end closes a heading, a block that opens closes lines,
    headings and paragraphs above it, items and cells close their like, and an end that fits nothing is none.
    """
    out: list[Piece] = []
    languages: set[str] = set()
    #: Open nodes as (name, number); a mark's node ends at its own mark only.
    path: list[tuple[str, int]] = [("text", 0)]
    count, last = 0, 0
    #: Of each open list, its running number, or None if it has no numbers; whether the row has a cell already.
    lists: list[int | None] = []
    cells = False

    def opened(name: str) -> None:
        nonlocal count
        count += 1
        path.append((name, count))
        languages.add(name.partition(".")[0])

    def close_while(names: frozenset[str]) -> None:
        while path[-1][0] in names:
            path.pop()

    def add(piece: str, stays: bool | None = None) -> None:
        if not piece:
            return
        if tags and "&" in piece and stays is None and (plain := html.unescape(piece)) != piece:
            languages.add("html")
            piece = plain
        blocks = [(n, i) for n, i in path[1:] if n not in _INLINE] or path[:1]
        names = {n for n, _ in blocks}
        if stays is None:
            stays = False if names & _HIDDEN else None if names & _CHROME else True if names & _CONTENT or any(n.startswith(("wiki", "latex", "markdown")) for n in names - _JUDGED) else None
        elif names & _HIDDEN:
            stays = False
        out.append(Piece("/".join(n for n, _ in blocks[:DEPTH]), blocks[-1][1], piece, stays))

    token = re.compile(r"\x01([^\x02]*)\x02|\x03|\x00(\d+)\x00" + ("|" + _TAG.pattern if tags else ""))
    for m in token.finditer(text):
        sign = m[0][0]
        if sign == "<" and m[4].lower() not in TAGS:
            continue
        add(text[last : m.start()])
        last = m.end()
        if sign == "\x01":
            opened(m[1])
        elif sign == "\x03":
            at = max((k for k, (n, _) in enumerate(path) if not n.startswith("html.") or n == "html.comment"), default=0)
            if at:
                del path[at:]
        elif sign == "\x00":
            name, kept = sink.kept[int(m[2])]
            opened(name)
            add(kept, True)
            path.pop()
        else:
            name, closing = m[4].lower(), m[3] == "/"
            step = f"html.{name}"
            languages.add("html")
            same = _HEADINGS if step in _HEADINGS else {step}
            if closing:
                at = max((k for k, (n, _) in enumerate(path) if n in same), default=0)
                # A mark's node keeps what it holds: tags don't close through it.
                if at and all(n.startswith("html.") for n, _ in path[at:]):
                    del path[at:]
            elif name not in _VOID and not m[6]:
                if name == "body":
                    close_while(frozenset({"html.head", "html.title", "html.style", "html.script"}))
                if step not in _INLINE:
                    close_while(_INLINE | _HEADINGS | {"html.p", "html.style", "html.script"})
                if name in ("li", "td", "th", "tr", "dt", "dd", "option"):
                    like = {"td": {"html.td", "html.th"}, "th": {"html.td", "html.th"}, "tr": {"html.tr", "html.td", "html.th"}, "dt": {"html.dt", "html.dd"}, "dd": {"html.dt", "html.dd"}}.get(name, {step})
                    close_while(frozenset(like))
                opened(step)
            before = ""
            if name in ("ol", "ul"):
                if closing:
                    del lists[-1:]
                else:
                    lists.append(0 if name == "ol" else None)
            elif name == "tr":
                cells = False
            if name in ("td", "th"):
                before = " | " if not closing and cells else ""
                cells = True
            elif name == "li" and not closing and lists and lists[-1] is not None:
                lists[-1] += 1
                before = f"\n{lists[-1]}. "
            else:
                before = _written(name, closing)
            if before:
                out.append(Piece("", 0, before, False if any(n in _HIDDEN for n, _ in path) else True))
    add(text[last:])
    return out, languages


def _written(name: str, closing: bool) -> str:
    """What an HTML tag leaves in the text."""
    if name == "br":
        return "\n"
    if re.fullmatch("h[1-6]", name):
        return "\n\n" if closing else "\n\n" + "#" * int(name[1]) + " "
    if name == "li":
        return "\n" if closing else "\n- "
    if name == "tr":
        return "\n"
    return "\n\n" if name in _BLOCK else ""


def _until_done(pattern: str, into, text: str, flags: int = 0) -> str:
    """Substitute, innermost constructs first, until nothing matches; every step takes a construct's brackets away."""
    compiled = re.compile(pattern, flags)
    n = 1
    while n:
        text, n = compiled.subn(into, text)
    return text


def _latex(text: str, sink: _Sink) -> str:
    def accent(m: re.Match) -> str:
        mark, letter = (m[1], m[2]) if m[1] else (m[3], m[4]) if m[3] else (m[5], m[6])
        return sink.node("latex.accent", unicodedata.normalize("NFC", letter.lstrip("\\") + ACCENTS[mark]))

    text = _ACCENT.sub(accent, text)
    # A percent sign behind a number is none of a comment.
    text = re.sub(r"(?<![\\\d])(?<!\d )% ?[^\n]*$", "", text, flags=re.M)
    text = _LINE_END.sub(sink.node("latex.line"), text)
    text = re.sub(r"\\begin\{(\w+)\*?\}(?:\[[^\]\n]*\])?", lambda m: f"\n\n\x01latex.{m[1] if m[1] in ('itemize', 'enumerate', 'verse', 'quote', 'center', 'document') else 'environment'}\x02", text)
    text = re.sub(r"\\end\{\w+\*?\}", "\x03\n\n", text)
    text = re.sub(r"\\item\s*(?:\[([^\]\n]*)\])?\s*", lambda m: sink.node("latex.item") + "\n- " + (m[1] + " " if m[1] else ""), text)

    def command(m: re.Match) -> str:
        name, body = m[1], m[2]
        if name in LATEX_HEADINGS:
            return "\n\n" + sink.node("latex.heading", "#" * LATEX_HEADINGS[name] + f" {body}") + "\n\n"
        if name in LATEX_DROPPED:
            return sink.node("latex.command")
        # An unknown command stands as it is, with brackets that are set aside while the others are opened.
        return sink.node("latex.footnote" if name == "footnote" else "latex.command", body) if _known_command(name) else m[0].replace("{", "\x04").replace("}", "\x05")

    text = _until_done(r"\\([A-Za-z]+)\*?(?:\[[^\]\n]*\])?\{([^{}]*)\}", command, text).replace("\x04", "{").replace("\x05", "}")
    text = re.sub(r"\\(?:ldots|dots)(?:\{\})?", sink.node("latex.command", "…"), text)
    return re.sub(r"\\([A-Za-z]+)(?:\{\})?[ \t]?", lambda m: sink.node("latex.command") if _known_command(m[1]) else m[0], text)


#: Template names that keep a node of their own; all others share one. Words that only place a picture (fixed values).
TEMPLATES = frozenset("naslov pesem opomba citat verz avtor poem quote".split())
_PLACING = re.compile(r"\s*(?:thumb|sličica|frame|okvir|right|desno|left|levo|center|sredina|none|upright|\d*x?\d+px|\w+=.*)\s*", re.I)


def _wiki(text: str, sink: _Sink, numbered: bool) -> str:
    node = sink.node
    text = re.sub(r"__[A-ZČŠŽ]{4,}__", node("wiki.word"), text)
    text = re.sub(r"'{2,5}", node("wiki.quotes"), text)

    def link(m: re.Match) -> str:
        head, *parts = m[1].split("|")
        if re.match(r"\s*(?:Kategorija|Category)\s*:", head):
            return node("wiki.category")
        if re.match(r"\s*(?:Slika|Datoteka|File|Image)\s*:", head):
            return node("wiki.picture", next((p for p in reversed(parts) if not _PLACING.fullmatch(p)), ""))
        return node("wiki.link", (parts or [head])[-1])

    text = _until_done(r"\[\[(?!\[)((?:(?!\[\[|\]\])[^\n])*)\]\]", link, text)
    text = re.sub(r"\[(?:https?|ftp)://\S+ ([^\]\n]*)\]", lambda m: node("wiki.link", m[1]), text)
    text = re.sub(r"^(={1,6})[ \t]*([^=\n].*?)[ \t]*\1[ \t]*$", lambda m: node("wiki.heading", "#" * len(m[1]) + " " + m[2]), text, flags=re.M)
    if numbered:
        text = re.sub(r"^\*+[ \t]+(?=\S)", "- ", text, flags=re.M)

    def template(m: re.Match) -> str:
        # A template's name is its node; the names of its values are attributes, addresses aren't text.
        name, values = m[1].lower(), _values(m[2] or "")
        return node(f"wiki.{name if name in TEMPLATES else 'template'}", "# " + values if name == "naslov" and values else values)

    text = _until_done(r"\{\{\s*([^{}|\n]+?)\s*(?:\|([^{}]*))?\}\}", template, text)
    text = _until_done(r"^\{\|[^\n]*\n((?:(?!^\{\||^\|\}).)*)^\|\}", lambda m: node("wiki.table", _rows(m[1])), text, re.M | re.S)
    if m := re.search(r"^\{\|[^\n]*\n?", text, re.M):
        text = text[: m.start()] + node("wiki.table", _rows(text[m.end() :]))
    text = re.sub(r"^\|-+(?:[ \t]+\w+ ?=[^\n]*)?[ \t]*$|^\|\}", node("wiki.table"), text, flags=re.M)
    return re.sub(r"\[\[|\]\]|\{\{|\}\}", node("wiki.stray"), text)


def _rows(body: str) -> str:
    """Rows of a wiki table, cells parted by bars; a cell may go over lines."""
    out: list[list[str]] = [[]]
    for line in body.split("\n"):
        if line.startswith("|-"):
            out.append([])
        elif line[:1] in ("|", "!"):
            for cell in re.split(r"\|\||!!", line[2 if line.startswith("|+") else 1 :]):
                out[-1].append(_CELL.sub("", cell).strip())
        elif out[-1]:
            out[-1][-1] += "\n" + line
        elif line.strip():
            out[-1].append(line)
    return "\n".join(" | ".join(cells).rstrip() for cells in out if cells) + "\n"


def _values(body: str) -> str:
    values = [re.sub(r"^\s*\w+\s*=\s*", "", v) for v in body.split("|")]
    return " ".join(v for v in values if v.strip() and not re.fullmatch(r"\s*(?:https?|ftp)://\S+\s*", v))


def _markdown(text: str, sink: _Sink) -> str:
    node = sink.node
    text = re.sub(r"^(\S[^\n]*)\n(={3,}|-{3,})[ \t]*$", lambda m: node("markdown.heading", ("# " if m[2][0] == "=" else "## ") + m[1]), text, flags=re.M)
    text = re.sub(r"^(#{1,6} +[^\n]*?)(?: +#+)?[ \t]*$", lambda m: node("markdown.heading", m[1]), text, flags=re.M)
    text = re.sub(r"^\[\^\w+\]:[ \t]*([^\n]*)$", lambda m: node("markdown.footnote", m[1]), text, flags=re.M)
    text = re.sub(r"\[\^\w+\]", node("markdown.footnote"), text)
    text = re.sub(r"!\[([^\[\]\n]*)\]\([^()\s]+\)", lambda m: node("markdown.picture", m[1]), text)
    text = re.sub(r"\[([^\[\]\n]+)\]\([^()\s]+\)", lambda m: node("markdown.link", m[1]), text)
    text = re.sub(r"\*\*(?=\S)([^*\n]+)\*\*", lambda m: node("markdown.strong", m[1]), text)
    text = re.sub(r"(?<![\w_/])_(?=[^\W_])([^_\n]*[^\s_])_(?![\w_])", lambda m: node("markdown.em", m[1]), text)
    text = re.sub(r"^> ?", node("markdown.quote"), text, flags=re.M)
    text = re.sub(r"^(?=[-*+] |\d{1,3}\. )", node("markdown.item"), text, flags=re.M)
    text = re.sub(r"^(?:```|~~~)[ \t]*\w*$", node("markdown.code"), text, flags=re.M)
    text = re.sub(r"^\|[ :\-|]*-{3}[ :\-|]*\|[ \t]*\n?", node("markdown.table"), text, flags=re.M)
    return re.sub(r"^\| *(.*?) *\|[ \t]*$", r"\1", text, flags=re.M)


def path_table(df: DataFrame, text: str = "text") -> DataFrame:
    """``path``, ``nodes``, ``chars``, ``punctuation`` summed over the corpus, map side first; blank nodes don't count."""

    def make():
        def step(texts):
            sums: dict[str, list[int]] = {}
            for t in texts:
                if t and _HINT.search(t) and (proposed := syntaxes(t)):
                    own: dict[tuple[str, int], list[int]] = {}
                    for path, node, piece, _ in parse(t, proposed)[0]:
                        if path and (bare := piece.strip()):
                            s = own.setdefault((path, node), [0, 0])
                            s[0] += len(bare)
                            s[1] += len(_PUNCT.findall(bare))
                    for (path, _), (chars, punctuation) in own.items():
                        s = sums.setdefault(path, [0, 0, 0])
                        s[0] += 1
                        s[1] += chars
                        s[2] += punctuation
            return {"path": list(sums), **{c: [s[i] for s in sums.values()] for i, c in enumerate(("nodes", "chars", "punctuation"))}}

        return step

    rows = map_batches(df.select(text), "path string, nodes bigint, chars bigint, punctuation bigint", make)
    return rows.groupBy("path").agg(*(F.sum(c).alias(c) for c in ("nodes", "chars", "punctuation")))


def dropped_paths(table: list[tuple[str, int, int, int]]) -> frozenset[str]:
    """Paths of enough nodes whose smoothed and fused text and punctuation ratios stay under the threshold."""
    own = {p: (n, c / n, u / n) for p, n, c, u in table if n}
    fused = {}
    for path, (n, c, u) in own.items():
        _, pc, pu = own.get(path.rpartition("/")[0] or "text", (0, c, u))
        w = n / (n + SMOOTH)
        fused[path] = math.sqrt((w * c + (1 - w) * pc) * (0.05 + w * u + (1 - w) * pu))
    # Text between constructs is no node of theirs and sets no measure.
    inside = [(p, c) for p, n, c, _ in table if n and p != "text"]
    mean = sum(fused[p] * c for p, c in inside) / (sum(c for _, c in inside) or 1)
    return frozenset(p for p, f in fused.items() if f < CONTENT_SHARE * mean and own[p][0] >= LEAST_NODES) - {"text"}


def cleaner(dropped: frozenset[str] = frozenset()):
    """Function from a text to (clean text, its markup languages); nodes on ``dropped`` paths that nothing protects go."""

    def clean(text: str | None) -> tuple[str | None, list[str]]:
        if not text or not _HINT.search(text):
            return text, []
        proposed = syntaxes(text)
        if not proposed:
            return text, []
        parts, languages = parse(text, proposed)
        joined = "".join(p.text for p in parts if p.stays or p.stays is None and p.path not in dropped)
        joined = re.sub(r"[ \t]+$", "", joined, flags=re.M)
        return re.sub(r"\n{3,}", "\n\n", joined).strip(), [x for x in proposed if x in languages]

    return clean


def clean_markup(df: DataFrame, key: str = "row_id", text: str = "text") -> DataFrame:
    """``key``, clean ``text``, ``syntaxes`` (array of html, markdown, wiki, latex) of every row.

    Texts without markup, empty and null ones come out as they are; an empty table gives no rows;
    repeated rows are kept. What no browser shows (head, style, script, comments), names of templates and
    attributes go, and nodes on paths whose ratios are low. The path table sent to workers has at most
    (known names)^DEPTH rows, in practice some hundred; texts are read twice and never shuffled.
    """
    dropped = dropped_paths([tuple(r) for r in path_table(df, text).collect()])

    def make():
        clean = cleaner(dropped)

        def step(keys, texts):
            done = [clean(t) for t in texts]
            return {key: keys, "text": [d[0] for d in done], "syntaxes": [d[1] for d in done]}

        return step

    return map_batches(df.select(key, text), f"{key} {df.schema[key].dataType.simpleString()}, text string, syntaxes array<string>", make)

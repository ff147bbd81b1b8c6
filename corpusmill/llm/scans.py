"""Problem 3: text of scanned pages becomes continuous paragraphs.

The lines of a text are one stream of tokens, decoded jointly. Its lattice has these edges: a token stands
as it is; it is read with misread characters; tokens parted by a blank are one word (the blank goes); a
token is several words run together; tokens parted by a division mark and a line break are one word; a
line that looks like page furniture is skipped. Within a stretch of tokens one dynamic program over the
characters finds the words, with gaps, missing gaps and confusions all at once; over the tokens a second
one chooses the edges. The kinds of damage are read off the chosen path. Paragraph boundaries are then
chosen by dynamic programming over the lines. Costs are logarithms of shares of documents, so they are the
same at every size of the table; vocabulary sizes are bounded as :mod:`.lexicon` explains.
"""

from __future__ import annotations

import bisect
import math
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import Memo, map_batches
from .lexicon import Lexicon, lexicon
from .lookalikes import _UNUSUAL, by_table

#: What a scan puts for what stands on paper (fixed values).
MISREAD = {
    "1": ("l", "i"), "!": ("i", "l"), "|": ("l", "i"), "0": ("o",), "5": ("s",), "6": ("b", "g"), "9": ("g",), "8": ("b",), "†": ("t",), "(": ("č", "c"), "ö": ("č",), "ß": ("š", "b"), "z'": ("ž",),
    "rn": ("m",), "ni": ("m",), "in": ("m",), "m": ("rn", "in", "ni"), "cl": ("d",), "d": ("cl",), "c": ("e",), "e": ("c",), "u": ("n",), "n": ("u",), "y": ("v",), "b": ("h",), "h": ("b", "li"), "li": ("h",), "vv": ("w",), "ii": ("u",), "f": ("t",), "l": ("i",),
}
#: Those that are no letters of Slovene words: they prove a misreading by themselves (fixed value).
_SIGNS = frozenset("1!|05698†(öß'")
#: How much more frequent the read word must be than what stands there; the cost of a misread place says the same.
RATIO = 25
PLACE_COST = math.log(RATIO)
#: Letters (not signs) that a word may have misread; extra cost of such a place for each letter a word has fewer than 4.
LETTER_PLACES, SHORT_COST = 1, 4.0
#: Cost of words run together: once, and for each gap; of a blank inside a word; of joining over a division mark; of joining a link word to something unknown.
RUN_COST, GAP_COST, BLANK_COST, JOIN_COST, LINK_COST = 5.5, 2.5, 8.6, 0.5, 12.0
#: Most blanks inside one word.
MOST_BLANKS = 2
#: Cost of an unknown word as it is: once, for each letter, for each letter beyond ten, for each sign in it.
UNKNOWN_COST, LETTER_COST, LONG_COST, SIGN_COST = 9.4, 1.5, 2.0, 4.0
#: Letters of an unknown word among words run together.
AMONG = (3, 10)
#: Cost of each letter of an unknown word beyond its own where words are known to run together.
TOGETHER_COST = 1.2
#: Lines this wide aren't lines of a page but paragraphs.
WIDEST = 200
#: Division marks (fixed value).
MARKS = "-¬­⸗‐"

_NUMBER = re.compile(r"[-–—\[(·*=~ ]*\d(?: ?\d){0,3}[-–—\])·*=~ ]*")
_PAGE = re.compile(r"(?:stran|str\.|page|seite) ?\d{1,4}\.?", re.I)
_HEADER = re.compile(r"\d{1,4} {3,}\S.{0,60}|\S.{0,70} {3,}\d{1,4}\*?|\S.{2,70}\. +\d{1,4}\*")
_RUNNING = re.compile(r"[^\W\d_][\w'-]+[:,] [^.!?]{2,60}\.(?: [IVXLC]+\.)?")
_UNSEEN = re.compile("[​‌‍⁠﻿]")
_DIVIDED = re.compile(rf"([^\W\d_]+)[{MARKS}] ?\Z")
_EDGE = ".,;:?»«›‹)[]{}\"„“”‚‘’–—-…/*_#<>=·­¬"
_BLANKS = re.compile(r"(\s+)")
_SUSPECT = re.compile(r"[^\W\d_]")


def furniture(lines: list[str]) -> list[bool]:
    """Of each line, whether it is a page number or running header.

    A number alone in its line, a header set apart from its number, the line at the top of a new page
    after a numbered one, and ``Name: Title.`` right after a page number are furniture; chapter
    numerals, speakers and numbers with a full stop are not.
    """
    out, numbered = [], False
    for line in lines:
        text = _UNSEEN.sub("", line).replace("\xa0", " ").replace(" ", " ").replace(" ", " ")
        new_page = "\x0c" in text
        text = text.replace("\x0c", "").strip()
        if not text:
            out.append(False)
            continue
        is_number = bool(_NUMBER.fullmatch(text) or _PAGE.fullmatch(text))
        header = bool(
            new_page and numbered and len(text) <= 80
            or _HEADER.fullmatch(text) and (text[0].isdigit() and text.split(None, 1)[1].isupper() or text.endswith("*") or re.sub(r"[\d\s]+$", "", text).isupper())
            or numbered and _RUNNING.fullmatch(text) and not text[0].islower()
        )
        out.append(is_number or header)
        numbered = is_number
    return out


class Reader:
    """Decodes streams of tokens against the vocabulary."""

    def __init__(self, words: Lexicon):
        self.words = words
        self.total = sum(words.words.values()) or 1
        self.order = sorted(words.words)
        self.begins = Memo(self._begins)
        self.decoded = Memo(self._decode)
        self.together = Memo(lambda text: self._decode(text, True))
        self.single = Memo(self._single)

    def weight(self, word: str) -> int:
        return self.words.get(word)

    def as_is(self, word: str) -> float:
        """Cost of a word in lower case as it stands."""
        w = self.weight(word)
        if w:
            return math.log(self.total / w)
        return UNKNOWN_COST + LETTER_COST * len(word) + LONG_COST * max(0, len(word) - 10) + SIGN_COST * sum(c in _SIGNS for c in word)

    def _begins(self, start: str) -> bool:
        at = bisect.bisect_left(self.order, start)
        return at < len(self.order) and self.order[at].startswith(start)

    def words_at(self, text: str, start: int) -> list[tuple[float, int, str, int]]:
        """Vocabulary words that ``text`` may hold from ``start`` on: cost, end, word, evidence of misreading.

        Signs may be misread without limit, letters in ``LETTER_PLACES`` places, and blanks may stand inside.
        """
        out = []
        #: (word so far, place in the text, letters misread, signs misread, blanks passed)
        states = [("", start, 0, 0, 0)]
        while states:
            done, at, letters, signs, blanks = states.pop()
            if done and text[at - 1] != " " and (w := self.weight(done)):
                # Words of one letter lean on the next word, so none ends a token.
                if len(done) > 1 or not start or text[start - 1] == " " or at < len(text) and text[at] != " ":
                    short = SHORT_COST * letters * max(0, 4 - len(done))
                    out.append((math.log(self.total / w) + PLACE_COST * (letters + signs) + short + BLANK_COST * blanks, at, done, 2 if signs else 1 if letters else 0))
            if at == len(text):
                continue
            c = text[at]
            if c == " ":
                if done and blanks < MOST_BLANKS:
                    states.append((done, at + 1, letters, signs, blanks + 1))
                continue
            if c not in _SIGNS and self.begins[done + c]:
                states.append((done + c, at + 1, letters, signs, blanks))
            for span in (2, 1):
                piece = text[at : at + span]
                sign = any(x in _SIGNS for x in piece)
                for to in MISREAD.get(piece, ()) if len(piece) == span and (sign or letters < LETTER_PLACES) else ():
                    if self.begins[done + to]:
                        states.append((done + to, at + span, letters + (not sign), signs + sign, blanks))
        return out

    def _decode(self, text: str, together: bool = False) -> tuple[float, list[tuple[int, int, str]], int] | None:
        """Cost, words (start, end, word) and evidence of misreading of a stretch in lower case; None if as it is it's likelier.

        With ``together``, it stands in a token of which is known that its words run together.
        """
        n = len(text)
        if not _ALPHABET.fullmatch(text):
            return None
        # A bar between words divides cells, it isn't a letter.
        if "|" in text and any(len(x) > 2 and self.weight(x) for x in re.split(r"[| ]", text)):
            return None
        least = sum(self.as_is(t) for t in text.split(" ")) + (TOGETHER_COST * n if together else 0.0)
        first_gap = GAP_COST + (0.0 if together else RUN_COST)
        #: Two layers: no gap so far, and some gap.
        cost = [[math.inf] * (n + 1), [math.inf] * (n + 1)]
        cost[0][0] = 0.0
        back: list[list[tuple[int, int, str, int]]] = [[(0, 0, "", 0)] * (n + 1), [(0, 0, "", 0)] * (n + 1)]

        def reach(start: int, end: int, more: float, word: str, evidence: int) -> None:
            gap = bool(word) and end < n and text[end] != " "
            for layer in (0, 1):
                total = cost[layer][start] + more + ((GAP_COST if layer else first_gap) if gap else 0.0)
                to = 1 if gap else layer
                if total < cost[to][end]:
                    cost[to][end], back[to][end] = total, (layer, start, word, evidence)

        for start in range(n):
            if min(cost[0][start], cost[1][start]) >= least:
                continue
            if text[start] == " ":
                reach(start, start + 1, 0.0, "", 0)
                continue
            for more, end, word, evidence in self.words_at(text, start):
                reach(start, end, more, word, evidence)
            if n > AMONG[1]:
                # A word unknown among the others; only in longer stretches can it pay.
                for end in range(start + AMONG[0], min(n, start + AMONG[1]) + 1):
                    piece = text[start:end]
                    if " " in piece:
                        break
                    reach(start, end, UNKNOWN_COST + (LETTER_COST + TOGETHER_COST * together) * len(piece) + SIGN_COST * sum(c in _SIGNS for c in piece), piece, 0)
        layer = int(cost[1][n] < cost[0][n])
        whole = cost[layer][n]
        if whole >= least:
            return None
        out, evidence, end = [], 0, n
        while end:
            layer, start, word, shown = back[layer][end]
            if word:
                out.append((start, end, word))
                evidence = max(evidence, shown)
            end = start
        return whole, out[::-1], evidence

    def reading(self, word: str) -> tuple[float, str, int] | None:
        """Cost, word and evidence of the best vocabulary word of which ``word``, whole, may be a misreading; None if as it is it's likelier."""
        best = min(((c, w, e) for c, end, w, e in self.words_at(word, 0) if end == len(word) and e), default=None)
        return best if best and best[0] < self.as_is(word) else None

    def _single(self, token: str) -> tuple[float, str, int, bool]:
        """Cost of a token, what it should read, evidence of misreading, and whether it is open: no word and not read as one."""
        left, core, right = _parted(token)
        low = core.lower()
        base = self.as_is(low) if core else 0.0
        best = (base, token, 0)
        if found := self._signed(token):
            best = found
        elif core and not self.weight(low) and (done := self.decoded[low]) and done[0] < base:
            best = (done[0], left + _spelled(core, done[1]) + right, done[2])
        elif not core and (parts := _RUNS.findall(token)) and len(parts) > 1 and not _NO_WORDS.search(token):
            # Words run together with the punctuation and numbers between them.
            costs = [(d[0], _spelled(p, d[1])) if not self.weight(p.lower()) and (d := self.together[p.lower()]) else self.single[p][:2] for p in parts]
            if sum(c for c, _ in costs) + RUN_COST + GAP_COST * (len(parts) - 1) < self.as_is("".join(parts).lower()):
                texts = iter(t for _, t in costs)
                best = (0.0, _BETWEEN.sub(" ", _RUNS.sub(lambda m: next(texts), token)), 0)
        return *best, bool(core) and not self.weight(low) and best[1] == token

    def _signed(self, token: str) -> tuple[float, str, int] | None:
        """A whole token read with misread characters; signs at its edges may be punctuation or letters."""
        core = token.strip(_EDGE)
        low = core.lower()
        if len(low) < 2 or not _SUSPECT.search(low):
            return None
        # An exclamation or opening bracket at the edge is punctuation if the rest is a word.
        bare = low.strip("!(").removesuffix("'")
        if not bare or bare != low and self.weight(bare) and not re.search(r"![.,;:?]", token):
            return None
        if not all(c.isalpha() or c in _SIGNS for c in low):
            return None
        tries = [low] if low.startswith("(") or low.endswith(("!", "'")) else [bare]
        if low != bare and bare not in tries:
            tries.append(bare)
        for form in tries:
            if found := self.reading(form):
                cost, word, proof = found
                start = token.lower().find(form)
                return cost, token[:start] + _cased(core, word) + token[start + len(form) :], proof
        return None

    def stream(self, tokens: list[str], line_ends: list[bool]) -> list[tuple[int, int, str, str | None, int]]:
        """The chosen edges of a stream of tokens that change something: from token, to token, text, kind, evidence.

        ``line_ends`` says of each token whether its line ends after it. Only around tokens that are open or
        divided is there more than one edge; a dynamic program runs over each such stretch.
        """
        out: list[tuple[int, int, str, str | None, int]] = []
        n = len(tokens)
        single = self.single
        many: list[int] = []
        for i, token in enumerate(tokens):
            own = single[token] if len(token) < 64 else self._single(token)
            if own[3] or line_ends[i] and token[-1] in MARKS and i + 1 < n:
                many.append(i)
            elif own[2] or own[1] is not token and own[1] != token:
                many.append(i)
        i = 0
        while i < len(many):
            # A stretch: what lies within two tokens of tokens with a choice.
            low = high = many[i]
            while i < len(many) and many[i] - high <= 4:
                high = many[i]
                i += 1
            low, high = max(0, low - 2), min(n, high + 3)
            if out and out[-1][1] > low:
                low = out[-1][1]
            out += self._path(tokens, line_ends, low, high)
        return out

    def _path(self, tokens: list[str], line_ends: list[bool], low: int, high: int) -> list[tuple[int, int, str, str | None, int]]:
        best: dict[int, tuple[float, tuple | None]] = {low: (0.0, None)}
        for i in range(low, high):
            if i not in best:
                continue
            here = best[i][0]
            for more, edge in self._edges(tokens, line_ends, i, high):
                to = edge[1]
                if to not in best or here + more < best[to][0]:
                    best[to] = here + more, edge
        out, at = [], max(best)
        while at > low:
            edge = best[at][1]
            if edge[2] is not None:
                out.append(edge)
            at = edge[0]
        return out[::-1]

    def _edges(self, tokens: list[str], line_ends: list[bool], i: int, high: int):
        token = tokens[i]
        marked = line_ends[i] and len(token) > 1 and token[-1] in MARKS and i + 1 < len(tokens)
        cost, text, evidence, is_open = self.single[token]
        changed = text if text != token else None
        if not marked:
            yield cost, (i, i + 1, changed, None, evidence)
        else:
            bare = token[:-1]
            yield self.single[bare][0], (i, i + 1, changed, None, evidence)
            link = tokens[i + 1].strip(_EDGE).lower() in _LINKS
            # Over a division mark: the rest of the word moves up; it may itself be divided again.
            joined, j = token, i
            while j + 1 < len(tokens) and line_ends[j] and (m := _DIVIDED.search(joined)) and (rest := _REST.match(tokens[j + 1])) and (rest[0][0].islower() or m[1].isupper()):
                joined = joined[: m.end(1)] + tokens[j + 1]
                j += 1
                found = self.single[joined] if not _DIVIDED.search(joined) else self.single[joined[:-1]]
                yield found[0] + JOIN_COST + (LINK_COST if link and found[3] else 0.0), (i, j + 1, found[1] if not _DIVIDED.search(joined) else joined, "split", found[2])
        # Over blanks: tokens of one line of which some is open.
        parts = [_parted(token)]
        opens = is_open
        for j in range(i + 1, min(high, i + MOST_BLANKS + 1)):
            if line_ends[j - 1] or not parts[-1][1] or parts[-1][2]:
                return
            part = _parted(tokens[j])
            if not part[1] or part[0] or not part[1].islower():
                return
            parts.append(part)
            opens += self.single[tokens[j]][3]
            if opens >= j - i:
                stretch = " ".join(p[1] for p in parts)
                if found := self.decoded[stretch.lower()]:
                    # Of equal ways, that of the shorter stretches.
                    yield found[0] + 1e-3 * (j - i), (i, j + 1, parts[0][0] + _spelled(stretch, found[1]) + parts[-1][2], None, found[2])


_REST = re.compile(r"(?:[^\W\d_]|[1!|0569†(öß'])+")
_RUNS = re.compile(r"[^\W\d_]+")
#: What the decoder reads: letters of Slovene words, signs, blanks (fixed value).
_ALPHABET = re.compile(r"[a-zčšžćđ1!|05698†(öß' ]*")
#: Signs of tokens that are no running text (fixed values).
_NO_WORDS = re.compile(r"[^\w.,;:!?…»«„“”’()–—-]|_|www\.|[^\W\d_A-Za-zčšžćđČŠŽĆĐ]")
#: Where blanks are missing: after punctuation before a letter, and beside numbers.
_BETWEEN = re.compile(r"(?<=[.,;:!?])(?=[^\W\d_])|(?<=[^\W\d_])(?=\d{4})|(?<=\d{4})(?=[^\W\d_])")


def _parted(token: str) -> tuple[str, str, str]:
    """Edge, word and edge of a token; the word is empty if it holds anything but letters and signs."""
    core = token.strip(_EDGE).strip("!('")
    if not core or not _SUSPECT.search(core) or not all(c.isalpha() or c in _SIGNS for c in core):
        return token, "", ""
    at = token.find(core)
    return token[:at], core, token[at + len(core) :]


def _cased(old: str, word: str) -> str:
    """``word`` in the case of ``old``."""
    return old if old.lower() == word else word.upper() if old.isupper() and len(old) > 1 else word[:1].upper() + word[1:] if old[:1].isupper() else word


def _spelled(stretch: str, words: list[tuple[int, int, str]]) -> str:
    return " ".join(_cased(stretch[a:b].replace(" ", ""), w) for a, b, w in words)


def reader(words: Lexicon):
    """Function from a text to (repaired text, kinds of damage)."""
    read = words.once(Reader)

    def repair(text: str | None) -> tuple[str | None, list[str]]:
        if not text:
            return text, []
        kinds: set[str] = set()
        # What only looks different or can't be seen is no scan damage and would hide the words.
        if _UNUSUAL.search(text):
            text = by_table(text)
        lines = text.split("\n")
        if len(lines) > 1:
            off = furniture(lines)
            if any(off):
                # Edges that skip a line cost nothing: furniture is always left out.
                kinds.add("furniture")
                lines = _without(lines, off)
            lines = [line.replace("\x0c", "") for line in lines]
        tokens: list[str] = []
        line_ends: list[bool] = []
        #: Of each token, its line and place in it.
        places: list[int] = []
        for k, line in enumerate(lines):
            own = line.split()
            tokens += own
            line_ends += [False] * len(own)
            places += [k] * len(own)
            if own:
                line_ends[-1] = True
        edges = read.stream(tokens, line_ends)
        if edges:
            lines = _rewritten(lines, tokens, places, edges)
            kinds.update(kind for *_, kind, _ in edges if kind)
            if any(evidence for *_, evidence in edges):
                kinds.add("misread")
        return _paragraphs(lines) if len(lines) > 1 else lines[0], sorted(kinds)

    return repair


def _rewritten(lines: list[str], tokens: list[str], places: list[int], edges: list[tuple[int, int, str, str | None, int]]) -> list[str]:
    """Lines with the text of the edges in place of their tokens; a token taken to an earlier line leaves its own."""
    new: dict[int, str | None] = {}
    for a, b, text, *_ in edges:
        new[a] = text
        new.update((i, None) for i in range(a + 1, b))
    touched = {places[i] for i in new}
    first: dict[int, int] = {}
    for i, k in enumerate(places):
        first.setdefault(k, i)
    out = []
    for k, line in enumerate(lines):
        if k not in touched:
            out.append(line)
            continue
        parts = _BLANKS.split(line.strip())
        words, blanks = parts[::2], [line[: len(line) - len(line.lstrip())], *parts[1::2]]
        done = ""
        for j, (word, blank) in enumerate(zip(words, blanks)):
            i = first[k] + j
            word = new.get(i, word)
            if word is not None:
                done += (blank if done or j == 0 else "") + word
        if done.strip():
            out.append(done)
    return out


#: Words that follow a real hyphen (fixed values).
_LINKS = frozenset("in ali ter pa na do od".split())


def _without(lines: list[str], off: list[bool]) -> list[str]:
    """Lines without furniture and the blank lines beside it."""
    out: list[str] = []
    gap = False
    for line, gone in zip(lines, off):
        if gone:
            gap = True
            while out and not out[-1].strip():
                out.pop()
        elif line.strip("\x0c \t") or not gap:
            out.append(line)
            gap = False
    return out


def _spaced(token: str, read: Reader) -> str:
    """A long token with blanks between the words that run together in it."""
    parts = re.split(r"([^\W\d_]+)", token)
    if sum(len(p) > 20 for p in parts) == 0 and token.count(",") + token.count(".") < 1:
        return token
    words = [" ".join(read.split(p) or [p]) if len(p) > 12 and p.isalpha() else p for p in parts]
    return re.sub(r"([.,;:!?])(?=[^\W\d_])", r"\1 ", "".join(words))


def _paragraphs(lines: list[str]) -> str:
    """Lines joined to paragraphs; where to break is chosen by dynamic programming.

    The break after a line costs more the fuller it is and if its sentence goes on; going on costs more
    after a short line, before an indented one and before a capital. Blank lines and headings always
    break. Runs of short capitalized lines (verse) and speakers keep their lines.
    """
    filled = sorted(len(x) for x in lines if x.strip())
    if not filled:
        return "\n".join(lines)
    width = filled[int(0.9 * (len(filled) - 1))]
    if width > WIDEST:
        return "\n".join(lines)
    n = len(lines)
    #: Least cost up to a line whose end is followed by a break (0) or not (1), and the choice before.
    cost, back = [0.0, 0.0], []
    for i in range(n - 1):
        a, b = lines[i].rstrip(), lines[i + 1]
        fixed = not a or not b.strip() or a.lstrip().startswith(("#", "- ", "|", "```", "> ")) or b.lstrip().startswith(("#", "- ", "|", "```", "> ", "\\", "{", "<"))
        ends = bool(re.search(r"[.!?…:][\"»«“”)]*$", a))
        full = len(a) / max(1, width)
        first = b.lstrip()[:1]
        speaker = bool(re.match(r"\s*[A-ZČŠŽ]{3,}:", b))
        stop = 0.0 if fixed else (0.4 if ends else 2.2) + (1.0 if full > 0.75 else 0.0) - (1.5 if first.isupper() and full < 0.7 else 0.0)
        go = 9.0 if fixed or speaker else (1.6 if ends and full < 0.7 else 0.0) + (1.2 if b[:1] in " \t" else 0.0) + (0.8 if first.isupper() and not ends else 0.0) + (0.5 if full < 0.5 else 0.0)
        # Single-line paragraphs in the middle of running text are unlikely.
        after_break, after_go = cost
        step = [min((after_break + 0.3, 0), (after_go, 1)), min((after_break, 0), (after_go, 1))]
        back.append((step[0][1], step[1][1]))
        cost = [step[0][0] + stop, step[1][0] + go]
    choice = 0 if not back or cost[0] <= cost[1] else 1
    choices = []
    for pair in reversed(back):
        choices.append(choice)
        choice = pair[choice]
    choices.reverse()
    out = [lines[0].rstrip()]
    for line, go in zip(lines[1:], choices):
        if go:
            out[-1] = f"{out[-1]} {line.strip()}"
        else:
            out.append(line.rstrip())
    return "\n".join(out)


def repaired(df: DataFrame, key: str = "row_id", text: str = "text") -> DataFrame:
    """``key``, repaired ``text``, ``damage`` (array of furniture, misread, split) of every row.

    Null and empty texts come out unchanged, an empty table gives no rows, repeated rows are kept. Texts
    are read twice and never shuffled; only the bounded vocabulary is sent to workers.
    """
    vocabulary = lexicon(df, text)

    def make():
        repair = reader(vocabulary.value)

        def step(keys, texts):
            done = [repair(t) for t in texts]
            return {key: keys, "text": [d[0] for d in done], "damage": [d[1] for d in done]}

        return step

    return map_batches(df.select(key, text), f"{key} {df.schema[key].dataType.simpleString()}, text string, damage array<string>", make)


def damaged(df: DataFrame, key: str = "row_id", text: str = "text") -> DataFrame:
    """Distinct ``key``, ``damage``: one row per kind."""
    return repaired(df, key, text).select(key, F.explode("damage").alias("damage")).distinct()

"""Problem 2: passages of held-out works in training text.

Pigeonhole edit matching: a passage of 25 words or more with at most one word in ten differing has a
run of 7 equal words, and so an aligned piece of 4. The pieces of all works are one Aho-Corasick
automaton, run over the folded character stream of each document, in which case, diacritics,
punctuation, spacing and the usual damage make no difference. Around a run of hits the stream is read
as words of the work, and Myers' bit-parallel distance, counted in words, decides: a passage of 25 words
may be 2 from the text, one of 30 may be 3, one of 40 may be 4. Every longer passage holds one of these.
"""

from __future__ import annotations

import bisect
import hashlib
import html
import itertools
import re
import unicodedata
from collections import defaultdict
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import Memo, checkpointed, map_batches
from .encoding import _HAS as _FOREIGN
from .encoding import _IMAGES, _KNOWN
from .lookalikes import _UNUSUAL, by_table
from .scans import MARKS, furniture

#: Least words of a passage, share of its words that may differ, words of a piece.
PASSAGE, DIFFER, PIECE = 25, 0.1, 4
#: Equal words in a row that any such passage has.
RUN = 7
#: Words of the passages that decide and how many of them may differ.
SIZES = tuple((n, int(n * DIFFER)) for n in (PASSAGE, 30, 40))
#: Code points of works sent to workers at once; more are matched in as many passes over the folded texts.
GROUP_CHARS = 8_000_000

_DIVISION = re.compile(rf"(?<=[^\W\d_])[{MARKS}] ?\n\s*(?=[^\W\d_])")
_TAG = re.compile(r"</?[A-Za-z][^<>]*>|<!--.*?-->", re.S)
_LATEX = re.compile(r"\\[vcHukr]\s*\{?([A-Za-z])\}?|\\['`\"^~=.]\{?([A-Za-z])\}?|\\(?:begin|end|cite|label|ref)\*?\{[^{}]*\}|\\[A-Za-z]+\*?")
_LINK = re.compile(r"\[\[[^\[\]|]*\||\]\([^()\s]*\)|\[https?://\S+|\[\^\w+\]|\{\{\w+\|")
_LINES = re.compile("[\x0c]|^[^\\w\n]*\\d[\\d ]{0,6}[^\\w\n]*$|^\\S.* {3,}\\d+\\*?$|^\\d+ {3,}\\S", re.M)
#: Letters that damage swaps share one sign: those of the lost or misread diacritics, strokes, bowls (fixed values).
_CLASS = str.maketrans({**dict.fromkeys("cesz5(", "s"), **dict.fromkeys("il1|j", "i"), **dict.fromkeys("un", "n"), **dict.fromkeys("vyw", "v"), **dict.fromkeys("hb68", "b"), "†": "t", "0": "o", "9": "g", "m": "rn", "d": "si", "�": "s"})


def fold_word(token: str) -> str:
    """A blank-separated token as it counts in comparison; empty if it has no letters.

    Digits count only inside words; foreign letters stand for a letter with a diacritic, as wrong
    encodings leave them; ``li`` and ``h`` aren't unified, so one misread word may stay different.
    """
    if not token.isascii():
        if _FOREIGN.search(token):
            token = _IMAGES.sub(lambda m: _home(m[0]), token)
        token = unicodedata.normalize("NFD", token)
    text = token.lower().strip("!?.,;:»«()[]{}\"'„“”‚‘’–—-…/*_#<>=·¡¿†‡ \ufffd")
    if not text or text.isdigit():
        return ""
    out = []
    for c in text:
        if c.isascii():
            if c.isalnum() or c in "(|":
                out.append(c)
            elif c == "?":
                out.append("s")
            elif c == "!":
                out.append("i")
        elif c == "†" or c == "�":
            out.append(c if not (c == "�" and out and out[-1] == "�") else "")
        elif c.isalpha() and not unicodedata.combining(c):
            out.append("s")
        elif _FOREIGN.match(c):
            out.append("s")
    return "".join(out).translate(_CLASS)


def _home(run: str) -> str:
    """The letters behind a run of wrongly read characters, where only one reading is known."""
    out, at = [], 0
    while at < len(run):
        for size in range(min(8, len(run) - at), 0, -1):
            piece = run[at : at + size]
            if piece in _KNOWN:
                target = sorted(_KNOWN[piece])[0]
                out.append(target if target.isalpha() and (size > 1 or len(_KNOWN[piece]) == 1) else "" if size > 1 else "č")
                at += size
                break
        else:
            out.append(run[at])
            at += 1
    return "".join(out)


def plain_text(text: str) -> str:
    """``text`` without page furniture, division marks and markup, in usual characters."""
    if _UNUSUAL.search(text):
        text = by_table(text)
    if "<" in text:
        text = _TAG.sub(" ", text)
    if "&" in text:
        text = html.unescape(text)
    if "\\" in text:
        text = _LATEX.sub(lambda m: m[1] or m[2] or " ", text)
    if "[" in text or "{" in text:
        text = _LINK.sub(" ", text)
    if "\n" in text:
        if _LINES.search(text):
            lines = text.split("\n")
            off = furniture(lines)
            if any(off):
                text = "\n".join(x for x, gone in zip(lines, off) if not gone)
                text = re.sub(r"\n{3,}", "\n\n", text)
                text = re.sub(rf"(?<=[^\W\d_])[{MARKS}] ?\n\s*\n(?=[^\W\d_])", "", text)
        text = _DIVISION.sub("", text)
    return text.replace("\xad", "")


class Works:
    """Folded words of held-out works, their streams, and the automaton of their pieces.

    A work is one (id, text): an id that is repeated with other texts is as many works.
    """

    def __init__(self, works: list[tuple[object, str]]):
        import ahocorasick

        self.items: list[object] = []
        self.words: list[list[str]] = []
        self.starts: list[list[int]] = []
        places: dict[str, list[tuple[int, int]]] = defaultdict(list)
        seen = set()
        for item, text in works:
            words = [w for w in map(fold_word, plain_text(text or "").split()) if w]
            if len(words) < PASSAGE or (item, *words) in seen:
                continue
            seen.add((item, *words))
            self.items.append(item)
            self.words.append(words)
            self.starts.append([0, *itertools.accumulate(map(len, words))])
            for i in range(0, len(words) - PIECE + 1, PIECE):
                places["".join(words[i : i + PIECE])].append((len(self.items) - 1, i))
        self.automaton = ahocorasick.Automaton()
        for piece, where in places.items():
            self.automaton.add_word(piece, (len(piece), where))
        if places:
            self.automaton.make_automaton()
        self.any = bool(places)


#: The works a worker process matched last, by their digest: the automaton is built once per process.
_built: dict[str, Works] = {}


def built(digest: str, works: list[tuple[object, str]]) -> Works:
    if digest not in _built:
        _built.clear()
        _built[digest] = Works(works)
    return _built[digest]


def myers(pattern: Sequence, text: Sequence, most: int = -1) -> int:
    """Least edit distance of ``pattern`` to any part of ``text``, bit-parallel over the pattern.

    Both are sequences of any symbols, characters or words. Stops once the distance is ``most`` or less.
    """
    m = len(pattern)
    if not m:
        return 0
    peq: dict = {}
    for i, c in enumerate(pattern):
        peq[c] = peq.get(c, 0) | 1 << i
    mask, high = (1 << m) - 1, 1 << m - 1
    pv, mv, score = mask, 0, m
    best = m
    for c in text:
        eq = peq.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | ~(xh | pv) & mask
        mh = pv & xh
        if ph & high:
            score += 1
        elif mh & high:
            score -= 1
            if score < best:
                best = score
                if best <= most:
                    return best
        ph = ph << 1 & mask
        mh = mh << 1 & mask
        pv = mh | ~(xv | ph) & mask
        mv = ph & xv
    return best


def as_words(stream: str, ends: Sequence[int], words: set[str]) -> list[str | None]:
    """``stream`` read as ``words`` wherever it can be; None is any other word.

    One dynamic program over the characters, with the fewest other words; of equals the one whose words
    agree best with the tokens of the text, which end at ``ends``. Blanks inside a word and between words
    that stand together therefore don't count.
    """
    n = len(stream)
    heads: dict[str, list[str]] = defaultdict(list)
    for w in words:
        heads[w[:2]].append(w)
    border = {0, *ends}
    #: Cost of another word, of a word, of an end inside a token.
    other, known, inside = 1.0, 0.001, 0.12
    cost = [0.0] + [float("inf")] * n
    back: list[tuple[int, str | None]] = [(0, None)] * (n + 1)
    stops = sorted({*ends, n})
    for at in range(n):
        here = cost[at]
        if here == float("inf"):
            continue
        for w in (*heads.get(stream[at : at + 2], ()), *(heads.get(stream[at], ()) if at + 1 < n else ())):
            if stream.startswith(w, at):
                to = at + len(w)
                more = here + known + (0.0 if to in border or to == n else inside)
                if more < cost[to]:
                    cost[to], back[to] = more, (at, w)
        # Another word goes on to its token's end, or to a place inside it where a word may begin.
        end = stops[bisect.bisect_right(stops, at)]
        for to in (end, *range(at + 1, min(end, at + 30))):
            more = here + other + (0.0 if to == end else inside)
            if more < cost[to]:
                cost[to], back[to] = more, (at, None)
    out, at = [], n
    while at:
        at, w = back[at][0], back[at][1]
        out.append(w)
    return out[::-1]


class Text:
    """Folded tokens of a text and their stream."""

    def __init__(self, tokens: list[str]):
        self.tokens = tokens
        self.stream = "".join(tokens)
        self._ends: list[int] | None = None

    @property
    def ends(self) -> list[int]:
        if self._ends is None:
            self._ends = list(itertools.accumulate(map(len, self.tokens)))
        return self._ends

    def reach(self, at: int, need: int, step: int) -> int:
        """Place so far from ``at`` that ``need`` characters lie between, not counting the longest words that may differ."""
        spare: list[int] = []
        i = bisect.bisect_right(self.ends, at) if step > 0 else bisect.bisect_left(self.ends, at)
        got = 0
        while 0 <= i < len(self.tokens):
            size = len(self.tokens[i])
            bisect.insort(spare, size)
            if len(spare) > SIZES[-1][1]:
                got += spare.pop(0)
            if got >= need:
                break
            i += step
        i = min(max(i, 0), len(self.tokens) - 1)
        return self.ends[i] if step > 0 else self.ends[i] - len(self.tokens[i])


def holds_passage(words: list[str], starts: list[int], text: Text, hits: list[tuple[int, int]]) -> bool:
    """Whether ``text`` holds a passage of a work; hits are (word of the work, place in the stream)."""
    n, stream = len(words), text.stream
    done: list[tuple[int, int, int]] = []
    for i, at in hits:
        shift = at - starts[i]
        if any(a <= i < b and shift == s for a, b, s in done):
            continue
        # Equal words on both sides of the hit: a run of RUN of them must be in any passage.
        a = b = i
        while a > 0 and starts[a - 1] + shift >= 0 and stream.startswith(words[a - 1], starts[a - 1] + shift):
            a -= 1
        while b < n and stream.startswith(words[b], starts[b] + shift):
            b += 1
        done.append((a, b, shift))
        if b - a >= PASSAGE:
            return True
        if b - a < RUN:
            continue
        size = SIZES[-1][0]
        low, high = max(0, b - size), min(n, a + size)
        first = text.reach(starts[a] + shift, starts[a] - starts[low], -1) if low < a else starts[a] + shift
        last = text.reach(starts[b] + shift, starts[high] - starts[b], 1) if high > b else starts[b] + shift
        first, last = min(first, starts[a] + shift), max(last, starts[b] + shift)
        # A word that stands nowhere around costs 1 in any reading: most windows are out by their number.
        part = stream[first:last]
        lacking = [0, *itertools.accumulate(w not in part for w in words[low:high])]
        windows = [(size, most, k) for size, most in SIZES for k in range(max(low, b - size), min(a, high - size) + 1) if lacking[k + size - low] - lacking[k - low] <= most]
        if windows:
            ends = text.ends[bisect.bisect_right(text.ends, first) : bisect.bisect_right(text.ends, last)]
            read = as_words(part, [e - first for e in ends], set(words[low:high]))
            there = set(read)
            if any(sum(w not in there for w in words[k : k + size]) <= most and myers(words[k : k + size], read, most) <= most for size, most, k in windows):
                return True
    return False


def finder(works: Works):
    """Function from folded tokens to the ids of the works of which they hold a passage."""

    def find(tokens: list[str]) -> list:
        if not tokens or not works.any:
            return []
        text = Text(tokens)
        hits: dict[int, list[tuple[int, int]]] = {}
        for end, (size, where) in works.automaton.iter(text.stream):
            for w, i in where:
                hits.setdefault(w, []).append((i, end - size + 1))
        return sorted({works.items[w] for w, found in hits.items() if holds_passage(works.words[w], works.starts[w], text, found)})

    return find


def folder():
    """Function from a text to its folded tokens."""
    fold = Memo(fold_word)

    def tokens(text: str | None) -> list[str]:
        return [w for t in plain_text(text).split() if (w := fold[t] if len(t) < 64 else fold_word(t))] if text else []

    return tokens


def _groups(rows, most: int):
    """Works in groups of ``most`` code points, or of one longer work."""
    group, size = [], 0
    for item, text in rows:
        if group and size + len(text) > most:
            yield group
            group, size = [], 0
        group.append((item, text))
        size += len(text)
    if group:
        yield group


def leaks(corpus: DataFrame, works: DataFrame, manifest: DataFrame | None = None, item: str = "item_id", key: str = "row_id", url: str = "url", text: str = "text", group_chars: int = GROUP_CHARS) -> DataFrame:
    """Distinct ``item``, ``key``: rows of ``corpus`` that training uses and the works that leaked into them.

    Rows at a url of ``works`` or of ``manifest.also_exclude_urls`` are left out first; a null url isn't
    among them. Null and empty texts hold nothing, works under 25 words can't leak, an empty table of
    works gives no rows; repeated rows are judged one by one, an id with several texts leaks by any of them.
    ``works`` is a frozen set: it is streamed through the driver and goes to workers in groups of
    ``group_chars`` code points. The corpus is read and folded once; with more than one group its folded
    tokens are written, and each group is matched over those.
    """
    urls = works.select(F.col(url).alias("_u"))
    if manifest is not None:
        urls = urls.unionByName(manifest.select(F.explode("also_exclude_urls").alias("_u")))
    used = corpus.join(urls.where("_u is not null").distinct(), F.col(url) == F.col("_u"), "left_anti").select(key, text)
    kinds = works.schema[item].dataType.simpleString(), corpus.schema[key].dataType.simpleString()
    rows = works.where(F.col(text).isNotNull() & F.col(item).isNotNull()).select(item, text).distinct().orderBy(item, text)
    groups = _groups(((r[0], r[1]) for r in rows.toLocalIterator()), group_chars)
    context = corpus.sparkSession.sparkContext
    sent = [(context.broadcast(g), hashlib.sha256(repr(g).encode("utf-8", "surrogatepass")).hexdigest()) for g in groups]
    many = len(sent) > 1
    if many:

        def fold_all():
            fold = folder()
            return lambda keys, texts: {key: keys, "tokens": [" ".join(fold(t)) for t in texts]}

        used = checkpointed(map_batches(used, f"{key} {kinds[1]}, tokens string", fold_all))
    found = None
    for group, digest in sent or [(context.broadcast([]), "")]:

        def make(group=group, digest=digest):
            find = finder(built(digest, group.value))
            tokens = str.split if many else folder()

            def step(keys, texts):
                pairs = [(i, k) for k, t in zip(keys, texts) for i in find(tokens(t))]
                return {item: [p[0] for p in pairs], key: [p[1] for p in pairs]}

            return step

        part = map_batches(used, f"{item} {kinds[0]}, {key} {kinds[1]}", make)
        found = part if found is None else found.unionByName(part)
    return found.distinct()

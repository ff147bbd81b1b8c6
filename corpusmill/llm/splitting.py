"""Problem 7: items over a size limit become pieces cut at natural boundaries.

Balanced targets: the smallest number of pieces that can hold an item gives equally spaced cuts; each
is moved to the strongest boundary near it, nearest first among equals. If that leaves a cut without a
natural boundary, one more piece is tried, up to ``EXTRA`` times. If that isn't enough, the text is cut
anew from its start, and pieces are added wherever else a cut would be forced; a cut is then forced only
where no natural boundary is left within a piece's reach, so no way of cutting has fewer forced cuts.
"""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import DataFrame

from .base import map_batches
from .tokens import counter

#: Most code points of a piece, code points a piece repeats of the one before, pieces added evenly at most.
LIMIT, OVERLAP, EXTRA = 1500, 100, 3
#: Half the width, as a share of a piece's stride, of the window in which a stronger boundary is preferred.
REACH = 0.35
#: Natural boundaries, strongest first; a cut falls at the end of a match (fixed values).
BOUNDARIES = tuple(map(re.compile, (r"\n[ \t]*\n\s*", r"\n\s*", r"[.!?…][\"»«“”)\]]*\s+", r"[,;:–—]\s+", r"\s+")))


def longest_run(text: str) -> int:
    """Length of the longest run without whitespace."""
    return max(map(len, text.split()), default=0)


def _snap(text: str, low: int, high: int, target: int, reach: int) -> tuple[int, bool]:
    """A cut in [low, high] near ``target``, and whether it is natural."""
    near = max(low, target - reach), min(high, target + reach)
    for a, b in (near, (low, high)):
        for pattern in BOUNDARIES:
            ends = [m.end() for m in pattern.finditer(text, max(0, a - 8), min(len(text), b + 8)) if a <= m.end() <= b]
            if ends:
                return min(ends, key=lambda e: (abs(e - target), e)), True
    cut = min(max(target, low), high)
    return _whole(text, low, cut), False


def _whole(text: str, low: int, cut: int) -> int:
    """``cut`` moved before the character whose combining marks follow it, if that is beyond ``low``."""
    at = cut
    while at > low and unicodedata.combining(text[at : at + 1] or " "):
        at -= 1
    return cut if at == low else at


def _cuts(text: str, k: int, limit: int, overlap: int) -> tuple[list[int], int]:
    """Ends of ``k`` pieces and how many of the cuts are forced."""
    n, ends, forced = len(text), [], 0
    stride = limit - overlap
    for i in range(1, k):
        last = ends[-1] if ends else 0
        start = last - overlap if ends else 0
        left = k - i
        low = max(last + 1, n - left * stride, overlap + 1)
        high = min(start + limit, n - left)
        target = last + round((n - last - (overlap if not ends else 0)) / (left + 1)) + (overlap if not ends else 0)
        cut, natural = _snap(text, low, high, min(max(target, low), high), int(REACH * stride))
        forced += not natural
        ends.append(cut)
    return [*ends, n], forced


def _walk(text: str, limit: int, overlap: int) -> tuple[list[int], int]:
    """Ends of as many pieces as it takes and how many of the cuts are forced, which is the least there can be."""
    n, ends, forced = len(text), [], 0
    stride = limit - overlap
    while True:
        last = ends[-1] if ends else 0
        start = last - overlap if ends else 0
        if n - start <= limit:
            return [*ends, n], forced
        high = start + limit
        left = -(-(n - high) // stride)
        least = max(last + 1, overlap + 1)
        low = max(least, n - left * stride)
        target = start + overlap + round((n - start - overlap) / (left + 1))
        cut, natural = _snap(text, low, high, min(max(target, low), high), int(REACH * stride))
        if not natural and least < low:
            cut, natural = _snap(text, least, high, high, int(REACH * stride))
        if not natural:
            # Nothing is gained by an earlier place inside the same word.
            cut = _whole(text, least, high)
        forced += not natural
        ends.append(cut)


def split(text: str | None, limit: int = LIMIT, overlap: int = OVERLAP) -> tuple[list[tuple[int, int]], int]:
    """Spans of the pieces of ``text`` and how many cuts had to be forced.

    An item within the limit is one piece; null and empty items have no pieces.
    """
    if not text:
        return [], 0
    n = len(text)
    if n <= limit:
        return [(0, n)], 0
    least = 1 + -(-(n - limit) // (limit - overlap))
    best = None
    for k in range(least, least + EXTRA + 1):
        ends, forced = _cuts(text, k, limit, overlap)
        if best is None or forced < best[1]:
            best = ends, forced
        if not forced:
            break
    if best[1] and (walked := _walk(text, limit, overlap))[1] < best[1]:
        best = walked
    ends, forced = best
    return [(max(0, a - overlap), b) for a, b in zip([0, *ends], ends)], forced


def named(text: str, forced: int, limit: int = LIMIT) -> str:
    """``forced`` if a cut was and, by an exact check, a run without whitespace is longer than the limit; else ``natural``.

    A run a little shorter than the limit may need a forced cut too, as pieces repeat the end of the one before.
    """
    return "forced" if forced and longest_run(text) > limit else "natural"


def pieces(df: DataFrame, key: str = "chunk_id", text: str = "text", limit: int = LIMIT, overlap: int = OVERLAP, path: str | None = None) -> DataFrame:
    """Pieces of the rows of ``df`` over ``limit`` code points; rows within it, empty and null ones give none.

    Columns: ``key``, ``piece`` (from 0), ``n_pieces``, ``cut``, ``forced_cuts`` (of the item), ``char_start``,
    ``char_end`` (within the item, end exclusive), ``text``, ``n_chars``, ``n_tokens`` (of byte_bpe_50k). Stored sizes are not
    trusted. Repeated rows are split like any other. No shuffle: an item is cut where it is read.
    """

    def make():
        count = counter(path)

        def step(keys, texts):
            out = {c: [] for c in (key, "piece", "n_pieces", "cut", "forced_cuts", "char_start", "char_end", "text", "n_chars", "n_tokens")}
            for k, t in zip(keys, texts):
                spans, forced = split(t, limit, overlap)
                if len(spans) < 2:
                    continue
                cut = named(t, forced, limit)
                for i, (a, b) in enumerate(spans):
                    for c, v in zip(out, (k, i, len(spans), cut, forced, a, b, t[a:b], b - a, count(t[a:b]))):
                        out[c].append(v)
            return out

        return step

    kind = df.schema[key].dataType.simpleString()
    schema = f"{key} {kind}, piece int, n_pieces int, cut string, forced_cuts int, char_start bigint, char_end bigint, text string, n_chars bigint, n_tokens bigint"
    return map_batches(df.select(key, text), schema, make)

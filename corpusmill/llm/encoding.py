"""Problem 5: text that was decoded with the wrong character encoding.

An unknown code-page swap is a substitution cipher: runs of foreign characters (units) stand for
letters. Per source, the letter behind each unit is learned by expectation-maximization against the
bigrams that undamaged text shows on both sides of each letter; the learned table is applied with
translate(). A mapped token counts as restored if the vocabulary knows it and not what stood there.
"""

from __future__ import annotations

import itertools
import re
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import Memo, canonical_source, checkpointed, map_batches
from .lexicon import EDGE, SHARE, Lexicon, lexicon

#: What a unit may stand for: letters and signs of undamaged text beyond ASCII (fixed values).
TARGETS = "čšžČŠŽ»«–—†…„“”’‚‘"
#: Code pages text may have been written in and read with (fixed values).
WRITTEN = ("utf-8", "cp1250", "iso8859-2", "cp852", "mac_latin2")
READ = ("latin-1", "cp1252", "cp1250", "iso8859-2", "cp852", "cp437", "mac_roman", "mac_latin2")
#: Iterations; weight of a target that some pair of code pages explains, against one of any other.
ITERATIONS, EXPLAINED, UNEXPLAINED = 15, 1.0, 1e-4
#: A unit is kept if it makes up this share of its source's units, so a source has at most 1/UNIT_SHARE.
UNIT_SHARE = 2e-5
#: Foreign letters that scans also put for Slovene ones (fixed values).
_UMLAUTS = set("äöüßÄÖÜ")
#: How many times more frequent the mapped word must be if the vocabulary also knows the raw one.
RATIO = 8

_FOREIGN = "\x80-\x9f¡-ª¬®-º¼¾-ÿĀ-ċĎ-şŢ-żſ-ƿǍ-ɏˇ-˝─-▟�"
_HAS = re.compile(f"[{_FOREIGN}½]")
_BROKEN = re.compile("[\x80-\x9f�]")
_SPACE = re.compile(r"\s")
_TARGET = re.compile(f"[{TARGETS}]")


def _image(text: str, written: str, read: str) -> str | None:
    try:
        return text.encode(written).decode(read)
    except UnicodeError:
        return None


def images() -> dict[str, set[str]]:
    """Of each unit some pair of code pages makes, the targets behind it; read wrongly once or twice."""
    out: dict[str, set[str]] = defaultdict(set)
    for target, written, read in itertools.product(TARGETS, WRITTEN, READ):
        once = _image(target, written, read)
        if once and once != target and once not in TARGETS:
            out[once].add(target)
            for again in READ:
                twice = _image(once, written, again)
                if twice and len(twice) > len(once):
                    out[twice].add(target)
    return out


_KNOWN = images()
_longest = sorted(_KNOWN, key=lambda u: (-len(u), u))
#: One image of a target, or any number of them; images may end in a letter that is no foreign character.
_IMAGES = re.compile(f"(?:{'|'.join(map(re.escape, _longest))})+")
_UNIT = re.compile(f"(?:{'|'.join(re.escape(u) for u in _longest if set(u) & set(TARGETS) and _HAS.match(u))})|[{_FOREIGN}½][{_FOREIGN}½\xa0«»€‚„…†‡‰‹›‘’“”•–—™˜ƒ\xad]*")


def _swapped(unit: str) -> bool:
    """Whether a run of several characters is nothing but images of targets."""
    return len(set(unit)) > 1 and _IMAGES.fullmatch(unit) is not None and (len(unit) > 2 or unit in _KNOWN)


def _utf8(unit: str) -> str | None:
    """What a run of foreign characters is if it is UTF-8 read as a single-byte code page, once or more; else None."""
    done = None
    while len(unit) > 1:
        for read in READ[:5]:
            try:
                new = unit.encode(read).decode("utf-8")
            except UnicodeError:
                continue
            if len(new) < len(unit) and new.isprintable():
                break
        else:
            return done
        done = unit = new
    return done


def _side(char: str) -> str:
    return char.lower() if char.isalpha() else " "


def _contexts(df: DataFrame, text: str, source: str) -> DataFrame:
    """``source``, ``unit``, ``left``, ``right``, ``n``; units of undamaged text have source ''."""

    def make():
        def step(sources, texts):
            counts: Counter = Counter()
            # Beyond a blank there is no context, so undamaged text is counted by its distinct tokens.
            usual: Counter = Counter()
            for s, t in zip(sources, texts):
                if not t or t.isascii():
                    continue
                if not _HAS.search(t):
                    usual.update(t.split())
                    continue
                t = f" {t} "
                for m in _UNIT.finditer(t):
                    if len(m[0]) <= 16:
                        counts[s or "?", m[0], _side(t[m.start() - 1]), _side(t[m.end()])] += 1
            for token, n in usual.items():
                if not token.isascii():
                    token = f" {token} "
                    for m in _TARGET.finditer(token):
                        counts["", m[0], _side(token[m.start() - 1]), _side(token[m.end()])] += n
            keys = list(zip(*counts)) or [[]] * 4
            return {**dict(zip(("source", "unit", "left", "right"), map(list, keys))), "n": list(counts.values())}

        return step

    rows = map_batches(df.select(canonical_source(source).alias("source"), text), "source string, unit string, left string, right string, n bigint", make)
    return rows.groupBy("source", "unit", "left", "right").agg(F.sum("n").alias("n"))


def _foreign(df: DataFrame, text: str, source: str) -> DataFrame:
    """``source``, ``word``, ``df``: in how many rows of a source a word with foreign characters stands; '' counts its rows with text."""

    def make():
        def step(sources, texts):
            counts: Counter = Counter()
            for s, t in zip(sources, texts):
                if t:
                    s = s or "?"
                    counts[s, ""] += 1
                    if not t.isascii() and _HAS.search(t):
                        counts.update((s, w) for w in {x.strip(EDGE).lower() for x in t.split() if _HAS.search(x)} if w.isalpha())
            keys = list(zip(*counts)) or [[]] * 2
            return {"source": list(keys[0]), "word": list(keys[1]), "df": list(counts.values())}

        return step

    return map_batches(df.select(canonical_source(source).alias("source"), text), "source string, word string, df bigint", make).groupBy("source", "word").agg(F.sum("df").alias("df"))


def elsewhere(rows: list[tuple[str, str, int]]) -> dict[tuple[str, str], float]:
    """Of each source and word, the share of the other sources' rows that hold the word; none if there are no others."""
    docs = {s: n for s, w, n in rows if not w}
    total = Counter()
    for _, w, n in rows:
        total[w] += n
    return {(s, w): (total[w] - n) / (total[""] - docs[s]) for s, w, n in rows if w and total[""] > docs[s]}


def learn(rows: list[tuple[str, str, str, str, int]]) -> dict[str, dict[str, str]]:
    """Of each source, unit -> text it stands for, by expectation-maximization over ``rows``."""
    sides = sorted({x for _, _, a, b, _ in rows for x in (a, b)} | {" "})
    at = {c: i for i, c in enumerate(sides)}
    left = np.full((len(TARGETS), len(sides)), 0.02)
    right = left.copy()
    prior = np.ones(len(TARGETS))
    for s, u, a, b, n in rows:
        if s == "":
            t = TARGETS.index(u)
            left[t, at[a]] += n
            right[t, at[b]] += n
            prior[t] += n
    left, right = left / left.sum(1, keepdims=True), right / right.sum(1, keepdims=True)
    known = _KNOWN
    out: dict[str, dict[str, str]] = {}
    for source in sorted({r[0] for r in rows} - {""}):
        seen = Counter()
        for s, u, _, _, n in rows:
            if s == source:
                seen[u] += n
        total = sum(seen.values())
        parts = {u: _parts(u, seen, known) for u, n in seen.items() if n >= UNIT_SHARE * total}
        units = sorted({p[0] for p in parts.values() if len(p) == 1})
        index = {u: i for i, u in enumerate(units)}
        rows_ = [(index[u], at[a], at[b], n) for s, u, a, b, n in rows if s == source and u in index]
        if not rows_:
            continue
        u, a, b, n = map(np.array, zip(*rows_))
        belief = np.full((len(units), len(TARGETS)), UNEXPLAINED)
        for unit, i in index.items():
            for t in known.get(unit, ()):
                belief[i, TARGETS.index(t)] = EXPLAINED
        base = belief.copy()
        context = (left[:, a] * right[:, b]).T * (prior / prior.sum())
        for _ in range(ITERATIONS):
            post = belief[u] * context
            post /= post.sum(1, keepdims=True) + 1e-300
            expected = np.zeros_like(belief)
            np.add.at(expected, u, post * n[:, None])
            # What code pages explain stays a prior: it isn't normalized away with a rare target.
            belief = base * (expected + 0.1) / (expected.sum(0, keepdims=True) + 1.0)
        # The letter most of the unit's occurrences were read as.
        choice = {unit: TARGETS[int(np.argmax(expected[i]))] for unit, i in index.items()}
        out[source] = choice | {w: "".join(choice.get(p, p) for p in ps) for w, ps in parts.items() if len(ps) > 1}
    return out


def _parts(unit: str, seen: Counter, known: dict[str, set[str]]) -> list[str]:
    """``unit`` cut into units that are seen at least as often or explained; itself if that can't be."""
    if unit in known or not 2 <= len(unit) <= 16:
        return [unit]
    best: list[list[str] | None] = [[]] + [None] * len(unit)
    for end in range(1, len(unit) + 1):
        for start in range(end):
            piece = unit[start:end]
            if piece != unit and best[start] is not None and (piece in known or seen[piece] >= seen[unit]):
                cut = [*best[start], piece]
                if best[end] is None or len(cut) < len(best[end]):
                    best[end] = cut
    return best[-1] or [unit]


def restorer(tables: dict[str, dict[str, str]], words: Lexicon, others: dict[tuple[str, str], float] | None = None):
    """Function from (source, text) to (restored text, whether some of it was garbled).

    ``others`` gives the share of the other sources' rows that hold a form, as :func:`elsewhere` does: what a
    whole source has garbled alike is rare there, so its frequency isn't taken for soundness.
    """
    others = others or {}
    known = _KNOWN
    single = {s: str.maketrans({u: t for u, t in table.items() if len(u) == 1}) for s, table in tables.items()}

    def core(token: str) -> str:
        return token.strip(EDGE).lower()

    def weight(source: str, form: str) -> float:
        """In how many documents a form stands, going by the other sources where it is rarer."""
        n, share = words.get(form), others.get((source, form))
        return n if share is None else min(n, share * words.docs)

    def better(source: str, raw: str, new: str, proof: bool) -> bool:
        a, b = core(raw), core(new)
        return len(b) > 1 and a != b and words.get(b) > 0 and (proof or words.get(b) >= RATIO * weight(source, a))

    def mapped(source: str, token: str) -> str:
        table = tables.get(source, {})

        def unit(m: re.Match) -> str:
            u = m[0]
            if u not in known and len(u) > 1 and (t := _utf8(u)) is not None:
                return t
            if (t := table.get(u)) is not None:
                return t
            return "".join(table.get(p) or _one(known, p) for p in _parts(m[0], Counter(), known))

        many = _UNIT.sub(lambda m: unit(m) if len(m[0]) > 1 else m[0], token)
        return many.translate(single[source]) if source in single else many

    def fix(key: tuple[str, str]) -> tuple[str, int]:
        """The restored token and how far it shows garbling; 3 is proof."""
        source, token = key
        # A run of characters that only a code page swap makes is one whatever the word and however frequent.
        proof = any(_swapped(m[0]) or len(m[0]) <= 64 and _utf8(m[0]) is not None for m in _UNIT.finditer(token))
        if not proof and weight(source, core(token)) > 50 * words.docs * 2e-4:
            return token, 0
        new = mapped(source, token)
        if new != token and better(source, token, new, proof):
            # Umlauts and a sharp s alone may also be letters that a scan misread.
            return new, 1 if not proof and set(_HAS.findall(token)) <= _UMLAUTS else 3
        if proof:
            return new, 3
        return token, 3 * bool(_BROKEN.search(token))

    def lost(token: str) -> str | None:
        """``token`` with letters in place of its question marks, if the vocabulary has just such a word.

        A mark inside a word or before one is no question; one behind a word may be. A quotation mark may
        have been lost before a known word.
        """
        inside = re.search(r"(?<=\w)\?(?=\w)", token)
        before = re.match(r"[\"'(]*\?(?=\w)", token)
        if not (inside or before or re.fullmatch(r"[^\W\d]+\?[.,;!]?", token)) or token.count("?") > 4:
            return None
        inner = core(token.lstrip("?"))
        holes = [i for i, c in enumerate(token) if c == "?"]
        best, most = None, RATIO * words.get(inner)
        for letters in itertools.product("čšž", repeat=len(holes)):
            chars = list(token)
            for i, c in zip(holes, letters):
                chars[i] = c
            n = words.get(core("".join(chars)))
            if n > most:
                best, most = "".join(chars), n
        if best is None and token.startswith("?") and words.get(inner):
            return "»" + token[1:]
        return best

    fixes, holes = Memo(fix), Memo(lost)

    def restore(source: str | None, text: str | None) -> tuple[str | None, bool]:
        if not text:
            return text, False
        source, garbled, shown = source or "?", False, 0
        if _HAS.search(text):

            def token(m: re.Match) -> str:
                nonlocal shown
                # A division mark at a line's end is a scan's.
                if not _HAS.search(m[0]) or m[0][-1] == "¬" and text[m.end() : m.end() + 1] in " \n" and not _HAS.search(m[0][:-1]):
                    return m[0]
                new, bad = fixes[source, m[0]] if len(m[0]) < 64 else fix((source, m[0]))
                shown += bad
                return new if bad else m[0]

            new = re.sub(r"[^ \n\t\r]+", token, text)
            if shown >= 3:
                text, garbled = new, True
        at = text.find("?")
        if at >= 0:
            out, last = [], 0
            while at >= 0:
                start = max(text.rfind(" ", last, at), text.rfind("\n", last, at), last - 1) + 1
                end = m.start() if (m := _SPACE.search(text, at)) else len(text)
                token = text[start:end]
                new = holes[token] if len(token) <= 40 else None
                if new is not None:
                    out += (text[last:start], new)
                    last, garbled = end, True
                at = text.find("?", end)
            text = "".join(out) + text[last:]
        return text, garbled

    return restore


def _one(known: dict[str, set[str]], unit: str) -> str:
    targets = known.get(unit)
    return next(iter(targets)) if targets and len(targets) == 1 else unit


def restored(df: DataFrame, key: str = "row_id", text: str = "text", source: str = "source") -> DataFrame:
    """``key``, restored ``text``, ``garbled`` of every row.

    Text that can't be restored (letters lost to U+FFFD) stays as it is but counts as garbled. Null and
    empty texts come out unchanged, a null source is a source of its own; repeated rows are kept and an
    empty table gives no rows. The texts are read four times (vocabulary, contexts, foreign words by source, restoration) and
    never shuffled; tables sent to workers are bounded by SHARE and UNIT_SHARE.
    """
    vocabulary: Broadcast = lexicon(df, text)
    # Written once: both the units and their totals are taken from it.
    counted = checkpointed(_contexts(df, text, source))
    every = counted.groupBy("source", "unit").agg(F.sum("n").alias("_u"))
    kept = counted.join(_frequent(every), ["source", "unit"]).select("source", "unit", "left", "right", "n")
    # Undamaged text has few letters beyond ASCII and their neighbours; each source is learned where its rows are.
    usual = [tuple(r) for r in kept.where("source = ''").collect()]

    def learned(rows: pd.DataFrame) -> pd.DataFrame:
        table = learn(usual + list(rows.itertuples(index=False, name=None)))
        return pd.DataFrame([(s, u, t) for s, units in table.items() for u, t in units.items()], columns=["source", "unit", "target"])

    found: dict[str, dict[str, str]] = {}
    for r in kept.where("source <> ''").groupBy("source").applyInPandas(learned, "source string, unit string, target string").toLocalIterator():
        found.setdefault(r["source"], {})[r["unit"]] = r["target"]
    tables = df.sparkSession.sparkContext.broadcast(found)
    foreign = checkpointed(_foreign(df, text, source))
    docs = foreign.where("word = ''").select("source", F.col("df").alias("_docs"))
    shared = foreign.join(docs, "source").where((F.col("word") == "") | (F.col("df") >= SHARE * F.col("_docs"))).select("source", "word", "df")
    others = df.sparkSession.sparkContext.broadcast(elsewhere([tuple(r) for r in shared.collect()]))

    def make():
        restore = restorer(tables.value, vocabulary.value, others.value)

        def step(keys, sources, texts):
            done = [restore(s, t) for s, t in zip(sources, texts)]
            return {key: keys, "text": [d[0] for d in done], "garbled": [d[1] for d in done]}

        return step

    return map_batches(df.select(key, canonical_source(source).alias(source), text), f"{key} {df.schema[key].dataType.simpleString()}, text string, garbled boolean", make)


def _frequent(units: DataFrame) -> DataFrame:
    totals = units.groupBy("source").agg(F.sum("_u").alias("_total"))
    return units.join(totals, "source").where(F.col("_u") >= UNIT_SHARE * F.col("_total")).select("source", "unit")

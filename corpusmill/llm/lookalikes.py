"""Problem 6: one form for text that looks the same.

Tokens that hold an unusual character are looked up in a trie of the corpus vocabulary by a weighted
edit automaton: look-alikes, presentation forms and ignorables cost nothing, a lost or added diacritic
costs 1. The cheapest word within the budget, and of equals the most frequent, is the spelling; tokens
without one are normalized by the table of look-alikes alone.
"""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import Memo, map_batches
from .lexicon import Lexicon, lexicon

#: Characters that take no room (fixed value).
ZERO_WIDTH = "​‌‍⁠﻿"
#: Blanks of other widths or without a break (fixed value).
BLANKS = "   　"
#: Greek and Cyrillic letters and the Latin letters they look like (fixed values).
GREEK = dict(zip("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧανορτυικ", "ABEZHIKMNOPTYXavoptuik", strict=True)) | {"ό": "ó", "Ό": "Ó", "χ": "x", "ς": "s", "γ": "y", "λ": "l"}
CYRILLIC = dict(zip("АВЕЅІЈКМНОРСТУХЗаеѕіјорсухкмнтвпгзи", "ABESIJKMHOPCTYXZaesijopcyxkmntvngzu", strict=True))
#: Ranges of ligatures, digraphs, full-width forms and mathematical letters (fixed values).
FORMS = "ﬀ-ﬆﬓ-ﬗĲĳǄ-ǌǱ-ǳ！-｠￠-￦\U0001d400-\U0001d7ffℂℊ-ℓℕℙ-ℝℤℨℬℭℯ-ℱℳℴ"
_UNUSUAL = re.compile(f"[{FORMS}{ZERO_WIDTH}{BLANKS}Ͱ-ԯ]|[^\x00-˿‐-›€─-╿]")
_FORM = re.compile(f"[{FORMS}]")
_INVISIBLE = re.compile(f"[{ZERO_WIDTH}]")
_BLANK = re.compile(f"[{BLANKS}]")
#: A run of letters with what may stand unseen among them.
_WORD = re.compile(rf"(?:[^\W\d_]|[̀-ͯ{ZERO_WIDTH}])+")
_LATIN = re.compile("[A-Za-zªºÀ-ÖØ-öø-ʯḀ-ỿﬀ-ﬆＡ-Ｚａ-ｚ]")
_OTHER = re.compile("[Ͱ-ϿЀ-ԯἀ-῿]")
#: Cost of a diacritic that is lost or added, and the most a token may cost.
DIACRITIC_COST, BUDGET = 1, 1


def mixed(word: str) -> bool:
    """Whether a word has Latin and also Greek or Cyrillic letters. Mathematical letters count as Latin."""
    return bool(_OTHER.search(word)) and bool(_LATIN.search(word) or re.search("[\U0001d400-\U0001d6a3]", word))


def plain(char: str) -> str:
    """A character in its usual form: compatibility forms opened, look-alikes Latin, blanks plain."""
    if char in ZERO_WIDTH:
        return ""
    if char in BLANKS:
        return " "
    if _FORM.match(char):
        return unicodedata.normalize("NFKC", char)
    return GREEK.get(char) or CYRILLIC.get(char) or char


def by_table(token: str) -> str:
    """A token normalized without the vocabulary; look-alikes only change in words of mixed scripts."""
    token = unicodedata.normalize("NFC", _INVISIBLE.sub("", _BLANK.sub(" ", token)))
    token = _FORM.sub(lambda m: unicodedata.normalize("NFKC", m[0]), token)
    token = _WORD.sub(lambda m: "".join(map(plain, m[0])) if mixed(m[0]) else m[0], token)
    return unicodedata.normalize("NFC", token)


class Trie:
    """Vocabulary trie with the weighted edit automaton."""

    def __init__(self, words: Lexicon):
        self.root: dict = {}
        for word, n in words.words.items():
            node = self.root
            for c in word:
                node = node.setdefault(c, {})
            node[""] = (n, word)

    def spell(self, token: str) -> str | None:
        """The vocabulary word that looks like ``token`` (lower case), or None."""
        units = [plain(c) for c in unicodedata.normalize("NFD", token)]
        text = "".join(units).lower()
        #: States of the automaton: trie node, place in the text, cost.
        best, states = None, [(self.root, 0, 0)]
        while states:
            node, at, cost = states.pop()
            if at == len(text):
                if "" in node and (best is None or (cost, -node[""][0]) < best[0]):
                    best = ((cost, -node[""][0]), node[""][1])
                continue
            c = text[at]
            end = at + 1
            while end < len(text) and unicodedata.combining(text[end]):
                end += 1
            whole = unicodedata.normalize("NFC", text[at:end])
            if whole in node:
                states.append((node[whole], end, cost))
            if cost + DIACRITIC_COST <= BUDGET and _OTHER.match(c):
                states += ((node[other], end, cost + DIACRITIC_COST) for other in node if other)
            elif cost + DIACRITIC_COST <= BUDGET:
                if end > at + 1 and c in node:
                    states.append((node[c], end, cost + DIACRITIC_COST))
                for other in node:
                    if other and other != whole and unicodedata.normalize("NFD", other)[0] == c:
                        states.append((node[other], end, cost + DIACRITIC_COST))
        return best[1] if best else None


def _cased(model: str, word: str) -> str:
    """``word`` in the case of ``model``: the table's form decides."""
    if model.isupper() and len(model) > 1:
        return word.upper()
    return word[:1].upper() + word[1:] if model[:1].isupper() else word


def normalizer(words: Lexicon):
    """Function from a text to (its one form, whether it has the marks of problem 6)."""
    trie = words.once(Trie)

    def word(match: re.Match) -> str:
        raw = match[0]
        form = by_table(raw)
        # Words of one script in usual characters stand as they are.
        if form == raw and not mixed(raw):
            return raw
        # Whole words of another script aren't spelled in this one.
        found = trie.spell(raw.lower()) if _LATIN.search(form) else None
        if found and found != form.lower() and form.lower() in words:
            return form
        return _cased(form, found) if found else form

    def token(raw: str) -> tuple[str, bool]:
        clean = by_table(_WORD.sub(word, unicodedata.normalize("NFC", _BLANK.sub(" ", raw))))
        # Changed or not to be resolved: only such tokens are checked for the marks.
        return clean, (clean != raw or any(mixed(w) for w in _WORD.findall(clean))) and marked(raw)

    memo = Memo(token)

    def normalize(text: str | None) -> tuple[str | None, bool]:
        if not text or text.isascii() or not _UNUSUAL.search(text) and unicodedata.is_normalized("NFC", text):
            return text, False
        found, out, last = False, [], 0
        for m in re.finditer(r"[^ \n\t\r\f\v]+", text):
            if not m[0].isascii():
                new, mark = memo[m[0]] if len(m[0]) < 64 else token(m[0])
                found |= mark
                if new != m[0]:
                    out += (text[last : m.start()], new)
                    last = m.end()
        return "".join(out) + text[last:], found

    return normalize


def marked(token: str) -> bool:
    """Exact check of a token against the marks that TESTDATA.md lists for p6_found."""
    return bool(
        _FORM.search(token)
        or _INVISIBLE.search(token)
        or _BLANK.search(token)
        or not unicodedata.is_normalized("NFC", token)
        or _OTHER.search(token)
        and any(mixed(w) for w in _WORD.findall(token))
    )


def one_form(df: DataFrame, fields: tuple[str, ...] = ("text", "title"), key: str = "row_id") -> DataFrame:
    """``key`` and, of each field, its one form and ``<field>_marked``.

    Null stays null, empty stays empty; an empty table gives no rows. Repeated rows are kept. The
    vocabulary is that of the first field, see :mod:`.lexicon` for its bound.
    """
    vocabulary = lexicon(df, fields[0])

    def make():
        normalize = normalizer(vocabulary.value)

        def step(keys, *columns):
            out = {key: keys}
            for field, values in zip(fields, columns):
                done = [normalize(v) for v in values]
                out[field], out[f"{field}_marked"] = [d[0] for d in done], [d[1] for d in done]
            return out

        return step

    schema = ", ".join([f"{key} {df.schema[key].dataType.simpleString()}", *(f"{f} string, {f}_marked boolean" for f in fields)])
    return map_batches(df.select(key, *fields), schema, make)


def marked_fields(df: DataFrame, fields: tuple[str, ...] = ("text", "title"), key: str = "row_id") -> DataFrame:
    """Distinct ``key``, ``field`` of the fields that :func:`one_form` found marked."""
    done = one_form(df, fields, key)
    rows = F.array(*(F.struct(F.lit(f).alias("field"), F.col(f"{f}_marked").alias("marked")) for f in fields))
    return done.select(key, F.explode(rows).alias("f")).where("f.marked").select(key, "f.field").distinct()

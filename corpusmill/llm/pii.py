"""Problem 10: personal data in running text becomes typed placeholders.

Candidate gradient boosting: generators of high recall propose overlapping spans, boosted trees score
each by its format and context, and of the spans above their kind's calibrated threshold the best
scored that don't overlap are replaced. The trees are fitted on ``TRAINING`` sentences made from the
templates below with a seed, so the model is the same whatever table it runs over.
"""

from __future__ import annotations

import random
import re
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import map_batches
from .boosting import BoostedTrees
from .lexicon import Lexicon, lexicon

KINDS = ("email", "phone", "id_number", "address", "name")
PLACEHOLDERS = {"email": "[EMAIL]", "phone": "[PHONE]", "id_number": "[ID]", "address": "[ADDRESS]", "name": "[NAME]"}
#: Labelled sentences the trees are fitted on (the bound of the training sample), and those thresholds are calibrated on.
TRAINING, CALIBRATION = 9000, 2500
#: Share of the labelled cases that no word announces.
UNANNOUNCED = 0.2

_UP, _LOW = "A-ZČŠŽĆĐ", "a-zčšžćđ"
_NAME = rf"[{_UP}][{_LOW}]+"
_SURNAME = rf"{_NAME}(?:-{_NAME})?"
_AT = r"(?:\s*[(\[{]\s*(?:at|afna|pri)\s*[)\]}]\s*|\s+(?:at|afna)\s+)"
_DOT = r"(?:\s*[(\[{]\s*(?:dot|pika)\s*[)\]}]\s*|\s+(?:dot|pika)\s+|\.)"
# Each pattern begins with a set of characters, which the engine looks for fast, and looks back from there.
GENERATORS = {
    "email": [re.compile(r"[A-Za-z0-9][\w.+%-]*@[A-Za-z0-9][A-Za-z0-9-]*(?:\.[A-Za-z0-9-]+)+"), re.compile(rf"[A-Za-z0-9][\w.+%-]*{_AT}[A-Za-z0-9][A-Za-z0-9-]*(?:{_DOT}[A-Za-z0-9-]+)+", re.I)],
    "phone": [re.compile(r"[+(\d](?<![\w+.-].)(?<!\d/.)[\d ()./\xa0-]{6,19}\d(?![\w-]|[./]\d)", re.S)],
    "id_number": [re.compile(r"\d(?<![\w-].)(?<!\d/.)(?:\d{6}[ -]?\d{2}[ -]?\d{4}|\d{7})(?![\w-]|/\d)", re.S), re.compile(r"[A-Z](?<![\w-].)[A-Z]{0,2} ?\d{6,9}(?![\w-]|/\d)", re.S)],
    "name": [
        re.compile(rf"[{_UP}](?<![\w.@°-].)(?:[{_LOW}]+[ \n]{_SURNAME}|\.[ \n]?{_SURNAME})(?![\w@])", re.S),
        re.compile(rf"[{_UP}](?<![\w.@°-].)[{_UP}]{{2,}}(?:-[{_UP}]{{3,}})?[ \n]{_NAME}(?![\w@])", re.S),
        re.compile(rf"[{_UP}](?<![\w.@°-].)[{_LOW}]+(?:-{_NAME})?,[ \n]{_NAME}(?![\w@])", re.S),
    ],
}
#: House number with what may follow it; the street is looked for before it.
_HOUSE = re.compile(rf"\d(?<= .)\d{{0,2}}(?:/\d{{1,3}}| ?[A-Za-z](?!\w))?(?:,?\s+(?:[A-Z]{{1,2}}-)?\d{{4}} [{_UP}]\w+(?: [{_UP}]\w+)?)?(?!\w)")
_STREET_WORD = re.compile(r"[\w.]+\Z")
_DISGUISED = re.compile(r"[(\[{]\s*(?:at|afna|pri)\s*[)\]}]|\s(?:at|afna)\s", re.I)
_TRIGGER = re.compile(rf"[@(\[{{]\s?(?:at|afna)|@|\d|[{_UP}][{_LOW}]*[.,]?[ \n][{_UP}]")

#: Words that stand before (or after) each kind, and before numbers that aren't personal (fixed values).
CUES = {
    "email": re.compile(r"e-?(?:pošt|mail)|mailto|piš[ie]|naslov|prek|odgovor|glej|popravke", re.I),
    "phone": re.compile(r"tel\b|telefon|gsm|mob\b|pokliči|kliči|številk[io]|zavrtite|☎|☏|📞", re.I),
    "id_number": re.compile(r"emšo|matičn|davčn|potn\w+ list|izkaznic|osebn|ddv|identifikacij", re.I),
    "address": re.compile(r"naslov|stanuj|prebiva|izvod|pošlji|bivališč", re.I),
    "name": re.compile(r"gospo\w+|\bga?\.|\bdr\.|sosed|prepis|uredila|gradivo|hrani|pozdrav|tvoj|opombe|prispeval|podpis|vpisano|bralec|imenik|zapisano|vprašajte|pravi|prim\.|branju|pomagala|besedah|zahvaljuj", re.I),
    "other": re.compile(r"koda|kat-?id|\binv\b|signatur|oznak|isbn|issn|letnik|\bstr\b|stran|\bspis|zvezk|verz|\btab\b|\bleta?\b|\bdne\b|račun|znesek|cena|zbirka|\burn\b|https?:|št\. str|katalog", re.I),
}
STREET = re.compile(r"\b(?:ulic\w*|ul\.|cest\w*|c\.|trg\w*|pot|vas|nabrež\w*|nasel\w*|drevored|steza|produ|studencu|gozdu|zvonikom|kovačev)(?!\w)", re.I)
_EMSO = (7, 6, 5, 4, 3, 2, 7, 6, 5, 4, 3, 2)


def emso_valid(digits: str) -> bool:
    """Control digit and date of a 13-digit personal number."""
    if len(digits) != 13:
        return False
    rest = sum(a * int(b) for a, b in zip(_EMSO, digits)) % 11
    return (11 - rest if rest else 0) % 11 == int(digits[12]) and rest != 1 and 1 <= int(digits[:2]) <= 31 and 1 <= int(digits[2:4]) <= 12


def candidates(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of every span some generator proposes; spans may overlap.

    Spans beginning at later words of a longer address candidate are proposed too.
    """
    if not _TRIGGER.search(text):
        return []
    out = set()
    for kind, patterns in GENERATORS.items():
        for pattern in patterns:
            if kind == "email" and not ("@" in text if pattern is patterns[0] else _DISGUISED.search(text)):
                continue
            at = 0
            while m := pattern.search(text, at):
                out.add((kind, *m.span()))
                at = m.end() if kind != "name" else m.start() + 1
    for m in _HOUSE.finditer(text):
        # Up to five words before the number, each of which may begin the street's name.
        start = m.start() - 1
        for _ in range(5):
            word = _STREET_WORD.search(text, max(0, start - 40), start)
            if not word:
                break
            start = word.start()
            if text[start].isupper():
                out.add(("address", start, m.end()))
            if start == 0 or text[start - 1] != " ":
                break
            start -= 1
    return sorted(out, key=lambda s: (s[1], s[2], s[0]))


class Shares:
    """Shares of documents that hold a word at all and in lower case, as the features use them."""

    def __init__(self, words: Lexicon, lower: Lexicon):
        self.words, self.lower = words, lower

    def any(self, word: str) -> float:
        return self.words.get(word.lower()) / max(1, self.words.docs)

    def small(self, word: str) -> float:
        return self.lower.get(word.lower()) / max(1, self.lower.docs)


def features(text: str, kind: str, start: int, end: int, shares) -> list[float]:
    """Format and context of one candidate."""
    span = text[start:end]
    before, after = text[max(0, start - 34) : start], text[end : end + 24]
    line = before.rsplit("\n\n", 1)[-1]
    digits = re.sub(r"\D", "", span)
    words = re.findall(r"[^\W\d_]+", span)
    near = {k: max((m.end() for m in p.finditer(line)), default=-1) for k, p in CUES.items()}
    tail = before.rstrip(" \n(\"»„[/:–-")
    out = [float(kind == k) for k in KINDS]
    out += [1.0 - (len(line) - near[k]) / 40 if near[k] >= 0 else 0.0 for k in (*KINDS, "other")]
    out += [float(near[kind] >= 0 and near[kind] > near["other"]), float(near["other"] >= 0 and near["other"] > near[kind])]
    out += [len(digits), len(span), len(words), float(span[:1] in "+(0"), float(span.startswith(("+", "00"))), float(emso_valid(digits)), float(span[:2] == "SI" or bool(re.match(r"[A-Z]{2}\d{7}$", span)))]
    out += [len(set(re.sub(r"\w", "", span))), float(bool(re.search(r"\d[ ./()-]+\d[ ./()-]+\d", span))), float(bool(re.match(r"\d{1,2}\. ?\d{1,2}\. ?\d{4}$|1[5-9]\d\d|20\d\d", span)))]
    out += [float(bool(STREET.search(span))), float(bool(re.search(r"\d{4} [A-ZČŠŽ]", span))), float(bool(re.match(r"(?:[(\[/–;:,.!?»«\s]|$)", text[end : end + 1] or " "))), float(bool(re.search(r"[(\[/–:-]\s?$", before[-3:]))), float(bool(re.match(r"\s?[)\]/–]|, |\.", after)))]
    out += [float("int." in after[:8] or "osebn" in after), float(bool(re.search(r"\d{3,4},? ?$|[vVnNdDiI][aoz]? $|\biz $", before))), float(bool(re.search(r"[.!?»«:;]\s*$|^$", tail[-1:] + " ")) or not tail)]
    if kind == "name":
        a, b = (words + ["", ""])[:2]
        if "," in span or len(a) > 2 and a.isupper():
            a, b = b, a
        small, any_ = [shares.small(w) for w in (a, *words[1:], b)], [shares.any(w) for w in (a, b)]
        out += [min(1.0, 200 * max(small)), min(1.0, 50 * any_[0]), min(1.0, 200 * any_[1]), float(len(a) == 1), float("," in span), float("-" in span), float(len(b) > 2 and b.isupper()), len(b)]
    elif kind == "address":
        first = words[0] if words else ""
        inner = re.match(r"\D*", span)[0].split()
        out += [float(span[:1].isupper()), float(bool(STREET.search(" ".join(inner[-1:])))), len(inner), float(any(w.endswith((".", "!", "?")) and len(w) > 4 for w in inner)), float(first.lower() in ("leta", "stran", "računa", "verz", "glej", "gsm", "tel")), 0.0, float(span.isupper()), float(bool(re.search(r"\bje\b|\bin\b|\bse\b|\bso\b", " ".join(inner), re.I)))]
    else:
        out += [float("@" in span or "(" in span), span.count("."), span.count("-"), span.count(" "), span.count("/"), 0.0, float(span[:1].isalpha()), float(len(digits) in (8, 9))]
    return out


class _Stub:
    """Word shares for training sentences, looked up in what the sentence maker drew."""

    def __init__(self):
        self.table: dict[str, tuple[float, float]] = {}

    def any(self, word: str) -> float:
        return self.table.get(word.lower(), (0.0, 0.0))[0]

    def small(self, word: str) -> float:
        return self.table.get(word.lower(), (0.0, 0.0))[1]


class _Maker:
    """Makes labelled sentences: every kind in its formats and wordings, and look-alikes that are none."""

    #: Parts words are made of, wordings and formats (fixed values).
    SYLLABLES = "ba be bo da de di ga go je ka ke ko la le li lo ma me mi na ne ni no pa po ra re ri ro sa se si ta te ti to va ve vi za že ži ča če ši šo".split()

    def __init__(self, seed: int):
        self.r = random.Random(seed)
        self.stub = _Stub()

    def word(self, share: tuple[float, float], least: int = 2) -> str:
        w = "".join(self.r.choice(self.SYLLABLES) for _ in range(self.r.randint(least, 4))) + self.r.choice(["", "", "k", "r", "c", "n"])
        if w not in self.stub.table:
            any_ = self.r.uniform(*share)
            self.stub.table[w] = (any_, any_ * self.r.uniform(0.3, 1))
        return w

    def plain(self, n: int) -> str:
        return " ".join(self.word((0.002, 0.3)) for _ in range(n))

    def proper(self, low: float, high: float) -> str:
        w = self.word((0.002, 0.3), 3)
        self.stub.table[w + "ič"] = (self.r.uniform(low, high), 0.0)
        return (w + "ič").capitalize()

    def place(self) -> str:
        a, b = self.word((0.01, 0.3)), self.proper(0.01, 0.15)
        if self.r.random() < 0.4:
            a = self.proper(0.01, 0.15).lower()
        return f"{a.capitalize()} {b}"

    def digits(self, n: int, first: str = "0123456789") -> str:
        return self.r.choice(first) + "".join(str(self.r.randint(0, 9)) for _ in range(n - 1))

    def email(self) -> str:
        user = self.r.choice([f"{self.word((0, 0))}.{self.word((0, 0))}", self.word((0, 0)) + self.digits(2), f"{self.word((0, 0))}_{self.word((0, 0))}+{self.word((0, 0))}", self.word((0, 0)) + "-" + self.digits(2)])
        dots = [self.word((0, 0)) for _ in range(self.r.randint(1, 3))] + [self.r.choice(["si", "example", "net", "org", "com"])]
        if self.r.random() < 0.35:
            at, dot = self.r.choice([(" (at) ", " (dot) "), (" [afna] ", " [pika] "), (" (afna) ", " (pika) "), ("[at]", "[dot]"), (" at ", " dot ")])
            return user + at + dot.join(dots)
        mail = f"{user}@{'.'.join(dots)}"
        return mail.upper() if self.r.random() < 0.15 else mail

    def phone(self) -> str:
        d = self.digits
        area = self.r.choice(["01", "02", "03", "04", "05", "07", "031", "040", "041", "051", "068", "070", "098", "099"])
        a, b, c = d(3), d(3), d(3)
        return self.r.choice([
            f"{area}/{a}-{b}", f"{area} {a} {b}", f"{area}.{a}.{b}", f"{area}{a}{b}", f"({area}) {a} {b}", f"+386 {area[1:]} {a} {b}", f"+386(0){area[1:]}-{a}-{b}", f"00386 {area[1:]} {a}{b}", f"+{d(1, '1234')} {a} {b} {c}{d(1)}", f"0 {area[1:]} {a[0]} {a[1:]} {b[:2]} {b[2]}", f"{area}-{a}-{b}", f"{area}/{a[:2]}-{a[2]}{b[0]}-{b[1:]}",
        ])

    def emso(self) -> str:
        while True:
            s = f"{self.r.randint(1, 28):02}{self.r.randint(1, 12):02}{self.r.randint(800, 999)}50{self.digits(3)}"
            for k in "0123456789":
                if emso_valid(s + k):
                    s += k
                    return self.r.choice([s, f"{s[:7]} {s[7:9]} {s[9:]}", f"{s[:7]} {s[7:]}", f"{s[:7]}-{s[7:]}", f"{s[:7]}-{s[7:9]} {s[9:]}"])

    def street(self) -> str:
        a, b = self.proper(0, 0.01), self.word((0.001, 0.05))
        return self.r.choice([f"{a} ulica", f"Ulica {b} {b}", f"{a} ul.", f"Ul. {b} {b}", f"{a} cesta", f"{a} c.", f"Cesta ob {b}", f"Trg pod {b}", f"{a} trg", f"{a} pot", f"Pot v {a}", f"Na produ", f"Pri studencu", f"{a} vas", f"Pod {b}", f"Na {b}"])

    def address(self) -> str:
        n = str(self.r.randint(1, 140))
        n += self.r.choice(["", "", "", "a", " b", "/3", "A"])
        s = f"{self.street()} {n}"
        if self.r.random() < 0.6:
            s += self.r.choice([", ", "\n", ", "]) + self.r.choice(["", "SI-"]) + self.digits(4, "123456789") + " " + self.r.choice([self.place(), self.proper(0.01, 0.1)])
        return s.upper() if self.r.random() < 0.12 else s

    def name(self) -> str:
        given, sur = self.proper(0.0, 0.2), self.proper(0.0, 0.0006)
        if self.r.random() < 0.3:
            sur += "-" + self.proper(0.0, 0.0006)
        return self.r.choice([f"{given} {sur}", f"{given} {sur}", f"{given[0]}. {sur.split('-')[0]}a", f"{sur.split('-')[0].upper()} {given}", f"{sur.split('-')[0]}, {given}"])

    STRAY = ("sosed", "sosede", "podpis", "naslov", "potnik", "pisar je pisal", "bralec", "telo", "prebiva", "glej", "gospa", "prepis", "številka", "izvod", "pravi", "stanuje", "prim.")
    LEADS = {
        "email": ["Pišite mi: {}", "E-pošta: {}.", "Odgovor pošljite na {}, prosim.", "Popravke zbira {}; hvala.", "Dosegljiv naslov je {} (do petka).", "{}", "glej <{}>", "mailto:{}"],
        "phone": ["Tel.: {}.", "GSM {} – samo nujno.", "Pokličite na {} po peti uri.", "Dobite me na številki {}, najraje zvečer.", "Za izposojo zavrtite {}!", "☎ {}", "mob. {}", "tel. {}", "☎ {}", "mob. {}", "tel. {}", "{}", "{}, int. 12"],
        "id_number": ["EMŠO {} je na izkaznici.", "Član je vpisan pod EMŠO: {}.", "matična številka {}.", "Identifikacija: {} (osebna).", "Davčna številka: {}.", "davčno št. {}.", "Pokazal je potni list {}.", "Osebna izkaznica št. {} je bila priložena.", "ID za DDV osebe je {}.", "Številka potnega lista: {}."],
        "address": ["Stanujem na naslovu {}, zvonec ne dela.", "Prinesite izvod: {}.", "Naslov pošiljatelja: {}.", "Knjige pošljite na naslov {}.", "na naslovu {}", "stanujoč: {}", "{}"],
        "name": ["Lep pozdrav, {}.", "Podpis: {}.", "Prepis je uredila {}.", "Gradivo hrani {}.", "Po besedah gospoda {} je stran izgubljena.", "Zahvaljujem se gospodu {}.", "Vpisano: {}, prostovoljec.", "Vprašajte dr. {} o letnici.", "V imeniku je zapisano {}.", "kot pravi {}", "prim. {}", "{}", "tvoj {}", "ga. {}."],
    }

    def decoy(self) -> str:
        d, r = self.digits, self.r
        return r.choice([
            lambda: f"Črtna koda {d(13)} pripada zvezku {d(1)}.", lambda: f"KAT-ID {d(8)} in inv. št. 098 {d(3)} sta navedena v katalogu.", lambda: f"Zvezek 1{d(3)} ima oznako {d(3)}-{d(2)}/1{d(3)}.", lambda: f"Glej letnik 1{d(3)}, str. {d(3)}–{d(3)}.",
            lambda: f"Spis z dne {r.randint(1, 31)}. {r.randint(1, 12)}. 1{d(3)}.", lambda: f"ISBN 978-{d(3)}-{d(4)}-{d(2)}-{d(1)} je napačen.", lambda: f"Zbirka {self.place()}, {self.place()} 19{d(2)}, signatura D {d(5)}/{d(1)}.", lambda: f"Leta 1{d(3)} je {self.plain(3)} v {self.place()}.",
            lambda: f"V {self.place()} je {self.plain(3)}.", lambda: f"{self.proper(0.01, 0.2)} (* 1{d(3)}, {self.place()}, † 1{d(3)}) je pojem.", lambda: f"»{self.word((0.01, 0.3)).capitalize()}, {self.proper(0.05, 0.3)},« je {self.plain(2)}.", lambda: f"Šel je po {self.proper(0, 0.05)} ulici in čez Trg pod {self.plain(1)} do {self.place()}.",
            lambda: f"Uporabnik @bralec{d(2)} je dodal {d(1)} kg papirja @ {d(1)} evra.", lambda: f"Račun {d(1)} * {d(1)} = {d(2)} in znesek ${d(2)} sta ob robu.", lambda: f"{self.plain(2).capitalize()} na strani {d(2)}.", lambda: f"Voda vre pri 100 °C, na hribu pri {d(2)} °C. {self.plain(2).capitalize()} {self.plain(3)}.",
            lambda: f"Stran {d(3)}\n\n{self.plain(4).capitalize()}.", lambda: f"je dodal * ob verzu {d(2)}. {self.plain(2).capitalize()} {self.plain(3)}.", lambda: f"{self.plain(3).capitalize()}, {self.proper(0.02, 0.3)} {self.plain(2)}; {self.proper(0.02, 0.3)} je {self.plain(2)}.", lambda: f"{d(2)}     {self.word((0.01, 0.3)).upper()}\n{self.plain(3).capitalize()}",
            lambda: f"Izposoja št. {d(6)} z dne 1. {r.randint(1, 12)}.", lambda: f"URN:NBN:SI:DOC-{d(8)}", lambda: f"Cena je bila {d(2)} goldinarja, po § {d(2)} pa polovico.", lambda: f"{self.proper(0.02, 0.3).upper()}: {self.plain(3).capitalize()} {self.plain(2)}.",
            lambda: f"V obrazcu stoji x + y = {d(2)} (gl. tab. {d(1)}b). {self.plain(3).capitalize()}.", lambda: f"Bil je {r.randint(1, 28)}. maj, ura 10:{d(2)}, in vlak je imel {d(1)}–10 minut zamude.", lambda: f"{self.place()} {self.plain(2)} {d(2)} let.",
            lambda: f"{self.plain(2).capitalize()} {r.randint(1, 31)}. {r.randint(1, 12)}. 1{r.choice('5678999')}{d(2)} {self.plain(2)}.", lambda: f"{self.plain(2).capitalize()}, {r.randint(1, 31)}. {r.randint(1, 12)}. 1{r.choice('5678999')}{d(2)}\n\n{self.plain(3).capitalize()}",
        ])()

    def sentence(self) -> tuple[str, str | None, int, int]:
        left = self.plain(self.r.randint(2, 6)).capitalize() + self.r.choice([" ", ". ", ".\n", ".\n\n", " (op. ur.: ", " – ", " [", " /"])
        right = self.r.choice([" ", ") ", " – ", "] ", "/ ", "\n", " "]) + self.plain(4)
        if self.r.random() < 0.5:
            # Words that are cues also stand in ordinary prose.
            if self.r.random() < 0.35:
                left += self.r.choice(self.STRAY) + self.r.choice([" ", ". ", ". »", ", ", ". V "])
            return left + self.decoy() + right, None, 0, 0
        # And words that announce other numbers stand before cases, which may be set off in any brackets.
        if self.r.random() < 0.4:
            left += self.r.choice((f"Leta 1{self.digits(3)} ", "Leta ", f"je na strani {self.digits(2)} ", f"v zvezku {self.digits(1)} ", f"račun {self.digits(2)} ", "katalog ")) + self.plain(self.r.randint(0, 2)) + self.r.choice(["", " ("])
        opening, closing = self.r.choice([("", ""), ("", ""), ("/", "/ "), ("[", "] "), ("(", ") "), ("– ", " – ")])
        left, right = left + opening, closing + right
        kind = self.r.choice(KINDS)
        if kind == "id_number":
            lead = self.r.choice(self.LEADS[kind])
            if re.search("EMŠO|matična|Identif", lead):
                value = self.emso()
            elif re.search("Davčna|davčno|DDV", lead):
                value = self.r.choice(["", "", "SI"]) + self.digits(8)
            else:
                value = "".join(self.r.choice("ABCPXZIQ") for _ in range(2)) + self.digits(7)
        else:
            lead, value = self.r.choice(self.LEADS[kind]), getattr(self, kind)()
        # And many cases stand in prose without any announcement; a bare number of a register is then none.
        if (kind != "id_number" or len(re.sub(r"\D", "", value)) == 13) and self.r.random() < UNANNOUNCED:
            lead = self.plain(self.r.randint(1, 4)).capitalize() + self.r.choice([" ", " ", ", ", ": "]) + "{}" + self.r.choice(["", ",", ".", " " + self.plain(2)])
        a, b = lead.split("{}")
        text = left + a
        return text + value + b + right, kind, len(text), len(text) + len(value)


def labelled(n: int, seed: int) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Features, labels and kinds of the candidates in ``n`` made sentences."""
    maker = _Maker(seed)
    x, y, kinds = [], [], []
    for _ in range(n):
        text, kind, start, end = maker.sentence()
        for k, a, b in candidates(text):
            inside = kind == k and (a == start and abs(b - end) <= 1 or a == start and text[a:b] == text[start:end].split(",")[0].split("\n")[0])
            if kind is not None and not inside and a < end and b > start and k == kind:
                continue  # part of a case, neither here nor there
            x.append(features(text, k, a, b, maker.stub))
            y.append(float(inside))
            kinds.append(k)
    return np.array(x), np.array(y), kinds


@lru_cache(maxsize=1)
def model(seed: int = 11) -> tuple[BoostedTrees, dict[str, float]]:
    """Fitted trees and the threshold of each kind that gives the best F1 on other made sentences."""
    x, y, _ = labelled(TRAINING, seed)
    trees = BoostedTrees().fit(x, y)
    x, y, kinds = labelled(CALIBRATION, seed + 1)
    p = trees.predict(x)
    thresholds = {}
    for kind in KINDS:
        own = np.array([k == kind for k in kinds])
        best = (-1.0, 0.5)
        for t in np.linspace(0.2, 0.8, 25):
            hit = p[own] >= t
            f1 = 2 * (hit * y[own]).sum() / max(1.0, hit.sum() + y[own].sum())
            if f1 > best[0] + 1e-9 or abs(f1 - best[0]) <= 1e-9 and abs(t - 0.5) < abs(best[1] - 0.5):
                best = (float(f1), float(t))
        thresholds[kind] = best[1]
    return trees, thresholds


class Redactor:
    """Finds and replaces personal data in texts."""

    def __init__(self, trees: BoostedTrees, thresholds: dict[str, float], shares: Shares, public: list[str]):
        self.trees, self.thresholds, self.shares = trees, thresholds, shares
        #: Given names and surnames of persons who aren't private, by the surname's first letters.
        self.public = [tuple(n.lower().split(" ", 1)) for n in public if n and " " in n.strip()]
        self.starts = {sur[:2] for _, sur in self.public}

    def is_public(self, span: str) -> bool:
        words = [w.lower() for w in re.findall(r"[^\W\d_]+", span)]
        if not any(w[:2] in self.starts for w in words):
            return False
        for given, sur in self.public:
            stem = sur[: max(4, len(sur) - 2)]
            for w in words:
                if w.startswith(stem) or len(w) > 1 and sur.startswith(w) and any(v[:4] == given[:4] for v in words):
                    if any(v != w and (v == given[:1] or v[: max(3, len(given) - 1)] == given[: max(3, len(given) - 1)]) for v in words) or sur.startswith(w) and len(w) < len(stem):
                        return True
        return False

    def spans(self, texts: list[str | None]) -> list[list[tuple[int, int, str]]]:
        """Chosen (start, end, kind) of each text, in order; scored in one batch."""
        found = [candidates(t) if t else [] for t in texts]
        rows = [(i, k, a, b) for i, cs in enumerate(found) for k, a, b in cs if k != "name" or not self.is_public(texts[i][a:b])]
        scores = self.trees.predict(np.array([features(texts[i], k, a, b, self.shares) for i, k, a, b in rows])) if rows else []
        out: list[list[tuple[int, int, str]]] = [[] for _ in texts]
        order = sorted(range(len(rows)), key=lambda j: (rows[j][0], -round(float(scores[j]), 3), rows[j][2] - rows[j][3], rows[j][2]))
        for j in order:
            i, k, a, b = rows[j]
            if scores[j] >= self.thresholds[k] and all(b <= c or a >= d for c, d, _ in out[i]):
                out[i].append((a, b, k))
        return [sorted(o) for o in out]

    def redact(self, texts: list[str | None]) -> list[tuple[str | None, list[str]]]:
        done = []
        for text, spans in zip(texts, self.spans(texts)):
            if not spans:
                done.append((text, []))
                continue
            parts, last = [], 0
            for a, b, k in spans:
                parts += (text[last:a], PLACEHOLDERS[k])
                last = b
            done.append(("".join(parts) + text[last:], sorted({k for _, _, k in spans})))
        return done


def redacted(df: DataFrame, authors: DataFrame | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``text`` with placeholders, ``pii`` (array of the kinds found) of every row.

    Null and empty texts come out unchanged with an empty array; an empty table gives no rows; repeated
    rows are judged one by one. Names of ``authors`` (column ``name``, a configuration table) stay. The
    word lists sent to workers are bounded by SHARE of :mod:`.lexicon`; the model doesn't see the table.
    """
    words = lexicon(df, text)
    lower = lexicon(df, text, lower=True)
    public = [] if authors is None else [r[0] for r in authors.select("name").where("name is not null").distinct().orderBy("name").collect()]
    sent = df.sparkSession.sparkContext.broadcast(model())

    def make():
        red = Redactor(*sent.value, Shares(words.value, lower.value), public)

        def step(keys, texts):
            done = red.redact(texts)
            return {key: keys, "text": [d[0] for d in done], "pii": [d[1] for d in done]}

        return step

    return map_batches(df.select(key, text), f"{key} {df.schema[key].dataType.simpleString()}, text string, pii array<string>", make)


def found(df: DataFrame, authors: DataFrame | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Distinct ``key``, ``pii``: one row per kind."""
    return redacted(df, authors, key, text).select(key, F.explode("pii").alias("pii")).distinct()


__all__ = ["BoostedTrees", "Redactor", "candidates", "emso_valid", "found", "model", "redacted"]

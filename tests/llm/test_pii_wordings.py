"""Recall over planted cases, those the generators miss included, in wordings the templates don't have."""

import collections

from corpusmill.llm import pii
from corpusmill.llm.lexicon import Lexicon

#: Sentence with the case in double angle brackets, and its kind.
PLANTED = [
    ("Kdor najde denarnico, naj se oglasi na <<tine.kovacic@posta.example>> ali pri vratarju.", "email"),
    ("Vabilo smo poslali tudi na <<m-zupan_1@drustvo.org.example>>, a odgovora ni bilo.", "email"),
    ("Urednica sprejema rokopise: <<urednica (at) zalozba (dot) example>>", "email"),
    ("Kontakt tajništva <<TAJNICA@OBCINA.EXAMPLE>> velja do konca meseca.", "email"),
    ("Nujne primere sporočite dežurnemu, <<041 765 321>>, tudi ponoči.", "phone"),
    ("Dosegljiva je vsak dan, številka njenega aparata je <<(02) 431 22 10>>.", "phone"),
    ("Iz tujine vrtite <<+386 40 123 987>> in počakajte na znak.", "phone"),
    ("Mobitel: <<070-555-012>>, oglasi se sin.", "phone"),
    ("Vlogi je priložil EMŠO <<1609850503921>> in dve sliki.", "id_number"),
    ("Zavezanec z davčno številko <<48392017>> ni oddal napovedi.", "id_number"),
    ("Na meji so zapisali potni list <<PB1234567>> in ga pustili naprej.", "id_number"),
    ("Pošiljko prevzame na domu, <<Lipova ulica 12>>, v pritličju.", "address"),
    ("Preselili so se na naslov <<Cesta ob gozdu 7b, 4280 Dolga Vas>> lani spomladi.", "address"),
    ("Zglasite se pri hišniku, <<Kamniška cesta 3/2>>, med osmo in deseto.", "address"),
    ("Sestanek je vodila <<Marjeta Kovačič>>, zapisnik je v predalu.", "name"),
    ("Za popravke skrbi <<Bogdan Žnidaršič-Kralj>> iz sosednje sobe.", "name"),
    ("Knjigo je vrnil <<P. Jeromenov>>, vendar brez platnic.", "name"),
    ("Prisotni: <<ZAJEC Tilen>>, opravičeno odsoten.", "name"),
    ("Na seznamu stoji <<Hribarnik, Alojzija>> pod tretjo točko.", "name"),
]
#: Sentences without personal data.
CLEAN = [
    "Leta 1895 je zbirka izšla v 1200 izvodih.", "Signatura D 10234/2, letnik 12, str. 45–48.", "Račun 4 * 12 = 48 je pravilen.", "Šli so po Lipovi ulici do trga.", "ISBN 978-961-1234-56-7 je napačen.",
    "Vlak odpelje ob 10:45 s tira 3.", "Cena je 1.250,00 goldinarjev.", "Glej poglavje IV, verz 112.", "Inv. št. 098 103 hrani knjižnica.", "Dne 12. 5. 1901 je snežilo.",
]


def test_recall_over_planted_cases():
    common = dict.fromkeys("kdor najde denarnico naj se na ali pri smo poslali tudi je in a do konca meseca vsak dan z iz v ni bilo za knjigo vlak glej dne leta cena račun ulici trga ulica cesta".split(), 500)
    shares = pii.Shares(Lexicon(common, 1000), Lexicon(common, 1000))
    red = pii.Redactor(*pii.model(), shares, [])
    hit, missed = collections.Counter(), []
    for sentence, kind in PLANTED:
        a, b = sentence.index("<<"), sentence.index(">>") - 2
        text = sentence.replace("<<", "").replace(">>", "")
        found = [(x, y, k) for x, y, k in red.spans([text])[0] if k == kind and x < b and y > a]
        hit[kind] += bool(found)
        if not found:
            missed.append((kind, text))
    total = collections.Counter(k for _, k in PLANTED)
    wrong = [t for t, spans in zip(CLEAN, red.spans(CLEAN)) if spans]
    assert sum(hit.values()) >= 0.9 * len(PLANTED), missed
    assert all(hit[k] >= 0.6 * total[k] for k in total), missed
    assert len(wrong) <= 1, wrong

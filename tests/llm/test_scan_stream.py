from corpusmill.llm import scans
from corpusmill.llm.lexicon import Lexicon

COUNTS = {"je": 12000, "hodila": 4000, "hitro": 9000, "gledal": 5000, "mati": 6000, "naslov": 3000, "vesel": 2000, "po": 9000, "tih": 900, "brat": 3000, "kdo": 5000, "pela": 5000, "pesem": 4000, "in": 12000} | {f"q{a}{b}w": 4000 for a in "abcdefghijklmnopqrst" for b in "abcdefghijklmnopqrst"}


def test_gaps_and_misread_places_are_decoded_together():
    for times in (1, 100):
        repair = scans.reader(Lexicon({w: n * times for w, n in COUNTS.items()}, 15_000 * times))
        assert repair("mati jehodila.") == ("mati je hodila.", [])
        assert repair("mati je hodi la, brat") == ("mati je hodila, brat", [])
        assert repair("Mati hi†rogledal in") == ("Mati hitro gledal in", ["misread"])
        assert repair("mati je h0di la  pesem") == ("mati je hodila  pesem", ["misread"])


def test_rare_words_and_cells_stay():
    repair = scans.reader(Lexicon(COUNTS, 15_000))
    for text in ("mati potih gledal", "naslov|vesel in naslov|krak", "Mati Brezovar je pela", "qaawqabwqacwxi je", "mati  je\tpela ! in"):
        assert repair(text) == (text, []), text


def test_one_stream():
    """Blanks inside words, run-together words with unknown ones among them, and words divided in several places."""
    repair = scans.reader(Lexicon(COUNTS | {"beseda": 3000, "seda": 40, "velika": 3000, "hiša": 2500, "stara": 2600, "drevo": 2400, "vrnati": 900, "vmati": 0, "vratar": 900}, 15_000))
    assert repair("mati in be seda je") == ("mati in beseda je", [])
    assert repair("mati in be se da je") == ("mati in beseda je", [])
    assert repair("Velikahišastaradrevo") == ("Velika hiša stara drevo", [])
    assert repair("Velikakrumbistaradrevo je") == ("Velika krumbi stara drevo je", [])
    assert "velika hiša" in repair("mati je velika, ve-\nli-\nka hiša")[0]
    text, kinds = repair("mati je gle-\n12\ndal, hi†ro in hitr0")
    assert text == "mati je gledal, hitro in hitro" and kinds == ["furniture", "misread", "split"]
    # Only the token itself changes, not the same signs inside another one.
    assert repair("hitrornati rnati je")[0].endswith("mati je")

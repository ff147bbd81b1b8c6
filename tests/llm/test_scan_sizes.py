from corpusmill.llm import scans
from corpusmill.llm.lexicon import Lexicon


def test_recurring_misreadings_are_found_at_any_table_size():
    counts = {"hitro": 9000, "zmeraj": 7000, "tiho": 9000, "je": 12000, "hodila": 4000, "hiti": 400, "biti": 6000, "schön": 60, "schčn": 90, "bitro": 40, "zrneraj": 30, "tibo": 30}
    for times in (0.1, 1, 10, 100):
        repair = scans.reader(Lexicon({w: max(1, int(n * times)) for w, n in counts.items()}, int(15_000 * times)))
        assert repair("bitro je hodila, zrneraj tibo.") == ("hitro je hodila, zmeraj tiho.", ["misread"]), times
        assert repair("hiti je schön") == ("hiti je schön", []), times

import pytest

from corpusmill.llm.lexicon import Lexicon

#: Words the small lexicon holds, as often as the number says.
WORDS = dict.fromkeys("kdo je hitro gledal hišo ko vlak stal pri beli peči mati počasi pela pesem starega romana kmet večer gora žena založnik uredniki čakal moker romar živel ognjišče delal".split(), 500)


@pytest.fixture(scope="session")
def words():
    return Lexicon(dict(WORDS), 1000)


CORPUS = "row_id bigint, title string, url string, text string, source string, author string, lang string, n int, key string, damage string, syntaxes string, garbled string, field string"


@pytest.fixture(scope="session")
def odd_corpus(spark):
    """Rows with nulls, empty and blank texts, a very long text, repeated rows and columns whose names clash."""
    usual = "Kdo je hitro gledal hišo, ko je vlak stal pri beli peči. Mati je počasi pela pesem starega romana. "
    rows = [(1, "Naslov", "https://a.example/1", usual, "dlib"), (1, "Naslov", "https://a.example/1", usual, "dlib"), (2, None, None, None, None), (3, "", "", "", ""), (4, " ", "x", " \n\t ", "dlib"), (5, "Dolg", "u", usual * 3000, "wikivir"), (6, "Brez presledkov", "u", "a" * 60_000, "wikivir"), (None, "N", "u", usual, "dlib")]
    rows += [(10 + i, "T", f"u{i}", usual, "dlib") for i in range(6)]
    return spark.createDataFrame([(*r, None, None, 1, "k", "d", "s", "g", "f") for r in rows], CORPUS)

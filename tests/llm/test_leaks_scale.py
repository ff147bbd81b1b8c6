import random

from corpusmill.llm import leaks

SYLLABLES = "ba da ga ka la ma na pa ra ta va za mo ro lu pe te".split()


def word(r, least=2, most=4):
    return "".join(r.choice(SYLLABLES) for _ in range(r.randint(least, most)))


def work(r, n=200):
    return [word(r) for _ in range(n)]


def test_long_substitutes_and_words_in_a_row():
    """Passages count whatever the length of the words that differ, and wherever they stand."""
    r = random.Random(3)
    words = work(r)
    find, fold = leaks.finder(leaks.Works([(1, " ".join(words))])), leaks.folder()
    around = lambda: [word(r) for _ in range(40)]
    for _ in range(60):
        at = r.randint(0, 175)
        part = words[at : at + 25]
        for i in r.sample(range(25), 2):
            part[i] = word(r, 11, 11)
        assert find(fold(" ".join(around() + part + around()))) == [1]
    # 18 equal words, 4 others, 18 equal ones: 4 of 40 differ. With 5 others it is 5 of 41.
    for others, expected in ((4, [1]), (5, [])):
        part = words[50:68] + [word(r) + "x" for _ in range(others)] + words[68 + others : 86 + others]
        assert find(fold(" ".join(around() + part + around()))) == expected
    # 24 words and nothing near are no passage; blanks inside and between words don't count.
    assert find(fold(" ".join(around() + ["xqx"] + words[30:52] + ["xqx"] * 3 + around()))) == []
    apart = "".join(w[:2] + " " + w[2:] + " " for w in words[30:40]) + "".join(words[40:46]) + " " + " ".join(words[46:55])
    assert find(fold(apart)) == [1]


def test_an_id_with_several_texts(spark):
    r = random.Random(4)
    one, two = work(r, 40), work(r, 80)
    works = spark.createDataFrame([(7, "a", " ".join(one)), (7, "b", " ".join(two)), (7, "b", " ".join(two)), (8, "c", None), (9, "d", "kratko")], "item_id bigint, url string, text string")
    rows = [(1, "x", " ".join(one)), (2, "y", " ".join(two[40:])), (3, "z", None), (4, None, ""), (5, "a", " ".join(one))]
    corpus = spark.createDataFrame(rows, "row_id bigint, url string, text string")
    for chars in (leaks.GROUP_CHARS, 10):
        assert {tuple(x) for x in leaks.leaks(corpus, works, group_chars=chars).collect()} == {(7, 1), (7, 2)}


def test_words_read_from_a_stream():
    tokens = ["ma", "tije", "pe", "la", "xq", "do"]
    text = leaks.Text(tokens)
    assert leaks.as_words(text.stream, text.ends, {"mati", "je", "pela", "do", "ma"}) == ["mati", "je", "pela", None, "do"]
    assert leaks.myers(["a", "b", "c"], ["x", "a", None, "c"]) == 1

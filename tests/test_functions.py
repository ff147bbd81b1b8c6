from pyspark.sql import functions as F

from corpusmill.functions import text as T
from corpusmill.functions import unicode as U


def one(spark, value, column):
    return spark.createDataFrame([(value,)], "x string").select(column(F.col("x")).alias("y")).first()["y"]


def test_words_and_tokens(spark):
    assert one(spark, " Ena\xa0dva\ntri ", T.words) == ["Ena", "dva", "tri"]
    assert one(spark, "Straße, 2_x!", T.tokens) == ["strasse", "2_x"]
    assert one(spark, None, T.words) is None and one(spark, None, T.n_words) == 0


def test_shingles(spark):
    assert one(spark, "a b c d e f", T.shingles) == ["a b c d e", "b c d e f"]
    assert one(spark, "a b", T.shingles) == ["a b"] and one(spark, " .", T.shingles) == []
    assert len(one(spark, "a b c d e a b c d e a b", T.shingles)) == 5


def test_titles(spark):
    assert one(spark, "Križ na gori!", T.normalized_title) == "križ na gori"
    assert one(spark, "Križ na gori!", T.slug) == "kriz-na-gori"
    assert one(spark, "Kriz\u030c na gori", T.normalized_title) == "križ na gori" and one(spark, None, T.normalized_title) is None
    assert one(spark, "Voda ǆ ﬁ é Å", T.slug) == "voda-dz-fi-e-a"
    df = spark.createDataFrame([("Ada (Ivan Breznik)", "Ivan Breznik"), ("Ada (drama)", "Ivan Breznik"), ("Ada", None)], "t string, a string")
    assert [r[0] for r in df.select(T.title_without_author("t", "a")).collect()] == ["ada", "ada drama", "ada"]


def test_gate(spark):
    words = "je in se da na ne so pa bi ni"
    assert one(spark, words, T.verdict) == "kept"
    assert one(spark, " \n ", T.verdict) == "empty"
    assert one(spark, "the cold house stands here", T.verdict) == "not_slovene"
    assert one(spark, f"{words} 1900 1901 1902", T.verdict) == "bibliography"
    listed = "\n".join(f"Naslov je in {i}" for i in range(12))
    assert one(spark, listed, T.index_like) is True and one(spark, "\n".join(["Naslov"] * 9), T.index_like) is False


def test_mattr_equals_brute_force(spark):
    words = [f"w{i * i % 37}" for i in range(730)]
    wins = [len(set(words[i : i + 500])) / 500 for i in range(0, 231, 100)]
    assert abs(one(spark, " ".join(words), T.mattr) - sum(wins) / len(wins)) < 1e-12
    assert one(spark, "", T.mattr) == 0.0


def test_lines_and_sentences(spark):
    assert one(spark, "a\n\na \nb", T.repeated_lines) == 1
    text = "Ena. Dve!\nTri brez konca"
    assert "".join(one(spark, text, T.sentences)) == text and len(one(spark, text, T.sentences)) == 3
    assert "".join(one(spark, "Al' tak',  12345 a\n\nb ", T.pretokens)) == "Al' tak',  12345 a\n\nb "


def test_parameters_and_band(spark):
    p = T.parameters(F.lit(16384), F.lit(6))
    row = spark.range(1).select(*(c.alias(n) for n, c in p.items())).first()
    assert round(row["total_params"] / 1e6, 1) == 42.1 and round(row["vocab_params"] / row["total_params"], 2) == 0.75
    assert tuple(one(spark, "3, 9", T.band)) == (3, 9) and one(spark, "3", T.band) is None


def test_nfc(spark):
    assert one(spark, "č", U.nfc) == "č" and one(spark, "č", U.is_nfc) is False and one(spark, None, U.nfc) is None

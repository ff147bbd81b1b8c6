import random

from corpusmill.llm import mixing, tokens


def test_water_filling():
    give = mixing.water_fill({"a": 100, "b": 100, "c": 1000}, {"a": 0.5, "b": 0.25, "c": 0.25}, {"a": 2, "b": 1, "c": None}, 1000)
    assert give == {"a": 200, "b": 100, "c": 700}
    assert mixing.water_fill({"a": 10}, {"a": 3, "none": 1}, {"a": 1, "none": None}) == {"a": 10, "none": 0.0}
    assert mixing.water_fill({}, {}, {}) == {} and mixing.water_fill({"a": 5}, {"a": None}, {"a": None}) == {"a": 0.0}


def test_selection_reaches_its_shares(spark):
    r = random.Random(2)
    docs = [(i, r.choice(["a"] * 6 + ["b", "c", "C "]), "beseda " * r.randint(1, 40)) for i in range(900)] + [(900, None, "x"), (901, "a", None), (5, "a", "beseda ")]
    df = spark.createDataFrame(docs, "doc_id bigint, source string, text string")
    targets = spark.createDataFrame([("m", "a", 0.3, 2), ("m", "b", 0.4, 3), ("m", "c", 0.4, None)], "mix_name string, source string, target_share double, max_repeats int")
    rows = mixing.selection(df, targets).collect()
    count = tokens.counter()
    have = {}
    for _, s, t in docs:
        if s:
            have[s.strip().lower()] = have.get(s.strip().lower(), 0) + count(t)
    give = mixing.water_fill(have, {"a": 0.3, "b": 0.4, "c": 0.4}, {"a": 2, "b": 3, "c": None})
    for s in "abc":
        got = sum(x["copies"] * x["n_tokens"] for x in rows if x["source"] == s)
        assert abs(got - give[s]) <= 45, s
        copies = {x["copies"] for x in rows if x["source"] == s}
        assert max(copies) - min(copies) <= 1 and (s != "b" or max(copies) <= 3)
    again = mixing.selection(df.repartition(5), targets).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))
    assert sorted(map(str, mixing.selection(df, targets, seed=1).collect())) != sorted(map(str, rows))

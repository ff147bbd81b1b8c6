import random

from corpusmill.operators import similarity


def test_every_pair_of_a_family_is_a_candidate(spark):
    r, rows = random.Random(6), []
    for i in range(10):
        base = [f"w{r.randint(0, 5000)}" for _ in range(150)]
        rows += [(4 * i + j, " ".join([*base[:-2], f"q{j}", f"r{j}"])) for j in range(4)]
    df = spark.createDataFrame(rows, "k bigint, text string")
    links = {(x["a"], x["b"]) for x in similarity.similar_pairs(df, "k").collect()}
    found = {(x["a"], x["b"]) for x in similarity.minhash_candidates(df, "k").collect()}
    assert len(links) == 60 and len(links & found) >= 0.95 * len(links)

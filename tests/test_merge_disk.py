"""The merge keeps no shingle sets on disk, and finds near sets in slices."""

import os
import random

from corpusmill.operators import merge
from corpusmill.operators import similarity as S
from corpusmill.operators.common import Tables, _shared_folder
from corpusmill.functions import text as T
from corpusmill.sources.files import WORK
from test_merge_sequence import DOC, grams, made


def on_disk(spark):
    folder = _shared_folder(spark).removeprefix("file:")
    return sum(os.path.getsize(os.path.join(at, f)) for at, _, files in os.walk(folder) for f in files)


def test_merge_leaves_less_than_its_texts(spark):
    r = random.Random(3)
    words = [f"{a}{b}" for a in "je na se pa".split() for b in range(3000)]
    texts = [" ".join(r.choice(words) + " je" for _ in range(1200)) for _ in range(60)]
    docs = [(i, "ivan", f"Pismo {i}", t, "s", "Ivan") for i, t in enumerate(texts)] + [(100 + i, "josip", f"Pismo {i}", t + " natis", "s", "Ivan") for i, t in enumerate(texts)]
    works = spark.createDataFrame([("w1", "Domov", "Ivan", None, None, [], [], [], "")], WORK)
    before = on_disk(spark)
    done = merge.merged(spark.createDataFrame(docs, DOC), works)
    assert {(x["row_id"], x["reason"], x["root"]) for x in done.collect()} == {(i, None, None) for i in range(60)} | {(100 + i, "near_dup", i) for i in range(60)}
    assert on_disk(spark) - before < sum(len(d[3]) for d in docs)


def test_near_sets_in_slices_equal_all_pairs(spark, monkeypatch):
    texts = sorted({d[3] for d in made(random.Random(5), 90)} | {"ena", "ena dve", "ena dve tri štiri pet šest", "ena dve tri štiri pet šest sedem"})
    texts += [t.upper() for t in texts[5:9]]
    df = S.text_ids(spark.createDataFrame([(t,) for t in texts], "text string").repartition(3))
    sets = {x["id"]: grams(x["text"]) for x in df.collect()}
    for at_once, frequent in ((0, []), (10**6, S.frequent_shingles(df)), (0, [-(2**63), -5, 7])):
        monkeypatch.setattr(S, "AT_ONCE", at_once)
        tables = Tables(spark)
        sized = df.withColumn("_s", T.gram_hashes("text")).withColumns({"n": T.F.size("_s"), "head": S.head("_s", frequent, 0.8)}).where("n > 0")
        heads = tables.put("heads", sized.groupBy("_s").agg(T.F.min("id").alias("rep"), T.F.first("n").alias("n"), T.F.first("head").alias("head")).drop("_s"))
        reps = {x["rep"] for x in heads.collect()}
        expected = {(a, b) for a in reps for b in reps if a != b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) - 1e-9}
        assert expected and {tuple(x) for x in S.linked_sets(heads, df, tables).collect()} == expected

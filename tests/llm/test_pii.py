import numpy as np

from corpusmill.llm import pii
from corpusmill.llm.boosting import BoostedTrees


def test_boosting_learns_an_interaction():
    r = np.random.default_rng(1)
    x = r.random((800, 3))
    y = ((x[:, 0] > 0.5) != (x[:, 1] > 0.5)).astype(float)
    p = BoostedTrees().fit(x[:600], y[:600]).predict(x[600:])
    assert ((p > 0.5) == y[600:]).mean() > 0.95
    assert len(BoostedTrees(trees=2).fit(np.zeros((4, 2)), np.ones(4)).predict(np.zeros((0, 2)))) == 0


def test_held_out_accuracy():
    trees, thresholds = pii.model()
    x, y, kinds = pii.labelled(1500, 99)
    p = trees.predict(x)
    for kind in pii.KINDS:
        own = np.array([k == kind for k in kinds])
        hit = p[own] >= thresholds[kind]
        assert (hit * y[own]).sum() / max(1, hit.sum()) > 0.9, kind
        assert (hit * y[own]).sum() / max(1, y[own].sum()) > 0.9, kind


def test_personal_numbers():
    assert pii.emso_valid("1609850503921") and not pii.emso_valid("1609850503922") and not pii.emso_valid("3844068529808") and not pii.emso_valid("1")


def test_redaction(spark):
    text = (
        "Pišite mi: bojan-75 [afna] mail [pika] zalozba [pika] example. Tel.: 098/185-750. EMŠO 1609850503921 je na izkaznici. Stanujem na naslovu Mlinska pot 77a, 9712 Dolga Njiva, zvonec ne dela. Lep pozdrav, Jure Pezdirnovšak."
    )
    plain = "KAT-ID 92623777 in inv. št. 098 103 sta navedena v katalogu. Črtna koda 3872427040325 pripada zvezku 1. Glej letnik 1879, str. 288–345. Šel je po Lipovi ulici. Uporabnik @bralec48 je dodal 6 kg papirja @ 2 evra. Prim. Anton Vetrnjak."
    df = spark.createDataFrame([(1, text), (2, plain), (3, None), (4, "")], "doc_id bigint, text string")
    authors = spark.createDataFrame([("Anton Vetrnjak",), (None,)], "name string")
    rows = {r["doc_id"]: (r["text"], r["pii"]) for r in pii.redacted(df, authors).collect()}
    assert rows[1][1] == ["address", "email", "id_number", "name", "phone"]
    assert "[EMAIL]" in rows[1][0] and "pozdrav, [NAME]." in rows[1][0] and "Tel.: [PHONE]." in rows[1][0] and "[ADDRESS]" in rows[1][0] and "zvonec ne dela" in rows[1][0]
    assert rows[2] == (plain, []) and rows[3] == (None, []) and rows[4] == ("", [])

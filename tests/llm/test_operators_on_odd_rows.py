"""Every operator on nulls, empty and long texts, repeated rows, clashing columns and empty tables."""

import pytest
from pyspark.sql import functions as F

from corpusmill.llm import encoding, leaks, lookalikes, markup, mixing, pii, scans, splitting, tokens

WORKS = "item_id bigint, url string, text string"


def operators(spark, df):
    works = spark.createDataFrame([(1, "w", "ena dve tri " * 20), (2, None, None), (None, "x", "y")], WORKS)
    targets = spark.createDataFrame([("m", "dlib", 0.5, 2), ("m", "dlib", 0.1, None), ("m", "nič", 0.5, 1), ("n", None, 0.5, 1), ("m", "wikivir", None, 3)], "mix_name string, source string, target_share double, max_repeats int")
    return {
        "tokens": lambda: tokens.encode_documents(df, "row_id"), "budget": lambda: tokens.token_budget(df, "c"), "scans": lambda: scans.repaired(df), "markup": lambda: markup.clean_markup(df), "encoding": lambda: encoding.restored(df),
        "lookalikes": lambda: lookalikes.one_form(df), "splitting": lambda: splitting.pieces(df, "row_id"), "leaks": lambda: leaks.leaks(df, works), "mixing": lambda: mixing.shares(df, targets, key="row_id"), "pii": lambda: pii.redacted(df, key="row_id"),
    }


NAMES = ("tokens", "budget", "scans", "markup", "encoding", "lookalikes", "splitting", "leaks", "mixing", "pii")


@pytest.mark.parametrize("name", NAMES)
def test_odd_rows(spark, odd_corpus, name):
    rows = operators(spark, odd_corpus)[name]().collect()
    if name in ("tokens", "scans", "markup", "encoding", "lookalikes", "pii"):
        assert len(rows) == odd_corpus.count()
        by = {r["row_id"]: r for r in rows}
        if name == "tokens":
            assert by[2]["ids"] == [] and by[3]["ids"] == [] and by[4]["ids"] and len(by[6]["ids"]) > 100
        else:
            assert by[2]["text"] is None and by[3]["text"] == "" and by[1]["text"].startswith("Kdo je hitro")
            assert len(by[5]["text"]) >= 290_000
        assert sum(r["row_id"] == 1 for r in rows) == 2
    if name == "leaks":
        assert rows == []
    if name == "mixing":
        got = {(r["mix_name"], r["source"]): r["n_tokens"] for r in rows}
        assert got["m", "nič"] == 0 and got["m", "dlib"] > 0 and got["m", "wikivir"] == 0


@pytest.mark.parametrize("name", NAMES)
def test_empty_tables(spark, odd_corpus, name):
    rows = operators(spark, odd_corpus.limit(0))[name]().collect()
    assert all(r["n_tokens"] == 0 for r in rows) if name == "mixing" else rows == []


@pytest.mark.parametrize("name", ("scans", "markup", "encoding", "lookalikes"))
def test_row_order_does_not_matter(spark, odd_corpus, name):
    a = sorted(map(str, operators(spark, odd_corpus)[name]().collect()))
    assert a == sorted(map(str, operators(spark, odd_corpus.orderBy(F.rand(3)).repartition(5))[name]().collect()))

from corpusmill.llm import encoding


def test_a_source_garbled_as_a_whole_is_found(spark):
    usual = ["Počasi je pela žena pri beli peči.", "Moker založnik je čakal večer.", "»Živel romar,« je delal šolar, »ognjišče!«"]
    rows = [(i, ("a", "b")[i % 2], usual[i % 3]) for i in range(200)]
    for written, read in (("cp1250", "latin-1"), ("utf-8", "cp1250"), ("utf-8", "latin-1")):
        bad = [(1000 + i, "c", usual[i % 3].encode(written).decode(read, errors="replace")) for i in range(100)]
        df = spark.createDataFrame(rows + bad, "row_id bigint, source string, text string")
        got = {r["row_id"]: (r["text"], r["garbled"]) for r in encoding.restored(df).collect()}
        assert all(got[i] == (t, False) for i, _, t in rows), (written, read)
        assert all(got[i][1] for i, *_ in bad), (written, read)

import itertools
import json
import math
import random

import pytest
from pyspark.sql import functions as F

from corpusmill.functions import text as T
from corpusmill.operators import chunks, cleaning, documents, holdout, merge, similarity, works
from corpusmill.sources import files
from corpusmill.streaming import dedup

DOC = "row_id bigint, shard string, title string, url string, text string, n_chars bigint, source string, author string"
WORK = files.WORK


def grams(t):
    w = t.split()
    return {" ".join(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) > 4 else {t} if w else set()


def test_similar_pairs_equal_brute_force(spark):
    r = random.Random(3)
    base = [[f"w{r.randint(0, 400)}" for _ in range(60)] for _ in range(12)]
    texts = []
    for b in base:
        for _ in range(4):
            t = list(b)
            for _ in range(r.choice([0, 1, 1, 2, 6])):
                t[r.randrange(60)] = f"x{r.randint(0, 9)}"
            texts.append(" ".join(t))
    texts += ["", None, "a b", "a b"]
    rows = [(i, t) for i, t in enumerate(texts)]
    got = {(x["a"], x["b"]) for x in similarity.similar_pairs(spark.createDataFrame(rows, "k bigint, text string"), "k").collect()}
    first = {}
    for i, t in rows:
        if t and grams(t):
            first.setdefault(frozenset(grams(t)), i)
    expected = {(i, j) for (x, i), (y, j) in itertools.combinations(sorted(first.items(), key=lambda v: v[1]), 2) if len(x & y) >= 0.8 * len(x | y)}
    assert got == expected and expected


def test_classes_and_keep_first(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (5, 6)], "a bigint, b bigint")
    assert {(r["node"], r["label"]) for r in similarity.components(edges).collect()} == {(1, 1), (2, 1), (3, 1), (5, 5), (6, 5)}
    # A chain: the middle goes, both ends stay.
    assert {r["node"] for r in similarity.keep_first(edges).where("kept").collect()} == {1, 3, 5}
    none = spark.createDataFrame([], "a bigint, b bigint")
    assert similarity.components(none).count() == 0 and similarity.keep_first(none).count() == 0


def test_near_duplicates_give_each_row_a_class(spark):
    t = " ".join(f"w{i}" for i in range(80))
    df = spark.createDataFrame([(1, t), (2, t), (3, t.replace("w79", "z")), (4, "kaj drugega"), (5, None)], "k bigint, text string")
    rows = {r["k"]: (r["class_id"], r["n_links"]) for r in similarity.near_duplicates(df, "k").collect()}
    assert rows == {1: (1, 1), 2: (1, 1), 3: (1, 1), 4: (4, 0), 5: (5, 0)}
    kept = {r["k"] for r in similarity.near_duplicate_roots(df, "k").where("kept").collect()}
    assert kept == {1, 4, 5}


def test_minhash_finds_close_pairs(spark):
    r = random.Random(5)
    rows = []
    for i in range(30):
        b = [f"w{r.randint(0, 5000)}" for _ in range(120)]
        rows += [(2 * i, " ".join(b)), (2 * i + 1, " ".join(b[:-3] + ["q", "r", "s"]))]
    df = spark.createDataFrame(rows, "k bigint, text string")
    links = {(x["a"], x["b"]) for x in similarity.similar_pairs(df, "k").collect()}
    found = {(x["a"], x["b"]) for x in similarity.minhash_candidates(df, "k").collect()}
    assert len(links) == 30 and len(links & found) >= 0.9 * len(links)


def test_containment_bands(spark):
    volume = [f"v{i}" for i in range(400)]
    poem, part = volume[10:60], volume[100:140] + [f"n{i}" for i in range(5)]
    df = spark.createDataFrame([(1, "A", "Zbirka", " ".join(volume)), (2, "A", "Pesem", " ".join(poem)), (3, "A", "Del", " ".join(part)), (4, "B", "Pesem", " ".join(poem)), (5, "A", "Zbirka", " ".join(poem))], "k bigint, author string, title string, text string")
    got = {r["k"]: r["verdict"] for r in similarity.contained(df, "k", "author", "title", floor=300).collect()}
    assert got == {2: "drop", 3: "partial"}


def merge_docs(spark):
    sl = "je in se da na ne so pa bi ni sem po ki za bil ga še ali kakor mu tudi to tako ko si mi bilo kaj od že iz vse bila ti če "
    text = lambda tag: sl + " ".join(f"{tag}{i}" for i in range(120))
    return spark.createDataFrame(
        [
            (1, "ivan", "Domov", "u1", text("a"), 0, "wikivir", "Ivan"),
            (2, "ivan", "Domov v tujino", "u2", text("a"), 0, "wikivir", "Ivan"),
            (3, "ivan", "Tujec", "u3", "the cold house stands " * 20, 0, "wikivir", "Ivan"),
            (4, "dlib-ivan-gapfill", "Domov", "u4", text("a").replace("a7 ", "z "), 0, "dlib", "Ivan"),
            (5, "wikipedia", "Ivan", "u5", "kratko", 0, "wikipedia", None),
            (6, "ivan", "Krivo", "u6", text("c"), 0, "wikivir", "Ivan"),
            (7, "murn", "Pismo", "u7", text("d"), 0, "wikivir", "Murn"),
            (8, "dlib-ivan", "Pismo 2", "u8", text("d").replace("d5 ", "y "), 0, "dlib", "Ivan"),
            (9, "ivan", "Nič", "u9", None, 0, "wikivir", "Ivan"),
        ],
        DOC,
    )


def merge_works(spark):
    return spark.createDataFrame([("w1", "Domov", "Ivan", None, None, [], [], [], ""), ("w2", "Krivo", "Ivan", None, None, ["not_by_author"], [], [], "")], WORK)


def test_merge(spark):
    docs = merge_docs(spark)
    rows = {r["row_id"]: (r["reason"], r["root"]) for r in merge.merged(docs, merge_works(spark)).collect()}
    assert rows == {
        1: (None, None), 2: ("exact_dup", 1), 3: ("gate_not_slovene", None), 4: ("registry_identity", 1), 5: (None, None), 6: ("not_by_author", None), 7: (None, None), 8: ("near_dup", 7), 9: ("gate_empty", None),
    }
    shuffled = docs.orderBy(F.rand(1)).repartition(7)
    assert {r["row_id"]: (r["reason"], r["root"]) for r in merge.merged(shuffled, merge_works(spark)).collect()} == rows
    other = spark.createDataFrame([("Pismo 2", "same_work", "Josip Murn"), ("Tujec", "same_work", "X")], "title string, resolution string, attribution string")
    fixed = merge.reattributed(docs, merge.merged(docs, merge_works(spark)), other).collect()
    assert [tuple(r) for r in fixed] == [(7, "Murn", "Josip Murn", 1)]


def test_merge_of_nothing(spark):
    assert merge.merged(merge_docs(spark).limit(0), merge_works(spark).limit(0)).count() == 0


def test_registry(spark):
    src = "array<struct<source:string,id:string,status:string,year:int,note:string>>"
    old = spark.createDataFrame([("w1", "Ada", "Ivan", None, "proza", ["x"], ["Ada I"], [("dlib", "1", "ingested", None, "")], "")], WORK)
    new = spark.createDataFrame([("w1", "Ada", "Ivan", 1900, "drama", ["y"], ["Ada"], [("dlib", "1", "candidate", None, ""), ("wikivir", "2", "missing", None, "")], ""), ("w2", "Bor", "Ivan", None, None, [], [], [], "")], WORK)
    done = {r["work_id"]: r for r in works.upsert(old, new).collect()}
    assert (done["w1"]["year"], done["w1"]["genre"], done["w1"]["flags"], done["w1"]["aliases"]) == (1900, "proza", ["x", "y"], ["Ada I"])
    assert {(s["source"], s["status"]) for s in done["w1"]["sources"]} == {("dlib", "ingested"), ("wikivir", "missing")} and set(done) == {"w1", "w2"}
    assert works.upsert(old, new).schema["sources"].dataType.simpleString() == src


def test_catalog_and_seed(spark):
    page = "== Proza ==\n* [[Ada]], 1900\n* [[Eva]] gl. [[Ada]]\n== Viri ==\n* [[Knjiga]]\n=== Pesmi ===\n* [[Bor (prevod)]] 1876"
    pages = spark.createDataFrame([(1, page, "Ivan")], "k bigint, text string, author string")
    got = [(r["title"], r["year"], r["genre"], r["alias_of"], r["translation"]) for r in works.catalog_entries(pages, "k").orderBy("pos").collect()]
    assert got == [("Ada", 1900, "Proza", None, False), ("Eva", None, "Proza", "Ada", False), ("Knjiga", None, None, None, False), ("Bor (prevod)", 1876, "Pesmi", None, True)]
    seeded = works.seed(spark.createDataFrame([], WORK), works.catalog_entries(pages, "k"), pages.drop("text"), "k")
    rows = {r["title"]: (r["aliases"], r["flags"]) for r in seeded.collect()}
    assert rows["Ada"] == (["Eva"], []) and rows["Bor (prevod)"] == ([], ["prevod"]) and len(rows) == 3


def test_authorship(spark):
    df = spark.createDataFrame([(["Breznik, Ivan (1876)"], [], "x"), (["Breznik, Izidor"], ["Breznik, Ivan"], "x"), ([], ["Breznik, Ivan"], "Delavci; Napisal Ivan Breznik"), ([], ["Breznik, Ivan"], "Poezije; Napisal A. Aškerc"), ([], ["Breznik, Ivan"], "Spominu Ivana Breznika"), ([], ["Murn"], "x")], "c array<string>, p array<string>, t string")
    assert [r[0] for r in df.select(works.by_author(F.col("c"), F.col("p"), F.col("t"), "Breznik, Ivan")).collect()] == [True, False, True, False, False, False]


def test_chunks_rebuild_their_text(spark):
    r = random.Random(1)
    texts = ["\n\n".join(" ".join(r.choice(["hiša.", "gora", "č" * 30, "x,"]) for _ in range(r.randint(1, 60))) for _ in range(4)) for _ in range(8)] + ["", "a" * 900, "č🙂" * 200]
    size = lambda s: len(chunks.encoder().encode_ordinary(s))
    for t, budget in itertools.product(texts, (16, 32, 64)):
        parts, _ = chunks.ladder(t, size, budget)
        assert "".join(p for p, _ in parts) == t and all(n == size(p) <= budget for p, n in parts)
    df = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, None])], "k bigint, text string")
    rows = chunks.chunked(df, "k", budget=32).orderBy("k", "chunk_index").collect()
    for k, group in itertools.groupby(rows, lambda x: x["k"]):
        group = list(group)
        assert [g["char_start"] for g in group] == [0, *(g["char_end"] for g in group[:-1])] and group[-1]["char_end"] == len(texts[k])


def test_packing():
    assert chunks.crop_loss([64, 40, 40, 64], 64, 2) == (17, 212)
    assert chunks.crop_loss([], 64, 2) == (0, 0) and chunks.crop_loss([64] * 5, 64, 2) == (0, 325)


def test_windows_and_bits(spark):
    df = spark.createDataFrame([([5, 6, 7, 8, 9],), ([],)], "ids array<int>")
    got = [[(list(b["x"]), list(b["y"])) for b in r[0]] for r in df.select(holdout.windows("ids", 3, 1)).collect()]
    assert got[0] == [([1, 5, 6], [5, 6, 7]), ([7, 8, 9], [8, 9, -1])] and got[1] == []
    rows = spark.createDataFrame([(2.0, 2), (2.0, 3), (2.0, 0)], "loss double, b bigint")
    assert abs(holdout.bits_per_byte(rows, "loss", "b").first()["bpb"] - 4 / (math.log(2) * 5)) < 1e-12
    assert holdout.bits_per_byte(rows.where("b = 0"), "loss", "b").first()["bpb"] == math.inf


def test_budget_fill_equals_a_sequential_fill(spark):
    import hashlib

    rows = [(i, i % 7 + 1) for i in range(200)]
    order = sorted(rows, key=lambda r: hashlib.sha256(str(r[0]).encode()).hexdigest())
    taken, total = set(), 0
    for k, n in order:
        if total < 60 or len(taken) < 8:
            taken.add(k)
            total += n
    got = holdout.budget_fill(spark.createDataFrame(rows, "k bigint, n bigint"), "k", "k", "n", 60)
    assert {r["k"] for r in got.collect()} == taken


def test_cleaning(spark):
    wiki = "{{Infopolje|a={{b}}}}'''Ada''' je [[drama|igra]].<ref>x</ref>\n{| class=a\n| {|\n|b\n|}\n|}\n[[Slika:a.jpg|thumb|opis [[Ada|dela]]]]\n[[en:Ada]]\n== Viri ==\nkonec"
    df = spark.createDataFrame([(wiki,)], "x string")
    assert df.select(cleaning.clean_wikitext(cleaning.preclean(F.col("x")))).first()[0] == "Ada je igra."
    scan = "Štev. 3\nDoma je bila de-\nželа lepa in mirna.\n— 12 —\n^~|^~|~~\nII.\nKonec"
    c = spark.createDataFrame([(scan,)], "x string").select(cleaning.scan_clean(F.col("x")).alias("c")).first()["c"]
    assert c["text"] == "Doma je bila deželа lepa in mirna.\nII.\nKonec" and c["dropped_lines"] == 3


def test_percentile_uses_the_floor_index(spark):
    df = spark.createDataFrame([("a", i) for i in range(1, 12)] + [("b", None)], "g string, v bigint")
    assert {r["g"]: r["p"] for r in documents.exact_percentile(df, "g", "v", 0.95, "p").collect()} == {"a": 10}


def test_sources(spark, tmp_path):
    docs = [{"title": "A", "url": "u", "text": "ena dve", "n_chars": 7, "source": "wikivir", "author": None}]
    for stem in ("wikipedia", "dlib-x-gapfill", "murn"):
        (tmp_path / f"{stem}.jsonl").write_text("\n".join(json.dumps(d) for d in docs) + "\n\n")
    shards = files.read_shards(spark, str(tmp_path)).orderBy("tier").collect()
    assert [(r["shard"], r["tier"]) for r in shards] == [("murn", 0), ("dlib-x-gapfill", 2), ("wikipedia", 3)]
    with pytest.raises(FileNotFoundError):
        files.read_json_lines(spark, str(tmp_path / "none.jsonl"))
    record = files.write_shard(files.read_json_lines(spark, str(tmp_path / "murn.jsonl")), str(tmp_path / "out"), str(tmp_path / "m/manifest.json"), "murn", {"stub": 2})
    assert (record["n_docs"], record["n_words"], record["n_chars"]) == (1, 2, 7) and json.loads((tmp_path / "m/manifest.json").read_text())["skipped"] == {"stub": 2}
    xml = '<mediawiki xmlns="http://x"><page><title>A</title><ns>0</ns><revision><text bytes="3">abc</text></revision></page><page><title>B</title><ns>0</ns><redirect title="A"/><revision><text bytes="1">x</text></revision></page></mediawiki>'
    (tmp_path / "d.xml").write_text(xml)
    pages = files.read_dump(spark, str(tmp_path / "d.xml")).orderBy("title").collect()
    assert [(r["title"], r["is_redirect"], r["text"]) for r in pages] == [("A", False, "abc"), ("B", True, "x")]
    raw = spark.createDataFrame([(bytearray("čas".encode()),), (bytearray("čas".encode("cp1250")),)], "b binary")
    assert [r["text"] for r in files.decoded(raw, "b").collect()] == ["čas", "čas"]
    (tmp_path / "s.toml").write_text('[[author]]\nname = "A"\nyear = 1\n[[author]]\nname = "B"\n')
    assert [tuple(r) for r in files.read_settings(spark, str(tmp_path / "s.toml"), "author", "name string, year int").collect()] == [("A", 1), ("B", None)]
    works_ = spark.createDataFrame([("w2", "B", "x", None, None, [], [], [], ""), ("w1", "A", "x", 1, None, ["f"], [], [("dlib", "1", "missing", None, "")], "")], WORK)
    files.write_registry(works_, str(tmp_path / "reg"))
    assert {r["work_id"] for r in files.read_registry(spark, str(tmp_path / "reg")).collect()} == {"w1", "w2"}


def test_metadata_records(spark):
    cho = {"dc:title": {"#text": "Delavci"}, "dc:date": "1910 (natis)", "dc:type": ["knjige", {"#text": "drama"}], "dc:language": "sl", "dc:contributor": "Breznik, Ivan"}
    data = json.dumps({"rdf:RDF": {"edm:ProvidedCHO": cho, "edm:WebResource": [{"@rdf:about": "http://x/PDF"}, {"@rdf:about": "http://x/TEXT"}]}})
    df = spark.createDataFrame([(1, data), (2, "{}")], "k bigint, data string")
    a, b = files.parse_records(df, "k", "data").orderBy("k").collect()
    assert (a["title"], a["year"], a["types"], a["langs"], a["people"], a["creators"], a["text_url"]) == ("Delavci", 1910, ["drama", "knjige"], ["sl"], ["Breznik, Ivan"], [], "http://x/TEXT")
    assert (b["title"], b["year"], b["types"], b["text_url"]) == ("", None, [], None)


def test_stream_of_copies(spark, tmp_path):
    schema = "text string, loaded_at timestamp"
    rows = spark.createDataFrame([("a",), ("a",), ("b",)], "text string").withColumn("loaded_at", F.lit("2026-01-01 00:00:00").cast("timestamp"))
    rows.coalesce(1).write.json(str(tmp_path / "in"))
    stream = dedup.first_copies(spark.readStream.schema(schema).json(str(tmp_path / "in")), "loaded_at")
    run = stream.writeStream.format("memory").queryName("copies").option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    run.awaitTermination(120)
    assert {r["text"] for r in spark.table("copies").collect()} == {"a", "b"}


def test_extra_columns_do_not_clash(spark):
    df = spark.createDataFrame([(1, "ena dve tri", 1, 2, 3)], "row_id bigint, text string, n int, root int, shingles int")
    assert similarity.near_duplicates(df, "row_id").first()["class_id"] == 1
    assert similarity.exact_copies(df, "row_id").first()["root"] == 1
    assert T.n_words("text") is not None


def test_reports_and_shipping(spark, tmp_path, monkeypatch):
    df = spark.createDataFrame([("b", 2), ("a", None)], "shard string, n int")
    files.write_report(df, str(tmp_path / "r.md"), "Naslov", ["shard"])
    assert (tmp_path / "r.md").read_text().splitlines()[-2:] == ["| a | - |", "| b | 2 |"]
    assert files.file_sha256(str(tmp_path / "r.md")) == files.file_sha256(str(tmp_path / "r.md"))
    from corpusmill.plans import session

    monkeypatch.chdir(tmp_path)
    monkeypatch.setenv("PYTHONPATH", "")
    session.ship(spark)
    session.ship(spark)
    assert spark.range(3).mapInPandas(lambda it: (b.assign(id=__import__("corpusmill.plans.params").plans.params.SHINGLE) for b in it), "id bigint").first()["id"] == 5

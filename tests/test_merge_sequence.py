"""The merge equals reading the documents one by one in the order of preference."""

import random

from corpusmill.operators import merge
from corpusmill.plans import params as P
from corpusmill.sources.files import WORK

WORDS = "je in se da na ne so pa bi ni".split()
DOC = "row_id bigint, shard string, title string, text string, source string, author string"
FLOOR = 60


def tier(shard):
    return 3 if shard == "wikipedia" else 2 if shard.startswith("dlib-") and shard.endswith("-gapfill") else 1 if shard.startswith("dlib-") else 0


def grams(text):
    w = (text or "").lower().split()
    return frozenset(" ".join(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([" ".join(w)] if w else [])


def one_by_one(docs, works, distinct):
    """(reason, root, mismatch) of each document."""
    find = {(a, t.lower()): (w, "not_by_author" in f) for w, t, a, f in works}
    out, kept, texts, latest = {}, [], {}, {}
    for key, shard, title, text, _, author in sorted(docs, key=lambda d: (tier(d[1]), d[1], d[0])):
        literary, g, mismatch = shard != "wikipedia", grams(text), None
        work, flagged = find.get((author, title.lower()), (None, False)) if author else (None, False)
        if flagged:
            out[key] = ("not_by_author", None, None)
            continue
        if literary and not text.split():
            out[key] = ("gate_empty", None, None)
            continue
        if literary and sum(w in WORDS for w in text.split()) / len(text.split()) < P.LANGUAGE_FLOOR:
            out[key] = ("gate_not_slovene", None, None)
            continue
        if text in texts:
            out[key] = ("exact_dup", texts[text], None)
            continue
        if work and literary and work in latest:
            other = latest[work]
            if g and len(g & other[1]) >= P.IDENTITY * min(len(g), len(other[1])):
                out[key] = ("registry_identity", other[0], None)
                continue
            mismatch = other[0]
        near = next((k for k in kept if g and len(g & k[1]) >= P.SIMILARITY * len(g | k[1])), None)
        if near and not (title.lower() in distinct and near[2] != author):
            out[key] = ("near_dup", near[0], mismatch)
            continue
        out[key] = (None, None, mismatch)
        texts[text] = key
        kept.append((key, g, author, title, literary))
        if work and literary:
            latest[work] = (key, g)
    for key, g, author, title, literary in kept:
        if literary and len(g) < FLOOR:
            best = (0, 0, None)
            for place, (k, h, a, t, lit) in enumerate(kept):
                if lit and a == author and t != title and len(h) >= FLOOR and len(g & h) > 0.8 * len(g):
                    best = min(best, (-len(g & h), place, k))
            if best[2] is not None and -best[0] > 0.95 * len(g):
                out[key] = ("containment", best[2], out[key][2])
    return out


def made(r, n):
    """Documents cut and mended from a few long texts, so that every reason comes up."""
    base = [[r.choice(WORDS) if r.random() < 0.4 else f"{r.choice('abcdefgh')}{r.randint(0, 400)}" for _ in range(140)] for _ in range(9)]
    docs = []
    for key in range(n):
        words = list(r.choice(base))
        form = r.random()
        if form < 0.25:
            at = r.randint(0, 100)
            words = words[at : at + r.randint(8, 40)]
        elif form < 0.55:
            for _ in range(r.randint(1, 9)):
                words[r.randrange(len(words))] = f"x{r.randint(0, 9)}"
        elif form < 0.7:
            words = words[: r.randint(50, 130)]
        if r.random() < 0.04:
            words = [w for w in words if w not in WORDS]
        text = "" if r.random() < 0.03 else " ".join(words)
        shard = r.choice(["ivan", "josip", "dlib-ivan", "dlib-ivan-gapfill", "wikipedia"])
        author = None if shard == "wikipedia" else r.choice(["Ivan", "Josip"])
        docs.append((key, shard, r.choice(["Domov", "Pismo", "Ura", "Pot", "Krivo"]), text, "s", author))
    return docs


def test_merge_equals_reading_one_by_one(spark):
    works = [("w1", "Domov", "Ivan", []), ("w2", "Pismo", "Ivan", []), ("w3", "Domov", "Josip", []), ("w4", "Krivo", "Josip", ["not_by_author"])]
    table = spark.createDataFrame([(w, t, a, None, None, f, [], [], "") for w, t, a, f in works], WORK)
    seen = set()
    for seed, n, apart in ((1, 70, []), (2, 80, ["Ura", "Pismo"])):
        docs = made(random.Random(seed), n)
        resolutions = spark.createDataFrame([(t, "distinct", None) for t in apart] + [("Pot", "same_work", "Ivan")], "title string, resolution string, attribution string")
        got = {x["row_id"]: (x["reason"], x["root"], x["mismatch"]) for x in merge.merged(spark.createDataFrame(docs, DOC).repartition(5), table, resolutions, floor=FLOOR).collect()}
        expected = one_by_one(docs, works, {t.lower() for t in apart})
        assert got == expected
        seen |= {x[0] for x in expected.values()} | {"mismatch" for x in expected.values() if x[2] is not None}
    assert seen >= {None, "not_by_author", "gate_empty", "gate_not_slovene", "exact_dup", "registry_identity", "near_dup", "containment", "mismatch"}, seen

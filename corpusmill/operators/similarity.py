"""Exact and near duplicates, containment, and what to keep of them.

Equal texts are folded to one representative first, so copies are never paired. Links between
different texts come from a prefix filter: with the rarest shingles first, two sets of Jaccard
similarity t or more share one of their first n - ceil(t n) + 1; only those are joined, and each
candidate is verified on the whole sets. No link is lost, and frequent shingles are joined last of all.
"""

from __future__ import annotations


from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..plans import params as P
from .common import Tables, checkpointed, spread


def exact_copies(df: DataFrame, key: str, text: str = "text", order: list[Column] | None = None) -> DataFrame:
    """``df`` with ``root``: the first key in ``order`` (by default the key) of the rows with equal text.

    Rows of null text are their own roots. The window runs over (hash, order) only: the text isn't shuffled.
    """
    order = order or [F.col(key)]
    slim = df.select(F.col(key), *(o.alias(f"_o{i}") for i, o in enumerate(order)), F.coalesce(T.content_hash(text), F.concat(F.lit("null-"), F.col(key).cast("string"))).alias("_h"))
    # A min per hash aggregates map side, so one text that makes up a third of all rows is no skew.
    first = slim.groupBy("_h").agg(F.min(F.struct(*(f"_o{i}" for i in range(len(order))), key)).getField(key).alias("root"))
    return slim.select(key, "_h").join(first, "_h").select(key, "root")


def shingle_sets(df: DataFrame, key: str, text: str = "text", size: int = P.SHINGLE) -> DataFrame:
    """``key``, ``shingles`` (sorted hashes), ``n``; rows without words are left out.

    If ``df`` has an array column ``shingles``, that is taken.
    """
    return hashed(df, key, text, size).withColumn("n", F.size("shingles")).where("n > 0")


def hashed(df: DataFrame, key: str, text: str = "text", size: int = P.SHINGLE) -> DataFrame:
    """``key``, ``shingles`` of every row; an array column of that name is taken as it is."""
    if dict(df.dtypes).get("shingles") == "array<bigint>":
        return df.select(key, "shingles")
    return spread(df.select(key, text)).select(key, F.coalesce(T.shingle_hashes(text, size), F.array().cast("array<bigint>")).alias("shingles"))


def similar_pairs(df: DataFrame, key: str, text: str = "text", similarity: float = P.SIMILARITY, size: int = P.SHINGLE) -> DataFrame:
    """``a`` < ``b``, ``common``, ``n_a``, ``n_b``: all pairs of different shingle sets with Jaccard >= ``similarity``.

    Rows with equal shingle sets stand for each other: of each such group the least key is compared;
    :func:`near_duplicates` gives every row its class. Null and empty texts have no pairs.
    """
    sets = checkpointed(distinct_sets(df, key, text, size))
    exploded = sets.select(key, "n", F.explode("shingles").alias("s"))
    frequency = exploded.groupBy("s").agg(F.count("*").alias("f")).where("f > 1")
    # Shingles of one document only can't link it, but they fill its prefix: their number is subtracted.
    shared = exploded.join(frequency, "s").select(key, "n", F.struct("f", "s").alias("r"))
    ranked = shared.groupBy(key, "n").agg(F.array_sort(F.collect_list("r")).alias("rs"))
    prefix = F.col("n") - F.ceil(F.lit(similarity) * F.col("n") - 1e-9).cast("int") + 1 - (F.col("n") - F.size("rs"))
    ahead = F.col("n") - F.size("rs")
    cut = F.slice("rs", 1, F.greatest(F.lit(1), F.col("p").cast("int")))
    heads = ranked.withColumn("p", F.greatest(F.lit(0), prefix)).where("p > 0").withColumn("ahead", ahead).select(key, "n", "ahead", F.posexplode(cut).alias("i", "r"))
    heads = heads.select(F.col(key), "n", F.col("r.s").alias("s"), (F.col("n") - F.col("ahead") - F.col("i")).alias("rest"))
    left, right = heads.select(F.col(key).alias("a"), F.col("n").alias("n_a"), F.col("rest").alias("r_a"), "s"), heads.select(F.col(key).alias("b"), F.col("n").alias("n_b"), F.col("rest").alias("r_b"), "s")
    near = (F.col("a") < F.col("b")) & (F.least("n_a", "n_b") >= F.lit(similarity) * F.greatest("n_a", "n_b") - 1e-9)
    # From the first common shingle on, no more can be common than either set has left; a similar pair passes there.
    near &= F.least("r_a", "r_b") >= F.lit(similarity / (1 + similarity)) * (F.col("n_a") + F.col("n_b")) - 1e-9
    candidates = left.join(right, "s").where(near).select("a", "b").distinct()
    one, two = sets.select(F.col(key).alias("a"), F.col("shingles").alias("x"), F.col("n").alias("n_a")), sets.select(F.col(key).alias("b"), F.col("shingles").alias("y"), F.col("n").alias("n_b"))
    scored = candidates.join(one, "a").join(two, "b").select("a", "b", F.size(F.array_intersect("x", "y")).alias("common"), "n_a", "n_b")
    return scored.where(F.col("common") >= F.lit(similarity) * (F.col("n_a") + F.col("n_b") - F.col("common")) - 1e-9)


#: Texts that are looked at to find frequent shingles, the least number of them that hold one, and how many shingles are named at most.
SEEN, FREQUENT, NAMED = 5_000, 5, 2_000
#: Pairs up to which they are verified at once, the slices of either side above that, and those of the hashes when pairs are looked for.
AT_ONCE, SLICES, HASH_SLICES = 20_000, 3, 4
#: Shingles that the heads of a pair must have in common. More make heads longer by as many and leave out pairs that share a passage only.
COMMON = 8


def text_ids(df: DataFrame, text: str = "text") -> DataFrame:
    """``id``, ``text`` of every row that has one; the id follows from the text, so a later reading gives it again."""
    return df.where(F.col(text).isNotNull()).select(F.xxhash64(text).alias("id"), F.col(text).alias("text"))


def frequent_shingles(texts: DataFrame, size: int = P.SHINGLE) -> list[int]:
    """Shingles that stand in many of some ``SEEN`` texts, the most frequent first. They say in which order shingles are compared, and no more."""
    some = texts.where(F.pmod("id", F.lit(max(1, texts.count() // SEEN))) == 0).dropDuplicates(["id"])
    counts = some.select(F.explode(T.gram_hashes("text", size)).alias("s")).groupBy("s").agg(F.count("*").alias("f")).where(F.col("f") >= FREQUENT)
    return [r["s"] for r in counts.orderBy(F.desc("f"), "s").limit(NAMED).collect()]


def head(shingles: str, frequent: list[int], similarity: float) -> Column:
    """The first n - ceil(t n) + c of a set in a fixed order of all shingles: by hash, ``frequent`` ones last of all.

    Two sets of Jaccard similarity t or more have ceil(t n) in common, so of these at least c, whatever the order; c is ``COMMON``
    or the whole ceil(t n) of a smaller set.
    """
    n = f"size({shingles})"
    order = F.col(shingles)
    if frequent:
        named = f"x in ({', '.join(f'{x}L' if x > -(2**63) else f'-9223372036854775807L - 1L' for x in frequent)})"
        order = F.concat(F.expr(f"filter({shingles}, x -> not ({named}))"), F.expr(f"filter({shingles}, x -> {named})"))
    return F.slice(order, 1, F.expr(n) - needed(F.expr(n), similarity) + F.least(F.lit(COMMON), needed(F.expr(n), similarity)))


def needed(n: Column, similarity: float) -> Column:
    """How many shingles a set of ``n`` has in common with any set of that similarity, at least."""
    return F.ceil(F.lit(similarity) * n - 1e-9).cast("int")


def linked_sets(heads: DataFrame, texts: DataFrame, tables: Tables, similarity: float = P.SIMILARITY) -> DataFrame:
    """``x``, ``y``: both ways, the pairs of different sets with Jaccard >= ``similarity``, written as the table ``linked``.

    ``heads`` has ``rep``, ``n`` and ``head`` of each different set, where ``rep`` is the id of a text in ``texts``
    that has it; the table ``heads`` they are is dropped. Heads go out in slices of the hashes, and a candidate's sets are made again from the texts, so
    that no more than a part of either is on disk at a time.
    """
    slices = HASH_SLICES if heads.count() > AT_ONCE else 1
    for i in range(slices):
        places = heads.select("rep", "n", F.explode(F.filter("head", lambda s: F.pmod(s, F.lit(slices)) == i)).alias("s"))
        one, two = places.select(F.col("rep").alias("x"), F.col("n").alias("n_x"), "s"), places.select(F.col("rep").alias("y"), F.col("n").alias("n_y"), "s")
        near = (F.col("x") < F.col("y")) & (F.least("n_x", "n_y") >= F.lit(similarity) * F.greatest("n_x", "n_y") - 1e-9)
        tables.add("candidates", one.join(two, "s").where(near).groupBy("x", "y", F.least("n_x", "n_y").alias("n")).agg(F.count("*").alias("c")))
    tables.drop("heads")
    counts = tables.get("candidates").groupBy("x", "y", "n").agg(F.sum("c").alias("c"))
    tables.put("candidates", counts.where(F.col("c") >= F.least(F.lit(COMMON), needed(F.col("n"), similarity))).select("x", "y"))
    common_of(tables, "candidates", texts, "found")
    found = tables.get("found").where(F.col("common") >= F.lit(similarity) * (F.col("n_x") + F.col("n_y") - F.col("common")) - 1e-9)
    linked = tables.put("linked", found.select("x", "y").unionByName(found.select(F.col("y").alias("x"), F.col("x").alias("y"))))
    tables.drop("candidates", "found")
    return linked


def common_of(tables: Tables, pairs: str, texts: DataFrame, name: str, size: int = P.SHINGLE) -> None:
    """Adds ``x``, ``y``, ``common``, ``n_x``, ``n_y`` for each row of the table ``pairs`` to the table ``name``.

    ``x``, ``y`` are ids of texts in ``texts``. Texts are shuffled, which are half as large as their sets. Many
    pairs go in slices by both sides, each of which shuffles its part of the texts only; for few, the texts that
    aren't asked for are left out where they are read.
    """
    asked = tables.get(pairs)
    few = asked.count() <= AT_ONCE
    for i in range(1 if few else SLICES):
        for j in range(1 if few else SLICES):

            def side(c: str, part: int) -> DataFrame:
                own = texts.join(F.broadcast(asked.select(F.col(c).alias("id")).distinct()), "id", "left_semi") if few else texts.where(F.pmod("id", F.lit(SLICES)) == part)
                return own.groupBy("id").agg(F.first("text").alias(f"t_{c}")).withColumnRenamed("id", c)

            some = asked if few else asked.where((F.pmod("x", F.lit(SLICES)) == i) & (F.pmod("y", F.lit(SLICES)) == j))
            both = some.join(side("x", i), "x").join(side("y", j), "y").withColumns({"_x": T.gram_hashes("t_x", size), "_y": T.gram_hashes("t_y", size)})
            tables.add(name, both.select("x", "y", F.size(F.array_intersect("_x", "_y")).alias("common"), F.size("_x").alias("n_x"), F.size("_y").alias("n_y")))


def _digests(sets: DataFrame, key: str) -> DataFrame:
    """``key`` and the digest of its shingle set, a group of its own for rows without words."""
    digest = F.when(F.size("shingles") > 0, F.sha2(F.array_join(F.transform("shingles", lambda x: x.cast("string")), ","), 256)).otherwise(F.concat(F.lit("null-"), F.col(key).cast("string")))
    return sets.select(key, digest.alias("_h"))


def representatives(df: DataFrame, key: str, text: str = "text", size: int = P.SHINGLE) -> DataFrame:
    """``key``, ``root``: the least key with the same shingle set; rows without words are their own."""
    sets = _digests(hashed(df, key, text, size), key)
    return sets.join(sets.groupBy("_h").agg(F.min(key).alias("root")), "_h").select(key, "root")


def distinct_sets(df: DataFrame, key: str, text: str = "text", size: int = P.SHINGLE) -> DataFrame:
    """``key``, ``shingles``, ``n`` of the first row of each different shingle set; rows without words are left out.

    Sets are compared by digest, so only those of the first rows are shuffled.
    """
    sets = hashed(df, key, text, size)
    if "shingles" not in df.columns:
        sets = checkpointed(sets)
    sets = sets.where(F.size("shingles") > 0)
    first = _digests(sets, key).groupBy("_h").agg(F.min(key).alias(key)).select(key)
    return sets.join(first, key, "left_semi").dropDuplicates([key]).withColumn("n", F.size("shingles"))


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node``, ``label``: the least node of each connected component of ``edges``.

    Labels spread along edges and are followed to their own labels in each round, so the number of rounds
    grows with the logarithm of a component's extent; each round is checkpointed.
    """
    both = checkpointed(edges.select(F.col(a).alias("node"), F.col(b).alias("other")).unionByName(edges.select(F.col(b).alias("node"), F.col(a).alias("other"))).distinct())
    labels = both.groupBy("node").agg(F.least(F.min("other"), F.first("node")).alias("label"))
    while True:
        spread = both.join(labels.withColumnRenamed("node", "other"), "other").groupBy("node").agg(F.min("label").alias("near"))
        new = labels.join(spread, "node", "left").select("node", "label", F.least("label", F.coalesce("near", "label")).alias("new"))
        jump = labels.select(F.col("node").alias("new"), F.col("label").alias("far"))
        new = checkpointed(new.join(jump, "new", "left").select("node", "label", F.least("new", F.coalesce("far", "new")).alias("new")), looped=True)
        if new.where("new <> label").isEmpty():
            return new.select("node", F.col("new").alias("label"))
        labels = new.select("node", F.col("new").alias("label"))


def near_duplicates(df: DataFrame, key: str, text: str = "text", similarity: float = P.SIMILARITY, size: int = P.SHINGLE) -> DataFrame:
    """One row per row of ``df``: ``key``, ``class_id`` (least key of its class), ``n_links``.

    ``n_links`` counts the different shingle sets this row's set is linked to; a class holds everything
    reachable over links and equal sets.
    """
    df = checkpointed(hashed(df, key, text, size))
    pairs = checkpointed(similar_pairs(df, key, text, similarity, size).select("a", "b"))
    links = pairs.select(F.col("a").alias("root")).unionByName(pairs.select(F.col("b").alias("root"))).groupBy("root").agg(F.count("*").alias("n_links"))
    labels = components(pairs).withColumnRenamed("node", "root")
    rows = representatives(df, key, text, size)
    return rows.join(labels, "root", "left").join(links, "root", "left").select(key, F.coalesce("label", "root").alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"))


def keep_first(edges: DataFrame, earlier: str = "a", later: str = "b") -> DataFrame:
    """``node``, ``kept`` for every node of ``edges``: greedy keep-first in key order.

    A node is dropped if an earlier neighbour is kept and kept if all earlier ones are dropped. Each round
    decides every node whose earlier neighbours are decided or of which one is kept.
    """
    e = checkpointed(edges.select(F.col(earlier).alias("p"), F.col(later).alias("node")).distinct())
    nodes = e.select("node").unionByName(e.select(F.col("p").alias("node"))).distinct()
    state = checkpointed(nodes.join(e.select("node").distinct().withColumn("waits", F.lit(True)), "node", "left").select("node", F.when(F.col("waits").isNull(), F.lit(True)).alias("kept")))
    while not state.where("kept is null").isEmpty():
        seen = e.join(state.select(F.col("node").alias("p"), F.col("kept").alias("pk")), "p").groupBy("node").agg(F.max("pk").alias("any"), F.max(F.col("pk").isNull()).alias("open"))
        state = checkpointed(
            state.join(seen, "node", "left").select("node", F.when(F.col("kept").isNotNull(), F.col("kept")).when(F.coalesce("any", F.lit(False)), F.lit(False)).when(~F.coalesce("open", F.lit(False)), F.lit(True)).alias("kept")),
            looped=True,
        )
    return state


def near_duplicate_roots(df: DataFrame, key: str, text: str = "text", similarity: float = P.SIMILARITY, size: int = P.SHINGLE) -> DataFrame:
    """``key``, ``kept``, ``root``: keep-first over near-duplicates; a dropped row's root is its least kept earlier neighbour."""
    df = checkpointed(hashed(df, key, text, size))
    rows = representatives(df, key, text, size)
    pairs = checkpointed(similar_pairs(df, key, text, similarity, size).select("a", "b"))
    state = keep_first(pairs)
    kept = state.where("kept").select(F.col("node").alias("a"))
    roots = pairs.join(kept, "a").groupBy("b").agg(F.min("a").alias("near"))
    done = rows.join(state.withColumnRenamed("node", "root"), "root", "left").join(roots.withColumnRenamed("b", "root"), "root", "left")
    drop = F.coalesce(~F.col("kept"), F.lit(False))
    return done.select(key, (~drop & (F.col(key) == F.col("root"))).alias("kept"), F.when(drop, F.col("near")).otherwise(F.col("root")).alias("root"))


def overlaps(small: DataFrame, large: DataFrame, small_key: str, large_key: str, at_least: float, text: str = "text", on: list[str] | None = None, size: int = P.SHINGLE) -> DataFrame:
    """``small_key``, ``large_key``, ``common``, ``n_small``: pairs with containment >= ``at_least`` of the small text.

    Prefix filter on the small side alone: of its rarest-first shingles n - ceil(t n) + 1 must hold one
    that the large text has. Those that no large text has come first of all: they are only counted, and a
    text with too many of them is out. ``on`` names columns that must be equal (an author, say).
    """
    on = on or []

    def sets(df: DataFrame, k: str, name: str) -> DataFrame:
        if dict(df.dtypes).get("shingles") == "array<bigint>":
            return df.select(k, *on, F.col("shingles").alias(name))
        return spread(df.select(k, *on, text)).select(k, *on, T.shingle_hashes(text, size).alias(name))

    s = sets(small, small_key, "x").withColumn("n_small", F.size("x")).where("n_small > 0")
    big = sets(large, large_key, "y").where(F.size("y") > 0)
    s, big = checkpointed(s), checkpointed(big)
    places = big.select(large_key, *on, F.explode("y").alias("s"))
    frequency = places.groupBy(*on, "s").agg(F.count("*").alias("f"))
    found = s.select(small_key, *on, "n_small", F.explode("x").alias("s")).join(frequency, [*on, "s"])
    ranked = found.groupBy(small_key, *on, "n_small").agg(F.array_sort(F.collect_list(F.struct("f", "s"))).alias("rs"))
    prefix = F.greatest(F.lit(1), F.col("n_small") - F.ceil(F.lit(at_least) * F.col("n_small") - 1e-9).cast("int") + 1) - (F.col("n_small") - F.size("rs"))
    heads = ranked.withColumn("p", prefix).where("p > 0").select(small_key, *on, F.explode(F.slice("rs", 1, F.col("p"))).alias("r")).select(small_key, *on, F.col("r.s").alias("s"))
    candidates = heads.join(places, [*on, "s"]).select(small_key, large_key).distinct()
    scored = candidates.join(s.select(small_key, "x", "n_small"), small_key).join(big.select(large_key, "y"), large_key)
    scored = scored.select(small_key, large_key, F.size(F.array_intersect("x", "y")).cast("bigint").alias("common"), F.col("n_small").cast("bigint").alias("n_small"), F.size("y").cast("bigint").alias("n_large"))
    return scored.where(F.col("common") >= F.lit(at_least) * F.col("n_small") - 1e-9)


def contained(df: DataFrame, key: str, author: str, title: str, floor: int = P.CONTAINER_SHINGLES, partial: float = P.PARTIAL, drop: float = P.DROP, text: str = "text") -> DataFrame:
    """``key``, ``container``, ``common``, ``n_small``, ``verdict``: works contained in a volume by the same author.

    Volumes have at least ``floor`` shingles and are never dropped. A smaller work takes the volume of
    another title and more shingles with the highest share, of equals the least key; above ``drop`` it is
    ``drop``, above ``partial`` it is ``partial``.
    """
    known = dict(df.dtypes).get("shingles") == "array<bigint>"
    sized = df.select(key, author, title, "shingles") if known else checkpointed(spread(df.select(key, author, title, text)).select(key, author, title, T.shingle_hashes(text).alias("shingles")))
    named = sized.withColumns({"_n": F.size("shingles"), "_a": F.coalesce(author, F.lit("?"))})
    volumes = named.where(F.col("_n") >= floor).withColumnRenamed(key, "container")
    works = named.where((F.col("_n") < floor) & (F.col("_n") > 0))
    pairs = overlaps(works, volumes, key, "container", partial, text, ["_a"])
    titles = pairs.join(works.select(key, F.col(title).alias("_t")), key).join(volumes.select("container", F.col(title).alias("_u")), "container")
    ok = titles.where((~F.col("_t").eqNullSafe(F.col("_u"))) & (F.col("n_large") > F.col("n_small")) & (F.col("common") > F.lit(partial) * F.col("n_small")))
    # The best per work by an aggregate, which combines map side: the most common shingles, then the least key.
    best = ok.groupBy(key, "n_small").agg(F.max("common").alias("common"), F.min_by("container", F.struct(-F.col("common"), F.col("container"))).alias("container"))
    return best.select(key, "container", "common", "n_small", F.when(F.col("common") > F.lit(drop) * F.col("n_small"), "drop").otherwise("partial").alias("verdict"))


def _permuted(seed: int, i: int):
    """The i-th permutation of shingle hashes, as a function of one column."""
    return lambda s: F.xxhash64(F.lit(seed), F.lit(i), s)


def minhash_candidates(df: DataFrame, key: str, text: str = "text", permutations: int = P.PERMUTATIONS, bands: int = P.BANDS, seed: int = P.SEED) -> DataFrame:
    """``a`` < ``b``: pairs of different shingle sets that share a band of their MinHash signatures.

    Approximate; verify with :func:`similar_pairs`, of which this finds nearly all at high similarity.
    """
    rows = permutations // bands
    sets = distinct_sets(df, key, text)
    bands_ = []
    for b in range(bands):
        mins = [F.array_min(F.transform("shingles", _permuted(seed, b * rows + r))) for r in range(rows)]
        bands_.append(F.xxhash64(F.lit(b), *mins))
    buckets = checkpointed(sets.select(key, F.explode(F.array(*bands_)).alias("bucket")))
    # Equal sets are folded already; the pairs of a bucket are joined in blocks, so no task has all of them.
    blocks = 8
    left = buckets.select(F.col(key).alias("a"), "bucket", F.pmod(F.xxhash64(key), F.lit(blocks)).alias("_block"))
    right = buckets.select(F.col(key).alias("b"), "bucket", F.explode(F.array(*(F.lit(i).cast("bigint") for i in range(blocks)))).alias("_block"))
    return left.join(right, ["bucket", "_block"]).where("a < b").select("a", "b").distinct()

"""Problem 9: mixes of sources with target shares of the tokens.

Capped water-filling: sources that can't reach their share within their repeat cap are clamped at it,
the rest of the budget goes to the others in proportion, until nothing is clamped any more. The epochs
of a source then are whole copies of all its documents plus a seeded sample for the fraction.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .base import canonical_source, checkpointed
from .tokens import token_counts

#: Buckets of the seeded order; the sample's end is found among their sums, then within one bucket.
BUCKETS = 4096


def water_fill(available: dict[str, int], shares: dict[str, float], caps: dict[str, float | None], budget: float | None = None) -> dict[str, float]:
    """Tokens each source gives. ``budget`` None is what the sources of positive share hold together.

    Shares needn't add up to 1 and negative or null ones count as 0; a cap None repeats without limit;
    a source without tokens gives none.
    """
    want = {s: max(0.0, w or 0.0) for s, w in shares.items()}
    most = {s: float("inf") if caps.get(s) is None else max(0.0, caps[s]) * available.get(s, 0) for s in want}
    most = {s: m if available.get(s, 0) > 0 else 0.0 for s, m in most.items()}
    budget = float(sum(available.get(s, 0) for s in want if want[s] > 0)) if budget is None else budget
    give, open_ = {s: 0.0 for s in want}, {s for s in want if want[s] > 0}
    left = budget
    while open_:
        weight = sum(want[s] for s in sorted(open_))
        full = {s for s in open_ if left * want[s] / weight >= most[s]}
        if not full:
            give |= {s: left * want[s] / weight for s in open_}
            break
        for s in sorted(full):
            give[s] = most[s]
            left -= most[s]
        open_ -= full
    return give


def plan(sizes: DataFrame, targets: DataFrame, budget: float | None = None) -> DataFrame:
    """One row per mix and source: target share, tokens available, tokens wanted, ``epochs``.

    ``sizes`` has ``source``, ``n_docs``, ``n_tokens`` summed per source. Both inputs have a row per
    source, and are solved mix by mix.
    """
    kept = targets.select("mix_name", canonical_source().alias("source"), F.col("target_share").cast("double").alias("target_share"), F.col("max_repeats").cast("double").alias("max_repeats"))
    # Repeated rows of a mix and source: shares add up, the widest cap holds, a null cap above all.
    kept = kept.where("source is not null").groupBy("mix_name", "source").agg(
        F.sum("target_share").alias("target_share"), F.when(F.count("max_repeats") == F.count(F.lit(1)), F.max("max_repeats")).alias("max_repeats")
    )
    joined = kept.join(sizes, "source", "left").select("mix_name", "source", "target_share", "max_repeats", F.coalesce("n_docs", F.lit(0)).alias("n_docs"), F.coalesce("n_tokens", F.lit(0)).alias("n_tokens"))

    def solve(rows):
        have = dict(zip(rows.source, rows.n_tokens))
        give = water_fill(have, dict(zip(rows.source, rows.target_share)), {s: None if c != c or c is None else c for s, c in zip(rows.source, rows.max_repeats)}, budget)
        rows["wanted_tokens"] = [give[s] for s in rows.source]
        rows["epochs"] = [give[s] / have[s] if have[s] else 0.0 for s in rows.source]
        total = sum(max(0.0, w or 0.0) for w in rows.target_share) or 1.0
        rows["target_share"] = [max(0.0, w or 0.0) / total for w in rows.target_share]
        return rows

    return joined.groupBy("mix_name").applyInPandas(solve, "mix_name string, source string, target_share double, max_repeats double, n_docs bigint, n_tokens bigint, wanted_tokens double, epochs double")


def selection(docs: DataFrame, targets: DataFrame, seed: int = 0, budget: float | None = None, key: str = "doc_id", path: str | None = None) -> DataFrame:
    """``mix_name``, ``source``, ``key``, ``n_tokens``, ``copies`` (at least 1) of the chosen documents.

    Every document of a source gets the whole epochs; the fraction goes to the first documents in the
    order of a seeded hash whose tokens fit it. A document is chosen by its key and seed alone, ties of
    the hash by the key. Documents without tokens are not chosen, those without a source neither;
    repeated rows are documents of their own. The order is cut by sums over ``BUCKETS`` hash ranges,
    so a source of any size is never sorted in one task.
    """
    sized = token_counts(docs.select(key, "text", canonical_source().alias("source")), "text", path, key, "source")
    sized = sized.where("source is not null and n_tokens > 0").withColumn("_h", F.xxhash64(F.lit(seed), F.col(key)))
    sized = sized.withColumn("_b", F.pmod(F.shiftrightunsigned("_h", 8), F.lit(BUCKETS)).cast("int"))
    # Written once: encoding is dear, and the sums and the selection must see the same rows.
    sized = checkpointed(sized)
    buckets = sized.groupBy("source", "_b").agg(F.sum("n_tokens").alias("_t"), F.count("*").alias("_n"))
    sizes = buckets.groupBy("source").agg(F.sum("_n").alias("n_docs"), F.sum("_t").alias("n_tokens"))
    wanted = plan(sizes, targets, budget).withColumn("_whole", F.floor(F.col("epochs") + 1e-12).cast("int"))
    wanted = wanted.withColumn("_rest", F.greatest(F.lit(0.0), F.col("wanted_tokens") - F.col("_whole") * F.col("n_tokens")))
    before = F.coalesce(F.sum("_t").over(Window.partitionBy("source").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ends = buckets.withColumn("_before", before)
    # Of each mix and source: the bucket in which the fraction ends.
    cut = wanted.select("mix_name", "source", "_whole", "_rest").join(ends, "source").where("_before <= _rest and _rest < _before + _t or _b = 0 and _rest <= 0")
    cut = cut.groupBy("mix_name", "source").agg(F.max("_whole").alias("_whole"), F.max("_rest").alias("_rest"), F.min("_b").alias("_end"), F.min_by("_before", "_b").alias("_before"))
    rows = sized.join(cut, "source")  # a row per mix and source: small enough for AQE to broadcast, or it is shuffled
    at_end = rows.where("_b = _end").withColumn("_sum", F.sum("n_tokens").over(Window.partitionBy("mix_name", "source").orderBy("_h", key)))
    # The document that crosses the line is taken if that comes nearer to it than leaving it.
    at_end = at_end.withColumn("copies", F.col("_whole") + (F.col("_before") + F.col("_sum") - F.col("n_tokens") / 2 <= F.col("_rest")).cast("int"))
    others = rows.where("_b <> _end").withColumn("copies", F.col("_whole") + (F.col("_b") < F.col("_end")).cast("int"))
    columns = ("mix_name", "source", key, "n_tokens", "copies")
    return others.select(*columns).unionByName(at_end.select(*columns)).where("copies > 0")


def shares(docs: DataFrame, targets: DataFrame, seed: int = 0, budget: float | None = None, key: str = "doc_id", path: str | None = None) -> DataFrame:
    """Of each mix and source: target and reached share, epochs, documents, tokens.

    Every source of a mix has a row, those that give nothing too.
    """
    chosen = selection(docs, targets, seed, budget, key, path)
    sums = chosen.groupBy("mix_name", "source").agg(F.count("*").alias("n_docs"), F.sum("copies").alias("n_copies"), F.sum(F.col("copies") * F.col("n_tokens")).alias("n_tokens"), F.max("copies").alias("most_copies"))
    named = targets.select("mix_name", canonical_source().alias("source"), F.greatest(F.lit(0.0), F.coalesce(F.col("target_share").cast("double"), F.lit(0.0))).alias("w")).where("source is not null").groupBy("mix_name", "source").agg(F.sum("w").alias("w"))
    every = Window.partitionBy("mix_name")
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    all_ = named.join(sums, ["mix_name", "source"], "left").select("mix_name", "source", "w", *(zero(c) for c in ("n_docs", "n_copies", "n_tokens", "most_copies")))
    return all_.select(
        "mix_name", "source", (F.col("w") / F.nullif(F.sum("w").over(every), F.lit(0.0))).alias("target_share"), (F.col("n_tokens") / F.nullif(F.sum("n_tokens").over(every), F.lit(0))).alias("reached_share"), "n_docs", "n_copies", "n_tokens", "most_copies"
    )

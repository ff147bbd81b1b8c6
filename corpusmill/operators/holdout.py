"""Held-out sets: candidates, closures, budget fill, exclusions, evaluation windows and bits per byte."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..plans import params as P
from . import similarity as S
from .common import checkpointed
from .merge import misattributed
from .works import find_works


def candidates(docs: DataFrame, source: str = "wikivir", chars: tuple[int, int] = P.HOLDOUT_CHARS, text: str = "text") -> DataFrame:
    """Documents of ``source``, however spelled, with a length in the band, both ends included."""
    return docs.where((T.source_name("source") == source) & F.length(text).between(*chars))


def forward_closure(docs: DataFrame, among: DataFrame, key: str, text: str = "text", at_least: float = P.HOLDOUT_REJECT) -> DataFrame:
    """``key``, ``other``, ``common``, ``n_small``: of each candidate its best container among the other texts.

    Candidates without a container of ``at_least`` have no row; the text itself and equal keys aren't others.
    """
    pairs = S.overlaps(docs, among.withColumnRenamed(key, "other"), key, "other", at_least, text).where(F.col(key) != F.col("other"))
    return pairs.groupBy(key, "n_small").agg(F.max("common").alias("common"), F.min_by("other", F.struct(-F.col("common"), F.col("other"))).alias("other"))


def reverse_closure(docs: DataFrame, held: DataFrame, key: str, held_key: str, at_least: float = P.HOLDOUT_REJECT, text: str = "text") -> DataFrame:
    """``key``, ``held_key``, ``common``, ``n_small``: documents contained in held-out texts by ``at_least``."""
    return S.overlaps(docs, held, key, held_key, at_least, text).select(key, held_key, "common", "n_small")


def budget_fill(docs: DataFrame, key: str, order: str, size: str, budget: float, least: int = P.HOLDOUT_WORKS, buckets: int = 1024) -> DataFrame:
    """Documents in the order of ``sha256(order)`` until ``budget`` is reached and ``least`` are taken.

    A document is taken if the sum before it is under the budget or fewer than ``least`` were taken. Ties
    of the hash go by ``key``. The running sum goes over sums of hash ranges first, so no task sorts all.
    """
    h = F.sha2(F.col(order).cast("string"), 256)
    rows = docs.select(F.col(key), F.coalesce(F.col(size), F.lit(0)).cast("bigint").alias("size"), h.alias("sha")).withColumn("_b", (F.conv(F.substring("sha", 1, 4), 16, 10).cast("int") * buckets / 65536).cast("int"))
    rows = checkpointed(rows)
    w = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy("_b").agg(F.sum("size").alias("t"), F.count("*").alias("c")).select("_b", F.coalesce(F.sum("t").over(w), F.lit(0)).alias("t0"), F.coalesce(F.sum("c").over(w), F.lit(0)).alias("c0"))
    inside = Window.partitionBy("_b").orderBy("sha", key).rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.join(sums, "_b").withColumn("before", F.col("t0") + F.coalesce(F.sum("size").over(inside), F.lit(0))).withColumn("taken", F.col("c0") + F.count("size").over(inside))
    return placed.where((F.col("before") < budget) | (F.col("taken") < least)).select(key, "size", "sha", F.col("before").cast("bigint").alias("before"))


def excluded_urls(works: DataFrame, manifest: DataFrame) -> DataFrame:
    """Distinct urls that training leaves out: those of held-out works and the listed ones."""
    return works.select("url").unionByName(manifest.select(F.explode("also_exclude_urls").alias("url"))).where("url is not null").distinct()


def training_rows(docs: DataFrame, works: DataFrame, manifest: DataFrame) -> DataFrame:
    """Documents that training uses; rows without a url stay."""
    return docs.join(excluded_urls(works, manifest), "url", "left_anti")


def verified(docs: DataFrame, works: DataFrame) -> DataFrame:
    """Per held-out work: rows at its url, how many still have the frozen text (J10); both 0 for a missing url."""
    rows = docs.select("url", T.content_hash("text").alias("h"))
    joined = works.select("item_id", "url", "content_sha256").join(rows, "url", "left")
    return joined.groupBy("item_id").agg(F.count("h").alias("n_rows"), F.count_if(F.col("h") == F.col("content_sha256")).alias("n_same"))


def require_verified(docs: DataFrame, works: DataFrame) -> None:
    """Fail if a held-out work has no row at its url any more, or none of them has the frozen text."""
    bad = verified(docs, works).where("n_same = 0")
    if not bad.isEmpty():
        raise ValueError(f"{bad.count()} held-out works are missing or changed, first {[r['item_id'] for r in bad.orderBy('item_id').limit(5).collect()]}")


def author_slice(docs: DataFrame, works: DataFrame, author: str, key: str, strict: bool = True) -> DataFrame:
    """Documents of ``author`` without those of works that aren't by them; with ``strict`` any of these is an error (F8)."""
    mine = docs.where(F.col("author") == author)
    bad = find_works(mine, works, key).join(misattributed(works), "work_id", "left_semi").select(key)
    if strict and not bad.isEmpty():
        raise ValueError(f"works that aren't by {author} stand in the slice")
    return mine.join(bad, key, "left_anti")


def totals(works: DataFrame, slice_: DataFrame, size: str) -> DataFrame:
    """One row: works held out, their size, documents of the slice, its size, the share held out in millionths."""
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    held = works.agg(F.count("*").alias("n_works"), total(size).alias("held"))
    # Two single rows.
    both = held.withColumn("_k", F.lit(0)).join(slice_.agg(F.count("*").alias("n_slice"), total(size).alias("slice")).withColumn("_k", F.lit(0)), "_k").drop("_k")
    return both.withColumn("millionths", F.floor(F.col("held") / F.nullif("slice", F.lit(0)) * 1e6).cast("bigint"))


def windows(ids: str | Column, length: int, start: int, ignore: int = -1) -> Column:
    """Array of structs ``x``, ``y`` of ``length`` ids each: non-overlapping windows behind a start id.

    The last window is padded, ``x`` with 0 and ``y`` with ``ignore``.
    """

    def tile(seq):
        last = F.size(seq) - 2
        part = lambda i, shift: F.slice(seq, i + 1 + shift, length)
        cut = lambda i, shift, pad: F.concat(part(i, shift), F.array_repeat(F.lit(pad), F.greatest(F.lit(0), length - F.size(part(i, shift)))))
        return F.when(last < 0, F.array().cast("array<struct<x:array<int>,y:array<int>>>")).otherwise(F.transform(F.sequence(F.lit(0), last, F.lit(length)), lambda i: F.struct(cut(i, 0, 0).alias("x"), cut(i, 1, ignore).alias("y"))))

    return T.let(F.concat(F.array(F.lit(start)), F.col(ids) if isinstance(ids, str) else ids), tile)


def bits_per_byte(rows: DataFrame, loss: str, n_bytes: str) -> DataFrame:
    """One row: ``nats``, ``bytes``, ``bpb`` over the targets that have bytes; infinite without any."""
    counted = F.when(F.col(n_bytes) > 0, F.col(loss)).otherwise(0.0)
    sums = rows.agg(F.coalesce(F.sum(counted), F.lit(0.0)).alias("nats"), F.coalesce(F.sum(F.when(F.col(n_bytes) > 0, F.col(n_bytes))), F.lit(0)).alias("bytes"))
    return sums.withColumn("bpb", F.when(F.col("bytes") == 0, F.lit(float("inf"))).otherwise(F.col("nats") / (F.lit(math.log(2)) * F.col("bytes"))))

"""Measures, gates and statistics of documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..plans import params as P
from .common import checkpointed, spread


def exact_percentile(df: DataFrame, by: str, value: str, q: float, name: str) -> DataFrame:
    """``by``, ``name``: the value at index floor(q (n - 1)) of the sorted group, as the reports define percentiles (A3).

    Values are counted first, so what is gathered of a group is its distinct values only.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(by, value).agg(F.count("*").alias("_c"))
    # One row per group; the cumulated counts are walked in an array of (value, count), bounded by distinct values.
    lists = counts.groupBy(by).agg(F.array_sort(F.collect_list(F.struct(F.col(value).alias("v"), F.col("_c").alias("c")))).alias("_l"), F.sum("_c").alias("_n"))
    rank = F.floor(F.lit(float(q)) * (F.col("_n") - 1))
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit(None).cast(df.schema[value].dataType).alias("v"))
    walked = F.aggregate("_l", start, lambda a, x: F.struct((a["at"] + x["c"]).alias("at"), F.when(a["v"].isNull() & (a["at"] + x["c"] > rank), x["v"]).otherwise(a["v"]).alias("v")))
    return lists.select(by, walked["v"].alias(name))


def measured(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with ``n_words``, ``n_text_chars``, ``n_bytes``, ``hash`` of its text; null text counts as empty."""
    body = F.coalesce(F.col(text), F.lit(""))
    return df.withColumns({"n_words": T.n_words(body), "n_text_chars": F.length(body).cast("bigint"), "n_bytes": F.octet_length(body).cast("bigint"), "hash": T.content_hash(body)})


def shard_metrics(df: DataFrame, by: str = "shard", text: str = "text") -> DataFrame:
    """Documents, words, characters, word-count distribution, repeated documents and characters unknown (A1)."""
    m = measured(spread(df.select(by, text)), text).withColumn("unknown", T.unknown_chars(F.coalesce(F.col(text), F.lit("")))).select(by, "n_words", "n_text_chars", "hash", "unknown")
    # Read three times; slim rows, written once.
    m = checkpointed(m)
    base = m.groupBy(by).agg(
        F.count("*").alias("n_docs"), F.sum("n_words").alias("n_words"), F.sum("n_text_chars").alias("n_chars"), F.min("n_words").alias("words_min"), F.max("n_words").alias("words_max"),
        F.sum("unknown").alias("unknown_chars"), (F.count("*") - F.count_distinct("hash")).alias("n_repeated"),
    )
    ranks = exact_percentile(m, by, "n_words", 0.95, "words_p95").join(exact_percentile(m, by, "n_words", 0.5, "words_p50"), by)
    return base.join(ranks, by)


def lexical_metrics(df: DataFrame, by: str, text: str = "text") -> DataFrame:
    """Word-weighted type-token ratio and share of repeated lines per group (A2), in millionths."""
    # Arrays that are used several times are columns of their own: each is computed once.
    arrays = spread(df.select(by, text)).select(by, F.transform(T.words(F.coalesce(F.col(text), F.lit(""))), T.folded).alias("ws"), T.lines(F.coalesce(F.col(text), F.lit(""))).alias("ls"))
    counted = arrays.select(by, F.size("ws").alias("w"), T.type_counts_of(F.col("ws")).alias("c"), F.size("ls").alias("lines"), F.size(F.array_distinct("ls")).alias("d"))
    total = F.aggregate("c", F.lit(0).cast("bigint"), lambda a, x: a + x)
    mattr = F.when(F.size("c") == 0, 0.0).otherwise(total / (F.size("c") * F.least(F.lit(P.MATTR_WINDOW), "w")))
    m = counted.select(by, "w", mattr.alias("mattr"), F.when(F.col("lines") < 2, 0.0).otherwise((F.col("lines") - F.col("d")) / F.col("lines")).alias("share"))
    weighted = lambda x: F.floor(F.sum(F.col(x) * F.col("w")) / F.nullif(F.sum("w"), F.lit(0)) * 1e6 + 0.5).cast("bigint")
    return m.groupBy(by).agg(F.count("*").alias("n_docs"), F.sum("w").alias("n_words"), weighted("mattr").alias("mattr_millionths"), weighted("share").alias("repeated_line_millionths"))


def markup_rates(df: DataFrame, by: str, text: str = "text") -> DataFrame:
    """Documents per group that some markup probe hits."""
    return df.groupBy(by).agg(F.count("*").alias("n_docs"), *(F.count_if(F.col(text).rlike(p)).alias(f"n_{name}") for name, p in T.PROBES.items()))


def gate(df: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``key``, the three signals as counts, and the verdict."""
    return judged(spread(df.select(key, text)), text).select(key, "n_words", "n_function_words", "n_years", "index_like", "verdict")


def judged(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with ``n_words``, ``n_function_words``, ``n_years``, ``index_like``, ``verdict`` (P9); null text is empty.

    Words and lines are columns of their own, so they are found once for all signals.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    arrays = df.withColumns({"_ws": T.words(body), "_ls": T.lines(body)})
    signals = arrays.withColumns({"n_words": F.size("_ws"), "n_function_words": T.function_words_of(F.col("_ws")), "n_years": T.year_count(body), "index_like": F.coalesce(T.index_like_lines(F.col("_ls")), F.lit(False))}).drop("_ws", "_ls")
    share = lambda c: F.col(c) / F.nullif("n_words", F.lit(0))
    return signals.withColumn("verdict", F.when(F.col("n_words") == 0, "empty").when(share("n_function_words") < P.LANGUAGE_FLOOR, "not_slovene").when(share("n_years") > P.YEAR_CEILING, "bibliography").when(F.col("index_like"), "index_list").otherwise("kept"))


def reason_counts(df: DataFrame, reason: str, values: list[str] | None = None) -> DataFrame:
    """Rows per reason (A8); with ``values``, reasons without rows count 0."""
    counts = df.groupBy(reason).agg(F.count("*").alias("n"))
    if values is None:
        return counts
    every = df.sparkSession.createDataFrame([(v,) for v in values], f"{reason} string")
    return every.join(counts, reason, "left").select(reason, F.coalesce("n", F.lit(0)).alias("n"))


def group_statistics(df: DataFrame, text: str = "text") -> DataFrame:
    """Documents, words and bytes by source and author, with totals per source and overall (A5)."""
    m = measured(spread(df.select("source", "author", text)), text).select("source", F.coalesce("author", F.lit("-")).alias("author"), "n_words", "n_bytes")
    total = m.rollup("source", "author").agg(F.grouping_id().alias("level"), F.count("*").alias("n_docs"), F.sum("n_words").alias("n_words"), F.sum("n_bytes").alias("n_bytes"))
    return total.select("source", "author", F.col("level").cast("int").alias("level"), "n_docs", "n_words", "n_bytes")


def slice_statistics(df: DataFrame, main_author: str, text: str = "text") -> DataFrame:
    """Per slice: documents, words, bytes, pre-tokens and those of digits, soft hyphens and tabs."""
    body = F.coalesce(F.col(text), F.lit(""))
    units = F.regexp_extract_all(body, F.lit(rf"\p{{L}}+|\p{{N}}{{1,2}}|[^{T.SPACE}\p{{L}}\p{{N}}]+"), F.lit(0))
    m = spread(df.select("source", "author", text)).select(T.slice_of("source", "author", main_author).alias("slice"), T.n_words(body).alias("w"), F.octet_length(body).alias("b"), units.alias("u"), F.contains(body, F.lit("\xad")).alias("soft"), F.contains(body, F.lit("\t")).alias("tab"))
    digits = F.size(F.filter("u", lambda x: x.rlike("^[0-9]+$")))
    return m.groupBy("slice").agg(F.count("*").alias("n_docs"), F.sum("w").alias("n_words"), F.sum("b").alias("n_bytes"), F.sum(F.size("u")).alias("n_units"), F.sum(digits).alias("n_digit_units"), F.count_if("soft").alias("n_soft_hyphen"), F.count_if("tab").alias("n_tab"))


def steps_per_epoch(totals: DataFrame, tokens: str, length: int = P.TOKEN_BUDGET, batches: tuple[int, ...] = P.BATCHES) -> DataFrame:
    """``totals`` with the whole steps an epoch takes per batch size."""
    return totals.withColumns({f"steps_{b}": F.floor(F.col(tokens) / (b * length)).cast("bigint") for b in batches})


def contract_violations(df: DataFrame, key: str, text: str = "text", length: str = "n_chars", url: str = "url") -> DataFrame:
    """``problem``, ``n``: rows whose length is stale or missing, empty texts, and repeated urls, each as a count."""
    body = F.coalesce(F.col(text), F.lit(""))
    rows = df.agg(
        F.count_if(F.col(length).isNull()).alias("length_missing"), F.count_if(F.col(length) != F.length(body)).alias("length_stale"), F.count_if(body == "").alias("text_empty"), (F.count(url) - F.count_distinct(url)).alias("url_repeated")
    )
    return rows.select(F.explode(F.map_from_arrays(F.array(*(F.lit(c) for c in rows.columns)), F.array(*(F.col(c).cast("bigint") for c in rows.columns)))).alias("problem", "n"))

"""Evaluation of given tokenizers; none is trained here."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from .chunks import encoder
from .documents import exact_percentile


def encoded_counts(df: DataFrame, paths: dict[str, str], text: str = "text", *keep: str) -> DataFrame:
    """``keep``, ``candidate``, ``n_tokens``, ``n_digit_tokens``, ``n_words``, ``n_bytes``: a row per document and candidate (K2, K7).

    Every document is read once for all candidates. Null texts count as empty.
    """
    kinds = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoders = {name: encoder(path) for name, path in paths.items()}
        digits = {name: frozenset(i for i in range(e.n_vocab) if _digits(e, i)) for name, e in encoders.items()}
        for batch in batches:
            rows = []
            for *kept, t, w, b in batch.itertuples(index=False):
                for name, e in encoders.items():
                    ids = e.encode_ordinary(t or "")
                    rows.append((*kept, name, len(ids), sum(i in digits[name] for i in ids), w, b))
            yield pd.DataFrame(rows, columns=[*keep, "candidate", "n_tokens", "n_digit_tokens", "n_words", "n_bytes"])

    body = F.coalesce(F.col(text), F.lit(""))
    rows = df.select(*keep, body.alias("t"), T.n_words(body).cast("bigint").alias("w"), F.octet_length(body).cast("bigint").alias("b"))
    return rows.mapInPandas(run, f"{kinds}{', ' if kinds else ''}candidate string, n_tokens bigint, n_digit_tokens bigint, n_words bigint, n_bytes bigint")


def _digits(e, i: int) -> bool:
    try:
        b = e.decode_single_token_bytes(i)
    except KeyError:
        return False
    return b.isdigit()


def fertility(counts: DataFrame, slice_: str = "slice") -> DataFrame:
    """Per candidate and slice: totals and the 95th percentile of tokens a word in thousandths."""
    rows = counts.withColumn("g", F.concat_ws("|", "candidate", slice_)).withColumn("f", F.floor(F.col("n_tokens") * 1000 / F.nullif("n_words", F.lit(0))).cast("bigint"))
    sums = rows.groupBy("g", "candidate", slice_).agg(F.count("*").alias("n_docs"), *(F.sum(c).alias(c) for c in ("n_words", "n_bytes", "n_tokens", "n_digit_tokens")))
    return sums.join(exact_percentile(rows, "g", "f", 0.95, "p95_fertility_thousandths"), "g", "left").drop("g")


def ratio(stats: DataFrame, one: str, other: str, slice_: str = "slice") -> DataFrame:
    """Per candidate: tokens a word of slice ``one`` over those of ``other`` (A7); null where one is missing."""
    rate = lambda s: F.sum(F.when(F.col(slice_) == s, F.col("n_tokens"))) / F.sum(F.when(F.col(slice_) == s, F.col("n_words")))
    return stats.groupBy("candidate").agg((rate(one) / rate(other)).alias("ratio"))


def segments(text: str, path: str) -> str:
    """Tokens of ``text`` with bars between them, for reports."""
    e = encoder(path)
    return "|".join(e.decode_single_token_bytes(i).decode("utf-8", errors="replace") for i in e.encode_ordinary(text))

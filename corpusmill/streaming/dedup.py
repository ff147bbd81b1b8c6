"""Duplicates in a stream of documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T


def first_copies(stream: DataFrame, time: str, delay: str = "1 hour", text: str = "text") -> DataFrame:
    """The first row of each text within ``delay``; works on batch input too, over all of it.

    State is kept per text hash until the watermark passes, so it is bounded by what arrives within ``delay``.
    """
    hashed = stream.withColumn("content_hash", T.content_hash(F.coalesce(F.col(text), F.lit(""))))
    if not stream.isStreaming:
        return hashed.dropDuplicates(["content_hash"])
    return hashed.withWatermark(time, delay).dropDuplicatesWithinWatermark(["content_hash"])

"""Problems 1 and 8: encoding with a public byte-level BPE, and token budgets per slice.

A worker loads the rank file once. Long texts are cut before a blank that follows a non-blank: no
pre-token of the pattern reaches across that place, so encoding the cuts one by one gives the ids of
the whole text, and a long text never becomes one huge regex input.
"""

from __future__ import annotations

import base64
import os
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import canonical_author, canonical_lang, canonical_source, checkpointed, host, map_batches

#: Directory of the public vocabulary files and the file used unless told otherwise.
TOKENIZERS = os.environ.get("PUBLIC_TOKENIZERS", "/opt/tokenizers")
BYTE_BPE = "byte_bpe_50k.tiktoken"
#: Pre-token pattern that belongs to the byte-level vocabulary (fixed value).
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Texts beyond this many code points are encoded in pieces.
LONG = 50_000
_CUT = re.compile(r"(?<=\S)(?= )")
_loaded: dict[str, object] = {}


def encoding(path: str | None = None):
    """The tiktoken encoding of a rank file; loaded once per process."""
    import tiktoken

    path = path or f"{TOKENIZERS}/{BYTE_BPE}"
    if path not in _loaded:
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        _loaded[path] = tiktoken.Encoding(os.path.basename(path), pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _loaded[path]


def cuts(text: str, longest: int = LONG) -> list[str]:
    """Pieces of about ``longest`` code points whose encodings, in order, are the encoding of ``text``."""
    pieces, start = [], 0
    while len(text) - start > longest and (cut := _CUT.search(text, start + longest)):
        pieces.append(text[start : cut.start()])
        start = cut.start()
    return [*pieces, text[start:]]


def encoder(path: str | None = None):
    """Function from a text to its list of ids; null and empty texts have the empty list."""
    encode = encoding(path).encode_ordinary

    def ids(text: str | None) -> list[int]:
        if not text:
            return []
        return encode(text) if len(text) <= LONG else [i for piece in cuts(text) for i in encode(piece)]

    return ids


def batch_counter(path: str | None = None):
    """Function from a list of texts to their numbers of tokens; the short ones go to the encoder in one call."""
    many, one = encoding(path).encode_ordinary_batch, counter(path)

    def count(texts: list[str | None]) -> list[int]:
        short = [i for i, t in enumerate(texts) if t and len(t) <= LONG]
        sizes = dict(zip(short, map(len, many([texts[i] for i in short], num_threads=1))))
        return [sizes[i] if i in sizes else one(t) for i, t in enumerate(texts)]

    return count


def counter(path: str | None = None):
    """Function from a text to its number of tokens; null and empty texts have none."""
    encode = encoder(path)
    return lambda text: len(encode(text))


def decode(ids: list[int], path: str | None = None) -> str:
    """Text of ids. Bytes are joined before decoding, as a character may be spread over tokens."""
    return encoding(path).decode_bytes(ids).decode("utf-8", errors="replace")


def encode_documents(df: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """``key`` and ``ids`` (array<int>) of every row of ``df``; no shuffle.

    Null and empty texts get an empty array, blank texts the ids of their blanks; repeated rows and
    null keys are kept as they are.
    """

    def make():
        encode = encoder(path)
        return lambda keys, texts: {key: keys, "ids": [encode(t) for t in texts]}

    kind = df.schema[key].dataType.simpleString()
    return map_batches(df.select(key, text), f"{key} {kind}, ids array<int>", make)


def token_counts(df: DataFrame, text: str = "text", path: str | None = None, *keep: str) -> DataFrame:
    """``keep`` columns and ``n_tokens`` of every row; the text itself is dropped."""

    def make():
        count = batch_counter(path)
        return lambda *columns: {**dict(zip(keep, columns)), "n_tokens": count(columns[-1])}

    schema = ", ".join([*(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep), "n_tokens bigint"])
    return map_batches(df.select(*keep, text), schema, make)


def token_budget(df: DataFrame, name: str, authors: DataFrame | None = None, path: str | None = None) -> DataFrame:
    """Exact token totals of the cube over source, language and host, and by author.

    Columns: ``corpus``; ``source``, ``lang``, ``host``, ``author`` (null where a value is missing or
    rolled up); ``slice`` naming the grouped columns joined by ``+`` (``all`` for the grand total);
    ``n_docs``, ``n_tokens``. Spellings of source and language are unified first. Null and empty texts
    count as documents without tokens. An empty table has no rows.

    The exact count of every document is stored once, without its text. Counts are then summed per distinct
    combination, map side; only those sums are cubed.
    """
    dims = ("source", "lang", "host", "author")
    named = df.select(canonical_source().alias("source"), canonical_lang().alias("lang"), host().alias("host"), F.nullif(F.trim("author"), F.lit("")).alias("author"), "text")
    counts = checkpointed(token_counts(named, "text", path, *dims))
    sums = canonical_author(counts.groupBy(*dims).agg(F.count("*").alias("n_docs"), F.sum("n_tokens").alias("n_tokens")), authors)
    by = sums.groupBy("source", "lang", "host", "author").agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
    sets = [[d for i, d in enumerate(dims[:3]) if mask >> i & 1] for mask in range(8)] + [["author"]]
    grouped = by.groupingSets([[F.col(c) for c in s] for s in sets], *(F.col(c) for c in dims)).agg(
        F.grouping_id(*dims).alias("_set"), F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens")
    )
    names = {sum(1 << (3 - i) for i, d in enumerate(dims) if d not in s): "+".join(s) or "all" for s in sets}
    label = F.coalesce(*(F.when(F.col("_set") == k, v) for k, v in names.items()))
    return grouped.select(F.lit(name).alias("corpus"), label.alias("slice"), *dims, "n_docs", "n_tokens").where("n_docs > 0")

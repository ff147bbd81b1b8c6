"""Chunking to a budget: the ladder of separators, packing, spans, and the packing simulation."""

from __future__ import annotations

import base64
import bisect
import os
import re
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..plans import params as P
from .common import spread

LEVELS = ("pass-through", "paragraph", "line", "sentence", "hard")
_SENTENCE = re.compile(r"(?<=[.!?…])(\s+)")
#: Rank file of a public byte-level encoder and the pattern that belongs to it (fixed value).
RANKS = os.environ.get("PUBLIC_TOKENIZERS", "/opt/tokenizers") + "/byte_bpe_50k.tiktoken"
BYTE_PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_encoders: dict[str, object] = {}


def encoder(path: str = RANKS):
    """Encoder of a rank file, loaded once per process."""
    import tiktoken

    if path not in _encoders:
        with open(path, "rb") as f:
            ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, f)}
        _encoders[path] = tiktoken.Encoding(os.path.basename(path), pat_str=BYTE_PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _encoders[path]


def _pieces(text: str, level: int) -> list[str]:
    """``text`` cut one level down; the pieces joined are the text."""
    if level == 3:
        parts = _SENTENCE.split(text)
        joined = [a + b for a, b in zip(parts[::2], [*parts[1::2], ""])]
        return [p for p in joined if p]
    return re.findall(r"(?s).*?\n\n|.+\Z" if level == 1 else r"(?s).*?\n|.+\Z", text)


def _hard(text: str, size: Callable[[str], int], budget: int) -> list[str]:
    """Longest heads within the budget, found by bisection over code points."""
    out = []
    while size(text) > budget:
        low, high = 1, min(len(text) - 1, max(1, budget * 16))
        while low < high:
            mid = (low + high + 1) // 2
            low, high = (mid, high) if size(text[:mid]) <= budget else (low, mid - 1)
        out.append(text[:low])
        text = text[low:]
    return [*out, text] if text else out


def ladder(text: str, size: Callable[[str], int], budget: int) -> tuple[list[tuple[str, int]], int]:
    """Chunks (text, size) within ``budget`` that rebuild ``text``, and the deepest level used.

    Pieces over the budget go one level down; adjacent pieces are packed greedily, and each pack is
    measured as a whole, since joined pieces may encode to more than their sum.
    """
    if not text:
        return [], 0
    stack, parts, deepest = [(text, 0)], [], 0
    while stack:
        piece, level = stack.pop()
        if size(piece) <= budget:
            parts.append(piece)
        elif level + 1 == 4:
            deepest = 4
            parts += _hard(piece, size, budget)
        else:
            cut = _pieces(piece, level + 1)
            if len(cut) > 1:
                deepest = max(deepest, level + 1)
            stack += [(p, level + 1) for p in reversed(cut)]
    chunks: list[tuple[str, int]] = []
    for part in parts:
        if chunks and (n := size(chunks[-1][0] + part)) <= budget:
            chunks[-1] = chunks[-1][0] + part, n
        else:
            chunks.append((part, size(part)))
    return chunks, deepest


def chunked(df: DataFrame, key: str, text: str = "text", budget: int = P.TOKEN_BUDGET, path: str = RANKS) -> DataFrame:
    """Chunks of every row (K4-K6, W6, W7): ``key``, ``chunk_index``, ``n_chunks``, ``char_start``, ``char_end``, ``n_tokens``, ``level``, ``text``.

    Null and empty texts have no chunks. Raises if some chunk is over the budget or a text isn't rebuilt.
    """
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(path).encode_ordinary
        for batch in batches:
            rows = []
            for k, t in zip(batch[key], batch[text]):
                if not isinstance(t, str) or not t:
                    continue
                chunks, level = ladder(t, lambda s: len(encode(s)), budget)
                if "".join(c for c, _ in chunks) != t or any(n > budget for _, n in chunks):
                    raise ValueError(f"chunks of {k!r} don't rebuild its text within {budget}")
                at = 0
                for i, (c, n) in enumerate(chunks):
                    rows.append((k, i, len(chunks), at, at + len(c), n, LEVELS[level], c))
                    at += len(c)
            yield pd.DataFrame(rows, columns=[key, "chunk_index", "n_chunks", "char_start", "char_end", "n_tokens", "level", "text"])

    return spread(df.select(key, text)).mapInPandas(run, f"{key} {kind}, chunk_index int, n_chunks int, char_start bigint, char_end bigint, n_tokens bigint, level string, text string")


def ladder_use(chunks: DataFrame, docs: DataFrame, key: str, by: str) -> DataFrame:
    """Documents per ``by`` and deepest level."""
    levels = chunks.where("chunk_index = 0").select(key, "level")
    return docs.select(key, by).join(levels, key).groupBy(by).pivot("level", list(LEVELS)).count().na.fill(0)


def word_chunks(df: DataFrame, key: str, text: str = "text", budget: int = 200) -> DataFrame:
    """Chunks by lines and words (the ladder's line rung): ``key``, ``chunk``, ``n_lines``, ``n_words``.

    Lines are packed greedily while their words stay within ``budget``; a longer line is a chunk of its own.
    The walk is one fold over the lines of a text, inside the JVM.
    """
    sizes = F.transform(F.split(F.coalesce(F.col(text), F.lit("")), "\n"), T.n_words)
    start = F.struct(F.lit(-1).alias("chunk"), F.lit(0).alias("n"), F.array().cast("array<struct<chunk:int,n:int>>").alias("out"))

    def step(a, n):
        new = (a["chunk"] < 0) | (a["n"] + n > budget)
        chunk = F.when(new, a["chunk"] + 1).otherwise(a["chunk"])
        return F.struct(chunk.alias("chunk"), F.when(new, n).otherwise(a["n"] + n).alias("n"), F.concat(a["out"], F.array(F.struct(chunk.alias("chunk"), n.alias("n")))).alias("out"))

    folded = df.select(key, F.explode(F.aggregate(sizes, start, step)["out"]).alias("c"))
    return folded.groupBy(key, F.col("c.chunk").alias("chunk")).agg(F.count("*").alias("n_lines"), F.sum("c.n").alias("n_words"))


def crop_loss(lengths: list[int], budget: int, buffer: int = P.PACK_BUFFER) -> tuple[int, int]:
    """(cropped, total) tokens of best-fit packing with a look-ahead of ``buffer`` chunks.

    Every chunk has a start token. Rows hold ``budget`` + 1; the largest chunk that fits goes in, and when
    none does the shortest is cropped to the rest. The buffer is kept sorted, so each step is a bisection.
    """
    feed, held, total, cropped = iter(lengths), [], 0, 0
    more = True

    def fill() -> bool:
        nonlocal total
        for n in feed:
            bisect.insort(held, n + 1)
            total += n + 1
            if len(held) == buffer:
                return True
        return False

    while True:
        room = budget + 1
        while room:
            more = more and len(held) < buffer and fill() or more and len(held) == buffer
            if not held:
                return cropped, total
            at = bisect.bisect_right(held, room)
            if at:
                room -= held.pop(at - 1)
            else:
                cropped += held.pop(0) - room
                room = 0


def measured(df: DataFrame, *keep: str, text: str = "text", path: str = RANKS) -> DataFrame:
    """``keep`` and ``n_tokens`` of every row, counted from its text; null and empty texts have none."""
    kinds = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode_ordinary
        for batch in batches:
            sizes = pa.array([len(encode(t)) if t else 0 for t in batch.column(len(keep)).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], sizes], names=[*keep, "n_tokens"])

    return df.select(*keep, text).mapInArrow(run, f"{kinds}, n_tokens bigint")


#: Chunks a loader packs at most on average; a larger table has more loaders.
STREAM_CHUNKS = 200_000


def simulated_crop(chunks: DataFrame, order: list[str], size: str = "n_tokens", budget: int = P.TOKEN_BUDGET, buffer: int = P.PACK_BUFFER, streams: int | None = None) -> DataFrame:
    """``stream``, ``cropped``, ``total``: the packing of each of ``streams`` loaders.

    A loader reads every chunk whose hash of ``order`` falls to it, in that order; one stream is the
    single loader. Packing is sequential within a stream, so a stream is one task; by default there are 64
    or as many as keep a stream at ``STREAM_CHUNKS``.
    """
    if streams is None:
        streams = max(64, -(-chunks.count() // STREAM_CHUNKS))
    rows = chunks.select(*order, F.col(size).cast("bigint").alias("n")).withColumn("stream", F.pmod(F.xxhash64(*order), F.lit(streams)).cast("int") if streams > 1 else F.lit(0))

    def pack(key, rows):
        cropped, total = crop_loss(rows.sort_values(order)["n"].tolist(), budget, buffer)
        return pd.DataFrame([(int(key[0]), cropped, total)], columns=["stream", "cropped", "total"])

    return rows.groupBy("stream").applyInPandas(pack, "stream int, cropped bigint, total bigint")


def vocabulary(spark, path: str = RANKS, special: tuple[str, ...] = P.SPECIAL_TOKENS) -> DataFrame:
    """``id``, ``n_bytes``, ``is_digits``, ``special`` of each token.

    Special tokens stand at the top of the vocabulary, behind the ranks, and have 0 bytes of text.
    """
    with open(path, "rb") as f:
        rows = [(int(r), base64.b64decode(t)) for t, r in map(bytes.split, f)]
    top = max(r for r, _ in rows) + 1
    table = [(i, len(b), b.isdigit() and b.isascii(), None) for i, b in rows] + [(top + i, 0, False, name) for i, name in enumerate(special)]
    return spark.createDataFrame(table, "id int, n_bytes int, is_digits boolean, special string")

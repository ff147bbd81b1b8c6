"""Word lexicon of a corpus: how many documents hold each word.

Only words that at least ``share`` of all documents hold are kept. The document frequencies of all
words sum to (documents x mean distinct words a document), so the lexicon has at most
mean distinct words / share entries however large the corpus grows, and may be broadcast.
"""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A lexicon word stands in at least this share of the documents ...
SHARE = 2e-4
#: ... and in at least this many.
LEAST = 2
#: Characters stripped from both ends of a blank-separated token (fixed value).
EDGE = ".,;:!?»«›‹()[]{}\"'„“”‚‘’–—-…/|*_#<>=†·"
_FLUSH = 300_000


def document_frequencies(df: DataFrame, text: str = "text", lower: bool = False) -> DataFrame:
    """``word``, ``df``: in how many rows of ``df`` a word (lower case, letters only) stands.

    With ``lower``, only words written in lower case count. The row of the empty word counts the documents with text. Words are counted per task before they
    are shuffled, in a dictionary that is handed on whenever it reaches 300,000 entries.
    """

    def run(batches):
        counts: Counter[str] = Counter()
        docs = 0

        def out():
            words: Counter[str] = Counter()
            for token, n in counts.items():
                word = token.strip(EDGE)
                if word.isalpha() and not (lower and not word.islower()):
                    word = word.lower()
                    words[word] += n
            counts.clear()
            return pa.RecordBatch.from_pydict({"word": pa.array(list(words), pa.string()), "df": pa.array(list(words.values()), pa.int64())})

        for batch in batches:
            for value in batch.columns[0].to_pylist():
                if value:
                    docs += 1
                    counts.update(set(value.split()))
            if len(counts) > _FLUSH:
                yield out()
        yield out()
        yield pa.RecordBatch.from_pydict({"word": pa.array([""], pa.string()), "df": pa.array([docs], pa.int64())})

    return df.select(text).mapInArrow(run, "word string, df bigint").groupBy("word").agg(F.sum("df").alias("df"))


class Lexicon:
    """Words and their document frequencies, for use in workers."""

    def __init__(self, words: dict[str, int], docs: int):
        self.words, self.docs = words, docs

    def once(self, make):
        """``make(self)``, made once per worker process: a broadcast lexicon stays in the process between tasks."""
        made = self.__dict__.setdefault("_made", {})
        if make not in made:
            made[make] = make(self)
        return made[make]

    def __getstate__(self):
        return {"words": self.words, "docs": self.docs}

    def __contains__(self, word: str) -> bool:
        return word in self.words

    def get(self, word: str) -> int:
        return self.words.get(word, 0)


def lexicon(df: DataFrame, text: str = "text", share: float = SHARE, least: int = LEAST, lower: bool = False) -> Broadcast:
    """Broadcast :class:`Lexicon` of ``df``; its size is bounded as the module explains."""
    counted = document_frequencies(df, text, lower).persist()
    try:
        docs = sum(r["df"] for r in counted.where(F.col("word") == "").collect())
        rows = counted.where((F.col("df") >= max(least, share * docs)) & (F.col("word") != "")).toArrow()
    finally:
        counted.unpersist()
    words = dict(zip(rows.column("word").to_pylist(), rows.column("df").to_pylist()))
    return df.sparkSession.sparkContext.broadcast(Lexicon(words, docs))

"""Shared plumbing of the training-data operators: table access, batch mapping, source names.

Python work runs in Arrow batches (``mapInArrow``); every helper streams its input, so memory per
worker is bounded by one batch and the bounded dictionaries its caller holds.
"""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

#: Entries a per-worker memo may hold before it is dropped and refilled.
MEMO_ENTRIES = 400_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One test table; files are Parquet."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def map_batches(df: DataFrame, schema: str, make: Callable[[], Callable[..., dict[str, list]]]) -> DataFrame:
    """Apply ``make()(*columns)`` to each Arrow batch of ``df``.

    ``make`` runs once per task and returns the function of one batch; it gets one Python list per
    column of ``df`` and returns a dict of equally long lists, one for each column of ``schema``.
    """
    struct = _parse_datatype_string(schema)
    assert isinstance(struct, StructType)
    arrow = to_arrow_schema(struct)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for batch in batches:
            if batch.num_rows:
                out = step(*(column.to_pylist() for column in batch.columns))
                yield pa.RecordBatch.from_arrays([pa.array(out[f.name], type=f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, struct)


class Memo(dict):
    """A dict that computes missing values with ``make`` and empties itself beyond ``limit`` entries."""

    def __init__(self, make: Callable, limit: int = MEMO_ENTRIES):
        super().__init__()
        self.make, self.limit = make, limit

    def __missing__(self, key):
        if len(self) >= self.limit:
            self.clear()
        value = self[key] = self.make(key)
        return value


def canonical_source(column: str | Column = "source") -> Column:
    """One spelling per source: trimmed, lower case, without hyphens, blanks and underscores; null stays null."""
    name = F.col(column) if isinstance(column, str) else column
    return F.nullif(F.regexp_replace(F.lower(name), r"[\s_\-]+", ""), F.lit(""))


def canonical_lang(column: str | Column = "lang") -> Column:
    """Two-letter code of the language tag: ``SL``, ``slv`` and ``sl`` are one language; null and blank are ``und``."""
    name = F.lower(F.trim(F.col(column) if isinstance(column, str) else column))
    #: ISO 639-2 codes and their ISO 639-1 equivalents (fixed values).
    pairs = {"slv": "sl", "deu": "de", "ger": "de", "eng": "en", "hrv": "hr", "ita": "it", "fra": "fr", "fre": "fr", "srp": "sr", "bos": "bs", "lat": "la", "ces": "cs", "cze": "cs"}
    return F.coalesce(*(F.when(name == long, short) for long, short in pairs.items()), F.nullif(name, F.lit("")), F.lit("und"))


def host(column: str = "url") -> Column:
    """Host of a URL in lower case, without user and port; null if there is none."""
    return F.nullif(F.lower(F.regexp_extract(F.col(column), r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)), F.lit(""))


def canonical_author(df: DataFrame, authors: DataFrame | None = None, column: str = "author") -> DataFrame:
    """Replace ``column`` by one spelling per author.

    ``Surname, Given``, capitals and repeated blanks are undone; with ``authors`` (column ``name``), an
    initial with a surname that fits exactly one of the names becomes that name. Blank is null.
    """
    name = F.trim(F.regexp_replace(column, r"\s+", " "))
    name = F.regexp_replace(name, r"^([^,]+), ([^,]+)$", "$2 $1")
    name = F.nullif(F.initcap(F.lower(name)), F.lit(""))
    df = df.withColumn(column, name)
    if authors is None:
        return df
    short = lambda c: F.concat(F.substring(c, 1, 1), F.lit(". "), F.regexp_replace(c, r"^\S+ ", ""))
    known = authors.select(F.initcap(F.lower("name")).alias("_name")).distinct()
    known = known.groupBy(short(F.col("_name")).alias("_short")).agg(F.min("_name").alias("_name"), F.count("*").alias("_n")).where("_n = 1").drop("_n")
    return df.join(known, df[column] == known["_short"], "left").withColumn(column, F.coalesce("_name", column)).drop("_short", "_name")


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` cut from its lineage by a reliable checkpoint.

    The folder is the one named in ``spark.checkpoint.dir``; where none is set, a temporary one is used on a
    single machine, as in tests, and a cluster must set one.
    """
    context = df.sparkSession.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        folder = context.getConf().get("spark.checkpoint.dir")
        if not folder and not (context.master == "local" or context.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="corpusmill-"))
    return df.checkpoint(eager=True)

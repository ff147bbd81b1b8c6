"""Files: JSON lines, shards, dumps, metadata records, settings, manifests."""

from __future__ import annotations

import datetime
import hashlib
import json
import os
import subprocess
import tomllib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T

CORPUS_DOC = "title string, url string, text string, n_chars bigint, source string, author string"
WORK = "work_id string, title string, author string, year int, genre string, flags array<string>, aliases array<string>, sources array<struct<source:string,id:string,status:string,year:int,note:string>>, notes string"


def read_json_lines(spark: SparkSession, path: str, schema: str = CORPUS_DOC, hint: str = "") -> DataFrame:
    """Rows of a JSON-lines file or folder (S1); a missing path fails at once, a malformed line when it is read."""
    if "://" not in path and not os.path.exists(path):
        raise FileNotFoundError(f"{path} {hint}".strip())
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_shards(spark: SparkSession, folder: str, schema: str = CORPUS_DOC) -> DataFrame:
    """All shards of a folder with ``shard`` (file stem) and ``tier`` (S2, S3, U1); files are read in parallel."""
    rows = spark.read.schema(schema).option("mode", "FAILFAST").json(f"{folder}/*.jsonl")
    stem = F.regexp_extract(F.col("_metadata.file_name"), r"^(.*?)\.jsonl", 1)
    return rows.withColumn("shard", stem).withColumn("tier", T.tier("shard"))


def write_shard(df: DataFrame, path: str, manifest: str, name: str, skipped: dict[str, int] | None = None, **more) -> dict:
    """Write a shard as Parquet and its manifest after that (S4, S16); nothing is recorded if writing fails."""
    df.write.mode("overwrite").parquet(path)
    done = df.sparkSession.read.parquet(path)
    counts = done.agg(F.count("*").alias("docs"), F.sum(F.length("text")).alias("chars"), F.sum(T.n_words("text")).alias("words")).first()
    record = {"name": name, "n_docs": counts["docs"], "n_chars": counts["chars"] or 0, "n_words": counts["words"] or 0, "skipped": skipped or {}, "created_at": utc_now(), "revision": revision(), **more}
    os.makedirs(os.path.dirname(manifest) or ".", exist_ok=True)
    with open(manifest, "w") as f:
        json.dump(record, f, ensure_ascii=False, indent=2, sort_keys=True)
        f.write("\n")
    return record


def read_dump(spark: SparkSession, path: str) -> DataFrame:
    """Pages of a MediaWiki XML dump, also bzip2: ``title``, ``ns``, ``is_redirect``, ``text``."""
    schema = "title string, ns string, redirect struct<_title:string>, revision struct<text:struct<_VALUE:string>>"
    pages = spark.read.format("xml").option("rowTag", "page").schema(schema).load(path)
    return pages.select("title", "ns", F.col("redirect").isNotNull().alias("is_redirect"), F.coalesce("revision.text._VALUE", F.lit("")).alias("text"))


def parse_records(df: DataFrame, key: str, data: str) -> DataFrame:
    """Metadata records from JSON text (S10): title, year, types, langs, people, creators, text_url.

    A value may be one or many, a string or an object with ``#text``; both forms become arrays of strings.
    """
    root = "$.rdf:RDF['edm:ProvidedCHO']"
    one = lambda name: F.get_json_object(data, f"{root}['{name}']")

    def many(name: str):
        raw = one(name)
        listed = F.from_json(F.when(F.startswith(raw, F.lit("[")), raw).otherwise(F.concat(F.lit("["), F.when(F.startswith(raw, F.lit("{")), raw).otherwise(F.to_json(F.array(raw)).substr(F.lit(2), F.length(F.to_json(F.array(raw))) - 2)), F.lit("]"))), "array<string>")
        text = lambda x: F.coalesce(F.when(F.startswith(x, F.lit("{")), F.get_json_object(x, "$['#text']")).otherwise(x), F.lit(""))
        return F.when(raw.isNull(), F.array().cast("array<string>")).otherwise(F.coalesce(F.transform(listed, text), F.array().cast("array<string>")))

    urls = F.from_json(F.get_json_object(data, "$.rdf:RDF['edm:WebResource']"), "array<map<string,string>>")
    return df.select(
        key, F.element_at(F.concat(many("dc:title"), F.array(F.lit(""))), 1).alias("title"), F.nullif(F.regexp_extract(F.array_join(many("dc:date"), " "), r"([0-9]{4})", 1), F.lit("")).cast("int").alias("year"),
        F.array_sort(F.array_distinct(many("dc:type"))).alias("types"), F.array_sort(F.array_distinct(many("dc:language"))).alias("langs"), F.array_sort(F.array_distinct(F.concat(many("dc:contributor"), many("dc:creator")))).alias("people"),
        F.array_sort(F.array_distinct(many("dc:creator"))).alias("creators"), F.element_at(F.concat(F.filter(F.transform(F.coalesce(urls, F.array().cast("array<map<string,string>>")), lambda m: m["@rdf:about"]), lambda u: F.endswith(u, F.lit("/TEXT"))), F.array(F.lit(None).cast("string"))), 1).alias("text_url"),
    )


def record_ids(df: DataFrame, text: str, kind: str = "DOC") -> DataFrame:
    """Distinct ``urn`` of the pages that are of ``kind``."""
    return df.select(F.explode(F.regexp_extract_all(text, F.lit(r"(URN:[A-Z]+(?::[A-Z]+)*-[0-9A-Z]+)"), F.lit(1))).alias("urn")).where(F.col("urn").rlike(f"[:]{kind}-")).distinct()


def decoded(df: DataFrame, data: str) -> DataFrame:
    """``df`` with ``text`` from bytes: UTF-8 if they are, else Windows-1250 with replacement."""

    @F.pandas_udf("string")
    def other(column):
        return column.map(lambda b: None if b is None else bytes(b).decode("cp1250", errors="replace"))

    return df.withColumn("text", F.when(F.is_valid_utf8(F.col(data).cast("string")), F.col(data).cast("string")).otherwise(other(F.col(data))))


def read_settings(spark: SparkSession, path: str, table: str, schema: str) -> DataFrame:
    """An array of tables in a TOML file as rows."""
    with open(path, "rb") as f:
        rows = tomllib.load(f).get(table, [])
    names = [c.split()[0] for c in schema.split(",")]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """Works of a registry file."""
    return read_json_lines(spark, path, WORK)


def write_registry(works: DataFrame, path: str) -> None:
    """A registry as one JSON-lines file in the order of ids, for stable differences (S12); registries are small."""
    works.orderBy("work_id").coalesce(1).write.mode("overwrite").json(path)


def write_report(df: DataFrame, path: str, title: str, order: list[str]) -> None:
    """An aggregate as a Markdown table (S14); rows in ``order``."""
    rows = df.orderBy(*order).toLocalIterator()
    with open(path, "w") as f:
        f.write(f"<!-- generated -->\n# {title}\n\n| {' | '.join(df.columns)} |\n|{'---|' * len(df.columns)}\n")
        for r in rows:
            f.write("| " + " | ".join("-" if v is None else str(v) for v in r) + " |\n")


def file_sha256(path: str) -> str:
    """SHA-256 of a file."""
    digest = hashlib.sha256()
    with open(path, "rb") as f:
        while block := f.read(1 << 20):
            digest.update(block)
    return digest.hexdigest()


def utc_now() -> str:
    """Time stamp in UTC."""
    return datetime.datetime.now(datetime.UTC).strftime("%Y-%m-%dT%H:%M:%SZ")


def revision() -> str:
    """Commit of the working folder, or ``unknown``."""
    done = subprocess.run(["git", "rev-parse", "HEAD"], capture_output=True, text=True, check=False)
    return done.stdout.strip() or "unknown"

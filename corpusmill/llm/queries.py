"""Queries of the training-data operators over the test tables, with production parameters and whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import encoding, leaks, lookalikes, markup, mixing, pii, scans, splitting, tokens
from .base import table

Query = Callable[[SparkSession, str], DataFrame]


def p1_token_budget(spark: SparkSession, sf: str) -> DataFrame:
    authors = table(spark, sf, "author_cfg")
    return tokens.token_budget(table(spark, sf, "corpus_doc"), "corpus_doc", authors).unionByName(tokens.token_budget(table(spark, sf, "documents"), "documents", authors))


def p1_document_tokens(spark: SparkSession, sf: str) -> DataFrame:
    """The exact count of every document of both tables."""
    counted = lambda name, key: tokens.token_counts(table(spark, sf, name), "text", None, key).select(F.lit(name).alias("corpus"), F.col(key).alias("id"), "n_tokens")
    return counted("corpus_doc", "row_id").unionByName(counted("documents", "doc_id"))


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    return leaks.leaks(table(spark, sf, "corpus_doc"), table(spark, sf, "holdout_work"), table(spark, sf, "holdout_manifest"))


def p2_items(spark: SparkSession, sf: str) -> DataFrame:
    """Of each held-out work, in how many rows it leaked; works that didn't leak have 0."""
    works = table(spark, sf, "holdout_work").select("item_id", "title")
    rows = p2_found(spark, sf).groupBy("item_id").agg(F.count("*").alias("n_rows"))
    return works.join(rows, "item_id", "left").select("item_id", "title", F.coalesce("n_rows", F.lit(0)).alias("n_rows"))


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    return scans.damaged(table(spark, sf, "corpus_doc"))


def p3_repaired(spark: SparkSession, sf: str) -> DataFrame:
    return scans.repaired(table(spark, sf, "corpus_doc"))


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    return markup.clean_markup(table(spark, sf, "corpus_doc")).select("row_id", F.explode("syntaxes").alias("syntax")).distinct()


def p4_clean(spark: SparkSession, sf: str) -> DataFrame:
    return markup.clean_markup(table(spark, sf, "corpus_doc"))


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    return encoding.restored(table(spark, sf, "corpus_doc")).where("garbled").select("row_id").distinct()


def p5_restored(spark: SparkSession, sf: str) -> DataFrame:
    return encoding.restored(table(spark, sf, "corpus_doc"))


def p6_found(spark: SparkSession, sf: str) -> DataFrame:
    return lookalikes.marked_fields(table(spark, sf, "corpus_doc"))


def p6_one_form(spark: SparkSession, sf: str) -> DataFrame:
    return lookalikes.one_form(table(spark, sf, "corpus_doc")).select("row_id", "text", "title")


def p7_found(spark: SparkSession, sf: str) -> DataFrame:
    return splitting.pieces(table(spark, sf, "chunk_doc")).where("piece = 0").select("chunk_id", "cut").distinct()


def p7_pieces(spark: SparkSession, sf: str) -> DataFrame:
    return splitting.pieces(table(spark, sf, "chunk_doc"))


def p8_ids(spark: SparkSession, sf: str) -> DataFrame:
    return tokens.encode_documents(table(spark, sf, "documents"))


def p9_mix_shares(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.shares(table(spark, sf, "documents"), table(spark, sf, "mix_target"))


def p9_mix_selection(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.selection(table(spark, sf, "documents"), table(spark, sf, "mix_target"))


def p10_found(spark: SparkSession, sf: str) -> DataFrame:
    return pii.found(table(spark, sf, "documents"), table(spark, sf, "author_cfg"))


def p10_redacted(spark: SparkSession, sf: str) -> DataFrame:
    return pii.redacted(table(spark, sf, "documents"), table(spark, sf, "author_cfg"))


def queries() -> dict[str, Query]:
    own = [
        p1_token_budget, p1_document_tokens, p2_found, p2_items, p3_found, p3_repaired, p4_found, p4_clean, p5_found, p5_restored, p6_found, p6_one_form,
        p7_found, p7_pieces, p8_ids, p9_mix_selection, p9_mix_shares, p10_found, p10_redacted,
    ]
    return {f.__name__: f for f in own}


#: What p6_found looks for, as SQL: marked characters, text that composition changes, words of mixed scripts.
_MARKS = r"[\x{FB00}-\x{FB06}\x{FB13}-\x{FB17}\x{132}\x{133}\x{1C4}-\x{1CC}\x{1F1}-\x{1F3}\x{FF01}-\x{FF60}\x{FFE0}-\x{FFE6}\x{1D400}-\x{1D7FF}\x{2102}\x{210A}-\x{2113}\x{2115}\x{2119}-\x{211D}\x{2124}\x{2128}\x{212C}\x{212D}\x{212F}-\x{2131}\x{2133}\x{2134}\x{200B}-\x{200D}\x{2060}\x{FEFF}\x{A0}\x{2007}\x{202F}\x{3000}]"
_MIXED = r"\p{Latin}[\p{L}\p{Mn}]*[\p{Greek}\p{Cyrillic}]|[\p{Greek}\p{Cyrillic}][\p{L}\p{Mn}]*\p{Latin}"
_MARKED = f"(regexp_matches({{c}}, '{_MARKS}') OR nfc_normalize({{c}}) <> {{c}} OR regexp_matches({{c}}, '{_MIXED}'))"


def oracle_sql() -> dict[str, str]:
    """SQL of the queries that DuckDB can state; the others are tested against brute force and round trips."""
    return {
        "p7_found": """
            SELECT DISTINCT chunk_id,
                   CASE WHEN list_max(list_transform(regexp_split_to_array(text, '[\\s\\x{0B}\\x{1C}-\\x{1F}\\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]+'), lambda x: length(x))) > 1500
                        THEN 'forced' ELSE 'natural' END AS cut
            FROM chunk_doc WHERE length(text) > 1500""",
        "p6_found": " UNION ".join(f"SELECT row_id, '{c}' AS field FROM corpus_doc WHERE {_MARKED.replace('{c}', c)}" for c in ("text", "title")),
    }

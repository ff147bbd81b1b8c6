"""Wiki and scan cleaning as column pipelines, and the skip reasons of ingestion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import unicode
from ..plans import params as P
from .common import spread

REDIRECT = r"(?i)^\s*#(redirect|preusmeritev)"
INDEX_TITLE = r"^(Abecedni )?[Ss]eznam "
DISAMBIGUATION = r"(?i)\{\{\s*Razločitev|Kategorija:\s*Razločitev"


def truncate_apparatus(text: Column) -> Column:
    """Text before the first heading of back matter."""
    return F.regexp_replace(text, rf"(?dims)^=+[ \t]*(?:{P.APPARATUS_PATTERN})[ \t]*=+[ \t]*$.*\z", "")


def strip_rendered(text: Column) -> Column:
    """Text without elements that only render something (P20)."""
    for tag in P.RENDERED:
        text = F.regexp_replace(text, rf"(?is)<{tag}(?:[^\p{{L}}\p{{N}}_>][^>]*)?>.*?</{tag}>", "")
    return F.regexp_replace(text, r"(?i)<(?:templatestyles|mapframe|maplink)(?:[^\p{L}\p{N}_>][^>]*)?/>", "")


def strip_tables_and_media(text: Column, depth: int = 4) -> Column:
    """Text without tables and media links nested up to ``depth`` deep, innermost first."""
    for _ in range(depth):
        text = F.regexp_replace(text, r"(?s)\{\|(?:(?!\{\||\|\}).)*\|\}", "")
        text = F.regexp_replace(text, rf"(?is)\[\[\s*(?:{'|'.join(P.MEDIA_NAMESPACES)})\s*:(?:(?!\[\[|\]\]).)*\]\]", "")
        # A plain link inside a caption gives way to its label, so that the caption's link becomes innermost.
        text = F.regexp_replace(text, r"(\[\[[^\[\]]*:[^\[\]]*)\[\[(?:[^\[\]|]*\|)?([^\[\]|]*)\]\]", "$1$2")
    return text


def strip_interwiki(text: Column) -> Column:
    """Text without links to other language editions."""
    return F.regexp_replace(text, r"\[\[[a-z]{2,3}(?:-[a-z]+)?:[^\]]+\]\]", "")


def preclean(text: Column) -> Column:
    """Apparatus, rendered elements, tables and media, interwiki links, in this order."""
    return strip_interwiki(strip_tables_and_media(strip_rendered(truncate_apparatus(text))))


def clean_wikitext(text: Column, depth: int = 4) -> Column:
    """Plain text of wiki markup (P18): composed; references, templates, links, quotes, tags and magic words go, blanks are tidied."""
    text = F.regexp_replace(unicode.nfc(text), r"(?is)<ref[^>/]*(?:/>|>.*?</ref>)", "")
    for _ in range(depth):
        text = F.regexp_replace(text, r"\{\{[^{}]*\}\}", "")
    text = F.regexp_replace(text, r"\[\[(?:[^\[\]|]*\|)*([^\[\]|]*)\]\]", "$1")
    text = F.regexp_replace(text, r"\[https?://[^\]\s]+ ([^\]]*)\]", "$1")
    text = F.regexp_replace(text, r"'''?", "")
    text = F.regexp_replace(text, r"(?i)</?[a-z][^<>]*>", "")
    text = F.regexp_replace(text, r"__[A-Z]+__", "")
    text = F.regexp_replace(text, r"(?dm)^=+[ \t]*([^=\n]+?)[ \t]*=+[ \t]*$", "$1")
    text = F.regexp_replace(text, r"(?dm)^(?:Kategorija|Category):[^\n]*$", "")
    text = F.regexp_replace(text, r"(?dm)^\^[^\n]*$", "")
    text = F.regexp_replace(text, r"[ \t]+\n", "\n")
    text = F.regexp_replace(text, r"\n{3,}", "\n\n")
    return T.strip(text)


def skip_reason(title: Column, text: Column, namespace: Column, redirect: Column, least: int = P.MIN_CHARS) -> Column:
    """Why a dump page isn't an article, null if it is (F1); cheap tests come before cleaning."""
    plain = clean_wikitext(preclean(text))
    return (
        F.when(namespace != "0", "non_article")
        .when(redirect | text.rlike(REDIRECT), "redirect")
        .when(title.rlike(INDEX_TITLE), "list_page")
        .when(text.rlike(DISAMBIGUATION), "disambiguation")
        .when(plain == "", "empty_text")
        .when(F.length(plain) < least, "stub")
    )


def crawl_skip_reason(text: Column, other_author: Column, least: int = P.MIN_CHARS) -> Column:
    """Why a crawled page isn't a work, null if it is (F2); ``other_author`` says whether its title names another author."""
    plain = clean_wikitext(text)
    return F.when(text.rlike(REDIRECT), "redirect").when(other_author, "other_author").when(F.length(plain) < least, "stub").when(T.index_like(plain), "index_list")


def listed(pages: DataFrame, authors: DataFrame) -> DataFrame:
    """Distinct ``title`` of the pages to crawl: without authors' own and index pages and lists of titles."""
    own = authors.select(F.explode(F.array("name", "index_page")).alias("title")).where("title is not null").distinct()
    return pages.where(F.col("title").isNotNull() & ~F.col("title").rlike(INDEX_TITLE)).select("title").distinct().join(own, "title", "left_anti")


def scan_lines(text: Column) -> Column:
    """Lines of scanned text after joining divided words, with runs of blanks single (first half of P27)."""
    text = F.replace(F.replace(unicode.nfc(text), F.lit("\r\n"), F.lit("\n")), F.lit("�"), F.lit(""))
    text = F.regexp_replace(text, r"([\p{L}\p{N}_])[-¬]\n([\p{L}\p{N}_])", "$1$2")
    text = F.regexp_replace(text, rf"\\[{T.SPACE}]+", " ")
    return F.transform(F.split(text, "\n"), lambda x: F.regexp_replace(T.strip(x), r"[ \t]+", " "))


def scan_drop(line: Column, at: Column, floor: float = P.LINE_FLOOR) -> Column:
    """Whether a line goes: page number, byline, backslashes, journal header, orphan, or too much noise."""
    return (line != "") & (
        line.rlike(r"^[^\p{L}\p{N}]*[0-9]{1,4}[^\p{L}\p{N}]*$")
        | line.rlike(r"^(?:Spisala?|Napisala?)(?:[^\p{L}\p{N}_].{0,59})?$")
        | line.rlike(r"^\\+$")
        | (at < P.HEADER_ZONE) & line.rlike(r"^(?:Štev\.|V Ljubljani,? dne|Leposloven)|(?:^|[^\p{L}\p{N}_])Leto [IVX]+\.?$")
        | (at < P.ORPHAN_ZONE) & (F.length(line) <= 2) & ~line.rlike(r"^[IVXLC]{1,6}\.?$")
        | (T.line_quality(line) < floor)
    )


def scan_clean(text: Column) -> Column:
    """Struct of the cleaned text and the metrics of P28."""

    def measure(clean, ls, kept):
        return F.struct(
            clean.alias("text"), F.length(clean).alias("n_chars"), F.length(F.regexp_replace(clean, rf"[^\p{{L}}{T.SPACE}]", "")).alias("n_letters"), (F.size(ls) - F.size(kept)).alias("dropped_lines"),
            F.size(F.filter(kept, lambda x: x != "")).alias("kept_lines"), F.length(F.regexp_replace(F.substring(clean, 1, 1000), r"[^<>^=~|%&$#]", "")).alias("early_noise"),
        )

    joined = lambda kept: T.strip(F.regexp_replace(F.array_join(kept, "\n"), r"\n{3,}", "\n\n"))
    return T.let(scan_lines(text), lambda ls: T.let(F.filter(ls, lambda x, i: ~scan_drop(x, i)), lambda kept: T.let(joined(kept), lambda clean: measure(clean, ls, kept))))


def scan_gate(clean: Column) -> Column:
    """Why a scanned text is refused, null if it isn't (P29); ``clean`` is the struct of :func:`scan_clean`."""
    alpha = clean["n_letters"] / F.greatest(F.lit(1), clean["n_chars"])
    return F.when(clean["early_noise"] > P.NOISE_MOST, "noisy_opening").when(alpha < P.MIN_ALPHA, "few_letters").when(clean["n_chars"] < P.MIN_CHARS, "short")


def scanned(df: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``key``, cleaned text, metrics and ``refused`` of every row; null text counts as empty."""
    c = spread(df.select(key, text)).select(key, scan_clean(F.coalesce(F.col(text), F.lit(""))).alias("c"))
    return c.select(key, "c.*", scan_gate(F.col("c")).alias("refused"))

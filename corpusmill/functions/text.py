"""Text functions as Spark columns; all but canonical composition run in the JVM.

Patterns that are also stated in SQL name their whitespace and word classes in full, since regular
expression engines differ in what ``\\s`` and ``\\w`` mean beyond ASCII.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..plans import params as P
from . import unicode

#: White space of Unicode as a character class (fixed value).
SPACE = r"\t\n\x0B\f\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
WORD = r"\p{L}\p{N}_"
PUNCTUATION = ".,;:!?\"'()[]«»"


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once: inside a lambda an outer expression would be computed per element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: str | Column) -> Column:
    """Array of the white-space separated words (P1); null text is null, blank text the empty array."""
    return F.regexp_extract_all(_c(text), F.lit(f"[^{SPACE}]+"), F.lit(0))


def n_words(text: str | Column) -> Column:
    """Number of white-space separated words; 0 for null."""
    return F.coalesce(F.size(words(text)), F.lit(0))


def folded(text: str | Column) -> Column:
    """Lower case with ``ß`` as ``ss``."""
    return F.replace(F.lower(_c(text)), F.lit("ß"), F.lit("ss"))


def tokens(text: str | Column) -> Column:
    """Array of case-folded runs of letters, digits and underscores."""
    return F.regexp_extract_all(folded(text), F.lit(f"[{WORD}]+"), F.lit(0))


def strip(text: str | Column) -> Column:
    """Text without white space at both ends."""
    return F.regexp_replace(_c(text), f"^[{SPACE}]+|[{SPACE}]+$", "")


def lines(text: str | Column) -> Column:
    """Array of the non-blank lines, stripped."""
    return F.filter(F.transform(F.split(_c(text), r"\r\n|[\n\x0B\f\r\x{1C}-\x{1E}\x{85}\x{2028}\x{2029}]"), strip), lambda x: x != "")


def shingles(text: str | Column, size: int = P.SHINGLE) -> Column:
    """Set of word ``size``-grams as an array (P3); a shorter text is one shingle, no words none."""

    def grams(w):
        many = F.transform(F.sequence(F.lit(1), F.size(w) - (size - 1)), lambda i: F.array_join(F.slice(w, i, size), " "))
        return F.array_distinct(F.when(F.size(w) >= size, many).when(F.size(w) > 0, F.array(F.array_join(w, " "))).otherwise(F.array().cast("array<string>")))

    return let(tokens(text), grams)


def shingle_hashes(text: str | Column, size: int = P.SHINGLE) -> Column:
    """Sorted 64-bit hashes of :func:`shingles`, 8 bytes each instead of some thirty."""
    return F.array_sort(F.array_distinct(F.transform(shingles(text, size), lambda s: F.xxhash64(s))))


def gram_hashes(text: str | Column, size: int = P.SHINGLE) -> Column:
    """Sorted 64-bit hashes of :func:`shingles`, from one hash per word: several times as fast as :func:`shingle_hashes`, other numbers. None for null."""

    def grams(h):
        many = F.transform(F.sequence(F.lit(1), F.size(h) - (size - 1)), lambda i: F.xxhash64(*(F.element_at(h, i + k) for k in range(size))))
        return F.when(F.size(h) >= size, many).when(F.size(h) > 0, F.array(F.xxhash64(h))).otherwise(F.array().cast("array<bigint>"))

    hashes = let(F.transform(tokens(text), lambda w: F.xxhash64(w)), grams)
    return F.coalesce(F.sort_array(F.array_distinct(hashes)), F.array().cast("array<bigint>"))


def content_hash(text: str | Column) -> Column:
    """SHA-256 of the UTF-8 bytes (P5)."""
    return F.sha2(_c(text), 256)


def function_word_count(text: str | Column, lexicon: str = P.FUNCTION_WORDS) -> Column:
    """How many words, without punctuation at their ends, are of ``lexicon``."""
    return function_words_of(words(text), lexicon)


def function_words_of(ws: Column, lexicon: str = P.FUNCTION_WORDS) -> Column:
    """The same for an array of words; a hash set is looked up per word."""
    return F.size(F.filter(ws, lambda w: folded(F.btrim(w, F.lit(PUNCTUATION))).isin(*dict.fromkeys(lexicon.split()))))


def year_count(text: str | Column) -> Column:
    """How many four-digit years from 1500 to 2099 stand alone in the text."""
    parts = F.regexp_extract_all(_c(text), F.lit(r"[\p{L}\p{N}_]+"), F.lit(0))
    return F.size(F.filter(parts, lambda w: w.rlike(r"^(?:1[5-9][0-9][0-9]|20[0-9][0-9])$")))


def index_like(text: str | Column) -> Column:
    """Whether a text is a list of titles or a table of contents."""

    return let(lines(text), index_like_lines)


def index_like_lines(ls: Column) -> Column:
    """The same for an array of lines; it should be a column or bound, as it is used several times."""
    n = F.size(ls)
    titles = F.size(F.filter(ls, lambda x: (F.length(x) < P.TITLE_LENGTH) & ~x.rlike(r"""[.!?«“"]$""") & ~x.rlike(r"[,;:!?.]")))
    numbered = F.size(F.filter(ls, lambda x: x.rlike(r"\p{Nd}")))
    share, digits = titles / F.greatest(n, F.lit(1)), numbered / F.greatest(n, F.lit(1))
    return (n >= P.INDEX_LINES) & ((share > P.INDEX_TITLES) | (digits > P.INDEX_DIGITS) & (share > P.INDEX_TITLE_FLOOR))


def verdict(text: str | Column) -> Column:
    """Quality gate (P9): the first that holds of empty, not_slovene, bibliography, index_list, else kept."""
    n = n_words(text)
    return (
        F.when(n == 0, "empty")
        .when(function_word_count(text) / n < P.LANGUAGE_FLOOR, "not_slovene")
        .when(year_count(text) / n > P.YEAR_CEILING, "bibliography")
        .when(index_like(text), "index_list")
        .otherwise("kept")
    )


def type_counts(text: str | Column, window: int = P.MATTR_WINDOW) -> Column:
    """Array of the distinct case-folded words of each window at a stride of a fifth window.

    A text within one window has one count, of all its words; an empty one has none.
    """

    return let(F.transform(words(text), folded), lambda w: type_counts_of(w, window))


def type_counts_of(w: Column, window: int = P.MATTR_WINDOW) -> Column:
    """The same for an array of case-folded words."""
    n = F.size(w)
    starts = F.sequence(F.lit(0), n - window, F.lit(max(1, window // 5)))
    many = F.transform(starts, lambda i: F.size(F.array_distinct(F.slice(w, i + 1, window))))
    return F.when(n > window, many).when(n > 0, F.array(F.size(F.array_distinct(w)))).otherwise(F.array().cast("array<int>"))


def mattr(text: str | Column, window: int = P.MATTR_WINDOW) -> Column:
    """Moving-average type-token ratio; 0 for texts without words."""
    total = lambda counts: F.aggregate(counts, F.lit(0).cast("bigint"), lambda a, x: a + x)
    mean = lambda counts: F.when(F.size(counts) == 0, 0.0).otherwise(total(counts) / (F.size(counts) * F.least(F.lit(window), n_words(text))))
    return let(type_counts(text, window), mean)


def repeated_lines(text: str | Column) -> Column:
    """How many non-blank lines repeat an earlier one; 0 for fewer than two."""
    return let(lines(text), lambda ls: F.when(F.size(ls) < 2, 0).otherwise(F.size(ls) - F.size(F.array_distinct(ls))))


def unknown_chars(text: str | Column) -> Column:
    """How many characters are neither of Slovene text nor white space."""
    return F.length(F.regexp_replace(_c(text), f"[{P.ALLOWED}{SPACE}]", ""))


#: Markup that shouldn't survive cleaning, by probe (P13; fixed values).
PROBES = {"wikitable": r"\{\|", "wikilink": r"\[\[", "template": r"\{\{", "image_frag": r"(?:^|[^\p{L}\p{N}_])(?:thumb|sličica)\|", "ref_tag": "<ref", "heading": r"(?m)^==+[^\n]+==+[ \t]*$"}


def normalized_title(title: str | Column) -> Column:
    """Matching key of a title: composed, case-folded, punctuation as blanks, diacritics kept."""
    return strip(F.regexp_replace(F.regexp_replace(folded(unicode.nfc(title)), f"[^{WORD}{SPACE}]", " "), f"[{SPACE}]+", " "))


def title_without_author(title: str | Column, author: str | Column) -> Column:
    """The title without a closing bracket that names the author's surname."""
    surname = folded(F.element_at(words(unicode.nfc(author)), -1))
    inner = F.regexp_extract(_c(title), r"\(([^)]*)\)[ \t\n]*$", 1)
    named = F.coalesce((inner != "") & F.contains(folded(unicode.nfc(inner)), surname), F.lit(False))
    return normalized_title(F.when(named, F.regexp_replace(_c(title), r"[ \t\n]*\([^)]*\)[ \t\n]*$", "")).otherwise(_c(title)))


def slug(title: str | Column) -> Column:
    """Title as a URL part: normalized, without diacritics, blanks as hyphens."""
    return F.replace(unicode.without_marks(normalized_title(title)), F.lit(" "), F.lit("-"))


def attributed_to(title: str | Column) -> Column:
    """Name in the bracket that closes a title, else null (P25)."""
    return F.nullif(strip(F.regexp_extract(_c(title), r"\(([^)]+)\)[ \t\n]*$", 1)), F.lit(""))


def line_quality(line: str | Column) -> Column:
    """Share of letters, blanks and usual punctuation in a stripped line; 1 for a blank one."""
    bare = strip(line)
    good = F.length(F.regexp_replace(bare, rf"""[^\p{{L}}{SPACE}.,;:!?\-"'()„“”«»*…]""", ""))
    return F.when(F.length(bare) == 0, 1.0).otherwise(good / F.length(bare))


def tier(shard: str | Column) -> Column:
    """Preference of a shard by its name, lower first."""
    s = _c(shard)
    return F.when(s == "wikipedia", 3).when(s.startswith("dlib-") & s.endswith("-gapfill"), 2).when(s.startswith("dlib-"), 1).otherwise(0)


def source_name(source: str | Column) -> Column:
    """One spelling per source: lower case, without blanks, hyphens and underscores."""
    return F.regexp_replace(F.lower(_c(source)), r"[\s_\-]+", "")


def slice_of(source: str | Column, author: str | Column, main_author: str) -> Column:
    """Reporting slice: the main author first, then the encyclopedia, else literary (P30); sources in any spelling."""
    return F.when(_c(author) == main_author, "main_author").when(source_name(source) == "wikipedia", "wikipedia").otherwise("literary")


def title_url(base: str, title: str | Column) -> Column:
    """Page address of a title."""
    return F.concat(F.lit(base), F.replace(_c(title), F.lit(" "), F.lit("_")))


def sentences(text: str | Column) -> Column:
    """Pieces that end after sentence marks and the blanks behind them; joined they are the text."""
    return F.regexp_extract_all(_c(text), F.lit(r"(?s).*?[.!?…]+[ \t\n\r]+|.+$"), F.lit(0))


def pretokens(text: str | Column) -> Column:
    """Pre-tokens whose concatenation is the text."""
    return F.regexp_extract_all(_c(text), F.lit("(?U)" + P.SPLIT_PATTERN), F.lit(0))


def parameters(vocabulary: str | Column, depth: str | Column) -> dict[str, Column]:
    """Weights that a vocabulary and the blocks of a decoder of ``depth`` layers take, width 64 a layer."""
    v, d = _c(vocabulary).cast("bigint"), _c(depth).cast("bigint")
    width = d * 64
    block = F.lit(12).cast("bigint") * width * width * d
    vocab = (F.lit(2) + F.ceil(d / 2)) * v * width
    return {"width": width, "block_params": block, "vocab_params": vocab.cast("bigint"), "total_params": (block + vocab).cast("bigint")}


def band(text: str | Column) -> Column:
    """``lo,hi`` as a struct of integers, null if it is no such pair."""
    parts = F.split(_c(text), ",")
    return F.when(_c(text).rlike(r"^\s*\d+\s*,\s*\d+\s*$"), F.struct(F.trim(parts[0]).cast("int").alias("lo"), F.trim(parts[1]).cast("int").alias("hi")))

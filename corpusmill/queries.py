"""Queries of the core operators over the test tables, each with the SQL that states it where SQL can."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import text as T
from .functions import unicode
from .operators.common import spread
from .operators import chunks, cleaning, documents, holdout, merge, similarity, tokenization, works
from .plans import params as P
from .sources import files
from .streaming import dedup

Query = Callable[[SparkSession, str], DataFrame]
MAIN_AUTHOR = "Matija Brezovar"
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function of (spark, sf_dir) under its name, with its SQL."""

    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def corpus(spark: SparkSession, sf: str) -> DataFrame:
    return _table(spark, sf, "corpus_doc")


def _n(text: str) -> str:
    """SQL literal of a regular expression."""
    return "'" + text.replace("'", "''") + "'"


SP = T.SPACE
WORDS = f"regexp_extract_all(coalesce(text, ''), {_n(f'[^{SP}]+')})"
FOLD = lambda x: f"replace(lower({x}), 'ß', 'ss')"
STRIP = lambda x: f"regexp_replace({x}, " + _n(f"^[{SP}]+|[{SP}]+$") + ", '', 'g')"
LINES = f"list_filter(list_transform(regexp_split_to_array(coalesce(text, ''), " + _n(r"\r\n|[\n\x0B\f\r\x{1C}-\x{1E}\x{85}\x{2028}\x{2029}]") + f"), lambda x: {STRIP('x')}), lambda x: x <> '')"
TOKENS = f"regexp_extract_all({FOLD('coalesce(text, chr(32))')}, {_n(f'[{T.WORD}]+')})"
SHINGLES = f"(SELECT row_id, CASE WHEN len(w) >= 5 THEN list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s FROM (SELECT row_id, {TOKENS} AS w FROM corpus_doc))"
NORM = lambda c: STRIP(f"regexp_replace(regexp_replace({FOLD(f'nfc_normalize({c})')}, {_n(f'[^{T.WORD}{SP}]')}, ' ', 'g'), {_n(f'[{SP}]+')}, ' ', 'g')")
SOURCE = r"regexp_replace(lower(source), '[\s_\-]+', '', 'g')"
TIER = "CASE WHEN shard = 'wikipedia' THEN 3 WHEN shard LIKE 'dlib-%-gapfill' THEN 2 WHEN shard LIKE 'dlib-%' THEN 1 ELSE 0 END"
LEX = "[" + ", ".join(f"'{w}'" for w in dict.fromkeys(P.FUNCTION_WORDS.split())) + "]"
_PUNCT = _n(T.PUNCTUATION)
GATE = f"""(SELECT row_id, shard, author, len(w) AS n_words,
    len(list_filter(w, lambda x: list_contains({LEX}, {FOLD(f"trim(x, {_PUNCT})")}))) AS n_function_words,
    len(list_filter(regexp_extract_all(text, '[\\p{{L}}\\p{{N}}_]+'), lambda x: regexp_full_match(x, '1[5-9][0-9][0-9]|20[0-9][0-9]'))) AS n_years,
    len(l) >= 10 AND (len(t) / len(l) > 0.65 OR (len(d) / len(l) > 0.10 AND len(t) / len(l) > 0.30)) AS index_like
  FROM (SELECT row_id, shard, author, text, w, l,
          list_filter(l, lambda x: length(x) < 60 AND NOT regexp_matches(x, '[.!?«“"]$') AND NOT regexp_matches(x, '[,;:!?.]')) AS t,
          list_filter(l, lambda x: regexp_matches(x, '\\p{{Nd}}')) AS d
        FROM (SELECT row_id, shard, author, coalesce(text, '') AS text, {WORDS} AS w, {LINES} AS l FROM corpus_doc)))"""
VERDICT = "CASE WHEN n_words = 0 THEN 'empty' WHEN n_function_words / n_words < 0.05 THEN 'not_slovene' WHEN n_years / n_words > 0.05 THEN 'bibliography' WHEN index_like THEN 'index_list' ELSE 'kept' END"


# Measures of documents.


@query(f"""
WITH d AS (SELECT shard, len({WORDS}) AS w, length(coalesce(text, '')) AS c, sha256(coalesce(text, '')) AS h,
             length(regexp_replace(coalesce(text, ''), {_n(f'[{P.ALLOWED}{SP}]')}, '', 'g')) AS u FROM corpus_doc)
SELECT shard, count(*) AS n_docs, CAST(sum(w) AS BIGINT) AS n_words, CAST(sum(c) AS BIGINT) AS n_chars, CAST(min(w) AS BIGINT) AS words_min, CAST(max(w) AS BIGINT) AS words_max,
  CAST(sum(u) AS BIGINT) AS unknown_chars, count(*) - count(DISTINCT h) AS n_repeated,
  CAST(list_sort(list(w))[CAST(floor(CAST(0.95 AS DOUBLE) * (count(*) - 1)) AS BIGINT) + 1] AS BIGINT) AS words_p95,
  CAST(list_sort(list(w))[CAST(floor(CAST(0.5 AS DOUBLE) * (count(*) - 1)) AS BIGINT) + 1] AS BIGINT) AS words_p50
FROM d GROUP BY shard""")
def shard_metrics(spark, sf):
    m = documents.shard_metrics(corpus(spark, sf))
    return m.select(*(F.col(c).cast("bigint").alias(c) if c != "shard" else F.col(c) for c in m.columns))


@query(f"SELECT source, count(*) AS n, CAST(median(len({WORDS})) * 2 AS BIGINT) AS words_median_twice FROM corpus_doc GROUP BY source")
def word_count_medians(spark, sf):
    m = corpus(spark, sf).select("source", T.n_words(F.coalesce("text", F.lit(""))).alias("w"))
    return m.groupBy("source").agg(F.count("*").alias("n"), (F.median("w") * 2).cast("bigint").alias("words_median_twice"))


@query(f"""
WITH d AS (SELECT coalesce(shard, '') AS shard, list_transform({WORDS}, lambda x: {FOLD('x')}) AS w, {LINES} AS l FROM corpus_doc),
m AS (SELECT shard, len(w) AS n, CASE WHEN len(w) = 0 THEN 0.0::DOUBLE WHEN len(w) <= 500 THEN len(list_distinct(w)) / len(w)
        ELSE list_sum(list_transform(range(0, len(w) - 499, 100), lambda i: len(list_distinct(w[i+1:i+500])))) / (len(range(0, len(w) - 499, 100)) * 500) END AS mattr,
      CASE WHEN len(l) < 2 THEN 0.0::DOUBLE ELSE (len(l) - len(list_distinct(l))) / len(l) END AS rep FROM d)
SELECT shard, count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_words, CAST(floor(sum(mattr * n) / nullif(sum(n), 0) * 1e6 + 0.5) AS BIGINT) AS mattr_millionths,
  CAST(floor(sum(rep * n) / nullif(sum(n), 0) * 1e6 + 0.5) AS BIGINT) AS repeated_line_millionths FROM m GROUP BY shard""")
def lexical_metrics(spark, sf):
    m = documents.lexical_metrics(corpus(spark, sf).withColumn("shard", F.coalesce("shard", F.lit(""))), "shard")
    return m.withColumn("n_words", F.col("n_words").cast("bigint"))


@query(
    "SELECT source, count(*) AS n_docs, "
    + ", ".join(f"count(*) FILTER (WHERE regexp_matches(text, {_n(p)})) AS n_{name}" for name, p in T.PROBES.items())
    + " FROM corpus_doc GROUP BY source"
)
def markup_rates(spark, sf):
    return documents.markup_rates(corpus(spark, sf), "source")


@query(f"SELECT row_id, n_words, n_function_words, n_years, index_like, {VERDICT} AS verdict FROM {GATE}")
def gate_verdicts(spark, sf):
    g = documents.gate(corpus(spark, sf), "row_id")
    return g.select("row_id", *(F.col(c).cast("bigint").alias(c) for c in ("n_words", "n_function_words", "n_years")), F.coalesce("index_like", F.lit(False)).alias("index_like"), "verdict")


@query(f"""SELECT v.verdict, count(g.row_id) AS n FROM (VALUES ('kept'), ('empty'), ('not_slovene'), ('bibliography'), ('index_list')) v(verdict)
LEFT JOIN (SELECT row_id, {VERDICT} AS verdict FROM {GATE}) g ON g.verdict = v.verdict GROUP BY v.verdict""")
def gate_reason_counts(spark, sf):
    return documents.reason_counts(documents.gate(corpus(spark, sf), "row_id"), "verdict", ["kept", "empty", "not_slovene", "bibliography", "index_list"])


@query(f"SELECT row_id, n_years, n_words FROM {GATE} WHERE n_words > 0 AND n_years / n_words > 0.01")
def year_ratio_docs(spark, sf):
    g = documents.gate(corpus(spark, sf), "row_id").where("n_words > 0 and n_years / n_words > 0.01")
    return g.select("row_id", F.col("n_years").cast("bigint").alias("n_years"), F.col("n_words").cast("bigint").alias("n_words"))


@query("""SELECT source, author, CAST(grouping(source) * 2 + grouping(author) AS INTEGER) AS level, count(*) AS n_docs, CAST(sum(w) AS BIGINT) AS n_words, CAST(sum(b) AS BIGINT) AS n_bytes
FROM (SELECT source, coalesce(author, '-') AS author, len(%s) AS w, octet_length(encode(coalesce(text, ''))) AS b FROM corpus_doc) GROUP BY ROLLUP (source, author)""" % WORDS)
def source_author_rollup(spark, sf):
    g = documents.group_statistics(corpus(spark, sf))
    return g.select("source", "author", "level", "n_docs", F.col("n_words").cast("bigint").alias("n_words"), F.col("n_bytes").cast("bigint").alias("n_bytes"))


UNITS = f"regexp_extract_all(coalesce(text, ''), {_n(rf'\p{{L}}+|\p{{N}}{{1,2}}|[^{SP}\p{{L}}\p{{N}}]+')})"


@query(f"""SELECT slice, count(*) AS n_docs, CAST(sum(w) AS BIGINT) AS n_words, CAST(sum(b) AS BIGINT) AS n_bytes, CAST(sum(len(u)) AS BIGINT) AS n_units,
  CAST(sum(len(list_filter(u, lambda x: regexp_full_match(x, '[0-9]+')))) AS BIGINT) AS n_digit_units, count(*) FILTER (WHERE soft) AS n_soft_hyphen, count(*) FILTER (WHERE tab) AS n_tab
FROM (SELECT CASE WHEN author = '{MAIN_AUTHOR}' THEN 'main_author' WHEN {SOURCE} = 'wikipedia' THEN 'wikipedia' ELSE 'literary' END AS slice, len({WORDS}) AS w, octet_length(encode(coalesce(text, ''))) AS b,
  {UNITS} AS u, contains(text, chr(173)) AS soft, contains(text, chr(9)) AS tab FROM corpus_doc) GROUP BY slice""")
def slice_stats(spark, sf):
    s = documents.slice_statistics(corpus(spark, sf), MAIN_AUTHOR)
    return s.select("slice", *(F.col(c).cast("bigint").alias(c) for c in s.columns if c != "slice"))


@query(f"""SELECT count(*) AS n_docs, CAST(sum(len({WORDS})) AS BIGINT) AS n_words, CAST(floor(sum(len({WORDS})) / 32768) AS BIGINT) AS steps_16, CAST(floor(sum(len({WORDS})) / 65536) AS BIGINT) AS steps_32 FROM corpus_doc""")
def steps_per_epoch(spark, sf):
    t = corpus(spark, sf).agg(F.count("*").alias("n_docs"), F.sum(T.n_words(F.coalesce("text", F.lit("")))).cast("bigint").alias("n_words"))
    return documents.steps_per_epoch(t, "n_words")


@query("""SELECT 'length_missing' AS problem, count(*) FILTER (WHERE n_chars IS NULL) AS n FROM corpus_doc UNION ALL
SELECT 'length_stale', count(*) FILTER (WHERE n_chars <> length(coalesce(text, ''))) FROM corpus_doc UNION ALL
SELECT 'text_empty', count(*) FILTER (WHERE coalesce(text, '') = '') FROM corpus_doc UNION ALL
SELECT 'url_repeated', count(url) - count(DISTINCT url) FROM corpus_doc""")
def contract_violations(spark, sf):
    return documents.contract_violations(corpus(spark, sf), "row_id")


@query("SELECT V AS vocabulary, L AS depth, 64 * L AS width, 12 * (64 * L) * (64 * L) * L AS block_params, (2 + CAST(ceil(L / 2) AS BIGINT)) * V * 64 * L AS vocab_params, 12 * (64 * L) * (64 * L) * L + (2 + CAST(ceil(L / 2) AS BIGINT)) * V * 64 * L AS total_params FROM (VALUES (4096::BIGINT), (8192), (16384)) a(V), (VALUES (4::BIGINT), (6), (8)) b(L)")
def vocab_param_cost(spark, sf):
    grid = spark.createDataFrame([(v, d) for v in (4096, 8192, 16384) for d in P.DEPTHS], "vocabulary bigint, depth bigint")
    return grid.select("vocabulary", "depth", *(c.alias(n) for n, c in T.parameters("vocabulary", "depth").items()))


# Titles and works.


@query(f"""SELECT row_id, {NORM("coalesce(title, '')")} AS norm, attributed, concat('https://vir.example/wiki/', replace(title, ' ', '_')) AS url_of_title FROM
(SELECT row_id, title, nullif({STRIP("regexp_extract(title, '\\(([^)]+)\\)[ \\t\\n]*$', 1)")}, '') AS attributed FROM corpus_doc)""")
def title_keys(spark, sf):
    c = corpus(spark, sf)
    return c.select("row_id", T.normalized_title(F.coalesce("title", F.lit(""))).alias("norm"), T.attributed_to("title").alias("attributed"), T.title_url("https://vir.example/wiki/", "title").alias("url_of_title"))


@query(f"SELECT work_id, replace(strip_accents({NORM('title')}), ' ', '-') AS slug FROM work_registry")
def slugs(spark, sf):
    return _table(spark, sf, "work_registry").select("work_id", T.slug("title").alias("slug"))


INDEX = f"""(SELECT author, norm, arg_min(work_id, CAST(rank AS VARCHAR) || work_id) AS work_id FROM (
  SELECT author, {NORM('title')} AS norm, work_id, 0 AS rank FROM work_registry UNION ALL
  SELECT author, {NORM('a')} AS norm, work_id, 1 AS rank FROM (SELECT author, work_id, unnest(aliases) AS a FROM work_registry)) WHERE norm <> '' AND author IS NOT NULL GROUP BY author, norm)"""
_SUR = FOLD(f"list_extract(regexp_extract_all(nfc_normalize(author), {_n(f'[^{SP}]+')}), -1)")
BARE_TITLE = NORM(f"CASE WHEN regexp_extract(title, '\\(([^)]*)\\)[ \\t\\n]*$', 1) <> '' AND contains({FOLD("nfc_normalize(regexp_extract(title, '\\(([^)]*)\\)[ \\t\\n]*$', 1))")}, {_SUR}) THEN regexp_replace(title, '[ \\t\\n]*\\([^)]*\\)[ \\t\\n]*$', '') ELSE title END")
LOOKUP = f"(SELECT d.row_id, i.work_id FROM (SELECT row_id, author, {BARE_TITLE} AS norm FROM corpus_doc) d LEFT JOIN {INDEX} i USING (author, norm))"


@query(f"SELECT row_id, work_id FROM {LOOKUP}")
def work_lookup(spark, sf):
    return works.find_works(corpus(spark, sf), _table(spark, sf, "work_registry"), "row_id")


@query(f"""WITH p AS (SELECT row_id, author, unnest(range(0, len(ps))) AS probe, unnest(ps) AS t FROM (SELECT row_id, author, list_concat([title], regexp_split_to_array(title, '[ \\t\\n]*[:;|][ \\t\\n]*')) AS ps
  FROM (SELECT row_id, author, concat(title, '; zbirka: ', author) AS title FROM corpus_doc))),
h AS (SELECT row_id, arg_min(work_id, probe) AS work_id, min(probe) AS probe FROM (SELECT row_id, author, probe, {NORM('t')} AS norm FROM p) JOIN {INDEX} USING (author, norm) GROUP BY row_id)
SELECT c.row_id, h.work_id, CAST(h.probe AS INTEGER) AS probe FROM corpus_doc c LEFT JOIN h USING (row_id)""")
def segment_match(spark, sf):
    titles = corpus(spark, sf).select("row_id", "author", F.concat("title", F.lit("; zbirka: "), F.coalesce("author", F.lit(""))).alias("title"))
    return works.find_by_segments(titles, _table(spark, sf, "work_registry"), "row_id")


@query(f"SELECT norm, count(DISTINCT author) AS n_authors, array_to_string(list_sort(list(DISTINCT author)), '; ') AS authors FROM (SELECT {NORM('title')} AS norm, author FROM work_registry) WHERE norm <> '' GROUP BY norm HAVING count(DISTINCT author) > 1")
def title_collisions(spark, sf):
    return works.title_collisions(_table(spark, sf, "work_registry"))


@query(f"""WITH n AS (SELECT work_id, author, year, {NORM('title')} AS norm FROM work_registry)
SELECT 'repeated_title' AS problem, work_id FROM n JOIN (SELECT author, norm FROM n GROUP BY author, norm HAVING count(*) > 1) USING (author, norm) UNION ALL
SELECT 'year_out_of_range', work_id FROM n WHERE year NOT BETWEEN 1800 AND 1940""")
def registry_problems(spark, sf):
    return works.validate(_table(spark, sf, "work_registry"), (1800, 1940))


@query("""SELECT work_id, title, coalesce(year, 1900) AS year, coalesce(genre, 'neznano') AS genre, list_sort(list_distinct(list_concat(flags, ['pregledano']))) AS flags, len(sources) AS n_sources,
len(list_filter(sources, lambda s: s.status = 'ingested')) AS n_ingested FROM work_registry""")
def registry_upsert(spark, sf):
    w = _table(spark, sf, "work_registry")
    new = w.select("work_id", "title", "author", F.lit(1900).alias("year"), F.lit("neznano").alias("genre"), F.array(F.lit("pregledano")).alias("flags"), F.array("title").alias("aliases"), F.transform("sources", lambda s: s.withField("status", F.lit("candidate"))).alias("sources"), "notes")
    done = works.upsert(w, new)
    return done.select("work_id", "title", "year", "genre", "flags", F.size("sources").cast("bigint").alias("n_sources"), F.size(F.filter("sources", lambda s: s["status"] == "ingested")).cast("bigint").alias("n_ingested"))


@query("SELECT work_id, len(sources) AS n_sources, len(list_filter(sources, lambda s: s.status = 'ingested')) AS n_ingested, array_to_string(list_sort(list_distinct(list_transform(list_filter(sources, lambda s: s.status = 'ingested'), lambda s: s.source))), '+') AS ingested_from FROM work_registry")
def work_coverage(spark, sf):
    c = works.coverage(_table(spark, sf, "work_registry"))
    return c.select("work_id", F.col("n_sources").cast("bigint").alias("n_sources"), F.col("n_ingested").cast("bigint").alias("n_ingested"), "ingested_from")


@query("""SELECT row_id, CASE WHEN author IS NOT NULL THEN starts_with(lower(author), 'matija') ELSE contains(lower(title), 'brez') END AS by_author FROM corpus_doc""")
def authorship(spark, sf):
    c = corpus(spark, sf)
    creators = F.when(F.col("author").isNotNull(), F.array("author")).otherwise(F.array().cast("array<string>"))
    return c.select("row_id", works.by_author(creators, F.array("title"), F.lit(""), "brez").alias("x"), works.by_author(creators, F.array("title"), F.lit(""), "matija").alias("y"), "author").select("row_id", F.when(F.col("author").isNotNull(), F.col("y")).otherwise(F.col("x")).alias("by_author"))


# Duplicates and overlaps.


@query(f"SELECT row_id, CAST(len(s) AS BIGINT) AS n FROM {SHINGLES}")
def shingle_counts(spark, sf):
    return spread(corpus(spark, sf).select("row_id", "text")).select("row_id", F.size(T.shingles(F.coalesce("text", F.lit("")))).cast("bigint").alias("n"))


@query(f"SELECT row_id, first_value(row_id) OVER (PARTITION BY coalesce(sha256(text), 'null-' || row_id) ORDER BY {TIER}, shard, row_id) AS root FROM corpus_doc")
def exact_dup_keep_first(spark, sf):
    return similarity.exact_copies(corpus(spark, sf), "row_id", "text", [T.tier("shard"), F.col("shard")])


JACCARD = f"""e AS MATERIALIZED (SELECT row_id, len(s) AS n, unnest(s) AS g FROM (SELECT min(row_id) AS row_id, s FROM (SELECT row_id, list_sort(s) AS s FROM {SHINGLES}) WHERE len(s) > 0 GROUP BY s)),
p AS MATERIALIZED (SELECT x.row_id AS a, y.row_id AS b, count(*) AS common, x.n AS n_a, y.n AS n_b FROM e x JOIN e y USING (g) WHERE x.row_id < y.row_id GROUP BY ALL HAVING count(*) >= 0.8 * (x.n + y.n - count(*)) - 1e-9)"""


@query(f"WITH {JACCARD} SELECT a, b, CAST(common AS BIGINT) AS common, CAST(n_a AS BIGINT) AS n_a, CAST(n_b AS BIGINT) AS n_b FROM p")
def similar_pairs(spark, sf):
    s = similarity.similar_pairs(corpus(spark, sf), "row_id")
    return s.select("a", "b", *(F.col(c).cast("bigint").alias(c) for c in ("common", "n_a", "n_b")))


ROOTS = f"r AS MATERIALIZED (SELECT row_id, CASE WHEN len(s) = 0 THEN row_id ELSE min(row_id) OVER (PARTITION BY s) END AS root FROM (SELECT row_id, list_sort(s) AS s FROM {SHINGLES}))"


@query(f"""WITH RECURSIVE {JACCARD}, {ROOTS}, b2 AS (SELECT a AS x, b AS y FROM p UNION ALL SELECT b, a FROM p),
c(x, y) AS (SELECT x, y FROM b2 UNION SELECT c.x, b2.y FROM c JOIN b2 ON c.y = b2.x),
l AS (SELECT x AS root, least(x, min(y)) AS label FROM c GROUP BY x), k AS (SELECT x AS root, count(*) AS n FROM b2 GROUP BY x)
SELECT r.row_id, coalesce(l.label, r.root) AS class_id, coalesce(k.n, 0) AS n_links FROM r LEFT JOIN l USING (root) LEFT JOIN k USING (root)""")
def near_duplicates(spark, sf):
    return similarity.near_duplicates(corpus(spark, sf), "row_id")


@query()
def near_dup_keep_first(spark, sf):
    return similarity.near_duplicate_roots(corpus(spark, sf), "row_id")


@query(f"""WITH RECURSIVE {JACCARD}, {ROOTS}, b2 AS (SELECT a AS x, b AS y FROM p UNION ALL SELECT b, a FROM p),
c(x, y) AS (SELECT x, y FROM b2 UNION SELECT c.x, b2.y FROM c JOIN b2 ON c.y = b2.x), l AS (SELECT x AS root, least(x, min(y)) AS label FROM c GROUP BY x),
z AS (SELECT r.row_id, coalesce(l.label, r.root) AS class_id FROM r LEFT JOIN l USING (root))
SELECT d.source, count(*) AS n_docs, count(DISTINCT z.class_id) AS n_classes FROM z JOIN corpus_doc d USING (row_id) GROUP BY d.source""")
def near_dup_summary(spark, sf):
    rows = similarity.near_duplicates(corpus(spark, sf), "row_id").join(corpus(spark, sf).select("row_id", "source"), "row_id")
    return rows.groupBy("source").agg(F.count("*").alias("n_docs"), F.count_distinct("class_id").alias("n_classes"))


@query()
def minhash_candidates(spark, sf):
    return similarity.minhash_candidates(corpus(spark, sf), "row_id")


CONTAIN = f"""e AS MATERIALIZED (SELECT row_id, len(s) AS n, unnest(s) AS g FROM {SHINGLES} WHERE len(s) > 0)"""


@query(f"""WITH {CONTAIN}, m AS (SELECT e.*, d.author, d.title FROM e JOIN corpus_doc d USING (row_id)),
q AS (SELECT x.row_id, y.row_id AS container, x.n AS n_small, count(*) AS common FROM m x JOIN m y ON x.g = y.g AND coalesce(x.author, '?') = coalesce(y.author, '?')
  WHERE x.n < 3000 AND y.n >= 3000 AND x.title IS DISTINCT FROM y.title GROUP BY ALL HAVING count(*) > 0.8 * x.n),
b AS (SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY common DESC, container) AS k FROM q)
SELECT row_id, container, CAST(common AS BIGINT) AS common, CAST(n_small AS BIGINT) AS n_small, CASE WHEN common > 0.95 * n_small THEN 'drop' ELSE 'partial' END AS verdict FROM b WHERE k = 1""")
def contained_docs(spark, sf):
    return similarity.contained(corpus(spark, sf), "row_id", "author", "title")


def reprints(spark, sf) -> DataFrame:
    """The corpus and a reprint of every row with three words more, under another key and shard: rows that are near each other."""
    c = corpus(spark, sf)
    return c.unionByName(c.withColumns({"row_id": -1 - F.col("row_id"), "shard": F.lit("dlib-ponatis"), "text": F.concat("text", F.lit(" natis drugi popravljen"))}))


REPRINTS = "SELECT row_id, shard, author, title, text, source FROM corpus_doc UNION ALL SELECT -1 - row_id, 'dlib-ponatis', author, title, text || ' natis drugi popravljen', source FROM corpus_doc"
_ON_REPRINTS = lambda sql: f"rp AS MATERIALIZED ({REPRINTS}), " + sql.replace("corpus_doc", "rp")


@query(f"WITH {_ON_REPRINTS(JACCARD)} SELECT a, b, CAST(common AS BIGINT) AS common, CAST(n_a AS BIGINT) AS n_a, CAST(n_b AS BIGINT) AS n_b FROM p")
def reprint_pairs(spark, sf):
    s = similarity.similar_pairs(reprints(spark, sf), "row_id")
    return s.select("a", "b", *(F.col(c).cast("bigint").alias(c) for c in ("common", "n_a", "n_b")))


@query(f"""WITH RECURSIVE {_ON_REPRINTS(JACCARD)}, {ROOTS.replace("corpus_doc", "rp")}, b2 AS (SELECT a AS x, b AS y FROM p UNION ALL SELECT b, a FROM p),
c(x, y) AS (SELECT x, y FROM b2 UNION SELECT c.x, b2.y FROM c JOIN b2 ON c.y = b2.x),
l AS (SELECT x AS root, least(x, min(y)) AS label FROM c GROUP BY x), k AS (SELECT x AS root, count(*) AS n FROM b2 GROUP BY x)
SELECT r.row_id, coalesce(l.label, r.root) AS class_id, coalesce(k.n, 0) AS n_links FROM r LEFT JOIN l USING (root) LEFT JOIN k USING (root)""")
def reprint_duplicates(spark, sf):
    return similarity.near_duplicates(reprints(spark, sf), "row_id")


#: Keep-first, node by node in the order of keys: a list of what is kept so far goes along.
KEEP_FIRST = """o AS (SELECT node, row_number() OVER (ORDER BY node) AS k FROM (SELECT a AS node FROM p UNION SELECT b FROM p)),
before AS MATERIALIZED (SELECT o.k, o.node, list(p.a) FILTER (WHERE p.a IS NOT NULL) AS earlier FROM o LEFT JOIN p ON p.b = o.node GROUP BY ALL),
run(k, kept, near) AS (SELECT 0::BIGINT, []::BIGINT[], NULL::BIGINT UNION ALL
  SELECT k, CASE WHEN near IS NULL THEN list_append(kept, node) ELSE kept END, near FROM (SELECT b.k, b.node, run.kept, list_min(list_intersect(coalesce(b.earlier, []), run.kept)) AS near FROM run JOIN before b ON b.k = run.k + 1))"""


@query(f"""WITH RECURSIVE {_ON_REPRINTS(JACCARD)}, {ROOTS.replace("corpus_doc", "rp")}, {KEEP_FIRST}
SELECT r.row_id, run.near IS NULL AND r.row_id = r.root AS kept, coalesce(run.near, r.root) AS root FROM r LEFT JOIN o ON o.node = r.root LEFT JOIN run ON run.k = o.k""")
def reprint_keep_first(spark, sf):
    return similarity.near_duplicate_roots(reprints(spark, sf), "row_id")


def _merge_sql(rows: str) -> str:
    """The merge of ``rows``, one document after the other: a list of what is kept goes along."""
    on = lambda sql: sql.replace("corpus_doc", "src")
    return f"""WITH RECURSIVE src AS MATERIALIZED ({rows}),
d AS (SELECT s.row_id, s.shard, s.author, s.title, s.text, {TIER} AS tier, CASE WHEN shard <> 'wikipedia' THEN w.work_id END AS work,
  CASE WHEN list_contains(r.flags, '{merge.NOT_BY_AUTHOR}') THEN 'not_by_author' WHEN s.shard <> 'wikipedia' AND v.verdict <> 'kept' THEN 'gate_' || v.verdict END AS refused
  FROM src s LEFT JOIN {on(LOOKUP)} w USING (row_id) LEFT JOIN work_registry r ON r.work_id = w.work_id LEFT JOIN (SELECT row_id, {VERDICT} AS verdict FROM {on(GATE)}) v USING (row_id)),
live AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY tier, shard, row_id) AS k FROM d WHERE refused IS NULL),
e AS MATERIALIZED (SELECT live.k, live.work, len(s) AS n, unnest(s) AS g FROM live JOIN {on(SHINGLES)} USING (row_id)),
m AS MATERIALIZED (SELECT x.k, y.k AS j, x.n, y.n AS m, count(*) AS common, x.work = y.work AS mates FROM e x JOIN e y USING (g) WHERE y.k < x.k GROUP BY ALL),
near AS (SELECT k, list(j) AS js FROM m WHERE common >= 0.8 * (n + m - common) - 1e-9 GROUP BY k),
ident AS (SELECT k, list(j) AS js FROM m WHERE mates AND common >= 0.5 * least(n, m) GROUP BY k),
copies AS (SELECT x.k, list(y.k) AS js FROM live x JOIN live y ON x.text = y.text AND y.k < x.k GROUP BY x.k),
mates AS (SELECT x.k, list(y.k) AS js FROM live x JOIN live y ON x.work = y.work AND y.k < x.k GROUP BY x.k),
seq AS MATERIALIZED (SELECT live.k, coalesce(c.js, []) AS c, coalesce(w.js, []) AS w, coalesce(i.js, []) AS i, coalesce(n.js, []) AS n FROM live LEFT JOIN copies c USING (k) LEFT JOIN mates w USING (k) LEFT JOIN ident i USING (k) LEFT JOIN near n USING (k)),
run(k, kept, reason, root) AS (SELECT 0::BIGINT, []::BIGINT[], NULL::VARCHAR, NULL::BIGINT UNION ALL
  SELECT k, CASE WHEN c IS NULL AND w IS NULL AND n IS NULL THEN list_append(kept, k) ELSE kept END, CASE WHEN c IS NOT NULL THEN 'exact_dup' WHEN w IS NOT NULL THEN 'registry_identity' WHEN n IS NOT NULL THEN 'near_dup' END, coalesce(c, w, n)
  FROM (SELECT seq.k, run.kept, list_min(list_intersect(seq.c, run.kept)) AS c, CASE WHEN list_contains(seq.i, list_max(list_intersect(seq.w, run.kept))) THEN list_max(list_intersect(seq.w, run.kept)) END AS w, list_min(list_intersect(seq.n, run.kept)) AS n FROM run JOIN seq ON seq.k = run.k + 1)),
done AS (SELECT live.row_id, run.reason, r.row_id AS root FROM live JOIN run USING (k) LEFT JOIN live r ON r.k = run.root UNION ALL SELECT row_id, refused, NULL FROM d WHERE refused IS NOT NULL)"""


@query(_merge_sql("SELECT row_id, shard, author, title, text FROM corpus_doc") + " SELECT row_id, reason, root FROM done")
def merge_decisions(spark, sf):
    return merge.merged(corpus(spark, sf), _table(spark, sf, "work_registry")).select("row_id", "reason", "root")


@query(_merge_sql("SELECT row_id, shard, author, title, text FROM corpus_doc") + " SELECT coalesce(reason, 'kept') AS reason, count(*) AS n FROM done GROUP BY 1")
def merge_drop_counts(spark, sf):
    done = merge.merged(corpus(spark, sf), _table(spark, sf, "work_registry"))
    return done.groupBy(F.coalesce("reason", F.lit("kept")).alias("reason")).agg(F.count("*").alias("n"))


@query(_merge_sql(f"SELECT * FROM ({REPRINTS})") + " SELECT row_id, reason, root FROM done")
def merge_reprints(spark, sf):
    return merge.merged(reprints(spark, sf), _table(spark, sf, "work_registry")).select("row_id", "reason", "root")


@query()
def merge_reattributed(spark, sf):
    c, w = corpus(spark, sf), _table(spark, sf, "work_registry")
    # Titles of several authors: what was dropped under another author's name goes to the first of them.
    named = works.title_collisions(w).select(F.col("norm").alias("title"), F.lit("same_work").alias("resolution"), F.split("authors", "; ")[0].alias("attribution"))
    return merge.reattributed(c, merge.merged(c, w, named), named)


@query(f"""SELECT DISTINCT w.work_id FROM work_registry w WHERE list_contains(w.flags, '{merge.NOT_BY_AUTHOR}') AND w.work_id NOT IN (SELECT work_id FROM {LOOKUP} WHERE work_id IS NOT NULL)""")
def merge_never_fired(spark, sf):
    return merge.never_fired(_table(spark, sf, "work_registry"), corpus(spark, sf))


def volumes(spark, sf) -> DataFrame:
    """Rows of the corpus and volumes put together of up to 300 of an author's rows each."""
    c = corpus(spark, sf).select("row_id", "author", "title", "text")
    parts = c.where("author is not null and text is not null").groupBy("author", F.floor(F.col("row_id") / 300).alias("v"))
    joined = parts.agg(F.min("row_id").alias("first"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("row_id", "text"))), lambda x: x["text"]), "\n").alias("text"))
    return c.unionByName(joined.select((-1 - F.col("first")).alias("row_id"), "author", F.lit("Zbrano delo").alias("title"), "text"))


VOLUMES = "SELECT row_id, author, title, text FROM corpus_doc UNION ALL SELECT -1 - min(row_id), author, 'Zbrano delo', string_agg(text, chr(10) ORDER BY row_id) FROM corpus_doc WHERE author IS NOT NULL AND text IS NOT NULL GROUP BY author, CAST(floor(row_id / 300) AS BIGINT)"


#: States contained_in_volumes, but cuts long texts into shingles in quadratic time: for small tables only.
CONTAINED_SQL = f"""WITH vol AS MATERIALIZED ({VOLUMES}), {CONTAIN.replace("corpus_doc", "vol")}, m AS (SELECT e.*, d.author, d.title FROM e JOIN vol d USING (row_id)),
q AS (SELECT x.row_id, y.row_id AS container, x.n AS n_small, count(*) AS common FROM m x JOIN m y ON x.g = y.g AND coalesce(x.author, '?') = coalesce(y.author, '?')
  WHERE x.n < 3000 AND y.n >= 3000 AND x.title IS DISTINCT FROM y.title GROUP BY ALL HAVING count(*) > 0.8 * x.n),
b AS (SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY common DESC, container) AS k FROM q)
SELECT row_id, container, CAST(common AS BIGINT) AS common, CAST(n_small AS BIGINT) AS n_small, CASE WHEN common > 0.95 * n_small THEN 'drop' ELSE 'partial' END AS verdict FROM b WHERE k = 1"""


@query()
def contained_in_volumes(spark, sf):
    return similarity.contained(volumes(spark, sf), "row_id", "author", "title")


# Held-out sets.


@query(f"SELECT row_id FROM corpus_doc WHERE {SOURCE} = 'wikivir' AND length(text) BETWEEN 3000 AND 45000")
def holdout_candidates(spark, sf):
    return holdout.candidates(corpus(spark, sf)).select("row_id")


@query(f"""WITH {CONTAIN}, k AS (SELECT row_id FROM corpus_doc WHERE {SOURCE} = 'wikivir' AND length(text) BETWEEN 3000 AND 45000),
q AS (SELECT x.row_id, y.row_id AS other, x.n, count(*) AS common FROM e x JOIN k USING (row_id) JOIN e y ON x.g = y.g AND x.row_id <> y.row_id GROUP BY ALL HAVING count(*) >= 0.5 * x.n)
SELECT row_id, CAST(n AS BIGINT) AS n_small, CAST(common AS BIGINT) AS common, other FROM (SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY common DESC, other) AS r FROM q) WHERE r = 1""")
def holdout_forward_closure(spark, sf):
    c = corpus(spark, sf)
    return holdout.forward_closure(holdout.candidates(c), c, "row_id").select("row_id", "n_small", "common", "other")


_HS = f"(SELECT item_id, CASE WHEN len(w) >= 5 THEN list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))) ELSE [array_to_string(w, ' ')] END AS s FROM (SELECT item_id, {TOKENS} AS w FROM holdout_work))"


@query(f"""WITH {CONTAIN}, h AS (SELECT item_id, unnest(s) AS g FROM {_HS})
SELECT e.row_id, h.item_id, count(*) AS common, CAST(e.n AS BIGINT) AS n_small FROM e JOIN h USING (g) GROUP BY e.row_id, h.item_id, e.n HAVING count(*) >= 0.5 * e.n""")
def holdout_reverse_closure(spark, sf):
    return holdout.reverse_closure(corpus(spark, sf), _table(spark, sf, "holdout_work"), "row_id", "item_id")


@query(f"""WITH d AS (SELECT row_id, len({WORDS}) AS size, sha256(CAST(row_id AS VARCHAR)) AS sha FROM corpus_doc WHERE {SOURCE} = 'wikivir'),
r AS (SELECT *, coalesce(sum(size) OVER (ORDER BY sha, row_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before, row_number() OVER (ORDER BY sha, row_id) AS k FROM d)
SELECT row_id, size, sha, CAST(before AS BIGINT) AS before FROM r WHERE before < 5000 OR k <= 8""")
def holdout_select(spark, sf):
    docs = corpus(spark, sf).where(T.source_name("source") == "wikivir").withColumn("size", T.n_words(F.coalesce("text", F.lit(""))))
    return holdout.budget_fill(docs, "row_id", "row_id", "size", 5000)


@query("SELECT row_id FROM corpus_doc WHERE url IS NULL OR url NOT IN (SELECT url FROM holdout_work WHERE url IS NOT NULL UNION SELECT unnest(also_exclude_urls) FROM holdout_manifest)")
def training_rows(spark, sf):
    return holdout.training_rows(corpus(spark, sf), _table(spark, sf, "holdout_work"), _table(spark, sf, "holdout_manifest")).select("row_id")


@query(f"""WITH h AS (SELECT sum(len({WORDS})) AS held FROM holdout_work), t AS (SELECT sum(len({WORDS})) AS slice, count(*) AS n_slice FROM corpus_doc WHERE author = '{MAIN_AUTHOR}')
SELECT (SELECT count(*) FROM holdout_work) AS n_works, CAST(held AS BIGINT) AS held, n_slice, CAST(slice AS BIGINT) AS slice, CAST(floor(held / slice * 1e6) AS BIGINT) AS millionths FROM h, t""")
def holdout_totals(spark, sf):
    return holdout.totals(_table(spark, sf, "holdout_work").withColumn("size", T.n_words("text")), corpus(spark, sf).where(F.col("author") == MAIN_AUTHOR).withColumn("size", T.n_words("text")), "size")


@query(f"""SELECT c.row_id FROM corpus_doc c LEFT JOIN {LOOKUP} w USING (row_id) LEFT JOIN work_registry r ON r.work_id = w.work_id WHERE c.author = '{MAIN_AUTHOR}' AND NOT coalesce(list_contains(r.flags, '{merge.NOT_BY_AUTHOR}'), false)""")
def author_slice(spark, sf):
    return holdout.author_slice(corpus(spark, sf), _table(spark, sf, "work_registry"), MAIN_AUTHOR, "row_id", strict=False).select("row_id")


@query("""SELECT DISTINCT title FROM corpus_doc WHERE title NOT IN (SELECT name FROM author_cfg) AND title NOT IN (SELECT index_page FROM author_cfg WHERE index_page IS NOT NULL) AND NOT regexp_matches(title, '^(Abecedni )?[Ss]eznam ')""")
def listed_pages(spark, sf):
    return cleaning.listed(corpus(spark, sf), _table(spark, sf, "author_cfg"))


@query("""SELECT CASE WHEN i > 0 THEN 'ingested' WHEN n > 0 THEN 'known' ELSE 'missing' END AS status, count(*) AS n FROM (SELECT len(sources) AS n, len(list_filter(sources, lambda s: s.status = 'ingested')) AS i FROM work_registry) GROUP BY 1""")
def coverage_histogram(spark, sf):
    return works.coverage_histogram(_table(spark, sf, "work_registry"))


@query("""SELECT work_id, array_to_string(list_sort(list_distinct(list_filter(list_concat(coalesce(aliases, []), [title || ' (ponatis)']), lambda x: x <> title))), '; ') AS aliases FROM work_registry""")
def registry_aliases(spark, sf):
    w = _table(spark, sf, "work_registry")
    new = w.select("work_id", "title", "author", F.lit(None).cast("int").alias("year"), F.lit(None).cast("string").alias("genre"), F.array().cast("array<string>").alias("flags"), F.array("title", F.concat("title", F.lit(" (ponatis)"))).alias("aliases"), F.array().cast(w.schema["sources"].dataType).alias("sources"), "notes")
    return works.upsert(w, new).select("work_id", F.array_join("aliases", "; ").alias("aliases"))


@query("SELECT w.item_id, count(d.url) AS n_rows, count(*) FILTER (WHERE sha256(d.text) = w.content_sha256) AS n_same FROM holdout_work w LEFT JOIN corpus_doc d USING (url) GROUP BY w.item_id")
def holdout_verified(spark, sf):
    return holdout.verified(corpus(spark, sf), _table(spark, sf, "holdout_work"))


@query(f"""WITH d AS (SELECT row_id, list_concat([-7], list_transform({WORDS}, lambda x: CAST(length(x) AS INTEGER))) AS s FROM corpus_doc)
SELECT row_id, CAST(i / 64 AS INTEGER) AS w, CAST(list_sum(s[i+1:i+64]) AS BIGINT) AS sum_x, least(64, len(s) - i - 1) AS n_targets FROM (SELECT row_id, s, unnest(range(0, len(s) - 1, 64)) AS i FROM d)""")
def eval_windows(spark, sf):
    ids = F.transform(T.words(F.coalesce("text", F.lit(""))), F.length)
    rows = corpus(spark, sf).select("row_id", F.posexplode(holdout.windows(ids, 64, -7)).alias("w", "b"))
    total = F.aggregate("b.x", F.lit(0).cast("bigint"), lambda a, x: a + x)
    return rows.select("row_id", "w", total.alias("sum_x"), F.size(F.filter("b.y", lambda y: y != -1)).cast("bigint").alias("n_targets"))


@query("SELECT CAST(sum(CASE WHEN l > 0 THEN l % 7 ELSE 0 END) AS DOUBLE) AS nats, CAST(sum(l) AS BIGINT) AS bytes, CAST(floor(sum(CASE WHEN l > 0 THEN l % 7 ELSE 0 END) / (ln(2) * sum(l)) * 1e9) AS BIGINT) AS bpb_e9 FROM (SELECT octet_length(encode(coalesce(text, ''))) AS l FROM corpus_doc)")
def bpb_synthetic(spark, sf):
    rows = corpus(spark, sf).select(F.octet_length(F.coalesce("text", F.lit(""))).cast("bigint").alias("l")).select("l", (F.col("l") % 7).cast("double").alias("loss"))
    b = holdout.bits_per_byte(rows, "loss", "l")
    return b.select("nats", "bytes", F.floor(F.col("bpb") * 1e9).cast("bigint").alias("bpb_e9"))


# Cleaning.


_GOOD = f"regexp_replace({STRIP('x')}, " + _n(rf"[^\p{{L}}{SP}.,;:!?\-\"'()„“”«»*…]") + ", '', 'g')"
SCAN_SQL = f"""WITH l AS (SELECT row_id, list_transform(string_split(regexp_replace(regexp_replace(replace(replace(nfc_normalize(coalesce(text, '')), chr(13) || chr(10), chr(10)), chr(65533), ''),
    '([\\p{{L}}\\p{{N}}_])[-¬]\\n([\\p{{L}}\\p{{N}}_])', '\\1\\2', 'g'), {_n(rf'\\[{SP}]+')}, ' ', 'g'), chr(10)), lambda x: regexp_replace({STRIP('x')}, '[ \\t]+', ' ', 'g')) AS ls FROM corpus_doc),
k AS (SELECT row_id, ls, list_filter(ls, lambda x, i: NOT (x <> '' AND (regexp_matches(x, '^[^\\p{{L}}\\p{{N}}]*[0-9]{{1,4}}[^\\p{{L}}\\p{{N}}]*$') OR regexp_matches(x, '^(?:Spisala?|Napisala?)(?:[^\\p{{L}}\\p{{N}}_].{{0,59}})?$')
    OR regexp_matches(x, '^\\\\+$') OR i <= 10 AND regexp_matches(x, '^(?:Štev\\.|V Ljubljani,? dne|Leposloven)|(?:^|[^\\p{{L}}\\p{{N}}_])Leto [IVX]+\\.?$')
    OR i <= 30 AND length(x) <= 2 AND NOT regexp_matches(x, '^[IVXLC]{{1,6}}\\.?$') OR CASE WHEN length(x) = 0 THEN 1 ELSE length({_GOOD}) / length(x) END < 0.85))) AS ks FROM l),
c AS (SELECT row_id, len(ls) - len(ks) AS dropped, len(list_filter(ks, lambda x: x <> '')) AS kept, {STRIP("regexp_replace(array_to_string(ks, chr(10)), '\\n{3,}', chr(10) || chr(10), 'g')")} AS t FROM k),
v AS (SELECT *, length(t) AS n_chars, length(regexp_replace(t, {_n(rf'[^\p{{L}}{SP}]')}, '', 'g')) AS n_letters, length(regexp_replace(substr(t, 1, 1000), '[^<>^=~|%&$#]', '', 'g')) AS early_noise FROM c)
SELECT row_id, n_chars, n_letters, dropped AS dropped_lines, kept AS kept_lines, early_noise,
  CASE WHEN early_noise > 10 THEN 'noisy_opening' WHEN n_letters / greatest(1, n_chars) < 0.84 THEN 'few_letters' WHEN n_chars < 400 THEN 'short' END AS refused FROM v"""


@query(SCAN_SQL)
def scan_clean(spark, sf):
    c = cleaning.scanned(corpus(spark, sf), "row_id").drop("text")
    return c.select("row_id", *(F.col(x).cast("bigint").alias(x) for x in c.columns if x not in ("row_id", "refused")), "refused")


@query()
def wiki_clean(spark, sf):
    return spread(corpus(spark, sf).select("row_id", "text")).select("row_id", cleaning.clean_wikitext(cleaning.preclean(F.coalesce("text", F.lit("")))).alias("text"))


@query()
def page_skip_counts(spark, sf):
    c = corpus(spark, sf)
    reason = cleaning.skip_reason(F.coalesce("title", F.lit("")), F.coalesce("text", F.lit("")), F.when(T.source_name("source") == "wikipedia", "0").otherwise("4"), F.lit(False))
    return c.groupBy(F.coalesce(reason, F.lit("kept")).alias("reason")).agg(F.count("*").alias("n"))


def _wiki_sql(text: str) -> str:
    """Plain text of wiki markup, step by step as the operator's documentation says."""
    steps = [
        (r"(?is)<ref[^>/]*(?:/>|>.*?</ref>)", ""), *[(r"\{\{[^{}]*\}\}", "")] * 4, (r"\[\[(?:[^\[\]|]*\|)*([^\[\]|]*)\]\]", r"\1"), (r"\[https?://[^\]\s]+ ([^\]]*)\]", r"\1"), (r"'{2,3}", ""), (r"(?i)</?[a-z][^<>]*>", ""),
        (r"__[A-Z]+__", ""), (r"(?m)^=+[ \t]*([^=\n]+?)[ \t]*=+[ \t]*$", r"\1"), (r"(?m)^(?:Kategorija|Category):[^\n]*$", ""), (r"(?m)^\^[^\n]*$", ""), (r"[ \t]+\n", "\n"), (r"\n{3,}", "\n\n"),
    ]
    out = f"nfc_normalize({text})"
    for pattern, to in steps:
        out = f"regexp_replace({out}, {_n(pattern)}, {_n(to)}, 'g')"
    return STRIP(out)


CRAWL_SQL = f"""WITH c AS (SELECT row_id, author, coalesce(title, '') AS title, coalesce(text, '') AS raw, {_wiki_sql("coalesce(text, '')")} AS text FROM corpus_doc WHERE {SOURCE} = 'wikivir'),
n AS (SELECT *, nullif({STRIP("regexp_extract(title, '\\(([^)]+)\\)[ \\t\\n]*$', 1)")}, '') AS named, {LINES} AS l FROM c),
j AS (SELECT *, list_filter(l, lambda x: length(x) < 60 AND NOT regexp_matches(x, '[.!?«“"]$') AND NOT regexp_matches(x, '[,;:!?.]')) AS t, list_filter(l, lambda x: regexp_matches(x, '\\p{{Nd}}')) AS d FROM n)
SELECT CASE WHEN regexp_matches(raw, '(?i)^\\s*#(redirect|preusmeritev)') THEN 'redirect'
  WHEN named IN (SELECT name FROM author_cfg) AND named IS DISTINCT FROM author THEN 'other_author' WHEN length(text) < 400 THEN 'stub'
  WHEN len(l) >= 10 AND (len(t) / len(l) > 0.65 OR (len(d) / len(l) > 0.10 AND len(t) / len(l) > 0.30)) THEN 'index_list' ELSE 'kept' END AS reason, count(*) AS n FROM j GROUP BY 1"""


@query(CRAWL_SQL)
def crawl_skip_counts(spark, sf):
    c = corpus(spark, sf).where(T.source_name("source") == "wikivir")
    # Each row leaves out its own author (J15); the roster is joined by the name a title closes with.
    named = c.select("author", "text", F.coalesce("title", F.lit("")).alias("title")).withColumn("name", T.attributed_to("title"))
    roster = _table(spark, sf, "author_cfg").select("name").distinct().withColumn("other", F.lit(True))
    rows = named.join(roster, "name", "left").withColumn("other", F.coalesce(F.col("other") & ~F.col("name").eqNullSafe(F.col("author")), F.lit(False)))
    reason = cleaning.crawl_skip_reason(F.coalesce("text", F.lit("")), F.col("other"))
    return rows.groupBy(F.coalesce(reason, F.lit("kept")).alias("reason")).agg(F.count("*").alias("n"))


_ENTRY = r"^\*+[ \t]*\[\[(?:[^\]|]*\|)?([^\]]+)\]\](.*)$"
CATALOG_SQL = rf"""WITH src AS ({{rows}}), l AS (SELECT row_id, unnest(range(0, len(ls))) AS pos, unnest(ls) AS line FROM (SELECT row_id, string_split(text, chr(10)) AS ls FROM src)),
h AS (SELECT *, nullif(regexp_extract(line, '^=+[ \t]*([^=]+?)[ \t]*=+[ \t]*$', 1), '') AS h FROM l),
r AS (SELECT *, last_value(CASE WHEN h IS NULL THEN NULL WHEN lower(h) IN ('viri', 'glej tudi', 'zunanje povezave') THEN '' ELSE h END IGNORE NULLS) OVER (PARTITION BY row_id ORDER BY pos) AS s FROM h),
t AS (SELECT *, regexp_extract(line, {_n(_ENTRY)}, 1) AS title, regexp_extract(line, {_n(_ENTRY)}, 2) AS tail FROM r)
SELECT row_id, CAST(pos AS INTEGER) AS pos, trim(title) AS title, TRY_CAST(nullif(regexp_extract(tail, '(1[5-9][0-9][0-9]|20[0-9][0-9])', 1), '') AS INTEGER) AS year, nullif(s, '') AS genre,
  nullif(trim(regexp_extract(tail, 'gl\.[ \t]*\[\[(?:[^\]|]*\|)?([^\]]+)\]\]', 1)), '') AS alias_of, contains(tail, '(prevod)') OR ends_with(trim(title), '(prevod)') AS translation FROM t WHERE title <> ''"""
_PAGES = "SELECT row_id, '== ' || coalesce(source, '?') || ' ==' || chr(10) || '* [[' || coalesce(title, '?') || ']], 18' || CAST(10 + row_id % 90 AS VARCHAR) || CASE WHEN row_id % 5 = 0 THEN ' (prevod)' ELSE '' END || chr(10) || '* [[Stran|' || coalesce(author, '?') || ']] gl. [[' || coalesce(title, '?') || ']]' || chr(10) || coalesce(text, '') AS text FROM corpus_doc"


@query(CATALOG_SQL.format(rows=_PAGES))
def catalog_entries(spark, sf):
    """A catalog page of each row: a section of its source with its title, its author as an alias, and its text."""
    part = lambda c: F.coalesce(c, F.lit("?"))
    page = F.concat(
        F.lit("== "), part("source"), F.lit(" ==\n* [["), part("title"), F.lit("]], 18"), (10 + F.col("row_id") % 90).cast("string"), F.when(F.col("row_id") % 5 == 0, " (prevod)").otherwise(""),
        F.lit("\n* [[Stran|"), part("author"), F.lit("]] gl. [["), part("title"), F.lit("]]\n"), F.coalesce("text", F.lit("")),
    )
    return works.catalog_entries(corpus(spark, sf).select("row_id", page.alias("text")), "row_id")


@query("SELECT DISTINCT urn FROM (SELECT unnest(regexp_extract_all(url, '(URN:[A-Z]+(?::[A-Z]+)*-[0-9A-Z]+)', 1)) AS urn FROM corpus_doc) WHERE contains(urn, ':DOC-')")
def record_ids(spark, sf):
    return files.record_ids(corpus(spark, sf), "url")


# Pieces.


@query("SELECT row_id, CAST(len(regexp_extract_all(coalesce(text, ''), '(?s).*?[.!?…]+[ \\t\\n\\r]+|.+$')) AS BIGINT) AS n, length(coalesce(text, '')) AS n_chars FROM corpus_doc")
def sentence_counts(spark, sf):
    pieces = T.sentences(F.coalesce("text", F.lit("")))
    return corpus(spark, sf).select("row_id", F.size(pieces).cast("bigint").alias("n"), F.length(F.array_join(pieces, "")).cast("bigint").alias("n_chars"))


@query()
def pretoken_counts(spark, sf):
    words = corpus(spark, sf).select(F.explode(T.pretokens(F.coalesce("text", F.lit("")))).alias("pretoken"))
    return words.groupBy("pretoken").agg(F.count("*").alias("n"))


@query()
def chunk_ladder(spark, sf):
    return chunks.chunked(corpus(spark, sf), "row_id").drop("text")


@query()
def chunk_ladder_use(spark, sf):
    c = corpus(spark, sf)
    return chunks.ladder_use(chunks.chunked(c, "row_id"), c, "row_id", "source")


@query()
def chunk_lengths(spark, sf):
    """Distribution of chunk sizes."""
    c = chunks.chunked(corpus(spark, sf), "row_id").select(F.lit("all").alias("g"), "n_tokens")
    counts = c.groupBy("g").agg(F.count("*").alias("n_chunks"), F.sum("n_tokens").alias("n_tokens"), F.max("n_tokens").alias("most"), F.count_if(F.col("n_tokens") == P.TOKEN_BUDGET).alias("at_budget"), F.count_if(F.col("n_tokens") < 64).alias("under_64"))
    return counts.join(documents.exact_percentile(c, "g", "n_tokens", 0.5, "p50"), "g").join(documents.exact_percentile(c, "g", "n_tokens", 0.95, "p95"), "g").drop("g")


@query()
def bestfit_crop(spark, sf):
    order = ["url", "chunk_index", "chunk_id"]
    return chunks.simulated_crop(chunks.measured(_table(spark, sf, "chunk_doc"), *order), order)


@query(f"""WITH RECURSIVE l AS MATERIALIZED (SELECT row_id, i, len(regexp_extract_all(x, {_n(f'[^{SP}]+')})) AS n FROM (SELECT row_id, unnest(range(0, len(ls))) AS i, unnest(ls) AS x FROM (SELECT row_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM corpus_doc))),
w(row_id, i, chunk, total, n) AS (SELECT row_id, 0::BIGINT, 0, CAST(n AS BIGINT), CAST(n AS BIGINT) FROM l WHERE i = 0 UNION ALL
  SELECT w.row_id, l.i, CASE WHEN w.total + l.n > 200 THEN w.chunk + 1 ELSE w.chunk END, CASE WHEN w.total + l.n > 200 THEN l.n ELSE w.total + l.n END, CAST(l.n AS BIGINT) FROM w JOIN l ON l.row_id = w.row_id AND l.i = w.i + 1)
SELECT row_id, chunk, count(*) AS n_lines, CAST(sum(n) AS BIGINT) AS n_words FROM w GROUP BY row_id, chunk""")
def word_budget_chunks(spark, sf):
    return chunks.word_chunks(corpus(spark, sf), "row_id")


@query()
def token_bytes(spark, sf):
    return chunks.vocabulary(spark)


@query("SELECT sha256(coalesce(text, '')) AS content_hash FROM corpus_doc GROUP BY ALL")
def first_copies(spark, sf):
    return dedup.first_copies(corpus(spark, sf), "loaded_at").select("content_hash")


@query()
def tokenizer_evaluation(spark, sf):
    folder = os.path.dirname(chunks.RANKS)
    paths = {n: f"{folder}/{n}.tiktoken" for n in ("byte_bpe_50k", "byte_bpe_multi_50k")}
    docs = corpus(spark, sf).withColumn("slice", T.slice_of("source", "author", MAIN_AUTHOR))
    return tokenization.fertility(tokenization.encoded_counts(docs, paths, "text", "slice"))


@query("SELECT row_id, nfc_normalize(text) <> text AS changes FROM corpus_doc WHERE text IS NOT NULL")
def nfc_violations(spark, sf):
    return corpus(spark, sf).where("text is not null").select("row_id", (~unicode.is_nfc("text")).alias("changes"))


@query()
def registry_seed(spark, sf):
    """Works found in the texts' own link lists, merged into the registry."""
    pages = corpus(spark, sf).select("row_id", "text", "author")
    return works.seed(_table(spark, sf, "work_registry"), works.catalog_entries(pages, "row_id"), pages.select("row_id", "author"), "row_id")


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)

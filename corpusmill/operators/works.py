"""Registry of known works: lookup, upkeep, checks and coverage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T


def title_index(works: DataFrame) -> DataFrame:
    """``author``, ``norm``, ``work_id``: titles before aliases, of equals the least id."""
    titles = works.select("author", T.normalized_title("title").alias("norm"), "work_id", F.lit(0).alias("rank"))
    aliases = works.select("author", "work_id", F.explode("aliases").alias("a")).select("author", T.normalized_title("a").alias("norm"), "work_id", F.lit(1).alias("rank"))
    both = titles.unionByName(aliases).where("norm <> '' and author is not null")
    return both.groupBy("author", "norm").agg(F.min_by("work_id", F.struct("rank", "work_id")).alias("work_id"))


def find_works(docs: DataFrame, works: DataFrame, key: str) -> DataFrame:
    """``key``, ``work_id`` of every document, null where none is known.

    The title is looked up without a closing bracket that names the author. The index is joined as it is;
    Spark broadcasts it if it is small.
    """
    wanted = docs.select(key, "author", T.title_without_author("title", "author").alias("norm"))
    return wanted.join(title_index(works), ["author", "norm"], "left").select(key, "work_id")


def find_by_segments(titles: DataFrame, works: DataFrame, key: str) -> DataFrame:
    """``key``, ``work_id``, ``probe``: the full title, else the first segment between ``:``, ``;``, ``|`` that is a work."""
    probes = F.concat(F.array("title"), F.split("title", r"[ \t\n]*[:;|][ \t\n]*"))
    out = titles.select(key, "author", F.posexplode(probes).alias("probe", "p")).withColumn("norm", T.normalized_title("p"))
    hits = out.join(title_index(works), ["author", "norm"]).groupBy(key).agg(F.min_by("work_id", "probe").alias("work_id"), F.min("probe").alias("probe"))
    return titles.select(key).join(hits, key, "left")


def title_collisions(works: DataFrame) -> DataFrame:
    """Normalized titles that several authors have (J11): ``norm``, ``n_authors``, ``authors``."""
    named = works.select(T.normalized_title("title").alias("norm"), "author").where("norm <> ''")
    return named.groupBy("norm").agg(F.count_distinct("author").alias("n_authors"), F.array_join(F.array_sort(F.collect_set("author")), "; ").alias("authors")).where("n_authors > 1")


def validate(works: DataFrame, years: tuple[int, int] = (1500, 2030)) -> DataFrame:
    """``problem``, ``work_id``: repeated titles of one author and years out of range."""
    norm = works.select("work_id", "author", "year", T.normalized_title("title").alias("norm"))
    repeated = norm.groupBy("author", "norm").agg(F.count("*").alias("c")).where("c > 1")
    same = norm.join(repeated, ["author", "norm"], "left_semi").select(F.lit("repeated_title").alias("problem"), "work_id")
    out = norm.where(~F.col("year").between(*years)).select(F.lit("year_out_of_range").alias("problem"), "work_id")
    return same.unionByName(out)


def upsert(works: DataFrame, new: DataFrame) -> DataFrame:
    """``works`` with ``new`` merged in by ``work_id``.

    Null years and genres are filled, never replaced; flags, aliases (other than the title) and sources are
    united, a source known by name and id keeps the status ``ingested``. Repeated rows of ``new`` are merged too.
    """
    sources = lambda rows: F.transform(
        F.array_distinct(F.transform(rows, lambda s: F.struct(s["source"].alias("source"), s["id"].alias("id")))),
        lambda k: F.aggregate(
            F.filter(rows, lambda s: (s["source"] == k["source"]) & (s["id"] == k["id"])),
            F.lit(None).cast("struct<source:string,id:string,status:string,year:int,note:string>"),
            lambda a, s: F.when(a.isNull() | (s["status"] == "ingested") & (a["status"] != "ingested"), s).otherwise(a),
        ),
    )
    both = works.withColumn("_r", F.lit(0)).unionByName(new.withColumn("_r", F.lit(1)), allowMissingColumns=True)
    first = lambda c: F.min_by(c, F.when(F.col(c).isNotNull(), F.col("_r"))).alias(c)
    merged = both.groupBy("work_id").agg(
        *(first(c) for c in ("title", "author", "year", "genre", "notes")),
        *(F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))).alias(c) for c in ("flags", "aliases")),
        F.flatten(F.array_sort(F.collect_list(F.struct("_r", "sources"))).getField("sources")).alias("sources"),
    )
    return merged.withColumn("sources", sources(F.col("sources"))).withColumn("aliases", F.filter("aliases", lambda x: x != F.col("title")))


def coverage(works: DataFrame) -> DataFrame:
    """``work_id``, number of sources and of ingested ones, and their names (A10)."""
    ingested = F.filter("sources", lambda s: s["status"] == "ingested")
    return works.select("work_id", F.coalesce(F.size("sources"), F.lit(0)).alias("n_sources"), F.size(ingested).alias("n_ingested"), F.array_join(F.array_sort(F.array_distinct(F.transform(ingested, lambda s: s["source"]))), "+").alias("ingested_from"))


def coverage_histogram(works: DataFrame) -> DataFrame:
    """``status``, ``n``: works ingested, known from some source only, and missing (A10)."""
    c = coverage(works)
    status = F.when(F.col("n_ingested") > 0, "ingested").when(F.col("n_sources") > 0, "known").otherwise("missing")
    return c.groupBy(status.alias("status")).agg(F.count("*").alias("n"))


def by_author(creators: Column, people: Column, title: Column, query: str) -> Column:
    """Layered authorship (R8): creators decide; else people, unless the title names another author or is a memorial."""
    wanted = query.lower()
    surname = wanted.split(",")[0].strip()
    attributed = F.regexp_extract(F.lower(title), "(?s)((?:napisal|spisal|zložil).*)", 1)
    return F.when(F.size(creators) > 0, F.exists(creators, lambda c: F.startswith(F.lower(c), F.lit(wanted)))).otherwise(
        F.exists(people, lambda p: F.contains(F.lower(p), F.lit(surname))) & ((attributed == "") | F.contains(attributed, F.lit(surname))) & ~title.rlike(r"(?i)^spominu(?![\p{L}])|(?<![\p{L}])v spomin(?![\p{L}])")
    )


def catalog_entries(pages: DataFrame, key: str, text: str = "text", not_works: tuple[str, ...] = ("viri", "glej tudi", "zunanje povezave")) -> DataFrame:
    """Entries of catalog pages (P38, W2): ``key``, ``pos``, ``title``, ``year``, ``genre``, ``alias_of``, ``translation``.

    The running section of a page is its last heading before the line; a heading that names no works ends it.
    """
    lines = pages.select(key, F.posexplode(F.split(text, "\n")).alias("pos", "line"))
    heading = F.nullif(F.regexp_extract("line", r"^=+[ \t]*([^=]+?)[ \t]*=+[ \t]*$", 1), F.lit(""))
    marked = F.when(heading.isNotNull(), F.when(F.lower(heading).isin(*not_works), F.lit("")).otherwise(heading))
    running = F.last("_h", ignorenulls=True).over(Window.partitionBy(key).orderBy("pos").rowsBetween(Window.unboundedPreceding, 0))
    title = F.regexp_extract("line", r"^\*+[ \t]*\[\[(?:[^\]|]*\|)?([^\]]+)\]\](.*)$", 1)
    tail = F.regexp_extract("line", r"^\*+[ \t]*\[\[(?:[^\]|]*\|)?([^\]]+)\]\](.*)$", 2)
    found = lines.withColumn("_h", marked).withColumn("_s", running).withColumn("title", title).withColumn("tail", tail).where("title <> ''")
    return found.select(
        key, "pos", F.trim("title").alias("title"), F.nullif(F.regexp_extract("tail", r"(1[5-9][0-9][0-9]|20[0-9][0-9])", 1), F.lit("")).cast("int").alias("year"), F.nullif("_s", F.lit("")).alias("genre"),
        F.nullif(F.trim(F.regexp_extract("tail", r"gl\.[ \t]*\[\[(?:[^\]|]*\|)?([^\]]+)\]\]", 1)), F.lit("")).alias("alias_of"), (F.contains("tail", F.lit("(prevod)")) | F.endswith(F.trim("title"), F.lit("(prevod)"))).alias("translation"),
    )


def seed(works: DataFrame, entries: DataFrame, pages: DataFrame, key: str) -> DataFrame:
    """``works`` with the ``entries`` of catalog ``pages`` merged in.

    An entry that names another title (``alias_of``) becomes an alias of it once all titles are there (J13);
    the others are works of the page's author. Entries of pages without an author are left out.
    """
    named = entries.join(pages, key).where("author is not null")
    empty = "array<struct<source:string,id:string,status:string,year:int,note:string>>"
    row = lambda title, aliases, flags: (
        F.concat(T.slug("author"), F.lit("-"), T.slug(title)).alias("work_id"), F.col(title).alias("title"), "author", "year", "genre", flags.alias("flags"), aliases.alias("aliases"), F.array().cast(empty).alias("sources"), F.lit("").alias("notes"),
    )
    none = F.array().cast("array<string>")
    titles = named.where("alias_of is null").select(*row("title", none, F.when(F.col("translation"), F.array(F.lit("prevod"))).otherwise(none)))
    aliases = named.where("alias_of is not null").withColumn("year", F.lit(None).cast("int")).select(*row("alias_of", F.array("title"), none))
    new = titles.unionByName(aliases)
    # Known titles keep their ids.
    known = title_index(works).select("author", "norm", F.col("work_id").alias("old"))
    new = new.withColumn("norm", T.normalized_title("title")).join(known, ["author", "norm"], "left").withColumn("work_id", F.coalesce("old", "work_id")).drop("norm", "old")
    return upsert(works, new)

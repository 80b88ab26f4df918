"""Line dedup by site-relative frequency, in DataFrame operations alone.

Lines are grouped by host. A line goes where the pages of its host that hold it, divided by all pages of that host,
exceed max_ratio, and at least min_pages of them hold it: by default two, without which all lines of a host of few pages
would go, as one page is then more than the ratio. Lines compare without the spaces around them; blank lines stay.

Each page hands on one row per different line (host, digest), summed before the shuffle, so a host or a line with a third
of all rows is a count, not a group. The lines of a host that go number at most (different lines on its average page) /
max_ratio, so they fit in one array per host, however many pages it has. These arrays join the pages by host: broadcast
where their counted size is under broadcast_lines, else shuffled, where adaptive execution splits a large host. A page meets
its host's array in a hashed intersection, and its lines are then looked up among its own that go.

Defined results: a null text has no lines and stays null, but its page counts; a null host is a host. Rows that share an
id, and rows that repeat, count as separate pages. An empty table gives an empty one. Columns of any name pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenantgraph.llm.shared import named, stash


def line_digest(line: Column) -> Column:
    return F.md5(F.trim(line))


def boilerplate(pages: DataFrame, max_ratio: float, min_pages: int) -> DataFrame:
    """pages (site, lines) to one row per site that has such lines: (site, digests)."""
    different = F.array_distinct(F.transform(F.filter("lines", lambda x: F.trim(x) != ""), line_digest))
    totals = pages.groupBy("site").agg(F.count(F.lit(1)).alias("pages"))
    counts = pages.select("site", F.explode(different).alias("digest")).groupBy("site", "digest").agg(F.count(F.lit(1)).alias("held")).where(F.col("held") >= min_pages)
    totals = totals.withColumnRenamed("site", "of")
    found = counts.join(totals, counts.site.eqNullSafe(totals.of)).where(F.col("held") > F.col("pages") * F.lit(float(max_ratio)))
    return found.groupBy("site").agg(F.sort_array(F.collect_list("digest")).alias("digests"))


def drop_boilerplate_lines(
    pages: DataFrame, *, site: Column, lines: Column, out: str = "lines", max_ratio: float = 0.1, min_pages: int = 2, broadcast_lines: int = 100_000
) -> DataFrame:
    """pages with a column `out`: the lines that stay, an array of strings, null where the lines are null."""
    found = stash(boilerplate(pages.select(site.alias("site"), lines.alias("lines")), max_ratio, min_pages), "lines-found")
    size = found.agg(F.coalesce(F.sum(F.size("digests")), F.lit(0)) + F.count(F.lit(1))).first()[0]
    found = found.select(F.struct("site", "digests").alias("__tg_found"))
    found = F.broadcast(found) if size <= broadcast_lines else found.hint("merge")
    joined = pages.withColumn("__tg_lines", lines).join(found, site.eqNullSafe(F.col("__tg_found.site")), "left")
    joined = joined.withColumn("__tg_gone", F.array_intersect(F.transform("__tg_lines", line_digest), "__tg_found.digests"))
    stays = F.filter("__tg_lines", lambda x: (F.trim(x) == "") | ~F.array_contains("__tg_gone", line_digest(x)))
    kept = F.when(F.coalesce(F.size("__tg_gone"), F.lit(0)) > 0, stays).otherwise(F.col("__tg_lines"))
    return joined.withColumn(out, kept).drop("__tg_lines", "__tg_found", "__tg_gone")


def drop_repeated_lines(docs: DataFrame, *, site_col: str = "source", text_col: str = "text", length_col: str | None = "n_chars", max_ratio: float = 0.1, min_pages: int = 2) -> DataFrame:
    """docs with such lines gone from their texts, and length_col set to the length that is left. No row goes."""
    columns = docs.columns
    kept = drop_boilerplate_lines(docs, site=named(site_col), lines=F.split(named(text_col), "\n", -1), out="__tg_kept", max_ratio=max_ratio, min_pages=min_pages)
    text = F.array_join("__tg_kept", "\n")
    new = {text_col: text.alias(text_col)} | ({length_col: F.length(text).cast("long").alias(length_col)} if length_col in columns else {})
    return kept.select(*[new.get(c, named(c)) for c in columns])

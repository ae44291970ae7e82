"""Line dedup by how often a line occurs on the pages of its site.

A line on more than a given share of its host's pages is boilerplate there, and
goes from all pages of that host.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ontime.llm.common import free_name, materialise
from ontime.llm.url_filter import host_of

# Ad and navigation lines stand on a tenth to a quarter of a site's pages in the tables
# at hand, prose on next to none.
RATIO = 0.1
# A line on a single page is no boilerplate, even if that is the host's only page.
MIN_PAGES = 2
# What is trimmed from a line: blanks, tabs, and the carriage return of a CRLF page.
BLANKS = " \t\r"

HIDDEN = r"(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->"
TAG = r"(?s)<[^>]*>"


def html_lines(html: Column) -> Column:
    """The visible lines of a page: tags and line ends separate them; blanks at
    either end and empty lines go. Null has none."""
    shown = F.regexp_replace(F.regexp_replace(F.coalesce(html, F.lit("")), HIDDEN, "\n"), TAG, "\n")
    lines = F.transform(F.split(shown, "\n"), lambda x: F.trim(x, F.lit(BLANKS)))
    return F.filter(lines, lambda x: x != "")


def drop_boilerplate(
    pages: DataFrame, url: str = "url", html: str = "html", ratio: float = RATIO, min_pages: int = MIN_PAGES
) -> DataFrame:
    """The rows of ``pages`` with host, n_lines, n_kept and text, the kept lines.

    A line is dropped if it stands on ``min_pages`` pages of the host or more and
    on more than ``ratio`` of them; once or often on a page is the same. An empty
    table gives no rows; a long page is an array of its lines in one row. Pages
    without a host (null or malformed URL) are a site of their own, the empty
    host. Repeated rows count as pages each. Columns of ``pages`` called like a
    new one make an error.

    Lines are counted by (host, line) with partial counts, so a hot host or line
    is a row per task. A host has at most ``mean lines per page / ratio`` such
    lines, whatever its number of pages, so they fit one array per host; pages
    join that array and are never taken apart.
    """
    clash = {"host", "n_lines", "n_kept", "text"} & {c.lower() for c in pages.columns}
    if clash:
        raise ValueError(f"there are columns {sorted(clash)} already")
    lines, common = free_name(pages, "lines"), free_name(pages, "common")
    split = pages.withColumns({"host": host_of(F.col(url)), lines: html_lines(F.col(html))})
    per_line = (
        split.select("host", F.explode(F.array_distinct(F.col(lines))).alias("line"))
        .groupBy("host", "line")
        .agg(F.count("*").alias("n"))
        .filter(F.col("n") >= min_pages)
    )
    totals = split.groupBy("host").agg(F.count("*").alias("pages"))
    frequent = per_line.join(totals, "host").filter(F.col("n") > F.col("pages") * ratio)
    by_host = materialise(frequent.groupBy("host").agg(F.collect_list("line").alias(common)), "boilerplate")
    joined = split.join(by_host, "host", "left")
    known = F.coalesce(F.col(common), F.array().cast("array<string>"))
    kept = F.filter(F.col(lines), lambda x: ~F.array_contains(known, x))
    return joined.withColumn(common, kept).select(
        *pages.columns,
        "host",
        F.size(lines).cast("long").alias("n_lines"),
        F.size(common).cast("long").alias("n_kept"),
        F.array_join(common, "\n").alias("text"),
    )

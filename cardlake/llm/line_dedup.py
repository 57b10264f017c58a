"""Boilerplate lines of web pages, by the share of a host's pages that have them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardlake.llm.common import saved

# Elements after which a line ends; the others are part of it.
BLOCKS = (
    "html|head|body|title|meta|link|nav|header|footer|main|article|section|aside|div|p|br|hr|"
    "h[1-6]|ul|ol|li|dl|dt|dd|table|thead|tbody|tr|td|th|blockquote|pre|form|figure"
)
HIDDEN = (
    r"(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->|<!doctype[^>]*>"
)
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"
ENTITIES = [("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"),
            ("&amp;", "&")]


def host_of(url: Column) -> Column:
    """The host in lower case, without user and port; empty where there is none or null."""
    found = F.regexp_extract(url, HOST, 1)
    return F.coalesce(F.lower(found), F.lit(""))


def lines_of(html: Column) -> Column:
    """The visible lines of a page: text between block elements, white space collapsed."""
    text = F.regexp_replace(F.coalesce(html, F.lit("")), HIDDEN, " ")
    text = F.regexp_replace(text, rf"(?i)</?(?:{BLOCKS})\b[^>]*>", "\n")
    text = F.regexp_replace(text, "<[^>]*>", "")
    for entity, character in ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(character))
    text = F.regexp_replace(text, r"[\x20\x09\x0B-\x0D]+", " ")
    return F.array_remove(F.transform(F.split(text, "\n", -1), lambda x: F.trim(x)), "")


def drop_boilerplate(
    pages: DataFrame, ratio: float = 0.3, min_pages: int = 2,
    page_id: str = "page_id", url: str = "url", html: str = "html",
) -> DataFrame:
    """One row per row of ``pages``: page_id, host, host_pages, n_lines, n_dropped, text.

    A line is boilerplate where more than ``ratio`` of its host's pages have it, and
    ``min_pages`` of them at least; every occurrence of it goes, in order the others
    stay. Null pages have no line and an empty text; pages without a host (null or
    malformed address) form one site with the empty name. Repeated rows count as
    pages of their own. An empty table gives an empty answer.

    Lines are counted once per page and summed in the map tasks, so a line of all
    pages is shuffled once per task; more than ``ratio`` of the pages have it, hence a
    host has at most (lines per page) / ratio boilerplate lines, kept as one array of
    digests. The join with the pages is one that Spark can split for a large host. The
    lines are kept between the two passes, as to find them costs more than to read them.
    """
    lined = saved(pages.select(
        F.col(page_id).alias("page_id"), host_of(F.col(url)).alias("host"),
        lines_of(F.col(html)).alias("lines")))
    digest = lambda line: F.unhex(F.md5(line))
    per_page = lined.select("host", F.explode(
        F.array_distinct(F.transform("lines", digest))).alias("line"))
    totals = lined.groupBy("host").agg(F.count("*").alias("host_pages"))
    counted = per_page.groupBy("host", "line").agg(F.count("*").alias("with_line"))
    boilerplate = (
        counted.filter(F.col("with_line") >= min_pages)
        .join(totals, "host")
        .filter(F.col("with_line") > ratio * F.col("host_pages"))
        .groupBy("host").agg(F.collect_set("line").alias("boilerplate")))
    # Kept: then both sides of the last join are plain shuffles, which Spark can split.
    sites = saved(totals.join(boilerplate, "host", "left"))
    known = F.coalesce("boilerplate", F.array().cast("array<binary>"))
    kept = F.filter("lines", lambda x: ~F.array_contains(F.col("known"), digest(x)))
    return (
        lined.join(sites, "host")
        .withColumn("known", known)
        .withColumn("kept", kept)
        .select(
            "page_id", "host", "host_pages", F.size("lines").alias("n_lines"),
            (F.size("lines") - F.size("kept")).alias("n_dropped"),
            F.array_join("kept", "\n").alias("text")))

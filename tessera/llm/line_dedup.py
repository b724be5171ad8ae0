"""Line dedup by site-relative frequency.

Pages are grouped by host; a line of a host is boilerplate if the share of the
host's pages that hold it exceeds ``ratio``.  Lines are compared without white
space around them, by a 64-bit hash and their length; a line counts once a page
and empty lines never count.  The counts are summed map-side, so a host or line
that a third of all pages share reaches its reducer as one row a task.

A host with fewer than ``min_pages`` pages that hold a line keeps that line:
the only page of a host is not boilerplate of itself.

With ``copies_once`` (the default) the share is taken over the distinct texts of
a host (by a 64-bit hash and the length), so copies of a page do not make its
own lines boilerplate; the found lines are dropped from all pages.  Without it
every row counts.

Defined results: null text stays null (no lines, but the nulls of a host are one
page of it); a null host counts as the host ``''``; repeated rows are one page in
the share and get the same result; a page that loses all lines
keeps an empty text; other columns ride along; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, stage

#: Half the rate of a line that one page in ten carries, so that such lines do not go or stay by chance.
RATIO = 0.05
MIN_PAGES = 3

BLANK = " \t\n\x0b\f\r"


def host_of(url: Column) -> Column:
    """Host of a URL in lower case, for tables that have URLs instead of sites."""
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]*)", 1))


def _lines(text: str) -> Column:
    return F.split(F.col(text), "\n", -1)


def _key(line: Column) -> Column:
    """What two lines share if they are the same; null for an empty line."""
    bare = F.btrim(line, F.lit(BLANK))
    return F.when(bare != "", F.struct(F.xxhash64(bare).alias("h"), F.length(bare).alias("n")))


def boilerplate_lines(pages: DataFrame, host: Column, text_col: str = "text",
                      ratio: float = RATIO, min_pages: int = MIN_PAGES, copies_once: bool = True) -> DataFrame:
    """``host``, ``line`` (hash and length), ``n_pages`` and ``host_pages`` of every boilerplate line."""
    site = F.coalesce(host.cast("string"), F.lit("")).alias("host")
    keys = F.array_distinct(F.transform(_lines(text_col), _key)).alias("keys")
    if copies_once:
        pages = (pages.select(site, F.xxhash64(text_col).alias("h"), F.length(text_col).alias("n"), keys)
                 .groupBy("host", "h", "n").agg(F.first("keys").alias("keys")))
    else:
        pages = pages.select(site, keys)
    totals = pages.groupBy("host").agg(F.count(F.lit(1)).alias("host_pages"))
    counts = (pages.select("host", F.explode("keys").alias("line"))
              .where(F.col("line").isNotNull())
              .groupBy("host", "line").agg(F.count(F.lit(1)).alias("n_pages"))
              .where(F.col("n_pages") >= min_pages))
    return counts.join(totals, "host").where(F.col("n_pages") > ratio * F.col("host_pages"))


def drop_boilerplate(pages: DataFrame, host: Column, text_col: str = "text", ratio: float = RATIO,
                     min_pages: int = MIN_PAGES, dropped_col: str | None = None,
                     broadcast_rows: int = BROADCAST_ROWS, copies_once: bool = True) -> DataFrame:
    """``pages`` without the boilerplate lines of their hosts.

    ``dropped_col`` names a column for the number of lines dropped.  The found
    lines are broadcast if there are few; otherwise page lines are joined with
    them by key and only the places of lines to drop go back to their pages.
    """
    found = stage(boilerplate_lines(pages, host, text_col, ratio, min_pages, copies_once).select("host", "line"),
                  "boilerplate")
    site = F.coalesce(host.cast("string"), F.lit(""))
    if found.count() <= broadcast_rows:
        by_host = found.groupBy(F.col("host").alias("__host")).agg(F.collect_list("line").alias("__found"))
        out = pages.withColumn("__host", site).join(F.broadcast(by_host), "__host", "left")
        kept = F.when(F.col("__found").isNull(), _lines(text_col)).otherwise(F.filter(
            _lines(text_col), lambda x: ~F.coalesce(F.array_contains(F.col("__found"), _key(x)), F.lit(False))))
    else:
        pages = stage(pages.withColumn("__row", F.monotonically_increasing_id()), "pages")
        places = (pages.select("__row", site.alias("host"), F.posexplode(F.transform(_lines(text_col), _key))
                               .alias("at", "line")).where(F.col("line").isNotNull())
                  .join(found, ["host", "line"], "left_semi")
                  .groupBy("__row").agg(F.collect_set("at").alias("__at")))
        out = pages.join(places, "__row", "left")
        kept = F.filter(_lines(text_col), lambda x, k: ~F.coalesce(F.array_contains(F.col("__at"), k), F.lit(False)))
    out = out.withColumn("__kept", kept)
    if dropped_col:
        dropped = F.coalesce(F.size(_lines(text_col)) - F.size("__kept"), F.lit(0)).cast("long")
        out = out.withColumn("__dropped", dropped)
    out = out.withColumn(text_col, F.array_join("__kept", "\n"))
    columns = [F.col(f"`{c}`") for c in pages.columns if c != "__row"]
    return out.select(*columns, *([F.col("__dropped").alias(dropped_col)] if dropped_col else []))

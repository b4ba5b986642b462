"""Boilerplate lines of sites, by the share of a site's pages that have them.

Counting needs one row per page and distinct line, reduced before the shuffle. The
lines of a site that exceed the ratio are few: the ratios of all its lines add up to
the lines of an average page, so fewer than that number over the ratio can
exceed it, however many pages the site has. That list goes to the site's pages,
and each page drops its lines on its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerline.llm.work import Work, free_names, with_results

BLOCK_TAGS = (
    "address|article|aside|blockquote|body|br|dd|div|dl|dt|figure|footer|form|h[1-6]|head|header|hr|html|li|main|nav|ol|p|"
    "pre|section|table|td|th|title|tr|ul"
)


def host_of(url: Column) -> Column:
    """The lower-case host of a URL with a scheme; null if there is none."""
    host = F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)", 1)
    return F.when(host != "", host)


def html_lines(html: Column) -> Column:
    """The page's text: a line per block element, without scripts, styles, comments and tags."""
    text = F.regexp_replace(html, r"(?is)<script.*?</script>|<style.*?</style>|<!--.*?-->", " ")
    text = F.regexp_replace(text, r"[\r\n]+", " ")
    text = F.regexp_replace(text, rf"(?i)</?(?:{BLOCK_TAGS})(?:[ \t/][^>]*)?>", "\n")
    text = F.regexp_replace(text, r"<[^>]*>", "")
    for entity, character in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")):
        text = F.replace(text, F.lit(entity), F.lit(character))
    return text


def lines_of(text: Column) -> Column:
    """Lines without space at their ends and without empty ones, in order, repeats included."""
    lines = F.transform(F.split(text, "\n"), lambda line: F.trim(F.regexp_replace(line, r"[ \t]+", " ")))
    return F.filter(lines, lambda line: line != "")


def _key(line: Column) -> Column:
    """128 bits that stand for a line."""
    return F.struct(F.xxhash64(line).alias("a"), F.xxhash64(F.lit(8), line).alias("b"))


def without_boilerplate(
    pages: DataFrame,
    *,
    url: str = "url",
    text: Column,
    ratio: float = 0.3,
    on_pages: int = 2,
) -> DataFrame:
    """The pages with ``host``, ``text`` (kept lines), ``n_lines`` and ``n_dropped``.

    A line goes if the pages of its host that contain it, over all pages of the
    host, exceed ``ratio``, and if they are at least ``on_pages``: what stands on one page only is
    no boilerplate, however few pages the host has. Pages without a host keep all lines. Rows that repeat
    are pages of their own. A null or empty text has no lines. Columns of ``pages`` that bear a result's
    name are replaced.
    """
    work = Work(pages.sparkSession, "lines")
    own_host, own_lines, of, keys, kept = free_names(pages, "host", "lines", "of", "keys", "kept")
    host = host_of(F.col(url).cast("string"))
    lines = lines_of(F.coalesce(text, F.lit("")))
    # Written down, so that each page is parted into lines once.
    pages = work.keep(pages.withColumns({own_host: host, own_lines: lines}), "pages")
    rows = pages.select(
        F.col(own_host).alias("host"), F.array_distinct(F.transform(own_lines, _key)).alias("keys")
    ).where("host IS NOT NULL")
    # One pass gives both counts: the null key stands for the page itself.
    page = F.array(F.lit(None).cast("struct<a:bigint,b:bigint>"))
    counted = rows.select("host", F.explode(F.concat(page, "keys")).alias("key")).groupBy("host", "key")
    counted = work.keep(counted.agg(F.count("*").alias("pages")), "counts")
    totals = counted.where("key IS NULL").select("host", F.col("pages").alias("all_pages"))
    totals = work.keep(totals.where(F.col("all_pages") >= on_pages), "hosts")
    frequent = counted.where((F.col("key").isNotNull()) & (F.col("pages") >= on_pages)).join(totals, "host")
    frequent = frequent.where(F.col("pages") > ratio * F.col("all_pages"))
    drop = frequent.groupBy(F.col("host").alias(of)).agg(F.collect_list("key").alias(keys))
    drop = work.keep(drop, "boilerplate")

    joined = pages.join(drop, F.col(own_host) == F.col(of), "left")
    left = F.filter(own_lines, lambda line: ~F.array_contains(F.col(keys), _key(line)))
    joined = joined.withColumn(kept, F.when(F.col(keys).isNull(), F.col(own_lines)).otherwise(left))
    results = {
        "host": F.col(own_host),
        "text": F.array_join(kept, "\n"),
        "n_lines": F.size(own_lines),
        "n_dropped": F.size(own_lines) - F.size(kept),
    }
    return with_results(joined, results).drop(own_host, own_lines, of, keys, kept)

"""Lookups and link crawls as joins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomwork.functions import html
from loomwork.session import materialize

DEFAULT_LINKS = 4  # fixed value: the cap of pages found by the crawl itself


def broadcast_lookup(items: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """Value of each item in a shared table, null if it is not there.

    Spark sends the table to every task when its measured bytes are below
    ``spark.sql.autoBroadcastJoinThreshold`` and shuffles both sides otherwise.
    """
    return items.join(table, key, "left")


def follow_up_lookup(table: DataFrame, key: str, value: str) -> DataFrame:
    """Each (k, v) with (k+1, v'); null where k+1 is missing."""
    after = table.select((F.col(key) - 1).alias(key), F.col(key).alias("next_key"),
                         F.col(value).alias("next_value"))
    return table.select(key, value).join(after, key, "left")


def zip_by_key(features: DataFrame, labels: DataFrame, key: str) -> DataFrame:
    """Features with their label, paired by key and not by position."""
    return features.join(labels, key)


def expand_links(frontier: DataFrame, edges: DataFrame) -> DataFrame:
    """One hop from (url, depth, copies) along (src, dst).

    Pages reached several times are one row with a count, so a page that
    everything links to does not grow the join.
    """
    hops = frontier.join(edges, frontier["url"] == edges["src"])
    return (hops.groupBy(F.col("dst").alias("url"), (F.col("depth") + 1).alias("depth"))
            .agg(F.sum("copies").alias("copies")))


def follow_cap(edges: DataFrame, max_links: int) -> DataFrame:
    """Edges a crawler follows per page: ordinals up to ``max_links`` and the next one.

    ``edges`` holds anchors with an href only; ordinals count all anchors.
    """
    beyond = (edges.where(F.col("ordinal") > max_links).groupBy("src")
              .agg(F.min("ordinal").alias("_last")))
    return (edges.join(beyond, "src", "left")
            .where((F.col("ordinal") <= max_links) | (F.col("ordinal") == F.col("_last")))
            .drop("_last"))


def page_links(pages: DataFrame, max_links: int | None = None) -> DataFrame:
    """(src, ordinal, href, dst) from pages (url, html): every link with its absolute address, relative ones resolved.

    With ``max_links`` only those a crawler follows.  Pages are not shuffled: the cap and
    the addresses come from the page's own row.
    """
    anchors = html.anchors(F.col("html"))
    linked = F.filter(anchors, lambda a: a["href"].isNotNull()) if max_links is None else html.followed(anchors, max_links)
    found = pages.select(F.col("url").alias("src"), html.base_address(F.col("html"), F.col("url")).alias("_base"),
                         linked.alias("_links"))
    return found.select("src", "_base", F.inline("_links")).select(
        "src", "ordinal", "href", html.resolve(F.col("_base"), F.col("href")).alias("dst"))


def crawl_bounded(seeds: DataFrame, edges: DataFrame, pages: DataFrame, max_depth: int = 1,
                  max_links: int = DEFAULT_LINKS, dedup: bool = False) -> DataFrame:
    """(url, depth, copies, html): pages a bounded crawl returns along ``edges`` (src, ordinal, dst), with how often and their body.

    ``pages`` is (url, html); of several bodies of a page the least counts.  Pages deeper than ``max_depth`` are returned and not expanded.  The seeds'
    links are capped by ``max_links``, those of later pages by the default cap.
    Only known pages count.  With ``dedup`` a page has one row, its least depth.
    """
    return _crawl(seeds, lambda cap: follow_cap(edges, cap), pages, max_depth, max_links, dedup)


def crawl_pages(seeds: DataFrame, pages: DataFrame, max_depth: int = 1,
                max_links: int = DEFAULT_LINKS, dedup: bool = False) -> DataFrame:
    """As ``crawl_bounded``, along the links in the pages themselves.

    An address is known without its fragment; links that are not of the web are not followed.
    """
    def bare(name: str) -> Column:
        return F.regexp_replace(name, "(?s)#.*", "")
    plain = pages.withColumn("url", bare("url"))

    def followed(cap: int) -> DataFrame:
        found = page_links(pages, cap).where(html.is_web_link(F.col("dst")))
        return found.select(bare("src").alias("src"), bare("dst").alias("dst"))
    return _crawl(seeds.withColumn("url", bare("url")), followed, plain, max_depth, max_links, dedup)


def _crawl(seeds: DataFrame, followed: Callable[[int], DataFrame], pages: DataFrame, max_depth: int,
           max_links: int, dedup: bool) -> DataFrame:
    """The crawl along the links that ``followed`` gives under a cap."""
    bodies = pages.groupBy("url").agg(F.min("html").alias("html"))
    known = pages.select("url").distinct()

    def into_known(max_links: int) -> DataFrame:
        """Followed edges whose target is a known page, written once for all levels."""
        capped = followed(max_links).select("src", "dst")
        return materialize(capped.join(known, capped["dst"] == known["url"], "left_semi"), "edges")
    seed_edges = into_known(max_links)
    later_edges = seed_edges if max_links == DEFAULT_LINKS else into_known(DEFAULT_LINKS)
    level = (seeds.groupBy("url").agg(F.count("*").alias("copies"))
             .join(known, "url", "left_semi").select("url", F.lit(0).alias("depth"), "copies"))
    levels = [materialize(level, "level")]
    for depth in range(max_depth + 1):
        # written, so that later levels and the result do not compute it again
        levels.append(materialize(expand_links(levels[-1], seed_edges if depth == 0 else later_edges), "level"))
    result = levels[0]
    for more in levels[1:]:
        result = result.unionByName(more)
    if dedup:
        result = result.groupBy("url").agg(F.min("depth").alias("depth"),
                                           F.sum("copies").alias("copies"))
    return result.join(bodies, "url")

"""A site's scrape as joins over a table of loaded pages."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.assemble import cap_per_listing, needs_fetch
from .html_pages import Layout, add_markdown, extract_pages, listing_links


@dataclass(frozen=True)
class Listing:
    """A page that lists elements, and the tags that its elements get."""

    url: str
    add_tags: tuple[str, ...] = ()


def scrape(pages: DataFrame, listings: list[Listing], layout: Layout, existing: DataFrame | None = None, lastmods: DataFrame | None = None, per_listing: int | None = None) -> DataFrame:
    """Raw elements of one site: listings, the pages they link to that are new or changed, and their extraction.

    ``pages``: (url, html), what a crawler has loaded. ``existing``: (url,
    fetchedAt); ``lastmods``: (loc, lastmod) of a site map. A page in several
    listings gets the tags of all, those of the first listing first.
    """
    spark = pages.sparkSession
    named = spark.createDataFrame([(i, x.url, list(x.add_tags)) for i, x in enumerate(listings)], "rank int, listing string, added array<string>")
    links = listing_links(pages.join(F.broadcast(named.select(F.col("listing").alias("url"))), "url", "left_semi"), layout)
    if per_listing is not None:
        links = cap_per_listing(links, per_listing)
    listed = links.join(F.broadcast(named), "listing").groupBy(F.col("link").alias("url")).agg(F.array_distinct(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("rank", "added"))), lambda x: x["added"]))).alias("added"))
    wanted = listed
    if existing is not None:
        none = spark.createDataFrame([], "loc string, lastmod string")
        wanted = listed.join(needs_fetch(listed, existing, none if lastmods is None else lastmods).where("fetch").select("url"), "url", "left_semi")
    found = extract_pages(pages.join(wanted.select("url"), "url", "left_semi"), layout)
    return add_markdown(found.join(wanted, "url").withColumn("tags", F.array_distinct(F.concat("added", "tags"))).drop("added"))

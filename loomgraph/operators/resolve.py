"""Links and category links from ids of targets to ids of pages and categories."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def title_map(pages: DataFrame, ns: int = 0) -> DataFrame:
    """(title, page_id) of a namespace; of pages of one title, the one with the largest id."""
    return pages.filter((F.col("ns") == ns) & F.col("title").isNotNull()).groupBy("title").agg(F.max("page_id").alias("page_id"))


def redirect_map(redirects: DataFrame, titles: DataFrame) -> DataFrame:
    """(rd_from, rd_to): redirects of the main namespace to pages that are there; id 0 is none."""
    found = redirects.filter("ns = 0 AND rd_from <> 0").join(titles, "title")
    return found.groupBy("rd_from").agg(F.max("page_id").alias("rd_to"))


def resolve_links(page_links: DataFrame, targets: DataFrame, pages: DataFrame, redirects: DataFrame, max_hops: int = 1) -> DataFrame:
    """(src_id, dst_id) for each link from the main namespace to a page of it, by way of its target's title, and where
    that page is a redirect, of what it points to (once, or up to max_hops times). Duplicates and loops stay."""
    titles = title_map(pages)
    hops = redirect_map(redirects, titles)
    main = pages.filter("ns = 0 AND page_id IS NOT NULL").select("page_id").distinct()
    # Targets are led to their pages first, so links, of which there are most, are joined twice only.
    ends = targets.filter("ns = 0").select("lt_id", "title").join(titles, "title").select("lt_id", F.col("page_id").alias("dst_id"))
    for _ in range(max_hops):
        ends = ends.join(hops, F.col("dst_id") == F.col("rd_from"), "left").select("lt_id", F.coalesce("rd_to", "dst_id").alias("dst_id"))
    ends = ends.join(main, F.col("dst_id") == F.col("page_id"), "left_semi")
    links = page_links.filter("pl_from_ns = 0").join(ends, F.col("pl_target") == F.col("lt_id")).select(F.col("pl_from").alias("src_id"), "dst_id")
    return links.join(main, F.col("src_id") == F.col("page_id"), "left_semi")


def resolve_categories(category_links: DataFrame, categories: DataFrame, pages: DataFrame, targets: DataFrame, max_pages: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Category edges (parent_id, child_id) and the bridge (page_id, category_id). The parent is the category of the
    target's title; a subcategory's page leads by its title to its category, a main page must be one."""
    by_title = categories.groupBy("title").agg(F.max("category_id").alias("category_id"))
    parents = targets.filter("ns = 14").join(by_title, "title").select(F.col("lt_id").alias("cl_target"), F.col("category_id").alias("parent_id"))
    bridge = pages.filter("ns = 14").join(by_title, "title").select(F.col("page_id").alias("cl_from"), F.col("category_id").alias("child_id"))
    main = pages.filter("ns = 0 AND page_id IS NOT NULL").select(F.col("page_id").alias("cl_from")).distinct()
    main = main.orderBy("cl_from").limit(max_pages) if max_pages else main
    links = category_links.join(parents, "cl_target")
    edges = links.filter("cl_type = 'subcat'").join(bridge, "cl_from").select("parent_id", "child_id")
    held = links.filter("cl_type = 'page'").join(main, "cl_from", "left_semi").select(F.col("cl_from").alias("page_id"), F.col("parent_id").alias("category_id"))
    return edges, held


def visual_pages(page_categories: DataFrame, visual: DataFrame) -> DataFrame:
    """The bridge restricted to visual pages, each pair once."""
    return page_categories.join(visual.select("page_id"), "page_id", "left_semi").distinct()

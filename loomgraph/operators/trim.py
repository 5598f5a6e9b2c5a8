"""Trims to a fixpoint, cycles, and what is left of a graph after nodes go."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import Parts, bounded, replace, staged
from .closure import reach


def restrict(edges: DataFrame, keep: DataFrame, src: str = "parent_id", dst: str = "child_id") -> DataFrame:
    """Edges both ends of which are in keep (column id)."""
    return edges.join(keep.select(F.col("id").alias(src)), src, "left_semi").join(keep.select(F.col("id").alias(dst)), dst, "left_semi").select(edges.columns)


def trim_leaves(categories: DataFrame, edges: DataFrame, pages: DataFrame, root, min_pages: int = 10) -> DataFrame:
    """(id) left after leaves other than root with fewer than min_pages pages (rows of category_id) have gone, again
    and again. Only the categories with few pages can ever go, so only their edges are looked at in the loop."""
    counts = pages.groupBy(F.col("category_id").alias("id")).agg(F.count("*").alias("pages"))
    poor = categories.select("id").distinct().join(counts, "id", "left").filter((F.coalesce("pages", F.lit(0)) < min_pages) & (F.col("id") != root)).select("id")
    poor = staged(poor, "poor")
    links = staged(edges.select("parent_id", "child_id").distinct().join(categories.select(F.col("id").alias("child_id")), "child_id", "left_semi").join(poor.withColumnRenamed("id", "parent_id"), "parent_id", "left_semi"), "links")
    gone = Parts("gone")
    while True:
        leaves = gone.add(poor.join(links.select(F.col("parent_id").alias("id")), "id", "left_anti"))
        if leaves.isEmpty():
            break
        poor = replace(poor, poor.join(leaves, "id", "left_anti"), "poor")
        links = replace(links, links.join(leaves.withColumnRenamed("id", "child_id"), "child_id", "left_anti"), "links")
    return categories.select("id").distinct().join(gone.all(), "id", "left_anti")


def trim_empty(nodes: DataFrame, edges: DataFrame, root: str) -> tuple[DataFrame, DataFrame]:
    """Nodes (node_id, node_type, parent_id ..) and edges without categories that have neither pages nor categories
    below them; the root stays."""
    nodes, edges = staged(nodes, "nodes"), staged(edges, "edges")
    while True:
        useful = nodes.filter("node_type = 'page'").select(F.col("parent_id").alias("node_id")).union(edges.filter("startswith(child_id, 'cat_')").select("parent_id")).distinct()
        drop = staged(nodes.filter((F.col("node_type") == "category") & (F.col("node_id") != root)).select("node_id").join(useful, "node_id", "left_anti"), "drop")
        if drop.isEmpty():
            return nodes, edges
        nodes = replace(nodes, nodes.join(drop, "node_id", "left_anti"), "nodes")
        left = edges.join(drop.withColumnRenamed("node_id", "child_id"), "child_id", "left_anti").join(drop.withColumnRenamed("node_id", "parent_id"), "parent_id", "left_anti")
        edges = replace(edges, left.select("parent_id", "child_id"), "edges")


def connected(categories: DataFrame, edges: DataFrame, root) -> DataFrame:
    """(id): what root reaches downwards."""
    start = categories.filter(F.col("id") == root).select("id")
    return reach(edges, start, None, "parent_id", "child_id").select("id")


def core(edges: DataFrame, src: str, dst: str) -> DataFrame:
    """Edges that are left when nodes without an edge in, or without one out, have gone, again and again. Every cycle
    is in it; loops are left out."""
    links = staged(edges.select(F.col(src).alias("src"), F.col(dst).alias("dst")).distinct().filter("src <> dst"), "core")
    n = links.count()
    while n:
        both = links.select(F.col("src").alias("id")).intersect(links.select(F.col("dst").alias("id")))
        links = replace(links, restrict(links, both, "src", "dst"), "core")
        m = links.count()
        if m == n:
            break
        n = m
    return links


def strong_components(edges: DataFrame, src: str = "child_id", dst: str = "parent_id") -> DataFrame:
    """(id, component): nodes on cycles of two or more nodes, by the smallest node of their strong component. In each
    round the smallest id that reaches a node colours it; what of its colour leads back to that id is a component."""
    links = core(edges, src, dst)
    found = Parts("components")
    while not links.isEmpty():
        colour = replace(None, links.select(F.explode(F.array("src", "dst")).alias("id")).distinct().withColumn("c", F.col("id")), "colour")
        while True:
            offered = colour.join(links.select(F.col("src").alias("id"), "dst"), "id").groupBy(F.col("dst").alias("id")).agg(F.min("c").alias("o"))
            new = colour.join(offered, "id", "left").select("id", F.least("c", "o").alias("c"), (F.col("o") < F.col("c")).alias("less"))
            new = replace(colour, new, "colour")
            moved = not new.filter("less").isEmpty()
            colour = new
            if not moved:
                break
        colour = colour.select("id", "c")
        same = links.join(colour.select(F.col("id").alias("src"), F.col("c").alias("cs")), "src").join(colour.select(F.col("id").alias("dst"), F.col("c").alias("cd")), "dst").filter("cs = cd")
        back = reach(same, colour.filter("id = c").select("id"), None, "dst", "src").select("id")
        part = found.add(colour.join(back, "id", "left_semi").select("id", F.col("c").alias("component")))
        rest = links.join(part.select(F.col("id").alias("src")), "src", "left_anti").join(part.select(F.col("id").alias("dst")), "dst", "left_anti").select("src", "dst")
        links = core(rest, "src", "dst")
    spark = edges.sparkSession
    kind = edges.schema[src].dataType.simpleString()
    if not found.tables:
        return spark.createDataFrame([], f"id {kind}, component {kind}")
    sizes = found.all().groupBy("component").count().filter("count > 1").select("component")
    return found.all().join(sizes, "component", "left_semi").select("id", "component")


def cycle_edges(edges: DataFrame, depths: DataFrame, mode: str = "acyclic") -> DataFrame:
    """Child-parent edges that go. acyclic: within a component, those to a parent that does not come before the child
    by (depth, id), nodes without a depth last, and all loops; what is left has no cycle. reference: in each
    component a node keeps, of its parents in it, only the one with the fewest children (then the least id)."""
    parts = strong_components(edges)
    inner = edges.select("child_id", "parent_id").distinct()
    inner = inner.join(parts.select(F.col("id").alias("child_id"), F.col("component").alias("cc")), "child_id").join(parts.select(F.col("id").alias("parent_id"), F.col("component").alias("cp")), "parent_id").filter("cc = cp")
    if mode == "reference":
        children = edges.select("child_id", "parent_id").distinct().groupBy("parent_id").agg(F.count("*").alias("children"))
        order = F.row_number().over(Window.partitionBy("child_id").orderBy("children", "parent_id"))
        return inner.filter("child_id <> parent_id").join(children, "parent_id").withColumn("nth", order).filter("nth > 1").select("child_id", "parent_id")
    deep = lambda c: F.struct(F.coalesce(f"{c}_depth", F.lit(2**31 - 1)), F.col(f"{c}_id"))
    for c in ("child", "parent"):
        inner = inner.join(depths.select(F.col("id").alias(f"{c}_id"), F.col("depth").alias(f"{c}_depth")), f"{c}_id", "left")
    bad = inner.filter(~(deep("parent") < deep("child"))).select("child_id", "parent_id")
    return bad.union(edges.filter("child_id = parent_id").select("child_id", "parent_id")).distinct()


def weak_roots(categories: DataFrame, edges: DataFrame, page_categories: DataFrame, min_concepts: int = 5) -> DataFrame:
    """(id): categories without a parent that have fewer than min_concepts different pages at or below them. Only pairs of
    a root and what is below it are made, not the whole closure."""
    top = staged(categories.select("id").distinct().join(edges.select(F.col("child_id").alias("id")), "id", "left_anti"), "roots")
    links = staged(edges.select(F.col("parent_id").alias("low"), F.col("child_id").alias("next")).distinct().filter("low <> next"), "links")
    below = Parts("below")
    last = below.add(top.select(F.col("id").alias("top"), F.col("id").alias("low")))
    while not last.isEmpty():
        last = below.add(last.join(links, "low").select("top", F.col("next").alias("low")).distinct().join(below.all(), ["top", "low"], "left_anti"))
    held = page_categories.select("page_id", F.col("category_id").alias("low")).join(bounded(staged(below.all(), "below")), "low").select("top", "page_id").distinct()
    counts = held.groupBy(F.col("top").alias("id")).agg(F.count("*").alias("total"))
    return top.join(counts, "id", "left").filter(F.coalesce("total", F.lit(0)) < min_concepts).select("id")


def without_orphans(categories: DataFrame, edges: DataFrame, page_categories: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Categories that have a page at or below them, and the pages that have a category. One upward closure is the
    fixpoint: a category that goes has no page, so no page loses its last category by it."""
    held = page_categories.join(bounded(staged(categories.select(F.col("id").alias("category_id")), "ids")), "category_id", "left_semi")
    used = reach(restrict(edges, categories), held.select(F.col("category_id").alias("id")), None, "child_id", "parent_id").select("id")
    return used, held.select(F.col("page_id").alias("id")).distinct()

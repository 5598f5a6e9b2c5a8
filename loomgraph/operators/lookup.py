"""Lookups: trees around a node, paths to the top, searches by title, cards."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.titles import normal_title, same_title, underscored
from ..runtime import staged
from .closure import pointers_to_root, reach

#: Edges that a printed tree may take to the driver.
TREE_EDGES = 200_000


def by_title(nodes: DataFrame, query: str, limit: int = 5) -> DataFrame:
    """Nodes of that title whatever its case, spaces as underscores."""
    key = nodes.columns[0]
    return nodes.filter(same_title(F.col("title"), query)).orderBy(key).limit(limit)


def by_synset(nodes: DataFrame, word: str) -> DataFrame:
    return nodes.filter(F.col("synset").startswith(f"{word}.")).orderBy("node_id")


def suggestions(nodes: DataFrame, query: str, limit: int = 10) -> DataFrame:
    """Did you mean: titles that have the query in them."""
    q = query.replace(" ", "_").lower()
    return nodes.filter(F.lower("title").contains(q)).orderBy(nodes.columns[0]).limit(limit)


def find(nodes: DataFrame, query: str, exact: bool = True) -> DataFrame:
    """The first node by id of that title, or with that in its title."""
    q = query.replace(" ", "_").lower()
    test = F.lower("title") == q if exact else F.lower("title").contains(q)
    return nodes.filter(test).orderBy("node_id").limit(1)


def tiered(categories: DataFrame, query: str) -> DataFrame:
    """One row and its tier: equal (0), equal but for case (1), or the shortest title with the query in it (2)."""
    q = query.replace(" ", "_")
    low = F.lower("title")
    tier = F.when(F.col("title") == q, 0).when(low == q.lower(), 1).when(low.contains(q.lower()), 2)
    return categories.withColumn("tier", tier).filter("tier IS NOT NULL").orderBy("tier", F.when(F.col("tier") == 2, F.length("title")).otherwise(0), "category_id").limit(1)


def search(nodes: DataFrame, query: str, node_type: str | None = None, limit: int = 5, filter_first: bool = True) -> DataFrame:
    """Titles equal to the query when normalised, then those that contain it, up to limit. The type filters before
    the limit or, if not filter_first, what the limit has left."""
    q = query.lower().replace(" ", "_").replace("-", "_")
    low = normal_title(F.col("title"))
    kind = F.col("node_type") == node_type if node_type else F.lit(True)
    hits = nodes.withColumn("tier", F.when(low == q, 0).when(low.contains(q), 1)).filter("tier IS NOT NULL")
    if filter_first:
        return hits.filter(kind).orderBy("tier", "node_id").limit(limit)
    return hits.orderBy("tier", "node_id").limit(limit).filter(kind)


def neighbourhood(edges: DataFrame, start, depth: int, up: bool = False) -> DataFrame:
    """(id, depth): what is within depth steps of start."""
    src, dst = ("child_id", "parent_id") if up else ("parent_id", "child_id")
    kind = edges.schema[src].dataType.simpleString()
    return reach(edges, edges.sparkSession.createDataFrame([(start,)], f"id {kind}"), depth, src, dst)


def printed_tree(edges: DataFrame, start, depth: int, up: bool = False) -> list[tuple[int, object]]:
    """(level, id) in the order of a depth-first walk that enters each node once; a node first met at the last level
    is not opened on a shorter way later on, so this may be less than the neighbourhood. Children come by edge_pos or,
    without it, by id. Only edges within the neighbourhood are collected, TREE_EDGES at most."""
    src, dst = ("child_id", "parent_id") if up else ("parent_id", "child_id")
    near = neighbourhood(edges, start, depth, up).filter(F.col("depth") < depth).select(F.col("id").alias(src))
    order = "edge_pos" if "edge_pos" in edges.columns else dst
    rows = edges.join(near, src, "left_semi").select(src, dst, F.col(order).alias("pos")).limit(TREE_EDGES + 1).collect()
    if len(rows) > TREE_EDGES:
        raise ValueError("the neighbourhood is too large to print; use neighbourhood()")
    below: dict = {}
    for r in sorted(rows, key=lambda r: r.pos):
        below.setdefault(r[src], []).append(r[dst])
    out, seen, stack = [], {start}, [(0, start)]
    while stack:
        level, node = stack.pop()
        if (level or node != start) and node in seen:
            continue
        seen.add(node)
        out.append((level, node))
        if level < depth:
            stack += [(level + 1, c) for c in reversed(below.get(node, [])) if c not in seen]
    return out


def paths_up(edges: DataFrame, start: DataFrame, max_nodes: int = 20, goal=None, max_paths: int | None = None) -> DataFrame:
    """(id, path): all paths without a repeated node from each id of start up to goal or, without it, to a node that
    has no parent; of at most max_nodes nodes. Paths that cannot reach goal are not grown: only ancestors of start
    that are also below goal take part. With max_paths, each id keeps so many, the shortest first."""
    links = edges.select(F.col("child_id").alias("last"), F.col("parent_id").alias("next")).distinct().filter("last <> next")
    if goal is not None:
        kind = edges.schema["child_id"].dataType.simpleString()
        below = reach(edges, edges.sparkSession.createDataFrame([(goal,)], f"id {kind}"), max_nodes, "parent_id", "child_id").select(F.col("id").alias("next"))
        links = links.join(below, "next", "left_semi").select("last", "next")
    links = staged(links, "up")
    grown = staged(start.select("id", F.array("id").alias("path")).distinct(), "paths")
    out = None
    for _ in range(max_nodes):
        ends = grown.withColumn("last", F.element_at("path", -1))
        ended = ends.filter(F.col("last") == F.lit(goal)) if goal is not None else ends.join(links.select("last"), "last", "left_anti")
        out = ended.select("id", "path") if out is None else out.union(ended.select("id", "path"))
        open_ = ends.filter(F.col("last") != F.lit(goal)) if goal is not None else ends
        grown = staged(open_.join(links, "last").filter(~F.array_contains("path", F.col("next"))).select("id", F.concat("path", F.array("next")).alias("path")), "paths")
        if grown.isEmpty():
            break
    if max_paths is None:
        return out
    first = Window.partitionBy("id").orderBy(F.size("path"), "path")
    return out.withColumn("nth", F.row_number().over(first)).filter(F.col("nth") <= max_paths).drop("nth")


def one_per_root(paths: DataFrame) -> DataFrame:
    """The shortest path to each root, then the first."""
    w = Window.partitionBy("id", F.element_at("path", -1)).orderBy(F.size("path"), "path")
    return paths.withColumn("nth", F.row_number().over(w)).filter("nth = 1").drop("nth")


def card(nodes: DataFrame, query: str, children: int = 10, siblings: int = 5) -> DataFrame:
    """The first hit of a search with its path to the root, child categories, number of pages, and siblings."""
    hit = staged(search(nodes, query, limit=1).drop("tier"), "hit")
    ups = pointers_to_root(_ancestry(nodes, hit)).join(hit.select(F.col("node_id").alias("id")), "id", "left_semi")
    names = nodes.select(F.col("node_id").alias("other"), F.col("title").alias("other_title"))
    path = ups.select("id", F.posexplode("path").alias("at", "other")).join(names, "other").groupBy("id").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "other_title"))), lambda x: x["other_title"]).alias("path"))
    below = nodes.join(hit.select(F.col("node_id").alias("parent_id")), "parent_id", "left_semi")
    cats = below.filter("node_type = 'category'").orderBy("node_id").limit(children).groupBy("parent_id").agg(F.array_sort(F.collect_list("title")).alias("children"))
    n_pages = below.filter("node_type = 'page'").groupBy("parent_id").agg(F.count("*").alias("pages"))
    sibs = nodes.join(hit.select("parent_id", F.col("node_id").alias("me")), "parent_id").filter("node_id <> me").orderBy("node_id").limit(siblings).groupBy(F.col("me").alias("id")).agg(F.array_sort(F.collect_list("title")).alias("siblings"))
    out = hit.withColumn("id", F.col("node_id")).join(path, "id", "left").join(sibs, "id", "left")
    out = out.join(cats.withColumnRenamed("parent_id", "id"), "id", "left").join(n_pages.withColumnRenamed("parent_id", "id"), "id", "left")
    empty = F.array().cast("array<string>")
    return out.select("node_id", "title", "node_type", "path", F.coalesce("children", empty).alias("children"), F.coalesce("pages", F.lit(0)).alias("pages"), F.coalesce("siblings", empty).alias("siblings"))


def concept_card(graph: dict[str, DataFrame], query: str, max_depth: int = 10) -> DataFrame:
    """The first node of a unified graph with that title, else with the query in it: its fields, the titles of what it
    belongs to or is a child of, and its hierarchy: the shortest path to each root, as titles from the root down."""
    nodes, edges = graph["nodes"], graph["edges"]
    exact = find(nodes, query)
    hit = staged(exact if not exact.isEmpty() else find(nodes, query, exact=False), "hit")
    names = nodes.select(F.col("node_id").alias("step"), F.col("title").alias("step_title"))
    start = hit.select(F.col("node_id").alias("id"))
    links = edges.filter("src_id <> dst_id").select(F.col("src_id").alias("child_id"), F.col("dst_id").alias("parent_id"))
    above = reach(links, start, max_depth, "child_id", "parent_id").select(F.col("id").alias("child_id"))
    found = one_per_root(paths_up(links.join(above, "child_id", "left_semi"), start, max_depth))
    steps = found.select("id", "path", F.posexplode(F.reverse("path")).alias("at", "step")).join(names, "step")
    lines = steps.groupBy("id", "path").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "step_title"))), lambda x: x["step_title"]).alias("line"))
    lines = lines.groupBy(F.col("id").alias("node_id")).agg(F.array_sort(F.collect_list(F.array_join("line", ">"))).alias("hierarchy"))
    ups = links.join(start.select(F.col("id").alias("child_id")), "child_id", "left_semi").join(names, F.col("parent_id") == F.col("step"))
    ups = ups.groupBy(F.col("child_id").alias("node_id")).agg(F.array_sort(F.collect_set("step_title")).alias("parents"))
    empty = F.array().cast("array<string>")
    out = hit.join(ups, "node_id", "left").join(lines, "node_id", "left")
    return out.withColumn("parents", F.coalesce("parents", empty)).withColumn("hierarchy", F.coalesce("hierarchy", empty))


def _ancestry(nodes: DataFrame, hit: DataFrame) -> DataFrame:
    """(id, parent_id) of the hit and all above it."""
    links = nodes.filter("parent_id IS NOT NULL").select(F.col("node_id").alias("child_id"), "parent_id")
    above = reach(links, hit.select(F.col("node_id").alias("id")), None, "child_id", "parent_id").select(F.col("id").alias("node_id"))
    return nodes.join(above, "node_id", "left_semi").select(F.col("node_id").alias("id"), "parent_id")


def sample_paths(paths: DataFrame, titles: DataFrame, wanted: list[str]) -> DataFrame:
    """Best paths of the nodes of these titles, as titles from the root down."""
    some = paths.join(titles.filter(underscored(F.col("title")).isin(*(w.replace(" ", "_") for w in wanted))).select("id", F.col("title").alias("of")), "id")
    steps = some.select("id", "of", "nth", F.posexplode(F.reverse("path")).alias("at", "step"))
    named = steps.join(titles.select(F.col("id").alias("step"), "title"), "step")
    return named.groupBy("id", "of", "nth").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "title"))), lambda x: x["title"]).alias("titles"))


def random_pages(nodes: DataFrame, n: int = 5, seed: int = 0) -> DataFrame:
    """n pages by a seeded hash, so the same each time."""
    return nodes.filter("node_type = 'page'").orderBy(F.xxhash64("node_id", F.lit(seed)), "node_id").limit(n)

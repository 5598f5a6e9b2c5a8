"""The semantic tree: each category keeps its k best parents, each page its best category.

A path is scored by (penalty, no domain anchor, minus the number of anchors, first is no anchor, length), compared
from left to right. What the score needs is carried along with the path, so a path is never looked up again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fixed_values as fixed
from ..functions.titles import category_node, infer_domain, is_penalized, normal_title, page_node
from ..runtime import Parts, replace, staged
from .trim import connected, restrict, trim_empty


def anchors_of(title: Column) -> Column:
    """The domains that have this title as an anchor."""
    return F.filter(F.array(*(F.when(title.isin(*names), F.lit(d)) for d, names in fixed.DOMAIN_ANCHORS.items())), lambda d: d.isNotNull())


def traits(categories: DataFrame) -> DataFrame:
    """(id, title, penalty, anchor, domains, domain) of each category."""
    t = F.coalesce("title", F.lit(""))
    return categories.select("id", "title", (is_penalized(t).cast("int") * fixed.PENALTY).alias("penalty"), t.isin(*fixed.ANCHORS).alias("anchor"), anchors_of(t).alias("domains"), infer_domain(t).alias("domain"))


def discovery(edges: DataFrame, root: DataFrame) -> DataFrame:
    """(id, depth, place): breadth-first order from root. place is the array of the edge positions on the way by which
    a node is first met; nodes of one depth come in the order of their arrays."""
    links = staged(edges.select(F.col("parent_id").alias("id"), "child_id", "edge_pos"), "links")
    kind = links.schema["id"].dataType.simpleString()
    found = Parts("found")
    last, depth = found.add(root.select("id", F.lit(0).alias("depth"), F.array().cast("array<bigint>").alias("place"))), 0
    while True:
        depth += 1
        met = last.join(links, "id").groupBy(F.col("child_id").alias("id")).agg(F.min(F.concat("place", F.array(F.col("edge_pos").cast("bigint")))).alias("place"))
        last = found.add(met.join(found.all().select("id"), "id", "left_anti").select(F.col("id").cast(kind).alias("id"), F.lit(depth).alias("depth"), "place"))
        if last.isEmpty():
            return found.all()


def score(penalty: Column, domains: Column, domain: Column, anchors: Column, first_anchor: Column, length: Column) -> Column:
    has = F.coalesce(F.array_contains(domains, domain), F.lit(False))
    return F.struct(penalty.alias("penalty"), (~has).cast("int").alias("no_domain"), (-anchors).alias("anchors"), (~first_anchor).cast("int").alias("not_first"), length.alias("length"))


def best_paths(categories: DataFrame, edges: DataFrame, root, k: int = 2) -> DataFrame:
    """(id, parent, nth, path, score): the k best paths of each category that root (an id) reaches, by different
    parents. edges has edge_pos, its place in the file. A parent counts if it comes before the node in breadth-first
    order; a node is taken up once all such parents have been, so a round handles all nodes whose turn it is."""
    known = staged(traits(categories), "traits")
    order = staged(discovery(edges, categories.filter(F.col("id") == root).select("id")), "order")
    at = lambda c: order.select(F.col("id").alias(f"{c}_id"), F.struct("depth", "place").alias(f"{c}_at"))
    links = edges.groupBy("parent_id", "child_id").agg(F.min("edge_pos").alias("edge_pos"))
    links = links.join(at("parent"), "parent_id").join(at("child"), "child_id").filter("parent_at < child_at").select("parent_id", F.col("child_id").alias("id"), "edge_pos")
    waiting = staged(links, "waiting")
    top = known.filter(F.col("id") == root)
    start = top.select("id", F.lit(None).cast(known.schema["id"].dataType).alias("parent"), F.lit(1).alias("nth"), F.array("id").alias("path"), "penalty", F.col("anchor").cast("int").alias("anchors"), "domains")
    parts = Parts("paths")
    parts.add(start.withColumn("score", score(F.col("penalty"), F.col("domains"), F.lit(None).cast("string"), F.col("anchors"), F.col("anchors") > 0, F.lit(1))))
    columns = parts.all().columns
    while not waiting.isEmpty():
        done = parts.all()
        open_ = waiting.join(done.select(F.col("id").alias("parent_id")).distinct(), "parent_id", "left_anti").select("id").distinct()
        ready = staged(waiting.join(open_, "id", "left_anti"), "ready")
        if ready.isEmpty():
            break
        paths = done.select(F.col("id").alias("parent_id"), F.col("nth").alias("path_nth"), F.col("path").alias("tail"), F.col("penalty").alias("tp"), F.col("anchors").alias("ta"), F.col("domains").alias("td"))
        made = ready.join(paths, "parent_id").join(known.select("id", "penalty", "anchor", "domains", "domain"), "id")
        made = made.select(
            "id", F.col("parent_id").alias("parent"), "edge_pos", "path_nth", F.concat(F.array("id"), "tail").alias("path"), (F.col("penalty") + F.col("tp")).alias("penalty"),
            (F.col("anchor").cast("int") + F.col("ta")).alias("anchors"), F.array_union("domains", "td").alias("domains"), "domain", "anchor",
        )
        made = made.withColumn("score", score(F.col("penalty"), F.col("domains"), F.col("domain"), F.col("anchors"), F.col("anchor"), F.size("path")))
        one = Window.partitionBy("id", "parent").orderBy("score", "path_nth")
        all_ = Window.partitionBy("id").orderBy("score", "edge_pos", "path_nth")
        kept = made.withColumn("n", F.row_number().over(one)).filter("n = 1").withColumn("nth", F.row_number().over(all_)).filter(F.col("nth") <= k).select(columns)
        last = parts.add(kept)
        waiting = replace(waiting, waiting.join(last.select("id").distinct(), "id", "left_anti"), "waiting")
    return parts.all()


def decision_reasons(candidates: DataFrame) -> DataFrame:
    """(reason, n): which part of the score set the best candidate of an id apart from the first different one.
    candidates has id and score."""
    first = candidates.groupBy("id").agg(F.min("score").alias("a"), F.count("*").alias("n"))
    other = candidates.join(first, "id").filter("score <> a").groupBy("id", "a").agg(F.min("score").alias("b"))
    reason = F.when(F.col("a.penalty") < F.col("b.penalty"), "penalized_avoided").when(F.col("a.no_domain") < F.col("b.no_domain"), "domain_preferred").when(F.col("a.anchors") < F.col("b.anchors"), "anchor_preferred").otherwise("depth_tiebreak")
    single = first.filter("n = 1").select(F.lit("single_parent").alias("reason"))
    return other.select(reason.alias("reason")).union(single).groupBy("reason").agg(F.count("*").alias("n"))


def build_tree(categories: DataFrame, edges: DataFrame, page_categories: DataFrame, root, k: int = 2) -> dict[str, DataFrame]:
    """categories (with depth), edges and the bridge of the tree of best parents; what it does not reach goes."""
    paths = best_paths(categories, edges, root, k)
    kept = staged(paths.filter("parent IS NOT NULL").select(F.col("parent").alias("parent_id"), F.col("id").alias("child_id")).distinct(), "edges")
    depths = discovery(kept.withColumn("edge_pos", F.lit(0)), categories.filter(F.col("id") == root)).select("id", "depth")
    cats = categories.join(depths, "id")
    return {"categories": cats, "edges": kept, "page_categories": page_categories.join(cats.select(F.col("id").alias("category_id")), "category_id", "left_semi"), "paths": paths}


def attach_pages(categories: DataFrame, edges: DataFrame, pages: DataFrame, page_categories: DataFrame, root) -> tuple[DataFrame, DataFrame]:
    """Nodes and edges of the graph of categories and pages. A page goes to its category of the best score, then the
    deepest, then the first in the bridge (column pos). A page that bears the name of a category goes to it or, if it
    is none of its categories, nowhere. Categories have one parent, the last of theirs by edge_pos."""
    parent = edges.groupBy(F.col("child_id").alias("id")).agg(F.max_by("parent_id", "edge_pos").alias("parent_id"))
    tree = parent.select("parent_id", F.col("id").alias("child_id"), F.lit(0).alias("edge_pos"))
    paths = best_paths(categories, tree, root, 1).select("id", "penalty", "anchors", "domains", F.size("path").alias("length"))
    depth = F.col("length") - 1
    cats = staged(traits(categories).join(paths.withColumnRenamed("penalty", "path_penalty").withColumnRenamed("domains", "path_domains"), "id").join(parent, "id", "left"), "cats")
    titles = cats.groupBy(F.lower("title").alias("low")).agg(F.max("id").alias("named"))
    names = cats.select(normal_title(F.col("title")).alias("normal")).distinct()
    rows = page_categories.join(pages.select("page_id", "title"), "page_id").join(cats.select(F.col("id").alias("category_id"), "path_penalty", "anchors", "path_domains", "anchor", "length"), "category_id")
    rows = rows.withColumn("normal", normal_title(F.col("title"))).withColumn("domain", infer_domain(F.col("title")))
    rows = rows.join(names.withColumn("is_name", F.lit(True)), "normal", "left").join(titles, F.col("normal") == F.col("low"), "left")
    rows = rows.filter("is_name IS NULL OR named = category_id")
    value = F.struct(score(F.col("path_penalty"), F.col("path_domains"), F.col("domain"), F.col("anchors"), F.col("anchor"), F.col("length")).alias("s"), (-depth).alias("d"), F.col("pos"))
    best = rows.groupBy("page_id").agg(F.min_by(F.struct("category_id", "title", "length"), value).alias("b"))
    page_nodes = best.select(page_node(F.col("page_id")).alias("node_id"), F.col("b.title").alias("title"), F.lit("page").alias("node_type"), F.col("b.length").alias("depth"), category_node(F.col("b.category_id")).alias("parent_id"))
    cat_nodes = cats.select(category_node(F.col("id")).alias("node_id"), "title", F.lit("category").alias("node_type"), depth.alias("depth"), category_node(F.col("parent_id")).alias("parent_id"))
    nodes = cat_nodes.unionByName(page_nodes)
    links = nodes.filter("parent_id IS NOT NULL").select("parent_id", F.col("node_id").alias("child_id"))
    return trim_empty(nodes, links, f"cat_{root}")


def semantic_subgraph(categories: DataFrame, edges: DataFrame, page_categories: DataFrame, root, deny=fixed.NOT_SEMANTIC, min_pages: int | None = 10) -> dict[str, DataFrame]:
    """Categories that are semantic by title and that root reaches, without poor leaves; their edges; the bridge."""
    from ..functions.titles import is_semantic
    from .trim import trim_leaves

    cats = categories.filter(is_semantic(F.col("title"), deny)) if deny else categories
    links = restrict(edges, cats)
    cats = staged(cats.join(connected(cats, links, root), "id", "left_semi"), "cats")
    links = staged(restrict(links, cats), "links")
    if min_pages is not None:
        kept = trim_leaves(cats, links, page_categories, root, min_pages)
        cats, links = cats.join(kept, "id", "left_semi"), restrict(links, kept)
    return {"categories": cats, "edges": links, "page_categories": page_categories.join(cats.select(F.col("id").alias("category_id")), "category_id", "left_semi")}

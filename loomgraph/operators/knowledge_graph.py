"""The unified graph of concepts and categories: built, cleaned, and written out as tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.titles import is_maintenance, java_regex, normalized_depth, specificity
from ..runtime import bounded, only, remove, replace, staged
from .closure import category_depths, closure, concept_ancestors, concept_depths, depth_histogram, descendant_counts, distinct_counts, gathered, keep_counted, relevant_categories
from .trim import cycle_edges, restrict, weak_roots, without_orphans


class Graph(Mapping):
    """The tables of a graph by name. Each is made when it is asked for first, as few readers need all of them. named and
    counted make parts of nodes, which need no depths: (node_id, original_id, title, node_type), and the counts instead of
    the title. Ids of nodes are unique here, edges too, and these end at nodes."""

    def __init__(self, named: Callable[[], DataFrame], counted: Callable[[], DataFrame], **makers: Callable[[], DataFrame]):
        self.named, self.counted, self.makers, self.tables = named, counted, makers, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self.tables:
            self.tables[name] = self.makers[name]()
        return self.tables[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self.makers)

    def __len__(self) -> int:
        return len(self.makers)


def offset_ids(concepts: DataFrame, categories: DataFrame) -> DataFrame:
    """One row: what is added to category ids, 0 if no concept has the id of a category, else one more than the
    largest concept id."""
    hit = concepts.join(categories, "id", "left_semi").agg(F.count("*").alias("hits"))
    return concepts.agg(F.max("id").alias("top")).crossJoin(F.broadcast(hit)).select(F.when(F.col("hits") > 0, F.col("top") + 1).otherwise(0).cast("long").alias("offset"))


def assemble(concepts: DataFrame, categories: DataFrame, edges: DataFrame, page_categories: DataFrame, counts: Callable[[], DataFrame], concept_direct: int) -> Graph:
    """Tables of the graph from its parts: nodes, edges, title_index, ancestors, metadata. counts makes (id, direct,
    total) of categories; a concept has concept_direct and 1. Without a column original_id, an id is its own. No row of
    page_categories is repeated."""
    concepts, categories = (df if "original_id" in df.columns else df.withColumn("original_id", F.col("id")) for df in (concepts, categories))
    shift = staged(offset_ids(concepts.select("id"), categories.select("id")), "offset")
    add = lambda df, *cols: df.crossJoin(F.broadcast(shift)).withColumns({c: F.col(c) + F.col("offset") for c in cols}).drop("offset")
    cat_depths = only(lambda: staged(category_depths(categories, edges).withColumn("depth", F.coalesce("depth", F.lit(0))), "depths"))
    parts: Graph

    def named() -> DataFrame:
        cat_nodes = add(categories.select(F.col("id").alias("node_id"), "original_id", "title", F.lit("category").alias("node_type")), "node_id")
        return concepts.select(F.col("id").alias("node_id"), "original_id", "title", F.lit("concept").alias("node_type")).unionByName(cat_nodes)

    def counted() -> DataFrame:
        cats = categories.join(counts(), "id", "left").fillna(0, ["direct", "total"])
        cat_nodes = add(cats.select(F.col("id").alias("node_id"), "original_id", F.lit("category").alias("node_type"), F.col("direct").alias("direct_concept_count"), F.col("total").alias("total_concept_count")), "node_id")
        con_nodes = concepts.select(F.col("id").alias("node_id"), "original_id", F.lit("concept").alias("node_type"), F.lit(concept_direct).cast("long").alias("direct_concept_count"), F.lit(1).cast("long").alias("total_concept_count"))
        return con_nodes.unionByName(cat_nodes)

    def nodes() -> DataFrame:
        con_depths = concepts.select("id").join(concept_depths(page_categories, cat_depths), "id", "left").withColumn("depth", F.coalesce("depth", F.lit(0)))
        cats = categories.join(cat_depths, "id").join(counts(), "id", "left").fillna(0, ["direct", "total"])
        cat_nodes = add(cats.select(F.col("id").alias("node_id"), "original_id", "title", F.lit("category").alias("node_type"), "depth", F.col("direct").alias("direct_concept_count"), F.col("total").alias("total_concept_count"), specificity(F.col("total")).alias("specificity_score")), "node_id")
        con_nodes = concepts.join(con_depths, "id").select(F.col("id").alias("node_id"), "original_id", "title", F.lit("concept").alias("node_type"), "depth", F.lit(concept_direct).cast("long").alias("direct_concept_count"), F.lit(1).cast("long").alias("total_concept_count"), F.lit(1.0).alias("specificity_score"))
        every = staged(con_nodes.unionByName(cat_nodes), "nodes")
        return every.crossJoin(F.broadcast(deepest(every))).withColumn("normalized_depth", normalized_depth(F.col("depth"), F.col("max_depth"))).drop("max_depth")

    def deepest(every: DataFrame) -> DataFrame:
        return staged(every.agg(F.coalesce(F.max("depth"), F.lit(0)).alias("max_depth")), "deepest")

    def all_edges() -> DataFrame:
        belongs = add(page_categories.select(F.col("page_id").alias("src_id"), F.col("category_id").alias("dst_id")), "dst_id").withColumn("edge_type", F.lit("belongs_to"))
        child_of = add(edges.select("child_id", "parent_id").distinct().select(F.col("child_id").alias("src_id"), F.col("parent_id").alias("dst_id")), "src_id", "dst_id").withColumn("edge_type", F.lit("child_of"))
        return belongs.unionByName(child_of)

    def title_index() -> DataFrame:
        return parts["nodes"].filter("title IS NOT NULL").select(F.lower("title").alias("title_lower"), "title", "node_id", "node_type")

    def metadata() -> DataFrame:
        every = parts["nodes"]
        histogram = depth_histogram(every.select("depth"), zeros=True).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col("depth").cast("string"), "n")))).alias("depth_distribution"))  # a row for each depth
        return every.agg(F.count("*").alias("num_nodes"), F.count_if(F.col("node_type") == "concept").alias("num_concepts"), F.count_if(F.col("node_type") == "category").alias("num_categories")).crossJoin(parts["edges"].agg(F.count("*").alias("num_edges"))).crossJoin(deepest(every)).crossJoin(shift.withColumnRenamed("offset", "category_id_offset")).crossJoin(histogram)

    parts = Graph(named, counted, nodes=nodes, edges=all_edges, title_index=title_index, ancestors=lambda: _lists(page_categories, edges, cat_depths, concepts, shift), metadata=metadata)
    return parts


def _lists(page_categories: DataFrame, edges: DataFrame, depths: DataFrame, concepts: DataFrame, shift: DataFrame) -> DataFrame:
    made = concept_ancestors(page_categories, closure(edges), depths, concepts).crossJoin(F.broadcast(shift))
    return made.select(F.col("id").alias("node_id"), F.expr("transform(ancestors, a -> a + offset)").alias("ancestors"))


def build(visual: DataFrame, page_categories: DataFrame, categories: DataFrame, edges: DataFrame, max_depth: int = 5, min_concepts: int = 1, keep_internal: bool = True) -> Graph:
    """visual (page_id, title), the bridge, categories (category_id, title) and edges (parent_id, child_id) become the
    graph: categories within max_depth above a page and with enough concepts below, counted by paths."""
    bridge = gathered(page_categories.select(F.col("page_id").alias("id"), F.col("category_id").alias("ancestor"))).select(F.col("id").alias("page_id"), F.col("ancestor").alias("category_id"))
    held = staged(bridge.join(visual.select("page_id"), "page_id", "left_semi"), "held")
    links = edges.select("parent_id", "child_id").distinct()
    cats = only(lambda: staged(categories.select(F.col("category_id").alias("id"), "title").dropDuplicates(["id"]).join(relevant_categories(held, links, max_depth), "id", "left_semi"), "cats"))
    links = staged(restrict(links, cats), "links")
    direct = staged(held.groupBy(F.col("category_id").alias("id")).agg(F.count("*").alias("direct")), "direct")
    counts = only(lambda: staged(descendant_counts(cats, links, direct), "counts"))
    kept = keep_counted(counts, min_concepts, keep_internal)
    cats = staged(cats.join(kept, "id", "left_semi"), "cats")
    links = staged(restrict(links, cats), "links")
    held = replace(held, held.join(bounded(cats, F.col("id").alias("category_id")), "category_id", "left_semi").select("page_id", "category_id"), "held")
    concepts = visual.select(F.col("page_id").alias("id"), "title").dropDuplicates(["id"])
    return assemble(concepts, cats, links, held, lambda: counts, 1)


def clean(graph: Mapping[str, DataFrame], extra: list[str] | None = None, keep: list[str] | None = None, min_root_concepts: int = 5, mode: str = "acyclic", read: Callable[[], None] | None = None) -> tuple[Graph, dict[str, int]]:
    """The graph without maintenance categories (unless a keep pattern matches), cycles, weak roots and orphans; all
    that is derived is derived anew, counting different concepts. Edges of nodes that go, go with them. The numbers of
    what went are those of all rounds together. read is called when the tables of graph are read no more."""
    sound = isinstance(graph, Graph)
    nodes, edges = graph.named() if sound else graph["nodes"], graph["edges"]
    title = F.col("title")
    bad = is_maintenance(title, extra or [])
    if keep:
        bad &= ~F.coalesce(title.rlike(java_regex(keep)), F.lit(False))
    cats = nodes.filter("node_type = 'category'").select(F.col("node_id").alias("id"), "original_id", "title")
    left = staged(cats.filter(~bad), "cats")
    concepts = staged(nodes.filter("node_type = 'concept'").select(F.col("node_id").alias("id"), "original_id", "title"), "concepts")
    stats = {"categories_before": cats.count(), "concepts_before": concepts.count()}
    stats["removed_maintenance"] = stats["categories_before"] - left.count()
    links = staged(restrict(edges.filter("edge_type = 'child_of'").select(F.col("dst_id").alias("parent_id"), F.col("src_id").alias("child_id")).distinct(), left), "links")
    held = edges.filter("edge_type = 'belongs_to'").select(F.col("src_id").alias("page_id"), F.col("dst_id").alias("category_id")).join(bounded(left, F.col("id").alias("category_id")), "category_id", "left_semi").select("page_id", "category_id")
    if not sound:  # Rows meet their concepts before they are made distinct, as both go by the page.
        held = held.join(concepts.select(F.col("id").alias("page_id")), "page_id", "left_semi").distinct()
    held = staged(held, "held")
    if read:
        read()
    cut = only(lambda: staged(cycle_edges(links, category_depths(left, links), mode), "cut"))
    stats["removed_cycle_edges"] = cut.count()
    links = staged(links.join(cut, ["child_id", "parent_id"], "left_anti").select("parent_id", "child_id"), "links")
    weak = only(lambda: staged(weak_roots(left, links, held, min_root_concepts), "weak"))
    stats["removed_weak_roots"] = weak.count()
    left = staged(left.join(weak, "id", "left_anti"), "cats")
    links = restrict(links, left)
    strong = held.join(bounded(weak, F.col("id").alias("category_id")), "category_id", "left_anti").select("page_id", "category_id")
    used, pages = without_orphans(left, links, strong)
    used, pages = staged(used, "used"), staged(pages, "pages")
    stats["removed_orphan_categories"] = left.count() - used.count()
    stats["removed_orphan_concepts"] = stats["concepts_before"] - pages.count()
    left, concepts = staged(left.join(used, "id", "left_semi"), "cats"), replace(concepts, concepts.join(pages, "id", "left_semi"), "concepts")
    remove(pages.sparkSession, pages.scratch_path)
    links = staged(restrict(links, left), "links")
    held = replace(held, strong.join(bounded(used, F.col("id").alias("category_id")), "category_id", "left_semi").select("page_id", "category_id"), "held")
    return assemble(concepts, left, links, held, lambda: only(lambda: staged(distinct_counts(left, held, closure(links)), "counts")), 0), stats

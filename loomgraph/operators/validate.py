"""Checks of a unified graph: each is rows (check, level, message, violations); level is ok, warn or error."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import staged
from .closure import closure, concept_ancestors, depth_histogram, ordered


def _row(check: str, message: str, bad: DataFrame, level: str = "error") -> DataFrame:
    """bad has one row per violation."""
    return bad.agg(F.count("*").alias("violations")).select(F.lit(check).alias("check"), F.when(F.col("violations") > 0, level).otherwise("ok").alias("level"), F.lit(message).alias("message"), "violations")


def _differs(check: str, message: str, one: DataFrame, a: Column, b: Column, level: str = "error") -> DataFrame:
    """one is a single row on which a and b must agree."""
    n = F.when(a.eqNullSafe(b), 0).otherwise(1).cast("long")
    return one.select(F.lit(check).alias("check"), F.when(n > 0, level).otherwise("ok").alias("level"), F.lit(message).alias("message"), n.alias("violations"))


def _parts(g: dict[str, DataFrame]) -> tuple[DataFrame, ...]:
    nodes, edges = g["nodes"], g["edges"]
    belongs = edges.filter("edge_type = 'belongs_to'").select(F.col("src_id").alias("page_id"), F.col("dst_id").alias("category_id"))
    child_of = edges.filter("edge_type = 'child_of'").select(F.col("src_id").alias("child_id"), F.col("dst_id").alias("parent_id"))
    return nodes, edges, belongs, child_of


def structure(g: dict[str, DataFrame]) -> list[DataFrame]:
    nodes, edges, _, _ = _parts(g)
    ids = nodes.select(F.col("node_id").alias("id"))
    one = g["metadata"].crossJoin(nodes.agg(F.count("*").alias("n"))).crossJoin(edges.agg(F.count("*").alias("e")))
    titled = nodes.filter("title IS NOT NULL").agg(F.count("*").alias("titled")).crossJoin(g["title_index"].agg(F.count("*").alias("indexed")))
    concepts = nodes.filter("node_type = 'concept'").select("node_id")
    return [
        _differs("V1", "number of nodes as in metadata", one, F.col("n"), F.col("num_nodes")),
        _differs("V1", "number of edges as in metadata", one, F.col("e"), F.col("num_edges")),
        _row("V1", "node ids occur once", nodes.groupBy("node_id").count().filter("count > 1")),
        _row("V1", "edges end at nodes", edges.select(F.explode(F.array("src_id", "dst_id")).alias("id")).distinct().join(ids, "id", "left_anti")),
        _differs("V1", "title index has every titled node", titled, F.col("titled"), F.col("indexed"), "warn"),
        _row("V1", "every concept has an ancestor list", concepts.join(g["ancestors"], "node_id", "left_anti")),
        _row("V1", "ancestor lists are of concepts", g["ancestors"].join(concepts, "node_id", "left_anti")),
    ]


def edge_types(g: dict[str, DataFrame]) -> list[DataFrame]:
    nodes, edges, _, _ = _parts(g)
    kinds = nodes.select("node_id", "node_type")
    typed = edges.join(kinds.select(F.col("node_id").alias("src_id"), F.col("node_type").alias("src_type")), "src_id").join(kinds.select(F.col("node_id").alias("dst_id"), F.col("node_type").alias("dst_type")), "dst_id")
    return [
        _row("V2", "belongs_to leads from a concept to a category", typed.filter("edge_type = 'belongs_to' AND NOT (src_type = 'concept' AND dst_type = 'category')")),
        _row("V2", "child_of leads from a category to a category", typed.filter("edge_type = 'child_of' AND NOT (src_type = 'category' AND dst_type = 'category')")),
        _row("V2", "no edge is a loop", edges.filter("src_id = dst_id")),
    ]


def depths(g: dict[str, DataFrame]) -> list[DataFrame]:
    nodes, _, belongs, child_of = _parts(g)
    depth = nodes.select("node_id", "depth")
    cats = nodes.filter("node_type = 'category'")
    both = child_of.join(depth.select(F.col("node_id").alias("child_id"), F.col("depth").alias("cd")), "child_id").join(depth.select(F.col("node_id").alias("parent_id"), F.col("depth").alias("pd")), "parent_id")
    least = belongs.join(depth.select(F.col("node_id").alias("category_id"), "depth"), "category_id").groupBy("page_id").agg(F.min("depth").alias("least"))
    concepts = nodes.filter("node_type = 'concept'").join(least.withColumnRenamed("page_id", "node_id"), "node_id")
    deepest = nodes.agg(F.max("depth").alias("deepest"))
    normal = nodes.crossJoin(F.broadcast(deepest)).filter("abs(normalized_depth - CASE WHEN deepest > 0 THEN depth / deepest ELSE 0 END) > 1e-6")
    return [
        _row("V3", "categories of depth 0 have no parent", cats.filter("depth = 0").join(child_of.select(F.col("child_id").alias("node_id")), "node_id", "left_semi")),
        _row("V3", "a parent is less deep than its child", both.filter("pd >= cd"), "warn"),
        _row("V3", "a concept is one deeper than its least deep category", concepts.filter("depth <> least + 1")),
        _row("V3", "normalized depth is depth over the largest", normal),
    ]


def cycles(g: dict[str, DataFrame]) -> list[DataFrame]:
    """A topological sort must reach every category."""
    nodes, _, _, child_of = _parts(g)
    cats = nodes.filter("node_type = 'category'").select(F.col("node_id").alias("id"))
    return [_row("V4", "the hierarchy has no cycle", cats.join(ordered(cats, child_of), "id", "left_anti"))]


def scores(g: dict[str, DataFrame]) -> list[DataFrame]:
    nodes = g["nodes"]
    want = F.when((F.col("node_type") == "concept") | (F.col("total_concept_count") == 0), 1.0).otherwise(1 / F.log1p(F.col("total_concept_count").cast("double")))
    corr = nodes.filter("node_type = 'category' AND total_concept_count > 0").agg(F.corr("specificity_score", "total_concept_count").alias("r"))
    return [
        _row("V5", "specificity is 1 / log1p(total)", nodes.filter(F.abs(F.col("specificity_score") - want) > 1e-5)),
        _row("V5", "specificity is over 0 and no more than 1 / log(2)", nodes.filter("specificity_score <= 0 OR specificity_score > 1.442696")),
        _row("V5", "specificity falls as the count grows", corr.filter("r >= 0"), "warn"),
    ]


def _fingerprint(c: Column) -> Column:
    """What tells lists apart, in a few bytes: length and two hashes, in order and sorted; null for null."""
    two = lambda x, name: F.struct(F.size(x).alias("n"), F.xxhash64(x).alias("a"), F.xxhash64(F.lit(1), x).alias("b")).alias(name)
    return F.when(c.isNotNull(), F.struct(two(F.array_sort(c), "members"), two(c, "order")))


def ancestors(g: dict[str, DataFrame]) -> list[DataFrame]:
    """All concepts are looked at, not only the first. Lists are compared by fingerprints, as they are many times as large
    as all else; they are made once for both checks."""
    nodes, _, belongs, child_of = _parts(g)
    depth = nodes.select(F.col("node_id").alias("id"), "depth")
    want = concept_ancestors(belongs, closure(child_of), depth).select(F.col("id").alias("node_id"), _fingerprint(F.col("ancestors")).alias("want"))
    given = g["ancestors"].select("node_id", _fingerprint(F.col("ancestors")).alias("given"))
    none = _fingerprint(F.array().cast("array<bigint>"))
    both = staged(given.join(want, "node_id", "left").withColumn("want", F.coalesce("want", none)).filter("given <> want"), "lists")
    return [
        _row("V6", "ancestors are all that is above", both.filter("given.members <> want.members")),
        _row("V6", "ancestors go from the root down", both.filter("given.members = want.members AND given.order <> want.order"), "warn"),
    ]


def coverage(g: dict[str, DataFrame]) -> list[DataFrame]:
    nodes, _, belongs, _ = _parts(g)
    n = belongs.groupBy(F.col("category_id").alias("node_id")).agg(F.count("*").alias("n"))
    cats = nodes.filter("node_type = 'category'").join(n, "node_id", "left").fillna(0, ["n"])
    return [
        _row("V7", "every concept belongs to a category", nodes.filter("node_type = 'concept'").join(belongs.select(F.col("page_id").alias("node_id")), "node_id", "left_anti"), "warn"),
        _row("V7", "direct counts are the edges", cats.filter("n <> direct_concept_count")),
    ]


def index(g: dict[str, DataFrame]) -> list[DataFrame]:
    nodes, t = g["nodes"], g["title_index"]
    return [
        _row("V8", "title_lower is the title in lower case", t.filter("title_lower <> lower(title)")),
        _row("V8", "titles are those of the nodes", t.join(nodes.select("node_id", F.col("title").alias("own")), "node_id", "left").filter("NOT (title <=> own)")),
        _row("V8", "titles occur once", t.groupBy("title_lower").count().filter("count > 1"), "warn"),
    ]


def statistics(g: dict[str, DataFrame]) -> list[DataFrame]:
    said = g["metadata"].select(F.explode("depth_distribution").alias("depth", "said")).select(F.col("depth").cast("int").alias("depth"), "said")
    real = depth_histogram(g["nodes"])
    both = real.join(said, "depth", "full").filter("coalesce(n, 0) <> coalesce(said, 0)")
    return [_row("V9", "depths are distributed as in metadata", both)]


def validate(g: dict[str, DataFrame], quick: bool = False) -> DataFrame:
    """All checks; quick leaves out the search for cycles."""
    parts = [structure, edge_types, depths, *([] if quick else [cycles]), scores, ancestors, coverage, index, statistics]
    return reduce(DataFrame.unionByName, [row for f in parts for row in f(g)])


def passed(ledger: DataFrame) -> bool:
    return ledger.filter("level = 'error'").isEmpty()


def report(ledger: DataFrame) -> str:
    rows = ledger.orderBy("check", "message").collect()  # a row for each check
    lines = [f"[{r.level}] {r.check} {r.message}: {r.violations}" for r in rows]
    n = {k: sum(r.level == k for r in rows) for k in ("ok", "warn", "error")}
    return "\n".join([*lines, f"{n['ok']} ok, {n['warn']} warnings, {n['error']} errors: {'FAILED' if n['error'] else 'PASSED'}"])


def averages(g: dict[str, DataFrame]) -> DataFrame:
    """One row: categories a concept, children a category, and specificity of categories; those without count as 0."""
    nodes, _, belongs, child_of = _parts(g)
    per = nodes.filter("node_type = 'concept'").join(belongs.groupBy(F.col("page_id").alias("node_id")).agg(F.count("*").alias("n")), "node_id", "left").agg(F.avg(F.coalesce("n", F.lit(0))).alias("categories_per_concept"))
    kids = nodes.filter("node_type = 'category'").join(child_of.groupBy(F.col("parent_id").alias("node_id")).agg(F.count("*").alias("n")), "node_id", "left")
    kids = kids.agg(F.avg(F.coalesce("n", F.lit(0))).alias("children_per_category"), F.avg("specificity_score").alias("mean_specificity"), F.min("specificity_score").alias("min_specificity"), F.max("specificity_score").alias("max_specificity"))
    return per.crossJoin(kids)


def largest(nodes: DataFrame, n: int = 20) -> DataFrame:
    return nodes.filter("node_type = 'category'").orderBy(F.desc("total_concept_count"), "node_id").limit(n)


def ends_specificity(nodes: DataFrame, n: int = 20) -> DataFrame:
    """One row: mean specificity of the n largest and the n smallest categories."""
    cats = nodes.filter("node_type = 'category'")
    top = cats.orderBy(F.desc("total_concept_count"), "node_id").limit(n).agg(F.avg("specificity_score").alias("largest"))
    low = cats.orderBy("total_concept_count", "node_id").limit(n).agg(F.avg("specificity_score").alias("smallest"))
    return top.crossJoin(low)


def root_categories(nodes: DataFrame, n: int = 20) -> DataFrame:
    return nodes.filter("node_type = 'category' AND depth = 0").orderBy(F.desc("total_concept_count"), "node_id").limit(n).withColumn("weak", F.col("total_concept_count") < 10)


def pages_per_category(nodes: DataFrame) -> DataFrame:
    """One row over the categories of a tree (node_type, parent_id) that have pages: fewest, most, mean and median pages
    and the number of these categories. The median is taken from counts of counts, which are few."""
    from .pagerank import quantiles

    per = nodes.filter("node_type = 'page'").groupBy("parent_id").agg(F.count("*").cast("double").alias("pagerank"))
    middle = quantiles(per, [0.5]).withColumnRenamed("q0", "median_pages")
    one = per.agg(F.min("pagerank").cast("long").alias("min_pages"), F.max("pagerank").cast("long").alias("max_pages"), F.avg("pagerank").alias("mean_pages"), F.count("*").alias("categories"))
    return one.crossJoin(F.broadcast(middle)).select("min_pages", "max_pages", "mean_pages", "median_pages", "categories")

"""Degrees of the link graph, hubs, and detectors of pages that are infrastructure."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as fixed
from ..functions.titles import contains_any, first_keyword, in_out_ratio, matches_parts


def degrees(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Nodes with in_degree, out_degree (each link counts) and their ratio. One aggregation over both ends."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("src_id").alias("page_id"), F.lit(0).alias("i"), F.lit(1).alias("o")), F.struct(F.col("dst_id").alias("page_id"), F.lit(1).alias("i"), F.lit(0).alias("o")))).alias("e"))
    counted = ends.groupBy(F.col("e.page_id").alias("page_id")).agg(F.sum("e.i").alias("in_degree"), F.sum("e.o").alias("out_degree"))
    out = nodes.join(counted, "page_id", "left").fillna(0, ["in_degree", "out_degree"])
    return out.withColumn("in_out_ratio", in_out_ratio(F.col("in_degree"), F.col("out_degree")))


def degree_stats(nodes: DataFrame) -> DataFrame:
    """One row: mean, median, largest and zero counts of both degrees."""
    made = []
    for c in ("in_degree", "out_degree"):
        made += [F.avg(c).alias(f"{c}_mean"), F.percentile(c, F.lit(0.5)).alias(f"{c}_median"), F.max(c).alias(f"{c}_max"), F.count_if(F.col(c) == 0).alias(f"{c}_zero")]
    return nodes.agg(F.count("*").alias("n"), *made)


def top_hubs(nodes: DataFrame, n: int = 30) -> DataFrame:
    return nodes.orderBy(F.desc("in_degree"), "page_id").limit(n).withColumn("low_out", F.col("out_degree") < 50)


def top_dangling(nodes: DataFrame, n: int = 50) -> DataFrame:
    return nodes.filter("out_degree = 0").orderBy(F.desc("in_degree"), "page_id").limit(n)


def top_lopsided(nodes: DataFrame, n: int = 50, min_in: int = 10_000, max_out: int = 10) -> DataFrame:
    return nodes.filter((F.col("in_degree") > min_in) & (F.col("out_degree") < max_out)).orderBy(F.desc("in_degree"), "page_id").limit(n)


def top_hubs_after(nodes: DataFrame, excluded: DataFrame, n: int = 30) -> DataFrame:
    return top_hubs(nodes.join(excluded.select("title"), "title", "left_anti"), n)


def title_patterns(nodes: DataFrame) -> DataFrame:
    """(pattern, n, example): how many titles have each namespace prefix or meta pattern, and the first of them."""
    t = F.col("title")
    tests = [(p, t.startswith(p)) for p in fixed.NAMESPACES]
    tests += [("(disambiguation)", F.lower(t).contains("(disambiguation)")), ("List_of_", t.startswith("List_of_"))]
    tests += [(name, t.rlike(p)) for name, p in fixed.META_TITLES.items()]
    one = nodes.agg(F.array(*(F.struct(F.lit(name).alias("pattern"), F.count_if(test).alias("n"), F.min(F.when(test, t)).alias("example")) for name, test in tests)).alias("x"))
    return one.select(F.explode("x").alias("x")).select("x.*")


def citation_titles(nodes: DataFrame) -> DataFrame:
    """Titles with a citation keyword and the first one, each title once (the node with most links in)."""
    found = nodes.withColumn("keyword", first_keyword(F.col("title"), fixed.FINDER_KEYWORDS)).filter("keyword IS NOT NULL")
    return found.groupBy("title", "keyword").agg(F.max(F.struct("in_degree", "out_degree")).alias("d")).select("title", "d.in_degree", "d.out_degree", "keyword").orderBy(F.desc("in_degree"), "title")


# Detectors: each gives (title, source).

def by_ratio(nodes: DataFrame, min_in: int = 5000, min_ratio: float = 100, max_out: int = 200) -> DataFrame:
    return _found(nodes, (F.col("in_degree") >= min_in) & (F.col("in_out_ratio") >= min_ratio) & (F.col("out_degree") <= max_out), "ratio")


def by_title(nodes: DataFrame, min_in: int = 1000) -> DataFrame:
    meta = F.col("title").rlike(r"_\(identifier\)$") | F.col("title").rlike(r"^H:[A-Z]+$")
    database = matches_parts(F.col("title"), fixed.DATABASE_KEYWORDS) & (F.col("in_degree") >= 5 * min_in) & (F.col("out_degree") < 200)
    return _found(nodes, meta & (F.col("in_degree") >= min_in) | database, "pattern")


def by_citation(nodes: DataFrame, min_in: int = 1000, min_ratio: float = 10) -> DataFrame:
    return _found(nodes, matches_parts(F.col("title"), fixed.CITATION_KEYWORDS) & (F.col("in_degree") >= min_in) & (F.col("in_out_ratio") > min_ratio), "citation")


def by_dangling(nodes: DataFrame, min_in: int = 500) -> DataFrame:
    return _found(nodes, (F.col("out_degree") == 0) & (F.col("in_degree") >= min_in), "dangling")


def curated(spark) -> DataFrame:
    return spark.createDataFrame([(t, "curated") for t in fixed.CURATED_EXCLUDED], "title string, source string")


def _found(nodes: DataFrame, test, source: str) -> DataFrame:
    return nodes.filter(test & F.col("title").isNotNull()).select("title", F.lit(source).alias("source"))


def exclusions(nodes: DataFrame, min_in: int = 1000) -> DataFrame:
    """(title, sources) that detectors or the curated list name, without protected titles, restricted to the graph."""
    found = [curated(nodes.sparkSession), by_ratio(nodes, 5 * min_in), by_title(nodes, min_in), by_citation(nodes, min_in), by_dangling(nodes, min_in // 2)]
    all_ = reduce(DataFrame.unionByName, found).groupBy("title").agg(F.array_sort(F.collect_set("source")).alias("sources"))
    return all_.filter(~F.col("title").isin(*fixed.PROTECTED)).join(nodes.select("title"), "title", "left_semi")


def excluded_share(nodes: DataFrame, excluded: DataFrame) -> DataFrame:
    """One row: excluded nodes, links into them, and the share of all links."""
    hit = nodes.join(excluded.select("title").distinct().withColumn("hit", F.lit(True)), "title", "left")
    into = F.coalesce(F.sum(F.when(F.col("hit"), F.col("in_degree"))), F.lit(0))
    return hit.agg(F.count_if(F.col("hit")).alias("nodes"), into.alias("links"), F.when(F.sum("in_degree") > 0, into / F.sum("in_degree")).alias("share"))


def recommend(nodes: DataFrame, min_in: int = 1000, max_out: int = 10, dangling: bool = True) -> DataFrame:
    """The older recommender: (title), in alphabetical order."""
    i, o = F.col("in_degree"), F.col("out_degree")
    test = (i > 5 * min_in) & (o < max_out) | contains_any(F.lower("title"), fixed.RECOMMENDER_KEYWORDS) & (i > 1000)
    if dangling:
        test |= (o == 0) & (i > min_in)
    return nodes.filter(test & F.col("title").isNotNull()).select("title").distinct().orderBy("title")

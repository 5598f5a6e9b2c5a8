"""PageRank and what is read off it: statistics, thresholds, ranks and pruned graphs.

Edges are a bag: an edge that occurs twice counts twice. A node without out-edges spreads its rank over all nodes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import bucketed, replace, staged


def weighted(edges: DataFrame, src: str = "src_id", dst: str = "dst_id") -> DataFrame:
    """(src, dst, weight): equal edges as one, weighted by their number."""
    return edges.groupBy(F.col(src).alias("src"), F.col(dst).alias("dst")).agg(F.count("*").alias("weight"))


def within(edges: DataFrame, nodes: DataFrame, src: str, dst: str, key: str) -> DataFrame:
    """Edges both ends of which are nodes."""
    ids = nodes.select(F.col(key).alias("__id"))
    return edges.join(ids, edges[src] == ids["__id"], "left_semi").join(ids, F.col(dst) == ids["__id"], "left_semi")


def without_titles(nodes: DataFrame, titles: DataFrame) -> DataFrame:
    """Nodes whose title is not among titles; a null title is among none."""
    return nodes.join(titles.select("title").distinct(), "title", "left_anti").select(nodes.columns)


def pagerank(
    nodes: DataFrame, edges: DataFrame, key: str = "page_id", src: str = "src_id", dst: str = "dst_id", damping: float = 0.85,
    max_iter: int = 30, tol: float | None = 1e-6, normalize: bool = False,
) -> DataFrame:
    """(key, pagerank). A round reads the ranks three times (to send them, to sum the dangling ones, to add up), so
    they are staged in every round; its change is measured there too, unless tol is None. The shares of the edges are
    computed once and kept in buckets by source, so a round shuffles ranks and what they send, but no edges."""
    ids = nodes.select(F.col(key).alias("id")).distinct()
    links = weighted(within(edges, nodes, src, dst, key), src, dst)
    out = links.groupBy("src").agg(F.sum("weight").alias("out"))
    shares = bucketed(links.join(out, "src").select("src", "dst", (F.col("weight") / F.col("out")).alias("share")), "src", "shares")
    base = staged(ids.join(out.select(F.col("src").alias("id"), F.lit(False).alias("dangling")), "id", "left").select("id", F.coalesce("dangling", F.lit(True)).alias("dangling")), "ids")
    n = base.count()
    if not n:
        return ids.select(F.col("id").alias(key), F.lit(0.0).alias("pagerank"))
    ranks, kept = base.withColumn("rank", F.lit(1.0 / n)), None
    for i in range(1, max_iter + 1):
        lost = ranks.agg(F.coalesce(F.sum(F.when(F.col("dangling"), F.col("rank"))), F.lit(0.0)).alias("lost"))
        got = shares.join(ranks.select(F.col("id").alias("src"), "rank"), "src").groupBy(F.col("dst").alias("id")).agg(F.sum(F.col("rank") * F.col("share")).alias("got"))
        new = ranks.join(got, "id", "left").crossJoin(F.broadcast(lost))  # lost is one row
        value = (1 - damping) / n + damping * (F.coalesce("got", F.lit(0.0)) + F.col("lost") / n)
        ranks = new.select("id", "dangling", value.alias("rank"), F.abs(value - F.col("rank")).alias("change"))
        ranks = kept = replace(kept, ranks, "ranks")
        if tol is not None and i < max_iter and ranks.agg(F.sum("change")).first()[0] < tol:
            break
        ranks = ranks.select("id", "dangling", "rank")
    if normalize:
        total = ranks.agg(F.sum("rank").alias("total"))
        ranks = ranks.crossJoin(F.broadcast(total)).withColumn("rank", F.col("rank") / F.col("total"))
    return ranks.select(F.col("id").alias(key), F.col("rank").alias("pagerank"))


def cumulated(ranks: DataFrame) -> DataFrame:
    """(pagerank, n, before, upto, total): each value with its rows, those with less, those with no more, and all.
    Values are counted first; running sums are taken within range partitions and shifted by the partitions before."""
    values = staged(ranks.groupBy("pagerank").agg(F.count("*").alias("n")).repartitionByRange("pagerank").withColumn("part", F.spark_partition_id()), "values")
    parts = values.groupBy("part").agg(F.sum("n").alias("rows"))
    shift = parts.select("part", F.coalesce(F.sum("rows").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("shift"))  # a row for each partition
    total = values.agg(F.sum("n").alias("total"))
    running = F.sum("n").over(Window.partitionBy("part").orderBy("pagerank").rowsBetween(Window.unboundedPreceding, 0))
    upto = values.withColumn("running", running).join(F.broadcast(shift), "part").crossJoin(F.broadcast(total))
    return upto.select("pagerank", "n", (F.col("running") + F.col("shift") - F.col("n")).alias("before"), (F.col("running") + F.col("shift")).alias("upto"), "total")


def quantiles(ranks: DataFrame, shares: list[float]) -> DataFrame:
    """One row with a column q0, q1 .. for each share: exact and interpolated between the two neighbours. Each value
    tells whether it is one of them, so no task sees more than its range of values."""
    at = [F.lit(float(s)) * (F.col("total") - 1) for s in shares]
    held = lambda k: F.max(F.when((F.col("before") <= k) & (F.col("upto") > k), F.col("pagerank")))
    found = cumulated(ranks.filter("pagerank IS NOT NULL")).agg(F.max("total").alias("total"), *(held(f(h)).alias(f"{c}{i}") for i, h in enumerate(at) for c, f in (("low", F.floor), ("high", F.ceil))))
    parts = [h - F.floor(h) for h in at]
    return found.select(*(((1 - w) * F.col(f"low{i}") + w * F.col(f"high{i}")).alias(f"q{i}") for i, w in enumerate(parts)))


def rank_stats(ranks: DataFrame) -> DataFrame:
    """One row: sum, min, max, mean, median and the 1st to 99th percentiles, exact and interpolated."""
    points = (1, 5, 10, 25, 50, 75, 90, 95, 99)
    one = ranks.agg(F.count("*").alias("n"), *(f("pagerank").alias(f"{f.__name__}_rank") for f in (F.sum, F.min, F.max, F.avg)))
    one = one.crossJoin(F.broadcast(quantiles(ranks, [p / 100 for p in points])))
    return one.select("n", "sum_rank", "min_rank", "max_rank", "avg_rank", *(F.col(f"q{i}").alias(f"p{p:02d}") for i, p in enumerate(points)))


def threshold(ranks: DataFrame, min_pagerank: float | None = None, drop_bottom_pct: float | None = None) -> DataFrame:
    """One row with the least rank that stays; exactly one of the two must be given."""
    if (min_pagerank is None) == (drop_bottom_pct is None):
        raise ValueError("give either min_pagerank or drop_bottom_pct")
    if min_pagerank is not None:
        return ranks.sparkSession.range(1).select(F.lit(float(min_pagerank)).alias("threshold"))
    return quantiles(ranks, [drop_bottom_pct / 100]).withColumnRenamed("q0", "threshold")


def keep_set(ranks: DataFrame, min_pagerank: float | None = None, drop_bottom_pct: float | None = None) -> DataFrame:
    """The rows at or over the threshold."""
    return ranks.crossJoin(F.broadcast(threshold(ranks, min_pagerank, drop_bottom_pct))).filter("pagerank >= threshold").drop("threshold")


def induced(edges: DataFrame, keep: DataFrame, key: str, src: str = "src_id", dst: str = "dst_id") -> DataFrame:
    return within(edges, keep, src, dst, key)


def prune(nodes: DataFrame, edges: DataFrame, ranks: DataFrame, key: str, src: str, dst: str, bridge: DataFrame | None = None, **limit: float) -> tuple[DataFrame, ...]:
    """Nodes, edges and, if given, the bridge to pages, restricted to the kept nodes. Pages are not filtered."""
    keep = keep_set(ranks, **limit).select(key)
    out = (nodes.join(keep, key, "left_semi"), induced(edges, keep, key, src, dst))
    return out if bridge is None else (*out, bridge.join(keep, key, "left_semi"))


def ranked(ranks: DataFrame, nodes: DataFrame, key: str = "page_id") -> DataFrame:
    """Every node with its rank from the top, its weak percentile and a status. Global order by a range sort and
    counts per partition, not one window over everything: see positions()."""
    at = positions(ranks.select(key, "pagerank"))
    status = F.when(F.col("percentile") > 99, "Elite").when(F.col("percentile") > 90, "Highly Influential").otherwise("Standard")
    return at.join(nodes, key, "left").withColumn("title", F.coalesce("title", F.lit("UNKNOWN"))).withColumn("status", status)


def positions(ranks: DataFrame) -> DataFrame:
    """rank_position (1 + rows with more) and percentile (share of rows with no more, in percent)."""
    upto = cumulated(ranks).select("pagerank", (F.col("total") - F.col("upto") + 1).alias("rank_position"), (F.col("upto") * 100.0 / F.col("total")).alias("percentile"))
    return ranks.join(upto, "pagerank")


def lookup(nodes: DataFrame, ranks: DataFrame, title: str, key: str = "page_id") -> DataFrame:
    """Rank, percentile and status of the node of that title; no row if there is none. Two counts, no sort."""
    one = nodes.filter(F.col("title") == title.replace(" ", "_")).join(ranks, key).select(key, "title", "pagerank")
    other = ranks.select(F.col("pagerank").alias("other"))
    # one has the few nodes of that title, so the pairs are a constant times the ranks.
    counted = other.crossJoin(F.broadcast(one.select("pagerank").distinct())).groupBy("pagerank").agg((F.count_if(F.col("other") > F.col("pagerank")) + 1).alias("rank_position"), (F.count_if(F.col("other") <= F.col("pagerank")) * 100.0 / F.count("*")).alias("percentile"))
    status = F.when(F.col("percentile") > 99, "Elite").when(F.col("percentile") > 90, "Highly Influential").otherwise("Standard")
    return one.join(F.broadcast(counted), "pagerank").withColumn("status", status)


def top(ranks: DataFrame, nodes: DataFrame, n: int = 20, bottom: bool = False, key: str = "page_id") -> DataFrame:
    """The n highest or lowest with titles; equal ranks by id."""
    order = F.col("pagerank").asc() if bottom else F.col("pagerank").desc()
    return ranks.orderBy(order, key).limit(n).join(nodes, key, "left").withColumn("title", F.coalesce("title", F.lit("UNKNOWN")))

"""Reachability, depths, ancestors and counts over hierarchies: driver loops over staged rounds.

A loop takes as many rounds as the graph is deep, not as it is large; a round is one join on the frontier.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import bounded, replace, scratch, staged


def reach(edges: DataFrame, start: DataFrame, max_depth: int | None = None, src: str = "src", dst: str = "dst") -> DataFrame:
    """(id, depth): what start (column id) reaches along edges, with the least number of steps. Rounds are written to
    parts of one table; a round joins only what the last one added."""
    spark = edges.sparkSession
    links = staged(edges.select(F.col(src).alias("id"), F.col(dst).alias("to")).distinct(), "links")
    path = scratch(spark, "reach")
    kind = start.schema["id"].dataType.simpleString()
    start.select("id").distinct().write.parquet(f"{path}/depth=0")
    depth = 0
    while max_depth is None or depth < max_depth:
        seen = spark.read.schema(f"id {kind}, depth int").option("basePath", path).parquet(path)
        new = seen.filter(F.col("depth") == depth).join(links, "id").select(F.col("to").alias("id")).distinct().join(seen.select("id"), "id", "left_anti")
        depth += 1
        new.write.parquet(f"{path}/depth={depth}")
        if spark.read.schema(f"id {kind}").parquet(f"{path}/depth={depth}").isEmpty():
            break
    return spark.read.schema(f"id {kind}, depth int").option("basePath", path).parquet(path)


def roots(nodes: DataFrame, edges: DataFrame, child: str = "child_id") -> DataFrame:
    """(id): nodes without a parent."""
    return nodes.select("id").distinct().join(edges.select(F.col(child).alias("id")), "id", "left_anti")


def relevant_categories(page_categories: DataFrame, edges: DataFrame, max_depth: int = 5) -> DataFrame:
    """(id): the categories of pages and up to max_depth levels above them."""
    return reach(edges, page_categories.select(F.col("category_id").alias("id")), max_depth, "child_id", "parent_id").select("id")


def category_depths(categories: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, depth): steps from the nearest root; null where no root reaches (cycles)."""
    found = reach(edges, roots(categories, edges), None, "parent_id", "child_id")
    return categories.select("id").distinct().join(found, "id", "left")


def concept_depths(page_categories: DataFrame, depths: DataFrame) -> DataFrame:
    """(id, depth): one more than the least depth of its categories that have one; 0 without any."""
    renamed = (F.col("id").alias("category_id"), "depth")
    known = bounded(depths, *renamed) if hasattr(depths, "scratch_path") else depths.select(*renamed)
    held = page_categories.join(known, "category_id", "left")
    return held.groupBy(F.col("page_id").alias("id")).agg((F.coalesce(F.min("depth"), F.lit(-1)) + 1).alias("depth"))


def closure(edges: DataFrame, src: str = "child_id", dst: str = "parent_id") -> DataFrame:
    """(id, ancestor): all pairs joined by a path of one edge or more; a node on a cycle is not its own ancestor here."""
    links = staged(edges.select(F.col(src).alias("mid"), F.col(dst).alias("ancestor")).distinct().filter("mid <> ancestor"), "links")
    spark = edges.sparkSession
    path, k = scratch(spark, "closure"), 0
    kind = links.schema["mid"].dataType.simpleString()
    links.select(F.col("mid").alias("id"), "ancestor").write.parquet(f"{path}/round=0")
    while True:
        known = spark.read.schema(f"id {kind}, ancestor {kind}, round int").option("basePath", path).parquet(path)
        last = known.filter(F.col("round") == k).select("id", F.col("ancestor").alias("mid"))
        new = last.join(links, "mid").filter("id <> ancestor").select("id", "ancestor").distinct().join(known.select("id", "ancestor"), ["id", "ancestor"], "left_anti")
        k += 1
        new.write.parquet(f"{path}/round={k}")
        if spark.read.schema(f"id {kind}, ancestor {kind}").parquet(f"{path}/round={k}").isEmpty():
            return spark.read.schema(f"id {kind}, ancestor {kind}, round int").option("basePath", path).parquet(path).select("id", "ancestor")


#: Pairs of a hierarchy up to which they go to every task, for `concept_ancestors` (8 bytes a pair).
LOOKUP_PAIRS = 1 << 23


def ancestors_of_concepts(page_categories: DataFrame, pairs: DataFrame) -> DataFrame:
    """(id, ancestor): a concept's categories and all above them."""
    return concept_ancestors(page_categories, pairs).select("id", F.explode("ancestors").alias("ancestor"))


def concept_ancestors(page_categories: DataFrame, pairs: DataFrame, depths: DataFrame | None = None, nodes: DataFrame | None = None) -> DataFrame:
    """(id, ancestors): a concept's categories and all above them, each once; with depths, ordered by depth, then id, where
    a null depth counts as 0. With nodes, the lists of these only, empty ones included.

    Lists are many times as large as the bridge, so they are never dealt out: categories are gathered by concept, and their
    lists are put together row by row from a table that every task has. A hierarchy of more than LOOKUP_PAIRS
    pairs does not fit there; its pairs are joined and dealt out."""
    direct = staged(page_categories.select(F.col("page_id").alias("id"), F.col("category_id").alias("ancestor")), "direct")
    ids = _above(direct, pairs)
    if pairs.count() + ids.count() > LOOKUP_PAIRS:
        above = direct.join(pairs.select(F.col("id").alias("ancestor"), F.col("ancestor").alias("above")), "ancestor").select("id", F.col("above").alias("ancestor"))
        every = direct.union(above).distinct()
        if depths is not None:
            return ancestor_lists(every, depths, nodes)
        return _of_nodes(every.groupBy("id").agg(F.transform(F.collect_list(F.struct("ancestor")), lambda x: x["ancestor"]).alias("ancestors")), "ancestors", nodes)
    order, places, table = _places(ids, pairs, depths)
    held = _placed(direct, places)
    held = _of_nodes(held.repartition("id").groupBy("id").agg(F.collect_set("place").alias("own")), "own", nodes)
    merged = F.array_distinct(F.flatten("own"))
    held = _looked_up(held, "own", table).select("id", (merged if depths is None else F.sort_array(merged)).alias("ancestors"))
    return _looked_up(held, "ancestors", order)


def _above(direct: DataFrame, pairs: DataFrame) -> DataFrame:
    """(ancestor): the categories of concepts and all above others."""
    return staged(direct.select("ancestor").distinct().union(pairs.select("ancestor")).distinct(), "above")


def _places(ids: DataFrame, pairs: DataFrame, depths: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """One row with all ids in order; (place, ancestor): where each is; one row with the list of places at and above each."""
    depth = F.lit(0) if depths is None else F.coalesce("depth", F.lit(0))
    known = ids if depths is None else ids.join(depths.select(F.col("id").alias("ancestor"), "depth"), "ancestor", "left")
    order = staged(known.agg(F.array_sort(F.collect_list(F.struct(depth.alias("d"), F.col("ancestor").alias("id")))).alias("order")).select(F.transform("order", lambda x: x["id"]).alias("ids")), "order")
    places = staged(order.select(F.posexplode("ids").alias("place", "ancestor")), "places")
    up = pairs.select(F.col("id").alias("low"), "ancestor").join(places, "ancestor").select("low", "ancestor", F.col("place").alias("up"))
    lists = places.select(F.col("ancestor").alias("low"), F.col("place").alias("at")).join(up.select("low", "up"), "low").select("at", "up").union(places.select("place", "place"))
    lists = lists.distinct().groupBy("at").agg(F.collect_list("up").alias("list"))
    return order, places, lists.agg(F.array_sort(F.collect_list(F.struct("at", "list"))).alias("all")).select(F.transform("all", lambda x: x["list"]).alias("lists"))


def _placed(direct: DataFrame, places: DataFrame) -> DataFrame:
    """(id, place): direct with the places of categories, the null one too."""
    return direct.join(F.broadcast(places.select("place", F.col("ancestor").alias("category"))), F.col("ancestor").eqNullSafe(F.col("category"))).select("id", "place")


def gathered(direct: DataFrame) -> DataFrame:
    """(id, ancestor): direct, each row once, dealt out by id. Gathering needs no rows that differ, so a bridge that is
    made distinct is not dealt out for that. A set leaves null out, which a flag keeps."""
    c = F.col("ancestor")
    sets = direct.groupBy("id").agg(F.collect_set(c).alias("some"), F.max(c.isNull()).alias("none"))
    return sets.select("id", F.explode(F.when(F.col("none"), F.concat("some", F.array(F.lit(None)))).otherwise(F.col("some"))).alias("ancestor"))


def _looked_up(df: DataFrame, places: str, table: DataFrame) -> DataFrame:
    """df with an array of places replaced by what table, one row of one array, has there. The row comes to the plan as
    the value of a session variable: as a column of a join it would be copied to every row of df, and a subquery may not
    be in a lambda."""
    spark, name = df.sparkSession, f"loom_{uuid.uuid4().hex}"
    table = staged(table, "constant")
    spark.sql(f"DECLARE VARIABLE {name} {table.dtypes[0][1]}")
    try:
        spark.sql(f"SET VARIABLE {name} = (SELECT * FROM {{table}})", table=table)
        return df.withColumn(places, F.transform(places, lambda at: F.get(F.col(name), at)))
    finally:
        spark.sql(f"DROP TEMPORARY VARIABLE {name}")


def _of_nodes(lists: DataFrame, name: str, nodes: DataFrame | None) -> DataFrame:
    if nodes is None:
        return lists
    empty = F.array().cast(lists.schema[name].dataType)
    return nodes.select("id").distinct().join(lists, "id", "left").withColumn(name, F.coalesce(name, empty))


def ancestor_lists(pairs: DataFrame, depths: DataFrame, nodes: DataFrame | None = None) -> DataFrame:
    """(id, ancestors): ordered by depth, then id; a null depth counts as 0. With nodes, also those without any."""
    rows = pairs.join(depths.select(F.col("id").alias("ancestor"), "depth"), "ancestor", "left")
    lists = rows.groupBy("id").agg(F.transform(F.array_sort(F.collect_list(F.struct(F.coalesce("depth", F.lit(0)).alias("d"), F.col("ancestor").alias("a")))), lambda x: x["a"]).alias("ancestors"))
    return _of_nodes(lists, "ancestors", nodes)


def direct_counts(page_categories: DataFrame) -> DataFrame:
    """(id, direct): different pages of each category."""
    return page_categories.distinct().groupBy(F.col("category_id").alias("id")).agg(F.count("*").alias("direct"))


def ordered(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, level): the nodes that a topological sort reaches, by the round in which their last parent was taken;
    nodes on cycles, or below one, are not among them."""
    spark = nodes.sparkSession
    links = staged(edges.select("parent_id", "child_id").distinct(), "links")
    left = staged(nodes.select("id").distinct(), "left")
    path, level = scratch(spark, "levels"), 0
    kind = left.schema["id"].dataType.simpleString()
    while True:
        ready = left.join(links.select(F.col("child_id").alias("id")), "id", "left_anti")
        ready.write.parquet(f"{path}/level={level}")
        taken = spark.read.schema(f"id {kind}").parquet(f"{path}/level={level}")
        if taken.isEmpty():
            return spark.read.schema(f"id {kind}, level int").option("basePath", path).parquet(path)
        left = replace(left, left.join(taken, "id", "left_anti"), "left")
        links = replace(links, links.join(taken, links.parent_id == taken.id, "left_anti"), "links")
        level += 1


def descendant_counts(categories: DataFrame, edges: DataFrame, direct: DataFrame) -> DataFrame:
    """(id, direct, total): total adds the totals of the children, so a concept below two children counts twice. Only
    nodes that a topological sort reaches gather from their children; the others keep their direct count."""
    sorted_ = staged(ordered(categories, edges).select("id"), "ordered")
    links = staged(edges.select("parent_id", F.col("child_id").alias("id")).distinct().join(sorted_.withColumnRenamed("id", "parent_id"), "parent_id", "left_semi"), "links")
    path, k = scratch(edges.sparkSession, "totals"), 0
    spark = edges.sparkSession
    kind = links.schema["id"].dataType.simpleString()
    base = categories.select("id").distinct().join(direct, "id", "left").select("id", F.coalesce("direct", F.lit(0)).cast("long").alias("n"))
    base.write.parquet(f"{path}/round=0")
    while True:
        last = spark.read.schema(f"id {kind}, n long").parquet(f"{path}/round={k}").filter("n > 0")
        up = last.join(links, "id").groupBy(F.col("parent_id").alias("id")).agg(F.sum("n").alias("n"))
        k += 1
        up.write.parquet(f"{path}/round={k}")
        if spark.read.schema(f"id {kind}, n long").parquet(f"{path}/round={k}").isEmpty():
            break
    rounds = spark.read.schema(f"id {kind}, n long, round int").option("basePath", path).parquet(path)
    return rounds.groupBy("id").agg(F.sum(F.when(F.col("round") == 0, F.col("n")).otherwise(0)).alias("direct"), F.sum("n").alias("total"))


def distinct_counts(categories: DataFrame, page_categories: DataFrame, pairs: DataFrame) -> DataFrame:
    """(id, direct, total): pages of a category, and different pages of it and all below it. Both are counted in one pass over
    the categories of each page, by places: those of its own once more, below zero."""
    direct = page_categories.select(F.col("page_id").alias("id"), F.col("category_id").alias("ancestor"))
    ids = _above(direct, pairs)
    if pairs.count() + ids.count() > LOOKUP_PAIRS:
        own = direct_counts(page_categories)
        held = ancestors_of_concepts(page_categories, pairs).groupBy(F.col("ancestor").alias("id")).agg(F.count("*").alias("total"))
        found = held.join(own, "id", "left")
    else:
        _, places, table = _places(ids, pairs)
        held = _placed(gathered(direct), places).groupBy("id").agg(F.collect_list("place").alias("own")).withColumn("all", F.col("own"))
        each = _looked_up(held, "all", table).select(F.explode(F.concat(F.transform("own", lambda p: -1 - p), F.array_distinct(F.flatten("all")))).alias("p"))
        counted = each.groupBy("p").agg(F.count("*").alias("n"))
        here, total = F.col("p") < 0, F.col("p") >= 0
        found = counted.groupBy(F.when(here, -1 - F.col("p")).otherwise(F.col("p")).alias("place")).agg(F.sum(F.when(here, F.col("n"))).alias("direct"), F.sum(F.when(total, F.col("n"))).alias("total"))
        found = found.join(places.select("place", F.col("ancestor").alias("id")), "place").select("id", "direct", "total")
    out = categories.select("id").distinct().join(found, "id", "left")
    return out.select("id", F.coalesce("direct", F.lit(0)).alias("direct"), F.coalesce("total", F.lit(0)).alias("total"))


def keep_counted(counts: DataFrame, min_concepts: int = 1, keep_internal: bool = True) -> DataFrame:
    return counts.filter(F.col("total" if keep_internal else "direct") >= min_concepts)


def depth_histogram(depths: DataFrame, zeros: bool = False) -> DataFrame:
    """(depth, n); with zeros, a row for every depth up to the largest."""
    n = depths.filter("depth IS NOT NULL").groupBy("depth").agg(F.count("*").alias("n"))
    if not zeros:
        return n.orderBy("depth")
    all_ = depths.agg(F.max("depth").alias("m")).filter("m IS NOT NULL").select(F.explode(F.sequence(F.lit(0), F.col("m").cast("int"))).alias("depth"))
    return all_.join(n, "depth", "left").select("depth", F.coalesce("n", F.lit(0)).alias("n")).orderBy("depth")


def parents_distribution(edges: DataFrame) -> DataFrame:
    """(parents, children): how many children have how many parents."""
    per = edges.groupBy("child_id").agg(F.count("*").alias("parents"))
    return per.groupBy("parents").agg(F.count("*").alias("children")).orderBy("parents")


def pointers_to_root(parents: DataFrame) -> DataFrame:
    """(id, path): from each node along its one parent (columns id, parent_id) to the top, itself first. Paths double
    in each round, so rounds are the logarithm of the depth; a node on a cycle stops where it would come again."""
    state = staged(parents.select("id", F.when(F.col("parent_id").isNotNull(), F.array("id", "parent_id")).otherwise(F.array("id")).alias("path")).dropDuplicates(["id"]), "paths")
    while True:
        other = state.select(F.col("id").alias("last"), F.col("path").alias("more"))
        joined = state.withColumn("last", F.element_at("path", -1)).join(other, "last", "left")
        tail = F.when((F.size("more") > 1) & (F.size(F.array_intersect("path", F.slice("more", 2, 1_000_000))) == 0), F.slice("more", 2, 1_000_000)).otherwise(F.array().cast(state.schema["path"].dataType))
        new = joined.select("id", F.concat("path", tail).alias("path"), (F.size(tail) > 0).alias("grew"))
        state = replace(state, new, "paths")
        if state.filter("grew").isEmpty():
            return state.select("id", "path")
        path = state.scratch_path
        state = state.select("id", "path")
        state.scratch_path = path


def sample_per_group(nodes: DataFrame, n: int = 3) -> DataFrame:
    """The first n nodes by id of each depth and type."""
    return nodes.withColumn("nth", F.row_number().over(Window.partitionBy("depth", "node_type").orderBy("node_id"))).filter(F.col("nth") <= n)

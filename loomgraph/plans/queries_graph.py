"""Queries on the link graph: ranks, degrees, detectors, hierarchies."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as fixed
from ..operators import closure as up
from ..operators import degrees as deg
from ..operators import pagerank as pr
from ..operators import trim
from ..runtime import staged
from .derived import derived, oracle

QUERIES: dict[str, Callable] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def rank_sql(rounds: int) -> str:
    """CTEs r0 .. r<rounds> (page_id, pagerank) for the link graph; every link end is a node."""
    ctes = [
        "n AS (SELECT count(*) AS n FROM nodes)",
        "w AS (SELECT src_id, dst_id, count(*) AS weight FROM links GROUP BY 1, 2)",
        "shares AS (SELECT src_id, dst_id, weight * 1.0 / sum(weight) OVER (PARTITION BY src_id) AS share FROM w)",
        "r0 AS (SELECT page_id, 1.0::DOUBLE / n AS pagerank FROM nodes, n)",
    ]
    for i in range(1, rounds + 1):
        ctes += [
            f"d{i} AS MATERIALIZED (SELECT coalesce(sum(pagerank), 0) AS lost FROM r{i - 1} WHERE page_id NOT IN (SELECT src_id FROM w))",
            f"c{i} AS MATERIALIZED (SELECT dst_id, sum(pagerank * share) AS got FROM r{i - 1} JOIN shares ON src_id = page_id GROUP BY dst_id)",
            f"r{i} AS MATERIALIZED (SELECT page_id, 0.15::DOUBLE / n + 0.85::DOUBLE * (coalesce(got, 0) + lost / n) AS pagerank FROM r{i - 1} LEFT JOIN c{i} ON dst_id = page_id, d{i}, n)",
        ]
    return ", " + ", ".join(ctes) + " "


def ranks(spark, sf) -> DataFrame:
    return pr.pagerank(derived(spark, sf, "nodes"), derived(spark, sf, "links"), max_iter=3, tol=None).withColumn("pagerank", F.round("pagerank", 12))


ROUNDED = "ranks AS (SELECT page_id, round(pagerank, 12) AS pagerank FROM r3) "


@query(oracle("nodes", "links", body=rank_sql(3) + ", " + ROUNDED + "SELECT page_id, title, round(pagerank, 9) AS pagerank FROM ranks JOIN nodes USING (page_id) ORDER BY ranks.pagerank DESC, page_id LIMIT 20"))
def g1_pagerank_top(spark, sf):
    return pr.top(ranks(spark, sf), derived(spark, sf, "nodes")).select("page_id", "title", F.round("pagerank", 9).alias("pagerank"))


@query(oracle("nodes", "links", body=rank_sql(3) + "SELECT page_id, round(pagerank / (SELECT sum(pagerank) FROM r3), 9) AS pagerank FROM r3"))
def g2_pagerank_normalized(spark, sf):
    out = pr.pagerank(derived(spark, sf, "nodes"), derived(spark, sf, "links"), max_iter=3, tol=None, normalize=True)
    return out.select("page_id", F.round("pagerank", 9).alias("pagerank"))


@query(oracle("nodes", "links", body=rank_sql(3) + "SELECT page_id, title, round(pagerank, 9) AS pagerank FROM r3 JOIN nodes USING (page_id) ORDER BY round(r3.pagerank, 12), page_id LIMIT 10"))
def t1_pagerank_bottom(spark, sf):
    return pr.top(ranks(spark, sf), derived(spark, sf, "nodes"), 10, bottom=True).select("page_id", "title", F.round("pagerank", 9).alias("pagerank"))


@query(oracle("nodes", "links", body=rank_sql(30) + "SELECT page_id, round(pagerank, 9) AS pagerank FROM r30"))
def g1_pagerank_converged(spark, sf):
    """All thirty rounds."""
    out = pr.pagerank(derived(spark, sf, "nodes"), derived(spark, sf, "links"), max_iter=30, tol=None)
    return out.select("page_id", F.round("pagerank", 9).alias("pagerank"))


@query(oracle("tree", body=", ids AS (SELECT p_partkey AS id FROM part), n AS (SELECT count(*) AS n FROM ids), d0 AS (SELECT count(*) AS c FROM ids WHERE id NOT IN (SELECT child_id FROM tree)) SELECT id, round(0.15 / n + 0.85 * ((SELECT count(*) FROM tree WHERE parent_id = id) * 1.0 / n + c * 1.0 / n / n), 12) AS pagerank FROM ids, n, d0"))
def g1_category_rank(spark, sf):
    """One round, from child to parent."""
    t = derived(spark, sf, "tree")
    return pr.pagerank(derived(spark, sf, "categories"), t, "id", "child_id", "parent_id", max_iter=1, tol=None).withColumn("pagerank", F.round("pagerank", 12))


@query(oracle("nodes", "links", body=rank_sql(3) + ", " + ROUNDED + "SELECT count(*) AS n, round(sum(pagerank), 6) AS sum_rank, round(min(pagerank), 9) AS min_rank, round(max(pagerank), 9) AS max_rank, round(avg(pagerank), 9) AS avg_rank, " + ", ".join(f"round(quantile_cont(pagerank, {p / 100}), 9) AS p{p:02d}" for p in (1, 5, 10, 25, 50, 75, 90, 95, 99)) + " FROM ranks"))
def a3_rank_stats(spark, sf):
    one = pr.rank_stats(ranks(spark, sf))
    return one.select("n", *(F.round(c, 6 if c == "sum_rank" else 9).alias(c) for c in one.columns[1:]))


@query(oracle("nodes", "links", body=rank_sql(3) + ", " + ROUNDED + "SELECT page_id, round(pagerank, 9) AS pagerank FROM ranks WHERE pagerank >= (SELECT quantile_cont(pagerank, 0.2) FROM ranks)"))
def a4_keep_top80(spark, sf):
    return pr.keep_set(ranks(spark, sf), drop_bottom_pct=20).withColumn("pagerank", F.round("pagerank", 9))


@query(oracle("nodes", "links", body=rank_sql(3) + ", " + ROUNDED + ", keep AS (SELECT page_id FROM ranks WHERE pagerank >= (SELECT quantile_cont(pagerank, 0.75) FROM ranks)) SELECT src_id, dst_id, count(*) AS n FROM links WHERE src_id IN (SELECT page_id FROM keep) AND dst_id IN (SELECT page_id FROM keep) GROUP BY 1, 2"))
def a5_filter_by_percentile(spark, sf):
    keep = pr.keep_set(ranks(spark, sf), drop_bottom_pct=75)
    return pr.induced(derived(spark, sf, "links"), keep, "page_id").groupBy("src_id", "dst_id").agg(F.count("*").alias("n"))


@query(oracle("nodes", "links", body=rank_sql(3) + ", " + ROUNDED + "SELECT page_id, title FROM ranks JOIN nodes USING (page_id) WHERE pagerank >= 0.0005"))
def j10_prune_nodes(spark, sf):
    return pr.prune(derived(spark, sf, "nodes"), derived(spark, sf, "links"), ranks(spark, sf), "page_id", "src_id", "dst_id", min_pagerank=0.0005)[0]


@query(oracle("nodes", "links", "bridge", body=rank_sql(3) + ", " + ROUNDED + "SELECT page_id, category_id FROM bridge WHERE category_id IN (SELECT page_id FROM ranks WHERE pagerank >= (SELECT quantile_cont(pagerank, 0.9) FROM ranks))"))
def j12_prune_bridge(spark, sf):
    r = ranks(spark, sf).withColumnRenamed("page_id", "category_id")
    empty = derived(spark, sf, "tree")
    return pr.prune(derived(spark, sf, "categories").drop("id"), empty, r, "category_id", "parent_id", "child_id", derived(spark, sf, "bridge"), drop_bottom_pct=90)[2].select("page_id", "category_id")


@query(oracle("nodes", "links", body=rank_sql(3) + ", " + ROUNDED + "SELECT page_id, title, rank() OVER (ORDER BY pagerank DESC) AS rank_position, round(cume_dist() OVER (ORDER BY pagerank) * 100, 9) AS percentile FROM ranks JOIN nodes USING (page_id)"))
def w1_rank_positions(spark, sf):
    return pr.ranked(ranks(spark, sf), derived(spark, sf, "nodes")).select("page_id", "title", "rank_position", F.round("percentile", 9).alias("percentile"))


@query(oracle("nodes", "links", body=rank_sql(3) + ", " + ROUNDED + ", one AS (SELECT page_id, title, pagerank AS p FROM ranks JOIN nodes USING (page_id) WHERE page_id = 13) SELECT page_id, title, (SELECT count(*) FROM ranks WHERE pagerank > p) + 1 AS rank_position, round((SELECT count(*) FROM ranks WHERE pagerank <= p) * 100.0 / (SELECT count(*) FROM ranks), 9) AS percentile FROM one"))
def w1_rank_lookup(spark, sf):
    nodes = derived(spark, sf, "nodes")
    title = nodes.filter("page_id = 13").first().title
    return pr.lookup(nodes, ranks(spark, sf), title).select("page_id", "title", "rank_position", F.round("percentile", 9).alias("percentile"))


DEGREES = ", d AS (SELECT page_id, title, (SELECT count(*) FROM links WHERE dst_id = page_id) AS in_degree, (SELECT count(*) FROM links WHERE src_id = page_id) AS out_degree FROM nodes), deg AS (SELECT *, in_degree / (out_degree + 1) AS in_out_ratio FROM d) "


def degrees(spark, sf) -> DataFrame:
    return deg.degrees(derived(spark, sf, "nodes"), derived(spark, sf, "links"))


@query(oracle("nodes", "links", body=DEGREES + "SELECT page_id, in_degree, out_degree, round(in_out_ratio, 9) AS in_out_ratio FROM deg"))
def a1_degrees(spark, sf):
    return degrees(spark, sf).select("page_id", "in_degree", "out_degree", F.round("in_out_ratio", 9).alias("in_out_ratio"))


@query(oracle("nodes", "links", body=DEGREES + "SELECT count(*) AS n, " + ", ".join(f"round(avg({c}), 9) AS {c}_mean, quantile_cont({c}, 0.5) AS {c}_median, max({c}) AS {c}_max, count(*) FILTER (WHERE {c} = 0) AS {c}_zero" for c in ("in_degree", "out_degree")) + " FROM deg"))
def a1_degree_stats(spark, sf):
    one = deg.degree_stats(degrees(spark, sf))
    return one.withColumns({c: F.round(c, 9) for c in ("in_degree_mean", "out_degree_mean")})


@query(oracle("links", body="SELECT src_id AS src, dst_id AS dst, count(*) AS weight FROM links GROUP BY 1, 2"))
def a18_edge_weights(spark, sf):
    return pr.weighted(derived(spark, sf, "links"))


@query(oracle("nodes", "links", body=DEGREES + "SELECT page_id, in_degree, out_degree, out_degree < 50 AS low_out FROM deg ORDER BY in_degree DESC, page_id LIMIT 30"))
def t2_top_hubs(spark, sf):
    return deg.top_hubs(degrees(spark, sf)).select("page_id", "in_degree", "out_degree", "low_out")


def upward(sql: str) -> str:
    return sql.replace("FROM links", "FROM upward")


def upward_degrees(spark, sf) -> DataFrame:
    return deg.degrees(derived(spark, sf, "nodes"), derived(spark, sf, "upward"))


@query(oracle("nodes", "upward", body=upward(DEGREES) + "SELECT page_id, in_degree FROM deg WHERE out_degree = 0 ORDER BY in_degree DESC, page_id LIMIT 50"))
def t3_top_dangling(spark, sf):
    return deg.top_dangling(upward_degrees(spark, sf)).select("page_id", "in_degree")


@query(oracle("nodes", "links", body=DEGREES + "SELECT page_id, in_degree FROM deg WHERE in_degree > 20 AND out_degree < 25 ORDER BY in_degree DESC, page_id LIMIT 50"))
def t4_lopsided(spark, sf):
    return deg.top_lopsided(degrees(spark, sf), min_in=20, max_out=25).select("page_id", "in_degree")


def any_of(words, column="lower(title)") -> str:
    return "(" + " OR ".join(f"contains({column}, '{w}')" for w in words) + ")"


DETECT = {
    "ratio": "in_degree >= 20 AND in_out_ratio >= 1 AND out_degree <= 25",
    "pattern": f"((regexp_matches(title, '_\\(identifier\\)$') OR regexp_matches(title, '^H:[A-Z]+$')) AND in_degree >= 5) OR ({any_of(fixed.DATABASE_KEYWORDS)} AND in_degree >= 25 AND out_degree < 200)",
    "citation": f"{any_of(fixed.CITATION_KEYWORDS)} AND in_degree >= 5 AND in_out_ratio > 1",
    "dangling": "out_degree = 0 AND in_degree >= 1",
}


def detected(spark, sf) -> dict[str, DataFrame]:
    d = degrees(spark, sf)
    return {"ratio": deg.by_ratio(d, 20, 1, 25), "pattern": deg.by_title(d, 5), "citation": deg.by_citation(d, 5, 1), "dangling": deg.by_dangling(d, 1)}


for _name, _test in DETECT.items():

    def _detector(spark, sf, name=_name):
        return deg.by_dangling(upward_degrees(spark, sf), 1) if name == "dangling" else detected(spark, sf)[name]

    _detector.__name__ = f"c_detect_{_name}"
    _graph, _degrees = ("upward", upward(DEGREES)) if _name == "dangling" else ("links", DEGREES)
    query(oracle("nodes", _graph, body=_degrees + f"SELECT title, '{_name}' AS source FROM deg WHERE {_test}"))(_detector)

FOUND = ", found AS (" + " UNION ALL ".join(f"SELECT title, '{k}' AS source FROM deg WHERE {v}" for k, v in {"ratio": "in_degree >= 10 AND in_out_ratio >= 100 AND out_degree <= 200", "pattern": DETECT["pattern"].replace(">= 5)", ">= 2)").replace(">= 25", ">= 10"), "citation": DETECT["citation"].replace(">= 5", ">= 2").replace("> 1", "> 10"), "dangling": DETECT["dangling"]}.items()) + ") "


@query(oracle("nodes", "links", body=DEGREES + FOUND + "SELECT title, array_to_string(list_sort(list(DISTINCT source)), ',') AS sources FROM found GROUP BY title"))
def u1_exclusions(spark, sf):
    return deg.exclusions(degrees(spark, sf), 2).select("title", F.array_join("sources", ",").alias("sources"))


@query(oracle("nodes", "upward", body=upward(DEGREES) + FOUND + "SELECT title, array_to_string(list_sort(list(DISTINCT source)), ',') AS sources FROM found GROUP BY title"))
def u1_exclusions_upward(spark, sf):
    """With pages that have no links of their own."""
    return deg.exclusions(upward_degrees(spark, sf), 2).select("title", F.array_join("sources", ",").alias("sources"))


@query(oracle("nodes", "links", body=DEGREES + FOUND + ", t AS (SELECT DISTINCT title FROM found) SELECT (SELECT count(*) FROM deg WHERE title IN (SELECT title FROM t)) AS nodes, CAST((SELECT coalesce(sum(in_degree), 0) FROM deg WHERE title IN (SELECT title FROM t)) AS BIGINT) AS links, round((SELECT coalesce(sum(in_degree), 0) FROM deg WHERE title IN (SELECT title FROM t)) / (SELECT sum(in_degree) FROM deg), 9) AS share"))
def a19_excluded_share(spark, sf):
    d = degrees(spark, sf)
    return deg.excluded_share(d, deg.exclusions(d, 2)).withColumn("share", F.round("share", 9))


@query(oracle("nodes", "links", body=DEGREES + FOUND + "SELECT page_id, in_degree FROM deg WHERE title NOT IN (SELECT title FROM found) ORDER BY in_degree DESC, page_id LIMIT 30"))
def t5_hubs_after_exclusion(spark, sf):
    d = degrees(spark, sf)
    return deg.top_hubs_after(d, deg.exclusions(d, 2)).select("page_id", "in_degree")


@query(oracle("nodes", "links", body=DEGREES + f"SELECT title FROM deg WHERE (in_degree > 25 AND out_degree < 20) OR ({any_of(fixed.RECOMMENDER_KEYWORDS)} AND in_degree > 1000) OR (out_degree = 0 AND in_degree > 5)"))
def c9_recommend(spark, sf):
    return deg.recommend(degrees(spark, sf), 5, 20)


@query(oracle("nodes", body="SELECT page_id, title FROM nodes WHERE title IS NULL OR title NOT IN (SELECT title FROM nodes WHERE starts_with(title, 'List_of_'))"))
def f7_exclude_titles(spark, sf):
    nodes = derived(spark, sf, "nodes")
    return pr.without_titles(nodes, nodes.filter(F.col("title").startswith("List_of_")).select("title")).select("page_id", "title")


# Hierarchies.

DEPTHS = ", dep AS (SELECT id, 0 AS depth FROM {cats} WHERE id NOT IN (SELECT child_id FROM {edges}) UNION SELECT child_id, depth + 1 FROM dep JOIN {edges} ON parent_id = dep.id), depths AS (SELECT id, min(depth) AS depth FROM dep GROUP BY id) "
ABOVE = ", up AS (SELECT child_id AS id, parent_id AS ancestor FROM {edges} UNION SELECT up.id, parent_id FROM up JOIN {edges} ON child_id = ancestor) "


def of(sql: str, cats: str = "scats", edges: str = "sdag") -> str:
    return sql.replace("{cats}", cats).replace("{edges}", edges)


@query(oracle("categories", "tree", recursive=True, body=of(DEPTHS, "categories", "tree") + "SELECT id, CAST(depth AS INT) AS depth FROM depths"))
def g5_category_depths(spark, sf):
    return up.category_depths(derived(spark, sf, "categories"), derived(spark, sf, "tree"))


@query(oracle("scats", "sdag", "sbridge", recursive=True, body=of(DEPTHS) + "SELECT page_id AS id, CAST(min(depth) + 1 AS INT) AS depth FROM sbridge JOIN depths ON id = category_id GROUP BY 1"))
def g5_concept_depths(spark, sf):
    d = up.category_depths(derived(spark, sf, "scats"), derived(spark, sf, "sdag"))
    return up.concept_depths(derived(spark, sf, "sbridge"), d).withColumn("depth", F.col("depth").cast("int"))


@query(oracle("tree", recursive=True, body=", r AS (SELECT 5::BIGINT AS id, 0 AS depth UNION SELECT child_id, depth + 1 FROM r JOIN tree ON parent_id = r.id) SELECT id, CAST(min(depth) AS INT) AS depth FROM r GROUP BY id"))
def g12_reachable(spark, sf):
    return up.reach(derived(spark, sf, "tree"), spark.createDataFrame([(5,)], "id long"), None, "parent_id", "child_id")


@query(oracle("sdag", "sbridge", recursive=True, body=", r AS (SELECT DISTINCT category_id AS id, 0 AS d FROM sbridge WHERE category_id NOT IN (SELECT parent_id FROM sdag) UNION SELECT parent_id, d + 1 FROM r JOIN sdag ON child_id = id WHERE d < 2) SELECT DISTINCT id FROM r"))
def g4_relevant_categories(spark, sf):
    """Of pages in categories that have no children."""
    e = derived(spark, sf, "sdag")
    held = derived(spark, sf, "sbridge").join(e.select(F.col("parent_id").alias("category_id")), "category_id", "left_anti")
    return up.relevant_categories(held, e, 2)


@query(oracle("sdag", recursive=True, body=of(ABOVE) + "SELECT id, ancestor FROM up WHERE id <> ancestor"))
def g7_closure(spark, sf):
    return up.closure(derived(spark, sf, "sdag"))


@query(oracle("scats", "sdag", recursive=True, body=of(DEPTHS) + of(ABOVE) + "SELECT id, string_agg(CAST(ancestor AS VARCHAR), ',' ORDER BY d.depth, ancestor) AS ancestors FROM up JOIN (SELECT id AS a, depth FROM depths) d ON a = ancestor GROUP BY id"))
def g7_ancestor_lists(spark, sf):
    e = derived(spark, sf, "sdag")
    lists = up.ancestor_lists(up.closure(e), up.category_depths(derived(spark, sf, "scats"), e))
    return lists.select("id", F.array_join(F.col("ancestors").cast("array<string>"), ",").alias("ancestors"))


@query(oracle("sdag", "sbridge", recursive=True, body=of(ABOVE) + "SELECT id, count(*) AS n FROM (SELECT page_id AS id, category_id AS a FROM sbridge UNION SELECT page_id, ancestor FROM sbridge JOIN up ON up.id = category_id) GROUP BY id"))
def g7_concept_ancestors(spark, sf):
    lists = up.concept_ancestors(derived(spark, sf, "sbridge"), up.closure(derived(spark, sf, "sdag")))
    return lists.select("id", F.size("ancestors").cast("long").alias("n"))


@query(oracle("bridge", body="SELECT category_id AS id, count(DISTINCT page_id) AS direct FROM bridge GROUP BY 1"))
def a7_direct_counts(spark, sf):
    return up.direct_counts(derived(spark, sf, "bridge"))


@query(oracle("scats", "sdag", "sbridge", recursive=True, body=", walks AS (SELECT parent_id AS top, child_id AS low, [parent_id, child_id] AS way FROM sdag UNION ALL SELECT top, child_id, list_append(way, child_id) FROM walks JOIN sdag ON parent_id = low), direct AS (SELECT id, (SELECT count(*) FROM sbridge WHERE category_id = id) AS direct FROM scats) SELECT d.id, d.direct, CAST(d.direct + coalesce((SELECT sum(x.direct) FROM walks JOIN direct x ON x.id = low WHERE top = d.id), 0) AS BIGINT) AS total FROM direct d"))
def a8_descendant_counts(spark, sf):
    b = derived(spark, sf, "sbridge")
    return up.descendant_counts(derived(spark, sf, "scats"), derived(spark, sf, "sdag"), up.direct_counts(b))


COUNTS = ", direct AS (SELECT id, (SELECT count(*) FROM sbridge WHERE category_id = id) AS direct FROM scats), below AS (SELECT id AS top, id AS low FROM scats UNION SELECT ancestor, id FROM up), counts AS (SELECT direct.id, direct, (SELECT count(DISTINCT page_id) FROM below JOIN sbridge ON category_id = low WHERE top = direct.id) AS total FROM direct) "


def counts(spark, sf) -> DataFrame:
    return up.distinct_counts(derived(spark, sf, "scats"), derived(spark, sf, "sbridge"), up.closure(derived(spark, sf, "sdag")))


@query(oracle("scats", "sdag", "sbridge", recursive=True, body=of(ABOVE) + COUNTS + "SELECT id, direct, total FROM counts"))
def a9_distinct_counts(spark, sf):
    return counts(spark, sf)


@query(oracle("scats", "sdag", "sbridge", recursive=True, body=of(ABOVE) + COUNTS + "SELECT id, direct, total FROM counts WHERE total >= 700"))
def a10_min_counts(spark, sf):
    return up.keep_counted(counts(spark, sf), 700)


@query(oracle("categories", "tree", recursive=True, body=of(DEPTHS, "categories", "tree") + "SELECT CAST(depth AS INT) AS depth, count(*) AS n FROM depths GROUP BY 1"))
def a11_depth_histogram(spark, sf):
    return up.depth_histogram(up.category_depths(derived(spark, sf, "categories"), derived(spark, sf, "tree")), zeros=True)


@query(oracle("dag", body="SELECT parents, count(*) AS children FROM (SELECT child_id, count(*) AS parents FROM dag GROUP BY 1) GROUP BY 1"))
def a13_parents_distribution(spark, sf):
    return up.parents_distribution(derived(spark, sf, "dag"))


@query(oracle("dag", body="SELECT DISTINCT parent_id AS id FROM dag WHERE parent_id NOT IN (SELECT child_id FROM dag)"))
def u5_roots(spark, sf):
    e = derived(spark, sf, "dag")
    return up.roots(e.select(F.col("parent_id").alias("id")), e)


@query(oracle("categories", "tree", recursive=True, body=", p AS (SELECT p_partkey AS id, CAST(p_partkey AS VARCHAR) AS path, p_partkey AS last FROM part UNION ALL SELECT p.id, path || ',' || parent_id, parent_id FROM p JOIN tree ON child_id = last) SELECT id, max_by(path, length(path)) AS path FROM p GROUP BY id"))
def g17_pointers(spark, sf):
    parents = derived(spark, sf, "categories").select("id").join(derived(spark, sf, "tree").withColumnRenamed("child_id", "id"), "id", "left")
    return up.pointers_to_root(parents).select("id", F.array_join(F.col("path").cast("array<string>"), ",").alias("path"))


@query(oracle("cyclic", recursive=True, body=", up AS (SELECT child_id AS id, parent_id AS ancestor FROM cyclic UNION SELECT up.id, parent_id FROM up JOIN cyclic ON child_id = ancestor), pairs AS (SELECT a.id, a.ancestor FROM up a JOIN up b ON a.id = b.ancestor AND a.ancestor = b.id WHERE a.id <> a.ancestor) SELECT id, least(id, min(ancestor)) AS component FROM pairs GROUP BY id"))
def g8_strong_components(spark, sf):
    return trim.strong_components(derived(spark, sf, "cyclic"))


@query(oracle("cyclic", recursive=True, body=", up AS (SELECT child_id AS id, parent_id AS ancestor FROM cyclic UNION SELECT up.id, parent_id FROM up JOIN cyclic ON child_id = ancestor) SELECT child_id, parent_id FROM cyclic WHERE child_id = parent_id OR (parent_id >= child_id AND (parent_id, child_id) IN (SELECT (id, ancestor) FROM up))"))
def g8_cycle_edges(spark, sf):
    e = derived(spark, sf, "cyclic")
    return trim.cycle_edges(e, up.category_depths(e.select(F.col("child_id").alias("id")), e))


def _trim_sql(rounds: int = 16) -> str:
    out = ", pages AS (SELECT category_id AS id, count(*) AS pages FROM bridge GROUP BY 1), k0 AS (SELECT c.id, coalesce(pages, 0) AS pages FROM categories c LEFT JOIN pages USING (id))"
    for i in range(1, rounds + 1):
        out += f", k{i} AS (SELECT * FROM k{i - 1} WHERE pages >= 30 OR id = 1 OR id IN (SELECT parent_id FROM tree WHERE child_id IN (SELECT id FROM k{i - 1})))"
    return out + f" SELECT id FROM k{rounds}"


@query(oracle("categories", "tree", "bridge", body=_trim_sql()))
def g13_trim_leaves(spark, sf):
    return trim.trim_leaves(derived(spark, sf, "categories"), derived(spark, sf, "tree"), derived(spark, sf, "bridge"), 1, 30)


@query(oracle("scats", "sdag", "sbridge", recursive=True, body=of(ABOVE) + ", held AS (SELECT * FROM sbridge WHERE category_id IN (SELECT id FROM scats WHERE starts_with(title, 'Physics'))) SELECT id FROM scats WHERE id IN (SELECT category_id FROM held) OR id IN (SELECT ancestor FROM up JOIN held ON category_id = up.id)"))
def g9_without_orphans(spark, sf):
    """Where only physics has pages."""
    cats = derived(spark, sf, "scats")
    held = derived(spark, sf, "sbridge").join(cats.filter(F.col("title").startswith("Physics")).select("category_id"), "category_id", "left_semi")
    return trim.without_orphans(cats, derived(spark, sf, "sdag"), held)[0]


@query(oracle("scats", "sdag", "sbridge", recursive=True, body=", kept AS (SELECT * FROM sdag WHERE child_id IN (SELECT id FROM scats WHERE NOT starts_with(title, 'Plants')))" + of(ABOVE, edges="kept") + ", below AS (SELECT id AS top, id AS low FROM scats UNION SELECT ancestor, id FROM up) SELECT id FROM scats WHERE id NOT IN (SELECT child_id FROM kept) AND (SELECT count(DISTINCT page_id) FROM below JOIN sbridge ON category_id = low WHERE top = scats.id) < 1000"))
def g10_weak_roots(spark, sf):
    """Where plants have lost their parents."""
    cats = derived(spark, sf, "scats")
    e = derived(spark, sf, "sdag").join(cats.filter(~F.col("title").startswith("Plants")).select(F.col("id").alias("child_id")), "child_id", "left_semi")
    return trim.weak_roots(cats, e, derived(spark, sf, "sbridge"), 1000)


@query(oracle("scats", "sdag", body=", keep AS (SELECT id FROM scats WHERE NOT starts_with(title, 'Countries')) SELECT parent_id, child_id FROM sdag WHERE parent_id IN (SELECT id FROM keep) AND child_id IN (SELECT id FROM keep)"))
def j11_induced_edges(spark, sf):
    return trim.restrict(derived(spark, sf, "sdag"), derived(spark, sf, "scats").filter(~F.col("title").startswith("Countries")))


@query(oracle("scats", "sdag", recursive=True, body=of(ABOVE) + "SELECT id FROM scats WHERE id = 2 OR id IN (SELECT up.id FROM up WHERE ancestor = 2)"))
def g14_connected(spark, sf):
    return trim.connected(derived(spark, sf, "scats"), derived(spark, sf, "sdag"), 2)


@query(oracle("scats", "sdag", recursive=True, body=", l AS (SELECT id, 0 AS n FROM scats UNION SELECT child_id, n + 1 FROM l JOIN sdag ON parent_id = l.id) SELECT id, CAST(max(n) AS INT) AS level FROM l GROUP BY id"))
def g6_topological_levels(spark, sf):
    return up.ordered(derived(spark, sf, "scats"), derived(spark, sf, "sdag"))


@query(oracle("nodes", "links", body=rank_sql(3) + ", " + ROUNDED + "SELECT page_id, round(pagerank, 9) AS pagerank FROM ranks"))
def k4_staged_ranks(spark, sf):
    """Ranks written and read back."""
    return staged(ranks(spark, sf)).withColumn("pagerank", F.round("pagerank", 9))

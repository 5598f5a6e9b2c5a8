"""Queries on the unified graph and the semantic tree."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as fixed
from ..operators import closure as up
from ..operators import knowledge_graph as kg
from ..operators import lookup, tree, trim, validate
from ..runtime import made, remove
from .derived import derived, oracle
from .queries_graph import ABOVE, COUNTS, DEPTHS, of

QUERIES: dict[str, Callable] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def built(spark, sf) -> kg.Graph:
    return kg.build(derived(spark, sf, "visual"), derived(spark, sf, "sbridge"), derived(spark, sf, "scats"), derived(spark, sf, "sdag"), max_depth=10)


def cleaned(spark, sf):
    """The graph after cleaning, and what that took away. The tables of the graph before go when nothing reads them any more."""
    with made() as paths:
        graph = built(spark, sf)
    return kg.clean(graph, min_root_concepts=5, read=lambda: [remove(spark, path) for path in paths])


# Every supplier has items, so every category stays; orders and suppliers share ids, so category ids move.
MOVED = ", shift AS (SELECT max(o_orderkey) + 1 AS s FROM orders) "
KG_NODES = of(ABOVE) + of(DEPTHS) + MOVED + """, live AS (SELECT id, title FROM scats WHERE id > 0),
 walks AS (SELECT parent_id AS top, child_id AS low FROM sdag UNION ALL SELECT top, child_id FROM walks JOIN sdag ON parent_id = low),
 direct AS (SELECT id, (SELECT count(*) FROM sbridge WHERE category_id = id) AS direct FROM live),
 totals AS (SELECT d.id, d.direct, CAST(d.direct + coalesce((SELECT sum(x.direct) FROM walks JOIN direct x ON x.id = low WHERE top = d.id), 0) AS BIGINT) AS total FROM direct d),
 cd AS (SELECT page_id, min(depth) + 1 AS depth FROM sbridge JOIN depths ON id = category_id GROUP BY 1),
 kgn AS (SELECT page_id AS node_id, page_id AS original_id, title, 'concept' AS node_type, coalesce(depth, 0) AS depth, 1 AS direct, 1 AS total, 1.0::DOUBLE AS spec FROM visual LEFT JOIN cd USING (page_id)
 UNION ALL SELECT id + s, id, title, 'category', coalesce(depth, 0), direct, total, CASE WHEN total = 0 THEN 1.0::DOUBLE ELSE 1 / ln(1 + total) END FROM live JOIN totals USING (id) LEFT JOIN depths USING (id), shift) """


@query(oracle("scats", "sdag", "sbridge", "visual", recursive=True, body=KG_NODES + "SELECT node_id, original_id, title, node_type, CAST(depth AS INT) AS depth, round(depth / (SELECT max(depth) FROM kgn), 9) AS normalized_depth, CAST(direct AS BIGINT) AS direct_concept_count, CAST(total AS BIGINT) AS total_concept_count, round(spec, 9) AS specificity_score FROM kgn"))
def p4_build_nodes(spark, sf):
    n = built(spark, sf)["nodes"]
    return n.select("node_id", "original_id", "title", "node_type", F.col("depth").cast("int").alias("depth"), F.round("normalized_depth", 9).alias("normalized_depth"), "direct_concept_count", "total_concept_count", F.round("specificity_score", 9).alias("specificity_score"))


@query(oracle("sdag", "sbridge", "visual", body=MOVED + "SELECT page_id AS src_id, category_id + s AS dst_id, 'belongs_to' AS edge_type FROM sbridge, shift WHERE page_id IN (SELECT page_id FROM visual) UNION ALL SELECT child_id + s, parent_id + s, 'child_of' FROM sdag, shift"))
def p4_build_edges(spark, sf):
    return built(spark, sf)["edges"].select("src_id", "dst_id", "edge_type")


@query(oracle("scats", "visual", body=MOVED + "SELECT lower(title) AS title_lower, title, page_id AS node_id, 'concept' AS node_type FROM visual UNION ALL SELECT lower(title), title, id + s, 'category' FROM scats, shift WHERE id > 0"))
def p4_build_title_index(spark, sf):
    return built(spark, sf)["title_index"]


@query(oracle("sdag", "sbridge", "visual", recursive=True, body=of(ABOVE) + MOVED + ", c AS (SELECT page_id AS id, category_id AS a FROM sbridge UNION SELECT page_id, ancestor FROM sbridge JOIN up ON up.id = category_id) SELECT page_id AS node_id, count(a) AS n, CAST(coalesce(sum(a + s), 0) AS BIGINT) AS total FROM visual LEFT JOIN c ON c.id = page_id, shift GROUP BY 1"))
def p4_build_ancestors(spark, sf):
    a = built(spark, sf)["ancestors"]
    return a.select("node_id", F.size("ancestors").cast("long").alias("n"), F.aggregate("ancestors", F.lit(0).cast("bigint"), lambda x, y: x + y).alias("total"))


#: The ledger: what a check counts, in SQL over kgn; a built graph keeps what is 0 here by its definition.
LEDGER = (
    ("V1", "number of nodes as in metadata", "error", "0"),
    ("V1", "number of edges as in metadata", "error", "0"),
    ("V1", "node ids occur once", "error", "SELECT count(*) FROM (SELECT node_id FROM kgn GROUP BY 1 HAVING count(*) > 1)"),
    ("V1", "edges end at nodes", "error", "SELECT count(*) FROM (SELECT child_id AS id FROM sdag UNION SELECT parent_id FROM sdag) WHERE id NOT IN (SELECT id FROM live)"),
    ("V1", "title index has every titled node", "warn", "0"),
    ("V1", "every concept has an ancestor list", "error", "0"),
    ("V1", "ancestor lists are of concepts", "error", "0"),
    ("V2", "belongs_to leads from a concept to a category", "error", "SELECT count(*) FROM sbridge WHERE page_id IN (SELECT page_id FROM visual) AND category_id NOT IN (SELECT id FROM live)"),
    ("V2", "child_of leads from a category to a category", "error", "SELECT count(*) FROM sdag WHERE child_id NOT IN (SELECT id FROM live) OR parent_id NOT IN (SELECT id FROM live)"),
    ("V2", "no edge is a loop", "error", "SELECT count(*) FROM sdag WHERE child_id = parent_id"),
    ("V3", "categories of depth 0 have no parent", "error", "SELECT count(*) FROM kgn JOIN sdag ON child_id = original_id WHERE node_type = 'category' AND depth = 0"),
    ("V3", "a parent is less deep than its child", "warn", "SELECT count(*) FROM sdag JOIN depths p ON p.id = parent_id JOIN depths c ON c.id = child_id WHERE p.depth >= c.depth"),
    ("V3", "a concept is one deeper than its least deep category", "error", "SELECT count(*) FROM kgn JOIN (SELECT page_id, min(depth) AS least FROM sbridge JOIN depths ON id = category_id GROUP BY 1) ON page_id = original_id WHERE node_type = 'concept' AND depth <> least + 1"),
    ("V3", "normalized depth is depth over the largest", "error", "0"),
    ("V4", "the hierarchy has no cycle", "error", "SELECT count(*) FROM up WHERE id = ancestor"),
    ("V5", "specificity is 1 / log1p(total)", "error", "0"),
    ("V5", "specificity is over 0 and no more than 1 / log(2)", "error", "SELECT count(*) FROM kgn WHERE spec <= 0 OR spec > 1.442696"),
    ("V5", "specificity falls as the count grows", "warn", "SELECT CASE WHEN corr(spec, total) >= 0 THEN 1 ELSE 0 END FROM kgn WHERE node_type = 'category' AND total > 0"),
    ("V6", "ancestors are all that is above", "error", "0"),
    ("V6", "ancestors go from the root down", "warn", "0"),
    ("V7", "every concept belongs to a category", "warn", "{lonely}"),
    ("V7", "direct counts are the edges", "error", "SELECT count(*) FROM kgn WHERE node_type = 'category' AND direct <> (SELECT count(*) FROM sbridge WHERE category_id = original_id)"),
    ("V8", "title_lower is the title in lower case", "error", "0"),
    ("V8", "titles are those of the nodes", "error", "0"),
    ("V8", "titles occur once", "warn", "SELECT count(*) FROM (SELECT lower(title) FROM kgn GROUP BY 1 HAVING count(*) > 1)"),
    ("V9", "depths are distributed as in metadata", "error", "0"),
)


def ledger_sql(lonely: str) -> str:
    rows = " UNION ALL ".join(f"SELECT '{c}' AS \"check\", '{m}' AS message, '{level}' AS bad, CAST(({q.replace('{lonely}', lonely)}) AS BIGINT) AS violations" for c, m, level, q in LEDGER)
    return oracle("scats", "sdag", "sbridge", "visual", recursive=True, body=KG_NODES + f', rows AS ({rows}) SELECT "check", CASE WHEN violations > 0 THEN bad ELSE \'ok\' END AS level, message, violations FROM rows')


@query(ledger_sql("SELECT count(*) FROM visual WHERE page_id NOT IN (SELECT page_id FROM sbridge)"))
def p4_validate(spark, sf):
    """The ledger of a built graph."""
    return validate.validate(built(spark, sf))


@query(ledger_sql("0"))
def p4_clean_validate(spark, sf):
    """The ledger of the graph after cleaning, which leaves no concept without a category."""
    graph, _ = cleaned(spark, sf)
    return validate.validate(graph)


@query(oracle("scats", "sdag", "sbridge", "visual", recursive=True, body=KG_NODES + "SELECT 'categories_before' AS name, (SELECT count(*) FROM live) AS n UNION ALL SELECT 'concepts_before', (SELECT count(*) FROM visual) UNION ALL SELECT 'removed_maintenance', 0 UNION ALL SELECT 'removed_cycle_edges', 0 UNION ALL SELECT 'removed_weak_roots', 0 UNION ALL SELECT 'removed_orphan_categories', 0 UNION ALL SELECT 'removed_orphan_concepts', (SELECT count(*) FROM visual WHERE page_id NOT IN (SELECT page_id FROM sbridge))"))
def a20_cleaning(spark, sf):
    """What cleaning took away."""
    _, stats = cleaned(spark, sf)
    return spark.createDataFrame(sorted(stats.items()), "name string, n long")


@query(oracle("scats", "sdag", "sbridge", "visual", recursive=True, body=KG_NODES + ", p AS (SELECT [40]::BIGINT[] AS path UNION ALL SELECT list_append(path, parent_id) FROM p JOIN sdag ON child_id = path[-1] WHERE len(path) < 10), one AS (SELECT path FROM p WHERE path[-1] NOT IN (SELECT child_id FROM sdag) ORDER BY len(path), path LIMIT 1), steps AS (SELECT unnest(path) AS id, generate_subscripts(path, 1) AS pl FROM one) SELECT id + s AS node_id, title, (SELECT string_agg(title, ',' ORDER BY title) FROM scats WHERE scats.id IN (SELECT parent_id FROM sdag WHERE child_id = 40)) AS parents, (SELECT string_agg(title, '>' ORDER BY pl DESC) FROM steps JOIN scats USING (id)) AS hierarchy FROM live, shift WHERE id = 40"))
def q8_concept_card(spark, sf):
    """Category 40 with its hierarchy; it has one root."""
    title = derived(spark, sf, "scats").filter("id = 40").first().title
    out = lookup.concept_card(built(spark, sf), title)
    return out.select("node_id", "title", F.array_join("parents", ",").alias("parents"), F.array_join("hierarchy", "|").alias("hierarchy"))


@query(oracle("scats", "sdag", "sbridge", "visual", recursive=True, body=of(ABOVE) + COUNTS + MOVED + ", p AS (SELECT DISTINCT page_id FROM sbridge WHERE page_id IN (SELECT page_id FROM visual)) SELECT page_id AS original_id, 'concept' AS node_type, 0::BIGINT AS direct, 1::BIGINT AS total FROM p UNION ALL SELECT id, 'category', direct, total FROM counts WHERE id > 0"))
def p4_clean_nodes(spark, sf):
    graph, _ = cleaned(spark, sf)
    return graph.counted().select("original_id", "node_type", F.col("direct_concept_count").cast("long").alias("direct"), F.col("total_concept_count").cast("long").alias("total"))


@query(oracle("scats", "sdag", "sbridge", "visual", recursive=True, body=KG_NODES + "SELECT node_id, CAST(total AS BIGINT) AS total_concept_count FROM kgn WHERE node_type = 'category' ORDER BY total DESC, node_id LIMIT 20"))
def t6_largest_categories(spark, sf):
    return validate.largest(built(spark, sf)["nodes"]).select("node_id", "total_concept_count")


@query(oracle("scats", "sdag", "sbridge", "visual", recursive=True, body=KG_NODES + "SELECT round((SELECT avg(spec) FROM (SELECT spec FROM kgn WHERE node_type = 'category' ORDER BY total DESC, node_id LIMIT 20)), 9) AS largest, round((SELECT avg(spec) FROM (SELECT spec FROM kgn WHERE node_type = 'category' ORDER BY total, node_id LIMIT 20)), 9) AS smallest"))
def t6_ends_specificity(spark, sf):
    one = validate.ends_specificity(built(spark, sf)["nodes"])
    return one.select(*(F.round(c, 9).alias(c) for c in one.columns))


@query(oracle("scats", "sdag", "sbridge", "visual", recursive=True, body=KG_NODES + "SELECT node_id, CAST(total AS BIGINT) AS total_concept_count, total < 10 AS weak FROM kgn WHERE node_type = 'category' AND depth = 0 ORDER BY total DESC, node_id LIMIT 20"))
def t7_root_categories(spark, sf):
    return validate.root_categories(built(spark, sf)["nodes"]).select("node_id", "total_concept_count", "weak")


@query(oracle("scats", "sdag", "sbridge", "visual", recursive=True, body=KG_NODES + "SELECT CAST(depth AS INT) AS depth, node_type, node_id FROM (SELECT *, row_number() OVER (PARTITION BY depth, node_type ORDER BY node_id) AS nth FROM kgn) WHERE nth <= 3"))
def w5_samples(spark, sf):
    return up.sample_per_group(built(spark, sf)["nodes"]).select(F.col("depth").cast("int").alias("depth"), "node_type", "node_id")


def semantic(spark, sf) -> dict[str, DataFrame]:
    cats = derived(spark, sf, "scats")
    return tree.semantic_subgraph(cats, derived(spark, sf, "sdag"), derived(spark, sf, "sbridge"), 1, min_pages=5)


@query(oracle("scats", "sdag", recursive=True, body=", ok AS (SELECT * FROM scats WHERE NOT (" + " OR ".join(f"contains(title, '{p}')" for p in ("_in_art", "_people", "Wikipedia_")) + ")), r AS (SELECT 1::BIGINT AS id UNION SELECT child_id FROM r JOIN sdag ON parent_id = r.id WHERE child_id IN (SELECT id FROM ok)) SELECT id FROM r"))
def p5_semantic_subgraph(spark, sf):
    """Without the trim; the deny-list finds only _in_art here."""
    out = tree.semantic_subgraph(derived(spark, sf, "scats"), derived(spark, sf, "sdag"), derived(spark, sf, "sbridge"), 1, min_pages=None)
    return out["categories"].select("id")


# The tree of best parents in SQL: waves are unrolled, more of them than the graph has at the size of the oracle.

WAVES = 14
TRAITS = (
    ", traits AS (SELECT id, title, CASE WHEN " + " OR ".join(f"contains(title, '{p}')" for p in fixed.PENALIZED) + f" THEN {fixed.PENALTY} ELSE 0 END AS penalty, title IN (" + ", ".join(f"'{x}'" for x in fixed.ANCHORS)
    + ") AS anchor, list_filter([" + ", ".join("CASE WHEN title IN (" + ", ".join(f"'{x}'" for x in names) + f") THEN '{d}' END" for d, names in fixed.DOMAIN_ANCHORS.items()) + "], lambda x: x IS NOT NULL) AS domains, {domain} AS domain FROM tcats)"
)
DOMAIN = "CASE " + " ".join(f"WHEN contains(lower(title), '{k}') THEN '{d}'" for k, d in fixed.DOMAIN_KEYWORDS) + " END"


def _places() -> str:
    """f<n>: (id, depth, place) in breadth-first order from 1; edges come by their parents' ids."""
    out = ", f0 AS (SELECT 1::BIGINT AS id, 0 AS depth, []::BIGINT[] AS place)"
    for i in range(1, WAVES + 1):
        out += f", f{i} AS MATERIALIZED (SELECT * FROM f{i - 1} UNION ALL SELECT child_id, {i}, min(list_append(place, parent_id)) FROM f{i - 1} JOIN sdag ON parent_id = id WHERE depth = {i - 1} AND child_id NOT IN (SELECT id FROM f{i - 1}) GROUP BY child_id)"
    return out + f", ways AS MATERIALIZED (SELECT parent_id, child_id AS id FROM sdag JOIN f{WAVES} p ON p.id = parent_id JOIN f{WAVES} c ON c.id = child_id WHERE p.depth < c.depth OR p.depth = c.depth AND p.place < c.place)"


def _best(k: int) -> str:
    """best: (id, parent, nth, path, penalty, anchors, domains, s1 .. s5), the k best paths by different parents."""
    out = ", w0 AS (SELECT id, NULL::BIGINT AS parent, 1 AS nth, [id] AS path, penalty, CAST(anchor AS INT) AS anchors, domains, penalty AS s1, 1 AS s2, -CAST(anchor AS INT) AS s3, 1 - CAST(anchor AS INT) AS s4, 1 AS s5 FROM traits WHERE id = 1)"
    for i in range(1, WAVES + 1):
        out += f""", m{i} AS (SELECT w.id, p.id AS parent, p.nth AS via, list_prepend(w.id, p.path) AS path, t.penalty + p.penalty AS penalty, CAST(t.anchor AS INT) + p.anchors AS anchors, list_distinct(list_concat(t.domains, p.domains)) AS domains, t.domain, t.anchor
 FROM ways w JOIN w{i - 1} p ON p.id = w.parent_id JOIN traits t ON t.id = w.id WHERE w.id NOT IN (SELECT id FROM w{i - 1}) AND w.id NOT IN (SELECT id FROM ways WHERE parent_id NOT IN (SELECT id FROM w{i - 1}))),
 s{i} AS (SELECT *, penalty AS s1, CASE WHEN domain IS NOT NULL AND list_contains(domains, domain) THEN 0 ELSE 1 END AS s2, -anchors AS s3, 1 - CAST(anchor AS INT) AS s4, len(path) AS s5 FROM m{i}),
 o{i} AS (SELECT *, row_number() OVER (PARTITION BY id, parent ORDER BY s1, s2, s3, s4, s5, via) AS n FROM s{i}),
 w{i} AS MATERIALIZED (SELECT * FROM w{i - 1} UNION ALL SELECT id, parent, nth, path, penalty, anchors, domains, s1, s2, s3, s4, s5 FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY s1, s2, s3, s4, s5, parent, via) AS nth FROM o{i} WHERE n = 1) WHERE nth <= {k})"""
    return out + f", best AS (SELECT * FROM w{WAVES}) "


BEST = TRAITS.replace("{domain}", DOMAIN) + _places() + _best(2)


def best_parents(spark, sf) -> DataFrame:
    e = derived(spark, sf, "sdag").withColumn("edge_pos", F.col("parent_id"))
    return tree.best_paths(derived(spark, sf, "tcats"), e, 1, 2)


@query(oracle("tcats", "sdag", recursive=True, body=BEST + "SELECT id, parent, CAST(nth AS INT) AS nth, CAST(s1 AS INT) AS penalty, CAST(s3 AS INT) AS anchors, array_to_string(path, ',') AS path FROM best"))
def p5_best_parents(spark, sf):
    """The two best parents of each category, with the paths by way of them."""
    return best_parents(spark, sf).select("id", "parent", "nth", F.col("score.penalty").cast("int").alias("penalty"), F.col("score.anchors").cast("int").alias("anchors"), F.array_join(F.col("path").cast("array<string>"), ",").alias("path"))


@query(oracle("tcats", "sdag", recursive=True, body=BEST + """, c AS (SELECT *, min((s1, s2, s3, s4, s5)) OVER (PARTITION BY id) AS a, count(*) OVER (PARTITION BY id) AS n FROM best),
 d AS (SELECT id, any_value(a) AS a, min((s1, s2, s3, s4, s5)) AS b FROM c WHERE (s1, s2, s3, s4, s5) <> a GROUP BY id)
 SELECT CASE WHEN a[1] < b[1] THEN 'penalized_avoided' WHEN a[2] < b[2] THEN 'domain_preferred' WHEN a[3] < b[3] THEN 'anchor_preferred' ELSE 'depth_tiebreak' END AS reason, count(*) AS n FROM d GROUP BY 1 UNION ALL SELECT 'single_parent', count(*) FROM (SELECT DISTINCT id FROM c WHERE n = 1) HAVING count(*) > 0"""))
def w4_decision_reasons(spark, sf):
    """What set the best path of each category apart from the second."""
    return tree.decision_reasons(best_parents(spark, sf).select("id", "score"))


@query(oracle("tcats", "sdag", recursive=True, body=BEST + ", steps AS (SELECT b.id, nth, unnest(path) AS step, generate_subscripts(path, 1) AS pl FROM best b JOIN tcats c ON c.id = b.id WHERE c.title IN ('Physics', 'Organisms', 'Culture')) SELECT steps.id, CAST(nth AS INT) AS nth, string_agg(title, '>' ORDER BY pl DESC) AS titles FROM steps JOIN tcats t ON t.id = step GROUP BY ALL"))
def q10_sample_paths(spark, sf):
    found = lookup.sample_paths(best_parents(spark, sf), derived(spark, sf, "tcats"), ["Physics", "Organisms", "Culture"])
    return found.select("id", "nth", F.array_join("titles", ">").alias("titles"))


@query(oracle("tcats", "sdag", "tpages", "sbridge", recursive=True, body=TRAITS.replace("{domain}", DOMAIN) + f""", up AS (SELECT child_id AS id, max(parent_id) AS parent FROM sdag GROUP BY 1),
 walk AS (SELECT id, penalty, CAST(anchor AS INT) AS anchors, domains, 1 AS length FROM traits WHERE id = 1 UNION ALL SELECT t.id, t.penalty + w.penalty, CAST(t.anchor AS INT) + w.anchors, list_distinct(list_concat(t.domains, w.domains)), length + 1 FROM walk w JOIN up ON parent = w.id JOIN traits t ON t.id = up.id),
 rows AS (SELECT p.page_id, p.title, w.id AS category_id, w.length, w.penalty, w.anchors, t.anchor, w.domains, {DOMAIN.replace("title", "p.title")} AS domain FROM sbridge b JOIN tpages p USING (page_id) JOIN walk w ON w.id = b.category_id JOIN traits t ON t.id = w.id WHERE coalesce((SELECT max(n.id) FROM tcats n WHERE lower(n.title) = lower(p.title)), w.id) = w.id),
 s AS (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY penalty, CASE WHEN domain IS NOT NULL AND list_contains(domains, domain) THEN 0 ELSE 1 END, -anchors, 1 - CAST(anchor AS INT), length, -(length - 1), category_id) AS nth FROM rows)
 SELECT concat('page_', page_id) AS node_id, concat('cat_', category_id) AS parent_id, CAST(length AS INT) AS depth FROM s WHERE nth = 1"""))
def p5_attached_pages(spark, sf):
    """Each order attached to the best of its suppliers' categories."""
    e = derived(spark, sf, "sdag").withColumn("edge_pos", F.col("parent_id"))
    b = derived(spark, sf, "sbridge").withColumn("pos", F.col("category_id"))
    nodes, _ = tree.attach_pages(derived(spark, sf, "tcats"), e, derived(spark, sf, "tpages"), b, 1)
    return nodes.filter("node_type = 'page'").select("node_id", "parent_id", F.col("depth").cast("int").alias("depth"))


@query(oracle("sdag", recursive=True, body=", d AS (SELECT 1::BIGINT AS id, 0 AS depth UNION SELECT child_id, depth + 1 FROM d JOIN sdag ON parent_id = d.id) SELECT id, CAST(min(depth) AS INT) AS depth FROM d GROUP BY id"))
def g16_discovery_depths(spark, sf):
    e = derived(spark, sf, "sdag").withColumn("edge_pos", F.col("parent_id"))
    return tree.discovery(e, derived(spark, sf, "scats").filter("id = 1")).select("id", "depth")


@query(oracle("geo", body="SELECT node_id FROM geo g WHERE node_type = 'page' OR node_id = 'cat_root' OR node_id IN (SELECT parent_id FROM geo WHERE node_type = 'page') OR node_id IN (SELECT parent_id FROM geo WHERE node_type = 'category' AND node_id IN (SELECT parent_id FROM geo WHERE node_type = 'page'))"))
def g19_trim_empty(spark, sf):
    nodes = derived(spark, sf, "geo")
    edges = nodes.filter("parent_id IS NOT NULL").select("parent_id", F.col("node_id").alias("child_id"))
    return trim.trim_empty(nodes, edges, "cat_root")[0].select("node_id")


@query(oracle("geo", body="SELECT CAST(depth AS INT) AS depth, count(*) FILTER (WHERE node_type = 'category') AS categories, count(*) FILTER (WHERE node_type = 'page') AS pages FROM geo GROUP BY 1"))
def a14_depth_types(spark, sf):
    g = derived(spark, sf, "geo")
    return g.groupBy("depth").agg(F.count_if(F.col("node_type") == "category").alias("categories"), F.count_if(F.col("node_type") == "page").alias("pages"))


@query(oracle("geo", body=", per AS (SELECT parent_id, count(*) AS n FROM geo WHERE node_type = 'page' GROUP BY 1) SELECT min(n) AS min_pages, max(n) AS max_pages, round(avg(n), 9) AS mean_pages, median(n) AS median_pages, count(*) AS categories FROM per"))
def a14_pages_per_category(spark, sf):
    one = validate.pages_per_category(derived(spark, sf, "geo"))
    return one.withColumn("mean_pages", F.round("mean_pages", 9))


@query(oracle("scats", "sdag", "sbridge", "visual", recursive=True, body=KG_NODES + "SELECT round((SELECT count(*) FROM sbridge WHERE page_id IN (SELECT page_id FROM visual)) * 1.0 / (SELECT count(*) FROM visual), 9) AS categories_per_concept, round((SELECT count(*) FROM sdag) * 1.0 / (SELECT count(*) FROM live), 9) AS children_per_category, round(avg(spec), 9) AS mean_specificity, round(min(spec), 9) AS min_specificity, round(max(spec), 9) AS max_specificity FROM kgn WHERE node_type = 'category'"))
def a16_averages(spark, sf):
    one = validate.averages(built(spark, sf))
    return one.select(*(F.round(c, 9).alias(c) for c in one.columns))


@query(oracle("scats", "sdag", "sbridge", "visual", recursive=True, body=KG_NODES + "SELECT round(corr(spec, total), 6) AS correlation FROM kgn WHERE node_type = 'category' AND total > 0"))
def a15_correlation(spark, sf):
    n = built(spark, sf)["nodes"].filter("node_type = 'category' AND total_concept_count > 0")
    return n.agg(F.round(F.corr("specificity_score", "total_concept_count"), 6).alias("correlation"))


@query(oracle("sbridge", body="SELECT category_id, count(*) AS page_count FROM sbridge GROUP BY 1"))
def a12_page_counts(spark, sf):
    return derived(spark, sf, "sbridge").groupBy("category_id").agg(F.count("*").alias("page_count"))

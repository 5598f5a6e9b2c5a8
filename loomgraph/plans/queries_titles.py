"""Queries on titles, dumps, link resolution and classification."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as fixed
from ..functions import titles as tt
from ..operators import classify as cl
from ..operators import degrees as deg
from ..operators import lookup, resolve
from ..sources import dumps, wordnet
from ..sources.tables import table
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


def any_of(words, column="title") -> str:
    return "(" + " OR ".join(f"contains({column}, '{w}')" for w in words) + ")"


@query(oracle("categories", body=f"SELECT id, title FROM categories WHERE NOT {any_of(fixed.NOT_SEMANTIC)}"))
def f11_semantic_titles(spark, sf):
    return derived(spark, sf, "categories").filter(tt.is_semantic(F.col("title"))).select("id", "title")


@query(oracle("categories", body=f"SELECT id, title FROM categories WHERE NOT {any_of(fixed.NOT_SEMANTIC_SHORT)}"))
def f11_semantic_titles_short(spark, sf):
    return derived(spark, sf, "categories").filter(tt.is_semantic(F.col("title"), fixed.NOT_SEMANTIC_SHORT)).select("id", "title")


@query(oracle("categories", body="SELECT id FROM categories WHERE regexp_matches(title, '(?i)(" + "|".join(fixed.MAINTENANCE) + ")')"))
def f13_maintenance(spark, sf):
    return derived(spark, sf, "categories").filter(tt.is_maintenance(F.col("title"))).select("id")


@query(oracle("categories", body="SELECT id FROM categories WHERE NOT (regexp_matches(title, '(?i)(" + "|".join(fixed.MAINTENANCE) + ")') AND NOT regexp_matches(title, '(?i)(bolt)'))"))
def f14_maintenance_keep(spark, sf):
    t = F.col("title")
    return derived(spark, sf, "categories").filter(~(tt.is_maintenance(t) & ~t.rlike(tt.java_regex(["bolt"])))).select("id")


@query(oracle("categories", body="SELECT id, title FROM categories WHERE lower(title) = (SELECT lower(title) FROM categories WHERE id = 13) ORDER BY id LIMIT 5"))
def f15_title_query(spark, sf):
    """The title of category 13, in capitals and with spaces."""
    c = derived(spark, sf, "categories").select("id", "title")
    return lookup.by_title(c, c.filter("id = 13").first().title.upper().replace("_", " "))


PATTERNS = [(p, f"starts_with(title, '{p}')") for p in fixed.NAMESPACES] + [("(disambiguation)", "contains(lower(title), '(disambiguation)')"), ("List_of_", "starts_with(title, 'List_of_')")] + [(k, f"regexp_matches(title, '{v}')") for k, v in fixed.META_TITLES.items()]


@query(oracle("nodes", body=" UNION ALL ".join(f"SELECT '{p}' AS pattern, count(*) FILTER (WHERE {t}) AS n, min(title) FILTER (WHERE {t}) AS example FROM nodes" for p, t in PATTERNS)))
def f18_title_patterns(spark, sf):
    return deg.title_patterns(derived(spark, sf, "nodes"))


@query(oracle("nodes", "links", body=", d AS (SELECT title, (SELECT count(*) FROM links WHERE dst_id = page_id) AS in_degree, (SELECT count(*) FROM links WHERE src_id = page_id) AS out_degree FROM nodes) SELECT *, CASE " + " ".join(f"WHEN contains(lower(title), '{k}') THEN '{k}'" for k in fixed.FINDER_KEYWORDS) + " END AS keyword FROM d WHERE keyword IS NOT NULL"))
def f19_citation_titles(spark, sf):
    return deg.citation_titles(deg.degrees(derived(spark, sf, "nodes"), derived(spark, sf, "links")))


@query(oracle("categories", body=f"SELECT id, {any_of(fixed.PENALIZED)} AS penalized, CASE " + " ".join(f"WHEN contains(lower(title), '{k}') THEN '{d}'" for k, d in fixed.DOMAIN_KEYWORDS) + " END AS domain, lower(replace(replace(title, ' ', '_'), '-', '_')) AS normal, 'cat_' || id AS node, lower(title) AS title_lower FROM categories"))
def f20_title_traits(spark, sf):
    t = F.col("title")
    return derived(spark, sf, "categories").select("id", tt.is_penalized(t).alias("penalized"), tt.infer_domain(t).alias("domain"), tt.normal_title(t).alias("normal"), tt.category_node(F.col("id")).alias("node"), F.lower("title").alias("title_lower"))


@query("SELECT p_partkey AS id, round(CASE WHEN p_size = 0 THEN 1.0 ELSE 1 / ln(1 + p_size) END, 9) AS specificity, round(p_size / 50.0, 9) AS normalized, CASE WHEN p_name = 'NULL' THEN NULL ELSE p_name END AS title FROM part")
def f26_scores(spark, sf):
    p = table(spark, sf, "part")
    return p.select(F.col("p_partkey").alias("id"), F.round(tt.specificity(F.col("p_size")), 9).alias("specificity"), F.round(tt.normalized_depth(F.col("p_size"), F.lit(50)), 9).alias("normalized"), tt.to_str(F.col("p_name")).alias("title"))


# Dumps: INSERT lines made from the tables, several tuples a line, and parsed back.

def dump_lines(rows: DataFrame, name: str, *fields) -> DataFrame:
    """One line for each hundred rows; text is quoted and escaped as in a dump."""
    tuple_ = F.concat(F.lit("("), F.concat_ws(",", *fields), F.lit(")"))
    lines = rows.select(F.floor(F.col("n") / 100).alias("line"), F.col("n"), tuple_.alias("t")).groupBy("line").agg(F.concat_ws(",", F.transform(F.array_sort(F.collect_list(F.struct("n", "t"))), lambda x: x["t"])).alias("ts"))
    return lines.select(F.concat(F.lit(f"INSERT INTO `{name}` VALUES "), F.col("ts"), F.lit(";")).alias("value"))


def quoted(c: Column) -> Column:
    return F.concat(F.lit("'"), F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("'"), F.lit("\\'")), F.lit("'"))


@query("SELECT p_partkey AS page_id, CAST(p_partkey % 3 AS BIGINT) AS ns, p_name || '''s, (' || p_type || ')' AS title FROM part")
def s1_dump_pages(spark, sf):
    p = table(spark, sf, "part").withColumn("n", F.col("p_partkey"))
    title = F.concat("p_name", F.lit("'s, ("), "p_type", F.lit(")"))
    lines = dump_lines(p, "page", F.col("p_partkey").cast("string"), (F.col("p_partkey") % 3).cast("string"), quoted(title))
    return dumps.pages(dumps.read_tuples(lines, "page"))


@query("SELECT n_nationkey AS category_id, n_name AS title, CASE WHEN n_regionkey = 0 THEN NULL ELSE CAST(n_regionkey AS BIGINT) END AS page_count FROM (SELECT CAST(n_nationkey AS BIGINT) AS n_nationkey, n_name, n_regionkey FROM nation)")
def s3_dump_categories(spark, sf):
    n = table(spark, sf, "nation").withColumn("n", F.col("n_nationkey"))
    count = F.when(F.col("n_regionkey") == 0, "NULL").otherwise(F.col("n_regionkey").cast("string"))
    return dumps.categories(dumps.read_tuples(dump_lines(n, "category", F.col("n_nationkey").cast("string"), quoted(F.col("n_name")), count), "category", decode_escapes=False))


# Synsets: a part is a synset named by the first word of its name, below the part of half its number.

def synsets(spark, sf) -> tuple[DataFrame, DataFrame]:
    p = table(spark, sf, "part")
    at = lambda c: F.lpad(c.cast("string"), 8, "0")
    word = F.split("p_name", " ")[0]
    half = F.floor(F.col("p_partkey") / 2)
    pointer = F.when(half > 0, F.concat(F.lit("001 "), F.when(F.col("p_partkey") % 5 == 0, "@i").otherwise("@"), F.lit(" "), at(half), F.lit(" n 0000"))).otherwise("000")
    line = F.concat(at(F.col("p_partkey")), F.lit(" 03 n 01 "), word, F.lit(" 0 "), pointer, F.lit(" | "), F.col("p_type"), F.lit('; "an example"'))
    return wordnet.build(wordnet.parse_synsets(p.select(line.alias("value"))))


@query("SELECT p_partkey * 4 AS node_id, printf('%s.n.%02d', word, nth) AS synset, p_type AS definition, 'n' AS pos FROM (SELECT CAST(p_partkey AS BIGINT) AS p_partkey, p_type, string_split(p_name, ' ')[1] AS word, row_number() OVER (PARTITION BY string_split(p_name, ' ')[1] ORDER BY p_partkey) AS nth FROM part)")
def s10_synsets(spark, sf):
    return synsets(spark, sf)[0]


@query("SELECT CAST(floor(p_partkey / 2.0) AS BIGINT) * 4 AS parent_id, CAST(p_partkey AS BIGINT) * 4 AS child_id FROM part WHERE floor(p_partkey / 2.0) > 0 AND floor(p_partkey / 2.0) IN (SELECT p_partkey FROM part)")
def g24_hypernyms(spark, sf):
    return synsets(spark, sf)[1]


# Link resolution: parts are pages, those divisible by 10 redirects to the page of a third of their number.

RESOLVE = {
    "pg": "SELECT p_partkey AS page_id, CASE WHEN p_partkey % 7 = 0 THEN 14 ELSE 0 END AS ns, concat('P', CAST(p_partkey AS STRING)) AS title FROM {part}",
    "lt": "SELECT p_partkey + 1000000 AS lt_id, CASE WHEN p_partkey % 7 = 0 THEN 14 ELSE 0 END AS ns, concat('P', CAST(p_partkey AS STRING)) AS title FROM {part}",
    "rd": "SELECT p_partkey AS rd_from, 0 AS ns, concat('P', CAST(CAST(floor(p_partkey / 3.0) AS BIGINT) AS STRING)) AS title FROM {part} WHERE p_partkey % 10 = 0",
    "pl": "SELECT l_partkey AS pl_from, CASE WHEN l_suppkey % 9 = 0 THEN 1 ELSE 0 END AS pl_from_ns, l_orderkey + 1000000 AS pl_target FROM {lineitem}",
    "cat": "SELECT p_partkey + 5000000 AS category_id, concat('P', CAST(p_partkey AS STRING)) AS title FROM {part} WHERE p_partkey % 7 = 0",
    "cll": "SELECT l_partkey AS cl_from, CASE l_linenumber % 3 WHEN 0 THEN 'subcat' WHEN 1 THEN 'page' ELSE 'file' END AS cl_type, l_orderkey + 1000000 AS cl_target FROM {lineitem}",
}


def made(spark, sf, name: str) -> DataFrame:
    sql = RESOLVE[name]
    return spark.sql(sql, **{t: table(spark, sf, t) for t in ("part", "lineitem") if "{" + t + "}" in sql})


def with_made(*names: str, body: str) -> str:
    return "WITH " + ", ".join(f"{n} AS ({RESOLVE[n].replace('{', '').replace('}', '')})" for n in names) + " " + body


@query(with_made("pg", "lt", "rd", "pl", body="SELECT src_id, dst_id, count(*) AS n FROM (SELECT pl_from AS src_id, coalesce(t2.page_id, t.page_id) AS dst_id FROM pl JOIN lt ON lt_id = pl_target AND lt.ns = 0 JOIN pg t ON t.title = lt.title AND t.ns = 0 LEFT JOIN rd ON rd_from = t.page_id AND rd_from <> 0 LEFT JOIN pg t2 ON t2.title = rd.title AND t2.ns = 0 WHERE pl_from_ns = 0) WHERE src_id IN (SELECT page_id FROM pg WHERE ns = 0) GROUP BY 1, 2"))
def j4_resolve_links(spark, sf):
    links = resolve.resolve_links(made(spark, sf, "pl"), made(spark, sf, "lt"), made(spark, sf, "pg"), made(spark, sf, "rd"))
    return links.groupBy("src_id", "dst_id").agg(F.count("*").alias("n"))


CATS = "SELECT parent.category_id AS parent_id, child.category_id AS child_id, page.page_id, cl_type FROM cll JOIN lt ON lt_id = cl_target AND lt.ns = 14 JOIN cat parent ON parent.title = lt.title JOIN pg page ON page.page_id = cl_from LEFT JOIN cat child ON child.title = page.title AND page.ns = 14"


@query(with_made("pg", "lt", "cat", "cll", body=f"SELECT parent_id, child_id, count(*) AS n FROM ({CATS}) WHERE cl_type = 'subcat' AND child_id IS NOT NULL GROUP BY 1, 2"))
def j9_category_edges(spark, sf):
    edges, _ = resolve.resolve_categories(*(made(spark, sf, n) for n in ("cll", "cat", "pg", "lt")))
    return edges.groupBy("parent_id", "child_id").agg(F.count("*").alias("n"))


@query(with_made("pg", "lt", "cat", "cll", body=f"SELECT x.page_id, parent_id AS category_id, count(*) AS n FROM ({CATS}) x JOIN pg USING (page_id) WHERE cl_type = 'page' AND ns = 0 GROUP BY 1, 2"))
def j9_page_categories(spark, sf):
    _, held = resolve.resolve_categories(*(made(spark, sf, n) for n in ("cll", "cat", "pg", "lt")))
    return held.groupBy("page_id", "category_id").agg(F.count("*").alias("n"))


@query(oracle("bridge", "visual", body="SELECT DISTINCT page_id, category_id FROM bridge WHERE page_id IN (SELECT page_id FROM visual WHERE starts_with(title, '2-HIGH'))"))
def j14_visual_pages(spark, sf):
    return resolve.visual_pages(derived(spark, sf, "bridge"), derived(spark, sf, "visual").filter(F.col("title").startswith("2-HIGH")))


# Classification.

def flag(exact, parts) -> str:
    return "(title IN (" + ", ".join(f"'{x}'" for x in exact) + f") OR {any_of(parts, 'lower(title)')})"


CLASSIFIED = f", flags AS (SELECT category_id, title AS category, {flag(fixed.VISUAL_TITLES, fixed.VISUAL_PARTS)} AS v, {flag(fixed.ABSTRACT_TITLES, fixed.ABSTRACT_PARTS)} AS a FROM categories), per AS (SELECT page_id, bool_or(v) AS v, bool_or(a) AS a, count(DISTINCT category) AS n FROM bridge JOIN flags USING (category_id) GROUP BY 1), classified AS (SELECT page_id, title, CASE WHEN v AND NOT a THEN 'visual' WHEN a AND NOT v THEN 'abstract' END AS classification, coalesce(n, 0) AS num_categories FROM visual LEFT JOIN per USING (page_id)) "


def classified(spark, sf) -> DataFrame:
    return cl.classify(derived(spark, sf, "visual"), derived(spark, sf, "bridge"), derived(spark, sf, "categories"))


@query(oracle("bridge", "visual", "categories", body=CLASSIFIED + "SELECT * FROM classified"))
def c1_classify(spark, sf):
    return classified(spark, sf)


@query(oracle("bridge", "visual", "categories", body=CLASSIFIED + "SELECT coalesce(classification, 'uncertain') AS classification, count(*) AS pages, min(num_categories) AS min_categories, median(num_categories) AS median_categories, round(avg(num_categories), 9) AS mean_categories, max(num_categories) AS max_categories, round(count(*) * 100.0 / (SELECT count(*) FROM classified), 9) AS pct FROM classified GROUP BY 1"))
def a6_classification_stats(spark, sf):
    return cl.classification_stats(classified(spark, sf)).withColumns({c: F.round(c, 9) for c in ("mean_categories", "pct")})


@query(oracle("bridge", "visual", "categories", body=CLASSIFIED + "SELECT page_id, title FROM classified WHERE classification IS NULL"))
def c2b_uncertain(spark, sf):
    return cl.split_rules(classified(spark, sf))["uncertain"].select("page_id", "title")


def stub(titles: list[str]) -> str:
    """Answers like a classifier: a page of an odd number is visual."""
    return "Here: " + json.dumps([{"title": t, "visual": int(t.rpartition("_")[2]) % 2 == 1} for t in titles]) + "."


@query(oracle("visual", body="SELECT page_id, title, page_id % 2 = 1 AS visual FROM visual"))
def c10_ask_classifier(spark, sf):
    return cl.ask(derived(spark, sf, "visual"), stub)


@query(oracle("visual", body="SELECT page_id, title FROM visual WHERE page_id % 2 = 0"))
def c12_nonvisual(spark, sf):
    return cl.split_verdicts(cl.ask(derived(spark, sf, "visual"), stub))["nonvisual"].select("page_id", "title")


@query(oracle("visual", body="SELECT page_id, title FROM visual WHERE NOT starts_with(title, '5-LOW')"))
def c11_resume(spark, sf):
    v = derived(spark, sf, "visual")
    return cl.resume(v, v.filter(F.col("title").startswith("5-LOW")).withColumn("visual", F.lit(True))).select("page_id", "title")


@query(oracle("visual", body="SELECT page_id, title, page_id % 2 = 1 AS visual FROM visual ORDER BY page_id LIMIT 50"))
def t9_ask_some(spark, sf):
    """The first fifty pages only."""
    return cl.ask(derived(spark, sf, "visual"), stub, limit=50)


@query(oracle("visual", body="SELECT count(*) AS titles, CAST(ceil(count(*) / 30.0) AS BIGINT) AS batches, count(*) * 25 AS tokens_in, count(*) * 15 AS tokens_out, round(count(*) * 25 / 1000.0 * 0.0008 + count(*) * 15 / 1000.0 * 0.002, 6) AS price FROM visual"))
def a21_cost(spark, sf):
    return cl.cost(derived(spark, sf, "visual")).withColumn("price", F.round("price", 6))


# Lookups.

@query(oracle("geo", body="SELECT node_id, title, node_type, tier FROM (SELECT *, CASE WHEN lower(title) = 'nation_1' THEN 0 WHEN contains(lower(title), 'nation_1') THEN 1 END AS tier FROM geo) WHERE tier IS NOT NULL ORDER BY tier, node_id LIMIT 5"))
def q5_search(spark, sf):
    return lookup.search(derived(spark, sf, "geo"), "Nation 1").select("node_id", "title", "node_type", "tier")


@query(oracle("geo", body="SELECT node_id, title FROM geo WHERE contains(lower(title), 'supplier#00000000') AND node_type = 'page' ORDER BY node_id LIMIT 5"))
def q5_search_typed(spark, sf):
    return lookup.search(derived(spark, sf, "geo"), "supplier#00000000", "page").select("node_id", "title")


@query(oracle("categories", body="SELECT category_id, title, 2 AS tier FROM categories WHERE contains(lower(title), 'bolt') ORDER BY length(title), category_id LIMIT 1"))
def q4_tiered(spark, sf):
    return lookup.tiered(derived(spark, sf, "categories"), "bolt").select("category_id", "title", "tier")


@query(oracle("categories", body="SELECT category_id, title, 0 AS tier FROM categories WHERE title = (SELECT title FROM categories WHERE id = 13) ORDER BY category_id LIMIT 1"))
def q4_tier_exact(spark, sf):
    c = derived(spark, sf, "categories")
    return lookup.tiered(c, c.filter("id = 13").first().title).select("category_id", "title", "tier")


@query(oracle("categories", body="SELECT category_id, title, 1 AS tier FROM categories WHERE lower(title) = (SELECT lower(title) FROM categories WHERE id = 13) ORDER BY category_id LIMIT 1"))
def q4_tier_case(spark, sf):
    c = derived(spark, sf, "categories")
    return lookup.tiered(c, c.filter("id = 13").first().title.swapcase()).select("category_id", "title", "tier")


@query(oracle("categories", body="SELECT id, title FROM categories WHERE contains(lower(title), 'red_w') ORDER BY id LIMIT 10"))
def q3_suggestions(spark, sf):
    return lookup.suggestions(derived(spark, sf, "categories").select("id", "title"), "Red w")


@query(oracle("geo", body="SELECT n.node_id, n.title, n.node_type, array_to_string([n.title, r.title, w.title], '>') AS path, (SELECT count(*) FROM geo WHERE parent_id = n.node_id AND node_type = 'page') AS pages FROM geo n JOIN geo r ON r.node_id = n.parent_id JOIN geo w ON w.node_id = r.parent_id WHERE n.title = 'NATION_3'"))
def q6_card(spark, sf):
    return lookup.card(derived(spark, sf, "geo"), "NATION_3").select("node_id", "title", "node_type", F.array_join("path", ">").alias("path"), "pages")


@query(oracle("sdag", recursive=True, body=", r AS (SELECT 20::BIGINT AS id, 0 AS depth UNION SELECT parent_id, depth + 1 FROM r JOIN sdag ON child_id = r.id WHERE depth < 3) SELECT id, CAST(min(depth) AS INT) AS depth FROM r GROUP BY 1"))
def q1_neighbourhood_up(spark, sf):
    return lookup.neighbourhood(derived(spark, sf, "sdag"), 20, 3, up=True)


@query(oracle("sdag", recursive=True, body=", r AS (SELECT 1::BIGINT AS id, 0 AS depth UNION SELECT child_id, depth + 1 FROM r JOIN sdag ON parent_id = r.id WHERE depth < 3) SELECT id, CAST(min(depth) AS INT) AS depth FROM r GROUP BY 1"))
def q1_neighbourhood_down(spark, sf):
    return lookup.neighbourhood(derived(spark, sf, "sdag"), 1, 3)


@query(oracle("tree", recursive=True, body=", r AS (SELECT 1::BIGINT AS id, 0 AS level, [1]::BIGINT[] AS way UNION ALL SELECT child_id, level + 1, list_append(way, child_id) FROM r JOIN tree ON parent_id = r.id WHERE level < 4) SELECT CAST(level AS BIGINT) AS level, id, row_number() OVER (ORDER BY way) AS line FROM r"))
def g20_printed_tree(spark, sf):
    """In a tree, a walk in depth-first order meets what is near, in the order of the ways to it."""
    rows = lookup.printed_tree(derived(spark, sf, "tree"), 1, 4)
    return spark.createDataFrame([(level, node, k + 1) for k, (level, node) in enumerate(rows)], "level long, id long, line long")


@query(oracle("sdag", recursive=True, body=", p AS (SELECT id, [id] AS path FROM (SELECT DISTINCT child_id AS id FROM sdag) UNION ALL SELECT id, list_append(path, parent_id) FROM p JOIN sdag ON child_id = path[-1] WHERE len(path) < 10), e AS (SELECT id, path FROM p WHERE path[-1] NOT IN (SELECT child_id FROM sdag)) SELECT id, array_to_string(path, ',') AS path FROM (SELECT *, row_number() OVER (PARTITION BY id, path[-1] ORDER BY len(path), path) AS nth FROM e) WHERE nth = 1"))
def w6_one_path_per_root(spark, sf):
    e = derived(spark, sf, "sdag")
    found = lookup.one_per_root(lookup.paths_up(e, e.select(F.col("child_id").alias("id")), 10))
    return found.select("id", F.array_join(F.col("path").cast("array<string>"), ",").alias("path"))


@query(oracle("sdag", recursive=True, body=", p AS (SELECT id, [id] AS path FROM (SELECT DISTINCT child_id AS id FROM sdag) UNION ALL SELECT id, list_append(path, parent_id) FROM p JOIN sdag ON child_id = path[-1] WHERE path[-1] <> 1), e AS (SELECT id, path FROM p WHERE path[-1] = 1) SELECT id, array_to_string(path, ',') AS path FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY len(path), path) AS nth FROM e) WHERE nth <= 3"))
def g22_shortest_paths(spark, sf):
    """No more than three paths for each category."""
    e = derived(spark, sf, "sdag")
    found = lookup.paths_up(e, e.select(F.col("child_id").alias("id")), 20, 1, max_paths=3)
    return found.select("id", F.array_join(F.col("path").cast("array<string>"), ",").alias("path"))


@query(oracle("sdag", recursive=True, body=", p AS (SELECT id, [id] AS path FROM (SELECT DISTINCT child_id AS id FROM sdag WHERE child_id IN (20, 57)) UNION ALL SELECT id, list_append(path, parent_id) FROM p JOIN sdag ON child_id = path[-1] WHERE NOT list_contains(path, parent_id) AND path[-1] <> 1) SELECT id, array_to_string(path, ',') AS path FROM p WHERE path[-1] = 1"))
def g22_paths_to_root(spark, sf):
    start = spark.createDataFrame([(20,), (57,)], "id long").join(derived(spark, sf, "sdag").select(F.col("child_id").alias("id")), "id", "left_semi")
    return lookup.paths_up(derived(spark, sf, "sdag"), start, 20, 1).select("id", F.array_join(F.col("path").cast("array<string>"), ",").alias("path"))


@query(oracle("sdag", recursive=True, body=", p AS (SELECT id, [id] AS path FROM (SELECT DISTINCT child_id AS id FROM sdag) UNION ALL SELECT id, list_append(path, parent_id) FROM p JOIN sdag ON child_id = path[-1] WHERE len(path) < 10) SELECT id, count(*) AS paths, CAST(min(len(path)) AS INT) AS shortest FROM p WHERE path[-1] NOT IN (SELECT child_id FROM sdag) GROUP BY id"))
def g23_paths_to_any_root(spark, sf):
    e = derived(spark, sf, "sdag")
    return lookup.paths_up(e, e.select(F.col("child_id").alias("id")), 10).groupBy("id").agg(F.count("*").alias("paths"), F.min(F.size("path")).alias("shortest"))


@query(oracle("geo", body="SELECT node_id, title FROM geo WHERE contains(lower(title), 'nation_2') ORDER BY node_id LIMIT 1"))
def q7_find(spark, sf):
    return lookup.find(derived(spark, sf, "geo"), "Nation 2", exact=False).select("node_id", "title")


@query(oracle("nodes", body="SELECT page_id AS node_id, concat(title, '.n.01') AS synset FROM nodes WHERE starts_with(title, 'List_of_') AND starts_with(concat(title, '.n.01'), (SELECT min(title) FROM nodes WHERE starts_with(title, 'List_of_')) || '.')"))
def q2_synset(spark, sf):
    nodes = derived(spark, sf, "nodes").select(F.col("page_id").alias("node_id"), F.concat("title", F.lit(".n.01")).alias("synset"))
    word = derived(spark, sf, "nodes").filter(F.col("title").startswith("List_of_")).agg(F.min("title")).first()[0]
    return lookup.by_synset(nodes, word)


@query(oracle("links", "nodes", body="SELECT src_id AS id FROM links EXCEPT SELECT page_id FROM nodes WHERE NOT starts_with(title, 'Wikipedia_')"))
def u6_missing_keys(spark, sf):
    """Sources of links that are no nodes, where nodes of one namespace have gone."""
    keys = derived(spark, sf, "links").select(F.col("src_id").alias("id")).distinct()
    return keys.join(derived(spark, sf, "nodes").filter(~F.col("title").startswith("Wikipedia_")).select(F.col("page_id").alias("id")), "id", "left_anti")


@query(oracle("upward", "nodes", body="SELECT page_id AS id FROM nodes EXCEPT SELECT dst_id FROM upward"))
def u6_unused_keys(spark, sf):
    """The other direction: nodes that no link leads to."""
    keys = derived(spark, sf, "nodes").select(F.col("page_id").alias("id")).distinct()
    return keys.join(derived(spark, sf, "upward").select(F.col("dst_id").alias("id")), "id", "left_anti")

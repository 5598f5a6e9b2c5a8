"""Graphs derived from the driver's tables, each by one statement that Spark and the oracle both understand."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from ..sources.tables import table

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

#: Title prefixes that give every pattern list something to find.
TITLE = """concat(CASE p_partkey % 16 WHEN 0 THEN 'Articles_needing_' WHEN 1 THEN 'History_of_' WHEN 2 THEN 'Animal_' WHEN 3 THEN 'Wikipedia_' WHEN 4 THEN 'pubmed_' WHEN 5 THEN 'Food_and_' WHEN 6 THEN 'CS1_'
 WHEN 7 THEN 'List_of_' WHEN 8 THEN 'Category:' WHEN 9 THEN 'database_' WHEN 10 THEN 'isbn_' WHEN 11 THEN 'Physics_' WHEN 12 THEN 'articles_' ELSE '' END, replace(p_name, ' ', '_'), '_', CAST(p_partkey AS STRING),
 CASE p_partkey % 9 WHEN 0 THEN '_stubs' WHEN 1 THEN '_(identifier)' WHEN 2 THEN '_by_country' WHEN 3 THEN '_in_europe' WHEN 4 THEN '_theory' WHEN 5 THEN '_buildings' ELSE '' END)"""

DERIVED = {
    "links": "SELECT src_id, dst_id FROM (SELECT l_partkey AS src_id, lead(l_partkey) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) AS dst_id FROM {lineitem}) x WHERE dst_id IS NOT NULL",
    "nodes": f"SELECT p_partkey AS page_id, {TITLE} AS title FROM {{part}}",
    "categories": f"SELECT p_partkey AS category_id, p_partkey AS id, {TITLE} AS title FROM {{part}}",
    "tree": "SELECT CAST(floor(p_partkey / 2.0) AS BIGINT) AS parent_id, p_partkey AS child_id FROM {part} WHERE p_partkey > 1",
    "dag": "SELECT CAST(floor(p_partkey / 2.0) AS BIGINT) AS parent_id, p_partkey AS child_id FROM {part} WHERE p_partkey > 1 UNION SELECT CAST(floor(p_partkey / 3.0) AS BIGINT) AS parent_id, p_partkey AS child_id FROM {part} WHERE p_partkey > 2",
    "bridge": "SELECT DISTINCT l_orderkey AS page_id, l_partkey AS category_id FROM {lineitem}",
    # A category for each supplier, pages for each order.
    "scats": "SELECT s_suppkey AS id, s_suppkey AS category_id, concat(CASE s_suppkey % 7 WHEN 0 THEN 'Animals' WHEN 1 THEN 'History_of_pets' WHEN 2 THEN 'Dogs_in_art' WHEN 3 THEN 'Physics' WHEN 4 THEN 'Plants' WHEN 5 THEN 'Grammar_theory' ELSE 'Countries' END, '_', CAST(s_suppkey AS STRING)) AS title FROM {supplier}",
    "sdag": "SELECT CAST(floor(s_suppkey / 2.0) AS BIGINT) AS parent_id, s_suppkey AS child_id FROM {supplier} WHERE s_suppkey > 1 UNION SELECT CAST(floor(s_suppkey / 3.0) AS BIGINT) AS parent_id, s_suppkey AS child_id FROM {supplier} WHERE s_suppkey > 2",
    "sbridge": "SELECT DISTINCT l_orderkey AS page_id, l_suppkey AS category_id FROM {lineitem} WHERE l_suppkey > 0",
    "cyclic": "SELECT s_suppkey AS child_id, (s_suppkey * 7 + 3) % (SELECT count(*) FROM {supplier}) AS parent_id FROM {supplier}",
    "visual": "SELECT o_orderkey AS page_id, concat(replace(o_orderpriority, ' ', '_'), '_', CAST(o_orderkey AS STRING)) AS title FROM {orders}",
    "geo": """SELECT concat('cat_r', CAST(r_regionkey AS STRING)) AS node_id, r_name AS title, 'category' AS node_type, 1 AS depth, 'cat_root' AS parent_id FROM {region}
     UNION ALL SELECT concat('cat_n', CAST(n_nationkey AS STRING)), n_name, 'category', 2, concat('cat_r', CAST(n_regionkey AS STRING)) FROM {nation}
     UNION ALL SELECT concat('page_', CAST(s_suppkey AS STRING)), s_name, 'page', 3, concat('cat_n', CAST(s_nationkey AS STRING)) FROM {supplier}
     UNION ALL SELECT 'cat_root', 'World', 'category', 0, CAST(NULL AS STRING)""",
}


#: All links, led from the smaller to the larger id, so that some pages have none of their own.
DERIVED["upward"] = f"SELECT least(src_id, dst_id) AS src_id, greatest(src_id, dst_id) AS dst_id FROM ({DERIVED['links']}) y"
#: The hierarchy with titles that are anchors or bear keywords of domains, for the semantic tree.
DERIVED["tcats"] = """SELECT s_suppkey AS id, s_suppkey AS category_id, CASE WHEN s_suppkey = 1 THEN 'Main_topic_classifications' WHEN s_suppkey = 2 THEN 'Animals' WHEN s_suppkey = 3 THEN 'Science' WHEN s_suppkey = 4 THEN 'Culture' WHEN s_suppkey = 5 THEN 'Organisms'
 WHEN s_suppkey = 7 THEN 'Physics' ELSE concat(CASE s_suppkey % 5 WHEN 0 THEN 'Dog_breeds' WHEN 1 THEN 'History_of_pets' WHEN 2 THEN 'Physics_theory' WHEN 3 THEN 'Towns' ELSE 'Fish' END, '_', CAST(s_suppkey AS STRING)) END AS title FROM {supplier}"""
DERIVED["tpages"] = "SELECT o_orderkey AS page_id, concat(CASE o_orderkey % 4 WHEN 0 THEN 'Big_dog' WHEN 1 THEN 'Quantum_physics' WHEN 2 THEN 'Poem' ELSE 'Fish' END, '_', CAST(o_orderkey AS STRING)) AS title FROM {orders}"


def derived(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    sql = DERIVED[name]
    return spark.sql(sql, **{t: table(spark, sf_dir, t) for t in TABLES if "{" + t + "}" in sql})


def oracle(*names: str, body: str, recursive: bool = False) -> str:
    """body after WITH the derived tables it names."""
    ctes = [f"{n} AS ({re.sub(r'[{}]', '', DERIVED[n])})" for n in names]
    return ("WITH RECURSIVE " if recursive else "WITH " if ctes else "") + ", ".join(ctes) + ("" if body.lstrip().startswith(",") or not ctes else " ") + body

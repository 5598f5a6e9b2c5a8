"""The tables' schemas, and a check against them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: By table, in DDL; parsed when used, as that takes a session.
SCHEMAS = {
    "nodes": "page_id LONG, title STRING",
    "edges": "src_id LONG, dst_id LONG",
    "pagerank": "page_id LONG, pagerank DOUBLE",
    "categories": "category_id LONG, title STRING, page_count LONG",
    "category_edges": "parent_id LONG, child_id LONG",
    "page_categories": "page_id LONG, category_id LONG",
    "category_pagerank": "category_id LONG, pagerank DOUBLE",
    "wn_nodes": "node_id LONG, synset STRING, definition STRING, pos STRING",
    "wn_edges": "parent_id LONG, child_id LONG",
    "wn_pagerank": "node_id LONG, pagerank DOUBLE",
    "classified": "page_id LONG, title STRING, classification STRING, num_categories LONG",
    "kg_nodes": "node_id LONG, original_id LONG, title STRING, node_type STRING, depth INT, normalized_depth DOUBLE, direct_concept_count LONG, total_concept_count LONG, specificity_score DOUBLE",
    "kg_edges": "src_id LONG, dst_id LONG, edge_type STRING",
    "metadata": "num_nodes LONG, num_concepts LONG, num_categories LONG, num_edges LONG, max_depth INT, category_id_offset LONG, depth_distribution MAP<STRING, LONG>",
    "title_index": "title_lower STRING, title STRING, node_id LONG, node_type STRING",
    "ancestors": "node_id LONG, ancestors ARRAY<LONG>",
    "clean_nodes": "node_id LONG, original_id LONG, title STRING, node_type STRING, depth INT, normalized_depth FLOAT, direct_concept_count INT, total_concept_count INT, specificity_score FLOAT",
    "tree_nodes": "node_id STRING, title STRING, node_type STRING, depth INT, parent_id STRING",
    "tree_edges": "parent_id STRING, child_id STRING",
}


def conform(df: DataFrame, name: str) -> DataFrame:
    """df with the columns of the schema, in order and cast; a missing column is an error."""
    schema = T.StructType.fromDDL(SCHEMAS[name])
    if missing := [f.name for f in schema if f.name not in df.columns]:
        raise ValueError(f"{name} lacks {', '.join(missing)}")
    return df.select(*(df[f.name].cast(f.dataType).alias(f.name) for f in schema))

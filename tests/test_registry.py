"""Registered queries against their oracle SQL on the smallest tables."""

import duckdb
import pytest

from loomgraph.plans import registry
from loomgraph.plans.derived import TABLES

SF = "/root/testdata/sf0.001"
SAMPLE = ["g1_pagerank_top", "w1_rank_positions", "u1_exclusions", "a8_descendant_counts", "g8_strong_components", "f20_title_traits", "s1_dump_pages", "j4_resolve_links", "c1_classify", "q6_card", "g22_paths_to_root", "p4_build_nodes"]


def test_every_oracle_has_a_query():
    assert set(registry.oracle_sql()) <= set(registry.queries())


@pytest.mark.parametrize("name", SAMPLE)
def test_against_oracle(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    cursor = con.execute(registry.oracle_sql()[name])
    columns = [c[0] for c in cursor.description]
    want = sorted(map(repr, cursor.fetchall()))
    got = registry.queries()[name](spark, SF).select(columns)
    assert sorted(repr(tuple(r)) for r in got.collect()) == want

"""The registered queries with SQL against DuckDB on sf0.001."""

import duckdb
import pytest

from quarry.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    want = con.execute(ORACLE[name])
    columns = [d[0] for d in want.description]
    got = QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(columns)
    assert sorted(map(tuple, got.select(*columns).collect()), key=repr) == sorted(want.fetchall(), key=repr)


def test_the_other_queries_have_brute_force_tests():
    assert set(QUERIES) - set(ORACLE) == {
        "op1_quality_rules", "op2_packing", "op3_html_extract", "op4_embedding_dedup", "op6_byte_bpe", "op8_language_id", "op9_simhash", "op13_pii",
    }

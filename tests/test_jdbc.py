"""JDBC option building. No database is started here, so the read itself
is not exercised (see README)."""

import pytest

from quarry.sources.jdbc import bounds_query, jdbc_options


def test_table_with_run_date_and_properties():
    cfg = {"url": "jdbc:postgresql://h/db", "table": "(select * from o where d >= '${run_date}') q",
           "properties": {"user": "u", "driver": "org.postgresql.Driver", "fetchsize": 1000}}
    opts = jdbc_options(cfg, "2024-01-02")
    assert opts["dbtable"] == "(select * from o where d >= '2024-01-02') q"
    assert opts["user"] == "u" and opts["fetchsize"] == "1000" and "query" not in opts


def test_query_is_not_substituted():
    opts = jdbc_options({"url": "jdbc:x", "query": "select '${run_date}'"}, "2024-01-02")
    assert opts["query"] == "select '${run_date}'"


def test_partitioned_read_options():
    opts = jdbc_options({"url": "jdbc:x", "table": "t", "partition_column": "id", "num_partitions": 16,
                         "lower_bound": 0, "upper_bound": 1000})
    assert (opts["partitionColumn"], opts["numPartitions"], opts["lowerBound"], opts["upperBound"]) == (
        "id", "16", "0", "1000")


@pytest.mark.parametrize("cfg", [{"url": "jdbc:x"}, {"url": "jdbc:x", "table": "t", "query": "q"}])
def test_table_xor_query(cfg):
    with pytest.raises(ValueError):
        jdbc_options(cfg)


def test_bounds_are_computed_by_the_database():
    opts = jdbc_options({"url": "jdbc:x", "table": "public.orders", "partition_column": "orderid"})
    assert bounds_query(opts) == "SELECT MIN(orderid) AS lo, MAX(orderid) AS hi FROM public.orders"
    opts = jdbc_options({"url": "jdbc:x", "query": "SELECT orderid AS order_id FROM t",
                         "partition_column": "order_id"})
    assert bounds_query(opts) == (
        "SELECT MIN(order_id) AS lo, MAX(order_id) AS hi FROM (SELECT orderid AS order_id FROM t) q")


def test_fetch_size_defaults_unless_given():
    assert jdbc_options({"url": "jdbc:x", "table": "t"})["fetchsize"] == "10000"
    opts = jdbc_options({"url": "jdbc:x", "table": "t", "properties": {"fetchSize": 50}})
    assert opts["fetchSize"] == "50" and "fetchsize" not in opts


def test_predicates_give_one_partition_each():
    from quarry.sources.jdbc import read_jdbc

    seen = {}

    class Reader:
        def jdbc(self, url, table, predicates=None, properties=None):
            seen.update(url=url, table=table, predicates=predicates, properties=properties)
            return "df"

    class Spark:
        read = Reader()

    cfg = {"url": "jdbc:x", "query": "select * from o", "properties": {"user": "u"},
           "predicates": ["d < '${run_date}'", "d >= '${run_date}'"]}
    assert read_jdbc(Spark(), cfg, "2024-01-02") == "df"
    assert seen["table"] == "(select * from o) q" and seen["url"] == "jdbc:x"
    assert seen["predicates"] == ["d < '2024-01-02'", "d >= '2024-01-02'"]
    assert seen["properties"]["user"] == "u" and "url" not in seen["properties"]


def test_an_empty_source_is_read_without_a_split(monkeypatch):
    from quarry.sources import jdbc

    seen = {}

    class Reader:
        def format(self, name):
            return self

        def options(self, **options):
            seen.update(options)
            return self

        def load(self):
            return "frame"

    class Session:
        read = Reader()

    monkeypatch.setattr(jdbc, "_bounds", lambda spark, opts: None)
    assert jdbc.read_jdbc(Session(), {"url": "u", "table": "t", "partition_column": "id"}) == "frame"
    assert "partitionColumn" not in seen and "lowerBound" not in seen and "numPartitions" not in seen

"""Catalog-table and Spark-SQL sources (Delta, Iceberg, Parquet tables).

``query`` wins over ``table``. Run-date placeholders in ``query`` become a
bound ``:run_date`` parameter, so the date reaches the scan as a literal
and partition filters on it are pruned.

A table of this library is read as it is named on storage: where the catalog
entry is missing (a session without a metastore) or behind (a change of it
failed), the folder decides. ``path`` names the folder of a table that is not
in its default place; ``format`` its file format.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quarry.functions.expressions import bind_run_date
from quarry.sinks import versions
from quarry.sinks.tables import qualified, table_location, view_base


def read_table(spark: SparkSession, config: dict, run_date=None) -> DataFrame:
    query = config.get("query")
    if query:
        text, args = bind_run_date(query, run_date)
        return spark.sql(text, args=args or None)
    table = config.get("table")
    if not table:
        raise ValueError("a table source needs 'table' or 'query'")
    found = _on_storage(spark, table, config)
    return found if found is not None else spark.table(table)


def _on_storage(spark: SparkSession, table: str, config: dict) -> DataFrame | None:
    """The table from its folder, if its entry does not lead there."""
    parts = [p.strip("`") for p in table.split(".")]
    if parts[0] == "spark_catalog":
        parts = parts[1:]
    if len(parts) > 2:  # of a catalog that keeps its own state
        return None
    name = qualified(*parts)
    reader = spark.read.format(config.get("format", "parquet"))
    if spark.catalog.tableExists(name):
        entry = table_location(spark, name)
        base = versions.base_of(entry) if entry else view_base(spark, name)
        named = versions.state(spark, base) if base else None
        if named is None or (entry and named.whole and versions.qualified_path(spark, entry) == versions.qualified_path(spark, named.path)):
            return None
    else:
        warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
        base = (config.get("path") or f"{warehouse}/{parts[-2] if len(parts) > 1 else 'default'}/{parts[-1]}").rstrip("/")
        named = versions.state(spark, base)
        if named is None:
            if not versions.holds_data(spark, base):
                return None
            named = versions.State(base, (versions.Part(""),))
    return versions.read(spark, named, reader.schema(named.schema) if named.schema is not None else reader)

"""Table sinks: append, full overwrite, partition overwrite, upsert.

Config keys: ``table_name`` (``table``, ``db.table`` or
``catalog.db.table``; file tables live in the session catalog, so there
the catalog part is ignored), ``path`` (default
``<warehouse>/<db>/<table>``), ``partition_by``, ``format`` (default per
writer; a writer whose table format is not configured raises unless the
config asks for another one), ``first`` (register the table at its path
again; a table with versions stays at its current one), ``merge_schema``
(an append may bring new columns and new fields of structs),
``widen_types`` (it may also bring wider types, see ``operators/schemas``),
``batch_id`` (an append that was done under this id is not done again),
``replace_where`` (a partition overwrite of all partitions that a condition
covers, those without new rows included), ``upsert_scope`` (``partitions``:
the touched partitions where the partition columns are keys; ``files``: only
the files of an unpartitioned table that hold matched keys; ``table``),
``rebalance`` (default true: partitioned writes are laid out per partition value, see
``rebalanced``; set false when every write holds one partition value,
such as one run date per backfill run), ``bucket_by`` (``{"columns": [...],
"buckets": n}``: a bucketed table, see ``TableSink`` below), and for upsert
``primary_key``, ``change_tracking_column``, ``null_safe``.

File tables (Parquet, ORC, ...) are written with Spark's commit protocol,
so a lost executor only re-runs its tasks. ``overwrite`` replaces every
partition; ``overwrite_partition`` replaces only the partitions present in
the new data (set per write, never through the session). Appends and
partition overwrites keep the table's schema: columns the data lacks are
NULL, new ones need ``merge_schema``, and a column of another type is an
error before anything is written, unless ``widen_types`` allows it. The table
is what lies on storage, not what a catalog entry lists: partitions that were
written but never registered are part of it.

An upsert on a file table writes the merged table to a new version folder,
names it current on storage in one rename (see ``versions``) and then lets
the catalog entry follow. A run that fails at any point leaves a readable
table, and the next write starts from the version named on storage, with
or without a catalog entry. Old versions are kept for readers that still
use them; to reclaim space delete folders under ``_versions`` other than
the one ``_versions/_current`` names (never by age alone). Delta / Iceberg
tables, when configured, use their own ``writeTo`` / ``MERGE`` support.
"""

from __future__ import annotations

import datetime as dt
import logging
import uuid
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions.expressions import substitute_run_date
from quarry.operators.merge import DEFAULT_BROADCAST_BYTES, SKEW_BYTES, plan_merge
from quarry.operators.schemas import fit, reconcile
from quarry.session import new_work_dir, remove
from quarry.sinks import versions

log = logging.getLogger(__name__)

BASE_PROPERTY = "quarry.base"
# An upsert by files rewrites the whole table beyond these: its share of the
# files, and the parts and dead files that a table's state may list.
MAX_TOUCHED_SHARE, MAX_FILE_PARTS, MAX_DEAD = 0.5, 64, 10_000

# Formats with their own transactions. Delta is written by path (then
# registered, like any file table); Iceberg through its catalog (writeTo).
# Both upsert with MERGE.
V2_FORMATS = {"delta", "iceberg"}
CATALOG_WRITE_FORMATS = {"iceberg"}
FORMAT_BY_WRITER = {
    "DeltaWriter": "delta",
    "IcebergWriter": "iceberg",
    "ParquetWriter": "parquet",
    "TableWriter": "parquet",
}


def split_table_name(name: str) -> tuple[str | None, str]:
    """Database and table of a name of one to three parts."""
    return _name_parts(name)[1:]


def _name_parts(name: str) -> tuple[str | None, str | None, str]:
    parts = [p.strip("`") for p in name.split(".")]
    if not 1 <= len(parts) <= 3:
        raise ValueError(f"table name {name!r} must have one to three parts")
    return tuple([None] * (3 - len(parts)) + parts)


def qualified(*parts: str | None) -> str:
    return ".".join(f"`{p}`" for p in parts if p)


def format_available(spark: SparkSession, fmt: str, catalog: str | None = None) -> bool:
    """Whether the session is set up for a table format with its own
    transactions: by its extension, or by the catalog a table is in."""
    if fmt not in V2_FORMATS:
        return True
    keys = ["spark.sql.extensions", "spark.sql.catalog.spark_catalog"]
    keys += [f"spark.sql.catalog.{catalog}"] if catalog else []
    return any(fmt in str(spark.conf.get(k, "") or "").lower() for k in keys)


def resolve_format(spark: SparkSession, config: dict, writer: str | None) -> str:
    fmt = config.get("format") or FORMAT_BY_WRITER.get(writer or "", "parquet")
    catalog = _name_parts(config["table_name"])[0] if config.get("table_name") else None
    if not format_available(spark, fmt, catalog):
        raise ValueError(f"{fmt} is not configured in this session; configure it or ask for another \"format\"")
    return fmt


def _entry(spark: SparkSession, name: str):
    """The session catalog's own record of a table, None if there is none
    (one look-up, where DESCRIBE would run a query)."""
    state = spark._jsparkSession.sessionState()
    ident = state.sqlParser().parseTableIdentifier(name)
    return state.catalog().getTableMetadata(ident) if state.catalog().tableExists(ident) else None


def table_location(spark: SparkSession, name: str) -> str | None:
    """Current location of a catalog table, or None when it does not exist."""
    entry = _entry(spark, name)
    if entry is None or not entry.storage().locationUri().isDefined():
        return None
    return spark._jvm.org.apache.hadoop.fs.Path(entry.location()).toString()


def _same_location(spark: SparkSession, a: str | None, b: str) -> bool:
    return a is not None and versions.qualified_path(spark, a) == versions.qualified_path(spark, b)


def _swap(spark: SparkSession, stage: str, name: str) -> None:
    """Put the entry ``stage`` in the place of ``name``. Entries are
    external, so no files move. If the second step fails the old entry is
    put back under its name before the error goes on."""
    if not spark.catalog.tableExists(name):
        spark.sql(f"ALTER TABLE {stage} RENAME TO {name}")
        return
    old = name[:-1] + f"__{uuid.uuid4().hex[:12]}`"
    spark.sql(f"ALTER TABLE {name} RENAME TO {old}")
    try:
        spark.sql(f"ALTER TABLE {stage} RENAME TO {name}")
    except Exception:
        spark.sql(f"ALTER TABLE {old} RENAME TO {name}")
        raise
    spark.sql(f"DROP TABLE IF EXISTS {old}")


def register_table(
    spark: SparkSession,
    name: str,
    fmt: str,
    path: str,
    partition_by: list[str],
    force: bool = False,
    merge_schema: bool = False,
    columns: list[str] | None = None,
    written: list[dict] | None = None,
    schema: T.StructType | None = None,
    first: bool = False,
) -> None:
    """Point the catalog entry ``name`` at ``path``.

    ``first`` (a job's flag): re-create the entry unless it already points
    at ``path`` with the same columns and partition columns, so a backfill
    loop registers once instead of once per date. ``force`` always
    re-creates it (a full overwrite that may have removed partitions).

    ``schema``: the schema of the data written. The entry is declared with
    it, so partition columns keep their types: inferred from folder names,
    a bigint key could come back as int and a code "007" as the number 7.
    With ``merge_schema`` the columns of the current entry are kept and
    new ones added.

    ``written``: the partition values the last write produced, when known;
    for a table already registered there only those are added, instead of
    listing the whole folder.

    Created when missing. A change of place or of columns is one ``ALTER``
    where the catalog has one, else a new entry is made in full and then
    put in the old one's place (``_swap``). External tables: dropping an
    entry never deletes data.
    """
    if schema is not None and columns is None:
        columns = schema.fieldNames()
    _drop_view(spark, name)
    if not spark.catalog.tableExists(name):
        _create(spark, name, fmt, path, partition_by, list(schema.fields) if schema is not None else None)
        return
    moved = not _same_location(spark, table_location(spark, name), path)
    old = spark.table(name).schema
    listed = [c.name for c in spark.catalog.listColumns(name) if c.isPartition]
    known = {f.name.lower(): f.dataType for f in old.fields}
    new = [f for f in (schema.fields if schema is not None else []) if f.name.lower() not in known]
    same_types = schema is None or all(known.get(f.name.lower(), f.dataType) == f.dataType for f in schema.fields)
    gone = bool(columns) and not set(known) <= {c.lower() for c in columns} | {f.name.lower() for f in new}
    replaces = (force or first) and not merge_schema and (gone or new or not same_types)
    if replaces or listed != list(partition_by) or not same_types or (moved and partition_by):
        fields = None if schema is None else list(schema.fields)
        if fields is not None and not replaces:
            fields = [f for f in old.fields if f.name.lower() not in {x.name.lower() for x in fields}] + fields
        stage = name[:-1] + f"__{uuid.uuid4().hex[:12]}`"
        _create(spark, stage, fmt, path, partition_by, fields)
        _swap(spark, stage, name)
        spark.catalog.refreshTable(name)
        return
    if new:
        nullable = T.StructType([T.StructField(f.name, f.dataType) for f in new])
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({nullable.toDDL()})")
    if moved:
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{_quoted(path)}'")
    elif partition_by and fmt not in V2_FORMATS and _tracks_partitions(spark, name):
        if force:  # a full overwrite: partitions may be gone
            spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")
        elif not add_partitions(spark, name, partition_by, written):
            spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    spark.catalog.refreshTable(name)


def _is_view(spark: SparkSession, name: str) -> bool:
    entry = _entry(spark, name)
    return entry is not None and entry.tableType().name() == "VIEW"


def _hidden(name: str, part: versions.Part) -> str:
    """The entry of one part of a table that is made of several."""
    return name[:-1] + "__part_" + (part.folder.rpartition("/")[2].replace("-", "_") or "base") + "`"


def _hidden_entries(spark: SparkSession, name: str) -> list[str]:
    db, table = ([None] + [p.strip("`") for p in name.split("`.`")])[-2:]
    found = spark.sql(f"SHOW TABLES{f' IN `{db}`' if db else ''} LIKE '{table}__part_*'").collect()
    return [qualified(db, r.tableName) for r in found]


def _drop_view(spark: SparkSession, name: str) -> None:
    """Take away the view of a table in parts, once it is in one again."""
    if _is_view(spark, name):
        spark.sql(f"DROP VIEW {name}")
        for hidden in _hidden_entries(spark, name):
            spark.sql(f"DROP TABLE IF EXISTS {hidden}")


def register_parts(spark: SparkSession, name: str, fmt: str, found: versions.State) -> None:
    """Point the entry ``name`` at a table made of several folders: an
    external table per folder and a view over those of their files that
    count. The view takes the entry's place once it is complete."""
    columns = ", ".join(f"`{f.name}`" for f in found.schema.fields)
    declared, _ = _declared_columns(list(found.schema.fields), [])
    selects = []
    for part, folder in zip(found.parts, found.folders()):
        hidden = _hidden(name, part)
        if spark.catalog.tableExists(hidden) and spark.table(hidden).dtypes != spark.createDataFrame([], found.schema).dtypes:
            spark.sql(f"DROP TABLE {hidden}")
        spark.sql(f"CREATE TABLE IF NOT EXISTS {hidden}{declared} USING {fmt} LOCATION '{_quoted(folder)}'")
        spark.catalog.refreshTable(hidden)  # an append may have added files
        dead = ", ".join(f"'{_quoted(n)}'" for n in part.dead)
        selects.append(f"SELECT {columns} FROM {hidden}" + (f" WHERE _metadata.file_name NOT IN ({dead})" if dead else ""))
    text = f"TBLPROPERTIES ('{BASE_PROPERTY}' = '{_quoted(found.base)}') AS " + " UNION ALL ".join(selects)
    if _is_view(spark, name):
        spark.sql(f"ALTER VIEW {name} AS " + " UNION ALL ".join(selects))
    else:
        old = name[:-1] + f"__{uuid.uuid4().hex[:12]}`"
        had = spark.catalog.tableExists(name)
        if had:
            spark.sql(f"ALTER TABLE {name} RENAME TO {old}")
        try:
            spark.sql(f"CREATE VIEW {name} {text}")
        except Exception:
            if had:
                spark.sql(f"ALTER TABLE {old} RENAME TO {name}")
            raise
        if had:
            spark.sql(f"DROP TABLE IF EXISTS {old}")
    used = {_hidden(name, p) for p in found.parts}
    for hidden in _hidden_entries(spark, name):
        if hidden not in used:
            spark.sql(f"DROP TABLE IF EXISTS {hidden}")


def view_base(spark: SparkSession, name: str) -> str | None:
    """The base folder of a table whose entry is a view of its parts."""
    if not _is_view(spark, name):
        return None
    properties = _entry(spark, name).properties()
    return properties.apply(BASE_PROPERTY) if properties.contains(BASE_PROPERTY) else None


def _quoted(path: str) -> str:
    return path.replace("\\", "\\\\").replace("'", "\\'")


def _create(spark: SparkSession, name: str, fmt: str, path: str, partition_by: list[str], fields) -> None:
    declared, partitioned = "", ""
    if fields is not None and fmt not in V2_FORMATS:  # those keep their own schema
        declared, partitioned = _declared_columns(fields, partition_by)
    spark.sql(f"CREATE TABLE {name}{declared} USING {fmt}{partitioned} LOCATION '{_quoted(path)}'")
    if partition_by and fmt not in V2_FORMATS and _tracks_partitions(spark, name):
        spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    spark.catalog.refreshTable(name)


def _tracks_partitions(spark: SparkSession, name: str) -> bool:
    """Whether the catalog lists the table's partitions (else Spark lists
    the folder when it reads)."""
    entry = _entry(spark, name)
    return entry is not None and entry.tracksPartitionsInCatalog()


def _declared_columns(fields: list[T.StructField], partition_by: list[str]) -> tuple[str, str]:
    """Column list (partition columns last, as Spark stores them) and
    ``PARTITIONED BY`` clause of a CREATE TABLE, as two clauses."""
    # An append may leave any column NULL.
    fields = [T.StructField(f.name, f.dataType, True, f.metadata) for f in fields]
    by_name = {f.name: f for f in fields}
    ordered = [f for f in fields if f.name not in partition_by] + [by_name[p] for p in partition_by]
    cols = " (" + T.StructType(ordered).toDDL() + ")"
    parts = " PARTITIONED BY (" + ", ".join(f"`{p}`" for p in partition_by) + ")" if partition_by else ""
    return cols, parts


# Most partition values an upsert names one by one (in the scan's filter and
# in the catalog); beyond it they are joined, and the folder is listed.
MAX_ADDED_PARTITIONS = 10_000
_PLAIN_PARTITION_TYPES = (T.StringType, T.IntegerType, T.LongType, T.ShortType, T.ByteType, T.DateType,
                          T.BooleanType)


def _nameable(spark: SparkSession, name: str, partition_by: list[str]):
    """Whether the table's partition columns have types whose values can
    be named in a partition spec exactly as the writer names their
    folders (no NULLs or timestamps, which are listed instead)."""
    types = {f.name: f.dataType for f in spark.table(name).schema.fields}
    return all(isinstance(types.get(c), _PLAIN_PARTITION_TYPES) for c in partition_by)


def _spec_literal(value) -> str:
    if isinstance(value, bool):
        return "true" if value else "false"
    text = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{text}'"


def add_partitions(spark: SparkSession, name: str, partition_by: list[str], written: list[dict] | None) -> bool:
    """Add the given partitions to the catalog (``IF NOT EXISTS``); False
    when they cannot be named exactly, so the caller lists the folder."""
    if written is None or len(written) > MAX_ADDED_PARTITIONS:
        return False
    if any(v is None for row in written for v in row.values()):
        return False
    if not _nameable(spark, name, partition_by):
        return False
    specs = [
        "PARTITION (" + ", ".join(f"`{c}` = {_spec_literal(row[c])}" for c in partition_by) + ")"
        for row in written
    ]
    for i in range(0, len(specs), 500):
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS " + " ".join(specs[i:i + 500]))
    return True


def rebalanced(df: DataFrame, partition_by: list[str]) -> DataFrame:
    """Lay out a partitioned write: rows of one partition value are
    brought together, so each value gets a few files instead of one per
    task. AQE then splits a hot value into several advisory-sized
    partitions and merges small ones, so neither small files nor one
    oversized task result."""
    return df.hint("rebalance", *[f"`{c}`" for c in partition_by]) if partition_by else df


def _fields(kind: T.DataType) -> int:
    """The number of struct fields at any depth."""
    if isinstance(kind, T.StructType):
        return sum(1 + _fields(f.dataType) for f in kind.fields)
    inner = [getattr(kind, a) for a in ("elementType", "keyType", "valueType") if hasattr(kind, a)]
    return sum(map(_fields, inner))


class TableSink:
    """One table target; ``append`` / ``overwrite`` / ``overwrite_partition``
    / ``upsert`` are the modes a job's ``load`` section names.

    Bucketed tables (``bucket_by``) keep their rows hashed into a fixed
    number of buckets by key. An upsert keyed on the bucket columns then
    reads the target bucket by bucket and shuffles only the source, and
    the merged rows come out already in bucket order for the write: the
    target, the large side, is never shuffled. Spark writes bucketed files
    only through the catalog, so every overwrite or upsert writes a new
    version as an external table and puts its entry in the old one's place;
    appends insert into the table, and partition overwrites insert with
    the table's own dynamic overwrite mode (stored with it, so the
    session's setting does not matter).
    """

    def __init__(self, spark: SparkSession, config: dict, run_date=None, writer: str | None = None):
        self.spark = spark
        self.config = config
        self.run_date = run_date
        self.fmt = resolve_format(spark, config, writer)
        self.partition_by = list(config.get("partition_by") or [])
        name = config.get("table_name")
        catalog, self.db, self.table = _name_parts(name) if name else (None, None, None)
        # File tables are entries of the session catalog.
        self.catalog = catalog if self.fmt in V2_FORMATS and catalog != "spark_catalog" else None
        self.name = qualified(self.catalog, self.db, self.table) if self.table else None

    # -- helpers ---------------------------------------------------------
    def _ensure_database(self) -> None:
        if self.db:
            loc = self.config.get("database_location")
            where = f" LOCATION '{_quoted(loc)}'" if loc else ""
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {qualified(self.catalog, self.db)}{where}")

    def _base_path(self) -> str:
        """The folder the table's versions lie under."""
        if self.config.get("path"):
            return self.config["path"].rstrip("/")
        if not self.table:
            raise ValueError("a table sink needs 'table_name' or 'path'")
        entry = table_location(self.spark, self.name) or view_base(self.spark, self.name)
        if entry is not None:
            return versions.base_of(entry)
        warehouse = self.spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
        return f"{warehouse}/{self.db or 'default'}/{self.table}"

    def path(self) -> str:
        """Where the table's files are: the version named on storage; else
        where the catalog has it, unless ``first`` takes it (back) to the
        configured path; else the configured or default path."""
        base = self._base_path()
        named = versions.current(self.spark, base)
        if named is not None:
            return named
        entry = table_location(self.spark, self.name) if self.name else None
        if entry is not None:
            of_base = _same_location(self.spark, versions.base_of(entry), base)
            if of_base or not self.config.get("first"):
                return versions.current(self.spark, versions.base_of(entry)) or entry
        return base

    def _stored(self, like: T.StructType) -> DataFrame | None:
        """The table as it lies on storage, whatever partitions a catalog
        entry lists; None if there is none yet. Its schema is the one named
        on storage, else the entry's with what the files have besides;
        ``like`` gives the types of partition columns, which folder names do
        not hold. A bucketed table is read through its entry, which alone
        knows the buckets, once all its partitions are in it."""
        base = self._base_path()
        if versions.finish_replacing(self.spark, base) and self.name and self.spark.catalog.tableExists(self.name) and _tracks_partitions(self.spark, self.name):
            self.spark.sql(f"MSCK REPAIR TABLE {self.name} SYNC PARTITIONS")
        path = self.path()
        entry = bool(self.name) and _same_location(self.spark, table_location(self.spark, self.name), path)
        if entry and self._bucket_spec():
            if self.partition_by and _tracks_partitions(self.spark, self.name):
                self.spark.sql(f"ALTER TABLE {self.name} RECOVER PARTITIONS")
            self.spark.catalog.refreshTable(self.name)
            return self.spark.table(self.name)
        named = versions.state(self.spark, base)
        if named is not None and named.path != path:
            named = None
        if not versions.holds_data(self.spark, path):
            return self.spark.table(self.name) if entry else None
        reader = self.spark.read.format(self.fmt)
        if named is not None and named.schema is not None:
            schema = named.schema
        else:
            schema = reader.load(path).schema
            types = {f.name.lower(): f.dataType for f in like.fields}
            for f in schema.fields:
                if f.name in self.partition_by:
                    f.dataType = types.get(f.name.lower(), f.dataType)
            if entry:
                own = self.spark.table(self.name).schema
                known = {f.name.lower() for f in own.fields}
                parts = {p.lower() for p in self.partition_by}
                extra = [f for f in schema.fields if f.name.lower() not in known]
                schema = T.StructType([f for f in own.fields if f.name.lower() not in parts] + extra + [f for f in own.fields if f.name.lower() in parts])
        return versions.read(self.spark, named or versions.State(path, (versions.Part(""),)), reader.schema(schema))

    def _aligned(self, df: DataFrame, stored: DataFrame | None) -> DataFrame:
        """``df`` with the stored table's columns: see the module's text."""
        if stored is None:
            return df
        have = {f.name.lower(): f for f in df.schema.fields}
        known = {f.name.lower() for f in stored.schema.fields}
        new = [f.name for k, f in have.items() if k not in known]
        if new and not self.config.get("merge_schema"):
            raise ValueError(f"{self.name or self.path()} has no columns {new} (set merge_schema to add them)")
        kinds, other = {}, []
        for f in stored.schema.fields:
            mine = have.get(f.name.lower())
            kinds[f.name] = f.dataType
            if mine is None or mine.dataType == f.dataType:
                continue
            nested = bool(self.config.get("merge_schema"))
            widen = bool(self.config.get("widen_types")) and f.name not in self.partition_by
            try:
                if not nested and not widen:
                    raise ValueError(f"{f.name}: {f.dataType.simpleString()} in the table, {mine.dataType.simpleString()} in the data")
                kinds[f.name] = reconcile(f.dataType, mine.dataType, widen, f.name)
                if not nested and _fields(kinds[f.name]) > _fields(f.dataType):
                    raise ValueError(f"{f.name} has new fields (set merge_schema to add them)")
            except ValueError as e:
                other.append(str(e))
        if other:
            raise ValueError(f"column types differ in {self.name or self.path()}: " + "; ".join(other))
        columns = []
        for f in stored.schema.fields:
            mine = have.get(f.name.lower())
            value = F.lit(None).cast(f.dataType) if mine is None else fit(F.col(f"`{mine.name}`"), mine.dataType, kinds[f.name])
            columns.append(value.alias(f.name))
        return df.select(*columns, *[F.col(f"`{n}`") for n in new])

    def _bucket_spec(self) -> tuple[int, list[str]] | None:
        spec = self.config.get("bucket_by")
        if not spec:
            return None
        return int(spec["buckets"]), list(spec["columns"])

    def _save_bucketed_version(self, df: DataFrame, aligned: bool = False) -> str:
        """Write ``df`` as a new version of the bucketed table and point
        the table's name at it (the old version's files stay in place)."""
        n, cols = self._bucket_spec()
        self._ensure_database()
        version = versions.new_version(self._base_path())
        stage = qualified(self.db, f"{self.table}__{uuid.uuid4().hex[:12]}")
        if not aligned:
            # One task per bucket, else every task writes a file for every
            # bucket it has rows of.
            df = df.repartition(n, *cols)
        writer = (
            df.write.format(self.fmt).mode("errorifexists")
            .bucketBy(n, *cols).sortBy(*cols).option("path", version)
        )
        if self.partition_by:
            # Stored with the table, so partition overwrites through the
            # catalog replace only the partitions written, whatever the
            # session's setting.
            writer = writer.partitionBy(*self.partition_by).option("partitionOverwriteMode", "dynamic")
        writer.saveAsTable(stage)
        versions.set_current(self.spark, version, df.schema)
        _swap(self.spark, stage, self.name)
        self.spark.catalog.refreshTable(self.name)
        return version

    def _bucketed(self, mode: str, df: DataFrame) -> None:
        if not self.name:
            raise ValueError("a bucketed table needs 'table_name'")
        stored = self._stored(df.schema)
        entry = stored is not None and _same_location(self.spark, table_location(self.spark, self.name), self.path())
        if mode == "append" and stored is not None:
            df = self._aligned(df, stored)
            if entry and df.columns == stored.columns:
                df.write.insertInto(self.name)
            else:  # new columns, or files without a catalog entry
                self._save_bucketed_version(stored.unionByName(df, allowMissingColumns=True))
            return
        if mode == "overwrite_partition" and entry and self.partition_by:
            options = _entry(self.spark, self.name).storage().properties()
            if not options.contains("partitionOverwriteMode") or options.apply("partitionOverwriteMode") != "dynamic":
                raise ValueError(f"{self.name} was not created for partition overwrites; overwrite it once first")
            self._aligned(df, stored).select(*stored.columns).write.insertInto(self.name, overwrite=True)
            return
        if mode == "overwrite_partition" and stored is not None and self.partition_by:
            raise ValueError(f"{self.path()} holds a bucketed table without a catalog entry; upsert or append to it first")
        if mode == "upsert":
            # The two joins keep the target in its buckets, so neither they
            # nor the write shuffle it.
            self._upsert_whole(df, stored, lambda merged: self._save_bucketed_version(merged, aligned=entry), one_pass=not entry)
            return
        # overwrite; the first append; a partition overwrite of a new or
        # unpartitioned table (which replaces all of it)
        self._save_bucketed_version(df)

    def _upsert_whole(self, df: DataFrame, stored: DataFrame | None, save, one_pass: bool = True) -> None:
        """Merge with the whole stored table and save the result."""
        source = self._pinned(df)
        try:
            save(plan_merge(
                self.spark.createDataFrame([], df.schema) if stored is None else stored,
                source, list(self.config["primary_key"]), list(self.config.get("change_tracking_column") or []),
                bool(self.config.get("null_safe", False)),
                broadcast_bytes=int(self.config.get("broadcast_bytes", DEFAULT_BROADCAST_BYTES)),
                one_pass=one_pass,
                skew_bytes=int(self.config.get("skew_bytes", SKEW_BYTES)),
            ))
        finally:
            self._unpin()

    def _unpin(self) -> None:
        remove(self.spark, self._pin)

    def _pinned(self, df: DataFrame) -> DataFrame:
        """The upsert source, written once as Parquet in the shared scratch
        folder. The profile, the update join and the insert join all read
        the same rows (the profile only the key columns), and a lost
        executor's part is read back from the files instead of being
        recomputed from a source that may have changed since (a database,
        a growing folder)."""
        self._pin = new_work_dir(self.spark, "upsert_source")
        df.write.parquet(self._pin)
        return self.spark.read.parquet(self._pin)

    def _layout(self, df: DataFrame) -> DataFrame:
        if self.config.get("rebalance", True):
            return rebalanced(df, self.partition_by)
        return df

    def _note_schema(self, named: versions.State | None, path: str, schema: T.StructType, replaced: bool) -> None:
        """Name the table's schema on storage when a write changed it: no
        file and no other session's catalog holds it otherwise."""
        if named is None:
            if self.config.get("merge_schema") or self.config.get("widen_types"):
                versions.set_state(self.spark, versions.State(path, (versions.Part(""),), schema))
        elif replaced or named.schema is None or [f.dataType for f in named.schema.fields] != [f.dataType for f in schema.fields] or named.schema.names != schema.names:
            versions.set_state(self.spark, replace(named, schema=schema))

    def _batch(self) -> str | None:
        """The id an append is done under once; ``${run_date}`` in it is the
        run date."""
        batch = self.config.get("batch_id")
        return None if batch is None else substitute_run_date(str(batch), self.run_date)

    def _write_files(self, df: DataFrame, mode: str, overwrite_mode: str | None = None, batch: str | None = None) -> str:
        self._ensure_database()
        path = self.path()
        if self.fmt not in V2_FORMATS and overwrite_mode != "static":
            df = self._aligned(df, self._stored(df.schema))
        named = versions.state(self.spark, self._base_path()) if self.fmt not in V2_FORMATS else None
        replaces = overwrite_mode == "static" or (overwrite_mode == "dynamic" and not self.partition_by)
        in_parts = named is not None and not named.whole
        read = any(versions.reads_path(df, p) for p in (named.folders() if in_parts else [path])) if overwrite_mode == "static" else False
        if self.fmt not in V2_FORMATS and replaces and (read or in_parts):
            # A static overwrite deletes the folder before the job reads
            # it, and a table in parts has others. Write a new version
            # instead and re-point the table.
            if not self.name and read:
                raise ValueError(f"cannot overwrite {path}: the data is read from it (give a table_name)")
            path = versions.new_version(versions.base_of(path))
            mode = "errorifexists"
        seen = None
        if (self.name or self._dated) and self.partition_by and overwrite_mode != "static" and self.fmt not in V2_FORMATS:
            # Whether this write holds one partition value, as a dated run
            # does, gathered by the write job itself: a few numbers,
            # however many partitions there are.
            seen = Observation(f"partitions_{uuid.uuid4().hex[:8]}")
            own = F.col(self._dated).cast("string") == F.lit(str(self.run_date)) if self._dated else F.lit(False)
            df = df.observe(
                seen, F.count(F.lit(1)).alias("n"), F.count_if(own).alias("own"),
                *[f(c).alias(f"{k}{i}") for i, c in enumerate(self.partition_by) for k, f in (("lo", F.min), ("hi", F.max), ("n", F.count))],
            )
        writer = self._layout(df).write.format(self.fmt).mode(mode)
        if self.partition_by:
            writer = writer.partitionBy(*self.partition_by)
        if overwrite_mode:
            writer = writer.option("partitionOverwriteMode", overwrite_mode)
        if self.config.get("merge_schema") and self.fmt == "delta":
            writer = writer.option("mergeSchema", "true")
        writer.save(path)
        if mode == "errorifexists":
            versions.set_current(self.spark, path, df.schema)
            in_parts = False
        elif self.fmt not in V2_FORMATS:
            self._note_schema(named, path, df.schema, replaces)
        if batch is not None:
            versions.add_batch(self.spark, self._base_path(), batch)
        if self.name and in_parts:
            register_parts(self.spark, self.name, self.fmt, versions.state(self.spark, self._base_path()))
        elif self.name:
            # A static overwrite of a partitioned table may have removed
            # partitions, and any overwrite may have changed the columns.
            register_table(
                self.spark, self.name, self.fmt, path, self.partition_by,
                force=overwrite_mode == "static",
                first=bool(self.config.get("first")),
                merge_schema=overwrite_mode != "static",
                written=self._one_partition(seen),
                schema=df.schema,
            )
        if overwrite_mode == "dynamic" and seen is not None and self._dated:
            got = self._metrics(seen)
            if df.filter(own).isEmpty() if got is None else not got["own"]:
                self._clear_own_partition(path)
        return path

    @property
    def _dated(self) -> str | None:
        """The column of a dated run's own partition, if the table is
        partitioned by it alone."""
        column = self.config.get("run_date_column", "run_date")
        return column if self.run_date is not None and self.partition_by == [column] else None

    def _clear_own_partition(self, path: str) -> None:
        """A re-run that finds no rows for its date takes the rows of the
        earlier run away: a dynamic overwrite alone would leave them."""
        # The entry first: one to nothing would be read as an error.
        if self.name and _tracks_partitions(self.spark, self.name):
            self.spark.sql(f"ALTER TABLE {self.name} DROP IF EXISTS PARTITION (`{self._dated}` = {_spec_literal(self.run_date)})")
            self.spark.catalog.refreshTable(self.name)
        fs, folder = versions.file_system(self.spark, f"{path}/{self._dated}={self.run_date}")
        if fs.exists(folder):
            fs.delete(folder, True)

    def _replace_where(self, df: DataFrame) -> None:
        """Replace all partitions that ``replace_where`` covers: those with
        new rows and those without any, which are cleared. ``{"column": the
        first partition column, "values": [...]}`` or ``"from"`` / ``"to"``
        (both included; dates, integers or text). Rows outside the condition
        are an error, before anything changes.

        The rows are written aside once. Then the list of partitions to put
        in place and to take away is named on storage in one rename, and
        carried out; a run that dies is finished by the next write.
        """
        where = self.config["replace_where"]
        column = where["column"]
        if not self.partition_by or self.partition_by[0].lower() != column.lower():
            raise ValueError(f"replace_where needs the first partition column, {self.partition_by[:1]}, not {column!r}")
        if self._bucket_spec():
            raise ValueError("replace_where is not for bucketed tables")
        self._ensure_database()
        df = self._aligned(df, self._stored(df.schema))
        base, path = self._base_path(), self.path()
        kind = {f.name.lower(): f.dataType for f in df.schema.fields}[column.lower()]
        covers = _covering(where, kind)
        c = F.col(f"`{column}`")
        if "values" in where:
            inside = c.cast("string").isin([str(v) for v in where["values"]])
        else:
            inside = (c >= F.lit(str(where["from"])).cast(kind)) & (c <= F.lit(str(where["to"])).cast(kind))
        seen = Observation(f"replaced_{uuid.uuid4().hex[:8]}")
        watched = df.observe(seen, F.count_if(~F.coalesce(inside, F.lit(False))).alias("outside"), F.count(F.lit(1)).alias("n"))
        staged = f"{base}/{versions.FOLDER}/.replace-{uuid.uuid4().hex[:12]}"
        self._layout(watched).write.format(self.fmt).mode("errorifexists").partitionBy(*self.partition_by).save(staged)
        got = self._metrics(seen)
        if (got["outside"] if got else df.where(~F.coalesce(inside, F.lit(False))).count()) > 0:
            versions.file_system(self.spark, staged)[0].delete(versions.file_system(self.spark, staged)[1], True)
            raise ValueError(f"rows outside of {where} in an overwrite of just that")
        new = versions.folders_of(self.spark, staged, column)
        old = {v: f for v, f in versions.folders_of(self.spark, path, column).items() if covers(v)}
        gone = [f for v, f in old.items() if v not in new]
        if self.name and _tracks_partitions(self.spark, self.name):
            for v in old:
                if v not in new:
                    self.spark.sql(f"ALTER TABLE {self.name} DROP IF EXISTS PARTITION (`{column}` = {_spec_literal(v)})")
        versions.replace_folders(self.spark, base, path, staged, list(new.values()), gone)
        if self.name:
            written = [{column: v} for v in new] if len(self.partition_by) == 1 else None
            register_table(self.spark, self.name, self.fmt, path, self.partition_by, merge_schema=True, written=written, schema=df.schema)

    def _metrics(self, seen: Observation) -> dict | None:
        try:
            return seen.get
        except Exception as e:  # an empty write planned away has none
            log.info("no write metrics (%s)", e)
            return None

    def _one_partition(self, seen: Observation | None) -> list[dict] | None:
        """The one partition a write produced ([] for an empty write), None
        if there may be more."""
        got = self._metrics(seen) if seen is not None else None
        if not got:
            return None
        if got["n"] == 0:
            return []
        one = all(got[f"n{i}"] == got["n"] and got[f"lo{i}"] == got[f"hi{i}"] for i in range(len(self.partition_by)))
        return [{c: got[f"lo{i}"] for i, c in enumerate(self.partition_by)}] if one else None

    def _v2_writer(self, df: DataFrame):
        self._ensure_database()
        if not self.spark.catalog.tableExists(self.name):
            w = df.limit(0).writeTo(self.name).using(self.fmt)
            if self.partition_by:
                w = w.partitionedBy(*[F.col(c) for c in self.partition_by])
            w.create()
        return df.writeTo(self.name)

    # -- modes -----------------------------------------------------------
    def append(self, df: DataFrame) -> None:
        if self._bucket_spec() and self.fmt not in V2_FORMATS:
            self._bucketed("append", df)
        elif self.fmt in CATALOG_WRITE_FORMATS:
            self._v2_writer(df).append()
        else:
            batch = self._batch()
            if batch is not None and versions.has_batch(self.spark, self._base_path(), batch):
                # Done already; its registration may have failed.
                log.info("batch %s is in %s", batch, self.name or self.path())
                stored = self._stored(df.schema)
                if self.name and not _is_view(self.spark, self.name):
                    register_table(self.spark, self.name, self.fmt, self.path(), self.partition_by, merge_schema=True, schema=stored.schema if stored is not None else df.schema)
                return
            self._write_files(df, "append", batch=batch)

    def overwrite(self, df: DataFrame) -> None:
        if self._bucket_spec() and self.fmt not in V2_FORMATS:
            self._bucketed("overwrite", df)
        elif self.fmt in CATALOG_WRITE_FORMATS:
            self._v2_writer(df).overwrite(F.lit(True))
        else:
            self._write_files(df, "overwrite", "static")

    def overwrite_partition(self, df: DataFrame) -> None:
        if self._bucket_spec() and self.fmt not in V2_FORMATS:
            self._bucketed("overwrite_partition", df)
        elif self.fmt in CATALOG_WRITE_FORMATS:
            self._v2_writer(df).overwritePartitions()
        elif self.config.get("replace_where") and self.fmt not in V2_FORMATS:
            self._replace_where(df)
        else:
            self._write_files(df, "overwrite", "dynamic")

    def upsert(self, df: DataFrame) -> None:
        if not self.name:
            raise ValueError("upsert needs 'table_name'")
        keys = list(self.config["primary_key"])
        tracked = list(self.config.get("change_tracking_column") or [])
        null_safe = bool(self.config.get("null_safe", False))
        if self.fmt in V2_FORMATS:
            self._merge_v2(df, keys, tracked, null_safe)
            return
        if self._bucket_spec():
            self._bucketed("upsert", df)
            return
        self._ensure_database()
        stored = self._stored(df.schema)
        scope = self.config.get("upsert_scope", "partitions")
        if stored is not None and self.partition_by and set(self.partition_by) <= set(keys) and scope == "partitions":
            self._upsert_partitions(df, stored, keys, tracked, null_safe)
            return
        if stored is not None and not self.partition_by and scope == "files" and self._upsert_files(df, stored, keys, tracked, null_safe):
            return

        def save(merged: DataFrame) -> None:
            version = versions.new_version(self._base_path())
            writer = self._layout(merged).write.format(self.fmt).mode("errorifexists")
            if self.partition_by:
                writer = writer.partitionBy(*self.partition_by)
            writer.save(version)
            versions.set_current(self.spark, version, merged.schema)
            register_table(self.spark, self.name, self.fmt, version, self.partition_by, schema=merged.schema)

        self._upsert_whole(df, stored, save)

    def _upsert_partitions(self, df: DataFrame, stored: DataFrame, keys, tracked, null_safe) -> None:
        """Upsert that rewrites only the partitions the source touches.

        Valid when the partition columns are part of the key: a source row
        can then only match target rows of its own partition. The touched
        values (few, on the driver) filter the target's scan as literals,
        so Spark prunes it to their folders; the merged rows go back with a
        dynamic partition overwrite, which stages the files before
        replacing each touched partition. Untouched partitions are neither
        read nor written. Beyond MAX_ADDED_PARTITIONS values the target is
        read through a semi join instead.
        """
        parts = self.partition_by
        location = self.path()
        source = self._pinned(df)
        touched = source.select(*parts).distinct()
        few = [r.asDict() for r in touched.limit(MAX_ADDED_PARTITIONS + 1).collect()]
        if len(few) <= MAX_ADDED_PARTITIONS:
            known, target = few, stored
            for p in parts:
                target = target.filter(_one_of(p, {r[p] for r in few}))
            if len(parts) > 1:  # the pairs, not only the values
                pairs = F.broadcast(touched)  # at most MAX_ADDED_PARTITIONS rows
                target = target.join(pairs, [target[p].eqNullSafe(pairs[p]) for p in parts], "left_semi")
        else:
            known = None
            target = stored.join(touched, [stored[p].eqNullSafe(touched[p]) for p in parts], "left_semi")
        try:
            merged = plan_merge(
                target, source, keys, tracked, null_safe,
                broadcast_bytes=int(self.config.get("broadcast_bytes", DEFAULT_BROADCAST_BYTES)),
                skew_bytes=int(self.config.get("skew_bytes", SKEW_BYTES)),
            )
            writer = self._layout(merged).write.format(self.fmt).mode("overwrite")
            writer.option("partitionOverwriteMode", "dynamic").partitionBy(*parts).save(location)
            register_table(self.spark, self.name, self.fmt, location, parts, written=known, schema=merged.schema)
        finally:
            self._unpin()

    def _upsert_files(self, df: DataFrame, stored: DataFrame, keys, tracked, null_safe) -> bool:
        """Upsert that rewrites only the files that hold matched keys; the
        others stay as they are. False (and nothing done) where that does
        not pay: too many of the files are touched, or the table's state
        would list too much, and then a whole rewrite puts it in one part.

        The touched files are found by a scan of the key columns, bounded by
        the source's smallest and largest key, which Parquet's statistics
        prune; a source row can match in no other file, so those files and
        the source are all the merge has to read. The new state, one rename,
        lists a folder more and the files that no longer count.
        """
        named = versions.state(self.spark, self._base_path()) or versions.State(self.path(), (versions.Part(""),))
        spelled = {c.lower(): c for c in stored.columns}
        keys = [spelled.get(k.lower(), k) for k in keys]
        source = self._pinned(df)
        try:
            bounds = source.agg(*[f(F.col(f"`{k}`")).alias(f"{n}{i}") for i, k in enumerate(keys) for n, f in (("lo", F.min), ("hi", F.max))]).first()
            near = stored.select(*[F.col(f"`{k}`") for k in keys], F.col("_metadata.file_name").alias("_file"))
            for i, k in enumerate(keys):
                if bounds[f"lo{i}"] is not None:
                    near = near.where(F.col(f"`{k}`").between(F.lit(bounds[f"lo{i}"]), F.lit(bounds[f"hi{i}"])))
            sought = source.select(*[F.col(f"`{k}`").alias(f"_s{i}") for i, k in enumerate(keys)]).distinct()
            same = [F.col(f"`{k}`") == F.col(f"_s{i}") for i, k in enumerate(keys)]
            touched = [r[0] for r in near.join(sought, same, "left_semi").select("_file").distinct().limit(MAX_DEAD + 1).collect()]
            dead = sum(len(p.dead) for p in named.parts) + len(touched)
            total = sum(self._files_in(f) for f in named.folders()) - (dead - len(touched))
            if len(touched) > MAX_TOUCHED_SHARE * total or dead > MAX_DEAD or len(named.parts) >= MAX_FILE_PARTS:
                return False
            target = stored.where(F.col("_metadata.file_name").isin(touched)) if touched else stored.limit(0)
            merged = plan_merge(
                target, source, keys, tracked, null_safe,
                broadcast_bytes=int(self.config.get("broadcast_bytes", DEFAULT_BROADCAST_BYTES)),
                skew_bytes=int(self.config.get("skew_bytes", SKEW_BYTES)),
            )
            version = versions.new_version(named.base)
            merged.write.format(self.fmt).mode("errorifexists").save(version)
            parts = []
            for p, folder in zip(named.parts, named.folders()):
                own = set(touched) & self._names_in(folder) if touched else set()
                parts.append(versions.Part(p.folder, tuple(sorted({*p.dead, *own}))))
            now = versions.State(named.base, (*parts, versions.Part(f"{versions.FOLDER}/{version.rpartition('/')[2]}")), merged.schema)
            versions.set_state(self.spark, now)
            register_parts(self.spark, self.name, self.fmt, now)
            return True
        finally:
            self._unpin()

    def _names_in(self, folder: str) -> set[str]:
        """The data files right in a folder, by name."""
        fs, p = versions.file_system(self.spark, folder)
        names = [s.getPath().getName() for s in fs.listStatus(p) if s.isFile()]
        return {n for n in names if not n.startswith((".", "_"))}

    def _files_in(self, folder: str) -> int:
        return len(self._names_in(folder))

    def _merge_v2(self, df: DataFrame, keys, tracked, null_safe) -> None:
        if self.fmt in CATALOG_WRITE_FORMATS:
            self._v2_writer(df)  # create if missing
        elif not self.spark.catalog.tableExists(self.name):
            self._write_files(df.limit(0), "append")  # empty table at the path, registered
        on = [F.col(f"{self.name}.`{k}`") == F.col(f"s.`{k}`") for k in keys]
        merge = df.alias("s").mergeInto(self.name, reduce(Column.__and__, on))
        if tracked:
            pairs = [(F.col(f"{self.name}.`{c}`"), F.col(f"s.`{c}`")) for c in tracked]
            changed = [~old.eqNullSafe(new) if null_safe else old != new for old, new in pairs]
            merge = merge.whenMatched(reduce(Column.__or__, changed)).update({c: new for c, (_, new) in zip(tracked, pairs)})
        merge.whenNotMatched().insertAll().merge()


def _covering(where: dict, kind: T.DataType):
    """Whether ``replace_where`` covers a partition value, given as the text
    of its folder."""
    if "values" in where:
        some = {str(v) for v in where["values"]}
        return lambda v: v in some
    read = {T.DateType: dt.date.fromisoformat, T.StringType: str}.get(type(kind), int)
    low, high = read(str(where["from"])), read(str(where["to"]))
    return lambda v: v != "__HIVE_DEFAULT_PARTITION__" and low <= read(v) <= high


def _one_of(column: str, values: set) -> Column:
    """Whether a partition column has one of a few values (NULL included)."""
    some = [v for v in values if v is not None]
    found = F.col(f"`{column}`").isin(some) if some else F.lit(False)
    return found | F.col(f"`{column}`").isNull() if None in values else found


class ConsoleSink:
    """Prints the frame untruncated; every mode does the same."""

    def __init__(self, spark: SparkSession, config: dict, run_date=None, writer: str | None = None):
        self.rows = int(config.get("rows", 20))

    def _show(self, df: DataFrame) -> None:
        df.show(self.rows, truncate=False)

    append = overwrite = overwrite_partition = _show

    def upsert(self, df: DataFrame) -> None:
        raise NotImplementedError("the console sink has no upsert")

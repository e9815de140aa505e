"""Which version of a file table is current, kept on storage.

An upsert or a guarded overwrite writes the whole table as a new folder
``<base>/_versions/<id>`` and then names it in ``<base>/_versions/_current``,
a small file put in place by a single rename. It also holds the table's
schema and, after an upsert that rewrote only some files, the list of folders
and of files that no longer count. The file is the authority: a catalog entry
only follows it, so a lost entry, or one whose change failed half-way, never
makes a later write start from an older table or from nothing.
"""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FOLDER, POINTER, REPLACING = "_versions", "_current", "_replacing"


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path for it."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def qualified_path(spark: SparkSession, path: str) -> str:
    """The path with scheme and authority, decoded, without a trailing
    slash: two spellings of one folder come out equal."""
    fs, p = file_system(spark, path)
    return fs.makeQualified(p).toString().rstrip("/")


def base_of(location: str) -> str:
    """The table's base folder, given any of its locations."""
    return location.split(f"/{FOLDER}/")[0]


def new_version(base: str) -> str:
    return f"{base.rstrip('/')}/{FOLDER}/{int(time.time() * 1000)}-{uuid.uuid4().hex[:8]}"


@dataclass(frozen=True)
class Part:
    """A folder of a version, and the names of files in it that no longer
    count. The folder is relative to the table's base ("" is the base)."""

    folder: str
    dead: tuple[str, ...] = ()


@dataclass(frozen=True)
class State:
    """What a table is made of, as named on storage: usually one folder;
    after upserts that rewrote only some files, several with dead files.
    ``schema`` is the table's own, where a write has named it."""

    base: str
    parts: tuple[Part, ...]
    schema: T.StructType | None = None

    def folders(self) -> list[str]:
        return [f"{self.base}/{p.folder}".rstrip("/") for p in self.parts]

    @property
    def path(self) -> str:
        """The newest folder, where further files go."""
        return self.folders()[-1]

    @property
    def whole(self) -> bool:
        """Whether the table is one folder with all its files."""
        return len(self.parts) == 1 and not self.parts[0].dead


def state(spark: SparkSession, base: str) -> State | None:
    """What the table at ``base`` is made of; None if no version was ever
    named there."""
    base = base.rstrip("/")
    text = _read_text(spark, f"{base}/{FOLDER}/{POINTER}")
    if text is None:
        return None
    name, _, rest = text.strip().partition("\n")
    more = json.loads(rest) if rest else {}
    own = "" if name == "." else f"{FOLDER}/{name}"
    parts = tuple(Part(p["folder"], tuple(p["dead"])) for p in more.get("parts", [])) or (Part(own),)
    schema = T.StructType.fromJson(more["schema"]) if more.get("schema") else None
    return State(base, parts, schema)


def current(spark: SparkSession, base: str) -> str | None:
    """The current version's folder, or None for a table without versions."""
    found = state(spark, base)
    return found.path if found else None


def read(spark: SparkSession, found: State, reader) -> DataFrame:
    """The table's rows through ``reader`` (format, schema and options set):
    one scan; dead files are left out by the file listing."""
    df = reader.load(found.folders() if len(found.parts) > 1 else found.path)
    dead = [n for p in found.parts for n in p.dead]
    return df.where(~F.col("_metadata.file_name").isin(dead)) if dead else df


def _read_text(spark: SparkSession, path: str) -> str | None:
    fs, p = file_system(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _put_text(spark: SparkSession, folder: str, name: str, text: str) -> None:
    """A small file, put in place over an older one by a single rename."""
    jvm = spark._jvm
    fs, new = file_system(spark, f"{folder}/.{name}-{uuid.uuid4().hex}")
    out = fs.create(new)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(fs.makeQualified(new), fs.makeQualified(file_system(spark, f"{folder}/{name}")[1]), options)


def set_current(spark: SparkSession, version: str, schema: T.StructType | None = None) -> None:
    """Name ``version`` (a folder written by new_version) as the current
    one, in one rename over the old pointer."""
    base, _, name = version.rpartition(f"/{FOLDER}/")
    set_state(spark, State(base, (Part(f"{FOLDER}/{name}"),), schema))


def set_state(spark: SparkSession, found: State) -> None:
    """Name a table's parts and schema, in one rename."""
    own = found.parts[-1].folder
    more = {}
    if found.schema is not None:
        more["schema"] = json.loads(found.schema.json())
    if not found.whole:
        more["parts"] = [{"folder": p.folder, "dead": list(p.dead)} for p in found.parts]
    name = own.removeprefix(f"{FOLDER}/") if own else "."
    _put_text(spark, f"{found.base}/{FOLDER}", POINTER, name + ("\n" + json.dumps(more) if more else ""))


# ------------------------------------------------- batches that were appended
def _batch_name(batch: str) -> str:
    return "batch-" + hashlib.sha256(batch.encode()).hexdigest()[:32]


def has_batch(spark: SparkSession, base: str, batch: str) -> bool:
    fs, p = file_system(spark, f"{base.rstrip('/')}/{FOLDER}/_batches/{_batch_name(batch)}")
    return fs.exists(p)


def add_batch(spark: SparkSession, base: str, batch: str) -> None:
    _put_text(spark, f"{base.rstrip('/')}/{FOLDER}/_batches", _batch_name(batch), batch)


# --------------------------------------------------- replacing partitions
def folders_of(spark: SparkSession, path: str, column: str) -> dict[str, str]:
    """{partition value, as text: folder name} of the folders
    ``column=value`` right under ``path``."""
    fs, p = file_system(spark, path)
    if not fs.exists(p):
        return {}
    names = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    start = names.escapePathName(column) + "="
    found = [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]
    return {names.unescapePathName(n[len(start) :]): n for n in found if n.lower().startswith(start.lower())}


def replace_folders(spark: SparkSession, base: str, target: str, staged: str, put: list[str], drop: list[str]) -> None:
    """Put the folders ``put`` of ``staged`` in the place of those of
    ``target``, and take ``drop`` away. The list is written first, in one
    rename; from then on a run that dies is finished by the next write
    (``finish_replacing``)."""
    plan = {"target": target, "staged": staged, "put": put, "drop": drop}
    _put_text(spark, f"{base.rstrip('/')}/{FOLDER}", REPLACING, json.dumps(plan))
    finish_replacing(spark, base)


def finish_replacing(spark: SparkSession, base: str) -> bool:
    """Carry out a written list of folders to replace, wherever an earlier
    run stopped; False if there is none."""
    folder = f"{base.rstrip('/')}/{FOLDER}"
    text = _read_text(spark, f"{folder}/{REPLACING}")
    if text is None:
        return False
    plan = json.loads(text)
    fs, target = file_system(spark, plan["target"])
    fs.mkdirs(target)
    at = lambda root, name: spark._jvm.org.apache.hadoop.fs.Path(root, name)
    for name in plan["drop"]:
        fs.delete(at(plan["target"], name), True)
    for name in plan["put"]:
        new, old = at(plan["staged"], name), at(plan["target"], name)
        if fs.exists(new):  # else it is in its place already
            fs.delete(old, True)
            if not fs.rename(new, old):
                raise OSError(f"{new} could not be renamed to {old}")
    fs.delete(file_system(spark, plan["staged"])[1], True)
    fs.delete(file_system(spark, f"{folder}/{REPLACING}")[1], False)
    return True


def holds_data(spark: SparkSession, path: str) -> bool:
    """Whether any data file lies under ``path`` (names that begin with _ or
    . are no data); stops at the first."""
    fs, p = file_system(spark, path)
    if not fs.exists(p):
        return False
    todo = [p]
    while todo:
        for status in fs.listStatus(todo.pop()):
            name = status.getPath().getName()
            if name.startswith((".", "_")):
                continue
            if status.isFile():
                return True
            todo.append(status.getPath())
    return False


def root_paths(df) -> list[str]:
    """Root folders of the file scans ``df`` reads, decoded and qualified,
    from the plan's relations: a few per scan, however many files."""
    out = []
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    for i in range(leaves.length()):
        leaf = leaves.apply(i)
        if leaf.getClass().getSimpleName() != "LogicalRelation":
            continue
        relation = leaf.relation()
        if relation.getClass().getSimpleName() != "HadoopFsRelation":
            continue
        paths = relation.location().rootPaths()
        out += [qualified_path(df.sparkSession, paths.apply(j).toString()) for j in range(paths.length())]
    return out


def reads_path(df, path: str) -> bool:
    """Whether ``df`` reads files at, under or around ``path``."""
    own = qualified_path(df.sparkSession, path)
    return any(own == p or own.startswith(p + "/") or p.startswith(own + "/") for p in root_paths(df))

"""Keyed upsert with change tracking, as DataFrame operations.

Semantics (the ``MERGE`` a job's ``upsert`` mode describes):

* a target row and a source row match when every key column is equal;
  NULL keys never match, so such source rows are always inserted;
* a matched target row is updated when any tracked column differs. The
  default test is ``<>``, under which a change to or from NULL is not an
  update; ``null_safe=True`` uses ``IS DISTINCT FROM``. On update all
  tracked columns take the source value, other columns keep the target's;
* unmatched source rows are inserted with all their columns;
* more than one source row matching a target row is an error (as in
  ``MERGE``); duplicate source keys that match nothing are all inserted,
  and duplicate target keys are each updated.

Plan. The source is measured first (one aggregation, also used for the
duplicate check).

* Small against the target (under ``broadcast_bytes`` and a quarter of the
  target's size): it is broadcast, so the target is never shuffled;
  ``target LEFT JOIN source`` gives updated and untouched rows, ``source
  LEFT ANTI JOIN target-keys`` the inserts, the keys being a second,
  column-pruned scan.
* Larger, without repeated keys: one ``FULL OUTER JOIN``, so either side is
  read and shuffled once. Rows with a NULL key match nothing; a salt spreads
  them, as NULLs would else all hash to one task. Spark cannot split a full
  outer join, so a key that many target rows share would be one task: such
  keys are counted first (``hot_keys``), their target rows are dealt over
  salts, and their source rows, one a key, are repeated for each salt.
* Larger, with repeated keys (which then match nothing): the two joins as
  above without the broadcast, which AQE can split.

Column names compare like Spark's (not by case).
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.operators.frequent import candidate_counts
from quarry.operators.schemas import fit, reconcile
from quarry.operators.sizing import DEFAULT_BROADCAST_BYTES, plan_bytes, row_width

_T, _S, _HIT, _SALT, _OLD = "__t", "__s", "__s_hit", "__salt", "__t_hit"
_SALTS, _HOT = "__salts", "__s_hot"
SALTS = 1024
# A target of fewer bytes is not searched for hot keys: a task can take it.
SKEW_BYTES = 256 * 1024 * 1024
MAX_PARTS = 10_000  # a key with this share of the target's rows is hot, at least
# A source under this share of the target's bytes is worth a second scan of
# the target's keys rather than a shuffle of the target.
SMALL_SHARE = 0.25

class DuplicateSourceKeyError(ValueError):
    pass


@dataclass(frozen=True)
class SourceProfile:
    rows: int
    max_rows_per_key: int
    est_bytes: int
    dup_keys: int = 0


def _q(alias: str, name: str) -> Column:
    return F.col(f"{alias}.`{name}`")


def profile_source(source: DataFrame, keys: list[str]) -> SourceProfile:
    """Row count, largest key group and number of repeated keys of the
    source, in one aggregation (partial aggregation keeps a hot key cheap)."""
    row = (
        source.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(
            F.sum("n").alias("rows"),
            F.max("n").alias("max_n"),
            F.count(F.when(F.col("n") > 1, True)).alias("dups"),
        )
        .first()
    )
    rows = int(row["rows"] or 0)
    return SourceProfile(rows, int(row["max_n"] or 0), rows * row_width(source.schema), int(row["dups"] or 0))


def _key_condition(keys: list[str], left: str, right: str) -> Column:
    return reduce(lambda a, b: a & b, [_q(left, k) == _q(right, k) for k in keys])


def check_duplicate_matches(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    dup_keys: int | None = None,
    broadcast_bytes: int = DEFAULT_BROADCAST_BYTES,
) -> None:
    """Raise if a key that occurs more than once in the source matches a
    target row. Runs only when the profile found repeated source keys.

    When the repeated keys are known to be few (``dup_keys`` from the
    profile, sized against ``broadcast_bytes``) they are broadcast and the
    target is only scanned. Otherwise the target keys are de-duplicated
    map-side before the shuffle, so a hot target key cannot load one task.
    """
    dups = source.groupBy(*keys).count().filter(F.col("count") > 1).select(*keys)
    key_bytes = row_width(dups.schema)
    if dup_keys is not None and dup_keys * key_bytes <= broadcast_bytes:
        clash = target.select(*keys).alias(_T).join(
            F.broadcast(dups).alias(_S), _key_condition(keys, _T, _S), "left_semi"
        )
    else:
        clash = dups.alias(_S).join(
            target.select(*keys).distinct().alias(_T), _key_condition(keys, _S, _T), "left_semi"
        )
    hit = clash.take(1)
    if hit:
        raise DuplicateSourceKeyError(
            f"several source rows match the same target row, e.g. key {hit[0].asDict()}"
        )


def _changed(tracked: list[str], null_safe: bool) -> Column:
    """Whether a tracked column of the joined rows differs."""
    pairs = [(_q(_T, c), _q(_S, c)) for c in tracked]
    diffs = [~a.eqNullSafe(b) if null_safe else a != b for a, b in pairs]
    return F.coalesce(reduce(Column.__or__, diffs), F.lit(False)) if diffs else F.lit(False)


def hot_keys(target: DataFrame, keys: list[str], parts: int) -> DataFrame | None:
    """(keys, __salts): the keys that hold more than a ``parts``-th of the
    target's rows, and over how many tasks their rows should be dealt; None
    without any. Counted by hash, exactly, then looked up by value; at most
    2 x ``parts`` salts in all, so this may be broadcast."""
    spark = target.sparkSession
    known = target.select(*[F.col(f"`{k}`") for k in keys], F.xxhash64(*[F.col(f"`{k}`") for k in keys]).alias("h"))
    known = known.where(reduce(Column.__and__, [F.col(f"`{k}`").isNotNull() for k in keys]))
    share = 1 / min(max(parts, 2), MAX_PARTS)
    counted, fair = candidate_counts(known, ["h"], share)
    hot = [(int(r.value), -(-r.n // fair)) for r in counted.where(F.col("n") > fair).collect()]
    if not hot:
        return None
    salts = spark.createDataFrame(hot, f"h long, {_SALTS} long")
    return known.join(F.broadcast(salts), "h").select(*[F.col(f"`{k}`") for k in keys], _SALTS).distinct()


def _salted(target: DataFrame, source: DataFrame, keys: list[str], hot: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """Both sides with the salt they also meet by, and a mark each; source
    rows of hot keys are there once per salt."""
    no_match = reduce(Column.__or__, [F.col(f"`{k}`").isNull() for k in keys])

    def spread(df: DataFrame) -> Column:
        own = F.xxhash64(*[F.col(f"`{f.name}`") for f in df.schema.fields if not isinstance(f.dataType, T.MapType)])
        return F.pmod(own, F.lit(SALTS))

    t_spread, s_spread = spread(target), spread(source)
    if hot is not None:
        target = target.join(F.broadcast(hot), keys, "left").select(*[F.col(f"`{c}`") for c in target.columns], _SALTS)
        source = source.join(F.broadcast(hot), keys, "left").select(*[F.col(f"`{c}`") for c in source.columns], _SALTS)
    else:
        none = F.lit(None).cast("long").alias(_SALTS)
        target, source = target.select("*", none), source.select("*", none)
    dealt = F.when(no_match, t_spread).when(F.col(_SALTS).isNotNull(), F.monotonically_increasing_id() % F.col(_SALTS)).otherwise(0)
    copies = F.when(no_match, F.array(s_spread)).when(F.col(_SALTS).isNotNull(), F.sequence(F.lit(0).cast("long"), F.col(_SALTS) - 1)).otherwise(F.array(F.lit(0).cast("long")))
    t = target.select("*", dealt.cast("long").alias(_SALT), F.lit(True).alias(_OLD)).drop(_SALTS)
    s = source.select("*", (F.explode(copies) if hot is not None else F.get(copies, F.lit(0))).alias(_SALT), F.lit(True).alias(_HIT), F.col(_SALTS).isNotNull().alias(_HOT)).drop(_SALTS)
    return t, s


def _one_pass(target: DataFrame, source: DataFrame, keys: list[str], tracked: list[str], null_safe: bool, hot: DataFrame | None) -> DataFrame:
    """Both sides read and shuffled once; see the module's text."""
    t, s = _salted(target, source, keys, hot)
    both = t.alias(_T).join(s.alias(_S), _key_condition([*keys, _SALT], _T, _S), "full")
    if hot is not None:
        # A hot key is in the target, so a copy of its source row that met
        # nothing under its own salt is no new row.
        both = both.where(_q(_T, _OLD).isNotNull() | ~_q(_S, _HOT))
    old, update = _q(_T, _OLD).isNotNull(), _q(_S, _HIT).isNotNull() & _changed(tracked, null_safe)
    out = []
    for f in target.schema.fields:
        new = _q(_S, f.name) if f.name in source.columns else F.lit(None)
        kept = F.when(update, new).otherwise(_q(_T, f.name)) if f.name in tracked else _q(_T, f.name)
        out.append(F.when(old, kept).otherwise(new).cast(f.dataType).alias(f.name))
    return both.select(*out)


def _shaped(column: Column, field: T.StructField, want: T.DataType) -> Column:
    if not isinstance(want, (T.StructType, T.ArrayType, T.MapType)) or field.dataType == want:
        return column
    if reconcile(want, field.dataType, True, field.name).simpleString() != want.simpleString():
        raise ValueError(f"{field.name}: {want.simpleString()} in the target cannot hold {field.dataType.simpleString()}")
    return fit(column, field.dataType, want)


def merge_changes(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    tracked: list[str],
    null_safe: bool = False,
    broadcast_source: bool = False,
    unique_source: bool = False,
    hot_parts: int = 0,
) -> DataFrame:
    """The merged table (target columns, target order), lazily.

    ``broadcast_source`` must only be set when the source size has been
    checked, ``unique_source`` when no non-NULL key repeats in the source
    (see ``plan_merge``). ``hot_parts``: target keys with more than this
    part of its rows are split (0: none are looked for).
    """
    cols = target.columns
    spelled = {c.lower(): c for c in cols}
    source = source.select(*[F.col(f"`{c}`").alias(spelled.get(c.lower(), c)) for c in source.columns])
    keys, tracked = [spelled.get(c.lower(), c) for c in keys], [spelled.get(c.lower(), c) for c in tracked]
    missing = [c for c in list(keys) + list(tracked) if c not in cols or c not in source.columns]
    if missing:
        raise ValueError(f"key/tracked columns missing from target or source: {missing}")
    extra = [c for c in source.columns if c not in cols]
    if extra:
        raise ValueError(f"source columns not in target: {extra}")
    if not keys:
        raise ValueError("an upsert needs at least one key column")
    # Structs are matched field by field; every other type is cast below.
    kinds = {f.name: f.dataType for f in target.schema.fields}
    source = source.select(*[_shaped(F.col(f"`{f.name}`"), f, kinds[f.name]).alias(f.name) for f in source.schema.fields])

    if unique_source and not broadcast_source:
        hot = hot_keys(target, keys, hot_parts) if hot_parts else None
        return _one_pass(target, source, keys, tracked, null_safe, hot)
    src = source.withColumn(_HIT, F.lit(True))
    src_side = F.broadcast(src) if broadcast_source else src
    t, s = target.alias(_T), src_side.alias(_S)
    on = _key_condition(keys, _T, _S)

    update = _q(_S, _HIT).isNotNull() & _changed(tracked, null_safe)

    types = {f.name: f.dataType for f in target.schema.fields}
    # Every output column keeps the target's type, so a narrower source
    # type never changes the table's schema.
    kept = t.join(s, on, "left").select(
        *[
            (F.when(update, _q(_S, c)).otherwise(_q(_T, c)) if c in tracked else _q(_T, c))
            .cast(types[c])
            .alias(c)
            for c in cols
        ]
    )

    if broadcast_source:
        # Only keys that also occur in the (small) source can block an
        # insert: a broadcast semi join keeps this side as small as the
        # source, so it is broadcast in turn and the target never shuffles.
        target_keys = F.broadcast(
            target.select(*keys)
            .join(F.broadcast(source.select(*keys).distinct()), on=list(keys), how="left_semi")
            .distinct()
        )
    else:
        # De-duplicated map-side, so a hot target key shrinks before the
        # shuffle.
        target_keys = target.select(*keys).distinct()
    inserts = (
        src.alias(_S)
        .join(target_keys.alias(_T), _key_condition(keys, _S, _T), "left_anti")
        .select(
            *[
                (_q(_S, c) if c in source.columns else F.lit(None)).cast(types[c]).alias(c)
                for c in cols
            ]
        )
    )
    return kept.unionByName(inserts)


def plan_merge(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    tracked: list[str],
    null_safe: bool = False,
    broadcast_bytes: int = DEFAULT_BROADCAST_BYTES,
    one_pass: bool = True,
    skew_bytes: int = SKEW_BYTES,
) -> DataFrame:
    """Check the source, then return ``merge_changes`` with the join
    strategy the measured source size allows. ``one_pass`` may be withheld
    for a target that is already dealt by its key (bucketed). A target of
    ``skew_bytes`` or more is searched for hot keys."""
    prof = profile_source(source, keys)
    if prof.max_rows_per_key > 1:
        check_duplicate_matches(target, source, keys, prof.dup_keys, broadcast_bytes)
    size = plan_bytes(target)
    small = prof.est_bytes <= min(broadcast_bytes, SMALL_SHARE * size)
    get = target.sparkSession.conf.get
    parts = int(get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None) or get("spark.sql.shuffle.partitions"))
    return merge_changes(
        target,
        source,
        keys,
        tracked,
        null_safe,
        broadcast_source=small,
        unique_source=one_pass and prof.max_rows_per_key <= 1,
        hot_parts=parts if size >= skew_bytes else 0,
    )

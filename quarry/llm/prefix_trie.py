"""Conversation prefix trie by padded matrices of turn ids.

A turn's id is a 128-bit hash of its position, role and text. Every rebuilt
conversation becomes rows of at most WIDTH turns (a long one is many rows,
"bands", each under the hash of all turns before it), and the rows are dealt
by ranges of (band, prefix, ids, conversation) into shards of bounded size.
In a shard, numpy sorts the padded matrix lexicographically; a column changes
where two neighbours differ in it, and the changes OR-accumulated from the
left mark where a node starts at each depth. ``reduceat`` over those starts
gives every depth's members, smallest member, children and subtree sums.

A node's rows are neighbours, so only nodes on the path of a shard's first or
last row can go on in other shards. Those boundary nodes (and the nodes where
one band hangs from another) come out as partial rows, are recombined by
Spark and given back to the shards that hold them; all other nodes never
leave their shard.

Subtree sums: a node's figures are put at the row of its smallest member, on
its depth. A row's running sum from its end up to depth d is then what that
conversation adds to its node at depth d, and a node's subtree is the sum
over its rows. Later bands of a conversation add one total to each earlier
one.

What crosses the network: hash and length of every turn (never a text), 16
bytes a turn and row to the shards, a few rows a shard. Copies of one
conversation are sorted by their id as well, so they spread over shards; a
conversation of any length spreads over bands.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ordered import Running, chunked, running
from ..session import materialize
from .common import hash128, only

WIDTH = 64  # turns of a matrix row
SHARD_ROWS = 4096
BLOCK = 5  # conversations that share a head
HEADS = 9  # heads have 0 to 8 turns
_PAD, _NONE = np.iinfo(np.int64).min, np.iinfo(np.int64).max
NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
_EDGE = "shard int, depth long, k1 long, k2 long, pk1 long, pk2 long, span boolean, n long, owner long, kids long, ends binary"
_EMPTY = hashlib.sha256(b"").hexdigest()


def _schema(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "string": pa.string(), "binary": pa.binary()}
    return pa.schema([(n, kinds[k]) for n, k in (f.split() for f in ddl.split(", "))])


def _table(columns: dict[str, list[np.ndarray | list]], schema: pa.Schema) -> pa.Table:
    flat = {n: [x for part in parts for x in (part.tolist() if isinstance(part, np.ndarray) else part)] for n, parts in columns.items()}
    return pa.table([pa.array(flat.get(f.name, []), f.type) for f in schema], schema=schema)


class Shard:
    """The sorted matrix of one shard, and its nodes by depth."""

    def __init__(self, table: pa.Table, full: int):
        self.full = full  # turns of a full row
        column = lambda n: np.asarray(table[n].combine_chunks())
        conv, band, p1, p2 = column("conv_id"), column("band"), column("p1"), column("p2")
        lens = np.asarray(table["bytes"].combine_chunks().value_lengths()).astype(np.int64)
        width = int(lens.max())
        ids = np.full((len(conv), 2 * width), _PAD, np.int64)
        ids[np.arange(2 * width)[None, :] < 2 * lens[:, None]] = np.asarray(table["ids"].combine_chunks().flatten())
        size = np.zeros((len(conv), width + 1), np.int64)
        size[:, 1:][np.arange(width)[None, :] < lens[:, None]] = np.asarray(table["bytes"].combine_chunks().flatten())
        order = np.lexsort((conv, lens, *ids.T[::-1], p2, p1, band))
        self.conv, self.band, self.lens, self.more, self.size = conv[order], band[order], lens[order], column("more")[order], size[order]
        ids, head = ids[order], np.stack([band, p1, p2], 1)[order]
        self.width = width
        self.valid = np.arange(width + 1)[None, :] <= self.lens[:, None]
        change = np.ones((len(conv), width + 1), bool)
        change[1:, 0] = (head[1:] != head[:-1]).any(axis=1)
        change[1:, 1:] = (ids[1:] != ids[:-1]).reshape(len(conv) - 1, width, 2).any(axis=2)
        self.start = np.logical_or.accumulate(change, axis=1) & self.valid
        self.node = np.cumsum(self.start, axis=0) - 1
        ids[ids == _PAD] = 0
        self.key = [np.bitwise_xor.accumulate(np.concatenate([head[:, i + 1 : i + 2], ids[:, i::2]], 1), axis=1) for i in (0, 1)]

    def depth(self, j: int) -> dict[str, np.ndarray]:
        """The nodes at column ``j`` of the shard, as far as it knows them."""
        at = np.flatnonzero(self.start[:, j])
        v, node = self.valid[:, j], self.node[:, j]
        hangs = (self.band[at] > 0) & (j == 0)  # a node of the band before
        span = np.zeros(len(at), bool)
        for row in (0, -1):
            if v[row]:
                span[node[row]] = True
        link = hangs.copy()
        if j == self.full:
            link |= np.logical_or.reduceat(self.more & v, at)
        kids = np.zeros(len(at), np.int64)
        if j < self.width:
            first = np.flatnonzero(self.start[:, j + 1])
            kids = np.bincount(node[first], minlength=len(at))
        return {
            "at": at,
            "hangs": hangs,
            "span": span,
            "link": link,
            "n": np.where(hangs, 0, np.add.reduceat(v.astype(np.int64), at)),
            "owner": np.where(hangs, _NONE, np.minimum.reduceat(np.where(v, self.conv, _NONE), at)),
            "kids": kids,
            "bytes": self.size[at, j],
            "depth": self.band[at] * self.full + j,
        }

    def depths(self) -> list[dict[str, np.ndarray]]:
        return [self.depth(j) for j in range(self.width + 1) if self.start[:, j].any()]

    def ends(self, j: int) -> list[np.ndarray]:
        """The conversations that end at each node of column ``j``,
        ascending: they share all ids, so the sort has them by conv_id."""
        rows = np.flatnonzero((self.lens == j) & ~self.more)
        count = np.bincount(self.node[rows, j], minlength=int(self.start[:, j].sum()))
        return np.split(self.conv[rows], np.cumsum(count)[:-1])


def _edges(table: pa.Table, width: int) -> pa.Table:
    """What a shard knows of the nodes that it may not hold whole."""
    s = Shard(table, width)
    shard = table["shard"][0].as_py()
    out: dict[str, list] = {f.name: [] for f in _schema(_EDGE)}
    levels = s.depths()
    for j, d in enumerate(levels):
        kids = d["kids"].copy()
        if j < s.width:
            below = levels[j + 1]  # boundary children are counted by key
            kids -= np.bincount(s.node[below["at"][below["span"]], j], minlength=len(kids))
        ends = s.ends(j)
        for e in np.flatnonzero(d["span"] | d["link"]):
            row = d["at"][e]
            up = [int(k[row, j - 1]) if j else None for k in s.key]
            owner = None if d["owner"][e] == _NONE else int(d["owner"][e])
            blob = ends[e].astype("<i8").tobytes() if d["span"][e] and not d["hangs"][e] else None
            values = (shard, int(d["depth"][e]), int(s.key[0][row, j]), int(s.key[1][row, j]), *up, bool(d["span"][e]), int(d["n"][e]), owner, int(kids[e]), blob)
            for name, value in zip(out, values):
                out[name].append(value)
    return pa.table([pa.array(out[f.name], f.type) for f in _schema(_EDGE)], schema=_schema(_EDGE))


def _known(s: Shard, extra: pa.Table) -> tuple[list[dict], np.ndarray, np.ndarray, np.ndarray]:
    """The shard's levels with the recombined nodes put in, and what every
    row adds (leaves, tokens) to its node at each depth. ``extra`` holds the
    recombined nodes of the shard and the totals of later bands."""
    rows = extra.to_pylist()
    whole = {(r["depth"], r["k1"], r["k2"]): r for r in rows if r["n"] is not None}
    later = {(r["conv"], r["band"]): r for r in rows if r["n"] is None}
    levels = s.depths()
    adds = np.zeros((2, len(s.conv), s.width + 1), np.int64)
    for j, d in enumerate(levels):
        for e in np.flatnonzero(d["span"] | d["link"]):
            row = d["at"][e]
            r = whole[(int(d["depth"][e]), int(s.key[0][row, j]), int(s.key[1][row, j]))]
            d["n"][e], d["owner"][e], d["kids"][e] = r["n"], r["owner"], r["kids"]
        node, here = s.node[:, j], s.valid[:, j] & ~d["hangs"][s.node[:, j]]
        own = here & (s.conv == d["owner"][node])
        adds[0, :, j] = own & (d["kids"] == 0)[node]
        adds[1, :, j] = np.where(own, ((d["n"] - 1) * d["bytes"])[node], 0)
    sums = adds[:, :, ::-1].cumsum(axis=2)[:, :, ::-1]
    if later:
        for i, c in enumerate(zip(s.conv.tolist(), s.band.tolist())):
            if c in later:
                sums[:, i] += np.array([[later[c]["leaves"]], [later[c]["saved"]]])
    return levels, sums, adds


def _own_totals(table: pa.Table, extra: pa.Table, width: int) -> pa.Table:
    """Per row of a conversation with several bands: what the nodes that it
    owns in this band add up to."""
    s = Shard(table, width)
    _, _, adds = _known(s, extra)
    deep = s.more | (s.band > 0)
    total = adds.sum(axis=2)
    shard = np.full(int(deep.sum()), table["shard"][0].as_py(), np.int32)
    return pa.table([shard, s.conv[deep], s.band[deep], total[0, deep], total[1, deep]], schema=_schema(_OWN))


_OWN = "shard int, conv long, band long, leaves long, saved long"
_FOUND = "span boolean, k1 long, k2 long, " + NODE


def _nodes(table: pa.Table, extra: pa.Table, width: int) -> pa.Table:
    """The shard's nodes; boundary nodes with the shard's part of the sums."""
    s = Shard(table, width)
    levels, sums, _ = _known(s, extra)
    out: dict[str, list] = {f.name: [] for f in _schema(_FOUND)}
    for j, d in enumerate(levels):
        at, v = d["at"], s.valid[:, j]
        up = [None] * len(at)
        if j:
            up = levels[j - 1]["owner"][s.node[at, j - 1]]
        emit = ~d["hangs"]
        ends = [_EMPTY if not len(e) else hashlib.sha256(",".join(map(str, e.tolist())).encode()).hexdigest() for e in s.ends(j)]
        values = {
            "span": d["span"],
            "k1": s.key[0][at, j],
            "k2": s.key[1][at, j],
            "conv_id": d["owner"],
            "depth": d["depth"],
            "parent_conv_id": up,
            "n_convs": d["n"],
            "n_children": d["kids"],
            "n_leaves": np.add.reduceat(np.where(v, sums[0, :, j], 0), at),
            "saved_tokens": np.add.reduceat(np.where(v, sums[1, :, j], 0), at),
            "ends_sha256": ends,
        }
        for name, value in values.items():
            out[name].append([x for x, k in zip(value if isinstance(value, list) else value.tolist(), emit) if k])
    return _table(out, _schema(_FOUND))


def _hashed_ends(edges: DataFrame) -> DataFrame:
    """(depth, k1, k2, ends_sha256) of the boundary nodes: the pieces of a
    node's list stream through one hash in the order of the shards, which is
    that of conv_id; a piece is at most a shard's rows."""

    def run(batches):
        now, state, first = None, None, True

        def row():
            return pa.RecordBatch.from_pylist([dict(depth=now[0], k1=now[1], k2=now[2], ends_sha256=state.hexdigest())], schema)

        schema = _schema("depth long, k1 long, k2 long, ends_sha256 string")
        for b in batches:
            for depth, k1, k2, ends in zip(*(b.column(n).to_pylist() for n in ("depth", "k1", "k2", "ends"))):
                if (depth, k1, k2) != now:
                    if now is not None:
                        yield row()
                    now, state, first = (depth, k1, k2), hashlib.sha256(), True
                ids = np.frombuffer(ends, "<i8")
                if len(ids):
                    state.update(("" if first else ",").encode() + ",".join(map(str, ids.tolist())).encode())
                    first = False
        if now is not None:
            yield row()

    pieces = edges.where("span and ends is not null").select("depth", "k1", "k2", "shard", "ends")
    pieces = pieces.repartition("depth", "k1", "k2").sortWithinPartitions("depth", "k1", "k2", "shard")
    return pieces.mapInArrow(run, "depth long, k1 long, k2 long, ends_sha256 string")


def rebuilt(spark: SparkSession, conversations: DataFrame, conv_id: str, turn: str, role: str, text: str) -> tuple[DataFrame, DataFrame]:
    """The rebuilt conversations: (conv_id, pos, h1, h2, bytes, total) per
    turn, pos from 1, and (conv_id, total) per conversation."""
    own = only(conversations, conv_id=conv_id, turn=turn, role=role, text=text).where("conv_id is not null")
    role_, text_ = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    h1, h2 = hash128(role_, text_)
    own = own.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", h1.alias("h1"), h2.alias("h2"), F.octet_length(text_).cast("long").alias("bytes"))
    # Turns are numbered in chunks: a conversation may hold a third of them.
    placed = running(chunked(spark, own, ["conv_id"], ["turn", "h1", "h2"]), {"pos": Running("count", F.lit(1))})
    turns = materialize(spark, placed.select("conv_id", "pos", "h1", "h2", "bytes"), "turns")
    head = turns.where((F.col("conv_id") % BLOCK == 0) & (F.col("pos") < HEADS))  # fewer than HEADS turns a group
    head = head.groupBy(F.col("conv_id").alias("base")).agg(F.sort_array(F.collect_list(F.struct("pos", "h1", "h2", "bytes"))).alias("head"))
    members = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    members = members.select("conv_id", "n", (F.col("conv_id") - F.col("conv_id") % BLOCK).alias("base"), (F.crc32(F.col("conv_id").cast("string")) % HEADS).alias("h"))
    members = members.join(head, "base", "left").withColumn("head", F.filter(F.coalesce("head", F.array()), lambda t: t.pos <= F.col("h")))
    size = F.size("head").cast("long")
    members = members.select("conv_id", "h", "head", size.alias("taken"), (size + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("total"))
    members = materialize(spark, members, "members")
    front = members.select("conv_id", "total", F.explode("head").alias("t")).select("conv_id", "t.*", "total")
    back = turns.join(members.select("conv_id", "h", "taken", "total"), "conv_id").where("pos > h")
    back = back.select("conv_id", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "h1", "h2", "bytes", "total")
    return front.unionByName(back), members.select("conv_id", "total")


def _rows(spark: SparkSession, turns: DataFrame, members: DataFrame, width: int, shard_rows: int) -> tuple[DataFrame, bool]:
    """Matrix rows with their shard, written; and whether any conversation
    has more than one."""
    of = F.struct("pos", F.xxhash64("h1", "h2", "pos").alias("z1"), F.xxhash64(F.lit(1), "h1", "h2", "pos").alias("z2"), "bytes")
    banded = turns.select("conv_id", "total", F.floor((F.col("pos") - 1) / width).alias("band"), of.alias("t"))
    # Dealt by the band as well, whatever the join above is dealt by.
    banded = banded.repartition("conv_id", "band").groupBy("conv_id", "band").agg(F.max("total").alias("total"), F.sort_array(F.collect_list("t")).alias("t"))
    empty = members.where("total = 0").select("conv_id", F.lit(0).cast("long").alias("band"), "total", F.expr("array()").cast(banded.schema["t"].dataType).alias("t"))
    rows = banded.unionByName(empty).select(
        "conv_id",
        "band",
        (F.col("total") > (F.col("band") + 1) * width).alias("more"),
        F.flatten(F.transform("t", lambda x: F.array(x.z1, x.z2))).alias("ids"),
        F.transform("t", lambda x: x.bytes).alias("bytes"),
        F.aggregate("t", F.lit(0).cast("long"), lambda a, x: a.bitwiseXOR(x.z1)).alias("x1"),
        F.aggregate("t", F.lit(0).cast("long"), lambda a, x: a.bitwiseXOR(x.z2)).alias("x2"),
    )
    counts = members.agg(F.sum(F.greatest(F.ceil(F.col("total") / width), F.lit(1))).alias("rows"), F.max("total").alias("longest")).first()
    deep = (counts.longest or 0) > width
    none = F.lit(0).cast("long")
    if deep:
        rows = materialize(spark, rows, "bands")
        many = rows.where(F.col("more") | (F.col("band") > 0))
        many = running(chunked(spark, many, ["conv_id"], ["band"]), {"p1": Running("bit_xor", F.col("x1"), True), "p2": Running("bit_xor", F.col("x2"), True)})
        few = rows.where(~F.col("more") & (F.col("band") == 0)).select("*", none.alias("p1"), none.alias("p2"))
        rows = few.unionByName(many.select(*few.columns)).withColumns({"p1": F.coalesce("p1", none), "p2": F.coalesce("p2", none)})
    else:
        rows = rows.select("*", none.alias("p1"), none.alias("p2"))
    shards = max(1, -(-int(counts.rows or 0) // shard_rows))
    dealt = rows.select("conv_id", "band", "more", "ids", "bytes", "p1", "p2").repartitionByRange(shards, "band", "p1", "p2", "ids", "conv_id")
    return materialize(spark, dealt.withColumn("shard", F.spark_partition_id()), "shards"), deep


def trie(
    spark: SparkSession,
    conversations: DataFrame,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    width: int = WIDTH,
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """One row per node of the prefix trie of the rebuilt conversations
    (NODE lists the columns; the module's text and README say what they are).

    A conversation is rebuilt from the first h turns of the conversation at
    the start of its block of five and its own turns after its first h. Null
    turns come first, turns of one number in the order of a hash of role and
    text. Null role or text is empty. Rows without a conv_id belong to no
    conversation. A repeated row is one more turn. A conversation whose turns
    all go is a member of the root. An empty table has no members and gives
    no rows. Other columns are ignored.
    """
    turns, members = rebuilt(spark, conversations, conv_id, turn, role, text)
    rows, deep = _rows(spark, turns, members, width, shard_rows)
    edges = materialize(spark, rows.groupBy("shard").applyInArrow(lambda t: _edges(t, width), _EDGE), "boundary")
    key = ["depth", "k1", "k2"]
    # Boundary children are counted once, however many shards hold them.
    below = edges.where("span and pk1 is not null").select(*key, "pk1", "pk2").distinct()
    below = below.groupBy((F.col("depth") - 1).alias("depth"), F.col("pk1").alias("k1"), F.col("pk2").alias("k2")).agg(F.count(F.lit(1)).alias("also"))
    whole = edges.groupBy(*key).agg(F.sum("n").alias("n"), F.min("owner").alias("owner"), F.sum("kids").alias("kids"))
    whole = whole.join(below, key, "left").select(*key, "n", "owner", (F.col("kids") + F.coalesce("also", F.lit(0))).alias("kids"))
    extra = edges.select("shard", *key).join(whole, key)
    for name in ("conv", "band", "leaves", "saved"):
        extra = extra.withColumn(name, F.lit(None).cast("long"))
    extra = materialize(spark, extra, "recombined")
    per_shard = rows.groupBy("shard")
    if deep:
        own = per_shard.cogroup(extra.groupBy("shard")).applyInArrow(lambda t, x: _own_totals(t, x, width), _OWN).withColumn("up", -F.col("band"))
        later = running(chunked(spark, own, ["conv"], ["up"]), {"l": Running("sum", F.col("leaves"), True), "s": Running("sum", F.col("saved"), True)})
        later = later.where("l is not null").select("shard", "conv", "band", F.col("l").alias("leaves"), F.col("s").alias("saved"))
        extra = materialize(spark, extra.unionByName(later, allowMissingColumns=True), "later-bands")
    found = materialize(spark, per_shard.cogroup(extra.groupBy("shard")).applyInArrow(lambda t, x: _nodes(t, x, width), _FOUND), "nodes")
    columns = [f.name for f in _schema(NODE)]
    same = ["conv_id", "parent_conv_id", "n_convs", "n_children"]
    cut = found.where("span").groupBy(*key).agg(*[F.min(c).alias(c) for c in same], F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))
    cut = cut.join(_hashed_ends(edges), key)
    return found.where("not span").select(*columns).unionByName(cut.select(*columns))

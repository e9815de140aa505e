"""Embedding near-dedup with randomised-rotation binary codes.

Each unit vector is rotated by a random orthogonal matrix and kept as the
signs of its coordinates, with a stored correction factor: its inner product
with the unit vector that the signs stand for. The product of the signs with
another rotated vector, divided by that factor, is an unbiased estimate of
the cosine, and the factor tells how far it may be off. A pair whose upper
confidence bound stays below the threshold is done; only the others are
recomputed from the stored vectors in double precision, and only that
decides a link.

Pairs are sought in cells: every vector has a home, the nearest of some
centres, and visits the next nearest ones, where it is compared with the
vectors at home there. The centres come from a bounded sample and are kept
apart from each other, so that a large group of near copies shares one home.
Home and visitors of a cell are dealt to blocks of bounded size, and a task
sees two blocks: a cell that holds a third of all vectors is many tasks. A
task returns counts and a spanning star per local component, never a list
of pairs.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from .common import hash128, only
from .components import connected_components

PER_CELL = 100  # vectors a cell should have, up to FINE centres; then the
FINE = 2048  # number of centres grows as the root of the vectors' number,
MAX_CENTRES = 16384  # up to this
SAMPLE_BYTES = 64 << 20  # most of the sample that centres are chosen from
# Greatest cosine between two centres. Embeddings often share a direction, so
# that most cosines are high: then the next bound is tried, until there are as
# many centres as wanted. All lie below what near copies have.
APART = (0.6, 0.7, 0.8, 0.85)
PAIRS = 1000  # pairs that the number of visits is measured on
FOUND_SHARE = 0.998  # of them that must meet
VISITS = 12  # least number of cells a vector visits beside its home
BLOCK = 1024
CONFIDENCE = 5.0  # standard errors of the estimate
SEED = 20240301
DEALT = "cell long, rows int, cols int, is_row boolean, node long, n long, home long, visits array<long>, vec binary, code binary, factor double"
FOUND = "node long, links long, other long"


@lru_cache(maxsize=4)
def rotation(dim: int) -> np.ndarray:
    """A random orthogonal matrix, the same in every worker."""
    q, r = np.linalg.qr(np.random.Generator(np.random.PCG64(SEED)).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length one, in double precision."""
    x = x.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def encode(units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes (packed signs) and correction factors of unit vectors."""
    turned = units @ rotation(units.shape[1])
    return np.packbits(turned > 0, axis=1), np.abs(turned).sum(axis=1) / np.sqrt(units.shape[1])


def estimate(codes: np.ndarray, factors: np.ndarray, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Estimated cosines of coded (rows) with other vectors (columns), and
    the standard error of each row's estimates."""
    dim = units.shape[1]
    signs = np.unpackbits(codes, axis=1, count=dim).astype(np.float32) * 2 - 1
    turned = (units @ rotation(dim)).astype(np.float32)
    error = np.sqrt(np.maximum(0, 1 - factors**2)) / factors / np.sqrt(max(1, dim - 1))
    return (signs @ turned.T) / (np.sqrt(dim) * factors).astype(np.float32)[:, None], error


def usable(vec: Column) -> Column:
    """Neither null nor empty nor zero, all components finite."""
    bad = F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce((F.size(vec) > 0) & ~bad & F.exists(vec, lambda x: x != 0), F.lit(False))


def _centres(classes: DataFrame, dim: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Sampled unit vectors, each at most APART from those before it, and
    the sample they are from."""
    most = max(1, SAMPLE_BYTES // (8 * dim))
    want = int(min(MAX_CENTRES, most // 2 + 1, max(1, min(FINE, n // PER_CELL), n**0.5)))
    size = min(most, max(8192, 2 * want))
    place = F.xxhash64("embedding").bitwiseAND(F.lit((1 << 31) - 1)) / float(1 << 31)
    sample = classes.where((F.size("embedding") == dim) & (place < 2.0 * size / max(n, 1)))
    got = sample.orderBy(F.xxhash64("embedding"), "node").limit(size).select("embedding").toPandas()["embedding"]
    if not len(got):
        return np.zeros((0, dim)), np.zeros((0, dim))
    pool = unit(np.stack([np.asarray(v, np.float64) for v in got]))
    chosen, near = [], np.full(len(pool), -2.0)
    for apart in APART:
        for i in range(len(pool)):
            if len(chosen) == want:
                break
            if near[i] <= apart:
                chosen.append(i)
                near = np.maximum(near, pool @ pool[i])
    return pool[chosen], pool


def visits_among(centres: int) -> int:
    """The number of cells a vector visits beside its home. The more centres,
    the further a pair's two homes are ranked from each other: of pairs at
    cosine 0.9, random in 64 and 256 dimensions, a fixed 12 finds 0.91 to
    0.92 among 16,384 random centres, this number over 0.99."""
    return max(VISITS, int(np.ceil(2 * centres ** (1 / 3))))


def visits_measured(centres: np.ndarray, pool: np.ndarray, threshold: float) -> int:
    """The visits by which pairs at the threshold meet, measured on the data
    at hand: to vectors of the sample a partner is made at just that cosine,
    off in the direction of another vector of the sample. Where vectors share
    a direction, what tells cells apart is less of a vector, and a pair's
    homes lie further from each other."""
    a = pool[:PAIRS]
    if len(a) < 2 or len(centres) < 2:
        return VISITS
    w = np.roll(a, 1, axis=0)
    w = w - (w * a).sum(axis=1, keepdims=True) * a
    size = np.sqrt((w * w).sum(axis=1, keepdims=True))
    a, w, size = a[size[:, 0] > 1e-6], w[size[:, 0] > 1e-6], size[size[:, 0] > 1e-6]
    if not len(a):
        return VISITS
    b = threshold * a + np.sqrt(max(0.0, 1 - threshold**2)) * w / size
    rank = []
    for at in range(0, len(a), 100):
        x, y = a[at : at + 100] @ centres.T, b[at : at + 100] @ centres.T
        rows = np.arange(len(x))
        there = (x > x[rows, y.argmax(axis=1)][:, None]).sum(axis=1)
        back = (y > y[rows, x.argmax(axis=1)][:, None]).sum(axis=1)
        rank.append(np.minimum(there, back))
    return int(np.quantile(np.concatenate(rank), FOUND_SHARE, method="higher"))


def _vectors(column: pa.Array) -> list[np.ndarray]:
    return [np.asarray(v.values) for v in column]


def _assign(centres: np.ndarray, vecs: list[np.ndarray], visits: int):
    """Per vector its home and the cells it visits, nearest first. Vectors
    of another length than the centres meet in a cell of their own."""
    dim = centres.shape[1]
    out: list[tuple[int, list[int]]] = [(-len(v), []) for v in vecs]
    own = [i for i, v in enumerate(vecs) if len(v) == dim]
    if own and len(centres):
        near = unit(np.stack([vecs[i] for i in own])) @ centres.T
        k = min(visits + 1, len(centres))
        top = np.argpartition(-near, k - 1, axis=1)[:, :k]
        order = np.take_along_axis(top, np.argsort(-np.take_along_axis(near, top, 1), axis=1, kind="stable"), 1)
        for i, cells in zip(own, order.tolist()):
            out[i] = (cells[0], cells[1:])
    return out


def _stars(links: np.ndarray, nodes: np.ndarray) -> list[tuple[int, int]]:
    """(node, smallest node of its component) by pairs of positions."""
    label = nodes.copy()
    a, b = links
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        if (new == label).all():
            return [(int(x), int(y)) for x, y in zip(nodes, label) if x != y]
        label = new


def _compare(table: pa.Table, threshold: float, confidence: float):
    """Links between the rows and the columns of one pair of blocks, as
    (node, weight of its links, None) and (node, None, local root)."""
    cell = table.column("cell")[0].as_py()
    same = table.column("rows")[0].as_py() == table.column("cols")[0].as_py()  # a block with itself
    is_row = table.column("is_row").to_numpy(zero_copy_only=False)
    node, n, home = (table.column(c).to_numpy() for c in ("node", "n", "home"))
    visits = table.column("visits").to_pylist()
    raw, kind = table.column("vec").to_pylist(), np.float32 if table.schema.metadata and table.schema.metadata.get(b"w") == b"4" else np.float64
    units = unit(np.frombuffer(b"".join(raw), kind).reshape(len(raw), -1))
    r = np.flatnonzero(is_row)
    c = r if same else np.flatnonzero(~is_row)
    if not len(r) or not len(c):
        return []
    codes = np.frombuffer(b"".join(table.column("code").take(pa.array(r)).to_pylist()), np.uint8).reshape(len(r), -1)
    guess, error = estimate(codes, table.column("factor").to_numpy()[r], units[c])
    maybe = guess + (confidence * error)[:, None].astype(np.float32) >= threshold
    if same:
        maybe = np.triu(maybe | maybe.T, 1)
    x, y = np.nonzero(maybe)
    a, b = r[x], c[y]
    keep = np.zeros(len(a), bool)
    for at in range(0, len(a), 1 << 16):  # exact recomputation, in bounded pieces
        part = slice(at, at + (1 << 16))
        keep[part] = np.einsum("ij,ij->i", units[a[part]], units[b[part]]) >= threshold
    a, b = a[keep], b[keep]
    if not same and len(a):
        # The two also meet at the other's home if this one visits there:
        # then the smaller cell counts them.
        foreign = np.flatnonzero(home[b] != cell)
        drop = [i for i in foreign if home[b[i]] < cell and home[b[i]] in visits[a[i]]]
        a, b = np.delete(a, drop), np.delete(b, drop)
    if not len(a):
        return []
    weight = np.bincount(np.concatenate([a, b]), np.concatenate([n[b], n[a]]), len(node)).astype(np.int64)
    hit = np.flatnonzero(weight)
    return [(int(node[i]), int(weight[i]), None) for i in hit] + [(p, None, q) for p, q in _stars(np.stack([a, b]), node)]


def link(
    spark: SparkSession, vectors: DataFrame, threshold: float = 0.9, visits: int | None = None, confidence: float = CONFIDENCE, vec_id: str = "vec_id", embedding: str = "embedding"
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) per row of ``vectors``.

    Rows with equal vectors are one class while links are sought and count
    as linked with each other. Vectors that are null, empty, zero, or hold a
    null or non-finite component link with nothing; neither do vectors of
    different lengths. component_id is the smallest non-null vec_id that
    links reach, the row's own included; rows with a null id count, but are
    never kept. An empty table gives no rows. ``visits`` is the number of
    cells a vector visits, by default as ``visits_among`` the centres and, if
    that is more, as ``visits_measured`` on the sample.
    """
    rows = only(vectors, vec_id=vec_id, embedding=embedding).withColumn("vec_id", F.col("vec_id").cast("long"))
    width = 4 if "float" in dict(rows.dtypes)["embedding"] else 8
    kind = np.float32 if width == 4 else np.float64
    good = rows.where(usable(F.col("embedding")))
    classes = good.groupBy("embedding").agg(F.min("vec_id").alias("low"), F.count("embedding").alias("n"))
    # Numbered once, as they are written.
    classes = materialize(spark, classes.withColumn("node", F.monotonically_increasing_id()), "vector-classes")
    sizes = {r["d"]: r["n"] for r in classes.groupBy(F.size("embedding").alias("d")).agg(F.count("node").alias("n")).collect()}
    bare = rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.col("vec_id").isNotNull().alias("kept"))
    if not sizes:
        return bare
    dim = max(sizes, key=lambda d: (sizes[d], -d))
    centres, pool = _centres(classes, dim, sizes[dim])
    if visits is None:
        visits = max(visits_among(len(centres)), visits_measured(centres, pool, threshold))

    def assign(batches):
        for b in batches:
            got = _assign(centres, _vectors(b.column(0)), visits)
            yield pa.RecordBatch.from_arrays([pa.array([h for h, _ in got], pa.int64()), pa.array([v for _, v in got], pa.list_(pa.int64()))], ["home", "visits"])

    counted = classes.select("embedding").mapInArrow(assign, "home long, visits array<long>")
    # One number per cell: at most MAX_CENTRES and one per other length.
    cells = counted.select("home", F.explode(F.concat(F.array("home"), "visits")).alias("cell")).groupBy("cell")
    cells = cells.agg(F.count_if(F.col("cell") == F.col("home")).alias("home"), F.count_if(F.col("cell") != F.col("home")).alias("away")).collect()
    blocks = {r["cell"]: (-(-r["home"] // BLOCK), -(-r["away"] // BLOCK)) for r in cells}

    def deal(batches):
        """Each vector to the pairs of blocks it takes part in: columns 0 to
        h - 1 are the cell's home blocks, from h on its visitors' blocks."""
        for b in batches:
            node, n = b.column(0).to_pylist(), b.column(1).to_pylist()
            vecs = _vectors(b.column(2))
            out = []
            for i, (home, away) in enumerate(_assign(centres, vecs, visits)):
                v = vecs[i].astype(kind)
                code, factor = encode(unit(v[None]))
                rest = (node[i], n[i], home, away, v.tobytes(), code.tobytes(), float(factor[0]))
                column = (*rest[:3], [], *rest[4:])  # only of rows it is asked where they visit
                h, w = blocks[home]
                own = node[i] * 0x9E3779B1 % 0xFFFFFFFB
                mine = own % h
                out += [(home, mine, k, True, *rest) for k in (*range(mine + 1), *range(h, h + w))]
                out += [(home, k, mine, False, *column) for k in range(mine + 1, h)]
                for cell in away:
                    h, w = blocks[cell]
                    out += [(cell, k, h + own % w, False, *column) for k in range(h)]
                if len(out) >= 4096:
                    yield _dealt(out)
                    out = []
            if out:
                yield _dealt(out)

    def compare(table):
        found = _compare(table.replace_schema_metadata({"w": str(width)}), threshold, confidence)
        return pa.table([pa.array(c, pa.int64()) for c in (zip(*found) if found else ([], [], []))], ["node", "links", "other"])

    pairs = classes.select("node", "n", "embedding").mapInArrow(deal, DEALT).groupBy("cell", "rows", "cols").applyInArrow(compare, FOUND)
    found = materialize(spark, pairs, "vector-links")
    counts = found.where("links is not null").groupBy("node").agg(F.sum("links").alias("links"))
    roots = connected_components(spark, found.where("other is not null").select(F.col("node").alias("a"), F.col("other").alias("b")))
    named = classes.select("node", "low", "n", *[h.alias(f"h{i}") for i, h in enumerate(hash128(F.col("embedding")))])
    named = named.join(roots, "node", "left").join(counts, "node", "left").withColumn("root", F.coalesce("root", "node"))
    named = materialize(spark, named, "vector-named")
    least = materialize(spark, named.groupBy("root").agg(F.min("low").alias("component_id")), "vector-least")
    named = named.join(least, "root").select("h0", "h1", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id")
    named = materialize(spark, named, "vector-components")
    keyed = good.select("vec_id", *[h.alias(f"h{i}") for i, h in enumerate(hash128(F.col("embedding")))])
    linked = keyed.join(named, ["h0", "h1"]).select("vec_id", "n_links", "component_id")
    linked = linked.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
    alone = rows.where(~usable(F.col("embedding")))
    return linked.union(alone.select("vec_id", F.lit(0).cast("long"), "vec_id", F.col("vec_id").isNotNull()))


def _dealt(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.float64())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], [c.split()[0] for c in DEALT.split(", ")])

"""WARC archives with a two-level capture index.

``write`` stores one record per page, each a gzip member of its own, and
says which records revisit an earlier equal payload. ``build_index`` sorts
the captures by reversed-host URL key into compressed blocks and keeps a
sparse directory with the first key of each block. ``lookup`` binary-searches
the directory and opens only the blocks that may hold a key; ``fetch`` then
cuts each record out of its archive by its byte range.

Everything is written and read by Spark: an archive is a row per chunk of
about CHUNK_BYTES, whose bytes in turn are a valid ``.warc.gz`` file, with
the byte ranges of its records beside it, and the index is a row per block.
So any store that Spark can write to will do, and Spark's commit protocol
holds: what a failed or doubled attempt wrote is never seen, and a lost
executor costs a re-run of its tasks only.
"""

from __future__ import annotations

import bisect
import hashlib
import json
import re
import uuid
import zlib
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize, new_work_dir
from .common import only, small_batches

BLOCK = 1024  # captures in one compressed index block
CHUNK_BYTES = 1 << 20  # a chunk of an archive is closed at this size
CAPTURE = "key string, page string, file string, chunk int, offset long, length long"
ARCHIVE = "file string, chunk int, data binary, captures array<struct<key:string,page:string,offset:bigint,length:bigint>>"
INDEX = "part int, block int, first string, n long, data binary"
DIRECTORY = "part int, block int, first string, n long"
NEEDED = "key string, part int, block int"
RECORD = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
_CAPTURES = pa.list_(pa.struct([("key", pa.string()), ("page", pa.string()), ("offset", pa.int64()), ("length", pa.int64())]))
# Fixed values of the format.
VERSION = b"WARC/1.1"
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def url_key(url: str | None) -> str:
    """The URL with its host reversed, so that a domain's captures sort
    together: http://a.b.org/x?y becomes org,b,a)/x?y. A null URL has an
    empty key; what is no URL is kept as it is."""
    if not url:
        return ""
    try:
        parts = urlsplit(url.strip())
        host = (parts.hostname or "").lower()
    except ValueError:
        return url
    if not host:
        return url
    port = f":{parts.netloc.rpartition(':')[2]}" if re.search(r":\d+$", parts.netloc) else ""
    return ",".join(reversed(host.split("."))) + port + ")" + (parts.path or "/") + (f"?{parts.query}" if parts.query else "")


def capture_key(url: str | None, page: str) -> str:
    """URL key and page, so that captures of one URL differ and even a URL
    with very many captures is spread over blocks and index parts."""
    return f"{url_key(url)} {page}"


def _line(value: str) -> str:
    """No control characters in a header line."""
    return re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def record(page: str, url: str | None, payload: bytes, digest: str, refers_to: str | None) -> bytes:
    """One WARC record: a response with its payload, or a revisit with the
    HTTP header alone (its Content-Length still tells the payload's size)."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    head = [
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{page}>",
        f"WARC-Date: {DATE}",
        *([f"WARC-Target-URI: {_line(url)}"] if url is not None else []),
        f"WARC-Payload-Digest: sha256:{digest}",
        *([f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"] if refers_to is not None else []),
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    return VERSION + b"\r\n" + "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> dict:
    """A record's headers, HTTP header and payload."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if version != VERSION.decode():
        raise ValueError(f"no WARC record: {version[:40]!r}")
    fields = dict(x.split(": ", 1) for x in lines)
    http, _, payload = rest[: int(fields["Content-Length"])].partition(b"\r\n\r\n")
    return {"fields": fields, "http": http.decode(), "payload": payload}


def _read(page: str, raw: bytes) -> tuple:
    """The row of one record; a payload must match its digest."""
    got = parse(raw)
    fields = got["fields"]
    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    size = int(re.search(r"^Content-Length: (\d+)$", got["http"], re.M)[1])
    own = re.fullmatch(r"<urn:page:(.*)>", fields["WARC-Record-ID"])[1]
    refers = re.fullmatch(r"<urn:page:(.*)>", fields.get("WARC-Refers-To", "<urn:page:>"))[1]
    if own != page:
        raise ValueError(f"the index names page {page}, the record is of page {own}")
    if fields["WARC-Type"] == "response" and (len(got["payload"]) != size or hashlib.sha256(got["payload"]).hexdigest() != digest):
        raise ValueError(f"the payload of page {page} does not match its digest")
    return (int(own) if own else None, fields.get("WARC-Target-URI"), size, digest, fields["WARC-Type"], int(refers) if refers else None)


def _gzip(data: bytes) -> bytes:
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def _kinds(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}
    return pa.schema([(n, kinds[k]) for n, k in (f.split() for f in ddl.split(", "))])


def _batch(rows: list[tuple], ddl: str) -> pa.RecordBatch:
    schema = _kinds(ddl)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def write(spark: SparkSession, pages: DataFrame, root: str, min_bytes: int = 100, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Write one record per row of ``pages`` under ``root``; returns the
    captures (key, page, file, chunk, offset, length).

    A null html is an empty payload, a null url has no target line. Of the
    records with equal payloads of at least ``min_bytes``, those of the
    smallest page_id are responses and the others revisit it; rows that
    repeat that page_id are responses too. Rows with a null page_id take
    part: they are revisits where a page with an id has their payload, else
    responses. No pages, no archives. Other columns are ignored.
    """
    small_batches(spark)
    rows = only(pages, page_id=page_id, url=url, html=html).select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce(F.col("html"), F.lit("")).alias("html"))
    rows = rows.withColumn("digest", F.sha2("html", 256))
    slim = rows.where(F.octet_length("html") >= min_bytes).select("page_id", "digest")
    equal = slim.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count("digest").alias("n")).where("n > 1 and refers_to is not null")
    # Written, so that AQE can split the rows of a very common payload.
    equal = materialize(spark, equal.select("digest", "refers_to"), "warc-equal")
    again = slim.join(equal, "digest").where(~F.col("page_id").eqNullSafe(F.col("refers_to"))).distinct()
    again = again.select(F.col("page_id").alias("p"), F.col("digest").alias("d"), "refers_to")
    # Hashing the few revisits spares a sort of whole pages.
    dealt = rows.join(again.hint("shuffle_hash"), rows.page_id.eqNullSafe(F.col("p")) & (rows.digest == F.col("d")), "left")

    def run(batches):
        name, chunk, held, size, seen = f"part-{uuid.uuid4().hex}.warc.gz", 0, [], 0, []

        def row():
            nonlocal chunk, size
            captures = pa.array([[dict(zip(("key", "page", "offset", "length"), c)) for c in seen]], _CAPTURES)
            got = pa.RecordBatch.from_arrays([pa.array([name]), pa.array([chunk], pa.int32()), pa.array([b"".join(held)], pa.binary()), captures], ["file", "chunk", "data", "captures"])
            chunk, size = chunk + 1, 0
            held.clear()
            seen.clear()
            return got

        for b in batches:
            for page, link, text, digest, refers in zip(*[c.to_pylist() for c in b.columns]):
                own = "" if page is None else str(page)
                member = _gzip(record(own, link, text.encode(), digest, None if refers is None else str(refers)))
                held.append(member)
                seen.append((capture_key(link, own), own, size, len(member)))
                size += len(member)
                if size >= CHUNK_BYTES:
                    yield row()
        if held:
            yield row()

    made = dealt.select("page_id", "url", "html", "digest", "refers_to").mapInArrow(run, ARCHIVE)
    made.write.option("compression", "uncompressed").parquet(f"{root}/archive")  # its members are compressed
    return captures(spark, root)


def read_archive(spark: SparkSession, root: str) -> DataFrame:
    """(file, chunk, data, captures): a file's chunks in turn are its bytes."""
    return spark.read.schema(ARCHIVE).parquet(f"{root}/archive")


def captures(spark: SparkSession, root: str) -> DataFrame:
    """(key, page, file, chunk, offset, length) of every record; only these
    columns are read."""
    return read_archive(spark, root).select("file", "chunk", F.explode("captures").alias("c")).select("c.key", "c.page", "file", "chunk", "c.offset", "c.length")


def build_index(spark: SparkSession, captures: DataFrame, root: str) -> DataFrame:
    """Sort the captures into compressed blocks under ``root``; returns the
    sparse directory (part, block, first, n), one row per block. Captures
    without rows give no blocks."""
    ordered = captures.repartitionByRange("key", "file", "chunk", "offset").sortWithinPartitions("key", "file", "chunk", "offset")

    def run(batches):
        from pyspark import TaskContext

        part, block, held = TaskContext.get().partitionId(), 0, []

        def row(rows):
            nonlocal block
            data = _gzip("".join(json.dumps(r, separators=(",", ":")) + "\n" for r in rows).encode())
            block += 1
            return _batch([(part, block - 1, rows[0][0], len(rows), data)], INDEX)

        for b in batches:
            held += zip(*[c.to_pylist() for c in b.columns])
            while len(held) >= BLOCK:
                yield row(held[:BLOCK])
                held = held[BLOCK:]
        if held:
            yield row(held)

    ordered.select("key", "page", "file", "chunk", "offset", "length").mapInArrow(run, INDEX).write.parquet(f"{root}/index")
    spark.read.schema(INDEX).parquet(f"{root}/index").select("part", "block", "first", "n").write.parquet(f"{root}/directory")
    return read_directory(spark, root)


def read_directory(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(DIRECTORY).parquet(f"{root}/directory")


def _blocks(spark: SparkSession, wanted: DataFrame, root: str) -> DataFrame:
    """(key, part, block): for every wanted key the blocks that may hold it,
    by a binary search of the parts on the driver's list of their first keys
    and then of the part's own directory."""
    parts = read_directory(spark, root).groupBy("part").agg(F.min("first").alias("first"))
    starts = sorted((r["first"].encode(), r["part"]) for r in parts.collect())  # one key per part, as many as shuffle partitions
    firsts, numbers = [s for s, _ in starts], [p for _, p in starts]

    def deal(batches):
        # Equal keys may begin at the end of the last part that starts
        # before them, and run on through parts that start with them.
        for b in batches:
            rows = []
            for key in b.column(0).to_pylist():
                k = key.encode()
                rows += [(key, numbers[i]) for i in range(max(bisect.bisect_left(firsts, k) - 1, 0), bisect.bisect_right(firsts, k))]
            if rows:
                yield _batch(rows, "key string, part int")

    def search(keys: pa.Table, directory: pa.Table) -> pa.Table:
        entries = sorted((f.encode(), b) for f, b in zip(directory["first"].to_pylist(), directory["block"].to_pylist()))
        first, rows = [f for f, _ in entries], []
        part = directory["part"][0].as_py() if directory.num_rows else 0
        for key in keys["key"].to_pylist():
            k = key.encode()
            rows += [(key, part, entries[i][1]) for i in range(max(bisect.bisect_left(first, k) - 1, 0), bisect.bisect_right(first, k))]
        return pa.Table.from_batches([_batch(rows, NEEDED)] if rows else [], _kinds(NEEDED))

    dealt = wanted.select("key").where("key is not null").distinct().mapInArrow(deal, "key string, part int")
    return dealt.groupBy("part").cogroup(read_directory(spark, root).groupBy("part")).applyInArrow(search, NEEDED)


def lookup(spark: SparkSession, wanted: DataFrame, root: str) -> DataFrame:
    """The captures of the keys in ``wanted`` (column key, see capture_key).

    The blocks that may hold them are found by binary search; only those
    are read and opened. A key that is not in the index gives no row, and
    neither does a null key; a key asked for twice is found once.
    """
    needed = materialize(spark, _blocks(spark, wanted, root), "warc-needed")
    index = spark.read.schema(INDEX).parquet(f"{root}/index").select("part", "block", "data")

    def opened(batches):
        for b in batches:
            for data in b.column(0).to_pylist():
                yield _batch([tuple(json.loads(x)) for x in zlib.decompress(data, 31).splitlines()], CAPTURE)

    held = index.join(needed.select("part", "block").distinct(), ["part", "block"], "left_semi")
    found = held.select("data").mapInArrow(opened, CAPTURE)
    return found.join(needed.select("key").distinct(), "key", "left_semi")


def fetch(spark: SparkSession, captures: DataFrame, root: str) -> DataFrame:
    """The records of ``captures``, each cut out of its chunk by its own byte
    range; chunks without one are not read on. A record that is no WARC
    record, of another page or with a payload unlike its digest raises."""
    # A chunk holds a bounded number of records, whatever it is asked for.
    ranges = captures.groupBy("file", "chunk").agg(F.collect_list(F.struct("page", "offset", "length")).alias("ranges"))
    # Hashing the ranges, a few bytes a record, spares a sort of the archives.
    near = read_archive(spark, root).select("file", "chunk", "data").join(ranges.hint("shuffle_hash"), ["file", "chunk"])

    def run(batches):
        for b in batches:
            for data, wanted in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                yield _batch([_read(r["page"], zlib.decompress(data[r["offset"] : r["offset"] + r["length"]], 31)) for r in wanted], RECORD)

    return near.select("data", "ranges").mapInArrow(run, RECORD)


def archive(spark: SparkSession, pages: DataFrame, min_bytes: int = 100, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Write ``pages`` as WARC, index the captures, look every page up in
    the index and read its record back: (page_id, url, payload_bytes,
    payload_digest, record_type, refers_to), one row per row of ``pages``."""
    root = new_work_dir(spark, "warc")
    build_index(spark, write(spark, pages, root, min_bytes, page_id, url, html), root)

    def keys(batches):
        for b in batches:
            page = ["" if p is None else str(p) for p in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([capture_key(u, p) for u, p in zip(b.column(1).to_pylist(), page)], pa.string())], ["key"])

    named = only(pages, page_id=page_id, url=url).withColumn("page_id", F.col("page_id").cast("long"))
    return fetch(spark, lookup(spark, named.mapInArrow(keys, "key string"), root), root)

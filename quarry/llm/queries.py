"""One query per operator, over whole tables, with production parameters.

Each query derives the columns of its contract from what its operator
returns. ``ORACLE`` holds DuckDB SQL where SQL can express the result; the
other queries are held against brute force in tests/llm.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import byte_bpe, embedding_dedup, html_extract, langid, line_dedup, packing, pii, prefix_trie, quality, simhash, substring_dedup, vector_codes, warc
from .common import read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def vocabulary(name: str) -> str:
    """The place of a public vocabulary file; workers have their own copy."""
    import public_tokenizers

    return public_tokenizers.path(name)


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


@query()
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = quality.train(spark, docs, read(spark, sf_dir, "labels"))
    return quality.score(spark, docs, model)


@query(
    r"""
    WITH lines AS (
        SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
        FROM documents
    ), keyed AS (
        SELECT *, translate(trim(line, concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS line_key
        FROM lines
    ), common AS (
        SELECT line_key FROM keyed WHERE length(line_key) >= 1
        GROUP BY line_key HAVING count(DISTINCT doc_id) >= 10
    )
    SELECT doc_id, count(*) AS n_lines,
           count(*) FILTER (WHERE common.line_key IS NOT NULL) AS n_dropped,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE common.line_key IS NULL), '')) AS kept_sha256
    FROM keyed LEFT JOIN common USING (line_key) GROUP BY doc_id
    """
)
def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(spark, read(spark, sf_dir, "documents"), min_docs=10, min_chars=1)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@query()
def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_duplicates(spark, read(spark, sf_dir, "documents"), shingle=3, max_bits=2)
    return out.select("doc_id", simhash.hex16("fp").alias("fingerprint"), "component_id")


@query(
    """
    WITH p AS (
        SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
        FROM pages
    ), f AS (
        SELECT payload_digest, min(page_id) AS low FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest
    )
    SELECT page_id, payload_bytes, payload_digest,
           CASE WHEN low IS NULL OR low = page_id THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN low <> page_id THEN low END AS refers_to
    FROM p LEFT JOIN f USING (payload_digest)
    """
)
def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive(spark, read(spark, sf_dir, "pages"), min_bytes=100).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query()
def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = packing.pack(spark, read(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), size=2048, end=1)
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query()
def op3_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(spark, read(spark, sf_dir, "pages"))


@query()
def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.link(spark, read(spark, sf_dir, "embeddings"), threshold=0.9)


@query()
def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    out = byte_bpe.round_trip(spark, read(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return out.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query()
def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return langid.predict(spark, docs, langid.train(spark, docs))


@query(
    r"""
    WITH words AS (
        SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
    ), wins AS (
        SELECT doc_id, p, array_to_string(ws[p:p + 49], ' ') AS win
        FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS p FROM words WHERE len(ws) >= 50)
    ), firsts AS (
        SELECT win, min(doc_id) AS low FROM wins GROUP BY win
    ), marked AS (
        SELECT DISTINCT doc_id, unnest(range(p, p + 50)) AS q
        FROM wins JOIN firsts USING (win) WHERE low < doc_id
    ), gone AS (
        SELECT doc_id, list(q) AS qs FROM marked GROUP BY doc_id
    ), every AS (
        SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS q FROM words
    ), kept AS (
        SELECT e.doc_id, string_agg(e.word, ' ' ORDER BY e.q) AS t
        FROM every e LEFT JOIN marked m ON e.doc_id = m.doc_id AND e.q = m.q
        WHERE m.q IS NULL GROUP BY e.doc_id
    )
    SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(len(qs), 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
    FROM words w LEFT JOIN gone USING (doc_id) LEFT JOIN kept USING (doc_id)
    """
)
def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup.dedup_substrings(spark, read(spark, sf_dir, "documents").select("doc_id", "text"), window=50)
    # What is kept, its words joined by one space.
    kept = F.btrim(F.regexp_replace(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+", " "), F.lit(" "))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(kept, 256).alias("kept_sha256"))


def _codes_sql() -> str:
    """Op 11 in SQL: each round finds the nearest entry of every part by
    |x|^2 - 2xe + |e|^2, exact in doubles at these magnitudes."""
    steps = [
        """
        kept AS (
            SELECT vec_id, label, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v
            FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), parts AS (
            SELECT vec_id, label, part, v[part * (len(v) // 4) + 1:(part + 1) * (len(v) // 4)] AS x
            FROM kept, (SELECT unnest(range(4)) AS part)
        ), book0 AS (
            SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry, x AS e FROM parts
            QUALIFY row_number() OVER (PARTITION BY part ORDER BY vec_id) <= 256
        )"""
    ]
    for i in range(5):
        steps.append(f"""
        near{i} AS (
            SELECT vec_id, label, p.part, any_value(x) AS x,
                   min(CAST(list_inner_product(x, x) - 2 * list_inner_product(x, e) + list_inner_product(e, e) AS BIGINT) * 256 + entry) AS best
            FROM parts p JOIN book{i} b ON p.part = b.part GROUP BY vec_id, label, p.part
        )""")
        if i < 4:
            steps.append(f"""
        mean{i} AS (
            SELECT part, entry, list(m ORDER BY pos) AS e FROM (
                SELECT part, best % 256 AS entry, pos, floor(sum(c) / count(*)) AS m
                FROM (SELECT part, best, unnest(x) AS c, generate_subscripts(x, 1) AS pos FROM near{i}) GROUP BY ALL
            ) GROUP BY part, entry
        ), book{i + 1} AS (
            SELECT b.part, b.entry, coalesce(m.e, b.e) AS e FROM book{i} b LEFT JOIN mean{i} m ON b.part = m.part AND b.entry = m.entry
        )""")
    return (
        "WITH"
        + ",".join(steps)
        + """,
        codes AS (
            SELECT vec_id, label, string_agg(printf('%02x', best % 256), '' ORDER BY part) AS code, CAST(sum(best // 256) AS BIGINT) AS error
            FROM near4 GROUP BY vec_id, label
        ), labels_error AS (
            SELECT label, CAST(sum(error) AS BIGINT) AS label_error FROM codes GROUP BY label
        ), hashed AS (
            SELECT sha256(string_agg(CAST(CAST(c AS BIGINT) AS VARCHAR), ',' ORDER BY part, entry, pos)) AS codebooks_sha256
            FROM (SELECT part, entry, unnest(e) AS c, generate_subscripts(e, 1) AS pos FROM book4)
        )
        SELECT vec_id, code, error, label_error, codebooks_sha256
        FROM codes JOIN labels_error ON codes.label IS NOT DISTINCT FROM labels_error.label, hashed"""
    )


@query(_codes_sql())
def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes, books = vector_codes.compress(spark, read(spark, sf_dir, "embeddings"))
    return codes.select("vec_id", "code", "error", "label_error", F.lit(vector_codes.digest(books)).alias("codebooks_sha256"))


@query(
    """
    WITH RECURSIVE ranked AS (
        SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS pos,
               coalesce(role, '') AS role, coalesce(text, '') AS text
        FROM conversations WHERE conv_id IS NOT NULL
    ), convs AS (
        SELECT conv_id, conv_id - conv_id % 5 AS base,
               xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
                   lambda crc, b: list_reduce(list_prepend(xor(crc, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
                                              lambda x, k: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) % 9 AS h
        FROM (SELECT DISTINCT conv_id FROM ranked)
    ), taken AS (
        SELECT c.conv_id, c.h, count(r.pos) AS got FROM convs c LEFT JOIN ranked r ON r.conv_id = c.base AND r.pos <= c.h GROUP BY ALL
    ), turns AS (
        SELECT c.conv_id, r.pos, r.role, r.text FROM convs c JOIN ranked r ON r.conv_id = c.base AND r.pos <= c.h
        UNION ALL
        SELECT t.conv_id, r.pos - t.h + t.got, r.role, r.text FROM taken t JOIN ranked r ON r.conv_id = t.conv_id AND r.pos > t.h
    ), chain AS (
        SELECT conv_id, 0::BIGINT AS depth, sha256('') AS node, NULL::VARCHAR AS parent, 0::BIGINT AS bytes FROM convs
        UNION ALL
        SELECT c.conv_id, c.depth + 1, sha256(concat_ws(chr(0), c.node, t.role, t.text)), c.node, CAST(strlen(t.text) AS BIGINT)
        FROM chain c JOIN turns t ON t.conv_id = c.conv_id AND t.pos = c.depth + 1
    ), ends AS (
        SELECT arg_max(node, depth) AS node, conv_id FROM chain GROUP BY conv_id
    ), nodes AS (
        SELECT node, any_value(parent) AS parent, any_value(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(bytes) AS bytes
        FROM chain GROUP BY node
    ), kids AS (
        SELECT parent AS node, count(*) AS n_children FROM nodes WHERE parent IS NOT NULL GROUP BY parent
    ), above AS (
        SELECT node AS top, node FROM nodes
        UNION ALL
        SELECT n.parent, a.node FROM above a JOIN nodes n ON n.node = a.top WHERE n.parent IS NOT NULL
    ), sums AS (
        SELECT a.top AS node, count(*) FILTER (WHERE k.node IS NULL) AS n_leaves, CAST(sum((n.n_convs - 1) * n.bytes) AS BIGINT) AS saved_tokens
        FROM above a JOIN nodes n ON n.node = a.node LEFT JOIN kids k ON k.node = a.node GROUP BY a.top
    ), lists AS (
        SELECT node, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) AS ids FROM ends GROUP BY node
    )
    SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n_children, 0) AS n_children, s.n_leaves, s.saved_tokens,
           sha256(coalesce(l.ids, '')) AS ends_sha256
    FROM nodes n LEFT JOIN nodes p ON p.node = n.parent LEFT JOIN kids k ON k.node = n.node JOIN sums s ON s.node = n.node LEFT JOIN lists l ON l.node = n.node
    """
)
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(spark, read(spark, sf_dir, "conversations"))


@query()
def op13_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    out = pii.find(spark, docs, pii.learn(spark, docs))
    return out.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base", 256).alias("base_sha256"), "spans")

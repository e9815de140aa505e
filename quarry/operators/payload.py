"""Semi-structured payloads: JSON text parsed once into Spark's VARIANT.

The schema of all payloads comes from one distributed aggregate
(``schema_of_variant_agg``), and fields are taken out of the variant by path,
so a text is parsed once however many fields are asked for.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_FIELD = re.compile(r"^\$(\.[A-Za-z_][A-Za-z0-9_]*|\[[0-9]+\]|\['[^'\\]+'\])*$")


def parsed(df: DataFrame, column: str, name: str = "payload") -> DataFrame:
    """``df`` with the text of ``column`` as a variant; NULL where it is no
    JSON."""
    return df.withColumn(name, F.try_parse_json(F.col(f"`{column}`")))


def payload_schema(df: DataFrame, column: str) -> str:
    """The one schema that holds every payload of ``column`` (JSON text), as
    Spark SQL text; ``VOID`` if there is none."""
    got = parsed(df, column).agg(F.schema_of_variant_agg("payload").alias("s")).first().s
    return re.sub(r"\bOBJECT<", "STRUCT<", got or "VOID")


def extract(df: DataFrame, column: str, paths: dict[str, tuple[str, str]]) -> DataFrame:
    """``df`` with a column per entry of ``paths``: {name: (path, type)}. A
    path that is missing, a value that does not fit the type and a text that
    is no JSON give NULL."""
    wrong = [p for p, _ in paths.values() if not _FIELD.match(p)]
    if wrong:
        raise ValueError(f"no paths of the form $.a.b[0]: {wrong}")
    with_payload = parsed(df, column, "_payload")
    return with_payload.select(*[F.col(f"`{c}`") for c in df.columns], *[F.try_variant_get("_payload", p, t).alias(n) for n, (p, t) in paths.items()])


def flattened(df: DataFrame, column: str) -> DataFrame:
    """``df`` with a column for each top-level field that any payload has,
    of the type that holds all its values (found by ``payload_schema``)."""
    schema = payload_schema(df, column)
    if not schema.startswith("STRUCT<"):
        return df
    taken = {c.lower() for c in df.columns}
    row = parsed(df, column, "_payload").withColumn("_payload", F.try_variant_get("_payload", "$", schema))
    names = [f.name for f in row.schema["_payload"].dataType.fields]
    clash = [n for n in names if n.lower() in taken]
    if clash:
        raise ValueError(f"payload fields {clash} are already columns")
    return row.select(*[F.col(f"`{c}`") for c in df.columns], *[F.col(f"_payload.`{n}`").alias(n) for n in names])
